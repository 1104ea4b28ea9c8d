"""What is known about each source: its fields, key and clocks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

RAW_SCHEMA = T.StructType(
    [
        T.StructField("payload", T.VariantType()),
        T.StructField("source", T.StringType()),
        T.StructField("ingested_at", T.TimestampNTZType()),
        T.StructField("batch_id", T.StringType()),
        T.StructField("file_name", T.StringType()),
    ]
)

LINEAGE = ("ingested_at", "batch_id", "file_name")


@dataclass(frozen=True)
class FieldSpec:
    """A typed column of the clean table and where the payload holds it."""

    name: str
    keys: tuple[str, ...]
    dtype: str


def _fields(*rows: tuple[str, str, str]) -> tuple[FieldSpec, ...]:
    return tuple(FieldSpec(name, tuple(keys.split(".")), dtype) for name, keys, dtype in rows)


@dataclass(frozen=True)
class SourceSpec:
    name: str
    table: str
    key: str
    version: str
    required: tuple[str, ...]
    timestamps: tuple[str, ...]
    fields: tuple[FieldSpec, ...]

    @property
    def qualified_table(self) -> str:
        return f"CLEAN.{self.table}"

    @property
    def clean_columns(self) -> list[str]:
        return [f.name for f in self.fields] + [*LINEAGE, "_loaded_at"]

    @property
    def clean_schema(self) -> str:
        """DDL of the clean table, for readers that must not infer it."""
        lineage = ["ingested_at timestamp_ntz", "batch_id string", "file_name string", "_loaded_at timestamp_ntz"]
        return ", ".join([f"{f.name} {f.dtype}" for f in self.fields] + lineage)


# Column names, payload fields and types of the two sources.
API_A = SourceSpec(
    name="api_a",
    table="CLN_API_A_EVENTS",
    key="id",
    version="updated_at",
    required=("id",),
    timestamps=("created_at", "updated_at"),
    fields=_fields(
        ("id", "id", "string"),
        ("created_at", "created_at", "timestamp_ntz"),
        ("updated_at", "updated_at", "timestamp_ntz"),
        ("name", "name", "string"),
        ("status", "status", "string"),
        ("event_type", "type", "string"),
        ("value", "value", "decimal(38,0)"),
        ("description", "description", "string"),
        ("category", "metadata.category", "string"),
        ("tags", "metadata.tags", "array<string>"),
    ),
)

API_B = SourceSpec(
    name="api_b",
    table="CLN_API_B_EVENTS",
    key="id",
    version="modified_at",
    required=("id",),
    timestamps=("created_at", "modified_at"),
    fields=_fields(
        ("id", "id", "string"),
        ("created_at", "created_at", "timestamp_ntz"),
        ("modified_at", "modified_at", "timestamp_ntz"),
        ("title", "title", "string"),
        ("state", "state", "string"),
        ("priority", "priority", "string"),
        ("amount", "amount", "decimal(18,2)"),
        ("notes", "notes", "string"),
        ("user_id", "user_id", "string"),
        ("user_name", "user_name", "string"),
    ),
)

SOURCES = {spec.name: spec for spec in (API_A, API_B)}
