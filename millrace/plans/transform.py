"""Flatten, normalise, validate, dedupe: two outputs of one normalisation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions import variants as V
from millrace.operators.dedupe import dedupe
from millrace.operators.flatten import flatten_records
from millrace.operators.once import computed_once
from millrace.operators.normalize import normalize_variant, variant_depth
from millrace.operators.shape import Shape, normalize_known, shape_of
from millrace.operators.validate import ERRORS, INDEX, with_validation_errors
from millrace.session import whole_payloads
from millrace.specs import API_A, API_B, SourceSpec


@dataclass(frozen=True)
class TransformSpec:
    required: tuple[str, ...] = ()
    timestamps: tuple[str, ...] = ()
    keys: tuple[str, ...] = ()
    sort: str | None = None
    flatten: bool = False
    normalize_keys: bool = True
    split_acronyms: bool = False
    # Set, records go through the general expressions for unknown fields, down to this depth.
    max_depth: int | None = None
    # What `shape_of` gave for exactly these records; None finds it in one pass over them.
    shape: Shape | None = None
    # What `schema_of_variant_agg` gave for exactly these records; the pass over them is saved then.
    schema: str | None = None
    # Column with the JSON text of each record, for the order of fields that get one name.
    text: str | None = None
    flatten_depth: int = 10


def spec_for(source: SourceSpec) -> TransformSpec:
    return TransformSpec(source.required, source.timestamps, (source.key,), source.version)


PRESETS = {s.name: spec_for(s) for s in (API_A, API_B)}


def _not_object(payload: str) -> Column:
    message = F.concat(F.lit("record is not an object: "), F.to_json(payload))
    return F.raise_error(message).cast("variant")


def normalized(df: DataFrame, spec: TransformSpec, payload: str = "payload") -> DataFrame:
    """Records with normalised payloads; one that is not an object stays as it is, for validation to reject.

    Where neither `spec.shape` nor `spec.schema` is given, this runs one aggregation over the records to find it.
    """
    shape = spec.shape or (None if spec.max_depth else shape_of(df, payload, spec.flatten, spec.schema))
    if shape and not (spec.flatten and shape.mixed_objects):
        done = normalize_known(payload, shape, spec.timestamps, spec.normalize_keys, spec.split_acronyms, flatten_depth=spec.flatten_depth if spec.flatten else None, text=spec.text)
        other = F.when(F.col(payload).isNotNull(), _not_object(payload)) if spec.flatten else F.col(payload)
        return computed_once(df, payload, F.coalesce(done, other))
    depth = spec.max_depth or max(1, variant_depth(df, payload))
    if spec.flatten:
        df = flatten_records(df, payload, max_depth=spec.flatten_depth)
    done = normalize_variant(payload, spec.timestamps, spec.normalize_keys, spec.split_acronyms, max_depth=depth)
    return computed_once(df, payload, F.coalesce(done, F.col(payload)))


def dedupe_payload(
    df: DataFrame, keys: Sequence[str], sort: str | None = None, keep: str = "last", ordinal: str = "ordinal", payload: str = "payload"
) -> DataFrame:
    """`dedupe` on payload fields. Keys compare as JSON, so the text "1" and the number 1 differ."""
    v = F.col(payload)
    names = {f"__key{i}": V.field(v, k) for i, k in enumerate(keys)}
    keyed = df.withColumns({n: F.when(~F.is_variant_null(k), F.to_json(k)) for n, k in names.items()})
    if sort:
        # Numbers compare as numbers and come before texts.
        keyed = keyed.withColumn("__value", V.field(v, sort))
        is_number = F.expr(V.is_number("schema_of_variant(__value)"))
        exact, large = (F.when(is_number, F.try_variant_get("__value", "$", t)) for t in ("decimal(38,9)", "double"))
        text = F.try_variant_get("__value", "$", "string")
        order = F.struct(large.isNull().alias("is_text"), large.alias("large"), exact.alias("exact"), F.when(large.isNull(), text).alias("text"))
        keyed = keyed.withColumn("__sort", F.when(text.isNotNull(), order)).drop("__value")
    one = dedupe(keyed, list(names), "__sort" if sort else None, keep, tie_break=[ordinal])
    return one.drop(*names, "__sort")


def transform(
    df: DataFrame, spec: TransformSpec, ordinal: str = "ordinal", payload: str = "payload", work: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) records of ``(ordinal, payload)`` rows, other columns carried along.

    Valid rows are one per key; rejected ones keep their errors and position. The only shuffle is the
    dedupe, and it moves one row per key and task. With ``work``, a new folder that all executors reach, the
    normalised records are written there once and both outputs read them; else each output works them out anew.
    """
    checked = with_validation_errors(normalized(df, spec, payload), spec.required, payload)
    if work:
        with whole_payloads(df.sparkSession):
            checked.write.parquet(work)
        checked = df.sparkSession.read.schema(checked.schema).parquet(work)
    valid = checked.where(F.size(ERRORS) == 0).drop(ERRORS)
    rejected = checked.where(F.size(ERRORS) > 0).withColumn(INDEX, F.col(ordinal))
    if spec.keys:
        valid = dedupe_payload(valid, spec.keys, spec.sort, ordinal=ordinal, payload=payload)
    return valid, rejected


def transform_source(
    df: DataFrame, source: str, ordinal: str = "ordinal", flatten: bool = False, work: str | None = None, schema: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """`transform` with the source's own settings."""
    return transform(df, replace(PRESETS[source], flatten=flatten, schema=schema), ordinal, work=work)
