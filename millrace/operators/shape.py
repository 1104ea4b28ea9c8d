"""Normalising VARIANT records by the fields they are known to have.

One aggregation pass merges the schemas of all records. Its field names are then known to the driver: new names are
worked out there, and every field is read by its path and handled by its type, in compiled code. Values whose type
differs from record to record (the merged schema says VARIANT) go through the general expressions, which look at every
value at run time.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F, types as T

from millrace.functions import timefn, variants as V
from millrace.functions.sqltext import let, literal
from millrace.functions.text import snake_name, trim_sql
from millrace.operators.flatten import struct_ddl
from millrace.operators.normalize import container_sql, depth_of

# Beyond this many fields, as when keys are data, a plan with an expression per field costs more than it saves.
MOST_FIELDS = 400
# Depth that the general expressions may be written out for without a look at how deep the values really are.
DEPTH_UNSEEN = 6
NOTHING = "CAST(array() AS array<struct<key:string,value:variant>>)"
NUMBERS = (T.LongType, T.IntegerType, T.ShortType, T.ByteType, T.DoubleType, T.FloatType, T.DecimalType)


@dataclass(frozen=True)
class Shape:
    """The fields that records have; how deep the values of no one type are nested, and whether objects may be among them.

    ``objects`` has the fields of the objects in lists of no one type, by the path of the list, as far as they are known.
    """

    struct: T.StructType
    depth: int = 1
    mixed_objects: bool = False
    objects: dict[tuple[str, ...], T.StructType] = field(default_factory=dict)


def _fields(dtype: T.DataType) -> int:
    if isinstance(dtype, T.ArrayType):
        return _fields(dtype.elementType)
    return sum(1 + _fields(f.dataType) for f in dtype.fields) if isinstance(dtype, T.StructType) else 0


def _addressable(dtype: T.DataType) -> bool:
    """A path can not name a key that holds a double quote."""
    if isinstance(dtype, T.ArrayType):
        return _addressable(dtype.elementType)
    return all('"' not in f.name and _addressable(f.dataType) for f in dtype.fields) if isinstance(dtype, T.StructType) else True


def _mixed(dtype: T.DataType) -> bool:
    """Whether values inside are of no one type."""
    if isinstance(dtype, T.StructType):
        return any(_mixed(f.dataType) for f in dtype.fields)
    return _mixed(dtype.elementType) if isinstance(dtype, T.ArrayType) else isinstance(dtype, T.VariantType)


def _mixed_values(root: str, path: tuple[str, ...], struct: T.StructType) -> list[str]:
    out = []
    for f in struct.fields:
        here = (*path, f.name)
        if isinstance(f.dataType, T.StructType):
            out += _mixed_values(root, here, f.dataType)
        elif _mixed(f.dataType):
            out.append(_get(root, here))
    return out


def _mixed_lists(path: tuple[str, ...], struct: T.StructType) -> list[tuple[str, ...]]:
    """Paths of lists whose elements are of no one type, outside of lists."""
    out = []
    for f in struct.fields:
        if isinstance(f.dataType, T.StructType):
            out += _mixed_lists((*path, f.name), f.dataType)
        elif isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.VariantType):
            out.append((*path, f.name))
    return out


def _is_object(v: str) -> str:
    return V.is_object(f"schema_of_variant({v})")


def _objects_in(root: str, path: tuple[str, ...]) -> Column:
    """Schema of the objects in a list."""
    objects = f"filter({_get(root, path, V.ITEMS, 'try_')}, x -> {_is_object('x')})"
    return F.schema_of_variant_agg(F.expr(f"to_variant_object({objects})"))


def shape_of(df: DataFrame, column: str, flattened: bool = False, schema: str | None = None) -> Shape | None:
    """The shape of exactly these records; None where records are not all objects or have too many fields.

    One aggregation pass, merged in each task first; none where ``schema``, as `schema_of_variant_agg` gave it for these
    records, is at hand. Values of no one type take a second one over them alone, and a third if they may be deep, or if
    records are to be ``flattened``, which has to know whether objects are among them.
    """
    if schema is None:
        schema = df.agg(F.schema_of_variant_agg(column)).first()[0]
    struct = T.DataType.fromDDL(struct_ddl(schema))
    if not isinstance(struct, T.StructType) or _fields(struct) > MOST_FIELDS or not _addressable(struct):
        return None
    mixed = _mixed_values(column, (), struct)
    if not mixed:
        return Shape(struct)
    if not flattened:
        # No value is nested deeper than the list of them has opening brackets, that of the list aside.
        lists = _mixed_lists((), struct)
        values = df.select(F.expr(f"to_variant_object(array({', '.join(mixed)}))").alias("__values"), column)
        text = F.to_json("__values")
        brackets = F.max(F.length(text) - F.length(F.translate(text, "[{", "")))
        most, *schemas = values.agg(brackets, *[_objects_in(f"`{column}`", p) for p in lists]).first()
        if (most or 0) <= DEPTH_UNSEEN:
            found = {p: T.DataType.fromDDL(struct_ddl(s)) for p, s in zip(lists, schemas)}
            known = {p: d.elementType for p, d in found.items() if isinstance(d, T.ArrayType) and isinstance(d.elementType, T.StructType)}
            known = {p: d for p, d in known.items() if _fields(struct) + _fields(d) <= MOST_FIELDS and _addressable(d)}
            return Shape(struct, max(1, (most or 0) - 1), mixed_objects=True, objects=known)
    objects = F.exists(F.try_variant_get(column, "$", V.ITEMS), lambda v: F.schema_of_variant(v).like("OBJECT%"))
    values = df.select(F.expr(f"to_variant_object(array({', '.join(mixed)}))").alias(column))
    found = values.agg(F.max(depth_of(column)).alias("depth"), F.bool_or(objects).alias("objects")).first()
    return Shape(struct, max(1, (found["depth"] or 1) - 1), bool(found["objects"]))


def _get(root: str, path: tuple[str, ...], dtype: str = "variant", on_error: str = "") -> str:
    return f"{on_error}variant_get({root}, {literal(V.path(*path))}, '{dtype}')" if path else root


@dataclass(frozen=True)
class _Entry:
    """A field of a normalised object: its old and new name, and as SQL whether it is there and its value."""

    key: str
    name: str
    there: str
    value: str
    path: tuple[str, ...]


class _Writer:
    """SQL text of normalised values, by their types."""

    def __init__(self, shape: Shape, timestamps: Sequence[str], normalize_keys: bool, split_acronyms: bool, to_utc: bool, text: str | None):
        self.timestamps, self.to_utc, self.text = timestamps, to_utc, text
        self.rename: Callable[[str], str] = (lambda k: snake_name(k, split_acronyms)) if normalize_keys else (lambda k: k)
        self.depth, self.objects = shape.depth, shape.objects
        self.general = {"timestamps": timestamps, "normalize_keys": normalize_keys, "split_acronyms": split_acronyms, "to_utc": to_utc}
        self.variables = 0

    def object_(self, entries: list[_Entry], in_list: bool = False) -> str:
        """An object of these entries.

        Of several with one new name the last one stays, in the order of keys or, where the JSON text is at hand, in its
        order. Elements of lists have no path into the text.
        """
        ordered = sorted(entries, key=lambda e: e.key.encode())
        pair = lambda name, value: f"array(struct({literal(name)} AS key, {value} AS value))"
        groups: dict[str, list[_Entry]] = {}
        for e in ordered:
            groups.setdefault(e.name, []).append(e)
        parts, done = [], set()
        for e in ordered:
            group = groups[e.name]
            if len(group) == 1 or in_list or not self.text or not all(self.readable(x.path) for x in group):
                parts.append(f"IF({e.there}, {pair(e.name, e.value)}, {NOTHING})")
            elif e.name not in done:
                done.add(e.name)
                places = ", ".join(f"IF({x.there}, struct({self.place(x.path)} AS place, {i} AS nth), NULL)" for i, x in enumerate(group))
                last = f"greatest({places}).nth"
                cases = " ".join(f"WHEN {i} THEN {x.value}" for i, x in enumerate(group))
                parts.append(f"IF({last} IS NULL, {NOTHING}, {pair(e.name, f'CASE {last} {cases} END')})")
        listed = f"concat({', '.join(parts)})" if parts else NOTHING
        return f"to_variant_object(map_from_entries({listed}))"

    @staticmethod
    def readable(path: tuple[str, ...]) -> bool:
        """Whether `get_json_object` can follow a path."""
        return not any(c in key for key in path[:-1] for c in "'?")

    def place(self, path: tuple[str, ...]) -> str:
        """Where a field stands in the text: the place of each key of its path among the keys beside it."""
        spots = []
        for n, key in enumerate(path):
            above = "$" + "".join(f"['{k}']" for k in path[:n])
            keys = f"json_object_keys({f'get_json_object({self.text}, {literal(above)})' if n else self.text})"
            spots.append(f"coalesce(array_position({keys}, {literal(key)}), 0L)")
        return f"array({', '.join(spots)})"

    def fields(self, root: str, path: tuple[str, ...], struct: T.StructType) -> list[_Entry]:
        return [x for f in struct.fields for x in self.entry(root, (*path, f.name), f.name, f.dataType)]

    def entry(self, root: str, path: tuple[str, ...], key: str, dtype: T.DataType) -> list[_Entry]:
        """The field under its new name; a field whose name is left empty is dropped."""
        new = self.rename(key)
        return [_Entry(key, new, f"{_get(root, path)} IS NOT NULL", self.value(root, path, key, new, dtype), path)] if new else []

    def flat(self, root: str, path: tuple[str, ...], prefix: str, struct: T.StructType, sep: str, depth: int) -> list[_Entry]:
        """The entries of nested objects under joined names."""
        out = []
        for f in sorted(struct.fields, key=lambda f: f.name.encode()):
            here, key = (*path, f.name), f"{prefix}{sep}{f.name}" if prefix else f.name
            if isinstance(f.dataType, T.StructType) and depth > 0:
                out += self.flat(root, here, key, f.dataType, sep, depth - 1)
                new, raw = self.rename(key), _get(root, here)
                if new:
                    out.append(_Entry(key, new, f"is_variant_null({raw})", raw, here))
            else:
                out += self.entry(root, here, key, f.dataType)
        return out

    def value(self, root: str, path: tuple[str, ...], key: str, new: str, dtype: T.DataType) -> str:
        raw = _get(root, path)
        if key in self.timestamps or new in self.timestamps:
            return f"CAST({self.stamp(root, path, dtype)} AS VARIANT)"
        if isinstance(dtype, T.StringType):
            return f"CAST({trim_sql(_get(root, path, 'string', 'try_'))} AS VARIANT)"
        if isinstance(dtype, T.StructType):
            return f"IF(is_variant_null({raw}), {raw}, {self.object_(self.fields(root, path, dtype), in_list=root.startswith("item"))})"
        if isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.StructType):
            self.variables += 1
            x = f"item{self.variables}"
            each = f"IF(is_variant_null({x}), {x}, {self.object_(self.fields(x, (), dtype.elementType), in_list=True)})"
            return f"to_variant_object(transform({_get(root, path, V.ITEMS, 'try_')}, {x} -> {each}))"
        if path in self.objects and not root.startswith("item"):
            self.variables += 1
            x = f"item{self.variables}"
            each = f"IF({_is_object(x)}, {self.object_(self.fields(x, (), self.objects[path]), in_list=True)}, {x})"
            return f"IF(is_variant_null({raw}), {raw}, to_variant_object(transform({_get(root, path, V.ITEMS, 'try_')}, {x} -> {each})))"
        if isinstance(dtype, T.VariantType) or isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.VariantType):
            return self.any_(raw)
        return raw

    def stamp(self, root: str, path: tuple[str, ...], dtype: T.DataType) -> str:
        if isinstance(dtype, T.StringType):
            return timefn.normalize_ts_sql(_get(root, path, "string", "try_"), "string", to_utc=self.to_utc)
        if isinstance(dtype, NUMBERS):
            return timefn.normalize_ts_sql(_get(root, path, "double", "try_"), "double")
        if isinstance(dtype, (T.StructType, T.ArrayType, T.BooleanType)):
            return "CAST(NULL AS STRING)"
        return let("s", _get(root, path), timefn.normalize_ts_variant("s", "schema_of_variant(s)", to_utc=self.to_utc))

    def any_(self, raw: str) -> str:
        """A field whose values have no one type."""
        self.variables += 1
        v, k = f"any{self.variables}", f"kind{self.variables}"
        text = trim_sql(f"try_variant_get({v}, '$', 'string')")
        inner = container_sql(v, self.depth, **self.general)
        body = f"CASE WHEN {V.is_text(k)} THEN CAST({text} AS VARIANT) WHEN {V.is_object(k)} OR {V.is_array(k)} THEN {inner} ELSE {v} END"
        return let(v, raw, let(k, f"schema_of_variant({v})", body))


def normalize_known(
    column: str,
    shape: Shape,
    timestamps: Sequence[str] = (),
    normalize_keys: bool = True,
    split_acronyms: bool = False,
    to_utc: bool = False,
    flatten_depth: int | None = None,
    sep: str = "_",
    text: str | None = None,
):
    """`normalize_variant` for records of a known shape; with ``flatten_depth`` they are flattened first.

    NULL for a record that is no object. Flattening needs a shape without objects among its mixed values. ``text`` names
    a column with the JSON text of the record: with it, of fields that get one name the last in that text stays. A
    VARIANT keeps its keys sorted, so without it the last in key order does, as it does for objects in lists.
    """
    if flatten_depth and shape.mixed_objects:
        raise ValueError("a field that holds objects and other values can not be flattened by shape")
    writer = _Writer(shape, timestamps, normalize_keys, split_acronyms, to_utc, text and f"`{text}`")
    root = f"`{column}`"
    entries = writer.fields(root, (), shape.struct) if flatten_depth is None else writer.flat(root, (), "", shape.struct, sep, flatten_depth)
    return F.expr(f"IF({root} IS NULL OR is_variant_null({root}), NULL, {writer.object_(entries)})")
