"""Nested-value column builders N01–N14.

JSON text is navigated with ``get_json_object`` / ``from_json``; arrays
are reshaped with higher-order functions (``transform``, ``filter``,
``map_filter``), which run inside codegen — no Python per row.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def json_path(json_col, path: str) -> Column:
    """``$.a.b[0].c`` scalar as text, null when absent."""
    return F.get_json_object(_c(json_col), path)


def json_first_value(json_col, object_path: str, key: str | None = None) -> Column:
    """``$.m.*.k`` — first value of an object (first key in document order)."""
    obj = F.get_json_object(_c(json_col), object_path)
    first = F.get(F.map_values(F.from_json(obj, T.MapType(T.StringType(), T.StringType()))), F.lit(0))
    return first if key is None else F.get_json_object(first, f"$.{key}")


def json_string_array(json_col, path: str = "$") -> Column:
    """JSON_VALUE_ARRAY → ``array<string>``."""
    src = _c(json_col) if path == "$" else F.get_json_object(_c(json_col), path)
    return F.from_json(src, T.ArrayType(T.StringType()))


def json_object_struct(json_col, base: str, fields: dict[str, tuple[str, str]]) -> Column:
    """A RECORD built from paths relative to ``base``.

    ``fields``: name → (relative path, Spark type).  Null when the base is
    missing or is not an object.
    """
    obj = F.get_json_object(_c(json_col), base) if base != "$" else _c(json_col)
    members = [F.get_json_object(obj, rel).cast(typ).alias(name) for name, (rel, typ) in fields.items()]
    return F.when(F.ltrim(obj).startswith("{"), F.struct(*members))


def json_array_of_struct(json_col, path: str, element: T.StructType) -> Column:
    """Array of objects → ``array<struct>`` (nested arrays allowed in ``element``)."""
    src = _c(json_col) if path == "$" else F.get_json_object(_c(json_col), path)
    return F.from_json(src, T.ArrayType(element))


def struct_from_positions(arr, names: Sequence[str], types: Sequence[str] | None = None) -> Column:
    """``[[a, b, …]]`` → ``array<struct<names…>>`` by element position."""
    types = types or [None] * len(names)

    def build(x):
        return F.struct(*[
            (F.get(x, F.lit(i)).cast(t) if t else F.get(x, F.lit(i))).alias(n)
            for i, (n, t) in enumerate(zip(names, types))
        ])

    return F.transform(_c(arr), build)


def flatten_pairs(arr) -> Column:
    """Unknown 2-wide arrays → ``array<struct<timestamp, value>>``."""
    return struct_from_positions(arr, ["timestamp", "value"])


def flatten_wide(arr, width: int) -> Column:
    """Unknown wider arrays → ``array<struct<val_0 … val_{width-1}>>``."""
    return struct_from_positions(arr, [f"val_{i}" for i in range(width)])


def flatten_by_width(arr, mappings: dict[int, Sequence[str]]) -> Column:
    """``array<struct>`` whose field names are picked by the width of the first element.

    One column has one type, so the structs hold the names of all widths, null
    where a width lacks one; a width without names gives null.
    """
    a = _c(arr)
    names = list(dict.fromkeys(n for own in mappings.values() for n in own))
    width = F.size(F.get(a, F.lit(0)))

    def named(own: Sequence[str]) -> Column:
        at = [list(own).index(n) if n in own else -1 for n in names]  # position -1 is null
        return F.transform(a, lambda x: F.struct(*[F.get(x, F.lit(i)).alias(n) for i, n in zip(at, names, strict=True)]))

    out = None
    for w, own in sorted(mappings.items()):
        out = F.when(width == w, named(own)) if out is None else out.when(width == w, named(own))
    return out


def zip_descriptors(values, descriptors, key_field: str = "key", index_field: str = "metricsIndex") -> Column:
    """``[[v0, v1…]]`` + ``[{key, index}]`` → ``array<map<key, value>>``
    with null values dropped from each map."""
    d = _c(descriptors)

    def one(v):
        pairs = F.transform(d, lambda x: F.struct(x[key_field].alias("k"), F.get(v, x[index_field]).alias("v")))
        m = F.map_from_entries(pairs)
        return F.map_filter(m, lambda k, x: x.isNotNull())

    return F.transform(_c(values), one)


def drop_null_entries(m) -> Column:
    """Drop null-valued keys; an empty map becomes null."""
    f = F.map_filter(_c(m), lambda k, v: v.isNotNull())
    return F.when(F.size(f) > 0, f)


def repair_array(json_col, path: str, element: T.DataType) -> Column:
    """Missing / non-list → ``[]``; a scalar becomes a one-element list."""
    raw = F.get_json_object(_c(json_col), path)
    parsed = F.from_json(raw, T.ArrayType(element))
    scalar = F.when(raw.isNotNull() & ~F.ltrim(raw).startswith("["), F.array(raw.cast(element)))
    return F.coalesce(parsed, scalar, F.array().cast(T.ArrayType(element)))


def _is_numeric_matrix(dt: T.DataType) -> bool:
    return (
        isinstance(dt, T.ArrayType)
        and isinstance(dt.elementType, T.ArrayType)
        and isinstance(dt.elementType.elementType, T.NumericType)
    )


def flatten_nested_arrays(col: Column, dt: T.DataType, widths: dict[str, int] | None = None, name: str = "") -> Column:
    """Walk a schema and rewrite every numeric ``[[…]]`` to an array of
    structs (pairs → ``{timestamp,value}``, wider → ``{val_i}``), recursing
    into structs, lists (of lists) and maps.  ``widths`` names the widest element of
    each path (see :func:`matrix_widths`); without it an element keeps what
    stands behind its pair in ``more``.  Driven by the schema on the driver;
    the resulting expression runs on executors.
    """
    widths = widths or {}
    if _is_numeric_matrix(dt):
        w = widths.get(name)
        if w is not None:
            return flatten_pairs(col) if w <= 2 else flatten_wide(col, w)
        # width unknown: a pair, and whatever stands behind it
        return F.transform(col, lambda x: F.struct(
            F.get(x, F.lit(0)).alias("timestamp"), F.get(x, F.lit(1)).alias("value"),
            F.when(F.size(x) > 2, F.slice(x, F.lit(3), F.greatest(F.size(x) - 2, F.lit(0)))).alias("more")))
    if isinstance(dt, T.StructType):
        return F.when(col.isNotNull(), F.struct(*[
            flatten_nested_arrays(col[f.name], f.dataType, widths, f"{name}.{f.name}".strip(".")).alias(f.name)
            for f in dt.fields
        ]))
    if isinstance(dt, T.ArrayType) and isinstance(dt.elementType, (T.StructType, T.ArrayType, T.MapType)):
        return F.transform(col, lambda x: flatten_nested_arrays(x, dt.elementType, widths, name))
    if isinstance(dt, T.MapType):
        return F.transform_values(col, lambda k, v: flatten_nested_arrays(v, dt.valueType, widths, name))
    return col


def _width_paths(dt: T.DataType, name: str) -> list[tuple[str, Callable[[Column], Column]]]:
    """(path, expression of the widest element) of every numeric ``[[…]]`` of a type, at any depth."""
    widest = lambda inner: lambda arr: F.array_max(F.transform(arr, inner))
    if _is_numeric_matrix(dt):
        return [(name, widest(F.size))]
    if isinstance(dt, T.StructType):
        member = lambda inner, key: lambda col: inner(col[key])
        return [(path, member(inner, f.name)) for f in dt.fields
                for path, inner in _width_paths(f.dataType, f"{name}.{f.name}".strip("."))]
    if isinstance(dt, T.ArrayType):
        return [(path, widest(inner)) for path, inner in _width_paths(dt.elementType, name)]
    if isinstance(dt, T.MapType):
        values = lambda inner: lambda col: widest(inner)(F.map_values(col))
        return [(path, values(inner)) for path, inner in _width_paths(dt.valueType, name)]
    return []


def matrix_widths(df: DataFrame) -> dict[str, int]:
    """Widest element of every numeric ``[[…]]`` of a frame, by path: one row of maxima reaches the driver.

    Lists and maps on the way are no part of the path: the widest over all of their members counts.
    """
    found = [(path, inner(F.col(f"`{f.name}`"))) for f in df.schema.fields for path, inner in _width_paths(f.dataType, f.name)]
    if not found:
        return {}
    row = df.agg(*[F.max(c).alias(f"w{i}") for i, (_, c) in enumerate(found)]).first()
    return {name: w for (name, _), w in zip(found, row, strict=True) if w is not None}
