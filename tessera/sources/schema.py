"""Schema system (§1.3): inferred over all records (S08), merged (S09),
declared in config (S14), and applied on append (S10).

Inference is Spark's own: one aggregate over the parsed lines gives the merged
type of every field, and only that one type text reaches the driver.  Where
records disagree, one more aggregate per clashing path looks for objects.

Promotion rules (fixed):
  * null values are ignored, so a field that is always null does not appear;
  * INTEGER + FLOAT → FLOAT; RECORD beats any other type; any other clash
    → STRING;
  * an empty or all-null list is a list of STRING.
Fields come in name order.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

STRING, LONG, DOUBLE, BOOL = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType()


def merge_types(cur: T.DataType, new: T.DataType) -> T.DataType:
    """S09 type promotion; the shape (list or not) of ``cur`` is kept."""
    cur_list, new_list = isinstance(cur, T.ArrayType), isinstance(new, T.ArrayType)
    ce = cur.elementType if cur_list else cur
    ne = new.elementType if new_list else new
    if isinstance(ce, T.StructType) and isinstance(ne, T.StructType):
        merged = merge_schema(ce, ne)
    elif isinstance(ce, T.StructType):
        merged = ce
    elif isinstance(ne, T.StructType):
        merged = ne
    elif ce == ne:
        merged = ce
    elif {ce.typeName(), ne.typeName()} == {"long", "double"}:
        merged = DOUBLE
    else:
        merged = STRING
    return T.ArrayType(merged) if cur_list else merged


def merge_schema(a: T.StructType, b: T.StructType) -> T.StructType:
    """Merge two nested schemas; new fields are appended in order."""
    fields = {f.name: f.dataType for f in a.fields}
    order = [f.name for f in a.fields]
    for f in b.fields:
        if f.name not in fields:
            fields[f.name] = f.dataType
            order.append(f.name)
        else:
            fields[f.name] = merge_types(fields[f.name], f.dataType)
    return T.StructType([T.StructField(n, fields[n], True) for n in order])


def _merged_type(values: DataFrame) -> T.DataType | None:
    """Spark's merged type of the variant column ``v`` (VARIANT where values disagree); None without rows."""
    text = values.agg(F.expr("schema_of_variant_agg(v)")).first()[0]
    if text is None:
        return None
    # the aggregate's type text is DDL but for the name of records
    return T.DataType.fromDDL(re.sub(r"\bOBJECT<", "struct<", text))


def _promoted(dt: T.DataType | None, values: DataFrame) -> T.DataType | None:
    """The promotion rules applied to a merged type; ``values`` are its values as variants in ``v``."""
    if dt is None or isinstance(dt, T.NullType):
        return None
    if isinstance(dt, T.StructType):
        fields = []
        for f in dt.fields:
            path = "$['" + f.name.replace("\\", "\\\\").replace("'", "\\'") + "']"
            found = _promoted(f.dataType, values.select(F.try_variant_get("v", path, "variant").alias("v")))
            if found is not None:
                fields.append(T.StructField(f.name, found))
        return T.StructType(fields)
    if isinstance(dt, T.ArrayType):
        items = values.select(F.explode(F.col("v").try_cast("array<variant>")).alias("v"))
        return T.ArrayType(_promoted(dt.elementType, items) or STRING)
    if isinstance(dt, T.VariantType):  # a clash: a record wins, else text
        records = values.filter(F.schema_of_variant("v").startswith("OBJECT"))
        return _promoted(_merged_type(records), records) or STRING
    if isinstance(dt, T.DecimalType):  # JSON numbers with a fraction, or beyond 64 bits
        return DOUBLE
    if isinstance(dt, (T.LongType, T.DoubleType, T.BooleanType)):
        return dt
    return STRING


def infer_schema(lines: DataFrame, value_col: str = "value") -> T.StructType:
    """The schema of JSON lines over all records; lines that are no objects are left out.

    An empty struct when no line is an object.
    """
    parsed = lines.select(F.try_parse_json(F.col(value_col)).alias("v"))
    records = parsed.filter(F.schema_of_variant("v").startswith("OBJECT"))
    return _promoted(_merged_type(records), records) or T.StructType([])


# ---- declared schemas (S14) ---------------------------------------------------------

_TYPES = {
    "STRING": STRING, "INTEGER": LONG, "INT64": LONG, "FLOAT": DOUBLE, "FLOAT64": DOUBLE,
    "BOOLEAN": BOOL, "BOOL": BOOL, "TIMESTAMP": T.TimestampType(), "DATETIME": T.TimestampNTZType(),
    "DATE": T.DateType(), "JSON": STRING, "NUMERIC": T.DecimalType(38, 9),
}


def spark_type(type_name: str, fields: Sequence[dict] | None = None) -> T.DataType:
    t = type_name.upper()
    if t in ("RECORD", "STRUCT"):
        return schema_from_config(fields or [])
    if t not in _TYPES:
        raise ValueError(f"unknown field type {type_name!r}")
    return _TYPES[t]


def schema_from_config(fields: Sequence[dict]) -> T.StructType:
    """``[{name, type, mode, fields}]`` → StructType (REPEATED → array)."""
    out = []
    for f in fields:
        dt = spark_type(f.get("bq_type") or f.get("type", "STRING"), f.get("fields"))
        if str(f.get("mode", "NULLABLE")).upper() == "REPEATED":
            dt = T.ArrayType(dt)
        out.append(T.StructField(f["name"], dt, str(f.get("mode", "NULLABLE")).upper() != "REQUIRED"))
    return T.StructType(out)


def align_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Add missing columns as typed nulls and keep the target's order;
    columns unknown to the target are ignored."""
    have = {f.name.lower(): f.name for f in df.schema.fields}
    cols = []
    for f in schema.fields:
        src = have.get(f.name.lower())
        cols.append((F.col(src) if src else F.lit(None)).cast(f.dataType).alias(f.name))
    return df.select(*cols)
