"""Tables whose schema grows with their deliveries.

A table is a folder with its data and its schemas.  An append merges the
delivery's schema into the table's (:func:`merge_schema`: new fields, also
nested ones, are added; INTEGER with FLOAT becomes FLOAT; other clashes follow
the promotion rules).  If that changes the schema, the next version of it is
written first.  Data files go to the folder of the version they were written
in, aligned to it.  A reader aligns every version's files to the newest schema,
so old files are never rewritten, and one version is one scan with its own
columns: a query for two columns reads two columns of each.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.keep import _fs, path_exists
from tessera.sources.schema import STRING, merge_schema


def aligned(col: Column, have: T.DataType, want: T.DataType) -> Column:
    """A value of one type as a value of another type of the same table.

    Records get null for fields they lack and lose none of the others; lists go item by item; a single value becomes a
    list of one, and what is no record is a null record; records and lists become JSON where the table holds text.
    """
    if have == want:
        return col
    if isinstance(want, T.ArrayType):
        if isinstance(have, T.ArrayType):
            return F.transform(col, lambda x: aligned(x, have.elementType, want.elementType))
        return F.when(col.isNotNull(), F.array(aligned(col, have, want.elementType)))
    if isinstance(want, T.StructType):
        if not isinstance(have, T.StructType):
            return F.lit(None).cast(want)
        types = {f.name: f.dataType for f in have.fields}
        fields = [(aligned(col[f.name], types[f.name], f.dataType) if f.name in types else F.lit(None).cast(f.dataType))
                  .alias(f.name) for f in want.fields]
        return F.when(col.isNotNull(), F.struct(*fields))
    if isinstance(have, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(col) if want == STRING else F.lit(None).cast(want)
    return col.try_cast(want)


def align_deep(df: DataFrame, schema: T.StructType) -> DataFrame:
    """A frame in a table's schema, nested fields included."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[
        (aligned(F.col(f"`{f.name}`"), types[f.name], f.dataType) if f.name in types else F.lit(None).cast(f.dataType))
        .alias(f.name) for f in schema.fields])


class EvolvingTable:
    """A Parquet table with versioned schemas; one writer at a time, any number of readers."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def versions(self) -> list[T.StructType]:
        """All schemas, oldest first (metadata only)."""
        found = []
        while path_exists(self.spark, f"{self.path}/schema/{len(found):06d}/_SUCCESS"):
            text = self.spark.read.text(f"{self.path}/schema/{len(found):06d}", wholetext=True).first()[0]
            found.append(T.StructType.fromJson(json.loads(text)))
        return found

    def _data(self, version: int) -> str:
        return f"{self.path}/data/version={version:06d}"

    def append(self, delivery: DataFrame) -> int:
        """Append a delivery, widening the schema if it brings more; returns the version it was written in."""
        known = self.versions()
        merged = merge_schema(known[-1], delivery.schema) if known else merge_schema(T.StructType([]), delivery.schema)
        if not known or merged != known[-1]:
            place = f"{self.path}/schema/{len(known):06d}"
            self.spark.createDataFrame([(merged.json(),)], "value string").coalesce(1).write.mode("overwrite").text(place)
            known.append(merged)
        align_deep(delivery, known[-1]).write.mode("append").parquet(self._data(len(known) - 1))
        return len(known) - 1

    def read(self, version_col: str | None = None) -> DataFrame:
        """All deliveries in the newest schema (with the version that each row was written in)."""
        known = self.versions()
        if not known:
            raise FileNotFoundError(f"no evolving table at {self.path}")
        out = None
        for version, schema in enumerate(known):
            if path_exists(self.spark, self._data(version)):  # a delivery that failed leaves a schema without data
                part = align_deep(self.spark.read.schema(schema).parquet(self._data(version)), known[-1])
                part = part.withColumn(version_col, F.lit(version)) if version_col else part
                out = part if out is None else out.unionByName(part)
        return out if out is not None else self.spark.createDataFrame([], known[-1])
