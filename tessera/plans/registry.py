"""Model registry (I05, I08, I09, M04): named models with declared inputs,
a layer, and a materialisation (view / table / incremental), run in
dependency order.  This replaces the template compiler and model runner.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import keep

# The three layers and their namespaces
LAYERS = {"lake": "lake", "hub": "hub", "product": "product"}


def get_schema(layer: str) -> str:
    """Layer → namespace; unknown layers are an error."""
    try:
        return LAYERS[layer]
    except KeyError:
        raise ValueError(f"unknown layer {layer!r}; expected one of {sorted(LAYERS)}") from None


@dataclass
class Model:
    name: str
    build: Callable[..., DataFrame]
    inputs: Sequence[str] = ()
    layer: str = "product"
    materialized: str = "view"          # view | table | incremental
    unique_key: Sequence[str] = ()
    partition_by: Sequence[str] = ()
    tags: Sequence[str] = ()
    inserted_col: str = "_dp_inserted_at"
    updated_col: str = "_dp_updated_at"
    stamp: bool = True                  # False: ``updated_col`` is the model's own column (a high-water mark it carries)


@dataclass
class Registry:
    root: str
    models: dict[str, Model] = field(default_factory=dict)

    def add(self, model: Model) -> Model:
        get_schema(model.layer)
        self.models[model.name] = model
        return model

    def path(self, model: Model) -> str:
        return f"{self.root.rstrip('/')}/{get_schema(model.layer)}/{model.name}"

    def order(self, select: Sequence[str] | None = None) -> list[str]:
        """Topological order of the selected models (by name or tag) and their upstreams."""
        wanted = set(self.models)
        if select:
            wanted = {n for n, m in self.models.items() if n in select or set(m.tags) & set(select)}
        seen: list[str] = []
        visiting: set[str] = set()

        def visit(n: str):
            if n in seen or n not in self.models:
                return
            if n in visiting:
                raise ValueError(f"dependency cycle at {n}")
            visiting.add(n)
            for up in self.models[n].inputs:
                visit(up)
            visiting.discard(n)
            seen.append(n)

        for n in sorted(wanted):
            visit(n)
        return seen

    def run(self, spark: SparkSession, sources: dict[str, DataFrame], select: Sequence[str] | None = None,
            full_refresh: bool = False) -> dict[str, DataFrame]:
        """Build every selected model; views stay lazy, tables are written."""
        frames = dict(sources)
        for name in self.order(select):
            m = self.models[name]
            df = m.build(*[frames[i] for i in m.inputs])
            if m.materialized == "view":
                frames[name] = df
                df.createOrReplaceTempView(name)
                continue
            path = self.path(m)
            if m.materialized == "table":
                df.write.mode("overwrite").parquet(path)
            elif m.materialized == "incremental":
                exists = keep.path_exists(spark, path)
                if exists and not full_refresh and m.inserted_col in df.columns:
                    target = spark.read.parquet(path)
                    df = keep.incremental_filter(df, target, m.inserted_col, m.updated_col)
                keep.merge_into_path(spark, df, path, list(m.unique_key), full_refresh=full_refresh or not exists,
                                     partition_by=list(m.partition_by), updated_col=m.updated_col if m.stamp else None)
            else:
                raise ValueError(f"unknown materialization {m.materialized!r}")
            frames[name] = spark.read.parquet(path)
            frames[name].createOrReplaceTempView(name)
        return frames


def global_high_water(df: DataFrame, col: str = "_dp_inserted_at", name: str = "max__dp_inserted_at") -> DataFrame:
    """The source's global ``max(col)`` on every row (scalar subquery)."""
    return df.withColumn(name, df.select(F.max(col)).scalar())
