"""S23 table source by logical name.

Tables are read lazily with ``spark.read.parquet`` so Catalyst prunes
columns and pushes filters into the scan; nothing is cached here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TEST_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one logical table from a directory of ``{name}.parquet`` files."""
    if name not in TEST_TABLES:
        raise KeyError(f"unknown table {name!r}; known: {', '.join(TEST_TABLES)}")
    return spark.read.parquet(table_path(sf_dir, name))


class Tables:
    """Attribute access to the registry: ``Tables(spark, d).lineitem``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        # dates are taken from UTC instants, as in the source models; a session
        # created elsewhere (a driver, a notebook) may carry a local zone
        if spark.conf.get("spark.sql.session.timeZone", "UTC") != "UTC":
            spark.conf.set("spark.sql.session.timeZone", "UTC")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return read_table(self.spark, self.sf_dir, name)

    def bytes_of(self, name: str) -> int:
        """Bytes of a table's files."""
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table_path(self.sf_dir, name))
        fs = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return fs.getContentSummary(path).getLength()

    def register_views(self, names=TEST_TABLES) -> None:
        for n in names:
            read_table(self.spark, self.sf_dir, n).createOrReplaceTempView(n)
