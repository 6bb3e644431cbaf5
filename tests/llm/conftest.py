import pytest

CLASHING = {
    "size": 1, "taken": 2, "row": 3, "key": "k", "fp": 4, "slot": 5, "shard": 6, "host": "h", "target": True,
    "lines": "l", "hash": 7, "kept": "x", "n": 8, "digest": "d", "root": 9, "bucket": 10,
    "__id": 11, "__hash": "i", "__host": 12, "__slot": 13, "__size": "j", "__taken": 14, "__text_hash": 15, "__nth": "k",
    "__block": 16, "__source": 17, "phrase": "p", "f": 18, "rank": 19, "score": 20, "item": 21, "terms": "t", "ids": "u",
    "decoded": "v", "a": 22, "l": 23, "r": 24,
}


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls everywhere, empty, blank and very long texts, repeated rows, columns with clashing names."""
    from pyspark.sql import functions as F

    long = " ".join(f"w{i % 9973}x{i}" for i in range(60_000))
    rows = [
        (0, None, "en", "a", 0),
        (1, "", "en", "a", 0),
        (2, " \t\n ", None, None, 3),
        (None, "one two three", "en", None, 13),
        (None, None, None, None, None),
        (3, long, "en", "a", len(long)),
        (4, "same words here again and again", "en", "b", 31),
        (4, "same words here again and again", "en", "b", 31),
        (5, "x" * 300_000, "en", "b", 300_000),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.select("*", *[F.lit(v).alias(k) for k, v in CLASHING.items()]).cache()


@pytest.fixture(scope="session")
def documents(spark, sf_small):
    return spark.read.parquet(f"{sf_small}/documents.parquet")
