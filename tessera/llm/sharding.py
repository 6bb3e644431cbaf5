"""Shard placement through a permutation-filled lookup table (operator 7).

Every shard has its own permutation of the slots of a prime-sized table and
the shards take turns claiming their next free slot.  The table gives each
shard an equal share (within one slot) and moves few keys when a shard
joins or leaves.  A row's slot is its key's hash modulo the table size; the
table's ``table_size`` rows are the proven bound of the broadcast.

Defined results: a null key is a key like any other (all null keys share a
shard); repeated rows go to the same shard; an empty table gives an empty
result; input columns named ``slot`` or ``shard`` are replaced; texts are
never looked at, so their length does not matter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import free_names

SHARDS, TABLE_SIZE = 64, 65_537


def lookup_table(names: list[str], size: int = TABLE_SIZE) -> np.ndarray:
    """Slot -> index into ``names``; ``size`` must be a prime of at least the number of names."""
    if size < 2 or any(size % d == 0 for d in range(2, int(size**0.5) + 1)):
        raise ValueError("the table size must be a prime")
    if not names or len(names) > size or len(set(names)) < len(names):
        raise ValueError("between 1 and table-size different shard names are needed")
    start = [xxhash.xxh64_intdigest(n, 1) % size for n in names]
    skip = [xxhash.xxh64_intdigest(n, 2) % (size - 1) + 1 for n in names]
    taken = np.full(size, -1, np.int32)
    nxt, left = list(start), size
    while left:
        for i in range(len(names)):
            while taken[nxt[i]] >= 0:
                nxt[i] = (nxt[i] + skip[i]) % size
            taken[nxt[i]] = i
            left -= 1
            if not left:
                break
    return taken


def place(df: DataFrame, key: str = "doc_id", shards: int = SHARDS, size: int = TABLE_SIZE) -> DataFrame:
    """``df`` with ``slot`` and ``shard`` (int): one map-side lookup per row, no shuffle of ``df``."""
    names = [f"shard-{i:05d}" for i in range(shards)]
    kept = df.drop("slot", "shard")
    (own,) = free_names(kept.columns, "__slot")
    filled = pa.table({own: np.arange(size, dtype=np.int64), "shard": lookup_table(names, size)})
    slots = F.broadcast(df.sparkSession.createDataFrame(filled))  # ``size`` rows, fixed by the parameter
    keyed = kept.withColumn(own, F.pmod(F.xxhash64(F.col(key)), F.lit(size)))
    return keyed.join(slots, own).select(*kept.columns, F.col(own).alias("slot"), "shard")
