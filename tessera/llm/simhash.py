"""SimHash near-duplicate groups through pivot distance tables (operator 6).

Fingerprints: 64 bits over 3-word shingles (XXH64, seed 42); a bit is set if
more than half of the shingles' hashes set it.  Equal fingerprints are one
class from the start, so copies never meet as pairs.

Search: ``PIVOTS`` reference fingerprints; the table holds, for every byte of a
fingerprint, its Hamming distance to that byte of each reference, and the
coordinates over a set of bytes are sums of rows of the table.  Two
fingerprints within two bits agree in at least six of eight bytes, so in one
of the 28 six-byte sets all their coordinates are equal: a class is looked up
under the digest of its coordinates in each set.  In a looked-up group the
pairs whose full coordinates differ by more than the radius anywhere are
discarded, the rest are verified bit by bit.  A group's members differ in two
bytes only, so it holds at most 65,536 classes whatever the data, and it
gives one link per member to its first linked member, never all pairs.

Components: links are joined up by alternating neighbour minima on classes,
each round written to the shared checkpoint folder.

Defined results: a null, empty or wordless text has fingerprint zero and links
like any other; a null id never becomes a component id unless its component
has no other id (then null); every input row gives one row; texts of any length
are hashed whole; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import free_names, slices, staged

#: Contract: words of a shingle, most differing bits, seed of the shingle hash.
SHINGLE, RADIUS, SEED = 3, 2, 42
PIVOTS = 32
_ROWS = 1 << 16


def shingle_hashes(text: bytes, size: int = SHINGLE) -> list[int]:
    words = text.lower().split()  # on bytes: lower-cases A-Z only, splits on the six ASCII white-space characters
    if not words:
        return []
    if len(words) <= size:
        return [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    runs = map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False))
    return [xxhash.xxh64_intdigest(r, SEED) for r in runs]


def fingerprints(texts: list[bytes], size: int = SHINGLE) -> np.ndarray:
    """uint64 fingerprint of each text."""
    out = np.zeros(len(texts), np.uint64)
    for i, text in enumerate(texts):
        hashes = np.array(shingle_hashes(text, size), np.uint64)
        if not len(hashes):
            continue
        ones = np.zeros(64, np.int64)
        for at in range(0, len(hashes), _ROWS):
            part = hashes[at : at + _ROWS].view(np.uint8).reshape(-1, 8)
            ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
        out[i] = np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0]
    return out


def with_fingerprint(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """documents -> doc_id, text_hash, fp (the fingerprint as a signed long)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or b"" for t in batch.column("text").to_pylist()]
            parts = [fingerprints(texts[a:b], size) for a, b in slices(texts)]
            fps = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(fps.view(np.int64))],
                names=["doc_id", "text_hash", "fp"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    read = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.col("text").cast("binary").alias("text"))
    return read.mapInArrow(run, f"doc_id {kind}, text_hash long, fp long")


# ---- pivot tables ----------------------------------------------------------------------------------------------

_BITS = np.array([bin(v).count("1") for v in range(256)], np.int16)


def references(count: int = PIVOTS) -> np.ndarray:
    """Reference fingerprints as bytes (count, 8): digests of their numbers."""
    digests = [xxhash.xxh64_digest(str(i).encode(), SEED) for i in range(count)]
    return np.frombuffer(b"".join(digests), np.uint8).reshape(count, 8)


def distance_table(count: int = PIVOTS) -> np.ndarray:
    """(byte position, byte value, reference) -> Hamming distance inside that byte."""
    refs = references(count)
    return _BITS[np.arange(256, dtype=np.uint8)[None, :, None] ^ refs.T[:, None, :]]


def coordinates(fps: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Distances (fingerprint, byte position, reference); summed over positions they are full distances."""
    return table[np.arange(8), fps.view(np.uint8).reshape(-1, 8)]


def lookup_keys(fps: np.ndarray, table: np.ndarray) -> np.ndarray:
    """(fingerprint, 28) digests of the coordinates over each six-byte set."""
    weights = np.array([xxhash.xxh64_intdigest(str(i).encode(), 7) | 1 for i in range(table.shape[2])], np.uint64)
    with np.errstate(over="ignore"):
        per_byte = (coordinates(fps, table).astype(np.uint64) * weights).sum(2, dtype=np.uint64)
        whole = per_byte.sum(1, dtype=np.uint64)
        keys = [
            (whole - per_byte[:, a] - per_byte[:, b]) ^ np.uint64(xxhash.xxh64_intdigest(f"{a},{b}".encode(), 7))
            for a, b in combinations(range(8), 2)
        ]
    return np.stack(keys, 1)


def group_links(members: np.ndarray, table: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """One link per member of a looked-up group to an earlier member within the radius, enough to join all such pairs."""
    full = coordinates(members, table).sum(1, dtype=np.int16)
    root = np.arange(len(members))
    links = []
    for i in range(1, len(members)):
        near = np.flatnonzero(np.abs(full[:i] - full[i]).max(1) <= radius)
        if not len(near):
            continue
        near = near[_BITS[(members[near] ^ members[i])[:, None].view(np.uint8)].sum(1) <= radius]
        for r in np.unique(root[near]).tolist():  # one link to each group of earlier members that this one joins
            links.append((int(members[i]), int(members[near[root[near] == r][0]])))
            root[root == r] = i
        root[i] = i
    return links


def links(classes: DataFrame, radius: int = RADIUS, pivots: int = PIVOTS) -> DataFrame:
    """Distinct fingerprints (fp long) -> links (a, b) that join all pairs within ``radius`` (at most 2) bits."""
    if not 0 <= radius <= 2:
        raise ValueError("six-byte sets cover a radius of two bits at most")

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = distance_table(pivots)
        for batch in batches:
            fps = np.ascontiguousarray(batch.column("fp").to_numpy(zero_copy_only=False).astype(np.int64)).view(np.uint64)
            for at in range(0, len(fps), _ROWS >> 4):
                part = fps[at : at + (_ROWS >> 4)]
                keys = lookup_keys(part, table)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.ravel().view(np.int64)), pa.array(np.repeat(part, keys.shape[1]).view(np.int64))],
                    names=["key", "fp"],
                )

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = distance_table(pivots)
        for batch in batches:
            found = []
            for group in batch.column("fps"):
                members = np.sort(np.array(group.as_py(), np.int64)).view(np.uint64)
                found += group_links(members, table, radius)
            pairs = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], names=["a", "b"])

    groups = (
        classes.select("fp").mapInArrow(spread, "key long, fp long")
        .groupBy("key").agg(F.collect_list("fp").alias("fps"))  # at most 65,536 by construction
        .filter(F.size("fps") > 1)
    )
    return groups.select("fps").mapInArrow(verify, "a long, b long").distinct()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(a, b) long edges -> (node, root): root is the smallest node of the component.

    Large-star and small-star rounds: every neighbour above a node is moved to
    the node's smallest neighbour, then every neighbour below likewise.  The
    rounds end when the edges no longer change, after about the logarithm of
    the longest chain.
    """
    tidy = lambda df: df.filter("a != b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    ).distinct()
    edges = staged(tidy(edges), name)
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # written, so that the joins below are plain ones and Spark may split a hot node
        low = staged(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low")), name)
        # large star: neighbours above a node link to the node's minimum
        large = both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        edges = staged(tidy(large), name)
        # small star: a node and its neighbours below link to the smallest of them
        low = staged(edges.groupBy("a").agg(F.min("b").alias("low")), name)
        small = edges.join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        edges = staged(tidy(small.unionByName(low.select("a", F.col("low").alias("b")))), name)
        state = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).first()
        if state == seen:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = state


def _grouped(docs: DataFrame, size: int, radius: int) -> DataFrame:
    """doc_id, text_hash, fp, root (a fingerprint that names the component), component_id."""
    hashed = staged(with_fingerprint(docs, size), "simhash")
    classes = staged(hashed.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-classes")
    roots = components(links(classes, radius), "simhash-links")
    rooted = classes.join(roots, classes.fp == roots.node, "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    smallest = staged(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "simhash-ids")
    return hashed.join(rooted.join(smallest, "root").select("fp", "root", "component_id"), "fp")


def near_duplicates(docs: DataFrame, size: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """documents -> doc_id, fingerprint, component_id, one row per input row."""
    return _grouped(docs, size, radius).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_per_group(docs: DataFrame, size: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row of each group, with all its columns: the one with the smallest id (then text hash); null ids come last."""
    first = _grouped(docs, size, radius).groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("k")
    )
    own_id, own_hash, text_hash, place = free_names(docs.columns, "__id", "__hash", "__text_hash", "__nth")
    first = first.select(F.col("k.doc_id").alias(own_id), F.col("k.text_hash").alias(own_hash)).distinct()
    hashed = docs.withColumn(text_hash, F.xxhash64("text"))
    same = hashed.doc_id.eqNullSafe(F.col(own_id)) & (hashed[text_hash] == F.col(own_hash))
    rest = [F.xxhash64(*docs.columns)]
    nth = F.row_number().over(Window.partitionBy("doc_id", text_hash).orderBy(*rest))
    kept = hashed.join(first, same, "left_semi").withColumn(place, nth)
    return kept.filter(F.col(place) == 1).select(*docs.columns)
