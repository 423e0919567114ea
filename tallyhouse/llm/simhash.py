"""SimHash near-duplicates through pivot distance tables.

A fingerprint's row in the table holds its Hamming distances to `PIVOTS` reference fingerprints, block by block (four
blocks of 16 bits). The distance to a pivot is the sum over the blocks, and by the triangle inequality fingerprints at
most r bits apart differ by at most r in every such coordinate. With r = 2, two of the four blocks agree as well, so
all coordinates of those two blocks agree: pairs of blocks' coordinate rows are the keys under which candidates meet
(six keys a fingerprint, no pair of texts that links is missed). Candidates whose largest coordinate difference exceeds r are
discarded; what survives is compared bit by bit.

Documents with one fingerprint are one class before any of this. Where more than `SMALL` classes meet under a key, none of
their pairs is formed: each class is listed under itself and its one-bit changes in the free blocks, and two
fingerprints share such a listing exactly if they are at most two bits apart; a listing has at most 33 members.

Defined results: null and wordless texts have fingerprint zero and link like any other; null doc_ids keep their rows and
are never a component's id unless all its rows have none; equal rows give equal rows; empty tables work; other columns
are ignored by `groups` and kept by `keep_one`, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.chunks import word_chunks
from tallyhouse.llm.components import components
from tallyhouse.llm.shared import stored

BITS, BLOCKS, PIVOTS, MAX_BITS = 64, 4, 24, 2
#: Buckets of up to so many classes are compared pair by pair.
SMALL = 50

_random = np.random.default_rng(20240229)
_PIVOTS = _random.integers(0, 1 << 64, PIVOTS, dtype=np.uint64)
_MASKS = np.array([((1 << 16) - 1) << (16 * b) for b in range(BLOCKS)], dtype=np.uint64)
#: Odd factors that hash rows of coordinates to 64 bits; equal rows have equal hashes.
_FACTORS = _random.integers(0, 1 << 63, (BLOCKS, PIVOTS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def fingerprint(text: str | None, words: int = 3) -> int:
    """Bits that are set in more than half of the hashes of all shingles of `words` words, A-Z folded; no words: 0."""
    total, counts = 0, np.zeros(BITS, dtype=np.int64)
    first = True
    for found in word_chunks((text or "").encode().lower(), words - 1):
        if not found or (len(found) < words and not first):
            continue
        n = max(1, len(found) - words + 1)
        joined = b" ".join(found)
        ends = np.cumsum([len(w) + 1 for w in found])
        starts = np.concatenate(([0], ends))[:n].tolist()
        stops = (ends[min(words, len(found)) - 1 :] - 1).tolist()
        digest = xxhash.xxh64_intdigest
        hashes = np.array([digest(joined[a:b], 42) for a, b in zip(starts, stops, strict=True)], dtype="<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        total, first = total + n, False
    return int(np.packbits(2 * counts > total, bitorder="little").view("<u8")[0]) if total else 0


def _fingerprints(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t.as_py(), words) for t in batch["text"]], dtype=np.uint64)
            yield batch.drop_columns(["text"]).append_column("fp", pa.array(prints.view(np.int64)))

    return run


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """doc_id, text_hash, fp (the 64 bits as a long), one row per document."""
    rows = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), "text")
    schema = rows.drop("text").withColumn("fp", F.lit(0).cast("long")).schema
    return rows.mapInArrow(_fingerprints(words), schema)


def _coordinates(prints: np.ndarray) -> np.ndarray:
    """Distances to the pivots by block: (fingerprints, blocks, pivots)."""
    return np.bitwise_count((prints[:, None, None] ^ _PIVOTS[None, None, :]) & _MASKS[None, :, None])


def _bucket_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = batch["fp"].to_numpy(zero_copy_only=False).view(np.uint64)
        rows = (_coordinates(prints).astype(np.uint64) * _FACTORS).sum(axis=2, dtype=np.uint64)
        for which, (a, b) in enumerate(combinations(range(BLOCKS), 2)):
            key = rows[:, a] * np.uint64(0x9E3779B97F4A7C15) + rows[:, b] + np.uint64(which)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.view(np.int64)), pa.array(np.full(len(key), which, np.int32)), batch["fp"]], names=["key", "which", "fp"]
            )


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links within small buckets: at most one fewer than members, with the same components as all links."""
    for batch in batches:
        a, b = [], []
        for members in batch["fps"]:
            prints = np.sort(members.values.to_numpy(zero_copy_only=False).view(np.uint64))
            table = _coordinates(prints).sum(axis=1, dtype=np.int16)
            group = list(range(len(prints)))
            for i in range(1, len(prints)):
                apart = np.abs(table[:i] - table[i]).max(axis=1)
                survivors = np.flatnonzero(apart <= MAX_BITS)
                linked = survivors[np.bitwise_count(prints[survivors] ^ prints[i]) <= MAX_BITS]
                for j in linked:
                    if group[j] != group[i]:
                        a.append(prints[i])
                        b.append(prints[j])
                        old, new = max(group[i], group[j]), min(group[i], group[j])
                        group = [new if g == old else g for g in group]
        ends = [pa.array(np.array(x, dtype=np.uint64).view(np.int64)) for x in (a, b)]
        yield pa.RecordBatch.from_arrays(ends, names=["a", "b"])


def links(classes: DataFrame) -> DataFrame:
    """(a, b): links between distinct fingerprints `fp` with the components that all pairs at most MAX_BITS apart have."""
    keys = stored(classes.select("fp").mapInArrow(_bucket_keys, "key long, which int, fp long"), "pivot-keys")
    sizes = keys.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    met = keys.join(sizes, "key")
    small = met.filter(F.col("n") <= SMALL).groupBy("key").agg(F.collect_list("fp").alias("fps"))
    few = small.select("fps").mapInArrow(_compare, "a long, b long")
    # A crowded bucket: its members agree in two blocks, so they differ in the bits of the other two.
    free = F.lit(None)
    for which, fixed in enumerate(combinations(range(BLOCKS), 2)):
        bits = [1 << i if i < 63 else -(1 << 63) for b in range(BLOCKS) if b not in fixed for i in range(16 * b, 16 * b + 16)]
        free = F.when(F.col("which") == which, F.array(F.lit(0).cast("long"), *[F.lit(x).cast("long") for x in bits])).otherwise(free)
    crowded = met.filter(F.col("n") > SMALL).select("which", "key", "fp", F.explode(free).alias("bit"))
    listed = crowded.groupBy("which", "key", F.col("fp").bitwiseXOR(F.col("bit")).alias("near")).agg(F.collect_list("fp").alias("fps"))
    many = listed.filter(F.size("fps") > 1).select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).filter("a != b")
    return few.unionByName(many)


def _rooted(prints: DataFrame) -> DataFrame:
    """(fp, root): the component of every distinct fingerprint, named by one of them."""
    classes = stored(prints.select("fp").distinct(), "simhash-classes")
    found = components(links(classes)).toDF("fp", "root")
    return classes.join(found, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def groups(docs: DataFrame, words: int = 3) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable), one row per document."""
    prints = stored(fingerprints(docs, words), "simhash")
    first = prints.groupBy("fp").agg(F.min("doc_id").alias("first")).join(_rooted(prints), "fp")
    named = stored(first.select("fp", "root", "first"), "simhash-roots")
    ids = named.groupBy("root").agg(F.min("first").alias("component_id"))
    by_print = named.join(ids, "root").select("fp", "component_id")
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return prints.join(by_print, "fp").select("doc_id", hexed.alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, words: int = 3) -> DataFrame:
    """One document of each component, with all its columns: the smallest doc_id (nulls last), of equal rows one."""
    prints = stored(fingerprints(docs, words), "simhash")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    rooted = prints.join(_rooted(prints), "fp")
    stays = rooted.groupBy("root").agg(F.min(order).alias("s")).select("s.doc_id", "s.text_hash")
    same = Window.partitionBy("d.doc_id", "text_hash").orderBy(F.lit(0))
    hashed = docs.select(F.struct("*").alias("d"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"))
    on = hashed["d.doc_id"].eqNullSafe(stays["doc_id"]) & (hashed["text_hash"] == stays["text_hash"])
    kept = hashed.join(stays, on, "left_semi")
    return kept.withColumn("copy", F.row_number().over(same)).filter("copy = 1").select("d.*")
