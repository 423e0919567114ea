"""Exact repeats of `LENGTH` bytes or more, through a sparse enhanced suffix array with its common-prefix interval tree.

Which suffixes meet. Every window of LENGTH bytes chooses an anchor, the 32 bytes in it with the smallest hash (the
rightmost of equals), so equal windows choose equal anchors at equal places. Consecutive windows with one anchor form a run; an
anchor's occurrence stands for its run and the bytes of it, about one per 85 bytes. All suffixes that can begin a common window
thus meet under an anchor's hash, aligned, and nothing else has to be compared or moved.

Where few occurrences meet (up to `CROWDED`): their suffixes from the anchor on are sorted with their common prefixes; a stack
scan of these gives the intervals of the common-prefix tree; within an interval of depth r the texts before the anchor,
read backwards, are arranged the same way, and an interval of depth l there is a maximal repeat (l + r bytes) with all
its occurrences if its members don't all go on alike to the right (else a deeper interval has it); to the left its members diverge by
construction. Windows inside any such repeat are covered.

Where many meet nothing collects the group; hashes are counted in Spark like any other key. Occurrences of equal bytes are
counted by (anchor, hash of the bytes). Those that remain alone are taken apart into blocks of `BLOCK` windows. All windows of
a block contain its core, so a block whose core nobody else has needs no further look (the text beside a common passage);
of the others, blocks that two have are covered whole, and only the rest is compared window by window.

Plan: pass 1 counts anchors (hash, count, least and greatest hash of the run's bytes). From the anchors seen twice, three
Bloom filters of bounded size say in pass 2 which occurrences to send and by which route; a filter's false hit sends a row too
many and changes no result. The texts are read twice and moved once, to have the covered bytes removed.

Defined results: a null text counts as empty; texts under LENGTH bytes have no spans; copies of a text of LENGTH bytes or more
lose everything; equal rows give equal rows; empty tables work; other columns are ignored. Hashes: 64 bits for anchors,
64 more for bytes, 128 for whole texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.shared import stored

LENGTH, GRAM, CROWDED, BLOCK = 200, 32, 50, 8
#: Bytes of a text taken at a time; places in a piece fit into PLACE bits.
PIECE, PLACE = 1 << 20, 24
#: Rows and bytes handed on at a time, and kinds remembered, by a task of the second pass.
SENT_ROWS, SENT_BYTES, HELD = 10_000, 1 << 22, 200_000
#: Kinds of crowded anchors that occur twice are broadcast up to so many (16 bytes each), beyond that joined.
BROADCAST_KINDS = 500_000
#: Bits of a filter: 16 for each hash, within these bounds (32 MB at most).
LEAST_BITS, MOST_BITS, PROBES = 1 << 16, 1 << 28, 3
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


class _Powers:
    """Powers of the base and its inverse modulo 2**64, grown on demand."""

    def __init__(self):
        self.up = self.down = np.ones(0, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            for name, base in (("up", _BASE), ("down", _INVERSE)):
                factors = np.full(size, base, np.uint64)
                factors[0] = 1
                setattr(self, name, np.cumprod(factors))
        return self.up[:n], self.down[:n]


def _gram_hashes(data: np.ndarray, powers: _Powers) -> np.ndarray:
    """Mixed polynomial hashes of all GRAM-byte strings."""
    up, down = powers.get(len(data))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up)))
    h = (sums[GRAM:] - sums[:-GRAM]) * down[: len(data) - GRAM + 1]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def _sliding_least(a: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while 2 * span <= width:
        a = np.minimum(a[:-span], a[span:])
        span *= 2
    rest = width - span
    return np.minimum(a[: len(a) - rest], a[rest:]) if rest else a


def anchors(text: bytes, powers: _Powers, length: int = LENGTH) -> Iterator[tuple[int, int, int, int]]:
    """(hash, place, first window, last window) of every run, left to right."""
    for start in range(0, max(0, len(text) - length + 1), PIECE):
        data = np.frombuffer(text, np.uint8, min(PIECE + length - 1, len(text) - start), start)
        h = _gram_hashes(data, powers)
        low = np.uint64((1 << PLACE) - 1)
        places = np.arange(len(h), dtype=np.uint64)
        least = _sliding_least((h & ~low) | (low - places), length - GRAM + 1)
        chosen = (low - (least & low)).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], chosen[1:] != chosen[:-1])))
        last = np.concatenate((first[1:] - 1, [len(chosen) - 1]))
        at = chosen[first]
        yield from zip(h[at].view(np.int64).tolist(), (at + start).tolist(), (first + start).tolist(), (last + start).tolist(), strict=True)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _count_pass(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, digest = _Powers(), xxhash.xxh64_intdigest
        for batch in batches:
            hashes, runs = [], []
            for value in batch["text"]:
                text = (value.as_py() or "").encode()
                for h, _, lo, hi in anchors(text, powers, length):
                    hashes.append(h)
                    runs.append(digest(text[lo : hi + length]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes, pa.int64()), pa.array(np.array(runs, dtype=np.uint64).view(np.int64))], names=["h", "run"]
            )

    return run


class Filter:
    """A Bloom filter over 64-bit hashes."""

    def __init__(self, words: np.ndarray):
        self.words, self.bits = words, len(words) * 64

    def has(self, h: int) -> bool:
        h &= (1 << 64) - 1
        a, b = h & 0xFFFFFFFF, (h >> 32) | 1
        for i in range(PROBES):
            bit = (a + i * b) % self.bits
            if not int(self.words[bit >> 6]) >> (bit & 63) & 1:
                return False
        return True


def _filter_of(hashes: DataFrame, n: int) -> Filter:
    """The filter of all rows h, put together by Spark; at most MOST_BITS / 64 words come to the driver."""
    bits = LEAST_BITS
    while bits < 16 * n and bits < MOST_BITS:
        bits *= 2
    a, b = F.col("h").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned("h", 32).bitwiseOR(F.lit(1))
    probes = F.explode(F.array(*[(a + F.lit(i).cast("long") * b) % F.lit(bits).cast("long") for i in range(PROBES)]))
    set_bits = hashes.select(probes.alias("bit"))
    words = set_bits.groupBy(F.shiftright("bit", 6).alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(bit & 63 AS INT)))").alias("value"))
    found = words.toArrow()
    out = np.zeros(bits // 64, np.uint64)
    out[found["word"].to_numpy()] = found["value"].to_numpy().view(np.uint64)
    return Filter(out)


#: What is sent: an occurrence where few meet, one where many meet, and a block of windows of the latter.
FEW, MANY, PART = 0, 1, 2
_SENT = (
    "route int, h long, run long, a long, b long, place int, lo int, hi int, bytes binary, core long, full long, windows array<long>"
)


def _send_pass(filters, length: int):
    """Occurrences of anchors that were seen twice; where their runs differ, with their bytes or their blocks of windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, differing, crowded = (Filter(w) for w in filters.value)
        powers, digest = _Powers(), xxhash.xxh64_intdigest
        schema = pa.schema([
            ("route", pa.int32()), ("h", pa.int64()), ("run", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("place", pa.int32()),
            ("lo", pa.int32()), ("hi", pa.int32()), ("bytes", pa.binary()), ("core", pa.int64()), ("full", pa.int64()),
            ("windows", pa.list_(pa.int64())),
        ])
        brought: set[tuple[int, int]] = set()
        for batch in batches:
            rows, held = [], 0
            for value, a, b in zip(batch["text"], batch["a"].to_pylist(), batch["b"].to_pylist(), strict=True):
                text = (value.as_py() or "").encode()
                for h, place, lo, hi in anchors(text, powers, length):
                    if not seen.has(h):
                        continue
                    part, route = text[lo : hi + length], MANY if crowded.has(h) else FEW
                    kind = (h, _signed(digest(part)))
                    # Of equal runs in a task one brings the bytes or the blocks.
                    brings = differing.has(h) and kind not in brought
                    rows.append((route, *kind, a, b, place, lo, hi, part if brings and route == FEW else None, None, None, None))
                    if not brings:
                        continue
                    brought.add(kind)
                    held += len(part)
                    # Blocks begin at equal distances from the anchor, so that equal windows lie in equal blocks.
                    for at in range((lo - place) // BLOCK, (hi - place) // BLOCK + 1) if route == MANY else ():
                        start = place + at * BLOCK
                        first, last = max(lo, start), min(hi, start + BLOCK - 1)
                        windows = [_signed(digest(text[i : i + length])) for i in range(first, last + 1)]
                        core, full = text[start + BLOCK - 1 : start + length], text[first : last + length]
                        rows.append((PART, *kind, a, b, place, first, last, None, _signed(digest(core)), _signed(digest(full)), windows))
                        held += 8 * len(windows)
                    if len(rows) >= SENT_ROWS or held >= SENT_BYTES:
                        yield _batch(rows, schema)
                        rows, held = [], 0
                if len(brought) > HELD:
                    brought.clear()
            yield _batch(rows, schema)

    return run


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


def _common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    lo, hi = 0, n  # a[:lo] == b[:lo], a[:hi] != b[:hi]
    while hi - lo > 1:
        mid = (lo + hi) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo


def _intervals(depths: list[int]) -> Iterator[tuple[int, int, int]]:
    """(depth, first, last) of the common-prefix tree's intervals, by a stack scan.

    depths[i] is the common prefix of the sorted strings i and i + 1.
    """
    stack: list[tuple[int, int]] = []
    for i, depth in enumerate([*depths, -1]):
        first = i
        while stack and stack[-1][0] > depth:
            d, first = stack.pop()
            yield d, first, i
        if not stack or stack[-1][0] < depth:
            stack.append((depth, first))


def maximal_repeats(before: list[bytes], after: list[bytes], length: int = LENGTH) -> Iterator[tuple[int, int, list[int]]]:
    """(left, right, members) of the maximal repeats of `length` bytes or more among strings aligned at an anchor.

    before: the bytes before the anchor, reversed; after: the bytes from the anchor on; no two strings alike in both.
    """
    order = sorted(range(len(after)), key=after.__getitem__)
    depths = [_common(after[i], after[j]) for i, j in zip(order, order[1:], strict=False)]
    reach = max(map(len, before), default=0)
    for right, first, last in _intervals(depths):
        if right + reach < length:
            continue
        # Which branch of the interval a member lies in: branches are parted where the common prefix is just `right`.
        branch, number = {order[first]: 0}, 0
        for i in range(first, last):
            number += depths[i] == right
            branch[order[i + 1]] = number
        members = sorted(branch, key=before.__getitem__)
        lefts = [_common(before[i], before[j]) for i, j in zip(members, members[1:], strict=False)]
        for left, a, b in _intervals(lefts):
            group = members[a : b + 1]
            if left + right >= length and len({branch[i] for i in group}) > 1:
                yield left, right, group


def _compare_pass(length: int):
    """Covered windows (a, b, lo, hi) of occurrences that arrive sorted by anchor, at most CROWDED of an anchor."""

    def of_group(rows: list[tuple]) -> Iterator[tuple]:
        kinds: dict[int, list[tuple]] = {}
        for r in rows:
            kinds.setdefault(r[1], []).append(r)
        alone = [k for k, same in kinds.items() if len(same) == 1]
        for same in kinds.values():
            if len(same) > 1:
                yield from ((a, b, lo, hi) for _, _, a, b, _, lo, hi, _ in same)
        if len(kinds) < 2 or not alone:
            return
        found = [next(r for r in same if r[7] is not None) for same in kinds.values()]
        before = [r[7][: r[4] - r[5]][::-1] for r in found]
        after = [r[7][r[4] - r[5] :] for r in found]
        for left, right, members in maximal_repeats(before, after, length):
            for i in members:
                _, run, a, b, place, lo, hi, _ = found[i]
                first, last = max(lo, place - left), min(hi, place + right - length)
                if len(kinds[run]) == 1 and first <= last:
                    yield a, b, first, last

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*[c.to_pylist() for c in batch.columns], strict=True)

        schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32())])
        out: list[tuple] = []
        for _, group in groupby(rows(), key=itemgetter(0)):
            out.extend(of_group(list(group)))
            if len(out) >= 20_000:
                yield _batch(out, schema)
                out = []
        yield _batch(out, schema)

    return run


def covered(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(a, b, lo, hi): first bytes lo to hi of windows of text (a, b) that occur elsewhere; ranges may touch or repeat."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("text", F.xxhash64(text).alias("a"), F.xxhash64(F.lit(1), text).alias("b")).filter(F.octet_length("text") >= length)
    counts = rows.select("text").mapInArrow(_count_pass(length), "h long, run long")
    twice = counts.groupBy("h").agg(F.count("*").alias("n"), F.min("run").alias("least"), F.max("run").alias("most")).filter("n > 1")
    twice = stored(twice.select("h", (F.col("least") != F.col("most")).alias("differ"), (F.col("n") > CROWDED).alias("crowded")), "anchors")
    n, n_differ, n_crowded = twice.agg(F.count("*"), F.count_if("differ"), F.count_if("crowded")).first()
    hashes = twice.select("h")
    filters = spark.sparkContext.broadcast([
        _filter_of(hashes, n).words,
        _filter_of(twice.filter("differ").select("h"), n_differ).words,
        _filter_of(twice.filter("crowded").select("h"), n_crowded).words,
    ])
    sent = stored(rows.mapInArrow(_send_pass(filters, length), _SENT), "occurrences")

    few = sent.filter(F.col("route") == FEW).select("h", "run", "a", "b", "place", "lo", "hi", "bytes")
    few = few.repartition("h").sortWithinPartitions("h").mapInArrow(_compare_pass(length), "a long, b long, lo int, hi int")

    many = sent.filter(F.col("route") == MANY).select("h", "run", "a", "b", "lo", "hi")
    kinds = stored(many.groupBy("h", "run").agg(F.count("*").alias("n")).filter("n > 1").select("h", "run"), "crowded-kinds")
    # A run may occur in a third of all texts; with the kinds in every task its rows need not meet.
    kinds = F.broadcast(kinds) if kinds.count() <= BROADCAST_KINDS else kinds
    alike = many.join(kinds, ["h", "run"]).select("a", "b", "lo", "hi")
    return few.unionByName(alike).unionByName(_of_blocks(sent.filter(F.col("route") == PART)))


def _shared(rows: DataFrame, keys: list[str], by: str) -> DataFrame:
    """The keys under which two different values of `by` occur."""
    return rows.groupBy(*keys).agg(F.min(by).alias("one"), F.max(by).alias("other")).filter("one != other").select(*keys)


def _of_blocks(parts: DataFrame) -> DataFrame:
    """Covered windows (a, b, lo, hi) of runs that occur once, from their blocks.

    Of a run that occurs more often some occurrence's windows come along; they are covered as well.
    """
    parts = parts.withColumn("from", F.col("lo") - F.col("place")).withColumn("block", F.floor(F.col("from") / BLOCK))
    at_core = ["h", "block", "core"]
    met = stored(parts.join(_shared(parts, at_core, "run"), at_core).select("h", "run", "a", "b", "from", "lo", "hi", "full", "windows"), "met-blocks")
    whole = ["h", "from", "full"]
    twice = stored(_shared(met, whole, "run"), "shared-blocks")
    covered_blocks = met.join(twice, whole).select("a", "b", "lo", "hi")
    kinds = met.groupBy(*whole).agg(F.first("windows").alias("windows"))
    at = (F.col("from") + F.col("i")).alias("at")
    windows = kinds.select("h", "from", "full", F.posexplode("windows").alias("i", "w")).select("h", at, "w", F.xxhash64("from", "full").alias("kind"))
    single = met.join(twice, whole, "left_anti").select("h", "a", "b", "lo", "from", F.posexplode("windows").alias("i", "w"))
    found = single.withColumn("at", at).join(_shared(windows, ["h", "at", "w"], "kind"), ["h", "at", "w"])
    place = F.col("lo") + F.col("i")
    return covered_blocks.unionByName(found.select("a", "b", place.alias("lo"), place.alias("hi")))


def _remove(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for value, ranges in zip(batch["text"], batch["ranges"], strict=True):
                text, spans, kept, at = (value.as_py() or "").encode(), [], hashlib.sha256(), 0
                for r in sorted((x["lo"], x["hi"]) for x in ranges.as_py() or ()):
                    lo, to = r[0], r[1] + length
                    if spans and lo <= spans[-1][1]:
                        spans[-1] = (spans[-1][0], max(spans[-1][1], to))
                    else:
                        spans.append((lo, to))
                for lo, to in spans:
                    kept.update(text[at:lo])
                    at = to
                kept.update(text[at:])
                out.append((len(text), sum(b - a for a, b in spans), [list(s) for s in spans], kept.hexdigest()))
            types = (pa.int64(), pa.int64(), pa.list_(pa.list_(pa.int32())), pa.string())
            arrays = [pa.array([r[i] for r in out], t) for i, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *arrays], names=["doc_id", "n_bytes", "n_removed", "spans", "kept_sha256"])

    return run


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, spans (removed [from, to) byte ranges), kept_sha256; one row per document."""
    ranges = covered(docs, length).groupBy(F.col("a").alias("ra"), F.col("b").alias("rb")).agg(F.collect_set(F.struct("lo", "hi")).alias("ranges"))
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", "text", F.xxhash64(text).alias("a"), F.xxhash64(F.lit(1), text).alias("b"))
    rows = rows.join(ranges, (F.col("a") == F.col("ra")) & (F.col("b") == F.col("rb")), "left").select("doc_id", "text", "ranges")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, n_bytes long, n_removed long, spans array<array<int>>, kept_sha256 string"
    return rows.mapInArrow(_remove(length), schema)
