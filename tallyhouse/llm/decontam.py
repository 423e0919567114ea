"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Patterns are the windows of `window` consecutive words of every item (an item of fewer words is one pattern). The search
runs over words, not characters: in prose nearly every three-letter block occurs in some pattern, nearly no pair of words
does, so a shift table over pairs of words skips almost a whole pattern length at a time.

* Shift table: for a pair of words, how far its last occurrence in the first m words of any pattern is from the end of
  those m words; a pair in no pattern shifts by m - 1. (m = 1: a block is one word.)
* Hash buckets: where the shift is 0, the pair names the patterns whose m words end in it.
* Every candidate is compared word for word with the text.

Patterns of one length form a class with tables of their own, so that short items don't spoil the shifts of the others;
there are at most `window` classes. Items go to the tasks in blocks of at most `BLOCK_WORDS` words, one pass of
narrow tasks per block: a task holds one block and one batch of documents, whatever the number of items.

Defined results: null or wordless documents have no words and no hits; null or wordless items and null item ids give no
pattern; items with equal texts or ids both count as one id each; equal documents give equal rows; empty tables work;
other columns are ignored by `scan` and kept by `keep_clean`, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm.chunks import word_chunks

#: Words are runs of ASCII digits and letters and of all characters beyond ASCII; A-Z counts as a-z.
_KEPT = set(range(0x30, 0x3A)) | set(range(0x61, 0x7B)) | set(range(0x80, 0x100))
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b in _KEPT else 0x20 for b in range(256))

#: Bound of what is broadcast at a time: words of items in a block (a longer item is a block alone).
BLOCK_WORDS = 500_000


def folded(text: str | None) -> bytes:
    """The words of a text between spaces."""
    return (text or "").encode().translate(_FOLD)


def words_of(text: str | None) -> list[bytes]:
    return folded(text).split()


class Patterns:
    """Shift tables and buckets of a block of items. items: (id, words)."""

    def __init__(self, items: list[tuple[object, list[bytes]]], window: int):
        owners: dict[tuple[bytes, ...], set] = defaultdict(set)
        for item, words in items:
            n = min(window, len(words))
            for i in range(len(words) - n + 1 if n else 0):
                owners[tuple(words[i : i + n])].add(item)
        self.classes = []
        by_length: dict[int, list[tuple[bytes, ...]]] = defaultdict(list)
        for pattern in owners:
            by_length[len(pattern)].append(pattern)
        for m, patterns in sorted(by_length.items()):
            block = min(2, m)
            shift: dict[object, int] = {}
            bucket: dict[object, dict[tuple[bytes, ...], frozenset]] = defaultdict(dict)
            for p in patterns:
                for end in range(block, m + 1):
                    key = p[end - 1] if block == 1 else p[end - 2 : end]
                    shift[key] = min(shift.get(key, m), m - end)
                bucket[p[-1] if block == 1 else p[-2:]][p] = frozenset(owners[p])
            self.classes.append((m, block, shift, dict(bucket)))

    def occurrences(self, text: str | None, window: int) -> Iterator[tuple[int, int, frozenset]]:
        """(words so far, 0, no ids) and (first word, number of words, item ids) of every occurrence; long texts in chunks."""
        at, overlap = 0, window - 1
        for i, words in enumerate(word_chunks(folded(text), overlap)):
            at -= min(overlap, at) if i else 0
            for first, n, who in self.search(words):
                yield at + first, n, who
            at += len(words)
            yield at, 0, frozenset()

    def search(self, words: list[bytes]) -> Iterator[tuple[int, int, frozenset]]:
        """(first word, number of words, item ids) of every occurrence."""
        for m, block, shift, bucket in self.classes:
            end, n, miss = m, len(words), m - block + 1
            if block == 1:
                for i, word in enumerate(words):
                    if word in bucket:
                        yield i, 1, bucket[word][(word,)]
                continue
            while end <= n:
                key = (words[end - 2], words[end - 1])
                step = shift.get(key, miss)
                if not step:
                    found = bucket[key].get(tuple(words[end - m : end]))
                    if found:
                        yield end - m, m, found
                    step = 1
                end += step


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Disjoint ascending [from, to) of any spans."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[object, str]]]:
    """All items in blocks of a bounded number of words, streamed through the driver."""
    rows = benchmark.select("item_id", "text").filter(F.col("item_id").isNotNull() & F.col("text").isNotNull())
    block, held = [], 0
    for item, text in rows.toLocalIterator():
        n = len(words_of(text))
        if block and held + n > BLOCK_WORDS:
            yield block
            block, held = [], 0
        if n:
            block.append((item, text))
            held += n
    if block:
        yield block


def scan(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """doc_id, n_words, spans (disjoint [from, to) of hit words), items (ids with occurring windows), one row per document."""
    sc = docs.sparkSession.sparkContext
    item_type = benchmark.schema["item_id"].dataType
    spans_type, items_type = T.ArrayType(T.ArrayType(T.IntegerType())), T.ArrayType(item_type)
    rows = docs.select(
        "doc_id", "text", F.lit(0).cast("long").alias("n_words"),
        F.array().cast(spans_type).alias("spans"), F.array().cast(items_type).alias("items"),
    )
    state, passes = rows.schema, 0
    for block in _blocks(benchmark):
        rows, passes = rows.mapInArrow(_searcher(sc.broadcast(block), window), state), passes + 1
    if not passes:
        rows = rows.mapInArrow(_searcher(sc.broadcast([]), window), state)
    return rows.drop("text")


def _searcher(block, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = Patterns([(item, words_of(text)) for item, text in block.value], window)
        for batch in batches:
            counts, spans, items = [], [], []
            for text, had, ids in zip(batch["text"], batch["spans"].to_pylist(), batch["items"].to_pylist(), strict=True):
                n_words, found, owners = 0, [tuple(x) for x in had], set(ids)
                for i, n, who in patterns.occurrences(text.as_py(), window):
                    if n:
                        found.append((i, i + n))
                        owners |= who
                    else:
                        n_words = i
                counts.append(n_words)
                spans.append([list(x) for x in _merged(found)])
                items.append(list(owners))
            new = {"n_words": counts, "spans": spans, "items": items}
            yield pa.RecordBatch.from_arrays(
                [pa.array(new[f.name], f.type) if f.name in new else batch[f.name] for f in batch.schema], schema=batch.schema
            )

    return run


def report(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 (of the sorted, comma-joined ids), contaminated."""
    found = scan(docs, benchmark, window)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + F.get(s, F.lit(1)) - F.get(s, F.lit(0)))
    ids = F.array_join(F.sort_array(F.transform("items", lambda x: x.cast("string"))), ",")
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(ids, 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """The documents in which no window of any item occurs, with all their columns."""
    sc = docs.sparkSession.sparkContext
    rows = docs
    for block in _blocks(benchmark):
        rows = rows.mapInArrow(_cleaner(sc.broadcast(block), docs.columns.index("text"), window), docs.schema)
    return rows


def _cleaner(block, text_at: int, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = Patterns([(item, words_of(text)) for item, text in block.value], window)
        for batch in batches:
            clean = [not any(n for _, n, _ in patterns.occurrences(x.as_py(), window)) for x in batch.column(text_at)]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return run


def sha256_of(ids: list) -> str:
    """The digest of `report`, for comparisons."""
    return hashlib.sha256(",".join(sorted(map(str, ids))).encode()).hexdigest()
