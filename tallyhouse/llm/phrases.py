"""Collocations from depth-truncated suffix trees that are built group by group.

A suffix is the up to `DEPTH` words that begin at a word and stay inside its piece. Vertical partitioning: suffixes are
grouped by their first two words so that a group's subtree fits a memory budget, and a pair of words that alone exceeds the
budget is extended to whole suffixes. Every group sorts its suffixes and sums leaf totals up to the nodes: the counts of
all phrases of two and more words.

* `_survey`, the first pass over the texts, counts words, and pairs of neighbours by a 64-bit hash. Counts of a few
  million words are merged before they leave a task, and travel as blocks of arrays, one for each bucket of hashes.
* Pairs that occur often enough, and pairs beyond the budget, are marked in two bitmaps of at most `MOST_BITS` bits. Every word
  pair inside a phrase occurs at least as often as the phrase, so suffixes end before a pair without a mark. Collisions, and
  bitmaps that fill up on very large data, let suffixes grow or split more than needed: counts stay the same.
* `_suffixes`, the second pass, merges equal suffixes of a few million words and sends them to their groups, as blocks with a
  dictionary of their words. Groups hold strings, not hashes, so all counts are exact. Nodes above the point where a pair
  was extended come out in parts, one from each group, and are added up after.

Scores, cuts and the rule about longer candidates are joins and aggregates over the candidates, in decimals.

Defined results: A-Z count as a-z; a null text has no words, a null lang is `und`; repeated rows count each time; equal scores
go by count, then by the phrase's UTF-8 bytes; empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.shared import discard, stored

DEPTH = 4
#: Words whose counts are merged in a task before they are sent; bytes of a long text that are split at a time.
MERGED, SEGMENT = 4_000_000, 1 << 20
#: Bytes of text a survey bucket, and suffixes a group.
BUCKET_BYTES, GROUP_SUFFIXES = 24 << 20, 2_000_000
#: Bits a mark has room for, and the most bits of a bitmap (32 MB).
SPREAD, MOST_BITS = 16, 1 << 28

#: Pieces end at these; words at spaces and tabs.
_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
_FOLD = bytes(10 if b in _ENDS else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))

SURVEY = "bucket long, lang string, words array<string>, pairs binary, counts binary"
COUNTS = "lang string, word string, pair long, n long"
BLOCKS = "lang string, grp long, part boolean, words array<string>, codes binary, counts binary"
NODES = "lang string, phrase string, k int, part boolean, n long"


class _Numbers(dict):
    """Numbers of words in the order they are met; 0 is no word, 1 the end of a piece."""

    def __init__(self):
        super().__init__({b"": 0, b"\n": 1})

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


class Stretch:
    """Words of one language as numbers, ready to be counted.

    hashes: by number. The last `tail` numbers begin no suffix here; they begin the next stretch.
    """

    def __init__(self, lang: str, numbers: _Numbers, of: np.ndarray, tail: int):
        self.lang, self.of, self.starts = lang, of, len(of) - tail
        self.words = list(numbers)
        self.hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, self.words), np.uint64, len(self.words))
        self.seed = np.uint64(xxhash.xxh3_64_intdigest(lang.encode()))

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Hash of every number and its next, and whether both are words."""
        a, b = self.of[:-1], self.of[1:]
        h = self.hashes * np.uint64(0x9E3779B97F4A7C15) ^ self.seed
        return mixed(h[a] + self.hashes[b]), (a > 1) & (b > 1)


def mixed(x: np.ndarray) -> np.ndarray:
    """Bits of 64-bit numbers well spread."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def _segments(text: bytes) -> Iterator[list[bytes]]:
    """Words and ends of pieces of a folded text, some of it at a time."""
    at = 0
    while len(text) - at > SEGMENT:
        end = text.find(b" ", at + SEGMENT)
        if end < 0:
            break
        yield text[at:end].split(b" ")
        at = end + 1
    yield text[at:].split(b" ")


class _Held:
    """Words of a language that wait to be counted."""

    def __init__(self, lang: str):
        self.lang, self.numbers, self.arrays, self.n = lang, _Numbers(), [], 0

    def add(self, words: list[bytes]) -> None:
        of = np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words))
        of = of[of != 0]
        self.arrays.append(of)
        self.n += len(of)

    def take(self, tail: int) -> Stretch:
        """All words but the last few, which stay."""
        of = np.concatenate(self.arrays)
        tail = min(tail, len(of))
        made = Stretch(self.lang, self.numbers, of, tail)
        rest = [made.words[i] for i in of[len(of) - tail :]]
        self.__init__(self.lang)
        if rest:
            self.add(rest)
        return made


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[Stretch]:
    held: dict[str, _Held] = {}
    total = 0
    for batch in batches:
        for lang, text in zip(batch["lang"].to_pylist(), batch["text"], strict=True):
            if not text.is_valid:
                continue
            own = held.get(lang) or held.setdefault(lang, _Held(lang))
            folded = text.as_py().encode().translate(_FOLD).replace(b"\n", b" \n ")
            for words in _segments(folded):
                before = own.n
                own.add(words)
                total += own.n - before
                if total > MERGED:
                    for each in held.values():
                        if each.n >= DEPTH:
                            yield each.take(DEPTH - 1)
                    total = sum(each.n for each in held.values())
            own.add([b"\n"])
    for each in held.values():
        if each.n:
            yield each.take(0)


def _survey(buckets: int):
    """Blocks of word counts and of pair counts, by bucket of hashes."""

    def rows(s: Stretch) -> Iterator[pa.RecordBatch]:
        n = np.bincount(s.of[: s.starts], minlength=len(s.words))
        present = np.flatnonzero(n[2:]) + 2
        at = s.hashes[present] % np.uint64(buckets)
        order = np.argsort(at, kind="stable")
        present, at = present[order], at[order]
        keys, both = s.pairs()
        keys, counts = np.unique(keys[: s.starts][both[: s.starts]], return_counts=True)
        key_at = keys % np.uint64(buckets)
        order = np.argsort(key_at, kind="stable")
        keys, counts, key_at = keys[order], counts[order], key_at[order]
        out = []
        for b in np.union1d(at, key_at):
            own = present[np.searchsorted(at, b) : np.searchsorted(at, b, "right")]
            if len(own):
                out.append((int(b), s.lang, [s.words[i].decode() for i in own], None, n[own].astype("<u4").tobytes()))
            i, j = np.searchsorted(key_at, b), np.searchsorted(key_at, b, "right")
            if j > i:
                out.append((int(b), s.lang, None, keys[i:j].astype("<u8").tobytes(), counts[i:j].astype("<u4").tobytes()))
        for i in range(0, len(out), 64):
            columns = zip(*out[i : i + 64], strict=True)
            types = [pa.int64(), pa.string(), pa.list_(pa.string()), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["bucket", "lang", "words", "pairs", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in _stretches(batches):
            yield from rows(s)

    return run


def _totals(least: int):
    """Merged counts of a bucket: words that occur often enough, all words of a language (no word), frequent pairs (a hash)."""

    def run(table: pa.Table) -> pa.Table:
        words: dict[tuple[str, str], int] = {}
        keys, counts = [], []
        for lang, own, pairs, n in zip(*(table[c] for c in ("lang", "words", "pairs", "counts")), strict=True):
            n = np.frombuffer(n.as_buffer(), "<u4")
            if pairs.is_valid:
                keys.append(np.frombuffer(pairs.as_buffer(), "<u8"))
                counts.append(n)
                continue
            lang = lang.as_py()
            for word, k in zip(own.as_py(), n.tolist(), strict=True):
                words[lang, word] = words.get((lang, word), 0) + k
        of_lang: dict[str, int] = {}
        for (lang, _), n in words.items():
            of_lang[lang] = of_lang.get(lang, 0) + n
        rows = [(lang, None, None, n) for lang, n in of_lang.items()]
        rows += [(lang, word, None, n) for (lang, word), n in words.items() if n >= least]
        if keys:
            key, place = np.unique(np.concatenate(keys), return_inverse=True)
            n = np.zeros(len(key), np.int64)
            np.add.at(n, place, np.concatenate(counts))
            rows += zip([None] * (n >= least).sum(), [None] * (n >= least).sum(), key[n >= least].view(np.int64).tolist(), n[n >= least].tolist(), strict=True)
        columns = list(zip(*rows, strict=True)) or [[]] * 4
        types = [pa.string(), pa.string(), pa.int64(), pa.int64()]
        return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["lang", "word", "pair", "n"])

    return run


def bitmap(keys: DataFrame, n: int) -> tuple[int, np.ndarray]:
    """Number of leading bits that are looked at, and the bitmap of the marked hashes (column pair); at most MOST_BITS bits.

    Spark builds blocks of 4 KB; what reaches the driver has the bitmap's size, whatever the number of keys.
    """
    bits = max(15, min(MOST_BITS.bit_length() - 1, (SPREAD * max(n, 1) - 1).bit_length()))
    place = F.shiftrightunsigned("pair", 64 - bits)
    blocks = keys.groupBy(F.shiftright(place, 15).alias("block")).agg(F.bitmap_construct_agg(place.bitwiseAND(F.lit(32767))).alias("bits"))
    made = np.zeros((1 << bits) // 8, np.uint8)
    for block in blocks.toLocalIterator():
        made[block["block"] * 4096 : (block["block"] + 1) * 4096] = np.frombuffer(block["bits"], np.uint8)
    return bits, made


def marked(hashes: np.ndarray, marks: tuple[int, np.ndarray]) -> np.ndarray:
    bits, made = marks
    place = hashes >> np.uint64(64 - bits)
    return (made[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _runs(*columns: np.ndarray) -> np.ndarray:
    """Where a run of equal rows begins, in sorted columns."""
    new = np.ones(len(columns[0]), bool)
    if len(new):
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return np.flatnonzero(new)


def _suffixes(frequent, heavy, groups: int):
    """Blocks of equal suffixes with their counts, by group. A group beyond `groups` has suffixes of an extended pair."""

    def rows(s: Stretch) -> Iterator[pa.RecordBatch]:
        keys, both = s.pairs()
        ok = both & marked(keys, frequent.value)
        at = np.flatnonzero(ok[: s.starts])
        if not len(at):
            return
        ok, of = np.append(ok, [False] * 2), np.append(s.of, [0] * 2)
        third = ok[at + 1]
        fourth = third & ok[at + 2]
        w = [of[at], of[at + 1], np.where(third, of[at + 2], 0), np.where(fourth, of[np.minimum(at + 3, len(of) - 1)], 0)]
        group, part = keys[at], marked(keys[at], heavy.value)
        tails = mixed(group + s.hashes[w[2]] * np.uint64(0xD6E8FEB86659FD93) + s.hashes[w[3]] * np.uint64(0xA0761D6478BD642F))
        group = (np.where(part, tails, group) % np.uint64(groups)).astype(np.int64) + np.where(part, groups, 0)
        order = np.lexsort((w[3], w[2], w[1], w[0], group))
        group, w = group[order], [c[order] for c in w]
        begin = _runs(group, *w)
        n = np.diff(np.append(begin, len(group)))
        group, w = group[begin], np.stack([c[begin] for c in w])
        out, first = [], np.append(_runs(group), len(group))
        for i, j in zip(first[:-1], first[1:], strict=True):
            own, codes = np.unique(w[:, i:j], return_inverse=True)
            words = [s.words[x].decode() if x else "" for x in own]
            out.append((s.lang, int(group[i]), bool(group[i] >= groups), words, codes.astype("<u4").tobytes(), n[i:j].astype("<u4").tobytes()))
        for i in range(0, len(out), 64):
            columns = zip(*out[i : i + 64], strict=True)
            types = [pa.string(), pa.int64(), pa.bool_(), pa.list_(pa.string()), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["lang", "grp", "part", "words", "codes", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in _stretches(batches):
            yield from rows(s)

    return run


def _subtree(least: int):
    """The nodes of a group's subtree: suffixes sorted by words, each node's count the sum of the leaves below it."""

    def run(table: pa.Table) -> pa.Table:
        number: dict[str, int] = {"": 0}
        columns, totals = [], []
        for words, codes, n in zip(*(table[c] for c in ("words", "codes", "counts")), strict=True):
            own = np.array([number.setdefault(w, len(number)) for w in words.as_py()], np.int64)
            columns.append(own[np.frombuffer(codes.as_buffer(), "<u4").reshape(DEPTH, -1)])
            totals.append(np.frombuffer(n.as_buffer(), "<u4"))
        w, n = np.concatenate(columns, axis=1), np.concatenate(totals).astype(np.int64)
        order = np.lexsort(w[::-1])
        w, n = w[:, order], n[order]
        lang, part, words = table["lang"][0].as_py(), table["part"][0].as_py(), list(number)
        found: list[tuple[str, int, int]] = []
        for k in range(2, DEPTH + 1):
            begin = _runs(*w[:k])
            total = np.add.reduceat(n, begin)
            # Suffixes that end above this depth are no nodes of it. An extended pair's nodes are whole only at full depth.
            node = (w[k - 1, begin] > 0) & ((total >= least) | (part and k < DEPTH))
            found += [(" ".join(words[w[c, i]] for c in range(k)), k, t) for i, t in zip(begin[node].tolist(), total[node].tolist(), strict=True)]
        size = len(found)
        phrase, k, total = zip(*found, strict=True) if found else ((), (), ())
        return pa.table(
            [pa.array([lang] * size, pa.string()), pa.array(phrase, pa.string()), pa.array(k, pa.int32()), pa.array([part] * size, pa.bool_()), pa.array(total, pa.int64())],
            names=["lang", "phrase", "k", "part", "n"],
        )

    return run


def counts(docs: DataFrame, least: int = 30) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Stored tables: phrases of 2 to DEPTH words (lang, phrase, k, n) and words (lang, word, n) with n >= least; all words by lang."""
    sc = docs.sparkSession.sparkContext
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text")
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    buckets = max(1, math.ceil(size / BUCKET_BYTES))
    blocks = rows.mapInArrow(_survey(buckets), SURVEY)
    survey = stored(blocks.groupBy("bucket").applyInArrow(_totals(least), COUNTS), "phrases-survey")

    pairs = survey.filter(F.col("pair").isNotNull()).select("pair", "n")
    heavy = pairs.filter(F.col("n") > GROUP_SUFFIXES)
    n_pairs, n_suffixes, n_heavy = pairs.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0)), F.count_if(F.col("n") > GROUP_SUFFIXES)).first()
    groups = max(1, math.ceil(n_suffixes / GROUP_SUFFIXES))
    marks = sc.broadcast(bitmap(pairs, n_pairs)), sc.broadcast(bitmap(heavy, n_heavy))
    suffixes = rows.mapInArrow(_suffixes(*marks, groups), BLOCKS)
    nodes = suffixes.groupBy("lang", "grp").applyInArrow(_subtree(least), NODES)
    # Nodes that came out in parts are added up; the others are whole.
    nodes = nodes.groupBy("lang", "phrase", "k").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    phrases = stored(nodes, "phrases-nodes")
    words = stored(survey.filter(F.col("word").isNotNull()).select("lang", "word", "n"), "phrases-words")
    by_lang = survey.filter(F.col("word").isNull() & F.col("pair").isNull()).groupBy("lang").agg(F.sum("n").alias("n"))
    by_lang = stored(by_lang, "phrases-langs")
    discard(survey)
    return phrases, words, by_lang


def collocations(docs: DataFrame, least: int = 30, top: int = 2000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first `top` phrases of each language."""
    phrases, words, by_lang = counts(docs, least)
    given = phrases.select("lang", "phrase", "k", F.col("n").alias("a"), F.split("phrase", " ").alias("ws"))
    known = phrases.select("lang", "phrase", "n").unionByName(words.select("lang", F.col("word").alias("phrase"), "n"))

    def joined(first, length):
        return F.array_join(F.slice("ws", first, length), " ")

    cuts = given.withColumn("at", F.explode(F.sequence(F.lit(1), F.col("k") - 1)))
    cuts = cuts.select("lang", "phrase", "a", "at", joined(F.lit(1), F.col("at")).alias("head"), joined(F.col("at") + 1, F.col("k") - F.col("at")).alias("tail"))
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("head"), F.col("n").alias("l")), ["lang", "head"])
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("tail"), F.col("n").alias("r")), ["lang", "tail"])
    score = F.expr("CAST(CAST(2000000 AS DECIMAL(10, 0)) * CAST(a AS DECIMAL(20, 0)) DIV (CAST(l AS DECIMAL(20, 0)) + r) AS LONG)")
    least_cut = F.min(F.struct(score.alias("score"), "at", "l", "r")).alias("cut")
    scored = cuts.groupBy("lang", "phrase").agg(F.max("a").alias("a"), least_cut).select("lang", "phrase", "a", "cut.score", "cut.l", "cut.r")

    # The contiguous parts of at least two words of every candidate, shorter than it is.
    longer = given.filter("k > 2").withColumn("m", F.explode(F.sequence(F.lit(2), F.col("k") - 1)))
    longer = longer.withColumn("at", F.explode(F.sequence(F.lit(1), F.col("k") - F.col("m") + 1)))
    inside = longer.select("lang", joined(F.col("at"), F.col("m")).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    wide = "CAST({} AS DECIMAL(20, 0))"
    held = F.expr(f"100 * {wide.format('most')} >= 80 * {wide.format('a')}")
    kept = scored.join(inside, ["lang", "phrase"], "left").filter(~F.coalesce(held, F.lit(False)))

    best_first = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(best_first)).filter(F.col("rank") <= top)
    ranked = ranked.join(by_lang, "lang")
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
