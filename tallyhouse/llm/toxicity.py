"""Toxicity: a logistic classifier with counterfactual regularisation.

Features are the words of a text and their first 4 to 6 letters, present or not. Spark counts every feature over all
labelled training rows; the `FEATURES` that tell the classes apart best, of those whose chi-square is `SIGNIFICANT`, make
the vocabulary, so that the chance weights of common words don't outvote a word that matters. The weights are fitted on
at most `SAMPLE` training rows (chosen by hash, all of them where there are fewer), minimising

    cross-entropy (toxic rows weighted by the root of the odds against them) + RIDGE |w|^2 + FAIRNESS * mean (z(text) - z(swapped text))^2

where a swapped text has every identity term (women, Muslims, ...) replaced by another of its group, so that a mention of
a group moves no score by itself. Identity terms are always in the vocabulary. Scoring reads every whole text.

Learned from: text and label of rows that are not held out, nothing else. Labels may repeat: a row is toxic if any
label of its doc_id says so; null labels are ignored.

Defined results: null and empty texts get the score of a text without any feature; without training rows of both
classes every score is 0; a null doc_id is not held out and has no label; equal rows give equal rows; empty tables
work; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.chunks import LONG_TEXT
from tallyhouse.llm.shared import stored

FEATURES, LEAST_TEXTS, SIGNIFICANT, SAMPLE = 6000, 4, 12.0, 20_000
RIDGE, FAIRNESS, STEPS = 1e-4, 1.0, 300
THRESHOLD = 0.7
PREFIXES = (4, 5, 6)
#: Labels of up to so many documents are broadcast; more are joined.
BROADCAST_LABELS = 2_000_000
#: Features counted or words remembered in a task before they are handed on or forgotten.
HELD = 300_000

#: Identity terms by group: any term may stand for any other of its group.
IDENTITY = (
    ("women", "men", "girls", "boys", "transgender", "lesbian", "gay", "straight", "bisexual", "queer"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "latino", "african", "european", "mexican", "chinese", "arab", "turkish"),
    ("immigrants", "refugees", "foreigners", "natives"),
    ("frauen", "männer", "lesben", "schwule"),
    ("femmes", "hommes", "lesbiennes", "gays"),
    ("mujeres", "hombres", "lesbianas", "gais"),
)
_GROUP = {term: group for group in IDENTITY for term in group}
_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> set[str]:
    """The distinct words; only those are held of a long text."""
    return {m[0] for m in _WORD.finditer(text.lower())} if text and len(text) > LONG_TEXT else set(_WORD.findall(text.lower())) if text else set()


def _features(word: str) -> list[str]:
    return [word, *(f"{word[:n]}*" for n in PREFIXES if len(word) >= n)]


def swapped(words: set[str], step: int) -> set[str] | None:
    """The words with every identity term replaced by the step-th next of its group; None without such a term."""
    terms = [w for w in words if w in _GROUP]
    if not terms:
        return None
    return (words - set(terms)) | {(g := _GROUP[t])[(g.index(t) + step) % len(g)] for t in terms}


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (feature, texts, toxic texts); the empty feature counts the texts."""
    counts: dict[str, list[int]] = {}

    def emit() -> pa.RecordBatch:
        columns = [pa.array(counts.keys(), pa.string()), *(pa.array([v[i] for v in counts.values()], pa.int64()) for i in (0, 1))]
        counts.clear()
        return pa.RecordBatch.from_arrays(columns, names=["feature", "n", "n_toxic"])

    for batch in batches:
        for text, toxic in zip(batch["text"], batch["toxic"].to_pylist(), strict=True):
            for feature in {"", *(f for w in words_of(text.as_py()) for f in _features(w))}:
                v = counts.setdefault(feature, [0, 0])
                v[0] += 1
                v[1] += toxic
            if len(counts) > HELD:
                yield emit()
    yield emit()


class Vocabulary:
    """Feature ids of words; remembers the words it has met, up to HELD of them."""

    def __init__(self, ids: dict[str, int]):
        self.ids, self.met = ids, {}

    def of(self, words: set[str]) -> set[int]:
        found: set[int] = set()
        for w in words:
            known = self.met.get(w)
            if known is None:
                known = tuple(i for f in _features(w) if (i := self.ids.get(f)) is not None)
                if len(self.met) >= HELD:
                    self.met.clear()
                self.met[w] = known
            if known:
                found.update(known)
        return found


def _encode(vocabulary):
    """Feature ids of training texts and of two swapped versions of those with identity terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, ids = Vocabulary(vocabulary.value), pa.list_(pa.int32())
        for batch in batches:
            own, swaps = [], []
            for text in batch["text"]:
                words = words_of(text.as_py())
                own.append(sorted(known.of(words)))
                swaps.append([sorted(known.of(s)) for step in (1, 2) if (s := swapped(words, step)) is not None])
            yield pa.RecordBatch.from_arrays([batch["toxic"], pa.array(own, ids), pa.array(swaps, pa.list_(ids))], names=["toxic", "own", "swaps"])

    return run


def fit(rows: list[tuple[int, list[int], list[list[int]]]], n_features: int) -> tuple[np.ndarray, float]:
    """Weights and bias from rows (toxic, feature ids, swapped texts' feature ids)."""

    def flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        sizes = [len(x) for x in lists]
        return np.repeat(np.arange(len(lists)), sizes), np.array([i for x in lists for i in x], dtype=np.int64)

    y = np.array([r[0] for r in rows], dtype=float)
    row, col = flat([r[1] for r in rows])
    of = [i for i, r in enumerate(rows) for _ in r[2]]
    pairs = len(of)
    # A pair's features: +1 of the text, -1 of the swapped text; what both have cancels.
    plus, plus_col = flat([rows[i][1] for i in of])
    minus, minus_col = flat([s for r in rows for s in r[2]])
    pair, pair_col = np.concatenate((plus, minus)), np.concatenate((plus_col, minus_col))
    sign = np.concatenate((np.ones(len(plus)), -np.ones(len(minus))))
    weight = np.where(y > 0, np.sqrt(max(1.0, (1 - y.mean()) / max(y.mean(), 1e-6))), 1.0)
    weight /= weight.sum()
    w, b = np.zeros(n_features), float(np.log(max(y.mean(), 1e-6) / max(1 - y.mean(), 1e-6)))
    m, v = np.zeros(n_features + 1), np.zeros(n_features + 1)
    for t in range(1, STEPS + 1):
        z = b + np.bincount(row, w[col], len(y))
        residual = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) * weight
        grad = np.bincount(col, residual[row], n_features) + 2 * RIDGE * w
        if pairs:
            gap = np.bincount(pair, sign * w[pair_col], pairs)
            grad += 2 * FAIRNESS / pairs * np.bincount(pair_col, sign * gap[pair], n_features)
        g = np.append(grad, residual.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
        w, b = w - step[:-1], b - float(step[-1])
    return w, b


def train(docs: DataFrame, labels: DataFrame) -> dict | None:
    """{"ids": feature ids, "weights", "bias"} from the labelled rows that are not held out; None without two classes."""
    spark = docs.sparkSession
    known = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").filter(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    if known.count() <= BROADCAST_LABELS:
        known = F.broadcast(known)
    rows = docs.select("doc_id", "text").join(known, "doc_id").select("doc_id", "text", "toxic")
    counted = rows.select("text", "toxic").mapInArrow(_count, "feature string, n long, n_toxic long")
    counted = counted.groupBy("feature").agg(F.sum("n").alias("n"), F.sum("n_toxic").alias("k"))
    terms = [f for t in _GROUP for f in _features(t)]
    least = stored(counted.filter((F.col("n") >= LEAST_TEXTS) | F.col("feature").isin("", *terms)), "features")
    total = least.filter("feature = ''").first()
    if total is None or not 0 < total.k < total.n:
        return None
    share = total.k / total.n
    # Chi-square of presence against label.
    off = F.pow(F.col("k") - F.col("n") * share, 2) / (F.col("n") * share * (1 - share) * (1 - F.col("n") / (total.n + 1)))
    best = least.filter("feature != ''").select("feature", off.alias("chi")).filter(F.col("chi") >= SIGNIFICANT).orderBy(F.desc("chi"), "feature").limit(FEATURES).collect()
    seen = {r.feature for r in least.filter(F.col("feature").isin(*terms)).select("feature").collect()}
    ids = {f: i for i, f in enumerate(sorted({r.feature for r in best} | seen | set(_GROUP)))}
    order = F.xxhash64("doc_id", "text")
    sample = rows.select("text", "toxic", order.alias("o")).withColumn("o", F.pmod("o", F.lit(1 << 40)))
    if total.n > SAMPLE:
        sample = sample.filter(F.col("o") < int((1 << 40) * SAMPLE / total.n))
    encoded = sample.select("text", "toxic").mapInArrow(_encode(spark.sparkContext.broadcast(ids)), "toxic int, own array<int>, swaps array<array<int>>")
    weights, bias = fit([tuple(r) for r in encoded.toLocalIterator()], len(ids))
    return {"ids": ids, "weights": weights, "bias": bias}


def _scorer(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, weights, bias = Vocabulary(model.value["ids"]), model.value["weights"], model.value["bias"]
        for batch in batches:
            z = np.array([bias + sum(weights[i] for i in sorted(known.of(words_of(t.as_py())))) for t in batch["text"]], dtype=float)
            scores = pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))), pa.float64())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], scores], names=["doc_id", "score"])

    return run


def score(docs: DataFrame, model: dict | None) -> DataFrame:
    """doc_id, score of every document."""
    rows = docs.select("doc_id", "text")
    if model is None:
        return rows.select("doc_id", F.lit(0.0).alias("score"))
    scorer = _scorer(docs.sparkSession.sparkContext.broadcast(model))
    return rows.mapInArrow(scorer, rows.select("doc_id", F.lit(0.0).alias("score")).schema)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted; one row per document."""
    scored = score(docs, train(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
