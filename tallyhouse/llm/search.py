"""Ranked lexical search by pipelined term partitioning.

The inverted file is partitioned by terms and by documents: a slice is a bounded run of documents, a stage owns a share of
the terms. Bundles of items travel through the stages, rarest terms first. On their way they carry sparse accumulators,
one list of (document, score so far) for each item and slice; a stage cogroups the bundles that reach it with the postings
of its own terms, adds integer contributions, and hands the accumulators on as a table. After the last stage every slice
selects its best documents, and a window over those selects the best of all.

* Scores only grow. The `top`-th best score so far of an item is a lower bound of the one it will have, so an accumulator
  that cannot reach it with the most that all later terms can add is dropped, and no new ones are opened once these
  terms alone cannot reach it. Ties are kept. The bounds are exact integers: the result is that of a full sum.
* A slice has at most `SLICE_DOCS` documents and `SLICE_POSTINGS` postings beyond its last document, so a task holds
  one slice's postings of one stage and one bundle's accumulators for it, whatever a term's frequency.
* Items are cut by a hash of their id into blocks of at most `BLOCK_TERMS` different (item, term) pairs (a longer item is
  a block alone); a block's terms, weights and items are what is broadcast. Each block takes one pass over the texts
  and its results are stored before the next begins.

A term's weight is floor(1000 ln((2N + 2) / (2 df + 1))), N documents with terms, df of them with this one. A document of n
terms has m = 100 - 25 + (25 n N) div L, L all terms of all documents. A term that occurs tf times there contributes its
weight times ((10^9 tf) div (1000 tf + 12 m)) each time that the item has it.

Defined results: terms are runs of ASCII letters and digits and of all characters beyond ASCII, A-Z as a-z; a null or
wordless document counts in nothing and a null or wordless item has no rows; rows with the same item_id (also null)
are one item with the terms of all of them; rows with the same doc_id are documents of their own; equal scores go by
doc_id, nulls first; empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.chunks import word_chunks
from tallyhouse.llm.decontam import folded
from tallyhouse.llm.shared import discard, stored

TERM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

BLOCK_TERMS, BUNDLE_ITEMS = 200_000, 64
SLICE_DOCS, SLICE_POSTINGS = 8192, 1 << 21
STAGES = 4
#: The number under which a slice's row of document ids and lengths goes.
DOCS = -1
_NULL_ID = np.iinfo(np.int64).min

POSTINGS = "slice long, term int, docs array<long>, counts array<long>"
CARRIED = "slice long, bundle int, item int, docs array<long>, scores array<long>, best array<long>"


def item_terms(items: DataFrame) -> DataFrame:
    """item_id, term, times."""
    terms = F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(TERM), F.lit(0))
    return items.select("item_id", F.explode(terms).alias("term")).groupBy("item_id", "term").agg(F.count("*").alias("times"))


def _blocks(terms: DataFrame) -> int:
    """So many hash blocks of items that each has at most BLOCK_TERMS pairs or a single item."""
    n = -(-max(1, terms.count()) // BLOCK_TERMS)
    while True:
        block = F.pmod(F.xxhash64("item_id"), F.lit(n)).alias("block")
        sizes = terms.groupBy(block, "item_id").agg(F.count("*").alias("n")).groupBy("block").agg(F.sum("n").alias("n"), F.count("*").alias("items"))
        if not sizes.filter((F.col("n") > BLOCK_TERMS) & (F.col("items") > 1)).head(1):
            return n
        n *= 2


def _lists(values: np.ndarray, ends: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)).astype(np.int32)), pa.array(values, pa.int64()))


def _invert(vocabulary):
    """Inverted slices of a partition's documents: a row of ids and lengths, and a row for every term of the vocabulary in it."""

    def slice_rows(number: int, docs: list, lengths: list, found: list) -> pa.RecordBatch:
        term, doc, tf = np.array(found, np.int64).reshape(-1, 3).T
        order = np.argsort(term, kind="stable")
        terms, counts = np.unique(term, return_counts=True)
        ends = np.cumsum(counts)
        head = pa.array([docs], pa.list_(pa.int64())), pa.array([lengths], pa.list_(pa.int64()))
        lists = [pa.concat_arrays([h, _lists(v[order], ends)]) for h, v in zip(head, (doc, tf), strict=True)]
        columns = [pa.array(np.full(len(terms) + 1, number)), pa.array(np.concatenate(([DOCS], terms)), pa.int32()), *lists]
        return pa.RecordBatch.from_arrays(columns, names=["slice", "term", "docs", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {t: i for i, t in enumerate(vocabulary.value)}
        number, docs, lengths, found = TaskContext.get().partitionId() << 24, [], [], []
        for batch in batches:
            for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                counts: Counter[bytes] = Counter()
                for words in word_chunks(folded(text.as_py()), 0):
                    counts.update(words)
                if not counts:
                    continue
                found += [(known[w], len(docs), n) for w, n in counts.items() if w in known]
                docs.append(doc)
                lengths.append(counts.total())
                if len(docs) >= SLICE_DOCS or len(found) >= SLICE_POSTINGS:
                    yield slice_rows(number, docs, lengths, found)
                    number, docs, lengths, found = number + 1, [], [], []
        if docs:
            yield slice_rows(number, docs, lengths, found)

    return run


class Plan:
    """What a block's tasks need to know: weights, stages and the most a term can add, and the items' terms by stage.

    owned: for each term its df and largest tf. Stages get rarer terms first, each about twice the postings of the one before.
    """

    def __init__(self, owned: dict[int, tuple[int, int]], items: list[dict[int, int]], n_docs: int, n_terms: int, top: int):
        self.n_docs, self.n_terms, self.top = n_docs, n_terms, top
        size = max(owned, default=-1) + 1
        self.weight, self.stage = np.zeros(size, np.int64), np.zeros(size, np.int64)
        most = np.zeros(size, np.int64)
        df = np.zeros(size, np.int64)
        shortest = 100 - 25 + (25 * n_docs) // max(n_terms, 1)
        for t, (n, tf) in owned.items():
            df[t] = n
            # In doubles, floor of the product.
            self.weight[t] = int(np.floor(1000 * np.log((2 * n_docs + 2) / (2 * n + 1))))
            most[t] = self.weight[t] * ((1_000_000_000 * tf) // (1000 * tf + 12 * shortest))
        rare_first = np.lexsort((np.arange(size), df))
        before = np.cumsum(df[rare_first]) - df[rare_first]
        bounds = [df.sum() * (2**s - 1) / (2**STAGES - 1) for s in range(1, STAGES)]
        self.stage[rare_first] = np.searchsorted(bounds, before, side="right")
        self.items = [[[(t, k) for t, k in terms.items() if t < size and df[t] and self.stage[t] == s] for s in range(STAGES)] for terms in items]
        added = np.array([[sum(k * int(most[t]) for t, k in own) for own in of] for of in self.items], np.int64).reshape(-1, STAGES)
        #: later[i, s]: the most that stages from s on can add to a document's score for item i.
        self.later = np.concatenate([np.cumsum(added[:, ::-1], axis=1)[:, ::-1], np.zeros((len(items), 1), np.int64)], axis=1)


def _stage(plan, reached, stage: int):
    """One slice's accumulators of a bundle through a stage. reached: the score so far that an item's best documents have."""

    def run(key: tuple, carried: pa.Table, postings: pa.Table) -> pa.Table:
        p, least = plan.value, reached.value
        slice_, bundle = (k.as_py() for k in key)
        term = postings["term"].to_numpy()
        docs, counts = (postings[c].combine_chunks() for c in ("docs", "counts"))
        at = int(np.flatnonzero(term == DOCS)[0])
        ids = docs[at].values
        m = 100 - 25 + (25 * counts[at].values.to_numpy() * p.n_docs) // p.n_terms
        gains = {}
        for i, t in enumerate(term.tolist()):
            if t != DOCS:
                d, tf = docs[i].values.to_numpy(), counts[i].values.to_numpy()
                gains[t] = d, p.weight[t] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[d]))
        had = dict(zip(carried["item"].to_pylist(), range(carried.num_rows), strict=True))
        old_docs, old_scores = (carried[c].combine_chunks() for c in ("docs", "scores"))
        out: list[tuple] = []
        for item in range(bundle * BUNDLE_ITEMS, min((bundle + 1) * BUNDLE_ITEMS, len(p.items))):
            score, own = np.zeros(len(m), np.int64), p.items[item][stage]
            if item in had:
                before = old_docs[had[item]].values.to_numpy()
                score[before] = old_scores[had[item]].values.to_numpy()
            opened = score > 0
            for t, k in own:
                if t in gains:
                    d, gain = gains[t]
                    score[d] += k * gain
            if p.later[item, stage] < least[item]:
                score[~opened] = 0
            kept = np.flatnonzero(score)
            if not len(kept):
                continue
            best = -np.sort(-score[kept])[: p.top]
            bound = max(least[item], int(best[-1]) if len(best) == p.top else 0)
            kept = kept[score[kept] + p.later[item, stage + 1] >= bound]
            if stage == STAGES - 1:
                named = ids.take(pa.array(kept))
                kept = kept[np.lexsort((named.fill_null(_NULL_ID).to_numpy(), -score[kept]))[: p.top]]
                out.append((item, ids.take(pa.array(kept)).to_pylist(), score[kept], []))
            else:
                out.append((item, kept, score[kept], best))
        n, lists = len(out), [pa.array([o[c] for o in out], pa.list_(pa.int64())) for c in (1, 2, 3)]
        columns = [pa.array([slice_] * n, pa.int64()), pa.array([bundle] * n, pa.int32()), pa.array([o[0] for o in out], pa.int32())]
        return pa.table([*columns, *lists], names=["slice", "bundle", "item", "docs", "scores", "best"])

    return run


def _reached(carried: DataFrame, n_items: int, top: int) -> list[int]:
    """The top-th best score so far of each item over all slices, 0 where fewer documents have one."""
    by_item = Window.partitionBy("item").orderBy(F.desc("score"))
    rows = carried.select("item", F.explode("best").alias("score")).withColumn("place", F.row_number().over(by_item))
    found = dict(rows.filter(F.col("place") <= top).filter(F.col("place") == top).select("item", "score").collect())
    return [found.get(i, 0) for i in range(n_items)]


def _rank_block(docs: DataFrame, terms: DataFrame, top: int) -> DataFrame:
    """item_id, rank, doc_id, score for the items of one block."""
    spark = docs.sparkSession
    sc = spark.sparkContext
    vocabulary = sorted(r.term for r in terms.select("term").distinct().collect())
    number = {t: i for i, t in enumerate(vocabulary)}
    by_item: dict[object, dict[int, int]] = {}
    for r in terms.collect():
        by_item.setdefault(r.item_id, {})[number[r.term]] = r.times
    named = list(by_item)
    known = sc.broadcast([t.encode() for t in vocabulary])
    postings = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_invert(known), POSTINGS), "search-postings")

    sizes = postings.filter(F.col("term") == DOCS).agg(
        F.coalesce(F.sum(F.size("docs")), F.lit(0)),
        F.coalesce(F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda s, x: s + x)), F.lit(0)),
    )
    n_docs, n_terms = sizes.first()
    owned = postings.filter(F.col("term") != DOCS).groupBy("term").agg(F.sum(F.size("docs")).alias("df"), F.max(F.array_max("counts")).alias("tf"))
    made = Plan({r.term: (r.df, r.tf) for r in owned.collect()}, list(by_item.values()), n_docs, n_terms, top)
    plan = sc.broadcast(made)

    bundles = -(-len(named) // BUNDLE_ITEMS)
    carried, least, tables = spark.createDataFrame([], CARRIED), [0] * len(named), [postings]
    for stage in range(STAGES):
        # The bundles that want a term of this stage; every bundle wants the documents of a slice.
        wanted = {(t, i // BUNDLE_ITEMS) for i, of in enumerate(made.items) for t, _ in of[stage]} | {(DOCS, b) for b in range(bundles)}
        owners = F.broadcast(spark.createDataFrame(sorted(wanted), "term int, bundle int"))
        run = _stage(plan, sc.broadcast(least), stage)
        both = carried.groupBy("slice", "bundle").cogroup(postings.join(owners, "term").groupBy("slice", "bundle"))
        carried = stored(both.applyInArrow(run, CARRIED), "search-carried")
        tables.append(carried)
        if stage < STAGES - 1:
            least = _reached(carried, len(named), top)

    best_first = Window.partitionBy("item").orderBy(F.desc("score"), "doc_id")
    found = carried.select("item", F.inline(F.arrays_zip(F.col("docs").alias("doc_id"), F.col("scores").alias("score"))))
    found = found.withColumn("rank", F.row_number().over(best_first)).filter(F.col("rank") <= top)
    names = spark.createDataFrame(list(enumerate(named)), f"item int, item_id {terms.schema['item_id'].dataType.simpleString()}")
    result = stored(found.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"), "search-result")
    discard(*tables)
    return result


def rank(docs: DataFrame, items: DataFrame, top: int = 20) -> DataFrame:
    """item_id, rank, doc_id, score: the `top` documents of highest score above 0 for every item."""
    terms = stored(item_terms(items), "search-terms")
    n = _blocks(terms)
    block = F.pmod(F.xxhash64("item_id"), F.lit(n))
    parts = [_rank_block(docs, terms.filter(block == b), top) for b in range(n)]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole
