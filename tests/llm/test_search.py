import math
import random
import re

from tallyhouse.llm import search
from tests.llm.conftest import ODD


def terms(text):
    return re.findall(search.TERM, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, top):
    docs = [(i, terms(t)) for i, t in docs]
    docs = [(i, w) for i, w in docs if w]
    N, L = len(docs), sum(len(w) for _, w in docs)
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, []).extend(terms(t))
    out = []
    for item, own in wanted.items():
        scores = []
        for d, words in docs:
            m = 100 - 25 + (25 * len(words) * N) // L
            s = 0
            for t in own:
                df, tf = sum(t in w for _, w in docs), words.count(t)
                s += math.floor(1000 * math.log((2 * N + 2) / (2 * df + 1))) * ((1000000000 * tf) // (1000 * tf + 12 * m))
            if s > 0:
                scores.append((-s, d is not None, d or 0, d))
        out += [(item, k + 1, s[3], -s[0]) for k, s in enumerate(sorted(scores, key=lambda s: s[:3])[:top])]
    return sorted(out, key=str)


def got(docs, items, spark, top=20):
    table = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int")
    return sorted((tuple(r) for r in search.rank(docs, table, top).select("item_id", "rank", "doc_id", "score").collect()), key=str)


ITEMS = [(1, "no ID here"), (2, None), (3, "..."), (4, "one one a"), (4, "ça b"), (None, "one"), (5, "absent"), (6, "va x va")]
ODD_DOCS = [r for r in ODD if r[0] != 6] + [(7, "one id"), (8, "x" * 300 + " one")]


def test_odd_rows(docs, spark):
    assert got(docs(ODD_DOCS), ITEMS, spark) == brute(ODD_DOCS, ITEMS, 20)


def drawn(n_docs, n_items):
    """Zipf-like words, copies, and passages of documents as items."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    weights = [1 / (i + 1) for i in range(400)]
    docs = [(i, " ".join(rng.choices(words, weights, k=rng.randint(1, 60)))) for i in range(n_docs)]
    docs += [(1000 + i, docs[3][1]) for i in range(60)]
    items = [(i, " ".join(rng.choices(docs, k=1)[0][1].split()[:12] + rng.choices(words, weights, k=6))) for i in range(n_items)]
    return docs, items


def test_small_slices_bundles_and_blocks(docs, spark, monkeypatch):
    """Accumulators dropped on the way change nothing; copies tie and go by id."""
    rows, items = drawn(250, 16)
    want = brute(rows, items, 5)
    frame = docs(rows).repartition(3)
    monkeypatch.setattr(search, "SLICE_DOCS", 40)
    monkeypatch.setattr(search, "BUNDLE_ITEMS", 5)
    assert got(frame, items, spark, 5) == want
    monkeypatch.setattr(search, "BLOCK_TERMS", 150)
    assert got(frame, items, spark, 5) == want


def test_bounds_drop_accumulators(spark):
    """Documents that cannot reach the best ones are not carried, and the plan's bound is never below what a document gets."""
    plan = search.Plan({0: (1, 1), 1: (50, 3), 2: (90, 9), 3: (100, 30)}, [{0: 2, 1: 1, 2: 1, 3: 4}], 100, 4000, 1)
    assert plan.stage.tolist() == sorted(plan.stage.tolist()) and plan.stage[0] < plan.stage[3]
    assert (plan.later[0, :-1] >= plan.later[0, 1:]).all() and plan.later[0, -1] == 0


def test_empty(docs, spark):
    assert got(docs([]), ITEMS, spark) == []
    assert got(docs(ODD_DOCS), [], spark) == []
