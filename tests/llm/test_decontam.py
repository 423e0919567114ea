import re

from tallyhouse.llm import chunks, decontam
from tests.llm.conftest import ODD

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text):
    return re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, window=10):
    out = []
    for i, t in docs:
        w, hit, ids = words(t), set(), set()
        for item, x in items:
            p = words(x)
            n = min(window, len(p))
            for k in range(len(p) - n + 1 if n and item is not None else 0):
                for at in range(len(w) - n + 1):
                    if w[at : at + n] == p[k : k + n]:
                        hit |= set(range(at, at + n))
                        ids.add(item)
        out.append((i or 0, len(w), len(hit), len(ids), decontam.sha256_of(list(ids)), bool(hit)))
    return sorted(out)


ITEMS = [
    (1, "The quick brown fox jumps over the lazy dog and runs away"), (2, "short item"), (3, "Ünï çödé"), (10, "one"), (4, None), (5, "..."),
    (6, "a a a a a a a a a a a a"), (7, "short item"), (None, "no id here"),
]
DOCS = [
    *[r for r in ODD if r[0] != 5], (5, "a b " * 50), (20, "THE quick-brown fox; jumps over the lazy dog and RUNS"), (21, "a " * 25 + "b"), (22, "short Item, short item?"),
    (23, "x ünï ÇÖDÉ"), (24, "Ünï çödé one two"), (25, "quick brown fox jumps over the lazy dog and"),
]


def test_report(docs, spark, monkeypatch):
    bench = spark.createDataFrame([(i, t, "z") for i, t in ITEMS], "item_id long, text string, n_words string")
    for block in (500_000, 12):  # all items at once, and a pass for every few words
        monkeypatch.setattr(decontam, "BLOCK_WORDS", block)
        got = sorted((r.doc_id or 0, *r[1:]) for r in decontam.report(docs(DOCS), bench).collect())
        assert got == brute(DOCS, ITEMS)
        clean = decontam.keep_clean(docs(DOCS), bench)
        assert sorted(r.doc_id or 0 for r in clean.collect()) == sorted(r[0] for r in brute(DOCS, ITEMS) if not r[5])
        assert clean.columns == ["doc_id", "text", "n_words", "key"]


def test_empty(docs, spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontam.report(docs([]), none).collect() == []
    assert [r.n_hit for r in decontam.report(docs([(1, "a b")]), none).collect()] == [0]
    assert decontam.keep_clean(docs([(1, "a b")]), none).count() == 1


def test_long_texts_in_chunks(monkeypatch):
    """Chunks of a few words; hits across their ends, and counts, are as in one go."""
    monkeypatch.setattr(chunks, "LONG_TEXT", 10)
    for n in (10, 13, 64):
        monkeypatch.setattr(chunks, "WORDS", n)
        text = " ".join(f"w{i}" for i in range(5)) + " The quick brown fox jumps over the lazy dog and runs away " + "x y z " * 9 + "one two"
        rows = [(1, text), (2, text + " " + text), (3, "a " * 40), (4, "nothing of it " * 12), (5, "")]
        patterns = decontam.Patterns([(i, decontam.words_of(t)) for i, t in ITEMS if i is not None], 10)
        for i, t in rows:
            n_words, hit, ids = 0, set(), set()
            for at, k, who in patterns.occurrences(t, 10):
                n_words = n_words if k else at
                hit |= set(range(at, at + k))
                ids |= who
            assert [(i, n_words, len(hit), len(ids), decontam.sha256_of(list(ids)), bool(hit))] == brute([(i, t)], ITEMS)
