import re
from collections import Counter

from tallyhouse.llm import quality
from tests.llm.conftest import ODD


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    n = Counter(windows)
    places = {p for i, x in enumerate(windows) if n[x] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(places)


def test_measurements(docs):
    rows = [*ODD, (10, "a b c a b c\na b c\na b c x"), (11, "w " * 49 + "w"), (12, "#*$ %&| <>"), (13, " ".join(map(str, range(60))))]
    got = quality.ledger(docs(rows)).collect()
    assert sorted((r.doc_id or 0, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == sorted(
        (i or 0, *brute(t)) for i, t in rows
    )


def test_long_texts_skip_the_packed_key(docs, monkeypatch):
    monkeypatch.setattr(quality, "PLACE_BITS", 3)
    text = "a b c d e f g h a b c i j k l m n a b c"
    assert quality.ledger(docs([(1, text)])).first().n_repeat_words == brute(text)[4] == 9


def test_policies_and_ablations(docs):
    good = " ".join(f"w{i}" for i in range(60))
    rows = quality.ledger(docs([(1, good), (2, "short"), (3, "a b c " * 30), (4, "# " * 10 + good), (5, "#" * 9)]))
    base = {r.doc_id: r.ok for r in quality.verdict(rows, quality.BASE, name="ok").collect()}
    assert base == {1: True, 2: False, 3: False, 4: True, 5: False}
    strict = quality.Policy("strict", 2, ("short", "symbols"))
    out = {(r.policy, r.rule): r for r in quality.ablations(rows, (quality.BASE, strict)).collect()}
    assert (out["base", "short"].n_rejected, out["base", "short"].n_only) == (3, 2)
    assert (out["strict", "symbols"].n_failing, out["strict", "symbols"].n_only) == (1, 0)
    assert out["strict", "short"].n_only == 1 and out["strict", "short"].version == 2
    assert [r.doc_id for r in quality.keep(docs([(1, good), (2, "short")])).collect()] == [1]


def test_empty(docs):
    assert quality.ledger(docs([])).collect() == []
    assert quality.ablations(quality.ledger(docs([])), (quality.BASE,)).first().n_docs == 0
