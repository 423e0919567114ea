import random
import re
from collections import Counter

import pytest

from tallyhouse.llm import phrases

SCHEMA = "doc_id long, lang string, text string, n int, word string"


def counted(rows):
    """Counts of phrases of 1 to 4 words, by lang."""
    f = Counter()
    for lang, text in rows:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            f.update((lang or "und", tuple(w[i : i + k])) for k in range(1, 5) for i in range(len(w) - k + 1))
    return f


def brute(rows, least, top):
    f, n = counted(rows), Counter()
    for (lang, p), a in f.items():
        n[lang] += a if len(p) == 1 else 0
    given = {c: a for c, a in f.items() if len(c[1]) > 1 and a >= least}
    out = {}
    for (lang, p), a in given.items():
        cuts = [(2000000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p))]
        if any(
            100 * b >= 80 * a and lang == other and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))
            for (other, q), b in given.items()
        ):
            continue
        score, _, left, right = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), left, right))
    return sorted(
        (lang, i + 1, p.decode(), -a, left, right, n[lang], -s) for lang, all_ in out.items() for i, (s, a, p, left, right) in enumerate(sorted(all_)[:top])
    )


def got(spark, rows, least, top, parts=3):
    frame = spark.createDataFrame([(i, lang, text, 1, "x") for i, (lang, text) in enumerate(rows)], SCHEMA)
    return sorted(tuple(r) for r in phrases.collocations(frame.repartition(parts) if rows else frame, least, top).collect())


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    words = ["the", "The", "of", "new", "york", "city", "Ünï", "çödé", "a", "x\x00y", "<s>", " ", "it's"] + [f"w{i}" for i in range(30)]
    weights = [9, 3, 9, 4, 4, 3, 2, 2, 5, 1, 1, 1, 1] + [1] * 30
    ends = [" ", " ", " ", " ", "  ", "\t", ", ", ".", "\n", "\r\n", "\x0b", "! "]
    texts = ["".join(w + rng.choice(ends) for w in rng.choices(words, weights, k=rng.randint(1, 80))) for _ in range(200)]
    texts += ["in new york city the sun"] * 40 + ["a a a a a a"] * 20 + ["", None, ". , ;", " \t ", "one"]
    out = [(rng.choice(["en", "de", None, "und"]), t) for t in texts]
    return out + [("en", "very long text of new york city " * 400)]


def test_like_brute(spark, rows):
    assert got(spark, rows, 5, 2000) == brute(rows, 5, 2000)
    assert got(spark, rows, 3, 7) == brute(rows, 3, 7)


def test_small_budgets(spark, rows, monkeypatch):
    """Many buckets, groups, extended pairs and stretches that end inside texts: the same counts."""
    for name, value in (("MERGED", 50), ("SEGMENT", 20), ("BUCKET_BYTES", 2000), ("GROUP_SUFFIXES", 30)):
        monkeypatch.setattr(phrases, name, value)
    assert got(spark, rows, 5, 2000) == brute(rows, 5, 2000)


def test_full_bitmaps(spark, rows, monkeypatch):
    """Marks that say nothing only make suffixes longer."""
    monkeypatch.setattr(phrases, "bitmap", lambda keys, n: (15, phrases.np.full(4096, 255, phrases.np.uint8)))
    assert got(spark, rows, 5, 2000) == brute(rows, 5, 2000)


def test_empty(spark):
    assert got(spark, [], 5, 10) == []
    assert got(spark, [("en", None), (None, "a b a b")], 3, 10) == []
