import hashlib
import random
import re
from collections import Counter

import pytest

from tallyhouse.llm import repeats
from tests.llm.conftest import ODD


def brute(rows, length):
    seen = Counter((t or "").encode()[i : i + length] for _, t in rows for i in range(len((t or "").encode()) - length + 1))
    out = []
    for doc, t in rows:
        b = (t or "").encode()
        covered = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                covered[i : i + length] = b"\1" * length
        kept = bytes(x for x, c in zip(b, covered, strict=True) if not c)
        spans = [[m.start(), m.end()] for m in re.finditer(rb"\x01+", bytes(covered))]
        out.append((doc or 0, len(b), sum(covered), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def corpus():
    rng = random.Random(11)
    prose = lambda n: " ".join(rng.choice("the of and to in that was for on are with as his they be at one have this".split()) + str(rng.randrange(60)) for _ in range(n))
    shared = [prose(60) for _ in range(6)] + ["é" * 130, "ab" * 150]
    rows = [r for r in ODD if r[0] not in (5, 6)] + [(5, "a b " * 300), (6, "x" * 900)]
    for i in range(60):
        parts = [prose(rng.randint(1, 40))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(shared)
            cut = rng.randrange(len(p) // 2)
            parts += [p[cut : cut + rng.randint(150, 420)], prose(rng.randint(0, 20))]
        rows.append((100 + i, " ".join(parts)))
    return [*rows, (200, rows[-1][1]), (201, rows[-2][1][:-1]), (202, "q" + rows[-3][1])]


@pytest.mark.parametrize("crowded", [500, 3, 0])
def test_against_brute_force(docs, monkeypatch, crowded):
    """Groups compared through the interval tree, and taken apart into window hashes."""
    monkeypatch.setattr(repeats, "CROWDED", crowded)
    rows = corpus()
    got = [tuple(r) for r in repeats.remove_repeats(docs(rows)).collect()]
    assert sorted((i or 0, n, k, s, d) for i, n, k, s, d in got) == brute(rows, 200)


def test_pieces_of_long_texts(docs, monkeypatch):
    monkeypatch.setattr(repeats, "PIECE", 300)
    rows = corpus()[:40]
    got = [tuple(r) for r in repeats.remove_repeats(docs(rows)).collect()]
    assert sorted((i or 0, n, k, s, d) for i, n, k, s, d in got) == brute(rows, 200)


def test_maximal_repeats():
    whole = ["xxabcdefgh|tail1", "yyabcdefgh|tail2", "zzzbcdefgh|other", "--------cd"]
    anchored = [(w[: w.index("cd")][::-1].encode(), w[w.index("cd") :].encode()) for w in whole]
    before, after = [a for a, _ in anchored], [b for _, b in anchored]
    found = {(left, right, tuple(sorted(m))) for left, right, m in repeats.maximal_repeats(before, after, 6)}
    # "abcdefgh|tail" in 0 and 1; "bcdefgh|" in 0, 1 and 2 is found with all its occurrences.
    assert (2, 11, (0, 1)) in found and (1, 7, (0, 1, 2)) in found


def test_filter_has_no_false_negatives(spark):
    hashes = [random.Random(3).getrandbits(64) - (1 << 63) for _ in range(1)] + [(i * 0x9E3779B97F4A7C15 & (1 << 64) - 1) - (1 << 63) for i in range(3000)]
    found = repeats._filter_of(spark.createDataFrame([(h,) for h in hashes], "h long"), len(hashes))
    assert all(found.has(h) for h in hashes)
    assert sum(found.has(h + 1) for h in hashes) < 200


def test_empty(docs):
    assert repeats.remove_repeats(docs([])).collect() == []
