import random
import re

import pytest
import xxhash

from tallyhouse.llm import simhash
from tallyhouse.llm.components import components
from tests.llm.conftest import ODD


def fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(prints):
    """Smallest reachable id of each (id, fingerprint), by union of all pairs."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i][1] ^ prints[j][1]).bit_count() <= 2:
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(prints):
        if doc is not None:
            least[find(i)] = min(least.get(find(i), doc), doc)
    return [least.get(find(i)) for i in range(len(prints))]


def test_fingerprints_long_and_odd():
    texts = [t for _, t in ODD] + ["Ä A b", "one two", "a b c\x0bd\te", "w" * (1 << 20), " ".join(f"w{i % 977}" for i in range(300_000))]
    assert [simhash.fingerprint(t) for t in texts] == [fingerprint(t) for t in texts]


def test_groups(docs):
    rng = random.Random(5)
    rows = list(ODD)
    for i in range(60):
        words = [rng.choice("abcdefghijkl") * rng.randint(1, 3) for _ in range(rng.randint(30, 200))]
        for j in range(rng.randint(1, 4)):
            rows.append((100 + 10 * i + j, " ".join(words)))
            words[rng.randrange(len(words))] = "new"
    prints = [(i, fingerprint(t)) for i, t in rows]
    want = sorted((i or 0, f"{f:016x}", c or 0) for (i, f), c in zip(prints, brute_components(prints), strict=True))
    got = simhash.groups(docs(rows)).collect()
    assert sorted((r.doc_id or 0, r.fingerprint, r.component_id or 0) for r in got) == want


@pytest.mark.parametrize("small", [50, 1])
def test_links_find_all_components(spark, monkeypatch, small):
    """Clouds of near fingerprints: compared in pairs, or (small = 1) through one-bit changes only."""
    monkeypatch.setattr(simhash, "SMALL", small)
    rng = random.Random(9)
    prints = set()
    for _ in range(40):
        base = rng.getrandbits(64)
        for _ in range(rng.randint(1, 60)):
            prints.add(base)
            for _ in range(rng.randint(1, 2)):
                base ^= 1 << rng.randrange(64)
            if rng.random() < 0.1:
                base ^= 0b111 << rng.randrange(61)
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    frame = spark.createDataFrame([(p,) for p in signed], "fp long")
    found = {r.node: r.component for r in components(simhash.links(frame)).collect()}
    got, want = {}, {}
    for p, s, c in zip(prints, signed, brute_components([(p, p) for p in prints]), strict=True):
        got.setdefault(found.get(s, s), set()).add(p)
        want.setdefault(c, set()).add(p)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_keep_one(docs):
    text = " ".join(f"word{i}" for i in range(80))
    rows = [(5, text), (3, text), (3, text), (9, text + " "), (7, "something else entirely"), (None, text), (8, None), (6, "")]
    assert sorted((r.doc_id, r.text) for r in simhash.keep_one(docs(rows)).collect()) == [(3, text), (6, ""), (7, "something else entirely")]
    kept = simhash.keep_one(docs([(None, "only one"), (None, "only one")]))
    assert kept.columns == ["doc_id", "text", "n_words", "key"] and kept.count() == 1


def test_empty(docs):
    assert simhash.groups(docs([])).collect() == [] and simhash.keep_one(docs([])).collect() == []


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(None, 3), (5, 5)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 201)}, **{1000 + i: 1000 for i in range(1, 300)}}
