import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import sharding
from tests.llm.conftest import ODD


def check(rows, got, shards):
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.size, r.text_crc32) for r in got) == sorted(
        (-1 if i is None else i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows
    )
    slots = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(shards))


def test_odd_rows(odd):
    check(ODD, sharding.pack(odd, shards=3).collect(), 3)


def test_empty(docs):
    assert sharding.pack(docs([]), shards=4).collect() == []


@pytest.mark.parametrize("cell", [20_000, 100])
def test_balance_groups_and_a_hot_group(docs, monkeypatch, cell):
    monkeypatch.setattr(sharding, "CELL_GROUPS", cell)
    rng = np.random.default_rng(1)
    rows = [(i, f"{i} " + "word " * int(rng.integers(1, 60))) for i in range(6000)]
    rows += [(10_000 + i, f"pair {i % 200} of equal texts") for i in range(600)]
    rows += [(20_000 + i, "hot text " * 20) for i in range(3000)]
    got = sharding.pack(docs(rows), shards=8).collect()
    check(rows, got, 8)
    text = dict(rows)
    for of, most in ((lambda r: r.size, 0.01), (lambda r: r.tokens, 0.06), (lambda r: 1, 0.1)):
        sums = np.zeros(8)
        for r in got:
            sums[r.shard] += of(r)
        assert (sums.max() - sums.min()) / sums.mean() < most
    homes = {}
    for r in got:
        homes.setdefault(text[r.doc_id], set()).add(r.shard)
    assert all(len(h) == 1 for t, h in homes.items() if not t.startswith("hot")) and len(homes["hot text " * 20]) > 1


@pytest.mark.parametrize("large", [400, 40])
def test_large_light_groups_in_many_cells(docs, monkeypatch, large):
    """Groups just under the heavy bound, beside cells whose share of a shard is smaller than they are."""
    monkeypatch.setattr(sharding, "CELL_GROUPS", 20)
    rng = np.random.default_rng(2)
    rows = [(i, f"{i} " + "x" * int(rng.integers(1, 30))) for i in range(12_000)]
    shard = sum(len(t) + 8 for _, t in rows) / 4 / (1 - large / 4 / 256)
    rows += [(20_000 + i, f"{i:05d} ".ljust(int(shard / 256) - 9, "y")) for i in range(large)]
    got = sharding.pack(docs(rows), shards=4).collect()
    check(rows, got, 4)
    sums = np.zeros(4)
    for r in got:
        sums[r.shard] += r.size
    assert (sums.max() - sums.min()) / sums.mean() < 0.02


def test_place():
    residual = np.array([[0.5, 0.1], [0.2, 0.9], [0.9, 0.05]])
    assert sharding.place(np.array([0.1, 0.1]), residual) == 1
    assert sharding.place(np.array([0.3, 0.01]), residual) == 2
    assert sharding.place(np.array([0.3, 0.9]), residual) == 2  # 1 has most to offer, but not the bytes
    assert sharding.place(np.array([2.0, 0.2]), residual) == 2


def test_repeated(docs):
    rows = [(1, "a"), (1, "a"), (None, "a")]
    assert sharding.pack(docs(rows), shards=2).agg(F.count("*")).first()[0] == 3
