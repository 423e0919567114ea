"""Shared operators against plain Spark forms."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyhouse.operators import keys, order_stats, ranking, scratch
from tallyhouse.operators.buckets import upsert_buckets
from tallyhouse.operators.distinct import sales_rollup
from tallyhouse.operators.order_stats import with_rank
from tallyhouse.operators.publish import rebuild, upsert
from tallyhouse.operators.ranking import Scale
from tallyhouse.sources import files
from tallyhouse.sources.tables import bucket_list, current_version


def numbers(spark, n, hot=0.4, nulls=0.1, seed=1):
    """Keys where one value holds a large share and some are missing."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        x = rnd.random()
        rows.append((f"id{i:06d}", None if x < nulls else 7 if x < nulls + hot else rnd.randint(-50, 500)))
    return spark.createDataFrame(rows, "id string, v int").repartition(5)


@pytest.mark.parametrize("n, k", [(1003, 5), (1000, 5), (3, 5), (1, 5), (17, 4)])
@pytest.mark.parametrize("descending, nulls_first", [(False, True), (False, False), (True, False), (True, True)])
def test_ntile_equals_window(spark, n, k, descending, nulls_first):
    df = numbers(spark, n)
    order = {(False, True): F.asc_nulls_first, (False, False): F.asc_nulls_last,
             (True, True): F.desc_nulls_first, (True, False): F.desc_nulls_last}[descending, nulls_first]("v")
    tiles = ranking.ntile_columns(df, "id", {"a": Scale(F.col("v"), descending, nulls_first), "b": Scale(F.col("v") % 3)}, k)
    both = df.select("id", F.ntile(k).over(Window.orderBy(order, "id")).alias("w"),
                     F.ntile(k).over(Window.orderBy(F.expr("v % 3").asc_nulls_last(), F.col("id"))).alias("w2"), tiles["a"].alias("t"), tiles["b"].alias("t2"))
    assert both.filter("w <> t OR w2 <> t2").count() == 0


def test_ntile_of_nothing(spark):
    empty = numbers(spark, 4).filter("v > 9999")
    assert empty.withColumns(ranking.ntile_columns(empty, "id", {"a": Scale(F.col("v"))})).count() == 0


def test_global_row_number_and_running_sum(spark):
    df = numbers(spark, 2000, nulls=0.0)
    order = [F.col("v"), F.col("id")]
    w = Window.orderBy(*order)
    want = {r.id: (r.rn, r.s) for r in df.select("id", F.row_number().over(w).alias("rn"), F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("s")).collect()}
    rn = {r.id: r.row_number for r in ranking.global_row_number(df, order).collect()}
    rs = {r.id: r.running_sum for r in ranking.global_running_sum(df, order, "v").collect()}
    assert {k: (rn[k], int(rs[k])) for k in want} == want


def test_latest_per_key_limits_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")], "k string, t int, v string")
    out = keys.latest_per_key(df, "k", F.desc("t"))
    assert sorted(tuple(r) for r in out.collect()) == [("a", 2, "y"), ("b", 1, "z")]
    big = keys.latest_per_key(numbers(spark, 100), "v", F.desc("id"))
    plan = big._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # once per map task, once after the shuffle


def test_known_and_parent_keys_with_nulls(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    known = spark.createDataFrame([("a",), (None,)], "k string")
    assert sorted(str(r.k) for r in keys.without_known(df, known, "k").collect()) == ["None", "b"]
    assert [r.k for r in keys.with_parent(df, known, "k").collect()] == ["a"]
    assert [r.k for r in keys.orphans(df, known, "k").collect()] == ["b"]


def test_sales_rollup_equals_distinct_counts(spark):
    rnd = random.Random(3)
    rows = []
    for o in range(400):
        customer = f"c{0 if rnd.random() < 0.35 else rnd.randint(1, 30)}"  # one customer has a third of the orders
        if rnd.random() < 0.05:
            customer = None
        rows += [(f"o{o}", customer, rnd.choice("xyz"), rnd.randint(1, 9)) for _ in range(rnd.randint(1, 5))]
    df = spark.createDataFrame(rows, "order_id string, customer_id string, g string, q int")
    got = sales_rollup(df, ["g"], {"q": F.col("q")}).select("g", "orders", "customers", "q")
    want = df.groupBy("g").agg(F.count_distinct("order_id").alias("orders"), F.count_distinct("customer_id").alias("customers"), F.sum("q").alias("q"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    total = sales_rollup(df, [], {"q": F.col("q")}).first()
    assert (total.orders, total.customers) == tuple(df.agg(F.count_distinct("order_id"), F.count_distinct("customer_id")).first())


def test_upsert_replaces_adds_and_keeps(spark, lake):
    first = spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int")
    rebuild(lake, "silver", "t", first)
    out = upsert(lake, "silver", "t", spark.createDataFrame([("b", 2), ("c", 2)], "k string, v int"), "k")
    assert sorted(map(tuple, out.collect())) == [("a", 1), ("b", 2), ("c", 2)]
    assert current_version(spark, lake.path("silver", "t")).endswith("v=00000002")


def test_unfinished_version_is_not_read(spark, lake, tmp_path):
    rebuild(lake, "silver", "t", spark.range(3))
    broken = tmp_path / "lake" / "silver" / "t" / "v=00000002"
    broken.mkdir()
    assert lake.read("silver", "t").count() == 3
    assert rebuild(lake, "silver", "t", spark.range(4)).count() == 4
    assert current_version(spark, lake.path("silver", "t")).endswith("v=00000003")


def test_shared_folder_follows_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    df, path = scratch.store(spark.range(5), "x")
    assert path.startswith(named) and df.count() == 5
    scratch.discard(spark, path)
    assert not files.exists(spark, path)


def test_few_partitions_of_a_hot_month_are_split(spark, lake):
    rows = spark.range(20000).withColumn("m", F.when(F.col("id") % 3 == 0, F.col("id") % 20).otherwise(-1))
    out = rebuild(lake, "gold", "f", rows, partition_by="m", sort_by="id")
    assert out.count() == 20000 and out.select("m").distinct().count() == 21


def test_scope_leaves_nothing_behind(spark, tmp_path):
    rows = spark.range(500).selectExpr("id", "cast(id % 7 as decimal(18,6)) / 3 as v").withColumn("v", F.col("v").cast("decimal(18,6)"))
    top = scratch.new_path(spark, "probe").rpartition("/")[0]
    before = files.child_names(spark, top)
    with scratch.scope(spark):
        ranking.global_row_number(rows, [F.col("v"), F.col("id")]).collect()
        ranking.global_running_sum(rows, [F.col("id")], "v").collect()
    ranking.ntile_columns(rows, "id", {"a": Scale(F.col("v"))})
    with pytest.raises(RuntimeError), scratch.scope(spark):
        scratch.store(rows, "x")
        raise RuntimeError
    assert files.child_names(spark, top) == before


def test_keys_keep_all_their_decimals(spark):
    rows = spark.createDataFrame([(i, f"1.0000{i}") for i in (3, 1, 4, 2)], "id int, t string").selectExpr("id", "cast(t as decimal(18,6)) as v", "1 + id / 1e9 as d")
    tiles = ranking.ntile_columns(rows, "id", {"a": Scale(F.col("v")), "b": Scale(F.col("d"), descending=True), "c": Scale(F.col("id"), descending=True)}, 4)
    got = sorted(tuple(r) for r in rows.select("id", tiles["a"], tiles["b"], tiles["c"]).collect())
    assert got == [(1, 1, 4, 4), (2, 2, 3, 3), (3, 3, 2, 2), (4, 4, 1, 1)]


def test_ranks_of_missing_values_and_groups(spark):
    rows = spark.createDataFrame([("a", 1, "x"), ("b", 3, "x"), ("c", None, "x"), ("d", 2, None), ("e", 5, None)], "id string, v int, g string")
    got = {r.id: (r.rank, r.percent_rank) for r in with_rank(rows, "v", "g").collect()}
    assert got == {"b": (1, 0.0), "a": (2, 0.5), "c": (3, 1.0), "e": (1, 0.0), "d": (2, 1.0)}


def test_upsert_rewrites_only_touched_buckets(spark, lake):
    rows = spark.range(4000).selectExpr("cast(id as string) as k", "id as v")
    upsert_buckets(lake, "silver", "t", rows, "k", rows_per_bucket=100)
    path = lake.path("silver", "t")
    before = bucket_list(spark, current_version(spark, path))
    assert before["buckets"] == 40 and sum(before["rows"].values()) == 4000
    out = upsert_buckets(lake, "silver", "t", spark.createDataFrame([("7", -1), ("new", -2)], "k string, v long"), "k", rows_per_bucket=100)
    after = bucket_list(spark, current_version(spark, path))
    changed = [b for b in after["folders"] if after["folders"][b] != before["folders"].get(b)]
    assert 1 <= len(changed) <= 2 and out.count() == 4001
    assert {r.k: r.v for r in out.filter("v < 0").collect()} == {"7": -1, "new": -2}
    # Only listed folders are kept, those of the last two versions.
    upsert_buckets(lake, "silver", "t", spark.createDataFrame([("8", -3)], "k string, v long"), "k", rows_per_bucket=100)
    kept = {f"{path}/data/{b}/{n}" for b in files.child_names(spark, f"{path}/data") for n in files.child_names(spark, f"{path}/data/{b}") if n.startswith("_bucket=")}
    versions = [bucket_list(spark, f"{path}/{n}") for n in files.child_names(spark, path) if n.startswith("v=")]
    assert len(versions) == 2 and kept == {f for v in versions for f in v["folders"].values()}


def test_upsert_grows_converts_and_survives_failure(spark, lake):
    rebuild(lake, "silver", "t", spark.range(10).selectExpr("id as k", "id as v"))
    out = upsert_buckets(lake, "silver", "t", spark.range(5, 300).selectExpr("id as k", "-id as v"), "k", rows_per_bucket=50)
    assert out.count() == 300 and out.agg(F.sum("v")).first()[0] == sum(range(5)) - sum(range(5, 300))
    grown = upsert_buckets(lake, "silver", "t", spark.range(300, 1200).selectExpr("id as k", "id as v"), "k", rows_per_bucket=50)
    assert grown.count() == 1200 and bucket_list(spark, current_version(spark, lake.path("silver", "t")))["buckets"] == 24
    bad = spark.range(3).selectExpr("id as k", "raise_error('no') as v").withColumn("v", F.col("v").cast("long"))
    with pytest.raises(Exception):
        upsert_buckets(lake, "silver", "t", bad, "k", rows_per_bucket=50)
    assert lake.read("silver", "t").count() == 1200
    assert upsert_buckets(lake, "silver", "t", spark.range(0).selectExpr("id as k", "id as v"), "k").count() == 1200
    assert upsert_buckets(lake, "silver", "none", spark.range(0).selectExpr("id as k", "id as v"), "k").count() == 0


@pytest.mark.parametrize("few", [50_000, 10])
def test_quantiles_equal_a_sorted_list(spark, monkeypatch, few):
    monkeypatch.setattr(order_stats, "FEW_ROWS", few)
    rnd = random.Random(6)
    values = [0.0] * 300 + [rnd.gauss(0, 1) for _ in range(400)] + [1e9, -1e9, 3.5, 3.5] + [rnd.random() * 1e-6 for _ in range(300)]
    rows = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    ps = [0, 0.01, 0.25, 0.333, 0.5, 0.75, 0.999, 1]
    ordered = sorted(values)
    want = []
    for p in ps:
        h = p * (len(values) - 1)
        low = ordered[int(h)]
        want.append(low + (ordered[min(int(h) + 1, len(values) - 1)] - low) * (h - int(h)))
    assert order_stats.exact_quantiles(rows, "v", ps) == pytest.approx(want)
    assert order_stats.exact_quantiles(rows.filter("v IS NULL"), "v", [0.5]) == [None]


@pytest.mark.parametrize("margin", [order_stats.MARGIN, 0.0])
def test_group_quantiles_equal_sorted_lists(spark, monkeypatch, margin):
    """Also where the bounds miss the places (no margin, coarse sketches), and a group holds a third of the rows."""
    monkeypatch.setattr(order_stats, "MARGIN", margin)
    monkeypatch.setattr(order_stats, "SKETCH", 1600 if margin else 8)
    rnd = random.Random(7)
    groups = {"hot": [rnd.gauss(0, 1) for _ in range(3000)], "same": [2.5] * 500, "wide": [1e300, -1e300, 0.0] + [rnd.random() * 1e-9 for _ in range(800)],
              None: [1.0, 2.0, 4.0], "one": [7.0]} | {f"g{i}": [float(rnd.randint(0, 9)) for _ in range(i)] for i in range(1, 40)}
    rows = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs] + [("hot", None), ("none", None), ("hot", float("nan"))], "g string, v double")
    ps = {"low": 0.0, "q1": 0.25, "third": 0.333, "median": 0.5, "most": 0.999, "high": 1.0}
    got = {r.g: r for r in order_stats.group_quantiles(rows.repartition(5), "v", "g", ps).collect()}
    assert set(got) == set(groups)
    for g, vs in groups.items():
        ordered = sorted(vs)
        for name, p in ps.items():
            h = p * (len(vs) - 1)
            low, high = ordered[int(h)], ordered[min(int(h) + 1, len(vs) - 1)]
            assert got[g][name] == pytest.approx(low + (high - low) * (h - int(h))) and got[g].n == len(vs)
    assert order_stats.group_quantiles(rows.filter("v IS NULL"), "v", "g", ps).collect() == []


def test_shuffles_follow_the_rows(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with scratch.partitions_for(spark, 10_000_001):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "41"
        with scratch.partitions_for(spark, 5):
            assert spark.conf.get("spark.sql.shuffle.partitions") == "41"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    with pytest.raises(ValueError), scratch.partitions_for(spark, 10_000_001):
        raise ValueError
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
