"""Facts with the version of their day."""

import datetime as dt

from tallyhouse.operators.history import as_of_join


def day(n):
    return dt.date(2024, 1, n)


def test_version_of_the_day(spark):
    """Gaps, versions of one day, an open end, overlaps, unknown and missing keys and days."""
    history = spark.createDataFrame(
        [("a", day(1), day(3), "x"), ("a", day(5), day(5), "y"), ("a", day(5), None, "z"), ("b", day(2), None, "p"), ("b", day(4), day(6), "q"),
         ("c", day(9), day(8), "never"), (None, day(1), None, "nobody")], "k string, valid_from date, valid_to date, v string")
    facts = [(1, "a", day(1)), (2, "a", day(3)), (3, "a", day(4)), (4, "a", day(5)), (5, "a", day(9)), (6, "b", day(1)), (7, "b", day(5)), (8, "b", day(7)),
             (9, "c", day(9)), (10, "d", day(1)), (11, None, day(1)), (12, "a", None), (13, "a", day(1))]
    got = as_of_join(spark.createDataFrame(facts, "id int, k string, d date"), history, "k", "d", {"v": "then"})
    assert got.columns == ["id", "k", "d", "then"]
    assert {r.id: r.then for r in got.collect()} == {1: "x", 2: "x", 3: None, 4: "z", 5: "z", 6: None, 7: "q", 8: "p", 9: None, 10: None, 11: None, 12: None, 13: "x"}
    assert got.count() == len(facts)


def test_no_range_condition_in_the_join(spark):
    history = spark.createDataFrame([("a", day(1), None, "x")], "k string, valid_from date, valid_to date, v string")
    facts = spark.createDataFrame([(1, "a", day(2))], "id int, k string, d date")
    plan = as_of_join(facts, history, "k", "d", {"v": "then"})._jdf.queryExecution().optimizedPlan().toString()
    join = next(line for line in plan.splitlines() if "Join" in line)
    assert "<" not in join and ">" not in join
