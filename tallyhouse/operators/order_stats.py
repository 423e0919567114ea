"""Exact ranks and quantiles over all rows or large groups.

Neither a large group nor a value that a third of the rows share comes into one task: ranks scan slices of a range order
(``operators.segments``), quantiles count values; those of many groups at once count them inside bounds that sketches give.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import ROUND_FLOOR, Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.operators import scratch
from tallyhouse.operators.segments import segmented


def with_rank(df: DataFrame, value: str, group: str | None = None, rank: str = "rank", percent: str = "percent_rank") -> DataFrame:
    """SQL ``rank`` and ``percent_rank`` by descending value, over all rows or inside each group.

    NULL values come last, and rows without a group form a group.
    """
    return segmented(df, {value: True}, group, rank=rank, percent=percent)


# Bins of a histogram pass, and so many rows of one bin at most come to the driver, as values with counts.
BINS, FEW_ROWS = 1024, 50_000


def exact_quantiles(df: DataFrame, value: str, probabilities: Sequence[float]) -> list[float | None]:
    """Linear-interpolated quantiles of a numeric column, NULLs left out.

    Nothing is sorted: a histogram finds the bins that hold the wanted positions, and a histogram of such a bin
    follows until few rows or one value are left. The column is stored first, so a pass is a scan of it.
    """
    with scratch.scope(df.sparkSession):
        values, _ = scratch.store(df.select(F.col(value).cast("double").alias("v")).filter("v IS NOT NULL"), "quantiles")
        total, low, high = values.agg(F.count("v"), F.min("v"), F.max("v")).first()
        if not total:
            return [None] * len(probabilities)
        points = [Decimal(str(p)) * (total - 1) for p in probabilities]
        floors = [int(h.to_integral_value(ROUND_FLOOR)) for h in points]
        wanted = sorted({min(i + step, total - 1) for i in floors for step in (0, 1)})
        spots = _values_at(values, wanted, low, high, 0, total)
    return [spots[i] + (spots.get(i + 1, spots[i]) - spots[i]) * float(h - i) for h, i in zip(points, floors)]


def _values_at(values: DataFrame, places: list[int], low: float, high: float, before: int, count: int) -> dict[int, float]:
    """The values at 0-based places of the sorted column; all lie in [low, high], which ``before`` values precede."""
    if low == high:
        return dict.fromkeys(places, low)
    inside = values.filter(F.col("v").between(low, high))
    if count <= FEW_ROWS or (high - low) / BINS == 0:
        found, at = {}, before
        for v, n in sorted(tuple(r) for r in inside.groupBy("v").count().collect()):
            found.update((p, v) for p in places if at <= p < at + n)
            at += n
        return found
    bin_of = F.least(F.floor((F.col("v") - low) / ((high - low) / BINS)), F.lit(BINS - 1))
    found, at = {}, before
    for _, n, first, last in sorted(tuple(r) for r in inside.groupBy(bin_of.alias("bin")).agg(F.count("v"), F.min("v"), F.max("v")).collect()):
        here = [p for p in places if at <= p < at + n]
        if here:
            found.update(_values_at(values, here, first, last, at, n))
        at += n
    return found


# Size of the sketches, and how far (as a share of the rows) a bound lies from the wanted place: three times their usual error.
SKETCH, MARGIN = 1600, 0.006


def group_quantiles(df: DataFrame, value: str, group: str, quantiles: Mapping[str, float]) -> DataFrame:
    """One row a group: its number of values (``n``) and exact linear-interpolated quantiles, by column name.

    Two passes over the stored column, whatever the range of its values and the number of groups. The first builds a mergeable sketch
    a group, which gives bounds around each wanted place; the second counts the values below the bounds and each value
    inside them. Running counts (``operators.segments``) then show the value at the place. Both passes aggregate before
    they shuffle. A sketch errs beyond its margin now and then: the counts show that, and such groups are counted again without bounds.

    NULL and NaN are no values; a group without values has no row, and rows without a group are one.
    """
    wanted = list(quantiles.items())
    values, _ = scratch.store(df.select(F.col(group).alias("g"), F.col(value).cast("double").alias("v")).filter("v IS NOT NULL AND NOT isnan(v)"), "group-values")
    sketched, _ = scratch.store(values.groupBy("g").agg(
        F.count("v").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"), F.kll_sketch_agg_double("v", SKETCH).alias("sketch")), "group-sketches")

    def bound(share: float, end: str):
        return F.col(end) if not 0 < share < 1 else F.kll_sketch_get_quantile_double("sketch", F.lit(share))

    def places(bounds: list) -> DataFrame:
        each = []
        for i, ((_, p), (low, high)) in enumerate(zip(wanted, bounds, strict=True)):
            at = F.lit(Decimal(str(p))) * (F.col("n") - 1).cast("decimal(20,0)")
            each.append(F.struct(F.lit(i).alias("i"), low.alias("low"), high.alias("high"), F.floor(at).cast("long").alias("place"),
                                 (at - F.floor(at)).cast("double").alias("share")))
        return sketched.select("g", "n", F.array(*each).alias("wanted"))

    bounded = places([(bound(p - MARGIN, "low"), bound(p + MARGIN, "high")) for _, p in wanted])
    found, _ = scratch.store(_counted(values, bounded), "group-quantiles")
    missed = found.filter("a IS NULL OR b IS NULL").select("g").distinct()
    if not missed.isEmpty():
        again = missed.select(F.col("g").alias("_g"))
        same = F.col("g").eqNullSafe(F.col("_g"))
        wide = places([(F.col("low"), F.col("high"))] * len(wanted)).join(again, same, "left_semi")
        recounted = _counted(values.join(again, same, "left_semi"), wide)
        found = found.join(again, same, "left_anti").unionByName(recounted)
    result = F.col("a") + (F.col("b") - F.col("a")) * F.col("share")
    return found.groupBy("g").agg(F.max("n").alias("n"), *[F.max(F.when(F.col("i") == i, result)).alias(name) for i, (name, _) in enumerate(wanted)]) \
        .withColumnRenamed("g", group)


def _counted(values: DataFrame, wanted: DataFrame) -> DataFrame:
    """For each group and place the values there (``a``) and at the next place (``b``); NULL where the bounds miss them."""
    bounds = wanted.select(F.col("g").alias("_g"), "wanted")
    met = values.join(bounds, F.col("g").eqNullSafe(F.col("_g"))).select("g", "v", F.explode("wanted").alias("w")).filter("v <= w.high")
    inside = F.col("v") >= F.col("w.low")
    counts = met.groupBy("g", F.col("w.i").alias("i"), inside.alias("inside"), F.when(inside, F.col("v")).alias("v")).agg(F.count(F.lit(1)).alias("times"))
    running = segmented(counts.withColumn("key", F.struct("g", "i")), {"inside": False, "v": False}, "key", running=("times", "upto"))
    places = wanted.select(F.col("g").alias("_g"), "n", F.explode("wanted").alias("w")).select(
        "_g", "n", F.col("w.i").alias("_i"), F.col("w.place").alias("place"), F.col("w.share").alias("share"))
    here = running.filter("inside").join(places, F.col("g").eqNullSafe(F.col("_g")) & (F.col("i") == F.col("_i")), "right")
    after = F.least(F.col("place") + 1, F.col("n") - 1)

    def at(place):
        return F.max(F.when((F.col("upto") - F.col("times") <= place) & (place < F.col("upto")), F.col("v")))

    return here.groupBy(F.col("_g").alias("g"), F.col("_i").alias("i")).agg(
        F.max("n").alias("n"), F.max("share").alias("share"), at(F.col("place")).alias("a"), at(after).alias("b"))
