"""Ranks, tiles and running sums inside groups of any size, from one arrangement of the rows.

The rows lie in slices of a range order over (group, order, place of the row), so neither a large group nor a value that many
rows share meets in one task, and the number of slices follows from the number of rows. A slice scans its own rows.
Only its first and its last group, and the ties at its ends, can go on in other slices; what these carry over is found from
two rows a slice and joined by slice, not by value.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.operators import scratch

ROWS_PER_SLICE = 250_000


def _ntile(position: Column, size: Column, k: int) -> Column:
    """Tile of a 0-based position, as NTILE deals them out: the first tiles take one row more."""
    least, longer = F.expr(f"_size div {k}"), size % k
    in_longer = F.floor(position / (least + 1))
    return (F.when(position < longer * (least + 1), in_longer).otherwise(F.floor((position - longer) / least)) + 1).cast("int")


def in_slices(df: DataFrame, order: dict[str, bool], group: str | None, rows_per_slice: int) -> DataFrame:
    """The rows with slice (``_slice``) and place in it (``_pos``), both in the order of groups and of the rows inside them.

    The rows are stored first, with their place in the input as the last order column: it spreads equal rows over slices.
    """
    stored, _ = scratch.store(df.withColumns({"_group": F.col(group) if group else F.lit(0), "_id": F.monotonically_increasing_id()}), "segment-rows")
    slices = max(1, ceil(stored.count() / rows_per_slice))
    arrangement = [F.col("_group"), *[F.col(c).desc_nulls_last() if down else F.col(c).asc_nulls_last() for c, down in order.items()], F.col("_id")]
    placed = stored.repartitionByRange(slices, *arrangement).withColumn("_slice", F.spark_partition_id())
    # Twice as many partitions as slices: fewer slices fall into one task by their hash.
    placed = placed.repartition(2 * slices, "_slice")
    return placed.withColumn("_pos", (F.row_number().over(Window.partitionBy("_slice").orderBy(*arrangement)) - 1).cast("long"))


def segmented(df: DataFrame, order: dict[str, bool], group: str | None = None, ties: int | None = None, rank: str | None = None,
              percent: str | None = None, row: str | None = None, tiles: tuple[str, int] | None = None,
              running: tuple[str, str] | None = None, rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """``df`` with window results over ``PARTITION BY group ORDER BY order``; all rows are one group without ``group``.

    ``order`` says for each column whether it descends; NULLs come last. ``rank`` and ``percent`` name columns of SQL ``rank``
    and ``percent_rank``, where rows with equal first ``ties`` order columns (by default all of them) tie. ``row`` names the
    row number, ``tiles`` a column and the number of tiles, ``running`` a whole-number or decimal column and its running sum, which has up
    to 38 digits. Rows that are equal in the whole order follow their place in the input. Rows without a group form
    one. An empty table stays empty, with the same columns.
    """
    columns = df.columns
    tied = [F.col(c) for c in list(order)[:ties]]
    placed = in_slices(df, order, group, rows_per_slice)
    of_group, of_tie = Window.partitionBy("_slice", "_group"), Window.partitionBy("_slice", "_group", *tied)
    scanned = placed.withColumns({"_first": F.min("_pos").over(of_group), "_n": F.count(F.lit(1)).over(of_group), "_tie": F.min("_pos").over(of_tie)})
    exact = None
    if running:
        exact = f"decimal(37,{getattr(df.schema[running[0]].dataType, 'scale', 0)})"
        added = F.coalesce(F.col(running[0]), F.lit(0)).cast(exact)
        sums = F.sum(added).over(of_group.orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)).cast(exact)
        scanned = scanned.withColumns({"_upto": sums, "_all": F.sum(added).over(of_group).cast(exact)})
    else:
        scanned = scanned.withColumns({"_upto": F.lit(0), "_all": F.lit(0)})
    rows, _ = scratch.store(scanned, "segments")

    # Two rows a slice: the group and the tie at its beginning and at its end.
    key = F.struct(*[c.alias(f"t{i}") for i, c in enumerate(tied)])
    edge = F.struct(F.col("_group").alias("g"), key.alias("t"), "_first", "_n", "_tie", "_all")
    ends = rows.groupBy("_slice").agg(F.count(F.lit(1)).alias("_rows"), F.min_by(edge, "_pos").alias("_head"), F.max_by(edge, "_pos").alias("_tail"))
    ends = ends.withColumn("_start", F.sum("_rows").over(Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_rows"))
    one = F.col("_head.g").eqNullSafe(F.col("_tail.g"))
    sides = F.when(one, F.array("_tail")).otherwise(F.array("_head", "_tail"))
    each = ends.select("_slice", "_start", F.posexplode(sides).alias("_side", "e"))
    across, across_tie = Window.partitionBy("e.g"), Window.partitionBy("e.g", "e.t")
    before = across.orderBy("_slice", "_side").rowsBetween(Window.unboundedPreceding, -1)
    known = each.select("_slice", "_side", F.col("e.g").alias("g"), F.col("e.t").alias("t"), F.min(F.col("_start") + F.col("e._first")).over(across).alias("first"),
                        F.sum("e._n").over(across).alias("size"), F.coalesce(F.sum("e._all").over(before), F.lit(0)).alias("sum"))
    # The head tie's start: the earliest slice that ends in it, or the head itself.
    both = ends.select("_slice", "_start", F.posexplode(F.array("_head", "_tail")).alias("_side", "e"))
    tie_start = both.select("_slice", "_side", F.min(F.col("_start") + F.col("e._tie")).over(across_tie).alias("tie"))
    heads = tie_start.filter("_side = 0").select("_slice", F.col("tie").alias("_head_tie"))
    per_slice = known.groupBy("_slice").agg(F.min_by(F.struct("first", "size", "sum"), "_side").alias("_h"), F.max_by(F.struct("first", "size", "sum"), "_side").alias("_t"))
    carried = ends.select("_slice", "_start", F.col("_head.g").alias("_hg"), F.col("_head.t").alias("_ht"), F.col("_tail.g").alias("_tg")).join(per_slice, "_slice").join(heads, "_slice")
    carried, _ = scratch.store(carried.coalesce(1), "segment-ends")  # one row a slice

    in_head, in_tail = F.col("_group").eqNullSafe(F.col("_hg")), F.col("_group").eqNullSafe(F.col("_tg"))

    def of(side: str, local: Column) -> Column:
        return F.when(in_head, F.col(f"_h.{side}")).when(in_tail, F.col(f"_t.{side}")).otherwise(local)

    at = rows.join(F.broadcast(carried), "_slice").withColumns({
        "_from": of("first", F.col("_start") + F.col("_first")), "_size": of("size", F.col("_n")),
        "_tied": F.when(in_head & key.eqNullSafe(F.col("_ht")), F.col("_head_tie")).otherwise(F.col("_start") + F.col("_tie"))})
    position, place = F.col("_start") + F.col("_pos") - F.col("_from"), F.col("_tied") - F.col("_from")
    out: dict[str, Column] = {}
    if rank:
        out[rank] = (place + 1).cast("long")
    if percent:
        out[percent] = F.when(F.col("_size") == 1, F.lit(0.0)).otherwise(place.cast("double") / (F.col("_size") - 1).cast("double"))
    if row:
        out[row] = (position + 1).cast("long")
    if tiles:
        out[tiles[0]] = _ntile(position, F.col("_size"), tiles[1])
    if running:
        out[running[1]] = (F.col("_upto") + of("sum", F.lit(0)).cast(exact))
    return at.select(*columns, *[c.alias(n) for n, c in out.items()])
