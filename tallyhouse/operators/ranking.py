"""Global ranking without a single-task window.

``row_number() OVER (ORDER BY …)`` or ``ntile`` with no PARTITION BY moves every row to one task.
Here the rows are range-partitioned and sorted in parallel, stored once, and only the partition sizes
(one row per partition) come to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.operators import scratch

_SEQ_MASK = (1 << 33) - 1  # low bits of monotonically_increasing_id(): position inside the partition


def _arranged(df: DataFrame, order: Sequence[Column], label: str) -> tuple[DataFrame, str]:
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return scratch.store(
        placed.withColumns({
            "_part": F.spark_partition_id(),
            "_pos": F.monotonically_increasing_id().bitwiseAND(F.lit(_SEQ_MASK)),
        }),
        label,
    )


def global_row_number(df: DataFrame, order: Sequence[Column], name: str = "row_number") -> DataFrame:
    """1-based position of every row in a total order. ``order`` must end in a unique key."""
    rows, _ = _arranged(df, order, "ranked")
    spark = df.sparkSession
    sizes = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).orderBy("_part").collect()
    starts, total = [], 0
    for r in sizes:
        starts.append((r["_part"], total))
        total += r["n"]
    # One row per partition: bounded by the partition count, not by the data.
    offsets = spark.createDataFrame(starts, "_part int, _start long")
    return (
        rows.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_start") + F.col("_pos") + 1)
        .drop("_part", "_pos", "_start")
    )


def global_running_sum(df: DataFrame, order: Sequence[Column], value: str, name: str = "running_sum") -> DataFrame:
    """Running total of a whole-number or decimal column over a total order, with all its decimals.

    The sum inside each range partition plus the sum of those before it. The total has up to 38 digits.
    """
    rows, _ = _arranged(df, order, "running")
    sizes = rows.groupBy("_part").agg(F.sum(value).alias("s")).orderBy("_part").collect()
    starts, total = [], 0
    for r in sizes:
        starts.append((r["_part"], Decimal(total)))
        total += r["s"] or 0
    scale = getattr(df.schema[value].dataType, "scale", 0)
    # One digit less on both sides of the sum leaves its type all the decimals.
    exact = f"decimal(37,{scale})"
    offsets = df.sparkSession.createDataFrame(starts, f"_part int, _start {exact}")
    inside = Window.partitionBy("_part").orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    return (
        rows.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_start") + F.coalesce(F.sum(value).over(inside), F.lit(0)).cast(exact))
        .drop("_part", "_pos", "_start")
    )


@dataclass(frozen=True)
class Scale:
    """One ranking: a numeric sort key, its direction and where NULLs go."""

    key: Column
    descending: bool = False
    nulls_first: bool = False

    def null_rank(self) -> Column:
        return F.when(self.key.isNull(), 0 if self.nulls_first else 2).otherwise(1)

    def number(self, as_type: str) -> Column:
        """The key in its own type, negated for a descending order; whole numbers as decimals, so that any can be negated."""
        number = F.coalesce(self.key.cast(as_type), F.lit(0).cast(as_type))
        return (-number if self.descending else number).cast(as_type)


def _number_type(df: DataFrame, key: Column) -> str:
    found = df.select(key).schema[0].dataType
    return "decimal(20,0)" if isinstance(found, T.IntegralType) else found.simpleString()


def tile_ends(n: int, k: int) -> list[int]:
    """0-based index of the last row of every tile but the last, as NTILE deals them out."""
    size, longer = divmod(n, k)
    ends, at = [], -1
    for tile in range(min(k, n) - 1):
        at += size + (1 if tile < longer else 0)
        ends.append(at)
    return ends


def ntile_columns(df: DataFrame, id_col: str, scales: dict[str, Scale], k: int = 5) -> dict[str, Column]:
    """Column expressions equal to ``ntile(k) OVER (ORDER BY key, id)``, one per scale.

    A tile is known from the k-1 rows that end the tiles. One range sort of (scale, key, id) over all
    scales finds these rows; the tile of any row is then a comparison with at most k-1 constants, so
    the scores need neither a window nor a join back.
    """
    spark = df.sparkSession
    types = {name: _number_type(df, scale.key) for name, scale in scales.items()}
    numbers = {name: f"number_{i}" for i, name in enumerate(scales)}
    # Every scale sorts by a column of its own, in the type of its key; the others are NULL in its rows.
    stacked = df.select(F.explode(F.array(*[
        F.struct(F.lit(name).alias("scale"), scale.null_rank().alias("null_rank"), *[
            (scale.number(types[n]) if n == name else F.lit(None).cast(types[n])).alias(column) for n, column in numbers.items()],
            F.col(id_col).alias("id")) for name, scale in scales.items()
    ])).alias("r")).select("r.*")
    cuts: dict[str, list] = {name: [] for name in scales}
    with scratch.scope(spark):
        rows, _ = _arranged(stacked, [F.col(c) for c in ("scale", "null_rank", *numbers.values(), "id")], "tiles")
        sizes = rows.groupBy("scale", "_part").agg(F.count(F.lit(1)).alias("n"), F.min("_pos").alias("first")).collect()
        wanted: list[tuple[str, int, int]] = []
        for name in scales:
            parts = sorted((r["_part"], r["first"], r["n"]) for r in sizes if r["scale"] == name)
            ends = tile_ends(sum(n for _, _, n in parts), k)
            start = 0
            for part, first, n in parts:
                wanted += [(name, part, first + e - start) for e in ends if start <= e < start + n]
                start += n
        if wanted:
            spot = reduce(lambda a, b: a | b, [(F.col("_part") == p) & (F.col("_pos") == i) & (F.col("scale") == s)
                                               for s, p, i in wanted])
            for r in rows.filter(spot).collect():  # at most (k - 1) rows per scale
                cuts[r["scale"]].append(r)

    out = {}
    for name, scale in scales.items():
        here = F.struct(scale.null_rank().alias("null_rank"), scale.number(types[name]).alias("number"), F.col(id_col).alias("id"))
        tile = F.lit(1)
        for r in cuts[name]:
            cut = F.struct(F.lit(r["null_rank"]).alias("null_rank"),
                           F.lit(r[numbers[name]]).cast(types[name]).alias("number"), F.lit(r["id"]).alias("id"))
            tile = tile + (here > cut).cast("int")
        out[name] = tile
    return out
