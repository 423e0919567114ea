"""Shards by vector bin packing: bytes, tokens and rows balanced jointly.

Documents with equal texts form a group and stay together; a group larger than a shard in any dimension is cut into pieces
of at most a quarter of a shard. A group or piece goes to the shard whose residual capacity has the largest dot product with its
size vector (both as shares of a shard), among the shards whose bytes it fits in; if it fits in none, to the one with most
bytes left. Bytes bind because the law is about them; a shard that is full in tokens or rows has less to offer in
the product, and gets less if any other has room.

* Groups of at least 1 / `HEAVY` of a shard in some dimension are few (at most 3 * HEAVY a shard, whatever the input):
  the driver places them one by one, largest first.
* All other groups are dealt to cells by hash. Every cell has its own residual capacities, the share of each shard's
  residual that the cell's groups make up of all light groups, and places its groups, largest first, in one streaming
  pass that holds only these vectors. The number of cells grows with the number of groups.
* With many cells a light group can be large beside a shard's share of a cell, and what does not fit there would fall on the
  same shard in every cell. So groups of more than 1 / `FIT` of that share go first, in levels of sizes within a factor of
  `LEVEL`, each level in as few cells as its own largest group needs; a level starts from the capacities the ones before left.
* Slots: documents are numbered within (shard, cell of the doc_id), cells one after another, so no task holds a shard.

Law: `bytes`; sizes (UTF-8 bytes plus 8) are nearly equal, tokens and rows as far as the groups allow.

Defined results: a null text counts as empty and groups with it; empty tables give empty results; rows with equal doc_id
and text are separate rows with slots of their own (the order among them is free); other columns are ignored. Groups are
told apart by the MD5 digest of their texts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.shared import stored
from tallyhouse.llm.words import words

HEAVY = 256
#: Light groups and documents a cell; a cell is a task's unit, not a limit.
CELL_GROUPS, CELL_ROWS = 20_000, 50_000
#: Largest groups that a shard's share of a cell has room for, at least; sizes in a level of larger groups.
FIT, LEVEL = 8, 64
DIMENSIONS = ("bytes", "tokens", "rows")


def _measured(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        "doc_id",
        F.md5(text).alias("key"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.size(words(text)).cast("long").alias("tokens"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )


def place(vector: np.ndarray, residual: np.ndarray) -> int:
    """The shard for a size vector: largest dot product with the residual capacity where its bytes fit, else most bytes left."""
    fits = residual[:, 0] >= vector[0]
    if fits.any():
        return int(np.where(fits, residual @ vector, -np.inf).argmax())
    return int(residual[:, 0].argmax())


def _place_all(vectors: np.ndarray, residual: np.ndarray) -> list[int]:
    """Shards of vectors in the order given; takes them off the residual."""
    out = []
    for v in vectors:
        shard = place(v, residual)
        residual[shard] -= v
        out.append(shard)
    return out


def _cell_packer(room: np.ndarray, shard_size: np.ndarray, light_total: np.ndarray):
    """Places rows (cell, key, sizes, sizes of the cell) that arrive cell by cell, largest first.

    room: what the heavy groups left of each shard. A cell may fill the share of it that it has of all light groups.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, residual = None, None
        for batch in batches:
            sizes, of_cell = (
                np.stack([batch[prefix + d].to_numpy(zero_copy_only=False) for d in DIMENSIONS], axis=1)
                for prefix in ("", "cell_")
            )
            shards = []
            for c, v, total in zip(batch["cell"].to_pylist(), sizes / shard_size, of_cell, strict=True):
                if c != cell:
                    cell, residual = c, room * (total / light_total)
                shard = place(v, residual)
                residual[shard] -= v
                shards.append(shard)
            columns = [batch["key"], pa.array(shards, pa.int32()), *[batch[d] for d in DIMENSIONS]]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "shard", *DIMENSIONS])

    return run


def _in_cells(groups: DataFrame, totals: np.ndarray, n_cells: int, residual: np.ndarray, shard_size: np.ndarray) -> DataFrame:
    """key, shard and sizes of groups, placed cell by cell into what is left of the shards."""
    total = np.maximum(totals, 1e-9)
    room = np.maximum(residual, 0)
    room = room / np.maximum(room.sum(axis=0), 1e-9) * (total / shard_size)
    in_cell = Window.partitionBy("cell")
    groups = groups.withColumn("cell", F.pmod(F.xxhash64("key"), F.lit(n_cells)).cast("int")).repartition(n_cells, "cell")
    groups = groups.withColumns({f"cell_{d}": F.sum(d).over(in_cell) for d in DIMENSIONS})
    ordered = groups.sortWithinPartitions("cell", F.desc("share"), "key").drop("share")
    return ordered.mapInArrow(_cell_packer(room, shard_size, total), "key string, shard int, bytes long, tokens long, rows long")


def _light(light: DataFrame, residual: np.ndarray, shard_size: np.ndarray, n_cells: int) -> list[DataFrame]:
    """Placed light groups: a table for each level of groups that are large beside a cell, and one for all others."""
    shards, size = len(residual), [F.coalesce(F.sum(d), F.lit(0)) for d in DIMENSIONS]
    *totals, largest = light.agg(*size, F.coalesce(F.max("bytes"), F.lit(0))).first()
    fitting = totals[0] / (FIT * shards * n_cells)
    if largest <= fitting or n_cells == 1:
        return [_in_cells(light, np.array(totals, dtype=float), n_cells, residual, shard_size)]
    # Level 0 has the largest groups; those that fit are the last level.
    last = math.ceil(math.log(largest / fitting, LEVEL)) + 1
    level = F.least(F.floor(F.log(F.lit(float(largest)) / F.col("bytes")) / F.lit(math.log(LEVEL))), F.lit(last - 1))
    light = light.withColumn("level", F.when(F.col("bytes") > fitting, level).otherwise(F.lit(last)).cast("int"))
    counted = light.groupBy("level").agg(*size, F.max("bytes"), F.count("*")).orderBy("level").collect()
    placed = []
    for i, (at, *sums, most, n) in enumerate(counted):
        cells = max(1, min(n // CELL_GROUPS, int(sums[0] / (FIT * shards * most))))
        done = _in_cells(light.filter(F.col("level") == at).drop("level"), np.array(sums, dtype=float), cells, residual, shard_size)
        if i < len(counted) - 1:
            done = stored(done, "shard-level")
            for shard, *used in done.groupBy("shard").agg(*size).collect():
                residual[shard] -= np.array(used, dtype=float) / shard_size
        placed.append(done)
    return placed


def pack(docs: DataFrame, shards: int = 24) -> DataFrame:
    """doc_id, size, tokens, text_crc32, shard, slot; one row per document."""
    spark = docs.sparkSession
    rows = stored(_measured(docs), "shard-rows")
    groups = rows.groupBy("key").agg(F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows"))
    groups = stored(groups, "shard-groups")
    n_groups, *sums = groups.agg(F.count("*"), *[F.coalesce(F.sum(d), F.lit(0)) for d in DIMENSIONS]).first()
    shard_size = np.maximum(np.array(sums, dtype=float) / shards, 1e-9)
    share = F.greatest(*[F.col(d) / F.lit(float(s)) for d, s in zip(DIMENSIONS, shard_size, strict=True)])
    heavy = groups.withColumn("share", share).filter(F.col("share") >= 1 / HEAVY)
    residual = np.ones((shards, 3))

    # Heavy groups whole, and the pieces of groups beyond a shard with the sizes they really have.
    cut = heavy.filter("share > 1").select("key", F.ceil(4 * F.col("share")).cast("int").alias("pieces"))
    piece_of = F.pmod(F.xxhash64("doc_id", "text_crc32"), F.col("pieces")).cast("int").alias("piece")
    pieces = rows.join(F.broadcast(cut), "key").groupBy("key", piece_of).agg(
        F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows")
    )
    whole = heavy.filter("share <= 1").select("key", F.lit(0).alias("piece"), *DIMENSIONS)
    units = sorted(whole.unionByName(pieces).collect(), key=lambda r: (-max(np.array(r[2:]) / shard_size), r.key, r.piece))
    heavy_shards = _place_all(np.array([r[2:] for r in units], dtype=float).reshape(-1, 3) / shard_size, residual)
    n_pieces = {r.key: r.pieces for r in cut.collect()}
    placed = spark.createDataFrame(
        [(r.key, n_pieces.get(r.key, 1), r.piece, s) for r, s in zip(units, heavy_shards, strict=True)],
        "key string, pieces int, piece int, shard int",
    )

    # Light groups, cell by cell.
    n_cells = max(1, n_groups // CELL_GROUPS)
    light = groups.withColumn("share", share).filter(F.col("share") < 1 / HEAVY)
    dealt = placed
    for done in _light(light, residual, shard_size, n_cells):
        dealt = dealt.unionByName(done.select("key", F.lit(1).alias("pieces"), F.lit(0).alias("piece"), "shard"))
    one = dealt.filter("pieces = 1").select("key", "shard")
    many = dealt.filter("pieces > 1")
    in_one = rows.join(F.broadcast(cut.select("key")), "key", "left_anti").join(one, "key")
    in_many = rows.join(F.broadcast(cut), "key").withColumn("piece", piece_of).join(F.broadcast(many.select("key", "piece", "shard")), ["key", "piece"])
    columns = ["doc_id", "size", "tokens", "text_crc32", "shard"]
    return _slots(in_one.select(columns).unionByName(in_many.select(columns)), sums[2])


def _slots(rows: DataFrame, n_rows: int) -> DataFrame:
    """Adds `slot`: gapless from 0 within each shard."""
    n_cells = max(1, n_rows // CELL_ROWS)
    rows = stored(rows.withColumn("cell", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(n_cells)).cast("int")), "shard-dealt")
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("shard", "cell").agg(F.count("*").alias("n"))
    starts = counts.select("shard", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("shard", "cell").orderBy("doc_id", "text_crc32")
    numbered = rows.withColumn("i", F.row_number().over(within) - 1).join(starts, ["shard", "cell"])
    return numbered.select("doc_id", "size", "tokens", "text_crc32", "shard", (F.col("start") + F.col("i")).cast("long").alias("slot"))
