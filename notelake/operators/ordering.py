"""Exact row numbers, globally and per group, without ever sorting a group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from notelake.session import shared_dir

BLOCK = 4096


# Leading characters that tell blocks of cell ids without a number apart.
PREFIX = 3


def global_index(df: DataFrame, order: Sequence[Column], name: str = "index") -> DataFrame:
    """Add the 0-based rank of each row under ``order`` as a long column.

    The sort is range-partitioned, so no task holds more than its range. The sorted rows are
    checkpointed, because both the range sizes and the ranks are read from them and have to agree;
    Spark removes the checkpoint with the frame if ``spark.cleaner.referenceTracking.
    cleanCheckpoints`` is set. Only the range sizes (one row per partition) meet in one task and
    are broadcast.
    """
    shared_dir(df.sparkSession)
    ranged = (
        df.orderBy(*order).withColumn("_id", F.monotonically_increasing_id()).checkpoint()
        .withColumn("_range", F.shiftright("_id", 33)))
    sizes = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start")
    )
    local = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        ranged.join(F.broadcast(starts), "_range")
        .withColumn(name, F.col("_start") + local)
        .drop("_id", "_range", "_start")
    )


def cell_order(cells: DataFrame) -> dict[str, Column]:
    """What sorts cells in their notebook, whichever of ``cell_pos`` and ``cell_id`` a row has.

    Given positions first, then ids that are numbers ("10" follows "9"), then other ids as texts.
    """
    pos = F.col("cell_pos").cast("bigint") if "cell_pos" in cells.columns else F.lit(None)
    text = F.col("cell_id").cast("string") if "cell_id" in cells.columns else F.lit(None)
    number = F.coalesce(pos, text.cast("string").try_cast("bigint"))
    return {
        "_tier": F.when(pos.isNotNull(), 0).when(number.isNotNull(), 1).otherwise(2),
        "_number": number, "_text": text.cast("string")}


def number_in_notebook(
    cells: DataFrame, ties: Sequence[str] = (), block: int = BLOCK, key: str = "notebook_hash"
) -> DataFrame:
    """Add ``position`` (0-based rank in the notebook, see ``cell_order``) and ``n_cells``.

    A notebook is cut into blocks: of ``block`` consecutive numbers, or of ids that begin alike.
    Rows are ranked inside their block only, and block offsets come from pre-aggregated block
    sizes: a notebook with a third of all rows spreads over as many tasks as it has blocks.
    """
    blocked = cells.withColumns(cell_order(cells)).withColumns({
        "_block": F.coalesce(F.expr(f"_number div {block}"), F.lit(0)),
        "_prefix": F.when(F.col("_tier") == 2, F.coalesce(F.left("_text", F.lit(PREFIX)), F.lit("")))
        .otherwise("")})
    of = ["_tier", "_block", "_prefix"]
    sizes = blocked.groupBy(key, *of).agg(F.count(F.lit(1)).alias("_size"))
    group = Window.partitionBy(key)
    running = group.orderBy(*of).rowsBetween(Window.unboundedPreceding, 0)
    offsets = sizes.select(
        F.col(key).alias("_key"), *[F.col(c).alias(f"{c}_of") for c in of],
        (F.sum("_size").over(running) - F.col("_size")).alias("_before"),
        F.sum("_size").over(group).alias("n_cells"),
    )
    inside = F.row_number().over(
        Window.partitionBy(key, *of).orderBy("_number", "_text", *ties))
    # The name of a notebook may be missing as well.
    same = F.col(key).eqNullSafe(F.col("_key"))
    for c in of:
        same &= F.col(c) == F.col(f"{c}_of")
    return (
        blocked.withColumn("_rank", inside).join(offsets, same)
        .withColumn("position", F.col("_before") + F.col("_rank") - 1)
        .select(*cells.columns, "position", "n_cells")
    )


def with_cell_pos(cells: DataFrame) -> DataFrame:
    """Give every cell the integer ``cell_pos`` that sorts it within its notebook.

    Tables with positions in every row keep their order but count from 0 without gaps.
    """
    numbered = number_in_notebook(cells)
    kept = [c for c in cells.columns if c != "cell_pos"]
    return numbered.select(*kept, F.col("position").alias("cell_pos"))
