"""Corpus aggregates: counts, roll-ups, distributions and table profiles."""

from __future__ import annotations

from collections.abc import Sequence
from math import isfinite

from pyspark.sql import Column, DataFrame, functions as F

from notelake.operators.quantiles import column_stats, exact_quantiles
from notelake.schemas import METRICS, PEAK_METRICS

QUARTILES = (0.25, 0.5, 0.75)


def op_counts(cells: DataFrame) -> DataFrame:
    """(function, count) over all cells; ``cells`` carries ``facts`` (see ``cell_facts``)."""
    return (
        cells.select(F.explode("facts.op").alias("fact"))
        .groupBy(F.col("fact.name").alias("function"))
        .agg(F.sum("fact.times").alias("count"))
    )


def op_summary(vocab: DataFrame, counts: DataFrame) -> DataFrame:
    """Every vocabulary or counted function with category and count, by name.

    Functions without calls count 0; counted functions outside the vocabulary have category "".
    """
    return (
        vocab.join(counts, "function", "full_outer")
        .select(
            F.coalesce("category", F.lit("")).alias("category"),
            "function",
            F.coalesce("count", F.lit(0)).cast("bigint").alias("count"),
        )
        .orderBy("function")
    )


def run_totals(metrics: DataFrame) -> DataFrame:
    return metrics.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("parse_error").isNotNull()).alias("parse_errors"),
    )


def notebook_rollup(
    metrics: DataFrame, cols: Sequence[str] = METRICS, peaks: Sequence[str] = PEAK_METRICS
) -> DataFrame:
    """One row per notebook: cell count, the largest of ``peaks``, the sum of all others."""
    totals = [(F.max(c) if c in peaks else F.sum(c)).alias(c) for c in cols]
    return metrics.groupBy("notebook_hash").agg(F.count("cell_id").alias("n_cells"), *totals)


def describe(df: DataFrame, cols: Sequence[str], digits: int | None = None) -> DataFrame:
    """One row per column: count, mean, std, min, q25, q50, q75, max (optionally rounded)."""
    stats = column_stats(df, cols)
    found = exact_quantiles(df, cols, QUARTILES, stats)
    shown = lambda x: (x if digits is None or x is None or not isfinite(x)
                       else round(x * 10**digits) / 10**digits)
    rows = [
        (c, s["count"], *map(shown, (s["mean"], s["std"], s["min"], *found[c], s["max"])))
        for c, s in stats.items()
    ]
    return df.sparkSession.createDataFrame(
        rows, "column string, count long, mean double, std double, min double, q25 double, "
              "q50 double, q75 double, max double")


def describe_wide(df: DataFrame, cols: Sequence[str], digits: int | None = None) -> DataFrame:
    """``describe`` with one row per statistic and one column per input column."""
    stats = describe(df, cols, digits).withColumn("count", F.col("count").cast("double"))
    long = stats.unpivot("column", stats.columns[1:], "statistic", "value")
    return long.groupBy("statistic").pivot("column", list(cols)).agg(F.first("value"))


def quartiles(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, p, value) at 25, 50 and 75 %, interpolated linearly."""
    found = exact_quantiles(df, cols, QUARTILES)
    rows = [(c, p, v) for c in cols for p, v in zip(QUARTILES, found[c])]
    return df.sparkSession.createDataFrame(rows, "column string, p double, value double")


def iqr_fences(df: DataFrame, col: str, k: float = 1.5) -> DataFrame:
    """One row: quartiles, the fences k interquartile ranges away, and the shown lower fence."""
    q25, q50, q75 = exact_quantiles(df, [col], QUARTILES)[col]
    schema = "q25 double, q50 double, q75 double"
    spread = F.col("q75") - F.col("q25")
    return (
        df.sparkSession.createDataFrame([(q25, q50, q75)], schema)
        .withColumn("lower", F.col("q25") - k * spread)
        .withColumn("upper", F.col("q75") + k * spread)
        .withColumn("lower_shown", F.greatest("lower", F.lit(0.0)))
    )


def iqr_filter(df: DataFrame, col: str, k: float = 1.5) -> DataFrame:
    """Rows of ``df`` whose ``col`` lies within the fences."""
    fences = iqr_fences(df, col, k).first()
    return df.where(F.col(col).between(fences["lower"], fences["upper"]))


def positive_count(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows with a positive value, per column, and the number of rows."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.col(c) > 0).alias(f"{c}_positive") for c in cols],
    )


def totals(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.agg(*[F.sum(c).alias(f"{c}_total") for c in cols])


def mean_ratio(df: DataFrame, num: str, den: str) -> DataFrame:
    """Rows with ``den`` > 0 and the mean of their own ratios num / den."""
    return df.where(F.col(den) > 0).agg(
        F.count(F.lit(1)).alias("rows"), F.avg(F.col(num) / F.col(den)).alias("mean_ratio")
    )


def distinct_count(df: DataFrame, col: str, name: str) -> DataFrame:
    return df.agg(F.countDistinct(col).alias(name))


def share_of_total(df: DataFrame, col: str, digits: int | None = 2) -> DataFrame:
    """Add ``percentage``: the share of ``col`` in its total, in percent."""
    share: Column = F.col(col) / df.agg(F.sum(col)).scalar() * 100
    # Scaled, rounded half to even and scaled back, as numpy does.
    shown = share if digits is None else F.rint(share * 10**digits) / 10**digits
    return df.withColumn("percentage", shown)


def cell_type_counts(cells: DataFrame) -> DataFrame:
    return cells.groupBy("cell_type").agg(F.count(F.lit(1)).alias("n"))


def histogram(df: DataFrame, col: str) -> DataFrame:
    """(bin, left, right, n) with as many equal bins as the maximum; only bins with rows.

    The last bin is closed. No rows come out when the maximum is below 1.
    """
    number = F.col(col).cast("double")
    ends = df.agg(F.struct(F.min(number).alias("low"), F.max(number).alias("high"))).scalar()
    low, high, bins = F.col("low"), F.col("high"), F.col("bins")
    edge = lambda i: low + i * ((high - low) / bins)
    slot = F.least(F.floor((F.col("x") - low) / (high - low) * bins), bins - 1)
    # A value belongs to the bin whose edges, as computed, enclose it.
    fitted = (
        F.when(F.col("x") < edge(F.col("slot")), F.col("slot") - 1)
        .when((F.col("x") >= edge(F.col("slot") + 1)) & (F.col("slot") < bins - 1),
              F.col("slot") + 1)
        .otherwise(F.col("slot"))
    )
    bounded = (
        df.where(F.col(col).isNotNull())
        .select(number.alias("x"), ends["low"].alias("low"), ends["high"].alias("high"))
        .withColumn("bins", F.floor("high"))
        .where(bins >= 1)
    )
    # A constant column is one unit wide around its value.
    flat = F.when(low == high, 0.5).otherwise(0.0)
    return (
        bounded.select("x", "bins", (low - flat).alias("low"), (high + flat).alias("high"))
        .withColumn("slot", slot)
        .groupBy(fitted.cast("bigint").alias("bin"), "low", "high", "bins")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("bin", edge(F.col("bin")).alias("left"), edge(F.col("bin") + 1).alias("right"), "n")
    )


def table_profile(df: DataFrame) -> DataFrame:
    """(column, type, non_null, rows) for every column, in one pass."""
    wide = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count(F.col(f"`{c}`")).alias(f"_c{i}") for i, c in enumerate(df.columns)],
    )
    lines = F.array(*[
        F.struct(
            F.lit(name).alias("column"), F.lit(kind).alias("type"),
            F.col(f"_c{i}").alias("non_null"), F.col("_rows").alias("rows"),
        )
        for i, (name, kind) in enumerate(df.dtypes)
    ])
    return wide.select(F.inline(lines))
