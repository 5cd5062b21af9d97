"""Where in a notebook something happens: curves over equally many bins per notebook."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from notelake.operators.ordering import number_in_notebook


def _sampled_bins(cells: DataFrame, flags: Sequence[str], bins: int) -> DataFrame:
    """Rows (flags, times, bin): how many cells with these flags stand for a bin.

    Bin b looks at cell floor(b * N / bins) of a notebook with N cells, hence the cell at
    position p stands for bins ceil(p * bins / N) up to (not with) ceil((p + 1) * bins / N).
    """
    numbered = number_in_notebook(cells, flags)
    first = F.expr(f"(position * {bins} + n_cells - 1) div n_cells")
    after = F.expr(f"((position + 1) * {bins} + n_cells - 1) div n_cells")
    # Counted before bins are spelled out: there are a few thousand ranges at most.
    ranges = (
        numbered.select(*flags, first.alias("first"), after.alias("after"))
        .where(F.col("first") < F.col("after"))
        .groupBy("first", "after", *flags).agg(F.count(F.lit(1)).alias("times"))
    )
    return ranges.select(
        *flags, "times", F.explode_outer(F.sequence("first", F.col("after") - 1)).alias("bin"))


def _all_cells(
    code: DataFrame, md: DataFrame, code_flags: dict[str, Column], md_flag: int
) -> DataFrame:
    """Code and markdown cells of the notebooks with their 0/1 flags."""
    def keys(df: DataFrame) -> list[str]:
        return [c for c in ("notebook_hash", "cell_pos", "cell_id") if c in df.columns]

    return code.select(*keys(code), *[f.alias(n) for n, f in code_flags.items()]).unionByName(
        md.select(*keys(md), *[F.lit(md_flag).alias(n) for n in code_flags]),
        allowMissingColumns=True)


def position_curves(
    code: DataFrame, md: DataFrame, cols: Sequence[str], bins: int = 100
) -> DataFrame:
    """(metric, bin, hits, notebooks, pct): share of notebooks whose sampled cell has a positive
    metric, for several metrics in one pass."""
    names = {f"_f{i}": c for i, c in enumerate(cols)}
    flags = {n: F.coalesce((F.col(c) > 0).cast("int"), F.lit(0)) for n, c in names.items()}
    per_bin = (
        _sampled_bins(_all_cells(code, md, flags, 0), list(flags), bins)
        .groupBy("bin")
        .agg(F.sum("times").alias("notebooks"),
             *[F.sum(F.col(n) * F.col("times")).alias(n) for n in flags])
    )
    hits = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(n).alias("hits"))
                     for n, c in names.items()])
    return (
        per_bin.select("bin", "notebooks", F.inline(hits))
        .select("metric", "bin", "hits", "notebooks",
                (F.col("hits") / F.col("notebooks") * 100).alias("pct"))
    )


def position_curve(code: DataFrame, md: DataFrame, col: str, bins: int = 100) -> DataFrame:
    """(bin, hits, notebooks, pct) of one metric."""
    return position_curves(code, md, [col], bins).drop("metric")


def type_ratio_curve(code: DataFrame, md: DataFrame, bins: int = 100) -> DataFrame:
    """(bin, text_count, code_count, text_pct): text against code cells per bin."""
    return (
        _sampled_bins(_all_cells(code, md, {"flag": F.lit(0)}, 1), ["flag"], bins)
        .groupBy("bin")
        .agg(F.sum(F.col("flag") * F.col("times")).alias("text_count"),
             F.sum((1 - F.col("flag")) * F.col("times")).alias("code_count"))
        .withColumn(
            "text_pct",
            F.col("text_count") / (F.col("text_count") + F.col("code_count")) * 100,
        )
    )


def curve_median(curve: DataFrame, col: str = "text_pct") -> DataFrame:
    """Median over the bins of a curve."""
    return curve.agg(F.median(col).alias("median"))
