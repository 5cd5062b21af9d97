"""Exact quantiles of numeric columns, at any number of rows.

Like Spark's own ``approxQuantile`` these functions run jobs when called. Only a few numbers per
column come back to the driver.
"""

from __future__ import annotations

import struct
from collections.abc import Sequence
from math import ceil, floor

from pyspark.sql import Column, DataFrame, Window, functions as F

# The parts of a double.
FRACTION, BIAS = 52, 1023
# Bits that one pass of the selection looks at.
DIGIT = 16


def _numbers(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Only the named columns, with NaN as missing."""
    types = dict(df.dtypes)
    missing = F.lit(float("nan"))
    return df.select(*[
        F.nullif(F.col(c), missing).alias(c) if types[c] in ("float", "double") else F.col(c)
        for c in cols
    ])


def column_stats(df: DataFrame, cols: Sequence[str]) -> dict[str, dict]:
    """count, mean, std, min and max per column, in one pass."""
    number = lambda c: F.col(c).cast("double")
    row = _numbers(df, cols).agg(*[
        F.struct(
            F.count(c).alias("count"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"),
            F.min(number(c)).alias("min"), F.max(number(c)).alias("max"),
        ).alias(c)
        for c in cols
    ]).first()
    return {c: row[c].asDict() for c in cols}


def exact_quantiles(
    df: DataFrame, cols: Sequence[str], probabilities: Sequence[float],
    stats: dict[str, dict] | None = None,
) -> dict[str, list[float | None]]:
    """Quantiles with linear interpolation, per column in the order of ``probabilities``."""
    stats = column_stats(df, cols) if stats is None else stats
    places = {c: [p * (stats[c]["count"] - 1) for p in probabilities]
              for c in cols if stats[c]["count"]}
    ranks = {c: {end(at) for at in places[c] for end in (floor, ceil)} for c in places}
    value = _values_at(_numbers(df, cols), ranks) if ranks else {}

    def between(c: str, at: float) -> float:
        low, high = value[c, floor(at)], value[c, ceil(at)]
        return low if low == high else low + (high - low) * (at - floor(at))

    return {c: [between(c, at) for at in places[c]] if c in places else [None] * len(probabilities)
            for c in cols}


def _sortable(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Columns b0, b1, ... of ``cols``: a long per number that sorts as the numbers do.

    It is the number's own 64 bits (exponent and fraction; negated below zero), taken apart by
    arithmetic on powers of two, which is exact. NULL stays NULL, and both zeros are one value.
    """
    x = [F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)]
    # The logarithm may be off by one next to a power of two.
    near = [F.floor(F.log2(F.abs(f"x{i}"))).cast("double").alias(f"e{i}") for i in range(len(cols))]

    def exponent(i: int) -> Column:
        size, e = F.abs(f"x{i}"), F.col(f"e{i}")
        return F.when(size < F.pow(F.lit(2.0), e), e - 1).when(
            size >= F.pow(F.lit(2.0), e + 1), e + 1).otherwise(e).alias(f"e{i}")

    def bits(i: int) -> Column:
        size, e = F.abs(f"x{i}"), F.col(f"e{i}")
        part = (size / F.pow(F.lit(2.0), e) - 1) * float(1 << FRACTION)
        normal = (e.cast("bigint") + BIAS) * (1 << FRACTION) + part.cast("bigint")
        tiny = (size * 2.0**537 * 2.0**537).cast("bigint")
        size = (F.when(size == float("inf"), F.lit((2 * BIAS + 1) << FRACTION))
                .when(size < 2.0 ** (1 - BIAS), tiny).otherwise(normal))
        return F.when(F.col(f"x{i}") < 0, -size).otherwise(size).alias(f"b{i}")

    each = range(len(cols))
    return df.select(x).select("*", *near).select(*[f"x{i}" for i in each], *map(exponent, each)).select(
        *map(bits, each))


def _number(bits: int) -> float:
    value = struct.unpack("<d", struct.pack("<q", abs(bits)))[0]
    return -value if bits < 0 else value


def _values_at(df: DataFrame, ranks: dict[str, set[int]]) -> dict[tuple[str, int], float]:
    """The values at 0-based ranks: {(column, rank): value}.

    Selection by digits: values are counted by the first 16 of their 64 bits, which tells in which of
    at most 65,536 groups a wanted rank lies; only these groups are counted by the next 16 bits, and
    so on. A group of one value ends the search, so most columns take two or three of the four
    passes. Counts combine in each task; nothing is sorted but the counts, and one row per rank
    comes to the driver.
    """
    names = list(ranks)
    table = _sortable(df, names)
    found, asked = {}, [(i, None, r, r) for i, c in enumerate(names) for r in ranks[c]]
    for shift in range(64 - DIGIT, -1, -DIGIT):
        prefixes = {}
        for column, prefix, _, _ in asked:
            prefixes.setdefault(column, set()).add(prefix)
        pairs = []
        for i, of in prefixes.items():
            bits = F.col(f"b{i}")
            inside = bits.isNotNull() if None in of else F.shiftright(bits, shift + DIGIT).isin(
                sorted(of))
            pairs.append(F.when(inside, F.struct(F.lit(i).alias("column"), bits.alias("bits"))))
        digit = F.shiftright("bits", shift)
        above = F.lit(0) if shift + DIGIT == 64 else F.shiftright("bits", shift + DIGIT)
        counts = (
            table.select(F.explode(F.array(*pairs)).alias("pair")).where("pair is not null")
            .select("pair.*").groupBy("column", above.cast("bigint").alias("prefix"), digit.alias("digit"))
            .agg(F.count(F.lit(1)).alias("n"), F.min("bits").alias("low"), F.max("bits").alias("high")))
        running = Window.partitionBy("column", "prefix").orderBy("digit")
        schema = "column int, prefix long, at long, rank long"
        wanted = F.broadcast(df.sparkSession.createDataFrame(
            [(c, p or 0, at, r) for c, p, at, r in asked], schema))  # one row per rank
        rows = (
            counts.withColumn("after", F.sum("n").over(running)).join(wanted, ["column", "prefix"])
            .where((F.col("at") < F.col("after")) & (F.col("at") >= F.col("after") - F.col("n")))
            .withColumn("at", F.col("at") - F.col("after") + F.col("n")).collect())
        asked = []
        for r in rows:
            if r["low"] == r["high"]:
                found[names[r["column"]], r["rank"]] = _number(r["low"])
            else:
                asked.append((r["column"], r["digit"], r["at"], r["rank"]))
        if not asked:
            break
    return found
