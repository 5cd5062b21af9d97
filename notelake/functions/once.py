"""A column that is computed once, whatever is done with it later."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def add_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add ``value`` as the last column, so that conditions on it do not repeat its work.

    Spark moves a filter below the projection its column comes from and computes the column
    there as well. It moves none below a generator, and one row of a one-element array is one
    row. Conditions on the other columns still reach the scan.
    """
    return df.withColumn("_once", value).select(
        *df.columns, F.explode_outer(F.array("_once")).alias(name))
