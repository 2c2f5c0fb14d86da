"""Counts and load reports as DataFrames (partial aggregation, no collect)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def row_count(df: DataFrame, name: str = "rows") -> DataFrame:
    """One row with the number of rows of ``df``."""
    return df.agg(F.count(F.lit(1)).alias(name))


def load_report(df: DataFrame) -> DataFrame:
    """One row ``(rows, columns)``: the shape of a loaded table."""
    return row_count(df).withColumn("columns", F.lit(len(df.columns)))
