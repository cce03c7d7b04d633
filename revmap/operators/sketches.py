"""Distinct counts that can be stored by month and merged for any range of months.

Estimates, for overviews of long ranges: no check and no PASS or FAIL uses them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revmap.operators.recon import date_range

#: Buckets of a sketch as a power of two: 2^14 of them are 8 KB and err by 0.8 % (one standard deviation).
LG_BUCKETS = 14


def standard_error(lg_buckets: int = LG_BUCKETS) -> float:
    """The relative standard deviation of an estimate."""
    return 1.04 / 2 ** (lg_buckets / 2)


def monthly_sketches(df: DataFrame, columns: list[str], *, month: str = "data_month", lg_buckets: int = LG_BUCKETS) -> DataFrame:
    """One row a month: ``n`` rows and for each column a sketch of its distinct values,
    NULL left out. Tasks add up sketches, so a frequent value or month is never
    gathered. Store it with ``reload_table`` and merge what is needed."""
    sketches = [F.hll_sketch_agg(F.col(c).cast("string"), F.lit(lg_buckets)).alias(f"{c}_sketch") for c in columns]
    return df.groupBy(month).agg(F.count("*").alias("n"), *sketches)


def distinct_in_range(
    sketches: DataFrame, columns: list[str], lo: str | dt.date | None = None, hi: str | dt.date | None = None, *, month: str = "data_month"
) -> DataFrame:
    """One row over the months from ``lo`` up to but not including ``hi``, or all:
    ``n`` and the estimated distinct values of each column. Only sketches are read."""
    rows = sketches if lo is None else date_range(sketches, lo, hi, column=month)
    merged = [F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(f"{c}_sketch")), F.lit(0).cast("bigint")).alias(f"{c}_distinct") for c in columns]
    return rows.agg(F.coalesce(F.sum("n"), F.lit(0).cast("bigint")).alias("n"), *merged)
