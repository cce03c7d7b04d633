"""Joining monthly revenue with the account mapping."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revmap import texts
from revmap.functions.columns import yes_no, zero_if_null
from revmap.functions.dates import as_date, month_start, prior_month
from revmap.operators.skew import lookup_join, ordered_by
from revmap.schemas import GL_FLAG, ID_FLAG, MAPPING_ATTRS

Day = str | dt.date


def month_slice(r: DataFrame, as_of: Day | None = None, months_back: int = 1, month: Day | None = None) -> DataFrame:
    """Revenue of one month: ``month`` itself, or ``months_back`` before
    ``as_of``. The test is an equality with a DATE literal, so it prunes
    ``data_month`` partitions or is pushed to the scan."""
    if month is not None:
        return r.where(F.col("data_month") == as_date(month))
    if as_of is None:
        raise ValueError("give as_of or month")
    return r.where(F.col("data_month") == prior_month(as_of, months_back))


def _side(m: DataFrame) -> DataFrame:
    """The mapping under names that cannot clash with revenue's ``id``."""
    return m.select(F.col("ID").alias("mapping_ID"), *MAPPING_ATTRS)


def _one_per_id(side: DataFrame) -> DataFrame:
    """One row per ID, the least by its attributes in column order. Rows
    without an ID stay as they are: they are not copies of each other."""
    firsts = (
        side.where(F.col("mapping_ID").isNotNull())
        .groupBy("mapping_ID")
        .agg(F.min(F.struct(*MAPPING_ATTRS)).alias("first"))
        .select("mapping_ID", "first.*")
    )
    return firsts.unionByName(side.where(F.col("mapping_ID").isNull()))


def _resolve_duplicates(side: DataFrame, on_duplicate: str) -> DataFrame:
    if on_duplicate == "allow":
        return side
    if on_duplicate == "first":
        return _one_per_id(side)
    if on_duplicate == "raise":
        repeated = (
            side.where(F.col("mapping_ID").isNotNull())
            .groupBy("mapping_ID")
            .count()
            .where("count > 1")
        )
        if not repeated.isEmpty():
            raise ValueError("the mapping has duplicate IDs")
        return side
    raise ValueError(f"on_duplicate must be allow, first or raise, not {on_duplicate}")


def map_revenue(
    r: DataFrame,
    m: DataFrame,
    *,
    as_of: Day | None = None,
    months_back: int = 1,
    month: Day | None = None,
    how: str = "left",
    master: str = "revenue",
    flags: bool = False,
    on_duplicate: str = "allow",
    hot: list | None = None,
) -> DataFrame:
    """The mapped view of one month.

    ``master="revenue"`` keeps every revenue row (``how="left"``) and appends
    the mapping attributes, or puts them first with two Y/N flags if ``flags``.
    ``master="mapping"`` puts the mapping first, its key as ``mapping_ID``, and
    keeps every mapping row. ``how="inner"`` keeps matches only.

    An ID that repeats in the mapping repeats its revenue rows, unless
    ``on_duplicate`` is "first" or "raise". ``hot`` names revenue IDs known to hold
    a large share of the month; with the mapping first nothing else can split them."""
    month_rows = month_slice(r, as_of, months_back, month)
    side = _resolve_duplicates(_side(m), on_duplicate)
    if master == "mapping":
        return _mapping_master(month_rows, side, how, hot)
    if master != "revenue":
        raise ValueError(f"master must be revenue or mapping, not {master}")
    joined = lookup_join(month_rows, side, "id", "mapping_ID", how, hot=hot)
    if not flags:
        return joined.select(*month_rows.columns, *MAPPING_ATTRS)
    return joined.select(
        *MAPPING_ATTRS,
        yes_no(F.col("Oracle_GL_Account").isNotNull()).alias(GL_FLAG),
        yes_no(F.col("mapping_ID").isNotNull()).alias(ID_FLAG),
        *month_rows.columns,
    )


def _mapping_master(month_rows: DataFrame, side: DataFrame, how: str, hot: list | None) -> DataFrame:
    columns = ["mapping_ID", *MAPPING_ATTRS, *month_rows.columns]
    if how == "left" and not hot:
        return side.join(month_rows, F.col("mapping_ID") == F.col("id"), "left").select(columns)
    # An outer join cannot split the side it does not preserve. Matches and
    # leftovers are found separately, so that hot revenue is on the spread side.
    matched = lookup_join(month_rows, side, "id", "mapping_ID", "inner", hot=hot).select(columns)
    if how == "inner":
        return matched
    left_over = lookup_join(side, revenue_ids(month_rows), "mapping_ID", "revenue_id", "left_anti")
    return matched.unionByName(left_over, allowMissingColumns=True)


def revenue_ids(month_rows: DataFrame) -> DataFrame:
    """The distinct non-null IDs, reduced in each task before the shuffle."""
    return month_rows.where(F.col("id").isNotNull()).select(F.col("id").alias("revenue_id")).distinct()


def mapping_ids(m: DataFrame) -> DataFrame:
    return m.where(F.col("ID").isNotNull()).select(F.col("ID").alias("mapping_ID")).distinct()


def _unmapped(r: DataFrame, m: DataFrame, month: dict) -> DataFrame:
    return lookup_join(month_slice(r, **month), mapping_ids(m), "id", "mapping_ID", "left_anti")


def unmapped_revenue(
    r: DataFrame, m: DataFrame, *, reason: str = texts.UNMAPPED_REASON, ordered: bool = True, **month
) -> DataFrame:
    """Revenue rows of the month whose ID is in no mapping, by ID. A row
    without an ID is unmapped."""
    rows = _unmapped(r, m, month)
    if ordered:
        rows = ordered_by(rows, F.asc_nulls_last("id"))
    return rows.select(F.lit(texts.UNMAPPED_REVENUE).alias("report_section"), "*", F.lit(reason).alias("unmapped_reason"))


def unmapped_totals(r: DataFrame, m: DataFrame, *, measure: str | None = None, **month) -> DataFrame:
    """How much revenue is unmapped: rows, IDs and the sum of ``measure``."""
    rows = _unmapped(r, m, month)
    totals = [F.count("*").alias("unmapped_revenue_count"), F.count_distinct("id").alias("unmapped_revenue_ids")]
    if measure is not None:
        totals.append(F.sum(zero_if_null(F.col(measure))).alias("unmapped_revenue_amount"))
    return rows.agg(*totals)


def _unused(r: DataFrame, m: DataFrame, month: dict) -> DataFrame:
    ids = revenue_ids(month_slice(r, **month))
    return lookup_join(m, ids, "ID", "revenue_id", "left_anti")


def unused_mappings(
    r: DataFrame, m: DataFrame, *, reason: str = texts.UNUSED_REASON, ordered: bool = True, **month
) -> DataFrame:
    """Mapping rows without revenue in the month, by ID."""
    rows = _unused(r, m, month)
    if ordered:
        rows = ordered_by(rows, F.asc_nulls_last("ID"))
    return rows.select(F.lit(texts.UNUSED_MAPPING).alias("report_section"), "*", F.lit(reason).alias("unused_reason"))


def unused_count(r: DataFrame, m: DataFrame, **month) -> DataFrame:
    return _unused(r, m, month).agg(F.count("*").alias("unused_mapping_count"))


def months_available(r: DataFrame, n: int = 12) -> DataFrame:
    """The latest ``n`` months and their row counts, newest first."""
    return (
        r.groupBy("data_month")
        .agg(F.count("*").alias("record_count"))
        .orderBy(F.desc_nulls_first("data_month"))
        .limit(n)
    )


def month_bounds(r: DataFrame, as_of: Day, months_back: int = 1) -> DataFrame:
    """The month the filter selects, with what the revenue relation holds for
    it, so that a wrong ``as_of`` shows up before a run."""
    prior = prior_month(as_of, months_back)
    return r.agg(
        as_date(as_of).alias("current_date"),
        prior.alias("prior_month_start"),
        month_start(as_of).alias("current_month_start"),
        F.count_if(F.col("data_month") == prior).alias("prior_month_records"),
        F.max("data_month").alias("latest_month"),
    )
