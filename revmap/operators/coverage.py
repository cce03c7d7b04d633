"""How much of a month's revenue is mapped, and how much of the mapping used.

Whether an ID is mapped depends on the ID alone. So revenue and mapping are
reduced to row counts per ID in one shuffle, each task combining its own rows
first; every coverage figure is then a sum over IDs. Nothing is joined, no
distinct count is expanded, and an ID on many rows costs no more than another.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revmap import texts
from revmap.functions.columns import any_of, count_null, one_row, percent, share_reaches
from revmap.functions.dates import run_stamp
from revmap.operators.mapping import Day, month_slice

# Coverage bands in percent.
PASS_PCT = 95
WARNING_PCT = 80
REPORT_PASS_PCT = 80
REPORT_WARNING_PCT = 50


def id_counts(month_rows: DataFrame, m: DataFrame) -> DataFrame:
    """Rows per ID on either side: id, n_revenue, n_mapping."""
    revenue = month_rows.select("id", F.lit(1).alias("revenue"), F.lit(0).alias("mapping"))
    mapping = m.select(F.col("ID").alias("id"), F.lit(0).alias("revenue"), F.lit(1).alias("mapping"))
    return (
        revenue.unionByName(mapping)
        .groupBy("id")
        .agg(F.sum("revenue").alias("n_revenue"), F.sum("mapping").alias("n_mapping"))
    )


def _figures(counts: DataFrame) -> DataFrame:
    keyed = F.col("id").isNotNull()
    revenue, mapping = F.col("n_revenue") > 0, F.col("n_mapping") > 0
    # A left join from the mapping repeats each mapping row once per revenue
    # row of its ID, and keeps it once if there is none.
    repeats = F.when(keyed, F.greatest("n_revenue", F.lit(1))).otherwise(1)
    return counts.agg(
        F.count_if(keyed & revenue).alias("total_revenue_records"),
        F.count_if(keyed & revenue & mapping).alias("mapped_revenue_records"),
        F.count_if(keyed & revenue & ~mapping).alias("unmapped_revenue_records"),
        F.count_if(keyed & mapping).alias("total_unique_mapping_records"),
        F.coalesce(F.sum(F.col("n_mapping") * repeats), F.lit(0)).alias("joined_mapping_records"),
        F.coalesce(F.sum("n_mapping"), F.lit(0)).alias("mapping_rows"),
        F.count_if(keyed & mapping & revenue).alias("used_mapping_records"),
        F.count_if(keyed & mapping & ~revenue).alias("unused_mapping_records"),
    )


def _status() -> Column:
    part, whole = "mapped_revenue_records", "total_revenue_records"
    return (
        F.when(share_reaches(part, whole, PASS_PCT), texts.PASS)
        .when(share_reaches(part, whole, WARNING_PCT), texts.WARNING)
        .otherwise(texts.FAIL)
    )


def coverage(
    r: DataFrame,
    m: DataFrame,
    *,
    variant: str = "script",
    run_ts: dt.datetime | str | None = None,
    as_of: Day | None = None,
    months_back: int = 1,
    month: Day | None = None,
) -> DataFrame:
    """The coverage summary, one row.

    ``variant="script"`` counts distinct mapping IDs. ``"model"`` adds the row
    count after the join, which repeats with duplicate IDs, and takes usage in
    percent of that; it also stamps the run. ``"document"`` is the mapping-first
    form without a status."""
    figures = _figures(id_counts(month_slice(r, as_of, months_back, month), m))
    section = F.lit(texts.COVERAGE_SUMMARY).alias("report_section")
    revenue = ["total_revenue_records", "mapped_revenue_records", "unmapped_revenue_records"]
    covered = percent("mapped_revenue_records", "total_revenue_records").alias("revenue_coverage_rate_pct")
    if variant == "script":
        return figures.select(
            section,
            *revenue,
            covered,
            F.col("total_unique_mapping_records").alias("total_mapping_records"),
            "used_mapping_records",
            "unused_mapping_records",
            percent("used_mapping_records", "total_unique_mapping_records").alias("mapping_usage_rate_pct"),
            _status().alias("revenue_coverage_status"),
        )
    if variant == "model":
        return figures.select(
            section,
            *revenue,
            covered,
            "total_unique_mapping_records",
            F.col("joined_mapping_records").alias("total_mapping_records"),
            "used_mapping_records",
            "unused_mapping_records",
            percent("used_mapping_records", "joined_mapping_records").alias("mapping_usage_rate_pct"),
            _status().alias("revenue_coverage_status"),
            run_stamp(run_ts).alias("test_run_timestamp"),
            F.lit(str(month) if month is not None else f"{months_back} months prior").alias("data_month_filter"),
        )
    if variant == "document":
        return figures.select(
            F.col("total_unique_mapping_records").alias("total_mapping_records"),
            F.col("used_mapping_records").alias("mapped_records"),
            F.col("unused_mapping_records").alias("unmapped_mapping_records"),
            percent("used_mapping_records", "total_unique_mapping_records").alias("mapping_success_rate_pct"),
            *revenue,
            covered,
        )
    raise ValueError(f"variant must be script, model or document, not {variant}")


def coverage_failures(
    r: DataFrame, m: DataFrame, *, threshold: int = PASS_PCT, fail_on_empty: bool = False, **kw
) -> DataFrame:
    """Data test: the coverage row if coverage is below ``threshold`` percent,
    else no row. Without revenue there is no coverage and the test passes,
    unless ``fail_on_empty``."""
    below = (F.col("total_revenue_records") > 0) & ~share_reaches(
        "mapped_revenue_records", "total_revenue_records", threshold
    )
    if fail_on_empty:
        below = below | (F.col("total_revenue_records") == 0)
    dropped = ["used_mapping_records", "unused_mapping_records", "mapping_usage_rate_pct"]
    return coverage(r, m, variant="model", **kw).where(below).drop(*dropped)


def merged_completeness(v: DataFrame) -> DataFrame:
    """Filled and missing counts in the mapped view, one pass."""
    return v.agg(
        F.lit(texts.MERGED_COMPLETENESS).alias("report_section"),
        F.count("*").alias("total_revenue_records"),
        F.count("id").alias("non_null_ids"),
        F.count("Oracle_Customer_Name").alias("non_null_customer_names"),
        F.count("Oracle_GL_Account").alias("non_null_gl_accounts"),
        count_null("data_month").alias("null_data_months"),
        count_null("id").alias("null_ids"),
        count_null("Oracle_Customer_Name").alias("null_customer_names"),
        count_null("Oracle_GL_Account").alias("null_gl_accounts"),
    ).withColumn("pct_revenue_without_mapping", percent("null_customer_names", "total_revenue_records"))


def revenue_by_mapping(v: DataFrame, measure: str | None = None) -> DataFrame:
    """Rows and IDs (and the sum of ``measure``) per customer, invoice group
    and GL account, largest first. Groups are formed before NULL is shown as
    UNMAPPED, so a real value of that name stays apart."""
    fields = ["Oracle_Customer_Name", "Oracle_Invoice_Group", "Oracle_GL_Account"]
    totals = [F.count_distinct("id").alias("unique_ids"), F.count("*").alias("total_records")]
    if measure is not None:
        totals.append(F.sum(measure).alias("total_revenue"))
    grouped = v.groupBy(*fields).agg(*totals)
    return grouped.select(
        F.lit(texts.REVENUE_BY_MAPPING).alias("report_section"),
        *[F.coalesce(F.col(c), F.lit(texts.UNMAPPED)).alias(c) for c in fields],
        *[c for c in grouped.columns if c not in fields],
    ).orderBy(F.desc("total_records"), *fields)


def unmapped_summary(v: DataFrame) -> DataFrame:
    """Rows of the mapped view without a customer name or a GL account."""
    return v.where(any_of([F.col("Oracle_Customer_Name").isNull(), F.col("Oracle_GL_Account").isNull()])).agg(
        F.lit(texts.UNMAPPED_SUMMARY).alias("report_section"),
        F.count_distinct("id").alias("unique_unmapped_ids"),
        F.count("*").alias("total_unmapped_records"),
    )


def merged_report(r: DataFrame, m: DataFrame, v: DataFrame, **month) -> DataFrame:
    """The full report on revenue ``r``, mapping ``m`` and mapped view ``v`` in
    one row: one pass over the view, one shuffle of the IDs of both sources."""
    view = v.agg(
        F.count("*").alias("total_revenue_records"),
        F.count_distinct("id").alias("unique_revenue_ids"),
        count_null("Oracle_GL_Account").alias("unmapped_revenue_count"),
    )
    source = _figures(id_counts(month_slice(r, **month), m)).select(
        F.col("total_revenue_records").alias("total_revenue_in_source"),
        F.col("mapped_revenue_records").alias("mapped_revenue_count"),
        F.col("mapping_rows").alias("total_mapping_records"),
    )
    is_unique = F.col("total_revenue_records") == F.col("unique_revenue_ids")

    def covered(pct: int) -> Column:
        return share_reaches("mapped_revenue_count", "total_revenue_in_source", pct)

    return one_row(view, source).select(
        F.lit(texts.MERGED_REPORT).alias("report_section"),
        "total_revenue_records",
        "unique_revenue_ids",
        F.when(is_unique, texts.PASS).otherwise(texts.FAIL_DUPLICATE_REVENUE).alias("uniqueness_status"),
        "total_revenue_in_source",
        "mapped_revenue_count",
        "unmapped_revenue_count",
        percent("mapped_revenue_count", "total_revenue_in_source").alias("revenue_coverage_rate_pct"),
        percent("unmapped_revenue_count", "total_revenue_records").alias("unmapped_revenue_pct"),
        "total_mapping_records",
        F.when(is_unique & covered(REPORT_PASS_PCT), texts.PASS_QUALITY)
        .when(covered(REPORT_WARNING_PCT), texts.WARN_COVERAGE)
        .otherwise(texts.FAIL_QUALITY)
        .alias("overall_status"),
    )
