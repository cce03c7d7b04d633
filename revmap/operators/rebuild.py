"""Rebuilding a manual revenue source from partner and total revenue."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revmap.functions.dates import as_date, run_stamp
from revmap.operators.skew import lookup_join

# Dimension codes of manually entered revenue.
DEVICE_TYPE_UNKNOWN = 4
METHOD_SUBTYPE_MANUAL = 3
CONVERSION_RATE = 1

SOURCE_COLS = ["account_id", "data_date", "revenue", "conversions"]


def label_accounts(
    df: DataFrame,
    labels: dict[str, str],
    default: str,
    *,
    website: str = "partner_website",
    date: str = "order_date",
    revenue: str = "total_revenue",
    conversions: str = "order_count",
) -> DataFrame:
    """Partner revenue with an account for each row: the label of its website,
    or ``default`` for a website without one (or no website)."""
    account = F.lit(default)
    for site, label in reversed(labels.items()):
        account = F.when(F.col(website) == site, label).otherwise(account)
    return df.select(
        account.alias("account_id"),
        F.col(date).cast("date").alias("data_date"),
        F.col(revenue).alias("revenue"),
        F.col(conversions).alias("conversions"),
        F.col(website).alias("partner_website"),
    )


def additional_revenue(
    all_rev: DataFrame, partner_rev: DataFrame, since: str | dt.date, account_id: str
) -> DataFrame:
    """Per day, total revenue less partner revenue, from ``since`` on. Days
    found on one side only are left out, as in an inner join of the daily sums;
    here both inputs are reduced to days in one shuffle instead."""
    columns = ["data_date", "revenue", "is_total"]
    stacked = all_rev.withColumn("is_total", F.lit(True)).select(columns).unionByName(
        partner_rev.withColumn("is_total", F.lit(False)).select(columns)
    )
    is_total = F.col("is_total")
    daily = (
        stacked.where(F.col("data_date") >= as_date(since))
        .groupBy("data_date")
        .agg(
            F.sum(F.when(is_total, F.col("revenue"))).alias("total"),
            F.sum(F.when(~is_total, F.col("revenue"))).alias("partner"),
            F.bool_or(is_total).alias("has_total"),
            F.bool_or(~is_total).alias("has_partner"),
        )
    )
    return daily.where("has_total AND has_partner").select(
        "data_date", F.lit(account_id).alias("account_id"), (F.col("total") - F.col("partner")).alias("revenue")
    )


def combine_sources(
    old: DataFrame,
    new: DataFrame,
    *,
    website: str,
    account_id: str,
    exclude_date: str | dt.date | None = None,
    dedup: bool = True,
) -> DataFrame:
    """The old source's rows of one website and the new source's rows, as
    account, date, revenue and conversions. Equal rows become one unless
    ``dedup`` is False; see :func:`dropped_rows` for what that removes."""
    kept = old.where(F.col("partner_website") == website)
    if exclude_date is not None:
        kept = kept.where(F.col("data_date") != as_date(exclude_date))
    kept = kept.select(F.lit(account_id).alias("account_id"), "data_date", "revenue", "conversions")
    added = new.select("account_id", "data_date", "revenue", F.lit(0).cast("bigint").alias("conversions"))
    both = kept.unionByName(added)
    return both.distinct() if dedup else both


def dropped_rows(old: DataFrame, new: DataFrame, **kw) -> DataFrame:
    """How many equal rows, and how much revenue, ``dedup`` removes."""
    both = combine_sources(old, new, dedup=False, **kw)
    copies = both.groupBy(*SOURCE_COLS).agg((F.count("*") - 1).alias("extra"))
    return copies.agg(
        F.coalesce(F.sum("extra"), F.lit(0)).alias("dropped_rows"),
        F.sum(F.col("extra") * F.col("revenue")).alias("dropped_revenue"),
    )


def account_metadata(df: DataFrame, code_length: int = 10) -> DataFrame:
    """Account metadata with its integer and code columns typed. A currency code
    longer than ``code_length`` is cut there, as in a column of that length."""
    return df.withColumns(
        {
            "bi_account_id": F.col("bi_account_id").cast("int"),
            "network_name_id": F.col("network_name_id").cast("int"),
            "currency_code": F.substring(F.col("currency_code").cast("string"), 1, code_length),
        }
        | ({"network_type_id": F.col("network_type_id").cast("int")} if "network_type_id" in df.columns else {})
    )


def periods_by_month(periods: DataFrame, since: Column, until: Column, *, start: str = "effective_from", end: str = "effective_to") -> DataFrame:
    """Each period once for every month it touches between two dates, as
    ``period_month``; an open end lasts to ``until``. A day lies in one month, so a fact
    joined on its month meets a period at most once. Periods without a start, and those
    that end before they start, have no month."""
    first = F.trunc(F.greatest(F.col(start), since), "MM")
    last = F.least(F.coalesce(F.col(end), until), until)
    begun = F.col(start).isNotNull() & since.isNotNull() & (F.col(start) <= last) & (first <= last)
    months = F.sequence(first, F.trunc(last, "MM"), F.expr("INTERVAL 1 MONTH"))
    return periods.withColumn("period_month", F.explode(F.when(begun, months)))


def effective_join(
    facts: DataFrame,
    accounts: DataFrame,
    contracts: DataFrame,
    *,
    as_of: str | dt.date,
    aggregation_source: str,
    run_ts: dt.datetime | str | None = None,
    use_effective_to: bool = False,
) -> DataFrame:
    """The manual revenue model: each fact with every account row in force on
    its date and that account's contracts, up to the day before ``as_of``.

    An account row is in force from ``effective_from`` on; ``effective_to``
    counts only with ``use_effective_to`` (NULL is open), so by default a fact
    meets every period that began before it. With it, periods are laid out by month
    and facts meet only those of their own month, so the pairs that are tested are in
    proportion to those that match however many periods an account has. Accounts are
    few and facts pile up on them: accounts and contracts are joined first, so that the
    facts are moved once if at all, and adaptive execution broadcasts or splits the rest."""
    dim = accounts.select(
        F.col("account_id").alias("dim_account_id"),
        "product_line_id",
        "network_name_id",
        "currency_code",
        "bi_account_id",
        "effective_from",
        "effective_to",
    )
    in_force = F.col("data_date") >= F.col("effective_from")
    if use_effective_to:
        in_force = in_force & (F.col("effective_to").isNull() | (F.col("data_date") <= F.col("effective_to")))
    signed = contracts.select(F.col("bi_account_id").alias("contract_account_id"), "contract_id")
    closed = facts.where(F.col("data_date") <= F.date_sub(as_date(as_of), 1))
    signed_accounts = lookup_join(dim, signed, "bi_account_id", "contract_account_id", "inner")
    if use_effective_to:
        first = closed.agg(F.min("data_date")).scalar()
        signed_accounts = periods_by_month(signed_accounts, first, F.date_sub(as_date(as_of), 1))
        in_force = in_force & (F.trunc("data_date", "MM") == F.col("period_month"))
    matched = lookup_join(closed, signed_accounts, "account_id", "dim_account_id", "inner", in_force)
    return matched.select(
        F.col("data_date").alias("data_ts"),
        "product_line_id",
        "network_name_id",
        "contract_id",
        F.lit(DEVICE_TYPE_UNKNOWN).alias("device_type_id"),
        F.lit(METHOD_SUBTYPE_MANUAL).alias("method_subtype_id"),
        "currency_code",
        F.lit(CONVERSION_RATE).alias("conversion_rate"),
        F.lit(None).cast("double").alias("bidded_searches"),
        F.lit(None).cast("double").alias("clicks"),
        F.lit(None).cast("double").alias("impressions"),
        F.col("revenue").cast("double").alias("gross_revenue"),
        "conversions",
        F.lit(aggregation_source).alias("aggregation_source"),
        run_stamp(run_ts).alias("aggregation_date"),
    )


def monthly_totals(src: DataFrame, *, date: str = "data_date", amount: str = "revenue") -> DataFrame:
    """The amount per month, oldest first."""
    return (
        src.groupBy(F.trunc(date, "MM").alias("data_month"))
        .agg(F.sum(amount).alias("revenue"))
        .orderBy("data_month")
    )


def month_total(
    src: DataFrame,
    month: str | dt.date,
    *,
    date: str = "data_date",
    amount: str = "revenue",
    counted_only: bool = False,
) -> DataFrame:
    """The amount of one month; ``counted_only`` leaves out rows without a
    conversion count. The month is tested as a range of days, which the scan
    can use, and not on a truncated date."""
    first = F.trunc(as_date(month), "MM")
    rows = src.where((F.col(date) >= first) & (F.col(date) < F.add_months(first, 1)))
    if counted_only:
        rows = rows.where(F.col("conversions") >= 0)
    return rows.agg(F.sum(amount).alias("revenue"))
