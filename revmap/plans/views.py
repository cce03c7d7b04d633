"""The relations this library works on, derived from the order, customer and
event tables of a TPC-H-like data set. Every view reads whole tables.

Money is added up in whole cents and divided afterwards: exact in any order, and
a plain long sum in the generated code. Tables are read with a given schema,
which saves a look into their files; wide projections are SQL text, which saves
a call to the JVM per column."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revmap.functions.dates import as_date
from revmap.operators.rebuild import label_accounts
from revmap.schemas import MAPPING_COLS, MEASURES, REVENUE_COLS

SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}
AS_OF = "1998-02-15"
MONTH = (dt.date(1998, 1, 1), dt.date(1998, 2, 1))
EVENTS_AS_OF = "2024-01-31"
SINCE = "2024-01-10"
OLD_UNTIL = "2024-01-15"
EXCLUDED = "2024-01-05"
LABELS = {"click": "acct-click", "signup": "acct-signup", "purchase": "acct-manual"}
OTHER_LABEL = "acct-partner"
MANUAL = "acct-manual"
MANUAL_SITE = "purchase"
SOURCE = "manual revenue"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


# The revenue columns over one row per customer and month.
_REVENUE = {
    "id": "concat('C.', c_custkey)",
    "data_month": "data_month",
    "business_unit_name": "c_mktsegment",
    "business_unit_detail_name": "r_name",
    "product_line_id": "string(r_regionkey)",
    "product_line_name": "r_name",
    "parent_partner_id": "double(n_nationkey)",
    "parent_partner_name": "n_name",
    "partner_id": "string(c_custkey)",
    "partner_name": "c_name",
    "drid": "string(NULL)",
    "contract_id": "string(n_nationkey + 200)",
    "contract_name": "concat('Contract ', n_name)",
    "gam_advertiser_level1": "string(NULL)",
    "gam_advertiser_level2": "string(NULL)",
    "network_name_id": "string(n_nationkey)",
    "network_name": "n_name",
    "network_classification_name": "r_name",
    "network_classification_subtype": "c_mktsegment",
    "network_feed_id": "CASE WHEN c_acctbal >= 1000 THEN string(n_nationkey) END",
    "markup_percent": "taxes / 100D",
    "net_percent": "discounts / 100D",
    "revshare_percent": "CASE WHEN c_mktsegment <> 'BUILDING' THEN 10D END",
    "bad_debt_percent": "double(NULL)",
    "management_percent": "double(NULL)",
    "impressions": "double(quantity)",
    "clicks": "double(lines)",
    "network_gross_revenue": "price / 100D",
    "network_revshare": "discounted / 10000D",
    "s1_gross_revenue": "(price * 100 - discounted) / 10000D",
    "managment_fee": "double(NULL)",
    "partner_revshare": "discounted / 10000D",
    "holdback_revenue": "0D",
    "partner_gross_revenue": "price / 100D",
    "commission_amount": "taxed / 10000D",
    "aggregation_source": "'orders'",
}


def revenue(spark: SparkSession, sf_dir: str, lo: dt.date | None = None, hi: dt.date | None = None) -> DataFrame:
    """Monthly revenue per customer, 36 columns. A range of days limits the
    scan of orders to the months a query is about; if those orders are few
    enough to broadcast, the lines of all others are dropped where they are
    read. Otherwise lines are added up per order before they are shuffled, so
    that a long order is never gathered line by line."""
    orders = table(spark, sf_dir, "orders")
    if lo is not None:
        orders = orders.where(F.col("o_orderdate") >= F.lit(lo).cast("timestamp_ntz"))
    if hi is not None:
        orders = orders.where(F.col("o_orderdate") < F.lit(hi).cast("timestamp_ntz"))
    orders = orders.selectExpr("o_orderkey", "o_custkey", "trunc(date(o_orderdate), 'MM') AS data_month")
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey",
        "bigint(rint(l_quantity)) AS quantity",
        "bigint(rint(l_extendedprice * 100)) AS price",
        "bigint(rint(l_discount * 100)) AS discount",
        "bigint(rint(l_tax * 100)) AS tax",
    )
    sums = [
        F.expr("count(*) AS lines"),
        F.expr("sum(quantity) AS quantity"),
        F.expr("sum(discount) AS discounts"),
        F.expr("sum(tax) AS taxes"),
        F.expr("sum(price) AS price"),
        F.expr("sum(price * discount) AS discounted"),
        F.expr("sum(price * tax) AS taxed"),
    ]
    same_order = F.col("o_orderkey") == F.col("l_orderkey")
    if lo is not None or hi is not None:
        # Few orders: lines are looked up in them and not summed first.
        monthly = lines.join(orders, same_order).groupBy("o_custkey", "data_month").agg(*sums)
    else:
        per_order = lines.groupBy("l_orderkey").agg(*sums)
        totals = [F.sum(c).alias(c) for c in per_order.columns if c != "l_orderkey"]
        monthly = orders.join(per_order, same_order).groupBy("o_custkey", "data_month").agg(*totals)
    # Nations are few: joined to customers, not to revenue, they move little,
    # and what they add to a customer's size is a name or two.
    customers = table(spark, sf_dir, "customer")
    who = customers.join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    named = monthly.join(who, F.col("o_custkey") == F.col("c_custkey"))
    return named.selectExpr(*[f"{_REVENUE[c]} AS {c}" for c in REVENUE_COLS])


def exact(df: DataFrame, measures: list[str] = MEASURES) -> DataFrame:
    """The measures as decimals: their sums do not depend on an order, and their
    text has no exponent."""
    return df.withColumns({c: F.col(c).cast("decimal(18,4)") for c in measures})


_IDENT = "concat('C.', c_custkey)"


def _mapping_columns(ident: str = _IDENT) -> list[str]:
    columns = {
        "ID": ident,
        "Oracle_Customer_Name": "CASE WHEN c_acctbal >= 5000 AND c_acctbal < 5100 THEN '  ' "
        "WHEN c_acctbal < 9000 OR c_acctbal >= 9100 THEN c_name END",
        "Oracle_Customer_Name_ID": "string(c_custkey)",
        "Oracle_Invoice_Group": "c_mktsegment",
        "Oracle_Invoice_Name": "c_name",
        "Oracle_GL_Account": "CASE WHEN c_acctbal < 0 OR c_acctbal >= 500 THEN string(c_nationkey) END",
    }
    return [f"{columns[c]} AS {c}" for c in MAPPING_COLS]


def mapping_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mapping of every customer."""
    return table(spark, sf_dir, "customer").selectExpr(*_mapping_columns())


def mapping(spark: SparkSession, sf_dir: str, least: float = 0) -> DataFrame:
    """A mapping of the customers that are not in debt (or hold ``least``)."""
    return table(spark, sf_dir, "customer").where(F.col("c_acctbal") >= least).selectExpr(*_mapping_columns())


def mapping_faulty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`mapping_full` with faults: IDs twice, extra rows with a NULL or a
    blank ID."""
    return _with_faults(table(spark, sf_dir, "customer"))


def mapping_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`mapping` with the same faults; it leaves a gap for coverage to find."""
    return _with_faults(table(spark, sf_dir, "customer").where(F.col("c_acctbal") >= 0))


def _with_faults(rows: DataFrame) -> DataFrame:
    extra = (
        f"CASE WHEN c_acctbal >= 9800 THEN {_IDENT} "
        "WHEN c_acctbal >= 3000 AND c_acctbal < 3020 THEN '  ' END"
    )
    faulty = "c_acctbal >= 9800 OR c_acctbal >= 3000 AND c_acctbal < 3020 OR c_acctbal >= 2000 AND c_acctbal < 2050"
    return rows.selectExpr(*_mapping_columns()).union(rows.where(faulty).selectExpr(*_mapping_columns(extra)))


def prod(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One version of revenue: all but NATION_7."""
    return revenue(spark, sf_dir).where(F.col("network_name") != "NATION_7")


def dev(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Another version: without NATION_9, one unit more revenue for machinery
    in Asia, and half a cent more commission for furniture, which is within
    the tolerance."""
    more_revenue = F.expr("if(business_unit_name = 'MACHINERY' AND product_line_name = 'ASIA', 1D, 0D)")
    more_commission = F.expr("if(business_unit_name = 'FURNITURE', 0.005D, 0D)")
    changed = {
        "network_gross_revenue": F.col("network_gross_revenue") + more_revenue,
        "commission_amount": F.col("commission_amount") + more_commission,
    }
    return revenue(spark, sf_dir).where(F.col("network_name") != "NATION_9").withColumns(changed)


def _daily(spark: SparkSession, sf_dir: str, keys: list[str]) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("partner_website"), F.col("ts").cast("date").alias("order_date"), "value"
    )
    return (
        events.groupBy(*keys, "order_date")
        .agg(F.expr("sum(bigint(rint(value * 100))) AS cents"), F.count("*").alias("order_count"))
        .selectExpr(*keys, "order_date", "CAST(CAST(cents AS DECIMAL(18,0)) / 100 AS DECIMAL(18,2)) AS total_revenue", "order_count")
    )


def partner_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue per website (event type) and day."""
    return _daily(spark, sf_dir, ["partner_website"])


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label_accounts(partner_revenue(spark, sf_dir), LABELS, OTHER_LABEL)


def partners_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled revenue of the websites that have an account of their own."""
    return labelled(spark, sf_dir).where(F.col("account_id") != OTHER_LABEL)


def total_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue per day over all websites."""
    return _daily(spark, sf_dir, []).select(F.col("order_date").alias("data_date"), F.col("total_revenue").alias("revenue"))


def old_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The earlier partner source, which ends on OLD_UNTIL."""
    return labelled(spark, sf_dir).where(F.col("data_date") < as_date(OLD_UNTIL))


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Account metadata: two overlapping periods per website."""
    starts = (
        table(spark, sf_dir, "events").groupBy("event_type").agg(F.min(F.col("ts").cast("date")).alias("first_day"))
    )
    sites = starts.withColumn("days", F.lit(4)).union(starts.withColumn("days", F.lit(19)))
    account = F.lit(OTHER_LABEL)
    for site, label in LABELS.items():
        account = F.when(F.col("event_type") == site, label).otherwise(account)
    start = F.date_add("first_day", F.col("days"))
    return sites.select(
        account.alias("account_id"),
        F.col("event_type").alias("product_line_id"),
        F.length("event_type").alias("bi_account_id"),
        (F.length("event_type") + 10).alias("network_name_id"),
        F.lit("USD").alias("currency_code"),
        start.alias("effective_from"),
        F.date_add(start, 10).alias("effective_to"),
    )


def contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A contract per account number."""
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("int").alias("bi_account_id"), (F.col("s_nationkey") + 200).alias("contract_id")
    )


def doubles(df: DataFrame) -> DataFrame:
    """Decimal columns as doubles, for output."""
    return df.select(*[F.col(n).cast("double").alias(n) if t.startswith("decimal") else n for n, t in df.dtypes])
