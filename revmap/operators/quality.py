"""Checks on the raw mapping table. Each one is a single aggregate over the
table with map-side combining, or a filter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revmap import texts
from revmap.functions.columns import any_of, count_null, is_blank, null_label
from revmap.operators.skew import ordered_by
from revmap.schemas import MAPPING_COLS


def quick_check(m: DataFrame) -> DataFrame:
    """Totals right after a load; passes if every row has its own ID."""
    return m.agg(
        F.count("*").alias("total_rows"),
        F.count_distinct("ID").alias("unique_ids"),
        count_null("ID").alias("null_ids"),
        count_null("Oracle_Customer_Name").alias("null_customer_names"),
        count_null("Oracle_GL_Account").alias("null_gl_accounts"),
    ).select(
        F.lit(texts.QUICK_CHECK).alias("check_type"),
        "*",
        F.when((F.col("total_rows") == F.col("unique_ids")) & (F.col("null_ids") == 0), texts.PASS)
        .otherwise(texts.FAIL_QUICK)
        .alias("status"),
    )


def uniqueness(m: DataFrame, key: str = "ID") -> DataFrame:
    """Rows against distinct keys. A NULL key is a row but not a key, so it
    counts as a duplicate."""
    return m.agg(F.count("*").alias("total_records"), F.count_distinct(key).alias("unique_ids")).select(
        F.lit(texts.UNIQUENESS_CHECK).alias("check_name"),
        "*",
        (F.col("total_records") - F.col("unique_ids")).alias("duplicate_count"),
        F.when(F.col("total_records") == F.col("unique_ids"), texts.PASS)
        .otherwise(texts.FAIL_DUPLICATE_IDS)
        .alias("status"),
    )


def duplicates(df: DataFrame, key: str = "ID", section: str | None = None) -> DataFrame:
    """Keys on more than one row, most frequent first; NULL is one key."""
    counts = df.groupBy(F.col(key).alias("ID")).agg(F.count("*").alias("occurrence_count"))
    repeated = counts.where("occurrence_count > 1").orderBy(F.desc("occurrence_count"), F.asc_nulls_last("ID"))
    if section is None:
        return repeated
    return repeated.select(F.lit(section).alias("report_section"), "*")


def completeness(m: DataFrame) -> DataFrame:
    """Filled and missing counts per column."""
    return m.agg(
        F.lit(texts.COMPLETENESS_CHECK).alias("check_name"),
        F.count("*").alias("total_records"),
        F.count("ID").alias("non_null_ids"),
        F.count("Oracle_Customer_Name").alias("non_null_customer_names"),
        F.count("Oracle_Customer_Name_ID").alias("non_null_customer_name_ids"),
        F.count("Oracle_Invoice_Group").alias("non_null_invoice_groups"),
        F.count("Oracle_Invoice_Name").alias("non_null_invoice_names"),
        F.count("Oracle_GL_Account").alias("non_null_gl_accounts"),
        count_null("ID").alias("null_ids"),
        count_null("Oracle_Customer_Name").alias("null_customer_names"),
        count_null("Oracle_GL_Account").alias("null_gl_accounts"),
    )


def null_ids(m: DataFrame) -> DataFrame:
    """The rows without an ID."""
    return m.where(F.col("ID").isNull())


def null_critical(
    m: DataFrame, columns: dict[str, str] | None = None
) -> DataFrame:
    """Rows where a critical column is NULL, with a NULL/OK label for each.
    ``columns`` maps column names to label names."""
    columns = columns or {"Oracle_Customer_Name": "customer_name_status", "Oracle_GL_Account": "gl_account_status"}
    return m.where(any_of(F.col(c).isNull() for c in columns)).select(
        "ID", *[null_label(c).alias(label) for c, label in columns.items()]
    )


def format_check(m: DataFrame, pattern: str = texts.ID_PATTERN) -> DataFrame:
    """How many IDs match ``pattern``. IDs may hold dots: pass a pattern that
    allows them if yours do."""
    return m.agg(
        F.count("*").alias("total_records"), F.count_if(F.col("ID").rlike(pattern)).alias("valid_format_ids")
    ).select(
        F.lit(texts.FORMAT_CHECK).alias("check_name"),
        "*",
        (F.col("total_records") - F.col("valid_format_ids")).alias("invalid_format_ids"),
    )


def empty_check(m: DataFrame) -> DataFrame:
    """Texts made of spaces only."""
    return m.agg(
        F.lit(texts.EMPTY_CHECK).alias("check_name"),
        F.count_if(is_blank("ID")).alias("empty_ids"),
        F.count_if(is_blank("Oracle_Customer_Name")).alias("empty_customer_names"),
        F.count_if(is_blank("Oracle_GL_Account")).alias("empty_gl_accounts"),
    )


def length_profile(m: DataFrame) -> DataFrame:
    """Shortest and longest values, and the mean ID length."""
    size = {c: F.length(c).cast("bigint") for c in ("ID", "Oracle_Customer_Name", "Oracle_GL_Account")}
    return m.agg(
        F.lit(texts.LENGTH_CHECK).alias("check_name"),
        F.min(size["ID"]).alias("min_id_length"),
        F.max(size["ID"]).alias("max_id_length"),
        F.avg(size["ID"]).alias("avg_id_length"),
        F.min(size["Oracle_Customer_Name"]).alias("min_customer_name_length"),
        F.max(size["Oracle_Customer_Name"]).alias("max_customer_name_length"),
        F.min(size["Oracle_GL_Account"]).alias("min_gl_account_length"),
        F.max(size["Oracle_GL_Account"]).alias("max_gl_account_length"),
    )


def dq_summary(m: DataFrame) -> DataFrame:
    """All raw checks in one row and one pass, with an overall verdict: IDs
    present, not blank and unique, and every row has a GL account."""
    counted = m.agg(
        F.count("*").alias("total_records"),
        F.count_distinct("ID").alias("unique_ids"),
        F.count_if(F.col("ID").isNull() | is_blank("ID")).alias("total_invalid_ids"),
        count_null("Oracle_Customer_Name").alias("missing_customer_names"),
        count_null("Oracle_GL_Account").alias("missing_gl_accounts"),
        count_null("Oracle_Customer_Name_ID").alias("missing_customer_name_ids"),
        count_null("Oracle_Invoice_Group").alias("missing_invoice_groups"),
        count_null("Oracle_Invoice_Name").alias("missing_invoice_names"),
    )
    unique = F.col("total_records") == F.col("unique_ids")
    ids_ok = F.col("total_invalid_ids") == 0
    return counted.select(
        F.lit(texts.RAW_SUMMARY).alias("report_section"),
        "total_records",
        "unique_ids",
        F.when(unique, texts.PASS).otherwise(texts.FAIL).alias("uniqueness_status"),
        "total_invalid_ids",
        F.when(ids_ok, texts.PASS).otherwise(texts.FAIL).alias("id_completeness_status"),
        "missing_customer_names",
        "missing_gl_accounts",
        "missing_customer_name_ids",
        "missing_invoice_groups",
        "missing_invoice_names",
        F.when(ids_ok & unique & (F.col("missing_gl_accounts") == 0), texts.PASS_QUALITY)
        .otherwise(texts.FAIL_QUALITY)
        .alias("overall_status"),
    )


def check_rows(m: DataFrame) -> DataFrame:
    """The three headline checks, one per row: the table is aggregated once and
    the single row unpivoted."""
    counted = m.agg(
        F.count("*").alias("total"), F.count_distinct("ID").alias("distinct"), count_null("ID").alias("nulls")
    )

    def check(name, value, status):
        return F.struct(F.lit(name).alias("check_type"), value.alias("check_value"), status.alias("check_status"))

    unique = F.when(F.col("distinct") == F.col("total"), texts.PASS).otherwise(texts.FAIL_DUPLICATES)
    filled = F.when(F.col("nulls") == 0, texts.PASS).otherwise(texts.FAIL_NULL_IDS)
    checks = F.array(
        check(texts.TOTAL_RECORDS, F.col("total"), F.lit(None).cast("string")),
        check(texts.UNIQUE_IDS, F.col("distinct"), unique),
        check(texts.NULL_IDS, F.col("nulls"), filled),
    )
    return counted.select(F.inline(checks))


def preview(df: DataFrame, section: str = texts.RAW_PREVIEW, n: int = 10, order_by: str = "ID") -> DataFrame:
    """The first ``n`` rows by ``order_by``, each task keeping only its own."""
    rest = [c for c in df.columns if c.lower() != order_by.lower()]
    top = df.orderBy(F.asc_nulls_last(order_by), *[F.asc_nulls_last(c) for c in rest]).limit(n)
    return top.select(F.lit(section).alias("report_section"), "*")


def not_null(df: DataFrame, column: str) -> DataFrame:
    """Column test: the failing rows."""
    return df.where(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """Column test: values on more than one row. NULL is not a value here."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("unique_field"))
        .agg(F.count("*").alias("n_records"))
        .where("n_records > 1")
    )


def staged(m: DataFrame) -> DataFrame:
    """The mapping for downstream models: trimmed, renamed, with an ID."""
    return m.where(F.col("ID").isNotNull()).select(
        "ID",
        F.trim("Oracle_Customer_Name").alias("customer_name"),
        F.col("Oracle_GL_Account").alias("gl_account"),
    )


def typed(m: DataFrame, *, require_id: bool = False, ordered: bool = False) -> DataFrame:
    """The mapping columns in order and as strings."""
    out = m.select(*[F.col(c).cast("string").alias(c) for c in MAPPING_COLS])
    if require_id:
        out = out.where(F.col("ID").isNotNull())
    return ordered_by(out, F.asc_nulls_last("ID")) if ordered else out
