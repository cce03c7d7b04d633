"""Verifying what an export wrote against what it was written from.

Exported rows are counted as parsed, by column name: a header is not a row, and
the ID is the column of that name wherever it stands."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revmap import texts
from revmap.functions.columns import has_special_chars, null_label, one_row
from revmap.functions.dates import run_stamp
from revmap.operators.skew import lookup_join, ordered_by
from revmap.schemas import EXPORT_HEADER, MAPPING_ATTRS
from revmap.sources.export import read_export
from revmap.sources.files import folder_name, list_files, name_matches


def _names(prefix: str) -> str:
    """The names of the exports of a prefix, as a regular expression."""
    return re.escape(prefix) + r"(?:_\d{6})?"


def exports(spark: SparkSession, root: str, prefix: str) -> DataFrame:
    """The exports of ``prefix`` below ``root``, at any depth, newest first: part
    files, bytes and times. Their names are the prefix and a month; ``prefix`` may
    be such a name itself."""
    return (
        list_files(spark, root, glob="*.csv*")
        .withColumn("export_name", folder_name(F.col("path")))
        .where(name_matches(F.col("export_name"), _names(prefix)))
        .groupBy("export_name")
        .agg(
            F.count("*").alias("files"),
            F.sum("length").alias("bytes"),
            F.min("modificationTime").alias("first_modified"),
            F.max("modificationTime").alias("last_modified"),
        )
        .orderBy(F.desc("last_modified"), F.desc("export_name"))
    )


def export_verify(spark: SparkSession, src: DataFrame, root: str, prefix: str, *, header: bool = True) -> DataFrame:
    """Files and rows of all exports of ``prefix`` against the source's rows;
    ``header=False`` for exports without one."""
    files = exports(spark, root, prefix).agg(
        F.coalesce(F.sum("files"), F.lit(0)).alias("total_files"),
        F.min("first_modified").alias("first_file_exported"),
        F.max("last_modified").alias("last_file_exported"),
    )
    source = src.agg(F.count("*").alias("source_row_count"))
    written = _exported(spark, root, prefix, src, header)
    frames = [files, source]
    if written is not None:
        frames.append(written.agg(F.count("*").alias("total_rows_exported")))
    found = one_row(*frames)
    if written is None:
        found = found.withColumn("total_rows_exported", F.lit(None).cast("bigint"))
    return found.select(
        F.lit(texts.EXPORT_VERIFICATION).alias("report_section"),
        "total_files",
        "total_rows_exported",
        "source_row_count",
        F.when(F.col("total_rows_exported") == F.col("source_row_count"), texts.PASS_ALL_ROWS)
        .otherwise(texts.WARN_ROWS)
        .alias("export_status"),
        "first_file_exported",
        "last_file_exported",
    )


def _exported(spark: SparkSession, root: str, prefix: str, src: DataFrame, header: bool) -> DataFrame | None:
    """Rows of every export of ``prefix``, or None if there is none. They are found
    as they are listed, at any depth."""
    if exports(spark, root, prefix).isEmpty():
        return None
    return read_export(spark, root, [c.upper() for c in src.columns], header=header, export_name=_names(prefix))


def _latest(
    spark: SparkSession, src: DataFrame, root: str, prefix: str, header: bool
) -> tuple[DataFrame, list[DataFrame]]:
    """The newest export's listing (at most one row) and, if there is one, the
    counts of its rows. Only that export is read."""
    latest = exports(spark, root, prefix).limit(1)
    row = latest.first()
    listing = latest.select(F.col("export_name").alias("file_name"), "last_modified")
    if row is None:
        return listing, []
    written = _exported(spark, root, row.export_name, src, header)
    counts = written.agg(F.count("*").alias("exported_row_count"), F.count_distinct("ID").alias("exported_unique_ids"))
    return listing, [counts]


def _compared(spark: SparkSession, src: DataFrame, root: str, prefix: str, header: bool) -> DataFrame:
    source = src.agg(
        F.count("*").alias("source_row_count"),
        F.count_distinct("ID").alias("source_unique_ids"),
        F.min("data_month").alias("min_data_month"),
        F.max("data_month").alias("max_data_month"),
        F.count_distinct("data_month").alias("distinct_data_months"),
    )
    listing, counts = _latest(spark, src, root, prefix, header)
    if not counts:
        # No export: the columns are there, and NULL.
        counts = [listing.select(F.lit(0).alias("n")).where("false").agg(
            F.max("n").cast("bigint").alias("exported_row_count"), F.max("n").cast("bigint").alias("exported_unique_ids")
        )]
    return one_row(source, listing, *counts)


def export_qa(
    spark: SparkSession,
    src: DataFrame,
    root: str,
    prefix: str,
    run_ts: dt.datetime | str | None = None,
    *,
    header: bool = True,
) -> DataFrame:
    """The newest export of ``prefix`` (or the one of that full name) against its
    source, one row. A missing export is reported, not passed over;
    ``header=False`` for exports without one."""
    rows_differ = F.col("source_row_count") != F.col("exported_row_count")
    no_file, empty = F.col("file_name").isNull(), F.col("exported_row_count") == 0
    ratio = F.col("exported_row_count").cast("decimal(20,0)") * 100 / F.nullif(
        F.col("source_row_count").cast("decimal(20,0)"), F.lit(0)
    )
    return _compared(spark, src, root, prefix, header).select(
        F.lit(texts.EXPORT_QA).alias("report_section"),
        "source_row_count",
        F.col("exported_row_count").alias("exported_data_row_count"),
        "source_unique_ids",
        "exported_unique_ids",
        "file_name",
        "last_modified",
        "min_data_month",
        "max_data_month",
        "distinct_data_months",
        (F.col("source_row_count") - F.col("exported_row_count")).alias("row_count_difference"),
        F.round(ratio, 2).cast("double").alias("export_completeness_pct"),
        F.when(no_file, texts.FAIL_NO_FILE)
        .when(empty, texts.FAIL_EMPTY_FILE)
        .when(rows_differ, texts.WARN_ROWS)
        .when(F.col("source_unique_ids") != F.col("exported_unique_ids"), texts.WARN_IDS)
        .otherwise(texts.PASS_EXPORT)
        .alias("export_status"),
        F.when(no_file, texts.DETAIL_NO_FILE)
        .when(empty, texts.DETAIL_EMPTY_FILE)
        .when(
            rows_differ,
            F.format_string(
                "Source has %d rows, exported has %d rows", F.col("source_row_count"), F.col("exported_row_count")
            ),
        )
        .otherwise(texts.DETAIL_OK)
        .alias("validation_details"),
        run_stamp(run_ts).alias("qa_run_timestamp"),
    )


def export_failures(spark: SparkSession, src: DataFrame, root: str, prefix: str, *, header: bool = True) -> DataFrame:
    """Data test on the newest export: one row if it is missing, empty or has
    another number of rows than its source, else none."""
    rows_differ = F.col("source_row_count") != F.col("exported_row_count")
    no_file, empty = F.col("file_name").isNull(), F.col("exported_row_count") == 0
    return (
        _compared(spark, src, root, prefix, header)
        .where(no_file | rows_differ | empty)
        .select(
            F.lit(texts.EXPORT_FAILED).alias("validation_status"),
            "source_row_count",
            "exported_row_count",
            "source_unique_ids",
            "exported_unique_ids",
            "file_name",
            "last_modified",
            F.when(no_file, texts.REASON_NO_FILE)
            .when(rows_differ, texts.REASON_ROWS)
            .when(empty, texts.REASON_EMPTY)
            .alias("failure_reason"),
        )
    )


def header_check(raw: DataFrame, expected: list[str] = EXPORT_HEADER, *, escape_underscore: bool = False) -> DataFrame:
    """What the first row of each file looks like, from a positional read. A
    first field with a dot, with any character at all, or longer than 20 counts
    as text; with ``escape_underscore`` it takes a real underscore instead of
    any character, and only then can a number be told from a header."""
    c1, c2, c3 = F.col("c1"), F.col("c2"), F.col("c3")
    exact = (c1 == expected[0]) & (c2 == expected[1]) & (c3 == expected[2])
    some = c1.contains("_") if escape_underscore else c1.like("%_%")
    likely = c1.contains(".") | some | (F.length(c1) > 20)
    return raw.where(F.col("row_number") == 1).select(
        F.when(exact, texts.HEADERS_FOUND)
        .when(likely, texts.HEADERS_LIKELY)
        .when(c1.try_cast("decimal(38,0)").isNotNull(), texts.HEADERS_NONE)
        .otherwise(texts.HEADERS_UNCERTAIN)
        .alias("header_check_status"),
        c1.alias("first_column_sample"),
        c2.alias("second_column_sample"),
        c3.alias("third_column_sample"),
        "row_number",
        "file_name",
    )


def header_by_count(raw: DataFrame, src: DataFrame, *, files: int = 1) -> DataFrame:
    """Whether a header is there, from row counts: all rows of the files
    against the source's. Every one of ``files`` part files has its own
    header. Needs no row numbers."""
    counts = one_row(
        raw.agg(F.count("*").alias("file_row_count")), src.agg(F.count("*").alias("source_row_count"))
    )
    extra = F.col("file_row_count") - F.col("source_row_count")
    return counts.select(
        F.lit(texts.FILE_STATISTICS).alias("check_type"),
        "file_row_count",
        "source_row_count",
        extra.alias("difference"),
        F.when(extra == files, texts.COUNT_PRESENT)
        .when(extra == 0, texts.COUNT_NONE)
        .otherwise(texts.COUNT_MISMATCH)
        .alias("header_analysis"),
    )


def header_validation(raw: DataFrame, expected: list[str] = EXPORT_HEADER) -> DataFrame:
    """The first row of each file against the expected names."""
    first = ["first_column", "second_column", "third_column", "fourth_column", "fifth_column"]
    match = (F.col("c1") == expected[0]) & (F.col("c2") == expected[1]) & (F.col("c3") == expected[2])
    return raw.where(F.col("row_number") == 1).select(
        F.lit(texts.HEADER_VALIDATION).alias("check_type"),
        F.when(match, texts.HEADERS_CONFIRMED).otherwise(texts.HEADERS_NOT_FOUND).alias("validation_result"),
        *[F.col(f"c{i}").alias(name) for i, name in enumerate(first, 1)],
        "file_name",
    )


def preview_rows(raw: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` rows of each file, the first one marked as header."""
    shown = F.concat(F.col("c1"), F.lit(","), F.col("c2"), F.lit(","), F.col("c3"), F.lit("..."))
    return (
        raw.where(F.col("row_number") <= n)
        .select(
            F.col("row_number").alias("row_num"),
            F.when(F.col("row_number") == 1, texts.HEADER_ROW).otherwise(texts.DATA_ROW).alias("row_type"),
            F.col("c1").alias("col1"),
            F.col("c2").alias("col2"),
            F.col("c3").alias("col3"),
            F.substring(shown, 1, 100).alias("first_three_cols_preview"),
            "file_name",
        )
        .orderBy("file_name", "row_num")
    )


def missing_ids(src: DataFrame, exported: DataFrame, *, ordered: bool = True) -> DataFrame:
    """IDs of the source that the export lacks. Both sides are reduced to
    distinct IDs in each task before they are shuffled."""
    have = src.where(F.col("ID").isNotNull()).select(F.col("ID").alias("missing_id")).distinct()
    wrote = exported.where(F.col("ID").isNotNull()).select(F.col("ID").alias("exported_id")).distinct()
    missing = lookup_join(have, wrote, "missing_id", "exported_id", "left_anti")
    if ordered:
        missing = ordered_by(missing, F.col("missing_id"))
    return missing.select(F.lit(texts.MISSING_IN_EXPORT).alias("status"), "missing_id")


def field_status(src: DataFrame, record_id: str | None = None) -> DataFrame:
    """Why a record might not survive an export: NULL attributes, characters
    that upset a CSV parser, dots in the ID. All records, or one ID's."""
    rows = src if record_id is None else src.where(F.col("ID") == record_id)
    return rows.select(
        F.col("ID").alias("ID"),
        *[null_label(c, "HAS_VALUE").alias(f"{c}_status") for c in MAPPING_ATTRS],
        *[
            F.when(has_special_chars(c), "HAS_SPECIAL_CHARS").otherwise("OK").alias(f"{c}_chars")
            for c in ("Oracle_Customer_Name", "Oracle_Invoice_Name")
        ],
        F.length("ID").cast("bigint").alias("id_length"),
        F.when(F.col("ID").contains("."), "HAS_DOTS").otherwise("NO_DOTS").alias("id_format"),
    )


def investigate(src: DataFrame, exported: DataFrame, record_id: str) -> dict[str, DataFrame]:
    """Everything known about one record, and all missing IDs."""
    of_id = F.col("ID") == record_id
    return {
        "exists": src.where(of_id).agg(
            F.lit(texts.RECORD_EXISTS).alias("check_type"), F.count("*").alias("record_count")
        ),
        "record": src.where(of_id),
        "field_status": field_status(src, record_id),
        "in_export": exported.where(of_id).agg(
            F.lit(texts.EXPORTED_CHECK).alias("check_type"), F.count("*").alias("exported_count")
        ),
        "missing": missing_ids(src, exported),
    }
