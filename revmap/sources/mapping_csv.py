"""Reading account-mapping files and raw delimited files."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revmap.functions.columns import count_null, null_tokens
from revmap.functions.dates import run_stamp
from revmap.schemas import CSV_OPTS, MAPPING, MAPPING_COLS, string_schema
from revmap.sources.files import file_name, latest_file, list_files, name_matches
from revmap.sources.numbering import add_offsets, count_blocks, number_rows, place_columns
from revmap.sources.utf8 import invalid_lines

CORRUPT = "_corrupt_record"


def _any_row() -> Column:
    """True of every row. It reads a column of the file: Spark refuses to read the
    corrupt record alone, as a count would."""
    return F.length(F.coalesce("ID", F.lit(""))) >= 0


def _raw(
    spark: SparkSession, path: str, *, pattern: str | None, latest: bool, mode: str, check_header: bool, multi_line: bool
) -> DataFrame:
    if latest:
        newest = latest_file(list_files(spark, path, pattern=pattern))
        if newest is None:
            raise FileNotFoundError(f"no mapping file in {path}")
        path = newest
    raw = (
        spark.read.schema(T.StructType([*MAPPING.fields, T.StructField(CORRUPT, T.StringType())]))
        .options(**CSV_OPTS)
        .option("header", True)
        .option("multiLine", multi_line)
        .option("enforceSchema", not check_header)
        .option("mode", mode)
        # All columns are parsed whatever is read later, so a bad row is one to every reader.
        .option("columnPruning", False)
        .option("recursiveFileLookup", True)
        .csv(path)
    )
    if pattern is not None and not latest:
        # Spark evaluates this on the file listing: other files are not opened.
        raw = raw.where(name_matches(F.col("_metadata.file_name"), pattern))
    return raw


def read_mapping(
    spark: SparkSession,
    path: str,
    *,
    pattern: str | None = None,
    latest: bool = False,
    on_error: str = "abort",
    check_header: bool = True,
    multi_line: bool = True,
) -> DataFrame:
    """The mapping from one file, or from a folder and those below it: every file,
    those whose name matches ``pattern``, or the ``latest`` of them.

    Short rows are filled with NULL and extra fields dropped
    (``on_error="abort"``: only a file the parser cannot read stops the load).
    ``"strict"`` also stops at such a row and ``"continue"`` leaves it out.
    ``check_header`` demands the mapping's names in their order. With
    ``multi_line`` quoted values may hold line breaks, and each file is read by
    one task; turn it off for files too large for that which hold none."""
    mode = {"abort": "PERMISSIVE", "strict": "FAILFAST", "continue": "PERMISSIVE"}.get(on_error)
    if mode is None:
        raise ValueError(f"on_error must be abort, strict or continue, not {on_error}")
    raw = _raw(
        spark, path, pattern=pattern, latest=latest, mode=mode, check_header=check_header, multi_line=multi_line
    )
    if on_error == "continue":
        raw = raw.where(F.col(CORRUPT).isNull() & _any_row())
    return null_tokens(raw.select(*MAPPING_COLS), MAPPING_COLS)


def load_report(
    spark: SparkSession,
    path: str,
    *,
    pattern: str | None = None,
    run_ts: dt.datetime | str | None = None,
    check_header: bool = True,
    multi_line: bool = True,
    count_invalid: bool = False,
) -> DataFrame:
    """What a load of ``path`` and the folders below it reads, one row per file:
    size, rows, rows with the wrong number of fields, and the first such record: its
    number and its first missing or surplus column. Counted in one pass while parsing,
    by block of a file, so large files may be split; nothing is cached.

    With ``count_invalid`` the files are read once more, as lines, for bytes that are
    no UTF-8: ``invalid_lines``, ``replaced_characters`` and ``first_invalid_line``."""
    raw = _raw(
        spark,
        path,
        pattern=pattern,
        latest=False,
        mode="PERMISSIVE",
        check_header=check_header,
        multi_line=multi_line,
    )
    rows = raw.where(_any_row()).select(F.col("_metadata.file_size").alias("file_size"), *place_columns(), "ID", CORRUPT)
    bad = F.when(F.col(CORRUPT).isNotNull(), F.col("position"))
    blocks = count_blocks(
        rows,
        F.first("file_size").alias("file_size"),
        F.count(CORRUPT).alias("errors"),
        count_null("ID").alias("null_ids"),
        F.min_by(CORRUPT, bad).alias("first_error"),
        F.min(bad).alias("first_bad"),
    )
    bad_block = F.when(F.col("errors") > 0, F.col("block"))
    record = F.col("rows_before") + F.col("first_bad") - F.col("first") + 1
    counted = add_offsets(blocks).groupBy("path").agg(
        F.first("file_size").alias("file_size"),
        F.sum("rows_in").alias("row_parsed"),
        F.sum("errors").alias("error_count"),
        F.sum("null_ids").alias("null_ids"),
        F.min_by("first_error", bad_block).alias("first_error"),
        F.min_by(record, bad_block).alias("first_error_record"),
    )
    # Commas outside quotes end a field.
    fields = F.size(F.split("first_error", r',(?=(?:[^"]*"[^"]*")*[^"]*$)'))
    column = F.when(F.col("first_error").isNotNull(), F.least(fields, F.lit(len(MAPPING_COLS))) + 1)
    invalid = []
    if count_invalid:
        found = invalid_lines(spark, path, pattern).drop("lines").withColumnRenamed("replaced", "replaced_characters")
        counted = counted.join(found, "path", "left")
        invalid = ["invalid_lines", "replaced_characters", "first_invalid_line"]
    return counted.select(
        file_name(F.col("path")).alias("file_name"),
        "file_size",
        F.col("row_parsed").alias("row_count"),
        "row_parsed",
        "error_count",
        "null_ids",
        "first_error",
        "first_error_record",
        column.alias("first_error_column"),
        F.when(F.col("error_count") == 0, "LOADED").otherwise("LOADED_WITH_ERRORS").alias("status"),
        run_stamp(run_ts).alias("last_load_time"),
        *invalid,
    )


def recent_loads(history: DataFrame, now: dt.datetime | str, hours: int = 1) -> DataFrame:
    """The load reports of the last ``hours``, newest first."""
    since = F.lit(now).cast("timestamp") - F.make_dt_interval(hours=F.lit(hours))
    return history.where(F.col("last_load_time") >= since).orderBy(F.desc("last_load_time"), "file_name")


def read_positional(
    spark: SparkSession,
    path: str,
    n_cols: int,
    *,
    max_rows: int | None = None,
    names: list[str] | None = None,
    multi_line: bool = True,
) -> DataFrame:
    """A delimited file by position: c1..cn, file name and time, and the row's
    number in its file. Without ``multi_line`` large files are split, and rows are
    numbered by their block's offset. With ``max_rows`` only the first rows of each
    file are kept, each task cuts its own before the shuffle, and nothing is counted."""
    columns = names or [f"c{i}" for i in range(1, n_cols + 1)]
    rows = (
        spark.read.schema(string_schema(columns))
        .options(**CSV_OPTS)
        .option("header", False)
        .option("multiLine", multi_line)
        # The same rows are found whatever columns are read.
        .option("columnPruning", False)
        .option("recursiveFileLookup", True)
        .csv(path)
        .select(*columns, F.col("_metadata.file_modification_time").alias("last_modified"), *place_columns())
    )
    if max_rows is None:
        numbered = number_rows(rows)
    else:
        order = Window.partitionBy("path").orderBy("block", "position")
        numbered = rows.withColumn("row_number", F.row_number().over(order)).where(F.col("row_number") <= max_rows)
    return null_tokens(numbered, columns).select(
        *columns, file_name(F.col("path")).alias("file_name"), "path", "last_modified", "row_number"
    )


def header_mismatches(spark: SparkSession, path: str, expected: list[str] = MAPPING_COLS) -> DataFrame:
    """The files whose first row is not exactly ``expected``, case included."""
    first = read_positional(spark, path, len(expected) + 1, max_rows=1)
    found = F.array(*[F.coalesce(F.col(f"c{i}"), F.lit("")) for i in range(1, len(expected) + 2)])
    wanted = F.array(*[F.lit(name) for name in [*expected, ""]])
    names = [F.col(f"c{i}") for i in range(1, len(expected) + 2)]
    return first.where(found != wanted).select("file_name", F.concat_ws(",", *names).alias("found"))
