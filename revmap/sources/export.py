"""Writing the mapped view as delimited files.

An export is a folder ``<prefix>_<yyyymm>`` of part files whose names follow
the sort order; Spark writes them in parallel."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revmap import texts
from revmap.functions.columns import null_tokens
from revmap.functions.dates import prior_month_value, run_stamp, yyyymm
from revmap.operators.skew import ordered_by
from revmap.schemas import CSV_OPTS, EXPORT_HEADER, string_schema
from revmap.session import scratch_dir
from revmap.sources.files import folder_name, name_matches
from revmap.sources.tables import clear, store_rows
from revmap.sources.utf8 import invalid_total, made_valid

# Fixed value: the size cap of one exported file in bytes.
MAX_FILE_BYTES = 5368709120
# Smaller files are not made for the sake of more tasks.
MIN_FILE_BYTES = 128 << 20

_SIZE, _ROW, _FILE, _BAD = "_row_bytes", "_row_number", "_file_number", "_replaced"


def export_csv(
    df: DataFrame,
    root: str,
    prefix: str,
    *,
    order_by: str | None = "ID",
    month_col: str = "data_month",
    as_of: str | dt.date | None = None,
    months_back: int = 1,
    header: bool = True,
    as_string: bool = True,
    single: bool = False,
    compression: str | None = None,
    max_bytes: int = MAX_FILE_BYTES,
    max_records: int | None = None,
    null_value: str = "",
    overwrite: bool = True,
    source: str = "",
    run_ts: dt.datetime | str | None = None,
    store: bool = True,
    invalid: str | None = None,
) -> DataFrame:
    """Write ``df`` and return a one-row receipt.

    The folder is named by the latest month in the data, or with ``as_of`` by
    the month ``months_back`` before it. With ``as_string`` values are written
    as text under upper-case names.

    Without ``max_records`` files are cut at bytes: none exceeds ``max_bytes``
    unless a single row does, and there are about twice as many as that needs at
    most, or one for each core if they would then have MIN_FILE_BYTES. Sizes are
    those of the text, before compression. With ``max_records`` each file holds so
    many rows and bytes are not looked at. ``single`` writes one file through one
    task, and is refused for more than ``max_bytes``.

    Bytes that are no UTF-8 become U+FFFD. With ``invalid="replace"`` the receipt says
    how many, as ``replaced_characters``; ``"error"`` refuses to export them.

    The rows are read to measure them, to find where files begin, and to write, so
    ``df`` is stored first, worked out once, and the copy is cleared afterwards.
    Pass ``store=False`` for a frame that only reads a table."""
    if invalid not in (None, "replace", "error"):
        raise ValueError(f"invalid must be replace or error, not {invalid}")
    columns, spark = df.columns, df.sparkSession
    bad = []
    if invalid is not None:
        bad = [invalid_total(df).alias(_BAD)]
        df = made_valid(df.select("*", *bad))
    size_of = _row_bytes(df.select(*columns), null_value)
    df, copy = df.select("*", size_of.alias(_SIZE), F.monotonically_increasing_id().alias(_ROW)), None
    if store:
        copy = scratch_dir(spark, "export")
        df = store_rows(df, copy)
    month = None if as_of is None else prior_month_value(as_of, months_back).strftime("%Y%m")
    size, rows, replaced = 0, 0, 0
    if month is None or max_records is None or single or bad:
        found = _measure(df, month_col if month is None else None)
        month, size, rows, replaced = month or found.month, found.bytes or 0, found.n, found.replaced
    if replaced and invalid == "error":
        raise ValueError(f"{replaced} characters are no UTF-8: export with invalid='replace'")
    if month is None:
        raise ValueError(f"no {month_col} in the data to name the export by; pass as_of")
    path = f"{root.rstrip('/')}/{prefix}_{month}"
    room = max(1, max_bytes - (sum(len(c.encode()) + 3 for c in columns) + 1 if header else 0))
    if single:
        if size > room or rows > (max_records or rows):
            raise ValueError(f"{rows} rows of {size} bytes are too many for one file: export with single=False")
        out = df.repartition(1)
        if order_by is not None:
            out = out.sortWithinPartitions(F.asc_nulls_last(order_by))
    elif max_records is None:
        # No file of less than MIN_FILE_BYTES for the sake of more tasks.
        even = max(MIN_FILE_BYTES, -(-size // spark.sparkContext.defaultParallelism))
        out = _cut_at_bytes(df, order_by, min(room, even), size)
    elif order_by is not None:
        out = ordered_by(df.drop(_SIZE, _ROW), F.asc_nulls_last(order_by))
    else:
        out = df
    out = out.select(*[F.col(c).cast("string").alias(c.upper()) if as_string else F.col(c) for c in columns])
    (
        out.write.mode("overwrite" if overwrite else "errorifexists")
        .options(**CSV_OPTS)
        .option("header", header)
        .option("nullValue", null_value)
        .option("emptyValue", "")
        .option("compression", compression or "none")
        .option("maxRecordsPerFile", 0 if single or max_records is None else max_records)
        .csv(path)
    )
    if copy is not None:
        clear(spark, copy)
    counted = [F.lit(replaced).cast("bigint").alias("replaced_characters")] if bad else []
    return spark.range(1).select(
        F.lit(texts.EXPORT_COMPLETED).alias("status"),
        F.lit(f"{prefix}_{month}").alias("exported_file"),
        F.lit(source).alias("source_table"),
        F.lit(month).alias("data_month"),
        run_stamp(run_ts).alias("export_timestamp"),
        F.lit(path).alias("path"),
        *counted,
    )


def _row_bytes(df: DataFrame, null_value: str) -> Column:
    """A row's bytes as a line of the file, at most: values as valid UTF-8 with their
    quotes doubled, two quotes and a separator each, and the line's end. The writer's
    timestamps are longer than those of a cast."""
    total = F.lit(1).cast("bigint")
    for field in df.schema:
        text = F.make_valid_utf8(F.col(f"`{field.name}`").cast("string"))
        value = 2 * F.octet_length(text) - F.octet_length(F.replace(text, F.lit('"'), F.lit("")))
        more = 12 if "timestamp" in field.dataType.simpleString() else 0
        total = total + F.coalesce(value, F.lit(len(null_value.encode()))) + F.lit(3 + more)
    return total


def _measure(df: DataFrame, month_col: str | None) -> Row:
    """The latest month, the number of rows and their bytes as text, in one pass."""
    month = F.lit(None).cast("string") if month_col is None else yyyymm(F.max(month_col))
    replaced = F.coalesce(F.sum(_BAD), F.lit(0)) if _BAD in df.columns else F.lit(0)
    return df.agg(month.alias("month"), F.count("*").alias("n"), F.sum(_SIZE).alias("bytes"), replaced.alias("replaced")).first()


def _cut_at_bytes(df: DataFrame, order_by: str | None, cap: int, size: int) -> DataFrame:
    """``df``, of ``size`` bytes, in one partition a file of at most ``cap`` bytes, in order.

    Sizes and sort keys alone are sorted by range; running sums of bytes cut each range
    into chunks of a quarter of ``cap`` at most. One row a chunk comes to the driver,
    which joins neighbours to files. The rows then go straight to the partition of their
    file, found by its first row, and are sorted there."""
    spark = df.sparkSession
    key, kind = _sort_key(df, order_by)
    if size <= cap:
        return df.repartition(1).sortWithinPartitions(key.isNull(), key, _ROW)
    narrow = df.select(key.alias("key"), key.isNull().alias("none"), F.col(_ROW).alias("row"), F.col(_SIZE).alias("size"))
    order = [F.col("none"), F.col("key"), F.col("row")]
    chunks = narrow.orderBy(*order).mapInArrow(
        _chunks(max(1, cap // 4)), f"task int, chunk bigint, key {kind}, none boolean, row bigint, size bigint"
    )
    starts, filled = [], None
    for c in sorted(chunks.collect(), key=lambda c: (c.task, c.chunk)):
        if filled is None or filled + c.size > cap:
            starts.append((c.none, c.key, c.row))
            filled = 0
        filled += c.size
    if len(starts) < 2:
        out = df.repartition(1)
    else:
        blank = F.lit("") if kind == "string" else F.lit(0)
        file = F.pandas_udf(_file_finder(starts[1:]), "int")
        number = file(key.isNull(), F.coalesce(key, blank.cast(kind)), F.col(_ROW))
        out = df.withColumn(_FILE, number).repartitionById(len(starts), F.col(_FILE))
    return out.sortWithinPartitions(key.isNull(), key, _ROW)


def _sort_key(df: DataFrame, order_by: str | None) -> tuple[Column, str]:
    """The sort key in a type that sorts alike in Spark and in numpy."""
    if order_by is None:
        return F.lit(None).cast("bigint"), "bigint"
    kind, key = df.select(order_by).schema[0].dataType, F.col(order_by)
    if isinstance(kind, T.DateType):
        return F.unix_date(key).cast("bigint"), "bigint"
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(key), "bigint"
    if isinstance(kind, T.IntegralType | T.BooleanType):
        return key.cast("bigint"), "bigint"
    if isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType):
        return key.cast("double"), "double"
    if isinstance(kind, T.DecimalType):
        return key, kind.simpleString()
    return key.cast("string"), "string"


def _chunks(limit: int):
    """Cut sorted rows at running sums of bytes; a row beyond the limit is a chunk by itself."""

    def run(batches):
        task, n, size, head = TaskContext.get().partitionId(), 0, 0, None
        for batch in batches:
            sums = np.cumsum(batch.column("size").to_numpy())
            at, done = 0, 0
            found = []
            while at < len(sums):
                # The rows from ``at`` on that still fit the open chunk.
                end = int(np.searchsorted(sums, done + limit - size, "right"))
                if end > at or head is None:
                    if head is None:
                        head = batch.slice(at, 1)
                        end = max(end, at + 1)
                    size += int(sums[end - 1]) - done
                    at, done = end, int(sums[end - 1])
                if at < len(sums):
                    found.append(_chunk_row(task, n, head, size))
                    n, size, head = n + 1, 0, None
            if found:
                yield pa.Table.from_batches(found).combine_chunks().to_batches()[0]
        if head is not None:
            yield _chunk_row(task, n, head, size)

    return run


def _chunk_row(task: int, n: int, head: pa.RecordBatch, size: int) -> pa.RecordBatch:
    columns = [pa.array([task], pa.int32()), pa.array([n], pa.int64()), *(head.column(c) for c in ("key", "none", "row"))]
    return pa.RecordBatch.from_arrays([*columns, pa.array([size], pa.int64())], ["task", "chunk", "key", "none", "row", "size"])


def _file_finder(starts: list[tuple]):
    """The number of files that start at a row or before it, the first file left out.
    ``starts`` holds (no key, key, row) in order, and rows without a key come last."""
    known = [s for s in starts if not s[0]]
    firsts = np.array([s[2] for s in known], np.int64)
    last = np.array([s[2] for s in starts if s[0]], np.int64)
    kinds = {type(s[1]) for s in known}
    keys = np.empty(len(known), np.int64 if kinds == {int} else np.float64 if kinds == {float} else object)
    keys[:] = [s[1] for s in known]

    def find(none: pd.Series, key: pd.Series, row: pd.Series) -> pd.Series:
        none, key, row = none.to_numpy(), key.to_numpy(), row.to_numpy()
        low, high = np.searchsorted(keys, key, "left"), np.searchsorted(keys, key, "right")
        file = low.copy()
        # Files that start within one key are told apart by the row.
        within = (low < high) & ~none
        for first in np.unique(low[within]):
            some = within & (low == first)
            file[some] = first + np.searchsorted(firsts[first : high[some][0]], row[some], "right")
        file[none] = len(keys) + np.searchsorted(last, row[none], "right")
        return pd.Series(file.astype(np.int32))

    return find


def export_record(df: DataFrame, root: str, record_id: str, **kw) -> DataFrame:
    """Export the rows of one ID alone, to see whether they survive."""
    return export_csv(df.where(F.col("ID") == record_id), root, "single_record", **kw)


def read_export(
    spark: SparkSession,
    path: str,
    names: list[str] | None = None,
    *,
    header: bool = True,
    multi_line: bool = True,
    export_name: str | None = None,
) -> DataFrame:
    """An export by column name, or with ``header=False`` by position: strings with
    null tokens turned to NULL, and the export folder and file each row came from.
    ``path`` is an export or a folder of exports at any depth; ``export_name``, a
    regular expression, then picks those of that name. Without ``multi_line`` large
    files are split."""
    names = names or EXPORT_HEADER
    rows = (
        spark.read.schema(string_schema(names))
        .options(**CSV_OPTS)
        .option("header", header)
        .option("multiLine", multi_line)
        .option("enforceSchema", not header)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.csv*")
        .csv(path)
    )
    if export_name is not None:
        # Spark evaluates this on the file listing: other files are not opened.
        rows = rows.where(name_matches(folder_name(F.col("_metadata.file_path")), export_name))
    parts = F.split(F.col("_metadata.file_path"), "/")
    return null_tokens(
        rows.select(*names, F.element_at(parts, -2).alias("export_name"), F.element_at(parts, -1).alias("file_name")),
        names,
    )


def sample_export(spark: SparkSession, path: str, n: int = 10, **kw) -> DataFrame:
    """Some ``n`` rows of the exports in ``path``, picked like :func:`read_export` does."""
    return read_export(spark, path, **kw).limit(n)


def add_header(
    spark: SparkSession,
    src: str,
    dst: str,
    header_row: str | None = None,
    *,
    order_by: str | None = None,
    multi_line: bool = True,
) -> DataFrame:
    """Write a copy of a header-less export with a header. The header defaults
    to the export's; a file with another number of columns is an error."""
    names = header_row.split(",") if header_row is not None else EXPORT_HEADER
    rows = (
        spark.read.schema(string_schema(names))
        .options(**CSV_OPTS)
        .option("header", False)
        .option("multiLine", multi_line)
        .option("mode", "FAILFAST")
        .csv(src)
    )
    if order_by is not None:
        rows = ordered_by(rows, F.asc_nulls_last(order_by))
    rows.write.mode("overwrite").options(**CSV_OPTS).option("header", True).option("emptyValue", "").csv(dst)
    return spark.range(1).select(
        F.lit("HEADERS ADDED").alias("status"), F.lit(src).alias("source_file"), F.lit(dst).alias("target_file")
    )
