"""Incremental ingest: load mapping files as they arrive.

What one call finds is one arrival. The stream may cut it into any number of
batches; these are staged, and the arrival passes its gate, is loaded and is later
told from others as a whole."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revmap.functions.columns import null_tokens
from revmap.operators.gates import GateError, gate_import
from revmap.schemas import CSV_OPTS, MAPPING, MAPPING_COLS
from revmap.sources.files import list_files
from revmap.sources.tables import clear

NO_NEW_FILES = "no new files"
_LEDGER = "arrival bigint, batch bigint, ok boolean, message string"


@dataclass(frozen=True)
class Arrival:
    """What became of the files of one call; ``number`` is None without new files."""

    ok: bool
    message: str
    number: int | None = None


def mapping_stream(
    spark: SparkSession, root: str, glob: str = "*.csv", max_files: int = 1000, multi_line: bool = True
) -> DataFrame:
    """New mapping files below ``root`` as a stream of rows, ``max_files`` to a
    batch. Turn ``multi_line`` off for large files without line breaks in quotes,
    which can then be split."""
    rows = (
        spark.readStream.schema(MAPPING)
        .options(**CSV_OPTS)
        .option("header", True)
        .option("multiLine", multi_line)
        .option("enforceSchema", False)
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", max_files)
        .csv(root)
    )
    return null_tokens(rows, MAPPING_COLS)


def ingest_new_files(
    spark: SparkSession,
    root: str,
    checkpoint: str,
    target: str,
    *,
    glob: str = "*.csv",
    strict: bool = False,
    max_files: int = 1000,
    multi_line: bool = True,
) -> Arrival:
    """Load what has arrived since the last call, and wait for it.

    An arrival that passes the import gate is written to a folder of its own in
    ``target``; one that fails goes to ``<target>-rejected`` and the next call goes
    on. ``<target>-arrivals`` lists the batches of each with the gate's message. The
    checkpoint remembers the files; a corrected file needs a new name.

    ``<target>-staged`` holds the batches that are not recorded yet, and is given up
    once they are: what a call reads does not grow with the calls before it. A call
    that breaks off is taken up by the next: batches are staged under their number and
    an arrival is named by its first batch, so what is repeated replaces itself, and
    an arrival that was recorded before its batches were given up is not loaded again.
    The files of one arrival, however small, are written together."""
    target, staged = target.rstrip("/"), f"{target.rstrip('/')}-staged"

    def stage(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{staged}/batch={batch_id}")

    (
        mapping_stream(spark, root, glob, max_files, multi_line)
        .writeStream.trigger(availableNow=True)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(stage)
        .start()
        .awaitTermination()
    )
    batches = _outstanding(spark, target)
    if not batches:
        return Arrival(True, NO_NEW_FILES)
    rows = spark.read.schema(MAPPING).parquet(*[f"{staged}/batch={b}" for b in batches])
    try:
        result = Arrival(True, gate_import(rows, strict=strict).message, batches[0])
    except GateError as error:
        result = Arrival(False, str(error), batches[0])
    folder = f"arrival={batches[0]}"
    rows.hint("rebalance").write.mode("overwrite").parquet(f"{target if result.ok else target + '-rejected'}/{folder}")
    done = spark.createDataFrame([(batches[0], b, result.ok, result.message) for b in batches], _LEDGER)
    done.drop("arrival").coalesce(1).write.mode("overwrite").parquet(f"{target}-arrivals/{folder}")
    clear(spark, staged)
    return result


def _staged_batches(spark: SparkSession, target: str) -> list[int]:
    number = F.regexp_extract("path", r"/batch=(\d+)/", 1).try_cast("bigint")
    there = list_files(spark, f"{target}-staged", glob="*.parquet").select(number.alias("batch")).where("batch IS NOT NULL").distinct()
    return sorted(row.batch for row in there.collect())


def _outstanding(spark: SparkSession, target: str) -> list[int]:
    """The staged batches that no arrival has recorded. Only a call that broke off just
    before it gave its batches up leaves others, and its arrival is named by the first."""
    batches = _staged_batches(spark, target)
    while batches:
        recorded = _or_empty(spark, f"{target}-arrivals/arrival={batches[0]}", "batch bigint")
        known = {row.batch for row in recorded.select("batch").collect()}
        if not known:
            return batches
        batches = [b for b in batches if b not in known]
    return []


def _or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def arrivals(spark: SparkSession, target: str) -> DataFrame:
    """The batches of all arrivals so far, whether they were loaded, and the gate's message."""
    return _or_empty(spark, f"{target.rstrip('/')}-arrivals", _LEDGER).select("arrival", "batch", "ok", "message")


def read_ingested(spark: SparkSession, target: str, *, latest_only: bool = False) -> DataFrame:
    """The rows loaded so far, or those of the latest arrival alone (truncate and
    reload). Before anything is loaded there are none."""
    rows = _or_empty(spark, target, ", ".join(f"{c} string" for c in [*MAPPING_COLS]) + ", arrival bigint")
    if latest_only:
        rows = rows.where(F.col("arrival") == rows.agg(F.max("arrival")).scalar())
    return rows.select(*MAPPING_COLS)
