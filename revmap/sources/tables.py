"""Parquet tables: truncate and reload, create if absent, rebuild in place.

A table is a folder of versions. ``data`` holds a folder for each version that was
written, ``versions`` one row for each that was published: a single small file that
Spark's commit puts there in one step. Readers take the last version published, so
they see all of a load or nothing of it, and a load that fails leaves the rows that
were there. Nothing is overwritten; what is out of use is listed for removal."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revmap.schemas import MAPPING

_VERSIONS = "version bigint, folder string, columns string, published timestamp"


@dataclass(frozen=True)
class Version:
    """Rows that are written for a table but not published yet."""

    path: str
    folder: str
    rows: DataFrame

    def publish(self) -> DataFrame:
        """Make this the version that readers get. Of versions published at the same
        time the one with the larger folder name counts, for every reader."""
        spark = self.rows.sparkSession
        last = _published(spark, self.path).agg(F.max("version")).scalar()
        number = F.coalesce(last, F.lit(0).cast("bigint")) + 1
        columns = json.dumps(self.rows.schema.jsonValue())
        entry = spark.range(1).select(
            number.alias("version"), F.lit(self.folder).alias("folder"), F.lit(columns).alias("columns"), F.current_timestamp().alias("published")
        )
        entry.coalesce(1).write.mode("append").parquet(f"{self.path}/versions")
        return self.rows


def store_rows(df: DataFrame, path: str) -> DataFrame:
    """Write rows to a path of scratch space and read them back: they are worked out
    once, and their size is known."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear(spark: SparkSession, path: str) -> None:
    """Give up what a folder of scratch space holds: an empty table replaces it."""
    spark.createDataFrame([], "cleared int").write.mode("overwrite").parquet(path)


def write_version(df: DataFrame, path: str, *, partition_by: str | None = None) -> Version:
    """Write the rows of a new version beside those there are. Partition revenue by
    ``data_month``, so that a month filter reads one folder. Rows are rebalanced on it
    first: few files per month, and a month far larger than the others is split over
    tasks."""
    path, folder = path.rstrip("/"), uuid.uuid4().hex
    out = f"{path}/data/{folder}"
    if partition_by is None:
        df.write.parquet(out)
    else:
        df.hint("rebalance", partition_by).write.partitionBy(partition_by).parquet(out)
    return Version(path, folder, df.sparkSession.read.schema(df.schema).parquet(out))


def reload_table(df: DataFrame, path: str, *, partition_by: str | None = None) -> DataFrame:
    """Replace the rows of the table at ``path`` in one step, and read them back.
    ``df`` may read the table itself."""
    return write_version(df, path, partition_by=partition_by).publish()


def _published(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(_VERSIONS).parquet(f"{path.rstrip('/')}/versions")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _VERSIONS)


def versions(spark: SparkSession, path: str) -> DataFrame:
    """Every version published, the current one marked."""
    found = _published(spark, path).drop("columns")
    last = found.agg(F.max(F.struct("version", "folder"))).scalar()
    return found.withColumn("current", F.struct("version", "folder") == last)


def _current(spark: SparkSession, path: str):
    return _published(spark, path).agg(F.max(F.struct("version", "folder", "columns")).alias("last")).first().last


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The rows last published. A frame keeps the version it was made for."""
    last = _current(spark, path)
    if last is None:
        raise FileNotFoundError(f"no table at {path}")
    schema = T.StructType.fromJson(json.loads(last["columns"]))
    return spark.read.schema(schema).parquet(f"{path.rstrip('/')}/data/{last.folder}")


def superseded(spark: SparkSession, path: str) -> DataFrame:
    """Folders that no new reader is given: former versions, and those never published
    because a load failed or is not done. Remove them once their readers are through."""
    from revmap.sources.files import list_files

    root = f"{path.rstrip('/')}/data"
    folder = F.regexp_extract("path", r"/data/([0-9a-f]{32})/", 1)
    there = list_files(spark, root).groupBy(folder.alias("folder")).agg(F.sum("length").alias("bytes"))
    known = versions(spark, path).select("folder", "version", "current")
    found = there.join(known, "folder", "left").where("NOT coalesce(current, false)")
    return found.select(F.concat(F.lit(f"{root}/"), "folder").alias("path"), "version", "bytes")


def create_if_absent(spark: SparkSession, path: str, schema: T.StructType = MAPPING) -> DataFrame:
    """An empty table at ``path`` unless there is one."""
    if _current(spark, path) is None:
        return reload_table(spark.createDataFrame([], schema), path)
    return read_table(spark, path)


def rebuild_table(spark: SparkSession, path: str, query: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Replace a table by a query over itself: the query reads one version while it
    writes the next, so there is no copy between."""
    return reload_table(query(read_table(spark, path)), path)


def save_as_table(df: DataFrame, name: str) -> DataFrame:
    """Replace a catalog table."""
    df.write.mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name)


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Make a query available to SQL under ``name``; nothing is computed."""
    df.createOrReplaceTempView(name)
    return df


def append_rows(df: DataFrame, path: str) -> DataFrame:
    """Add rows, such as a load report or an export receipt, to a table."""
    df.write.mode("append").parquet(path)
    return df.sparkSession.read.parquet(path)


def column_list(df: DataFrame, upper: bool = False) -> str:
    """The column names of a relation in order, as one text."""
    names = ",".join(df.columns)
    return names.upper() if upper else names
