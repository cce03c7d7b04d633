"""Files of a folder as a relation: path, time and size, without their content."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revmap.functions.dates import as_date
from revmap.sources.numbering import number_rows, place_columns

FILE_SCHEMA = "path string, modificationTime timestamp, length bigint"


def name_matches(name: Column, pattern: str) -> Column:
    """Whether the whole file name matches a regular expression."""
    return name.rlike(f"^(?:{pattern})$")


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def folder_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -2)


def list_files(spark: SparkSession, root: str, glob: str | None = None, pattern: str | None = None) -> DataFrame:
    """Every file below ``root``, by glob or by regular expression on its name.
    A folder that does not exist holds no files."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    try:
        files = reader.load(root).select("path", "modificationTime", "length")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], FILE_SCHEMA)
    return files if pattern is None else files.where(name_matches(file_name(F.col("path")), pattern))


def latest_file(files: DataFrame) -> str | None:
    """Path of the newest file; of equally new ones the last by path. One row
    comes to the driver."""
    newest = files.agg(F.max(F.struct("modificationTime", "path")).alias("newest")).first().newest
    return None if newest is None else newest.path


def file_details(files: DataFrame) -> DataFrame:
    """Files by name, newest first."""
    return files.select(
        file_name(F.col("path")).alias("file_name"),
        folder_name(F.col("path")).alias("export_name"),
        F.col("length").alias("file_size"),
        F.col("modificationTime").alias("last_modified"),
        "path",
    ).orderBy(F.desc("last_modified"), "path")


def expired(files: DataFrame, as_of: str | dt.date, days: int = 90) -> DataFrame:
    """Files last changed more than ``days`` days before ``as_of``. They are
    only listed; deleting them is left to the caller."""
    return files.where(F.col("modificationTime") < F.date_sub(as_date(as_of), days).cast("timestamp"))


def content_keys(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """A content key per text file, from its lines and their order; files without a
    line have none. Each line is hashed with its number where it is read, and the
    hashes are summed in each task, so a file of any size can be split and its key
    does not depend on how. The files are read twice, once to number the lines."""
    reader = spark.read.option("recursiveFileLookup", True)
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    numbered = number_rows(reader.text(root).select("value", *place_columns()), "line")
    line = F.xxhash64("line", "value")
    return (
        numbered.groupBy("path")
        .agg(
            F.count("*").alias("lines"),
            F.sum(line.cast("decimal(20,0)")).alias("total"),
            F.bit_xor(line).alias("xor"),
        )
        .select("path", "lines", F.md5(F.concat_ws("/", "lines", "total", "xor")).alias("content_key"))
    )
