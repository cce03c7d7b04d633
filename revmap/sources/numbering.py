"""Row numbers in files that many tasks read.

No task knows the rows before its own block of a file. So rows are counted by block
first; the counts of a file's blocks, added up in their order, then say how many rows
come before each, and a row's number is that plus its place in its block. What is
sorted or summed in one place is one row a block, never the rows of a file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revmap.session import scratch_dir
from revmap.sources.tables import store_rows


def place_columns() -> list[Column]:
    """The columns that the functions here go by, to select where files are read:
    file, block of it, and a number that rises by one from row to row of a block."""
    return [
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("position"),
    ]


def count_blocks(rows: DataFrame, *more: Column) -> DataFrame:
    """One row a block: ``rows_in``, the ``first`` position, and what ``more`` aggregates."""
    return rows.groupBy("path", "block").agg(F.count("*").alias("rows_in"), F.min("position").alias("first"), *more)


def add_offsets(blocks: DataFrame) -> DataFrame:
    """Add ``rows_before``: the rows of the file before each block."""
    order = Window.partitionBy("path").orderBy("block")
    return blocks.withColumn("rows_before", F.sum("rows_in").over(order) - F.col("rows_in"))


def number_rows(rows: DataFrame, name: str = "row_number") -> DataFrame:
    """Add each row's number in its file, from 1, to rows with ``place_columns``.

    The files are read twice, once to count. The offsets are stored as a table of known
    size, so that Spark sends them to the tasks as long as they are few and shuffles
    both sides beyond that. Files that change between the two readings are an error."""
    offsets = add_offsets(count_blocks(rows)).select("path", "block", "rows_in", "first", "rows_before")
    offsets = store_rows(offsets, scratch_dir(rows.sparkSession, "offsets"))
    place = F.col("position") - F.col("first")
    known = F.col("rows_in").isNotNull() & (place >= 0) & (place < F.col("rows_in"))
    number = F.when(known, F.col("rows_before") + place + 1).otherwise(
        F.raise_error(F.concat(F.lit("changed while it was read: "), F.col("path"))).cast("bigint")
    )
    numbered = rows.join(offsets, ["path", "block"], "left").withColumn(name, number)
    return numbered.select(*rows.columns, name)
