"""Bytes that are no UTF-8 in values and in files: found, counted, replaced.

A reader of delimited files turns such bytes into U+FFFD without a word, and so does
the writer. Here they are counted first, from the bytes as they are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revmap.sources.files import name_matches
from revmap.sources.numbering import add_offsets, count_blocks, place_columns

# Fixed value: the character that stands for bytes that are no UTF-8.
REPLACEMENT = "�"


def _replacements(text: Column) -> Column:
    return (F.octet_length(text) - F.octet_length(F.replace(text, F.lit(REPLACEMENT), F.lit("")))) / 3


def invalid_count(text: Column) -> Column:
    """How many characters are put in when a text is made valid; those that it holds
    already do not count. NULL has none."""
    found = _replacements(F.make_valid_utf8(text)) - _replacements(text)
    return F.when(F.is_valid_utf8(text), 0).otherwise(F.coalesce(found, F.lit(0))).cast("bigint")


def made_valid(df: DataFrame) -> DataFrame:
    """Every text column with U+FFFD for bytes that are no UTF-8."""
    return df.select(*[F.make_valid_utf8(F.col(f"`{c}`")).alias(c) if t == "string" else F.col(f"`{c}`") for c, t in df.dtypes])


def invalid_total(df: DataFrame) -> Column:
    """The characters that ``made_valid`` puts into a row."""
    texts = [invalid_count(F.col(f"`{c}`")) for c, t in df.dtypes if t == "string"]
    return sum(texts, F.lit(0).cast("bigint"))


def invalid_lines(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """One row a file below ``path``: ``lines``, ``invalid_lines``, ``replaced`` (the
    characters a reader puts in) and ``first_invalid_line``, NULL if there is none.

    Files are read once, as lines, and may be split: the first line is counted in its
    block and moved on by the lines of the blocks before. Compressed files are read
    whole; files without a line have no row."""
    raw = spark.read.option("recursiveFileLookup", True).text(path)
    if pattern is not None:
        raw = raw.where(name_matches(F.col("_metadata.file_name"), pattern))
    rows = raw.select("value", *place_columns())
    bad = ~F.is_valid_utf8("value")
    blocks = count_blocks(
        rows,
        F.count_if(bad).alias("bad"),
        F.sum(invalid_count(F.col("value"))).alias("replaced"),
        F.min(F.when(bad, F.col("position"))).alias("first_bad"),
    )
    line = F.col("rows_before") + F.col("first_bad") - F.col("first") + 1
    return (
        add_offsets(blocks)
        .groupBy("path")
        .agg(
            F.sum("rows_in").alias("lines"),
            F.sum("bad").alias("invalid_lines"),
            F.sum("replaced").alias("replaced"),
            F.min(line).alias("first_invalid_line"),
        )
    )
