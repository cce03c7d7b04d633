"""Tables and columns that several operators of this folder share."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revmap.session import scratch_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Python workers of a local session find this package wherever the session was started.
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).parents[2]))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared scratch folder and read it back: it is computed
    once, its lineage ends there, and no lost executor takes it away."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def tagged(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, tag, text: rows that repeat an id with another text differ in the tag."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    return docs.select(F.col(f"`{id_col}`").alias("id"), tag(text).alias("tag"), text.alias("text"))


def tag(text: Column) -> Column:
    return (F.crc32(F.encode(text, "UTF-8")) - F.lit(2**31)).cast("int")
