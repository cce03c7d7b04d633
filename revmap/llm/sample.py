"""The bounded sample of labelled documents that a classifier is fitted on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """Rows kept from training: crc32 of the id as text leaves this remainder."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % modulus == remainder, F.lit(False))


def clean_labels(labels: DataFrame, label: str, excluded: Column) -> DataFrame:
    """(key, label) to learn from: without null ids, labels other than 0 and 1, ids
    with contradicting labels, and rows for which ``excluded`` holds."""
    return (
        labels.select(F.col("doc_id").alias("key"), F.col(label).cast("int").alias("label"))
        .where(F.col("label").isin(0, 1) & F.col("key").isNotNull())
        .groupBy("key")
        .agg(F.min("label").alias("label"), F.max("label").alias("other"))
        .where("label = other")
        .drop("other")
        .where(~excluded)
    )


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, excluded: Column, rows: int, balance: bool = False) -> DataFrame:
    """(key, label, text) of about ``rows`` labelled documents, not over twice as many.

    All labelled documents are taken if they are fewer; else those with the least
    hashes of their ids, so the choice does not depend on the partitions. With
    ``balance`` each label gets half of the rows if it has them. Ids that are null,
    labels other than 0 and 1, and ids with contradicting labels are left out.
    The chosen labels are at most ``2 * rows`` small rows and are broadcast.
    """
    clean = clean_labels(labels, label, excluded)
    counts = {r["label"]: r["count"] for r in clean.groupBy("label").count().collect()}
    draw = F.pmod(F.xxhash64("key"), F.lit(1_000_003)) / 1_000_003.0
    total = sum(counts.values())
    share = F.lit(1.0)
    for value, n in counts.items():
        wanted = rows / 2 if balance else rows * n / total
        share = F.when(F.col("label") == value, F.lit(wanted / n)).otherwise(share)
    chosen = clean.where(draw < share)
    text = docs.select(F.col("doc_id").alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    return text.join(F.broadcast(chosen), "key").select("key", "label", "text")
