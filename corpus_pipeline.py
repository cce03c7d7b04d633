"""The pipeline over documents, and all queries of the training-data operators.

Toxic documents go, one document of each group of near copies stays, passages that
repeat across documents are cut from all but the first, documents that hold
benchmark passages go, and the rest is encoded. The first and the last stage are
not SQL, so there is no SQL for the whole; it is tested against brute force.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revmap.llm import queries as llm
from revmap.llm.byte_bpe import VOCABULARY, Tokenizer
from revmap.llm.decontamination import contamination
from revmap.llm.minhash_dedup import near_duplicates
from revmap.llm.sample import held_out
from revmap.llm.store import documents, stored, table
from revmap.llm.substring_dedup import remove_repeats
from revmap.llm.toxicity import THRESHOLD, ToxicityModel


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold; the labels learnt from are those
    of ``op4_toxicity``. Null and empty texts are scored like any other."""
    labels = table(spark, sf_dir, "labels")
    model = ToxicityModel.fit(docs, labels, held_out(F.col("key"), 4, 2))
    return model.score(docs, score_col="_score").where(F.col("_score") < THRESHOLD).select(*docs.columns)


def minhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies. Of rows that
    repeat an id the least stays; rows without an id all stay."""
    kept = near_duplicates(docs).where("kept AND doc_id IS NOT NULL").select("doc_id")
    rest = [c for c in docs.columns if c != "doc_id"]
    row = F.struct(*(F.col(c) for c in rest)).alias("row")
    one = docs.join(kept, "doc_id", "left_semi").groupBy("doc_id").agg(F.min(row).alias("row"))
    one = one.select("doc_id", *(F.col(f"row.{c}").alias(c) for c in rest))
    return one.select(*docs.columns).unionByName(docs.where("doc_id IS NULL"))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without later copies of 50-word passages; a document of
    nothing else stays with an empty text."""
    left = remove_repeats(docs).withColumn("n_chars", F.char_length("text").cast("long"))
    return left.select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark passages are less than a twentieth of the words."""
    found = contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.where("NOT contaminated").select(*docs.columns)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and whether they decode to its text; rows that
    repeat are each encoded, an empty table stays empty."""
    tokenizer = Tokenizer(spark, public_tokenizers.path(VOCABULARY))
    decoded = tokenizer.round_trip(docs, bytes_col="_decoded")
    same = F.col("_decoded") == F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    return decoded.select(*docs.columns, "ids", F.size("ids").cast("long").alias("n_tokens"), same.alias("round_trip"))


STAGES = [
    ("toxicity", toxicity),
    ("minhash_dedup", minhash_dedup),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("byte_bpe", byte_bpe),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again as the next one's input."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs


QUERIES = llm.QUERIES | {"pipeline": run}
ORACLE = llm.ORACLE | ({"pipeline": ORACLE_SQL} if ORACLE_SQL else {})
