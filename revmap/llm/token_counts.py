"""Token counts for every context limit, from an exact histogram of encoded lengths.

Documents are encoded and aggregated by length, one row for each length that
occurs. Suffix sums over the histogram then answer what any limit would do: how
many documents reach it, how many tokens remain when longer ones are cut there,
and which limit holds a given share of the documents whole.

The sums are built in two steps, over ranges of lengths and within a range, so no
task has more than the lengths of one range.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from revmap.llm.byte_bpe import VOCABULARY, Tokenizer
from revmap.llm.store import documents, stored

#: Lengths in a range.
RANGE = 1_024


def length_histogram(counted: DataFrame, *, count_col: str = "n_tokens") -> DataFrame:
    """(``n_tokens``, ``docs``, ``tokens``): one row for each length; null lengths are left out."""
    lengths = counted.select(F.col(count_col).cast("long").alias("n_tokens")).where("n_tokens IS NOT NULL")
    grouped = lengths.groupBy("n_tokens").agg(F.count("*").alias("docs"))
    return grouped.withColumn("tokens", F.col("docs") * F.col("n_tokens"))


def suffix_sums(histogram: DataFrame) -> DataFrame:
    """Add to each length, taken as a context limit: ``docs_at_least`` and
    ``tokens_at_least`` (documents of that length or more), ``docs_within`` (that
    fit whole), ``tokens_cut`` (all tokens if longer documents are cut there) and
    ``tokens_all``. An empty histogram stays empty."""
    ranged = histogram.withColumn("range", F.floor(F.col("n_tokens") / RANGE))
    sums = ranged.groupBy("range").agg(F.sum("docs").alias("range_docs"), F.sum("tokens").alias("range_tokens"))
    # One row for each RANGE lengths: the longest document bounds it, not their number.
    above = Window.orderBy(F.desc("range"))
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sums = sums.select(
        "range",
        (F.sum("range_docs").over(above) - F.col("range_docs")).alias("docs_above"),
        (F.sum("range_tokens").over(above) - F.col("range_tokens")).alias("tokens_above"),
        F.sum("range_docs").over(every).alias("docs_all"),
        F.sum("range_tokens").over(every).alias("tokens_all"),
    )
    inner = Window.partitionBy("range").orderBy(F.desc("n_tokens"))
    docs = F.sum("docs").over(inner) + F.col("docs_above")
    tokens = F.sum("tokens").over(inner) + F.col("tokens_above")
    return (
        ranged.join(sums, "range")
        .select("n_tokens", "docs", "tokens", docs.alias("docs_at_least"), tokens.alias("tokens_at_least"), "docs_all", "tokens_all")
        .select(
            "n_tokens",
            "docs",
            "tokens",
            "docs_at_least",
            "tokens_at_least",
            (F.col("docs_all") - F.col("docs_at_least") + F.col("docs")).alias("docs_within"),
            (F.col("tokens_all") - F.col("tokens_at_least") + F.col("n_tokens") * F.col("docs_at_least")).alias("tokens_cut"),
            "tokens_all",
        )
    )


def quantile_limit(sums: DataFrame, share: float) -> DataFrame:
    """One row: the least length that holds at least ``share`` of the documents whole
    (null without documents)."""
    total = F.col("docs_within") + F.col("docs_at_least") - F.col("docs")
    return sums.where(F.col("docs_within") >= F.ceil(total * share)).agg(F.min("n_tokens").alias("n_tokens"))


def cut_total(sums: DataFrame, limit: int) -> DataFrame:
    """One row: documents beyond ``limit`` and the tokens left if they are cut there;
    any limit, also a length that no document has (null without documents)."""
    # The next length above the limit has the sums of all that are cut.
    longer = F.col("n_tokens") > limit
    docs = F.coalesce(F.max(F.when(longer, F.col("docs_at_least"))), F.lit(0))
    tokens = F.coalesce(F.max(F.when(longer, F.col("tokens_at_least"))), F.lit(0))
    return sums.agg(docs.alias("docs_cut"), (F.max("tokens_all") - tokens + limit * docs).alias("tokens_cut"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each encoded length among all documents would do as a context limit."""
    tokenizer = Tokenizer(spark, public_tokenizers.path(VOCABULARY))
    counted = tokenizer.count(documents(spark, sf_dir).select("text"))
    return suffix_sums(stored(length_histogram(counted), "length-histogram"))


QUERIES = {"op7_token_counts": op7_token_counts}
ORACLE: dict[str, str] = {}
