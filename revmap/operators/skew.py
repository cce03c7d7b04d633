"""Joins and sorts that hold when one key carries a large share of the rows.

A lookup is a plain join without hints. While it runs, adaptive execution turns it
into a broadcast if a side has *measured* small, and splits the partitions of a key
that has measured large; building a plan starts no job.

Where a key is known to be hot, and is on a side that an outer join cannot split, it
can be named: its rows are spread over salts, and the other side's rows of that key
are repeated once per salt. :func:`hot_keys` counts them, in a stored table or one
that is cheap to read twice.

Salts depend on the row and on the partition it is read from, not on a random
number: a task that runs again after a lost executor sends every row to the
same place. Identical rows spread too, as they are read from many partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key is hot when it holds more than one row in HOT_SHARE, and more than
# HOT_ROWS rows, which one task can always take.
HOT_SHARE = 64
HOT_ROWS = 1_000_000


def salt_count(df: DataFrame) -> int:
    """Several salts per shuffle partition, so that their hashes even out."""
    return 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def spread(df: DataFrame, n: int) -> Column:
    """A repeatable number in [0, n) for each row of ``df``."""
    return F.pmod(F.xxhash64(F.spark_partition_id(), *[F.col(c) for c in df.columns]), F.lit(n)).cast("int")


def hot_keys(df: DataFrame, key: str) -> list:
    """The hot keys of ``df``, fewer than HOT_SHARE; None stands for NULL."""
    counts = df.groupBy(F.col(key).alias("hot_key")).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    hot = counts.where((F.col("n") > HOT_ROWS) & (F.col("n") * HOT_SHARE > total))
    return [row.hot_key for row in hot.collect()]


def lookup_join(
    big: DataFrame,
    side: DataFrame,
    big_key: str,
    side_key: str,
    how: str = "left",
    where: Column | None = None,
    *,
    hot: list | None = None,
    hot_side: list | None = None,
) -> DataFrame:
    """Join ``big`` to ``side`` on ``big_key = side_key`` (and ``where``, for a
    range condition). ``how`` is left, inner, left_semi or left_anti: the rows
    of ``big`` are never repeated except by their matches. The two frames must
    not share a column name.

    ``hot`` names keys of ``big`` to spread (None stands for NULL), and ``hot_side``
    keys that crowd ``side``, in an inner join or a left one without ``where``; the
    latter must occur in ``side``. The result is the same without them."""
    if how not in ("left", "inner", "left_semi", "left_anti"):
        raise ValueError(f"not a lookup join: {how}")
    condition = F.col(big_key) == F.col(side_key)
    if where is not None:
        condition = condition & where
    side = side.where(F.col(side_key).isNotNull())
    if how in ("left_semi", "left_anti") and where is None:
        side = side.select(side_key).distinct()
    hot = hot or []
    crowded = [k for k in hot_side or [] if k not in hot]
    if not crowded or not (how == "inner" or (how == "left" and where is None)):
        return _spread_join(big, side, big_key, side_key, hot, condition, how)
    # A crowded key has matches for certain, so its rows of big need no outer
    # join, and an inner join may spread the side.
    in_big = F.coalesce(F.col(big_key).isin(crowded), F.lit(False))
    in_side = F.col(side_key).isin(crowded)
    rest = _spread_join(big.where(~in_big), side.where(~in_side), big_key, side_key, hot, condition, how)
    matched = _spread_join(side.where(in_side), big.where(in_big), side_key, big_key, crowded, condition, "inner")
    return rest.unionByName(matched)


def _spread_join(
    big: DataFrame, side: DataFrame, big_key: str, side_key: str, hot: list, condition: Column, how: str
) -> DataFrame:
    """Join with the rows of the ``hot`` keys of ``big`` spread over salts."""
    if not hot:
        return big.join(side, condition, how)
    n = salt_count(big)
    keys = [k for k in hot if k is not None]
    is_hot = F.coalesce(F.col(big_key).isin(keys), F.lit(None in hot))
    salted = big.withColumn("big_salt", F.when(is_hot, spread(big, n)).otherwise(0))
    salts = F.when(F.col(side_key).isin(keys), F.sequence(F.lit(0), F.lit(n - 1))).otherwise(F.array(F.lit(0)))
    copies = side.withColumn("side_salt", F.explode(salts))
    joined = salted.join(copies, condition & (F.col("big_salt") == F.col("side_salt")), how)
    return joined.drop("big_salt", "side_salt")


def ordered_by(df: DataFrame, *order: Column) -> DataFrame:
    """Sort the whole frame. A tie-break that differs between equal keys lets
    the range partitioner cut a hot key into several partitions; the order of
    ``order`` is unchanged."""
    return (
        df.withColumn("tie_break", F.xxhash64(F.spark_partition_id(), *[F.col(c) for c in df.columns]))
        .orderBy(*order, F.col("tie_break"))
        .drop("tie_break")
    )
