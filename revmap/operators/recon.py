"""Comparing two versions of the revenue relation within a tolerance."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revmap.functions.columns import all_of, sentinel, zero_if_null
from revmap.functions.dates import as_date
from revmap.schemas import KEYS, MEASURES
from revmap.session import scratch_dir
from revmap.sources.tables import store_rows

# What a missing key reads as, and the tolerance.
KEY_SENTINEL = "N/A"
DATE_SENTINEL = "2010-01-01"
TOLERANCE = 0.01


def _keys(keys: list[str], date_keys: list[str], text: str, date: str) -> list:
    return [sentinel(k, "date", date) if k in date_keys else sentinel(k, "string", text) for k in keys]


def paired(
    left: DataFrame,
    right: DataFrame,
    keys: list[str] = KEYS,
    measures: list[str] = MEASURES,
    *,
    names: tuple[str, str] = ("dev", "prod"),
    date_keys: list[str] | None = None,
    key_sentinel: str = KEY_SENTINEL,
    date_sentinel: str = DATE_SENTINEL,
    method: str = "aggregate",
) -> DataFrame:
    """Every key of either side with both sums of every measure and two
    presence flags.

    ``method="aggregate"`` tags both sides, stacks them and groups once: one
    shuffle, rows combined in each task before it, so a frequent key is never
    gathered. ``method="join"`` groups each side and joins in full; it gives
    the same rows and serves as a check."""
    a, b = names
    dates = ["data_month"] if date_keys is None else date_keys
    named = _keys(keys, dates, key_sentinel, date_sentinel)
    flags = [f"{a}_records_present", f"{b}_records_present"]
    if method == "aggregate":
        stacked = left.select(*named, *measures, F.lit(True).alias("in_left")).unionByName(
            right.select(*named, *measures, F.lit(False).alias("in_left"))
        )
        sides = [(a, "in_left"), (b, "NOT in_left")]
        present = [F.expr(f"bool_or({test}) AS {name}_records_present") for name, test in sides]
        sums = [
            F.expr(f"coalesce(sum(CASE WHEN {test} THEN `{x}` END), 0) AS `{name}_{x}`")
            for x in measures
            for name, test in sides
        ]
        grouped = stacked.groupBy(*keys).agg(*present, *sums)
        return grouped.select(*flags, *keys, *[f"{n}_{x}" for x in measures for n in names])
    if method == "join":

        def grouped_side(df: DataFrame, name: str) -> DataFrame:
            return (
                df.select(*named, *measures)
                .groupBy(*keys)
                .agg(F.lit(True).alias(f"{name}_records_present"), *[F.sum(x).alias(f"{name}_{x}") for x in measures])
            )

        joined = grouped_side(left, a).join(grouped_side(right, b), keys, "full")
        return joined.select(
            *[F.coalesce(F.col(f), F.lit(False)).alias(f) for f in flags],
            *keys,
            *[zero_if_null(F.col(f"{n}_{x}")).alias(f"{n}_{x}") for x in measures for n in names],
        )
    raise ValueError(f"method must be aggregate or join, not {method}")


def _differs(measures: list[str], names: tuple[str, str], tol: float) -> Column:
    a, b = names
    return F.expr(" OR ".join(f"abs(`{a}_{x}` - `{b}_{x}`) > {tol!r}D" for x in measures))


def diff(
    left: DataFrame,
    right: DataFrame,
    keys: list[str] = KEYS,
    measures: list[str] = MEASURES,
    *,
    tol: float = TOLERANCE,
    names: tuple[str, str] = ("dev", "prod"),
    order_by: str | None = "data_month",
    **kw,
) -> DataFrame:
    """Keys found on one side only, or where any measure differs by more than
    ``tol`` (a difference of exactly ``tol`` is not reported)."""
    a, b = names
    both = paired(left, right, keys, measures, names=names, **kw)
    one_sided = ~F.col(f"{a}_records_present") | ~F.col(f"{b}_records_present")
    found = both.where(one_sided | _differs(measures, names, tol))
    if order_by is None:
        return found
    return found.orderBy(order_by, *[k for k in keys if k != order_by])


def _apart(keys: list[str], date_keys: list[str], text: str, date: str) -> list:
    """The values of ``_keys`` by another expression. Spark notes that a row's block is the
    hash of these and, for each of them that a later projection names, keeps a note with
    and one without the name: with the expressions of ``_keys``, two to the power of their
    number, which is more than the driver holds."""
    kinds = [("date", date) if k in date_keys else ("string", text) for k in keys]
    given = [(F.col(k).cast(kind), F.lit(value).cast(kind)) for k, (kind, value) in zip(keys, kinds, strict=True)]
    return [F.when(key.isNull(), missing).otherwise(key) for key, missing in given]


def _blocked(df: DataFrame, keys: list[str], month: str, buckets: int, texts: tuple[str, str, list[str]]) -> DataFrame:
    """``df`` with its block: month, and a bucket of the keys as the comparison reads them."""
    key_sentinel, date_sentinel, dates = texts
    named = _apart(keys, dates, key_sentinel, date_sentinel)
    of_month = named[keys.index(month)] if month in keys else F.col(month)
    bucket = F.pmod(F.xxhash64(*named), F.lit(buckets))
    return df.withColumns({"block_month": of_month, "block_bucket": bucket})


def changed_blocks(
    left: DataFrame,
    right: DataFrame,
    keys: list[str] = KEYS,
    measures: list[str] = MEASURES,
    *,
    month: str = "data_month",
    buckets: int = 1024,
    names: tuple[str, str] = ("dev", "prod"),
    date_keys: list[str] | None = None,
    key_sentinel: str = KEY_SENTINEL,
    date_sentinel: str = DATE_SENTINEL,
) -> DataFrame:
    """The blocks, of a month and a bucket of keys, in which the rows of the two sides
    differ: ``block_month``, ``block_bucket`` and the rows of each side.

    A block's fingerprint is the number of its rows and two sums of row hashes, those of
    one side taken from those of the other; the order of rows plays no part. Rows are
    added up where they are read, so what is shuffled is one row a block and task.
    Equal rows give equal sums; different rows do but for a chance of 2^-128."""
    a, b = names
    dates = ["data_month"] if date_keys is None else date_keys
    named = _keys(keys, dates, key_sentinel, date_sentinel)
    # Hashed in the type that both sides share: the same number of another scale has another hash.
    shared = left.select(*measures).unionByName(right.select(*measures)).schema
    values = [*named, *[F.col(f.name).cast(f.dataType) for f in shared]]
    of_month = named[keys.index(month)] if month in keys else F.col(month)

    def side(df: DataFrame, sign: int) -> DataFrame:
        return df.select(
            of_month.alias("block_month"),
            F.pmod(F.xxhash64(*named), F.lit(buckets)).alias("block_bucket"),
            F.lit(sign).alias("sign"),
            F.xxhash64(*values).alias("h1"),
            F.xxhash64(F.lit(1), *values).alias("h2"),
        )

    hashed = side(left, 1).unionByName(side(right, -1))
    sums = hashed.groupBy("block_month", "block_bucket").agg(
        F.count_if(F.col("sign") > 0).alias(f"{a}_rows"),
        F.count_if(F.col("sign") < 0).alias(f"{b}_rows"),
        *[F.sum(F.col("sign") * F.col(h).cast("decimal(20,0)")).alias(h) for h in ("h1", "h2")],
    )
    return sums.where(f"h1 <> 0 OR h2 <> 0 OR {a}_rows <> {b}_rows").drop("h1", "h2")


def diff_blocks(
    left: DataFrame,
    right: DataFrame,
    keys: list[str] = KEYS,
    measures: list[str] = MEASURES,
    *,
    month: str = "data_month",
    buckets: int = 1024,
    tol: float = TOLERANCE,
    names: tuple[str, str] = ("dev", "prod"),
    order_by: str | None = "data_month",
    date_keys: list[str] | None = None,
    key_sentinel: str = KEY_SENTINEL,
    date_sentinel: str = DATE_SENTINEL,
) -> DataFrame:
    """What :func:`diff` finds, for versions that mostly agree: only the rows of
    :func:`changed_blocks` are grouped over all keys and summed.

    Both sides are read twice, so they should read tables. The blocks are found when
    this is called and stored, one short row each; Spark sends them to the tasks as
    long as they are few. If everything has changed, that is the cost of looking for
    what has not, and no more."""
    how = {"date_keys": date_keys, "key_sentinel": key_sentinel, "date_sentinel": date_sentinel}
    found = changed_blocks(left, right, keys, measures, month=month, buckets=buckets, names=names, **how)
    block = ["block_month", "block_bucket"]
    blocks = store_rows(found.select(*block), scratch_dir(left.sparkSession, "blocks"))
    dates = ["data_month"] if date_keys is None else date_keys

    def changed(df: DataFrame) -> DataFrame:
        mine = _blocked(df, keys, month, buckets, (key_sentinel, date_sentinel, dates))
        same = blocks.select(*[F.col(c).alias(f"changed_{c}") for c in block])
        # Null-safe, so that Spark infers no filter on the hash, which it would note like the hash.
        met = all_of([F.col(c).eqNullSafe(F.col(f"changed_{c}")) for c in block])
        return mine.join(same, met, "left_semi").select(*df.columns)

    return diff(changed(left), changed(right), keys, measures, tol=tol, names=names, order_by=order_by, **how)


def diff_counts(
    left: DataFrame,
    right: DataFrame,
    keys: list[str] = KEYS,
    measures: list[str] = MEASURES,
    *,
    tol: float = TOLERANCE,
    names: tuple[str, str] = ("dev", "prod"),
    **kw,
) -> DataFrame:
    """What :func:`diff` looked at, in one row: a comparison of nothing shows as
    zero keys and not as success."""
    a, b = names
    in_both = all_of([F.col(f"{a}_records_present"), F.col(f"{b}_records_present")])
    changed = _differs(measures, names, tol)
    return paired(left, right, keys, measures, names=names, **kw).agg(
        F.count("*").alias("keys_compared"),
        F.count_if(~F.col(f"{b}_records_present")).alias(f"{a}_only"),
        F.count_if(~F.col(f"{a}_records_present")).alias(f"{b}_only"),
        F.count_if(in_both & changed).alias("changed"),
        F.count_if(in_both & ~changed).alias("equal"),
    )


def date_range(
    df: DataFrame,
    lo: str | dt.date,
    hi: str | dt.date,
    *,
    column: str = "data_month",
    lo_inclusive: bool = True,
) -> DataFrame:
    """Rows from ``lo`` up to but not including ``hi``."""
    c = F.col(column)
    return df.where((c >= as_date(lo) if lo_inclusive else c > as_date(lo)) & (c < as_date(hi)))


def contract_rows(
    r: DataFrame,
    contract_id: str | int,
    lo: str | dt.date | None = None,
    hi: str | dt.date | None = None,
    *,
    month: str | dt.date | None = None,
    lo_inclusive: bool = True,
) -> DataFrame:
    """Revenue rows of one contract in a range of months or in one month."""
    rows = r.where(F.col("contract_id") == F.lit(str(contract_id)))
    if month is not None:
        return rows.where(F.col("data_month") == as_date(month))
    return date_range(rows, lo, hi, lo_inclusive=lo_inclusive)
