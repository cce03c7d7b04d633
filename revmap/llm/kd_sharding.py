"""Shards of near equal size by a k-d tree over document metadata.

A region of metadata space is cut at the weighted median of its widest dimension,
and each side again, until a leaf holds the target bytes. Medians are distributed:
each level takes one pass for the widths of all its regions and a few passes of
histograms, at most ``BUCKETS`` sums a region, in which the cut is narrowed down.
Only these sums and the cuts, as many as shards, reach the driver.

What is cut are points, the groups of equal texts, so equal texts share a shard. A
group larger than ``SLACK`` of a shard is dealt into parts by document id, as no
one shard could hold it beside its share.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from revmap.llm.store import documents, stored

SHARDS = 40
SLACK = 0.02
#: A cut may miss the exact median by this part of a shard.
MISS = 0.002
BUCKETS = 1 << 10
#: Rows that are numbered in one sort, about.
ROWS_A_CHUNK = 50_000
#: A coordinate takes 20 bits of a key; the rest orders points that share it.
_COORDINATE_BITS, _TIE_BITS = 20, 42


@dataclass
class Region:
    first: int
    shards: int
    dim: int = -1
    cut: int = 0
    low: Region | None = None
    high: Region | None = None

    def leaf(self, keys: list[Column], value) -> Column:
        """``value`` of the region that a point with these keys falls into."""
        if self.low is None or self.high is None:
            return value(self)
        return F.when(keys[self.dim] < self.cut, self.low.leaf(keys, value)).otherwise(self.high.leaf(keys, value))


def _grow(points: DataFrame, dims: int, root: Region, total: int) -> None:
    """Cut until each region is one shard. ``points`` has key0, key1, ... and weight."""
    keys = [F.col(f"key{d}") for d in range(dims)]
    spark = points.sparkSession
    level, target = [root], total / root.shards
    while level := [r for r in level if r.shards > 1]:
        region = root.leaf(keys, lambda r: F.lit(r.first))
        spans = points.select(region.alias("region"), "weight", *keys, F.array(*keys).alias("keys"))
        ends = {
            row.region: row
            for row in spans.groupBy("region")
            .agg(F.sum("weight").alias("weight"), *(f(k).alias(f"{f.__name__}{d}") for d, k in enumerate(keys) for f in (F.min, F.max)))
            .collect()
        }
        low, high, below, wanted = {}, {}, {}, {}
        for r in level:
            row = ends.get(r.first)
            if row is None:  # no points are left here: any cut will do
                r.dim, low[r.first], high[r.first], below[r.first], wanted[r.first] = 0, 0, 1, 0, 0
                continue
            width = [(row[f"max{d}"] >> _TIE_BITS) - (row[f"min{d}"] >> _TIE_BITS) for d in range(dims)]
            r.dim = int(np.argmax(width))
            low[r.first], high[r.first] = row[f"min{r.dim}"], row[f"max{r.dim}"] + 1
            below[r.first], wanted[r.first] = 0, row.weight * (r.shards // 2) / r.shards
        open_ = [r for r in level if r.first in ends]
        while open_:
            shift = {r.first: max(0, (high[r.first] - low[r.first] - 1).bit_length() - BUCKETS.bit_length() + 1) for r in open_}
            # At most as many rows as shards.
            wanted_rows = [(r.first, r.dim + 1, low[r.first], high[r.first], shift[r.first]) for r in open_]
            table = spark.createDataFrame(wanted_rows, "region int, dim int, low bigint, high bigint, shift int")
            rows = (
                spans.join(F.broadcast(table), "region")
                .selectExpr("region", "weight", "element_at(keys, dim) AS key", "low", "high", "shift")
                .where("key >= low AND key < high")
                .groupBy("region", F.expr("shiftright(key - low, shift)").alias("bucket"))
                .agg(F.sum("weight").alias("weight"))
                .collect()
            )
            still = []
            for r in open_:
                own = sorted((row.bucket, row.weight) for row in rows if row.region == r.first)
                reach = below[r.first] + np.cumsum([w for _, w in own])
                k = int(np.searchsorted(reach, wanted[r.first]))
                k = min(k, len(own) - 1)
                bucket_, weight = own[k]
                start = low[r.first] + (bucket_ << shift[r.first])
                below[r.first] = float(reach[k]) - weight
                if weight <= MISS * target or shift[r.first] == 0:
                    nearer = wanted[r.first] - below[r.first] > weight / 2
                    r.cut = start + (1 << shift[r.first]) if nearer else start
                else:
                    low[r.first], high[r.first] = start, min(high[r.first], start + (1 << shift[r.first]))
                    still.append(r)
            open_ = still
        for r in level:
            half = r.shards // 2
            r.low, r.high = Region(r.first, half), Region(r.first + half, r.shards - half)
        level = [side for r in level for side in (r.low, r.high)]


def kd_shards(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    dims: dict[str, Column] | None = None,
    shards: int | None = None,
    target_bytes: int | None = None,
) -> DataFrame:
    """Deal documents into shards of near equal bytes.

    A document's size is its UTF-8 bytes plus 16; a null text has none. ``dims`` are
    numeric columns of ``docs``, by default language, source, size (logarithm) and
    id; of equal texts the least value counts, and a null counts as the least of
    all. Either the number of shards or their target size is given. Returns one row
    for each row of ``docs``: id, ``size``, ``text_crc32``, ``shard`` (from 0) and
    ``slot`` (from 0, without gaps in each shard). Rows without an id, repeated rows
    and empty texts are dealt like others. No rows give no rows.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    if dims is None:
        code = lambda c: F.crc32(F.encode(F.col(c).cast("string"), "UTF-8")).cast("double")
        dims = {c: code(c) for c in ("lang", "source") if c in docs.columns}
        dims |= {"size": F.log2(F.octet_length(text) + 16.0), "id": F.xxhash64(f"`{id_col}`").cast("double")}
        if dict(docs.dtypes)[id_col] in ("bigint", "int", "smallint"):
            dims["id"] = F.col(f"`{id_col}`").cast("double")
    slim = stored(
        docs.select(
            F.col(f"`{id_col}`").alias("id"),
            (F.octet_length(text) + 16).cast("long").alias("size"),
            F.crc32(F.encode(text, "UTF-8")).alias("crc"),
            F.xxhash64(text).alias("group"),
            *(c.cast("double").alias(f"dim{k}") for k, c in enumerate(dims.values())),
        ),
        "shard-sizes",
    )
    names = [f"dim{k}" for k in range(len(dims))]
    whole = slim.agg(
        F.count("*").alias("rows"), F.sum("size").alias("bytes"), *(f(n).alias(f"{f.__name__}_{n}") for n in names for f in (F.min, F.max))
    ).first()
    if shards is None:
        shards = max(1, -(-(whole.bytes or 0) // (target_bytes or 1 << 30)))
    group = ["group", "size", "crc"]
    limit_bytes, limit_rows = (max(1.0, SLACK * x / shards) for x in (whole.bytes or 0, whole.rows))
    n_parts = F.ceil(F.greatest(F.sum("size") / limit_bytes, F.count("*") / limit_rows))
    # At most 2 * shards / SLACK groups have several parts.
    large = slim.groupBy(*group).agg(n_parts.alias("parts")).where("parts > 1")
    parted = slim.join(F.broadcast(large), group, "left").withColumn(
        "part", F.coalesce(F.pmod(F.xxhash64("id"), F.col("parts")), F.lit(0)).cast("long")
    )
    points = parted.groupBy(*group, "part").agg(F.sum("size").alias("weight"), *(F.min(n).alias(n) for n in names))
    tie = F.shiftrightunsigned(F.xxhash64("group", "part"), 64 - _TIE_BITS)
    for k, n in enumerate(names):
        least, most = whole[f"min_{n}"], whole[f"max_{n}"]
        scale = ((1 << _COORDINATE_BITS) - 1) / (most - least) if whole.rows and least is not None and most > least else 0.0
        coordinate = F.floor((F.coalesce(n, F.lit(least or 0.0)) - F.lit(least or 0.0)) * scale).cast("long")
        points = points.withColumn(f"key{k}", F.shiftleft(coordinate, _TIE_BITS) + tie)
    points = stored(points.drop(*names), "points")
    root = Region(0, shards)
    if whole.rows:
        _grow(points, len(names), root, whole.bytes)
    leaf = root.leaf([F.col(f"key{k}") for k in range(len(names))], lambda r: F.lit(r.first))
    placed = stored(points.select(*group, "part", leaf.alias("shard")), "placed-points")
    dealt = parted.select("id", *group, "part").join(placed, [*group, "part"])
    chunks = max(64, whole.rows // (shards * ROWS_A_CHUNK))
    dealt = stored(dealt.select("id", "size", "crc", "shard", F.pmod(F.xxhash64("id", "group"), F.lit(chunks)).alias("chunk")), "dealt")
    # Numbers within a shard: those of a chunk follow those of the chunks before it.
    counts = dealt.groupBy("shard", "chunk").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("chunk")) - F.col("n")
    offsets = counts.select("shard", "chunk", before.alias("before"))
    within = F.row_number().over(Window.partitionBy("shard", "chunk").orderBy("id", "crc")) - 1
    return dealt.join(offsets, ["shard", "chunk"]).select(
        F.col("id").alias(id_col),
        "size",
        F.col("crc").alias("text_crc32"),
        F.col("shard").cast("int").alias("shard"),
        (F.col("before") + within).alias("slot"),
    )


def write_shards(docs: DataFrame, dealt: DataFrame, path: str, *, id_col: str = "doc_id") -> None:
    """Write documents, ids unique, in one folder ``shard=N`` for each shard."""
    dealt = dealt.select(F.col(id_col).alias("_id"), "shard", "slot")
    rows = docs.join(dealt, docs[id_col] == dealt["_id"]).drop("_id")
    rows.hint("rebalance", "shard").write.partitionBy("shard").parquet(path)


def op2_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards of near equal bytes."""
    return kd_shards(documents(spark, sf_dir), shards=SHARDS).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


QUERIES = {"op2_kd_sharding": op2_kd_sharding}
ORACLE: dict[str, str] = {}
