"""Near-duplicate documents: MinHash, banding, verification, components.

Documents with equal shingle sets are one class from the start. Each class has
``bands * rows`` minima of universal hashes; classes that agree in all minima of
a band share a bucket. Inside a bucket not all pairs are formed: members are
first compared with two leaders, by the whole signature and then by the full
shingle sets. What is still apart though buckets connect it is
compared in blocks, full sets again, by matrix products.

A link at the threshold of 0.75 is missed with probability
``(1 - 0.75 ** rows) ** bands``, 2e-6 by default, and at 0.8 with 6e-9.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revmap.llm import sequences as seq
from revmap.llm.components import components
from revmap.llm.store import documents, stored, tagged

BANDS, ROWS = 48, 5
#: How far the share of equal minima may be below the similarity, in standard deviations.
SLACK = 6.0
#: Documents and shingles in a block of documents that are compared all with all.
BLOCK_DOCS, BLOCK_SHINGLES = 400, 1_000_000


def _coefficients(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(7919)
    return rng.integers(0, 2**31, n, dtype=np.uint32) * 2 + 1, rng.integers(0, 2**32, n, dtype=np.uint32)


def shingle_sets(part: np.ndarray, places: np.ndarray, k: int) -> list[np.ndarray]:
    """The distinct hashes of each text's k-word shingles, sorted. A text of fewer
    words has its whole sequence as one, a text without words none."""
    lower = seq.LOWER[part]
    start, end, word0 = seq.words(lower, places)
    hasher = seq.Hasher(seq.word_symbols(lower, start, end))
    windows = hasher.windows(k)
    whole = hasher.stretches(word0[:-1], word0[1:])
    sets = []
    for i, (a, b) in enumerate(zip(word0[:-1].tolist(), word0[1:].tolist(), strict=True)):
        if b - a >= k:
            sets.append(np.unique(windows[a : b - k + 1]))
        else:
            sets.append(whole[i : i + 1] if b > a else whole[:0])
    return sets


def _signatures(k: int, bands: int, rows: int):
    factor, shift = _coefficients(bands * rows)
    salt = seq.mix(np.arange(1, bands + 1, dtype=np.uint64))

    def minima(x: np.ndarray) -> np.ndarray:
        low = seq.mix(x).astype(np.uint32)
        least = np.full(bands * rows, 2**32 - 1, np.uint32)
        for at in range(0, len(low), 256):
            np.minimum(least, (low[at : at + 256, None] * factor + shift).min(axis=0), out=least)
        return least

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, places = seq.buffers(batch.column("text"))
            size, one, two, sketch, keys = [], [], [], [], []
            for _, _, part, at in seq.parts(data, places):
                for x in shingle_sets(part, at, k):
                    least = minima(x)
                    size.append(len(x))
                    one.append(np.add.reduce(seq.mix(x ^ np.uint64(1))))
                    two.append(np.add.reduce(seq.mix(x ^ np.uint64(2))))
                    sketch.append(least.astype(np.uint8).tobytes())
                    key = salt.copy()
                    for column in least.reshape(bands, rows).T:
                        key = seq.mix(key + column)
                    keys.append(key)
            keys = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array(size, pa.int64()),
                    pa.array(np.array(one, np.uint64).view(np.int64)),
                    pa.array(np.array(two, np.uint64).view(np.int64)),
                    pa.array(sketch, pa.binary()),
                    pa.ListArray.from_arrays(np.arange(len(size) + 1, dtype=np.int32) * bands, pa.array(keys.view(np.int64))),
                ],
                ["id", "size", "one", "two", "sketch", "bands"],
            )

    return run


def _alike(threshold: int, minima: int):
    """Pairs whose signatures allow the similarity."""
    share = threshold / 100
    least = share - SLACK * np.sqrt(share * (1 - share) / minima)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, minima) for c in ("sketch_a", "sketch_b"))
            yield batch.select(["a", "b"]).filter(pa.array((x == y).mean(axis=1) >= least))

    return run


def _confirmed(k: int, threshold: int):
    """Pairs whose full shingle sets have the similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: dict[str, np.ndarray] = {}

        def shingles(text: str) -> np.ndarray:
            if text not in last:
                if len(last) > 64:
                    last.clear()
                data = np.frombuffer(text.encode(), np.uint8)
                last[text] = shingle_sets(data, np.array([0, len(data)]), k)[0]
            return last[text]

        for batch in batches:
            keep = []
            for one, two in zip(batch.column("text_a"), batch.column("text_b"), strict=True):
                x, y = shingles(one.as_py()), shingles(two.as_py())
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= threshold * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def near_duplicates(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 5,
    threshold: int = 75,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """Components of documents whose word shingles overlap by ``threshold`` percent or more.

    Words are runs of anything but 0x20 and 0x09-0x0D, with A-Z in lower case.
    Returns one row for each row of ``docs``: id, ``n_shingles``, ``component_id``
    (the least id that links lead to) and ``kept`` (the row is that document).
    A text that is null or without words has an empty set and is linked with
    nothing. Rows that repeat an id are one node. A row without an id is kept,
    has no component and links nothing. An empty table gives an empty table.
    Other columns are ignored.
    """
    texts = tagged(docs, id_col, text_col).select("id", "text")
    id_type = texts.schema["id"].dataType.simpleString()
    signed = stored(
        texts.mapInArrow(
            _signatures(shingle, bands, rows),
            f"id {id_type}, size bigint, one bigint, two bigint, sketch binary, bands array<bigint>",
        ),
        "signatures",
    )
    with_words = signed.where("size > 0 AND id IS NOT NULL")
    # What is joined back is stored, as Spark splits a skewed join only of plain inputs.
    classes = stored(with_words.groupBy("one", "two", "size").agg(F.min("id").alias("rep")), "classes")
    reps = stored(
        with_words.join(classes.select(F.col("rep").alias("id"), "one", "two"), ["id", "one", "two"])
        .select("id", "size", "sketch", "bands"),
        "representatives",
    )
    member = reps.select("id", "size", F.explode("bands").alias("bucket"))
    shared = stored(
        member.groupBy("bucket").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi"), "shared"
    )
    members = stored(member.join(shared, "bucket"), "buckets")
    taking_part = stored(members.select("id").distinct(), "members")
    texts = stored(texts.join(taking_part, "id", "left_semi"), "texts")
    sketches = stored(reps.select("id", "size", "sketch").join(taking_part, "id", "left_semi"), "sketches")
    compare = _Comparison(texts, sketches, id_type, shingle, threshold, bands * rows)

    leaders = F.explode(F.array("lo", "hi")).alias("b")
    found = components(compare(members.select(F.col("id").alias("a"), leaders).where("a != b")))
    rest = _rest(members, found, texts, id_type, shingle, threshold)
    if not rest.isEmpty():
        found = components(rest.union(found.select(F.col("node").alias("a"), F.col("component").alias("b"))))

    result = signed.select("id", "size", "one", "two").join(classes, ["one", "two", "size"], "left")
    result = result.join(found.withColumnRenamed("node", "rep"), "rep", "left")
    component = F.coalesce("component", "rep", "id")
    return result.select(
        F.col("id").alias(id_col),
        F.col("size").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )


def _rest(members: DataFrame, found: DataFrame, texts: DataFrame, id_type: str, shingle: int, threshold: int) -> DataFrame:
    """Links between documents that buckets connect but that are in different components so far.

    Components that buckets connect, directly or over others, are a cluster. Of
    clusters with several components, all documents are compared by matrix products
    of their full sets. Only sizes within the threshold can match, so a document
    meets its own class of sizes and the classes next to it, in blocks: each task
    has two blocks, and a document is sent to as many tasks as there are blocks.
    """
    placed = members.select("bucket", "id", "size").join(found.withColumnRenamed("node", "id"), "id", "left")
    placed = stored(placed.withColumn("component", F.coalesce("component", "id")), "placed")
    least = stored(
        placed.groupBy("bucket").agg(F.min("component").alias("b"), F.max("component").alias("most")).where("b < most"), "least"
    )
    connected = placed.join(least, "bucket").select(F.col("component").alias("a"), "b")
    cluster = components(connected)
    # Every component of a cluster, the least one too.
    apart = cluster.select(F.col("node").alias("component"), F.col("component").alias("cluster"))
    apart = stored(apart.union(apart.select("cluster", "cluster").distinct()), "clusters")
    size_class = F.floor(F.log(F.col("size").cast("double")) / float(np.log(100 / threshold))).cast("int")
    everyone = placed.groupBy("id").agg(F.max("size").alias("size"), F.min("component").alias("component"))
    placed = stored(everyone.join(apart, "component").withColumn("class", size_class), "apart")
    blocks = F.ceil(F.greatest(F.count("*") / BLOCK_DOCS, F.sum("size") / BLOCK_SHINGLES)).cast("int")
    sizes = placed.groupBy("cluster", "class").agg(blocks.alias("blocks"))
    near = lambda step, name: sizes.select("cluster", (F.col("class") + step).alias("class"), F.col("blocks").alias(name))
    sizes = stored(
        sizes.join(near(1, "below"), ["cluster", "class"], "left").join(near(-1, "above"), ["cluster", "class"], "left"), "blocks"
    )
    own = placed.join(sizes, ["cluster", "class"]).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    each = lambda n, row: F.expr(f"transform(filter(sequence(0, {n} - 1), x -> {n} > 0), x -> {row})")
    tasks = F.concat(
        each("blocks", "struct(class AS c, least(block, x) AS x, class AS d, greatest(block, x) AS y)"),
        each("coalesce(above, 0)", "struct(class AS c, block AS x, class + 1 AS d, x AS y)"),
        each("coalesce(below, 0)", "struct(class - 1 AS c, x AS x, class AS d, block AS y)"),
    )
    sent = own.join(texts, "id").select("cluster", "id", "component", "text", F.explode(tasks).alias("task"))
    sent = sent.select("cluster", "task.*", "id", "component", "text")
    links = sent.groupBy("cluster", "c", "x", "d", "y").applyInPandas(_matched(shingle, threshold), f"a {id_type}, b {id_type}")
    return stored(links.distinct(), "rest")


def _matched(k: int, threshold: int):
    """Links between the components in one task."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        data, places = seq.buffers(pa.array(rows.text, pa.string()))
        sets = [x for _, _, part, at in seq.parts(data, places) for x in shingle_sets(part, at, k)]
        n, size = len(sets), np.array([len(x) for x in sets])
        _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        doc = np.repeat(np.arange(n), size)
        shared = times[column] > 1  # what only one set has is in no intersection
        column, doc = column[shared], doc[shared]
        column = np.unique(column, return_inverse=True)[1]
        order = np.argsort(column, kind="stable")
        column, doc = column[order], doc[order]
        common = np.zeros((n, n), np.float32)
        for at in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
            a, b = np.searchsorted(column, (at, at + 4096))
            has = np.zeros((n, 4096), np.float32)
            has[doc[a:b], column[a:b] - at] = 1
            common += has @ has.T
        component = rows.component.to_numpy()
        linked = 100 * common >= threshold * (size[:, None] + size[None, :] - common)
        x, y = np.nonzero(np.triu(linked & (component[:, None] != component[None, :]), 1))
        ids = rows.id.to_numpy()
        return pd.DataFrame({"a": ids[x], "b": ids[y]})

    return run


class _Comparison:
    """Compares pairs by signature, then by full sets; no pair twice in a call."""

    def __init__(self, texts: DataFrame, sketches: DataFrame, id_type: str, shingle: int, threshold: int, minima: int):
        self._texts, self._sketches, self._minima = texts, sketches, minima
        self._schema, self._shingle, self._threshold = f"a {id_type}, b {id_type}", shingle, threshold

    def _side(self, frame: DataFrame, side: str) -> DataFrame:
        return frame.select(*(F.col(c).alias(side if c == "id" else f"{c}_{side}") for c in frame.columns))

    def __call__(self, pairs: DataFrame) -> DataFrame:
        pairs = stored(pairs.distinct(), "pairs").join(self._side(self._sketches, "b"), "b").join(self._side(self._sketches, "a"), "a")
        pairs = pairs.where(f"100 * least(size_a, size_b) >= {self._threshold} * greatest(size_a, size_b)")
        alike = pairs.select("a", "b", "sketch_a", "sketch_b").mapInArrow(_alike(self._threshold, self._minima), self._schema)
        alike = stored(alike, "alike").join(self._side(self._texts, "b"), "b").join(self._side(self._texts, "a"), "a")
        return stored(alike.mapInArrow(_confirmed(self._shingle, self._threshold), self._schema), "confirmed")


def op8_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The component of near copies each document is in."""
    return near_duplicates(documents(spark, sf_dir))


QUERIES = {"op8_minhash_dedup": op8_minhash_dedup}

ORACLE = {
    "op8_minhash_dedup": """
WITH RECURSIVE d AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
    FROM documents
), s AS (
    SELECT DISTINCT doc_id, md5(array_to_string(w[i:i + 4], ' ')) AS h
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)
), n AS (
    SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), c AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
    FROM s AS a JOIN s AS b ON a.h = b.h AND a.doc_id <> b.doc_id GROUP BY ALL
), e AS (
    SELECT a, b FROM c JOIN n AS x ON x.doc_id = a JOIN n AS y ON y.doc_id = b
    WHERE 100 * common >= 75 * (x.n + y.n - common)
), r AS (
    SELECT a AS node, a AS reached FROM e
    UNION
    SELECT r.node, e.b FROM r JOIN e ON e.a = r.reached
), k AS (
    SELECT node, min(reached) AS component FROM r GROUP BY node
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(component, d.doc_id) AS component_id,
       coalesce(component, d.doc_id) = d.doc_id AS kept
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN k ON k.node = d.doc_id
"""
}
