"""Long word passages that repeat across documents, by De Bruijn compaction.

The k-mers (windows) of consecutive words are the edges of a De Bruijn graph. At
one row a word the graph would be many times the text, so it is never laid out:
edges that follow each other and share their least k-gram (their anchor) form one
path, a single row, right where the text is read. Then, with Spark joins:

1. Paths whose anchor stands in one document only cannot repeat and go.
2. A path that stands in several documents as a whole is non-branching there and
   stays compact: all its copies but those in the smallest document are repeats.
3. Where an anchor has several paths, the graph branches. One copy of each of
   those paths is opened into its edges, and each edge is compared by itself.
4. Source coordinates of repeated paths and edges are merged into maximal spans
   for each document, and the words in them are taken out.

No step gathers a group: groups are reduced by ``min`` with partial sums on the
map side, and the result is joined back in joins that Spark may split on skew.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revmap.llm import sequences as seq
from revmap.llm.store import documents, stored, tag, tagged

WINDOW = 50
#: Words in an anchor: long enough to be rare, short enough to keep paths long.
ANCHOR = 10


def _paths(window: int, anchor: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, places = seq.buffers(batch.column("text"))
            for first, last, part, at in seq.parts(data, places):
                start, end, word0 = seq.words(part, at)
                found = seq.super_windows(seq.word_symbols(part, start, end), word0, window, anchor)
                text, begin, n, least, covered = found
                which = pa.array(first + text)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").take(which),
                        batch.column("tag").take(which),
                        pa.array(begin.astype(np.int32)),
                        pa.array(n.astype(np.int32)),
                        pa.array(least.view(np.int64)),
                        pa.array(covered.view(np.int64)),
                    ],
                    ["id", "tag", "start", "n", "anchor", "path"],
                )

    return run


def _edges(window: int):
    """The edges of the listed paths of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, places = seq.buffers(batch.column("text"))
            lists = batch.column("paths")
            offsets = lists.offsets.to_numpy()
            begins = lists.values.field("start").to_numpy()
            counts = lists.values.field("n").to_numpy()
            for first, last, part, at in seq.parts(data, places):
                start, end, word0 = seq.words(part, at)
                hasher = seq.Hasher(seq.word_symbols(part, start, end))
                own = slice(offsets[first], offsets[last])
                text = np.repeat(np.arange(last - first), np.diff(offsets[first : last + 1]))
                base = np.repeat(begins[own], counts[own])
                step = np.arange(len(base)) - np.repeat(np.cumsum(counts[own]) - counts[own], counts[own])
                text, begin = np.repeat(text, counts[own]), base + step
                where = word0[text] + begin
                which = pa.array(first + text)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").take(which),
                        batch.column("tag").take(which),
                        pa.array(begin.astype(np.int32)),
                        pa.array(hasher.stretches(where, where + window).view(np.int64)),
                    ],
                    ["id", "tag", "start", "edge"],
                )

    return run


def merge_spans(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Overlapping or touching spans made one, in order."""
    order = np.argsort(begin, kind="stable")
    begin, reach = begin[order], np.maximum.accumulate(end[order])
    new = np.ones(len(begin), bool)
    new[1:] = begin[1:] > reach[:-1]
    last = np.append(np.flatnonzero(new)[1:] - 1, len(begin) - 1) if len(begin) else np.zeros(0, int)
    return begin[new], reach[last]


def _cut(names: list[str], text_col: str):
    """Take the spans' words out of each text, with the spaces that follow them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, places = seq.buffers(batch.column(text_col))
            texts, spans = batch.column(text_col).to_pylist(), batch.column("_spans")
            offsets, flat = spans.offsets.to_numpy(), spans.values
            begins, ends = flat.field("start").to_numpy(), flat.field("end").to_numpy()
            n_words, n_removed, removed = [], [], []
            for first, last, part, at in seq.parts(data, places):
                start, end, word0 = seq.words(part, at)
                n_words.extend(np.diff(word0).tolist())
                for k in range(first, last):
                    lo, hi = offsets[k], offsets[k + 1]
                    if lo == hi or spans[k].is_valid is False:
                        n_removed.append(0)
                        removed.append([])
                        continue
                    b, e = merge_spans(begins[lo:hi], ends[lo:hi])
                    own, word = part[at[k - first] : at[k - first + 1]].tobytes(), word0[k - first]
                    count = word0[k - first + 1] - word
                    kept, done, list_ = [], 0, []
                    for x, y in zip(b.tolist(), e.tolist(), strict=True):
                        from_ = int(start[word + x] - at[k - first])
                        to = int(start[word + y] - at[k - first]) if y < count else len(own)
                        kept.append(own[done:from_])
                        done = to
                        list_.append({"start": x, "end": y})
                    kept.append(own[done:])
                    texts[k] = b"".join(kept).decode()
                    n_removed.append(int((e - b).sum()))
                    removed.append(list_)
            columns = [pa.array(texts, pa.string()) if c == text_col else batch.column(c) for c in names]
            columns += [
                pa.array(n_words, pa.int64()),
                pa.array(n_removed, pa.int64()),
                pa.array(removed, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
            ]
            yield pa.RecordBatch.from_arrays(columns, [*names, "n_words", "n_removed", "removed"])

    return run


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """Take out each word that lies in ``window`` consecutive words of which the
    same sequence also starts in a document with a smaller id.

    Words are runs of anything but 0x20 and 0x09-0x0D, compared byte for byte.
    Returns the columns of ``docs``, the text without those words (and the spaces
    after each), and ``n_words``, ``n_removed``, ``removed`` (spans of word
    numbers, end left out); columns of these names in ``docs`` are replaced.
    A null text stays null and has no words; a text shorter than the window is
    kept. Rows of one id do not remove from each other; rows without an id neither
    lose words nor make others lose any. Equal texts lose their words in all
    documents but that with the smallest id. An empty table gives an empty table.
    """
    if not 0 < anchor <= window:
        raise ValueError("the anchor must be within the window")
    rest = [c for c in docs.columns if c not in ("n_words", "n_removed", "removed")]
    docs = docs.select(*(f"`{c}`" for c in rest))
    spark = docs.sparkSession
    texts = tagged(docs, id_col, text_col).where("id IS NOT NULL")
    id_type = texts.schema["id"].dataType.simpleString()
    paths = stored(
        texts.mapInArrow(_paths(window, anchor), f"id {id_type}, tag int, start int, n int, anchor bigint, path bigint"),
        "paths",
    )
    # What is joined back is stored, as Spark splits a skewed join only of plain inputs.
    anchors = stored(
        paths.groupBy("anchor")
        .agg(F.min("id").alias("a"), F.max("id").alias("b"), (F.min("path") != F.max("path")).alias("branches"))
        .where("a < b")
        .select("anchor", "branches"),
        "anchors",
    )
    shared = stored(paths.join(anchors, "anchor"), "shared-paths")
    first = stored(shared.groupBy("path").agg(F.min("id").alias("first")), "first-paths")
    placed = shared.join(first, "path")
    later = placed.where("id > first").select("id", "tag", "start", F.expr(f"start + n + {window - 1}").alias("end"))
    opened = (
        placed.where("id = first AND branches")
        .groupBy("id", "tag")
        .agg(F.collect_list(F.struct("start", "n")).alias("paths"))
    )
    edges = stored(
        texts.join(opened, ["id", "tag"]).mapInArrow(_edges(window), f"id {id_type}, tag int, start int, edge bigint"),
        "edges",
    )
    edge_first = stored(
        edges.groupBy("edge").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last").select("edge", "first"),
        "first-edges",
    )
    later_edges = (
        edges.join(edge_first, "edge").where("id > first").select("id", "tag", "start", F.expr(f"start + {window}").alias("end"))
    )
    spans = (
        later.unionByName(later_edges)
        .groupBy(F.col("id").alias("_id"), F.col("tag").alias("_tag"))
        .agg(F.collect_list(F.struct("start", "end")).alias("_spans"))
    )
    return _apply(spark, docs, spans, rest, id_col, text_col)


def _apply(spark: SparkSession, docs: DataFrame, spans: DataFrame, rest: list[str], id_col: str, text_col: str) -> DataFrame:
    keyed = docs.withColumn("_tag0", tag(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))))
    joined = keyed.join(spans, (keyed[id_col] == spans["_id"]) & (keyed["_tag0"] == spans["_tag"]), "left").select(
        *(keyed[c] for c in rest),
        F.coalesce("_spans", F.expr("cast(array() AS array<struct<start:int,end:int>>)")).alias("_spans"),
    )
    more = T.StructType.fromDDL("n_words bigint, n_removed bigint, removed array<struct<start:int,end:int>>")
    return joined.mapInArrow(_cut(rest, text_col), T.StructType([*docs.schema.fields, *more.fields]))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that are left when later copies of 50-word passages go."""
    left = remove_repeats(documents(spark, sf_dir).select("doc_id", "text"))
    words = F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", " "))
    return left.select("doc_id", "n_words", "n_removed", F.sha2(F.encode(words, "UTF-8"), 256).alias("kept_sha256"))


QUERIES = {"op10_substring_dedup": op10_substring_dedup}

ORACLE = {
    "op10_substring_dedup": """
WITH d AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), p AS (
    SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50
), g AS (
    SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h FROM p
), f AS (
    SELECT doc_id, i, min(doc_id) OVER (PARTITION BY h) AS first FROM g
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i FROM f WHERE doc_id > first
), gone_of AS (
    SELECT doc_id, list(i) AS l FROM gone GROUP BY doc_id
)
SELECT d.doc_id, len(w) AS n_words, coalesce(len(l), 0) AS n_removed,
       sha256(array_to_string(list_filter(w, lambda x, i: NOT list_contains(coalesce(l, []), i)), ' ')) AS kept_sha256
FROM d LEFT JOIN gone_of USING (doc_id)
"""
}
