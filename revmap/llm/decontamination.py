"""Passages of test questions and answers in documents, by one Aho-Corasick automaton.

A text is normalised to its words (runs of a-z, 0-9 and anything outside ASCII,
A-Z in lower case) with one space around each. Every window of a question or
answer is a pattern of the automaton, from its first to its last space, and one
scan of a normalised document finds all of them, overlaps included. Spaces count
the words, so each occurrence is known by the numbers of its words, and these
lead back to places in the original text.

The automaton holds at most ``block_bytes`` of normalised questions. A larger
question table is dealt into blocks, each with an automaton of its own, and the
documents pass through one after the other in the same stage, without a shuffle.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revmap.llm import sequences as seq
from revmap.llm.store import documents

WINDOW = 13
#: Normalised text in one automaton. Its windows overlap, so it takes some hundred times as much memory.
BLOCK_BYTES = 1 << 18

#: What each byte becomes: 0-9, a-z and all beyond ASCII stay, A-Z become a-z, the rest ends a word.
NORMAL = bytes(b if b >= 128 or chr(b).isdigit() or chr(b).islower() else b + 32 if chr(b).isupper() else 32 for b in range(256))

_automata: dict[str, tuple[ahocorasick.Automaton, list[list[str]], list[int]]] = {}


def normal_words(text: str | bytes | None) -> list[bytes]:
    if text is None:
        return []
    return (text.encode() if isinstance(text, str) else text).translate(NORMAL).split()


def _automaton(items: Broadcast, window: int):
    """The automaton of a block, built once in each Python worker."""
    name, rows = items.value
    if name not in _automata:
        patterns: dict[str, set[str]] = defaultdict(set)
        length: dict[str, int] = {}
        for item, text in rows:
            words = normal_words(text)
            for i in range(max(1, len(words) - window + 1) if words else 0):
                part = words[i : i + window]
                pattern = b" ".join([b"", *part, b""]).decode("latin-1")
                patterns[pattern].add(item)
                length[pattern] = len(part)
        automaton = ahocorasick.Automaton()
        for k, pattern in enumerate(patterns):
            automaton.add_word(pattern, k)
        if patterns:
            automaton.make_automaton()
        _automata.clear()
        _automata[name] = automaton, [sorted(x) for x in patterns.values()], [length[p] for p in patterns]
    return _automata[name]


def _union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    merged: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if merged and a <= merged[-1][1]:
            merged[-1] = merged[-1][0], max(b, merged[-1][1])
        else:
            merged.append((a, b))
    return merged


def _scan(items: Broadcast, window: int, text_col: str, names: list[str]):
    """Add a block's hits to those that the documents bring along."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, owners, length = _automaton(items, window)
        for batch in batches:
            data, places = seq.buffers(batch.column(text_col))
            n_words, spans, hit_items = [], batch.column("spans").to_pylist(), batch.column("items").to_pylist()
            for i, (a, b) in enumerate(zip(places[:-1].tolist(), places[1:].tolist(), strict=True)):
                words = data[a:b].tobytes().translate(NORMAL).split()
                n_words.append(len(words))
                if not len(automaton) or not words:
                    continue
                text = b" ".join([b"", *words, b""])
                hits = list(automaton.iter(text.decode("latin-1")))
                if not hits:
                    continue
                space = np.flatnonzero(np.frombuffer(text, np.uint8) == 32)
                last = np.searchsorted(space, [end for end, _ in hits])
                found = [(int(n) - length[k], int(n)) for n, (_, k) in zip(last, hits, strict=True)]
                spans[i] = [{"start": x, "end": y} for x, y in _union(found + [(s["start"], s["end"]) for s in spans[i]])]
                hit_items[i] = sorted({*hit_items[i], *(owner for _, k in hits for owner in owners[k])})
            columns = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(n_words, pa.int64()), pa.array(spans, _SPANS), pa.array(hit_items, pa.list_(pa.string()))],
                [*names, "n_words", "spans", "items"],
            )

    return run


_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
_ADDED = "n_words bigint, spans array<struct<start:int,end:int>>, items array<string>"


def contamination(
    docs: DataFrame,
    items: DataFrame,
    *,
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Find the windows of ``items`` in ``docs``.

    Returns the columns of ``docs`` and ``n_words``, ``spans`` (numbers of the hit
    words, end left out, apart from each other), ``items`` (ids of the items with a
    window here, as sorted strings), ``n_hit`` and ``contaminated``: at least a
    twentieth of the words are hit. Columns of these names in ``docs`` are replaced.

    A window is ``window`` consecutive words of an item; an item of fewer words is
    one window, an item without words or without an id is left out. Rows that
    repeat an item count once. A null text has no words. Without items, or without
    documents, nothing is hit.
    """
    names = [c for c in docs.columns if c not in ("n_words", "spans", "items", "n_hit", "contaminated")]
    docs = docs.select(*(f"`{c}`" for c in names))
    spark = docs.sparkSession
    normal = items.select(F.col(item_id).cast("string").alias("id"), F.col(item_text).alias("text")).where(
        "id IS NOT NULL AND text IS NOT NULL"
    )
    n_blocks = 1 + (normal.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // block_bytes
    found = docs.selectExpr("*", "cast(array() AS array<struct<start:int,end:int>>) AS spans", "cast(array() AS array<string>) AS items")
    schema = T.StructType([*docs.schema.fields, *T.StructType.fromDDL(_ADDED).fields])
    for k in range(n_blocks):
        block = normal.where(F.pmod(F.xxhash64("id", "text"), F.lit(n_blocks)) == k).distinct().orderBy("id", "text")
        rows = [(r.id, r.text) for r in block.toLocalIterator()]
        found = found.mapInArrow(_scan(spark.sparkContext.broadcast((uuid.uuid4().hex, rows)), window, text_col, names), schema)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s.end - s.start)
    found = found.withColumn("n_hit", n_hit)
    return found.withColumn("contaminated", F.expr("n_hit > 0 AND 20 * n_hit >= n_words"))


def original_spans(text: str, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Where spans of word numbers lie in the original text, in characters."""
    data = np.frombuffer(text.encode(), np.uint8)
    inside = np.frombuffer(data.tobytes().translate(NORMAL), np.uint8) != 32
    edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    start, end = edge[::2], edge[1::2]
    chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    return [(int(chars[start[a]]), int(chars[end[b - 1]])) for a, b in spans]


def _mask(text_col: str, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text_col).to_pylist()
            for i, spans in enumerate(batch.column("spans").to_pylist()):
                if spans:
                    at, done = 0, []
                    for a, b in original_spans(texts[i], [(s["start"], s["end"]) for s in spans]):
                        done.append(texts[i][at:a])
                        at = b
                    texts[i] = "".join([*done, texts[i][at:]])
            yield pa.RecordBatch.from_arrays([pa.array(texts) if c == text_col else batch.column(c) for c in names], names)

    return run


def without_passages(found: DataFrame, *, text_col: str = "text") -> DataFrame:
    """Result of :func:`contamination` with the hit words cut out of the original text."""
    return found.mapInArrow(_mask(text_col, found.columns), found.schema)


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which benchmark items stand in each document, and how much of it they cover."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = contamination(documents(spark, sf_dir).select("doc_id", "text"), items)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.encode(F.array_join("items", ","), "UTF-8"), 256).alias("items_sha256"),
        "contaminated",
    )


QUERIES = {"op1_decontamination": op1_decontamination}

ORACLE = {
    "op1_decontamination": """
WITH b AS (
    SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark WHERE item_id IS NOT NULL
), bw AS (
    SELECT item_id, least(len(w), 13) AS k, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0
), p AS (
    SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS t FROM bw
), d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
), dw AS (
    SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS t
    FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i
          FROM d, (SELECT DISTINCT k FROM p) WHERE len(w) >= k)
), h AS (
    SELECT doc_id, item_id, i, dw.k FROM dw JOIN p ON p.t = dw.t AND p.k = dw.k
), n AS (
    SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS j FROM h) GROUP BY doc_id
), m AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS s
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM h) GROUP BY doc_id
)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN m ON m.doc_id = d.doc_id
"""
}
