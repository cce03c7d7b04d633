"""Repeated byte strings, by longest previous factors of partitioned suffixes.

A string of ``window`` bytes is a later copy if its longest previous factor is as
long as the window: put suffixes in the order of their first ``window`` bytes, and
among equal ones of their positions; the entry before with a smaller position then
has the longest match that starts earlier, and the bytes that neighbours have in
common say how long it is. Suffixes are dealt out so that those which share
``window`` bytes meet:

1. Each suffix belongs to the anchor of its first ``window`` bytes, their least
   k-gram by hash. Neighbours with one anchor form a run, one row, cut by content
   on both sides. Runs whose anchor occurs once cannot match anything and go.
2. Of equal runs (128 bits of hashes), which copied text consists of, all but those
   in the smallest document are later copies at once. Copies within a document are
   found there.
3. For anchors with several different runs, one copy of each goes with its bytes to
   a group of anchors, where its suffixes are ordered and compared by their bytes.

Hashes only part what cannot match from what is compared. An anchor with more than
HOT different runs is dealt to several groups; suffixes that are first in theirs are
then packed by 128 bits of hashes of their bytes and compared once more.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from revmap.llm import sequences as seq
from revmap.llm.store import documents, stored, tag, tagged
from revmap.llm.substring_dedup import merge_spans

WINDOW, ANCHOR = 100, 20
#: Runs in a group of anchors, about; an anchor with more different runs than HOT is dealt to several groups.
GROUP_RUNS, HOT = 8_000, 50_000
#: Suffixes that are put in order at once, in bytes.
ORDER_BYTES = 16 << 20

_RUN = "within boolean, route bigint, known boolean, anchor bigint, path bigint, start int, n int"


def _spread(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which values occur before in an array, and which more than once."""
    order = np.argsort(values, kind="stable")
    same = values[order][1:] == values[order][:-1]
    again, several = np.zeros(len(values), bool), np.zeros(len(values), bool)
    again[order[1:]] = same
    several[order[1:]] = same
    several[order[:-1]] |= same
    return again, several


def _stretches(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return edges[::2], edges[1::2]


def _runs(window: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, places = seq.buffers(batch.column("text"))
            found: list[tuple] = []
            own: list[tuple] = []
            for first, _, part, at in seq.parts(data, places):
                symbols = seq.BYTE_SYMBOL[part]
                text, start, n, least, covered = seq.super_windows(symbols, at, window, k)
                found.append((first + text, start, n, least, covered))
                for t in seq.repeating_texts(symbols, at, window, k).tolist():
                    hashes = seq.Hasher(symbols[at[t] : at[t + 1]]).windows(window)
                    some = np.flatnonzero(_spread(hashes)[1])
                    again = np.zeros(len(hashes), bool)
                    again[some] = longest_previous_factors(part, at[t] + some, hashes[some], some, window) == window
                    begin, end = _stretches(again)
                    own.append((np.full(len(begin), first + t), begin, end - begin))
            if not found:
                continue
            text, start, n, anchor, path = (np.concatenate([f[i] for f in found]) for i in range(5))
            # An anchor that comes twice here is known to be repeated. One row goes to
            # where other tasks' rows of it go, to tell them; the rest spread.
            again, several = _spread(anchor)
            route = np.where(again, seq.mix(anchor ^ path ^ seq.mix(text.astype(np.uint64))), anchor)
            m = sum(len(o[0]) for o in own)
            more = [np.concatenate([o[i] for o in own]) if m else np.zeros(0, np.int64) for i in range(3)]
            which = pa.array(np.concatenate([text, more[0]]))
            none = np.zeros(m, np.uint64)
            own_route = seq.mix(more[0].astype(np.uint64) << np.uint64(32) | more[1].astype(np.uint64))
            whole = lambda *x: np.concatenate(x)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(which),
                    batch.column("tag").take(which),
                    pa.array(whole(np.zeros(len(text), bool), np.ones(m, bool))),
                    pa.array(whole(route, own_route).view(np.int64)),
                    pa.array(whole(several, np.ones(m, bool))),
                    pa.array(whole(anchor, none).view(np.int64)),
                    pa.array(whole(path, none).view(np.int64)),
                    pa.array(whole(start, more[1]).astype(np.int32)),
                    pa.array(whole(n, more[2]).astype(np.int32)),
                ],
                ["id", "tag", "within", "route", "known", "anchor", "path", "start", "n"],
            )

    return run


def _opened(window: int):
    """The bytes of the listed runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, places = seq.buffers(batch.column("text"))
            lists = batch.column("runs")
            offsets, flat = lists.offsets.to_numpy(), lists.values
            start, n = flat.field("start").to_numpy(), flat.field("n").to_numpy()
            for first, last, part, at in seq.parts(data, places):
                own = slice(offsets[first], offsets[last])
                text = np.repeat(np.arange(first, last), np.diff(offsets[first : last + 1]))
                where, raw = at[text - first] + start[own], part.tobytes()
                pieces = [raw[a:b] for a, b in zip(where.tolist(), (where + n[own] + window - 1).tolist(), strict=True)]
                which, listed = pa.array(text), pa.array(np.arange(own.start, own.stop))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").take(which),
                        batch.column("tag").take(which),
                        *(flat.field(c).take(listed) for c in ("anchor", "hot", "start")),
                        pa.array(pieces, pa.binary()),
                    ],
                    ["id", "tag", "anchor", "hot", "start", "bytes"],
                )

    return run


def longest_previous_factors(data: np.ndarray, start: np.ndarray, prefix: np.ndarray, position: np.ndarray, depth: int) -> np.ndarray:
    """How many bytes, up to ``depth``, each suffix shares with the entry of a smaller
    position before it in suffix order; 0 for the first of a match.

    Suffixes are taken from ``start`` in ``data``, in blocks by ``prefix``, a hash of
    their first ``depth`` bytes: others cannot share all of these. Within equal bytes the
    order is by position, so the previous smaller position is the nearest entry before
    of another position, and the next smaller one never shares more.
    """
    found = np.zeros(len(start), np.int64)
    blocked = np.argsort(prefix, kind="stable")
    edges = np.flatnonzero(np.concatenate([[True], prefix[blocked][1:] != prefix[blocked][:-1]])) if len(blocked) else blocked
    at, limit = 0, max(1, ORDER_BYTES // depth)
    while at < len(blocked):
        # Whole groups of equal hashes, about a limit of suffixes.
        k = int(np.searchsorted(edges, at + limit, "right"))
        end = int(edges[k]) if k < len(edges) else len(blocked)
        if k and int(edges[k - 1]) > at:
            end = int(edges[k - 1])
        some = blocked[at:end]
        some = some[np.argsort(position[some], kind="stable")]
        # Taken from a view: places of single bytes would be eight times the bytes.
        rows = np.lib.stride_tricks.sliding_window_view(data, depth)[start[some]]
        order = np.argsort(rows.view(f"S{depth}").ravel(), kind="stable")
        some, rows = some[order], rows[order]
        fresh = np.concatenate([[True], (rows[1:] != rows[:-1]).any(axis=1)])
        del rows
        # The first entry of each stretch of equal bytes.
        index, p = np.arange(len(some)), position[some]
        head = np.maximum.accumulate(np.where(fresh, index, 0))
        found[some] = np.where(p > p[head], depth, 0)
        at = end
    return found


def _pack(columns: dict[str, pa.Array], bucket: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """Rows as one piece of bytes for each bucket."""
    table, order = pa.table(columns), np.argsort(bucket, kind="stable")
    table, (found, first) = table.take(pa.array(order)), np.unique(bucket[order], return_index=True)
    pieces = []
    for a, b in zip(first.tolist(), [*first[1:].tolist(), len(bucket)], strict=True):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as out:
            out.write_table(table.slice(a, b - a))
        pieces.append(sink.getvalue().to_pybytes())
    return found, pieces


def _factors(window: int, buckets: int):
    """Later copies among the runs of a group as spans of bytes. Of hot anchors, a
    group has only a part, so for them also the suffixes that are first in it, with
    two hashes of their first ``window`` bytes, packed by the first, to be compared
    with other groups'."""

    def run(rows: pa.Table) -> pa.Table:
        data, places = seq.buffers(rows["bytes"])
        ids = np.unique(np.array(rows["id"].to_pylist()), return_inverse=True)[1]
        n = np.diff(places) - window + 1
        row = np.repeat(np.arange(len(n)), n)
        step = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        begins = places[row] + step
        prefix = seq.Hasher(seq.BYTE_SYMBOL[data]).stretches(begins, begins + window)
        some = np.flatnonzero(_spread(prefix)[1])
        later = np.zeros(len(row), bool)
        later[some] = longest_previous_factors(data, begins[some], prefix[some], ids[row[some]], window) == window
        # Neighbouring suffixes of one run make one span; a gap parts the runs.
        flags = np.zeros(len(row) + len(n), bool)
        flags[np.arange(len(row)) + row] = later
        begin, end = _stretches(flags)
        reach = np.cumsum(n + 1)
        owner = np.searchsorted(reach, begin, "right")
        first = reach[owner] - (n[owner] + 1)
        start = rows["start"].to_numpy()
        open_ = np.flatnonzero(rows["hot"].to_numpy()[row] & ~later)
        found, pieces = np.zeros(0, np.int64), []
        if len(open_):
            other = seq.Hasher(seq.mix(seq.BYTE_SYMBOL)[data]).stretches(begins[open_], begins[open_] + window)
            columns = {
                "id": rows["id"].take(pa.array(row[open_])),
                "tag": rows["tag"].take(pa.array(row[open_])),
                "start": pa.array((start[row[open_]] + step[open_]).astype(np.int32)),
                "prefix": pa.array(prefix[open_]),
                "other": pa.array(other),
            }
            found, pieces = _pack(columns, (prefix[open_] % np.uint64(buckets)).astype(np.int64))
        none = lambda kind: pa.nulls(len(found), kind)
        spans = [
            rows["id"].combine_chunks().take(pa.array(owner)),
            rows["tag"].combine_chunks().take(pa.array(owner)),
            pa.array((start[owner] + begin - first).astype(np.int32)),
            pa.array((start[owner] + end - first + window - 1).astype(np.int32)),
        ]
        columns = [pa.concat_arrays([c, none(c.type)]) for c in spans]
        columns.append(pa.concat_arrays([pa.nulls(len(owner), pa.int64()), pa.array(found, pa.int64())]))
        columns.append(pa.concat_arrays([pa.nulls(len(owner), pa.binary()), pa.array(pieces, pa.binary())]))
        return pa.table(columns, names=["id", "tag", "start", "end", "bucket", "packed"])

    return run


def _first_of_all(window: int):
    """Spans of the packed suffixes of a bucket that another document has before."""

    def run(rows: pa.Table) -> pa.Table:
        table = pa.concat_tables([pa.ipc.open_stream(p.as_buffer()).read_all() for p in rows["packed"]]).combine_chunks()
        known = table["id"].combine_chunks().dictionary_encode()
        ids = np.unique(np.array(known.dictionary.to_pylist()), return_inverse=True)[1][known.indices.to_numpy()]
        prefix, other = table["prefix"].to_numpy(), table["other"].to_numpy()
        order = np.lexsort((ids, other, prefix))
        new = np.ones(len(order), bool)
        new[1:] = (prefix[order][1:] != prefix[order][:-1]) | (other[order][1:] != other[order][:-1])
        head = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
        later = order[ids[order] > ids[order][head]]
        start, tags = table["start"].to_numpy(), table["tag"].to_numpy()
        later = later[np.lexsort((start[later], tags[later], ids[later]))]
        fresh = np.ones(len(later), bool)
        a, b = later[1:], later[:-1]
        fresh[1:] = (ids[a] != ids[b]) | (tags[a] != tags[b]) | (start[a] > start[b] + window)
        begin = np.flatnonzero(fresh)
        last = np.concatenate([begin[1:], [len(later)]])[: len(begin)] - 1
        which = pa.array(later[begin])
        return pa.table(
            {
                "id": table["id"].take(which),
                "tag": table["tag"].take(which),
                "start": table["start"].take(which),
                "end": pa.array((start[later[last]] + window).astype(np.int32)),
            }
        )

    return run


def _cut(names: list[str], text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, places = seq.buffers(batch.column(text_col))
            spans = batch.column("_spans")
            offsets, flat = spans.offsets.to_numpy(), spans.values
            begins, ends = flat.field("start").to_numpy(), flat.field("end").to_numpy()
            kept, removed, lists = [], [], []
            for i, (a, b) in enumerate(zip(places[:-1].tolist(), places[1:].tolist(), strict=True)):
                x, y = merge_spans(begins[offsets[i] : offsets[i + 1]], ends[offsets[i] : offsets[i + 1]])
                text = data[a:b].tobytes()
                edges = [0, *np.stack([x, y], 1).ravel().tolist(), len(text)]
                kept.append(b"".join(text[p:q] for p, q in zip(edges[::2], edges[1::2], strict=True)))
                removed.append(int((y - x).sum()))
                lists.append([{"start": p, "end": q} for p, q in zip(x.tolist(), y.tolist(), strict=True)])
            columns = [
                pa.array(np.diff(places)),
                pa.array(removed, pa.int64()),
                pa.array(lists, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                pa.array(kept, pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *columns], [*names, *_ADDED])

    return run


_ADDED = ("n_bytes", "n_removed", "removed", "kept_bytes")


def remove_repeated_bytes(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """Find each byte that lies in ``window`` bytes which also start earlier: in a
    document with a smaller id, or before in the same document.

    Returns the columns of ``docs`` and ``n_bytes``, ``n_removed``, ``removed`` (spans
    of byte places, end left out, maximal) and ``kept_bytes``, what is left, which
    may cut a character; columns of these names in ``docs`` are replaced. Matches
    do not cross documents. A null text is empty; a text shorter than the window is
    kept. Rows that repeat an id count as one document with that id: they do not
    remove from each other. Rows without an id are kept whole and remove nothing.
    An empty table gives an empty table.
    """
    if not 0 < anchor <= window:
        raise ValueError("the anchor must be within the window")
    rest = [c for c in docs.columns if c not in _ADDED]
    docs = docs.select(*(f"`{c}`" for c in rest))
    texts = tagged(docs, id_col, text_col).where("id IS NOT NULL")
    id_type = texts.schema["id"].dataType.simpleString()
    keyed = f"id {id_type}, tag int"
    runs = texts.mapInArrow(_runs(window, anchor), f"{keyed}, {_RUN}")
    met = runs.withColumn("met", F.count("*").over(Window.partitionBy("route")))
    repeated = stored(met.where("known OR met > 1").drop("route", "known", "met"), "repeated-runs")
    across = repeated.where("NOT within")
    # What is joined back is stored, as Spark splits a skewed join only of plain inputs.
    first = stored(across.groupBy("anchor", "path").agg(F.min("id").alias("first")), "first-runs")
    branching = stored(
        across.groupBy("anchor").agg((F.min("path") != F.max("path")).alias("branches"), (F.count("*") > HOT).alias("hot"))
        .where("branches").select("anchor", "hot"),
        "branching",
    )
    placed = across.join(first, ["anchor", "path"])
    span = F.expr(f"start + n + {window - 1}").alias("end")
    later = placed.where("id > first").select("id", "tag", "start", span)
    within = repeated.where("within").select("id", "tag", "start", span)
    reps = placed.where("id = first").select("id", "tag", "anchor", "start", "n").join(branching, "anchor")
    lists = reps.groupBy("id", "tag").agg(F.collect_list(F.struct("start", "n", "anchor", "hot")).alias("runs"))
    opened = stored(
        texts.join(lists, ["id", "tag"]).mapInArrow(
            _opened(window), f"{keyed}, anchor bigint, hot boolean, start int, bytes binary"
        ),
        "opened-runs",
    )
    groups = max(1, opened.count() // GROUP_RUNS)
    dealt = F.pmod(F.when(F.col("hot"), F.xxhash64("anchor", "id")).otherwise(F.xxhash64("anchor")), F.lit(groups))
    factors = opened.withColumn("group", dealt).groupBy("group").applyInArrow(
        _factors(window, groups), f"{keyed}, start int, end int, bucket bigint, packed binary"
    )
    factors = stored(factors, "factors")
    in_groups = factors.where("packed IS NULL").select("id", "tag", "start", "end")
    warm = factors.where("packed IS NOT NULL").select("bucket", "packed")
    by_suffix = warm.groupBy("bucket").applyInArrow(_first_of_all(window), f"{keyed}, start int, end int")
    removed = (
        later.unionByName(within).unionByName(in_groups).unionByName(by_suffix)
        .groupBy(F.col("id").alias("_id"), F.col("tag").alias("_tag"))
        .agg(F.collect_list(F.struct("start", "end")).alias("_spans"))
    )
    keyed_docs = docs.withColumn("_tag0", tag(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))))
    joined = keyed_docs.join(removed, (keyed_docs[id_col] == removed["_id"]) & (keyed_docs["_tag0"] == removed["_tag"]), "left").select(
        *(keyed_docs[c] for c in rest), F.coalesce("_spans", F.expr("cast(array() AS array<struct<start:int,end:int>>)")).alias("_spans")
    )
    more = T.StructType.fromDDL("n_bytes bigint, n_removed bigint, removed array<struct<start:int,end:int>>, kept_bytes binary")
    return joined.mapInArrow(_cut(rest, text_col), T.StructType([*docs.schema.fields, *more.fields]))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that are left when later copies of 100-byte strings go."""
    left = remove_repeated_bytes(documents(spark, sf_dir).select("doc_id", "text"))
    return left.select(
        "doc_id", "n_bytes", "n_removed", F.size("removed").cast("long").alias("n_spans"), F.sha2("kept_bytes", 256).alias("kept_sha256")
    )


QUERIES = {"op9_suffix_dedup": op9_suffix_dedup}
ORACLE: dict[str, str] = {}
