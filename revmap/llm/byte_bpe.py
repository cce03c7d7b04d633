"""Byte-level BPE on padded matrices.

Texts are split by the pre-tokenising pattern. The distinct pieces that a worker
has not met yet are encoded together: pieces of similar length form a matrix of
token ids with one row a piece, padded on the right. In each round every row
merges its leftmost pair of least rank, found by hashed lookup of all pairs at
once, the row is compacted, and rows without a pair left leave the matrix.
"""

from __future__ import annotations

import base64
import contextlib
import ctypes
import gc
import re
import sys
import uuid
from collections.abc import Iterator
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revmap.llm import sequences as seq
from revmap.llm.store import documents

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: A rank file is broadcast; a larger one is refused.
MAX_VOCABULARY_BYTES = 64 << 20
#: Encoded pieces that a worker keeps for the next text.
KEPT_PIECES = 150_000
#: Cells of a matrix that is merged at once.
CELLS = 1 << 20

_PAD = -1
_NONE = np.int32(2**31 - 1)


def read_ranks(path: str) -> bytes:
    """A rank file (base64 token and rank on each line), as it is."""
    with open(path, "rb") as file:
        data = file.read(MAX_VOCABULARY_BYTES + 1)
    if len(data) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path} is larger than {MAX_VOCABULARY_BYTES} bytes")
    return data


def read_tokens(data: bytes) -> dict[int, bytes]:
    """The bytes of each id of a rank file."""
    lines = (line.split() for line in data.split(b"\n") if line)
    return {int(rank): base64.b64decode(token) for token, rank in lines}


class PairTable:
    """Rank of a pair of token ids, by open addressing."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray):
        self._bits = max(4, int(len(rank) * 4).bit_length())
        self._keys = np.full(1 << self._bits, -1, np.int64)
        self._ranks = np.full(1 << self._bits, _NONE, np.int32)
        keys = left.astype(np.int64) << 32 | right
        slot, todo = self._slot(keys), np.arange(len(keys))
        while len(todo):
            free = todo[self._keys[slot[todo]] == -1]
            self._keys[slot[free]] = keys[free]  # of several for one slot the last stays
            placed = self._keys[slot[todo]] == keys[todo]
            self._ranks[slot[todo[placed]]] = rank[todo[placed]]
            todo = todo[~placed]
            slot[todo] = (slot[todo] + 1) & ((1 << self._bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            spread = keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (spread >> np.uint64(64 - self._bits)).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.int64) << 32 | right.astype(np.int64)
        slot = self._slot(keys)
        found, ranks = self._keys[slot], self._ranks[slot]
        miss = np.nonzero((found != keys) & (found != -1))
        while len(miss[0]):
            again = (slot[miss] + 1) & ((1 << self._bits) - 1)
            slot[miss] = again
            there = self._keys[again]
            ranks[miss] = self._ranks[again]
            miss = tuple(m[(there != keys[miss]) & (there != -1)] for m in miss)
        return np.where(self._keys[slot] == keys, ranks, _NONE)


class Codec:
    """Encodes and decodes with the ranks of one file."""

    def __init__(self, data: bytes, pattern: str):
        self.tokens = read_tokens(data)
        ids = {token: rank for rank, token in self.tokens.items()}
        self._byte = np.array([ids[bytes([b])] for b in range(256)], np.int32)
        pairs = [
            (ids[token[:i]], ids[token[i:]], rank)
            for token, rank in ids.items()
            for i in range(1, len(token))
            if token[:i] in ids and token[i:] in ids
        ]
        left, right, rank = np.array(pairs, np.int64).reshape(-1, 3).T
        self._pairs = PairTable(left, right, rank.astype(np.int32))
        self._pieces: dict[str, tuple[int, ...]] = {}
        self.split = _splitter(pattern)

    def _matrix(self, pieces: list[bytes]) -> list[tuple[int, ...]]:
        """Encode pieces of similar length, one row each."""
        width = max(map(len, pieces))
        rows = np.full((len(pieces), width), _PAD, np.int32)
        for k, piece in enumerate(pieces):
            rows[k, : len(piece)] = self._byte[np.frombuffer(piece, np.uint8)]
        done: list[tuple[int, ...]] = [()] * len(pieces)
        index = np.arange(len(pieces))
        length = np.array([len(p) for p in pieces])
        # Ranks of all neighbours; a merge renews the two around it.
        ranks = self._ranks(rows[:, :-1], rows[:, 1:])
        while len(index):
            if ranks.shape[1]:
                at = ranks.argmin(axis=1)
                best = ranks[np.arange(len(index)), at]
                ready = best == _NONE
            else:
                ready = np.ones(len(index), bool)
            for k in np.flatnonzero(ready):
                done[index[k]] = tuple(rows[k, : length[k]].tolist())
            if ready.all():
                break
            go = ~ready
            index, rows, ranks, at, best, length = index[go], rows[go], ranks[go], at[go], best[go], length[go] - 1
            n, width = np.arange(len(index)), rows.shape[1] - 1
            # Compaction: what stands right of the merged pair moves left by one.
            right = np.arange(width)[None, :] > at[:, None]
            rows = np.where(right, rows[:, 1:], rows[:, :-1])
            rows[n, at] = best
            if width == 1:
                ranks = np.zeros((len(index), 0), np.int32)
                continue
            ranks = np.where(np.arange(width - 1)[None, :] >= at[:, None], ranks[:, 1:], ranks[:, :-1])
            before, after = np.flatnonzero(at > 0), np.flatnonzero(at < width - 1)
            ranks[before, at[before] - 1] = self._ranks(rows[before, at[before] - 1], rows[before, at[before]])
            ranks[after, at[after]] = self._ranks(rows[after, at[after]], rows[after, at[after] + 1])
        return done

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return np.where(right == _PAD, _NONE, self._pairs(np.maximum(left, 0), np.maximum(right, 0)))

    def _long(self, piece: bytes) -> tuple[int, ...]:
        """One long piece as a linked row: many merges of one row at its end would
        each move the whole row, so here only the neighbours of a merge change. The
        merges are the same, leftmost of least rank first."""
        import heapq

        ids: list[int] = self._byte[np.frombuffer(piece, np.uint8)].tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        first = self._pairs(np.array(ids[:-1]), np.array(ids[1:]))
        known: dict[tuple[int, int], int] = {}

        def rank(x: int, y: int) -> int:
            if (x, y) not in known:
                known[x, y] = int(self._pairs(np.array([x]), np.array([y]))[0])
            return known[x, y]

        heap = [(r, k, ids[k], ids[k + 1]) for k, r in enumerate(first.tolist()) if r != _NONE]
        heapq.heapify(heap)
        while heap:
            r, k, x, y = heapq.heappop(heap)
            j = after[k]
            if ids[k] != x or j >= n or ids[j] != y:
                continue
            ids[k], ids[j] = r, -1
            after[k] = after[j]
            if after[j] < n:
                before[after[j]] = k
            for a, b in ((before[k], k), (k, after[k])):
                if a >= 0 and b < n and (new := rank(ids[a], ids[b])) != _NONE:
                    heapq.heappush(heap, (new, a, ids[a], ids[b]))
        return tuple(i for i in ids if i >= 0)

    def learn(self, pieces: set[str]) -> None:
        """Encode pieces in buckets by length and keep the result."""
        todo = sorted((p.encode() for p in pieces - self._pieces.keys()), key=len)
        at = 0
        while at < len(todo):
            limit = max(8, len(todo[at]) * 3 // 2)
            end = at
            while end < len(todo) and len(todo[end]) <= limit and (end - at) * limit < CELLS:
                end += 1
            part = todo[at:end]
            encoded = self._matrix(part) if limit <= 512 else [self._long(p) for p in part]
            self._pieces.update(zip((p.decode() for p in part), encoded, strict=True))
            at = end

    def _split(self, texts: list[str]) -> list[list[str]]:
        """Pieces of the texts, all of them encoded."""
        if len(self._pieces) > KEPT_PIECES:
            self._pieces.clear()
        split = [self.split(t) for t in texts]
        self.learn(set(chain.from_iterable(split)))
        return split

    def forget(self) -> None:
        self._pieces.clear()

    def encode(self, texts: list[str]) -> list[list[int]]:
        get = self._pieces.__getitem__
        return [list(chain.from_iterable(map(get, pieces))) for pieces in self._split(texts)]

    def count(self, texts: list[str]) -> list[int]:
        get = self._pieces.__getitem__
        return [sum(map(len, map(get, pieces))) for pieces in self._split(texts)]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


def _splitter(pattern: str):
    """Matches of the pattern in a text. The standard ``re`` is faster than
    ``regex`` but has no Unicode classes: it takes the texts in whose characters the
    two agree, if the pattern is the usual one."""
    slow = regex.compile(pattern).findall
    if pattern != public_tokenizers.PATTERN:
        return slow
    every = "".join(chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000)
    letters, numbers, spaces = (set(regex.findall(p, every)) for p in (r"\p{L}", r"\p{N}", r"\s"))
    plain = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+").findall
    as_letter, as_number, as_space = (set(re.findall(p, every)) for p in (r"[^\W\d_]", r"\d", r"\s"))
    other = (letters ^ as_letter) | (numbers ^ as_number) | (spaces ^ as_space)
    ascii_other = re.compile("[" + re.escape("".join(c for c in sorted(other) if c < "\x80")) + "]").search

    def split(text: str) -> list[str]:
        agree = not ascii_other(text) if text.isascii() else other.isdisjoint(text)
        return plain(text) if agree else slow(text)

    return split


_codecs: dict[str, Codec] = {}


def _codec(ranks: Broadcast, pattern: str) -> Codec:
    name, data = ranks.value
    if name not in _codecs:
        _codecs.clear()
        _codecs[name] = Codec(data, pattern)
    return _codecs[name]


def _released(codec: Codec) -> None:
    """What a task has learnt goes with it: the worker stays, and other work needs the memory."""
    codec.forget()
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries do so by themselves
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def _encode(ranks: Broadcast, pattern: str, text_col: str, names: list[str], ids_col: str, bytes_col: str | None = None):
    """Ids of the texts; with ``bytes_col`` also what they decode to, in the same worker."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(ranks, pattern)
        for batch in batches:
            _, places = seq.buffers(batch.column(text_col))
            at = 0
            while at < len(batch):
                end = max(at + 1, int(np.searchsorted(places, places[at] + seq.PART_BYTES * 4, "right")) - 1)
                part = batch.slice(at, end - at)
                encoded = codec.encode([t or "" for t in part.column(text_col).to_pylist()])
                offsets = np.zeros(len(encoded) + 1, np.int32)
                np.cumsum([len(x) for x in encoded], out=offsets[1:])
                values = np.fromiter(chain.from_iterable(encoded), np.int32, int(offsets[-1]))
                columns, added = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))], [ids_col]
                if bytes_col is not None:
                    columns.append(pa.array([codec.decode(x) for x in encoded], pa.binary()))
                    added.append(bytes_col)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), *columns], [*names, *added])
                at = end
        _released(codec)

    return run


def _decode(ranks: Broadcast, ids_col: str, names: list[str], bytes_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = read_tokens(ranks.value[1])
        for batch in batches:
            lists = batch.column(ids_col)
            values, offsets = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_pylist()
            data = [b"".join(map(tokens.__getitem__, values[a:b].tolist())) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(data, pa.binary())], [*names, bytes_col])

    return run


def _count(ranks: Broadcast, pattern: str, text_col: str, names: list[str], count_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(ranks, pattern)
        for batch in batches:
            _, places = seq.buffers(batch.column(text_col))
            at, counts = 0, []
            while at < len(batch):
                end = max(at + 1, int(np.searchsorted(places, places[at] + seq.PART_BYTES * 4, "right")) - 1)
                counts += codec.count([t or "" for t in batch.column(text_col).slice(at, end - at).to_pylist()])
                at = end
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(counts, pa.int64())], [*names, count_col])
        _released(codec)

    return run


class Tokenizer:
    """Encoding and decoding columns with a rank file that the driver reads."""

    def __init__(self, spark: SparkSession, path: str, pattern: str = public_tokenizers.PATTERN):
        self._ranks = spark.sparkContext.broadcast((uuid.uuid4().hex, read_ranks(path)))
        self._pattern = pattern

    def encode(self, df: DataFrame, *, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
        """Add ``ids_col``, the token ids of the whole text; a null text has none.
        Matches of the pattern are encoded apart, strings of special tokens are
        ordinary text. A column of that name is replaced. Rows that repeat are each
        encoded; an empty table stays empty."""
        return self._map(df, {ids_col: T.ArrayType(T.IntegerType())}, lambda names: _encode(self._ranks, self._pattern, text_col, names, ids_col))

    def round_trip(self, df: DataFrame, *, text_col: str = "text", ids_col: str = "ids", bytes_col: str = "decoded") -> DataFrame:
        """:meth:`encode` and :meth:`decode` in one pass over the texts."""
        kinds = {ids_col: T.ArrayType(T.IntegerType()), bytes_col: T.BinaryType()}
        return self._map(df, kinds, lambda names: _encode(self._ranks, self._pattern, text_col, names, ids_col, bytes_col))

    def decode(self, df: DataFrame, *, ids_col: str = "ids", bytes_col: str = "decoded") -> DataFrame:
        """Add ``bytes_col``, the bytes that ids stand for. They are UTF-8 if the ids
        come from a text; a cut list of ids may end within a character. Null ids
        have no bytes; an id outside the vocabulary is an error."""
        known = df.withColumn(ids_col, F.coalesce(ids_col, F.expr("cast(array() AS array<int>)")))
        return self._map(known, {bytes_col: T.BinaryType()}, lambda names: _decode(self._ranks, ids_col, names, bytes_col))

    def count(self, df: DataFrame, *, text_col: str = "text", count_col: str = "n_tokens") -> DataFrame:
        """Add ``count_col``, the number of ids that :meth:`encode` would give."""
        return self._map(df, {count_col: T.LongType()}, lambda names: _count(self._ranks, self._pattern, text_col, names, count_col))

    def _map(self, df: DataFrame, added: dict[str, T.DataType], function) -> DataFrame:
        names = [c for c in df.columns if c not in added]
        df = df.select(*(f"`{c}`" for c in names))
        return df.mapInArrow(function(names), T.StructType([*df.schema.fields, *(T.StructField(c, kind) for c, kind in added.items())]))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, and what they decode to."""
    tokenizer = Tokenizer(spark, public_tokenizers.path(VOCABULARY))
    decoded = tokenizer.round_trip(documents(spark, sf_dir).select("doc_id", "text"))
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.encode(F.concat_ws(",", F.col("ids").cast("array<string>")), "UTF-8"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


QUERIES = {"op3_byte_bpe": op3_byte_bpe}
ORACLE: dict[str, str] = {}
