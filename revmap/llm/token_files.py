"""Token ids in files of directly addressable codes.

An id is cut into chunks of 8 bits, least first. Level 0 of a file holds the first
chunk of every id, level 1 the second chunk of the ids that have one, and so on. A
bitmap beside each level says which of its ids go on, and a directory holds the
number of such ids before each block of the bitmap. The place of an id's next chunk
is then one rank query, so any token is read without decoding what lies before it.

A text is encoded in units. They end where white space follows something else, where a
stop follows a letter, and after a single line break: the pre-tokeniser of a byte-level
vocabulary never joins the two sides. Each distinct unit of a block goes
through the tokenizers library once.
"""

from __future__ import annotations

import json
import os
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from revmap.llm import sequences as seq
from revmap.llm.store import documents, stored
from revmap.session import scratch_dir

VOCABULARY = "byte_bpe_50k.json"
#: The id after the last token of each document.
END_ID = 2
#: A vocabulary file is broadcast; a larger one is refused.
MAX_VOCABULARY_BYTES = 64 << 20
#: Bytes of text that are encoded at once; a longer text is worked on in pieces.
BLOCK_BYTES = 8 << 20
#: A file is closed once it has so many ids; a document is never divided.
FILE_TOKENS = 2 << 20
#: Bytes of text for one task.
TASK_BYTES = 16 << 20

_MAGIC = b"DACTOK1\0"
_CHUNK = 8
#: Bits of a bitmap that one entry of its directory stands for.
_RANK_BITS = 512
#: Bytes of units that the library encodes as one text.
_JOINED = 1 << 16
#: Bytes that surely end no white space: printable ASCII, and some beyond.
_ENDS = np.zeros(256, bool)
_ENDS[0x21:0x7F] = True
_ENDS[0x80:] = True
_ENDS[[*range(0x80, 0x8B), 0x9F, 0xA0, 0xA8, 0xA9, 0xAF]] = False
#: Bytes that surely start no white space.
_STARTS = np.zeros(256, bool)
_STARTS[[*range(0x21, 0x7F), 0xC3]] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_MARK = np.zeros(256, bool)
_MARK[list(b".,;:!?")] = True


class UnitEncoder:
    """Encodes texts with the tokenizers library, each distinct unit of a block once."""

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self._library = Tokenizer.from_str(vocabulary)
        self._library.encode_special_tokens = True  # their strings in a text are ordinary text
        tokens = self._library.get_vocab(with_added_tokens=False)
        self._bytes_of = np.zeros(max(tokens.values()) + 1, np.int64)
        for token, number in tokens.items():
            self._bytes_of[number] = len(token)  # a byte is one character of a token

    def _encode(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        for text in texts:  # one by one: what the library keeps for a token is far larger than its id
            yield np.array(self._library.encode_batch_fast([text.decode("utf-8", "replace")], add_special_tokens=False)[0].ids, np.int32)

    def _encode_units(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids of some units, and where each unit's ids start and end.

        Units that start with one space, and units that start with no white space and
        are put behind a line break, are encoded one after the other and told apart by
        the bytes of their ids; the others, which are few, each by itself.
        """
        start, size = offsets[:-1], np.diff(offsets)
        head = data[start]
        second = data[np.minimum(start + 1, len(data) - 1)]
        ends = _ends_at(data, offsets[1:] - 1) & (size > 0)
        spaced = ends & (head == 0x20) & (size > 1) & _STARTS[second]
        plain = ends & _STARTS[head]
        together = np.flatnonzero(spaced | plain)
        first, last, blocks, done = np.zeros(len(start), np.int64), np.zeros(len(start), np.int64), [], 0
        lead = plain[together].astype(np.int64)
        length = size[together] + lead
        stop = np.cumsum(length)
        joined = np.full(stop[-1] if len(stop) else 0, 0x0A, np.uint8)
        at = _ranges(stop - size[together], size[together])
        joined[at] = data[_ranges(start[together], size[together])]
        alone = [np.flatnonzero(~(spaced | plain))]
        cuts = np.unique(np.searchsorted(stop, np.arange(_JOINED, len(joined) + _JOINED, _JOINED), "left").clip(max=len(stop) - 1)) + 1
        pieces = list(zip(np.concatenate([[0], cuts[:-1]]).tolist(), cuts.tolist(), strict=True)) if len(stop) else []
        texts = [joined[stop[a] - length[a] : stop[b - 1]].tobytes() for a, b in pieces]
        for (a, b), ids in zip(pieces, self._encode(texts), strict=True):
            reach = np.cumsum(self._bytes_of[ids])
            wanted = stop[a:b] - (stop[a] - length[a])
            to = np.searchsorted(reach, wanted) + 1
            if not len(reach) or reach[-1] != wanted[-1] or not np.array_equal(reach[to - 1], wanted):
                alone.append(together[a:b])  # bytes that are no UTF-8
                continue
            blocks.append(ids)
            first[together[a:b]] = done + np.concatenate([[0], to[:-1]]) + lead[a:b]
            last[together[a:b]] = done + to
            done += len(ids)
        rest = np.concatenate(alone)
        for i, ids in zip(rest, self._encode([data[offsets[i] : offsets[i + 1]].tobytes() for i in rest]), strict=True):
            blocks.append(ids)
            first[i], last[i] = done, done + len(ids)
            done += len(ids)
        return np.concatenate(blocks) if blocks else np.zeros(0, np.int32), first, last

    def encode(self, data: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts of a buffer, and where each text's ids start (one more entry than texts)."""
        blocks, counts = [], np.zeros(len(places) - 1, np.int64)
        for cuts in _units(data, places):
            units = pa.Array.from_buffers(
                pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(cuts - cuts[0]), pa.py_buffer(data[cuts[0] : cuts[-1]])]
            ).dictionary_encode()
            number = np.asarray(units.indices)
            ids, first, last = self._encode_units(*seq.buffers(units.dictionary))
            length = (last - first)[number]
            blocks.append(ids[_ranges(first[number], length)])
            text = np.searchsorted(places, cuts[:-1], "right") - 1
            counts += np.bincount(text, weights=length, minlength=len(counts)).astype(np.int64)
        starts = np.concatenate([[0], np.cumsum(counts)])
        return np.concatenate(blocks) if blocks else np.zeros(0, np.int32), starts


def _ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each pair, one after the other."""
    ends = np.cumsum(length)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - length), length)


def _ends_at(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the characters whose last bytes are at these places are surely no white space."""
    at = np.maximum(at, 0)
    return _ENDS[data[at]] | ((data[at] >= 0x80) & (data[np.maximum(at - 1, 0)] == 0xC3))


def _units(data: np.ndarray, places: np.ndarray) -> Iterator[np.ndarray]:
    """The cuts around units, some BLOCK_BYTES at a time."""
    at, n, size = int(places[0]), int(places[-1]), BLOCK_BYTES
    while at < n:
        end = min(at + size, n)
        block = data[at:end]
        mark = np.zeros(len(block) + 1, bool)
        before, after = block[:-1], block[1:]
        solid = _ENDS[before]
        # Letters of two bytes from U+00C0 on end in any byte.
        solid[1:] |= (before[1:] >= 0x80) & (before[:-1] == 0xC3)
        # A line break is a unit if it is all the white space there is.
        broken = (before == 0x0A) & _STARTS[after]
        broken[1:] &= solid[:-1]
        broken[:1] = False
        mark[1:-1] = (solid & seq.IS_SPACE[after]) | (_LETTER[before] & _MARK[after]) | broken
        mark[places[(places > at) & (places < end)] - at] = True
        if end < n:
            cuts = np.flatnonzero(mark)
            if not len(cuts):
                size *= 2  # one unit is larger than the block
                continue
            end = at + int(cuts[-1])
        else:
            mark[-1] = True
            cuts = np.flatnonzero(mark)
        yield np.concatenate([[at], at + cuts]).astype(np.int64)
        at, size = end, BLOCK_BYTES


class TokenFile:
    """One file: ``data`` is anything with a buffer, such as bytes or a memory map."""

    def __init__(self, data):
        view = memoryview(data)
        if bytes(view[:8]) != _MAGIC:
            raise ValueError("not a file of directly addressable codes")
        levels, self.n_tokens, self.n_docs = (int(x) for x in np.frombuffer(view, "<u8", 3, 8))
        sizes = np.frombuffer(view, "<u8", levels, 32).astype(np.int64)
        at, self._levels = 32 + 8 * levels, []
        for n in sizes:
            words, entries = -(-int(n) // 64), -(-int(n) // _RANK_BITS)
            chunks = np.frombuffer(view, np.uint8, int(n), at)
            at += -(-int(n) // 8) * 8
            bitmap = np.frombuffer(view, np.uint8, 8 * words, at)
            at += 8 * words
            ranks = np.frombuffer(view, "<u8", entries, at)
            at += 8 * entries
            self._levels.append((chunks, bitmap, ranks))
        self.ends = np.frombuffer(view, "<u8", self.n_docs, at).astype(np.int64)
        at += 8 * self.n_docs
        id_ends = np.frombuffer(view, "<i8", self.n_docs, at)
        at += 8 * self.n_docs
        self._id_ends, self._id_bytes = id_ends, view[at:]

    def token(self, i: int) -> int:
        """Token ``i`` of the file; touches one chunk, one bit and one rank a level."""
        if not 0 <= i < self.n_tokens:
            raise IndexError(i)
        return int(self.gather(np.array([i]))[0])

    def gather(self, places: np.ndarray) -> np.ndarray:
        """The tokens at any places, in that order."""
        places = np.asarray(places, np.int64)
        out, alive = np.zeros(len(places), np.uint32), np.arange(len(places))
        for level, (chunks, bitmap, ranks) in enumerate(self._levels):
            out[alive] |= chunks[places].astype(np.uint32) << np.uint32(_CHUNK * level)
            more = (bitmap[places >> 3] >> (places & 7).astype(np.uint8)) & 1 == 1
            alive, places = alive[more], places[more]
            if not len(places):
                break
            places = _rank(bitmap, ranks, places)
        return out

    def tokens(self, start: int = 0, stop: int | None = None) -> np.ndarray:
        """Tokens ``start`` to ``stop`` (left out): one rank a level, then slices."""
        stop = self.n_tokens if stop is None else stop
        out, alive = np.zeros(max(stop - start, 0), np.uint32), None
        for level, (chunks, bitmap, ranks) in enumerate(self._levels):
            if start >= stop:
                break
            part = chunks[start:stop].astype(np.uint32) << np.uint32(_CHUNK * level)
            bits = np.unpackbits(bitmap[start >> 3 : (stop + 7) >> 3], bitorder="little")[start & 7 :][: stop - start]
            if alive is None:
                out |= part
                alive = np.flatnonzero(bits)
            else:
                out[alive] |= part
                alive = alive[bits == 1]
            first = int(_rank(bitmap, ranks, np.array([start]))[0])
            start, stop = first, first + int(bits.sum())
        return out

    def document(self, i: int) -> np.ndarray:
        """The tokens of document ``i`` of the file."""
        return self.tokens(int(self.ends[i - 1]) if i else 0, int(self.ends[i]))

    def ids(self) -> list[str | None]:
        """The id of each document, as text."""
        out, start = [], 0
        for end in self._id_ends.tolist():
            out.append(None if end < 0 else bytes(self._id_bytes[start:end]).decode())
            start = start if end < 0 else end
        return out


def _rank(bitmap: np.ndarray, ranks: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The number of set bits before each place: the directory, and at most one block of the bitmap."""
    block = places // _RANK_BITS
    words = bitmap.view("<u8")
    base = block * (_RANK_BITS // 64)
    found = ranks[np.minimum(block, len(ranks) - 1)].astype(np.int64)
    last = places >> 6
    for k in range(_RANK_BITS // 64):
        word = base + k
        whole = word < last
        found[whole] += np.bitwise_count(words[word[whole]])
    inside = places & 63
    part = inside > 0
    mask = (np.uint64(1) << inside[part].astype(np.uint64)) - np.uint64(1)
    found[part] += np.bitwise_count(words[last[part]] & mask)
    return found


def file_bytes(tokens: np.ndarray, ends: list[int], ids: list[str | None]) -> bytes:
    """A whole file. Its parts, all little-endian and padded to 8 bytes: magic; number of
    levels, tokens and documents; sizes of the levels; for each level chunks, bitmap and
    directory; ends of documents in tokens; ends of their ids in bytes (-1: null); ids."""
    sizes, levels, rest = [], [], np.asarray(tokens, np.uint32)
    while not sizes or len(rest):
        n = len(rest)
        more = rest >> np.uint32(_CHUNK) > 0
        bits = np.zeros(-(-n // _RANK_BITS) * _RANK_BITS, bool)
        bits[:n] = more
        counts = bits.reshape(-1, _RANK_BITS).sum(axis=1)
        bitmap = np.packbits(bits, bitorder="little")[: -(-n // 64) * 8]
        chunks = np.zeros(-(-n // 8) * 8, np.uint8)
        chunks[:n] = rest & np.uint32(0xFF)
        levels += [chunks.tobytes(), bitmap.tobytes(), (np.cumsum(counts) - counts).astype("<u8").tobytes()]
        sizes.append(n)
        rest = rest[more] >> np.uint32(_CHUNK)
    texts = [None if i is None else i.encode() for i in ids]
    id_ends, end = [], 0
    for text in texts:
        end += len(text or b"")
        id_ends.append(-1 if text is None else end)
    head = np.array([len(sizes), len(tokens), len(ids), *sizes], "<u8").tobytes()
    tail = np.array(ends, "<u8").tobytes() + np.array(id_ends, "<i8").tobytes() + b"".join(t or b"" for t in texts)
    return _MAGIC + head + b"".join(levels) + tail


def _put(folder: str, name: str, data: bytes) -> None:
    """Write a file under another name and move it, so that no reader sees half of it."""
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(folder)
    store.create_dir(path, recursive=True)
    unfinished = f"{path}/_{name}.{uuid.uuid4().hex}"
    with store.open_output_stream(unfinished) as out:
        out.write(data)
    store.move(unfinished, f"{path}/{name}")


_FILES = "task int, file string, n_tokens bigint, n_docs bigint"
_READ = "file string, id string, at bigint, n_tokens bigint, ids_crc32 bigint"


def _writer(folder: str, vocabulary: Broadcast, end_id: int | None):
    """Encode a task's documents, which are in order, and write them to files."""

    def run(batches):
        encoder, task = UnitEncoder(vocabulary.value), TaskContext.get().partitionId()
        tail = np.array([] if end_id is None else [end_id], np.uint32)
        files, ids, tokens, ends = 0, [], [], []

        def close():
            data = file_bytes(np.concatenate(tokens), ends, ids)
            name = f"{task:06d}-{files:06d}.dac"
            _put(folder, name, data)
            return pa.RecordBatch.from_pylist([{"task": task, "file": name, "n_tokens": ends[-1], "n_docs": len(ids)}], schema)

        schema = pa.schema([("task", pa.int32()), ("file", pa.string()), ("n_tokens", pa.int64()), ("n_docs", pa.int64())])
        for batch in batches:
            coded, starts = encoder.encode(*seq.buffers(batch.column("text")))
            for doc_id, a, b in zip(batch.column("id").to_pylist(), starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                ids.append(doc_id)
                tokens.append(np.concatenate([coded[a:b].astype(np.uint32), tail]))
                ends.append((ends[-1] if ends else 0) + len(tokens[-1]))
                if ends[-1] >= FILE_TOKENS:
                    yield close()
                    files, ids, tokens, ends = files + 1, [], [], []
        if ids:
            yield close()

    return run


def _reader(batches):
    for batch in batches:
        for path, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
            file = TokenFile(content.as_buffer())
            tokens, starts = file.tokens().astype("<u4"), np.concatenate([[0], file.ends[:-1]]).astype(np.int64)
            crc = [zlib.crc32(tokens[a:b]) for a, b in zip(starts.tolist(), file.ends.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([path.rsplit("/", 1)[-1]] * file.n_docs, pa.string()),
                    pa.array(file.ids(), pa.string()),
                    pa.array(starts, pa.int64()),
                    pa.array(file.ends - starts, pa.int64()),
                    pa.array(crc, pa.int64()),
                ],
                ["file", "id", "at", "n_tokens", "ids_crc32"],
            )


def write_token_files(
    docs: DataFrame,
    folder: str,
    vocabulary_path: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int | None = END_ID,
) -> DataFrame:
    """Encode all texts and write their ids to ``folder`` in ascending order of ids.

    Returns one row a file in order: ``task``, ``file``, ``n_tokens``, ``n_docs`` and
    ``start``, the number of ids in all files before it. ``folder`` is a path or URI that
    every executor can write to (file, hdfs, s3, gs). Texts are dealt out by ranges of ids,
    then encoded and written where they land: one shuffle, and no ids are stored but in
    the files. A task that is repeated writes the same files again.

    A null text is empty and has the end id only. Rows without an id come first, and
    keep a null as their id; rows that repeat an id are all written, in the order of a
    checksum of their texts. A text of any length is encoded in blocks; one document is
    never divided over files. No documents, no files. Other columns play no part.
    """
    spark = docs.sparkSession
    with open(vocabulary_path, encoding="utf-8") as file:
        vocabulary = file.read(MAX_VOCABULARY_BYTES + 1)
    if len(vocabulary) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{vocabulary_path} is larger than {MAX_VOCABULARY_BYTES} bytes")
    read = json.loads(vocabulary)
    if read.get("normalizer") or read["pre_tokenizer"].get("type") != "ByteLevel" or read["pre_tokenizer"].get("add_prefix_space"):
        raise ValueError(f"{vocabulary_path} is no byte-level vocabulary")
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # Rows that are alike in all are still dealt over tasks.
    order = (F.col("id"), F.col("tie"), F.col("row"))
    rows = rows.withColumns({"tie": F.crc32(F.encode("text", "UTF-8")), "row": F.monotonically_increasing_id()})
    rows = rows.repartitionByRange(1 + size // TASK_BYTES, *order).sortWithinPartitions(*order)
    rows = rows.select(F.col("id").cast("string").alias("id"), "text")
    files = stored(rows.mapInArrow(_writer(folder, spark.sparkContext.broadcast(vocabulary), end_id), _FILES), "token-manifest")
    # Starts in two steps, so that no task has more than the files of one writer, or a row for each writer.
    sums = files.groupBy("task").agg(F.sum("n_tokens").alias("in_task"))
    before = F.sum("in_task").over(Window.orderBy("task")) - F.col("in_task")
    inner = F.sum("n_tokens").over(Window.partitionBy("task").orderBy("file")) - F.col("n_tokens")
    starts = sums.select("task", before.alias("before"))
    return files.join(starts, "task").select("task", "file", "n_tokens", "n_docs", (F.col("before") + inner).alias("start"))


def read_token_files(files: DataFrame, folder: str, id_type: str = "bigint") -> DataFrame:
    """One row a document of the files that ``write_token_files`` listed: ``id``, ``start``
    (ids of all documents before it), ``n_tokens`` and ``ids_crc32`` (crc32 of its ids as
    little-endian unsigned 32-bit integers). Spark lists and reads the files, whole.
    Without files there are no rows."""
    spark = files.sparkSession
    starts = files.select("file", F.col("start").alias("file_start"))
    if files.isEmpty():
        found = spark.createDataFrame([], _READ)
    else:
        binary = spark.read.format("binaryFile").option("pathGlobFilter", "*.dac").load(folder)
        found = binary.select("path", "content").mapInArrow(_reader, _READ)
    rows = found.join(starts, "file")
    return rows.select(
        F.col("id").cast(id_type).alias("id"), (F.col("file_start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"
    )


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the ids of each document lie in the files, and their checksum, read from the files."""
    folder = scratch_dir(spark, "token-files")
    docs = documents(spark, sf_dir).select("doc_id", "text")
    files = stored(write_token_files(docs, folder, public_tokenizers.path(VOCABULARY)), "token-starts")
    return read_token_files(files, folder, docs.schema["doc_id"].dataType.simpleString()).withColumnRenamed("id", "doc_id")


QUERIES = {"op12_token_files": op12_token_files}
#: No SQL: encoding by a vocabulary's ranks. Tested against the tokenizers library.
ORACLE: dict[str, str] = {}
