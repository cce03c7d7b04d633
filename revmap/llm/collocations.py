"""Phrases whose words go together, the best of each language, by best-first growth.

Words and pairs of words are counted once. A pair is the prefix of phrases of three
words, and bounds them: with a = f(xyz) at most f(xy) and f(yz), the score over the
first cut, a * a / (f(x) * f(yz)), is at most f(xy) / f(x). Pairs are grown in the
order of this bound, so many at a time for each language. One reading of the texts
counts the phrases of three words that start or end with a grown pair. A language is
settled once its 2000th surviving phrase is above the bound of every pair that has
not been grown: no phrase left can reach it, not even as a tie.

Which pairs are grown is sent to the tasks as a bit field of a fixed size. What else
meets a set bit is counted as well and drops out when the counts are joined.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from revmap.llm import sequences as seq
from revmap.llm.store import documents, stored

TOP = 2_000
MIN_COUNT = 10
#: A phrase goes if a longer one around it has this share (in hundredths) of its occurrences.
ABSORBED = 50
#: Language of texts that name none.
NO_LANG = "und"
#: Pairs that are grown first, in phrases to return; then GROWTH times as many, and so on.
FRONTIER = 8
GROWTH = 8
#: Bits of the field of grown pairs: 4 MB whatever the size of the tables.
FIELD_BITS = 25
_CHUNK_BITS = 19
#: Bytes of text that are counted at once; a longer text is worked on in blocks.
BLOCK_BYTES = 1 << 20
#: Bytes of counts that a task adds up before they are packed and sent.
HELD_BYTES = 8 << 20
#: Bytes of text for one bucket, whose counts are added up at once. A task sends a frequent
#: pair once for HELD_BYTES, so no bucket grows with a pair's frequency.
BUCKET_BYTES = 8 << 20

_BREAK = np.zeros(256, bool)
_BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_APART = _BREAK.copy()
_APART[[0x20, 0x09]] = True

_WORDS = pa.schema([("lang", pa.string()), ("w1", pa.string()), ("w2", pa.string()), ("n", pa.int64())])
_TRIPLES = pa.schema([("lang", pa.string()), ("w1", pa.string()), ("w2", pa.string()), ("w3", pa.string()), ("n", pa.int64())])


class _Block:
    """Words of some texts. ``old`` words at the start were counted with the block before."""

    def __init__(self, data: np.ndarray, places: np.ndarray, langs: np.ndarray, old: int):
        data = seq.LOWER[data]
        inside = np.zeros(len(data) + 2, bool)
        inside[1:-1] = ~_APART[data]
        starts, ends = inside[1:-1] & ~inside[:-2], inside[1:-1] & ~inside[2:]
        inner = places[(places > 0) & (places < len(data))]
        starts[inner] |= inside[1:-1][inner]
        ends[inner - 1] |= inside[1:-1][inner - 1]
        start, end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
        offsets = np.concatenate([[0], np.cumsum(end - start)]).astype(np.int64)
        column = pa.Array.from_buffers(
            pa.large_string(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside[1:-1]])]
        ).dictionary_encode()
        self.words = column.dictionary
        #: Number of each word, of its text's language, and whether it was not counted before.
        self.number = np.asarray(column.indices).astype(np.int64)
        text = np.searchsorted(places, start, "right") - 1
        self.lang = langs[text]
        self.new = np.arange(len(start)) >= old
        pieces = np.cumsum(_BREAK[data])[start] if len(start) else start
        #: Whether a word and the next are in one piece.
        self.linked = (text[1:] == text[:-1]) & (pieces[1:] == pieces[:-1])

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """The places of pairs, and a number that is the same for equal pairs of a language."""
        at = np.flatnonzero(self.linked)
        return at, (self.lang[at] * len(self.words) + self.number[at]) * len(self.words) + self.number[at + 1]


def _blocks(data: np.ndarray, places: np.ndarray, langs: np.ndarray) -> Iterator[_Block]:
    """All texts of a buffer, some BLOCK_BYTES at a time. A block that starts within a
    text starts with the last two words of the block before."""
    at, n, old, size = int(places[0]), int(places[-1]), 0, BLOCK_BYTES
    while at < n:
        end = min(at + size, n)
        text = int(np.searchsorted(places, end - 1, "right")) - 1
        begin = max(int(places[text]), at)
        if end < n and end < places[text + 1]:
            # The text goes on: end after white space or a stop, with two words at least.
            tail = np.flatnonzero(_APART[data[begin:end]])
            end = begin + int(tail[-1]) + 1 if len(tail) else begin
        first, last = int(np.searchsorted(places, at, "right")) - 1, int(np.searchsorted(places, end, "left"))
        inner = np.clip(places[first : last + 1], at, end) - at
        part = data[at:end]
        carried = 0
        if end < n and end < places[text + 1] and end > begin:
            inside = ~_APART[data[begin:end]]
            heads = np.flatnonzero(inside & ~np.concatenate([[False], inside[:-1]]))
            carried = min(2, len(heads))
            following = begin + int(heads[-carried]) if carried else end
        else:
            following = end
        if end <= at or following <= at:
            size *= 2  # one word, or two with nothing between, are larger than the block
            continue
        yield _Block(part, inner, langs[first:last], old)
        at, old, size = following, carried, BLOCK_BYTES


def _texts(batch: pa.RecordBatch) -> tuple[Iterator[_Block], pa.Array]:
    langs = batch.column(0).fill_null(NO_LANG).dictionary_encode()
    data, places = seq.buffers(batch.column(1))
    return _blocks(data, places, np.asarray(langs.indices).astype(np.int64)), langs.dictionary


def _counted(schema: pa.Schema, names: pa.Array, words: pa.Array, lang, parts, n) -> pa.RecordBatch:
    """Rows of a language's name, words (None: none), and a count."""
    take = lambda w: pa.nulls(len(n), pa.string()) if w is None else words.take(pa.array(w)).cast(pa.string())
    columns = [names.take(pa.array(lang)).cast(pa.string()), *map(take, parts), pa.array(n, pa.int64())]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def _block_counts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Occurrences of words (w2 null), of pairs, and of all words of a language (w1 null as well)."""
    blocks, names = _texts(batch)
    for b in blocks:
        v = max(1, len(b.words))
        key, n = np.unique(b.lang[b.new] * v + b.number[b.new], return_counts=True)
        yield _counted(_WORDS, names, b.words, key // v, (key % v, None), n)
        lang, n = np.unique(b.lang[b.new], return_counts=True)
        yield _counted(_WORDS, names, b.words, lang, (None, None), n)
        at, pair = b.pairs()
        key, n = np.unique(pair[b.new[at + 1]], return_counts=True)
        yield _counted(_WORDS, names, b.words, key // v // v, (key // v % v, key % v), n)


def _summed(parts: list[pa.Table]) -> pa.Table:
    found = pa.concat_tables(parts).group_by(["lang", "w1", "w2"], use_threads=False).aggregate([("n", "sum")])
    return found.rename_columns([c.removesuffix("_sum") for c in found.column_names]).select(_WORDS.names)


def _packed(parts: list[pa.RecordBatch], buckets: int) -> pa.RecordBatch:
    """Counts added up and packed, one row for each bucket of words and pairs."""
    counts = _summed([pa.Table.from_batches([p]) for p in parts]).combine_chunks()
    hashes = [_hashes(counts.column(c).combine_chunks()) for c in ("lang", "w1", "w2")]
    with np.errstate(over="ignore"):
        bucket = (seq.mix(seq.mix(seq.mix(hashes[0]) * np.uint64(7) + hashes[1]) * np.uint64(11) + hashes[2]) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    counts, bucket = counts.take(pa.array(order)).combine_chunks(), bucket[order]
    found, first = np.unique(bucket, return_index=True)
    rows, edges = [], [*first.tolist(), len(bucket)]
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, _WORDS, options=pa.ipc.IpcWriteOptions(compression="lz4")) as out:
            out.write_table(counts.slice(a, b - a))
        rows.append(sink.getvalue().to_pybytes())
    return pa.RecordBatch.from_arrays([pa.array(found), pa.array(rows, pa.binary())], ["bucket", "counts"])


def _count_words(buckets: int):
    def run(batches):
        held, size = [], 0
        for batch in batches:
            for part in _block_counts(batch):
                held.append(part)
                size += part.nbytes
                if size >= HELD_BYTES:
                    yield _packed(held, buckets)
                    held, size = [], 0
        if held:
            yield _packed(held, buckets)

    return run


def _frequent(min_count: int):
    """The counts of a bucket, added up; rare words and pairs go."""

    def run(key, rows):
        counts = _summed([pa.ipc.open_stream(r.as_buffer()).read_all() for r in rows.column("counts")])
        kept = pc.or_(pc.is_null(counts.column("w1")), pc.greater_equal(counts.column("n"), min_count))
        return counts.filter(kept)

    return run


def _bits(lang: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """The bit of a pair, from hashes of its language and words."""
    with np.errstate(over="ignore"):
        h = seq.mix(seq.mix(seq.mix(lang) * np.uint64(3) + first) * np.uint64(5) + second)
    return (h >> np.uint64(64 - FIELD_BITS)).astype(np.int64)


def _hashes(words: pa.Array) -> np.ndarray:
    data, places = seq.buffers(words)
    return seq.word_symbols(data, places[:-1], places[1:])


def _pair_bits(batches):
    for batch in batches:
        bits = np.unique(_bits(*(_hashes(batch.column(k)) for k in range(3))))
        yield pa.RecordBatch.from_arrays([pa.array(bits >> _CHUNK_BITS), pa.array(bits & (1 << _CHUNK_BITS) - 1)], ["chunk", "bit"])


def _chunk(key, rows):
    field = np.zeros(1 << _CHUNK_BITS, bool)
    field[rows.column("bit").to_numpy()] = True
    return pa.table({"chunk": rows.column("chunk")[:1], "field": pa.array([np.packbits(field, bitorder="little").tobytes()], pa.binary())})


def _field(pairs: DataFrame) -> bytes:
    """The bit field of some pairs, put together from chunks that tasks make: 2^FIELD_BITS bits."""
    bits = pairs.select("lang", "w1", "w2").mapInArrow(_pair_bits, "chunk long, bit long").distinct()
    chunks = bits.groupBy("chunk").applyInArrow(_chunk, "chunk long, field binary").collect()
    size = 1 << _CHUNK_BITS - 3
    field = bytearray(size << FIELD_BITS - _CHUNK_BITS)
    for row in chunks:
        field[row.chunk * size : (row.chunk + 1) * size] = row.field
    return bytes(field)


def _count_triples(field: Broadcast):
    """Occurrences of phrases of three words whose first or last two are a grown pair."""

    def run(batches):
        grown = np.frombuffer(field.value, np.uint8)
        for batch in batches:
            blocks, names = _texts(batch)
            langs = _hashes(names)
            for b in blocks:
                v = max(1, len(b.words))
                words = _hashes(b.words)
                at, pair = b.pairs()
                kinds, kind = np.unique(pair, return_inverse=True)
                bit = _bits(langs[kinds // v // v], words[kinds // v % v], words[kinds % v])
                inside = (grown[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1
                of = np.full(len(b.number), -1)
                of[at] = kind
                third = at[b.linked[np.minimum(at + 1, len(b.linked) - 1)] & (at + 2 < len(b.number))] if len(at) else at
                third = third[b.new[third + 2]]
                third = third[inside[of[third]] | inside[of[third + 1]]]
                key, n = np.unique(of[third] * v + b.number[third + 2], return_counts=True)
                front = kinds[key // v]
                yield _counted(_TRIPLES, names, b.words, front // v // v, (front // v % v, front % v, key % v), n)

    return run


def _whole(*factors) -> Column:
    """An exact product."""
    return reduce(lambda a, b: a * b, (F.lit(f).cast("decimal(38,0)") if isinstance(f, int) else F.col(f).cast("decimal(38,0)") for f in factors))


def _score(part: str, rest: str) -> Column:
    """floor(1000000 * a * a / (part * rest)), whatever the size of the numbers."""
    return F.call_function("div", _whole(1_000_000, "a", "a"), _whole(part, rest))


def _leading(phrases: DataFrame, value: str, wanted: int) -> DataFrame:
    """Mark, as ``leads``, phrases of each language with the largest (value, a), about
    ``wanted`` of them and not fewer, if there are so many. The cut lies between levels,
    of which there are some 1,300 at most, so no language is ever sorted whole."""
    top = 1000 + F.floor(8 * F.log2("a"))
    levelled = phrases.withColumn("level", F.when(F.col(value) >= 1_000_000, top).otherwise(F.floor(F.col(value) / 1000)))
    sums = levelled.groupBy("lang", "level").count()
    before = F.sum("count").over(Window.partitionBy("lang").orderBy(F.desc("level"))) - F.col("count")
    reached = sums.select("lang", "level", before.alias("before")).where(F.col("before") < wanted)
    cuts = stored(reached.groupBy("lang").agg(F.min("level").alias("cut")), "cuts")
    return levelled.join(cuts, "lang").withColumn("leads", F.col("level") >= F.col("cut")).drop("level", "cut")


def _best(texts: DataFrame, pairs: DataFrame, words: DataFrame, frontier: int, min_count: int, absorbed: int) -> tuple[DataFrame, DataFrame]:
    """One round: the phrases that survive among those grown, and the largest (bound, a)
    of each language's other pairs."""
    led = stored(_leading(pairs, "bound", frontier), "frontier")
    grown = led.where("leads")
    beyond = led.where("NOT leads").groupBy("lang").agg(F.max(F.struct("bound", "a")).alias("beyond"))
    field = texts.sparkSession.sparkContext.broadcast(_field(grown))
    triples = texts.mapInArrow(_count_triples(field), "lang string, w1 string, w2 string, w3 string, n long")
    triples = triples.groupBy("lang", "w1", "w2", "w3").agg(F.sum("n").alias("a")).where(F.col("a") >= min_count)
    pair = lambda x, y, f: pairs.select("lang", F.col("w1").alias(x), F.col("w2").alias(y), F.col("a").alias(f))
    word = lambda x, f: words.select("lang", F.col("w1").alias(x), F.col("n").alias(f))
    triples = stored(triples, "triples")
    scored = (
        triples.join(pair("w1", "w2", "front"), ["lang", "w1", "w2"])
        .join(pair("w2", "w3", "back"), ["lang", "w2", "w3"])
        .join(word("w1", "head"), ["lang", "w1"])
        .join(word("w3", "tail"), ["lang", "w3"])
        .select("*", _score("head", "back").alias("s1"), _score("front", "tail").alias("s2"))
        .select(
            "lang",
            F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"),
            "a",
            F.when(F.col("s1") <= F.col("s2"), F.col("head")).otherwise(F.col("front")).alias("l"),
            F.when(F.col("s1") <= F.col("s2"), F.col("back")).otherwise(F.col("tail")).alias("r"),
            F.least("s1", "s2").alias("score"),
        )
    )
    around = triples.select("lang", "w1", "w2", "a").union(triples.select("lang", "w2", "w3", "a"))
    around = around.groupBy("lang", "w1", "w2").agg(F.max("a").alias("longer"))
    kept = grown.join(around, ["lang", "w1", "w2"], "left").where(F.coalesce(100 * F.col("longer") < absorbed * F.col("a"), F.lit(True)))
    two = kept.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", "l", "r", "score")
    return two.unionByName(scored), beyond


def collocations(
    docs: DataFrame,
    *,
    text_col: str = "text",
    lang_col: str = "lang",
    top: int = TOP,
    min_count: int = MIN_COUNT,
    absorbed: int = ABSORBED,
) -> DataFrame:
    """The ``top`` phrases of two or three words of each language: ``lang``, ``rank``,
    ``phrase``, ``a`` (its occurrences), ``l`` and ``r`` (those of its two parts), ``n``
    (all words of the language) and ``score``.

    Texts are lower-cased (A-Z), split into pieces at stops and line ends, and these into
    words at spaces and tabs; phrases lie within a piece. The score of a cut is floor(10^6 *
    a * a / (l * r)); the cut with the lowest counts, among equals the first. Phrases below
    ``min_count`` occurrences are left out, and so are phrases within a longer one that has
    ``absorbed`` hundredths of their occurrences. Ranks go by score, then occurrences, both
    descending, then by the bytes of the phrase.

    A null text is empty, a null language is ``und``, as is one of that name. Every row
    counts, also one that repeats. Texts of any length are read in blocks. No documents, no
    phrases. Other columns play no part.
    """
    texts = docs.select(F.coalesce(F.col(f"`{lang_col}`"), F.lit(NO_LANG)).alias("lang"), F.col(f"`{text_col}`").alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    packed = texts.mapInArrow(_count_words(1 + size // BUCKET_BYTES), "bucket long, counts binary")
    counted = packed.groupBy("bucket").applyInArrow(_frequent(min_count), "lang string, w1 string, w2 string, n long")
    counted = stored(counted, "words-and-pairs")
    totals = stored(counted.where("w1 IS NULL").select("lang", "n"), "totals")
    words = counted.where("w1 IS NOT NULL AND w2 IS NULL").select("lang", "w1", "n")
    pairs = (
        counted.where("w2 IS NOT NULL")
        .select("lang", "w1", "w2", F.col("n").alias("a"))
        .join(words.select("lang", "w1", F.col("n").alias("l")), ["lang", "w1"])
        .join(words.select("lang", F.col("w1").alias("w2"), F.col("n").alias("r")), ["lang", "w2"])
    )
    bound = F.call_function("div", _whole(1_000_000, "a"), _whole("l"))
    pairs = stored(pairs.select("*", _score("l", "r").alias("score"), bound.alias("bound")), "pairs")
    settled, growing, open_texts, frontier = [], pairs, texts, FRONTIER * top
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    while True:
        survivors, beyond = _best(open_texts, growing, words, frontier, min_count, absorbed)
        leaders = _leading(stored(survivors, "survivors"), "score", top).where("leads").drop("leads")
        ranked = stored(leaders.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top), "phrases")
        beyond = stored(beyond, "beyond")
        safe = ranked.join(beyond, "lang").where(F.struct("score", "a") > F.struct("beyond.bound", "beyond.a")).groupBy("lang").count()
        # Languages with pairs left, and too few phrases above all that these could grow to.
        unsettled = stored(beyond.join(safe.where(F.col("count") >= top), "lang", "left_anti").select("lang"), "unsettled")
        settled.append(ranked.join(unsettled, "lang", "left_anti"))
        if unsettled.isEmpty():
            break
        growing, open_texts = (f.join(unsettled, "lang", "left_semi") for f in (pairs, texts))
        frontier *= GROWTH
    best = reduce(DataFrame.unionByName, settled)
    columns = ("lang", F.col("rank").cast("int").alias("rank"), "phrase", "a", "l", "r", "n", "score")
    return best.join(totals, "lang").select(*columns)


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 best phrases of each language of all documents."""
    return collocations(documents(spark, sf_dir))


QUERIES = {"op11_collocations": op11_collocations}
ORACLE = {
    "op11_collocations": f"""
WITH pieces AS (
  SELECT coalesce(lang, '{NO_LANG}') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
split AS MATERIALIZED (
  SELECT lang, [w FOR w IN regexp_split_to_array(piece, '[ \\t]+') IF w <> ''] AS w FROM pieces),
placed AS MATERIALIZED (
  SELECT lang, w[i] AS w1, w[i + 1] AS w2, w[i + 2] AS w3, len(w) - i AS follow
  FROM (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM split)),
f1 AS MATERIALIZED (SELECT lang, w1, count(*) AS f FROM placed GROUP BY ALL),
f2 AS MATERIALIZED (SELECT lang, w1, w2, count(*) AS f FROM placed WHERE follow >= 1 GROUP BY ALL HAVING f >= {MIN_COUNT}),
f3 AS MATERIALIZED (SELECT lang, w1, w2, w3, count(*) AS f FROM placed WHERE follow >= 2 GROUP BY ALL HAVING f >= {MIN_COUNT}),
cuts AS (
  SELECT p.lang, p.w1 || ' ' || p.w2 AS phrase, p.f AS a, 1 AS k, x.f AS l, y.f AS r
  FROM f2 p JOIN f1 x ON (p.lang, p.w1) = (x.lang, x.w1) JOIN f1 y ON (p.lang, p.w2) = (y.lang, y.w1)
  WHERE NOT EXISTS (SELECT 1 FROM f3 t WHERE t.lang = p.lang AND t.w1 = p.w1 AND t.w2 = p.w2 AND 100 * t.f >= {ABSORBED} * p.f)
    AND NOT EXISTS (SELECT 1 FROM f3 t WHERE t.lang = p.lang AND t.w2 = p.w1 AND t.w3 = p.w2 AND 100 * t.f >= {ABSORBED} * p.f)
  UNION ALL
  SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.f, 1, x.f, y.f
  FROM f3 t JOIN f1 x ON (t.lang, t.w1) = (x.lang, x.w1) JOIN f2 y ON (t.lang, t.w2, t.w3) = (y.lang, y.w1, y.w2)
  UNION ALL
  SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.f, 2, x.f, y.f
  FROM f3 t JOIN f2 x ON (t.lang, t.w1, t.w2) = (x.lang, x.w1, x.w2) JOIN f1 y ON (t.lang, t.w3) = (y.lang, y.w1)),
scored AS (
  SELECT lang, phrase, a, l, r, (1000000::HUGEINT * a * a // (l::HUGEINT * r))::BIGINT AS score FROM cuts
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, (row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase))::INTEGER AS rank,
  phrase, a, l, r, n, score
FROM scored JOIN (SELECT lang, count(*) AS n FROM placed GROUP BY lang) USING (lang)
QUALIFY rank <= {TOP}
"""
}
