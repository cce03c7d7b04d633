"""Toxicity behind disguises: a noisy channel, decoded by Viterbi, then a lexicon score.

Writers hide words by leetspeak (``1d10t``), spacing (``i d i o t``) and repetition
(``looooser``). A suspicious stretch is a lattice: a character stands for itself,
for the letters it looks like, or (a repeated letter, what separates letters) for
nothing. A character trigram model counted over all documents weighs the paths,
and Viterbi finds the best. Two scans find stretches. The first needs no lexicon,
and the lexicon is learnt from what it reads: single letters with separators,
look-alikes within words, letters three times in a row. The second knows the
lexicon and takes every stretch that some path turns into an entry: words cut in
pieces, any separators, doubled letters, symbols only. There the language model is
a mixture of the trigrams and, with a small share, the entries, so a stretch is
read as an entry unless the trigrams have a likelier path. Elsewhere texts are left
as they are.

The score of the restored text comes from words and word beginnings that are much
more frequent under label 1, and from a logistic regression over what of them a
document holds.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revmap.llm import sequences as seq
from revmap.llm.sample import held_out, labelled_sample
from revmap.llm.store import documents, stored

#: Labelled documents that are learnt from, about.
SAMPLE_ROWS = 12_000
#: Entries of the lexicon at most.
LEXICON = 4_096
#: A lexicon entry is in so many documents of label 1 at least, and so much more
#: frequent there (log). Besides, its frequency there is no chance: of all words and
#: beginnings that are looked at, about one passes if none has to do with the label.
LEAST_DOCS, LEAST_WEIGHT = 3, 2.0
THRESHOLD = 0.3
#: Word beginnings of these lengths are features besides whole words.
BEGINNINGS = (4, 5, 6)

# What a character may stand for besides itself, and costs (negative logs) of the channel.
LOOKS_LIKE = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t",
}
COST_LOOKS_LIKE, COST_SYMBOL, COST_DROP_REPEATED, COST_DROP_SPACE = 1.0, 4.0, 1.5, 0.5
#: A separator between pieces of two characters or more, as two usual words have it.
COST_JOIN = 4.0
#: What a word of the lexicon and a beginning cost in the mixture, instead of their trigrams.
COST_ENTRY, COST_BEGINNING = 9.0, 13.0

_LEET = "".join(LOOKS_LIKE).encode()
#: Code of a byte in the character model: 0 ends a word, 1-26 letters, 27 beyond ASCII, 28 a digit.
CODE = np.zeros(256, np.uint8)
CODE[97:123] = np.arange(1, 27)
CODE[65:91] = np.arange(1, 27)
CODE[128:] = 27
CODE[48:58] = 28

_LETTER, _SYMBOL, _DIGIT, _WORD = 1, 2, 4, 8
_CLASS = np.zeros(256, np.uint8)
_CLASS[97:123] = _LETTER | _WORD
_CLASS[[b for b in _LEET]] = _SYMBOL
_CLASS[48:58] = _SYMBOL | _DIGIT | _WORD
_CLASS[128:] = _WORD

_leet = re.escape(_LEET)
_GAP = rb"[^a-z%b\x80-\xff]{1,3}" % _leet
_SPACED = re.compile(rb"(?<![a-z%b\x80-\xff])[a-z%b](?:%b[a-z%b]){2,}(?![a-z%b\x80-\xff])" % (_leet, _leet, _GAP, _leet, _leet))
_FIGURES = re.compile(rb"[0-9](?:%b[0-9]){2}" % _GAP)
_TOKEN = re.compile(rb"[a-z%b]{2,}[a-z0-9]" % _leet)
_ODD = re.compile(rb"[%b](?=[a-z])|(?<=[a-z])[0-9]|([a-z])\1\1" % _leet)
_LOWER_TABLE = bytes(seq.LOWER)
_CLASS_LIST = _CLASS.tolist()
_SEPARATORS = bytes(b for b in range(128) if not _CLASS[b] and not 65 <= b < 91)
#: What a byte of a lower-case text can be read as; bytes that are read alike have one shape from 1 to 26.
_READS = {b: {b} for b in range(97, 123)} | {ord(k): {ord(c) for c in v} for k, v in LOOKS_LIKE.items()}
_SHAPE = np.zeros(256, np.uint8)
for _byte, _letters in _READS.items():
    _SHAPE[_byte] = min(105 if c == 108 else c for c in _letters) - 96  # i and l are alike, as 1 is either
_SHAPE[128:] = 27
#: Separators beyond ASCII (no-break and zero-width spaces, dots, dashes) as blanks of the same length.
_WIDE_GAP = re.compile(rb"\xc2[\x80-\xa9\xab-\xb4\xb6-\xb9\xbb-\xbf]|\xe2[\x80\x81][\x80-\xbf]|\xe3\x80\x80|\xef\xbb\xbf")
#: Shapes of a word's first runs that the scan compares.
_RUNS = 4
_WORD_TABLE = bytes(b if b >= 128 or 97 <= b <= 122 or 48 <= b <= 57 else 32 for b in range(256))


def _trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(1 << 15, np.int64)
    for batch in batches:
        data, places = seq.buffers(batch.column("text"))
        for _, _, part, at in seq.parts(data, places):
            if not len(part):
                continue
            # A word end between texts; the place of each byte moves by its text's number.
            code = np.zeros(len(part) + len(at) + 1, np.uint16)
            code[np.arange(len(part)) + np.repeat(np.arange(1, len(at)), np.diff(at)) + 1] = CODE[part]
            counts += np.bincount((code[:-2] << 10) | (code[1:-1] << 5) | code[2:], minlength=1 << 15)
    seen = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(counts[seen])], ["gram", "n"])


def character_model(docs: DataFrame, text_col: str = "text") -> list[float]:
    """Log probability of a character after two others, from all documents. One row
    for each trigram of 32 codes comes to the driver, whatever the input."""
    counted = docs.select(F.col(f"`{text_col}`").alias("text")).mapInArrow(_trigrams, "gram int, n bigint")
    counts = np.zeros(1 << 15)
    for row in counted.groupBy("gram").agg(F.sum("n").alias("n")).collect():
        counts[row.gram] = row.n
    table = counts.reshape(32, 32, 32)
    # Trigrams are smoothed by bigrams, and these by single characters.
    single = (table.sum((0, 1)) + 1) / (table.sum() + 32)
    pair = (table.sum(0) + 20 * single) / (table.sum((0, 2))[:, None] + 20)
    return np.log((table + 5 * pair[None]) / (table.sum(2, keepdims=True) + 5)).ravel().tolist()


def _gap_cost(text: bytes, first: int, last: int) -> float:
    """What it costs to drop the separators text[first:last]."""
    joined = lambda i: 0 <= i < len(text) and text[i] in _READS
    return COST_JOIN if joined(first - 2) and joined(last + 1) else COST_DROP_SPACE


def viterbi(stretch: bytes, model: list[float], wide: bool = False) -> tuple[float, bytes]:
    """The likeliest reading of a suspicious stretch (lower case) and its score. With ``wide`` any
    repeated letter, also one that only looks repeated, and any symbol can stand for nothing."""
    states: dict[int, tuple[float, tuple | None]] = {0: (0.0, None)}
    if wide:
        stretch = re.sub(rb"[^a-z%b\x80-\xff]+" % _leet, b" ", stretch)
    runs = [len(m.group()) for m in re.finditer(rb"(?s)(.)\1*", stretch) for _ in m.group()]
    previous = -1
    for place, (byte, run) in enumerate(zip(stretch, runs, strict=True)):
        char, code = chr(byte), int(CODE[byte])
        options: list[tuple[int, float, int]] = []  # code (-1: nothing), cost, byte
        if char in LOOKS_LIKE:
            options += [(ord(c) - 96, COST_LOOKS_LIKE, ord(c)) for c in LOOKS_LIKE[char]]
            options.append((code, COST_SYMBOL, byte))
            if wide and not 48 <= byte < 58:
                options.append((-1, COST_SYMBOL, 0))
        elif byte not in _READS and byte < 128:
            options += [(-1, _gap_cost(stretch, place, place + 1) if wide else COST_DROP_SPACE, 0), (0, 0.0, 32)]
        else:
            options.append((code, 0.0, byte))
        if wide:
            if not _READS.get(byte, set()).isdisjoint(_READS.get(previous, ())):
                options.append((-1, COST_DROP_REPEATED, 0))
            previous = byte if byte in _READS else previous
        else:
            if byte == previous and run > 2 and 97 <= byte < 123:  # two alike are common spelling
                options.append((-1, COST_DROP_REPEATED, 0))
            previous = byte
        following: dict[int, tuple[float, tuple | None]] = {}
        for state, (score, path) in states.items():
            for code_, cost, out in options:
                if code_ < 0:
                    key, value, new = state, score - cost, path
                else:
                    key, value, new = (state << 5 | code_) & 1023, score - cost + model[state << 5 | code_], (path, out)
                if key not in following or value > following[key][0]:
                    following[key] = value, new
        states = following
    score, path = max(((s + model[k << 5], p) for k, (s, p) in states.items()), key=lambda x: x[0])
    read = bytearray()
    while path is not None:
        path, out = path
        read.append(out)
    return score, bytes(reversed(read))


class Hidden:
    """The stretches of a text that some path of the wide lattice turns into a lexicon entry."""

    def __init__(self, entries: Iterable[bytes]):
        entries = [e for e in entries if re.fullmatch(rb"[a-z]+\*?", e)]
        # Nodes of a tree by letters; at 0 whether a word (1) or a beginning (2) ends there, at 1 the letters.
        self._tree: dict[int, dict | int | bytes] = {}
        # Whether an entry begins with these runs of shapes.
        self._begins = np.zeros((32,) * _RUNS, bool)
        for entry in entries:
            node = self._tree
            for letter in entry.rstrip(b"*"):
                node = node.setdefault(letter, {})
            node[0], node[1] = node.get(0, 0) | (2 if entry.endswith(b"*") else 1), entry.rstrip(b"*")
            shapes = _SHAPE[np.frombuffer(entry.rstrip(b"*"), np.uint8)]
            runs = shapes[np.flatnonzero(np.diff(shapes, prepend=99))][:_RUNS]
            self._begins[tuple(runs.tolist())] = True  # all that follows a short one
        self._begins = self._begins.ravel()

    def starts(self, part: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where in lower-case texts an entry may begin: a superset, by the first runs alone."""
        kind = _CLASS[part]
        word = kind & _WORD > 0
        shape = _SHAPE[part]
        kept = np.flatnonzero(shape)
        if not len(kept):
            return kept
        kind, shape = kind[kept], shape[kept]
        before = np.zeros(len(part) + 1, bool)
        before[1:] = word
        before[at[:-1]] = False
        punctuation = kind & (_SYMBOL | _DIGIT) == _SYMBOL
        start = (~before[kept] | punctuation | np.append(False, punctuation[:-1])) & (shape < 27)
        first = np.append(True, shape[1:] != shape[:-1])
        run = np.cumsum(first) - 1
        runs = np.append(shape[first], np.zeros(_RUNS, np.uint8)).astype(np.int64)
        # A symbol is a letter or a separator: near one, nothing is ruled out.
        odd = np.append(np.zeros(1, np.int64), np.cumsum(punctuation))
        ends = np.append(np.flatnonzero(first), np.full(_RUNS + 1, len(kept)))
        start = np.flatnonzero(start)
        r = run[start]
        code = np.zeros(len(start), np.int64)
        for k in range(_RUNS):
            code = code << 5 | runs[r + k]
        good = self._begins[code] | (odd[ends[r + _RUNS]] > odd[start])
        return kept[start[good]]

    def ends(self, text: bytes, start: int) -> list[tuple[int, int, float, bytes]]:
        """Where entries end that stretches from ``start`` can be read as, the longest
        first; the end of the word there, the cost of the channel and of the entry, and its letters."""
        nodes, previous, gap, found = {id(self._tree): (0.0, self._tree)}, -1, 0, []
        for place in range(start, len(text)):
            byte = text[place]
            reads = _READS.get(byte)
            if reads is None:
                if byte >= 128:
                    break
                gap = gap or place
                continue
            punctuation = not (97 <= byte < 123 or 48 <= byte < 58)
            looks = 0.0 if 97 <= byte < 123 else COST_LOOKS_LIKE
            drop = []
            if previous >= 0:
                drop = [COST_SYMBOL] if punctuation else []
                drop += [] if reads.isdisjoint(_READS[previous]) else [COST_DROP_REPEATED]
            dropped = _gap_cost(text, gap, place) if gap else 0.0
            following: dict[int, tuple[float, dict]] = {}
            for cost, node in nodes.values():
                steps = [(looks, node[c]) for c in reads if c in node]
                steps += [(min(drop), node)] if drop else []
                for more, after in steps:
                    if id(after) not in following or cost + dropped + more < following[id(after)][0]:
                        following[id(after)] = cost + dropped + more, after
            if not following:
                break
            nodes, previous, gap = following, byte, 0
            ended = place + 1 == len(text) or not _CLASS_LIST[text[place + 1]] & _WORD
            ending = [(c + (COST_ENTRY if ended and n[0] & 1 else COST_BEGINNING), n[1]) for c, n in nodes.values() if n.get(0, 0) > (0 if ended else 1)]
            if ending:
                end = place + 1
                while end < len(text) and _CLASS_LIST[text[end]] & _WORD:
                    end += 1
                found.append((place + 1, end, *min(ending)))
        return found[::-1]


class Restorer:
    """Texts in lower case with their suspicious stretches decoded; with a lexicon also
    those that only it makes suspicious."""

    def __init__(self, model: list[float], lexicon: Lexicon | None = None):
        self._model, self._lexicon = model, lexicon
        self._hidden = Hidden(lexicon.entries()) if lexicon else None
        self._known: dict[bytes, bytes] = {}
        self._known_hidden: dict[bytes, bytes | None] = {}

    def _read(self, match: re.Match[bytes]) -> bytes:
        stretch = match.group()
        if stretch not in self._known:
            if len(self._known) > 100_000:
                self._known.clear()
            self._known[stretch] = viterbi(stretch, self._model)[1]
        return self._known[stretch]

    def _reveal(self, stretch: bytes, cost: float, entry: bytes, rest: bytes) -> bytes | None:
        """The reading of a stretch that can be read as an entry and the rest of a word, if that is
        likelier than to read none; None too if the stretch shows an entry as it is."""
        if stretch not in self._known_hidden:
            if len(self._known_hidden) > 100_000:
                self._known_hidden.clear()
            has = lambda t: self._lexicon.evidence(distinct_words(t))[0] > 0
            read = None
            if not has(stretch) and not re.fullmatch(rb"[^a-z@$!|+]*", stretch):  # figures alone are numbers
                score, read = viterbi(stretch, self._model, wide=True)
                if not has(read):
                    state, value = int(CODE[entry[-2]]) << 5 | int(CODE[entry[-1]]), -cost
                    for code in CODE[np.frombuffer(rest, np.uint8)].tolist() + [0] if rest else []:
                        value, state = value + self._model[state << 5 | code], (state << 5 | code) & 1023
                    read = entry + rest if value > score else None
            self._known_hidden[stretch] = read
        return self._known_hidden[stretch]

    def reveal(self, text: bytes, starts: Iterable[int]) -> bytes:
        """A lower-case text with the entries read that are hidden at ``starts``."""
        read, done, last = [], 0, (-1, -1)
        plain = text if text.isascii() else _WIDE_GAP.sub(lambda m: b" " * len(m.group()), text)
        for start in starts:
            # From a letter that the one before repeats nothing else can begin.
            place, repeated = start, last[1] >= 0 and not plain[last[0] + 1 : start].strip(_SEPARATORS)
            repeated = repeated and plain[place] == last[1]
            last = (start, plain[start])
            if start < done or repeated:
                continue
            for inner, end, cost, entry in self._hidden.ends(plain, start):
                reading = self._reveal(plain[start:end], cost, entry, plain[inner:end])
                if reading is not None:
                    read += [text[done:start], reading]
                    done = end
                    break
        return b"".join([*read, text[done:]]) if read else text

    def restore(self, text: bytes) -> bytes:
        text = text.translate(_LOWER_TABLE)
        if self._hidden:
            part = np.frombuffer(text, np.uint8)
            text = self.reveal(text, self._starts(part, np.array([0, len(part)])).tolist())
        return self._restore(text)

    def _starts(self, part: np.ndarray, at: np.ndarray) -> np.ndarray:
        if (part >= 128).any():
            plain = _WIDE_GAP.sub(lambda m: b" " * len(m.group()), part.tobytes())
            part = np.frombuffer(plain, np.uint8)
        return self._hidden.starts(part, at)

    def _restore(self, text: bytes) -> bytes:
        # Three figures alone are numbers.
        text = _SPACED.sub(lambda m: m.group() if _FIGURES.fullmatch(m.group()) else self._read(m), text)
        return _TOKEN.sub(lambda m: self._read(m) if _ODD.search(m.group()) else m.group(), text)

    def batch(self, texts: pa.Array) -> Iterator[bytes]:
        """Each text restored. A scan of whole buffers tells which texts need it."""
        data, places = seq.buffers(texts)
        for _, _, part, at in seq.parts(data, places):
            part = seq.LOWER[part]
            odd = np.zeros(len(part) + 1, np.int64)
            if len(part) > 1:
                kind = _CLASS[part]
                letter, symbol = kind & _LETTER > 0, kind & _SYMBOL > 0
                odd[1:-1] = (symbol[:-1] & letter[1:]) | (letter[:-1] & (kind[1:] & _DIGIT > 0))
                odd[1:-2] |= letter[:-2] & (part[:-2] == part[1:-1]) & (part[1:-1] == part[2:])
                # Three characters that stand alone, near each other.
                alone = np.zeros(len(part) + 2, bool)
                alone[1:-1] = letter | symbol
                joined = alone[1:-1] | (kind & _WORD > 0)
                left, right = np.append(False, joined[:-1]), np.append(joined[1:], False)
                inner = at[(at > 0) & (at < len(part))]
                left[inner], right[inner - 1] = False, False
                single = np.flatnonzero((letter | symbol) & ~left & ~right)
                near = np.diff(single) <= 4
                odd[single[2:][near[1:] & near[:-1]] + 1] = 1
                np.cumsum(odd, out=odd)
            starts = self._starts(part, at) if self._hidden and len(part) else np.zeros(0, np.int64)
            bounds = np.searchsorted(starts, at)
            for k, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist(), strict=True)):
                text = part[a:b].tobytes()
                if bounds[k] < bounds[k + 1]:
                    text = self.reveal(text, (starts[bounds[k] : bounds[k + 1]] - a).tolist())
                yield self._restore(text) if odd[b] > odd[a] else text


def features(words: set[bytes]) -> set[bytes]:
    """Words and their beginnings, the latter with a star."""
    found = set(words)
    for n in BEGINNINGS:
        found.update(w[:n] + b"*" for w in words if len(w) >= n)
    return found


def distinct_words(restored: bytes) -> set[bytes]:
    return set(restored.translate(_WORD_TABLE).split())


def _alike(found: set[bytes]) -> int:
    """A number that near copies mostly share: three min-hashes of their features."""
    least = [min((zlib.crc32(f, seed) for f in found), default=0) for seed in (1, 2, 3)]
    return least[0] << 31 ^ least[1] << 15 ^ least[2]


def _featured(model: list[float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(model)
        for batch in batches:
            found = [features(distinct_words(t)) for t in restorer.batch(batch.column("text"))]
            alike = pa.array([_alike(fs) for fs in found], pa.int64())
            lists = pa.array([[f.decode("latin-1") for f in fs if 2 < len(f) < 40] for fs in found], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([batch.column("label"), alike, lists], ["label", "alike", "features"])

    return run


class Lexicon:
    """Weights of words and beginnings, and what a document holds of them."""

    def __init__(self, weights: dict[bytes, float]):
        self._weights = weights
        self._starts = {f[:-1][:4] if f.endswith(b"*") else f[:4] for f in weights}

    def entries(self) -> list[bytes]:
        return list(self._weights)

    def evidence(self, words: set[bytes]) -> tuple[float, float, float]:
        """The largest weight, the logarithm of their sum, and that of the number of words."""
        starts, get = self._starts, self._weights.get
        hits = [
            max(get(w, 0.0), *(get(w[:n] + b"*", 0.0) for n in BEGINNINGS))
            for w in words
            if w[:4] in starts
        ]
        return max(hits, default=0.0), math.log1p(sum(hits)), math.log1p(len(words))


def _evidence(model: list[float], lexicon: Lexicon, names: list[str], text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(model, lexicon)
        for batch in batches:
            rows = [lexicon.evidence(distinct_words(t)) for t in restorer.batch(batch.column(text_col))]
            flat = pa.array([x for row in rows for x in row], pa.float64())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * 3), flat)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), lists], [*names, "evidence"])

    return run


def logistic_regression(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Coefficients, the constant last, by Newton's method."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + (ridge + 1e-9) * np.eye(len(w)) * len(y)
        step = np.linalg.solve(hessian, x.T @ (y - p) - ridge * len(y) * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


class ToxicityModel:
    """The character model, the lexicon and the coefficients, all of bounded size."""

    def __init__(self, characters: list[float], weights: dict[bytes, float], coefficients: np.ndarray | None):
        self.characters, self.lexicon, self.coefficients = characters, Lexicon(weights), coefficients

    @classmethod
    def fit(cls, docs: DataFrame, labels: DataFrame, excluded, *, sample_rows: int = SAMPLE_ROWS) -> ToxicityModel:
        """Count characters over all ``docs`` and learn from about ``sample_rows``
        labelled ones (``doc_id``, ``toxic``) for which ``excluded`` (a condition on
        ``key``, the id) does not hold. One half gives the lexicon, the other the
        coefficients. With labels of one kind only, every score is that label."""
        characters = character_model(docs)
        sample = stored(labelled_sample(docs, labels, "toxic", excluded, sample_rows), "toxicity-sample")
        lexicon_half = F.pmod(F.crc32(F.encode(F.col("key").cast("string"), "UTF-8")) / 4, F.lit(2)).cast("int") == 0
        counts = {r["label"]: r["count"] for r in sample.where(lexicon_half).groupBy("label").count().collect()}
        n0, n1 = counts.get(0, 0), counts.get(1, 0)
        featured = sample.where(lexicon_half).mapInArrow(_featured(characters), "label int, alike bigint, features array<string>")
        # Copies of a document are no further evidence, they count once.
        words = featured.select("label", "alike", F.explode("features").alias("feature")).distinct()
        seen = words.groupBy("feature").agg(F.sum("label").alias("in1"), F.sum(1 - F.col("label")).alias("in0"))
        seen = stored(seen.where(F.col("in1") + F.col("in0") >= LEAST_DOCS), "toxicity-words")
        a, b, share = F.col("in1"), F.col("in0"), n1 / max(1, n0 + n1)
        weight = F.log((a + 0.5) / (n1 + 1.0)) - F.log((b + 0.5) / (n0 + 1.0))
        # Chernoff's bound on the chance that so many of its documents have label 1.
        part = lambda n, p: F.when(n > 0, n * F.log(n / ((a + b) * max(p, 1e-9)))).otherwise(0.0)
        surprise = part(a, share) + part(b, 1 - share)
        top = (
            seen.where(a >= LEAST_DOCS)
            .where(surprise >= math.log(max(1, seen.count())))
            .select("feature", weight.alias("weight"), "in1")
            .where(F.col("weight") >= LEAST_WEIGHT)
            .orderBy(F.desc(F.col("weight") * F.log1p("in1")), "feature")
            .limit(LEXICON)
        )
        weights = {r.feature.encode("latin-1"): r.weight for r in top.collect()}
        model = cls(characters, weights, None)
        half = sample.where(~lexicon_half).select("key", "label", "text")
        fitted = half.mapInArrow(_evidence(characters, model.lexicon, ["key", "label"], "text"), "key bigint, label int, evidence array<double>")
        rows = np.array(sorted((r.key, r.label, *r.evidence) for r in fitted.collect()), float).reshape(-1, 5)
        if 0 < rows[:, 1].sum() < len(rows):
            model.coefficients = logistic_regression(rows[:, 2:], rows[:, 1])
        else:
            constant = 0.0 if not len(rows) else rows[0, 1]
            model.coefficients = np.array([0.0, 0.0, 0.0, 30.0 if constant else -30.0])
        return model

    def score(self, docs: DataFrame, *, text_col: str = "text", score_col: str = "score") -> DataFrame:
        """Add ``score_col``, 0 to 1 and higher for label 1. A null text is scored as
        an empty one; a column of that name is replaced."""
        names = [c for c in docs.columns if c not in (score_col, "evidence")]
        docs = docs.select(*(f"`{c}`" for c in names))
        schema = T.StructType([*docs.schema.fields, *T.StructType.fromDDL("evidence array<double>").fields])
        found = docs.mapInArrow(_evidence(self.characters, self.lexicon, names, text_col), schema)
        a, b, c, constant = (F.lit(float(x)) for x in self.coefficients)
        e = F.col("evidence")
        return found.withColumn(score_col, 1 / (1 + F.exp(-(a * e[0] + b * e[1] + c * e[2] + constant)))).drop("evidence")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    docs, labels = documents(spark, sf_dir).select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = ToxicityModel.fit(docs, labels, held_out(F.col("key"), 4, 2))
    return model.score(docs).select(
        "doc_id",
        held_out(F.col("doc_id"), 4, 2).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


QUERIES = {"op4_toxicity": op4_toxicity}
ORACLE: dict[str, str] = {}
