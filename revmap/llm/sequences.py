"""Texts as sequences of 64-bit symbols (bytes or words), and hashes of their windows.

Everything here works on plain numpy arrays inside a Spark task: the texts of a
part of an Arrow batch lie one after the other in a buffer, and each step is a
few array operations over the whole buffer.

A hash is the polynomial sum of symbols, modulo 2^64 with an odd base, finished
by a bijective mix; symbols are random 64-bit numbers, equal in every process.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that are worked on at once; a longer text is one part by itself.
PART_BYTES = 1 << 19

_BASE = 0x9E3779B97F4A7C15
_RANDOM = np.random.default_rng(20240229)
#: A random symbol for every byte.
BYTE_SYMBOL = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: The bytes 0x20 and 0x09 to 0x0D end a word.
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: A-Z to a-z, all other bytes unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse, kept for the next call."""
    if "base" not in _powers or len(_powers["base"]) < n:
        size = max(n, PART_BYTES + 1)
        with np.errstate(over="ignore"):
            for name, value in (("base", _BASE), ("inverse", pow(_BASE, -1, 2**64))):
                steps = np.full(size, value, np.uint64)
                steps[0] = 1
                _powers[name] = np.cumprod(steps, dtype=np.uint64)
    return _powers["base"][:n], _powers["inverse"][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit of a 64-bit number over all others."""
    with np.errstate(over="ignore"):
        h = h ^ (h >> np.uint64(32))
        h = h * np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
    return h


class Hasher:
    """Hashes of stretches of one symbol array."""

    def __init__(self, symbols: np.ndarray):
        base, self._inverse = _power(len(symbols) + 1)
        self._sums = np.zeros(len(symbols) + 1, np.uint64)
        np.cumsum(symbols * base[:-1], out=self._sums[1:])
        self._n = len(symbols)

    def stretches(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The hash of symbols start (included) to end (left out), for each pair."""
        return mix((self._sums[end] - self._sums[start]) * self._inverse[start])

    def windows(self, k: int) -> np.ndarray:
        """The hash of the k symbols from each place on."""
        m = self._n - k + 1
        if m <= 0:
            return np.zeros(0, np.uint64)
        return mix((self._sums[k:] - self._sums[:m]) * self._inverse[:m])


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string array and where each text starts; a null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = texts.buffers()
    places = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    return np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8), places


def parts(data: np.ndarray, places: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Whole texts, some PART_BYTES at a time: first text, last text (left out), bytes, places within them."""
    first, n = 0, len(places) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(places, places[first] + PART_BYTES, "right")) - 1)
        last = min(last, n)
        yield first, last, data[places[first] : places[last]], places[first : last + 1] - places[first]
        first = last


def words(data: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word ``[^\\x20\\x09-\\x0D]+`` in bytes, and for each
    text the number of its first word (one more entry than texts)."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~IS_SPACE[data]
    starts = inside[1:-1] & ~inside[:-2]
    ends = inside[1:-1] & ~inside[2:]
    inner = places[(places > 0) & (places < len(data))]
    starts[inner] |= inside[1:-1][inner]
    ends[inner - 1] |= inside[1:-1][inner - 1]
    start, end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return start, end, np.searchsorted(start, places)


def word_symbols(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A symbol for each word, the hash of its bytes."""
    if not len(start):
        return np.zeros(0, np.uint64)
    return Hasher(BYTE_SYMBOL[data]).stretches(start, end)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours, by doubling."""
    done = 1
    while done * 2 <= width:
        values = np.minimum(values[:-done], values[done:])
        done *= 2
    if done < width:
        values = np.minimum(values[: len(values) - (width - done)], values[width - done :])
    return values


def _within_texts(first: np.ndarray, n: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """The text of each symbol, and which windows do not leave their text."""
    text_of = np.repeat(np.arange(len(first) - 1), np.diff(first))
    return text_of, text_of[: n - window + 1] == text_of[window - 1 :]


def super_windows(symbols: np.ndarray, first: np.ndarray, window: int, k: int):
    """Cut the windows of each text into runs with the same least k-gram hash.

    ``first`` holds where each text starts in ``symbols`` (one more entry than
    texts). The least hash among the k-grams of a window is its anchor, so equal
    windows have equal anchors wherever they stand, and the run around an anchor
    is cut by the content on both sides: inside a long repeated passage, runs are
    equal too. Returns for each run: text, start (within the text), number of
    windows, anchor, and the hash of all symbols that its windows cover.
    """
    empty = np.zeros(0, np.int64)
    n = len(symbols)
    if n < window:
        return empty, empty, empty, empty.astype(np.uint64), empty.astype(np.uint64)
    hasher = Hasher(symbols)
    least = sliding_min(hasher.windows(k), window - k + 1)
    text_of, inside = _within_texts(first, n, window)
    new = np.ones(len(least), bool)
    new[1:] = (least[1:] != least[:-1]) | ~inside[:-1]
    starts = np.flatnonzero(new & inside)
    # A run ends before the next start or before the first window that leaves its text.
    stops = np.flatnonzero(inside & np.append(new[1:] | ~inside[1:], True)) + 1
    text = text_of[starts]
    covered = hasher.stretches(starts, stops + window - 1)
    return text, starts - first[text], stops - starts, least[starts], covered


def repeating_texts(symbols: np.ndarray, first: np.ndarray, window: int, k: int) -> np.ndarray:
    """The texts that have an anchor at two places. No other text has a window twice:
    equal windows have their anchors at equal places within them."""
    n = len(symbols)
    if n < window:
        return np.zeros(0, np.int64)
    grams, width = Hasher(symbols).windows(k), window - k + 1
    least = sliding_min(grams, width)
    text_of, inside = _within_texts(first, n, window)
    # A k-gram is an anchor if the largest of the least hashes around it is its own.
    least = np.where(inside, least, 0)
    none = np.zeros(width - 1, np.uint64)
    around = ~sliding_min(~np.concatenate([none, least, none]), width)
    anchor = np.flatnonzero((grams == around) & (around > 0))
    text = text_of[anchor]
    key = mix(grams[anchor] + mix(text.astype(np.uint64)))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    return np.unique(text[order[1:]][same])
