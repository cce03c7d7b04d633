"""Near copies, repeated passages and repeated bytes against brute force."""

from __future__ import annotations

import hashlib
import re
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from revmap.llm import minhash_dedup, suffix_dedup
from revmap.llm import sequences as seq
from revmap.llm.components import components
from revmap.llm.minhash_dedup import near_duplicates
from revmap.llm.substring_dedup import remove_repeats
from revmap.llm.suffix_dedup import remove_repeated_bytes

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_words(rows, window):
    """doc_id to the words that stay."""
    seen, left = {}, {}
    for i, text in sorted(rows):
        words = WORD.findall(text or "")
        grams = [tuple(words[p : p + window]) for p in range(len(words) - window + 1)]
        gone = set()
        for p, gram in enumerate(grams):
            if seen.get(gram, i) < i:
                gone.update(range(p, p + window))
        for gram in grams:
            seen.setdefault(gram, i)
        left[i] = [w for p, w in enumerate(words) if p not in gone]
    return left


def brute_bytes(rows, window):
    seen, left = set(), {}
    for i, text in sorted(rows):
        data, gone = (text or "").encode(), set()
        for p in range(len(data) - window + 1):
            if data[p : p + window] in seen:
                gone.update(range(p, p + window))
            seen.add(data[p : p + window])
        left[i] = bytes(b for p, b in enumerate(data) if p not in gone)
    return left


@pytest.fixture
def repeats(prose):
    """Texts that share passages at all kinds of places, within and across texts."""
    a, b, c = prose(70, 1), prose(60, 2), prose(130, 3)
    return [
        a,
        f"{prose(20, 4)} {a} {prose(9, 5)}",
        f"{a}\n{b}",
        b.replace(" ", "\t", 3),
        f"{c} {c}",
        " ".join(c.split()[:49]),
        " ".join(c.split()[10:60]),
        f"{c[:400]}X{c[400:]}",
        "ab " * 300,
        f"ab ab {'ab ' * 80}",
        a,
        "",
        None,
    ] + [f"{prose(5, 100 + k)} {b} {prose(5, 200 + k)}" for k in range(30)]


def test_words_against_brute_force(make, repeats):
    docs = make(*repeats)
    got = {r.doc_id: r for r in remove_repeats(docs, window=50).collect()}
    for i, left in brute_words([(r.doc_id, r.text) for r in docs.collect()], 50).items():
        assert WORD.findall(got[i].text or "") == left
        assert got[i].n_removed == got[i].n_words - len(left)
        assert sum(s.end - s.start for s in got[i].removed) == got[i].n_removed


@pytest.mark.parametrize("hot", [1000, 3])
def test_bytes_against_brute_force(make, repeats, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    monkeypatch.setattr(suffix_dedup, "GROUP_RUNS", 20)
    docs = make(*repeats)
    got = {r.doc_id: r for r in remove_repeated_bytes(docs, window=100).collect()}
    for i, left in brute_bytes([(r.doc_id, r.text) for r in docs.collect()], 100).items():
        assert bytes(got[i].kept_bytes) == left
        assert got[i].n_bytes - got[i].n_removed == len(left)


@pytest.mark.parametrize("collide", [False, True])
@pytest.mark.parametrize("room", [64 << 20, 40])
def test_longest_previous_factors(monkeypatch, collide, room):
    """Against all earlier places; equal hashes of other bytes change nothing."""
    import numpy as np

    monkeypatch.setattr(suffix_dedup, "ORDER_BYTES", room)
    rng, depth = np.random.default_rng(2), 4
    for _ in range(30):
        data = rng.integers(0, 3, 60).astype(np.uint8)
        start = rng.permutation(57)[:50]
        position = rng.integers(0, 9, 50)
        text = [data[s : s + depth].tobytes() for s in start]
        prefix = np.array([0 if collide else hash(t) % 2**63 for t in text], np.uint64)
        found = suffix_dedup.longest_previous_factors(data, start, prefix, position, depth)
        wanted = [depth * any(t == u and q < p for u, q in zip(text, position, strict=True)) for t, p in zip(text, position, strict=True)]
        assert found.tolist() == wanted
    assert not len(suffix_dedup.longest_previous_factors(data, start[:0], prefix[:0], position[:0], depth))


def test_suffixes_of_a_repetitive_text_are_ordered_in_little_memory():
    # Places of single bytes, gathered one by one, took 549 MB of a task here.
    data = np.tile(np.random.default_rng(5).integers(97, 101, 4000).astype(np.uint8), 150)
    start = np.arange(len(data) - 99)
    prefix = seq.Hasher(seq.BYTE_SYMBOL[data]).windows(100)
    tracemalloc.start()
    found = suffix_dedup.longest_previous_factors(data, start, prefix, start, 100)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (found[4000:] == 100).all() and not found[:4000].any()
    assert most < 128 << 20


def test_query_against_brute_force(spark):
    """The five columns over the whole table."""
    rows = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    seen, wanted = set(), {}
    for i in sorted(rows):
        data, gone = rows[i], bytearray(len(rows[i]))
        for p in range(len(data) - 99):
            if (s := data[p : p + 100]) in seen:
                gone[p : p + 100] = b"\1" * 100
            seen.add(s)
        left = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        wanted[i] = (len(data), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(left).hexdigest())
    got = suffix_dedup.op9_suffix_dedup(spark, "/root/testdata/sf0.001").collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == wanted


def brute_components(rows, threshold=75, k=5):
    sets = {}
    for i, text in rows:
        words = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        n = max(len(words) - k + 1, 1) if words else 0
        sets[i] = {tuple(words[p : p + k]) for p in range(n)}
    component = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for i, x in sets.items():
            for j, y in sets.items():
                if i < j and x and y and 100 * len(x & y) >= threshold * len(x | y) and component[i] != component[j]:
                    old, new = max(component[i], component[j]), min(component[i], component[j])
                    component = {d: new if c == old else c for d, c in component.items()}
                    changed = True
    return {i: (len(s), component[i]) for i, s in sets.items()}


def test_near_copies_against_brute_force(make, prose):
    base = prose(120, 7).split()
    edited = lambda *at: " ".join(f"new{p}" if p in at else w for p, w in enumerate(base))
    # A chain: neighbours are near, its ends are not; and copies that only reach each other over others.
    texts = [edited(*range(0, 8 * n, 8)) for n in range(12)] + [edited(20 + n, 60 + n) for n in range(25)]
    texts += [" ".join(base).upper(), prose(100, 8), prose(100, 8) + " more", "a b c", "A B C", "a b", "", None, "one"]
    docs = make(*texts)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(docs).collect()}
    assert got == brute_components([(r.doc_id, r.text) for r in docs.collect()])


def test_leftovers_are_compared_in_blocks(make, prose, monkeypatch):
    monkeypatch.setattr(minhash_dedup, "BLOCK_DOCS", 4)
    base = prose(150, 9).split()
    texts = []
    for n in range(40):
        rng = __import__("random").Random(n)
        at = set(rng.sample(range(150), rng.randint(2, 6)))
        texts.append(" ".join(f"x{n}{p}" if p in at else w for p, w in enumerate(base)))
    docs = make(*texts)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(docs).collect()}
    assert got == brute_components([(r.doc_id, r.text) for r in docs.collect()])


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(20)] + [(100, i) for i in range(101, 140)] + [(7, 7), (50, 51), (51, 50)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(1, 21)}, **{i: 100 for i in range(101, 140)}, 51: 50}


def test_odd_rows_and_empty_tables(odd):
    clash = odd.withColumn("removed", F.lit(1)).withColumn("spans", F.lit("x"))
    words = remove_repeats(clash).collect()
    assert len(words) == 10 and all(r.n_removed == 0 and r.spans == "x" for r in words)
    assert sorted(r.text or "" for r in words) == sorted(r.text or "" for r in odd.collect())
    data = remove_repeated_bytes(clash).collect()
    assert len(data) == 10 and [r.n_bytes for r in data if r.text is None] == [0]
    near = near_duplicates(clash).collect()
    assert len(near) == 10
    assert {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near} >= {(2, 0, 2, True), (3, 0, 3, True), (None, 1, None, True)}
    for empty in (remove_repeats, remove_repeated_bytes, near_duplicates):
        assert empty(odd.limit(0)).count() == 0


def test_rows_of_one_id_do_not_remove_from_each_other(spark, prose):
    text = prose(80, 11)
    docs = spark.createDataFrame([(1, text), (1, text + " end"), (2, text)], "doc_id bigint, text string")
    assert sorted((r.doc_id, r.n_removed) for r in remove_repeats(docs).collect()) == [(1, 0), (1, 0), (2, 80)]
    kept = [hashlib.md5(r.kept_bytes).hexdigest() for r in remove_repeated_bytes(docs).collect() if r.doc_id == 1]
    assert sorted(kept) == sorted(hashlib.md5(t.encode()).hexdigest() for t in (text, text + " end"))
