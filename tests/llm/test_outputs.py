"""Phrases, token files and product codes against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from revmap.llm import code_compression, collocations, token_files
from revmap.llm import sequences as seq
from revmap.llm.code_compression import compress, kept_vectors, lloyd_codebooks
from revmap.llm.token_files import TokenFile, UnitEncoder, file_bytes, read_token_files, write_token_files

SF = "/root/testdata/sf0.001"
VOCABULARY = public_tokenizers.path(token_files.VOCABULARY)


def brute_phrases(rows, top, min_count, absorbed=50):
    """(lang, text) rows to {(lang, rank): (phrase, a, l, r, n, score)}."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", text):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for k in (1, 2, 3):
                f.update((lang, *words[i : i + k]) for i in range(len(words) - k + 1))
    out = {}
    for lang in n:
        phrases = {p[1:]: a for p, a in f.items() if p[0] == lang and len(p) > 2 and a >= min_count}
        scored = []
        for p, a in phrases.items():
            around = [b for q, b in phrases.items() if len(q) == 3 and len(p) == 2 and p in (q[:2], q[1:])]
            if not any(100 * b >= absorbed * a for b in around):
                cuts = [(10**6 * a * a // (f[lang, *p[:k]] * f[lang, *p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                scored.append((-score, -a, " ".join(p).encode(), f[lang, *p[:k]], f[lang, *p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out[lang, rank] = (phrase.decode(), -a, left, right, n[lang], -score)
    return out


def found_phrases(df):
    return {(r.lang, r["rank"]): (r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect()}


def speech(seed, n, words):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(words)]
    out = []
    while len(out) < n:
        at = int(rng.paretovariate(0.6)) % words
        out += [vocabulary[at]] + [vocabulary[(at * 7 + k) % words] for k in range(rng.choice([0, 0, 1, 2, 3]))]
        if rng.random() < 0.1:
            out[-1] += rng.choice(".,;:!?\n\r")
    return " ".join(out)


@pytest.mark.parametrize("frontier", [8, 1])
def test_phrases_against_brute_force(spark, monkeypatch, frontier):
    monkeypatch.setattr(collocations, "FRONTIER", frontier)
    monkeypatch.setattr(collocations, "GROWTH", 2)
    rows = [(lang, speech(k, 900, 60 + 40 * len(lang or ""))) for k, lang in enumerate(["en", "en", "de", None, "und", "x"])]
    rows += [("en", None), ("en", ""), ("fr", " \t\n "), (None, "A a  a\ta. a"), rows[0], rows[0], ("en", "Café ÉTÉ " * 40)]
    docs = spark.createDataFrame([(i, *r, "c", 1) for i, r in enumerate(rows)], "doc_id int, lang string, text string, phrase string, n int")
    for top, least in ((10, 3), (40, 2)):
        got = found_phrases(collocations.collocations(docs, top=top, min_count=least))
        assert got == brute_phrases(rows, top, least)
    assert collocations.collocations(docs.limit(0)).count() == 0
    assert collocations.collocations(docs, min_count=10**6).count() == 0


@pytest.mark.parametrize("size", [64, 300, 1 << 20])
def test_blocks_count_every_word_once(monkeypatch, size):
    """A text that is longer than a block, also one without any white space."""
    monkeypatch.setattr(collocations, "BLOCK_BYTES", size)
    texts = [speech(1, 300, 40), "", None, "x" * 1000, "a b " * 200, speech(2, 50, 9), "y" * 500 + " " + "z" * 700 + " q", "."]
    batch = pa.RecordBatch.from_pydict({"lang": ["a", "b", None, "a", "b", "a", "c", "d"], "text": texts})
    total = Counter()
    for part in collocations._block_counts(batch):
        for r in part.to_pylist():
            total[r["lang"], r["w1"], r["w2"]] += r["n"]
    wanted = Counter()
    for lang, text in zip(batch.column(0).to_pylist(), texts, strict=True):
        for piece in re.split("[.,;:!?\n\r]", text or ""):
            words = piece.split()
            wanted.update((lang or "und", w, None) for w in words)
            wanted.update((lang or "und", x, y) for x, y in zip(words, words[1:], strict=False))
            if words:
                wanted[lang or "und", None, None] += len(words)
    assert total == wanted


def test_large_counts_are_exact(spark):
    a, part, rest = 3_000_000_019, 3_000_000_021, 4_000_000_007
    row = spark.createDataFrame([(a, part, rest)], "a bigint, l bigint, r bigint")
    assert row.select(collocations._score("l", "r").alias("s")).first().s == 10**6 * a * a // (part * rest)


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(VOCABULARY)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


UNITS = [
    "a  b", "a \n b  ", "  x", "é è  café con leche", " ", "", "  b a  c", "<|endoftext|> hi", "日本語 中文 ",
    " word's it'll we're  ", "a\x1c b\x85c  d  e", "end.\nNext,and\n\n more!?\r\n\tx", "…  … ! ! 12 3 4.5,6", "x" * 400 + " " + "y " * 90,
]


@pytest.mark.parametrize("size", [40, 8 << 20])
def test_units_are_encoded_like_whole_texts(library, monkeypatch, size):
    monkeypatch.setattr(token_files, "BLOCK_BYTES", size)
    with open(VOCABULARY, encoding="utf-8") as file:
        encoder = UnitEncoder(file.read())
    rng = random.Random(5)
    texts = UNITS + ["".join(rng.choice(["a", "B", "é", " ", "  ", "\n", ".", "'s", "7", " ", " "]) for _ in range(60)) for _ in range(200)]
    ids, starts = encoder.encode(*seq.buffers(pa.array([*texts, None])))
    for i, text in enumerate([*texts, ""]):
        assert ids[starts[i] : starts[i + 1]].tolist() == library(text), text


def test_any_token_is_read_alone():
    rng = np.random.default_rng(1)
    tokens = rng.integers(0, 70_000, 5_000).astype(np.uint32)
    tokens[::7] %= 256
    tokens[[3, 4000]] = 2**32 - 1, 2**24
    file = TokenFile(file_bytes(tokens, [10, 10, 5_000], ["1", None, "é"]))
    assert file.ids() == ["1", None, "é"] and file.n_docs == 3
    assert np.array_equal(file.tokens(), tokens) and np.array_equal(file.document(2), tokens[10:]) and not len(file.document(1))
    assert [file.token(i) for i in range(0, 5_000, 13)] == tokens[::13].tolist()
    at = rng.integers(0, 5_000, 700)
    assert np.array_equal(file.gather(at), tokens[at])
    for a in range(0, 5_000, 97):
        assert np.array_equal(file.tokens(a, a + 50), tokens[a : a + 50])
    with pytest.raises(IndexError):
        file.token(5_000)
    assert not len(TokenFile(file_bytes(np.zeros(0, np.uint32), [0], ["x"])).tokens())
    with pytest.raises(ValueError):
        TokenFile(b"something else than such a file")


def test_query_reads_what_the_library_encodes(spark, library):
    wanted, at = [], 0
    for r in sorted(spark.read.parquet(f"{SF}/documents.parquet").collect(), key=lambda r: r.doc_id):
        ids = np.array([*library(r.text), 2], "<u4")
        wanted.append((r.doc_id, at, len(ids), zlib.crc32(ids)))
        at += len(ids)
    assert sorted(tuple(r) for r in token_files.op12_token_files(spark, SF).collect()) == wanted


def test_token_files_of_odd_rows(spark, odd, tmp_path, library, monkeypatch):
    monkeypatch.setattr(token_files, "TASK_BYTES", 200)
    long = spark.createDataFrame([(8, "a long text, " * 100_000, "en", "c", 1)], odd.schema)
    docs = odd.unionByName(long).withColumn("ids", F.lit(1)).withColumn("task", F.lit(2))
    files = write_token_files(docs, str(tmp_path / "files"), VOCABULARY)
    got = sorted(read_token_files(files, str(tmp_path / "files")).collect(), key=lambda r: r.start)
    assert [r.id for r in got] == [None, 1, 1, 2, 3, 4, 5, 6, 7, 7, 8]
    assert [r.start for r in got] == np.cumsum([0, *(r.n_tokens for r in got)])[:-1].tolist()
    wanted = Counter((r.doc_id, zlib.crc32(np.array([*library(r.text), 2], "<u4"))) for r in docs.collect())
    assert Counter((r.id, r.ids_crc32) for r in got) == wanted
    texts = docs.select(F.concat(F.lit("k"), "doc_id").alias("doc_id"), "text")
    files = write_token_files(texts, str(tmp_path / "texts"), VOCABULARY, end_id=None)
    assert {r.id for r in read_token_files(files, str(tmp_path / "texts"), "string").collect()} == {None, *(f"k{i}" for i in range(1, 9))}
    none = write_token_files(docs.limit(0), str(tmp_path / "none"), VOCABULARY)
    assert read_token_files(none, str(tmp_path / "none")).count() == 0


def brute_codes(rows, rounds=2, parts=16, entries=64):
    """(id, label, vector) rows to {id: (code, error)} and the codebooks."""
    whole = [(i, lab, [int(__import__("fractions").Fraction(x) * 256 // 1) for x in v]) for i, lab, v in rows]
    width = -(-max(len(v) for _, _, v in whole) // parts)
    cut = {i: [[*v, *[0] * parts * width][p * width : (p + 1) * width] for p in range(parts)] for i, _, v in whole}
    books = [[cut[i][p] for i in sorted(cut)[:entries]] for p in range(parts)]
    distance = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    nearest = lambda p, part: min((distance(part, e), k) for k, e in enumerate(books[p]))
    for _ in range(rounds):
        members = {}
        for v in cut.values():
            for p in range(parts):
                members.setdefault((p, nearest(p, v[p])[1]), []).append(v[p])
        for (p, k), found in members.items():
            books[p][k] = [sum(x) // len(found) for x in zip(*found, strict=True)]
    best = {i: [nearest(p, v[p]) for p in range(parts)] for i, v in cut.items()}
    return {i: ("".join(f"{k:02x}" for _, k in b), sum(d for d, _ in b)) for i, b in best.items()}, books


def vectors_of(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<double>")


@pytest.mark.parametrize("salt_vectors", [2_048, 16])
def test_codes_against_brute_force(spark, monkeypatch, salt_vectors):
    monkeypatch.setattr(code_compression, "SALT_VECTORS", salt_vectors)
    rng = np.random.default_rng(8)
    rows = [(i, int(i) % 5 or None, (rng.integers(-3, 4, 32) + rng.normal(0, 0.3, 32)).tolist()) for i in range(300)]
    rows += [(i, 2, rows[7][2]) for i in range(300, 420)]  # a vector on many rows
    wanted, books = brute_codes(rows)
    kept = kept_vectors(vectors_of(spark, rows).repartition(5))
    found = lloyd_codebooks(kept)
    assert found.entries == books
    got = compress(kept, found).collect()
    assert {r.id: (r.code, r.error) for r in got} == wanted
    sums = Counter()
    for i, label, _ in rows:
        sums[label] += wanted[i][1]
    assert {r.label: r.label_error for r in got} == dict(sums)
    more, _ = brute_codes(rows, rounds=4)
    found = lloyd_codebooks(kept, rounds=4)
    assert {r.id: (r.code, r.error) for r in compress(kept, found).collect()} == more


@pytest.mark.parametrize("size", [1.0, 2.0**30, 2.0**70])
def test_codes_of_large_components(spark, size):
    rng = np.random.default_rng(9)
    rows = [(i, 1, (rng.normal(0, 1, 20) * (size if i % 9 == 0 else 1)).tolist()) for i in range(100)]
    wanted, books = brute_codes(rows)
    kept = kept_vectors(vectors_of(spark, rows))
    found = lloyd_codebooks(kept)
    assert found.entries == books
    got = compress(kept, found).collect()
    fits = lambda x: x if x < 2**63 else None
    assert {r.id: (r.code, r.error) for r in got} == {i: (c, fits(e)) for i, (c, e) in wanted.items()}
    total = None if any(fits(e) is None for _, e in wanted.values()) else fits(sum(e for _, e in wanted.values()))
    assert {r.label_error for r in got} == {total}


def test_codes_of_odd_rows(spark, tmp_path):
    nan, inf = float("nan"), float("inf")
    rows = [(1, 1, [0.5] * 16), (1, 1, [0.5] * 16), (2, 1, None), (3, 2, [nan] * 16), (4, 2, [inf] * 16), (5, 2, [None] * 16)]
    rows += [(6, None, [0.25] * 7), (7, None, []), (None, 3, [-0.001] * 16)]
    vectors = vectors_of(spark, rows).withColumn("code", F.lit("x")).withColumn("row", F.lit(1))
    kept = kept_vectors(vectors)
    books = lloyd_codebooks(kept)
    got = compress(kept, books).collect()
    assert Counter(r.id for r in got) == Counter([1, 1, 6, 7, None])
    assert {r.error for r in got} == {0} and {r.label_error for r in got} == {0}
    folder = tmp_path / "empty"
    vectors.where("vec_id = 2").select("vec_id", "label", "embedding").write.parquet(str(folder / "embeddings.parquet"))
    none = code_compression.op13_code_compression(spark, str(folder))
    assert none.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"] and none.count() == 0


def test_checksum_of_codebooks():
    books = code_compression.Codebooks([[[1, -2], [3, 4]], [[5, 6], [7, 8]]])
    assert books.sha256() == hashlib.sha256(b"1,-2,3,4,5,6,7,8").hexdigest()
