"""Shards, nearest vectors, the pipeline, and every query against its SQL."""

from __future__ import annotations

import random

import numpy as np
import pytest
from compare import connect, difference
from pyspark.sql import functions as F

import corpus_pipeline
from revmap.llm import kd_sharding, voronoi_topk
from revmap.llm.kd_sharding import kd_shards, write_shards
from revmap.llm.voronoi_topk import top_k

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(corpus_pipeline.ORACLE))
def test_query_matches_sql(spark, name):
    assert difference(corpus_pipeline.QUERIES[name](spark, SF), connect(SF), corpus_pipeline.ORACLE[name]) is None


def _check_shards(rows, shards):
    for s in {r.shard for r in rows}:
        slots = sorted(r.slot for r in rows if r.shard == s)
        assert 0 <= s < shards and slots == list(range(len(slots)))


def test_shards_are_near_equal(spark, prose):
    rng = random.Random(3)
    rows = [(i, prose(rng.randint(1, 60), i), rng.choice("ab"), rng.choice("xyz")) for i in range(3000)]
    rows += [(i, rows[5][1], "a", "x") for i in range(3000, 4500)]  # one text on a third of the rows
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    got = kd_shards(docs, shards=7).collect()
    assert sorted(r.doc_id for r in got) == list(range(4500))
    _check_shards(got, 7)
    size = [sum(r.size for r in got if r.shard == s) for s in range(7)]
    assert max(size) <= 1.03 * sum(size) / 7 and min(size) >= 0.97 * sum(size) / 7
    by_text = {}
    for r in got:
        if r.doc_id < 3000 and r.doc_id != 5:
            by_text.setdefault(r.text_crc32, set()).add(r.shard)
    assert all(len(s) == 1 for s in by_text.values())


def test_shards_of_odd_rows_and_files(odd, spark, tmp_path):
    got = kd_shards(odd, shards=3).collect()
    assert len(got) == 10
    _check_shards(got, 3)
    assert {r.size for r in got if r.doc_id in (2, 3)} == {16}
    assert kd_shards(odd.limit(0), shards=3).count() == 0
    assert {r.shard for r in kd_shards(odd, target_bytes=10**9).collect()} == {0}
    one = odd.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    write_shards(one, kd_shards(one, shards=2), str(tmp_path / "shards"))
    assert spark.read.parquet(str(tmp_path / "shards")).count() == one.count()


def brute_top(rows, queries, k):
    return {
        q: sorted(((-int(np.dot(v, w)), j) for j, w in rows if j != q), key=lambda x: x)[:k] for q, v in rows if q in queries
    }


@pytest.mark.parametrize("block", [8192, 7])
def test_top_k_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(voronoi_topk, "BLOCK_VECTORS", block)
    monkeypatch.setattr(voronoi_topk, "BLOCK_QUERIES", block)
    rng = np.random.default_rng(4)
    centres = rng.integers(-60, 60, (6, 8))
    vectors = [(centres[i % 6] + rng.integers(-4, 5, 8)).tolist() for i in range(300)] + [centres[0].tolist()] * 90
    rows = [(i, v) for i, v in enumerate(vectors)]
    got = top_k(spark.createDataFrame(rows, "vec_id bigint, v array<bigint>"), F.col("vec_id") % 10 == 0, k=5).collect()
    wanted = brute_top(rows, {i for i, _ in rows if i % 10 == 0}, 5)
    found = {}
    for r in got:
        found.setdefault(r.query_id, []).append((r["rank"], -r.score, r.vec_id))
    assert {q: [x[1:] for x in sorted(f)] for q, f in found.items()} == wanted


def test_top_k_copies_neither_side(spark, monkeypatch):
    """Vectors that no bound prunes: every query needs every cell. Nothing stored has a row for each pair of
    them, and a task keeps k + 1 rows a query."""
    frames, kept = {}, voronoi_topk.stored

    def counted(df, label):
        out = kept(df, label)
        frames[label] = max(frames.get(label, 0), out.count())
        return out

    monkeypatch.setattr(voronoi_topk, "stored", counted)
    rng = np.random.default_rng(9)
    unit = rng.normal(size=(900, 16))
    unit = np.floor(64 * unit / np.linalg.norm(unit, axis=1)[:, None]).astype(int).tolist()
    rows = list(enumerate(unit))
    got = top_k(spark.createDataFrame(rows, "vec_id bigint, v array<bigint>"), F.col("vec_id") % 3 == 0, k=5).collect()
    found = {}
    for r in got:
        found.setdefault(r.query_id, []).append((r["rank"], -r.score, r.vec_id))
    assert {q: [x[1:] for x in sorted(f)] for q, f in found.items()} == brute_top(rows, set(range(0, 900, 3)), 5)
    assert max(frames.values()) <= 900, frames


def test_top_k_in_rounds_at_once(spark, monkeypatch):
    """Several rounds in one job, of cells and of parts of a cell with many queries; equal and longer vectors among them."""
    monkeypatch.setattr(voronoi_topk, "PARTS", 2)
    monkeypatch.setattr(voronoi_topk, "BLOCK_QUERIES", 40)
    monkeypatch.setattr(voronoi_topk, "UNSORTED", 8)
    rng = np.random.default_rng(5)
    vectors = rng.integers(-3, 4, (260, 4)).tolist() + [[70000, 1, 2, 3]] * 3 + [[1, 2, 3, 4]] * 9
    rows = list(enumerate(vectors))
    got = top_k(spark.createDataFrame(rows, "vec_id bigint, v array<bigint>"), F.lit(True), k=4).collect()
    found = {}
    for r in got:
        found.setdefault(r.query_id, []).append((r["rank"], -r.score, r.vec_id))
    assert {q: [x[1:] for x in sorted(f)] for q, f in found.items()} == brute_top(rows, set(range(272)), 4)


def test_top_k_of_odd_vectors(spark):
    rows = [(0, [1, 2]), (0, [1, 2]), (1, None), (2, [1, None]), (3, [5]), (None, [9, 9]), (4, []), (10, [1, 2])]
    vectors = spark.createDataFrame(rows, "vec_id bigint, v array<bigint>")
    got = sorted(tuple(r) for r in top_k(vectors, F.col("vec_id") % 10 == 0, k=3).collect())
    assert got == [(0, 1, 3, 5), (0, 2, 10, 5), (0, 3, 4, 0), (10, 1, 0, 5), (10, 2, 3, 5), (10, 3, 4, 0)]
    assert top_k(vectors.limit(0), F.col("vec_id") % 10 == 0).count() == 0
    assert top_k(vectors, F.lit(False)).count() == 0
    with pytest.raises(ValueError):
        top_k(spark.createDataFrame([(0, [2**21])], "vec_id bigint, v array<bigint>"), F.lit(True))


@pytest.mark.parametrize("size", [2**21, 2**27, 2**29])
def test_top_k_of_large_components(spark, size):
    rng = np.random.default_rng(6)
    rows = [(i, [int(x) for x in rng.integers(-9, 10, 6)]) for i in range(120)]
    # Scores of these differ by less than float64 can tell at 2^58.
    rows += [(i, [size + int(x) for x in rng.integers(-2, 3, 6)]) for i in range(120, 200)]
    got = top_k(spark.createDataFrame(rows, "vec_id bigint, v array<bigint>"), F.col("vec_id") % 10 == 0, k=5, largest=None).collect()
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=True))
    for q, v in rows[::10]:
        wanted = sorted((-dot(v, w), j) for j, w in rows if j != q)[:5]
        assert sorted((r["rank"], -r.score, r.vec_id) for r in got if r.query_id == q) == [(n, *x) for n, x in enumerate(wanted, 1)]


def test_query_answers_a_vector_with_a_large_component(spark, tmp_path):
    rows = [(i, [float(i), 1.0]) for i in range(40)] + [(40, [40000.0, 1.0])]
    spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").write.parquet(str(tmp_path / "embeddings.parquet"))
    got = voronoi_topk.op6_voronoi_topk(spark, str(tmp_path)).where("rank = 1").collect()
    assert {r.query_id: r.vec_id for r in got} == {0: 1, 20: 40, 40: 39}


def test_pipeline(spark, tmp_path):
    """Each stage's effect on its whole input, by the operators' SQL, brute force or the usual library."""
    import base64

    import public_tokenizers
    import tiktoken
    from test_dedup import brute_words

    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    frames = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = corpus_pipeline.stored(stage(spark, docs, sf), name)
        frames[name] = (before, docs)
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    for before, after in frames.values():
        assert after.columns[:5] == columns and after.count() <= before.count()
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    count = lambda f: {r.toxic: r["count"] for r in f.join(labels, "doc_id").groupBy("toxic").count().collect()}
    before, after = (count(f) for f in frames["toxicity"])
    # There are only some forty toxic documents to learn from here.
    assert after[1] <= 0.5 * before[1] and after[0] >= 0.97 * before[0]

    def by_sql(name, query):
        """Rows of an operator's SQL over what its stage was given."""
        path = str(tmp_path / name)
        frames[name][0].select(*columns).write.parquet(path)
        con = connect(sf)
        con.execute(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{path}/*.parquet'")
        cursor = con.execute(corpus_pipeline.ORACLE[query])
        names = [c[0] for c in cursor.description]
        return [dict(zip(names, row, strict=True)) for row in cursor.fetchall()]

    ids = lambda f: {r.doc_id for r in f.select("doc_id").collect()}
    near = by_sql("minhash_dedup", "op8_minhash_dedup")
    assert {r["doc_id"] for r in near if r["kept"]} == ids(frames["minhash_dedup"][1]) != ids(frames["minhash_dedup"][0])
    before, after = ([(r.doc_id, r.text) for r in f.collect()] for f in frames["substring_dedup"])
    assert {i: t.split() for i, t in after} == brute_words(before, 50)
    found = by_sql("decontamination", "op1_decontamination")
    assert {r["doc_id"] for r in found if not r["contaminated"]} == ids(frames["decontamination"][1]) != ids(frames["decontamination"][0])
    before, last = frames["byte_bpe"]
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    usual = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    assert {r.doc_id: list(r.ids) for r in last.collect()} == {r.doc_id: usual(r.text or "") for r in before.collect()}
    assert last.where("round_trip AND n_tokens = size(ids)").count() == before.count()


def test_stages_take_odd_and_empty_rows(spark, odd):
    for docs, most in ((odd, 9), (odd.limit(0), 0)):
        for _, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.stored(stage(spark, docs, SF), "odd")
        assert docs.count() <= most and docs.where("NOT round_trip").count() == 0


def test_every_operator_is_registered():
    names = {n.split("_")[0] for n in corpus_pipeline.QUERIES}
    assert names == {"pipeline", *(f"op{n}" for n in range(1, 14))}
    assert kd_sharding.SHARDS == 40
