"""Benchmark passages, tokens, toxicity and quality."""

from __future__ import annotations

import base64
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from revmap.llm import byte_bpe, decontamination
from revmap.llm.byte_bpe import VOCABULARY, Codec, Tokenizer, read_ranks
from revmap.llm.decontamination import contamination, original_spans, without_passages
from revmap.llm.quality import Network, QualityModel, train
from revmap.llm.sample import held_out
from revmap.llm.token_counts import cut_total, length_histogram, op7_token_counts, quantile_limit, suffix_sums
from revmap.llm.toxicity import Lexicon, Restorer, ToxicityModel, character_model, logistic_regression

PATH = public_tokenizers.path(VOCABULARY)
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def usual():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_passages_and_their_places(spark, prose):
    item = prose(20, 1)
    words = item.split()
    docs = spark.createDataFrame(
        [(1, f"Start, {'; '.join(words).upper()}! end"), (2, " ".join(words[3:15])), (3, f"x {' '.join(words[3:16])} y"), (4, None), (5, "Tiny-item")],
        "doc_id bigint, text string",
    )
    items = spark.createDataFrame([(10, item), (9, item), (11, "tiny item"), (12, None), (13, " . "), (None, item)], "item_id bigint, text string")
    got = {r.doc_id: r for r in contamination(docs, items).collect()}
    assert [(got[i].n_words, got[i].n_hit, got[i].items) for i in range(1, 6)] == [
        (22, 20, ["10", "9"]), (12, 0, []), (15, 13, ["10", "9"]), (0, 0, []), (2, 2, ["11"]),
    ]
    assert [got[i].contaminated for i in range(1, 6)] == [True, False, True, False, True]
    text = got[1].text
    (span,) = original_spans(text, [(s.start, s.end) for s in got[1].spans])
    assert text[slice(*span)] == "; ".join(words).upper()
    cut = {r.doc_id: r.text for r in without_passages(contamination(docs, items)).collect()}
    assert cut[1] == "Start, ! end" and cut[3] == "x  y" and cut[4] is None
    # Several automata find what one finds.
    small = {r.doc_id: r for r in contamination(docs, items, block_bytes=50).collect()}
    assert small == got
    assert contamination(docs, items.limit(0)).where("n_hit > 0").count() == 0
    assert contamination(docs.limit(0), items).count() == 0


def test_passages_of_odd_rows(odd, spark):
    items = spark.createDataFrame([(1, "short"), (1, "short")], "item_id bigint, text string")
    got = contamination(odd.withColumn("spans", F.lit(0)), items).collect()
    assert len(got) == 10 and [r.doc_id for r in got if r.n_hit] == [5]
    assert decontamination.normal_words("Ab-9_ñ") == [b"ab", b"9", "ñ".encode()]


def test_tokens_are_the_usual_ones(usual):
    rng = random.Random(5)
    texts = ["", " ", "a", "  \n\n x ", "it's WE'LL  o'clock", "½ ⅷ x²\x1c\x1d\x85é", "aaaa" * 300, "x" * 3000, "中文字符" * 300, "<|endoftext|>"]
    texts += ["".join(rng.choice("abcdefgh") for _ in range(1500))]
    texts += ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(160, 0x3000), rng.randrange(0x1F300, 0x1F700)])) for _ in range(200)) for _ in range(30)]
    codec = Codec(read_ranks(PATH), public_tokenizers.PATTERN)
    ids = codec.encode(texts)
    assert ids == [usual.encode_ordinary(t) for t in texts]
    assert codec.count(texts) == [len(i) for i in ids]
    assert [codec.decode(i) for i in ids] == [t.encode() for t in texts]


def test_encoding_columns(odd, usual, spark):
    tokenizer = Tokenizer(spark, PATH)
    got = tokenizer.decode(tokenizer.encode(odd.withColumn("ids", F.lit("clash")))).collect()
    assert len(got) == 10
    for r in got:
        assert r.ids == usual.encode_ordinary(r.text or "") and bytes(r.decoded) == (r.text or "").encode()
    assert tokenizer.encode(odd.limit(0)).count() == 0
    with pytest.raises(ValueError):
        byte_bpe.MAX_VOCABULARY_BYTES, keep = 10, byte_bpe.MAX_VOCABULARY_BYTES
        try:
            read_ranks(PATH)
        finally:
            byte_bpe.MAX_VOCABULARY_BYTES = keep


def test_token_counts_against_brute_force(spark, usual):
    texts = [r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    lengths = [len(usual.encode_ordinary(t)) for t in texts]
    got = {r.n_tokens: r for r in op7_token_counts(spark, SF).collect()}
    assert set(got) == set(lengths)
    for limit, r in got.items():
        assert r.docs == lengths.count(limit) and r.tokens == limit * r.docs
        assert (r.docs_at_least, r.tokens_at_least) == (sum(x >= limit for x in lengths), sum(x for x in lengths if x >= limit))
        assert r.docs_within == sum(x <= limit for x in lengths)
        assert (r.tokens_cut, r.tokens_all) == (sum(min(x, limit) for x in lengths), sum(lengths))


def test_limits_and_quantiles(spark):
    lengths = [0, 0, 3, 5, 5, 9, 4000, None]
    sums = suffix_sums(length_histogram(spark.createDataFrame([(x,) for x in lengths], "n_tokens bigint")))
    assert [quantile_limit(sums, q).first()[0] for q in (0.2, 0.5, 1.0)] == [0, 5, 4000]
    for limit in (0, 4, 5, 100, 5000):
        r = cut_total(sums, limit).first()
        assert (r.docs_cut, r.tokens_cut) == (sum(x > limit for x in lengths if x is not None), sum(min(x, limit) for x in lengths if x is not None))
    empty = suffix_sums(length_histogram(spark.createDataFrame([], "n_tokens bigint")))
    assert empty.count() == 0 and quantile_limit(empty, 0.5).first()[0] is None


def test_disguised_words_are_read(spark):
    docs = spark.createDataFrame([("you idiot and loser are so stupid the moron is disgusting trash " * 50,)], "text string")
    restorer = Restorer(character_model(docs))
    read = lambda t: restorer.restore(t.encode()).decode()
    for hidden, plain in {"1d10t": "idiot", "i d i o t": "idiot", "s.t.u.p.i.d": "stupid", "loooooser": "loser", "TR@SH!!": "trash!!", "d1$gu$t1ng": "disgusting", "the m0r0n is": "the moron is"}.items():
        assert read(hidden) == plain
    for plain in ("", "plain words", "room 12", "a b", "!!! ???"):
        assert read(plain) == plain


@pytest.mark.parametrize("hidden", ["a s s", "a,s,s", "i/d/i/o/t", "i,d,i,o,t", "i - d - i - o - t", "i  d  i  o  t", "id iot", "id-i.ot", "iddiiott", "1dd1ioott", "st upp1d", "@$$", "i!d!i!o!t", "i\u200bd\u200bi\u200bo\u200bt", "id\u00a0iot"])
def test_hidden_words_of_the_lexicon_are_read(spark, hidden):
    import pyarrow as pa

    docs = spark.createDataFrame([("you idiot and loser are so stupid the moron is an ass and of hers a hello that was " * 50,)], "text string")
    restorer = Restorer(character_model(docs), Lexicon({b"idiot": 3.0, b"ass": 3.0, b"stup*": 3.0}))
    for text in (hidden, f"so {hidden}", f"that {hidden} was", f"hello ({hidden.upper()})!"):
        # Between texts that begin and end with letters.
        (_, read, _) = restorer.batch(pa.array(["was", text, "was"]))
        assert {b"idiot", b"ass", b"stupid"} & set(read.replace(b"!", b" ").replace(b")", b" ").replace(b"(", b" ").split()), read
        assert restorer.restore(text.encode()) == read
    for plain in ("as so hers", "that was a", "455", "4 5 5", "hello as", "assume", "an idea"):
        assert list(restorer.batch(pa.array([plain]))) == [plain.encode()]


def test_a_word_in_few_documents_of_many_is_learnt(spark):
    rng = random.Random(9)
    common = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(200)]
    rows = []
    for i in range(8000):
        # The rare word is in less than a hundredth of the documents of label 1.
        words = rng.choices(common, k=12) + ([] if i % 5 else ["vermin"] if i < 60 else ["idiot"])
        rows.append((i, " ".join(words), int(i % 5 == 0)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    model = ToxicityModel.fit(docs, docs, F.lit(False))
    assert b"vermin" in model.lexicon.entries() and not set(map(str.encode, common)) & set(model.lexicon.entries())


def test_toxicity_on_rows_held_out(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    model = ToxicityModel.fit(docs, labels, held_out(F.col("key"), 4, 2))
    scored = model.score(docs).join(labels, "doc_id").where(held_out(F.col("doc_id"), 4, 2)).select("score", "toxic").collect()
    assert all(0 <= r.score <= 1 for r in scored)
    assert sum((r.score >= 0.3) == (r.toxic == 1) for r in scored) >= 0.9 * len(scored)


def test_scores_of_odd_rows(odd, spark):
    labels = spark.createDataFrame([(1, 1, 0), (5, 0, 1), (6, 1, None), (None, 0, 1), (7, 0, 0), (7, 1, 1)], "doc_id bigint, quality int, toxic int")
    nobody = F.lit(False)
    for model in (ToxicityModel.fit(odd, labels, nobody), QualityModel.fit(odd, labels, nobody), ToxicityModel.fit(odd, labels.limit(0), nobody), QualityModel.fit(odd.limit(0), labels.limit(0), nobody)):
        scores = [r.score for r in model.score(odd.withColumn("score", F.lit("clash"))).collect()]
        assert len(scores) == 10 and all(0 <= s <= 1 for s in scores)
        assert model.score(odd.limit(0)).count() == 0


def test_quality_learns_nothing_from_held_out_labels(spark, make, prose):
    docs = make(*(prose(20, k) for k in range(60)))
    labels = docs.select("doc_id", (F.col("doc_id") % 3 == 0).cast("int").alias("quality"))
    contradicting = labels.unionByName(labels.where("doc_id < 20 AND quality = 1").withColumn("quality", F.lit(0)))
    out = held_out(F.col("doc_id"), 5, 0)
    one = QualityModel.fit(docs, labels, held_out(F.col("key"), 5, 0))
    # Other labels of rows held out, and other numbers of them.
    for other in (labels.withColumn("quality", F.when(out, F.lit(1)).otherwise(F.col("quality"))), labels.where(~out)):
        two = QualityModel.fit(docs, other, held_out(F.col("key"), 5, 0))
        assert (two.shift, two.parameters) == (one.shift, one.parameters)
    # Ids with contradicting labels are in neither count.
    clean = labels.join(contradicting.groupBy("doc_id").count().where("count = 1"), "doc_id", "left_semi")
    a, b = (QualityModel.fit(docs, x, F.lit(False)) for x in (contradicting, clean))
    assert (a.shift, a.parameters) == (b.shift, b.parameters)


def test_samples_are_as_large_as_documented():
    from pathlib import Path

    from revmap.llm import quality, toxicity

    text = " ".join((Path(__file__).parents[2] / "README.md").read_text().split())
    assert f"(`SAMPLE_ROWS`, about {toxicity.SAMPLE_ROWS:,} and {quality.SAMPLE_ROWS:,})" in text
    assert f"from {quality.SAMPLE_ROWS:,} documents in {quality.EPOCHS} rounds" in text


def test_logistic_regression():
    x = np.linspace(-2, 2, 200)[:, None]
    w = logistic_regression(x, (x[:, 0] > 0.5).astype(float))
    assert w[0] > 1 and w[0] * 1.5 + w[1] > 0 > w[0] * -0.5 + w[1]


def test_network_gradients():
    rng = np.random.default_rng(0)
    network = Network.fresh()
    network.p = {k: v.astype(float) for k, v in network.p.items()}
    network.p["weight"] = rng.normal(0, 0.3, len(network.p["weight"]))
    texts = [rng.integers(1, 255, n, dtype=np.uint8).tobytes() for n in (700, 90, 0, 3)]
    data, places = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    labels = np.array([1.0, 0, 1, 0])

    def loss():
        z = network.forward(data, places)
        return np.mean(np.log1p(np.exp(z)) - labels * z)

    gradients = network.gradients(data, places, labels)
    for name, values in network.p.items():
        at = np.unravel_index(np.abs(gradients[name]).argmax(), values.shape)
        keep, step = values[at], 1e-6
        values[at] = keep + step
        up = loss()
        values[at] = keep - step
        down = loss()
        values[at] = keep
        assert (up - down) / (2 * step) == pytest.approx(gradients[name][at], rel=1e-3, abs=1e-7)


def test_network_learns_and_covers_a_whole_text(prose):
    good, bad = [prose(60, k).encode() for k in range(40)], [b"&&& " .join(prose(60, 100 + k).encode().split()) for k in range(40)]
    network = train(good + bad, np.array([1] * 40 + [0] * 40, np.float32), epochs=6)
    score = lambda t: float(network.forward(np.frombuffer(t, np.uint8), np.array([0, len(t)]))[0])
    assert score(prose(60, 500).encode()) > 0 > score(b"&&& ".join(prose(60, 501).encode().split()))
    # What stands at the very end of a long text counts.
    long = prose(3000, 502).encode()
    assert score(long + b" &&& &&& &&&") != score(long)
    assert Network.load(network.dump()).forward(np.frombuffer(long, np.uint8), np.array([0, len(long)])) == network.forward(np.frombuffer(long, np.uint8), np.array([0, len(long)]))
