"""Text quality by a small byte-level convolutional network, all in numpy.

A byte is a learnt vector; ``FILTERS`` learnt filters look at ``WIDTH`` bytes each,
at every second byte. A document is covered by chunks of four blocks that overlap
by one block, and a filter's largest answer in a chunk stands for the chunk. Over
the chunks of a document the largest, mean and smallest of these are combined into
one probability. Nothing is cut off: a document of any length is chunks only.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revmap.llm import sequences as seq
from revmap.llm.sample import clean_labels, held_out, labelled_sample
from revmap.llm.store import documents, stored

#: Labelled documents that are learnt from, about; half of each label where there are enough.
SAMPLE_ROWS = 6_000
THRESHOLD = 0.3
FILTERS, WIDTH, DEPTH, STRIDE = 16, 8, 4, 2
#: Bytes of a block; chunks have CHUNK blocks and start HOP blocks apart.
BLOCK, CHUNK, HOP = 64, 4, 3
EPOCHS, DOCS_A_STEP, RATE = 8, 16, 0.01


class Network:
    """Parameters, and what they make of a buffer of texts."""

    NAMES = ("embed", "filters", "bias", "weight", "constant")

    def __init__(self, **parameters: np.ndarray):
        self.p = {k: np.asarray(parameters[k], np.float32) for k in self.NAMES}

    @classmethod
    def fresh(cls, seed: int = 1) -> Network:
        rng = np.random.default_rng(seed)
        return cls(
            embed=rng.normal(0, 0.5, (256, DEPTH)),
            filters=rng.normal(0, (WIDTH * DEPTH) ** -0.5, (WIDTH * DEPTH, FILTERS)),
            bias=np.zeros(FILTERS),
            weight=rng.normal(0, 0.05, 3 * FILTERS),
            constant=np.zeros(1),
        )

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **self.p)
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> Network:
        with np.load(io.BytesIO(data)) as parameters:
            return cls(**parameters)

    def forward(self, data: np.ndarray, places: np.ndarray, trace: bool = False):
        """Logits of the texts, and with ``trace`` what a step of learning needs."""
        lengths = np.diff(places)
        blocks = (lengths + WIDTH + BLOCK - 1) // BLOCK  # at least WIDTH zero bytes follow a text
        first = np.concatenate([[0], np.cumsum(blocks)])
        padded = np.zeros(first[-1] * BLOCK + BLOCK, np.uint8)
        padded[np.arange(len(data)) + np.repeat(first[:-1] * BLOCK - places[:-1], lengths)] = data
        vectors = self.p["embed"][padded]
        n = first[-1] * BLOCK
        # Filters at places r, r + WIDTH, r + 2 WIDTH, ... are one matrix product without a copy.
        answers = [
            vectors[r : r + n].reshape(-1, WIDTH * DEPTH) @ self.p["filters"] for r in range(0, WIDTH, STRIDE)
        ]
        per_block = np.stack([a.reshape(first[-1], BLOCK // WIDTH, FILTERS) for a in answers], axis=2).reshape(first[-1], -1, FILTERS)
        top = per_block.max(axis=1)
        chunks = np.maximum(1, -(-(blocks - 1) // HOP))
        chunk0 = np.concatenate([[0], np.cumsum(chunks)])
        of = np.repeat(np.arange(len(blocks)), chunks)
        start = np.minimum(HOP * (np.arange(chunk0[-1]) - chunk0[of]), np.maximum(blocks[of] - CHUNK, 0))
        member = np.minimum(start[:, None] + np.arange(CHUNK), blocks[of][:, None] - 1) + first[of][:, None]
        pooled = top[member].max(axis=1) + self.p["bias"]
        active = np.maximum(pooled, 0)
        at = chunk0[:-1]
        combined = np.concatenate(
            [np.maximum.reduceat(active, at), np.add.reduceat(active, at) / chunks[:, None], np.minimum.reduceat(active, at)], axis=1
        )
        logits = combined @ self.p["weight"] + self.p["constant"][0]
        return (logits, padded, per_block, top, member, pooled, active, of, chunks, combined) if trace else logits

    def gradients(self, data: np.ndarray, places: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        logits, padded, per_block, top, member, pooled, active, of, chunks, combined = self.forward(data, places, True)
        error = ((1 / (1 + np.exp(-np.clip(logits, -30, 30)))) - labels) / len(labels)
        back = error[:, None] * self.p["weight"]
        most, mean, least = (back[:, k * FILTERS : (k + 1) * FILTERS] for k in range(3))
        # The largest and the smallest answer pass their gradient to the chunks that
        # gave them, in equal parts: neighbours share a block and so, often, an answer.
        g = (mean / chunks[:, None])[of]
        at = np.cumsum(chunks) - chunks
        for part, k in ((most, 0), (least, 2)):
            gave = active == combined[of, k * FILTERS : (k + 1) * FILTERS]
            g = g + np.where(gave, (part / np.add.reduceat(gave, at))[of], 0)
        g = g * (pooled > 0)
        chosen = np.take_along_axis(member, top[member].argmax(axis=1), axis=1)
        slot = per_block.argmax(axis=1)[chosen, np.arange(FILTERS)]
        # A slot of a block is (row of WIDTH bytes, phase).
        phases = WIDTH // STRIDE
        place = chosen * BLOCK + slot // phases * WIDTH + slot % phases * STRIDE
        seen = padded[place[:, :, None] + np.arange(WIDTH)]
        vectors = self.p["embed"][seen].reshape(*place.shape, WIDTH * DEPTH)
        to_vectors = (g[:, :, None] * self.p["filters"].T[None]).reshape(*place.shape, WIDTH, DEPTH)
        embed = np.zeros_like(self.p["embed"])
        np.add.at(embed, seen.ravel(), to_vectors.reshape(-1, DEPTH))
        return {
            "embed": embed,
            "filters": np.einsum("cf,cfw->wf", g, vectors),
            "bias": g.sum(axis=0),
            "weight": error @ combined,
            "constant": np.array([error.sum()]),
        }


def train(texts: list[bytes], labels: np.ndarray, epochs: int = EPOCHS) -> Network:
    """Adam over shuffled documents, always in the same order."""
    network, rng = Network.fresh(), np.random.default_rng(2)
    mean = {k: np.zeros_like(v) for k, v in network.p.items()}
    square = {k: np.zeros_like(v) for k, v in network.p.items()}
    step, steps = 0, epochs * -(-len(texts) // DOCS_A_STEP)
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for a in range(0, len(order), DOCS_A_STEP):
            own = order[a : a + DOCS_A_STEP]
            data = np.frombuffer(b"".join(texts[i] for i in own), np.uint8)
            places = np.concatenate([[0], np.cumsum([len(texts[i]) for i in own])])
            rate = RATE * (1 - step / steps)
            step += 1
            for k, g in network.gradients(data, places, labels[own]).items():
                mean[k] += 0.1 * (g - mean[k])
                square[k] += 0.01 * (g * g - square[k])
                network.p[k] -= rate * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-8)
    return network


def _trained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    texts, labels = [], []
    for batch in batches:
        texts += [t.encode() for t in batch.column("text").to_pylist()]
        labels += batch.column("label").to_pylist()
    if texts:
        network = train(texts, np.array(labels, np.float32))
        yield pa.RecordBatch.from_arrays([pa.array([network.dump()], pa.binary())], ["network"])


def _scores(parameters: bytes, shift: float, text_col: str, names: list[str], score_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = Network.load(parameters)
        for batch in batches:
            data, places = seq.buffers(batch.column(text_col))
            logits = [network.forward(part, at) for _, _, part, at in seq.parts(data, places)]
            logit = np.concatenate(logits).astype(float) + shift if logits else np.zeros(0)
            score = 1 / (1 + np.exp(-np.clip(logit, -700, 700)))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(score)], [*names, score_col])

    return run


class QualityModel:
    """A trained network and the shift that undoes the balance of its sample."""

    def __init__(self, parameters: bytes, shift: float):
        self.parameters, self.shift = parameters, shift

    @classmethod
    def fit(cls, docs: DataFrame, labels: DataFrame, excluded, *, sample_rows: int = SAMPLE_ROWS) -> QualityModel:
        """Learn from about ``sample_rows`` labelled documents (``doc_id``, ``quality``)
        for which ``excluded`` (a condition on ``key``, the id) does not hold. The
        sample is bounded, so one task trains on it. With labels of one kind only,
        every score is that label; without labels, 0."""
        sample = stored(labelled_sample(docs, labels, "quality", excluded, sample_rows, balance=True), "quality-sample")
        taken = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
        if len(taken) < 2:
            only = Network.fresh()
            only.p["weight"][:] = 0
            return cls(only.dump(), 30.0 if 1 in taken else -30.0)
        known = clean_labels(labels, "quality", excluded).groupBy("label").count().collect()
        there = {r["label"]: r["count"] for r in known}
        shift = float(np.log(there[1] / there[0]) - np.log(taken[1] / taken[0]))
        network = sample.repartition(1).sortWithinPartitions("key").mapInArrow(_trained, "network binary").first()
        return cls(bytes(network.network), shift)

    def score(self, docs: DataFrame, *, text_col: str = "text", score_col: str = "score") -> DataFrame:
        """Add ``score_col``, 0 to 1 and higher for label 1. A null text is scored as
        an empty one; a column of that name is replaced."""
        names = [c for c in docs.columns if c != score_col]
        docs = docs.select(*(f"`{c}`" for c in names))
        schema = T.StructType([*docs.schema.fields, T.StructField(score_col, T.DoubleType())])
        return docs.mapInArrow(_scores(self.parameters, self.shift, text_col, names, score_col), schema)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs, labels = documents(spark, sf_dir).select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = QualityModel.fit(docs, labels, held_out(F.col("key"), 5, 0))
    return model.score(docs).select(
        "doc_id",
        held_out(F.col("doc_id"), 5, 0).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


QUERIES = {"op5_quality": op5_quality}
ORACLE: dict[str, str] = {}
