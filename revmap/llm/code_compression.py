"""Product codes of vectors, with codebooks by member-resident Lloyd rounds.

Vectors are cut into equal parts, each with a codebook for its position. The parts
are dealt out once by (position, entry, salt) and stay with the owners of their
entries. In a round the owners sum their resident members for the new entries, then
look for the nearest of these; only parts whose entry changes are written again, by
the owner they move to. What was stored is never rewritten: a part is still resident
where it was stored as long as the codebooks since then gave it the same entry.

All arithmetic is on integers: 64-bit where nothing can pass them, else Python's.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revmap.llm.store import stored, table

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
#: Vectors for one salt: an entry that many parts share has more owners on more rows.
SALT_VECTORS = 2_048
#: Vectors that are compared with a codebook at once.
BLOCK = 4_096

#: Rows of the sums and of the members that move, from one reading of stored members.
_ROUND = "position int, entry int, salt long, places binary, parts binary, n long, sums string"


@dataclass(frozen=True)
class Codebooks:
    """entries[position][entry] is a list of integers."""

    entries: list[list[list[int]]]

    def sha256(self) -> str:
        """Of all components as decimals, by position, entry and place, joined by commas."""
        numbers = (str(x) for book in self.entries for entry in book for x in entry)
        return hashlib.sha256(",".join(numbers).encode()).hexdigest()


def _whole(x: np.ndarray) -> np.ndarray:
    """floor(SCALE * x), as int64 if all fit with room to spare, else as Python integers."""
    if not x.size or np.abs(x).max() < 2.0**50:
        return np.floor(x * SCALE).astype(np.int64)
    small = np.abs(x) < 2.0**50
    out = np.empty(x.shape, object)
    out[small] = np.floor(x[small] * SCALE).astype(np.int64).tolist()
    out[~small] = [int(v) * SCALE for v in x[~small].tolist()]
    return out


class _Nearest:
    """The nearest entry of one position's codebook."""

    def __init__(self, book: list[list[int]]):
        self._largest = max((abs(x) for entry in book for x in entry), default=0)
        self._book = np.array(book, np.int64 if self._largest < 2**62 else object)

    def __call__(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each part: the entry, ties to the lower index, and the squared distance."""
        width = parts.shape[1]
        exact = [_limit(parts), self._largest]
        if width and 4 * width * max(exact) ** 2 < 2**53:
            # Sums of products below 2^53 are exact as float64, in any order.
            left, book = parts.astype(np.float64), self._book.astype(np.float64)
            entry, error = np.empty(len(parts), np.int64), np.empty(len(parts), np.int64)
            norms = (book**2).sum(axis=1)
            for at in range(0, len(parts), BLOCK):
                block = left[at : at + BLOCK]
                distance = norms - 2 * (block @ book.T)
                entry[at : at + BLOCK] = best = distance.argmin(axis=1)
                error[at : at + BLOCK] = distance[np.arange(len(block)), best] + (block**2).sum(axis=1)
            return entry, error
        small = np.array([max(map(abs, p), default=0) < 2**20 for p in parts.tolist()]) if width else np.ones(len(parts), bool)
        if width and small.any() and not small.all() and 4 * width * max(2**20, self._largest) ** 2 < 2**53:
            # Only the large ones go the long way.
            entry, error = np.empty(len(parts), np.int64), np.empty(len(parts), object)
            for rows in (small, ~small):
                entry[rows], error[rows] = self(parts[rows].astype(np.int64) if rows is small else parts[rows])
            return entry, error
        book = self._book.tolist()
        found = []
        for part in parts.tolist():
            distances = [sum((a - b) ** 2 for a, b in zip(part, c, strict=True)) for c in book]
            best = min(range(len(book)), key=distances.__getitem__)
            found.append((best, distances[best]))
        return np.array([f[0] for f in found], np.int64), np.array([f[1] for f in found] or [0], object)[: len(found)]


def _limit(parts: np.ndarray) -> int:
    return max(map(abs, (int(parts.min()), int(parts.max()))), default=0) if parts.size else 0


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column as float64 rows of ``width``; shorter vectors are filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    size = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), width))
    out[np.arange(width) < size[:, None]] = values
    return out


class _Sums:
    """Count and sum of the members of each (position, entry) that a task has seen."""

    def __init__(self):
        self._n, self._sum = defaultdict(int), {}

    def add(self, position: int, entry: np.ndarray, parts: np.ndarray) -> None:
        if parts.dtype != object and _limit(parts) * max(1, len(parts)) >= 2**62:
            parts = parts.astype(object)
        order = np.argsort(entry, kind="stable")
        found, first, count = np.unique(entry[order], return_index=True, return_counts=True)
        if not len(found):
            return
        sums = np.add.reduceat(parts[order], first, axis=0)
        for e, n, s in zip(found.tolist(), count.tolist(), sums.tolist(), strict=True):
            key = position, e
            self._n[key] += n
            self._sum[key] = [a + int(b) for a, b in zip(self._sum[key], s, strict=True)] if key in self._sum else list(map(int, s))

    def rows(self) -> list[dict]:
        return [
            {"position": p, "entry": e, "n": n, "sums": ",".join(map(str, self._sum[p, e]))} for (p, e), n in self._n.items()
        ]


def _members(position: int, entry: np.ndarray, places: np.ndarray, raw: np.ndarray, salts: int) -> list[dict]:
    """Members in packed rows, one for each entry and salt."""
    if not len(entry):
        return []
    owner = entry * salts + places % salts
    order = np.argsort(owner, kind="stable")
    found, first = np.unique(owner[order], return_index=True)
    out = []
    for o, at in zip(found.tolist(), np.split(order, first[1:]), strict=True):
        out.append(
            {
                "position": position,
                "entry": o // salts,
                "salt": o % salts,
                "places": places[at].astype("<i8").tobytes(),
                "parts": raw[at].astype("<f8").tobytes(),
            }
        )
    return out


_ROWS = pa.schema(
    [("position", pa.int32()), ("entry", pa.int32()), ("salt", pa.int64()), ("places", pa.binary()), ("parts", pa.binary()), ("n", pa.int64()), ("sums", pa.string())]
)


def _deal(books: Codebooks, width: int, salts: int):
    """Each part to the owner of its nearest entry."""

    def run(batches):
        nearest = [_Nearest(b) for b in books.entries]
        for batch in batches:
            places = batch.column(0).to_numpy()
            raw = _matrix(batch.column(1), width * PARTS)
            for p in range(PARTS):
                part = raw[:, p * width : (p + 1) * width]
                rows = _members(p, nearest[p](_whole(part))[0], places, part, salts)
                yield pa.RecordBatch.from_pylist(rows, _ROWS)

    return run


def _round(since: list[Codebooks], width: int, salts: int):
    """Owners read their members. ``since`` are the codebooks made after these were
    stored: members that left for an earlier one are passed over, those that leave for
    the last one are returned to be moved, and all that stay are summed."""

    def run(batches):
        nearest = [[_Nearest(b) for b in books.entries] for books in since]
        sums = _Sums()
        for batch in batches:
            moved = []
            for row in batch.to_pylist():
                p, home = row["position"], row["entry"]
                places = np.frombuffer(row["places"], "<i8")
                raw = np.frombuffer(row["parts"], "<f8").reshape(len(places), width)
                parts = _whole(raw)
                for books in nearest[:-1]:
                    stay = books[p](parts)[0] == home
                    places, raw, parts = places[stay], raw[stay], parts[stay]
                entry = nearest[-1][p](parts)[0] if nearest else np.full(len(parts), home)
                gone = entry != home
                moved += _members(p, entry[gone], places[gone], raw[gone], salts)
                sums.add(p, entry[~gone], parts[~gone])
            yield pa.RecordBatch.from_pylist(moved, _ROWS)
        yield pa.RecordBatch.from_pylist(sums.rows(), _ROWS)

    return run


def _add_up(key, rows):
    """One row of sums; there is one from each task for a (position, entry)."""
    total = None
    for text in rows.column("sums").to_pylist():
        numbers = [int(x) for x in text.split(",")] if text else []
        total = numbers if total is None else [a + b for a, b in zip(total, numbers, strict=True)]
    return pa.table(
        {
            "position": rows.column("position")[:1],
            "entry": rows.column("entry")[:1],
            "n": pa.array([sum(rows.column("n").to_pylist())], pa.int64()),
            "sums": pa.array([",".join(map(str, total))], pa.string()),
        }
    )


def _updated(books: Codebooks, sums: DataFrame) -> Codebooks:
    """Each entry becomes the floor of its members' mean; unused entries stay."""
    added = sums.groupBy("position", "entry").applyInArrow(_add_up, "position int, entry int, n long, sums string")
    entries = [[list(e) for e in book] for book in books.entries]
    for row in added.collect():  # at most one row for each entry of the codebooks
        entries[row.position][row.entry] = [int(x) // row.n for x in row.sums.split(",")] if row.sums else []
    return Codebooks(entries)


def _owned(members: DataFrame, label: str) -> DataFrame:
    """Members stored by owner."""
    return stored(members.select("position", "entry", "salt", "places", "parts").repartition("position", "entry", "salt"), label)


def kept_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(row, id, label, v) of vectors that are not null and hold neither null nor
    non-finite components, stored; ``row`` tells rows apart that repeat an id."""
    v = F.col(f"`{vector_col}`").cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))  # NaN is above infinity
    rows = vectors.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").alias("label"), v.alias("v"))
    return stored(rows.where(F.col("v").isNotNull() & finite).withColumn("row", F.monotonically_increasing_id()), "vectors")


def lloyd_codebooks(kept: DataFrame, *, rounds: int = ROUNDS, entries: int = ENTRIES) -> Codebooks | None:
    """Codebooks of vectors from ``kept_vectors``; None if there are none.

    Entries start as the parts of the vectors with the smallest ids (without an id:
    last; ties by the vector). There are fewer than ``entries`` if there are fewer
    vectors. Vectors shorter than the longest, or whose length is no multiple of PARTS,
    are filled up with zeros. A codebook of ENTRIES entries is all that reaches the
    driver or is sent to tasks, so its size depends on the length of vectors alone.
    """
    n, longest = kept.agg(F.count("*"), F.max(F.size("v"))).first()
    if not n:
        return None
    width = -(-longest // PARTS)
    first = kept.orderBy(F.asc_nulls_last("id"), "v").limit(entries).select("v").collect()
    start = np.zeros((len(first), width * PARTS))
    for i, r in enumerate(first):
        start[i, : len(r.v)] = r.v
    whole = _whole(start)
    books = Codebooks([[e[p * width : (p + 1) * width] for e in whole.tolist()] for p in range(PARTS)])
    if not rounds:
        return books
    salts = -(-n // SALT_VECTORS)
    members = [_owned(kept.select("row", "v").mapInArrow(_deal(books, width, salts), _ROUND), "members")]
    history = [books]
    for k in range(1, rounds + 1):
        found, moved = [], None
        for at, resident in enumerate(members):
            # Members stored after codebook ``at`` was made; the codebooks since then decide who is still there.
            rows = resident.selectExpr("*", "CAST(NULL AS LONG) AS n", "CAST(NULL AS STRING) AS sums")
            found.append(stored(rows.mapInArrow(_round(history[at + 1 :], width, salts), _ROUND), "round"))
        moves = [f.where("places IS NOT NULL") for f in found if k > 1]
        sums = [f.where("sums IS NOT NULL").select("position", "entry", "n", "sums") for f in found]
        if moves:
            for f in moves[1:]:
                moves[0] = moves[0].union(f)
            moved = _owned(moves[0], "members")
            rows = moved.selectExpr("*", "CAST(NULL AS LONG) AS n", "CAST(NULL AS STRING) AS sums")
            sums.append(rows.mapInArrow(_round([], width, salts), _ROUND).select("position", "entry", "n", "sums"))
            members.append(moved)
        for f in sums[1:]:
            sums[0] = sums[0].union(f)
        history.append(_updated(history[-1], sums[0]))
    return history[-1]


def _coder(books: Codebooks, width: int, names: list[str]):
    def run(batches):
        nearest = [_Nearest(b) for b in books.entries]
        for batch in batches:
            raw = _matrix(batch.column("v"), width * PARTS)
            codes, errors = np.zeros((len(raw), PARTS), np.int64), np.zeros(len(raw), object)
            for p in range(PARTS):
                codes[:, p], error = nearest[p](_whole(raw[:, p * width : (p + 1) * width]))
                errors += error
            text = ["".join(f"{c:02x}" for c in row) for row in codes.tolist()]
            # A distance beyond a bigint has no value there.
            size = [e if e < 2**63 else None for e in map(int, errors)]
            columns = [*(batch.column(c) for c in names), pa.array(text, pa.string()), pa.array(size, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*names, "code", "error"])

    return run


def compress(kept: DataFrame, books: Codebooks) -> DataFrame:
    """``id``, ``label``, ``code`` (two hex digits a part), ``error`` (squared distance
    to the entries, all parts) and ``label_error`` (sum over all rows of the label) for
    each row of ``kept_vectors``. Nothing is shuffled but the sums by label.

    Rows that repeat are coded alike, each by itself. Null labels are one label. An
    error beyond a bigint is null, and so is the sum of its label.
    """
    width, names = len(books.entries[0][0]), ["id", "label"]
    fields = [T.StructField("code", T.StringType()), T.StructField("error", T.LongType())]
    schema = T.StructType([*kept.select(*names).schema.fields, *fields])
    coded = stored(kept.select(*names, "v").mapInArrow(_coder(books, width, names), schema), "codes")
    whole = F.count("error") == F.count("*")
    sums = coded.groupBy("label").agg(
        F.when(whole, F.sum(F.col("error").cast("decimal(38,0)")).try_cast("long")).alias("label_error")
    )
    sums = stored(sums.withColumnRenamed("label", "_label"), "label-errors")
    return coded.join(sums, F.col("label").eqNullSafe(F.col("_label"))).select("id", "label", "code", "error", "label_error")


def op13_code_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The code and error of every vector, the error of its label, and the codebooks' checksum."""
    kept = kept_vectors(table(spark, sf_dir, "embeddings"))
    books = lloyd_codebooks(kept)
    if books is None:
        types = f"vec_id {kept.schema['id'].dataType.simpleString()}, code string, error long, label_error long, codebooks_sha256 string"
        return spark.createDataFrame([], types)
    coded = compress(kept, books).withColumn("codebooks_sha256", F.lit(books.sha256()))
    return coded.select(F.col("id").alias("vec_id"), "code", "error", "label_error", "codebooks_sha256")


QUERIES = {"op13_code_compression": op13_code_compression}


def _sql() -> str:
    """Rounds of the same, each as tables of assigned parts and of entries."""
    assign = """
a{k} AS MATERIALIZED (
  SELECT vec_id, label, pos, part, entry, dist FROM (
    SELECT p.vec_id, p.label, p.pos, p.part, c.entry,
           list_sum([(x[1] - x[2]) * (x[1] - x[2]) FOR x IN list_zip(p.part, c.part)])::BIGINT AS dist
    FROM parts p JOIN c{k} c ON p.pos = c.pos)
  QUALIFY row_number() OVER (PARTITION BY vec_id, pos ORDER BY dist, entry) = 1)"""
    update = """
m{n} AS MATERIALIZED (
  SELECT pos, entry, list((s - ((s % n) + n) % n) // n ORDER BY i) AS part FROM (
    SELECT pos, entry, i, sum(part[i])::BIGINT AS s, count(*) AS n
    FROM a{k}, (SELECT unnest(range(1, (SELECT w FROM width) + 1)) AS i) GROUP BY ALL) GROUP BY ALL),
c{n} AS MATERIALIZED (
  SELECT c.pos, c.entry, coalesce(m.part, c.part) AS part FROM c{k} c LEFT JOIN m{n} m ON c.pos = m.pos AND c.entry = m.entry)"""
    steps = [assign.format(k=0)]
    for k in range(ROUNDS):
        steps += [update.format(k=k, n=k + 1), assign.format(k=k + 1)]
    return f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, label, [floor({SCALE} * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
width AS (SELECT max(len(v)) // {PARTS} AS w FROM kept),
parts AS MATERIALIZED (
  SELECT vec_id, label, pos, v[pos * w + 1 : pos * w + w] AS part
  FROM kept, width, (SELECT unnest(range({PARTS})) AS pos)),
c0 AS MATERIALIZED (
  SELECT pos, part, rank - 1 AS entry FROM (
    SELECT pos, part, row_number() OVER (PARTITION BY pos ORDER BY vec_id) AS rank FROM parts) WHERE rank <= {ENTRIES}),
{",".join(steps)},
books AS (
  SELECT sha256(string_agg(array_to_string(part, ','), ',' ORDER BY pos, entry)) AS codebooks_sha256 FROM c{ROUNDS}),
coded AS (
  SELECT vec_id, any_value(label) AS label, string_agg(printf('%02x', entry), '' ORDER BY pos) AS code, sum(dist)::BIGINT AS error
  FROM a{ROUNDS} GROUP BY vec_id)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM coded, books
"""


ORACLE = {"op13_code_compression": _sql()}
