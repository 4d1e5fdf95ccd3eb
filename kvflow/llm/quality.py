"""Quality grades by ordinal cumulative-link regression on hashed text features.

P(grade <= k) = sigmoid(threshold_k - w.x): one weight vector for all grades and ordered thresholds.  Grades come from
ratings: 0 for toxic, 1 for poor, 2 for good.  A document gets its expected grade and the tail chances P(grade >= k).

Features: distinct lower-case words and word shapes, hashed to DIMENSIONS.  The fit keeps those that at least MIN_ROWS
sampled rows hold and whose share among toxic rows, or among rows below the best grade, departs from the rest's by
MIN_Z standard errors.  A document's kept features count 1 / n ** 0.25 each, n being their number.

The model is fitted on the driver from a bounded sample: the SAMPLE_ROWS rated rows whose id hashes lowest.  Every row
of the table is scored, whole text.

Defined results: null and empty texts have no features and get the thresholds' own grade; rows rated null count as
unrated; an id rated more than once has its lowest grade; without ratings of two grades all rows get the one grade
there is (the best where there is none).  Repeated rows get equal results.  An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GRADES = 3
DIMENSIONS = 1 << 18
#: Rated rows the model is fitted on, at most: so many rows' features reach the driver.
SAMPLE_ROWS = 6000
MIN_ROWS, MIN_Z = 5, 5.0
ROUNDS, RATE, DECAY = 200, 0.05, 1e-5
#: Kept: P(grade >= KEEP_GRADE) of at least KEEP_CHANCE.
KEEP_GRADE, KEEP_CHANCE = 1, 0.5

_TOKEN = re.compile(r"\S+")
_CORE = re.compile(r"^\W+|\W+$")


class _Buckets(dict):
    """Cache: token -> its word and shape buckets."""

    def __missing__(self, token: str) -> tuple[int, ...]:
        word = _CORE.sub("", token).lower()
        shape = "".join("X" if c.isupper() else "x" if c.islower() else "9" if c.isdigit() else c for c in token)
        shape = re.sub(r"(.)\1+", r"\1", shape)
        got = tuple(xxhash.xxh64_intdigest(k + v, 42) % DIMENSIONS for k, v in (("w", word), ("s", shape)) if v)
        if len(token) <= 40:
            if len(self) >= 300_000:
                self.clear()
            self[token] = got
        return got


def features(text: str | None, buckets: _Buckets | None = None) -> np.ndarray:
    """The buckets of a text's features, each once, ascending."""
    buckets = _Buckets() if buckets is None else buckets
    return np.array(sorted({b for token in set(_TOKEN.findall(text or "")) for b in buckets[token]}), np.int32)


def grade(quality: Column, toxic: Column) -> Column:
    return F.when(toxic > 0, 0).when(quality.isNull() | toxic.isNull(), None).when(quality > 0, 2).otherwise(1)


class Model:
    """weights (0 where a feature isn't kept), kept, thresholds (ascending, GRADES - 1 of them)."""

    def __init__(self, weights: np.ndarray, kept: np.ndarray, thresholds: np.ndarray) -> None:
        self.weights, self.kept, self.thresholds = weights, kept, thresholds

    def tails(self, at: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1 ... GRADES - 1."""
        at = at[self.kept[at]]
        score = float(self.weights[at].sum()) / max(1, len(at)) ** 0.25
        return 1 / (1 + np.exp(np.clip(self.thresholds - score, -50, 50)))


def _telling(rows: list[tuple[np.ndarray, int]]) -> np.ndarray:
    """Which features the fit keeps."""
    held = np.zeros((GRADES, DIMENSIONS))
    for at, y in rows:
        held[y, at] += 1
    size = np.bincount([y for _, y in rows], minlength=GRADES)
    n, z = held.sum(axis=0), np.zeros(DIMENSIONS)
    for k in range(1, GRADES):
        share = size[:k].sum() / size.sum()
        z = np.maximum(z, np.abs(held[:k].sum(axis=0) - n * share) / np.sqrt(n * share * (1 - share) + 1))
    return (n >= MIN_ROWS) & (z >= MIN_Z)


def fit(rows: list[tuple[np.ndarray, int]]) -> Model:
    """Full-batch Adam on the cumulative-link likelihood, classes weighted by the square root of their rarity; deterministic."""
    grades = np.array([r[1] for r in rows], np.int64)
    present = sorted(set(grades.tolist()))
    if len(present) < 2:
        only = present[0] if present else GRADES - 1
        return Model(np.zeros(DIMENSIONS, np.float32), np.zeros(DIMENSIONS, bool), np.where(np.arange(1, GRADES) <= only, -20.0, 20.0))
    kept = _telling(rows)
    listed = [at[kept[at]] for at, _ in rows]
    size = np.array([len(at) for at in listed])
    at = np.concatenate(listed).astype(np.int64)
    row = np.repeat(np.arange(len(rows)), size)
    value = (1 / np.maximum(1, size) ** 0.25)[row]
    share = np.bincount(grades, minlength=GRADES) / len(grades)
    weight = 1 / np.sqrt(np.maximum(share, 1e-9))[grades]
    weight /= weight.sum()
    w, base, gaps = np.zeros(DIMENSIONS), np.array([-1.0]), np.zeros(GRADES - 2)
    state = [[np.zeros_like(p), np.zeros_like(p)] for p in (w, base, gaps)]
    low = np.arange(GRADES - 1)
    for step in range(1, ROUNDS + 1):
        thresholds = np.concatenate([base, base + np.cumsum(np.exp(gaps))])
        score = np.bincount(row, weights=w[at] * value, minlength=len(rows))
        cdf = 1 / (1 + np.exp(-np.clip(thresholds[None, :] - score[:, None], -50, 50)))
        full = np.concatenate([np.zeros((len(rows), 1)), cdf, np.ones((len(rows), 1))], axis=1)
        chance = np.maximum(full[np.arange(len(rows)), grades + 1] - full[np.arange(len(rows)), grades], 1e-12)
        slope = cdf * (1 - cdf)
        upper = (low[None, :] == grades[:, None]) * slope
        lower = (low[None, :] == grades[:, None] - 1) * slope
        by_threshold = -(weight / chance)[:, None] * (upper - lower)
        by_score = -by_threshold.sum(axis=1)
        grad_t = by_threshold.sum(axis=0)
        grads = (
            np.bincount(at, weights=by_score[row] * value, minlength=DIMENSIONS) + DECAY * w,
            np.array([grad_t.sum()]),
            np.array([grad_t[j + 1 :].sum() for j in range(GRADES - 2)]) * np.exp(gaps),
        )
        for p, g, (m, v) in zip((w, base, gaps), grads, state, strict=True):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
    return Model(w.astype(np.float32), kept, np.concatenate([base, base + np.cumsum(np.exp(gaps))]))


def sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> list[tuple[np.ndarray, int]]:
    """Features and grades of the rated rows whose id hashes lowest."""
    rated = labels.select("doc_id", grade(F.col("quality"), F.col("toxic")).alias("grade")).where("doc_id is not null and grade is not null")
    rated = rated.groupBy("doc_id").agg(F.min("grade").alias("grade"))
    chosen = rated.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    joined = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = _Buckets()
        for batch in batches:
            got = [features(t.as_py(), buckets) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(got, pa.list_(pa.int32()))],
                ["doc_id", "grade", "at"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    found = joined.select("doc_id", "text", "grade").mapInArrow(run, f"doc_id {kind}, grade int, at array<int>").dropDuplicates(["doc_id"])
    got = sorted(found.collect(), key=lambda r: r.doc_id)
    return [(np.array(r["at"], np.int32), r["grade"]) for r in got]


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, grade (expected), p_ge_1, p_ge_2, keep: a row for each row of docs."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, buckets = shared.value, _Buckets()
        for batch in batches:
            tails = np.array([m.tails(features(t.as_py(), buckets)) for t in batch.column(1)]).reshape(-1, GRADES - 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(tails.sum(axis=1)), *(pa.array(tails[:, k]) for k in range(GRADES - 1)), pa.array(tails[:, KEEP_GRADE - 1] >= KEEP_CHANCE)],
                [id_col, "grade", *(f"p_ge_{k}" for k in range(1, GRADES)), "keep"],
            )

    tails = ", ".join(f"p_ge_{k} double" for k in range(1, GRADES))
    return docs.select(id_col, F.col(text_col).cast("string").alias("text")).mapInArrow(run, f"`{id_col}` {kind}, grade double, {tails}, keep boolean")
