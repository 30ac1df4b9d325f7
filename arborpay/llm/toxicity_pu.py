"""Toxicity by non-negative positive-unlabelled learning.

A linear model over hashed words and word beginnings is fitted to confirmed toxic texts and to
unlabelled ones. The risk on negatives is that on unlabelled texts less the prior's share of positives,
and never counts as less than nothing; where it would, the step goes the other way (non-negative
correction). The model is fitted on bounded samples (parameters below) and scores every whole text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arborpay.llm.common import Workspace
from arborpay.llm.text import span_hashes

#: Bounds of the two samples that the model is fitted on, in documents, and of the features it has.
POSITIVES, UNLABELLED, COLUMNS = 4000, 10_000, 4096
BITS = 18
#: Lengths in bytes of the word beginnings that count as features beside the words.
STEMS = (4, 5, 6, 7)
#: A feature takes part if this many positives have it and its rate among positives is this many standard errors over that among unlabelled.
SUPPORT, SURPRISE = 5, 6.0
_WORD = np.zeros(256, bool)
_WORD[[*range(97, 123), *range(128, 256)]] = True
FOLDS = 5


def features(text: str | None) -> np.ndarray:
    """Sorted distinct buckets of a text's words and word beginnings, in lower case."""
    raw = (text or "").lower().encode("utf-8", "surrogatepass")
    data = np.frombuffer(raw, np.uint8)
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = _WORD[data]
    step = np.diff(inside)
    starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    if not len(starts):
        return np.empty(0, np.int32)
    spans = [(starts, ends)]
    for n in STEMS:
        long = ends - starts > n
        spans.append((starts[long], starts[long] + n))
    hashes = span_hashes(data, np.concatenate([s for s, _ in spans]), np.concatenate([e for _, e in spans]))
    kind = np.repeat(np.arange(len(spans), dtype=np.uint64), [len(s) for s, _ in spans])
    return np.unique((hashes + kind * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)).astype(np.int32)


@dataclass
class PUModel:
    """weights by bucket and a bias; without positives to learn from, every score is 0."""

    weights: np.ndarray
    bias: float

    def score(self, buckets: np.ndarray) -> float:
        z = float(self.weights[buckets].sum()) + self.bias
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def choose(count_p: np.ndarray, count_u: np.ndarray, n_p: int, n_u: int) -> np.ndarray:
    """Buckets that take part: those that surprise most among the positives, at most COLUMNS."""
    rate_u = (count_u + 0.5) / (n_u + 1)
    surprise = (count_p / n_p - rate_u) / np.sqrt(rate_u * (1 - rate_u) / n_p)
    chosen = np.flatnonzero((count_p >= min(SUPPORT, n_p)) & (surprise >= SURPRISE))
    return np.sort(chosen[np.argsort(-surprise[chosen], kind="stable")[:COLUMNS]])


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


@dataclass
class Rows:
    """Texts by the columns of their features: two arrays of places, and the number of texts."""

    row: np.ndarray
    column: np.ndarray
    n: int

    def scores(self, w: np.ndarray, b: float) -> np.ndarray:
        return np.bincount(self.row, weights=w[self.column], minlength=self.n) + b

    def pulled(self, d: np.ndarray, size: int) -> np.ndarray:
        """Sums of d by column, and over all rows for the bias."""
        return np.append(np.bincount(self.column, weights=d[self.row], minlength=size), d.sum())


def risks(positive: Rows, unlabelled: Rows, w: np.ndarray, b: float, prior: float) -> tuple[float, float, np.ndarray, np.ndarray]:
    """The risk on positives, that on negatives corrected by the prior, and their gradients (bias last)."""
    zp, zu = positive.scores(w, b), unlabelled.scores(w, b)
    of_positive = prior * np.logaddexp(0, -zp).mean()
    of_negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
    down = prior * positive.pulled(-sigmoid(-zp) / positive.n, len(w))
    up = unlabelled.pulled(sigmoid(zu) / unlabelled.n, len(w)) - prior * positive.pulled(sigmoid(zp) / positive.n, len(w))
    return of_positive, of_negative, down, up


def fit(positives: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, steps: int = 400, rate: float = 0.05, decay: float = 1e-4) -> PUModel:
    """Minimise the class-prior-corrected risk with logistic loss by Adam over full batches."""
    size = 1 << BITS
    if not positives or not unlabelled:
        return PUModel(np.zeros(size, np.float32), -30.0)
    prior = float(np.clip(prior, 1e-4, 0.9))
    counts = [np.bincount(np.concatenate(rows), minlength=size) for rows in (positives, unlabelled)]
    chosen = choose(*counts, len(positives), len(unlabelled))
    column = np.full(size, -1)
    column[chosen] = np.arange(len(chosen))

    def matrix(rows: list[np.ndarray]) -> Rows:
        cols = [c[c >= 0] for c in (column[r] for r in rows)]
        return Rows(np.repeat(np.arange(len(rows)), [len(c) for c in cols]), np.concatenate(cols), len(rows))

    p, u = matrix(positives), matrix(unlabelled)
    w, b = np.zeros(len(chosen)), float(np.log(prior / (1 - prior)))
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for k in range(1, steps + 1):
        _, negative, down, up = risks(p, u, w, b, prior)
        g = down + up if negative >= 0 else -up
        g[:-1] += decay * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = rate * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.999**k)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    weights = np.zeros(size, np.float32)
    weights[chosen] = w
    return PUModel(weights, float(b))


def _featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, len(batch), 256):
            part = batch.slice(at, 256)
            yield pa.RecordBatch.from_arrays([*part.columns[:2], pa.array([features(t).tobytes() for t in part.column(2).to_pylist()], pa.binary())], ["doc_id", "positive", "buckets"])


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many positive and unlabelled texts have each bucket."""
    sums = np.zeros((2, 1 << BITS), np.int64)
    for batch in batches:
        for positive, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            sums[0 if positive else 1, np.frombuffer(raw, np.int32)] += 1
    at = np.flatnonzero(sums.any(axis=0))
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[0, at]), pa.array(sums[1, at])], ["bucket", "p", "u"])


def _only(chosen: np.ndarray) -> Callable:
    """Texts by the chosen buckets alone."""
    keep = np.zeros(1 << BITS, bool)
    keep[chosen] = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [np.frombuffer(raw, np.int32) for raw in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x[keep[x]].tobytes() for x in rows], pa.binary())], ["positive", "buckets"])

    return run


def _scorer(model: PUModel, place: int, name: str) -> Callable:
    """Adds the score of the text in the column at a place, under a name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                scores = [model.score(features(t)) for t in part.column(place).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(scores, pa.float64())], [*part.schema.names, name])

    return run


def with_scores(docs: DataFrame, model: PUModel, name: str) -> DataFrame:
    """docs with a column of scores, of a name that it hasn't yet; ``text`` must be a string column."""
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])
    return docs.mapInArrow(_scorer(model, docs.columns.index("text"), name), schema)


def held_out(doc_id) -> "F.Column":
    """True for the fold that is never learned from; false for a null doc_id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame) -> PUModel:
    """Fit on documents of the learning folds: confirmed toxic ones, and a sample of all as unlabelled.

    ``labels`` needs doc_id and toxic; a document labelled twice counts as toxic if any label says so,
    null labels say nothing. The prior is the share of toxic among the labels of the learning folds.
    The samples are the documents with the smallest hashes, at most POSITIVES and UNLABELLED; of a doc_id
    that repeats, the text with the smallest features counts. Features are chosen from counts by bucket, and
    only chosen ones come to the driver: at most COLUMNS for each document of the samples.
    """
    ws = Workspace(docs.sparkSession, "toxicity")
    mix = F.xxhash64(F.col("doc_id"))
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("doc_id is not null and toxic is not null")
    known = known.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    prior = known.agg(F.avg("toxic")).first()[0]
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    toxic = known.where("toxic = 1").select("doc_id", F.lit(True).alias("positive")).orderBy(mix, "doc_id").limit(POSITIVES)
    other = plain.select("doc_id", F.lit(False).alias("positive")).orderBy(mix, "doc_id").limit(UNLABELLED)
    chosen = toxic.union(other).distinct()  # no more rows than the two bounds
    rows = plain.join(F.broadcast(chosen), "doc_id").select("doc_id", "positive", "text").mapInArrow(_featurise, "doc_id long, positive boolean, buckets binary")
    rows = ws.table(rows.groupBy("doc_id", "positive").agg(F.min("buckets").alias("buckets")).select("positive", "buckets"), "features")
    sizes = {r["positive"]: r["n"] for r in rows.groupBy("positive").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return fit([], [], 0.0)
    found = rows.mapInArrow(_counts, "bucket long, p long, u long").groupBy("bucket").agg(F.sum("p").alias("p"), F.sum("u").alias("u")).toPandas()  # 2**BITS rows at most
    counts = np.zeros((2, 1 << BITS), np.int64)
    counts[:, found["bucket"]] = found["p"], found["u"]
    wanted = choose(counts[0], counts[1], sizes[True], sizes[False])
    sample = rows.mapInArrow(_only(wanted), "positive boolean, buckets binary").orderBy("positive", "buckets").toPandas()
    sets = [np.frombuffer(b, np.int32) for b in sample["buckets"]]
    positive = sample["positive"].to_numpy(bool)
    return fit([x for x, p in zip(sets, positive, strict=True) if p], [x for x, p in zip(sets, positive, strict=True) if not p], prior or 0.0)


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of docs.

    A null or empty text has no features and gets the score of the bias. Without any confirmed toxic
    document to learn from, every score is 0. No rows give no rows; columns beside doc_id and text are
    not read.
    """
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = with_scores(plain, train(docs, labels), "score")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of docs with a score under the threshold, with all their columns."""
    name = "score"
    while name in docs.columns:
        name = f"_{name}"
    return with_scores(docs, train(docs, labels), name).where(F.col(name) < threshold).drop(name)
