"""Toxicity by cumulative-link ordinal regression.

P(grade > j | x) = sigmoid(w.x - threshold_j): one weight vector shared by all ordered thresholds, sparse hashed word
features, severity = the sum of these probabilities, the expected grade. The labels table grades a document 0 (not
toxic), 1 (toxic) or 2 (toxic and of low quality).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.text import LOWER, Slices, blocks, longs, utf8, words

FEATURE_BITS = 18
#: At most so many labelled documents of either toxic label are fitted, the ones of smallest hash.
SAMPLE_ROWS = 1500
GRADES = 3
#: A feature takes part if so many documents of the sample hold it and its share of toxic ones is so many standard
#: deviations off the mean: labels are noisy, and most words are too rare to tell.
MIN_DOCUMENTS, MIN_DEVIATIONS = 5, 6.0
ROUNDS, RATE, RIDGE = 400, 0.5, 0.3
#: Documents of this expected severity or more are rejected.
REJECT = 0.35
PUNCTUATION = np.zeros(256, bool)
PUNCTUATION[[ord(c) for c in ".,;:!?\"'()*#$%&|<>_-"]] = True


def _trimmed(data, starts, ends):
    """Words without the punctuation at their ends (three characters of it at most on each side)."""
    for _ in range(3):
        starts = starts + ((ends - starts > 1) & PUNCTUATION[data[starts]]) if len(starts) else starts
        ends = ends - ((ends - starts > 1) & PUNCTUATION[data[ends - 1]]) if len(ends) else ends
    return starts, ends


def features(texts) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct buckets of each text, joined, and their bounds."""
    raw, bounds = utf8(texts)
    data = LOWER[raw]
    starts, ends, first = words(data, bounds)
    bucket = (Slices(data)(*_trimmed(data, starts, ends)) >> np.uint64(64 - FEATURE_BITS)).astype(np.int64)
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    both = np.unique((doc << FEATURE_BITS) | bucket)
    return both & ((1 << FEATURE_BITS) - 1), np.searchsorted(both >> FEATURE_BITS, np.arange(len(first)))


def telling(buckets: np.ndarray, doc: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Whether each bucket's documents are toxic much more, or much less, often than all are."""
    size = 1 << FEATURE_BITS
    mean = (weight * toxic).sum() / weight.sum()
    n, held = np.bincount(buckets, weight[doc], size), np.bincount(buckets, minlength=size)
    off = np.bincount(buckets, (weight * toxic)[doc], size) - n * mean
    spread = np.bincount(buckets, (weight ** 2)[doc], size) * mean * (1 - mean)
    return (held >= MIN_DOCUMENTS) & (np.abs(off) > MIN_DEVIATIONS * np.sqrt(spread))


def fit(buckets: np.ndarray, bounds: np.ndarray, grade: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ascending thresholds by full-batch gradient steps scaled per coordinate.

    Features are 0/1 presences; the loss is the weighted sum of the logistic losses of all thresholds, and a ridge.
    """
    w = np.zeros(1 << FEATURE_BITS)
    cuts = np.linspace(2.0, 3.0, GRADES - 1)
    above = (grade[:, None] > np.arange(GRADES - 1)).astype(float)
    doc = np.repeat(np.arange(len(grade)), np.diff(bounds))
    used = telling(buckets, doc, (grade > 0).astype(float), weight)
    doc, buckets = doc[used[buckets]], buckets[used[buckets]]
    scale_w, scale_c = np.full(len(w), 1e-8), np.full(len(cuts), 1e-8)
    for _ in range(ROUNDS):
        score = np.bincount(doc, w[buckets], len(grade))
        gap = (1 / (1 + np.exp(np.clip(cuts - score[:, None], -50, 50))) - above) * weight[:, None]
        grad = np.bincount(buckets, gap.sum(1)[doc], len(w)) + RIDGE * w
        scale_w += grad ** 2
        w -= RATE * grad / np.sqrt(scale_w) * used
        step = -gap.sum(0)
        scale_c += step ** 2
        cuts -= RATE * step / np.sqrt(scale_c)
        cuts = np.maximum.accumulate(cuts)
    return w, cuts


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """Fits on at most SAMPLE_ROWS documents of each toxic label; the sample is bounded, so it is collected.

    Labels are joined by id; null or repeated labels count by their maximum, null ids not at all.
    """
    label = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("quality").alias("quality"))
    picked = label.where("toxic > 0").orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_ROWS).unionByName(
        label.where("toxic <= 0").orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_ROWS))
    ids = {r["doc_id"]: (r["toxic"], r["quality"]) for r in picked.collect()}  # 2 x SAMPLE_ROWS numbers
    if not ids:
        return np.zeros(1 << FEATURE_BITS), np.full(GRADES - 1, 50.0)
    text = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).where(F.col("doc_id").isin(list(ids)))

    def wide(batches):
        for batch in batches:
            for part in blocks(batch):
                b, at = features(part.column("text"))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(b.astype(np.int32)))], names=["doc_id", "buckets"])

    found = text.mapInArrow(wide, "doc_id long, buckets array<int>").groupBy("doc_id").agg(F.min("buckets").alias("buckets")).orderBy("doc_id").toArrow()
    lists = found.column("buckets").combine_chunks()
    bounds = lists.offsets.to_numpy().astype(np.int64)
    grade = np.array([0 if ids[i][0] <= 0 else 1 if ids[i][1] else 2 for i in found.column("doc_id").to_pylist()])
    if not (grade > 0).any() or not (grade == 0).any():
        return np.zeros(1 << FEATURE_BITS), np.full(GRADES - 1, 50.0 if not (grade > 0).any() else -50.0)
    # Each label's sample stands for all rows of that label.
    all_rows = {r["t"]: r["count"] for r in label.groupBy((F.col("toxic") > 0).alias("t")).count().collect()}
    share = {t: all_rows[t] / max(1, sum((v[0] > 0) == t for v in ids.values())) for t in all_rows}
    weight = np.array([share[bool(g)] for g in grade > 0])
    return fit(lists.values.to_numpy().astype(np.int64), bounds, grade, weight / weight.mean())


def _probabilities(texts, model) -> np.ndarray:
    """P(grade > j) of each text, a column per threshold."""
    weights, cuts = model
    buckets, bounds = features(texts)
    total = np.concatenate([[0.0], np.cumsum(weights[buckets], dtype=np.float64)])
    return 1 / (1 + np.exp(np.clip(cuts - (total[bounds[1:]] - total[bounds[:-1]])[:, None], -50, 50)))


def _model(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str):
    w, cuts = train(docs, labels, id_col, text_col)
    return docs.sparkSession.sparkContext.broadcast((w.astype(np.float32), cuts))  # 2**FEATURE_BITS numbers


def grade_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, severity (expected grade, 0 to 2), p_toxic, grade (most likely), rejected, one row per row.

    Null and empty texts have the severity of a document without words; ids are carried as they are, also null or
    repeated; further columns are ignored; empty tables give no rows; without labels, or without toxic ones, nothing is
    rejected.
    """
    shared = _model(docs, labels, id_col, text_col)

    def score(batches):
        for batch in batches:
            for part in blocks(batch):
                p = _probabilities(part.column("text"), shared.value)
                of_grade = -np.diff(np.concatenate([np.ones((len(p), 1)), p, np.zeros((len(p), 1))], 1), axis=1)
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), pa.array(p.sum(1)), pa.array(p[:, 0]), pa.array(of_grade.argmax(1).astype(np.int32)), pa.array(p.sum(1) >= REJECT),
                ], names=["doc_id", "severity", "p_toxic", "grade", "rejected"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(score, "doc_id long, severity double, p_toxic double, grade int, rejected boolean")


def kept_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, with all their columns, that grade_toxicity() does not reject."""
    shared = _model(docs, labels, id_col, text_col)

    def keep(batches):
        for batch in batches:
            for part in blocks(batch, text_col):
                yield part.filter(pa.array(_probabilities(part.column(text_col), shared.value).sum(1) < REJECT))

    return docs.mapInArrow(keep, docs.schema)
