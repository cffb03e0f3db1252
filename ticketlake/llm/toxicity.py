"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

An n-gram of lower-cased bytes is hashed into one of 2^BITS cells; a text has a cell or not. From a sample of labelled
rows come, per cell, the log ratio of its smoothed shares among toxic and other texts; a logistic regression with a
ridge penalty is fitted on texts whose cells carry these ratios as values. A score multiplies the two into one weight
per cell, so scoring is one table of fixed size and a sum over the cells of a text.

Null and empty texts have no cell and get the score of the intercept. Rows without a label, or with a null doc_id, do
not train; with no labelled rows of both kinds every score is 0. Labels of one doc_id that repeat count once, a toxic
one first. Repeated rows get equal scores, as a score depends on the text alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketlake.llm.common import apart, blocks, lower_ascii, narrow, raw

BITS, LENGTHS = 19, (4, 5, 6)
#: Most labelled rows (by hash of doc_id) that train, half of them of each kind where there are so many.
SAMPLE_ROWS = 4_000
#: A text that trains is read whole; a cell gets a weight if so many sampled texts have it and its ratio is so many
#: standard errors from zero.
LEAST_TEXTS, LEAST_Z = 3, 2.0
RIDGE, STEPS, SMOOTH = 1.0, 120, 1.0
_ODD = np.uint64(0x9E3779B97F4A7C15)


def cells(data: np.ndarray) -> np.ndarray:
    """Cells of the n-grams of one text, repeats included."""
    low, out = lower_ascii(data).astype(np.uint64), []
    packed = low.copy()
    for n in range(2, max(LENGTHS) + 1):
        if len(low) < n:
            break
        packed = (packed[:-1] << np.uint64(8)) | low[n - 1 :]
        if n in LENGTHS:
            out.append(((packed + np.uint64(n)) * _ODD >> np.uint64(64 - BITS)).astype(np.int32))
    return np.concatenate(out) if out else np.zeros(0, np.int32)


def _texts(part: pa.RecordBatch) -> Iterator[np.ndarray]:
    data, at = raw(part.column("text"))
    for k in range(len(at) - 1):
        yield data[at[k] : at[k + 1]]


def _distinct(data: np.ndarray, seen: np.ndarray) -> np.ndarray:
    own = cells(data)
    seen[own] = True
    found = np.flatnonzero(seen)
    seen[found] = False
    return found


def sample(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """doc_id, toxic and cells of at most `rows` labelled texts, chosen by hash of the id, half of each kind if possible."""
    own = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    lot = None
    for kind in (1, 0):
        part = own.where(F.col("toxic") == kind).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows // 2)
        lot = part if lot is None else lot.union(part)
    chosen = narrow(docs).join(F.broadcast(lot), "doc_id")  # `rows` ids at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(1 << BITS, bool)
        for part in blocks(batches):
            found = [_distinct(x, seen).astype(np.int32) for x in _texts(part)]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("toxic"), pa.array([x.tobytes() for x in found], pa.binary())], names=["doc_id", "toxic", "cells"])

    key = chosen.schema["doc_id"].dataType.simpleString()
    label = chosen.schema["toxic"].dataType.simpleString()
    return chosen.select("doc_id", "toxic", "text").mapInArrow(run, f"doc_id {key}, toxic {label}, cells binary")


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> tuple[np.ndarray, float]:
    """Weight of each cell and intercept. The sample is bounded in rows; it reaches the driver as sets of cells."""
    found: dict = {}
    for row in sample(docs, labels, rows).toLocalIterator():
        found.setdefault(row.doc_id, (np.frombuffer(row.cells, np.int32), int(row.toxic == 1)))
    keys = sorted(found)
    y = np.array([found[k][1] for k in keys], np.float64)
    if not len(y) or y.min() == y.max():
        return np.zeros(1 << BITS, np.float32), -50.0
    counts = np.full((2, 1 << BITS), SMOOTH)
    for own, toxic in found.values():
        counts[toxic][own] += 1
    negative, positive = counts
    ratio = np.log(positive / (y.sum() + 2 * SMOOTH)) - np.log(negative / ((1 - y).sum() + 2 * SMOOTH))
    spread = np.sqrt(1 / positive + 1 / negative)
    telling = (positive + negative - 2 * SMOOTH >= LEAST_TEXTS) & (np.abs(ratio) >= LEAST_Z * spread)
    ratio = np.where(telling, ratio, 0)
    texts = [own[telling[own]] for own, _ in (found.pop(k) for k in keys)]
    weight, bias = _logistic(texts, ratio, y)
    return (weight * ratio).astype(np.float32), bias


#: Texts whose cells one step of the fit takes at once.
_TEXTS = 200


def _logistic(texts: list[np.ndarray], ratio: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Ridge logistic regression by accelerated gradient steps; each kind of text has half of the weight."""
    size = len(ratio)
    parts = []
    for first in range(0, len(texts), _TEXTS):
        own = texts[first : first + _TEXTS]
        parts.append((np.concatenate(own), np.repeat(np.arange(len(own)), [len(t) for t in own])))
    share = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    norms = np.array([(ratio[t] ** 2).sum() for t in texts])
    penalty = RIDGE / len(y)
    step = 1.0 / (0.25 * (norms.max() + 1) * 0.05 + penalty)
    weight, bias, before, bias_before = np.zeros(size), 0.0, np.zeros(size), 0.0
    last = np.inf
    for k in range(STEPS):
        push = k / (k + 3)
        w, b = weight + push * (weight - before), bias + push * (bias - bias_before)
        scaled = w * ratio
        margin = np.concatenate([np.bincount(of, scaled[flat], minlength=min(_TEXTS, len(y) - n * _TEXTS)) for n, (flat, of) in enumerate(parts)]) + b
        p = 1 / (1 + np.exp(-np.clip(margin, -40, 40)))
        loss = -(share * np.where(y == 1, np.log(p + 1e-12), np.log(1 - p + 1e-12))).sum() + 0.5 * penalty * (w @ w)
        if loss > last * 1.02:  # the step was too long: shorten it and start the acceleration anew
            step, before, bias_before = step / 2, weight.copy(), bias
        last = min(last, loss)
        error = share * (p - y)
        slope = penalty * w
        for n, (flat, of) in enumerate(parts):
            slope += np.bincount(flat, error[n * _TEXTS + of], minlength=size) * ratio
        before, bias_before = weight, bias
        weight, bias = w - step * slope, b - step * error.sum()
    return weight, float(bias)


def score(docs: DataFrame, model: tuple[np.ndarray, float]) -> DataFrame:
    """row (all columns but the text), doc_id, text, score and predicted of every document."""
    weights, bias = model
    shared = docs.sparkSession.sparkContext.broadcast(weights)  # 2^BITS numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, seen = shared.value, np.zeros(1 << BITS, bool)
        for part in blocks(batches):
            margin = np.array([own[_distinct(x, seen)].sum(dtype=np.float64) for x in _texts(part)]) + bias
            found = 1 / (1 + np.exp(-np.clip(margin, -40, 40)))
            yield pa.RecordBatch.from_arrays(
                [part.column("row"), part.column("doc_id"), part.column("text"), pa.array(found, pa.float64()), pa.array((found >= 0.5).astype(np.int32))],
                names=["row", "doc_id", "text", "score", "predicted"],
            )

    source = docs.select(apart(docs), F.col("doc_id"), F.col("text"))
    row, key = (source.schema[x].dataType.simpleString() for x in ("row", "doc_id"))
    return source.mapInArrow(run, f"row {row}, doc_id {key}, text string, score double, predicted int")


def held_out(key: str = "doc_id") -> F.Column:
    return F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0


def classify(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """Fit on the labelled rows that are not held out, then score every row."""
    model = fit(docs, labels.where(~held_out()), rows)
    return score(docs, model).withColumn("held_out", F.coalesce(held_out(), F.lit(False)))
