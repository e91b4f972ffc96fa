"""Document quality by naive Bayes support vectors (Wang and Manning, 2012).

A document's features are indicators of hashed n-grams: words and pairs of words, and, as patterns that hold for
any vocabulary, a word's shape with the signs at its end, pairs of shapes and whether a word repeats the last
one, each also by the share of the document that it makes up. Indicators are scaled by the classes'
log-count ratios, rows to length one, and a linear model is fitted to the hinge loss by dual coordinate
descent. Margins become probabilities by a logistic curve fitted on rows that the model has not seen.

The model is fitted on at most ``sample_rows`` labelled rows (the first by a hash of doc_id), which bounds what the one
fitting task gets; every document is scored on its whole text in one pass without a shuffle.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from .common import id_text
from .tokens import WordCache

DIMENSIONS = 1 << 18
SAMPLE_ROWS = 6_000
LEVELS = (4, 16, 64)  # an n-gram of shapes is also marked if it makes up one in so many

_EDGES = re.compile(r"^(\W*)(.*?)(\W*)$", re.S)
_U = np.uint64


def _shape(core: str) -> int:
    if not core:
        return 0
    if core.isdigit():
        return 1
    if not core.isalpha():
        return 2
    if core.islower():
        return 3
    if core.isupper():
        return 4 if len(core) > 1 else 5
    return 6 if core[1:].islower() else 7


def _packed(word: str) -> int:
    """Hash of the word (32 bits), of the signs around it (20 bits), its shape (4 bits)."""
    before, core, after = _EDGES.match(word).groups()
    signs = zlib.crc32(f"{before[:4]} {after[:4]}".encode()) & 0xFFFFF
    return zlib.crc32(core.encode()) << 24 | signs << 4 | _shape(core)


_WORDS = WordCache(_packed, 100_000)


def _mixed(x: np.ndarray, kind: int) -> np.ndarray:
    x = (x + _U(kind)) * _U(0x9E3779B97F4A7C15)
    x = (x ^ (x >> _U(29))) * _U(0xBF58476D1CE4E5B9)
    return (x >> _U(40)) % _U(DIMENSIONS)


def features(text: str) -> np.ndarray:
    """Numbers of the indicators that a text has, in ascending order."""
    words = text.split()
    n = len(words)
    if not n:
        return np.zeros(0, np.int32)
    packed = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, n)
    core, form = packed >> _U(24), packed & _U(0xFFFFFF)
    found = [_mixed(core, 1), _mixed(core[:-1] * _U(0x100000001B3) + core[1:], 2)]
    same = (core[1:] == core[:-1]).astype(np.uint64)
    pairs = (form[:-1] << _U(8)) | ((form[1:] & _U(15)) << _U(1)) | same
    for kind, patterns in ((3, form), (4, pairs), (5, same)):
        values, counts = np.unique(patterns, return_counts=True)
        found.append(_mixed(values, kind * 8))
        for i, level in enumerate(LEVELS):
            found.append(_mixed(values[counts * level >= n], kind * 8 + i + 1))
    return np.unique(np.concatenate(found)).astype(np.int32)


def _descend(rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, cost: np.ndarray, rounds: int) -> np.ndarray:
    """Dual coordinate descent for the hinge loss (Hsieh et al., 2008). The last weight is the bias."""
    w = np.zeros(DIMENSIONS + 1, np.float32)
    alpha = np.zeros(len(rows))
    norm = np.array([float(v @ v) for v in values])
    rng = np.random.default_rng(0)
    active = np.arange(len(rows))
    for _ in range(rounds):
        moved = []
        for i in rng.permutation(active):
            at, x = rows[i], values[i]
            slope = y[i] * (w[at] @ x) - 1
            new = min(max(alpha[i] - slope / norm[i], 0.0), cost[i])
            if abs(new - alpha[i]) > 1e-4 * cost[i]:
                w[at] += np.float32((new - alpha[i]) * y[i]) * x
                alpha[i] = new
                moved.append(i)
        if not moved and len(active) == len(rows):
            break
        active = np.array(moved) if moved else np.arange(len(rows))  # rows at rest are looked at again at the end
    return w


def _scaled(rows: list[np.ndarray], ratio: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Rows with the bias added; values: the ratios, at length one, and 1 for the bias."""
    out, values = [], []
    for r in rows:
        x = ratio[r]
        out.append(np.append(r, np.int32(DIMENSIONS)))
        values.append(np.append(x / max(1e-9, np.sqrt(x @ x)), 1.0).astype(np.float32))
    return out, values


def fit(rows: list[np.ndarray], labels: np.ndarray, cost: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Log-count ratios, weights and bias, and the two numbers of the logistic curve, in one array.

    With one class only (or no rows) the score is the smoothed share of label 1.
    """
    share = (labels.sum() + 1) / (len(labels) + 2)
    model = np.zeros(2 * DIMENSIONS + 3)
    if len(set(labels.tolist())) < 2:
        model[-1] = np.log(share / (1 - share))
        return model
    y = np.where(labels > 0, 1.0, -1.0)
    counts = np.ones((2, DIMENSIONS))
    for r, positive in zip(rows, labels > 0, strict=True):
        counts[int(positive), r] += 1
    counts /= counts.sum(axis=1, keepdims=True)
    ratio = np.log(counts[1] / counts[0])
    at, values = _scaled(rows, ratio)
    costs = cost * np.where(y > 0, 1.0, max(1.0, (y > 0).sum() / max(1, (y < 0).sum())))

    fold = np.arange(len(y)) % 3
    margins = np.zeros(len(y))
    for k in range(3):  # margins of rows that the model of the other two thirds has not seen
        seen = np.flatnonzero(fold != k)
        w = _descend([at[i] for i in seen], [values[i] for i in seen], y[seen], costs[seen], rounds)
        for i in np.flatnonzero(fold == k):
            margins[i] = w[at[i]] @ values[i]
    target = np.where(y > 0, ((y > 0).sum() + 1) / ((y > 0).sum() + 2), 1 / ((y < 0).sum() + 2))
    a, b = 1.0, 0.0
    for _ in range(50):  # Newton's steps for the logistic curve
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -30, 30)))
        grad = np.array([(p - target) @ margins + 1e-3 * (a - 1), (p - target).sum()])
        h = p * (1 - p)
        hess = np.array([[h @ margins**2 + 1e-3, h @ margins], [h @ margins, h.sum() + 1e-6]])
        step = np.linalg.solve(hess, grad)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    w = _descend(at, values, y, costs, rounds)
    model[:DIMENSIONS], model[DIMENSIONS:-2] = ratio, w
    model[-2:] = a, b
    return model


def score(text: str, model: np.ndarray) -> float:
    ratio, w, (a, b) = model[:DIMENSIONS], model[DIMENSIONS:-2], model[-2:]
    at = features(text)
    x = ratio[at]
    margin = (w[at] @ x) / max(1e-9, np.sqrt(x @ x)) + w[-1]
    return float(1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30))))


def held_out(doc_id: Column) -> Column:
    """Rows that no model learns from: crc32 of the doc_id as text is 2 modulo 4 (a null doc_id: as "")."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def train_quality(docs: DataFrame, labels: DataFrame, label_col: str = "quality", sample_rows: int = SAMPLE_ROWS) -> np.ndarray:
    """Fits the model on at most ``sample_rows`` labelled documents that are not held out.

    Rows without a label or doc_id are passed over; of several labels of a document the least counts.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label")).dropna()
    known = known.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min("label").alias("label"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)

    def featurize(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(t.as_py()).tobytes() for t in batch["text"]]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["label"], pa.array(found, pa.binary())], ["doc_id", "label", "features"])

    def fitted(table: pa.Table) -> pa.Table:
        table = table.sort_by("doc_id")
        rows = [np.frombuffer(f, np.int32) for f in table["features"].to_pylist()]
        return pa.table({"model": pa.array([fit(rows, table["label"].to_numpy()).tobytes()], pa.binary())})

    # The sample's size is bounded by its parameter, so it may be broadcast and gathered in one task.
    chosen = id_text(docs).join(F.broadcast(sample), "doc_id").mapInArrow(featurize, "doc_id long, label int, features binary")
    found = chosen.groupBy(F.lit(0).alias("all")).applyInArrow(fitted, "model binary").collect()
    return np.frombuffer(found[0].model) if found else fit([], np.zeros(0))


def scorer(spark: SparkSession, model: np.ndarray):
    """A function of a text column (no nulls) that gives the score."""
    shared = spark.sparkContext.broadcast(model.astype(np.float64))  # some MB whatever the data

    @F.arrow_udf(DoubleType())
    def scored(texts: pa.Array) -> pa.Array:
        return pa.array((score(t.as_py(), shared.value) for t in texts), pa.float64())

    return scored


def score_quality(docs: DataFrame, model: np.ndarray, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score (0 to 1, higher: label 1 likelier), predicted (1 from the threshold on).

    A text without words (null, empty) has no features and gets the score of the bias. Repeated rows and null
    doc_ids are scored like any other; other columns are not read; an empty table gives an empty result.
    """
    scored = scorer(docs.sparkSession, model)
    rows = id_text(docs).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), scored("text").alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
