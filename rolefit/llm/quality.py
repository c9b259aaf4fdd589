"""Quality classifier: kernel ridge regression by random Fourier features, calibrated by isotonic regression.

Statistics of a text, standardized, are mapped to random cosine features, whose inner products approximate a
Gaussian kernel. Tasks sum the normal equations of their labelled rows; the sums have a fixed size, whatever the
data. One part of the labelled rows calibrates the ridge scores to probabilities.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rolefit.llm.common import materialize, text_or_empty

FEATURES = [
    "chars", "words", "word_length", "word_spread", "longest_word", "lines", "line_length", "upper", "lower", "digits", "blanks", "marks", "stops",
    "other", "distinct_words", "top_word", "same_as_next", "distinct_pairs", "distinct_lines", "caps_words", "marked_words", "bare_marks", "packed", "entropy",
]
#: Cosine features, ridge penalty per row, and the most labelled rows that a model is fit to.
DIMENSIONS, PENALTY, MAX_ROWS = 256, 1e-4, 200_000
#: Tasks that sum the normal equations: what they send to be added is this many times a fixed size.
SUMMING_TASKS = 24
#: Bins of ridge scores that the calibration sees.
BINS = 2_000

_CLASS = np.full(256, 6)
_CLASS[ord("A"):ord("Z") + 1], _CLASS[ord("a"):ord("z") + 1], _CLASS[ord("0"):ord("9") + 1] = 0, 1, 2
_CLASS[[32, 9, 10, 11, 12, 13]], _CLASS[[ord(c) for c in "#$%&*+/<=>@[\\]^_`{|}~!"]], _CLASS[[ord(c) for c in ".,;:?'\"()-"]] = 3, 4, 5
_BARE = b".,;:?'\"()-#$%&*+/<=>@[\\]^_`{|}~!"


def statistics(text: str) -> list[float]:
    """FEATURES of a text; zeros for an empty one. Every part of the text counts."""
    raw = text.encode("utf-8", "surrogatepass")
    if not raw.strip():
        return [0.0] * len(FEATURES)
    bytes_ = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    kinds = np.bincount(_CLASS, bytes_, 7) / len(raw)
    p = bytes_[bytes_ > 0] / len(raw)
    words, lines = raw.split(), raw.split(b"\n")
    length = np.fromiter(map(len, words), np.int64, len(words))
    n = len(words)
    pairs = list(zip(words, words[1:]))
    return [
        np.log1p(len(raw)), np.log1p(n), length.mean(), length.std(), np.log(length.max()), np.log(len(lines)), np.log1p(len(raw) / len(lines)), *kinds,
        len(set(words)) / n ** 0.9, max(Counter(words).values()) / n, sum(a == b for a, b in pairs) / n, (len(set(pairs)) + 1) / n,
        len(set(lines)) / len(lines), sum(map(bytes.isupper, words)) / n, sum(w[-1] in _BARE for w in words) / n,
        sum(not w.strip(_BARE) for w in words) / n, len(zlib.compress(raw, 1)) / (len(raw) + 40), float(-(p * np.log2(p)).sum()),
    ]


def _matrix(texts: pa.Array) -> np.ndarray:
    return np.array([statistics(t or "") for t in texts.to_pylist()], np.float64).reshape(-1, len(FEATURES))


def add_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and x (FEATURES) per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("text")).astype(np.float32)
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "x": pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float32()))})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(run, "doc_id long, x array<float>")


@dataclass
class Model:
    """What scoring needs; of a fixed size. ``grid`` and ``level`` are the calibration's corners."""

    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    grid: np.ndarray
    level: np.ndarray

    def raw(self, x: np.ndarray) -> np.ndarray:
        return cosines(x, self.mean, self.spread) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        """Calibrated probability of label 1; a small part of the ridge score keeps the order within a level."""
        raw = self.raw(x)
        return np.clip(0.998 * np.interp(raw, self.grid, self.level) + 0.002 / (1 + np.exp(-4 * np.clip(raw - 0.5, -9, 9))), 0, 1)


def cosines(x: np.ndarray, mean: np.ndarray, spread: np.ndarray, seed: int = 11) -> np.ndarray:
    """Random Fourier features of a Gaussian kernel, and a constant."""
    rng = np.random.default_rng(seed)
    w = rng.normal(size=(x.shape[1], DIMENSIONS)) / np.sqrt(2.0 * x.shape[1])
    z = np.clip((x - mean) / spread, -6, 6)
    return np.c_[np.sqrt(2 / DIMENSIONS) * np.cos(z @ w + rng.uniform(0, 2 * np.pi, DIMENSIONS)), np.ones(len(x))]


def isotonic(y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The non-decreasing fit of least weighted squares: neighbours out of order are pooled."""
    blocks: list[list[float]] = []
    for v, w in zip(y, weight, strict=True):
        blocks.append([v, w, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            b, a = blocks.pop(), blocks.pop()
            blocks.append([(a[0] * a[1] + b[0] * b[1]) / (a[1] + b[1]), a[1] + b[1], a[2] + b[2]])
    return np.concatenate([np.full(int(n), v) for v, _, n in blocks]) if blocks else np.empty(0)


def fold(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5


def _sums(rows: DataFrame, width: int, of) -> np.ndarray:
    """Sums over all rows of the matrix that ``of`` makes of a batch; a task adds up its own before anything moves."""

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for batch in batches:
            if len(batch):
                part = of(np.stack(batch.x.to_numpy()).astype(float), batch.y.to_numpy(float))
                total = part if total is None else total + part
        if total is not None:
            yield pd.DataFrame({"i": range(len(total)), "v": list(total)})

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"i": pdf.i[:1], "v": [np.stack(pdf.v.to_numpy()).sum(axis=0)]})

    out = rows.mapInPandas(partial, "i int, v array<double>").groupBy("i").applyInPandas(add, "i int, v array<double>").collect()
    return np.array([r.v for r in sorted(out, key=lambda r: r.i)], float).reshape(-1, width)


def known_rows(labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """labelled, y, fold of the labels (doc_id, quality) that a model may learn from: at most about ``max_rows`` rows, to be broadcast.

    Rows of fold 0 are left out. Of more than ``max_rows`` labelled rows a seeded sample of about that many is taken, a bound of the
    model alone. Labels without an id or a value are left out.
    """
    known = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").select(F.col("doc_id").cast("long").alias("labelled"), F.col("quality").cast("double").alias("y"))
    known = known.withColumn("fold", fold("labelled")).filter("fold <> 0")
    part = min(1.0, max_rows / max(1, known.count()))
    return known.filter(F.pmod(F.xxhash64(F.lit(29), "labelled"), F.lit(1_000_000)) < int(part * 1_000_000))


def fit(statistics_: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Model:
    """A model from ``statistics_`` (doc_id, x) and ``labels`` (doc_id, quality), see known_rows().

    Fold 1 calibrates, the others fit. Without any usable label every score is near 0.5; with one class only, near that class.
    """
    known = known_rows(labels, max_rows)
    rows = statistics_.join(F.broadcast(known), F.col("doc_id") == F.col("labelled")).select("x", "y", "fold")
    rows = materialize(rows, "quality-rows").coalesce(SUMMING_TASKS)
    width = len(FEATURES)
    moments = _sums(rows.filter("fold <> 1"), width, lambda x, y: np.stack([np.full(width, len(x)), x.sum(axis=0), (x * x).sum(axis=0)]))
    if not len(moments):
        return Model(np.zeros(width), np.ones(width), np.zeros(DIMENSIONS + 1), np.array([0.0]), np.array([0.5]))
    mean = moments[1] / moments[0]
    spread = np.sqrt(np.maximum(moments[2] / moments[0] - mean**2, 1e-6))

    def equations(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        z = cosines(x, mean, spread)
        return z.T @ np.c_[z, y]

    sums = _sums(rows.filter("fold <> 1"), DIMENSIONS + 2, equations)
    penalty = PENALTY * moments[0, 0] * np.eye(DIMENSIONS + 1)
    model = Model(mean, spread, np.linalg.solve(sums[:, :-1] + penalty, sums[:, -1]), np.array([0.0]), np.array([0.5]))

    def binned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                raw = np.clip(model.raw(np.stack(batch.x.to_numpy()).astype(float)), -1, 2)
                yield pd.DataFrame({"bin": np.rint((raw + 1) / 3 * BINS).astype(int), "y": batch.y})

    bins = rows.filter("fold = 1").mapInPandas(binned, "bin int, y double").groupBy("bin").agg(F.sum("y").alias("y"), F.count("y").alias("n"))
    bins = bins.toPandas().sort_values("bin")  # at most BINS + 1 rows
    if len(bins):
        model.grid = bins.bin.to_numpy() / BINS * 3 - 1
        # One row of either class beside each fit keeps probabilities off 0 and 1.
        n = bins.n.to_numpy(float)
        model.level = np.clip(isotonic(bins.y.to_numpy() / n, n), 0.5 / n.sum(), 1 - 0.5 / n.sum())
    return model


def score_statistics(statistics_: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted per row of ``statistics_``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy().reshape(-1, len(FEATURES)).astype(float)
            score = model.score(x)
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "score": score, "predicted": (score >= threshold).astype(np.int32)})

    scored = statistics_.mapInArrow(run, "doc_id long, score double, predicted int")
    return scored.select("doc_id", F.coalesce(fold() == 0, F.lit(False)).alias("held_out"), "score", "predicted")


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted per row of ``docs``.

    Null and empty texts have zeros for statistics and a score like others; a null doc_id is never held out;
    repeated rows are scored each.
    """
    x = materialize(add_statistics(docs), "quality-statistics")
    return score_statistics(x, fit(x, labels), threshold)


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """Rows of ``docs``, all columns, whose score reaches the threshold."""
    ids = known_rows(labels).select(F.col("labelled").alias("__labelled")).distinct()
    labelled = docs.join(F.broadcast(ids), F.col("doc_id") == F.col("__labelled"), "left_semi")  # statistics of these alone are needed to fit
    model = fit(add_statistics(labelled), labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(model.score(_matrix(batch.column("text"))) >= threshold))

    return docs.mapInArrow(run, docs.schema)
