"""Quality scores from a Bradley-Terry model of preference pairs (operator 13).

A document of label 1 is preferred to one of label 0. The chance that document a is preferred to b
is the logistic function of s(a) - s(b), where a document's strength s is linear in measures of its
whole text. The weights minimise the logistic loss over all pairs of a training row of label 1 and one
of label 0 (on the differences of their measures), with a small ridge term, by Newton's method. The threshold
is the quantile of the training rows' strengths at the share of label 0 among them; a score is the
logistic function of the distance to it, moved so that the threshold itself scores 0.3.

The measures come from the text alone. Labels, language, source and id are no inputs.

All labelled training rows are fitted. At most `PAIRS` pairs are fitted one by one on the driver, by
their measures. More pairs are never listed: a step of Newton's method is one pass over the training
rows, added up by class and bin of strength (`STEP` wide), and each pair of bins stands for the pairs of
its rows, so a step costs in proportion to the rows. The quantile is that of all training rows, found by
narrowing. All documents are measured once; their measures are written, joined to the labels and scored.

Null, empty and blank texts have measures of zero words and are scored like others. Repeated rows
are scored each; a training id that occurs in several rows or labels is fitted once for each. Null
ids have no label and count as held out. Very long texts are measured whole, one at a time. If one
of the labels is missing in the training rows, all strengths are 0 and every score is 0.5. Ties in
strength share a score. Other columns are left out, whatever their names; an empty table gives no
rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystar.llm.quantiles import quantiles
from tallystar.llm.tables import Scratch, id_type, ship, texts
from tallystar.llm.text import (
    NOT_SPACE,
    SYMBOLS,
    Texts,
    chunks,
    distinct,
    repeated_lines,
    repeated_words,
    span_hashes,
    sums,
    words,
)

PAIRS = 200_000
#: Width of a bin of strength, bins on each side of 0 (farther ones count as the last), steps at most.
STEP, MOST_BINS, STEPS = 1 / 16, 1024, 50
#: Parts of a whole in which moments are added up.
UNITS = 1 << 20
RIDGE = 1e-3
THRESHOLD_SCORE = 0.3
FOLDS, HELD_OUT = 5, 0

MEASURES = [
    "log_words", "word_bytes", "upper", "symbols", "calls", "digits", "marks", "line_copies",
    "window_copies", "distinct_words", "stutter", "line_words", "non_ascii", "controls", "entropy",
]


def _bytes(*ranges: tuple[int, int]) -> np.ndarray:
    kind = np.zeros(256, bool)
    for first, last in ranges:
        kind[first : last + 1] = True
    return kind


UPPER, LOWER, DIGIT = _bytes((65, 90)), _bytes((97, 122)), _bytes((48, 57))
CALLS, MARKS = np.zeros(256, bool), np.zeros(256, bool)
CALLS[list(b"!?")] = MARKS[list(b".,;:'\"()-")] = True
CONTROL = _bytes((0, 8), (14, 31), (127, 127))


def measures(texts_: Texts) -> np.ndarray:
    """A row of MEASURES for each text."""
    found = words(texts_, NOT_SPACE)
    hashes = span_hashes(texts_, found.start, found.end)
    size = texts_.sizes
    n = found.count

    def of(kind: np.ndarray) -> np.ndarray:
        return sums(kind[texts_.data], texts_.offsets)

    each, total = np.maximum(n, 1), np.maximum(size, 1)
    upper, lower = of(UPPER), of(LOWER)
    lines = 1 + sums(texts_.data == 10, texts_.offsets)
    once, _ = distinct(found.text, hashes)
    again = np.zeros(len(hashes), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (found.text[1:] == found.text[:-1])
    text = np.repeat(np.arange(len(size)), size)
    counts = np.bincount(text * 256 + texts_.data, minlength=256 * len(size)).reshape(-1, 256)
    part = counts / total[:, None]
    entropy = -(part * np.log2(np.where(part > 0, part, 1.0))).sum(1)
    columns = [
        np.log1p(n),
        np.log1p(sums(NOT_SPACE[texts_.data], texts_.offsets) / each),
        upper / np.maximum(upper + lower, 1),
        np.minimum(of(SYMBOLS) / each, 4.0),
        np.minimum(of(CALLS) / each, 4.0),
        of(DIGIT) / total,
        np.minimum(of(MARKS) / each, 4.0),
        repeated_lines(texts_, found) / lines,
        repeated_words(found, hashes) / each,
        np.log1p(np.bincount(once, minlength=len(size))) - np.log1p(n),
        sums(again, found.bounds) / each,
        np.log1p(n / lines),
        sums(texts_.data >= 0x80, texts_.offsets) / total,
        of(CONTROL) / total,
        entropy,
    ]
    return np.stack(columns, 1)


@dataclass(frozen=True)
class Ranking:
    """A fitted model: strength = weights . clipped standardised measures."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float

    def strength(self, rows: np.ndarray) -> np.ndarray:
        return np.clip((rows - self.mean) / self.scale, -8.0, 8.0) @ self.weights

    def score(self, rows: np.ndarray) -> np.ndarray:
        if not self.weights.any():
            return np.full(len(rows), 0.5)
        shift = np.log(THRESHOLD_SCORE / (1 - THRESHOLD_SCORE))
        away = np.clip(self.strength(rows) - self.threshold + shift, -500, 500)
        return 1.0 / (1.0 + np.exp(-away))


def pairwise_weights(better: np.ndarray, worse: np.ndarray, ridge: float = RIDGE) -> np.ndarray:
    """Weights that minimise the mean logistic loss of the differences, by damped Newton steps."""
    x = better - worse
    w = np.zeros(x.shape[1])

    def loss(v: np.ndarray) -> float:
        return float(np.logaddexp(0.0, -(x @ v)).mean() + 0.5 * ridge * v @ v)

    now = loss(w)
    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(np.clip(x @ w, -500, 500)))
        gradient = -(x * p[:, None]).mean(0) + ridge * w
        hessian = (x * (p * (1 - p))[:, None]).T @ x / len(x) + ridge * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        size = 1.0
        while size > 1e-6 and (then := loss(w - size * step)) > now:
            size /= 2
        if size <= 1e-6 or now - then < 1e-10:
            break
        w, now = w - size * step, then
    return w


def fitted(rows: np.ndarray, good: np.ndarray) -> Ranking:
    """The model of few labelled rows of measures, by all their pairs; `good` is true for label 1."""
    width = len(MEASURES)
    mean = rows.mean(0) if len(rows) else np.zeros(width)
    scale = np.maximum(rows.std(0), 1e-6) if len(rows) else np.ones(width)
    above, below = np.flatnonzero(good), np.flatnonzero(~good)
    if not len(above) or not len(below):
        return Ranking(mean, scale, np.zeros(width), 0.0)
    first, second = np.repeat(above, len(below)), np.tile(below, len(above))
    z = np.clip((rows - mean) / scale, -8.0, 8.0)
    weights = pairwise_weights(z[first], z[second])
    threshold = float(np.quantile(z @ weights, len(below) / len(rows), method="midpoint"))
    return Ranking(mean, scale, weights, threshold)


def _fold(doc_id) -> F.Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS


def training_ids(labels: DataFrame, sample: int | None = None) -> DataFrame:
    """The labelled training rows; if asked for, only `sample` of them, those whose ids hash smallest."""
    own = labels.select(
        F.col("doc_id"), (F.col("quality") == 1).alias("good")
    ).dropna()
    own = own.where(_fold(F.col("doc_id")) != HELD_OUT)
    return own if sample is None else own.orderBy(F.xxhash64("doc_id"), "doc_id", "good").limit(sample)


# Fitting on Spark


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1)


def _lists(rows: np.ndarray) -> pa.Array:
    ends = pa.array(np.arange(len(rows) + 1) * rows.shape[1], pa.int32())
    return pa.ListArray.from_arrays(ends, pa.array(rows.ravel(), pa.float64()))


def _sums(train: DataFrame, of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sums over all rows of what `of` gives for some; one short row a task comes to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = sum((of(_matrix(b.column("measures"))).sum(0) for b in batches if b.num_rows), np.zeros(1))
        if len(total) > 1:
            task = pa.array([TaskContext.get().partitionId()], pa.int32())
            yield pa.record_batch({"task": task, "total": _lists(total[None])})

    parts = train.mapInArrow(run, "task int, total array<double>").collect()
    # In the order of tasks, so that a repeated run fits the same model.
    return np.sum([r["total"] for r in sorted(parts)], 0)


def _by_strength(train: DataFrame, model: Ranking) -> DataFrame:
    """`good, bin, place, total`: the moments of all rows, added up by class and bin of strength.

    Rows whose strengths differ by less than STEP share a bin. Each task adds its rows up, in whole
    numbers of 1 / UNITS, so that the order in which tasks are added is no matter.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            z = np.clip((_matrix(batch.column("measures")) - model.mean) / model.scale, -8.0, 8.0)
            good = batch.column("good").to_numpy(zero_copy_only=False).astype(bool)
            bins = np.clip(np.floor(z @ model.weights / STEP), -MOST_BINS, MOST_BINS).astype(np.int64)
            key, which = np.unique(bins * 2 + good, return_inverse=True)
            order = np.argsort(which, kind="stable")
            stats = np.add.reduceat(_moments(z)[order], np.searchsorted(which[order], np.arange(len(key))))
            for k, own in zip(key.tolist(), stats):
                total[k] = total[k] + own if k in total else own
        if total:
            keys = np.array(list(total))
            units = np.rint(np.stack(list(total.values())) * UNITS).astype(np.int64)
            ends = pa.array(np.arange(len(units) + 1) * units.shape[1], pa.int32())
            yield pa.record_batch(
                {
                    "good": pa.array(keys % 2 == 1),
                    "bin": pa.array(keys // 2, pa.int32()),
                    "totals": pa.ListArray.from_arrays(ends, pa.array(units.ravel(), pa.int64())),
                }
            )

    return (
        train.mapInArrow(run, "good boolean, bin int, totals array<long>")
        .select("good", "bin", F.posexplode("totals").alias("place", "total"))
        .groupBy("good", "bin", "place").agg(F.sum("total").alias("total"))
    )


_UPPER = np.triu_indices(len(MEASURES))


def _moments(z: np.ndarray) -> np.ndarray:
    """1, the measures, and their products."""
    return np.concatenate([np.ones((len(z), 1)), z, z[:, _UPPER[0]] * z[:, _UPPER[1]]], 1)


def _all_pairs(train: DataFrame, model: Ranking, ridge: float) -> tuple[float, np.ndarray, np.ndarray]:
    """Loss, gradient and Hessian over every pair of a row of label 1 and one of label 0.

    Both depend on a row by its strength and its measures alone, so rows are added up by class and
    bin of strength, and pairs of bins stand for all pairs of their rows. The driver gets the moments
    of at most 2 * (2 * MOST_BINS + 1) bins.
    """
    width = len(MEASURES)
    table = _by_strength(train, model).toArrow().sort_by([("bin", "ascending"), ("place", "ascending")])
    totals, side = table["total"].to_numpy() / UNITS, table["good"].to_numpy()
    sides = []
    for own in (True, False):
        stats = totals[side == own].reshape(-1, 1 + width + len(_UPPER[0]))
        n, means = stats[:, 0], stats[:, 1 : 1 + width] / stats[:, :1]
        products = np.zeros((len(n), width, width))
        products[:, _UPPER[0], _UPPER[1]] = products[:, _UPPER[1], _UPPER[0]] = stats[:, 1 + width :] / n[:, None]
        sides.append((n, means, products))
    (n, x, xx), (m, y, yy) = sides
    w = model.weights
    share = np.outer(n / n.sum(), m / m.sum())
    d = (x @ w)[:, None] - (y @ w)[None, :]
    loss = float((share * np.logaddexp(0.0, -d)).sum() + 0.5 * ridge * w @ w)
    p = 1.0 / (1.0 + np.exp(np.clip(d, -500, 500)))
    pull = share * p
    gradient = -(pull.sum(1) @ x - pull.sum(0) @ y) + ridge * w
    q = pull * (1 - p)
    cross = x.T @ q @ y
    hessian = (
        np.tensordot(q.sum(1), xx, 1) + np.tensordot(q.sum(0), yy, 1) - cross - cross.T + ridge * np.eye(width)
    )
    return loss, gradient, hessian


def all_pairs_ranking(train: DataFrame, scratch: Scratch, ridge: float = RIDGE) -> Ranking:
    """The model of all rows `good, measures` (saved) and all their pairs; rows stay with Spark."""
    width = len(MEASURES)
    n = train.count()
    mean = _sums(train, lambda rows: rows) / n
    scale = np.maximum(np.sqrt(_sums(train, lambda rows: (rows - mean) ** 2) / n), 1e-6)

    def at(weights: np.ndarray) -> Ranking:
        return Ranking(mean, scale, weights, 0.0)

    w = np.zeros(width)
    now, gradient, hessian = _all_pairs(train, at(w), ridge)
    for _ in range(STEPS):
        step = np.linalg.solve(hessian, gradient)
        if gradient @ step < 1e-9:
            break
        size = 1.0
        then = _all_pairs(train, at(w - step), ridge)
        while then[0] > now and size > 1e-3:
            size /= 2
            then = _all_pairs(train, at(w - size * step), ridge)
        if then[0] > now:
            break
        w, (now, gradient, hessian) = w - size * step, then
    model = at(w)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = pa.array(model.strength(_matrix(batch.column("measures"))), pa.float64())
            yield pa.record_batch({"name": pa.array(["strength"] * len(x), pa.string()), "x": x})

    strengths = scratch.saved(train.mapInArrow(run, "name string, x double"), "strengths")
    share = train.where("not good").count() / n
    _, found = quantiles(strengths, {"strength": [share]})
    scratch.drop("strengths")
    return Ranking(mean, scale, w, found["strength", share].midpoint)


def measured(docs: DataFrame) -> DataFrame:
    """`doc_id, measures` of every document."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts_ in chunks(batches):
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "measures": _lists(measures(texts_))})

    return texts(docs).mapInArrow(run, f"doc_id {id_type(docs).simpleString()}, measures array<double>")


def learned(rows: DataFrame, labels: DataFrame, scratch: Scratch) -> Ranking:
    """The model that the labelled training rows teach; `rows`: `measured` documents, saved.

    Few pairs (at most PAIRS) are fitted one by one on the driver, more of them by bins of strength.
    """
    ids = training_ids(labels).withColumnRenamed("doc_id", "labelled_id")
    train = scratch.saved(
        rows.join(ids, F.col("doc_id") == F.col("labelled_id")).select("good", "measures"), "train"
    )
    counts = {r["good"]: r["count"] for r in train.groupBy("good").count().collect()}
    above, below = counts.get(True, 0), counts.get(False, 0)
    if not above or not below:
        model = fitted(np.zeros((0, len(MEASURES))), np.zeros(0, bool))
    elif above * below <= PAIRS:
        table = train.toArrow()
        cells = _matrix(table["measures"].combine_chunks())
        good = table["good"].to_numpy().astype(bool)
        # The same order whatever tasks ended first, so that a repeated run fits the same model.
        order = np.lexsort((*cells.T, good))
        model = fitted(cells[order], good[order])
    else:
        model = all_pairs_ranking(train, scratch)
    scratch.drop("train")
    return model


def scored(rows: DataFrame, model: Ranking) -> DataFrame:
    """`doc_id, held_out, score, predicted` of every measured document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = pa.array(model.score(_matrix(batch.column("measures"))), pa.float64())
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "score": score})

    return (
        rows.mapInArrow(run, f"doc_id {id_type(rows).simpleString()}, score double")
        .select(
            "doc_id",
            (_fold(F.col("doc_id")) == HELD_OUT).alias("held_out"),
            "score",
            (F.col("score") >= THRESHOLD_SCORE).cast("int").alias("predicted"),
        )
    )


def ranked(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores by the model that `labels` (doc_id, quality) teach."""
    scratch = Scratch(docs.sparkSession)
    rows = scratch.saved(measured(docs), "measured")
    return scored(rows, learned(rows, labels, scratch))
