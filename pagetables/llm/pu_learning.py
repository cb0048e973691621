"""Non-negative positive-unlabelled learning of a linear model over sets of hashed features, in numpy.

The risk of a classifier under a class prior is estimated from positives and unlabelled texts alone: the positives'
loss as positive, plus the unlabelled texts' loss as negative less what the positives among them contribute. The
latter part can't be negative in truth; where the estimate is, the step goes against it instead of with it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagetables.llm.common import row_counts, slices

#: Size of the hashed feature space, and bounds of the sample that a classifier is fitted on (rows of each kind).
FEATURES = 1 << 18
POSITIVES, UNLABELLED, CONTRAST = 3000, 6000, 3000
#: A feature is used if so many of the sample's texts have it, and its shares among positives and unlabelled texts
#: differ by so many standard errors.
LEAST, SURE = 12, 3.5
STEPS, RATE, DECAY = 250, 0.05, 2e-4

Featurize = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


class Sets:
    """Feature sets of some texts: ``row`` and ``feature`` of every member, sorted by row."""

    def __init__(self, lists: list[np.ndarray]) -> None:
        self.n = len(lists)
        self.row = np.repeat(np.arange(self.n), [len(x) for x in lists])
        self.feature = np.concatenate([*lists, np.zeros(0, np.int32)]).astype(np.int64)

    def keep(self, place: np.ndarray) -> None:
        at = place[self.feature]
        self.row, self.feature = self.row[at >= 0], at[at >= 0]

    def times(self, weights: np.ndarray) -> np.ndarray:
        return row_counts(self.row, self.n, weights[self.feature])

    def back(self, slopes: np.ndarray, width: int) -> np.ndarray:
        return np.bincount(self.feature, slopes[self.row], minlength=width)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit(positive: Sets, unlabelled: Sets, prior: float) -> tuple[np.ndarray, np.ndarray, float]:
    """Features used, their weights and the bias."""
    p, u = (np.bincount(s.feature, minlength=FEATURES) / s.n for s in (positive, unlabelled))
    both = (p * positive.n + u * unlabelled.n) / (positive.n + unlabelled.n)
    doubt = np.sqrt(both * (1 - both) * (1 / positive.n + 1 / unlabelled.n)) + 1e-12
    used = np.flatnonzero((both * (positive.n + unlabelled.n) >= LEAST) & (np.abs(p - u) >= SURE * doubt))
    place = np.full(FEATURES, -1)
    place[used] = np.arange(len(used))
    positive.keep(place)
    unlabelled.keep(place)
    w, bias = np.zeros(len(used)), np.log(prior / (1 - prior))
    first, second = np.zeros(len(used) + 1), np.zeros(len(used) + 1)
    for step in range(1, STEPS + 1):
        p, u = sigmoid(positive.times(w) + bias), sigmoid(unlabelled.times(w) + bias)
        negative = -np.log1p(-u * (1 - 1e-9)).mean() + prior * np.log1p(-p * (1 - 1e-9)).mean()
        as_positive = -prior * (1 - p) / positive.n  # slopes of the logistic losses in the scores
        less, as_negative = -prior * p / positive.n, u / unlabelled.n
        if negative >= 0:
            up, uu = as_positive + less, as_negative
        else:
            up, uu = -less, -as_negative
        slope = np.append(positive.back(up, len(used)) + unlabelled.back(uu, len(used)) + DECAY * w, up.sum() + uu.sum())
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        move = RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
        w, bias = w - move[:-1], bias - move[-1]
    return used, w, float(bias)


def calibrate(scores: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift that make the sigmoid of the score a probability, by Newton steps with smoothed labels."""
    if len(np.unique(labels)) < 2:
        return 1.0, 0.0
    center, spread = scores.mean(), scores.std() + 1e-9
    x = np.stack([(scores - center) / spread, np.ones(len(scores))])
    n1, n0 = labels.sum(), (1 - labels).sum()
    y = np.where(labels > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    beta = np.array([1.0, 0.0])
    for _ in range(50):
        p = sigmoid(beta @ x)
        hessian = (x * (p * (1 - p))) @ x.T + 1e-3 * np.eye(2)
        move = np.linalg.solve(hessian, x @ (p - y) + 1e-3 * beta * [1, 0])
        beta = beta - np.clip(move, -2, 2)
    slope = max(beta[0], 1e-3) / spread
    return float(slope), float(beta[1] - slope * center)


class Model:
    """Weight of every feature (0: not used), bias and calibration."""

    def __init__(self, used: np.ndarray, weights: np.ndarray, bias: float, slope: float, shift: float) -> None:
        self.weights = np.zeros(FEATURES, np.float32)
        self.weights[used] = weights
        self.bias, self.slope, self.shift = bias, slope, shift

    def score(self, row: np.ndarray, feature: np.ndarray, rows: int) -> np.ndarray:
        live = self.weights[feature] != 0
        members = np.unique(row[live] * FEATURES + feature[live])
        raw = row_counts(members // FEATURES, rows, self.weights[members % FEATURES]) + self.bias
        return sigmoid(self.slope * raw + self.shift)


def sample_features(rows: DataFrame, featurize: Featurize) -> dict[str, list[np.ndarray]]:
    """Feature sets of the sampled rows ``_kind, _id, _text`` by kind, in the order of the identifiers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, bounds in slices(batch.column(2)):
                row, feature = featurize(data, bounds)
                members = np.unique(row * FEATURES + feature)
                at = np.searchsorted(members, np.arange(last - first + 1) * FEATURES).astype(np.int32)
                sets = pa.ListArray.from_arrays(pa.array(at), pa.array((members % FEATURES).astype(np.int32)))
                kinds, ids = (batch.column(i).slice(first, last - first) for i in (0, 1))
                yield pa.RecordBatch.from_arrays([kinds, ids, sets], ["_kind", "_id", "features"])

    kind = rows.schema["_id"].dataType.simpleString()
    found = rows.mapInArrow(run, f"_kind string, _id {kind}, features array<int>").toPandas()
    found = found.sort_values(["_kind", "_id"])
    return {k: list(g["features"]) for k, g in found.groupby("_kind")}


def first_ids(rows: DataFrame, n: int) -> list:
    """At most ``n`` identifiers, by a hash of them."""
    return [r[0] for r in rows.select("_id").distinct().orderBy(F.xxhash64("_id"), "_id").limit(n).collect()]


def train(
    docs: DataFrame, labels: DataFrame, label_col: str, learnable: Column, featurize: Featurize,
    id_col: str, text_col: str, usual: float,
) -> Model:
    """Fit on a bounded sample: positives, unlabelled texts, and rows labelled 0, which serve only the prior's
    estimate and the calibration. ``learnable`` is a condition on ``_id``. With no positive at all the model is
    constant and gives the prior (``usual`` if there is no label)."""
    marks = labels.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{label_col}`").alias("_y"))
    marks = marks.where("_id is not null and _y is not null").where(learnable)
    counts = {bool(r["_y"]): r["count"] for r in marks.groupBy((F.col("_y") > 0).alias("_y")).count().collect()}
    ones, zeros = counts.get(True, 0), counts.get(False, 0)
    prior = ones / (ones + zeros) if ones and zeros else usual
    constant = Model(np.zeros(0, int), np.zeros(0), float(np.log(prior / (1 - prior))), 1.0, 0.0)
    texts = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text")).where("_id is not null")
    chosen = {
        "positive": first_ids(marks.where("_y > 0"), POSITIVES),
        "contrast": first_ids(marks.where("_y <= 0"), CONTRAST),
        "unlabelled": first_ids(texts.where(learnable), UNLABELLED),
    }
    if not chosen["positive"] or not chosen["unlabelled"]:
        return constant
    spark, kind = docs.sparkSession, docs.schema[id_col].dataType.simpleString()
    picked = spark.createDataFrame([(k, i) for k, ids in chosen.items() for i in ids], f"_kind string, _id {kind}")
    # The picked identifiers are few, by the bounds above.
    rows = texts.join(F.broadcast(picked), "_id").select("_kind", "_id", "_text")
    sets = {k: Sets(v) for k, v in sample_features(rows, featurize).items()}
    if "positive" not in sets or "unlabelled" not in sets:
        return constant
    checks = {k: Sets([]) for k in ("positive", "contrast")}
    for k in checks:
        if k in sets:
            checks[k].n, checks[k].row, checks[k].feature = sets[k].n, sets[k].row, sets[k].feature
    used, weights, bias = fit(sets["positive"], sets["unlabelled"], prior)
    model = Model(used, weights, bias, 1.0, 0.0)
    raw = {k: s.times(model.weights) + bias for k, s in checks.items()}
    # Each kind weighs as it does among all labelled rows.
    scores = np.concatenate([raw["positive"], raw["contrast"]])
    truth = np.repeat([1, 0], [len(raw["positive"]), len(raw["contrast"])])
    slope, shift = calibrate(scores, truth)
    if checks["contrast"].n:
        shift += float(np.log(prior / (1 - prior)) - np.log(checks["positive"].n / checks["contrast"].n))
    return Model(used, weights, bias, slope, shift)


def apply(docs: DataFrame, model: Model, featurize: Featurize, id_col: str, text_col: str) -> DataFrame:
    """``<id>, score`` for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, bounds in slices(batch.column(1)):
                scores = shared.value.score(*featurize(data, bounds), last - first)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first), pa.array(scores)], ["_id", "score"]
                )

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text"))
    return rows.mapInArrow(run, f"_id {kind}, score double").withColumnRenamed("_id", id_col)
