"""Toxicity by non-negative positive-unlabelled learning: confirmed toxic texts against unlabelled text.

Features of a text are the words it has (lower case, runs of letters) and the beginnings of its longer words, hashed;
how often or where a word stands does not count. See ``pu_learning`` for the risk, the bounds of the sample and the
calibration. Null and empty texts have no feature and get the score of the bias alone. Rows are scored one by one, so
repeated rows get equal scores; without any label all scores are ``USUAL``. Other columns are never read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagetables.llm import pu_learning
from pagetables.llm.common import LOWER, span_hash, spans

USUAL, THRESHOLD = 0.1, 0.5
#: Lengths in bytes of the word beginnings that are features of their own.
BEGINNINGS = (5,)
NO_LETTER = np.array([b < 128 and not chr(b).isalpha() for b in range(256)])


def features(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    data = LOWER[data]
    start, end, row = spans(data, bounds, NO_LETTER)
    rows, keys = [row], [span_hash(data, start, end)]
    for n in BEGINNINGS:
        longer = end - start > n
        rows.append(row[longer])
        keys.append(span_hash(data, start[longer], start[longer] + n) + np.uint64(n))
    return np.concatenate(rows), (np.concatenate(keys) % np.uint64(pu_learning.FEATURES)).astype(np.int64)


def score(
    docs: DataFrame, labels: DataFrame, learnable: Column, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "toxic",
) -> DataFrame:
    """``<id>, score, predicted`` for every row; ``learnable`` says on ``_id`` whose labels may be used."""
    model = pu_learning.train(docs, labels, label_col, learnable, features, id_col, text_col, USUAL)
    scored = pu_learning.apply(docs, model, features, id_col, text_col)
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
