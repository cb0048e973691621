"""Quality by positive-unlabelled learning: trusted good texts against unlabelled web text.

Features of a text describe how it is written, each as the step that a share falls into: symbols, capitals, digits,
punctuation, exclamation marks, column bars and white space among its characters, different words and words like the one
before among its words, repeated lines, the length of its words and of the text; and which non-letters its words begin or end with. See
``pu_learning`` for the non-negative risk, the bounds of the sample and the calibration. Null and empty texts have the
features of nothing and are scored like any other. Rows are scored one by one, so repeated rows get equal scores;
without any label all scores are ``USUAL``. Other columns are never read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagetables.llm import pu_learning
from pagetables.llm.common import IS_SPACE, LOWER, code_points, row_counts, scatter, span_hash, spans

USUAL, THRESHOLD = 0.5, 0.7
#: Shares are cut into steps that get finer towards 0.
EDGES = np.array([0.0, 0.0005, 0.002, 0.005, 0.01, 0.02, 0.035, 0.05, 0.075, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 0.97])
LINE_END = np.zeros(256, bool)
LINE_END[10] = True


def mark(which: bytes | range) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(which)] = True
    return out


GROUPS = [
    mark(b"#*$%&<>@^~_=+/\\{}[]"), mark(range(65, 91)), mark(range(48, 58)), mark(b".,;:"), mark(b"!?"), mark(b"|"),
    IS_SPACE, mark(range(97, 123)), mark(range(128, 256)),
]


def features(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    rows = len(bounds) - 1
    start, end, row = spans(data, bounds, IS_SPACE)
    words, points = row_counts(row, rows), code_points(data)
    size = np.diff(points[bounds])
    hashes = span_hash(LOWER[data], start, end)
    different = np.unique(hashes ^ scatter(row.astype(np.uint64) + np.uint64(1)), return_index=True)[1]
    l_start, l_end, l_row = spans(data, bounds, LINE_END)
    lines = span_hash(data, l_start, l_end) ^ scatter(l_row.astype(np.uint64) + np.uint64(1))
    l_first = np.unique(lines, return_index=True)[1]
    shares = [np.diff(np.concatenate([[0], np.cumsum(g[data])])[bounds]) / np.maximum(np.diff(bounds), 1) for g in GROUPS]
    shares.append(row_counts(row[different], rows) / np.maximum(words, 1))
    again = (hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1])
    shares.append(row_counts(row[1:][again], rows) / np.maximum(words, 1))
    shares.append(row_counts(l_row[l_first], rows) / np.maximum(row_counts(l_row, rows), 1))
    steps = [np.searchsorted(EDGES, s, "right") for s in shares]
    steps.append(np.minimum(size / np.maximum(words, 1) * 2, 60).astype(np.int64))
    steps.append(np.log2(size + 1).astype(np.int64))
    every = np.arange(rows)
    out_row = [every] * len(steps)
    keys = [scatter((np.uint64(1000 * (i + 1)) + s.astype(np.uint64))) for i, s in enumerate(steps)]
    # Non-letters at either end of a word; ASCII ones by themselves, with their number up to three.
    for at, sign in ((start, 1), (end - 1, -1)):
        byte = data[at] if len(at) else np.zeros(0, np.uint8)
        odd = (byte < 128) & ~GROUPS[1][byte] & ~GROUPS[7][byte] & ~GROUPS[2][byte]
        inner = np.clip(at + sign, start, np.maximum(end - 1, 0))
        twice = (data[inner] == byte) & (inner != at) if len(at) else odd
        out_row.append(row[odd])
        keys.append(scatter(np.uint64(1 << 40) + byte[odd].astype(np.uint64) * np.uint64(8) + np.uint64(2 + sign) + twice[odd].astype(np.uint64) * np.uint64(4)))
    return np.concatenate(out_row), (np.concatenate(keys) % np.uint64(pu_learning.FEATURES)).astype(np.int64)


def score(
    docs: DataFrame, labels: DataFrame, learnable: Column, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "quality",
) -> DataFrame:
    """``<id>, score, predicted`` for every row; ``learnable`` says on ``_id`` whose labels may be used."""
    model = pu_learning.train(docs, labels, label_col, learnable, features, id_col, text_col, USUAL)
    scored = pu_learning.apply(docs, model, features, id_col, text_col)
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
