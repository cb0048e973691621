"""Language by cross-parsing: the language whose labelled text parses a text into the fewest phrases wins.

For each language a suffix automaton of a bounded labelled sample accepts exactly the substrings of that sample.
A text is parsed greedily: a phrase is the longest match from where it begins; then the next phrase begins. Few
phrases per byte mean a small cross entropy with the sample. Texts are parsed whole, in pieces of ``PIECE`` bytes
at whose ends a phrase ends too, so that many pieces walk through the automata side by side; the phrase counts of
all pieces of a text are added up.

The sample: of the training rows with a label, per language those that come first by a hash of the identifier,
``ROWS`` rows at most, up to its share of ``SAMPLE`` bytes, which is that of ``GROUP`` languages if there are more. Every label
is learned: the automata of ``GROUP`` languages are held at a time, and with more languages each batch of texts walks
through one group after the other, which builds its automata again.
Texts that are null or have no letter get ``und`` and score 0; with no labelled row at all every text does. Equal
phrase counts go to the language that sorts first. ``score`` is the winner's share when every phrase more halves a
language's weight.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagetables.llm.common import LOWER, SLICE, slices

SAMPLE, ROWS, GROUP, PIECE = 160_000, 100, 4, 192
NO_LETTER = np.array([b < 128 and not chr(b).isalpha() for b in range(256)])


def suffix_automaton(text: bytes) -> list[dict[int, int]]:
    """Transitions of the smallest automaton that accepts all substrings of ``text``; state 0 begins."""
    step: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in text:
        new = len(step)
        step.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = new
            p = link[p]
        if p >= 0:
            q = step[p][c]
            if length[p] + 1 == length[q]:
                link[new] = q
            else:
                copy = len(step)
                step.append(dict(step[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and step[p].get(c) == q:
                    step[p][c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    return step


def parser(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """``next[state * symbols + symbol]`` and the symbol of each byte. A negative entry ends a phrase: its
    complement is the state after the first byte of the next. Symbol 0 stands for bytes the sample lacks."""
    step = suffix_automaton(text)
    symbols = np.zeros(256, np.uint8)
    present = sorted(set(text))
    symbols[present] = np.arange(1, len(present) + 1)
    width = len(present) + 1
    # A byte that the sample lacks is a phrase of its own: the state behind it, the last one, has no way on.
    begin = np.full(width, len(step), np.int32)
    for c, to in step[0].items():
        begin[symbols[c]] = to
    out = np.tile(~(begin * width), (len(step) + 1, 1))
    for state, edges in enumerate(step):
        if edges:
            out[state, symbols[list(edges)]] = np.array(list(edges.values()), np.int32) * width
    return out.ravel(), symbols


def squeeze(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower case, and one space for each run of ASCII characters that are no letters."""
    if not len(data):
        return data, bounds
    space = NO_LETTER[data]
    keep = np.ones(len(data), bool)
    keep[1:] = ~(space[1:] & space[:-1])
    kept = np.zeros(len(data) + 1, np.int64)
    np.cumsum(keep, out=kept[1:])
    return np.where(space, np.uint8(32), LOWER[data])[keep], kept[bounds]


def phrases(data: np.ndarray, bounds: np.ndarray, model: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Number of phrases of every row."""
    table, symbols = model
    size = np.diff(bounds)
    pieces = -(-size // PIECE)
    row = np.repeat(np.arange(len(size)), pieces)
    if not len(row):
        return np.zeros(len(size), np.int64)
    rank = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    start = bounds[:-1][row] + rank * PIECE
    long = np.minimum(size[row] - rank * PIECE, PIECE)
    order = np.argsort(-long, kind="stable")
    start, long, row = start[order], long[order], row[order]
    coded = symbols[data]
    state, count = np.zeros(len(row), np.int32), np.ones(len(row), np.int64)
    active = np.searchsorted(-long, -np.arange(PIECE), "left")  # pieces that have a byte at this offset
    for i in range(int(long[0])):
        n = active[i]
        to = table[state[:n] + coded[start[:n] + i]]
        ended = to < 0
        state[:n] = np.where(ended, ~to, to)
        if i:
            count[:n] += ended
    return np.bincount(row, count, minlength=len(size)).astype(np.int64)


def learn(docs: DataFrame, training: Column, id_col: str, text_col: str, lang_col: str) -> dict[str, bytes]:
    """Per language the sample text, each bounded by ``SAMPLE`` and ``ROWS``."""
    rows = docs.where(training & F.col(lang_col).isNotNull()).select(
        F.col(lang_col).alias("_lang"), F.col(id_col).alias("_id"), F.col(text_col).alias("_text")
    )
    langs = [r[0] for r in rows.groupBy("_lang").count().orderBy(F.desc("count"), "_lang").collect()]
    if not langs:
        return {}
    share = SAMPLE // min(len(langs), GROUP)
    # Only identifiers are ranked; a rank limit cuts each task's rows before they move. Few, known ids then meet the texts.
    order = Window.partitionBy("_lang").orderBy(F.xxhash64("_id"), "_id")
    out: dict[str, bytes] = {}
    for i in range(0, len(langs), 32):
        some = rows.where(F.col("_lang").isin(langs[i : i + 32]))
        ids = some.select("_lang", "_id").withColumn("_n", F.row_number().over(order))
        chosen = {r["_id"] for r in ids.where(F.col("_n") <= ROWS).collect()} - {None}
        texts = some.where(F.col("_id").isin(sorted(chosen)))
        texts = texts.select("_lang", "_id", F.xxhash64("_id").alias("_h"), F.substring("_text", 1, share).alias("_text")).collect()
        for r in sorted(texts, key=lambda r: (r["_lang"], r["_h"], r["_id"], r["_text"] or "")):
            have = out.get(r["_lang"], b"")
            if len(have) < share:
                data, _ = squeeze(np.frombuffer((r["_text"] or "").encode(), np.uint8), np.zeros(1, np.int64))
                out[r["_lang"]] = (have + data.tobytes() + b" ")[:share]
    return out


def predict(docs: DataFrame, samples: dict[str, bytes], id_col: str, text_col: str) -> DataFrame:
    """``<id>, lang_pred, score`` and ``phrases_per_byte`` for every row of ``docs``."""
    spark = docs.sparkSession
    names = sorted(samples)
    shared = spark.sparkContext.broadcast(samples)
    models: list = []

    def groups() -> Iterator[list]:
        if len(names) <= GROUP:
            if not models:
                models.extend(parser(shared.value[n]) for n in names)
            yield models
        else:
            for i in range(0, len(names), GROUP):
                yield [parser(shared.value[n]) for n in names[i : i + GROUP]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            letters = np.asarray(batch.column(2).to_numpy(zero_copy_only=False), bool)
            texts = ((first, last, *squeeze(data, bounds)) for first, last, data, bounds in slices(batch.column(1), SLICE))
            # Automata that are built again should see many texts; those that stay see slice after slice.
            for some_texts in [list(texts)] if len(names) > GROUP else ([t] for t in texts):
                counts, place = np.zeros((len(names), batch.num_rows), np.int64), 0
                for group in groups() if names else ():
                    for i, model in enumerate(group):
                        for first, last, data, bounds in some_texts:
                            counts[place + i, first:last] = phrases(data, bounds, model)
                    place += len(group)
                for first, last, _, bounds in some_texts:
                    some = letters[first:last] & bool(names)
                    pred = np.full(last - first, "und", object)
                    score, rate = np.zeros(last - first), np.zeros(last - first)
                    if names:
                        own = counts[:, first:last]
                        least = own.min(0)
                        pred[some] = np.array(names, object)[own.argmin(0)[some]]
                        score[some] = (1 / np.exp2(-np.minimum(own - least, 60).astype(float)).sum(0))[some]
                        rate[some] = (least / np.maximum(np.diff(bounds), 1))[some]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(first, last - first), pa.array(pred, pa.string()), pa.array(score), pa.array(rate)],
                        ["_id", "lang_pred", "score", "phrases_per_byte"],
                    )

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(
        F.col(f"`{id_col}`").alias("_id"),
        F.col(f"`{text_col}`").alias("_text"),
        F.coalesce(F.col(f"`{text_col}`").rlike(r"\p{L}"), F.lit(False)).alias("_letter"),
    )
    out = rows.mapInArrow(run, f"_id {kind}, lang_pred string, score double, phrases_per_byte double")
    return out.withColumnRenamed("_id", id_col)


def identify(
    docs: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """Learn from the rows where ``training`` holds, predict for all."""
    return predict(docs, learn(docs, training, id_col, text_col, lang_col), id_col, text_col)
