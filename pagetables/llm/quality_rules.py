"""Quality rules: counted base rules, and perplexity bands under an n-gram model of each language.

The model is a modified Kneser-Ney model of order 4 over code points (white space squeezed to one space), one for each language that
occurs and one for rows without a language. Tasks add up the 4-grams of their texts and Spark adds up the tasks. Continuation
counts of the lower orders, counts of counts, totals of contexts, the shares of grams, what their contexts leave to the lower order
and so the bits of every 4-gram are Spark aggregations and joins over all distinct grams; none is left out.

Every 4-gram that a text holds is in that table. The ``COMMON`` most frequent ones of a language are handed to the tasks, in arrays sorted
by 64-bit hash; a text's other grams leave the task with the number of its row and meet the table in a join. So the bits of a text are
those of the whole model whatever its alphabet, and only the rarest grams move. Bits are added up as whole numbers of 1/``FINE``, so the order
of adding doesn't matter. ``GROUP`` languages are learned and measured at a time, so driver and tasks hold the arrays of one group; every
further group is one more pass over the table.

``learn`` hands over arrays for texts that are not in the table, with an answer for every point after every three; those keep the grams
that make up at least 1/``KEPT`` of their order's counts in their language. ``judge`` doesn't use them.

A whole document is measured under the model of its own language, quotations in another language included. Its bits per
character (the log of the perplexity) must lie in the band of its own language: median minus ``LOWER`` and plus ``UPPER`` times the scaled median
absolute deviation over all documents of the language, from a complete histogram in steps of 0.001 bits. Short documents scatter more: a document of n characters gets its deviation scaled
by sqrt(n / (n + ``SHORT``)). Four characters tell words of the language from random letters in any script; the order of whole words
is not judged.

Null texts count as empty: no words, base failed. A null language is a language of its own. Rows are judged one by one,
so repeated rows get equal results. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from pagetables.llm.common import IS_SPACE, byte_sums, cut, mapped, row_counts, scatter, slices, span_hash, spans

#: Languages that are learned and measured together; 4-grams of a language that the tasks look up themselves; grams of an order and language in ``learn``'s arrays at most.
GROUP, COMMON, KEPT = 8, 1 << 16, 1 << 18
#: Order of the model, bits of a code point, grams of a language that a task adds up before it hands them on, parts of a bit, bytes of text at a time.
ORDER, POINT, HELD, FINE, PART = 4, 21, 1 << 18, 1 << 20, 1 << 19
GOLD = np.uint64(0x9E3779B97F4A7C15)
LOWER, UPPER, SHORT, STEP = 4.5, 5.0, 300, 1000
#: Fixed values of the base rules.
LEAST_WORDS, MOST_REPEATED, WINDOW, SYMBOLS = 10, 20, 5, b"#*$%&|<>"

IS_SYMBOL = np.zeros(256, bool)
IS_SYMBOL[list(SYMBOLS)] = True
IS_LINE_END = np.zeros(256, bool)
IS_LINE_END[10] = True


def grams(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every character, white space squeezed: the three code points before it in one number, its own, and its row."""
    at = np.flatnonzero((data & 0xC0) != 0x80)
    point = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), "<u4").astype(np.int64)
    space = mapped(data, IS_SPACE).view(bool)[at]
    keep = np.ones(len(at), bool)
    ends = np.searchsorted(at, bounds)  # of the rows, in characters
    keep[1:] = ~(space[1:] & space[:-1])
    keep[ends[:-1][ends[:-1] < len(at)]] = True
    point[space] = 32
    kept = np.flatnonzero(keep)
    size = np.diff(np.searchsorted(kept, ends))
    row = np.repeat(np.arange(len(size)), size)
    # Every row begins after three spaces.
    place = np.arange(len(kept)) + (ORDER - 1) * (row + 1)
    padded = np.full(len(kept) + (ORDER - 1) * len(size), 32, np.int64)
    padded[place] = point = point[kept]
    before = np.zeros(len(padded), np.int64)
    for back in range(ORDER - 1, 0, -1):
        before <<= POINT
        before[back:] |= padded[:-back]
    return before[place], point, row


def gram_hash(before: np.ndarray, point: np.ndarray) -> np.ndarray:
    return scatter(scatter(before.astype(np.uint64)) * GOLD + point.astype(np.uint64))


def added_up(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts of equal grams in one."""
    before, point, n = (np.concatenate(x) for x in zip(*parts, strict=True))
    which, distinct = pd.factorize(gram_hash(before, point))
    first = np.zeros(len(distinct), np.int64)
    first[which[::-1]] = np.arange(len(which))[::-1]
    return before[first], point[first], np.bincount(which, n, minlength=len(distinct)).astype(np.int64)


def count(docs: DataFrame) -> DataFrame:
    """``_slot, before, point, n`` of all documents; ``docs`` has ``_id, _text, _slot``."""

    def rows_of(slot: int, found: tuple[np.ndarray, np.ndarray, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for i in range(0, len(found[0]), 100_000):
            part = [x[i : i + 100_000] for x in found]
            columns = [np.full(len(part[0]), slot, np.int32), part[0], part[1].astype(np.int32), part[2]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["_slot", "before", "point", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        sizes: dict[int, int] = {}
        for batch in batches:
            slots = batch.column(2).to_numpy()
            for first, last, data, bounds in slices(batch.column(1), PART):
                before, point, row = grams(data, bounds)
                slot = slots[first:last][row]
                for s in np.unique(slot).tolist():
                    at = slot == s
                    held.setdefault(s, []).append(added_up([(before[at], point[at], np.ones(int(at.sum()), np.int64))]))
                    sizes[s] = sizes.get(s, 0) + len(held[s][-1][0])
                    if sizes[s] > HELD:
                        held[s] = [added_up(held[s])]
                        sizes[s] = len(held[s][0][0])
                        if sizes[s] > HELD // 2:
                            yield from rows_of(s, held.pop(s)[0])
                            sizes[s] = 0
        for s, parts in held.items():
            yield from rows_of(s, added_up(parts))

    rows = docs.select("_id", "_text", "_slot").mapInArrow(run, "_slot int, before long, point int, n long")
    return rows.groupBy("_slot", "before", "point").agg(F.sum("n").alias("n"))


def discounts(n: list[int]) -> list[float]:
    """What is taken off a count of 1, 2, and 3 or more, from how many grams have each count up to 4."""
    n = [max(1, x) for x in n]
    y = n[0] / (n[0] + 2 * n[1])
    return [min(max(k - (k + 1) * y * n[k] / n[k - 1], 0.05 * k), 0.95 * k) for k in (1, 2, 3)]


def levels(rows: DataFrame) -> dict[int, DataFrame]:
    """``_slot, before, point, n`` of every order: a gram of a lower order counts in how many distinct ways it is preceded."""
    out = {ORDER: cut(count(rows))}
    for order in range(ORDER - 1, 0, -1):
        out[order] = out[order + 1].groupBy("_slot", shorter(order).alias("before"), "point").agg(F.count(F.lit(1)).alias("n"))
    return out


def shorter(order: int) -> Column:
    """The context that a gram of the next higher order leaves to ``order``."""
    return F.col("before").bitwiseAND(F.lit((1 << POINT * (order - 1)) - 1))


def totals(orders: dict[int, DataFrame]) -> dict[tuple[int, int], Row]:
    """By order and language slot: how many grams have each count up to 4, the sum of counts, and the number of grams."""
    ones = [F.count_if(F.col("n") == k).alias(f"n{k}") for k in (1, 2, 3, 4)]
    parts = [
        level.groupBy(F.lit(order).alias("_order"), "_slot").agg(*ones, F.sum("n").alias("all"), F.count(F.lit(1)).alias("distinct"))
        for order, level in orders.items()
    ]
    return {(r["_order"], r["_slot"]): r for r in reduce(DataFrame.unionByName, parts).collect()}


def shares(level: DataFrame, order: int, found: dict[tuple[int, int], Row]) -> DataFrame:
    """``_slot, before, point, n, share, left`` of all grams of an order: the gram's own share, and what its context leaves to the lower order."""
    taken = [F.lit(0.0)] * 3
    for (o, slot), r in found.items():
        if o == order:
            own = discounts([r[f"n{k}"] for k in (1, 2, 3, 4)])
            taken = [F.when(F.col("_slot") == slot, d).otherwise(t) for d, t in zip(own, taken, strict=True)]
    context = Window.partitionBy("_slot", "before")
    n, total = F.col("n"), F.sum("n").over(context)
    off = F.when(n == 1, taken[0]).when(n == 2, taken[1]).otherwise(taken[2])
    have = [F.count_if(test).over(context) for test in (n == 1, n == 2, n > 2)]
    left = sum((h * t for h, t in zip(have, taken, strict=True)), F.lit(0.0)) / total
    return level.select("_slot", "before", "point", "n", ((n - off) / total).alias("share"), left.alias("left"))


def gram_bits(rows: DataFrame) -> DataFrame:
    """``_slot, before, point, n, bits`` of every distinct 4-gram of ``_id, _text, _slot``; bits in parts of 1/``FINE``."""
    orders = levels(rows)
    found = totals(orders)
    lower = F.lit(1.0)
    for (order, slot), r in found.items():
        if order == 1:
            lower = F.when(F.col("_slot") == slot, 1 / (r["distinct"] + 1)).otherwise(lower)
    level = shares(orders[1], 1, found).withColumn("p", F.col("share") + F.col("left") * lower)
    for order in range(2, ORDER + 1):
        below = level.select("_slot", F.col("before").alias("_shorter"), "point", F.col("p").alias("_p"))
        level = shares(orders[order], order, found).withColumn("_shorter", shorter(order - 1)).join(below, ["_slot", "_shorter", "point"])
        level = level.withColumn("p", F.col("share") + F.col("left") * F.col("_p"))
    return cut(level.select("_slot", "before", "point", "n", F.round(-F.log2("p") * FINE).cast("long").alias("bits")))


def common(table: DataFrame, most: int) -> tuple[dict[int, tuple[np.ndarray, np.ndarray]], DataFrame | None]:
    """Of ``gram_bits``: by language slot the most frequent grams' sorted hashes and bits, and the rows of all other grams, None without any."""
    # Counts up to 4096 one by one, then by powers of two, each named by the least count in it.
    step = F.when(F.col("n") < 4096, F.col("n")).otherwise(F.expr("shiftleft(1L, length(bin(n)) - 1)"))
    steps: dict[int, list[tuple[int, int]]] = {}
    for r in table.groupBy("_slot", step.alias("step")).agg(F.count(F.lit(1)).alias("grams")).collect():
        steps.setdefault(r["_slot"], []).append((r["step"], r["grams"]))
    least, rest = F.lit(0), False
    for slot, some in steps.items():
        held, bound = 0, 2 * max(some)[0]
        for n, grams_of in sorted(some, reverse=True):
            held += grams_of
            if held > most:
                rest = True
                break
            bound = n
        least = F.when(F.col("_slot") == slot, bound).otherwise(least)
    often = table.where(F.col("n") >= least).select("_slot", "before", "point", "bits").toArrow()
    slots, before, point, bits = (c.to_numpy() for c in often.columns)
    key = gram_hash(before, point)
    arrays = {}
    for slot in steps:
        own = np.flatnonzero(slots == slot)
        own = own[np.argsort(key[own])]
        arrays[slot] = key[own], bits[own]
    return arrays, table.where(F.col("n") < least) if rest else None


class Model:
    """One language: per order the sorted hashes of grams with their shares, and of contexts with what they leave."""

    def __init__(self, symbols: int) -> None:
        self.base = 1 / (symbols + 1)
        self.orders: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, before: np.ndarray, point: np.ndarray, share: np.ndarray) -> None:
        """The next order, from 1 up."""
        key = gram_hash(before, point)
        order = np.argsort(key)
        context, at = np.unique(scatter(before.astype(np.uint64)), return_inverse=True)
        left = np.maximum(1 - np.bincount(at, share, minlength=len(context)), 1e-9)
        self.orders.append((key[order], share[order].astype(np.float32), context, left.astype(np.float32)))

    def bits(self, before: np.ndarray, point: np.ndarray) -> np.ndarray:
        """Bits of every point after the three before it, by binary search from the lowest order up."""
        p = np.full(len(point), self.base)
        for k, (key, share, context, left) in enumerate(self.orders):
            own = before & ((1 << POINT * k) - 1)
            p *= found(context, left, scatter(own.astype(np.uint64)), 1.0)
            p += found(key, share, gram_hash(own, point), 0.0)
        return -np.log2(p)


def found(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, other: float) -> np.ndarray:
    """The value of every wanted key of a sorted array, ``other`` where it lacks."""
    if not len(keys):
        return np.full(len(wanted), other)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], other)


def learn(rows: DataFrame, kept: int = KEPT) -> dict[int, Model]:
    """The models of all language slots of ``_id, _text, _slot``, for texts that needn't be among them."""
    orders = levels(rows)
    found = totals(orders)
    models = {slot: Model(r["distinct"]) for (order, slot), r in found.items() if order == 1}
    for order in range(1, ORDER + 1):
        least = F.lit(1)
        for (o, slot), r in found.items():
            if o == order:
                least = F.when(F.col("_slot") == slot, r["all"] // kept + (r["all"] >= kept)).otherwise(least)
        some = shares(orders[order], order, found).where(F.col("n") >= least).select("_slot", "before", "point", "share").toPandas()
        parts = dict(tuple(some.groupby("_slot")))
        for s, model in models.items():
            own = parts.get(s, some.iloc[:0])
            model.add(own["before"].to_numpy(np.int64), own["point"].to_numpy(np.int64), own["share"].to_numpy(np.float64))
    return models


def repeated_words(hashes: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """Words in windows of five that occur twice or more in their text."""
    if len(hashes) < WINDOW:
        return np.zeros(rows, np.int64)
    n = len(hashes) - WINDOW + 1
    key = np.zeros(n, np.uint64)
    for i in range(WINDOW):
        key = scatter(key * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + n])
    whole = np.flatnonzero(row[:n] == row[WINDOW - 1 :])
    key = key[whole] ^ scatter(row[whole].astype(np.uint64) + np.uint64(1))
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(key), bool)
    twice[order[1:]] = same
    twice[order[:-1]] |= same
    change = np.zeros(len(hashes) + 1, np.int64)
    change[whole[twice]] += 1
    change[whole[twice] + WINDOW] -= 1
    return row_counts(row[np.cumsum(change[:-1]) > 0], rows)


def base_counts(data: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of every row."""
    rows = len(bounds) - 1
    start, end, row = spans(data, bounds, IS_SPACE)
    sums = byte_sums(data)
    letter = ((data & 0xC0) != 0x80) & (mapped(data, IS_SPACE) == 0)  # a character's first byte, in a word
    symbol = mapped(data, IS_SYMBOL)
    each = list(itertools.pairwise(bounds.tolist()))
    # Lines with a word; one is a duplicate if an earlier line of its text is equal.
    l_start, l_end, l_row = spans(data, bounds, IS_LINE_END)
    worded = np.searchsorted(start, l_end) > np.searchsorted(start, l_start)
    l_start, l_end, l_row = l_start[worded], l_end[worded], l_row[worded]
    key = span_hash(data, l_start, l_end, sums) ^ scatter(l_row.astype(np.uint64) + np.uint64(1))
    _, firsts = np.unique(key, return_index=True)
    lines = row_counts(l_row, rows)
    return [
        row_counts(row, rows),
        np.array([np.count_nonzero(letter[a:b]) for a, b in each], np.int64),
        np.array([np.count_nonzero(symbol[a:b]) for a, b in each], np.int64),
        lines - row_counts(l_row[firsts], rows),
        repeated_words(span_hash(data, start, end, sums), row, rows),
    ]


def measure(docs: DataFrame, arrays: dict[int, tuple[np.ndarray, np.ndarray]], kind: str) -> DataFrame:
    """``_id, _slot``, base counts, ``_size`` in characters, ``_sum`` of the common grams' bits, and the other grams, for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(arrays)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slots = batch.column(2).to_numpy()
            for first, last, data, bounds in slices(batch.column(1), PART):
                rows = last - first
                before, point, row = grams(data, bounds)
                size = row_counts(row, rows)
                own, bits, other = slots[first:last][row], np.zeros(rows), np.zeros(len(row), bool)
                for s in np.unique(own).tolist():
                    at = np.flatnonzero(own == s)
                    # Every distinct gram is looked up once a slice.
                    which, distinct = pd.factorize(gram_hash(before[at], point[at]))
                    value = found(*shared.value[s], distinct, -1)[which]
                    bits += row_counts(row[at], rows, np.maximum(value, 0))
                    other[at] = value < 0
                # Rows stand one after the other, so do their grams.
                ends = _offsets(row[other], rows)
                lists = [pa.ListArray.from_arrays(ends, pa.array(x[other])) for x in (before, point.astype(np.int32))]
                out = [*base_counts(data, bounds), size, bits.astype(np.int64)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, rows), pa.array(slots[first:last]), *map(pa.array, out), *lists], names
                )

    names = ["_id", "_slot", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "_size", "_sum", "_before", "_point"]
    shape = f"_id {kind}, _slot int, {', '.join(f'{n} long' for n in names[2:-2])}, _before array<long>, _point array<int>"
    return docs.select("_id", "_text", "_slot").mapInArrow(run, shape)


def _offsets(row: np.ndarray, rows: int) -> pa.Array:
    return pa.array(np.concatenate([[0], np.cumsum(row_counts(row, rows))]), pa.int32())


def whole_bits(measured: DataFrame, rest: DataFrame | None) -> DataFrame:
    """``measured`` with ``bits`` per character; the grams that the tasks had no bits of get theirs from the table ``rest``."""
    total = F.col("_sum")
    if rest is not None:
        measured = cut(measured.withColumn("_row", F.monotonically_increasing_id()))
        other = measured.select("_row", "_slot", F.inline(F.arrays_zip("_before", "_point")).alias("before", "point"))
        theirs = rest.select("_slot", "before", "point", "bits")
        added = other.join(theirs, ["_slot", "before", "point"]).groupBy("_row").agg(F.sum("bits").alias("_rest"))
        measured = measured.join(added, "_row", "left")
        total = total + F.coalesce("_rest", F.lit(0))
    size = F.greatest("_size", F.lit(1))
    return measured.withColumn("bits", total / FINE / size).drop("_row", "_rest", "_sum", "_before", "_point")


def middle(values: np.ndarray, weights: np.ndarray) -> float:
    order = np.argsort(values, kind="stable")
    sums = np.cumsum(weights[order])
    return float(values[order][np.searchsorted(sums, sums[-1] / 2)])


def bands(measured: DataFrame) -> dict[int, tuple[float, float]]:
    """Per language slot: median and scaled median absolute deviation of the bits, from a histogram of all documents."""
    steps = measured.where("n_words > 0").groupBy("_slot", F.round(F.col("bits") * STEP).cast("int").alias("_bin")).count()
    out = {}
    for slot, group in steps.toPandas().groupby("_slot"):
        values, weights = group["_bin"].to_numpy() / STEP, group["count"].to_numpy()
        center = middle(values, weights)
        out[int(slot)] = (center, max(1.4826 * middle(np.abs(values - center), weights), 1 / STEP))
    return out


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Per row: id, base counts, ``base_failed, kept``, and ``bits, perplexity, band_low, band_high``."""
    langs = [r[0] for r in docs.select(F.col(f"`{lang_col}`").alias("_lang")).groupBy("_lang").count().orderBy(F.desc("count"), "_lang").collect()]
    kind = docs.schema[id_col].dataType.simpleString()
    parts = [judged(docs, langs[i : i + GROUP], kind, id_col, text_col, lang_col) for i in range(0, max(len(langs), 1), GROUP)]
    return reduce(DataFrame.unionByName, parts)


def judged(docs: DataFrame, langs: list, kind: str, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """``judge`` for the rows of some languages."""
    lang, slot, own = F.col(f"`{lang_col}`"), F.lit(-1), F.lit(False)
    for i, name in enumerate(langs):
        slot = F.when(lang.eqNullSafe(F.lit(name)), i).otherwise(slot)
        own = own | lang.eqNullSafe(F.lit(name))
    rows = docs.where(own).select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text"), slot.alias("_slot"))
    arrays, rest = common(gram_bits(rows), COMMON)
    measured = cut(whole_bits(measure(rows, arrays, kind), rest))
    found = bands(measured)
    center, spread = F.lit(0.0), F.lit(1.0)
    for s, (c, d) in found.items():
        center, spread = F.when(F.col("_slot") == s, c).otherwise(center), F.when(F.col("_slot") == s, d).otherwise(spread)
    size = F.greatest("_size", F.lit(1))
    wide = spread / F.sqrt(size / (size + SHORT))
    out = measured.withColumn("band_low", center - LOWER * wide).withColumn("band_high", center + UPPER * wide)
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return out.select(
        F.col("_id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & F.col("bits").between(F.col("band_low"), F.col("band_high"))).alias("kept"),
        "bits", F.pow(F.lit(2.0), "bits").alias("perplexity"), "band_low", "band_high",
    )


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that the rules reject go. A row stays if the verdict on its id holds for all its rows."""
    gone = judge(docs).where("not kept").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"].eqNullSafe(gone["_gone"]), "left_anti")
