"""How far the sources of a language are from each other in their words.

Every group, a source within a language, is a row of a matrix whose columns are the terms kept for the language; a cell holds
how often the group uses the term. A task takes one block of columns and the rows of two tiles of groups and keeps its part of the
matrix as a quadtree: level by level, each quadrant that holds any count has one bit for each of its four
quadrants, and the running number of set bits says where its own quadrants stand on the next level. All pairs of rows go down
the tree together. Where both quadrants are empty, every cell in them has the share of an unseen term in its
group, so only the number of columns is noted, to be priced at once; where one isn't empty the walk goes on to the cells.

Shares are whole numbers, ``1 + floor(10^9 * (count + add) / (N + add * V))``; products are taken in decimals of 38 digits.
Only sums and identifiers of groups leave a task; neither a group nor a language has to fit into one. The number of a pair's
rows on the way is the number of blocks.

Null text, language and source count as ''. A text of any length is counted in slices, a group without kept terms is a row
of zeros, equal rows count twice, ties are ordered by the bytes of the item, an empty table gives an empty result, and further
columns of the input play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagetables.llm.common import LOWER, cut, slices, spans

#: Least documents of a language that hold a kept term, what is added to every count, terms listed for a group.
MIN_DOCS, ADD, TOP = 30, 5, 50
SCALE = 1_000_000_000
#: Columns and rows of a task's part of the matrix on average; groups that are broadcast at most.
COLUMNS, ROWS, SMALL = 2048, 256, 50_000
#: Text counted together, pairs of quadrants walked together.
COUNTED, WALKED = 1 << 23, 1 << 17

#: Bytes between terms: ASCII that isn't a letter.
BETWEEN = np.ones(256, bool)
BETWEEN[65:91] = BETWEEN[97:123] = BETWEEN[128:] = False


def count_terms(docs: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    """``lang, source, term, n, docs`` summed within slices of texts; a row without term for every group that occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, source, text = (pc.fill_null(c.cast(pa.string()), "") for c in batch.columns)
            langs, sources = lang.dictionary_encode(), source.dictionary_encode()
            group = langs.indices.to_numpy().astype(np.int64) * len(sources.dictionary) + sources.indices.to_numpy()
            for first, last, data, bounds in slices(text, COUNTED):
                start, end, row = spans(data, bounds, BETWEEN)
                offsets = np.append(0, np.cumsum(end - start)).astype(np.int32)
                kept = LOWER[data[~BETWEEN[data]]]
                terms = pa.StringArray.from_buffers(len(start), pa.py_buffer(offsets), pa.py_buffer(kept)).dictionary_encode()
                wide = len(terms.dictionary) + 1
                there = np.unique(group[first:last])
                in_doc, n = np.unique(row * wide + terms.indices.to_numpy(), return_counts=True)
                key = group[first:last][in_doc // wide] * wide + in_doc % wide
                cells, which = np.unique(key, return_inverse=True)
                of, term = np.append(cells // wide, there), np.append(cells % wide, np.full(len(there), wide - 1))
                sums = np.bincount(which, n, minlength=len(cells)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        langs.dictionary.take(pa.array(of // len(sources.dictionary))),
                        sources.dictionary.take(pa.array(of % len(sources.dictionary))),
                        terms.dictionary.take(pa.array(term, mask=term == wide - 1)),
                        pa.array(np.append(sums, np.zeros(len(there), np.int64))),
                        pa.array(np.append(np.bincount(which, minlength=len(cells)), np.zeros(len(there), np.int64))),
                    ],
                    ["lang", "source", "term", "n", "docs"],
                )

    read = docs.select(*[F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate((lang_col, source_col, text_col))])
    return read.mapInArrow(run, "lang string, source string, term string, n bigint, docs bigint")


def kept_cells(docs: DataFrame, min_docs: int, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    """``lang, source, term, n, lang_n, head``: counts of the kept terms, the language's count, one head row per term."""
    of_term = Window.partitionBy("lang", "term")
    counted = count_terms(docs, text_col, lang_col, source_col).repartition("lang", "term")  # both groupings lie within
    cells = counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    cells = cells.select(
        "*",
        F.sum("docs").over(of_term).alias("_df"),
        F.sum("n").over(of_term).alias("lang_n"),
        ((F.row_number().over(of_term.orderBy("source")) == 1) & F.col("term").isNotNull()).alias("head"),
    )
    return cells.where(F.col("term").isNull() | (F.col("_df") >= min_docs)).drop("_df", "docs")


def share(n: Column, total: Column, terms: Column, add: int) -> Column:
    """``1 + floor(10^9 * (n + add) / (total + add * terms))`` without rounding; 1 without terms."""
    whole = "decimal(20,0)"
    above = F.lit(SCALE).cast("decimal(10,0)") * (n + add).cast("decimal(19,0)")
    below = (total + F.lit(add) * terms).cast(whole)
    floor = F.call_function("div", above, below)
    return F.when(terms > 0, floor + 1).otherwise(F.lit(1)).cast("bigint")


class Quadtree:
    """The cells of a matrix of ``rows`` x ``columns`` that hold anything, as bits of quadrants."""

    def __init__(self, row: np.ndarray, column: np.ndarray, height: int) -> None:
        z = np.zeros(len(row), np.int64)
        for bit in range(height):
            z |= ((row >> bit & 1) << (2 * bit + 1)) | ((column >> bit & 1) << (2 * bit))
        self.height = height
        self.order = np.argsort(z, kind="stable")
        z = z[self.order]
        #: Per level a bit for each quadrant of every non-empty one above, and how many are set up to it.
        self.bits: list[np.ndarray] = []
        self.rank: list[np.ndarray] = []
        above = np.zeros(1, np.int64) if len(z) else np.zeros(0, np.int64)
        for level in range(1, height + 1):
            here = np.unique(z >> 2 * (height - level))
            bits = np.zeros(4 * max(len(above), 1), bool)
            bits[4 * np.searchsorted(above, here >> 2) + (here & 3)] = True
            self.bits.append(bits)
            self.rank.append(np.cumsum(bits) - 1)
            above = here

    def below(self, level: int, node: np.ndarray, quadrant: np.ndarray) -> np.ndarray:
        """Number of the quadrant's node on the next level, -1 if it's empty or stands in an empty one."""
        at = 4 * np.maximum(node, 0) + quadrant
        return np.where((node >= 0) & self.bits[level][at], self.rank[level][at], -1)


def walk(
    tree: Quadtree, value: np.ndarray, unseen: np.ndarray, split: int, rows: int, columns: int
) -> tuple[np.ndarray, np.ndarray]:
    """Sums of absolute differences over all columns for the pairs of rows, as a matrix, and which pairs were asked for.

    ``value`` holds the shares of the cells in the tree's order, ``unseen`` a row's share of a term it lacks. With ``split``,
    pairs have one row before it and one from it on; without, all pairs of two rows.
    """
    height = tree.height
    total = np.zeros((rows, rows), np.int64)
    empty = [np.zeros((1 << level, 1 << level), np.int64) for level in range(height + 1)]
    a_bit, b_bit, c_bit = (np.array([i >> k & 1 for i in range(8)]) for k in (2, 1, 0))
    zero = np.zeros(1, np.int64)
    root = zero if len(value) else zero - 1
    stack = [(0, root, root, zero, zero, zero)]
    while stack:
        level, a, b, ra, rb, c = stack.pop()
        if len(a) > WALKED:
            half = len(a) // 2
            for part in (slice(half, None), slice(None, half)):
                stack.append((level, *(x[part] for x in (a, b, ra, rb, c))))
            continue
        rest = height - level - 1
        qa, qb = 2 * a_bit + c_bit, 2 * b_bit + c_bit
        na, nb = tree.below(level, a[:, None], qa[None, :]).ravel(), tree.below(level, b[:, None], qb[None, :]).ravel()
        ra, rb, c = ((2 * x[:, None] + bit[None, :]).ravel() for x, bit in ((ra, a_bit), (rb, b_bit), (c, c_bit)))
        use = (rb << rest < rows) & (c << rest < columns)
        use &= ((ra << rest < split) & ((rb + 1 << rest) > split)) if split else (ra <= rb)
        na, nb, ra, rb, c = (x[use] for x in (na, nb, ra, rb, c))
        bare = (na < 0) & (nb < 0)
        wide = np.minimum(columns - (c[bare] << rest), 1 << rest)
        np.add.at(empty[level + 1], (ra[bare], rb[bare]), wide)
        na, nb, ra, rb, c = (x[~bare] for x in (na, nb, ra, rb, c))
        if not len(na):
            continue
        if rest:
            stack.append((level + 1, na, nb, ra, rb, c))
        else:
            use = ra < rows
            na, nb, ra, rb = (x[use] for x in (na, nb, ra, rb))
            va, vb = (np.where(node >= 0, value[node], unseen[r]) for node, r in ((na, ra), (nb, rb)))
            np.add.at(total, (ra, rb), np.abs(va - vb))
    bare = empty[0]
    for finer in empty[1:]:
        bare = np.kron(bare, np.ones((2, 2), np.int64)) + finer
    total += bare[:rows, :rows] * np.abs(unseen[:, None] - unseen[None, :])
    first, second = np.arange(rows)[:, None], np.arange(rows)[None, :]
    return total, (first < split) & (second >= split) if split else first < second


def compare_block(part: pd.DataFrame) -> pd.DataFrame:
    """``a, b, f, covered``: sums of the pairs of one task's rows, and the number of columns they are taken over."""
    marks = part[part["term"].isna()].drop_duplicates("gid").sort_values(["tile", "gid"])
    cells = part[part["term"].notna()]
    place = pd.Series(np.arange(len(marks)), marks["gid"].to_numpy())
    column, seen = pd.factorize(cells["term"])
    row = place.loc[cells["gid"]].to_numpy(np.int64)
    rows, columns = len(marks), len(seen)
    height = max(1, int(max(rows, columns) - 1).bit_length())
    tree = Quadtree(row, column.astype(np.int64), height)
    tiles = marks["tile"].to_numpy()
    split = 0 if tiles[0] == tiles[-1] and part["ta"].iloc[0] == part["tb"].iloc[0] else int((tiles == part["ta"].iloc[0]).sum())
    gid = marks["gid"].to_numpy()
    if part["ta"].iloc[0] != part["tb"].iloc[0] and split in (0, rows):
        return pd.DataFrame({"a": gid[:0], "b": gid[:0], "f": gid[:0], "covered": gid[:0]})  # a tile without groups
    sums, asked = walk(tree, cells["p"].to_numpy(np.int64)[tree.order], marks["p"].to_numpy(np.int64), split, rows, columns)
    a, b = np.nonzero(asked)
    return pd.DataFrame({"a": gid[a], "b": gid[b], "f": sums[a, b], "covered": np.full(len(a), columns)})


def rated(cells: DataFrame, groups: DataFrame, add: int) -> DataFrame:
    """Every cell with its group's share ``p`` and the language's share ``q``."""
    have = cells.where(F.col("term").isNotNull())
    return have.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", "gid", "tile", "tiles", "blocks",
        share(F.col("n"), F.col("total"), F.col("terms"), add).alias("p"),
        share(F.col("lang_n"), F.col("lang_total"), F.col("terms"), add).alias("q"),
    )


def group_table(cells: DataFrame, add: int, columns: int, rows: int) -> DataFrame:
    """One row per group: identifier, sizes, share of an unseen term, tile; and blocks and tiles of its language."""
    own = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    lang = cells.groupBy("lang").agg(
        F.sum("n").alias("lang_total"),
        F.sum(F.col("head").cast("bigint")).alias("terms"),
        F.sum(F.col("term").isNull().cast("bigint")).alias("_groups"),
    )
    joined = own.join(lang, "lang").select(
        "lang", "source", "total", "lang_total", "terms",
        share(F.lit(0).cast("bigint"), F.col("total"), F.col("terms"), add).alias("unseen"),
        F.greatest(F.lit(1), F.ceil(F.col("terms") / columns)).cast("int").alias("blocks"),
        F.ceil(F.col("_groups") / rows).cast("int").alias("tiles"),
    )
    tiled = joined.withColumn("tile", F.pmod(F.xxhash64("source"), F.col("tiles")).cast("int"))
    return tiled.withColumn("gid", F.monotonically_increasing_id())


def pair_sums(cells: DataFrame, groups: DataFrame) -> DataFrame:
    """``a, b, value``: sum of the differences over all kept terms of the language, once per pair of groups."""
    tile_pairs = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    shape = ["lang", "gid", "tile", "_other", "_block", "term", "p"]
    have = cells.withColumn("_block", F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int")).withColumn("_other", tile_pairs)
    marks = groups.withColumn("_block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("_other", tile_pairs)
    marks = marks.withColumn("term", F.lit(None).cast("string")).withColumn("p", F.col("unseen"))
    parts = have.select(*shape).unionByName(marks.select(*shape))
    parts = parts.withColumn("ta", F.least("tile", "_other")).withColumn("tb", F.greatest("tile", "_other"))
    blocks = parts.select("lang", "ta", "tb", "_block", "gid", "tile", "term", "p").groupBy("lang", "ta", "tb", "_block")
    sums = blocks.applyInPandas(compare_block, "a bigint, b bigint, f bigint, covered bigint")
    sums = sums.groupBy("a", "b").agg(F.sum("f").alias("f"), F.sum("covered").alias("covered"))
    zero_a, zero_b = groups.select(F.col("gid").alias("a"), F.col("unseen").alias("_za"), "terms"), groups.select(F.col("gid").alias("b"), F.col("unseen").alias("_zb"))
    # Columns that no row of a task's tiles holds have the unseen share in both.
    rest = (F.col("terms") - F.col("covered")) * F.abs(F.col("_za") - F.col("_zb"))
    return sums.join(zero_a, "a").join(zero_b, "b").select("a", "b", F.when(F.col("terms") > 0, F.col("f") + rest).otherwise(0).cast("bigint").alias("value"))


def audit(
    docs: DataFrame, min_docs: int = MIN_DOCS, add: int = ADD, top: int = TOP, text_col: str = "text",
    lang_col: str = "lang", source_col: str = "source", columns: int = COLUMNS, rows: int = ROWS,
) -> DataFrame:
    """``lang, source, part, item, value, rank``: the other sources of each group, farthest first, and its own terms."""
    cells = cut(kept_cells(docs, min_docs, text_col, lang_col, source_col))
    groups = cut(group_table(cells, add, columns, rows))
    few = groups.count() <= SMALL
    shares = rated(cells, F.broadcast(groups) if few else groups, add)

    def ranked(found: DataFrame, part: str) -> DataFrame:
        order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item").asc())
        return found.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))

    own = shares.where(F.col("p") > F.col("q")).select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    terms = ranked(own, "term").where(F.col("rank") <= top)
    sums = pair_sums(shares, groups)
    both = sums.unionAll(sums.select(F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    named = groups.select(F.col("gid").alias("a"), "lang", "source")
    others = groups.select(F.col("gid").alias("b"), F.col("source").alias("item"))
    pairs = ranked(both.join(named, "a").join(others, "b"), "pair")
    return pairs.unionAll(terms)
