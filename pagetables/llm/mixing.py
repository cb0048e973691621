"""Mix sources to target weights in fixed-length blocks.

The words of a source, its documents in a fixed order one after the other, are packed into blocks of ``BLOCK``
words; only a source's last block may be shorter. A source's target decides how many output slots it gets. The
slots are dealt over output shards by a multinomial draw per source, so every shard has its own random counts while
a source's total is exact. Slot ``j`` of a source takes block ``permute(j mod blocks)``; every pass over a source uses
another pseudorandom permutation of its block numbers, computed from the number alone (a keyed Feistel network that
walks on until it falls inside the range), so nothing is sorted or stored. Slots and blocks meet by source and block
number. The last slot is cut so that a source gives exactly its rounded target.

Targets: sources in code point order, null last, weigh 5, 2, 1 in turn and share all words by weight; a target stops
at three times its source, what is left over is shared again by weight. The shares end at
``min(3 * size, level * weight)``, where ``level`` is the largest of the levels found with the k soonest full sources
taken out. All sizes of sources pass one task in this step, one row per source.

Null texts and texts without a word have size 0 and give nothing. Rows that repeat a document count as documents of
their own. An empty table gives an empty result. Other columns of the input are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagetables.llm.common import cut, n_words

BLOCK, MOST, WEIGHTS = 1024, 3, (5, 2, 1)
#: Slots of an output shard on average, slots made by one row's work, parts of a source whose offsets are summed apart.
SHARD, CHUNK, PARTS = 4096, 65_536, 4096
#: Sources that are broadcast at most.
SMALL = 50_000


class Permutation:
    """A keyed pseudorandom permutation of ``range(n)``, either way."""

    def __init__(self, key: int, n: int, rounds: int = 4) -> None:
        self.n = n
        self.half = max(1, ((n - 1).bit_length() + 1) // 2)
        self.mask = np.uint64((1 << self.half) - 1)
        self.keys = np.random.default_rng(key).integers(1, 1 << 62, rounds, dtype=np.uint64)

    def mixed(self, x: np.ndarray, key: np.uint64) -> np.ndarray:
        y = (x + key) * np.uint64(0x9E3779B97F4A7C15)
        y ^= y >> np.uint64(29)
        y *= np.uint64(0xBF58476D1CE4E5B9)
        return (y >> np.uint64(32)) & self.mask

    def forth(self, x: np.ndarray) -> np.ndarray:
        left, right = x >> np.uint64(self.half), x & self.mask
        for k in self.keys:
            left, right = right, left ^ self.mixed(right, k)
        return (left << np.uint64(self.half)) | right

    def back(self, x: np.ndarray) -> np.ndarray:
        left, right = x >> np.uint64(self.half), x & self.mask
        for k in self.keys[::-1]:
            left, right = right ^ self.mixed(left, k), left
        return (left << np.uint64(self.half)) | right

    def walk(self, x: np.ndarray, step) -> np.ndarray:
        out = step(x.astype(np.uint64))
        while len(outside := np.flatnonzero(out >= self.n)):
            out[outside] = step(out[outside])
        return out.astype(np.int64)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return self.walk(x, self.forth)

    def inverse(self, x: np.ndarray) -> np.ndarray:
        return self.walk(x, self.back)


def targets(sizes: DataFrame) -> DataFrame:
    """``source, source_size`` → also ``target``."""
    names = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), ((F.row_number().over(names) - 1) % len(WEIGHTS)) + 1)
    weighed = sizes.withColumn("_weight", weight).withColumn("_cap", F.col("source_size") * MOST)
    soonest = Window.orderBy(F.col("_cap") / F.col("_weight"), F.col("source").asc_nulls_last())
    full = F.coalesce(F.sum("_cap").over(soonest.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("_weight").over(soonest.rowsBetween(0, Window.unboundedFollowing))
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("source_size").over(everything) - full) / rest
    leveled = weighed.withColumn("_level", level)
    water = F.max("_level").over(everything)
    return leveled.withColumn(
        "target", F.least(F.col("_cap").cast("double"), water * F.col("_weight")).cast("double")
    ).drop("_weight", "_cap", "_level")


def draw(group: pd.DataFrame, block: int, shards: int) -> Iterator[pd.DataFrame]:
    """The slots of some chunks: ``_key, _block, shard, slot, _words`` (words the slot takes from its block)."""
    for name, size, take, chunk in group[["_key", "source_size", "_take", "_chunk"]].itertuples(index=False, name=None):
        key = zlib.crc32(name.encode())
        blocks, passes, rest = -(-size // block), take // size, take % size
        slots = passes * blocks
        if rest:
            final = Permutation(key * 64 + passes, blocks)
            short = block * blocks - size  # words the last block lacks
            at = int(final.inverse(np.array([blocks - 1]))[0])
            more = -(-rest // block)
            more = -(-(rest + short) // block) if at < more else more
            before = (more - 1) * block - (short if at < more - 1 else 0)
            slots += more
        j = np.arange(chunk * CHUNK, min((chunk + 1) * CHUNK, slots))
        if not len(j):
            continue
        turn = j // blocks
        chosen = np.empty(len(j), np.int64)
        for t in np.unique(turn):
            chosen[turn == t] = Permutation(key * 64 + int(t), blocks)((j % blocks)[turn == t])
        words = np.full(len(j), block)
        if rest and j[-1] == slots - 1:
            words[-1] = rest - before
        counts = np.random.default_rng(key).multinomial(slots, np.full(shards, 1 / shards))
        shard = np.searchsorted(np.cumsum(counts), j, "right")
        yield pd.DataFrame({"_key": name, "_block": chosen, "shard": shard, "slot": j, "_words": words})


def mix(
    docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", block: int = BLOCK
) -> tuple[DataFrame, DataFrame]:
    """Documents with their source's ``source_size`` and ``target``, and the pieces of the mix.

    Documents: ``_key, _start, <id>, size, source_size, target``. Pieces: ``shard, _key, slot, _start, first_word, words``:
    which words of which document (found by key and start) an output slot takes, in order of ``first_word``.
    """
    rows = docs.select(
        F.col(f"`{id_col}`").alias(id_col), F.col(f"`{source_col}`").alias("source"), n_words(F.col(f"`{text_col}`")).alias("size")
    )
    # A null source needs a key that joins.
    rows = cut(rows.withColumn("_key", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n"))))
    rows = rows.withColumn("_part", F.pmod(F.xxhash64(id_col), F.lit(PARTS)))
    parts = rows.groupBy("_key", "source", "_part").agg(F.sum("size").alias("_sum"))
    sources = targets(parts.groupBy("_key", "source").agg(F.sum("_sum").alias("source_size")))
    sources = cut(sources.withColumn("_take", F.round("target").cast("long")))
    upto = Window.partitionBy("_key").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    begin = parts.select("_key", "_part", F.coalesce(F.sum("_sum").over(upto), F.lit(0)).alias("_begin"))
    inside = Window.partitionBy("_key", "_part").orderBy(id_col, "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.join(begin, ["_key", "_part"]).select(
        "_key", id_col, "size", (F.col("_begin") + F.coalesce(F.sum("size").over(inside), F.lit(0))).alias("_start")
    )
    # One row per source meets all of a source's rows: few enough rows are sent to every task, so a hot source is no one's key.
    sizes = sources.select("_key", "source_size", "target")
    placed = placed.join(F.broadcast(sizes) if sources.count() <= SMALL else sizes, "_key")

    total = sources.agg(F.sum("_take")).first()[0] or 0
    shards = int(max(1, -(-total // (block * SHARD))))
    most = F.ceil(F.col("_take") / block) + F.floor(F.col("_take") / F.col("source_size")) + 1
    chunks = sources.where("source_size > 0 and _take > 0").select(
        "_key", "source_size", "_take", F.explode(F.sequence(F.lit(0), F.floor(most / CHUNK).cast("int"))).alias("_chunk")
    )

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield from draw(frame, block, shards)

    slots = chunks.repartition("_key", "_chunk").mapInPandas(
        run, "_key string, _block long, shard long, slot long, _words long"
    )
    last = F.col("_start") + F.col("size")
    lies = placed.where("size > 0").select(
        "_key", "_start", "size",
        F.explode(F.sequence(F.floor(F.col("_start") / block), F.floor((last - 1) / block))).alias("_block"),
    )
    lies = lies.withColumn("_from", F.greatest(F.col("_start") - F.col("_block") * block, F.lit(0)))
    lies = lies.withColumn("_to", F.least(last - F.col("_block") * block, F.lit(block)))
    pieces = lies.join(slots, ["_key", "_block"]).where("_words > _from").select(
        "shard", "_key", "slot", "_start",
        (F.col("_block") * block + F.col("_from") - F.col("_start")).alias("first_word"),
        (F.least("_to", "_words") - F.col("_from")).alias("words"),
    )
    return placed, pieces


def taken(docs: DataFrame, id_col: str = "doc_id", **names) -> DataFrame:
    """Per document: ``<id>, size, source_size, target, taken``."""
    placed, pieces = mix(docs, id_col, **names)
    placed = cut(placed)
    sums = pieces.groupBy("_key", "_start").agg(F.sum("words").alias("taken"))
    # Documents without a word share their start with the next one and take nothing.
    some = placed.where("size > 0").join(sums, ["_key", "_start"], "left")
    none = placed.where("size = 0").withColumn("taken", F.lit(None).cast("long"))
    out = some.select(id_col, "size", "source_size", "target", "taken").unionByName(
        none.select(id_col, "size", "source_size", "target", "taken")
    )
    return out.withColumn("taken", F.coalesce("taken", F.lit(0)).cast("long"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: every document as often as the mix takes it; a part of a document counts as one more
    whole document with that part as its chance, decided by a hash of its identifier.

    Rows of one identifier share its chance and number of copies, null being one of them; documents without a word go; an
    empty table stays empty; columns of any name come through unchanged.
    """
    shares = taken(docs).groupBy("doc_id").agg(F.try_divide(F.sum("taken"), F.sum("size")).alias("_share"))
    chance = F.pmod(F.xxhash64("doc_id", F.lit("mix")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    copies = shares.where("_share > 0").select(
        F.col("doc_id").alias("_doc"),
        (F.floor("_share") + (chance < F.col("_share") - F.floor("_share")).cast("int")).cast("int").alias("_copies"),
    )
    worded = docs.where(F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    rows = worded.select(F.col("doc_id").alias("_own"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    chosen = rows.join(copies.where("_copies > 0"), F.col("_own").eqNullSafe(F.col("_doc")))
    return chosen.select("_row", F.explode(F.sequence(F.lit(1), F.col("_copies"))).alias("_copy")).select("_row.*")
