"""Exact Jaccard join on word shingles by universe partitioning and the pigeonhole principle, and its components.

A document's set are its distinct 64-bit shingle hashes; equal sets are one class from the start, found by a 64-bit
fingerprint. Sizes are cut into bands so that partners lie in the same or the next band. Two sets of a band that are
similar enough differ in at most ``H`` tokens. The band's universe is dealt by hash into segments, and every segment of a
set is indexed by its content:

* small bands: ``H // 2 + 1`` segments, each with its content and its one-deletion neighbourhood, as one segment must
  differ by one token at most;
* larger bands: ``H + 1 + spare`` segments by their content alone, so that at least ``spare + 1`` are equal. A set may
  skip up to ``spare`` segments of at most ``WEAK`` tokens, which would be the costly ones to look up; a set with more
  of them skips none, so no pair is lost.

Classes that share a key are candidates. Instead of all pairs of a bucket, every member is checked against a hub of
the bucket, the member that shares most keys with others. Connected components of the verified links tell which buckets
still join different components without their hubs; there the remaining pairs across components are looked at in blocks of about
``BLOCK`` members per side, for all buckets of a hub at once where they have much the same members. A pair is dropped without its texts only if sizes or
sketches rule it out: parities of token hashes differ in no more places than the sets differ in tokens. Every other
candidate is verified on the shingles of the whole texts. A pair that is never compared is already connected, so the components are
exact, but for the chance that two of all shingle hashes or fingerprints fall together (64 bits).

Texts without a word have an empty set and link with nothing. Null texts count as empty. Rows without identifier get
the component of their class, null if no row of it has one. Repeated rows are in one class. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pagetables.llm.common import IS_SPACE, LOWER, cut, mapped, row_counts, scatter, slices, span_hash, spans

WORDS, SIMILAR = 4, 85
#: The pipeline's stage: words of a shingle and least similarity in per cent.
STAGE_WORDS, STAGE_SIMILAR = 5, 80
#: Up to this size a band uses one-deletion neighbourhoods; tokens of a weak segment; classes of a key within one
#: slice that make it hot; members per side of a block; parities in a sketch at least; bits of
#: the map of wanted classes; edges in one task at least; pairs of a block looked at together.
SMALL, WEAK, HOT, BLOCK, BITS, MAP, EDGES, PAIRS = 64, 1, 24, 256, 1024, 1 << 22, 100_000, 1 << 17
#: Classes that are broadcast at most when the stage's rows meet them.
FEW = 500_000
GOLD = np.uint64(0x9E3779B97F4A7C15)


# ---------------------------------------------------------------- sets


def shingles(data: np.ndarray, bounds: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes and their rows, sorted by row and hash; a shorter text is one shingle."""
    data = mapped(data, LOWER)
    start, end, row = spans(data, bounds, IS_SPACE)
    hashes, size = span_hash(data, start, end), row_counts(row, len(bounds) - 1)
    first = np.cumsum(size) - size
    out, rows = [], []
    whole = np.arange(max(0, len(hashes) - words + 1))
    whole = whole[row[whole] == row[whole + words - 1]]
    key = np.zeros(len(whole), np.uint64)
    for i in range(words):
        key = scatter(key * GOLD + hashes[whole + i])
    out.append(key)
    rows.append(row[whole])
    short = np.flatnonzero((size > 0) & (size < words))
    key = np.zeros(len(short), np.uint64)
    for i in range(words - 1):
        has = size[short] > i
        key[has] = scatter(key[has] * GOLD + hashes[first[short[has]] + i])
    out.append(scatter(key + size[short].astype(np.uint64)))
    rows.append(short)
    key, row = np.concatenate(out), np.concatenate(rows)
    if len(short):
        order = np.argsort(row, kind="stable")
        key, row = key[order], row[order]
    first = 0
    for last in np.cumsum(row_counts(row, len(bounds) - 1)).tolist():  # every set by itself, which takes no places along
        key[first:last].sort()
        first = last
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (row[1:] != row[:-1])
    return key[new], row[new]


def summed(cell: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sums of 64-bit values per cell, modulo 2**64."""
    low = np.bincount(cell, values & np.uint64(0xFFFFFFFF), minlength=n)
    high = np.bincount(cell, values >> np.uint64(32), minlength=n)
    return (high.astype(np.uint64) << np.uint64(32)) + low.astype(np.uint64)


def fingerprints(key: np.ndarray, row: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprint of every row's set as a signed number, and the set's size."""
    size = row_counts(row, rows)
    return scatter(summed(row, scatter(key ^ GOLD), rows) + size.astype(np.uint64)).view(np.int64), size


# ---------------------------------------------------------------- bands and keys


class Band:
    """Sizes ``low`` to ``high``, and up to ``reach`` for the larger partner; ``segments`` and how they are used."""

    def __init__(self, number: int, low: int, similar: int) -> None:
        self.number, self.low = number, low
        self.high = max(low, low * 100 // similar)
        self.reach = self.high * 100 // similar
        both = self.high + self.reach
        # Largest difference of a pair whose sizes add up to so much.
        self.differ = max(s - 2 * -(-similar * s // (100 + similar)) for s in range(max(2, both - 4), both + 1))
        self.deletions = self.high <= SMALL
        self.spare = 0 if self.deletions else 2 + self.differ // 12
        self.segments = self.differ // 2 + 1 if self.deletions else self.differ + 1 + self.spare


@lru_cache(maxsize=4)
def bands(similar: int, largest: int) -> list[Band]:
    out, low = [], 1
    while low <= largest or len(out) < 2:
        out.append(Band(len(out), low, similar))
        low = out[-1].high + 1
    return out


def signatures(key: np.ndarray, row: np.ndarray, rows: int, similar: int) -> tuple[np.ndarray, np.ndarray]:
    """Index keys of all sets, and the row of each."""
    size = row_counts(row, rows)
    plan = bands(similar, 1 << max(10, int(size.max(initial=1)).bit_length()))
    own = np.searchsorted([b.low for b in plan], size, "right") - 1
    keys, owners = [], []
    for lower in (0, 1):
        number = own - lower
        reach = np.array([b.reach for b in plan])
        some = (size > 0) & (number >= 0)
        some[some] = size[some] <= reach[number[some]]
        segments, spare, deletions, differ = (
            np.array([getattr(b, a) for b in plan])[np.maximum(number, 0)] for a in ("segments", "spare", "deletions", "differ")
        )
        # Sets of a band without room for any difference can only be equal, and equal sets are one class already.
        some &= differ > 0
        live = some[row]
        k, r = key[live], row[live]
        begin = np.cumsum(np.where(some, segments, 0)) - np.where(some, segments, 0)
        total = int(np.where(some, segments, 0).sum())
        if not total:
            continue
        cell = begin[r] + (scatter(k + GOLD) % segments[r].astype(np.uint64)).astype(np.int64)
        token = scatter(k + np.uint64(7))
        content, filled = summed(cell, token, total), np.bincount(cell, minlength=total)
        cell_row = np.repeat(np.arange(rows), np.where(some, segments, 0))
        place = (np.arange(total) - begin[cell_row]).astype(np.uint64)
        salt = scatter(number[cell_row].astype(np.uint64) * np.uint64(1 << 32) + place + np.uint64(1))
        weak = filled <= WEAK
        skips = (row_counts(cell_row, rows, weak) <= spare) & ~deletions
        kept = ~(weak & skips[cell_row])
        keys.append(scatter(content[kept] + salt[kept]))
        owners.append(cell_row[kept])
        without = deletions[r]
        keys.append(scatter(content[cell[without]] - token[without] + salt[cell[without]]))
        owners.append(r[without])
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(keys), np.concatenate(owners)


# ---------------------------------------------------------------- steps over documents


def sketches(key: np.ndarray, row: np.ndarray, rows: int) -> pa.Array:
    """Parities of every set, bit i telling whether an odd number of its tokens falls on i: ``BITS`` or, for larger sets,
    the first power of two from twice the size up, so that differences of large sets show as those of small ones do."""
    size = row_counts(row, rows)
    bits = np.maximum(BITS, 1 << np.ceil(np.log2(np.maximum(2 * size, 1))).astype(np.int64))
    ends = np.cumsum(bits)
    cell = (ends - bits)[row] + (scatter(key + np.uint64(3)) & (bits[row] - 1).astype(np.uint64)).astype(np.int64)
    odd = np.packbits((np.bincount(cell, minlength=int(ends[-1]) if rows else 0) & 1).astype(np.uint8))
    offsets = np.append(0, ends // 8).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), rows, [None, pa.py_buffer(offsets), pa.py_buffer(odd)])


def folded(found: list[bytes], size: int) -> np.ndarray:
    """Sketches as rows of 64-bit words, longer ones folded to ``size`` bytes: the parity of a part is that of its halves."""
    out = np.zeros((len(found), size // 8), np.uint64)
    length = np.array([len(x) for x in found])
    for n in np.unique(length):
        some = np.flatnonzero(length == n)
        words = np.frombuffer(b"".join([found[i] for i in some]), np.uint64).reshape(len(some), n // size, size // 8)
        out[some] = np.bitwise_xor.reduce(words, axis=1)
    return out


def odd_bits(left: list[bytes], right: list[bytes]) -> np.ndarray:
    """In how many parities the sketches of every pair differ, at the shorter one's length."""
    size = np.array([min(len(x), len(y)) for x, y in zip(left, right, strict=True)])
    out = np.zeros(len(size), np.int64)
    for n in np.unique(size):
        some = np.flatnonzero(size == n)
        both = [folded([side[i] for i in some], int(n)) for side in (left, right)]
        out[some] = np.bitwise_count(both[0] ^ both[1]).sum(1, dtype=np.int64)
    return out


def may_link(size_a: np.ndarray, size_b: np.ndarray, odd: np.ndarray, similar: int) -> np.ndarray:
    """False only for pairs that can't be links: sizes too far apart, or more parities differ than tokens may."""
    both = size_a + size_b
    most = both - 2 * -(-similar * both // (100 + similar))
    return (100 * np.minimum(size_a, size_b) >= similar * np.maximum(size_a, size_b)) & (odd <= most)


def class_rows(rows: DataFrame, kind: str, words: int = WORDS) -> DataFrame:
    """``_id, _class, n_shingles, _sketch`` per row; class null for an empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, bounds in slices(batch.column(1)):
                key, row = shingles(data, bounds, words)
                found, size = fingerprints(key, row, last - first)
                sketch = sketches(key, row, last - first)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first), pa.array(found, mask=size == 0), pa.array(size), sketch],
                    ["_id", "_class", "n_shingles", "_sketch"],
                )

    return rows.mapInArrow(run, f"_id {kind}, _class long, n_shingles long, _sketch binary")


def index_rows(rows: DataFrame, similar: int, words: int = WORDS) -> DataFrame:
    """``_key, _class, _hot``: keys of every class, once per slice; hot above 0 if many of its slice have it, else 0.
    Hot keys are known to be shared, so their rows need not meet in one task to find that out: ``_hot`` deals them out by
    class. One member of each hot key in a slice comes as a row with 0 besides and stands for the others where the rows
    meet that were not hot in their slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, bounds in slices(batch.column(1)):
                key, row = shingles(data, bounds, words)
                found, size = fingerprints(key, row, last - first)
                _, one = np.unique(found, return_index=True)
                once = np.zeros(last - first, bool)
                once[one] = True
                live = once[row]
                keys, owner = signatures(key[live], row[live], last - first, similar)
                which, distinct = pd.factorize(keys)
                hot = np.bincount(which, minlength=len(distinct))[which] >= HOT
                name = found[owner]
                often = np.where(hot, 1 + (name & 0x3FFFFFFF), 0).astype(np.int32)
                some = np.flatnonzero(hot)
                stand_in = some[np.unique(which[some], return_index=True)[1]]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([keys, keys[stand_in]]).view(np.int64)),
                        pa.array(np.concatenate([name, name[stand_in]])),
                        pa.array(np.concatenate([often, np.zeros(len(stand_in), np.int32)])),
                    ],
                    ["_key", "_class", "_hot"],
                )

    return rows.mapInArrow(run, "_key long, _class long, _hot int")


def bitmap(named: DataFrame) -> np.ndarray:
    """``MAP`` bits, set where a class of ``_class`` falls; of fixed size, put together by Spark in 64-bit words."""
    place = F.pmod(F.col("_class"), F.lit(MAP))
    words = named.groupBy(F.floor(place / 64).cast("int").alias("_word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(_class, {MAP}) % 64 as int))")).alias("_bits")
    )
    out = np.zeros(MAP // 64, np.uint64)
    found = words.toArrow()
    out[found["_word"].to_numpy()] = found["_bits"].to_numpy().view(np.uint64)
    return out


def class_texts(rows: DataFrame, kind: str, wanted: np.ndarray, words: int = WORDS) -> DataFrame:
    """``_id, _class, _text`` of the rows whose class may be wanted, by the bitmap."""
    shared = rows.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, bounds in slices(batch.column(1)):
                found, size = fingerprints(*shingles(data, bounds, words), last - first)
                place = (found % MAP).astype(np.uint64)
                hit = (shared.value[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1)
                some = pa.array(np.flatnonzero((size > 0) & (hit == 1)))
                parts = [batch.column(i).slice(first, last - first).take(some) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays([parts[0], pa.array(found).take(some), parts[1]], ["_id", "_class", "_text"])

    return rows.mapInArrow(run, f"_id {kind}, _class long, _text string")


def texts_of(rows: DataFrame, pairs: DataFrame, classes: DataFrame, kind: str, words: int = WORDS) -> DataFrame:
    """``_class, _text`` of the classes in the pairs, from the row that stands for each."""
    named = pairs.select(F.col("_a").alias("_class")).unionByName(pairs.select(F.col("_b").alias("_class"))).distinct()
    texts = class_texts(rows, kind, bitmap(named), words)
    named = named.join(classes.select("_class", "_first"), "_class").withColumnRenamed("_class", "_named")
    met = texts.join(named, (F.col("_class") == F.col("_named")) & F.col("_id").eqNullSafe(F.col("_first")))
    return met.select("_class", "_text").dropDuplicates(["_class"])


def sets_of(texts: list[str], words: int = WORDS) -> list[np.ndarray]:
    data = [t.encode() for t in texts]
    bounds = np.concatenate([[0], np.cumsum([len(d) for d in data])]).astype(np.int64)
    key, row = shingles(np.frombuffer(b"".join(data), np.uint8), bounds, words)
    return np.split(key, np.cumsum(row_counts(row, len(texts)))[:-1])


def linked(a: np.ndarray, b: np.ndarray, similar: int) -> bool:
    """The exact test on two sets."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if 100 * len(small) < similar * len(large):
        return False
    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
    both = int((large[at] == small).sum())
    return 100 * both >= similar * (len(a) + len(b) - both)


def verify(pairs: DataFrame, texts: DataFrame, similar: int, words: int = WORDS) -> DataFrame:
    """Those of the pairs ``_a, _b`` that are links; ``_a`` is the one that has many partners.

    A text moves once per hub it is compared with: the partners of a hub come in slices of about ``BLOCK``, each behind the
    hub's own text, and are compared as they stream by.
    """
    slices_of = pairs.groupBy("_a").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("_slices"))
    dealt = pairs.join(slices_of, "_a").select("_a", "_b", F.pmod(F.xxhash64("_b"), F.col("_slices")).cast("int").alias("_slice"))
    hubs = dealt.select(F.col("_a").alias("_class"), "_a", "_slice", F.lit(None).cast("long").alias("_b")).distinct()
    roles = hubs.unionByName(dealt.select(F.col("_b").alias("_class"), "_a", "_slice", "_b"))
    met = roles.join(texts, "_class").select("_a", "_slice", "_b", "_text").repartition("_a", "_slice")
    ordered = met.sortWithinPartitions("_a", "_slice", F.col("_b").asc_nulls_first())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub = np.zeros(0, np.uint64)
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                a, b = part.column(0).to_pylist(), part.column(2).to_pylist()
                good = []
                for x, y, own in zip(a, b, sets_of(part.column(3).to_pylist(), words), strict=True):
                    if y is None:
                        hub = own
                    elif linked(hub, own, similar):
                        good.append((x, y))
                yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in good], pa.int64()) for i in (0, 1)], ["_a", "_b"])

    return ordered.mapInArrow(run, "_a long, _b long")


def components(edges: DataFrame) -> DataFrame:
    """``_class, _root`` for every class with an edge: alternating large and small stars until nothing changes."""
    # The edges never grow in number; as many tasks hold them as their number asks for. One task exchanges nothing, the
    # other side of its joins, a row for each end of ``EDGES`` edges at most, is broadcast.
    tasks = max(1, -(-edges.count() // EDGES))
    stars = edges.select(F.greatest("_a", "_b").alias("hi"), F.least("_a", "_b").alias("lo")).where("hi != lo")
    stars = cut(stars.coalesce(tasks).distinct().coalesce(tasks))
    met = F.broadcast if tasks == 1 else lambda side: side
    known = None
    while True:
        check = stars.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if tuple(check) == known:
            return stars.select(F.col("hi").alias("_class"), F.col("lo").alias("_root")).unionByName(
                stars.select(F.col("lo").alias("_class"), F.col("lo").alias("_root")).distinct()
            )
        known = tuple(check)
        both = stars.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
            stars.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
        ).coalesce(tasks)
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = both.where("v > u").join(met(least), "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        root = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(met(root), "hi").select(F.col("lo").alias("hi"), F.col("m").alias("lo")).where("hi != lo")
        stars = cut(small.unionByName(root.select("hi", F.col("m").alias("lo"))).coalesce(tasks).distinct().coalesce(tasks))


# ---------------------------------------------------------------- candidates


def shared_keys(index: DataFrame) -> DataFrame:
    """``_key, _class``: the members of all keys that several classes share."""
    bucket = Window.partitionBy("_key", "_hot")
    met = index.withColumn("_low", F.min("_class").over(bucket)).withColumn("_high", F.max("_class").over(bucket))
    return met.where("_hot > 0 or _low != _high").select("_key", "_class").distinct()


def leaders(members: DataFrame, rank: Column) -> DataFrame:
    """``_key, _hub``: every bucket's hub, the member that ranks highest. Of two classes the same one leads in every bucket."""
    hubs = members.withColumn("_rank", rank).groupBy("_key").agg(F.max(F.struct("_rank", "_class")).alias("_first"))
    return hubs.select("_key", F.col("_first._class").alias("_hub"))


def hub_pairs(members: DataFrame, hubs: DataFrame) -> DataFrame:
    """``_a, _b``: every bucket's hub with each other member."""
    met = members.join(hubs, "_key").where("_class != _hub")
    return met.select(F.col("_hub").alias("_a"), F.col("_class").alias("_b")).distinct()


def rest_groups(members: DataFrame, hubs: DataFrame, roots: DataFrame) -> DataFrame:
    """``_key, _class, _root``: groups of classes in several components, so that any two of a bucket that no hub was compared
    with are in one. A bucket goes without its hub, which has met all of it. Buckets of one hub that have much the same
    members are one group, or a pair would be found again in each of them: a hub's members are put together where that
    gives no more pairs than its buckets do."""
    held = members.join(roots, "_class", "left").withColumn("_root", F.coalesce("_root", "_class")).join(hubs, "_key").where("_class != _hub")
    ends = held.groupBy("_key").agg(F.min("_root").alias("_low"), F.max("_root").alias("_high"), F.count(F.lit(1)).alias("_n"))
    held = cut(held.join(ends.where("_low != _high").select("_key", "_n"), "_key"))
    # A bucket has a row with its size for each member, so the sizes add up to the squares.
    each = held.groupBy("_hub", "_class").agg(F.first("_root").alias("_root"), F.sum("_n").alias("_apart"))
    alike = each.groupBy("_hub").agg(F.count(F.lit(1)).alias("_n"), F.sum("_apart").alias("_apart")).where("_n * _n <= _apart").select("_hub")
    together = each.join(alike, "_hub").select(F.col("_hub").alias("_key"), "_class", "_root")
    return together.unionByName(held.join(alike, "_hub", "left_anti").select("_key", "_class", "_root"))


def likely(pairs: DataFrame, classes: DataFrame, similar: int) -> DataFrame:
    """The pairs that the sizes and sketches of their classes don't rule out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            odd = odd_bits(batch.column(4).to_pylist(), batch.column(5).to_pylist())
            good = pa.array(may_link(batch.column(2).to_numpy(), batch.column(3).to_numpy(), odd, similar))
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(good) for i in (0, 1)], ["_a", "_b"])

    for name in ("_a", "_b"):
        side = classes.select(F.col("_class").alias(name), F.col("n_shingles").alias(f"_n{name}"), F.col("_sketch").alias(f"_s{name}"))
        pairs = pairs.join(side, name)
    return pairs.select("_a", "_b", "_n_a", "_n_b", "_s_a", "_s_b").mapInArrow(run, "_a long, _b long")


def shortened(classes: DataFrame) -> DataFrame:
    """``_class, n_shingles, _part``: sketches folded to 256 bits, or for larger sets the first power of two from 0.6 times
    the size up. In so many parities unlike sets still differ far more than similar ones may."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, found = batch.column(1).to_numpy(), batch.column(2).to_pylist()
            wanted = np.maximum(32, 1 << np.ceil(np.log2(np.maximum(0.6 * size, 8))).astype(np.int64) >> 3)
            part = np.empty(len(found), object)
            for n in np.unique(wanted):
                some = np.flatnonzero(wanted == n)
                part[some] = [x.tobytes() for x in folded([found[i] for i in some], int(n))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(part, pa.binary())], ["_class", "n_shingles", "_part"])

    return classes.select("_class", "n_shingles", "_sketch").mapInArrow(run, "_class long, n_shingles long, _part binary")


def rest_pairs(rows: DataFrame, classes: DataFrame, similar: int) -> DataFrame:
    """Likely pairs of members of one group that are in different components, found block by block. A sketch comes once per
    block of a group its class is in, so it comes short; what short ones leave is looked at with the whole ones."""
    size = rows.groupBy("_key").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("_blocks"))
    rows = rows.join(size, "_key")
    rows = rows.withColumn("_block", F.pmod(F.xxhash64("_class"), F.col("_blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))
    rows = rows.select("_key", "_class", "_root", "_block", other.alias("_other"))
    rows = rows.select(
        "_key", F.least("_block", "_other").alias("_i"), F.greatest("_block", "_other").alias("_j"), "_class", "_root", "_block"
    ).join(shortened(classes), "_class")
    columns = ["_key", "_i", "_j", "_class", "_root", "_block", "n_shingles", "_part"]
    rows = rows.repartition("_key", "_i", "_j").sortWithinPartitions("_key", "_i", "_j").select(*columns)

    def pairs_of(table: pa.Table) -> pa.RecordBatch:
        key, i, j, name, root, block, size = (table.column(c).to_numpy() for c in columns[:-1])
        sketches = table.column("_part").to_pylist()
        change = np.flatnonzero((key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1
        start = np.concatenate([[0], change])
        size_of = np.diff(np.append(start, len(key)))
        length = np.array([len(x) for x in sketches])
        least = np.repeat(np.minimum.reduceat(length, start), size_of)  # the group's shortest sketch
        before = np.arange(len(key)) - np.repeat(start, size_of)
        inside = i == j
        left, right = [], []
        for n in np.unique(least).tolist():
            own = np.flatnonzero((least == n) & (before > 0))
            whole = np.flatnonzero(least == n)
            sketch = folded([sketches[x] for x in whole], n)
            at = np.zeros(len(key), np.int64)
            at[whole] = np.arange(len(whole))
            # All members before every member, for as many members at a time as make about ``PAIRS`` pairs.
            for some in np.split(own, np.flatnonzero(np.diff(np.cumsum(before[own]) // PAIRS)) + 1):
                x = np.repeat(some, before[some])
                y = x - 1 - (np.arange(len(x)) - np.repeat(np.cumsum(before[some]) - before[some], before[some]))
                meet = np.flatnonzero((root[y] != root[x]) & (inside[x] | (block[y] != block[x])))
                x, y = x[meet], y[meet]
                meet = np.flatnonzero(100 * np.minimum(size[y], size[x]) >= similar * np.maximum(size[y], size[x]))
                x, y = x[meet], y[meet]
                odd = np.bitwise_count(sketch[at[y]] ^ sketch[at[x]]).sum(1, dtype=np.int64)
                meet = may_link(size[y], size[x], odd, similar)
                x, y = x[meet], y[meet]
                left.append(np.maximum(name[y], name[x]))
                right.append(np.minimum(name[y], name[x]))
        none = np.zeros(0, np.int64)
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate([*p, none])) for p in (left, right)], ["_a", "_b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []  # rows of a group whose end hasn't come yet
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([*kept, batch])
            last = [table.column(c)[-1].as_py() for c in columns[:3]]
            same = np.ones(table.num_rows, bool)
            for c, v in zip(columns[:3], last, strict=True):
                same &= table.column(c).to_numpy() == v
            at = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
            if at:
                yield pairs_of(table.slice(0, at))
            kept = table.slice(at).combine_chunks().to_batches()
        if kept:
            yield pairs_of(pa.Table.from_batches(kept))

    return likely(rows.mapInArrow(run, "_a long, _b long").distinct(), classes, similar)


def classed(rows: DataFrame, kind: str, similar: int, words: int) -> tuple[DataFrame, DataFrame]:
    """Per row ``_id, _class, n_shingles``; per class ``_class, _first, _rows, component_id`` and ``_lead``, whether it
    is the one class of its component that holds the document which stays."""
    each = cut(class_rows(rows, kind, words))
    # The row that stands for a class: its smallest identifier; a class without any takes part with the null row.
    one = [F.min(c).alias(n) for c, n in (("_id", "_first"), ("n_shingles", "n_shingles"), ("_sketch", "_sketch"))]
    classes = cut(each.where("_class is not null").groupBy("_class").agg(*one, F.count(F.lit(1)).alias("_rows")))
    members = cut(shared_keys(index_rows(rows, similar, words)))
    # The member that shares the most with others leads its buckets.
    sizes = members.groupBy("_key").agg(F.count(F.lit(1)).alias("_n"))
    weights = members.join(sizes, "_key").groupBy("_class").agg(F.sum("_n").alias("_weight"))
    hubs = cut(leaders(members.join(weights, "_class"), F.col("_weight")))
    pairs = cut(likely(hub_pairs(members, hubs), classes, similar))
    links = cut(verify(pairs, texts_of(rows, pairs, classes, kind, words), similar, words))
    pairs = cut(rest_pairs(rest_groups(members, hubs, components(links)), classes, similar))
    links = cut(links.unionByName(verify(pairs, texts_of(rows, pairs, classes, kind, words), similar, words)))
    roots = components(links)
    known = classes.join(roots, "_class", "left").withColumn("_root", F.coalesce("_root", "_class"))
    first = F.struct(F.col("_first").isNull().alias("none"), F.col("_first").alias("id"), F.col("_class").alias("of"))
    least = known.groupBy("_root").agg(F.min(first).alias("_least"))
    known = known.select("_class", "_first", "_rows", "_root").join(least, "_root")
    return each, known.select("_class", "_first", "_rows", F.col("_least.id").alias("component_id"), (F.col("_class") == F.col("_least.of")).alias("_lead"))


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similar: int = SIMILAR, words: int = WORDS) -> DataFrame:
    """Per row: ``<id>, n_shingles, component_id``; shingles of ``words`` words, links from ``similar`` per cent up."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text"))
    each, known = classed(rows, kind, similar, words)
    out = each.join(known.select("_class", "component_id"), "_class", "left")
    return out.select(
        F.col("_id").alias(id_col),
        "n_shingles",
        F.when(F.col("_class").isNull(), F.col("_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def named_rows(docs: DataFrame, text_col: str, words: int) -> DataFrame:
    """``_class, _row`` of every row, the whole row as one struct."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(f"`{text_col}`").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, bounds in slices(batch.column(1)):
                found, size = fingerprints(*shingles(data, bounds, words), last - first)
                yield pa.RecordBatch.from_arrays([pa.array(found, mask=size == 0), batch.column(0).slice(first, last - first)], ["_class", "_row"])

    return rows.mapInArrow(run, f"_class long, _row {rows.schema['_row'].dataType.simpleString()}")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one document of every component stays, the one with the smallest identifier, and all without a word.

    Of rows that repeat it, or if no row of the component has an identifier, exactly one stays. Only classes that go or have
    several rows meet the rows again. An empty table stays empty; columns of any name come through unchanged.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select(F.col("doc_id").alias("_id"), F.col("text").alias("_text"))
    _, known = classed(rows, kind, STAGE_SIMILAR, STAGE_WORDS)
    special = cut(known.where("not _lead or _rows > 1").select(F.col("_class").alias("_named"), "_lead", "_first"))
    # So few that every task may hold them: then no text moves for them.
    special = F.broadcast(special) if special.count() <= FEW else special
    met = named_rows(docs, "text", STAGE_WORDS).join(special, F.col("_class") == F.col("_named"), "left")
    plain = met.where("_named is null").select("_row")
    again = met.where("_lead").where(F.col("_row.doc_id").eqNullSafe(F.col("_first"))).dropDuplicates(["_class"]).select("_row")
    return plain.unionAll(again).select("_row.*")
