"""Alignment of two tokenizers' ids on the bytes of one text, and how often their tokens meet in the corpus.

Both tokenizers read a space and the text. Side A is a byte-level file of the tokenizers library, side B a
sentencepiece model, which adds that space by itself. The strings of special tokens inside a text are plain text.

The tokens of a batch stand in two pandas frames by document and start. ``merge_asof`` finds for every start of one side
the token of the other side that covers it; both directions together are all overlaps of tokens, and overlaps
whose ends are equal close a group: between two such ends no token of either side is cut. All pairs of a group's tokens are
its links. They are counted by distinct ids with the product of their numbers, so a group in which two ids
repeat a million times is one pair of ids.

Per document the pairs and their numbers are written to the shared folder once. Spark counts in how many documents a
pair stands. Counts come back to the documents in two ways that give the same: pairs of at least 1/``HEAVY`` of all rows, of which there can be at
most ``HEAVY``, are broadcast; every other pair has fewer rows than that and meets its count in a join by the pair.

A text that is null or empty, or that one of the tokenizers doesn't keep byte for byte, has no tokens: zeros and an
empty digest. Very long texts are one slice of their own. Equal rows and rows without identifier are documents of their own. An empty
table gives an empty result; columns besides identifier and text play no part.
"""

from __future__ import annotations

import hashlib
import itertools
import os
import re
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagetables.llm.bpe import byte_characters
from pagetables.llm.common import shared_folder, slices, utf8
from pagetables.llm.token_files import ragged

#: Most pairs of ids that are broadcast; each has at least this fraction of all (document, pair) rows.
HEAVY = 1 << 18
#: Pieces encoded in one call, links of ids worked on at a time, bytes of text aligned together.
JOINED, PRODUCTS, TEXT = 256, 1 << 20, 1 << 20
#: Id of side B inside a pair's key.
SIDE = 1 << 31
MARK = "▁"
#: Characters beyond the six of ASCII that some pattern may take as white space.
WIDE = [*range(0x1C, 0x20), 0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x200E), 0x2028, 0x2029, 0x202F, 0x205F, 0x2060, 0x3000, 0xFEFF]
WIDE_SPACE = re.compile(f"[{''.join(map(chr, WIDE))}]")

OPEN_END = re.compile(f"[{MARK}{''.join(map(chr, WIDE))}]\\Z")


class Side:
    """One tokenizer: ids of a list of texts that begin with a space, bytes of every id."""

    bytes_of: list[bytes]
    by_piece: bool

    def encode(self, texts: list[str]) -> list[list[int]]:
        raise NotImplementedError

    def measure(self) -> None:
        self.length = np.array([len(b) for b in self.bytes_of], np.int64)
        self.table = pa.array(self.bytes_of, pa.binary())

    def tokens(self, pieces: pa.StringArray, open_end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all pieces in one array; where each piece's begin, how many it has, and whether their bytes are the piece's.

        Pieces without an open end are encoded many at a time.
        """
        n = len(pieces)
        first, count, ok = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, bool)
        joined = np.flatnonzero(~open_end) if self.by_piece else np.zeros(0, np.int64)
        ids, fit = np.zeros(0, np.int64), np.zeros(0, bool)
        while len(joined):
            ids, at, fit = self._joined(pieces.take(pa.array(joined)))
            if fit.all():
                first[joined], count[joined], ok[joined] = at[:-1], np.diff(at), True
                break
            joined = joined[fit]  # one of a group isn't kept byte for byte: which one shows when each is encoded alone
        alone = np.setdiff1d(np.arange(n), joined)
        found = self.encode(pieces.take(pa.array(alone)).to_pylist())
        parts, size = [ids if len(joined) else ids[:0]], len(ids) if len(joined) else 0
        for i, own in zip(alone.tolist(), found):
            if b"".join([self.bytes_of[x] for x in own]) == pieces[i].as_py().encode():
                first[i], count[i], ok[i] = size, len(own), True
                parts.append(np.array(own, np.int64))
                size += len(own)
        return np.concatenate(parts), first, count, ok

    def _joined(self, pieces: pa.StringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of pieces encoded by groups, their bounds, and which pieces' groups came back byte for byte."""
        data, bounds = utf8(pieces)
        raw = data.tobytes()
        cuts = np.append(np.arange(0, len(pieces), JOINED), len(pieces))
        at = bounds[cuts].tolist()
        found = self.encode([raw[i:j].decode() for i, j in zip(at, at[1:])])
        size = np.fromiter(map(len, found), np.int64, len(found))
        ids = np.fromiter(itertools.chain.from_iterable(found), np.int64, int(size.sum()))
        ends = np.cumsum(self.length[ids])
        group = np.repeat(np.arange(len(found)), np.diff(cuts))
        fit = np.diff(np.append(0, np.append(0, ends)[np.cumsum(size)])) == np.diff(bounds[cuts])
        if not fit.all():
            return ids, bounds, fit[group]
        bytes_now = np.frombuffer(self.table.take(pa.array(ids)).buffers()[2], np.uint8)[: len(data)]
        fit[np.searchsorted(bounds[cuts], np.flatnonzero(bytes_now != data), "right") - 1] = False
        last = np.searchsorted(ends, bounds[1:])
        fit[group[ends[last] != bounds[1:]]] = False
        return ids, np.append(0, last + 1), fit[group]


class ByteLevel(Side):
    """A byte-level file of the tokenizers library; special strings are plain text."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.tokenizer.encode_special_tokens = True
        to_byte = byte_characters()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        plain = self.tokenizer.get_vocab(with_added_tokens=False)
        self.bytes_of = [b""] * (max(vocabulary.values()) + 1)
        for piece, i in plain.items():
            self.bytes_of[i] = bytes(to_byte[c] for c in piece)
        # Words of the byte-level split may hold one space in front and none inside.
        self.by_piece = '"use_regex":true' in self.tokenizer.to_str().replace(" ", "") and self.tokenizer.normalizer is None
        self.measure()

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


class Pieces(Side):
    """A sentencepiece model; the space in front of a text is the one that it adds."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        spelled = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes_of = [
            b"" if self.model.is_control(i) or self.model.is_unknown(i)
            else bytes([int(p[3:5], 16)]) if self.model.is_byte(i)
            else p.replace(MARK, " ").encode()
            for i, p in enumerate(spelled)
        ]
        # Where no piece goes on after a word's end, no merge reaches over it.
        inside = re.compile(f"[^{MARK}]{MARK}")
        self.by_piece = not any(inside.search(p) for p in spelled) and self.joins()
        self.measure()

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode([t[1:] for t in texts], num_threads=1)

    def joins(self) -> bool:
        """Whether texts keep their spaces, so that pieces may be joined, on samples with runs of them."""
        whole = [" a", "  b", " c", "   d", " e\n", " f.", " \t g"]
        return self.encode(["".join(whole)])[0] == [x for t in whole for x in self.encode([t])[0]]


@lru_cache(maxsize=2)
def sides(path_a: str, path_b: str) -> tuple[Side, Side]:
    return ByteLevel(path_a), Pieces(path_b)


def default_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def cut_pieces(data: np.ndarray, bounds: np.ndarray, wide: bool) -> np.ndarray:
    """Where texts may be cut for both sides: before a space after a word, one neighbour being no white space for sure."""
    known = np.zeros(256, bool)
    known[33:127] = True
    known[128:] = not wide
    cuts = np.zeros(len(data) + 1, bool)
    cuts[1:-2] = (data[1:-1] == 32) & (data[:-2] != 32) & (known[data[:-2]] | known[data[2:]])
    # A last space stays with what stands before it: alone it would be an empty text to one side.
    cuts[bounds[1:] - 1] = False
    cuts[bounds] = True
    return np.flatnonzero(cuts)


def open_ends(pieces: pa.StringArray) -> np.ndarray:
    """Pieces whose last character might run together with the space of the next piece, or be white space to a pattern."""
    data, bounds = utf8(pieces)
    last = data[bounds[1:] - 1]
    out = (last < 33) | (last == 127)
    wide = np.flatnonzero(last > 127)
    out[wide] = [bool(OPEN_END.search(p)) for p in pieces.take(pa.array(wide)).to_pylist()]
    return out


class Tokens:
    """All tokens of one side of a slice of texts: id, document, start and end among the slice's bytes."""

    def __init__(self, side: Side, found: tuple, which: np.ndarray, rows: np.ndarray, n: int, kept: np.ndarray, at: np.ndarray) -> None:
        flat, begin, count, _ = found
        use = kept[rows]
        taken, per_piece = ragged(begin, count, which[use])
        self.id = flat[taken]
        self.row = np.repeat(rows[use], per_piece)
        length = side.length[self.id]
        # Pieces begin where they stand in the slice; the tokens of one follow each other from there.
        end = np.cumsum(length)
        first = np.cumsum(per_piece) - per_piece
        some = per_piece > 0
        before = np.zeros(len(per_piece), np.int64)
        before[some] = end[first[some]] - length[first[some]]
        self.start = end - length - np.repeat(before, per_piece) + np.repeat(at[use], per_piece)
        self.end = self.start + length
        self.n = np.bincount(self.row, minlength=n)

    def frame(self, name: str) -> pd.DataFrame:
        return pd.DataFrame({"start": self.start, "row": self.row, name: np.arange(len(self.id))})


def overlaps(a: Tokens, b: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all pairs of tokens whose bytes overlap, by A and then by B."""
    fa, fb = a.frame("a"), b.frame("b")
    there = pd.merge_asof(fa, fb, on="start", by="row")  # every A start and the B token that covers it
    back = pd.merge_asof(fb, fa, on="start", by="row")
    wide = max(len(fb), 1)
    both = [x["a"].to_numpy(np.int64) * wide + x["b"].to_numpy(np.int64) for x in (there, back)]
    both = np.sort(np.concatenate(both), kind="stable")  # two ascending runs
    both = both[np.append(True, both[1:] != both[:-1])] if len(both) else both
    return both // wide, both % wide


class Slice:
    """The alignment of a slice of texts: tokens of both sides, overlaps, and the group of every token."""

    def __init__(self, texts: pa.Array, a: Side, b: Side) -> None:
        n = self.n = len(texts)
        spaced = pc.binary_join_element_wise(" ", texts, "")
        data, bounds = utf8(spaced)
        empty = np.diff(bounds) <= 1
        if a.by_piece and b.by_piece:
            cuts = cut_pieces(data, bounds, bool(WIDE_SPACE.search(data.tobytes().decode())))
        else:
            cuts = bounds
        coded = pa.StringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(data)).dictionary_encode()
        which, pieces = coded.indices.to_numpy(), coded.dictionary
        rows = np.searchsorted(bounds, cuts[:-1], "right") - 1
        ends = open_ends(pieces)
        in_a, in_b = a.tokens(pieces, ends), b.tokens(pieces, ends)
        ok = in_a[3] & in_b[3]
        self.kept = ~empty & (np.bincount(rows, ~ok[which], minlength=n) == 0)
        self.a = Tokens(a, in_a, which, rows, n, self.kept, cuts[:-1])
        self.b = Tokens(b, in_b, which, rows, n, self.kept, cuts[:-1])
        self.over_a, self.over_b = overlaps(self.a, self.b)
        closing = self.over_a[self.a.end[self.over_a] == self.b.end[self.over_b]]
        self.cuts, self.cut_row = self.a.end[closing], self.a.row[closing]
        self.group_a = np.searchsorted(self.cuts, self.a.end)
        self.group_b = np.searchsorted(self.cuts, self.b.end)
        self.groups = np.bincount(self.cut_row, minlength=n)
        self.size_a = np.bincount(self.group_a, minlength=len(self.cuts))
        self.size_b = np.bincount(self.group_b, minlength=len(self.cuts))

    def links(self) -> np.ndarray:
        """Number of links of every text."""
        out = np.zeros(self.n, np.int64)
        np.add.at(out, self.cut_row, self.size_a * self.size_b)
        return out

    def digests(self, spelled: pa.Array, wide: int) -> list[str]:
        """SHA-256 of every text's groups as text: ids of A, a bar, ids of B, a semicolon between groups."""
        na, nb = np.cumsum(self.size_a), np.cumsum(self.size_b)
        order = np.empty(len(self.group_a) + len(self.group_b), np.int64)
        ia, ib = np.arange(len(self.group_a)), np.arange(len(self.group_b))
        last_a, last_b = ia + 1 == na[self.group_a], ib + 1 == nb[self.group_b]
        order[ia + (nb - self.size_b)[self.group_a]] = 2 * self.a.id + last_a
        order[ib + na[self.group_b]] = 2 * wide + 2 * self.b.id + last_b
        text = spelled.take(pa.array(order))
        offsets = np.frombuffer(text.buffers()[1], np.int32)[: len(text) + 1]
        raw = memoryview(text.buffers()[2]) if len(text) else memoryview(b"")
        ends = offsets[np.cumsum(self.a.n + self.b.n)]
        starts = np.append(0, ends[:-1])
        return [hashlib.sha256(raw[s : e - 1]).hexdigest() if e > s else "" for s, e in zip(starts.tolist(), ends.tolist())]

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, pair of ids and number of links, once per text and pair, by text and pair."""
        groups = len(self.cuts)
        ka, ca = np.unique(self.group_a * SIDE + self.a.id, return_counts=True)
        kb, cb = np.unique(self.group_b * SIDE + self.b.id, return_counts=True)
        per = np.bincount(kb // SIDE, minlength=groups)
        first = np.cumsum(per) - per
        of = ka // SIDE
        upto = np.cumsum(per[of])
        parts = []
        at = 0
        while at < len(ka):
            to = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + PRODUCTS, "right")))
            taken, times = ragged(first, per, of[at:to])
            row = np.repeat(self.cut_row[of[at:to]], times)
            pair = np.repeat(ka[at:to] % SIDE, times) * SIDE + kb[taken] % SIDE
            parts.append(add_up(row, pair, np.repeat(ca[at:to], times) * cb[taken]))
            at = to
        if not parts:
            none = np.zeros(0, np.int64)
            return none, none, none
        return add_up(*(np.concatenate(x) for x in zip(*parts))) if len(parts) > 1 else parts[0]


def add_up(row: np.ndarray, pair: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums of ``n`` by row and pair, in their order."""
    order = np.lexsort((pair, row))
    row, pair, n = row[order], pair[order], n[order]
    if not len(row):
        return row, pair, n
    new = np.append(True, (row[1:] != row[:-1]) | (pair[1:] != pair[:-1]))
    at = np.flatnonzero(new)
    return row[at], pair[at], np.add.reduceat(n, at)


def _sliced(batches: Iterator[pa.RecordBatch], a: Side, b: Side) -> Iterator[tuple[pa.Array, Slice]]:
    for batch in batches:
        texts = pc.fill_null(batch.column(1).cast(pa.string()), "")
        for first, last, _, _ in slices(texts, TEXT):
            yield batch.column(0).slice(first, last - first), Slice(texts.slice(first, last - first), a, b)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text"))


def _lists(values: np.ndarray, n: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(n)).astype(np.int32)), pa.array(values))


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``<id>, a_ids, b_ids, a_groups, b_groups, overlaps_a, overlaps_b`` of every text.

    ``a_groups`` and ``b_groups`` number the group of every token from 0; ``overlaps_a[i]`` and ``overlaps_b[i]`` are the
    places in ``a_ids`` and ``b_ids`` of two tokens that share a byte.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, s in _sliced(batches, *sides(path_a, path_b)):
            base = (np.cumsum(s.groups) - s.groups).astype(np.int64)
            before_a, before_b = np.cumsum(s.a.n) - s.a.n, np.cumsum(s.b.n) - s.b.n
            row = s.a.row[s.over_a]
            over = np.bincount(row, minlength=s.n)
            columns = [ids, _lists(s.a.id, s.a.n), _lists(s.b.id, s.b.n)]
            columns += [_lists(s.group_a - base[s.a.row], s.a.n), _lists(s.group_b - base[s.b.row], s.b.n)]
            columns += [_lists(s.over_a - before_a[row], over), _lists(s.over_b - before_b[row], over)]
            yield pa.RecordBatch.from_arrays(columns, ["_id", *names])

    names = ["a_ids", "b_ids", "a_groups", "b_groups", "overlaps_a", "overlaps_b"]
    out = _texts(docs, id_col, text_col).mapInArrow(run, f"_id {kind}, " + ", ".join(f"{x} array<bigint>" for x in names))
    return out.withColumnRenamed("_id", id_col)


def measure(docs: DataFrame, path_a: str, path_b: str, id_col: str, text_col: str) -> DataFrame:
    """Every text's numbers and digest, and its pairs of ids with their links."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = sides(path_a, path_b)
        wide = len(a.bytes_of)
        spelled = pa.array([f"{i}{c}" for i in range(wide) for c in ",|"] + [f"{i}{c}" for i in range(len(b.bytes_of)) for c in ",;"])
        for ids, s in _sliced(batches, a, b):
            row, pair, times = s.pairs()
            per = np.bincount(row, minlength=s.n)
            yield pa.RecordBatch.from_arrays(
                [ids, *(pa.array(x.astype(np.int64)) for x in (s.a.n, s.b.n, s.groups, s.links())), pa.array(s.digests(spelled, wide), pa.string()), _lists(pair, per), _lists(times, per)],
                ["_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "_pairs", "_times"],
            )

    shape = f"_id {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, _pairs array<bigint>, _times array<bigint>"
    return _texts(docs, id_col, text_col).mapInArrow(run, shape)


def link_counts(
    docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text", heavy: int = HEAVY
) -> DataFrame:
    """``<id>, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``, one row per row of ``docs``."""
    spark = docs.sparkSession
    folder = f"{shared_folder(spark)}/token-align-{uuid.uuid4().hex}"
    measured = measure(docs, path_a, path_b, id_col, text_col).withColumn("_row", F.monotonically_increasing_id())
    measured.write.option("compression", "zstd").parquet(f"{folder}/measured")
    stored = spark.read.parquet(f"{folder}/measured")
    found = stored.select("_row", F.explode(F.arrays_zip("_pairs", "_times")).alias("_p"))
    rows = found.select("_row", F.col("_p._pairs").alias("_pair"), F.col("_p._times").alias("_n"))

    counted = stored.select(F.explode("_pairs").alias("_pair")).groupBy("_pair").agg(F.count(F.lit(1)).alias("_docs"))
    of_a = Window.partitionBy((F.col("_pair") / SIDE).cast("bigint"))  # at most one row per id of side B
    counted.withColumn("_best", F.col("_docs") == F.max("_docs").over(of_a)).write.parquet(f"{folder}/counts")
    counts = spark.read.parquet(f"{folder}/counts")
    total = counts.agg(F.sum("_docs")).first()[0] or 0
    limit = total // heavy + 1  # pairs with so many rows or more: at most ``heavy``
    frequent, rare = counts.where(F.col("_docs") >= limit), counts.where(F.col("_docs") < limit)

    met = rows.join(F.broadcast(frequent), "_pair", "left")
    sums = [F.sum(F.col("_n") * F.col("_docs")).alias("_sum"), F.sum(F.when(F.col("_best"), F.col("_n"))).alias("_of_best")]
    parts = met.where(F.col("_docs").isNotNull()).groupBy("_row").agg(*sums)
    if limit > 1:
        rest = met.where(F.col("_docs").isNull()).select("_row", "_pair", "_n")
        parts = parts.unionAll(rest.join(rare, "_pair").groupBy("_row").agg(*sums))
    totals = parts.groupBy("_row").agg(F.sum("_sum").alias("_sum"), F.sum("_of_best").alias("_of_best"))
    out = stored.drop("_pairs", "_times").join(totals, "_row", "left")
    zero = F.lit(0).cast("bigint")
    return out.select(
        F.col("_id").alias(id_col), "n_a", "n_b", "n_groups", "n_links",
        F.coalesce("_of_best", zero).alias("n_best"), F.coalesce("_sum", zero).alias("count_sum"), "groups_sha256",
    )
