"""Byte-level BPE encoding and decoding with the merges of a public tokenizer file.

A text is split into words by the tokenizer's pattern; the ids of a word depend on the word alone and are
remembered. Short words are encoded in contiguous arrays, words of one length side by side: part boundaries with the rank of the
merge that each part and its right neighbour would make. Every array is scanned for the smallest rank, that boundary is
deleted, and the two neighbouring ranks are made anew, until no rank is left. For a long word repeated scans
would take quadratic time; there the same merges are picked from a heap, with the same result.

The text of an added token (such as an end-of-text mark) becomes its id wherever it stands, as the tokenizers
library does by default. Null texts count as empty and give no ids; nothing is truncated or padded.
"""

from __future__ import annotations

import heapq
import itertools
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed values of the byte-level split.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same for texts in ASCII, where the standard library's expressions are faster.
ASCII = r"'(?:[stmd]|re|ve|ll)| ?[A-Za-z]+| ?[0-9]+| ?[^ \t\n\r\f\vA-Za-z0-9]+|[ \t\n\r\f\v]+(?![^ \t\n\r\f\v])|[ \t\n\r\f\v]+"
#: Words of up to so many bytes are scanned; longer ones use the heap.
SHORT = 64
#: Words remembered per worker; the half that was met longer ago goes first.
REMEMBERED = 400_000
#: Words of one length scanned side by side, slots of a table of pairs.
SIDE, SLOTS = 4096, 1 << 18
NO_RANK = 1 << 30
GOLD, EMPTY = np.uint64(0x9E3779B97F4A7C15), np.uint64((1 << 64) - 1)
#: Texts encoded together, and their characters.
ROWS, PART = 1024, 1 << 22


def byte_characters() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shifted = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(shifted)}


class Pairs:
    """Ranks of pairs of ids for many pairs at once: tables of hashed slots, each for what fell on a slot taken in the one before."""

    def __init__(self, merges: dict[tuple[int, int], tuple[int, int]]) -> None:
        pairs = np.array([*merges, (0, 0)], np.uint64)[:-1]
        self.made = np.zeros(max((r for r, _ in merges.values()), default=0) + 1, np.int32)
        rank = np.array([r for r, _ in merges.values()], np.int32)
        self.made[rank] = [m for _, m in merges.values()]
        key = pairs[:, 0] << np.uint64(32) | pairs[:, 1]
        self.tables: list[tuple[np.ndarray, np.ndarray]] = []
        while len(key) or not self.tables:
            slot = self.slot(key, len(self.tables))
            _, first = np.unique(slot, return_index=True)
            keys, ranks = np.full(SLOTS, EMPTY), np.full(SLOTS, NO_RANK, np.int32)
            keys[slot[first]], ranks[slot[first]] = key[first], rank[first]
            self.tables.append((keys, ranks))
            left = np.ones(len(key), bool)
            left[first] = False
            key, rank = key[left], rank[left]

    def slot(self, key: np.ndarray, table: int) -> np.ndarray:
        return ((key * (GOLD + np.uint64(2 * table))) >> np.uint64(65 - SLOTS.bit_length())).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of every pair, ``NO_RANK`` for one that no merge makes."""
        key = left.astype(np.uint64).ravel() << np.uint64(32) | right.astype(np.uint64).ravel()
        out, rest = np.full(key.shape, NO_RANK, np.int32), np.arange(len(key))
        for table, (keys, ranks) in enumerate(self.tables):
            at = self.slot(key[rest], table)
            held = keys[at]
            hit = held == key[rest]
            out[rest[hit]] = ranks[at[hit]]
            rest = rest[~hit & (held != EMPTY)]
            if not len(rest):
                break
        return out.reshape(left.shape)


class Codec:
    """Merges and vocabulary of one tokenizer file (byte-level BPE, no normaliser)."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        to_byte = byte_characters()
        vocab = spec["model"]["vocab"]
        self.bytes_of = {i: bytes(to_byte[c] for c in piece) for piece, i in vocab.items()}
        self.byte_id = [0] * 256
        for c, b in to_byte.items():
            self.byte_id[b] = vocab[c]
        self.byte_ids = np.array(self.byte_id, np.int32)
        self.merges = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[vocab[left], vocab[right]] = (rank, vocab[left + right])
        self.pairs = Pairs(self.merges)
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of |= {i: text.encode() for text, i in self.added.items()}
        self.pieces = pa.array([self.bytes_of.get(i) for i in range(max(self.bytes_of, default=-1) + 1)], pa.large_binary())
        longest = sorted(self.added, key=len, reverse=True)
        self.marks = regex.compile("(" + "|".join(map(regex.escape, longest)) + ")") if longest else None
        self.words, self.ascii_words = regex.compile(PATTERN), re.compile(ASCII)
        #: Ids of words, as bytes of 32-bit numbers: those met since, and those met before them.
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def scans(self, ids: np.ndarray) -> list[bytes]:
        """Contiguous arrays of parts and ranks, one per row: find the smallest rank, drop the boundary, refresh its
        neighbours. Rows that still merge have lost the same number of parts. Gives the ids as bytes of 32-bit numbers."""
        out = [b""] * len(ids)
        row = np.arange(len(ids))
        ranks = np.full(ids.shape, NO_RANK, np.int32)
        ranks[:, :-1] = self.pairs.ranks(ids[:, :-1], ids[:, 1:])
        while len(row):
            own = np.arange(len(row))
            i = ranks.argmin(1)
            least = ranks[own, i]
            ends = least == NO_RANK
            if ends.any():
                whole, step = ids[ends].tobytes(), 4 * ids.shape[1]
                for k, r in enumerate(row[ends].tolist()):
                    out[r] = whole[k * step : (k + 1) * step]
                row, ids, ranks, i, least = (x[~ends] for x in (row, ids, ranks, i, least))
                own = own[: len(row)]
            if not len(row):
                break
            places = np.arange(ids.shape[1] - 1)
            places = places + (places > i[:, None])
            ids, ranks = np.take_along_axis(ids, places, 1), np.take_along_axis(ranks, places, 1)
            ids[own, i] = self.pairs.made[least]
            inner = np.flatnonzero(i + 1 < ids.shape[1])
            ranks[own, i] = NO_RANK
            ranks[inner, i[inner]] = self.pairs.ranks(ids[inner, i[inner]], ids[inner, i[inner] + 1])
            inner = np.flatnonzero(i)
            ranks[inner, i[inner] - 1] = self.pairs.ranks(ids[inner, i[inner] - 1], ids[inner, i[inner]])
        return out

    def scan(self, ids: list[int]) -> list[int]:
        return np.frombuffer(self.scans(np.array([ids], np.int32))[0], np.int32).tolist()

    def heap(self, ids: list[int]) -> list[int]:
        """The same merges for a long word: candidates in a heap, parts in a linked list."""
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        end, merges = len(ids), self.merges
        queue = [(m[0], i, ids[i], ids[i + 1]) for i in range(end - 1) if (m := merges.get((ids[i], ids[i + 1])))]
        heapq.heapify(queue)
        while queue:
            _, i, left, right = heapq.heappop(queue)
            j = after[i]
            if ids[i] != left or j >= end or ids[j] != right:
                continue  # one of the two has been merged meanwhile
            ids[i], ids[j] = merges[left, right][1], -1
            after[i] = after[j]
            if after[i] < end:
                before[after[i]] = i
                if m := merges.get((ids[i], ids[after[i]])):
                    heapq.heappush(queue, (m[0], i, ids[i], ids[after[i]]))
            if (h := before[i]) >= 0 and (m := merges.get((ids[h], ids[i]))):
                heapq.heappush(queue, (m[0], h, ids[h], ids[i]))
        return [x for x in ids if x >= 0]

    def learn(self, words: list[str]) -> None:
        """Remembers the ids of some distinct words."""
        data = [w.encode("utf-8", "surrogatepass") for w in words]
        sizes = np.array([len(w) for w in data])
        order = np.argsort(sizes, kind="stable")
        for some in np.split(order, np.flatnonzero(np.diff(sizes[order])) + 1):
            own = [data[i] for i in some.tolist()]
            if len(own) and len(own[0]) <= SHORT:
                ids = self.byte_ids[np.frombuffer(b"".join(own), np.uint8)].reshape(len(own), -1)
                found = [x for at in range(0, len(own), SIDE) for x in self.scans(ids[at : at + SIDE])]
            else:
                found = [np.array(self.heap(self.byte_ids[np.frombuffer(w, np.uint8)].tolist()), np.int32).tobytes() for w in own]
            self.known.update(zip([words[i] for i in some.tolist()], found, strict=True))
        for mark in self.added.keys() & set(words):
            self.known[mark] = np.array([self.added[mark]], np.int32).tobytes()

    def split(self, text: str) -> list[str]:
        """The words of a text; an added token's text is one of them."""
        words = (self.ascii_words if text.isascii() else self.words).findall
        if not any(m in text for m in self.added):
            return words(text)
        return [w for piece in self.marks.split(text) for w in ([piece] if piece in self.added else words(piece))]

    def encode_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one behind the other, and where each text's begin and end."""
        words = [self.split(t) for t in texts]
        if len(self.known) >= REMEMBERED // 2:
            self.known, self.older = {}, self.known
        new = set().union(*words) - self.known.keys()
        again = new & self.older.keys()
        self.known.update((w, self.older[w]) for w in again)
        self.learn([*(new - again)])
        found = [b"".join(map(self.known.__getitem__, own)) for own in words]
        for w in new:
            if len(w) > SHORT:
                del self.known[w]
        ends = np.cumsum([0, *map(len, found)]) // 4
        return np.frombuffer(b"".join(found), np.int32), ends

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0].tolist()

    def decode_all(self, ids: np.ndarray, ends: np.ndarray) -> list[str]:
        """The texts of ids one behind the other."""
        _, offsets, data = self.pieces.take(pa.array(ids)).buffers()
        data = memoryview(data or b"")
        at = np.frombuffer(offsets, np.int64)[ends].tolist() if len(ids) else [0] * len(ends)
        return [str(data[a:b], "utf-8", "replace") for a, b in itertools.pairwise(at)]

    def decode(self, ids: list[int]) -> str:
        return self.decode_all(np.array(ids, np.int32), np.array([0, len(ids)]))[0]


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows that are encoded together, few if their texts are long."""
    ends = np.cumsum(pc.fill_null(pc.utf8_length(batch.column(1)), 0).to_numpy())
    first = 0
    while first < batch.num_rows:
        most = PART + (int(ends[first - 1]) if first else 0)
        last = min(first + ROWS, max(first + 1, int(np.searchsorted(ends, most, "right"))))
        yield batch.slice(first, last - first)
        first = last


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``<id>, ids array<int>, decoded string``: the ids of every whole text and what they decode to.

    ``path`` is a file that every worker can read at the same place (part of the Python environment).
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = codec(path)
        for batch in batches:
            for part in parts(batch):
                ids, ends = code.encode_all([t or "" for t in part.column(1).to_pylist()])
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), lists, pa.array(code.decode_all(ids, ends), pa.string())], ["_id", "ids", "decoded"]
                )

    out = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text"))
    return out.mapInArrow(run, f"_id {kind}, ids array<int>, decoded string").withColumnRenamed("_id", id_col)


def digest(encoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Number of ids and the digests of ids and decoded text."""
    return encoded.select(
        id_col,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage, the last: every document that is left, encoded and decoded again."""
    return digest(encode(docs, default_path()))
