"""Token ids in binary files of fixed-width packed bits, written and read back by Spark tasks.

Every id takes the fewest bits that hold the vocabulary's highest id. A set of files is a folder:

* ``shard-<n>.bits``: the blocks, the offset of every block as 64-bit integers, and 40 bytes (``TRAILER``) that say how
  much there is, which is known only at the end of a streamed file. A block holds ``block`` ids (the last one fewer), bit after bit from the lowest, filled up to a whole
  byte, so any block is found by its offset and unpacked by numpy without the ones before it.
* ``shard-<n>.index``: an Arrow file with the identifier and the first position in the shard of every document.
* ``manifest``: a Parquet table ``shard, first, n_tokens, n_docs, name, index``, ``first`` being the number of ids in all
  shards before. A shard counts only once it is listed here.

Documents follow each other by identifier, ascending, null identifiers last, equal identifiers by a hash of their text; shards
are ranges of that order, so one identifier that holds many rows is still split. The bounds are found from identifiers and hashes
alone, so texts are encoded once and only ids move. A shard's file is written
under a name of the attempt alone and never changed, so a task that is run again after a lost executor
leaves nothing half written in the listed files. The folder has to be one that all executors share; its address may have
any scheme that ``pyarrow.fs`` knows.

Null texts count as empty: such a document has the end id alone. Texts are never cut; equal rows are documents of their
own; an empty table gives no shard and reads back as no row. Columns besides identifier and text play no part.
"""

from __future__ import annotations

import bisect
import itertools
import json
import os
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagetables.llm.common import LOWER, SPACES, shared_folder, slices, utf8

#: Ids in a block, bytes of text in a shard on average.
BLOCK, SHARD = 4096, 1 << 24
#: Ids of 49,408 and the end id that closes a document.
END_ID = 1
MAGIC = b"BITIDS01"
#: Mark, bits of an id, ids of a block, ids in all, documents, where the offsets of the blocks begin.
TRAILER = struct.Struct("<8sIIQQQ")
#: Ids unpacked at a time; bytes of text encoded at a time; words remembered per worker before those used least are dropped.
WINDOW, PART, REMEMBERED = 1 << 20, 1 << 23, 400_000
#: Fixed value: the word pattern of the tokenizer file.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def width_of(vocabulary: int) -> int:
    """Fewest bits that hold every id below ``vocabulary``."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """Ids as ``width`` bits each, lowest bit first, filled up with zero bits to a whole byte."""
    bits = np.unpackbits(ids.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
    return np.packbits(bits[:, :width].reshape(-1), bitorder="little").tobytes()


def unpack(data: bytes | np.ndarray, width: int, n: int) -> np.ndarray:
    """The first ``n`` ids of packed bytes."""
    bits = np.unpackbits(np.frombuffer(data, np.uint8), count=n * width, bitorder="little").reshape(n, width)
    whole = np.zeros((n, 32), np.uint8)
    whole[:, :width] = bits
    return np.packbits(whole, axis=1, bitorder="little").reshape(-1).view("<u4")


def byte_classes() -> np.ndarray:
    """Class of every byte where it's sure whatever stands beside it: 1 letter, 2 digit, 3 mark, 4 white space; else 0."""
    out = np.zeros(256, np.uint8)
    out[33:127] = 3
    out[48:58] = 2
    out[65:91] = out[97:123] = 1
    out[list(SPACES)] = 4
    return out


CLASSES = byte_classes()
APOSTROPHE = 39


class Encoder:
    """A tokenizer file of the tokenizers library; texts are encoded by their distinct pieces.

    Under the word pattern ``WORDS`` a text may be cut at ASCII white space and wherever letters, digits and marks
    meet, and its ids are those of the pieces one after the other. A piece of one class alone is one word, whose last id, and
    no other, carries the word end: many such pieces are encoded in one call. Other tokenizer files encode whole texts.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        steps = [x["type"] for x in (spec["normalizer"] or {}).get("normalizers", [])]
        words = (spec["pre_tokenizer"] or {}).get("pretokenizers", [{}])[0].get("pattern", {}).get("Regex")
        suffix = spec["model"].get("end_of_word_suffix")
        self.by_piece = words == WORDS and steps == ["NFC", "Replace", "Lowercase"] and bool(suffix)
        self.closes = np.zeros(vocabulary(path), bool)
        if suffix:
            self.closes[[i for piece, i in spec["model"]["vocab"].items() if piece.endswith(suffix)]] = True
        self.marks = [t["content"].encode() for t in spec["added_tokens"]]
        # Words met, the place of each one's ids and their number, how often a part of the texts held it.
        self.known = pa.array([], pa.string())
        self.flat, self.first, self.size, self.uses = (np.zeros(0, t) for t in (np.uint32, np.int64, np.int64, np.int64))

    def pieces(self, data: np.ndarray, bounds: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """All pieces in lower case where that's safe, which of them are one word, and the row of each."""
        classes = CLASSES[data]
        lead = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7))
        classes[lead] = classes[lead + 1] = 1  # accented Latin letters of two bytes
        space = classes == 4
        cuts = np.ones(len(data), bool)
        cuts[1:] = space[1:] != space[:-1]
        whole = any(m in data.tobytes() for m in self.marks)
        if not whole:
            a, b = classes[:-1], classes[1:]
            cuts[1:] |= (a > 0) & (b > 0) & ((a != b) | (a == 2)) & (data[:-1] != APOSTROPHE)
        cuts[bounds[:-1][bounds[:-1] < len(data)]] = True
        start = np.flatnonzero(cuts)
        size = np.diff(np.append(start, len(data)))
        pure = np.add.reduceat((classes == 0) | (data == APOSTROPHE), start, dtype=np.int64) == 0
        pure &= not whole
        keep = ~space[start]
        low = LOWER[data]
        low[lead + 1] |= np.where(data[lead + 1] < 0x9F, 0x20, 0).astype(np.uint8)
        low = np.where(np.repeat(pure, size), low, data)[~space]
        offsets = np.append(0, np.cumsum(size[keep])).astype(np.int32)
        words = pa.StringArray.from_buffers(int(keep.sum()), pa.py_buffer(offsets), pa.py_buffer(low))
        return words, pure[keep], np.searchsorted(bounds, start[keep], "right") - 1

    def learn(self, words: list[str], pure: np.ndarray) -> list[bytes]:
        """Ids of words not met yet, as 32-bit integers: one-word pieces many at a time, others by themselves."""
        out = [b""] * len(words)
        alone = np.flatnonzero(~pure).tolist()
        joined = np.flatnonzero(pure).tolist()
        groups = [joined[i : i + 256] for i in range(0, len(joined), 256)]
        texts = [" ".join([words[i] for i in g]) for g in groups]
        for group, e in zip(groups, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            found = np.array(e.ids, "<u4")
            ends = (4 * np.flatnonzero(self.closes[found]) + 4).tolist()
            if len(ends) != len(group):
                alone += group
                continue
            ids, first = found.tobytes(), 0
            for i, last in zip(group, ends):
                out[i] = ids[first:last]
                first = last
        for i, e in zip(alone, self.tokenizer.encode_batch_fast([words[i] for i in alone], add_special_tokens=False)):
            out[i] = np.array(e.ids, "<u4").tobytes()
        return out

    def keep(self, words: pa.Array, ids: list[bytes]) -> None:
        """Add words to those met."""
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        self.first = np.concatenate([self.first, len(self.flat) + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        self.flat = np.concatenate([self.flat, np.frombuffer(b"".join(ids), "<u4")])
        self.uses = np.concatenate([self.uses, np.zeros(len(ids), np.int64)])
        self.known = pa.concat_arrays([self.known, words])

    def forget(self) -> None:
        """Of too many words met, the half that was used most stays; a word that went is learned again when it is met."""
        if len(self.known) <= REMEMBERED:
            return
        stay = np.sort(np.argsort(-self.uses, kind="stable")[: REMEMBERED // 2])
        taken, self.size = ragged(self.first, self.size, stay)
        self.flat, self.first = self.flat[taken], np.cumsum(self.size) - self.size
        self.uses, self.known = self.uses[stay] // 2, self.known.take(pa.array(stay))

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each closed by the end id, and the n + 1 bounds between them."""
        if self.by_piece:
            data, bounds = utf8(texts)
            words, pure, rows = self.pieces(data, bounds) if len(data) else (pa.array([], pa.string()), np.zeros(0, bool), np.zeros(0, int))
            coded = words.dictionary_encode()
            which, distinct = coded.indices.to_numpy(), coded.dictionary
            self.forget()
            place = pc.index_in(distinct, value_set=self.known).fill_null(-1).to_numpy().astype(np.int64)
            new = np.flatnonzero(place < 0)
            sure = np.zeros(len(distinct), bool)
            sure[which] = pure
            unmet = distinct.take(pa.array(new))
            place[new] = len(self.known) + np.arange(len(new))
            self.keep(unmet, self.learn(unmet.to_pylist(), sure[new]))
            self.uses[place] += 1
            flat, first, size, which = self.flat, self.first, self.size, place[which]
        else:
            which = rows = np.arange(len(texts))
            found = self.tokenizer.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)
            ids = [np.array(e.ids, "<u4") for e in found]
            size = np.fromiter(map(len, ids), np.int64, len(ids))
            flat, first = np.concatenate([*ids, np.zeros(0, "<u4")]), np.cumsum(size) - size
        taken, per_piece = ragged(first, size, which)
        row = np.repeat(rows, per_piece)
        out = np.full(len(taken) + len(texts), end_id, np.uint32)
        out[np.arange(len(taken)) + row] = flat[taken]
        return out, np.append(0, np.cumsum(np.bincount(row, minlength=len(texts)) + 1))


def ragged(first: np.ndarray, size: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the members of the listed runs one after the other, and how many each run has."""
    n = size[which]
    before = np.cumsum(n) - n
    return np.repeat(first[which] - before, n) + np.arange(int(n.sum())), n


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@lru_cache(maxsize=4)
def vocabulary(path: str) -> int:
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True)


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``_id, _tie, _text``: rows of one identifier are told apart by a hash of their text."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return docs.select(F.col(f"`{id_col}`").alias("_id"), F.xxhash64(text).alias("_tie"), text.alias("_text"))


def shard_bounds(rows: DataFrame, shard: int) -> list[tuple]:
    """First key of every shard but the first: identifiers and hashes alone are ranged over, one key per shard returns."""
    total = rows.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    key = F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), F.col("_tie").alias("tie"))
    ranged = rows.select("_id", "_tie").repartitionByRange(max(1, -(-total // shard)), F.col("_id").asc_nulls_last(), "_tie")
    first = ranged.groupBy(F.spark_partition_id()).agg(F.min(key).alias("k")).select("k.*").collect()
    return sorted((bool(r.none), None if r.none else r.id, r.tie) for r in first)[1:]


def key_of(i: object, tie: int) -> tuple:
    return (True, tie) if i is None else (False, i, tie)


def encode(rows: DataFrame, path: str, end_id: int, bounds: list[tuple], item: int) -> DataFrame:
    """``_shard, _id, _tie, _n, _ids``: ids of every whole text and the end id, little-endian integers of ``item`` bytes."""
    kind = rows.schema["_id"].dataType.simpleString()
    keys = [key_of(i, tie) for _, i, tie in bounds]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(path)
        for batch in batches:
            texts = batch.column(2).cast(pa.string())
            for first, last, _, _ in slices(texts, PART):
                part = batch.slice(first, last - first)
                ids, ends = code.encode(part.column(2).cast(pa.string()), end_id)
                ids = ids.astype(f"<u{item}")
                offsets = pa.py_buffer((ends * item).astype(np.int64))
                data = pa.LargeBinaryArray.from_buffers(pa.large_binary(), last - first, [None, offsets, pa.py_buffer(ids)])
                at = [bisect.bisect_right(keys, key_of(i, t)) for i, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(at, pa.int32()), part.column(0), part.column(1), pa.array(np.diff(ends)), data.cast(pa.binary())],
                    ["_shard", "_id", "_tie", "_n", "_ids"],
                )

    return rows.mapInArrow(run, f"_shard int, _id {kind}, _tie bigint, _n bigint, _ids binary")


def file_system(folder: str) -> tuple[fs.FileSystem, str]:
    """File system and path of an address; ``file:/x``, ``file:///x`` and plain paths are the shared local mount."""
    if folder.startswith("file:"):
        folder = "/" + folder[5:].lstrip("/")
    return (fs.LocalFileSystem(), folder) if folder.startswith("/") else fs.FileSystem.from_uri(folder)


def write(
    docs: DataFrame, folder: str, path: str, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text",
    block: int = BLOCK, shard: int = SHARD,
) -> None:
    """Encode every document once and write the set of files to ``folder``."""
    spark = docs.sparkSession
    size = max(vocabulary(path), end_id + 1)
    width, item = width_of(size), 2 if size <= 1 << 16 else 4
    rows = keyed(docs, id_col, text_col)
    bounds = shard_bounds(rows, shard)
    dealt = encode(rows, path, end_id, bounds, item).repartition(len(bounds) + 1, "_shard")
    ordered = dealt.sortWithinPartitions("_shard", F.col("_id").asc_nulls_last(), "_tie", "_ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for at, own in by_shard(batches):
            n, n_docs, name, index = write_shard(own, folder, f"shard-{at:07d}-{uuid.uuid4().hex}", width, block, item)
            made = {"shard": pa.array([at], pa.int32()), "n_tokens": [n], "n_docs": [n_docs], "name": [name], "index": [index]}
            yield pa.RecordBatch.from_pydict(made)

    found = ordered.mapInArrow(run, "shard int, n_tokens bigint, n_docs bigint, name string, index string")
    found.write.parquet(f"{folder}/shards")
    kind = rows.schema["_id"].dataType.simpleString()
    with_first(spark.read.parquet(f"{folder}/shards")).withColumn("id_type", F.lit(kind)).write.parquet(f"{folder}/manifest")


def by_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Iterator[pa.RecordBatch]]]:
    """Runs of rows of one shard, from batches ordered by shard: its number and ``_id, _n, _ids``."""

    def parts() -> Iterator[tuple[int, pa.RecordBatch]]:
        for batch in batches:
            shard = batch.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(shard)) + 1).tolist(), len(shard)]
            for a, b in zip(cuts, cuts[1:]):
                if b > a:
                    yield int(shard[a]), batch.select([1, 3, 4]).slice(a, b - a)

    for at, run in itertools.groupby(parts(), key=lambda x: x[0]):
        yield at, (part for _, part in run)


def write_shard(
    batches: Iterator[pa.RecordBatch], folder: str, stem: str, width: int, block: int, item: int
) -> tuple[int, int, str, str]:
    """One shard's two files, streamed: a block leaves as soon as it is full."""
    system, base = file_system(folder)
    out = index = None
    offsets: list[int] = []
    left = np.zeros(0, f"<u{item}")
    n = n_docs = at = 0
    for batch in batches:
        if out is None:
            system.create_dir(f"{base}/files", recursive=True)
            out = system.open_output_stream(f"{base}/files/{stem}.bits")
            index = pa.ipc.new_file(system.open_output_stream(f"{base}/files/{stem}.index"), pa.schema([("id", batch.column(0).type), ("start", pa.int64())]))
        sizes = batch.column(1).to_numpy()
        index.write_batch(pa.RecordBatch.from_arrays([batch.column(0), pa.array(n + np.cumsum(sizes) - sizes)], ["id", "start"]))
        left = np.concatenate([left, *[np.frombuffer(ids.as_buffer(), f"<u{item}") for ids in batch.column(2)]])
        whole = len(left) - len(left) % block
        for first in range(0, whole, block):
            offsets.append(at)
            at += out.write(pack(left[first : first + block], width))
        left = left[whole:]
        n += int(sizes.sum())
        n_docs += batch.num_rows
    if len(left):
        offsets.append(at)
        at += out.write(pack(left, width))
    out.write(np.array(offsets, "<u8").tobytes() + TRAILER.pack(MAGIC, width, block, n, n_docs, at))
    out.close()
    index.close()
    return n, n_docs, f"files/{stem}.bits", f"files/{stem}.index"


def with_first(shards: DataFrame, per: int = 1024) -> DataFrame:
    """``first``: the ids of all shards before, as a running sum within runs of ``per`` shards and over the runs' sums."""
    run = (F.col("shard") / per).cast("int")
    inner = Window.partitionBy("_run").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.partitionBy("_top").orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    sums = shards.groupBy(run.alias("_run")).agg(F.sum("n_tokens").alias("_sum"))
    before = sums.withColumn("_top", F.lit(0)).select("_run", F.coalesce(F.sum("_sum").over(outer), F.lit(0)).alias("_before"))
    within = shards.withColumn("_run", run).withColumn("_within", F.coalesce(F.sum("n_tokens").over(inner), F.lit(0)))
    return within.join(before, "_run").withColumn("first", F.col("_before") + F.col("_within")).drop("_run", "_before", "_within")


class Shard:
    """Random access to one ``.bits`` file: any run of positions is read by the blocks that hold it."""

    def __init__(self, system: fs.FileSystem, path: str) -> None:
        self.file = system.open_input_file(path)
        mark, self.width, self.block, self.n, self.n_docs, at = TRAILER.unpack(
            self.file.read_at(TRAILER.size, self.file.size() - TRAILER.size)
        )
        if mark != MAGIC:
            raise ValueError(f"{path} isn't a file of packed ids")
        blocks = -(-self.n // self.block)
        self.offsets = np.append(np.frombuffer(self.file.read_at(8 * blocks, at), "<u8"), at).astype(np.int64)

    def ids(self, first: int, last: int) -> np.ndarray:
        """The ids at positions ``first`` up to ``last``, which may span many blocks."""
        if first >= last:
            return np.zeros(0, np.uint32)
        a, b = first // self.block, (last - 1) // self.block
        data = np.frombuffer(self.file.read_at(int(self.offsets[b + 1] - self.offsets[a]), int(self.offsets[a])), np.uint8)
        stride = int(self.offsets[a + 1] - self.offsets[a])
        if self.block * self.width % 8 == 0 or a == b:  # the bits of the blocks follow each other without filling
            found = unpack(data, self.width, min((b + 1) * self.block, self.n) - a * self.block)
        else:
            cuts = range(0, len(data), stride)
            sizes = [min(self.block, self.n - (a + i) * self.block) for i in range(len(cuts))]
            found = np.concatenate([unpack(data[c : c + stride], self.width, s) for c, s in zip(cuts, sizes)])
        return found[first - a * self.block : last - a * self.block]

    def pieces(self, first: int, last: int) -> Iterator[np.ndarray]:
        """The same in pieces of at most ``WINDOW`` ids."""
        for at in range(first, last, WINDOW):
            yield self.ids(at, min(at + WINDOW, last))


def each_document(folder: str, made: Callable[[Shard, np.ndarray], pa.Array], field: str):
    """A function over batches of the manifest: ``doc_id, start, n_tokens`` and what ``made`` gives for a shard's bounds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = file_system(folder)
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(system, f"{base}/{row['name']}")
                index = pa.ipc.open_file(system.open_input_file(f"{base}/{row['index']}"))
                for i in range(index.num_record_batches):
                    part = index.get_batch(i)
                    starts = part.column(1).to_numpy()
                    following = index.get_batch(i + 1).column(1)[0].as_py() if i + 1 < index.num_record_batches else shard.n
                    bounds = np.append(starts, following)
                    for cut in range(0, len(starts), 1024):
                        some = bounds[cut : cut + 1025]
                        yield pa.RecordBatch.from_arrays(
                            [part.column(0).slice(cut, 1024), pa.array(some[:-1] + row["first"]), pa.array(np.diff(some)), made(shard, some)],
                            ["_id", "start", "n_tokens", field],
                        )

    return run


def whole_ids(shard: Shard, bounds: np.ndarray) -> pa.Array:
    ids = [shard.ids(a, b) for a, b in zip(bounds[:-1], bounds[1:])]
    return pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32()))


def checksums(shard: Shard, bounds: np.ndarray) -> pa.Array:
    """crc32 of every document's ids; neighbouring documents are unpacked together, long ones piece by piece."""
    out = np.zeros(len(bounds) - 1, np.int64)
    i = 0
    while i < len(out):
        j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + WINDOW, "right")) - 1)
        if j == i + 1:
            for piece in shard.pieces(int(bounds[i]), int(bounds[j])):
                out[i] = zlib.crc32(piece.astype("<u4"), int(out[i]))
        else:
            ids, zero = shard.ids(int(bounds[i]), int(bounds[j])).astype("<u4"), bounds[i]
            for k in range(i, j):
                out[k] = zlib.crc32(ids[bounds[k] - zero : bounds[k + 1] - zero])
        i = j
    return pa.array(out)


def _read(spark: SparkSession, folder: str, id_col: str, made, field: str, kind: str) -> DataFrame:
    manifest = spark.read.parquet(f"{folder}/manifest")
    n, id_kind = manifest.agg(F.count(F.lit(1)), F.first("id_type")).first()
    dealt = manifest.select("name", "index", "first").repartition(max(1, n), "name")
    out = dealt.mapInArrow(each_document(folder, made, field), f"_id {id_kind or 'bigint'}, start bigint, n_tokens bigint, {field} {kind}")
    return out.withColumnRenamed("_id", id_col)


def read(spark: SparkSession, folder: str, id_col: str = "doc_id") -> DataFrame:
    """``<id>, start, n_tokens, ids``: every document of a set of files, ``start`` counting over all shards."""
    return _read(spark, folder, id_col, whole_ids, "ids", "array<int>")


def read_checksums(spark: SparkSession, folder: str, id_col: str = "doc_id") -> DataFrame:
    """The same with the crc32 of the ids as little-endian unsigned 32-bit integers instead of the ids."""
    return _read(spark, folder, id_col, checksums, "ids_crc32", "bigint")


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write all documents to a new folder in the shared one and read the files back as checksums."""
    folder = f"{shared_folder(docs.sparkSession)}/token-files-{uuid.uuid4().hex}"
    write(docs, folder, path, id_col=id_col, text_col=text_col)
    return read_checksums(docs.sparkSession, folder, id_col)
