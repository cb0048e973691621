"""What the operators share: shared folder, words of whole texts as arrays, remainders of identifiers."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space that separates words: space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = b" \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
#: Texts are worked on in slices of about so many bytes; a longer text is a slice of its own.
SLICE = 1 << 21

IS_SPACE = np.zeros(256, bool)
IS_SPACE[list(SPACES)] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: the one the session names, or one beside the warehouse in local mode."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
    return f"{spark.conf.get('spark.sql.warehouse.dir')}-checkpoints"


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage by a checkpoint in the shared folder."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """The rows, written to the shared folder as compressed Parquet and read again: a checkpoint of many short values takes more."""
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def remainder(column: Column | str, n: int) -> Column:
    """crc32 of the identifier written as text, modulo n; null for a null identifier."""
    return F.crc32((F.col(column) if isinstance(column, str) else column).cast("string").cast("binary")) % n


def scatter(values: np.ndarray) -> np.ndarray:
    """A fixed well-mixing function on 64 bits."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


BYTE = scatter(np.arange(1, 257, dtype=np.uint64))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS["up"]) < n:
        size = max(n, SLICE + 1)
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.cumprod(steps)
    return _POWERS["up"][:n], _POWERS["down"]


def utf8(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the n + 1 bounds between them; null counts as empty."""
    if len(array) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    array = pc.fill_null(array.cast(pa.string()), "")
    _, offsets, data = array.buffers()
    bounds = np.frombuffer(offsets, np.int32)[array.offset : array.offset + len(array) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[bounds[0] : bounds[-1]], bounds - bounds[0]


def slices(array: pa.Array, limit: int = SLICE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole texts of about ``limit`` bytes: first row, last row + 1, bytes, bounds."""
    data, bounds = utf8(array)
    first = 0
    while first < len(array):
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + limit, "right")) - 1)
        yield first, last, data[bounds[first] : bounds[last]], bounds[first : last + 1] - bounds[first]
        first = last


def spans(data: np.ndarray, bounds: np.ndarray, splits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of the runs of bytes between separators; none crosses a row."""
    if not len(data):
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    split = mapped(data, splits).view(bool)
    word = ~split
    inner = bounds[(bounds > 0) & (bounds < len(data))]
    opens = word.copy()  # a run begins or ends at a bound whatever stands before or behind
    opens[1:] &= split[:-1]
    opens[inner] = word[inner]
    closes = word.copy()
    closes[:-1] &= split[1:]
    closes[inner - 1] = word[inner - 1]
    start = np.flatnonzero(opens)
    return start, np.flatnonzero(closes) + 1, np.repeat(np.arange(len(bounds) - 1), np.diff(np.searchsorted(start, bounds)))


def mapped(data: np.ndarray, values: np.ndarray) -> np.ndarray:
    """``values[data]`` for bytes and a table of 256 small values."""
    return np.frombuffer(data.tobytes().translate(values.astype(np.uint8).tobytes()), np.uint8)


def byte_sums(data: np.ndarray) -> np.ndarray:
    """What ``span_hash`` adds up, before every byte; some bytes at a time, as they fit the processor's cache."""
    up, _ = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    for i in range(0, len(data), 1 << 15):
        part = BYTE[data[i : i + (1 << 15)]]
        part *= up[i : i + len(part)]
        part[:1] += sums[i : i + 1]
        np.cumsum(part, out=sums[i + 1 : i + 1 + len(part)])
    return sums


def span_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray, sums: np.ndarray | None = None) -> np.ndarray:
    """64-bit hash of every span of bytes, independent of where it stands; ``sums`` are the ``byte_sums``, if they are known."""
    sums = byte_sums(data) if sums is None else sums
    _, down = powers(len(data) + 1)
    return scatter((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


def row_counts(rows: np.ndarray, n: int, weights: np.ndarray | None = None) -> np.ndarray:
    return np.bincount(rows, weights, minlength=n)


def code_points(data: np.ndarray) -> np.ndarray:
    """Running count of code points before every byte position, and in all at the end."""
    out = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=out[1:])
    return out


def n_words(column: Column | str) -> Column:
    """Number of words of a whole text, null 0."""
    text = F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))
    return F.regexp_count(text, F.lit(WORD)).cast("long")
