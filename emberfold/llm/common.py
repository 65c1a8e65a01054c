"""Helpers shared by the operators: Arrow word splitting, packed arrays, column handling."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emberfold.session import cut_lineage as cut  # noqa: F401
from emberfold.session import drop_tables as discard  # noqa: F401

# Words are runs of anything but these six characters; Java's regex syntax.
SPACE = "[ \\t\\n\\x0B\\f\\r]+"
# Text bytes that a task works on at once.
SLICE_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, also inside lambdas."""
    return F.transform(F.array(value), body)[0]


def word_list(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Pieces of a batch with at most ``limit`` bytes of text each, or a single longer row."""
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(size, dtype=np.int64)
    at, rows = 0, batch.num_rows
    while at < rows:
        done = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + limit, "right")))
        yield batch.slice(at, to - at)
        at = to


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(words per row, codes of all words in order, the distinct words); A-Z are lower-cased."""
    return split_words(pc.ascii_lower(pc.fill_null(texts, "")))


def split_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    split = pc.ascii_split_whitespace(texts)
    flat = split.flatten()
    counts = np.diff(split.offsets.to_numpy())
    full = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    if not full.all():
        before = np.concatenate([[0], np.cumsum(full)])
        edges = np.concatenate([[0], np.cumsum(counts)])
        counts = np.diff(before[edges])
        flat = flat.filter(pa.array(full))
    coded = flat.dictionary_encode()
    return counts.astype(np.int64), coded.indices.to_numpy(), coded.dictionary.to_numpy(zero_copy_only=False).tolist()


def hash_words(words: list[str]) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter(map(digest, words), np.uint64, len(words))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def shingle_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` word hashes (empty if there are fewer)."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(width):
        out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + n])
    return out


def pack(array: np.ndarray) -> bytes:
    """Compressed, byte by byte of the numbers: small numbers leave whole planes of zeros."""
    array = np.ascontiguousarray(array)
    planes = array.view(np.uint8).reshape(len(array), array.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpack(data: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(size, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def runs(sorted_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs of equal values."""
    if not len(sorted_keys):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    starts = np.flatnonzero(np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]]))
    return starts, np.diff(np.append(starts, len(sorted_keys)))
