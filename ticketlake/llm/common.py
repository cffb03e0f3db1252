"""What the operators of this package share: column choice, bounded text blocks, byte arrays and word splitting."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketlake.session import cut_lineage

#: Bytes of text that a task works on at once; one longer text is a block of its own.
BLOCK_BYTES = 2_000_000

__all__ = ["BLOCK_BYTES", "apart", "blocks", "cut_lineage", "lower_ascii", "mixed", "narrow", "raw", "prefix_sums", "range_hashes", "segments", "table", "together", "word_hashes", "words_of"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def narrow(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Only the key and the text (null: empty), so that other columns, whatever their names, never clash."""
    return df.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))


def apart(docs: DataFrame) -> F.Column:
    """`row`: all columns but the text, which then travels once, beside it."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row")


def together(docs: DataFrame) -> list[F.Column]:
    """The columns of `docs` again, from `row` and `text`."""
    return [F.col("text") if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns]


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (one more than rows) of a column of texts without nulls, not copied."""
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def blocks(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each part holds about `limit` bytes of text or one row."""
    for batch in batches:
        at, start = raw(batch.column(text))[1], 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(at, at[start] + limit, "right")) - 1)
            yield batch.slice(start, stop - start)
            start = stop


def segments(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start+1, ... for each pair, one after the other."""
    lengths = lengths.astype(np.int64)
    ends = np.cumsum(lengths)
    if not len(ends) or not ends[-1]:
        return np.zeros(0, np.int64)
    return np.arange(ends[-1], dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)


def words_of(data: np.ndarray, at: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of concatenated texts: start, end and number of words before each text. `inside` marks word bytes of 256."""
    good = inside[data]
    first = good.copy()
    first[1:] &= ~good[:-1]
    last = good.copy()
    last[:-1] &= ~good[1:]
    edges = at[:-1][at[:-1] < at[1:]]  # a text's first byte starts a word, whatever stands before it
    first[edges] |= good[edges]
    last[edges[edges > 0] - 1] |= good[edges[edges > 0] - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, at)


_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS: dict[int, np.ndarray] = {}


def powers(count: int, base: int = _BASE) -> np.ndarray:
    """1, base, base^2, ... in 64 bits; kept by the worker for texts of usual length."""
    known = _POWERS.get(base)
    if known is None or len(known) < count:
        known = np.full(max(count, 1 << 16), base, np.uint64)
        known[0] = 1
        known = np.cumprod(known)
        if len(known) <= 8 * BLOCK_BYTES:
            _POWERS[base] = known
    return known[:count]


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one mix of 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_VALUES = mixed(np.arange(1, 257, dtype=np.uint64))


def prefix_sums(values: np.ndarray, base: int = _BASE) -> np.ndarray:
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(len(values), base), out=out[1:])
    return out


def range_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = _BASE) -> np.ndarray:
    """A hash of each range of the summed values that depends on the values alone, not on their place."""
    inverse = pow(base, -1, 1 << 64)
    return mixed((sums[ends] - sums[starts]) * powers(len(sums), inverse)[starts] + (ends - starts).astype(np.uint64))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64 bits for each word of a byte array."""
    return range_hashes(prefix_sums(_BYTE_VALUES[data]), starts, ends)
