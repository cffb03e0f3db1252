"""Line dedup: two Bloom filters find suspected repeats, an exact count settles them.

Every task marks its lines in a filter of lines seen once and moves those that it meets again to a filter of lines
seen twice. Filters of tasks merge without loss (what two tasks have both seen once has been seen twice), so the
merged second filter holds every line of two documents, and a few others. Only lines that it suspects are shuffled;
their documents are counted exactly, by text, and the largest id of each frequent line is chosen.

A filter has a bounded number of bits; when it fills, more lines are shuffled and the result stays the same.

Nulls and empty texts are one empty line. Rows with one doc_id are one document; a null doc_id is a document below all
others. Ties cannot occur, as the largest id is unique. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketlake.llm.common import blocks, cut_lineage

MIN_CHARS, MIN_DOCS = 20, 3
BLANKS = b" \t\n\v\f\r"
#: A filter's bits: 16 for each of ten lines a document, within these powers of two (the larger: 32 MB).
LEAST_BITS, MOST_BITS, PROBES = 20, 28, 4
CHUNK = 1 << 16  # bytes of a filter that merge as one row
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def keys_of(text: str, min_chars: int) -> list[bytes | None]:
    """The key of each line, None for lines that are too short to count."""
    found = []
    for line in text.encode().translate(_LOWER).split(b"\n"):
        key = line.strip(BLANKS)
        long_enough = len(key) >= min_chars and (key.isascii() or len(key.decode()) >= min_chars)
        found.append(key if long_enough else None)
    return found


def _places(hashes: np.ndarray, bits: int) -> np.ndarray:
    """PROBES bit places of each hash, one row per probe."""
    odd = (hashes >> np.uint64(32)) | np.uint64(1)
    return np.stack([(hashes + np.uint64(k) * odd * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits) for k in range(PROBES)])


class Filters:
    """Lines seen once and lines seen twice, as arrays of bits."""

    def __init__(self, bits: int):
        self.bits = bits
        self.once = np.zeros(1 << (bits - 3), np.uint8)
        self.twice = np.zeros(1 << (bits - 3), np.uint8)

    @staticmethod
    def holds(array: np.ndarray, places: np.ndarray) -> np.ndarray:
        return ((array[places >> 3] >> (places & 7).astype(np.uint8)) & 1).astype(bool).all(axis=0)

    @staticmethod
    def mark(array: np.ndarray, places: np.ndarray) -> None:
        flat = places.ravel()
        np.bitwise_or.at(array, flat >> 3, np.left_shift(1, flat & 7).astype(np.uint8))

    def see(self, hashes: np.ndarray) -> None:
        """Take the hashes of some documents; each comes once for a document that holds it."""
        distinct, times = np.unique(hashes, return_counts=True)
        places = _places(distinct, self.bits).astype(np.int64)
        again = (times > 1) | self.holds(self.once, places)
        self.mark(self.twice, places[:, again])
        self.mark(self.once, places)


def _filter_bits(docs: DataFrame) -> int:
    return int(np.clip(int(docs.count() * 160).bit_length(), LEAST_BITS, MOST_BITS))


def suspected(docs: DataFrame, min_chars: int) -> np.ndarray:
    """The merged filter of lines seen twice. Its size is bounded, so the driver may hold and broadcast it."""
    bits = _filter_bits(docs)
    names = ["chunk", "once", "twice"]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Filters(bits)
        for part in blocks(batches):
            hashes = [
                xxhash.xxh3_64_intdigest(key)
                for text in part.column("text").to_pylist()
                for key in set(keys_of(text, min_chars))
                if key is not None
            ]
            own.see(np.array(hashes, np.uint64))
        for at in range(0, len(own.once), CHUNK):
            once, twice = own.once[at : at + CHUNK], own.twice[at : at + CHUNK]
            if once.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([at // CHUNK], pa.int32()), pa.array([once.tobytes()]), pa.array([twice.tobytes()])], names=names
                )

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by chunk: hold one chunk at a time."""

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([chunk], pa.int32()), pa.array([once.tobytes()]), pa.array([twice.tobytes()])], names=names
            )

        chunk = None
        for batch in batches:
            for k, a, b in zip(*(batch.column(n) for n in names), strict=True):
                first, second = (np.frombuffer(x.as_buffer(), np.uint8) for x in (a, b))
                if chunk != k.as_py():
                    if chunk is not None:
                        yield out()
                    chunk, once, twice = k.as_py(), first.copy(), second.copy()
                else:
                    twice |= second | (once & first)
                    once |= first
        if chunk is not None:
            yield out()

    shape = "chunk int, once binary, twice binary"
    built = docs.select(F.coalesce("text", F.lit("")).alias("text")).mapInArrow(build, shape)
    merged = built.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(merge, shape)
    whole = np.zeros(1 << (bits - 3), np.uint8)
    for row in merged.select("chunk", "twice").toLocalIterator():
        whole[row.chunk * CHUNK : row.chunk * CHUNK + len(row.twice)] = np.frombuffer(row.twice, np.uint8)
    return whole


def drop_repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """Drop lines whose key is long enough and found in `min_docs` documents, except in the largest doc_id holding it.

    Returns row (the other columns of the document), doc_id, text (the lines that stay; null stays null), n_lines and
    n_dropped. The text itself is shuffled once.
    """
    spark = docs.sparkSession
    others = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"])
    source = docs.select(others.alias("row"), F.col("doc_id"), F.col("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    twice = suspected(docs, min_chars)
    bits = int(len(twice) * 8).bit_length() - 1
    shared = spark.sparkContext.broadcast(twice)

    def suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in blocks(batches):
            at, keys = [], []
            for k, text in enumerate(part.column("text").fill_null("").to_pylist()):
                own = {key for key in keys_of(text, min_chars) if key is not None}
                keys += own
                at += [k] * len(own)
            places = _places(np.array([xxhash.xxh3_64_intdigest(k) for k in keys], np.uint64), bits).astype(np.int64)
            chosen = np.flatnonzero(Filters.holds(shared.value, places))
            ids = part.column("doc_id").take(pa.array([at[i] for i in chosen], pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array([keys[i] for i in chosen], pa.binary()), ids], names=["key", "doc_id"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in blocks(batches):
            texts, lines, dropped = part.column("text").to_pylist(), [], []
            for k, (text, losing) in enumerate(zip(texts, part.column("losing").to_pylist(), strict=True)):
                lines.append((text or "").count("\n") + 1)
                dropped.append(0)
                if losing and text:
                    gone = set(losing)
                    kept = [x for x, key in zip(text.split("\n"), keys_of(text, min_chars), strict=True) if key not in gone]
                    texts[k], dropped[k] = "\n".join(kept), lines[k] - len(kept)
            yield pa.RecordBatch.from_arrays(
                [part.column("row"), part.column("doc_id"), pa.array(texts, pa.string()), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())],
                names=["row", "doc_id", "text", "n_lines", "n_dropped"],
            )

    pairs = source.select("doc_id", "text").mapInArrow(suspects, f"key binary, doc_id {kind}")
    held = pairs.groupBy("key", "doc_id").agg(F.lit(1).alias("one"))
    frequent = held.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("keeper")).where(F.col("n") >= min_docs)
    frequent = cut_lineage(frequent)  # written, so that the join shuffles both sides and Spark can split a hot line
    losing = (
        pairs.join(frequent, "key").where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
        .groupBy("doc_id").agg(F.collect_set("key").alias("losing")).withColumnRenamed("doc_id", "of")
    )
    joined = source.join(losing, F.col("doc_id").eqNullSafe(F.col("of")), "left").select("row", "doc_id", "text", "losing")
    out = source.select("row").schema["row"].dataType.simpleString()
    return joined.mapInArrow(cut, f"row {out}, doc_id {kind}, text string, n_lines bigint, n_dropped bigint")
