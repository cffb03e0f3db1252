"""Context-triggered piecewise hashing.

A hash of the last seven bytes ends a piece where it is at the top of its block size, so an edit moves the nearby ends
only. A fingerprint is `size:a:b`: one character for every piece at the block size, and at twice the size. Two
fingerprints compare at block sizes that they share, by insertions and deletions between their characters.

Null and empty texts have the fingerprint `3::`; two of them are alike. Equal texts have equal fingerprints. The next
document is the one that follows by doc_id (nulls first, equal ids in the order of their texts), after the last the
first; a single document is its own next one. Empty tables give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketlake.llm.common import cut_lineage, mixed, prefix_sums, range_hashes

LEAST_SIZE, LENGTH, REACH = 3, 64, 7
#: Characters in a row that two signatures must share to be alike at all.
COMMON = 4
_LETTERS = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)


def fingerprint(text: str) -> str:
    data = np.frombuffer(text.encode(), np.uint8)
    if not len(data):
        return f"{LEAST_SIZE}::"
    sums = prefix_sums(mixed(data.astype(np.uint64) + np.uint64(1)))
    ends = np.arange(1, len(data) + 1)
    rolling = range_hashes(sums, np.maximum(ends - REACH, 0), ends)
    size = LEAST_SIZE
    while size * LENGTH < len(data):
        size *= 2
    one = _signature(sums, rolling, size)
    while size > LEAST_SIZE and len(one) < LENGTH // 2:
        size //= 2
        one = _signature(sums, rolling, size)
    return f"{size}:{one}:{_signature(sums, rolling, size * 2)}"


def _signature(sums: np.ndarray, rolling: np.ndarray, size: int) -> str:
    """A character for each piece; the last piece takes what is left once there are LENGTH of them."""
    stops = np.flatnonzero(rolling % np.uint64(size) == np.uint64(size - 1))[: LENGTH - 1] + 1
    if not len(stops) or stops[-1] < len(rolling):
        stops = np.append(stops, len(rolling))
    starts = np.concatenate([[0], stops[:-1]])
    return _LETTERS[(range_hashes(sums, starts, stops) >> np.uint64(58)).astype(np.int64)].tobytes().decode()


def edit_distance(a: str, b: str) -> int:
    """Insertions and deletions that turn one into the other: lengths less twice the longest common subsequence."""
    where: dict[str, int] = {}
    for k, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << k
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        met = row & where.get(c, 0)
        row = ((row + met) | (row - met)) & full
    return len(a) + len(b) - 2 * (len(a) - row.bit_count())


def _alike(a: str, b: str) -> float:
    if a == b:
        return 1.0
    common = min(COMMON, len(a), len(b))
    grams = {a[k : k + common] for k in range(len(a) - common + 1)}
    if not common or not any(b[k : k + common] in grams for k in range(len(b) - common + 1)):
        return 0.0
    return 1.0 - edit_distance(a, b) / (len(a) + len(b))


def likeness(x: str, y: str) -> float:
    """0 to 1; signatures meet at equal block sizes, a size and its double too."""
    if x == y:
        return 1.0
    (n, a, a2), (m, b, b2) = ((int(s[0]), s[1], s[2]) for s in (x.split(":"), y.split(":")))
    if n == m:
        return max(_alike(a, b), _alike(a2, b2))
    if n == 2 * m:
        return _alike(a, b2)
    return _alike(a2, b) if m == 2 * n else 0.0


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by the first as many (or all) of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_OUT = "n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_NAMES = [x.split()[0] for x in _OUT.split(", ")]


def _row(text: str, own: str, following: str, following_print: str) -> tuple:
    changed = edited(text, following)
    other = fingerprint(changed)
    return len(text), hashlib.sha256(changed.encode()).hexdigest(), own, other, likeness(own, other), likeness(own, following_print)


def fingerprints(docs: DataFrame, columns: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """`columns`, n_chars and fingerprint of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(len(columns)).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array([len(t) for t in texts], pa.int64()), pa.array([fingerprint(t) for t in texts], pa.string())],
                names=[*columns, "n_chars", "fingerprint"],
            )

    source = docs.select(*columns, F.coalesce("text", F.lit("")).alias("text"))
    head = ", ".join(f"{c} {source.schema[c].dataType.simpleString()}" for c in columns)
    return source.mapInArrow(run, f"{head}, n_chars bigint, fingerprint string")


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id and the measures of every text against its edited form and the next document.

    One shuffle by range of doc_id. A task pairs the rows that follow one another in its range; of the row at each end
    of a range it passes on what the neighbouring range needs, and those few rows (two a task) meet by a join.
    """
    source = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    ordered = source.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    ordered = ordered.withColumn("part", F.spark_partition_id())
    # role 0: a finished row; 1: the last of its range, with its text; 2: the first of its range, with its text
    head = ["role", "part", "doc_id"]

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None
        for batch in batches:
            rows, done, ids = zip(*(batch.column(n).to_pylist() for n in ("part", "text")), strict=True), [], []
            for k, (part, text) in enumerate(rows):
                own = fingerprint(text)
                if before is None:
                    first = (part, text, own)
                    yield edge(2, *first, batch.column("doc_id").slice(k, 1))
                else:
                    done.append(_row(before[1], before[2], text, own))
                    ids.append(before[3])
                before = (part, text, own, batch.column("doc_id").slice(k, 1))
            if done:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([0] * len(done), pa.int32()), pa.array([before[0]] * len(done), pa.int32()), pa.concat_arrays(ids),
                     *map(pa.array, zip(*done, strict=True)), pa.nulls(len(done), pa.string())], names=[*head, *_NAMES, "text"],
                )
        if before is not None:
            yield edge(1, *before)

    def edge(role: int, part: int, text: str, own: str, key: pa.Array) -> pa.RecordBatch:
        values = [pa.array([len(text)], pa.int64()), pa.nulls(1, pa.string()), pa.array([own]), pa.nulls(1, pa.string()), pa.nulls(1, pa.float64()), pa.nulls(1, pa.float64())]
        return pa.RecordBatch.from_arrays([pa.array([role], pa.int32()), pa.array([part], pa.int32()), key, *values, pa.array([text])], names=[*head, *_NAMES, "text"])

    met = cut_lineage(ordered.mapInArrow(pair, f"role int, part int, doc_id {kind}, {_OUT}, text string"))

    def join_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [_row(*x) for x in zip(*(batch.column(n).to_pylist() for n in ("text", "fingerprint", "next_text", "next_print")), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, zip(*rows, strict=True))], names=["doc_id", *_NAMES])

    firsts, lasts = met.where("role = 2"), met.where("role = 1")
    parts = sorted(r.part for r in lasts.select("part").collect())  # one number for each range with rows
    if parts:
        follows = docs.sparkSession.createDataFrame(list(zip(parts, [*parts[1:], parts[0]], strict=True)), "part int, next_part int")
    else:
        follows = docs.sparkSession.createDataFrame([], "part int, next_part int")
    following = firsts.select(F.col("part").alias("next_part"), F.col("text").alias("next_text"), F.col("fingerprint").alias("next_print"))
    edges = lasts.select("part", "doc_id", "text", "fingerprint").join(follows, "part").join(following, "next_part")
    ends = edges.select("doc_id", "text", "fingerprint", "next_text", "next_print").mapInArrow(join_edges, f"doc_id {kind}, {_OUT}")
    return met.where("role = 0").select("doc_id", *_NAMES).union(ends)
