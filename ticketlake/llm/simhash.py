"""SimHash near-duplicates with a pigeonring filter.

A fingerprint is split into five segments on a ring. If two differ in at most four bits, some segment starts a chain
whose first l segments differ in at most l * 4 / 5 bits, for every l: none in the first, one in the first two, two in
the first three, three in the first four. Of two segments that differ in one bit at most, one half is equal:
fingerprints therefore meet where a segment and one half of the next are equal, ten places each; the chains are
checked before the full distance.

Equal fingerprints are folded first. A meeting place with many members is cut into tiles that meet pairwise in separate
tasks; a task returns a spanning forest of its links, never all pairs, so a large group of near copies costs rows in
proportion to its size. Components are then found by rounds of joins.

Nulls and empty texts have no words and the fingerprint zero, linked like any other. Rows with a null doc_id are
fingerprinted and take part, and are never a component's id unless it has no other. Repeated rows get equal results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketlake.llm.common import blocks, cut_lineage, narrow
from ticketlake.llm.components import components

SHINGLE, SEED, DISTANCE = 4, 42, 4
#: Widths of the segments, from the highest bit on.
WIDTHS = (13, 13, 13, 13, 12)
#: Members of a meeting place that one task compares; more are cut into tiles of this size.
TILE = 1024
_LOWER = bytes(b + 32 if 65 <= b <= 90 else 32 if b in (9, 10, 11, 12, 13) else b for b in range(256))
_SHIFTS = tuple(64 - sum(WIDTHS[: k + 1]) for k in range(5))


def fingerprint(text: str) -> int:
    words = [w for w in text.encode().translate(_LOWER).split(b" ") if w]
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) < SHINGLE:
        shingles = [line]
    else:
        lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
        ends = np.cumsum(lengths)
        starts = (ends - lengths)[: len(words) - SHINGLE + 1].tolist()
        shingles = [line[a:b] for a, b in zip(starts, (ends[SHINGLE - 1 :] - 1).tolist(), strict=True)]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter([digest(s, SEED) for s in shingles], np.uint64, len(shingles))
    counts = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 4096):
        part = hashes[k : k + 4096].astype(">u8")
        counts += np.unpackbits(part.view(np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    bits = np.packbits(counts * 2 > len(hashes))
    return int.from_bytes(bits.tobytes(), "big")


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fp (the 64 bits as a signed number) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in blocks(batches):
            found = np.array([fingerprint(t) for t in part.column("text").to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(found)], names=["doc_id", "fp"])

    source = narrow(docs)
    return source.mapInArrow(run, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, fp bigint")


def _segment(fp: np.ndarray, k: int) -> np.ndarray:
    return (fp >> np.uint64(_SHIFTS[k % 5])) & np.uint64((1 << WIDTHS[k % 5]) - 1)


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """place, fp: every fingerprint at ten places, a segment with either half of the next."""
    for batch in batches:
        for start in range(0, batch.num_rows, 65536):
            fp = batch.column("fp").slice(start, 65536).to_numpy(zero_copy_only=False).view(np.uint64)
            places = []
            for k in range(5):
                second = _segment(fp, k + 1)
                for half, part in enumerate((second >> np.uint64(6), second & np.uint64(63))):
                    places.append((np.uint64(2 * k + half) << np.uint64(20)) | (_segment(fp, k) << np.uint64(7)) | part)
            columns = [pa.array(np.concatenate(places).view(np.int64)), pa.array(np.tile(fp, len(places)).view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=["place", "fp"])


def _near(differing: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Whether the chain from segment `start` keeps to its shares of the distance, and the whole to the distance."""
    near, total = np.ones(len(differing), bool), np.zeros(len(differing), np.int64)
    shifts, masks = np.array(_SHIFTS, np.uint64), np.array([(1 << w) - 1 for w in WIDTHS], np.uint64)
    for length in range(1, 5):
        k = (start + length - 1) % 5
        total += np.bitwise_count((differing >> shifts[k]) & masks[k])
        near &= total * 5 <= length * DISTANCE
    near[near] = np.bitwise_count(differing[near]) <= DISTANCE
    return near


def _forest(fp: np.ndarray, side: np.ndarray, start: int) -> list[tuple[int, int]]:
    """Links that connect what all links of a group connect: between its two sides, or within if it has one."""
    parent = list(range(len(fp)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    links, both = [], side.any() and not side.all()
    rows = np.flatnonzero(side) if both else np.arange(len(fp))
    others = np.flatnonzero(~side) if both else rows
    for n, r in enumerate(rows):
        against = others if both else others[n + 1 :]
        for c in against[_near(fp[against] ^ fp[r], np.full(len(against), start))].tolist():
            a, b = root(int(r)), root(c)
            if a != b:
                parent[max(a, b)] = min(a, b)
                links.append((r, c))
    return links


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by group (place, i, j), at most two tiles each; a group that a batch cuts waits for the next."""
    names = ["place", "i", "j", "fp", "side"]
    held = None

    def settle(place: np.ndarray, i: np.ndarray, j: np.ndarray, fp: np.ndarray, side: np.ndarray) -> pa.RecordBatch:
        fp, new = fp.view(np.uint64), np.ones(len(place), bool)
        new[1:] = (place[1:] != place[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
        group, begins = np.cumsum(new) - 1, np.append(np.flatnonzero(new), len(place))
        sizes, cross = np.diff(begins), i != j
        left, right = [], []
        small = np.flatnonzero((sizes <= 16)[group])
        for d in range(1, 16):
            first = small[small + d < len(place)]
            first = first[group[first] == group[first + d]]
            if not len(first):
                break
            first = first[~cross[first] | (side[first] != side[first + d])]
            near = _near(fp[first] ^ fp[first + d], place[first] >> 21)
            left.append(fp[first[near]])
            right.append(fp[first[near] + d])
        for g in np.flatnonzero(sizes > 16):
            own = slice(begins[g], begins[g + 1])
            if cross[begins[g]] and side[own].all() == side[own].any():
                continue  # one tile of the pair is empty
            links = _forest(fp[own], side[own], int(place[begins[g]]) >> 21)
            if links:
                at = np.array(links)
                left.append(fp[own][at[:, 0]])
                right.append(fp[own][at[:, 1]])
        columns = [np.concatenate(x).view(np.int64) if x else np.zeros(0, np.int64) for x in (left, right)]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(n).to_numpy(zero_copy_only=False) for n in names]
        if held is not None:
            columns = [np.concatenate(x) for x in zip(held, columns, strict=True)]
        same = (columns[0] == columns[0][-1]) & (columns[1] == columns[1][-1]) & (columns[2] == columns[2][-1])
        cut = int(np.argmax(same))
        held = [x[cut:] for x in columns]
        if cut:
            yield settle(*(x[:cut] for x in columns))
    if held is not None:
        yield settle(*held)


def near_links(prints: DataFrame) -> DataFrame:
    """a, b: links between distinct fingerprints of at most DISTANCE differing bits that give the same components as all."""
    met = prints.select("fp").distinct().mapInArrow(_places, "place bigint, fp bigint")
    sizes = met.groupBy("place").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    dealt = met.join(sizes, "place").withColumn("tiles", F.ceil(F.col("n") / TILE).cast("int"))
    dealt = dealt.withColumn("tile", F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int"))
    paired = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).select(
        "place", F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"), "fp", (F.col("tile") > F.col("other")).alias("side"),
    )
    ordered = paired.repartition("place", "i", "j").sortWithinPartitions("place", "i", "j")
    return ordered.mapInArrow(_compare, "a bigint, b bigint").distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fp, and component_id: the smallest doc_id reachable over links, itself included."""
    prints = cut_lineage(fingerprints(docs))
    found = components(near_links(prints)).withColumnRenamed("node", "fp")
    least = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    rooted = least.join(found, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return prints.join(rooted.join(ids, "root").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")
