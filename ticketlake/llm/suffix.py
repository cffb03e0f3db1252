"""Substring dedup on bytes: common prefixes of a shard's suffixes by backward extension on its Burrows-Wheeler transform.

A shard's lines, each closed by an end of its own, are sorted by suffix; the transform holds the byte before each. An
interval of the order is all suffixes with one prefix. Breadth first, intervals of prefix length l are extended to the
left by every byte before them: the new interval has prefixes of length l + 1, and where its upper bound is not yet known
to divide suffixes, their common prefix is l + 1 long. Values come in increasing order, and the search stops at the
minimum length: bounds still unknown then part suffixes that share at least that much. (Shards: see `anchors`.)

Null and empty texts, and texts shorter than the minimum, lose nothing. Matches end with their document. Rows that repeat
are occurrences like any other, so both lose their bytes. What stays need not be valid UTF-8, so it is binary.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ticketlake.llm.anchors import Windows, covered, repeated_windows, with_spots
from ticketlake.llm.common import blocks, raw, segments

MIN_BYTES, GRAM = 200, 64


def suffix_order(units: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array and line (units + 1, with an end after each text: 0, but ends differ) of some texts."""
    texts = len(at) - 1
    line = np.zeros(len(units) + texts, np.int64)
    line[np.arange(len(units)) + np.repeat(np.arange(texts), np.diff(at))] = units.astype(np.int64) + 1
    size = len(line)
    # the first symbols of a suffix up to its end, packed; suffixes that end among them differ, in the order of the texts
    bits = max(1, int(line.max(initial=0)).bit_length())
    width = min(max(1, 62 // bits), 16)
    key, ended = line.copy(), line == 0
    for k in range(1, min(width, size)):
        key <<= bits
        shifted = np.where(ended[: size - k], 0, line[k:])
        key[: size - k] |= shifted
        ended[: size - k] |= line[k:] == 0
    order = np.argsort(key, kind="stable")
    sorted_key = key[order]
    new = np.ones(size, bool)
    new[1:] = (sorted_key[1:] != sorted_key[:-1]) | ended[order[1:]]
    first = np.maximum.accumulate(np.where(new, np.arange(size), 0))
    rank = np.empty(size, np.int64)
    rank[order] = first  # how many suffixes are less by this prefix
    open_ = order[~(new & np.append(new[1:], True))]
    while len(open_):  # twice the prefix from two ranks; suffixes whose rank is theirs alone are settled
        pair = rank[open_] * (size + 1) + rank[np.minimum(open_ + width, size - 1)] + 1
        order = np.argsort(pair)
        open_, pair = open_[order], pair[order]
        old = pair // (size + 1)
        new = np.ones(len(open_), bool)
        new[1:] = pair[1:] != pair[:-1]
        places = np.arange(len(open_))
        begin = np.maximum.accumulate(np.where(np.append(True, old[1:] != old[:-1]), places, 0))
        rank[open_] = old + np.maximum.accumulate(np.where(new, places, 0)) - begin
        open_ = open_[~(new & np.append(new[1:], True))]
        width *= 2
    suffixes = np.empty(size, np.int64)
    suffixes[rank] = np.arange(size)
    return suffixes, line


#: (interval, symbol) pairs up to which a table, not a sort, finds their first and last places.
_TABLE = 1 << 22


def _extended(low: np.ndarray, high: np.ndarray, before: np.ndarray, back: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Each interval extended by each symbol before its suffixes: from where its first such suffix maps to its last."""
    single = high - low == 1
    one = low[single]
    one = one[before[one] > 0]
    low, high = low[~single], high[~single]
    sizes = high - low
    places = segments(low, sizes)
    symbols = before[places]
    pairs = np.repeat(np.arange(len(low)), sizes) * most + symbols
    pairs, places = pairs[symbols > 0], places[symbols > 0]
    if len(low) * most <= _TABLE:
        first, last = np.full(len(low) * most, -1), np.empty(len(low) * most, np.int64)
        first[pairs[::-1]] = places[::-1]
        last[pairs] = places
        met = np.flatnonzero(first >= 0)
        first, last = first[met], last[met]
    else:
        order = np.argsort(pairs, kind="stable")
        new = np.append(True, pairs[order[1:]] != pairs[order[:-1]]) if len(order) else np.zeros(0, bool)
        first, last = places[order[new]], places[order[np.append(new[1:], True)[: len(new)]]]
    return np.concatenate([back[one], back[first]]), np.concatenate([back[one], back[last]]) + 1


def long_prefixes(suffixes: np.ndarray, line: np.ndarray, least: int) -> np.ndarray:
    """Whether each suffix of the order shares `least` symbols or more with the one before it."""
    size = len(line)
    before = line[suffixes - 1]  # the transform; the line starts after an end, as it closes with one
    counts = np.bincount(line)
    begins = np.cumsum(counts) - counts
    back = np.empty(size, np.int64)  # the place of each suffix with the symbol before it
    back[np.argsort(before, kind="stable")] = np.arange(size)
    unknown = np.ones(size + 1, bool)
    symbols = np.flatnonzero(counts)
    ends = np.arange(counts[0])  # each an interval of its own, as ends differ
    low = np.concatenate([ends, begins[symbols[symbols > 0]]])
    high = np.concatenate([ends + 1, begins[symbols[symbols > 0]] + counts[symbols[symbols > 0]]])
    unknown[low] = False
    unknown[high] = False
    for _ in range(1, least):
        if not len(low):
            break
        low, high = _extended(low, high, before, back, len(counts))
        fresh = unknown[high]
        low, high = low[fresh], high[fresh]
        unknown[high] = False
    return unknown[:size]


def resolve(units: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Units of some texts where `size` units start that start elsewhere too."""
    suffixes, line = suffix_order(units, at)
    shares = long_prefixes(suffixes, line, size)
    marked = np.zeros(len(line), bool)
    where = np.flatnonzero(shares)
    marked[suffixes[where]] = True
    marked[suffixes[where - 1]] = True
    return marked[line > 0]


def drop_repeated_bytes(docs: DataFrame, size: int = MIN_BYTES, gram: int = GRAM) -> DataFrame:
    """doc_id, kept (binary), n_bytes, n_removed and removed (start and end of every maximal run) of each text."""
    kind = Windows(words=False, size=size, gram=min(gram, size))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in blocks(batches):
            data, at = raw(part.column("text"))
            kept, counts, removed = [], [], []
            for k, spots in enumerate(part.column("spots").to_pylist()):
                own = data[at[k] : at[k + 1]]
                cover = covered(spots, len(own), size)
                kept.append(own[~cover].tobytes())
                counts.append(int(cover.sum()))
                edges = np.flatnonzero(np.diff(np.concatenate([[0], cover.view(np.int8), [0]])))
                removed.append([{"start": a, "end": b} for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)])
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(kept, pa.binary()), pa.array(np.diff(at), pa.int64()), pa.array(counts, pa.int64()),
                 pa.array(removed, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                names=["doc_id", "kept", "n_bytes", "n_removed", "removed"],
            )

    joined = with_spots(docs, repeated_windows(docs, kind, resolve))
    key = joined.schema["doc_id"].dataType.simpleString()
    return joined.mapInArrow(cut, f"doc_id {key}, kept binary, n_bytes bigint, n_removed bigint, removed array<struct<start:bigint,end:bigint>>")
