"""Substring dedup on words: relative Lempel-Ziv parsing.

The contexts of a shard are one another's reference blocks, indexed by their sorted suffixes. Every context is parsed
greedily from the left: a factor is the longest run of words from the cursor that starts elsewhere in the references, and
the cursor jumps behind it. A factor of at least the minimum gives a duplicate span; windows that cross the end of a
factor are looked up one by one, as the next factor starts too late for them. (Shards: see `anchors`.)

Null and empty texts have no words, texts of fewer words than a window lose none. Matches end with their document. Rows
that repeat are occurrences like any other. Words match by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ticketlake.llm.anchors import NOT_BLANK, Windows, covered, repeated_windows, with_spots
from ticketlake.llm.common import blocks, raw, segments, words_of
from ticketlake.llm.suffix import suffix_order

MIN_WORDS, GRAM = 35, 12


class References:
    """Sorted suffixes of some contexts; `longest` gives the length of the longest match elsewhere, for any places."""

    def __init__(self, units: np.ndarray, at: np.ndarray):
        _, numbers = np.unique(units, return_inverse=True)
        self.suffixes, self.line = suffix_order(numbers, at)
        self.rank = np.empty(len(self.line), np.int64)
        self.rank[self.suffixes] = np.arange(len(self.line))
        self.known = np.full(len(self.line) + 1, -1, np.int64)  # common words with the suffix before, where looked up

    def _common(self, ranks: np.ndarray) -> np.ndarray:
        new = np.unique(ranks[(ranks > 0) & (ranks < len(self.line))])
        new = new[self.known[new] < 0]
        a, b = self.suffixes[new - 1].copy(), self.suffixes[new].copy()
        length, alive = np.zeros(len(new), np.int64), np.arange(len(new))
        while len(alive):
            same = (self.line[a[alive]] == self.line[b[alive]]) & (self.line[a[alive]] > 0)
            alive = alive[same]
            length[alive] += 1
            a[alive] += 1
            b[alive] += 1
        self.known[new] = length
        return np.maximum(self.known[ranks], 0)

    def longest(self, places: np.ndarray) -> np.ndarray:
        ranks = self.rank[places]
        return np.maximum(self._common(ranks), self._common(ranks + 1))


def resolve(units: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Units of some texts where `size` units start that start elsewhere too, by greedy factors."""
    references = References(units, at)
    texts = np.arange(len(at) - 1)
    cursor, end = at[:-1] + texts, at[1:] + texts  # in the line, which has an end after each text
    marked = np.zeros(len(references.line), bool)
    while len(cursor):
        alive = cursor + size <= end
        cursor, end = cursor[alive], end[alive]
        length = references.longest(cursor)
        inside = np.maximum(length - size + 1, 0)  # windows within the factor
        marked[segments(cursor, inside)] = True
        # windows from there on to the factor's end cross it
        crossing = segments(cursor + inside, np.minimum(cursor + np.maximum(length, 1), end - size + 1) - cursor - inside)
        marked[crossing[references.longest(crossing) >= size]] = True
        cursor = cursor + np.maximum(length, 1)
    return marked[references.line > 0]


def drop_repeated_words(docs: DataFrame, size: int = MIN_WORDS, gram: int = GRAM) -> DataFrame:
    """doc_id, kept (the words that stay, joined by one blank), n_words and n_removed of each text."""
    kind = Windows(words=True, size=size, gram=min(gram, size))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in blocks(batches):
            data, at = raw(part.column("text"))
            starts, ends, first = words_of(data, at, NOT_BLANK)
            marks = [covered(spots, int(n), size) for spots, n in zip(part.column("spots").to_pylist(), np.diff(first), strict=True)]
            stay = ~np.concatenate(marks) if marks else np.zeros(0, bool)
            # copy each word that stays and a blank after it, then drop the last blank of each text
            lengths = (ends - starts + 1)[stay]
            source = segments(starts[stay], lengths)
            out = np.append(data, np.uint8(32))[source]
            out[np.cumsum(lengths) - 1] = 32
            stop = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], np.cumsum(stay)])[first]]
            kept = [out[a : max(a, b - 1)].tobytes().decode() for a, b in zip(stop[:-1].tolist(), stop[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(kept, pa.string()), pa.array(np.diff(first), pa.int64()), pa.array([int(m.sum()) for m in marks], pa.int64())],
                names=["doc_id", "kept", "n_words", "n_removed"],
            )

    joined = with_spots(docs, repeated_windows(docs, kind, resolve))
    key = joined.schema["doc_id"].dataType.simpleString()
    return joined.mapInArrow(cut, f"doc_id {key}, kept string, n_words bigint, n_removed bigint")
