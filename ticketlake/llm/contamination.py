"""Benchmark decontamination with suffix arrays of the training texts.

Each block of training texts is a shard: its words become numbers of the benchmark's vocabulary (0: a word that no item
has), the suffixes that can hold a window are sorted, and every window-long prefix of every item suffix is found by
binary search. The matches give the words that are hit, the items, and the longest verbatim match with its place.

The benchmark travels to the tasks in lots of a bounded number of words; each lot is one more pass over the rows, without
a shuffle, so a benchmark of any size takes more passes and never more memory.

Null and empty texts and items have no words. Items with fewer words than a window are one window. Rows that repeat are
judged one by one; repeated item ids count once, a null id as the empty text. Words match by 64-bit hashes. Without
items nothing is contaminated.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketlake.llm.common import apart, blocks, lower_ascii, raw, segments, together, word_hashes, words_of

WINDOW, SHARE = 13, 20
#: Words of the benchmark that one pass searches.
LOT_WORDS = 1_000_000
_SHARD_BYTES = 3_000_000
INSIDE = np.array([48 <= b <= 57 or 97 <= b <= 122 or b >= 128 for b in range(256)])


@dataclass
class Items:
    """Some items: sorted word hashes, and for each window length the windows (vocabulary numbers) and their item and place."""

    names: list[str]
    vocabulary: np.ndarray
    windows: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]


def index_items(names: list[str], texts: list[str]) -> Items:
    data, at = raw(pa.array(texts, pa.large_string()))
    low = lower_ascii(data)
    starts, ends, first = words_of(low, at, INSIDE)
    vocabulary, numbers = np.unique(word_hashes(low, starts, ends), return_inverse=True)
    lengths = np.diff(first)
    windows = {}
    for size in np.unique(np.minimum(lengths[lengths > 0], WINDOW)):
        items = np.flatnonzero((lengths >= WINDOW) if size == WINDOW else (lengths == size))
        counts = lengths[items] - size + 1
        begins = segments(first[items], counts)
        of = np.repeat(items, counts)
        windows[int(size)] = (numbers[begins[:, None] + np.arange(size)] + 1, of, begins - first[of])
    return Items(names, vocabulary, windows)


def _suffixes(line: np.ndarray, least: int) -> np.ndarray:
    """Places of `line` where at least `least` known words begin, sorted by the WINDOW words from there."""
    unknown = np.flatnonzero(line == 0)  # the line ends with one
    places = np.arange(len(line))
    room = unknown[np.searchsorted(unknown, places)] - places
    chosen = np.flatnonzero(room >= least)
    rank, width = line.astype(np.int64), 1
    while width < WINDOW:  # ranks of twice the length from pairs of ranks
        following = np.zeros(len(line), np.int64)
        following[: max(len(line) - width, 0)] = rank[width:]
        some = np.flatnonzero(rank)
        _, found = np.unique(rank[some] * (following.max() + 1) + following[some], return_inverse=True)
        rank = np.zeros(len(line), np.int64)
        rank[some] = found + 1
        width *= 2
    return chosen[np.argsort(rank[chosen], kind="stable")]


def _bound(line: np.ndarray, order: np.ndarray, windows: np.ndarray, upper: bool) -> np.ndarray:
    """Binary search of all windows at once: the first suffix not below (or, with `upper`, above) each window."""
    low, high = np.zeros(len(windows), np.int64), np.full(len(windows), len(order), np.int64)
    steps, size = np.arange(windows.shape[1]), len(line) - 1
    while (open_ := np.flatnonzero(low < high)).size:
        middle = (low[open_] + high[open_]) // 2
        words = line[np.minimum(order[middle][:, None] + steps, size)]
        differ = words != windows[open_]
        first = np.argmax(differ, axis=1)
        rows = np.arange(len(open_))
        ours, theirs = words[rows, first], windows[open_][rows, first]
        below = (ours < theirs) | (upper & (ours == theirs))
        low[open_[below]] = middle[below] + 1
        high[open_[~below]] = middle[~below]
    return low


def matches(data: np.ndarray, at: np.ndarray, items: Items) -> tuple[np.ndarray, np.ndarray, tuple[np.ndarray, ...]]:
    """Number of words before each text; and of every match: its word (over all texts), window length, item and place in it."""
    low = lower_ascii(data)
    starts, ends, first = words_of(low, at, INSIDE)
    hashes = word_hashes(low, starts, ends)
    where = np.minimum(np.searchsorted(items.vocabulary, hashes), max(len(items.vocabulary) - 1, 0))
    known = items.vocabulary[where] == hashes if len(items.vocabulary) else np.zeros(len(hashes), bool)
    text = np.repeat(np.arange(len(at) - 1), np.diff(first))
    line = np.zeros(len(hashes) + len(at), np.int64)  # an unknown word after each text
    line[np.arange(len(hashes)) + text] = np.where(known, where + 1, 0)
    word = np.full(len(line), -1, np.int64)
    word[np.arange(len(hashes)) + text] = np.arange(len(hashes))
    parts = []
    if items.windows:
        order = _suffixes(line, min(items.windows))
        for size, (windows, of, place) in items.windows.items():
            lower = _bound(line, order, windows, False)
            counts = _bound(line, order, windows, True) - lower
            which = np.repeat(np.arange(len(windows)), counts)
            parts.append((word[order[segments(lower, counts)]], np.full(len(which), size), of[which], place[which]))
    found = tuple(np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.zeros(0, np.int64),) * 4
    return first, starts, found


def _longest(word: np.ndarray, size: np.ndarray, item: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First word and length of every maximal verbatim match: windows of one item that follow one another in step."""
    order = np.lexsort((word, word - place, item))
    w, i, d = word[order], item[order], (word - place)[order]
    new = np.ones(len(w), bool)
    new[1:] = (w[1:] != w[:-1] + 1) | (i[1:] != i[:-1]) | (d[1:] != d[:-1])
    begins = np.flatnonzero(new)
    return w[begins], np.diff(np.append(begins, len(w))) + size[order][begins] - 1


def find_matches(docs: DataFrame, benchmark: DataFrame, lot_words: int = LOT_WORDS) -> DataFrame:
    """row (all columns but the text), doc_id, text, n_words, n_hit, items (sorted texts of item ids), longest, longest_at (word), contaminated."""
    spark = docs.sparkSession
    words = F.coalesce(F.length("text"), F.lit(0)) / 2 + 1  # an upper bound of an item's words
    named = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("name"), F.coalesce("text", F.lit("")).alias("text"))
    total = named.agg(F.sum(words)).first()[0] or 0
    lots = max(1, int(np.ceil(total / lot_words)))
    named = named.withColumn("lot", F.pmod(F.xxhash64("name", "text"), F.lit(lots)))

    source = docs.select(
        apart(docs), F.col("doc_id"), F.col("text"), F.lit(0).cast("bigint").alias("n_words"),
        F.array().cast("array<bigint>").alias("hits"), F.array().cast("array<string>").alias("items"),
        F.lit(0).cast("bigint").alias("longest"), F.lit(-1).cast("bigint").alias("longest_at"),
    )
    shape = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in source.schema.fields)
    for lot in range(lots):
        rows = named.where(F.col("lot") == lot).collect()  # about `lot_words` words
        shared = spark.sparkContext.broadcast(index_items([r.name for r in rows], [r.text for r in rows]))
        source = source.mapInArrow(_pass(shared), shape)
    # hits are ranges of words, start and end in turn, in order and apart
    spread = F.aggregate("hits", F.lit(0).cast("bigint"), lambda total, x: x - total)
    out = source.withColumn("n_hit", spread).withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * SHARE >= F.col("n_words")))
    return out.select("row", "doc_id", "text", "n_words", "n_hit", F.array_sort("items").alias("items"), "longest", "longest_at", "contaminated")


def _pass(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items: Items = shared.value
        for part in blocks(batches, limit=_SHARD_BYTES):
            data, at = raw(part.column("text"))
            first, _, (word, size, item, place) = matches(data, at, items)
            count = int(first[-1])
            cover = np.zeros(count + 1, np.int64)
            np.add.at(cover, word, 1)
            np.add.at(cover, word + size, -1)
            of = np.searchsorted(first, word, "right") - 1
            begin, length = _longest(word, size, item, place) if len(word) else (word, word)
            best = {}
            for t, b, n in zip((np.searchsorted(first, begin, "right") - 1).tolist(), begin.tolist(), length.tolist(), strict=True):
                if n > best.get(t, (0, 0))[0]:
                    best[t] = (n, b - int(first[t]))
            met: dict[int, set[str]] = {}
            for t, i in set(zip(of.tolist(), item.tolist(), strict=True)):
                met.setdefault(t, set()).add(items.names[i])
            hit = np.cumsum(cover)[:-1] > 0
            hits, all_items, longest, longest_at = (part.column(n).to_pylist() for n in ("hits", "items", "longest", "longest_at"))
            for t, names in met.items():
                own = hit[first[t] : first[t + 1]].copy()
                for a, b in zip(hits[t][::2], hits[t][1::2], strict=True):
                    own[a:b] = True
                edges = np.flatnonzero(np.diff(np.concatenate([[0], own.view(np.int8), [0]])))
                hits[t], all_items[t] = edges.tolist(), sorted(names.union(all_items[t]))
                if best[t][0] > longest[t]:
                    longest[t], longest_at[t] = best[t]
            yield pa.RecordBatch.from_arrays(
                [part.column("row"), part.column("doc_id"), part.column("text"), pa.array(np.diff(first), pa.int64()),
                 pa.array(hits, pa.list_(pa.int64())), pa.array(all_items, pa.list_(pa.string())), pa.array(longest, pa.int64()), pa.array(longest_at, pa.int64())],
                names=part.schema.names,
            )

    return run


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with their columns."""
    return find_matches(docs, benchmark).where(~F.col("contaminated")).select(*together(docs))
