"""Repeated windows over all texts: anchors bring equal windows together, a resolver settles each shard.

A text is a line of units (bytes or words). Every window of W units has an anchor: its gram of k units with the least
hash, the leftmost of equals. The anchor depends on the window's content alone, so equal windows have equal anchors, at
the same place inside. Windows that follow one another with one anchor form a context, and:

1. anchors are counted by hash with partial counts; those that occur once cannot hold a repeated window and go;
2. if all contexts of an anchor are equal, all their windows are repeated, whatever their number;
3. where contexts of an anchor differ, equal ones fold into one, and the distinct ones of an anchor are brought to one
   shard with their units, where the resolver of the operator finds the windows that occur twice;
4. an anchor with more distinct contexts than a shard should hold is split: a context is cut into parts of BLOCK windows,
   and parts meet by the units that all their windows share; equal parts fold, distinct ones go to shards as above;
5. parts that are still too many for a shard are cut into single windows, so equal windows alone stay together.

Contexts, anchors and windows are compared by 64-bit hashes (windows of split anchors and equal contexts of one anchor
by two of them); resolvers see the units themselves.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketlake.llm.common import _BYTE_VALUES, blocks, cut_lineage, mixed, prefix_sums, range_hashes, raw, segments, word_hashes, words_of

#: Distinct contexts of one anchor beyond which its windows are spread; units that a resolver takes at once.
MANY, SHARD_UNITS = 1_000, 400_000
#: Windows of a part of a split context.
BLOCK = 16
#: Bytes of text at once: arrays of 64 bits for each unit take some twenty times as much.
_BLOCK = 600_000
_SECOND = 0xC2B2AE3D27D4EB4F
_PLACE_BITS = np.uint64(28)
NOT_BLANK = np.array([b != 32 and not 9 <= b <= 13 for b in range(256)])


@dataclass(frozen=True)
class Windows:
    """What a window is: units, their number, and the length of its anchor."""

    words: bool
    size: int
    gram: int

    def units(self, part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        """64 bits for each unit of all texts, and the number of units before each text."""
        data, at = raw(part.column("text"))
        if not self.words:
            return _BYTE_VALUES[data], at
        starts, ends, first = words_of(data, at, NOT_BLANK)
        return word_hashes(data, starts, ends), first


def _sliding_least(keys: np.ndarray, width: int) -> np.ndarray:
    done = 1
    while done * 2 <= width:
        keys = np.minimum(keys[:-done], keys[done:])
        done *= 2
    rest = width - done
    return np.minimum(keys[: len(keys) - rest], keys[rest:]) if rest else keys


def contexts(units: np.ndarray, at: np.ndarray, kind: Windows) -> tuple[np.ndarray, ...]:
    """Of every context: anchor hash, own hash, text, first window (over all texts), number of windows."""
    none = (np.zeros(0, np.uint64), np.zeros(0, np.uint64), *(np.zeros(0, np.int64),) * 3)
    if len(units) < kind.size:
        return none
    sums = prefix_sums(units)
    begins = np.arange(len(units) - kind.gram + 1)
    grams = range_hashes(sums, begins, begins + kind.gram)
    low = (np.uint64(1) << _PLACE_BITS) - np.uint64(1)
    anchor = (_sliding_least((grams & ~low) | begins.astype(np.uint64), kind.size - kind.gram + 1) & low).astype(np.int64)
    counts = np.maximum(np.diff(at) - kind.size + 1, 0)
    windows = segments(at[:-1], counts)
    if not len(windows):
        return none
    own = anchor[windows]
    new = np.ones(len(windows), bool)
    new[1:] = (own[1:] != own[:-1]) | (windows[1:] != windows[:-1] + 1)
    first = np.flatnonzero(new)
    starts, number = windows[first], np.diff(np.append(first, len(windows)))
    second = prefix_sums(units, _SECOND)
    whole = range_hashes(second, starts, starts + number - 1 + kind.size, _SECOND)
    return grams[own[first]], whole, np.searchsorted(at, starts, "right") - 1, starts, number


def _named(docs: DataFrame) -> DataFrame:
    """doc_id, text, and 23 bits of the text that tell rows with one doc_id apart."""
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", text.alias("text"), F.shiftrightunsigned(F.xxhash64(text), 41).alias("mark"))


def _anchor_rows(docs: DataFrame, kind: Windows, places: bool) -> DataFrame:
    """h, c and, with `places`, doc_id and spot (mark, first window and number of windows less one, packed)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in blocks(batches, limit=_BLOCK):
            units, at = kind.units(part)
            h, c, text, start, number = contexts(units, at, kind)
            columns = [pa.array(h.view(np.int64)), pa.array(c.view(np.int64))]
            if places:
                mark = part.column("mark").to_numpy(zero_copy_only=False)[text]
                columns.append(part.column("doc_id").take(pa.array(text)))
                columns.append(pa.array((mark << 40) | ((start - at[text]) << 8) | (number - 1)))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    source = _named(docs)
    names = ["h", "c", "doc_id", "spot"] if places else ["h", "c"]
    key = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, "h bigint, c bigint" + (f", doc_id {key}, spot bigint" if places else ""))


def _mark(spot: F.Column) -> F.Column:
    return F.shiftright(spot, 40)


def _with_texts(docs: DataFrame, spots: DataFrame) -> DataFrame:
    """Rows of docs with the array `spots` (null: none) of their text. All uses share one shuffle of the texts."""
    few = spots.withColumnsRenamed({"doc_id": "of", "mark": "of_mark"})
    same = F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("mark") == F.col("of_mark"))
    return _named(docs).join(few, same, "left").select("doc_id", "text", "mark", "spots")


def repeated_windows(docs: DataFrame, kind: Windows, resolve: Callable[[np.ndarray, np.ndarray, int], np.ndarray]) -> DataFrame:
    """doc_id, mark, and spots: an array of (first window << 8 | number of windows less one) that occur elsewhere too.

    `resolve` takes the units of some contexts, one after the other, the number of units before each, and the window size;
    it marks the units where a window starts that starts elsewhere in them too.
    """
    seen = _anchor_rows(docs, kind, False).groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("low"), F.max("c").alias("high"))
    # written, so that the join below shuffles both sides and Spark can split the rows of a hot anchor
    often = cut_lineage(seen.where(F.col("n") > 1).select("h", (F.col("low") != F.col("high")).alias("differ")))
    rows = cut_lineage(_anchor_rows(docs, kind, True).join(often, "h"))
    same = rows.where(~F.col("differ")).select("doc_id", "spot")

    differing = rows.where("differ")
    folded = differing.groupBy("h", "c").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "spot")).alias("one"))
    folded = cut_lineage(folded)
    copied = folded.where(F.col("n") > 1).select("h", "c")
    copies = differing.join(copied, ["h", "c"]).select("doc_id", "spot")
    per_anchor = folded.groupBy("h").agg((F.count(F.lit(1)) > MANY).alias("many"))
    chosen = cut_lineage(folded.join(per_anchor, "h").select("h", "many", "one.doc_id", "one.spot", (F.col("n") == 1).alias("open")))

    fetched = _fetch(docs, chosen, kind)
    alone = _resolve(fetched.where(~F.col("many")), kind, resolve).union(_split(fetched.where("many"), kind, resolve))
    spots = same.union(copies).union(alone).select("doc_id", _mark(F.col("spot")).alias("mark"), F.col("spot").bitwiseAND((1 << 40) - 1).alias("spot"))
    return spots.groupBy("doc_id", "mark").agg(F.collect_list("spot").alias("spots"))


def _fetch(docs: DataFrame, chosen: DataFrame, kind: Windows) -> DataFrame:
    """h, many, doc_id, spot, open (its windows are not settled yet) and units of the chosen contexts."""
    wanted = chosen.groupBy("doc_id", _mark(F.col("spot")).alias("mark")).agg(F.collect_list(F.struct("h", "many", "open", "spot")).alias("spots"))
    key = chosen.schema["doc_id"].dataType.simpleString()
    names = ["h", "many", "open", "doc_id", "spot", "units"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in blocks(batches, limit=_BLOCK):
            part = part.filter(part.column("spots").is_valid())
            if not part.num_rows:
                continue
            units, at = kind.units(part)
            if not kind.words:
                units = raw(part.column("text"))[0]
            rows = part.column("spots")
            flat, counts = rows.flatten(), np.diff(rows.offsets.to_numpy())
            text = np.repeat(np.arange(len(counts)), counts)
            spot = flat.field("spot").to_numpy(zero_copy_only=False)
            begin = at[text] + ((spot >> 8) & 0xFFFFFFFF)
            end = begin + (spot & 255) + kind.size
            data = [units[a:b].tobytes() for a, b in zip(begin.tolist(), end.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [flat.field("h"), flat.field("many"), flat.field("open"), part.column("doc_id").take(pa.array(text)), flat.field("spot"), pa.array(data, pa.binary())],
                names=names,
            )

    return _with_texts(docs, wanted).mapInArrow(run, f"h bigint, many boolean, open boolean, doc_id {key}, spot bigint, units binary")


def _resolve(fetched: DataFrame, kind: Windows, resolve: Callable) -> DataFrame:
    """doc_id and spot of repeated windows of open contexts; the contexts of an anchor come together and in order."""
    key = fetched.schema["doc_id"].dataType.simpleString()
    width = np.uint64 if kind.words else np.uint8

    def settle(held: list[tuple]) -> pa.RecordBatch:
        lines = [np.frombuffer(r[4], width) for r in held]
        at = np.concatenate([[0], np.cumsum([len(x) for x in lines])]).astype(np.int64)
        marks = resolve(np.concatenate(lines), at, kind.size)
        ids, spots = [], []
        for k, (_, open_, doc, spot, _) in enumerate(held):
            if open_:
                own = np.concatenate([[0], marks[at[k] : at[k + 1]].view(np.int8), [0]])
                edges = np.flatnonzero(np.diff(own))
                for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
                    ids.append(doc)
                    spots.append((((spot >> 8) + a) << 8) | (b - a - 1))
        return pa.RecordBatch.from_arrays([pa.array(ids, kind_of_id), pa.array(spots, pa.int64())], names=["doc_id", "spot"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for row in zip(*(batch.column(n).to_pylist() for n in ("h", "open", "doc_id", "spot", "units")), strict=True):
                if held and size > limit and row[0] != held[-1][0]:
                    yield settle(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[4]) // width().itemsize
        if held:
            yield settle(held)

    limit = SHARD_UNITS
    kind_of_id = _arrow_kind(key)
    ordered = fetched.select("h", "open", "doc_id", "spot", "units").repartition("h").sortWithinPartitions("h")
    return ordered.mapInArrow(run, f"doc_id {key}, spot bigint")


def _arrow_kind(name: str) -> pa.DataType:
    return {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "smallint": pa.int16(), "tinyint": pa.int8()}[name]


def _split(fetched: DataFrame, kind: Windows, resolve: Callable) -> DataFrame:
    """doc_id and spot of repeated windows of open contexts of anchors with many contexts, part by part."""
    parts = cut_lineage(_parts(fetched, kind, min(BLOCK, kind.size - kind.gram + 1)))  # what is shared is never less than an anchor
    folded = parts.groupBy("h", "c").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "spot")).alias("one"), F.first("units").alias("units"), F.bool_or("open").alias("open")
    )
    folded = cut_lineage(folded)
    copied = folded.where((F.col("n") > 1) & F.col("open")).select("h", "c")
    copies = parts.where("open").join(copied, ["h", "c"]).select("doc_id", "spot")
    per_anchor = folded.groupBy("h").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > 1)
    distinct = folded.join(per_anchor, "h").select(
        "h", (F.col("m") > MANY).alias("many"), (F.col("open") & (F.col("n") == 1)).alias("open"), "one.doc_id", "one.spot", "units"
    )
    single = _parts(distinct.where("many"), kind, 1)
    twice = single.groupBy("h", "c").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).select("h", "c")
    windows = single.where("open").join(twice, ["h", "c"]).select("doc_id", "spot")
    return copies.union(_resolve(distinct.where(~F.col("many")), kind, resolve)).union(windows)


def _anchor_places(values: np.ndarray, base: np.ndarray, kind: Windows) -> np.ndarray:
    """Where the anchor of each context stands: that of its first window, as all its windows have one."""
    begins = base[:, None] + np.arange(kind.size - kind.gram + 1)
    grams = range_hashes(prefix_sums(values), begins.ravel(), begins.ravel() + kind.gram).reshape(begins.shape)
    return base + np.argmin(grams >> _PLACE_BITS, axis=1)


def _parts(contexts_: DataFrame, kind: Windows, block: int) -> DataFrame:
    """h, c, open, doc_id, spot, units: contexts cut after every `block`-th window, counted from their anchor.

    h is a hash of the units that all windows of a full part share, c of the part; with one window both are of its units,
    which are not passed on.
    """
    key = contexts_.schema["doc_id"].dataType.simpleString()
    width = np.uint64 if kind.words else np.uint8
    names = ["h", "c", "open", "doc_id", "spot", "units"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                lines = [np.frombuffer(x, width) for x in part.column("units").to_pylist()]
                lengths = np.array([len(x) for x in lines])
                base = np.cumsum(lengths) - lengths
                units = np.concatenate(lines)
                values = units if kind.words else _BYTE_VALUES[units]
                counts = lengths - kind.size + 1
                window = segments(base, counts)
                of = np.repeat(np.arange(len(lines)), counts)
                # equal windows have their anchor at one distance, so cuts counted from it agree
                anchor = _anchor_places(values, base, kind)
                block_of = (anchor[of] - window) // block
                new = np.ones(len(window), bool)
                new[1:] = (of[1:] != of[:-1]) | (block_of[1:] != block_of[:-1])
                begins = np.flatnonzero(new)
                row, start, number = of[begins], window[begins], np.diff(np.append(begins, len(window)))
                last = anchor[row] - block_of[begins] * block  # where the last window of the full part starts
                shared = range_hashes(prefix_sums(values), last, last - block + 1 + kind.size)
                h = mixed(shared ^ (block_of[begins].astype(np.uint64) << np.uint64(40)))
                end = start + number - 1 + kind.size
                c = range_hashes(prefix_sums(mixed(values), _SECOND), start, end, _SECOND)
                spot = part.column("spot").to_numpy(zero_copy_only=False)[row]
                taken = pa.array(row)
                data = [units[a:z].tobytes() for a, z in zip(start.tolist(), end.tolist(), strict=True)] if block > 1 else [None] * len(row)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.view(np.int64)), pa.array(c.view(np.int64)), part.column("open").take(taken), part.column("doc_id").take(taken),
                     pa.array((((spot >> 8) + start - base[row]) << 8) | (number - 1)), pa.array(data, pa.binary())],
                    names=names,
                )

    return contexts_.mapInArrow(run, f"h bigint, c bigint, open boolean, doc_id {key}, spot bigint, units binary")


def covered(spots: list[int] | None, count: int, size: int) -> np.ndarray:
    """Units of a text that a repeated window covers."""
    if not spots:
        return np.zeros(count, bool)
    packed = np.array(spots, np.int64)
    start = packed >> 8
    end = start + (packed & 255) + size
    cover = np.zeros(count + 1, np.int32)
    np.add.at(cover, start, 1)
    np.add.at(cover, end, -1)
    return np.cumsum(cover)[:-1] > 0


def with_spots(docs: DataFrame, spots: DataFrame) -> DataFrame:
    return _with_texts(docs, spots).select("doc_id", "text", "spots")
