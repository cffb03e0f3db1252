"""How sources of one language differ in their words: exact pairwise distances from count-level bitmaps.

Terms of a language are numbered inside shards of about `SHARD_TERMS`, commonest first, and 64 numbers are one word of bits.
A group (lang, source) has, for each word and each count that occurs in it, one bitset of the terms with that count. Two
groups meet in a shard: AND and popcount of two bitsets of a word give how many terms have that pair of counts, times the
distance of the two shares. Terms absent from one group are what popcount leaves over; terms absent from both are the
complement, added once for a pair. So a term costs at most 64 cells of a pair, whatever the counts are.

Nulls are empty texts, an empty language or source is a group like any other, repeated rows count again, a text of any length
is read whole (one longer than a block is a block of its own), ties rank by name, other columns are not read, and an empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticketlake.llm.common import blocks, cut_lineage, lower_ascii, raw, segments, words_of

#: A term has to stand in so many documents of its language.
LEAST_DOCUMENTS = 30
#: Added to every count, and what a share is a fraction of.
PRIOR, SCALE = 5, 1_000_000_000
#: Ranks listed for the terms of a group.
TOP_TERMS = 50
#: Terms of a shard, sources of a tile: what one task compares at a time.
SHARD_TERMS, TILE_SOURCES = 16_384, 32

_TEXT_BYTES = 4_000_000
_LETTERS = np.zeros(256, bool)
_LETTERS[65:91] = _LETTERS[97:123] = _LETTERS[128:] = True

_COUNTS = "lang string, source string, term string, n bigint, docs bigint"
_PAIRS = "lang string, a string, b string, value bigint, covered bigint, far bigint, terms bigint"


def audit(
    docs: DataFrame, least_documents: int = LEAST_DOCUMENTS, top: int = TOP_TERMS, shard_terms: int = SHARD_TERMS,
    tile_sources: int = TILE_SOURCES,
) -> DataFrame:
    """lang, source, part, item, value, rank: every other source by distance, and the terms most above the language."""
    counts = cut_lineage(term_counts(docs))
    kept = counts.where("term != ''").groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("total"))
    kept = kept.where(F.col("docs") >= least_documents)
    shards = max(1, -(-kept.count() // shard_terms))
    kept = kept.select("lang", "term", "total", F.pmod(F.xxhash64("term"), F.lit(shards)).cast("int").alias("shard"))
    order = Window.partitionBy("lang", "shard").orderBy(F.desc("total"), "term")
    held = counts.where("term != ''").drop("docs").join(kept.withColumn("number", F.row_number().over(order) - 1), ["lang", "term"])
    heads = cut_lineage(_groups(counts, kept, tile_sources)).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    cells = held.join(heads, ["lang", "source", "shard"]).withColumn("p", _share("n", "group_n"))
    return _distances(cells, heads).unionByName(_marked_terms(cells.withColumn("value", F.col("p") - _share("total", "lang_n")), top))


def term_counts(docs: DataFrame) -> DataFrame:
    """Occurrences of every term in every (lang, source), and documents with it; the empty term stands for the group itself."""
    names = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")]
    found = docs.select(*names).mapInArrow(_count, _COUNTS)
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in blocks(batches, limit=_TEXT_BYTES):
        data, at = raw(batch.column("text"))
        data = lower_ascii(data)
        starts, ends, before = words_of(data, at, _LETTERS)
        offsets = np.zeros(len(starts) + 1, np.int64)
        np.cumsum(ends - starts, out=offsets[1:])
        words = pa.Array.from_buffers(
            pa.large_utf8(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[_LETTERS[data]])]
        ).dictionary_encode()
        codes, terms = words.indices.to_numpy().astype(np.int64), words.dictionary
        lang, source = batch.column("lang").dictionary_encode(), batch.column("source").dictionary_encode()
        width = max(len(source.dictionary), 1)
        group = lang.indices.to_numpy().astype(np.int64) * width + source.indices.to_numpy()
        of_word = np.repeat(np.arange(batch.num_rows, dtype=np.int64), np.diff(before))
        size = max(len(terms), 1)
        keys, n = np.unique(group[of_word] * size + codes, return_counts=True)
        once = np.unique(of_word * size + codes)
        docs = np.unique(group[once // size] * size + once % size, return_counts=True)[1]
        whole, members = np.unique(group, return_counts=True)
        ids = np.concatenate([keys // size, whole])
        named = pa.concat_arrays([terms.cast(pa.string()).take(pa.array(keys % size)), pa.array([""] * len(whole), pa.string())])
        yield pa.record_batch(
            [
                lang.dictionary.take(pa.array(ids // width)).cast(pa.string()), source.dictionary.take(pa.array(ids % width)).cast(pa.string()),
                named, pa.array(np.concatenate([n, np.zeros(len(whole), np.int64)])), pa.array(np.concatenate([docs, members])),
            ],
            names=["lang", "source", "term", "n", "docs"],
        )


def _share(count: str, total: str) -> F.Column:
    """1 + floor(SCALE * (count + PRIOR) / (total + PRIOR * terms)) in whole numbers; 0 in a language without kept terms."""
    above = f"CAST({SCALE} AS DECIMAL(10,0)) * CAST({count} + {PRIOR} AS DECIMAL(20,0))"
    return F.expr(f"IF(terms = 0, 0L, 1L + ({above}) div CAST({total} + {PRIOR} * terms AS DECIMAL(20,0)))")


def _groups(counts: DataFrame, kept: DataFrame, tile_sources: int) -> DataFrame:
    """Every (lang, source) with its kept occurrences, those of its language, the terms kept there, and its tile."""
    named = counts.where("term = ''").select("lang", "source")
    own = counts.join(kept.select("lang", "term"), ["lang", "term"]).groupBy("lang", "source").agg(F.sum("n").alias("group_n"))
    whole = kept.groupBy("lang").agg(F.sum("total").alias("lang_n"), F.count(F.lit(1)).alias("terms"))
    tiles = named.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / tile_sources).cast("int").alias("tiles"))
    found = named.join(own, ["lang", "source"], "left").join(tiles, "lang").join(whole, "lang", "left").na.fill(0)
    return found.withColumn("tile", F.pmod(F.xxhash64("source"), F.col("tiles")).cast("int")).withColumn("p0", _share("0", "group_n"))


def bitsets(cells: DataFrame) -> DataFrame:
    """One row for each word and count of a group: the terms of the word that occur so often in the group."""
    word = [F.expr("number div 64").cast("int").alias("word"), F.expr("shiftleft(1L, CAST(number % 64 AS INT))").alias("bit")]
    levels = cells.select("lang", "shard", "source", "tile", "tiles", "p0", "terms", "n", "p", *word)
    return levels.groupBy("lang", "shard", "source", "tile", "tiles", "p0", "terms", "word", "n", "p").agg(F.bit_or("bit").alias("bits")).drop("n")


def _distances(cells: DataFrame, heads: DataFrame) -> DataFrame:
    """Tiles of groups meet pairwise in every shard; a pair's parts are added, then the terms that neither group has."""
    nothing = {"word": "int", "p": "bigint", "bits": "bigint"}
    marks = heads.select("lang", "shard", "source", "tile", "tiles", "p0", "terms", *[F.lit(None).cast(t).alias(c) for c, t in nothing.items()])
    met = F.transform(F.sequence(F.lit(0), F.col("tiles") - 1), lambda t: F.struct(F.least("tile", t).alias("i"), F.greatest("tile", t).alias("j")))
    dealt = bitsets(cells).unionByName(marks).withColumn("met", F.explode(met)).select("*", "met.i", "met.j").drop("met", "tiles")
    parts = dealt.groupBy("lang", "shard", "i", "j").applyInArrow(_compare, _PAIRS)
    whole = parts.groupBy("lang", "a", "b").agg(
        F.sum("value").alias("value"), F.sum("covered").alias("covered"), F.max("far").alias("far"), F.max("terms").alias("terms")
    )
    value = F.col("value") + (F.col("terms") - F.col("covered")) * F.col("far")
    both = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    return _ranked(whole.select("lang", value.alias("value"), both.alias("side")).select("lang", "side.*", "value"), "pair")


def _compare(table: pa.Table) -> pa.Table:
    """Every pair of sources of two tiles (or of one) over the bitsets of a shard."""
    lang, i, j = (table.column(c)[0].as_py() for c in ("lang", "i", "j"))
    table = table.sort_by([("source", "ascending"), ("word", "ascending")]).combine_chunks()
    names = table.column("source").combine_chunks().dictionary_encode()
    sources, code = names.dictionary.to_pylist(), names.indices.to_numpy()
    edges = np.searchsorted(code, np.arange(len(sources) + 1))
    tile, p0, terms = (table.column(c).to_numpy()[edges[:-1]] for c in ("tile", "p0", "terms"))
    word = table.column("word").fill_null(-1).to_numpy()
    p, bits = (table.column(c).fill_null(0).to_numpy() for c in ("p", "bits"))
    bits = bits.view(np.uint64)
    rows = []
    levels = []
    for k in range(len(sources)):
        own = np.arange(edges[k], edges[k + 1])
        own = own[word[own] >= 0]
        levels.append((word[own], p[own], bits[own], np.bitwise_count(bits[own]).astype(np.int64)))
    for x in range(len(sources)):
        for y in range(x + 1, len(sources)):
            if {int(tile[x]), int(tile[y])} == {i, j}:
                value, covered = _cells(levels[x], levels[y], p0[x], p0[y])
                rows.append((lang, sources[x], sources[y], value, covered, abs(int(p0[x]) - int(p0[y])), int(terms[x])))
    columns = list(zip(*rows, strict=True)) or [()] * 7
    kinds = [pa.string()] * 3 + [pa.int64()] * 4
    return pa.table([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["lang", "a", "b", "value", "covered", "far", "terms"])


def _cells(a: tuple, b: tuple, a0: int, b0: int) -> tuple[int, int]:
    """Summed distance and number of the terms that at least one of two groups has."""
    (a_word, a_p, a_bits, a_size), (b_word, b_p, b_bits, b_size) = a, b
    low, high = np.searchsorted(b_word, a_word, "left"), np.searchsorted(b_word, a_word, "right")
    left, right = np.repeat(np.arange(len(a_word)), high - low), segments(low, high - low)
    joint = np.bitwise_count(a_bits[left] & b_bits[right]).astype(np.int64)
    a_only = a_size - np.bincount(left, joint, len(a_word)).astype(np.int64)
    b_only = b_size - np.bincount(right, joint, len(b_word)).astype(np.int64)
    value = (joint * np.abs(a_p[left] - b_p[right])).sum() + (a_only * np.abs(a_p - b0)).sum() + (b_only * np.abs(b_p - a0)).sum()
    return int(value), int(joint.sum() + a_only.sum() + b_only.sum())


def _marked_terms(cells: DataFrame, top: int) -> DataFrame:
    above = cells.where("value > 0").select("lang", "source", F.col("term").alias("item"), "value")
    return _ranked(above, "term").where(F.col("rank") <= top)


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
