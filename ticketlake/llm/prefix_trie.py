"""Conversations as a trie of shared first turns, each shard of it held as balanced parentheses.

A turn is 24 bytes: 16 of the SHA-256 of role and text, 8 of the text's length. A conversation is the turns in order, so that
binary order is the order of a walk through the trie from left to right. Equal conversations fold, then ranges of that order are
the shards. Inside a shard every node is one pair of parentheses; `Parens.findclose`, by minima of excess over blocks, ends its
subtree, rank counts the pairs without content (leaves), and running sums over the nodes in order give members and savings.

Nodes on the border of two shards are in both. Each shard knows the last conversation before it and the first one after it, so
it counts a node only where it occurs first, and takes its last node for a leaf only if the next shard does not go on from it.
So the parts of a border node simply add up.

Rows without conv_id belong to no conversation; rows with one turn number stand in the order of their digests, repeated rows
are turns of their own, null role and text are empty, other columns are not read, an empty table has no node. One conversation
(24 bytes a turn) is held whole by one task, texts are not.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticketlake.llm.common import cut_lineage, segments

#: Bytes of a turn in a sequence: digest, then length of its text.
TURN_BYTES = 24
#: Turns that a shard holds, more or less.
SHARD_TURNS = 250_000
#: A conversation starts with turns of the one whose id is the next lower multiple of this; how many, depends on its id.
FAMILY, MOST_SHARED = 5, 9

#: Bytes of a sequence by which it is dealt to a shard; conversations equal up to there share a shard.
_DEALT_BYTES = 64 * TURN_BYTES
_NODES = (
    "shard int, conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, "
    "saved_tokens bigint, end_id bigint, spine binary, parent_spine binary"
)


def sequences(rows: DataFrame) -> DataFrame:
    """conv_id and the turns of it, in order, as one binary."""
    said = F.coalesce(F.col("text"), F.lit(""))
    role = F.coalesce(F.col("role"), F.lit(""))
    size = F.octet_length(said)
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, said), 256)
    turn = F.concat(F.substring(digest, 1, 32), F.lpad(F.hex(size), 16, "0")).alias("turn_key")
    held = rows.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("bigint"), F.struct("turn", turn).alias("t"))
    joined = F.array_join(F.transform(F.sort_array(F.collect_list("t")), lambda t: t["turn_key"]), "")
    return held.groupBy("conv_id").agg(F.unhex(joined).alias("seq"))


def rebuilt(own: DataFrame) -> DataFrame:
    """Every conversation with its first turns taken from the one that its family shares."""
    shared = own.select(F.col("conv_id").alias("from_id"), F.substring("seq", 1, TURN_BYTES * MOST_SHARED).alias("head"))
    cut = (F.crc32(F.col("conv_id").cast("string")) % MOST_SHARED * TURN_BYTES).cast("int").alias("cut")
    asked = own.select("conv_id", "seq", cut, (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("from_id"))
    seq = F.expr("concat(coalesce(substring(head, 1, cut), X''), substring(seq, cut + 1))")
    return asked.join(shared, "from_id", "left").select("conv_id", seq.alias("seq"))


def trie(conversations: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """conv_id, seq to one row per distinct prefix: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    conversations = cut_lineage(conversations)
    distinct = conversations.groupBy("seq").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("first_id"))
    turns = conversations.agg(F.sum(F.octet_length("seq").cast("bigint"))).first()[0] or 0
    dealt = distinct.repartitionByRange(max(1, -(-turns // (TURN_BYTES * shard_turns))), F.substring("seq", 1, _DEALT_BYTES))
    dealt = cut_lineage(dealt.withColumn("shard", F.spark_partition_id()))
    nodes = cut_lineage(dealt.groupBy("shard").cogroup(_borders(dealt).groupBy("shard")).applyInArrow(_shard_nodes, _NODES))
    merged = _merge_spines(nodes)
    ends = _ends(conversations)
    nothing = hashlib.sha256(b"").hexdigest()
    return merged.join(ends, "end_id", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"),
    )


def _borders(dealt: DataFrame) -> DataFrame:
    """For each shard the last conversation before it and the first after it; one row a shard is ordered, nothing more."""
    edges = dealt.groupBy("shard").agg(F.min("seq").alias("first"), F.max("seq").alias("last"))
    order = Window.orderBy("shard")
    return edges.select("shard", F.lag("last").over(order).alias("before"), F.lead("first").over(order).alias("after"))


def _merge_spines(nodes: DataFrame) -> DataFrame:
    """Nodes of several shards become one; nodes right below them learn the smallest member of their parent."""
    spine = nodes.where(F.col("spine").isNotNull())
    one = spine.groupBy("spine").agg(
        F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.max("end_id").alias("end_id"), F.max("parent_spine").alias("parent_spine"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
    )
    columns = ["conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens", "end_id"]
    named = one.select(F.col("spine").alias("parent_spine"), F.col("conv_id").alias("above"))
    upper = one.join(named, "parent_spine", "left").select(*columns, F.col("above").alias("parent_conv_id"))
    # By shard, so that the children of the root do not meet in one task.
    places = spine.select("shard", F.col("spine").alias("parent_spine")).join(named, "parent_spine")
    lower = nodes.where(F.col("spine").isNull()).join(places, ["shard", "parent_spine"], "left")
    return lower.select(*columns, F.coalesce("above", "parent_conv_id").alias("parent_conv_id")).unionByName(upper)


def _ends(conversations: DataFrame) -> DataFrame:
    """For each distinct conversation its smallest id and the digest of all its ids; ids stream through, they are never gathered."""
    keyed = conversations.select(F.unhex(F.sha2("seq", 256)).alias("k"), "conv_id")
    return keyed.repartition("k").sortWithinPartitions("k", "conv_id").mapInArrow(_digest_runs, "end_id bigint, ends_sha256 string")


def _digest_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last, first_id, digest = None, None, None
    for batch in batches:
        keys, ids = batch.column("k").to_pylist(), batch.column("conv_id").to_pylist()
        done = []
        for key, conv_id in zip(keys, ids, strict=True):
            if key == last:
                digest.update(b",%d" % conv_id)
                continue
            if digest is not None:
                done.append((first_id, digest.hexdigest()))
            last, first_id, digest = key, conv_id, hashlib.sha256(b"%d" % conv_id)
        if done:
            yield _end_rows(done)
    if digest is not None:
        yield _end_rows([(first_id, digest.hexdigest())])


def _end_rows(done: list[tuple[int, str]]) -> pa.RecordBatch:
    ids, digests = zip(*done, strict=True)
    return pa.record_batch([pa.array(ids, pa.int64()), pa.array(digests, pa.string())], names=["end_id", "ends_sha256"])


class Parens:
    """Balanced parentheses (1 opens, 0 closes) with the least excess of blocks in a tree of pairwise minima."""

    BLOCK = 128

    def __init__(self, bits: np.ndarray):
        self.bits = bits
        self.excess = np.cumsum(bits.astype(np.int64) * 2 - 1)
        high = np.iinfo(np.int64).max
        least = np.minimum.reduceat(self.excess, np.arange(0, len(bits), self.BLOCK)) if len(bits) else np.zeros(0, np.int64)
        self.levels = [least]
        while len(self.levels[-1]) > 1:
            below = self.levels[-1]
            if len(below) % 2:
                below = self.levels[-1] = np.append(below, high)
            self.levels.append(np.minimum(below[::2], below[1::2]))

    def findclose(self, opens: np.ndarray) -> np.ndarray:
        """The closing place of each opening one: the first later place whose excess is one less."""
        found = np.full(len(opens), -1, np.int64)
        target = self.excess[opens] - 1
        self._scan(opens + 1, target, np.arange(len(opens)), found)
        left = np.flatnonzero(found < 0)
        if len(left):
            self._scan(self._block_after(opens[left] // self.BLOCK, target[left]) * self.BLOCK, target, left, found)
        return found

    def _scan(self, start: np.ndarray, target: np.ndarray, asked: np.ndarray, found: np.ndarray) -> None:
        """Look from each start to the end of the start's block; `asked` says which of the targets."""
        at, stop = start, np.minimum((start // self.BLOCK + 1) * self.BLOCK, len(self.bits))
        while len(at):
            inside = at < stop
            at, asked, stop = at[inside], asked[inside], stop[inside]
            hit = self.excess[at] <= target[asked]
            found[asked[hit]] = at[hit]
            at, asked, stop = at[~hit] + 1, asked[~hit], stop[~hit]

    def _block_after(self, block: np.ndarray, target: np.ndarray) -> np.ndarray:
        """The first block after each given one with an excess as low as the target: up the tree, then down."""
        place, height = block.copy(), np.full(len(block), -1)
        climbing = np.arange(len(block))
        for level, least in enumerate(self.levels):
            right = place[climbing] % 2 == 0
            beside = np.where(right, place[climbing] + 1, 0)
            fits = right & (beside < len(least))
            fits[fits] = least[beside[fits]] <= target[climbing[fits]]
            place[climbing[fits]] += 1
            height[climbing[fits]] = level
            climbing = climbing[~fits]
            place[climbing] //= 2
            if not len(climbing):
                break
        for level in range(len(self.levels) - 1, 0, -1):
            down = np.flatnonzero(height >= level)
            child = place[down] * 2
            place[down] = child + (self.levels[level - 1][child] > target[down])
        return place


def _shared_turns(a: bytes, b: bytes) -> int:
    """Number of equal first turns."""
    size = min(len(a), len(b)) // TURN_BYTES
    x, y = (np.frombuffer(t, np.uint8, size * TURN_BYTES).reshape(size, TURN_BYTES) for t in (a, b))
    differ = np.flatnonzero((x != y).any(axis=1))
    return int(differ[0]) if len(differ) else size


def _shared_with_previous(turns: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Equal first turns of each conversation and the one before it, depth by depth over those still equal."""
    shared = np.zeros(len(start), np.int64)
    alive, depth = np.arange(1, len(start)), 0
    while len(alive):
        alive = alive[np.minimum(length[alive], length[alive - 1]) > depth]
        alive = alive[(turns[start[alive] + depth] == turns[start[alive - 1] + depth]).all(axis=1)]
        depth += 1
        shared[alive] = depth
    return shared


def _range_minima(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The least value of each range that is not empty, from minima of ranges of powers of two."""
    out = np.empty(len(low), np.int64)
    exponent = np.frexp((high - low).astype(np.float64))[1] - 1
    table = values
    for power in range(int(exponent.max(initial=0)) + 1):
        here = np.flatnonzero(exponent == power)
        out[here] = np.minimum(table[low[here]], table[high[here] - (1 << power)])
        table = np.minimum(table[: -(1 << power)], table[1 << power :]) if len(table) > 1 << power else table
    return out


def _prefix_digests(seq: bytes, depth: int) -> list[bytes]:
    """The digest of every prefix up to a depth."""
    running, found = hashlib.sha256(), []
    for d in range(depth + 1):
        found.append(running.copy().digest())
        running.update(seq[d * TURN_BYTES : (d + 1) * TURN_BYTES])
    return found


def _shard_nodes(conversations: pa.Table, borders: pa.Table) -> pa.Table:
    """All nodes of one shard, with the shard's part of their figures."""
    schema = _node_schema()
    if not conversations.num_rows:
        return schema.empty_table()
    table = conversations.take(pc.sort_indices(conversations.column("seq").combine_chunks())).combine_chunks()
    seq = table.column("seq").combine_chunks()
    first, last = seq[0].as_py(), seq[-1].as_py()
    before, after = borders.column("before")[0].as_py(), borders.column("after")[0].as_py()
    from_before = -1 if before is None else _shared_turns(before, first)
    to_after = -1 if after is None else _shared_turns(last, after)

    length = pc.binary_length(seq).to_numpy().astype(np.int64) // TURN_BYTES
    turns = np.frombuffer(b"".join(seq.to_pylist()), ">u8").reshape(-1, 3)
    start = np.cumsum(length) - length
    shared = _shared_with_previous(turns, start, length)
    shared[0] = -1
    opened = length - shared
    of_seq = np.repeat(np.arange(len(length)), opened)
    depth = segments(shared + 1, opened)
    size = len(depth)
    text_bytes = np.zeros(size, np.int64)
    below = depth > 0
    text_bytes[below] = turns[start[of_seq[below]] + depth[below] - 1, 2].astype(np.int64)

    # Before each conversation the nodes it does not share are closed, then its own are opened.
    closed = np.append(length[:-1] - shared[1:], length[-1] + 1)
    runs = np.column_stack([opened, closed]).ravel()
    bits = np.repeat(np.tile(np.array([1, 0], np.uint8), len(length)), runs)
    tree = Parens(bits)
    opens = np.flatnonzero(bits)
    closes = tree.findclose(opens)
    node = np.arange(size)
    stop = node + (closes - opens + 1) // 2

    ends_at = np.cumsum(opened) - 1
    goes_on = after is not None and to_after == length[-1]
    pairs = np.zeros(len(bits) + 1, np.int64)
    pairs[1:-1] = (bits[:-1] == 1) & (bits[1:] == 0)
    if goes_on:
        pairs[opens[ends_at[-1]] + 1] = 0
    pairs = np.cumsum(pairs)
    leaves = pairs[closes] - pairs[opens]

    members = np.zeros(size + 1, np.int64)
    members[ends_at + 1] = table.column("n").to_numpy()
    members = np.cumsum(members)
    convs = members[stop] - members[node]
    ended = np.zeros(size + 1, np.int64)
    ended[ends_at + 1] = 1
    ended = np.cumsum(ended)
    least = _range_minima(table.column("first_id").to_numpy(), ended[node], ended[stop])

    on_first, on_last = of_seq == 0, (node <= ends_at[-1]) & (ends_at[-1] < stop)
    counted = ~(on_first & (depth <= from_before))
    saved = np.zeros(size + 1, np.int64)
    np.cumsum((convs - counted) * text_bytes, out=saved[1:])

    order = np.lexsort((node, depth))
    rank = depth[order] * size + order
    parent = np.where(below, order[np.searchsorted(rank, (depth - 1) * size + node) - 1], -1)
    children = np.bincount(parent[below & counted], minlength=size)

    spine = np.full(size, None, object)
    for path, known, deepest in ((first, on_first, from_before), (last, on_last, to_after)):
        digests = _prefix_digests(path, deepest) if deepest >= 0 else []
        for k in np.flatnonzero(known & (depth <= deepest)):
            spine[k] = digests[depth[k]]
    end_id = np.full(size, None, object)
    end_id[ends_at] = table.column("first_id").to_pylist()
    above = np.append(least, 0)[parent]
    return pa.table(
        [
            pa.array(np.full(size, conversations.column("shard")[0].as_py()), pa.int32()), pa.array(least), pa.array(depth),
            pa.array(above, mask=~below), pa.array(convs), pa.array(children.astype(np.int64)), pa.array(leaves),
            pa.array(saved[stop] - saved[node]), pa.array(end_id, pa.int64()), pa.array(spine, pa.binary()),
            pa.array(np.append(spine, None)[parent], pa.binary()),
        ],
        schema=schema,
    )


def _node_schema() -> pa.Schema:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in _NODES.split(", "))])
