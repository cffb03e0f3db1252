"""The trie against a plain dictionary of prefixes, with one shard and with many; the parentheses against a stack."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from fixtures import clashing, empty, rows_of

from ticketlake.llm import prefix_trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def _conversations() -> list[tuple]:
    rng = random.Random(11)
    rows = []
    for conv_id in [*range(0, 140), 7, 10**15, -3]:
        if conv_id % 11 == 4:
            continue
        said = [("user", rng.choice("abc")), ("assistant", rng.choice("de"))] + [(rng.choice(("user", None)), rng.choice(("x", "日本", "", None, "é" * 50))) for _ in range(rng.randrange(9))]
        rows += [(conv_id, k, *t) for k, t in enumerate(said[: rng.randrange(len(said) + 1)])] if conv_id != 7 else []
    rows += [(7, None, "user", "first"), (7, 1, "user", "tie"), (7, 1, "user", "tie"), (7, 0, "user", "second"), (None, 0, "user", "nobody")]
    rows += [(conv_id, k, "user", "the same") for conv_id in range(1000, 1040) for k in range(conv_id % 3 + 10)]
    rows += [(2000, k, "user", f"long {k}") for k in range(3000)] + [(2001, 0, "user", "w" * 200_000)]
    return rows


def _plain(rows: list[tuple]) -> list[tuple]:
    own = defaultdict(list)
    for conv_id, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[1] is not None, r[1] or 0)):
        own[conv_id].append((role or "", text or ""))
    members, ends = defaultdict(list), defaultdict(list)
    for conv_id in sorted(own):
        h = zlib.crc32(str(conv_id).encode()) % 9
        seq = tuple(own.get(conv_id - int(np.fmod(conv_id, 5)), [])[:h] + own[conv_id][h:])
        for depth in range(len(seq) + 1):
            members[seq[:depth]].append(conv_id)
        ends[seq].append(conv_id)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        children[node[:-1]] += bool(node)
    for node, ids in members.items():
        for depth in range(len(node) + 1):
            leaves[node[:depth]] += not children.get(node)
            saved[node[:depth]] += (len(ids) - 1) * len(node[-1][1].encode()) if node else 0
    return sorted(
        (
            (
                ids[0], len(node), members[node[:-1]][0] if node else None, len(ids), children.get(node, 0), leaves[node], saved[node],
                hashlib.sha256(",".join(map(str, ends.get(node, []))).encode()).hexdigest(),
            )
            for node, ids in members.items()
        ),
        key=repr,
    )


def _rows_without_long(rows):
    return [r for r in rows if r[0] != 2000]


@pytest.mark.parametrize("shard_turns", [10**6, 40, 3])
def test_every_prefix_has_its_figures_whatever_the_shards(spark, shard_turns):
    rows = _rows_without_long(_conversations())
    given = clashing(spark.createDataFrame(rows, SCHEMA).repartition(3))
    found = prefix_trie.trie(prefix_trie.rebuilt(prefix_trie.sequences(given)), shard_turns)
    assert rows_of(found) == _plain(rows)


def test_a_long_conversation_is_one_path(spark):
    rows = [r for r in _conversations() if r[0] == 2000]
    found = prefix_trie.trie(prefix_trie.sequences(spark.createDataFrame(rows, SCHEMA)))
    assert sorted(r.depth for r in found.collect()) == list(range(3001))


def test_no_rows_make_no_nodes(spark):
    assert prefix_trie.trie(prefix_trie.rebuilt(prefix_trie.sequences(empty(spark, SCHEMA)))).collect() == []


def test_a_conversation_may_lose_all_its_turns(spark):
    """No donor, and fewer turns than are cut: a member of the root only."""
    conv_id = next(c for c in range(1, 999) if c % 5 and zlib.crc32(str(c).encode()) % 9 >= 2)
    found = prefix_trie.trie(prefix_trie.rebuilt(prefix_trie.sequences(spark.createDataFrame([(conv_id, 0, "user", "x")], SCHEMA))))
    digest = hashlib.sha256(str(conv_id).encode()).hexdigest()
    assert rows_of(found) == [(conv_id, 0, None, 1, 0, 1, 0, digest)]


def test_findclose_meets_the_matching_parenthesis():
    rng = np.random.default_rng(3)
    for size in (1, 2, 63, 64, 129, 700, 3000):
        for lean in (0.2, 0.5, 0.8, 0.99):
            bits, depth, left = [], 0, size
            while left or depth:
                opening = left and (not depth or rng.random() < lean)
                bits.append(int(bool(opening)))
                left, depth = (left - 1, depth + 1) if opening else (left, depth - 1)
            stack, want = [], {}
            for place, bit in enumerate(bits):
                if bit:
                    stack.append(place)
                else:
                    want[stack.pop()] = place
            opens = np.flatnonzero(np.array(bits))
            found = prefix_trie.Parens(np.array(bits, np.uint8)).findclose(opens)
            assert [want[k] for k in opens] == found.tolist()
