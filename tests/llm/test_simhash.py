import random

import numpy as np
import pytest
import xxhash
from fixtures import blank_words, clashing, documents, empty, lower, rows_of

from ticketlake.llm import simhash
from ticketlake.llm.components import components


def plain_fingerprint(text):
    own = blank_words(lower(text or ""))
    if not own:
        return 0
    shingles = [" ".join(own[k : k + 4]) for k in range(len(own) - 3)] if len(own) >= 4 else [" ".join(own)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_roots(prints):
    """Least id reachable, by comparing all pairs."""
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def test_documents(spark):
    docs = documents(spark)
    rows = [r for r in docs.collect() if r.doc_id is not None]
    rows = sorted({r.doc_id: r for r in rows}.values(), key=lambda r: r.doc_id)
    prints = [plain_fingerprint(r.text) for r in rows]
    expected = {r.doc_id: (p, rows[k].doc_id) for r, p, k in zip(rows, prints, plain_roots(prints), strict=True)}
    found = simhash.near_duplicates(clashing(docs)).collect()
    assert len(found) == docs.count()
    assert {r.doc_id: (r.fp % (1 << 64), r.component_id) for r in found if r.doc_id is not None} == expected


@pytest.mark.parametrize("tile", [1024, 8])
def test_dense_groups(spark, monkeypatch, tile):
    """Chains and balls of fingerprints, with tiles of a few members too."""
    monkeypatch.setattr(simhash, "TILE", tile)
    rng = random.Random(11)
    prints = []
    for _ in range(12):
        center = rng.getrandbits(64)
        for _ in range(rng.choice((1, 3, 40))):
            prints.append(center)
            for _ in range(rng.choice((1, 2, 5))):
                center ^= 1 << rng.randrange(64)
    roots = plain_roots(prints)
    df = spark.createDataFrame([(k, int(np.uint64(p).view(np.int64))) for k, p in enumerate(prints)], "doc_id bigint, fp bigint")
    links = {(a % (1 << 64), b % (1 << 64)) for a, b in simhash.near_links(df).collect()}
    assert all((a ^ b).bit_count() <= 4 for a, b in links)
    same = {}
    for p, r in zip(prints, roots, strict=True):
        same.setdefault(p, r)
    nodes = sorted(set(prints))
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[find(a)] = find(b)
    assert all((same[a] == same[b]) == (find(a) == find(b)) for a in nodes for b in nodes[:60])


def test_no_rows(spark):
    assert simhash.near_duplicates(empty(spark)).count() == 0


def test_components_of_a_long_chain(spark):
    chain = [(k, k + 1) for k in range(300)] + [(1000, 1002), (1001, 1002), (1002, 1000), (5000, 5000)]
    found = dict(components(spark.createDataFrame(chain, "a bigint, b bigint")).collect())
    assert found == {**{k: 0 for k in range(301)}, 1000: 1000, 1001: 1000, 1002: 1000}
    assert rows_of(components(spark.createDataFrame([], "a bigint, b bigint"))) == []
