from collections import Counter

import numpy as np
import pytest
from fixtures import blank_words, clashing, documents, empty, rows_of
from hypothesis import given, settings
from hypothesis import strategies as st

from ticketlake.llm import anchors, factors, suffix


def marks(units: list, size: int) -> list[list[bool]]:
    """Units covered by a window that starts elsewhere too, window by window."""
    seen = Counter(tuple(u[s : s + size]) for u in units for s in range(len(u) - size + 1))
    out = []
    for u in units:
        cover = [False] * len(u)
        for s in range(len(u) - size + 1):
            if seen[tuple(u[s : s + size])] > 1:
                cover[s : s + size] = [True] * size
        out.append(cover)
    return out


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=40), min_size=1, max_size=6), st.integers(1, 12))
def test_resolvers_find_all_repeated_starts(texts, size):
    at = np.cumsum([0, *map(len, texts)])
    units = np.array([u for t in texts for u in t], np.uint8)
    seen = Counter(tuple(t[s : s + size]) for t in texts for s in range(len(t) - size + 1))
    expected = [s + size <= len(t) and seen[tuple(t[s : s + size])] > 1 for t in texts for s in range(len(t))]
    assert suffix.resolve(units, at, size).tolist() == expected
    assert factors.resolve(units.astype(np.uint64), at, size).tolist() == expected


def expected_bytes(docs, size):
    rows = [(r.doc_id, (r.text or "").encode()) for r in docs.collect()]
    out = []
    for (key, data), cover in zip(rows, marks([list(d) for _, d in rows], size), strict=True):
        runs = sum(c and not (k and cover[k - 1]) for k, c in enumerate(cover))
        out.append((key, bytes(b for b, c in zip(data, cover, strict=True) if not c), len(data), sum(cover), runs))
    return sorted(out, key=repr)


def found_bytes(docs, size, gram):
    rows = suffix.drop_repeated_bytes(docs, size, gram).collect()
    return sorted(((r.doc_id, bytes(r.kept), r.n_bytes, r.n_removed, len(r.removed)) for r in rows), key=repr)


def expected_words(docs, size):
    rows = [(r.doc_id, blank_words(r.text)) for r in docs.collect()]
    return sorted(
        ((k, " ".join(w for w, c in zip(own, cover, strict=True) if not c), len(own), sum(cover)) for (k, own), cover in zip(rows, marks([w for _, w in rows], size), strict=True)),
        key=repr,
    )


@pytest.mark.parametrize(("size", "gram"), [(200, 64), (20, 7)])
def test_bytes(spark, size, gram):
    docs = documents(spark)
    assert found_bytes(docs, size, gram) == expected_bytes(docs, size)


@pytest.mark.parametrize(("size", "gram"), [(35, 12), (5, 2)])
def test_words(spark, size, gram):
    docs = documents(spark)
    assert rows_of(factors.drop_repeated_words(docs, size, gram)) == expected_words(docs, size)


def test_split_anchors_and_small_shards(spark, monkeypatch):
    """Anchors of more contexts than MANY are spread; the result is the same."""
    monkeypatch.setattr(anchors, "MANY", 2)
    monkeypatch.setattr(anchors, "SHARD_UNITS", 100)
    docs = documents(spark)
    assert found_bytes(docs, 50, 20) == expected_bytes(docs, 50)
    assert rows_of(factors.drop_repeated_words(docs, 6, 2)) == expected_words(docs, 6)


def test_other_columns_and_no_rows(spark):
    docs = documents(spark)
    assert found_bytes(clashing(docs), 200, 64) == found_bytes(docs, 200, 64)
    assert rows_of(factors.drop_repeated_words(clashing(docs))) == rows_of(factors.drop_repeated_words(docs))
    assert suffix.drop_repeated_bytes(empty(spark)).count() == 0
    assert factors.drop_repeated_words(empty(spark)).count() == 0
