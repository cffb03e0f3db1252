from collections import defaultdict

import numpy as np
import pytest
import re
from fixtures import clashing, documents, empty, lower, rows_of

from ticketlake.llm import contamination, lines

BLANKS = " \t\n\x0b\x0c\r"


def expected_lines(rows, min_chars=20, min_docs=3):
    holders = defaultdict(set)
    for r in rows:
        for line in (r.text or "").split("\n"):
            key = lower(line.strip(BLANKS))
            if len(key) >= min_chars:
                holders[key].add(r.doc_id)
    low = lambda x: -1 if x is None else x
    out = []
    for r in rows:
        own = (r.text or "").split("\n")
        kept = [x for x in own if len(h := holders.get(lower(x.strip(BLANKS)), ())) < min_docs or low(r.doc_id) == max(map(low, h))]
        out.append((r.doc_id, "\n".join(kept), len(own), len(own) - len(kept)))
    return sorted(out, key=repr)


def found_lines(docs, **options):
    return rows_of(lines.drop_repeated_lines(docs, **options).selectExpr("doc_id", "coalesce(text, '')", "n_lines", "n_dropped"))


def test_lines(spark):
    docs = documents(spark)
    assert found_lines(docs) == expected_lines(docs.collect())
    assert found_lines(docs, min_chars=1, min_docs=2) == expected_lines(docs.collect(), 1, 2)


def test_full_filter_changes_nothing(spark, monkeypatch):
    """A filter of eight bits suspects every line."""
    monkeypatch.setattr(lines, "_filter_bits", lambda docs: 3)
    docs = documents(spark)
    assert found_lines(docs) == expected_lines(docs.collect())


def test_filters_lose_no_line_of_two_documents():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 1 << 63, 500).astype(np.uint64), rng.integers(0, 1 << 63, 500).astype(np.uint64)
    one, two = lines.Filters(16), lines.Filters(16)
    one.see(a)
    one.see(a[:50])
    two.see(np.concatenate([b, a[100:200]]))
    merged = one.twice | two.twice | (one.once & two.once)
    again = np.concatenate([a[:50], a[100:200]])
    assert lines.Filters.holds(merged, lines._places(again, 16).astype(np.int64)).all()
    assert not lines.Filters.holds(merged, lines._places(b, 16).astype(np.int64)).all()


def test_lines_keep_columns_and_take_no_rows(spark):
    docs = clashing(documents(spark))
    assert found_lines(docs) == expected_lines(docs.collect())
    assert lines.drop_repeated_lines(empty(spark)).count() == 0


ITEMS = "item_id bigint, text string"


def item_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))


def expected_matches(docs, items):
    windows = defaultdict(set)
    for r in items:
        own = item_words(r.text)
        size = min(13, len(own))
        for k in range(len(own) - size + 1 if size else 0):
            windows[tuple(own[k : k + size])].add("" if r.item_id is None else str(r.item_id))
    out = []
    for r in docs:
        own, hit, met, longest = item_words(r.text), set(), set(), 0
        for size in {len(w) for w in windows}:
            for k in range(len(own) - size + 1):
                if tuple(own[k : k + size]) in windows:
                    met |= windows[tuple(own[k : k + size])]
                    hit |= set(range(k, k + size))
        out.append((r.doc_id, len(own), len(hit), sorted(met), bool(hit) and 20 * len(hit) >= len(own)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("lot_words", [1_000_000, 100])
def test_matches(spark, lot_words):
    docs = documents(spark)
    texts = [r.text for r in docs.where("length(text) > 100").orderBy("doc_id").collect()]
    items = [(1, texts[3]), (2, " ".join(texts[4].split()[5:30])), (2, texts[5]), (30, "x"), (None, texts[6]), (5, None), (6, ""), (7, "No such words, at all."), (8, texts[3])]
    benchmark = spark.createDataFrame(items, ITEMS)
    found = contamination.find_matches(clashing(docs), benchmark, lot_words)
    got = rows_of(found.select("doc_id", "n_words", "n_hit", "items", "contaminated"))
    assert got == expected_matches(docs.collect(), benchmark.collect())


def test_longest_match_and_what_stays(spark):
    text = " ".join(f"w{k}" for k in range(100))
    docs = spark.createDataFrame([(1, "a b " + text[:200] + " c"), (2, "clean words only"), (3, None)], "doc_id bigint, text string")
    benchmark = spark.createDataFrame([(1, text)], ITEMS)
    rows = {r.doc_id: r for r in contamination.find_matches(docs, benchmark).collect()}
    assert (rows[1].longest, rows[1].longest_at) == (len(text[:200].split()) - (text[200] != " "), 2)
    assert (rows[2].longest, rows[2].longest_at) == (0, -1)
    assert rows_of(contamination.decontaminate(docs, benchmark).select("doc_id")) == [(2,), (3,)]


def test_empty_tables(spark):
    assert contamination.find_matches(empty(spark), spark.createDataFrame([(1, "a b")], ITEMS)).count() == 0
    found = contamination.find_matches(documents(spark), empty(spark, ITEMS))
    assert found.where("contaminated or n_hit > 0").count() == 0
