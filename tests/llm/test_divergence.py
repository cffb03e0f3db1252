"""Distances and marked terms against plain counting, in one shard and in many, with groups in one tile and in several."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import pytest
from fixtures import clashing, documents, empty, lower, rows_of

from ticketlake.llm import divergence


def _plain(rows, least: int, top: int):
    counts, docs = defaultdict(Counter), defaultdict(Counter)
    for r in rows:
        lang, source = r["lang"] or "", r["source"] or ""
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower(r["text"] or ""))
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
    kept = {lang: [t for t, n in c.items() if n >= least] for lang, c in docs.items()}

    def share(count, total, terms):
        return 1 + 10**9 * (count + 5) // (total + 5 * terms)

    out = []
    for (lang, source), own in counts.items():
        terms = kept.get(lang, [])

        def shares(c, terms=terms):
            total = sum(c[t] for t in terms)
            return {t: share(c[t], total, len(terms)) for t in terms}

        p = shares(own)
        whole = sum((c for (other, _), c in counts.items() if other == lang), Counter())
        q = shares(whole)
        pairs = []
        for (l2, s2), c in counts.items():
            if l2 == lang and s2 != source:
                r = shares(c)
                pairs.append((s2, sum(abs(p[t] - r[t]) for t in terms)))
        marked = [(t, p[t] - q[t]) for t in terms if own[t] > 0 and p[t] > q[t]]
        for part, items, limit in (("pair", pairs, None), ("term", marked, top)):
            ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:limit]
            out += [(lang, source, part, item, value, k + 1) for k, (item, value) in enumerate(ranked)]
    return sorted(out, key=repr)


def _spread(spark):
    from pyspark.sql import functions as F

    docs = documents(spark)
    named = F.element_at(F.array(*[F.lit(x) for x in ("web", "", "日本", "Web", None)]), (F.col("n") % 5 + 1).cast("int"))
    numbered = docs.withColumn("n", F.coalesce("doc_id", F.lit(3)))
    lang = F.when(F.col("n") % 3 == 0, F.lit("en")).when(F.col("n") % 3 == 1, F.lit(None)).otherwise("é")
    return numbered.withColumn("source", named).withColumn("lang", lang).drop("n")


@pytest.mark.parametrize(("least", "shard_terms", "tile_sources"), [(2, 10**6, 32), (2, 7, 2), (1, 50, 1), (4, 16, 3), (10**6, 10, 2)])
def test_every_distance_and_term(spark, least, shard_terms, tile_sources):
    docs = _spread(spark)
    found = divergence.audit(clashing(docs), least, 5, shard_terms, tile_sources)
    assert rows_of(found) == _plain(docs.collect(), least, 5)


def test_every_document_is_counted_in_its_group(spark):
    docs = _spread(spark)
    counts = divergence.term_counts(docs)
    assert counts.where("term = ''").agg({"docs": "sum"}).first()[0] == docs.count()


def test_no_documents(spark):
    assert divergence.audit(empty(spark)).collect() == []


def test_large_counts_stay_whole_numbers(spark):
    from pyspark.sql import functions as F

    row = spark.range(1).select(F.lit(4_000_000_000_000).alias("n"), F.lit(9_000_000_000_000).alias("total"), F.lit(1_000_000).alias("terms"))
    assert row.select(divergence._share("n", "total")).first()[0] == 1 + 10**9 * (4 * 10**12 + 5) // (9 * 10**12 + 5 * 10**6)
