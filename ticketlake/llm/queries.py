"""One registered query for each operator of this package, over the whole tables, with check SQL where SQL can say it."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketlake.llm import bpe, contamination, divergence, factors, lines, pii, piecewise, prefix_trie, secret_ledger, simhash, suffix, toxicity, url_templates
from ticketlake.llm.common import narrow, table
from ticketlake.session import ensure_checkpoint_dir

RANK_FILE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def op1_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.encode(table(spark, folder, "documents"), RANK_FILE, public_tokenizers.PATTERN, digests=True)


def _spans(spans: F.Column, kinds: tuple[str, ...] | None = None) -> F.Column:
    """kind:start:end joined by commas, of some kinds or all."""
    if kinds:
        spans = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _counts(kinds: tuple[str, ...]) -> list[F.Column]:
    def count(kind: str) -> F.Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return [count(kind) for kind in kinds]


def op2_secrets(spark: SparkSession, folder: str) -> DataFrame:
    versions = table(spark, folder, "documents").select(F.col("doc_id").alias("path"), "text")
    ledger = secret_ledger.append(spark, f"{ensure_checkpoint_dir(spark)}/ledger-{uuid.uuid4().hex}", secret_ledger.scan(versions))
    found = secret_ledger.findings(versions, ledger)
    return found.select(
        F.col("path").alias("doc_id"), *_counts(secret_ledger.BASE_KINDS),
        F.sha2(_spans(F.col("spans"), secret_ledger.BASE_KINDS), 256).alias("base_sha256"), _spans(F.col("spans")).alias("spans"),
    )


def op3_suffixes(spark: SparkSession, folder: str) -> DataFrame:
    kept = suffix.drop_repeated_bytes(table(spark, folder, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", F.size("removed").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op4_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find(narrow(table(spark, folder, "documents")))
    return found.select(
        "row.doc_id", *_counts(pii.BASE_KINDS), F.sha2(_spans(F.col("spans"), pii.BASE_KINDS), 256).alias("base_sha256"), _spans(F.col("spans")).alias("spans"),
    )


def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    scored = toxicity.classify(narrow(table(spark, folder, "documents")), table(spark, folder, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


def op6_factors(spark: SparkSession, folder: str) -> DataFrame:
    kept = factors.drop_repeated_words(table(spark, folder, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op7_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_contamination(spark: SparkSession, folder: str) -> DataFrame:
    found = contamination.find_matches(narrow(table(spark, folder, "documents")), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


def op9_lines(spark: SparkSession, folder: str) -> DataFrame:
    kept = lines.drop_repeated_lines(narrow(table(spark, folder, "documents")))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


OP9_SQL = r"""
WITH doc AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
line AS (
  SELECT doc_id, n, parts[n] AS line,
    translate(trim(parts[n], ' ' || chr(9) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS n FROM doc)
),
frequent AS (
  SELECT key, max(doc_id) AS keeper FROM line WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
),
marked AS (SELECT l.*, f.key IS NOT NULL AND l.doc_id <> f.keeper AS dropped FROM line l LEFT JOIN frequent f USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

def op10_piecewise(spark: SparkSession, folder: str) -> DataFrame:
    return piecewise.with_next(table(spark, folder, "documents"))


OP6_SQL = r"""
WITH doc AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(w[i:i + 34], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM doc WHERE len(w) >= 35)
),
twice AS (SELECT s FROM win GROUP BY s HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS n FROM win SEMI JOIN twice USING (s)),
word AS (SELECT doc_id, n, w[n] AS word FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS n FROM doc)),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY n) AS text FROM word ANTI JOIN gone USING (doc_id, n) GROUP BY doc_id),
lost AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(lost.n, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM doc LEFT JOIN lost USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

OP8_SQL = r"""
WITH item AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
),
item_win AS (
  SELECT DISTINCT id, size, array_to_string(w[i:i + size - 1], ' ') AS s
  FROM (SELECT id, w, least(13, len(w)) AS size, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM item WHERE len(w) > 0)
),
doc AS (
  SELECT doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
),
doc_win AS (
  SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS s
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM doc JOIN (SELECT DISTINCT size FROM item_win) ON len(w) >= size)
),
met AS (SELECT DISTINCT doc_id, size, i, id FROM doc_win JOIN item_win USING (size, s)),
hit AS (SELECT doc_id, count(DISTINCT n) AS n FROM (SELECT doc_id, unnest(range(i, i + size)) AS n FROM met) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT doc_id, id FROM met) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(named.n, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(hit.n, 0) > 0 AND 20 * coalesce(hit.n, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""

def op11_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(table(spark, folder, "documents"))


OP11_SQL = r"""
WITH doc AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
),
kept AS (SELECT lang, term FROM (SELECT lang, unnest(list_distinct(w)) AS term FROM doc) GROUP BY ALL HAVING count(*) >= 30),
occurs AS (SELECT lang, source, term, count(*) AS n FROM (SELECT lang, source, unnest(w) AS term FROM doc) SEMI JOIN kept USING (lang, term) GROUP BY ALL),
whole AS (SELECT lang, term, sum(n) AS n FROM occurs GROUP BY ALL),
v AS (SELECT lang, count(*) AS terms FROM kept GROUP BY ALL),
grp AS (SELECT DISTINCT lang, source FROM doc),
sums AS (SELECT lang, source, coalesce(sum(n), 0) AS total FROM grp LEFT JOIN occurs USING (lang, source) GROUP BY ALL),
share AS (
  SELECT g.lang, g.source, k.term, coalesce(o.n, 0) AS n,
    1 + (1000000000 * (coalesce(o.n, 0) + 5)::HUGEINT) // (s.total + 5 * v.terms)::HUGEINT AS p
  FROM grp g JOIN kept k USING (lang) JOIN v USING (lang) JOIN sums s USING (lang, source) LEFT JOIN occurs o USING (lang, source, term)
),
common AS (
  SELECT lang, term, 1 + (1000000000 * (n + 5)::HUGEINT) // (sum(n) OVER (PARTITION BY lang) + 5 * terms)::HUGEINT AS q FROM whole JOIN v USING (lang)
),
pair AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(d.value, 0) AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (
    SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value
    FROM share x JOIN share y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL
  ) d ON d.lang = a.lang AND d.source = a.source AND d.item = b.source
),
both_parts AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pair
  UNION ALL
  SELECT lang, source, 'term', term, p - q FROM share JOIN common USING (lang, term) WHERE share.n > 0 AND p > q
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM both_parts)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""

def op12_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.trie(prefix_trie.rebuilt(prefix_trie.sequences(table(spark, folder, "conversations"))))


OP12_SQL = r"""
WITH turn AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (
      PARTITION BY conv_id
      ORDER BY turn NULLS FIRST, left(sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), 32), strlen(text)
    ) AS k
  FROM conversations WHERE conv_id IS NOT NULL
),
conv AS (
  SELECT conv_id, conv_id - conv_id % 5 AS from_id,
    xor(4294967295::UBIGINT, list_reduce(
      list_concat([4294967295::UBIGINT], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: ascii(c)::UBIGINT)),
      lambda crc, c: list_reduce(list_concat([xor(crc, c)], list_transform(range(8), lambda r: r::UBIGINT)), lambda a, r: xor(a >> 1, 3988292384::UBIGINT * (a & 1)))
    )) % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM turn)
),
head AS (SELECT c.conv_id, t.k, t.role, t.text FROM conv c JOIN turn t ON t.conv_id = c.from_id AND t.k <= c.h),
said AS (
  SELECT conv_id, k, role, text FROM head
  UNION ALL
  SELECT t.conv_id, t.k - c.h + (SELECT count(*) FROM head WHERE head.conv_id = c.conv_id), t.role, t.text FROM turn t JOIN conv c USING (conv_id) WHERE t.k > c.h
),
path AS (
  SELECT conv_id, k AS depth, strlen(text) AS bytes, list({'r': role, 't': text}) OVER (PARTITION BY conv_id ORDER BY k) AS prefix FROM said
  UNION ALL
  SELECT conv_id, 0, 0, [] FROM conv
),
member AS (
  SELECT conv_id, depth, bytes, min(conv_id) OVER (PARTITION BY depth, prefix) AS node, max(depth) OVER (PARTITION BY conv_id) AS length FROM path
),
node AS (
  SELECT node, depth, any_value(bytes) AS bytes, count(*) AS n_convs, count(*) FILTER (depth = length) AS n_ends,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (depth = length), '')) AS ends_sha256
  FROM member GROUP BY node, depth
),
tree AS (SELECT n.*, p.node AS parent FROM node n LEFT JOIN member p ON p.conv_id = n.node AND p.depth = n.depth - 1),
kids AS (SELECT parent AS node, depth - 1 AS depth, count(*) AS n FROM tree WHERE depth > 0 GROUP BY ALL),
below AS (
  SELECT a.node, a.depth, sum((t.n_convs - 1) * t.bytes) AS saved, count(*) FILTER (kids.n IS NULL) AS leaves
  FROM tree t JOIN member a ON a.conv_id = t.node AND a.depth <= t.depth LEFT JOIN kids ON kids.node = t.node AND kids.depth = t.depth
  GROUP BY ALL
)
SELECT t.node AS conv_id, CAST(t.depth AS BIGINT) AS depth, t.parent AS parent_conv_id, t.n_convs, coalesce(kids.n, 0) AS n_children,
  below.leaves AS n_leaves, CAST(below.saved AS BIGINT) AS saved_tokens, t.ends_sha256
FROM tree t JOIN below USING (node, depth) LEFT JOIN kids USING (node, depth)
"""

def op13_urls(spark: SparkSession, folder: str) -> DataFrame:
    return url_templates.judge(table(spark, folder, "pages"))


def _op13_level(level: int) -> str:
    """CTEs of one level of the tree: children, named branches, bins, runs of bins, and the shapes with one segment more."""
    return rf"""
children{level} AS MATERIALIZED (
  SELECT host, template, segments[{level + 1}] AS segment, sum(labelled) AS labelled, sum(blocked) AS blocked,
    CASE WHEN sum(n) < 5 THEN '#*' ELSE segments[{level + 1}] END AS name
  FROM tree{level} WHERE len(segments) > {level} GROUP BY host, template, segments[{level + 1}]
),
named{level} AS MATERIALIZED (
  SELECT *, CASE WHEN labelled > 0 THEN (20 * (2 * blocked + 1)) // (2 * labelled + 2) END AS bin
  FROM (SELECT host, template, name, sum(labelled) AS labelled, sum(blocked) AS blocked FROM children{level} GROUP BY ALL)
),
bins{level} AS MATERIALIZED (
  SELECT host, template, bin, sum(labelled)::DOUBLE AS l, sum(blocked)::DOUBLE AS b, min(name) AS least, count(*) AS size
  FROM named{level} WHERE bin IS NOT NULL GROUP BY ALL
),
beside{level} AS (SELECT *, lag(l) OVER (PARTITION BY host, template ORDER BY bin) AS l0, lag(b) OVER (PARTITION BY host, template ORDER BY bin) AS b0 FROM bins{level}),
runs{level} AS MATERIALIZED (
  SELECT *, sum(CASE WHEN (b * l0 - b0 * l) * (b * l0 - b0 * l) * (l + l0) > 3.84::DOUBLE * (b + b0) * (l + l0 - b - b0) * l * l0 THEN 1 ELSE 0 END)
    OVER (PARTITION BY host, template ORDER BY bin) AS run
  FROM beside{level}
),
branch{level} AS MATERIALIZED (
  SELECT host, template, bin, min(least) OVER w || CASE WHEN sum(size) OVER w > 1 THEN '#~' ELSE '' END AS branch
  FROM runs{level} WINDOW w AS (PARTITION BY host, template, run)
),
tree{level + 1} AS MATERIALIZED (
  SELECT t.host, t.shape, t.n, t.labelled, t.blocked, t.segments, t.template || coalesce('/' || coalesce(b.branch, m.name), '') AS template
  FROM tree{level} t
  LEFT JOIN children{level} c ON c.host = t.host AND c.template = t.template AND c.segment = t.segments[{level + 1}]
  LEFT JOIN named{level} m ON m.host = c.host AND m.template = c.template AND m.name = c.name
  LEFT JOIN branch{level} b ON b.host = m.host AND b.template = m.template AND b.bin = m.bin
)"""


OP13_SQL = rf"""
WITH rest AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
part AS (
  SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path
  FROM rest
),
rules(verdict, rule_host, rule_path) AS (VALUES
  ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')
),
fit AS (
  SELECT host, path, max_by(rule_host || rule_path, length(rule_host || rule_path)) AS rule, max_by(verdict, length(rule_host || rule_path)) AS verdict
  FROM (SELECT DISTINCT host, path FROM part) JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY ALL
),
ruled AS MATERIALIZED (
  SELECT p.*, rule, verdict, regexp_replace(p.path, '[0-9]+', '#', 'g') AS shape FROM part p LEFT JOIN fit f ON f.host = p.host AND f.path = p.path
),
tree0 AS MATERIALIZED (
  SELECT host, shape, count(*) AS n, count(verdict) AS labelled, count(*) FILTER (verdict = 'block') AS blocked, '' AS template,
    CASE WHEN shape = '' THEN [] WHEN len(string_split(shape, '/')) <= 9 THEN string_split(substr(shape, 2), '/')
      ELSE list_append(string_split(shape, '/')[2:8], array_to_string(string_split(shape, '/')[9:], '/')) END AS segments
  FROM ruled GROUP BY ALL
),
{",".join(_op13_level(level) for level in range(8))},
whole AS (SELECT coalesce(sum(blocked) / nullif(sum(labelled), 0), 0) AS share FROM tree0),
refused AS (
  SELECT host, template FROM tree8, whole GROUP BY host, template, share
  HAVING sum(labelled) > 0 AND (sum(blocked) + 5 * share) / (sum(labelled) + 5) > 0.8
),
refused_shape AS (SELECT host, shape FROM tree8 SEMI JOIN refused USING (host, template))
SELECT r.page_id, r.host, r.path, r.rule, coalesce(r.verdict, CASE WHEN s.host IS NOT NULL THEN 'block' END, 'allow') AS verdict
FROM ruled r LEFT JOIN refused_shape s ON s.host = r.host AND s.shape = r.shape
"""

QUERIES = {
    "op1_bpe": op1_bpe,
    "op2_secrets": op2_secrets,
    "op3_suffixes": op3_suffixes,
    "op4_pii": op4_pii,
    "op5_toxicity": op5_toxicity,
    "op6_factors": op6_factors,
    "op7_simhash": op7_simhash,
    "op8_contamination": op8_contamination,
    "op9_lines": op9_lines,
    "op10_piecewise": op10_piecewise,
    "op11_divergence": op11_divergence,
    "op12_trie": op12_trie,
    "op13_urls": op13_urls,
}
ORACLES: dict[str, str] = {
    "op6_factors": OP6_SQL, "op8_contamination": OP8_SQL, "op9_lines": OP9_SQL, "op11_divergence": OP11_SQL, "op12_trie": OP12_SQL, "op13_urls": OP13_SQL,
}
