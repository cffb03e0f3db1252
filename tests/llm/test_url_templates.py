"""Host, path and rule against plain parsing; the tree against a plain one, node by node; no Python in the plan."""

from __future__ import annotations

import random
import re
from collections import defaultdict

import pytest
from fixtures import clashing, empty, rows_of

from ticketlake.llm import url_templates

SCHEMA = "page_id bigint, url string, html string"


def _pages() -> list[tuple]:
    rng = random.Random(13)
    odd = [
        None, "", "no address", "http://", "http://HOST.Example.COM", "x://a.net?q=/es/1", "://net/es/", "ftp://com/", "http://example.com/en", "http://example.com/en/",
        "http://badexample.com/en/1", "http://WWW.Example.com/en/?a#b", "http://a.www.example.com/en/x", "http://net/ES/1", "http://é.net/fr/\n9", "http://a.com#x/y",
        "http://a.org/" + "s/" * 40, "http://a.org/" + "long" * 50_000, "http://a.org//7//", "http://b.org/#*/1", "http://a://b.com/c",
    ]
    hosts = ["a.example.com", "www.example.com", "b.example.net", "c.net", "one.org"]
    made = [
        f"https://{rng.choice(hosts)}/{rng.choice(['en', 'en', 'es', 'fr', 'de', 'q7', 'w' + str(rng.randrange(9999))])}"
        f"{rng.choice(['', '/'])}{rng.choice(['', '/' + str(rng.randrange(500)), '/x/' + str(rng.randrange(50)) + '.html', '/list'])}{rng.choice(['', '?a=/en/', '#top'])}"
        for _ in range(900)
    ]
    blocked = [f"http://www.example.com.example.com/en/{k}" for k in range(600)]
    rare = [f"http://few.net/{s}/{k}" for s in ("es", "fr") for k in range(4)] + ["http://few.net/da/1", "http://few.net/sv/12"]
    urls = odd + made + made[:60] + blocked + rare
    return [(k if k % 17 else None, u, "<p>") for k, u in enumerate(urls)]


def _split(url):
    rest = url[url.index("://") + 3 :] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host) :]).group()
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def _rule(host, path):
    fits = [(h + p, v) for v, h, p in url_templates.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits, key=lambda f: len(f[0]), default=(None, None))


def _plain(pages):
    """Counts per shape, then one level after another over all nodes."""
    judged = [(page_id, *_split(url)) for page_id, url, _ in pages]
    judged = [(page_id, host, path, *_rule(host, path)) for page_id, host, path in judged]
    shapes = defaultdict(lambda: [0, 0, 0])
    for _, host, path, _, verdict in judged:
        c = shapes[host, re.sub("[0-9]+", "#", path)]
        c[0] += 1
        c[1] += verdict is not None
        c[2] += verdict == "block"
    segments = {(h, s): s[1:].split("/", url_templates.DEPTH - 1) if s else [] for h, s in shapes}
    template = dict.fromkeys(shapes, "")
    for level in range(url_templates.DEPTH):
        nodes = defaultdict(lambda: defaultdict(list))
        for key, parts in segments.items():
            if len(parts) > level:
                nodes[key[0], template[key]][parts[level]].append(key)
        for children in nodes.values():
            names = {s: s if sum(shapes[k][0] for k in keys) >= url_templates.SUPPORT else "#*" for s, keys in children.items()}
            stats = defaultdict(lambda: [0, 0])
            for s, keys in children.items():
                for k in keys:
                    stats[names[s]][0] += shapes[k][1]
                    stats[names[s]][1] += shapes[k][2]
            bins = defaultdict(list)
            for name, (labelled, blocked) in stats.items():
                if labelled:
                    bins[20 * (2 * blocked + 1) // (2 * labelled + 2)].append(name)
            runs, before = [], None
            for _, members in sorted(bins.items()):
                now = tuple(sum(stats[m][i] for m in members) for i in (0, 1))
                if before:
                    (l0, b0), (l1, b1) = before, now
                    pooled = (b0 + b1) / (l0 + l1)
                    together = (b0 / l0 - b1 / l1) ** 2 <= 3.84 * pooled * (1 - pooled) * (1 / l0 + 1 / l1)
                if before and together:
                    runs[-1] += members
                else:
                    runs.append(list(members))
                before = now
            branch = {m: min(run, key=str.encode) + ("#~" if len(run) > 1 else "") for run in runs for m in run}
            for s, keys in children.items():
                for k in keys:
                    template[k] += "/" + branch.get(names[s], names[s])
    labelled, blocked = (sum(c[i] for c in shapes.values()) for i in (1, 2))
    sums = defaultdict(lambda: [0, 0])
    for (host, shape), c in shapes.items():
        sums[host, template[host, shape]][0] += c[1]
        sums[host, template[host, shape]][1] += c[2]
    share = blocked / labelled if labelled else 0
    refused = {t for t, (n, b) in sums.items() if n and (b + 5 * share) / (n + 5) > 0.8}
    out = []
    for page_id, host, path, rule, verdict in judged:
        learned = "block" if (host, template[host, re.sub("[0-9]+", "#", path)]) in refused else "allow"
        out.append((page_id, host, path, rule, verdict or learned))
    return sorted(out, key=repr)


def test_every_page_is_judged_like_a_plain_tree(spark):
    pages = _pages()
    found = rows_of(url_templates.judge(clashing(spark.createDataFrame(pages, SCHEMA).repartition(3))))
    assert found == _plain(pages)
    assert any(rule is None and verdict == "block" for *_, rule, verdict in found)


@pytest.mark.parametrize("rules", [(), (("block", "org", "/"),)])
def test_other_rules(spark, rules):
    found = url_templates.judge(spark.createDataFrame([(1, "http://x.org/a", ""), (2, "http://x.com/a", "")], SCHEMA), rules)
    assert rows_of(found.select("page_id", "rule", "verdict")) == [(1, "org/" if rules else None, "block" if rules else "allow"), (2, None, "allow")]


def test_no_pages(spark):
    assert url_templates.judge(empty(spark, SCHEMA)).collect() == []


def test_equal_branches_merge_and_different_ones_stay(spark):
    rows = [("h.x", f"/{s}/#", "block" if s in "ab" else "allow") for s in "abc" for _ in range(30)] + [("h.x", "/d/#", None)] * 9
    ruled = spark.createDataFrame(rows, "host string, shape string, verdict string")
    found = {r["shape"]: (r["template"], r["rejected"]) for r in url_templates.templates(ruled).collect()}
    assert found == {"/a/#": ("/a#~/#", True), "/b/#": ("/a#~/#", True), "/c/#": ("/c/#", False), "/d/#": ("/d/#", False)}


def test_no_python_in_the_plan(spark):
    plan = url_templates.judge(spark.createDataFrame(_pages(), SCHEMA))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
