import hashlib

from fixtures import SCHEMA, documents, empty, rows_of
from test_lines_contamination import expected_lines, expected_matches
from test_simhash import plain_fingerprint, plain_roots

import __spark_entry__
import corpus_pipeline as pipeline

SF = "/root/testdata/sf0.001"


def test_stages_follow_their_rules(spark):
    """Every stage against a plain version, over the table of the small scale, each on what the one before kept."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    before = docs
    for name, stage in pipeline.STAGES:
        after = spark.createDataFrame(stage(spark, before, SF).collect(), before.schema if stage is not pipeline.encode else None)
        rows, kept = before.collect(), after.collect()
        ids = {r.doc_id for r in kept}
        if stage is pipeline.drop_toxic:
            gone = [labels[r.doc_id] for r in rows if r.doc_id not in ids and r.doc_id in labels]
            stay = [labels[r.doc_id] for r in kept if r.doc_id in labels]
            assert set(rows_of(after)) <= set(rows_of(before)) and gone and sum(gone) >= 0.9 * len(gone) and sum(stay) <= 0.1 * len(stay)
        elif stage is pipeline.drop_lines:
            assert sorted(((r.doc_id, r.text) for r in kept), key=repr) == [x[:2] for x in expected_lines(rows)]
            assert all(r.n_chars == len(r.text) for r in kept)
        elif stage is pipeline.drop_near_copies:
            rows.sort(key=lambda r: r.doc_id)
            roots = plain_roots([plain_fingerprint(r.text) for r in rows])
            assert ids == {rows[k].doc_id for k in roots} and set(rows_of(after)) <= set(rows_of(before))
        elif stage is pipeline.drop_contaminated:
            assert ids == {x[0] for x in expected_matches(rows, benchmark) if not x[-1]}
        else:
            texts = {r.doc_id: r.text for r in rows}
            assert {r.doc_id: r.decoded_sha256 for r in kept} == {k: hashlib.sha256(t.encode()).hexdigest() for k, t in texts.items()}
        if stage is not pipeline.encode:
            assert after.columns == docs.columns, name
        before = after


def test_rows_that_share_an_id_are_judged_by_their_own_text(spark):
    """One of the three has a near copy; the other row of its id has none and stays. Equal rows become one."""
    near = " ".join(f"word{k}" for k in range(300))
    rows = [(1, near), (2, near + " end"), (2, "quite another text of its own, " * 9), (None, "no id"), (None, "no id"), (5, "twice"), (5, "twice"), (None, None), (7, "")]
    docs = spark.createDataFrame([(k, t, "en", "s", None) for k, t in rows], SCHEMA)
    kept = rows_of(pipeline.drop_near_copies(spark, docs, SF).select("doc_id", "text"))
    assert kept == sorted([(1, near), (2, "quite another text of its own, " * 9), (None, "no id"), (5, "twice"), (7, "")], key=repr)


def test_run_gives_what_the_stages_give(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert rows_of(pipeline.run(spark, SF)) == rows_of(docs)


def test_awkward_rows_pass_every_stage(spark):
    for docs in (documents(spark), empty(spark, SCHEMA)):
        for _, stage in pipeline.STAGES[:-1]:
            assert stage(spark, docs, SF).columns == docs.columns
            stage(spark, docs, SF).collect()
        pipeline.encode(spark, docs, SF).collect()


def test_all_queries_are_registered():
    names = set(__spark_entry__.queries())
    assert {f"op{n}_" for n in range(1, 14)} == {x[: x.index("_") + 1] for x in names if x.startswith("op") and x[2].isdigit()}
    assert "pipeline" in names and "op9_lines" in __spark_entry__.oracle_sql()
