import random
import zlib

import numpy as np
from fixtures import clashing, empty, words

from ticketlake.llm import toxicity


def labelled(spark, count=400):
    rng = random.Random(9)
    rows, labels = [], []
    for k in range(count):
        own = words(rng, rng.choice((20, 60)))
        toxic = k % 4 == 0
        if toxic:
            for _ in range(3):
                own.insert(rng.randrange(len(own)), rng.choice(("vile", "Rotten!", "nasty")))
        rows.append((k, " ".join(own)))
        labels.append((k, int(toxic)))
    docs = spark.createDataFrame([*rows, (10_000, None), (10_001, ""), (None, "no id"), rows[7]], "doc_id bigint, text string")
    return docs, spark.createDataFrame([*labels, labels[3], (None, 1), (5, None)], "doc_id bigint, toxic int"), dict(labels)


def test_held_out_accuracy(spark):
    docs, labels, truth = labelled(spark)
    found = toxicity.classify(clashing(docs), labels).collect()
    assert len(found) == docs.count()
    own = {r.doc_id: r for r in found}
    for key, row in own.items():
        assert row.held_out == (key is not None and zlib.crc32(str(key).encode()) % 5 == 0)
        assert 0 <= row.score <= 1 and row.predicted == int(row.score >= 0.5)
    judged = [k for k in truth if own[k].held_out]
    assert len(judged) > 40
    assert np.mean([own[k].predicted == truth[k] for k in judged]) > 0.93


def test_held_out_labels_do_not_matter(spark):
    docs, labels, _ = labelled(spark, 150)
    flipped = labels.selectExpr("doc_id", "IF(crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 5 = 0, 1 - toxic, toxic) AS toxic")
    scores = [{(r.doc_id, r.score) for r in toxicity.classify(docs, x).collect()} for x in (labels, flipped)]
    assert scores[0] == scores[1]


def test_nothing_to_learn_from(spark):
    docs, labels, _ = labelled(spark, 20)
    assert {r.predicted for r in toxicity.classify(docs, labels.where("toxic = 0")).collect()} == {0}
    assert {r.predicted for r in toxicity.classify(docs, empty(spark, "doc_id bigint, toxic int")).collect()} == {0}
    assert toxicity.classify(empty(spark), labels).count() == 0
