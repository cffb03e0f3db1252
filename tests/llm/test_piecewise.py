import hashlib
import random

from fixtures import clashing, documents, empty, words

from ticketlake.llm import piecewise


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], before if x == y else 1 + min(row[j], row[j - 1])
    return row[-1]


def test_edit_distance():
    rng = random.Random(4)
    for _ in range(300):
        a, b = ("".join(rng.choice("abcd") for _ in range(rng.randrange(40))) for _ in range(2))
        assert piecewise.edit_distance(a, b) == plain_distance(a, b)


def test_next_documents(spark):
    docs = documents(spark, repeat=False)
    rows = sorted(docs.collect(), key=lambda r: r.doc_id)
    found = {r.doc_id: r for r in piecewise.with_next(clashing(docs)).collect()}
    assert len(found) == len(rows)
    for k, row in enumerate(rows):
        text, following = row.text or "", rows[(k + 1) % len(rows)].text or ""
        half = len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        own = found[row.doc_id]
        assert own.n_chars == len(text)
        assert own.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert own.fingerprint == piecewise.fingerprint(text)
        assert own.edited_fingerprint == piecewise.fingerprint(changed)
        assert own.near_edited == piecewise.likeness(own.fingerprint, own.edited_fingerprint)
        assert own.near_next == piecewise.likeness(own.fingerprint, piecewise.fingerprint(following))


def test_repeated_rows_and_few_rows(spark):
    assert piecewise.with_next(documents(spark)).count() == documents(spark).count()
    assert piecewise.with_next(empty(spark)).count() == 0
    one = piecewise.with_next(spark.createDataFrame([(1, "only one here")], "doc_id bigint, text string")).first()
    assert one.near_next == 1.0


def test_likeness_orders_edits():
    rng = random.Random(8)
    near, far = [], []
    for _ in range(60):
        text, other = (" ".join(words(rng, 400)) for _ in range(2))
        cut = rng.randrange(len(text))
        slight = text[:cut] + "!" + text[cut + 5 :]
        prints = [piecewise.fingerprint(x) for x in (text, slight, piecewise.edited(text, other), other)]
        slightly, half, none = (piecewise.likeness(prints[0], p) for p in prints[1:])
        near.append(slightly > half)
        far.append(half > none)
    assert sum(near) >= 58 and sum(far) >= 58
