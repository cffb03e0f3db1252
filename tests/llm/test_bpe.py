import base64
import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken
from fixtures import clashing, documents, empty, rows_of

from ticketlake.llm import bpe

RANKS = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_ids_are_those_of_the_library(spark, reference):
    docs = documents(spark)
    found = rows_of(bpe.encode(docs, RANKS, P.PATTERN))
    expected = []
    for row in docs.collect():
        ids = reference.encode_ordinary(row.text or "")
        expected.append((row.doc_id, len(ids), ids))
    assert found == sorted(expected, key=repr)


def test_decoding_is_exact(spark):
    docs = documents(spark, repeat=False)
    decoded = dict(bpe.decode(bpe.encode(docs, RANKS, P.PATTERN), RANKS, P.PATTERN).collect())
    assert {k: bytes(v) for k, v in decoded.items()} == {r.doc_id: (r.text or "").encode() for r in docs.collect()}


def test_other_columns_do_no_harm(spark):
    docs = documents(spark)
    assert rows_of(bpe.encode(clashing(docs), RANKS, P.PATTERN, True)) == rows_of(bpe.encode(docs, RANKS, P.PATTERN, True))
    assert bpe.encode(empty(spark), RANKS, P.PATTERN).count() == 0


@pytest.mark.parametrize("alphabet", ["a", "ab", "the andtioner", " ", "0123456789", "日本語"])
def test_long_pieces(reference, alphabet):
    rng = random.Random(3)
    coder = bpe.coder(RANKS, P.PATTERN)
    pieces = ["".join(rng.choice(alphabet) for _ in range(n)).encode() for n in (1, 7, 199, 200, 201, 700)]
    ids, decoded = coder.encode_pieces(pieces)
    assert ids == [list(reference._core_bpe.encode_single_piece(p)) for p in pieces]
    assert decoded == pieces


@pytest.mark.parametrize(("alphabet", "length"), [("abcdefghijklmnopqrstuvwxyz", 200_000), ("".join(map(chr, range(0x4E00, 0x5E00))), 200_000), ("a", 1_000_000)])
def test_a_run_of_any_length_is_encoded_whole(spark, reference, alphabet, length):
    """Through Spark, beside other texts; memory grows with the length, not with its square."""
    rng = random.Random(7)
    texts = ["".join(rng.choices(alphabet, k=length)), "short", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1)
    found = {r.doc_id: r for r in bpe.encode(docs, RANKS, P.PATTERN).collect()}
    assert [found[k].ids for k in range(3)] == [reference.encode_ordinary(t or "") for t in texts]
    digests = {r.doc_id: r.decoded_sha256 for r in bpe.encode(docs, RANKS, P.PATTERN, True).collect()}
    assert digests == {k: hashlib.sha256((t or "").encode()).hexdigest() for k, t in enumerate(texts)}


def test_what_a_worker_remembers_is_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED_BYTES", 20_000)
    own = bpe.Coder(RANKS, P.PATTERN)
    for k in range(30):
        words = [f"word{k}x{j}" for j in range(50)]
        own.learn(words)
        assert own.held < 20_000 + 50 * 300 and all(w in own.ids for w in words)
        assert own.decoded(words) == "".join(words).encode()
    assert own.held == sum(bpe._weight(w, x) for w, x in own.ids.items())


def test_contraction_stops_for_a_lower_rank(tmp_path):
    """ab ranks above abc here: after the first ab, abc comes before the second ab."""
    tokens = [bytes([b]) for b in range(256)] + [b"bc", b"abc", b"ca", b"ab", b"aba"]
    path = tmp_path / "ranks"
    path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % k for k, t in enumerate(tokens)))
    own = bpe.Coder(str(path), P.PATTERN)
    piece = b"ababab" * 50 + b"cabc" * 40
    reference = tiktoken.Encoding("small", pat_str=P.PATTERN, mergeable_ranks={t: k for k, t in enumerate(tokens)}, special_tokens={})
    assert own.encode_pieces([piece, piece[:40]])[0] == [list(reference._core_bpe.encode_single_piece(p)) for p in (piece, piece[:40])]
