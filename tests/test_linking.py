"""Linking against a sequential walk, with slices small enough to hand notices over."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ticketlake.operators import linking
from ticketlake.operators.linking import RULES, ambiguous_candidates, attach_links, link_candidates, link_tickets, load_manual
from ticketlake.operators.timelines import along

SIDE = "ticket_id bigint, matricula string, protocolo_referencia string, assunto_normalizado string, data_criacao timestamp_ntz"
MANUAL = "ticket_solicitacao_id string, ticket_notificacao_id string, justificativa string, usuario string, atualizado_em timestamp_ntz"
T0 = datetime(2024, 1, 1)


def walk(requests, notices, manual):
    """(status, rule, notice, count) of each request, one after the other."""
    by_id = {n[0]: n for n in notices}
    named = {m[0]: m[1] for m in manual}
    used, out = set(), {}
    late = datetime.max
    for rid, account, protocol, subject, at in sorted(requests, key=lambda r: (r[4] or late, r[0])):
        if rid in named:
            known = named[rid] in by_id
            out[rid] = ("MANUAL", "manual", named[rid], 1) if known else ("SEM_VINCULO", "manual_invalido", None, 0)
            if known:
                used.add(named[rid])
            continue
        out[rid] = ("SEM_VINCULO", None, None, 0)
        for rule, index in ((RULES[0][0], 2), (RULES[1][0], 3)):
            value = (protocol, subject)[index - 2]
            if not account or not account.strip() or not value or not value.strip() or at is None:
                continue
            found = sorted(
                (n for n in notices if n[0] not in used and n[1] == account and n[index] == value and n[4] is not None and timedelta(0) <= at - n[4] <= timedelta(days=7)),
                key=lambda n: (n[4], n[0]),
            )
            if found:
                if len(found) == 1:
                    used.add(found[0][0])
                    out[rid] = ("VINCULADO", rule, found[0][0], 1)
                else:
                    out[rid] = ("AMBIGUO", rule, None, len(found), ", ".join(str(n[0]) for n in found[:10]))
                break
    return out


def random_case(seed, size):
    rnd = random.Random(seed)
    when = lambda: None if rnd.random() < 0.03 else T0 + timedelta(hours=rnd.randint(0, 24 * rnd.choice([10, 40])))
    # One account holds most rows.
    side = lambda i: (i, rnd.choice(["A", "A", "A", "B", None, " "]), rnd.choice([None, None, "p1", "p2", " "]), rnd.choice([None, "s1", "s2", "s3"]), when())
    requests = [side(i) for i in range(size)]
    notices = [side(1000 + i) for i in range(size)]
    manual = [(i, rnd.choice([1000 + rnd.randrange(size), 5000]), "j") for i in rnd.sample(range(size), size // 10)]
    return requests, notices, manual


def linked(spark, requests, notices, manual, slice_rows):
    links = spark.createDataFrame([(str(a), str(b), c, "u", T0) for a, b, c in manual], MANUAL)
    df = link_tickets(
        spark.createDataFrame(requests, SIDE), spark.createDataFrame(notices, SIDE),
        load_manual(links) if manual else None, slice_rows=slice_rows,
    )
    out = {}
    for r in df.collect():
        row = (r["status_vinculo"], r["criterio_vinculo"], r["ticket_notificacao_id"], r["quantidade_candidatos"])
        if r["status_vinculo"] == "AMBIGUO":
            row += (r["observacao"].split(": ")[1],)
        out[r["ticket_solicitacao_id"]] = row
    return out


@pytest.mark.parametrize("seed,size,slice_rows", [(1, 60, 1000), (2, 80, 15), (3, 80, 9), (4, 60, 20), (5, 100, 12)])
def test_equals_sequential_walk(spark, seed, size, slice_rows):
    case = random_case(seed, size)
    assert linked(spark, *case, slice_rows) == walk(*case)


def test_alternating_chain_in_one_account(spark):
    """Each request depends on the one before it, across every slice."""
    requests = [(i, "A", None, "s", T0 + timedelta(hours=2 * i + 1)) for i in range(40)]
    notices = [(1000 + i, "A", None, "s", T0 + timedelta(hours=2 * i)) for i in range(40)]
    assert linked(spark, requests, notices, [], 11) == walk(requests, notices, [])


def test_window_edges_and_manual(spark):
    week = timedelta(days=7)
    notices = [(10, "A", None, "s", T0), (11, "B", None, "s", T0), (12, "C", None, "s", T0), (13, "D", None, "s", T0)]
    requests = [
        (1, "A", None, "s", T0 + week), (2, "B", None, "s", T0 + week + timedelta(seconds=1)), (3, "C", None, "s", T0 + timedelta(days=2)),
        (4, "Z", None, None, T0 + timedelta(days=1)), (5, "D", None, "s", T0 + timedelta(days=1)), (6, "Q", None, "s", T0 + timedelta(days=2)), (7, "Q", None, "s", T0),
    ]
    manual = [(4, 12, "j"), (6, 13, "j"), (7, 99, "j")]  # 12 is taken before its turn, 13 only after
    got = linked(spark, requests, notices, manual, 1000)
    assert got == walk(requests, notices, manual)
    assert got[1][0] == "VINCULADO" and got[2][0] == "SEM_VINCULO" and got[3][0] == "SEM_VINCULO"
    assert got[4][0] == "MANUAL" and got[5][0] == "VINCULADO" and got[6][0] == "MANUAL" and got[7][1] == "manual_invalido"


def test_without_notices(spark):
    requests = spark.createDataFrame([(1, "A", None, "s", T0)], SIDE)
    links = link_tickets(requests, None)
    assert links.first()["status_vinculo"] == "NOTIFICACAO_NAO_CARREGADA"
    tickets = requests.select("ticket_id", "data_criacao")
    assert attach_links(tickets, links).first()["ticket_solicitacao_id"] == 1
    assert attach_links(tickets, None).first()["status_vinculo"] == "NOTIFICACAO_NAO_CARREGADA"


def test_candidate_counts(spark):
    requests, notices, _ = random_case(7, 120)
    expected = {}
    for rid, account, protocol, subject, at in requests:
        for rule, index in ((RULES[0][0], 2), (RULES[1][0], 3)):
            value = (protocol, subject)[index - 2]
            if not account or not account.strip() or not value or not value.strip() or at is None:
                continue
            count = sum(1 for n in notices if n[1] == account and n[index] == value and n[4] is not None and timedelta(0) <= at - n[4] <= timedelta(days=7))
            if count:
                expected[(rid, rule)] = count
    got = link_candidates(spark.createDataFrame(requests, SIDE), spark.createDataFrame(notices, SIDE))
    assert {(r[0], r[1]): r[2] for r in got.collect()} == expected


def test_candidates_of_every_ambiguous_request(spark):
    """The whole list, also beyond the ids of the note; notices taken before are not in it."""
    requests = [(i, "A", None, "s", T0 + timedelta(hours=50 + i)) for i in range(5)] + [(9, "A", "p", None, T0 + timedelta(hours=20))]
    notices = [(1000 + i, "A", "p" if i == 3 else None, "s", T0 + timedelta(hours=i)) for i in range(30)] + [(2000, "B", None, "s", T0)]
    sides = [spark.createDataFrame(rows, SIDE) for rows in (requests, notices)]
    links = link_tickets(*sides, slice_rows=9)
    got = sorted((r[0], r[2]) for r in ambiguous_candidates(links, *sides).collect())
    assert got == [(i, 1000 + k) for i in range(5) for k in range(30) if k != 3]


def test_joins_settle_nearly_all(spark):
    """One account and subject holds a third of all rows; less than a tenth of the rows that could meet is walked."""
    rnd = random.Random(5)
    requests, notices = [], []
    for i in range(900):
        hot = i % 3 == 0
        at = T0 + timedelta(hours=70 * i) if hot else T0 + timedelta(hours=rnd.randrange(9000))
        key = ("A", None, "s") if hot else (f"c{i % 200}", f"p{rnd.randrange(3)}", rnd.choice(["s", "u", None]))
        notices.append((10_000 + i, *key, at))
        requests.append((i, *key, at + timedelta(hours=rnd.choice([1, 2, 30]))))
    slim = [linking._slim(spark.createDataFrame(rows, SIDE)) for rows in (requests, notices)]
    consumed = slim[1].selectExpr("ticket_id AS alvo", "conta", "t", "ticket_id").limit(0)
    done, left, remaining = linking.peel(*slim, consumed, slice_rows=150)
    walked = linking._with_partner(left, remaining).count() + linking._with_partner(remaining, left).count()
    could_meet = linking._with_partner(*slim).count() + linking._with_partner(*slim[::-1]).count()
    assert walked < 0.1 * could_meet and done.count() > 500
    case = (requests, notices, [])
    assert linked(spark, *case, 150) == walk(*case)


@pytest.mark.parametrize("slice_rows", [10**6, 25, 3])
def test_running_figures_do_not_depend_on_the_slices(spark, slice_rows):
    from pyspark.sql import functions as F

    rnd = random.Random(8)
    rows = [(rnd.choice("aaaab"), rnd.randrange(40), i, rnd.random() < 0.6) for i in range(150)]
    df = spark.createDataFrame(rows, "g string, t bigint, id bigint, note boolean")
    found = along(df, ["g"], ["t", "id"], F.col("note"), F.when(~F.col("note"), F.struct("t", "id")), slice_rows).collect()
    order = sorted(rows, key=lambda r: r[:3])
    for r in found:
        own = [x for x in order if x[0] == r.g]
        at = own.index((r.g, r.t, r.id, r.note))
        assert r.total == sum(x[3] for x in own[: at + 1])
        after = [x for x in own[at + 1 :] if not x[3]]
        assert (tuple(r.seguinte) if r.seguinte else None) == (after[0][1:3] if after else None)
    assert len(found) == 150


def test_a_slice_that_hands_over_less_reaches_the_next(spark):
    """Long dependence through slices of two rows, walked without peeling."""
    requests = [(i, "A", None, "s", T0 + timedelta(hours=3 * i + 2)) for i in range(30)]
    notices = [(1000 + i, "A", None, "s", T0 + timedelta(hours=3 * i)) for i in range(30)] + [(1500, "A", None, "s", T0 + timedelta(hours=1))]
    slim = [linking._slim(spark.createDataFrame(rows, SIDE)) for rows in (requests, notices)]
    consumed = slim[1].selectExpr("ticket_id AS alvo", "conta", "t", "ticket_id").limit(0)
    rows = {r.ticket_id: (r.candidatos, r.notificacao) for r in linking.serve_in_order(*slim, consumed, 7, 2).collect()}
    want = {k: v for k, v in walk(requests, notices, []).items() if v[0] != "SEM_VINCULO"}
    assert {k: v[0] for k, v in rows.items()} == {k: v[3] for k, v in want.items()}
    assert {k: v[1] for k, v in rows.items()} == {k: v[2] for k, v in want.items()}


def far_sides(spark):
    """Same account and subject throughout; three requests come a day after a notice, the others twelve days after one."""
    at = lambda first, hours: [(first + i, "A", None, "s", T0 + timedelta(days=30 * i, hours=hours if i < 3 else 24 * 12 * (first == 0))) for i in range(60)]
    return [spark.createDataFrame(rows, SIDE) for rows in (at(0, 24), at(1000, 0))]


def test_rows_far_from_the_other_side_enter_no_round(spark, monkeypatch):
    entered, peel = [], linking.peel

    def counted(requests, notices, *rest):
        entered.append((requests.count(), notices.count()))
        return peel(requests, notices, *rest)

    monkeypatch.setattr(linking, "peel", counted)
    rows = {r.ticket_solicitacao_id: (r.status_vinculo, r.ticket_notificacao_id) for r in link_tickets(*far_sides(spark)).collect()}
    assert rows == {i: ("VINCULADO", 1000 + i) if i < 3 else ("SEM_VINCULO", None) for i in range(60)}
    ((requests, notices),) = entered
    assert requests + notices < 60, entered


def test_keys_are_worked_out_near_the_other_side_only(spark):
    worked = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def subject(text):
        worked.add(1)
        return text

    requests, notices = far_sides(spark)
    raw = [df.withColumnRenamed("assunto_normalizado", "titulo").drop("protocolo_referencia") for df in (requests, notices)]
    keys = lambda df: df.withColumns({"assunto_normalizado": subject("titulo"), "protocolo_referencia": F.lit(None).cast("string")})
    links = link_tickets(*raw, keys=keys)
    assert links.exceptAll(link_tickets(requests, notices)).isEmpty()
    assert ambiguous_candidates(links, *raw, keys=keys).isEmpty()
    assert 6 <= worked.value < 60, worked.value


def test_requests_on_the_borders_of_their_window(spark):
    """A notice exactly as old as the window counts, at and beside the borders of the stretches, before 1970 too."""
    micro, week = timedelta(microseconds=1), timedelta(days=7)
    starts = [datetime(1970, 1, 1) + k * week + d for k in (-3, -1, 0, 1, 2900) for d in (-micro, timedelta(0), micro)]
    requests = [(10 * i + j, f"c{i}-{j}", None, "s", at) for i, at in enumerate(starts) for j in range(3)]
    notices = [(9000 + r[0], *r[1:4], r[4] - (week if r[0] % 10 == 0 else week + micro if r[0] % 10 == 1 else timedelta(0))) for r in requests]
    case = (requests, notices, [])
    assert linked(spark, *case, 1000) == walk(*case)
