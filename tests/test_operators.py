"""Rules, intake, deduplication, orders and persistence on small frames."""

import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from ticketlake.operators import dedup, orders, persistence, quality, rules
from ticketlake.schemas import HISTORY, TICKET_ALIASES, TICKET_FEED
from ticketlake.sources import canonical, files

AT, LATER = datetime(2024, 1, 1, 8), datetime(2024, 1, 2, 8)


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def test_headers_and_canonicalize(spark):
    assert files.header_name("Número da Porta") == "numero_da_porta"
    assert files.header_name("ID-do-Ticket") == "id_do_ticket"
    raw = spark.createDataFrame(
        [("12.0", "Rua A", None), ("abc", "x", "y"), (None, None, "Rua B")],
        "`ID do ticket` string, Logradouro string, `Nome Logradouro` string",
    )
    got = canonical.canonicalize(raw, TICKET_ALIASES, TICKET_FEED)
    assert got.columns == list(TICKET_FEED)
    assert rows(got, "ticket_id", "logradouro", "titulo") == rows(
        spark.createDataFrame([(12, "Rua A", None), (None, "x", None), (None, "Rua B", None)], "a bigint, b string, c string"), "a", "b", "c"
    )
    assert rows(canonical.coerce_ids(raw.toDF("id", "b", "c"), "id"), "id") == [(12,)]


def test_delimited_and_discovery(spark, tmp_path):
    (tmp_path / "Base_GSS_1.csv").write_bytes("a;b\ncafé;1\n".encode("latin1"))
    (tmp_path / "base_gss_2.csv").write_text("a,b\ncafé,1\n", encoding="utf-8")
    (tmp_path / "~$Base_GSS_3.csv").write_text("x")
    (tmp_path / "outro.csv").write_text("x")
    for name in ("Base_GSS_1.csv", "base_gss_2.csv"):
        assert rows(files.read_delimited(spark, str(tmp_path / name)), "a", "b") == [("café", "1")]
    found = [r["arquivo"] for r in files.discover_sources(spark, str(tmp_path), ("BASE_GSS",)).collect()]
    assert sorted(found) == ["Base_GSS_1.csv", "base_gss_2.csv"]
    assert files.lookup_latest_file(spark, str(tmp_path), "óutro").first()["arquivo"] == "outro.csv"


def test_dedup(spark):
    df = spark.createDataFrame([(1, "2024-01-01", "old", 0), (1, "2024-01-02", "new", 1), (2, None, "x", 2), (2, "2024", "y", 3)], "id int, ts string, v string, row_seq int")
    assert rows(dedup.dedup_latest(df, ["id"], ["ts", "row_seq"]), "id", "v") == [(1, "new"), (2, "x")]
    assert rows(dedup.dedup_first(df, ["id"], ["ts", "row_seq"]), "id", "v") == [(1, "old"), (2, "y")]
    plan = dedup.dedup_latest(df, ["id"], ["ts", "row_seq"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # one row per key before and after the shuffle


def test_subjects(spark):
    df = spark.createDataFrame(
        [(1, "f", "Água", None, 1, "a", 0), (1, "f", "ESGOTO", None, 2, "a", 1), (1, "f", "agua ", None, 3, "b", 2), (2, "f", " ", "Título", 1, "a", 3), (3, "f", None, None, 1, "a", 4)],
        "ticket_id bigint, formulario_ticket string, assunto string, titulo string, arquivo_mtime int, arquivo_origem string, row_seq int",
    )
    subjects = dedup.ticket_subjects(df)
    assert rows(subjects, "ticket_id", "assunto_raw", "ordem_assunto", "flag_assunto_principal") == [(1, "ESGOTO", 2, 0), (1, "agua", 1, 1), (2, "Título", 1, 1)]
    metrics = dedup.attach_subject_metrics(spark.range(1, 4).withColumnRenamed("id", "ticket_id"), subjects)
    assert rows(metrics, "ticket_id", "qtde_assuntos_ticket", "flag_multiplos_assuntos") == [(1, 2, 1), (2, 1, 0), (3, 1, 0)]
    wide = dedup.pivot_subjects(df, ("row_seq",))
    assert [c for c in wide.columns if c.startswith("assunto_")] == ["assunto_1", "assunto_2", "assunto_3"]


def governed(spark, *pairs):
    return spark.createDataFrame(list(pairs), "ticket_id bigint, regra string")


def test_archive_override_audit(spark):
    g = governed(spark, (2, rules.ARCHIVED), (3, rules.ATTACHMENT_FIX), (9, rules.REMOVED), (5, rules.AUDIT_EXCEPTION))
    df = spark.createDataFrame(
        [
            (1, "[internal]Ticket Privado Oceano Canais de Atrito", "X", None, "PROCON Niterói", None),
            (2, "G", "X", None, None, None), (3, "G", "X", None, "A::PROCON", None), (4, "Outro", None, None, "Canais de Atrito::PROCON", None),
            (5, "[routing]Canais de Atrito N2", "X", None, "CEDOC", None), (6, "[routing] Canais de Atrito N2", None, None, "Canais de Atrito::CEDOC", None),
            (7, None, None, "informativo x anexo", "JECX", None), (9, "G", None, None, "JEC", None), (10, None, None, None, "JEC Niterói", None),
        ],
        "ticket_id bigint, grupo_tickets string, tipo_manifestacao string, classificacao_notificacoes string, tipo_solicitacao string, atribuido string",
    )
    df = rules.drop_removed(df, g)
    assert df.count() == 8
    df = rules.apply_overrides(rules.archive_flag(df, g), rules.bulk_overrides(g, "solicitacao"), g)
    flags = dict(rows(df, "ticket_id", "flag_arquivado_relatorio"))
    assert flags == {1: 1, 2: 1, 3: 1, 4: 0, 5: 0, 6: 0, 7: 1, 10: 0}
    audited = rules.audit_rules(df, g, AT)
    assert {r[0] for r in rows(audited.filter("flag_auditoria_classificacao = 1"), "ticket_id")} == {4, 5, 10}
    assert rows(audited.filter("ticket_id = 5"), "tipo_solicitacao", "tipo_solicitacao_original_auditoria", "motivo_auditoria_classificacao") == [("Reclame Aqui", "CEDOC", rules.EXCEPTION_REASON)]
    assert rows(audited.filter("ticket_id = 4"), "flag_arquivado_relatorio", "status_auditoria_classificacao", "canal_normalizado_auditoria") == [(1, rules.PENDING, "PROCON")]


def test_purge_stale(spark):
    tickets = spark.createDataFrame([(1, 1), (2, 0), (3, None)], "ticket_id bigint, flag_auditoria_classificacao int")
    audits = spark.createDataFrame([(1, "PENDENTE_VALIDACAO"), (2, " pendente_validacao"), (3, "VALIDADO"), (4, "PENDENTE_VALIDACAO")], "ticket_id bigint, status_auditoria string")
    assert rows(rules.purge_stale(audits, tickets, "status_auditoria"), "ticket_id") == [(1,), (3,)]


def test_contracts(spark):
    good = spark.createDataFrame([("1", "2024-01-01", "open", "Solicitações", "t", "c")], "`ID do ticket` string, `Criação do ticket - Carimbo de data/hora` string, `Status do ticket` string, `Formulário de ticket` string, `Assunto do ticket` string, `Tipos de Solicitações` string")
    assert quality.contract_issues(good, "zendesk_geral").count() == 0
    with pytest.raises(quality.ContractError):
        quality.validate_or_raise(good.drop("ID do ticket"), "zendesk_geral")
    gss = spark.createDataFrame([("1", "2", "2024", "s")], "Matricula string, `No. da O.S.` string, `Dt. Emissao` string, `Servico Executado` string")
    assert quality.contract_issues(gss, "gss").count() == 0
    assert quality.contract_issues(gss.filter("1 = 0"), "gss").count() == 0


def order_frame(spark, data):
    return spark.createDataFrame(
        data, "gss_os_id string, numero_os string, matricula string, data_emissao timestamp_ntz, status_os_gss string, tokens_servico array<string>"
    )


def test_enrichment(spark):
    t = spark.createDataFrame([(1, "40001", " ", "Niterói"), (2, None, None, None)], "ticket_id bigint, matricula string, bairro string, municipio string")
    o = spark.createDataFrame(
        [("1", "40001", "Centro", "Rio", None, None, None, None, None, None, None, AT, None, None), ("2", "40001", "Icaraí", None, None, None, None, None, None, None, None, LATER, None, None)],
        "gss_os_id string, matricula string, bairro string, municipio string, nome_logradouro string, endereco_requerente string, numero_porta string, complemento string, telefone string, nome_cliente string, nome_requerente string, data_emissao timestamp_ntz, data_execucao timestamp_ntz, data_agendamento timestamp_ntz",
    )
    assert rows(orders.enrich_missing(t, o), "ticket_id", "bairro", "municipio") == [(1, "Centro", "Niterói"), (2, None, None)]


def scored_by_hand(ticket, candidates):
    """Every candidate scored one by one."""
    scored = []
    for os in candidates:
        days = None if os[3] is None or ticket["dia"] is None else abs((ticket["dia"] - os[3].date()).days)
        ds = 0.0 if days is None else next((v for d, v in orders.DATE_BANDS if days <= d), 0.0)
        a, b = set(ticket["tokens"]), set(os[5])
        js = len(a & b) / len(a | b) if a and b else 0.0
        ss = 0.30
        if os[4] in ("PENDENTE", "PENDENTE_VENCIDA"):
            ss = 1.0 if ticket["aberto"] else 0.75
        elif os[4] == "EXECUTADA":
            ss = 0.60
        scored.append((0.50 * ds + 0.35 * js + 0.15 * ss, os[3] or datetime(1, 1, 1), os[0]))
    scored.sort(reverse=True)
    return scored[0][2], scored[0][0], scored[1][0] if len(scored) > 1 else 0.0


@pytest.mark.parametrize(("seed", "direct_classes", "most"), [(1, 200, 3), (2, 0, 3), (3, 0, 8), (4, 30, 5)])
def test_scores_equal_all_pairs(spark, seed, direct_classes, most):
    """Whether an account's tickets meet all its orders or go through the token index."""
    rnd = random.Random(seed)
    words = ["AGUA", "ESGOTO", "FATURA", "RUA", "NOVA", *[f"W{k}" for k in range(most)]]
    pick = lambda: sorted({*rnd.sample(words, rnd.randint(0, most)), *rnd.sample(words[:1], rnd.randint(0, 1))})
    day = lambda: datetime(2024, 1, 1).replace(month=rnd.randint(1, 6), day=rnd.randint(1, 28))
    os = [(f"os{i:03d}", str(i), rnd.choice("AAAB"), rnd.choice([None, day(), day()]), rnd.choice([None, "EXECUTADA", "PENDENTE", "PENDENTE_VENCIDA"]), pick()) for i in range(120)]
    ts = [(i, rnd.choice("AABC"), rnd.choice([None, day().date(), day().date(), day().date()]), rnd.random() < 0.5, pick()) for i in range(80)]
    tickets = spark.createDataFrame(ts, "ticket_id bigint, matricula string, dia date, aberto boolean, tokens array<string>")
    got = {r["ticket_id"]: (r["melhor"]["gss_os_id"], r["melhor"]["score"], r["segundo"]) for r in orders.score_orders(tickets, order_frame(spark, os), direct_classes).collect()}
    expected = {}
    for i, account, d, is_open, tokens in ts:
        mine = [o for o in os if o[2] == account]
        if mine:
            expected[i] = scored_by_hand({"dia": d, "aberto": is_open, "tokens": tokens}, mine)
    assert got == expected


def test_exact_match(spark):
    t = spark.createDataFrame([(1, "A", "7"), (2, "B", "7"), (3, "C", "8"), (4, None, None), (5, "Z", None)], "ticket_id bigint, matricula string, numero_os string")
    o = order_frame(spark, [("x7", "7", "A", AT, None, []), ("y7", "7", "Q", LATER, None, [])])
    got = {r["ticket_id"]: (r["gss_os_id"], r["status_vinculo_os"]) for r in orders.match_orders(t, o).collect()}
    assert got == {1: ("x7", "MATCH_EXATO_ZENDESK_GSS"), 2: ("y7", "MATCH_EXATO_ZENDESK_GSS"), 3: (None, "ZENDESK_ORIGINAL"), 4: (None, "SEM_MATRICULA"), 5: (None, "SEM_CANDIDATO_GSS")}


def test_order_status(spark):
    raw = spark.createDataFrame([("7.0", "2024", "40.0", None, None, "2024-01-01"), ("8", None, "41", "2024-02-01", None, None), ("9", None, "41", None, "2024-01-01", None), (None, "1", "2", None, None, None)], "`No. da O.S.` string, `Ano da O.S.` string, Matricula string, `Prev. Conclusao` string, `Dt. Execucao` string, `Dt. Emissao` string").withColumn("row_seq", F.monotonically_increasing_id())
    got = rows(orders.prepare_orders(raw, date(2024, 1, 15)), "gss_os_id", "matricula", "status_os_gss")
    assert got == [("2024-7", "40", "PENDENTE"), ("8", "41", "PENDENTE"), ("9", "41", "EXECUTADA")]


def test_upsert(spark):
    target = spark.createDataFrame([(1, "a", "t1")], "ticket_id bigint, status string, titulo string")
    source = spark.createDataFrame([(1, None), (2, "b")], "ticket_id bigint, status string")
    assert rows(persistence.upsert(target, source, "ticket_id"), "ticket_id", "status", "titulo") == [(1, None, "t1"), (2, "b", None)]
    assert rows(persistence.upsert(target, source.filter("1 = 0"), "ticket_id"), "ticket_id", "status") == [(1, "a")]
    assert rows(persistence.upsert(target.select("ticket_id"), source.select("ticket_id"), "ticket_id"), "ticket_id") == [(1,), (2,)]
    with pytest.raises(ValueError):
        persistence.upsert(target, source.withColumn("x", F.lit(1)), "ticket_id")


def test_history(spark):
    empty = spark.createDataFrame([], ", ".join(f"`{c}` {k}" for c, k in HISTORY.items()))
    day1 = spark.createDataFrame([(1, "OPEN", None), (2, "OPEN", 5)], "ticket_id bigint, status string, ticket_notificacao_id bigint")
    first = persistence.scd2(empty, day1, "r1", AT)
    assert persistence.changed_tickets(first, day1).count() == 0  # a second identical run changes nothing
    day2 = spark.createDataFrame([(1, "SOLVED", None)], "ticket_id bigint, status string, ticket_notificacao_id bigint")
    second = persistence.scd2(first, day2, "r2", LATER)
    got = rows(second, "ticket_id", "status", "flag_ativo", "data_fim_vigencia")
    assert got == [(1, "OPEN", 0, LATER), (1, "SOLVED", 1, None), (2, "OPEN", 1, None)]
    assert '"ticket_notificacao_id":null' in second.filter("ticket_id = 1").first()["payload_json"]


def test_stored_history_touches_open_versions_and_one_month(spark, tmp_path):
    import glob
    import os

    from ticketlake.sources.tables import read_history, update_history

    path = str(tmp_path / "historico")
    day = lambda rows: spark.createDataFrame(rows, "ticket_id bigint, status string")
    files = lambda: {f: os.path.getmtime(f) for f in glob.glob(f"{path}/**/*.parquet", recursive=True)}
    update_history(spark, path, day([(1, "a"), (2, "a")]), "r1", datetime(2024, 1, 5))
    update_history(spark, path, day([(1, "b"), (2, "a")]), "r2", datetime(2024, 2, 5))
    old = {f: t for f, t in files().items() if "mes_fim=2024-02" in f}
    update_history(spark, path, day([(1, "c"), (3, "a")]), "r3", datetime(2024, 3, 5))
    got = update_history(spark, path, day([(1, "d")]), "r4", datetime(2024, 3, 6))
    assert {f: files().get(f) for f in old} == old and old
    found = rows(got, "ticket_id", "status", "flag_ativo", "mes_fim")
    assert found == [(1, "a", 0, "2024-02"), (1, "b", 0, "2024-03"), (1, "c", 0, "2024-03"), (1, "d", 1, "aberta"), (2, "a", 1, "aberta"), (3, "a", 1, "aberta")]
    update_history(spark, path, day([(1, "d")]), "r5", datetime(2024, 3, 7))
    assert rows(read_history(spark, path), "ticket_id", "status", "flag_ativo", "mes_fim") == found
    plan = read_history(spark, path).filter("flag_ativo = 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(flag_ativo" in plan


def test_history_is_one_join_of_open_and_current_rows(spark):
    empty = spark.createDataFrame([], ", ".join(f"`{c}` {k}" for c, k in HISTORY.items()))
    day1 = spark.createDataFrame([(1, "OPEN")], "ticket_id bigint, status string")
    plan = persistence.scd2(empty, day1, "r1", AT)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join FullOuter") == 1 and plan.count("Join") == 1
