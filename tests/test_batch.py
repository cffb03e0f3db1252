"""The whole batch on a small raw feed, twice, and the shape of key plans."""

import os
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from ticketlake.catalog import QUERIES, inputs
from ticketlake.operators.dedup import dedup_latest
from ticketlake.operators.quality import ContractError
from ticketlake.plans import reports
from ticketlake.plans.batch import Rules, run_batch
from ticketlake.schemas import GOLD
from ticketlake.sources.canonical import conform
from ticketlake.sources.files import with_lineage
from ticketlake.sources.tables import Progress, TableStore, export_semantic, stamp_order

SF = "/root/testdata/sf0.001"
TODAY, AT = date(2024, 3, 5), datetime(2024, 3, 5, 6)

GENERAL = [
    ("1.0", "2024-03-04 10:00:00", None, "open", "Solicitações", "Falta d'água", "Água", "Canais::PROCON", "40001.0", "[routing]Canais de Atrito N2"),
    ("1", "2024-03-04 10:00:00", None, "open", "Solicitações", "Falta d'água", "Esgoto", "Canais::PROCON", "40001.0", "[routing]Canais de Atrito N2"),
    ("2", "2024-03-03 09:00:00", "2024-03-04 12:00:00", "solved", "Notificações", "n", "Esgoto", "x", "40001", "G"),
    ("3", "2024-03-02 09:00:00", None, "open", "Solicitações", "t", "Conta", "PROCON", "10002", "Outro"),
    ("9", "2024-03-02 09:00:00", None, "open", "Solicitações", "t", "Conta", "x", "10002", "Outro"),
]
HEADERS = ("ID do ticket", "Criação do ticket - Carimbo de data/hora", "Resolução do ticket - Carimbo de data/hora", "Status do ticket", "Formulário de ticket", "Assunto do ticket", "Assuntos do ticket", "Tipos de Solicitações", "Matrícula", "Grupo de tickets")


def frame(spark, data, headers):
    df = spark.createDataFrame(data, ", ".join(f"`{h}` string" for h in headers))
    return df.select("*", F.lit("f.parquet").alias("arquivo_origem"), F.lit("2024-03-05 00:00:00").alias("arquivo_mtime"))


def feeds(spark):
    gss = ("Matricula", "No. da O.S.", "Ano da O.S.", "Dt. Emissao", "Servico Executado", "Nome do Bairro")
    return {
        "zendesk_geral": frame(spark, GENERAL, HEADERS),
        "zendesk_n1": None,
        "audiencias": frame(spark, [("70", "1", "2024-03-06 10:00:00"), ("71", "55", "2024-03-06 10:00:00")], ("ID do ticket", "Ticket relacionado ID", "Data da audiência - Carimbo de data/hora")),
        "gss": frame(spark, [("40001", "5", "2024", "2024-03-04", "Água falta", "Centro"), ("999", "6", "2024", "2024-03-04", "x", "y")], gss),
    }


def test_run_batch(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "gold"))
    rules = Rules(spark.createDataFrame([(9, "REMOVIDO")], "ticket_id bigint, regra string"))
    assert run_batch(store, feeds(spark), rules, str(tmp_path / "out"), TODAY, AT) == "PARTIAL"  # no level-1 feed
    tickets = {r["ticket_id"]: r for r in store.read("tickets").collect()}
    assert set(tickets) == {1, 3}
    assert tickets[1]["ticket_notificacao_id"] == 2 and tickets[1]["status_vinculo"] == "VINCULADO"
    assert tickets[1]["bairro"] == "Centro" and tickets[1]["gss_os_id"] == "2024-5"
    assert tickets[1]["qtde_assuntos_ticket"] == 2 and tickets[1]["flag_ativo"] == 1
    assert tickets[3]["flag_auditoria_classificacao"] == 1 and tickets[3]["flag_arquivado_relatorio"] == 1
    assert [r["ticket_id"] for r in store.read("audiencias").collect()] == [1]
    assert store.read("tickets_auditoria_classificacao").count() == 1
    assert store.read("silver_geral").count() == 3
    daily = spark.read.parquet(str(tmp_path / "out/daily/totals")).first()
    assert (daily["qtde_tickets"], daily["qtde_tickets_com_audiencia"]) == (1, 1)
    assert spark.read.parquet(str(tmp_path / "out/semantic/fato_tickets")).count() == 1

    before = store.read("tickets_historico").count()
    run_batch(store, feeds(spark), rules, str(tmp_path / "out"), TODAY, datetime(2024, 3, 6, 6))
    assert store.read("tickets_historico").count() == before  # an identical run opens no version
    assert {r["data_inicio_vigencia"] for r in store.read("tickets").collect()} == {AT}
    runs = store.read("etl_runs").collect()
    assert len(runs) == 2 and {r["status"] for r in runs} == {"PARTIAL"}


def test_saved_manual_link_changes_the_outcome(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "gold"))
    rules = Rules(spark.createDataFrame([(9, "REMOVIDO")], "ticket_id bigint, regra string"))
    saved = spark.createDataFrame(
        [(3, 2, "visto", AT), (1, 77, "engano", AT)],
        "ticket_solicitacao_id bigint, ticket_notificacao_id bigint, justificativa string, atualizado_em timestamp_ntz",
    )
    schema = GOLD["ticket_vinculos_manuais"][0]
    store.replace(conform(saved, schema), "ticket_vinculos_manuais")
    run_batch(store, feeds(spark), rules, str(tmp_path / "out"), TODAY, AT)
    links = {r["ticket_id"]: (r["ticket_notificacao_id"], r["status_vinculo"], r["criterio_vinculo"]) for r in store.read("tickets").collect()}
    assert links == {3: (2, "MANUAL", "manual"), 1: (None, "SEM_VINCULO", "manual_invalido")}


def test_ties_of_files_follow_name_and_position(spark, tmp_path):
    """Two files of one time, the rows of each in reverse: the last row of the last file stays."""
    for name, value in (("a", "old"), ("b", "new")):
        rows = [(k, f"{value}{n}") for n in range(3) for k in range(50)]
        folder = tmp_path / name
        spark.createDataFrame(rows, "id int, v string").coalesce(1).write.parquet(str(folder))
        part = next(folder.glob("part-*.parquet"))
        part.rename(tmp_path / f"{name}.parquet")
        os.utime(tmp_path / f"{name}.parquet", (1_700_000_000, 1_700_000_000))
    read = with_lineage(spark.read.parquet(str(tmp_path / "a.parquet"), str(tmp_path / "b.parquet")), "x")
    shuffled = stamp_order(read).repartition(7, F.rand(1))
    kept = dedup_latest(shuffled, ["id"], ["arquivo_mtime", "row_seq"])
    assert {(r.id, r.v) for r in kept.collect()} == {(k, "new2") for k in range(50)}


def test_broken_contract_fails_the_run(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    raw = {**feeds(spark), "zendesk_geral": frame(spark, GENERAL, HEADERS).drop("Status do ticket")}
    with pytest.raises(ContractError):
        run_batch(store, raw, Rules(inputs.governed(spark, SF)), str(tmp_path / "out"), TODAY, AT)
    assert store.read("etl_runs").first()["status"] == "FAILED"
    assert not store.exists("tickets")


def test_tables_change_together_or_not_at_all(spark, tmp_path):
    """A writer that dies between two tables, or after claiming a number, leaves readers on the run before."""
    store = TableStore(spark, str(tmp_path))
    store.publish({name: store.stage(spark.range(1), name) for name in ("a", "b")})
    staged = store.stage(spark.range(5), "a")
    (tmp_path / "_commits" / "000000000001.claim").touch()
    assert [TableStore(spark, str(tmp_path)).read(name).count() for name in ("a", "b")] == [1, 1]
    store.publish({"a": staged})
    assert [store.read(name).count() for name in ("a", "b")] == [5, 1]
    assert not store.exists("c") and store.read_or_empty("c", {"x": "int"}).count() == 0


def test_a_failing_mart_is_written_empty_and_others_stand(spark, tmp_path):
    said = []

    def broken():
        raise ValueError("no such column")

    fails_late = lambda: spark.range(9).select(F.raise_error(F.lit("late")).alias("x"))
    export_semantic({"a": lambda: spark.range(3), "b": lambda: spark.range(4)}, str(tmp_path))
    written = export_semantic({"a": lambda: spark.range(7), "b": broken, "c": fails_late}, str(tmp_path), said.append)
    assert [spark.read.parquet(written[name]).count() for name in "abc"] == [7, 0, 0]
    assert len(said) == 2 and "no such column" in said[0]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["inflow", "productivity", "funnel", "bi_counts", "norm_text", "ticket_subjects", "match_scored", "link_candidates"])
def test_plans_stay_in_the_jvm(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_period_filters_reach_the_scan_of_a_stored_table(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    store.replace(inputs.tickets(spark, SF), "tickets")
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    pushed = plan_of(reports.inflow(store.read("tickets"), date(1998, 1, 1), date(1998, 1, 31))).split("PushedFilters: [")[1].split("ReadSchema")[0]
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(data_entrada_reclamacao,1998-01-01" in pushed, pushed
    assert "IsNull(data_entrada_reclamacao)" in pushed and "GreaterThanOrEqual(data_criacao,1998-01-01" in pushed


def test_inflow_reads_its_table_once(spark):
    plan = plan_of(QUERIES["inflow"](spark, SF))
    assert plan.count("FileScan parquet") == 1
    schema = plan.split("ReadSchema: struct<")[1].split(">")[0]
    assert "o_totalprice" not in schema and "o_orderstatus" not in schema


def _dies_at(monkeypatch, table):
    """Let the writer die before the snapshot of a table; the names of those it wrote are listed."""
    written, real = [], TableStore.stage

    def stage(self, df, name, version=None):
        if name == table:
            raise OSError("executor and driver are gone")
        written.append(name)
        return real(self, df, name, version)

    monkeypatch.setattr(TableStore, "stage", stage)
    return written


def test_a_run_that_died_goes_on_with_its_key(spark, tmp_path, monkeypatch):
    store = TableStore(spark, str(tmp_path / "gold"))
    rules = Rules(spark.createDataFrame([(9, "REMOVIDO")], "ticket_id bigint, regra string"))
    with monkeypatch.context() as patch:
        before = _dies_at(patch, "tickets_historico")
        with pytest.raises(OSError):
            run_batch(store, feeds(spark), rules, str(tmp_path / "out"), TODAY, AT, "day-65")
    assert "silver_geral" in before and "tickets_historico" not in before
    assert not store.exists("tickets") and not store.exists("silver_geral")  # readers see nothing of it

    kept = {p: p.stat().st_mtime_ns for p in (tmp_path / "gold").rglob("part-*.parquet") if "etl_" not in str(p)}
    unread = {k: v if v is None else v.select(*[F.raise_error(F.lit("read again")).cast("string").alias(c) for c in v.columns]) for k, v in feeds(spark).items()}
    later = datetime(2024, 3, 5, 9)
    assert run_batch(store, unread, rules, str(tmp_path / "out"), TODAY, later, "day-65") == "PARTIAL"
    stands = {p: p.stat().st_mtime_ns for p in kept if "_runs" not in str(p)}
    assert stands and all(kept[p] == t for p, t in stands.items())  # finished snapshots were not written again
    assert {r["data_inicio_vigencia"] for r in store.read("tickets").collect()} == {AT}  # the moment of the first start
    assert store.read("tickets_historico").count() == 2 and store.read("etl_runs").count() == 1
    assert not (tmp_path / "gold/_runs/day-65").exists()


def test_a_run_that_died_after_the_switch_only_writes_outputs(spark, tmp_path, monkeypatch):
    store = TableStore(spark, str(tmp_path / "gold"))
    rules = Rules(spark.createDataFrame([(9, "REMOVIDO")], "ticket_id bigint, regra string"))

    def dies(*_):
        raise OSError("driver is gone")

    with monkeypatch.context() as patch:
        patch.setattr("ticketlake.plans.batch.write_outputs", dies)
        with pytest.raises(OSError):
            run_batch(store, feeds(spark), rules, str(tmp_path / "out"), TODAY, AT, "k")
    live = store.live()
    run_batch(store, feeds(spark), rules, str(tmp_path / "out"), TODAY, AT, "k")
    assert {n: v for n, v in store.live().items() if n != "etl_runs"} == {n: v for n, v in live.items() if n != "etl_runs"}
    assert spark.read.parquet(str(tmp_path / "out/semantic/fato_tickets")).count() == 1


def test_what_a_run_kept_is_void_once_another_run_switched_the_tables(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    first = Progress(store, "a", ["t"], TODAY, AT)
    assert first.keep("x", spark.range(3)).count() == 3
    again = Progress(store, "a", ["t"], TODAY, datetime(2024, 3, 5, 9))
    assert (again.run_id, again.at) == (first.run_id, AT)
    assert again.keep("x", spark.range(7)).count() == 3
    with pytest.raises(ValueError):
        Progress(store, "a", ["t"], date(2024, 3, 6), AT)

    (tmp_path / "_runs/a/x/_SUCCESS").unlink()  # half of a frame is written over
    assert again.keep("x", spark.range(7)).count() == 7
    other = Progress(store, "b", ["t"], TODAY, AT)
    other.publish({"t": store.stage(spark.range(1), "t", other.snapshot)})
    assert other.published() and Progress(store, "b", ["t"], TODAY, AT).published()
    anew = Progress(store, "a", ["t"], TODAY, AT)
    assert anew.run_id != first.run_id and not anew.published()
    assert anew.keep("x", spark.range(2)).count() == 2
    anew.discard()
    assert not (tmp_path / "_runs/a").exists()
