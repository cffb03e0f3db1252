"""The report cube against reports on the tickets themselves, and the scans of the headline figures."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from ticketlake.catalog import inputs
from ticketlake.catalog.inputs import END, START, TODAY
from ticketlake.plans import cube, reports

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Tickets and hearings as stored tables."""
    folder = tmp_path_factory.mktemp("cube")
    inputs.tickets(spark, SF).write.parquet(f"{folder}/t")
    inputs.hearings(spark, SF).write.parquet(f"{folder}/h")
    return spark.read.parquet(f"{folder}/t"), spark.read.parquet(f"{folder}/h")


def rows(df):
    return sorted(map(str, df.collect()))


def test_reports_from_the_cube_equal_the_direct_ones(tables):
    tickets, hearings = tables
    made = cube.build_cube(tickets, hearings).cache()
    pairs = [
        (cube.inflow(made, START, END), reports.inflow(tickets, START, END)),
        (cube.inflow_all(made), reports.inflow_all(tickets)),
        (cube.productivity(made, START, END), reports.productivity(tickets, START, END)),
        (cube.productivity_all(made), reports.productivity_all(tickets)),
        (cube.funnel(made, START, END), reports.funnel(tickets, hearings, START, END)),
    ]
    for from_cube, direct in pairs:
        assert from_cube.columns == direct.columns and rows(from_cube) == rows(direct)


def test_a_cube_follows_inserts_changes_and_removals(tables):
    tickets, hearings = tables
    new = tickets.filter("ticket_id % 4 <> 1").withColumn(
        "tipo_solicitacao", F.when(F.col("ticket_id") % 4 == 2, F.lit("NOVO")).otherwise(F.col("tipo_solicitacao"))
    )
    old = tickets.filter("ticket_id % 4 <> 0")
    held = hearings.filter("ticket_id % 4 <> 3")
    before = cube.build_cube(old, hearings)
    touched = tickets.select("ticket_id").filter("ticket_id % 4 IN (0, 1, 2)")
    moved = hearings.select("ticket_id").filter("ticket_id % 4 = 3")
    updated = cube.update_cube(before, touched.unionByName(moved).unionByName(moved), old, hearings, new, held)
    wanted = cube.build_cube(new, held)
    assert rows(updated.select(*wanted.columns)) == rows(wanted)
    same = cube.update_cube(wanted, touched, new, held, new, held)  # named without a change
    assert rows(same.select(*wanted.columns)) == rows(wanted)


def test_a_cube_can_become_empty_and_start_empty(tables):
    tickets, hearings = tables
    none, nothing = tickets.limit(0), hearings.limit(0)
    full = cube.build_cube(tickets, hearings)
    ids = tickets.select("ticket_id")
    assert cube.update_cube(full, ids, tickets, hearings, none, nothing).count() == 0
    begun = cube.update_cube(cube.build_cube(none, nothing), ids, none, nothing, tickets, hearings)
    assert rows(begun.select(*full.columns)) == rows(full)
    empty = cube.funnel(cube.build_cube(none, nothing), START, END).first()
    assert (empty["qtde_tickets_procon_periodo"], empty["taxa_conversao_pct"]) == (0, None)


def test_headline_figures_read_three_times_and_equal_the_reports(tables):
    tickets, hearings = tables
    found = reports.headline_kpis(tickets, hearings, START, END, TODAY)
    assert found._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 3
    row = found.first()
    opened = reports.open_hearings(tickets, hearings, START, END, TODAY).first()
    steps = reports.funnel(tickets, hearings, START, END).first()
    assert row["audiencias_em_aberto"] == opened["qtde_audiencias_em_aberto"]
    assert row["audiencias_data_futura"] == opened["qtde_audiencias_somente_data_futura"]
    assert row["procon_total"] == steps["qtde_tickets_procon_periodo"]
    assert row["procon_com_audiencia"] == steps["qtde_tickets_procon_com_audiencia"]


def test_headline_figures_count_a_hearing_and_a_ticket_once(spark):
    """A hearing of two tickets, a ticket of two hearings, one without status, and none at all."""
    kinds = "ticket_id bigint, status string, atribuido string, protocolo_procon string, data_entrada_reclamacao timestamp_ntz, data_criacao timestamp_ntz, data_resolucao timestamp_ntz, flag_arquivado_relatorio int, formulario_ticket string"
    from datetime import datetime

    day = datetime(2024, 1, 5, 9)
    data = [
        (1, "open", "a", "p", None, day, day, 0, None), (2, None, None, " ", day, None, None, None, "Solicitações"),
        (3, "closed", "a", "q", None, day, day, 0, None), (4, "open", "b", "r", None, day, day, 1, None),
        (5, "closed", "b", "s", None, None, None, 0, None),
    ]
    tickets = spark.createDataFrame(data, kinds)
    held = spark.createDataFrame(
        [(1, 10, day, None), (2, 10, day, None), (3, 11, None, datetime(2030, 1, 1)), (3, 12, None, None), (4, 13, None, None), (3, None, None, None)],
        "ticket_id bigint, audiencia_id bigint, data_audiencia timestamp_ntz, data_reagendamento timestamp_ntz",
    )
    span = date(2024, 1, 1), date(2024, 1, 31), date(2024, 2, 1)
    row = reports.headline_kpis(tickets, held, *span).first().asDict()
    assert row == {
        "audiencias_em_aberto": 2, "audiencias_data_futura": 1, "procon_total": 2, "procon_com_audiencia": 2,
        "procon_taxa_pct": 100.0, "tickets_entrada": 3, "tickets_resolvidos": 2, "colaboradores_ativos": 1,
        "linhas_detalhe": 7,
    }
    none = reports.headline_kpis(tickets.limit(0), held.limit(0), *span).first().asDict()
    assert set(none.values()) == {0, 0.0} and len(none) == 9
