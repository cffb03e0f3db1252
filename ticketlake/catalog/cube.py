"""Reports from a cube that was built on the tickets of the day before and then brought up to date."""

from __future__ import annotations

from pyspark.sql import functions as F

from ticketlake.catalog.inputs import END, START, hearings, tickets
from ticketlake.catalog.registry import query
from ticketlake.catalog.reports import CHANNEL, ENTRY_DAY, FUNNEL_SQL, INFLOW_SQL, PRODUCTIVITY_SQL
from ticketlake.plans import cube, reports


def _maintained(spark, sf):
    """Today's cube. Yesterday every seventh ticket was missing, every fifth had another channel, day, assignee and filter
    flag, every eleventh stood there once more under an id that is gone today, and every third had no hearing yet."""
    now, held_now = tickets(spark, sf), hearings(spark, sf)
    other = F.col("ticket_id") % 5 == 0
    earlier = F.col("data_criacao") - F.expr("INTERVAL 1 DAY")
    before = now.filter("ticket_id % 7 <> 0").withColumns(
        {
            "tipo_solicitacao": F.when(other, F.lit("ANTIGO")).otherwise(F.col("tipo_solicitacao")),
            "atribuido": F.when(other, F.lit(None)).otherwise(F.col("atribuido")),
            "data_criacao": F.when(other, earlier).otherwise(F.col("data_criacao")),
            "flag_arquivado_relatorio": F.when(other, F.lit(0)).otherwise(F.col("flag_arquivado_relatorio")),
        }
    )
    gone = now.filter("ticket_id % 11 = 0").withColumn("ticket_id", -F.col("ticket_id"))
    before = before.unionByName(gone)
    held_before = held_now.filter("ticket_id % 3 <> 0")
    ids = [
        now.filter("ticket_id % 7 = 0 OR ticket_id % 5 = 0").select("ticket_id"), gone.select("ticket_id"),
        held_now.filter("ticket_id % 3 = 0").select("ticket_id"),
    ]
    touched = ids[0].unionByName(ids[1]).unionByName(ids[2])
    yesterday = cube.build_cube(before, held_before)
    return cube.update_cube(yesterday, touched, before, held_before, now, held_now)


@query("inflow_cube", INFLOW_SQL, days=("periodo_inicio",))
def inflow_cube(spark, sf):
    return reports.sort_inflow(cube.inflow(_maintained(spark, sf), START, END))


@query("productivity_cube", PRODUCTIVITY_SQL, days=("periodo_inicio",))
def productivity_cube(spark, sf):
    return reports.sort_productivity(cube.productivity(_maintained(spark, sf), START, END))


@query("funnel_cube", FUNNEL_SQL, days=("periodo_inicial", "periodo_final"))
def funnel_cube(spark, sf):
    return cube.funnel(_maintained(spark, sf), START, END)


@query(
    "moved_tickets",
    f"""
    WITH moves AS (
      SELECT ticket_id, {CHANNEL} AS canal, {ENTRY_DAY} AS dia FROM tickets
      UNION ALL SELECT ticket_id, {CHANNEL}, CAST(data_resolucao AS DATE) FROM tickets),
    spans AS (
      SELECT 'MES' AS granularidade, CAST(date_trunc('month', dia) AS DATE) AS periodo_inicio, * FROM moves WHERE dia IS NOT NULL
      UNION ALL SELECT 'ANO', CAST(date_trunc('year', dia) AS DATE), * FROM moves WHERE dia IS NOT NULL)
    SELECT granularidade, periodo_inicio, canal AS canal_entrada, count(DISTINCT ticket_id) AS qtde_tickets FROM spans GROUP BY ALL
    UNION ALL SELECT granularidade, periodo_inicio, 'TOTAL GERAL', count(DISTINCT ticket_id) FROM spans GROUP BY ALL
    """,
    days=("periodo_inicio",),
)
def moved_tickets(spark, sf):
    """Distinct tickets per period, from the cells of two feeds that were stored apart."""
    every = tickets(spark, sf)
    parts = [cube.movement_cells(every.filter(f"ticket_id % 3 {sign} 0")) for sign in ("=", "<>")]
    return cube.moved_tickets(parts[0].unionByName(parts[1]))
