"""A stored additive cube behind the volume reports, kept up to date from the tickets that changed.

Its rows are days, labels and filter flags with a count, so its size follows the calendar and not the tickets. A change takes
the old facts of the touched tickets out and puts the new ones in; counts add up, so no other ticket is read.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketlake.operators.distinct import by_range, count_cells, distinct_cells, merge_cells
from ticketlake.operators.filters import official
from ticketlake.plans.reports import (
    GRAND_TOTAL, GRANULARITIES, assignee, by_period, channel, entry_moment, funnel_row, has_procon,
)

ENTRY, RESOLUTION = "ENTRADA", "RESOLUCAO"
DIMENSIONS = ("medida", "dia", "rotulo", "flag_conta", "flag_procon", "flag_audiencia")


def _fact(measure: str, moment: Column, label: Column) -> Column:
    return F.struct(F.lit(measure).alias("medida"), F.to_date(moment).alias("dia"), label.alias("rotulo"))


def ticket_facts(tickets: DataFrame, hearings: DataFrame) -> DataFrame:
    """Up to two facts per ticket: its entry by channel and its resolution by assignee. Undated ones have none."""
    held = hearings.select("ticket_id").distinct().withColumn("_tem", F.lit(True))
    facts = F.array(
        _fact(ENTRY, entry_moment(), channel()), _fact(RESOLUTION, F.col("data_resolucao"), assignee())
    )
    marked = tickets.select(
        "ticket_id", facts.alias("_fatos"),
        F.coalesce(official("report"), F.lit(False)).alias("flag_conta"), has_procon().alias("flag_procon"),
    ).join(held, "ticket_id", "left")
    flags = ("flag_conta", "flag_procon", F.coalesce("_tem", F.lit(False)).alias("flag_audiencia"))
    return marked.select(F.inline("_fatos"), *flags).filter(F.col("dia").isNotNull())


def build_cube(tickets: DataFrame, hearings: DataFrame) -> DataFrame:
    return ticket_facts(tickets, hearings).groupBy(*DIMENSIONS).agg(F.count(F.lit(1)).alias("n"))


def update_cube(
    cube: DataFrame, touched: DataFrame, tickets_before: DataFrame, hearings_before: DataFrame, tickets: DataFrame,
    hearings: DataFrame,
) -> DataFrame:
    """The cube after a run. `touched` holds the `ticket_id` of every ticket that came, went or changed, or whose hearing
    did; an id that is named without a change, or twice, alters nothing."""
    ids = touched.select("ticket_id").distinct()

    def facts(rows: DataFrame, held: DataFrame) -> DataFrame:
        return ticket_facts(rows.join(ids, "ticket_id", "left_semi"), held.join(ids, "ticket_id", "left_semi"))

    gone = facts(tickets_before, hearings_before).withColumn("n", F.lit(-1).cast("bigint"))
    come = facts(tickets, hearings).withColumn("n", F.lit(1).cast("bigint"))
    change = gone.unionByName(come).groupBy(*DIMENSIONS).agg(F.sum("n").alias("n"))
    both = cube.select(*DIMENSIONS, "n").unionByName(change)
    return both.groupBy(*DIMENSIONS).agg(F.sum("n").alias("n")).filter(F.col("n") != 0)


def _daily(cube: DataFrame, measure: str, name: str) -> DataFrame:
    return cube.filter(F.col("medida") == measure).groupBy("dia", F.col("rotulo").alias(name)).agg(F.sum("n").alias("n"))


def _counted(cube: DataFrame, start: date, end: date) -> DataFrame:
    return cube.filter(F.col("flag_conta") & F.col("dia").between(F.lit(start), F.lit(end)))


def inflow(cube: DataFrame, start: date, end: date) -> DataFrame:
    """`reports.inflow`, from the cube."""
    daily = _daily(_counted(cube, start, end), ENTRY, "canal_entrada")
    return by_period(daily, "canal_entrada", "qtde_tickets", GRANULARITIES, GRAND_TOTAL)


def inflow_all(cube: DataFrame) -> DataFrame:
    return by_period(_daily(cube, ENTRY, "canal_entrada"), "canal_entrada", "qtde_tickets", GRANULARITIES, GRAND_TOTAL)


def productivity(cube: DataFrame, start: date, end: date) -> DataFrame:
    """`reports.productivity`, from the cube."""
    daily = _daily(_counted(cube, start, end), RESOLUTION, "atribuido")
    return by_period(daily, "atribuido", "tickets_resolvidos", GRANULARITIES[:3])


def productivity_all(cube: DataFrame) -> DataFrame:
    return by_period(_daily(cube, RESOLUTION, "atribuido"), "atribuido", "tickets_resolvidos", GRANULARITIES[:3])


def funnel(cube: DataFrame, start: date, end: date) -> DataFrame:
    """`reports.funnel`, from the cube; a ticket is one row of the stored table, so its facts count tickets."""
    asked = _counted(cube, start, end).filter((F.col("medida") == ENTRY) & F.col("flag_procon"))
    zero = F.lit(0).cast("bigint")
    counts = asked.agg(
        F.coalesce(F.sum("n"), zero).alias("total"),
        F.coalesce(F.sum(F.when(F.col("flag_audiencia"), F.col("n"))), zero).alias("com"),
    )
    return funnel_row(counts, "qtde_tickets_procon", "periodo").select(
        F.lit(start).alias("periodo_inicial"), F.lit(end).alias("periodo_final"), "*"
    )


def movement_cells(tickets: DataFrame) -> DataFrame:
    """Per day and channel, which tickets entered or were resolved; stored beside the cube, each day is written once."""
    days = F.array_distinct(F.array(F.to_date(entry_moment()), F.to_date("data_resolucao")))
    moves = tickets.select("ticket_id", channel().alias("canal_entrada"), F.explode(days).alias("dia"))
    return distinct_cells(moves.filter(F.col("dia").isNotNull()), F.col("ticket_id"), ("dia", "canal_entrada"))


def moved_tickets(cells: DataFrame) -> DataFrame:
    """Tickets that moved in each month and year, by channel and in all.

    A ticket that entered and was resolved in one period counts once, so the days cannot be added up.
    """
    spans = F.array(*[
        F.struct(F.lit(name).alias("granularidade"), F.trunc("dia", unit).alias("periodo_inicio"))
        for name, unit in (("MES", "month"), ("ANO", "year"))
    ])
    labels = F.array("canal_entrada", F.lit(GRAND_TOTAL))
    # One shuffle by range serves the merges over days, months and channels.
    monthly = merge_cells(by_range(cells).withColumn("periodo_inicio", F.trunc("dia", "month")), ("periodo_inicio", "canal_entrada"))
    spread = monthly.withColumnRenamed("periodo_inicio", "dia").withColumn("canal_entrada", F.explode(labels))
    return count_cells(
        spread.select("*", F.inline(spans)), ("granularidade", "periodo_inicio", "canal_entrada"), "qtde_tickets"
    )
