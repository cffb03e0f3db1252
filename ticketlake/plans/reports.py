"""Executive reports: volumes by period, hearings, funnels, the audit sheet and headline figures."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketlake.functions.dates import first_in_days, in_days, week_label, week_monday, week_number
from ticketlake.functions.text import label_or, upper_trim
from ticketlake.operators.filters import (
    OPEN_STATUSES, VIEW_DONE_STATUSES, is_request_form, not_archived, official,
)
from ticketlake.operators.quality import percent

GRAND_TOTAL = "TOTAL GERAL"
GRANULARITIES = ("DIARIA", "SEMANAL", "MENSAL", "ANUAL")
# Columns of the audit sheet that come straight from the ticket and from the hearing.
# Columns and labels of the output.
DETAIL_TICKET = (
    "ticket_id", "case_id", "matricula", "numero_os", "data_criacao", "data_resolucao", "status", "atribuido",
    "titulo", "assunto", "tipo_conversa", "tipo_solicitacao", "tipo_manifestacao", "resultado_tratativa",
    "formulario_ticket", "classificacao_notificacoes", "protocolo_procon", "protocolo_defensoria",
    "protocolo_codecon", "case_jec", "ticket_solicitacao_id", "ticket_notificacao_id", "data_entrada_reclamacao",
    "data_criacao_solicitacao", "data_criacao_notificacao", "dias_defasagem_abertura", "criterio_vinculo",
    "confianca_vinculo", "status_vinculo",
)
DETAIL_HEARING = (
    "audiencia_id", "audiencia", "data_audiencia", "data_reagendamento", "preposto", "local_procon", "tipo_audiencia",
)
HEADLINE = (
    "audiencias_em_aberto", "audiencias_data_futura", "procon_total", "procon_com_audiencia", "procon_taxa_pct",
    "tickets_entrada", "tickets_resolvidos", "colaboradores_ativos", "linhas_detalhe",
)
ENTRY = ("data_entrada_reclamacao", "data_criacao")


def entry_moment() -> Column:
    return F.coalesce(*ENTRY)


def hearing_day() -> Column:
    """Effective day of a hearing: rescheduled, else original."""
    return F.to_date(F.coalesce("data_reagendamento", "data_audiencia"))


def is_open() -> Column:
    return upper_trim(F.col("status")).isin(*OPEN_STATUSES)


def has_procon() -> Column:
    return F.nullif(F.trim(F.col("protocolo_procon")), F.lit("")).isNotNull()


def _periods(day: str, granularities: Sequence[str]) -> Column:
    """The periods a day belongs to, as an array of one struct type."""
    d, null = F.col(day), F.lit(None).cast("string")
    year, month = F.date_format(d, "yyyy"), F.date_format(d, "MM")
    parts = {
        "DIARIA": (d, F.date_format(d, "yyyy-MM-dd"), week_number(d), month),
        "SEMANAL": (week_monday(d), week_label(d), week_number(d), null),
        "MENSAL": (F.trunc(d, "month"), F.date_format(d, "yyyy-MM"), null, month),
        "ANUAL": (F.trunc(d, "year"), year, null, null),
    }
    return F.array(
        *[
            F.struct(
                F.lit(g).alias("granularidade"), parts[g][0].alias("periodo_inicio"),
                parts[g][1].alias("periodo_label"), year.alias("ano"), parts[g][2].alias("semana"),
                parts[g][3].alias("mes"),
            )
            for g in granularities
        ]
    )


# Columns and labels of the output.
PERIOD = ("granularidade", "periodo_inicio", "periodo_label", "ano", "semana", "mes")


def by_period(
    daily: DataFrame, dimension: str, measure: str, granularities: Sequence[str], total: str | None = None
) -> DataFrame:
    """Roll `daily(dia, <dimension>, n)` up to every granularity, with a total row per period if named.

    The input is already one row per day and label, so the expansion never touches ticket rows.
    """
    expanded = daily.select(dimension, "n", F.inline(_periods("dia", granularities)))
    counted = F.sum("n").alias(measure)
    if total is None:
        return expanded.groupBy(*PERIOD, dimension).agg(counted)
    columns = [F.col(c) for c in PERIOD]
    label = F.col(dimension)
    grouped = expanded.groupingSets([columns, [*columns, label]], *columns, label).agg(
        counted, F.grouping(dimension).alias("_total")
    )
    named = F.when(F.col("_total") == 1, F.lit(total)).otherwise(label)
    return grouped.select(*PERIOD, named.alias(dimension), measure)


def _daily(df: DataFrame, day: Column, label: Column, name: str) -> DataFrame:
    return df.groupBy(day.alias("dia"), label.alias(name)).agg(F.count(F.lit(1)).alias("n"))


def channel() -> Column:
    return label_or(F.col("tipo_solicitacao"), "NAO INFORMADO")


def assignee() -> Column:
    return label_or(F.col("atribuido"), "NAO ATRIBUIDO")


def inflow(tickets: DataFrame, start: date, end: date) -> DataFrame:
    """Tickets entered in a period, by day, week, month and year, per channel and in total."""
    chosen = tickets.filter(official("report") & first_in_days(ENTRY, start, end))
    daily = _daily(chosen, F.to_date(entry_moment()), channel(), "canal_entrada")
    return by_period(daily, "canal_entrada", "qtde_tickets", GRANULARITIES, GRAND_TOTAL)


def inflow_all(tickets: DataFrame) -> DataFrame:
    """Entry volume of all tickets, no filter."""
    chosen = tickets.filter(entry_moment().isNotNull())
    daily = _daily(chosen, F.to_date(entry_moment()), channel(), "canal_entrada")
    return by_period(daily, "canal_entrada", "qtde_tickets", GRANULARITIES, GRAND_TOTAL)


def productivity(tickets: DataFrame, start: date, end: date) -> DataFrame:
    """Resolved tickets per assignee by day, week and month."""
    chosen = tickets.filter(official("report") & in_days(F.col("data_resolucao"), start, end))
    daily = _daily(chosen, F.to_date("data_resolucao"), assignee(), "atribuido")
    return by_period(daily, "atribuido", "tickets_resolvidos", GRANULARITIES[:3])


def productivity_all(tickets: DataFrame) -> DataFrame:
    chosen = tickets.filter(F.col("data_resolucao").isNotNull())
    daily = _daily(chosen, F.to_date("data_resolucao"), assignee(), "atribuido")
    return by_period(daily, "atribuido", "tickets_resolvidos", GRANULARITIES[:3])


def _granularity_place() -> Column:
    return F.array_position(F.array(*[F.lit(g) for g in GRANULARITIES]), F.col("granularidade"))


def sort_inflow(df: DataFrame) -> DataFrame:
    return df.orderBy(
        _granularity_place(), "periodo_inicio", F.col("canal_entrada") != GRAND_TOTAL, "canal_entrada"
    )


def sort_productivity(df: DataFrame) -> DataFrame:
    return df.orderBy(_granularity_place(), "periodo_inicio", "atribuido")


def _counted_hearings(tickets: DataFrame, hearings: DataFrame, tests: dict[str, Column]) -> DataFrame:
    """Distinct hearings that pass each test, in one shuffle: first per hearing, then overall."""
    slim_h = hearings.select("ticket_id", "audiencia_id", "data_audiencia", "data_reagendamento")
    joined = slim_h.join(tickets, "ticket_id")
    per_hearing = joined.groupBy("audiencia_id").agg(*[F.bool_or(t).alias(n) for n, t in tests.items()])
    return per_hearing.filter(F.col("audiencia_id").isNotNull()).agg(
        *[F.count_if(F.col(n)).alias(n) for n in tests]
    )


def open_hearings(tickets: DataFrame, hearings: DataFrame, start: date, end: date, today: date) -> DataFrame:
    """Hearings that are ahead, whose ticket is open, or either; one row."""
    slim = tickets.filter(official("report")).select("ticket_id", "status")
    ahead = F.coalesce(hearing_day() >= F.lit(today), F.lit(False))
    counts = _counted_hearings(
        slim, hearings,
        {
            "qtde_audiencias_em_aberto": ahead | is_open(),
            "qtde_audiencias_somente_data_futura": ahead,
            "qtde_audiencias_ticket_aberto": is_open(),
        },
    )
    return counts.select(
        F.lit(start).alias("periodo_inicial"), F.lit(end).alias("periodo_final"), F.lit(today).alias("data_referencia"),
        "*",
    )


def open_hearings_view(tickets: DataFrame, hearings: DataFrame, today: date) -> DataFrame:
    """Hearings ahead by original date, or whose ticket is not done; archived tickets count too."""
    ahead = F.coalesce(F.to_date("data_audiencia") >= F.lit(today), F.lit(False))
    not_done = ~upper_trim(F.col("status")).isin(*VIEW_DONE_STATUSES)
    counts = _counted_hearings(
        tickets.select("ticket_id", "status"), hearings, {"qtde_audiencias_em_aberto": ahead | not_done}
    )
    return counts.select(F.lit(today).alias("data_referencia"), "*")


def funnel_row(counts: DataFrame, what: str, suffix: str) -> DataFrame:
    total, held = F.col("total"), F.col("com")
    return counts.select(
        total.alias(f"{what}_{suffix}"), held.alias(f"{what}_com_audiencia"),
        (total - held).alias(f"{what}_sem_audiencia"), percent(held, total).alias("taxa_conversao_pct"),
    )


def _held(hearings: DataFrame) -> DataFrame:
    return hearings.select("ticket_id", F.lit(1).alias("_tem"))


def funnel(tickets: DataFrame, hearings: DataFrame, start: date, end: date) -> DataFrame:
    """Consumer-agency tickets of a period that reached a hearing; one row."""
    base = tickets.filter(official("report") & has_procon() & first_in_days(ENTRY, start, end)).select("ticket_id")
    counts = (
        base.join(_held(hearings), "ticket_id", "left")
        .groupBy("ticket_id").agg(F.max("_tem").alias("_tem"))
        .agg(F.count(F.lit(1)).alias("total"), F.count("_tem").alias("com"))
    )
    return funnel_row(counts, "qtde_tickets_procon", "periodo").select(
        F.lit(start).alias("periodo_inicial"), F.lit(end).alias("periodo_final"), "*"
    )


def funnel_protocols(tickets: DataFrame, hearings: DataFrame, today: date) -> DataFrame:
    """The same over distinct protocols of all time; one row."""
    base = tickets.filter(has_procon()).select("ticket_id", F.trim("protocolo_procon").alias("protocolo"))
    counts = (
        base.join(_held(hearings), "ticket_id", "left")
        .groupBy("protocolo").agg(F.max("_tem").alias("_tem"))
        .agg(F.count(F.lit(1)).alias("total"), F.count("_tem").alias("com"))
    )
    return funnel_row(counts, "qtde_protocolos_procon", "total").select(F.lit(today).alias("data_referencia"), "*")


def _flag(test: Column, name: str) -> Column:
    return F.coalesce(test, F.lit(False)).cast("int").alias(name)


def detail_rows(tickets: DataFrame, hearings: DataFrame) -> DataFrame:
    """Tickets beside their hearing, if any."""
    return tickets.select(*DETAIL_TICKET, "flag_arquivado_relatorio").join(
        hearings.select("ticket_id", *DETAIL_HEARING), "ticket_id", "left"
    )


def report_detail(tickets: DataFrame, hearings: DataFrame, start: date, end: date, today: date) -> DataFrame:
    """Audit sheet: every ticket with its hearing and the flags the reports are built on."""
    entry, effective = F.to_date(entry_moment()), hearing_day()
    held = F.col("audiencia_id").isNotNull()
    ahead = effective >= F.lit(today)
    period = lambda d: d.between(F.lit(start), F.lit(end))
    sheet = detail_rows(tickets, hearings).select(
        F.lit(start).alias("periodo_inicial_param"),
        F.lit(end).alias("periodo_final_param"),
        F.lit(today).alias("data_referencia_execucao"),
        *DETAIL_TICKET,
        upper_trim(F.col("status")).alias("status_normalizado"),
        F.coalesce("flag_arquivado_relatorio", F.lit(0)).alias("flag_arquivado_relatorio"),
        *DETAIL_HEARING,
        effective.alias("data_audiencia_efetiva"),
        entry.alias("data_entrada_base"),
        _flag(period(entry), "flag_periodo_entrada"),
        _flag(period(F.to_date("data_resolucao")), "flag_periodo_resolucao"),
        _flag(has_procon(), "flag_procon"),
        _flag(is_request_form(), "flag_formulario_solicitacao"),
        _flag(held, "flag_tem_audiencia"),
        _flag(ahead, "flag_audiencia_futura_ou_hoje"),
        _flag(is_open(), "flag_ticket_aberto"),
        _flag(held & (F.coalesce(ahead, F.lit(False)) | is_open()), "flag_audiencia_em_aberto_regra_atual"),
        _flag(held & ahead, "flag_audiencia_em_aberto_data_futura"),
        _flag(not_archived() & is_request_form(), "flag_elegivel_relatorio"),
    )
    return sheet.orderBy(
        F.desc("flag_audiencia_em_aberto_regra_atual"), F.desc("flag_periodo_entrada"),
        F.col("data_entrada_base").desc_nulls_last(), F.desc("ticket_id"),
    )


def headline_kpis(tickets: DataFrame, hearings: DataFrame, start: date, end: date, today: date) -> DataFrame:
    """One row with the figures an executive reads first.

    Volumes are one pass over the tickets of the period. Everything about hearings is one join: each of its rows says
    which hearing and which agency ticket it counts for, these fold to one row per id, and all counts are taken from that.
    """
    counts = official("report")
    entered = counts & first_in_days(ENTRY, start, end)
    resolved = counts & in_days(F.col("data_resolucao"), start, end)
    volumes = (
        tickets.filter(entered | resolved).groupBy(assignee().alias("_quem"))
        .agg(F.count_if(entered).alias("_entrada"), F.count_if(resolved).alias("_resolvidos"))
        .agg(
            F.coalesce(F.sum("_entrada"), F.lit(0)).alias("tickets_entrada"),
            F.coalesce(F.sum("_resolvidos"), F.lit(0)).alias("tickets_resolvidos"),
            F.count_if(F.col("_resolvidos") > 0).alias("colaboradores_ativos"),
        )
    )
    slim = tickets.select(
        "ticket_id", _truth(counts, "_conta"), _truth(is_open(), "_aberto"), _truth(entered & has_procon(), "_procon")
    )
    held = hearings.select(
        "ticket_id", "audiencia_id", _truth(hearing_day() >= F.lit(today), "_futura"), F.lit(True).alias("_tem")
    )
    ahead = F.coalesce("_futura", F.lit(False))
    marks = F.array(
        _mark("linha", F.lit(None), F.lit(False), F.lit(False)),
        F.when(
            F.col("_conta") & F.col("audiencia_id").isNotNull(),
            _mark("audiencia", F.col("audiencia_id"), ahead | F.col("_aberto"), ahead),
        ),
        F.when(F.col("_procon"), _mark("procon", F.col("ticket_id"), F.coalesce("_tem", F.lit(False)), F.lit(False))),
    )
    folded = (
        slim.join(held, "ticket_id", "left").select(F.inline(F.array_compact(marks)))
        .groupBy("tipo", "id").agg(F.bool_or("a").alias("a"), F.bool_or("b").alias("b"), F.count(F.lit(1)).alias("n"))
    )
    hearing, asked = F.col("tipo") == "audiencia", F.col("tipo") == "procon"
    found = folded.agg(
        F.count_if(hearing & F.col("a")).alias("audiencias_em_aberto"),
        F.count_if(hearing & F.col("b")).alias("audiencias_data_futura"),
        F.count_if(asked).alias("procon_total"),
        F.count_if(asked & F.col("a")).alias("procon_com_audiencia"),
        F.coalesce(F.sum(F.when(F.col("tipo") == "linha", F.col("n"))), F.lit(0)).alias("linhas_detalhe"),
    )
    rate = F.coalesce(percent(F.col("procon_com_audiencia"), F.col("procon_total")), F.lit(0.0))
    found = found.withColumn("procon_taxa_pct", rate).withColumn("_k", F.lit(1))
    # Two one-row frames side by side.
    return found.join(volumes.withColumn("_k", F.lit(1)), "_k").select(*HEADLINE)


def _truth(test: Column, name: str) -> Column:
    return F.coalesce(test, F.lit(False)).alias(name)


def _mark(kind: str, key: Column, a: Column, b: Column) -> Column:
    """What a joined row counts for: a kind of thing, its id and two tests."""
    return F.struct(F.lit(kind).alias("tipo"), key.cast("string").alias("id"), a.alias("a"), b.alias("b"))


def append_total(
    df: DataFrame, exclude: Iterable[str] = (), exclude_prefixes: Iterable[str] = ("flag_",)
) -> DataFrame:
    """Add a TOTAL row over the numeric columns that make sense to sum, when there is more than one row."""
    excluded, prefixes = set(exclude), tuple(exclude_prefixes)
    numeric = ("int", "bigint", "smallint", "tinyint", "float", "double", "decimal")
    summed = [
        n for n, k in df.dtypes if k.startswith(numeric) and n not in excluded and not n.startswith(prefixes)
    ]
    if not summed:
        return df
    labels = [c for c in df.columns if c not in summed]
    totals = df.agg(F.count(F.lit(1)).alias("_linhas"), *[F.sum(c).alias(c) for c in summed]).filter("_linhas > 1")
    kind = dict(totals.dtypes)
    body = df.select(
        *[F.col(c).cast(kind[c]) if c in summed else F.col(c).cast("string").alias(c) for c in df.columns]
    ) if labels else df
    row = totals.select(
        *[
            F.col(c) if c in summed else F.lit("TOTAL" if c == labels[0] else "").alias(c)
            for c in df.columns
        ]
    )
    return body.unionByName(row)
