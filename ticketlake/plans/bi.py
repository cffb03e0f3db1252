"""BI model: facts, dimensions and measures."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ticketlake.functions.dates import CALENDAR_MONTH_NAMES, WEEKDAY_NAMES, name_from, week_monday
from ticketlake.functions.text import last_segment
from ticketlake.operators.filters import BI_DONE_STATUSES, BI_OPEN_STATUSES, official

# Columns and labels of the output.
FACT_TICKET = (
    "status", "atribuido", "titulo", "assunto", "tipo_solicitacao", "tipo_manifestacao", "resultado_tratativa",
    "protocolo_procon", "protocolo_defensoria", "protocolo_codecon", "case_jec", "formulario_ticket",
    "classificacao_notificacoes", "tags_ticket", "grupo_tickets", "canal_origem", "canais_de_atrito",
    "superintendencia_adr", "prioridade_ticket", "motivo_espera", "classificacao_solicitacoes", "bloco",
    "qtde_assuntos_ticket", "flag_multiplos_assuntos", "bairro", "municipio", "logradouro", "endereco",
    "numero_porta", "complemento", "telefone", "nome_cliente_gss", "nome_requerente_gss", "nome_solicitante",
    "email_solicitante", "numero_os_original", "numero_os_gss", "origem_numero_os", "status_vinculo_os",
    "score_vinculo_os", "criterio_vinculo_os", "ticket_notificacao_id", "data_criacao_notificacao",
    "status_vinculo", "criterio_vinculo", "confianca_vinculo",
)
FACT_HEARING = ("audiencia", "preposto", "local_procon", "tipo_audiencia")
HEARING_FACT_TICKET = (
    "status", "atribuido", "tipo_solicitacao", "assunto", "tipo_manifestacao", "municipio", "bairro",
)


def _entry() -> Column:
    return F.to_date(F.coalesce("data_entrada_reclamacao", "data_criacao")).alias("data_entrada")


def _days(*names: str) -> list[Column]:
    return [F.to_date(n).alias(n) for n in names]


def bi_fact_tickets(tickets: DataFrame, hearings: DataFrame) -> DataFrame:
    """Counted requests with their hearing; tickets without a form are out."""
    left = tickets.filter(official("bi"))
    right = hearings.select("ticket_id", "data_audiencia", "data_reagendamento", *FACT_HEARING)
    return left.join(right, "ticket_id", "left").select(
        "ticket_id", "case_id", "matricula", "numero_os", _entry(), *_days("data_criacao", "data_resolucao"),
        *FACT_TICKET, *_days("data_audiencia", "data_reagendamento"), *FACT_HEARING,
    )


def bi_fact_hearings(tickets: DataFrame, hearings: DataFrame) -> DataFrame:
    left = tickets.filter(official("bi"))
    right = hearings.select("ticket_id", "data_audiencia", "data_reagendamento", *FACT_HEARING)
    return left.join(right, "ticket_id").select(
        "ticket_id", _entry(), *_days("data_criacao", "data_resolucao", "data_audiencia", "data_reagendamento"),
        *HEARING_FACT_TICKET, *FACT_HEARING,
    )


def _closed() -> Column:
    return F.upper(F.coalesce("status", F.lit(""))).isin(*BI_DONE_STATUSES)


def bi_counts(fact: DataFrame) -> DataFrame:
    """Totals, resolved, open, closed and their shares (0..1); one row."""
    total = F.count(F.lit(1))
    counts = fact.agg(
        total.alias("tickets_total"), total.alias("tickets_entradas"),
        F.count("data_resolucao").alias("tickets_resolvidos"),
        F.count_if(~_closed()).alias("tickets_abertos"), F.count_if(_closed()).alias("tickets_fechados"),
    )
    share = lambda c: F.try_divide(F.col(c).cast("double"), F.col("tickets_total"))
    return counts.select(
        "*", share("tickets_fechados").alias("pct_resolvidos"), share("tickets_abertos").alias("pct_em_tratamento")
    )


def bi_resolution_time(fact: DataFrame) -> DataFrame:
    """Mean days and hours from entry to resolution; both ends are days, so hours are days x 24."""
    days = F.datediff("data_resolucao", "data_entrada")
    return fact.agg(
        F.avg(days).alias("tempo_medio_dias"), F.avg(days * 24).alias("tempo_medio_horas"),
    )


def bi_by_dim(fact: DataFrame, dim: str) -> DataFrame:
    """All and resolved tickets per value of a dimension."""
    return fact.groupBy(dim).agg(
        F.count(F.lit(1)).alias("tickets_total"), F.count("data_resolucao").alias("tickets_resolvidos")
    )


def bi_hearings(fact: DataFrame, today: date) -> DataFrame:
    """Hearings in all, pending, overdue and closed; one row. A missing date counts as past."""
    past = F.coalesce(F.col("data_audiencia") < F.lit(today), F.lit(True))
    return fact.agg(
        F.count(F.lit(1)).alias("audiencias_total"),
        F.count_if(~past | ~_closed()).alias("audiencias_pendentes"),
        F.count_if(past & ~_closed()).alias("audiencias_vencidas"),
        F.count_if(_closed()).alias("audiencias_encerradas"),
    )


def dim_calendar(fact: DataFrame, hearings: DataFrame, today: date) -> DataFrame:
    """Every day from January 1st of the first year to December 31st of the last one."""
    span = (
        fact.agg(
            F.min(F.least("data_entrada", "data_resolucao")).alias("a"),
            F.max(F.greatest("data_entrada", "data_resolucao")).alias("b"),
        )
        .union(hearings.agg(F.min("data_audiencia"), F.max("data_audiencia")))
        .agg(
            F.coalesce(F.year(F.min("a")), F.lit(today.year)).alias("a"),
            F.coalesce(F.year(F.max("b")), F.lit(today.year)).alias("b"),
        )
    )
    day = F.explode(
        F.sequence(F.make_date("a", F.lit(1), F.lit(1)), F.make_date("b", F.lit(12), F.lit(31)))
    )
    d = F.col("data")
    return span.select(day.alias("data")).select(
        d,
        F.year(d).alias("ano"),
        F.month(d).alias("mes_numero"),
        name_from(F.month(d), CALENDAR_MONTH_NAMES).alias("mes"),
        F.date_format(d, "yyyy-MM").alias("ano_mes"),
        F.concat(F.lit("T"), F.quarter(d)).alias("trimestre"),
        F.date_format(week_monday(d), "yyyy-MM-dd").alias("semana_ano"),
        F.dayofmonth(d).alias("dia"),
        (F.weekday(d) + 1).alias("dia_semana_numero"),
        name_from(F.weekday(d) + 1, WEEKDAY_NAMES).alias("dia_semana"),
        (F.weekday(d) >= 5).cast("int").alias("fim_de_semana"),
    )


def mtd_ytd(fact: DataFrame, calendar: DataFrame) -> DataFrame:
    """Month- and year-to-date resolved tickets per calendar day, by entry day.

    Tickets are counted per day first; the running sums see at most a year of days at a time.
    """
    counts = fact.groupBy(F.col("data_entrada").alias("data")).agg(F.count("data_resolucao").alias("n"))
    days = calendar.select("data").join(counts, "data", "left").select("data", F.coalesce("n", F.lit(0)).alias("n"))
    year, month = F.year("data"), F.month("data")
    to_date = lambda *keys: Window.partitionBy(*keys).orderBy("data").rowsBetween(
        Window.unboundedPreceding, 0
    )
    return days.select(
        "data",
        F.sum("n").over(to_date(year, month)).alias("resolvidos_mtd"),
        F.sum("n").over(to_date(year)).alias("resolvidos_ytd"),
    )


def dense_ranks(fact: DataFrame, dim: str, resolved_only: bool = False) -> DataFrame:
    """Dense rank of each value of a dimension by ticket count, highest first.

    Ranks are given to the distinct counts and joined back, so the global order never holds one row
    per label (subjects may be as many as tickets) in a single task.
    """
    measure = F.count("data_resolucao") if resolved_only else F.count(F.lit(1))
    counts = fact.groupBy(dim).agg(measure.alias("tickets"))
    levels = counts.select("tickets").distinct().withColumn(
        "posicao", F.row_number().over(Window.orderBy(F.desc("tickets")))
    )
    return counts.join(levels, "tickets").select(dim, "tickets", "posicao")


def status_group(status: Column) -> Column:
    s = F.upper(F.trim(status))
    return F.when(s.isin(*BI_DONE_STATUSES), "Fechado").when(s.isin(*BI_OPEN_STATUSES), "Aberto").otherwise("Outros")


def _label_dim(fact: DataFrame, column: str, original: str, short: str) -> DataFrame:
    return fact.select(column).distinct().select(
        F.col(column).alias(original), last_segment(F.col(column), empty_tail="empty").alias(short)
    )


def dim_channel_bi(fact: DataFrame) -> DataFrame:
    return _label_dim(fact, "tipo_solicitacao", "canal_original", "canal_normalizado")


def dim_subject_bi(fact: DataFrame) -> DataFrame:
    return _label_dim(fact, "assunto", "assunto_original", "assunto_normalizado")


def dim_assignee_bi(fact: DataFrame) -> DataFrame:
    return fact.select(F.col("atribuido").alias("colaborador")).distinct().orderBy("colaborador")


def dim_status_bi(fact: DataFrame) -> DataFrame:
    return fact.select("status").distinct().withColumn("status_grupo", status_group(F.col("status")))


def dim_location_bi(fact: DataFrame) -> DataFrame:
    return fact.select("municipio", "bairro", "bloco").distinct().orderBy("municipio", "bairro")


def protocol_funnel(tickets: DataFrame) -> DataFrame:
    """Active tickets, resolution rate and tickets per filled protocol; one row in one pass."""
    active = tickets.filter(F.coalesce("flag_arquivado_relatorio", F.lit(0)) == 0)
    filled = lambda c: F.count(F.nullif(F.trim(F.col(c)), F.lit("")))
    total, resolved = F.count(F.lit(1)), F.count("data_resolucao")
    return active.agg(
        total.alias("tickets_ativos"), resolved.alias("tickets_resolvidos"),
        F.round(F.try_divide(resolved.cast("double"), total), 4).alias("taxa_resolucao"),
        filled("protocolo_procon").alias("com_procon"), filled("protocolo_defensoria").alias("com_defensoria"),
        filled("protocolo_codecon").alias("com_codecon"), filled("case_jec").alias("com_jec"),
    )


def by_territory(tickets: DataFrame) -> DataFrame:
    """Tickets per block and municipality, with the block subtotal (municipality null, nivel = bloco)."""
    grouped = tickets.groupingSets(
        [[F.col("bloco")], [F.col("bloco"), F.col("municipio")]], F.col("bloco"), F.col("municipio")
    ).agg(F.count(F.lit(1)).alias("qtde_tickets"), F.grouping("municipio").alias("_sub"))
    return grouped.select(
        F.when(F.col("_sub") == 1, "bloco").otherwise("municipio").alias("nivel"), "bloco", "municipio", "qtde_tickets"
    )
