"""Weekly productivity and the service summaries."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketlake.functions.dates import first_in_days, in_days, previous_business_week, weekday_label
from ticketlake.functions.text import label_or, last_segment
from ticketlake.operators.filters import official

CARRIED = (
    "ticket_id", "data_criacao", "assunto", "status", "tipo_manifestacao", "matricula", "numero_os",
    "resultado_tratativa", "classificacao_solicitacoes", "nome_solicitante", "email_solicitante",
)


def _assignee() -> Column:
    return label_or(F.col("atribuido"), "NAO ATRIBUIDO")


def _channel() -> Column:
    return label_or(F.col("tipo_solicitacao"), "NAO INFORMADO")


def weekly_base(tickets: DataFrame, today: date) -> DataFrame:
    """Tickets resolved from Monday to Friday of the week before."""
    monday, friday = previous_business_week(today)
    return tickets.filter(official("daily") & in_days(F.col("data_resolucao"), monday, friday)).select(
        *CARRIED,
        F.to_date("data_resolucao").alias("data_resolucao"),
        _assignee().alias("atribuido"),
        _channel().alias("tipo_solicitacao"),
        F.col("titulo").alias("titulo_ticket"),
        last_segment(_channel()).alias("canal_normalizado"),
        last_segment(F.col("assunto")).alias("assunto_normalizado"),
        F.weekday(F.to_date("data_resolucao")).alias("dia_semana_numero"),
        weekday_label(F.to_date("data_resolucao")).alias("dia_semana_nome"),
        F.lit(monday).alias("periodo_inicio_semana"),
        F.lit(friday).alias("periodo_fim_semana"),
    )


def _resolved(df: DataFrame, *by: str) -> DataFrame:
    return df.groupBy(*by).agg(F.count_distinct("ticket_id").alias("qtde_tickets_resolvidos"))


def weekly_total(base: DataFrame, today: date) -> DataFrame:
    monday, _ = previous_business_week(today)
    return base.agg(F.count_distinct("ticket_id").alias("qtde_tickets_resolvidos")).select(
        F.lit(monday).alias("data_referencia_semana"), "*"
    )


def weekly_by_day(base: DataFrame, today: date) -> DataFrame:
    """Always five rows, days without resolutions as zero."""
    monday, _ = previous_business_week(today)
    spine = base.sparkSession.range(5).select(
        F.lit(monday).alias("data_referencia_semana"),
        F.date_add(F.lit(monday), F.col("id").cast("int")).alias("data_resolucao"),
    )
    counts = _resolved(base, "data_resolucao")
    return spine.join(counts, "data_resolucao", "left").select(
        "data_referencia_semana", "data_resolucao", weekday_label(F.col("data_resolucao")).alias("dia_semana"),
        F.coalesce("qtde_tickets_resolvidos", F.lit(0)).alias("qtde_tickets_resolvidos"),
    ).orderBy("data_resolucao")


def weekly_by_assignee(base: DataFrame) -> DataFrame:
    return _resolved(base, "atribuido").orderBy(F.desc("qtde_tickets_resolvidos"), "atribuido")


def weekly_by_channel(base: DataFrame) -> DataFrame:
    """Per channel, shortened before it is grouped."""
    return _resolved(base, "canal_normalizado").orderBy(F.desc("qtde_tickets_resolvidos"), "canal_normalizado")


def _merged_channels(df: DataFrame, measure: str) -> DataFrame:
    """Distinct tickets per full channel, then summed per short channel."""
    raw = df.groupBy(_channel().alias("canal_raw")).agg(F.count_distinct("ticket_id").alias("n"))
    short = last_segment(F.col("canal_raw"), missing="NAO INFORMADO")
    return raw.groupBy(short.alias("canal")).agg(F.sum("n").alias(measure)).orderBy(F.desc(measure), "canal")


def service_weekly(tickets: DataFrame, today: date) -> dict[str, DataFrame]:
    """Total, per assignee, per day with resolutions, and per channel, for the week before."""
    monday, friday = previous_business_week(today)
    base = tickets.filter(official("service") & in_days(F.col("data_resolucao"), monday, friday)).select(
        "ticket_id", "data_resolucao", "atribuido", "tipo_solicitacao"
    )
    distinct = F.count_distinct("ticket_id").alias("tickets_resolvidos")
    return {
        "total": base.agg(distinct),
        "by_collaborator": base.groupBy(_assignee().alias("colaborador")).agg(distinct).orderBy(
            F.desc("tickets_resolvidos"), "colaborador"
        ),
        "by_day": base.groupBy(F.to_date("data_resolucao").alias("data_resolucao")).agg(distinct).orderBy(
            "data_resolucao"
        ),
        "by_channel": _merged_channels(base, "tickets_resolvidos"),
    }


def service_channel_volume(tickets: DataFrame, start: date, end: date) -> DataFrame:
    """Tickets entered in a period per short channel."""
    base = tickets.filter(official("service") & first_in_days(("data_entrada_reclamacao", "data_criacao"), start, end))
    return _merged_channels(base, "qtde_tickets")
