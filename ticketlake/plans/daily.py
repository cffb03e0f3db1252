"""Daily report: movements of the previous working day and hearings of the week."""

from __future__ import annotations

from datetime import date
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketlake.functions.dates import day_of, first_in_days, in_days
from ticketlake.functions.text import label_or, last_segment, upper_trim
from ticketlake.operators.filters import DONE_STATUSES, official
from ticketlake.plans.reports import hearing_day

TICKET_SIDE = (
    "ticket_id", "data_criacao", "data_resolucao", "status", "assunto", "matricula", "numero_os",
    "resultado_tratativa", "classificacao_solicitacoes", "nome_solicitante", "email_solicitante", "bairro",
    "municipio",
)
HEARING_SIDE = ("audiencia_id", "audiencia", "data_audiencia", "data_reagendamento", "preposto", "local_procon")
OVERDUE_COLUMNS = (
    "ticket_id", "data_criacao", "data_resolucao", "data_audiencia", "data_reagendamento",
    "data_audiencia_efetiva", "status", "atribuido", "preposto", "local_procon", "titulo_ticket", "assunto",
    "matricula", "numero_os", "tipo_solicitacao", "resultado_tratativa", "nome_solicitante", "email_solicitante",
)


def _done() -> Column:
    return upper_trim(F.col("status")).isin(*DONE_STATUSES)


def _flag(test: Column, name: str) -> Column:
    return F.coalesce(test, F.lit(False)).cast("int").alias(name)


def _columns(window: dict[str, Any]) -> list[Column]:
    today, day, friday = window["today"], window["business_day"], window["week_end"]
    held = F.col("audiencia_id").isNotNull()
    entered = F.to_date("data_criacao") == F.lit(day)
    this_week = held & hearing_day().between(F.lit(today), F.lit(friday))
    return [
        *TICKET_SIDE,
        label_or(F.col("atribuido"), "NAO ATRIBUIDO").alias("atribuido"),
        label_or(F.col("tipo_solicitacao"), "NAO INFORMADO").alias("tipo_solicitacao"),
        upper_trim(F.col("status")).alias("status_normalizado"),
        F.col("titulo").alias("titulo_ticket"),
        held.cast("int").alias("tem_audiencia"),
        *[c for c in HEARING_SIDE if c != "audiencia_id"],
        hearing_day().alias("data_audiencia_efetiva"),
        F.lit(today).alias("data_referencia_execucao"),
        F.lit(day).alias("data_referencia_dia_util_anterior"),
        F.lit(today).alias("data_inicio_semana_execucao"),
        F.lit(friday).alias("data_fim_semana_execucao"),
        _flag(entered, "flag_entrada_dia_util_anterior"),
        _flag(F.to_date("data_resolucao") == F.lit(day), "flag_resolvido_dia_util_anterior"),
        _flag(entered & held, "flag_entrada_audiencia_dia_util_anterior"),
        _flag(this_week & ~_done(), "flag_audiencia_semana_aberta"),
        _flag(this_week & _done(), "flag_audiencia_semana_encerrada"),
    ]


def daily_base(tickets: DataFrame, hearings: DataFrame, window: dict[str, Any]) -> DataFrame:
    """Tickets created or resolved on the previous working day, or with a hearing from today to Friday.

    Both tables are cut to one day or week by scan filters before they meet, so the joins are between
    small sets; whether one is broadcast is decided at run time, by its measured size.
    """
    today, day, friday = window["today"], window["business_day"], window["week_end"]
    due = hearings.filter(first_in_days(("data_reagendamento", "data_audiencia"), today, friday)).select("ticket_id")
    moved = in_days(F.col("data_criacao"), day, day) | in_days(F.col("data_resolucao"), day, day)
    counted = tickets.filter(official("daily")).select(*TICKET_SIDE, "atribuido", "tipo_solicitacao", "titulo")
    moved = F.coalesce(moved, F.lit(False))
    chosen = counted.filter(moved).unionByName(counted.filter(~moved).join(due, "ticket_id", "left_semi"))
    theirs = hearings.select("ticket_id", *HEARING_SIDE).join(chosen.select("ticket_id"), "ticket_id", "left_semi")
    return chosen.join(theirs, "ticket_id", "left").select(*_columns(window))


def _distinct_tickets(df: DataFrame, flag: str, *by: str) -> DataFrame:
    return df.filter(F.col(flag) == 1).groupBy(*by).agg(F.count_distinct("ticket_id").alias("n"))


def daily_totals(base: DataFrame, day: date) -> DataFrame:
    """Tickets entered, resolved and entered with a hearing; one row, in one shuffle on the ticket."""
    flags = {
        "qtde_tickets": "flag_entrada_dia_util_anterior",
        "qtde_tickets_resolvidos": "flag_resolvido_dia_util_anterior",
        "qtde_tickets_com_audiencia": "flag_entrada_audiencia_dia_util_anterior",
    }
    per_ticket = base.groupBy("ticket_id").agg(*[F.max(f).alias(n) for n, f in flags.items()])
    return per_ticket.agg(*[F.count_if(F.col(n) == 1).alias(n) for n in flags]).select(
        F.lit(day).alias("data_referencia"), "*"
    )


def daily_entry_channel(base: DataFrame) -> DataFrame:
    """Entries per channel; grouped on the full label and shortened afterwards, so labels may repeat."""
    counts = _distinct_tickets(base, "flag_entrada_dia_util_anterior", "tipo_solicitacao")
    return counts.orderBy(F.desc("n"), "tipo_solicitacao").select(
        last_segment(F.col("tipo_solicitacao")).alias("tipo_solicitacao"), F.col("n").alias("qtde_tickets")
    )


def daily_resolved_assignee(base: DataFrame) -> DataFrame:
    counts = _distinct_tickets(base, "flag_resolvido_dia_util_anterior", "atribuido")
    return counts.orderBy(F.desc("n"), "atribuido").withColumnRenamed("n", "qtde_tickets_resolvidos")


def daily_hearings(base: DataFrame, window: dict[str, Any], state: str) -> DataFrame:
    """Hearings of the week by date, place, delegate and assignee; `state` is "aberta" or "encerrada"."""
    by = ("data_audiencia_efetiva", "local_procon", "preposto", "atribuido")
    counts = _distinct_tickets(base, f"flag_audiencia_semana_{state}", *by).withColumnRenamed("n", "qtde_audiencias")
    return counts.orderBy(
        "data_audiencia_efetiva", F.desc("qtde_audiencias"),
        *[F.col(c).asc_nulls_last() for c in ("local_procon", "preposto", "atribuido")],
    ).select(
        F.lit(window["today"]).alias("data_inicio_janela"), F.lit(window["week_end"]).alias("data_fim_janela"), "*"
    )


def overdue_hearings(base: DataFrame, today: date) -> DataFrame:
    """Hearings in the past whose ticket is not done.

    Given `daily_base`, only tickets in the daily window are looked at; given `hearing_base`, all are.
    """
    late = (
        (F.col("tem_audiencia") == 1)
        & (F.col("data_audiencia_efetiva") < F.lit(today))
        & ~F.col("status_normalizado").isin(*DONE_STATUSES)
    )
    return base.filter(late).select(*OVERDUE_COLUMNS).orderBy(
        "data_audiencia_efetiva", F.col("status").asc_nulls_last(), "atribuido", F.desc("ticket_id")
    )


def hearing_base(tickets: DataFrame, hearings: DataFrame, window: dict[str, Any]) -> DataFrame:
    """Every counted ticket with a hearing, in the columns of `daily_base`."""
    counted = tickets.filter(official("daily")).select(*TICKET_SIDE, "atribuido", "tipo_solicitacao", "titulo")
    return counted.join(hearings.select("ticket_id", *HEARING_SIDE), "ticket_id").select(*_columns(window))


def exception_movements(tickets: DataFrame, window: dict[str, Any]) -> DataFrame:
    """Creations and resolutions on the idle days before today; empty when there were none."""
    start, end = window["idle_start"], window["idle_end"]
    idle = F.lit(False) if start is None else (
        in_days(F.col("data_criacao"), start, end) | in_days(F.col("data_resolucao"), start, end)
    )
    return (
        tickets.filter(official("daily") & idle)
        .select(
            F.to_date("data_criacao").alias("data_entrada"),
            F.to_date("data_resolucao").alias("data_resolucao"),
            label_or(F.col("atribuido"), "NAO ATRIBUIDO").alias("atribuido"),
            label_or(F.col("tipo_solicitacao"), "NAO INFORMADO").alias("canal"),
        )
        .orderBy(*[F.col(c).asc_nulls_last() for c in ("data_entrada", "data_resolucao", "atribuido", "canal")])
        .withColumn("canal", last_segment(F.col("canal")))
    )


def report_dates(df: DataFrame, dates: tuple[str, ...], labels: tuple[str, ...]) -> DataFrame:
    """Dates cut to the day (bad ones null) and hierarchical labels cut to their last level."""
    return df.withColumns(
        {**{c: day_of(F.col(c)) for c in dates}, **{c: last_segment(F.col(c)) for c in labels}}
    )
