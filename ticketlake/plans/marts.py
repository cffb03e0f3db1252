"""Star-schema marts and clean extracts over the stored tables."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketlake.functions.dates import MONTH_NAMES, day_of, first_in_days, name_from
from ticketlake.functions.text import clean_subject, clean_ws, collapse_spaces, first_nonblank, label_or, last_segment
from ticketlake.operators.filters import not_archived, official

# Columns and labels of the output.
FACT_COLUMNS = (
    "ticket_id", "case_id", "matricula", "bloco", "numero_os", "data_criacao", "data_resolucao", "status",
    "atribuido", "titulo", "assunto", "tipo_solicitacao", "tipo_manifestacao", "resultado_tratativa",
    "grupo_tickets", "canal_origem", "classificacao_solicitacoes", "classificacao_notificacoes",
    "flag_arquivado_relatorio", "flag_auditoria_classificacao", "qtde_assuntos_ticket",
    "flag_multiplos_assuntos", "ticket_notificacao_id", "status_vinculo", "data_inicio_vigencia",
    "data_fim_vigencia", "flag_ativo",
)
# Columns and labels of the output.
HEARING_FACT_COLUMNS = (
    "ticket_id", "ticket_audiencia_id", "ticket_relacionado_id", "audiencia", "data_audiencia", "status_ticket",
    "preposto_id", "preposto", "local_procon", "tipo_audiencia", "atribuido", "data_reagendamento",
)
# Columns and labels of the output.
AI_TEXT = {
    "titulo": "titulo", "assunto": "assunto", "canal_semantico": "tipo_solicitacao",
    "tipo_manifestacao": "tipo_manifestacao", "resultado_tratativa": "resultado_tratativa",
    "classificacao_solicitacoes": "classificacao_solicitacoes",
    "classificacao_notificacoes": "classificacao_notificacoes", "grupo_tickets": "grupo_tickets",
    "municipio": "municipio", "bairro": "bairro", "endereco": "endereco",
}
# Columns and labels of the output.
SANITIZED_COLUMNS = (
    "data_criacao", "data_resolucao", "ticket_id", "atribuido", "formulario_ticket", "tags_ticket", "grupo_tickets",
    "matricula", "superintendencia_adr", "canal_origem", "cpf_cliente", "passou_nivel_1", "canais_de_atrito",
    "tipo_solicitacao", "motivo_espera", "prioridade_ticket", "titulo", "classificacao_notificacoes",
    "tipo_manifestacao", "resultado_tratativa", "controle_interno", "numero_os", "status", "concessionaria",
    "classificacao_solicitacoes", "assunto", "local_procon", "audiencia", "nome_solicitante", "email_solicitante",
    "bloco", "bairro", "municipio", "logradouro", "endereco", "numero_porta", "complemento", "telefone",
    "nome_cliente_gss", "nome_requerente_gss", "tipo_audiencia", "data_audiencia", "preposto", "data_reagendamento",
    "case_id", "case_jec", "protocolo_referencia",
)
LISTING_DATES = ("data_resolucao", "data_criacao", "data_entrada")


def active_tickets(tickets: DataFrame) -> DataFrame:
    return tickets.filter(F.coalesce("flag_ativo", F.lit(1)) == 1)


def fact_tickets(tickets: DataFrame) -> DataFrame:
    return active_tickets(tickets).filter(not_archived()).select(*FACT_COLUMNS)


def fact_hearings(tickets: DataFrame, hearings: DataFrame) -> DataFrame:
    """Hearings of tickets that are not archived, and hearings without an active ticket."""
    archived = active_tickets(tickets).filter(~not_archived()).select("ticket_id")
    return hearings.join(archived, "ticket_id", "left_anti").select(*HEARING_FACT_COLUMNS)


def dim_time(tickets: DataFrame, hearings: DataFrame) -> DataFrame:
    """One row per day on which anything happened."""
    days = (
        tickets.select(F.explode(F.array(day_of(F.col("data_criacao")), day_of(F.col("data_resolucao")))).alias("d"))
        .distinct()
        .union(
            hearings.select(
                F.explode(F.array(day_of(F.col("data_audiencia")), day_of(F.col("data_reagendamento")))).alias("d")
            ).distinct()
        )
        .filter(F.col("d").isNotNull())
        .distinct()
    )
    d = F.col("d")
    return days.select(
        F.date_format(d, "yyyyMMdd").alias("data_key"),
        d.alias("data_calendario"),
        F.year(d).alias("ano"),
        F.month(d).alias("mes"),
        F.dayofmonth(d).alias("dia"),
        F.date_format(d, "yyyy-MM").alias("ano_mes"),
        F.quarter(d).alias("trimestre"),
        name_from(F.month(d), MONTH_NAMES).alias("nome_mes"),
        (F.dayofweek(d) - 1).alias("dia_semana_num"),
    )


def _dim(df: DataFrame, column: str, key: str, label: str, default: str) -> DataFrame:
    value = F.coalesce(F.col(column), F.lit(default))
    return df.select(value.alias(key), value.alias(label)).distinct()


def dim_channel(fact: DataFrame) -> DataFrame:
    return _dim(fact, "tipo_solicitacao", "canal_key", "canal", "NAO_INFORMADO")


def dim_status(fact: DataFrame) -> DataFrame:
    return _dim(fact, "status", "status_key", "status", "NAO_INFORMADO")


def dim_assignee(fact: DataFrame) -> DataFrame:
    return _dim(fact, "atribuido", "atribuido_key", "atribuido", "NAO_ATRIBUIDO")


def dim_subject(subjects: DataFrame) -> DataFrame:
    return _dim(subjects, "assunto_normalizado", "assunto_key", "assunto_normalizado", "SEM_ASSUNTO")


def ai_ready(tickets: DataFrame) -> DataFrame:
    """Current tickets with clean, never-null text columns."""
    text = [
        collapse_spaces(F.coalesce(F.col(source), F.lit(""))).alias(name) for name, source in AI_TEXT.items()
    ]
    return active_tickets(tickets).filter(not_archived()).select(
        "ticket_id", "case_id", "matricula", "bloco", "data_criacao", "data_resolucao", "status", "atribuido", *text,
        F.coalesce("flag_auditoria_classificacao", F.lit(0)).alias("flag_auditoria_classificacao"),
    )


def hearing_columns(hearings: DataFrame, *names: str) -> DataFrame:
    """Hearing columns under their own names, ready for a join on the ticket id."""
    return hearings.select("ticket_id", *names)


def sanitized_base(tickets: DataFrame, notices: DataFrame, hearings: DataFrame, cases: DataFrame) -> DataFrame:
    """Clean extract of both ticket tables with hearings, newest first.

    What hearings and cases add is brought together by ticket id on narrow rows first, so whole rows are shuffled once for
    it, and once for the order.
    """
    from_hearing = ("local_procon", "audiencia", "tipo_audiencia", "data_audiencia", "preposto", "data_reagendamento")
    aside = hearing_columns(hearings, *from_hearing)
    needed = [c for c in SANITIZED_COLUMNS if c not in (*from_hearing, "protocolo_referencia")]
    needed += ["protocolo_referencia_informado", "protocolo_procon", "protocolo_defensoria", "protocolo_codecon"]

    def branch(df: DataFrame) -> DataFrame:
        return df.filter(official("sanitized")).select(*needed)

    both = branch(tickets).unionByName(branch(notices))
    numbered = cases.filter(F.col("protocolo_agenersa").isNotNull()).select("case_id", "protocolo_agenersa")
    # An id may stand in both tables with different cases.
    of_case = both.select("ticket_id", "case_id").join(numbered, "case_id").groupBy("ticket_id").agg(
        F.collect_set(F.struct("case_id", "protocolo_agenersa")).alias("_casos")
    )
    joined = both.join(aside.join(of_case, "ticket_id", "full"), "ticket_id", "left")
    own = F.get(F.filter("_casos", lambda x: x["case_id"] == F.col("case_id")), F.lit(0))
    joined = joined.withColumn("protocolo_agenersa", own["protocolo_agenersa"])
    reference = F.coalesce(
        *[
            F.nullif(F.trim(F.col(c)), F.lit(""))
            for c in (
                "protocolo_referencia_informado", "protocolo_agenersa", "protocolo_procon", "protocolo_defensoria",
                "protocolo_codecon", "case_jec",
            )
        ]
    )
    joined = joined.withColumn("protocolo_referencia", reference)

    def cell(name: str):
        if name.startswith("data_"):
            return day_of(F.col(name)).alias(name)
        if name == "ticket_id":
            return F.col(name)
        return (clean_subject if name == "assunto" else clean_ws)(F.col(name)).alias(name)

    # Sorted on raw values first: the sort samples its input, and cleaning should run once.
    ordered = joined.orderBy(day_of(F.col("data_criacao")).desc_nulls_last(), F.col("ticket_id").desc())
    return ordered.select(*[cell(c) for c in SANITIZED_COLUMNS])


def entry_day():
    """Official entry day: of the complaint, else of the ticket."""
    return F.to_date(F.coalesce("data_entrada_reclamacao", "data_criacao"))


def processed_tickets_listing(
    tickets: DataFrame, date_field: str, start: date, end: date, limit: int | None = 50
) -> DataFrame:
    """Newest tickets of a period without personal data, and how many there are in all.

    The listing is a top-k report of `limit` rows (None: all of them), while `total` counts every match.
    """
    if date_field not in LISTING_DATES:
        raise ValueError(f"date_field must be one of {LISTING_DATES}")
    if limit is not None and limit < 1:
        raise ValueError("limit must be at least 1, or None for all rows")
    dates = ("data_entrada_reclamacao", "data_criacao") if date_field == "data_entrada" else (date_field,)
    raw = F.coalesce(*dates)
    matching = tickets.filter(official("service") & first_in_days(dates, start, end))
    total = matching.select("ticket_id").distinct().agg(F.count(F.lit(1)).alias("total"))
    newest = matching.withColumn("_dia", F.to_date(raw)).orderBy(F.desc("_dia"), F.desc("ticket_id"))
    top = (
        (newest if limit is None else newest.limit(limit))
        .select(
            "ticket_id",
            F.to_date("data_criacao").alias("data_criacao"),
            F.to_date("data_resolucao").alias("data_resolucao"),
            "status",
            label_or(F.col("atribuido"), "NAO ATRIBUIDO").alias("atribuido"),
            last_segment(label_or(F.col("tipo_solicitacao"), "NAO INFORMADO"), missing="NAO INFORMADO").alias(
                "canal_normalizado"
            ),
            "tipo_manifestacao",
            "classificacao_solicitacoes",
            "formulario_ticket",
        )
    )
    return top.crossJoin(F.broadcast(total))  # one row


def semantic_marts(tickets: DataFrame, hearings: DataFrame, subjects: DataFrame) -> dict:
    """The seven marts of the semantic layer, each built on demand."""
    return {
        "fato_tickets": lambda: fact_tickets(tickets),
        "fato_audiencias": lambda: fact_hearings(tickets, hearings),
        "dim_tempo": lambda: dim_time(tickets, hearings),
        "dim_canal": lambda: dim_channel(fact_tickets(tickets)),
        "dim_status": lambda: dim_status(fact_tickets(tickets)),
        "dim_atribuido": lambda: dim_assignee(fact_tickets(tickets)),
        "dim_assunto": lambda: dim_subject(subjects),
    }
