"""From raw feeds to canonical rows: one projection chain per feed."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketlake.functions.keys import PROTOCOL_PATTERNS, case_id, court_case_key, protocols
from ticketlake.functions.text import blank_to_null, first_nonblank, norm_identifier, norm_subject, strip, territory
from ticketlake.operators.filters import split_by_form
from ticketlake.operators.rules import apply_overrides, audit_rules, bulk_overrides, drop_removed
from ticketlake.schemas import HEARING_ALIASES, HEARING_FEED, N1_ALIASES, N1_FEED, TICKET_ALIASES, TICKET_FEED
from ticketlake.sources.canonical import canonicalize, channel_coalesce, explicit_link_key


def _with_id(df: DataFrame, column: str = "ticket_id") -> DataFrame:
    return df.filter(F.col(column).isNotNull())


def canonical_tickets(raw: DataFrame, governed: DataFrame) -> DataFrame:
    """Canonical rows of the general feed, of both kinds, without removed tickets."""
    return drop_removed(_with_id(canonicalize(raw, TICKET_ALIASES, TICKET_FEED, keep_extra=True)), governed)


def transform_tickets(
    raw: DataFrame, kind: str, governed: DataFrame, overrides: DataFrame | None, at: datetime
) -> DataFrame:
    """Canonical tickets of one kind ("solicitacao" or "notificacao") from the general feed."""
    return tickets_of_kind(canonical_tickets(raw, governed), kind, governed, overrides, at)


def tickets_of_kind(
    canonical: DataFrame, kind: str, governed: DataFrame, overrides: DataFrame | None, at: datetime
) -> DataFrame:
    """Tickets of one kind from the canonical rows of both."""
    df = canonical.withColumns(
        {
            "tipo_ticket_zendesk": F.lit(kind.upper()),
            "chave_explicita_vinculo": explicit_link_key(canonical),
            "formulario_ticket": strip(F.col("formulario_ticket")),
        }
    )
    df = split_by_form(df, kind)
    df = df.withColumns(
        {
            "matricula": norm_identifier(F.col("matricula")),
            "numero_os": norm_identifier(F.col("numero_os")),
            "cpf_cliente": norm_identifier(F.col("cpf_cliente")),
            "protocolo_referencia_informado": blank_to_null(F.col("protocolo_referencia_informado")),
        }
    ).withColumn("bloco", territory(F.col("matricula")))
    df = channel_coalesce(df)
    rows = bulk_overrides(governed, kind)
    if overrides is not None:
        rows = rows.unionByName(overrides.select("ticket_id", "coluna", "valor", "prioridade"))
    df = apply_overrides(df, rows, governed)
    df = df.withColumns(protocols(F.col("titulo"))).withColumns(
        {
            "case_id": case_id(F.col("protocolo_agenersa"), F.col("ticket_id")),
            "case_jec": court_case_key(
                *[F.col(c) for c in ("tipo_solicitacao", "tipo_manifestacao", "cpf_cliente", "matricula", "assunto")]
            ),
            "assunto_normalizado": norm_subject(F.coalesce("assunto", "titulo")),
        }
    )
    df = df.withColumn(
        "protocolo_referencia",
        first_nonblank(*[F.col(c) for c in ("protocolo_referencia_informado", *PROTOCOL_PATTERNS, "case_jec")]),
    )
    return audit_rules(df, governed, at) if kind == "solicitacao" else df


def _with_order(raw: DataFrame, aliases: dict, schema: dict) -> DataFrame:
    """Canonical rows, with the input order where the feed is stamped with it."""
    order = [c for c in raw.columns if c == "row_seq"]
    return canonicalize(raw, aliases, schema, keep_extra=True).select(*schema, *order)


def transform_n1(raw: DataFrame, governed: DataFrame) -> DataFrame:
    """Level-1 tickets; they never enter the level-2 metrics."""
    df = drop_removed(_with_id(_with_order(raw, N1_ALIASES, N1_FEED)), governed)
    df = df.withColumn("matricula", norm_identifier(F.col("matricula")))
    return df.withColumn("bloco", territory(F.col("matricula")))


def transform_hearings(raw: DataFrame, governed: DataFrame) -> DataFrame:
    """Hearings keyed by the related ticket, else by their own id."""
    df = _with_order(raw, HEARING_ALIASES, HEARING_FEED)
    df = _with_id(df.withColumn("ticket_id", F.coalesce("ticket_relacionado_id", "ticket_audiencia_id")))
    return drop_removed(df, governed).withColumns(
        {"audiencia": F.lit("TRUE"), "local_procon": F.lit(None).cast("string")}
    )


def silver_general(requests: DataFrame, notices: DataFrame) -> DataFrame:
    """Requests and notices together, by creation and id, undated last."""
    both = requests.unionByName(notices, allowMissingColumns=True)
    return both.orderBy(F.col("data_criacao").asc_nulls_last(), F.col("ticket_id").asc_nulls_last())
