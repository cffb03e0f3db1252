"""Which rows count: partitions by form, official filters, orphans."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketlake.functions.text import norm_text, upper_trim

# Form prefixes of the two ticket kinds and status labels.
FORM_PREFIX = {"solicitacao": "SOLICIT", "notificacao": "NOTIFIC"}
ATTACHMENT = "ANEXO"
ATTACHMENT_NOTICE = "INFORMATIVO::ANEXO"
OPEN_STATUSES = ("OPEN", "HOLD", "PENDING", "NEW")
DONE_STATUSES = ("SOLVED", "CLOSED")
VIEW_DONE_STATUSES = ("RESOLVIDO", "FECHADO", "RESOLVIDO/FECHADO")
BI_DONE_STATUSES = ("SOLVED", "CLOSED", "RESOLVIDO", "FECHADO")
BI_OPEN_STATUSES = ("OPEN", "NEW", "HOLD", "PENDING", "ABERTO")


def split_by_form(df: DataFrame, kind: str) -> DataFrame:
    """Rows of one kind; rows without a form belong to both."""
    matches = norm_text(F.col("formulario_ticket")).startswith(FORM_PREFIX[kind])
    return df.filter(F.coalesce(matches, F.lit(True)))


def partition_overlap(requests: DataFrame, notices: DataFrame) -> DataFrame:
    return requests.select("ticket_id").join(notices.select("ticket_id"), "ticket_id", "left_semi").distinct()


def assert_disjoint(requests: DataFrame, notices: DataFrame) -> None:
    sample = [row[0] for row in partition_overlap(requests, notices).take(5)]
    if sample:
        raise RuntimeError(f"Tickets in both kinds, such as {sorted(sample)}.")


def orphan_filter(hearings: DataFrame, tickets: DataFrame) -> DataFrame:
    """Hearings whose ticket exists."""
    return hearings.join(tickets.select("ticket_id"), "ticket_id", "left_semi")


def not_archived() -> Column:
    return F.coalesce(F.col("flag_arquivado_relatorio"), F.lit(0)) == 0


def is_request_form() -> Column:
    return F.col("formulario_ticket").isNull() | upper_trim(F.col("formulario_ticket")).startswith("SOLICIT")


def _not(column: str, value: str) -> Column:
    return upper_trim(F.col(column)) != value


def _hard_blank_safe(column: str, value: str) -> Column:
    text = F.translate(F.coalesce(F.col(column), F.lit("")), "\xa0", " ")
    return F.upper(F.trim(text)) != value


def _bi_form() -> Column:
    return F.upper(F.coalesce(F.col("formulario_ticket"), F.lit(""))).startswith("SOLICIT")


def _bi_not(column: str, value: str) -> Column:
    return F.upper(F.coalesce(F.col(column), F.lit(""))) != value


def official(variant: str) -> Column:
    """Tickets that count, in the sense of one consumer; the variants differ on purpose."""
    tests = {
        "report": lambda: [not_archived(), is_request_form()],
        "daily": lambda: [not_archived(), is_request_form(), _not("tipo_manifestacao", ATTACHMENT)],
        "service": lambda: [
            not_archived(), is_request_form(), _not("tipo_manifestacao", ATTACHMENT),
            _not("tipo_solicitacao", ATTACHMENT_NOTICE),
        ],
        "bi": lambda: [
            not_archived(), _bi_form(), _bi_not("tipo_manifestacao", ATTACHMENT),
            _bi_not("classificacao_notificacoes", ATTACHMENT_NOTICE),
        ],
        "sanitized": lambda: [
            not_archived(), _hard_blank_safe("tipo_manifestacao", ATTACHMENT),
            _hard_blank_safe("classificacao_notificacoes", ATTACHMENT_NOTICE),
        ],
    }[variant]()
    return reduce(lambda a, b: a & b, tests)


OFFICIAL_VARIANTS = ("report", "daily", "service", "bi", "sanitized")


def official_counts(tickets: DataFrame) -> DataFrame:
    """Tickets that pass each variant, in one pass."""
    return tickets.agg(*[F.count_if(official(v)).alias(f"qtde_{v}") for v in OFFICIAL_VARIANTS])
