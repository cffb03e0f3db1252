"""Governance rules: removal, archiving, overrides and classification audit.

Ids and per-ticket values are data: they come in as small tables, `governed(ticket_id, regra)` and
`overrides(ticket_id, coluna, valor, prioridade)`. The joins carry no broadcast hint; Spark sends a side
to every task only when its measured size is below the session threshold, and shuffles it otherwise.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketlake.functions.keys import sha256_key
from ticketlake.functions.text import norm_class, norm_text
from ticketlake.operators.dedup import dedup_latest
from ticketlake.schemas import PURGE_COLUMNS

# Rule names of the governed-id table, audited channels, expected groups and labels.
REMOVED, ARCHIVED, GROUP_FIX, ATTACHMENT_FIX, AUDIT_EXCEPTION = (
    "REMOVIDO", "ARQUIVO_MANUAL", "GRUPO_MANUAL", "ANEXO_MANUAL", "EXCECAO_AUDITORIA",
)
AUDIT_CHANNELS = ("AGENCIA REGULADORA", "CEDOC", "CEJUSC", "CODECON", "DEFENSORIA", "JEC", "PROCON")
EXPECTED_GROUPS = ("OCEANO CANAIS DE ATRITO N2", "CANAIS DE ATRITO N2")
SUGGESTED_GROUP = "[routing]Oceano Canais de Atrito N2"
PRIVATE_GROUPS = ("[INTERNAL]TICKET PRIVADO OCEANO CANAIS DE ATRITO",)
NOTICE_ATTACHMENT = "Informativo::Anexo"
PENDING = "PENDENTE_VALIDACAO"
EXCEPTION_CHANNEL = "Reclame Aqui"
EXCEPTION_ORIGIN, EXCEPTION_REASON = "EXCECAO_OPERACIONAL", "EXCECAO_OPERACIONAL_RECLAME_AQUI"
EXCEPTION_NOTE = "Ticket encerrado incorretamente como canal de atrito no Zendesk; segregado para auditoria."
AUTOMATIC_ORIGIN, AUTOMATIC_REASON = (
    "REGRA_AUTOMATICA_GRUPO_CANAL", "POSSIVEL_CLASSIFICACAO_INCORRETA_GRUPO_CANAL",
)
AUTOMATIC_NOTE = "Validar grupo do ticket antes de eventual reclassificacao operacional."
DEFAULT_ORIGIN, DEFAULT_REASON = "AUDITORIA_CLASSIFICACAO", "CLASSIFICACAO_SUSPEITA"
OVERRIDABLE = ("grupo_tickets", "tipo_manifestacao", "classificacao_notificacoes", "atribuido")


def ids_of(governed: DataFrame, rule: str) -> DataFrame:
    return governed.filter(F.col("regra") == rule).select("ticket_id").distinct()


def _mark(df: DataFrame, ids: DataFrame, name: str) -> DataFrame:
    """Add a flag that tells whether the ticket is in `ids` (unique)."""
    marked = df.join(ids.withColumn(name, F.lit(True)), "ticket_id", "left")
    return marked.withColumn(name, F.coalesce(F.col(name), F.lit(False)))


def drop_removed(df: DataFrame, governed: DataFrame) -> DataFrame:
    return df.join(ids_of(governed, REMOVED), "ticket_id", "left_anti")


def archive_expression(listed: Column) -> Column:
    """1 for attachments, attachment notices, private groups and listed tickets."""
    notice = F.coalesce(norm_text(F.col("classificacao_notificacoes")), F.lit(""))
    tests = (
        F.coalesce(norm_text(F.col("tipo_manifestacao")) == "ANEXO", F.lit(False))
        | (notice.contains("INFORMATIVO") & notice.contains("ANEXO"))
        | F.coalesce(norm_text(F.col("grupo_tickets")).isin(*PRIVATE_GROUPS), F.lit(False))
        | listed
    )
    return tests.cast("int")


def archive_flag(df: DataFrame, governed: DataFrame) -> DataFrame:
    marked = _mark(df, ids_of(governed, ARCHIVED), "_listed")
    return marked.withColumn("flag_arquivado_relatorio", archive_expression(F.col("_listed"))).drop("_listed")


def bulk_overrides(governed: DataFrame, kind: str) -> DataFrame:
    """Override rows of the two governed lists, for one ticket kind."""
    attachment = (
        ("tipo_manifestacao", "ANEXO") if kind == "solicitacao" else ("classificacao_notificacoes", NOTICE_ATTACHMENT)
    )
    targets = {GROUP_FIX: ("grupo_tickets", SUGGESTED_GROUP), ATTACHMENT_FIX: attachment}
    column = F.lit(None).cast("string")
    value = F.lit(None).cast("string")
    for rule, (name, text) in targets.items():
        column = F.when(F.col("regra") == rule, F.lit(name)).otherwise(column)
        value = F.when(F.col("regra") == rule, F.lit(text)).otherwise(value)
    return governed.filter(F.col("regra").isin(*targets)).select(
        "ticket_id", column.alias("coluna"), value.alias("valor"), F.lit(0).alias("prioridade")
    )


def apply_overrides(
    df: DataFrame, overrides: DataFrame, governed: DataFrame, columns: Sequence[str] = OVERRIDABLE
) -> DataFrame:
    """Replace fields ticket by ticket (highest priority wins), then compute the archive flag again."""
    names = [c for c in columns if c in df.columns]
    wide = overrides.groupBy("ticket_id").agg(
        *[
            F.max_by(
                F.when(F.col("coluna") == c, F.struct("valor")),
                F.when(F.col("coluna") == c, F.col("prioridade")),
            ).alias(f"_novo_{c}")
            for c in names
        ]
    )
    changed = df.join(wide, "ticket_id", "left").withColumns(
        {c: F.when(F.col(f"_novo_{c}").isNotNull(), F.col(f"_novo_{c}")["valor"]).otherwise(F.col(c)) for c in names}
    )
    return archive_flag(changed.drop(*[f"_novo_{c}" for c in names]), governed)


def is_governed_channel(c: Column) -> Column:
    return F.coalesce(norm_class(c).rlike("^(" + "|".join(AUDIT_CHANNELS) + ")( |$)"), F.lit(False))


def is_expected_group(c: Column) -> Column:
    """A missing group counts as unexpected."""
    return F.coalesce(norm_class(c).isin(*EXPECTED_GROUPS), F.lit(False))


def audit_rules(df: DataFrame, governed: DataFrame, at: datetime) -> DataFrame:
    """Set aside tickets of a governed channel that sit in an unexpected group, and listed exceptions."""
    marked = _mark(df, ids_of(governed, AUDIT_EXCEPTION), "_excecao")
    automatic = (
        is_governed_channel(F.col("tipo_solicitacao"))
        & ~is_expected_group(F.col("grupo_tickets"))
        & ~F.col("_excecao")
        & (F.coalesce("flag_arquivado_relatorio", F.lit(0)) == 0)
    )
    marked = marked.withColumn("_automatica", automatic)
    listed, auto = F.col("_excecao"), F.col("_automatica")
    either = listed | auto
    channel = F.col("tipo_solicitacao")

    def pick(for_listed: str | None, for_auto: str | None) -> Column:
        return F.when(listed, F.lit(for_listed)).when(auto, F.lit(for_auto)).cast("string")

    return marked.withColumns(
        {
            "flag_auditoria_classificacao": either.cast("int"),
            "motivo_auditoria_classificacao": pick(EXCEPTION_REASON, AUTOMATIC_REASON),
            "status_auditoria_classificacao": pick(PENDING, PENDING),
            "grupo_sugerido_auditoria": pick(None, SUGGESTED_GROUP),
            "tipo_solicitacao_original_auditoria": F.when(either, channel),
            "data_auditoria_classificacao": F.when(either, F.lit(at).cast("timestamp_ntz")),
            "origem_regra_auditoria": pick(EXCEPTION_ORIGIN, AUTOMATIC_ORIGIN),
            "canal_normalizado_auditoria": F.when(either, norm_class(channel)),
            "observacao_auditoria_classificacao": pick(EXCEPTION_NOTE, AUTOMATIC_NOTE),
            "flag_arquivado_relatorio": F.when(either, F.lit(1)).otherwise(F.col("flag_arquivado_relatorio")),
            "tipo_solicitacao": F.when(listed, F.lit(EXCEPTION_CHANNEL)).otherwise(channel),
        }
    ).drop("_excecao", "_automatica")


def _flagged(df: DataFrame) -> DataFrame:
    return df.filter(F.coalesce(F.col("flag_auditoria_classificacao"), F.lit(0)) == 1)


def classification_audit(df: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """One audit row per flagged ticket."""
    rows = _flagged(df)
    if order:
        rows = dedup_latest(rows, ["ticket_id"], order)
    return rows.select(
        "ticket_id",
        F.col("origem_regra_auditoria").alias("origem_regra"),
        F.col("status_auditoria_classificacao").alias("status_auditoria"),
        F.col("motivo_auditoria_classificacao").alias("motivo_auditoria"),
        F.col("tipo_solicitacao_original_auditoria").alias("tipo_solicitacao_original"),
        F.col("tipo_solicitacao").alias("tipo_solicitacao_atual"),
        "grupo_tickets",
        F.col("grupo_sugerido_auditoria").alias("grupo_sugerido"),
        F.col("canal_normalizado_auditoria").alias("canal_normalizado"),
        "data_criacao",
        "data_resolucao",
        "atribuido",
        "titulo",
        F.col("observacao_auditoria_classificacao").alias("observacao"),
        "arquivo_origem",
    )


def operational_audit(df: DataFrame, at: datetime, order: Sequence[str] = ()) -> DataFrame:
    """One audit row per flagged ticket and reason, under a hashed key."""
    rows = _flagged(df)
    if order:
        rows = dedup_latest(rows, ["ticket_id", "motivo_auditoria_classificacao"], order)
    return rows.select(
        sha256_key(
            F.col("ticket_id"), F.col("origem_regra_auditoria"), F.col("motivo_auditoria_classificacao")
        ).alias("auditoria_operacional_key"),
        "ticket_id",
        F.coalesce("origem_regra_auditoria", F.lit(DEFAULT_ORIGIN)).alias("origem_regra"),
        F.coalesce("motivo_auditoria_classificacao", F.lit(DEFAULT_REASON)).alias("tipo_inconsistencia"),
        F.col("observacao_auditoria_classificacao").alias("descricao_inconsistencia"),
        F.lit(PENDING).alias("status_validacao"),
        F.lit(at).cast("timestamp_ntz").alias("data_identificacao"),
        F.lit(None).cast("timestamp_ntz").alias("data_validacao"),
        F.lit(None).cast("string").alias("validado_por"),
        F.lit(None).cast("string").alias("acao_tomada"),
        F.col("titulo").alias("observacao"),
    )


def purge_stale(audits: DataFrame, tickets: DataFrame, status: str) -> DataFrame:
    """Drop pending audit rows whose ticket is no longer flagged; validated rows stay."""
    return audits.sparkSession.sql(
        f"""
        SELECT a.* FROM {{audits}} a
        WHERE upper(trim(coalesce(a.{status}, ''))) <> '{PENDING}'
           OR EXISTS (
                SELECT 1 FROM {{tickets}} t
                WHERE t.ticket_id = a.ticket_id AND coalesce(t.flag_auditoria_classificacao, 0) = 1)
        """,
        audits=audits,
        tickets=tickets,
    )


def purge_removed(tables: Mapping[str, DataFrame], governed: DataFrame) -> dict[str, DataFrame]:
    """Tables without any row that names a removed ticket in one of its id columns."""
    removed = ids_of(governed, REMOVED)
    kept = {}
    for name, df in tables.items():
        for column in PURGE_COLUMNS.get(name, ()):
            df = df.join(removed.withColumnRenamed("ticket_id", column), column, "left_anti").select(*df.columns)
        kept[name] = df
    return kept


def backfill_territory(df: DataFrame) -> DataFrame:
    """Compute the block where it is missing or unknown; other rows keep theirs."""
    account = F.trim(F.coalesce("matricula", F.lit("")))
    known = F.coalesce(F.col("bloco").isin("Bloco 1", "Bloco 4"), F.lit(False))
    computed = F.when(account.startswith("40"), "Bloco 4").when(account.startswith("10"), "Bloco 1")
    return df.withColumn("bloco", F.when(known, F.col("bloco")).otherwise(computed))
