"""Persistence, run log and whole-batch queries."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketlake.catalog.ingest import transform_sql
from ticketlake.catalog.inputs import AT, TODAY, governed, hearings, raw_general, table, tickets, view
from ticketlake.catalog.orders import feed, manual_links
from ticketlake.catalog.registry import query
from ticketlake.operators import persistence
from ticketlake.plans.batch import Rules, build_gold, build_silver
from ticketlake.plans.runs import last_run as latest_steps
from ticketlake.schemas import GOLD, HISTORY, HISTORY_COLUMNS
from ticketlake.session import empty_frame

LATER = datetime(1998, 4, 21, 6, 30, 0)


@query(
    "upsert",
    """
    WITH alvo AS (SELECT ticket_id, status, titulo, municipio FROM tickets WHERE ticket_id % 3 <> 0),
    novo AS (SELECT ticket_id, CASE WHEN ticket_id % 10 = 0 THEN NULL ELSE 'NOVO' END AS status, upper(coalesce(municipio, '')) || '!' AS municipio FROM tickets WHERE ticket_id % 2 = 0)
    SELECT coalesce(a.ticket_id, n.ticket_id) AS ticket_id, CASE WHEN n.ticket_id IS NOT NULL THEN n.status ELSE a.status END AS status, a.titulo,
      CASE WHEN n.ticket_id IS NOT NULL THEN n.municipio ELSE a.municipio END AS municipio FROM alvo a FULL JOIN novo n ON n.ticket_id = a.ticket_id
    """,
)
def upsert(spark, sf):
    t = tickets(spark, sf)
    target = t.filter("ticket_id % 3 <> 0").select("ticket_id", "status", "titulo", "municipio")
    changed = F.when(F.col("ticket_id") % 10 == 0, F.lit(None)).otherwise(F.lit("NOVO"))
    place = F.concat(F.upper(F.coalesce("municipio", F.lit(""))), F.lit("!"))
    source = t.filter("ticket_id % 2 = 0").select("ticket_id", changed.alias("status"), place.alias("municipio"))
    return persistence.upsert(target, source, "ticket_id")


# Columns and forms of the version hash, written out here and not taken from the operator.
HASH_SQL = """sha256(CAST(to_json({
    'assunto': assunto, 'atribuido': atribuido, 'case_id': case_id,
    'data_criacao': strftime(data_criacao, '%Y-%m-%d %H:%M:%S'), 'data_resolucao': strftime(data_resolucao, '%Y-%m-%d %H:%M:%S'),
    'flag_arquivado_relatorio': CAST(flag_arquivado_relatorio AS VARCHAR), 'grupo_tickets': grupo_tickets, 'matricula': matricula,
    'numero_os': CAST(numero_os AS VARCHAR), 'resultado_tratativa': resultado_tratativa, 'status': status,
    'status_vinculo': status_vinculo, 'ticket_id': CAST(ticket_id AS VARCHAR),
    'ticket_notificacao_id': CAST(ticket_notificacao_id AS VARCHAR), 'tipo_manifestacao': tipo_manifestacao,
    'tipo_solicitacao': tipo_solicitacao, 'titulo': titulo}) AS VARCHAR))"""
SCD_OUT = ("ticket_id", "status", "data_inicio_vigencia", "data_fim_vigencia", "flag_ativo", "run_id", "hash_dados")


def _snapshots(spark, sf):
    """Yesterday's tickets, and today's: some changed, some gone, some new."""
    t = tickets(spark, sf).select(*HISTORY_COLUMNS)
    first = t.filter("ticket_id % 7 <> 0")
    second = t.filter("ticket_id % 11 <> 0").withColumn(
        "status", F.when(F.col("ticket_id") % 5 == 0, F.lit("REABERTO")).otherwise(F.col("status"))
    )
    return first, second


def _history(spark, sf):
    first, second = _snapshots(spark, sf)
    empty = empty_frame(spark, HISTORY)
    opened = persistence.scd2(empty, first, "r1", AT)
    return opened, persistence.scd2(opened, second, "r2", LATER), second


@query(
    "scd2",
    f"""
    WITH a AS (SELECT *, {HASH_SQL} AS h FROM tickets WHERE ticket_id % 7 <> 0),
    b0 AS (SELECT * REPLACE (CASE WHEN ticket_id % 5 = 0 THEN 'REABERTO' ELSE status END AS status) FROM tickets WHERE ticket_id % 11 <> 0),
    b AS (SELECT *, {HASH_SQL} AS h FROM b0),
    c AS (SELECT b.* FROM b LEFT JOIN a ON a.ticket_id = b.ticket_id WHERE a.h IS NULL OR a.h <> b.h)
    SELECT ticket_id, status, TIMESTAMP '{AT}' AS data_inicio_vigencia, CASE WHEN ticket_id IN (SELECT ticket_id FROM c) THEN TIMESTAMP '{LATER}' END AS data_fim_vigencia,
      CASE WHEN ticket_id IN (SELECT ticket_id FROM c) THEN 0 ELSE 1 END AS flag_ativo, 'r1' AS run_id, h AS hash_dados FROM a
    UNION ALL SELECT ticket_id, status, TIMESTAMP '{LATER}', NULL, 1, 'r2', h FROM c
    """,
    stamps=("data_inicio_vigencia", "data_fim_vigencia"),
)
def scd2(spark, sf):
    return _history(spark, sf)[1].select(*SCD_OUT)


@query(
    "sync_validity",
    f"""
    WITH m AS (SELECT ticket_id, CASE WHEN ticket_id % 11 = 0 THEN NULL WHEN ticket_id % 7 = 0 OR (ticket_id % 5 = 0) THEN 1 ELSE 0 END AS mudou FROM tickets)
    SELECT t.ticket_id, CASE WHEN mudou = 1 THEN TIMESTAMP '{LATER}' WHEN mudou = 0 AND t.ticket_id % 2 = 0 THEN TIMESTAMP '{LATER}' WHEN t.ticket_id % 2 = 0 THEN NULL ELSE data_inicio_vigencia END AS data_inicio_vigencia,
      data_fim_vigencia, CASE WHEN mudou IS NOT NULL THEN 1 ELSE flag_ativo END AS flag_ativo FROM tickets t JOIN m ON m.ticket_id = t.ticket_id
    """,
    stamps=("data_inicio_vigencia", "data_fim_vigencia"),
)
def sync_validity(spark, sf):
    opened, _, second = _history(spark, sf)
    changed = persistence.changed_tickets(opened, second)
    stored = tickets(spark, sf).select(
        "ticket_id",
        F.when(F.col("ticket_id") % 2 == 0, F.lit(None)).otherwise(F.col("data_inicio_vigencia")).alias(
            "data_inicio_vigencia"
        ),
        "data_fim_vigencia", "flag_ativo",
    )
    return persistence.sync_validity(stored, second, changed, LATER)


# ---- run log: users of the event table stand for runs, their events for steps ------------------------------
RUNS_SQL = "r AS (SELECT CAST(user_id AS VARCHAR) AS run_id, max(ts) AS data_inicio FROM events GROUP BY user_id)"


@query(
    "last_run",
    f"""
    WITH {RUNS_SQL}, u AS (SELECT run_id FROM r ORDER BY data_inicio DESC LIMIT 1)
    SELECT run_id, 'SUCCESS' AS status_execucao, ts AS timestamp_log, 'INFO' AS nivel, CAST(event_id AS VARCHAR) AS etapa, event_type AS status, event_id AS volume_processado, value AS tempo_etapa, CAST(NULL AS VARCHAR) AS erro
    FROM events JOIN u ON run_id = CAST(user_id AS VARCHAR)
    """,
    stamps=("timestamp_log",),
)
def last_run(spark, sf):
    events = table(spark, sf, "events")
    runs = events.groupBy(F.col("user_id").cast("string").alias("run_id")).agg(
        F.max("ts").alias("data_inicio"), F.max("ts").alias("data_execucao")
    ).withColumn("status", F.lit("SUCCESS"))
    steps = events.select(
        F.col("user_id").cast("string").alias("run_id"), F.col("ts").alias("timestamp_log"), F.lit("INFO").alias("nivel"),
        F.col("event_id").cast("string").alias("etapa"), F.col("event_type").alias("status"),
        F.col("event_id").alias("volume_processado"), F.col("value").alias("tempo_etapa"),
        F.lit(None).cast("string").alias("erro"),
    )
    return latest_steps(runs, steps)


@query(
    "step_log",
    "SELECT event_id, CAST(to_json({'etapa': event_type, 'erro': CASE WHEN event_type = 'error' THEN props END, 'volume_processado': user_id}) AS VARCHAR) AS payload_json FROM events",
)
def step_log(spark, sf):
    row = F.struct(
        F.col("event_type").alias("etapa"),
        F.when(F.col("event_type") == "error", F.col("props")).alias("erro"),
        F.col("user_id").alias("volume_processado"),
    )
    return table(spark, sf, "events").select(
        "event_id", F.to_json(row, {"ignoreNullFields": "false"}).alias("payload_json")
    )


def _brought_sql(kind: str) -> str:
    return f"({transform_sql(kind)} SELECT ticket_id, matricula, coalesce(protocolo_agenersa, CAST(ticket_id AS VARCHAR)) AS case_id, auto OR exc = 1 AS marcado FROM c WHERE formulario_ticket IS NOT NULL)"


@query(
    "batch_counts",
    f"""
    WITH r AS {_brought_sql("solicitacao")}, n AS {_brought_sql("notificacao")}, ambos AS (SELECT * FROM r UNION ALL SELECT * FROM n),
    fora AS (SELECT ticket_id FROM governed WHERE regra = 'REMOVIDO')
    SELECT 'clientes' AS tabela, count(DISTINCT matricula) AS linhas FROM ambos
    UNION ALL SELECT 'cases', count(DISTINCT case_id) FROM ambos
    UNION ALL SELECT unnest(['tickets', 'ticket_assunto', 'ticket_relacionamentos', 'tickets_historico']), (SELECT count(DISTINCT ticket_id) FROM r)
    UNION ALL SELECT 'tickets_notificacao', count(DISTINCT ticket_id) FROM n
    UNION ALL SELECT 'tickets_n1', count(*) FROM tickets WHERE formulario_ticket IS NOT NULL AND ticket_id % 101 <> 0 AND ticket_id NOT IN (SELECT ticket_id FROM fora)
    UNION ALL SELECT 'ticket_vinculos_manuais', 0
    UNION ALL SELECT unnest(['tickets_auditoria_classificacao', 'tickets_auditoria_operacional']), (SELECT count(*) FROM r WHERE marcado)
    UNION ALL SELECT 'audiencias', count(*) FROM hearings WHERE ticket_id IN (SELECT ticket_id FROM r) AND ticket_audiencia_id NOT IN (SELECT ticket_id FROM fora)
    """,
)
def batch_counts(spark, sf):
    """Rows of every stored table after one whole batch over all tickets, hearings and work orders."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("linhas")).select(F.lit(name).alias("tabela"), "linhas")
        for name, df in _after_batch(spark, sf).items()
    ]
    total = counts[0]
    for other in counts[1:]:
        total = total.unionByName(other)
    return total


def _after_batch(spark, sf):
    """Stored tables after one batch that began with none."""
    raw = raw_general(spark, sf).filter(F.col("`Formulário de ticket`").isNotNull())
    h = hearings(spark, sf)
    hearing_feed = h.select(
        F.col("ticket_audiencia_id").cast("string").alias("ID do ticket"),
        F.col("ticket_id").cast("string").alias("Ticket relacionado ID"),
        F.date_format("data_audiencia", "yyyy-MM-dd HH:mm:ss").alias("Data da audiência - Carimbo de data/hora"),
        F.col("preposto").alias("Preposto (name)"),
    )
    manual = manual_links(tickets(spark, sf).filter("ticket_id % 2 = 0"))
    rules = Rules(governed(spark, sf), view(spark, sf, "field_overrides"), manual)
    feeds = {"zendesk_geral": raw, "zendesk_n1": raw, "audiencias": hearing_feed, "gss": feed(spark, sf)}
    silver = build_silver(feeds, rules, TODAY, AT)
    stored = {name: empty_frame(spark, schema) for name, (schema, _) in GOLD.items()}
    return build_gold(silver, stored, rules, "r1", AT)


@query(
    "batch_contents",
    f"""
    WITH r AS {_brought_sql("solicitacao")}, n AS {_brought_sql("notificacao")},
    fora AS (SELECT ticket_id FROM governed WHERE regra = 'REMOVIDO')
    SELECT 'clientes' AS tabela, matricula AS chave, matricula, CAST(NULL AS VARCHAR) AS case_id FROM (SELECT matricula FROM r UNION SELECT matricula FROM n) WHERE matricula IS NOT NULL
    UNION ALL SELECT 'cases', case_id, NULL, case_id FROM (SELECT case_id FROM r UNION SELECT case_id FROM n)
    UNION ALL SELECT 'tickets', CAST(ticket_id AS VARCHAR), matricula, case_id FROM r
    UNION ALL SELECT 'tickets_historico', CAST(ticket_id AS VARCHAR), matricula, case_id FROM r
    UNION ALL SELECT 'tickets_notificacao', CAST(ticket_id AS VARCHAR), matricula, case_id FROM n
    UNION ALL SELECT unnest(['tickets_auditoria_classificacao', 'tickets_auditoria_operacional']), CAST(ticket_id AS VARCHAR), NULL, NULL FROM r WHERE marcado
    UNION ALL SELECT 'audiencias', CAST(ticket_audiencia_id AS VARCHAR), NULL, NULL FROM hearings WHERE ticket_id IN (SELECT ticket_id FROM r) AND ticket_audiencia_id NOT IN (SELECT ticket_id FROM fora)
    """,
)
def batch_contents(spark, sf):
    """Key, account and case of every row of the stored tables after one whole batch."""
    gold = _after_batch(spark, sf)
    keys = {
        "clientes": ("matricula", "matricula", None),
        "cases": ("case_id", None, "case_id"),
        "tickets": ("ticket_id", "matricula", "case_id"),
        "tickets_historico": ("ticket_id", "matricula", "case_id"),
        "tickets_notificacao": ("ticket_id", "matricula", "case_id"),
        "tickets_auditoria_classificacao": ("ticket_id", None, None),
        "tickets_auditoria_operacional": ("ticket_id", None, None),
        "audiencias": ("ticket_audiencia_id", None, None),
    }
    frames = [
        gold[name].select(
            F.lit(name).alias("tabela"), F.col(key).cast("string").alias("chave"),
            (F.col(account) if account else F.lit(None).cast("string")).alias("matricula"),
            (F.col(case) if case else F.lit(None).cast("string")).alias("case_id"),
        )
        for name, (key, account, case) in keys.items()
    ]
    return reduce(DataFrame.unionByName, frames)
