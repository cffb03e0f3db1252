"""Filter, governance, audit and quality queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ticketlake.catalog.ingest import (
    ARCHIVE_SQL, CHANNEL_CLASS, GOVERNED_SQL, OVERRIDE_SQL, SUBJECTS_SQL,
)
from ticketlake.catalog.inputs import TABLES, AT, SUBJECT_TIES, governed, hearings, raw_general, table, tickets, view
from ticketlake.catalog.registry import query
from ticketlake.catalog.text import norm
from ticketlake.operators import dedup, filters, quality, rules

# Blanks only: a hard blank does not make a label equal, except where a variant says so.
FORM = "(formulario_ticket IS NULL OR upper(trim(coalesce(formulario_ticket, ''), ' ')) LIKE 'SOLICIT%')"
ACTIVE = "coalesce(flag_arquivado_relatorio, 0) = 0"
REPORT = f"{ACTIVE} AND {FORM}"
DAILY = f"{REPORT} AND upper(trim(coalesce(tipo_manifestacao, ''), ' ')) <> 'ANEXO'"
SERVICE = f"{DAILY} AND upper(trim(coalesce(tipo_solicitacao, ''), ' ')) <> 'INFORMATIVO::ANEXO'"
BI = (
    f"{ACTIVE} AND upper(coalesce(formulario_ticket, '')) LIKE 'SOLICIT%' AND upper(coalesce(tipo_manifestacao, '')) <> 'ANEXO' "
    "AND upper(coalesce(classificacao_notificacoes, '')) <> 'INFORMATIVO::ANEXO'"
)
SANITIZED = (
    f"{ACTIVE} AND upper(trim(replace(coalesce(tipo_manifestacao, ''), chr(160), ' '))) <> 'ANEXO' "
    "AND upper(trim(replace(coalesce(classificacao_notificacoes, ''), chr(160), ' '))) <> 'INFORMATIVO::ANEXO'"
)


@query("split_by_form", f"SELECT ticket_id, formulario_ticket FROM tickets WHERE {norm('formulario_ticket')} IS NULL OR {norm('formulario_ticket')} LIKE 'NOTIFIC%'")
def split_by_form(spark, sf):
    return filters.split_by_form(tickets(spark, sf), "notificacao").select("ticket_id", "formulario_ticket")


@query("partition_overlap", f"SELECT ticket_id FROM tickets WHERE {norm('formulario_ticket')} IS NULL")
def partition_overlap(spark, sf):
    t = tickets(spark, sf)
    return filters.partition_overlap(filters.split_by_form(t, "solicitacao"), filters.split_by_form(t, "notificacao"))


@query(
    "official_filters",
    f"SELECT count_if({REPORT}) AS qtde_report, count_if({DAILY}) AS qtde_daily, count_if({SERVICE}) AS qtde_service, count_if({BI}) AS qtde_bi, count_if({SANITIZED}) AS qtde_sanitized FROM tickets",
)
def official_filters(spark, sf):
    return filters.official_counts(tickets(spark, sf))


@query("orphan_hearings", "SELECT ticket_id, audiencia_id FROM hearings WHERE ticket_id IN (SELECT ticket_id FROM tickets WHERE ticket_id % 2 = 0)")
def orphan_hearings(spark, sf):
    requests = tickets(spark, sf).filter("ticket_id % 2 = 0")
    return filters.orphan_filter(hearings(spark, sf), requests).select("ticket_id", "audiencia_id")


@query("drop_removed", "SELECT ticket_id, titulo FROM tickets WHERE ticket_id NOT IN (SELECT ticket_id FROM governed WHERE regra = 'REMOVIDO')")
def drop_removed(spark, sf):
    return rules.drop_removed(tickets(spark, sf), governed(spark, sf)).select("ticket_id", "titulo")


JOINED = f"WITH {OVERRIDE_SQL}, j AS (SELECT t.*, coalesce(arq, 0) AS arq, coalesce(grp, 0) AS grp, coalesce(anx, 0) AS anx, coalesce(exc, 0) AS exc FROM tickets t LEFT JOIN regras USING (ticket_id))"


@query("archive_flag", f"{JOINED} SELECT ticket_id, {ARCHIVE_SQL} AS flag_arquivado_relatorio FROM j")
def archive_flag(spark, sf):
    return rules.archive_flag(tickets(spark, sf), governed(spark, sf)).select("ticket_id", "flag_arquivado_relatorio")


@query(
    "overrides",
    f"""{JOINED},
    o AS (SELECT j.* REPLACE (CASE WHEN coluna = 'atribuido' THEN valor ELSE atribuido END AS atribuido,
        CASE WHEN grp = 1 THEN '[routing]Oceano Canais de Atrito N2' ELSE grupo_tickets END AS grupo_tickets,
        CASE WHEN coluna = 'tipo_manifestacao' THEN valor WHEN anx = 1 THEN 'ANEXO' ELSE tipo_manifestacao END AS tipo_manifestacao)
      FROM j LEFT JOIN field_overrides USING (ticket_id))
    SELECT ticket_id, atribuido, grupo_tickets, tipo_manifestacao, {ARCHIVE_SQL} AS flag_arquivado_relatorio FROM o""",
)
def overrides(spark, sf):
    listed = governed(spark, sf)
    rows = rules.bulk_overrides(listed, "solicitacao").unionByName(view(spark, sf, "field_overrides"))
    return rules.apply_overrides(tickets(spark, sf), rows, listed).select(
        "ticket_id", "atribuido", "grupo_tickets", "tipo_manifestacao", "flag_arquivado_relatorio"
    )


AUDITED = f"""{JOINED},
    a AS (SELECT *, {GOVERNED_SQL} AS auto, {CHANNEL_CLASS} AS canal FROM j),
    r AS (SELECT * FROM a WHERE auto OR exc = 1)"""
REASON = "CASE WHEN exc = 1 THEN 'EXCECAO_OPERACIONAL_RECLAME_AQUI' ELSE 'POSSIVEL_CLASSIFICACAO_INCORRETA_GRUPO_CANAL' END"
ORIGIN = "CASE WHEN exc = 1 THEN 'EXCECAO_OPERACIONAL' ELSE 'REGRA_AUTOMATICA_GRUPO_CANAL' END"
NOTE = "CASE WHEN exc = 1 THEN 'Ticket encerrado incorretamente como canal de atrito no Zendesk; segregado para auditoria.' ELSE 'Validar grupo do ticket antes de eventual reclassificacao operacional.' END"


def audited(spark, sf):
    df = rules.audit_rules(tickets(spark, sf), governed(spark, sf), AT)
    return df.withColumn("arquivo_origem", F.lit("geral.parquet"))


@query(
    "audit_rules",
    f"""{AUDITED}
    SELECT ticket_id, CASE WHEN auto OR exc = 1 THEN 1 ELSE 0 END AS flag_auditoria_classificacao,
      CASE WHEN auto OR exc = 1 THEN 1 ELSE flag_arquivado_relatorio END AS flag_arquivado_relatorio,
      CASE WHEN exc = 1 THEN 'Reclame Aqui' ELSE tipo_solicitacao END AS tipo_solicitacao,
      CASE WHEN auto OR exc = 1 THEN {REASON} END AS motivo_auditoria_classificacao,
      CASE WHEN auto OR exc = 1 THEN canal END AS canal_normalizado_auditoria,
      CASE WHEN auto OR exc = 1 THEN {NOTE} END AS observacao_auditoria_classificacao
    FROM a""",
)
def audit_rules(spark, sf):
    return audited(spark, sf).select(
        "ticket_id", "flag_auditoria_classificacao", "flag_arquivado_relatorio", "tipo_solicitacao",
        "motivo_auditoria_classificacao", "canal_normalizado_auditoria", "observacao_auditoria_classificacao",
    )


@query(
    "audit_class",
    f"""{AUDITED}
    SELECT ticket_id, {ORIGIN} AS origem_regra, 'PENDENTE_VALIDACAO' AS status_auditoria, {REASON} AS motivo_auditoria, tipo_solicitacao AS tipo_solicitacao_original,
      CASE WHEN exc = 1 THEN 'Reclame Aqui' ELSE tipo_solicitacao END AS tipo_solicitacao_atual, grupo_tickets,
      CASE WHEN exc = 0 THEN '[routing]Oceano Canais de Atrito N2' END AS grupo_sugerido, canal AS canal_normalizado, data_criacao, data_resolucao, atribuido, titulo,
      {NOTE} AS observacao, 'geral.parquet' AS arquivo_origem FROM r""",
    stamps=("data_criacao", "data_resolucao"),
)
def audit_class(spark, sf):
    return rules.classification_audit(audited(spark, sf), ("data_criacao",))


@query(
    "audit_oper",
    f"""{AUDITED}
    SELECT sha256(CAST(ticket_id AS VARCHAR) || '|' || {ORIGIN} || '|' || {REASON}) AS auditoria_operacional_key, ticket_id, {ORIGIN} AS origem_regra, {REASON} AS tipo_inconsistencia,
      {NOTE} AS descricao_inconsistencia, 'PENDENTE_VALIDACAO' AS status_validacao, TIMESTAMP '{AT}' AS data_identificacao, CAST(NULL AS TIMESTAMP) AS data_validacao,
      CAST(NULL AS VARCHAR) AS validado_por, CAST(NULL AS VARCHAR) AS acao_tomada, titulo AS observacao FROM r""",
    stamps=("data_identificacao", "data_validacao"),
)
def audit_oper(spark, sf):
    return rules.operational_audit(audited(spark, sf), AT, ("data_criacao",))


STORED_AUDITS = "SELECT ticket_id, CASE ticket_id % 3 WHEN 0 THEN ' pendente_validacao' WHEN 1 THEN 'PENDENTE_VALIDACAO' ELSE 'VALIDADO' END AS status_auditoria FROM tickets WHERE flag_auditoria_classificacao IS NOT NULL"


@query(
    "purge_stale",
    f"SELECT ticket_id, status_auditoria FROM ({STORED_AUDITS}) WHERE upper(trim(status_auditoria)) <> 'PENDENTE_VALIDACAO' OR ticket_id IN (SELECT ticket_id FROM tickets WHERE coalesce(flag_auditoria_classificacao, 0) = 1)",
)
def purge_stale(spark, sf):
    t = tickets(spark, sf)
    label = F.when(F.col("ticket_id") % 3 == 0, " pendente_validacao").when(
        F.col("ticket_id") % 3 == 1, "PENDENTE_VALIDACAO"
    ).otherwise("VALIDADO")
    audits = t.filter("flag_auditoria_classificacao IS NOT NULL").select("ticket_id", label.alias("status_auditoria"))
    return rules.purge_stale(audits, t, "status_auditoria")


GONE = "SELECT ticket_id FROM governed WHERE regra = 'REMOVIDO'"


@query(
    "purge_removed",
    f"""
    SELECT 'tickets' AS tabela, count(*) AS linhas FROM tickets WHERE ticket_id NOT IN ({GONE})
    UNION ALL SELECT 'audiencias', count(*) FROM hearings WHERE ticket_id NOT IN ({GONE}) AND ticket_audiencia_id NOT IN ({GONE}) AND (ticket_relacionado_id IS NULL OR ticket_relacionado_id NOT IN ({GONE}))
    UNION ALL SELECT 'ticket_relacionamentos', count(*) FROM tickets WHERE ticket_solicitacao_id NOT IN ({GONE}) AND (ticket_notificacao_id IS NULL OR ticket_notificacao_id NOT IN ({GONE}))
    """,
)
def purge_removed(spark, sf):
    t = tickets(spark, sf)
    stored = {
        "tickets": t.select("ticket_id"),
        "audiencias": hearings(spark, sf).select("ticket_id", "ticket_relacionado_id", "ticket_audiencia_id"),
        "ticket_relacionamentos": t.select("ticket_solicitacao_id", "ticket_notificacao_id"),
    }
    kept = rules.purge_removed(stored, governed(spark, sf))
    counts = [df.agg(F.count(F.lit(1)).alias("linhas")).select(F.lit(n).alias("tabela"), "linhas") for n, df in kept.items()]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query(
    "backfill_territory",
    """
    SELECT ticket_id, CASE WHEN bloco IN ('Bloco 1', 'Bloco 4') THEN bloco WHEN coalesce(trim(matricula), '') LIKE '40%' THEN 'Bloco 4'
      WHEN coalesce(trim(matricula), '') LIKE '10%' THEN 'Bloco 1' END AS bloco FROM tickets
    """,
)
def backfill_territory(spark, sf):
    return rules.backfill_territory(tickets(spark, sf)).select("ticket_id", "bloco")


EMPTY_GROUP = "Nao ha dados preenchidos para um grupo critico do contrato."


@query(
    "contract_issues",
    f"""
    SELECT * EXCLUDE (n) FROM (
      SELECT 'zendesk_geral' AS fonte, 'ERROR' AS severidade, 'MISSING_CRITICAL_DATA' AS codigo, '{EMPTY_GROUP}' AS mensagem, 'status_do_ticket' AS colunas, (SELECT count(nullif(trim(criterio_vinculo_os), '')) FROM tickets) AS n
      UNION ALL SELECT 'audiencias', 'ERROR', 'MISSING_CRITICAL_DATA', '{EMPTY_GROUP}', 'data_da_audiencia_carimbo_de_data_hora, data_de_reagendamento_carimbo_de_data_hora', (SELECT count(motivo_espera) FROM tickets)
      UNION ALL SELECT 'zendesk_geral', 'ERROR', 'MISSING_REQUIRED_COLUMNS', 'Colunas obrigatorias ausentes na fonte.', 'criacao_do_ticket_carimbo_de_data_hora', 0
      UNION ALL SELECT 'gss', 'ERROR', 'MISSING_CRITICAL_DATA', '{EMPTY_GROUP}', 'servico_executado', (SELECT count(motivo_espera) FROM tickets)
    ) WHERE n = 0
    """,
)
def contract_issues(spark, sf):
    """Contracts over whole feeds, some of which lack a column or hold only blanks in one."""
    raw = raw_general(spark, sf)
    general = raw.drop("Criação do ticket - Carimbo de data/hora").withColumn(
        "Status do ticket", F.when(F.col("`Status do ticket`").isNotNull(), F.lit(" nan "))
    )
    empty_date = F.lit(None).cast("string")
    hearing = raw.select("`ID do ticket`", empty_date.alias("Data da audiência - Carimbo de data/hora"))
    orders = view(spark, sf, "work_orders").select(
        "matricula", F.col("numero_os").alias("No. da O.S."), F.col("data_emissao").alias("Dt. Emissao"),
        empty_date.alias("Serviço Executado"),
    )
    return (
        quality.contract_issues(general, "zendesk_geral")
        .unionByName(quality.contract_issues(hearing, "audiencias"))
        .unionByName(quality.contract_issues(orders, "gss"))
        .unionByName(quality.contract_issues(raw, "zendesk_geral"))
    )


@query(
    "table_profile",
    """
    SELECT 'region' AS tabela, (SELECT count(*) FROM region) AS linhas, coluna, tipo, CAST(posicao AS INTEGER) AS posicao FROM (VALUES ('r_regionkey','int',1), ('r_name','string',2)) v(coluna, tipo, posicao)
    UNION ALL
    SELECT 'nation' AS tabela, (SELECT count(*) FROM nation) AS linhas, coluna, tipo, CAST(posicao AS INTEGER) AS posicao FROM (VALUES ('n_nationkey','int',1), ('n_name','string',2), ('n_regionkey','int',3)) v(coluna, tipo, posicao)
    UNION ALL
    SELECT 'customer' AS tabela, (SELECT count(*) FROM customer) AS linhas, coluna, tipo, CAST(posicao AS INTEGER) AS posicao FROM (VALUES ('c_custkey','bigint',1), ('c_name','string',2), ('c_nationkey','int',3), ('c_acctbal','double',4), ('c_mktsegment','string',5)) v(coluna, tipo, posicao)
    UNION ALL
    SELECT 'supplier' AS tabela, (SELECT count(*) FROM supplier) AS linhas, coluna, tipo, CAST(posicao AS INTEGER) AS posicao FROM (VALUES ('s_suppkey','bigint',1), ('s_name','string',2), ('s_nationkey','int',3), ('s_acctbal','double',4)) v(coluna, tipo, posicao)
    UNION ALL
    SELECT 'part' AS tabela, (SELECT count(*) FROM part) AS linhas, coluna, tipo, CAST(posicao AS INTEGER) AS posicao FROM (VALUES ('p_partkey','bigint',1), ('p_name','string',2), ('p_brand','string',3), ('p_type','string',4), ('p_size','int',5), ('p_retailprice','double',6)) v(coluna, tipo, posicao)
    UNION ALL
    SELECT 'orders' AS tabela, (SELECT count(*) FROM orders) AS linhas, coluna, tipo, CAST(posicao AS INTEGER) AS posicao FROM (VALUES ('o_orderkey','bigint',1), ('o_custkey','bigint',2), ('o_orderstatus','string',3), ('o_totalprice','double',4), ('o_orderdate','timestamp_ntz',5), ('o_orderpriority','string',6)) v(coluna, tipo, posicao)
    UNION ALL
    SELECT 'lineitem' AS tabela, (SELECT count(*) FROM lineitem) AS linhas, coluna, tipo, CAST(posicao AS INTEGER) AS posicao FROM (VALUES ('l_orderkey','bigint',1), ('l_partkey','bigint',2), ('l_suppkey','bigint',3), ('l_linenumber','int',4), ('l_quantity','double',5), ('l_extendedprice','double',6), ('l_discount','double',7), ('l_tax','double',8), ('l_returnflag','string',9), ('l_linestatus','string',10), ('l_shipdate','timestamp_ntz',11)) v(coluna, tipo, posicao)
    UNION ALL
    SELECT 'events' AS tabela, (SELECT count(*) FROM events) AS linhas, coluna, tipo, CAST(posicao AS INTEGER) AS posicao FROM (VALUES ('event_id','bigint',1), ('ts','timestamp_ntz',2), ('user_id','bigint',3), ('event_type','string',4), ('value','double',5), ('props','string',6)) v(coluna, tipo, posicao)
    UNION ALL
    SELECT 'documents' AS tabela, (SELECT count(*) FROM documents) AS linhas, coluna, tipo, CAST(posicao AS INTEGER) AS posicao FROM (VALUES ('doc_id','bigint',1), ('text','string',2), ('lang','string',3), ('source','string',4), ('n_chars','bigint',5)) v(coluna, tipo, posicao)
    UNION ALL
    SELECT 'embeddings' AS tabela, (SELECT count(*) FROM embeddings) AS linhas, coluna, tipo, CAST(posicao AS INTEGER) AS posicao FROM (VALUES ('vec_id','bigint',1), ('embedding','array<float>',2), ('label','int',3)) v(coluna, tipo, posicao)
    UNION ALL
    SELECT 'pages' AS tabela, (SELECT count(*) FROM pages) AS linhas, coluna, tipo, CAST(posicao AS INTEGER) AS posicao FROM (VALUES ('page_id','bigint',1), ('url','string',2), ('html','string',3)) v(coluna, tipo, posicao)
    UNION ALL
    SELECT 'benchmark' AS tabela, (SELECT count(*) FROM benchmark) AS linhas, coluna, tipo, CAST(posicao AS INTEGER) AS posicao FROM (VALUES ('item_id','bigint',1), ('text','string',2)) v(coluna, tipo, posicao)
    UNION ALL
    SELECT 'labels' AS tabela, (SELECT count(*) FROM labels) AS linhas, coluna, tipo, CAST(posicao AS INTEGER) AS posicao FROM (VALUES ('doc_id','bigint',1), ('quality','int',2), ('toxic','int',3)) v(coluna, tipo, posicao)
    UNION ALL
    SELECT 'conversations' AS tabela, (SELECT count(*) FROM conversations) AS linhas, coluna, tipo, CAST(posicao AS INTEGER) AS posicao FROM (VALUES ('conv_id','bigint',1), ('turn','bigint',2), ('role','string',3), ('text','string',4)) v(coluna, tipo, posicao)
    """,
)
def table_profile(spark, sf):
    return quality.table_profile({n: table(spark, sf, n) for n in TABLES})


@query(
    "reconcile",
    f"""
    WITH {SUBJECTS_SQL}, b AS (SELECT DISTINCT ticket_id FROM subject_feed), g AS (SELECT ticket_id FROM tickets WHERE ticket_id NOT IN ({GONE})), m AS (SELECT ticket_id, count(*) AS q FROM o GROUP BY ticket_id)
    SELECT (SELECT count(*) FROM b) AS qtde_tickets_bronze, (SELECT count(*) FROM g) AS qtde_tickets_gold, (SELECT count(*) FROM b WHERE ticket_id NOT IN (SELECT ticket_id FROM g)) AS somente_bronze,
      (SELECT count(*) FROM g WHERE ticket_id NOT IN (SELECT ticket_id FROM b)) AS somente_gold, (SELECT CAST(sum(q) AS BIGINT) FROM m) AS qtde_assuntos, (SELECT count(*) FROM m WHERE q > 1) AS qtde_multiplos_assuntos
    """,
)
def reconcile(spark, sf):
    feed = view(spark, sf, "subject_feed")
    gold = rules.drop_removed(tickets(spark, sf).select("ticket_id"), governed(spark, sf))
    return quality.reconcile(feed, gold, dedup.subject_keys(feed))


@query(
    "quality_indicators",
    """
    SELECT count(*) AS qtde_tickets, round(100.0 * count_if(bloco IN ('Bloco 1', 'Bloco 4')) / count(*), 2) AS pct_matricula_valida, round(100.0 * count(gss_os_id) / count(*), 2) AS pct_enriquecido_gss,
      round(100.0 * count_if(coalesce(flag_auditoria_classificacao, 0) = 0) / count(*), 2) AS pct_classificacao_consistente, round(100.0 * count_if(flag_arquivado_relatorio = 1) / count(*), 2) AS taxa_arquivamento FROM tickets
    """,
)
def quality_indicators(spark, sf):
    return quality.quality_indicators(tickets(spark, sf))
