"""Intake, canonicalisation, deduplication and subject queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ticketlake.catalog.inputs import AT, SUBJECT_TIES, governed, raw_general, table, tickets, view
from ticketlake.catalog.registry import query
from ticketlake.catalog.text import PROTOCOL_SQL, norm, subject
from ticketlake.functions.text import first_nonblank
from ticketlake.operators import dedup
from ticketlake.plans import transform
from ticketlake.schemas import TICKET_ALIASES, TICKET_FEED
from ticketlake.session import settle, ensure_checkpoint_dir
from ticketlake.sources import canonical, files, intake
from ticketlake.sources.tables import deliver

BLANK = "CASE WHEN trim({c}) IN ('', '<NA>', 'nan', 'None') THEN NULL ELSE trim({c}) END"


def ident(c: str) -> str:
    return f"regexp_replace({norm(c)}, '\\.0+$', '')"


@query(
    "bronze_union",
    """
    SELECT fonte, count(*) AS linhas, count(chave) AS chaves, count(valor) AS valores, count(data) AS datas FROM (
      SELECT 'orders.parquet' AS fonte, o_orderkey AS chave, o_totalprice AS valor, CAST(NULL AS TIMESTAMP) AS data FROM orders
      UNION ALL SELECT 'lineitem.parquet', l_orderkey, CAST(NULL AS DOUBLE), l_shipdate FROM lineitem) GROUP BY fonte
    """,
)
def bronze_union(spark, sf):
    """Two files of different layout as one source, with lineage; absent columns are null."""
    both = files.read_source(spark, [[f"{sf}/orders.parquet"], [f"{sf}/lineitem.parquet"]], "carga")
    return both.groupBy(F.col("arquivo_origem").alias("fonte")).agg(
        F.count(F.lit(1)).alias("linhas"), F.count(F.coalesce("o_orderkey", "l_orderkey")).alias("chaves"),
        F.count("o_totalprice").alias("valores"), F.count("l_shipdate").alias("datas"),
    )


@query(
    "bronze_intake",
    """
    SELECT o_orderkey AS chave, CASE WHEN o_orderkey % 4 = 3 THEN 2 ELSE o_orderkey % 4 END AS versao, o_totalprice AS valor,
      CASE WHEN o_orderkey % 4 IN (1, 2, 3) THEN o_orderstatus END AS situacao FROM orders
    """,
)
def bronze_intake(spark, sf):
    """Three deliveries, each taken in as it comes: every one repeats a quarter of the keys, the later two bring a column."""
    root = f"{ensure_checkpoint_dir(spark)}/intake-{uuid.uuid4().hex}"
    orders, stored = table(spark, sf, "orders"), None
    for version in range(3):
        chosen = orders.filter(F.col("o_orderkey") % 4 == version).unionByName(orders.filter("o_orderkey % 4 = 3"))
        columns = [F.col("o_orderkey").alias("chave"), F.lit(version).alias("versao"), F.col("o_totalprice").alias("valor")]
        columns += [F.col("o_orderstatus").alias("situacao")] if version else []
        deliver(chosen.select(*columns), f"{root}/feed", f"Base_GSS_{version}")
        last = intake.land(spark, f"{root}/feed", "gss", f"{root}/bronze")
        arrived = intake.landed(spark, f"{root}/bronze", after=last - 1)
        stored = settle(intake.merge_latest(stored, arrived, "chave"))
    return stored.select("chave", F.col("versao").cast("bigint").alias("versao"), "valor", "situacao")


# The general feed as it is after canonicalisation, in the check database.
FEED_SQL = """
    feed AS (SELECT * REPLACE (
        CASE WHEN ticket_id % 61 = 0 THEN NULL ELSE data_criacao END AS data_criacao,
        ' ' || matricula || CASE WHEN ticket_id % 5 = 0 THEN '.0' ELSE '' END AS matricula),
      CASE WHEN ticket_id % 9 = 0 THEN CAST(ticket_id + 1 AS VARCHAR) END AS chave_explicita_vinculo,
      data_criacao AS arquivo_mtime
      FROM tickets WHERE ticket_id % 101 <> 0)
"""


@query(
    "headers",
    "SELECT count(*) AS linhas, count(DISTINCT ticket_id) AS id_do_ticket, count(titulo) AS assunto_do_ticket, "
    "count(data_resolucao) AS resolucao_do_ticket_carimbo_de_data_hora, count(matricula) AS matricula FROM tickets",
)
def headers(spark, sf):
    named = canonical.normalize_headers(raw_general(spark, sf))
    return named.agg(
        F.count(F.lit(1)).alias("linhas"), F.count_distinct(F.regexp_replace("id_do_ticket", r"\.0$", "")).alias("_ids"),
        F.count_if(F.col("id_do_ticket") == "sem numero").alias("_sem"),
        F.count("assunto_do_ticket").alias("assunto_do_ticket"),
        F.count("resolucao_do_ticket_carimbo_de_data_hora").alias("resolucao_do_ticket_carimbo_de_data_hora"),
        F.count("matricula").alias("matricula"),
    ).select(
        "linhas", (F.col("_ids") + F.greatest(F.col("_sem") - 1, F.lit(0))).alias("id_do_ticket"), "assunto_do_ticket",
        "resolucao_do_ticket_carimbo_de_data_hora", "matricula",
    )


CANONICAL = (
    "ticket_id", "data_criacao", "data_resolucao", "atribuido", "titulo", "assunto", "tipo_solicitacao", "status",
    "matricula", "tipo_manifestacao", "numero_os", "grupo_tickets", "cpf_cliente", "bairro", "municipio", "logradouro",
    "formulario_ticket", "tipo_conversa", "local_procon",
)


@query(
    "canonicalize",
    f"WITH {FEED_SQL} SELECT {', '.join(c for c in CANONICAL[:-2])}, CAST(NULL AS VARCHAR) AS tipo_conversa, CAST(NULL AS VARCHAR) AS local_procon "
    "FROM feed UNION ALL SELECT NULL, CASE WHEN ticket_id % 61 = 0 THEN NULL ELSE data_criacao END, "
    + ", ".join(
        "' ' || matricula || CASE WHEN ticket_id % 5 = 0 THEN '.0' ELSE '' END" if c == "matricula" else c
        for c in CANONICAL[2:-2]
    )
    + ", NULL, NULL FROM tickets WHERE ticket_id % 101 = 0",
    stamps=("data_criacao", "data_resolucao"),
)
def canonicalize(spark, sf):
    return canonical.canonicalize(raw_general(spark, sf), TICKET_ALIASES, TICKET_FEED).select(*CANONICAL)


@query("coerce_ids", "SELECT ticket_id, titulo FROM tickets WHERE ticket_id % 101 <> 0")
def coerce_ids(spark, sf):
    raw = raw_general(spark, sf).select(
        F.col("`ID do ticket`").alias("ticket_id"), F.col("`Assunto do ticket`").alias("titulo")
    )
    return canonical.coerce_ids(raw, "ticket_id")


@query(
    "protocol_ref",
    "SELECT ticket_id, coalesce(nullif(trim(protocolo_referencia_informado), ''), nullif(trim(protocolo_procon), ''), "
    "nullif(trim(protocolo_defensoria), ''), nullif(trim(protocolo_codecon), ''), nullif(trim(case_jec), '')) AS protocolo_referencia FROM tickets",
)
def protocol_ref(spark, sf):
    names = ("protocolo_referencia_informado", "protocolo_procon", "protocolo_defensoria", "protocolo_codecon", "case_jec")
    return tickets(spark, sf).select(
        "ticket_id", first_nonblank(*[F.col(c) for c in names]).alias("protocolo_referencia")
    )


@query(
    "channel_coalesce",
    "SELECT ticket_id, coalesce(tipo_solicitacao, classificacao_solicitacoes, canais_de_atrito) AS tipo_solicitacao FROM tickets",
)
def channel_coalesce(spark, sf):
    return canonical.channel_coalesce(tickets(spark, sf)).select("ticket_id", "tipo_solicitacao")


@query(
    "explicit_key",
    "SELECT ticket_id, CASE WHEN ticket_id % 9 = 0 THEN CAST(ticket_id + 1 AS VARCHAR) END AS chave FROM tickets WHERE ticket_id % 101 <> 0",
)
def explicit_key(spark, sf):
    raw = raw_general(spark, sf)
    return raw.select(
        canonical.to_long(F.col("`ID do ticket`")).alias("ticket_id"), canonical.explicit_link_key(raw).alias("chave")
    ).filter(F.col("ticket_id").isNotNull())


SILVER = ("ticket_id", "data_criacao", "matricula", "so_solicitacao", "so_notificacao")


@query(
    "silver_union",
    """
    SELECT ticket_id, data_criacao, matricula, qtde_assuntos_ticket AS so_solicitacao, CAST(NULL AS VARCHAR) AS so_notificacao FROM tickets WHERE ticket_id % 2 = 0
    UNION ALL SELECT ticket_id, data_criacao, matricula, NULL, bairro FROM tickets WHERE ticket_id % 2 = 1
    """,
    stamps=("data_criacao",),
)
def silver_union(spark, sf):
    t = tickets(spark, sf)
    both = [F.col("ticket_id"), F.col("data_criacao"), F.col("matricula")]
    requests = t.filter("ticket_id % 2 = 0").select(*both, F.col("qtde_assuntos_ticket").alias("so_solicitacao"))
    notices = t.filter("ticket_id % 2 = 1").select(*both, F.col("bairro").alias("so_notificacao"))
    return transform.silver_general(requests, notices)


# ---- transforms -------------------------------------------------------------------------------------
OVERRIDE_SQL = """
    removidos AS (SELECT ticket_id FROM governed WHERE regra = 'REMOVIDO'),
    regras AS (SELECT ticket_id, max(CASE WHEN regra = 'ARQUIVO_MANUAL' THEN 1 ELSE 0 END) AS arq, max(CASE WHEN regra = 'GRUPO_MANUAL' THEN 1 ELSE 0 END) AS grp,
      max(CASE WHEN regra = 'ANEXO_MANUAL' THEN 1 ELSE 0 END) AS anx, max(CASE WHEN regra = 'EXCECAO_AUDITORIA' THEN 1 ELSE 0 END) AS exc FROM governed GROUP BY ticket_id)
"""
ARCHIVE_SQL = (
    "CASE WHEN {n_manif} = 'ANEXO' OR (coalesce({n_notif}, '') LIKE '%INFORMATIVO%' AND coalesce({n_notif}, '') LIKE '%ANEXO%') "
    "OR {n_grupo} = '[INTERNAL]TICKET PRIVADO OCEANO CANAIS DE ATRITO' OR arq = 1 THEN 1 ELSE 0 END"
).format(n_manif=norm("tipo_manifestacao"), n_notif=norm("classificacao_notificacoes"), n_grupo=norm("grupo_tickets"))
CLASS = "nullif(trim(regexp_replace(trim(string_split({n}, '::')[-1]), '^\\[[^\\]]+\\]\\s*', '')), '')"
CHANNEL_CLASS = CLASS.format(n=norm("tipo_solicitacao"))
GROUP_CLASS = CLASS.format(n=norm("grupo_tickets"))
GOVERNED_SQL = (
    f"(coalesce(regexp_matches({CHANNEL_CLASS}, '^(AGENCIA REGULADORA|CEDOC|CEJUSC|CODECON|DEFENSORIA|JEC|PROCON)( |$)'), FALSE) "
    f"AND NOT coalesce({GROUP_CLASS} IN ('OCEANO CANAIS DE ATRITO N2', 'CANAIS DE ATRITO N2'), FALSE) AND exc = 0 AND coalesce(flag_arquivado_relatorio, 0) = 0)"
)


def transform_sql(kind: str) -> str:
    prefix = "SOLICIT" if kind == "solicitacao" else "NOTIFIC"
    manif, notif = "tipo_manifestacao", "classificacao_notificacoes"
    if kind == "solicitacao":
        manif = "CASE WHEN anx = 1 THEN 'ANEXO' ELSE tipo_manifestacao END"
    else:
        notif = "CASE WHEN anx = 1 THEN 'Informativo::Anexo' ELSE classificacao_notificacoes END"
    return f"""
    WITH {FEED_SQL}, {OVERRIDE_SQL},
    a AS (SELECT f.* REPLACE (
        trim(formulario_ticket) AS formulario_ticket, {ident('matricula')} AS matricula, {ident('numero_os')} AS numero_os,
        {ident('cpf_cliente')} AS cpf_cliente, {BLANK.format(c='protocolo_referencia_informado')} AS protocolo_referencia_informado,
        coalesce(tipo_solicitacao, classificacao_solicitacoes, canais_de_atrito) AS tipo_solicitacao,
        CASE WHEN coluna = 'atribuido' THEN valor ELSE atribuido END AS atribuido,
        CASE WHEN grp = 1 THEN '[routing]Oceano Canais de Atrito N2' ELSE grupo_tickets END AS grupo_tickets,
        CASE WHEN coluna = 'tipo_manifestacao' THEN valor ELSE {manif} END AS tipo_manifestacao,
        {notif} AS classificacao_notificacoes),
        coalesce(arq, 0) AS arq, coalesce(exc, 0) AS exc
      FROM feed f LEFT JOIN regras USING (ticket_id) LEFT JOIN field_overrides USING (ticket_id)
      WHERE ticket_id NOT IN (SELECT ticket_id FROM removidos)
        AND ({norm('formulario_ticket')} IS NULL OR {norm('formulario_ticket')} LIKE '{prefix}%')),
    b AS (SELECT * REPLACE ({ARCHIVE_SQL} AS flag_arquivado_relatorio,
        CASE WHEN matricula LIKE '40%' THEN 'Bloco 4' WHEN matricula LIKE '10%' THEN 'Bloco 1' END AS bloco) FROM a),
    p AS (SELECT ticket_id, {PROTOCOL_SQL} FROM b),
    c AS (SELECT b.* EXCLUDE (protocolo_procon, protocolo_defensoria, protocolo_codecon, case_id, case_jec), p.* EXCLUDE (ticket_id),
        CASE WHEN (upper(coalesce(tipo_solicitacao, '')) LIKE '%JEC%' OR upper(coalesce(tipo_manifestacao, '')) LIKE '%JEC%')
          AND (coalesce(cpf_cliente, '') <> '' OR coalesce(matricula, '') <> '')
          THEN sha256(coalesce(cpf_cliente, '') || '|' || coalesce(matricula, '') || '|' || coalesce(lower(trim(assunto)), '')) END AS case_jec,
        {subject('coalesce(assunto, titulo)')} AS assunto_normalizado, {GOVERNED_SQL} AS auto FROM b JOIN p USING (ticket_id))
    """


TRANSFORM_OUT = (
    "ticket_id", "data_criacao", "data_resolucao", "matricula", "bloco", "numero_os", "cpf_cliente", "atribuido",
    "grupo_tickets", "tipo_manifestacao", "classificacao_notificacoes", "case_id", "case_jec", "protocolo_agenersa",
    "protocolo_referencia", "assunto_normalizado", "chave_explicita_vinculo", "formulario_ticket",
    "tipo_ticket_zendesk", "flag_arquivado_relatorio", "tipo_solicitacao",
)
_REFERENCE = (
    "coalesce(nullif(trim(protocolo_referencia_informado), ''), nullif(trim(protocolo_agenersa), ''), "
    "nullif(trim(protocolo_procon), ''), nullif(trim(protocolo_defensoria), ''), nullif(trim(protocolo_codecon), ''), "
    "nullif(trim(case_jec), ''))"
)
_SHARED = ", ".join(c for c in TRANSFORM_OUT[:11])
_TAIL = f"coalesce(protocolo_agenersa, CAST(ticket_id AS VARCHAR)) AS case_id, case_jec, protocolo_agenersa, {_REFERENCE} AS protocolo_referencia, assunto_normalizado, chave_explicita_vinculo, formulario_ticket"
AUDIT_OUT = (
    "flag_auditoria_classificacao", "motivo_auditoria_classificacao", "grupo_sugerido_auditoria",
    "tipo_solicitacao_original_auditoria", "canal_normalizado_auditoria", "data_auditoria_classificacao",
)


@query(
    "transform_tickets",
    transform_sql("solicitacao")
    + f"""
    SELECT {_SHARED}, {_TAIL}, 'SOLICITACAO' AS tipo_ticket_zendesk,
      CASE WHEN auto OR exc = 1 THEN 1 ELSE flag_arquivado_relatorio END AS flag_arquivado_relatorio,
      CASE WHEN exc = 1 THEN 'Reclame Aqui' ELSE tipo_solicitacao END AS tipo_solicitacao,
      CASE WHEN auto OR exc = 1 THEN 1 ELSE 0 END AS flag_auditoria_classificacao,
      CASE WHEN exc = 1 THEN 'EXCECAO_OPERACIONAL_RECLAME_AQUI' WHEN auto THEN 'POSSIVEL_CLASSIFICACAO_INCORRETA_GRUPO_CANAL' END AS motivo_auditoria_classificacao,
      CASE WHEN exc = 0 AND auto THEN '[routing]Oceano Canais de Atrito N2' END AS grupo_sugerido_auditoria,
      CASE WHEN auto OR exc = 1 THEN tipo_solicitacao END AS tipo_solicitacao_original_auditoria,
      CASE WHEN auto OR exc = 1 THEN {CHANNEL_CLASS} END AS canal_normalizado_auditoria,
      CASE WHEN auto OR exc = 1 THEN TIMESTAMP '{AT}' END AS data_auditoria_classificacao
    FROM c
    """,
    stamps=("data_criacao", "data_resolucao", "data_auditoria_classificacao"),
)
def transform_tickets(spark, sf):
    df = transform.transform_tickets(
        raw_general(spark, sf), "solicitacao", governed(spark, sf), view(spark, sf, "field_overrides"), AT
    )
    return df.select(*TRANSFORM_OUT, *AUDIT_OUT)


@query(
    "transform_notices",
    transform_sql("notificacao")
    + f"SELECT {_SHARED}, {_TAIL}, 'NOTIFICACAO' AS tipo_ticket_zendesk, flag_arquivado_relatorio, tipo_solicitacao FROM c",
    stamps=("data_criacao", "data_resolucao"),
)
def transform_notices(spark, sf):
    df = transform.transform_tickets(
        raw_general(spark, sf), "notificacao", governed(spark, sf), view(spark, sf, "field_overrides"), AT
    )
    return df.select(*TRANSFORM_OUT)


@query(
    "transform_n1",
    f"""
    WITH {FEED_SQL}, {OVERRIDE_SQL}
    SELECT ticket_id, {ident('matricula')} AS matricula, CASE WHEN {ident('matricula')} LIKE '40%' THEN 'Bloco 4' WHEN {ident('matricula')} LIKE '10%' THEN 'Bloco 1' END AS bloco,
      data_criacao, data_resolucao, status, titulo, assunto, CAST(NULL AS VARCHAR) AS canal_ticket
    FROM feed WHERE ticket_id NOT IN (SELECT ticket_id FROM removidos)
    """,
    stamps=("data_criacao", "data_resolucao"),
)
def transform_n1(spark, sf):
    return transform.transform_n1(raw_general(spark, sf), governed(spark, sf)).select(
        "ticket_id", "matricula", "bloco", "data_criacao", "data_resolucao", "status", "titulo", "assunto", "canal_ticket"
    )


@query(
    "transform_hearings",
    f"""
    WITH {OVERRIDE_SQL},
    h AS (SELECT *, coalesce(ticket_relacionado_id, ticket_audiencia_id) AS t FROM hearings)
    SELECT t AS ticket_id, ticket_audiencia_id, ticket_relacionado_id, data_audiencia, data_reagendamento, 'TRUE' AS audiencia, preposto, CAST(NULL AS VARCHAR) AS local_procon
    FROM h WHERE t NOT IN (SELECT ticket_id FROM removidos)
    """,
    stamps=("data_audiencia", "data_reagendamento"),
)
def transform_hearings(spark, sf):
    h = view(spark, sf, "hearings")
    raw = h.select(
        F.col("ticket_audiencia_id").cast("string").alias("ID do ticket"),
        F.col("ticket_relacionado_id").cast("string").alias("Ticket relacionado ID"),
        F.date_format("data_audiencia", "yyyy-MM-dd HH:mm:ss").alias("Data da audiência - Carimbo de data/hora"),
        F.date_format("data_reagendamento", "yyyy-MM-dd HH:mm:ss").alias("Data de reagendamento - Carimbo de data/hora"),
        F.col("preposto").alias("Preposto (name)"),
    )
    return transform.transform_hearings(raw, governed(spark, sf)).select(
        "ticket_id", "ticket_audiencia_id", "ticket_relacionado_id", "data_audiencia", "data_reagendamento", "audiencia",
        "preposto", "local_procon",
    )


# ---- deduplication and subjects -----------------------------------------------------------------------
TIES = ", ".join(f"{c} DESC" for c in SUBJECT_TIES)
LINE_ORDER = ("l_shipdate", "l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_partkey", "l_suppkey")


def _line_sql(direction: str) -> str:
    order = ", ".join(f"{c} {direction}" for c in LINE_ORDER)
    return (
        "SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_extendedprice FROM (SELECT *, row_number() OVER "
        f"(PARTITION BY l_orderkey, l_linenumber ORDER BY {order}) AS rn FROM lineitem) WHERE rn = 1"
    )


@query("dedup_latest", _line_sql("DESC"), stamps=("l_shipdate",))
def dedup_latest(spark, sf):
    lines = dedup.dedup_latest(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], LINE_ORDER)
    return lines.select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_extendedprice")


@query("dedup_first", _line_sql("ASC"), stamps=("l_shipdate",))
def dedup_first(spark, sf):
    lines = dedup.dedup_first(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], LINE_ORDER)
    return lines.select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_extendedprice")


SUBJECTS_SQL = f"""
    s AS (SELECT *, coalesce(nullif(trim(assunto), ''), nullif(trim(titulo), '')) AS assunto_raw FROM subject_feed),
    n AS (SELECT * FROM (SELECT *, {subject('assunto_raw')} AS assunto_normalizado FROM s) WHERE assunto_normalizado IS NOT NULL),
    d AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ticket_id, assunto_normalizado ORDER BY arquivo_mtime DESC NULLS FIRST, {TIES}) AS rn FROM n) WHERE rn = 1),
    l AS (SELECT *, first_value(assunto_normalizado) OVER (PARTITION BY ticket_id ORDER BY arquivo_mtime DESC NULLS FIRST, {TIES}) AS principal FROM d),
    o AS (SELECT *, CAST(row_number() OVER (PARTITION BY ticket_id ORDER BY CASE WHEN assunto_normalizado = principal THEN 0 ELSE 1 END, arquivo_mtime DESC NULLS LAST, assunto_normalizado) AS INTEGER) AS ordem_assunto FROM l)
"""


@query(
    "ticket_subjects",
    f"WITH {SUBJECTS_SQL} SELECT sha256(CAST(ticket_id AS VARCHAR) || '|' || assunto_normalizado) AS ticket_assunto_id, ticket_id, formulario_ticket, "
    "assunto_raw, assunto_normalizado, ordem_assunto, CASE WHEN ordem_assunto = 1 THEN 1 ELSE 0 END AS flag_assunto_principal, arquivo_origem FROM o",
)
def ticket_subjects(spark, sf):
    return dedup.ticket_subjects(view(spark, sf, "subject_feed"), SUBJECT_TIES)


@query(
    "subject_metrics",
    f"WITH {SUBJECTS_SQL}, m AS (SELECT ticket_id, count(*) AS q FROM o GROUP BY ticket_id) SELECT t.ticket_id, CAST(coalesce(q, 1) AS INTEGER) AS qtde_assuntos_ticket, "
    "CASE WHEN coalesce(q, 1) > 1 THEN 1 ELSE 0 END AS flag_multiplos_assuntos FROM tickets t LEFT JOIN m ON m.ticket_id = t.ticket_id",
)
def subject_metrics(spark, sf):
    subjects = dedup.ticket_subjects(view(spark, sf, "subject_feed"), SUBJECT_TIES)
    return dedup.attach_subject_metrics(tickets(spark, sf).select("ticket_id"), subjects)


PIVOT_WIDTH = 20


@query(
    "pivot_subjects",
    """
    WITH r AS (SELECT ticket_id, assunto, row_number() OVER (PARTITION BY ticket_id ORDER BY arquivo_mtime, preco, qtde, desconto, taxa, parte, fornecedor, arquivo_origem) AS p FROM subject_feed),
    b AS (SELECT ticket_id, arquivo_origem FROM (SELECT ticket_id, arquivo_origem, row_number() OVER (PARTITION BY ticket_id ORDER BY arquivo_mtime, preco, qtde, desconto, taxa, parte, fornecedor, arquivo_origem) AS p FROM subject_feed) WHERE p = 1)
    SELECT ticket_id, arquivo_origem, """
    + ", ".join(f"max(CASE WHEN p = {i} THEN assunto END) AS assunto_{i}" for i in range(1, PIVOT_WIDTH + 1))
    + " FROM r JOIN b USING (ticket_id) GROUP BY ticket_id, arquivo_origem",
)
def pivot_subjects(spark, sf):
    feed = view(spark, sf, "subject_feed")
    wide = dedup.pivot_subjects(feed, ("arquivo_mtime", *SUBJECT_TIES))
    found = [c for c in wide.columns if c.startswith("assunto_")]
    missing = [f"assunto_{i}" for i in range(len(found) + 1, PIVOT_WIDTH + 1)]
    return wide.select(
        "ticket_id", "arquivo_origem", *found, *[F.lit(None).cast("string").alias(c) for c in missing]
    )


def _kinds(spark, sf):
    t = tickets(spark, sf)
    agency = F.when(F.col("ticket_id") % 19 == 0, F.col("case_id")).alias("protocolo_agenersa")
    slim = t.select("ticket_id", "matricula", "case_id", agency)
    return slim.filter("ticket_id % 2 = 0"), slim.filter("ticket_id % 2 = 1")


@query("dim_customers", "SELECT DISTINCT matricula FROM tickets WHERE matricula IS NOT NULL")
def dim_customers(spark, sf):
    return dedup.distinct_customers(*_kinds(spark, sf))


@query(
    "dim_cases",
    "SELECT case_id, max(CASE WHEN ticket_id % 19 = 0 THEN case_id END) AS protocolo_agenersa FROM tickets GROUP BY case_id",
)
def dim_cases(spark, sf):
    return dedup.distinct_cases(*_kinds(spark, sf))
