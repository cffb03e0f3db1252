"""Work-order and linking queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketlake.catalog.ingest import CLASS, ident
from ticketlake.catalog.inputs import ORDER_TIES, TODAY, table, tickets, view
from ticketlake.catalog.registry import query
from ticketlake.catalog.text import norm, subject, tokens
from ticketlake.functions.keys import protocols
from ticketlake.functions.text import norm_class
from ticketlake.operators import linking, orders
from ticketlake.session import settle

ORDER_TIES_SQL = ", ".join(f"{c} DESC" for c in ORDER_TIES)


def words(*cols: str) -> str:
    return "nullif(concat_ws(' ', " + ", ".join(f"nullif(trim({c}), '')" for c in cols) + "), '')"


PREPARED_SQL = f"""
    os0 AS (SELECT * REPLACE ({ident('matricula')} AS matricula, {ident('numero_os')} AS numero_os, {ident('ano_os')} AS ano_os) FROM work_orders),
    os1 AS (SELECT *, CASE WHEN ano_os IS NOT NULL THEN ano_os || '-' || numero_os ELSE numero_os END AS gss_os_id,
        CASE WHEN data_execucao IS NOT NULL THEN 'EXECUTADA' WHEN previsao_conclusao < DATE '{TODAY}' THEN 'PENDENTE_VENCIDA' WHEN previsao_conclusao IS NOT NULL OR data_emissao IS NOT NULL THEN 'PENDENTE' END AS status_os_gss,
        {subject(words('servico_executado', 'solicitacao_associada', 'tipo_solicitacao_gss'))} AS servico_normalizado
      FROM os0 WHERE numero_os IS NOT NULL AND matricula IN (SELECT {ident('matricula')} FROM tickets)),
    prep AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY gss_os_id ORDER BY arquivo_mtime DESC, {ORDER_TIES_SQL}) AS rn FROM os1) WHERE rn = 1)
"""


def feed(spark, sf) -> DataFrame:
    return view(spark, sf, "work_orders").withColumn("numero_porta", F.col("porta").cast("string")).drop("porta")


def prepared(spark, sf) -> DataFrame:
    kept = orders.semi_filter_orders(feed(spark, sf), tickets(spark, sf))
    return orders.prepare_orders(kept, TODAY, ORDER_TIES)


@query("gss_semi", f"SELECT numero_os, {ident('matricula')} AS matricula, data_emissao FROM work_orders WHERE {ident('matricula')} IN (SELECT {ident('matricula')} FROM tickets)", stamps=("data_emissao",))
def gss_semi(spark, sf):
    return orders.semi_filter_orders(feed(spark, sf), tickets(spark, sf)).select("numero_os", "matricula", "data_emissao")


@query(
    "order_status",
    f"WITH {PREPARED_SQL} SELECT gss_os_id, numero_os, matricula, status_os_gss, servico_normalizado, data_emissao FROM prep",
    stamps=("data_emissao",),
)
def order_status(spark, sf):
    return prepared(spark, sf).select(
        "gss_os_id", "numero_os", "matricula", "status_os_gss", "servico_normalizado", "data_emissao"
    )


def blank(c: str) -> str:
    return f"CASE WHEN trim({c}) IN ('', '<NA>', 'nan', 'None') THEN NULL ELSE trim({c}) END"


# Written out here and not taken from the operator: order column, its expression in the check SQL, ticket column.
FILLS = (
    ("bairro", "bairro", "bairro"),
    ("municipio", "municipio", "municipio"),
    ("nome_logradouro", "nome_logradouro", "logradouro"),
    ("endereco_requerente", "endereco_requerente", "endereco"),
    ("numero_porta", "CAST(porta AS VARCHAR)", "numero_porta"),
    ("complemento", "complemento", "complemento"),
    ("telefone", "telefone", "telefone"),
    ("nome_cliente", "nome_cliente", "nome_cliente_gss"),
    ("nome_requerente", "nome_requerente", "nome_requerente_gss"),
)
SOURCES = {source: shown for source, shown, _ in FILLS}
FILLED = " + ".join(f"CASE WHEN c_{s} IS NOT NULL THEN 1 ELSE 0 END" for s in SOURCES)


@query(
    "enrich_missing",
    f"""
    WITH {PREPARED_SQL},
    k0 AS (SELECT matricula, gss_os_id, data_emissao, data_execucao, data_agendamento, {', '.join(f'{blank(e)} AS c_{s}' for s, e in SOURCES.items())} FROM prep),
    k AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY matricula ORDER BY {FILLED} DESC, data_emissao DESC NULLS LAST, data_execucao DESC NULLS LAST, data_agendamento DESC NULLS LAST, gss_os_id DESC) AS rn FROM k0) WHERE rn = 1)
    SELECT ticket_id, {', '.join(f"CASE WHEN {blank('t.' + target)} IS NULL THEN coalesce(k.c_{source}, t.{target}) ELSE t.{target} END AS {target}" for source, _, target in FILLS)}
    FROM tickets t LEFT JOIN k ON k.matricula = t.matricula
    """,
)
def enrich_missing(spark, sf):
    filled = orders.enrich_missing(tickets(spark, sf), prepared(spark, sf))
    return filled.select("ticket_id", *[target for _, _, target in FILLS])


@query(
    "match_exact",
    f"""
    WITH {PREPARED_SQL},
    t AS (SELECT ticket_id, matricula, {ident('numero_os')} AS n FROM tickets WHERE {ident('numero_os')} IS NOT NULL)
    SELECT ticket_id, gss_exato FROM (SELECT ticket_id, gss_os_id AS gss_exato, row_number() OVER (PARTITION BY ticket_id ORDER BY CASE WHEN p.matricula = t.matricula THEN 0 ELSE 1 END, data_emissao DESC NULLS LAST, gss_os_id DESC) AS rn
      FROM t LEFT JOIN prep p ON p.numero_os = t.n) WHERE rn = 1
    """,
)
def match_exact(spark, sf):
    given = tickets(spark, sf).filter("numero_os IS NOT NULL").select(
        "ticket_id", "matricula", F.col("numero_os").alias("numero_os_original")
    )
    return orders.match_exact(given, prepared(spark, sf))


DATE_SCORE = "CASE WHEN dist <= 3 THEN 1.0::DOUBLE WHEN dist <= 7 THEN 0.85::DOUBLE WHEN dist <= 15 THEN 0.65::DOUBLE WHEN dist <= 30 THEN 0.40::DOUBLE WHEN dist <= 60 THEN 0.20::DOUBLE ELSE 0.0::DOUBLE END"
MATCH_SQL = f"""
    WITH {PREPARED_SQL},
    o AS (SELECT *, {tokens('servico_normalizado')} AS tk FROM prep),
    t AS (SELECT ticket_id, matricula, {ident('numero_os')} AS n, CAST(coalesce(data_entrada_reclamacao, data_criacao_solicitacao, data_criacao) AS DATE) AS dia,
        coalesce({norm('status')} IN ('OPEN', 'HOLD', 'PENDING', 'NEW'), FALSE) AS aberto,
        {subject(words('titulo', 'assunto', 'tipo_solicitacao', 'tipo_manifestacao', 'classificacao_solicitacoes', 'canais_de_atrito'))} AS txt FROM tickets),
    tt AS (SELECT *, {tokens('txt')} AS tk FROM t),
    ex AS (SELECT * FROM (SELECT ticket_id, gss_os_id, row_number() OVER (PARTITION BY ticket_id ORDER BY CASE WHEN p.matricula = t.matricula THEN 0 ELSE 1 END, data_emissao DESC NULLS LAST, gss_os_id DESC) AS rn
      FROM t JOIN prep p ON p.numero_os = t.n) WHERE rn = 1),
    c0 AS (SELECT tt.ticket_id, o.gss_os_id, o.numero_os, o.data_emissao, abs(dia - CAST(o.data_emissao AS DATE)) AS dist, aberto, status_os_gss,
        CASE WHEN len(tt.tk) = 0 OR len(o.tk) = 0 THEN 0.0::DOUBLE ELSE CAST(len(list_intersect(tt.tk, o.tk)) AS DOUBLE) / CAST(len(list_distinct(list_concat(tt.tk, o.tk))) AS DOUBLE) END AS js
      FROM tt JOIN o ON o.matricula = tt.matricula WHERE tt.n IS NULL),
    c1 AS (SELECT *, {DATE_SCORE} AS ds, CASE WHEN status_os_gss IN ('PENDENTE', 'PENDENTE_VENCIDA') THEN CASE WHEN aberto THEN 1.0::DOUBLE ELSE 0.75::DOUBLE END WHEN status_os_gss = 'EXECUTADA' THEN 0.60::DOUBLE ELSE 0.30::DOUBLE END AS ss FROM c0),
    c2 AS (SELECT *, 0.50::DOUBLE * ds + 0.35::DOUBLE * js + 0.15::DOUBLE * ss AS score FROM c1),
    c3 AS (SELECT *, row_number() OVER w AS rn, lead(score) OVER w AS s2 FROM c2 WINDOW w AS (PARTITION BY ticket_id ORDER BY score DESC, data_emissao DESC NULLS LAST, gss_os_id DESC)),
    b AS (SELECT *, score >= 0.55::DOUBLE AS bom, score >= 0.55::DOUBLE AND score - coalesce(s2, 0.0::DOUBLE) >= 0.10::DOUBLE AS claro FROM c3 WHERE rn = 1)
    SELECT t.ticket_id, coalesce(t.n, CASE WHEN claro THEN b.numero_os END) AS numero_os, t.n AS numero_os_original,
      CASE WHEN ex.gss_os_id IS NOT NULL THEN t.n WHEN bom THEN b.numero_os END AS numero_os_gss, coalesce(ex.gss_os_id, CASE WHEN bom THEN b.gss_os_id END) AS gss_os_id,
      CASE WHEN t.n IS NOT NULL THEN 'ZENDESK' WHEN claro THEN 'GSS_MATCH' END AS origem_numero_os,
      CASE WHEN ex.gss_os_id IS NOT NULL THEN 'MATCH_EXATO_ZENDESK_GSS' WHEN t.n IS NOT NULL THEN 'ZENDESK_ORIGINAL' WHEN t.matricula IS NULL THEN 'SEM_MATRICULA' WHEN b.ticket_id IS NULL THEN 'SEM_CANDIDATO_GSS'
        WHEN claro THEN 'MATCH_AUTOMATICO' WHEN bom THEN 'AMBIGUO' ELSE 'SEM_MATCH' END AS status_vinculo_os,
      CASE WHEN t.n IS NOT NULL THEN 1.0::DOUBLE ELSE CAST(printf('%.4f', score) AS DOUBLE) END AS score_vinculo_os,
      CASE WHEN ex.gss_os_id IS NOT NULL THEN 'numero_os_exato' WHEN t.n IS NOT NULL THEN 'numero_os_informado_no_zendesk' WHEN t.matricula IS NULL THEN 'matricula_ausente' WHEN b.ticket_id IS NULL THEN 'nenhuma_os_para_matricula'
        ELSE printf('matricula+score_servico_datas|date=%.2f|service=%.2f|status=%.2f', ds, js, ss) END AS criterio_vinculo_os
    FROM t LEFT JOIN ex ON ex.ticket_id = t.ticket_id LEFT JOIN b ON b.ticket_id = t.ticket_id
"""


@query("match_scored", MATCH_SQL)
def match_scored(spark, sf):
    # Both the scores and the exact lookup read the prepared orders, so what they read of them is materialised once.
    return orders.match_orders(tickets(spark, sf), settle(prepared(spark, sf).select(*orders.MATCHED_FIELDS))).select(
        "ticket_id", *orders.MATCH_COLUMNS
    )


@query("match_not_loaded", f"SELECT ticket_id, {ident('numero_os')} AS numero_os, CASE WHEN {ident('numero_os')} IS NULL THEN 'GSS_NAO_CARREGADO' ELSE 'ZENDESK_ORIGINAL' END AS status_vinculo_os FROM tickets")
def match_not_loaded(spark, sf):
    return orders.match_orders(tickets(spark, sf), None).select("ticket_id", "numero_os", "status_vinculo_os")


# ---- linking ------------------------------------------------------------------------------------------------
def link_sides(spark, sf) -> tuple[DataFrame, DataFrame]:
    t = tickets(spark, sf).select("ticket_id", "matricula", "data_criacao", "assunto", "titulo")
    return t.filter("ticket_id % 2 = 0"), t.filter("ticket_id % 2 = 1")


def link_keys(side: DataFrame) -> DataFrame:
    return side.select(
        "ticket_id", "matricula", "data_criacao", norm_class(F.coalesce("assunto", "titulo")).alias("assunto_normalizado"),
        *[c.alias(n) for n, c in protocols(F.col("titulo")).items() if n == "protocolo_procon"],
    ).withColumnRenamed("protocolo_procon", "protocolo_referencia")


LINK_SQL = f"""
    t AS (SELECT ticket_id, matricula, data_criacao, {CLASS.format(n=norm('coalesce(assunto, titulo)'))} AS assunto_normalizado, nullif(regexp_extract(titulo, '(\\d{{2}}\\.\\d{{2}}\\.\\d{{4}}\\.\\d{{3}}\\.\\d{{5}}-\\d{{3}})', 1), '') AS protocolo_referencia FROM tickets),
    s AS (SELECT * FROM t WHERE ticket_id % 2 = 0), n AS (SELECT * FROM t WHERE ticket_id % 2 = 1)
"""


def candidates_sql(rule: str, key: str, sides: str = "s JOIN n") -> str:
    return (
        f"SELECT s.ticket_id AS ticket_solicitacao_id, '{rule}' AS criterio_vinculo, count(*) AS quantidade_candidatos FROM {sides} "
        f"ON s.matricula = n.matricula AND s.{key} = n.{key} AND n.data_criacao <= s.data_criacao AND n.data_criacao >= s.data_criacao - INTERVAL {{w}} DAY GROUP BY s.ticket_id"
    )


BOTH_RULES = candidates_sql("matricula_protocolo", "protocolo_referencia") + " UNION ALL " + candidates_sql("titulo_normalizado", "assunto_normalizado")


@query("link_candidates", f"WITH {LINK_SQL} " + BOTH_RULES.replace("{w}", "7"))
def link_candidates(spark, sf):
    return linking.link_candidates(*map(link_keys, link_sides(spark, sf)))


DENSE_SQL = "s AS (SELECT * FROM dense_links WHERE event_type = 'purchase'), n AS (SELECT * FROM dense_links WHERE event_type = 'error')"


def dense_sides(spark, sf) -> tuple[DataFrame, DataFrame]:
    events = view(spark, sf, "dense_links")
    return events.filter("event_type = 'purchase'"), events.filter("event_type = 'error'")


@query("link_candidates_dense", f"WITH {DENSE_SQL} " + BOTH_RULES.replace("{w}", "7"))
def link_candidates_dense(spark, sf):
    return linking.link_candidates(*dense_sides(spark, sf))


# Check by another route: the k-th request of every account at once, with the list of notices used so far. `by_hand` names
# (request, notice or nothing); a notice taken by hand is gone from the turn of the first request that takes it.
NO_HAND = "by_hand AS (SELECT CAST(NULL AS BIGINT) AS pedido, CAST(NULL AS BIGINT) AS alvo, false AS vale WHERE false)"
BY_HAND = """by_hand AS (SELECT ticket_id AS pedido, CASE WHEN ticket_id % 194 = 0 THEN ticket_id + 1 ELSE -ticket_id END AS alvo,
      CASE WHEN ticket_id % 194 = 0 THEN ticket_id + 1 ELSE -ticket_id END IN (SELECT ticket_id FROM n) AS vale FROM s WHERE ticket_id % 97 = 0)"""


LINK_ROWS = """
    SELECT ticket_solicitacao_id, ticket_notificacao_id,
      CASE WHEN vale THEN 'MANUAL' WHEN mao OR achados = 0 THEN 'SEM_VINCULO' WHEN achados = 1 THEN 'VINCULADO' ELSE 'AMBIGUO' END AS status_vinculo,
      CASE WHEN vale THEN 'manual' WHEN mao THEN 'manual_invalido' WHEN regra = 0 THEN 'matricula_protocolo' WHEN regra = 1 THEN 'titulo_normalizado' END AS criterio_vinculo,
      CAST(CASE WHEN vale THEN 1.0 WHEN mao THEN 0.0 WHEN regra = 0 THEN 0.95 WHEN regra = 1 THEN 0.85 END AS DOUBLE) AS confianca_vinculo,
      criada AS data_entrada_reclamacao, criada AS data_criacao_solicitacao, n.data_criacao AS data_criacao_notificacao,
      CAST(date_diff('day', CAST(n.data_criacao AS DATE), CAST(criada AS DATE)) AS INTEGER) AS dias_defasagem_abertura,
      CAST(CASE WHEN vale THEN 1 WHEN mao THEN 0 ELSE achados END AS BIGINT) AS quantidade_candidatos,
      CASE WHEN vale THEN 'a pedido' WHEN mao THEN 'Vinculo manual aponta para ticket de notificacao inexistente na base carregada.' WHEN achados > 1 THEN 'Candidatos encontrados para analise manual: ' || array_to_string(livres[1:10], ', ')
        WHEN achados = 0 THEN 'Nenhum criterio automatico encontrou notificacao correspondente.' END AS observacao
    FROM l LEFT JOIN n ON n.ticket_id = ticket_notificacao_id
"""
CANDIDATE_ROWS = """
    SELECT ticket_solicitacao_id, CASE regra WHEN 0 THEN 'matricula_protocolo' ELSE 'titulo_normalizado' END AS criterio_vinculo, unnest(livres) AS ticket_notificacao_id
    FROM l WHERE achados > 1 AND NOT mao
"""


def link_sql(sides: str, by_hand: str = NO_HAND, rows: str = LINK_ROWS) -> str:
    def options(key: str) -> str:
        return (
            f"coalesce((SELECT list(n.ticket_id ORDER BY n.data_criacao, n.ticket_id) FROM n LEFT JOIN gone g ON g.alvo = n.ticket_id WHERE n.matricula = q.matricula AND trim(n.{key}) <> '' AND n.{key} = q.{key}"
            " AND n.data_criacao BETWEEN q.data_criacao - INTERVAL 7 DAY AND q.data_criacao AND (g.alvo IS NULL OR (q.data_criacao, q.ticket_id) < (g.vez, g.pedido))), CAST([] AS BIGINT[]))"
        )

    return f"""
    WITH RECURSIVE {sides}, {by_hand},
    gone AS (SELECT alvo, min(vez).vez AS vez, min(vez).pedido AS pedido FROM (SELECT alvo, {{'vez': data_criacao, 'pedido': pedido}} AS vez FROM by_hand JOIN s ON ticket_id = pedido WHERE vale AND data_criacao IS NOT NULL) GROUP BY alvo),
    r AS (
      SELECT ticket_id, matricula, row_number() OVER (PARTITION BY matricula ORDER BY data_criacao, ticket_id) AS k, {options("protocolo_referencia")} AS primeiros, {options("assunto_normalizado")} AS segundos
      FROM s q WHERE trim(matricula) <> '' AND data_criacao IS NOT NULL AND ticket_id NOT IN (SELECT pedido FROM by_hand)
    ),
    walk AS (
      SELECT DISTINCT matricula, CAST(0 AS BIGINT) AS k, CAST([] AS BIGINT[]) AS used, CAST(NULL AS BIGINT) AS ticket_id, CAST(NULL AS INTEGER) AS regra, CAST([] AS BIGINT[]) AS livres FROM r
      UNION ALL
      SELECT matricula, k, CASE WHEN len(livres) = 1 THEN list_append(used, livres[1]) ELSE used END, ticket_id, regra, livres
      FROM (
        SELECT matricula, k, used, ticket_id, CASE WHEN len(p) > 0 THEN 0 WHEN len(q) > 0 THEN 1 END AS regra, CASE WHEN len(p) > 0 THEN p ELSE q END AS livres
        FROM (SELECT w.matricula, r.k, w.used, r.ticket_id, list_filter(r.primeiros, lambda x: NOT list_contains(w.used, x)) AS p, list_filter(r.segundos, lambda x: NOT list_contains(w.used, x)) AS q FROM walk w JOIN r ON r.matricula = w.matricula AND r.k = w.k + 1)
      )
    ),
    l AS (
      SELECT s.ticket_id AS ticket_solicitacao_id, h.pedido IS NOT NULL AS mao, coalesce(h.vale, false) AS vale, w.regra,
        CASE WHEN vale THEN h.alvo WHEN NOT mao AND len(livres) = 1 THEN livres[1] END AS ticket_notificacao_id, coalesce(len(livres), 0) AS achados, livres, s.data_criacao AS criada
      FROM s LEFT JOIN by_hand h ON h.pedido = s.ticket_id LEFT JOIN walk w ON w.ticket_id = s.ticket_id
    )
    {rows}
    """


LINK_STAMPS = ("data_entrada_reclamacao", "data_criacao_solicitacao", "data_criacao_notificacao")


@query("link_tickets", link_sql(LINK_SQL.strip()), stamps=LINK_STAMPS)
def link_tickets(spark, sf):
    return linking.link_tickets(*link_sides(spark, sf), keys=link_keys)


@query("link_tickets_dense", link_sql(DENSE_SQL), stamps=LINK_STAMPS)
def link_tickets_dense(spark, sf):
    return linking.link_tickets(*dense_sides(spark, sf))


@query("link_ambiguous", link_sql(DENSE_SQL, rows=CANDIDATE_ROWS))
def link_ambiguous(spark, sf):
    sides = dense_sides(spark, sf)
    return linking.ambiguous_candidates(linking.link_tickets(*sides), *sides)


def manual_links(requests: DataFrame) -> DataFrame:
    """Every 97th request named by hand, half of them to a notice that does not exist."""
    k = F.col("ticket_id")
    return requests.filter(k % 97 == 0).select(
        k.cast("string").alias("ticket_solicitacao_id"),
        F.when(k % 194 == 0, k + 1).otherwise(-k).cast("string").alias("ticket_notificacao_id"),
        F.lit("a pedido").alias("justificativa"), F.lit("analista").alias("usuario"),
        F.col("data_criacao").alias("atualizado_em"),
    )


@query("link_tickets_manual", link_sql(LINK_SQL.strip(), BY_HAND), stamps=LINK_STAMPS)
def link_tickets_manual(spark, sf):
    requests, notices = link_sides(spark, sf)
    return linking.link_tickets(requests, notices, linking.load_manual(manual_links(requests)), keys=link_keys)


@query("link_ambiguous_manual", link_sql(LINK_SQL.strip(), BY_HAND, CANDIDATE_ROWS))
def link_ambiguous_manual(spark, sf):
    requests, notices = link_sides(spark, sf)
    links = linking.link_tickets(requests, notices, linking.load_manual(manual_links(requests)), keys=link_keys)
    return linking.ambiguous_candidates(links, requests, notices, keys=link_keys)


@query(
    "link_status_counts",
    f"SELECT status_vinculo, criterio_vinculo, count(*) AS qtde, CAST(sum(quantidade_candidatos) AS BIGINT) AS candidatos FROM ({link_sql(LINK_SQL.strip(), BY_HAND)}) GROUP BY ALL",
)
def link_status_counts(spark, sf):
    requests, notices = link_sides(spark, sf)
    links = linking.link_tickets(requests, notices, linking.load_manual(manual_links(requests)), keys=link_keys)
    return links.groupBy("status_vinculo", "criterio_vinculo").agg(
        F.count(F.lit(1)).alias("qtde"), F.sum("quantidade_candidatos").alias("candidatos")
    )


@query(
    "attach_links",
    """
    WITH l AS (SELECT ticket_id AS rid, ticket_notificacao_id AS nid, status_vinculo AS st, data_criacao AS dc FROM tickets WHERE ticket_id % 3 = 0)
    SELECT ticket_id, coalesce(rid, ticket_id) AS ticket_solicitacao_id, nid AS ticket_notificacao_id, coalesce(dc, data_criacao) AS data_criacao_solicitacao, dc AS data_entrada_reclamacao, st AS status_vinculo
    FROM tickets LEFT JOIN l ON rid = ticket_id
    """,
    stamps=("data_criacao_solicitacao", "data_entrada_reclamacao"),
)
def attach_links(spark, sf):
    t = tickets(spark, sf)
    links = t.filter("ticket_id % 3 = 0").select(
        F.col("ticket_id").alias("ticket_solicitacao_id"), "ticket_notificacao_id",
        F.col("data_criacao").alias("data_entrada_reclamacao"), F.col("data_criacao").alias("data_criacao_solicitacao"),
        "data_criacao_notificacao", "dias_defasagem_abertura", "criterio_vinculo", "confianca_vinculo", "status_vinculo",
    )
    return linking.attach_links(t.select("ticket_id", "data_criacao"), links).select(
        "ticket_id", "ticket_solicitacao_id", "ticket_notificacao_id", "data_criacao_solicitacao",
        "data_entrada_reclamacao", "status_vinculo",
    )


@query(
    "attach_master",
    """
    WITH m AS (SELECT * FROM (SELECT upper(trim(regexp_replace('  ' || CASE c_custkey % 3 WHEN 0 THEN '40' WHEN 1 THEN '10' ELSE '99' END || lpad(CAST(c_custkey AS VARCHAR), 6, '0') || '.0', '\\.0$', ''))) AS chave, c_name, c_mktsegment FROM customer))
    SELECT ticket_id, matricula, c_name, c_mktsegment FROM tickets LEFT JOIN m ON chave = matricula
    """,
)
def attach_master(spark, sf):
    prefix = F.when(F.col("c_custkey") % 3 == 0, "40").when(F.col("c_custkey") % 3 == 1, "10").otherwise("99")
    key = F.concat(F.lit("  "), prefix, F.lpad(F.col("c_custkey").cast("string"), 6, "0"), F.lit(".0"))
    master = table(spark, sf, "customer").select(key.alias("NUM_LIGACAO"), "c_name", "c_mktsegment", "c_custkey")
    joined = orders.attach_master(
        tickets(spark, sf).select("ticket_id", "matricula"), master, "matricula", "NUM_LIGACAO", ("c_custkey",)
    )
    return joined.select("ticket_id", "matricula", "c_name", "c_mktsegment")

