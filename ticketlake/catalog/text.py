"""Text, date and key queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ticketlake.catalog.inputs import table, tickets, view
from ticketlake.catalog.registry import query
from ticketlake.functions import text as T
from ticketlake.functions.dates import (
    business_calendar, holiday_calendar, parse_timestamp, timestamp_text, week_label, week_monday, weekday_label,
)
from ticketlake.functions.keys import case_id, court_case_key, protocols
from ticketlake.plans.bi import bi_fact_tickets, dim_status_bi
from ticketlake.plans.daily import report_dates

NORM = (
    "nullif(upper(trim(regexp_replace(regexp_replace(strip_accents(replace({c}, chr(160), ' ')), '[^\\x00-\\x7F]', '', 'g'),"
    " '[\\t-\\r\\x1c-\\x20]+', ' ', 'g'))), '')"
)
SUBJECT = "nullif(trim(regexp_replace({n}, '[^A-Z0-9]+', ' ', 'g')), '')"
TOKENS = "list_sort(list_distinct(list_filter(string_split(coalesce({s}, ''), ' '), lambda w: length(w) > 2)))"


def norm(c: str) -> str:
    return NORM.format(c=c)


def subject(c: str) -> str:
    return SUBJECT.format(n=norm(c))


def tokens(s: str) -> str:
    return TOKENS.format(s=s)


# Characters that decompose into one or several letters, in and beyond the basic plane, and their letters by hand.
RARE, RARE_LETTERS = "ⅫⅫ ㎏ ⅓ ạ 𝐀 Œ ㏂ ℡ ǆ Ⓩ ﬃ ", "XIIXII kg 13 a A  a.m. TEL dz Z ffi "


@query("norm_text", f"SELECT doc_id, {norm(f"CASE WHEN doc_id % 5 = 0 THEN '{RARE_LETTERS}' || text ELSE text END")} AS texto FROM documents")
def norm_text(spark, sf):
    text = F.when(F.col("doc_id") % 5 == 0, F.concat(F.lit(RARE), "text")).otherwise(F.col("text"))
    return table(spark, sf, "documents").select("doc_id", T.norm_text(text).alias("texto"))


@query(
    "norm_identifier",
    f"SELECT k, regexp_replace({norm('k')}, '\\.0+$', '') AS chave FROM "
    "(SELECT ' ' || CAST(o_totalprice AS VARCHAR) || CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE '.00 ' END AS k FROM "
    "(SELECT o_orderkey, CAST(floor(o_totalprice) AS BIGINT) AS o_totalprice FROM orders))",
)
def norm_identifier(spark, sf):
    raw = F.concat(
        F.lit(" "), F.floor("o_totalprice").cast("bigint").cast("string"),
        F.when(F.col("o_orderkey") % 3 == 0, "").otherwise(".00 "),
    )
    return table(spark, sf, "orders").select(raw.alias("k")).select("k", T.norm_identifier(F.col("k")).alias("chave"))


@query("norm_subject", f"SELECT conv_id, turn, {subject('text')} AS assunto FROM conversations")
def norm_subject(spark, sf):
    return table(spark, sf, "conversations").select("conv_id", "turn", T.norm_subject(F.col("text")).alias("assunto"))


@query(
    "token_set",
    f"SELECT doc_id, len(t) AS qtde, array_to_string(t, ' ') AS palavras FROM (SELECT doc_id, {tokens('s')} AS t FROM "
    f"(SELECT doc_id, {subject('text')} AS s FROM documents))",
)
def token_set(spark, sf):
    found = table(spark, sf, "documents").select("doc_id", T.token_set(F.col("text")).alias("t"))
    return found.select("doc_id", F.size("t").cast("bigint").alias("qtde"), F.array_join("t", " ").alias("palavras"))


@query(
    "territory",
    "SELECT ticket_id, matricula, CASE WHEN matricula LIKE '40%' THEN 'Bloco 4' WHEN matricula LIKE '10%' THEN 'Bloco 1' END AS bloco FROM tickets",
)
def territory(spark, sf):
    return tickets(spark, sf).select("ticket_id", "matricula", T.territory(F.col("matricula")).alias("bloco"))


@query(
    "last_segment",
    """
    SELECT ticket_id,
      CASE WHEN v IS NULL OR trim(v) = '' THEN v WHEN trim(fim) = '' THEN trim(v) ELSE trim(fim) END AS relatorio,
      CASE WHEN v IS NULL OR trim(v) = '' THEN 'NAO INFORMADO' WHEN trim(fim) = '' THEN trim(v) ELSE trim(fim) END AS servico,
      CASE WHEN v IS NULL THEN NULL ELSE trim(fim) END AS painel
    FROM (SELECT ticket_id, tipo_solicitacao AS v, string_split(tipo_solicitacao, '::')[-1] AS fim FROM tickets)
    """,
)
def last_segment(spark, sf):
    c = F.col("tipo_solicitacao")
    return tickets(spark, sf).select(
        "ticket_id", T.last_segment(c).alias("relatorio"), T.last_segment(c, missing="NAO INFORMADO").alias("servico"),
        T.last_segment(c, empty_tail="empty").alias("painel"),
    )


@query(
    "norm_class",
    f"""
    SELECT ticket_id, nullif(trim(regexp_replace(trim(string_split(c, '::')[-1]), '^\\[[^\\]]+\\]\\s*', '')), '') AS canal,
      nullif(trim(regexp_replace(trim(string_split(g, '::')[-1]), '^\\[[^\\]]+\\]\\s*', '')), '') AS grupo
    FROM (SELECT ticket_id, {norm('tipo_solicitacao')} AS c, {norm('grupo_tickets')} AS g FROM tickets)
    """,
)
def norm_class(spark, sf):
    return tickets(spark, sf).select(
        "ticket_id", T.norm_class(F.col("tipo_solicitacao")).alias("canal"), T.norm_class(F.col("grupo_tickets")).alias("grupo")
    )


@query(
    "clean_ws",
    f"""
    SELECT conv_id, turn, nullif(trim(regexp_replace(replace(text, chr(160), ' '), '[\\t-\\r\\x1c-\\x20]+', ' ', 'g')), '') AS texto,
      replace(upper(nfc_normalize(nullif(trim(regexp_replace(replace(text, chr(160), ' '), '[\\t-\\r\\x1c-\\x20]+', ' ', 'g')), ''))), 'ẞ', 'SS') AS assunto
    FROM conversations
    """,
)
def clean_ws(spark, sf):
    c = F.col("text")
    return table(spark, sf, "conversations").select(
        "conv_id", "turn", T.clean_ws(c).alias("texto"), T.clean_subject(c).alias("assunto")
    )


@query(
    "join_key",
    """
    SELECT ticket_id, CASE WHEN k IN ('NAN', 'NONE', 'NULL', '') THEN NULL ELSE k END AS chave
    FROM (SELECT ticket_id, upper(trim(regexp_replace(CASE WHEN ticket_id % 7 = 0 THEN ' nan' WHEN ticket_id % 5 = 0 THEN ' ' || matricula || '.0' ELSE lower(status) END, '\\.0$', ''))) AS k FROM tickets)
    """,
)
def join_key(spark, sf):
    k = F.col("ticket_id")
    raw = F.when(k % 7 == 0, F.lit(" nan")).when(k % 5 == 0, F.concat(F.lit(" "), "matricula", F.lit(".0"))).otherwise(
        F.lower("status")
    )
    return tickets(spark, sf).select("ticket_id", T.join_key_text(raw).alias("chave"))


PROTOCOL_SQL = r"""
    nullif(regexp_extract(titulo, '(\d{10})', 1), '') AS protocolo_agenersa,
    nullif(regexp_extract(titulo, '(\d{2}\.\d{2}\.\d{4}\.\d{3}\.\d{5}-\d{3})', 1), '') AS protocolo_procon,
    nullif(regexp_extract(titulo, '([Vv]\d{2,5}/\d{4})', 1), '') AS protocolo_defensoria,
    nullif(regexp_extract(titulo, '(\d{4,6}/\d{4})', 1), '') AS protocolo_codecon
"""


@query("protocols", f"SELECT ticket_id, {PROTOCOL_SQL} FROM tickets")
def protocols_query(spark, sf):
    found = protocols(F.col("titulo"))
    return tickets(spark, sf).select("ticket_id", *[c.alias(n) for n, c in found.items()])


DOC_TITLE = "'V' || lpad(CAST(doc_id % 99999 AS VARCHAR), 5, '0') || '/2024 ' || text"


@query(
    "protocols_text",
    "SELECT doc_id, " + PROTOCOL_SQL + f" FROM (SELECT doc_id, {DOC_TITLE} AS titulo FROM documents)",
)
def protocols_text(spark, sf):
    title = F.concat(F.lit("V"), F.lpad((F.col("doc_id") % 99999).cast("string"), 5, "0"), F.lit("/2024 "), "text")
    docs = table(spark, sf, "documents").select("doc_id", title.alias("titulo"))
    return docs.select("doc_id", *[c.alias(n) for n, c in protocols(F.col("titulo")).items()])


@query(
    "case_id",
    r"SELECT ticket_id, coalesce(nullif(regexp_extract(titulo, '(\d{10})', 1), ''), CAST(ticket_id AS VARCHAR)) AS case_id FROM tickets",
)
def case_id_query(spark, sf):
    found = protocols(F.col("titulo"))["protocolo_agenersa"]
    return tickets(spark, sf).select("ticket_id", case_id(found, F.col("ticket_id")).alias("case_id"))


@query(
    "court_key",
    """
    SELECT ticket_id, CASE WHEN (upper(coalesce(tipo_solicitacao, '')) LIKE '%JEC%' OR upper(coalesce(tipo_manifestacao, '')) LIKE '%JEC%')
        AND (coalesce(cpf_cliente, '') <> '' OR coalesce(matricula, '') <> '')
      THEN sha256(coalesce(cpf_cliente, '') || '|' || coalesce(matricula, '') || '|' || coalesce(lower(trim(assunto)), '')) END AS case_jec
    FROM tickets
    """,
)
def court_key(spark, sf):
    key = court_case_key(
        *[F.col(c) for c in ("tipo_solicitacao", "tipo_manifestacao", "cpf_cliente", "matricula", "assunto")]
    )
    return tickets(spark, sf).select("ticket_id", key.alias("case_jec"))


EASTER_SQL = """
    years AS (SELECT DISTINCT CAST(year(o_orderdate) AS BIGINT) AS y FROM orders),
    p1 AS (SELECT y, y % 19 AS a, y // 100 AS b, y % 100 AS c FROM years),
    p2 AS (SELECT *, (19 * a + b - b // 4 - ((b - (b + 8) // 25 + 1) // 3) + 15) % 30 AS h, b % 4 AS e FROM p1),
    p3 AS (SELECT *, (32 + 2 * e + 2 * (c // 4) - h - c % 4) % 7 AS l FROM p2),
    p4 AS (SELECT *, h + l - 7 * ((a + 11 * h + 22 * l) // 451) + 114 AS n FROM p3),
    easter AS (SELECT y, make_date(y, n // 31, n % 31 + 1) AS pascoa FROM p4),
    feriados AS (
      SELECT make_date(y, m, d) AS feriado FROM years, (VALUES (1,1),(4,21),(5,1),(9,7),(10,12),(11,2),(11,15),(12,25)) f(m, d)
      UNION SELECT CAST(pascoa + CAST(o AS INTEGER) AS DATE) FROM easter, (VALUES (-48),(-47),(-2),(60)) g(o)
    )
"""


def order_years(spark, sf):
    return table(spark, sf, "orders").select(F.year("o_orderdate").alias("ano")).distinct()


@query("holidays", f"WITH {EASTER_SQL} SELECT feriado FROM feriados", days=("feriado",))
def holidays(spark, sf):
    return holiday_calendar(order_years(spark, sf))


@query(
    "prev_business_day",
    f"""
    WITH {EASTER_SQL},
    dias AS (SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS data FROM
      (SELECT min(CAST(o_orderdate AS DATE)) AS a, max(CAST(o_orderdate AS DATE)) AS b FROM orders)),
    m AS (SELECT data, CASE WHEN isodow(data) < 6 AND data NOT IN (SELECT feriado FROM feriados) THEN 1 ELSE 0 END AS dia_util FROM dias),
    p AS (SELECT data, CAST(dia_util AS INTEGER) AS dia_util, max(CASE WHEN dia_util = 1 THEN data END) OVER (ORDER BY data ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS dia_util_anterior FROM m)
    SELECT data, dia_util, dia_util_anterior,
      CASE WHEN data - dia_util_anterior > 1 THEN dia_util_anterior + 1 END AS inicio_excecao,
      CASE WHEN data - dia_util_anterior > 1 THEN data - 1 END AS fim_excecao
    FROM p
    """,
    days=("data", "dia_util_anterior", "inicio_excecao", "fim_excecao"),
)
def prev_business_day(spark, sf):
    span = table(spark, sf, "orders").agg(F.min(F.to_date("o_orderdate")).alias("a"), F.max(F.to_date("o_orderdate")).alias("b"))
    days = span.select(F.explode(F.sequence("a", "b")).alias("data"))
    return business_calendar(days, holiday_calendar(order_years(spark, sf)))


@query(
    "week_labels",
    """
    SELECT d AS data, d - CAST(isodow(d) - 1 AS INTEGER) AS segunda, strftime(d, '%Y') || '-S' || strftime(d, '%W') AS semana,
      count(*) AS qtde FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders) GROUP BY d
    """,
    days=("data", "segunda"),
)
def week_labels(spark, sf):
    days = table(spark, sf, "orders").groupBy(F.to_date("o_orderdate").alias("data")).agg(F.count(F.lit(1)).alias("qtde"))
    d = F.col("data")
    return days.select(d, week_monday(d).alias("segunda"), week_label(d).alias("semana"), "qtde")


@query(
    "weekday_label",
    """
    SELECT ticket_id, CASE isodow(data_criacao) WHEN 1 THEN 'Segunda-feira' WHEN 2 THEN 'Terça-feira' WHEN 3 THEN 'Quarta-feira'
      WHEN 4 THEN 'Quinta-feira' WHEN 5 THEN 'Sexta-feira' END AS dia_semana FROM tickets
    """,
)
def weekday_label_query(spark, sf):
    return tickets(spark, sf).select("ticket_id", weekday_label(F.to_date("data_criacao")).alias("dia_semana"))


@query(
    "report_dates",
    """
    SELECT ticket_id, TRY_CAST(criado AS DATE) AS criado, CAST(data_resolucao AS DATE) AS data_resolucao,
      CASE WHEN trim(string_split(assunto, '::')[-1]) = '' THEN trim(assunto) ELSE trim(string_split(assunto, '::')[-1]) END AS assunto
    FROM (SELECT *, CASE WHEN ticket_id % 61 = 0 THEN 'nao eh data' ELSE strftime(data_criacao, '%Y-%m-%d %H:%M:%S') END AS criado FROM tickets)
    """,
    days=("criado", "data_resolucao"),
)
def report_dates_query(spark, sf):
    text = F.when(F.col("ticket_id") % 61 == 0, "nao eh data").otherwise(timestamp_text(F.col("data_criacao")))
    t = tickets(spark, sf).select("ticket_id", text.alias("criado"), "data_resolucao", "assunto")
    return report_dates(t, ("criado", "data_resolucao"), ("assunto",))


@query(
    "coerce_ts",
    """
    SELECT ticket_id, coalesce(TRY_CAST(v AS TIMESTAMP), try_strptime(v, '%m/%d/%Y %H:%M')) AS data
    FROM (SELECT ticket_id, CASE ticket_id % 4 WHEN 0 THEN strftime(data_criacao, '%Y-%m-%d %H:%M:%S') WHEN 1 THEN strftime(data_criacao, '%m/%d/%Y %H:%M') WHEN 2 THEN 'nao eh data' END AS v FROM tickets)
    """,
    stamps=("data",),
)
def coerce_ts(spark, sf):
    k, d = F.col("ticket_id") % 4, F.col("data_criacao")
    text = F.when(k == 0, timestamp_text(d)).when(k == 1, F.date_format(d, "MM/dd/yyyy HH:mm")).when(k == 2, "nao eh data")
    return tickets(spark, sf).select("ticket_id", parse_timestamp(text).alias("data"))


@query("serialize_ts", "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM events")
def serialize_ts(spark, sf):
    return table(spark, sf, "events").select("event_id", timestamp_text(F.col("ts")).alias("ts"))


@query(
    "jaccard",
    f"""
    SELECT ticket_id, CASE WHEN len(a) = 0 OR len(b) = 0 THEN 0.0 ELSE round(CAST(len(list_intersect(a, b)) AS DOUBLE) / len(list_distinct(list_concat(a, b))), 6) END AS semelhanca
    FROM (SELECT ticket_id, {tokens('sa')} AS a, {tokens('sb')} AS b FROM (SELECT ticket_id, {subject('assunto')} AS sa, {subject('titulo')} AS sb FROM tickets))
    """,
)
def jaccard(spark, sf):
    sets = tickets(spark, sf).select(
        "ticket_id", T.token_set(F.col("assunto")).alias("a"), T.token_set(F.col("titulo")).alias("b")
    )
    return sets.select("ticket_id", F.round(T.jaccard(F.col("a"), F.col("b")), 6).alias("semelhanca"))


@query(
    "dim_status_bi",
    """
    SELECT status, CASE WHEN upper(trim(status)) IN ('SOLVED','CLOSED','RESOLVIDO','FECHADO') THEN 'Fechado'
      WHEN upper(trim(status)) IN ('OPEN','NEW','HOLD','PENDING','ABERTO') THEN 'Aberto' ELSE 'Outros' END AS status_grupo
    FROM (SELECT DISTINCT status FROM tickets WHERE coalesce(flag_arquivado_relatorio, 0) = 0 AND upper(coalesce(formulario_ticket, '')) LIKE 'SOLICIT%'
      AND upper(coalesce(tipo_manifestacao, '')) <> 'ANEXO' AND upper(coalesce(classificacao_notificacoes, '')) <> 'INFORMATIVO::ANEXO')
    """,
)
def dim_status_bi_query(spark, sf):
    return dim_status_bi(bi_fact_tickets(tickets(spark, sf), view(spark, sf, "hearings")))


