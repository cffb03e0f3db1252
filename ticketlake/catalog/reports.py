"""Report, mart and BI queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ticketlake.catalog.ingest import SUBJECTS_SQL
from ticketlake.catalog.inputs import END, START, SUBJECT_TIES, TODAY, hearings, tickets, view
from ticketlake.catalog.registry import query
from ticketlake.catalog.rules import ACTIVE, BI, DAILY, FORM, REPORT, SANITIZED, SERVICE
from ticketlake.functions.dates import CALENDAR_MONTH_NAMES, MONTH_NAMES, WEEKDAY_NAMES, report_window
from ticketlake.operators import dedup
from ticketlake.plans import bi, daily, marts, reports, weekly
from ticketlake.schemas import TICKETS

ENTRY = "coalesce(data_entrada_reclamacao, data_criacao)"
ENTRY_DAY = f"CAST({ENTRY} AS DATE)"
CHANNEL = "coalesce(nullif(trim(tipo_solicitacao, ' '), ''), 'NAO INFORMADO')"
ASSIGNEE = "coalesce(nullif(trim(atribuido, ' '), ''), 'NAO ATRIBUIDO')"
PERIOD_DAYS = f"BETWEEN DATE '{START}' AND DATE '{END}'"
OPEN = "upper(trim(coalesce(status, ''), ' ')) IN ('OPEN', 'HOLD', 'PENDING', 'NEW')"
DONE = "upper(trim(coalesce(status, ''), ' ')) IN ('SOLVED', 'CLOSED')"
EFFECTIVE = "CAST(coalesce(data_reagendamento, data_audiencia) AS DATE)"
PROCON = "nullif(trim(protocolo_procon, ' '), '') IS NOT NULL"


def short(c: str) -> str:
    return f"CASE WHEN trim(string_split({c}, '::')[-1]) = '' THEN trim({c}) ELSE trim(string_split({c}, '::')[-1]) END"


MONDAY = "d - CAST(isodow(d) - 1 AS INTEGER)"
WEEK = "strftime(d, '%Y') || '-S' || strftime(d, '%W')"
LEVELS = {
    "DIARIA": ("d", "strftime(d, '%Y-%m-%d')", "strftime(d, '%W')", "strftime(d, '%m')"),
    "SEMANAL": (MONDAY, WEEK, "strftime(d, '%W')", "NULL"),
    "MENSAL": ("CAST(date_trunc('month', d) AS DATE)", "strftime(d, '%Y-%m')", "NULL", "strftime(d, '%m')"),
    "ANUAL": ("CAST(date_trunc('year', d) AS DATE)", "strftime(d, '%Y')", "NULL", "NULL"),
}


def by_period_sql(base: str, label: str, measure: str, levels, total: bool) -> str:
    """One aggregate per level, with and without the label, stacked."""
    parts = []
    for level in levels:
        first, text, week, month = LEVELS[level]
        for name in ([f"'TOTAL GERAL'"] if total else []) + ["rotulo"]:
            parts.append(
                f"SELECT '{level}' AS granularidade, {first} AS periodo_inicio, {text} AS periodo_label, strftime(d, '%Y') AS ano, "
                f"{week} AS semana, {month} AS mes, {name} AS {label}, count(*) AS {measure} FROM base GROUP BY ALL"
            )
    return f"WITH base AS ({base}) " + " UNION ALL ".join(parts)


FOUR, THREE = ("DIARIA", "SEMANAL", "MENSAL", "ANUAL"), ("DIARIA", "SEMANAL", "MENSAL")
INFLOW_SQL = by_period_sql(
    f"SELECT {ENTRY_DAY} AS d, {CHANNEL} AS rotulo FROM tickets WHERE {REPORT} AND {ENTRY_DAY} {PERIOD_DAYS}",
    "canal_entrada", "qtde_tickets", FOUR, True,
)


@query("inflow", INFLOW_SQL, days=("periodo_inicio",))
def inflow(spark, sf):
    return reports.sort_inflow(reports.inflow(tickets(spark, sf), START, END))


@query(
    "inflow_all",
    by_period_sql(f"SELECT {ENTRY_DAY} AS d, {CHANNEL} AS rotulo FROM tickets WHERE {ENTRY} IS NOT NULL", "canal_entrada", "qtde_tickets", FOUR, True),
    days=("periodo_inicio",),
)
def inflow_all(spark, sf):
    return reports.inflow_all(tickets(spark, sf))


PRODUCTIVITY_SQL = by_period_sql(
    f"SELECT CAST(data_resolucao AS DATE) AS d, {ASSIGNEE} AS rotulo FROM tickets WHERE {REPORT} AND CAST(data_resolucao AS DATE) {PERIOD_DAYS}",
    "atribuido", "tickets_resolvidos", THREE, False,
)


@query("productivity", PRODUCTIVITY_SQL, days=("periodo_inicio",))
def productivity(spark, sf):
    return reports.sort_productivity(reports.productivity(tickets(spark, sf), START, END))


@query(
    "productivity_all",
    by_period_sql(f"SELECT CAST(data_resolucao AS DATE) AS d, {ASSIGNEE} AS rotulo FROM tickets WHERE data_resolucao IS NOT NULL", "atribuido", "tickets_resolvidos", THREE, False),
    days=("periodo_inicio",),
)
def productivity_all(spark, sf):
    return reports.productivity_all(tickets(spark, sf))


AHEAD = f"{EFFECTIVE} >= DATE '{TODAY}'"
OPEN_HEARINGS_SQL = f"""
    SELECT DATE '{START}' AS periodo_inicial, DATE '{END}' AS periodo_final, DATE '{TODAY}' AS data_referencia,
      count(DISTINCT CASE WHEN {AHEAD} OR {OPEN} THEN audiencia_id END) AS qtde_audiencias_em_aberto,
      count(DISTINCT CASE WHEN {AHEAD} THEN audiencia_id END) AS qtde_audiencias_somente_data_futura,
      count(DISTINCT CASE WHEN {OPEN} THEN audiencia_id END) AS qtde_audiencias_ticket_aberto
    FROM (SELECT audiencia_id, ticket_id, data_audiencia, data_reagendamento FROM hearings) a JOIN tickets USING (ticket_id) WHERE {REPORT}
"""


@query("open_hearings", OPEN_HEARINGS_SQL, days=("periodo_inicial", "periodo_final", "data_referencia"))
def open_hearings(spark, sf):
    return reports.open_hearings(tickets(spark, sf), hearings(spark, sf), START, END, TODAY)


@query(
    "open_hearings_view",
    f"""
    SELECT DATE '{TODAY}' AS data_referencia, count(DISTINCT audiencia_id) AS qtde_audiencias_em_aberto FROM (SELECT audiencia_id, ticket_id, data_audiencia FROM hearings) a JOIN tickets USING (ticket_id)
    WHERE CAST(data_audiencia AS DATE) >= DATE '{TODAY}' OR upper(trim(coalesce(status, ''), ' ')) NOT IN ('RESOLVIDO', 'FECHADO', 'RESOLVIDO/FECHADO')
    """,
    days=("data_referencia",),
)
def open_hearings_view(spark, sf):
    return reports.open_hearings_view(tickets(spark, sf), hearings(spark, sf), TODAY)


FUNNEL_SQL = f"""
    WITH base AS (SELECT ticket_id FROM tickets WHERE {PROCON} AND {REPORT} AND {ENTRY_DAY} {PERIOD_DAYS}),
    com AS (SELECT DISTINCT b.ticket_id FROM base b JOIN hearings h ON h.ticket_id = b.ticket_id)
    SELECT DATE '{START}' AS periodo_inicial, DATE '{END}' AS periodo_final, (SELECT count(*) FROM base) AS qtde_tickets_procon_periodo, (SELECT count(*) FROM com) AS qtde_tickets_procon_com_audiencia,
      (SELECT count(*) FROM base) - (SELECT count(*) FROM com) AS qtde_tickets_procon_sem_audiencia, round(100.0 * (SELECT count(*) FROM com) / nullif((SELECT count(*) FROM base), 0), 2) AS taxa_conversao_pct
"""


@query("funnel", FUNNEL_SQL, days=("periodo_inicial", "periodo_final"))
def funnel(spark, sf):
    return reports.funnel(tickets(spark, sf), hearings(spark, sf), START, END)


@query(
    "funnel_protocols",
    f"""
    WITH base AS (SELECT DISTINCT trim(protocolo_procon, ' ') AS p FROM tickets WHERE {PROCON}),
    com AS (SELECT DISTINCT trim(t.protocolo_procon, ' ') AS p FROM tickets t JOIN hearings h ON h.ticket_id = t.ticket_id WHERE {PROCON})
    SELECT DATE '{TODAY}' AS data_referencia, (SELECT count(*) FROM base) AS qtde_protocolos_procon_total, (SELECT count(*) FROM com) AS qtde_protocolos_procon_com_audiencia,
      (SELECT count(*) FROM base) - (SELECT count(*) FROM com) AS qtde_protocolos_procon_sem_audiencia, round(100.0 * (SELECT count(*) FROM com) / nullif((SELECT count(*) FROM base), 0), 2) AS taxa_conversao_pct
    """,
    days=("data_referencia",),
)
def funnel_protocols(spark, sf):
    return reports.funnel_protocols(tickets(spark, sf), hearings(spark, sf), TODAY)


HELD_SQL = "h AS (SELECT ticket_id, audiencia_id, audiencia, data_audiencia, data_reagendamento, preposto, local_procon, tipo_audiencia FROM hearings)"
FLAG = "CASE WHEN {} THEN 1 ELSE 0 END"


@query(
    "report_detail",
    f"""
    WITH {HELD_SQL}
    SELECT DATE '{START}' AS periodo_inicial_param, DATE '{END}' AS periodo_final_param, DATE '{TODAY}' AS data_referencia_execucao, {', '.join('t.' + c for c in reports.DETAIL_TICKET)},
      upper(trim(coalesce(status, ''), ' ')) AS status_normalizado, coalesce(flag_arquivado_relatorio, 0) AS flag_arquivado_relatorio, {', '.join('h.' + c for c in reports.DETAIL_HEARING)},
      {EFFECTIVE} AS data_audiencia_efetiva, {ENTRY_DAY} AS data_entrada_base,
      {FLAG.format(f"{ENTRY_DAY} {PERIOD_DAYS}")} AS flag_periodo_entrada, {FLAG.format(f"CAST(data_resolucao AS DATE) {PERIOD_DAYS}")} AS flag_periodo_resolucao,
      {FLAG.format(PROCON)} AS flag_procon, {FLAG.format(FORM)} AS flag_formulario_solicitacao, {FLAG.format('audiencia_id IS NOT NULL')} AS flag_tem_audiencia,
      {FLAG.format(AHEAD)} AS flag_audiencia_futura_ou_hoje, {FLAG.format(OPEN)} AS flag_ticket_aberto,
      {FLAG.format(f"audiencia_id IS NOT NULL AND ({AHEAD} OR {OPEN})")} AS flag_audiencia_em_aberto_regra_atual,
      {FLAG.format(f"audiencia_id IS NOT NULL AND {AHEAD}")} AS flag_audiencia_em_aberto_data_futura, {FLAG.format(REPORT)} AS flag_elegivel_relatorio
    FROM tickets t LEFT JOIN h ON h.ticket_id = t.ticket_id
    """,
    days=("periodo_inicial_param", "periodo_final_param", "data_referencia_execucao", "data_audiencia_efetiva", "data_entrada_base"),
    stamps=("data_criacao", "data_resolucao", "data_entrada_reclamacao", "data_criacao_solicitacao", "data_criacao_notificacao", "data_audiencia", "data_reagendamento"),
)
def report_detail(spark, sf):
    return reports.report_detail(tickets(spark, sf), hearings(spark, sf), START, END, TODAY)


@query(
    "headline_kpis",
    f"""
    WITH a AS ({OPEN_HEARINGS_SQL}), base AS (SELECT ticket_id FROM tickets WHERE {PROCON} AND {REPORT} AND {ENTRY_DAY} {PERIOD_DAYS}),
    com AS (SELECT DISTINCT b.ticket_id FROM base b JOIN hearings h ON h.ticket_id = b.ticket_id),
    r AS (SELECT {ASSIGNEE} AS a FROM tickets WHERE {REPORT} AND CAST(data_resolucao AS DATE) {PERIOD_DAYS})
    SELECT a.qtde_audiencias_em_aberto AS audiencias_em_aberto, a.qtde_audiencias_somente_data_futura AS audiencias_data_futura,
      (SELECT count(*) FROM base) AS procon_total, (SELECT count(*) FROM com) AS procon_com_audiencia, round(100.0 * (SELECT count(*) FROM com) / (SELECT count(*) FROM base), 2) AS procon_taxa_pct,
      (SELECT count(*) FROM tickets WHERE {REPORT} AND {ENTRY_DAY} {PERIOD_DAYS}) AS tickets_entrada, (SELECT count(*) FROM r) AS tickets_resolvidos, (SELECT count(DISTINCT a) FROM r) AS colaboradores_ativos,
      (SELECT count(*) FROM tickets t LEFT JOIN hearings h ON h.ticket_id = t.ticket_id) AS linhas_detalhe FROM a
    """,
)
def headline_kpis(spark, sf):
    return reports.headline_kpis(tickets(spark, sf), hearings(spark, sf), START, END, TODAY)


@query(
    "append_total",
    f"""
    WITH g AS (SELECT {ASSIGNEE} AS atribuido, count(*) AS qtde_tickets, CAST(max(flag_arquivado_relatorio) AS VARCHAR) AS flag_algum FROM tickets GROUP BY 1)
    SELECT * FROM g UNION ALL SELECT 'TOTAL', CAST(sum(qtde_tickets) AS BIGINT), '' FROM g
    """,
)
def append_total(spark, sf):
    grouped = tickets(spark, sf).groupBy(reports.label_or(F.col("atribuido"), "NAO ATRIBUIDO").alias("atribuido")).agg(
        F.count(F.lit(1)).alias("qtde_tickets"), F.max("flag_arquivado_relatorio").alias("flag_algum")
    )
    return reports.append_total(grouped)


# ---- daily: Tuesday after a Monday holiday --------------------------------------------------------------
DAY, FRIDAY, IDLE = "DATE '1998-04-17'", "DATE '1998-04-24'", "BETWEEN DATE '1998-04-18' AND DATE '1998-04-19'"
IN_WEEK = f"{EFFECTIVE} BETWEEN DATE '{TODAY}' AND {FRIDAY}"
DAILY_SQL = f"""
    {HELD_SQL}, base AS (
      SELECT t.ticket_id, t.data_criacao, t.data_resolucao, {ASSIGNEE} AS atribuido, {CHANNEL} AS tipo_solicitacao, status, titulo AS titulo_ticket, assunto, matricula, numero_os, resultado_tratativa, nome_solicitante, email_solicitante,
        {FLAG.format('audiencia_id IS NOT NULL')} AS tem_audiencia, data_audiencia, data_reagendamento, {EFFECTIVE} AS data_audiencia_efetiva, preposto, local_procon,
        {FLAG.format(f'CAST(t.data_criacao AS DATE) = {DAY}')} AS entrou, {FLAG.format(f'CAST(t.data_resolucao AS DATE) = {DAY}')} AS resolveu,
        {FLAG.format(f'audiencia_id IS NOT NULL AND {IN_WEEK} AND NOT ({DONE})')} AS semana_aberta, {FLAG.format(f'audiencia_id IS NOT NULL AND {IN_WEEK} AND {DONE}')} AS semana_encerrada
      FROM tickets t LEFT JOIN h ON h.ticket_id = t.ticket_id
      WHERE {DAILY} AND (CAST(t.data_criacao AS DATE) = {DAY} OR CAST(t.data_resolucao AS DATE) = {DAY} OR (audiencia_id IS NOT NULL AND {IN_WEEK})))
"""


def _daily(spark, sf):
    window = report_window(spark, TODAY)
    return daily.daily_base(tickets(spark, sf), hearings(spark, sf), window), window


@query(
    "daily_base",
    f"WITH {DAILY_SQL} SELECT ticket_id, data_criacao, data_resolucao, atribuido, tipo_solicitacao, tem_audiencia, data_audiencia_efetiva, entrou AS flag_entrada_dia_util_anterior, resolveu AS flag_resolvido_dia_util_anterior, "
    "CASE WHEN entrou = 1 AND tem_audiencia = 1 THEN 1 ELSE 0 END AS flag_entrada_audiencia_dia_util_anterior, semana_aberta AS flag_audiencia_semana_aberta, semana_encerrada AS flag_audiencia_semana_encerrada FROM base",
    days=("data_audiencia_efetiva",), stamps=("data_criacao", "data_resolucao"),
)
def daily_base(spark, sf):
    return _daily(spark, sf)[0].select(
        "ticket_id", "data_criacao", "data_resolucao", "atribuido", "tipo_solicitacao", "tem_audiencia",
        "data_audiencia_efetiva", "flag_entrada_dia_util_anterior", "flag_resolvido_dia_util_anterior",
        "flag_entrada_audiencia_dia_util_anterior", "flag_audiencia_semana_aberta", "flag_audiencia_semana_encerrada",
    )


@query(
    "daily_totals",
    f"WITH {DAILY_SQL} SELECT {DAY} AS data_referencia, count(DISTINCT CASE WHEN entrou = 1 THEN ticket_id END) AS qtde_tickets, count(DISTINCT CASE WHEN resolveu = 1 THEN ticket_id END) AS qtde_tickets_resolvidos, "
    "count(DISTINCT CASE WHEN entrou = 1 AND tem_audiencia = 1 THEN ticket_id END) AS qtde_tickets_com_audiencia FROM base",
    days=("data_referencia",),
)
def daily_totals(spark, sf):
    base, window = _daily(spark, sf)
    return daily.daily_totals(base, window["business_day"])


@query(
    "daily_entry_channel",
    f"WITH {DAILY_SQL} SELECT {short('tipo_solicitacao')} AS tipo_solicitacao, n AS qtde_tickets FROM (SELECT tipo_solicitacao, count(DISTINCT ticket_id) AS n FROM base WHERE entrou = 1 GROUP BY 1)",
)
def daily_entry_channel(spark, sf):
    return daily.daily_entry_channel(_daily(spark, sf)[0])


@query("daily_resolved_assignee", f"WITH {DAILY_SQL} SELECT atribuido, count(DISTINCT ticket_id) AS qtde_tickets_resolvidos FROM base WHERE resolveu = 1 GROUP BY 1")
def daily_resolved_assignee(spark, sf):
    return daily.daily_resolved_assignee(_daily(spark, sf)[0])


def hearings_sql(state: str) -> str:
    return (
        f"WITH {DAILY_SQL} SELECT DATE '{TODAY}' AS data_inicio_janela, {FRIDAY} AS data_fim_janela, data_audiencia_efetiva, local_procon, preposto, atribuido, "
        f"count(DISTINCT ticket_id) AS qtde_audiencias FROM base WHERE semana_{state} = 1 GROUP BY ALL"
    )


HEARING_DAYS = ("data_inicio_janela", "data_fim_janela", "data_audiencia_efetiva")


@query("daily_hearings_open", hearings_sql("aberta"), days=HEARING_DAYS)
def daily_hearings_open(spark, sf):
    return daily.daily_hearings(*_daily(spark, sf), "aberta")


@query("daily_hearings_closed", hearings_sql("encerrada"), days=HEARING_DAYS)
def daily_hearings_closed(spark, sf):
    return daily.daily_hearings(*_daily(spark, sf), "encerrada")


OVERDUE = f"tem_audiencia = 1 AND data_audiencia_efetiva < DATE '{TODAY}' AND NOT ({DONE})"


@query(
    "overdue_hearings",
    f"WITH {DAILY_SQL} SELECT {', '.join(daily.OVERDUE_COLUMNS)} FROM base WHERE {OVERDUE}",
    days=("data_audiencia_efetiva",), stamps=("data_criacao", "data_resolucao", "data_audiencia", "data_reagendamento"),
)
def overdue_hearings(spark, sf):
    return daily.overdue_hearings(_daily(spark, sf)[0], TODAY)


@query(
    "overdue_hearings_all",
    f"WITH {HELD_SQL} SELECT ticket_id, {EFFECTIVE} AS data_audiencia_efetiva, status, preposto FROM (SELECT t.*, h.* EXCLUDE (ticket_id) FROM tickets t JOIN h ON h.ticket_id = t.ticket_id) WHERE {DAILY} AND {EFFECTIVE} < DATE '{TODAY}' AND NOT ({DONE})",
    days=("data_audiencia_efetiva",),
)
def overdue_hearings_all(spark, sf):
    base = daily.hearing_base(tickets(spark, sf), hearings(spark, sf), report_window(spark, TODAY))
    return daily.overdue_hearings(base, TODAY).select("ticket_id", "data_audiencia_efetiva", "status", "preposto")


@query(
    "exception_movements",
    f"SELECT CAST(data_criacao AS DATE) AS data_entrada, CAST(data_resolucao AS DATE) AS data_resolucao, {ASSIGNEE} AS atribuido, {short(CHANNEL)} AS canal FROM tickets WHERE {DAILY} AND (CAST(data_criacao AS DATE) {IDLE} OR CAST(data_resolucao AS DATE) {IDLE})",
    days=("data_entrada", "data_resolucao"),
)
def exception_movements(spark, sf):
    return daily.exception_movements(tickets(spark, sf), report_window(spark, TODAY))


# ---- weekly -----------------------------------------------------------------------------------------------
WEEK_DAYS = "BETWEEN DATE '1998-04-13' AND DATE '1998-04-17'"
RESOLVED_DAY = "CAST(data_resolucao AS DATE)"
WEEKLY_WHERE = f"{DAILY} AND {RESOLVED_DAY} {WEEK_DAYS}"


def _weekly(spark, sf):
    return weekly.weekly_base(tickets(spark, sf), TODAY)


@query(
    "weekly_base",
    f"SELECT ticket_id, {RESOLVED_DAY} AS data_resolucao, {ASSIGNEE} AS atribuido, {short(CHANNEL)} AS canal_normalizado, {short('assunto')} AS assunto_normalizado, CAST(isodow({RESOLVED_DAY}) - 1 AS INTEGER) AS dia_semana_numero FROM tickets WHERE {WEEKLY_WHERE}",
    days=("data_resolucao",),
)
def weekly_base(spark, sf):
    return _weekly(spark, sf).select(
        "ticket_id", "data_resolucao", "atribuido", "canal_normalizado", "assunto_normalizado", "dia_semana_numero"
    )


@query("weekly_total", f"SELECT DATE '1998-04-13' AS data_referencia_semana, count(DISTINCT ticket_id) AS qtde_tickets_resolvidos FROM tickets WHERE {WEEKLY_WHERE}", days=("data_referencia_semana",))
def weekly_total(spark, sf):
    return weekly.weekly_total(_weekly(spark, sf), TODAY)


@query(
    "weekly_by_day",
    f"""
    WITH c AS (SELECT {RESOLVED_DAY} AS d, count(DISTINCT ticket_id) AS n FROM tickets WHERE {WEEKLY_WHERE} GROUP BY 1)
    SELECT DATE '1998-04-13' AS data_referencia_semana, s.d AS data_resolucao, nome AS dia_semana, coalesce(n, 0) AS qtde_tickets_resolvidos
    FROM (VALUES (DATE '1998-04-13', 'Segunda-feira'), (DATE '1998-04-14', 'Terça-feira'), (DATE '1998-04-15', 'Quarta-feira'), (DATE '1998-04-16', 'Quinta-feira'), (DATE '1998-04-17', 'Sexta-feira')) s(d, nome) LEFT JOIN c ON c.d = s.d
    """,
    days=("data_referencia_semana", "data_resolucao"),
)
def weekly_by_day(spark, sf):
    return weekly.weekly_by_day(_weekly(spark, sf), TODAY)


@query("weekly_by_assignee", f"SELECT {ASSIGNEE} AS atribuido, count(DISTINCT ticket_id) AS qtde_tickets_resolvidos FROM tickets WHERE {WEEKLY_WHERE} GROUP BY 1")
def weekly_by_assignee(spark, sf):
    return weekly.weekly_by_assignee(_weekly(spark, sf))


@query("weekly_by_channel", f"SELECT {short(CHANNEL)} AS canal_normalizado, count(DISTINCT ticket_id) AS qtde_tickets_resolvidos FROM tickets WHERE {WEEKLY_WHERE} GROUP BY 1")
def weekly_by_channel(spark, sf):
    return weekly.weekly_by_channel(_weekly(spark, sf))


SERVICE_WEEK = f"{SERVICE} AND {RESOLVED_DAY} {WEEK_DAYS}"


@query(
    "service_weekly",
    f"""
    SELECT 'total' AS grupo, 'total' AS rotulo, count(DISTINCT ticket_id) AS tickets_resolvidos FROM tickets WHERE {SERVICE_WEEK}
    UNION ALL SELECT 'by_collaborator', {ASSIGNEE}, count(DISTINCT ticket_id) FROM tickets WHERE {SERVICE_WEEK} GROUP BY 2
    UNION ALL SELECT 'by_day', CAST({RESOLVED_DAY} AS VARCHAR), count(DISTINCT ticket_id) FROM tickets WHERE {SERVICE_WEEK} GROUP BY 2
    UNION ALL SELECT 'by_channel', {short(CHANNEL)}, count(DISTINCT ticket_id) FROM tickets WHERE {SERVICE_WEEK} GROUP BY 2
    """,
)
def service_weekly(spark, sf):
    parts = weekly.service_weekly(tickets(spark, sf), TODAY)
    rows = []
    for name, df in parts.items():
        label = F.lit("total") if name == "total" else F.col(df.columns[0]).cast("string")
        rows.append(df.select(F.lit(name).alias("grupo"), label.alias("rotulo"), "tickets_resolvidos"))
    return rows[0].unionByName(rows[1]).unionByName(rows[2]).unionByName(rows[3])


@query("channel_volume", f"SELECT {short(CHANNEL)} AS canal, count(DISTINCT ticket_id) AS qtde_tickets FROM tickets WHERE {SERVICE} AND {ENTRY_DAY} {PERIOD_DAYS} GROUP BY 1")
def channel_volume(spark, sf):
    return weekly.service_channel_volume(tickets(spark, sf), START, END)


# ---- marts ------------------------------------------------------------------------------------------------
@query(
    "processed_listing",
    f"""
    WITH m AS (SELECT * FROM tickets WHERE {SERVICE} AND {ENTRY_DAY} {PERIOD_DAYS})
    SELECT ticket_id, CAST(data_criacao AS DATE) AS data_criacao, CAST(data_resolucao AS DATE) AS data_resolucao, status, {ASSIGNEE} AS atribuido, {short(CHANNEL)} AS canal_normalizado,
      tipo_manifestacao, classificacao_solicitacoes, formulario_ticket, (SELECT count(DISTINCT ticket_id) FROM m) AS total FROM m
    """,
    days=("data_criacao", "data_resolucao"),
)
def processed_listing(spark, sf):
    return marts.processed_tickets_listing(tickets(spark, sf), "data_entrada", START, END, None)


def ws(c: str) -> str:
    return f"nullif(trim(regexp_replace(replace({c}, chr(160), ' '), '[\\t-\\r\\x1c-\\x20]+', ' ', 'g')), '')"


FROM_HEARING = ("local_procon", "audiencia", "tipo_audiencia", "data_audiencia", "preposto", "data_reagendamento")


def sanitized_cell(c: str) -> str:
    side = "h" if c in FROM_HEARING else "t"
    if c.startswith("data_"):
        return f"CAST({side}.{c} AS DATE) AS {c}"
    if c == "ticket_id":
        return "t.ticket_id"
    if c == "assunto":
        return f"upper({ws('string_split(' + ws('t.assunto') + chr(44) + chr(39) + '::' + chr(39) + ')[-1]')}) AS assunto"
    if c == "protocolo_referencia":
        parts = [
            "nullif(trim(" + n + "), '')"
            for n in ("t.protocolo_referencia_informado", "c.protocolo_agenersa", "t.protocolo_procon", "t.protocolo_defensoria", "t.protocolo_codecon", "t.case_jec")
        ]
        return f"{ws('coalesce(' + ', '.join(parts) + ')')} AS {c}"
    return f"{ws(side + '.' + c)} AS {c}"


@query(
    "sanitized_base",
    "WITH cs AS (SELECT case_id, max(CASE WHEN ticket_id % 19 = 0 THEN case_id END) AS protocolo_agenersa FROM tickets GROUP BY case_id) SELECT "
    + ", ".join(sanitized_cell(c) for c in marts.SANITIZED_COLUMNS)
    + f" FROM (SELECT * FROM tickets WHERE {SANITIZED}) t LEFT JOIN hearings h ON h.ticket_id = t.ticket_id LEFT JOIN cs c ON c.case_id = t.case_id",
    days=("data_criacao", "data_resolucao", "data_audiencia", "data_reagendamento"),
)
def sanitized_base(spark, sf):
    t = tickets(spark, sf)
    t = t.withColumn("protocolo_agenersa", F.when(F.col("ticket_id") % 19 == 0, F.col("case_id")))
    requests, notices = t.filter("ticket_id % 2 = 0"), t.filter("ticket_id % 2 = 1")
    return marts.sanitized_base(requests, notices, hearings(spark, sf), dedup.distinct_cases(requests, notices))


@query(
    "ai_ready",
    "SELECT ticket_id, case_id, matricula, bloco, data_criacao, data_resolucao, status, atribuido, "
    + ", ".join(f"coalesce({ws(source)}, '') AS {name}" for name, source in marts.AI_TEXT.items())
    + f", coalesce(flag_auditoria_classificacao, 0) AS flag_auditoria_classificacao FROM tickets WHERE coalesce(flag_ativo, 1) = 1 AND {ACTIVE}",
    stamps=("data_criacao", "data_resolucao"),
)
def ai_ready(spark, sf):
    return marts.ai_ready(tickets(spark, sf))


FACT_WHERE = f"coalesce(flag_ativo, 1) = 1 AND {ACTIVE}"


@query(
    "fact_tickets",
    f"SELECT {', '.join(marts.FACT_COLUMNS)} FROM tickets WHERE {FACT_WHERE}",
    stamps=[c for c in marts.FACT_COLUMNS if TICKETS[c] == "timestamp_ntz"],
)
def fact_tickets(spark, sf):
    return marts.fact_tickets(tickets(spark, sf))


@query("active_tickets", "SELECT ticket_id, status, flag_ativo FROM tickets WHERE coalesce(flag_ativo, 1) = 1")
def active_tickets(spark, sf):
    return marts.active_tickets(tickets(spark, sf)).select("ticket_id", "status", "flag_ativo")


@query(
    "fact_hearings",
    f"SELECT {', '.join('a.' + c for c in marts.HEARING_FACT_COLUMNS)} FROM hearings a LEFT JOIN (SELECT * FROM tickets WHERE coalesce(flag_ativo, 1) = 1) t ON t.ticket_id = a.ticket_id WHERE t.ticket_id IS NULL OR coalesce(t.flag_arquivado_relatorio, 0) = 0",
    stamps=("data_audiencia", "data_reagendamento"),
)
def fact_hearings(spark, sf):
    return marts.fact_hearings(tickets(spark, sf), hearings(spark, sf))


def named(index: str, names) -> str:
    return "[" + ", ".join(f"'{n}'" for n in names) + f"][{index}]"


@query(
    "dim_time",
    f"""
    WITH d AS (SELECT CAST(data_criacao AS DATE) AS d FROM tickets UNION SELECT CAST(data_resolucao AS DATE) FROM tickets UNION SELECT CAST(data_audiencia AS DATE) FROM hearings UNION SELECT CAST(data_reagendamento AS DATE) FROM hearings)
    SELECT strftime(d, '%Y%m%d') AS data_key, d AS data_calendario, CAST(year(d) AS INTEGER) AS ano, CAST(month(d) AS INTEGER) AS mes, CAST(day(d) AS INTEGER) AS dia, strftime(d, '%Y-%m') AS ano_mes, CAST(quarter(d) AS INTEGER) AS trimestre,
      {named('month(d)', MONTH_NAMES)} AS nome_mes, CAST(dayofweek(d) AS INTEGER) AS dia_semana_num FROM d WHERE d IS NOT NULL
    """,
    days=("data_calendario",),
)
def dim_time(spark, sf):
    return marts.dim_time(tickets(spark, sf), hearings(spark, sf))


def _dim_sql(column: str, key: str, label: str, default: str) -> str:
    return f"SELECT DISTINCT coalesce({column}, '{default}') AS {key}, coalesce({column}, '{default}') AS {label} FROM tickets WHERE {FACT_WHERE}"


@query("dim_channel", _dim_sql("tipo_solicitacao", "canal_key", "canal", "NAO_INFORMADO"))
def dim_channel(spark, sf):
    return marts.dim_channel(marts.fact_tickets(tickets(spark, sf)))


@query("dim_status", _dim_sql("status", "status_key", "status", "NAO_INFORMADO"))
def dim_status(spark, sf):
    return marts.dim_status(marts.fact_tickets(tickets(spark, sf)))


@query("dim_assignee", _dim_sql("atribuido", "atribuido_key", "atribuido", "NAO_ATRIBUIDO"))
def dim_assignee(spark, sf):
    return marts.dim_assignee(marts.fact_tickets(tickets(spark, sf)))


@query("dim_subject", f"WITH {SUBJECTS_SQL} SELECT DISTINCT assunto_normalizado AS assunto_key, assunto_normalizado FROM o")
def dim_subject(spark, sf):
    return marts.dim_subject(dedup.ticket_subjects(view(spark, sf, "subject_feed"), SUBJECT_TIES))


# ---- BI ---------------------------------------------------------------------------------------------------
BI_FACT_SQL = f"""
    {HELD_SQL}, fact AS (SELECT t.* REPLACE (CAST(t.data_criacao AS DATE) AS data_criacao, CAST(t.data_resolucao AS DATE) AS data_resolucao), CAST({ENTRY} AS DATE) AS data_entrada, CAST(h.data_audiencia AS DATE) AS data_audiencia,
        CAST(h.data_reagendamento AS DATE) AS data_reagendamento, h.audiencia, h.preposto, h.local_procon, h.tipo_audiencia, h.ticket_id AS tem
      FROM (SELECT * FROM tickets WHERE {BI}) t LEFT JOIN h ON h.ticket_id = t.ticket_id)
"""
CLOSED = "upper(coalesce(status, '')) IN ('SOLVED', 'CLOSED', 'RESOLVIDO', 'FECHADO')"


def _fact(spark, sf):
    return bi.bi_fact_tickets(tickets(spark, sf), hearings(spark, sf))


def _fact_hearings(spark, sf):
    return bi.bi_fact_hearings(tickets(spark, sf), hearings(spark, sf))


@query(
    "bi_fact_tickets",
    f"WITH {BI_FACT_SQL} SELECT ticket_id, case_id, matricula, numero_os, data_entrada, data_criacao, data_resolucao, {', '.join(bi.FACT_TICKET)}, data_audiencia, data_reagendamento, {', '.join(bi.FACT_HEARING)} FROM fact",
    days=("data_entrada", "data_criacao", "data_resolucao", "data_audiencia", "data_reagendamento"), stamps=("data_criacao_notificacao",),
)
def bi_fact_tickets(spark, sf):
    return _fact(spark, sf)


@query(
    "bi_fact_hearings",
    f"WITH {BI_FACT_SQL} SELECT ticket_id, data_entrada, data_criacao, data_resolucao, data_audiencia, data_reagendamento, {', '.join(bi.HEARING_FACT_TICKET)}, {', '.join(bi.FACT_HEARING)} FROM fact WHERE tem IS NOT NULL",
    days=("data_entrada", "data_criacao", "data_resolucao", "data_audiencia", "data_reagendamento"),
)
def bi_fact_hearings(spark, sf):
    return _fact_hearings(spark, sf)


@query(
    "bi_counts",
    f"WITH {BI_FACT_SQL} SELECT count(*) AS tickets_total, count(*) AS tickets_entradas, count(data_resolucao) AS tickets_resolvidos, count_if(NOT ({CLOSED})) AS tickets_abertos, count_if({CLOSED}) AS tickets_fechados, "
    f"round(count_if({CLOSED}) / count(*), 6) AS pct_resolvidos, round(count_if(NOT ({CLOSED})) / count(*), 6) AS pct_em_tratamento FROM fact",
)
def bi_counts(spark, sf):
    return bi.bi_counts(_fact(spark, sf)).withColumns(
        {c: F.round(F.col(c), 6) for c in ("pct_resolvidos", "pct_em_tratamento")}
    )


@query("bi_resolution_time", f"WITH {BI_FACT_SQL} SELECT round(avg(data_resolucao - data_entrada), 4) AS tempo_medio_dias, round(avg((data_resolucao - data_entrada) * 24), 4) AS tempo_medio_horas FROM fact")
def bi_resolution_time(spark, sf):
    return bi.bi_resolution_time(_fact(spark, sf)).select(
        *[F.round(F.col(c), 4).alias(c) for c in ("tempo_medio_dias", "tempo_medio_horas")]
    )


BI_DIMS = ("atribuido", "tipo_solicitacao", "municipio", "bairro")


@query(
    "bi_by_dim",
    f"WITH {BI_FACT_SQL} " + " UNION ALL ".join(f"SELECT '{d}' AS dimensao, {d} AS rotulo, count(*) AS tickets_total, count(data_resolucao) AS tickets_resolvidos FROM fact GROUP BY 2" for d in BI_DIMS),
)
def bi_by_dim(spark, sf):
    fact = _fact(spark, sf)
    parts = [
        bi.bi_by_dim(fact, d).select(F.lit(d).alias("dimensao"), F.col(d).alias("rotulo"), "tickets_total", "tickets_resolvidos")
        for d in BI_DIMS
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query(
    "bi_hearings",
    f"WITH {BI_FACT_SQL} SELECT count(*) AS audiencias_total, count_if(data_audiencia >= DATE '{TODAY}' OR NOT ({CLOSED})) AS audiencias_pendentes, count_if(data_audiencia < DATE '{TODAY}' AND NOT ({CLOSED})) AS audiencias_vencidas, count_if({CLOSED}) AS audiencias_encerradas FROM fact WHERE tem IS NOT NULL",
)
def bi_hearings(spark, sf):
    return bi.bi_hearings(_fact_hearings(spark, sf), TODAY)


CALENDAR_SQL = """
    lim AS (SELECT min(d) AS a, max(d) AS b FROM (SELECT data_entrada AS d FROM fact UNION ALL SELECT data_resolucao FROM fact UNION ALL SELECT data_audiencia FROM fact)),
    cal AS (SELECT CAST(unnest(generate_series(make_date(year(a), 1, 1), make_date(year(b), 12, 31), INTERVAL 1 DAY)) AS DATE) AS d FROM lim)
"""


@query(
    "dim_calendar",
    f"""
    WITH {BI_FACT_SQL}, {CALENDAR_SQL}
    SELECT d AS data, CAST(year(d) AS INTEGER) AS ano, CAST(month(d) AS INTEGER) AS mes_numero, {named('month(d)', CALENDAR_MONTH_NAMES)} AS mes, strftime(d, '%Y-%m') AS ano_mes, 'T' || CAST(quarter(d) AS VARCHAR) AS trimestre,
      CAST(d - CAST(isodow(d) - 1 AS INTEGER) AS VARCHAR) AS semana_ano, CAST(day(d) AS INTEGER) AS dia, CAST(isodow(d) AS INTEGER) AS dia_semana_numero, {named('isodow(d)', WEEKDAY_NAMES)} AS dia_semana, CASE WHEN isodow(d) >= 6 THEN 1 ELSE 0 END AS fim_de_semana FROM cal
    """,
    days=("data",),
)
def dim_calendar(spark, sf):
    return bi.dim_calendar(_fact(spark, sf), _fact_hearings(spark, sf), TODAY)


@query(
    "mtd_ytd",
    f"""
    WITH {BI_FACT_SQL}, {CALENDAR_SQL}, n AS (SELECT d, count(data_resolucao) AS n FROM cal LEFT JOIN fact ON data_entrada = d GROUP BY d)
    SELECT d AS data, CAST(sum(n) OVER (PARTITION BY year(d), month(d) ORDER BY d) AS BIGINT) AS resolvidos_mtd, CAST(sum(n) OVER (PARTITION BY year(d) ORDER BY d) AS BIGINT) AS resolvidos_ytd FROM n
    """,
    days=("data",),
)
def mtd_ytd(spark, sf):
    fact = _fact(spark, sf)
    return bi.mtd_ytd(fact, bi.dim_calendar(fact, _fact_hearings(spark, sf), TODAY))


def _rank_sql(dim: str, measure: str) -> str:
    return f"SELECT '{dim}' AS dimensao, {dim} AS rotulo, {measure} AS tickets, CAST(dense_rank() OVER (ORDER BY {measure} DESC) AS INTEGER) AS posicao FROM fact GROUP BY {dim}"


@query(
    "dense_ranks",
    f"WITH {BI_FACT_SQL} {_rank_sql('tipo_solicitacao', 'count(*)')} UNION ALL {_rank_sql('assunto', 'count(*)')} UNION ALL {_rank_sql('atribuido', 'count(data_resolucao)')}",
)
def dense_ranks(spark, sf):
    fact = _fact(spark, sf)
    shape = lambda df, d: df.select(F.lit(d).alias("dimensao"), F.col(d).alias("rotulo"), "tickets", "posicao")
    return (
        shape(bi.dense_ranks(fact, "tipo_solicitacao"), "tipo_solicitacao")
        .unionByName(shape(bi.dense_ranks(fact, "assunto"), "assunto"))
        .unionByName(shape(bi.dense_ranks(fact, "atribuido", resolved_only=True), "atribuido"))
    )


@query("bi_dims_channel", f"WITH {BI_FACT_SQL} SELECT DISTINCT tipo_solicitacao AS canal_original, trim(string_split(trim(tipo_solicitacao), '::')[-1]) AS canal_normalizado FROM fact")
def bi_dims_channel(spark, sf):
    return bi.dim_channel_bi(_fact(spark, sf))


@query("bi_dims_subject", f"WITH {BI_FACT_SQL} SELECT DISTINCT assunto AS assunto_original, trim(string_split(trim(assunto), '::')[-1]) AS assunto_normalizado FROM fact")
def bi_dims_subject(spark, sf):
    return bi.dim_subject_bi(_fact(spark, sf))


@query("bi_dims_assignee", f"WITH {BI_FACT_SQL} SELECT DISTINCT atribuido AS colaborador FROM fact")
def bi_dims_assignee(spark, sf):
    return bi.dim_assignee_bi(_fact(spark, sf))


@query("bi_dims_location", f"WITH {BI_FACT_SQL} SELECT DISTINCT municipio, bairro, bloco FROM fact")
def bi_dims_location(spark, sf):
    return bi.dim_location_bi(_fact(spark, sf))


@query(
    "protocol_funnel",
    f"""
    SELECT count(*) AS tickets_ativos, count(data_resolucao) AS tickets_resolvidos, round(CAST(count(data_resolucao) AS DOUBLE) / count(*), 4) AS taxa_resolucao, count(nullif(trim(protocolo_procon), '')) AS com_procon,
      count(nullif(trim(protocolo_defensoria), '')) AS com_defensoria, count(nullif(trim(protocolo_codecon), '')) AS com_codecon, count(nullif(trim(case_jec), '')) AS com_jec FROM tickets WHERE {ACTIVE}
    """,
)
def protocol_funnel(spark, sf):
    return bi.protocol_funnel(tickets(spark, sf))


@query(
    "by_territory",
    "SELECT 'bloco' AS nivel, bloco, CAST(NULL AS VARCHAR) AS municipio, count(*) AS qtde_tickets FROM tickets GROUP BY bloco UNION ALL SELECT 'municipio', bloco, municipio, count(*) FROM tickets GROUP BY bloco, municipio",
)
def by_territory(spark, sf):
    return bi.by_territory(tickets(spark, sf))
