"""The given tables in the shape of ticket feeds and stored ticket tables.

Each view is one SQL text that both Spark and the check database can run, so a query and its check start
from the same rows. Nothing is sampled: every row of the given tables takes part.
"""

from __future__ import annotations

import re
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)
START, END, TODAY = date(1997, 1, 1), date(1998, 12, 31), date(1998, 4, 20)
AT = datetime(1998, 4, 20, 6, 30, 0)

VIEWS = {
    # Requests and notices in the shape of the stored ticket table.
    "tickets": """
        SELECT
          k AS ticket_id,
          CASE WHEN k % 19 = 0 THEN lpad(CAST(k AS STRING), 10, '7') ELSE CAST(k AS STRING) END AS case_id,
          conta AS matricula,
          CASE WHEN k % 13 = 0 THEN 'Bloco X' WHEN conta LIKE '40%' THEN 'Bloco 4' WHEN conta LIKE '10%' THEN 'Bloco 1' END AS bloco,
          CASE WHEN k % 6 = 0 THEN CAST(k AS STRING) || '-' || CAST(1 + k % 7 AS STRING) END AS numero_os,
          CASE WHEN k % 6 = 0 THEN CAST(k AS STRING) || '-' || CAST(1 + k % 7 AS STRING) END AS numero_os_original,
          CASE WHEN k % 12 = 0 THEN CAST(k AS STRING) || '-1' END AS numero_os_gss,
          CASE WHEN k % 4 = 0 THEN 'G' || CAST(k AS STRING) END AS gss_os_id,
          CASE WHEN k % 6 = 0 THEN 'ZENDESK' END AS origem_numero_os,
          CASE WHEN k % 6 = 0 THEN 'ZENDESK_ORIGINAL' ELSE 'SEM_MATCH' END AS status_vinculo_os,
          CASE WHEN k % 6 = 0 THEN CAST(1 AS DOUBLE) END AS score_vinculo_os,
          CAST(NULL AS STRING) AS criterio_vinculo_os,
          o_orderdate AS data_criacao,
          CASE WHEN o_orderstatus = 'F' THEN CAST(dia + CAST(k % 40 AS INT) AS {ts}) END AS data_resolucao,
          CASE WHEN k % 13 = 0 THEN ' Closed ' WHEN o_orderstatus = 'F' THEN 'SOLVED' WHEN o_orderstatus = 'O' THEN 'OPEN' ELSE 'PENDING' END AS status,
          CASE WHEN k % 11 = 0 THEN '  ' ELSE 'NATION_' || CAST(c % 25 AS STRING) END AS atribuido,
          CASE k % 7
            WHEN 0 THEN 'Reclamação ' || lpad(CAST(k AS STRING), 10, '0')
            WHEN 1 THEN 'Proc. ' || procon || ' (análise)'
            WHEN 2 THEN 'Ofício V' || lpad(CAST(k % 100000 AS STRING), 5, '0') || '/2024'
            WHEN 3 THEN 'Codecon ' || lpad(CAST(k % 1000000 AS STRING), 6, '0') || '/2023'
            ELSE segmento || ' - atenção' END AS titulo,
          CASE k % 4 WHEN 0 THEN 'Serviços::' || segmento WHEN 1 THEN segmento WHEN 3 THEN 'Cobrança - ' || segmento || ' 2024/02!' END AS assunto,
          'chat' AS tipo_conversa,
          canal AS tipo_solicitacao,
          CASE WHEN k % 23 = 0 THEN ' Anexo ' WHEN k % 43 = 0 THEN chr(160) || 'anexo' || chr(160) ELSE 'MANIFESTACAO' END AS tipo_manifestacao,
          CASE WHEN k % 3 = 0 THEN 'PROCEDENTE' END AS resultado_tratativa,
          'tag_' || CAST(k % 5 AS STRING) AS tags_ticket,
          grupo AS grupo_tickets,
          'ADR ' || CAST(c % 4 AS STRING) AS superintendencia_adr,
          CASE WHEN k % 2 = 0 THEN 'web' ELSE 'email' END AS canal_origem,
          CASE WHEN k % 15 = 0 THEN NULL ELSE lpad(CAST(c AS STRING), 11, '0') END AS cpf_cliente,
          CASE WHEN k % 2 = 0 THEN 'sim' END AS passou_nivel_1,
          CASE WHEN k % 2 = 0 THEN 'CEDOC' END AS canais_de_atrito,
          CASE WHEN k % 47 = 0 THEN ' REF' || CAST(k AS STRING) || ' ' WHEN k % 5 = 0 THEN ' ' END AS protocolo_referencia_informado,
          CAST(NULL AS STRING) AS motivo_espera,
          o_orderpriority AS prioridade_ticket,
          CAST(NULL AS STRING) AS controle_interno,
          'CONC' AS concessionaria,
          CASE WHEN k % 3 = 0 THEN 'Classe A' END AS classificacao_solicitacoes,
          CASE WHEN k % 8 = 0 THEN ' ' WHEN k % 8 = 1 THEN NULL ELSE 'BAIRRO' || chr(160) || '  ' || CAST(c % 30 AS STRING) END AS bairro,
          CASE WHEN k % 9 = 0 THEN NULL ELSE 'MUN ' || CAST(c % 12 AS STRING) END AS municipio,
          CASE WHEN k % 2 = 0 THEN 'Rua ' || CAST(c % 50 AS STRING) END AS logradouro,
          'Endereço  ' || CAST(c AS STRING) AS endereco,
          CAST(c % 300 AS STRING) AS numero_porta,
          CAST(NULL AS STRING) AS complemento,
          CAST(NULL AS STRING) AS telefone,
          CAST(NULL AS STRING) AS nome_cliente_gss,
          CAST(NULL AS STRING) AS nome_requerente_gss,
          'Cliente ' || CAST(c AS STRING) AS nome_solicitante,
          CAST(NULL AS STRING) AS email_solicitante,
          CASE WHEN k % 31 = 0 THEN NULL WHEN k % 10 = 4 THEN ' solicitações ' WHEN k % 2 = 0 THEN 'Solicitações' ELSE 'Notificações' END AS formulario_ticket,
          CASE WHEN k % 37 = 0 THEN 'Informativo::Anexo' WHEN k % 41 = 0 THEN 'informativo com anexo' END AS classificacao_notificacoes,
          CAST(CASE WHEN k % 23 = 0 THEN 1 WHEN k % 10 = 0 THEN NULL ELSE 0 END AS INT) AS flag_arquivado_relatorio,
          CAST(CASE WHEN k % 53 = 0 THEN 1 WHEN k % 2 = 0 THEN 0 END AS INT) AS flag_auditoria_classificacao,
          CAST(NULL AS STRING) AS motivo_auditoria_classificacao,
          CAST(NULL AS STRING) AS status_auditoria_classificacao,
          CAST(NULL AS STRING) AS grupo_sugerido_auditoria,
          CAST(NULL AS STRING) AS tipo_solicitacao_original_auditoria,
          CAST(NULL AS {ts}) AS data_auditoria_classificacao,
          CAST(1 + k % 3 AS INT) AS qtde_assuntos_ticket,
          CAST(CASE WHEN k % 3 = 0 THEN 0 ELSE 1 END AS INT) AS flag_multiplos_assuntos,
          CASE k % 7 WHEN 1 THEN procon WHEN 2 THEN '  ' END AS protocolo_procon,
          CASE WHEN k % 7 = 2 THEN 'V' || lpad(CAST(k % 100000 AS STRING), 5, '0') || '/2024' END AS protocolo_defensoria,
          CASE WHEN k % 7 = 3 THEN lpad(CAST(k % 1000000 AS STRING), 6, '0') || '/2023' END AS protocolo_codecon,
          CASE WHEN k % 59 = 0 THEN 'jec' || CAST(c AS STRING) END AS case_jec,
          k AS ticket_solicitacao_id,
          CASE WHEN k % 9 = 0 THEN k + 1 END AS ticket_notificacao_id,
          CASE WHEN k % 5 = 0 THEN NULL ELSE CAST(dia - CAST(k % 3 AS INT) AS {ts}) END AS data_entrada_reclamacao,
          o_orderdate AS data_criacao_solicitacao,
          CAST(NULL AS {ts}) AS data_criacao_notificacao,
          CAST(NULL AS INT) AS dias_defasagem_abertura,
          CASE WHEN k % 9 = 0 THEN 'titulo_normalizado' END AS criterio_vinculo,
          CASE WHEN k % 9 = 0 THEN CAST(0.5 AS DOUBLE) END AS confianca_vinculo,
          CASE WHEN k % 9 = 0 THEN 'VINCULADO' ELSE 'SEM_VINCULO' END AS status_vinculo,
          o_orderdate AS data_inicio_vigencia,
          CAST(NULL AS {ts}) AS data_fim_vigencia,
          CAST(CASE WHEN k % 97 = 0 THEN 0 WHEN k % 89 = 0 THEN NULL ELSE 1 END AS INT) AS flag_ativo
        FROM (
          SELECT o_orderkey AS k, o_custkey AS c, o_orderdate, o_orderstatus, o_orderpriority,
            CAST(o_orderdate AS DATE) AS dia,
            CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE
              (CASE o_custkey % 3 WHEN 0 THEN '40' WHEN 1 THEN '10' ELSE '99' END) || lpad(CAST(o_custkey AS STRING), 6, '0') END AS conta,
            CASE o_custkey % 5 WHEN 0 THEN 'Água' WHEN 1 THEN 'Esgoto' WHEN 2 THEN 'Fatura alta' WHEN 3 THEN 'Ligação nova' ELSE 'Vazamento rua' END AS segmento,
            '11.22.2024.' || lpad(CAST(o_orderkey % 1000 AS STRING), 3, '0') || '.' || lpad(CAST(o_orderkey % 1009 AS STRING), 5, '0') || '-' || lpad(CAST(o_orderkey % 7 AS STRING), 3, '0') AS procon,
            CASE WHEN o_orderkey % 29 = 0 THEN 'Informativo::Anexo' WHEN o_orderpriority LIKE '1%' THEN 'Canais de Atrito::PROCON'
              WHEN o_orderpriority LIKE '2%' THEN 'JEC' WHEN o_orderpriority LIKE '3%' THEN 'Reclame Aqui::' WHEN o_orderpriority LIKE '4%' THEN '  ' END AS canal,
            CASE o_orderkey % 7 WHEN 0 THEN '[routing]Oceano Canais de Atrito N2' WHEN 1 THEN NULL
              WHEN 2 THEN '[internal]Ticket Privado Oceano Canais de Atrito' ELSE 'Grupo ' || CAST(o_orderkey % 3 AS STRING) END AS grupo
          FROM {orders}
        ) o
    """,
    # Hearings: one per order with a returned line.
    "hearings": """
        SELECT l_orderkey AS ticket_id, l_orderkey + 1000000000 AS audiencia_id,
          CASE WHEN l_orderkey % 3 = 0 THEN NULL ELSE l_orderkey END AS ticket_relacionado_id,
          l_orderkey + 5000000000 AS ticket_audiencia_id,
          'TRUE' AS audiencia, min(l_shipdate) AS data_audiencia,
          CASE WHEN max(l_shipdate) <> min(l_shipdate) THEN max(l_shipdate) END AS data_reagendamento,
          CASE WHEN l_orderkey % 2 = 0 THEN 'open' END AS status_ticket,
          CAST(l_orderkey % 7 AS STRING) AS preposto_id, 'PREPOSTO ' || CAST(l_orderkey % 7 AS STRING) AS preposto,
          CASE WHEN l_orderkey % 4 = 0 THEN NULL ELSE 'PROCON ' || CAST(l_orderkey % 5 AS STRING) END AS local_procon,
          'Conciliação' AS tipo_audiencia, 'NATION_1' AS atribuido, 'h.parquet' AS arquivo_origem
        FROM {lineitem} WHERE l_returnflag = 'R' GROUP BY l_orderkey
    """,
    # Subject rows of tickets, several per ticket, with a file time.
    "subject_feed": """
        SELECT l_orderkey AS ticket_id, 'Solicitações' AS formulario_ticket,
          CASE WHEN l_partkey % 11 = 0 THEN ' ' ELSE
            (CASE l_partkey % 6 WHEN 0 THEN 'Cobrança' WHEN 1 THEN 'COBRANCA!' WHEN 2 THEN 'Ligação - nova' WHEN 3 THEN 'Esgoto' WHEN 4 THEN 'Vazamento' ELSE 'Água' END) END AS assunto,
          CASE WHEN l_suppkey % 9 = 0 THEN NULL ELSE 'Título ' || CAST(l_suppkey % 4 AS STRING) END AS titulo,
          l_shipdate AS arquivo_mtime, 'lote_' || CAST(l_linenumber AS STRING) AS arquivo_origem,
          l_extendedprice AS preco, l_quantity AS qtde, l_discount AS desconto, l_tax AS taxa, l_partkey AS parte, l_suppkey AS fornecedor
        FROM {lineitem}
    """,
    # Work orders: raw text cells, many rows per order number.
    "work_orders": """
        SELECT CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS numero_os,
          CASE WHEN l_orderkey % 10 = 0 THEN NULL ELSE '2024' END AS ano_os,
          CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE
            (CASE o_custkey % 3 WHEN 0 THEN '40' WHEN 1 THEN '10' ELSE '99' END) || lpad(CAST(o_custkey AS STRING), 6, '0') END AS matricula,
          CASE WHEN l_linenumber = 7 THEN NULL ELSE l_shipdate END AS data_emissao,
          CASE WHEN l_linestatus = 'F' THEN l_shipdate END AS data_execucao,
          CASE WHEN l_linenumber % 3 = 0 THEN o_orderdate END AS data_agendamento,
          CASE WHEN l_linenumber % 2 = 0 THEN CAST(CAST(l_shipdate AS DATE) + 30 AS {ts}) END AS previsao_conclusao,
          CASE l_partkey % 6 WHEN 0 THEN 'Cobrança revisão' WHEN 1 THEN 'Água' WHEN 2 THEN 'Ligação nova' WHEN 3 THEN 'Esgoto' WHEN 4 THEN 'Vazamento na rua' ELSE NULL END AS servico_executado,
          CASE l_suppkey % 5 WHEN 0 THEN 'Reclamação procon' WHEN 1 THEN ' ' WHEN 2 THEN 'Fatura alta' ELSE NULL END AS solicitacao_associada,
          CASE WHEN l_linenumber % 4 = 0 THEN 'atenção' END AS tipo_solicitacao_gss,
          CASE WHEN l_partkey % 3 = 0 THEN NULL ELSE 'Bairro ' || CAST(l_partkey % 30 AS STRING) END AS bairro,
          CASE WHEN l_partkey % 4 = 0 THEN 'nan' ELSE 'Mun ' || CAST(l_partkey % 12 AS STRING) END AS municipio,
          'Rua ' || CAST(l_suppkey AS STRING) AS nome_logradouro,
          CASE WHEN l_suppkey % 2 = 0 THEN ' ' ELSE 'End ' || CAST(l_suppkey AS STRING) END AS endereco_requerente,
          CAST(l_quantity AS INT) AS porta, CASE WHEN l_linenumber % 5 = 0 THEN 'Fundos' END AS complemento,
          '21' || lpad(CAST(l_suppkey AS STRING), 8, '9') AS telefone,
          'Cliente ' || CAST(o_custkey AS STRING) AS nome_cliente, CAST(NULL AS STRING) AS nome_requerente,
          l_shipdate AS arquivo_mtime,
          l_partkey AS parte, l_suppkey AS fornecedor, l_quantity AS qtde, l_extendedprice AS preco, l_discount AS desconto, l_tax AS taxa
        FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
    """,
    # Governed ids and overrides as a share of all tickets.
    "governed": """
        SELECT o_orderkey AS ticket_id, CASE o_orderkey % 211 WHEN 1 THEN 'REMOVIDO' WHEN 2 THEN 'ARQUIVO_MANUAL'
          WHEN 3 THEN 'GRUPO_MANUAL' WHEN 4 THEN 'ANEXO_MANUAL' ELSE 'EXCECAO_AUDITORIA' END AS regra
        FROM {orders} WHERE o_orderkey % 211 BETWEEN 1 AND 5
    """,
    "field_overrides": """
        SELECT o_orderkey AS ticket_id, CASE WHEN o_orderkey % 2 = 0 THEN 'atribuido' ELSE 'tipo_manifestacao' END AS coluna,
          CASE WHEN o_orderkey % 2 = 0 THEN 'EQUIPE ' || CAST(o_orderkey % 3 AS STRING) ELSE 'ANEXO' END AS valor, 1 AS prioridade
        FROM {orders} WHERE o_orderkey % 199 = 6
    """,
    # Dense link test: purchases ask, errors are notices, one account per user.
    "dense_links": """
        SELECT event_id AS ticket_id, event_type, CAST(user_id AS STRING) AS matricula, ts AS data_criacao,
          CASE WHEN event_id % 3 = 0 THEN props END AS protocolo_referencia,
          'A' || CAST(event_id % 4 AS STRING) AS assunto_normalizado
        FROM {events} WHERE event_type IN ('purchase', 'error')
    """,
}
# Tie-break columns: together they tell apart all rows of a line.
SUBJECT_TIES = ("preco", "qtde", "desconto", "taxa", "parte", "fornecedor", "arquivo_origem")
ORDER_TIES = ("preco", "qtde", "desconto", "taxa", "parte", "fornecedor")


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def view(spark: SparkSession, sf: str, name: str) -> DataFrame:
    sql = VIEWS[name].replace("{ts}", "TIMESTAMP_NTZ")
    used = {t: table(spark, sf, t) for t in TABLES if f"{{{t}}}" in sql}
    return spark.sql(sql, **used)


def with_views(body: str) -> str:
    """`body` as one statement for the check database, with the views it names."""
    named = [name for name in VIEWS if re.search(rf"\b{name}\b", body)]
    ctes = []
    for name in named:
        sql = VIEWS[name].replace("{ts}", "TIMESTAMP")
        for t in TABLES:
            sql = sql.replace(f"{{{t}}}", t)
        ctes.append(f"{name} AS ({sql})")
    if not ctes:
        return body
    body = body.strip()
    if body.upper().startswith("WITH RECURSIVE "):
        return "WITH RECURSIVE " + ",\n".join(ctes) + ",\n" + body[15:]
    if body.upper().startswith("WITH "):
        return "WITH " + ",\n".join(ctes) + ",\n" + body[5:]
    return "WITH " + ",\n".join(ctes) + "\n" + body


def tickets(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "tickets")


def hearings(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "hearings")


def governed(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "governed")


RAW_HEADERS = {
    "ID do ticket": "ticket_id",
    "Criação do ticket - Carimbo de data/hora": "data_criacao",
    "Resolução do ticket - Carimbo de data/hora": "data_resolucao",
    "Nome do atribuído": "atribuido",
    "Assunto do ticket": "titulo",
    "Assuntos do ticket": "assunto",
    "Tipos de Solicitações": "tipo_solicitacao",
    "Status do ticket": "status",
    "Matrícula": "matricula",
    "Tipo de Manifestação": "tipo_manifestacao",
    "Formulário de ticket": "formulario_ticket",
    "Classificação Notificações": "classificacao_notificacoes",
    "Classificação Solicitações": "classificacao_solicitacoes",
    "Canais de atrito": "canais_de_atrito",
    "Número da OS": "numero_os",
    "Grupo de tickets": "grupo_tickets",
    "CPF Cliente": "cpf_cliente",
    "Protocolo de Referência": "protocolo_referencia_informado",
    "Bairro": "bairro",
    "Município": "municipio",
    "Nome Logradouro": "logradouro",
    "Ticket relacionado": "ticket_relacionado",
    "arquivo_origem": "arquivo_origem",
    "arquivo_mtime": "arquivo_mtime",
}


def raw_general(spark: SparkSession, sf: str) -> DataFrame:
    """The tickets as a raw export: original headers, text cells, some of them broken."""
    t = tickets(spark, sf)
    key = F.col("ticket_id")
    text = t.withColumns(
        {
            "ticket_relacionado": F.when(key % 9 == 0, (key + 1).cast("string")).when(key % 4 == 0, F.lit(" nan ")),
            "arquivo_origem": F.lit("geral.parquet"),
            "arquivo_mtime": F.col("data_criacao"),
            "data_criacao": F.when(key % 61 == 0, F.lit("nao eh data")).otherwise(
                F.date_format("data_criacao", "yyyy-MM-dd HH:mm:ss")
            ),
            "data_resolucao": F.date_format("data_resolucao", "MM/dd/yyyy HH:mm"),
            "matricula": F.concat(F.lit(" "), "matricula", F.when(key % 5 == 0, ".0").otherwise("")),
            "ticket_id": F.when(key % 101 == 0, F.lit("sem numero"))
            .when(key % 5 == 0, F.concat(key.cast("string"), F.lit(".0")))
            .otherwise(key.cast("string")),
        }
    )
    return text.select(*[F.col(c).alias(h) for h, c in RAW_HEADERS.items()])
