"""Canonical tables: column names, types, raw header aliases and intake contracts.

The values below are fixed: they are the header spellings of the source exports and the column names
that reports and stored tables agree on.
"""

from __future__ import annotations

from dataclasses import dataclass, field

TS, DAY, TEXT, LONG, INT, REAL = "timestamp_ntz", "date", "string", "bigint", "int", "double"

# ---- file name prefixes of each source ------------------------------------------------------
SOURCE_PREFIXES = {
    "zendesk_geral": ("ANALYTICS_BASE_TICKETS_GERAL",),
    "zendesk_n1": ("ANALYTICS_BASE_TICKETS_N1",),
    "audiencias": ("PRE_CONTENCIOSO_AUDIENCIAS",),
    "gss": ("Base_GSS",),
}

# ---- raw header (normalised) -> canonical column --------------------------------------------
TICKET_ALIASES = {
    "id_do_ticket": "ticket_id",
    "criacao_do_ticket_carimbo_de_data_hora": "data_criacao",
    "resolucao_do_ticket_carimbo_de_data_hora": "data_resolucao",
    "nome_do_atribuido": "atribuido",
    "assunto_do_ticket": "titulo",
    "assuntos_do_ticket": "assunto",
    "tipos_de_conversas": "tipo_conversa",
    "tipos_de_solicitacoes": "tipo_solicitacao",
    "status_do_ticket": "status",
    "tipo_de_manifestacao": "tipo_manifestacao",
    "formulario_de_ticket": "formulario_ticket",
    "numero_da_os": "numero_os",
    "resultado_tratativa_segundo_nivel": "resultado_tratativa",
    "tipo_de_audiencia": "tipo_audiencia",
    "data_da_audiencia_carimbo_de_data_hora": "data_audiencia",
    "preposto_name": "preposto",
    "local_do_procon": "local_procon",
    "data_de_reagendamento_carimbo_de_data_hora": "data_reagendamento",
    "tags_de_ticket": "tags_ticket",
    "grupo_de_tickets": "grupo_tickets",
    "canal_de_origem": "canal_origem",
    "passou_pelo_nivel_1": "passou_nivel_1",
    "protocolo_de_referencia": "protocolo_referencia_informado",
    "motivo_de_espera": "motivo_espera",
    "prioridade_do_ticket": "prioridade_ticket",
    "nome_logradouro": "logradouro",
    "endereco_do_requerente": "endereco",
    "numero_da_porta": "numero_porta",
    "desc_complemento": "complemento",
    "nome_do_solicitante": "nome_solicitante",
    "e_mail_do_solicitante": "email_solicitante",
    "tickets": "contagem_zendesk",
}
N1_ALIASES = {
    "id_do_ticket": "ticket_id",
    "criacao_do_ticket_carimbo_de_data_hora": "data_criacao",
    "resolucao_do_ticket_carimbo_de_data_hora": "data_resolucao",
    "status_do_ticket": "status",
    "assunto_do_ticket": "titulo",
    "assuntos_do_ticket": "assunto",
    "grupo_de_tickets": "grupo_tickets",
    "canal_do_ticket": "canal_ticket",
    "canal_de_origem": "canal_origem",
    "formulario_de_ticket": "formulario_ticket",
    "tipo_do_ticket": "tipo_ticket",
    "sistema_conversationid": "conversation_id",
    "tipos_de_conversas": "tipo_conversa",
    "tickets": "contagem_zendesk",
}
HEARING_ALIASES = {
    "id_do_ticket": "ticket_audiencia_id",
    "data_da_audiencia_carimbo_de_data_hora": "data_audiencia",
    "data_de_reagendamento_carimbo_de_data_hora": "data_reagendamento",
    "tipo_de_audiencia": "tipo_audiencia",
    "status_do_ticket": "status_ticket",
    "preposto_name": "preposto",
    "nome_do_atribuido": "atribuido",
    "tickets": "contagem_zendesk",
}
WORK_ORDER_ALIASES = {
    "no_da_o_s": "numero_os",
    "ano_da_o_s": "ano_os",
    "dt_emissao": "data_emissao",
    "endereco_do_requerente": "endereco_requerente",
    "numero_da_porta": "numero_porta",
    "desc_complemento": "complemento",
    "nome_do_bairro": "bairro",
    "nome_da_localidade": "municipio",
    "dt_agendamento": "data_agendamento",
    "dt_impressao": "data_impressao",
    "prev_conclusao": "previsao_conclusao",
    "dt_execucao": "data_execucao",
    "entrada_no_setor": "entrada_setor",
    "tipo_de_solicitacao": "tipo_solicitacao_gss",
}

# ---- canonical feeds: column -> type after canonicalisation ----------------------------------
LINEAGE = {"arquivo_origem": TEXT, "arquivo_mtime": TS}


TICKET_FEED = {
    "ticket_id": LONG,
    "data_criacao": TS,
    "data_resolucao": TS,
    "data_audiencia": TS,
    "data_reagendamento": TS,
    "atribuido": TEXT,
    "titulo": TEXT,
    "assunto": TEXT,
    "tipo_conversa": TEXT,
    "tipo_solicitacao": TEXT,
    "status": TEXT,
    "matricula": TEXT,
    "bloco": TEXT,
    "tipo_manifestacao": TEXT,
    "numero_os": TEXT,
    "resultado_tratativa": TEXT,
    "tags_ticket": TEXT,
    "grupo_tickets": TEXT,
    "superintendencia_adr": TEXT,
    "canal_origem": TEXT,
    "cpf_cliente": TEXT,
    "passou_nivel_1": TEXT,
    "canais_de_atrito": TEXT,
    "protocolo_referencia_informado": TEXT,
    "motivo_espera": TEXT,
    "prioridade_ticket": TEXT,
    "controle_interno": TEXT,
    "concessionaria": TEXT,
    "bairro": TEXT,
    "municipio": TEXT,
    "logradouro": TEXT,
    "endereco": TEXT,
    "numero_porta": TEXT,
    "complemento": TEXT,
    "telefone": TEXT,
    "nome_cliente_gss": TEXT,
    "nome_requerente_gss": TEXT,
    "nome_solicitante": TEXT,
    "email_solicitante": TEXT,
    "classificacao_solicitacoes": TEXT,
    "formulario_ticket": TEXT,
    "classificacao_notificacoes": TEXT,
    "audiencia": TEXT,
    "tipo_audiencia": TEXT,
    "preposto": TEXT,
    "local_procon": TEXT,
    **LINEAGE,
}
N1_FEED = {
    "ticket_id": LONG,
    "data_criacao": TS,
    "data_resolucao": TS,
    "matricula": TEXT,
    "bloco": TEXT,
    "status": TEXT,
    "titulo": TEXT,
    "assunto": TEXT,
    "grupo_tickets": TEXT,
    "canal_ticket": TEXT,
    "canal_origem": TEXT,
    "formulario_ticket": TEXT,
    "tipo_ticket": TEXT,
    "conversation_id": TEXT,
    "tipo_conversa": TEXT,
    **LINEAGE,
}
HEARING_FEED = {
    "ticket_audiencia_id": LONG,
    "ticket_relacionado_id": LONG,
    "data_audiencia": TS,
    "data_reagendamento": TS,
    "tipo_audiencia": TEXT,
    "status_ticket": TEXT,
    "preposto_id": TEXT,
    "preposto": TEXT,
    "atribuido": TEXT,
    **LINEAGE,
}
WORK_ORDER_FEED = {
    "numero_os": TEXT,
    "ano_os": TEXT,
    "matricula": TEXT,
    "data_emissao": TS,
    "data_agendamento": TS,
    "data_impressao": TS,
    "previsao_conclusao": TS,
    "data_execucao": TS,
    "entrada_setor": TS,
    "servico_executado": TEXT,
    "nome_cliente": TEXT,
    "nome_requerente": TEXT,
    "telefone": TEXT,
    "endereco_requerente": TEXT,
    "nome_logradouro": TEXT,
    "numero_porta": TEXT,
    "complemento": TEXT,
    "bairro": TEXT,
    "municipio": TEXT,
    "executor": TEXT,
    "data_pedido": TEXT,
    "atendente": TEXT,
    "solicitacao_associada": TEXT,
    "tipo_solicitacao_gss": TEXT,
    **LINEAGE,
}
# Candidate columns of an explicit link between two tickets, best first.
EXPLICIT_LINK_COLUMNS = (
    "id_reclamacao", "id_manifestacao", "chave_reclamacao", "ticket_relacionado_id", "ticket_relacionado",
    "external_id", "id_externo", "protocolo_reclamacao",
)

# ---- stored tables ----------------------------------------------------------------------------
TICKETS = {
    "ticket_id": LONG,
    "case_id": TEXT,
    "matricula": TEXT,
    "bloco": TEXT,
    "numero_os": TEXT,
    "numero_os_original": TEXT,
    "numero_os_gss": TEXT,
    "gss_os_id": TEXT,
    "origem_numero_os": TEXT,
    "status_vinculo_os": TEXT,
    "score_vinculo_os": REAL,
    "criterio_vinculo_os": TEXT,
    "data_criacao": TS,
    "data_resolucao": TS,
    "status": TEXT,
    "atribuido": TEXT,
    "titulo": TEXT,
    "assunto": TEXT,
    "tipo_conversa": TEXT,
    "tipo_solicitacao": TEXT,
    "tipo_manifestacao": TEXT,
    "resultado_tratativa": TEXT,
    "tags_ticket": TEXT,
    "grupo_tickets": TEXT,
    "superintendencia_adr": TEXT,
    "canal_origem": TEXT,
    "cpf_cliente": TEXT,
    "passou_nivel_1": TEXT,
    "canais_de_atrito": TEXT,
    "protocolo_referencia_informado": TEXT,
    "motivo_espera": TEXT,
    "prioridade_ticket": TEXT,
    "controle_interno": TEXT,
    "concessionaria": TEXT,
    "classificacao_solicitacoes": TEXT,
    "bairro": TEXT,
    "municipio": TEXT,
    "logradouro": TEXT,
    "endereco": TEXT,
    "numero_porta": TEXT,
    "complemento": TEXT,
    "telefone": TEXT,
    "nome_cliente_gss": TEXT,
    "nome_requerente_gss": TEXT,
    "nome_solicitante": TEXT,
    "email_solicitante": TEXT,
    "formulario_ticket": TEXT,
    "classificacao_notificacoes": TEXT,
    "flag_arquivado_relatorio": INT,
    "flag_auditoria_classificacao": INT,
    "motivo_auditoria_classificacao": TEXT,
    "status_auditoria_classificacao": TEXT,
    "grupo_sugerido_auditoria": TEXT,
    "tipo_solicitacao_original_auditoria": TEXT,
    "data_auditoria_classificacao": TS,
    "qtde_assuntos_ticket": INT,
    "flag_multiplos_assuntos": INT,
    "protocolo_procon": TEXT,
    "protocolo_defensoria": TEXT,
    "protocolo_codecon": TEXT,
    "case_jec": TEXT,
    "ticket_solicitacao_id": LONG,
    "ticket_notificacao_id": LONG,
    "data_entrada_reclamacao": TS,
    "data_criacao_solicitacao": TS,
    "data_criacao_notificacao": TS,
    "dias_defasagem_abertura": INT,
    "criterio_vinculo": TEXT,
    "confianca_vinculo": REAL,
    "status_vinculo": TEXT,
    "data_inicio_vigencia": TS,
    "data_fim_vigencia": TS,
    "flag_ativo": INT,
}
NOTICES = {
    "ticket_id": LONG,
    "case_id": TEXT,
    "matricula": TEXT,
    "bloco": TEXT,
    "numero_os": TEXT,
    "data_criacao": TS,
    "data_resolucao": TS,
    "status": TEXT,
    "atribuido": TEXT,
    "titulo": TEXT,
    "assunto": TEXT,
    "tipo_conversa": TEXT,
    "tipo_solicitacao": TEXT,
    "tipo_manifestacao": TEXT,
    "resultado_tratativa": TEXT,
    "tags_ticket": TEXT,
    "grupo_tickets": TEXT,
    "superintendencia_adr": TEXT,
    "canal_origem": TEXT,
    "cpf_cliente": TEXT,
    "passou_nivel_1": TEXT,
    "canais_de_atrito": TEXT,
    "protocolo_referencia_informado": TEXT,
    "motivo_espera": TEXT,
    "prioridade_ticket": TEXT,
    "controle_interno": TEXT,
    "concessionaria": TEXT,
    "classificacao_solicitacoes": TEXT,
    "bairro": TEXT,
    "municipio": TEXT,
    "logradouro": TEXT,
    "endereco": TEXT,
    "numero_porta": TEXT,
    "complemento": TEXT,
    "telefone": TEXT,
    "nome_cliente_gss": TEXT,
    "nome_requerente_gss": TEXT,
    "nome_solicitante": TEXT,
    "email_solicitante": TEXT,
    "formulario_ticket": TEXT,
    "classificacao_notificacoes": TEXT,
    "flag_arquivado_relatorio": INT,
    "protocolo_procon": TEXT,
    "protocolo_defensoria": TEXT,
    "protocolo_codecon": TEXT,
    "case_jec": TEXT,
    "arquivo_origem": TEXT,
}
TICKETS_N1 = {name: kind for name, kind in N1_FEED.items() if name != "arquivo_mtime"}
HEARINGS = {
    "audiencia_id": LONG,
    "ticket_id": LONG,
    "ticket_audiencia_id": LONG,
    "ticket_relacionado_id": LONG,
    "audiencia": TEXT,
    "data_audiencia": TS,
    "status_ticket": TEXT,
    "preposto_id": TEXT,
    "preposto": TEXT,
    "local_procon": TEXT,
    "tipo_audiencia": TEXT,
    "atribuido": TEXT,
    "data_reagendamento": TS,
    "arquivo_origem": TEXT,
}
TICKET_SUBJECTS = {
    "ticket_assunto_id": TEXT,
    "ticket_id": LONG,
    "formulario_ticket": TEXT,
    "assunto_raw": TEXT,
    "assunto_normalizado": TEXT,
    "ordem_assunto": INT,
    "flag_assunto_principal": INT,
    "arquivo_origem": TEXT,
}
RELATIONS = {
    "ticket_solicitacao_id": LONG,
    "ticket_notificacao_id": LONG,
    "status_vinculo": TEXT,
    "criterio_vinculo": TEXT,
    "confianca_vinculo": REAL,
    "data_entrada_reclamacao": TS,
    "data_criacao_solicitacao": TS,
    "data_criacao_notificacao": TS,
    "dias_defasagem_abertura": INT,
    "quantidade_candidatos": LONG,
    "observacao": TEXT,
}
MANUAL_LINKS = {
    "ticket_solicitacao_id": LONG,
    "ticket_notificacao_id": LONG,
    "justificativa": TEXT,
    "usuario": TEXT,
    "atualizado_em": TS,
}
AUDIT_CLASS = {
    "ticket_id": LONG,
    "origem_regra": TEXT,
    "status_auditoria": TEXT,
    "motivo_auditoria": TEXT,
    "tipo_solicitacao_original": TEXT,
    "tipo_solicitacao_atual": TEXT,
    "grupo_tickets": TEXT,
    "grupo_sugerido": TEXT,
    "canal_normalizado": TEXT,
    "data_criacao": TS,
    "data_resolucao": TS,
    "atribuido": TEXT,
    "titulo": TEXT,
    "observacao": TEXT,
    "arquivo_origem": TEXT,
}
AUDIT_OPER = {
    "auditoria_operacional_key": TEXT,
    "ticket_id": LONG,
    "origem_regra": TEXT,
    "tipo_inconsistencia": TEXT,
    "descricao_inconsistencia": TEXT,
    "status_validacao": TEXT,
    "data_identificacao": TS,
    "data_validacao": TS,
    "validado_por": TEXT,
    "acao_tomada": TEXT,
    "observacao": TEXT,
}
HISTORY_COLUMNS = (
    "ticket_id", "case_id", "matricula", "numero_os", "status", "atribuido", "titulo", "assunto",
    "tipo_solicitacao", "tipo_manifestacao", "resultado_tratativa", "grupo_tickets",
    "flag_arquivado_relatorio", "ticket_notificacao_id", "status_vinculo", "data_criacao", "data_resolucao",
)
HISTORY = {
    "ticket_hist_id": TEXT,
    **{name: TICKETS[name] for name in HISTORY_COLUMNS},
    "data_inicio_vigencia": TS,
    "data_fim_vigencia": TS,
    "flag_ativo": INT,
    "run_id": TEXT,
    "hash_dados": TEXT,
    "payload_json": TEXT,
}
RUNS = {
    "run_id": TEXT,
    "pipeline_name": TEXT,
    "data_execucao": TS,
    "status": TEXT,
    "tempo_execucao": REAL,
    "qtd_registros_processados": LONG,
    "erro": TEXT,
    "qtd_arquivos_lidos": LONG,
    "qtd_fontes_processadas": LONG,
    "data_inicio": TS,
    "data_fim": TS,
}
STEPS = {
    "run_id": TEXT,
    "timestamp_log": TS,
    "nivel": TEXT,
    "etapa": TEXT,
    "status": TEXT,
    "volume_processado": LONG,
    "tempo_etapa": REAL,
    "erro": TEXT,
    "payload_json": TEXT,
}
# Stored table -> (schema, key).
GOLD = {
    "clientes": ({"matricula": TEXT}, "matricula"),
    "cases": ({"case_id": TEXT, "protocolo_agenersa": TEXT}, "case_id"),
    "tickets": (TICKETS, "ticket_id"),
    "tickets_notificacao": (NOTICES, "ticket_id"),
    "tickets_n1": (TICKETS_N1, "ticket_id"),
    "ticket_assunto": (TICKET_SUBJECTS, "ticket_assunto_id"),
    "ticket_relacionamentos": (RELATIONS, "ticket_solicitacao_id"),
    "ticket_vinculos_manuais": (MANUAL_LINKS, "ticket_solicitacao_id"),
    "tickets_auditoria_classificacao": (AUDIT_CLASS, "ticket_id"),
    "tickets_auditoria_operacional": (AUDIT_OPER, "auditoria_operacional_key"),
    "tickets_historico": (HISTORY, "ticket_hist_id"),
    "audiencias": (HEARINGS, "ticket_id"),
}
# Columns by which a removed ticket is purged from each stored table.
PURGE_COLUMNS = {
    "ticket_assunto": ("ticket_id",),
    "ticket_relacionamentos": ("ticket_solicitacao_id", "ticket_notificacao_id"),
    "ticket_vinculos_manuais": ("ticket_solicitacao_id", "ticket_notificacao_id"),
    "tickets_auditoria_classificacao": ("ticket_id",),
    "tickets_auditoria_operacional": ("ticket_id",),
    "tickets_historico": ("ticket_id",),
    "audiencias": ("ticket_id", "ticket_relacionado_id", "ticket_audiencia_id"),
    "tickets": ("ticket_id",),
    "tickets_notificacao": ("ticket_id",),
    "tickets_n1": ("ticket_id",),
}


# ---- intake contracts ---------------------------------------------------------------------------
@dataclass(frozen=True)
class Contract:
    required: tuple[str, ...] = ()
    filled: tuple[tuple[str, ...], ...] = ()
    aliases: dict[str, str] = field(default_factory=dict)


CONTRACTS = {
    "zendesk_geral": Contract(
        required=(
            "id_do_ticket", "criacao_do_ticket_carimbo_de_data_hora", "status_do_ticket", "formulario_de_ticket",
        ),
        filled=(
            ("id_do_ticket",),
            ("formulario_de_ticket",),
            ("status_do_ticket",),
            ("assunto_do_ticket", "assuntos_do_ticket"),
            ("tipos_de_solicitacoes", "classificacao_solicitacoes", "canais_de_atrito"),
        ),
    ),
    "zendesk_n1": Contract(
        required=("id_do_ticket", "criacao_do_ticket_carimbo_de_data_hora", "status_do_ticket"),
        filled=(("id_do_ticket",), ("criacao_do_ticket_carimbo_de_data_hora",)),
    ),
    "audiencias": Contract(
        filled=(
            ("id_do_ticket", "ticket_relacionado_id"),
            ("data_da_audiencia_carimbo_de_data_hora", "data_de_reagendamento_carimbo_de_data_hora"),
        ),
    ),
    "gss": Contract(
        required=("matricula", "numero_os", "data_emissao", "servico_executado"),
        filled=(("matricula",), ("numero_os",), ("data_emissao", "data_execucao"), ("servico_executado",)),
        aliases=WORK_ORDER_ALIASES,
    ),
}
