"""Words, labels and formats that decide results and must read exactly so.

Nothing here is logic. Lexicons, prices, descriptions and prompt templates are inputs.
"""

# --- filter reasons and criteria (%s are filled left to right) -------------------------
REASON_BYPASS = "Filtro desativado"
REASON_EMPTY = "objetoCompra vazio"
REASON_NO_TERM = "Nenhum termo correspondente encontrado"
REASON_GROUP = "Match com grupo '%s'"
REASON_TERM = "Match com termo '%s' do grupo '%s'"
CRITERION_GROUP = 'Nome do grupo "%s" (palavra exata)'
CRITERION_TERM = 'Termo "%s" do grupo "%s" (palavra exata)'
REASON_STAGE1_REJECTED = "Etapa 1 (Palavras-chave): %s"
REASON_STAGE1_ONLY = "Apenas Etapa 1 (Palavras-chave): %s"
REASON_VERDICT = "LLM %s (confiança: %s%%)"
REASON_HYBRID_YES = "Híbrido: Etapa1 ✓ → Etapa2 ✓ | %s"
REASON_HYBRID_NO = "Híbrido: Etapa1 ✓ → Etapa2 ✗ | %s"
BATCH_REASON = "TI: %s, Alto valor: %s"

# --- verdict text ----------------------------------------------------------------------
APPROVE = "APROVAR"
REJECT = "REJEITAR"
DECISION_MARKS = ("DECISAO:", "DECISÃO:")
CATEGORY_MARK = "CATEGORIA:"
CONFIDENCE_MARKS = ("CONFIANCA:", "CONFIANÇA:")
JUSTIFICATION_MARK = "JUSTIFICATIVA:"
REPAIR_PHRASES = ("se enquadra", "materiais educacionais")
REPAIR_CONFIDENCE = 85

# --- names of output columns -----------------------------------------------------------
FILTER_COLUMNS = {
    "applied": "filtro_aplicado",
    "reason": "filtro_motivo",
    "group": "filtro_grupo_matched",
    "term": "filtro_termo_matched",
    "criterion": "filtro_criterio",
}
EXTRACTION_DATE = "extraction_date"
PUBLICATION_DATE = "data_publicacao"
CONSOLIDATION_DATE = "consolidation_date"

# --- look-ups: domain table, its column, key column, output column, label of an unknown code
DOMAIN_LOOKUPS = [
    ("modalidade", "name", "modalidadeId", "modalidade_nome_dominio", "Modalidade %s"),
    ("modalidade", "description", "modalidadeId", "modalidade_descricao_dominio", "Modalidade não encontrada: %s"),
    ("situacao_compra", "name", "situacaoCompraId", "situacao_compra_nome_dominio", "Situação %s"),
    ("modo_disputa", "name", "modoDisputaId", "modo_disputa_nome_dominio", "Modo %s"),
    ("criterio_julgamento", "name", "criterioJulgamentoId", "criterio_julgamento_nome_dominio", "Critério %s"),
    ("instrumento_convocatorio", "name", "instrumentoConvocatorioId", "instrumento_convocatorio_nome_dominio",
     "Instrumento %s"),
    ("esfera", "name", "orgaoEntidade.esferaId", "esfera_nome_dominio", "Esfera %s"),
    ("poder", "name", "orgaoEntidade.poderId", "poder_nome_dominio", "Poder %s"),
]
CATEGORY_FAMILIES = {
    "Licitação Tradicional": [3, 4, 5, 6, 7],
    "Leilão": [1, 13],
    "Procedimentos Especiais": [2, 10, 11, 12],
    "Contratação Direta": [8, 9],
}
ELECTRONIC_CODES = [1, 4, 6]
IN_PERSON_CODES = [5, 7, 13]

# --- keys of a row, in order of preference ----------------------------------------------
MONTH_DEDUP_KEYS = [
    "sequencialContratacao", "numeroContratacao", "codigoUnidadeOrgao", "dataPublicacao", "objetoContrato"]
HISTORY_DEDUP_KEYS = ["sequencialContratacao", "numeroContratacao", "codigoUnidadeOrgao", "dataPublicacao"]

# --- text classes of the reporting layer -------------------------------------------------
CLASS_WORDS = [
    ("Tecnologia da Informação", [
        "TECNOLOGIA", "SOFTWARE", "SISTEMA", "INFORMAÇÃO", "TI", "DIGITAL", "COMPUTADOR", "REDE", "INTERNET"]),
    ("Obras e Infraestrutura", ["OBRA", "CONSTRUÇÃO", "REFORMA"]),
    ("Serviços Gerais", ["SERVIÇO", "MANUTENÇÃO", "LIMPEZA"]),
]
CLASS_OTHER = "Outros"
YES, NO = "Sim", "Não"
TECHNOLOGY_SUBSTRINGS = ["tecnologia", "informacao", "software", "sistema"]

# --- log lines ---------------------------------------------------------------------------
ERROR_PATTERN = "ERROR|FATAL|Exception|Traceback"
LATEST_ERROR_PATTERN = "ERROR|FATAL|Exception"
MODEL_LINE_PATTERN = "LLM"
SOURCE_LINE_PATTERN = "API|requisição|Modalidade"
USAGE_GLOB = "Tokens: *, Custo: $*"
CATEGORY_GLOB = "Modalidade *: * registros em * páginas"
ERROR_TERMS = ["ERROR", "FATAL", "Exception", "Traceback"]
API_FAILURE_TERMS = ["OpenAI", "API", "429", "quota", "rate limit"]

# --- alarms: metric, bin width, statistic, comparison, threshold -------------------------
ALARMS = {
    "workflow_failures": ("executions_failed", "5 minutes", "sum", ">=", 1),
    "workflow_duration": ("execution_time_ms", "5 minutes", "avg", ">", 7200000),
    "task_failures": ("tasks_failed", "5 minutes", "sum", ">=", 1),
    "application_errors": ("error_count", "5 minutes", "sum", ">", 5),
    "api_failures": ("api_failure_count", "10 minutes", "sum", ">", 10),
    "daily_cost": ("cost_usd", "24 hours", "sum", ">", 50.0),
}
