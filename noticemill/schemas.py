"""Declared schemas: every reader gets one, so a day whose nested field is all null cannot drift."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


UNIT = _strings("codigoIbge", "codigoUnidade", "municipioNome", "nomeUnidade", "ufNome", "ufSigla")
AGENCY = _strings("cnpj", "esferaId", "poderId", "razaoSocial")
LEGAL_BASIS = T.StructType([
    T.StructField("codigo", T.LongType()),
    T.StructField("descricao", T.StringType()),
    T.StructField("nome", T.StringType()),
])
BUDGET_SOURCE = T.StructType([
    T.StructField("codigo", T.LongType()),
    T.StructField("dataInclusao", T.StringType()),
    T.StructField("descricao", T.StringType()),
    T.StructField("nome", T.StringType()),
])

RECORD_STRUCTS = {
    "unidadeOrgao": UNIT,
    "orgaoEntidade": AGENCY,
    "amparoLegal": LEGAL_BASIS,
    "unidadeSubRogada": UNIT,
    "orgaoSubRogado": AGENCY,
}
RECORD_ARRAYS = {"fontesOrcamentarias": BUDGET_SOURCE}

NOTICE = T.StructType([
    T.StructField("numeroCompra", T.StringType()),
    T.StructField("objetoCompra", T.StringType()),
    T.StructField("valorTotalEstimado", T.DoubleType()),
    T.StructField("modalidadeId", T.LongType()),
    T.StructField("situacaoCompraId", T.LongType()),
    T.StructField("modoDisputaId", T.LongType()),
    T.StructField("criterioJulgamentoId", T.LongType()),
    T.StructField("instrumentoConvocatorioId", T.LongType()),
    *[T.StructField(n, t) for n, t in RECORD_STRUCTS.items()],
    *[T.StructField(n, T.ArrayType(t)) for n, t in RECORD_ARRAYS.items()],
])

CONTRACT_TABLE = T.StructType([
    T.StructField("numeroContrato", T.StringType()),
    T.StructField("objetoContrato", T.StringType()),
    T.StructField("valorContrato", T.DoubleType()),
    T.StructField("dataAssinatura", T.StringType()),
    T.StructField("modalidadeLicitacao", T.StringType()),
    T.StructField("dataPublicacao", T.StringType()),
    T.StructField("sequencialContratacao", T.LongType()),
    T.StructField("codigoUnidadeOrgao", T.StringType()),
    T.StructField("modalidade_nome_dominio", T.StringType()),
    T.StructField("modalidade_descricao_dominio", T.StringType()),
    T.StructField("situacao_compra_nome_dominio", T.StringType()),
    T.StructField("modo_disputa_nome_dominio", T.StringType()),
    T.StructField("criterio_julgamento_nome_dominio", T.StringType()),
    T.StructField("instrumento_convocatorio_nome_dominio", T.StringType()),
    T.StructField("esfera_nome_dominio", T.StringType()),
    T.StructField("poder_nome_dominio", T.StringType()),
    T.StructField("filtro_aplicado", T.BooleanType()),
    T.StructField("filtro_motivo", T.StringType()),
    T.StructField("filtro_grupo_matched", T.StringType()),
    T.StructField("filtro_termo_matched", T.StringType()),
    T.StructField("filtro_criterio", T.StringType()),
    T.StructField("extraction_date", T.StringType()),
    T.StructField("data_publicacao_control", T.StringType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
])

LEXICON_MAP = T.MapType(T.StringType(), T.ArrayType(T.StringType()))

VERDICT = T.StructType([
    T.StructField("decisao", T.StringType()),
    T.StructField("categoria", T.StringType()),
    T.StructField("confianca", T.LongType()),
    T.StructField("justificativa", T.StringType()),
    T.StructField("tokens_used", T.LongType()),
    T.StructField("response_time", T.DoubleType()),
    T.StructField("cached", T.BooleanType()),
])
