"""Star of derived tables for reporting: fact, calendar, categories, agencies, summary."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed_values as V
from ..functions.dates import calendar, parse_date
from ..functions.text import classify_text, yes_no
from ..operators.reports import distinct_dimension, fact_summary

# Fact columns by their reporting names (fixed values).
FACT_NAMES = {
    "numeroContrato": "Número do Contrato",
    "objetoContrato": "Objeto do Contrato",
    "valorContrato": "Valor do Contrato",
    "dataAssinatura": "Data Assinatura",
    "dataPublicacao": "Data Publicação",
    "sequencialContratacao": "Sequencial",
    "codigoUnidadeOrgao": "Código Unidade",
    "modalidadeLicitacao": "Modalidade",
    "modalidade_nome_dominio": "Nome Modalidade",
    "situacao_compra_nome_dominio": "Situação",
    "esfera_nome_dominio": "Esfera",
    "poder_nome_dominio": "Poder",
    "filtro_aplicado": "Filtro Aplicado",
    "filtro_motivo": "Motivo Filtro",
    "filtro_grupo_matched": "Grupo Matched",
    "filtro_termo_matched": "Termo Matched",
    "extraction_date": "Data Extração",
    "year": "Ano",
    "month": "Mês",
}
DATE_COLUMNS = ("dataAssinatura", "dataPublicacao")
FLAG_COLUMNS = ("filtro_aplicado",)
PUBLISHED = FACT_NAMES["dataPublicacao"]


def fact_table(
    contracts: DataFrame, names: Mapping[str, str] = FACT_NAMES, dates: Sequence[str] = DATE_COLUMNS,
    flags: Sequence[str] = FLAG_COLUMNS, text: str = "objetoContrato", class_name: str = "Categoria Contrato",
) -> DataFrame:
    """Renamed columns, parsed dates, labelled flags, and the text class of each row."""
    out = []
    for src, name in names.items():
        c = F.col(src)
        if src in dates:
            c = parse_date(c)
        elif src in flags:
            c = yes_no(c, V.YES, V.NO)
        out.append(c.alias(name))
    out.append(classify_text(text, V.CLASS_WORDS, V.CLASS_OTHER).alias(class_name))
    return contracts.select(*out)


def dimensions(fact: DataFrame) -> dict[str, DataFrame]:
    """calendar, modalities, agencies and summary, each a plan over the fact."""
    return {
        "calendar": calendar(fact, PUBLISHED),
        "modalities": distinct_dimension(fact, ["Modalidade", "Nome Modalidade"]),
        "agencies": distinct_dimension(fact, ["Esfera", "Poder", "Código Unidade"]),
        "summary": fact_summary(
            fact, ["Ano", "Mês", "Modalidade", "Categoria Contrato", "Esfera"], "Número do Contrato", "Valor do Contrato"),
    }


def build_star(contracts: DataFrame) -> dict[str, DataFrame]:
    """fact, calendar, modalities, agencies and summary, each a plan over the contracts; see :func:`store_star`."""
    fact = fact_table(contracts)
    return {"fact": fact, **dimensions(fact)}


def store_star(contracts: DataFrame, path: str, prefix: str, buckets: int = 200) -> dict[str, DataFrame]:
    """The star as catalog tables ``{prefix}_fact`` and so on below ``path``; the contracts are read once.

    The fact is written first and the other tables are made from what is stored. Fact and calendar share buckets of the
    publication date, sorted, so that a calendar too large to broadcast is joined without a shuffle. The smaller
    dimensions are broadcast if their stored size allows it. A date with very many rows becomes several files of
    its bucket, and where the calendar is broadcast, Spark reads the files evenly and not by bucket. Tables of
    the same names are replaced.
    """
    spark = contracts.sparkSession

    def put(df: DataFrame, name: str, key: str | None = None) -> DataFrame:
        if key:
            df = df.hint("rebalance", buckets, F.col(f"`{key}`"))
        writer = df.write.mode("overwrite").format("parquet").option("path", f"{path}/{name}")
        if key:
            writer = writer.bucketBy(buckets, key).sortBy(key)
        writer.saveAsTable(f"{prefix}_{name}")
        return spark.table(f"{prefix}_{name}")

    fact = put(fact_table(contracts), "fact", PUBLISHED)
    made = dimensions(fact)
    return {"fact": fact, **{name: put(df, name, "date" if name == "calendar" else None) for name, df in made.items()}}


def drop_star(spark: SparkSession, prefix: str) -> None:
    """Takes the tables of a star from the catalog; their files stay."""
    for name in ("fact", "calendar", "modalities", "agencies", "summary"):
        spark.sql(f"DROP TABLE IF EXISTS {prefix}_{name}")


def associate(fact: DataFrame, dim: DataFrame, on: Sequence[str] | Mapping[str, str]) -> DataFrame:
    """Left join of a dimension by shared column names, or by fact name to dim name; a null key has no partner."""
    pairs = dict(on) if isinstance(on, Mapping) else {c: c for c in on}
    right = dim.select(*[F.col(d).alias(f"_k_{d}") if d in pairs.values() else F.col(d) for d in dim.columns])
    tests = [fact[f] == right[f"_k_{d}"] for f, d in pairs.items()]
    return fact.join(right, tests, "left").drop(*[f"_k_{d}" for d in pairs.values()])
