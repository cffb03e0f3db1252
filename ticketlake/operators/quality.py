"""Intake contracts, profiles, reconciliation and quality indicators."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketlake.functions.text import blank_to_null
from ticketlake.schemas import CONTRACTS, Contract
from ticketlake.sources.canonical import headers_by_name, quoted

MISSING_COLUMNS, MISSING_DATA = "MISSING_REQUIRED_COLUMNS", "MISSING_CRITICAL_DATA"
# Columns and labels of the output.
MESSAGES = {
    MISSING_COLUMNS: "Colunas obrigatorias ausentes na fonte.",
    MISSING_DATA: "Nao ha dados preenchidos para um grupo critico do contrato.",
}


class ContractError(Exception):
    """A source broke its contract."""

    def __init__(self, source: str, issues: list[dict]):
        super().__init__(f"Falha de contrato na fonte '{source}': {issues}")
        self.source, self.issues = source, issues


def _names_of(column: str, contract: Contract) -> list[str]:
    return [column, *[alias for alias, name in contract.aliases.items() if name == column]]


def contract_issues(df: DataFrame, source: str, contract: Contract | None = None) -> DataFrame:
    """Issues of a source: (fonte, severidade, codigo, mensagem, colunas); none for an empty source.

    Columns are checked on the schema; whether any cell of each critical group is filled is one
    aggregate over the data for all groups together.
    """
    contract = contract or CONTRACTS[source]
    have = headers_by_name(df)

    def raws(column: str) -> list[str]:
        return [raw for name in _names_of(column, contract) for raw in have.get(name, [])]

    missing = [c for c in contract.required if not raws(c)]
    checks = []
    for group in contract.filled:
        cells = [blank_to_null(quoted(raw)).isNotNull() for column in group for raw in raws(column)]
        any_filled = reduce(lambda a, b: a | b, cells) if cells else F.lit(False)
        checks.append((", ".join(group), F.coalesce(F.bool_or(any_filled), F.lit(False))))
    results = df.agg(
        F.count(F.lit(1)).alias("_linhas"), *[check.alias(f"_g{i}") for i, (_, check) in enumerate(checks)]
    )
    issue = "struct({bad} AS falha, '{code}' AS codigo, '{message}' AS mensagem, '{columns}' AS colunas)"
    rows = [
        issue.format(bad=f"NOT _g{i}", code=MISSING_DATA, message=MESSAGES[MISSING_DATA], columns=name)
        for i, (name, _) in enumerate(checks)
    ]
    rows.insert(
        0,
        issue.format(
            bad=str(bool(missing)).lower(), code=MISSING_COLUMNS, message=MESSAGES[MISSING_COLUMNS],
            columns=", ".join(missing),
        ),
    )
    return (
        results.filter("_linhas > 0")
        .selectExpr(f"inline(array({', '.join(rows)}))")
        .filter("falha")
        .select(F.lit(source).alias("fonte"), F.lit("ERROR").alias("severidade"), "codigo", "mensagem", "colunas")
    )


def validate_or_raise(df: DataFrame, source: str) -> None:
    """Stop on a broken contract; the issue list has at most one row per rule of the contract."""
    issues = [row.asDict() for row in contract_issues(df, source).collect()]
    if issues:
        raise ContractError(source, issues)


def table_profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per column of each table: name, type, position, and the row count of its table."""
    profiles = []
    for table, df in tables.items():
        columns = ", ".join(
            f"struct('{name}' AS coluna, '{kind}' AS tipo, {i} AS posicao)"
            for i, (name, kind) in enumerate(df.dtypes, start=1)
        )
        profiles.append(
            df.agg(F.count(F.lit(1)).alias("linhas")).selectExpr(
                f"'{table}' AS tabela", "linhas", f"inline(array({columns}))"
            )
        )
    return reduce(DataFrame.unionByName, profiles)


def table_sample(df: DataFrame, limit: int = 20) -> DataFrame:
    """A few rows to look at."""
    if limit < 1:
        raise ValueError("limit must be at least 1")
    return df.limit(limit)


def reconcile(bronze: DataFrame, gold: DataFrame, subjects: DataFrame) -> DataFrame:
    """Distinct tickets before and after, those found on one side only, and subject counts; one row.

    One shuffle on the ticket id serves all counts.
    """
    sides = (
        bronze.select("ticket_id", F.lit(1).alias("b"), F.lit(0).alias("g"), F.lit(0).alias("s"))
        .unionAll(gold.select("ticket_id", F.lit(0), F.lit(1), F.lit(0)))
        .unionAll(subjects.select("ticket_id", F.lit(0), F.lit(0), F.lit(1)))
        .filter(F.col("ticket_id").isNotNull())
        .groupBy("ticket_id")
        .agg(F.max("b").alias("b"), F.max("g").alias("g"), F.sum("s").alias("s"))
    )
    in_b, in_g = F.col("b") == 1, F.col("g") == 1
    return sides.agg(
        F.count_if(in_b).alias("qtde_tickets_bronze"),
        F.count_if(in_g).alias("qtde_tickets_gold"),
        F.count_if(in_b & ~in_g).alias("somente_bronze"),
        F.count_if(in_g & ~in_b).alias("somente_gold"),
        F.coalesce(F.sum("s"), F.lit(0)).alias("qtde_assuntos"),
        F.count_if(F.col("s") > 1).alias("qtde_multiplos_assuntos"),
    )


def percent(part, whole):
    """Share in percent with two decimals; null for an empty whole."""
    return F.round(F.try_divide(F.lit(100.0) * part, whole), 2)


def quality_indicators(tickets: DataFrame) -> DataFrame:
    """Shares of valid accounts, order-enriched, consistently classified and archived tickets; one row."""
    every = F.count(F.lit(1))
    known_block = F.coalesce(F.col("bloco").isin("Bloco 1", "Bloco 4"), F.lit(False))
    enriched = F.col("gss_os_id").isNotNull()
    consistent = F.coalesce(F.col("flag_auditoria_classificacao"), F.lit(0)) == 0
    archived = F.coalesce(F.col("flag_arquivado_relatorio"), F.lit(0)) == 1
    return tickets.agg(
        every.alias("qtde_tickets"),
        percent(F.count_if(known_block), every).alias("pct_matricula_valida"),
        percent(F.count_if(enriched), every).alias("pct_enriquecido_gss"),
        percent(F.count_if(consistent), every).alias("pct_classificacao_consistente"),
        percent(F.count_if(archived), every).alias("taxa_arquivamento"),
    )
