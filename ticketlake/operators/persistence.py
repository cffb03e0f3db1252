"""Keyed persistence: upsert, versioned history and validity dates, as whole-snapshot expressions."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketlake.functions.dates import timestamp_text
from ticketlake.functions.keys import sha256_key
from ticketlake.schemas import HISTORY, HISTORY_COLUMNS

#: What a row of the history is after a run: the open version as it was, closed by it, or opened by it.
_KEPT, _CLOSED, _NEW = 0, 1, 2


def upsert(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Target with the rows of `source` inserted or, column by column, updated.

    Columns that `source` does not bring keep their value; `source` has one row per key.
    """
    unknown = [c for c in source.columns if c not in target.columns]
    if unknown:
        raise ValueError(f"Columns unknown to the table: {unknown}")
    brought = [c for c in source.columns if c != key]
    types = dict(target.dtypes)
    incoming = source.select(
        F.col(key).cast(types[key]).alias(key), F.lit(True).alias("_veio"),
        *[F.col(c).cast(types[c]).alias(f"_novo_{c}") for c in brought],
    )
    merged = target.join(incoming, key, "full")
    return merged.select(
        *[
            F.when(F.col("_veio"), F.col(f"_novo_{c}")).otherwise(F.col(c)).alias(c) if c in brought else F.col(c)
            for c in target.columns
        ]
    )


def _as_text(df: DataFrame, name: str) -> Column:
    kind = dict(df.dtypes)[name]
    return timestamp_text(F.col(name)) if kind.startswith("timestamp") else F.col(name).cast("string")


def payload_json(df: DataFrame, columns: Sequence[str]) -> Column:
    """Row as JSON text with sorted keys and nulls written out."""
    cells = [_as_text(df, c).alias(c) for c in sorted(columns)]
    return F.to_json(F.struct(*cells), {"ignoreNullFields": "false"})


def with_version_hash(df: DataFrame) -> DataFrame:
    """Add the hash over the business columns and the full row as JSON."""
    absent = [c for c in HISTORY_COLUMNS if c not in df.columns]
    full = df.withColumns({c: F.lit(None).cast(HISTORY[c]) for c in absent}) if absent else df
    return full.withColumns(
        {
            "hash_dados": F.sha2(payload_json(full, HISTORY_COLUMNS), 256),
            "payload_json": payload_json(full, full.columns),
        }
    )


def changed_tickets(history: DataFrame, current: DataFrame) -> DataFrame:
    """Current rows that are new or differ from their active version, hash and payload included."""
    hashed = with_version_hash(current)
    active = history.filter(F.col("flag_ativo") == 1).select("ticket_id", F.col("hash_dados").alias("_vigente"))
    joined = hashed.join(active, "ticket_id", "left")
    return joined.filter(F.col("_vigente").isNull() | (F.col("_vigente") != F.col("hash_dados"))).drop("_vigente")


def scd2(history: DataFrame, current: DataFrame, run_id: str, at: datetime) -> DataFrame:
    """History after a run: replaced versions closed, changed and new tickets opened.

    One full join of open versions with current rows; each pair gives the open version as it was, or closed beside its
    successor. Tickets that no longer arrive keep their open version; closed versions pass by untouched. The join carries
    flat columns, so a reader of a few of them shuffles no more than these.
    """
    moment = F.lit(at).cast("timestamp_ntz")
    opened = with_version_hash(current).select(
        sha256_key(F.col("ticket_id"), timestamp_text(moment), F.col("hash_dados")).alias("ticket_hist_id"),
        *HISTORY_COLUMNS,
        moment.alias("data_inicio_vigencia"),
        F.lit(None).cast("timestamp_ntz").alias("data_fim_vigencia"),
        F.lit(1).alias("flag_ativo"),
        F.lit(run_id).alias("run_id"),
        "hash_dados",
        "payload_json",
    ).select(*[F.col(c).cast(k).alias(c) for c, k in HISTORY.items()])
    is_open = F.coalesce(F.col("flag_ativo") == 1, F.lit(False))
    now = history.filter(is_open).select(*[F.col(c).alias(f"_a_{c}") for c in HISTORY], F.lit(True).alias("_aberta"))
    come = opened.select(*[F.col(c).alias(f"_n_{c}") for c in HISTORY], F.lit(True).alias("_nova"))
    met = now.join(come, F.col("_a_ticket_id") == F.col("_n_ticket_id"), "full")
    same = F.coalesce(F.col("_a_hash_dados") == F.col("_n_hash_dados"), F.lit(False))
    versions = (
        F.when(F.col("_aberta").isNull(), F.array(F.lit(_NEW)))
        .when(F.col("_nova").isNull() | same, F.array(F.lit(_KEPT)))
        .otherwise(F.array(F.lit(_CLOSED), F.lit(_NEW)))
    )
    version = F.col("_versao")
    closing = {"data_fim_vigencia": moment, "flag_ativo": F.lit(0)}
    cells = [
        F.when(version == _NEW, F.col(f"_n_{c}"))
        .when(version == _CLOSED, closing.get(c, F.col(f"_a_{c}")))
        .otherwise(F.col(f"_a_{c}")).cast(k).alias(c)
        for c, k in HISTORY.items()
    ]
    after = met.withColumn("_versao", F.explode(versions)).select(*cells)
    return history.filter(~is_open).select(*HISTORY).unionByName(after)


def sync_validity(tickets: DataFrame, loaded: DataFrame, changed: DataFrame, at: datetime) -> DataFrame:
    """Validity of the current rows: changed tickets start now, other loaded ones keep their start."""
    moment = F.lit(at).cast("timestamp_ntz")
    marks = (
        loaded.select("ticket_id", F.lit(False).alias("_mudou"))
        .unionByName(changed.select("ticket_id", F.lit(True).alias("_mudou")))
        .groupBy("ticket_id").agg(F.max("_mudou").alias("_mudou"))
    )
    joined = tickets.join(marks, "ticket_id", "left")
    arrived = F.col("_mudou").isNotNull()
    start = F.when(F.col("_mudou"), moment).when(arrived, F.coalesce("data_inicio_vigencia", moment))
    return joined.withColumns(
        {
            "data_inicio_vigencia": start.otherwise(F.col("data_inicio_vigencia")),
            "data_fim_vigencia": F.when(arrived, F.lit(None)).otherwise(F.col("data_fim_vigencia")),
            "flag_ativo": F.when(arrived, F.lit(1)).otherwise(F.col("flag_ativo")),
        }
    ).select(*tickets.columns)
