"""Keyed deduplication and per-ticket subjects.

Every keep-one step is a `row_number() = 1` filter. Spark limits each key to one row before the
shuffle as well as after it, so a key that holds a third of all rows sends one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ticketlake.functions.keys import sha256_key
from ticketlake.functions.text import first_nonblank, norm_subject
from ticketlake.sources.canonical import with_required


def keep_one(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    rank = "_rank"
    return (
        df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
        .filter(F.col(rank) == 1)
        .drop(rank)
    )


def dedup_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Last row per key in the given order; a missing order value counts as latest.

    The last order column must be unique inside a key (such as `row_seq`).
    """
    have = set(df.columns)
    return keep_one(df, keys, [F.col(c).desc_nulls_first() for c in order if c in have])


def dedup_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row per key in the given order; a missing order value counts as latest."""
    return keep_one(df, keys, [F.col(c).asc_nulls_last() for c in order])


def ticket_subjects(df: DataFrame, tie_break: Sequence[str] = ("row_seq",)) -> DataFrame:
    """One row per ticket and normalised subject, principal subject first.

    The principal subject is the one on the latest row of the ticket; the others follow newest first,
    then by name.
    """
    needed = ["ticket_id", "formulario_ticket", "arquivo_mtime", "arquivo_origem", *tie_break]
    subject = df.filter(F.col("ticket_id").isNotNull()).select(
        *dict.fromkeys(needed), first_nonblank(F.col("assunto"), F.col("titulo")).alias("assunto_raw")
    )
    subject = with_required(subject, "assunto_normalizado", norm_subject(F.col("assunto_raw")))
    latest = dedup_latest(subject, ["ticket_id", "assunto_normalizado"], ["arquivo_mtime", *tie_break])
    newest = [F.col(c).desc_nulls_first() for c in ("arquivo_mtime", *tie_break)]
    by_ticket = Window.partitionBy("ticket_id")
    principal = F.first("assunto_normalizado").over(by_ticket.orderBy(*newest))
    place = [
        F.col("_principal").desc(), F.col("arquivo_mtime").desc_nulls_last(), F.col("assunto_normalizado").asc(),
    ]
    return (
        latest.withColumn("_principal", (F.col("assunto_normalizado") == principal).cast("int"))
        .withColumn("ordem_assunto", F.row_number().over(by_ticket.orderBy(*place)))
        .select(
            sha256_key(F.col("ticket_id"), F.col("assunto_normalizado")).alias("ticket_assunto_id"),
            "ticket_id",
            "formulario_ticket",
            "assunto_raw",
            "assunto_normalizado",
            "ordem_assunto",
            (F.col("ordem_assunto") == 1).cast("int").alias("flag_assunto_principal"),
            "arquivo_origem",
        )
    )


def subject_keys(df: DataFrame) -> DataFrame:
    """Ticket and normalised subject of every row that `ticket_subjects` gives, for readers who only count them.

    Distinct pairs fold in tasks before the shuffle; no row is ordered, so neither texts nor tie-breaks are carried.
    """
    text = df.filter(F.col("ticket_id").isNotNull()).select("ticket_id", first_nonblank(F.col("assunto"), F.col("titulo")).alias("_texto"))
    return with_required(text, "assunto_normalizado", norm_subject(F.col("_texto"))).select("ticket_id", "assunto_normalizado").distinct()


def subject_metrics(subjects: DataFrame) -> DataFrame:
    return (
        subjects.groupBy("ticket_id")
        .agg(F.count(F.lit(1)).cast("int").alias("qtde_assuntos_ticket"))
        .withColumn("flag_multiplos_assuntos", (F.col("qtde_assuntos_ticket") > 1).cast("int"))
    )


def attach_subject_metrics(tickets: DataFrame, subjects: DataFrame) -> DataFrame:
    """Subject counts on tickets; tickets without subject rows count one."""
    return tickets.join(subject_metrics(subjects), "ticket_id", "left").withColumns(
        {
            "qtde_assuntos_ticket": F.coalesce("qtde_assuntos_ticket", F.lit(1)),
            "flag_multiplos_assuntos": F.coalesce("flag_multiplos_assuntos", F.lit(0)),
        }
    )


def pivot_subjects(df: DataFrame, order: Sequence[str], width: int | None = None) -> DataFrame:
    """Subject rows of a ticket as columns `assunto_1..n`, beside the ticket's first row.

    `width` is the longest subject list; when not given it is read with one aggregate.
    """
    by_ticket = Window.partitionBy("ticket_id").orderBy(*[F.col(c).asc_nulls_last() for c in order])
    listed = (
        df.filter(F.col("ticket_id").isNotNull() & F.col("assunto").isNotNull())
        .select("ticket_id", "assunto", F.row_number().over(by_ticket).alias("posicao"))
    )
    if width is None:
        sizes = df.filter(F.col("assunto").isNotNull() & F.col("ticket_id").isNotNull()).groupBy("ticket_id").count()
        width = sizes.agg(F.max("count")).first()[0] or 0
    wide = listed.groupBy("ticket_id").pivot("posicao", list(range(1, width + 1))).agg(F.first("assunto"))
    wide = wide.select("ticket_id", *[F.col(str(i)).alias(f"assunto_{i}") for i in range(1, width + 1)])
    base = dedup_first(df.drop("assunto"), ["ticket_id"], order)
    return base.join(wide, "ticket_id", "left")


def distinct_customers(requests: DataFrame, notices: DataFrame) -> DataFrame:
    both = requests.select("matricula").union(notices.select("matricula"))
    return both.filter(F.col("matricula").isNotNull()).distinct()


def distinct_cases(requests: DataFrame, notices: DataFrame) -> DataFrame:
    """One row per case; the protocol is the same on every ticket of a regulator case."""
    both = requests.select("case_id", "protocolo_agenersa").union(notices.select("case_id", "protocolo_agenersa"))
    return both.filter(F.col("case_id").isNotNull()).groupBy("case_id").agg(
        F.max("protocolo_agenersa").alias("protocolo_agenersa")
    )
