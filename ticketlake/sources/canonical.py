"""From raw headers and untyped cells to canonical typed columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketlake.functions.dates import parse_timestamp, timestamp_text
from ticketlake.functions.text import blank_to_null
from ticketlake.schemas import EXPLICIT_LINK_COLUMNS, TS
from ticketlake.sources.files import header_name


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def headers_by_name(df: DataFrame) -> dict[str, list[str]]:
    """Normalised header -> raw headers, in column order."""
    found: dict[str, list[str]] = {}
    for raw in df.columns:
        found.setdefault(header_name(raw), []).append(raw)
    return found


def normalize_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[header_name(name) for name in df.columns])


def to_long(c: Column) -> Column:
    """Whole number of a numeric text such as `12` or `12.0`; anything else is null."""
    return c.cast("string").try_cast("double").try_cast("bigint")


def _typed(c: Column, kind: str) -> Column:
    if kind == "bigint":
        return to_long(c)
    if kind == TS:
        return parse_timestamp(c)
    return c.cast(kind)


def canonicalize(
    df: DataFrame, aliases: Mapping[str, str], schema: Mapping[str, str], keep_extra: bool = False
) -> DataFrame:
    """One projection: rename by alias, add absent columns as null, cast safely, fix the order.

    Raw headers that mean the same column are merged, first filled one wins. `keep_extra` keeps the
    other raw columns under their normalised names.
    """
    raw_of: dict[str, list[str]] = {}
    for name, raws in headers_by_name(df).items():
        raw_of.setdefault(aliases.get(name, name), []).extend(raws)
    types = dict(df.dtypes)
    columns = []
    for name, kind in schema.items():
        raws = raw_of.pop(name, [])
        if not raws:
            columns.append(F.lit(None).cast(kind).alias(name))
            continue
        cells = [quoted(r) if types[r] == kind else _typed(quoted(r), kind) for r in raws]
        columns.append((F.coalesce(*cells) if len(cells) > 1 else cells[0]).alias(name))
    if keep_extra:
        columns += [F.coalesce(*[quoted(r) for r in raws]).alias(name) for name, raws in raw_of.items()]
    return df.select(*columns)


def conform(df: DataFrame, schema: Mapping[str, str]) -> DataFrame:
    """Exactly the columns of a stored table: absent ones null, others dropped."""
    have = set(df.columns)
    return df.select(
        *[(F.col(n).cast(k) if n in have else F.lit(None).cast(k)).alias(n) for n, k in schema.items()]
    )


def with_required(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Set a column and drop the rows where it is null, computing it once.

    A filter would be pushed below the projection and compute an expensive value again; the generator
    does both in one step.
    """
    others = [quoted(c) for c in df.columns if c != name]
    return df.select(*others, F.explode(F.array_compact(F.array(value))).alias(name))


def coerce_ids(df: DataFrame, column: str) -> DataFrame:
    """Keep rows whose id is a number, as a whole number."""
    return df.withColumn(column, to_long(F.col(column))).filter(F.col(column).isNotNull())


def coerce_timestamps(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.withColumns({c: parse_timestamp(F.col(c)) for c in columns})


def serialize_timestamps(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    have = set(df.columns)
    return df.withColumns({c: timestamp_text(F.col(c)) for c in columns if c in have})


def channel_coalesce(df: DataFrame) -> DataFrame:
    """Channel of the ticket, else its request class, else its friction channel (null test only)."""
    return df.withColumn(
        "tipo_solicitacao", F.coalesce("tipo_solicitacao", "classificacao_solicitacoes", "canais_de_atrito")
    )


def explicit_link_key(df: DataFrame) -> Column:
    """First filled candidate column that the frame has."""
    raws = headers_by_name(df)
    cells = [blank_to_null(quoted(raws[name][0])) for name in EXPLICIT_LINK_COLUMNS if name in raws]
    return F.coalesce(*cells) if cells else F.lit(None).cast("string")
