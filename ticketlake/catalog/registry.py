"""Named queries and, beside each, the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketlake.catalog import inputs
from ticketlake.functions.dates import timestamp_text

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def dates_as_text(df: DataFrame) -> DataFrame:
    """Dates and timestamps as ISO text, the way reports and stored tables show them."""
    columns = []
    for name, kind in df.dtypes:
        if kind == "date":
            columns.append(F.col(name).cast("string").alias(name))
        elif kind.startswith("timestamp"):
            columns.append(timestamp_text(F.col(name)).alias(name))
        else:
            columns.append(F.col(name))
    return df.select(*columns)


def query(name: str, sql: str | None = None, days: Sequence[str] = (), stamps: Sequence[str] = ()):
    """Register a query. `sql` may use the input views by name; `days` and `stamps` are its date columns."""

    def register(build: Query) -> Query:
        QUERIES[name] = lambda spark, sf: dates_as_text(build(spark, sf))
        if sql is not None:
            shown = [f"CAST({c} AS VARCHAR) AS {c}" for c in days]
            shown += [f"strftime({c}, '%Y-%m-%d %H:%M:%S') AS {c}" for c in stamps]
            body = f"SELECT * REPLACE ({', '.join(shown)}) FROM (\n{sql}\n)" if shown else sql
            ORACLES[name] = inputs.with_views(body)
        return build

    return register
