"""Compare queries with their check SQL. Usage: python tests/compare.py SF_DIR [key ...]"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

from ticketlake.catalog.inputs import TABLES


def database(sf: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9) + 0.0)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def compare(spark, con, sf: str, build, sql: str) -> tuple[bool, str]:
    df = build(spark, sf)
    started = time.perf_counter()
    names, ours = rows_of(df.columns, [tuple(r) for r in df.collect()])
    spent = time.perf_counter() - started
    result = con.execute(sql)
    expected_names, theirs = rows_of([d[0] for d in result.description], result.fetchall())
    if names != expected_names:
        return False, f"columns {names} vs {expected_names}"
    if ours != theirs:
        extra, missing = list((ours - theirs).items())[:3], list((theirs - ours).items())[:3]
        return False, f"rows {sum(ours.values())} vs {sum(theirs.values())}; ours only {extra}; theirs only {missing}"
    return True, f"{sum(ours.values())} rows, spark {spent:.2f}s"


def main(sf: str, keys: list[str]) -> int:
    from ticketlake.catalog import ORACLES, QUERIES
    from ticketlake.session import build_session

    spark = build_session("compare", "local[8]", **{"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = database(sf)
    failed = []
    for key in keys or list(QUERIES):
        started = time.perf_counter()
        try:
            if key in ORACLES:
                good, note = compare(spark, con, sf, QUERIES[key], ORACLES[key])
            else:
                good, note = True, f"{len(QUERIES[key](spark, sf).collect())} rows, no check SQL"
        except Exception as error:
            good, note = False, f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{'ok  ' if good else 'FAIL'} {key} {time.perf_counter() - started:.2f}s {note}", flush=True)
        if not good:
            failed.append(key)
    print(f"{len(failed)} failed: {failed}")
    return len(failed)


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
