"""What steps carry and keep, so that their figures grow no faster than their input."""

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ticketlake.functions import text
from ticketlake.operators import dedup, distinct, orders, persistence
from ticketlake.plans import marts
from ticketlake.schemas import HISTORY, HISTORY_COLUMNS
from ticketlake.session import cut_lineage, empty_frame, ensure_checkpoint_dir, settle

AT = datetime(2024, 5, 1, 6, 0, 0)


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def size(folder: str) -> int:
    return sum(os.path.getsize(os.path.join(at, name)) for at, _, names in os.walk(folder.removeprefix("file:")) for name in names)


def test_settled_rows_are_small_and_complete(spark):
    ids = F.col("id")
    wide = spark.range(200_000).select(
        "id", *[F.lit(None).cast("string").alias(f"vazia_{i}") for i in range(40)],
        *[F.concat(F.lit("texto "), ids % 7).alias(f"texto_{i}") for i in range(20)],
    ).groupBy("id").agg(*[F.max(f"vazia_{i}").alias(f"vazia_{i}") for i in range(40)], *[F.max(f"texto_{i}").alias(f"texto_{i}") for i in range(20)])
    folder = ensure_checkpoint_dir(spark)
    before = size(folder)
    cut_lineage(wide)
    checkpointed = size(folder) - before
    kept = settle(wide)
    settled = size(folder) - before - checkpointed
    assert kept.schema.names == wide.schema.names and kept.count() == 200_000
    assert kept.exceptAll(wide).isEmpty()
    assert settled * 5 < checkpointed, (settled, checkpointed)


def test_joins_with_empty_tables_are_dropped(spark):
    target = empty_frame(spark, {"k": "bigint", "a": "string", "b": "int"})
    source = spark.range(10).select(F.col("id").alias("k"), F.lit("x").alias("a"))
    merged = persistence.upsert(target, source, "k")
    assert "Join" not in optimized(merged)
    assert sorted(map(tuple, merged.collect())) == [(i, "x", None) for i in range(10)]


def test_history_shuffles_only_what_is_read(spark):
    def day(status):
        columns = {c: F.lit(None).cast(HISTORY[c]) for c in HISTORY_COLUMNS}
        columns["ticket_id"] = F.col("id")
        return spark.range(6).withColumns({**columns, "status": status}).select(*HISTORY_COLUMNS)

    opened = settle(persistence.scd2(empty_frame(spark, HISTORY), day(F.lit("OPEN")), "r1", AT))
    status = F.when(F.col("id") < 2, "SOLVED").otherwise("OPEN")
    after = persistence.scd2(opened, day(status).filter("ticket_id <> 5"), "r2", AT)
    assert sorted((r.ticket_id, r.status, r.flag_ativo, r.run_id) for r in after.collect()) == [
        (0, "OPEN", 0, "r1"), (0, "SOLVED", 1, "r2"), (1, "OPEN", 0, "r1"), (1, "SOLVED", 1, "r2"),
        *[(i, "OPEN", 1, "r1") for i in (2, 3, 4, 5)],
    ]
    assert "payload_json" not in optimized(after.select("ticket_id", "flag_ativo")).split("Relation")[0]


def test_sparse_cells_take_no_more_than_their_rows(spark):
    rows = spark.range(5_000).select((F.col("id") * 40_000).alias("k"), (F.col("id") % 900).alias("dia"))
    cells = distinct.distinct_cells(rows, F.col("k"), ("dia",))
    assert dict(cells.dtypes)[distinct.MEMBERS] == "bigint"
    assert cells.count() == 5_000
    assert distinct.count_cells(cells, ("dia",), "n").agg(F.sum("n")).first()[0] == 5_000


def test_subject_keys_are_those_of_the_subject_rows(spark):
    ids = F.col("id")
    feed = spark.range(400).select(
        F.when(ids % 50 == 0, None).otherwise(ids % 90).alias("ticket_id"), F.lit("f").alias("formulario_ticket"),
        F.when(ids % 4 == 0, " ").otherwise(F.concat(F.lit("Água "), ids % 3)).alias("assunto"),
        F.when(ids % 8 == 0, None).otherwise(F.lit("agua 1!")).alias("titulo"),
        F.lit(AT).alias("arquivo_mtime"), F.lit("a").alias("arquivo_origem"), ids.alias("row_seq"),
    )
    keys = dedup.subject_keys(feed)
    whole = dedup.ticket_subjects(feed).select("ticket_id", "assunto_normalizado")
    assert sorted(keys.collect()) == sorted(whole.collect())
    assert "Window" not in optimized(keys)


@pytest.mark.parametrize("absent_accounts", [orders.ABSENT_ACCOUNTS, 0])
def test_orders_of_accounts_without_tickets_are_dropped_either_way(spark, absent_accounts):
    cells = [("A1.0", 1), (" a2 ", 2), ("A3", 3), (None, 4), (" ", 5), ("A1", 6)]
    feed = spark.createDataFrame(cells, "`Matrícula` string, n int")
    tickets = spark.createDataFrame([("A1",), ("a2.0",), (None,), (" ",)], "matricula string")
    kept = orders.semi_filter_orders(feed, tickets, absent_accounts)
    assert sorted(r.n for r in kept.collect()) == [1, 2, 6]
    assert ("LeftAnti" in optimized(kept)) == (absent_accounts > 0)


def test_exact_match_ranks_only_given_numbers(spark):
    found = [("7", "A", "g1", AT), ("7", "B", "g2", AT), ("8", "A", "g3", AT)]
    prepared = spark.createDataFrame(found, "numero_os string, matricula string, gss_os_id string, data_emissao timestamp_ntz")
    asked = spark.createDataFrame([(1, "A", "7"), (2, "C", "7"), (3, "A", "9")], "ticket_id bigint, matricula string, numero_os_original string")
    folder = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    matched = orders.match_exact(asked, prepared)
    assert sorted(map(tuple, matched.collect())) == [(1, "g1"), (2, "g2"), (3, None)]
    (ranked,) = set(os.listdir(folder)) - before
    assert spark.read.parquet(f"{folder}/{ranked}").count() == 2


def test_sanitized_rows_are_shuffled_once_before_they_are_ordered(spark):
    hearing = ("local_procon", "audiencia", "tipo_audiencia", "data_audiencia", "preposto", "data_reagendamento")
    extra = ("protocolo_referencia_informado", "protocolo_procon", "protocolo_defensoria", "protocolo_codecon", "classificacao_notificacoes")
    kinds = {c: "string" for c in (*marts.SANITIZED_COLUMNS, *extra) if c not in (*hearing, "protocolo_referencia")}
    kinds |= {"ticket_id": "bigint", "data_criacao": "timestamp_ntz", "data_resolucao": "timestamp_ntz", "flag_arquivado_relatorio": "int"}

    def side(rows):
        given = spark.createDataFrame(rows, "ticket_id bigint, case_id string")
        return given.select(*[F.col(c) if c in given.columns else F.lit(AT if "data" in c else "X" if c == "titulo" else None).cast(k).alias(c) for c, k in kinds.items()])

    # 3 stands in both tables with different cases, 4 has two hearings, 5 has a hearing and no ticket.
    requests, notices = side([(1, "a"), (2, None), (3, "b"), (4, "d")]), side([(3, "c"), (6, "a")])
    held = spark.createDataFrame([(3, "P3"), (4, "P4"), (4, "P5"), (5, "P6")], "ticket_id bigint, local_procon string")
    held = held.select("*", *[F.lit(None).cast("timestamp_ntz" if c.startswith("data_") else "string").alias(c) for c in hearing[1:]])
    cases = spark.createDataFrame([("a", "n1"), ("b", "n2"), ("c", "n3"), ("d", None), ("e", "n4")], "case_id string, protocolo_agenersa string")
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        base = marts.sanitized_base(requests, notices, held, cases)
        mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        formatted = base._jdf.queryExecution().explainString(mode)
        rows = [(r.ticket_id, r.case_id, r.protocolo_referencia, r.local_procon) for r in base.collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    assert [r[0] for r in rows] == [6, 4, 4, 3, 3, 2, 1]
    assert sorted(rows, key=str) == sorted(
        [(1, "a", "n1", None), (2, None, None, None), (3, "b", "n2", "P3"), (3, "c", "n3", "P3"), (4, "d", None, "P4"), (4, "d", None, "P5"), (6, "a", "n1", None)], key=str
    )
    wide = [part for part in formatted.split("\n\n") if "hashpartitioning" in part and "titulo" in part.split("Arguments")[0]]
    assert len(wide) == 1, len(wide)


def test_cleaned_text_is_the_same_with_and_without_the_short_way(spark):
    parts = ["a", "B c", " ", "  ", "\t", "\x1c", "\x1f", "\n", "\xa0", "\u2003", "\x85", "á", ""]
    cells = [(a + b + c,) for a in parts for b in parts for c in parts] + [(None,)]
    df = spark.createDataFrame(cells, "c string")
    for r in df.select("c", text.clean_ws(F.col("c")).alias("limpo")).collect():
        assert r.limpo == (" ".join(r.c.split()) or None if r.c is not None else None), repr(r.c)
