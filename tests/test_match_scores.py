"""Scores of orders: the best two of an account for each set of words, exact rounding, plain text."""

from datetime import date, datetime
from fractions import Fraction

from pyspark.sql import functions as F

from ticketlake.functions import text
from ticketlake.operators import orders

ORDERS = "matricula string, gss_os_id string, numero_os string, data_emissao timestamp_ntz, status_os_gss string, tokens_servico array<string>, dia_os date"


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_far_orders_are_found_without_a_row_for_every_pair(spark):
    day = datetime(2024, 3, 1)
    rows = [
        ("a", f"o{i:02d}", str(i), [None, day, datetime(2024, 3, 2)][i % 3], ["PENDENTE", "EXECUTADA", None][i % 2 + (i > 20)], [["X", "Y"], ["X"], []][i % 3], date(2024, 3, 1))
        for i in range(30)
    ] + [("b", "p", "1", None, None, [], None)]
    newest = spark.createDataFrame(rows, ORDERS)
    askers = spark.createDataFrame(
        [("a", ["X"], True), ("a", ["X", "Y", "Z"], False), ("a", [], True), ("b", ["X"], True), ("c", ["X"], True)],
        "matricula string, tokens array<string>, aberto boolean",
    )
    found = orders.far_orders(askers, newest)
    assert "Window" not in optimized(found)
    pairs = orders._ranked_two(askers.join(newest, "matricula"), ["matricula", "tokens", "aberto"])
    wanted = pairs.select("tokens", "aberto", *orders.ORDER_FIELDS)
    assert found.count() == 7 and found.exceptAll(wanted).isEmpty() and wanted.exceptAll(found).isEmpty()


def test_rounding_is_exact(spark):
    values = [i / 20000 for i in range(160, 20001, 5)] + [i / 1024 for i in range(1025)] + [1 / 3, 2 / 3, 0.125]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for digits in (2, 4):
        got = df.select("v", text.exact_units(F.col("v"), digits).alias("u")).collect()
        assert all(r.u == round(Fraction(r.v) * 10**digits) for r in got)


def test_marks_and_ligatures_beside_other_scripts(spark):
    said = {"ação": "ACAO", "½ xícara": "12 XICARA", "ﬁm": "FIM", "ﷺ": None, "Ĳ文ß": "IJ", "plain": "PLAIN"}
    got = {r.t: r.n for r in spark.createDataFrame([(k,) for k in said], "t string").select("t", text.norm_text(F.col("t")).alias("n")).collect()}
    assert got == said
