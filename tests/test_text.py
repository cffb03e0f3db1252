"""Column functions against plain Python on edge values."""

import re
import unicodedata
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from ticketlake.functions import dates as D
from ticketlake.functions import text as T

VALUES = [
    None, "", "   ", "São José  ", "a    b\tc", "40001.0", "40.01", "123.00", "Cobrança - 2024/02!", "\xa0nbsp\xa0x\xa0",
    "é decomposto", "ﬁm de ½ mês…", "linha\nquebra\r\n", " largo　", "ÇÃÕÜñ", "nan", "None", "日本", "a\x1cb",
]


def norm(value):
    if value is None or not value.strip():
        return None
    text = unicodedata.normalize("NFKD", value.strip()).encode("ascii", "ignore").decode()
    return re.sub(r"\s+", " ", text).strip().upper() or None


def column(spark, fn, values=VALUES):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in rows.orderBy("i").select(fn(F.col("v"))).collect()]


def test_norm_text(spark):
    assert column(spark, T.norm_text) == [norm(v) for v in VALUES]


def test_every_decomposition(spark):
    """All characters of all planes whose decomposition keeps ASCII, in lots, and the two forms in one text."""
    chars = [chr(c) for c in range(0x80, 0x110000) if unicodedata.decomposition(chr(c))]
    lots = ["ⅫⅫ ㎏ ⅓ ạ 𝐀 Œ ㏂ ℡ ǆ"] + ["x" + "|".join(chars[k : k + 200]) for k in range(0, len(chars), 200)]
    assert norm(lots[0]) == "XIIXII KG 13 A A A.M. TEL DZ"
    assert column(spark, T.norm_text, lots) == [norm(v) for v in lots]


def test_norm_identifier(spark):
    expected = [None if norm(v) is None else re.sub(r"\.0+$", "", norm(v)) for v in VALUES]
    assert column(spark, T.norm_identifier) == expected


def test_subject_and_tokens(spark):
    assert column(spark, T.norm_subject, ["Cobrança - 2024/02!", "--", None]) == ["COBRANCA 2024 02", None, None]
    assert column(spark, T.token_set, ["a be cde cde", None, "zz"]) == [["CDE"], [], []]


def test_territory(spark):
    got = column(spark, lambda c: T.territory(T.norm_identifier(c)), ["40123", "10987", "99999", "40123.0", None])
    assert got == ["Bloco 4", "Bloco 1", None, "Bloco 4", None]


def test_last_segment(spark):
    values = ["A::B:: C ", "X", "A::", " ", None]
    assert column(spark, T.last_segment, values) == ["C", "X", "A::", " ", None]
    assert column(spark, lambda c: T.last_segment(c, missing="N"), values) == ["C", "X", "A::", "N", "N"]
    assert column(spark, lambda c: T.last_segment(c, empty_tail="empty"), values) == ["C", "X", "", "", None]


def test_norm_class_and_keys(spark):
    assert column(spark, T.norm_class, ["Canais::[routing] Cedoc", "[x]", None]) == ["CEDOC", None, None]
    assert column(spark, T.join_key_text, [" 12.0", "nan", "null", "", "ab ", None]) == ["12.0".replace(".0", ""), None, None, None, "AB", None]


def test_clean(spark):
    assert column(spark, T.clean_ws, [" a\xa0 b\n", "\xa0", None]) == ["a b", None, None]
    values = ["X::ﬁ ça", "é::ûm", "A::", None, "straße"]

    def expected(v):
        if v is None:
            return None
        v = " ".join(v.replace("\xa0", " ").split())
        v = v.split("::")[-1].strip() if "::" in v else v
        v = " ".join(unicodedata.normalize("NFKC", v).split())
        return v.upper() or None

    assert column(spark, T.clean_subject, values) == [expected(v) for v in values]


def test_first_nonblank(spark):
    row = spark.createDataFrame([(None, "  ", "x ", "y"), (" ", "", None, None)], "a string, b string, c string, d string")
    got = [r[0] for r in row.select(T.first_nonblank(*[F.col(c) for c in "abcd"])).collect()]
    assert got == ["x", None]


def test_exact_rounding(spark):
    values = [0.125, 0.375, 0.145, 0.165, 0.65625, 1.0, 0.0, 1 / 3, 0.63375, 7 / 40]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double").orderBy("i")
    got = [tuple(r) for r in df.select(T.fixed2(F.col("v")), T.round4(F.col("v"))).collect()]
    assert got == [(f"{v:.2f}", round(v, 4)) for v in values]


def test_timestamps(spark):
    got = column(spark, lambda c: D.timestamp_text(D.parse_timestamp(c)), ["2024-03-15 10:30:00", "nao eh data", "03/05/2026 10:00", None])
    assert got == ["2024-03-15 10:30:00", None, "2026-03-05 10:00:00", None]


def test_weeks(spark):
    days = [date(2018, 1, 1) + timedelta(days=i) for i in range(0, 4700)]
    df = spark.createDataFrame([(d,) for d in days], "d date").orderBy("d")
    got = [r[0] for r in df.select(D.week_label(F.col("d"))).collect()]
    assert got == [d.strftime("%Y-S%W") for d in days]


def test_holidays_and_windows(spark):
    feriados = {r[0] for r in D.holiday_calendar(D.year_spine(spark, 2024, 2026)).collect()}
    assert {date(2024, 2, 12), date(2024, 2, 13), date(2024, 3, 29), date(2024, 5, 30), date(2025, 4, 18), date(2026, 4, 3)} <= feriados
    window = D.report_window(spark, date(2024, 2, 14))  # Wednesday after Carnival
    assert window["business_day"] == date(2024, 2, 9)
    assert (window["idle_start"], window["idle_end"]) == (date(2024, 2, 10), date(2024, 2, 13))
    assert window["week_end"] == date(2024, 2, 16)
    assert D.report_window(spark, date(2024, 5, 25))["week_end"] == date(2024, 5, 25)
    assert D.report_window(spark, date(2024, 5, 23))["idle_start"] is None
    assert D.previous_business_week(date(2026, 5, 13)) == (date(2026, 5, 4), date(2026, 5, 8))


def test_periods():
    today = date(2026, 5, 13)
    assert D.resolve_period(today) == (date(2026, 5, 6), date(2026, 5, 12))
    with pytest.raises(ValueError):
        D.resolve_period(today, start=today)
    with pytest.raises(ValueError):
        D.resolve_period(today, today, today)
    with pytest.raises(ValueError):
        D.resolve_period(today, date(2026, 5, 2), date(2026, 5, 1))
