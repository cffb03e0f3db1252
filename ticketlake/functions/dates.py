"""Calendar and timestamp expressions."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# National holidays by (month, day), and days from Easter for the moving ones
# (Carnival Monday and Tuesday, Good Friday, Corpus Christi).
FIXED_HOLIDAYS = ((1, 1), (4, 21), (5, 1), (9, 7), (10, 12), (11, 2), (11, 15), (12, 25))
EASTER_OFFSETS = (-48, -47, -2, 60)
WEEKDAY_LABELS = ("Segunda-feira", "Terça-feira", "Quarta-feira", "Quinta-feira", "Sexta-feira")
WEEKDAY_NAMES = (
    "segunda-feira", "terça-feira", "quarta-feira", "quinta-feira", "sexta-feira", "sábado", "domingo",
)
MONTH_NAMES = (
    "Janeiro", "Fevereiro", "Marco", "Abril", "Maio", "Junho",
    "Julho", "Agosto", "Setembro", "Outubro", "Novembro", "Dezembro",
)
CALENDAR_MONTH_NAMES = (
    "janeiro", "fevereiro", "março", "abril", "maio", "junho",
    "julho", "agosto", "setembro", "outubro", "novembro", "dezembro",
)
TIMESTAMP_TEXT = "yyyy-MM-dd HH:mm:ss"
SLASH_FORMATS = ("MM/dd/yyyy HH:mm:ss", "MM/dd/yyyy HH:mm", "MM/dd/yyyy")


def parse_timestamp(c: Column, formats: tuple[str, ...] = SLASH_FORMATS) -> Column:
    """Zone-less timestamp from ISO text or one of `formats`; anything else is null."""
    text = c.cast("string")
    parsed = [text.try_cast("timestamp_ntz")]
    parsed += [F.try_to_timestamp(text, F.lit(f)).cast("timestamp_ntz") for f in formats]
    return F.coalesce(*parsed)


def timestamp_text(c: Column) -> Column:
    return F.date_format(c, TIMESTAMP_TEXT)


def day_of(c: Column) -> Column:
    """Calendar day of a timestamp, date or ISO text; bad text is null."""
    return c.try_cast("date")


def days_lag(later: Column, earlier: Column) -> Column:
    return F.datediff(F.to_date(later), F.to_date(earlier))


def week_monday(d: Column) -> Column:
    return F.date_sub(d, F.weekday(d))


def week_number(d: Column) -> Column:
    """Two-digit Monday week of the year, 00 before the first Monday."""
    return F.lpad(F.floor((F.dayofyear(d) + 6 - F.weekday(d)) / 7).cast("string"), 2, "0")


def week_label(d: Column) -> Column:
    return F.concat(F.date_format(d, "yyyy"), F.lit("-S"), week_number(d))


def name_from(index: Column, names: tuple[str, ...]) -> Column:
    """The label at a 1-based position, null outside the list."""
    return F.try_element_at(F.array(*[F.lit(n) for n in names]), index.cast("int"))


def weekday_label(d: Column) -> Column:
    """Working-day label, null on weekends."""
    return name_from(F.weekday(d) + 1, WEEKDAY_LABELS)


def in_days(c: Column, start: date, end: date) -> Column:
    """Day of `c` within [start, end], written on the raw column so that scans can skip row groups."""
    return (c >= F.lit(start).cast("timestamp_ntz")) & (c < F.lit(end + timedelta(days=1)).cast("timestamp_ntz"))


def first_in_days(columns: tuple[str, ...], start: date, end: date) -> Column:
    """Day of the first filled one of `columns` within [start, end].

    Written branch by branch, as a scan can test each column against its bounds but not a coalesce.
    """
    test, empty = None, None
    for name in columns:
        branch = in_days(F.col(name), start, end)
        test = branch if test is None else test | (empty & branch)
        empty = F.col(name).isNull() if empty is None else empty & F.col(name).isNull()
    return test


def with_easter(years: DataFrame) -> DataFrame:
    """Gregorian Easter Sunday (`pascoa`) of each year, by golden number and epact.

    One step per projection, so that each intermediate is computed once.
    """
    year = F.col("ano").cast("int")
    df = years.select("ano", (year % 19 + 1).alias("ouro"), (F.floor(year / 100) + 1).alias("seculo"))
    df = df.withColumns(
        {
            "solar": F.floor(3 * F.col("seculo") / 4) - 12,
            "lunar": F.floor((8 * F.col("seculo") + 5) / 25) - 5,
        }
    )
    df = df.withColumns(
        {
            "domingo": F.floor(5 * F.col("ano") / 4) - F.col("solar") - 10,
            "epacta": F.pmod(11 * F.col("ouro") + 20 + F.col("lunar") - F.col("solar"), F.lit(30)),
        }
    )
    late = ((F.col("epacta") == 25) & (F.col("ouro") > 11)) | (F.col("epacta") == 24)
    df = df.withColumn("epacta", F.col("epacta") + late.cast("int"))
    df = df.withColumn("lua", 44 - F.col("epacta"))
    df = df.withColumn("lua", F.col("lua") + F.when(F.col("lua") < 21, 30).otherwise(0))
    march_day = F.col("lua") + 7 - F.pmod(F.col("domingo") + F.col("lua"), F.lit(7))
    first = F.make_date(F.col("ano").cast("int"), F.lit(3), F.lit(1))
    return df.select("ano", F.date_add(first, (march_day - 1).cast("int")).alias("pascoa"))


def holiday_calendar(years: DataFrame) -> DataFrame:
    """Holidays (`feriado`) of every year in the one-column frame `years(ano)`."""
    year = F.col("ano").cast("int")
    fixed = [F.make_date(year, F.lit(m), F.lit(d)) for m, d in FIXED_HOLIDAYS]
    moving = [F.date_add("pascoa", offset) for offset in EASTER_OFFSETS]
    return with_easter(years).select(F.explode(F.array(*fixed, *moving)).alias("feriado")).distinct()


def year_spine(spark: SparkSession, first: int, last: int) -> DataFrame:
    return spark.range(first, last + 1).select(F.col("id").cast("int").alias("ano"))


def business_calendar(days: DataFrame, holidays: DataFrame) -> DataFrame:
    """Working-day flag, previous working day and the idle window between it and each day.

    `days(data)` must be gap-free, so the result grows with calendar time, never with ticket rows.
    """
    flagged = days.join(
        holidays.select(F.col("feriado").alias("data"), F.lit(1).alias("eh_feriado")), "data", "left"
    ).withColumn("dia_util", ((F.weekday("data") < 5) & F.col("eh_feriado").isNull()).cast("int"))
    before = Window.orderBy("data").rowsBetween(Window.unboundedPreceding, -1)
    previous = F.last(F.when(F.col("dia_util") == 1, F.col("data")), ignorenulls=True).over(before)
    idle = F.datediff("data", "dia_util_anterior") > 1
    return (
        flagged.withColumn("dia_util_anterior", previous)
        .withColumn("inicio_excecao", F.when(idle, F.date_add("dia_util_anterior", 1)))
        .withColumn("fim_excecao", F.when(idle, F.date_sub("data", 1)))
        .drop("eh_feriado")
    )


def report_window(spark: SparkSession, today: date) -> dict[str, date | None]:
    """Dates of a daily report: previous working day, Friday of the week and the idle window.

    One row of calendar data is read back; no ticket is touched.
    """
    first = today - timedelta(days=30)
    days = spark.range(31).select(F.date_add(F.lit(first), F.col("id").cast("int")).alias("data"))
    row = (
        business_calendar(days, holiday_calendar(year_spine(spark, first.year, today.year)))
        .filter(F.col("data") == F.lit(today))
        .first()
    )
    return {
        "today": today,
        "business_day": row["dia_util_anterior"],
        "week_end": today + timedelta(days=max(0, 4 - today.weekday())),
        "idle_start": row["inicio_excecao"],
        "idle_end": row["fim_excecao"],
    }


def previous_business_week(today: date) -> tuple[date, date]:
    monday = today - timedelta(days=today.weekday() + 7)
    return monday, monday + timedelta(days=4)


def resolve_period(
    today: date, start: date | None = None, end: date | None = None, days: int = 7, closed: bool = True
) -> tuple[date, date]:
    """Report period: both or neither date; the default is `days` days up to yesterday.

    `closed` refuses an end after yesterday, so that no half day is reported.
    """
    if (start is None) != (end is None):
        raise ValueError("Give start and end together, or neither.")
    yesterday = today - timedelta(days=1)
    if start is None:
        return yesterday - timedelta(days=max(1, days) - 1), yesterday
    if start > end:
        raise ValueError("start is after end.")
    if closed and end > yesterday:
        raise ValueError("end must be yesterday or earlier.")
    return start, end
