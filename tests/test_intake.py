"""Incremental intake: new files only, once each, in any order of arrival."""

import os
import re
import shutil

import pytest
from pyspark.sql import functions as F

from ticketlake.operators.dedup import dedup_latest
from ticketlake.sources import files, intake

DAY = 86_400


def put(spark, folder, name, rows, schema, age_days):
    """One parquet file of a given name and age."""
    aside = f"{folder}.aside-{name}"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(aside)
    os.makedirs(folder, exist_ok=True)
    part = next(n for n in os.listdir(aside) if n.endswith(".parquet"))
    path = shutil.move(f"{aside}/{part}", f"{folder}/{name}")
    moment = 1_700_000_000 - age_days * DAY
    os.utime(path, (moment, moment))


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def feed(tmp_path):
    return str(tmp_path / "feed"), str(tmp_path / "bronze")


def test_a_second_call_reads_new_files_only(spark, feed):
    folder, target = feed
    put(spark, folder, "Base_GSS_1.parquet", [(1, "a"), (2, "b")], "k long, v string", 3)
    put(spark, folder, "other.parquet", [(9, "x")], "k long, v string", 3)
    assert intake.land(spark, folder, "gss", target) == 0
    before = {n: os.stat(f"{target}/lots/lote=0/{n}").st_mtime_ns for n in os.listdir(f"{target}/lots/lote=0")}
    put(spark, folder, "BASE_gss_2.PARQUET", [(2, "c", 5)], "k long, v string, n int", 2)
    # Older than the newest file by far more than a week.
    put(spark, folder, "base_GSS_0.parquet", [(3, "late")], "k long, v string", 400)
    assert intake.land(spark, folder, "gss", target) == 1
    assert before == {n: os.stat(f"{target}/lots/lote=0/{n}").st_mtime_ns for n in before}
    new = intake.landed(spark, target, after=0)
    assert rows_of(new.select("k", "v", "n", "arquivo_origem", "fonte_raw")) == [
        (2, "c", 5, "BASE_gss_2.PARQUET", "gss"), (3, "late", None, "base_GSS_0.parquet", "gss"),
    ]
    assert re.search(r"PartitionFilters: \[[^\]]*lote", new._jdf.queryExecution().toString())
    assert intake.land(spark, folder, "gss", target) == 1
    assert intake.landed(spark, target).count() == 4


def test_lots_hold_what_one_read_of_the_folder_gives(spark, feed):
    folder, target = feed
    for i in range(5):
        put(spark, folder, f"Base_GSS_{i}.parquet", [(i, f"v{i}"), (7, f"w{i}")], "k long, v string", 10 - i)
    assert intake.land(spark, folder, "gss", target, files_per_lot=2) == 2
    direct = files.read_discovered(spark, folder, "gss")
    assert rows_of(intake.landed(spark, target).select(*direct.columns)) == rows_of(direct)


def test_a_call_that_died_before_its_commit_lands_its_lot_once(spark, feed):
    folder, target = feed
    put(spark, folder, "Base_GSS_1.parquet", [(1, "a")], "k long, v string", 2)
    intake.land(spark, folder, "gss", target)
    put(spark, folder, "Base_GSS_2.parquet", [(2, "b")], "k long, v string", 1)
    intake.land(spark, folder, "gss", target)
    for name in ("1", ".1.crc"):
        if os.path.exists(f"{target}/checkpoint/commits/{name}"):
            os.remove(f"{target}/checkpoint/commits/{name}")
    assert intake.land(spark, folder, "gss", target) == 1
    assert rows_of(intake.landed(spark, target).select("k", "lote")) == [(1, 0), (2, 1)]


def test_no_files(spark, feed):
    folder, target = feed
    os.makedirs(folder)
    assert intake.land(spark, folder, "gss", target) == -1
    assert intake.landed(spark, target) is None
    assert files.read_discovered(spark, folder, "gss") is None


def test_merged_lots_equal_the_latest_row_of_all_files(spark, feed):
    folder, target = feed
    ages = [5, 1, 9, 3]  # order of arrival is not the order of file times
    stored = None
    for i, age in enumerate(ages):
        rows = [(k, f"{i}-{k}") for k in range(i, i + 4)] + [(2, f"again {i}"), (None, "no key")]
        put(spark, folder, f"Base_GSS_{i}.parquet", rows, "k long, v string", age)
        last = intake.land(spark, folder, "gss", target)
        stored = intake.merge_latest(stored, intake.landed(spark, target, after=last - 1), "k")
    again = intake.merge_latest(stored, intake.landed(spark, target, after=0), "k")
    every = files.read_discovered(spark, folder, "gss").filter(F.col("k").isNotNull())
    wanted = dedup_latest(every, ["k"], intake.ARRIVAL)
    assert rows_of(stored.select("k", "v")) == rows_of(wanted.select("k", "v")) == rows_of(again.select("k", "v"))
