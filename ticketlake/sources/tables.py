"""Stored tables: parquet snapshots behind one commit file for all of them, and a history that rewrites touched months only."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Mapping
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketlake.operators.persistence import scd2
from ticketlake.schemas import HISTORY
from ticketlake.session import FILE_ROWS, empty_frame, settle

COMMITS = "_commits"
# Entry of a commit that names the batch run that made it.
RUN = "_run"


def _filesystem(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def _read_json(spark: SparkSession, path: str) -> dict:
    fs, target = _filesystem(spark, path)
    stream = fs.open(target)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def _write_json(spark: SparkSession, path: str, value: Mapping, aside: str) -> None:
    """Write a small file aside and rename it, so that readers see all of it or nothing."""
    fs, writing = _filesystem(spark, f"{aside}/_writing-{uuid.uuid4().hex}")
    stream = fs.create(writing)
    stream.write(bytearray(json.dumps(value, sort_keys=True).encode()))
    stream.close()
    if not fs.rename(writing, _filesystem(spark, path)[1]):
        raise RuntimeError(f"{path} could not be put in place.")


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = _filesystem(spark, path)
    return fs.exists(target)


class TableStore:
    """Named tables under one folder of any Hadoop file system.

    A table is a set of snapshot folders. The newest commit file names the live snapshot of every table, so that several
    tables change together or not at all. Readers that planned on older snapshots finish on them, and a failed write or a
    crash before the commit leaves everything as it was.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _commits(self) -> list[str]:
        fs, folder = _filesystem(self.spark, f"{self.root}/{COMMITS}")
        return sorted(status.getPath().getName() for status in fs.listStatus(folder)) if fs.exists(folder) else []

    def live(self) -> dict[str, str]:
        """Table name to snapshot, as of the newest commit."""
        done = [name for name in self._commits() if name.endswith(".json")]
        return _read_json(self.spark, f"{self.root}/{COMMITS}/{done[-1]}") if done else {}

    def exists(self, name: str) -> bool:
        return name in self.live()

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}/{self.live()[name]}")

    def read_or_empty(self, name: str, schema: Mapping[str, str]) -> DataFrame:
        live = self.live()
        if name in live:
            return self.spark.read.parquet(f"{self.root}/{name}/{live[name]}")
        return empty_frame(self.spark, schema)

    def stage(self, df: DataFrame, name: str, version: str | None = None) -> str:
        """Write a new snapshot without making it live; one of a given version that is there in full is left as it is."""
        version = version or uuid.uuid4().hex
        _write_once(df, f"{self.root}/{name}/{version}")
        return version

    def has_rows(self, df: DataFrame, name: str, version: str) -> bool:
        """Whether a staged snapshot of `df` holds any row."""
        return not self.spark.read.schema(df.schema).parquet(f"{self.root}/{name}/{version}").isEmpty()

    def publish(self, versions: Mapping[str, str]) -> None:
        """Make staged snapshots live, all at once.

        A number is claimed by creating an empty file; the commit is written aside and renamed to that number. A claim
        without its commit is a writer that has not finished, or never will: it holds nothing back.
        """
        taken = self._commits()
        serial = int(taken[-1].split(".")[0]) + 1 if taken else 0
        fs, claim = _filesystem(self.spark, f"{self.root}/{COMMITS}/{serial:012d}.claim")
        if not fs.createNewFile(claim):
            raise RuntimeError("Another writer published first.")
        _write_json(
            self.spark, f"{self.root}/{COMMITS}/{serial:012d}.json", {**self.live(), **versions}, aside=self.root
        )

    def replace(self, df: DataFrame, name: str) -> bool:
        """Replace a table; an empty frame writes nothing and keeps the old one."""
        version = self.stage(df, name)
        if not self.has_rows(df, name, version):
            return False
        self.publish({name: version})
        return True


def _write_once(df: DataFrame, path: str, file_rows: int = 0) -> None:
    """Write a folder unless it is there in full; Spark marks a finished one, and half of one is written over."""
    if not path_exists(df.sparkSession, f"{path}/_SUCCESS"):
        df.write.mode("overwrite").option("maxRecordsPerFile", file_rows).parquet(path)


class Progress:
    """What a run has finished, kept in the store under the key of the run.

    A run that is started again with its key reads the frames that are there and goes on with the first one that is not.
    It keeps the id and moment of its first start. When the stored tables it began from have been replaced meanwhile by
    another run, what it kept is worthless and it starts anew.
    """

    def __init__(self, store: TableStore, key: str, tables: Iterable[str], today: date, at: datetime):
        self.store, self.spark, self.folder = store, store.spark, f"{store.root}/_runs/{key}"
        live = store.live()
        base = {name: live[name] for name in tables if name in live}
        begun = f"{self.folder}/begun.json"
        start = _read_json(self.spark, begun) if path_exists(self.spark, begun) else None
        if start and start["today"] != today.isoformat():
            raise ValueError(f"Run {key} is of {start['today']}.")
        if start and start["base"] != base and live.get(RUN) != start["run_id"]:
            self.discard()
            start = None
        if start is None:
            start = {
                "run_id": uuid.uuid4().hex, "snapshot": uuid.uuid4().hex, "today": today.isoformat(),
                "at": at.isoformat(), "base": base,
            }
            _write_json(self.spark, begun, start, aside=self.folder)
        self.run_id, self.snapshot = start["run_id"], start["snapshot"]
        self.at = datetime.fromisoformat(start["at"])

    def done(self, step: str) -> bool:
        return path_exists(self.spark, f"{self.folder}/{step}.json")

    def mark(self, step: str) -> None:
        _write_json(self.spark, f"{self.folder}/{step}.json", {}, aside=self.folder)

    def keep(self, name: str, df: DataFrame) -> DataFrame:
        """The frame as it was written by this run, now or before it was started again."""
        _write_once(df, f"{self.folder}/{name}", FILE_ROWS)
        return self.spark.read.schema(df.schema).parquet(f"{self.folder}/{name}")

    def publish(self, versions: Mapping[str, str]) -> None:
        """Make the run's snapshots live; the same commit says that it was this run."""
        self.store.publish({**versions, RUN: self.run_id})

    def published(self) -> bool:
        return self.store.live().get(RUN) == self.run_id

    def discard(self) -> None:
        fs, folder = _filesystem(self.spark, self.folder)
        fs.delete(folder, True)


def export_semantic(
    marts: Mapping[str, Callable[[], DataFrame]], folder: str, warn: Callable[[str], None] = print
) -> dict[str, str]:
    """Write one parquet folder per mart; a failing mart is reported and written without rows or columns.

    Each mart is written aside first, so that a failure on the way never costs readers the folder they have.
    """
    written = {}
    for name, build in marts.items():
        target = f"{folder}/{name}"
        try:
            _swap_in(build(), target)
        except Exception as error:  # one broken mart must not stop the others
            warn(f"mart {name}: {error}")
            spark = SparkSession.getActiveSession()
            _swap_in(spark.createDataFrame([], "sem_dados boolean"), target)
        written[name] = target
    return written


def _swap_in(df: DataFrame, target: str) -> None:
    """Write beside the target, then put the new folder in its place."""
    spark, aside = df.sparkSession, f"{target}.{uuid.uuid4().hex}"
    df.write.parquet(aside)
    fs, old = _filesystem(spark, target)
    fs.delete(old, True)
    if not fs.rename(_filesystem(spark, aside)[1], old):
        raise RuntimeError(f"{target} could not be replaced.")


def deliver(df: DataFrame, folder: str, name: str) -> None:
    """Put a frame into a feed folder as files `<name>_<i>.parquet`, each there as a whole or not at all."""
    aside = f"{folder}.{uuid.uuid4().hex}"
    df.write.parquet(aside)
    fs, written = _filesystem(df.sparkSession, aside)
    fs.mkdirs(_filesystem(df.sparkSession, folder)[1])
    parts = [status.getPath() for status in fs.listStatus(written) if status.getPath().getName().endswith(".parquet")]
    for i, part in enumerate(parts):
        if not fs.rename(part, _filesystem(df.sparkSession, f"{folder}/{name}_{i}.parquet")[1]):
            raise RuntimeError(f"{name}_{i}.parquet could not be put into {folder}.")
    fs.delete(written, True)


def update_history(spark: SparkSession, path: str, current: DataFrame, run_id: str, at: datetime) -> DataFrame:
    """Bring a stored history up to date and return it: folders by `flag_ativo` and the month in which a version closed.

    Open versions and those closed in the month of `at` are read, merged and written; Spark overwrites the folders that
    have rows, so older months are neither read nor written. A run that is repeated with the same rows changes nothing.
    """
    month = f"{at:%Y-%m}"
    touched = empty_frame(spark, HISTORY)
    if path_exists(spark, path):
        stored = read_history(spark, path)
        touched = stored.filter((F.col("flag_ativo") == 1) | (F.col("mes_fim") == month)).select(*HISTORY)
    merged = scd2(touched, current, run_id, at)
    named = merged.withColumn("mes_fim", F.coalesce(F.date_format("data_fim_vigencia", "yyyy-MM"), F.lit("aberta")))
    written = settle(named).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    written.partitionBy("flag_ativo", "mes_fim").parquet(path)
    return read_history(spark, path)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    kinds = ", ".join(f"`{c}` {k}" for c, k in HISTORY.items())
    return spark.read.schema(f"{kinds}, mes_fim string").parquet(path)


def export_ai_ready(df: DataFrame, folder: str, day: date) -> str:
    """Dated output of the AI-ready mart."""
    target = f"{folder}/date={day:%Y%m%d}"
    df.write.mode("overwrite").parquet(target)
    return target


def stamp_order(df: DataFrame, column: str = "row_seq") -> DataFrame:
    """Input order as a tie-break after the file time: file name, then position in the file.

    Rows that were not read from files have no position; they are numbered as they come.
    """
    if "arquivo_linha" in df.columns:
        return df.withColumn(column, F.struct("arquivo_origem", "arquivo_linha"))
    return df.withColumn(column, F.monotonically_increasing_id())
