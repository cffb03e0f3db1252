"""Run and step log of the batch, kept as tables."""

from __future__ import annotations

import time
import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketlake.operators.persistence import upsert
from ticketlake.schemas import RUNS, STEPS
from ticketlake.sources.tables import TableStore


def _ddl(schema: dict[str, str]) -> str:
    return ", ".join(f"`{name}` {kind}" for name, kind in schema.items())


def step_rows(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """Step rows with their JSON payload."""
    plain = {name: kind for name, kind in STEPS.items() if name != "payload_json"}
    df = spark.createDataFrame([tuple(row.get(c) for c in plain) for row in rows], _ddl(plain))
    return df.withColumn("payload_json", F.to_json(F.struct(*plain), {"ignoreNullFields": "false"}))


class RunLog:
    """One run: RUNNING until finished, with a row per step."""

    def __init__(self, store: TableStore, name: str, now=datetime.now, run_id: str | None = None):
        self.store, self.name, self.now = store, name, now
        self.run_id = run_id or uuid.uuid4().hex
        self.begun = time.perf_counter()
        self._save_run({"data_execucao": now(), "status": "RUNNING", "data_inicio": now()})

    def _save_run(self, values: dict) -> None:
        row = {"run_id": self.run_id, "pipeline_name": self.name, **values}
        schema = {c: RUNS[c] for c in row}
        incoming = self.store.spark.createDataFrame([tuple(row.values())], _ddl(schema))
        merged = upsert(self.store.read_or_empty("etl_runs", RUNS), incoming, "run_id").coalesce(1)
        self.store.publish({"etl_runs": self.store.stage(merged, "etl_runs")})

    def step(
        self, name: str, status: str = "SUCCESS", volume: int | None = None, seconds: float | None = None,
        error: str | None = None, level: str = "INFO",
    ) -> None:
        row = {
            "run_id": self.run_id, "timestamp_log": self.now(), "nivel": level, "etapa": name, "status": status,
            "volume_processado": volume, "tempo_etapa": None if seconds is None else round(seconds, 3), "erro": error,
        }
        # The log is the one table that only grows: its rows are appended, never rewritten.
        step_rows(self.store.spark, [row]).coalesce(1).write.mode("append").parquet(f"{self.store.root}/etl_logs")

    def finish(self, status: str, records: int, sources: int, error: str | None = None) -> None:
        self._save_run(
            {
                "status": status, "tempo_execucao": round(time.perf_counter() - self.begun, 3),
                "qtd_registros_processados": records, "erro": error or "", "qtd_fontes_processadas": sources,
                "data_fim": self.now(),
            }
        )

    def steps(self) -> DataFrame:
        return self.store.spark.read.schema(_ddl(STEPS)).parquet(f"{self.store.root}/etl_logs")


def last_run(runs: DataFrame, steps: DataFrame, limit: int | None = None) -> DataFrame:
    """Steps of the latest run in order; the first `limit` of them, or all."""
    if limit is not None and limit < 1:
        raise ValueError("limit must be at least 1, or None for all steps")
    latest = runs.orderBy(
        F.coalesce("data_inicio", "data_execucao").desc(), F.desc("data_execucao")
    ).limit(1).select("run_id", F.col("status").alias("status_execucao"))
    found = steps.join(F.broadcast(latest), "run_id").orderBy("timestamp_log", "etapa")  # one row
    return (found if limit is None else found.limit(limit)).select(
        "run_id", "status_execucao", "timestamp_log", "nivel", "etapa", "status", "volume_processado",
        "tempo_etapa", "erro",
    )
