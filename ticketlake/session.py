"""Session defaults and lineage cutting."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Only settings that are safe at any size: sizes of shuffles are left to AQE, which merges
# small partitions and splits skewed ones at run time.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Wide text projections become methods the JVM never compiles; beyond this size Spark splits them.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(app: str = "ticketlake", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Checkpoint folder of the session; a private one, gone at the end of the process, only for local runs that name none."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("Set spark.checkpoint.dir to a folder that every executor can reach.")
        folder = tempfile.mkdtemp(prefix="ticketlake-checkpoint-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    context.setCheckpointDir(folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise `df` in the shared checkpoint folder, so that a lost executor cannot undo it."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: Spark removes the shuffle files of a finished query at once when this is set, not when the driver collects garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


#: Rows of one file of a materialised frame. A reader cannot share a small file out, so what few tasks wrote few would read.
FILE_ROWS = 250_000


def settle(df: DataFrame) -> DataFrame:
    """Materialise `df` as Parquet in the shared checkpoint folder.

    As `cut_lineage`, but compressed by column and read by column, and without the shuffle files that made it. The order
    and number of partitions are not kept.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/settled-{uuid.uuid4().hex}"
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").option("maxRecordsPerFile", FILE_ROWS).parquet(path)
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def empty_frame(spark: SparkSession, schema: Mapping[str, str]) -> DataFrame:
    """No rows of a schema; the planner knows that there are none and drops joins with them."""
    return spark.range(1).select(*[F.lit(None).cast(k).alias(c) for c, k in schema.items()]).limit(0)
