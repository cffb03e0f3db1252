"""Incremental intake: files that came since the last call are read once and kept in numbered lots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketlake.operators.dedup import dedup_latest
from ticketlake.schemas import SOURCE_PREFIXES
from ticketlake.sources.files import discover_sources, name_glob, with_lineage
from ticketlake.sources.tables import path_exists

# The file source forgets, and would skip, files older than this when measured from the newest one. A file may be copied
# with its old time, so nothing is ever too old.
_ANY_AGE = "36500d"
#: Column with the number of the lot.
LOT = "lote"
ARRIVAL = ("arquivo_mtime", "arquivo_origem", "arquivo_linha")


def land(spark: SparkSession, folder: str, source: str, target: str, files_per_lot: int = 1_000) -> int:
    """Read the parquet files of a source that no earlier call has read, and return the number of the last lot (-1: none yet).

    The stream's checkpoint in `target` knows the files that were read. Each lot is a folder of its own that is written over
    when a call that died is repeated, so every row lands once. Only footers of older files are read again, in tasks, as a
    new file may bring a column; rows of the lots before have null in it. A file changed under its old name is not read
    again. One call at a time may run on a target.
    """
    prefixes = SOURCE_PREFIXES[source]
    if not discover_sources(spark, folder, prefixes, ("parquet",)).isEmpty():
        names = name_glob(prefixes, "parquet")
        layout = spark.read.option("mergeSchema", "true").option("pathGlobFilter", names).parquet(folder).schema
        arriving = (
            spark.readStream.schema(layout).option("pathGlobFilter", names)
            .option("maxFilesPerTrigger", files_per_lot).option("maxFileAge", _ANY_AGE).parquet(folder)
        )

        def keep(rows: DataFrame, number: int) -> None:
            rows.write.mode("overwrite").parquet(f"{target}/lots/{LOT}={number}")

        query = (
            with_lineage(arriving, source).writeStream.foreachBatch(keep)
            .option("checkpointLocation", f"{target}/checkpoint").trigger(availableNow=True).start()
        )
        query.awaitTermination()
    rows = landed(spark, target)
    return -1 if rows is None else rows.agg(F.coalesce(F.max(LOT), F.lit(-1))).first()[0]


def landed(spark: SparkSession, target: str, after: int = -1) -> DataFrame | None:
    """Rows of the lots after a given one, with their lineage; None when nothing has ever landed.

    Lots are partitions, so older ones are not read.
    """
    if not path_exists(spark, f"{target}/lots"):
        return None
    rows = spark.read.option("mergeSchema", "true").parquet(f"{target}/lots")
    return rows.withColumn(LOT, F.col(LOT).cast("int")).filter(F.col(LOT) > after)


def merge_latest(stored: DataFrame | None, arrived: DataFrame, key: str) -> DataFrame:
    """The latest row of each key among stored and newly landed ones, columns of both.

    Later means a later file time, then file name and place in the file, not a later lot: a file that comes late does not
    undo newer rows, and a lot that is merged twice changes nothing. Rows without a key are left out.
    """
    arrived = arrived.drop(LOT)
    both = arrived if stored is None else stored.unionByName(arrived, allowMissingColumns=True)
    return dedup_latest(both.filter(F.col(key).isNotNull()), [key], ARRIVAL)
