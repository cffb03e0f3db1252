"""Finding and reading source files."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketlake.functions.text import norm_text
from ticketlake.schemas import SOURCE_PREFIXES


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """Path, name, change time and size of every file of a folder; contents are not read."""
    return spark.read.format("binaryFile").load(folder).select(
        "path",
        F.substring_index("path", "/", -1).alias("arquivo"),
        F.col("modificationTime").cast("timestamp_ntz").alias("arquivo_mtime"),
        F.col("length").alias("bytes"),
    )


def name_glob(prefixes: Sequence[str], extension: str) -> str:
    """File name pattern for any of some prefixes and an extension, in any case."""

    def any_case(text: str) -> str:
        return "".join(f"[{c.upper()}{c.lower()}]" if c.isalpha() else c for c in text)

    return "{" + ",".join(any_case(p) for p in prefixes) + "}*." + any_case(extension)


def discover_sources(
    spark: SparkSession, folder: str, prefixes: Sequence[str], extensions: Sequence[str] = ("parquet", "csv")
) -> DataFrame:
    """Files whose name starts with a prefix (any case) and has an allowed extension, oldest first.

    Lock files (`~$...`) are left out.
    """
    name = F.upper("arquivo")
    starts = reduce(lambda a, b: a | b, [name.startswith(p.upper()) for p in prefixes])
    extension = F.lower(F.substring_index("arquivo", ".", -1)).isin(*[e.lower() for e in extensions])
    return (
        list_files(spark, folder)
        .filter(starts & extension & ~F.col("arquivo").startswith("~$"))
        .orderBy("arquivo_mtime", "arquivo")
    )


def lookup_latest_file(spark: SparkSession, folder: str, text: str) -> DataFrame:
    """The first file whose accent-free name holds `text` (any case)."""
    plain = norm_text(F.col("arquivo"))
    wanted = norm_text(F.lit(text))
    return list_files(spark, folder).filter(plain.contains(wanted)).orderBy("arquivo").limit(1)


def with_lineage(df: DataFrame, source: str) -> DataFrame:
    """Stamp file name, file time, position in the file and source; must sit directly on a file scan."""
    return df.select(
        "*",
        F.col("_metadata.file_name").alias("arquivo_origem"),
        F.col("_metadata.file_modification_time").cast("timestamp_ntz").alias("arquivo_mtime"),
        F.col("_metadata.row_index").alias("arquivo_linha"),
        F.lit(source).alias("fonte_raw"),
    )


def read_source(spark: SparkSession, layouts: Sequence[Sequence[str]], source: str) -> DataFrame:
    """Read the files of a source and stack them, absent columns as null.

    Each entry of `layouts` is a group of files with one layout, so a thousand daily files are one
    scan and only differing layouts are stacked by name.
    """
    frames = [with_lineage(spark.read.parquet(*paths), source) for paths in layouts]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_discovered(spark: SparkSession, folder: str, source: str) -> DataFrame | None:
    """All parquet files of a named source in a folder; None when there is none.

    Files are chosen by a pattern inside the scan, so their paths are not collected; layouts are merged by column name.
    """
    prefixes = SOURCE_PREFIXES[source]
    if discover_sources(spark, folder, prefixes, ("parquet",)).isEmpty():
        return None
    reader = spark.read.option("mergeSchema", "true").option("pathGlobFilter", name_glob(prefixes, "parquet"))
    return with_lineage(reader.parquet(folder), source)


def read_delimited(spark: SparkSession, path: str) -> DataFrame:
    """CSV as `;` latin1 or, when that gives one column, as `,` utf-8."""
    semicolon = spark.read.csv(path, sep=";", encoding="ISO-8859-1", header=True)
    if len(semicolon.columns) > 1:
        return semicolon
    return spark.read.csv(path, sep=",", encoding="UTF-8", header=True)


def header_name(text: str) -> str:
    """A raw header as plain snake case."""
    plain = unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode("ascii")
    return re.sub(r"[^a-zA-Z0-9]+", "_", plain).strip("_").lower()
