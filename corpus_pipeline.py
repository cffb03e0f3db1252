"""The corpus pipeline: five stages, each an operator of `ticketlake.llm`, applied one after the other to `documents`.

Every stage but the last returns the columns of documents. The frame between two stages is written as Parquet in the
shared folder of the session and read again, so that a lost executor costs no earlier stage.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketlake.llm import bpe, contamination, lines, simhash, toxicity
from ticketlake.llm.common import cut_lineage, table, together
from ticketlake.llm.queries import RANK_FILE
from ticketlake.session import ensure_checkpoint_dir


#: Name of a column that no table has.
_ROW = "row identity of the near-copy stage"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not call toxic, with a null or an empty text as they are."""
    scored = toxicity.classify(docs, table(spark, sf_dir, "labels"))
    return scored.where(F.col("predicted") == 0).select(*together(docs))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without its repeated lines; n_chars follows the text, a null text stays null."""
    kept = lines.drop_repeated_lines(docs)
    shorter = F.when(F.col("n_dropped") > 0, F.length("text").cast("bigint")).otherwise(F.col("row.n_chars"))
    new = {"text": F.col("text"), "n_chars": shorter}
    return kept.select(*[new.get(c, F.col(f"row.{c}")).alias(c) for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group stays: that of the smallest id, an id before none, then by digest of the text.

    Rows are told apart by id and text, so rows that share an id are judged each by its own text. Rows that are equal in
    both are copies of one another; these, usually few, are the only ones whose texts are compared by a shuffle.
    """
    digest = F.sha2(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.coalesce("text", F.lit(""))), 256)
    row = F.unhex(F.substring(digest, 1, 32))
    found = simhash.near_duplicates(docs.select(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", row.alias("row")).alias("doc_id"), "text"))
    rows = found.groupBy(F.col("doc_id.row").alias("row")).agg(
        F.max(F.col("doc_id.row") != F.col("component_id.row")).alias("other"), F.count(F.lit(1)).alias("n")
    )
    odd = cut_lineage(rows.where("other OR n > 1"))
    marked = docs.withColumns({_ROW: row}).join(odd.withColumnRenamed("row", _ROW), _ROW, "left")
    copies = marked.where("NOT other").dropDuplicates([_ROW])
    return marked.where("other IS NULL").unionByName(copies).select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return contamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and of the decoded bytes."""
    return bpe.encode(docs, RANK_FILE, public_tokenizers.PATTERN, digests=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_lines),
    ("SimHash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("byte-level BPE", encode),
]
#: The trained classifier and the tokenizer have no form in SQL; tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for step, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if step < len(STAGES) - 1:
            docs.write.parquet(f"{folder}/{step}")
            docs = spark.read.parquet(f"{folder}/{step}")
    return docs
