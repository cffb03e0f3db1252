"""Secret scans with a ledger of blobs.

A version of a file (path, text) is named by the SHA-256 of its text. The ledger holds one row for every pair of blob and
rule version that has been scanned, with the spans found; a scan joins the blobs of a feed with the ledger and reads the
text of pairs that are not in it only, one path for each blob. Findings go back to all paths by the blob's name.

A null text is the empty blob, which has no span. Rows that repeat, a null path too, get the findings of their text.
Empty feeds add nothing. Spans are in code points, end exclusive.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketlake.llm.common import blocks

#: Kinds in the order in which spans of one start are listed; raise the version when a rule changes.
RULES_VERSION = 1
BASE_KINDS = ("assign", "access", "hex")
EXTRA_KINDS = ("private_key", "web_token", "service_token")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([a-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
_EXTRA = (
    ("private_key", "-----BEGIN ", re.compile(r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----[A-Za-z0-9+/=\s]*(?:-----END (?:[A-Z]+ )*PRIVATE KEY-----)?")),
    ("web_token", "eyJ", re.compile(r"\beyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}")),
    ("service_token", "_", re.compile(r"\b(?:gh[pousr]_[A-Za-z0-9]{36}|sk_live_[A-Za-z0-9]{20,})\b")),
)
SHAPE = "array<struct<kind:string,start:int,end:int>>"
_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])


def secrets_of(text: str) -> list[tuple[str, int, int]]:
    """All spans by start, then kind as listed. Quick tests for single characters only skip what cannot match."""
    found = []
    if ":" in text or "=" in text:
        found += [("assign", *m.span()) for m in _ASSIGN.finditer(text.translate(_LOWER)) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in _ACCESS.finditer(text)]
    found += [("hex", *m.span()) for m in _HEX.finditer(text)]
    for kind, hint, rule in _EXTRA:
        if hint in text:
            found += [(kind, *m.span()) for m in rule.finditer(text)]
    order = {kind: k for k, kind in enumerate(BASE_KINDS + EXTRA_KINDS)}
    return sorted(found, key=lambda s: (s[1], order[s[0]]))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in blocks(batches):
        spans = [[dict(zip(("kind", "start", "end"), s, strict=True)) for s in secrets_of(t)] for t in part.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([part.column("blob"), pa.array(spans, pa.list_(_SPAN))], names=["blob", "spans"])


def addressed(versions: DataFrame) -> DataFrame:
    """path, text and blob (the content address) of every version."""
    text = F.coalesce("text", F.lit(""))
    return versions.select("path", text.alias("text"), F.sha2(text, 256).alias("blob"))


def unseen(versions: DataFrame, ledger: DataFrame | None, rules_version: int = RULES_VERSION) -> DataFrame:
    """blob and text, once each, of pairs with the rule version that the ledger does not hold.

    Equal texts fold before the shuffle and again after it, so a hot blob costs one row per task.
    """
    new = addressed(versions).select("blob", "text").groupBy("blob").agg(F.first("text").alias("text"))
    if ledger is not None:
        new = new.join(ledger.where(F.col("rules_version") == rules_version).select("blob"), "blob", "left_anti")
    return new


def scan(versions: DataFrame, ledger: DataFrame | None = None, rules_version: int = RULES_VERSION) -> DataFrame:
    """Ledger rows (blob, rules_version, spans) to add for a feed."""
    found = unseen(versions, ledger, rules_version).mapInArrow(_scan, f"blob string, spans {SHAPE}")
    return found.select("blob", F.lit(rules_version).alias("rules_version"), "spans")


def findings(versions: DataFrame, ledger: DataFrame, rules_version: int = RULES_VERSION) -> DataFrame:
    """path, blob and spans of every version. Only blobs with findings meet the paths; a hot blob is split by Spark.

    A feed that was scanned twice against one state of the ledger has left two equal rows of a blob; one counts.
    """
    some = ledger.where((F.col("rules_version") == rules_version) & (F.size("spans") > 0)).select("blob", "spans").dropDuplicates(["blob"])
    paths = addressed(versions).select("path", "blob")
    return paths.join(some, "blob", "left").select("path", "blob", F.coalesce("spans", F.array().cast(SHAPE)).alias("spans"))


def append(spark: SparkSession, folder: str, rows: DataFrame) -> DataFrame:
    """Add rows to the ledger stored in `folder` and return the whole of it."""
    rows.write.mode("append").partitionBy("rules_version").parquet(folder)
    return spark.read.schema(f"blob string, spans {SHAPE}, rules_version int").parquet(folder)
