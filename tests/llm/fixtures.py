"""Small documents with the awkward cases, and plain Python versions of each operator's rule."""

from __future__ import annotations

import random
import re

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Columns whose names the operators use inside; they must come to no harm.
CLASHING = "row string, h bigint, c bigint, spot bigint, fp bigint, place bigint, key string, n_words bigint, hits string, of bigint, mark int, spots string, part int, blob string"


def words(rng: random.Random, count: int) -> list[str]:
    return [rng.choice(("Ton", "re", "ATH", "énon", "thwh", "er", "日本", "x", "ing")) + rng.choice(("", "a", "on", "7", ".")) for _ in range(count)]


def texts() -> list[str | None]:
    rng = random.Random(5)
    passage = " ".join(words(rng, 60))
    line = "The very same line of more than twenty characters, " + " ".join(words(rng, 6))
    base = [" ".join(words(rng, rng.choice((3, 20, 80, 200)))) for _ in range(30)]
    out: list[str | None] = [None, "", " ", "\n", "a", "ab" * 300, "z" * 1200, " " * 400, "\t\n \x0b", "é" * 260, "日本語 " * 90]
    out += base + base[:4] + [base[2]] * 3
    out += [f"{b} {passage} {c}" for b, c in zip(base[:6], base[6:12], strict=True)]
    out += [f"{b}\n{line}\n{c}" for b, c in zip(base[12:18], base[18:24], strict=True)] + [f"  {line.upper()}\t", line]
    out += [b[:-1] + "q" for b in base[4:9]]
    out += [" ".join(words(rng, 9000))]
    return out


def documents(spark, wide: bool = False, repeat: bool = True):
    rows = [(k, t, "en", "src0", None if t is None else len(t)) for k, t in enumerate(texts())]
    if repeat:
        rows += [rows[12], (None, "a text of no id, " + "of no id at all " * 20, None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return clashing(docs) if wide else docs


def clashing(docs):
    from pyspark.sql import functions as F

    for column in CLASHING.split(", "):
        name, kind = column.split()
        docs = docs.withColumn(name, F.lit("7").cast(kind))
    return docs


def empty(spark, schema: str = SCHEMA):
    return spark.createDataFrame([], schema)


def rows_of(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)


def lower(text: str) -> str:
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def blank_words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")
