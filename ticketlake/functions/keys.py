"""Protocol numbers and surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ticketlake.functions.text import strip

# How each institution writes its protocol numbers.
PROTOCOL_PATTERNS = {
    "protocolo_agenersa": r"(\d{10})",
    "protocolo_procon": r"(\d{2}\.\d{2}\.\d{4}\.\d{3}\.\d{5}-\d{3})",
    "protocolo_defensoria": r"([Vv]\d{2,5}/\d{4})",
    "protocolo_codecon": r"(\d{4,6}/\d{4})",
}


def protocols(title: Column) -> dict[str, Column]:
    """First protocol of each kind in a title; null where there is none."""
    return {
        name: F.nullif(F.regexp_extract(title, pattern, 1), F.lit(""))
        for name, pattern in PROTOCOL_PATTERNS.items()
    }


def case_id(regulator_protocol: Column, ticket_id: Column) -> Column:
    return F.coalesce(regulator_protocol, ticket_id.cast("string"))


def sha256_key(*parts: Column) -> Column:
    """Surrogate key of the parts joined by `|`; a missing part counts as empty."""
    return F.sha2(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]), 256)


def court_case_key(channel: Column, kind: Column, cpf: Column, account: Column, subject: Column) -> Column:
    """Shared key of small-claims tickets; null when neither person nor account is known."""
    is_court = F.upper(F.coalesce(channel, F.lit(""))).contains("JEC") | F.upper(
        F.coalesce(kind, F.lit(""))
    ).contains("JEC")
    person, home = strip(F.coalesce(cpf, F.lit(""))), strip(F.coalesce(account, F.lit("")))
    key = sha256_key(person, home, F.lower(strip(subject)))
    return F.when(is_court & ((person != "") | (home != "")), key)
