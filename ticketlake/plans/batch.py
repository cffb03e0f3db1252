"""The whole batch: raw feeds to silver datasets, stored tables and outputs."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, replace
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketlake.functions.dates import report_window
from ticketlake.operators.dedup import (
    attach_subject_metrics, dedup_latest, distinct_cases, distinct_customers, ticket_subjects,
)
from ticketlake.operators.filters import assert_disjoint, orphan_filter
from ticketlake.operators.linking import SLICE_ROWS, attach_links, link_tickets, load_manual
from ticketlake.operators.orders import enrich_missing, match_orders, order_context, prepare_orders, semi_filter_orders
from ticketlake.operators.persistence import changed_tickets, scd2, sync_validity, upsert
from ticketlake.operators.quality import ContractError, validate_or_raise
from ticketlake.operators.rules import (
    backfill_territory, classification_audit, operational_audit, purge_removed, purge_stale,
)
from ticketlake.plans import daily, marts, weekly
from ticketlake.plans.runs import RunLog
from ticketlake.plans.transform import canonical_tickets, silver_general, tickets_of_kind, transform_hearings, transform_n1
from ticketlake.schemas import GOLD, HEARINGS, NOTICES, RELATIONS, TICKET_SUBJECTS, TICKETS, TICKETS_N1
from ticketlake.session import settle
from ticketlake.sources.canonical import conform
from ticketlake.sources.tables import Progress, TableStore, export_ai_ready, export_semantic, stamp_order

SOURCES = ("zendesk_geral", "zendesk_n1", "audiencias", "gss")
Keep = Callable[[str, DataFrame], DataFrame]
VALIDITY = ("data_inicio_vigencia", "data_fim_vigencia", "flag_ativo")


@dataclass
class Rules:
    """Rule tables of a run."""

    governed: DataFrame
    overrides: DataFrame | None = None
    manual: DataFrame | None = None


@dataclass
class Silver:
    """Treated datasets; a feed that was not loaded is None."""

    requests: DataFrame | None = None
    notices: DataFrame | None = None
    n1: DataFrame | None = None
    hearings: DataFrame | None = None
    orders: DataFrame | None = None
    subjects: DataFrame | None = None
    links: DataFrame | None = None
    extra: dict[str, DataFrame] = field(default_factory=dict)

    def datasets(self) -> dict[str, DataFrame]:
        """The five datasets that are kept, by name."""
        found = {}
        if self.requests is not None:
            found["geral"] = silver_general(self.requests, self.notices)
            found["ticket_assunto"] = self.subjects
            found["vinculos"] = self.links
        if self.n1 is not None:
            found["n1"] = self.n1
        if self.hearings is not None:
            found["audiencias"] = self.hearings
        return found


def _ordered(raw: DataFrame) -> DataFrame:
    return raw if "row_seq" in raw.columns else stamp_order(raw)


def _cut(name: str, df: DataFrame) -> DataFrame:
    return settle(df)


def build_silver(
    raw: Mapping[str, DataFrame | None], rules: Rules, today: date, at: datetime, slice_rows: int = SLICE_ROWS,
    keep: Keep = _cut,
) -> Silver:
    """Transform, deduplicate, link, enrich and match.

    Every feed is read once: the canonical rows of the general feed are materialised before they part into kinds, and
    requests and notices after deduplication, as five consumers read them. `keep` says where.
    """
    silver = Silver()
    governed = rules.governed
    latest = ["arquivo_mtime", "row_seq"]
    general = raw.get("zendesk_geral")
    if general is not None:
        general = _ordered(general)
        general = keep("geral_canonico", canonical_tickets(general, governed))
        requests = tickets_of_kind(general, "solicitacao", governed, rules.overrides, at)
        notices = tickets_of_kind(general, "notificacao", governed, rules.overrides, at)
        silver.subjects = keep("assuntos", ticket_subjects(requests))
        requests = keep("solicitacoes", dedup_latest(requests, ["ticket_id"], latest))
        notices = keep("notificacoes", dedup_latest(notices, ["ticket_id"], latest))
        assert_disjoint(requests, notices)
    if raw.get("zendesk_n1") is not None:
        n1 = _ordered(raw["zendesk_n1"])
        silver.n1 = keep("n1", dedup_latest(transform_n1(n1, governed), ["ticket_id"], latest).drop("row_seq"))
    if raw.get("audiencias") is not None:
        hearings = transform_hearings(_ordered(raw["audiencias"]), governed)
        silver.hearings = keep("audiencias", dedup_latest(hearings, ["ticket_id"], latest).drop("row_seq"))
    if general is None:
        return silver

    orders = context = None
    if raw.get("gss") is not None:
        accounts = requests.select("matricula").union(notices.select("matricula"))
        known = semi_filter_orders(_ordered(raw["gss"]), accounts, keep=lambda df: keep("contas_sem_ticket", df))
        orders = keep("ordens", prepare_orders(known, today))
        silver.orders = orders
        orders = None if orders.isEmpty() else orders
    if orders is not None:  # read by both kinds and by every step of matching
        context = keep("contexto_ordens", order_context(orders))
    manual = None if rules.manual is None else load_manual(rules.manual)
    loaded = None if notices.isEmpty() else notices
    silver.links = keep("vinculos", link_tickets(requests, loaded, manual, slice_rows=slice_rows))
    matched = match_orders(enrich_missing(requests, orders, context=context), orders)
    silver.requests = keep("solicitacoes_prontas", attach_subject_metrics(matched, silver.subjects))
    silver.notices = keep("notificacoes_prontas", enrich_missing(notices, orders, context=context))
    return silver


def _brought(df: DataFrame, schema: Mapping[str, str], without: tuple[str, ...] = ()) -> DataFrame:
    """The stored columns a feed brings."""
    return conform(df, {c: k for c, k in schema.items() if c not in without})


def build_gold(
    silver: Silver, stored: Mapping[str, DataFrame], rules: Rules, run_id: str, at: datetime, keep: Keep = _cut
) -> dict[str, DataFrame]:
    """Stored tables after the run, from the stored tables before it."""
    governed = rules.governed
    gold = dict(stored)

    def put(name: str, df: DataFrame) -> None:
        gold[name] = upsert(gold[name], df, GOLD[name][1])

    if silver.n1 is not None:
        put("tickets_n1", _brought(silver.n1, TICKETS_N1))
    if silver.requests is not None:
        put("clientes", distinct_customers(silver.requests, silver.notices))
        put("cases", distinct_cases(silver.requests, silver.notices))
        put("tickets_notificacao", _brought(silver.notices, NOTICES))
        linked = attach_links(silver.requests, silver.links)
        tickets = keep("tickets_atuais", _brought(linked, TICKETS, VALIDITY))
        put("tickets", tickets)
        put("ticket_assunto", _brought(silver.subjects, TICKET_SUBJECTS))
        changed = keep("tickets_alterados", changed_tickets(gold["tickets_historico"], tickets))
        gold["tickets_historico"] = scd2(gold["tickets_historico"], tickets, run_id, at)
        gold["tickets"] = sync_validity(gold["tickets"], tickets, changed, at)
        put("tickets_auditoria_classificacao", classification_audit(silver.requests))
        put("tickets_auditoria_operacional", operational_audit(silver.requests, at))
        put("ticket_relacionamentos", _brought(silver.links, RELATIONS))
        if silver.hearings is not None:
            known = orphan_filter(silver.hearings, tickets).withColumn("audiencia_id", F.col("ticket_id"))
            put("audiencias", _brought(known, HEARINGS))
        for name, status in (
            ("tickets_auditoria_classificacao", "status_auditoria"),
            ("tickets_auditoria_operacional", "status_validacao"),
        ):
            gold[name] = purge_stale(gold[name], gold["tickets"], status)
    gold = purge_removed(gold, governed)
    for name in ("tickets", "tickets_notificacao", "tickets_n1"):
        gold[name] = backfill_territory(gold[name])
    return gold


def _all_manual(given: DataFrame | None, saved: DataFrame) -> DataFrame:
    """Manual links handed to the run and those that analysts saved; `load_manual` keeps the latest of a request."""
    wanted = ("ticket_solicitacao_id", "ticket_notificacao_id", "justificativa", "atualizado_em")
    return saved.select(*wanted) if given is None else saved.select(*wanted).unionByName(given.select(*wanted))


def write_outputs(store: TableStore, folder: str, today: date, log: RunLog) -> list[str]:
    """Reports and extracts; a failing one is logged and the others go on."""
    failures: list[str] = []

    def attempt(name: str, job) -> None:
        try:
            job()
        except Exception as error:  # outputs are optional, the stored tables are already safe
            failures.append(f"{name}: {error}")
            log.step(f"generate_{name}", "FAILED", error=str(error)[:2000], level="WARNING")

    tickets, hearings = store.read("tickets"), store.read("audiencias")

    def save(df: DataFrame, name: str) -> None:
        df.write.mode("overwrite").parquet(f"{folder}/{name}")

    def daily_report() -> None:
        window = report_window(store.spark, today)
        base = settle(daily.daily_base(tickets, hearings, window))
        save(base, "daily/data")
        save(daily.daily_totals(base, window["business_day"]), "daily/totals")
        save(daily.daily_entry_channel(base), "daily/entry_channel")
        save(daily.daily_resolved_assignee(base), "daily/resolved_assignee")
        save(daily.daily_hearings(base, window, "aberta"), "daily/hearings_open")
        save(daily.daily_hearings(base, window, "encerrada"), "daily/hearings_closed")
        save(daily.overdue_hearings(base, today), "daily/hearings_overdue")
        save(daily.exception_movements(tickets, window), "daily/exception_movements")

    def weekly_report() -> None:
        base = settle(weekly.weekly_base(tickets, today))
        save(base, "weekly/data")
        save(weekly.weekly_total(base, today), "weekly/total")
        save(weekly.weekly_by_day(base, today), "weekly/by_day")
        save(weekly.weekly_by_assignee(base), "weekly/by_assignee")
        save(weekly.weekly_by_channel(base), "weekly/by_channel")

    attempt("daily", daily_report)
    attempt("weekly", weekly_report)
    attempt(
        "sanitized_base",
        lambda: save(
            marts.sanitized_base(tickets, store.read("tickets_notificacao"), hearings, store.read("cases")), "sanitized"
        ),
    )
    export_semantic(
        marts.semantic_marts(tickets, hearings, store.read("ticket_assunto")), f"{folder}/semantic", failures.append
    )
    attempt("ai_ready", lambda: export_ai_ready(marts.ai_ready(tickets), f"{folder}/ai_ready", today))
    return failures


def _process_and_load(
    store: TableStore, raw: Mapping[str, DataFrame | None], rules: Rules, today: date, progress: Progress, log: RunLog
) -> None:
    """Write the snapshots of all treated and stored tables that are not there yet, then switch to them."""
    clock = time.perf_counter()
    stored = {name: store.read_or_empty(name, schema) for name, (schema, _) in GOLD.items()}
    rules = replace(rules, manual=_all_manual(rules.manual, stored["ticket_vinculos_manuais"]))
    silver = build_silver(raw, rules, today, progress.at, keep=progress.keep)
    staged = {}
    for name, df in silver.datasets().items():
        version = store.stage(df, f"silver_{name}", progress.snapshot)
        if store.has_rows(df, f"silver_{name}", version):
            staged[f"silver_{name}"] = version
    log.step("save_silver", seconds=time.perf_counter() - clock)

    clock = time.perf_counter()
    gold = build_gold(silver, stored, rules, log.run_id, progress.at, progress.keep)
    for name, df in gold.items():
        staged[name] = store.stage(df, name, progress.snapshot)
    progress.publish(staged)
    log.step("persist_gold", seconds=time.perf_counter() - clock)


def run_batch(
    store: TableStore, raw: Mapping[str, DataFrame | None], rules: Rules, out: str, today: date, at: datetime,
    run_key: str | None = None,
) -> str:
    """Run everything and return the final status: SUCCESS, PARTIAL (a feed or output missing) or FAILED.

    All stored tables are written as new snapshots first and switched together at the end, by one commit file. A run that
    died goes on where it stopped when it is started again with the same `run_key` (and the same feeds, rules and day);
    what it had finished is neither read nor computed again. Without a key nothing is left for a second start.
    """
    progress = Progress(store, run_key or uuid.uuid4().hex, GOLD, today, at)
    at = progress.at
    log = RunLog(store, "batch", run_id=progress.run_id)
    missing = [name for name in SOURCES if raw.get(name) is None]
    present = len(SOURCES) - len(missing)
    try:
        for name in SOURCES:
            if raw.get(name) is None:
                log.step(f"contract_validation_{name}", "EMPTY", 0, level="WARNING")
            elif not progress.done(f"contrato_{name}"):
                validate_or_raise(raw[name], name)
                progress.mark(f"contrato_{name}")
                log.step(f"contract_validation_{name}")
        if not present:
            log.finish("PARTIAL", 0, 0, "no source")
            progress.discard()
            return "PARTIAL"
        if not progress.published():
            _process_and_load(store, raw, rules, today, progress, log)
        records = store.read("tickets").count() + store.read("tickets_notificacao").count()
        failures = write_outputs(store, out, today, log)
        log.step("generate_outputs", error="; ".join(failures)[:2000] or None)
        status = "PARTIAL" if missing or failures else "SUCCESS"
        log.finish(status, records, present, "; ".join(failures)[:2000])
        progress.discard()
        return status
    except ContractError as error:
        log.step("validate_contracts", "FAILED", error=str(error)[:2000], level="ERROR")
        log.finish("FAILED", 0, present, str(error)[:2000])
        progress.discard()  # other rows must come, so this run has nothing to go on with
        raise
    except Exception as error:
        log.step("process_and_load", "FAILED", error=str(error)[:2000], level="ERROR")
        log.finish("FAILED", 0, present, str(error)[:2000])
        if run_key is None:
            progress.discard()
        raise
