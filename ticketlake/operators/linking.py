"""One-to-one linking of requests to notices inside a look-back window.

Requests are served in order of creation. A request takes the only unused notice that shares its account
and protocol (else its account and subject) and was created within the window before it; two or more make
it ambiguous.

Rows without a row of the other side near them in time leave at once: first by account alone (`_near`), so that keys are only
worked out for the rest, then by account and key (`_near_keys`).

Then the requests are peeled by joins (`peel`): where a request is the first to reach every notice of its
window, nobody has used one before it, so counts alone say what it gets. It leaves, with the notice it took,
and others become first. What is left after a few rounds is the contested core.

The core is walked. Serving in order is sequential inside an account, and one account may hold a third of all
rows, so the timeline of all accounts is range-partitioned into slices of bounded size. Each slice is
served on its own, then slices whose predecessor leaves other unused notices behind are served again with them,
until nothing changes. A slice only depends on the one before it, so the fixed point is the exact answer;
a gap or a full window makes a slice forget its past, which is why few rounds are needed.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable
from functools import reduce
from itertools import islice

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ticketlake.functions.dates import days_lag
from ticketlake.functions.text import strip
from ticketlake.operators.dedup import keep_one
from ticketlake.operators.timelines import SLICE_ROWS, along, sliced
from ticketlake.session import settle
from ticketlake.sources.canonical import coerce_ids

# Window, rules (name, key column, confidence) in order, and the notes of each outcome.
WINDOW_DAYS = 7
RULES = (
    ("matricula_protocolo", "protocolo_referencia", 0.95),
    ("titulo_normalizado", "assunto_normalizado", 0.85),
)
LISTED_CANDIDATES = 10
NOTE_NOT_LOADED = "Relatorio de notificacao nao foi encontrado na carga atual."
NOTE_BAD_MANUAL = "Vinculo manual aponta para ticket de notificacao inexistente na base carregada."
NOTE_NONE = "Nenhum criterio automatico encontrou notificacao correspondente."
NOTE_AMBIGUOUS = "Candidatos encontrados para analise manual: "
STATUS_NOT_LOADED = "NOTIFICACAO_NAO_CARREGADA"

DAY_MICROS = 86_400_000_000
#: Rounds of joins before the walk; each settles the requests that are first at all their notices.
PEEL_ROUNDS = 3
_GROUP, _ORDER = ["conta", "regra", "chave"], ["t", "lugar", "ticket_id"]
_NOTICE, _REQUEST, _HORIZON = 1, 2, 0
_SIDE = ("ticket_id", "matricula", "protocolo_referencia", "assunto_normalizado", "data_criacao")
#: Adds protocolo_referencia and assunto_normalizado to rows of a side.
Keys = Callable[[DataFrame], DataFrame]
_SERVED = (
    "fatia int, tipo string, ticket_id bigint, regra int, candidatos bigint, notificacao bigint, lista string,"
    " conta string, t bigint, protocolo string, assunto string"
)


def _micros(name: str):
    return F.unix_micros(F.col(name).cast("timestamp"))


def _key(name: str):
    return F.when(strip(F.col(name)) != "", F.col(name))


def _of_rule(values: list):
    """The value of the rule in `regra`; null when there is none."""
    first, second = values
    return F.when(F.col("regra") == 0, F.lit(first)).when(F.col("regra") == 1, F.lit(second))


def load_manual(links: DataFrame) -> DataFrame:
    """Manual links with both ids numeric; the latest one per request counts."""
    typed = coerce_ids(coerce_ids(links, "ticket_solicitacao_id"), "ticket_notificacao_id")
    return keep_one(
        typed, ["ticket_solicitacao_id"],
        [F.col("atualizado_em").desc_nulls_last(), F.col("ticket_notificacao_id").desc()],
    )


def link_candidates(
    requests: DataFrame, notices: DataFrame, window_days: int = WINDOW_DAYS, slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """How many notices each request could take under each rule, before any is used.

    Counted with running totals, not by forming pairs: the count in [t - window, t] is the total up to t
    less the total before t - window. `along` cuts the timelines anywhere, so no task sees more than a slice.
    """
    events = _timeline(_slim(requests), _slim(notices), window_days)
    counted = _candidate_counts(along(events, _GROUP, _ORDER, F.col("lugar") == _NOTICE, slice_rows=slice_rows))
    return counted.filter(F.col("candidatos") > 0).select(
        F.col("ticket_id").alias("ticket_solicitacao_id"),
        _of_rule([name for name, _, _ in RULES]).alias("criterio_vinculo"),
        F.col("candidatos").alias("quantidade_candidatos"),
    )


def _keyed(df: DataFrame) -> DataFrame:
    """One row per rule whose key a ticket has."""
    options = [F.struct(F.lit(i).alias("regra"), F.col(c).alias("chave")) for i, c in enumerate(("protocolo", "assunto"))]
    return df.select("ticket_id", "conta", "t", F.inline(F.array(*options))).filter(F.col("chave").isNotNull())


def _timeline(requests: DataFrame, notices: DataFrame, window_days: int) -> DataFrame:
    """Per account, rule and key: arrivals of notices, turns of requests, and the time where each request's window opens."""
    span = window_days * DAY_MICROS
    places = F.array(
        F.struct(F.col("t").alias("t"), F.lit(_REQUEST).alias("lugar")),
        F.struct((F.col("t") - span).alias("t"), F.lit(_HORIZON).alias("lugar")),
    )
    turns = _keyed(requests).select("ticket_id", "conta", "regra", "chave", F.inline(places))
    return turns.unionByName(_keyed(notices).withColumn("lugar", F.lit(_NOTICE)))


def _candidate_counts(timeline: DataFrame) -> DataFrame:
    """ticket_id, regra, candidatos: notices in the window of each request under each rule."""
    signed = F.when(F.col("lugar") == _REQUEST, F.col("total")).otherwise(-F.col("total"))
    return timeline.filter(F.col("lugar") != _NOTICE).groupBy("ticket_id", "regra").agg(F.sum(signed).alias("candidatos"))


def _peel_once(requests: DataFrame, notices: DataFrame, consumed: DataFrame, window_days: int, slice_rows: int) -> tuple:
    """Outcomes of the requests that are first at every notice of their window, and all that still have candidates."""
    turn = F.when(F.col("lugar") == _REQUEST, F.struct("t", "ticket_id"))
    timeline = settle(
        along(_timeline(requests, notices, window_days), _GROUP, _ORDER, F.col("lugar") == _NOTICE, turn, slice_rows)
    )
    counts = _candidate_counts(timeline).filter(F.col("candidatos") > 0)
    # The first rule with candidates is the one that counts.
    asked = counts.groupBy("ticket_id").agg(F.min(F.struct("regra", "candidatos")).alias("a")).select("ticket_id", "a.*")
    reach = F.when(F.col("seguinte.t") <= F.col("t") + window_days * DAY_MICROS, F.col("seguinte"))
    # Notices that are taken by hand at some turn stay contested.
    first = (
        timeline.filter((F.col("lugar") == _NOTICE) & reach.isNotNull())
        .groupBy(F.col("ticket_id").alias("notificacao"))
        .agg(F.min(reach).alias("primeiro"), F.collect_list(F.struct("regra", reach.alias("por"))).alias("regras"), F.min("t").alias("chegada"))
        .join(consumed.select(F.col("alvo").alias("notificacao")), "notificacao", "left_anti")
        .select("notificacao", "chegada", "primeiro", F.explode("regras").alias("r"))
        .filter(F.col("r.por") == F.col("primeiro"))
        .select("notificacao", "chegada", F.col("primeiro.ticket_id").alias("ticket_id"), F.col("r.regra").alias("regra"))
    )
    own = first.groupBy("ticket_id", "regra").agg(F.count(F.lit(1)).alias("candidatos"), F.min("notificacao").alias("unica"))
    sure = asked.join(own, ["ticket_id", "regra", "candidatos"])
    place = F.row_number().over(Window.partitionBy("ticket_id", "regra").orderBy("chegada", "notificacao"))
    listed = (
        first.withColumn("lugar", place).filter(F.col("lugar") <= LISTED_CANDIDATES)
        .groupBy("ticket_id", "regra").agg(F.array_sort(F.collect_list(F.struct("lugar", "notificacao"))).alias("ids"))
    )
    settled = settle(
        sure.join(listed, ["ticket_id", "regra"]).select(
            "ticket_id", "regra", "candidatos", F.when(F.col("candidatos") == 1, F.col("unica")).alias("notificacao"),
            F.when(F.col("candidatos") > 1, F.array_join(F.transform("ids", lambda x: x["notificacao"].cast("string")), ", ")).alias("lista"),
        )
    )
    return settled, asked.select("ticket_id")


def peel(
    requests: DataFrame, notices: DataFrame, consumed: DataFrame, window_days: int = WINDOW_DAYS, slice_rows: int = SLICE_ROWS,
    rounds: int = PEEL_ROUNDS,
) -> tuple[DataFrame | None, DataFrame, DataFrame]:
    """Outcomes settled by joins, and the requests and notices that are left for the walk.

    Arguments as of `serve_in_order`. A request without a candidate, taken ones gone, needs no outcome and leaves too.
    """
    done = None
    for _ in range(rounds):
        settled, asking = _peel_once(requests, notices, consumed, window_days, slice_rows)
        if settled.isEmpty():
            break
        done = settled if done is None else done.unionByName(settled)
        requests = settle(requests.join(asking, "ticket_id", "left_semi").join(settled, "ticket_id", "left_anti"))
        if requests.isEmpty():
            break
        taken = settled.filter(F.col("notificacao").isNotNull()).select(F.col("notificacao").alias("ticket_id"))
        notices = settle(notices.join(taken, "ticket_id", "left_anti"))
    return done, requests, notices


class _Timeline:
    """Unused notices of one account inside the window."""

    def __init__(self, window_days: int):
        self.span = window_days * DAY_MICROS
        self.queue: deque = deque()
        self.open: dict[int, tuple] = {}
        self.by_key: tuple[dict, ...] = ({}, {})

    def arrive(self, t: int, ticket: int, keys: tuple) -> None:
        self.queue.append((t, ticket))
        self.open[ticket] = (t, keys)
        for index, key in zip(self.by_key, keys):
            if key is not None:
                index.setdefault(key, {})[ticket] = t

    def remove(self, ticket: int) -> int | None:
        found = self.open.pop(ticket, None)
        if found is None:
            return None
        for index, key in zip(self.by_key, found[1]):
            if key is not None:
                del index[key][ticket]
                if not index[key]:
                    del index[key]
        return found[0]

    def expire(self, now: int) -> None:
        while self.queue and self.queue[0][0] < now - self.span:
            self.remove(self.queue.popleft()[1])

    def serve(self, now: int, keys: tuple) -> tuple | None:
        """(rule, count, notice or None, listed ids or None) of a request, None without candidates."""
        self.expire(now)
        for rule, (index, key) in enumerate(zip(self.by_key, keys)):
            found = index.get(key) if key is not None else None
            if not found:
                continue
            if len(found) > 1:
                return rule, len(found), None, ", ".join(map(str, islice(found, LISTED_CANDIDATES)))
            notice = next(iter(found))
            self.remove(notice)
            return rule, 1, notice, None
        return None


def _text(value):
    return value if isinstance(value, str) else None


def _serve_slice(window_days: int):
    def serve(key: tuple, events: pd.DataFrame, carried: pd.DataFrame) -> pd.DataFrame:
        out = []
        line, account, now = _Timeline(window_days), None, None
        if len(carried):
            carried = carried.sort_values(["t", "ticket_id"])
            account = carried["conta"].iloc[0]
            for row in carried.itertuples(index=False):
                line.arrive(row.t, row.ticket_id, (_text(row.protocolo), _text(row.assunto)))
        for row in events.sort_values(["conta", "t", "ordem", "ticket_id"]).itertuples(index=False):
            if row.conta != account:
                line, account = _Timeline(window_days), row.conta
            now = row.t
            keys = (_text(row.protocolo), _text(row.assunto))
            if row.ordem == 0:
                line.arrive(row.t, row.ticket_id, keys)
            elif row.alvo >= 0:
                line.remove(row.alvo)
            else:
                result = line.serve(row.t, keys)
                if result is not None:
                    rule, count, notice, listed = result
                    out.append((key[0], "R", row.ticket_id, rule, count, notice, listed, None, None, None, None))
        if now is not None:
            line.expire(now)
            for ticket, (t, keys) in line.open.items():
                out.append((key[0], "S", ticket, None, None, None, None, account, t, *keys))
        frame = pd.DataFrame(out, columns=[part.split()[0] for part in _SERVED.split(",")], dtype=object)
        whole = ["fatia", "ticket_id", "regra", "candidatos", "notificacao", "t"]
        return frame.astype({name: "Int64" for name in whole})

    return serve


def _serve(slices: DataFrame, carried: DataFrame, window_days: int) -> DataFrame:
    return (
        slices.groupBy("fatia").cogroup(carried.groupBy("fatia")).applyInPandas(_serve_slice(window_days), _SERVED)
    )


def serve_in_order(
    requests: DataFrame, notices: DataFrame, consumed: DataFrame, window_days: int, slice_rows: int
) -> DataFrame:
    """Outcome of every request that has an unused candidate when its turn comes.

    `requests`, `notices`: (ticket_id, conta, t, protocolo, assunto), all of conta and t present.
    `consumed`: (alvo, conta, t, ticket_id), notices taken by hand when request `ticket_id` has its turn.
    """
    columns = ["conta", "t", "ordem", "ticket_id", "alvo", "protocolo", "assunto"]
    notices = _with_partner(notices, requests)
    nothing = F.lit(None).cast("string")
    events = (
        notices.select("conta", "t", F.lit(0).alias("ordem"), "ticket_id", F.lit(-1).cast("bigint").alias("alvo"),
                       "protocolo", "assunto")
        .unionByName(
            requests.select("conta", "t", F.lit(1).alias("ordem"), "ticket_id",
                            F.lit(-1).cast("bigint").alias("alvo"), "protocolo", "assunto")
        )
        .unionByName(
            consumed.select("conta", "t", F.lit(1).alias("ordem"), "ticket_id", "alvo",
                            nothing.alias("protocolo"), nothing.alias("assunto"))
        )
        .select(*columns)
    )
    # The id is part of the order, so neither a hot account nor a hot instant can make a slice grow.
    slices, parts = sliced(events, ["conta", "t", "ordem", "ticket_id"], slice_rows)
    # One row per slice: its first and last account, and the slice that follows it.
    bounds = settle(
        slices.groupBy("fatia").agg(F.min("conta").alias("inicio"), F.min_by("t", F.struct("conta", "t")).alias("t0"))
    )
    follows = bounds.select(
        F.lag("fatia").over(Window.orderBy("fatia")).alias("anterior"), F.col("fatia").alias("seguinte"), "inicio", "t0"
    )

    def handed_over(served: DataFrame) -> DataFrame:
        state = served.filter(F.col("tipo") == "S").select("fatia", "ticket_id", "conta", "t", "protocolo", "assunto")
        reaches = (
            (F.col("fatia") == F.col("anterior")) & (F.col("conta") == F.col("inicio"))
            & (F.col("t") >= F.col("t0") - window_days * DAY_MICROS)
        )
        return state.join(follows, reaches).select(
            F.col("seguinte").alias("fatia"), "ticket_id", "conta", "t", "protocolo", "assunto"
        )

    carried = slices.sparkSession.createDataFrame(
        [], "fatia int, ticket_id bigint, conta string, t bigint, protocolo string, assunto string"
    )
    served = settle(_serve(slices, carried, window_days))
    versions, asked = [served], []  # what each round served, and which slices it served anew
    for _ in range(parts - 1):
        fresh = settle(handed_over(served))
        # Only the slices behind those just served can have other notices handed over now.
        before = carried
        if asked:
            behind = follows.join(asked[-1].select(F.col("fatia").alias("anterior")), "anterior").select(F.col("seguinte").alias("fatia"))
            before = carried.join(behind, "fatia", "left_semi")
        changed = settle(
            fresh.select("fatia", "ticket_id", F.lit(1).alias("novo"))
            .join(before.select("fatia", "ticket_id", F.lit(1).alias("velho")), ["fatia", "ticket_id"], "full")
            .filter(F.col("novo").isNull() | F.col("velho").isNull())
            .select("fatia").distinct()
        )
        if changed.isEmpty():
            break
        now = fresh.join(changed, "fatia", "left_semi")
        served = settle(_serve(slices.join(changed, "fatia", "left_semi"), now, window_days))
        carried = settle(carried.join(changed, "fatia", "left_anti").unionByName(now))
        versions.append(served)
        asked.append(changed)
    # The latest version of each slice counts; the earlier ones stay as they were written.
    outcomes = []
    for k, rows in enumerate(versions):
        found = rows.filter(F.col("tipo") == "R")
        for later in asked[k:]:
            found = found.join(later, "fatia", "left_anti")
        outcomes.append(found.select("ticket_id", "regra", "candidatos", "notificacao", "lista"))
    return reduce(DataFrame.unionByName, outcomes)


def _placed(df: DataFrame, *more) -> DataFrame:
    """Rows with an account and a time, and `more` columns."""
    return df.filter((strip(F.col("matricula")) != "") & F.col("data_criacao").isNotNull()).select(
        "ticket_id", F.col("matricula").alias("conta"), _micros("data_criacao").alias("t"), *more
    )


def _slim(df: DataFrame) -> DataFrame:
    return _placed(df, _key("protocolo_referencia").alias("protocolo"), _key("assunto_normalizado").alias("assunto"))


def _cell(window_days: int):
    """Stretch of time of a row, as long as the window: a request reaches notices of its own stretch and of the one before."""
    return F.expr(f"t div {max(window_days, 1) * DAY_MICROS}")


def _meeting(requests: DataFrame, notices: DataFrame, key: list[str], window_days: int) -> tuple[DataFrame, DataFrame]:
    """Ids of the rows of both sides that share `key` and a stretch of time with a row of the other side.

    A row without such a row cannot be linked. Only numbers are shuffled, one per place, which fold before the shuffle; two
    places of one number keep rows too many and lose none.
    """
    cell = _cell(window_days)
    asks = requests.select("ticket_id", F.explode(F.array(F.xxhash64(*key, cell - 1), F.xxhash64(*key, cell))).alias("lugar"))
    offers = notices.select("ticket_id", F.xxhash64(*key, cell).alias("lugar"))
    sides = asks.select("lugar", F.lit(True).alias("pede")).unionByName(offers.select("lugar", F.lit(False).alias("pede")))
    met = settle(sides.groupBy("lugar").agg(F.bool_or("pede").alias("a"), F.bool_and("pede").alias("b")).filter("a AND NOT b").select("lugar"))
    asking, offering = [settle(side.join(met, "lugar", "left_semi").select("ticket_id").distinct()) for side in (asks, offers)]
    return asking, offering


def _near(requests: DataFrame, notices: DataFrame, window_days: int, keys: Keys | None) -> list[DataFrame]:
    """Rows of both sides with one of the other side near them in their account, with their keys."""
    found = _meeting(_placed(requests), _placed(notices), ["conta"], window_days)
    close = [side.join(ids, "ticket_id", "left_semi") for side, ids in zip((requests, notices), found)]
    return [settle((keys(side) if keys else side).select(*_SIDE)) for side in close]


def _with_partner(df: DataFrame, other: DataFrame) -> DataFrame:
    """Rows whose (account, protocol) or (account, subject) occurs on the other side."""
    keys = other.selectExpr(
        "conta", "inline(array(struct(0 AS regra, protocolo AS chave), struct(1 AS regra, assunto AS chave)))"
    ).filter(F.col("chave").isNotNull()).distinct()
    hit = (
        df.selectExpr(
            "ticket_id", "conta",
            "inline(array(struct(0 AS regra, protocolo AS chave), struct(1 AS regra, assunto AS chave)))",
        )
        .filter(F.col("chave").isNotNull())
        .join(keys, ["conta", "regra", "chave"], "left_semi")
        .select("ticket_id").distinct()
    )
    return df.join(hit, "ticket_id", "left_semi")


def _near_keys(requests: DataFrame, notices: DataFrame, window_days: int) -> tuple[DataFrame, DataFrame]:
    """Rows of both sides with one of the other side near them under the same account and key."""
    asking, offering = _meeting(_keyed(requests), _keyed(notices), _GROUP, window_days)
    return settle(requests.join(asking, "ticket_id", "left_semi")), settle(notices.join(offering, "ticket_id", "left_semi"))


def link_tickets(
    requests: DataFrame,
    notices: DataFrame | None,
    manual: DataFrame | None = None,
    window_days: int = WINDOW_DAYS,
    slice_rows: int = SLICE_ROWS,
    keys: Keys | None = None,
) -> DataFrame:
    """One outcome row per request.

    Both sides: (ticket_id, matricula, protocolo_referencia, assunto_normalizado, data_criacao), one row
    per ticket. `manual` as given by `load_manual`. `notices` is None when that feed was not loaded. With `keys`, both
    sides come without protocolo_referencia and assunto_normalizado, and only rows that could link get them.
    """
    base = requests.select("ticket_id", "data_criacao")
    null = F.lit(None)
    dates = [
        F.col("data_criacao").alias("data_entrada_reclamacao"),
        F.col("data_criacao").alias("data_criacao_solicitacao"),
    ]
    if notices is None:
        return base.select(
            F.col("ticket_id").alias("ticket_solicitacao_id"),
            null.cast("bigint").alias("ticket_notificacao_id"),
            F.lit(STATUS_NOT_LOADED).alias("status_vinculo"),
            null.cast("string").alias("criterio_vinculo"),
            null.cast("double").alias("confianca_vinculo"),
            *dates,
            null.cast("timestamp_ntz").alias("data_criacao_notificacao"),
            null.cast("int").alias("dias_defasagem_abertura"),
            F.lit(0).cast("bigint").alias("quantidade_candidatos"),
            F.lit(NOTE_NOT_LOADED).alias("observacao"),
        )

    near_requests, near_notices = _near(requests, notices, window_days, keys)
    open_notices = _slim(near_notices)
    if manual is None:
        by_hand = base.select(
            "ticket_id", null.cast("bigint").alias("_mid"), null.cast("string").alias("_mnota"),
            null.cast("timestamp_ntz").alias("_mdata"), F.lit(False).alias("_mvale"),
        ).limit(0)
        consumed = open_notices.select(
            F.col("ticket_id").alias("alvo"), "conta", "t", "ticket_id"
        ).limit(0)
        automatic = near_requests
    else:
        manual = settle(manual)
        aimed = manual.select(F.col("ticket_notificacao_id").alias("_nid")).distinct()
        known = notices.select(F.col("ticket_id").alias("_nid"), F.col("data_criacao").alias("_ndata")).join(aimed, "_nid", "left_semi")
        by_hand = settle(
            manual.select(
                F.col("ticket_solicitacao_id").alias("ticket_id"), F.col("ticket_notificacao_id").alias("_mid"),
                F.col("justificativa").alias("_mnota"),
            )
            .join(known, F.col("_mid") == F.col("_nid"), "left")
            .select("ticket_id", "_mid", "_mnota", F.col("_ndata").alias("_mdata"), F.col("_nid").isNotNull().alias("_mvale"))
        )
        turns = (
            base.filter(F.col("data_criacao").isNotNull())
            .select("ticket_id", _micros("data_criacao").alias("_vez"))
            .join(by_hand.filter("_mvale").select("ticket_id", F.col("_mid").alias("alvo")), "ticket_id")
        )
        # First turn at which each notice is taken by hand, on the timeline of the notice.
        taken = turns.groupBy("alvo").agg(F.min(F.struct("_vez", "ticket_id")).alias("_primeira"))
        placed = settle(
            open_notices.select(F.col("ticket_id").alias("alvo"), "conta", F.col("t").alias("_chegada")).join(taken, "alvo")
        )
        early = placed.filter(F.col("_primeira._vez") < F.col("_chegada")).select(F.col("alvo").alias("ticket_id"))
        consumed = placed.filter(F.col("_primeira._vez") >= F.col("_chegada")).select(
            "alvo", "conta", F.col("_primeira._vez").alias("t"), F.col("_primeira.ticket_id").alias("ticket_id")
        )
        open_notices = open_notices.join(early, "ticket_id", "left_anti")
        automatic = near_requests.join(by_hand.select("ticket_id"), "ticket_id", "left_anti")

    asking, open_notices = _near_keys(settle(_slim(automatic)), settle(open_notices), window_days)
    peeled, asking, open_notices = peel(asking, open_notices, consumed, window_days, slice_rows)
    served = serve_in_order(asking, open_notices, consumed, window_days, slice_rows)
    if peeled is not None:
        served = served.unionByName(peeled)
    # Few requests link, so their dates are found from their side, and requests without a notice are in no join.
    linked_dates = (
        served.select("ticket_id", "notificacao").filter(F.col("notificacao").isNotNull())
        .join(near_notices.select(F.col("ticket_id").alias("notificacao"), F.col("data_criacao").alias("_cdata")), "notificacao")
        .drop("notificacao")
    )
    outcomes = settle(served.join(linked_dates, "ticket_id", "left"))
    rule_name = _of_rule([name for name, _, _ in RULES])
    confidence = _of_rule([value for _, _, value in RULES])
    linked, many = F.col("notificacao").isNotNull(), F.col("lista").isNotNull()
    is_manual, valid = F.col("_mid").isNotNull(), F.coalesce(F.col("_mvale"), F.lit(False))
    joined = base.join(by_hand, "ticket_id", "left").join(outcomes, "ticket_id", "left")
    notice_date = F.when(is_manual & valid, F.col("_mdata")).when(linked, F.col("_cdata"))
    return joined.select(
        F.col("ticket_id").alias("ticket_solicitacao_id"),
        F.when(is_manual & valid, F.col("_mid")).when(~is_manual, F.col("notificacao")).alias("ticket_notificacao_id"),
        F.when(is_manual & valid, "MANUAL").when(is_manual, "SEM_VINCULO").when(linked, "VINCULADO")
        .when(many, "AMBIGUO").otherwise("SEM_VINCULO").alias("status_vinculo"),
        F.when(is_manual & valid, "manual").when(is_manual, "manual_invalido").otherwise(rule_name).alias("criterio_vinculo"),
        F.when(is_manual & valid, 1.0).when(is_manual, 0.0).otherwise(confidence).alias("confianca_vinculo"),
        *dates,
        notice_date.alias("data_criacao_notificacao"),
        days_lag(F.col("data_criacao"), notice_date).alias("dias_defasagem_abertura"),
        F.when(is_manual & valid, F.lit(1)).when(is_manual, F.lit(0))
        .otherwise(F.coalesce("candidatos", F.lit(0))).cast("bigint").alias("quantidade_candidatos"),
        F.when(is_manual & valid, F.col("_mnota")).when(is_manual, F.lit(NOTE_BAD_MANUAL))
        .when(many, F.concat(F.lit(NOTE_AMBIGUOUS), "lista")).when(linked, null.cast("string"))
        .otherwise(F.lit(NOTE_NONE)).alias("observacao"),
    )


def ambiguous_candidates(
    links: DataFrame, requests: DataFrame, notices: DataFrame, window_days: int = WINDOW_DAYS, keys: Keys | None = None
) -> DataFrame:
    """Every notice that an ambiguous request of `links` could have taken at its turn; the note names the first few only.

    A notice counts if no request before took it. Cells as long as the window bring a request to the notices of its own
    cell and the one before; the rows made are the rows returned, but for those outside the window or taken. Sides and
    `keys` as of `link_tickets`.
    """
    span = window_days * DAY_MICROS
    number = F.when(F.col("criterio_vinculo") == RULES[0][0], 0).when(F.col("criterio_vinculo") == RULES[1][0], 1)
    # Outcomes are few beside requests and are read three times.
    marked = settle(
        links.select("ticket_solicitacao_id", "ticket_notificacao_id", "status_vinculo", "criterio_vinculo", "data_criacao_solicitacao")
        .filter((F.col("status_vinculo") == "AMBIGUO") | F.col("ticket_notificacao_id").isNotNull())
    )
    open_cases = marked.filter("status_vinculo = 'AMBIGUO'").select(F.col("ticket_solicitacao_id").alias("ticket_id"), number.alias("regra"), "criterio_vinculo")
    requests, notices = _near(requests.join(open_cases, "ticket_id", "left_semi"), notices, window_days, keys)
    cell = _cell(window_days)
    asked = (
        _keyed(_slim(requests)).join(open_cases, ["ticket_id", "regra"])
        .select("ticket_id", "criterio_vinculo", F.col("t").alias("vez"), *_GROUP, F.explode(F.array(cell - 1, cell)).alias("celula"))
    )
    turn = F.struct(_micros("data_criacao_solicitacao").alias("vez"), F.col("ticket_solicitacao_id").alias("ticket_id"))
    used = (
        marked.filter(F.col("ticket_notificacao_id").isNotNull() & F.col("data_criacao_solicitacao").isNotNull())
        .groupBy(F.col("ticket_notificacao_id").alias("notificacao")).agg(F.min(turn).alias("tomada"))
    )
    offered = _keyed(_slim(notices)).select(F.col("ticket_id").alias("notificacao"), "t", *_GROUP, cell.alias("celula")).join(used, "notificacao", "left")
    return (
        asked.join(offered, [*_GROUP, "celula"])
        .filter((F.col("t") <= F.col("vez")) & (F.col("t") >= F.col("vez") - span))
        .filter(F.col("tomada").isNull() | (F.col("tomada") > F.struct("vez", "ticket_id")))
        .select(F.col("ticket_id").alias("ticket_solicitacao_id"), "criterio_vinculo", F.col("notificacao").alias("ticket_notificacao_id"))
    )


def attach_links(tickets: DataFrame, links: DataFrame | None) -> DataFrame:
    """Link outcome on each ticket; the ticket itself and its creation fill what is missing."""
    added = (
        "ticket_notificacao_id", "data_entrada_reclamacao", "data_criacao_solicitacao", "data_criacao_notificacao",
        "dias_defasagem_abertura", "criterio_vinculo", "confianca_vinculo", "status_vinculo",
    )
    if links is None:
        kinds = ("bigint", "timestamp_ntz", "timestamp_ntz", "timestamp_ntz", "int", "string", "double", "string")
        joined = tickets.withColumns({c: F.lit(None).cast(k) for c, k in zip(added, kinds)})
        joined = joined.withColumns(
            {
                "ticket_solicitacao_id": F.lit(None).cast("bigint"),
                "data_entrada_reclamacao": F.col("data_criacao"),
                "status_vinculo": F.lit(STATUS_NOT_LOADED),
            }
        )
    else:
        slim = links.select("ticket_solicitacao_id", *added)
        joined = tickets.join(slim, F.col("ticket_id") == F.col("ticket_solicitacao_id"), "left")
    return joined.withColumns(
        {
            "ticket_solicitacao_id": F.coalesce("ticket_solicitacao_id", "ticket_id"),
            "data_criacao_solicitacao": F.coalesce("data_criacao_solicitacao", "data_criacao"),
        }
    )
