"""Work orders: preparation, filling of missing ticket fields, and the choice of the matching order."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ticketlake.functions.text import (
    blank_to_null, fixed2, jaccard, join_key_text, norm_identifier, norm_subject, norm_text, round4, shared_tokens, strip,
    territory, token_set, words_of,
)
from ticketlake.operators.dedup import dedup_first, dedup_latest, keep_one
from ticketlake.operators.filters import OPEN_STATUSES
from ticketlake.schemas import WORK_ORDER_ALIASES, WORK_ORDER_FEED
from ticketlake.session import settle
from ticketlake.sources.canonical import canonicalize, headers_by_name, quoted, with_required

# Order column -> ticket column it may fill; score weights, bands and thresholds.
FILL_COLUMNS = {
    "bairro": "bairro",
    "municipio": "municipio",
    "nome_logradouro": "logradouro",
    "endereco_requerente": "endereco",
    "numero_porta": "numero_porta",
    "complemento": "complemento",
    "telefone": "telefone",
    "nome_cliente": "nome_cliente_gss",
    "nome_requerente": "nome_requerente_gss",
}
MIN_SCORE, MIN_MARGIN = 0.55, 0.10
WEIGHT_DATE, WEIGHT_SERVICE, WEIGHT_STATUS = 0.50, 0.35, 0.15
DATE_BANDS = ((3, 1.0), (7, 0.85), (15, 0.65), (30, 0.40), (60, 0.20))
TICKET_WORDS = (
    "titulo", "assunto", "tipo_solicitacao", "tipo_manifestacao", "classificacao_solicitacoes", "canais_de_atrito",
)
TICKET_DATES = ("data_entrada_reclamacao", "data_criacao_solicitacao", "data_criacao")
#: Orders (two of each class) up to which an account's tickets simply meet them all.
DIRECT_CLASSES = 200
ORDER_FIELDS = ["matricula", "gss_os_id", "numero_os", "data_emissao", "status_os_gss", "tokens_servico", "dia_os"]
#: What matching reads of prepared orders.
MATCHED_FIELDS = [c for c in ORDER_FIELDS if c != "dia_os"]
_ASKER = ["tokens", "aberto"]
MATCH_COLUMNS = {
    "numero_os": "string", "numero_os_original": "string", "numero_os_gss": "string", "gss_os_id": "string",
    "origem_numero_os": "string", "status_vinculo_os": "string", "score_vinculo_os": "double",
    "criterio_vinculo_os": "string",
}
HORIZON = DATE_BANDS[-1][0]
#: Accounts of orders without a ticket up to which they are handed to every task, instead of shuffling all orders.
ABSENT_ACCOUNTS = 50_000


def joined_words(*cols: Column) -> Column:
    """Filled cells joined by a blank."""
    return F.concat_ws(" ", *[F.nullif(strip(c), F.lit("")) for c in cols])


def _accounts(df: DataFrame, name: str) -> DataFrame:
    """Distinct normalised accounts; equal raw cells fold before they are normalised."""
    raw = df.select(quoted(name).cast("string").alias("_crua")).distinct()
    return with_required(raw, "_conta", F.nullif(norm_identifier(F.col("_crua")), F.lit(""))).select("_conta").distinct()


def semi_filter_orders(
    orders: DataFrame, tickets: DataFrame, absent_accounts: int = ABSENT_ACCOUNTS,
    keep: Callable[[DataFrame], DataFrame] = settle,
) -> DataFrame:
    """Orders whose account occurs in the tickets; without an account column nothing is filtered.

    The accounts that only orders have are found first, on accounts alone. While they are few, their orders are dropped
    where they lie, and no order row is shuffled; else orders meet the accounts of the tickets. Both give the same rows.
    `keep` says where these accounts are materialised.
    """
    found = headers_by_name(orders).get("matricula")
    if not found:
        return orders
    wanted = _accounts(tickets, "matricula")
    absent = keep(_accounts(orders, found[0]).join(wanted, "_conta", "left_anti"))
    kept = with_required(orders, found[0], F.nullif(norm_identifier(quoted(found[0]).cast("string")), F.lit("")))
    same = quoted(found[0]) == F.col("_conta")
    if absent.limit(absent_accounts + 1).count() <= absent_accounts:
        return kept.join(F.broadcast(absent), same, "left_anti")
    return kept.join(wanted, same, "left_semi")


def prepare_orders(raw: DataFrame, today: date, tie_break: tuple[str, ...] = ("row_seq",)) -> DataFrame:
    """Canonical orders with id, status on `today`, service text and tokens; latest row per order."""
    df = canonicalize(raw, WORK_ORDER_ALIASES, WORK_ORDER_FEED, keep_extra=True)
    df = with_required(df, "numero_os", norm_identifier(F.col("numero_os")))
    df = df.withColumn("ano_os", norm_identifier(F.col("ano_os")))
    named = F.concat(F.nullif(F.col("ano_os"), F.lit("")), F.lit("-"), F.nullif(F.col("numero_os"), F.lit("")))
    df = df.withColumn("gss_os_id", F.coalesce(named, F.col("numero_os")))
    # Only the key is computed for every raw row; the rest is for the rows that stay.
    df = dedup_latest(df, ["gss_os_id"], ["arquivo_mtime", *tie_break])
    overdue = F.col("previsao_conclusao") < F.lit(today).cast("timestamp_ntz")
    df = df.withColumns(
        {
            "matricula": norm_identifier(F.col("matricula")),
            "status_os_gss": F.when(F.col("data_execucao").isNotNull(), "EXECUTADA")
            .when(overdue, "PENDENTE_VENCIDA")
            .when(F.col("previsao_conclusao").isNotNull() | F.col("data_emissao").isNotNull(), "PENDENTE"),
            "_texto": joined_words(
                F.col("servico_executado"), F.col("solicitacao_associada"), F.col("tipo_solicitacao_gss")
            ),
        }
    )
    df = df.withColumns(
        {"bloco": territory(F.col("matricula")), "servico_normalizado": norm_subject(F.col("_texto"))}
    ).drop("_texto")
    return df.withColumn("tokens_servico", words_of(F.col("servico_normalizado")))


def spread_nulls(key: Column, unique: Column) -> Column:
    """Join key whose missing values become distinct non-matching texts.

    Rows without a key would otherwise all hash to one task of a shuffled left join.
    """
    return F.coalesce(key, F.concat(F.lit("\x00"), unique.cast("string")))


def order_context(orders: DataFrame, columns: Mapping[str, str] = FILL_COLUMNS) -> DataFrame:
    """The fullest, then latest, order row of each account."""
    names = [c for c in columns if c in orders.columns]
    context = orders.filter(F.col("matricula").isNotNull()).withColumns({c: blank_to_null(F.col(c)) for c in names})
    filled = sum((F.col(c).isNotNull().cast("int") for c in names), F.lit(0))
    newest = [F.col(c).desc_nulls_last() for c in ("data_emissao", "data_execucao", "data_agendamento", "gss_os_id")]
    best = keep_one(context.withColumn("_preenchidos", filled), ["matricula"], [F.desc("_preenchidos"), *newest])
    return best.select("matricula", *names)


def enrich_missing(
    tickets: DataFrame, orders: DataFrame | None, columns: Mapping[str, str] = FILL_COLUMNS,
    context: DataFrame | None = None,
) -> DataFrame:
    """Fill blank ticket fields from the account's best order row; filled fields stay.

    `context` is the `order_context` of the orders when the caller has it already.
    """
    absent = [t for t in columns.values() if t not in tickets.columns]
    tickets = tickets.withColumns({t: F.lit(None).cast("string") for t in absent}) if absent else tickets
    if orders is None:
        return tickets
    context = order_context(orders, columns) if context is None else context
    context = context.select(
        F.col("matricula").alias("_conta"),
        *[F.col(c).alias(f"_ctx_{c}") for c in context.columns if c != "matricula"],
    )
    joined = tickets.join(
        context, spread_nulls(F.col("matricula"), F.col("ticket_id")) == F.col("_conta"), "left"
    )
    fills = {
        target: F.when(blank_to_null(F.col(target)).isNull(), F.coalesce(F.col(f"_ctx_{source}"), F.col(target)))
        .otherwise(F.col(target))
        for source, target in columns.items()
        if f"_ctx_{source}" in context.columns
    }
    return joined.withColumns(fills).select(*tickets.columns)


def date_score(distance: Column) -> Column:
    """Score of a distance in days; 0 beyond the last band or when a date is missing."""
    score = F.lit(0.0)
    for days, value in reversed(DATE_BANDS):
        score = F.when(F.abs(distance) <= days, F.lit(value)).otherwise(score)
    return score


def status_score(order_status: Column, ticket_is_open: Column) -> Column:
    pending = order_status.isin("PENDENTE", "PENDENTE_VENCIDA")
    return (
        F.when(pending & ticket_is_open, F.lit(1.0))
        .when(pending, F.lit(0.75))
        .when(order_status == "EXECUTADA", F.lit(0.60))
        .otherwise(F.lit(0.30))
    )


def _newest() -> list[Column]:
    return [F.col("data_emissao").desc_nulls_last(), F.col("gss_os_id").desc()]


def _best_two(df: DataFrame, keys: list[str], *first: Column) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*first, *_newest()))
    return df.withColumn("_lugar", place).filter(F.col("_lugar") <= 2).drop("_lugar")


def score_orders(tickets: DataFrame, orders: DataFrame, direct_classes: int = DIRECT_CLASSES) -> DataFrame:
    """Best and second-best score per ticket over all orders of its account.

    A score depends on an order only through its class (status and service tokens) and its distance in
    days. So the two best orders of each class are all a ticket can need near its day. Beyond the date
    bands the day does not count: `far_orders` ranks an account's orders once for each set of ticket
    words. If one of its two lies near a ticket after all, it scores higher there, so that no third
    order is ever missed; only the far score of that order is left out.

    `tickets(ticket_id, matricula, dia, aberto, tokens)`,
    `orders(gss_os_id, numero_os, matricula, data_emissao, status_os_gss, tokens_servico)`.
    """
    # Read four times below; the words of a ticket are the costly part.
    tickets = settle(tickets.withColumn("tokens", F.coalesce("tokens", F.array().cast("array<string>"))))
    slim = orders.filter(F.col("matricula").isNotNull()).select(
        "matricula", "gss_os_id", "numero_os", "data_emissao", "status_os_gss", "tokens_servico",
        F.to_date("data_emissao").alias("dia_os"),
    )
    kind = ["matricula", "status_os_gss", "tokens_servico"]
    newest = _best_two(slim, kind)

    # Days that occur in an account's tickets, each meeting the two best orders of each class and day within the last band.
    # Orders are dealt by account and cell once, for their windows and for the join.
    cell = F.floor(F.unix_date(F.col("dia")) / HORIZON)
    days = (
        tickets.filter(F.col("dia").isNotNull())
        .select("matricula", "dia").distinct()
        .select("matricula", "dia", F.explode(F.array(cell - 1, cell, cell + 1)).alias("_celula"))
    )
    dated = slim.filter(F.col("dia_os").isNotNull()).withColumn(
        "_celula", F.floor(F.unix_date(F.col("dia_os")) / HORIZON)
    )
    dated = _best_two(dated.repartition("matricula", "_celula"), ["_celula", *kind, "dia_os"])
    distance = F.datediff("dia", "dia_os")
    near_days = days.join(dated, ["matricula", "_celula"]).filter(F.abs(distance) <= HORIZON).drop("_celula")
    # Dealt by account and day, as the join with the tickets below wants them.
    near = _best_two(
        near_days.repartition("matricula", "dia").withColumn("date_score", date_score(distance)), ["dia", *kind],
        F.desc("date_score"),
    )

    close = tickets.join(near, ["matricula", "dia"])
    outside = F.col("dia").isNull() | F.col("dia_os").isNull() | (F.abs(distance) > HORIZON)
    words = ["matricula", "tokens", "aberto"]
    far = tickets.join(far_orders(tickets.select(*words).distinct(), newest, direct_classes), words).filter(outside)

    pairs = close.unionByName(far.withColumn("date_score", F.lit(0.0)).select(*close.columns))
    pairs = pairs.withColumn("_comuns", shared_tokens(F.col("tokens"), F.col("tokens_servico"))).withColumns(
        {
            "service_score": jaccard(F.col("tokens"), F.col("tokens_servico"), F.col("_comuns")),
            "status_score": status_score(F.col("status_os_gss"), F.col("aberto")),
        }
    ).select(
        "ticket_id", "gss_os_id", "numero_os", "data_emissao", "date_score", "service_score", "status_score",
        (
            F.lit(WEIGHT_DATE) * F.col("date_score")
            + F.lit(WEIGHT_SERVICE) * F.col("service_score")
            + F.lit(WEIGHT_STATUS) * F.col("status_score")
        ).alias("score"),
    )
    by_ticket = Window.partitionBy("ticket_id").orderBy(F.desc("score"), *_newest())
    top = pairs.withColumn("_lugar", F.row_number().over(by_ticket)).filter(F.col("_lugar") <= 2)
    fields = ["gss_os_id", "numero_os", "date_score", "service_score", "status_score", "score"]
    return top.groupBy("ticket_id").agg(
        F.min_by(F.struct(*fields), "_lugar").alias("melhor"),
        F.coalesce(F.max(F.when(F.col("_lugar") == 2, F.col("score"))), F.lit(0.0)).alias("segundo"),
    )


def _overlap_score(words: Column, service: Column) -> Column:
    return F.lit(WEIGHT_SERVICE) * words + F.lit(WEIGHT_STATUS) * service


def _ranked_two(pairs: DataFrame, asker: Sequence[str] = ("_pedido",)) -> DataFrame:
    """Score of each pair without a date, and the two best orders of each asker."""
    scored = pairs.withColumns(
        {"_js": jaccard(F.col("tokens"), F.col("tokens_servico")), "_ss": status_score(F.col("status_os_gss"), F.col("aberto"))}
    )
    return _best_two(scored.withColumn("_nota", _overlap_score(F.col("_js"), F.col("_ss"))), list(asker), F.desc("_nota"))


def far_orders(askers: DataFrame, newest: DataFrame, direct_classes: int = DIRECT_CLASSES) -> DataFrame:
    """The two best orders of the account of each (matricula, tokens, aberto), dates left aside.

    `newest` has up to two orders of each class. Askers of an account with few of them meet them all; in larger accounts,
    where that would grow with askers times classes, they go through the token index. Both ways are exact.
    """
    newest = settle(newest.select(*ORDER_FIELDS))
    large = settle(newest.groupBy("matricula").count().filter(F.col("count") > direct_classes).select("matricula"))
    if large.isEmpty():
        return _far_direct(askers, newest)
    asked = settle(askers.withColumn("_pedido", F.monotonically_increasing_id()))
    few = [df.join(large, "matricula", "left_anti") for df in (asked, newest)]
    many = [df.join(large, "matricula", "left_semi") for df in (asked, newest)]
    return _far_direct(*few).unionByName(_far_by_index(*many))


def _far_direct(asked: DataFrame, newest: DataFrame) -> DataFrame:
    """As `far_orders`, by meeting every order of the account.

    The few orders of an account travel as one list, in which each asker finds its best two: no pair becomes a row, to be
    sorted and shuffled. The lists are written, so that the join with an account of many askers can be split.
    """
    fields = [c for c in ORDER_FIELDS if c not in ("matricula", "data_emissao", "gss_os_id")]
    listed = settle(newest.groupBy("matricula").agg(F.collect_list(F.struct(*ORDER_FIELDS[1:])).alias("_ordens")))

    words = F.col("tokens")

    def counted(order: Column) -> Column:
        return F.struct(shared_tokens(words, order["tokens_servico"]).alias("comuns"), order.alias("ordem"))

    def graded(found: Column) -> Column:
        order = found["ordem"]
        service = status_score(order["status_os_gss"], F.col("aberto"))
        grade = _overlap_score(jaccard(words, order["tokens_servico"], found["comuns"]), service)
        # As `_newest` orders them: a descending order of structs has missing cells last.
        first = [grade.alias("_nota"), order["data_emissao"].alias("data_emissao"), order["gss_os_id"].alias("gss_os_id")]
        return F.struct(*first, *[order[c].alias(c) for c in fields])

    best = F.slice(F.sort_array(F.transform(F.transform("_ordens", counted), graded), asc=False), 1, 2)
    met = asked.join(listed, "matricula").select("matricula", *_ASKER, F.inline(best))
    return met.select(*_ASKER, *ORDER_FIELDS)


def _far_by_index(asked: DataFrame, newest: DataFrame) -> DataFrame:
    """As `far_orders`, by a prefix-filtered token index.

    An order loses to two newer ones of its status that share as many words of the same total, so three lists suffice: the newest two of each status (orders that share no word), the newest two of each
    status, word and number of words (orders that share one word), and, for orders that share more, the classes with a word
    of the asker, rarest word first. The first two lists give a bound. A word is looked up in the third only while an order
    without the rarer words could still reach the bound, and the commonest word never is: who shares two words has another.
    Common words therefore meet short lists, however many texts an account has.
    """
    index = newest.withColumn("_tamanho", F.size("tokens_servico")).withColumn("_palavra", F.explode("tokens_servico"))
    none_shared = _best_two(newest, ["matricula", "status_os_gss"])
    one_shared = _best_two(index, ["matricula", "status_os_gss", "_palavra", "_tamanho"]).drop("_tamanho")
    looked_up = asked.withColumn("_palavra", F.explode("tokens"))
    first = asked.join(none_shared, "matricula").unionByName(
        looked_up.join(one_shared, ["matricula", "_palavra"]).drop("_palavra")
    ).dropDuplicates(["_pedido", "gss_os_id"])
    leading = settle(_ranked_two(first))
    bound = leading.groupBy("_pedido").agg(F.when(F.count(F.lit(1)) == 2, F.min("_nota")).otherwise(0.0).alias("_limite"))

    held = index.groupBy("matricula", "_palavra").agg(F.count(F.lit(1)).alias("_classes"))
    rarest = Window.partitionBy("_pedido").orderBy("_classes", "_palavra")
    left = looked_up.join(held, ["matricula", "_palavra"]).withColumns(
        {"_ordem": F.row_number().over(rarest) - 1, "_conhecidas": F.count(F.lit(1)).over(Window.partitionBy("_pedido"))}
    )
    most = _overlap_score((F.col("_conhecidas") - F.col("_ordem")) / F.size("tokens"), F.when(F.col("aberto"), 1.0).otherwise(0.75))
    probes = left.join(bound, "_pedido").filter((F.col("_ordem") < F.col("_conhecidas") - 1) & (most >= F.col("_limite") - 1e-9))
    sizes = F.least(F.size("tokens"), F.col("_tamanho")) / F.greatest(F.size("tokens"), F.col("_tamanho"))
    reachable = _overlap_score(sizes, status_score(F.col("status_os_gss"), F.col("aberto"))) >= F.col("_limite") - 1e-9
    more = (
        probes.select("matricula", "_palavra", "_pedido", "tokens", "aberto", "_limite").join(index, ["matricula", "_palavra"])
        .filter(reachable).select("_pedido", *_ASKER, *ORDER_FIELDS).dropDuplicates(["_pedido", "gss_os_id"])
    )
    both = leading.select("_pedido", *_ASKER, *ORDER_FIELDS).unionByName(more).dropDuplicates(["_pedido", "gss_os_id"])
    return _ranked_two(both).select(*_ASKER, *ORDER_FIELDS)


def _present(df: DataFrame, names: tuple[str, ...]) -> list[Column]:
    return [F.col(c) for c in names if c in df.columns]


def match_profile(tickets: DataFrame) -> DataFrame:
    """What scoring needs to know about a ticket."""
    status = norm_text(F.col("status")) if "status" in tickets.columns else F.lit(None).cast("string")
    profile = tickets.select(
        "ticket_id",
        "matricula",
        F.to_date(F.coalesce(*_present(tickets, TICKET_DATES), F.lit(None).cast("timestamp_ntz"))).alias("dia"),
        F.coalesce(status.isin(*OPEN_STATUSES), F.lit(False)).alias("aberto"),
        joined_words(*_present(tickets, TICKET_WORDS)).alias("_texto"),
    )
    return profile.withColumn("tokens", token_set(F.col("_texto"))).drop("_texto")


def match_exact(tickets: DataFrame, orders: DataFrame) -> DataFrame:
    """Order of the number given on the ticket: of the same account when there is one, else the newest.

    `tickets(ticket_id, matricula, numero_os_original)`, number present. Only orders of these numbers are ranked.
    """
    asked = tickets.select("numero_os_original").distinct()
    slim = settle(  # few rows, ranked twice
        orders.select("numero_os", "matricula", "gss_os_id", "data_emissao")
        .join(asked, F.col("numero_os") == F.col("numero_os_original"), "left_semi")
    )
    per_account = keep_one(slim, ["numero_os", "matricula"], _newest())
    per_number = keep_one(per_account, ["numero_os"], _newest())
    same = per_account.select(
        F.col("numero_os").alias("_os"), F.col("matricula").alias("_conta"), F.col("gss_os_id").alias("_mesma")
    )
    any_account = per_number.select(F.col("numero_os").alias("_os2"), F.col("gss_os_id").alias("_qualquer"))
    return (
        tickets.join(same, (F.col("numero_os_original") == F.col("_os")) & (F.col("matricula") == F.col("_conta")), "left")
        .join(any_account, F.col("numero_os_original") == F.col("_os2"), "left")
        .select("ticket_id", F.coalesce("_mesma", "_qualquer").alias("gss_exato"))
    )


def match_orders(tickets: DataFrame, orders: DataFrame | None) -> DataFrame:
    """Tickets with the order they belong to: given number, best score, or the reason for none."""
    rest = [c for c in tickets.columns if c not in MATCH_COLUMNS]
    number = F.nullif(norm_identifier(F.col("numero_os")), F.lit(""))
    account = F.nullif(F.col("matricula"), F.lit(""))
    base = tickets.select(*rest, number.alias("numero_os_original"))
    null = F.lit(None)
    given = F.col("numero_os_original").isNotNull()
    if orders is None:
        return base.select(
            *rest,
            F.col("numero_os_original").alias("numero_os"),
            "numero_os_original",
            null.cast("string").alias("numero_os_gss"),
            null.cast("string").alias("gss_os_id"),
            F.when(given, "ZENDESK").alias("origem_numero_os"),
            F.when(given, "ZENDESK_ORIGINAL").otherwise("GSS_NAO_CARREGADO").alias("status_vinculo_os"),
            null.cast("double").alias("score_vinculo_os"),
            null.cast("string").alias("criterio_vinculo_os"),
        )

    exact = match_exact(base.filter(given).select("ticket_id", "matricula", "numero_os_original"), orders)
    scored = score_orders(match_profile(base.filter(~given & account.isNotNull())), orders)
    best = F.col("melhor")
    score = best["score"]
    enough = score >= MIN_SCORE
    clear = enough & (score - F.col("segundo") >= MIN_MARGIN)
    has_best = best.isNotNull()
    trail = F.concat(
        F.lit("matricula+score_servico_datas|date="), fixed2(best["date_score"]),
        F.lit("|service="), fixed2(best["service_score"]), F.lit("|status="), fixed2(best["status_score"]),
    )
    found = F.col("gss_exato").isNotNull()
    joined = base.join(exact, "ticket_id", "left").join(scored, "ticket_id", "left")
    return joined.select(
        *rest,
        F.when(given, F.col("numero_os_original")).when(clear, best["numero_os"]).alias("numero_os"),
        "numero_os_original",
        F.when(given & found, F.col("numero_os_original")).when(enough, best["numero_os"]).alias("numero_os_gss"),
        F.when(given, F.col("gss_exato")).when(enough, best["gss_os_id"]).alias("gss_os_id"),
        F.when(given, "ZENDESK").when(clear, "GSS_MATCH").alias("origem_numero_os"),
        F.when(given & found, "MATCH_EXATO_ZENDESK_GSS")
        .when(given, "ZENDESK_ORIGINAL")
        .when(account.isNull(), "SEM_MATRICULA")
        .when(~has_best, "SEM_CANDIDATO_GSS")
        .when(clear, "MATCH_AUTOMATICO")
        .when(enough, "AMBIGUO")
        .otherwise("SEM_MATCH")
        .alias("status_vinculo_os"),
        F.when(given, F.lit(1.0)).when(has_best, round4(score)).alias("score_vinculo_os"),
        F.when(given & found, "numero_os_exato")
        .when(given, "numero_os_informado_no_zendesk")
        .when(account.isNull(), "matricula_ausente")
        .when(~has_best, "nenhuma_os_para_matricula")
        .otherwise(trail)
        .alias("criterio_vinculo_os"),
    )


def attach_master(
    tickets: DataFrame, master: DataFrame, ticket_key: str, master_key: str, order: Sequence[str]
) -> DataFrame:
    """Tickets beside the first master row of their cleaned account."""
    cleaned = master.withColumn(master_key, join_key_text(F.col(master_key)))
    first = dedup_first(cleaned.filter(F.col(master_key).isNotNull()), [master_key], order)
    keyed = tickets.withColumn(ticket_key, join_key_text(F.col(ticket_key)))
    match = spread_nulls(F.col(ticket_key), F.col("ticket_id")) == F.col(master_key)
    return keyed.join(first, match, "left")
