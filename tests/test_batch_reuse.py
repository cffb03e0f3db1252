"""What a batch computes once, and how what it keeps is laid out."""

from ticketlake import session
from ticketlake.operators import orders
from ticketlake.plans import batch
from tests.test_batch import AT, TODAY, feeds


def test_what_one_task_wrote_several_can_read(spark, monkeypatch):
    monkeypatch.setattr(session, "FILE_ROWS", 100, raising=False)
    kept = session.settle(spark.range(1000).coalesce(1))
    assert len(kept.inputFiles()) == 10 and kept.distinct().count() == 1000


def test_a_batch_ranks_the_orders_of_an_account_once(spark, monkeypatch):
    real, asked, kept = orders.order_context, [], []

    def ranked(*args):
        asked.append(args)
        return real(*args)

    def keep(name, df):
        kept.append(name)
        return session.settle(df)

    monkeypatch.setattr(orders, "order_context", ranked)
    monkeypatch.setattr(batch, "order_context", ranked, raising=False)
    rules = batch.Rules(spark.createDataFrame([(9, "REMOVIDO")], "ticket_id bigint, regra string"))
    silver = batch.build_silver(feeds(spark), rules, TODAY, AT, keep=keep)
    assert len(asked) == 1 and "contexto_ordens" in kept
    assert {r["ticket_id"]: r["bairro"] for r in silver.requests.collect()} == {1: "Centro", 3: None}
    assert [r["bairro"] for r in silver.notices.collect()] == ["Centro"]
