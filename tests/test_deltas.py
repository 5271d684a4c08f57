"""Aggregates kept from changes equal those rebuilt, after inserts, cancellations, moves between months and customers, and deletes."""

import random
from decimal import Decimal

from conftest import same

from loomvault.operators.changes import change_feed
from loomvault.plans import deltas, gold
from loomvault.sources.tables import TableFolder

SCHEMA = ("ORDER_SK string, HK_CUSTOMER string, ORDER_DATE_KEY int, ORDER_STATUS string, CURRENCY_CODE string, TOTAL_AMOUNT decimal(18,4), "
          "NET_AMOUNT decimal(20,4), DISCOUNT_AMOUNT decimal(18,4), TAX_AMOUNT decimal(18,4)")
AS_OF = "2024-01-01 00:00:00"


def order(rng, k):
    return (f"o{k}", rng.choice([None, "a", "b", "c", "d", "e"]), 20230000 + rng.randint(1, 12) * 100 + rng.randint(1, 28),
            rng.choice(["PENDING", "DELIVERED", "CANCELLED"]), rng.choice(["USD", "EUR"]), *(rng.choice([None, Decimal(rng.randint(1, 500))]) for _ in range(4)))


def test_revenue_from_changes_equals_a_rebuild(spark, folder):
    rng = random.Random(4)
    tables = TableFolder(spark, folder)
    days = gold.dim_date(spark, "2023-01-01", "2024-01-01", AS_OF).persist()
    state = {}
    for batch in range(1, 5):
        before = spark.createDataFrame(list(state.values()), SCHEMA)
        for k in range(12):
            state[k + batch * 6] = order(rng, k + batch * 6)
        for gone in rng.sample(sorted(state), 4 if batch < 4 else len(state) - 3):
            del state[gone]
        after = spark.createDataFrame(list(state.values()), SCHEMA)
        feed = change_feed(before, after, ["ORDER_SK"])
        for _ in range(2 if batch == 2 else 1):  # one batch runs again
            got = deltas.refresh_revenue(tables, feed, days, AS_OF, batch, buckets=3)
        same(got, gold.agg_monthly_revenue(after, days, AS_OF))
    none = deltas.refresh_revenue(tables, feed.limit(0), days, AS_OF, 5, buckets=3)
    same(none, got)


def test_no_change_at_all(spark, folder):
    days = gold.dim_date(spark, "2023-01-01", "2024-01-01", AS_OF)
    empty = spark.createDataFrame([], SCHEMA)
    got = deltas.refresh_revenue(TableFolder(spark, folder), change_feed(empty, empty, ["ORDER_SK"]), days, AS_OF, 1)
    assert got.collect() == [] and got.columns == gold.agg_monthly_revenue(empty, days, AS_OF).columns
