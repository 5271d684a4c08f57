"""Aggregates and bridges kept up to date from changes alone.

Monthly revenue is kept in two tables: the (customer, month, currency) sums in folders by a hash of the customer, and their sums by month. A
change feed of orders is turned into signed sums. Only the folders of customers in the feed are read; what these customers added to
their months before is taken away and what they add now is added, new and returning customers included. Other customers' rows are never read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.changes import ACTION, with_keys, without_keys
from ..session import shuffles_removed
from ..sources.tables import TableFolder
from ..streaming.known import BUCKET, with_bucket
from . import gold, vault

MONTHS, PARTS, CHANGES = "customer_months", "month_parts", "customer_month_changes"
SUMS = ("n", *gold.REVENUE, *(f"{c}_KNOWN" for c in gold.REVENUE))
KEY = ["HK_CUSTOMER"]
REVENUE_COLUMNS = (*KEY, "ORDER_STATUS", "ORDER_DATE_KEY", "CURRENCY_CODE", *gold.REVENUE)  # of an order, read by ``refresh_revenue``


def signed(rows: DataFrame, columns, sign: int) -> DataFrame:
    return rows.withColumns({c: (F.col(c) * sign).cast(rows.schema[c].dataType) for c in columns})


def added_up(rows: DataFrame, keys, columns) -> DataFrame:
    """Sums by key in the types they have."""
    return rows.groupBy(*keys).agg(*[F.sum(c).cast(rows.schema[c].dataType).alias(c) for c in columns])


def refresh_revenue(tables: TableFolder, feed: DataFrame, calendar: DataFrame, as_of: str, batch: int, buckets: int = 64) -> DataFrame:
    """Monthly revenue after the changes of orders in ``feed`` (see ``change_feed``). Running a batch again gives the same tables."""
    for name in (MONTHS, PARTS):
        tables.begin(name, batch)
    inserted, deleted = (gold.customer_months(feed.where(F.col(ACTION) == action), calendar) for action in ("INSERT", "DELETE"))
    changes = inserted.unionByName(signed(deleted, SUMS, -1))
    changes = with_bucket(added_up(changes, [*KEY, *gold.MONTH_KEYS], SUMS), KEY[0], buckets)
    # read by each step below; stored, so that what the feed has exchanged goes before they begin
    changes = tables.replace(CHANGES, changes)
    none = tables.spark.createDataFrame([], changes.schema)
    try:
        with shuffles_removed(tables.spark):
            touched = sorted(r[0] for r in changes.select(BUCKET).distinct().collect())  # at most one row a bucket
        if touched:
            held = tables.read_parts(MONTHS, [str(b) for b in touched])
            held = none if held is None else held.select(*changes.columns)
            customers = changes.select(*KEY).distinct()
            before = with_keys(held, customers, KEY)
            after = added_up(before.unionByName(changes), [*KEY, *gold.MONTH_KEYS, BUCKET], SUMS).where("n <> 0").select(*changes.columns)
            parts_before, parts_after = (gold.month_parts(rows.drop(BUCKET)) for rows in (before, after))
            columns = [c for c in parts_after.columns if c not in gold.MONTH_KEYS]
            parts = parts_after.unionByName(signed(parts_before, columns, -1))
            known = tables.read(PARTS)
            parts = parts if known is None else parts.unionByName(known)
            # both tables are written before either changes for the next batch; a batch that stops between them begins anew
            tables.replace(PARTS, added_up(parts, gold.MONTH_KEYS, columns).where("TOTAL_ORDERS <> 0"))
            tables.replace_parts(MONTHS, without_keys(held, customers, KEY).unionByName(after), BUCKET, [str(b) for b in touched])
    finally:
        tables.drop(CHANGES)
    parts = tables.read(PARTS)
    if parts is None:
        parts = gold.month_parts(none.drop(BUCKET))
    return gold.monthly_revenue_of(parts, as_of)


def refresh_bridge(tables: TableFolder, touched: DataFrame, key: str, parents, link: DataFrame, effectivity: DataFrame, name: str, batch: int,
                   extra=(), buckets: int = 64, digests=()) -> DataFrame | None:
    """Bridge rows of the touched links anew; the others stay where they are.

    A link's bucket never changes, so the folders to write anew are known from the keys. ``digests`` names the columns that hold
    digests only: all that is joined is exchanged with their bytes.
    """
    tables.begin(name, batch)
    keys = touched.select(key).where(F.col(key).isNotNull())
    folders = [str(b) for b in with_bucket(keys, key, buckets).agg(F.collect_set(BUCKET)).first()[0]]  # at most one a bucket

    def packed(df: DataFrame) -> DataFrame:
        return vault.all_packed(df, [c for c in df.columns if c in digests])

    keys = packed(keys).distinct()
    link, effectivity = (packed(df).join(keys, key, "left_semi") for df in (link, effectivity))
    rows = vault.load_bridge(link, key, parents, effectivity, extra=extra)
    held = tables.read_parts(name, folders)
    if held is not None:
        rows = packed(held.drop(BUCKET)).join(link.select(key), key, "left_anti").unionByName(rows)
    if folders:
        tables.replace_parts(name, with_bucket(vault.all_unpacked(rows, [c for c in rows.columns if c in digests]), key, buckets), BUCKET, folders)
    return tables.read(name)
