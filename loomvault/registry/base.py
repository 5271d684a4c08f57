"""Registered queries: a Spark callable per name, with the SQL that must give the same rows."""

from __future__ import annotations

import re
from collections.abc import Callable
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.warehouse import Warehouse

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
CTES: dict[str, str] = {}
_WAREHOUSES: WeakKeyDictionary = WeakKeyDictionary()


def warehouse(spark: SparkSession, folder: str) -> Warehouse:
    """The lazily built warehouse over one folder of test tables."""
    per_session = _WAREHOUSES.setdefault(spark, {})
    if folder not in per_session:
        per_session[folder] = Warehouse.from_test_tables(spark, folder)
    return per_session[folder]


def forget_warehouses() -> None:
    """Drop the built frames, and with them what they checkpointed."""
    _WAREHOUSES.clear()


def present(df: DataFrame) -> DataFrame:
    """Driver-neutral output types: decimals as doubles, open-ended instants as text."""
    out = []
    for field in df.schema:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            col = col.cast("double")
        elif field.name in ("EFFECTIVE_TO", "VALID_TO"):
            col = F.date_format(col, "yyyy-MM-dd HH:mm:ss")
        out.append(col.alias(field.name))
    return df.select(*out)


def query(name: str, sql: str | None = None):
    """Register a callable ``(warehouse, spark, folder) -> DataFrame`` under a name."""
    def keep(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = lambda spark, folder: present(fn(warehouse(spark, folder), spark, folder))
        if sql is not None:
            ORACLES[name] = with_ctes(sql)
        return fn
    return keep


def with_ctes(sql: str) -> str:
    """Prefix the statement with the named expressions it mentions, in dependency order."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for word in re.findall(r"[a-z_0-9]+", text):
            if word in CTES and word not in needed:
                visit(CTES[word])
                if word not in needed:
                    needed.append(word)

    visit(sql)
    if not needed:
        return sql
    body = ",\n".join(f"{n} AS MATERIALIZED ({CTES[n]})" for n in needed)
    return f"WITH {body}\n{sql}"


def doubles(source: str, *columns: str, texts: tuple[str, ...] = ()) -> str:
    """All columns of a named expression, the listed ones as doubles or as timestamp text."""
    swaps = [f"CAST({c} AS DOUBLE) AS {c}" for c in columns]
    swaps += [f"strftime({c}, '%Y-%m-%d %H:%M:%S') AS {c}" for c in texts]
    return f"SELECT * REPLACE ({', '.join(swaps)}) FROM {source}" if swaps else f"SELECT * FROM {source}"
