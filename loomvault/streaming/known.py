"""What is known of a vault table's keys: a slim key-bucketed table, of which a batch reads the buckets it touches.

For each vault table ``current_<name>`` holds (key, load instant, mark) of the versions that batches added, in folders by a hash of the key.
A batch lists and reads the folders of its own keys only, and of these rows it keeps those of its keys without moving the table: few keys
are looked up by their values, for which files carry Bloom filters and row groups without any of them are skipped; more keys are
hashed into every task if their size allows, and if not, the loaders' own joins find the rows of their keys. The vault table itself, with its payload, is never read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.history import latest_per_key
from ..operators.sizes import fits_broadcast
from ..plans.vault import LDTS
from ..sources.tables import TableFolder

BUCKET = "KEY_BUCKET"
FEW = 256         # keys looked up one by one
SLOTS = 1 << 14   # keys are counted by slots of their hash before they are gathered: no more slots than keys
COMPACT = 16      # folders of a bucket before its rows are reduced to the newest of each key


def with_bucket(df: DataFrame, key: str, buckets: int) -> DataFrame:
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))


def _table(name: str) -> str:
    return f"current_{name}"


def known_rows(tables: TableFolder, name: str, keys: DataFrame, key: str, buckets: int) -> DataFrame | None:
    """At least the known rows of some keys (one column, repeats allowed), None where their buckets are empty.

    Of other keys it has rows too, where there are too many keys to broadcast: to meet them takes an exchange of both sides, as does the join that follows.
    """
    slot = F.pmod(F.xxhash64(F.lit(1), key), F.lit(SLOTS))
    touched, slots = with_bucket(keys, key, buckets).agg(F.collect_set(BUCKET), F.count_distinct(slot)).first()  # keys themselves are not exchanged
    rows = tables.read_parts(_table(name), [str(b) for b in touched])
    if rows is None:
        return None
    if slots <= FEW:
        few = [r[0] for r in keys.distinct().limit(FEW + 1).collect()]
        if len(few) <= FEW:
            return rows.drop(BUCKET).where(F.col(key).isin(few))
    return rows.drop(BUCKET).join(F.broadcast(keys.distinct()), key, "left_semi") if fits_broadcast(keys) else rows.drop(BUCKET)


def learn(tables: TableFolder, name: str, rows: DataFrame, key: str, mark: str | None, buckets: int) -> None:
    """Add what a batch appended; now and then reduce the table to the newest row of each key."""
    columns = [key, LDTS] + ([mark] if mark else [])
    blooms = {f"parquet.bloom.filter.enabled#{key}": "true"}
    tables.add_parts(_table(name), with_bucket(rows.select(*columns), key, buckets), BUCKET, blooms)
    if len(tables.folders(_table(name))) > COMPACT * buckets:
        newest = latest_per_key(tables.read(_table(name)), key, [LDTS])
        tables.replace(_table(name), newest, BUCKET)


def load_known(staged: DataFrame, load, tables: TableFolder, name: str, batch: int, key: str, mark: str | None, buckets: int) -> DataFrame:
    """Append what a staged batch adds to one vault table. Running the batch again gives the same tables."""
    tables.begin(_table(name), batch)
    keys = staged.select(key).where(F.col(key).isNotNull())
    stored = tables.append(name, load(staged, known_rows(tables, name, keys, key, buckets)), batch)
    learn(tables, name, tables.snapshot(name, batch + 1), key, mark, buckets)
    return stored
