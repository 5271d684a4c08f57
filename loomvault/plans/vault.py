"""Loaders for hubs, links, satellites, effectivity satellites, PIT and bridge tables.

Every loader returns the rows to append. Loading a batch twice, or loading history in one batch
or in many, gives the same table. Rows older than the newest stored version of their key are
dropped by the satellite loaders.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions.dates import at, end_of_time, ghost_time
from ..functions.keys import has_key, hash_diff as diff_of, hash_key, packed, unpacked
from ..operators.history import carry_forward, drop_repeats, latest_per_key
from ..operators.segments import cut_points
from ..operators.sizes import dealt

GROUPED_BYTES = 2 << 20  # of stored data for each partition in which distinct keys are gathered

LDTS, SOURCE = "LOAD_DATETIME", "RECORD_SOURCE"
META = (LDTS, SOURCE)


def high_water_mark(target: DataFrame | None, column: str = LDTS) -> str:
    """Newest loaded instant as text, to be used as a literal that file statistics can prune on."""
    if target is None:
        return config.GHOST_TIME
    newest = target.agg(F.max(column).cast("string").alias("t")).first()["t"]
    return newest or config.GHOST_TIME


def newer_than(df: DataFrame, target: DataFrame | None, column: str = LDTS, target_column: str | None = None) -> DataFrame:
    """Incremental read: only rows after the target's high-water mark."""
    return df.where(F.col(column) > at(high_water_mark(target, target_column or column)))


def _first_seen(staging: DataFrame, key: str, payload: Sequence[str]) -> DataFrame:
    """Earliest row per key; ties go to the smaller source name, then the smaller payload."""
    row = F.struct(LDTS, SOURCE, *payload)
    first = staging.groupBy(key).agg(F.min(row).alias("_row"))
    return first.select(key, *[F.col(f"_row.{c}").alias(c) for c in (*payload, *META)])


def _first_seen_late(staging: DataFrame, business_keys: Sequence[str], keys: Mapping[str, Sequence[str]], source: str,
                     distinct: bool = False) -> DataFrame:
    """``_first_seen`` by business keys; ``keys`` (name -> its business keys) are hashed from what is left.

    Digests do not compress and make most of a row: here none is aggregated or exchanged. The aggregate keeps an instant and a flag
    only, so it is done by hashing and not by sorting each task's rows, and it needs one exchange.
    Business keys must be free of the key separator, as the text that a key is hashed from is not compared.
    With ``distinct``, for keys that hardly repeat, rows are exchanged before they are aggregated: what a task holds of such keys grows with
    its part of the scan and is spilled, and nothing would shrink. They are dealt into partitions whose number grows with the scan instead.
    """
    if distinct:
        staging = dealt(staging.select(*business_keys, LDTS), GROUPED_BYTES, *business_keys)
    first = staging.groupBy(*business_keys).agg(F.min(LDTS).alias("_first"), F.max(F.col(LDTS).isNull()).alias("_undated"))
    made = {name: hash_key(first, *parts) for name, parts in keys.items()}
    # an instant that is missing comes before all others
    return first.withColumns(made | {LDTS: F.when(~F.col("_undated"), F.col("_first")), SOURCE: F.lit(source)})


def all_packed(rows: DataFrame, digests: Sequence[str]) -> DataFrame:
    """Columns of digests as bytes, for work that exchanges them; see ``all_unpacked``."""
    return rows.withColumns({c: packed(F.col(c)) for c in digests}) if digests else rows


def all_unpacked(rows: DataFrame, digests: Sequence[str]) -> DataFrame:
    return rows.withColumns({c: unpacked(F.col(c)) for c in digests}) if digests else rows


def _unknown(first: DataFrame, target: DataFrame | None, key: str, digests: Sequence[str] = ()) -> DataFrame:
    """Rows whose key the target does not have; ``digests`` are the columns that are exchanged as bytes."""
    if target is None:
        return first
    if not digests:
        return first.join(target.select(key), key, "left_anti")
    return all_unpacked(all_packed(first, digests).join(target.select(packed(F.col(key)).alias(key)), key, "left_anti"), digests).select(*first.columns)


def load_hub(staging: DataFrame, key: str, business_key: str, target: DataFrame | None = None,
             use_high_water_mark: bool = False, late: str | None = None) -> DataFrame:
    """New hub rows: one per business key never seen before. Blank keys are not loaded.

    ``late`` here and in ``load_link`` names the source, where all staged rows are of one: keys are then hashed from the business
    keys after rows are reduced, with the same rows as result.
    """
    source = newer_than(staging, target) if use_high_water_mark else staging
    present = source.where(has_key(business_key))
    if late is not None:
        first = _first_seen_late(present, [business_key], {key: [business_key]}, late).select(key, business_key, *META)
        return _unknown(first, target, key, [key])
    return _unknown(_first_seen(present, key, [business_key]), target, key)


def load_link(staging: DataFrame, key: str, parents: Sequence[str], target: DataFrame | None = None,
              business_keys: Sequence[str] = (), child_keys: Sequence[str] = (),
              use_high_water_mark: bool = False, late: str | None = None) -> DataFrame:
    """New link rows: one per key combination; ``business_keys`` (those of the parents, in their order) must all be present."""
    source = newer_than(staging, target) if use_high_water_mark else staging
    needed = [*business_keys, *child_keys]
    if needed:
        source = source.where(has_key(*needed))
    if late is not None:
        keys = {key: needed, **{parent: [its] for parent, its in zip(parents, business_keys, strict=True)}}
        first = _first_seen_late(source, needed, keys, late, distinct=bool(child_keys)).select(key, *parents, *child_keys, *META)
        return _unknown(first, target, key, list(keys))
    return _unknown(_first_seen(source, key, [*parents, *child_keys]), target, key)


def cuts_of(staging: DataFrame, key: str, business_key: str) -> DataFrame:
    """The points at which the keys of staged rows are cut into segments: the same for all that is loaded from them."""
    return cut_points(staging.where(has_key(business_key)), key, LDTS)


def _after_stored(rows: DataFrame, target: DataFrame | None, key: str, mark: str, cuts: DataFrame | None) -> DataFrame:
    """Changed rows of a batch, compared with the newest stored version of each key."""
    cuts = cut_points(rows, key, LDTS) if cuts is None else cuts
    if target is None:
        return drop_repeats(rows, key, LDTS, mark, ties=[SOURCE], cuts=cuts)
    newest = target.groupBy(key).agg(F.max(F.struct(LDTS, mark)).alias("_stored"))
    fresh = (
        rows.join(newest, key, "left")
        .where(F.col("_stored").isNull() | (F.col(LDTS) > F.col(f"_stored.{LDTS}")))
        .select(*rows.columns, F.col(f"_stored.{mark}").alias("_stored_mark"))
    )
    changed = drop_repeats(fresh, key, LDTS, mark, ties=[SOURCE], seed="_stored_mark", cuts=cuts)
    return changed.select(*rows.columns)


def _after_stored_packed(rows: DataFrame, target: DataFrame | None, key: str, mark: str, cuts: DataFrame | None, digests: Sequence[str]) -> DataFrame:
    """``_after_stored`` with digests exchanged as bytes; ``cuts`` are of the text and so are left to the packed rows."""
    if not digests or cuts is not None:
        return _after_stored(rows, target, key, mark, cuts)
    if target is not None:
        target = all_packed(target.select(key, LDTS, mark), [c for c in (key, mark) if c in digests])
    return all_unpacked(_after_stored(all_packed(rows, digests), target, key, mark, cuts), digests).select(*rows.columns)


def load_satellite(staging: DataFrame, key: str, hash_diff: str, payload: Sequence[str],
                   target: DataFrame | None = None, business_key: str | None = None,
                   cuts: DataFrame | None = None, hashed: Sequence[str] | None = None) -> DataFrame:
    """New satellite versions: rows whose hash diff differs from the version before them.

    With ``hashed``, the columns that the hash diff is made of, a first load exchanges rows by their business key and makes both
    digests behind the exchange, with the same rows as result; a later load exchanges the digests as bytes.
    """
    source = staging.where(has_key(business_key)) if business_key else staging
    if hashed is not None and target is None and business_key:
        columns = list(dict.fromkeys([*payload, *hashed]))
        plain = source.select(business_key, *columns, *META)
        kept = drop_repeats(plain, business_key, LDTS, "HASH_DIFF", ties=[SOURCE], mark_of=lambda rows: diff_of(rows, *hashed), cuts=cuts)
        return kept.select(hash_key(kept, business_key).alias(key), "HASH_DIFF", *payload, *META)
    rows = source.select(key, F.col(hash_diff).alias("HASH_DIFF"), *payload, *META)
    return _after_stored_packed(rows, target, key, "HASH_DIFF", cuts, [key, "HASH_DIFF"] if hashed is not None else [])


def load_eff_satellite(staging: DataFrame, key: str, parents: Sequence[str], status: str, effective_from: str,
                       target: DataFrame | None = None, business_keys: Sequence[str] = (),
                       cuts: DataFrame | None = None, digests: Sequence[str] = ()) -> DataFrame:
    """Validity of a link: a row whenever the relationship turns active or inactive.

    ``digests`` here and in ``load_bridge`` names the columns that hold digests only: they are exchanged as bytes, with the same rows as result.
    """
    ended = F.coalesce(F.col(status).isin(*config.INACTIVE_STATUSES), F.lit(False))
    source = staging.where(has_key(*business_keys)) if business_keys else staging
    rows = source.select(
        key, *parents,
        (~ended).alias("IS_ACTIVE"),
        F.col(effective_from).alias("EFFECTIVE_FROM"),
        F.when(ended, F.col(LDTS)).otherwise(end_of_time()).alias("EFFECTIVE_TO"),
        status, *META,
    )
    return _after_stored_packed(rows, target, key, "IS_ACTIVE", cuts, digests)


def load_pit(hub: DataFrame, key: str, satellites: Mapping[str, DataFrame], with_hash_diff: bool = True,
             cuts: DataFrame | None = None) -> DataFrame:
    """For each key and each instant anything changed: pointers to the valid satellite rows.

    Hub and satellite instants go through one exchange as a single stream; the pointer is carried
    forward from the satellite's own rows, so no satellite is joined by inequality.
    """
    stream = hub.select(key, F.col(LDTS).alias("PIT_LOAD_DATETIME"))
    for name, sat in satellites.items():
        version = F.struct(F.col(LDTS).alias("t"), F.col("HASH_DIFF").alias("h")) if with_hash_diff else F.struct(F.col(LDTS).alias("t"))
        stream = stream.unionByName(
            sat.select(key, F.col(LDTS).alias("PIT_LOAD_DATETIME"), version.alias(name)), allowMissingColumns=True
        )
    names = list(satellites)
    carried = carry_forward(stream, key, "PIT_LOAD_DATETIME", names, cuts)
    pointers = []
    for name in names:
        pointers.append(F.coalesce(F.col(f"{name}.t"), ghost_time()).alias(f"{name}_LDTS"))
        if with_hash_diff:
            pointers.append(F.coalesce(F.col(f"{name}.h"), F.lit(config.GHOST_KEY)).alias(f"{name}_HD"))
    # Rows sharing an instant carry the same pointers: keep one of them.
    return carried.select(key, "PIT_LOAD_DATETIME", *pointers).distinct()


def load_bridge(link: DataFrame, key: str, parents: Sequence[str], effectivity: DataFrame | None = None,
                extra: Sequence[str] = (), active_only: bool = False, digests: Sequence[str] = ()) -> DataFrame:
    """Link rows with the newest validity of the relationship."""
    base = link.select(key, *parents, F.col(LDTS).alias("LINK_LOAD_DATETIME"), F.col(SOURCE).alias("LINK_RECORD_SOURCE"))
    if effectivity is None:
        return base
    wanted = ["IS_ACTIVE", "EFFECTIVE_FROM", "EFFECTIVE_TO", *extra]
    states = effectivity.select(key, LDTS, *wanted)
    newest = latest_per_key(all_packed(states, [key] if key in digests else []), key, [LDTS]).drop(LDTS)
    joined = all_unpacked(all_packed(base, digests).join(newest, key, "left"), digests).select(*base.columns, *wanted)
    return joined.where("IS_ACTIVE") if active_only else joined


def hub_bridge(left_hub: DataFrame, link: DataFrame, right_hub: DataFrame, left_key: str, right_key: str,
               left_bk: str, right_bk: str, link_key: str) -> DataFrame:
    """Hub - link - hub walk with both business keys."""
    return (
        link.select(link_key, left_key, right_key, F.col(LDTS).alias("LINK_LOAD_DATETIME"))
        .join(left_hub.select(left_key, left_bk), left_key)
        .join(right_hub.select(right_key, right_bk), right_key)
        .select(left_key, left_bk, link_key, right_key, right_bk, "LINK_LOAD_DATETIME")
    )


def pit_current(hub: DataFrame, key: str, business_key: str, satellites: Mapping[str, DataFrame]) -> DataFrame:
    """One row per hub key with the newest pointer into each satellite."""
    out = hub.select(key, business_key)
    for name, sat in satellites.items():
        newest = sat.groupBy(key).agg(F.max(LDTS).alias(f"_{name}"))
        out = out.join(newest, key, "left").withColumns({
            f"SAT_{name}_HK": F.when(F.col(f"_{name}").isNotNull(), F.col(key)),
            f"SAT_{name}_LOAD_DT": F.coalesce(F.col(f"_{name}"), ghost_time()),
        }).drop(f"_{name}")
    return out


def vault_as_of(table: DataFrame, key: str | None, instant: str) -> DataFrame:
    """State of an insert-only table at an instant; with a key, only its newest version then."""
    seen = table.where(F.col(LDTS) <= at(instant))
    return seen if key is None else latest_per_key(seen, key, [LDTS])


def snapshot_scd2(state: DataFrame | None, source: DataFrame, key: str, updated_at: str, as_of: str) -> DataFrame:
    """Next state of a timestamp snapshot: open new versions, close changed and deleted ones."""
    opened = source.select("*", F.col(updated_at).alias("VALID_FROM"), F.lit(None).cast("timestamp_ntz").alias("VALID_TO"))
    if state is None:
        return opened
    closed = state.where("VALID_TO is not null")
    current = state.where("VALID_TO is null")
    incoming = source.select(key, F.col(updated_at).alias("_new_at"))
    matched = current.join(incoming, key, "left")
    ends = (
        F.when(F.col("_new_at").isNull(), at(as_of))
        .when(F.col("_new_at") > F.col(updated_at), F.col("_new_at"))
    )
    kept = matched.withColumn("VALID_TO", ends).select(*state.columns)
    known = current.select(key, F.col(updated_at).alias("_old_at"))
    fresh = opened.join(known, key, "left").where("_old_at is null or " + f"`{updated_at}` > _old_at").select(*state.columns)
    return closed.unionByName(kept).unionByName(fresh)
