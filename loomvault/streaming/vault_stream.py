"""Micro-batch loading of vault tables and refresh of what depends on them."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..plans import vault
from ..sources.tables import TableFolder
from .known import BUCKET, load_known, with_bucket

Loader = Callable[..., DataFrame]


def load_batch(staged: DataFrame, loaders: Mapping[str, Loader], tables: TableFolder, batch: int,
               keyed: Mapping[str, tuple[str, str | None]] | None = None, buckets: int = 64) -> None:
    """Append what one staged batch adds to each vault table.

    Loaders see the tables as they were before this batch, so running the batch again writes the
    same rows into the same folders. For tables that ``keyed`` gives (key, mark) of, only the known rows of the batch's keys are read.
    Each loader stages the columns it takes from the source: a copy of all of them, five digests a row, would be many times the batch on disk.
    """
    for name, load in loaders.items():
        if keyed and name in keyed:
            load_known(staged, load, tables, name, batch, *keyed[name], buckets)
        else:
            tables.append(name, load(staged, tables.read(name, before_batch=batch)), batch)


def stream_load_vault(raw: DataFrame, stage: Callable[[DataFrame], DataFrame], loaders: Mapping[str, Loader],
                      tables: TableFolder, checkpoint: str,
                      after: Callable[[DataFrame, int], None] | None = None,
                      keyed: Mapping[str, tuple[str, str | None]] | None = None, buckets: int = 64) -> StreamingQuery:
    """Continuous hub, link and satellite load from a landing stream."""

    def load(batch: DataFrame, batch_id: int) -> None:
        staged = stage(batch)
        load_batch(staged, loaders, tables, batch_id, keyed, buckets)
        if after is not None:
            after(staged, batch_id)

    return raw.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def refresh_pit(tables: TableFolder, touched: DataFrame, key: str, hub: str, satellites: Mapping[str, str], pit: str,
                buckets: int = 64, with_hash_diff: bool = True) -> DataFrame:
    """Rebuild the PIT rows of the touched keys only; the rest of the table is not read for them."""
    keys = touched.select(key).distinct()

    def of(name: str) -> DataFrame:
        return tables.read(name).join(keys, key, "left_semi")

    rows = vault.load_pit(of(hub), key, {alias: of(name) for alias, name in satellites.items()}, with_hash_diff)
    return tables.upsert(pit, with_bucket(rows, key, buckets), [key, "PIT_LOAD_DATETIME"], BUCKET)


class ChangeDetector(StatefulProcessor):
    """Newest change of each key of a bucket, as one state value; emits a row only when its key's hash diff changes.

    A bucket's rows are worked on as one frame: with a state value and a frame for each key, the calls cost more than the work.
    """

    def __init__(self, key: str, columns: list[str]):
        self.key, self.columns = key, columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", T.StructType([T.StructField("known", T.BinaryType())]))

    def _known(self) -> pd.DataFrame | None:
        if not self.last.exists():
            return None
        return pa.ipc.open_stream(bytes(self.last.get()[0])).read_pandas()

    def _learn(self, known: pd.DataFrame) -> None:
        table, sink = pa.Table.from_pandas(known, preserve_index=False), pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_table(table)
        self.last.update((sink.getvalue().to_pybytes(),))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # One bucket's rows of one micro-batch: bounded by the trigger's file limit.
        frame = pd.concat(list(rows), ignore_index=True)[self.columns].sort_values([self.key, "LOAD_DATETIME", "RECORD_SOURCE", "HASH_DIFF"])
        frame = frame.drop_duplicates([self.key, "LOAD_DATETIME"], keep="first")
        known = self._known()
        if known is None:
            frame = frame.assign(_mark=None)
        else:
            frame = frame.merge(known, on=self.key, how="left")
            frame = frame[frame["_at"].isna() | (frame["LOAD_DATETIME"] > frame["_at"])]
        keys, before = frame[self.key], frame[self.key].shift()
        same = (keys == before) | (keys.isna() & before.isna())
        same.iloc[:1] = False
        changed = frame[frame["HASH_DIFF"] != frame["HASH_DIFF"].shift().where(same, frame["_mark"])]
        if len(changed):
            newest = changed.drop_duplicates(self.key, keep="last")[[self.key, "LOAD_DATETIME", "HASH_DIFF"]]
            newest = newest.set_axis([self.key, "_at", "_mark"], axis=1)
            self._learn(newest if known is None else pd.concat([known[~known[self.key].isin(newest[self.key])], newest]))
            yield changed[self.columns]

    def close(self) -> None:
        pass


def stream_satellite_stateful(rows: DataFrame, key: str, buckets: int = 1024, digests: Sequence[str] = ()) -> DataFrame:
    """Satellite versions from a stream with the last hash diff of each key kept in state, by buckets of keys.

    ``rows`` holds the key, HASH_DIFF, payload, LOAD_DATETIME and RECORD_SOURCE. Needs the RocksDB
    state store. The state of a bucket is read and written whole when a trigger has rows of it; more buckets
    suit small triggers over many keys. ``stream_load_vault`` is the choice when one key may dominate.
    ``digests`` names the columns that hold digests only: they are exchanged and kept as bytes.
    """
    packed = vault.all_packed(with_bucket(rows, key, buckets), digests)
    changed = packed.groupBy(BUCKET).transformWithStateInPandas(
        statefulProcessor=ChangeDetector(key, rows.columns), outputStructType=packed.drop(BUCKET).schema, outputMode="append", timeMode="none")
    return vault.all_unpacked(changed, digests)
