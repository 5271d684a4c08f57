"""Structured Streaming into landing tables."""

from __future__ import annotations

from dataclasses import replace
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.copy import LOG, accept_files, staged_files, staged_rows
from ..sources.formats import Stage, file_name
from ..sources.tables import TableFolder
from . import offsets
from .cdc import split_dead_letters

PAYLOAD = "RECORD_TEXT"
LISTED = "path string, modificationTime timestamp, length bigint, content binary"


def stream_files(spark: SparkSession, stage: Stage, tables: TableFolder, name: str, source_system: str, now: str,
                 checkpoint: str, max_files: int = 1000) -> StreamingQuery:
    """Pick up new files, whole files only, and log each one.

    A file is always inside one micro-batch; the stream tells which files are new, and they are read
    as a copy reads them, columns matched by name file by file. A batch writes its own folder, so a
    replay after a failure replaces what the failed attempt left.
    """
    # only the listing: files are read once, as a copy reads them, and those without a line are seen too
    found = spark.readStream.format("binaryFile").option("maxFilesPerTrigger", max_files).schema(LISTED).load(stage.location).select(file_name())

    def load(batch: DataFrame, batch_id: int) -> None:
        files = [unquote(r["_FILE_NAME"]) for r in batch.distinct().collect()]  # at most max_files names
        if not files:
            return
        rows = staged_rows(batch.sparkSession, replace(stage, location=files))
        result = accept_files(rows, stage, source_system, now, done=tables.read(LOG, before_batch=batch_id),
                              listing=staged_files(batch.sparkSession, files))
        tables.append(name, result.rows, batch_id)
        tables.append(LOG, result.log, batch_id)

    return found.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def load_events(batch: DataFrame, tables: TableFolder, name: str, batch_id: int) -> None:
    """Land one micro-batch of events; running it again gives the same tables.

    What has landed is known from the intervals of landed offsets that the batch before stored, so the landing table is never
    read. An offset that is no whole number is looked up among the few such tokens. Events are brought down to one of each offset
    once: several tables are written from them.
    """
    odd, state = f"{name}_tokens", f"{name}_offsets"
    intervals = tables.snapshot(state, batch_id)
    placed = offsets.with_offset(batch)
    numbered = offsets.each_once(placed).persist()
    loose = placed.where("lane is null").persist()
    try:
        named = F.col(offsets.TOKEN).isNotNull() & F.col(offsets.TOPIC).isNotNull() & F.col(offsets.PARTITION).isNotNull()
        keys = [offsets.TOPIC, offsets.PARTITION, offsets.TOKEN]
        tokens = loose.where(named).dropDuplicates(keys)
        seen = tables.read(odd, before_batch=batch_id)
        if seen is not None:
            tokens = tokens.join(seen, keys, "left_anti").select(*loose.columns)
        rows = offsets.not_landed(loose.where(~named), intervals, numbered).unionByName(tokens)
        good, bad = rows, None
        if PAYLOAD in batch.columns:
            parsed, bad = split_dead_letters(rows, PAYLOAD)
            good = parsed.withColumn("RECORD_CONTENT", F.parse_json(PAYLOAD)).drop(PAYLOAD)
            tables.append(f"{name}_dead_letters", bad.drop("lane", "offset"), batch_id)
        tables.append(name, good.drop("lane", "offset"), batch_id)
        tables.append(odd, tokens.select(*keys), batch_id)
        new = offsets.islands(numbered.select("lane", "offset"))
        tables.append(state, offsets.joined(new if intervals is None else intervals.unionByName(new)), batch_id)
    finally:
        numbered.unpersist()
        loose.unpersist()
    tables.forget_snapshots(state, batch_id - 1)


def stream_events(events: DataFrame, tables: TableFolder, name: str, checkpoint: str) -> StreamingQuery:
    """Row-level events, each (topic, partition, offset) once, however late a repeat or a new event comes.

    Events without an offset, topic or partition cannot be told apart and all land. A ``RECORD_TEXT`` column is parsed into ``RECORD_CONTENT``;
    events whose text is no JSON go to ``<name>_dead_letters`` as they came, once too. ``<name>_offsets`` holds the intervals of
    landed offsets after each batch.
    """
    return (events.writeStream.foreachBatch(lambda batch, batch_id: load_events(batch, tables, name, batch_id))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def error_trend_stream(errors: DataFrame, delay: str = "2 hours") -> DataFrame:
    """Hourly error counts that are final once the watermark has passed them."""
    timed = errors.withColumn("_event_time", F.col("ERROR_TIMESTAMP").cast("timestamp"))
    return timed.withWatermark("_event_time", delay).groupBy(
        F.window("_event_time", "1 hour").alias("w"), "PROCEDURE_NAME", "SEVERITY",
    ).agg(F.count("*").alias("ERROR_COUNT"), F.collect_set("ERROR_CODE").alias("codes")).select(
        F.col("w.start").cast("timestamp_ntz").alias("ERROR_HOUR"), "PROCEDURE_NAME", "SEVERITY", "ERROR_COUNT",
        F.array_join(F.sort_array("codes"), ",").alias("ERROR_CODES"),
    )
