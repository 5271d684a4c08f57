"""Stored tables: version folders, and one small pointer file that names those which are the table now.

Every write goes into a folder of its own (``_v=<n>``, or ``_v=<n>/<column>=<value>`` for each part of a partitioned table). When it is
whole, the pointer file is replaced in one step; a write that fails half-way leaves the table as it was. A backup is a copy of the pointer
and a restore puts one back, so neither moves a row; folders that no pointer names go with ``vacuum``. One writer per table at a time.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timedelta
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..functions.dates import at
from ..operators.changes import merge_upsert, with_keys
from ..schemas import assert_schema
from ..session import shuffles_removed

BATCH = "_batch"
VERSION = "_v"
POINTER = "_CURRENT"
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"  # fixed value: the folder of rows without a partition value
STAMP = "%Y%m%d_%H%M%S"
PACKED = {"compression": "zstd"}  # keys and hash diffs are hex text, which takes twice its bytes where codes are not shortened too


def _value(folder: str) -> str | None:
    """The partition value that a folder is named after."""
    value = unquote(folder.rsplit("=", 1)[1])
    return None if value == NO_VALUE else value


class TableFolder:
    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet"):
        self.spark, self.root, self.fmt = spark, root.rstrip("/"), fmt

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    # ---- versions ----------------------------------------------------------------------
    def folders(self, name: str) -> list[str] | None:
        """The folders that are the table now, None where it was never written."""
        return self._pointed(f"{self.path(name)}/{POINTER}")

    def _pointed(self, path: str) -> list[str] | None:
        fs, target = self._fs(path)
        if not fs.exists(target):
            return None
        stream = fs.open(target)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return text.split("\n")[:-1]

    def _point(self, path: str, folders: Sequence[str]) -> None:
        """Write a pointer under another name, then put it in place in one step."""
        fs, draft = self._fs(path + ".draft")
        stream = fs.create(draft, True)
        try:
            stream.write(bytearray("".join(f"{f}\n" for f in folders).encode()))
        finally:
            stream.close()
        jvm, gateway = self.spark._jvm, self.spark.sparkContext._gateway
        rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        how = gateway.new_array(rename, 1)
        how[0] = rename.OVERWRITE
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), self.spark._jsc.hadoopConfiguration())
        files.rename(draft, self._fs(path)[1], how)

    def _new_version(self, name: str) -> str:
        known = [int(c.split("=", 1)[1]) for c in self._children(self.path(name)) if c.startswith(f"{VERSION}=")]
        return f"{VERSION}={max(known, default=0) + 1}"

    def _load(self, name: str, folders: Sequence[str], base: str | None = None) -> DataFrame | None:
        if not folders:
            return None
        path = self.path(base or name)
        frame = self.spark.read.format(self.fmt).option("basePath", path).load([f"{path}/{f}" for f in folders])
        return frame.drop(VERSION)

    def read(self, name: str, before_batch: int | None = None) -> DataFrame | None:
        """The stored rows, None where there are no files.

        A batch that may be running again reads its target as it was ``before_batch``; later folders are not listed.
        """
        folders = self.folders(name) or []
        if before_batch is not None:
            folders = [f for f in folders if f"/{BATCH}=" not in f or int(_value(f)) < before_batch]
        frame = self._load(name, folders)
        return None if frame is None else frame.drop(BATCH)

    def read_parts(self, name: str, values: Sequence[str | None]) -> DataFrame | None:
        """The rows of some partitions; the folders of the others are not listed."""
        wanted = set(values)
        return self._load(name, [f for f in self.folders(name) or [] if _value(f) in wanted])

    def snapshot(self, name: str, before_batch: int) -> DataFrame | None:
        """The rows of the newest batch before one, for tables of which every batch holds the whole state."""
        known = {int(_value(f)): f for f in self.folders(name) or []}
        earlier = [n for n in known if n < before_batch]
        frame = self._load(name, [known[max(earlier)]]) if earlier else None
        return None if frame is None else frame.drop(BATCH)

    def forget_snapshots(self, name: str, before_batch: int) -> None:
        """Remove the states before a batch, but for the newest of them."""
        folders = self.folders(name) or []
        old = sorted((int(_value(f)), f) for f in folders if int(_value(f)) < before_batch)[:-1]
        if old:
            gone = {f for _, f in old}
            self._point(f"{self.path(name)}/{POINTER}", [f for f in folders if f not in gone])
            for folder in gone:
                self._delete(f"{self.path(name)}/{folder}")

    def begin(self, name: str, batch: int) -> None:
        """Before a batch changes a table in place: keep its pointer, or go back to it if the batch ran before."""
        kept = f"{self.path(name)}/_BEFORE/{batch}"
        before = self._pointed(kept)
        if before is not None:
            self._point(f"{self.path(name)}/{POINTER}", before)
        else:
            self._point(kept, self.folders(name) or [])

    def vacuum(self, name: str) -> list[str]:
        """Remove the folders that neither the table, nor a backup, nor the state before its newest batch names."""
        path = self.path(name)
        marks = sorted(self._children(f"{path}/_BEFORE"), key=int)
        named = set(self.folders(name) or [])
        for pointer in [f"{path}/_BEFORE/{m}" for m in marks[-1:]] + [f"{self.root}/_backups/{c}" for c, _, _ in self.backups() if c.startswith(f"{name}_")]:
            named.update(self._pointed(pointer) or [])
        for mark in marks[:-1]:
            self._delete(f"{path}/_BEFORE/{mark}")
        gone = []
        for version in [c for c in self._children(path) if c.startswith(f"{VERSION}=")]:
            parts = [f"{version}/{c}" for c in self._children(f"{path}/{version}") if "=" in c]
            if not any(f == version or f.startswith(f"{version}/") for f in named):
                gone.append(version)
            elif version not in named:
                gone += [f for f in parts if f not in named]
        for folder in gone:
            self._delete(f"{path}/{folder}")
        return gone

    def drop(self, name: str) -> None:
        """Remove a table with all its versions, such as one that holds what a single run works on."""
        self._delete(self.path(name))

    # ---- writes ------------------------------------------------------------------------
    def view(self, name: str, frame: DataFrame) -> DataFrame:
        frame.createOrReplaceTempView(name)
        return frame

    def _write(self, name: str, frame: DataFrame, partition_by: Sequence[str] = (), under: str = "", sort_by: Sequence[str] = (),
               options: Mapping[str, str] | None = None) -> list[str]:
        """Write a new version and return its folders. Parts are dealt out by size: a large one to several tasks, small ones together."""
        version = self._new_version(name)
        path = f"{self.path(name)}/{version}"
        how = {**(PACKED if self.fmt == "parquet" else {}), **(options or {})}
        if not partition_by:
            with shuffles_removed(frame.sparkSession):
                frame.write.format(self.fmt).options(**how).save(f"{path}{under}")
            return [f"{version}{under}"]
        dealt = frame.hint("rebalance", *partition_by)
        dealt = dealt.sortWithinPartitions(*partition_by, *sort_by) if sort_by else dealt
        with shuffles_removed(frame.sparkSession):
            dealt.write.format(self.fmt).options(**how).partitionBy(*partition_by).save(path)
        return [f"{version}/{c}" for c in self._children(path) if "=" in c]

    def replace(self, name: str, frame: DataFrame, partition_by: str | Sequence[str] = (), sort_by: Sequence[str] = ()) -> DataFrame | None:
        """Full table. ``sort_by`` clusters files so that row-group statistics prune."""
        if sort_by:
            frame = frame.repartitionByRange(*sort_by).sortWithinPartitions(*sort_by)
        parts = [partition_by] if isinstance(partition_by, str) else list(partition_by)
        self._point(f"{self.path(name)}/{POINTER}", self._write(name, frame, parts))
        return self.read(name)

    def keep(self, name: str, frame: DataFrame) -> DataFrame:
        """Hook for ``Warehouse(keep=...)``: store a shared frame once, then read it back."""
        return self.replace(name, frame)

    def append(self, name: str, frame: DataFrame, batch: int, on_schema_change: str = "fail") -> DataFrame:
        """Insert-only batch. A batch has its own folder, so running it again replaces it."""
        folders = self.folders(name) or []
        if folders and on_schema_change == "fail":
            assert_schema(frame, self.read(name).schema)
        kept = [f for f in folders if not f.endswith(f"/{BATCH}={batch}")]
        self._point(f"{self.path(name)}/{POINTER}", kept + self._write(name, frame, under=f"/{BATCH}={batch}"))
        return self.read(name)

    def add_parts(self, name: str, frame: DataFrame, partition_by: str, options: Mapping[str, str] | None = None) -> None:
        """Add rows to a partitioned table; what it holds is not read. See ``begin`` for batches that may run again."""
        folders = self.folders(name) or []
        self._point(f"{self.path(name)}/{POINTER}", folders + self._write(name, frame, [partition_by], options=options))

    def replace_parts(self, name: str, frame: DataFrame, partition_by: str, values: Sequence[str | None]) -> None:
        """Put rows in place of some partitions; the others stay where they are."""
        gone = set(values)
        kept = [f for f in self.folders(name) or [] if _value(f) not in gone]
        self._point(f"{self.path(name)}/{POINTER}", kept + self._write(name, frame, [partition_by]))

    def upsert(self, name: str, source: DataFrame, keys: Sequence[str], partition_by: str, sort_by: Sequence[str] = ()) -> DataFrame | None:
        """Write anew only the partitions that hold an incoming key, before or after the change.

        ``partition_by`` names a column of the table, such as a month. A key may move between
        partitions; a partition that loses its last row is gone. The source is read twice.
        """
        stored = self.read(name)
        if stored is None:
            self._point(f"{self.path(name)}/{POINTER}", self._write(name, source, [partition_by], sort_by=sort_by))
            return self.read(name)
        part = F.col(partition_by).cast("string").alias("p")
        where_now = with_keys(stored, source, keys).select(part)
        touched = {r["p"] for r in where_now.union(source.select(part)).distinct().collect()}  # partition names only
        now = self.read_parts(name, touched)
        merged = source if now is None else merge_upsert(now, source, keys)
        untouched = [f for f in self.folders(name) if _value(f) not in touched]
        self._point(f"{self.path(name)}/{POINTER}", untouched + self._write(name, merged.select(*stored.columns), [partition_by], sort_by=sort_by))
        return self.read(name)

    def write(self, name: str, frame: DataFrame, how: str, **options) -> DataFrame | None:
        """Store a frame as a ``view``, ``table``, ``append`` or ``merge``."""
        ways = {"view": self.view, "table": self.replace, "append": self.append, "merge": self.upsert}
        return ways[how](name, frame, **options)

    # ---- files ---------------------------------------------------------------------------
    def _fs(self, path: str):
        jvm = self.spark._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self.spark._jsc.hadoopConfiguration()), target

    def _delete(self, path: str) -> None:
        fs, target = self._fs(path)
        fs.delete(target, True)

    def _children(self, path: str) -> list[str]:
        fs, target = self._fs(path)
        names = [s.getPath().getName() for s in fs.listStatus(target)] if fs.exists(target) else []
        return sorted(n for n in names if not n.startswith("."))

    # ---- backups -------------------------------------------------------------------------
    def backup(self, name: str, now: str, label: str = "BACKUP") -> str:
        """Pointer to the table as it is, under ``_backups``, named by table and time. No row is copied."""
        copy = f"{name}_{label}_{datetime.fromisoformat(now).strftime(STAMP)}"
        folders = self.folders(name)
        if folders is None:
            raise LookupError(f"no table {name}")
        self._point(f"{self.root}/_backups/{copy}", folders)
        return copy

    def backups(self) -> list[tuple[str, str, datetime]]:
        """(copy, label, time) of every backup, from their names."""
        found = []
        for copy in self._children(f"{self.root}/_backups"):
            for label in ("BACKUP", "PRE_RESTORE"):
                if f"_{label}_" in copy:
                    stamp = copy.rsplit(f"_{label}_", 1)[1]
                    found.append((copy, label, datetime.strptime(stamp, STAMP)))
        return found

    def read_backup(self, copy: str) -> DataFrame | None:
        """The rows of a backup."""
        name = copy.rsplit("_BACKUP_", 1)[0].rsplit("_PRE_RESTORE_", 1)[0]
        frame = self._load(name, self._pointed(f"{self.root}/_backups/{copy}") or [])
        return None if frame is None else frame.drop(BATCH)

    def restore(self, name: str, instant: str, now: str) -> str:
        """Point to the newest backup taken at or before an instant; the present pointer is kept first."""
        wanted = datetime.fromisoformat(instant)
        usable = [(t, c) for c, label, t in self.backups() if label == "BACKUP" and c.startswith(f"{name}_BACKUP_") and t <= wanted]
        if not usable:
            raise LookupError(f"no backup of {name} at or before {instant}")
        self.backup(name, now, "PRE_RESTORE")
        source = max(usable)[1]
        self._point(f"{self.path(name)}/{POINTER}", self._pointed(f"{self.root}/_backups/{source}"))
        return source

    def cleanup_backups(self, now: str, days: int = config.LOG_RETENTION_DAYS) -> list[str]:
        """Remove backups older than the retention, and the rows that only they held; returns their names."""
        limit = datetime.fromisoformat(now) - timedelta(days=days)
        old = [c for c, label, t in self.backups() if label == "BACKUP" and t < limit]
        for copy in old:
            self._delete(f"{self.root}/_backups/{copy}")
        for name in {c.rsplit("_BACKUP_", 1)[0] for c in old}:
            self.vacuum(name)
        return old


def archive_older_than(hub: DataFrame, as_of: str, years: int = config.ARCHIVE_YEARS, column: str = "LOAD_DATETIME") -> DataFrame:
    """Rows beyond the hot period, with the year they are stored under."""
    limit = F.add_months(F.to_date(at(as_of)), -12 * years).cast("timestamp_ntz")
    return hub.where(F.col(column) < limit).withColumn("LOAD_YEAR", F.year(column))


def write_archive(archive: DataFrame, path: str, fmt: str = "parquet", sort_by: str = "LOAD_DATETIME") -> None:
    """A folder a year. Years are dealt out by size, a large one to several tasks; files are sorted, so that row groups can be skipped."""
    parted = archive.hint("rebalance", "LOAD_YEAR").sortWithinPartitions("LOAD_YEAR", sort_by)
    parted.write.format(fmt).mode("overwrite").partitionBy("LOAD_YEAR").save(path)
