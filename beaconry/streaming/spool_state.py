"""Keyed state of spools and buffers: what a spool keeps, and batches that go out when they are full or old."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from beaconry import fixed_values as fixed
from beaconry.streaming.run import to_batches, write_batch

_ENTRY = "ts_ms bigint, seq bigint, bytes bigint, entry string"


def _newest_first(rows: list[tuple]) -> list[tuple]:
    return sorted(rows, key=lambda row: row[:2], reverse=True)


def _held(rows: list[tuple], max_events: int, max_bytes: int, oldest_ms: float | None, floor: tuple) -> tuple[list[tuple], tuple]:
    """Of entries (ts, seq, bytes, ...), newest first, what a spool keeps, and the newest place that had to go.

    It keeps young ones, at most so many, of at most so many bytes, and none at the floor or below: what went from there
    went for the sake of newer ones, so an older one that comes late must not take its place.
    """
    kept, total = [], 0
    for row in rows:
        if row[:2] <= floor or (oldest_ms is not None and row[0] < oldest_ms):
            break
        total += row[2]
        if len(kept) == max_events or total > max_bytes:
            return kept, row[:2]
        kept.append(row)
    return kept, floor


class _Retention(StatefulProcessor):
    """The entries a spool holds, as a list, and a log of what came and what had to go.

    What falls out never returns: newer entries only push it further back. So each batch looks at the entries held, at
    most ``max_events`` of them, and at its own, and writes what changed.
    """

    def __init__(self, max_events: int, max_bytes: int, max_age_ms: float | None):
        self.max_events, self.max_bytes, self.max_age_ms = max_events, max_bytes, max_age_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.entries = handle.getListState("entries", _ENTRY)
        self.account = handle.getValueState("account", "entries bigint, bytes bigint, latest bigint, floor_ms bigint, floor_seq bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        number, _, latest, *floor = self.account.get() if self.account.exists() else (0, 0, 0, -1 << 63, -1 << 63)
        held = before = [tuple(row) for row in self.entries.get()] if number else []
        floor = tuple(floor)
        for frame in rows:
            some = list(zip(*(frame[c].tolist() for c in ("ts_ms", "seq", "bytes", "entry")), strict=True))
            latest = max([latest, *(int(t) for t in frame["now_ms"].tolist())])
            oldest = None if self.max_age_ms is None else latest - self.max_age_ms
            held, floor = _held(_newest_first(held + some), self.max_events, self.max_bytes, oldest, floor)
        if held:
            self.entries.put(held)
        elif before:
            self.entries.clear()
        self.account.update((len(held), sum(row[2] for row in held), latest, *floor))
        had, has = set(before), set(held)
        changes = [(key[0], *row, True) for row in held if row not in had] + [(key[0], *row, False) for row in before if row not in has]
        return iter([pd.DataFrame(changes, columns=["spool_id", "ts_ms", "seq", "bytes", "entry", "kept"])] if changes else [])

    def close(self) -> None:
        pass


def _thinned(max_events: int):
    """Of each batch of rows, the newest of every spool: a hot spool brings at most so many from each into the state."""
    def thin(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            newest = frame.sort_values(["ts_ms", "seq"], ascending=False).groupby("spool_id", sort=False).head(max_events)
            yield newest.assign(now_ms=newest.groupby("spool_id")["now_ms"].transform("max"))

    return thin


def stream_retention(entries: DataFrame, now_ms: Column, max_events: int = fixed.SPOOL_MAX_EVENTS, max_bytes: int = fixed.SPOOL_MAX_BYTES,
                     max_age_s: float = fixed.SPOOL_MAX_AGE_SECONDS) -> DataFrame:
    """Changes of what spools keep, by the bounds of ``delivery.retention``: kept true for an entry that came, false for one that went.

    Reads spool_id, ts_ms, seq, bytes and entry (text, given back as it is); ts_ms and seq tell a spool's entries apart.
    ``now_ms`` is a row's present; a spool's is the latest it has seen. Entries may come in any order. An entry that its own batch pushes out again is
    never reported. Ages are looked at when a spool has rows.
    """
    max_events, max_bytes = max(1, int(max_events)), max(1024, int(max_bytes))
    max_age_ms = max(0.0, float(max_age_s)) * 1000 or None
    rows = entries.select(F.col("spool_id").cast("string"), F.col("ts_ms").cast("bigint"), F.col("seq").cast("bigint"), F.col("bytes").cast("bigint"),
                          F.col("entry").cast("string"), now_ms.cast("bigint").alias("now_ms"))
    few = rows.mapInPandas(_thinned(max_events), rows.schema)
    return few.groupBy("spool_id").transformWithStateInPandas(
        statefulProcessor=_Retention(max_events, max_bytes, max_age_ms), outputStructType=f"spool_id string, {_ENTRY}, kept boolean",
        outputMode="Append", timeMode="None")


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def _folders(spark: SparkSession, path: str, name: str) -> list[int]:
    """The numbers n of the folders ``name``=n below a path."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [str(f.getPath().getName()) for f in files.listStatus(at)] if files.exists(at) else []
    return sorted(int(f[len(name) + 1:]) for f in found if f.startswith(f"{name}="))


def _folded(changes: DataFrame) -> DataFrame:
    """What is kept after changes in any order and any number of copies: an entry that went stays gone."""
    key = ["spool_id", "ts_ms", "seq"]
    gone = changes.where("NOT kept").select(*key)
    return changes.where("kept").join(gone, key, "left_anti").dropDuplicates(key)


def kept_entries(spark: SparkSession, folder: str) -> DataFrame:
    """What the spools hold now: the latest whole table, and the batches of changes after it."""
    whole = _folders(spark, f"{folder}/whole", "upto")[-1:]
    after = [n for n in _folders(spark, f"{folder}/changes", "batch") if not whole or n > whole[0]]
    paths = [f"{folder}/whole/upto={n}" for n in whole] + [f"{folder}/changes/batch={n}" for n in after]
    schema = f"spool_id string, {_ENTRY}, kept boolean"
    if not paths:
        return spark.createDataFrame([], schema).drop("kept")
    return _folded(spark.read.schema(schema).parquet(*paths)).drop("kept")


def retention_writer(spark: SparkSession, folder: str, compact_every: int = 20):
    """A foreachBatch step for ``stream_retention``: a batch writes its changes, and now and then a whole table takes the place of older ones.

    Each batch costs what changed in it. Every ``compact_every`` batches the changes since the last whole table and that
    table become a new one; older folders are deleted, but not before the batch after it has begun, so that readers of the one before find
    it still. A repeated batch replaces its own folder, and folding the same changes twice gives the same table.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        wholes = _folders(spark, f"{folder}/whole", "upto")
        write_batch(batch, f"{folder}/changes", batch_id)
        for upto in wholes[:-1]:
            _delete(spark, f"{folder}/whole/upto={upto}")
        for old in _folders(spark, f"{folder}/changes", "batch"):
            if wholes and old <= wholes[-1] and old != batch_id:
                _delete(spark, f"{folder}/changes/batch={old}")
        if batch_id % compact_every == compact_every - 1 and batch_id not in wholes:
            kept_entries(spark, folder).selectExpr("*", "true AS kept").write.mode("overwrite").parquet(f"{folder}/whole/upto={batch_id}")

    return write


def run_retention(changes: DataFrame, folder: str, checkpoint: str, compact_every: int = 20, every: str | None = None):
    return to_batches(changes, retention_writer(changes.sparkSession, folder, compact_every), checkpoint, every=every)


class _Chunks(StatefulProcessor):
    """Items of one flush key that wait until a body is full or the oldest of them is old."""

    def __init__(self, size: int, flush_ms: int):
        self.size, self.flush_ms = size, flush_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.items = handle.getListState("items", "item string")
        self.waiting = handle.getValueState("waiting", "items bigint, bodies bigint, due bigint")

    def _bodies(self, key, items: list[str], first: int, why: str) -> pd.DataFrame:
        rows = [(key[0], first + n, items[at:at + self.size], why) for n, at in enumerate(range(0, len(items), self.size))]
        return pd.DataFrame(rows, columns=["flush_key", "chunk", "items", "flushed"])

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        waiting, bodies, due = self.waiting.get() if self.waiting.exists() else (0, 0, None)
        items = [item for item, in self.items.get()] if waiting else []
        fresh = not items
        for frame in rows:
            items += frame["item"].tolist()
            full = len(items) // self.size * self.size
            if full:
                yield self._bodies(key, items[:full], bodies, "full")
                bodies, items, fresh = bodies + full // self.size, items[full:], True
        self.items.put([(item,) for item in items]) if items else self.items.clear()
        if items and fresh:
            due = timerValues.getCurrentProcessingTimeInMs() + self.flush_ms
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(due)
        self.waiting.update((len(items), bodies, due if items else None))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        waiting, bodies, due = self.waiting.get() if self.waiting.exists() else (0, 0, None)
        if not waiting or due is None or due > expiredTimerInfo.getExpiryTimeInMs():
            return
        items = [item for item, in self.items.get()]
        self.items.clear()
        self.waiting.update((0, bodies + 1, None))
        yield self._bodies(key, items, bodies, "old")

    def close(self) -> None:
        pass


def stream_chunks(items: DataFrame, size: int = fixed.MAX_BATCH, flush_ms: int = 5_000) -> DataFrame:
    """Bodies of at most ``size`` items per flush key, given out when full, or when their first item has waited ``flush_ms``.

    Reads flush_key and item (text). Returns flush_key, chunk (from 0), items and flushed (full or old). Items of a hot key
    pass in batches and leave at once; less than one body of each key waits. A timer of the processing time fires with the
    next trigger, so a body goes out at most one trigger after its time.
    """
    rows = items.select(F.col("flush_key").cast("string"), F.col("item").cast("string"))
    return rows.groupBy("flush_key").transformWithStateInPandas(
        statefulProcessor=_Chunks(size, flush_ms), outputStructType="flush_key string, chunk bigint, items array<string>, flushed string",
        outputMode="Append", timeMode="ProcessingTime")
