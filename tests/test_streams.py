"""Streams fed several files, one a micro-batch, give what the batch operators give."""

import time

import pytest
from pyspark.sql import Window, functions as F

from beaconry.operators import context, delivery, sessions
from beaconry.sources import tables as t
from beaconry.streaming import run, spool_state, stateful, stateless


def fed(spark, df, folder, parts):
    """A stream of ``df`` in order of ts_ms, cut into ``parts`` files that arrive one a batch."""
    bounds = [r.b for r in df.select(F.ntile(parts).over(
        Window.orderBy("ts_ms")).alias("n"), "ts_ms").groupBy("n").agg(
        F.max("ts_ms").alias("b")).orderBy("n").collect()]
    low = -1
    for i, high in enumerate(bounds):
        df.where((F.col("ts_ms") > low) & (F.col("ts_ms") <= high)).coalesce(1).write.parquet(f"{folder}/part={i}")
        low = high
    return (spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1)
            .option("recursiveFileLookup", "true").parquet(folder))


def finish(spark, df, folder):
    run.to_parquet(df, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{folder}/out")


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def with_time(df):
    return df.withColumn("at", F.timestamp_millis("ts_ms"))


def shuffled(spark, df, folder, parts):
    """A stream of ``df`` in ``parts`` files that hold rows of any time, and a last one far later, which moves the watermark."""
    for part in range(parts):
        df.where(F.pmod(F.xxhash64("event_id"), F.lit(parts)) == part).orderBy(F.rand(part)).coalesce(1).write.parquet(f"{folder}/part={part}")
    last = df.limit(1).withColumns({df.columns[0]: F.lit("last"), "ts_ms": F.lit(4 * 10**12)})
    last.coalesce(1).write.parquet(f"{folder}/part={parts}")
    return with_time(spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(folder))


def test_breadcrumbs(spark, sf_dir, tmp_path):
    """Marks in shuffled micro-batches give the batch result."""
    marks = t.CRUMB_MARKS.frame(spark, sf_dir).select("process_id", "ts_ms", "event_id", "is_error", "message")
    stream = shuffled(spark, marks, str(tmp_path / "in"), 3)
    got = finish(spark, stateful.stream_breadcrumbs(stream, "90 days", limit=4, ttl_ms=10**10, bucket_ms=3_600_000), str(tmp_path))
    want = context.crumb_owners(marks, 4).select("process_id", "error_id", "event_id", "message")
    assert rows(got.where("process_id <> 'last'")) == rows(want)


def test_breadcrumbs_are_forgotten(spark, tmp_path):
    hour = 3_600_000
    marks = spark.createDataFrame([("p", 1 * hour, 1, False, "a"), ("p", 2 * hour, 2, False, "b"), ("p", 9 * hour, 3, True, "c"), ("p", None, 4, False, "d"),
                                   ("q", 1 * hour, 5, False, "e"), ("q", 3 * hour, 6, True, "f"), ("q", 3 * hour, 7, True, "g")],
                                  "process_id string, ts_ms long, event_id long, is_error boolean, message string")
    got = finish(spark, stateful.stream_breadcrumbs(shuffled(spark, marks, str(tmp_path / "in"), 2), "90 days", ttl_ms=5 * hour), str(tmp_path))
    assert rows(got) == [("q", 6, 5, "e")]


def test_sessions(spark, sf_dir, tmp_path):
    """Shuffled micro-batches again; every session is closed by the late mark, those without an end as abnormal or crashed."""
    marks = t.SESSION_MARKS.frame(spark, sf_dir).select("session_id", "ts_ms", "event_id", "mark", "final_status")
    stream = shuffled(spark, marks, str(tmp_path / "in"), 3)
    got = finish(spark, stateful.stream_sessions(stream, "90 days", 10**10), str(tmp_path))
    folded = sessions.fold_sessions(marks)
    silent = ~F.col("ended") & F.col("status").isin("ok", "errored")
    want = folded.withColumn("status", F.when(silent, "abnormal").otherwise(F.col("status"))).select(got.columns)
    assert rows(got.where("session_id <> 'last'")) == rows(want)


def test_marks_fold_to_a_row_a_session(spark):
    """However many marks a session has, and wherever they lie, one row reaches the state."""
    marks = with_time(spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 500)).alias("session_id"), (F.col("id") * 7919 % 30_000).alias("ts_ms"),
        F.col("id").alias("event_id"), F.when(F.col("id") % 97 == 0, "error").when(F.col("id") == 29_999, "end").otherwise("start").alias("mark"),
        F.lit(None).cast("string").alias("final_status"))).repartition(7)
    folds = stateful.fold_marks(marks).collect()
    assert len(folds) == len({r.session_id for r in folds}) == marks.select("session_id").distinct().count()
    hot = next(r for r in folds if r.session_id == "hot")
    held = marks.where("session_id = 'hot'")
    assert (hot.started, hot.latest) == tuple(held.agg(F.min("ts_ms"), F.max("ts_ms")).first())
    assert {tuple(e) for e in hot.errors} == {(r.ts_ms, r.event_id) for r in held.where("mark = 'error'").collect()}


def spool_entries(spark, n=400):
    """Entries of three spools, a third and more of them in one."""
    spool = F.when(F.col("id") % 5 < 3, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 2))
    return spark.range(n).select(spool.alias("spool_id"), (F.col("id") * 37 % n).alias("ts_ms"), F.col("id").alias("seq"), (F.col("id") % 50 * 20).alias("bytes"),
                                 F.col("id").cast("string").alias("entry"), F.col("id").alias("event_id"))


@pytest.mark.parametrize("bounds", [{"max_events": 40, "max_bytes": 9000}, {"max_events": 25}, {"max_bytes": 3000, "max_age_s": 0.25}])
def test_retention(spark, tmp_path, bounds):
    """Changes of shuffled micro-batches add up to the batch result; each batch writes its changes, older folders go."""
    entries = spool_entries(spark)
    for part in range(7):
        entries.where(F.pmod(F.xxhash64("seq"), F.lit(7)) == part).coalesce(1).write.parquet(f"{tmp_path}/in/part={part}")
    stream = spark.readStream.schema(entries.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")
    folder = str(tmp_path / "spool")
    changes = spool_state.stream_retention(stream, F.lit(400), **bounds)
    spool_state.run_retention(changes, folder, str(tmp_path / "checkpoint"), compact_every=3).awaitTermination()
    want = delivery.retention(entries, F.lit(400), **{"max_events": 100, **bounds}).select("spool_id", "ts_ms", "seq", "bytes", "entry")
    kept = spool_state.kept_entries(spark, folder)
    assert rows(kept) == rows(want)
    batches, wholes = spool_state._folders(spark, f"{folder}/changes", "batch"), spool_state._folders(spark, f"{folder}/whole", "upto")
    assert batches == [6] and wholes == [5]
    # a batch that runs again, and a compaction of what was compacted, change nothing
    again = spark.read.parquet(f"{folder}/changes/batch=6")
    spool_state.retention_writer(spark, folder, 1)(spark.createDataFrame(again.collect(), again.schema), 6)
    assert rows(spool_state.kept_entries(spark, folder)) == rows(want)


def test_bodies_go_out_full_or_old(spark, tmp_path):
    """No body over the limit, none but full ones before their time, all items once, and none left behind when time has passed."""
    items = spark.range(1150).select(F.when(F.col("id") % 10 < 7, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 3)).alias("flush_key"),
                                     F.col("id").cast("string").alias("item"), F.col("id").alias("ts_ms"))
    stream = fed(spark, items, str(tmp_path / "in"), 3)
    query = run.to_parquet(spool_state.stream_chunks(stream, 100, 2_000), f"{tmp_path}/out", f"{tmp_path}/checkpoint", every="1 second")
    try:
        for _ in range(60):
            time.sleep(1)
            got = spark.read.schema("flush_key string, chunk bigint, items array<string>, flushed string").parquet(f"{tmp_path}/out").collect()
            if sum(len(r["items"]) for r in got) == 1150:
                break
    finally:
        query.stop()
    assert sorted(int(i) for r in got for i in r["items"]) == list(range(1150))
    assert all(len(r["items"]) == 100 if r.flushed == "full" else len(r["items"]) < 100 for r in got)
    by_key = {}
    for r in got:
        by_key.setdefault(r.flush_key, []).append(r.chunk)
    assert all(sorted(chunks) == list(range(len(chunks))) for chunks in by_key.values()) and {r.flushed for r in got} == {"full", "old"}


def test_dedupe_across_batches(spark, tmp_path):
    events = spark.range(60).select(F.col("id").alias("ts_ms"), (F.col("id") % 20).alias("event_id"))
    stream = with_time(fed(spark, events, str(tmp_path / "in"), 3))
    got = finish(spark, stateless.stream_dedupe(stream, "at", ["event_id"], "1 hour").select("event_id"), str(tmp_path))
    assert sorted(r[0] for r in got.collect()) == list(range(20))
