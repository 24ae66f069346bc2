"""Lookups by trace: right rows in order, from the few files that hold them."""

from pyspark.sql import functions as F

from beaconry.sources import trace_store


def rows_of_all_kinds(spark, n=30_000):
    """A third of all rows in one trace, some without a trace or a time, the rest in traces of about ten rows."""
    i = F.col("id")
    trace = F.when(i % 3 == 0, "hot").when(i % 1001 == 1, None).otherwise(F.md5((i % (n // 15)).cast("string")))
    return spark.range(n).select(trace.alias("trace_id"), F.when(i % 997 != 5, i * 7919 % n).alias("ts_ms"),
                                 F.when(i % 2 == 0, "log").otherwise("span").alias("kind"), i.alias("detail"))


def test_lookups(spark, tmp_path):
    rows, folder = rows_of_all_kinds(spark), str(tmp_path / "store")
    trace_store.write_trace_store(rows, folder, parts=40)
    held = spark.read.parquet(f"{folder}/ranges").collect()
    assert len(held) == 40 and sum(r.rows for r in held) == rows.count() and max(r.rows for r in held) < 3 * rows.count() // 40
    some = [r.trace_id for r in rows.where("trace_id <> 'hot'").select("trace_id").distinct().orderBy("trace_id").limit(700).collect()]
    for asked in ([some[3]], [some[5], some[600]], ["hot"], ["nothing like it"], [], [some[0], "hot", "zz"]):
        got = trace_store.timeline(spark, folder, asked)
        want = rows.where(F.col("trace_id").isin(asked)) if asked else rows.limit(0)
        assert sorted(map(str, got.drop("part").select(*rows.columns).collect())) == sorted(map(str, want.collect()))
        parts = got.select(F.spark_partition_id().alias("p"), "*").collect()
        for a, b in zip(parts, parts[1:]):
            if a.p == b.p:
                key = lambda r: (r.part, r.trace_id, r.ts_ms is not None, r.ts_ms or 0, r.kind)
                assert key(a) <= key(b)


def test_few_files_and_no_exchange(spark, tmp_path):
    rows, folder = rows_of_all_kinds(spark), str(tmp_path / "store")
    trace_store.write_trace_store(rows, folder, parts=40)
    one = rows.where("trace_id <> 'hot'").select("trace_id").first()[0]
    found = trace_store.timeline(spark, folder, [one])
    assert len(found.inputFiles()) <= 2 and len(trace_store.parts_of(spark, folder, ["hot"])) >= 13
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "PushedFilters: [IsNotNull(trace_id), EqualTo(trace_id" in plan


def test_empty(spark, tmp_path):
    rows, folder = rows_of_all_kinds(spark).limit(0), str(tmp_path / "store")
    trace_store.write_trace_store(rows, folder, parts=4)
    assert trace_store.timeline(spark, folder, ["a"]).count() == 0
