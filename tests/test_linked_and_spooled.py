"""trace_linked counts all tables in one pass; write_spool prepares only what it writes."""

from beaconry.operators import hot_keys, reports
from beaconry.plans import source_jobs


def test_linked_tables_meet_the_errors_in_one_join(spark):
    """One join with the errors, whatever the number of tables: joins that follow each other sort in the same task, and their memory adds up."""
    errors = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "event_id long, trace_id string")
    some = spark.createDataFrame([("a",), ("a",), ("c",), (None,)], "trace_id string")
    got = reports.trace_linked(errors, some, some.limit(0), some.limit(1), some)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(
        [("a", 1, 2, 0, 1, 2), ("b", 2, 0, 0, 0, 0), (None, 3, 0, 0, 0, 0)], key=repr) and got.columns == [
        "trace_id", "event_id", "linked_spans", "linked_logs", "linked_requests", "linked_queries"]
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Join LeftOuter") == 1


def test_write_spool_builds_no_request_batches(spark, sf_dir, monkeypatch):
    """Numbering the requests of hot hosts writes them all before the filter on the path can leave them out."""
    def never(*args, **kwargs):
        raise AssertionError("requests are numbered")

    monkeypatch.setattr(hot_keys, "slotted", never)
    got = source_jobs.write_spool(spark, sf_dir)
    assert got.count() == spark.read.parquet(f"{sf_dir}/events.parquet").count()
