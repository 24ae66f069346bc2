"""The kinds of a batch are written side by side."""

import threading

from beaconry.sources import envelopes as env
from beaconry.streaming import stateless


def test_kinds_are_written_side_by_side(spark, tmp_path, monkeypatch):
    """Two writes must be under way at once; one after the other they would wait for each other in vain."""
    lines = ['{"path":"/ingest/v1/heartbeat","payload":{"slug":"a","status":"success"},"ts":1}', '{"ts":']
    batch = env.parse_envelopes(spark.createDataFrame([(line, "x") for line in lines], "value string, file string"))
    real, meeting = stateless.write_batch, threading.Barrier(2, timeout=60)

    def write(df, folder, batch_id):
        if folder.endswith(("/heartbeats", "/rejected_envelopes")):
            meeting.wait()
        real(df, folder, batch_id)

    monkeypatch.setattr(stateless, "write_batch", write)
    stateless.ingest_writer(str(tmp_path), ["heartbeats"])(batch, 0)
    assert [r.slug for r in spark.read.parquet(f"{tmp_path}/heartbeats").collect()] == ["a"]
    assert [r.rejected for r in spark.read.parquet(f"{tmp_path}/rejected_envelopes").collect()] == ["document"]
    assert spark.read.parquet(f"{tmp_path}/rejected_heartbeats").count() == 0
