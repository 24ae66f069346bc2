"""Where scratch tables go, and when a scan is spread."""

from beaconry import session


class _Conf(dict):
    def get(self, key, default=None):
        return super().get(key, default)


class _Session:
    def __init__(self, **conf):
        self.conf = _Conf(conf)


def test_scratch_tables_go_to_the_shared_folder():
    shared = _Session(**{"spark.checkpoint.dir": "hdfs:///checkpoints/"})
    first, second = session.scratch_dir(shared, "x"), session.scratch_dir(shared, "x")
    assert first.startswith("hdfs:///checkpoints/beaconry/x-") and first != second


def test_spread_leaves_scans_with_enough_splits_alone(spark):
    wide = spark.range(0, 100, numPartitions=64)
    assert session.spread(wide) is wide
    assert session.spread(spark.range(0, 100, numPartitions=1)).rdd.getNumPartitions() > 1
