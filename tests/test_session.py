"""Session settings and the shared folder."""

import pytest

from hazardmart import session
from hazardmart.sources.landed import land


class Context:
    master = "spark://cluster:7077"

    def getCheckpointDir(self):
        return None


class ClusterSession:
    """Just what ``shared_folder`` asks a session for."""

    sparkContext = Context()

    def __init__(self, settings):
        self.conf = settings


def test_shared_folder_is_the_configured_one():
    spark = ClusterSession({"spark.checkpoint.dir": "hdfs://shared/checkpoints"})
    assert session.shared_folder(spark) == "hdfs://shared/checkpoints"


def test_a_cluster_never_falls_back_to_a_local_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(ClusterSession({}))


def test_landed_rows_are_read_from_files(spark):
    landed = land(spark.range(10), "numbers")
    assert landed.count() == 10
    assert all("/numbers-" in path for path in landed.inputFiles())


def test_shuffle_settings_follow_the_largest_shuffle():
    small = session.shuffle_settings(1 << 30)
    large = session.shuffle_settings(10 << 40)
    assert small["spark.sql.shuffle.partitions"] == "200"
    assert large["spark.sql.shuffle.partitions"] == "81920"
