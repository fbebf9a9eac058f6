"""Session settings: submitted ones win, and a cluster needs a shared folder."""

import pytest

from snaplytics import session as S


class Conf(dict):
    def get(self, key, default=None):
        return dict.get(self, key, default)


class FakeContext:
    def __init__(self, conf):
        self.conf = conf

    def getConf(self):
        return self

    def getAll(self):
        return list(self.conf.items())

    def get(self, key, default=None):
        return self.conf.get(key, default)

    def getCheckpointDir(self):
        return None


class FakeSession:
    def __init__(self, **conf):
        self.conf = Conf({k.replace("__", "."): v for k, v in conf.items()})
        self.sparkContext = FakeContext(dict(self.conf))


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        S.checkpoint_root(FakeSession(spark__master="spark://host:7077"))


def test_submitted_settings_are_kept():
    s = FakeSession(**{"spark__sql__session__timeZone": "Asia/Tokyo"})
    s.conf.set = s.conf.__setitem__
    S.apply_defaults(s)
    assert s.conf["spark.sql.session.timeZone"] == "Asia/Tokyo"
    assert s.conf["spark.sql.adaptive.enabled"] == "true"


def test_shuffle_partitions_are_left_to_the_submitter(spark):
    assert "spark.sql.shuffle.partitions" not in S.SESSION_DEFAULTS
    before = spark.conf.get("spark.sql.shuffle.partitions")
    S.build_session()
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_scratch_lies_in_the_application_folder(spark):
    a, b = S.scratch_path(spark, "x"), S.scratch_path(spark, "x")
    assert a != b and f"snaplytics-{spark.sparkContext.applicationId}" in a
