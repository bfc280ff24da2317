"""The scratch folder: the cluster's shared one, an own one in a single process, else an error."""

import pytest

from termscope import session as S


class Session:
    """Settings as a running session has them: fixed ones cannot be set."""

    def __init__(self, master, **fixed):
        self.fixed, self.own, self.conf, self.sparkContext, self.master = fixed, {}, self, self, master

    def get(self, key, default=None):
        return self.fixed.get(key.replace(".", "_"), self.own.get(key, default))

    def set(self, key, value):
        assert key != "spark.checkpoint.dir", "cannot be modified at run time"
        self.own[key] = value


def test_the_shared_folder_is_used_as_it_is():
    spark = S.local_scratch(Session("spark://host:1", spark_checkpoint_dir="/shared/"))
    assert S.scratch_dir(spark).startswith("/shared/termscope-") and not spark.own


def test_a_single_process_gets_its_own_folder_once():
    spark = S.local_scratch(Session("local[4]"))
    first = S.scratch_dir(spark).rsplit("/", 1)[0]
    assert S.scratch_dir(S.local_scratch(spark)).rsplit("/", 1)[0] == first
    assert S.scratch_dir(spark) != S.scratch_dir(spark)


def test_a_cluster_without_a_shared_folder_raises():
    with pytest.raises(ValueError, match=r"spark\.checkpoint\.dir"):
        S.scratch_dir(S.local_scratch(Session("yarn")))


def test_own_folder_can_be_set_in_a_running_session(spark):
    spark.conf.set("spark.termscope.probe", "x")
    assert spark.conf.get("spark.termscope.probe") == "x"
    spark.conf.unset("spark.termscope.probe")
    assert S.scratch_dir(spark)
