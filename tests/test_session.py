import os

import pytest

from heliovane import session


class Context:
    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = f"{folder}/of-this-application"


class Session:
    def __init__(self, master, folder=None, **conf):
        self.sparkContext, self.conf = Context(master, folder), self
        self.options = conf

    def get(self, name, default=None):
        return self.options.get(name.replace(".", "_"), default)


def test_the_named_folder_is_used():
    on_cluster = Session("yarn", spark_checkpoint_dir="hdfs:///shared")
    assert session.shared_dir(on_cluster) == "hdfs:///shared/of-this-application"
    assert session.shared_dir(Session("yarn", "s3a://set/earlier", spark_checkpoint_dir="x")) == "s3a://set/earlier"


def test_no_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Session("spark://host:7077"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Session("local[2]"))


def test_scratch_paths_are_new_ones():
    there = Session("local[2]", "/shared")
    first, second = session.scratch_path(there, "a"), session.scratch_path(there, "a")
    assert first.startswith("/shared/") and first != second


def test_settled_tables_start_from_files(spark):
    table = session.settle(spark.range(10).selectExpr("id", "id * 2 AS twice"))
    assert table.agg({"twice": "sum"}).first()[0] == 90
    assert len(table.inputFiles()) > 0


def test_discarded_tables_are_gone(spark):
    table = session.settle(spark.range(3))
    kept = session.settle(spark.range(3))
    session.discard(table)
    assert not os.path.exists(table.settled_at.removeprefix("file:"))
    assert kept.count() == 3
