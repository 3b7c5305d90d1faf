import os

import pytest
from pyspark.sql import types as T

from opsmetrics.session import checkpoint_folder, cut_lineage, dimension


class Session:
    """A session without a checkpoint setting, on a given master."""

    def __init__(self, master, configured=None):
        self.master, self.configured, self.folder = master, configured, None
        self.conf = self.sparkContext = self

    def get(self, key, default):
        assert key == "spark.checkpoint.dir"
        return self.configured or default

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_the_named_folder_is_used(spark):
    assert checkpoint_folder(Session("spark://host-01:7077", "hdfs:///shared")) == "hdfs:///shared"
    assert checkpoint_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_a_cluster_must_name_a_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_folder(Session("yarn"))


def test_a_local_session_gets_its_own():
    session = Session("local[4]")
    folder = checkpoint_folder(session)
    assert os.path.isdir(folder) and session.folder == folder
    assert checkpoint_folder(session) == folder


def test_cut_lineage_keeps_rows_and_forgets_the_plan(spark):
    df = spark.range(100).selectExpr("id", "id % 7 AS k").repartition(4)
    kept = cut_lineage(df)
    assert kept.collect() == df.collect()
    assert "Exchange" not in kept._jdf.queryExecution().executedPlan().toString()
    folder = spark.conf.get("spark.checkpoint.dir")
    assert any("rdd-" in d for _, dirs, _ in os.walk(folder) for d in dirs)


def test_dimension_has_a_known_size(spark):
    schema = T.StructType(
        [T.StructField("name", T.StringType()), T.StructField("place", T.IntegerType())]
    )
    df = dimension(spark, [("a", 1), (None, 2)], schema)
    assert sorted(map(tuple, df.collect()), key=repr) == [("a", 1), (None, 2)]
    assert "LocalTableScan" in df._jdf.queryExecution().executedPlan().toString()
    assert dimension(spark, [], schema).collect() == []
