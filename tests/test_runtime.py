import os

import pytest

from varstrata.plans import runtime


def test_written_tables_are_columns_in_the_shared_folder(spark):
    frame = runtime.written(spark.range(10).selectExpr("id", "cast(id as string) as text"), "kept")
    assert frame.schema.simpleString() == "struct<id:bigint,text:string>" and frame.count() == 10
    assert "kept-" in frame.inputFiles()[0]


def test_cleanup_removes_what_the_session_wrote(spark):
    frame = runtime.written(spark.range(10))
    folder = os.path.dirname(frame.inputFiles()[0].removeprefix("file://").removeprefix("file:"))
    assert os.path.isdir(folder)
    assert runtime.cleanup(spark) > 0
    assert not os.path.exists(folder) and runtime.cleanup(spark) == 0


class Elsewhere:
    """A session on a cluster without a shared folder."""

    class conf:
        @staticmethod
        def get(key, default=None):
            return default

    class sparkContext:
        master = "spark://host:7077"

        @staticmethod
        def getCheckpointDir():
            return None


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "local-cluster[2,1,1024]"])
def test_a_cluster_needs_a_shared_folder(master):
    Elsewhere.sparkContext.master = master
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        runtime.shared_dir(Elsewhere)
