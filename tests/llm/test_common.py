from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from quarry.llm import common


def session(master):
    conf = {}
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda k, d=None: conf.get(k, d), set=conf.__setitem__), sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: None)
    )


def test_a_cluster_must_name_its_shared_folder():
    for master in ("spark://host:7077", "yarn", "k8s://https://host", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="checkpoint"):
            common.shared_folder(session(master))
    local = session("local[4]")
    assert common.shared_folder(local).startswith("file:///") and common.shared_folder(local) == common.shared_folder(local)


def test_names_that_no_column_has(spark):
    df = spark.range(1).select(F.lit(1).alias("_A"), F.lit(2).alias("__a"), F.lit(3).alias("x.`y"))
    assert common.unused(df, "_a") == "___a" and common.unused(df, "b") == "b"
    assert df.select(common.column("x.`y")).first()[0] == 3


def test_release_of_what_a_stage_wrote(spark):
    from quarry.llm import common

    before = common.materialise(spark.range(2), "before")
    mark = common.written_so_far()
    part, out = common.materialise(spark.range(3), "part"), common.materialise(spark.range(4), "out")
    common.release_since(spark, mark, out)
    assert before.count() == 2 and out.count() == 4 and common.written_so_far() == mark + 1
    with pytest.raises(Exception, match="FILE_NOT_EXIST|does not exist|PATH_NOT_FOUND|FileNotFound"):
        part.count()
