from types import SimpleNamespace

import pytest

from ferrule.llm import common


def session(master, conf=None, known=None):
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: known, setCheckpointDir=lambda p: None)
    return SimpleNamespace(conf=SimpleNamespace(get=lambda k, d: conf), sparkContext=context)


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        common.shared_folder(session("spark://host:7077"))
    assert common.shared_folder(session("spark://host:7077", conf="hdfs://x/y/")) == "hdfs://x/y"
    assert common.shared_folder(session("yarn", known="hdfs://x/z")) == "hdfs://x/z"


def test_values_beside_untouched_columns(spark, odd):
    docs = odd.selectExpr("*", "cast(1.5 as decimal(10,2)) as d", "timestamp'2020-01-01' as t", "map('a', n_chars) as m", "array(doc_id) as a", "struct(doc_id as `x y`) as s")
    got = common.with_values(docs, "n long, w array<string>", lambda texts: ((len(t or ""), (t or "").split()[:2]) for t in texts), rows=3)
    assert got.columns == [*docs.columns, "n", "w"]
    assert sorted(map(str, got.drop("n", "w").collect())) == sorted(map(str, docs.collect()))
    assert sorted(r.n for r in got.collect()) == sorted(len(r.text or "") for r in docs.collect())


def test_forgotten_tables_are_deleted(spark):
    import os

    df = common.saved(spark.range(5), "some")
    path = df.inputFiles()[0].removeprefix("file://")
    assert os.path.exists(path)
    common.forget(df)
    assert not os.path.exists(os.path.dirname(path))


def test_components(spark):
    edges = [(1, 2), (2, 3), (9, 8), (5, 5), (3, 1)]
    got = {r.node: r.component for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 8: 8, 9: 8, 5: 5}
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0
