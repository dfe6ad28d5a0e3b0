import contextlib
import io

from epitrend.functions.sizing import broadcast_if_bounded


def _plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_broadcast_only_within_the_bound(spark):
    big = spark.range(1000).withColumnRenamed("id", "k")
    small = spark.createDataFrame([(i, f"v{i}") for i in range(5)], "k long, v string")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # only the hint may broadcast
    try:
        inside = big.join(broadcast_if_bounded(small, 5), "k")
        beyond = big.join(broadcast_if_bounded(small, 4), "k")
        assert "BroadcastHashJoin" in _plan(inside)
        assert "BroadcastHashJoin" not in _plan(beyond) and "SortMergeJoin" in _plan(beyond)
        assert inside.count() == beyond.count() == 5
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_materialized_side_is_checkpointed(spark):
    small = spark.range(3).withColumnRenamed("id", "k")
    out = broadcast_if_bounded(small.groupBy("k").count(), 10, materialize=True)
    assert "ExistingRDD" in _plan(out) and out.count() == 3


def test_broadcast_bounds_bytes(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = spark.range(10).withColumnRenamed("id", "k")
        wide = spark.createDataFrame([(i, "x" * 1000) for i in range(5)], "k long, v string")
        assert "BroadcastHashJoin" not in _plan(big.join(broadcast_if_bounded(wide, 10, max_bytes=4000), "k"))
        assert "BroadcastHashJoin" in _plan(big.join(broadcast_if_bounded(wide, 10, max_bytes=6000), "k"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    import pytest

    from epitrend.session import checkpoint_root

    def fake(master, folder=None):
        kept = []
        sc = SimpleNamespace(master=master, getCheckpointDir=lambda: kept[0] if kept else None,
                             setCheckpointDir=kept.append,
                             getConf=lambda: SimpleNamespace(get=lambda k, d=None: folder))
        return SimpleNamespace(sparkContext=sc)

    for master in ("yarn", "spark://host:7077", "k8s://x", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            checkpoint_root(fake(master))
        assert checkpoint_root(fake(master, "hdfs://nn/x/")) == "hdfs://nn/x"
    for master in ("local", "local[*]", "local[8]"):
        assert checkpoint_root(fake(master))
