"""Exact duplicates, latest load, restamp."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from ledgerlake.operators import dedup
from ledgerlake.operators.dedup import exact_rows, latest_load, latest_version, restamp

L1, L2 = "20240101000000", "20240201000000"
STRATEGIES = ("join", "rank")


def loads(spark, data):
    return spark.createDataFrame(data, "k string, x int, dt_proc string")


def test_two_loads_of_the_same_rows(spark):
    data = [(k, 1, load) for load in (L1, L2) for k in "abc"]
    df = loads(spark, data + data)
    assert exact_rows(df, "with_load").count() == 6
    assert exact_rows(df, "business").count() == 3
    assert "dt_proc" not in exact_rows(df, "business").columns
    with pytest.raises(ValueError):
        exact_rows(df, "other")


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_ties_are_kept_and_null_keys_dropped(spark, strategy):
    df = loads(
        spark,
        [("A", 1, L1), ("A", 2, L2), ("A", 2, L2), ("A", 3, L2), ("B", 4, L1), (None, 5, L2),
         (None, 6, L1), ("C", 7, None)],
    )
    assert rows(latest_load(df, "k", strategy=strategy)) == [
        ("A", 2, L2), ("A", 2, L2), ("A", 3, L2), ("B", 4, L1),
    ]
    kept = latest_load(df, "k", null_keys="keep", strategy=strategy)
    assert rows(kept) == [
        ("A", 2, L2), ("A", 2, L2), ("A", 3, L2), ("B", 4, L1), (None, 5, L2),
    ]


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_latest_load_is_idempotent_and_keeps_columns(spark, strategy):
    df = loads(spark, [("A", 1, L1), ("A", 2, L2), ("B", 4, L1)])
    once = latest_load(df, ["k"], strategy=strategy)
    assert once.columns == df.columns
    assert rows(latest_load(once, ["k"], strategy=strategy)) == rows(once)


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_composite_key_with_null_parts(spark, strategy):
    df = spark.createDataFrame(
        [("a", None, 1, 1), ("a", None, 2, 2), ("a", "x", 3, 1), (None, "x", 4, 9)],
        "k string, m string, x int, dt_proc bigint",
    )
    assert rows(latest_load(df, ["k", "m"], strategy=strategy)) == [("a", "x", 3, 1)]
    kept = latest_load(df, ["k", "m"], null_keys="keep", strategy=strategy)
    assert sorted(r[2] for r in rows(kept)) == [2, 3, 4]


def test_unknown_modes(spark):
    df = loads(spark, [("A", 1, L1)])
    with pytest.raises(ValueError):
        latest_load(df, "k", strategy="sort")
    with pytest.raises(ValueError):
        latest_load(df, "k", null_keys="maybe")


def test_hot_key_is_split_by_the_skew_join(spark, conf, tmp_path):
    """A third of the rows under one key and load: the join cuts them into several tasks."""
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20k",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="10k",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
    )
    key = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id"))
    text = F.sha2(F.col("id").cast("string"), 256)
    current = spark.range(0, 90_000, 1, 8).select(key.alias("k"), text.alias("x"), F.lit(L2).alias("dt_proc"))
    older = current.limit(1_000).withColumn("dt_proc", F.lit(L1))
    current.unionByName(older).write.parquet(str(tmp_path / "t"))
    latest = latest_load(spark.read.parquet(str(tmp_path / "t")), "k")
    assert len(latest.collect()) == 90_000
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin(skew=true)" in plan
    assert "SortAggregate" not in plan


def test_restamp_keeps_the_stamp_last(spark):
    df = spark.createDataFrame([(L1, "A", 1)], "dt_proc string, k string, x int")
    assert rows(restamp(df, L2)) == [("A", 1, L2)]
    assert restamp(df, L2).columns == ["k", "x", "dt_proc"]


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("stamp", ["2024-02", "", "-7", "123456789012345678"])
def test_stamps_that_are_no_numbers_stop_the_query(spark, conf, ansi, stamp):
    conf(spark__sql__ansi__enabled=ansi)
    df = loads(spark, [("A", 1, L1), ("A", 2, stamp)])
    for result in (latest_load(df, "k"), latest_load(df, "k", strategy="rank"), latest_version(df, ["k"])):
        with pytest.raises(Exception, match="load stamp is not a string of digits"):
            result.collect()


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_stamps_keep_their_zeros(spark, conf, ansi):
    conf(spark__sql__ansi__enabled=ansi)
    df = loads(spark, [("A", 1, "006"), ("A", 2, "007"), ("B", 3, "0"), ("B", 4, None), ("C", 5, None)])
    assert rows(latest_version(df, ["k"])) == [("A", "007"), ("B", "0"), ("C", None)]
    assert rows(latest_load(df, "k")) == [("A", 2, "007"), ("B", 3, "0")]


@pytest.mark.parametrize("few", [0, 1, 100])
@pytest.mark.parametrize("null_keys", ["drop", "keep"])
def test_keys_of_several_loads_are_looked_up_first(spark, monkeypatch, few, null_keys):
    monkeypatch.setattr(dedup, "FEW_KEYS", few)
    data = [("a", 1, L1), ("a", 2, L2), ("a", 2, L2), ("b", 3, L1), ("c", 4, None), ("d", 5, None), ("d", 6, L1),
            (None, 7, L1), (None, 8, L2), ("e", 9, L2), ("e", 10, L1)]
    df = loads(spark, data)
    got = latest_load(df, "k", null_keys=null_keys, strategy="mixed")
    assert rows(got) == rows(latest_load(df, "k", null_keys=null_keys))
    with pytest.raises(Exception, match="load stamp"):
        latest_load(loads(spark, [("a", 1, "x")]), "k", strategy="mixed").collect()


def test_rows_of_keys_with_one_load_stay_in_their_tasks(spark, monkeypatch):
    df = loads(spark, [(k, n, L1) for k in ("a", "b", None) for n in range(3)])
    latest = latest_load(df, "k", strategy="mixed")
    assert "Exchange" not in latest._jdf.queryExecution().executedPlan().toString()
    assert latest.count() == 6
    df = df.unionByName(loads(spark, [("b", 9, L2)]))
    plan = latest_load(df, "k", strategy="mixed")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
