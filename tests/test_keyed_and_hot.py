"""Batches by a keyed permutation; runs cut into parts; windows in append mode."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from corpuslm.operators import dataset as D
from corpuslm.operators import metrics as M
from corpuslm.operators.order import running


@pytest.mark.parametrize("n", [1, 2, 3, 5, 64, 97, 1000])
def test_each_window_once_an_epoch_and_back(spark, n):
    e = F.lit(4)
    d = spark.range(n).select("id", D.window_at(F.col("id"), n, 9, e).alias("w"))
    rows = d.select("id", "w", D.place_of(F.col("w"), n, 9, e).alias("back")).collect()
    assert sorted(r["w"] for r in rows) == list(range(n))
    assert all(r["back"] == r["id"] for r in rows)


def test_keyed_batches_plan_and_restart(spark):
    n, size = 203, 20
    wins = spark.range(n).select(F.col("id").alias("win_id"))
    b = D.keyed_batches(wins, n, size, epochs=3, seed=1)
    plan = b._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
    got = {}
    for r in b.collect():
        got.setdefault((r["epoch"], r["batch"]), []).append(r["win_id"])
    for e in range(3):
        assert sorted(w for (ep, _), ws in got.items() if ep == e for w in ws) == list(range(n))
        assert [len(got[e, k]) for k in range(11)] == [20] * 10 + [3]
    assert got[0, 0] != got[1, 0] and got[1, 0] != got[2, 0]
    assert D.keyed_batches(wins, n, size, 1, seed=2).filter("batch = 0").count() == size
    # any step alone, after a restart
    steps = spark.createDataFrame([(0,), (10,), (11,), (25,)], "step int")
    by_step = {}
    for r in D.step_windows(steps, n, size, seed=1).collect():
        by_step.setdefault(r["step"], []).append(r["win_id"])
    for s, ws in by_step.items():
        assert sorted(ws) == sorted(got[s // 11, s % 11])
    assert set(by_step) == {0, 10, 11, 25}
    with pytest.raises(Exception, match="window numbers"):
        D.keyed_batches(wins, n - 1, size).collect()
    assert D.step_windows(steps, 0, size).collect() == []


def test_the_order_looks_shuffled(spark):
    """No rise or fall, and neighbours do not stay neighbours."""
    n = 5000
    w = [r["w"] for r in spark.range(n).select(D.window_at(F.col("id"), n, 0, F.lit(0)).alias("w")).sort("id").collect()]
    mean = (n - 1) / 2
    corr = sum((i - mean) * (x - mean) for i, x in enumerate(w)) / sum((i - mean) ** 2 for i in range(n))
    assert abs(corr) < 0.06  # four standard deviations of a random order
    assert sum(abs(a - b) == 1 for a, b in zip(w, w[1:])) < 12
    fixed = sum(i == x for i, x in enumerate(w))
    assert fixed < 8


def _log(spark, seed=3):
    """One run with over a third of all rows, one with gaps, one without a name."""
    rng = random.Random(seed)
    t0 = dt.datetime(2024, 1, 1)
    rows = []
    for run, steps in ((1, range(1, 901)), (2, sorted(rng.sample(range(1, 3000), 300))), (None, range(1, 120)), (4, [7])):
        for s in steps:
            loss = rng.choice([float("nan"), 0.5, 1.0, rng.random() * 9])
            rows.append((run, s, loss, t0 + dt.timedelta(seconds=s)))
    rng.shuffle(rows)
    return rows, spark.createDataFrame(rows, "run_id bigint, step bigint, loss double, ts timestamp").repartition(6)


def _runs(rows):
    by = {}
    for r in sorted(rows, key=lambda r: r[1]):
        by.setdefault(r[0], []).append(r)
    return by


@pytest.mark.parametrize("span", [1, 13, 100, 10 ** 6])
def test_rolling_loss_of_a_cut_run(spark, span):
    rows, log = _log(spark)
    want = {}
    for run, rs in _runs(rows).items():
        for i, r in enumerate(rs):
            if r[1] % 10 == 0:
                last = [x[2] for x in rs[max(0, i - 9): i + 1]]
                want[run, r[1]] = sum(last) / len(last)
    got = {(r["run_id"], r["step"]): r["avg_loss"] for r in M.rolling_loss(log, 10, span).collect()}
    assert got.keys() == want.keys()
    for k, v in want.items():
        assert (math.isnan(v) and math.isnan(got[k])) or abs(v - got[k]) < 1e-12


@pytest.mark.parametrize("span", [1, 50, 10 ** 6])
def test_best_marks_of_a_cut_run(spark, span):
    rows, log = _log(spark, 8)
    want = {}
    for run, rs in _runs(rows).items():
        low = math.inf
        for r in rs:
            want[run, r[1]] = r[2] < low
            low = min(low, r[2]) if not math.isnan(r[2]) else low
    got = {(r["run_id"], r["step"]): r["is_best"] for r in M.mark_best(log, "loss", span).collect()}
    assert got == want


def test_a_hot_run_is_spread_over_tasks(spark):
    log = spark.range(60_000).select(F.lit(1).alias("run_id"), (F.col("id") + 1).alias("step"), F.lit(1.0).alias("loss"))
    d = running(log, ["run_id"], F.floor(F.col("step") / 1000), ["step"], F.lit(1), "sum", "pos")
    # without the merging of small partitions, which a table of this size would not need to be cut at all
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["n"] for r in d.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) == 8 and max(sizes) < 60_000 / 3
    assert d.filter("pos != step - 1").count() == 0


def test_running_sum_and_max_of_nulls_and_nothing(spark):
    d = spark.createDataFrame([(None, 1, None), (None, 5, 2), ("a", 3, 4), ("a", 9, 1), ("a", 9, 7)], "g string, k int, v int")
    got = lambda fold: {(r["g"], r["k"], r["v"]): r["x"] for r in running(
        d, ["g"], F.floor(F.col("k") / 4), ["k", "v"], F.col("v"), fold, "x").collect()}
    assert got("max") == {(None, 1, None): None, (None, 5, 2): None, ("a", 3, 4): None, ("a", 9, 1): 4, ("a", 9, 7): 4}
    assert got("sum") == {(None, 1, None): 0, (None, 5, 2): 0, ("a", 3, 4): 0, ("a", 9, 1): 4, ("a", 9, 7): 5}
    assert running(d.limit(0), ["g"], F.col("k"), ["k"], F.col("v"), "sum", "x").collect() == []


def test_append_mode_gives_closed_windows_once(spark, tmp_path):
    from corpuslm.streaming import stream as STR
    t0 = dt.datetime(2024, 1, 1)
    at = lambda minutes: t0 + dt.timedelta(minutes=minutes)
    kind = "event_id bigint, user_id bigint, ts timestamp_ntz, value double"
    folder = tmp_path / "events.parquet"

    def add(rows):
        spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(str(folder))

    def run():
        ev = STR.read_table_stream(spark, str(tmp_path), "events")
        out = STR.run_available(STR.run_metrics_stream(ev), "m", "append", root=str(tmp_path / "q"))
        return sorted((r["window_start"].hour, r["run_id"], r["n"]) for r in spark.read.parquet(out).collect())

    add([(1, 1, at(5), 100.0), (2, 1, at(50), 300.0), (3, 2, at(61), 100.0)])
    assert run() == []                       # the watermark stands at 00:51
    add([(4, 1, at(75), 100.0)])             # 01:05: the first hour is closed
    assert run() == [(0, 1, 2)]
    add([(5, 1, at(20), 900.0), (6, 2, at(140), 100.0)])  # one row too late, then 02:10 - the second hour closes
    assert run() == [(0, 1, 2), (1, 1, 1), (1, 2, 1)]
