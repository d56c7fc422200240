"""Rolling means and best marks of running jobs: a state per run, timers, append mode."""
import datetime as dt
import math
import random

from pyspark.sql import functions as F

from corpuslm.operators import metrics as M
from corpuslm.streaming import live as L
from corpuslm.streaming import stream as STR

T0 = dt.datetime(2024, 1, 1)
KIND = "run_id bigint, loss double, ts timestamp_ntz, event_id bigint, step string"


class Folder:
    """A table that grows by files, and the rows that a live query has written so far."""

    def __init__(self, spark, path, log_every, eval_every):
        self.spark, self.path, self.every = spark, path, (log_every, eval_every)

    def add(self, rows):
        d = self.spark.createDataFrame([(*r, "clash") for r in rows], KIND)
        d.coalesce(1).write.mode("append").parquet(str(self.path / "log.parquet"))

    def run(self):
        log = STR.read_table_stream(self.spark, str(self.path), "log")
        out = L.run_live(L.live_metrics(log, *self.every, watermark="1 minute", order="event_id"), root=str(self.path / "q"))
        got = self.spark.read.parquet(out).collect()
        return sorted((tuple(r) for r in got), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))


def _at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def test_rows_wait_for_the_watermark_and_late_ones_are_dropped(spark, tmp_path):
    t = Folder(spark, tmp_path, 2, 2)
    t.add([(1, 4.0, _at(0), 1), (1, 2.0, _at(20), 3), (1, 6.0, _at(10), 2), (1, 1.0, _at(65), 4)])
    # the watermark stands at 5 s: one row is out, which is step 1
    assert t.run() == []
    t.add([(1, 8.0, _at(15), 5), (1, 3.0, _at(130), 6)])  # out of order, but not late; then 70 s
    two_steps = [(1, 2, 5.0, 6.0, True), (1, 4, 5.0, 2.0, True)]
    assert t.run() == two_steps
    t.add([(1, -9.0, _at(60), 7), (1, 5.0, _at(131), 8), (1, 7.0, _at(300), 9)])  # -9 is late
    assert t.run() == [*two_steps, (1, 6, 2.0, 3.0, False)]
    assert t.run() == [*two_steps, (1, 6, 2.0, 3.0, False)]  # nothing new, nothing twice


def test_a_run_of_its_own_for_null_and_no_number_wins(spark, tmp_path):
    t = Folder(spark, tmp_path, 1, 1)
    nan = float("nan")
    t.add([(None, nan, _at(1), 1), (None, 3.0, _at(2), 2), (None, None, _at(3), 3), (None, 3.0, _at(3), 4),
           (2, 1.0, None, 5), (2, 2.0, _at(4), 6), (2, 2.0, _at(4), 6), (3, 0.0, _at(500), 7)])
    got = t.run()
    assert math.isnan(got[0][2]) and math.isnan(got[0][3]) and got[0][4] is False
    assert got[1:] == [(None, 2, 3.0, 3.0, True), (None, 3, None, None, False), (None, 4, 3.0, 3.0, False),
                       (2, 1, 2.0, 2.0, True), (2, 2, 2.0, 2.0, False)]  # equal is not lower


def test_an_empty_stream_gives_no_rows(spark, tmp_path):
    t = Folder(spark, tmp_path, 1, 1)
    t.add([])
    assert t.run() == []


def test_many_files_give_the_rows_of_the_batch_operators(spark, tmp_path):
    """Whatever the files and starts, as long as nothing is late."""
    rng = random.Random(5)
    t = Folder(spark, tmp_path, 7, 10)
    rows = [(rng.choice([1, 1, 1, 2, 3]), rng.choice([float(rng.randint(0, 9)), rng.random(), float("nan")]), _at(i // 3), i)
            for i in range(600)]
    for a in range(0, 600, 150):  # within a file and over the border of two files the order is any
        part = rows[max(0, a - 20): a + 130] if a < 450 else rows[a - 20:]
        rng.shuffle(part)
        t.add(part)
        if a != 150:
            got = t.run()
    log = spark.createDataFrame([r for r in rows], KIND.rsplit(",", 1)[0])
    from pyspark.sql import Window
    log = log.withColumn("step", F.row_number().over(Window.partitionBy("run_id").orderBy("ts", "event_id")).cast("long"))
    end = (599 // 3) - 60
    out = log.filter(F.unix_micros(F.col("ts").cast("timestamp")) <= F.unix_micros(F.lit(_at(end)).cast("timestamp")))
    mean = {(r["run_id"], r["step"]): r["avg_loss"] for r in M.rolling_loss(out, 7).collect()}
    marks = {(r["run_id"], r["step"]): (r["val_loss"], r["is_best"]) for r in M.mark_best(M.eval_points(out, 10)).collect()}
    want = sorted((*k, mean.get(k), *marks.get(k, (None, None))) for k in mean.keys() | marks.keys())
    assert len(want) > 50 and sum(r[4] is True for r in want) > 3
    assert list(map(repr, got)) == list(map(repr, want))
