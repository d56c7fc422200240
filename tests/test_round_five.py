"""A long training keeps its plans short; what is written and shuffled on the way is small; the keyed order is no loop."""

import random
from pathlib import Path

from bpe_brute import train_brute
from corpuslm import session
from corpuslm.operators import bpe as B
from corpuslm.operators import dataset as D
from corpuslm.operators import segments as SEG
from corpuslm.operators import words as W
from pyspark.sql import functions as F


def test_lineage_of_a_round_does_not_grow_with_the_merges(spark, monkeypatch):
    rng = random.Random(8)
    texts = [" ".join("".join(rng.choice("abcd") for _ in range(rng.randint(1, 9))) for _ in range(60)) for _ in range(6)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    depth = []
    plain = B.recount
    monkeypatch.setattr(B, "APPLY_AFTER", 3)
    monkeypatch.setattr(B, "WRITE_AFTER", 2, raising=False)
    monkeypatch.setattr(B, "recount", lambda w, *a: depth.append(w._jdf.queryExecution().toRdd().toDebugString().count("RDD[")) or plain(w, *a))
    m = B.train_bpe(W.word_table(docs), vocab_size=50)
    assert (m.alphabet, m.merges) == train_brute(texts, 50)
    assert len(depth) > 8 and max(depth) <= depth[0] + 2 * 6  # six more for each time that blocks are made from blocks


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_keyed_order_is_the_same_without_a_loop_in_an_expression(spark):
    rows = spark.range(10).select("id", D.place_of(F.col("id"), 10, 7, F.lit(3)).alias("p"))
    assert [r["p"] for r in rows.orderBy("id").collect()] == [3, 6, 8, 2, 1, 4, 7, 0, 5, 9]
    placed = spark.range(100).withColumn("p", D.place_of(F.col("id"), 100, 7, F.lit(3)))
    assert "lambda" not in _plan(placed)
    nested = D.window_at(D.place_of(F.col("id"), 100, 7, F.lit(3)), 100, 7, F.lit(3))
    assert placed.filter(nested == F.col("id")).filter(D.window_at(F.col("p"), 100, 7, F.lit(3)) == F.col("id")).count() == 100


def test_shuffled_batches_leave_the_hash_behind(spark):
    b = D.shuffle_batches(spark.range(100).withColumnRenamed("id", "win_id"), 8, 2, 0, rows_per_bucket=20)
    moved = _plan(b).split("RepartitionByExpression")[1].splitlines()
    assert moved[0].startswith(" [epoch#") and " AS h#" not in moved[1]
    rows = sorted((r["epoch"], r["win_id"]) for r in b.collect())
    assert rows == [(e, i) for e in (0, 1) for i in range(100)]


def test_stored_rows_are_equal_and_small(spark, tmp_path):
    rng = random.Random(4)
    words = [[rng.randrange(70) for _ in range(rng.randint(1, 6))] for _ in range(300)]
    rows = [(i, [t for _ in range(400) for t in rng.choice(words)] if i % 9 else None) for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, ids array<int>").repartition(4)
    kept = session.stored(df)
    assert kept.schema == df.schema and sorted(map(tuple, kept.collect())) == rows
    held = sum(len(r[1] or ()) for r in rows)
    assert sum(Path(f.removeprefix("file:")).stat().st_size for f in kept.inputFiles()) < 1.5 * held


def test_segments_are_stored_as_columns(spark):
    docs = spark.createDataFrame([(1, "some words here " * 40), (2, "short")], "doc_id long, text string")
    assert any("/stored-" in f for f in SEG.word_segments(docs, size=64).inputFiles())
