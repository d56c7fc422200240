"""Texts in segments: nothing that is cut shows in words, ids, windows or clean lines."""

import random

import pytest
from pyspark.sql import functions as F

from corpuslm.operators import bpe as B
from corpuslm.operators import corpus_clean as CC
from corpuslm.operators import dataset as D
from corpuslm.operators import segments as SEG
from corpuslm.operators import words as W

BITS = ["der", "Rat", "x", "\n", "\n\n", " ", "  ", ".", "...", "ΟΔΟΣ", "ΟΔΟΣ'Σ", "ß", "\U0001d552b", "á", "1_2", "-",
        "<doc id=\"3\"\n t>", "</doc>", "http://a.b/c", "\r", " ", " ", "A long enough line of text here.\n"]


def _docs(spark, seed=2, n=30):
    rng = random.Random(seed)
    rows = [(i, "".join(rng.choice(BITS) for _ in range(rng.randrange(60)))) for i in range(n)]
    rows += [(n, None), (n + 1, ""), (n + 2, "w" * 300), (n + 3, "\n" * 50), (n + 4, "abcdefgh\n"), (n + 5, "abcdefgh")]
    rows[4] = (4, "".join(rng.choice(BITS) + rng.choice(["", " "]) for _ in range(4000)))  # most of all text
    return rows, spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)


@pytest.mark.parametrize("size", [1, 8, 50, 10 ** 6])
def test_segments_are_the_texts(spark, size):
    rows, df = _docs(spark)
    by = {}
    for r in SEG.line_segments(df, size=size).sort("segment").collect():
        by.setdefault(r["doc_id"], []).append(r)
    assert {k: None if rs[0]["text"] is None else "\n".join(r["text"] for r in rs) for k, rs in by.items()} == dict(rows)
    assert all([r["seg"] for r in rs] == list(range(len(rs))) for rs in by.values())
    lower = dict(df.select("doc_id", F.lower("text")).collect())
    parts = {}
    for r in SEG.word_segments(df, size=size).sort("segment").collect():
        parts.setdefault(r["doc_id"], []).append(r["text"])
    assert {k: None if ps[0] is None else "".join(ps) for k, ps in parts.items()} == lower
    if size == 8:
        assert len(parts[4]) > 500 and max(len(p) for p in parts[4]) < 40


@pytest.mark.parametrize("size", [1, 20])
def test_ids_and_windows_equal_the_uncut_ones(spark, size):
    _, df = _docs(spark)
    model = B.train_from_text(df, vocab_size=80)
    cut = B.encode_corpus(SEG.word_segments(df, size=size), model.merges, model.vocab, key="segment").checkpoint()
    whole = B.encode_corpus(df, model.merges, model.vocab).checkpoint()
    assert sorted(D.token_stream(cut, "segment").collect()) == sorted(D.token_stream(whole).collect())
    a, b = (D.windows(D.token_runs(x, k), 16, stride=5) for x, k in ((cut, "segment"), (whole, "doc_id")))
    assert sorted(a.collect()) == sorted(b.collect())
    freq = lambda d, k: sorted(W.word_freq(W.pretokenize(d, k), k).select("word", "freq").collect())
    assert freq(SEG.word_segments(df, size=size), "segment") == freq(df, "doc_id")


@pytest.mark.parametrize("size", [1, 50])
def test_clean_lines_equal_the_uncut_ones(spark, size):
    _, df = _docs(spark, 6)
    lines = lambda d, k: sorted(CC.corpus_lines(CC.clean_joined(d, k).checkpoint(), k).collect())
    assert lines(SEG.line_segments(df, size=size), "segment") == lines(df, "doc_id")


def test_a_huge_text_is_spread_over_tasks(spark):
    df = spark.createDataFrame([(1, "some words " * 60_000), (2, "short"), (3, "one more")], "doc_id bigint, text string")
    # without the merging of small partitions, which a text of this size would not need to be cut at all
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        cut = SEG.word_segments(df, size=1000).filter("doc_id = 1")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    sizes = [r["n"] for r in cut.groupBy(F.spark_partition_id()).agg(F.sum(F.length("text")).alias("n")).collect()]
    assert len(sizes) >= 4 and max(sizes) < 660_000 / 3
    empty = SEG.word_segments(df.limit(0), size=5)
    assert empty.collect() == [] and empty.columns == ["doc_id", "seg", "segment", "text"]
    with pytest.raises(ValueError, match="too wide"):
        SEG.word_segments(spark.createDataFrame([(2 ** 61, "a b c d")], "doc_id bigint, text string"), size=1)
