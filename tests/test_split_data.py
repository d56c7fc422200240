import random

from pyspark.sql import functions as F

from corpuslm.operators import dataset as D
from corpuslm.operators import split as S
from spec_clean import spec_split


def _split_texts(spark, docs, ratio=0.9):
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    pieces = S.split_corpus(df, ratio).collect()
    out = {}
    for s in ("train", "val"):
        ps = sorted((r["doc_id"], r["text"]) for r in pieces if r["split"] == s)
        out[s] = "\n".join(t for _, t in ps) if ps else ""
    return out["train"], out["val"]


def test_split_matches_string_cut(spark):
    rnd = random.Random(7)
    for _ in range(6):
        docs = ["".join(rnd.choice("ab\n") for _ in range(rnd.randint(0, 12))) for _ in range(rnd.randint(1, 6))]
        assert _split_texts(spark, docs) == spec_split("\n".join(docs)), docs


def test_split_without_newline(spark):
    assert _split_texts(spark, ["abcdef"]) == ("abcde", "f")


def test_windows_stride1_and_count(spark):
    toks = [(i, (i * 7) % 11) for i in range(50)]
    stream = spark.createDataFrame(toks, "gpos long, id int")
    L = 8
    w = {r["win_id"]: (r["x"], r["y"]) for r in D.windows(stream, L, stride=1, block=16).collect()}
    ids = [t for _, t in toks]
    assert len(w) == D.window_count(len(ids), L) == 42
    for i in range(42):
        assert w[i] == (ids[i:i + L], ids[i + 1:i + L + 1])
    assert D.windows(stream.limit(5), L).count() == 0


def test_shuffle_batches_cover_each_window_once(spark):
    wins = spark.range(100).select(F.col("id").alias("win_id"))
    b = D.shuffle_batches(wins, batch_size=32, epochs=2, seed=3, rows_per_bucket=7).collect()
    for e in (0, 1):
        rows = [r for r in b if r["epoch"] == e]
        assert sorted(r["win_id"] for r in rows) == list(range(100))
        sizes = {}
        for r in rows:
            sizes[r["batch"]] = sizes.get(r["batch"], 0) + 1
        assert sorted(sizes.values()) == [4, 32, 32, 32]
    order = lambda e: [r["win_id"] for r in sorted((r for r in b if r["epoch"] == e), key=lambda r: r["batch"])]
    assert order(0) != order(1)


def test_lr_schedule(spark):
    import math
    m = D.training_manifest(10, spark, max_steps=1000, warmup=100).collect()
    for r in m[::97]:
        s = r["step"]
        if s < 100:
            exp = 3e-4 * (s + 1) / 100
        else:
            exp = 3e-5 + 0.5 * (1 + math.cos(math.pi * (s - 100) / 900)) * (3e-4 - 3e-5)
        assert abs(r["lr"] - exp) < 1e-12
        assert r["epoch"] == s // 10 and r["batch"] == s % 10


def test_stream_paths_agree(spark):
    from conftest import SF0001
    from corpuslm.operators import bpe as B
    from corpuslm.operators import words as W
    from corpuslm.plans import views as V
    docs = V.documents(spark, SF0001)
    m = B.train_bpe(W.word_table(docs), vocab_size=90)
    a = D.token_stream(B.encode_corpus(docs, m.merges, m.vocab))
    b = D.token_stream_from_occurrences(B.encode_occurrences(docs, m.merges, m.vocab))
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
