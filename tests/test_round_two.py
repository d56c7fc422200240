"""Inputs of other shapes: folder tables, many buckets, odd strides, NaN."""

import random


def test_stream_reads_a_folder_of_part_files(spark, tmp_path):
    from corpuslm.streaming import stream as STR
    spark.range(40).repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    out = STR.run_available(STR.read_table_stream(spark, str(tmp_path), "documents"), "t_folder")
    assert spark.read.parquet(out).count() == 40


def test_windows_of_any_stride_and_block(spark):
    from corpuslm.operators import dataset as D
    rng = random.Random(2)
    for _ in range(4):
        n, L, stride, block = rng.randint(20, 60), rng.randint(3, 12), rng.randint(1, 9), rng.randint(1, 20)
        stream = spark.range(n).selectExpr("id AS gpos", "cast(id AS int) AS id")
        got = sorted((r["win_id"], r["x"], r["y"]) for r in D.windows(stream, L, stride, block).collect())
        want = [(k, list(range(i, i + L)), list(range(i + 1, i + L + 1))) for k, i in enumerate(range(0, n - L, stride))]
        assert got == want, (n, L, stride, block)


def test_windows_of_runs_equal_windows_of_tokens(spark):
    from corpuslm.operators import dataset as D
    from corpuslm.operators import ngram as N
    rng = random.Random(6)
    for _ in range(4):
        docs = [(i, list(range(100 * i, 100 * i + rng.choice([0, 0, 1, 3, 40])))) for i in range(9)]
        L, stride, block = rng.randint(3, 12), rng.randint(1, 9), rng.randint(1, 20)
        runs = D.token_runs(spark.createDataFrame(docs, "doc_id long, ids array<int>")).checkpoint()
        ids = [x for _, d in docs for x in d]
        got = sorted((r["win_id"], r["x"], r["y"]) for r in D.windows(runs, L, stride, block).collect())
        starts = range(0, max(0, len(ids) - L), stride)
        assert got == [(k, ids[i:i + L], ids[i + 1:i + L + 1]) for k, i in enumerate(starts)], (docs, L, stride, block)
        assert D.count_tokens(runs) == len(ids)
        pairs = sorted((r["ctx"][0], r["next"]) for r in N.ngram_pairs(runs, 2, block).collect())
        assert pairs == sorted(zip(ids, ids[1:]))


def test_extracted_text_is_kept_whole(spark, tmp_path):
    from corpuslm.sources import io as IO
    (tmp_path / "wiki_0").write_text('stray one\n<doc revid="77" id="5" url="u" title="t">\nbody\n</doc>\n'
                                     '<doc id="6" url="v" title="w">\nnever closed\n<doc id="x">\r\nlast')
    got = sorted((r["text"], r["doc_id"]) for r in IO.read_extracted(spark, str(tmp_path)).collect())
    assert got == [('<doc id="6" url="v" title="w">\nnever closed\n</doc>', 6), ('<doc id="x">\nlast</doc>', None),
                   ('<doc revid="77" id="5" url="u" title="t">\nbody\n</doc>', 5), ("stray one\n", None)]


def test_log_has_a_header_and_grows(spark, tmp_path):
    from corpuslm.sources import io as IO
    for k in (1, 2):
        IO.write_log(spark.createDataFrame([(9, k, f"{k},0.5,0.25,0.00030000,1.50,{k}.0")], "run_id long, step long, line string"),
                     str(tmp_path / "log"))
    files = list((tmp_path / "log").glob("run_id=9/*.csv"))
    assert len(files) == 2 and all(f.read_text().startswith("step,train_loss,val_loss,lr,time,perplexity\n") for f in files)
    assert sorted(map(tuple, IO.read_log(spark, str(tmp_path / "log")).collect())) == [
        (k, 0.5, 0.25, 0.0003, 1.5, float(k), 9) for k in (1, 2)]


def test_split_and_encode_shuffle_no_text(spark):
    from corpuslm.operators import bpe as B
    from corpuslm.operators import split as S
    docs = spark.createDataFrame([(i, "some text\n" * i) for i in range(9)], "doc_id long, text string")
    for out in (S.split_corpus(docs), B.encode_corpus(docs, [("s", "o")], {"so": 0, "m": 1})):
        assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()


def test_many_shuffle_buckets(spark):
    from corpuslm.operators import dataset as D
    got = D.shuffle_batches(spark.range(50_000).withColumnRenamed("id", "win_id"), 32, 1, 0, rows_per_bucket=1)
    assert got.select("win_id").distinct().count() == 50_000


def test_nan_is_no_best_evaluation(spark):
    from corpuslm.operators import metrics as M
    nan, inf = float("nan"), float("inf")
    ev = spark.createDataFrame([(1, 1, nan), (1, 2, inf), (1, 3, 2.0), (2, 1, nan)], "run_id int, step int, val_loss double")
    got = {(r["run_id"], r["step"]): r["is_best"] for r in M.mark_best(ev).collect()}
    assert got == {(1, 1): False, (1, 2): False, (1, 3): True, (2, 1): False}
    best = {r["run_id"]: r["best_step"] for r in M.best_checkpoint(ev).collect()}
    assert best == {1: 3, 2: None}


def test_a_long_word_is_encoded_in_n_log_n(spark):
    import time

    from corpuslm.operators.bpe import encode_word_py
    t = time.time()
    assert encode_word_py("ab" * 10_000, {("a", "b"): 0, ("ab", "ab"): 1}) == ["abab"] * 5_000
    assert time.time() - t < 1
    ranks = {("a", "b"): 0, ("ab", "c"): 1, ("b", "c"): 2}
    assert encode_word_py("abcab", ranks) == ["abc", "ab"] and encode_word_py("bcbc", ranks) == ["bc", "bc"]
