"""Corpus scope against the line machine on the joined text; equal-row buckets;
streams of several micro-batches; decoding without a shuffle."""

import datetime
import random

from spec_clean import spec_clean

LINES = ["", "", "  ", "a line that is long enough", "another line, long enough", "short", "https://example.org/x",
         "  a line that is long enough ", "\x07", "café  with  spaces here", "<doc id=\"1\">", "</doc>"]


def _joined(spark, docs, **kw):
    from corpuslm.operators.corpus_clean import clean_joined
    rows = clean_joined(spark.createDataFrame(docs, "doc_id long, text string"), **kw).collect()
    return "\n".join(r["text"] for r in sorted(rows))


def test_corpus_scope_equals_cleaning_the_joined_text(spark):
    rng = random.Random(4)
    for case in range(6):
        docs = [(7 * i, "\n".join(rng.choice(LINES) for _ in range(rng.randint(1, 5)))) for i in range(rng.randint(1, 12))]
        want = spec_clean("\n".join(t for _, t in docs), lowercase=case == 5)
        assert _joined(spark, docs, lowercase=case == 5) == want, docs


TAGS = ["<doc", "<doc id=3", "a tag <doc\tx=1", "that ends here> and goes on", "plain text without any mark", "x > y, a long line",
        "</d", "oc> after the tag, long", "<do", "c> no tag, long enough", "<doc><doc y", ">", "</doc>", "<doc z>whole tag, long line"]


def test_tags_over_several_documents(spark):
    rng = random.Random(12)
    for _ in range(4):
        docs = [(3 * i - 8, "\n".join(rng.choice(TAGS) for _ in range(rng.randint(1, 3)))) for i in range(rng.randint(1, 14))]
        docs.insert(len(docs) // 2, (docs[-1][0] + 1, None))
        texts = [t for _, t in docs if t is not None]
        assert _joined(spark, docs) == spec_clean("\n".join(texts)), docs
    # a tag over a third of all documents is one join of short pieces
    docs = [(i, "before the tag it is <doc " if i == 10 else "after> the tag, long" if i == 40 else f"document number {i}") for i in range(90)]
    assert _joined(spark, docs) == spec_clean("\n".join(t for _, t in docs))


def test_corpus_scope_of_blank_null_and_no_documents(spark):
    assert _joined(spark, [(1, ""), (2, None), (3, " \n ")]) == ""
    assert _joined(spark, []) == ""
    assert _joined(spark, [(1, "same line, twice"), (2, "\n"), (3, None), (4, "same line, twice\n\nend of the text")]) == \
        "same line, twice\n\nend of the text"


def test_corpus_lines_are_numbered_through(spark):
    from corpuslm.operators.corpus_clean import corpus_lines
    docs = spark.createDataFrame([(5, "a\nb"), (9, "c"), (2, "x\n\ny")], "doc_id long, text string")
    assert [tuple(r) for r in sorted(corpus_lines(docs).collect())] == list(enumerate(["x", "", "y", "a", "b", "c"]))


def test_one_outlying_key_does_not_fill_a_bucket(spark):
    from corpuslm.operators.order import bucket_of, prefix_sum
    keys = [*range(2000), 2 ** 61]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    sizes = [r["count"] for r in df.groupBy(bucket_of(df, "k").alias("b")).count().collect()]
    assert max(sizes) <= 2 * len(keys) / len(sizes)
    got = {r["k"]: r["s"] for r in prefix_sum(df.selectExpr("k", "1 AS one"), "k", "one", "s").collect()}
    assert got == {k: i for i, k in enumerate(keys)}


def test_more_buckets_than_first_borders(spark):
    from corpuslm.operators.order import bucket_of, last_before, prefix_sum
    df = spark.range(0, 30_000, 3).withColumnRenamed("id", "k").selectExpr("k", "if(k % 5 = 0, k, null) AS v")
    rows = df.select("k", bucket_of(df, "k", rows_per_bucket=4).alias("b")).orderBy("k").collect()
    assert all(x["b"] <= y["b"] for x, y in zip(rows, rows[1:])) and rows[-1]["b"] > 1500
    got = prefix_sum(df.selectExpr("k", "1 AS one"), "k", "one", "s", rows_per_bucket=4)
    assert got.filter("s * 3 != k").isEmpty() and got.count() == 10_000
    seen = last_before(df, "k", "v", "p", rows_per_bucket=4)
    assert seen.filter("k > 0 and p != (k - 1) div 15 * 15 or k = 0 and p is not null or k > 0 and p is null").isEmpty()


def test_decode_shuffles_no_ids(spark):
    from corpuslm.operators import bpe as B
    vocab = spark.createDataFrame([("a", 0), ("bc", 2)], "token string, id bigint")
    tokens = spark.createDataFrame([(1, [0, 2, 1, 9, -1]), (2, []), (3, None)], "doc_id long, ids array<int>")
    out = B.decode(tokens, vocab)
    assert {r["doc_id"]: r["text"] for r in out.collect()} == {1: "abc", 2: "", 3: ""}
    assert "hashpartitioning(doc_id" not in out._jdf.queryExecution().executedPlan().toString()


def test_characters_without_a_token(spark):
    from corpuslm.operators import bpe as B
    docs = spark.createDataFrame([(1, "Abc, zü"), (2, None), (3, "zz")], "doc_id long, text string")
    got = {r["token"]: r["n"] for r in B.oov_report(docs, {"a": 0, "b": 1, "ab": 2, ",": 3}).collect()}
    assert got == {"c": 1, "z": 3, "ü": 1}


def _words(spark, path, *texts):
    (spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
     .coalesce(1).write.mode("append").parquet(str(path)))


def test_state_over_several_batches_and_a_restart(spark, tmp_path):
    from corpuslm.streaming import stream as STR
    table, root = tmp_path / "documents.parquet", str(tmp_path / "root")

    def run():
        docs = STR.read_table_stream(spark, str(tmp_path), "documents")
        out = STR.run_available(STR.word_count_stream(docs), "w", "update", STR.upsert_sink(["word"]), root=root)
        return {r["word"]: r["freq"] for r in STR.latest(spark, out, ["word"]).collect()}
    _words(spark, table, "a b")
    _words(spark, table, "b c")
    assert run() == {"a": 1, "b": 2, "c": 1}
    _words(spark, table, "c c d")  # only this file is new to the restarted query
    assert run() == {"a": 1, "b": 2, "c": 3, "d": 1}
    assert len(list((tmp_path / "root" / "out").glob("batch=*"))) >= 3


def test_a_replayed_batch_overwrites_itself(spark, tmp_path):
    from corpuslm.streaming import stream as STR
    docs = spark.createDataFrame([(1, "ab"), (2, "b")], "doc_id long, text string")
    sink = STR.encode_stream_sink([("a", "b")], {"a": 0, "b": 1, "ab": 2})
    for _ in range(2):
        sink(docs, 3, str(tmp_path / "out"))
    assert sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).select("doc_id", "ids").collect()) == [
        (1, [2]), (2, [1])]


def test_rows_later_than_the_watermark_are_dropped(spark, tmp_path):
    from corpuslm.streaming import stream as STR
    root = str(tmp_path / "root")

    def run(hour):
        ts = datetime.datetime(2024, 1, 1, hour)
        (spark.createDataFrame([(1, ts, 100.0)], "user_id long, ts timestamp, value double")
         .coalesce(1).write.mode("append").parquet(str(tmp_path / "events.parquet")))
        ev = STR.read_table_stream(spark, str(tmp_path), "events")
        out = STR.run_available(STR.run_metrics_stream(ev), "m", "update", STR.upsert_sink([]), root=root)
        return STR.latest(spark, out, ["window_start", "run_id"]).count()
    assert run(10) == 1
    assert run(15) == 2
    assert run(9) == 2  # the window of 9 to 10 h ended before the watermark
