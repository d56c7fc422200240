from pyspark.sql import functions as F

from bpe_brute import train_brute
from conftest import SF0001
from corpuslm.operators import bpe as B
from corpuslm.operators import words as W
from corpuslm.plans import views as V


def test_batched_training_equals_one_at_a_time(spark):
    docs = V.documents(spark, SF0001)
    texts = [r["text"] for r in docs.orderBy("doc_id").collect()]
    alpha, merges = train_brute(texts, 200)
    model = B.train_bpe(W.word_table(docs), vocab_size=200)
    assert model.alphabet == alpha
    assert model.merges == merges
    assert model.rounds < len(merges)          # several merges per round
    one = B.train_bpe(W.word_table(docs), vocab_size=80, max_merges_per_round=1)
    assert one.merges == merges[:80 - len(alpha)]


def test_stop_rules(spark):
    df = spark.createDataFrame([(0, "ab ab cd")], "doc_id long, text string")
    m = B.train_bpe(W.word_table(df), vocab_size=100, min_frequency=2)
    assert m.merges == [("a", "b")]             # (c, d) occurs once: below min_frequency
    m = B.train_bpe(W.word_table(df), vocab_size=2)
    assert m.merges == [] and m.alphabet == ["a", "b", "c", "d"]   # alphabet never truncated


def test_encode_goldens():
    assert B.encode_word_py("aaa", {("a", "a"): 0}) == ["aa", "a"]
    ranks = {("a", "b"): 0, ("ab", "c"): 1, ("b", "c"): 2}
    assert B.encode_word_py("abcab", ranks) == ["abc", "ab"]
    assert B.encode_word_py("bcbc", ranks) == ["bc", "bc"]


def test_encode_hand_edited_and_oov(spark):
    # a pair listed twice keeps its last rank; '?' is not in the vocab
    merges = [("b", "c"), ("a", "b"), ("b", "c")]
    vocab = {"a": 0, "b": 1, "c": 2, "bc": 3, "ab": 4}
    docs = spark.createDataFrame([(0, "abc ?x"), (1, "")], "doc_id long, text string")
    out = {r["doc_id"]: r["ids"] for r in B.encode_corpus(docs, merges, vocab).collect()}
    assert out[0] == [4, 2]      # (a,b) rank 1 beats (b,c) rank 2 -> ab, c ; '?' and 'x' dropped
    assert out[1] == []


def test_encode_decode_roundtrip(spark):
    docs = V.documents(spark, SF0001)
    m = B.train_bpe(W.word_table(docs), vocab_size=120)
    enc = B.encode_corpus(docs, m.merges, m.vocab)
    dec = {r["doc_id"]: r["text"] for r in B.decode(enc, m.vocab_df(spark)).collect()}
    words = {r["doc_id"]: "".join(r["w"]) for r in docs.select("doc_id", W.words_of(F.col("text")).alias("w")).collect()}
    assert dec == words


def test_uint16_guard(spark):
    from corpuslm.sources.io import check_uint16
    ok = spark.createDataFrame([(0, [1, 65535])], "doc_id long, ids array<int>")
    assert check_uint16(ok).count() == 1
    bad = spark.createDataFrame([(0, [70000])], "doc_id long, ids array<int>")
    try:
        check_uint16(bad).collect()
        raise AssertionError("expected failure")
    except Exception as e:  # noqa: BLE001
        assert "65535" in str(e)
