"""Words, n-grams and windows are counted and cut by slices in Arrow nodes; the results are those of plain loops."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpuslm.operators import bpe as B
from corpuslm.operators import dataset as D
from corpuslm.operators import ngram as N
from corpuslm.operators import words as W
from corpuslm.operators.pair_deltas import cut_word, recount

TEXTS = [(3, "b a b c"), (1, "c c d"), (1, "e d"), (None, "z b"), (None, "q, b"), (7, None), (8, ""), (2, "a.b|c* a.b")]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_words_of_repeated_and_null_keys_without_a_row_per_word(spark):
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string")
    got, want = W.word_table(docs), W.word_freq(W.pretokenize(docs))
    assert "Generate" not in plan(got)
    assert sorted(got.collect()) == sorted(want.collect())


def test_slices_hold_few_words_and_lose_none():
    lists = pa.array([["a"] * n if n is not None else None for n in (3, None, 0, 9, 1, 1, 4, 0)])
    b = pa.RecordBatch.from_arrays([pa.array(range(8)), lists], names=["k", "w"])
    parts = [(p.column(0).to_pylist(), list(n)) for p, n in W.word_slices(b, 4)]
    assert [k for p, _ in parts for k in p] == list(range(8))
    assert all(sum(n) <= 4 or len(n) == 1 for _, n in parts)
    assert [len(p.column(1).flatten()) for p, _ in W.word_slices(b, 4)] == [sum(n) for _, n in parts]


def test_encoding_by_slices(spark, monkeypatch):
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string")
    merges = [("a", "b"), ("b", "c")]
    vocab = {c: i for i, c in enumerate(["a", "b", "c", "d", "e", ".", "|", "ab", "bc"])}
    got = B.encode_corpus(docs, merges, vocab).collect()
    want = [(r["doc_id"], B._ids([t for w in (r["w"] or ()) for t in B.encode_word_py(w, {m: i for i, m in enumerate(merges)})], vocab))
            for r in docs.select("doc_id", W.words_of(F.col("text")).alias("w")).collect()]
    assert sorted(map(str, got)) == sorted(f"Row(doc_id={k}, ids={ids})" for k, ids in want)


def test_a_pair_listed_twice_keeps_its_last_rank():
    ranks = {("a", "b"): 9, ("b", "c"): 2, ("a", "bc"): 5}
    assert cut_word("abcab", ranks) == ["abc", "ab"]
    assert cut_word("abcab" * 20, ranks) == ["abc", "ab"] * 20  # the heap of long words


@pytest.mark.parametrize("n", [1, 2, 3, 4])
def test_ngrams_by_blocks(spark, n, monkeypatch):
    ids = [(i * i + i // 3) % 7 * (1 if i % 5 else 100_000) for i in range(61)]
    runs = spark.createDataFrame([(0, ids[:20]), (20, ids[20:21]), (21, []), (21, ids[21:])], "start long, ids array<int>")
    monkeypatch.setattr(N, "BLOCKS_AT_ONCE", 2)
    monkeypatch.setattr(N, "blocks", lambda s, L: D.blocks(s, L, 8))
    got = N.fit_ngram(runs, n)
    assert "Generate" not in plan(got).split("MapInArrow")[0]
    want = {}
    for i in range(len(ids)):
        for m in range(n):
            if i + m < len(ids):
                k = (tuple(ids[i: i + m]), ids[i + m])
                want[k] = want.get(k, 0) + 1
    assert {(tuple(r["ctx"]), r["next"]): r["c"] for r in got.collect()} == want


def test_windows_leave_one_arrow_node(spark):
    runs = spark.createDataFrame([(0, list(range(30))), (30, list(range(30, 50)))], "start long, ids array<int>")
    w = D.windows(runs, 4, stride=3, block=8)
    assert "MapInArrow" in plan(w)
    assert sorted(w.collect()) == [(i // 3, list(range(i, i + 4)), list(range(i + 1, i + 5))) for i in range(0, 46, 3)]


def test_words_of_a_round_are_found_in_one_pass(spark):
    words = spark.createDataFrame([("a.b", 2, 0), ("axb", 3, 1), ("a|*", 5, 2)], "word string, freq long, wrank long")
    found = recount(words, [], [("a", "."), ("|", "*")], set(), set())
    assert "exists(" not in plan(found)
    rows = found.collect()
    assert [r["n"] for r in rows if r["step"] == -3] == [2]
    assert {(r["left"], r["right"]): r["n"] for r in rows if r["step"] == 1} == {("a", "|"): -5, ("|", "*"): -5, ("a", "|*"): 5}


def test_loss_sums_up_only_the_contexts_of_its_targets(spark):
    counts = spark.createDataFrame([([], 1, 3), ([], 2, 1), ([1], 2, 2), ([9], 1, 5)], "ctx array<int>, next int, c long")
    targets = spark.createDataFrame([([1], 2), ([8], 1)], "ctx array<int>, next int")
    loss = N.cross_entropy(counts, targets, 3, 1.0)
    assert "LeftSemi" in loss._jdf.queryExecution().optimizedPlan().toString()
    import math
    assert loss.first()["loss"] == pytest.approx(-(math.log(3 / 5) + math.log(4 / 7)) / 2)


def test_windows_of_a_stream_with_empty_places(spark):
    runs = spark.createDataFrame([(0, [1, 2, 3]), (0, [1, 2, 3])], "start long, ids array<int>")
    got = sorted(D.windows(runs.limit(1).unionByName(spark.createDataFrame([(8, [7])], "start long, ids array<int>")), 2, 1, 8).collect())
    assert got == [(0, [1, 2], [2, 3]), (1, [2, 3], [3, 7])]
    got = sorted(D.windows(spark.createDataFrame([(0, [1, 2]), (1, [3]), (9, [4, 5, 6])], "start long, ids array<int>"), 2, 2, 4).collect())
    assert got == [(0, [1, 2], [2, 3]), (1, [3], [])]
