"""Cleaning looks at distinct characters and trims without a pattern; rows that go to Python are small."""

import sys
import unicodedata

from pyspark.sql import functions as F

from corpuslm.functions import text as X
from corpuslm.operators import bpe as B
from corpuslm.operators import words as W


def spec(text):
    return "".join(c for c in unicodedata.normalize("NFKD", text) if c in "\n\t" or unicodedata.category(c)[0] != "C")


def test_controls_go_by_distinct_characters():
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, sys.maxunicode + 1)]))
    few = "q­ué ﬁ\u0007x\n\t​ z"
    for text in (few, every, "", "é", "plain\u0000\u007f\n"):
        assert X.nfkd_strip_control_py(text) == spec(text)
    seen = []
    plain, X._is_control = X._is_control, lambda c: seen.append(c) or plain(c)
    try:
        X.nfkd_strip_control_py(few * 1000)
    finally:
        X._is_control = plain
    assert len(seen) == len(set(spec(few))) + 3  # each character once, however long the text


def test_strip_takes_the_white_space_of_python_without_a_pattern(spark):
    texts = [a + t + b for a in ("", " \t", "  \n", "\x1c\x85") for b in ("", "　", "\n\n ") for t in ("", "a", "é  b​")]
    df = spark.createDataFrame([(t,) for t in [*texts, None]], "t string").select("t", X.strip_ws(F.col("t")).alias("s"))
    assert "regexp" not in df._jdf.queryExecution().executedPlan().toString()
    assert all(r["s"] == (None if r["t"] is None else r["t"].strip()) for r in df.collect())


def test_dear_rounds_guess_few_merges_and_learn_the_same(spark, monkeypatch):
    texts = [(i, " ".join(f"the{i % 7}ther on{i % 5}tion re{i % 3}den inner" for _ in range(3))) for i in range(20)]
    freqs = W.word_table(spark.createDataFrame(texts, "doc_id long, text string")).cache()
    sizes = []
    plain = B.recount
    monkeypatch.setattr(B, "recount", lambda w, m, batch, *a: sizes.append(len(batch)) or plain(w, m, batch, *a))
    want = B.train_bpe(freqs, vocab_size=45)
    first, sizes[:] = list(sizes), []
    monkeypatch.setattr(B, "CHEAP_ROUND", 0)
    monkeypatch.setattr(B, "FEW_MERGES", 2)
    got = B.train_bpe(freqs, vocab_size=45)
    assert (got.merges, got.stop_reason) == (want.merges, want.stop_reason) and len(want.merges) > 10
    assert all(b <= max(2, 2 * a) for a, b in zip(sizes, sizes[1:])) and len(first) <= len(sizes)
