"""Blocks of words give what the loop over words gives, before and after merges are applied to them."""

import random

import pyarrow as pa
import pytest
from bpe_brute import train_brute
from corpuslm.operators import bpe as B
from corpuslm.operators import pair_deltas as P
from corpuslm.operators import word_blocks as WB
from corpuslm.operators import words as W


def _words():
    rng = random.Random(9)
    return [("".join(rng.choice("abcé𝛼") for _ in range(rng.randint(2, 50))), rng.randint(1, 9), i * 3) for i in range(60)] + [("aaaaaaa", 4, 500)]


def _packed(words):
    b = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*words, strict=True)], names=["word", "freq", "wrank"])
    return WB._block([b])


class _Plan:
    """Runs an Arrow node in place."""

    def mapInArrow(self, task, _):
        return list(task(iter(self.rows)))


@pytest.mark.parametrize("applied", [0, 1, 3])
def test_changes_of_blocks_are_those_of_the_words(applied):
    words, merges = _words(), [("a", "a"), ("b", "c"), ("aa", "bc")]
    batch = [("aabc", "é"), ("c", "c"), ("aa", "aa"), ("𝛼", "𝛼"), ("aaaa", "aa")]
    asked, triples = {("a", "b"), ("aa", "é"), ("b", "b")}, {("a", "b", "b"), ("b", "b", "a"), ("aa", "é", "𝛼"), ("b", "b", "b"), ("zz", "a", "b")}
    want, overlaps = P.changes(words, merges, batch, asked, triples)
    plan = _Plan()
    plan.rows = [_packed(words[:30]), _packed(words[30:])]
    if applied:
        plan.rows = WB.advance(plan, merges[:applied])
    rows = [r for b in WB.changes_of_blocks(iter(plan.rows), merges, batch, asked, triples, P.CHANGE) for r in b.to_pylist()]
    got, tri = {}, {}
    for r in rows:
        if r["step"] == -2:
            tri[r["left"], r["mid"], r["right"]] = tri.get((r["left"], r["mid"], r["right"]), 0) + r["n"]
        elif r["step"] >= -1:
            c = got.setdefault((r["step"], r["left"], r["right"]), [0, None, None, None])
            c[0] += r["n"]
            for k, name in ((1, "lost"), (2, "gained"), (3, "seen")):
                c[k] = c[k] if r[name] is None else P._least(c[k], r[name])
    assert got == want and tri == overlaps and len(want) > 20 and overlaps
    pairs = {}
    for b in WB.pairs_of_blocks(iter(plan.rows), merges):
        for r in b.to_pylist():
            c = pairs.setdefault((r["left"], r["right"]), [0, None])
            c[0], c[1] = c[0] + r["n"], P._least(c[1], r["first"])
    count, ranks = {}, {p: i for i, p in enumerate(merges)}
    for word, freq, wrank in words:
        for at, left, right in P.placed_pairs(P.cut_word(word, ranks)):
            c = count.setdefault((left, right), [0, None])
            c[0], c[1] = c[0] + freq, P._least(c[1], (wrank << P.POS_BITS) + at)
    assert pairs == count


def test_training_with_blocks_made_anew(spark, monkeypatch):
    rng = random.Random(8)
    texts = [" ".join("".join(rng.choice("abcd") for _ in range(rng.randint(1, 9))) for _ in range(60)) for _ in range(6)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    made = []
    plain = B.advance
    monkeypatch.setattr(B, "APPLY_AFTER", 5)
    monkeypatch.setattr(B, "advance", lambda b, m: made.append(len(m)) or plain(b, m))
    m = B.train_bpe(W.word_table(docs), vocab_size=50)
    assert (m.alphabet, m.merges) == train_brute(texts, 50) and len(made) > 2
