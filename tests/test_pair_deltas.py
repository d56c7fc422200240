"""The delta trainer against one merge at a time: bounded pair tables, guessed
batches, late first places."""

import random

import pytest
from bpe_brute import train_brute
from corpuslm.operators import bpe as B
from corpuslm.operators import pair_deltas as P
from corpuslm.operators import words as W


def _texts():
    rng = random.Random(5)
    roots = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(2, 6))) for _ in range(30)]
    return [" ".join(rng.choice(roots) + rng.choice(roots) * rng.randint(0, 2) for _ in range(40)) for _ in range(12)]


@pytest.mark.parametrize("held", [1_000_000, 12])
def test_delta_training_equals_one_at_a_time(spark, held):
    texts = _texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    alpha, merges = train_brute(texts, 120)
    m = B.train_bpe(W.word_table(docs), vocab_size=120, held_pairs=held)
    assert (m.alphabet, m.merges) == (alpha, merges)
    assert len(m.rows_touched) >= m.rounds > 0 and m.rounds < len(merges)


def test_changes_give_what_a_recount_gives():
    rng = random.Random(6)
    words = [("".join(rng.choice("ab") for _ in range(rng.randint(2, 60))), rng.randint(1, 9), i) for i in range(80)]
    merges, batch = [("a", "a"), ("b", "a")], [("aa", "ba"), ("b", "b"), ("aa", "aa")]

    def counted(upto):
        ranks = {p: i for i, p in enumerate(upto)}
        out = {}
        for w, n, i in words:
            for at, left, right in P.placed_pairs(P.cut_word(w, ranks)):
                c = out.setdefault((left, right), [0, None])
                c[0] += n
                c[1] = P._least(c[1], (i << P.POS_BITS) + at)
        return out

    table = P.PairTable()
    start = counted(merges)
    table.n = {p: c[0] for p, c in start.items()}
    table.first = {p: c[1] for p, c in start.items()}
    table._heap()
    asked = set(counted(merges + batch))
    found, triples = P.changes(words, merges, batch, asked, {("aaba", "aaba", "aaba")})
    for step, (left, right) in enumerate(batch):
        table.apply([{"left": k[1], "right": k[2], "n": c[0], "lost": c[1], "gained": c[2], "seen": c[3]}
                     for k, c in found.items() if k[0] == step], {left + right})
        want = counted(merges + batch[: step + 1])
        assert table.n == {p: c[0] for p, c in want.items()}
        assert all(table.first[p] == want[p][1] for p in want if p not in table.late)
        assert all(table.first[p] <= want[p][1] for p in want)
    table.apply([{"left": k[1], "right": k[2], "n": c[0], "lost": c[1], "gained": c[2], "seen": c[3]}
                 for k, c in found.items() if k[0] == -1], set())
    assert not table.late and table.first == {p: c[1] for p, c in want.items()}
    ranks = {p: i for i, p in enumerate(merges + batch)}
    assert triples.get(("aaba",) * 3, 0) == sum(n * sum(t == ("aaba",) * 3 for t in zip(c, c[1:], c[2:], strict=False))
                                               for w, n, _ in words for c in [P.cut_word(w, ranks)])
