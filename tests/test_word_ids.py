"""Words encoded together give the ids that the loop over each word gives."""

import random

import pyarrow as pa
import pytest
from corpuslm.operators import bpe as B
from corpuslm.operators.pair_deltas import SHORT
from corpuslm.operators.word_ids import WordIds

TRAINED = [("a", "b"), ("b", "c"), ("ab", "ab"), ("c", "c"), ("abab", "a"), ("é", "𝛼"), ("ab", "c"), ("cc", "cc")]
ODD = [("ab", "c"), ("a", "bc"), ("b", "c"), ("a", "b"), ("abc", "abc"), ("b", "c"), ("", "a"), ("zz", "z"), ("c", "a"), ("a", "a"), ("aa", "a")]


def _encoded(words, merges, vocab, longest=0):
    ranks = {m: i for i, m in enumerate(merges)}
    seen = []

    def one(word):
        seen.append(word)
        return B._ids(B.encode_word_py(word, ranks), vocab)

    size, ids = WordIds(merges, vocab, one)(pa.array(words, pa.string()))
    assert all(len(w) > SHORT for w in seen)  # no loop over the words of usual length
    ends = size.cumsum()
    return [ids[e - n: e].tolist() for e, n in zip(ends, size, strict=True)], [B._ids(B.encode_word_py(w, ranks), vocab) for w in words]


@pytest.mark.parametrize("merges", [TRAINED, ODD, []])
def test_words_encoded_together(merges):
    rng = random.Random(4)
    words = ["".join(rng.choice("abcé𝛼z") for _ in range(rng.randint(1, 45))) for _ in range(400)] + ["aaaa", "abcabc", "ab" * 300, "a", "zzz"]
    whole = {t: i for i, t in enumerate(dict.fromkeys([*"abcé𝛼", *(left + right for left, right in merges)]))}
    some = {t: i + 7 for i, t in enumerate(t for t in whole if t not in ("é", "abab", "bc", "abc"))}
    for vocab in (whole, some, {}):
        got, want = _encoded(words, merges, vocab)
        assert got == want


def test_no_words():
    assert _encoded([], TRAINED, {"a": 0}) == ([], [])


def test_tokens_are_numbered_without_a_sort(monkeypatch):
    import numpy as np
    from corpuslm.operators import ngram as N
    rng = np.random.default_rng(3)
    few, far, below = rng.integers(0, 50, 4000).astype(np.int32), rng.integers(0, 1 << 40, 4000), rng.integers(-3, 3, 200)
    want = [np.unique(x, return_inverse=True, return_counts=True)[1:] for x in (few, far, below, few[:0])]
    for x, w in zip((few, far, below, few[:0]), want, strict=True):
        assert all(np.array_equal(a, b) for a, b in zip(N._numbered(x), w, strict=True))
    monkeypatch.delattr(np, "unique")
    assert np.array_equal(N._numbered(few)[1], want[0][1])
    ids = np.arange(200, dtype=np.int32) % 9
    assert len(list(N._count_levels([(ids, np.array([200])), (ids[:1], np.array([1]))], 2))) == 2
