"""Ids of many words at once: all words of a slice are joined step by step in passes of numpy
instead of a Python loop over each.

The characters of the words lie one after the other.  In a step every word that still holds a
pair with a rank joins the leftmost pair of its lowest rank, as ``bpe.encode_word_py`` does, so
there are at most as many steps as a word has characters.  Longer words than ``SHORT`` are left
to that function.  A character's token is its code point, joined texts are numbered beyond those.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from corpuslm.operators.pair_deltas import SHORT
from corpuslm.operators.word_blocks import JOINED

NONE = np.iinfo(np.int32).max  # the rank of a pair that no merge has


class WordIds:
    """Encodes words by ranked merges; ``one`` gives the ids of a long word."""

    def __init__(self, merges: list[tuple[str, str]], vocab: dict[str, int], one: Callable[[str], list[int]]):
        numbers: dict[str, int] = {}
        for left, right in merges:
            numbers.setdefault(left + right, JOINED + len(numbers))

        def number(text: str) -> int:
            return ord(text) if len(text) == 1 else numbers.get(text, -1) if text else -1

        ranks = {}  # a pair listed twice keeps its last rank
        for rank, (left, right) in enumerate(merges):
            a, b = number(left), number(right)
            if a >= 0 and b >= 0:
                ranks[(a << 32) + b] = rank
        self.keys = np.array([*sorted(ranks), np.iinfo(np.int64).max], np.int64)
        self.ranks = np.array([ranks.get(k, NONE) for k in self.keys.tolist()], np.int32)
        self.joined = np.array([number(left + right) for left, right in merges], np.int32)
        self.ids = np.full(JOINED + len(numbers), -1, np.int32)
        for text, n in numbers.items():  # an unknown one gives its first character's id, if known
            self.ids[n] = vocab[text] if text in vocab else vocab.get(text[:1], -1)
        for text, i in vocab.items():
            if len(text) == 1:
                self.ids[ord(text)] = i
        self.one = one

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = (left.astype(np.int64) << 32) + right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.ranks[at], NONE)

    def __call__(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each word has, and the ids one after the other."""
        n = len(words)
        length = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
        text = pc.binary_join(pa.ListArray.from_arrays([0, n], words), "")[0].as_py()
        tok = np.frombuffer(text.encode("utf-32-le"), np.int32)
        word = np.repeat(np.arange(n, dtype=np.int32), length)
        long = np.flatnonzero(length > SHORT)
        if len(long):
            short = np.repeat(length <= SHORT, length)
            tok, word = tok[short], word[short]
        ids, of = self._joined(tok.copy(), word)
        for w in long.tolist():
            ids.append(np.array(self.one(words[w].as_py()), np.int32))
            of.append(np.full(len(ids[-1]), w, np.int32))
        ids, of = np.concatenate(ids), np.concatenate(of)
        known = ids >= 0
        ids, of = ids[known], of[known]
        return np.bincount(of, minlength=n), ids[np.argsort(of, kind="stable")]

    def _joined(self, tok: np.ndarray, word: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of words and the words that they belong to, in parts; in a word they are in order."""
        ids, of = [np.empty(0, np.int32)], [np.empty(0, np.int32)]
        rank = np.full(len(tok), NONE, np.int32)  # of the pair that begins at a place
        at = np.flatnonzero(word[:-1] == word[1:])
        rank[at] = self._ranks(tok[at], tok[at + 1])
        begin = np.flatnonzero(np.diff(word, prepend=-1))
        size = np.diff(begin, append=len(tok))
        while len(tok):
            best = np.minimum.reduceat(rank, begin)
            more = best < NONE
            live = np.repeat(more, size)
            ids.append(self.ids[tok[~live]])
            of.append(word[~live])
            at = np.flatnonzero(rank == np.repeat(np.where(more, best, -1), size))
            at = at[np.diff(word[at], prepend=-1) != 0]  # the leftmost in each word
            tok[at] = self.joined[best[more]]
            live[at + 1] = False
            tok, word, rank = tok[live], word[live], rank[live]
            inside, size = at - begin[more], size[more] - 1
            begin = np.cumsum(size) - size
            at = begin + inside
            rank[at] = NONE
            for i in (at[inside > 0] - 1, at[inside < size - 1]):  # the pairs beside the joined one
                rank[i] = self._ranks(tok[i], tok[i + 1])
        return ids, of
