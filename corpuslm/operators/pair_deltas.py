"""Pair counts that follow the merges of a BPE training by signed updates.

The words of the corpus are one table of blocks (``word_blocks``).  What a word is cut
into is a function of the merges so far; every some rounds the blocks are made anew with the
merges since, and a lost task is run again from the table and the merge list.

A merge of ``(l, r)`` can only change a word that holds this pair, so a
round looks only at those (``recount``).  It returns, for each pair that lost or gained occurrences there, the signed change
of its count, and the first place lost and the first gained.  These are summed by
pair before they reach the driver: at most the pairs next to a merged one.

A round tries a whole batch of merges.  ``PairTable.guess`` names what is likely to
come next, the changes come step by step, and the driver takes them in one after
the other as long as the next guess is the best pair of the exact counts then.  So
a wrong guess costs a round, never a merge.  Guessing takes into account how often
frequent pairs overlap, which the rounds before have counted.

``PairTable`` keeps the counts of the most frequent pairs, ``limit`` to twice
``limit`` of them, and a floor: what it does not hold occurs ``floor`` times at
most.  That stays true, as an old pair only loses occurrences, and a pair with a
token of the round is counted in whole by the round's changes.  When the best
pair is not above the floor, the table is filled anew from the words.

Ties go to the pair seen first, by (rank of the word, place of the character in
it).  Places do not move when other pairs are merged.  When a pair's first
occurrence is lost, its place is only known not to be earlier; if that decides a
tie, the true place is asked for, most often together with the next round.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslm.operators.word_blocks import POS_BITS, as_blocks, changes_of_blocks, pairs_of_blocks

Pair = tuple[str, str]
Triple = tuple[str, str, str]
CHANGE = pa.schema([("step", pa.int32()), *((k, pa.string()) for k in ("left", "mid", "right")),
                    *((k, pa.int64()) for k in ("n", "lost", "gained", "seen"))])
SHORT = 40  # characters up to which a word is cut by plain scans
NO_RANK = 1 << 62


def cut_word(word: str, ranks: dict[Pair, int]) -> list[str]:
    """Tokens of a word: of all neighbours the pair of lowest rank, leftmost first,
    is joined until none has a rank."""
    if len(word) > SHORT:
        from corpuslm.operators.bpe import encode_word_py
        return encode_word_py(word, ranks)
    piece, none, get = list(word), NO_RANK, ranks.get
    rank = [get(p, none) for p in zip(piece, piece[1:], strict=False)]
    while rank and (best := min(rank)) < none:
        i = rank.index(best)
        piece[i: i + 2] = [piece[i] + piece[i + 1]]
        del rank[i]
        if i:
            rank[i - 1] = get((piece[i - 1], piece[i]), none)
        if i < len(rank):
            rank[i] = get((piece[i], piece[i + 1]), none)
    return piece


def join_pair(piece: list[str], left: str, right: str) -> list[str]:
    """Join a pair from left to right, without overlap."""
    out, i, n = [], 0, len(piece)
    while i < n:
        if i + 1 < n and piece[i] == left and piece[i + 1] == right:
            out.append(left + right)
            i += 2
        else:
            out.append(piece[i])
            i += 1
    return out


def placed_pairs(piece: list[str]) -> dict[tuple[int, str, str], None]:
    """The pairs of a cut word with their places, in order."""
    out, at = {}, 0
    for left, right in zip(piece, piece[1:], strict=False):
        out[at, left, right] = None
        at += len(left)
    return out


def _least(a: int | None, b: int) -> int:
    return b if a is None or b < a else a


Key = tuple[int, str, str]  # a step of the batch and a pair; step -1: the asked first places


def changes(rows: Iterable[tuple[str, int, int]], merges: list[Pair], batch: list[Pair], asked: set[Pair],
            triples: set[Triple]) -> tuple[dict[Key, list], dict[Triple, int]]:
    """What the merges of ``batch``, learned after ``merges``, change in these (word,
    frequency, rank), step by step: per pair the change of its count, the first place
    lost and the first gained; for the asked pairs the first place after the batch.
    And how often the ``triples`` of tokens occur after the batch."""
    ranks = {p: i for i, p in enumerate(merges)}
    out: dict[Key, list] = {}
    overlaps: dict[Triple, int] = {}
    steps = [(step, left, right, left + right) for step, (left, right) in enumerate(batch)]
    for word, freq, wrank in rows:
        piece = cut_word(word, ranks)
        base = wrank << POS_BITS
        then = None
        for step, left, right, text in steps:
            if text not in word or left not in piece:
                continue
            after = join_pair(piece, left, right)
            if len(after) == len(piece):
                continue
            if then is None:
                then = placed_pairs(piece)
            now = placed_pairs(after)
            for signed, old, new, k in ((-freq, then, now, 1), (freq, now, then, 2)):
                for at, a, b in old:
                    if (at, a, b) not in new:
                        c = out.get((step, a, b))
                        if c is None:
                            c = out[step, a, b] = [0, None, None, None]
                        c[0] += signed
                        c[k] = _least(c[k], base + at)
            piece, then = after, now
        if asked and not asked.isdisjoint(zip(piece, piece[1:], strict=False)):
            for at, left, right in then if then is not None else placed_pairs(piece):
                if (left, right) in asked:
                    c = out.setdefault((-1, left, right), [0, None, None, None])
                    c[3] = _least(c[3], base + at)
        for tri in zip(piece, piece[1:], piece[2:], strict=False) if triples else ():
            if tri in triples:
                overlaps[tri] = overlaps.get(tri, 0) + freq
    return out, overlaps


def recount(words: DataFrame, merges: list[Pair], batch: list[Pair], asked: set[Pair], triples: set[Triple]) -> DataFrame:
    """``changes`` over the words (a table of them or ``word_blocks``) that hold a pair of the
    batch, an asked one or that of a triple, summed by step and pair.  Step -2 has the
    triples, step -3 the number of words looked at."""
    def task(batches):
        return changes_of_blocks(batches, merges, batch, asked, triples, CHANGE)

    return as_blocks(words).mapInArrow(task, "step int, left string, mid string, right string, n long, lost long, gained long, seen long").groupBy(
        "step", "left", "mid", "right").agg(F.sum("n").alias("n"), F.min("lost").alias("lost"), F.min("gained").alias("gained"),
                                            F.min("seen").alias("seen"))


def count_pairs(words: DataFrame, merges: list[Pair]) -> DataFrame:
    """``(left, right, n, first)`` of all pairs under ``merges``, from the words."""

    def task(batches):
        return pairs_of_blocks(batches, merges)

    return as_blocks(words).mapInArrow(task, "left string, right string, n long, first long").groupBy(
        "left", "right").agg(F.sum("n").alias("n"), F.min("first").alias("first"))


class PairTable:
    """Counts and first places of the most frequent pairs, on the driver; at most
    ``2 * limit`` of them."""

    def __init__(self, limit: int = 1_000_000):
        self.limit, self.floor = limit, 0
        self.n: dict[Pair, int] = {}
        self.first: dict[Pair, int] = {}
        self.late: set[Pair] = set()  # the first place is not before what ``first`` says
        self.heap: list = []

    def fill(self, pairs: DataFrame) -> None:
        """Take the most frequent of a table of all pairs."""
        rows = pairs.orderBy(F.desc("n"), "first").limit(self.limit + 1).collect()
        self.floor = rows.pop()["n"] if len(rows) > self.limit else 0
        self.n = {(r["left"], r["right"]): r["n"] for r in rows}
        self.first = {(r["left"], r["right"]): r["first"] for r in rows}
        self.late = set()
        self._heap()

    def _heap(self) -> None:
        self.heap = [(-n, self.first[p], p) for p, n in self.n.items()]
        heapq.heapify(self.heap)

    def apply(self, rows: Iterable, made: set[str]) -> None:
        """Take in the changes of a round that made the tokens ``made``."""
        for r in rows:
            p = (r["left"], r["right"])
            if p not in self.n:
                if not (p[0] in made or p[1] in made) or r["n"] <= self.floor:
                    continue  # not above the floor before, and not now
                self.n[p], self.first[p] = 0, r["gained"]
            n = self.n[p] = self.n[p] + r["n"]
            if r["seen"] is not None:
                self.first[p] = r["seen"]
                self.late.discard(p)
            elif r["lost"] is not None and r["lost"] <= self.first[p]:
                self.late.add(p)
            if n <= 0:
                del self.n[p], self.first[p]
                self.late.discard(p)
            else:
                heapq.heappush(self.heap, (-n, self.first[p], p))
        if len(self.n) > 2 * self.limit:
            kept = heapq.nlargest(self.limit + 1, self.n.items(), key=lambda x: x[1])
            self.floor = max(self.floor, kept.pop()[1])
            self.n = dict(kept)
            self.first = {p: self.first[p] for p in self.n}
            self.late &= self.n.keys()
            self._heap()
        elif len(self.heap) > 4 * len(self.n) + 1000:
            self._heap()

    def _pop(self):
        while self.heap:
            e = heapq.heappop(self.heap)
            if self.n.get(e[2]) == -e[0] and self.first[e[2]] == e[1] and not (self.heap and self.heap[0] == e):
                return e
        return None

    def best(self, min_frequency: int) -> tuple[Pair | None, str]:
        """The pair to merge next, or None and why: ``ask`` (a tie that a first place
        decides which is not known), ``refill``, ``no_pairs`` or ``below_min_frequency``."""
        e = self._pop()
        if e is None:
            return None, "refill" if self.floor else "no_pairs"
        heapq.heappush(self.heap, e)
        if -e[0] <= self.floor:
            return None, "refill"
        if -e[0] < min_frequency:
            return None, "below_min_frequency"
        if e[2] in self.late:
            heapq.heappop(self.heap)
            other = self._pop()
            heapq.heappush(self.heap, e)
            if other:
                heapq.heappush(self.heap, other)
                if other[0] == e[0]:
                    return None, "ask"
        return e[2], ""

    def top(self, n: int) -> list[tuple[int, int, Pair]]:
        """The first ``n`` of the ranking: (-count, first place, pair)."""
        got = []
        while len(got) < n and (e := self._pop()):
            got.append(e)
        for e in got:
            heapq.heappush(self.heap, e)
        return got

    def near(self, n: int, known: set[Pair]) -> set[Triple]:
        """The triples of tokens in which two of the first ``n`` pairs overlap, of
        which one is not ``known`` yet."""
        pairs = {e[2] for e in self.top(n)}
        follow = defaultdict(list)
        for left, right in pairs:
            follow[left].append(right)
        found = {(a, b, c) for a, b in pairs for c in follow.get(b, ()) if (a, b) not in known or (b, c) not in known}
        known |= pairs
        return found

    def guess(self, overlaps: dict[Triple, int], n: int, ahead: int) -> list[Pair]:
        """Up to ``n`` merges that are likely to come next, from the first ``ahead``
        of the ranking and how often they overlap: a merge of (a, b) takes the
        overlaps from (x, a) and (b, y) and gives them to (x, ab) and (ab, y).
        Nothing rests on this but the number of rounds."""
        ranked = self.top(ahead)
        least = -ranked[-1][0] if len(ranked) == ahead else 1
        count, first = {e[2]: -e[0] for e in ranked}, {e[2]: e[1] for e in ranked}
        tri, out = dict(overlaps), []
        heap = list(ranked)  # ascending, so a heap
        while heap and len(out) < n:
            c, _, p = heapq.heappop(heap)
            if count.get(p) != -c:
                continue
            if -c < least:
                break
            a, b = p
            out.append(p)
            if a == b:
                break
            del count[p]
            for q in list(count):
                if q[0] == b:
                    t, made, old, new = tri.get((a, b, q[1]), 0), (a + b, q[1]), (b, q[1]), (a + b, q[1])
                elif q[1] == a:
                    t, made, old, new = tri.get((q[0], a, b), 0), (q[0], a + b), (q[0], a), (q[0], a + b)
                else:
                    continue
                t = min(t, count[q], -c)
                if t:
                    for x, v in ((q, count[q] - t), (made, t)):
                        count[x], first[x] = v, first[q]
                        heapq.heappush(heap, (-v, first[q], x))
                    # what overlaps the new pair did so with the old one
                    tri |= {(*new, k[2]): v for k, v in overlaps.items() if k[:2] == old}
                    tri |= {(k[0], *new): v for k, v in overlaps.items() if k[1:] == old}
        return out
