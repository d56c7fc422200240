"""Words of a BPE training as blocks of numbers, so that a merge is a few passes of numpy over
a block instead of a Python loop over words.

A row holds a block of words: ``tok`` has the tokens of its words one after the other, with -1
before the first word and after each; ``pos`` says at which character of the block each begins.
Character ``starts[w]`` is the first of word w, ``freq`` and ``wrank`` are its count and rank.
The first ``done`` merges are applied, and words that they leave in one piece are left out of
``tok``.  A character's token is its code point; joined texts are numbered beyond those.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

POS_BITS = 20  # place inside a word; words are < 2**20 characters
BLOCK_WORDS, BLOCK_BYTES = 1 << 18, 1 << 25  # of a block, about
COLUMNS = {"tok": np.int32, "pos": np.int32, "starts": np.int32, "freq": np.int64, "wrank": np.int64}
SCHEMA = "done int, tok binary, pos binary, starts binary, freq binary, wrank binary"
JOINED = 0x110000  # the first number beyond the code points


class Names:
    """Numbers of tokens: code points, and joined texts in the order in which they are made."""

    def __init__(self, merges: list[tuple[str, str]]):
        self.texts: list[str] = []
        self.ids: dict[str, int] = {}
        self.steps = []  # (left, right, joined) of each merge
        for left, right in merges:
            text = left + right
            sides = self.id(left), self.id(right)
            if text not in self.ids:
                self.ids[text] = JOINED + len(self.texts)
                self.texts.append(text)
            self.steps.append((*sides, self.ids[text]))

    def id(self, text: str) -> int:
        """-2 for a text that is neither a character nor made by the merges."""
        return ord(text) if len(text) == 1 else self.ids.get(text, -2)

    def keys(self, pairs) -> np.ndarray:
        """Pairs as single numbers, ascending; those of unknown texts are left out."""
        both = [(self.id(a), self.id(b)) for a, b in pairs]
        return np.unique(np.array([(a << 32) + b for a, b in both if a >= 0 and b >= 0], np.int64))

    def column(self, numbers: np.ndarray) -> pa.Array:
        some, at = np.unique(numbers, return_inverse=True)
        texts = [chr(i) if i < JOINED else self.texts[i - JOINED] for i in some.tolist()]
        return pa.array(texts, pa.string()).take(pa.array(at))


def as_blocks(words: DataFrame) -> DataFrame:
    """``(word, freq, wrank)`` as blocks; blocks stay as they are."""
    if "tok" in words.columns:
        return words

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, size = [], 0, 0
        for b in batches:
            held.append(b)
            n += b.num_rows
            size += b.nbytes
            if n >= BLOCK_WORDS or size >= BLOCK_BYTES:
                yield _block(held)
                held, n, size = [], 0, 0
        if n:
            yield _block(held)

    return words.select("word", "freq", "wrank").mapInArrow(pack, SCHEMA)


def _block(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    t = pa.Table.from_batches(batches)
    words = t["word"].to_pylist()
    size = np.fromiter(map(len, words), np.int64, len(words))
    if size.max(initial=0) > (1 << POS_BITS) + 1:
        raise ValueError(f"a word of more than {1 << POS_BITS} characters cannot be ranked")
    starts = np.cumsum(size + 1) - size
    tok = np.frombuffer(("\n" + "\n".join(words) + "\n").encode("utf-32-le"), np.int32).copy()
    tok[np.concatenate(([0], starts + size))] = -1  # words hold no white space
    return _row(0, {"tok": tok, "pos": np.arange(len(tok)), "starts": starts, "freq": t["freq"].to_numpy(), "wrank": t["wrank"].to_numpy()})


def _row(done: int, block: dict[str, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([done], pa.int32()), *(pa.array([block[k].astype(kind).tobytes()], pa.binary()) for k, kind in COLUMNS.items())],
        names=["done", *COLUMNS])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, dict[str, np.ndarray]]]:
    for b in batches:
        for i in range(b.num_rows):
            yield b.column("done")[i].as_py(), {k: np.frombuffer(b.column(k)[i].as_buffer(), kind) for k, kind in COLUMNS.items()}


def _pair_keys(tok: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of ``at`` where a pair begins, and the pairs as single numbers."""
    at = at[(tok[at] >= 0) & (tok[at + 1] >= 0)]
    return at, (tok[at].astype(np.int64) << 32) + tok[at + 1]


def _split(tok: np.ndarray, pos: np.ndarray, wanted: np.ndarray):
    """The words that hold a wanted pair, the other ones, and the number of the first."""
    top = int(max(tok.max(initial=0), 0)) + 2  # the last place, that of -1, stays empty
    first, second = np.zeros(top, bool), np.zeros(top, bool)
    for mask, side in ((first, wanted >> 32), (second, wanted & 0xFFFFFFFF)):
        mask[side[side < top - 1]] = True
    at = np.flatnonzero(first[tok[:-1]])
    at = at[second[tok[at + 1]]]
    at = at[np.isin((tok[at].astype(np.int64) << 32) + tok[at + 1], wanted)]
    ends = np.flatnonzero(tok == -1)
    chosen = np.zeros(len(ends), bool)
    chosen[np.searchsorted(ends, at)] = True  # a word's number is that of its end
    n = int(chosen.sum())
    if not n:
        return (tok[:1], pos[:1]), (tok, pos), 0
    mine = np.repeat(chosen, np.diff(ends, prepend=-1))
    mine[0] = True
    rest = ~mine
    rest[0] = True
    return (tok[mine], pos[mine]), (tok[rest], pos[rest]), n


def _places(tok: np.ndarray, left: int, right: int) -> np.ndarray:
    """Where the pair is joined: from left to right, without overlap."""
    at = np.flatnonzero(tok[:-1] == left)
    at = at[tok[at + 1] == right]
    if left == right and len(at) > 1:
        new = np.flatnonzero(np.diff(at, prepend=-2) != 1)
        at = at[(np.arange(len(at)) - np.repeat(new, np.diff(new, append=len(at)))) % 2 == 0]
    return at


def _joined(tok: np.ndarray, pos: np.ndarray, at: np.ndarray, text: int) -> tuple[np.ndarray, np.ndarray]:
    keep = np.ones(len(tok), bool)
    keep[at + 1] = False
    tok = tok.copy()
    tok[at] = text
    return tok[keep], pos[keep]


def _apply(tok, pos, steps):
    for left, right, text in steps:
        at = _places(tok, left, right)
        if len(at):
            tok, pos = _joined(tok, pos, at, text)
    return tok, pos


def _keys_of(steps) -> np.ndarray:
    return np.unique(np.array([(a << 32) + b for a, b, _ in steps if a >= 0 and b >= 0], np.int64))


def _near(at: np.ndarray, offsets: tuple[int, ...]) -> np.ndarray:
    return np.unique(np.concatenate([at + k for k in offsets]))


def advance(blocks: DataFrame, merges: list[tuple[str, str]]) -> DataFrame:
    """The blocks with all of ``merges`` applied."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = Names(merges)
        for done, b in _blocks(batches):
            steps = names.steps[done:]
            mine, rest, _ = _split(b["tok"], b["pos"], _keys_of(steps))
            tok, pos = _apply(*mine, steps)
            ends = np.flatnonzero(tok == -1)
            size = np.diff(ends, prepend=-1)
            whole = np.repeat(size == 2, size)  # one piece and its end
            b["tok"], b["pos"] = (np.concatenate((r, x[1:][~whole[1:]])) for r, x in zip(rest, (tok, pos), strict=True))
            yield _row(len(merges), b)

    return blocks.mapInArrow(task, SCHEMA)


NONE = np.iinfo(np.int64).max  # no place


class _Sums:
    """Changes by number of the step and pair: what is added, and the least place of each kind."""

    def __init__(self, block: dict[str, np.ndarray]):
        self.block, self.parts = block, []

    def add(self, step: int, pos: np.ndarray, keys: np.ndarray, signs: np.ndarray, kinds: np.ndarray) -> None:
        """``signs`` of the frequencies; a place counts as lost (0), gained (1) or seen (2)."""
        if not len(keys):
            return
        b = self.block
        w = np.searchsorted(b["starts"], pos, "right") - 1
        place = (b["wrank"][w] << POS_BITS) + (pos - b["starts"][w])
        order = np.argsort(keys, kind="stable")
        keys, kinds, place = keys[order], kinds[order], place[order]
        cut = np.flatnonzero(np.diff(keys, prepend=-1))
        n = np.add.reduceat((signs * b["freq"][w])[order], cut)
        least = [np.minimum.reduceat(np.where(kinds == k, place, NONE), cut) for k in range(3)]
        self.parts.append((np.full(len(cut), step, np.int32), keys[cut], n, *least))

    def columns(self) -> list[np.ndarray]:
        return [np.concatenate(c) for c in zip(*self.parts, strict=True)] if self.parts else [np.empty(0, np.int64)] * 6


def _count_triples(tok: np.ndarray, pos: np.ndarray, block: dict, names: Names, triples) -> Iterator[tuple[tuple, int]]:
    named = {(x, y, z): t for t in triples if min(x := names.id(t[0]), y := names.id(t[1]), z := names.id(t[2])) >= 0}
    pairs = np.unique(np.array([(x << 32) + y for x, y, _ in named], np.int64))
    if not len(pairs) or len(tok) < 4:
        return
    at, keys = _pair_keys(tok, np.arange(1, len(tok) - 2))
    at, keys = (v[np.isin(keys, pairs)] for v in (at, keys))
    at, keys = (v[tok[at + 2] >= 0] for v in (at, keys))
    code = (np.searchsorted(pairs, keys) << 32) + tok[at + 2]
    some, which = np.unique(code, return_inverse=True)
    n = np.zeros(len(some), np.int64)
    np.add.at(n, which, block["freq"][np.searchsorted(block["starts"], pos[at], "right") - 1])
    for c, times in zip(some.tolist(), n.tolist(), strict=True):
        pair = int(pairs[c >> 32])
        if (t := named.get((pair >> 32, pair & 0xFFFFFFFF, c & 0xFFFFFFFF))) is not None:
            yield t, times


def changes_of_blocks(batches: Iterator[pa.RecordBatch], merges, batch, asked, triples, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """What ``pair_deltas.changes`` gives for the words of some blocks, as rows."""
    names = Names([*merges, *batch])
    asked_keys = names.keys(asked)
    others = np.unique(np.concatenate((asked_keys, names.keys({t[:2] for t in triples}))))
    looked = 0
    for done, block in _blocks(batches):
        sums = _Sums(block)
        steps = names.steps[done:]
        (tok, pos), _, n = _split(block["tok"], block["pos"], np.union1d(_keys_of(steps), others))
        looked += n
        tok, pos = _apply(tok, pos, steps[: len(merges) - done])
        for step, (left, right, text) in enumerate(names.steps[len(merges):]):
            at = _places(tok, left, right)
            if not len(at):
                continue
            old, gone = _pair_keys(tok, _near(at, (-1, 0, 1)))
            was = pos[old]
            tok, pos = _joined(tok, pos, at, text)
            new, made = _pair_keys(tok, _near(at - np.arange(len(at)), (-1, 0)))
            kinds = np.repeat([0, 1], [len(old), len(new)])
            sums.add(step, np.concatenate((was, pos[new])), np.concatenate((gone, made)), 2 * kinds - 1, kinds)
        if len(asked_keys) and len(tok) > 1:
            at, keys = _pair_keys(tok, np.arange(1, len(tok) - 1))
            at, keys = (v[np.isin(keys, asked_keys)] for v in (at, keys))
            sums.add(-1, pos[at], keys, np.zeros(len(at), np.int64), np.full(len(at), 2))
        step, keys, n, *least = sums.columns()
        yield pa.RecordBatch.from_arrays(
            [pa.array(step, pa.int32()), names.column(keys >> 32), pa.array([""] * len(keys), pa.string()), names.column(keys & 0xFFFFFFFF),
             pa.array(n, pa.int64()), *(pa.array(x, pa.int64(), mask=x == NONE) for x in least)], schema=schema)
        found = list(_count_triples(tok, pos, block, names, triples)) if triples else []
        if found:
            sides = [[t[k] for t, _ in found] for k in range(3)]
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(
                [[-2] * len(found), *sides, [n for _, n in found], *[[None] * len(found)] * 3], schema.types, strict=True)], schema=schema)
    yield pa.RecordBatch.from_arrays([pa.array([v], kind) for v, kind in zip((-3, "", "", "", looked, None, None, None), schema.types, strict=True)], schema=schema)


def pairs_of_blocks(batches: Iterator[pa.RecordBatch], merges) -> Iterator[pa.RecordBatch]:
    """``(left, right, n, first)`` of all pairs of each block under ``merges``."""
    names = Names(merges)
    for done, block in _blocks(batches):
        tok, pos = _apply(block["tok"], block["pos"], names.steps[done:])
        sums = _Sums(block)
        if len(tok) > 1:
            at, keys = _pair_keys(tok, np.arange(1, len(tok) - 1))
            sums.add(0, pos[at], keys, np.ones(len(at), np.int64), np.full(len(at), 2))
        _, keys, n, _, _, first = sums.columns()
        yield pa.RecordBatch.from_arrays([names.column(keys >> 32), names.column(keys & 0xFFFFFFFF), pa.array(n, pa.int64()), pa.array(first, pa.int64())],
                                         names=["left", "right", "n", "first"])
