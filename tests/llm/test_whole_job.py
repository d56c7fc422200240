"""Inputs on which the operators once did less than the whole job."""

import random
import re

import pyarrow as pa
from corpuslm.llm import chat, minhash

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _words(rng, n):
    return ["".join(rng.choice("abcdefgh") for _ in range(7)) for _ in range(n)]


def _shingles(text):
    w = WORD.findall(text)
    return {tuple(w[i: i + 5]) for i in range(max(1, len(w) - 4))}


def _grouped(links, names):
    """The least name of each name's component."""
    group = {x: x for x in names}
    for a, b in links:
        old, new = max(group[a], group[b]), min(group[a], group[b])
        group = {x: new if g == old else g for x, g in group.items()}
    return group


def test_near_copies_with_repeated_passages_are_linked(spark):
    rng = random.Random(11)
    texts = []
    for k in range(24):
        w = _words(rng, 200)
        passage = w[60:130]
        texts += [" ".join(w), " ".join(w[:130] + passage * (5, 10, 30, 200)[k % 4] + w[130:])]
    sets = [_shingles(t) for t in texts]
    links = [(i, j) for i in range(len(texts)) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    assert links == [(2 * k + 1, 2 * k) for k in range(24)]
    got = minhash.classes(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert {r["doc_id"]: r["class_id"] for r in got.collect()} == _grouped(links, range(len(texts)))


def test_large_fringe_of_one_bucket_is_compared_whole(spark):
    """24 pairs of near copies on one template, in one bucket that no further band divides."""
    p = minhash.Params(bands=1, rows=1, chunk=4)
    for seed in range(100):  # a template that gives the first register of all texts
        rng = random.Random(seed)
        template = _words(rng, 200)
        texts = []
        for _ in range(24):
            own = _words(rng, 60)
            texts += [" ".join(template + own), " ".join(template + own[:-1] + ["changed"])]
        signed = minhash._signer(p)(iter([pa.RecordBatch.from_arrays(
            [pa.array(range(len(texts))), pa.array(texts), pa.array(texts)], names=["doc_id", "node", "text"])]))
        if len({k[0] for b in signed for k in b.column(3).to_pylist()}) == 1:
            break
    else:
        raise AssertionError("no template")
    sets = [_shingles(t) for t in texts]
    links = [(i, j) for i in range(len(texts)) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    assert links == [(2 * k + 1, 2 * k) for k in range(24)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = minhash.classes(docs, p)
    assert {r["doc_id"]: r["class_id"] for r in got.collect()} == _grouped(links, range(len(texts)))


def test_many_rows_of_few_turn_numbers_are_cut_into_parts(spark):
    rows = [(None, k % 11, "u", f"n{k}") for k in range(3000)]  # a null id, eleven numbers
    rows += [(1, None, "u", f"z{k}") for k in range(700)] + [(1, 5, "a", "last")]  # no numbers
    rows += [(2, 7, "u", "same")] * 700 + [(3, 1, "u", "same")] * 300  # repeated rows; 3 is a prefix of 2
    rows += [(4, 1, "u", "x"), (4, 9000, "u", "y")] + [(5, 0, "u", "x")]  # 5 is a prefix of 4
    conv = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    got = {(r["conv_id"], r["part"]): r for r in chat.format_chats(conv).collect()}
    size = {k: r["text"].count("<|im_start|>") for k, r in got.items()}
    assert size == {**{(None, k): 256 for k in range(11)}, (None, 11): 3000 - 11 * 256, (1, -3): 700 - 512, (1, -2): 256,
                    (1, -1): 256, (1, 0): 1, (2, 0): 256, (2, 1): 256, (2, 2): 700 - 512, (4, 0): 2}
    assert {k[0]: r["n_turns"] for k, r in got.items()} == {None: 3000, 1: 701, 2: 700, 4: 2}
    text = lambda c: re.findall(r"\|>\w\n(\w+)<", "".join(got[k]["text"] for k in sorted(k for k in got if k[0] == c)))
    numbers = [int(x[1:]) % 11 for x in text(None)]
    assert numbers == sorted(numbers) and set(text(None)) == {f"n{k}" for k in range(3000)}
    assert text(1)[-1] == "last" and set(text(1)[:-1]) == {f"z{k}" for k in range(700)}
    assert set(text(2)) == {"same"} and text(4) == ["x", "y"]
