"""Nearest neighbours, hard negatives and the prefix trie against brute force."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from corpuslm.llm import negatives, neighbours, trie

EMB = "vec_id long, embedding array<double>, label int, row long, v string, q int, list string"


def _vectors(seed=4, n=700, dim=24):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, dim)) * rng.uniform(0.2, 3, (n, 1))
    rows = [(i, x[i].tolist(), int(rng.integers(0, 4))) for i in range(n)]
    rows += [(n + i, x[40].tolist(), 1) for i in range(60)]  # equal vectors
    rows += [(100, x[100].tolist(), rows[100][2]), (7, x[8].tolist(), 2), (None, x[1].tolist(), 1), (2000, None, 1),
             (2020, [], 1), (2040, [1.0, None], 1), (2060, [float("nan"), 1.0], 2), (2080, [float("inf")], 2),
             (2100, [0.0] * dim, 3), (2120, [1.5, -2.0], 0), (2200, x[5].tolist(), None), (-100, x[6].tolist(), 2)]
    return rows


def _frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "v", 2, "l") for r in rows], EMB).repartition(5)


def _sound(v):
    return v is not None and all(c is not None and np.isfinite(c) for c in v)


def _dot(a, b):
    s = 0.0
    for x, y in zip(a, b, strict=False):
        s += x * y
    return s


def _nearest_by_hand(rows):
    ok = [(i, v) for i, v, _ in rows if i is not None and _sound(v) and any(v)]
    out = []
    for i, v in ok:
        if i % 20 == 0:
            near = sorted(((-_dot(v, w), j) for j, w in ok if j != i))[:20]
            out += [(i, k + 1, j, -s) for k, (s, j) in enumerate(near)]
    return ok, out


@pytest.mark.parametrize("sizes", [{}, {"list_rows": 60, "piece": 50, "block": 7}])
def test_neighbours(spark, sizes):
    rows = _vectors()
    _, want = _nearest_by_hand(rows)
    got = [tuple(r)[:4] for r in neighbours.search(_frame(spark, rows), **sizes).collect()]
    assert len(got) == len(want)
    mine, theirs = defaultdict(list), defaultdict(list)
    for i, _, j, s in got:
        mine[i].append((j, s))
    for i, _, j, s in want:
        theirs[i].append((j, s))
    hit = sum(len({round(s, 9) for _, s in mine[i]} & {round(s, 9) for _, s in theirs[i]}) / len({round(s, 9) for _, s in theirs[i]})
              for i in theirs) / len(theirs)
    assert hit >= 0.9
    true = {(i, j): s for i, _, j, s in want}
    for i, k, j, s in got:
        assert 1 <= k <= 20 and i != j and ((i, j) not in true or true[i, j] == s)
    for i, ranked in mine.items():
        if i != 100:  # two rows
            assert sorted(ranked, key=lambda x: (-x[1], x[0])) == sorted(ranked, key=lambda x: -x[1]) or len(ranked) == 20


def test_neighbours_of_few_and_no_rows(spark):
    rows = [(0, [1.0, 0.0], 1), (1, [0.5, 0.5], 1), (2, [-1.0, 2.0], 1), (20, [3.0], 1)]
    got = sorted(tuple(r)[:4] for r in neighbours.search(_frame(spark, rows)).collect())
    assert got == [(0, 1, 20, 3.0), (0, 2, 1, 0.5), (0, 3, 2, -1.0), (20, 1, 0, 3.0), (20, 2, 1, 1.5), (20, 3, 2, -3.0)]
    assert neighbours.search(_frame(spark, rows).limit(0)).count() == 0
    assert neighbours.search(_frame(spark, rows[1:3])).count() == 0


def test_the_scan_abandons_and_keeps_the_near():
    rng = np.random.default_rng(5)
    x = rng.standard_normal((3000, 96))
    x /= np.linalg.norm(x, axis=1)[:, None]
    space = neighbours.Space(96, 1.0, 1.0)
    q = space.rotated(x[:50], query=True)
    turned = space.rotated(x, query=False)
    true = 2 - 2 * x[:50] @ x.T
    limit = np.sort(true, axis=1)[:, 20]
    blocks = [turned[:, d: d + 16] for d in range(0, space.full, 16)]
    assert np.allclose(sum(neighbours._distances(q[:, d: d + 16], turned[:, d: d + 16]) for d in range(0, space.full, 16)), true)
    i, j, part = neighbours._survivors(space, q, blocks, limit, np.ones(true.shape, dtype=bool))
    near = {(a, b) for a, b in zip(*np.nonzero(true <= limit[:, None]), strict=True)}
    assert len(near & set(zip(i, j, strict=True))) >= 0.97 * len(near) and np.allclose(part, true[i, j])


def test_strassen_is_exact():
    rng = np.random.default_rng(6)
    for m, k, n in ((1, 1, 1), (5, 3, 4), (33, 64, 70), (40, 65, 17), (0, 8, 9)):
        for top in (1000, 2 ** 27, 2 ** 40):  # the last wraps around
            a, b = rng.integers(-top, top, (m, k)), rng.integers(-top, top, (k, n))
            assert (negatives.strassen(a, b, 2) == a @ b).all() and (negatives.strassen(a, b) == a @ b).all()


@pytest.mark.parametrize("sizes", [{}, {"anchor_block": 2, "candidate_block": 37}])
def test_negatives(spark, sizes):
    rows = _vectors()
    ok = []
    for i, v, label in rows:
        if i is not None and label is not None and _sound(v):
            ok.append((i, [int(np.floor(256 * c)) for c in v], (label + 1) % 10 if i % 7 == 0 else label))
    want = []
    for i, v, label in ok:
        if i % 100:
            continue
        score = [(-sum(a * b for a, b in zip(v, w, strict=False)), j, lab) for j, w, lab in ok]
        for ps, p, _ in sorted(x for x in score if x[2] == label and x[1] != i)[:5]:
            far = sorted(x for x in score if x[2] != label and -30 * ps <= -100 * x[0] <= -90 * ps)[:10]
            want += [(i, p, k + 1, j, -ps, -s) for k, (s, j, _) in enumerate(far)]
    got = [tuple(r)[:6] for r in negatives.mine(_frame(spark, rows), **sizes).collect()]
    assert sorted(got) == sorted(want) and len(got) > 100
    assert negatives.mine(_frame(spark, rows).limit(0)).count() == 0


def _trie_by_hand(rows):
    convs = defaultdict(list)
    for c, t, r, x, *_ in rows:
        if c is not None:
            r, x = r or "", x or ""
            convs[c].append((t is not None, t or 0, hashlib.sha256(f"{len(r)}:{r}{x}".encode()).hexdigest(), r, x))
    own = {c: [v[3:] for v in sorted(ts)] for c, ts in convs.items()}
    seq = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        seq[c] = tuple(own.get(base, [])[:h]) + tuple(own[c][h:])
    members = defaultdict(list)
    for c in sorted(seq):
        for d in range(len(seq[c]) + 1):
            members[seq[c][:d]].append(c)
    kids = defaultdict(list)
    for k in members:
        if k:
            kids[k[:-1]].append(k)
    below = {}
    for k in sorted(members, key=len, reverse=True):
        saved = (len(members[k]) - 1) * len(k[-1][1].encode()) if k else 0
        below[k] = (sum(below[x][0] for x in kids[k]) or 1, saved + sum(below[x][1] for x in kids[k]))
    return [(m[0], len(k), members[k[:-1]][0] if k else None, len(m), len(kids[k]), *below[k],
             hashlib.sha256(",".join(str(c) for c in m if len(seq[c]) == len(k)).encode()).hexdigest()) for k, m in members.items()]


def _conversations():
    rng = random.Random(8)
    turn = lambda: (rng.choice(["user", "assistant", None]), rng.choice(["", None, "é", "a b", "long " * 400, "x", "y"]))
    rows = []
    for c in range(120):
        rows += [(c, t, *turn()) for t in range(rng.randint(1, 12))]
    for c in (200, 205, 210):  # long ones, of which two are equal from the first turn on
        rows += [(c, t, "user", f"t{t}" if c != 210 or t < 70 else "other") for t in range(150)]
    rows += [(c, t, "user", "same") for c in range(300, 400) for t in range(14)]
    rows += [(7, None, "user", "no number"), (7, None, "user", "no number"), (7, 3, "user", "again"), (7, 3, "user", "again"),
             (None, 1, "user", "nobody"), (-3, 1, "user", "below"), (-5, 1, None, None), (2 ** 40 + 1, 0, "user", "alone")]
    rows += [(500, 1, "user", "one row many times")] * 90
    return rows


CONV = "conv_id long, turn long, role string, text string, n long, token string, depth int, place int"


@pytest.mark.parametrize("batch", ["10000", "7"])
def test_trie(spark, batch):
    rows = _conversations()
    key = lambda r: tuple((x is not None, x) for x in r)
    d = spark.createDataFrame([(*r, 1, "t", 2, 3) for r in rows], CONV).repartition(6)
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)  # many shards
    try:
        got = [tuple(r)[:8] for r in trie.prefix_trie(d).collect()]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert sorted(got, key=key) == sorted(_trie_by_hand(rows), key=key)


def test_trie_of_no_rows(spark):
    assert trie.prefix_trie(spark.createDataFrame([], CONV)).count() == 0


def test_double_arrays_hold_all_segments():
    rng = np.random.default_rng(9)
    rows = sorted({tuple(rng.integers(1, 40, rng.integers(1, 7))) for _ in range(3000)})
    codes = np.zeros((len(rows), 7), dtype=np.int64)
    for i, r in enumerate(rows):
        codes[i, : len(r)] = r
    arrays = trie.DoubleArray(codes)
    state = arrays.walk(codes)
    prefixes = {r[:k] for r in rows for k in range(1, len(r) + 1)}
    assert len(np.unique(state[state >= 0])) == len(prefixes) == (arrays.check >= 0).sum()
    names = {}
    for i, r in enumerate(rows):
        for k in range(len(r)):
            assert names.setdefault(state[i, k], r[: k + 1]) == r[: k + 1]
    with pytest.raises(AssertionError):
        arrays.walk(np.array([[39, 39, 39, 39, 39, 39, 39]]))
