"""The trie of conversation prefixes (operator 12), packed as double arrays.

A turn is a token of 20 bytes: 16 of the SHA-256 of role and text, and the text's
length; texts are never shuffled.  Turns are put in order by one range shuffle over
(conv_id, turn, token); a task numbers its rows as they stream by, and what a
conversation has in earlier tasks is added from one summary row per task, so a
conversation that holds a third of all turns is numbered by many tasks.

Rebuilt conversations are cut into segments of ``TURNS`` turns.  A segment's prefix
is named by two 64-bit sums (exclusive or) of the hashes of the segments before it.
Equal segments of one prefix are counted first.  The distinct ones are dealt out by
ranges of (prefix, segment), so a task holds neighbours in the trie, and every Arrow
batch of them is one prefix shard: its turns get dense ids, the most frequent the
smallest, its BASE and CHECK arrays are packed, and walking all segments through the
arrays gives the nodes with what their segments sum up to.  A node inside a shard is
complete; those on the two border paths of a shard, and where segments meet, may
lie in several shards, and their sums are merged by name.

Sums over subtrees are sums over members: a node belongs to its smallest member, and
a conversation's own nodes are the lower end of its path.  So the sum over the
subtree of a node is the sum of what all members own, less what the node's own
conversation owns above it.  A second walk with these sums as weights gives it.

No task holds a whole group: running sums along a conversation's own nodes go in two
levels, and the ids of equal conversations stream through their SHA-256, which has
to take them in one order, in short strings of up to ``IDS`` of them.

Defined results.  Turns are ordered by number, null first, and equal numbers by
token.  A null role or text is empty.  Rows with a null conv_id take no part.
Repeated rows are turns like others.  conv_id % 5 keeps the sign, as in SQL.  An
empty table gives no rows.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURNS = 32  # turns of a segment
TOKEN = 20  # bytes of a turn's token
IDS = 12  # bits: conversation ids in one string
OWN = 12  # bits: depths in one run of a conversation's own nodes
HEADS, CYCLE, LIMIT = 5, 9, 8  # rebuilt from conv_id - conv_id % HEADS; crc32 % CYCLE turns, at most LIMIT
FAR = np.iinfo(np.int64).max


# ------------------------------------------------------------------ turns in order
def _token(role: Column, text: Column) -> Column:
    role, text = F.coalesce(role.cast("string"), F.lit("")), F.coalesce(text.cast("string"), F.lit(""))
    named = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return F.unhex(F.concat(F.substring(F.sha2(named, 256), 1, 2 * (TOKEN - 4)), F.lpad(F.hex(F.octet_length(text)), 8, "0")))


def _numbered(batches):
    """Each row's place among those of its conversation in this task."""
    task = TaskContext.get().partitionId()
    last, n = None, 0
    for b in batches:
        if not b.num_rows:
            continue
        conv = b.column(0).to_numpy()
        start = np.flatnonzero(np.r_[True, conv[1:] != conv[:-1]])
        size = np.diff(np.r_[start, len(conv)])
        place = np.arange(len(conv)) - np.repeat(start, size)
        if conv[0] == last:
            place[: size[0]] += n
        last, n = conv[-1], int(place[-1]) + 1
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array(np.full(len(conv), task, dtype=np.int32)), pa.array(place), b.column(1)],
            names=["conv_id", "task", "place", "token"])


def ordered_turns(conv: DataFrame) -> DataFrame:
    """``(conv_id, pos, token)``, pos from 0."""
    spark = conv.sparkSession
    t = conv.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), _token(F.col("role"), F.col("text")).alias("token"),
        F.col("turn").cast("long").alias("turn"), F.monotonically_increasing_id().alias("row"))
    keys = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("token"), F.col("row")]
    placed = (t.repartitionByRange(*keys).sortWithinPartitions(*keys).select("conv_id", "token")
              .mapInArrow(_numbered, "conv_id long, task int, place long, token binary").checkpoint())
    # one row per task: its first conversation, its last one and how many turns of that it has
    ends = placed.groupBy("task").agg(F.min("conv_id").alias("first"), F.max(F.struct("conv_id", "place")).alias("last")).collect()
    before, held = [], {}
    for e in sorted(ends, key=lambda e: e["task"]):
        if held.get("conv_id") == e["first"]:
            before.append((e["task"], e["first"], held["n"]))
        more = held.get("n", 0) if held.get("conv_id") == e["last"]["conv_id"] else 0
        held = {"conv_id": e["last"]["conv_id"], "n": more + e["last"]["place"] + 1}
    carried = spark.createDataFrame(before, "task int, conv_id long, before long")
    placed = placed.join(F.broadcast(carried), ["task", "conv_id"], "left")  # at most a row per task
    return placed.select("conv_id", (F.col("place") + F.coalesce("before", F.lit(0))).alias("pos"), "token")


def rebuilt(conv: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The turns ``(conv_id, depth, token, n_all)`` of the rebuilt conversations,
    depth from 1, and all of them as ``(conv_id, n_all)``."""
    turns = ordered_turns(conv).checkpoint()
    own = turns.groupBy("conv_id").agg((F.max("pos") + 1).alias("n_own"), F.array_sort(F.collect_list(F.when(
        F.col("pos") < LIMIT, F.struct("pos", "token")))).alias("head"))
    heads = own.filter(F.col("conv_id") % HEADS == 0).select(F.col("conv_id").alias("head_id"), "head")
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % CYCLE).cast("int")
    convs = own.select("conv_id", "n_own", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % HEADS).alias("head_id"))
    convs = convs.join(heads, "head_id", "left").withColumn("n_head", F.least("h", F.coalesce(F.size("head"), F.lit(0))))
    convs = convs.withColumn("n_all", F.col("n_head") + F.greatest(F.col("n_own") - F.col("h"), F.lit(0))).checkpoint()
    lead = convs.filter("n_head > 0").select("conv_id", "n_all", F.posexplode(F.slice("head", 1, F.col("n_head"))).alias("i", "x"))
    lead = lead.select("conv_id", (F.col("i") + 1).cast("long").alias("depth"), F.col("x.token").alias("token"), "n_all")
    rest = turns.join(convs.select("conv_id", "h", "n_head", "n_all"), "conv_id").filter(F.col("pos") >= F.col("h"))
    rest = rest.select("conv_id", (F.col("n_head") + F.col("pos") - F.col("h") + 1).alias("depth"), "token", "n_all")
    return lead.unionByName(rest), convs.select("conv_id", "n_all")


# ------------------------------------------------------------------ segments
def _name(band: Column, seg: Column, which: int) -> Column:
    return F.xxhash64(F.concat(F.unhex(F.lpad(F.hex(band), 16, "0")), F.unhex(F.lit(f"{which:02d}")), seg))


def _names(band: int, seg: bytes) -> tuple[int, int]:
    """The same for one segment, as signed numbers."""
    head = band.to_bytes(8, "big")
    a, b = (xxhash.xxh64_intdigest(head + bytes([k]) + seg, seed=42) for k in (1, 2))
    return a - (1 << 64) if a >> 63 else a, b - (1 << 64) if b >> 63 else b


def segments(conv: DataFrame) -> DataFrame:
    """``(conv_id, band, p1, p2, h1, h2, seg, n_all)``: the prefix's name, the
    segment's and its tokens.  A conversation without turns has one empty segment."""
    turns, convs = rebuilt(conv)
    band = F.floor((F.col("depth") - 1) / TURNS).alias("band")
    listed = turns.groupBy("conv_id", band, "n_all").agg(F.array_sort(F.collect_list(F.struct("depth", "token"))).alias("x"))
    listed = listed.select("conv_id", "band", "n_all", F.unhex(F.array_join(F.transform(
        "x", lambda s: F.hex(s["token"])), "")).alias("seg"))
    none = convs.filter("n_all = 0").select("conv_id", F.lit(0).cast("long").alias("band"), "n_all", F.unhex(F.lit("")).alias("seg"))
    named = listed.unionByName(none).select(
        "*", *[_name(F.col("band"), F.col("seg"), k).alias(f"h{k}") for k in (1, 2)]).checkpoint()
    zero = F.lit(0).cast("long")
    short = named.filter(F.col("n_all") <= TURNS).select("*", zero.alias("p1"), zero.alias("p2"))
    # two levels: runs of 256 segments, and the runs' totals
    long = named.filter(F.col("n_all") > TURNS).withColumn("run", F.shiftright("band", 8))
    within = Window.partitionBy("conv_id", "run").orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("conv_id").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    totals = long.groupBy("conv_id", "run").agg(*[F.bit_xor(f"h{k}").alias(f"t{k}") for k in (1, 2)])
    totals = totals.select("conv_id", "run", *[F.coalesce(F.bit_xor(f"t{k}").over(upto), zero).alias(f"t{k}") for k in (1, 2)])
    long = long.select("*", *[F.coalesce(F.bit_xor(f"h{k}").over(within), zero).alias(f"w{k}") for k in (1, 2)]).join(
        totals, ["conv_id", "run"])
    long = long.select(*named.columns, *[F.col(f"w{k}").bitwiseXOR(F.col(f"t{k}")).alias(f"p{k}") for k in (1, 2)])
    return short.unionByName(long)


# ------------------------------------------------------------------ double arrays
class DoubleArray:
    """BASE and CHECK over dense codes from 1: from state s, code c leads to
    BASE[s] + c if CHECK there is s.  Built from a matrix of codes whose rows are
    sorted by prefix (0 where a row has ended), level by level."""

    def __init__(self, codes: np.ndarray):
        size = 2 * codes.size + int(codes.max(initial=0)) + 2
        self.base, self.check = np.zeros(size, dtype=np.int64), np.full(size, -1, dtype=np.int64)
        self.used = 1  # slots from here on are free
        self.check[0] = 0
        state = np.zeros(len(codes), dtype=np.int64)
        same = np.zeros(len(codes), dtype=bool)
        same[1:] = True
        for col in codes.T:
            same[1:] &= col[1:] == col[:-1]
            new = (col > 0) & ~same
            at = np.flatnonzero(new)
            slots = self._place(state[at], col[at])
            state = np.where(col > 0, slots[np.cumsum(new) - 1] if len(at) else 0, state)
        self.check[0] = -1

    def _room(self, size: int) -> None:
        if size > len(self.check):
            more = max(size, 2 * len(self.check)) - len(self.check)
            self.base = np.concatenate([self.base, np.zeros(more, dtype=np.int64)])
            self.check = np.concatenate([self.check, np.full(more, -1, dtype=np.int64)])

    def _place(self, parent: np.ndarray, code: np.ndarray) -> np.ndarray:
        """Slots of the children (parents in runs); sets BASE and CHECK."""
        slots = np.zeros(len(parent), dtype=np.int64)
        if not len(parent):
            return slots
        start = np.flatnonzero(np.r_[True, parent[1:] != parent[:-1]])
        size = np.diff(np.r_[start, len(parent)])
        holes = np.flatnonzero(self.check[: self.used] < 0)
        for a, n in zip(start[size > 1], size[size > 1], strict=True):
            codes = code[a: a + n]
            least, most = int(codes.min()), int(codes.max())
            fits = holes[np.searchsorted(holes, least, side="right"):] - least
            self._room(self.used + most + 2)
            for c in np.sort(codes):
                if not len(fits):
                    break
                fits = fits[self.check[fits + c] < 0]
            base = int(fits[0]) if len(fits) else max(1, self.used - least)
            self._room(base + most + 1)
            self.base[parent[a]] = base
            slots[a: a + n] = base + codes
            self.check[base + codes] = parent[a]
            self.used = max(self.used, base + most + 1)
            if len(fits):
                holes = holes[self.check[holes] < 0]
        one = start[size == 1]
        if len(one):  # single children go side by side behind what is used
            at = max(self.used, int(code[one].max()) + 1) + np.arange(len(one))
            self._room(int(at[-1]) + 1)
            self.base[parent[one]] = at - code[one]
            slots[one] = at
            self.check[at] = parent[one]
            self.used = int(at[-1]) + 1
        return slots

    def walk(self, codes: np.ndarray) -> np.ndarray:
        """The state after each code; -1 where a row has ended."""
        state = np.zeros(len(codes), dtype=np.int64)
        out = np.full(codes.shape, -1, dtype=np.int64)
        for k, col in enumerate(codes.T):
            on = np.flatnonzero(col > 0)
            to = self.base[state[on]] + col[on]
            if (self.check[to] != state[on]).any():
                raise AssertionError("a segment is not in its trie")
            state[on] = out[on, k] = to
        return out


def shard_nodes(band: np.ndarray, p1: np.ndarray, p2: np.ndarray, segs: list[bytes],
                sums: dict[str, np.ndarray], least: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """The nodes of one shard of sorted distinct segments.  ``sums`` are added up
    over the segments of a node, of ``least`` the smallest is taken."""
    n = np.array([len(s) for s in segs]) // TOKEN
    width = int(n.max(initial=0))
    flat = np.frombuffer(b"".join(segs), dtype=f"S{TOKEN}")
    tokens, ids, times = np.unique(flat, return_inverse=True, return_counts=True)
    dense = np.empty(len(tokens), dtype=np.int64)
    dense[np.argsort(-times, kind="stable")] = 1 + np.arange(len(tokens))
    codes = np.zeros((len(segs), 1 + width), dtype=np.int64)
    new = np.r_[True, (band[1:] != band[:-1]) | (p1[1:] != p1[:-1]) | (p2[1:] != p2[:-1])]
    codes[:, 0] = np.cumsum(new)
    at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    rows = np.repeat(np.arange(len(segs)), n)
    codes[rows, 1 + at] = dense[ids]
    size = np.zeros((len(segs), 1 + width), dtype=np.int64)
    size[rows, 1 + at] = np.frombuffer(b"".join(segs), dtype=np.uint8).reshape(-1, TOKEN)[:, -4:].copy().view(">u4").ravel()

    trie = DoubleArray(codes)
    states = trie.walk(codes)
    children = np.bincount(trie.check[trie.check >= 0], minlength=len(trie.check))
    out: dict[str, list] = {k: [] for k in ("depth", "k1", "k2", "q1", "q2", "bytes", "children", "shared", "copies", *sums, *least)}
    above = None
    for k in range(1 + width):
        on = np.flatnonzero(states[:, k] >= 0)
        s = states[on, k]
        first = np.flatnonzero(np.r_[True, s[1:] != s[:-1]])
        head = on[first]  # the first segment of each node
        names = np.array([_names(int(band[r]), segs[r][: TOKEN * k]) if k else (0, 0) for r in head], dtype=np.int64)
        key = np.column_stack([p1[head], p2[head]]) ^ names
        counted = (k > 0) | (band[head] == 0)  # elsewhere the segment before has counted this node
        out["depth"].append(band[head] * TURNS + k)
        out["k1"].append(key[:, 0])
        out["k2"].append(key[:, 1])
        of = np.zeros((len(segs), 2), dtype=np.int64)
        of[head] = key
        if k:
            leads = np.maximum.accumulate(np.where(states[:, k - 1] >= 0, above[1], -1))
            out["q1"].append(above[0][leads[head], 0])
            out["q2"].append(above[0][leads[head], 1])
        else:
            out["q1"].append(np.zeros(len(head), dtype=np.int64))
            out["q2"].append(np.zeros(len(head), dtype=np.int64))
        lead = np.zeros(len(segs), dtype=np.int64) - 1
        lead[head] = head
        above = (of, lead)
        state = s[first]
        out["bytes"].append(np.where(counted, size[head, k], 0))
        out["children"].append(children[state])
        border = (state == states[0, k]) | (state == states[-1, k])
        out["shared"].append(border | (k in (0, TURNS)))
        out["copies"].append(counted.astype(np.int64))
        for name, v in sums.items():
            out[name].append(np.where(counted, np.add.reduceat(v[on], first), 0))
        for name, v in least.items():
            out[name].append(np.where(counted, np.minimum.reduceat(v[on], first), FAR))
    return {k: np.concatenate(v) for k, v in out.items()}


def _walked(distinct: DataFrame, sums: list[str], least: list[str]) -> DataFrame:
    """Deal distinct segments out by range, one trie per Arrow batch."""
    names = ["band", "p1", "p2", "seg", *sums, *least]
    kept = ["depth", "k1", "k2", "q1", "q2", "bytes", "children", "shared", "copies", *sums, *least]

    def walk(batches):
        for b in batches:
            if b.num_rows:
                c = dict(zip(names, b.columns, strict=True))
                n = lambda k: c[k].to_numpy(zero_copy_only=False)
                got = shard_nodes(n("band"), n("p1"), n("p2"), c["seg"].to_pylist(),
                                  {k: n(k) for k in sums}, {k: n(k) for k in least})
                yield pa.RecordBatch.from_arrays([pa.array(got[k]) for k in kept], names=kept)

    keys = ["band", "p1", "p2", "seg"]
    schema = ", ".join(f"{k} {'boolean' if k == 'shared' else 'long'}" for k in kept)
    return distinct.select(*names).repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(walk, schema)


# ------------------------------------------------------------------ nodes
KEY = ["depth", "k1", "k2"]
SEGMENT = ["band", "p1", "p2", "h1", "h2"]


def _merged(raw: DataFrame) -> DataFrame:
    """Nodes with whole sums: those shared by shards are merged by name, and a
    child that lies in several shards counts once."""
    inner = raw.filter(~F.col("shared")).select(*KEY, "q1", "q2", "bytes", "children", "n", "conv")
    top = raw.filter("shared").groupBy(*KEY).agg(
        *[F.max(F.when(F.col("copies") > 0, F.col(c))).alias(c) for c in ("q1", "q2")], F.max("bytes").alias("bytes"),
        F.sum("children").alias("children"), F.sum("n").alias("n"), F.min("conv").alias("conv"), F.sum("copies").alias("copies"))
    twice = top.filter("copies > 1 and depth > 0").groupBy(
        (F.col("depth") - 1).alias("depth"), F.col("q1").alias("k1"), F.col("q2").alias("k2")).agg(
        F.sum(F.col("copies") - 1).alias("twice"))
    top = top.join(twice, KEY, "left").withColumn("children", F.col("children") - F.coalesce("twice", F.lit(0)))
    return inner.unionByName(top.select(*inner.columns))


def _hash_ids(batches):
    """The SHA-256 of each node's strings of ids, which come in order."""
    now, h, out = None, None, []

    def flush():
        cols = list(zip(*out, strict=True)) if out else [(), (), (), ()]
        return pa.RecordBatch.from_arrays([*(pa.array(c, type=pa.int64()) for c in cols[:3]), pa.array(cols[3], type=pa.string())],
                                          names=[*KEY, "ends"])
    for b in batches:
        for depth, k1, k2, ids in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if (depth, k1, k2) != now:
                if now is not None:
                    out.append((*now, h.hexdigest()))
                now, h = (depth, k1, k2), hashlib.sha256(ids.encode())
            else:
                h.update(b"," + ids.encode())
        yield flush()
        out = []
    if now is not None:
        out.append((*now, h.hexdigest()))
        yield flush()


def _ends(segs: DataFrame) -> DataFrame:
    """``(depth, k1, k2, ends)``: the hash of the ids of the conversations that end
    at a node."""
    last = segs.filter(F.col("band") == F.floor(F.greatest(F.col("n_all") - 1, F.lit(0)) / TURNS))
    own = [F.when(F.col("n_all") == 0, F.col(f"p{k}")).otherwise(F.col(f"p{k}").bitwiseXOR(F.col(f"h{k}"))).alias(f"k{k}") for k in (1, 2)]
    last = last.select(F.col("n_all").cast("long").alias("depth"), *own, "conv_id")
    ids = last.groupBy(*KEY, F.shiftright("conv_id", IDS).alias("at")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda x: x.cast("string")), ",").alias("ids"))
    return ids.repartition(*KEY).sortWithinPartitions(*KEY, "at").select(*KEY, "ids").mapInArrow(
        _hash_ids, "depth long, k1 long, k2 long, ends string")


def _owned(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The nodes with ``above``, what their conversation owns above them, and
    ``is_top``; and per conversation what it owns: ``saved`` and ``leaves``."""
    d = nodes.withColumn("saved", (F.col("n") - 1) * F.col("bytes")).withColumn("run", F.shiftright("depth", OWN))
    run = Window.partitionBy("conv", "run").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    totals = d.groupBy("conv", "run").agg(F.sum("saved").alias("s"), F.min("depth").alias("top"),
                                          F.sum((F.col("children") == 0).cast("long")).alias("leaves"))
    whole = Window.partitionBy("conv")
    upto = whole.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("conv", "run", F.coalesce(F.sum("s").over(upto), F.lit(0)).alias("base"),
                           F.min("top").over(whole).alias("top"), F.sum("s").over(whole).alias("saved"),
                           F.sum("leaves").over(whole).alias("leaves")).checkpoint()
    d = d.withColumn("in_run", F.coalesce(F.sum("saved").over(run), F.lit(0))).drop("saved")
    d = d.join(totals.select("conv", "run", "base", "top"), ["conv", "run"])
    owned = d.select(*KEY, "q1", "q2", "n", "conv", "children", (F.col("base") + F.col("in_run")).alias("above"),
                     (F.col("depth") == F.col("top")).alias("is_top"))
    return owned, totals.groupBy("conv").agg(F.max("saved").alias("saved"), F.max("leaves").alias("leaves"))


def prefix_trie(conv: DataFrame) -> DataFrame:
    """The nodes of the trie of the rebuilt conversations: conv_id (the smallest
    member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and
    ends_sha256; with k1 and k2, which name the node at its depth."""
    segs = segments(conv).checkpoint()
    seg = F.first("seg").alias("seg")
    distinct = segs.groupBy(*SEGMENT).agg(seg, F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv"))
    nodes = _merged(_walked(distinct, ["n"], ["conv"]).checkpoint()).checkpoint()
    owned, totals = _owned(nodes)
    owned = owned.checkpoint()
    weighed = segs.select(*SEGMENT, "seg", F.col("conv_id").alias("conv")).join(totals, "conv")
    weighed = weighed.groupBy(*SEGMENT).agg(seg, F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves"))
    sums = _walked(weighed, ["saved", "leaves"], []).select(*KEY, "saved", "leaves")
    tops = owned.filter("is_top and depth > 0").select(
        *KEY, (F.col("depth") - 1).alias("d"), F.col("q1").alias("a1"), F.col("q2").alias("a2"))
    up = owned.select(F.col("depth").alias("d"), F.col("k1").alias("a1"), F.col("k2").alias("a2"), F.col("conv").alias("parent"))
    parents = tops.join(up, ["d", "a1", "a2"]).select(*KEY, "parent")
    mine = owned.select(*KEY, "conv", "n", "children", "above", F.when(~F.col("is_top"), F.col("conv")).alias("parent"))
    parts = mine.unionByName(sums, allowMissingColumns=True).unionByName(parents, allowMissingColumns=True).unionByName(
        _ends(segs), allowMissingColumns=True)
    whole = parts.groupBy(*KEY).agg(*[F.max(c).alias(c) for c in ("conv", "n", "children", "above", "parent", "ends")],
                                    *[F.sum(c).alias(c) for c in ("saved", "leaves")])
    return whole.select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"),
        (F.col("saved") - F.col("above")).alias("saved_tokens"),
        F.coalesce("ends", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"), "k1", "k2")
