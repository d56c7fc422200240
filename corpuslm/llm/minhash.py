"""Near-duplicate classes by ProbMinHash (operator 6).

A text is the set of its five-word shingles.  Each element sends arrivals of a
Poisson process at its weight's rate to random registers; a register keeps the
element that arrives first.  Arrivals come in rounds, and a round only follows
the elements that can still be earlier than the latest register (early
termination).  Two texts agree in a register with the probability Jaccard
similarity of their weighted sets.  Every shingle weighs 1, however often it
occurs: then that is the Jaccard similarity of the sets, which defines a link.
(With weights that grow with the counts, a copy that repeats a passage agrees in
any lower share of registers.)

Registers are cut into bands; texts that agree in a band share a bucket.  A
bucket's texts are linked to its first text only (a star), never all with all:

1. every star pair whose registers do not rule it out is verified exactly
   (Jaccard of the shingle sets, ``threshold`` or more);
2. verified pairs give connected components;
3. buckets that now lie in one component are done.  In the others the texts
   outside the bucket's largest component (the fringe) are compared with all
   its texts by their registers, and the pairs that pass are verified.  Fringe
   and bucket are dealt into chunks of about ``chunk`` texts, and each chunk of
   the one meets each chunk of the other in a task of its own, so that a bucket
   of any size is compared whole.  The work is fringe times bucket.

So no link is lost beyond the bands' own error: at similarity 0.8 a pair of
texts shares no band with probability (1 - 0.8**4)**24, about 3e-6.

Equal texts are one node from the first step on.  Nodes are MD5 digests of the
texts, so a null or repeated doc_id does no harm.

Defined results.  A null text is alone in its class; equal texts (also empty
or wordless ones) share a class; a text of fewer than five words, but not none,
is one shingle.  Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after
lower-casing A-Z.  A class is named by its least doc_id (null if it has none).
Repeated rows get a row each.  An empty table gives no rows.  Other columns are
ignored by ``classes`` and carried unchanged by ``keep_first``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslm.llm import vec


@dataclass(frozen=True)
class Params:
    words: int = 5
    threshold: float = 0.8
    bands: int = 24
    rows: int = 4
    registers: int = 192  # the first bands * rows of them form the bands, all of them rule pairs out
    min_agree: float = 0.7  # share of registers that agree, below which a pair is ruled out (3.5 deviations)
    chunk: int = 2048


# ------------------------------------------------------------ signatures
def _uniform(h: np.ndarray) -> np.ndarray:
    """A float in (0, 1] from a hash."""
    return ((h >> np.uint64(11)).astype(np.float64) + 1.0) * 2.0 ** -53


def prob_minhash(row: np.ndarray, elem: np.ndarray, weight: np.ndarray, rows: int, m: int) -> np.ndarray:
    """(rows, m) registers of element hashes; rows without elements are 0."""
    time = np.full(rows * m, np.inf)
    sig = np.zeros(rows * m, dtype=np.uint64)
    last = np.full(rows, np.inf)  # each row's latest register
    at = np.zeros(len(elem))
    k = 0
    while len(elem):
        r1 = vec.mix(elem + np.uint64((2 * k + 1) * 0x9E3779B97F4A7C15 % 2 ** 64))
        r2 = vec.mix(r1 ^ np.uint64(0xD6E8FEB86659FD93))
        at = at - np.log(_uniform(r1)) / weight
        reg = row * m + (r2 % np.uint64(m)).astype(np.int64)
        early = np.flatnonzero(at < time[reg])
        if len(early):
            # of several arrivals at one register the earliest counts
            order = early[np.lexsort((elem[early], at[early], reg[early]))]
            first = np.ones(len(order), dtype=bool)
            first[1:] = reg[order][1:] != reg[order][:-1]
            win = order[first]
            time[reg[win]] = at[win]
            sig[reg[win]] = elem[win]
            last = time.reshape(rows, m).max(axis=1) if rows else last
        go = at < last[row]
        row, elem, weight, at = row[go], elem[go], weight[go], at[go]
        k += 1
    return sig.reshape(rows, m)


def shingles(sl: vec.Slice, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, hash and count of the distinct shingles of each row."""
    s, e, first = sl.lower().words(vec.ALNUM_WORD)
    h = sl.hash_spans(s, e)
    n = np.diff(first)
    g, at = vec.grams(h, k, first)
    row = vec.row_index(first)[at]
    for size in range(1, k):  # texts of fewer words are one shingle
        few = np.flatnonzero(n == size)
        if len(few):
            acc = np.zeros(len(few), dtype=np.uint64)
            for j in range(size):
                acc += h[first[few] + j] * np.uint64(vec.mix_int(100 * size + j) | 1)
            row, g = np.concatenate([row, few]), np.concatenate([g, vec.mix(acc)])
    order = np.lexsort((g, row))
    row, g = row[order], g[order]
    new = np.ones(len(g), dtype=bool)
    new[1:] = (g[1:] != g[:-1]) | (row[1:] != row[:-1])
    start = np.flatnonzero(new)
    return row[start], g[start], np.diff(np.append(start, len(g)))


def _signer(p: Params):
    m = p.registers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sigs, bands = [], []
            for sl in vec.slices(b.column(2)):
                row, g, _ = shingles(sl, p.words)
                sig = prob_minhash(row, g, np.ones(len(g)), sl.rows, m)
                some = np.bincount(row, minlength=sl.rows) > 0
                low = sig.astype(np.uint16)  # 16 bits of each register are enough to rule pairs out
                key = np.zeros((sl.rows, p.bands), dtype=np.uint64)
                for j in range(p.rows):  # of the same bits, so that the bands that two texts share show in their sigs
                    key = vec.mix(key + low[:, j * p.bands: (j + 1) * p.bands].astype(np.uint64))
                key = vec.mix(key + np.arange(p.bands, dtype=np.uint64)).view(np.int64)
                for r in range(sl.rows):
                    sigs.append(low[r].tobytes() if some[r] else None)
                    bands.append(key[r] if some[r] else None)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(sigs, type=pa.binary()),
                 pa.array(bands, type=pa.list_(pa.int64()))], names=["doc_id", "node", "sig", "bands"])
    return run


def node_of(text: Column) -> Column:
    return F.unhex(F.md5(text))


# ------------------------------------------------------------ candidates
def _agree(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a == b).mean(axis=1)


def _rows_of(col: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), dtype=np.uint16).reshape(-1, width)


def _likely(p: Params):
    """Rows (a, b, sig of a, sig of b, k): those that are not ruled out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = _agree(_rows_of(b.column(2), p.registers), _rows_of(b.column(3), p.registers))
            yield b.filter(pa.array(ok >= p.min_agree)).select(["a", "b", "k"])
    return run


PAIRS_PER_BATCH = 100_000


def _fringe_pairs(p: Params):
    """Rows (items, band) of a fringe chunk and a bucket chunk each: pairs of a
    fringe text and a text of the bucket's chunk, of different components, that
    are not ruled out.  A pair that shares several bands is given by the first
    of them only: all buckets are compared whole."""
    def first_shared(same: np.ndarray) -> np.ndarray:
        return same[:, : p.bands * p.rows].reshape(-1, p.rows, p.bands).all(axis=1).argmax(axis=1)

    def batch(a: list, b: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(a, type=pa.binary()), pa.array(b, type=pa.binary())], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a_out, b_out = [], []
        for b in batches:
            for at in range(b.num_rows):
                items, band = b.column(0)[at].as_py(), b.column(1)[at].as_py()
                own = [x for x in items if x["own"]]
                if not own:
                    continue
                sig = np.frombuffer(b"".join(x["sig"] for x in own), dtype=np.uint16).reshape(len(own), -1)
                for x in items:
                    if not x["fringe"]:
                        continue
                    same = sig == np.frombuffer(x["sig"], dtype=np.uint16)
                    near = np.flatnonzero(same.mean(axis=1) >= p.min_agree)
                    for k in near[first_shared(same[near]) == band].tolist():
                        # of two fringe texts each meets the other: the lesser node gives the pair
                        if own[k]["comp"] != x["comp"] and not (own[k]["outer"] and own[k]["node"] < x["node"]):
                            a_out.append(x["node"])
                            b_out.append(own[k]["node"])
                    if len(a_out) >= PAIRS_PER_BATCH:
                        yield batch(a_out, b_out)
                        a_out, b_out = [], []
        yield batch(a_out, b_out)
    return run


def _verifier(p: Params):
    def sets(col: pa.Array) -> list[np.ndarray]:
        out = []
        for sl in vec.slices(col):
            row, g, _ = shingles(sl, p.words)
            cut = np.searchsorted(row, np.arange(sl.rows + 1))
            out += [g[cut[r]: cut[r + 1]] for r in range(sl.rows)]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep, known = [], {}
            names, other = b.column(0).to_pylist(), sets(b.column(3))
            todo = {x: i for i, x in enumerate(names)}  # a star's centre is read once a batch
            for (x, _), s in zip(todo.items(), sets(b.column(2).take(pa.array(list(todo.values()), type=pa.int64()))),
                                 strict=True):
                known[x] = s
            for x, t in zip(names, other, strict=True):
                s = known[x]
                both = len(np.intersect1d(s, t, assume_unique=True))
                keep.append(both >= p.threshold * (len(s) + len(t) - both))
            yield b.filter(pa.array(keep, type=pa.bool_())).select(["a", "b"])
    return run


def _verified(pairs: DataFrame, texts: DataFrame, p: Params) -> DataFrame:
    """The pairs (a, b) of nodes with similar texts.  ``texts`` has one row
    per document; a node's text may come several times, so it is taken from
    its first document."""
    left = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    right = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    return (pairs.join(left, "b").join(right, "a").select("a", "b", "text_a", "text_b")
            .mapInArrow(_verifier(p), "a binary, b binary"))


# ------------------------------------------------------------ components
LINKS_PER_TASK = 200_000


def components(links: DataFrame, n: int) -> DataFrame:
    """``(node, comp)`` of every node of the ``n`` links (a, b): alternating
    large and small stars until each component is one star; a node's rows are
    aggregated before they are shuffled, so a hub costs one row per task.  The
    number of tasks follows the number of links, which never grows."""
    tasks = max(links.sparkSession.sparkContext.defaultParallelism, n // LINKS_PER_TASK + 1)
    e = links.select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).filter("lo != hi").distinct()
    e = e.coalesce(tasks).checkpoint()
    while True:
        ends = e.select(F.col("lo").alias("u"), F.lit(0).alias("up")).unionByName(
            e.select(F.col("hi").alias("u"), F.lit(1).alias("up")))
        # no star yet: a node below several others, or between two
        if ends.groupBy("u").agg(F.sum("up").alias("up"), F.min("up").alias("least")).filter(
                "up > 1 or (up > 0 and least = 0)").isEmpty():
            break
        both = e.select(F.col("lo").alias("u"), F.col("hi").alias("v")).unionByName(
            e.select(F.col("hi").alias("u"), F.col("lo").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(least, "u").filter(F.col("v") > F.col("u"))
                 .select(F.col("m").alias("lo"), F.col("v").alias("hi")).filter("lo != hi")
                 .coalesce(tasks).distinct().coalesce(tasks))
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(least, "hi").coalesce(tasks)
        e = (small.select(F.col("m").alias("lo"), "hi").unionByName(
            small.select(F.col("m").alias("lo"), F.col("lo").alias("hi")))
            .filter("lo != hi").distinct().coalesce(tasks).checkpoint())
    return e.select(F.col("hi").alias("node"), F.col("lo").alias("comp")).unionByName(
        e.select(F.col("lo").alias("node"), F.col("lo").alias("comp")).distinct())


def _merged(comp: DataFrame | None, links: DataFrame, n: int) -> DataFrame:
    """The components once ``n`` more links hold: only the components that the
    links touch are joined into larger ones."""
    if comp is None:
        return components(links, n).checkpoint()
    named = _named(links, comp).select(F.col("c_a").alias("a"), F.col("c_b").alias("b"))
    over = components(named, n)
    renamed = over.select(F.col("node").alias("comp"), F.col("comp").alias("root"))
    old = comp.join(renamed, "comp", "left").select("node", F.coalesce("root", "comp").alias("comp"))
    return old.unionByName(over.join(comp.select("node"), "node", "left_anti")).checkpoint()


def similar_nodes(docs: DataFrame, p: Params) -> tuple[DataFrame, DataFrame]:
    """The signed rows (doc_id, node, ...) and the components of the nodes
    that have a partner."""
    d = docs.filter(F.col("text").isNotNull()).select("doc_id", node_of(F.col("text")).alias("node"), "text")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    signed = d.mapInArrow(_signer(p), f"doc_id {id_type}, node binary, sig binary, bands array<long>").checkpoint()
    nodes = (signed.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("sig").alias("sig"),
                                        F.first("bands").alias("bands"))
             .filter(F.col("sig").isNotNull()))
    alone = F.transform("bands", lambda x, i: F.struct(i.alias("no"), x.alias("key")))
    rows = nodes.select("node", F.explode(alone).alias("b")).select(
        F.col("b.key").alias("key"), F.col("b.no").alias("no"), "node")
    # buckets of two or more, with their heads
    size = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    rows = rows.join(size, "key").checkpoint()
    if rows.isEmpty():
        return signed, None
    score = rows.groupBy("node").agg(F.sum("n").alias("score"))
    heads = rows.join(score, "node").groupBy("key").agg(F.max(F.struct("score", "node")).alias("head")).select(
        "key", F.col("head.node").alias("head"))
    rows = rows.join(heads, "key").checkpoint()
    # signatures and texts of the nodes that share a bucket, one row each, by the node's least doc_id
    sigs = nodes.join(rows.select("node").distinct(), "node").select("node", "doc_id", "sig").checkpoint()
    wanted = _listed(sigs.select(F.col("node").alias("__node"), F.col("doc_id").alias("__id")))
    texts = (d.join(wanted, (F.col("node") == F.col("__node")) & F.col("doc_id").eqNullSafe(F.col("__id")))
             .dropDuplicates(["node", "doc_id"]).select("node", "text").checkpoint())
    star = rows.filter("node != head").groupBy(F.col("head").alias("a"), F.col("node").alias("b")).agg(
        F.count(F.lit(1)).alias("k"))
    star = _plausible(star, sigs, p).checkpoint()
    # a text has a head in each band, mostly the same few: the one it shares most bands with first, then
    # those that are still in another component
    best = star.groupBy("b").agg(F.max(F.struct("k", "a")).alias("m")).select(F.col("m.a").alias("a"), "b")
    comp = None
    for pairs in (best, star.select("a", "b")):
        comp = _linked(pairs, comp, texts, p)
    # the fringe of the buckets that still hold several components
    tagged = (rows.withColumn("comp", F.col("node")) if comp is None else
              rows.join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node")))
    per = tagged.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("c"))
    most = (per.groupBy("key").agg(F.max(F.struct("c", "comp")).alias("top"), F.count(F.lit(1)).alias("comps"))
            .filter("comps > 1").select("key", F.col("top.comp").alias("top"), F.col("top.c").alias("c")))
    left = tagged.join(most, "key").select("key", "no", "node", "comp", "n", (F.col("comp") != F.col("top")).alias(
        "outer"), (F.col("n") - F.col("c")).alias("q")).checkpoint()
    # chunk i of the fringe meets chunk j of the bucket
    chunks, parts = (F.ceil(F.col(c) / p.chunk).cast("int") for c in ("n", "q"))
    left = left.withColumn("chunks", chunks).withColumn("parts", parts).withColumn(
        "j", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")).withColumn(
        "i", F.pmod(F.xxhash64("node", F.lit(1)), F.col("parts")).cast("int"))
    as_own = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda x: F.struct(x.alias("i"), F.col("j").alias("j")))
    as_fringe = F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda x: F.struct(F.col("i").alias("i"), x.alias("j")))
    listed = (left.join(sigs.select("node", "sig"), "node")
              .withColumn("at", F.explode(F.when(F.col("outer"), F.array_union(as_own, as_fringe)).otherwise(as_own)))
              .groupBy("key", "no", "at").agg(F.collect_list(F.struct(  # about 2 * chunk rows
                  "node", "sig", "comp", "outer", (F.col("at.j") == F.col("j")).alias("own"),
                  (F.col("outer") & (F.col("at.i") == F.col("i"))).alias("fringe"))).alias("items"))
              .select("items", F.col("no").cast("int").alias("band")))
    pairs = listed.mapInArrow(_fringe_pairs(p), "a binary, b binary").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    return signed, _linked(pairs, comp, texts, p)


LISTED_ROWS = 200_000  # of two short columns: some 10 MB


def _listed(ids: DataFrame) -> DataFrame:
    """``ids`` (a checkpointed list of nodes and doc_ids), sent to all tasks if
    its counted rows are few; else both sides of a join are shuffled."""
    return F.broadcast(ids) if ids.count() <= LISTED_ROWS else ids


def _linked(pairs: DataFrame, comp: DataFrame | None, texts: DataFrame, p: Params) -> DataFrame | None:
    """The components once the pairs are verified too.  Pairs that are in one
    component already are left out first."""
    if comp is not None:
        pairs = _named(pairs, comp).filter("c_a != c_b").select("a", "b")
    pairs = pairs.checkpoint()
    if pairs.isEmpty():
        return comp
    new = _verified(pairs, texts, p).checkpoint()
    n = new.count()
    return _merged(comp, new, n) if n else comp


def _plausible(pairs: DataFrame, sigs: DataFrame, p: Params) -> DataFrame:
    """The pairs (a, b, k) that their registers do not rule out."""
    s = sigs.select("node", "sig")
    return (pairs.join(s.withColumnsRenamed({"node": "b", "sig": "sig_b"}), "b")
            .join(s.withColumnsRenamed({"node": "a", "sig": "sig_a"}), "a")
            .select("a", "b", "sig_a", "sig_b", "k").mapInArrow(_likely(p), "a binary, b binary, k long"))


def _named(pairs: DataFrame, comp: DataFrame) -> DataFrame:
    """The pairs with their components ``c_a`` and ``c_b``."""
    for side in ("a", "b"):
        c = comp.withColumnsRenamed({"node": side, "comp": f"c_{side}"})
        pairs = pairs.join(c, side, "left").withColumn(f"c_{side}", F.coalesce(f"c_{side}", side))
    return pairs


def classes(docs: DataFrame, params: Params = Params()) -> DataFrame:
    """One row per document row: doc_id, class_id (the least doc_id of its
    class) and is_first (it is that document)."""
    signed, comp = similar_nodes(docs, params)
    rows = signed.select("doc_id", "node")
    if comp is not None:
        rows = rows.join(comp, "node", "left").select("doc_id", F.coalesce("comp", "node").alias("comp"))
    else:
        rows = rows.select("doc_id", F.col("node").alias("comp"))
    # written, so that the join's stages can split a large class
    named = rows.groupBy("comp").agg(F.min("doc_id").alias("class_id")).checkpoint()
    out = rows.join(named, "comp").select("doc_id", "class_id")
    alone = docs.filter(F.col("text").isNull()).select("doc_id", F.col("doc_id").alias("class_id"))
    return out.unionByName(alone).withColumn("is_first", F.col("doc_id").eqNullSafe(F.col("class_id")))


def keep_first(docs: DataFrame, params: Params = Params()) -> DataFrame:
    """The rows of ``docs`` (all columns) without near duplicates: of each
    class the document of least doc_id stays, of repeated rows one.  Null
    texts all stay."""
    signed, comp = similar_nodes(docs, params)
    rows = signed.select("doc_id", "node")
    if comp is not None:
        rows = rows.join(comp, "node", "left").select("doc_id", "node", F.coalesce("comp", "node").alias("comp"))
    else:
        rows = rows.select("doc_id", "node", F.col("node").alias("comp"))
    # a null id sorts last
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "node")
    first = rows.groupBy("comp").agg(F.min(order).alias("m")).select(
        F.col("m.doc_id").alias("__id"), F.col("m.node").alias("__node"))
    named = docs.withColumn("__own", node_of(F.col("text")))
    kept = (named.join(first, (F.col("__own") == F.col("__node")) & F.col("doc_id").eqNullSafe(F.col("__id")))
            .dropDuplicates(["__own", "doc_id"]).select(*docs.columns))
    return kept.unionByName(docs.filter(F.col("text").isNull()))
