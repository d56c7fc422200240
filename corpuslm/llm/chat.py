"""Chat formatting by collapse of cumulative snapshots (operator 1), with
DataFrame functions only.

Chat logs often hold a conversation again after every turn.  A conversation
that is a prefix of a longer one is a snapshot and goes; of equal conversations
the one of least id stays; the others are rendered.

Rolling prefix hashes tell prefixes: a turn's hash takes its place, role and
text, and a prefix's hash is the sum of its turns' hashes (two sums of 64-bit
hashes, exact in decimals).  Sums need no order, so they are formed in two
levels: within runs of ``RUN`` turns and over the runs' totals.  Prefix hashes
are made distinct per task before the shuffle, so a first turn shared by a third
of all conversations is one row per task.

Places come from two-level sums too.  Equal rows are counted first.  A run is
``RUN`` turn numbers, or, where those hold more than twice as many distinct rows
(a null conv_id, a number or null in many rows), one number and a range of
hashes, as many ranges as its rows need.  So no task holds the turns of more
than about two runs of one conversation in order, besides the totals of its runs.

A long conversation is rendered in parts of ``RUN`` turns by place.

Defined results.  Turns are ordered by number; turns of equal number by their
hashes; a null number comes first.  A null role or text renders as empty but
differs from an empty one.  Rows with a null conv_id form one conversation.
Repeated rows are turns like others.  An empty table gives no rows.  Other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RUN = 256
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def _hash(*cols: Column, seed: int) -> Column:
    flags = [c.isNull() for c in cols]
    return F.xxhash64(F.lit(seed), *[F.coalesce(c, F.lit("")) for c in cols], *flags)


def _turns(conv: DataFrame) -> DataFrame:
    t = conv.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text")
    return t.withColumn("a", _hash(F.col("role"), F.col("text"), seed=1)).withColumn(
        "b", _hash(F.col("role"), F.col("text"), seed=2))


def _same(names: list[str]) -> Column:
    """Equal to the columns of these names with a ``__`` before, null to null."""
    out = F.lit(True)
    for k in names:
        out = out & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return out


def _other(d: DataFrame, names: list[str]) -> DataFrame:
    return d.withColumnsRenamed({k: f"__{k}" for k in names})


TURN = ["conv_id", "turn", "a", "b"]


def _placed(turns: DataFrame) -> DataFrame:
    """One row per distinct turn (conv_id, turn, a, b): n (its equal rows),
    start (the first one's place from 0), n_all and n_null (the conversation's
    rows, and those without a number, which come first)."""
    run, zero = ["conv_id", "part", "number", "range"], F.lit(0).cast("long")
    cells = turns.groupBy(*TURN).agg(F.count(F.lit(1)).alias("n")).withColumn("part", F.floor(F.col("turn") / RUN))
    rows = cells.groupBy("conv_id", "part", "turn").agg(F.count(F.lit(1)).alias("m"))  # RUN numbers a part at most
    large = rows.withColumn("in_part", F.sum("m").over(Window.partitionBy("conv_id", "part"))).filter(
        F.col("in_part") > 2 * RUN).select("conv_id", "turn", F.ceil(F.col("m") / RUN).alias("k"))
    cells = cells.join(_other(large, ["conv_id", "turn"]), _same(["conv_id", "turn"]), "left")
    share = F.col("a").cast("double") / 2.0 ** 64 + 0.5  # hashes are even, and ascend with their ranges
    at = F.least(F.floor(share * F.col("k")), F.col("k") - 1)
    cells = cells.select(*TURN, "n", "part", F.when(F.col("k").isNotNull(), F.col("turn")).alias("number"),
                         F.coalesce(at, zero).alias("range")).checkpoint()
    whole = Window.partitionBy("conv_id")
    before = whole.orderBy(F.col("part").asc_nulls_first(), F.col("number").asc_nulls_first(), "range").rowsBetween(
        Window.unboundedPreceding, -1)
    totals = cells.groupBy(*run).agg(F.sum("n").alias("total"))
    totals = totals.select(*run, F.coalesce(F.sum("total").over(before), zero).alias("base"),
                           F.sum("total").over(whole).alias("n_all"),
                           F.coalesce(F.sum(F.when(F.col("part").isNull(), F.col("total"))).over(whole), zero).alias("n_null"))
    in_run = Window.partitionBy(*run).orderBy(F.col("turn").asc_nulls_first(), "a", "b").rowsBetween(
        Window.unboundedPreceding, -1)
    return (cells.withColumn("r", F.coalesce(F.sum("n").over(in_run), zero)).join(_other(totals, run), _same(run))
            .select(*TURN, "n", (F.col("base") + F.col("r")).alias("start"), "n_all", "n_null"))


def prefixes(conv: DataFrame) -> DataFrame:
    """One row per turn: conv_id, pos (1-based place), s1, s2 (the hash of the
    prefix that ends here) and is_last."""
    # each equal row has its place; listed in two steps, so that no list is long
    t = _placed(_turns(conv)).withColumn("x", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(RUN).cast("long"))))
    t = t.withColumn("x", F.explode(F.sequence("x", F.least(F.col("x") + RUN, "n") - 1)))
    t = t.withColumn("pos", F.col("start") + F.col("x") + 1).withColumn("is_last", F.col("pos") == F.col("n_all"))
    t = t.withColumn("part", F.floor((F.col("pos") - 1) / RUN))
    t = t.select("conv_id", "part", "pos", "is_last",
                 *[F.xxhash64("pos", k).cast("decimal(20,0)").alias(f"x{k}") for k in "ab"])
    running = Window.partitionBy("conv_id", "part").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    t = t.select("*", *[F.sum(f"x{k}").over(running).alias(f"s{k}") for k in "ab"])
    totals = t.groupBy("conv_id", "part").agg(F.sum("xa").alias("ta"), F.sum("xb").alias("tb"))
    upto = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("decimal(38,0)")
    base = totals.select("conv_id", "part", F.coalesce(F.sum("ta").over(upto), zero).alias("ba"),
                         F.coalesce(F.sum("tb").over(upto), zero).alias("bb"))
    key = ["conv_id", "part"]
    return t.join(_other(base, key), _same(key)).select("conv_id", "pos", "is_last", (F.col("sa") + F.col("ba")).cast(
        "decimal(38,0)").alias("s1"), (F.col("sb") + F.col("bb")).cast("decimal(38,0)").alias("s2"))


def maximal(conv: DataFrame) -> DataFrame:
    """``(conv_id, n_turns, n_copies)`` of the conversations that are no prefix
    of a longer one; n_copies counts the equal ones."""
    p = prefixes(conv).checkpoint()
    key = ["pos", "s1", "s2"]
    whole = p.filter("is_last").groupBy(*key).agg(F.min(F.struct(F.col("conv_id").isNull(), "conv_id")).alias("m"),
                                                  F.count(F.lit(1)).alias("n_copies"))
    inner = p.filter(~F.col("is_last")).select(*key).distinct()
    return whole.join(inner, key, "left_anti").select(F.col("m.conv_id").alias("conv_id"),
                                                      F.col("pos").alias("n_turns"), "n_copies")


def render(conv: DataFrame, chosen: DataFrame) -> DataFrame:
    """The chosen conversations as text: one row per conv_id and part.  A part
    has RUN turns at most, by place: numbered turns are in parts 0, 1 and so on,
    turns without a number in parts that end with -1."""
    one = F.concat(F.lit(OPEN), F.coalesce("role", F.lit("")), F.lit("\n"), F.coalesce("text", F.lit("")),
                   F.lit(CLOSE + "\n"))
    t = _turns(conv).join(_other(chosen.select("conv_id", "n_turns", "n_copies"), ["conv_id"]), _same(["conv_id"]))
    texts = t.groupBy(*TURN).agg(F.first(one).alias("t"), F.first("n_turns").alias("n_turns"),
                                 F.first("n_copies").alias("n_copies"))  # of equal rows one
    d = texts.join(_other(_placed(t.select(*TURN)), TURN), _same(TURN))
    begin, end = F.col("start") - F.col("n_null"), F.col("start") - F.col("n_null") + F.col("n")
    d = d.withColumn("part", F.explode(F.sequence(F.floor(begin / RUN), F.floor((end - 1) / RUN))))
    low, high = F.greatest(begin, F.col("part") * RUN), F.least(end, (F.col("part") + 1) * RUN)
    parts = d.groupBy("conv_id", "n_turns", "n_copies", "part").agg(F.array_sort(F.collect_list(F.struct(
        low.alias("at"), F.expr("t"), (high - low).cast("int").alias("copies")))).alias("x"))
    return parts.select("conv_id", "part", "n_turns", "n_copies", F.array_join(
        F.transform("x", lambda s: F.repeat(s["t"], s["copies"])), "").alias("text"))


def format_chats(conv: DataFrame) -> DataFrame:
    """Collapse, then render."""
    return render(conv, maximal(conv))
