"""Train / validation split (SPL-*).

The corpus is the cleaned documents joined with ``\\n`` in ``doc_id`` order.
The reference cuts that one string at the last newline before
``int(len * ratio)``; here each document learns its character offset from a
two-level prefix sum, the cut position is one scalar, and every document is
labelled (and at most one cut in two) by a narrow projection.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpuslm.operators.order import prefix_sum


def with_doc_offsets(docs: DataFrame, key: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(key, len, start)``: length and character offset of every document in
    the joined corpus (separator newlines included).  Only the narrow
    ``(key, len)`` projection is shuffled, never the text."""
    d = docs.select(key, F.length(text_col).cast("long").alias("len"))
    return prefix_sum(d, key, F.col("len") + 1, "start")


def with_offsets(docs: DataFrame, key: str = "doc_id", text_col: str = "text") -> DataFrame:
    """SPL-01: ``(key, line_no, line, offset)`` for every line of the corpus.

    Line offsets inside a document are a running sum over that document's
    lines (a window partitioned by document); document offsets come from the
    two-level prefix sum and are joined on the key, so no window spans the
    corpus."""
    offs = with_doc_offsets(docs, key, text_col)
    lines = docs.select(key, F.posexplode(F.split(text_col, "\n", -1)).alias("line_no", "line"))
    w = Window.partitionBy(key).orderBy("line_no").rowsBetween(Window.unboundedPreceding, -1)
    local = F.coalesce(F.sum(F.length("line") + 1).over(w), F.lit(0))
    return (lines.withColumn("__local", local).join(offs.select(key, "start"), key)
                 .select(key, F.col("line_no").cast("long").alias("line_no"), "line",
                         (F.col("start") + F.col("__local")).cast("long").alias("offset")))


def split_point(docs: DataFrame, offs: DataFrame, ratio: float = 0.9, key: str = "doc_id",
                text_col: str = "text") -> dict:
    """SPL-02: total length, ``int(len * ratio)`` and the cut: the last
    newline before it, or -1 (then all but the last character is train).

    Newline candidates are the separators after every document but the last
    (a narrow aggregate) and the newlines of the one document holding
    position ``split_idx - 1`` (read by key).  Only scalars reach the driver.
    """
    agg = offs.agg(F.count(F.lit(1)).alias("n"), F.sum("len").alias("chars"),
                   F.max(key).alias("last")).first()
    n = agg["n"] or 0
    total = (agg["chars"] or 0) + max(n - 1, 0)
    split_idx = int(total * ratio)
    sep = F.col("start") + F.col("len")
    best = offs.agg(
        F.max(F.when((sep < split_idx) & (F.col(key) != F.lit(agg["last"])), sep)).alias("sep"),
        F.max_by(F.struct(key, "start"),
                 F.when((F.col("start") <= split_idx - 1) & (sep >= split_idx - 1), F.col("start"))
                 ).alias("holder"),
    ).first()
    p = best["sep"] if best["sep"] is not None else -1
    holder = best["holder"]
    if holder is not None and holder[key] is not None:
        h_start = holder["start"]
        head = F.substring(text_col, 1, split_idx - h_start)
        from_end = F.instr(F.reverse(head), "\n")
        row = (docs.filter(F.col(key) == F.lit(holder[key]))
                   .select(F.when(from_end > 0, F.length(head) - from_end).alias("q")).first())
        if row is not None and row["q"] is not None:
            p = max(p, h_start + int(row["q"]))
    c = p if p >= 0 else max(total - 1, 0)
    return {"total_chars": total, "split_idx": split_idx, "split_point": int(p), "cut": c}


def split_corpus(docs: DataFrame, ratio: float = 0.9, key: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """SPL-03: ``(key, split, text)`` pieces.  ``train`` text is the ``train``
    pieces joined with ``\\n`` in key order, ``val`` likewise; the val text
    starts with the newline at the cut (carried by its first piece).

    The order is the key, so one document holds the cut: those before it are
    train, those after it val.  Both filters compare the key with a literal
    (pushed to the scan) and no text is joined or shuffled.  ``docs`` is read
    three times (lengths, the cut document, the pieces); materialise it first
    when it is expensive (``checkpoint``)."""
    offs = with_doc_offsets(docs, key, text_col)
    c = split_point(docs, offs, ratio, key, text_col)["cut"]
    at = offs.agg(F.max_by(F.struct(key, "start", "len"), F.when(F.col("start") <= c, F.col("start"))).alias("held"),
                  F.min(F.when(F.col("start") > c, F.col(key))).alias("next")).first()
    if at["held"] is None:  # no documents
        return docs.limit(0).select(key, F.lit("train").alias("split"), F.col(text_col))
    k, t = F.col(key), F.col(text_col)
    held, n = at["held"][key], c - at["held"]["start"]  # n characters of the document at the cut are train
    train = docs.filter(k <= held).select(
        key, F.lit("train").alias("split"), F.when(k == held, F.substring(t, 1, n)).otherwise(t).alias(text_col))
    if n < at["held"]["len"]:
        val = docs.filter(k >= held).select(key, F.lit("val").alias("split"), F.when(
            k == held, F.substring(t, n + 1, 2147483647)).otherwise(t).alias(text_col))
    else:  # the cut is the newline before the next document
        first = F.lit(False) if at["next"] is None else k == at["next"]
        val = docs.filter(k > held).select(key, F.lit("val").alias("split"), F.when(
            first, F.concat(F.lit("\n"), t)).otherwise(t).alias(text_col))
    return train.unionByName(val)


def split_report(pieces: DataFrame, text_col: str = "text") -> DataFrame:
    """SPL-04: characters, bytes and MB per split plus a total row (rollup).
    Separators between pieces count one character / byte each."""
    per = pieces.groupBy("split").agg(
        (F.sum(F.length(text_col)) + F.count(F.lit(1)) - 1).cast("long").alias("chars"),
        (F.sum(F.octet_length(text_col)) + F.count(F.lit(1)) - 1).cast("long").alias("bytes"))
    tot = per.agg(F.lit("total").alias("split"), F.sum("chars").cast("long").alias("chars"),
                  F.sum("bytes").cast("long").alias("bytes"))
    both = per.unionByName(tot)
    return both.withColumn("mb", F.round(F.col("bytes") / F.lit(1048576.0), 6))
