"""Cleaning in corpus scope: the documents as one text, joined with ``\\n`` in
key order, as if one string were cleaned.

It differs from document scope only where documents meet: a document's first
non-blank line may repeat the last one before it, blank lines of two documents
may meet, and only the ends of the whole text are stripped.  So each document is
cleaned by itself and learns two things from the documents before it: the last
non-blank line (its MD5) and whether the last line is empty.  Both are carried
by two-level windows over narrow columns; no text is shuffled.

A tag may begin in one document and end in a later one.  Read from its start, a
document either leaves the reader where it was (it has no ``>`` and opens no tag),
or inside a tag, or outside, whatever the reader's state before: after its last
``>`` the reader is outside in any case.  So the state before a document is what the
last document that sets it says, which the same two-level windows carry.  Only
documents that such a tag touches are brought together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslm.functions.text import DOC_OPEN, WS, strip_ws
from corpuslm.operators import clean as C
from corpuslm.operators.order import last_before, prefix_sum

FEW_KEYS = 500_000  # keys sent to all tasks, about 10 MB; more are joined by a shuffle


def _marked(docs: DataFrame, keys: DataFrame, key: str, flag: str) -> DataFrame:
    """``docs`` with ``flag``: whether the key is one of ``keys``."""
    keys = keys.select(key).withColumn(flag, F.lit(True)).checkpoint()
    if keys.count() <= FEW_KEYS:
        keys = F.broadcast(keys)
    return docs.join(keys, key, "left").withColumn(flag, F.coalesce(flag, F.lit(False)))


def _without_first(lines: Column, at: Column, drop: Column) -> Column:
    return F.when(drop, F.filter(lines, lambda x, i: i != at)).otherwise(lines)


def _single_blanks(lines: Column) -> Column:
    """Runs of empty lines become one."""
    return C.let(lines, lambda ls: F.filter(ls, lambda x, i: (x != "") | (i == 0) | (F.get(ls, i - 1) != "")))


OPENED = "<doc(?:" + WS + r"|\z)"  # a tag that no > closes; at the end of a document a newline follows


def strip_open_joined(docs: DataFrame, key: str = "doc_id", text_col: str = "text") -> DataFrame:
    """CLN-01 in corpus scope: ``(key, text)`` without ``<doc ...>`` tags, those
    over several documents included.  The documents that such a tag joins become
    one row under the first one's key.  Texts are not null."""
    k, t = F.col(key), F.col(text_col)
    tail = F.substring_index(t, ">", -1)  # behind the last >, or the whole text
    closes, opens = F.contains(t, F.lit(">")), F.rlike(tail, F.lit(OPENED))
    marks = docs.select(key, closes.alias("closes"), F.when(closes, opens).when(opens, F.lit(True)).alias("state")).checkpoint()
    facts = marks.agg(F.max(F.when(F.col("closes"), k)).alias("last"), F.bool_or("state").alias("any")).first()
    if facts["last"] is None or not facts["any"]:
        return docs.select(key, C.strip_doc_open(t).alias("text"))
    last = F.lit(facts["last"])  # a tag that is open behind the last > is no tag
    seen = last_before(marks, key, "state", "before").withColumn("inside", F.coalesce("before", F.lit(False)) & (k <= last))
    seen = seen.withColumn("open", F.coalesce("state", "before", F.lit(False)) & (k < last))
    seen = last_before(seen.withColumn("outside", F.when(~F.col("inside"), k)).checkpoint(), key, "outside", "earlier")
    chain = seen.filter(F.col("inside") | F.col("open")).select(
        key, "inside", "open", F.coalesce("outside", "earlier").alias("head")).checkpoint()
    if chain.count() <= FEW_KEYS:
        chain = F.broadcast(chain)
    d = docs.select(key, t.alias("text")).join(chain, key, "left")
    t = F.col("text")
    tail = F.substring_index(t, ">", -1)
    front = F.when(F.col("inside"), F.expr("substring(text, length(substring_index(text, '>', 1)) + 2)")).otherwise(t)
    front = F.substring(front, F.lit(1), F.greatest(F.length(front) - F.length(tail), F.lit(0)))
    cut = F.when(F.col("open"), F.regexp_replace(tail, OPENED + r"[\s\S]*", "")).otherwise(tail)
    gone = F.col("inside") & ~F.contains(t, F.lit(">"))
    piece = F.when(gone, F.lit("")).otherwise(F.concat(F.regexp_replace(front, DOC_OPEN, ""), cut))
    alone = d.filter(F.col("head").isNull()).select(key, C.strip_doc_open(t).alias("text"))
    joined = d.filter(F.col("head").isNotNull()).select("head", key, piece.alias("text")).groupBy("head").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(key, "text"))), lambda x: x["text"]), "").alias("text"))
    return alone.unionByName(joined.select(F.col("head").alias(key), "text"))


def clean_joined(docs: DataFrame, key: str = "doc_id", text_col: str = "text", lowercase: bool = False,
                 min_len: int = 10) -> DataFrame:
    """CLN-01/04/06/10/13/14 in corpus scope: ``(key, text)``, the lines that each
    document gives to the cleaned corpus; the corpus is these texts joined with
    ``\\n`` in key order.  Documents that give no line have no row.  A null text
    gives none; the key is a unique integer."""
    t = F.col("text")
    tagless = C.squeeze_blank(C.blank_url_lines(C.strip_doc_close(t)))
    d = (strip_open_joined(docs.filter(F.col(text_col).isNotNull()), key, text_col).select(key, C.dedup_adjacent_lines(C.split_lines(tagless)).alias("lines"))
             .checkpoint())
    # a line that repeats the last non-blank line of the documents before
    at = F.when(F.col("lines")[0] == "", F.lit(1)).otherwise(F.lit(0))  # one blank line at most comes first

    def digest(line: Column) -> Column:
        return F.when(line.isNotNull(), F.md5(strip_ws(line)))
    full = F.filter("lines", lambda x: x != "")
    ends = d.select(key, digest(F.get("lines", at)).alias("head"),
                    digest(F.get(full, F.size(full) - 1)).alias("tail")).checkpoint()
    seen = last_before(ends, key, "tail", "before")
    d = _marked(d, seen.filter(F.col("head") == F.col("before")), key, "__again")
    d = d.select(key, _without_first(F.col("lines"), at, F.col("__again")).alias("lines")).filter(F.size("lines") > 0)
    # Unicode and spaces, then empty lines
    d = C.nfkd_frame(d.select(key, F.array_join("lines", C.NL).alias("text")), "text")
    d = d.select(key, _single_blanks(C.split_lines(C.squeeze_spaces(F.col("text")))).alias("lines")).checkpoint()
    ends = d.select(key, (F.get("lines", F.lit(0)) == "").alias("head"),
                    (F.element_at("lines", -1) == "").alias("tail")).checkpoint()
    seen = last_before(ends, key, "tail", "before")
    d = _marked(d, seen.filter(F.col("head") & F.col("before")), key, "__again")
    lines = _without_first(F.col("lines"), F.lit(0), F.col("__again"))
    kept = F.filter(F.transform(lines, strip_ws), lambda x: (x == "") | (F.length(x) >= min_len))
    d = d.select(key, kept.alias("lines")).filter(F.size("lines") > 0).checkpoint()
    # the ends of the whole text
    some = F.when(F.exists("lines", lambda x: x != ""), F.col(key))
    edge = d.agg(F.min(some).alias("lo"), F.max(some).alias("hi")).first()
    if edge["lo"] is None:
        return d.limit(0).select(key, F.lit("").alias("text"))
    text = F.array_join("lines", C.NL)
    text = F.when(F.col(key) == edge["lo"], F.regexp_replace(text, r"\A\n+", "")).otherwise(text)
    text = F.when(F.col(key) == edge["hi"], F.regexp_replace(text, r"\n+\z", "")).otherwise(text)
    return d.filter(F.col(key).between(edge["lo"], edge["hi"])).select(
        key, (F.lower(text) if lowercase else text).alias("text"))


def corpus_lines(clean: DataFrame, key: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(line_no, line)`` of the joined corpus, line_no from 0."""
    lines = C.split_lines(F.col(text_col))
    first = prefix_sum(clean.select(key, F.size(lines).alias("__n")), key, "__n", "first")
    return (clean.join(first.select(key, "first"), key)
            .select("first", F.posexplode(lines).alias("i", "line"))
            .select((F.col("first") + F.col("i")).cast("long").alias("line_no"), "line"))
