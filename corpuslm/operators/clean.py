"""Text cleaning (CLN-*).

Every step works inside one row: a document is cleaned with regular
expressions on its text and higher-order functions on its array of lines.
No step shuffles, so cleaning is a narrow map stage that streams over any
number of documents (and runs unchanged on a stream, STR-01).

Step order (it matters; duplicates are found before NFKD and before
short lines are dropped):

 1. delete ``<doc ...>`` tags            7. drop control characters
 2. delete ``</doc>``                    8. squeeze runs of spaces
 3. blank lines that are one URL         9. three or more newlines -> two
 4. squeeze runs of blank lines         10. strip lines, drop short ones
 5. split into lines                    11. optional lower case
 6. drop a repeated non-blank line,     12. join and strip the text
    NFKD normalise
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslm.functions.text import (
    DOC_CLOSE, DOC_OPEN, NOT_WS, WS, nfkd_strip_control, nfkd_strip_control_py,
    strip_control_ascii, strip_ws,
)

NL = "\n"


# ---------------------------------------------------------------- CLN-01..04
def strip_doc_open(text: Column) -> Column:
    """CLN-01: remove ``<doc ...>`` opening tags; a tag may span lines."""
    return F.regexp_replace(text, DOC_OPEN, "")


def strip_doc_close(text: Column) -> Column:
    """CLN-02: remove ``</doc>``."""
    return F.replace(text, F.lit(DOC_CLOSE), F.lit(""))


def blank_url_lines(text: Column) -> Column:
    """CLN-03: a line that is exactly one ``http(s)://`` URL becomes empty.

    Python's MULTILINE ``^``/``$`` only know ``\\n``; Java's ``(?m)`` also
    breaks at U+2028 and friends, so the line edges are spelled out.
    """
    return F.regexp_replace(text, r"(?<![^\n])https?://" + NOT_WS + r"+(?![^\n])", "")


def squeeze_blank(text: Column) -> Column:
    """CLN-04: ``re.sub(r'^\\s*$', '', text, flags=re.M)``.

    ``\\s*`` may run over newlines, so every run of blank lines becomes a
    single empty line (also at both ends of the text).
    """
    return F.regexp_replace(text, r"(?<![^\n])" + WS + r"*(?![^\n])", "")


# ---------------------------------------------------------------- CLN-05/06
def split_lines(text: Column) -> Column:
    """CLN-05: ``text.split('\\n')`` keeping trailing empty strings."""
    return F.split(text, NL, -1)


def let(value: Column, body) -> Column:
    """Bind ``value`` once and use it several times inside ``body``.

    Catalyst inlines a column that a lambda references, so an array used at
    ``i-1`` and ``i-2`` would be rebuilt for every element; a one-element
    ``transform`` evaluates it exactly once per row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def dedup_adjacent_lines(lines: Column) -> Column:
    """CLN-06: drop a non-blank line whose stripped text equals the previous
    non-blank line's; empty lines always pass.

    Runs after CLN-04, so a blank line is ``''`` and never has a blank
    neighbour: the previous non-blank line is at ``i-1`` or ``i-2``.  That
    keeps the test O(1) per line instead of a scan.
    """
    pairs = F.transform(lines, lambda l: F.struct(l.alias("l"), strip_ws(l).alias("k")))

    def with_pairs(ps):
        def keep(p, i):
            k1 = F.get(ps, i - 1).getField("k")
            prev = F.when(k1 != "", k1).otherwise(F.get(ps, i - 2).getField("k"))
            k = p.getField("k")
            return (k == "") | (i == 0) | F.coalesce(prev != k, F.lit(True))
        return F.transform(F.filter(ps, keep), lambda p: p.getField("l"))
    return let(pairs, with_pairs)


def dedup_adjacent(text: Column) -> Column:
    return F.array_join(dedup_adjacent_lines(split_lines(text)), NL)


# ---------------------------------------------------------------- CLN-07/08
def nfkd(text: Column) -> Column:
    """CLN-07 + CLN-08 for any text (Arrow-batched helper, ASCII fast path)."""
    return nfkd_strip_control(text)


def strip_control(text: Column) -> Column:
    """CLN-08 for text known to be ASCII (native, stays in codegen)."""
    return strip_control_ascii(text)


# ---------------------------------------------------------------- CLN-09..13
def squeeze_spaces(text: Column) -> Column:
    """CLN-09: runs of U+0020 (not tabs) become one space."""
    return F.regexp_replace(text, " +", " ")


def squeeze_newlines(text: Column) -> Column:
    """CLN-10: three or more newlines become two."""
    return F.regexp_replace(text, r"\n{3,}", "\n\n")


def drop_short_lines(text: Column, min_len: int = 10) -> Column:
    """CLN-11: strip every line; keep it when empty or >= ``min_len`` code
    points.  Blank lines left next to each other stay (as in the reference)."""
    stripped = F.transform(split_lines(text), strip_ws)
    kept = F.filter(stripped, lambda l: (F.length(l) == 0) | (F.length(l) >= min_len))
    return F.array_join(kept, NL)


def lower(text: Column) -> Column:
    """CLN-12."""
    return F.lower(text)


def assemble(text: Column) -> Column:
    """CLN-13 (text form): strip the whole text."""
    return strip_ws(text)


# ---------------------------------------------------------------- CLN-14
def clean_before_nfkd(text: Column) -> Column:
    """Steps 1-6 (everything that runs before Unicode normalisation)."""
    t = strip_doc_close(strip_doc_open(text))
    t = squeeze_blank(blank_url_lines(t))
    return dedup_adjacent(t)


def clean_after_nfkd(text: Column, lowercase: bool = False, min_len: int = 10) -> Column:
    """Steps 8-12."""
    t = drop_short_lines(squeeze_newlines(squeeze_spaces(text)), min_len)
    if lowercase:
        t = F.lower(t)
    return assemble(t)


def nfkd_frame(df: DataFrame, col: str) -> DataFrame:
    """CLN-07/08 as its own plan node: Arrow batches through ``mapInPandas``.

    A scalar Python UDF stacked on the array expressions of steps 1-6 is
    collapsed into one projection and then fails to evaluate (IsNull inside a
    lambda); a map node is an explicit boundary and also works on streams.
    ASCII rows take a fast path inside the helper.
    """
    schema = df.schema

    def run(batches):
        for pdf in batches:
            pdf[col] = pdf[col].map(nfkd_strip_control_py, na_action="ignore")
            yield pdf
    return df.mapInPandas(run, schema)


def clean_corpus(df: DataFrame, text_col: str = "text", out_col: str = "text",
                 lowercase: bool = False, min_len: int = 10) -> DataFrame:
    """CLN-14: the whole cleaning, one row per document (document scope).

    Native steps 1-6, one Arrow pass for NFKD, native steps 8-12: two
    codegen'd projections around a map node, no shuffle.
    """
    # the intermediate replaces the input column when the output does, so
    # only one copy of each document crosses into Python
    stage = text_col if out_col == text_col else "__clean_mid"
    out = df.withColumn(stage, clean_before_nfkd(F.col(text_col)))
    out = nfkd_frame(out, stage)
    out = out.withColumn(out_col, clean_after_nfkd(F.col(stage), lowercase, min_len))
    return out if stage == out_col else out.drop(stage)


# ---------------------------------------------------------------- CLN-15..17
def artifact_counts(df: DataFrame, text_col: str = "text") -> DataFrame:
    """CLN-15: number of ``<doc ...>`` tags before cleaning."""
    return df.agg(F.coalesce(F.sum(F.regexp_count(F.col(text_col), F.lit(DOC_OPEN))),
                             F.lit(0)).cast("bigint").alias("doc_tags"))


def clean_report(raw: DataFrame, clean: DataFrame, key: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """CLN-16: characters before/after, removed, percent removed.

    Sums are taken per side first (two map-side aggregates), so nothing is
    joined row by row; an empty input gives NULL percent instead of the
    reference's division by zero.
    """
    before = raw.agg(F.coalesce(F.sum(F.length(text_col)), F.lit(0)).cast("bigint").alias("chars_before"))
    after = clean.agg(F.coalesce(F.sum(F.length(text_col)), F.lit(0)).cast("bigint").alias("chars_after"))
    r = before.crossJoin(after)  # two one-row frames
    removed = F.col("chars_before") - F.col("chars_after")
    return r.select(
        "chars_before", "chars_after", removed.alias("chars_removed"),
        F.round(F.try_divide(removed * 100.0, F.col("chars_before")), 6).alias("pct_removed"))


def explode_lines(df: DataFrame, key: str = "doc_id", text_col: str = "text") -> DataFrame:
    """CLN-05 as a table: ``(key, line_no, line)``, line_no from 0."""
    return df.select(key, F.posexplode(split_lines(F.col(text_col))).alias("line_no", "line"))


def sample_lines(clean: DataFrame, n: int = 10, width: int = 80, key: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """CLN-17: the first ``n`` lines of the cleaned corpus, cut to ``width``.

    Each document offers at most ``n`` lines before the global top-n
    (TakeOrderedAndProject), so the sort never sees the whole line table.
    """
    first = clean.select(
        key, F.posexplode(F.slice(split_lines(F.col(text_col)), 1, n)).alias("line_no", "line"))
    top = first.orderBy(key, "line_no").limit(n)
    return top.select(key, F.col("line_no").cast("bigint").alias("line_no"),
                      F.substring("line", 1, width).alias("line"))
