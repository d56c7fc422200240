"""Long texts in segments, so that one text of a third of the corpus is the work
of many tasks.

A text is cut where nothing that a later step looks at is crossed: between words
for encoding, between lines for cleaning in corpus scope.  A segment has a number
of its own that follows (document, place in the document), so whatever takes rows in
key order takes segments instead of documents: ``bpe.encode_corpus``, ``token_runs``,
``token_stream``, ``clean_joined`` and ``words.word_freq`` run unchanged with ``segment``
as their key, and prefix sums over it put the pieces together.

Texts up to ``size`` stay where they are; only the segments of longer ones are moved.
Null and empty texts are one segment as they are.  Keys are unique integers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslm.functions.text import WORD
from corpuslm.operators.clean import let
from corpuslm.session import stored

SIZE = 1 << 20  # code points


def _numbered(docs: DataFrame, key: str, text: Column, size: int, pieces) -> DataFrame:
    """``(key, seg, segment, text)``, longer texts cut by ``pieces`` and spread over tasks."""
    d = docs.select(F.col(key), text.alias("text"))
    long = F.coalesce(F.char_length("text") > size, F.lit(False))
    short = d.filter(~long).select(key, F.lit(0).alias("seg"), "text")
    cut = stored(d.filter(long).select(key, F.posexplode(pieces(F.col("text"))).alias("seg", "text"))
                 .repartition(key, "seg"))
    facts = cut.agg(F.max("seg").alias("seg")).first()
    width = 1 if facts["seg"] is None else facts["seg"] + 1
    if width > 1:
        ends = docs.agg(F.min(key).alias("lo"), F.max(key).alias("hi")).first()
        if max(abs(ends["lo"]), abs(ends["hi"]) + 1) * width >= 2 ** 62:
            raise ValueError("keys too wide to number segments; rank the documents first")
    return short.unionByName(cut).withColumn("segment", F.col(key).cast("long") * width + F.col("seg")).select(
        key, "seg", "segment", "text")


def word_segments(docs: DataFrame, key: str = "doc_id", text_col: str = "text", size: int = SIZE) -> DataFrame:
    """Segments of ``size`` code points and the rest of the last word: the words of the segments
    are the words of the text.  The text is lower-cased first, since the lower case of a letter
    may depend on its neighbours.  A single word longer than that is not cut."""
    pattern = f"(?s).{{1,{size}}}{WORD}*+"
    return _numbered(docs, key, F.lower(text_col), size, lambda t: F.regexp_extract_all(t, F.lit(pattern), 0))


def line_segments(docs: DataFrame, key: str = "doc_id", text_col: str = "text", size: int = SIZE) -> DataFrame:
    """Segments of ``size`` code points and the rest of the last line; joined with ``\\n`` they are the
    text.  A single line longer than that is not cut."""
    pattern = f"(?s).{{{size}}}[^\\n]*+\\n|.+"

    def pieces(t):
        def whole(ps):
            closed = lambda p: (F.char_length(p) > size) & F.endswith(p, F.lit("\n"))
            lines = F.transform(ps, lambda p: F.when(closed(p), F.substring(p, F.lit(1), F.char_length(p) - 1)).otherwise(p))
            return F.when(closed(F.element_at(ps, -1)), F.concat(lines, F.array(F.lit("")))).otherwise(lines)
        return let(F.regexp_extract_all(t, F.lit(pattern), 0), whole)
    return _numbered(docs, key, F.col(text_col), size, pieces)
