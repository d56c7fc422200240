"""Quality rules by distribution divergence (operator 4).

A document's text is compared with references of its language: a histogram
of character classes, and a histogram of the language's commonest words (all
other words in one bin).  Both references are counted over all documents.
The distance is Jensen-Shannon (square root of the divergence, base 2,
between 0 and 1).  Short texts are guarded: a histogram of few words is noisy,
so a text is judged by the method only from ``min_words`` words on, and a
language only once its reference holds ``min_ref_words`` words.

Base counts (over every whole text, words are ``[^\\x20\\x09-\\x0D]+``) come
from the same scan of the bytes.

Plan: one Arrow map pass that counts (language, word) and (language, class)
per task, a group-by, the top words per language, then a second map pass that
scores and emits.  No text is shuffled and no Python object is made per word.

Defined results.  A null text has no words: all counts 0, ``base_failed``
true, ``kept`` false.  A null language is a language of its own.  Repeated rows
are judged alike, each on its own.  Ties between equally frequent words are
broken by their hash.  An empty table gives no rows.  Other columns are ignored
by ``report`` and carried unchanged by ``keep_good``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuslm.llm import vec

MIN_BASE_WORDS = 20
MAX_REPEAT_PCT = 30
REPEAT_WINDOW = 8


@dataclass(frozen=True)
class Params:
    top_words: int = 64  # common words of a language
    min_words: int = 50  # shorter texts are not judged by divergence
    min_ref_words: int = 2_000  # a smaller language has no reference
    # a histogram of n words is off by chance by about 1 / sqrt(n), so the
    # limits are floor + slack / sqrt(n words)
    class_floor: float = 0.24
    class_slack: float = 0.6
    word_floor: float = 0.29
    word_slack: float = 2.0


# character classes by UTF-8 byte; bytes that continue a character have none
CLASSES = ("lower", "upper", "digit", "space", "newline", "stop", "symbol", "other", "letter")
_SKIP = len(CLASSES)


def _class_table() -> np.ndarray:
    t = np.full(256, CLASSES.index("other"), dtype=np.uint8)
    for lo, hi, name in ((0x61, 0x7B, "lower"), (0x41, 0x5B, "upper"), (0x30, 0x3A, "digit")):
        t[lo:hi] = CLASSES.index(name)
    t[[0x20, 0x09]] = CLASSES.index("space")
    t[0x0A:0x0E] = CLASSES.index("newline")
    t[[ord(c) for c in ".,;:!?'\"()-"]] = CLASSES.index("stop")
    t[[ord(c) for c in "#*$%&|<>"]] = CLASSES.index("symbol")
    t[0x80:0xC0] = _SKIP
    t[0xC0:] = CLASSES.index("letter")
    return t


CLASS_OF = _class_table()
SYMBOL = CLASS_OF == CLASSES.index("symbol")
_K = len(CLASSES) + 1


def _class_counts(sl: vec.Slice) -> np.ndarray:
    """(rows, classes) counts of characters."""
    rows = np.repeat(np.arange(sl.rows, dtype=np.int64) * _K, np.diff(sl.off))
    flat = np.bincount(rows + CLASS_OF[sl.data[: sl.n]], minlength=sl.rows * _K)
    return flat.reshape(sl.rows, _K)[:, : len(CLASSES)]


def _langs(col: pa.Array, n: int) -> list[str]:
    return [x if x is not None else "\x00" for x in col.to_pylist()] if n else []


# ------------------------------------------------------------ references
def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: (lang, kind, key, n) with kind 0 = character class, 1 = word.
    Words are merged batch by batch, so a task holds its distinct words."""
    classes: dict[str, np.ndarray] = {}
    words: dict[str, list[np.ndarray]] = {}

    def packed(hs: np.ndarray, ns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        u, inv = np.unique(hs, return_inverse=True)
        return u, np.bincount(inv, weights=ns, minlength=len(u)).astype(np.int64)

    for b in batches:
        langs = np.array(_langs(b.column(0), b.num_rows), dtype=object)
        for sl in vec.slices(b.column(1)):
            of = langs[sl.row0: sl.row0 + sl.rows]
            counts = _class_counts(sl)
            s, e, first = sl.lower().words(vec.ALNUM_WORD)
            h = sl.hash_spans(s, e)
            row = vec.row_index(first)
            for lang in set(of):
                mine = of == lang
                classes[lang] = classes.get(lang, 0) + counts[mine].sum(axis=0)
                u, n = np.unique(h[mine[row]], return_counts=True)
                have = words.setdefault(lang, [])
                have.append((u, n))
                if len(have) == 16:
                    words[lang] = [packed(np.concatenate([x[0] for x in have]), np.concatenate([x[1] for x in have]))]
    for lang in classes:
        u, n = packed(np.concatenate([x[0] for x in words[lang]]), np.concatenate([x[1] for x in words[lang]]))
        c = classes[lang]
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * (len(u) + len(c))),
             pa.array(np.concatenate([np.ones(len(u), dtype=np.int32), np.zeros(len(c), dtype=np.int32)])),
             pa.array(np.concatenate([u.view(np.int64), np.arange(len(c))])),
             pa.array(np.concatenate([n, c]).astype(np.int64))], names=["lang", "kind", "key", "n"])


def references(docs: DataFrame, params: Params = Params()) -> DataFrame:
    """``(lang, kind, key, n, total)``: each language's class counts and its
    ``top_words`` commonest words with the count of all its words.  Rows are
    bounded: languages x (classes + top words)."""
    counts = (docs.select(F.col("lang").cast("string").alias("lang"), "text")
              .mapInArrow(_counter, "lang string, kind int, key long, n long")
              .groupBy("lang", "kind", "key").agg(F.sum("n").alias("n")))
    # the top words of each part first, so that no task ranks a whole language
    part = F.pmod(F.col("key"), F.lit(64))
    near = Window.partitionBy("lang", "kind", part).orderBy(F.desc("n"), "key")
    far = Window.partitionBy("lang", "kind").orderBy(F.desc("n"), "key")
    sums = Window.partitionBy("lang", "kind", part)
    top = (counts.withColumn("__r", F.row_number().over(near)).withColumn("__part", F.sum("n").over(sums))
           .filter(F.col("__r") <= params.top_words))
    total = Window.partitionBy("lang", "kind")
    return (top.withColumn("total", F.sum(F.when(F.col("__r") == 1, F.col("__part"))).over(total))
            .withColumn("__q", F.row_number().over(far)).filter(F.col("__q") <= params.top_words)
            .select("lang", "kind", "key", "n", "total"))


def _model(docs: DataFrame, params: Params) -> dict:
    """The references as arrays, per language with enough words."""
    rows = references(docs, params).collect()  # bounded, see references()
    out = {}
    for lang in {r["lang"] for r in rows}:
        classes = np.zeros(len(CLASSES))
        for r in rows:
            if r["lang"] == lang and r["kind"] == 0:
                classes[r["key"]] = r["n"]
        top = sorted((np.uint64(r["key"] % (1 << 64)), r["n"], r["total"])
                     for r in rows if r["lang"] == lang and r["kind"] == 1)
        total = top[0][2] if top else 0
        if total >= params.min_ref_words:
            counts = np.array([x[1] for x in top], dtype=float)
            out[lang] = {"classes": classes / classes.sum(), "keys": np.array([x[0] for x in top], dtype=np.uint64),
                         "words": np.append(counts, total - counts.sum()) / total}
    return out


# ------------------------------------------------------------ scoring
def js_distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Row-wise Jensen-Shannon distance (base 2) of histograms; ``q`` is one
    distribution, a row of zeros in ``p`` gives 0."""
    total = p.sum(axis=1, keepdims=True)
    p = np.divide(p, total, out=np.zeros_like(p, dtype=float), where=total > 0)
    m = (p + q) / 2
    safe = np.where(m > 0, m, 1.0)
    left = np.where(p > 0, p * np.log2(np.where(p > 0, p, 1.0) / safe), 0.0).sum(axis=1)
    right = np.where(q > 0, q * np.log2(np.where(q > 0, q, 1.0) / safe), 0.0).sum(axis=1)
    return np.where(total[:, 0] > 0, np.sqrt(np.clip((left + right) / 2, 0.0, 1.0)), 0.0)


def _repeat_words(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Per row: words inside windows of REPEAT_WINDOW words that occur at
    least twice in the row."""
    g, at = vec.grams(h, REPEAT_WINDOW, first)
    if not len(g):
        return np.zeros(len(first) - 1, dtype=np.int64)
    row = vec.row_index(first)[at]
    key = vec.mix(g + row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key, kind="stable")
    sk = key[order]
    twin = np.zeros(len(sk), dtype=bool)
    twin[1:] = sk[1:] == sk[:-1]
    twin[:-1] |= twin[1:]
    begin = at[order[twin]]
    cover = np.zeros(len(h) + 1, dtype=np.int64)
    cover[begin] += 1  # begins are distinct
    np.subtract.at(cover, begin + REPEAT_WINDOW, 1)
    return vec.sums(np.cumsum(cover[:-1]) > 0, first)


def _dup_lines(sl: vec.Slice, word_start: np.ndarray) -> np.ndarray:
    """Per row: lines with a word that equal an earlier line of the row."""
    s, e, first = sl.lines()
    has = np.searchsorted(word_start, e) > np.searchsorted(word_start, s)
    h = sl.hash_spans(s[has], e[has])
    row = vec.row_index(first)[has]
    key = vec.mix(h + row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, again = np.unique(key, return_index=True)
    later = np.ones(len(key), dtype=np.int64)
    later[again] = 0
    return np.bincount(row, weights=later, minlength=sl.rows).astype(np.int64)


def measure(sl: vec.Slice, langs: np.ndarray, model: dict, params: Params) -> dict[str, np.ndarray]:
    """All columns of the report for the rows of one slice."""
    data = sl.data[: sl.n]
    s, e, first = sl.words(vec.SPACE_WORD)
    n_words = np.diff(first)
    lead = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    out = {"n_words": n_words, "word_chars": vec.sums(lead[e] - lead[s], first),
           "n_symbols": vec.sums(SYMBOL[data], sl.off), "n_dup_lines": _dup_lines(sl, s),
           "n_repeat_words": _repeat_words(sl.hash_spans(s, e), first)}
    out["base_failed"] = (n_words < MIN_BASE_WORDS) | (100 * out["n_repeat_words"] > MAX_REPEAT_PCT * n_words)
    classes = _class_counts(sl)
    s, e, first = sl.lower().words(vec.ALNUM_WORD)
    h = sl.hash_spans(s, e)
    row = vec.row_index(first)
    by_class, by_word = np.zeros(sl.rows), np.zeros(sl.rows)
    for lang in set(langs):
        ref = model.get(lang)
        if ref is None:
            continue
        mine = np.flatnonzero(langs == lang)
        by_class[mine] = js_distance(classes[mine], ref["classes"])
        number = np.full(sl.rows, -1)
        number[mine] = np.arange(len(mine))
        own = number[row] >= 0
        k = np.minimum(np.searchsorted(ref["keys"], h[own]), len(ref["keys"]) - 1)
        k = np.where(ref["keys"][k] == h[own], k, len(ref["keys"]))
        width = len(ref["keys"]) + 1
        hist = np.bincount(number[row[own]] * width + k, minlength=len(mine) * width).reshape(len(mine), width)
        by_word[mine] = js_distance(hist, ref["words"])
    judged = n_words >= params.min_words
    noise = 1 / np.sqrt(np.maximum(n_words, 1))
    far = judged & ((by_class > params.class_floor + params.class_slack * noise)
                    | (by_word > params.word_floor + params.word_slack * noise))
    return out | {"kept": ~out["base_failed"] & ~far, "class_distance": by_class, "word_distance": by_word}


_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_ALL = (*_COUNTS, "base_failed", "kept", "class_distance", "word_distance")


def _measured(b: pa.RecordBatch, model: dict, params: Params) -> dict[str, np.ndarray]:
    langs = np.array(_langs(b.column(b.schema.get_field_index("lang")), b.num_rows), dtype=object)
    parts = [measure(sl, langs[sl.row0: sl.row0 + sl.rows], model, params)
             for sl in vec.slices(b.column(b.schema.get_field_index("text")))]
    return {k: np.concatenate([p[k] for p in parts]) if parts else np.zeros(0) for k in _ALL}


def report(docs: DataFrame, params: Params = Params()) -> DataFrame:
    """One row per document row: doc_id, the base counts, base_failed, kept,
    and the two distances (0 where there is no reference)."""
    shared = docs.sparkSession.sparkContext.broadcast(_model(docs, params))
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType)]
                          + [T.StructField(k, T.LongType()) for k in _COUNTS]
                          + [T.StructField(k, T.BooleanType()) for k in ("base_failed", "kept")]
                          + [T.StructField(k, T.DoubleType()) for k in ("class_distance", "word_distance")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for b in batches:
            m = _measured(b, model, params)
            cols = [pa.array(m[k].astype(np.int64)) for k in _COUNTS]
            cols += [pa.array(m[k].astype(bool)) for k in ("base_failed", "kept")]
            cols += [pa.array(m[k].astype(float)) for k in ("class_distance", "word_distance")]
            yield pa.RecordBatch.from_arrays([b.column(0), *cols], names=schema.names)

    return docs.select("doc_id", F.col("lang").cast("string").alias("lang"), "text").mapInArrow(run, schema)


def keep_good(docs: DataFrame, params: Params = Params()) -> DataFrame:
    """The rows of ``docs`` (all columns) that the rules keep."""
    shared = docs.sparkSession.sparkContext.broadcast(_model(docs, params))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for b in batches:
            yield b.filter(pa.array(_measured(b, model, params)["kept"].astype(bool)))

    return docs.mapInArrow(run, docs.schema)
