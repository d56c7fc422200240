"""Character classes and per-value text helpers.

The jobs reproduce Python's ``re`` / ``str`` semantics with Java regular
expressions (Spark) and RE2 (the DuckDB oracle).  Both engines accept the
``\\x{h..h}`` escape, so every class below is rendered once and used by both.
"""

from __future__ import annotations

import functools
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _ranges(codepoints: list[int]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for cp in codepoints:
        if out and out[-1][1] == cp - 1:
            out[-1] = (out[-1][0], cp)
        else:
            out.append((cp, cp))
    return out


def _render_class(codepoints: list[int], negate: bool = False, extra: str = "") -> str:
    parts = []
    for lo, hi in _ranges(codepoints):
        parts.append(f"\\x{{{lo:x}}}" if lo == hi else f"\\x{{{lo:x}}}-\\x{{{hi:x}}}")
    return "[" + ("^" if negate else "") + extra + "".join(parts) + "]"


@functools.lru_cache(maxsize=None)
def whitespace_codepoints() -> tuple[int, ...]:
    """Python's whitespace (``str.isspace``, ``str.strip``, ``re`` ``\\s``)."""
    return tuple(cp for cp in range(0x110000) if chr(cp).isspace())


#: ``\s`` of Python as a class usable by Java regex and RE2.
WS = _render_class(list(whitespace_codepoints()))
#: ``[^\s]`` of Python.
NOT_WS = _render_class(list(whitespace_codepoints()), negate=True)
#: ``\S`` without the newline: used where a match must stay inside a line.
WS_NO_NL = _render_class([cp for cp in whitespace_codepoints() if cp != 0x0A])
#: Python ``\w`` (letters, numbers, underscore).
WORD = r"[\p{L}\p{N}_]"
#: The pre-tokenizer ``\w+|[^\w\s]`` rewritten with explicit classes.
WORD_PATTERN = WORD + "+|" + _render_class(list(whitespace_codepoints()), negate=True,
                                            extra=r"\p{L}\p{N}_")
#: ``<doc ...>`` opening tag of extracted dumps (may span lines).
DOC_OPEN = "<doc" + WS + "+[^>]*>"
DOC_CLOSE = "</doc>"
#: A line that is one URL and nothing else.
URL_LINE = "https?://" + NOT_WS + "+"


def strip_ws(col: Column) -> Column:
    """``str.strip()``: Spark's ``trim`` only removes spaces unless it is told which characters."""
    return F.btrim(col, F.lit("".join(map(chr, whitespace_codepoints()))))


def is_ascii(col: Column) -> Column:
    return ~col.rlike(r"[^\x00-\x7f]")


# --------------------------------------------------------------------------
# Unicode normalisation (no Spark built-in): one Arrow-batched helper.
# --------------------------------------------------------------------------

@functools.lru_cache(maxsize=None)
def _is_control(c: str) -> bool:
    return unicodedata.category(c)[0] == "C" and c not in "\n\t"


FEW_CONTROLS = 16  # distinct characters that are dropped one after the other; more go in one pass


def _drop_controls(text: str) -> str:
    """Looks at the distinct characters; most texts have few of them and hardly one to drop."""
    gone = [c for c in set(text) if _is_control(c)]
    if len(gone) > FEW_CONTROLS:
        return text.translate(dict.fromkeys(map(ord, gone)))
    for c in gone:
        text = text.replace(c, "")
    return text


_ASCII_CONTROLS = {cp: None for cp in list(range(0, 9)) + list(range(11, 32)) + [127]}


def nfkd_strip_control_py(text: str | None) -> str | None:
    """NFKD, then drop every code point of category C* except newline and tab."""
    if text is None:
        return None
    if text.isascii():
        return text.translate(_ASCII_CONTROLS)
    return _drop_controls(unicodedata.normalize("NFKD", text))


@F.pandas_udf(T.StringType())
def nfkd_strip_control(texts: pd.Series) -> pd.Series:
    return texts.map(nfkd_strip_control_py, na_action="ignore")


def strip_control_ascii(col: Column) -> Column:
    """Native form of the control-character filter for ASCII-only text."""
    return F.regexp_replace(col, r"[\x00-\x08\x0b-\x1f\x7f]", "")
