"""A line machine for the cleaning rules: the text is cut into lines once and
lines pass a chain of generators.  Fuzzes the column expressions, which work
on whole texts."""

from __future__ import annotations

import unicodedata
from itertools import groupby


def _untagged(text):
    out = ""
    while (i := text.find("<doc")) >= 0:
        j = text.find(">", i)
        tag = j >= 0 and text[i + 4].isspace()
        out += text[:i] if tag else text[: i + 1]
        text = text[j + 1:] if tag else text[i + 1:]
    return "".join((out + text).split("</doc>"))


def _is_url(line):
    head, sep, rest = line.partition("://")
    return bool(sep) and head in ("http", "https") and rest != "" and not any(c.isspace() for c in rest)


def _unrepeated(lines):
    shown = None
    for blank, run in groupby(lines, key=lambda x: x.strip() == "" or _is_url(x)):
        if blank:
            yield ""
            continue
        for line in run:
            if line.strip() != shown:
                shown = line.strip()
                yield line


def _plain(line):
    kept = [c for c in unicodedata.normalize("NFKD", line) if c == "\t" or not unicodedata.category(c).startswith("C")]
    return "".join(c for i, c in enumerate(kept) if c != " " or i == 0 or kept[i - 1] != " ")


def spec_clean(text: str, lowercase: bool = False) -> str:
    lines = [_plain(x) for x in _unrepeated(_untagged(text).split("\n"))]
    short = []
    for empty, run in groupby(lines, key=lambda x: x == ""):
        run = list(run)
        short += run[:1] if empty else run
    kept = [x.strip() for x in short if x.strip() == "" or len(x.strip()) >= 10]
    done = "\n".join(kept)
    return (done.lower() if lowercase else done).strip()


def spec_split(text: str, ratio: float = 0.9):
    size = int(len(text) * ratio)
    before = [i for i, c in enumerate(text[:size]) if c == "\n"]
    cut = before[-1] if before else -1
    return text[:cut], text[cut:]
