"""HTML extraction (operator 7): flat text blocks, classified by a decision tree.

A page is cut into blocks of text at block-level tags.  A block's features are
its own, its predecessor's and its successor's word count and link density, and
two marks of the markup around it: whether it stands in an article element, and
whether it stands in a container for other matter (by tag, role, class or id).
A small decision tree, trained on the labelled table below, says which blocks
are main text.

Pages are independent: one Arrow map pass, nothing shuffled, memory bounded by
one batch and its longest page.

Defined results.  A null html is empty.  Character references are decoded,
white space inside a block becomes one space, blocks are trimmed and joined by
one space.  Scripts, styles, templates, comments, the head and form fields are
no text.  Unclosed tags end with their container.  A page without main text
gives an empty text.  Repeated rows each get a row.  An empty table gives no
rows.  Other columns are ignored.
"""

from __future__ import annotations

import html as _html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<[!?][^>]*>",
                    re.S)
_RAW = ("script", "style", "textarea", "title", "noscript", "template", "svg", "iframe", "select", "button")
_RAW_END = {t: re.compile(rf"</{t}\s*>", re.I) for t in _RAW}
_BLOCK = frozenset("""address article aside blockquote body br caption center dd details dialog div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary
table tbody td tfoot th thead tr ul""".split())
_HOLDS = frozenset("""article aside body details dialog div dl fieldset figure footer form head header html main menu
nav ol section table ul""".split())
_OTHER_TAG = frozenset("nav footer aside form head menu dialog fieldset".split())
_MAIN_TAG = frozenset(("article", "main"))
_OTHER_ROLE = frozenset("navigation banner contentinfo complementary search dialog alert".split())
_OTHER_NAME = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner|breadcrumbs?|comments?|consent|cookies?|disqus|footer|header|login|masthead|"
    r"menu|modal|nav|navbar|navigation|newsletter|notices?|pagination|popup|promo\w*|related|replies|respond|search|"
    r"share|sharing|side|sidebar|signup|skip|social|sponsor\w*|subscribe|tags|teaser|toolbar|warning|widget)(?:$|[\s_-])",
    re.I)
_ATTR = re.compile(r"\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)


def _is_other(tag: str, attrs: str, in_main: bool) -> bool:
    if tag in _OTHER_TAG or tag == "header" and not in_main:
        return True
    for m in _ATTR.finditer(attrs):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "role" and value in _OTHER_ROLE:
            return True
        if name in ("class", "id") and _OTHER_NAME.search(value):
            return True
    return False


def blocks(page: str) -> list[tuple[str, int, int, bool, bool]]:
    """``(text, words, words in links, in article, in other matter)`` in page
    order; blocks without text are left out."""
    out: list[tuple[str, int, int, bool, bool]] = []
    stack: list[tuple[str, bool, bool]] = [("", False, False)]  # tag, in article, in other matter
    parts: list[str] = []
    linked, link = 0, False

    def close() -> None:
        nonlocal linked
        words = "".join(parts).split()
        if words:
            out.append((" ".join(words), len(words), min(linked, len(words)), stack[-1][1], stack[-1][2]))
        parts.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        if text:
            text = _html.unescape(text) if "&" in text else text
            parts.append(text)
            if link:
                linked += len(text.split())

    at = 0
    while True:
        m = _TOKEN.search(page, at)
        if m is None:
            add(page[at:])
            break
        add(page[at: m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag, closing = m[2].lower(), bool(m[1])
        if tag in _RAW_END:
            if not closing and not m[3].endswith("/"):
                end = _RAW_END[tag].search(page, at)
                at = end.end() if end else len(page)
            continue
        if tag == "a":
            link = not closing
        if tag not in _BLOCK:
            continue
        close()
        if tag in _HOLDS:
            if closing:
                if any(t == tag for t, _, _ in stack):
                    while stack.pop()[0] != tag:
                        pass
            else:
                _, main, other = stack[-1]
                if tag in _MAIN_TAG and not main and not _is_other(tag, m[3], False):
                    stack.append((tag, True, False))
                else:  # an article inside comments or inside an article (a reply) is no main text of its own
                    stack.append((tag, main, other or _is_other(tag, m[3], main)))
    close()
    return out


# ------------------------------------------------------------ decision tree
FEATURES = ("words", "links", "prev_words", "prev_links", "next_words", "next_links", "in_article", "other")

# fixed values: blocks labelled by hand, the features in the order above, then 1 = main text
LABELLED = (
    (8, 0.0, 0, 0.0, 60, 0.0, 1, 0, 1), (60, 0.0, 8, 0.0, 45, 0.0, 1, 0, 1), (45, 0.0, 60, 0.0, 1, 0.0, 1, 0, 1),
    (1, 0.0, 45, 0.0, 90, 0.0, 1, 0, 1), (90, 0.05, 1, 0.0, 30, 0.0, 1, 0, 1), (30, 0.1, 90, 0.05, 6, 0.0, 1, 0, 1),
    (3, 0.0, 25, 0.0, 4, 0.0, 1, 0, 1), (12, 0.5, 40, 0.0, 35, 0.0, 1, 0, 1), (1, 1.0, 30, 0.0, 30, 0.0, 1, 0, 1),
    (2, 0.0, 6, 1.0, 70, 0.0, 1, 0, 1), (25, 0.0, 5, 0.0, 9, 0.0, 1, 0, 1), (5, 0.0, 10, 0.0, 6, 0.2, 1, 0, 1),
    (110, 0.0, 80, 0.0, 5, 0.0, 1, 0, 1), (15, 0.0, 14, 0.0, 16, 0.0, 1, 0, 1),
    (7, 0.0, 0, 0.0, 7, 0.0, 1, 0, 1), (7, 0.0, 7, 0.0, 20, 0.0, 1, 0, 1), (8, 0.0, 10, 0.0, 8, 0.0, 1, 0, 1),
    (2, 0.0, 3, 0.0, 2, 0.0, 1, 0, 1), (4, 1.0, 2, 0.0, 5, 0.0, 1, 0, 1), (8, 0.0, 8, 0.0, 0, 0.0, 1, 0, 1),
    (1, 0.0, 1, 0.0, 1, 0.0, 1, 0, 1), (6, 0.0, 1, 1.0, 6, 0.0, 1, 0, 1), (1, 1.0, 4, 1.0, 2, 0.0, 1, 0, 1),
    (1, 1.0, 1, 1.0, 1, 1.0, 0, 1, 0), (1, 1.0, 1, 1.0, 10, 0.0, 0, 1, 0), (2, 1.0, 0, 0.0, 1, 1.0, 0, 1, 0),
    (10, 0.0, 1, 1.0, 8, 0.0, 0, 1, 0), (30, 0.0, 1, 1.0, 9, 0.0, 0, 1, 0), (7, 0.0, 40, 0.0, 0, 0.0, 0, 1, 0),
    (9, 0.2, 3, 0.0, 0, 0.0, 0, 1, 0), (20, 0.0, 60, 0.0, 15, 0.0, 1, 1, 0), (45, 0.0, 50, 0.0, 20, 0.0, 1, 1, 0),
    (5, 0.0, 30, 0.0, 40, 0.0, 1, 1, 0), (3, 1.0, 25, 0.0, 3, 1.0, 1, 1, 0), (80, 0.0, 12, 0.0, 60, 0.0, 0, 1, 0),
    (60, 0.0, 50, 0.0, 70, 0.0, 0, 0, 1), (45, 0.05, 60, 0.0, 40, 0.0, 0, 0, 1), (80, 0.0, 4, 0.0, 55, 0.0, 0, 0, 1),
    (35, 0.0, 70, 0.0, 3, 1.0, 0, 0, 1), (28, 0.1, 45, 0.0, 50, 0.0, 0, 0, 1), (120, 0.0, 9, 0.0, 2, 1.0, 0, 0, 1),
    (18, 0.0, 55, 0.0, 60, 0.0, 0, 0, 1), (15, 0.0, 40, 0.0, 45, 0.0, 0, 0, 1),
    (2, 1.0, 2, 1.0, 3, 1.0, 0, 0, 0), (4, 0.9, 5, 1.0, 60, 0.0, 0, 0, 0), (6, 0.0, 2, 1.0, 3, 1.0, 0, 0, 0),
    (3, 0.0, 0, 0.0, 2, 1.0, 0, 0, 0), (10, 0.7, 12, 0.8, 9, 0.9, 0, 0, 0), (7, 0.0, 5, 0.0, 4, 0.0, 0, 0, 0),
    (5, 0.0, 3, 0.0, 0, 0.0, 0, 0, 0), (25, 0.9, 3, 1.0, 20, 0.8, 0, 0, 0), (9, 0.0, 1, 1.0, 0, 0.0, 0, 0, 0),
)


def _gini(y: np.ndarray) -> float:
    p = y.mean() if len(y) else 0.0
    return 2 * p * (1 - p)


def train(rows=LABELLED, min_leaf: int = 2, depth: int = 6) -> tuple:
    """A binary tree by Gini impurity: (feature, limit, tree up to the limit,
    tree above it), or a label.  Ties go to the first feature and limit."""
    data = np.array(rows, dtype=float)
    x, y = data[:, :-1], data[:, -1]

    def grow(at: np.ndarray, left: int):
        best = None
        if left and 0 < y[at].mean() < 1:
            for f in range(x.shape[1]):
                values = np.unique(x[at, f])
                for limit in (values[1:] + values[:-1]) / 2:
                    low = x[at, f] <= limit
                    if min(low.sum(), (~low).sum()) >= min_leaf:
                        cost = low.sum() * _gini(y[at[low]]) + (~low).sum() * _gini(y[at[~low]])
                        if best is None or cost < best[0] - 1e-12:
                            best = (cost, f, float(limit), at[low], at[~low])
        if best is None or best[0] >= len(at) * _gini(y[at]):
            return bool(y[at].mean() >= 0.5)
        return best[1], best[2], grow(best[3], left - 1), grow(best[4], left - 1)

    return grow(np.arange(len(y)), depth)


def classify(tree, row) -> bool:
    while not isinstance(tree, bool):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree


def main_text(page: str, tree) -> str:
    found = blocks(page)
    own = [(n, k / n) for _, n, k, _, _ in found]
    around = [(0, 0.0), *own, (0, 0.0)]
    return " ".join(b[0] for i, b in enumerate(found)
                    if classify(tree, (*own[i], *around[i], *around[i + 2], b[3], b[4])))


def extract(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    schema = T.StructType([pages.schema["page_id"], pages.schema["url"], T.StructField("text", T.StringType()),
                           T.StructField("n_chars", T.LongType())])
    tree = train()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(h.as_py() or "", tree) for h in b.column(2)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(texts, type=pa.string()),
                 pa.array([len(t) for t in texts], type=pa.int64())], names=schema.names)

    return pages.select("page_id", "url", "html").mapInArrow(run, schema)
