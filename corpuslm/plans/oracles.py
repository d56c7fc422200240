"""DuckDB oracle SQL for the registered queries.

Written independently of the Spark jobs: DuckDB's RE2 has no look-around,
so the oracle cleans *line tables* with window functions, where the Spark
job works inside each row with arrays.  NFKD has no DuckDB built-in, so it
is a chain of ``replace`` calls derived from ``unicodedata`` for Latin-1,
the only non-ASCII range the driver tables use.
"""

from __future__ import annotations

import unicodedata

# character classes, fixed values: white space, letters with numbers and the underscore
_SPACES = (r"\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}")
WS, NOT_WS = f"[{_SPACES}]", f"[^{_SPACES}]"
WORD_PATTERN = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_" + _SPACES + "]"

ORACLES: dict[str, str] = {}

NL = "chr(10)"


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def strip(e: str) -> str:
    return f"regexp_replace({e}, {q(r'\A' + WS + '+|' + WS + r'+\z')}, '', 'g')"


def nfkd_latin1(e: str) -> str:
    """NFKD followed by removal of category C, for Latin-1 text."""
    out = e
    for cp in range(0xA0, 0x100):
        ch = chr(cp)
        dec = unicodedata.normalize("NFKD", ch)
        if dec != ch:
            out = f"replace({out}, {q(ch)}, {q(dec)})"
    controls = "".join(f"\\x{{{cp:x}}}" for cp in range(0x100)
                       if unicodedata.category(chr(cp))[0] == "C" and chr(cp) not in "\n\t")
    return f"regexp_replace({out}, {q('[' + controls + ']')}, '', 'g')"


# ------------------------------------------------------------------ views
CTE_DOCUMENTS = "docs AS (SELECT doc_id, text FROM documents)"

CTE_WIKI_RAW = f"""wiki_raw AS (
  SELECT doc_id,
    '<doc id="' || CAST(doc_id AS VARCHAR) || '" url="https://example.org/?curid=' || CAST(doc_id AS VARCHAR)
    || '" title="Title number ' || CAST(doc_id AS VARCHAR) || '">' || {NL}
    || 'Title number ' || CAST(doc_id AS VARCHAR) || {NL} || {NL}
    || 'Title number ' || CAST(doc_id AS VARCHAR) || {NL}
    || 'https://example.org/' || CAST(doc_id AS VARCHAR) || {NL} || {NL} || {NL}
    || replace(text, '. ', '.  ') || {NL} || '   ' || {NL} || 'short' || {NL} || '</doc>' AS text
  FROM documents)"""

CTE_NOISY = """noisy AS (
  SELECT doc_id, replace(replace(replace(text, 'x', 'x' || chr(7)), 'qu', 'q' || chr(173) || 'u'),
                         ', ', ',' || chr(160)) AS text
  FROM documents)"""


def lines_of(src: str, name: str) -> str:
    """Line table ``(doc_id, line_no, line)`` of a text CTE, line_no from 0."""
    return f"""{name} AS (
  SELECT doc_id, unnest(arr) AS line, generate_subscripts(arr, 1) - 1 AS line_no
  FROM (SELECT doc_id, string_split(text, {NL}) AS arr FROM {src}))"""


def join_lines(src: str, base: str, name: str) -> str:
    """Text per document from a line table; documents without lines give ''."""
    return f"""{name} AS (
  SELECT b.doc_id, coalesce(a.text, '') AS text
  FROM {base} b LEFT JOIN (SELECT doc_id, string_agg(line, {NL} ORDER BY line_no) AS text
                           FROM {src} GROUP BY doc_id) a USING (doc_id))"""


def clean_ctes(src: str, lowercase: bool = False) -> list[str]:
    """Cleaning as line-table CTEs; returns CTEs ending in ``c_final``."""
    ctes = [
        f"""c_s2 AS (SELECT doc_id, replace(regexp_replace(text, {q('<doc' + WS + '+[^>]*>')}, '', 'g'),
                                     '</doc>', '') AS text FROM {src})""",
        lines_of("c_s2", "c_l2"),
        f"""c_l3 AS (SELECT doc_id, line_no,
                  CASE WHEN regexp_full_match(line, {q('https?://' + NOT_WS + '+')}) THEN '' ELSE line END AS line
           FROM c_l2)""",
        f"""c_l4 AS (
  SELECT doc_id, line_no, CASE WHEN blank THEN '' ELSE line END AS line
  FROM (SELECT *, lag(blank) OVER (PARTITION BY doc_id ORDER BY line_no) AS prev_blank
        FROM (SELECT *, regexp_full_match(line, {q(WS + '*')}) AS blank FROM c_l3))
  WHERE NOT blank OR prev_blank IS NULL OR NOT prev_blank)""",
        f"""c_l6 AS (
  SELECT doc_id, line_no, line FROM c_l4 WHERE line = ''
  UNION ALL
  SELECT doc_id, line_no, line
  FROM (SELECT *, lag(k) OVER (PARTITION BY doc_id ORDER BY line_no) AS pk
        FROM (SELECT *, {strip('line')} AS k FROM c_l4 WHERE line <> ''))
  WHERE pk IS NULL OR pk <> k)""",
        f"c_l8 AS (SELECT doc_id, line_no, regexp_replace({nfkd_latin1('line')}, ' +', ' ', 'g') AS line FROM c_l6)",
        f"""c_l9 AS (
  SELECT doc_id, line_no, line
  FROM (SELECT *, lag(line) OVER (PARTITION BY doc_id ORDER BY line_no) AS pl FROM c_l8)
  WHERE line <> '' OR pl IS NULL OR pl <> '')""",
        f"""c_l10 AS (SELECT doc_id, line_no, {('lower(' + strip('line') + ')') if lowercase else strip('line')} AS line
            FROM c_l9 WHERE length({strip('line')}) = 0 OR length({strip('line')}) >= 10)""",
        join_lines("c_l10", src, "c_joined"),
        f"c_final AS (SELECT doc_id, {strip('text')} AS text FROM c_joined)",
    ]
    return ctes


def with_(ctes: list[str], body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


def _reg(name: str, sql: str) -> None:
    ORACLES[name] = sql


# ------------------------------------------------------------------ cleaning
_reg("cln_01", with_([CTE_WIKI_RAW], f"SELECT doc_id, regexp_replace(text, {q('<doc' + WS + '+[^>]*>')}, '', 'g') AS text FROM wiki_raw"))
_reg("cln_02", with_([CTE_WIKI_RAW], "SELECT doc_id, replace(text, '</doc>', '') AS text FROM wiki_raw"))

_c = clean_ctes("wiki_raw")
_reg("cln_03", with_([CTE_WIKI_RAW] + _c[:3] + [join_lines("c_l3", "wiki_raw", "r")], "SELECT doc_id, text FROM r"))
_reg("cln_04", with_([CTE_WIKI_RAW] + _c[:4] + [join_lines("c_l4", "wiki_raw", "r")], "SELECT doc_id, text FROM r"))
_reg("cln_05", with_([CTE_WIKI_RAW, lines_of("wiki_raw", "l")],
                     "SELECT doc_id, CAST(line_no AS BIGINT) AS line_no, line FROM l"))
_reg("cln_06", with_([CTE_WIKI_RAW] + _c[:5] + [join_lines("c_l6", "wiki_raw", "r")], "SELECT doc_id, text FROM r"))
_reg("cln_07", f"SELECT doc_id, {nfkd_latin1('text')} AS text FROM documents")
_reg("cln_08", with_([CTE_NOISY], f"SELECT doc_id, {nfkd_latin1('text')} AS text FROM noisy"))
_reg("cln_09", with_([CTE_WIKI_RAW], "SELECT doc_id, regexp_replace(text, ' +', ' ', 'g') AS text FROM wiki_raw"))
_reg("cln_10", with_(
    [CTE_WIKI_RAW, lines_of("wiki_raw", "l"),
     f"""l4 AS (SELECT doc_id, line_no, CASE WHEN blank THEN '' ELSE line END AS line
        FROM (SELECT *, lag(blank) OVER (PARTITION BY doc_id ORDER BY line_no) AS prev_blank
              FROM (SELECT *, regexp_full_match(line, {q(WS + '*')}) AS blank FROM l))
        WHERE NOT blank OR prev_blank IS NULL OR NOT prev_blank)""",
     join_lines("l4", "wiki_raw", "j")],
    f"SELECT doc_id, regexp_replace(text, '\\n{{3,}}', {NL} || {NL}, 'g') AS text FROM j"))
_short = f"""s AS (SELECT doc_id, line_no, {strip('line')} AS line FROM c_l6
              WHERE length({strip('line')}) = 0 OR length({strip('line')}) >= 10)"""
_reg("cln_11", with_([CTE_WIKI_RAW] + _c[:5] + [_short, join_lines("s", "wiki_raw", "r")],
                     "SELECT doc_id, text FROM r"))
_reg("cln_12", "SELECT doc_id, lower(text) AS text FROM documents")
_reg("cln_13", with_([CTE_WIKI_RAW] + _c[:5] + [_short, join_lines("s", "wiki_raw", "r")],
                     f"SELECT doc_id, {strip('text')} AS text FROM r"))
_reg("cln_14", with_([CTE_WIKI_RAW] + clean_ctes("wiki_raw"), "SELECT doc_id, text FROM c_final"))
_reg("cln_14_noisy", with_([CTE_NOISY] + clean_ctes("noisy", lowercase=True), "SELECT doc_id, text FROM c_final"))
_reg("cln_15", with_([CTE_WIKI_RAW],
                     f"SELECT CAST(coalesce(sum(len(regexp_extract_all(text, {q('<doc' + WS + '+[^>]*>')}, 0))), 0) AS BIGINT) AS doc_tags FROM wiki_raw"))
_reg("cln_16", with_([CTE_WIKI_RAW] + clean_ctes("wiki_raw"), """
SELECT b AS chars_before, a AS chars_after, b - a AS chars_removed,
       round(CASE WHEN b = 0 THEN NULL ELSE (b - a) * 100.0 / b END, 6) AS pct_removed
FROM (SELECT CAST(sum(length(text)) AS BIGINT) AS b FROM wiki_raw),
     (SELECT CAST(sum(length(text)) AS BIGINT) AS a FROM c_final)"""))
_reg("cln_17", with_([CTE_WIKI_RAW] + clean_ctes("wiki_raw") + [lines_of("c_final", "fl")], """
SELECT doc_id, CAST(line_no AS BIGINT) AS line_no, substring(line, 1, 80) AS line
FROM fl ORDER BY doc_id, line_no LIMIT 10"""))

# ------------------------------------------------------------------ split
# The oracle joins the cleaned documents into ONE string, as the reference
# does, and cuts it with string functions.
_SPLIT = clean_ctes("wiki_raw") + [
    f"corpus AS (SELECT coalesce(string_agg(text, {NL} ORDER BY doc_id), '') AS t FROM c_final)",
    "sp AS (SELECT t, length(t) AS total, CAST(floor(length(t) * CAST(0.9 AS DOUBLE)) AS BIGINT) AS split_idx FROM corpus)",
    f"""sp2 AS (SELECT t, total, split_idx,
        CASE WHEN strpos(reverse(substring(t, 1, split_idx)), {NL}) > 0
             THEN split_idx - strpos(reverse(substring(t, 1, split_idx)), {NL}) ELSE -1 END AS split_point
        FROM sp)""",
    "sp3 AS (SELECT *, CASE WHEN split_point >= 0 THEN split_point ELSE greatest(total - 1, 0) END AS c FROM sp2)",
]
_reg("spl_01", with_([CTE_WIKI_RAW] + clean_ctes("wiki_raw") + [lines_of("c_final", "fl")], f"""
SELECT doc_id, CAST(line_no AS BIGINT) AS line_no, line,
       CAST(coalesce(sum(length(line) + 1) OVER (ORDER BY doc_id, line_no
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS offset
FROM fl"""))
_reg("spl_02", with_([CTE_WIKI_RAW] + _SPLIT,
                     "SELECT CAST(total AS BIGINT) AS total_chars, split_idx, CAST(split_point AS BIGINT) AS split_point FROM sp3"))
_reg("spl_03", with_([CTE_WIKI_RAW] + _SPLIT + ["""offs AS (
  SELECT doc_id, text, length(text) AS len,
         coalesce(sum(length(text) + 1) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM c_final)"""], f"""
SELECT doc_id, 'train' AS split, substring(text, 1, CAST(least(c - start, len) AS BIGINT)) AS text
FROM offs, sp3 WHERE start <= c
UNION ALL
SELECT doc_id, 'val' AS split,
       (CASE WHEN start - 1 = c THEN {NL} ELSE '' END) || substring(text, CAST(greatest(c - start, 0) + 1 AS BIGINT)) AS text
FROM offs, sp3 WHERE start + len > c"""))
_reg("spl_04", with_([CTE_WIKI_RAW] + _SPLIT + [
    "parts AS (SELECT substring(t, 1, c) AS tr, substring(t, c + 1) AS va FROM sp3)"], """
SELECT split, CAST(chars AS BIGINT) AS chars, CAST(bytes AS BIGINT) AS bytes, round(bytes / 1048576.0, 6) AS mb FROM (
  SELECT 'train' AS split, length(tr) AS chars, strlen(tr) AS bytes FROM parts
  UNION ALL SELECT 'val', length(va), strlen(va) FROM parts
  UNION ALL SELECT 'total', length(tr) + length(va), strlen(tr) + strlen(va) FROM parts)"""))

# the same with the documents joined before they are cleaned
_JOINED = [CTE_WIKI_RAW, f"one AS (SELECT 0 AS doc_id, string_agg(text, {NL} ORDER BY doc_id) AS text FROM wiki_raw)"]
_CORPUS = _JOINED + clean_ctes("one")
_reg("cln_14_corpus", with_(_CORPUS + [lines_of("c_final", "fl")], "SELECT CAST(line_no AS BIGINT) AS line_no, line FROM fl"))
ORACLES["cln_14_segments"] = ORACLES["cln_14_corpus"]
_PARTS = _CORPUS + ["corpus AS (SELECT text AS t FROM c_final)"] + _SPLIT[-3:] + [
    "parts AS MATERIALIZED (SELECT substring(t, 1, c) AS tr, substring(t, c + 1) AS va FROM sp3)"]
_reg("cln_01_corpus", with_([f"""tagged AS (SELECT doc_id, CASE
    WHEN doc_id % 7 = 3 THEN text || {NL} || '<doc id="' || CAST(doc_id AS VARCHAR)
    WHEN doc_id % 7 = 5 THEN '" title="t">' || text
    WHEN doc_id % 11 = 0 THEN text || ' <doc' ELSE text END AS text FROM documents)""",
    f"""one AS (SELECT string_split(regexp_replace(string_agg(text, {NL} ORDER BY doc_id), '<doc[ \t\n\r]+[^>]*>', '', 'g'), {NL}) AS ls
         FROM tagged)"""], """
SELECT CAST(generate_subscripts(ls, 1) - 1 AS BIGINT) AS line_no, unnest(ls) AS line FROM one"""))
_reg("spl_04_corpus", with_(_PARTS, """
SELECT split, CAST(chars AS BIGINT) AS chars, CAST(bytes AS BIGINT) AS bytes, round(bytes / 1048576.0, 6) AS mb FROM (
  SELECT 'train' AS split, length(tr) AS chars, strlen(tr) AS bytes FROM parts
  UNION ALL SELECT 'val', length(va), strlen(va) FROM parts
  UNION ALL SELECT 'total', length(tr) + length(va), strlen(tr) + strlen(va) FROM parts)"""))

# ------------------------------------------------------------------ words
CTE_WORDS = f"""words AS (
  SELECT doc_id, unnest(arr) AS word, generate_subscripts(arr, 1) - 1 AS pos
  FROM (SELECT doc_id, regexp_extract_all(lower(text), {q(WORD_PATTERN)}, 0) AS arr FROM documents))"""
CTE_FREQ = """freq AS (
  SELECT word, count(*) AS freq, arg_min(doc_id, (doc_id, pos)) AS first_doc,
         CAST(arg_min(pos, (doc_id, pos)) AS BIGINT) AS first_pos
  FROM words GROUP BY word)"""
_reg("tok_01", with_([CTE_WORDS], "SELECT doc_id, CAST(pos AS BIGINT) AS pos, word FROM words"))
_reg("tok_02", with_([CTE_WORDS, CTE_FREQ], "SELECT word, freq, first_doc, first_pos FROM freq"))
_reg("tok_03", with_([CTE_WORDS], """
SELECT token, CAST(row_number() OVER (ORDER BY token) - 1 AS BIGINT) AS id
FROM (SELECT DISTINCT unnest(string_split(word, '')) AS token FROM words) WHERE length(token) > 0"""))


# ------------------------------------------------------------------ BPE
# One merge per step, unrolled: the Spark trainer merges several pairs per
# round, so equality here also checks the batching rule.
EXTRA_MERGES = 8
CTE_RANKED = """ranked AS MATERIALIZED (
  SELECT word, freq, row_number() OVER (ORDER BY first_doc, first_pos) - 1 AS wrank,
         ' ' || array_to_string(string_split(word, ''), '  ') || ' ' AS sym
  FROM freq WHERE length(word) >= 2)"""
CTE_ALPHA = """alpha AS MATERIALIZED (
  SELECT token, row_number() OVER (ORDER BY token) - 1 AS id
  FROM (SELECT DISTINCT unnest(string_split(word, '')) AS token FROM freq) WHERE length(token) > 0)"""


def pairs_sql(src: str) -> str:
    return f"""SELECT l, r, CAST(sum(freq) AS BIGINT) AS n, min({{'w': wrank, 'j': j}}) AS first FROM (
      SELECT freq, wrank, s[i] AS l, s[i + 1] AS r, i - 1 AS j FROM (
        SELECT freq, wrank, s, unnest(range(1, len(s))) AS i
        FROM (SELECT freq, wrank, string_split(trim(sym), '  ') AS s FROM {src})))
    GROUP BY l, r"""


def merge_sym(e: str, m: str) -> str:
    return f"replace({e}, ' ' || {m}.l || '  ' || {m}.r || ' ', ' ' || {m}.l || {m}.r || ' ')"


def train_ctes(k: int = EXTRA_MERGES, words: str = CTE_WORDS) -> list[str]:
    ctes = [words, CTE_FREQ, CTE_RANKED, CTE_ALPHA, "w0 AS MATERIALIZED (SELECT word, freq, wrank, sym FROM ranked)"]
    for i in range(1, k + 1):
        ctes.append(f"""b{i} AS MATERIALIZED (SELECT l, r, n FROM ({pairs_sql(f"w{i-1}")}) WHERE n >= 2
                       ORDER BY n DESC, first ASC LIMIT 1)""")
        ctes.append(f"w{i} AS MATERIALIZED (SELECT word, freq, wrank, {merge_sym('sym', f'b{i}')} AS sym FROM w{i-1}, b{i})")
    ctes.append("merges AS (" + " UNION ALL ".join(
        f"SELECT CAST({i-1} AS BIGINT) AS rank, l AS \"left\", r AS \"right\" FROM b{i}" for i in range(1, k + 1)) + ")")
    ctes.append("""vocab AS (SELECT token, CAST(id AS BIGINT) AS id FROM alpha
                 UNION ALL SELECT "left" || "right", (SELECT count(*) FROM alpha) + rank FROM merges)""")
    return ctes


def encode_ctes(words_cte: str, k: int = EXTRA_MERGES, sfx: str = "") -> list[str]:
    """Replay the learned merges in rank order on every distinct word, then
    map tokens to ids (fallback: first character; else dropped)."""
    e = "' ' || array_to_string(string_split(word, ''), '  ') || ' '"
    for i in range(1, k + 1):
        e = merge_sym(e, f"b{i}")
    froms = ", ".join(f"b{i}" for i in range(1, k + 1))
    return [
        f"enc{sfx} AS MATERIALIZED (SELECT word, string_split(trim({e}), '  ') AS tokens FROM (SELECT DISTINCT word FROM {words_cte}), {froms})",
        f"tokmap{sfx} AS (SELECT word, unnest(tokens) AS tok, generate_subscripts(tokens, 1) AS k FROM enc{sfx})",
        f"""occ_ids{sfx} AS MATERIALIZED (
  SELECT w.doc_id, w.pos, t.k, coalesce(v.id, v1.id) AS id
  FROM {words_cte} w JOIN tokmap{sfx} t USING (word)
  LEFT JOIN vocab v ON v.token = t.tok LEFT JOIN vocab v1 ON v1.token = left(t.tok, 1))""",
    ]


def ids_per_doc(base: str) -> str:
    return f"""SELECT b.doc_id, coalesce(a.ids, CAST([] AS INTEGER[])) AS ids FROM {base} b LEFT JOIN (
  SELECT doc_id, list(CAST(id AS INTEGER) ORDER BY pos, k) AS ids FROM occ_ids WHERE id IS NOT NULL GROUP BY doc_id) a
USING (doc_id)"""


_reg("tok_04", with_([CTE_WORDS, CTE_FREQ], "SELECT word, string_split(word, '') AS symbols FROM freq"))
_reg("tok_05", with_([CTE_WORDS, CTE_FREQ, CTE_RANKED, f"p AS ({pairs_sql('ranked')})"], """
SELECT l AS "left", r AS "right", n, CAST(first.w AS BIGINT) AS first_word, CAST(first.j AS BIGINT) AS first_j FROM p"""))
_reg("tok_06", with_([CTE_WORDS, CTE_FREQ, CTE_RANKED, f"p AS ({pairs_sql('ranked')})"],
                     'SELECT l AS "left", r AS "right", n FROM p ORDER BY n DESC, first ASC LIMIT 1'))
_reg("tok_07", with_([CTE_WORDS, CTE_FREQ, CTE_RANKED, f"p AS MATERIALIZED ({pairs_sql('ranked')})",
                      """b AS MATERIALIZED (SELECT ' ' || l || '  ' || r || ' ' AS old, ' ' || l || r || ' ' AS new FROM p
                         ORDER BY n DESC, first ASC LIMIT 1)"""], """
SELECT word, string_split(trim(replace(sym, (SELECT old FROM b), (SELECT new FROM b))), '  ') AS symbols FROM ranked"""))
# whatever the merges are: decoding gives the words back, the vocabulary is full, its last token occurs
_reg("tok_14_full", with_([CTE_WORDS], """
SELECT d.doc_id, coalesce(a.text, '') AS text FROM documents d LEFT JOIN (
  SELECT doc_id, string_agg(word, '' ORDER BY pos) AS text FROM words GROUP BY doc_id) a USING (doc_id)"""))
_reg("tok_16_full", with_([CTE_WORDS, CTE_FREQ, CTE_ALPHA], """
SELECT CAST(5000 AS BIGINT) AS vocab_size, CAST(5000 - count(*) AS BIGINT) AS num_merges FROM alpha"""))
_reg("tok_17_full", "SELECT CAST(5000 AS BIGINT) AS vocab_size, CAST(4999 AS BIGINT) AS max_id, CAST(0 AS BIGINT) AS out_of_range")
_reg("tok_08", with_(train_ctes(), 'SELECT rank, "left", "right" FROM merges'))
_reg("tok_10", with_(train_ctes(), "SELECT token, id FROM vocab"))
_reg("tok_11", with_(train_ctes() + encode_ctes("words")[:1], "SELECT word, tokens FROM enc"))
_reg("tok_12", with_(train_ctes() + encode_ctes("words"), ids_per_doc("documents")))
CTE_BENCH_WORDS = f"""bwords AS (
  SELECT doc_id, unnest(arr) AS word, generate_subscripts(arr, 1) - 1 AS pos
  FROM (SELECT item_id AS doc_id, regexp_extract_all(lower(text), {q(WORD_PATTERN)}, 0) AS arr FROM benchmark))"""
_reg("tok_13", with_(train_ctes() + [CTE_BENCH_WORDS] + encode_ctes("bwords"),
                     ids_per_doc("(SELECT item_id AS doc_id FROM benchmark)")))
# trained on the benchmark, applied to the documents
_FOREIGN = train_ctes(words=CTE_BENCH_WORDS.replace("bwords AS", "words AS")) + [CTE_WORDS.replace("words AS", "dwords AS")]
_reg("tok_13_oov", with_(_FOREIGN + encode_ctes("dwords"), ids_per_doc("documents")))
_reg("tok_13_report", with_(_FOREIGN, """
SELECT c AS token, CAST(count(*) AS BIGINT) AS n FROM (SELECT unnest(string_split(word, '')) AS c FROM dwords)
WHERE length(c) > 0 AND c NOT IN (SELECT token FROM alpha) GROUP BY c"""))
# one merge a step until no pair occurs twice; the vocabulary of 5,000 is never reached
_reg("tok_09", with_([CTE_BENCH_WORDS.replace("bwords AS", "words AS"), CTE_FREQ, CTE_RANKED, CTE_ALPHA, f"""steps AS (
  SELECT 0 AS it, word, freq, wrank, sym FROM ranked
  UNION ALL
  SELECT s.it + 1, s.word, s.freq, s.wrank, {merge_sym('s.sym', 'b')} FROM steps s,
    (SELECT l, r FROM ({pairs_sql('steps')}) WHERE n >= 2 ORDER BY n DESC, first ASC LIMIT 1) b)""",
    "done AS MATERIALIZED (SELECT * FROM steps WHERE it = (SELECT max(it) FROM steps))"], f"""
SELECT (SELECT count(*) FROM alpha) AS alphabet_size, (SELECT CAST(max(it) AS BIGINT) FROM done) AS num_merges,
       CASE WHEN EXISTS (SELECT 1 FROM ({pairs_sql('done')})) THEN 'below_min_frequency' ELSE 'no_pairs' END AS stop_reason
""").replace("WITH ", "WITH RECURSIVE ", 1))
_reg("tok_14", with_(train_ctes() + encode_ctes("words"), """
SELECT d.doc_id, coalesce(a.text, '') AS text FROM documents d LEFT JOIN (
  SELECT o.doc_id, string_agg(v.token, '' ORDER BY o.pos, o.k) AS text
  FROM occ_ids o JOIN vocab v ON v.id = o.id GROUP BY o.doc_id) a USING (doc_id)"""))
_reg("tok_15", with_(train_ctes() + encode_ctes("words"), """
SELECT t AS tokens, round(t * 2 / 1048576.0, 6) AS size_mb, c AS chars,
       round(CASE WHEN t = 0 THEN NULL ELSE c / t END, 6) AS chars_per_token
FROM (SELECT CAST(count(id) AS BIGINT) AS t FROM occ_ids),
     (SELECT CAST(sum(length(text)) AS BIGINT) AS c FROM documents)"""))
_reg("tok_16", with_(train_ctes(), """
SELECT (SELECT CAST(count(DISTINCT token) AS BIGINT) FROM vocab) AS vocab_size,
       (SELECT CAST(count(*) AS BIGINT) FROM merges) AS num_merges"""))
_reg("tok_17", with_(train_ctes() + encode_ctes("words"), """
SELECT (SELECT count(*) FROM vocab) AS vocab_size, CAST(max(id) AS BIGINT) AS max_id,
       CAST(count(*) FILTER (WHERE id >= (SELECT count(*) FROM vocab)) AS BIGINT) AS out_of_range
FROM occ_ids"""))


# ------------------------------------------------------------------ datasets
CONTEXT, BATCH, EPOCHS, SEED = 16, 32, 2, 0
_STREAM = train_ctes() + encode_ctes("words") + [
    """stream AS MATERIALIZED (SELECT row_number() OVER (ORDER BY doc_id, pos, k) - 1 AS gpos,
                                 CAST(id AS INTEGER) AS id FROM occ_ids WHERE id IS NOT NULL)""",
    "whole AS MATERIALIZED (SELECT list(id ORDER BY gpos) AS toks, count(*) AS n FROM stream)",
]
_WINS = f"""wins AS (
  SELECT xs.w AS win_id, xs.x, ys.y
  FROM (SELECT gpos // {CONTEXT} AS w, list(id ORDER BY gpos) AS x FROM stream GROUP BY 1) xs
  JOIN (SELECT (gpos - 1) // {CONTEXT} AS w, list(id ORDER BY gpos) AS y FROM stream WHERE gpos >= 1 GROUP BY 1) ys
    USING (w), whole
  WHERE xs.w * {CONTEXT} <= n - {CONTEXT} - 1)"""
_reg("dat_01", with_(_STREAM, "SELECT CAST(gpos AS BIGINT) AS gpos, id FROM stream"))
ORACLES["dat_01_segments"] = ORACLES["dat_01"]
_reg("dat_02", with_(_STREAM + [_WINS], "SELECT CAST(win_id AS BIGINT) AS win_id, x, y FROM wins"))
_reg("dat_02_stride1", with_(_STREAM, f"""
SELECT CAST(greatest(n - {CONTEXT}, 0) AS BIGINT) AS n_windows,
  (SELECT CAST(sum(id) AS BIGINT) FROM stream WHERE gpos <= n - {CONTEXT} - 1) AS sum_x_first,
  (SELECT CAST(sum(id) AS BIGINT) FROM stream WHERE gpos >= {CONTEXT}) AS sum_y_last,
  (SELECT CAST(sum(CAST(id AS BIGINT) * (least(gpos, n - {CONTEXT} - 1) - greatest(0, gpos - {CONTEXT} + 1) + 1)) AS BIGINT)
     FROM stream WHERE least(gpos, n - {CONTEXT} - 1) >= greatest(0, gpos - {CONTEXT} + 1)) AS sum_x_all
FROM whole"""))
_reg("dat_03", with_(_STREAM, f"""
SELECT CAST(n AS BIGINT) AS n_tokens, CAST({CONTEXT} AS BIGINT) AS context_length,
       CAST(greatest(n - {CONTEXT}, 0) AS BIGINT) AS n_windows FROM whole"""))
_SHUF = _STREAM + [_WINS, f"""shuf AS (
  SELECT e AS epoch, win_id,
         row_number() OVER (PARTITION BY e ORDER BY md5('{SEED}:' || CAST(e AS VARCHAR) || ':' || CAST(win_id AS VARCHAR)), win_id) - 1 AS rn
  FROM wins, range(0, {EPOCHS}) t(e))"""]
_reg("dat_04", with_(_SHUF, f"SELECT CAST(epoch AS BIGINT) AS epoch, CAST(rn // {BATCH} AS BIGINT) AS batch, CAST(win_id AS BIGINT) AS win_id FROM shuf"))
_reg("dat_04_keyed", with_(_STREAM + [_WINS], f"""
SELECT CAST(e AS BIGINT) AS epoch, count(*) AS n_windows, CAST(sum(win_id) AS BIGINT) AS sum_windows, count(*) AS n_back,
       CAST(ceil(count(*) / {BATCH}) AS BIGINT) AS n_batches, count(*) // {BATCH} AS n_full,
       (count(*) - 1) % {BATCH} + 1 AS n_last, count(DISTINCT win_id) AS n_once
FROM wins, range(0, {EPOCHS}) t(e) GROUP BY e"""))
_reg("dat_05", with_(_STREAM + [_WINS], f"""
SELECT CAST(win_id // {BATCH} AS BIGINT) AS batch, CAST(win_id AS BIGINT) AS win_id FROM wins WHERE win_id < {20 * BATCH}"""))
_reg("dat_06", with_(_STREAM + [_WINS, f"nb AS (SELECT CAST(ceil(count(*) / {BATCH}) AS BIGINT) AS nb FROM wins)"], """
SELECT CAST(step AS BIGINT) AS step, CAST(step // nb AS BIGINT) AS epoch, CAST(step % nb AS BIGINT) AS batch,
  round(CASE WHEN step < 500 THEN 3e-4 * (step + 1) / 500.0
             WHEN step > 15000 THEN 3e-5
             ELSE 3e-5 + 0.5 * (1.0 + cos(pi() * (step - 500) / 14500.0)) * (3e-4 - 3e-5) END, 12) AS lr
FROM nb, range(0, 15000) t(step)"""))


# ------------------------------------------------------------------ n-gram model
TEMP, TOPK, TOPK_SMALL, GEN_STEPS = 0.8, 40, 5, 200


def hexu(e: str) -> str:
    return f"CAST(('0x' || substring(md5({e}), 1, 12)) AS BIGINT) / {float(16 ** 12)!r}"


_LM = _STREAM + [
    """counts AS MATERIALIZED (
  SELECT [a.id] AS ctx, b.id AS next, count(*) AS c FROM stream a JOIN stream b ON b.gpos = a.gpos + 1 GROUP BY 1, 2
  UNION ALL SELECT CAST([] AS INTEGER[]), id, count(*) FROM stream GROUP BY id)""",
    """dist AS MATERIALIZED (
  SELECT ctx, next, c, sum(c) OVER (PARTITION BY ctx) AS total,
         c / sum(c) OVER (PARTITION BY ctx) AS p, ln(c / sum(c) OVER (PARTITION BY ctx)) AS logit FROM counts)""",
    "V AS (SELECT count(*) AS v FROM vocab)",
    CTE_BENCH_WORDS] + encode_ctes("bwords", sfx="_b") + [
    """bstream AS MATERIALIZED (SELECT row_number() OVER (ORDER BY doc_id, pos, k) - 1 AS gpos, CAST(id AS INTEGER) AS id
                            FROM occ_ids_b WHERE id IS NOT NULL)""",
    """ctx_tot AS (SELECT ctx, sum(c) AS cc FROM counts WHERE len(ctx) > 0 GROUP BY ctx)""",
    """uni AS (SELECT next, c AS u FROM counts WHERE len(ctx) = 0)""",
    """ntok AS (SELECT sum(u) AS nn FROM uni)""",
]


def nll_sql(src: str) -> str:
    """-ln p for rows of ``src(ctx, next, ...)`` (add-one smoothing, unigram backoff)."""
    return f"""(SELECT s.*, -ln(CASE WHEN t.cc IS NOT NULL THEN (coalesce(k.c, 0) + 1.0) / (t.cc + V.v)
                               ELSE (coalesce(u.u, 0) + 1.0) / (ntok.nn + V.v) END) AS nll
   FROM {src} s LEFT JOIN counts k ON k.ctx = s.ctx AND k.next = s.next
   LEFT JOIN ctx_tot t ON t.ctx = s.ctx LEFT JOIN uni u ON u.next = s.next, V, ntok)"""


def softmax_sql(k: int | None) -> str:
    keep = f"WHERE rk <= {k}" if k else ""
    return f"""(SELECT ctx, next, e / sum(e) OVER (PARTITION BY ctx) AS q FROM (
  SELECT ctx, next, exp(z - max(z) OVER (PARTITION BY ctx)) AS e FROM (
    SELECT ctx, next, z FROM (SELECT ctx, next, logit / {TEMP} AS z,
                                     rank() OVER (PARTITION BY ctx ORDER BY logit / {TEMP} DESC) AS rk FROM dist) {keep})))"""


_SAMP = """samp AS MATERIALIZED (
  SELECT ctx, next, hi - q AS lo, hi, max(hi) OVER (PARTITION BY ctx) AS tot FROM (
    SELECT ctx, next, q, sum(q) OVER (PARTITION BY ctx ORDER BY next ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS hi
    FROM """ + softmax_sql(TOPK) + "))"

_reg("lm_01", with_(_LM, "SELECT ctx, CAST(next AS INTEGER) AS next, CAST(c AS BIGINT) AS c FROM counts"))
_reg("lm_02", with_(_LM, """SELECT ctx, CAST(next AS INTEGER) AS next, CAST(c AS BIGINT) AS c, CAST(total AS BIGINT) AS total,
                               round(p, 9) AS p, round(logit, 9) AS logit FROM dist"""))
_reg("lm_03", with_(_LM + ["bt AS (SELECT [a.id] AS ctx, b.id AS next FROM bstream a JOIN bstream b ON b.gpos = a.gpos + 1)"],
                    f"SELECT CAST(count(*) AS BIGINT) AS n_targets, round(avg(nll), 9) AS loss FROM {nll_sql('bt')}"))
_EVAL = _LM + ["bn AS (SELECT count(*) AS n FROM bstream)", f"""ev AS (
  SELECT (s.gpos - t.t) // {BATCH} AS batch, [s.id] AS ctx, nx.id AS next
  FROM bstream s, range(0, {CONTEXT}) t(t), bn, bstream nx
  WHERE nx.gpos = s.gpos + 1 AND s.gpos - t.t >= 0 AND s.gpos - t.t <= least({20 * BATCH - 1}, bn.n - {CONTEXT} - 1))"""]
_reg("lm_04", with_(_EVAL, f"""
SELECT CAST(count(*) AS BIGINT) AS n_batches, round(avg(l), 9) AS loss, round(exp(avg(l)), 9) AS perplexity
FROM (SELECT batch, avg(nll) AS l FROM {nll_sql('ev')} GROUP BY batch)"""))
_reg("lm_05", with_(_LM + ["bt AS (SELECT [a.id] AS ctx, b.id AS next FROM bstream a JOIN bstream b ON b.gpos = a.gpos + 1)"],
                    f"SELECT round(avg(nll), 9) AS loss, round(exp(avg(nll)), 9) AS perplexity FROM {nll_sql('bt')}"))
_reg("lm_06", with_(_LM, f"SELECT ctx, CAST(next AS INTEGER) AS next, round(q, 9) AS q FROM {softmax_sql(None)}"))
_reg("lm_07", with_(_LM, f"SELECT ctx, CAST(next AS INTEGER) AS next, round(q, 9) AS q FROM {softmax_sql(TOPK_SMALL)}"))
_reg("lm_08", with_(_LM + [_SAMP, f"req AS (SELECT DISTINCT ctx, {hexu("'0:' || array_to_string(ctx, ',')")} AS u FROM samp)"], """
SELECT r.ctx, CAST(s.next AS INTEGER) AS next FROM req r JOIN samp s ON s.ctx = r.ctx AND s.lo <= r.u * s.tot AND r.u * s.tot < s.hi"""))

CTE_PROMPT_WORDS = f"""pwords AS (
  SELECT doc_id, unnest(arr) AS word, generate_subscripts(arr, 1) - 1 AS pos
  FROM (SELECT conv_id AS doc_id, regexp_extract_all(lower(text), {q(WORD_PATTERN)}, 0) AS arr
        FROM conversations WHERE turn = 0 AND role = 'user'))"""
_GEN = _LM + [_SAMP, CTE_PROMPT_WORDS] + encode_ctes("pwords", sfx="_p") + [
    "ctxs AS (SELECT DISTINCT ctx FROM samp)",
    """g0 AS (SELECT p.conv_id AS prompt_id, coalesce(a.ids, CAST([] AS INTEGER[])) AS ids
           FROM (SELECT conv_id FROM conversations WHERE turn = 0 AND role = 'user') p LEFT JOIN (
             SELECT doc_id, list(CAST(id AS INTEGER) ORDER BY pos, k) AS ids FROM occ_ids_p WHERE id IS NOT NULL GROUP BY doc_id) a
           ON a.doc_id = p.conv_id)"""]
_GEN.append(f"""gen AS (
  SELECT 0 AS step, prompt_id, ids FROM g0
  UNION ALL
  SELECT r.step + 1, r.prompt_id, list_append(r.ids, CAST(s.next AS INTEGER))
  FROM (SELECT g.step, g.prompt_id, g.ids, CASE WHEN c.ctx IS NOT NULL THEN c.ctx ELSE CAST([] AS INTEGER[]) END AS ctx,
               {hexu("'0:' || CAST(g.prompt_id AS VARCHAR) || ':' || CAST(g.step AS VARCHAR)")} AS u
        FROM gen g LEFT JOIN ctxs c ON len(g.ids) >= 1 AND c.ctx = [g.ids[len(g.ids)]] WHERE g.step < {GEN_STEPS}) r
  JOIN samp s ON s.ctx = r.ctx AND s.lo <= r.u * s.tot AND r.u * s.tot < s.hi)""")
_GEN.append(f"done AS MATERIALIZED (SELECT prompt_id, ids FROM gen WHERE step = {GEN_STEPS})")
_reg("lm_09", with_(_GEN, """
SELECT g.prompt_id, g.ids, coalesce(t.text, '') AS text FROM done g LEFT JOIN (
  SELECT prompt_id, string_agg(v.token, '' ORDER BY i) AS text
  FROM (SELECT prompt_id, unnest(ids) AS id, generate_subscripts(ids, 1) AS i FROM done) x
  JOIN vocab v ON v.id = x.id GROUP BY prompt_id) t USING (prompt_id)""").replace("WITH ", "WITH RECURSIVE ", 1))

# contexts of every length, as lists of the tokens before
_reg("lm_02_smoothed", with_(_LM, """
SELECT d.ctx, CAST(d.next AS INTEGER) AS next, CAST(d.c AS BIGINT) AS c, CAST(d.total AS BIGINT) AS total,
       round((d.c + 1.0) / (d.total + V.v), 9) AS p, round(ln((d.c + 1.0) / (d.total + V.v)), 9) AS logit FROM dist d, V
UNION ALL
SELECT ctx, -1, 0, CAST(t AS BIGINT), round(1.0 / (t + V.v), 9), round(ln(1.0 / (t + V.v)), 9)
FROM (SELECT ctx, sum(c) AS t, count(*) AS k FROM counts GROUP BY ctx), V WHERE k < V.v"""))


def before_sql(src: str, extra: str = "") -> str:
    return f"""SELECT gpos, id{extra}, lag(id, 1) OVER w AS a, lag(id, 2) OVER w AS b, lag(id, 3) OVER w AS d
  FROM {src} WINDOW w AS (ORDER BY gpos)"""


_CTX = {0: "CAST([] AS INTEGER[])", 1: "[a]", 2: "[b, a]", 3: "[d, b, a]"}
_HAS = {0: "TRUE", 1: "a IS NOT NULL", 2: "b IS NOT NULL", 3: "d IS NOT NULL"}
_LEVELS = _LM + [f"back AS MATERIALIZED ({before_sql('stream')})", f"bback AS MATERIALIZED ({before_sql('bstream')})",
                 "levels AS MATERIALIZED (" + " UNION ALL ".join(
                     f"SELECT {_CTX[k]} AS ctx, id AS next, count(*) AS c FROM back WHERE {_HAS[k]} GROUP BY 1, 2" for k in range(4)) + ")",
                 "tots AS MATERIALIZED (SELECT ctx, sum(c) AS t FROM levels GROUP BY ctx)"]
_reg("lm_02_orders", with_(_LEVELS, """
SELECT ctx, CAST(next AS INTEGER) AS next, CAST(c AS BIGINT) AS c, CAST(t AS BIGINT) AS total, round(c / t, 9) AS p,
       round(ln(c / t), 9) AS logit FROM levels JOIN tots USING (ctx)"""))


def backed_sql(src: str, n: int) -> str:
    """-ln p of the rows of ``src`` (next and the contexts s0, s1, ..., null if
    too short) under the model of order n."""
    joins = " ".join(f"LEFT JOIN tots t{k} ON t{k}.ctx = s.s{k}" for k in range(n))
    used = "CASE " + " ".join(f"WHEN t{k}.t IS NOT NULL THEN {{}}{k}{{}}" for k in reversed(range(n))) + " END"
    inner = f"SELECT s.*, {used.format(*['s.s', ''] * n)} AS ctx, {used.format(*['t', '.t'] * n)} AS t FROM {src} s {joins}"
    return f"""(SELECT x.*, -ln((coalesce(l.c, 0) + 1.0) / (x.t + V.v)) AS nll
  FROM ({inner}) x LEFT JOIN levels l ON l.ctx = x.ctx AND l.next = x.next, V)"""



_reg("lm_03_orders", with_(_LEVELS, " UNION ALL ".join(
    f"SELECT {n} AS n, CAST(count(*) AS BIGINT) AS n_targets, round(avg(nll), 9) AS loss FROM "
    + backed_sql(f"(SELECT id AS next, {', '.join(f'{_CTX[k]} AS s{k}' for k in range(n))} FROM bback WHERE {_HAS[n - 1]})", n)
    for n in range(1, 5))))


def _eval_src(n: int) -> str:
    """Targets of the stride-1 windows of the first 20 batches; a context does not
    reach before its window."""
    rows = ", ".join(f"CASE WHEN t.t + 1 >= {k} THEN {_CTX[k]} END AS s{k}" for k in range(n))
    return f"""(SELECT (x.gpos - 1 - t.t) // {BATCH} AS batch, x.id AS next, {rows}
  FROM bback x, range(0, {CONTEXT}) t(t), bn
  WHERE x.gpos - 1 - t.t >= 0 AND x.gpos - 1 - t.t <= least({20 * BATCH - 1}, bn.n - {CONTEXT} - 1))"""


_reg("lm_04_orders", with_(_LEVELS + ["bn AS (SELECT count(*) AS n FROM bstream)"], " UNION ALL ".join(
    f"SELECT {n} AS n, CAST(count(*) AS BIGINT) AS n_batches, round(avg(l), 9) AS loss, round(exp(avg(l)), 9) AS perplexity "
    f"FROM (SELECT batch, avg(nll) AS l FROM {backed_sql(_eval_src(n), n)} GROUP BY batch)" for n in range(1, 5))))


# ------------------------------------------------------------------ run metrics
LOG_EVERY, EVAL_EVERY, SAVE_EVERY = 5, 10, 30
CTE_LOG = """train_log AS MATERIALIZED (
  SELECT user_id AS run_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS step,
         value / 100.0 AS loss, ts FROM events)"""
_reg("met_01", with_([CTE_LOG], f"""
SELECT run_id, step, round(a, 9) AS avg_loss FROM (
  SELECT run_id, step, avg(loss) OVER (PARTITION BY run_id ORDER BY step ROWS BETWEEN {LOG_EVERY - 1} PRECEDING AND CURRENT ROW) AS a
  FROM train_log) WHERE step % {LOG_EVERY} = 0"""))
_reg("met_02", with_([CTE_LOG], f"""
SELECT run_id, step, round(loss, 9) AS val_loss, round(exp(loss), 9) AS perplexity FROM train_log WHERE step % {EVAL_EVERY} = 0"""))
_reg("met_03", with_([CTE_LOG], f"""
SELECT run_id, step, round(loss, 9) AS val_loss,
       coalesce(loss < min(loss) OVER (PARTITION BY run_id ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                loss < 'inf'::DOUBLE) AS is_best
FROM train_log WHERE step % {EVAL_EVERY} = 0"""))
_reg("met_04", with_([CTE_LOG], f"""
SELECT run_id, CAST(arg_min(step, (loss, step)) AS BIGINT) AS best_step, round(min(loss), 9) AS best_loss
FROM train_log WHERE step % {EVAL_EVERY} = 0 GROUP BY run_id"""))
_reg("met_05", with_([CTE_LOG], f"""
SELECT run_id, step, round(el, 6) AS elapsed,
       round(CASE WHEN el = 0 THEN NULL ELSE step * 32 * 256 / el END, 6) AS tokens_per_sec
FROM (SELECT run_id, step, (epoch_us(ts) - min(epoch_us(ts)) OVER (PARTITION BY run_id)) / 1e6 AS el FROM train_log)
WHERE step % {LOG_EVERY} = 0"""))
_reg("met_06", with_([CTE_LOG], f"""
SELECT run_id, step, step = last AS is_final FROM (
  SELECT run_id, step, max(step) OVER (PARTITION BY run_id) AS last FROM train_log)
WHERE step % {SAVE_EVERY} = 0 OR step = last"""))
_reg("snk_04", with_([CTE_LOG], f"""
SELECT run_id, step, printf('%d,%.6f,%.6f,%.8f,%.2f,%.4f', step, tl, loss,
  CASE WHEN step - 1 < 500 THEN 3e-4 * step / 500.0
       WHEN step - 1 > 15000 THEN 3e-5
       ELSE 3e-5 + 0.5 * (1.0 + cos(pi() * (step - 1 - 500) / 14500.0)) * (3e-4 - 3e-5) END,
  el, exp(loss)) AS line
FROM (SELECT run_id, step, loss,
             avg(loss) OVER (PARTITION BY run_id ORDER BY step ROWS BETWEEN {LOG_EVERY - 1} PRECEDING AND CURRENT ROW) AS tl,
             (epoch_us(ts) - min(epoch_us(ts)) OVER (PARTITION BY run_id)) / 1e6 AS el FROM train_log)
WHERE step % {EVAL_EVERY} = 0"""))


# ------------------------------------------------------------------ streaming
# the stream forms must give the batch results
ORACLES["str_01"] = ORACLES["cln_14"]
ORACLES["str_02"] = ORACLES["tok_12"]
_reg("str_03", with_([CTE_WORDS], "SELECT word, CAST(count(*) AS BIGINT) AS freq FROM words GROUP BY word"))
_reg("str_04", """
SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start, user_id AS run_id,
       round(avg(value / 100.0), 9) AS mean_loss, round(exp(avg(value / 100.0)), 9) AS perplexity,
       CAST(count(*) AS BIGINT) AS n
FROM events GROUP BY 1, 2""")

_reg("str_04_append", f"""
SELECT * FROM ({ORACLES['str_04']})
WHERE window_start + INTERVAL '1 hour' <= (SELECT max(ts) FROM events) - INTERVAL '10 minutes'""")

# a row is out once the watermark, whole milliseconds, has passed it
_reg("str_04_live", with_([CTE_LOG], f"""
SELECT run_id, step, CASE WHEN step % {LOG_EVERY} = 0 THEN round(m, 9) END AS avg_loss,
       CASE WHEN step % {EVAL_EVERY} = 0 THEN round(loss, 9) END AS val_loss,
       CASE WHEN step % {EVAL_EVERY} = 0 THEN loss < coalesce(low, 'inf'::DOUBLE) END AS is_best
FROM (SELECT run_id, step, loss, ts,
             avg(loss) OVER (PARTITION BY run_id ORDER BY step ROWS BETWEEN {LOG_EVERY - 1} PRECEDING AND CURRENT ROW) AS m,
             min(CASE WHEN step % {EVAL_EVERY} = 0 THEN loss END) OVER (
               PARTITION BY run_id ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS low
      FROM train_log)
WHERE (step % {LOG_EVERY} = 0 OR step % {EVAL_EVERY} = 0)
  AND epoch_us(ts) <= (SELECT epoch_us(max(ts)) // 1000 * 1000 - 600000000 FROM events)"""))


# ------------------------------------------------------------------ sources / sinks
def line_report_sql(text: str) -> str:
    """Characters, newlines and an order-dependent sum over the lines of one text."""
    return f"""SELECT CAST(length({text}) AS BIGINT) AS chars, CAST(len(ls) - 1 AS BIGINT) AS newlines, CAST(0 AS BIGINT) AS carriage_returns,
  CAST(list_sum(list_transform(ls, lambda l, i: length(l) * ((i - 1) % 9973))) AS BIGINT) AS placed_chars"""


_reg("src_01", with_([CTE_WIKI_RAW, f"one AS (SELECT string_agg(text || {NL}, '' ORDER BY doc_id) AS t FROM wiki_raw)"],
                     line_report_sql("t") + f" FROM (SELECT t, string_split(t, {NL}) AS ls FROM one)"))
_reg("snk_01_text", with_(_PARTS, " UNION ALL ".join(
    line_report_sql("t").replace("SELECT ", f"SELECT '{s}' AS split, ", 1) + f" FROM (SELECT {c} AS t, string_split({c}, {NL}) AS ls FROM parts)"
    for s, c in (("train", "tr"), ("val", "va")))))
_reg("src_02", with_([CTE_WIKI_RAW], """
SELECT doc_id, 'https://example.org/?curid=' || CAST(doc_id AS VARCHAR) AS url,
       'Title number ' || CAST(doc_id AS VARCHAR) AS title, text FROM wiki_raw"""))
_reg("src_03", f"SELECT * FROM ({ORACLES['spl_03']}) WHERE split = 'train'")
ORACLES["snk_01"] = ORACLES["spl_03"]
ORACLES["snk_02"] = ORACLES["tok_10"]
ORACLES["src_04"] = ORACLES["tok_08"]
ORACLES["snk_03"] = ORACLES["tok_12"]
_reg("src_05", f"SELECT doc_id, CAST(len(ids) AS BIGINT) AS n_ids, CAST(coalesce(list_sum(ids), 0) AS BIGINT) AS sum_ids "
               f"FROM ({ORACLES['tok_12']})")

_reg("snk_03_uint16", with_(_STREAM, """
SELECT CAST(gpos // 65536 AS BIGINT) AS block, count(*) AS n, CAST(sum(id * (gpos % 9973)) AS BIGINT) AS placed_ids
FROM stream GROUP BY 1"""))
ORACLES["src_05_uint16"] = ORACLES["dat_02"]


# ------------------------------------------------------------------ from raw text to windows
def _part_words(name: str, column: str) -> str:
    return f"""{name} AS (SELECT 0 AS doc_id, unnest(arr) AS word, generate_subscripts(arr, 1) - 1 AS pos
  FROM (SELECT regexp_extract_all(lower({column}), {q(WORD_PATTERN)}, 0) AS arr FROM parts))"""


def _part_report(split: str, column: str, ids: str) -> str:
    return f"""SELECT '{split}' AS split, chars, n AS tokens, round(n * 2 / 1048576.0, 6) AS size_mb,
    round(CASE WHEN n = 0 THEN NULL ELSE chars / n END, 6) AS chars_per_token,
    (SELECT CAST(count(DISTINCT g // {CONTEXT}) AS BIGINT) FROM s_{split} WHERE g // {CONTEXT} * {CONTEXT} < n - {CONTEXT}) AS n_windows,
    (SELECT CAST(sum(id * (g % 9973)) AS BIGINT) FROM s_{split} WHERE g // {CONTEXT} * {CONTEXT} < n - {CONTEXT}) AS placed_ids
  FROM (SELECT CAST(length({column}) AS BIGINT) AS chars FROM parts), (SELECT CAST(count(*) AS BIGINT) AS n FROM s_{split})"""


_reg("pipe_01", with_(
    _PARTS + train_ctes(words=_part_words("words", "tr")) + [_part_words("vwords", "va")] + encode_ctes("words")
    + encode_ctes("vwords", sfx="_v") + [
        f"""s_{split} AS MATERIALIZED (SELECT row_number() OVER (ORDER BY pos, k) - 1 AS g, CAST(id AS BIGINT) AS id
            FROM {ids} WHERE id IS NOT NULL)""" for split, ids in (("train", "occ_ids"), ("val", "occ_ids_v"))],
    _part_report("train", "tr", "occ_ids") + "\nUNION ALL\n" + _part_report("val", "va", "occ_ids_v")))


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
