"""Each operator against a brute-force version on small rows with nulls, empty
and long texts, ties, repeated rows, empty tables and clashing columns."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from corpuslm.llm import chat, decontam, extract, linededup, minhash, pack, pii, quality, shards, urls, vec

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, node string, cut string, n long"


def _lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    vocab = ["".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 9))) for _ in range(300)]
    line = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    passage = line(60)
    base = [line(rng.randint(5, 40)) + "\n" + line(30) for _ in range(40)]
    near = base[3].split(" ")
    near[5] = "changed"
    out = [*base, base[0], base[0], " ".join(near), passage + "\n" + base[1], base[2] + "\n" + passage, passage,
           None, "", None, "", " \n\n ", "one", "a b c", "x" * 30000, line(4000), "\n".join([line(5)] * 30),
           "\n".join([passage] * 3), "Zoë a@b.c._d@e.f 1.2.3.4.5 4111 1111-1111 1111 +1 (269) 555-3296 GB82 WEST 1234 5698 7654 32"]
    return out


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "en" if i % 2 else None, "s", None, "n", "c", 1) for i, t in enumerate(texts)]
    rows += [(None, texts[4], "en", "s", 1, "n", "c", 1), rows[7], rows[7]]
    return spark.createDataFrame(rows, DOCS).repartition(3)


def test_span_hashes_depend_on_bytes_only():
    rows = ["ab cdefghijk x", "", "x ab", "é" * 20 + " ab"]
    (sl,) = vec.slices(pa.array(rows))
    s, e, first = sl.words(vec.SPACE_WORD)
    h = dict(zip((bytes(sl.data[a:z]) for a, z in zip(s, e, strict=True)), sl.hash_spans(s, e), strict=True))
    assert len(set(h.values())) == len(h) == 4 and first.tolist() == [0, 3, 3, 5, 7]


def test_decontamination(spark, docs, texts):
    items = [(1, texts[10]), (1, texts[11]), (20, texts[12].upper()), (3, "A, b c"), (None, texts[13]), (5, None), (6, "?!")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    wins = {}
    for i, t in items:
        w = WORD.findall(_lower(t))
        if i is not None:
            for k in range(max(1, len(w) - 12) if w else 0):
                wins.setdefault(tuple(w[k: k + 13]), set()).add(str(i))
    want = []
    for r in docs.collect():
        w, hit, ids = WORD.findall(_lower(r["text"])), set(), set()
        for n in {len(x) for x in wins}:
            for k in range(len(w) - n + 1):
                if tuple(w[k: k + n]) in wins:
                    hit |= set(range(k, k + n))
                    ids |= wins[tuple(w[k: k + n])]
        sha = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        want.append((r["doc_id"], len(w), len(hit), len(ids), sha, len(hit) > 0 and 20 * len(hit) >= len(w)))
    for block_chars in (decontam.BLOCK_CHARS, 300):  # one block of items, and several
        got = [tuple(r) for r in decontam.report(docs, bench, block_chars=block_chars).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
        kept = decontam.remove_contaminated(docs, bench, block_chars=block_chars)
        assert kept.columns == docs.columns and kept.count() == sum(not x[5] for x in want)
    assert decontam.report(docs.limit(0), bench).count() == 0
    assert decontam.report(docs, bench.limit(0)).filter("n_hit > 0").count() == 0


def test_quality(docs):
    for r in quality.report(docs).join(docs.select("doc_id", "text").distinct(), "doc_id").collect():
        t = r["text"] or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        win = [tuple(w[i: i + 8]) for i in range(len(w) - 7)]
        rep = {i + j for i, x in enumerate(win) if win.count(x) > 1 for j in range(8)}
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (
            len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(rep))
        assert r["base_failed"] == (len(w) < 20 or 100 * len(rep) > 30 * len(w))
        assert not (r["base_failed"] and r["kept"])
    p = np.array([[1.0, 0, 0], [0.2, 0.3, 0.5], [0, 0, 0]])
    q = np.array([0.2, 0.3, 0.5])
    m = (p[0] + q) / 2
    kl = lambda a, b: sum(x * np.log2(x / y) for x, y in zip(a, b, strict=True) if x)
    assert np.allclose(quality.js_distance(p, q), [np.sqrt((kl(p[0], m) + kl(q, m)) / 2), 0, 0])
    assert quality.report(docs.limit(0)).count() == 0 and quality.keep_good(docs).columns == docs.columns


def test_line_dedup(docs, texts):
    got = linededup.dedup_lines(docs).collect()
    assert len(got) == docs.count()
    seen, before = set(), {}
    for r in sorted(got, key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0)):
        t = texts[r["doc_id"]] if r["doc_id"] is not None else texts[4]
        if t is None:
            assert r["text"] is None
            continue
        assert r["__n_lines"] == len(t.split("\n"))
        kept = r["text"].split("\n") if r["text"] else []
        rest = iter(t.split("\n"))
        assert all(x in rest for x in kept)  # a subsequence of the lines
        for x in kept:
            if len(x.split()) >= linededup.MIN_WORDS:  # a long line stays in its first document only
                assert before.setdefault(x, r["doc_id"]) == r["doc_id"] or r["doc_id"] is None
        seen |= set(kept)
    assert seen >= {x for t in texts if t for x in t.split("\n") if len(x.split()) >= linededup.MIN_WORDS}
    assert linededup.dedup_lines(docs.limit(0)).count() == 0


def test_first_least_by_brute_force():
    rng = np.random.default_rng(5)
    h = rng.integers(0, 9, 60).astype(np.uint64)
    lo = np.arange(50)
    hi = lo + rng.integers(0, 10, 50)
    assert linededup._first_least(h, lo, hi).tolist() == [int(a + np.argmin(h[a: z + 1])) for a, z in zip(lo, hi, strict=True)]


def test_near_duplicates(docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]

    def shingles(t):
        w = WORD.findall(_lower(t))
        return {tuple(w[i: i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            a, b = rows[i][1], rows[j][1]
            x, y = shingles(a), shingles(b)
            if a is not None and (a == b or x and y and len(x & y) >= 0.8 * len(x | y)):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    want = []
    for i, (doc, t) in enumerate(rows):
        ids = [d for k, (d, _) in enumerate(rows) if group[k] == group[i] and d is not None]
        name = doc if t is None else min(ids, default=None)
        want.append((doc, name, doc == name))
    got = [tuple(r) for r in minhash.classes(docs).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    kept = minhash.keep_first(docs)
    assert kept.columns == docs.columns
    assert kept.filter("text is not null").count() == len({g for g, (_, t) in zip(group, rows, strict=True) if t is not None})
    assert minhash.classes(docs.limit(0)).count() == 0


def test_components_grow_by_further_links(spark):
    rng = random.Random(4)
    links = [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(55)] + [(k, k + 1) for k in range(100, 130)]
    rng.shuffle(links)
    group = {x: x for link in links for x in link}
    comp = None
    for part in (links[:40], links[40:60], links[60:]):
        comp = minhash._merged(comp, spark.createDataFrame(part, "a int, b int"), len(part))
        for a, b in part:
            group = {x: group[a] if g == group[b] else g for x, g in group.items()}
        got = {}
        for r in comp.collect():
            got.setdefault(r["comp"], []).append(r["node"])
        want = {}
        for x, g in group.items():
            want.setdefault(g, []).append(x)
        assert sorted(sorted(x) for x in got.values()) == sorted(sorted(x) for x in want.values() if len(x) > 1)


def test_prob_minhash_estimates_probability_jaccard():
    n, m = 400, 4096
    elem = vec.mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(77))
    w = np.ones(n)
    row = np.concatenate([np.zeros(300), np.ones(300)]).astype(np.int64)
    both = np.concatenate([elem[:300], elem[100:]])
    sig = minhash.prob_minhash(row, both, np.concatenate([w[:300], w[100:]]), 2, m)
    assert abs((sig[0] == sig[1]).mean() - 0.5) < 0.04


def test_packing(docs, texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    got = pack.pack(docs, path, pack.Params(capacity=256, deme_size=16)).collect()
    want = []
    for r in docs.collect():
        ids = tok.encode(r["text"] or "", add_special_tokens=False).ids + [1]
        for k in range(0, len(ids), 256):
            cut = ids[k: k + 256]
            want.append((r["doc_id"], k // 256, k, len(cut), zlib.crc32(np.array(cut, dtype="<u4").tobytes())))
    assert sorted((tuple(r)[:5] for r in got), key=str) == sorted(want, key=str)
    seqs = {}
    for r in got:
        seqs.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for s in seqs.values():
        at = 0
        for off, n in sorted(s):
            assert off == at
            at += n
        assert at <= 256
    assert len(seqs) <= 1.1 * sum(w[3] for w in want) / 256 + 1
    assert pack.pack(docs.limit(0), path).count() == 0


def test_packed_sequences_hold_their_ids(docs):
    """The real output: the ids of a sequence are those of its pieces, one after another."""
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    texts = {}
    for r in docs.collect():
        texts.setdefault(r["doc_id"], set()).add(tuple(tok.encode(r["text"] or "", add_special_tokens=False).ids + [1]))
    got = pack.sequences(docs, path, pack.Params(capacity=256, deme_size=16)).collect()
    n = 0
    for s in got:
        ids = np.frombuffer(s["ids"], dtype="<u4").tolist()
        assert len(ids) == sum(x["length"] for x in s["parts"]) <= 256
        for x in s["parts"]:
            own = tuple(ids[x["offset"]: x["offset"] + x["length"]])
            assert any(t[x["start"]: x["start"] + x["length"]] == own for t in texts[x["doc_id"]])
            n += 1
    assert n == pack.pieces(docs, path, 256).count() and len({s["sequence_id"] for s in got}) == len(got)


def test_the_genetic_search_saves_bins():
    """Lengths where best fit by falling length is far from the bound."""
    for low, high, at_most in ((1000, 1700, 0.94), (800, 2000, 0.98)):
        sizes = sorted(np.random.default_rng(low).integers(low, high + 1, size=600).tolist(), reverse=True)
        plain = []
        pack.best_fit(sizes, list(range(600)), plain, [], 4096)
        best = pack.evolve(sizes, [], pack.Params(), 1)
        assert sorted(i for x in best for i in x) == list(range(600))
        assert max(sum(sizes[i] for i in x) for x in best) <= 4096
        assert -(-sum(sizes) // 4096) <= len(best) <= at_most * len(plain)


def test_the_genetic_search_against_all_packings():
    """Small sets: the fewest bins, found by trying everything."""
    def fewest(sizes, room):
        best = [len(sizes)]

        def put(k, fill):
            if len(fill) >= best[0]:
                return
            if k == len(sizes):
                best[0] = len(fill)
                return
            for i in {f: i for i, f in enumerate(fill) if f + sizes[k] <= room}.values():
                put(k + 1, [f + sizes[k] * (j == i) for j, f in enumerate(fill)])
            put(k + 1, [*fill, sizes[k]])
        put(0, [])
        return best[0]

    rng = np.random.default_rng(8)
    for k in range(25):
        sizes = sorted(rng.integers(1, 60, size=10).tolist(), reverse=True)
        assert len(pack.evolve(sizes, [], pack.Params(capacity=100), k)) == fewest(sizes, 100)
    assert pack.evolve([5], [], pack.Params(capacity=5), 0) == [[0]]


def test_unit_ids_on_odd_texts():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tok, units = Tokenizer.from_file(path), pack.UnitIds(path, entries=40)
    odd = ["a b c\u0085e\x1cf\x1dg", "ΑΣ Σ İstanbul é ́x don't I'LL it's ,'s '", "<|endoftext|> x <|startoftext|>",
           "ab​cd　ef", "ﬁ½ … 한국어 👍🏽", "", "a×b÷C É,é;Ž1Ɏ =≠ = ̸ẞß“q”,“ ’s l’été 12,345.67", *["w%d tail" % i for i in range(99)]]
    for sl in vec.slices(pa.array(odd)):
        ids, first = units.encode(sl)
        for r in range(sl.rows):
            assert ids[first[r]: first[r + 1]].tolist() == tok.encode(odd[r], add_special_tokens=False).ids


def _base_spans(t):
    def luhn(d):
        return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0
    rules = (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
             ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
             ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(re.sub(r"\D", "", m)) <= 19 and luhn(re.sub(r"\D", "", m))),
             ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(re.sub(r"\D", "", m)) <= 15))
    out = []
    for no, (kind, p, ok) in enumerate(rules):
        out += [(m.start(), no, f"{kind}:{m.start()}:{m.end()}") for m in re.finditer(p, t) if ok(m[0])]
    return [x[2] for x in sorted(out)]


def test_personal_data(spark):
    rng = random.Random(9)
    hard = ["é a@b.c._d@e.f 1.2.3.4.5.6.7.8 256.1.1.1", "+1 (269) 555-3296, 4111 1111-1111 1111", None, "", "9" * 5000,
            "IBAN GB82 WEST 1234 5698 7654 32", "my ssn 123-45-6789; call (555) 123-4567", "123-45-6789 " * 300]
    hard += ["".join(rng.choice("ab@.+- ()0123459é\n") for _ in range(rng.randint(1, 300))) for _ in range(150)]
    d = spark.createDataFrame([(i, t, 1) for i, t in enumerate(hard)], "doc_id long, text string, spans int")
    got = {r["doc_id"]: r for r in pii.report(d).collect()}
    for i, t in enumerate(hard):
        want = _base_spans(t or "")
        assert got[i]["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest(), t
        assert set(want) <= set((got[i]["spans"] or "").split(",")) | {""}
        assert got[i]["n_email"] == sum(x.startswith("email") for x in want)
    assert "iban:5:32" in got[5]["spans"] and "ssn:7:18" in got[6]["spans"] and "local_phone" in got[6]["spans"]
    text = {r["doc_id"]: r["text"] for r in pii.redact(d).collect()}
    assert text[5] == "IBAN [iban]" and text[2] is None and text[1] == "[phone], [card]"
    assert pii.report(d.limit(0)).count() == 0


def test_sharding(spark, docs, tmp_path):
    placed, versions = shards.shard_by_bytes(docs, n_shards=4, n_slots=64)
    rows = placed.collect()
    assert len(rows) == docs.count()
    size = {}
    for s in range(4):
        mine = sorted(r["slot"] for r in rows if r["shard"] == s)
        assert mine == list(range(len(mine)))
        size[s] = sum(r["size"] for r in rows if r["shard"] == s)
    want = sorted((r["doc_id"] is None, r["doc_id"] or 0, len((r["text"] or "").encode()) + 1,
                   zlib.crc32((r["text"] or "").encode())) for r in docs.collect())
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["size"], r["text_crc32"]) for r in rows) == want
    shards.write_map(spark, versions, str(tmp_path / "m"))
    assert shards.read_map(spark, str(tmp_path / "m")) == versions[2]
    assert shards.read_map(spark, str(tmp_path / "m"), 1) == versions[1]
    even = shards.rebalance(versions[1], {v: 10 + v % 7 for v in range(64)}, 4)
    load = [sum(10 + v % 7 for v, s in even.items() if s == k) for k in range(4)]
    assert max(load) - min(load) <= 1
    grown = shards.rebalance(even, {v: 10 + v % 7 for v in range(64)}, 5)
    assert 64 // 5 - 2 <= sum(grown[v] != even[v] for v in range(64)) <= 64 // 5 + 8  # little more than the new share
    assert shards.shard_by_bytes(docs.limit(0))[0].count() == 0


def test_chat_collapse(spark):
    turns = {1: ["u:a", "a:b"], 2: ["u:a", "a:b", "u:c"], 3: ["u:a", "a:b", "u:c"], 4: ["u:a"], 5: ["u:z"], 6: ["a:b"],
             7: [f"u:{i}" for i in range(600)], 8: [f"u:{i}" for i in range(300)], None: ["u:n"]}
    rows = [(c, k, t[0], t[2:], 1) for c, ts in turns.items() for k, t in enumerate(ts)] + [(9, None, None, None, 1)]
    conv = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, pos int").repartition(4)
    got = {(r["conv_id"], r["part"]): r for r in chat.format_chats(conv).collect()}
    assert set(got) == {(2, 0), (5, 0), (6, 0), (7, 0), (7, 1), (7, 2), (None, 0), (9, -1)}
    assert got[2, 0]["n_copies"] == 2 and got[2, 0]["text"] == "".join(
        f"<|im_start|>{t[0]}\n{t[2:]}<|im_end|>\n" for t in turns[2])
    assert got[7, 2]["text"].count("<|im_start|>") == 600 - 512 and got[7, 0]["n_turns"] == 600
    assert chat.format_chats(conv.limit(0)).count() == 0


def test_urls(spark):
    us = ["https://A.Example.NET/en/1?x", "http://b.net/fr/", "https://x.org/fr/a#t", "http://example.com/de/1",
          "http://notexample.com/de/1", None, "nothing", "http://b.net", "http://u.org?q=/fr/", "://c.net/en/://x"]
    us += [f"http://h.org/bad/{i}" for i in range(30)] + [f"http://h.org/good/{i}.html" for i in range(30)]
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(us)], "page_id long, url string, host string")
    got = {r["page_id"]: r for r in urls.verdicts(pages).collect()}
    assert [(got[i]["host"], got[i]["path"], got[i]["rule"]) for i in range(10)] == [
        ("a.example.net", "/en/1", "example.net/en/"), ("b.net", "/fr/", "net/"), ("x.org", "/fr/a", "org/fr/"),
        ("example.com", "/de/1", "example.com/de/"), ("notexample.com", "/de/1", None), ("", "", None), ("", "", None),
        ("b.net", "", None), ("u.org", "", None), ("c.net", "/en/://x", "net/")]
    labels = spark.createDataFrame([(i, i < 40) for i in range(10, 70)], "page_id long, bad boolean")
    got = {r["page_id"]: r["verdict"] for r in urls.verdicts(pages, labels=labels).collect()}
    assert {got[i] for i in range(10, 40)} == {"block"} and {got[i] for i in range(40, 70)} == {"allow"}
    assert urls.verdicts(pages.limit(0)).count() == 0


def test_extraction(spark):
    page = """<html><head><title>T</title><script>var t="</p><article>no</article>";</script></head><body>
    <nav><a href="/">Home</a></nav><div class="cookie-notice"><p>We use many cookies on this site, please agree</p></div>
    <article><header><h1>A &amp; B</h1></header><p>First  <b>bo</b>ld<br>line&nbsp;two<p>Short.<!-- <p>no</p> -->
    <aside>Read also this other article of ours</aside><form>Your name <input name=x></form>
    <section id="comments"><article><p>A reader says something long about it all</p></article></section>
    <p>Last.</article><footer>&copy; us</footer></body></html>"""
    d = spark.createDataFrame([(1, "u", page, 1), (2, None, None, 1), (3, "v", "<p", 1), (1, "u", page, 1)],
                              "page_id long, url string, html string, text int")
    got = sorted((tuple(r) for r in extract.extract(d).collect()), key=str)
    want = "A & B First bold line two Short. Last."
    assert got[0] == got[1] == (1, "u", want, len(want)) and got[2][2:] == ("", 0)
    assert extract.extract(d.limit(0)).count() == 0
    tree = extract.train()
    assert sum(extract.classify(tree, r[:-1]) == bool(r[-1]) for r in extract.LABELLED) >= 0.95 * len(extract.LABELLED)


def test_pipeline_equals_its_stages_by_hand(spark):
    import corpus_pipeline as P
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in P.STAGES[:-1]:
        after = stage(spark, docs, sf).checkpoint()
        assert after.columns == docs.columns and after.schema == docs.schema, name
        assert after.count() <= docs.count()
        docs = after
    assert {r["doc_id"] for r in P.run(spark, sf).select("doc_id").collect()} == {
        r["doc_id"] for r in docs.select("doc_id").collect()}


def test_written_shards_hold_whole_records_and_the_map_is_edited(spark, tmp_path):
    from pyspark.sql import functions as F

    long = "word " * 30_000
    rows = [(i, f"text {i} " * (i % 9), "x", i) for i in range(300)] + [(7, "copy", "x", 1)] * 9_000 + [
        (7, "copy", "y", 1), (None, None, None, None), (None, "", None, None), (5, long, "z", 2), (5, long, "z", 2)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, shard string, vslot int")
    at = str(tmp_path / "s")
    version = shards.write_shards(docs, at, n_shards=4, n_slots=64)
    assert version == 2
    files = spark.read.parquet(at + "/files")
    key = lambda r: tuple((x is not None, x or 0) if i in (0, 3) else (x is not None, x or "") for i, x in enumerate(r))
    assert sorted((tuple(r) for r in files.select("record.*").collect()), key=key) == sorted(rows, key=key)
    got = shards.placed(spark, at, version).collect()
    load = {}
    for r in got:
        load.setdefault(r["shard"], []).append(r["slot"])
    assert set(load) <= set(range(4)) and all(sorted(v) == list(range(len(v))) for v in load.values())
    slot_map = shards.read_map(spark, at + "/map", version)
    assert all(slot_map[r["vslot"]] == r["shard"] for r in got)
    # the copies are spread; the next run finds the stored map, and no move is left
    assert len({r["vslot"] for r in got if r["doc_id"] == 7}) == 64
    assert shards.write_shards(docs, at, n_shards=4, n_slots=64) == version
    # other bytes: an edited version beside the stored ones; a slot stays or moves, records stay in their slots
    more = docs.unionByName(docs.filter("doc_id < 40 AND text NOT LIKE 'copy%'").withColumn("text", F.repeat("text", F.lit(50))))
    newer = shards.write_shards(more, at, n_shards=5, n_slots=64)
    assert newer == 3 and shards.read_map(spark, at + "/map", 2) == slot_map
    assert {v for v, s in shards.read_map(spark, at + "/map", 3).items() if s != slot_map[v]}
    assert len(shards.placed(spark, at, newer).collect()) == more.count()
    assert shards.write_shards(docs.limit(0), str(tmp_path / "none"), n_shards=4, n_slots=64) == 1
