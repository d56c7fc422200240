"""The template tree and the evidence of its templates against a version by hand."""

import math
import random
import re
from collections import Counter, defaultdict

import pytest
from corpuslm.llm import urls

P = urls.Params(max_branches=6, min_pages=3, min_labels=4)


def _pattern(path):
    out = []
    for s in path.split("/"):
        if s:
            out.append("{x}" if re.fullmatch(r"[0-9a-fA-F-]{12,}", s) and re.search("[0-9]", s) else re.sub("[0-9]+", "{n}", s))
    return "/".join(out)


def _by_hand(rows, p):
    """rows: (page, host, path, bad or None); per page its (template, labelled, bad, basis)."""
    count = defaultdict(Counter)
    for _, host, path, bad in rows:
        count[host, _pattern(path)].update(n=1, labelled=bad is not None, bad=bool(bad))
    template = {}
    for host in {h for h, _ in count}:
        groups = {"": [(pat, pat.split("/") if pat else []) for h, pat in count if h == host]}
        k = 0
        while groups:
            later = defaultdict(list)
            for node, paths in groups.items():
                on = [x for x in paths if len(paths) > 1 and len(x[1]) > k]
                for pat, seg in paths:
                    if (pat, seg) not in on:
                        template[host, pat] = node + ("/" + "/".join(seg[k:]) if len(seg) > k else "")
                by = defaultdict(Counter)
                for pat, seg in on:
                    by[seg[k]].update(count[host, pat])
                total = sum(by.values(), Counter())
                for pat, seg in on:
                    c = by[seg[k]]
                    l, b, rl, rb = c["labelled"], c["bad"], total["labelled"] - c["labelled"], total["bad"] - c["bad"]
                    share = total["bad"] / max(total["labelled"], 1)
                    err = math.sqrt(share * (1 - share) * (1 / max(l, 1) + 1 / max(rl, 1)))
                    same = l >= p.min_labels and rl >= p.min_labels and abs(b / max(l, 1) - rb / max(rl, 1)) <= p.z_same * err + 1e-9
                    rare = len(by) > p.max_branches and c["n"] < p.min_pages
                    later[node + "/" + ("*" if same or rare else seg[k])].append((pat, seg))
            groups, k = later, k + 1
    own, pool = defaultdict(Counter), defaultdict(Counter)
    for (host, pat), tpl in template.items():
        own[host, tpl].update(count[host, pat])
        parts = tpl.split("/")
        for i in range(2, len(parts) + 1):
            pool["/".join(parts[:i])].update(count[host, pat])
    out = {}
    for page, host, path, _ in rows:
        tpl = template[host, _pattern(path)]
        c, basis = own[host, tpl], "host"
        parts = tpl.split("/")
        while c["labelled"] < p.min_labels:
            basis = "path"
            if len(parts) < 2:
                c, basis = Counter(), None
                break
            c, parts = pool["/".join(parts)], parts[:-1]
        out[page] = (host + tpl, c["labelled"], c["bad"], basis)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_tree_and_evidence(spark, seed):
    rng = random.Random(seed)
    hosts = ["a.org", "b.net", "c.edu", "d.com"]
    rows = []
    for i in range(500):
        host = rng.choice(hosts)
        path = "".join("/" + rng.choice(["win", "news", f"p{rng.randint(1, 99)}", "0123456789abcdef", f"u{rng.choice('abcdefghij')}", ""])
                       for _ in range(rng.randint(0, 7)))
        bad = None if host in ("c.edu", "d.com") or rng.random() < 0.4 else "win" in path and rng.random() < 0.95
        rows.append((i, host, path, bad))
    pages = spark.createDataFrame([(i, f"http://{h}{x}", "x", "t") for i, h, x, _ in rows],
                                  "page_id long, url string, host string, template string").repartition(4)
    labels = spark.createDataFrame([(i, b) for i, _, _, b in rows if b is not None], "page_id long, bad boolean")
    want = _by_hand(rows, P)
    got = {r["page_id"]: r for r in urls.verdicts(pages, rules=(), labels=labels, params=P).collect()}
    assert len(got) == len(rows)
    for i, (template, labelled, bad, basis) in want.items():
        purity = round((bad + P.strength * P.prior) / (labelled + P.strength), 6)
        assert (got[i]["template"], got[i]["basis"]) == (template, basis), rows[i]
        assert abs(got[i]["purity"] - purity) < 2e-6
        assert got[i]["verdict"] == ("block" if basis and purity >= P.purity else "allow")
    assert {got[i]["basis"] for i, h, _, _ in rows if h == "c.edu"} >= {"path"}  # judged by other hosts' labels
    assert {r["verdict"] for r in got.values()} == {"allow", "block"}


def test_bad_labels_elsewhere_do_not_block_a_host_without_any(spark):
    rows = [(i, f"http://bad.net/x{i}/y") for i in range(95)] + [(100 + i, f"http://a.org/fr/{i}") for i in range(5)]
    rows += [(200 + i, f"http://good.edu/{w}/page") for i, w in enumerate(("about", "news", "team"))]
    rows += [(300, "http://good.edu/deep" + "/a" * 300), (301, "http://good.edu/deep" + "/a" * 299 + "/b"), (302, None), (302, None)]
    got = urls.verdicts(spark.createDataFrame(rows, "page_id long, url string")).collect()
    assert len(got) == len(rows)
    assert {r["verdict"] for r in got if r["page_id"] >= 200} == {"allow"}
    assert {r["template"] for r in got if r["page_id"] == 300} == {"good.edu/deep" + "/a" * 300}
