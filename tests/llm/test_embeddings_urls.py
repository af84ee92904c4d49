import numpy as np
import pytest
from harness import compare, duck
from pyspark.sql import functions as F

from lakeledger.llm import embedding_dedup as E
from lakeledger.llm import queries
from lakeledger.llm import url_filters as U


def brute(rows, threshold):
    ids = [r[0] for r in rows]
    usable = [r[1] is not None and len(r[1]) > 0 and all(v is not None and np.isfinite(v) for v in r[1]) and any(r[1])
              for r in rows]
    n = len(rows)
    label, links = list(range(n)), [0] * n
    unit = [np.array(r[1], np.float64) / np.linalg.norm(np.array(r[1], np.float64)) if ok else None
            for r, ok in zip(rows, usable, strict=True)]
    for i in range(n):
        for j in range(i):
            if usable[i] and usable[j] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold:
                links[i] += 1
                links[j] += 1
                a, b = label[i], label[j]
                label = [b if x == a else x for x in label]
    out = []
    for k in range(n):
        known = [ids[m] for m in range(n) if label[m] == label[k] and ids[m] is not None]
        comp = min(known) if known else None
        out.append((ids[k], links[k], comp, ids[k] is not None and ids[k] == comp))
    return sorted(out, key=repr)


def vectors(seed=0):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(60, 64))
    near = base[:30] + rng.normal(size=(30, 64)) * rng.uniform(0.05, 0.5, (30, 1))
    chain = [base[0] + k * 0.25 * base[1] for k in range(8)]
    rows = [(i, [float(np.float32(v)) for v in x]) for i, x in enumerate([*base, *near, *chain])]
    rows += [(1000 + i, rows[3][1]) for i in range(5)] + [(3, rows[3][1]), (None, rows[4][1]), (None, [5.0] * 64)]
    rows += [(2000, None), (2001, []), (2002, [0.0] * 64), (2003, [float("nan")] * 64), (2004, [None] + [1.0] * 63),
             (2005, [float("inf")] + [1.0] * 63), (2006, [1.0, 2.0]), (2007, [2.0, 4.0]), (2008, [-0.0, 1.0]), (2009, [0.0, 1.0])]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows],
                                 "vec_id long, embedding array<float>, label int, node string").repartition(3)


def test_links_and_groups_equal_brute_force(spark, monkeypatch):
    rows = vectors()
    for cell, block, many in ((8192, 4096, 0.02), (10, 7, 1.0), (10, 7, -1.0)):
        monkeypatch.setattr(E, "CELL", cell)
        monkeypatch.setattr(E, "BLOCK", block)
        monkeypatch.setattr(E, "MANY", many)
        got = E.embedding_groups(frame(spark, rows)).collect()
        assert sorted((tuple(r) for r in got), key=repr) == brute(rows, 0.9)


def test_no_vectors(spark):
    assert E.embedding_groups(frame(spark, vectors()).where("vec_id < -1")).collect() == []
    only = E.embedding_groups(frame(spark, [(1, None), (2, [0.0])])).collect()
    assert sorted(tuple(r) for r in only) == [(1, 0, 1, True), (2, 0, 2, True)]


RULES = [("block", "bad.example", "/"), ("allow", "good.bad.example", "/ok"), ("block", "Shop.example", "/sale"),
         ("allow", "shop.example", "/sale/fair"), ("block", "shop.example", "/sale/fair")]


def pages(spark):
    link = lambda u: f'<html><head><link rel="canonical" href="{u}"></head></html>'
    refresh = lambda u: f"<meta http-equiv='refresh' content='0; URL={u}'>"
    rows = [
        (1, "http://bad.example/x", None), (2, "http://mirror.example/x", link("http://bad.example/x")),
        (3, "http://hop.example/", refresh("http://mirror.example/x?utm=1")), (4, "HTTP://GOOD.bad.example/ok/1", ""),
        (5, "http://both.example/a", link("http://bad.example/y") + refresh("http://good.bad.example/ok/2")),
        (6, "http://notbad.example/", link("/rel/canon")), (7, "http://notbad.example/rel/canon", None),
        (8, "no url at all", link("http://bad.example/x")), (9, None, link("http://bad.example/x")),
        (10, "http://shop.example/sale/fair/1#top", ""), (11, "http://a.shop.example/sale?x=/", ""),
        (12, "http://free.example/", "<!-- " + link("http://bad.example/x") + " --><script>" + refresh("http://bad.example/x") + "</script>"),
        (13, "http://xbad.example/", None), (14, "http://mirror.example/x?again", None), (1, "http://bad.example/x", None)]
    return spark.createDataFrame([(*r, "u", "v") for r in rows], "page_id long, url string, html string, host string, verdict string")


def test_verdicts_follow_rules_then_aliases(spark):
    got = U.filter_urls(pages(spark), U.rules_table(spark, RULES)).collect()
    by = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in got}
    assert len(got) == 15
    assert by[1][2:] == ("bad.example/", "block") and by[2][2:] == (None, "block") and by[3][2:] == (None, "block")
    assert by[4] == ("good.bad.example", "/ok/1", "good.bad.example/ok", "allow")
    assert by[5][3] == "allow"      # one alias is explicitly allowed
    assert by[6][3] == by[7][3] == by[12][3] == by[13][3] == "allow" and by[14][3] == "block"
    assert by[8][:2] == by[9][:2] == ("", "") and by[8][3] == by[9][3] == "allow"
    assert by[10][2:] == ("shop.example/sale/fair", "allow") and by[11][2:] == ("shop.example/sale", "block")


def test_known_redirects_and_no_pages(spark):
    more = spark.createDataFrame([("http://notbad.example/q", "http://bad.example/z"), (None, "x")], "from_url string, to_url string")
    page = spark.createDataFrame([(1, "https://notbad.example/q#f", None)], "page_id long, url string, html string")
    rules = U.rules_table(spark, RULES)
    assert U.filter_urls(page, rules, more).first().verdict == "block"
    assert U.filter_urls(page.where("page_id < 0"), rules, more).collect() == []
    assert U.filter_urls(page, rules.where("action = 'none'")).first().verdict == "allow"


def test_targets(spark):
    rows = [("http://a.b/c", "http://a.b/c"), ("//a.b/c", "http://a.b/c"), ("/c", "http://h/c"), ("c", "http://h/p/c"),
            ("?q", "http://h/p/q?q")]
    df = spark.createDataFrame(rows, "t string, want string")
    got = df.select(U.absolute(F.col("t"), F.lit("h"), F.lit("/p/q")).alias("g"), "want").collect()
    assert all(r.g == r.want for r in got)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, name):
    sf = "/root/testdata/sf0.01"
    r = compare(spark, duck(sf), queries.QUERIES[name], queries.ORACLES[name], sf)
    assert r["match"], r
