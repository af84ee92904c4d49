import collections
import math
import re

import numpy as np
import pytest
from llm.helpers import awkward_texts, docs_table, empty_docs

from lakeledger.llm import quality_rules as Q


def brute_statistics(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = collections.Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    covered = {j for i in range(len(w) - 7) if windows[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered),
            len(w) < 20 or 100 * len(covered) > 30 * len(w))


def test_statistics_equal_brute_force(spark):
    rows = awkward_texts() + [(900, "a b c d e f g h " * 9), (901, "#*$%&|<> x ### y\n\n \nz"), (902, "w " * 8), (903, "w " * 9)]
    got = Q.statistics(docs_table(spark, rows), ["doc_id"]).collect()
    assert sorted((tuple(r) for r in got), key=repr) == sorted(((i, *brute_statistics(t)) for i, t in rows), key=repr)


def brute_mcd(x):
    """The estimate in numpy, for one group: medians and quartile ranges,
    concentration steps, one reweighting."""
    floors = np.diag(np.array(Q.FLOORS) ** 2)
    shrink = Q.CORE / Q.chi2_cdf(Q.chi2_quantile(Q.CORE, Q.P), Q.P + 2)
    inner = Q.chi2_quantile(0.975, Q.P)
    bins = np.sort(np.floor(x * 64), axis=0)
    n = len(x)
    at = lambda q: bins[math.ceil(n * q) - 1] / 64
    m, c = at(0.5) + 1 / 128, np.diag(((at(0.75) - at(0.25)) / 1.349) ** 2) + floors

    def distance(m, c):
        z = np.linalg.solve(np.linalg.cholesky(c), (x - m).T)
        return (z * z).sum(axis=0)

    last = np.linalg.slogdet(c)[1] / 2
    for step in range(Q.MAX_STEPS):
        b = np.floor(np.log1p(distance(m, c)) * 256)
        y = x[b <= np.sort(b)[math.ceil(n * Q.CORE) - 1]]
        m, c = y.mean(axis=0), np.cov(y.T, bias=True) * shrink + floors
        det = np.linalg.slogdet(c)[1] / 2
        if step and not det < last - 1e-4:
            break
        last = det
    y = x[distance(m, c) <= inner]
    c = np.cov(y.T, bias=True) * (0.975 / Q.chi2_cdf(inner, Q.P + 2)) + floors
    return distance(y.mean(axis=0), c)


@pytest.mark.parametrize("few", [10_000, 0])
def test_distances_equal_the_estimate_in_numpy(spark, monkeypatch, few):
    monkeypatch.setattr(Q, "FEW_GROUPS", few)
    rng = np.random.default_rng(4)
    x = np.round(rng.multivariate_normal([1.6, 0.1, 0.1, 0.2, 5], np.diag([.05, .02, .1, .3, 1]) + 0.01, 400) * 1024) / 1024
    x[:40] += [1.5, 1, 1, 3, -3]  # a tenth is bad
    rows = spark.createDataFrame([("g", i, *map(float, r)) for i, r in enumerate(x)],
                                 "gid string, i int, x0 double, x1 double, x2 double, x3 double, x4 double")
    params = Q.minimum_covariance_determinant(rows.select("gid", *Q.XS))
    got = Q._distance(rows, params, few > 0).orderBy("i").toPandas().d2.to_numpy()
    assert np.allclose(got, brute_mcd(x), rtol=1e-6)
    assert got[:40].min() > Q.chi2_quantile(1 - Q.TAIL, Q.P) > np.quantile(got[40:], 0.999) / 2


def test_chi_squared():
    assert abs(Q.chi2_cdf(11.0705, 5) - 0.95) < 1e-5 and abs(Q.chi2_quantile(0.975, 5) - 12.8325) < 1e-3


def test_small_groups_are_pooled(spark):
    rows = spark.createDataFrame(
        [("en", f"s{i % 3}", False) for i in range(300)] + [("de", f"t{i}", False) for i in range(120)]
        + [("fr", "u", False), (None, None, False), ("en", "s0", True), ("xx", "only bad", True)],
        "lang string, source string, base_failed boolean")
    got = {(r.lang, r.source): r.gid for r in Q._grouped(rows).collect()}
    assert got["en", "s0"] == "=en\u0001=s0" and got["de", "t7"] == "=de"
    assert got["fr", "u"] == got[None, None] == "all" and got["xx", "only bad"] is None or got["xx", "only bad"] == "all"


def test_awkward_rows_and_filter(spark):
    rows = awkward_texts()
    docs = docs_table(spark, rows)
    got = Q.quality_rules(docs).collect()
    assert len(got) == len(rows) and all(r.kept is not None for r in got)
    assert not any(r.kept for r in got if r.base_failed)
    kept = Q.quality_filter(docs)
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in got)


def test_empty_table_and_only_bad_rows(spark):
    assert Q.quality_rules(empty_docs(spark)).collect() == []
    got = Q.quality_rules(docs_table(spark, [(1, "short"), (2, None)])).collect()
    assert len(got) == 2 and not any(r.kept for r in got)


def test_main_path_is_native(spark):
    plan = Q.quality_rules(docs_table(spark, [(1, "short")]))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_good_texts_stay_and_bad_ones_go(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet").distinct()
    out = Q.quality_rules(spark.read.parquet(f"{sf}/documents.parquet")).join(labels, "doc_id").toPandas()
    good = out[(out.quality == 1) & ~out.base_failed]
    assert good.kept.mean() > 0.998 and out[out.quality == 0].kept.mean() < 0.08
