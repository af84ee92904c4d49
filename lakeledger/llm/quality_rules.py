"""Quality rules: base rules and robust multivariate outliers, DataFrame only.

Each text gets five statistics; transformed, they are a vector.  For every
group (language and source) the minimum covariance determinant estimate gives
a centre and covariance that bad texts of the group cannot pull away, and a text
is rejected when its Mahalanobis distance is beyond the chi-squared cutoff.

The estimate is iterated for all groups at once.  From the coordinates'
medians and quartile ranges, each concentration step takes the share ``CORE`` of
the group's texts with the least distances and computes their mean and
covariance; steps go on while a determinant falls.  A last step reweights:
mean and covariance of the texts within the 97.5 % distance.  Small groups
are pooled by language, and small pools over all languages.

A step is two aggregations: a histogram of the distances (for the share's
limit) and the sums, both partial before the shuffle, and estimates meet rows
by a broadcast of checked size or a salted join, so a source with a third of
all rows is a third of all tasks.  Coordinates are rounded to 1/1024: sums
of them and of their products are then exact in double precision whatever the
order (up to some 10^7 rows a group, nearly so beyond).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeledger.llm.common import stored

WINDOW = 8            # words of a repeated passage
MIN_WORDS = 20
REPEAT_PERCENT = 30
CORE = 0.75
MIN_GROUP = 100       # texts a group needs for an estimate of its own
MAX_STEPS = 10
FEW_GROUPS = 10_000   # groups (some 200 bytes each) that are broadcast
SALTS = 32            # parts of a group when there are more
TAIL = 1e-6           # of clean normal vectors that the cutoff would reject
#: least standard deviation of each coordinate: no estimate is so narrow that
#: usual differences between clean texts count as outliers
FLOORS = (0.06, 0.05, 0.12, 0.5, 0.8)
P = len(FLOORS)
XS = [f"x{i}" for i in range(P)]

_WORD = r"[^\x20\x09-\x0D]+"


def _let(value: Column, body) -> Column:
    """body(value) with value evaluated once, also inside lambdas."""
    return F.transform(F.array(value), body)[0]


def _repeat_words(words: Column) -> Column:
    """Words inside windows of ``WINDOW`` words that occur twice or more."""
    def covered(h: Column) -> Column:
        ranked = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        again = _let(ranked, lambda s: F.filter(s, lambda x, j: F.coalesce(x["h"] == F.get(s, j - 1)["h"], F.lit(False))
                                                | F.coalesce(x["h"] == F.get(s, j + 1)["h"], F.lit(False))))
        at = F.sort_array(F.transform(again, lambda x: x["i"]))
        new = _let(at, lambda a: F.transform(
            a, lambda x, j: F.least(F.lit(WINDOW), F.coalesce(F.get(a, j + 1), x + WINDOW) - x)))
        return F.aggregate(new, F.lit(0), lambda s, x: s + x)

    def windows(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(w) - WINDOW),
                           lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)]))

    some = _let(F.transform(words, lambda x: F.xxhash64(x)), windows)
    count = _let(some, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(0))
    return F.when(F.size(words) > WINDOW, count).otherwise(0).cast("long")


def statistics(docs: DataFrame, keep: list) -> DataFrame:
    """The columns ``keep`` and n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed of every whole text; null has no words."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(F.col("_t"), "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    w = F.col("_w")
    out = docs.select(*keep, text.alias("_t")).withColumn("_w", F.regexp_extract_all("_t", F.lit(_WORD), F.lit(0)))
    out = out.select(
        *out.columns[:len(keep)],
        F.size(w).cast("long").alias("n_words"),
        F.aggregate(w, F.lit(0), lambda s, x: s + F.char_length(x)).cast("long").alias("word_chars"),
        F.char_length(F.regexp_replace("_t", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        _let(lines, lambda a: F.size(a) - F.size(F.array_distinct(a))).cast("long").alias("n_dup_lines"),
        _repeat_words(w).alias("n_repeat_words"))
    return out.withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                          | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words")))


def vector() -> list[Column]:
    """The transformed statistics, rounded to 1/1024."""
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    chars = F.greatest(F.col("word_chars"), F.lit(1)).cast("double")
    raw = [F.log(chars / words),                                    # mean length of a word
           F.sqrt(F.col("n_symbols") / chars),
           F.sqrt(F.col("n_repeat_words") / words),
           F.log1p(F.col("n_dup_lines").cast("double")),
           F.log(words)]
    return [F.round(x * 1024) / 1024 for x in raw]


def chi2_cdf(x: float, k: int) -> float:
    """Lower regularised gamma function of (k/2, x/2), by its series."""
    a, h = k / 2, x / 2
    term = total = 1 / a
    n = 0
    while term > total * 1e-16 and n < 1000:
        n += 1
        term *= h / (a + n)
        total += term
    return min(1.0, total * math.exp(-h + a * math.log(h) - math.lgamma(a))) if h > 0 else 0.0


def chi2_quantile(q: float, k: int) -> float:
    lo, hi = 0.0, 400.0
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi2_cdf(mid, k) < q else (lo, mid)
    return hi


def _grouped(rows: DataFrame) -> DataFrame:
    """Add gid: lang and source, or the pool of the small groups."""
    name = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("null"))
    rows = rows.withColumn("_lang", name("lang")).withColumn("_source", name("source"))
    size = rows.groupBy("_lang", "_source").agg(F.count_if(~F.col("base_failed")).alias("n"))
    size = size.withColumn("own", F.col("n") >= MIN_GROUP)
    pool = size.where("not own").groupBy("_lang").agg((F.sum("n") >= MIN_GROUP).alias("pooled"))
    size = stored(size.join(pool, "_lang", "left").select("_lang", "_source", "own", "pooled"), "groups")
    gid = (F.when(F.col("own"), F.concat_ws("\u0001", "_lang", "_source"))
           .when(F.col("pooled"), F.col("_lang")).otherwise(F.lit("all")))
    out = _with_group(rows, size, _few(size), key=["_lang", "_source"])
    return out.withColumn("gid", gid).drop("_lang", "_source", "own", "pooled")


def _cholesky(groups: DataFrame) -> DataFrame:
    """(gid, m*, l*, logdet) from (gid, m*, c*): the lower Cholesky factor."""
    out = groups
    for j in range(P):
        low = [F.col(f"l{j}{k}") for k in range(j)]
        out = out.withColumn(f"l{j}{j}", F.sqrt(F.greatest(
            F.col(f"c{j}{j}") - sum((x * x for x in low), F.lit(0.0)), F.lit(FLOORS[j] ** 2 / 4))))
        for i in range(j + 1, P):
            dot = sum((F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)), F.lit(0.0))
            out = out.withColumn(f"l{i}{j}", (F.col(f"c{j}{i}") - dot) / F.col(f"l{j}{j}"))
    logdet = sum((F.log(f"l{j}{j}") for j in range(P)), F.lit(0.0))
    return out.select("gid", *[f"m{i}" for i in range(P)],
                      *[f"l{i}{j}" for i in range(P) for j in range(i + 1)], logdet.alias("logdet"))


def _with_group(rows: DataFrame, groups: DataFrame, few: bool, how: str = "left",
                key: list[str] | None = None) -> DataFrame:
    """Rows with what ``groups`` has for their key (gid).  Few groups are
    broadcast; more are joined by key and a salt, as one group may hold a third
    of the rows."""
    key = key or ["gid"]
    if few:
        return rows.join(F.broadcast(groups), key, how)
    salt = F.pmod(F.xxhash64(*XS), F.lit(SALTS)).cast("int")
    salted = groups.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("_salt", salt).join(salted, [*key, "_salt"], how).drop("_salt")


def _few(groups: DataFrame) -> bool:
    return groups.count() <= FEW_GROUPS


def _distance(rows: DataFrame, params: DataFrame, few: bool) -> DataFrame:
    """Add d2, the squared Mahalanobis distance to the group's estimate."""
    out = _with_group(rows, params, few)
    for i in range(P):
        dot = sum((F.col(f"l{i}{k}") * F.col(f"z{k}") for k in range(i)), F.lit(0.0))
        out = out.withColumn(f"z{i}", (F.col(f"x{i}") - F.col(f"m{i}") - dot) / F.col(f"l{i}{i}"))
    return out.select(*rows.columns, sum((F.col(f"z{i}") * F.col(f"z{i}") for i in range(P)), F.lit(0.0)).alias("d2"))


def _moments(rows: DataFrame, factor: float) -> DataFrame:
    """(gid, m*, c*) of rows with x*: mean and covariance times ``factor``,
    with the floors as least variances."""
    sums = [F.count("*").alias("n"), *[F.sum(x).alias(f"s_{x}") for x in XS],
            *[F.sum(F.col(XS[i]) * F.col(XS[j])).alias(f"q{i}{j}") for i in range(P) for j in range(i, P)]]
    g = rows.groupBy("gid").agg(*sums)
    mean = {i: F.col(f"s_x{i}") / F.col("n") for i in range(P)}
    cov = {}
    for i in range(P):
        for j in range(i, P):
            c = (F.col(f"q{i}{j}") / F.col("n") - mean[i] * mean[j]) * factor
            cov[i, j] = c + F.lit(FLOORS[i] ** 2) if i == j else c
    return g.select("gid", *[mean[i].alias(f"m{i}") for i in range(P)],
                    *[c.alias(f"c{i}{j}") for (i, j), c in cov.items()])


def _start(rows: DataFrame) -> DataFrame:
    """(gid, m*, c*): medians and squared quartile ranges, from histograms."""
    longer = rows.select("gid", F.posexplode(F.array(*XS)).alias("i", "x"))
    bins = longer.groupBy("gid", "i", F.floor(F.col("x") * 64).alias("bin")).agg(F.count("*").alias("n"))
    up = Window.partitionBy("gid", "i").orderBy("bin")
    bins = bins.withColumn("upto", F.sum("n").over(up)).withColumn("all", F.sum("n").over(Window.partitionBy("gid", "i")))
    at = lambda q: F.min(F.when(F.col("upto") >= F.col("all") * q, F.col("bin"))) / 64
    each = bins.groupBy("gid", "i").agg((at(0.5) + 1 / 128).alias("mid"), ((at(0.75) - at(0.25)) / 1.349).alias("sd"))
    pick = lambda c, i: F.max(F.when(F.col("i") == i, F.col(c)))
    return each.groupBy("gid").agg(
        *[pick("mid", i).alias(f"m{i}") for i in range(P)],
        *[(pick("sd", i) * pick("sd", i) + FLOORS[i] ** 2 if i == j else F.lit(0.0)).alias(f"c{i}{j}")
          for i in range(P) for j in range(i, P)])


def _core(rows: DataFrame, params: DataFrame, few: bool) -> DataFrame:
    """The rows whose distance is among the least ``CORE`` of their group, to
    the width of a bin (0.4 % of the distance)."""
    d = _distance(rows, params, few).withColumn("bin", F.floor(F.log1p("d2") * 256))
    bins = d.groupBy("gid", "bin").agg(F.count("*").alias("n"))
    up = Window.partitionBy("gid").orderBy("bin")
    bins = bins.withColumn("upto", F.sum("n").over(up)).withColumn("all", F.sum("n").over(Window.partitionBy("gid")))
    limit = bins.where(F.col("upto") >= F.col("all") * CORE).groupBy("gid").agg(F.min("bin").alias("limit"))
    return _with_group(d, limit, few, "inner").where("bin <= limit")


def minimum_covariance_determinant(rows: DataFrame) -> DataFrame:
    """(gid, m*, l*): centre and Cholesky factor of the scatter of each group of
    rows with gid and x*."""
    shrunk = CORE / chi2_cdf(chi2_quantile(CORE, P), P + 2)   # makes the core's covariance that of all
    inner = chi2_quantile(0.975, P)
    wide_ = 0.975 / chi2_cdf(inner, P + 2)
    params = stored(_cholesky(_start(rows)), "mcd")
    few = _few(params)
    for step in range(MAX_STEPS):
        new = stored(_cholesky(_moments(_core(rows, params, few), shrunk)), "mcd")
        fell = new.join(params.select("gid", F.col("logdet").alias("was")), "gid").where("logdet < was - 1e-4")
        params = new
        if step and fell.isEmpty():
            break
    near = _distance(rows, params, few).where(F.col("d2") <= inner)
    return stored(_cholesky(_moments(near, wide_)), "mcd")


def quality_rules(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (doc_id alone by default), the statistics,
    base_failed, distance and kept for every row.

    A null or empty text has no words and fails the base rules.  Groups are
    (lang, source); null is a group value of its own.  Repeated rows are
    judged alike, each counts in its group.  distance is the squared
    Mahalanobis distance, null where no group has an estimate (all texts of the
    table failed the base rules).  An empty table gives an empty result; other
    columns are ignored.
    """
    keep = keep or ["doc_id"]
    named = [F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)]
    stats = statistics(docs, [*named, F.col("lang").alias("lang"), F.col("source").alias("source")])
    stats = stored(stats, "statistics")
    rows = stored(_grouped(stats.select("*", *[x.alias(n) for x, n in zip(vector(), XS, strict=True)])), "vectors")
    params = minimum_covariance_determinant(rows.where("not base_failed").select("gid", *XS))
    out = _distance(rows, params, _few(params))
    cutoff = chi2_quantile(1 - TAIL, P)
    return out.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)],
                      "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                      F.col("d2").alias("distance"),
                      (~F.col("base_failed") & (F.coalesce("d2", F.lit(0.0)) <= cutoff)).alias("kept"))


def quality_filter(docs: DataFrame) -> DataFrame:
    """The documents that the rules keep, with all columns as they came, of
    whatever names."""
    mark = F.xxhash64(F.coalesce("text", F.lit(""))).alias("mark")
    judged = quality_rules(docs.select("doc_id", "text", "lang", "source", mark), ["doc_id", "mark"])
    bad = judged.where("not kept").select(F.col("doc_id").alias("bad"), F.col("mark").alias("bad_mark")).distinct()
    rows = docs.select(F.struct(*docs.columns).alias("doc"), F.col("doc_id").alias("id"), mark)
    gone = (F.col("mark") == F.col("bad_mark")) & F.col("id").eqNullSafe(F.col("bad"))
    return rows.join(bad, gone, "left_anti").select("doc.*")
