"""Registered corpus queries; each takes (spark, sf_dir) and applies one
operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeledger.llm import (alignment, embedding_dedup, mixing, packing, periodic, quality_classifier, quality_rules,
                            simhash, suffix_dedup, token_files, toxicity, url_filters, window_dedup)
from lakeledger.llm.common import read_table
from lakeledger.llm.training import remainder
from lakeledger.session import apply_required_conf, new_run_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_required_conf(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run
    return deco


@register("op10_simhash_near_dedup")
def op10(spark, sf_dir):
    """SimHash groups of all documents: 3-word shingles, 3 differing bits."""
    groups = simhash.simhash_groups(read_table(spark, sf_dir, "documents"), shingle=3, max_bits=3)
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@register("op2_token_files")
def op2(spark, sf_dir):
    """Token files of all documents, written and read back."""
    path = new_run_dir(spark, "tokens") + "/files"
    token_files.write_tokens(read_table(spark, sf_dir, "documents"), path,
                             public_tokenizers.path("byte_bpe_50k.json"), "byte", end_id=2)
    return token_files.with_crc(token_files.read_tokens(spark, path))


@register("op9_best_fit_packing")
def op9(spark, sf_dir):
    """All documents packed into sequences of at most 4096 tokens."""
    return packing.pack_documents(read_table(spark, sf_dir, "documents"),
                                  public_tokenizers.path("word_bpe_49k.json"), "word", end_id=1, room=4096)


@register("op3_toxicity")
def op3(spark, sf_dir):
    """Toxicity of all documents; labels with remainder 0 are held out."""
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    rest = remainder(F.col("doc_id"), 5)
    model = toxicity.toxicity_model(docs, labels, rest != 0)
    return toxicity.toxicity(docs, model).select(
        "doc_id", (rest == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "lang_threshold", "flagged")


@register("op7_quality_classifier")
def op7(spark, sf_dir):
    """Quality of all documents; labels with remainder 2 are held out."""
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    rest = remainder(F.col("doc_id"), 4)
    model = quality_classifier.quality_model(docs, labels, rest != 2)
    return quality_classifier.quality(docs, model).select(
        "doc_id", (rest == 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


MIX = {"clean": 0.94, "toxic": 0.03, "poor": 0.03}


@register("op8_mixing")
def op8(spark, sf_dir):
    """Rates at which the documents give a mix of 94 % clean text."""
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    model = mixing.domain_model(docs, labels)
    rates = mixing.mix(docs, model, MIX, ["doc_id"])
    return rates.select("doc_id", "n_tokens", *[F.col("p")[i].alias(f"p_{d}") for i, d in enumerate(model.domains)],
                        "rate", "copies")


URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
             ("allow", "com", "/fr/"), ("block", "com", "/de/")]

_URL_SQL = """
WITH RECURSIVE parsed AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, html
  FROM (SELECT page_id, html,
               CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
        FROM pages)),
target AS (
  SELECT host, path, substr(t, strpos(t, '://') + 3) AS rest
  FROM (SELECT host, path, unnest(regexp_extract_all(html,
          '(?is)<link\\b[^>]*\\brel\\s*=\\s*["'']?canonical\\b[^>]*\\bhref\\s*=\\s*["'']?([^"''\\s>]+)', 1)) AS t
        FROM parsed) WHERE strpos(t, '://') > 0),
edge AS (
  SELECT DISTINCT host || path AS u, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                  'abcdefghijklmnopqrstuvwxyz') || regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS v FROM target),
ways AS (SELECT u, v FROM edge UNION SELECT v, u FROM edge),
reach AS (SELECT u, v FROM ways UNION SELECT r.u, b.v FROM reach r JOIN ways b ON r.v = b.u),
rules(action, r_host, r_path) AS (VALUES {rules}),
node AS (SELECT DISTINCT host, path FROM parsed
         UNION SELECT regexp_extract(v, '^[^/]*'), regexp_extract(v, '^[^/]*(.*)', 1) FROM ways),
best AS (
  SELECT host, path, r_host || r_path AS rule, action FROM node JOIN rules
    ON (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path)
  QUALIFY row_number() OVER (PARTITION BY host, path
                             ORDER BY length(r_host) DESC, length(r_path) DESC, action) = 1),
alias AS (
  SELECT r.u, bool_or(b.action = 'block') AS block, bool_or(b.action = 'allow') AS allow
  FROM reach r JOIN best b ON r.v = b.host || b.path GROUP BY r.u)
SELECT p.page_id, p.host, p.path, b.rule,
       coalesce(b.action, CASE WHEN a.block AND NOT a.allow THEN 'block' ELSE 'allow' END) AS verdict
FROM parsed p LEFT JOIN best b ON p.host = b.host AND p.path = b.path LEFT JOIN alias a ON p.host || p.path = a.u
""".format(rules=", ".join(str(r) for r in URL_RULES))


@register("op6_url_filters", _URL_SQL)
def op6(spark, sf_dir):
    """Verdicts of all pages, with aliases from their html."""
    return url_filters.filter_urls(read_table(spark, sf_dir, "pages"), url_filters.rules_table(spark, URL_RULES))


_EMBEDDING_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS norm
  FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)
  WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_dot_product(e, e) > 0),
link AS (
  SELECT a.vec_id AS u, b.vec_id AS v FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.9),
reach AS (SELECT u, v FROM link UNION SELECT r.u, l.v FROM reach r JOIN link l ON r.v = l.u),
least AS (SELECT u, min(v) AS m FROM reach GROUP BY u),
n AS (SELECT u, count(*) AS n_links FROM link GROUP BY u)
SELECT e.vec_id, coalesce(n.n_links, 0)::BIGINT AS n_links,
       least(e.vec_id, coalesce(l.m, e.vec_id))::BIGINT AS component_id,
       e.vec_id = least(e.vec_id, coalesce(l.m, e.vec_id)) AS kept
FROM embeddings e LEFT JOIN n ON e.vec_id = n.u LEFT JOIN least l ON e.vec_id = l.u
"""


@register("op5_embedding_near_dedup", _EMBEDDING_SQL)
def op5(spark, sf_dir):
    """Groups of all embeddings at a cosine of 0.9."""
    return embedding_dedup.embedding_groups(read_table(spark, sf_dir, "embeddings"), threshold=0.9)


@register("op4_quality_rules")
def op4(spark, sf_dir):
    """Quality rules over all documents."""
    return quality_rules.quality_rules(read_table(spark, sf_dir, "documents"))


@register("op1_suffix_array_dedup")
def op1(spark, sf_dir):
    """All documents without the strings of 200 bytes that occur elsewhere."""
    return suffix_dedup.deduplicate(read_table(spark, sf_dir, "documents"), ["doc_id"], length=200)


def _planted(docs: DataFrame) -> DataFrame:
    """Every tenth document (by crc32 of its id) with its tail made periodic,
    as the contract of op13 asks; the others as they are."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda x: x != "")
    docs = docs.select("doc_id", "text", F.when(h % 10 == 0, words).alias("w"), F.floor(h / 10).alias("g"))
    docs = docs.select("*", F.size("w").cast("long").alias("n")).select("*", F.expr("g % nullif(n, 0)").alias("a"))
    docs = docs.select("*", F.expr("1 + (n - a) div (3 + g % 8)").alias("p"))
    tail = F.expr("""slice(flatten(array_repeat(slice(w, int(a + 1), int(p)), int((n - a) div p + 1))), 1, int(n - a))""")
    text = F.array_join(F.concat(F.expr("slice(w, 1, int(a))"), tail), " ")
    return docs.select("doc_id", F.when(F.col("n") > 0, text).otherwise(F.col("text")).alias("text"))


@register("op13_periodic_runs")
def op13(spark, sf_dir):
    """Periodic runs of the words of all documents."""
    runs = periodic.periodic_runs(_planted(read_table(spark, sf_dir, "documents")), exponent=4, least=6)
    # greatest length / period without rounding: products of the other's period
    better = """array_sort(runs, (x, y) -> CASE
        WHEN x.length * y.period > y.length * x.period THEN -1 WHEN x.length * y.period < y.length * x.period THEN 1
        WHEN x.start < y.start THEN -1 WHEN x.start > y.start THEN 1 WHEN x.period < y.period THEN -1
        WHEN x.period > y.period THEN 1 ELSE 0 END)"""
    lines = "concat_ws('', transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')))"
    best = F.expr(f"get({better}, 0)")
    return runs.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"),
        best["period"].alias("period"), F.expr(f"1000 * get({better}, 0).length div get({better}, 0).period").alias("exponent_milli"),
        F.sha2(F.expr(lines).cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


_WINDOW_SQL = r"""
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 49], ' ') AS s
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM w WHERE len(ws) >= 50)),
least AS (SELECT s, min(doc_id) AS m FROM win GROUP BY s),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i
         FROM (SELECT win.doc_id, win.i FROM win JOIN least USING (s) WHERE m < win.doc_id)),
per AS (SELECT doc_id, list(i) AS places FROM gone GROUP BY doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(len(places), 0)::BIGINT AS n_removed,
       sha256(array_to_string(CASE WHEN places IS NULL THEN ws ELSE
         list_filter(ws, lambda x, i: NOT list_contains(places, i)) END, ' ')) AS kept_sha256
FROM w LEFT JOIN per ON w.doc_id = per.doc_id
"""


@register("op12_substring_dedup", _WINDOW_SQL)
def op12(spark, sf_dir):
    """All documents without the 50-word windows of earlier documents."""
    left = window_dedup.drop_repeated_windows(read_table(spark, sf_dir, "documents"), window=50)
    return left.select(
        "doc_id", "n_words", F.expr("aggregate(removed, 0L, (n, r) -> n + r.end - r.start)").alias("n_removed"),
        F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


@register("op11_cross_tokenizer_alignment")
def op11(spark, sf_dir):
    """Links between the ids of two tokenizers in all documents."""
    return alignment.score(alignment.align(read_table(spark, sf_dir, "documents"),
                                           public_tokenizers.path("byte_bpe_50k.json"),
                                           public_tokenizers.path("piece_bpe_32k.model")))
