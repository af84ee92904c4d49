"""URL filters with redirect equivalence.

A page is judged by the longest rule that fits its url.  Pages without a rule
take the decision of their aliases: urls that redirect (meta refresh) or
canonical links of the pages name as the same are edges of a graph, its
connected components are classes of equivalent urls, and a block of one
member holds for all, unless a member is explicitly allowed.

Rules and urls meet in an equi-join: a url is looked up under each suffix of
its host and each prefix of its path that has the length of some rule's path,
so a host with many rules and many pages pairs no page with a rule that does
not fit.  Only urls that are an end of an edge go through the components.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeledger.llm.common import stored
from lakeledger.llm.components import connected_components

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MAX_PATH_LENGTHS = 256

#: parts of a page that hold no links of its own
_HIDDEN = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
_LINK = r"(?is)<link\b[^>]*\brel\s*=\s*[\"']?canonical\b[^>]*>"
_META = r"(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>"
_HREF = r"(?is)\bhref\s*=\s*[\"']?\s*([^\"'\s>]+)"
_TO = r"(?is)\bcontent\s*=\s*[\"']?\s*[0-9.]*\s*[;,]\s*url\s*=\s*['\"]?\s*([^\"'\s>]+)"


def _rest(url: Column) -> Column:
    """What follows the first ``://``; null without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3))


def host_of(url: Column) -> Column:
    """After ``://`` up to / ? # or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(_rest(url), r"^[^/?#]*", 0)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ? # or the end; else empty."""
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def alias_targets(html: Column) -> Column:
    """The urls, as written, that a page names as its canonical form or
    redirects to; links in comments, scripts and styles do not count."""
    bare = F.regexp_replace(html, _HIDDEN, " ")
    # bind the stripped text once; pages without either word are not searched
    some = html.rlike(r"(?i)canonical|http-equiv")
    return F.when(some, F.transform(F.array(bare), lambda b: F.concat(
        F.transform(F.regexp_extract_all(b, F.lit(_LINK), 0), lambda t: F.regexp_extract(t, _HREF, 1)),
        F.transform(F.regexp_extract_all(b, F.lit(_META), 0), lambda t: F.regexp_extract(t, _TO, 1))))[0])


def absolute(target: Column, host: Column, path: Column) -> Column:
    """A target as an absolute url, seen from the page at host and path."""
    folder = F.regexp_extract(path, r"^(.*/)?", 0)
    folder = F.when(folder == "", "/").otherwise(folder)
    return (F.when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), target)
            .when(target.startswith("//"), F.concat(F.lit("http:"), target))
            .when(target.startswith("/"), F.concat(F.lit("http://"), host, target))
            .when(target.rlike(r"^[?#]"), F.concat(F.lit("http://"), host, path, target))
            .otherwise(F.concat(F.lit("http://"), host, folder, target)))


def rules_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(rules, "action string, host string, path string")


def judged(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, rule, action) of those (host, path) that a rule fits: the
    rule with the longest host, then path; allow before block at a tie."""
    rules = rules.select(F.translate("host", UPPER, LOWER).alias("r_host"), F.col("path").alias("r_path"),
                         F.col("action").alias("r_action")).where("r_host is not null and r_path is not null")
    lengths = [r[0] for r in rules.select(F.length("r_path")).distinct().limit(MAX_PATH_LENGTHS + 1).collect()]
    if len(lengths) > MAX_PATH_LENGTHS:
        raise ValueError(f"rules with more than {MAX_PATH_LENGTHS} different lengths of path")
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    prefixes = F.array(*[F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in sorted(lengths)])
    keyed = (urls.select("host", "path").distinct()
             .select("host", "path", F.explode(F.array_distinct(suffixes)).alias("r_host"), prefixes.alias("p"))
             .select("host", "path", "r_host", F.explode("p").alias("r_path")).where("r_path is not null"))
    rank = F.struct(F.length("r_host"), F.length("r_path"), (F.col("r_action") == "allow"))
    return (keyed.join(rules, ["r_host", "r_path"])
            .groupBy("host", "path").agg(F.max_by(F.struct("r_host", "r_path", "r_action"), rank).alias("m"))
            .select("host", "path", F.concat("m.r_host", "m.r_path").alias("rule"), F.col("m.r_action").alias("action")))


def filter_urls(pages: DataFrame, rules: DataFrame, redirects: DataFrame | None = None) -> DataFrame:
    """(page_id, host, path, rule, verdict) for every page.

    ``rules``: (action allow or block, host, path); a rule fits its host and
    all subdomains if the path of the url starts with the rule's.
    ``redirects``: (from_url, to_url) known from elsewhere, besides those in
    the pages.

    verdict: the action of the longest fitting rule; without one, block if
    an alias is blocked by a rule and no alias is allowed by one, else allow.
    A null url, or one without ``://``, has an empty host and path, no rule
    and no aliases.  Null html has no links.  Scheme, query and fragment do
    not tell urls apart.  Repeated pages are judged alike; an empty table
    gives an empty result; other columns are ignored.
    """
    base = pages.select("page_id", "url", "html").select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"),
        alias_targets(F.col("html")).alias("targets"))
    base = stored(base, "pages")
    found = (base.where("host <> '' and size(targets) > 0").select("host", "path", F.explode("targets").alias("to"))
             .where("to <> ''").select("host", "path", absolute(F.col("to"), F.col("host"), F.col("path")).alias("to")))
    found = found.select("host", "path", host_of(F.col("to")).alias("to_host"), path_of(F.col("to")).alias("to_path"))
    if redirects is not None:
        found = found.unionByName(redirects.select(
            host_of(F.col("from_url")).alias("host"), path_of(F.col("from_url")).alias("path"),
            host_of(F.col("to_url")).alias("to_host"), path_of(F.col("to_url")).alias("to_path")))
    edges = stored(found.where("host <> '' and to_host <> ''").distinct(), "aliases")
    ends = edges.select("host", "path").union(edges.select("to_host", "to_path"))
    rule_of = stored(judged(base.select("host", "path").union(ends), rules), "judged")
    key = lambda h, p: F.concat(h, p)  # a path is empty or starts with /, and a host holds none
    comp = connected_components(edges.select(key("host", "path").alias("u"), key("to_host", "to_path").alias("v")))
    member = comp.join(rule_of.select(key("host", "path").alias("node"), "action"), "node", "left")
    state = member.groupBy("component").agg(
        F.max((F.col("action") == "block").cast("int")).alias("block"),
        F.max((F.col("action") == "allow").cast("int")).alias("allow"))
    blocked = (comp.join(state.where("block = 1 and coalesce(allow, 0) = 0"), "component")
               .select(F.col("node").alias("b_node")))
    return (base.join(rule_of, ["host", "path"], "left")
            .join(blocked, key("host", "path") == F.col("b_node"), "left")
            .select("page_id", "host", "path", "rule",
                    F.coalesce("action", F.when(F.col("b_node").isNotNull(), "block"), F.lit("allow")).alias("verdict")))
