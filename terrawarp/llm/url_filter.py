"""URL filters with redirect equivalence. DataFrame operations only.

Rules judge a URL by host and path. Redirects and canonical links make URLs aliases of each other: distributed
connected components over those edges carry a block to every alias without a rule of its own. An explicit allow
takes precedence: a URL that an allow rule fits stays allowed, whatever its aliases are.

Defined results
* Null url, or one without "://": host and path are empty, no rule fits, verdict allow unless an alias is blocked
  (a url without "://" is still a node under its own text; a null url has no aliases).
* Repeated pages and equal urls are judged alike, one result row each. Very long urls and pages are read whole.
* Null or empty html has no links. An empty table gives no rows. Null page_id is kept.
* Of two rules that fit, the longer host and path wins; of equally long ones, allow.
* Extra columns are kept by `filter_urls`; host, path, rule and verdict are replaced.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, components, free_name, table

#: Fixed values: (action, host, path) of the production rules.
RULES = (
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: Column) -> Column:
    return F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + F.lit(3)))


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), "^([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def node_of(url: Column) -> Column:
    """What names a resource: the url without scheme and fragment, its host lower-cased."""
    query = F.regexp_extract(_rest(url), "^[^?#]*([?][^#]*)", 1)
    return F.when(F.instr(url, "://") > 0, F.concat(host_of(url), path_of(url), query)).otherwise(url)


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """struct(rule, action) of the longest rule that fits, else null. The rules are a driver-side list."""
    ranked = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[0] != "allow"))
    out = None
    for action, h, p in ranked:
        fits = ((host == h) | F.endswith(host, F.lit(f".{h}"))) & F.startswith(path, F.lit(p))
        value = F.struct(F.lit(h + p).alias("rule"), F.lit(action).alias("action"))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return out if out is not None else F.lit(None).cast("struct<rule:string,action:string>")


def link_targets(url: Column, html: Column) -> Column:
    """Canonical and refresh targets that a page names, resolved against its url."""
    link = F.filter(F.regexp_extract_all(html, F.lit("(?i)<link\\b[^>]*>"), F.lit(0)), lambda t: t.rlike("(?i)\\brel\\s*=\\s*[\"']?canonical\\b"))
    meta = F.filter(F.regexp_extract_all(html, F.lit("(?i)<meta\\b[^>]*>"), F.lit(0)), lambda t: t.rlike("(?i)http-equiv\\s*=\\s*[\"']?refresh\\b"))
    to = F.concat(
        F.transform(link, lambda t: F.regexp_extract(t, "(?i)\\bhref\\s*=\\s*[\"']?([^\"'\\s>]+)", 1)),
        F.transform(meta, lambda t: F.regexp_extract(t, "(?i)\\burl\\s*=\\s*[\"']?([^\"'\\s>]+)", 1)),
    )
    scheme, origin = F.regexp_extract(url, "^(.*?)://", 1), F.regexp_extract(url, "^(.*?://[^/?#]*)", 1)
    folder = F.regexp_extract(url, "^(.*?://[^/?#]*[^?#]*/)", 1)
    full = lambda t: (
        F.when(F.instr(t, "://") > 0, t).when(F.startswith(t, F.lit("//")), F.concat(scheme, F.lit(":"), t)).when(F.startswith(t, F.lit("/")), F.concat(origin, t))
        .otherwise(F.concat(F.when(folder == "", F.concat(origin, F.lit("/"))).otherwise(folder), t))
    )
    return F.transform(F.filter(to, lambda t: t != ""), full)


def filter_urls(pages: DataFrame, rules=RULES, url: str = "url", html: str | None = "html", redirects: DataFrame | None = None) -> DataFrame:
    """pages with host, path, rule and verdict added.

    `redirects` may bring further edges (src, dst). Only urls that have an edge enter the component search; the
    edge table is all that it shuffles. Verdicts of blocked components come back by a join on the url's node.
    """
    scratch = Scratch(pages.sparkSession)
    edges = []
    if html is not None:
        u = pages[url]
        named = pages.select(node_of(u).alias("a"), F.explode(link_targets(u, pages[html])).alias("t"))
        edges.append(named.select("a", node_of(F.col("t")).alias("b"), F.col("t").alias("url")))
    if redirects is not None:
        edges.append(redirects.select(node_of(F.col("src")).alias("a"), node_of(F.col("dst")).alias("b"), F.col("dst").alias("url")))
        edges.append(redirects.select(node_of(F.col("src")).alias("a"), node_of(F.col("dst")).alias("b"), F.col("src").alias("url")))
    base = pages.drop(*[c for c in pages.columns if c.lower() in ("host", "path", "rule", "verdict")])
    r, n = free_name(base, "_r"), free_name(base, "_n")
    judged = base.withColumn("host", host_of(base[url])).withColumn("path", path_of(base[url]))
    judged = judged.withColumn(r, rule_of(F.col("host"), F.col("path"), rules))
    alias_block = None
    if edges:
        links = scratch.keep(reduce(DataFrame.unionByName, edges).where("a IS NOT NULL AND b IS NOT NULL"))
        if links.take(1):
            group = scratch.keep(components(links.select("a", "b"), scratch))
            # a node's own rule follows from its url: of both ends that the edges name, and of the pages
            ends = links.select(F.col("b").alias("node"), rule_of(host_of(F.col("url")), path_of(F.col("url")), rules).alias("x"))
            ends = ends.unionByName(judged.select(node_of(F.col(url)).alias("node"), F.col(r).alias("x")))
            bad = ends.where(F.col("x.action") == "block").select("node").distinct()
            labels = group.join(bad, "node", "left_semi").select("label").distinct()
            alias_block = group.join(labels, "label", "left_semi").select(F.col("node").alias(n)).withColumn("_bad", F.lit(True))
    if alias_block is not None:
        judged = judged.join(alias_block, node_of(F.col(url)) == F.col(n), "left").drop(n)
    else:
        judged = judged.withColumn("_bad", F.lit(None).cast("boolean"))
    verdict = F.coalesce(F.col(f"{r}.action"), F.when(F.col("_bad"), F.lit("block")), F.lit("allow"))
    return judged.select(*base.columns, "host", "path", F.col(f"{r}.rule").alias("rule"), verdict.alias("verdict"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The production rules over all pages, with the edges that the pages' html names."""
    return filter_urls(table(spark, sf_dir, "pages").select("page_id", "url", "html")).select("page_id", "host", "path", "rule", "verdict")


OP9_SQL = """
WITH RECURSIVE p AS (
  SELECT page_id, url, html, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
q AS (
  SELECT page_id, url, html,
         coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path,
         CASE WHEN rest IS NULL THEN url ELSE translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
              || regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) || regexp_extract(rest, '^[^?#]*([?][^#]*)', 1) END AS node FROM p),
tags AS (SELECT node, url, unnest(regexp_extract_all(html, '(?i)<(?:link|meta)\\b[^>]*>')) AS tag FROM q WHERE html IS NOT NULL AND url IS NOT NULL),
targets AS (
  SELECT node AS a, CASE WHEN regexp_matches(tag, '(?i)^<link') THEN regexp_extract(tag, '(?i)\\bhref\\s*=\\s*["'']?([^"''\\s>]+)', 1)
                    ELSE regexp_extract(tag, '(?i)\\burl\\s*=\\s*["'']?([^"''\\s>]+)', 1) END AS t, url
  FROM tags WHERE (regexp_matches(tag, '(?i)^<link') AND regexp_matches(tag, '(?i)\\brel\\s*=\\s*["'']?canonical\\b'))
               OR (regexp_matches(tag, '(?i)^<meta') AND regexp_matches(tag, '(?i)http-equiv\\s*=\\s*["'']?refresh\\b'))),
resolved AS (
  SELECT a, CASE WHEN strpos(t, '://') > 0 THEN t WHEN starts_with(t, '//') THEN regexp_extract(url, '^(.*?)://', 1) || ':' || t
            WHEN starts_with(t, '/') THEN regexp_extract(url, '^(.*?://[^/?#]*)', 1) || t
            WHEN regexp_extract(url, '^(.*?://[^/?#]*[^?#]*/)', 1) = '' THEN regexp_extract(url, '^(.*?://[^/?#]*)', 1) || '/' || t
            ELSE regexp_extract(url, '^(.*?://[^/?#]*[^?#]*/)', 1) || t END AS u
  FROM targets WHERE t <> ''),
ends AS (SELECT a, u, CASE WHEN strpos(u, '://') > 0 THEN substr(u, strpos(u, '://') + 3) END AS rest FROM resolved),
tails AS (
  SELECT a, coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path,
         CASE WHEN rest IS NULL THEN u ELSE translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
              || regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) || regexp_extract(rest, '^[^?#]*([?][^#]*)', 1) END AS b FROM ends),
e AS (SELECT a, b FROM tails WHERE a IS NOT NULL AND b IS NOT NULL UNION SELECT b, a FROM tails WHERE a IS NOT NULL AND b IS NOT NULL),
urls AS (SELECT node, host, path FROM q UNION SELECT b, host, path FROM tails),
rules(action, rhost, rpath) AS (VALUES ('block', 'com', '/en/'), ('allow', 'example.com', '/en/7'), ('allow', 'net', '/de/'), ('block', 'example.net', '/de/8'), ('block', 'org', '/es/')),
fit AS (
  SELECT u.node, u.host, u.path, r.rhost || r.rpath AS rule, r.action,
         row_number() OVER (PARTITION BY u.node, u.host, u.path ORDER BY length(r.rhost || r.rpath) DESC, r.action) AS k
  FROM urls u JOIN rules r ON (u.host = r.rhost OR ends_with(u.host, '.' || r.rhost)) AND starts_with(u.path, r.rpath)),
bad(n) AS (
  SELECT node FROM fit WHERE k = 1 AND action = 'block' AND node IN (SELECT a FROM e)
  UNION
  SELECT e.b FROM bad JOIN e ON e.a = bad.n)
SELECT q.page_id, q.host, q.path, f.rule, coalesce(f.action, CASE WHEN q.node IN (SELECT n FROM bad WHERE n IS NOT NULL) THEN 'block' ELSE 'allow' END) AS verdict
FROM q LEFT JOIN fit f ON f.k = 1 AND f.node IS NOT DISTINCT FROM q.node AND f.host = q.host AND f.path = q.path
"""
