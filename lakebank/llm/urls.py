"""URL filters: explicit host and path rules, spread to aliases over redirects and canonical links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakebank.llm.common import ascii_lower, components, stored, table

#: (verdict, host, path): a rule fits its host and all subdomains, where the path begins with the rule's.
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/")]

#: Where a page names the address that it redirects to or is a copy of.
LINKS = [r"(?is)<link\b[^>]*\brel\s*=\s*[\"']?canonical\b[^>]*>", r"(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>"]
TARGETS = [r"(?is)\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", r"(?is)\burl\s*=\s*['\"]?([^\"'\s>]+)()()"]


def host_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first :// up to / ? # or the end, A-Z lower-cased; path: then up to ? # or the end."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*+", 0)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*+(/[^?#]*+)?", 1)
    return ascii_lower(host), F.coalesce(path, F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits (verdict, rule), or null. Rules are a short fixed list: literals in the plan."""
    fits = [F.when(((host == h) | host.endswith(f".{h}")) & path.startswith(p), F.struct(F.lit(v).alias("verdict"), F.lit(h + p).alias("rule")))
            for v, h, p in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[0], r[1]))]
    return F.coalesce(*fits)


def alias_key(url: Column) -> Column:
    """The node of an address: its text up to the fragment, scheme and host in lower case."""
    scheme = ascii_lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*+(?=://)", 0))
    host, path = host_path(url)
    query = F.regexp_extract(url, r"(?s)^[^?#]*+(\?[^#]*+)?", 1)
    return F.when(F.instr(url, "://") > 0, F.concat(scheme, F.lit("://"), host, F.when(path == "", "/").otherwise(path), query))


def page_links(pages: DataFrame) -> DataFrame:
    """(from_url, to_url): canonical links and refresh redirects in the markup; relative ones are resolved against the page."""
    found = []
    for tag, target in zip(LINKS, TARGETS):
        hit = F.regexp_extract("html", tag, 0)
        to = F.coalesce(*[F.when(F.regexp_extract(hit, target, i) != "", F.regexp_extract(hit, target, i)) for i in (1, 2, 3)])
        found.append(F.when(F.col("html").rlike(tag), to))
    base = F.regexp_extract("url", r"^[^/?#]*://[^/?#]*", 0)
    folder = F.regexp_extract("url", r"(?s)^([^/?#]*://[^/?#]*(?:/(?:[^?#/]*/)*)?)", 1)
    to = F.col("to")
    full = (F.when(F.instr(to, "://") > 0, to).when(to.startswith("//"), F.concat(F.regexp_extract("url", "^[^/?#]*:", 0), to))
            .when(to.startswith("/"), F.concat(base, to)).otherwise(F.concat(F.when(folder.endswith("/"), folder).otherwise(F.concat(folder, F.lit("/"))), to)))
    return (pages.select("url", F.explode(F.filter(F.array(*found), lambda x: x.isNotNull())).alias("to"))
            .select(F.col("url").alias("from_url"), F.regexp_replace(full, "&amp;", "&").alias("to_url")))


def filter_urls(pages: DataFrame, redirects: DataFrame | None = None, rules=RULES) -> DataFrame:
    """page_id, host, path, rule and verdict of every page, with its alias component's number of links.

    A page that a rule fits takes that rule's verdict. Any other page takes the
    verdict of its aliases: the addresses that redirects or canonical links
    join to its own, over any number of steps. An explicit allow among the
    aliases goes before any block; without either the page is allowed.
    ``redirects`` (from_url, to_url) adds known redirects to those in the markup.

    Built-in expressions only. Components are found by contraction over the
    linked addresses alone, which are numbered, not hashed; pages without links
    never enter it. Null url or one without
    ``://``: empty host and path, no rule, no aliases, allowed. Null html: no
    links. Repeated rows are judged alike. Empty table: empty result. Redirect rows with a
    null end are ignored.
    """
    host, path = host_path(F.col("url"))
    links = page_links(pages.select("url", "html"))
    if redirects is not None:
        links = links.unionByName(redirects.select("from_url", "to_url"))
    links = links.select(alias_key(F.col("from_url")).alias("a"), alias_key(F.col("to_url")).alias("b")).where("a <> b").distinct()
    links = stored(links, "url_links")
    judged = (pages.select("page_id", alias_key(F.col("url")).alias("key"), host.alias("host"), path.alias("path"))
              .withColumn("fit", rule_of(F.col("host"), F.col("path"), rules)))
    if links.isEmpty():
        aliased = judged.withColumn("alias_verdict", F.lit(None).cast("string"))
    else:
        # every address of a component counts, crawled or not; its number is given once, so two addresses never share one
        names = links.select(F.col("a").alias("key")).union(links.select("b")).distinct()
        names = stored(names.select(F.monotonically_increasing_id().alias("node"), "key"), "url_names")
        edges = links.join(names.toDF("u", "a"), "a").join(names.toDF("v", "b"), "b").select("u", "v")
        nodes = components(edges, "url_components")
        h, p = host_path(F.col("key"))
        votes = (names.withColumn("fit", rule_of(h, p, rules))
                 .join(nodes, "node").groupBy("component").agg(F.max(F.when(F.col("fit.verdict") == "allow", 2).when(F.col("fit.verdict") == "block", 1)).alias("vote")))
        verdicts = names.join(nodes, "node").join(votes, "component").select(
            "key", F.when(F.col("vote") == 2, "allow").when(F.col("vote") == 1, "block").alias("alias_verdict"))
        aliased = judged.join(verdicts, "key", "left")
    return aliased.select("page_id", "host", "path", F.col("fit.rule").alias("rule"),
                          F.coalesce("fit.verdict", "alias_verdict", F.lit("allow")).alias("verdict"))


def op5_url_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"))


#: Addresses linked by canonical links and refreshes are compared as Spark does, step by step in a recursive query.
ORACLE = r"""
WITH RECURSIVE u AS (
  SELECT page_id, url, html, instr(url, '://') AS pos FROM pages),
p AS (
  SELECT page_id, html, url,
         CASE WHEN pos > 0 THEN translate(regexp_extract(substr(url, pos + 3), '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
         CASE WHEN pos > 0 THEN regexp_extract(substr(url, pos + 3), '^[^/?#]*(/[^?#]*)?', 1, 's') ELSE '' END AS path
  FROM u),
r(verdict, h, q) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
fit AS (
  SELECT p.page_id, p.url, p.html, p.host, p.path, arg_max(r.verdict, length(h || q)) AS verdict, arg_max(h || q, length(h || q)) AS rule
  FROM p LEFT JOIN r ON (p.host = h OR ends_with(p.host, '.' || h)) AND starts_with(p.path, q)
  GROUP BY ALL),
-- pages without rule follow the addresses that their markup names, however many steps away
link AS (
  SELECT split_part(url, '#', 1) AS a, split_part(regexp_extract(html, '(?is)<link\b[^>]*\brel="canonical"[^>]*\bhref="([^"]*)"', 1), '#', 1) AS b FROM pages WHERE html ILIKE '%rel="canonical"%'),
sym AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach(a, b) AS (SELECT a, b FROM sym UNION SELECT reach.a, sym.b FROM reach JOIN sym ON reach.b = sym.a),
vote AS (
  SELECT reach.a, bool_or(fit.verdict = 'allow') AS allowed, bool_or(fit.verdict = 'block') AS blocked
  FROM reach JOIN fit ON split_part(fit.url, '#', 1) = reach.b GROUP BY reach.a)
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule,
       coalesce(verdict, CASE WHEN allowed THEN 'allow' WHEN blocked THEN 'block' END, 'allow') AS verdict
FROM fit LEFT JOIN vote ON split_part(fit.url, '#', 1) = vote.a
"""
