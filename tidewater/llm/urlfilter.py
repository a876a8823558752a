r"""URL filters with redirect equivalence (DataFrame operations only).

Rules are (verdict, host, path); one fits its host and all subdomains if the
url's path starts with the rule's, and the longest fitting rule wins. They are
one CASE expression, so the pages are judged in the scan without a join.

Pages without a rule take their verdict from the urls they are equivalent to.
A page's canonical link and its refresh redirect are edges between urls (host
and path); the connected components of these edges are sets of aliases. A set
with a blocked url and without an explicitly allowed one is blocked, as are
its unruled pages; everything else is allowed. Urls that are only linked to
count as members of their set with their own rule. A page's own rule always stands.

At scale: only pages with an edge take part in the components; all others
never leave the scan's stage but for one join on the url's key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm._components import components
from tidewater.llm._scratch import settle

#: The rules of the production query.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"),
         ("allow", "org", "/fr/"))


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(_lowered(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def _lowered(host: Column) -> Column:
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _rules(rules, host: Column, path: Column) -> tuple[Column, Column]:
    """Rule and verdict of a url, null if none fits; of equally long rules an allowing one comes first."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[0] == "allow", r[1:])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def _attribute(tag: Column, name: str) -> Column:
    """The value of a tag's attribute, with or without quotes; empty if there is none."""
    found = F.regexp_extract(tag, rf"(?is)\s{name}\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", 1)
    return F.trim(F.regexp_replace(found, r"^[\"']|[\"']$", ""))


def link_edges(pages: DataFrame) -> DataFrame:
    """The canonical links and refresh redirects of pages, as ``(a, b)`` of url keys."""
    tag, to, url = F.col("tag"), F.col("to"), F.col("url")
    # explode(array(x)) keeps filters on x from being moved below it, where x would be computed again
    tags = pages.where(url.contains("://")).select("url", F.explode(F.regexp_extract_all(
        "html", F.lit(r"(?is)<(?:link|meta)\b[^>]*+>"), F.lit(0))).alias("tag"))
    tags = tags.select("url", F.lower(_attribute(tag, "rel")).alias("rel"), _attribute(tag, "href").alias("href"),
                       F.lower(_attribute(tag, "http-equiv")).alias("equiv"), _attribute(tag, "content").alias("content"))
    refresh = F.regexp_extract("content", r"(?is);\s*url\s*=\s*['\"]?\s*([^'\"\s]+)", 1)
    target = (F.when(F.col("rel").rlike(r"(^|\s)canonical(\s|$)"), F.col("href"))
              .when(F.col("equiv") == "refresh", refresh))
    raw = tags.select("url", F.explode(F.array(target)).alias("to")).where("to <> ''")
    raw = raw.select(F.regexp_replace(to, "&amp;", "&").alias("to"), F.regexp_extract("url", r"(?s)^(.*?)://", 1).alias("scheme"),
                     F.regexp_extract("url", r"(?s)^.*?://([^/?#]*)", 1).alias("host"), path_of(url).alias("path"))
    scheme, path = F.col("scheme"), F.col("path")
    root = F.concat(scheme, F.lit("://"), F.col("host"))
    folder = F.when(path == "", "/").otherwise(F.regexp_replace(path, "[^/]*$", ""))
    absolute = (F.when(to.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), to)
                .when(to.startswith("//"), F.concat(scheme, F.lit(":"), to))
                .when(to.startswith("/"), F.concat(root, to))
                .when(to.rlike("^[?#]"), F.concat(root, path, to))
                .when(~to.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.concat(root, folder, to)))
    ends = raw.select("host", "path", F.explode(F.array(absolute)).alias("to")).where(to.contains("://"))
    ends = ends.withColumn("host", _lowered(F.col("host")))
    return (ends.select(F.concat("host", F.lit(" "), "path").alias("a"), F.concat(host_of(to), F.lit(" "), path_of(to)).alias("b"))
            .where("a <> b").distinct())


def judge_urls(pages: DataFrame, rules=RULES) -> DataFrame:
    """``pages(page_id, url, html)`` to page_id, host, path, rule, verdict; a row for each page.

    A null url, or one without ``://``, has empty host and path, no aliases and
    verdict allow. A null html has no links. Repeated pages keep a row each;
    an empty table gives no rows. Other columns are not read.
    """
    host, path = F.col("host"), F.col("path")
    rule, verdict = _rules(rules, host, path)
    judged = (pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
              .withColumn("rule", rule).withColumn("own", verdict))
    sets = components(link_edges(pages))
    h, p = F.substring_index("node", " ", 1), F.expr("substring(node, instr(node, ' ') + 1)")
    # the smallest url of a set is a member too, but has no row of its own
    members = sets.unionByName(sets.select(F.col("component").alias("node"), "component").distinct())
    members = members.withColumn("own", _rules(rules, h, p)[1])
    blocked = (members.groupBy("component")
               .agg(F.max(F.when(F.col("own") == "block", 1).otherwise(0)).alias("b"),
                    F.max(F.when(F.col("own") == "allow", 1).otherwise(0)).alias("a"))
               .where("b = 1 AND a = 0").select("component"))
    bad = settle(members.join(blocked, "component", "left_semi").select(F.col("node").alias("key"), F.lit(True).alias("bad")))
    return (judged.withColumn("key", F.concat("host", F.lit(" "), "path")).join(bad, "key", "left")
            .select("page_id", "host", "path", "rule",
                    F.coalesce("own", F.when(F.col("bad"), "block"), F.lit("allow")).alias("verdict")))


def op9_url_filter(spark, sf_dir: str) -> DataFrame:
    """Every page judged by the four fixed rules and its aliases."""
    return judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"))


#: DuckDB: rules as joins, aliases by a recursive closure over the links.
SQL = r"""
WITH RECURSIVE rules(verdict, h, p) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'),
                                               ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
u AS (SELECT page_id, url, html,
        translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path FROM pages),
links AS (SELECT host || ' ' || path AS a,
                 unnest(regexp_extract_all(coalesce(html, ''), '(?is)<link\b[^>]*\srel="canonical"[^>]*\shref="([^">]*://[^">]*)"', 1)) AS target FROM u),
edges AS (SELECT DISTINCT a, translate(regexp_extract(target, '^(?s:.*?)://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
                 || ' ' || regexp_extract(target, '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS b FROM links),
both_ways AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges),
reach(a, b) AS (SELECT a, a FROM both_ways UNION SELECT r.a, e.b FROM reach r JOIN both_ways e ON r.b = e.a),
nodes AS (SELECT b AS node, split_part(b, ' ', 1) AS host, substr(b, instr(b, ' ') + 1) AS path FROM reach GROUP BY b),
known AS (SELECT host, path FROM u UNION SELECT host, path FROM nodes),
ruled AS (SELECT k.host, k.path, arg_max(r.h || r.p, len(r.h || r.p)) AS rule, arg_max(r.verdict, len(r.h || r.p)) AS own
          FROM known k JOIN rules r ON (k.host = r.h OR ends_with(k.host, '.' || r.h)) AND starts_with(k.path, r.p)
          GROUP BY k.host, k.path),
sets AS (SELECT reach.a AS node, max(CASE WHEN own = 'block' THEN 1 ELSE 0 END) AS b, max(CASE WHEN own = 'allow' THEN 1 ELSE 0 END) AS al
         FROM reach JOIN nodes n ON n.node = reach.b LEFT JOIN ruled USING (host, path) GROUP BY reach.a)
SELECT page_id, u.host, u.path, rule, coalesce(own, CASE WHEN b = 1 AND al = 0 THEN 'block' END, 'allow') AS verdict
FROM u LEFT JOIN ruled ON ruled.host = u.host AND ruled.path = u.path LEFT JOIN sets ON sets.node = u.host || ' ' || u.path
"""
