"""URL filters with redirect equivalence.

A rule (verdict, host, path) fits its host and all its subdomains where the
url's path starts with the rule's; the longest fitting rule decides. Every
other url takes the decision of its aliases: nodes are urls without scheme,
fragment, tracking parameters and trailing slash, edges are canonical links
and meta-refresh redirects between them, and a connected component that holds
an explicitly allowed url is allowed, one that holds a blocked url (and no
allowed one) is blocked, and any other is allowed.

DataFrame functions only. The html is read for its links alone; edges,
components and decisions are distributed (see components.py). Decisions are
joined salted, since one url may be a third of the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agora.llm.components import SALTS, components
from agora.llm.common import durable

Rule = tuple[str, str, str]              # (allow | block, host, path)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = "(?s)^.*?://([^/?#]*)([^?#]*)"
_QUERY = "(?s)^.*?://[^?#]*[?]([^#]*)"
# Spellings of & in an attribute, tracking parameters.
AMPERSAND = "(?i)&(amp|#38|#x26);"
TRACKING = "^(utm_[^=]*|gclid|fbclid|ref)(=|$)"
_CANONICAL = ("""(?is)<link[^>]*rel=["']?canonical["']?[^>]*href=["']?([^"' >]+)""",
              """(?is)<link[^>]*href=["']?([^"' >]+)["']?[^>]*rel=["']?canonical["']?[ />]""")
_REFRESH = """(?is)<meta[^>]*http-equiv=["']?refresh["']?[^>]*content=["']?[^"'>]*url=["']?([^"'>]+)"""


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(url, _PARTS, 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, _PARTS, 2)


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Name (host + path) and verdict of the longest fitting rule; NULL where none fits.

    The rules are a short list that becomes one expression. Ties in length: by name.
    """
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for word, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = (((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path))
        name = F.when(fits, rule_host + rule_path).otherwise(name)
        verdict = F.when(fits, word).otherwise(verdict)
    return name, verdict


def node_of(url: Column) -> Column:
    """The url's node; NULL for a url without ://."""
    query = F.array_join(F.array_sort(F.filter(
        F.split(F.regexp_extract(url, _QUERY, 1), "&"), lambda x: ~x.rlike(TRACKING))), "&")
    return F.when(F.contains(url, F.lit("://")), F.concat(
        host_of(url), F.regexp_replace(_resolved(path_of(url)), "/+$", ""), F.lit("?"), query))


def _resolved(path: Column) -> Column:
    """The path without its ``.`` and ``..`` segments."""
    segments = F.aggregate(
        F.split(path, "/"), F.expr("CAST(array() AS array<string>)"),
        lambda held, x: F.when(x == "..", F.slice(held, 1, F.greatest(F.size(held) - 1, F.lit(1))))
        .when(x == ".", held).otherwise(F.concat(held, F.array(x))))
    return F.when(F.contains(path, F.lit("/.")), F.array_join(segments, "/")).otherwise(path)


def _target(url: Column, link: Column) -> Column:
    """The absolute url of a link on the page at ``url``, as a browser reads it; NULL without a link."""
    link = F.regexp_replace(F.trim(link), AMPERSAND, "&")
    folder = F.regexp_replace(path_of(url), "[^/]*$", "")
    absolute = (F.when(F.contains(link, F.lit("://")), link)
                .when(link.startswith("//"), F.concat(F.lit("http:"), link))
                .when(link.startswith("/"), F.concat(F.lit("http://"), host_of(url), link))
                .when(link.startswith("?"), F.concat(F.lit("http://"), host_of(url), path_of(url), link))
                .when(link.startswith("#"), url)
                .otherwise(F.concat(F.lit("http://"), host_of(url),
                                    F.when(folder == "", "/").otherwise(folder), link)))
    return F.when(link != "", absolute)


def edges(pages: DataFrame) -> DataFrame:
    """(u, v) nodes joined by a canonical link or a redirect; pages has ``url`` and ``html``."""
    html = F.col("html")
    links = F.array(*[F.regexp_extract(html, p, 1) for p in (*_CANONICAL, _REFRESH)])
    has = html.rlike("(?i)canonical|http-equiv")
    return (pages.filter(has).select("url", F.explode(links).alias("link"))
            .select(node_of(F.col("url")).alias("u"),
                    node_of(_target(F.col("url"), F.col("link"))).alias("v"))
            .filter("u <> v"))


def judge(pages: DataFrame, rules: Sequence[Rule], id_col: str = "page_id", url_col: str = "url",
          html_col: str = "html") -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule`` and ``verdict`` of every row of ``pages``.

    A NULL url, or one without ://, has an empty host and path, no rule and no
    aliases: it is allowed. NULL html has no links. Repeated rows and NULL ids
    are kept as they are; an empty table gives no rows.
    """
    rows = pages.select(pages[id_col].alias("page_id"),
                        F.coalesce(pages[url_col].cast("string"), F.lit("")).alias("url"),
                        pages[html_col].cast("string").alias("html"))
    judged = rows.select("page_id", "url", host_of(F.col("url")).alias("host"),
                         path_of(F.col("url")).alias("path"), node_of(F.col("url")).alias("node"))
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    judged = durable(judged.select("page_id", "host", "path", name.alias("rule"),
                                   verdict.alias("ruled"), "node"))
    links = durable(edges(rows).distinct())
    roots = components(links)
    # the link ends are nodes too, whether they are pages or not
    ends = links.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    _, end_verdict = rule_of(F.regexp_extract("node", "(?s)^([^/?]*)", 1),
                             F.regexp_extract("node", "(?s)^[^/?]*([^?]*)", 1), rules)
    ruled = (judged.select("node", "ruled").filter("node IS NOT NULL AND ruled IS NOT NULL")
             .unionByName(ends.select("node", end_verdict.alias("ruled")).filter("ruled IS NOT NULL"))
             .distinct())
    of_root = (ruled.join(roots, "node", "left")
               .groupBy(F.coalesce("root", "node").alias("root"))
               .agg(F.bool_or(F.col("ruled") == "allow").alias("allow")))
    blocked = of_root.filter("NOT allow").select("root")
    # nodes of blocked components: a root's own node, and every node joined to it
    # one component may hold a third of all nodes: salted
    spread = blocked.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    below = (roots.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int"))
             .join(spread, ["root", "salt"], "left_semi").select("node"))
    nodes = blocked.select(F.col("root").alias("node")).unionByName(below).distinct()
    salted = nodes.select("node", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"),
                          F.lit(True).alias("hit"))
    return (judged.withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int"))
            .join(salted, ["node", "salt"], "left")
            .select("page_id", "host", "path", "rule",
                    F.coalesce("ruled", F.when(F.col("hit"), "block"), F.lit("allow"))
                    .alias("verdict")))


def sql(rules: Sequence[Rule]) -> str:
    """The same verdicts in SQL over ``pages``."""
    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    def node(url: str) -> str:
        query = (f"array_to_string(list_sort(list_filter(string_split(regexp_extract({url}, "
                 f"'{_QUERY}', 1), '&'), lambda x: NOT regexp_matches(x, '{TRACKING}'))), '&')")
        return (f"CASE WHEN contains({url}, '://') THEN "
                f"translate(regexp_extract({url}, '{_PARTS}', 1), '{_UPPER}', '{_LOWER}') || "
                f"regexp_replace({resolved(url)}, '/+$', '') || '?' || {query} END")

    def resolved(url: str) -> str:
        path = f"regexp_extract({url}, '{_PARTS}', 2)"
        segments = (f"list_reduce(list_transform(string_split({path}, '/'), lambda x: [x]), lambda a, x: "
                    "CASE WHEN x[1] = '..' THEN a[1:greatest(len(a) - 1, 1)] WHEN x[1] = '.' THEN a "
                    "ELSE list_concat(a, x) END)")
        return f"CASE WHEN contains({path}, '/.') THEN array_to_string({segments}, '/') ELSE {path} END"

    link = f"regexp_replace(trim(link, ' '), '{AMPERSAND}', '&', 'g')"
    target = (f"CASE WHEN contains({link}, '://') THEN {link} "
              f"WHEN {link} LIKE '//%' THEN 'http:' || {link} "
              f"WHEN {link} LIKE '/%' THEN 'http://' || host || {link} "
              f"WHEN {link} LIKE '?%' THEN 'http://' || host || path || {link} "
              f"WHEN {link} LIKE '#%' THEN url "
              f"ELSE 'http://' || host || coalesce(nullif(regexp_replace(path, '[^/]*$', ''), ''), "
              f"'/') || {link} END")
    values = ", ".join(f"('{w}', '{h}', '{p}')" for w, h, p in rules)
    fits = ("(host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)")
    links = ", ".join(f"regexp_extract(html, {quoted(p)}, 1)" for p in (*_CANONICAL, _REFRESH))
    return f"""
WITH RECURSIVE rules(word, rhost, rpath) AS (VALUES {values}),
page AS (
  SELECT row_number() OVER () AS r, page_id, coalesce(url, '') AS url, html,
         translate(regexp_extract(coalesce(url, ''), '{_PARTS}', 1), '{_UPPER}', '{_LOWER}') AS host,
         regexp_extract(coalesce(url, ''), '{_PARTS}', 2) AS path
  FROM pages),
noded AS (SELECT *, {node('url')} AS node FROM page),
link AS (SELECT url, host, path, node, unnest([{links}]) AS link FROM noded WHERE html IS NOT NULL),
target AS (SELECT node AS u, {target} AS t FROM link WHERE {link} <> ''),
edge AS (SELECT DISTINCT u, v FROM (SELECT u, {node('t')} AS v FROM target) WHERE u <> v),
both_ways AS (SELECT u, v FROM edge UNION SELECT v, u FROM edge),
reach(node, other) AS (
  SELECT u, u FROM both_ways UNION SELECT r.node, b.v FROM reach r JOIN both_ways b ON r.other = b.u),
seen AS (
  SELECT DISTINCT node, host, path FROM noded WHERE node IS NOT NULL
  UNION SELECT DISTINCT u, regexp_extract(u, '(?s)^([^/?]*)', 1),
               regexp_extract(u, '(?s)^[^/?]*([^?]*)', 1) FROM both_ways),
ruled AS (
  SELECT node, host, path, rhost || rpath AS rule, word,
         row_number() OVER (PARTITION BY node, host, path
                            ORDER BY length(rhost || rpath) DESC, rhost || rpath DESC) AS rn
  FROM seen JOIN rules ON {fits}),
word_of AS (SELECT * FROM ruled WHERE rn = 1),
near AS (SELECT node, other FROM reach UNION SELECT node, node FROM seen),
spread AS (SELECT n.node, bool_or(w.word = 'allow') AS allowed
           FROM near n JOIN word_of w ON w.node = n.other GROUP BY n.node)
SELECT p.page_id, p.host, p.path, w.rule,
       coalesce(w.word, CASE WHEN s.allowed = false THEN 'block' ELSE 'allow' END) AS verdict
FROM noded p LEFT JOIN word_of w ON w.node = p.node AND w.host = p.host AND w.path = p.path
LEFT JOIN spread s ON s.node = p.node
"""
