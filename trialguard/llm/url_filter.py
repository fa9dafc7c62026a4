"""URL filters with redirect equivalence.

Rules allow or block a host with all its subdomains below a path; the longest fitting rule decides. A page without a
rule takes the decision of its aliases: connected components over redirects (meta refresh, and a table of redirects if
there is one), canonical links, and the bare form of a URL (without ``www.`` or ``m.`` before the host and without a
closing slash). Of a component, an explicit allow goes before a block; without either the page is allowed.

All work is DataFrame expressions and equi-joins. A URL meets rules by (host suffix, path prefix), with prefixes of
the lengths that rules have, so no URL is held against all rules. A component may hold any share of the pages: its
members are never gathered, only their decisions are aggregated, and pages get them by a plain join.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialguard.llm.common import staged
from trialguard.llm.components import connected_components

ATTRIBUTE = r"""(?is)\s{}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]*))"""
TAG = r"(?is)<(?:link|meta)\s[^>]*>"


def lower_ascii(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to a slash, question mark, number sign or the end, in lower case."""
    return lower_ascii(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """What follows the host up to a question mark, number sign or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _query_of(url: Column) -> Column:
    """The query without tracking parameters, with its question mark."""
    asked = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^?#]*\?([^#]*)", 1)
    kept = F.filter(F.split(asked, "&"), lambda p: (p != "") & ~p.rlike("^utm_"))
    return F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")


def _node(host: Column, path: Column, query: Column) -> Column:
    """A node of the alias graph: a hash, so that the order of nodes has nothing to do with links."""
    return F.md5(F.concat(host, F.lit("\n"), path, query))


def _attribute(tag: Column, name: str) -> Column:
    pattern = ATTRIBUTE.format(name)
    found = F.concat(*(F.regexp_extract(tag, pattern, k) for k in (1, 2, 3)))
    return F.replace(F.trim(found), F.lit("&amp;"), F.lit("&"))


def _linked(html: Column) -> Column:
    """Targets of canonical links and of meta refreshes in a page."""
    tags = F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(TAG), F.lit(0))
    wanted = F.filter(
        tags,
        lambda t: (t.rlike("(?i)^<link") & F.lower(_attribute(t, "rel")).rlike(r"(^|\s)canonical(\s|$)"))
        | (t.rlike("(?i)^<meta") & (F.lower(_attribute(t, "http-equiv")) == "refresh")),
    )
    targets = F.transform(
        wanted,
        lambda t: F.when(t.rlike("(?i)^<link"), _attribute(t, "href")).otherwise(
            F.regexp_extract(_attribute(t, "content"), r"""(?is);\s*url\s*=\s*["']?([^"']*)""", 1)
        ),
    )
    return F.filter(targets, lambda t: t != "")


def _resolved(target: Column, host: Column, path: Column) -> Column:
    """A target as an absolute URL; its scheme plays no part."""
    folder = F.regexp_extract(path, r"(?s)^(.*/)", 1)
    base = F.concat(F.lit("x://"), host)
    return (
        F.when(target.rlike(r"(?s)^[A-Za-z][A-Za-z0-9+.-]*://"), target)
        .when(target.startswith("//"), F.concat(F.lit("x:"), target))
        .when(target.startswith("/"), F.concat(base, target))
        .when(target.startswith("?") | target.startswith("#"), F.concat(base, path, target))
        .otherwise(F.concat(base, F.when(folder == "", "/").otherwise(folder), target))
    )


def _ruled(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """``rid, rule, verdict`` of the rows ``rid, host, path`` that a rule fits; the longest rule, the longer host,
    then an allow wins."""
    lengths = [r[0] for r in rules.select(F.length("rule_path")).distinct().collect()]  # a row a length of rule paths
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."),
    )
    prefixes = F.array_distinct(
        F.array(*(F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in sorted(lengths)))
    )
    keyed = rows.where("host != ''").select("rid", F.explode(suffixes).alias("rule_host"), prefixes.alias("prefixes"))
    keyed = keyed.select("rid", "rule_host", F.explode("prefixes").alias("rule_path"))
    fits = keyed.join(rules, ["rule_host", "rule_path"])
    best = F.max(
        F.struct(
            (F.length("rule_host") + F.length("rule_path")).alias("n"), F.length("rule_host").alias("h"),
            (F.col("verdict") == "allow").alias("allow"), F.concat("rule_host", "rule_path").alias("rule"),
        )
    ).alias("best")
    found = fits.groupBy("rid").agg(best)
    return found.select("rid", "best.rule", F.when(F.col("best.allow"), "allow").otherwise("block").alias("verdict"))


def judge(
    pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str | None = "html",
    redirects: DataFrame | None = None,
) -> DataFrame:
    """``id_col, host, path, rule, verdict, by_alias`` for each row of ``pages``.

    ``rules(host, path, verdict)`` hold ``allow`` or ``block``; ``redirects(source, target)`` hold URLs, if given.
    ``rule`` is the deciding rule as host and path, null without one; ``by_alias`` says that aliases decided. A null
    URL, or one without ``://``, has an empty host and path, no rule and no alias, and is allowed. Null html has no
    links. Repeated rows are judged alike; an empty table gives no rows; other columns are not read.
    """
    rules = rules.select(
        lower_ascii(F.col("host")).alias("rule_host"), F.col("path").alias("rule_path"), F.col("verdict")
    )
    url = F.col(url_col)
    links = _linked(F.col(html_col)) if html_col else F.array().cast("array<string>")
    rows = pages.select(
        F.col(id_col).alias("id"), host_of(url).alias("host"), path_of(url).alias("path"),
        _query_of(url).alias("query"), links.alias("links"),
    )
    rows = rows.withColumn("node", F.when(F.col("host") != "", _node(F.col("host"), F.col("path"), F.col("query"))))
    rows = staged(rows.withColumn("rid", F.monotonically_increasing_id()), "pages")

    bare_host = F.regexp_replace("host", r"^(www|m)\.(?=[^.]+\.)", "")
    bare_path = F.regexp_replace("path", r"(?s)(?<=.)/$", "")
    bare = F.concat(F.lit("x://"), bare_host, bare_path, F.col("query"))
    to = F.concat(
        F.transform("links", lambda t: _resolved(t, F.col("host"), F.col("path"))), F.array(bare)
    )
    pairs = rows.where("host != ''").select("node", "host", "path", F.explode(to).alias("to"))
    if redirects is not None:
        source = F.col("source")
        pairs = pairs.unionAll(
            redirects.select(
                _node(host_of(source), path_of(source), _query_of(source)).alias("node"), host_of(source).alias("host"),
                path_of(source).alias("path"), F.col("target").alias("to"),
            ).where("host != ''")
        )
    target = F.col("to")
    pairs = pairs.select(
        "node", "host", "path", host_of(target).alias("to_host"), path_of(target).alias("to_path"),
        _node(host_of(target), path_of(target), _query_of(target)).alias("to_node"),
    ).where("to_host != '' and node != to_node")
    pairs = staged(pairs.distinct(), "aliases")
    groups = staged(
        connected_components(pairs.select(F.col("node").alias("a"), F.col("to_node").alias("b"))), "components"
    )
    ends = pairs.select(F.col("node").alias("rid"), "host", "path").unionAll(
        pairs.select(F.col("to_node"), F.col("to_host"), F.col("to_path"))
    )
    told = _ruled(ends.distinct(), rules)
    decided = groups.join(told, groups["node"] == told["rid"]).groupBy("component").agg(
        F.min("verdict").alias("alias_verdict")  # an allow goes first
    )
    by_node = groups.join(decided, "component").select("node", "alias_verdict")
    ruled = _ruled(rows.select("rid", "host", "path"), rules)
    judged = rows.select("rid", "id", "host", "path", "node").join(ruled, "rid", "left").join(by_node, "node", "left")
    return judged.select(
        F.col("id").alias(id_col), "host", "path", "rule",
        F.coalesce("verdict", "alias_verdict", F.lit("allow")).alias("verdict"),
        (F.col("verdict").isNull() & F.col("alias_verdict").isNotNull()).alias("by_alias"),
    )


def _sql_attribute(name: str) -> str:
    pattern = ATTRIBUTE.format(name).replace("'", "''")
    found = " || ".join(f"regexp_extract(t, '{pattern}', {k})" for k in (1, 2, 3))
    return f"replace(trim({found}), '&amp;', '&')"


def _sql_parts(url: str, prefix: str = "") -> str:
    """Host, path and kept query of a URL as columns."""
    asked = f"string_split(regexp_extract({url}, '(?s)^.*?://[^?#]*\\?([^#]*)', 1), '&')"
    kept = f"list_filter({asked}, lambda x: x <> '' AND NOT starts_with(x, 'utm_'))"
    return f"""translate(regexp_extract({url}, '(?s)^.*?://([^/?#]*)', 1), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS {prefix}host,
      regexp_extract({url}, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS {prefix}path,
      CASE WHEN len({kept}) > 0 THEN '?' || array_to_string({kept}, '&') ELSE '' END AS {prefix}query"""


def sql(rules: list[tuple[str, str, str]]) -> str:
    """DuckDB: the same verdicts for the table ``pages``, with the closure of aliases by recursion."""
    values = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in rules)
    return f"""
WITH RECURSIVE rules(h, p, v) AS (VALUES {values}),
page AS (SELECT row_number() OVER () AS rid, page_id, coalesce(html, '') AS html, {_sql_parts("coalesce(url, '')")} FROM pages),
tag AS (SELECT host, path, query, unnest(regexp_extract_all(html, '{TAG}')) AS t FROM page WHERE host <> ''),
link AS (
  SELECT host, path, query, CASE
    WHEN regexp_matches(t, '(?i)^<link') AND regexp_matches(lower({_sql_attribute("rel")}), '(^|\\s)canonical(\\s|$)') THEN {_sql_attribute("href")}
    WHEN regexp_matches(t, '(?i)^<meta') AND lower({_sql_attribute("http-equiv")}) = 'refresh'
      THEN regexp_extract({_sql_attribute("content")}, '(?is);\\s*url\\s*=\\s*["'']?([^"'']*)', 1) ELSE '' END AS link FROM tag),
target AS (
  SELECT host, path, query, CASE
    WHEN regexp_matches(link, '(?s)^[A-Za-z][A-Za-z0-9+.-]*://') THEN link WHEN starts_with(link, '//') THEN 'x:' || link
    WHEN starts_with(link, '/') THEN 'x://' || host || link
    WHEN starts_with(link, '?') OR starts_with(link, '#') THEN 'x://' || host || path || link
    ELSE 'x://' || host || CASE WHEN regexp_extract(path, '(?s)^(.*/)', 1) = '' THEN '/' ELSE regexp_extract(path, '(?s)^(.*/)', 1) END || link
    END AS t FROM link WHERE link <> ''
  UNION ALL SELECT host, path, query, 'x://' || CASE WHEN regexp_matches(host, '^(www|m)\\.[^.]+\\.') THEN substr(host, instr(host, '.') + 1) ELSE host END
    || CASE WHEN length(path) > 1 AND ends_with(path, '/') THEN left(path, length(path) - 1) ELSE path END || query FROM page WHERE host <> ''),
pair AS (SELECT DISTINCT host, path, query, {_sql_parts("t", "to_")} FROM target),
edge AS (
  SELECT host || chr(10) || path || query AS a, to_host || chr(10) || to_path || to_query AS b FROM pair WHERE to_host <> ''),
both_ways AS (SELECT a, b FROM edge WHERE a <> b UNION SELECT b, a FROM edge WHERE a <> b),
reach(a, b) AS (SELECT a, a FROM both_ways UNION SELECT r.a, e.b FROM reach r JOIN both_ways e ON r.b = e.a),
node AS (
  SELECT host || chr(10) || path || query AS node, host, path FROM page
  UNION SELECT to_host || chr(10) || to_path || to_query, to_host, to_path FROM pair),
ruled AS (
  SELECT node, arg_max(h || p, (length(h || p), length(h), v = 'allow')) AS rule, arg_max(v, (length(h || p), length(h), v = 'allow')) AS verdict
  FROM node, rules WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY node),
alias AS (SELECT r.a AS node, min(d.verdict) AS verdict FROM reach r JOIN ruled d ON r.b = d.node GROUP BY r.a)
SELECT page_id, host, path, rule, coalesce(d.verdict, CASE WHEN host <> '' THEN s.verdict END, 'allow') AS verdict,
  d.verdict IS NULL AND host <> '' AND s.verdict IS NOT NULL AS by_alias
FROM page LEFT JOIN ruled d ON d.node = host || chr(10) || path || query LEFT JOIN alias s ON s.node = host || chr(10) || path || query
"""
