"""Operator 3, URL filters: block decisions reach every alias of a page through redirects and canonical links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapdelta.llm.common import ascii_lower, kept, scratch
from snapdelta.llm.graph import components

#: Rule (host, path) and verdict.
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"

_SPACE = r"[\x20\x09-\x0D]"
_EQUALS = rf"{_SPACE}*={_SPACE}*"
#: An attribute begins behind white space, a slash or the quote of the one before.
_BEFORE = r"""[\x20\x09-\x0D"'/]"""
UNSEEN = "(?is)<!--.*?(?:-->|\\z)|" + "|".join(rf"<{x}\b.*?(?:</{x}\b[^<>]*>|\z)" for x in ("script", "style", "template", "textarea"))
VALUE = rf"""{_EQUALS}["']?{_SPACE}*([^"'\x20\x09-\x0D<>]+)"""
HREF = rf"{_BEFORE}href"
BASE = rf"(?i)<base\b[^<>]*{HREF}{_EQUALS}[^<>]*"
REFRESH = rf"""(?i)<meta\b[^<>]*{_BEFORE}http-equiv{_EQUALS}["']?{_SPACE}*refresh\b[^<>]*"""
#: ``canonical`` is one word of the attribute's list.
CANONICAL = (
    rf"(?i)<link\b[^<>]*{_BEFORE}rel{_EQUALS}(?:"
    + "|".join(rf"{q}(?:[^{q}<>]*{_SPACE})?canonical(?:{_SPACE}[^{q}<>]*)?{q}[^<>]*" for q in "\"'")
    + r"|canonical(?:[\x20\x09-\x0D/][^<>]*)?(?:[<>]|\z))"
)


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, PARTS, 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, as a struct (rule, verdict), or null; of two equally long ones an allowing one."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for name, start, verdict in sorted(rules, key=lambda r: (len(r[0] + r[1]), r[2] == "allow")):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        out = F.when(fits, F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def without_dots(path: Column) -> Column:
    """The path without its segments ``.`` and ``..``, which the latter takes one more with it."""
    parts = F.split(path, "/")
    up = lambda so_far: F.slice(so_far, 1, F.greatest(F.size(so_far) - 1, F.lit(0)))
    left = F.aggregate(
        F.slice(parts, 2, F.size(parts)),
        F.array().cast("array<string>"),
        lambda so_far, x: F.when(x == "..", up(so_far)).when(x == ".", so_far).otherwise(F.array_append(so_far, x)),
        lambda so_far: F.concat(F.lit("/"), F.array_join(so_far, "/"), F.when(path.rlike(r"/\.\.?\z") & (F.size(so_far) > 0), "/").otherwise("")),
    )
    return F.when(path.rlike(r"/\.\.?(/|\z)"), left).otherwise(path)


def node_of(host: Column, path: Column) -> Column:
    """The node of a page; null without a host."""
    return F.when(host != "", F.concat(host, F.when(path == "", "/").otherwise(without_dots(path))))


def visible_markup(html: Column) -> Column:
    """The markup that can hold a link of the page: comments, scripts, styles, templates and text areas are blank. Null for a
    page that names neither a refresh nor a canonical link, which spares it all further scans."""
    named = F.lower(html).contains("refresh") | F.lower(html).contains("canonical")
    return F.when(named, F.regexp_replace(html, F.lit(UNSEEN), F.lit(" ")))


def linked_urls(url: Column, markup: Column) -> Column:
    """Where a page says it belongs: the targets of all its refreshes and canonical links in its visible markup. Relative
    ones are resolved against the page's first ``base`` (itself resolved against the page), else against the page.
    Targets of other schemes without ``//`` (mailto and the like) are left out."""

    def targets(tag: str, attribute: str) -> Column:
        tags = F.regexp_extract_all(markup, F.lit(tag), F.lit(0))
        return F.coalesce(F.transform(tags, lambda x: F.regexp_extract(x, "(?i)" + attribute + VALUE, 1)), F.array().cast("array<string>"))

    def resolved(target: Column, near: Column) -> Column:
        own = F.concat(F.lit("http://"), host_of(near))
        return (
            F.when(target.rlike("^[A-Za-z][A-Za-z0-9+.-]*://") | target.startswith("://"), target)
            .when(target.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None))
            .when(target.startswith("//"), F.concat(F.lit("http:"), target))
            .when(target.startswith("/"), F.concat(own, target))
            .when(target.rlike("^[?#]"), F.concat(own, path_of(near)))
            .otherwise(F.concat(own, F.coalesce(F.nullif(F.regexp_extract(path_of(near), "(?s)^.*/", 0), F.lit("")), F.lit("/")), target))
        )

    page = F.coalesce(url, F.lit(""))
    base = F.nullif(F.coalesce(F.regexp_extract(F.regexp_extract(markup, BASE, 0), "(?i)" + HREF + VALUE, 1), F.lit("")), F.lit(""))
    near = F.coalesce(resolved(base, page), page)
    every = F.concat(targets(REFRESH, r"\burl"), targets(CANONICAL, HREF))
    given = F.transform(F.filter(every, lambda x: x != ""), lambda x: resolved(F.replace(x, F.lit("&amp;"), F.lit("&")), near))
    return F.array_compact(given)


def url_filter(pages: DataFrame, rules=RULES, url: str = "url", html: str = "html") -> DataFrame:
    """All columns of ``pages`` but the html, with ``host``, ``path``, ``rule`` (null: none fits) and ``verdict``.

    Pages are nodes by host and path: scheme, query and fragment lead to the same page. All redirects and canonical links
    of a page are edges, but for those in comments, scripts, styles, templates and text areas. A page's own rule decides; without one, a group that holds an explicitly allowed address is allowed, else a
    group that holds a blocked one is blocked, else the page is allowed. A null url, or one without ``://``, has empty
    parts and no links and is allowed. Repeated rows get equal results; an empty table stays empty. Columns with the
    names of the results are replaced.
    """
    ids = [c for c in pages.columns if c not in (html, "host", "path", "rule", "verdict") and not c.startswith("_")]
    # A column of its own: as part of each scan the markup would be cleaned anew.
    seen = pages.select(*ids, F.col(url).alias("_url"), visible_markup(F.col(html)).alias("_markup"))
    links = F.transform(linked_urls(F.col("_url"), F.col("_markup")), lambda x: node_of(host_of(x), path_of(x)))
    read = seen.select(*ids, host_of(F.col("_url")).alias("host"), path_of(F.col("_url")).alias("path"), F.array_distinct(F.array_compact(links)).alias("_links"))
    judged = read.withColumn("_rule", rule_of(F.col("host"), F.col("path"), rules))
    judged = judged.select(*ids, "host", "path", "_rule", node_of(F.col("host"), F.col("path")).alias("_node"), "_links")
    with scratch(pages.sparkSession):
        judged = kept(judged, "url-pages", result=True)
        groups = components(judged.where("_node is not null").select(F.col("_node").alias("a"), F.explode("_links").alias("b")))
        slash = F.instr("node", "/")
        ruled = groups.withColumn("_rule", rule_of(F.expr("substring(node, 1, instr(node, '/') - 1)"), F.col("node").substr(slash, F.length("node")), rules))
        decided = ruled.groupBy("root").agg(
            F.bool_or(F.coalesce(F.col("_rule.verdict") == "allow", F.lit(False))).alias("allows"),
            F.bool_or(F.coalesce(F.col("_rule.verdict") == "block", F.lit(False))).alias("blocks"),
        )
        blocked = groups.join(decided.where("blocks and not allows").select("root"), "root")
        aliases = kept(blocked.select(F.col("node").alias("_node"), F.lit(True).alias("_blocked")), "url-blocked", result=True)
    verdict = F.coalesce(F.col("_rule.verdict"), F.when(F.col("_blocked"), "block").otherwise("allow"))
    return judged.join(aliases, "_node", "left").select(*ids, "host", "path", F.col("_rule.rule").alias("rule"), verdict.alias("verdict"))
