"""Judge page addresses by rules, and carry block decisions over to aliases.

A rule names a host and the start of a path. It fits its host and all subdomains if the path
of the address starts with the rule's; the longest fitting rule decides.

Addresses that no rule fits are judged by redirect equivalence: a page and the address that it
redirects to (``meta`` refresh) or calls its canonical one are aliases, and so are addresses
that differ in scheme or fragment only, or in ``.`` and ``..`` steps of the path. The first tag of a
kind that has an address counts; entities in it are decoded. Aliases are found as connected components over these
links. In a component an explicit allow takes precedence, else an explicit block of any member
blocks the members without a rule, and otherwise they are allowed. Link targets count as
members also where they are no row of the table.

Defined results: a null address, or one without ``://``, has an empty host and path, fits no
rule, has no alias and is allowed; null or empty html has no links; of fitting rules with equal
length, allow wins; repeated rows are judged alike; other columns are not read. The rules are a
short list given by the caller and become one expression.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakezones.llm.components import connected_components
from lakezones.llm.text import ascii_lower, whole
from lakezones.session import stage

# Patterns of link and refresh tags, and of the address in them.
CANONICAL_TAG = r"""(?i)<link\s[^>]*\brel\s*=\s*["']?canonical\b[^>]*>"""
REFRESH_TAG = r"""(?i)<meta\s[^>]*\bhttp-equiv\s*=\s*["']?refresh\b[^>]*>"""
LINK_ADDRESS = r"""(?i)[\s"']href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^"'\s>]+))"""
REFRESH_ADDRESS = r"""(?i)[\s"';,]url\s*=\s*(?:"([^"]*)"|'([^']*)'|([^"'\s>]+))"""
# How characters that mean something in tags are written in an address; the ampersand comes last.
ENTITIES = {
    "&quot;": '"', "&#34;": '"', "&apos;": "'", "&#39;": "'", "&#x27;": "'", "&lt;": "<", "&gt;": ">", "&#x2F;": "/", "&#47;": "/",
    "&#38;": "&", "&#x26;": "&", "&amp;": "&",
}
DOTS = r"/\.{1,2}(/|$)"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def parse_rule(text: str) -> Rule:
    """``block example.org/es/`` as a rule."""
    verdict, address = text.split(" ", 1)
    host, slash, path = address.partition("/")
    return Rule(verdict, host, slash + path)


def _after_scheme(url: Column) -> Column:
    return F.when(url.contains("://"), F.substring(url, F.locate("://", url) + 3, F.length(url))).otherwise(F.lit(""))


def url_host(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(_after_scheme(whole(url)), "^[^/?#]*", 0))


def url_path(url: Column) -> Column:
    return F.regexp_extract(_after_scheme(whole(url)), "^[^/?#]*([^?#]*)", 1)


def without_dots(path: Column) -> Column:
    """The path without ``.`` and ``..`` steps."""
    steps = F.split(path, "/", -1)

    def walked(way: Column, step: Column) -> Column:
        back = F.slice(way, 1, F.greatest(F.size(way) - 1, F.lit(1)))
        return F.when(step == ".", way).when(step == "..", back).otherwise(F.concat(way, F.array(step)))

    way = F.aggregate(F.slice(steps, 2, F.size(steps)), F.array(F.lit("")), walked)
    ends_in_folder = F.element_at(steps, -1).isin(".", "..")
    plain = F.concat(F.array_join(way, "/"), F.when(ends_in_folder, "/").otherwise(""))
    return F.when(path.rlike(DOTS), plain).otherwise(path)


def url_node(url: Column) -> Column:
    """What aliases share: the address without scheme, fragment and dot steps; null without ``://``."""
    query = F.regexp_extract(_after_scheme(whole(url)), r"^[^/?#]*[^?#]*(\?[^#]*)", 1)
    return F.when(whole(url).contains("://"), F.concat(url_host(url), without_dots(url_path(url)), query))


def deciding_rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the longest fitting rule, null where none fits."""
    ordered = sorted(rules, key=lambda rule: (-len(rule.text), rule.verdict != "allow"))
    name = verdict = None
    for rule in ordered:
        on_host = (host == rule.host) | host.endswith("." + rule.host)
        fits = on_host & path.startswith(rule.path)
        name = F.when(fits, rule.text) if name is None else name.when(fits, rule.text)
        verdict = F.when(fits, rule.verdict) if verdict is None else verdict.when(fits, rule.verdict)
    none = F.lit(None).cast("string")
    return (none, none) if name is None else (name, verdict)


def tag_address(html: Column, tag: str, address: str) -> Column:
    """The address in the first such tag that has one; null without one."""

    def found(text: Column) -> Column:
        value = F.btrim(F.concat(*[F.regexp_extract(text, address, group) for group in (1, 2, 3)]))
        for entity, character in ENTITIES.items():
            value = F.replace(value, F.lit(entity), F.lit(character))
        return value

    tags = F.regexp_extract_all(whole(html), F.lit(tag), F.lit(0))
    return F.get(F.filter(F.transform(tags, found), lambda one: one != ""), 0)


def link_target(url: Column, html: Column, tag: str, address: str) -> Column:
    """The absolute address in the first such tag that has one, null without one."""
    found = tag_address(html, tag, address)
    scheme = F.substring_index(url, "://", 1)
    site = F.concat(scheme, F.lit("://"), url_host(url))
    folder = F.regexp_extract(url_path(url), "^(.*/)?", 0)
    target = (
        F.when(found.isNull() | ~whole(url).contains("://"), None)
        .when(found.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), found)
        .when(found.startswith("//"), F.concat(scheme, F.lit(":"), found))
        .when(found.startswith("/"), F.concat(site, found))
        .when(found.startswith("#") | found.startswith("?"), F.concat(site, url_path(url), found))
        .otherwise(F.concat(site, F.when(folder == "", "/").otherwise(folder), found))
    )
    return _plain_address(target)


def _plain_address(url: Column) -> Column:
    """The address without dot steps in its path."""
    start, rest = F.regexp_extract(url, "^.*?://[^/?#]*", 0), F.regexp_extract(url, "^.*?://[^?#]*(.*)$", 1)
    return F.when(url_path(url).rlike(DOTS), F.concat(start, without_dots(url_path(url)), rest)).otherwise(url)


def alias_links(pages: DataFrame) -> DataFrame:
    """``url`` and ``target`` of every redirect and canonical link between differing addresses."""
    targets = F.array(
        link_target(F.col("url"), F.col("html"), CANONICAL_TAG, LINK_ADDRESS),
        link_target(F.col("url"), F.col("html"), REFRESH_TAG, REFRESH_ADDRESS),
    )
    links = pages.select("url", F.explode(targets).alias("target")).filter("target IS NOT NULL")
    return links.filter(url_node(F.col("url")) != url_node(F.col("target")))


def alias_verdicts(links: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The verdict of each address in ``links`` that its aliases give it: ``node``, ``inherited``."""
    addresses = links.select("url").unionByName(links.select(F.col("target").alias("url")))
    _, verdict = deciding_rule(url_host(F.col("url")), url_path(F.col("url")), rules)
    own = addresses.select(url_node(F.col("url")).alias("node"), verdict.alias("verdict")).distinct()
    edges = links.select(url_node(F.col("url")).alias("a"), url_node(F.col("target")).alias("b"))
    members = stage(connected_components(edges).join(own, "node"), "url-aliases")
    decided = members.groupBy("component").agg(
        F.max(F.col("verdict") == "allow").alias("allowed"), F.max(F.col("verdict") == "block").alias("blocked")
    )
    inherited = F.when(F.col("allowed"), "allow").when(F.col("blocked"), "block")
    named = members.select("node", "component").join(decided, "component")
    return named.select("node", inherited.alias("inherited")).filter("inherited IS NOT NULL")


def judge_urls(pages: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """page_id, host, path, rule and verdict of every page."""
    links = stage(alias_links(pages), "url-links")
    url = F.col("url")
    parts = pages.select("page_id", url_host(url).alias("host"), url_path(url).alias("path"), url_node(url).alias("node"))
    rule, verdict = deciding_rule(F.col("host"), F.col("path"), rules)
    judged = parts.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("own"), "node")
    if links.isEmpty():
        inherited = F.lit(None).cast("string")
    else:
        judged = judged.join(stage(alias_verdicts(links, rules), "url-verdicts"), "node", "left")
        inherited = F.col("inherited")
    return judged.select("page_id", "host", "path", "rule", F.coalesce("own", inherited, F.lit("allow")).alias("verdict"))
