"""URL filter with redirect equivalence: block decisions reach every alias of a page."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cantora.llm.common import ascii_lower
from cantora.llm.components import connected_components

MAX_RULES = 2000  # rules are literals of the plan; more are refused, not cut


@dataclass(frozen=True)
class Rule:
    """``allow`` or ``block`` of a host with all its subdomains, from a path prefix on."""

    verdict: str
    rule: str  # host/path

    @property
    def host(self) -> str:
        return self.rule.partition("/")[0]

    @property
    def path(self) -> str:
        _, slash, rest = self.rule.partition("/")
        return slash + rest


RULES = (
    Rule("block", "net/"),
    Rule("allow", "example.net/en/"),
    Rule("block", "example.com/de/"),
    Rule("allow", "org/fr/"),
)


def _rest(url: Column) -> Column:
    """What follows the first ``://``; NULL without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _with(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with ``value`` in the plan once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _folded(path: Column) -> Column:
    """An absolute path without its ``.`` and ``..`` segments; ``..`` at the root is dropped."""

    def fold(segments: Column) -> Column:
        return F.aggregate(
            segments,
            F.array().cast("array<string>"),
            lambda done, x: F.when(x == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))))
            .when(x == ".", done)
            .otherwise(F.concat(done, F.array(x))),
        )

    # a last segment of dots is a folder: its slash stays
    segments = F.split(F.regexp_replace(F.substring(path, 2, 1 << 30), r"(^|/)(\.\.?)$", "$1$2/"), "/")
    dotted = path.rlike(r"/\.\.?(/|$)")
    return F.when(dotted, F.concat(F.lit("/"), F.array_join(fold(segments), "/"))).otherwise(path)


def node_of(url: Column) -> Column:
    """The page a URL names, whatever its scheme and fragment: host, path without dot segments, and query."""
    query = F.regexp_extract(_rest(url), r"^[^?#]*(\?[^#]*)", 1)
    return F.when(F.instr(url, "://") > 0, F.concat(host_of(url), _folded(path_of(url)), query))


def resolved(target: Column, url: Column) -> Column:
    """The absolute URL of a link's target on the page ``url``; NULL where it names no page.

    Targets may be absolute, without a scheme, from the root of the host, from the directory of the
    page, or a query or fragment of the page itself. Empty ones and other schemes without a host
    (``mailto:``) name no page. Dot segments are left for ``node_of``.
    """
    named = r"^[a-zA-Z][a-zA-Z0-9+.\-]*:"

    def against(host: Column, path: Column, query: Column, bare: Column) -> Column:
        directory = F.when(path == "", "/").otherwise(F.regexp_extract(path, r"^(.*/)", 1))
        return (
            F.when(bare == "", None)
            .when(bare.rlike(named + "//"), bare)
            .when(bare.rlike(named), None)
            .when(bare.startswith("//"), F.concat(F.lit("http:"), bare))
            .when(bare.startswith("/"), F.concat(host, bare))
            .when(bare.startswith("?"), F.concat(host, path, bare))
            .when(bare.startswith("#"), F.concat(host, path, query))
            .otherwise(F.concat(host, directory, bare))
        )

    def on(url: Column) -> Column:
        query = F.regexp_extract(_rest(url), r"^[^?#]*(\?[^#]*)", 1)
        bare = F.regexp_replace(target, r"^(?i:https?):(?!//)", "")  # http:x is x
        parts = F.struct(
            F.concat(F.lit("http://"), host_of(url)).alias("host"), path_of(url).alias("path"), query.alias("query"), bare.alias("bare"))
        return F.when(url.contains("://"), _with(parts, lambda p: against(p["host"], p["path"], p["query"], p["bare"])))

    return _with(url, on)


def best_rule(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """Struct (rule, verdict) of the longest fitting rule, or NULL; allow wins between equals."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules, {MAX_RULES} at most")
    best = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(set(rules), key=lambda r: (len(r.rule), r.verdict == "allow", r.rule)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        best = F.when(fits, F.struct(F.lit(r.rule).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(best)
    return best


# Text that holds no tags: comments, and what is inside elements of raw text. Leftmost first, so a comment's
# script and a script's comment both end where HTML ends them; unclosed ones run to the end.
_NO_TAGS = r"(?is)<!--.*?(?:-->|\z)|<(script|style|textarea|title|xmp|iframe|noembed|noframes)(?=[\s/>]).*?(?:</\1(?=[\s/>])|\z)"
_TAG = r"""(?i)(<%s\s(?:[^>"']++|"[^"]*+"|'[^']*+')*+>)"""


def attribute(tag: Column, name: str) -> Column:
    """Value of an attribute of a tag, to its closing quote or, without quotes, to the next blank; empty if absent."""
    value = r"""(?i)\s%s\s*=\s*(?:"([^"]*)"|'([^']*)'|([^"'\s>][^\s>]*))""" % name
    return F.trim(F.concat(*(F.regexp_extract(tag, value, i) for i in (1, 2, 3))))


def page_links(pages: DataFrame) -> DataFrame:
    """Edges (a, b) between the nodes of pages and of their canonical links and refresh redirects.

    Both come from the whole html but its comments, scripts and other raw text: every
    ``<link rel=canonical href=...>`` and every ``<meta http-equiv=refresh content="n; url=...">``.
    Relative targets of every form are resolved against the first ``<base href=...>``, where there is
    one, and the page's url.
    """
    url = F.col("url")
    named = pages.where(url.contains("://") & F.col("html").rlike(r"(?i)canonical|http-equiv"))
    named = named.select("url", F.regexp_replace("html", _NO_TAGS, " ").alias("html"))
    links, metas, bases = (F.regexp_extract_all("html", F.lit(_TAG % t), 1) for t in ("link", "meta", "base"))
    canonical = F.transform(
        F.filter(links, lambda t: attribute(t, "rel").rlike(r"(?i)(^|\s)canonical(\s|$)")), lambda t: attribute(t, "href"))
    refresh = r"""(?i)^[\d.\s]*[;,\s]\s*url\s*=\s*(?:"([^"]*)|'([^']*)|([^"'].*))"""
    redirects = F.transform(
        F.filter(metas, lambda t: F.lower(attribute(t, "http-equiv")) == "refresh"),
        lambda t: _with(attribute(t, "content"), lambda c: F.trim(F.concat(*(F.regexp_extract(c, refresh, i) for i in (1, 2, 3))))),
    )
    targets = F.concat(canonical, redirects)
    base = F.get(F.filter(F.transform(bases, lambda t: attribute(t, "href")), lambda t: t != ""), F.lit(0))
    plain = lambda text: F.replace(text, F.lit("&amp;"), F.lit("&"))
    found = named.select("url", plain(base).alias("base"), F.explode(targets).alias("target"))
    based = found.select("url", plain(F.col("target")).alias("target"), F.coalesce(resolved(F.col("base"), url), url).alias("base"))
    target = _with(resolved(F.col("target"), F.col("base")), node_of)
    return based.select(node_of(url).alias("a"), target.alias("b")).where("b IS NOT NULL").distinct()


def redirect_filter(
    pages: DataFrame, rules: tuple[Rule, ...] = RULES, redirects: DataFrame | None = None
) -> DataFrame:
    """page_id, host, path, rule and verdict of every row of ``pages`` (page_id, url, html).

    A URL's own longest rule decides. Without one, the alias group of the page does: the connected
    component over canonical-link and redirect edges, among them those of ``redirects`` (source,
    target URLs), where present. In a group, an allowed URL takes precedence over blocked ones; a group
    with neither, like a page without links, is allowed. URLs of a group that no row has count too,
    and ``rule`` stays NULL for what the group decides.

    Defined cases: a NULL url or one without ``://`` has an empty host and path, no rule and no alias;
    NULL html has no links; repeated rows are judged each; an empty table gives no rows; further
    columns are ignored.
    """
    pages = pages.select("page_id", "url", "html")
    edges = page_links(pages)
    if redirects is not None:
        edges = edges.union(redirects.select(node_of(F.col("source")), _with(resolved(F.col("target"), F.col("source")), node_of)))
    groups = connected_components(edges)
    slash = F.regexp_extract("node", r"^[^/?#]*", 0), F.regexp_extract("node", r"^[^/?#]*([^?]*)", 1)
    decided = groups.withColumn("own", best_rule(*slash, rules)["verdict"])
    verdicts = decided.groupBy("component").agg(
        F.when(F.bool_or(F.col("own") == "allow"), "allow")
        .when(F.bool_or(F.col("own") == "block"), "block")
        .alias("group_verdict")
    )
    aliases = groups.join(verdicts.where("group_verdict IS NOT NULL"), "component").select("node", "group_verdict")
    judged = pages.select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), node_of(F.col("url")).alias("node")
    ).withColumn("best", best_rule(F.col("host"), F.col("path"), rules))
    return judged.join(aliases, "node", "left").select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", "group_verdict", F.lit("allow")).alias("verdict"),
    )
