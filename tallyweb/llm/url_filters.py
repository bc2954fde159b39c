"""URL filters with redirect equivalence.

A rule (host + path prefix) fits its host and all subdomains where the url's path starts
with the rule's; the longest fitting rule decides. A url without a rule gets its verdict
from its aliases: pages joined by redirect and canonical-link edges form components, and a
component that holds a blocked url blocks its members without a rule, unless it also holds
an explicitly allowed one (allow takes precedence). Everything else is allowed.

DataFrame functions only; components are distributed (see components.py). Few rules
become one expression; a long list is joined by host suffix.

Defined cases: a null url, or one without ://, has empty host and path, no rule, no
aliases, and is allowed; null or empty html has no edges; repeated rows are judged one by
one; a table without edges skips the components; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweb.llm.common import store
from tallyweb.llm.components import components

#: (verdict, rule): host up to the first slash, then the path's beginning.
RULES: list[tuple[str, str]] = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]
#: Up to so many rules are one expression, more are joined.
INLINE_RULES = 200


def _rest(url: Column) -> Column:
    """What follows the first ://, or nothing."""
    at = F.locate("://", url)
    return F.coalesce(F.when(at > 0, F.substr(url, at + 3)), F.lit(""))


def _host(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(url), "^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _path(url: Column) -> Column:
    return F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)


def _node(url: Column) -> Column:
    """A hash of host, path and query (scheme and fragment don't tell urls apart); null without a host."""
    host = _host(url)
    return F.when(host != "", F.xxhash64(F.concat(host, F.regexp_extract(_rest(url), "^[^/?#]*([^#]*)", 1))))


def split_url(df: DataFrame) -> DataFrame:
    """Adds host, path and _node to a frame with _url."""
    url = F.col("_url")
    return df.withColumns({"host": _host(url), "path": _path(url), "_node": _node(url)})


def _parts(rule: str) -> tuple[str, str]:
    host, slash, path = rule.partition("/")
    return host, slash + path


def match_rules(df: DataFrame, rules: list[tuple[str, str]] | DataFrame) -> DataFrame:
    """Adds rule and its verdict (both null if none fits) to a frame with host and path.

    rules: a list, or a table (verdict, rule) for long lists.
    """
    if isinstance(rules, list) and len(rules) <= INLINE_RULES:
        fits = found = None
        for verdict, rule in sorted(rules, key=lambda r: (-len(r[1]), r[0], r[1])):
            host, path = _parts(rule)
            here = ((F.col("host") == host) | F.endswith("host", F.lit("." + host))) & F.startswith("path", F.lit(path))
            fits = F.when(here, F.lit(rule)) if fits is None else fits.when(here, F.lit(rule))
            found = F.when(here, F.lit(verdict)) if found is None else found.when(here, F.lit(verdict))
        none = F.lit(None).cast("string")
        return df.withColumn("rule", none if fits is None else fits).withColumn("_explicit", none if found is None else found)
    if isinstance(rules, list):
        rules = df.sparkSession.createDataFrame(rules, "verdict string, rule string")
    listed = rules.select(F.split_part("rule", F.lit("/"), F.lit(1)).alias("_suffix"), F.expr("substring(rule, locate('/', rule))").alias("_prefix"), "rule", F.col("verdict").alias("_explicit"))
    # A rule is found by host suffix, so only distinct (host, path) pairs are multiplied by their labels.
    urls = df.select("host", "path").distinct()
    labels = F.split("host", "\\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    pairs = urls.withColumn("_suffix", F.explode(suffixes)).join(listed, "_suffix").where("startswith(path, _prefix)")
    best = pairs.groupBy("host", "path").agg(F.max_by(F.struct("rule", "_explicit"), F.struct(F.length("rule"), F.when(F.col("_explicit") == "allow", 1).otherwise(0), "rule")).alias("_r"))
    return df.join(best.select("host", "path", "_r.rule", "_r._explicit"), ["host", "path"], "left")


def resolve(base: Column, link: Column) -> Column:
    """The url that a link on the page base leads to; null for an empty link, a fragment or another kind of address."""
    scheme = F.regexp_extract(base, "^([^:/?#]*):", 1)
    site = F.regexp_extract(base, "^([^:/?#]*://[^/?#]*)", 1)
    path = F.regexp_extract(base, "^[^:/?#]*://[^/?#]*([^?#]*)", 1)
    rest = F.regexp_extract(link, "^[^?#]*([?#].*)$", 1)
    folder = F.when(F.startswith(link, F.lit("/")), F.lit("")).otherwise(F.regexp_extract(path, "^(.*/)[^/]*$", 1))
    joined = F.concat(F.when(folder == "", F.lit("/")).otherwise(folder), F.regexp_extract(link, "^/*([^?#]*)", 1))
    # . and .. are taken out segment by segment; one at the end leaves the folder.
    parts = F.split(F.substr(joined, F.lit(2)), "/")
    empty = F.array().cast("array<string>")
    clean = F.aggregate(parts, empty, lambda done, x: F.when(x == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))).when(x == ".", done).otherwise(F.concat(done, F.array(x))))
    tail = F.when(F.element_at(parts, -1).isin(".", ".."), F.lit("/")).otherwise(F.lit(""))
    whole = F.concat(site, F.lit("/"), F.array_join(clean, "/"), F.when(F.size(clean) > 0, tail).otherwise(F.lit("")), rest)
    return (
        F.when(link.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), link)
        .when(F.startswith(link, F.lit("//")), F.concat(scheme, F.lit(":"), link))
        .when((link == "") | link.rlike("^(?:#|[A-Za-z][A-Za-z0-9+.-]*:)") | (site == ""), F.lit(None))
        .when(F.startswith(link, F.lit("?")), F.concat(site, path, link))
        .otherwise(whole)
    )


def page_edges(pages: DataFrame) -> DataFrame:
    """(src, dst) urls from canonical links and meta refreshes in pages (_url, _html), comments aside."""
    held = pages.where("_html rlike '(?i)canonical|refresh'").select("_url", F.regexp_replace("_html", r"(?s)<!--.*?(?:-->|\z)", "").alias("_html"))
    tags = F.regexp_extract_all("_html", F.lit(r"(?is)<(?:link|meta)\b[^>]*>"), F.lit(0))
    canonical = r"""(?is)^<link\b.*\brel\s*=\s*(?:"[^"]*(?<![\w-])canonical(?![\w-])[^"]*"|'[^']*(?<![\w-])canonical(?![\w-])[^']*'|canonical(?![\w-]))"""
    marked = F.filter(tags, lambda t: t.rlike(canonical) | t.rlike(r"""(?is)^<meta\b.*http-equiv\s*=\s*["']?refresh\b"""))
    df = held.select("_url", F.explode(marked).alias("_tag"))
    href = F.regexp_extract("_tag", r"""(?is)\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", 0)
    target = F.regexp_replace(href, r"""(?is)^href\s*=\s*["']?|["']$""", "")
    refresh = F.regexp_extract("_tag", r"""(?is)\burl\s*=\s*["']?([^"'>\s]+)""", 1)
    to = F.regexp_replace(F.trim(F.when(F.lower(F.substring("_tag", 1, 5)) == "<link", target).otherwise(refresh)), "&amp;", "&")
    df = df.select("_url", to.alias("_to"))
    return df.select(F.col("_url").alias("src"), resolve(F.col("_url"), F.col("_to")).alias("dst")).where("src IS NOT NULL AND dst IS NOT NULL AND src <> dst")


def judge_urls(
    pages: DataFrame,
    rules: list[tuple[str, str]] | DataFrame = RULES,
    redirects: DataFrame | None = None,
    page_id: str = "page_id",
    url: str = "url",
    html: str | None = "html",
) -> DataFrame:
    """page_id, host, path, rule and verdict of every page.

    redirects: optional table (src, dst) of followed redirects.
    """
    own = [F.col(page_id).alias("page_id"), F.col(url).cast("string").alias("_url")]
    edges = redirects.select("src", "dst") if redirects is not None else None
    if html is not None:
        linked = page_edges(pages.select(*own, F.col(html).cast("string").alias("_html")))
        edges = linked if edges is None else edges.unionByName(linked)
    marked = match_rules(split_url(pages.select(*own)), rules)
    keep = ["page_id", "host", "path", "rule"]
    if edges is not None:
        edges = store(edges, "edges")
    if edges is None or edges.isEmpty():
        return marked.select(*keep, F.coalesce("_explicit", F.lit("allow")).alias("verdict"))
    pairs = edges.select(_node(F.col("src")).alias("a"), _node(F.col("dst")).alias("b")).where("a IS NOT NULL AND b IS NOT NULL")
    grown = store(components(pairs), "aliases")
    # Targets that are no pages themselves still carry their rules into the component.
    nodes = split_url(edges.select(F.col("src").alias("_url")).unionAll(edges.select(F.col("dst").alias("_url"))))
    nodes = match_rules(nodes.select("host", "path", "_node").distinct(), rules).select(F.col("_node").alias("id"), "_explicit").distinct()
    verdicts = grown.join(nodes, "id").groupBy("component").agg(F.bool_or(F.col("_explicit") == "allow").alias("_allow"), F.bool_or(F.col("_explicit") == "block").alias("_block"))
    aliases = grown.join(verdicts, "component").where("_block AND NOT coalesce(_allow, false)").select(F.col("id").alias("_node"), F.lit("block").alias("_inherited"))
    out = marked.join(aliases, "_node", "left")
    return out.select(*keep, F.coalesce("_explicit", "_inherited", F.lit("allow")).alias("verdict"))
