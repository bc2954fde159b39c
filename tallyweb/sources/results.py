"""Result pages of search engines and structured data of directories, in Arrow batches."""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweb import dims
from tallyweb.functions import contacts as ct
from tallyweb.functions import urls as u

_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())


def _has(attributes: dict, tag: str, name: str, condition: str) -> bool:
    """Whether an element is one step of a selector: tag, .class, tag.class or tag[attribute=value]; * fits all."""
    want, _, rest = condition.partition("[")
    want, _, kind = want.partition(".")
    if want not in ("", "*", name):
        return False
    if kind and kind not in (attributes.get("class") or "").split():
        return False
    if rest:
        key, _, value = rest.rstrip("]").partition("=")
        return key in attributes and (not value or attributes[key] == value)
    return True


class _Links(HTMLParser):
    """Addresses of the links that a chain of steps leads to; ">" before a step: a child, not any descendant."""

    def __init__(self, chain: tuple[str, ...]):
        super().__init__(convert_charrefs=True)
        self.chain, self.stack, self.found = chain, [], []

    def _fits(self, stack: list, chain: tuple[str, ...]) -> bool:
        if not chain:
            return True
        step = chain[-1]
        if step.startswith(">"):
            return bool(stack) and _has(stack[-1][1], "", stack[-1][0], step[1:]) and self._fits(stack[:-1], chain[:-1]) if len(chain) > 1 else bool(stack) and _has(stack[-1][1], "", stack[-1][0], step[1:])
        return any(_has(attributes, "", name, step) and self._fits(stack[:k], chain[:-1]) for k, (name, attributes) in enumerate(stack))

    def handle_starttag(self, tag, attrs):
        own = {k: v or "" for k, v in attrs}
        if tag == "a" and own.get("href") and _has(own, "", tag, self.chain[-1].lstrip(">")):
            child = self.chain[-1].startswith(">")
            above = self.chain[:-1]
            if child and above:
                above = (*above[:-1], ">" + above[-1].lstrip(">"))
            if self._fits(self.stack, above):
                self.found.append(own["href"])
        if tag not in _VOID:
            self.stack.append((tag, own))

    def handle_endtag(self, tag):
        if any(t == tag for t, _ in self.stack):
            while self.stack.pop()[0] != tag:
                pass


# ---- Fixed values: where the organic results of each engine are ----
SELECTORS: dict[str, tuple[tuple[str, ...], ...]] = {
    "google": (("div.yuRUbf", ">div", ">span", ">a"), ("a[jsname=UWckNb]",), ("div.g", "a"), ("div[data-sokoban-container]", "a")),
    "bing": (("li.b_algo", "h2", "a"),),
    "duckduckgo": ((".web-result", "a.result__a"),),
}
ENGINE_DOMAINS = {"google": dims.GOOGLE_DOMAINS, "bing": dims.BING_DOMAINS, "duckduckgo": dims.DDG_DOMAINS}


def result_hrefs(html: str | None, engine: str) -> list[str]:
    """Addresses of an engine's results as they stand in the page, by selector, then in page order."""
    out = []
    for chain in SELECTORS.get(engine, ()):
        parser = _Links(chain)
        parser.feed(html or "")
        parser.close()
        out += parser.found
    return out


def target(engine: Column, href: Column) -> Column:
    """The page a result leads to; '' if there is none."""
    wrapped = u.bing_target(href)
    bing = F.when(href.contains("bing.com/ck/a") & (wrapped != ""), wrapped).otherwise(href)
    return F.when(engine == "google", u.google_target(href)).when(engine == "bing", bing).when(engine == "duckduckgo", u.ddg_target(href)).otherwise(F.lit(""))


def search_results(pages: DataFrame, engine: str = "engine", html: str = "html") -> DataFrame:
    """The columns of pages but html, and position and url of each result: unwrapped, not the engine's own, not of an

    excluded domain that is no directory, each url of a page once, at its first place. Positions are from 1 and without gaps.
    """

    @F.pandas_udf("array<string>")
    def run(engines: pd.Series, bodies: pd.Series) -> pd.Series:
        return pd.Series([result_hrefs(b, e) for e, b in zip(engines, bodies, strict=True)], dtype=object)

    kept = [c for c in pages.columns if c != html]
    name = F.col(engine)

    def good(url: Column) -> Column:
        out = F.lit(False)
        for e, domains in ENGINE_DOMAINS.items():
            out = out | ((name == e) & u.keep_result(url, domains))
        return out & F.startswith(url, F.lit("http"))

    urls = F.array_distinct(F.filter(F.transform(run(name, F.col(html)), lambda h: target(name, h)), good))
    out = pages.select(*kept, F.posexplode(urls).alias("position", "url"))
    return out.select(*kept, (F.col("position") + 1).alias("position"), "url")


def structured_listings(pages: DataFrame, html: str = "html") -> DataFrame:
    """The columns of pages but html, and a directory listing for each structured-data object with a name."""
    kept = [c for c in pages.columns if c != html]
    text = lambda v, path: F.coalesce(F.when(~F.try_variant_get(v, path, "string").rlike(r"^\s*[{\[]"), F.try_variant_get(v, path, "string")), F.lit(""))
    parts = ("streetAddress", "addressLocality", "addressRegion", "postalCode")
    each = pages.select(*kept, F.explode(ct.json_ld(F.col(html))).alias("_v"))
    v = F.col("_v")
    joined = F.concat_ws(", ", *[F.nullif(text(v, f"$.address.{k}"), F.lit("")) for k in parts])
    out = each.select(
        *kept,
        text(v, "$.name").alias("name"),
        text(v, "$.url").alias("listing_url"),
        text(v, "$.telephone").alias("phone"),
        text(v, "$.email").alias("email"),
        text(v, "$['@type']").alias("category"),
        F.when(joined != "", joined).otherwise(text(v, "$.address")).alias("address"),
        text(v, "$.aggregateRating.ratingValue").alias("rating"),
    )
    return out.where("name <> ''")
