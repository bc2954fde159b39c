"""Bodies of pages: charset, links and listing cards by element, in Arrow batches."""

from __future__ import annotations

import codecs
import re
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_BOMS = ((codecs.BOM_UTF8, "utf-8"), (codecs.BOM_UTF16_LE, "utf-16-le"), (codecs.BOM_UTF16_BE, "utf-16-be"))


def decode_body(body: bytes | None, content_type: str | None) -> str:
    """Text of a body: charset of the header, the byte order mark, the page itself, else UTF-8 or windows-1252; what is invalid is dropped."""
    body = bytes(body or b"")
    found = re.search(r"charset\s*=\s*[\"']?([\w.:-]+)", content_type or "", re.I)
    names = [found[1]] if found else []
    names += [name for mark, name in _BOMS if body.startswith(mark)]
    meta = re.search(rb"<meta[^>]+charset\s*=\s*[\"']?([\w.:-]+)", body[:4096], re.I)
    names += [meta[1].decode("ascii", "ignore")] if meta else []
    for name in names:
        try:
            codec = codecs.lookup({"iso-8859-1": "windows-1252", "latin1": "windows-1252", "ascii": "windows-1252"}.get(name.lower(), name))
            return codec.decode(body, "ignore")[0].lstrip("﻿")
        except LookupError:
            continue
    try:
        return body.decode("utf-8")
    except UnicodeDecodeError as e:
        cut = e.start >= len(body) - 3
        return body.decode("utf-8" if cut else "windows-1252", "ignore")


def decode_column(body: Column, content_type: Column) -> Column:
    @F.pandas_udf("string")
    def run(bodies: pd.Series, types: pd.Series) -> pd.Series:
        return pd.Series([decode_body(b, t) for b, t in zip(bodies, types, strict=True)], dtype=object)

    return run(body, content_type)


@dataclass
class Spec:
    """What a site's listing cards look like: each is an element with one of the classes; fields are classes within it."""

    site: str
    card: tuple[str, ...]
    fields: dict[str, tuple[str, ...]] = field(default_factory=dict)
    link: str = ""
    once: bool = True


# ---- Fixed values: cards of the directories ----
SPECS = (
    Spec("classpass.com", ("venue-card", "VenueCard"), {"name": ("venue-name",), "address": ("venue-address",), "category": ("venue-category",)}, "/studios/"),
    Spec("yelp.com", ("businessName",), {"name": ("businessName",), "address": ("secondaryAttributes",), "phone": ("phone",)}, "/biz/"),
    Spec("yellowpages.com", ("result", "v-card"), {"name": ("business-name",), "phone": ("phones",), "address": ("street-address", "locality"), "category": ("categories",)}, "", False),
    Spec("yogaalliance.org", ("search-result", "directory-item"), {"name": ("result-name",), "address": ("result-address",), "phone": ("result-phone",)}, "/"),
    Spec("tripadvisor.com", ("listing_title", "result-card"), {"name": ("listing_title", "title"), "address": ("address",)}, "/"),
)
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())


class _Cards(HTMLParser):
    def __init__(self, spec: Spec):
        super().__init__(convert_charrefs=True)
        self.spec, self.cards, self.stack, self.now = spec, [], [], None

    def handle_starttag(self, tag, attrs):
        own = dict(attrs)
        classes = set((own.get("class") or "").split())
        if tag not in _VOID:
            self.stack.append((tag, [f for f, c in self.spec.fields.items() if classes & set(c)]))
        if self.now is None and classes & set(self.spec.card):
            self.now = {"_depth": len(self.stack), "url": ""}
        if self.now is not None and tag == "a" and not self.now["url"] and own.get("href") and self.spec.link in own["href"]:
            href = own["href"]
            self.now["url"] = href if href.startswith("http") else f"https://www.{self.spec.site}{href}"

    def handle_endtag(self, tag):
        if not any(t == tag for t, _ in self.stack):
            return
        while self.stack:
            if self.now is not None and len(self.stack) == self.now["_depth"]:
                self.cards.append(self.now)
                self.now = None
            if self.stack.pop()[0] == tag:
                break

    def handle_data(self, data):
        if self.now is not None:
            for f in {f for _, fields in self.stack for f in fields}:
                self.now[f] = " ".join((self.now.get(f, "") + " " + data).split())


def listing_cards(html: str | None, spec: Spec) -> list[dict]:
    """Cards with a name, each name once (where the site says so)."""
    parser = _Cards(spec)
    parser.feed(html or "")
    parser.close()
    out, seen = [], set()
    for card in parser.cards + ([parser.now] if parser.now else []):
        name = card.get("name", "")
        if name and not (spec.once and name in seen):
            seen.add(name)
            out.append({"name": name, "url": card["url"], "address": card.get("address", ""), "phone": card.get("phone", ""), "category": card.get("category", "")})
    return out


def explode_cards(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """The columns of pages but html, and the fields of each card of a directory's page."""
    kind = "array<struct<name:string,url:string,address:string,phone:string,category:string>>"

    @F.pandas_udf(kind)
    def run(urls: pd.Series, bodies: pd.Series) -> pd.Series:
        out = []
        for u, b in zip(urls, bodies, strict=True):
            host = (re.match(r"https?://(?:www\.)?([^/?#:]+)", u or "") or [None, ""])[1].lower()
            spec = next((s for s in SPECS if host == s.site or host.endswith("." + s.site)), None)
            out.append(listing_cards(b, spec) if spec else [])
        return pd.Series(out, dtype=object)

    kept = [c for c in pages.columns if c != html]
    return pages.select(*kept, F.explode(run(F.col(url), F.col(html))).alias("_card")).select(*kept, *[F.col(f"_card.{f}").alias(f"card_{f}") for f in ("name", "url", "address", "phone", "category")])


class _Selected(HTMLParser):
    """Text of the first element of each selector (tag, class or itemprop)."""

    def __init__(self, wanted: dict[str, tuple[str, ...]]):
        super().__init__(convert_charrefs=True)
        self.wanted, self.found, self.stack, self.meta = wanted, {}, [], {}

    def handle_starttag(self, tag, attrs):
        own = dict(attrs)
        if tag == "meta" and own.get("content"):
            self.meta.setdefault((own.get("property") or own.get("name") or "").lower(), own["content"].strip())
        marks = {tag, *(own.get("class") or "").split(), own.get("itemprop") or ""}
        if tag not in _VOID:
            self.stack.append((tag, [k for k, v in self.wanted.items() if marks & set(v) and k not in self.found]))
            for k in self.stack[-1][1]:
                self.found[k] = ""

    def handle_endtag(self, tag):
        if any(t == tag for t, _ in self.stack):
            while self.stack.pop()[0] != tag:
                pass

    def handle_data(self, data):
        for _, keys in self.stack:
            for k in keys:
                self.found[k] = " ".join((self.found[k] + " " + data).split())


# ---- Fixed values: marks of contact data in pages ----
MARKS = {"person": ("fn", "n", "author"), "org": ("org", "organization-name"), "address": ("address", "adr", "street-address", "postal-address")}


def page_metadata(html: str | None) -> dict:
    """name, description, category, contact and address from meta tags and microformats."""
    parser = _Selected(MARKS)
    parser.feed(html or "")
    parser.close()
    m, f = parser.meta, parser.found
    short = lambda s, a, b: s if a < len(s) < b else ""
    return {
        "name": m.get("og:title") or m.get("og:site_name") or short(f.get("org", ""), 0, 100),
        "description": m.get("og:description") or m.get("description") or "",
        "category": (m.get("keywords") or "")[:200],
        "contact": m.get("author") or short(f.get("person", ""), 0, 100),
        "address": short(f.get("address", ""), 10, 300),
    }


def metadata_column(html: Column) -> Column:
    @F.pandas_udf("name string, description string, category string, contact string, address string")
    def run(bodies: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([page_metadata(b) for b in bodies], columns=["name", "description", "category", "contact", "address"])

    return run(html)
