"""URL functions: Column in, Column out, built-in expressions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyweb import dims

_AUTHORITY = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)"


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def strip(text: Column) -> Column:
    """Without white space (of any script) at the ends."""
    return F.regexp_replace(text, r"^[\s\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+|[\s\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+$", "")


def hash_text(text: Column) -> Column:
    """Identity of a query or an email: case and outer white space don't count."""
    return sha256(F.lower(strip(text)))


def form_encode(text: Column) -> Column:
    return F.replace(F.replace(F.url_encode(text), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def is_tracking(name: Column) -> Column:
    prefixes = "|".join(p.replace("-", r"\-") for p in dims.TRACKING_PREFIXES)
    return name.isin(*dims.TRACKING_PARAMS) | name.rlike(f"^(?:{prefixes})")


def _malformed(url: Column) -> Column:
    before_query = F.regexp_extract(url, r"^([^?#]*)", 1)
    return url.rlike(r"[\x00-\x1F\x7F]") | before_query.rlike(r"%(?![0-9A-Fa-f]{2})") | url.rlike(r"^(?![A-Za-z][A-Za-z0-9+.-]*:)[^/?#]*:") | F.regexp_extract(url, _AUTHORITY, 1).contains(" ")


def canonical_url(url: Column) -> Column:
    """Scheme and host lowered, no fragment, no trailing slashes, no tracking parameters, the others sorted by name; a malformed url just lowered."""
    plain = F.regexp_replace(url, r"(?s)#.*$", "")
    scheme = F.lower(F.regexp_extract(plain, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1))
    rest = F.regexp_replace(plain, r"^[A-Za-z][A-Za-z0-9+.-]*:", "")
    authority = F.regexp_extract(rest, r"^//([^/?]*)", 1)
    user, host = F.regexp_extract(authority, r"^(.*@)", 1), F.lower(F.regexp_extract(authority, r"([^@]*)$", 1))
    path = F.regexp_replace(F.regexp_extract(rest, r"^(?://[^/?]*)?([^?]*)", 1), r"/+$", "")
    query = F.regexp_extract(rest, r"^[^?]*\?(.*)$", 1)
    # Decoded, filtered, sorted by name (repeated names stay in order), encoded again. What can't be decoded is dropped.
    pairs = F.transform(
        F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.contains(";")),
        lambda p, i: F.struct(F.try_url_decode(F.regexp_extract(p, r"^([^=]*)", 1)).alias("k"), i.alias("i"), F.try_url_decode(F.regexp_extract(p, r"^[^=]*=?(.*)$", 1)).alias("v")),
    )
    kept = F.array_sort(F.filter(pairs, lambda p: p["k"].isNotNull() & p["v"].isNotNull() & ~is_tracking(p["k"])))
    encoded = F.array_join(F.transform(kept, lambda p: F.concat(form_encode(p["k"]), F.lit("="), form_encode(p["v"]))), "&")
    whole = F.concat(
        F.when(scheme != "", F.concat(scheme, F.lit(":"))).otherwise(F.lit("")),
        F.when(rest.rlike("^//"), F.concat(F.lit("//"), user, host)).otherwise(F.lit("")),
        F.when(path == "", F.lit("/")).otherwise(path),
        F.when(encoded != "", F.concat(F.lit("?"), encoded)).otherwise(F.lit("")),
    )
    return F.when(_malformed(url), F.lower(url)).otherwise(whole)


def hash_url(url: Column) -> Column:
    return sha256(canonical_url(url))


def domain(url: Column) -> Column:
    """Lowered host without user and port; '' if there is none."""
    authority = F.regexp_replace(F.regexp_extract(url, _AUTHORITY, 1), r"^.*@", "")
    return F.when(_malformed(url), F.lit("")).otherwise(F.lower(F.when(authority.rlike(r"^\["), F.regexp_extract(authority, r"^\[([^\]]*)\]", 1)).otherwise(F.regexp_extract(authority, r"^([^:]*)", 1))))


def param(url: Column, name: str) -> Column:
    """The first value of a query parameter, decoded; ''."""
    raw = F.regexp_extract(F.regexp_replace(url, "#.*$", ""), rf"[?&]{name}=([^&]*)", 1)
    return F.coalesce(F.try_url_decode(raw), F.lit(""))


def google_target(href: Column) -> Column:
    """The page behind a result link of the first engine; '' if there is none."""
    own = F.startswith(href, F.lit("http"))
    wrapped = F.regexp_extract(href, _AUTHORITY, 1).contains("google.") & href.rlike(r"^[^:]+://[^/?#]*/url\?") & (param(href, "q") != "")
    return F.when(~own & F.startswith(href, F.lit("/url?")), param(href, "q")).when(~own, F.lit("")).when(wrapped, param(href, "q")).otherwise(href)


def bing_target(href: Column) -> Column:
    u = param(href, "u")
    return F.coalesce(F.when(F.startswith(u, F.lit("a1")), F.decode(F.unbase64(F.translate(F.substr(u, F.lit(3)), "-_", "+/")), "UTF-8")), F.lit(""))


def ddg_target(href: Column) -> Column:
    full = F.when(F.startswith(href, F.lit("//")), F.concat(F.lit("https:"), href)).otherwise(href)
    once = param(full, "uddg")
    return F.when(once != "", F.coalesce(F.try_url_decode(once), once)).when(F.startswith(full, F.lit("http")), full).otherwise(F.lit(""))


def search_url(engine: Column, query: Column, page: Column, per_page: int, gl: Column, hl: Column) -> Column:
    """A result page's url; the third engine has one page, whatever page is asked for."""
    q, g, h = form_encode(query), form_encode(gl), form_encode(hl)
    return (
        F.when(engine == "google", F.concat(F.lit("https://www.google.com/search?q="), q, F.lit(f"&num={per_page}&start="), (page * per_page).cast("string"), F.lit("&gl="), g, F.lit("&hl="), h))
        .when(engine == "bing", F.concat(F.lit("https://www.bing.com/search?q="), q, F.lit("&first="), (page * 10 + 1).cast("string"), F.lit("&cc="), g, F.lit("&setlang="), h))
        .when(engine == "duckduckgo", F.concat(F.lit("https://html.duckduckgo.com/html/?q="), q, F.lit("&kl="), g, F.lit("-"), h))
    )


def in_domains(host: Column, domains: tuple[str, ...]) -> Column:
    """host is one of the domains or below one."""
    names = "|".join(d.replace(".", r"\.") for d in domains)
    return host.rlike(rf"(?:^|\.)(?:{names})$")


def skip_domain(host: Column) -> Column:
    """Hosts that are not enriched: listed ones, public bodies, forums and help desks."""
    ends = "|".join(s.replace(".", r"\.") for s in dims.PUBLIC_SUFFIXES)
    begins = "|".join(s.replace(".", r"\.") for s in dims.FORUM_PREFIXES)
    within = "|".join(s.replace(".", r"\.") for s in dims.FORUM_INFIXES)
    return host.isin(*dims.BLOCKED_HOSTS) | host.rlike(f"(?:{ends})$") | host.rlike(f"^(?:{begins})") | host.rlike(f"(?:{within})")


def keep_result(url: Column, engine_domains: tuple[str, ...]) -> Column:
    """A result is kept unless it is the engine's own or excluded and no directory."""
    host = domain(url)
    return ~in_domains(host, engine_domains) & (~in_domains(host, dims.EXCLUDED_DOMAINS) | in_domains(host, dims.DIRECTORY_DOMAINS))


def site_contact_pages(url: Column) -> Column:
    """Pages that may hold contacts, on the url's own scheme and host."""
    site = F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    return F.when(site != "", F.transform(F.array(*[F.lit(p) for p in dims.MORE_CONTACT_PATHS]), lambda p: F.concat(site, p))).otherwise(F.array().cast("array<string>"))


def plain_search_url(query: Column, page: Column, per_page: int) -> Column:
    """The first engine's result page, whatever the country, in English."""
    return F.concat(F.lit("https://www.google.com/search?q="), form_encode(query), F.lit(f"&num={per_page}&start="), (page * per_page).cast("string"), F.lit("&hl=en"))


def contact_pages(host: Column) -> Column:
    return F.array(*[F.concat(F.lit("https://"), host, F.lit(p)) for p in dims.CONTACT_PATHS])


def absolute(href: Column, site: str) -> Column:
    return F.when(F.startswith(href, F.lit("http")), href).otherwise(F.concat(F.lit(site), href))
