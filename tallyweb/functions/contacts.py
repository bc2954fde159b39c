"""Contact functions: emails, phones, social handles, structured data, countries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyweb import dims

EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
PHONE = r"\+?[0-9][0-9 ().-]{7,18}[0-9]"


def _in(c: Column, values: tuple[str, ...]) -> Column:
    return c.isin(*values)


def _has(c: Column, parts: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for p in parts:
        out = out | c.contains(p)
    return out


def find_emails(text: Column) -> Column:
    """Emails of a text: matched, lowered, not blocked, clean, each once in order."""
    found = F.transform(F.regexp_extract_all(text, F.lit(EMAIL), F.lit(0)), lambda e: F.lower(F.trim(e)))
    return F.array_distinct(F.filter(found, lambda e: ~blocked_email(e) & clean_email(e)))


def shielded_emails(html: Column) -> Column:
    """Emails that a page hides from robots: hex digits, the first byte is the key of the others."""
    found = F.regexp_extract_all(html, F.lit(r"""(?i)(?:data-cfemail\s*=\s*["']?|/cdn-cgi/l/email-protection#)((?:[0-9a-f]{2}){4,})"""), F.lit(1))
    return F.transform(found, lambda h: F.array_join(F.transform(F.sequence(F.lit(3), F.length(h), F.lit(2)), lambda i: F.char(_byte(h, i).bitwiseXOR(_byte(h, F.lit(1))))), ""))


def _byte(digits: Column, at: Column) -> Column:
    return F.conv(F.substring(digits, at, 2), 16, 10).cast("int")


def page_emails(html: Column) -> Column:
    """Emails of a page, shielded ones first: lowered, not blocked, clean, each once in order."""
    hidden = F.transform(shielded_emails(html), lambda e: F.lower(F.trim(e)))
    good = F.filter(hidden, lambda e: e.rlike(f"^(?:{EMAIL})$") & ~blocked_email(e) & clean_email(e))
    return F.array_distinct(F.concat(good, find_emails(html)))


def page_phones(html: Column) -> Column:
    """Phones of a page: of tel: links, then of its text; each once in order."""
    links = F.regexp_extract_all(html, F.lit(r"""(?i)href\s*=\s*["']?tel:([^"'>]+)"""), F.lit(1))
    own = F.filter(F.transform(links, lambda t: normal_phone(F.trim(F.replace(t, F.lit("%20"), F.lit(" "))))), lambda p: F.length(p).between(10, 15))
    return F.array_distinct(F.concat(own, find_phones(html)))


def blocked_email(email: Column) -> Column:
    low = F.lower(email)
    return _has(low, dims.BLOCKED_EMAIL_PARTS) | _in(F.regexp_extract(low, r"@([^@]*)$", 1), dims.BLOCKED_EMAIL_DOMAINS)


def clean_email(email: Column) -> Column:
    """No concatenated text, unknown top-level domain or tracking id."""
    local, host = F.regexp_extract(email, r"(?s)^(.+)@[^@]*$", 1), F.regexp_extract(email, r"@([^@]*)$", 1)
    hexes = F.length(F.regexp_replace(local, "[^0-9a-f]", ""))
    tracking = (hexes > 20) & (hexes > F.octet_length(local) * F.lit(0.8))
    return (local != "") & (F.octet_length(local) <= 40) & host.contains(".") & _in(F.lower(F.regexp_extract(host, r"\.([^.]*)$", 1)), dims.TLDS) & ~tracking


def filter_emails(emails: Column) -> Column:
    """Without placeholders; each once in order."""
    local = lambda e: F.regexp_extract(e, r"(?s)^([^@]*)@", 1)
    host = lambda e: F.regexp_extract(e, r"(?s)^[^@]*@(.*)$", 1)
    good = lambda e: e.contains("@") & (F.octet_length(local(e)) <= 64) & ~_in(local(e), dims.PLACEHOLDER_LOCALS) & ~_has(local(e), dims.PLACEHOLDER_LOCAL_PARTS) & ~_in(host(e), dims.PLACEHOLDER_DOMAINS)
    return F.array_distinct(F.filter(F.transform(emails, lambda e: F.trim(F.lower(e))), good))


def normal_phone(phone: Column) -> Column:
    digits = F.regexp_replace(phone, "[^0-9]", "")
    return F.when(F.startswith(phone, F.lit("+")), F.concat(F.lit("+"), digits)).otherwise(digits)


def find_phones(text: Column) -> Column:
    found = F.transform(F.regexp_extract_all(text, F.lit(PHONE), F.lit(0)), normal_phone)
    return F.array_distinct(F.filter(found, lambda p: F.length(p).between(10, 15)))


def filter_phones(phones: Column) -> Column:
    """International (+) or national (0) numbers of 10 to 15 digits; each once in order."""
    clean = F.transform(phones, lambda p: normal_phone(F.trim(p)))
    return F.array_distinct(F.filter(clean, lambda p: F.length(F.regexp_replace(p, "[^0-9]", "")).between(10, 15) & p.rlike("^[+0]")))


def handle(html: Column, network: str) -> Column:
    """The first handle of a network; '' if that is a widget's."""
    h = F.regexp_extract(html, dims.SOCIAL[network], 1)
    return F.when(_in(F.lower(h), dims.SOCIAL_NOISE), F.lit("")).otherwise(h)


def whatsapp(html: Column) -> Column:
    return F.regexp_extract(html, dims.WHATSAPP, 1)


def social_url(html: Column, network: str) -> Column:
    h = handle(html, network)
    bases = {"instagram": "https://instagram.com/", "facebook": "https://facebook.com/", "twitter": "https://twitter.com/", "linkedin": "https://linkedin.com/company/", "tiktok": "https://tiktok.com/@"}
    if network == "youtube":
        whole = F.regexp_extract(html, dims.SOCIAL["youtube"], 0)
        base = F.when(whole.contains("/channel/"), F.lit("https://youtube.com/channel/")).when(whole.contains("/user/"), F.lit("https://youtube.com/user/")).otherwise(F.lit("https://youtube.com/@"))
        return F.when(h == "", h).otherwise(F.concat(base, h))
    if network == "telegram":
        return h
    return F.when(h == "", h).otherwise(F.concat(F.lit(bases[network]), h))


def social_links(html: Column) -> Column:
    """Map of the networks that have a link."""
    pairs = [x for n in ("instagram", "facebook", "twitter", "linkedin") for x in (F.lit(n), social_url(html, n))]
    return F.map_filter(F.create_map(*pairs, F.lit("whatsapp"), whatsapp(html)), lambda k, v: v != "")


def drop_keys(links: Column, keys: tuple[str, ...]) -> Column:
    return F.map_filter(links, lambda k, v: ~k.isin(*keys))


def json_ld(html: Column) -> Column:
    """Parsed structured-data objects of a page."""
    raw = F.regexp_extract_all(html, F.lit(r"""(?is)<script[^>]*type\s*=\s*["']?application/ld\+json["']?[^>]*>(.*?)</script>"""), F.lit(1))
    return F.filter(F.transform(raw, lambda x: F.try_parse_json(x)), lambda v: v.isNotNull())


def _first(objects: Column, path: str) -> Column:
    """The first non-empty string at a path."""
    return F.coalesce(F.get(F.filter(F.transform(objects, lambda v: F.try_variant_get(v, path, "string")), lambda x: x.isNotNull() & (x != "") & ~x.rlike(r"^\s*[{\[]")), F.lit(0)), F.lit(""))


def _joined(objects: Column, path: str, separator: str) -> Column:
    """The first array of strings at a path, joined; or a plain string."""
    lists = F.filter(F.transform(objects, lambda v: F.array_join(F.try_variant_get(v, path, "array<string>"), separator)), lambda x: x.isNotNull() & (x != ""))
    return F.coalesce(F.get(lists, F.lit(0)), F.lit(""))


def ld_address(objects: Column) -> Column:
    parts = [F.nullif(_first(objects, f"$.address.{k}"), F.lit("")) for k in ("streetAddress", "addressLocality", "addressRegion", "postalCode", "addressCountry")]
    joined = F.concat_ws(", ", *parts)
    bare = _first(objects, "$.address")
    return F.when(joined != "", joined).when(F.octet_length(bare) > 10, bare).otherwise(F.lit(""))


def ld_business(objects: Column) -> dict[str, Column]:
    """Fields of structured data, '' where there is none."""
    person = F.lit("")
    for role in ("contactPoint", "director", "employee", "founder", "author"):
        here = F.coalesce(*[F.nullif(_first(objects, p), F.lit("")) for p in (f"$.{role}.name", f"$.{role}[0].name", f"$.{role}")])
        person = F.coalesce(here, person)
    kind = _first(objects, "$['@type']")
    hours, hour_list = _first(objects, "$.openingHours"), _joined(objects, "$.openingHours", ", ")
    value, count = _first(objects, "$.aggregateRating.ratingValue"), _first(objects, "$.aggregateRating.reviewCount")
    lat, lng = _first(objects, "$.geo.latitude"), _first(objects, "$.geo.longitude")
    place = F.concat_ws(", ", *[F.nullif(_first(objects, f"$.address.{k}"), F.lit("")) for k in ("addressLocality", "addressRegion", "addressCountry")])
    return {
        "name": _first(objects, "$.name"),
        "contact": person,
        "category": F.when(_in(kind, dims.GENERIC_TYPES), F.lit("")).otherwise(kind),
        "description": F.substring(_first(objects, "$.description"), 1, 500),
        "hours": F.when(hour_list != "", hour_list).otherwise(hours),
        "rating": F.when((value != "") & (count != ""), F.concat(value, F.lit(" ("), count, F.lit(" reviews)"))).otherwise(value),
        "email": F.lower(_first(objects, "$.email")),
        "phone": normal_phone(_first(objects, "$.telephone")),
        "address": ld_address(objects),
        "city": _first(objects, "$.address.addressLocality"),
        "country": F.coalesce(F.nullif(_first(objects, "$.address.addressCountry.name"), F.lit("")), _first(objects, "$.address.addressCountry")),
        "location": F.when((lat != "") & (lng != ""), F.concat(lat, F.lit(", "), lng)).otherwise(place),
    }


def country_codes(spark) -> tuple[str, ...]:
    """ISO 3166-1 alpha-2 codes, as the platform knows them."""
    return tuple(sorted(spark.sparkContext._jvm.java.util.Locale.getISOCountries()))


def normal_country(raw: Column, codes: tuple[str, ...]) -> Column:
    """Alpha-2 code of a name or code; '' if unknown or a state's code."""
    low, up = F.lower(F.trim(raw)), F.upper(F.trim(raw))
    names = F.create_map(*[F.lit(x) for pair in dims.COUNTRY_NAMES.items() for x in pair])
    three = F.create_map(*[F.lit(x) for pair in dims.ALPHA3.items() for x in pair])
    two = F.when(F.length(up).eqNullSafe(2) & ~_in(up, dims.STATE_CODES) & _in(up, codes), up)
    return F.coalesce(F.try_element_at(names, low), two, F.try_element_at(three, up), F.lit(""))


def country_tail(address: Column) -> Column:
    """A country's name or code, in capitals, as the last word of an address, unless it is a state's code; ''. A code is a word of its own."""
    names = "|".join(dims.ADDRESS_COUNTRIES)
    tail = F.upper(F.regexp_extract(address, rf"(?i)(?<![\p{{L}}])({names}|[A-Z]{{2,3}})\s*$", 1))
    return F.when(_in(tail, dims.REGION_CODES), F.lit("")).otherwise(tail)


def folded_country(country: Column) -> Column:
    """A name that is known as its code; anything else, and what has two letters or less, as it is."""
    names = F.create_map(*[F.lit(x) for pair in dims.COUNTRY_NAMES.items() for x in pair])
    return F.when(F.length(country) > 2, F.coalesce(F.try_element_at(names, F.lower(F.trim(country))), country)).otherwise(country)


def city_part(address: Column) -> Column:
    """The last part but one of an address of three or more; ''."""
    parts = F.split(address, ",")
    return F.when(F.size(parts) >= 3, F.btrim(F.get(parts, F.size(parts) - 2), F.lit(" ,"))).otherwise(F.lit(""))


def page_title(html: Column) -> Column:
    return F.trim(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1))


def hrefs(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit(r"""(?i)<a\s[^>]*?href\s*=\s*["']([^"']+)["']"""), F.lit(1))


def robot_page(html: Column, engine: str) -> Column:
    return _has(F.lower(html), dims.BLOCK_MARKS[engine])


def permanent_error(message: Column) -> Column:
    return _has(F.lower(message), tuple(p.lower() for p in dims.PERMANENT_ERRORS))


def mask_email(email: Column) -> Column:
    """For samples and logs."""
    return F.regexp_replace(email, r"^(.).*(@.*)$", "$1***$2")


def csv_escape(text: Column) -> Column:
    return F.when(text.rlike("[,\"\n]"), F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(text)


def delta_text(now: Column, before: Column) -> Column:
    percent = F.try_divide((now - before).cast("double"), before.cast("double")) * 100
    return F.when((before == 0) & (now > 0), F.lit("(new)")).when(before == 0, F.lit("")).when(percent > 0, F.format_string("(+%.0f%%)", percent)).when(percent < 0, F.format_string("(%.0f%%)", percent)).otherwise(F.lit("(=)"))


def short_count(n: Column) -> Column:
    return (
        F.when(n >= 1_000_000, F.format_string("%.1fM", n / 1_000_000))
        .when(n >= 10_000, F.concat(F.floor(n / 1000).cast("string"), F.lit("K")))
        .when(n >= 1_000, F.format_string("%.1fK", n / 1000))
        .otherwise(n.cast("string"))
    )


def bar(value: Column, most: Column, width: int = 8) -> Column:
    filled = F.greatest(F.lit(0), F.least(F.lit(width), F.floor(F.try_divide(value * width, most)).cast("int")))
    return F.when(most == 0, F.lit("")).otherwise(F.concat(F.repeat(F.lit("█"), filled), F.repeat(F.lit("░"), F.lit(width) - filled)))


def score(f: dict[str, Column]) -> Column:
    """Deliverability from validation flags, 0 to 1."""
    dead = (f["reachable"] == "invalid") | ~f["syntax"] | f["honeypot"] | f["disabled"]
    points = lambda c, p: F.when(c, F.lit(p)).otherwise(F.lit(0.0))
    total = F.lit(0.05) + points(f["mx"], 0.25) + points(f["deliverable"], 0.35) + points(~f["disposable"], 0.15) + points(~f["role"], 0.10) + points(~f["catch_all"], 0.10)
    return F.when(dead, F.lit(0.0)).otherwise(F.round(total, 2))


def good_email(f: dict[str, Column]) -> Column:
    return (f["reachable"] != "invalid") & f["syntax"] & f["mx"] & ~f["disposable"] & ~f["honeypot"] & ~f["disabled"]


def completeness(email: Column, phone: Column, named: Column, placed: Column, social: Column) -> Column:
    points = lambda c, p: F.when(c, F.lit(p)).otherwise(F.lit(0))
    return points(email, 40) + points(phone, 20) + points(named, 15) + points(placed, 15) + points(social, 10)
