"""Exports: CSV and JSON files, CSV lines, a dump of dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweb.functions.contacts import csv_escape
from tallyweb.operators.dedup import first_wins

# ---- Fixed values: exported columns by kind of export ----
COLUMNS = {
    "cli": ("emails", "phone", "domain", "url", "social_links", "address"),
    "v1": ("business_name", "category", "website", "emails", "domain", "social_links", "address", "location", "phone"),
    "v2": ("id", "business_name", "category", "domain", "website", "address", "location", "phone", "emails", "email_count", "valid_email_count", "created_at"),
    "chat": ("emails", "phone", "domain", "url", "business_name", "category", "page_title", "website", "address", "location", "opening_hours", "rating", "social_links"),
    "standalone": ("email", "email_status", "phone", "domain", "source_url", "business_name", "business_category", "description", "location", "address", "instagram", "facebook", "twitter", "linkedin", "whatsapp", "opening_hours", "rating"),
}
VALID = ("valid", "pending", "unknown")


def provider_filter(provider: str) -> str | None:
    """A provider as it may be filtered by; anything but lower letters, digits and dots is no filter."""
    return provider if provider and all(c.isascii() and (c.islower() or c.isdigit() or c == ".") for c in provider) else None


def exportable(listings: DataFrame, links: DataFrame, key: str, email: str, status: str) -> DataFrame:
    """Listings with an email that may be valid, and those emails, sorted and joined."""
    good = links.where(F.col(status).isin(*VALID)).groupBy(key).agg(F.array_join(F.array_sort(F.collect_set(email)), ";").alias("emails"))
    return listings.join(good, key)


def projected(df: DataFrame, kind: str) -> DataFrame:
    """The columns of a kind of export, as text, empty where there is nothing; maps as JSON."""
    out = []
    for c in COLUMNS[kind]:
        if c not in df.columns:
            out.append(F.lit("").alias(c))
        elif df.schema[c].dataType.typeName() == "map":
            out.append(F.coalesce(F.to_json(F.map_from_entries(F.array_sort(F.map_entries(c)))), F.lit("{}")).alias(c))
        else:
            out.append(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c))
    return df.select(*out)


def cli_export(listings: DataFrame, links: DataFrame, key: str = "id", email: str = "email", status: str = "validation_status") -> DataFrame:
    """Listings with an email that may be valid, by id."""
    return projected(exportable(listings, links, key, email, status).orderBy(key), "cli")


def v1_export(listings: DataFrame, links: DataFrame, key: str = "id", email: str = "email", status: str = "validation_status", provider: str = "") -> DataFrame:
    """All listings, or those with an email of a provider, with their emails that may be valid, by id."""
    name = provider_filter(provider)
    chosen = listings if name is None else listings.join(links.where(F.endswith(email, F.lit("@" + name))), key, "left_semi")
    good = links.where(F.col(status).isin(*VALID)).groupBy(key).agg(F.array_join(F.array_sort(F.collect_set(email)), ";").alias("emails"))
    return projected(chosen.join(good, key, "left").orderBy(key), "v1")


def v2_export(listings: DataFrame, links: DataFrame, key: str = "id", email: str = "email", status: str = "validation_status") -> DataFrame:
    """listings (as filtered by the caller), with all their emails, how many, and how many are valid, by id."""
    mails = links.groupBy(key).agg(F.array_join(F.array_sort(F.collect_list(email)), ";").alias("emails"), F.count("*").alias("email_count"), F.count_if(F.col(status) == "valid").alias("valid_email_count"))
    out = listings.join(mails, key, "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("email_count", "valid_email_count")})
    return projected(out.withColumn("id", F.col(key)).orderBy(key), "v2")


#: Filters of the chat export that mean an email domain.
PROVIDER_WORDS = {"gmail": "gmail.com", "yahoo": "yahoo.com", "hotmail": "hotmail.com", "outlook": "outlook.com"}


def chat_export(listings: DataFrame, links: DataFrame, key: str = "id", email: str = "email", word: str = "", n: int = 50_000) -> DataFrame:
    """Newest listings with an email: those with one of a provider, or that name the word in location, address or category; with all their emails."""
    domain = PROVIDER_WORDS.get(word.lower())
    mails = links.groupBy(key).agg(F.array_join(F.array_sort(F.collect_set(email)), ";").alias("emails"))
    out = listings.join(mails, key)
    if domain is not None:
        out = out.join(links.where(F.split_part(email, F.lit("@"), F.lit(2)) == domain), key, "left_semi")
    elif word:
        out = out.where(F.col("location").ilike(f"%{word}%") | F.col("address").ilike(f"%{word}%") | F.col("category").ilike(f"%{word}%"))
    return projected(out.orderBy(F.desc("created_at"), key).limit(n), "chat")


def standalone_export(jobs: DataFrame, status: Column | None = None) -> DataFrame:
    """A line for each email of completed jobs, once for each (email, domain), the first by time, url and place; status: the email's, from a column email."""
    done = jobs.where("status = 'completed'")
    each = done.select("*", F.posexplode("raw_emails").alias("_i", "_mail")).withColumn("email", F.lower("_mail"))
    once = first_wins(each, F.struct("email", "domain"), "completed_at", "url", "_i")
    texts = {"business_name": "raw_business_name", "business_category": "raw_category", "description": "raw_description", "location": "raw_location", "address": "raw_address", "opening_hours": "raw_opening_hours", "rating": "raw_rating"}
    links = {n: F.try_element_at("raw_social", F.lit(n)) for n in ("instagram", "facebook", "twitter", "linkedin", "whatsapp")}
    out = once.withColumns({**{k: F.col(v) for k, v in texts.items()}, **links, "email_status": F.lit("") if status is None else status, "phone": F.get("raw_phones", F.lit(0)), "source_url": F.col("url")})
    return projected(out, "standalone")


def csv_line(*columns: Column) -> Column:
    return F.concat_ws(",", *[csv_escape(F.coalesce(c.cast("string"), F.lit(""))) for c in columns])


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True, quote='"', escape='"')


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def dump_dimensions(cities: DataFrame, niches: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(city, country), the first country by name, and (niche, word_count)."""
    lowered = cities.select(F.lower("city").alias("city"), F.lower("country").alias("country"))
    words = niches.select("niche", F.size(F.split(F.trim("niche"), r"\s+")).alias("word_count"))
    return first_wins(lowered, "city", "country"), words
