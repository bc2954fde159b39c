"""Filters, pages and rollups of listings with their emails."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_PER_PAGE, PER_PAGE, MOST_IDS, MOST_QUERIES = 200, 50, 1000, 500


def page_number(value: str | int | None, default: int) -> int:
    """A positive integer, else the default."""
    try:
        n = int(value)  # type: ignore[arg-type]
    except (TypeError, ValueError):
        return default
    return n if n >= 1 else default


def page(df: DataFrame, number: int, per_page: int, *order: Column | str) -> DataFrame:
    per_page = min(per_page if per_page >= 1 else PER_PAGE, MOST_PER_PAGE)
    return df.orderBy(*order).offset((max(number, 1) - 1) * per_page).limit(per_page)


def keyset_page(df: DataFrame, key: str, last: int, n: int) -> DataFrame:
    return df.where(F.col(key) > last).orderBy(key).limit(n)


def envelope(total: int, number: int, per_page: int) -> dict:
    """Meta of a page; a negative total is unknown."""
    known = total >= 0
    return {"page": number, "per_page": per_page, "total": max(total, 0), "total_pages": math.ceil(total / per_page) if known else 0, "total_known": known}


def filtered(df: DataFrame, *conditions: Column | None) -> DataFrame:
    """Rows that satisfy all conditions that are given."""
    given = [c for c in conditions if c is not None]
    return df.where(reduce(lambda a, b: a & b, given)) if given else df


def with_match(listings: DataFrame, links: DataFrame, key: str, condition: Column | None = None) -> DataFrame:
    """Listings that have a link (that satisfies a condition)."""
    return listings.join(links if condition is None else links.where(condition), key, "left_semi")


def results_filter(
    listings: DataFrame, links: DataFrame, key: str = "id", domain: str = "", has_email: bool = False, email: str = "", provider: str = "", status: str = "", search: str = ""
) -> DataFrame:
    """Listings that satisfy every filter that is given. links: (key, email, validation_status).

    Each filter on emails is a semi join of its own, so an email each may satisfy them. In the provider's name
    % and _ are wildcards.
    """
    out = filtered(listings, F.col("domain") == domain if domain else None, F.col("business_name").ilike(f"%{search}%") if search else None)
    if has_email:
        out = with_match(out, links.select(key), key)
    conditions = [(email, F.col("email") == email), (provider, F.col("email").like(f"%@{provider}")), (status, F.col("validation_status") == status)]
    for given, condition in conditions:
        if given:
            out = with_match(out, links.where(condition).select(key), key)
    return out


def in_list(df: DataFrame, column: str, values: list, most: int = 200) -> DataFrame:
    """Rows whose column is one of the values: a list where they are few, a semi join beyond."""
    if len(values) <= most:
        return df.where(F.col(column).isin(*values)) if values else df.limit(0)
    wanted = df.sparkSession.createDataFrame([(v,) for v in dict.fromkeys(values)], df.select(column).schema)
    return df.join(wanted, column, "left_semi")


def pending(df: DataFrame, n: int, status: str = "pending", key: str = "id") -> DataFrame:
    """The first n rows of a status."""
    return df.where(F.col("status") == status).orderBy(key).limit(n)


def newest_jobs(df: DataFrame, n: int = 50, at: str = "created_at", key: str = "id") -> DataFrame:
    """For a look at the latest jobs."""
    return df.orderBy(F.desc(at), key).limit(n)


def email_rollup(links: DataFrame, key: str, email: str, info: list[str], valid: Column) -> DataFrame:
    """Per listing: its emails sorted, with their info, how many, and how many are valid."""
    return links.groupBy(key).agg(F.array_sort(F.collect_list(F.col(email).cast("string"))).alias("emails"), F.array_sort(F.collect_list(F.struct(email, *info))).alias("emails_with_info"), F.count("*").alias("n_emails"), F.count_if(valid).alias("n_valid"))


def check_request(ids: list | None = None, domain: str | None = None, queries: list | None = None) -> None:
    """Limits of request bodies: ids or a domain, not both; so many at most."""
    if queries is not None and not 0 < len(queries) <= MOST_QUERIES:
        raise ValueError(f"1 to {MOST_QUERIES} queries")
    if queries is None and bool(ids) == bool(domain):
        raise ValueError("either ids or a domain")
    if ids and len(ids) > MOST_IDS:
        raise ValueError(f"{MOST_IDS} ids at most")
