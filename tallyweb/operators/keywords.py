"""Keyword generation."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweb import dims
from tallyweb.functions.urls import hash_text, search_url
from tallyweb.operators.dedup import first_wins

# ---- Fixed values ----
#: Operators put behind "<niche> <city>".
OPERATORS = ('contact', 'email', '"@gmail.com"', '"@yahoo.com"', '"@hotmail.com"', '"@outlook.com"', '"@icloud.com"', '"@aol.com"', '"@protonmail.com"')


def distinct_keywords(df: DataFrame, text: str = "keyword") -> DataFrame:
    """Trimmed, not empty, each once whatever its case."""
    own = df.select(F.trim(text).alias("keyword")).where("keyword <> ''")
    return first_wins(own, F.lower("keyword"), "keyword")


def cartesian(niches: DataFrame, cities: DataFrame, operators: tuple[str, ...] = OPERATORS) -> DataFrame:
    """niche x city x operator, lowered, each once. The dimensions are small by nature (hundreds of rows)."""
    each = niches.select(F.col(niches.columns[0]).alias("_n")).crossJoin(cities.select(F.col(cities.columns[0]).alias("_c")))
    made = each.select(F.explode(F.transform(F.array(*[F.lit(o) for o in operators]), lambda o: F.lower(F.concat_ws(" ", "_n", "_c", o)))).alias("keyword"))
    return made.distinct()


def expand_template(spark, pattern: str, variables: dict[str, list[str]]) -> DataFrame:
    """A pattern with {names}, once for each combination of the values of the names that occur in it."""
    names = [n for n in dict.fromkeys(re.findall(r"\{(\w+)\}", pattern)) if n in variables]
    text, df = F.lit(pattern), spark.range(1)
    for n in names:
        df = df.crossJoin(spark.createDataFrame([(v,) for v in variables[n]], f"`{n}` string"))
        text = F.replace(text, F.lit("{" + n + "}"), F.col(n))
    return distinct_keywords(df.select(text.alias("keyword")))


def fan_out(queries: DataFrame, engines: dict[str, int] = dims.ENGINE_PAGES, per_page: int = 100, gl: str = "us", hl: str = "en") -> DataFrame:
    """A job for each query, engine and page. queries: (query_text, country)."""
    locales = queries.sparkSession.createDataFrame([(c, x[0], x[1]) for c, x in dims.LOCALES.items()], "country string, gl string, hl string")
    own = queries.join(F.broadcast(locales), "country", "left").withColumns({"gl": F.coalesce("gl", F.lit(gl)), "hl": F.coalesce("hl", F.lit(hl))})
    jobs = F.flatten(F.array(*[F.array(*[F.struct(F.lit(e).alias("engine"), F.lit(p).alias("page")) for p in range(n)]) for e, n in engines.items()]))
    out = own.select("query_text", "gl", "hl", F.explode(jobs).alias("j")).select("query_text", "gl", "hl", "j.engine", "j.page")
    return out.select(
        F.concat("engine", F.lit("-"), "query_text", F.lit("-p"), F.col("page").cast("string")).alias("job_id"), "query_text", "engine", "page", search_url(F.col("engine"), F.col("query_text"), F.col("page"), per_page, F.col("gl"), F.col("hl")).alias("search_url")
    )


def expand_queries(done: DataFrame, known: DataFrame, n: int, suffixes: tuple[str, ...], *order: str) -> DataFrame:
    """Variants of the first n completed queries (query_text) that aren't known (text_hash) yet."""
    first = done.orderBy(*order).limit(n)
    variants = first.select(F.explode(F.transform(F.array(*[F.lit(s) for s in suffixes]), lambda s: F.concat_ws(" ", "query_text", s))).alias("query_text"))
    hashed = variants.withColumn("text_hash", hash_text(F.col("query_text"))).dropDuplicates(["text_hash"])
    return hashed.join(known.select("text_hash"), "text_hash", "left_anti")


def compose(niches: DataFrame, people: DataFrame, cities: DataFrame, sites: tuple[str, ...], country: str | None = None) -> DataFrame:
    """Business, personal and site keywords of all cities, or of a country's; an unknown country is an error.

    cities: (city, country); sites: patterns with two %s, for a niche and a city.
    """
    own = cities if country is None else cities.where(F.lower("country") == country.lower())
    if country is not None and own.isEmpty():
        raise ValueError(f"no cities of {country}")
    towns = own.select("city").distinct()
    site = lambda df: df.select(F.col(df.columns[0]).alias("_n")).crossJoin(towns).select(F.explode(F.array(*[F.lower(F.format_string(s, "_n", "city")) for s in sites])).alias("keyword"))
    parts = [cartesian(niches, towns), cartesian(people, towns), site(niches), site(people)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return distinct_keywords(out)


def dimension(spark, name: str, values: tuple[str, ...]) -> DataFrame:
    """A small table of one column."""
    return spark.createDataFrame([(v,) for v in values], f"{name} string")


def all_keywords(spark, cities: DataFrame, country: str | None = None) -> DataFrame:
    """Business, personal and site keywords of all cities (city, country), or of a country's."""
    return compose(dimension(spark, "niche", dims.NICHES), dimension(spark, "niche", dims.PERSONAL_NICHES), cities, dims.SITE_TEMPLATES, country)


def business_keywords(spark, cities: DataFrame, country: str = "all", niche: str = "all") -> DataFrame:
    """Business keywords only: of one niche or all, in the cities of a country or all; an unknown country is an error."""
    own = cities if country.lower() == "all" else cities.where(F.col("country") == country)
    if country.lower() != "all" and own.isEmpty():
        raise ValueError(f"no cities of {country}")
    niches = dims.NICHES if niche.lower() in ("", "all") else (niche,)
    return cartesian(dimension(spark, "niche", niches), own.select("city").distinct())


def enabled_engines(wanted: str, engines: dict[str, int] = dims.ENGINE_PAGES) -> dict[str, int]:
    """Engines of a comma-separated list; all of them for "all" or a list of none that is known."""
    names = [n.strip().lower() for n in wanted.split(",")]
    return {n: engines[n] for n in names if n in engines} or dict(engines)
