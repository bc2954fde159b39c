"""Keyword files, templates and configuration."""

from __future__ import annotations

import os
import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweb.operators.dedup import first_wins

# ---- Fixed values ----
#: Column names that hold the keyword, and first cells that look like a header.
KEYWORD_COLUMNS = ("keyword", "query", "search", "q")
HEADER_CELLS = ("keyword", "query", "search", "q", "term", "text", "name", "id", "no", "number", "index")


def _first_line(spark: SparkSession, path: str) -> str:
    row = spark.read.text(path).limit(1).first()
    return row[0] if row else ""


def read_keyword_csv(spark: SparkSession, path: str, width: int = 64) -> DataFrame:
    """Keywords of a CSV file, ragged rows allowed: the column a header names, else the first; trimmed, each once.

    A first cell that looks like a header is no keyword, whatever column it names.
    """
    cells = [c.strip().strip('"').lower() for c in _first_line(spark, path).split(",")]
    at = next((k for k, c in enumerate(cells) if c in KEYWORD_COLUMNS), None)
    schema = ", ".join(f"c{k} string" for k in range(max(width, len(cells))))
    rows = spark.read.schema(schema).csv(path, ignoreLeadingWhiteSpace=True, mode="PERMISSIVE", header=at is not None or cells[0] in HEADER_CELLS)
    return _once(rows.select(F.col(f"c{at or 0}").alias("keyword")))


def read_keyword_text(spark: SparkSession, path: str) -> DataFrame:
    """A keyword per line; blank lines and comments don't count."""
    return _once(spark.read.text(path).select(F.col("value").alias("keyword")).where("NOT startswith(trim(keyword), '#')"))


def _once(df: DataFrame) -> DataFrame:
    # A line's place: its file, the block of the file it is read with, and its order there.
    place = F.struct(F.input_file_name(), F.input_file_block_start(), F.monotonically_increasing_id())
    own = df.select(F.trim("keyword").alias("keyword"), place.alias("_at")).where("keyword <> ''")
    return first_wins(own, F.lower("keyword"), "_at").select("keyword")


def read_keywords(spark: SparkSession, path: str) -> DataFrame:
    return read_keyword_csv(spark, path) if path.lower().endswith(".csv") else read_keyword_text(spark, path)


def read_template(path: str) -> dict:
    """A YAML template: name, pattern, variables."""
    import yaml

    with open(path, encoding="utf-8") as f:
        found = yaml.safe_load(f) or {}
    if not found.get("pattern"):
        raise ValueError("a template needs a pattern")
    return {"name": found.get("name", ""), "pattern": found["pattern"], "variables": {k: [str(x) for x in v] for k, v in (found.get("variables") or {}).items()}}


def expand_env(text: str, env: Mapping[str, str] | None = None) -> str:
    """${NAME} and ${NAME:-default}; an unset or empty variable takes the default."""
    env = os.environ if env is None else env
    return re.sub(r"\$\{(\w+)(?::-([^}]*))?\}", lambda m: env.get(m[1]) or m[2] or "", text)
