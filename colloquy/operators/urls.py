"""Candidate lists: reading order, fallbacks, set operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCKS = 64


def watch_url(url: Column, vid: Column, prefix: str) -> Column:
    """The url, else the prefix with the id; null where both are missing or empty."""
    filled = F.nullif(vid, F.lit(""))
    return F.when(filled.isNotNull(), F.coalesce(F.nullif(url, F.lit("")), F.concat(F.lit(prefix), filled)))


def dedupe_ordered(df: DataFrame, key: str = "url", pos: str = "pos") -> DataFrame:
    """(key, pos): each key at its first position; a minimum, combined before the shuffle."""
    return df.groupBy(key).agg(F.min(pos).alias(pos))


def union_distinct(*lists: DataFrame) -> DataFrame:
    out = lists[0].select("url")
    for other in lists[1:]:
        out = out.union(other.select("url"))
    return out.distinct()


def new_urls(found: DataFrame, known: DataFrame) -> DataFrame:
    return found.select("url").subtract(known.select("url"))


def query_matrix(languages: DataFrame, phrases: DataFrame) -> DataFrame:
    """(language, phrase): every different phrase in every language. The product is the result asked for; it is made by an equi-join on
    blocks of phrases, each met by every language, so that it is spread over tasks and nothing is gathered."""
    blocks = languages.select("language", F.explode(F.sequence(F.lit(0), F.lit(BLOCKS - 1))).alias("block"))
    return phrases.select("phrase", F.pmod(F.xxhash64("phrase"), F.lit(BLOCKS)).cast("int").alias("block")).distinct().join(blocks, "block").select("language", "phrase")


def candidate_sources(query: str | None, sources: list[str], limit: int, cc_only: bool = False) -> list[str]:
    """Search addresses: the query (or its open-license search), then the sources as given."""
    from urllib.parse import quote_plus

    own = []
    if query:
        own = [f"search-cc:{quote_plus(query)}"] if cc_only else [f"search{limit}:{query}"]
    return own + list(sources)
