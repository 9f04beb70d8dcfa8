"""Problem 7: mixing sources to target weights by Poisson replication.

Sizes are tokens of a public tokenizer. A source's target rate is its share of the total divided by its own size; the number
of uses of a document is drawn by inverting a Poisson distribution at a uniform number hashed from (seed, document). Uses above
the source's max_repeats count as max_repeats, so the Poisson mean is chosen such that the mean after this cut equals the rate.
A source whose rate reaches max_repeats gives all its documents max_repeats times; the share it can't give goes to the other
sources in proportion to their weights (`shortfall="rescale"`, keeping the total), or to none (`"leave"`, keeping the weights).
The copies are shuffled globally by a hash of (seed, document, copy).

Sources are a table like any other: their number has no bound, the level that fills them up is found by grouped sums, and
documents meet their source's plan in a join that may be split where one source holds a third of all rows. A distribution is
tabulated only where it has weight, within some standard deviations of its mean, so neither rates nor max_repeats have a bound.

Defined results: documents of a null or unlisted source count in the corpus' size but are not used; null and empty texts have
0 tokens and may be used; a source without documents gives 0; repeated doc_ids are drawn alike; null max_repeats means 1; null
weight means 0; an empty corpus gives no rows. Only sums over all sources reach the driver.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..runtime import cut
from .tokens import BYTE_BPE, FOLDER, count_tokens

DEVIATIONS, MARGIN = 12, 40


@lru_cache(maxsize=256)
def poisson_table(mean: float) -> tuple[int, np.ndarray]:
    """(first, cumulative): P(X <= first + i) over the numbers that have weight; by logarithms, as exp(-mean) may be 0."""
    spread = DEVIATIONS * math.sqrt(mean) + MARGIN
    first, last = max(0, math.floor(mean - spread)), math.ceil(mean + spread)
    k = np.arange(first + 1, last + 1, dtype=np.float64)
    start = first * math.log(mean) - mean - math.lgamma(first + 1)
    return first, np.minimum(np.cumsum(np.exp(np.concatenate([[start], start + np.cumsum(math.log(mean) - np.log(k))]))), 1.0)


def cut_mean(mean: float, most: int) -> float:
    """The mean of min(X, most): the sum of P(X > k) for k below most."""
    if mean <= 0:
        return 0.0
    first, below = poisson_table(mean)
    return most if first >= most else first + float((1 - below[: most - first]).sum())


def mean_for_rate(rate: float, most: int) -> float:
    """The Poisson mean whose draws, cut at most, have the given mean; inf where rate reaches most."""
    if rate <= 0:
        return 0.0
    if rate >= most:
        return math.inf
    lo, hi = 0.0, 1.0
    while cut_mean(hi, most) < rate:
        hi *= 2
    while lo < (mid := (lo + hi) / 2) < hi and hi - lo > 1e-12 * hi:
        lo, hi = (mid, hi) if cut_mean(mid, most) < rate else (lo, mid)
    return hi


def draw(u: np.ndarray, mean: float, most: int) -> np.ndarray:
    """min(X, most) of the inverse distribution at u."""
    if math.isinf(mean):
        return np.full(len(u), most, np.int64)
    if mean <= 0:
        return np.zeros(len(u), np.int64)
    first, below = poisson_table(mean)
    return np.minimum(first + np.searchsorted(below, u), most)


@F.pandas_udf(T.DoubleType())
def _mean(rate: pd.Series, most: pd.Series) -> pd.Series:
    return pd.Series([mean_for_rate(r, m) for r, m in zip(rate, most, strict=True)], dtype="float64")


@F.pandas_udf(T.LongType())
def _repeats(u: pd.Series, mean: pd.Series, most: pd.Series) -> pd.Series:
    out = np.zeros(len(u), np.int64)
    for (m, k), at in u.groupby([mean, most]).indices.items():
        out[at] = draw(u.to_numpy()[at], float(m), int(k))
    return pd.Series(out)


def fill(sources: DataFrame, total: float, shortfall: str = "rescale") -> DataFrame:
    """Adds want (tokens to give) to (source, weight, most, tokens): weight * level, at most `most * tokens`.

    The level at which the wants make the total is found from below by Newton's steps, each one grouped sum over the sources;
    a step takes the sources that are full by then at their bound, so there are never more steps than sources, and few in practice.
    """
    bound = F.col("most") * F.col("tokens")
    live = F.when(bound > 0, F.col("weight")).otherwise(0.0)
    weights = sources.agg(F.sum(live).alias("live"), F.sum("weight").alias("all")).first()
    level, full = total / ((weights.live if shortfall == "rescale" else weights["all"]) or 1.0), -1
    while shortfall == "rescale":
        filled = (live > 0) & (live * F.lit(level) >= bound)
        got = sources.agg(F.count_if(filled).alias("n"), F.sum(F.when(filled, bound).otherwise(0)).alias("given"), F.sum(F.when(filled, 0.0).otherwise(live)).alias("open")).first()
        if got.n == full or not got.open:
            break
        level, full = max(level, (total - got.given) / got.open), got.n
    return sources.withColumn("want", F.least(live * F.lit(level), bound.cast("double")))


def _uniform(seed: int, *cols: str | Column) -> Column:
    return (F.shiftrightunsigned(F.xxhash64(F.lit(seed), *cols), 11).cast("double") + 0.5) / float(1 << 53)


def mix(documents: DataFrame, targets: DataFrame, seed: int = 0, shortfall: str = "rescale", name: str = BYTE_BPE, folder: str = FOLDER) -> tuple[DataFrame, DataFrame]:
    """(doc_id, source, tokens, repeats) of all listed documents, and each source's target and actual share."""
    sized = cut(count_tokens(documents, "doc_id", "source", name=name, folder=folder))
    wanted = targets.where("source is not null").groupBy("source").agg(F.max(F.coalesce("weight", F.lit(0.0))).alias("weight"), F.max(F.coalesce(F.col("max_repeats").cast("long"), F.lit(1))).alias("most"))
    sums = sized.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("documents"))
    nothing = F.lit(0).cast("long")
    sources = cut(wanted.join(sums, "source", "left").select("source", "weight", "most", F.coalesce("documents", nothing).alias("documents"), F.coalesce("tokens", nothing).alias("tokens")))
    total = sized.agg(F.coalesce(F.sum("tokens"), nothing).alias("t")).first().t
    planned = fill(sources, float(total), shortfall).withColumn("rate", F.coalesce(F.try_divide("want", "tokens"), F.lit(0.0)))
    table = cut(planned.withColumn("mean", _mean("rate", "most")))
    drawn = sized.join(table.select("source", "mean", "most"), "source").withColumn("u", _uniform(seed, "doc_id"))
    used = cut(drawn.select("doc_id", "source", "tokens", _repeats("u", "mean", "most").cast("int").alias("repeats")))
    given = used.groupBy("source").agg(F.sum(F.col("tokens") * F.col("repeats")).alias("given"), F.sum("repeats").alias("uses"))
    got = given.agg(F.coalesce(F.sum("given"), nothing).alias("got")).first().got
    share = lambda c, of: F.try_divide(c.cast("double"), F.lit(float(of)))
    tokens_given = F.coalesce("given", nothing)
    shares = table.join(given, "source", "left").select(
        "source", F.col("weight").alias("target_share"), F.coalesce(share(F.col("want"), total), F.lit(0.0)).alias("planned_share"), share(tokens_given, got).alias("actual_share"), F.col("most").alias("max_repeats"),
        "rate", "documents", "tokens", tokens_given.alias("tokens_given"), F.coalesce("uses", nothing).alias("uses"), F.lit(total).cast("long").alias("corpus_tokens"),
    )
    return used, shares


def shuffled_copies(used: DataFrame, seed: int = 0) -> DataFrame:
    """(place, doc_id, source, copy): each use of a document, in a global order that is random by hash."""
    copies = used.where("repeats > 0").select("doc_id", "source", F.explode(F.sequence(F.lit(1), F.col("repeats"))).alias("copy"))
    return copies.select(F.xxhash64(F.lit(seed + 1), "doc_id", "copy").alias("place"), "doc_id", "source", "copy").orderBy("place", "doc_id", "copy")
