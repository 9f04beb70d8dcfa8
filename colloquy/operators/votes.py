"""Votes over windows of a clip: majority, joint language vote, median count."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Thresholds
from .ordered import ratio


def majority(value: Column) -> Column:
    """Aggregate: the most frequent non-null value as text; ties go to the smallest."""
    return F.mode(value.cast("string"), deterministic=True)


def majority_true(value: Column) -> Column:
    return F.coalesce(F.lower(majority(value)) == "true", F.lit(False))


def language_vote(votes: DataFrame, min_agreement: float = Thresholds.min_agreement) -> DataFrame:
    """(clip_id, language_code, language, agreement, n_windows): the joint vote on (code, name), normalised.

    Most votes win, ties go to the pair seen first; missing values count as ''. Below min_agreement both are ''.
    """
    code = F.split_part(F.lower(F.trim(F.coalesce("language_code", F.lit("")))), F.lit("-"), F.lit(1))
    name = F.lower(F.trim(F.coalesce("language", F.lit(""))))
    pairs = votes.groupBy("clip_id", code.alias("code"), name.alias("name")).agg(F.count("*").alias("n"), F.min("win").alias("first"))
    won = pairs.groupBy("clip_id").agg(F.sum("n").alias("all"), F.max(F.struct(F.col("n"), (-F.col("first")).alias("early"), "code", "name")).alias("w"))
    sure = F.col("w.n") >= F.lit(min_agreement) * F.col("all")
    return won.select("clip_id", F.when(sure, F.col("w.code")).otherwise("").alias("language_code"), F.when(sure, F.col("w.name")).otherwise("").alias("language"), ratio(F.col("w.n"), F.col("all"), 2).alias("agreement"), F.col("all").alias("n_windows"))


def speaker_median(votes: DataFrame) -> DataFrame:
    """(clip_id, num_speakers): the median of the non-null counts, cut to a whole number; 0 where there is none."""
    return votes.groupBy("clip_id").agg(F.coalesce(F.percentile("num_speakers", 0.5).cast("int"), F.lit(0)).alias("num_speakers"))


def verdicts(votes: DataFrame, th: Thresholds = Thresholds()) -> DataFrame:
    """One verdict per clip with at least th.min_votes votes; other clips have none."""
    flags = [c for c in ("is_conversational", "has_turn_taking", "is_dubbed_or_voiceover", "music_dominant") if c in votes.columns]
    texts = [(c, d) for c, d in (("background_noise", "moderate"), ("confidence", "low")) if c in votes.columns]
    aggs = [majority_true(F.col(c)).alias(c) for c in flags] + [F.coalesce(majority(F.col(c)), F.lit(d)).alias(c) for c, d in texts]
    counts = votes.groupBy("clip_id").agg(F.count("*").alias("__n"), *aggs).where(F.col("__n") >= th.min_votes).drop("__n")
    return counts.join(language_vote(votes, th.min_agreement), "clip_id").join(speaker_median(votes), "clip_id")
