"""Turn-taking statistics of a conversation and the gate over them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Thresholds
from .ordered import BLOCK_MS, blocked, ratio, scan, steps
from .segments import EVERYONE, ORDER, everyone_and_one


def talk_time(segments: DataFrame) -> DataFrame:
    """(clip_id, speaker, talk_ms, share): talk time of each speaker and its share of all talk, to three places."""
    per = segments.groupBy("clip_id", "speaker").agg(F.sum(F.col("end_ms") - F.col("start_ms")).alias("talk_ms"))
    total = per.groupBy("clip_id").agg(F.sum("talk_ms").alias("total"))
    return per.join(total, "clip_id").select("clip_id", "speaker", "talk_ms", ratio(F.col("talk_ms"), F.col("total"), 3).alias("share"))


def speaker_maps(segments: DataFrame) -> DataFrame:
    """(clip_id, talk_time, speaker_shares): seconds of talk to two places, and shares of all talk, by speaker."""
    entry = lambda value: F.map_from_entries(F.array_sort(F.collect_list(F.struct("speaker", value))))  # noqa: E731, one entry a speaker
    per = talk_time(segments)
    return per.groupBy("clip_id").agg(entry(ratio(F.col("talk_ms"), F.lit(1000), 2).alias("v")).alias("talk_time"), entry(F.col("share")).alias("speaker_shares"))


def in_seconds(stats: DataFrame) -> DataFrame:
    """The statistics with lengths in seconds, as records hold them: duration, overlap_sec, median_turn_dur."""
    names = {"duration": ratio(F.col("duration_ms"), F.lit(1000), 3), "overlap_sec": ratio(F.col("overlap_ms"), F.lit(1000), 2), "median_turn_dur": F.round(F.col("median_turn_ms") / 1000, 3)}
    return stats.withColumns(names).drop("duration_ms", "overlap_ms", "median_turn_ms", "talk_ms")


def conversation_stats(segments: DataFrame, th: Thresholds = Thresholds(), block_ms: int = BLOCK_MS, durations: DataFrame | None = None) -> DataFrame:
    """One row per clip. Lengths are whole ms; overlap is the sum of pairwise overlaps of different speakers.

    durations (clip_id, duration_ms) gives the clips' own lengths, which count the silence after the last segment; a clip without
    one is as long as its segments reach. Turns per minute and the speech ratio are 0 where a length is 0.

    Neighbours across a long time line come from block summaries; the sum of pairwise overlaps from the numbers of running
    segments (of all speakers, minus those of the same one), so neither a hot clip nor a dense one grows a task.
    """
    rows = scan(blocked(segments.select("clip_id", *ORDER, "end_ms", "speaker"), ["clip_id"], "start_ms", block_ms), ["clip_id"], ORDER, fields=["end_ms", "speaker"], prev="prev", nxt="nxt")
    length = F.col("end_ms") - F.col("start_ms")
    change = F.col("prev.speaker") != F.col("speaker")
    sandwiched = (length < th.backchannel_ms) & (F.col("prev.speaker") == F.col("nxt.speaker")) & change
    gap = F.when(change & (F.col("start_ms") > F.col("prev.end_ms")), F.col("start_ms") - F.col("prev.end_ms"))
    base = rows.groupBy("clip_id").agg(
        F.count("*").alias("n_segments"), F.count_if(change).alias("n_turns"), F.count_if(sandwiched).alias("backchannels"), F.max("end_ms").alias("duration_ms"), F.sum(length).alias("talk_ms"),
        F.count(gap).alias("n_gaps"), F.coalesce(F.sum(gap), F.lit(0)).alias("gap_ms"), F.percentile(length, 0.5).alias("median_turn_ms"),
    )
    speakers = segments.groupBy("clip_id", "speaker").agg(F.sum(length).alias("ms")).groupBy("clip_id").agg(F.count("*").alias("n_speakers"), F.max("ms").alias("most_ms"))
    spoken = segments.select("clip_id", "start_ms", "end_ms", everyone_and_one())
    k = F.col("active") - F.col("d")
    pairs = F.when(F.col("who") == EVERYONE, 1).otherwise(-1) * F.call_function("div", F.col("ms") * k * (k - 1), F.lit(2).cast("long"))
    overlaps = steps(spoken, ["clip_id", "who"], block_ms=block_ms).groupBy("clip_id").agg(F.sum(pairs).alias("overlap_ms"))
    joined = base.join(speakers, "clip_id").join(overlaps, "clip_id")
    if durations is not None:
        known = durations.groupBy("clip_id").agg(F.max("duration_ms").alias("known_ms"))
        joined = joined.join(known, "clip_id", "left").withColumn("duration_ms", F.coalesce("known_ms", "duration_ms"))
    c = F.col
    return joined.select(
        "clip_id", "n_speakers", "n_segments", "n_turns", "backchannels", "duration_ms", "talk_ms", "overlap_ms", "median_turn_ms",
        ratio(c("most_ms"), c("talk_ms"), 3).alias("dominance"), F.coalesce(ratio(c("n_turns") * 60_000, c("duration_ms"), 2), F.lit(0.0)).alias("turns_per_min"), ratio(c("overlap_ms"), c("talk_ms"), 4).alias("overlap_ratio"),
        F.coalesce(ratio(c("gap_ms"), c("n_gaps") * 1000, 3), F.lit(0.0)).alias("mean_gap"), F.coalesce(ratio(c("talk_ms"), c("duration_ms"), 3), F.lit(0.0)).alias("speech_ratio"),
    )


def qualify(stats: DataFrame, th: Thresholds = Thresholds()) -> DataFrame:
    """Adds reason: the first rule that a clip breaks, compared on the rounded statistics, bounds included; '' where none."""
    reason = (
        F.when(F.coalesce(F.col("n_speakers"), F.lit(0)) != 2, "diar_speaker_count")
        .when((F.col("n_turns") < th.min_turns) | (F.col("turns_per_min") < th.min_turns_per_min), "few_turns")
        .when(F.col("dominance") > th.max_dominance, "imbalanced")
        .when((F.col("overlap_ratio") < th.min_overlap_ratio) | (F.col("overlap_ratio") > th.max_overlap_ratio), "overlap_out_of_range")
    )
    return stats.withColumn("reason", F.coalesce(reason, F.lit("")))
