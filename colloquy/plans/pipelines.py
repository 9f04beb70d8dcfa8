"""The three pipelines as single declarative plans: curation, transcripts, training windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import Thresholds, WindowPlan
from ..functions import records
from ..operators import gates, mining, ranges, segments, state, stats, votes, words
from ..runtime import cut


# The stage at which each reason of the light gate is found.
STAGES = {"too_short": "probe", "too_long": "probe", "license": "probe", "low_speech": "prefilter", "high_speech": "prefilter", "verify_failed": "verify", "not_two_speakers": "verify", "not_indic": "verify", "not_conversational": "verify"}
_FLAGS = ("is_conversational", "music_dominant", "is_dubbed")


def with_verdicts(videos: DataFrame, vote_rows: DataFrame, th: Thresholds = Thresholds()) -> DataFrame:
    """The candidates (vid, duration in s, license, speech_ratio) with the voted verdict of their windows; verify_missing where there is none."""
    verdict = votes.verdicts(vote_rows, th).withColumnsRenamed({"clip_id": "vid", "is_dubbed_or_voiceover": "is_dubbed"})
    for flag in _FLAGS:
        if flag not in verdict.columns:
            verdict = verdict.withColumn(flag, F.lit(flag == "is_conversational"))
    joined = videos.select("vid", "duration", "license", "speech_ratio").join(verdict.select("vid", "num_speakers", "language", "language_code", *_FLAGS), "vid", "left")
    return joined.withColumn("verify_missing", F.col("language_code").isNull())


def run(candidates: DataFrame, segment_rows: DataFrame, th: Thresholds = Thresholds()) -> DataFrame:
    """(id, vid, status, reason, stage, t0, t1): every row that a run leaves in the state table.

    Candidates have what the light gate reads, and duration in seconds; those that pass are diarized (segment_rows by clip_id = vid).
    Exactly two speakers make one conversation as long as the recording; more are mined for stretches of two, each of which is cut
    out, measured by its own length and judged by itself (id `vid_segN`), and the recording is accepted with the number of stretches
    that passed. One speaker, none, or no such stretch is `diar_speaker_count`.
    """
    light = cut(candidates.select("vid", F.round(F.coalesce("duration", F.lit(0.0)) * 1000).cast("long").alias("duration_ms"), gates.light_reason(th).alias("reason")).dropDuplicates(["vid"]))
    passed = light.where("reason = ''").select(F.col("vid").alias("clip_id"), "duration_ms")
    segs = cut(segments.clean_segments(segment_rows, th.min_segment_ms).join(passed.select("clip_id"), "clip_id", "left_semi"))
    speakers = segs.groupBy("clip_id", "speaker").agg(F.count("*").alias("n")).groupBy("clip_id").agg(F.count("*").alias("speakers"))
    counted = cut(passed.join(speakers, "clip_id", "left").withColumn("speakers", F.coalesce("speakers", F.lit(0))))
    several = segs.join(counted.where("speakers > 2").select("clip_id"), "clip_id", "left_semi")
    mined = mining.mine_two_speaker(several, th.min_chunk_ms, th.max_chunk_ms, th.silence_gap_ms)
    number = F.row_number().over(Window.partitionBy("clip_id").orderBy("t0", "t1")) - 1  # stretches are minutes long, so few a clip
    mined = cut(mined.withColumn("win", records.clip_name(F.col("clip_id"), number)))
    parts = segments.clip_to_windows(segs, mined).select(F.col("win").alias("clip_id"), *segments.COLUMNS[1:])
    whole = counted.where("speakers = 2").select("clip_id", "duration_ms", F.col("clip_id").alias("vid"), F.lit(0).cast("long").alias("t0"), F.col("duration_ms").alias("t1"))
    stretches = whole.unionByName(mined.select(F.col("win").alias("clip_id"), (F.col("t1") - F.col("t0")).alias("duration_ms"), F.col("clip_id").alias("vid"), "t0", "t1"))
    measured = stats.conversation_stats(segs.join(whole.select("clip_id"), "clip_id", "left_semi").unionByName(parts), th, durations=stretches.select("clip_id", "duration_ms"))
    judged = cut(stretches.join(stats.qualify(measured, th).select("clip_id", "reason"), "clip_id", "left").withColumn("reason", F.coalesce("reason", F.lit("diar_speaker_count"))))
    status = F.when(F.col("reason") == "", "accepted").otherwise("rejected")
    own = judged.select(F.col("clip_id").alias("id"), "vid", status.alias("status"), "reason", F.when(F.col("reason") == "", "emit").otherwise("qualify").alias("stage"), "t0", "t1")
    parents = state.parents(own.where("id <> vid").select(F.col("vid").alias("parent"), "status"), own.where("id <> vid").select("vid"))
    nowhere = F.lit(None).cast("long")
    parents = parents.select(F.col("vid").alias("id"), "vid", "status", "reason", F.when(F.col("status") == "accepted", "emit").otherwise("qualify").alias("stage"), nowhere.alias("t0"), nowhere.alias("t1"))
    left_out = counted.join(judged.select(F.col("vid").alias("clip_id")), "clip_id", "left_anti").select(F.col("clip_id").alias("vid"), F.lit("diar_speaker_count").alias("reason"), F.lit("diarize").alias("stage"))
    early = light.where("reason <> ''").select("vid", "reason", records.lookup(STAGES, F.col("reason")).alias("stage"))
    rejected = early.unionByName(left_out).select(F.col("vid").alias("id"), "vid", F.lit("rejected").alias("status"), "reason", "stage", nowhere.alias("t0"), nowhere.alias("t1"))
    return own.unionByName(parents).unionByName(rejected)


def curate(videos: DataFrame, vote_rows: DataFrame, segment_rows: DataFrame, th: Thresholds = Thresholds()) -> DataFrame:
    """`run` over candidates with the votes of their windows (by clip_id = vid)."""
    return run(with_verdicts(videos, vote_rows, th), segment_rows, th)


def assemble_transcripts(word_rows: DataFrame, turns: DataFrame, totals: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(words with repaired times, turns with their text)."""
    placed = words.repair_words(word_rows, totals)
    return placed, segments.words_in_turns(placed, turns)


def plan_training_windows(segment_rows: DataFrame, totals: DataFrame, plan: WindowPlan = WindowPlan()) -> DataFrame:
    """(clip_id, win, n_frames, first_sample, last_sample, split): frame-aligned windows of every clip, split by source video."""
    cuts = segments.cut_points(segment_rows, totals, plan.min_gap_ms)
    spans = ranges.snap_spans(mining.plan_windows(cuts, totals, plan), totals, plan)
    split = ranges.grouped_split(totals, ranges.source_of(F.col("clip_id")), plan.val_frac, plan.seed)
    return spans.withColumn("source", ranges.source_of(F.col("clip_id"))).join(split, "source").drop("source")
