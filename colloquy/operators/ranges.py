"""Placing windows and chunks on a time line, and assigning keys to shards and splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import Thresholds, WindowPlan


def even_windows(df: DataFrame, n: int = Thresholds.verify_windows, win_ms: int = int(Thresholds.verify_window_sec * 1000)) -> DataFrame:
    """(clip_id, i, start_ms): n windows spread over the middle 80 % of (clip_id, duration_ms), kept inside it; 0 wins."""
    span = F.greatest(F.floor(F.col("duration_ms") * 8 / 10), F.lit(win_ms))
    at = F.floor(F.col("duration_ms") / 10) + F.floor((span * (2 * F.col("i") + 1) - n * win_ms) / (2 * n))
    rows = df.select("clip_id", "duration_ms", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("i"))
    return rows.select("clip_id", "i", F.greatest(F.lit(0), F.least(at, F.col("duration_ms") - win_ms)).cast("long").alias("start_ms"))


def chunk_ranges(df: DataFrame, chunk_ms: int = 120_000, overlap_ms: int = 10_000) -> DataFrame:
    """(clip_id, i, start_ms, end_ms): overlapping chunks of (clip_id, duration_ms); the last one is cut."""
    hop = chunk_ms - overlap_ms
    rows = df.where("duration_ms > 0").select("clip_id", "duration_ms", F.posexplode(F.sequence(F.lit(0).cast("long"), F.col("duration_ms") - 1, F.lit(hop).cast("long"))).alias("i", "start_ms"))
    return rows.select("clip_id", "i", "start_ms", F.least(F.col("start_ms") + chunk_ms, "duration_ms").alias("end_ms"))


def emission_ranges(df: DataFrame, rate: int = 16_000, core_s: int = 300, context_s: int = 10, stride: int = 320) -> DataFrame:
    """(clip_id, i, start, end, core_start, core_end, skip_frames) in samples of (clip_id, n_samples): cores with context on both sides."""
    core, context = core_s * rate, context_s * rate
    rows = df.where("n_samples > 0").select("clip_id", "n_samples", F.posexplode(F.sequence(F.lit(0).cast("long"), F.col("n_samples") - 1, F.lit(core).cast("long"))).alias("i", "core_start"))
    start = F.greatest(F.lit(0), F.col("core_start") - context)
    core_end = F.least(F.col("core_start") + core, "n_samples")
    return rows.select("clip_id", "i", start.alias("start"), F.least(core_end + context, F.col("n_samples")).alias("end"), "core_start", core_end.alias("core_end"), F.floor((F.col("core_start") - start) / stride).alias("skip_frames"))


def proportional_chunks(df: DataFrame, chunk_ms: int = 480_000) -> DataFrame:
    """(clip_id, i, lo, hi): words [lo, hi) of (clip_id, n_words, duration_ms) given to the i-th of ceil(duration / chunk) chunks by their share of time."""
    n = F.greatest(F.lit(1), F.ceil(F.col("duration_ms") / chunk_ms))
    rows = df.where("duration_ms > 0").select("clip_id", "n_words", "duration_ms", F.explode(F.sequence(F.lit(0).cast("long"), n - 1)).alias("i"))
    word = lambda i: F.floor(F.col("n_words") * F.least(i * chunk_ms, F.col("duration_ms")) / F.col("duration_ms"))
    return rows.select("clip_id", "i", word(F.col("i")).alias("lo"), word(F.col("i") + 1).alias("hi"))


def snap_spans(spans: DataFrame, totals: DataFrame, plan: WindowPlan = WindowPlan()) -> DataFrame:
    """(clip_id, win, first_sample, last_sample, n_frames): planned spans (half ms) cut to whole frames and to the clip; short ones dropped.

    A frame is 1000 / frame_hz ms; all in integers of half ms.
    """
    frame2 = round(2000 / plan.frame_hz)
    rows = spans.join(totals, "clip_id").withColumn("n_frames", F.floor((F.col("b2") - F.col("a2")) / frame2))
    first = F.floor(F.col("a2") * plan.sample_rate / 2000)
    length = F.floor(F.col("n_frames") * frame2 * plan.sample_rate / 2000)
    rows = rows.select("clip_id", "win", "n_frames", first.alias("first_sample"), F.least(first + length, F.floor(F.col("total_ms") * plan.sample_rate / 1000)).alias("last_sample"))
    return rows.where((F.col("last_sample") - F.col("first_sample")) * 1000 >= plan.min_ms * plan.sample_rate)


def both_speak(spans: DataFrame, left: str = "rms_left", right: str = "rms_right", least: float = WindowPlan.min_rms) -> DataFrame:
    return spans.where(F.least(left, right) >= least)


def source_of(clip: Column) -> Column:
    """The source video of a clip: its id without the segment suffix, so that its segments stay together."""
    return F.regexp_replace(clip, r"_seg[0-9]+$", "")


def portable_hash(key: Column, seed: int = 0) -> Column:
    """A 32-bit hash of text that any engine can repeat: the first eight hex digits of MD5."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key).cast("binary")), 1, 8), 16, 10).cast("long")


def jitter(key: Column, lo: float, hi: float, seed: int = 0) -> Column:
    """A delay in [lo, hi) that is random over keys and the same again for one key."""
    return F.lit(lo) + portable_hash(key, seed) / F.lit(float(1 << 32)) * F.lit(hi - lo)


def grouped_split(df: DataFrame, key: Column, frac: float = WindowPlan.val_frac, seed: int = WindowPlan.seed) -> DataFrame:
    """(source, split): a share of the sources held out for validation, at least one of two or more.

    The sources with the smallest hashes are taken. The bound hash comes from counts by its leading bits, so only the sources
    inside one such bin are ranked, not all of them.
    """
    sources = df.select(key.alias("source")).where("source is not null").distinct().withColumn("h", portable_hash(F.col("source"), seed)).withColumn("bin", F.shiftright("h", 18))
    bins = sources.groupBy("bin").agg(F.count("*").alias("n"))  # 16,384 bins at most
    before = F.coalesce(F.sum("n").over(Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    total = F.sum("n").over(Window.partitionBy(F.lit(1)))
    held = F.when(total > 1, F.greatest(F.lit(1), F.floor(total * frac))).otherwise(0)
    bins = bins.select("bin", before.alias("before"), held.alias("held"))
    rank = F.row_number().over(Window.partitionBy("bin").orderBy("h", "source")) + F.col("before")
    return sources.join(F.broadcast(bins), "bin").select("source", F.when(rank <= F.col("held"), "val").otherwise("train").alias("split"))


def crc_shard(key: Column, n: int) -> Column:
    return F.pmod(F.crc32(key.cast("binary")), F.lit(n)).cast("int")
