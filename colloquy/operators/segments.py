"""Interval operators over speaker-labelled segments: cleaning, overlaps, joins of intervals and points.

Defined results: rows without clip, speaker or bound, or shorter than the minimum, are not segments; a row present twice counts
once; empty tables give empty results; only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Thresholds
from .ordered import BLOCK_MS, blocked, scan, steps

COLUMNS = ["clip_id", "seg_idx", "speaker", "start_ms", "end_ms"]
ORDER = ["start_ms", "seg_idx"]
PAIR_BLOCK_MS = 60_000
EVERYONE = "*"


def clean_segments(df: DataFrame, min_ms: int = Thresholds.min_segment_ms) -> DataFrame:
    """Distinct valid segments of at least min_ms."""
    rows = df.select("clip_id", "seg_idx", "speaker", F.col("start_ms").cast("long").alias("start_ms"), F.col("end_ms").cast("long").alias("end_ms"))
    return rows.where(F.col("clip_id").isNotNull() & F.col("speaker").isNotNull() & (F.col("end_ms") - F.col("start_ms") >= min_ms)).distinct()


def everyone_and_one() -> Column:
    """who: each segment once for everyone and once for its speaker."""
    return F.explode(F.array(F.lit(EVERYONE), F.concat(F.lit("="), "speaker"))).alias("who")


def _spread(start: str, end: str, block_ms: int) -> Column:
    """All blocks that a half-open interval touches."""
    return F.explode(F.sequence(F.floor(F.col(start) / block_ms), F.floor((F.col(end) - 1) / block_ms)))


def overlap_pairs(segments: DataFrame, block_ms: int = PAIR_BLOCK_MS) -> DataFrame:
    """(clip_id, a_idx, b_idx, overlap_ms): overlapping segments of different speakers, b starting later.

    The earlier segment is spread over the blocks it touches and meets the later one in the block of its start, so each pair
    is made once, by an equi-join on (clip, block).
    """
    a = segments.select("clip_id", _spread("start_ms", "end_ms", block_ms).alias("block"), F.col("seg_idx").alias("a_idx"), F.col("speaker").alias("a_speaker"), F.col("start_ms").alias("a_start"), F.col("end_ms").alias("a_end"))
    b = segments.select("clip_id", F.floor(F.col("start_ms") / block_ms).alias("block"), F.col("seg_idx").alias("b_idx"), F.col("speaker").alias("b_speaker"), F.col("start_ms").alias("b_start"), F.col("end_ms").alias("b_end"))
    later = (F.col("a_start") < F.col("b_start")) | ((F.col("a_start") == F.col("b_start")) & (F.col("a_idx") < F.col("b_idx")))
    pairs = a.join(b, ["clip_id", "block"]).where(later & (F.col("b_start") < F.col("a_end")) & (F.col("a_speaker") != F.col("b_speaker")))
    return pairs.select("clip_id", "a_idx", "b_idx", (F.least("a_end", "b_end") - F.col("b_start")).alias("overlap_ms"))


def mark_overlaps(segments: DataFrame) -> DataFrame:
    """Each segment with overlap_ms, its summed overlap with other speakers' segments, and clean (none).

    The area under the number of running intervals, of all speakers minus the own one, is read at both ends of a segment: no
    pairs are made, so dense clips cost no more than sparse ones.
    """
    spoken = segments.select(*COLUMNS, everyone_and_one())
    rows = steps(spoken, ["clip_id", "who"]).withColumn("step", F.col("ms") * (F.col("active") - F.col("d")))
    area = scan(rows, ["clip_id", "who"], ["t"], sums={"area": F.col("step")}).select("clip_id", "t", "who", "area")
    area = area.groupBy("clip_id", "t").agg(F.map_from_entries(F.collect_list(F.struct("who", "area"))).alias("area"))
    ends = segments.select(*COLUMNS, F.explode(F.array(F.struct(F.col("start_ms").alias("t"), F.lit(-1).alias("sign")), F.struct(F.col("end_ms").alias("t"), F.lit(1).alias("sign")))).alias("e")).select(*COLUMNS, "e.*")
    read = ends.join(area, ["clip_id", "t"])
    marked = read.groupBy(*COLUMNS).agg(F.sum(F.col("sign") * (F.element_at("area", F.lit(EVERYONE)) - F.element_at("area", F.concat(F.lit("="), "speaker")))).alias("overlap_ms"))
    return marked.withColumn("clean", F.col("overlap_ms") == 0)


def clip_to_windows(segments: DataFrame, windows: DataFrame, block_ms: int = 600_000) -> DataFrame:
    """Segments of a window's speakers (windows: clip_id, win, t0, t1, pair), cut to it and relative to its start."""
    w = windows.select("clip_id", "win", "t0", "t1", "pair", _spread("t0", "t1", block_ms).alias("block"))
    s = segments.select(*COLUMNS, _spread("start_ms", "end_ms", block_ms).alias("block"))
    met = s.join(w, ["clip_id", "block"]).where((F.col("end_ms") > F.col("t0")) & (F.col("start_ms") < F.col("t1")) & F.array_contains("pair", F.col("speaker")))
    once = met.where(F.col("block") == F.floor(F.greatest("start_ms", "t0") / block_ms))
    return once.select("clip_id", "win", "seg_idx", "speaker", F.greatest(F.lit(0), F.col("start_ms") - F.col("t0")).alias("start_ms"), (F.least("t1", "end_ms") - F.col("t0")).alias("end_ms"))


def words_in_turns(words: DataFrame, turns: DataFrame, block_ms: int = 60_000) -> DataFrame:
    """(clip_id, channel, seg_idx, text, n_words): the words starting inside each turn, in order; turns without words are dropped."""
    w = words.where("start_ms is not null").select("clip_id", "channel", "idx", "word", F.col("start_ms").alias("at"), F.floor(F.col("start_ms") / block_ms).alias("block"))
    t = turns.select("clip_id", "channel", "seg_idx", "start_ms", "end_ms", _spread("start_ms", "end_ms", block_ms).alias("block"))
    inside = w.join(t, ["clip_id", "channel", "block"]).where("at >= start_ms and at < end_ms")
    ordered = F.array_sort(F.collect_list(F.struct("at", "idx", "word")))
    return inside.groupBy("clip_id", "channel", "seg_idx").agg(ordered.alias("w")).select("clip_id", "channel", "seg_idx", F.array_join("w.word", " ").alias("text"), F.size("w").alias("n_words"))


def silence_groups(segments: DataFrame, gap_ms: int = Thresholds.silence_gap_ms, block_ms: int = BLOCK_MS) -> DataFrame:
    """Each segment with grp, counting from 0: a new group begins gap_ms or more after the end of the segment before."""
    rows = scan(blocked(segments.select(*COLUMNS), ["clip_id"], "start_ms", block_ms), ["clip_id"], ORDER, fields=["end_ms"], prev="prev")
    rows = rows.select(*COLUMNS, "block", F.when(F.col("start_ms") - F.col("prev.end_ms") >= gap_ms, 1).otherwise(0).alias("opens"))
    return scan(rows, ["clip_id"], ORDER, sums={"grp": F.col("opens")}).select(*COLUMNS, F.col("grp").cast("long").alias("grp"))


def cut_points(segments: DataFrame, totals: DataFrame, min_gap_ms: int = 400) -> DataFrame:
    """(clip_id, cut2): twice the midpoint (so that it stays whole) of each silence of min_gap_ms or more, edges included.

    totals has (clip_id, total_ms); clips without segments have no cut points. Touching segments leave no silence.
    """
    from .coverage import silences

    return silences(segments, totals).where(F.col("b") - F.col("a") >= min_gap_ms).select(F.col("entity").alias("clip_id"), (F.col("a") + F.col("b")).alias("cut2"))
