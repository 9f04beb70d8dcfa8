"""Properties of the pipelines' results on the smallest tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from colloquy import fixtures as fx
from colloquy.operators import mining, segments, words
from colloquy.runtime import table


def test_words_do_not_overlap(spark, folder):
    w = fx.derive(spark, folder, fx.WORDS_SPARK)
    totals = fx.derive(spark, folder, fx.WORD_TOTALS, words=w)
    done = words.repair_words(w, totals)
    assert done.count() == w.count() and done.where("start_ms is null or end_ms < start_ms").count() == 0
    order = Window.partitionBy("clip_id", "channel").orderBy("idx")
    late = done.withColumn("nxt", F.lead("start_ms").over(order)).where("not approx and end_ms > nxt")
    before = words.interpolate_words(w, totals).withColumn("nxt", F.lead("start_ms").over(order)).where("not approx and end_ms > nxt")
    assert late.count() == before.count()  # an end is never moved past the next start


def test_cuts_lie_in_silence(spark, folder):
    segs = segments.clean_segments(table(spark, folder, "segments"))
    totals = segs.groupBy("clip_id").agg((F.max("end_ms") + 500).alias("total_ms"))
    cuts = segments.cut_points(segs, totals)
    inside = cuts.join(segs, "clip_id").where("cut2 > 2 * start_ms and cut2 < 2 * end_ms")
    assert cuts.count() > 0 and inside.count() == 0


def test_mined_windows_have_two_speakers(spark, folder):
    segs = segments.clean_segments(table(spark, folder, "segments"))
    mined = mining.mine_two_speaker(segs, 20_000, 100_000)
    rows = mined.collect()
    assert rows and all(len(r.pair) == 2 and r.t1 - r.t0 >= 20_000 for r in rows)
    # a third speaker closes a run at the start of their segment; only a last segment still running then can reach past it
    last = F.max(F.when(F.array_contains("pair", F.col("speaker")) & (F.col("end_ms") <= F.col("t1")), F.col("start_ms"))).over(Window.partitionBy("clip_id", "t0"))
    inside = mined.join(segs, "clip_id").where("start_ms >= t0 and start_ms < t1").withColumn("last", last)
    assert inside.where("not array_contains(pair, speaker) and start_ms < last and start_ms > t0").count() == 0


def test_planned_windows_tile_the_clip(spark, folder):
    segs = segments.clean_segments(table(spark, folder, "segments"))
    totals = segs.groupBy("clip_id").agg((F.max("end_ms") + 500).alias("total_ms"))
    spans = mining.plan_windows(segments.cut_points(segs, totals), totals)
    bad = spans.where("b2 - a2 > 360000 or b2 - a2 < 60000")
    assert spans.count() > 0 and bad.count() == 0
    overlap = spans.withColumn("nxt", F.lead("a2").over(Window.partitionBy("clip_id").orderBy("win"))).where("nxt < b2")
    assert overlap.count() == 0
