"""Interval operators against brute force, with the dirty cases."""

from __future__ import annotations

import random

import pytest

from colloquy.operators import coverage, segments, stats
from colloquy.operators.ordered import blocked, scan
from pyspark.sql import functions as F

SCHEMA = "clip_id string, seg_idx int, speaker string, start_ms long, end_ms long, entity string, block long, t long, d long"


def random_rows(seed: int, clips: int = 4, n: int = 60, span: int = 20_000):
    r = random.Random(seed)
    rows = []
    for c in range(clips):
        for i in range(n):
            a = r.randrange(span)
            rows.append((f"c{c}", i, r.choice("ABC"), a, a + r.randrange(0, 900), "x", 1, 2, 3))
    rows += [(None, 0, "A", 0, 5, "x", 1, 2, 3), ("c0", 900, None, 5, 10, "x", 1, 2, 3), ("c0", 901, "A", None, 10, "x", 1, 2, 3), ("c0", 902, "A", 10, None, "x", 1, 2, 3), ("c0", 903, "A", 10, 4, "x", 1, 2, 3)]
    return rows + rows[:7]


def brute_periods(rows):
    out = {}
    for clip in {r[0] for r in rows if r[0]}:
        iv = sorted((r[3], r[4]) for r in rows if r[0] == clip and r[3] is not None and r[4] is not None and r[4] > r[3])
        merged = []
        for a, b in iv:
            if merged and a <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], b)
            else:
                merged.append([a, b])
        out[clip] = merged
    return out


@pytest.mark.parametrize("block_ms", [500, 3_000, 10_000_000])
def test_periods_and_gaps(spark, block_ms):
    rows = random_rows(1)
    df = spark.createDataFrame(rows, SCHEMA)
    got = {(r.entity, r.kind, r.start_ms, r.end_ms) for r in coverage.periods_and_gaps(df, block_ms=block_ms).collect()}
    want = set()
    for clip, merged in brute_periods(rows).items():
        want |= {(clip, "period", a, b) for a, b in merged}
        want |= {(clip, "gap", x[1], y[0]) for x, y in zip(merged, merged[1:])}
    assert got == want


@pytest.mark.parametrize("block_ms", [500, 10_000_000])
def test_free_starts(spark, block_ms):
    rows = random_rows(2)
    got = {(r.entity, r.at) for r in coverage.free_starts(spark.createDataFrame(rows, SCHEMA), block_ms=block_ms).collect()}
    valid = {(r[0], r[3], r[4]) for r in rows if r[0] and r[3] is not None and r[4] is not None and r[4] > r[3]}
    want = {(c, s) for c, s, _ in valid if not any(c2 == c and s2 < s and e2 > s for c2, s2, e2 in valid)}
    assert got == want


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert coverage.periods_and_gaps(empty).count() == 0
    assert coverage.free_starts(empty).count() == 0
    assert stats.conversation_stats(segments.clean_segments(empty)).count() == 0
    assert segments.mark_overlaps(segments.clean_segments(empty)).count() == 0


def test_overlaps_against_pairs(spark):
    rows = random_rows(3, n=40)
    segs = segments.clean_segments(spark.createDataFrame(rows, SCHEMA), 1)
    clean = [tuple(r) for r in segs.collect()]
    want, pairs = {}, set()
    for c, i, s, a, b in clean:
        want[c, i, a] = sum(max(0, min(b, b2) - max(a, a2)) for c2, _, s2, a2, b2 in clean if c2 == c and s2 != s)
        for c2, j, s2, a2, b2 in clean:
            if c2 == c and s2 != s and (a, i) < (a2, j) and a2 < b:
                pairs.add((c, i, j, min(b, b2) - a2))
    assert {(r.clip_id, r.seg_idx, r.start_ms): r.overlap_ms for r in segments.mark_overlaps(segs).collect()} == want
    assert {tuple(r) for r in segments.overlap_pairs(segs, 700).collect()} == pairs
    total = {r.clip_id: r.overlap_ms for r in stats.conversation_stats(segs, block_ms=900).collect()}
    assert total == {c: sum(p[3] for p in pairs if p[0] == c) for c in total}


@pytest.mark.parametrize("block_ms", [300, 10_000_000])
def test_ordered_helpers(spark, block_ms):
    rows = [("k", i % 3, (i * 37) % 1000, i) for i in range(80)]
    df = blocked(spark.createDataFrame(rows, "clip_id string, kind int, t long, i long"), ["clip_id"], "t", block_ms)
    got = scan(df, ["clip_id"], ["t", "i"], sums={"s": F.col("i")}, maxima={"m": F.col("i")}, fields=["kind"], prev="prev", nxt="nxt").orderBy("t", "i").collect()
    order = sorted(rows, key=lambda r: (r[2], r[3]))
    for n, (g, r) in enumerate(zip(got, order, strict=True)):
        assert (g.prev.kind if g.prev else None) == (order[n - 1][1] if n else None)
        assert (g.nxt.kind if g.nxt else None) == (order[n + 1][1] if n + 1 < len(order) else None)
        assert g.s == sum(x[3] for x in order[: n + 1]) and g.m == max((x[3] for x in order[:n]), default=None)


def test_words_in_turns_and_windows(spark):
    words = spark.createDataFrame([("c", 0, 0, "a", 0, 10), ("c", 0, 1, "b", 500, 600), ("c", 0, 2, "x", None, None), ("c", 0, 3, "c", 999, 1200), ("c", 0, 4, "d", 1000, 1100)], "clip_id string, channel int, idx int, word string, start_ms long, end_ms long")
    turns = spark.createDataFrame([("c", 0, 0, 0, 1000), ("c", 0, 1, 400, 1001), ("c", 0, 2, 5000, 6000)], "clip_id string, channel int, seg_idx int, start_ms long, end_ms long")
    assert {(r.seg_idx, r.text) for r in segments.words_in_turns(words, turns, 300).collect()} == {(0, "a b c"), (1, "b c d")}
    segs = spark.createDataFrame([("c", 0, "A", 0, 5000), ("c", 1, "B", 900, 2000), ("c", 2, "C", 1000, 1500), ("c", 3, "A", 3000, 9000)], "clip_id string, seg_idx int, speaker string, start_ms long, end_ms long")
    wins = spark.createDataFrame([("c", 7, 1000, 4000, ["A", "B"])], "clip_id string, win int, t0 long, t1 long, pair array<string>")
    assert {tuple(r)[1:] for r in segments.clip_to_windows(segs, wins, 1000).collect()} == {(7, 0, "A", 0, 3000), (7, 1, "B", 0, 1000), (7, 3, "A", 2000, 3000)}


def test_blocks_leave_out_null_keys(spark):
    df = spark.createDataFrame([(None, 1), ("a", None), ("a", 5), ("a", 900)], "k string, t long")
    rows = scan(blocked(df, ["k"], "t", 100), ["k"], ["t"], sums={"n": F.lit(1)}, minima={"after": F.col("t")}).orderBy("t").collect()
    assert [(r.k, r.t, r.n, r.after) for r in rows] == [("a", 5, 1, 900), ("a", 900, 2, None)]
