"""Greedy folds against independent sequential versions."""

from __future__ import annotations

import random

import pytest

from colloquy.config import WindowPlan
from colloquy.operators import mining
from colloquy.streaming.incremental import BackOff, replay_backoff


def runs_of(segs, least, longest, gap):
    """Two-speaker windows by plain lists: groups, then runs, then chunks."""
    groups = []
    for s in segs:
        if groups and s[0] - groups[-1][-1][1] < gap:
            groups[-1].append(s)
        else:
            groups.append([s])
    out = []
    for g in groups:
        at = 0
        while at < len(g):
            end, seen = at, set()
            while end < len(g) and len(seen | {g[end][2]}) <= 2:
                seen.add(g[end][2])
                end += 1
            run, at = g[at:end], end
            if len(seen) != 2 or run[-1][1] - run[0][0] < least:
                continue
            if run[-1][1] - run[0][0] <= longest:
                chunks = [run]
            else:
                chunks, part, origin = [], [], run[0][0]
                for s in run:
                    part.append(s)
                    if s[1] - origin >= longest:
                        chunks.append(part)
                        part, origin = [], s[1]
                if part and part[-1][1] - origin >= least:
                    chunks.append(part)
            out += [(c[0][0], c[-1][1], tuple(sorted({s[2] for s in c}))) for c in chunks if c[-1][1] - c[0][0] >= least]
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_mining(spark, seed):
    r = random.Random(seed)
    rows, want = [], set()
    for c in range(6):
        t, segs = 0, []
        for i in range(150):
            t += r.choice([0, 200, 300, 900, -400, 6000 if r.random() < 0.1 else 100])
            t = max(t, segs[-1][0] if segs else 0)
            segs.append((t, t + r.randrange(300, 4000), r.choice("AABBB" if r.random() < 0.95 else "CD" if c % 2 else "C")))
            t = segs[-1][1]
        rows += [(f"c{c}", i, s[2], s[0], s[1]) for i, s in enumerate(segs)]
        want |= {(f"c{c}", *w) for w in runs_of(segs, 8_000, 30_000, 5_000)}
    df = spark.createDataFrame(rows, "clip_id string, seg_idx int, speaker string, start_ms long, end_ms long")
    got = {(x.clip_id, x.t0, x.t1, tuple(x.pair)) for x in mining.mine_two_speaker(df, 8_000, 30_000, 5_000).collect()}
    assert got == want and want
    blocks = {(x.clip_id, x.t0, x.t1, tuple(x.pair)) for x in mining.mine_two_speaker(df, 8_000, 30_000, 5_000, block_ms=10_000).collect()}
    assert blocks == want


def planned(total, cuts, target, least, most):
    bounds = [0]
    while total - bounds[-1] > most:
        p = bounds[-1]
        near = [c for c in sorted(cuts) if p + least < c < p + most]
        bounds.append(min(near, key=lambda c: abs(c - p - target)) if near else p + target)
    bounds.append(total)
    return [(a, b) for a, b in zip(bounds, bounds[1:]) if b - a >= least]


def test_planning(spark):
    r = random.Random(5)
    plan = WindowPlan(target_ms=60_000, min_ms=15_000, max_ms=90_000)
    cuts, totals, want = [], [("none", 200_000), ("zero", 0)], {("none", *x) for x in planned(400_000, [], 120_000, 30_000, 180_000)}
    for c in range(8):
        total = r.randrange(10_000, 900_000)
        mine = sorted({r.randrange(2 * total) for _ in range(r.randrange(40))})
        totals.append((f"c{c}", total))
        cuts += [(f"c{c}", x) for x in mine]
        want |= {(f"c{c}", *x) for x in planned(2 * total, mine, 120_000, 30_000, 180_000)}
    got = mining.plan_windows(spark.createDataFrame(cuts, "clip_id string, cut2 long"), spark.createDataFrame(totals, "clip_id string, total_ms long"), plan).collect()
    assert {(x.clip_id, x.a2, x.b2) for x in got} == want
    small = mining.plan_windows(spark.createDataFrame(cuts, "clip_id string, cut2 long"), spark.createDataFrame(totals, "clip_id string, total_ms long"), plan, block_ms=1).collect()
    assert sorted(map(tuple, small)) == sorted(map(tuple, got))  # blocks of twice the longest window
    assert all(x.win == sum(y.clip_id == x.clip_id and y.a2 < x.a2 for y in got) for x in got)


def test_backoff(spark):
    hits = [("a", t, i, k) for i, (t, k) in enumerate([(0.0, "rate"), (10.0, "rate"), (700.0, "wall"), (5000.0, "rate"), (5100.0, "rate")])] + [("b", 1.0, 0, "other")]
    got = replay_backoff(spark.createDataFrame(hits, "key string, at double, seq int, kind string")).orderBy("at").collect()
    # 10 + 600 = 610; 700 > 670 begins anew; 700 + 900 = 1600; 5000 > 1660 begins anew; 5100 within
    assert [(r.streak, r.pause) for r in got] == [(1, 300), (2, 600), (1, 900), (1, 300), (2, 600)]


def test_backoff_in_parts(spark):
    r = random.Random(11)
    hits, want = [], {}
    for key in "ab":
        t, own = 0.0, BackOff()
        for i in range(400):
            t += r.choice([5.0, 200.0, 900.0, 3000.0, 5461.0, 5459.0, 20_000.0])
            kind = r.choice(["rate", "wall"])
            hits.append((key, t, i, kind))
            want[key, t] = own.hit(t, kind)
    got = replay_backoff(spark.createDataFrame(hits, "key string, at double, seq int, kind string"), block_seconds=50_000).collect()
    assert {(x.key, x["at"]): (x.streak, x.pause, x.until) for x in got} == want
