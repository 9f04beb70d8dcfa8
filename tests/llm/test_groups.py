from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from colloquy.llm import groups

TRAIN = "path string, split string, root string, vid string"
VIDEOS = "vid string, url string, channel_id string, path string"


def components(edges):
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        if a is not None and b is not None:
            up[find(a)] = find(b)
        else:
            find(a if a is not None else b) if (a is not None or b is not None) else None
    return {x: find(x) for x in up}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_forest(spark, seed):
    r = random.Random(seed)
    edges = [(f"n{r.randrange(60)}", f"n{r.randrange(60)}") for _ in range(55)] + [("hub", f"n{i}") for i in range(0, 60, 9)] + [("x", "x"), (None, "y"), ("p0", "p1")] + [(f"p{i}", f"p{i + 1}") for i in range(20)]
    labels, forest = groups.spanning_forest(spark.createDataFrame(edges, "a string, b string"))
    got, want = {x.node: x.root for x in labels.collect()}, components(edges)
    assert set(got) == set(want)
    assert {frozenset(n for n in got if got[n] == k) for k in set(got.values())} == {frozenset(n for n in want if want[n] == k) for k in set(want.values())}
    kept = [tuple(e) for e in forest.distinct().collect()]
    assert len(kept) == len(got) - len(set(got.values()))  # a forest: one edge less than nodes, in every tree
    assert {frozenset(n for n in got if got[n] == k) for k in set(got.values()) if sum(v == k for v in got.values()) > 1} == {frozenset(n for n, v in components(kept).items() if v == k) for k in set(components(kept).values())}


def test_groups_and_sides(spark):
    vids = [f"vid{i:08d}" for i in range(300)]
    videos = [(v, None, None if i % 3 == 0 else f"CN{i % 40}", "x") for i, v in enumerate(vids)] + [(None, f"https://a.example/watch?v={vids[0]}", "CN1", "x"), (None, None, "CN9", "x"), (vids[1], None, None, "x")]
    r = random.Random(1)
    train = [(f"d/{v}_seg{k}_{k:04d}.wav", "val" if r.random() < 0.01 else "train" if r.random() < 0.9 else None, "x", "y") for v in vids for k in range(r.randrange(1, 7))] + [("odd", "train", "x", "y"), (None, "val", "x", "y")]
    t, v = spark.createDataFrame(train + train[:5], TRAIN), spark.createDataFrame(videos, VIDEOS)
    rows = groups.assign_splits(t, v).collect()
    assert len(rows) == len(train) + 4
    channel = {x: c for x, u, c, _ in videos if x and c} | {vids[0]: "CN1"}
    assert all(x.group_id == (channel.get(x.path[2:13], x.path[2:13]) if x.path != "odd" else "odd") for x in rows)
    sides = {}
    for x in rows:
        sides.setdefault(x.group_id, set()).add(x.side)
    assert all(len(s) == 1 for s in sides.values())
    share = {s: sum(x.side == s for x in rows) / len(rows) for s in ("train", "val", "test")}
    assert abs(share["val"] - 0.05) < 0.02 and abs(share["test"] - 0.05) < 0.02
    torn = {x.group_id for x in groups.torn_groups(groups.window_groups(t, v)).collect()}
    by = {}
    for p, s, *_ in train:
        if p and s:
            by.setdefault(channel.get(p[2:13], p[2:13]), set()).add(s)
    assert torn == {g for g, s in by.items() if len(s) > 1}
    assert groups.torn_groups(groups.window_groups(spark.createDataFrame([], TRAIN), v)).count() == 0
    assert groups.assign_splits(spark.createDataFrame([], TRAIN), spark.createDataFrame([], VIDEOS)).count() == 0


def test_dealing_keeps_proportions(spark):
    r = random.Random(2)
    sizes = [(f"r{i}", int(r.paretovariate(1.2))) for i in range(4000)] + [("huge", 9000)]
    got = groups.deal(spark.createDataFrame(sizes, "root string, n long")).collect()
    total = sum(n for _, n in sizes)
    assert len(got) == len(sizes) and next(x.side for x in got if x.root == "huge") == "train"
    for side in ("val", "test"):
        assert abs(sum(x.n for x in got if x.side == side) / total - 0.05) < 0.01


def test_dealing_any_proportions(spark):
    r = random.Random(4)
    sizes = spark.createDataFrame([(f"r{i}", int(r.paretovariate(1.5))) for i in range(6000)], "root string, n long").cache()
    total = sizes.groupBy().sum("n").first()[0]
    for shares in ({"train": 0.8, "val": 0.12, "test": 0.08}, {"a": 0.5, "b": 0.5}, {"a": 0.34, "b": 0.33, "c": 0.2, "d": 0.13}, {"train": 0.97, "val": 0.03, "none": 0.0}, {"all": 1.0}):
        got = {x.side: x.n for x in groups.deal(sizes, shares).groupBy("side").agg(F.sum("n").alias("n")).collect()}
        assert set(got) == {s for s, p in shares.items() if p > 0}
        assert all(abs(got[s] / total - p) < 0.01 for s, p in shares.items() if p > 0), (shares, got)
