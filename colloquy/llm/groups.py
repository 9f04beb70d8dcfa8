"""Problem 4: splits that keep related windows together.

Windows are tied to their source video, videos to their channel. Components come from Boruvka rounds: every component picks
its smallest incident edge (edges are in one total order: a hash, then the end points), the picked edges join the persisted
spanning forest, and the components along them are contracted. Each round is a few grouped minima and joins on checkpointed
tables and at least halves the components that still have edges, so a graph of n nodes needs log2(n) rounds at most.

Roots are stratified by size band (quarter powers of two of their windows) and dealt systematically in the order of band and hash, any
proportions to any number of sides. A root larger than half a small side's share would tear the proportions and stays in train.
Ranks come from counts per band and hash bucket, so no task ranks all roots.

Defined results: paths without a clip id of 11 characters or more are their own group (the path itself); null paths are left
out; repeated rows count as often as they occur for sizes; channels that are null tie nothing; empty tables give no rows.
A channel holding a third of all rows is one key only in minima and sums combined before the shuffle.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import cut, shared_path
from .naming import video_id
from .windows import clip_of_path

PROPORTIONS = {"train": 0.9, "val": 0.05, "test": 0.05}
BUCKET_BITS, GOLDEN, HEAVY = 10, 0.6180339887498949, 0.001


def spanning_forest(edges: DataFrame, folder: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(node, root) of every node and (a, b) of the forest, for an undirected edge table (a, b) of strings."""
    spark = edges.sparkSession
    folder = folder or shared_path(spark, "forest")
    clean = edges.select("a", "b").where("a is not null and b is not null and a <> b")
    clean = clean.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    live = cut(clean.select("a", "b", F.struct(F.xxhash64("a", "b").alias("h"), "a", "b").alias("edge")))
    nodes = edges.select(F.explode(F.array("a", "b")).alias("node")).where("node is not null").distinct()
    labels = cut(nodes.select("node", F.col("node").alias("root")))
    rounds = 0
    while live.limit(1).count():
        both = live.select(F.col("a").alias("u"), F.col("b").alias("v"), "edge").union(live.select("b", "a", "edge"))
        picks = cut(both.groupBy("u").agg(F.min(F.struct("edge", "v")).alias("p")).select("u", F.col("p.v").alias("v"), F.col("p.edge").alias("edge")))
        picks.select("edge.a", "edge.b").distinct().write.parquet(f"{folder}/round={rounds}")
        back = picks.select(F.col("u").alias("v"), F.col("v").alias("back"))
        parent = picks.join(back, "v", "left").select("u", F.when((F.col("back") == F.col("u")) & (F.col("u") < F.col("v")), F.col("u")).otherwise(F.col("v")).alias("up"))
        parent = cut(parent)
        while True:  # pointer doubling: each pass halves every path to the root
            further = parent.select(F.col("u").alias("up"), F.col("up").alias("next"))
            parent = cut(parent.join(further, "up").select("u", F.col("next").alias("up"), (F.col("next") != F.col("up")).alias("moved")))
            if not parent.where("moved").limit(1).count():
                break
        top = parent.select(F.col("u").alias("root"), F.col("up").alias("to"))
        labels = cut(labels.join(top, "root", "left").select("node", F.coalesce("to", "root").alias("root")))
        moved = live.join(parent.select(F.col("u").alias("a"), F.col("up").alias("ra")), "a").join(parent.select(F.col("u").alias("b"), F.col("up").alias("rb")), "b")
        live = cut(moved.where("ra <> rb").groupBy(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).agg(F.min("edge").alias("edge")))
        rounds += 1
    forest = spark.read.schema("a string, b string").parquet(folder).select("a", "b") if rounds else clean.limit(0)
    return labels, forest


def window_groups(train: DataFrame, videos: DataFrame, folder: str | None = None) -> DataFrame:
    """(path, split, vid, root, group_id) of each train row; group_id is the channel of its component, or its vid."""
    clip = clip_of_path(F.col("path"))
    rows = cut(train.select("path", "split", F.when(F.length(clip) >= 11, F.substring(clip, 1, 11)).alias("vid")).where("path is not null"))
    wanted = rows.select("vid").where("vid is not null").distinct()
    named = videos.select(video_id(F.col("vid"), F.col("url")).alias("vid"), "channel_id").where("vid is not null and channel_id is not null").distinct()
    ties = named.join(wanted, "vid", "left_semi").select(F.concat(F.lit("v:"), F.col("vid")).alias("a"), F.concat(F.lit("c:"), F.col("channel_id")).alias("b"))
    labels, _ = spanning_forest(cut(ties), folder)
    names = labels.groupBy("root").agg(F.min(F.when(F.col("node").startswith("c:"), F.substring("node", 3, 1 << 20))).alias("channel"))
    of_node = labels.join(names, "root").select(F.substring("node", 3, 1 << 20).alias("vid"), "root", "channel", F.col("node").startswith("v:").alias("video")).where("video").drop("video")
    grouped = rows.join(of_node, "vid", "left")
    return grouped.select("path", "split", "vid", F.coalesce("root", F.concat(F.lit("v:"), F.col("vid")), F.concat(F.lit("p:"), F.col("path"))).alias("root"), F.coalesce("channel", "vid", "path").alias("group_id"))


def torn_groups(grouped: DataFrame) -> DataFrame:
    """(group_id) of the groups whose rows carry two or more different non-null splits."""
    return grouped.groupBy("group_id").agg(F.min("split").alias("lo"), F.max("split").alias("hi")).where("lo <> hi").select("group_id")


def deal(sizes: DataFrame, proportions: dict[str, float] = PROPORTIONS, seed: int = 0) -> DataFrame:
    """(root, n, side) for (root, n): roots dealt systematically by size band; the first side takes what is too large for another.

    Root number r falls on the fraction of r times the golden ratio. Any stretch of neighbouring numbers spreads evenly over
    [0, 1) that way, so every side, given a stretch of [0, 1) as long as its proportion, gets its share of every size band. Heavy
    roots, each over the share HEAVY of all rows, come first; what they leave each side fixes the stretches for the others.
    """
    first, small = next(iter(proportions)), {s: p for s, p in list(proportions.items())[1:] if p > 0}
    sizes = cut(sizes.select("root", F.col("n").cast("long").alias("n"), F.xxhash64(F.lit(seed), "root").alias("h")))
    total = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("t")).first().t
    is_heavy = F.col("n") > F.lit(HEAVY * total)
    heavy, given = [], dict.fromkeys(proportions, 0)
    for r, row in enumerate(sizes.where(is_heavy).orderBy(F.desc("n"), "h", "root").collect(), 1):  # 1 / HEAVY rows at most
        place = r * GOLDEN % 1
        side = next((s for s, upto in zip(small, accumulate(small.values()), strict=True) if place < upto), first)
        if side != first and row.n > min(0.5 * small[side] * total, small[side] * total - given[side]):
            side = first
        given[side] += row.n
        heavy.append((row.root, row.n, side))
    rest = total - sum(given.values())
    open_ = {s: max(0.0, p * total - given[s]) / rest if rest else 0.0 for s, p in small.items()}
    scale = 1 / max(1.0, sum(open_.values()))
    order = sizes.where(~is_heavy).withColumn("band", F.floor(4 * F.log2("n"))).withColumn("bucket", F.shiftrightunsigned("h", 64 - BUCKET_BITS))
    counts = order.groupBy("band", "bucket").agg(F.count("*").alias("c"))
    before = Window.orderBy(F.desc("band"), "bucket").rowsBetween(Window.unboundedPreceding, -1)  # at most 256 bands x 2 ** BUCKET_BITS small rows
    starts = counts.select("band", "bucket", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("start"))
    rank = F.col("start") + F.row_number().over(Window.partitionBy("band", "bucket").orderBy("h", "root"))
    place, side = F.pmod(rank * F.lit(GOLDEN), F.lit(1.0)), F
    for name, upto in zip(open_, accumulate(open_.values()), strict=True):
        side = side.when(place < upto * scale, name)
    side = side.otherwise(first) if small else F.lit(first)
    dealt = order.join(starts, ["band", "bucket"]).select("root", "n", side.alias("side"))
    return dealt.unionByName(sizes.sparkSession.createDataFrame(heavy, "root string, n long, side string"))


def assign_splits(train: DataFrame, videos: DataFrame, seed: int = 0) -> DataFrame:
    """(path, vid, group_id, split, side): the present split and the side of each train row."""
    grouped = cut(window_groups(train, videos))
    sides = deal(grouped.groupBy("root").agg(F.count("*").alias("n")), seed=seed)
    return grouped.join(sides.select("root", "side"), "root").select("path", "vid", "group_id", "split", "side")
