"""Greedy folds over time lines: two-speaker runs, chunks of long runs, and training windows.

Runs come from window functions over blocks of a clip. Chunks and windows decide each step from the one before, which no window
function can state: segments of long runs are streamed in order through `mapInPandas` with a state of a few values, nothing of a
run is gathered. Windows are planned over sorted cut points in blocks of a clip at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Thresholds, WindowPlan
from ..runtime import cut
from .ordered import BLOCK_MS, blocked, scan
from .segments import COLUMNS, ORDER

PLAN_BLOCK_MS = 86_400_000
_MINED = "clip_id string, t0 long, t1 long, pair array<string>"


class _Chunks:
    """The open chunk of a long run, and the chunks before it."""

    def __init__(self, start: int):
        self.first = self.start = self.last = start
        self.speakers: set[str] = set()
        self.fresh = False

    def add(self, speaker: str, start: int, end: int, longest: int) -> list[tuple[int, int, list[str]]]:
        """The chunk that this segment closes, if it does."""
        if self.fresh:
            self.first, self.speakers, self.fresh = start, set(), False
        self.speakers.add(speaker)
        self.last = end
        if end - self.start < longest:
            return []
        done = [(self.first, end, sorted(self.speakers))]
        self.start, self.fresh = end, True
        return done

    def rest(self, least: int) -> list[tuple[int, int, list[str]]]:
        return [(self.first, self.last, sorted(self.speakers))] if not self.fresh and self.last - self.start >= least else []


def two_speaker_runs(segments: DataFrame, gap_ms: int = Thresholds.silence_gap_ms, block_ms: int = BLOCK_MS) -> DataFrame:
    """Each segment with its run: groups part at silences of gap_ms; inside a group a third speaker closes the run and begins the next alone.

    No fold is needed for that. Let a turn be a stretch of one speaker. A turn is a third one if its speaker is neither of the two turns
    before it (in its group). It closes the run exactly if the turn before it did not: a run that has just begun holds one speaker, so
    a third turn right after its first turn only brings the second speaker. In an unbroken series of third turns therefore the
    first, third, fifth ... close a run, which the turns' numbers tell.
    """
    by = ["clip_id"]
    rows = scan(blocked(segments.select(*COLUMNS), by, "start_ms", block_ms), by, ORDER, fields=["end_ms", "speaker"], prev="prev")
    opens = F.col("prev").isNull() | (F.col("start_ms") - F.col("prev.end_ms") >= gap_ms)
    rows = rows.select(*COLUMNS, "block", opens.alias("opens"), (~opens & (F.col("prev.speaker") != F.col("speaker"))).alias("changed"), F.col("prev.speaker").alias("was"))
    begins = F.col("opens") | F.col("changed")
    rows = scan(rows, by, ORDER, sums={"turn": begins.cast("int")}, maxima={"before": F.when(begins, F.struct(*ORDER, "changed", "was"))})
    third = F.coalesce(F.col("changed") & F.col("before.changed") & (F.col("before.was") != F.col("speaker")), F.lit(False))
    rows = blocked(cut(rows.select(*COLUMNS, "opens", begins.alias("begins"), third.alias("third"), "turn")), by, "start_ms", block_ms)
    rows = scan(rows, by, ORDER, maxima={"calm": F.when(F.col("begins") & ~F.col("third"), F.col("turn"))})
    closes = F.col("opens") | (F.col("third") & (F.pmod(F.col("turn") - F.col("calm"), F.lit(2)) == 1))
    return scan(rows.withColumn("closes", closes), by, ORDER, sums={"run": F.col("closes").cast("int")}).select(*COLUMNS, "run")


def mine_two_speaker(segments: DataFrame, min_ms: int = Thresholds.min_chunk_ms, max_ms: int = Thresholds.max_chunk_ms, gap_ms: int = Thresholds.silence_gap_ms, block_ms: int = BLOCK_MS) -> DataFrame:
    """(clip_id, t0, t1, pair): stretches in which exactly two people talk.

    Runs of two speakers (`two_speaker_runs`) of min_ms or more; runs longer than max_ms are closed into chunks whenever one has reached
    max_ms, and a rest under min_ms is dropped. Only segments of such long runs are folded, each run in order, with a state of a
    few values.
    """

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key = chunks = None
        for batch in batches:
            out = []
            for clip, run, start, end, speaker in zip(batch.clip_id, batch.run, batch.start_ms, batch.end_ms, batch.speaker, strict=True):
                if (clip, run) != key:
                    out += [(key[0], *w) for w in chunks.rest(min_ms)] if key else []
                    key, chunks = (clip, run), _Chunks(start)
                out += [(clip, *w) for w in chunks.add(speaker, start, end, max_ms)]
            yield pd.DataFrame(out, columns=["clip_id", "t0", "t1", "pair"])
        if key:
            yield pd.DataFrame([(key[0], *w) for w in chunks.rest(min_ms)], columns=["clip_id", "t0", "t1", "pair"])

    rows = cut(two_speaker_runs(segments, gap_ms, block_ms))
    runs = rows.groupBy("clip_id", "run").agg(F.min("start_ms").alias("t0"), F.max(F.struct(*ORDER, "end_ms"))["end_ms"].alias("t1"), F.array_sort(F.collect_set("speaker")).alias("pair"))  # two speakers at most
    runs = cut(runs.where((F.size("pair") == 2) & (F.col("t1") - F.col("t0") >= min_ms)))
    long = runs.where(F.col("t1") - F.col("t0") > max_ms).select("clip_id", "run")
    inside = rows.join(long, ["clip_id", "run"], "left_semi").repartition("clip_id", "run").sortWithinPartitions("clip_id", "run", *ORDER)
    chunks = inside.mapInPandas(fold, _MINED).where(F.col("t1") - F.col("t0") >= min_ms)
    return runs.where(F.col("t1") - F.col("t0") <= max_ms).select("clip_id", "t0", "t1", "pair").unionByName(chunks)


class _Plan:
    """The planner's place in one block of a clip; all lengths in half ms. Cuts come in order and are held only while in reach."""

    def __init__(self, total: int, pos: int, stop: int, plan: WindowPlan):
        self.total, self.pos, self.stop, self.held = total, pos, stop, []
        self.target, self.least, self.longest = 2 * plan.target_ms, 2 * plan.min_ms, 2 * plan.max_ms

    def settle(self, seen: float) -> list[tuple[int, int]]:
        """Spans that begin in the block and that no cut after `seen` can change."""
        out = []
        while self.pos < self.stop and self.total - self.pos > self.longest and seen >= self.pos + self.longest:
            ideal = self.pos + self.target
            near = [c for c in self.held if self.pos + self.least < c < self.pos + self.longest]
            end = min(near, key=lambda c: (abs(c - ideal), c)) if near else ideal
            out.append((self.pos, end))
            self.pos = end
            self.held = [c for c in self.held if c > end]
        return out

    def finish(self) -> list[tuple[int, int]]:
        """The rest, with the clip's last span where it begins in the block; pos is then where the next block begins, or the clip's end."""
        out = self.settle(np.inf)
        if self.pos < self.stop:
            out.append((self.pos, self.total))
            self.pos = self.total
        return out


def _plan_blocks(entries: DataFrame, cuts: DataFrame, plan: WindowPlan, block2: int) -> DataFrame:
    """(clip_id, block, a2, b2) of the spans that begin in each block of entries (clip_id, block, total2, pos), and where the next block is
    entered as a row without b2."""

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key = state = None
        for b in batches:
            out = []
            for clip, block, total, at, cut2 in zip(b.clip_id, b.block, b.total2, b["at"], b.cut2, strict=True):
                if (clip, block) != key:
                    if key:
                        out += [(*key, *s) for s in state.finish()] + [(*key, state.pos, None)]
                    key, state = (clip, block), _Plan(int(total), int(at), (block + 1) * block2, plan)
                if cut2 > state.pos:
                    out += [(clip, block, *s) for s in state.settle(cut2)]
                    state.held.append(cut2)
            yield _frame(out)
        if key:
            yield _frame([(*key, *s) for s in state.finish()] + [(*key, state.pos, None)])

    def _frame(rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=["clip_id", "block", "a2", "b2"]).astype({"b2": "Int64"})

    begin = entries.select("clip_id", "block", "total2", F.col("pos").alias("at"), F.lit(-1).cast("long").alias("cut2"))
    rows = cuts.join(entries, ["clip_id", "block"]).select("clip_id", "block", "total2", F.col("pos").alias("at"), "cut2").unionByName(begin)
    return rows.repartition("clip_id", "block").sortWithinPartitions("clip_id", "block", "cut2").mapInPandas(fold, "clip_id string, block long, a2 long, b2 long")


def plan_windows(cuts: DataFrame, totals: DataFrame, plan: WindowPlan = WindowPlan(), block_ms: int = PLAN_BLOCK_MS) -> DataFrame:
    """(clip_id, win, a2, b2) in half ms, from cuts (clip_id, cut2) and totals (clip_id, total_ms).

    From each bound the cut nearest to target among those between min and max is the next (ties to the left), or a hard cut at
    target; spans under min are dropped.

    A span's end is the next one's begin, yet a long clip is planned in blocks at once: each block is planned from a guess where it
    is entered, at its start; those that turn out to be entered elsewhere are planned again from there, until nothing changes. Plans from
    different places soon meet at a cut and are one from there on, so a block seldom hands a change on and few rounds are needed;
    the result is the same whatever their number. Inside a block cuts are streamed in order, with a state of a few values.
    """
    block2 = 2 * max(block_ms, 2 * plan.max_ms)
    block = F.floor(F.col("cut2") / block2)
    ahead = F.when(F.col("cut2") - block * block2 < 2 * plan.max_ms, F.array(block, block - 1)).otherwise(F.array(block))
    seen = cut(cuts.where("cut2 >= 0").select("clip_id", "cut2", F.explode(ahead).alias("block")).where("block >= 0"))
    every = totals.where("clip_id is not null and total_ms is not null").select("clip_id", (2 * F.col("total_ms")).cast("long").alias("total2"))
    last = F.greatest(F.lit(0), F.floor((F.col("total2") - 1) / block2))
    entries = cut(every.select("clip_id", "total2", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("block")).withColumn("pos", F.col("block") * block2))
    made = cut(_plan_blocks(entries, seen, plan, block2))
    while True:
        left = made.where("b2 is null").select("clip_id", (F.col("block") + 1).alias("block"), F.col("a2").alias("enters"))
        moved = cut(entries.join(left, ["clip_id", "block"]).where("enters <> pos").select("clip_id", "block", "total2", F.col("enters").alias("pos")))
        if not moved.limit(1).count():
            break
        keys = moved.select("clip_id", "block")
        made = cut(made.join(keys, ["clip_id", "block"], "left_anti").unionByName(_plan_blocks(moved, seen, plan, block2)))
        entries = cut(entries.join(keys, ["clip_id", "block"], "left_anti").unionByName(moved.select(*entries.columns)))
    spans = made.where(F.col("b2") - F.col("a2") >= 2 * plan.min_ms).select("clip_id", "a2", "b2")
    numbered = scan(blocked(spans, ["clip_id"], "a2", block2), ["clip_id"], ["a2"], sums={"n": F.lit(1)})
    return numbered.select("clip_id", (F.col("n") - 1).cast("int").alias("win"), "a2", "b2")
