"""Problem 1: cutting oversized training windows at natural boundaries.

A window longer than the limit is cut into pieces; each piece after the first begins `overlap_ms` before the end of the one
before. Cuts fall on free starts (starts of valid segments during which no earlier segment runs), the strongest one, by the
silence before it, of each permissible range of lengths; ties go to the right. Where a range has none, the cut is hard, at
the limit. Only boundaries later than begin + overlap are permissible, so every piece makes progress; with such cuts a window
is cut without a hard cut exactly if cutting at natural boundaries alone can keep every piece within the limit: in that case
two neighbouring boundaries are never further apart than limit - overlap, and the next range always holds one.

Range queries use a sparse table over the strengths of a window's boundaries (argmax of each power-of-two stretch), built per
window with numpy: O(n log n) to build, O(1) a query.

Defined results: rows with a null path, offset or length are not windows; equal paths are taken once (the longest row, then
the earliest offset); a clip without segments gives hard cuts only; empty tables give no rows. A window's boundaries are
gathered per window, found by joining on (clip, block of time): memory follows one window's length, never a clip's.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.coverage import free_starts

LIMIT_MS, OVERLAP_MS, LEAST_MS, BLOCK_MS = 180_000, 2_000, 90_000, 600_000


def clip_of_path(path: Column) -> Column:
    """The clip id of a window's path: its file name without extension and number, whichever way the path is written."""
    name = F.regexp_extract(F.translate(F.trim(path), "\\", "/"), r"([^/]*)$", 1)
    clip = F.regexp_extract(name, r"^(.+)_\d+(?:\.[A-Za-z0-9]+)?\s*$", 1)
    return F.when(clip != "", clip)


def oversized(train: DataFrame, limit_ms: int = LIMIT_MS) -> DataFrame:
    """(path, clip, begin, finish) of each distinct path whose window is longer than the limit."""
    length = F.coalesce(F.col("n_frames") * F.lit(80), F.round(F.col("duration") * 1000).cast("long"))
    rows = train.select("path", clip_of_path(F.col("path")).alias("clip"), F.col("offset_ms").cast("long").alias("begin"), length.cast("long").alias("length"))
    rows = rows.where(F.col("path").isNotNull() & F.col("begin").isNotNull() & (F.col("length") > limit_ms))
    best = rows.groupBy("path", "clip").agg(F.max(F.struct(F.col("length"), (-F.col("begin")).alias("early"))).alias("w"))
    return best.select("path", "clip", (-F.col("w.early")).alias("begin"), (F.col("w.length") - F.col("w.early")).alias("finish"))


class SparseTable:
    """Range-maximum index; argmax(lo, hi) is the rightmost strongest position of [lo, hi)."""

    def __init__(self, strength: np.ndarray):
        self.strength = strength
        self.levels = [np.arange(len(strength))]
        step = 1
        while 2 * step <= len(strength):
            a, b = self.levels[-1][:-step], self.levels[-1][step:]
            self.levels.append(np.where(strength[a] > strength[b], a, b))
            step *= 2

    def argmax(self, lo: int, hi: int) -> int:
        k = (hi - lo).bit_length() - 1
        a, b = self.levels[k][lo], self.levels[k][hi - (1 << k)]
        return int(a if self.strength[a] > self.strength[b] else b)


def cut_window(begin: int, finish: int, at: np.ndarray, strength: np.ndarray, limit: int = LIMIT_MS, overlap: int = OVERLAP_MS, least: int = LEAST_MS) -> list[tuple[int, int, bool]]:
    """Pieces (start, end, ended by a hard cut) of one window; `at` ascending, strictly inside the window."""
    pieces, index = [], SparseTable(strength) if len(at) else None
    while finish - begin > limit:
        lo, mid, hi = (int(np.searchsorted(at, x, side)) for x, side in ((begin + overlap, "right"), (begin + least, "left"), (begin + limit, "right")))
        mid = max(lo, mid)
        first, last = (mid, hi) if mid < hi else (lo, hi)
        hard = first >= last
        end = begin + limit if hard else int(at[index.argmax(first, last)])
        pieces.append((begin, end, hard))
        begin = end - overlap
    return [*pieces, (begin, finish, False)]


def pieces(train: DataFrame, segments: DataFrame, limit_ms: int = LIMIT_MS, overlap_ms: int = OVERLAP_MS, least_ms: int = LEAST_MS, block_ms: int = BLOCK_MS) -> DataFrame:
    """(path, clip_id, kind, piece, start_ms, end_ms, cut): the pieces of each oversized window; cut tells how a piece ends."""
    windows = oversized(train, limit_ms)
    blocks = windows.withColumn("block", F.explode(F.sequence(F.floor(F.col("begin") / block_ms), F.floor(F.col("finish") / block_ms))))
    bounds = free_starts(segments).withColumnRenamed("entity", "clip").withColumn("block", F.floor(F.col("at") / block_ms))
    inside = blocks.join(bounds, ["clip", "block"]).where("at > begin and at < finish")
    found = inside.groupBy("path").agg(F.array_sort(F.collect_list(F.struct("at", "silence"))).alias("b"))
    rows = windows.join(found, "path", "left").select("path", "clip", "begin", "finish", F.col("b.at").alias("at"), F.col("b.silence").alias("silence"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for r in batch.itertuples(index=False):
                at = np.asarray(r.at if r.at is not None else [], dtype=np.int64)
                strength = np.asarray(r.silence if r.silence is not None else [], dtype=np.int64)
                cuts = cut_window(int(r.begin), int(r.finish), at, strength, limit_ms, overlap_ms, least_ms)
                kind = "hard" if any(h for *_, h in cuts) else "natural"
                out += [(r.path, r.clip, kind, i, s, e, "end" if i + 1 == len(cuts) else "hard" if h else "natural") for i, (s, e, h) in enumerate(cuts)]
            yield pd.DataFrame(out, columns=["path", "clip_id", "kind", "piece", "start_ms", "end_ms", "cut"])

    return rows.mapInPandas(run, "path string, clip_id string, kind string, piece int, start_ms long, end_ms long, cut string")
