"""Sampled channels as arrays: levels, gains, similarity, stitching; numpy only where a fold over overlapping spans is needed."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import cut
from .ordered import blocked, scan


def _total(x: Column, f) -> Column:
    return F.aggregate(x, F.lit(0.0), lambda a, v: a + f(v.cast("double")))


def rms(x: Column) -> Column:
    """Root mean square; 0 for an empty array, null for null."""
    return F.coalesce(F.sqrt(F.try_divide(_total(x, lambda v: v * v), F.size(x))), F.when(x.isNotNull(), F.lit(0.0)))


def peak(x: Column, floor: float = 1e-6) -> Column:
    return F.greatest(F.coalesce(F.array_max(F.transform(x, lambda v: F.abs(v.cast("double")))), F.lit(0.0)), F.lit(floor))


def scaled(x: Column, gain: Column) -> Column:
    return F.transform(x, lambda v: v.cast("double") * gain)


def peak_normalised(x: Column, level: float = 0.9) -> Column:
    return scaled(x, F.lit(level) / peak(x))


def rms_normalised(x: Column, level: float = 0.05, ceiling: float = 0.99) -> Column:
    """Brought to the level, then under the ceiling; unchanged if (nearly) silent."""
    gain = F.lit(level) / rms(x)
    loud = peak(x, 0.0) * gain
    return F.when(rms(x) < 1e-6, scaled(x, F.lit(1.0))).otherwise(scaled(x, gain * F.when(loud > ceiling, F.lit(ceiling) / loud).otherwise(F.lit(1.0))))


def similarity(x: Column, y: Column, least: float = 1e-8) -> Column:
    """Mean-centred normalised correlation over the common length; 0 where a channel does not vary."""
    n = F.least(F.size(x), F.size(y))
    x, y = F.slice(x, 1, n), F.slice(y, 1, n)
    mx, my = F.try_divide(_total(x, lambda v: v), n), F.try_divide(_total(y, lambda v: v), n)
    xy = F.aggregate(F.zip_with(x, y, lambda a, b: (a.cast("double") - mx) * (b.cast("double") - my)), F.lit(0.0), lambda s, v: s + v)
    norm = F.sqrt(_total(x, lambda v: (v - mx) * (v - mx))) * F.sqrt(_total(y, lambda v: (v - my) * (v - my)))
    return F.when(norm > least, xy / norm).otherwise(0.0)


def swapped(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    """Whether the second chunk's channels fit the first's better when exchanged."""
    return similarity(a0, b1) + similarity(a1, b0) > similarity(a0, b0) + similarity(a1, b1)


def crossfade(x: Column, y: Column, n: int) -> Column:
    """x then y with a linear crossfade over the last n samples of x and the first n of y."""
    step = F.lit(float(max(1, n - 1)))
    ramp = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: i / step)
    both = F.zip_with(F.slice(x, F.size(x) - n + 1, n), F.slice(y, 1, n), lambda a, b: F.struct(a.cast("double").alias("a"), b.cast("double").alias("b")))
    mixed = F.zip_with(both, ramp, lambda p, r: p["a"] * (1 - r) + p["b"] * r)
    return F.concat(F.transform(F.slice(x, 1, F.size(x) - n), lambda v: v.cast("double")), mixed, F.transform(F.slice(y, n + 1, F.size(y)), lambda v: v.cast("double")))


def pair_channels(rows: DataFrame) -> DataFrame:
    """(clip_id, ch0, ch1) of one row a channel (clip_id, channel, samples): the two channels side by side; a missing one is null."""
    of = lambda k: F.max(F.when(F.col("channel") == k, F.struct("samples")))["samples"].alias(f"ch{k}")
    return rows.where("channel in (0, 1)").groupBy("clip_id").agg(of(0), of(1))


def stitch(chunks: DataFrame, overlap: int, block: int = 256) -> DataFrame:
    """(clip_id, i, swapped, ch0, ch1) of two-channel chunks (clip_id, i, ch0, ch1), each overlapping the one before by `overlap` samples.

    Channels of a chunk may come exchanged; each chunk is turned to fit the stitched one before it, and the overlap is faded over.
    Concatenated in order, the pieces are the stitched clip. No chunk waits for the one before: a comparison of two raw chunks tells
    whether they differ, so a chunk is exchanged if an odd number of such differences lies before it (counted anew after a tie,
    at which a chunk stays as it is). Only ends of chunks pass between rows, never a stitched clip. Chunks but the last have at
    least `overlap` samples; a shorter last one overlaps with all it has.
    """
    by, at, n = ["clip_id"], ["i"], F.size("ch0")
    ends = {f"head{k}": F.slice(f"ch{k}", 1, overlap) for k in (0, 1)} | {f"tail{k}": F.slice(f"ch{k}", F.greatest(F.lit(1), n - overlap + 1), F.lit(overlap)) for k in (0, 1)}
    rows = blocked(chunks.select("clip_id", F.col("i").cast("long").alias("i"), "ch0", "ch1").withColumns(ends | {"n": n}), by, "i", block)
    rows = scan(rows, by, at, fields=["tail0", "tail1", "n"], prev="before", nxt="after")
    first, met = F.col("before").isNull(), F.least(F.size("before.tail0"), F.size("head0"))
    tail = lambda k: F.slice(F.col(f"before.tail{k}"), F.size("before.tail0") - met + 1, met)
    head = lambda k: F.slice(F.col(f"head{k}"), F.lit(1), met)
    crossed, direct = (similarity(tail(0), head(j)) + similarity(tail(1), head(1 - j)) for j in (1, 0))
    rows = rows.withColumns({"met": met, "crossed": crossed, "direct": direct})
    rows = rows.withColumns({"differs": F.when(~first & (F.col("crossed") > F.col("direct")), 1).otherwise(0), "anew": first | (F.col("crossed") == F.col("direct"))})
    flags = cut(rows.select(*by, "block", *at, "differs", "anew"))  # a few bytes a chunk; what follows does not carry samples
    flags = cut(scan(flags, by, at, sums={"odd": F.col("differs")}))
    flags = scan(flags, by, at, maxima={"mark": F.when(F.col("anew"), F.struct("i", "odd"))})
    since = F.when(F.col("anew"), F.col("odd")).otherwise(F.col("mark.odd"))
    flags = cut(flags.select(*by, "block", *at, (F.pmod(F.col("odd") - since, F.lit(2)) == 1).alias("swapped")))
    flags = scan(flags, by, at, fields=["swapped"], prev="ahead").select(*by, "block", *at, "swapped", "ahead")
    rows = rows.join(flags, [*by, "block", *at])
    own = lambda name, k: F.when(F.col("swapped"), F.col(f"{name}{1 - k}")).otherwise(F.col(f"{name}{k}"))
    was = lambda k: F.when(F.col("ahead.swapped"), tail(1 - k)).otherwise(tail(k))
    ramp = lambda j: (j - 1) / F.greatest(F.lit(1), F.col("met") - 1)

    def piece(k: int) -> Column:
        samples = F.transform(own("ch", k), lambda v: v.cast("double"))
        pairs = F.transform(F.sequence(F.lit(1), F.col("met")), lambda j: F.element_at("__was", j) * (1 - ramp(j)) + F.element_at("__own", j) * ramp(j))
        faded = F.when(F.col("met") > 0, pairs).otherwise(F.array().cast("array<double>"))
        body = F.when(first, F.col("__own")).otherwise(F.concat(faded, F.slice("__own", F.col("met") + 1, F.col("n"))))
        nonlocal rows
        rows = rows.withColumns({"__own": samples, "__was": was(k)})
        rows = rows.withColumn(f"out{k}", F.slice(body, F.lit(1), F.col("n") - F.coalesce(F.least(F.lit(overlap), F.col("after.n"), F.col("n")), F.lit(0)) * F.col("after").isNotNull().cast("int")))
        return F.col(f"out{k}").alias(f"ch{k}")

    pieces = [piece(0), piece(1)]
    return rows.select("clip_id", "i", "swapped", *pieces)


def fit_length(x: Column, n: int) -> Column:
    """Cut or padded with zeros to n samples."""
    x = F.transform(x, lambda v: v.cast("double"))
    return F.slice(F.concat(x, F.array_repeat(F.lit(0.0), F.greatest(F.lit(0), F.lit(n) - F.size(x)))), 1, n)


def mono(x: Column, y: Column) -> Column:
    return F.zip_with(x, y, lambda a, b: (a.cast("double") + b.cast("double")) / 2)


def stereo(x: Column, y: Column) -> Column:
    return F.zip_with(x, y, lambda a, b: F.struct(a.alias("left"), b.alias("right")))


def time_slice(x: Column, rate: int, t0: Column, t1: Column) -> Column:
    """Samples of [t0, t1) seconds; the start is not before 0."""
    lo = F.greatest(F.lit(0), F.floor(t0 * rate)).cast("int")
    return F.slice(x, lo + 1, F.greatest(F.lit(0), F.floor(t1 * rate).cast("int") - lo))


def speech_ratio(df: DataFrame, total: str) -> DataFrame:
    """(clip_id, speech_ratio) of (clip_id, start_ms, end_ms, total): summed lengths over the total; 0 where that is 0."""
    return df.groupBy("clip_id").agg(F.coalesce(F.try_divide(F.sum(F.col("end_ms") - F.col("start_ms")), F.max(total)), F.lit(0.0)).alias("speech_ratio"))


def talkative_channel(shares: Column, mode: str = "talkative", key: Column | None = None) -> Column:
    """0 or 1: the channel to train on. talkative: of exactly two shares (in key order) the larger; random: by hash of key."""
    if mode in ("0", "1"):
        return F.lit(int(mode))
    if mode == "random":
        return F.pmod(F.xxhash64(key), F.lit(2)).cast("int")
    ordered = F.transform(F.array_sort(F.map_entries(shares)), lambda e: e["value"])
    return F.when(F.size(shares) != 2, 0).when(F.element_at(ordered, 1) >= F.element_at(ordered, 2), 0).otherwise(1)


def mask_channel(x: np.ndarray, spans: list[tuple[int, int]], ramp: int) -> np.ndarray:
    """x inside the spans with linear ramps at their ends (for spans longer than two ramps); where spans meet the larger value stays."""
    out = np.zeros_like(x)
    for a, b in spans:
        a, b = max(0, a), min(len(x), b)
        if b <= a:
            continue
        part = x[a:b].copy()
        if ramp and b - a > 2 * ramp:
            up = np.linspace(0.0, 1.0, ramp, dtype=x.dtype)
            part[:ramp] *= up
            part[-ramp:] *= up[::-1]
        out[a:b] = np.where(np.abs(part) >= np.abs(out[a:b]), part, out[a:b])
    return out


def mask_channels(df: DataFrame, rate: int = 16_000, ramp_ms: int = 20) -> DataFrame:
    """(clip_id, speaker, samples) from (clip_id, speaker, samples, spans array<struct<start_ms,end_ms>>)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = [mask_channel(np.asarray(x, np.float32), [(int(s["start_ms"]) * rate // 1000, int(s["end_ms"]) * rate // 1000) for s in spans], ramp_ms * rate // 1000) for x, spans in zip(b.samples, b.spans, strict=True)]
            yield pd.DataFrame({"clip_id": b.clip_id, "speaker": b.speaker, "samples": out})

    return df.select("clip_id", "speaker", "samples", "spans").where("samples is not null and spans is not null").mapInPandas(run, "clip_id string, speaker string, samples array<float>")


def resample_array(x: np.ndarray, source: int, target: int, taps: int = 32) -> np.ndarray:
    """Band-limited resampling by windowed sinc interpolation; blocks of outputs, so memory is bounded by taps times the block."""
    if source == target or not len(x):
        return x.astype(np.float32)
    n, cutoff = math.ceil(len(x) * target / source), min(1.0, target / source)
    half = math.ceil(taps / cutoff)
    padded = np.pad(x.astype(np.float64), half)
    out = np.empty(n, np.float32)
    for lo in range(0, n, 65_536):
        at = np.arange(lo, min(n, lo + 65_536)) * source / target
        base = np.floor(at).astype(np.int64)
        k = np.arange(-half + 1, half + 1)
        d = at[:, None] - (base[:, None] + k)
        w = cutoff * np.sinc(cutoff * d) * (0.5 + 0.5 * np.cos(np.pi * np.clip(d / half, -1, 1)))
        out[lo : lo + len(at)] = (padded[base[:, None] + k + half] * w).sum(1)
    return out


def resample(df: DataFrame, target: int) -> DataFrame:
    """(clip_id, samples, rate) at the target rate."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"clip_id": b.clip_id, "samples": [resample_array(np.asarray(x, np.float32), int(r), target) for x, r in zip(b.samples, b.rate, strict=True)], "rate": target})

    return df.select("clip_id", "samples", "rate").where("samples is not null").mapInPandas(run, "clip_id string, samples array<float>, rate int")
