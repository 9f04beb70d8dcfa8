"""Continuous periods, gaps and free starts of interval sets, by a sweep line.

Interval boundaries become +1/-1 events, pre-aggregated per entity and moment, so repeated rows never reach one task. The
prefix sums run in two levels: the time line of an entity is cut into blocks of `block_ms`; totals per block are summed over
the (few) blocks of an entity, sums inside a block run per (entity, block). A single endless entity is therefore spread over
as many tasks as its time line has blocks.

Defined results: rows with a null entity or bound, or with an end not after the start, cover nothing; touching intervals
belong to one period; repeated rows count once; an empty table gives an empty result. Only the named columns are read, so
further columns of any name do no harm.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordered import BLOCK_MS, blocked, scan


def valid_intervals(df: DataFrame, entity: str = "clip_id", start: str = "start_ms", end: str = "end_ms") -> DataFrame:
    """(entity, start, end) of the rows that make an interval; times as long."""
    rows = df.select(F.col(entity).alias("entity"), F.col(start).cast("long").alias("start"), F.col(end).cast("long").alias("end"))
    return rows.where(F.col("entity").isNotNull() & (F.col("end") > F.col("start")))


def sweep(df: DataFrame, entity: str = "clip_id", start: str = "start_ms", end: str = "end_ms", block_ms: int = BLOCK_MS) -> DataFrame:
    """(entity, block, t, before, active): the number of running intervals just before and from each moment at which it changes."""
    moments = F.explode(F.array(F.struct(F.col("start").alias("t"), F.lit(1).alias("d")), F.struct(F.col("end").alias("t"), F.lit(-1).alias("d"))))
    events = valid_intervals(df, entity, start, end).select("entity", moments.alias("e")).groupBy("entity", F.col("e.t").alias("t")).agg(F.sum("e.d").alias("d")).where("d <> 0")
    rows = scan(blocked(events, ["entity"], "t", block_ms), ["entity"], ["t"], sums={"active": F.col("d")})
    return rows.select("entity", "block", "t", (F.col("active") - F.col("d")).alias("before"), "active")


def silences(df: DataFrame, totals: DataFrame, entity: str = "clip_id", start: str = "start_ms", end: str = "end_ms", block_ms: int = BLOCK_MS) -> DataFrame:
    """(entity, a, b): the gaps, and the stretches before the first and after the last interval, up to the entity's total_ms.

    All come from one pass over the edges of the periods; totals (entity, total_ms) travel with the summary of the blocks. Entities
    without a total or without intervals have none.
    """
    edges = sweep(df, entity, start, end, block_ms).where("before = 0 or active = 0").select("entity", "block", "t", (F.col("before") == 0).alias("opens"))
    rows = scan(edges, ["entity"], ["t"], prev="prev", nxt="nxt", extra=(totals.select(F.col(entity).alias("entity"), "total_ms"), ["entity"]))
    stretch = lambda when, a, b: F.when(when, F.struct(a.cast("long").alias("a"), b.cast("long").alias("b")))
    t, last = F.col("t"), F.col("nxt").isNull()
    found = F.array(stretch(F.col("prev").isNull(), F.lit(0), t), stretch(~F.col("opens") & ~last, t, F.col("nxt.t")), stretch(last, t, F.col("total_ms")))
    return rows.select("entity", F.explode(F.filter(found, lambda s: s.isNotNull())).alias("s")).select("entity", "s.a", "s.b")


def periods_and_gaps(df: DataFrame, entity: str = "clip_id", start: str = "start_ms", end: str = "end_ms", block_ms: int = BLOCK_MS) -> DataFrame:
    """(entity, kind, start_ms, end_ms): kind 'period' for covered stretches at full length, 'gap' for the stretches between."""
    edges = sweep(df, entity, start, end, block_ms).where("before = 0 or active = 0").select("entity", "block", "t", (F.col("before") == 0).alias("opens"))
    paired = scan(edges, ["entity"], ["t"], nxt="nxt").where("nxt is not null")
    return paired.select("entity", F.when(F.col("opens"), "period").otherwise("gap").alias("kind"), F.col("t").alias("start_ms"), F.col("nxt.t").alias("end_ms"))


def free_starts(df: DataFrame, entity: str = "clip_id", start: str = "start_ms", end: str = "end_ms", block_ms: int = BLOCK_MS) -> DataFrame:
    """(entity, at, silence): starts at which no earlier-started interval is still running, with the silence before them.

    The first start of an entity is free; its silence counts from 0 and is never negative.
    """
    starts = valid_intervals(df, entity, start, end).groupBy("entity", F.col("start").alias("t")).agg(F.max("end").alias("end"))
    rows = scan(blocked(starts, ["entity"], "t", block_ms), ["entity"], ["t"], maxima={"reach": F.col("end")}).where("reach is null or reach <= t")
    return rows.select("entity", F.col("t").alias("at"), F.greatest(F.lit(0), F.col("t") - F.coalesce("reach", F.lit(0))).alias("silence"))
