"""Ordered operations on time lines that may be too long for one task.

A plain window partitioned by clip puts an endless clip into a single task. Here the time line is cut into blocks of `block_ms`;
windows run per (key, block), and what crosses a block's edge comes from a summary with one row per block, joined back. Rows are
partitioned by (key, block) once; the windows, the summary and the join all use that partitioning, so `scan` adds only the
exchange of the summary.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_MS = 3_600_000


def blocked(df: DataFrame, by: list[str], t: str, block_ms: int = BLOCK_MS) -> DataFrame:
    """The rows with a key and a time, with their block, partitioned by both.

    Keys and blocks are made non-nullable: else the optimizer adds null filters to one side of the summary's join only, the two
    sides differ, and what comes before is computed twice instead of reusing its exchange.
    """
    present = df.where(" and ".join(f"`{c}` is not null" for c in [*by, t]))
    keys = {c: F.coalesce(F.col(c), F.lit("")) for c, kind in df.select(*by).dtypes if kind == "string"}
    block = F.coalesce(F.floor(F.col(t) / F.lit(block_ms)).cast("long"), F.lit(0))
    return present.withColumns({**keys, "block": block}).repartition(*by, "block")


def scan(df: DataFrame, by: list[str], order: list[str], sums: dict[str, Column] | None = None, fields: list[str] | None = None, prev: str | None = None, nxt: str | None = None, maxima: dict[str, Column] | None = None, minima: dict[str, Column] | None = None, wholes: dict[str, Column] | None = None, extra: tuple[DataFrame, list[str]] | None = None, peers: bool = False) -> DataFrame:
    """One pass in each key's order over blocked rows (order[0] is the time that fixes the block). Adds

    sums: inclusive running sums of integer values; maxima: maxima over the rows before; minima: minima over the rows after; prev,
    nxt: structs of the order and fields of the neighbouring rows, null at the ends; wholes: sums over the whole key; extra: columns
    of a table with one row per key (or part of it), joined by the listed columns. Values are expressions over the row alone.
    peers: sums take in all rows of the same order, not only those that happen to come first.
    """
    sums, maxima, minima, wholes = sums or {}, maxima or {}, minima or {}, wholes or {}
    row = F.struct(*order, *[f for f in fields or [] if f not in order])
    inside = Window.partitionBy(*by, "block").orderBy(*order)
    upto, before, after = (inside.rowsBetween(a, b) for a, b in ((Window.unboundedPreceding, 0), (Window.unboundedPreceding, -1), (1, Window.unboundedFollowing)))
    upto = inside.rangeBetween(Window.unboundedPreceding, Window.currentRow) if peers else upto
    along = Window.partitionBy(*by).orderBy("block")
    earlier, later = along.rowsBetween(Window.unboundedPreceding, -1), along.rowsBetween(1, Window.unboundedFollowing)
    totals = [F.sum(v).alias(f"__s_{n}") for n, v in sums.items()] + [F.max(v).alias(f"__m_{n}") for n, v in maxima.items()] + [F.min(v).alias(f"__n_{n}") for n, v in minima.items()]
    totals += [F.sum(v).alias(f"__w_{n}") for n, v in wholes.items()]
    totals += [F.max(row).alias("__last")] * bool(prev) + [F.min(row).alias("__first")] * bool(nxt)
    edge = [F.coalesce(F.sum(f"__s_{n}").over(earlier), F.lit(0)).alias(f"__s_{n}") for n in sums] + [F.max(f"__m_{n}").over(earlier).alias(f"__m_{n}") for n in maxima] + [F.min(f"__n_{n}").over(later).alias(f"__n_{n}") for n in minima]
    edge += [F.sum(f"__w_{n}").over(Window.partitionBy(*by)).alias(n) for n in wholes]
    edge += [F.lag("__last").over(along).alias("__last")] * bool(prev) + [F.lead("__first").over(along).alias("__first")] * bool(nxt)
    totals.append(F.max(order[0]).alias("__at"))  # reads the time too, so that both sides of the join may share one exchange
    carried = df.groupBy(*by, "block").agg(*totals).where("__at is not null").select(*by, "block", *edge)
    if extra:
        carried = carried.join(extra[0], extra[1])
    new = {n: F.col(f"__s_{n}") + F.sum(v).over(upto) for n, v in sums.items()} | {n: F.greatest(F.col(f"__m_{n}"), F.max(v).over(before)) for n, v in maxima.items()}
    new |= {n: F.least(F.col(f"__n_{n}"), F.min(v).over(after)) for n, v in minima.items()}
    if prev:
        new[prev] = F.coalesce(F.lag(row).over(inside), F.col("__last"))
    if nxt:
        new[nxt] = F.coalesce(F.lead(row).over(inside), F.col("__first"))
    drop = [f"__s_{n}" for n in sums] + [f"__m_{n}" for n in maxima] + [f"__n_{n}" for n in minima] + ["__last", "__first"]
    return df.join(carried, [*by, "block"]).withColumns(new).drop(*drop)


def steps(intervals: DataFrame, by: list[str], start: str = "start_ms", end: str = "end_ms", block_ms: int = BLOCK_MS) -> DataFrame:
    """(by, block, t, d, active, ms): at each boundary the change and number of running intervals, and the time since the boundary before.

    Boundaries are pre-aggregated per moment, so repeated rows never meet in one task.
    """
    moments = F.explode(F.array(F.struct(F.col(start).alias("t"), F.lit(1).alias("d")), F.struct(F.col(end).alias("t"), F.lit(-1).alias("d"))))
    events = intervals.select(*by, moments.alias("e")).groupBy(*by, F.col("e.t").alias("t")).agg(F.sum("e.d").alias("d"))
    rows = scan(blocked(events, by, "t", block_ms), by, ["t"], sums={"active": F.col("d")}, prev="prev")
    return rows.withColumn("ms", F.coalesce(F.col("t") - F.col("prev.t"), F.lit(0))).drop("prev")


def ratio(n: Column, d: Column, places: int) -> Column:
    """n / d of integers, rounded half up to places in integer arithmetic (exact, the same in every engine); null where d is 0."""
    scale = 10**places
    whole = F.call_function("div", (n * (2 * scale) + d).cast("long"), F.nullif((d * 2).cast("long"), F.lit(0).cast("long")))
    return whole.cast("double") / float(scale)
