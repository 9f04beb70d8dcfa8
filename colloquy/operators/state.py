"""The state table: latest row per key, resuming, and reports over it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DECIDED = ["accepted", "rejected"]


def latest(log: DataFrame, key: str, order: list[str], fields: list[str]) -> DataFrame:
    """The last row of each key. As a maximum of structs it is combined before the shuffle, so hot keys stay small."""
    best = log.groupBy(key).agg(F.max(F.struct(*order, *[f for f in fields if f not in order])).alias("__b"))
    return best.select(key, *[F.col(f"__b.{f}").alias(f) for f in fields])


def undecided(candidates: DataFrame, state: DataFrame, key: str, redo: bool = False) -> DataFrame:
    """The candidates whose latest state is not a decision; all of them with redo."""
    return candidates if redo else candidates.join(state.where(F.col("status").isin(DECIDED)).select(key), key, "left_anti")


def lookup(table: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows of a table whose key is asked for."""
    return table.join(keys.select(key), key, "left_semi")


def without_output(candidates: DataFrame, outputs: DataFrame, key: str, overwrite: bool = False) -> DataFrame:
    """The candidates that have no output yet; all of them with overwrite."""
    return candidates if overwrite else candidates.join(outputs.select(key), key, "left_anti")


def reject(rejected: DataFrame, stage: Column, now: Column, keep_raw: bool = False) -> tuple[DataFrame, DataFrame]:
    """(rows for the state log, keys whose raw file is to go) of rows (vid, url, reason); rejected rows keep their raw file with keep_raw."""
    rows = rejected.where("reason <> ''").select("vid", "url", F.lit("rejected").alias("status"), "reason", stage.alias("stage"), now.alias("updated"))
    return rows, rows.select("vid").limit(0) if keep_raw else rows.select("vid").distinct()


def hours(rows: DataFrame, *by: str, seconds: tuple[str, ...] = ("duration",)) -> DataFrame:
    """(by, n, n_known, centiseconds, hours): rows and their summed length, from the first of the columns that is not 0 or null.

    Lengths are summed as whole hundredths of a second, so the order of rows does not matter.
    """
    length = F.round(falsy_first(*seconds) * 100).cast("long")
    sums = rows.groupBy(*by).agg(F.count("*").alias("n"), F.count(length).alias("n_known"), F.coalesce(F.sum(length), F.lit(0)).alias("centiseconds"))
    return sums.withColumn("hours", F.col("centiseconds") / F.lit(360000.0))


def tally(rows: DataFrame, column: str, missing: str = "none") -> DataFrame:
    """(column, n): how often each value occurs; null counts as `missing`."""
    return rows.groupBy(F.coalesce(column, F.lit(missing)).alias(column)).agg(F.count("*").alias("n"))


def report(state: DataFrame, accepted: DataFrame) -> DataFrame:
    """(place, line): the funnel as lines of text, most frequent outcome first (ties by name), then the total and the accepted hours."""
    label = F.concat(F.col("status"), F.when(F.coalesce("reason", F.lit("")) != "", F.concat(F.lit(" / "), "reason")).otherwise(""))
    line = lambda name, value: F.concat(F.lit("  "), F.rpad(name, F.greatest(F.length(name), F.lit(38)), F.lit(" ")), F.lit(" "), F.lpad(value, F.greatest(F.length(value), F.lit(6)), F.lit(" ")))
    counted = state.groupBy(label.alias("label")).agg(F.count("*").alias("n"))
    rows = counted.select(F.lit(0).alias("part"), "n", "label", line(F.col("label"), F.col("n").cast("string")).alias("line"))
    total = state.agg(F.count("*").alias("n")).select(F.lit(1).alias("part"), "n", F.lit("total").alias("label"), line(F.lit("total"), F.col("n").cast("string")).alias("line"))
    long = hours(accepted).select(F.lit(2).alias("part"), "n", F.lit("hours").alias("label"), line(F.lit("accepted hours"), F.format_string("%.1f", F.round("hours", 1))).alias("line"))
    every = rows.unionByName(total).unionByName(long)
    return every.select(F.row_number().over(Window.orderBy("part", F.desc("n"), "label")).alias("place"), "line")  # one row a kind of outcome


def funnel(state: DataFrame) -> DataFrame:
    """(status, reason, n), largest first; the row without status and reason is the total."""
    counted = state.rollup("status", "reason").agg(F.count("*").alias("n"), F.grouping_id().alias("g"))
    return counted.where("g in (0, 3)").orderBy(F.desc("n")).select("status", "reason", "n")


def falsy_first(*columns: str) -> Column:
    """The first of the columns that is neither null nor 0; null where none is."""
    return F.coalesce(*[F.nullif(F.col(c).cast("double"), F.lit(0.0)) for c in columns])


def parents(segment_rows: DataFrame, candidates: DataFrame) -> DataFrame:
    """(vid, status, reason) of each candidate from its segments' rows (parent, status): accepted with their number, or rejected."""
    n = segment_rows.where("status = 'accepted'").groupBy("parent").agg(F.count("*").alias("n"))
    rows = candidates.select("vid").distinct().join(n, F.col("vid") == F.col("parent"), "left")
    found = F.coalesce("n", F.lit(0)) > 0
    return rows.select("vid", F.when(found, "accepted").otherwise("rejected").alias("status"), F.when(found, F.concat(F.col("n").cast("string"), F.lit("_segment(s)"))).otherwise("no_qualifying_2spk_segment").alias("reason"))
