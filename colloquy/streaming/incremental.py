"""Incremental running: resume, polling, bounded batches, back-off, sessions - as Structured Streaming.

The checkpoint keeps what has been read; decided keys are left out by an anti-join per micro-batch, so a restart repeats no work.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ..operators.ordered import blocked, scan
from ..operators.state import latest, undecided
from ..runtime import cut, delete_path, list_names

POLL_SECONDS = 180


def watch(spark: SparkSession, path: str, schema: str, fmt: str = "json", files_per_batch: int = 16) -> DataFrame:
    """A growing folder as a stream; a bounded number of files per batch is the back-pressure."""
    return spark.readStream.schema(schema).format(fmt).option("maxFilesPerTrigger", files_per_batch).load(path)


def resume(spark: SparkSession, state_path: str, key: str, work: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function: runs work on the keys whose latest row in the state log is no decision, and appends its rows to it.

    work gives (key, status, ...); each row is noted with the batch it came from, and the latest batch's row counts. A batch that
    is run again (after a failure) replaces what it wrote before. `compact_log` keeps the log as short as the number of keys.
    """

    def step(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        fresh = batch.dropDuplicates([key])
        if list_names(session, state_path):
            earlier = session.read.parquet(state_path).where(F.col("batch") < number)
            fresh = undecided(fresh, latest(earlier, key, ["batch"], ["status"]), key)
        work(fresh).write.mode("overwrite").parquet(f"{state_path}/batch={number}")

    return step


def compact_log(spark: SparkSession, state_path: str, key: str, upto: int) -> None:
    """Put the latest rows of the batches up to a finished one into that batch's folder."""
    old = [n for n in list_names(spark, state_path) if n.startswith("batch=") and int(n[6:]) <= upto]
    if len(old) > 1:
        rows = spark.read.option("basePath", state_path).parquet(*[f"{state_path}/{n}" for n in old])
        kept = cut(latest(rows, key, ["batch"], [c for c in rows.columns if c != key]).drop("batch"))
        kept.write.mode("overwrite").parquet(f"{state_path}/batch={upto}")
        for n in old:
            if n != f"batch={upto}":
                delete_path(spark, f"{state_path}/{n}")


def run_polling(stream: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str, seconds: int = POLL_SECONDS) -> StreamingQuery:
    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(processingTime=f"{seconds} seconds").start()


def catch_up(stream: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """One pass over everything that has arrived, then stop."""
    writer: DataStreamWriter = stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    writer.start().awaitTermination()


def complete_to(result: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Run a streaming aggregate over all that has arrived; its complete result, as a table at path."""
    write = lambda batch, _: batch.write.mode("overwrite").parquet(path)
    result.writeStream.outputMode("complete").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return result.sparkSession.read.parquet(path)


def sessions(events: DataFrame, key: str, ts: str, gap: str, late: str | None = None) -> DataFrame:
    """(key, start, end, n): sessions of events no further apart than gap; with late, a watermark for streams. Plain timestamps are read as UTC."""
    rows = events.select(F.col(key), F.col(ts).cast("timestamp").alias("ts"))
    rows = rows.withWatermark("ts", late) if late else rows
    return rows.groupBy(F.session_window("ts", gap).alias("w"), key).agg(F.count("*").alias("n")).select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


# First pause and longest pause in seconds, by kind of hit; a hit this long after a pause begins anew.
PAUSES = {"rate": (300, 2400), "wall": (900, 5400)}
CLEAN_SECONDS = 60
_BACKOFF = "key string, at double, kind string, streak int, pause int, until double"


class BackOff:
    """The state of one site: when its pause ends, and the streaks."""

    def __init__(self, until: float = 0.0, rate: int = 0, wall: int = 0):
        self.until, self.streak = until, {"rate": rate, "wall": wall}

    def hit(self, at: float, kind: str) -> tuple[int, int, float]:
        """(streak, pause, until) after a hit."""
        if at > self.until + CLEAN_SECONDS:
            self.streak = dict.fromkeys(self.streak, 0)
        self.streak[kind] += 1
        first, longest = PAUSES[kind]
        pause = min(first * 2 ** min(self.streak[kind] - 1, 30), longest)
        self.until = at + pause
        return self.streak[kind], pause, self.until


def replay_backoff(hits: DataFrame, block_seconds: int = 86_400) -> DataFrame:
    """(key, at, kind, streak, pause, until) of hits (key, at, seq, kind), streamed in order with a state of three values.

    A hit later than the longest pause and the clean time after the one before begins anew whatever came before, so the hits of a key
    are parted there, by block-wise scans, and a busy key is spread over tasks. Only a part without such a gap stays in one piece.
    """
    apart = max(longest for _, longest in PAUSES.values()) + CLEAN_SECONDS

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key = state = None
        for b in batches:
            out = []
            for k, part, at, kind in zip(b.key, b.part, b["at"], b.kind, strict=True):
                if (k, part) != key:
                    key, state = (k, part), BackOff()
                out.append((k, at, kind, *state.hit(at, kind)))
            yield pd.DataFrame(out, columns=["key", "at", "kind", "streak", "pause", "until"])

    rows = hits.select(F.col("key").cast("string").alias("key"), "at", "seq", "kind").where(F.col("kind").isin(*PAUSES))
    order = ["at", "seq"]
    rows = scan(blocked(rows, ["key"], "at", block_seconds), ["key"], order, prev="prev")
    rows = rows.select("key", *order, "kind", "block", F.when(F.col("at") - F.col("prev.at") > apart, 1).otherwise(0).alias("opens"))
    rows = scan(rows, ["key"], order, sums={"part": F.col("opens")}).select("key", "part", *order, "kind")
    return rows.repartition("key", "part").sortWithinPartitions("key", "part", *order).mapInPandas(fold, _BACKOFF)


def stream_backoff(hits: DataFrame) -> DataFrame:
    """The same over a stream of (key, at, kind); hits of one micro-batch are taken in order of time."""

    def update(key: tuple, frames: Iterable[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        own = BackOff(*state.get) if state.exists else BackOff()
        rows = pd.concat(list(frames)).sort_values("at", kind="stable")
        out = [(str(key[0]), at, kind, *own.hit(at, kind)) for at, kind in zip(rows["at"], rows.kind, strict=True) if kind in PAUSES]
        state.update((own.until, own.streak["rate"], own.streak["wall"]))
        yield pd.DataFrame(out, columns=["key", "at", "kind", "streak", "pause", "until"])

    return hits.groupBy("key").applyInPandasWithState(update, _BACKOFF, "until double, rate int, wall int", "append", "NoTimeout")


def shard(key: Column, n: int, k: int) -> Column:
    """Whether a key belongs to shard k of n; stays so as the folder grows."""
    from ..operators.ranges import crc_shard

    return crc_shard(key, n) == k
