"""The boundary to models: named backends with fixed output schemas. Model code is not part of this package; backends are plugged in.

A backend is a function from an iterator of pandas frames to an iterator of pandas frames. It is loaded once per worker process and
must report a failure in the column `error` instead of raising; the caller maps it to a reason.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import time

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The pluggable points and what they return.
POINTS = {
    "diarizer": "clip_id string, seg_idx int, speaker string, start_ms long, end_ms long, error string",
    "separator": "clip_id string, speaker string, samples array<float>, rate int, error string",
    "aligner": "clip_id string, channel int, idx int, word string, start_ms long, end_ms long, error string",
    "speech_ratio": "clip_id string, speech_ratio double, error string",
    "verifier": "clip_id string, win int, reply string, error string",
    "probe": "url string, meta string, error string",
}
_backends: dict[tuple[str, str], Callable] = {}
_loaded: dict[tuple[str, str], Callable] = {}  # of this worker process
# Answers of a service after which a request is repeated, attempts, and the first pause in seconds (doubled each time).
RETRY_STATUS = (408, 429, 500, 502, 503, 504)
ATTEMPTS, FIRST_PAUSE = 4, 5.0


def register(point: str, name: str, load: Callable[[], Callable[[pd.DataFrame], pd.DataFrame]]) -> None:
    """load() is called once per worker and returns the function over batches."""
    if point not in POINTS:
        raise KeyError(f"unknown point {point}; one of {', '.join(POINTS)}")
    _backends[point, name] = load


def apply(df: DataFrame, point: str, name: str) -> DataFrame:
    load, key = _backends[point, name], (point, name)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from colloquy.functions import registry  # the worker's own module, not the one sent along

        if key not in registry._loaded:
            registry._loaded[key] = load()
        yield from map(registry._loaded[key], batches)

    return df.mapInPandas(run, POINTS[point])


def retrying(call: Callable[[object], tuple[int, float | None, str]], attempts: int = ATTEMPTS, pause: float = FIRST_PAUSE, statuses: tuple[int, ...] = RETRY_STATUS, sleep: Callable[[float], None] = time.sleep) -> Callable[[object], tuple[str | None, str | None]]:
    """(reply, error) of a call that gives (status, seconds to wait or None, body), for use inside a backend.

    An answer in statuses and a broken connection (OSError) are tried again, after the pause asked for or one that doubles;
    other answers, and the last attempt's, become the error.
    """

    def run(request: object) -> tuple[str | None, str | None]:
        error = None
        for attempt in range(attempts):
            wait = pause * 2**attempt
            try:
                status, asked, body = call(request)
            except OSError as e:
                error = f"{type(e).__name__}: {e}"
            else:
                if status == 200:
                    return body, None
                error = f"HTTP {status}: {body[:300]}"
                if status not in statuses:
                    break
                wait = wait if asked is None else asked
            if attempt + 1 < attempts:
                sleep(wait)
        return None, error

    return run


def by_setting(df: DataFrame, point: str, setting: str, default: str) -> DataFrame:
    """The point with the backend that a session setting names."""
    return apply(df, point, df.sparkSession.conf.get(setting, default))


def speech_ratio(df: DataFrame, name: str, neutral: float = 0.6) -> DataFrame:
    """A failed voice detector counts as neutral; empty audio is 0 by the backend itself."""
    return apply(df, "speech_ratio", name).select("clip_id", F.when(F.col("error").isNotNull(), neutral).otherwise(F.coalesce("speech_ratio", F.lit(0.0))).alias("speech_ratio"))


def channel_segments(spans: DataFrame, min_ms: int = 300) -> DataFrame:
    """Segments from per-channel speech spans (clip_id, channel, start_ms, end_ms): speakers named by channel, short ones dropped, numbered in time."""
    from ..operators.ordered import blocked, scan

    rows = spans.where(F.col("end_ms") - F.col("start_ms") >= min_ms).withColumn("speaker", F.format_string("SPEAKER_%02d", F.col("channel")))
    numbered = scan(blocked(rows, ["clip_id"], "start_ms"), ["clip_id"], ["start_ms", "channel", "end_ms"], sums={"n": F.lit(1)})
    return numbered.select("clip_id", (F.col("n") - 1).cast("int").alias("seg_idx"), "speaker", "start_ms", "end_ms")
