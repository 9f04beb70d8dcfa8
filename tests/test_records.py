from __future__ import annotations

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from colloquy.functions import records


def test_small_functions(spark):
    df = spark.createDataFrame([(0, "", [], {"a": "1", "b": "2"}, {"b": "9"}, "hi-IN", 3, "v", 0.0), (5, "x", ["t"] * 30, {}, {}, "xx", 12, "w", 86_400.0)], "n int, s string, t array<string>, l map<string,string>, r map<string,string>, c string, k int, v string, e double")
    got = df.select(
        records.truthy(F.col("n"), "number").alias("n"), records.truthy(F.col("s"), "text").alias("s"), records.truthy(F.col("t"), "collection").alias("t"), F.size(records.first_tags(F.col("t"))).alias("tags"),
        records.merge_maps(F.col("l"), F.col("r")).alias("m"), records.language_name(F.col("c")).alias("name"), records.speaker_name(F.col("k")).alias("spk"), records.clip_name(F.col("v"), F.col("k")).alias("clip"),
        records.local_stamp(F.col("e")).alias("stamp"), records.speaker_map(F.array(F.lit("B"), F.lit("A"))).alias("map"), records.override(F.struct("n", "s"), {"n": F.lit(1), "z": F.lit(2)}).alias("o"), records.lookup({"v": "V"}, F.col("v")).alias("look"),
    ).collect()
    a, b = got
    assert (a.n, a.s, a.t, a.tags, b.n, b.s, b.tags) == (None, None, None, 0, 5, "x", 20)
    assert a.m == {"a": "1", "b": "9"} and (a.name, b.name) == ("Hindi", None) and b.spk == "SPEAKER_12" and a.clip == "v_seg3"
    assert a.stamp == "1970-01-01T00:00:00" and b.stamp == "1970-01-02T00:00:00" and a.map == {"spk0": "A", "spk1": "B"} and tuple(a.o) == (1, "", 2) and (a.look, b.look) == ("V", "w")


def test_word_spans(spark):
    head = "clip_id string, spans array<struct<start:int,end:int>>, sizes array<int>, n_samples long, n_frames long, rate long"
    ok = [("c", [(0, 2), (3, 4), (10, 12)], [2, 0, 1], 16_000, 50, 16_000)]
    got = records.word_spans(spark.createDataFrame(ok, head)).orderBy("idx").collect()
    assert [tuple(r) for r in got] == [("c", 0, 0, 80), ("c", 2, 200, 240)]
    with pytest.raises(Exception, match="differ in number"):
        records.word_spans(spark.createDataFrame([("c", [(0, 2)], [2], 16_000, 50, 16_000)], head)).collect()


def test_word_spans_of_many_rows(spark, monkeypatch):
    """Parts of a batch give what the whole gives, and no span becomes an object."""
    head = "clip_id string, spans array<struct<start:int,end:int>>, sizes array<int>, n_samples long, n_frames long, rate long"
    rows = [(f"c{i}", [(3 * k, 3 * k + 2) for k in range(i)], [1] * (i % 3) + [0] * (i % 2) + [i - i % 3], 48_000 + i, 150, 16_000) for i in range(40)]
    want = []
    for clip, spans, sizes, n_samples, n_frames, rate in rows:
        ms = lambda frame: (frame * n_samples // n_frames * 2000 + rate) // (2 * rate)  # noqa: B023, E731
        want += [(clip, i, ms(spans[sum(sizes[:i])][0]), ms(spans[sum(sizes[: i + 1]) - 1][1])) for i, n in enumerate(sizes) if n]
    kept, df = [], spark.createDataFrame(rows, head).coalesce(1)
    whole = type(df).mapInArrow
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, f, schema: kept.append(f) or whole(self, f, schema))
    for part in (1_000_000, 25):
        monkeypatch.setattr(records, "SPANS", part)
        assert sorted(tuple(r) for r in records.word_spans(df).collect()) == sorted(want)

    n, m = 200, 5_000  # clips, spans of each; five a word
    at = pa.array(np.arange(n * m, dtype=np.int32))
    spans = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * m), pa.StructArray.from_arrays([at, at], ["start", "end"]))
    sizes = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * (m // 5)), pa.array(np.full(n * m // 5, 5, np.int32)))
    longs = {c: pa.array(np.full(n, 16_000)) for c in ("n_samples", "n_frames", "rate")}
    batch = pa.RecordBatch.from_pydict({"clip_id": pa.array([f"c{i}" for i in range(n)]), "spans": spans, "sizes": sizes} | longs)
    tracemalloc.start()
    words = sum(b.num_rows for b in kept[0](iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert words == n * m // 5 and peak < 64 * n * m
