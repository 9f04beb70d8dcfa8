from __future__ import annotations

import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from colloquy import queries as core
from colloquy.functions import replies
from colloquy.operators import ranges, signal, words
from tests_compare import compare

WORD = "clip_id string, channel int, idx int, word string, start_ms long, end_ms long"


def test_interpolation(spark):
    rows = [("c", 0, 0, "a", None, None), ("c", 0, 1, "b", 1000, 1200), ("c", 0, 2, "c", None, None), ("c", 0, 3, "d", None, None), ("c", 0, 4, "e", 1100, 1300), ("c", 0, 5, "f", None, None), ("n", 0, 0, "x", None, None), ("n", 0, 1, "y", None, None)]
    totals = spark.createDataFrame([("c", 2000), ("n", 1001)], "clip_id string, total_ms long")
    got = {(r.clip_id, r.idx): (r.start_ms, r.end_ms, r.approx) for r in words.interpolate_words(spark.createDataFrame(rows, WORD), totals).collect()}
    assert got["c", 0] == (0, 1000, True) and got["c", 1] == (1000, 1200, False)
    assert got["c", 2] == got["c", 3] == (1200, 1200, True)  # the next start lies before the previous end
    assert got["c", 5] == (1300, 2000, True)
    assert got["n", 0] == (0, 501, True) and got["n", 1] == (501, 1001, True)


def test_extension(spark):
    rows = [("c", 0, 0, "a", 0, 100, False), ("c", 0, 1, "b", 350, 400, False), ("c", 0, 2, "c", 651, 700, False), ("c", 0, 3, "d", 690, 720, True), ("c", 0, 4, "e", 760, 800, False)]
    totals = spark.createDataFrame([("c", 850)], "clip_id string, total_ms long")
    got = [r.end_ms for r in words.extend_word_ends(spark.createDataFrame(rows, WORD + ", approx boolean"), totals).orderBy("idx").collect()]
    assert got == [350, 500, 700, 720, 850]


def test_texts(spark):
    df = spark.createDataFrame([("नमस्ते hello ۱",), ("",), (None,), ("123",)], "text string")
    got = df.select(*[c.alias(n) for n, c in words.script_counts(F.col("text")).items()]).collect()
    assert (got[0].devanagari, got[0].other_letters) == (6, 6) and got[0].devanagari_frac == 0.5
    assert got[1].devanagari_frac is None and got[3].n_letters == 0
    grams = words.repeated_ngrams(spark.createDataFrame([(1, "a b c d a b c d"), (2, "a b"), (3, None)], "k int, text string"), "k", "text").collect()
    assert [tuple(r) for r in grams] == [(1, 5, 4)]
    assert spark.createDataFrame([("a b \n",)], "t string").select(words.tokens(F.col("t")).alias("w")).first().w == ["a", "b"]


def test_outcomes(spark):
    df = spark.createDataFrame([(None, "w"), ("a", "w"), (None, None)], "aligned string, fallback string")
    got = df.select(words.first_outcome(("aligner", F.col("aligned")), ("transcriber", F.col("fallback"))).alias("o")).collect()
    assert [r.o and tuple(r.o) for r in got] == [("transcriber", "w"), ("aligner", "a"), None]
    even = words.even_timestamps(spark.createDataFrame([("c", 0, 900, ["a", "b"])], "clip_id string, channel int, total_ms long, words array<string>")).collect()
    assert [(r.start_ms, r.end_ms, r.approx) for r in even] == [(0, 450, True), (450, 900, True)]
    nested = spark.createDataFrame([("c", 0, [([(" hi ", 0.1234, 0.5)],), (None,)])], "clip_id string, channel int, segments array<struct<words:array<struct<word:string,start:double,end:double>>>>")
    assert [tuple(r) for r in words.flatten_segments(nested).collect()] == [("c", 0, 0, "hi", 123, 500)]


def test_signal(spark):
    df = spark.createDataFrame([([0.0, 0.0],), ([1.0, -1.0, 0.5, 0.1],), ([],), (None,)], "x array<float>")
    got = df.select(signal.rms(F.col("x")).alias("r"), signal.peak(F.col("x")).alias("p"), signal.rms_normalised(F.col("x")).alias("n")).collect()
    assert got[0].r == 0.0 and got[0].n == [0.0, 0.0] and got[2].r == 0.0 and got[3].r is None
    assert math.isclose(np.sqrt(np.mean(np.square(got[1].n))), 0.05, rel_tol=1e-6)
    pair = spark.createDataFrame([([1.0, 2.0, 3.0], [2.0, 4.0, 6.0], [-1.0, -2.0, -3.0], [1.0, 1.0, 1.0])], "a array<float>, b array<float>, c array<float>, z array<float>")
    s = pair.select(*[signal.similarity(F.col("a"), F.col(c)).alias("to_" + c) for c in "bcz"], signal.swapped(F.col("a"), F.col("c"), F.col("c"), F.col("b")).alias("s"), signal.fit_length(F.col("a"), 5).alias("f"), signal.crossfade(F.col("a"), F.col("b"), 2).alias("x")).first()
    assert (round(s.to_b, 6), round(s.to_c, 6), s.to_z) == (1.0, -1.0, 0.0) and s.s is True and s.f == [1, 2, 3, 0, 0] and s.x == [1.0, 2.0, 4.0, 6.0]


def test_mask_and_resample():
    x = np.ones(100, np.float32)
    y = signal.mask_channel(x, [(10, 50), (40, 80), (-5, 3), (90, 300)], 5)
    assert y[5] == 0 and y[30] == 1 and y[45] == 1 and y[10] == 0 and y[12] == pytest.approx(0.5) and y[95] == 1.0
    t = np.arange(16_000) / 16_000
    z = signal.resample_array(np.sin(2 * np.pi * 440 * t).astype(np.float32), 16_000, 24_000)
    assert len(z) == 24_000 and np.abs(z[200:-200] - np.sin(2 * np.pi * 440 * np.arange(24_000) / 24_000)[200:-200]).max() < 2e-3


def test_ranges(spark):
    d = spark.createDataFrame([("a", 600_000), ("b", 10_000)], "clip_id string, duration_ms long")
    even = {(r.clip_id, r.i): r.start_ms for r in ranges.even_windows(d).collect()}
    assert even["a", 0] == 60_000 + 48_000 - 22_500 and even["b", 4] == 0
    chunks = ranges.chunk_ranges(spark.createDataFrame([("a", 225_000), ("z", 0)], "clip_id string, duration_ms long")).collect()
    assert [(r.start_ms, r.end_ms) for r in chunks] == [(0, 120_000), (110_000, 225_000), (220_000, 225_000)]
    ids = spark.createDataFrame([("abc",), ("abc_seg0",), ("abc_seg1",), ("x",), (None,)], "c string")
    split = ranges.grouped_split(ids, ranges.source_of(F.col("c")), 0.5).collect()
    assert len(split) == 2 and sorted(r.split for r in split) == ["train", "val"]
    shards = ids.where("c is not null").select("c", ranges.crc_shard(F.col("c"), 7).alias("s")).collect()
    assert all(r.s == zlib.crc32(r.c.encode()) % 7 for r in shards)


def test_replies(spark):
    texts = ['```json\n{"num_speakers": 2}\n```', 'Sure: {"num_speakers": 3} ok', '{"num_speakers": ', "", None, '{"num_speakers": null}']
    got = spark.createDataFrame([(t,) for t in texts], "r string").select(replies.vote_of(F.col("r"), "num_speakers int")["num_speakers"].alias("n")).collect()
    assert [r.n for r in got] == [2, 3, None, None, None, None]
    assert spark.createDataFrame([("é",), (None,)], "t string").select(replies.nfc(F.col("t")).alias("t")).collect()[0].t == "é"


def stitched(chunks, overlap):
    """The fold over chunks: turn each to fit the one before, fade the overlap over."""
    def sim(a, b):
        a, b = a - a.mean(), b - b.mean()
        n = np.linalg.norm(a) * np.linalg.norm(b)
        return (a * b).sum() / n if n > 1e-8 else 0.0

    out, how = None, []
    for c in chunks:
        c = np.asarray(c, float)
        if out is None:
            out, swap = c, False
        else:
            m = min(overlap, out.shape[1], c.shape[1])
            p, h = out[:, -m:], c[:, :m]
            swap = sim(p[0], h[1]) + sim(p[1], h[0]) > sim(p[0], h[0]) + sim(p[1], h[1])
            c = c[::-1] if swap else c
            fade = np.linspace(0.0, 1.0, m)
            out = np.concatenate([out[:, :-m], p * (1 - fade) + c[:, :m] * fade, c[:, m:]], 1)
        how.append(swap)
    return out, how


def test_stitching(spark):
    r = np.random.default_rng(3)
    rows, want = [], {}
    for clip, sizes in {"a": [20] * 9, "one": [12], "short": [20, 20, 3], "tie": [20, 20, 20, 20]}.items():
        whole, at, chunks = r.normal(size=(2, 400)), 0, []
        for k, n in enumerate(sizes):
            c = whole[:, at : at + n] + r.normal(scale=0.1, size=(2, n))
            chunks.append(c[::-1] if r.random() < 0.5 else c)
            if clip == "tie" and k == 2:
                chunks[-1] = np.zeros((2, n))
            at += n - 5
        rows += [(clip, k, c[0].tolist(), c[1].tolist()) for k, c in enumerate(chunks)]
        want[clip] = stitched(chunks, 5)
    df = spark.createDataFrame(rows, "clip_id string, i int, ch0 array<double>, ch1 array<double>")
    got = {}
    for x in signal.stitch(df, 5, block=3).orderBy("clip_id", "i").collect():
        got.setdefault(x.clip_id, []).append(x)
    for clip, (wave, how) in want.items():
        assert [x.swapped for x in got[clip]] == how
        assert np.allclose(np.array([sum((x.ch0 for x in got[clip]), []), sum((x.ch1 for x in got[clip]), [])]), wave)


def test_token_places(spark):
    rows = [("c", 0, 0, "ab"), ("c", 0, 1, "c"), ("c", 0, 1, "def"), ("c", 0, 25_000, "g"), ("c", 1, 7, "hi")]
    got = words.token_places(spark.createDataFrame(rows, "clip_id string, channel int, idx int, word string"), F.length("word"))
    assert sorted(tuple(r) for r in got.collect()) == [("c", 0, 0, 0, 2, 7), ("c", 0, 1, 3, 6, 7), ("c", 0, 1, 5, 6, 7), ("c", 0, 25_000, 6, 7, 7), ("c", 1, 7, 0, 2, 2)]


def test_token_spans_of_odd_clips(spark, tmp_path):
    """Clips of many words, without an id, under one id, without words: as the SQL has them, and none is gathered into a row."""
    texts = [(1, "ab c\n\n def"), (1, "g hi jkl m"), (2, " ".join("नमस्ते" if i % 7 else "x" for i in range(45_000))), (None, "no id"), (None, "nor this one"), (3, None), (4, ""), (5, " \n ")]
    spark.createDataFrame(texts, "audio_id long, transcript string").coalesce(1).write.parquet(str(tmp_path / "tables" / "nemo_audio.parquet"))
    (tmp_path / "tables" / "nemo_audio.parquet").rename(tmp_path / "written")
    next((tmp_path / "written").glob("*.parquet")).rename(tmp_path / "tables" / "nemo_audio.parquet")
    compare(spark, str(tmp_path / "tables"), "token_spans", core.REGISTRY)
    plan = core.REGISTRY["token_spans"][0](spark, str(tmp_path / "tables"))._jdf.queryExecution().toString()
    assert "collect_list" not in plan and "MapIn" not in plan
