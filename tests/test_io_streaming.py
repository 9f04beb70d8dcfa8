from __future__ import annotations

import io
import json
import wave

import numpy as np
import pytest
from pyspark.sql import functions as F

from colloquy.functions import registry
from colloquy.plans import pipelines
from colloquy.sources import readers, sinks
from colloquy.streaming import incremental


def test_lists_and_json(spark, tmp_path):
    (tmp_path / "l").mkdir()
    (tmp_path / "l/a.txt").write_text(" u1 \n\nu2")
    (tmp_path / "l/b.txt").write_text("u1\nu3")
    assert sorted(r.url for r in readers.read_list(spark, str(tmp_path / "l")).collect()) == ["u1", "u1", "u2", "u3"]
    (tmp_path / "l/c.txt").write_text("\n".join(f"v{i}" for i in range(300)))
    assert [r.url for r in readers.read_list(spark, str(tmp_path / "l"), first=2).orderBy("pos").collect()] == ["u1", "u2"]
    got = readers.read_list(spark, str(tmp_path / "l")).orderBy("pos").collect()
    assert [r.url for r in got] == ["u1", "u2", "u1", "u3", *[f"v{i}" for i in range(300)]] and [r.pos for r in got] == list(range(304))
    (tmp_path / "l/c.txt").unlink()
    (tmp_path / "x.jsonl").write_text('{"path": "a", "duration": 1.5}\nbroken{\n\n{"path": "b"}\n')
    assert sorted(r.path for r in readers.read_json_lines(spark, str(tmp_path / "x.jsonl"), "path string, duration double").collect()) == ["a", "b"]
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.read_json_lines(spark, str(tmp_path / "x.jsonl"), "path string, duration double", strict=True).collect()


def test_entities_and_media(spark, tmp_path):
    for n in ("one", "two", "none"):
        (tmp_path / n).mkdir()
    for n in ("one", "two"):
        (tmp_path / n / "meta.json").write_text(json.dumps({"id": n, "duration": 2.0}, indent=2))
    (tmp_path / "one/a.WAV").write_bytes(b"123")
    (tmp_path / "two/b.xyz").write_bytes(b"123")
    assert sorted((r.id, r.folder) for r in readers.read_entities(spark, str(tmp_path), "id string, duration double").collect()) == [("one", "one"), ("two", "two")]
    media = readers.read_media(spark, str(tmp_path)).withColumn("uri", readers.data_uri(F.col("content"), F.col("media_type"))).collect()
    assert [(r.media_type, r.uri) for r in media] == [("audio/wav", "data:audio/wav;base64,MTIz")]
    turns = readers.parse_turns(spark.createDataFrame([("0.5 1.5 A",), ("x 1 B",), ("1 2",)], "line string")).collect()
    assert [tuple(r) for r in turns] == [(0.5, 1.5, "A")]


def test_sinks(spark, tmp_path):
    seg = spark.createDataFrame([("c", 0, "A", 1005, 2500)], "clip_id string, seg_idx int, speaker string, start_ms long, end_ms long")
    assert sinks.rttm_lines(seg).first().line == "SPEAKER c 1 1.005 1.495 <NA> <NA> A <NA> <NA>"
    sinks.write_rttm(seg, str(tmp_path / "rttm"))
    assert spark.read.text(str(tmp_path / "rttm")).count() == 1
    w = wave.open(io.BytesIO(sinks.wav_bytes([np.array([0, 1, -2], np.float32), np.zeros(3, np.float32)], 16_000)))
    assert (w.getnchannels(), w.getnframes(), w.getframerate()) == (2, 3, 16_000)
    files = sinks.wav_files(spark.createDataFrame([("x", [[0.0, 0.5]])], "name string, channels array<array<float>>"), 8_000).collect()
    assert files[0].content[:4] == b"RIFF"
    wins = spark.createDataFrame([("a", 1.23456789, "train"), ("b", 2.0, "val")], "path string, duration double, split string")
    assert "duration_sec: 100" in sinks.write_splits(wins, str(tmp_path / "s"), 120_000)
    assert spark.read.json(str(tmp_path / "s/train.jsonl")).first().duration == 1.234568
    head = "file string, analysis struct<num_speakers:int,language:string,language_code:string,topic:string,tone:string,setting:string,audio_quality:string,confidence:string,summary:string,speakers:array<struct<id:string,apparent_gender:string,notes:string>>,background_sounds:array<string>,key_moments:array<string>,unclear:array<string>,transcript:string>"
    page = sinks.markdown_report(spark.createDataFrame([("f", (2, "Hindi", None, "", None, "s", "q", "c", None, [("A", None, "n")], ["x", "y"], [], None, ""))], head)).first().report
    assert "| Topic | — |" in page and "- x\n- y" in page and "None flagged." in page and "```\n(none)\n```" in page and "**A** — unclear — n" in page and "| Other languages | — |" in page
    run = "struct<source:string,model:string,duration:double,elapsed:double,tokens:int>"
    df = spark.createDataFrame([("f", ("p/f", "m", None, 2.6, 7), (2, "Hindi", ["en", "ta"]))], f"file string, run {run}, analysis struct<num_speakers:int,language:string,other_languages:array<string>>")
    for c in ("language_code", "topic", "tone", "setting", "audio_quality", "confidence", "summary", "transcript"):
        df = df.withColumn("analysis", F.col("analysis").withField(c, F.lit(None).cast("string")))
    for c in ("background_sounds", "key_moments", "unclear"):
        df = df.withColumn("analysis", F.col("analysis").withField(c, F.lit(None).cast("array<string>")))
    df = df.withColumn("analysis", F.col("analysis").withField("speakers", F.lit(None).cast("array<struct<id:string,apparent_gender:string,notes:string>>")))
    page = sinks.markdown_report(df, run="run").first().report
    assert page.startswith("# Audio analysis — f\n\n- Source: `p/f`\n- Model: `m`\n- Processing time: 3s\n- Tokens: 7\n\n---\n") and "| Other languages | en, ta |" in page


def test_registry(spark):
    def load():
        def run(b):
            return b[["clip_id"]].assign(speech_ratio=[None if c == "bad" else 0.3 for c in b.clip_id], error=["boom" if c == "bad" else None for c in b.clip_id])

        return run

    registry.register("speech_ratio", "fake", load)
    got = registry.speech_ratio(spark.createDataFrame([("bad",), ("ok",)], "clip_id string"), "fake").collect()
    assert {r.clip_id: r.speech_ratio for r in got} == {"bad": 0.6, "ok": 0.3}
    answers = iter([(503, None, "busy"), OSError("reset"), (429, 7.0, "later"), (200, None, "fine")])
    waits = []

    def call(_):
        a = next(answers)
        if isinstance(a, OSError):
            raise a
        return a

    assert registry.retrying(call, sleep=waits.append)("x") == ("fine", None) and waits == [5.0, 10.0, 7.0]
    assert registry.retrying(lambda _: (400, None, "bad"), sleep=waits.append)("x") == (None, "HTTP 400: bad") and len(waits) == 3
    assert registry.retrying(lambda _: (500, None, "down"), attempts=2, sleep=waits.append)("x") == (None, "HTTP 500: down") and len(waits) == 4
    with pytest.raises(KeyError):
        registry.register("nothing", "x", load)
    spans = spark.createDataFrame([("c", 1, 0, 500), ("c", 0, 100, 600), ("c", 0, 700, 900)], "clip_id string, channel int, start_ms long, end_ms long")
    assert [tuple(r)[1:3] for r in registry.channel_segments(spans).orderBy("seg_idx").collect()] == [(0, "SPEAKER_01"), (1, "SPEAKER_00")]


def test_resume_stream(spark, tmp_path):
    src, state, ck = tmp_path / "in", str(tmp_path / "state"), str(tmp_path / "ck")
    src.mkdir()
    work = lambda b: b.select("vid", F.when(F.col("n") > 1, "accepted").otherwise("error").alias("status"))
    step = incremental.resume(spark, state, "vid", work)
    for k, rows in enumerate([[("a", 2), ("b", 1)], [("a", 5), ("b", 3)]]):
        (src / f"{k}.json").write_text("\n".join(json.dumps({"vid": v, "n": n}) for v, n in rows))
        incremental.catch_up(incremental.watch(spark, str(src), "vid string, n int"), step, ck)
    got = sorted(tuple(r) for r in spark.read.parquet(state).select("vid", "status").collect())
    assert got == [("a", "accepted"), ("b", "accepted"), ("b", "error")]  # a is decided once; b, undecided, is tried again


def test_the_latest_row_decides(spark, tmp_path):
    src, state = tmp_path / "in", str(tmp_path / "state")
    src.mkdir()
    seen = []
    work = lambda b: b.select("vid", F.col("next").alias("status"))
    step = incremental.resume(spark, state, "vid", work)
    for k, rows in enumerate([[("v", "accepted"), ("w", "rejected")], [("v", "error")], [("w", "accepted"), ("u", "error")]]):
        step(spark.createDataFrame(rows, "vid string, next string"), k)
        seen.append(sorted((r.vid, r.status) for r in spark.read.parquet(state).collect()))
    assert seen[1] == seen[0] and seen[2] == [("u", "error"), ("v", "accepted"), ("w", "rejected")]
    spark.createDataFrame([("v", "error")], "vid string, status string").write.parquet(f"{state}/batch=3")  # redone by hand: open again
    step(spark.createDataFrame([("v", "rejected"), ("u", "accepted")], "vid string, next string"), 4)
    step(spark.createDataFrame([("v", "rejected"), ("u", "accepted")], "vid string, next string"), 4)  # a retry
    incremental.compact_log(spark, state, "vid", 4)
    assert sorted((r.vid, r.status, r.batch) for r in spark.read.parquet(state).collect()) == [("u", "accepted", 4), ("v", "rejected", 4), ("w", "rejected", 4)]


def test_stream_backoff_and_sessions(spark, tmp_path):
    src = tmp_path / "hits"
    src.mkdir()
    (src / "0.json").write_text("\n".join(json.dumps({"key": "a", "at": t, "kind": "rate"}) for t in (0.0, 10.0)))
    q = incremental.stream_backoff(incremental.watch(spark, str(src), "key string, at double, kind string")).writeStream.format("memory").queryName("hits").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert [(r.streak, r.pause) for r in spark.table("hits").orderBy("at").collect()] == [(1, 300), (2, 600)]
    ev = spark.createDataFrame([("u", "2024-01-01 00:00:00"), ("u", "2024-01-01 00:10:00"), ("u", "2024-01-01 02:00:00")], "k string, ts string")
    assert sorted(r.n for r in incremental.sessions(ev, "k", "ts", "30 minutes").collect()) == [1, 2]


def test_pipelines(spark):
    seg = [("v_seg0", i, "AB"[i % 2], i * 2000, i * 2000 + 2100) for i in range(200)]
    segs = spark.createDataFrame(seg, "clip_id string, seg_idx int, speaker string, start_ms long, end_ms long")
    videos = spark.createDataFrame([("v_seg0", 400.0, "", 0.8), ("w", 10.0, "", 0.8), ("x", 400.0, "", 0.8)], "vid string, duration double, license string, speech_ratio double")
    votes = spark.createDataFrame([(v, i, 2, "Hindi", "hi", True) for v in ("v_seg0", "w") for i in range(3)], "clip_id string, win int, num_speakers int, language string, language_code string, is_conversational boolean")
    got = {r.vid: (r.reason, r.stage) for r in pipelines.curate(videos, votes, segs).collect()}
    assert got == {"v_seg0": ("", "emit"), "w": ("too_short", "probe"), "x": ("verify_failed", "verify")}
    totals = spark.createDataFrame([("v_seg0", 400_600)], "clip_id string, total_ms long")
    wins = pipelines.plan_training_windows(segs, totals).collect()
    assert len(wins) == 3 and all(w.split == "train" and (w.last_sample - w.first_sample) % 1920 == 0 for w in wins)
