"""Commands end to end over small tables."""

from __future__ import annotations

import json

from colloquy.__main__ import main


def test_commands(spark, tmp_path, capsys):
    at = lambda name: f"{tmp_path}/{name}"
    (tmp_path / "known.txt").write_text("https://v.example/b\n")
    main(["discover", "--query", "two hosts", "--source", "https://v.example/a", "--source", "https://v.example/b", "--known", at("known.txt"), "--out", at("urls")], spark)
    assert sorted(r.value for r in spark.read.text(at("urls")).collect()) == ["https://v.example/a", "search50:two hosts"]

    spark.createDataFrame([("v", 400.0, "", 0.8), ("w", 10.0, "", 0.8)], "vid string, duration double, license string, speech_ratio double").write.parquet(at("videos"))
    spark.createDataFrame([("v", i, 2, "Hindi", "hi", True) for i in range(3)], "clip_id string, win int, num_speakers int, language string, language_code string, is_conversational boolean").write.parquet(at("votes"))
    spark.createDataFrame([("v", i, "AB"[i % 2], i * 2000, i * 2000 + 2100) for i in range(190)], "clip_id string, seg_idx int, speaker string, start_ms long, end_ms long").write.parquet(at("segments"))
    run = ["run", "--videos", at("videos"), "--votes", at("votes"), "--segments", at("segments"), "--out", at("state")]
    main(run, spark)
    main([*run, "--state", at("state")], spark)  # both are decided: nothing is added
    assert sorted((r.vid, r.status, r.reason, r.stage) for r in spark.read.parquet(at("state")).collect()) == [("v", "accepted", "", "emit"), ("w", "rejected", "too_short", "probe")]

    (tmp_path / "manifest.jsonl").write_text('{"duration": 1800}\n{"duration": 0, "seconds": 1800}\n')
    main(["stats", "--state", at("state"), "--manifest", at("manifest.jsonl")], spark)
    main(["hours", "--manifest", at("manifest.jsonl")], spark)
    out = capsys.readouterr().out
    assert "rejected / too_short" in out and "accepted hours" in out and "0.5" in out and "2 rows, 2 with a length, 1.00 h" in out

    (tmp_path / "accepted/v").mkdir(parents=True)
    (tmp_path / "accepted/v/meta.json").write_text(json.dumps({"id": "v", "duration": 400.0, "language_code": "hi", "files": {"channels": ["spk0.wav"]}}))
    main(["export", "--root", at("accepted"), "--out", at("export")], spark)
    row = spark.read.json(at("export")).first()
    assert row.id == "v" and row.channel_filepaths == [at("accepted/v/spk0.wav")] and row.lang == "hi"

    main(["windows", "--segments", at("segments"), "--out", at("out"), "--dry-run"], spark)
    assert not (tmp_path / "out").exists() and "train: 3 windows" in capsys.readouterr().out
    main(["windows", "--segments", at("segments"), "--out", at("out"), "--max-window", "150"], spark)
    assert "batch_size: 8" in capsys.readouterr().out and spark.read.json(at("out/train.jsonl")).count() > 0

    spark.createDataFrame([("v", 0, i, f"w{i}", i * 1000 if i % 3 else None, i * 1000 + 300 if i % 3 else None) for i in range(10)], "clip_id string, channel int, idx int, word string, start_ms long, end_ms long").write.parquet(at("words"))
    spark.createDataFrame([("v", 0, 0, 0, 5000), ("v", 0, 1, 5000, 20_000)], "clip_id string, channel int, seg_idx int, start_ms long, end_ms long").write.parquet(at("turns"))
    spark.createDataFrame([("v", 12_000)], "clip_id string, total_ms long").write.parquet(at("totals"))
    for _ in range(2):
        main(["transcribe", "--words", at("words"), "--turns", at("turns"), "--totals", at("totals"), "--out", at("text")], spark)
    assert sorted(r.text for r in spark.read.parquet(at("text/turns")).collect()) == ["w0 w1 w2 w3 w4", "w5 w6 w7 w8 w9"]
