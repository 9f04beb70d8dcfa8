from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from colloquy.config import Thresholds
from colloquy.operators import gates, stats, state, urls, votes

CAND = "duration double, license string, speech_ratio double, verify_missing boolean, num_speakers int, language_code string, language string, is_conversational boolean, music_dominant boolean, is_dubbed boolean"


@pytest.mark.parametrize(
    ("row", "reason"),
    [
        ((120.0, "", 0.45, False, 2, "hi", "", True, False, False), ""),
        ((119.9, "", 0.5, False, 2, "hi", "", True, False, False), "too_short"),
        ((None, "", 0.5, False, 2, "hi", "", True, False, False), "too_short"),
        ((14400.1, "", 0.5, False, 2, "hi", "", True, False, False), "too_long"),
        ((200.0, "", 0.44, False, 2, "hi", "", True, False, False), "low_speech"),
        ((200.0, "", 0.99, False, 2, "hi", "", True, False, False), "high_speech"),
        ((200.0, "", 0.5, True, 2, "hi", "", True, False, False), "verify_failed"),
        ((200.0, "", 0.5, False, None, "hi", "", True, False, False), "not_two_speakers"),
        ((200.0, "", 0.5, False, 2, "HI-in", "Telugu", True, False, False), ""),
        ((200.0, "", 0.5, False, 2, "hi_IN", "Hindi", True, False, False), "not_indic"),
        ((200.0, "", 0.5, False, 2, "", " Hindi ", True, False, False), ""),
        ((200.0, "", 0.5, False, 2, None, "Telugu", True, False, False), "not_indic"),
        ((200.0, "", 0.5, False, 2, "hi", "", None, False, False), "not_conversational"),
        ((200.0, "", 0.5, False, 2, "hi", "", True, True, False), "not_conversational"),
    ],
)
def test_light_gate(spark, row, reason):
    assert spark.createDataFrame([row], CAND).select(gates.light_reason().alias("r")).first().r == reason


def test_license_gate(spark):
    rows = [(200.0, x, 0.5, False, 2, "hi", "", True, False, False) for x in (None, "CREATIVE commons BY", "standard")]
    got = spark.createDataFrame(rows, CAND).select(gates.light_reason(Thresholds(cc_only=True)).alias("r")).collect()
    assert [r.r for r in got] == ["license", "", "license"]


def test_qualify_bounds(spark):
    head = "clip_id string, n_speakers int, n_turns int, turns_per_min double, dominance double, overlap_ratio double"
    rows = [("a", 2, 20, 3.0, 0.75, 0.005), ("b", 2, 19, 3.0, 0.75, 0.1), ("c", 2, 20, 2.99, 0.7, 0.1), ("d", 2, 20, 3.0, 0.751, 0.1), ("e", 2, 20, 3.0, 0.7, 0.3501), ("f", 3, 99, 9.0, 0.5, 0.1), ("g", None, None, None, None, None)]
    got = {r.clip_id: r.reason for r in stats.qualify(spark.createDataFrame(rows, head)).collect()}
    assert got == {"a": "", "b": "few_turns", "c": "few_turns", "d": "imbalanced", "e": "overlap_out_of_range", "f": "diar_speaker_count", "g": "diar_speaker_count"}


def test_votes(spark):
    head = "clip_id string, win int, num_speakers int, language string, language_code string, is_conversational boolean, confidence string"
    rows = [("t", 0, 2, "Telugu", "te", True, "high"), ("t", 1, 3, "Hindi", "hi-IN", False, None), ("o", 0, 2, "Hindi", "hi", True, "low"), ("m", 0, None, None, None, None, None), ("m", 1, None, " HINDI", "Hi ", None, None), ("m", 2, 2, "hindi", "hi-in", True, "low")]
    df = spark.createDataFrame(rows, head)
    lang = {r.clip_id: (r.language_code, r.language, r.agreement) for r in votes.language_vote(df).collect()}
    assert lang == {"t": ("", "", 0.5), "o": ("hi", "hindi", 1.0), "m": ("hi", "hindi", 0.67)}
    low = {r.clip_id: r.language_code for r in votes.language_vote(df, 0.5).collect()}
    assert low["t"] == "te"  # a tie goes to the pair seen first
    v = {r.clip_id: r for r in votes.verdicts(df).collect()}
    assert set(v) == {"t", "m"} and v["t"].num_speakers == 2 and v["t"].is_conversational is False and v["m"].is_conversational is True and v["m"].confidence == "low"


def test_errors(spark):
    texts = ["HTTP 429: rate-limit", "Sign in to confirm you are not a Bot", "sign in", None]
    got = spark.createDataFrame([(t,) for t in texts], "e string").select(gates.back_off_kind(F.col("e")).alias("k"), gates.failure_reason(F.lit("probe"), F.col("e")).alias("r")).collect()
    assert [r.k for r in got] == ["rate", "wall", None, None]
    assert [r.r for r in got] == ["probe_failed"] * 3 + [None]
    with pytest.raises(Exception, match="emit_failed"):
        gates.check_emitted(spark.createDataFrame([(1,)], "x int"), F.col("x") > 1).collect()


def test_state(spark):
    log = spark.createDataFrame([("a", 1.0, "accepted"), ("a", 2.0, "pending"), ("b", 1.0, "rejected"), ("c", None, "error")], "vid string, updated double, status string")
    last = state.latest(log, "vid", ["updated"], ["updated", "status"])
    assert {(r.vid, r.status) for r in last.collect()} == {("a", "pending"), ("b", "rejected"), ("c", "error")}
    cand = spark.createDataFrame([("a",), ("b",), ("d",)], "vid string")
    assert {r.vid for r in state.undecided(cand, last, "vid").collect()} == {"a", "d"}
    assert state.undecided(cand, last, "vid", redo=True).count() == 3
    d = spark.createDataFrame([(0.0, 5.0, None), (None, None, 0.0), (3.0, 1.0, 1.0)], "duration double, duration_s double, seconds double")
    assert [r.x for r in d.select(state.falsy_first("duration", "duration_s", "seconds").alias("x")).collect()] == [5.0, None, 3.0]


def test_urls(spark):
    df = spark.createDataFrame([("", "x"), ("u", "x"), (None, "y"), ("u", ""), ("u", None)], "url string, vid string")
    assert [r.u for r in df.select(urls.watch_url(F.col("url"), F.col("vid"), "p/").alias("u")).collect()] == ["p/x", "u", "p/y", None, None]
    assert urls.candidate_sources("a b", ["s"], 5) == ["search5:a b", "s"] and urls.candidate_sources("a b", [], 5, True) == ["search-cc:a+b"]
    lang, phrase = spark.createDataFrame([("hi",), ("ta",)], "language string"), spark.createDataFrame([("p",), ("q",)], "phrase string")
    assert urls.query_matrix(lang, phrase).count() == 4
