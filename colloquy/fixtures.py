"""Derived input tables for the registered queries, as SQL text that runs unchanged on Spark and on the oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .runtime import table

SEGMENTS = "SELECT DISTINCT clip_id, seg_idx, speaker, start_ms, end_ms FROM segments WHERE clip_id IS NOT NULL AND speaker IS NOT NULL AND end_ms - start_ms >= 300"
TOTALS = f"SELECT clip_id, max(end_ms) + 500 AS total_ms FROM ({SEGMENTS}) s GROUP BY clip_id"
VOTES = """
SELECT CAST(user_id AS VARCHAR(20)) AS clip_id, CAST(event_id AS INT) AS win,
  CASE event_type WHEN 'click' THEN 'hi-IN' WHEN 'view' THEN ' HI ' WHEN 'purchase' THEN 'hi' WHEN 'error' THEN 'te' ELSE NULL END AS language_code,
  CASE event_type WHEN 'error' THEN 'Telugu' WHEN 'signup' THEN NULL ELSE 'Hindi' END AS language,
  CAST(event_id % 4 AS INT) AS num_speakers, CASE WHEN event_id % 7 = 0 THEN NULL ELSE event_id % 3 <> 0 END AS is_conversational
FROM events"""
CANDIDATES = """
SELECT o_orderkey AS vid, o_totalprice / 30 AS duration, CASE WHEN o_orderkey % 5 = 0 THEN 'Creative Commons Attribution' ELSE '' END AS license,
  CAST((o_custkey * 37) % 1000 AS DOUBLE) / 1000 AS speech_ratio, CAST((o_orderkey * 31) % 4 AS INT) AS num_speakers,
  CASE WHEN o_orderkey % 3 = 0 THEN 'te' WHEN o_orderkey % 7 = 0 THEN '' ELSE 'hi' END AS language_code,
  CASE WHEN o_orderkey % 3 = 0 THEN 'telugu' ELSE 'hindi' END AS language, o_orderkey % 11 <> 0 AS is_conversational,
  o_orderkey % 13 = 0 AS music_dominant, o_orderkey % 17 = 0 AS is_dubbed, o_orderkey % 19 = 0 AS verify_missing
FROM orders"""
RUN_CANDIDATES = f"""
SELECT clip_id AS vid, CAST(last_ms + 20000 AS DOUBLE) / 1000 AS duration, '' AS license, CASE WHEN a % 17 = 0 THEN 0.3 WHEN a % 19 = 0 THEN 0.99 ELSE 0.8 END AS speech_ratio, CASE WHEN a % 23 = 0 THEN 1 ELSE 2 END AS num_speakers,
  CASE WHEN a % 13 = 0 THEN 'ta' ELSE 'hi' END AS language_code, 'hindi' AS language, a % 29 <> 0 AS is_conversational, a % 31 = 0 AS music_dominant, false AS is_dubbed, a % 37 = 0 AS verify_missing
FROM (SELECT clip_id, max(end_ms) AS last_ms, ascii(substr(clip_id, 2, 1)) AS a FROM ({SEGMENTS}) s GROUP BY clip_id) c"""
STATE_LOG = """
SELECT event_id % 500 AS vid, event_id AS seq, CASE event_type WHEN 'purchase' THEN 'accepted' WHEN 'error' THEN 'rejected' ELSE 'pending' END AS status,
  CASE WHEN event_type = 'error' THEN 'few_turns' ELSE '' END AS reason
FROM events"""
URLS = "SELECT concat('https://v.example/', CAST((event_id * 7) % 900 AS VARCHAR(20))) AS url, event_id AS pos, CAST(user_id % 20 AS INT) AS list_id FROM events"
PAIRS = "SELECT a.vec_id AS clip_id, a.embedding AS ch0, b.embedding AS ch1 FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1 WHERE a.vec_id % 2 = 0"
CHUNKS = "SELECT CAST(floor(a.vec_id / 2) AS INT) % 7 AS clip_id, CAST(floor(a.vec_id / 14) AS BIGINT) AS i, a.embedding AS ch0, b.embedding AS ch1 FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1 WHERE a.vec_id % 2 = 0"

_TIMES = """CASE WHEN {plain} THEN CAST(pos * 350 + (length(word) * 13) % 90 AS BIGINT) END AS start_ms,
  CASE WHEN {plain} THEN CAST(pos * 350 + (length(word) * 13) % 90 + 40 + (length(word) * 61) % 200 AS BIGINT) END AS end_ms"""
WORDS_SPARK = f"""
SELECT CAST(audio_id AS STRING) AS clip_id, 0 AS channel, CAST(pos AS INT) AS idx, word, {_TIMES.format(plain="regexp_like(word, '^[A-Za-z]+$')")}
FROM nemo_audio LATERAL VIEW posexplode(filter(split(transcript, '[ \\n]+'), x -> x <> '')) t AS pos, word"""
WORDS_SQL = f"""
SELECT CAST(audio_id AS VARCHAR) AS clip_id, 0 AS channel, CAST(pos AS INT) AS idx, word, {_TIMES.format(plain="regexp_full_match(word, '[A-Za-z]+')")}
FROM (SELECT audio_id, unnest(ws) AS word, unnest(range(len(ws))) AS pos FROM (SELECT audio_id, list_filter(string_split_regex(transcript, '[ \\n]+'), lambda x: x <> '') AS ws FROM nemo_audio) a) u"""
TURNS = "SELECT clip_id, channel, k AS seg_idx, CAST(k * 4000 AS BIGINT) AS start_ms, CAST(k * 4000 + 3600 AS BIGINT) AS end_ms FROM (SELECT DISTINCT clip_id, channel, CAST(floor(start_ms / 4000) AS INT) AS k FROM words WHERE start_ms IS NOT NULL) d"
WORD_TOTALS = "SELECT clip_id, CAST(max(idx) * 350 + 1000 AS BIGINT) AS total_ms FROM words GROUP BY clip_id"


def derive(spark: SparkSession, d: str, sql: str, **views: DataFrame) -> DataFrame:
    """The fixture over the folder's tables, read under names of their own (nothing is left in the catalog's way)."""
    import re

    names = {n for n in re.findall(r"(?:FROM|JOIN)\s+(\w+)", sql)}
    return spark.sql(re.sub(r"\b(FROM|JOIN)\s+(\w+)", lambda m: f"{m[1]} {{{m[2]}}}", sql), **{n: views[n] if n in views else table(spark, d, n) for n in names})
