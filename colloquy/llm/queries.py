"""Registered queries of the operators for training data: name -> (query, SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import table
from . import groups, history, mixture, mojibake, repetition, tokens, windows

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Query, str | None]] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def put(f: Query) -> Query:
        REGISTRY[name] = (f, sql)
        return f

    return put


_NAME = r"regexp_extract(replace(trim(path), '\', '/'), '([^/]*)$', 1)"
_CLIP = rf"regexp_extract({_NAME}, '^(.+)_\d+(\.[A-Za-z0-9]+)?\s*$', 1)"

_P1 = rf"""
WITH w AS (SELECT DISTINCT path, {_CLIP} AS clip_id, offset_ms AS a, offset_ms + len AS b
  FROM (SELECT *, CAST(coalesce(n_frames * 80, round(duration * 1000)) AS BIGINT) AS len FROM train) t WHERE len > 180000),
v AS (SELECT clip_id, start_ms, max(end_ms) AS end_ms FROM segments WHERE clip_id IS NOT NULL AND end_ms > start_ms GROUP BY clip_id, start_ms),
f AS (SELECT clip_id, start_ms, max(end_ms) OVER (PARTITION BY clip_id ORDER BY start_ms ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM v),
c AS (SELECT path, a + 2000 AS moment FROM w UNION ALL SELECT path, b FROM w
  UNION ALL SELECT path, start_ms FROM w JOIN f ON w.clip_id = f.clip_id AND start_ms > a + 2000 AND start_ms < b WHERE reach IS NULL OR reach <= start_ms),
g AS (SELECT path, moment - lag(moment) OVER (PARTITION BY path ORDER BY moment) AS step FROM c)
SELECT path, CASE WHEN max(step) <= 178000 THEN 'natural' ELSE 'hard' END AS kind FROM g GROUP BY path"""

_ID = "[A-Za-z0-9_-]{11}"
_NAMED = rf"""
a0 AS (SELECT *, regexp_replace(vid, '^\s+|\s+$', '', 'g') AS v0, replace(regexp_replace(url, '^\s+|\s+$', '', 'g'), '&amp;', '&') AS u0 FROM videos),
a1 AS (SELECT *, CASE WHEN regexp_matches(u0, '^[^?#]*/redirect/?\?') THEN url_decode(regexp_extract(u0, '[?&]q=([^&#]+)', 1)) ELSE u0 END AS u1 FROM a0),
a2 AS (SELECT *, regexp_extract(v0, '({_ID})/?$', 1) AS i1, regexp_extract(url_decode(regexp_extract(u1, '^[^?#]*\?(?:[^#]*?&)?v=([^&#]*)', 1)), '^({_ID})$', 1) AS i2,
  regexp_extract(url_decode(regexp_extract(u1, '(?i)^(?:https?://)?[^/?#]+/(?:(?:embed|live|shorts|v|e)/)?([^/?#]+)', 1)), '^({_ID})$', 1) AS i3 FROM a1),
named AS (SELECT row_id, batch_no, status, channel_id, coalesce(nullif(i1, ''), nullif(i2, ''), nullif(i3, '')) AS id,
  list_filter(regexp_split_to_array(lower(url_decode(replace(regexp_extract(u1, '(?i)/talks/([^?#]*)', 1), '+', ' '))), '[^a-z0-9]+'), lambda x: x <> '') AS words FROM a2)"""

_P2 = rf"""
WITH RECURSIVE {_NAMED},
t AS (SELECT DISTINCT words FROM named WHERE id IS NULL AND len(words) > 0),
e AS (SELECT x.words AS a, y.words AS b FROM t x JOIN t y ON len(x.words) = len(y.words) AND list_bool_and(list_transform(range(1, len(x.words) + 1), lambda i: x.words[i] = y.words[i]
  OR (NOT regexp_matches(x.words[i] || y.words[i], '[0-9]') AND damerau_levenshtein(x.words[i], y.words[i]) <= CASE WHEN least(length(x.words[i]), length(y.words[i])) >= 5 THEN 2 ELSE 1 END)))),
reach AS (SELECT a, b FROM e UNION SELECT reach.a, e.b FROM reach JOIN e ON reach.b = e.a),
class AS (SELECT a AS words, min(array_to_string(b, ' ')) AS class FROM reach GROUP BY a),
k AS (SELECT row_id, batch_no, status, CASE WHEN id IS NOT NULL THEN 'v:' || id ELSE 't:' || class END AS k FROM named LEFT JOIN class ON named.id IS NULL AND named.words = class.words),
o AS (SELECT k, min(row_id) AS old_row FROM k WHERE status = 'accepted' AND k IS NOT NULL GROUP BY k)
SELECT old_row, k.row_id AS new_row FROM k JOIN o ON k.k = o.k JOIN videos v ON v.row_id = o.old_row WHERE v.batch_no < k.batch_no"""

_P4 = rf"""
WITH {_NAMED},
c AS (SELECT id, min(channel_id) AS channel FROM named WHERE id IS NOT NULL AND channel_id IS NOT NULL GROUP BY id),
t AS (SELECT path, split, left({_CLIP}, 11) AS vid FROM train)
SELECT coalesce(channel, vid) AS group_id FROM t LEFT JOIN c ON t.vid = c.id GROUP BY 1 HAVING count(DISTINCT split) > 1"""


@query("p1_found", _P1)
def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Oversized windows, and whether natural boundaries alone can cut them."""
    return windows.pieces(table(spark, d, "train"), table(spark, d, "segments")).where("piece = 0").select("path", "kind")


_PIECES = rf"""
WITH RECURSIVE w AS (SELECT path, {_CLIP} AS clip_id, max(struct_pack(len := len, early := -offset_ms)) AS m
  FROM (SELECT *, CAST(coalesce(n_frames * 80, round(duration * 1000)) AS BIGINT) AS len FROM train) t WHERE len > 180000 AND path IS NOT NULL AND offset_ms IS NOT NULL GROUP BY 1, 2),
v AS (SELECT clip_id, start_ms, max(end_ms) AS end_ms FROM segments WHERE clip_id IS NOT NULL AND end_ms > start_ms GROUP BY clip_id, start_ms),
f AS MATERIALIZED (SELECT clip_id, start_ms AS at, greatest(0, start_ms - coalesce(reach, 0)) AS silence FROM (SELECT *, max(end_ms) OVER (PARTITION BY clip_id ORDER BY start_ms ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM v) x
  WHERE reach IS NULL OR reach <= start_ms),
r AS (SELECT path, clip_id, -m.early AS a, m.len - m.early AS finish, 0 AS piece, '' AS how FROM w
  UNION ALL SELECT path, clip_id, coalesce(best.at, a + 180000) - 2000, finish, piece + 1, CASE WHEN best IS NULL THEN 'hard' ELSE 'natural' END
  FROM (SELECT r.path, r.clip_id, r.a, r.finish, r.piece, max(CASE WHEN f.at IS NOT NULL THEN struct_pack(far := f.at >= r.a + 90000, silence := f.silence, at := f.at) END) AS best
    FROM r LEFT JOIN f ON f.clip_id = r.clip_id AND f.at > r.a + 2000 AND f.at <= r.a + 180000 AND f.at < r.finish WHERE r.finish - r.a > 180000 GROUP BY r.path, r.clip_id, r.a, r.finish, r.piece) b)
SELECT path, clip_id, CASE WHEN bool_or(how = 'hard') OVER p THEN 'hard' ELSE 'natural' END AS kind, CAST(piece AS INT) AS piece, CAST(a AS BIGINT) AS start_ms,
  CAST(coalesce(lead(a) OVER (PARTITION BY path ORDER BY piece) + 2000, finish) AS BIGINT) AS end_ms, coalesce(lead(how) OVER (PARTITION BY path ORDER BY piece), 'end') AS cut FROM r WINDOW p AS (PARTITION BY path)"""


@query("p1_pieces", _PIECES)
def p1_pieces(spark: SparkSession, d: str) -> DataFrame:
    """The pieces of every oversized window."""
    return windows.pieces(table(spark, d, "train"), table(spark, d, "segments"))


@query("p2_found", _P2)
def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """New rows that repeat an accepted row of an earlier batch."""
    return history.repeated_rows(table(spark, d, "videos"))


@query("p4_found", _P4)
def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """Groups of related windows that the present split tears apart."""
    return groups.torn_groups(groups.window_groups(table(spark, d, "train"), table(spark, d, "videos")))


_P4_WHOLE = _P4[: _P4.rindex("HAVING")].replace("SELECT coalesce(channel, vid) AS group_id", "SELECT coalesce(channel, vid) AS group_id, count(*) AS n_windows, CAST(1 AS BIGINT) AS n_sides")


@query("p4_whole", _P4_WHOLE)
def p4_whole(spark: SparkSession, d: str) -> DataFrame:
    """Every group's windows, and on how many sides they are."""
    rows = groups.assign_splits(table(spark, d, "train"), table(spark, d, "videos"))
    return rows.groupBy("group_id").agg(F.count("*").alias("n_windows"), F.count_distinct("side").alias("n_sides"))


@query("p4_assignment")
def p4_assignment(spark: SparkSession, d: str) -> DataFrame:
    """The side of every window."""
    return groups.assign_splits(table(spark, d, "train"), table(spark, d, "videos"))


_P5 = r"""
WITH w AS (SELECT audio_id, list_filter(regexp_split_to_array(lower(transcript), '[\s\p{Z}\p{P}]+'), lambda x: x <> '') AS ws FROM nemo_audio WHERE transcript IS NOT NULL),
p AS (SELECT audio_id, len(ws) AS n, unnest(range(1, len(ws) - 2)) AS i, ws FROM w WHERE len(ws) >= 4),
r AS (SELECT audio_id, n, i, row_number() OVER (PARTITION BY audio_id, ws[i], ws[i + 1], ws[i + 2], ws[i + 3] ORDER BY i) AS k FROM p),
m AS (SELECT DISTINCT audio_id, n, unnest(range(i, i + 4)) AS at FROM r WHERE k > 1)
SELECT audio_id FROM m GROUP BY audio_id, n HAVING count(*) >= 0.3 * n"""


@query("p5_found", _P5)
def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Transcripts at least 0.3 of whose words are repeated."""
    return repetition.repetitive(table(spark, d, "nemo_audio"))


@query("p5_shares", _P5[: _P5.rindex("SELECT audio_id")].replace("WHERE transcript IS NOT NULL", "") + """, s AS (SELECT audio_id, count(*) AS k FROM m GROUP BY audio_id)
SELECT w.audio_id, coalesce(len(ws), 0) AS words, round(coalesce(k, 0) / greatest(1, coalesce(len(ws), 0)), 6) AS repeated_share FROM w LEFT JOIN s USING (audio_id)""")
def p5_shares(spark: SparkSession, d: str) -> DataFrame:
    """The words and the share of repeated words of every transcript."""
    rows = repetition.measures(table(spark, d, "nemo_audio"), "audio_id", "transcript", share=0.0)
    return rows.select("audio_id", "words", F.round(F.coalesce("repeated_share", F.lit(0.0)), 6).alias("repeated_share"))


@query("p5_measures")
def p5_measures(spark: SparkSession, d: str) -> DataFrame:
    """Tokenizer measures, their bands by script, and the share of repeated words of every transcript; share 0 bars no row."""
    return repetition.rejected(repetition.measures(table(spark, d, "nemo_audio"), "audio_id", "transcript", share=0.0))


@query("p6_ids")
def p6_ids(spark: SparkSession, d: str) -> DataFrame:
    """Token ids of every document."""
    return tokens.encode(table(spark, d, "documents"))


@query("p6_decoded", "SELECT doc_id, coalesce(text, '') AS text FROM documents")
def p6_decoded(spark: SparkSession, d: str) -> DataFrame:
    """Every document's text, read back from its token ids."""
    return tokens.decode_rows(tokens.encode(table(spark, d, "documents")))


@query("p7_mix")
def p7_mix(spark: SparkSession, d: str) -> DataFrame:
    """Every listed document with its repeats, and its source's target and actual share."""
    used, shares = mixture.mix(table(spark, d, "documents"), table(spark, d, "mix_targets"))
    return used.join(shares.select("source", "target_share", "actual_share"), "source").select("doc_id", "source", "tokens", "repeats", "target_share", "actual_share")


@query("p7_shares")
def p7_shares(spark: SparkSession, d: str) -> DataFrame:
    """Target, planned and actual share of every source."""
    return mixture.mix(table(spark, d, "documents"), table(spark, d, "mix_targets"))[1]


@query("p7_sources", """SELECT t.source, t.weight AS target_share, CAST(t.max_repeats AS BIGINT) AS max_repeats, coalesce(n, 0) AS documents, FALSE AS over_cap, TRUE AS kept_plan
FROM mix_targets t LEFT JOIN (SELECT source, count(*) AS n FROM documents GROUP BY source) d ON d.source = t.source""")
def p7_sources(spark: SparkSession, d: str) -> DataFrame:
    """Each source's documents, whether any is used too often, and whether the tokens given are near the plan (five standard deviations of Poisson draws)."""
    used, shares = mixture.mix(table(spark, d, "documents"), table(spark, d, "mix_targets"))
    squares = used.groupBy("source").agg(F.max("repeats").alias("most"), F.sum(F.col("tokens").cast("double") * F.col("tokens")).alias("sq"))
    off = F.abs(F.col("tokens_given") - F.col("rate") * F.col("tokens"))
    rows = shares.join(squares, "source", "left")
    return rows.select("source", "target_share", "max_repeats", "documents", (F.coalesce("most", F.lit(0)) > F.col("max_repeats")).alias("over_cap"), (off <= 5 * F.sqrt(F.coalesce("sq", F.lit(0.0)) * F.col("rate")) + 1).alias("kept_plan"))


@query("p7_stream")
def p7_stream(spark: SparkSession, d: str) -> DataFrame:
    """Every use of a document, in global random order."""
    return mixture.shuffled_copies(mixture.mix(table(spark, d, "documents"), table(spark, d, "mix_targets"))[0])


@query("p8_found")
def p8_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents holding text decoded with a wrong encoding."""
    return mojibake.restored(table(spark, d, "documents")).select("doc_id")


@query("p8_restored")
def p8_restored(spark: SparkSession, d: str) -> DataFrame:
    """The affected documents with the original text as far as it can be had back."""
    documents = table(spark, d, "documents")
    return mojibake.repair_lost(documents, mojibake.restored(documents))
