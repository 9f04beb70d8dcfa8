"""Registered queries of the core: name -> (query, SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fixtures as fx
from .config import INDIC, Thresholds
from .functions import records, replies
from .operators import coverage, gates, mining, ranges, segments, signal, state, stats, urls, votes, words
from .operators.ordered import ratio
from .runtime import shared_path, table
from .sources import sinks
from .streaming import incremental

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Query, str | None]] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def put(f: Query) -> Query:
        REGISTRY[name] = (f, sql)
        return f

    return put


def _ratio(n: str, d: str, places: int) -> str:
    s = 10**places
    return f"CAST(({n}) * {2 * s} + ({d}) AS BIGINT) // nullif(CAST(2 * ({d}) AS BIGINT), 0) / {s}.0::DOUBLE"


def _segments(spark: SparkSession, d: str) -> DataFrame:
    return segments.clean_segments(table(spark, d, "segments"))


def _totals(segs: DataFrame) -> DataFrame:
    return segs.groupBy("clip_id").agg((F.max("end_ms") + 500).alias("total_ms"))


# --- coverage of clips ---

_VALID = "SELECT clip_id, start_ms, end_ms FROM segments WHERE clip_id IS NOT NULL AND end_ms > start_ms"
_REACH = f"SELECT *, max(end_ms) OVER (PARTITION BY clip_id ORDER BY start_ms, end_ms ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM ({_VALID}) v"
_ISLANDS = f"SELECT *, sum(CASE WHEN reach IS NULL OR start_ms > reach THEN 1 ELSE 0 END) OVER (PARTITION BY clip_id ORDER BY start_ms, end_ms ROWS UNBOUNDED PRECEDING) AS g FROM ({_REACH}) r"


@query("p3_found", f"SELECT clip_id, reach AS gap_start_ms, start_ms AS gap_end_ms FROM ({_REACH}) r WHERE start_ms - reach >= 400")
def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Uncovered stretches of at least 400 ms inside a clip."""
    rows = coverage.periods_and_gaps(table(spark, d, "segments"))
    gaps = rows.where((F.col("kind") == "gap") & (F.col("end_ms") - F.col("start_ms") >= 400))
    return gaps.select(F.col("entity").alias("clip_id"), F.col("start_ms").alias("gap_start_ms"), F.col("end_ms").alias("gap_end_ms"))


@query("p3_periods", f"SELECT clip_id, min(start_ms) AS period_start_ms, max(end_ms) AS period_end_ms FROM ({_ISLANDS}) i GROUP BY clip_id, g")
def p3_periods(spark: SparkSession, d: str) -> DataFrame:
    """Continuous periods of every clip."""
    rows = coverage.periods_and_gaps(table(spark, d, "segments")).where("kind = 'period'")
    return rows.select(F.col("entity").alias("clip_id"), F.col("start_ms").alias("period_start_ms"), F.col("end_ms").alias("period_end_ms"))


# --- segments ---

_S = f"s AS ({fx.SEGMENTS})"
_LATER = "a.clip_id = b.clip_id AND a.speaker <> b.speaker AND (a.start_ms < b.start_ms OR (a.start_ms = b.start_ms AND a.seg_idx < b.seg_idx)) AND b.start_ms < a.end_ms"
_STATS = f"""
WITH {_S}, w AS (SELECT *, lag(speaker) OVER o AS ps, lead(speaker) OVER o AS ns, lag(end_ms) OVER o AS pe FROM s WINDOW o AS (PARTITION BY clip_id ORDER BY start_ms, seg_idx)),
b AS (SELECT clip_id, count(*) AS n_segments, count(*) FILTER (ps <> speaker) AS n_turns, count(*) FILTER (end_ms - start_ms < 1200 AND ps = ns AND ps <> speaker) AS backchannels,
  max(end_ms) AS duration_ms, CAST(sum(end_ms - start_ms) AS BIGINT) AS talk_ms, count(*) FILTER (ps <> speaker AND start_ms > pe) AS n_gaps,
  CAST(coalesce(sum(start_ms - pe) FILTER (ps <> speaker AND start_ms > pe), 0) AS BIGINT) AS gap_ms, median(end_ms - start_ms) AS median_turn_ms FROM w GROUP BY clip_id),
p AS (SELECT clip_id, count(*) AS n_speakers, max(ms) AS most_ms FROM (SELECT clip_id, speaker, sum(end_ms - start_ms) AS ms FROM s GROUP BY ALL) x GROUP BY clip_id),
o AS (SELECT a.clip_id, CAST(sum(least(a.end_ms, b.end_ms) - b.start_ms) AS BIGINT) AS overlap FROM s a JOIN s b ON {_LATER} GROUP BY a.clip_id),
j AS (SELECT b.*, n_speakers, most_ms, coalesce(overlap, 0) AS overlap_ms FROM b JOIN p USING (clip_id) LEFT JOIN o USING (clip_id)),
st AS (SELECT clip_id, n_speakers, n_segments, n_turns, backchannels, duration_ms, talk_ms, overlap_ms, median_turn_ms, {_ratio("most_ms", "talk_ms", 3)} AS dominance,
  coalesce({_ratio("n_turns * 60000", "duration_ms", 2)}, 0.0) AS turns_per_min, {_ratio("overlap_ms", "talk_ms", 4)} AS overlap_ratio,
  coalesce({_ratio("gap_ms", "n_gaps * 1000", 3)}, 0.0) AS mean_gap, {_ratio("talk_ms", "duration_ms", 3)} AS speech_ratio FROM j)"""
_REASON = "CASE WHEN n_speakers <> 2 THEN 'diar_speaker_count' WHEN n_turns < 20 OR turns_per_min < 3 THEN 'few_turns' WHEN dominance > 0.75 THEN 'imbalanced' WHEN overlap_ratio < 0.005 OR overlap_ratio > 0.35 THEN 'overlap_out_of_range' ELSE '' END AS reason"


@query("conversation_stats", f"{_STATS} SELECT *, {_REASON} FROM st")
def conversation_stats(spark: SparkSession, d: str) -> DataFrame:
    return stats.qualify(stats.conversation_stats(_segments(spark, d)))


@query("qualify_reason", f"{_STATS} SELECT reason, count(*) AS n FROM (SELECT {_REASON} FROM st) r GROUP BY reason")
def qualify_reason(spark: SparkSession, d: str) -> DataFrame:
    return stats.qualify(stats.conversation_stats(_segments(spark, d))).groupBy("reason").agg(F.count("*").alias("n"))


@query("talk_time", f"WITH {_S}, t AS (SELECT clip_id, speaker, CAST(sum(end_ms - start_ms) AS BIGINT) AS talk_ms FROM s GROUP BY ALL) SELECT *, {_ratio('talk_ms', 'sum(talk_ms) OVER (PARTITION BY clip_id)', 3)} AS share FROM t")
def talk_time(spark: SparkSession, d: str) -> DataFrame:
    return stats.talk_time(_segments(spark, d))


@query("overlap_pairs", f"WITH {_S} SELECT a.clip_id, a.seg_idx AS a_idx, b.seg_idx AS b_idx, least(a.end_ms, b.end_ms) - b.start_ms AS overlap_ms FROM s a JOIN s b ON {_LATER}")
def overlap_pairs(spark: SparkSession, d: str) -> DataFrame:
    return segments.overlap_pairs(_segments(spark, d))


@query("mark_overlaps", f"""WITH {_S}, m AS (SELECT a.clip_id, a.seg_idx, a.speaker, a.start_ms, a.end_ms, CAST(sum(least(a.end_ms, b.end_ms) - greatest(a.start_ms, b.start_ms)) AS BIGINT) AS o
  FROM s a JOIN s b ON a.clip_id = b.clip_id AND a.speaker <> b.speaker AND a.start_ms < b.end_ms AND b.start_ms < a.end_ms GROUP BY ALL)
SELECT s.*, coalesce(o, 0) AS overlap_ms, coalesce(o, 0) = 0 AS clean, {_ratio("coalesce(o, 0)", "s.end_ms - s.start_ms", 3)} AS overlap_frac FROM s LEFT JOIN m USING (clip_id, seg_idx, speaker, start_ms, end_ms)""")
def mark_overlaps(spark: SparkSession, d: str) -> DataFrame:
    return segments.mark_overlaps(_segments(spark, d)).withColumn("overlap_frac", ratio(F.col("overlap_ms"), F.col("end_ms") - F.col("start_ms"), 3))


_GROUPS = f"""{_S}, g0 AS (SELECT *, CASE WHEN start_ms - lag(end_ms) OVER (PARTITION BY clip_id ORDER BY start_ms, seg_idx) >= 5000 THEN 1 ELSE 0 END AS o FROM s),
g AS (SELECT clip_id, seg_idx, speaker, start_ms, end_ms, CAST(sum(o) OVER (PARTITION BY clip_id ORDER BY start_ms, seg_idx ROWS UNBOUNDED PRECEDING) AS BIGINT) AS grp FROM g0)"""


@query("silence_groups", f"WITH {_GROUPS} SELECT * FROM g")
def silence_groups(spark: SparkSession, d: str) -> DataFrame:
    return segments.silence_groups(_segments(spark, d))


_MINED = f"""{_GROUPS}, b AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY clip_id, grp ORDER BY start_ms, seg_idx) AS rn FROM g),
r AS (SELECT clip_id, grp, rn, start_ms, end_ms, speaker, 1 AS run, speaker AS s1, CAST(NULL AS VARCHAR) AS s2 FROM b WHERE rn = 1
  UNION ALL SELECT clip_id, grp, rn, start_ms, end_ms, speaker, run + third, CASE WHEN third = 1 THEN speaker ELSE s1 END, CASE WHEN third = 1 THEN NULL WHEN s2 IS NULL AND speaker <> s1 THEN speaker ELSE s2 END
  FROM (SELECT b.*, r.run, r.s1, r.s2, CASE WHEN r.s2 IS NOT NULL AND b.speaker <> r.s1 AND b.speaker <> r.s2 THEN 1 ELSE 0 END AS third FROM r JOIN b ON r.clip_id = b.clip_id AND r.grp = b.grp AND b.rn = r.rn + 1) n),
u AS (SELECT clip_id, grp, run, min(start_ms) AS t0, arg_max(end_ms, rn) AS t1, min(rn) AS first_rn FROM r GROUP BY clip_id, grp, run HAVING count(s2) > 0 AND arg_max(end_ms, rn) - min(start_ms) >= 120000),
k AS MATERIALIZED (SELECT r.clip_id, r.grp, r.run, r.rn - u.first_rn + 1 AS rn, r.start_ms, r.end_ms, r.speaker, u.t0, u.t1, u.t1 - u.t0 > 600000 AS long FROM r JOIN u USING (clip_id, grp, run)),
c AS (SELECT *, 1 AS chunk, t0 AS chunk_start, long AND end_ms - t0 >= 600000 AS closes FROM k WHERE rn = 1
  UNION ALL SELECT k.*, c.chunk + CASE WHEN c.closes THEN 1 ELSE 0 END, CASE WHEN c.closes THEN c.end_ms ELSE c.chunk_start END, k.long AND k.end_ms - CASE WHEN c.closes THEN c.end_ms ELSE c.chunk_start END >= 600000
  FROM c JOIN k ON k.clip_id = c.clip_id AND k.grp = c.grp AND k.run = c.run AND k.rn = c.rn + 1),
m AS (SELECT clip_id, arg_min(start_ms, rn) AS t0, arg_max(end_ms, rn) AS t1, list_sort(list(DISTINCT speaker)) AS pair FROM c GROUP BY clip_id, grp, run, chunk, long
  HAVING arg_max(end_ms, rn) - arg_min(start_ms, rn) >= 120000 AND (NOT long OR bool_or(closes) OR arg_max(end_ms, rn) - min(chunk_start) >= 120000))"""


@query("mine_two_speaker", f"WITH RECURSIVE {_MINED} SELECT clip_id, t0, t1, array_to_string(pair, ' ') AS pair FROM m")
def mine_two_speaker(spark: SparkSession, d: str) -> DataFrame:
    return mining.mine_two_speaker(_segments(spark, d)).withColumn("pair", F.array_join("pair", " "))


@query("clip_window_segments", f"""WITH RECURSIVE {_MINED} SELECT s.clip_id, t0, seg_idx, speaker, greatest(0, start_ms - t0) AS start_ms, least(t1, end_ms) - t0 AS end_ms
FROM s JOIN m ON s.clip_id = m.clip_id AND s.end_ms > t0 AND s.start_ms < t1 AND list_contains(pair, speaker)""")
def clip_window_segments(spark: SparkSession, d: str) -> DataFrame:
    segs = _segments(spark, d)
    mined = mining.mine_two_speaker(segs).withColumn("win", F.col("t0"))
    return segments.clip_to_windows(segs, mined).withColumnRenamed("win", "t0")


_CUTS = f"""{_S}, t AS (SELECT clip_id, max(end_ms) + 500 AS total_ms FROM s GROUP BY clip_id),
h AS (SELECT clip_id, start_ms, max(end_ms) OVER (PARTITION BY clip_id ORDER BY start_ms, seg_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM s),
cuts AS (SELECT clip_id, coalesce(reach, 0) + start_ms AS cut2 FROM h WHERE start_ms - coalesce(reach, 0) >= 400 UNION ALL SELECT clip_id, 2 * total_ms - 500 FROM t)"""


@query("silence_cut_points", f"WITH {_CUTS} SELECT clip_id, cut2 FROM cuts")
def silence_cut_points(spark: SparkSession, d: str) -> DataFrame:
    segs = _segments(spark, d)
    return segments.cut_points(segs, _totals(segs))


_PLAN = f"""{_CUTS}, p AS (SELECT clip_id, 2 * total_ms AS total2, CAST(0 AS BIGINT) AS pos FROM t
  UNION ALL SELECT p.clip_id, total2, coalesce(min(struct_pack(d := abs(cut2 - pos - 240000), c := cut2)).c, pos + 240000) FROM p LEFT JOIN cuts ON cuts.clip_id = p.clip_id AND cut2 > pos + 60000 AND cut2 < pos + 360000
  WHERE total2 - pos > 360000 GROUP BY p.clip_id, total2, pos),
sp AS (SELECT clip_id, pos AS a2, coalesce(lead(pos) OVER (PARTITION BY clip_id ORDER BY pos), total2) AS b2 FROM p),
spans AS (SELECT clip_id, CAST(row_number() OVER (PARTITION BY clip_id ORDER BY a2) - 1 AS INT) AS win, a2, b2 FROM sp WHERE b2 - a2 >= 60000)"""


@query("plan_windows", f"WITH RECURSIVE {_PLAN} SELECT * FROM spans")
def plan_windows(spark: SparkSession, d: str) -> DataFrame:
    segs = _segments(spark, d)
    totals = _totals(segs)
    return mining.plan_windows(segments.cut_points(segs, totals), totals)


@query("snap_windows", f"""WITH RECURSIVE {_PLAN}, f AS (SELECT clip_id, win, (b2 - a2) // 160 AS n_frames, a2 * 12 AS first_sample, t.total_ms * 24 AS n FROM spans JOIN t USING (clip_id)),
q AS (SELECT clip_id, win, n_frames, first_sample, least(first_sample + n_frames * 1920, n) AS last_sample FROM f) SELECT * FROM q WHERE (last_sample - first_sample) * 1000 >= 30000 * 24000""")
def snap_windows(spark: SparkSession, d: str) -> DataFrame:
    segs = _segments(spark, d)
    totals = _totals(segs)
    return ranges.snap_spans(mining.plan_windows(segments.cut_points(segs, totals), totals), totals)


@query("rttm_lines", f"""WITH {_S} SELECT clip_id, start_ms, seg_idx, format('SPEAKER {{}} 1 {{}}.{{:03d}} {{}}.{{:03d}} <NA> <NA> {{}} <NA> <NA>', clip_id, start_ms // 1000, start_ms % 1000, (end_ms - start_ms) // 1000, (end_ms - start_ms) % 1000, speaker) AS line FROM s""")
def rttm_lines(spark: SparkSession, d: str) -> DataFrame:
    return sinks.rttm_lines(_segments(spark, d))


@query("export_manifest", f"""{_STATS} SELECT clip_id AS id, concat('accepted/', clip_id, '/stereo.wav') AS stereo_filepath, concat('accepted/', clip_id, '/spk0.wav accepted/', clip_id, '/spk1.wav') AS channel_filepaths,
duration_ms / 1000.0::DOUBLE AS duration, overlap_ratio, turns_per_min FROM (SELECT *, {_REASON} FROM st) r WHERE reason = ''""")
def export_manifest(spark: SparkSession, d: str) -> DataFrame:
    kept = gates.split_by_reason(stats.qualify(stats.conversation_stats(_segments(spark, d))))[0]
    manifest = kept.select(
        F.col("clip_id").alias("id"), (F.col("duration_ms") / 1000.0).alias("duration"), F.lit("hi").alias("language_code"), F.lit(None).cast("string").alias("license"), F.lit(None).cast("string").alias("source"),
        F.struct("overlap_ratio", "turns_per_min").alias("conversation"), F.struct(F.array(F.lit("spk0.wav"), F.lit("spk1.wav")).alias("channels")).alias("files"),
    )
    rows = sinks.export_rows(manifest, F.lit("accepted"))
    return rows.select("id", "stereo_filepath", F.array_join("channel_filepaths", " ").alias("channel_filepaths"), "duration", "overlap_ratio", "turns_per_min")


# --- gates, votes, state ---

_LIGHT = """CASE WHEN duration < 120 THEN 'too_short' WHEN duration > 14400 THEN 'too_long' {cc} WHEN speech_ratio < 0.45 THEN 'low_speech' WHEN speech_ratio > 0.98 THEN 'high_speech' WHEN verify_missing THEN 'verify_failed'
 WHEN num_speakers < 2 THEN 'not_two_speakers' WHEN NOT (CASE WHEN language_code <> '' THEN language_code = 'hi' ELSE language = 'hindi' END) THEN 'not_indic' WHEN NOT is_conversational OR music_dominant OR is_dubbed THEN 'not_conversational' ELSE '' END"""


@query("light_gate_funnel", f"SELECT {_LIGHT.format(cc='')} AS reason, count(*) AS n FROM ({fx.CANDIDATES}) v GROUP BY 1")
def light_gate_funnel(spark: SparkSession, d: str) -> DataFrame:
    return fx.derive(spark, d, fx.CANDIDATES).groupBy(gates.light_reason().alias("reason")).agg(F.count("*").alias("n"))


_CC = "WHEN NOT contains(lower(license), 'creative commons') THEN 'license'"


@query("light_gate_cc", f"SELECT vid, {_LIGHT.format(cc=_CC)} AS reason FROM ({fx.CANDIDATES}) v")
def light_gate_cc(spark: SparkSession, d: str) -> DataFrame:
    return fx.derive(spark, d, fx.CANDIDATES).select("vid", gates.light_reason(Thresholds(cc_only=True)).alias("reason"))


@query("funnel_rollup", "SELECT status, reason, count(*) AS n FROM videos GROUP BY ROLLUP (status, reason) HAVING grouping(status) + grouping(reason) IN (0, 2)")
def funnel_rollup(spark: SparkSession, d: str) -> DataFrame:
    return state.funnel(table(spark, d, "videos"))


@query("status_tally", "SELECT coalesce(status, 'none') AS status, count(*) AS n FROM videos GROUP BY 1")
def status_tally(spark: SparkSession, d: str) -> DataFrame:
    return state.tally(table(spark, d, "videos"), "status")


@query("accepted_hours", """SELECT count(*) AS n, CAST(sum(round(coalesce(duration, 0) * 100)) AS BIGINT) AS centiseconds, CAST(sum(round(coalesce(duration, 0) * 100)) AS BIGINT) / 360000.0::DOUBLE AS hours,
count(nullif(duration, 0)) AS n_known FROM videos WHERE status = 'accepted'""")
def accepted_hours(spark: SparkSession, d: str) -> DataFrame:
    return state.hours(table(spark, d, "videos").where("status = 'accepted'"))


@query("latest_state", f"SELECT vid, arg_max(seq, seq) AS seq, arg_max(status, seq) AS status, arg_max(reason, seq) AS reason FROM ({fx.STATE_LOG}) l GROUP BY vid")
def latest_state(spark: SparkSession, d: str) -> DataFrame:
    return state.latest(fx.derive(spark, d, fx.STATE_LOG), "vid", ["seq"], ["seq", "status", "reason"])


@query("undecided", f"""WITH l AS (SELECT vid, arg_max(status, seq) AS status FROM ({fx.STATE_LOG}) l GROUP BY vid)
SELECT v.vid FROM ({fx.CANDIDATES}) v WHERE NOT EXISTS (SELECT 1 FROM l WHERE l.vid = v.vid AND l.status IN ('accepted', 'rejected'))""")
def undecided(spark: SparkSession, d: str) -> DataFrame:
    last = state.latest(fx.derive(spark, d, fx.STATE_LOG), "vid", ["seq"], ["status"])
    return state.undecided(fx.derive(spark, d, fx.CANDIDATES).select("vid"), last, "vid")


_PARENT = "regexp_replace(clip_id, '_seg[0-9]+$', '')"


@query("parent_rollup", f"""{_STATS}, r AS (SELECT {_PARENT} AS parent, reason FROM (SELECT *, {_REASON} FROM st) x), n AS (SELECT parent, count(*) FILTER (reason = '') AS n FROM r GROUP BY parent)
SELECT parent AS vid, CASE WHEN n > 0 THEN 'accepted' ELSE 'rejected' END AS status, CASE WHEN n > 0 THEN concat(CAST(n AS VARCHAR), '_segment(s)') ELSE 'no_qualifying_2spk_segment' END AS reason FROM n""")
def parent_rollup(spark: SparkSession, d: str) -> DataFrame:
    judged = stats.qualify(stats.conversation_stats(_segments(spark, d)))
    rows = judged.select(ranges.source_of(F.col("clip_id")).alias("parent"), F.when(F.col("reason") == "", "accepted").otherwise("rejected").alias("status"))
    return state.parents(rows, rows.select(F.col("parent").alias("vid")))


_V = f"v AS ({fx.VOTES})"


@query("language_vote", f"""WITH {_V}, p AS (SELECT clip_id, split_part(lower(trim(coalesce(language_code, ''))), '-', 1) AS code, lower(trim(coalesce(language, ''))) AS name, count(*) AS n, min(win) AS first FROM v GROUP BY ALL),
k AS (SELECT *, CAST(sum(n) OVER (PARTITION BY clip_id) AS BIGINT) AS n_windows, row_number() OVER (PARTITION BY clip_id ORDER BY n DESC, first) AS rn FROM p)
SELECT clip_id, CASE WHEN n >= 0.6 * n_windows THEN code ELSE '' END AS language_code, CASE WHEN n >= 0.6 * n_windows THEN name ELSE '' END AS language, {_ratio('n', 'n_windows', 2)} AS agreement, n_windows FROM k WHERE rn = 1""")
def language_vote(spark: SparkSession, d: str) -> DataFrame:
    return votes.language_vote(fx.derive(spark, d, fx.VOTES))


@query("majority_vote", f"""WITH {_V}, c AS (SELECT clip_id, CAST(is_conversational AS VARCHAR) AS x, count(*) AS n FROM v WHERE is_conversational IS NOT NULL GROUP BY ALL),
k AS (SELECT *, row_number() OVER (PARTITION BY clip_id ORDER BY n DESC, x) AS rn FROM c), a AS (SELECT clip_id FROM v GROUP BY clip_id HAVING count(*) >= 2)
SELECT a.clip_id, coalesce(x = 'true', false) AS is_conversational FROM a LEFT JOIN k ON a.clip_id = k.clip_id AND rn = 1""")
def majority_vote(spark: SparkSession, d: str) -> DataFrame:
    return votes.verdicts(fx.derive(spark, d, fx.VOTES)).select("clip_id", "is_conversational")


@query("speaker_median", f"WITH {_V} SELECT clip_id, CAST(floor(median(num_speakers)) AS INT) AS num_speakers FROM v GROUP BY clip_id")
def speaker_median(spark: SparkSession, d: str) -> DataFrame:
    return votes.speaker_median(fx.derive(spark, d, fx.VOTES))


@query("json_votes", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events")
def json_votes(spark: SparkSession, d: str) -> DataFrame:
    reply = F.concat(F.lit("Here it is:\n```json\n"), "props", F.lit("\n```"))
    return table(spark, d, "events").select("event_id", replies.vote_of(reply, "k int")["k"].alias("k"))


@query("tolerant_meta", "SELECT row_id, CASE WHEN json_valid(meta) THEN CAST(json_extract_string(meta, '$.probe_ms') AS INT) END AS probe_ms FROM videos")
def tolerant_meta(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "videos").select("row_id", replies.vote_of(F.col("meta"), "probe_ms int")["probe_ms"].alias("probe_ms"))


# --- words and texts ---

_W = f"words AS ({fx.WORDS_SQL}), totals AS ({fx.WORD_TOTALS})"
_INTER = f"""{_W}, i0 AS (SELECT w.*, total_ms, coalesce(last_value(end_ms IGNORE NULLS) OVER (PARTITION BY clip_id, channel ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS t0,
  coalesce(first_value(start_ms IGNORE NULLS) OVER (PARTITION BY clip_id, channel ORDER BY idx ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), total_ms) AS nx,
  count(start_ms) OVER (PARTITION BY clip_id, channel ORDER BY idx ROWS UNBOUNDED PRECEDING) AS isl FROM words w JOIN totals USING (clip_id)),
i1 AS (SELECT *, greatest(t0, nx) - t0 AS len, start_ms IS NULL AS approx, row_number() OVER (PARTITION BY clip_id, channel, isl, start_ms IS NULL ORDER BY idx) - 1 AS k, count(*) OVER (PARTITION BY clip_id, channel, isl, start_ms IS NULL) AS n FROM i0),
inter AS (SELECT clip_id, channel, idx, word, CASE WHEN approx THEN t0 + (2 * k * len + n) // (2 * n) ELSE start_ms END AS start_ms, CASE WHEN approx THEN t0 + (2 * (k + 1) * len + n) // (2 * n) ELSE end_ms END AS end_ms, approx FROM i1)"""


def _words(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    w = fx.derive(spark, d, fx.WORDS_SPARK)
    return w, fx.derive(spark, d, fx.WORD_TOTALS, words=w)


@query("interpolate_words", f"WITH {_INTER} SELECT * FROM inter")
def interpolate_words(spark: SparkSession, d: str) -> DataFrame:
    return words.interpolate_words(*_words(spark, d))


@query("extend_word_ends", f"""WITH {_INTER}, e AS (SELECT inter.*, coalesce(lead(start_ms) OVER (PARTITION BY clip_id, channel ORDER BY idx), total_ms) AS nx FROM inter JOIN totals USING (clip_id))
SELECT clip_id, channel, idx, word, start_ms, CASE WHEN approx OR nx - end_ms <= 0 THEN end_ms WHEN nx - end_ms <= 250 THEN nx ELSE least(end_ms + 100, nx) END AS end_ms, approx FROM e""")
def extend_word_ends(spark: SparkSession, d: str) -> DataFrame:
    return words.repair_words(*_words(spark, d))


@query("turns_text", f"""WITH {_W}, turns AS ({fx.TURNS}) SELECT t.clip_id, t.channel, t.seg_idx, string_agg(w.word, ' ' ORDER BY w.start_ms, w.idx) AS text, count(*) AS n_words
FROM words w JOIN turns t ON w.clip_id = t.clip_id AND w.channel = t.channel AND w.start_ms >= t.start_ms AND w.start_ms < t.end_ms GROUP BY ALL""")
def turns_text(spark: SparkSession, d: str) -> DataFrame:
    w, _ = _words(spark, d)
    return segments.words_in_turns(w, fx.derive(spark, d, fx.TURNS, words=w))


@query("transcripts", f"""WITH {_INTER}, e AS (SELECT inter.*, coalesce(lead(start_ms) OVER (PARTITION BY clip_id, channel ORDER BY idx), total_ms) AS nx FROM inter JOIN totals USING (clip_id)),
turns AS ({fx.TURNS}) SELECT t.clip_id, t.channel, t.seg_idx, string_agg(w.word, ' ' ORDER BY w.start_ms, w.idx) AS text, count(*) AS n_words
FROM e w JOIN turns t ON w.clip_id = t.clip_id AND w.channel = t.channel AND w.start_ms >= t.start_ms AND w.start_ms < t.end_ms GROUP BY ALL""")
def transcripts(spark: SparkSession, d: str) -> DataFrame:
    """The turns with all their words, those without a time placed first."""
    from .plans.pipelines import assemble_transcripts

    w, totals = _words(spark, d)
    return assemble_transcripts(w, fx.derive(spark, d, fx.TURNS, words=w), totals)[1]


@query("word_counts", f"WITH {_W} SELECT clip_id, count(*) AS n_words, count(*) FILTER (start_ms IS NULL) AS n_unplaced FROM words GROUP BY clip_id")
def word_counts(spark: SparkSession, d: str) -> DataFrame:
    return _words(spark, d)[0].groupBy("clip_id").agg(F.count("*").alias("n_words"), F.count_if(F.col("start_ms").isNull()).alias("n_unplaced"))


_DEVA, _OTHER = r"len(regexp_extract_all(coalesce(text, ''), '[\x{0900}-\x{097F}]'))", r"len(regexp_extract_all(coalesce(text, ''), '[\x{0980}-\x{0DFF}\x{0600}-\x{06FF}A-Za-z]'))"


@query("script_stats", f"SELECT doc_id, CAST(d AS INT) AS devanagari, CAST(o AS INT) AS other_letters, CAST(d + o AS INT) AS n_letters, {_ratio('d', 'd + o', 4)} AS devanagari_frac FROM (SELECT doc_id, {_DEVA} AS d, {_OTHER} AS o FROM documents) x")
def script_stats(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", *[c.alias(n) for n, c in words.script_counts(F.col("text")).items()])


@query("ngram_repetition", r"""WITH w AS (SELECT audio_id, list_filter(string_split_regex(transcript, '[\s\x{00A0}\x{2000}-\x{200A}\x{3000}]+'), lambda x: x <> '') AS w FROM nemo_audio),
g AS (SELECT audio_id, list_transform(range(1, len(w) - 2), lambda i: concat(w[i], ' ', w[i + 1], ' ', w[i + 2], ' ', w[i + 3])) AS g FROM w WHERE len(w) >= 4)
SELECT audio_id, CAST(len(g) AS INT) AS n_grams, CAST(len(list_distinct(g)) AS INT) AS n_distinct FROM g""")
def ngram_repetition(spark: SparkSession, d: str) -> DataFrame:
    return words.repeated_ngrams(table(spark, d, "nemo_audio"), "audio_id", "transcript")


# --- ranges, splits, lists ---

_DUR = "SELECT row_id AS clip_id, CAST(round(duration * 1000) AS BIGINT) AS duration_ms FROM videos WHERE duration > 0"


def _durations(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "videos").where("duration > 0").select(F.col("row_id").alias("clip_id"), F.round(F.col("duration") * 1000).cast("long").alias("duration_ms"))


@query("even_windows", f"""SELECT clip_id, CAST(i AS INT) AS i, greatest(0, least(duration_ms // 10 + CAST(floor((greatest(duration_ms * 8 // 10, 45000) * (2 * i + 1) - 225000) / 10.0::DOUBLE) AS BIGINT), duration_ms - 45000)) AS start_ms FROM ({_DUR}) d, range(5) t(i)""")
def even_windows(spark: SparkSession, d: str) -> DataFrame:
    return ranges.even_windows(_durations(spark, d))


@query("chunk_ranges", f"SELECT clip_id, CAST(i AS INT) AS i, i * 110000 AS start_ms, least(i * 110000 + 120000, duration_ms) AS end_ms FROM (SELECT *, unnest(range(CAST(ceil(duration_ms / 110000.0) AS BIGINT))) AS i FROM ({_DUR}) d) x")
def chunk_ranges(spark: SparkSession, d: str) -> DataFrame:
    return ranges.chunk_ranges(_durations(spark, d))


@query("emission_ranges", f"""WITH x AS (SELECT clip_id, duration_ms * 16 AS n, unnest(range(CAST(ceil(duration_ms * 16 / 4800000.0) AS BIGINT))) AS i FROM ({_DUR}) d), y AS (SELECT *, i * 4800000 AS cs, least(i * 4800000 + 4800000, n) AS ce FROM x)
SELECT clip_id, CAST(i AS INT) AS i, greatest(0, cs - 160000) AS start, least(ce + 160000, n) AS "end", cs AS core_start, ce AS core_end, (cs - greatest(0, cs - 160000)) // 320 AS skip_frames FROM y""")
def emission_ranges(spark: SparkSession, d: str) -> DataFrame:
    return ranges.emission_ranges(_durations(spark, d).withColumn("n_samples", F.col("duration_ms") * 16))


@query("proportional_chunks", f"""WITH x AS (SELECT clip_id, 1000 AS w, duration_ms AS t, unnest(range(CAST(ceil(duration_ms / 480000.0) AS BIGINT))) AS i FROM ({_DUR}) d)
SELECT clip_id, i, w * least(i * 480000, t) // t AS lo, w * least((i + 1) * 480000, t) // t AS hi FROM x""")
def proportional_chunks(spark: SparkSession, d: str) -> DataFrame:
    return ranges.proportional_chunks(_durations(spark, d).withColumn("n_words", F.lit(1000)))


_HASH = "CAST(concat('0x', left(md5(concat('0:', source)), 8)) AS BIGINT)"


@query("grouped_split", f"""WITH g AS (SELECT DISTINCT {_PARENT} AS source FROM segments WHERE clip_id IS NOT NULL), r AS (SELECT source, row_number() OVER (ORDER BY {_HASH}, source) AS rn, count(*) OVER () AS n FROM g)
SELECT source, CASE WHEN n > 1 AND rn <= greatest(1, floor(n * 0.05)) THEN 'val' ELSE 'train' END AS split FROM r""")
def grouped_split(spark: SparkSession, d: str) -> DataFrame:
    return ranges.grouped_split(table(spark, d, "segments"), ranges.source_of(F.col("clip_id")))


@query("split_totals", "SELECT coalesce(split, 'all') AS split, count(*) AS n_windows, CAST(sum(n_frames) AS BIGINT) AS n_frames FROM (SELECT coalesce(split, 'none') AS split, n_frames FROM train) t GROUP BY ROLLUP (split)")
def split_totals(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "train").select(F.coalesce("split", F.lit("none")).alias("split"), "n_frames")
    return rows.rollup("split").agg(F.count("*").alias("n_windows"), F.sum("n_frames").alias("n_frames")).select(F.coalesce("split", F.lit("all")).alias("split"), "n_windows", "n_frames")


@query("url_dedupe", f"SELECT url, min(pos) AS pos FROM ({fx.URLS}) u GROUP BY url")
def url_dedupe(spark: SparkSession, d: str) -> DataFrame:
    return urls.dedupe_ordered(fx.derive(spark, d, fx.URLS))


@query("new_urls", f"WITH u AS ({fx.URLS}) SELECT url FROM u WHERE list_id < 10 EXCEPT SELECT url FROM u WHERE list_id >= 15")
def new_urls(spark: SparkSession, d: str) -> DataFrame:
    u = fx.derive(spark, d, fx.URLS)
    return urls.new_urls(urls.union_distinct(*[u.where(F.col("list_id") == i) for i in range(10)]), u.where("list_id >= 15"))


@query("url_fallback", "SELECT row_id, CASE WHEN vid <> '' THEN coalesce(nullif(url, ''), concat('https://v.example/', vid)) END AS url FROM videos")
def url_fallback(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "videos").select("row_id", urls.watch_url(F.col("url"), F.col("vid"), "https://v.example/").alias("url"))


# --- signals ---

_SQ = "list_sum(list_transform({0}, lambda x: x::DOUBLE * x))"
_P = f"p AS ({fx.PAIRS})"
_CORR = "list_sum(list_transform(range(1, 65), lambda i: ({0}[i] - list_avg({0})) * ({1}[i]::DOUBLE - list_avg({1})))) / (sqrt(list_sum(list_transform({0}, lambda x: (x - list_avg({0})) ** 2))) * sqrt(list_sum(list_transform({1}, lambda x: (x - list_avg({1})) ** 2))))"


@query("channel_rms", f"SELECT vec_id, round(sqrt({_SQ.format('embedding')} / len(embedding)), 6) AS rms, round(list_max(list_transform(embedding, lambda x: abs(x::DOUBLE))), 6) AS peak FROM embeddings")
def channel_rms(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings").select("vec_id", F.round(signal.rms(F.col("embedding")), 6).alias("rms"), F.round(signal.peak(F.col("embedding")), 6).alias("peak"))


@query("peak_norm", "WITH x AS (SELECT vec_id, embedding AS e, 0.9 / list_max(list_transform(embedding, lambda x: abs(x::DOUBLE))) AS g FROM embeddings) SELECT vec_id, round(e[1] * g, 6) AS first, round(list_max(list_transform(e, lambda x: abs(x * g))), 6) AS peak FROM x")
def peak_norm(spark: SparkSession, d: str) -> DataFrame:
    y = table(spark, d, "embeddings").select("vec_id", signal.peak_normalised(F.col("embedding")).alias("y"))
    return y.select("vec_id", F.round(F.col("y")[0], 6).alias("first"), F.round(signal.peak(F.col("y")), 6).alias("peak"))


@query("rms_norm", f"""WITH x AS (SELECT vec_id, embedding AS e, 0.05 / sqrt({_SQ.format('embedding')} / len(embedding)) AS g FROM embeddings), y AS (SELECT *, list_max(list_transform(e, lambda v: abs(v::DOUBLE))) * g AS pk FROM x)
SELECT vec_id, round(e[1] * g * CASE WHEN pk > 0.99 THEN 0.99 / pk ELSE 1 END, 6) AS first FROM y""")
def rms_norm(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings").select("vec_id", F.round(signal.rms_normalised(F.col("embedding"))[0], 6).alias("first"))


@query("channel_similarity", f"WITH {_P}, q AS (SELECT clip_id, ch0::DOUBLE[] AS a, ch1::DOUBLE[] AS b FROM p) SELECT clip_id, round({_CORR.format('a', 'b')}, 6) AS similarity FROM q")
def channel_similarity(spark: SparkSession, d: str) -> DataFrame:
    return fx.derive(spark, d, fx.PAIRS).select("clip_id", F.round(signal.similarity(F.col("ch0"), F.col("ch1")), 6).alias("similarity"))


_NEXT = "SELECT p.clip_id, p.ch0::DOUBLE[] AS a0, p.ch1::DOUBLE[] AS a1, n.ch0::DOUBLE[] AS b0, n.ch1::DOUBLE[] AS b1 FROM p JOIN p n ON n.clip_id = p.clip_id + 2"


@query("swap_decision", f"WITH {_P}, q AS ({_NEXT}) SELECT clip_id, {_CORR.format('a0', 'b1')} + {_CORR.format('a1', 'b0')} > {_CORR.format('a0', 'b0')} + {_CORR.format('a1', 'b1')} AS swapped FROM q")
def swap_decision(spark: SparkSession, d: str) -> DataFrame:
    p = fx.derive(spark, d, fx.PAIRS)
    n = p.select((F.col("clip_id") - 2).alias("clip_id"), F.col("ch0").alias("b0"), F.col("ch1").alias("b1"))
    return p.join(n, "clip_id").select("clip_id", signal.swapped(F.col("ch0"), F.col("ch1"), F.col("b0"), F.col("b1")).alias("swapped"))


@query("crossfade", f"WITH {_P} SELECT clip_id, len(ch0) + len(ch1) - 16 AS n, round(ch0[49] * (1 - 0 / 15.0::DOUBLE) + ch1[1] * 0, 6) AS x49, round(ch0[56] * (1 - 7 / 15.0::DOUBLE) + ch1[8] * (7 / 15.0::DOUBLE), 6) AS x56, round(ch1[17]::DOUBLE, 6) AS x65 FROM p")
def crossfade(spark: SparkSession, d: str) -> DataFrame:
    x = fx.derive(spark, d, fx.PAIRS).select("clip_id", signal.crossfade(F.col("ch0"), F.col("ch1"), 16).alias("x"))
    return x.select("clip_id", F.size("x").cast("long").alias("n"), F.round(F.col("x")[48], 6).alias("x49"), F.round(F.col("x")[55], 6).alias("x56"), F.round(F.col("x")[64], 6).alias("x65"))


@query("energy_filter", f"WITH {_P} SELECT clip_id FROM p WHERE least(sqrt({_SQ.format('ch0')} / len(ch0)), sqrt({_SQ.format('ch1')} / len(ch1))) >= 0.125")
def energy_filter(spark: SparkSession, d: str) -> DataFrame:
    p = fx.derive(spark, d, fx.PAIRS).select("clip_id", signal.rms(F.col("ch0")).alias("l"), signal.rms(F.col("ch1")).alias("r"))
    return ranges.both_speak(p, "l", "r", 0.125).select("clip_id")


# --- records ---

_INDIC = ", ".join(f"('{c}', '{n}')" for c, n in INDIC.items())


@query("language_names", f"""WITH l(code, name) AS (VALUES {_INDIC}) SELECT row_id, name AS language_name, coalesce(name IS NOT NULL, false) AS indic
FROM videos LEFT JOIN l ON l.code = split_part(lower(trim(language)), '-', 1)""")
def language_names(spark: SparkSession, d: str) -> DataFrame:
    """Language names by code, and membership of the Indic dimension."""
    code = F.col("language")
    return table(spark, d, "videos").select("row_id", records.language_name(code).alias("language_name"), F.coalesce(gates.is_indic(code, F.lit(None).cast("string")), F.lit(False)).alias("indic"))


@query("probe_tags", """SELECT row_id, array_to_string(CAST(json_extract(meta, '$.tags') AS VARCHAR[])[1:20], ' ') AS tags, len(CAST(json_extract(meta, '$.tags') AS VARCHAR[])) AS n_tags FROM videos WHERE json_valid(meta) AND meta LIKE '%"tags"%'""")
def probe_tags(spark: SparkSession, d: str) -> DataFrame:
    """The first 20 tags of the probe's record, where it parses."""
    tags = replies.vote_of(F.col("meta"), "tags array<string>")["tags"]
    rows = table(spark, d, "videos").select("row_id", tags.alias("t")).where("t is not null")
    return rows.select("row_id", F.array_join(records.first_tags(F.col("t")), " ").alias("tags"), F.size("t").cast("long").alias("n_tags"))


@query("failure_reasons", """SELECT stage, CASE WHEN error IS NULL THEN NULL WHEN stage IN ('probe', 'download', 'diarize', 'separate', 'emit') THEN concat(stage, '_failed') END AS reason,
CASE WHEN contains(lower(error), 'sign in to confirm') AND contains(lower(error), 'bot') THEN 'wall' WHEN contains(lower(error), 'rate-limit') OR contains(lower(error), 'rate limited') THEN 'rate' END AS kind, count(*) AS n
FROM (SELECT CASE event_id % 6 WHEN 0 THEN 'probe' WHEN 1 THEN 'download' WHEN 2 THEN 'diarize' WHEN 3 THEN 'separate' WHEN 4 THEN 'emit' ELSE 'other' END AS stage,
 CASE event_type WHEN 'error' THEN 'HTTP 429 Rate-Limit' WHEN 'signup' THEN 'Sign in to confirm you are not a bot' WHEN 'view' THEN 'timed out' END AS error FROM events) e GROUP BY ALL""")
def failure_reasons(spark: SparkSession, d: str) -> DataFrame:
    """Errors of the stages as reasons, and what they say about the site's limits."""
    stage = F.element_at(F.array(*map(F.lit, ["probe", "download", "diarize", "separate", "emit", "other"])), (F.col("event_id") % 6 + 1).cast("int"))
    error = F.when(F.col("event_type") == "error", "HTTP 429 Rate-Limit").when(F.col("event_type") == "signup", "Sign in to confirm you are not a bot").when(F.col("event_type") == "view", "timed out")
    rows = table(spark, d, "events").select(stage.alias("stage"), error.alias("error"))
    return rows.groupBy("stage", gates.failure_reason(F.col("stage"), F.col("error")).alias("reason"), gates.back_off_kind(F.col("error")).alias("kind")).agg(F.count("*").alias("n"))


@query("talkative_channel", f"""WITH {_S}, t AS (SELECT clip_id, speaker, sum(end_ms - start_ms) AS ms FROM s GROUP BY ALL), k AS (SELECT clip_id, list(ms ORDER BY speaker) AS m FROM t GROUP BY clip_id)
SELECT clip_id, CASE WHEN len(m) = 2 AND m[1] < m[2] THEN 1 ELSE 0 END AS channel FROM k""")
def talkative_channel(spark: SparkSession, d: str) -> DataFrame:
    """The channel of the speaker with more talk time."""
    shares = stats.talk_time(_segments(spark, d)).groupBy("clip_id").agg(F.map_from_entries(F.collect_list(F.struct("speaker", "talk_ms"))).alias("shares"))
    return shares.select("clip_id", signal.talkative_channel(F.col("shares")).alias("channel"))


@query("speech_ratio", f"WITH {_S}, t AS (SELECT clip_id, CAST(sum(end_ms - start_ms) AS BIGINT) AS ms, max(end_ms) + 500 AS total FROM s GROUP BY clip_id) SELECT clip_id, ms / total AS speech_ratio FROM t")
def speech_ratio(spark: SparkSession, d: str) -> DataFrame:
    segs = _segments(spark, d)
    return signal.speech_ratio(segs.join(_totals(segs), "clip_id"), "total_ms")


@query("suspect_language", r"""WITH t AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), c AS (SELECT doc_id, len(regexp_extract_all(t, '[\x{0900}-\x{097F}]')) AS d, len(regexp_extract_all(t, '[\x{0980}-\x{0DFF}\x{0600}-\x{06FF}A-Za-z]')) AS o FROM t)
SELECT doc_id, d + o >= 50 AND (CAST(d * 20000 + d + o AS BIGINT) // nullif(2 * (d + o), 0)) < 5000 AS suspect FROM c""")
def suspect_language(spark: SparkSession, d: str) -> DataFrame:
    """Whether a transcript has enough letters and too few of the expected script."""
    counts = words.script_counts(F.col("text"))
    rows = table(spark, d, "documents").select("doc_id", F.create_map(F.lit("spk0"), F.struct(counts["n_letters"].alias("n_letters"), counts["devanagari_frac"].alias("devanagari_frac"))).alias("m"))
    return rows.select("doc_id", words.suspect_language(F.col("m")).alias("suspect"))


# --- incremental ---


@query("backoff_replay", """WITH RECURSIVE h AS MATERIALIZED (SELECT CAST(user_id AS VARCHAR) AS k, epoch(ts) AS t, CASE WHEN event_id % 5 = 0 THEN 'wall' ELSE 'rate' END AS kind, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events WHERE event_type = 'error'),
r AS (SELECT k, t, kind, rn, CASE WHEN kind = 'rate' THEN 1 ELSE 0 END AS sr, CASE WHEN kind = 'wall' THEN 1 ELSE 0 END AS sw, CASE WHEN kind = 'wall' THEN 900 ELSE 300 END AS pause, t + CASE WHEN kind = 'wall' THEN 900 ELSE 300 END AS until FROM h WHERE rn = 1
  UNION ALL SELECT k, t, kind, rn, sr, sw, p, t + p FROM (SELECT *, CASE WHEN kind = 'wall' THEN least(900 * power(2, sw - 1), 5400) ELSE least(300 * power(2, sr - 1), 2400) END::INT AS p FROM (SELECT h.*,
    CASE WHEN h.t > r.until + 60 THEN 0 ELSE r.sr END + CASE WHEN h.kind = 'rate' THEN 1 ELSE 0 END AS sr, CASE WHEN h.t > r.until + 60 THEN 0 ELSE r.sw END + CASE WHEN h.kind = 'wall' THEN 1 ELSE 0 END AS sw FROM r JOIN h ON h.k = r.k AND h.rn = r.rn + 1) a) b)
SELECT k AS key, kind, CASE WHEN kind = 'wall' THEN sw ELSE sr END AS streak, pause, CAST(round(until * 1000) AS BIGINT) AS until_ms FROM r""")
def backoff_replay(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").where("event_type = 'error'")
    hits = e.select(F.col("user_id").alias("key"), (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("at"), F.col("event_id").alias("seq"), F.when(F.col("event_id") % 5 == 0, "wall").otherwise("rate").alias("kind"))
    return incremental.replay_backoff(hits).select("key", "kind", "streak", "pause", F.round(F.col("until") * 1000).cast("long").alias("until_ms"))


_SESSIONS = """WITH e AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS o FROM events), g AS (SELECT *, sum(o) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM e)
SELECT user_id, epoch_us(min(ts)) AS start_us, epoch_us(max(ts)) + 1800000000 AS end_us, count(*) AS n FROM g GROUP BY user_id, s"""


@query("sessions", _SESSIONS)
def sessions(spark: SparkSession, d: str) -> DataFrame:
    rows = incremental.sessions(table(spark, d, "events"), "user_id", "ts", "30 minutes")
    return rows.select("user_id", F.unix_micros("start").alias("start_us"), F.unix_micros("end").alias("end_us"), "n")


@query("stream_sessions", _SESSIONS)
def stream_sessions(spark: SparkSession, d: str) -> DataFrame:
    """The same by a stream over the folder's files, run to its end."""
    schema = spark.read.parquet(f"{d}/events.parquet").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d)
    rows = incremental.complete_to(incremental.sessions(stream, "user_id", "ts", "30 minutes"), shared_path(spark, "sessions"), shared_path(spark, "checkpoint"))
    return rows.select("user_id", F.unix_micros("start").alias("start_us"), F.unix_micros("end").alias("end_us"), "n")


@query("speaker_verdict_counts", f"""WITH {_V}, a AS (SELECT clip_id, count(*) AS n, CAST(floor(median(num_speakers)) AS INT) AS ns FROM v GROUP BY clip_id)
SELECT CASE WHEN ns < 2 THEN 'few' ELSE 'enough' END AS outcome, count(*) AS n FROM a WHERE n >= 2 GROUP BY 1""")
def speaker_verdict_counts(spark: SparkSession, d: str) -> DataFrame:
    """Clips by whether their voted number of speakers is below two; plans.curate has the gates and conversation statistics."""
    v = votes.verdicts(fx.derive(spark, d, fx.VOTES))
    return v.groupBy(F.when(F.col("num_speakers") < 2, "few").otherwise("enough").alias("outcome")).agg(F.count("*").alias("n"))


from . import table_queries  # noqa: E402, F401, registers the queries of sources, sinks, boundaries and whole pipelines
