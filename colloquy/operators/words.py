"""Word timing repair and text diagnostics. Words are rows (clip_id, channel, idx, word, start_ms, end_ms); times may be null.

A channel of an endless clip may hold any number of words, so neighbours and positions come from block-wise scans over idx.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordered import blocked, ratio, scan

CHANNEL = ["clip_id", "channel"]
WORD = [*CHANNEL, "idx", "word", "start_ms", "end_ms"]
BLOCK_WORDS = 20_000
FILL_MS, TAIL_MS = 250, 100


def _in_order(words: DataFrame, *more: str) -> DataFrame:
    return blocked(words.select(*WORD, *more), CHANNEL, "idx", BLOCK_WORDS)


def _interpolate(rows: DataFrame, totals: DataFrame) -> DataFrame:
    placed, extra = F.col("start_ms").isNotNull(), (totals.select("clip_id", "total_ms"), ["clip_id"])
    rows = scan(rows, CHANNEL, ["idx"], sums={"pos": F.lit(1)})
    rows = scan(rows, CHANNEL, ["idx"], maxima={"before": F.when(placed, F.struct("pos", "end_ms"))}, minima={"after": F.when(placed, F.struct("pos", "start_ms"))}, wholes={"n_all": F.lit(1)}, extra=extra)
    first, t0 = F.coalesce("before.pos", F.lit(0)) + 1, F.coalesce("before.end_ms", F.lit(0))
    n = F.coalesce("after.pos", F.col("n_all") + 1) - first
    rows = rows.withColumns({"open": ~placed, "t0": t0, "len": F.greatest(t0, F.coalesce("after.start_ms", F.col("total_ms"))) - t0, "k": F.col("pos") - first, "n": n})
    place = lambda i: (F.col("t0") + F.call_function("div", 2 * i * F.col("len") + F.col("n"), 2 * F.col("n"))).cast("long")
    at = lambda c, i: F.when(F.col("open"), place(i)).otherwise(F.col(c)).alias(c)
    return rows.select(*CHANNEL, "idx", "word", at("start_ms", F.col("k")), at("end_ms", F.col("k") + 1), F.col("open").alias("approx"), "block")


def _extend(rows: DataFrame, totals: DataFrame, fill_ms: int, tail_ms: int) -> DataFrame:
    rows = scan(rows, CHANNEL, ["idx"], fields=["start_ms"], nxt="later", extra=(totals.select("clip_id", "total_ms"), ["clip_id"]))
    nxt = F.coalesce("later.start_ms", F.col("total_ms"))
    gap = nxt - F.col("end_ms")
    end = F.when(F.col("approx") | (gap <= 0), F.col("end_ms")).when(gap <= fill_ms, nxt).otherwise(F.least(F.col("end_ms") + tail_ms, nxt))
    return rows.select(*CHANNEL, "idx", "word", "start_ms", end.alias("end_ms"), "approx", "block")


def interpolate_words(words: DataFrame, totals: DataFrame) -> DataFrame:
    """Words without times are spread evenly from the end of the last placed word (0) to the start of the next (the clip's total_ms); flagged approx."""
    return _interpolate(_in_order(words), totals).drop("block")


def extend_word_ends(words: DataFrame, totals: DataFrame, fill_ms: int = FILL_MS, tail_ms: int = TAIL_MS) -> DataFrame:
    """Ends move towards the next word's start (the clip's total_ms after the last): all the way over gaps up to fill_ms, else by tail_ms; approx words stay."""
    return _extend(_in_order(words, "approx"), totals, fill_ms, tail_ms).drop("block")


def repair_words(words: DataFrame, totals: DataFrame, fill_ms: int = FILL_MS, tail_ms: int = TAIL_MS) -> DataFrame:
    """Both in one partitioning: unplaced words interpolated, then ends extended."""
    return _extend(_interpolate(_in_order(words), totals), totals, fill_ms, tail_ms).drop("block")


def even_timestamps(df: DataFrame, words: str = "words", total: str = "total_ms") -> DataFrame:
    """The last resort: the words of an array spread evenly over the total, all approx."""
    rows = df.select("clip_id", "channel", total, F.size(words).alias("n"), F.posexplode(words).alias("idx", "word"))
    at = lambda i: F.floor(i * F.col(total) / F.col("n")).cast("long")
    return rows.select("clip_id", "channel", "idx", "word", at(F.col("idx")).alias("start_ms"), at(F.col("idx") + 1).alias("end_ms"), F.lit(True).alias("approx"))


def token_places(words: DataFrame, size: Column, by: list[str] = CHANNEL) -> DataFrame:
    """(by, idx, first, last, n_tokens): a word of `size` tokens takes those from first up to, not including, last of its channel's n_tokens.

    It follows the words with a smaller idx; words that share an idx all end behind the last of them, as a running sum over idx has it.
    by: leave the channel out where it is constant; a literal among the keys costs a second exchange of all words.
    """
    rows = blocked(words.select(*by, "idx", size.alias("size")), by, "idx", BLOCK_WORDS)
    rows = scan(rows, by, ["idx"], sums={"last": F.col("size")}, wholes={"n_tokens": F.col("size")}, peers=True)
    return rows.select(*by, "idx", (F.col("last") - F.col("size")).alias("first"), "last", "n_tokens")


def first_outcome(*outcomes: tuple[str, Column]) -> Column:
    """struct(source, value) of the first outcome that is not null: aligner, then transcriber, then even spacing."""
    chain = F.when(F.lit(False), F.struct(F.lit("").alias("source"), outcomes[0][1].alias("value")))
    for name, value in outcomes:
        chain = chain.when(value.isNotNull(), F.struct(F.lit(name).alias("source"), value.alias("value")))
    return chain


def flatten_segments(df: DataFrame, segments: str = "segments") -> DataFrame:
    """Transcriber output to words: array<struct<words: array<struct<word, start, end>>>> in seconds to rows in ms; null word lists give none."""
    lists = F.transform(segments, lambda s: F.coalesce(s["words"], F.array().cast("array<struct<word:string,start:double,end:double>>")))
    rows = df.select("clip_id", "channel", F.posexplode(F.flatten(lists)).alias("idx", "w"))
    ms = lambda c: F.round(F.col(c) * 1000).cast("long")
    return rows.select("clip_id", "channel", "idx", F.trim("w.word").alias("word"), ms("w.start").alias("start_ms"), ms("w.end").alias("end_ms"))


def approx_counts(words: DataFrame) -> DataFrame:
    """(clip_id, n_words, n_approx) of words with their approx flag."""
    return words.groupBy("clip_id").agg(F.count("*").alias("n_words"), F.count_if("approx").alias("n_approx"))


def tokens(text: Column) -> Column:
    """The text's tokens between white space (Unicode's too); empty for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"(?U)\s+"), lambda w: w != "")


def script_counts(text: Column) -> dict[str, Column]:
    """Letters of Devanagari, of other scripts and in all, and Devanagari's share to four places (null without letters)."""
    text = F.coalesce(text, F.lit(""))
    deva, other = F.regexp_count(text, F.lit("[\\u0900-\\u097F]")), F.regexp_count(text, F.lit("[\\u0980-\\u0DFF\\u0600-\\u06FFA-Za-z]"))
    return {"devanagari": deva, "other_letters": other, "n_letters": deva + other, "devanagari_frac": ratio(deva.cast("long"), (deva + other).cast("long"), 4)}


def suspect_language(stats: Column, least_letters: int = 50, least_frac: float = 0.5) -> Column:
    """Whether any channel of map<string, struct<n_letters, devanagari_frac>> has enough letters and too few of Devanagari."""
    return F.exists(F.map_values(stats), lambda s: (s["n_letters"] >= least_letters) & (F.coalesce(s["devanagari_frac"], F.lit(0.0)) < least_frac))


def repeated_ngrams(df: DataFrame, key: str, text: str, n: int = 4) -> DataFrame:
    """(key, n_grams, n_distinct): n-grams of each text's tokens."""
    w = tokens(F.col(text))
    rows = df.select(key, w.alias("w")).where(F.size("w") >= n)
    grams = F.transform(F.sequence(F.lit(1), F.size("w") - (n - 1)), lambda i: F.array_join(F.slice("w", i, F.lit(n)), " "))
    return rows.select(key, grams.alias("g")).select(key, F.size("g").alias("n_grams"), F.size(F.array_distinct("g")).alias("n_distinct"))
