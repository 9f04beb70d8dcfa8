"""Gates: the first rule a candidate breaks becomes its reason. Staged from cheap to expensive columns, all in one projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import INDIC, Thresholds


def language_prefix(code: Column) -> Column:
    """The code in lower case before its first '-'; '' for null."""
    return F.split_part(F.lower(F.coalesce(code, F.lit(""))), F.lit("-"), F.lit(1))


def is_hindi(code: Column, name: Column) -> Column:
    """By code if there is one, else by name."""
    prefix = language_prefix(code)
    return F.when(prefix != "", prefix == "hi").otherwise(F.lower(F.trim(F.coalesce(name, F.lit("")))) == "hindi")


def is_indic(code: Column, name: Column) -> Column:
    names = sorted({n.lower() for n in INDIC.values()})
    return language_prefix(code).isin(*INDIC) | F.lower(F.trim(F.coalesce(name, F.lit("")))).isin(*names)


def light_reason(th: Thresholds = Thresholds()) -> Column:
    """The light gate over duration, license, speech_ratio, verify_missing, num_speakers, language(_code), is_conversational, music_dominant, is_dubbed.

    '' passes. A null duration counts as 0, a null license as none.
    """
    c = F.col
    duration = F.coalesce(c("duration"), F.lit(0.0))
    open_license = F.lower(F.coalesce(c("license"), F.lit(""))).contains("creative commons")
    chain = F.when(duration < th.min_duration, "too_short").when(duration > th.max_duration, "too_long")
    if th.cc_only:
        chain = chain.when(~open_license, "license")
    return (
        chain.when(c("speech_ratio") < th.min_speech_ratio, "low_speech")
        .when(c("speech_ratio") > th.max_speech_ratio, "high_speech")
        .when(c("verify_missing"), "verify_failed")
        .when(F.coalesce(c("num_speakers"), F.lit(0)) < 2, "not_two_speakers")
        .when(~is_hindi(c("language_code"), c("language")), "not_indic")
        .when(~F.coalesce(c("is_conversational"), F.lit(False)) | F.coalesce(c("music_dominant"), F.lit(False)) | F.coalesce(c("is_dubbed"), F.lit(False)), "not_conversational")
        .otherwise("")
    )


def failure_reason(stage: Column, error: Column) -> Column:
    """The reject reason of a stage that failed; null where it did not or is not a stage that leaves a row."""
    known = F.create_map(*[F.lit(x) for s in ("probe", "download", "diarize", "separate", "emit") for x in (s, f"{s}_failed")])
    return F.when(error.isNotNull(), F.try_element_at(known, stage))


def back_off_kind(error: Column) -> Column:
    """'wall', 'rate' or null: what an error text says about the site's limits."""
    low = F.lower(error)
    wall = low.contains("sign in to confirm") & low.contains("bot")
    return F.when(wall, "wall").when(low.contains("rate-limit") | low.contains("rate limited"), "rate")


def split_by_reason(df: DataFrame, reason: str = "reason") -> tuple[DataFrame, DataFrame]:
    """(passing, rejected) rows."""
    return df.where(F.col(reason) == ""), df.where(F.col(reason) != "")


def check_emitted(df: DataFrame, rule: Column, message: str = "emit_failed") -> DataFrame:
    """The rows, failing the job where one breaks the rule: the last check before a sink."""
    return df.where(F.when(F.coalesce(rule, F.lit(False)), F.lit(True)).otherwise(F.raise_error(F.lit(message)).cast("boolean")))
