"""Writers: JSON lines, entities, RTTM, WAV bytes, reports, the training configuration."""

from __future__ import annotations

import io
import uuid
import wave
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordered import ratio


def append_json(df: DataFrame, path: str) -> None:
    """Append to a manifest; rows already there stay."""
    df.write.mode("append").json(path)


def write_entities(df: DataFrame, path: str, key: str = "id") -> None:
    """One folder per entity with its record as JSON."""
    df.withColumn("__k", F.col(key)).repartition("__k").write.mode("overwrite").partitionBy("__k").json(path)


def seconds(ms: Column) -> Column:
    """Whole ms as seconds with three places, in integers."""
    return F.format_string("%d.%03d", F.floor(ms / 1000), F.pmod(ms, F.lit(1000)))


def rttm_lines(segments: DataFrame) -> DataFrame:
    """(clip_id, start_ms, seg_idx, line): one RTTM line per segment (start and duration in seconds)."""
    line = F.concat(F.lit("SPEAKER "), "clip_id", F.lit(" 1 "), seconds(F.col("start_ms")), F.lit(" "), seconds(F.col("end_ms") - F.col("start_ms")), F.lit(" <NA> <NA> "), "speaker", F.lit(" <NA> <NA>"))
    return segments.select("clip_id", "start_ms", "seg_idx", line.alias("line"))


def write_rttm(segments: DataFrame, path: str) -> None:
    """One text folder per clip, in order of time."""
    rttm_lines(segments).repartition("clip_id").sortWithinPartitions("clip_id", "start_ms", "seg_idx").select("clip_id", F.col("line").alias("value")).write.mode("overwrite").partitionBy("clip_id").text(path)


def write_marked(marked: DataFrame, path: str) -> None:
    """Segments of mark_overlaps as JSON lines in seconds (schemas.MARKED), appended; one record a segment."""
    sec = lambda c: F.round(c / 1000, 3)
    length = F.col("end_ms") - F.col("start_ms")
    fields = [sec(F.col("start_ms")).alias("start"), sec(F.col("end_ms")).alias("end"), "speaker", sec(length).alias("duration"), sec(F.col("overlap_ms")).alias("overlap_sec"), ratio(F.col("overlap_ms"), length, 3).alias("overlap_frac"), "clean"]
    append_json(marked.select("clip_id", *fields), path)


def wav_bytes(channels: list[np.ndarray], rate: int) -> bytes:
    """16-bit PCM of one or more channels, cut at full scale."""
    n = min(map(len, channels))
    pcm = (np.clip(np.stack([c[:n] for c in channels], 1), -1, 1) * 32767).round().astype("<i2")
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(len(channels))
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes(pcm.tobytes())
    return out.getvalue()


def wav_files(df: DataFrame, rate: int) -> DataFrame:
    """(name, content) of (name, channels array<array<float>>)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"name": b.name_, "content": [wav_bytes([np.asarray(c, np.float32) for c in x], rate) for x in b.channels]})

    rows = df.select(F.col("name").alias("name_"), "channels").where("size(channels) > 0")
    return rows.mapInPandas(run, "name string, content binary")


def write_files(files: DataFrame, folder: str) -> DataFrame:
    """(name, length) of files (name, content) written below a folder, given as an address any executor can reach.

    A file appears under its name when it is whole, so a task that is run again does no harm. Nothing is written before the result is used.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow.fs import FileSystem

        fs, base = FileSystem.from_uri(folder)
        fs.create_dir(base, recursive=True)
        for b in batches:
            for name, content in zip(b.name_, b.content, strict=True):
                draft = f"{base}/.{uuid.uuid4().hex}"
                with fs.open_output_stream(draft) as out:
                    out.write(content)
                fs.move(draft, f"{base}/{name}")
            yield pd.DataFrame({"name": b.name_, "length": b.content.map(len)})

    return files.select(F.col("name").alias("name_"), "content").mapInPandas(run, "name string, length long")


def export_rows(manifest: DataFrame, root: Column) -> DataFrame:
    """Nested manifest records to flat training rows."""
    at = F.concat(root, F.lit("/"), F.col("id"), F.lit("/"))
    return manifest.select(
        "id", F.concat(at, F.lit("stereo.wav")).alias("stereo_filepath"), F.concat(at, F.lit("mixture.wav")).alias("mixture_filepath"),
        F.transform("files.channels", lambda c: F.concat(root, F.lit("/"), F.col("id"), F.lit("/"), c)).alias("channel_filepaths"), F.concat(at, F.lit("diarization.rttm")).alias("rttm_filepath"),
        "duration", F.col("language_code").alias("lang"), F.col("conversation.overlap_ratio").alias("overlap_ratio"), F.col("conversation.turns_per_min").alias("turns_per_min"), "license", "source",
    )


# Keys and settings of the training configuration, in its order; {...} are filled in.
TRAINING = {
    "moshi_paths": {"hf_repo_id": '"kyutai/moshiko-pytorch-bf16"'}, "run_dir": '"{run_dir}"', "lora": {"enable": "true", "rank": "128", "scaling": "2.", "ft_embed": "false"},
    "duration_sec": "{duration}", "batch_size": "8", "max_steps": "2000", "first_codebook_weight_multiplier": "100.", "text_padding_weight": "0.5", "gradient_checkpointing": "true",
    "optim": {"lr": "2e-6", "weight_decay": "0.1", "pct_start": "0.05"}, "data": {"train_data": '"{train}"', "eval_data": '"{val}"', "shuffle": "true"},
    "eval_freq": "200", "no_eval": "false", "ckpt_freq": "500", "save_adapters": "true", "seed": "0", "log_freq": "10",
}


def training_config(train: str, val: str, window_ms: int, run_dir: str = "./runs/duplex", **settings: str) -> str:
    """A YAML configuration of the two manifests; durations are capped at 100 s; settings replace top-level ones."""
    given = {"train": train, "val": val, "duration": str(min(window_ms // 1000, 100)), "run_dir": run_dir}
    lines = []
    for key, value in (TRAINING | settings).items():
        if isinstance(value, dict):
            lines += [f"{key}:", *[f"  {k}: {v.format(**given)}" for k, v in value.items()]]
        else:
            lines.append(f"{key}: {value.format(**given)}")
    return "\n".join([*lines, ""])


def write_splits(windows: DataFrame, path: str, window_ms: int) -> str:
    """Train and validation rows (path, duration, split) as JSON lines; returns the configuration."""
    for split in ("train", "val"):
        windows.where(F.col("split") == split).select("path", F.round("duration", 6).alias("duration")).write.mode("overwrite").json(f"{path}/{split}.jsonl")
    return training_config(f"{path}/train.jsonl", f"{path}/val.jsonl", window_ms)


def _or_dash(text: Column) -> Column:
    return F.coalesce(F.nullif(text.cast("string"), F.lit("")), F.lit("—"))


def _bullets(items: Column, empty: str = "—") -> Column:
    return F.when(F.size(items) > 0, F.array_join(F.transform(items, lambda i: F.concat(F.lit("- "), F.coalesce(i, F.lit("")))), "\n")).otherwise(empty)


# Rows of the report's table and its sections, in order, with what an empty section says.
REPORT_FIELDS = [("Topic", "topic"), ("Tone", "tone"), ("Setting", "setting"), ("Audio quality", "audio_quality"), ("Confidence", "confidence")]
REPORT_LISTS = [("Background sounds", "background_sounds", "—"), ("Key moments", "key_moments", "—"), ("Unclear / low confidence", "unclear", "None flagged.")]
REPORT_HEAD = [("Source", "source", "`{}`"), ("Model", "model", "`{}`"), ("Generated", "generated", "{}"), ("Duration", "duration", "{:.1f}s"), ("Processing time", "elapsed", "{:.0f}s"), ("Tokens", "tokens", "{}")]


def markdown_report(df: DataFrame, file: str = "file", analysis: str = "analysis", run: str | None = None) -> DataFrame:
    """(file, report): a Markdown page of each analysis record; missing values show as a dash.

    run names a struct column of how the record came about (any of source, model, generated, duration, elapsed, tokens); its null
    fields are left out of the page's head.
    """
    a = lambda c: F.col(f"{analysis}.{c}")
    has = lambda outer, c: c in df.schema[outer].dataType.names
    head = [F.lit("")]
    for title, c, form in REPORT_HEAD if run else []:
        if has(run, c):
            value = F.col(f"{run}.{c}")
            before, after = form.split("{", 1)[0], form.split("}", 1)[1]
            text = F.format_string("%.1f" if ":.1f" in form else "%.0f", value.cast("double")) if ":" in form else value.cast("string")
            head.append(F.when(value.isNotNull(), F.concat(F.lit(f"- {title}: {before}"), text, F.lit(after))))
    head += [F.lit(""), F.lit("---"), F.lit("")] if run else []
    bold = lambda c: F.concat(F.lit("**"), _or_dash(a(c)), F.lit("**"))
    others = F.array_join(a("other_languages"), ", ") if has(analysis, "other_languages") else F.lit("")
    table = [F.concat(F.lit("| Speakers | "), bold("num_speakers"), F.lit(" |")), F.concat(F.lit("| Language | "), bold("language"), F.lit(" (`"), _or_dash(a("language_code")), F.lit("`) |")), F.concat(F.lit("| Other languages | "), _or_dash(others), F.lit(" |"))]
    table += [F.concat(F.lit(f"| {t} | "), _or_dash(a(c)), F.lit(" |")) for t, c in REPORT_FIELDS]
    people = F.transform(a("speakers"), lambda s: F.concat(F.lit("**"), F.coalesce(s["id"], F.lit("?")), F.lit("** — "), F.coalesce(s["apparent_gender"], F.lit("unclear")), F.lit(" — "), F.coalesce(s["notes"], F.lit(""))))
    parts = [F.concat(F.lit("# Audio analysis — "), F.col(file)), *head, F.lit("## At a glance"), F.lit(""), F.lit("| Field | Value |"), F.lit("|---|---|"), *table, F.lit(""), F.lit("## Summary"), F.lit(""), _or_dash(a("summary")), F.lit(""), F.lit("## Speakers"), F.lit(""), _bullets(people)]
    for title, c, empty in REPORT_LISTS:
        parts += [F.lit(""), F.lit(f"## {title}"), F.lit(""), _bullets(a(c), empty)]
    parts += [F.lit(""), F.lit("## Transcript"), F.lit(""), F.lit("```"), F.coalesce(F.nullif(a("transcript"), F.lit("")), F.lit("(none)")), F.lit("```"), F.lit("")]
    return df.select(F.col(file).alias("file"), F.concat_ws("\n", *parts).alias("report"))
