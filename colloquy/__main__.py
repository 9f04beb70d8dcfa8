"""Commands: python -m colloquy COMMAND ... over tables in any format Spark reads by its file ending (parquet, json, jsonl, csv).

discover: candidate addresses of a query and of further sources, without those known.
run: the outcome of every candidate as rows of the state table; candidates decided before are left out unless --redo.
stats: the funnel of a state table as lines. export: the manifest of entity folders, flat. hours: count and length of a manifest.
transcribe: words with repaired times and the turns' text; clips that have a transcript are left out unless --overwrite.
windows: frame-aligned training windows with their split, as manifests with a configuration; --dry-run only counts.
"""

from __future__ import annotations

import argparse
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import schemas
from .config import Thresholds, WindowPlan
from .operators import segments, state, urls
from .plans import pipelines
from .runtime import path_exists, ship
from .sources import readers, sinks


def load(spark: SparkSession, path: str) -> DataFrame:
    ending = path.rstrip("/").rsplit(".", 1)[-1].lower()
    return spark.read.format({"jsonl": "json", "json": "json", "csv": "csv"}.get(ending, "parquet")).load(path)


def discover(spark: SparkSession, a: argparse.Namespace) -> None:
    """Writes the candidates as a text list, in order; the search itself is the probe backend's business."""
    rows = spark.createDataFrame(list(enumerate(urls.candidate_sources(a.query, a.source, a.limit, a.cc_only))), "pos int, url string")
    if a.known:
        rows = rows.join(readers.read_list(spark, a.known).select("url"), "url", "left_anti")
    urls.dedupe_ordered(rows).sort("pos").select("url").write.mode("overwrite").text(a.out)


def run(spark: SparkSession, a: argparse.Namespace) -> None:
    th = replace(Thresholds(), cc_only=a.cc_only, min_duration=a.min_duration, max_duration=a.max_duration)
    videos = load(spark, a.videos)
    if a.state and path_exists(spark, a.state):
        log = load(spark, a.state)
        videos = state.undecided(videos, state.latest(log, "vid", ["updated"], ["status"]), "vid", a.redo)
    rows = pipelines.curate(videos, load(spark, a.votes), load(spark, a.segments), th)
    rows.withColumn("updated", F.unix_micros(F.current_timestamp()) / 1e6).write.mode("append").parquet(a.out)


def stats(spark: SparkSession, a: argparse.Namespace) -> None:
    last = state.latest(load(spark, a.state), "vid", ["updated"], ["status", "reason"])
    accepted = load(spark, a.manifest) if a.manifest else spark.createDataFrame([], "duration double")
    for row in state.report(last, accepted).orderBy("place").collect():  # a line a kind of outcome
        print(row.line)


def export(spark: SparkSession, a: argparse.Namespace) -> None:
    sinks.export_rows(readers.read_entities(spark, a.root, schemas.MANIFEST), F.lit(a.root.rstrip("/"))).write.mode("overwrite").json(a.out)


def hours(spark: SparkSession, a: argparse.Namespace) -> None:
    manifest = readers.read_json_lines(spark, a.manifest, "duration double, duration_s double, seconds double", strict=True)
    got = state.hours(manifest, seconds=("duration", "duration_s", "seconds")).first()
    print(f"{got.n} rows, {got.n_known} with a length, {got.hours:.2f} h")


def transcribe(spark: SparkSession, a: argparse.Namespace) -> None:
    words, turns, totals = (load(spark, p) for p in (a.words, a.turns, a.totals))
    if path_exists(spark, f"{a.out}/turns"):
        words = state.without_output(words, spark.read.parquet(f"{a.out}/turns").select("clip_id").distinct(), "clip_id", a.overwrite)
    placed, text = pipelines.assemble_transcripts(words, turns, totals)
    mode = "overwrite" if a.overwrite else "append"
    placed.write.mode(mode).parquet(f"{a.out}/words")
    text.write.mode(mode).parquet(f"{a.out}/turns")


def windows(spark: SparkSession, a: argparse.Namespace) -> None:
    ms = lambda s: round(s * 1000)
    plan = WindowPlan(target_ms=ms(a.window), min_ms=ms(a.min_window), max_ms=ms(a.max_window), min_gap_ms=ms(a.min_gap), min_rms=a.min_rms, val_frac=a.val_frac, seed=a.seed)
    segs = segments.clean_segments(load(spark, a.segments))
    totals = load(spark, a.totals) if a.totals else segs.groupBy("clip_id").agg(F.max("end_ms").alias("total_ms"))
    rows = pipelines.plan_training_windows(segs, totals, plan)
    named = rows.select(F.format_string("%s_%04d.wav", "clip_id", "win").alias("path"), (F.col("n_frames") / plan.frame_hz).alias("duration"), "split")
    for r in state.hours(named, "split").orderBy("split").collect():
        print(f"{r.split}: {r.n} windows, {r.hours:.2f} h")
    if not a.dry_run:
        print(sinks.write_splits(named, a.out, plan.target_ms))


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="colloquy", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    subs = top.add_subparsers(dest="command", required=True)

    def command(f, *flags: str, **options) -> None:
        p = subs.add_parser(f.__name__)
        p.set_defaults(run=f)
        for name in flags:
            p.add_argument(f"--{name}", required=True)
        for name, value in options.items():
            name = f"--{name.replace('_', '-')}"
            if isinstance(value, list):
                p.add_argument(name, action="append", default=value)
            elif value is False:
                p.add_argument(name, action="store_true")
            else:
                p.add_argument(name, default=value, type=type(value) if value is not None else str)

    th, plan = Thresholds, WindowPlan
    command(discover, query=None, source=[], limit=50, cc_only=False, known=None, out="urls.txt")
    command(run, "videos", "votes", "segments", "out", state=None, cc_only=False, redo=False, min_duration=th.min_duration, max_duration=th.max_duration)
    command(stats, "state", manifest=None)
    command(export, "root", out="train_manifest.jsonl")
    command(hours, "manifest")
    command(transcribe, "words", "turns", "totals", "out", overwrite=False)
    command(windows, "segments", totals=None, out="./windows", window=plan.target_ms / 1000, min_window=plan.min_ms / 1000, max_window=plan.max_ms / 1000, min_gap=plan.min_gap_ms / 1000, min_rms=plan.min_rms, val_frac=plan.val_frac, seed=plan.seed, dry_run=False)
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    a = parser().parse_args(argv)
    session = spark or SparkSession.builder.appName(f"colloquy {a.command}").getOrCreate()
    ship(session)
    a.run(session, a)


if __name__ == "__main__":
    main()
