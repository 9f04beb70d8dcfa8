"""Small record functions: falsy values, overrides, lookups, slices, stamps, token spans."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import INDIC

TAGS = 20
SPANS = 1_000_000


def truthy(value: Column, kind: str) -> Column:
    """The value, or null where it is empty: 0, '', or an array or map without entries. kind: number, text or collection."""
    if kind == "collection":
        return F.when(F.size(value) > 0, value)
    return F.nullif(value, F.lit(0) if kind == "number" else F.lit(""))


def first_tags(tags: Column, n: int = TAGS) -> Column:
    return F.slice(tags, 1, n)


def override(record: Column, values: Mapping[str, Column]) -> Column:
    """The struct with the given fields replaced or added."""
    for name, value in values.items():
        record = record.withField(name, value)
    return record


def merge_maps(left: Column, right: Column) -> Column:
    """Entries of both maps; the right one wins (whatever the session's rule for repeated keys)."""
    kept = F.map_filter(left, lambda k, _: ~F.array_contains(F.map_keys(right), k))
    return F.map_concat(kept, right)


def lookup(table: Mapping[str, str], key: Column, default: Column | None = None) -> Column:
    """The value of a fixed table, else the default, else the key itself."""
    pairs = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    return F.coalesce(F.try_element_at(pairs, key), key if default is None else default)


def language_name(code: Column) -> Column:
    return lookup(INDIC, F.split_part(F.lower(F.trim(code)), F.lit("-"), F.lit(1)), F.lit(None).cast("string"))


def speaker_name(number: Column) -> Column:
    return F.format_string("SPEAKER_%02d", number)


def clip_name(vid: Column, i: Column) -> Column:
    return F.concat(vid, F.lit("_seg"), i.cast("string"))


def speaker_map(speakers: Column) -> Column:
    """spk0, spk1, ... to the sorted speakers."""
    ordered = F.array_sort(F.array_distinct(speakers))
    return F.map_from_arrays(F.transform(F.sequence(F.lit(0), F.size(ordered) - 1), lambda i: F.concat(F.lit("spk"), i.cast("string"))), ordered)


def local_stamp(epoch: Column) -> Column:
    """Epoch seconds as yyyy-MM-ddTHH:mm:ss in the session's time zone."""
    return F.date_format(F.timestamp_seconds(epoch), "yyyy-MM-dd'T'HH:mm:ss")


def frame_ms(frame: Column, n_samples: Column, n_frames: Column, rate: Column) -> Column:
    """The time of a frame in whole ms, half up; parted so that frame * n_samples is never formed."""
    div = lambda a, b: F.call_function("div", a, b)
    sample = frame * div(n_samples, n_frames) + div(frame * (n_samples % n_frames), n_frames)
    return div(sample * 2000 + rate, rate * 2)


def word_spans(df: DataFrame) -> DataFrame:
    """(clip_id, idx, start_ms, end_ms) of (clip_id, spans array<struct<start,end>> in frames, sizes array<int> tokens a word, n_samples, n_frames, rate).

    Word i takes sizes[i] spans after those of the words before it. Rows whose number of spans is not the sum of sizes are errors and
    fail. Lists stay flat Arrow arrays, about a million spans (or one row) at a time: a span is never an object of its own.
    """

    def parts(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ends = np.cumsum(pc.list_value_length(b["spans"]).to_numpy(zero_copy_only=False), dtype=np.int64)
        cuts = [0, *(np.flatnonzero(np.diff(ends // SPANS)) + 1).tolist(), b.num_rows]
        yield from (b.slice(i, j - i) for i, j in pairwise(cuts) if j > i)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (p for b in batches for p in parts(b)):
            n_spans, n_words = (pc.list_value_length(b[c]).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("spans", "sizes"))
            sizes = b["sizes"].flatten()
            if sizes.null_count:
                raise ValueError("sizes must not be null")
            sizes = sizes.to_numpy().astype(np.int64)
            last = np.cumsum(sizes)
            upto = np.concatenate([[0], last])[np.concatenate([[0], np.cumsum(n_words)])]
            if (np.diff(upto) != n_spans).any():
                raise ValueError("token spans and targets differ in number")
            row, idx = np.repeat(np.arange(b.num_rows), n_words), np.arange(len(sizes)) - np.repeat(np.cumsum(n_words) - n_words, n_words)
            some = sizes > 0
            row, idx, first, last = row[some], idx[some], (last - sizes)[some], last[some] - 1
            spans = b["spans"].flatten()
            start, end = (pc.struct_field(spans, c).take(pa.array(at)).cast(pa.int64()) for c, at in (("start", first), ("end", last)))
            if start.null_count or end.null_count:
                raise ValueError("a word's span must not be null")
            of = {c: b[c].take(pa.array(row)) for c in ("clip_id", "n_samples", "n_frames", "rate")}
            yield pa.RecordBatch.from_pydict({"clip_id": of.pop("clip_id"), "idx": pa.array(idx.astype(np.int32)), "start": start, "end": end} | of)

    rows = df.where("spans is not null and sizes is not null and n_frames > 0 and rate > 0").select("clip_id", "spans", "sizes", F.col("n_samples").cast("long"), F.col("n_frames").cast("long"), F.col("rate").cast("long"))
    found = rows.mapInArrow(run, "clip_id string, idx int, start long, end long, n_samples long, n_frames long, rate long")
    ms = lambda c: frame_ms(F.col(c), F.col("n_samples"), F.col("n_frames"), F.col("rate")).alias(f"{c}_ms")
    return found.select("clip_id", "idx", ms("start"), ms("end"))
