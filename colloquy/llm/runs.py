"""Sorted runs: rows with a text key, kept in the order of the key below a shared folder.

A run is written sorted, in files of `range_rows` rows at most, each a stretch of keys; the list of runs notes each file's first
and last key and its rows. Looking keys up reads only the files whose stretch holds one of them, so a batch of k keys reads
k * range_rows rows of each run at most, however long the history is. Runs are merged in tiers, `fan` of one size into one of the
next, so a row is rewritten once a tier: as often as the logarithm of the history.

The list of runs (one entry a file) is all that is held on the driver. Files are never changed; what an interrupted writer left
behind is in no list, and `vacuum` removes it.
"""

from __future__ import annotations

import uuid
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import delete_path, list_names

FAN, RANGE_ROWS, FEW_FILES = 4, 100_000, 4


class SortedRuns:
    """Runs of rows of one schema, whose first column is `key`; `merge` reduces the rows of runs put together."""

    def __init__(self, spark: SparkSession, folder: str, schema: str, merge: Callable[[DataFrame], DataFrame] = lambda rows: rows, fan: int = FAN, range_rows: int = RANGE_ROWS, runs: list[dict] | None = None):
        self.spark, self.folder, self.schema, self.merge, self.fan, self.range_rows = spark, folder, schema, merge, fan, range_rows
        self.runs: list[dict] = runs or []
        self.outdated: list[str] = []
        self.rows_read = 0

    def _load(self, files: list[tuple[str, int]]) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(*[f"{self.folder}/{name}" for name, _ in files]) if files else self.spark.createDataFrame([], self.schema)

    def _files(self) -> list[tuple[str, str, str, int]]:
        """(name, first key, last key, rows) of all files."""
        return [(f"{r['name']}/{f}", lo, hi, n) for r in self.runs for f, lo, hi, n in r["files"]]

    def rows(self) -> int:
        return sum(n for *_, n in self._files())

    def all(self) -> DataFrame:
        return self._load([(name, n) for name, _, _, n in self._files()])

    def near(self, keys: DataFrame) -> DataFrame:
        """The rows of the files whose stretch of keys holds one of keys (key); a superset of the rows with such keys."""
        files = self._files()
        if len(files) > FEW_FILES:
            stretches = [([lo for _, lo, _, _ in r["files"]], [hi for _, _, hi, _ in r["files"]]) for r in self.runs]
            shared = self.spark.sparkContext.broadcast(stretches)  # one entry a file

            def touched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                hit: set[int] = set()
                for batch in batches:
                    for key in set(batch.column(0).to_pylist()) - {None}:
                        first = 0
                        for lo, hi in shared.value:
                            hit.update(range(first + bisect_left(hi, key), first + bisect_right(lo, key)))
                            first += len(lo)
                yield pa.RecordBatch.from_arrays([pa.array(sorted(hit), pa.int32())], names=["file"])

            held = {r.file for r in keys.select("key").mapInArrow(touched, "file int").distinct().collect()}
            files = [f for i, f in enumerate(files) if i in held]
        self.rows_read += sum(n for *_, n in files)
        return self._load([(name, n) for name, _, _, n in files])

    def append(self, rows: DataFrame, tier: int = 0) -> None:
        """Write the rows (cheap to compute twice) as a run, then merge tiers that are full."""
        name = f"run-{uuid.uuid4().hex}"
        path = f"{self.folder}/{name}"
        fields = self.spark.createDataFrame([], self.schema).columns
        rows.select(*fields).where("key is not null").repartitionByRange("key").sortWithinPartitions(*fields[:2]).write.option("maxRecordsPerFile", self.range_rows).parquet(path)
        written = self.spark.read.schema(self.schema).parquet(path)
        files = written.groupBy(F.col("_metadata.file_name").alias("file")).agg(F.min("key").alias("lo"), F.max("key").alias("hi"), F.count("*").alias("n")).orderBy("lo", "hi").collect()
        if not files:
            return delete_path(self.spark, path)
        self.runs.append({"name": name, "tier": tier, "files": [[r.file, r.lo, r.hi, r.n] for r in files]})
        full = [r for r in self.runs if r["tier"] == tier]
        if len(full) >= self.fan:
            self.runs = [r for r in self.runs if r["tier"] != tier]
            self.outdated += [r["name"] for r in full]
            self.append(self.merge(self._load([(f"{r['name']}/{f}", n) for r in full for f, _, _, n in r["files"]])), tier + 1)

    def vacuum(self) -> None:
        """Delete runs that are in no list any more, and what interrupted writers left; nobody else may be writing."""
        kept = {r["name"] for r in self.runs}
        for name in list_names(self.spark, self.folder):
            if name.startswith("run-") and name not in kept:
                delete_path(self.spark, f"{self.folder}/{name}")
        self.outdated = []

    def forget(self) -> None:
        """Delete the runs that were merged, once a list without them is committed."""
        for name in self.outdated:
            delete_path(self.spark, f"{self.folder}/{name}")
        self.outdated = []
