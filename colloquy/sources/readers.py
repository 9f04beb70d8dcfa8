"""Readers: text lists, JSON lines, one folder per entity, media files."""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import MEDIA_TYPES


def read_list(spark: SparkSession, path: str, first: int = 0) -> DataFrame:
    """(url, pos) of a text list: trimmed, without blank lines, in order of file and line; the first n with `first`.

    pos counts the lines from 0 over all files, in the order of their names; every file ends its last line, whether or not a newline
    does. Files are read in blocks and lines of a block keep their order, so blocks are counted first and lines numbered within them.
    """
    lines = spark.read.text(path).select(F.trim(F.col("value")).alias("url"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("at"))
    lines = lines.where("url <> ''")
    if first:
        lines = lines.orderBy("file", "start", "at").limit(first)  # the first of each task, then of those
    blocks = lines.groupBy("file", "start").agg(F.count("*").alias("n"))  # one row a block of a file
    before = F.coalesce(F.sum("n").over(Window.orderBy("file", "start").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inside = F.row_number().over(Window.partitionBy("file", "start").orderBy("at")) - 1
    return lines.withColumn("inside", inside).join(blocks.select("file", "start", before.alias("before")), ["file", "start"]).select("url", (F.col("before") + F.col("inside")).alias("pos"))


def read_json_lines(spark: SparkSession, path: str, schema: str, strict: bool = False) -> DataFrame:
    """JSON lines with a fixed schema; malformed ones are dropped, or fail the read with strict."""
    return spark.read.schema(schema).option("mode", "FAILFAST" if strict else "DROPMALFORMED").json(path)


def read_entities(spark: SparkSession, root: str, schema: str, name: str = "meta.json") -> DataFrame:
    """One record per entity folder that has the file, with its folder, in the order of the folders' names."""
    rows = spark.read.schema(schema).option("multiLine", True).option("mode", "DROPMALFORMED").json(f"{root.rstrip('/')}/*/{name}")
    return rows.withColumn("folder", file_name(F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/[^/]+$", 1))).orderBy("folder")


def file_name(part: Column) -> Column:
    """A part of a file's address as the file system writes it."""
    return F.url_decode(F.regexp_replace(part, r"\+", "%2B"))


def media_type(path: Column, default: str = "audio/wav") -> Column:
    known = F.create_map(*[F.lit(x) for pair in MEDIA_TYPES.items() for x in pair])
    return F.coalesce(F.try_element_at(known, F.lower(F.regexp_extract(path, r"(\.[^./]+)$", 1))), F.lit(default))


def read_media(spark: SparkSession, *paths: str) -> DataFrame:
    """(path, media_type, length, content) of all media files below the paths; other files are left out, missing paths warned of."""
    from ..runtime import path_exists

    found = [p for p in paths if path_exists(spark, p)]
    for p in paths:
        if p not in found:
            warnings.warn(f"not found: {p}", stacklevel=2)
    if not found:
        return spark.createDataFrame([], "path string, media_type string, length long, content binary")
    pattern = "*{" + ",".join(x for e in MEDIA_TYPES for x in (e, e.upper())) + "}"
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(found)
    return files.select("path", media_type(F.col("path")).alias("media_type"), "length", "content")


def data_uri(content: Column, media: Column) -> Column:
    return F.concat(F.lit("data:"), media, F.lit(";base64,"), F.regexp_replace(F.base64(content), r"\s", ""))


def parse_turns(df: DataFrame, line: str = "line") -> DataFrame:
    """(start, end, speaker) of 'start end speaker' lines; lines with fewer parts or no numbers are dropped."""
    parts = F.filter(F.split(F.col(line), r"\s+"), lambda w: w != "")
    rows = df.select(*[c for c in df.columns if c not in (line, "start", "end", "speaker")], parts.alias("__p")).where(F.size("__p") >= 3)
    rows = rows.withColumns({"start": F.expr("try_cast(__p[0] as double)"), "end": F.expr("try_cast(__p[1] as double)"), "speaker": F.col("__p")[2]}).drop("__p")
    return rows.where("start is not null and end is not null")
