"""Session helpers: the shared folder for checkpoints and written tables."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, from spark.checkpoint.dir; one of this machine only where Spark is local (tests)."""
    folder = spark.conf.get(SETTING, None) or spark.sparkContext.getConf().get(SETTING)
    if not folder:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError(f"set {SETTING} to a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="colloquy-")
        spark.conf.set(SETTING, folder)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once an application, for clusters on which it is not installed."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        root = Path(__file__).resolve().parent
        archive = shutil.make_archive(f"{tempfile.mkdtemp(prefix='colloquy-')}/{root.name}", "zip", root.parent, root.name)
        spark.sparkContext.addPyFile(archive)
        _shipped.add(app)


def cut(df: DataFrame) -> DataFrame:
    """The rows of df from a reliable checkpoint: recomputation after a lost executor starts there."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _at(spark: SparkSession, path: str):
    """(file system, path) of a path on whatever file system holds it."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a written table."""
    fs, target = _at(spark, path)
    fs.delete(target, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = _at(spark, path)
    return fs.exists(target)


def list_names(spark: SparkSession, folder: str) -> list[str]:
    """The names below a folder; none where it does not exist."""
    fs, target = _at(spark, folder)
    return sorted(f.getPath().getName() for f in fs.listStatus(target)) if fs.exists(target) else []


def read_text(spark: SparkSession, path: str) -> str:
    fs, target = _at(spark, path)
    stream = fs.open(target)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text_once(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file under its name at once, by renaming; fails where the name is taken."""
    fs, target = _at(spark, path)
    _, draft = _at(spark, f"{path}.{uuid.uuid4().hex}")
    stream = fs.create(draft)
    stream.write(text.encode())
    stream.close()
    if fs.exists(target) or not fs.rename(draft, target):
        fs.delete(draft, False)
        raise FileExistsError(path)
