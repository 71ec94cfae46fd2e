"""What the operators share: where they may write, and how their Python reaches the executors."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import re
import tempfile
import time
import uuid
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space that separates words, as a Java regular expression class.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def prepare(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver has it."""
    root = str(Path(__file__).resolve().parents[2])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
    return spark


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share (spark.checkpoint.dir).

    Only a local session that names none, as in tests, gets a temporary folder; on a cluster its executors would not share it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base and not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("name a folder that driver and executors share in spark.checkpoint.dir")
    if not base:
        base = f"file://{tempfile.mkdtemp(prefix='catalume-')}"
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/catalume/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it again: lineage ends here, and a lost executor costs no more than a read."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, *frames: DataFrame) -> None:
    """Delete what stored() wrote, once nothing reads it any more."""
    jvm = spark.sparkContext._jvm
    for df in frames:
        for folder in {os.path.dirname(f) for f in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            if "/catalume/" in folder:
                path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner delete the shuffle files of plans that an iteration is done with; it waits for the driver's garbage collector."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def trim() -> None:
    """Give memory that is free back to the system: Python workers live on after a task, and count beside the JVM of their executor."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # where the C library has no such call
        ctypes.CDLL(None).malloc_trim(0)


def tidy(run):
    """A function of batches for mapInArrow that gives free memory back every few seconds, and when it ends."""

    def wrapped(batches):
        last = time.monotonic()
        for out in run(batches):
            yield out
            if time.monotonic() - last > 2:
                trim()
                last = time.monotonic()
        trim()

    return wrapped


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def bound(value: Column, f) -> Column:
    """f(value), where value is computed once however often f uses it."""
    return F.element_at(F.transform(F.array(value), f), 1)


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def crc32_of_id(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary"))
