"""Tables of keyed rows whose versions are published whole or not at all, and whose merges rewrite no more than the buckets they touch (A6, D5).

A table is a folder:

    data/<name>/bucket=<k>/part-*.parquet    rows of the buckets that one write has made
    versions/<number>.json                   which folder holds each bucket in that version, and what the write observed

A write puts its data beside what is there. Only then is the version's file written, under another name, and renamed; a name that is taken
is never renamed over. So a reader finds the old version or the new one, a write that dies leaves folders that no version names, and of two writers that
build on one version the later fails and may start again. That holds where renames are atomic: HDFS and local file systems.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


class Conflict(RuntimeError):
    """Another writer has published the version that this one was about to."""


class Version(NamedTuple):
    """number; schema of the rows; keys and how many buckets they are hashed to; the folder of each bucket that has rows; the last batch of each stream that is in it; what its write observed."""

    number: int
    schema: StructType
    keys: tuple[str, ...]
    buckets: int
    folders: dict[int, str]
    batches: dict[str, int]
    observed: dict[str, int]


def _fs(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def _text(spark: SparkSession, path: str) -> str:
    fs, where = _fs(spark, path)
    stream = fs.open(where)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def numbers(spark: SparkSession, path: str) -> list[int]:
    """Published versions of a table, ascending; none where there is no table."""
    fs, where = _fs(spark, f"{path}/versions")
    names = [x.getPath().getName() for x in fs.listStatus(where)] if fs.exists(where) else []
    return sorted(int(x[:-5]) for x in names if x.endswith(".json") and x[:-5].isdigit())


def version(spark: SparkSession, path: str, number: int | None = None) -> Version | None:
    """A version, or the newest; None where none is published."""
    if number is None:
        known = numbers(spark, path)
        if not known:
            return None
        number = known[-1]
    v = json.loads(_text(spark, f"{path}/versions/{number:020}.json"))
    return Version(number, StructType.fromJson(v["schema"]), tuple(v["keys"]), v["buckets"], {int(k): x for k, x in v["folders"].items()}, v["batches"], v["observed"])


def publish(spark: SparkSession, path: str, v: Version) -> Version:
    """Make v the newest version. Conflict if there is one of its number already."""
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    fs, where = _fs(spark, f"{path}/versions/.{v.number:020}-{uuid.uuid4().hex}")
    body = {"schema": v.schema.jsonValue(), "keys": list(v.keys), "buckets": v.buckets, "folders": v.folders, "batches": v.batches, "observed": v.observed}
    out = fs.create(where, False)
    out.write(bytearray(json.dumps(body).encode()))
    out.close()
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(where.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    to = jvm.org.apache.hadoop.fs.Path(f"{path}/versions/{v.number:020}.json")
    try:
        files.rename(where, to, gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0))
    except Exception as e:
        fs.delete(where, False)
        if "FileAlreadyExists" in str(e):
            raise Conflict(f"{path} has a version {v.number} already") from e
        raise
    return v


def bucket_of(v: Version) -> Column:
    return F.pmod(F.xxhash64(*v.keys), F.lit(v.buckets)).cast("int")


def rows(spark: SparkSession, path: str, number: int | None = None, only: list[int] | None = None) -> DataFrame:
    """Rows of a version (the newest, if none is named), or of some of its buckets. A reader keeps its version, whatever is published meanwhile."""
    v = version(spark, path, number)
    if v is None:
        raise FileNotFoundError(f"no version of {path} is published")
    folders = [f"{path}/data/{folder}/bucket={k}" for k, folder in sorted(v.folders.items()) if only is None or k in only]
    return spark.read.schema(v.schema).parquet(*folders) if folders else spark.createDataFrame([], v.schema)


def _written(df: DataFrame, v: Version, path: str, observed: dict[str, Column]) -> tuple[dict[int, str], dict[str, int]]:
    """Write rows by bucket, in files of a like size however buckets differ; the folder of each bucket, and what was observed in passing."""
    spark, name = df.sparkSession, uuid.uuid4().hex
    seen = Observation(name)
    out = df.withColumn("bucket", bucket_of(v)).hint("rebalance", "bucket").observe(seen, F.count("*").alias("n_rows"), *[c.cast("long").alias(k) for k, c in observed.items()])
    out.select(*v.schema.names, "bucket").write.partitionBy("bucket").parquet(f"{path}/data/{name}")
    fs, where = _fs(spark, f"{path}/data/{name}")
    made = [x.getPath().getName() for x in fs.listStatus(where)]
    return {int(x.removeprefix("bucket=")): name for x in made if x.startswith("bucket=")}, {k: x or 0 for k, x in seen.get.items()}


def create(df: DataFrame, path: str, keys: tuple[str, ...], buckets: int = 64) -> Version:
    """Version 0 of a table of df, by hash of keys. Conflict if there is a table."""
    if "bucket" in df.columns:
        raise ValueError("bucket is a name of the table's own")
    v = Version(0, df.schema, tuple(keys), buckets, {}, {}, {})
    folders, seen = _written(df, v, path, {})
    return publish(df.sparkSession, path, v._replace(folders=folders, observed=seen))


def merge(spark: SparkSession, path: str, new: DataFrame, keep: Callable[[DataFrame, DataFrame], DataFrame], stream: str | None = None, batch: int | None = None, observed: dict[str, Column] | None = None, touch: DataFrame | None = None, whole: bool = False) -> Version:
    """Publish a version in which the buckets of new's keys hold keep(old rows of these buckets, new); all other buckets stay where they are.

    touch: keys whose buckets are touched beside those of new; whole: all buckets are. keep has to give rows of touched buckets; observed: aggregates over what it gives, taken as it is written. A batch of a stream that is in the table already changes nothing, so batches may be
    repeated after a failure. new is written first, so that what it is made from is read once.
    """
    v = version(spark, path)
    if v is None:
        raise FileNotFoundError(f"no version of {path} is published")
    if stream is not None and v.batches.get(stream, -1) >= batch:
        return v
    staged = f"{path}/staged/{uuid.uuid4().hex}"
    new.write.parquet(staged)
    new = spark.read.schema(new.schema).parquet(staged)
    at = new.select(bucket_of(v).alias("bucket"))
    at = at if touch is None else at.unionByName(touch.select(bucket_of(v).alias("bucket")))
    touched = list(range(v.buckets)) if whole else [r["bucket"] for r in at.distinct().collect()]  # at most v.buckets
    batches = v.batches | ({stream: batch} if stream is not None else {})
    old = rows(spark, path, v.number, touched)
    folders, seen = _written(keep(old, new), v, path, observed or {})
    out = publish(spark, path, v._replace(number=v.number + 1, folders={k: x for k, x in v.folders.items() if k not in touched} | folders, batches=batches, observed=seen | {"n_buckets": len(touched)}))
    fs, where = _fs(spark, staged)
    fs.delete(where, True)
    return out


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Delete versions but the last `keep`, and data that none of these names, such as that of writes that died, with what they had staged; how many folders went. No write may be under way."""
    known = numbers(spark, path)
    held = {x for n in known[-keep:] for x in version(spark, path, n).folders.values()}
    for n in known[:-keep]:
        fs, where = _fs(spark, f"{path}/versions/{n:020}.json")
        fs.delete(where, False)
    fs, where = _fs(spark, f"{path}/staged")
    fs.delete(where, True)
    fs, where = _fs(spark, f"{path}/data")
    gone = [x.getPath() for x in fs.listStatus(where) if x.getPath().getName() not in held] if fs.exists(where) else []
    for x in gone:
        fs.delete(x, True)
    return len(gone)


def newest_row(old: DataFrame, new: DataFrame, keys: tuple[str, ...], order: Column, columns: list[str], new_wins: bool = True) -> DataFrame:
    """Of the rows of both that share keys the one of the greatest order; of equal ones a new one (if new_wins), then the greatest in the other columns. Nulls are least."""
    rest = [c for c in columns if c not in keys]
    both = old.withColumn("__new", F.lit(False)).unionByName(new.withColumn("__new", F.lit(new_wins)), allowMissingColumns=True)
    return both.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(order, "__new", *[_ordered(both, c) for c in rest])).alias("row")).select(*keys, "row.*").select(*columns)


def _ordered(df: DataFrame, column: str) -> Column:
    """A column as something that Spark can order by: maps go by their sorted entries, variants by their text."""
    kind = df.schema[column].dataType
    if kind.typeName() == "map":
        return F.array_sort(F.map_entries(column))
    return F.to_json(column) if kind.typeName() == "variant" else F.col(column)
