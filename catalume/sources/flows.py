"""SDMX listings that lie in XML files: read flow by flow, so that no listing is ever one row, and landed as narrow rows, so that none is parsed twice (A2, C4)."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from catalume.functions.text import given, stripped

FLOW = "_id string, Name array<string>, _corrupt_record string, source_id string, start long"
LANDED = "source_id string, start long, file string, at long, item_id string, title string"
ASIDE = "source_id string, start long, file string, reason string"


@contextmanager
def _listed_in_turn(spark: SparkSession) -> Iterator[None]:
    """Let folders be listed by as many tasks as there are cores, many folders a task, where Spark would start a task for each of up to 10,000 folders of a source."""
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(name)
    spark.conf.set(name, str(spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def read_flows(spark: SparkSession, path: str) -> DataFrame:
    """Each Dataflow of the XML files below path/source_id=../start=.., with its file and `at`, which rises through a file; flows that are no XML have _corrupt_record."""
    rows = spark.read.format("xml").schema(FLOW).options(rowTag="Dataflow", ignoreNamespace="true", nullValue="\u0000", mode="PERMISSIVE")
    with _listed_in_turn(spark):
        rows = rows.load(path)
    return rows.select("*", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("at"))


def unfinished(spark: SparkSession, path: str) -> DataFrame:
    """ASIDE rows of files whose text does not end by closing an element, such as those that broke off."""
    with _listed_in_turn(spark):
        lines = spark.read.schema("value string, source_id string, start long").text(path)
    tails = lines.where("value rlike '\\\\S'").select("source_id", "start", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), F.right("value", F.lit(300)).alias("tail"))
    last = tails.groupBy("source_id", "start", "file").agg(F.max_by("tail", F.struct("block", "at")).alias("tail"))
    return last.where("not tail rlike '</[^<>\\\\s]+\\\\s*>\\\\s*$'").select("source_id", "start", "file", F.lit("breaks off").alias("reason"))


def land_flows(spark: SparkSession, path: str, out: str) -> None:
    """Read the files below path, each listing once: flows to out/flows (LANDED), and files that break off or hold a flow that is no XML to out/aside (ASIDE). No flow of a file that is set aside counts."""
    parsed = read_flows(spark, path).withColumn("title", given(stripped(F.get("Name", F.lit(0)))))
    parsed.select("source_id", "start", "file", "at", F.col("_id").alias("item_id"), "title", F.col("_corrupt_record").isNotNull().alias("corrupt")).write.parquet(f"{out}/parsed")
    rows = spark.read.parquet(f"{out}/parsed")
    bad = rows.where("corrupt").select("source_id", "start", "file", F.lit("no XML").alias("reason")).distinct()
    unfinished(spark, path).unionByName(bad).write.parquet(f"{out}/aside")
    aside = spark.read.schema(ASIDE).parquet(f"{out}/aside")
    rows.join(aside.select("file").distinct(), "file", "left_anti").select(*[x.split()[0] for x in LANDED.split(", ")]).write.parquet(f"{out}/flows")


def flow_items(spark: SparkSession, out: str) -> DataFrame:
    """Landed flows as sdmx_items has them, numbered through each source by start, file and place: files are counted by source, flows ranked by file."""
    rows = spark.read.schema(LANDED).parquet(f"{out}/flows")
    counts = rows.groupBy("source_id", "start", "file").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(W.partitionBy("source_id").orderBy("start", "file").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    rank = F.row_number().over(W.partitionBy("source_id", "start", "file").orderBy("at"))
    numbered = rows.withColumn("rank", rank).join(counts.select("source_id", "start", "file", before.alias("before")), ["source_id", "start", "file"])
    return numbered.select("source_id", "item_id", F.col("item_id").alias("item_name"), "title", (F.col("before") + F.col("rank")).cast("int").alias("ordinal"))
