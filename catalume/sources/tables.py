"""Tables that the operators read and write. Every reader names its schema where files may lack columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RESPONSES = "source_id string, item_id string, url string, method string, page int, status_code int, content_type string, headers map<string,string>, body string, error_class string, fetched_at timestamp"
CHECKS = "source_id string, item_id string, check_timestamp timestamp, intake_score int"


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.parquet(path)
    if "source_id" not in df.columns:
        raise ValueError("a registry has one row per source, with a source_id")
    return df


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RESPONSES).parquet(path)


def read_snapshot(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A previous table; none yet gives no rows of schema."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)
    if schema and not there:
        return spark.createDataFrame([], schema)
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def write_inventory(items: DataFrame, path: str) -> None:
    """One folder per source; only the folders of sources in items are replaced.

    Rows are dealt out by source, but a source that is larger than spark.sql.adaptive.advisoryPartitionSizeInBytes to several tasks and small ones to one: there are about as many files as sources and that
    size demand, however many tasks there were and however unlike the sources are.
    """
    items.hint("rebalance", "source_id").write.partitionBy("source_id").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def write_report(report: DataFrame, path: str) -> None:
    report.write.partitionBy("run_id").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def read_report(spark: SparkSession, path: str, run_id: str) -> DataFrame:
    return spark.read.parquet(path).where(F.col("run_id") == run_id)


def write_checks(checks: DataFrame, path: str, version: int) -> str:
    """A new version beside the one that checks may come from; its path."""
    out = f"{path}/version={version}"
    checks.write.mode("overwrite").parquet(out)
    return out
