"""Catalog-shaped views over the test tables, as SQL that Spark and DuckDB both run."""

from __future__ import annotations

import re
from collections.abc import Iterable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

SQL_FILE = Path(__file__).with_name("fixtures.sql")
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "pages", "documents")


def definitions() -> dict[str, str]:
    """View name -> SELECT, in the order in which they build on each other."""
    parts = re.split(r"^-- (fx_\w+).*$", SQL_FILE.read_text(), flags=re.M)[1:]
    return {name: sql.strip().rstrip(";").strip() for name, sql in zip(parts[::2], parts[1::2])}


def with_views(sql: str, given: Iterable[str] = ()) -> str:
    """sql with the views it names before it, for an engine that has the tables alone, or these and the views in given."""
    known = {name: body for name, body in definitions().items() if name not in given}
    needed, todo = set(), {x for x in known if re.search(rf"\b{x}\b", sql)}
    while todo:
        needed |= todo
        todo = {y for x in todo for y in known if re.search(rf"\b{y}\b", known[x])} - needed
    views = ", ".join(f"{name} AS ({body})" for name, body in known.items() if name in needed)
    return f"WITH {views} {sql}" if views else sql


def view(spark: SparkSession, sf_dir: str, name: str, **given: DataFrame) -> DataFrame:
    """One view, over the tables of sf_dir and over views that are given, such as one that has been written once for many uses. Nothing stays registered under the plain table names of other folders."""
    body = with_views(f"SELECT * FROM {name}", given)
    for other, df in given.items():
        df.createOrReplaceTempView(other)
    for table in TABLES:
        if re.search(rf"\b{table}\b", body):
            spark.read.parquet(f"{sf_dir}/{table}.parquet").createOrReplaceTempView(table)
    return spark.sql(body)
