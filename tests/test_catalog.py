"""Golden rows, oracles in DuckDB, and the stream against the batch."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

from catalume.functions import text as T
from catalume.operators import changes, check, inventory, radar
from catalume.plans.registry import ORACLES, QUERIES
from catalume.sources import parse

SF = "/root/testdata/sf0.001"


def values(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def test_granularity(spark):
    golden = {"comuni della regione Lombardia": "comune", "dati provinciali italiani": "provincia", "regional statistics": "nazionale", "dati Lombardia 2022": "regione", "indicatori europei UE": "europeo", "": "non_determinato"}
    df = spark.createDataFrame([(k,) for k in golden], "t string")
    assert dict(values(df, "t", T.granularity(F.col("t")))) == golden


def test_years(spark):
    df = spark.createDataFrame([("copertura 2015-2023",), ("20 comuni",), ("proiezioni 2035",), ("1899 1900 120001",)], "t string")
    assert values(df, T.year_min(F.col("t")), T.year_max(F.col("t"))) == [(2015, 2023), (None, None), (None, None), (1900, 1900)]


def test_urls(spark):
    df = spark.createDataFrame([("https://h/odapi/package_list?limit=1",), ("",), ("https://h/api/3/action/package_search#x",)], "u string")
    assert values(df, T.ckan_api_base(F.col("u"))) == [("https://h/odapi",), (None,), ("https://h/api/3/action",)]
    one = spark.createDataFrame([("https://h/a b/è+1?x=ü z",)], "u string")
    assert values(one, T.quote_path(F.col("u"))) == [("https://h/a%20b/%C3%A8+1?x=ü z",)]


def test_score(spark):
    rows = [("comune", 1990, 2023, True, "CSV", "ckan_package_show"), ("non_determinato", None, None, False, None, "none"), ("regione", 2020, None, True, "dati.finale.json", "none")]
    df = spark.createDataFrame(rows, "granularity string, year_min int, year_max int, reachable boolean, resource_format string, enrich_method string")
    assert values(check.intake_score(df), "intake_score", "needs_review", "intake_candidate") == [(100, False, True), (0, True, False), (65, False, True)]


def test_overlay_takes_nulls_and_keeps_ordinals(spark):
    base = spark.createDataFrame([("s", "a", "A", 1), ("s", "b", "B", 2)], "source_id string, item_id string, title string, ordinal int")
    rich = spark.createDataFrame([("s", "a", "old", 1), ("s", "a", None, 9)], "source_id string, item_id string, title string, ordinal int")
    out = inventory.overlay(base, rich, ["source_id", "item_id"]).orderBy("item_id")
    assert values(out, "title", "ordinal", "matched") == [(None, 1, True), ("B", 2, False)]


def test_sample_equals_the_closed_form(spark):
    df = spark.createDataFrame([("s", str(i), i + 1) for i in range(103)], "source_id string, item_id string, ordinal int")
    kept = sorted(r.ordinal - 1 for r in inventory.systematic_sample(df, 10).collect())
    assert kept == [i for i in range(103) if i in (0, 102) or (i % 10 == 0 and i // 10 <= 8)]
    assert inventory.systematic_sample(df, 0).count() == 0


def test_malformed_bodies_do_no_harm(spark):
    df = spark.createDataFrame([("s", "i", "<a", "text/html"), ("s", "i", None, None), ("s", "i", '{"success":true,"result":{"name":"n","tags":["x",{"name":"y"}]}}', "application/json")], "source_id string, item_id string, body string, content_type string")
    assert parse.sdmx_items(df).count() == 0
    out = parse.ckan_items(df.withColumn("ordinal", F.lit(1))).collect()
    assert [(r.item_id, r.tags) for r in out] == [("n", "x, y")]


def test_radar(spark):
    df = spark.createDataFrame([(199,), (200,), (399,), (404,), (500,)], "c int")
    assert [r[0] for r in values(df, radar.radar_status(F.col("c")))] == ["RED", "GREEN", "GREEN", "YELLOW", "RED"]


def test_diff_and_signals(spark):
    schema = "source_id string, protocol string, status string, method string, row_count long, error string"
    prev = spark.createDataFrame([("a", "ckan", "ok", "m", 5, None), ("b", "ckan", "error", "m", 0, "x"), ("c", "ckan", "ok", "m", 5, None)], schema)
    cur = spark.createDataFrame([("a", "ckan", "ok", "m", 7, None), ("b", "ckan", "ok", "m", 3, None), ("d", "ckan", "ok", "m", 1, None)], schema)
    assert set(values(changes.report_diff(prev, cur), "source_id", "change", "delta")) == {("a", "row_change", "+2"), ("b", "recovery", None), ("c", "removed", None), ("d", "added", None)}
    assert set(values(changes.signals(cur, prev), "source", "signal_type", "metric_value")) == {("a", "inventory change", 7), ("b", "health", 3), ("d", "no signal", 1)}


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, name):
    con = duckdb.connect()
    con.sql("SET timezone = 'UTC'")
    for t in ("nation", "customer", "orders", "lineitem", "events", "documents", "pages"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = QUERIES[name](spark, SF)
    expected = con.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(expected.columns)
    at = [expected.columns.index(c) for c in df.columns]
    assert sorted(map(repr, map(tuple, df.collect()))) == sorted(repr(tuple(r[i] for i in at)) for r in expected.fetchall())


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")
def test_stream_equals_batch(spark):
    stream = QUERIES["j1_stream_upsert"](spark, SF)
    batch = QUERIES["d5_upsert_latest"](spark, SF)
    pick = lambda df, t: sorted(map(tuple, df.select("item_id", "source_id", t, "intake_score").collect()))
    assert pick(stream, F.date_format("check_timestamp", "yyyy-MM-dd")) == pick(batch, "checked")
