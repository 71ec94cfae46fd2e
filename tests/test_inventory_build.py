"""The inventory in one call, on cases that the test tables do not hold; and what plans look like: parsed once, few exchanges, balanced files."""

import json
import os
import re

import pytest
from pyspark.sql import functions as F

from catalume.operators import build, check, inventory
from catalume.sources import parse, tables, versions
from catalume.sources.tables import RESPONSES


def responses(spark, rows):
    full = [(s, item, url, "GET", page, status, kind, None, body, error, None) for s, item, url, page, status, kind, body, error in rows]
    return spark.createDataFrame(full, RESPONSES)


def registry(spark, *rows):
    return spark.createDataFrame([(s, p, "catalog", "catalog-watch", f"https://{s}/api/3/action/package_list", False, "package_list", "", *more) for s, p, *more in rows], "source_id string, protocol string, source_kind string, observation_mode string, base_url string, non_inventoriable boolean, baseline_method string, reason string, skip_package_search boolean, skip_current_list boolean, package_show_sample boolean")


def ckan(source, action, page, result, item=None, success=True):
    return (source, item, f"https://{source}/api/3/action/{action}?start=0", page, 200, "application/json", json.dumps({"success": success, "result": result}), None)


NOW = "2001-01-01"


def run(spark, path, rows, *sources, only=None):
    items, report = build.build_inventory(spark, registry(spark, *sources), responses(spark, rows), path, F.lit(NOW).cast("timestamp"), only, buckets=4)
    return sorted((x.source_id, x.item_id, x.title, x.inventory_method, x.ordinal) for x in items.collect()), {x.source_id: x for x in report.collect()}


def test_ways_of_ckan_and_their_reports(spark, tmp_path):
    off = (True, False, False)
    rows = [
        ckan("a", "package_search", 1, {"results": [{"id": "1", "name": "n1", "title": "T1"}, {"name": "n2"}]}), ckan("a", "package_search", 2, {"results": []}),
        ckan("b", "package_list", 1, ["x", "y", 7]), ckan("b", "current_package_list_with_resources", 1, [{"id": "x", "title": "X"}, {"id": "zz", "title": "not listed"}]),
        ckan("b", "current_package_list_with_resources", 2, [{"id": "y", "title": "Y"}]), ("b", None, "https://b/api/3/action/current_package_list_with_resources", 3, None, None, None, "timeout"),
        ckan("c", "package_list", 1, ["x"]), ckan("c", "current_package_list_with_resources", 1, [{"id": "x"}]), ("c", None, "https://c/api/3/action/current_package_list_with_resources", 2, 500, None, None, None),
        ckan("d", "package_list", 1, ["p", "q"]), ckan("d", "package_show", 1, {"name": "other", "title": "P"}, item="p"), ckan("d", "package_show", 1, [1], item="q"),
        ckan("e", "package_list", 1, {"no": "list"}),
        ("f", None, "https://f/api/3/action/package_list", 1, 200, "text/html", "<html> Blocked", None),
    ]
    items, report = run(spark, str(tmp_path), rows, ("a", "ckan", False, False, False), ("b", "ckan", *off), ("c", "ckan", *off), ("d", "ckan", True, True, True), ("e", "ckan", *off), ("f", "ckan", *off), ("g", "ckan", *off))
    assert items == [
        ("a", "1", "T1", "package_search", 1), ("a", "n2", None, "package_search", 2),
        ("b", "7", None, "package_list", 3), ("b", "x", "X", "current_package_list_with_resources", 1), ("b", "y", "Y", "current_package_list_with_resources", 2),
        ("c", "x", None, "package_list", 1), ("d", "p", "P", "package_show_sample", 1), ("d", "q", None, "package_list", 2),
    ]
    told = {s: (x.status, x.row_count, x.error, x.warning, x.package_search_error, x.current_list_error, x.rows_enriched, x.rows_missing_metadata, x.failed_page) for s, x in report.items()}
    assert told == {
        "a": ("ok", 2, None, None, None, None, None, None, None),
        "b": ("ok", 3, None, "fallback_current_package_list_with_resources", "package_search skipped", None, 3, 1, 3),
        "c": ("ok", 1, None, "fallback_package_list", "package_search skipped", "current_package_list_with_resources: HTTP 500", None, None, None),
        "d": ("ok", 2, None, "skip_current_package_list_with_package_show_sample", None, None, 1, 1, None),
        "e": ("error", None, "package_list: result is not a list", None, None, None, None, None, None),
        "f": ("error", None, "package_list: non-JSON response: <html> Blocked", None, None, None, None, None, None),
        "g": ("error", None, "package_list: no rows", None, None, None, None, None, None),
    }


def test_a_rebuild_of_some_sources_leaves_the_others(spark, tmp_path):
    path, plain = str(tmp_path), (False, False, False)
    found = lambda s, *names: ckan(s, "package_search", 1, {"results": [{"id": x} for x in names]})
    sources = [(s, "ckan", *plain) for s in "abc"]
    run(spark, path, [found("a", "1", "2"), found("b", "1"), found("c", "1")], *sources)
    items, report = run(spark, path, [found("a", "3"), ckan("b", "package_search", 1, None, success=False), found("c", "9")], *sources, only=["a", "b"])
    assert [x[:2] for x in items] == [("a", "3"), ("c", "1")]
    assert {s: (x.status, x.row_count) for s, x in report.items()} == {"a": ("ok", 1), "b": ("error", None), "c": ("ok", 1)}
    with pytest.raises(ValueError, match="no rows"):
        run(spark, path, [], *sources, only=["a"])
    assert versions.rows(spark, f"{path}/inventory").count() == 2


def test_registered_protocols_are_built(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(inventory, "PROTOCOLS", dict(inventory.PROTOCOLS))
    inventory.register_protocol("lines", lambda x: x.select("source_id", F.posexplode(F.split("body", "\n")).alias("ordinal", "item_id")))
    items, report = run(spark, str(tmp_path), [("l", None, "https://l", 1, 200, "text/plain", "l1\nl2", None)], ("l", "lines", False, False, False))
    assert [x[:2] for x in items] == [("l", "l1"), ("l", "l2")] and report["l"].row_count == 2


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bodies_are_parsed_once_or_at_landing(spark, tmp_path):
    bodies = spark.createDataFrame([("s", "i", 1, "application/json", '{"success": true, "result": {"name": "n", "title": "comuni 2001", "tags": [" x ", {"name": "y"}, 5], "resources": [{"url": "http://f"}, 3]}}')], "source_id string, item_id string, ordinal int, content_type string, body string")
    parse.land(bodies, f"{tmp_path}/landed")
    landed = spark.read.parquet(f"{tmp_path}/landed")
    for f in (parse.ckan_items, parse.ckan_enrich, parse.ckan_payload_status):
        assert f(landed).drop("doc").collect() == f(bodies).drop("doc").collect()
        assert len(re.findall(r"parse_json|from_json", plan_of(f(bodies)))) <= 1 and not re.search("parse_json|from_json", plan_of(f(landed)))
    x = parse.ckan_enrich(bodies).first()
    assert (x.granularity, x.year_min, x.resource_url, x.enriched_tags) == ("comune", 2001, "http://f", "x, y")


def test_enrichers_add_no_exchanges(spark, monkeypatch):
    items = spark.createDataFrame([("s", "a", None), ("s", "a", None), ("t", "b", "https://p")], "source_id string, item_id string, landing_page string")
    sources = spark.createDataFrame([("s", "own", False), ("t", "own", False)], "source_id string, protocol string, scraping_blocked boolean")
    none = spark.createDataFrame([], "source_id string, item_id string, resource_url string, resource_format string, granularity string, year_min int, year_max int, enrich_method string")
    html = spark.createDataFrame([("t", "b", "PDF", "html_scrape")], "source_id string, item_id string, format string, enrich_method string")
    monkeypatch.setattr(parse, "ENRICHERS", {})
    counts = []
    for k in range(4):
        out = parse.enrich(items, sources, none, html, none)
        counts.append(plan_of(out).count("Exchange hashpartitioning"))
        parse.register_enricher(f"e{k}", lambda x, k=k: x.where("item_id = 'a'").select("source_id", "item_id", F.from_json(F.lit(f'{{"enrich_method": "own{k}"}}'), parse.ENRICHED).alias("enrich")).distinct())
    methods = sorted((x.item_id, x.enrich.enrich_method, x.enrich.resource_format) for x in parse.enrich(items, sources, none, html, none).collect())
    assert methods == [("a", "own0", None), ("a", "own0", None), ("b", "html_scrape", "PDF")]
    assert counts[1] - counts[0] == counts[2] - counts[1] == counts[3] - counts[2] <= 1  # the enricher's own distinct


def test_a_hot_dataset_is_reduced_before_it_is_gathered(spark):
    n = 200_000
    rows = spark.range(n).select(F.lit("s").alias("source_id"), F.when(F.col("id") % 10 == 9, F.concat(F.lit("d"), F.col("id").cast("string"))).otherwise("hot").alias("dataset"), (F.col("id") + 1).alias("pos"), F.when(F.col("id") > 5, "t").alias("title"), F.concat(F.lit("u"), (F.col("id") % 3).cast("string")).alias("download_url"), F.lit("f").alias("format"))
    out = parse.group_bindings(rows).where("dataset = 'hot'").first()
    assert (out.first_pos, out.title, out.urls, out.formats, out.themes) == (1, "t", ["u0", "u1", "u2"], ["f"], [])


def test_files_of_an_inventory_are_bounded(spark, tmp_path):
    items = spark.range(50_000).repartition(32).select(F.when(F.col("id") % 3 == 0, F.concat(F.lit("s"), (F.col("id") % 40).cast("string"))).otherwise("hot").alias("source_id"), F.sha2(F.col("id").cast("string"), 256).alias("item_id"))
    size, key = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes"), "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(key, "500k")
    try:
        tables.write_inventory(items, f"{tmp_path}/i")
    finally:
        spark.conf.set(key, size)
    files = [d for d, _, names in os.walk(f"{tmp_path}/i") for x in names if x.endswith(".parquet")]
    assert spark.read.parquet(f"{tmp_path}/i").count() == 50_000
    assert 40 < len(files) < 80 and 1 < sum(d.endswith("=hot") for d in files) < 16


def test_a_plan_is_counted_as_it_is_written(spark):
    items = spark.createDataFrame([(str(i), "2001-01-06" if i % 5 == 0 else "x") for i in range(50)], "item_id string, modified string")
    old = spark.createDataFrame([(str(i), f"2001-01-0{1 + i % 5}") for i in range(20)], "item_id string, check_timestamp string").withColumn("check_timestamp", F.col("check_timestamp").cast("timestamp"))
    now = F.lit("2001-01-09").cast("timestamp")
    plan, seen = check.observed_plan(items, old, now)
    n = plan.count()
    assert seen.get == {"n_items": 50, "n_recent": 16, "n_reinspected": 0, "n_skipped": 16} and n == 34 == check.recheck_plan(items, old, now).count()


def test_sources_by_list_and_by_table(spark):
    items = spark.createDataFrame([(f"s{i}", i) for i in range(9)], "source_id string, n int")
    assert inventory.only_sources(items, ["s1", "s7"]).count() == inventory.only_sources(items, items.where("n in (1, 7)")).count() == 2
