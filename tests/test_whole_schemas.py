"""Golden rows of what the whole schemas add, on cases that the test tables do not hold."""

from pyspark.sql import functions as F

from catalume.functions import text as T
from catalume.operators import changes, check, inventory, radar
from catalume.sources import parse


def rows(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def test_settings_of_a_nested_block(spark):
    df = spark.createDataFrame([("a", (None, 100)), ("b", (True, None)), ("c", None)], "source_id string, inventory struct<skip_current_list boolean, sample_size int>")
    assert rows(inventory.with_settings(df).orderBy("source_id"), "skip_current_list", "sample_size", "skip_package_search") == [(False, 100, False), (True, 25, False), (False, 25, False)]


def test_sdmx_urls(spark):
    df = spark.createDataFrame([("https://h/rest/dataflow",), ("https://h/rest/dataflow/IT1/?x=1",), ("https://h/rest",)], "u string")
    flow = F.lit("F")
    assert rows(df, T.sdmx_root(F.col("u"))) == [("https://h/rest",)] * 3
    assert rows(df, T.sdmx_flow_url(F.col("u"), flow)) == [("https://h/rest/F",), ("https://h/rest/dataflow/IT1/F",), ("https://h/F",)]


def test_reasons_of_the_registry_win(spark):
    df = spark.createDataFrame([("a", True, "perché no"), ("b", True, ""), ("c", False, "x")], "source_id string, non_inventoriable boolean, reason string")
    df = df.withColumns({"source_kind": F.lit("catalog"), "observation_mode": F.lit("catalog-watch"), "protocol": F.lit("ckan")})
    assert rows(inventory.route_sources(df).orderBy("source_id"), "reason") == [("perché no",), ("Fonte non inventariabile.",), (None,)]


def test_errors_are_cut_and_isolated(spark):
    df = spark.createDataFrame([("x" * 300,), (None,)], "error string")
    assert rows(check.isolated(df, F.col("error"), "ok"), "enrich_method", "check_notes") == [("error", "x" * 200), ("ok", None)]


def test_blocked_sources_and_precedence(spark):
    registry = spark.createDataFrame([("a", None, None, (True,)), ("b", "ckan", "https://b/api", (None,))], "source_id string, protocol string, base_url string, inventory struct<scraping_blocked boolean>")
    items = spark.createDataFrame([("a", "1", "n", None, "https://p", None, None), ("b", "2", "n", "sdmx", "https://p", " ", "ftp://x"), ("zz", "3", None, None, "ftp://p", None, None)], "source_id string, item_id string, item_name string, protocol string, landing_page string, item_slug string, api_base_url string")
    got = rows(parse.enrich_requests(items, registry).orderBy("item_id"), "kind", "url")
    assert got == [("blocked", None), ("ckan", "https://b/api/package_show?id=n"), ("none", None)]


def test_finished_checks(spark):
    items = spark.createDataFrame([("s", "1", "nome", "Comuni 2001", None, "https://l", None), ("s", "2", None, None, "t", None, None)], "source_id string, item_id string, item_name string, title string, tags string, landing_page string, distribution_url string")
    enriched = spark.createDataFrame([("s", "1", "https://r.csv", "CSV", "non_determinato", None, None, "sdmx_dataflow_annotations", None, "", None)], "source_id string, item_id string, resource_url string, resource_format string, granularity string, year_min int, year_max int, enrich_method string, enriched_title string, enriched_tags string, enriched_notes string")
    heads = spark.createDataFrame([("s", "1", None, "timeout")], "source_id string, item_id string, status_code int, error_class string")
    out = check.finish_check(items, enriched, heads, F.lit("2024-01-01").cast("timestamp")).orderBy("item_id")
    assert rows(out, "title", "url_checked", "reachable", "check_notes", "granularity", "year_min", "resource_format", "enrich_method") == [
        ("Comuni 2001", "https://l", False, "timeout", "comune", 2001, "CSV", "sdmx_dataflow_annotations"),
        (None, None, False, "url_missing_or_invalid", "non_determinato", None, None, "none"),
    ]
    assert out.columns == [x.split()[0] for x in check.CHECK_RESULT.split(", ")]


def test_signal_of_an_unknown_status(spark):
    schema = "source_id string, protocol string, status string, method string, row_count long, error string"
    cur, prev = spark.createDataFrame([("a", "ckan", "weird", None, None, None), ("b", "ckan", "error", None, None, None)], schema), spark.createDataFrame([("b", "ckan", "ok", "m", 3, None)], schema)
    assert sorted(rows(changes.signal_details(cur, prev), "source", "signal_type", "detail")) == [("a", "no signal", "Status non gestito: weird"), ("b", "health", "Errore: errore sconosciuto")]


def test_sources_without_url_are_red(spark):
    registry = spark.createDataFrame([("a", ""), ("b", "https://b")], "source_id string, base_url string")
    seen = spark.createDataFrame([("a", "GREEN", "200", None, False), ("b", "YELLOW", "404", None, False)], "source_id string, status string, http_code string, note string, ssl_fallback_used boolean")
    assert rows(radar.source_notes(registry, seen).orderBy("source_id"), "status", "note") == [("RED", "Missing base_url in registry entry"), ("YELLOW", "HTTP 404")]


def test_ordinals_of_many_datasets(spark):
    states = parse.group_bindings(spark.createDataFrame([("s", f"https://d/{i}", 25_001 - i) for i in range(25_000)], "source_id string, dataset string, pos int").withColumn("distribution_count", F.lit(None).cast("int")))
    got = parse.sparql_catalog(states)
    assert rows(got.where("item_id in ('https://d/24999', 'https://d/0', 'https://d/12000')").orderBy("ordinal"), "item_name", "ordinal") == [("24999", 1), ("12000", 13_000), ("0", 25_000)]
