"""Registered queries of operators in their whole schemas, beside those of queries.py that show fewer columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalume.fixtures import view
from catalume.functions import text as T
from catalume.operators import build, changes, check, inventory, radar
from catalume.plans import queries as base
from catalume.sources import flows, parse, tables


def _of_protocol(spark, d, df: DataFrame, protocol: str) -> DataFrame:
    return df.join(base._registry(spark, d).where(F.col("protocol") == protocol).select("source_id"), "source_id", "left_semi")


def c1_ckan_inventory(spark, d):
    """Inventory rows of packages by search, in the whole schema."""
    packages = _of_protocol(spark, d, view(spark, d, "fx_ckan_packages"), "ckan")
    return base._shown(parse.inventory_rows(parse.ckan_items(packages), base._registry(spark, d), "ckan", base._now(), "package_search"))


def c2_names_inventory(spark, d):
    names = parse.ckan_names(_of_protocol(spark, d, base._name_pages(spark, d), "ckan"))
    return base._shown(parse.inventory_rows(names, base._registry(spark, d), "ckan", base._now(), "package_list"))


def c4_sdmx_inventory(spark, d):
    """Flows of several bodies a source; ordinals count through them."""
    found = parse.sdmx_items(_of_protocol(spark, d, base._flows(base._items(spark, d)), "sdmx"))
    return base._shown(parse.inventory_rows(found, base._registry(spark, d), "sdmx", base._now()))


def c4_sdmx_files(spark, d):
    """The same listings as files, some of which break off: landed flow by flow, then numbered."""
    path, out = base._scratch(spark, "listings"), base._scratch(spark, "flows")
    listings = base._flows(_of_protocol(spark, d, base._items(spark, d), "sdmx"))
    # a file costs more than its few bytes, so listings are dealt out by number to all cores, and tasks put files in place themselves
    dealt = listings.repartition(4 * spark.sparkContext.defaultParallelism, "source_id", "start")
    dealt.write.partitionBy("source_id", "start").option("mapreduce.fileoutputcommitter.algorithm.version", "2").text(path)
    flows.land_flows(spark, path, out)
    return flows.flow_items(spark, out)


def _sparql_registry(spark, d) -> DataFrame:
    """The registry's five SPARQL sources under the names that the bindings' sources have; the last names no query."""
    k = F.col("k") - 2
    name = F.when(k < 20, F.concat(F.lit("q"), k.cast("string")))
    rows = base._registry(spark, d).where("k % 5 = 2")
    return rows.select(F.concat(F.lit("s"), (k / 5).cast("int").cast("string")).alias("source_id"), "source_kind", "protocol", "base_url", F.lit(None).cast("string").alias("baseline_method"), name.alias("sparql_query_name"))


def c5b_sparql_inventory(spark, d):
    states = parse.group_bindings(view(spark, d, "fx_bindings"))
    return base._shown(parse.inventory_rows(parse.sparql_catalog(states), _sparql_registry(spark, d), "sparql", base._now()))


def b8_list_gate(spark, d):
    """Bodies of lists, one in four each with no list, an empty one, and a failure."""
    pages, n = base._name_pages(spark, d), (F.col("start") / 100).cast("int") % 4
    body = F.when(n == 0, F.concat(F.lit('{"success":true,'), F.substring("body", 2, 1 << 30))).when(n == 1, '{"success":true,"result":{"a":1}}').when(n == 2, '{"success":true,"result":[]}').otherwise('{"success":false}')
    bodies = pages.select("source_id", "start", F.lit("application/json").alias("content_type"), body.alias("body"))
    return parse.ckan_payload_status(bodies, "$.result").select("source_id", "start", "payload")


def _harvest_attempts(spark, d) -> DataFrame:
    n = F.regexp_extract("source_id", r"(\d+)", 1).cast("int")
    limit = F.when(F.col("attempt") == 1, 100).when(F.col("attempt") == 2, 50).otherwise(10)
    failure = F.coalesce("error_class", F.concat(F.lit("HTTP "), F.col("status_code").cast("string")))
    return view(spark, d, "fx_probe_attempts").select(F.concat(F.lit("g"), (n % 40).cast("string")).alias("source_id"), n.alias("position"), F.col("attempt").alias("step"), F.coalesce(F.col("status_code") < 400, F.lit(False)).alias("ok"), F.col("status_code").alias("n_rows"), limit.alias("limit"), failure.alias("failure"))


def c3b_harvest_warning(spark, d):
    out = inventory.harvest_warning(_harvest_attempts(spark, d))
    return out.select("source_id", "status", "rows_collected", F.col("warning.type").alias("type"), "warning.failed_offset", "warning.failed_limit", "warning.failure")


def c14_check_result(spark, d):
    """Every item checked: its package's enrichment, a probe of its url, what its own texts say, and the score."""
    every = base._items(spark, d)
    heads = every.select("source_id", "item_id", F.when(F.col("reachable"), 200).otherwise(404).alias("status_code"), F.lit(None).cast("string").alias("error_class"))
    return base._shown(check.finish_check(every.drop("reachable", "enrich_method"), parse.ckan_enrich(view(spark, d, "fx_ckan_packages")), heads, base._now()))


def c10_enrich_requests(spark, d):
    """Items of which some have a slug, a blank one or an API of their own."""
    n = F.col("ordinal")
    slug = F.when(n % 4 == 0, F.concat(F.lit(" slug-"), "item_id", F.lit(" "))).when(n % 4 == 1, " ")
    items = base._items(spark, d).withColumns({"item_slug": slug, "api_base_url": F.when(n % 5 == 0, "https://api.test/x").when(n % 5 == 1, "n/a")})
    return parse.enrich_requests(items, base._registry(spark, d))


def k2_own_enricher(spark, d):
    """The dispatch with an enricher of one's own, which knows every ninth item and comes before all others."""
    fields = {"resource_url": F.concat(F.lit("https://own.test/"), "item_id"), "resource_format": F.lit("CSV"), "granularity": F.lit("comune"), "year_min": F.lit(1990), "year_max": F.lit(2000), "enrich_method": F.lit("own")}
    parse.register_enricher("ninth", lambda items: items.where("ordinal % 9 = 0").select("source_id", "item_id", F.struct(*[c.alias(k) for k, c in fields.items()]).alias("enrich")))
    try:
        return base.c10_enrich_sdmx(spark, d)
    finally:
        del parse.ENRICHERS["ninth"]


def e1_full_report(spark, d):
    outcomes = base._report(spark, d, "cur").select("source_id", F.when(F.col("status") == "error", F.col("error")).alias("error"), F.when(F.col("row_count") % 2 == 0, "retry_backoff").alias("warning"))
    return changes.full_report(inventory.route_sources(base._registry(spark, d)), base._items(spark, d), outcomes)


def d8_observed_compare(spark, d):
    """Baselines against the method observed in the rows of each source's inventory."""
    registry = base._registry(spark, d)
    observed = F.when(F.col("ordinal") % 3 == 0, "package_search").when(F.col("k") % 4 < 2, "package_list").otherwise("package_show")
    items = base._items(spark, d).join(registry.select("source_id", "k"), "source_id").withColumn("inventory_method", observed)
    outcomes = base._report(spark, d, "cur").select("source_id", F.lit(None).cast("string").alias("error"), F.lit(None).cast("string").alias("warning"))
    return changes.baseline_compare(changes.full_report(inventory.route_sources(registry), items, outcomes), registry)


def e11_sample_warning(spark, d):
    n = F.regexp_extract("source_id", r"(\d+)", 1).cast("int")
    a = view(spark, d, "fx_probe_attempts").withColumn("n", n).withColumn("source_id", F.concat(F.lit("g"), (F.col("n") % 7).cast("string")))
    return inventory.sample_warning(a.where("error_class is not null"), a.where("error_class is null"), a, F.struct("n", "attempt"), F.col("error_class"))


def _noted(spark, d) -> DataFrame:
    """The registry with datasets in use, notes, and some sources without a base_url."""
    k = F.col("k")
    datasets = F.when(k % 3 == 0, F.array("protocol", "source_kind")).when(k % 3 == 1, F.array().cast("array<string>"))
    return base._registry(spark, d).withColumns({"datasets_in_use": datasets, "note": F.when(k % 4 == 1, "nota registro"), "base_url": F.when(k % 10 != 7, F.col("base_url"))})


def _detailed(spark, d) -> DataFrame:
    answered = F.col("http_code") != "-"
    return base._source_probe(spark, d).withColumns({"content_type": F.when(answered, "text/html"), "final_url": F.when(answered & (F.col("status") == "YELLOW"), F.concat(F.lit("https://f.test/"), "http_code"))})


def a1_registry_roundtrip(spark, d):
    path = base._scratch(spark, "registry")
    base._registry(spark, d).write.parquet(path)
    return tables.read_registry(spark, path).select("source_id", "protocol", "base_url")


def a2_responses_roundtrip(spark, d):
    """Landed responses of files that lack most of the columns."""
    path = base._scratch(spark, "landed")
    url = F.coalesce("landing_page", "distribution_url")
    base._items(spark, d).select("source_id", "item_id", url.alias("url"), F.lit("HEAD").alias("method"), F.when(F.col("reachable"), 200).otherwise(404).alias("status_code")).write.parquet(path)
    return tables.read_responses(spark, path).groupBy("source_id", "status_code").agg(F.count("*").alias("n"), F.count("url").alias("n_urls"), F.count("body").alias("n_bodies"))


def a5_report_roundtrip(spark, d):
    path = base._scratch(spark, "report")
    tables.write_report(view(spark, d, "fx_report"), path)
    return tables.read_report(spark, path, "cur").drop("run_id")


def a6_check_versions(spark, d):
    """Version 0 of the checks, and version 1, made of it and of a check of every item."""
    path = base._scratch(spark, "checks")
    read = lambda df, version: spark.read.schema(tables.CHECKS).parquet(tables.write_checks(df, path, version))
    old = read(base._existing(spark, d).select("source_id", "item_id", "check_timestamp", "intake_score"), 0)
    done = base._checked(base._items(spark, d)).select("source_id", "item_id", base._now().alias("check_timestamp"), "intake_score")
    return base._shown(read(check.upsert_latest(done, old, ("source_id", "item_id")), 1))


def i5_sdmx_urls(spark, d):
    url, flow = F.col("base_url"), F.concat(F.lit("F"), F.col("k").cast("string"))
    return base._registry(spark, d).select("source_id", T.sdmx_root(url).alias("root"), T.sdmx_data_url(url, flow).alias("data_url"), T.sdmx_flow_url(url, flow).alias("flow_url"))


def _build_registry(spark, d) -> DataFrame:
    """The registry, of which two CKAN sources do without the current list, one of them with a sample of packages."""
    k = F.col("k")
    return base._registry(spark, d).withColumns({"skip_current_list": k.isin(0, 18), "package_show_sample": k == 18})


def _build_responses(spark, d) -> DataFrame:
    """Landed responses of all protocols, in pages. CKAN: search answers for sources 3 and 13, is empty for 15 and fails for the others; the list fails for 20; the current list times out on page 2 for 10
    and fails for 15; packages are shown for 18, some not. SDMX: malformed bodies for 6, a status for 16, nothing for 21. SPARQL: a page instead of JSON for 7, no bindings for 22."""
    k, n = F.col("k"), F.col("ordinal")
    items = base._kept(spark, base._items(spark, d), "items").join(base._registry(spark, d).select("source_id", "k", "protocol", "base_url"), "source_id")
    ckan, api = items.where("protocol = 'ckan'"), F.regexp_replace("base_url", "/package_list.*", "")
    ok, json = F.lit(200), F.lit("application/json")
    blank = lambda kind: F.lit(None).cast(kind)
    row = lambda df, url, page, status, body, kind=json, error=None, item=None: df.select("source_id", (blank("string") if item is None else item).alias("item_id"), url.alias("url"), F.lit("GET").alias("method"), page.cast("int").alias("page"), status.cast("int").alias("status_code"), kind.alias("content_type"), blank("map<string,string>").alias("headers"), body.alias("body"), (blank("string") if error is None else error).alias("error_class"), base._now().alias("fetched_at"))
    url = lambda action: F.concat(api, F.lit(f"/{action}?x=1"))
    page = F.floor((n - 1) / 20) + 1
    package = lambda id: F.struct(F.col(id).alias("id"), F.col("item_name").alias("name"), "title", F.lit("Autore").alias("author"), F.array("tags").alias("tags"))
    paged = lambda df, element: df.groupBy("source_id", "k", "base_url", page.alias("page")).agg(F.transform(F.array_sort(F.collect_list(F.struct("ordinal", element.alias("e")))), lambda x: x["e"]).alias("list"))
    body = lambda *path: F.to_json(F.struct(F.lit(True).alias("success"), (F.struct(F.col("list").alias(path[1])) if len(path) > 1 else F.col("list")).alias(path[0])))
    sources, one = ckan.select("source_id", "k", "base_url").distinct(), F.lit(1)
    current = "current_package_list_with_resources"
    shown = F.to_json(F.struct((n % 50 != 1).alias("success"), F.struct(F.col("item_name").alias("name"), F.concat(F.lit("Mostra "), "item_id").alias("title")).alias("result")))
    sdmx = base._flows(items.where("k in (1, 6)")).join(items.select("source_id", "k", "base_url").distinct(), "source_id")
    binding = lambda c: F.when(c.isNotNull(), F.struct(c.alias("value")))
    bound = F.struct(binding(F.concat(F.lit("https://example.test/d/"), "item_id")).alias("dataset"), binding(F.col("title")).alias("title"), binding(F.col("distribution_url")).alias("distributionURL"))
    sparql = items.where("k = 2").groupBy("source_id", "base_url", F.floor((n - 1) / 100).alias("page")).agg(F.transform(F.array_sort(F.collect_list(F.struct("ordinal", bound.alias("e")))), lambda x: x["e"]).alias("bindings"))
    others, address = items.select("source_id", "k", "base_url").distinct(), F.col("base_url")
    return inventory.union_sources(
        row(paged(ckan.where("k in (3, 13)"), package("item_id")), url("package_search"), F.col("page"), ok, body("result", "results")),
        row(sources.where("k not in (3, 13)"), url("package_search"), one, ok, F.when(k == 15, '{"success":true,"result":{"results":[]}}').otherwise('{"success":false}')),
        row(paged(ckan.where("k <> 20"), F.col("item_name")), url("package_list"), F.col("page"), ok, body("result")),
        row(sources.where("k = 20"), url("package_list"), one, F.lit(503), blank("string")),
        row(paged(ckan.where((k != 15) & (n % 2 == 0) & ((k != 10) | (page == 1))), package("item_name")), url(current), F.col("page"), ok, body("result")),
        row(sources.where("k = 10"), url(current), F.lit(2), blank("int"), blank("string"), error=F.lit("timeout")),
        row(sources.where("k = 15"), url(current), one, ok, F.lit('{"success":false}')),
        row(ckan.where((k == 18) & (n % 25 == 1)), url("package_show"), one, ok, shown, item=F.col("item_name")),
        row(sdmx.where("k = 6 or start % 2 = 0"), address, F.col("start") + 1, ok, F.col("body"), F.lit("text/xml")),
        row(others.where("k = 16"), address, one, F.lit(500), blank("string"), blank("string")),
        row(sparql, address, F.col("page") + 1, ok, F.to_json(F.struct(F.struct("bindings").alias("results")))),
        row(others.where("k in (7, 22)"), address, one, ok, F.when(k == 7, "<html>").otherwise('{"results":{}}')),
    )


def _built(spark, d) -> tuple[DataFrame, DataFrame]:
    """Responses land with their bodies parsed; the inventory is built from what has landed."""
    landed = base._scratch(spark, "landed")
    parse.land(_build_responses(spark, d), landed)
    return build.build_inventory(spark, _build_registry(spark, d), spark.read.parquet(landed), base._scratch(spark, "build"), base._now(), buckets=8)


def h3_plan_metrics(spark, d):
    """What the plan of checks counts as it is written: items, those checked lately, those checked again as they were modified since, and those left out."""
    plan, seen = check.observed_plan(base._items(spark, d), base._existing(spark, d), base._now(), keys=("source_id", "item_id"))
    plan.write.parquet(base._scratch(spark, "plan"))
    return spark.createDataFrame([tuple(seen.get.values())], ", ".join(f"{c} long" for c in seen.get))


WHOLE = {
    "a1_registry_roundtrip": a1_registry_roundtrip,
    "a2_responses_roundtrip": a2_responses_roundtrip,
    "a5_report_roundtrip": a5_report_roundtrip,
    "a6_check_versions": a6_check_versions,
    "b1_route_reasons": lambda s, d: inventory.route_sources(base._registry(s, d)).select("source_id", "status", "reason"),
    "b8_list_gate": b8_list_gate,
    "c1_ckan_inventory": c1_ckan_inventory,
    "c2_names_inventory": c2_names_inventory,
    "c3b_harvest_warning": c3b_harvest_warning,
    "c4_sdmx_inventory": c4_sdmx_inventory,
    "c4_sdmx_files": c4_sdmx_files,
    "c5b_sparql_inventory": c5b_sparql_inventory,
    "c6_enriched_texts": lambda s, d: parse.ckan_enrich(view(s, d, "fx_ckan_packages")).select("source_id", "item_id", "enriched_title", "enriched_tags", "enriched_notes"),
    "c10_enrich_requests": c10_enrich_requests,
    "c14_check_result": c14_check_result,
    "c16_isolated": base.c16_isolated,
    "k1_inventory_build": lambda s, d: base._shown(_built(s, d)[0]),
    "d9_build_report": lambda s, d: base._shown(_built(s, d)[1]),
    "d2_with_registry": lambda s, d: parse.with_registry(base._items(s, d).select("source_id", "item_id"), base._registry(s, d), "protocol", "base_url", "scraping_blocked"),
    "d7_signal_details": lambda s, d: changes.signal_details(base._report(s, d, "cur"), base._report(s, d, "prev")),
    "d8_observed_compare": d8_observed_compare,
    "e1_full_report": e1_full_report,
    "e2_category_counts": lambda s, d: radar.category_counts(base._registry(s, d), base._source_probe(s, d)),
    "e6_named_summary": lambda s, d: parse.sparql_summary(view(s, d, "fx_bindings"), _sparql_registry(s, d)),
    "e7_sources_checked": lambda s, d: base._shown(changes.sources_checked(base._report(s, d, "cur"), T.run_ts(base._now()))),
    "e11_sample_warning": e11_sample_warning,
    "g3_ordered_diff": lambda s, d: changes.ordered(changes.report_diff(base._report(s, d, "prev"), base._report(s, d, "cur"))),
    "h3_plan_metrics": h3_plan_metrics,
    "k2_own_enricher": k2_own_enricher,
    "i5_sdmx_urls": i5_sdmx_urls,
    "i14_run_ts": lambda s, d: base._shown(s.read.parquet(f"{d}/events.parquet").select("event_id", T.run_ts(F.col("ts").cast("timestamp")).alias("run_ts"))),
    "i17_inventory_settings": lambda s, d: inventory.with_settings(base._registry(s, d)).select("source_id", *inventory.SETTINGS),
    "r8_lines_with_datasets": lambda s, d: radar.source_lines(_noted(s, d), _detailed(s, d)),
    "r9_note_details": lambda s, d: radar.source_notes(_noted(s, d), _detailed(s, d)),
}
