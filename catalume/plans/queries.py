"""The registered query of each operator, over views of the test tables."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalume.fixtures import view
from catalume.functions import text as T
from catalume.operators import changes, check, inventory, radar
from catalume.plans.oracles import ORACLES  # noqa: F401
from catalume.sources import parse, tables
from catalume.streaming.checks import stream_checks, stream_responses


def _now():
    return F.lit("2001-08-12 00:00:00").cast("timestamp")


def _items(spark, d):
    return view(spark, d, "fx_items")


def _kept(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """df written once, for what uses it many times."""
    path = _scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _on_items(f):
    return lambda spark, d: f(_items(spark, d))


def _registry(spark, d):
    return view(spark, d, "fx_registry")


def _report(spark, d, run):
    return view(spark, d, "fx_report").where(F.col("run_id") == run).drop("run_id")


def _probe(spark, d):
    return radar.collapse_attempts(view(spark, d, "fx_probe_attempts"))


def _source_probe(spark, d):
    """Outcomes dealt to the registry's sources by number."""
    k = F.regexp_extract("source_id", r"(\d+)", 1).cast("int")
    probe = _probe(spark, d).withColumn("k", k).drop("source_id")
    return _registry(spark, d).select("k", "source_id").join(probe, "k").drop("k")


def _checked(items: DataFrame) -> DataFrame:
    title = F.col("title")
    return check.intake_score(items.select("*", T.granularity(F.coalesce(title, F.lit(""))).alias("granularity"), T.year_min(title).alias("year_min"), T.year_max(title).alias("year_max"), F.col("format").alias("resource_format")))


def _existing(spark, d, **given):
    return view(spark, d, "fx_existing_checks", **given).withColumn("check_timestamp", F.col("check_timestamp").cast("timestamp"))


def _new_checks(spark, d) -> DataFrame:
    """Checks of all items that are due."""
    due = check.recheck_plan(_items(spark, d), _existing(spark, d), _now(), keys=("source_id", "item_id")).drop("why")
    return _checked(due).select("source_id", "item_id", _now().alias("check_timestamp"), "intake_score")


def _shown(df: DataFrame) -> DataFrame:
    """Times as text, which all engines write alike."""
    return df.select(*[F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) if kind == "timestamp" else F.col(c) for c, kind in df.dtypes])


def _scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share; a temporary one only where a local session names none."""

    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base and not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("name a folder that driver and executors share in spark.checkpoint.dir")
    return f"{base or 'file://' + tempfile.mkdtemp()}/{name}-{uuid.uuid4().hex}"


def a4_inventory_roundtrip(spark, d):
    path = _scratch(spark, "inventory")
    tables.write_inventory(_items(spark, d), path)
    return tables.read_snapshot(spark, path).groupBy("source_id").agg(F.count("*").alias("n"), F.sum(F.col("item_id").cast("bigint")).alias("sum_id"), F.count("title").alias("n_titles"))


def _name_pages(spark, d) -> DataFrame:
    """List bodies of a hundred names."""
    n = F.floor((F.col("ordinal") - 1) / 100)
    return _items(spark, d).groupBy("source_id", (n * 100).alias("start")).agg(F.to_json(F.struct(F.transform(F.array_sort(F.collect_list(F.struct("ordinal", "item_name"))), lambda x: x["item_name"]).alias("result"))).alias("body"))


def c3_merge_pages(spark, d):
    return parse.merge_pages(_name_pages(spark, d), 100)


def c2_ckan_names(spark, d):
    return parse.ckan_names(_name_pages(spark, d))


def _flows(items: DataFrame) -> DataFrame:
    """XML bodies of flows per source and hundred items; items without title have a blank name, an empty one or none. One item in 29 lies in a body that is malformed."""
    n, bad = F.col("ordinal"), F.col("ordinal") % 29 == 0
    name = F.when(F.col("title").isNotNull(), F.concat(F.lit("<c:Name>"), F.col("title"), F.lit("</c:Name><c:Name>other</c:Name>"))).when(n % 3 == 0, "<c:Name> </c:Name><c:Name>other</c:Name>").when(n % 3 == 1, "<c:Name/>").otherwise("")
    flow = F.concat(F.lit('<s:Dataflow id="'), F.col("item_id"), F.lit('">'), name, F.lit("</s:Dataflow>"))
    pages = items.groupBy("source_id", F.floor((n - 1) / 100).alias("page"), bad.alias("bad")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ordinal", flow.alias("flow")))), lambda x: x["flow"]), "").alias("flows"))
    return pages.select("source_id", (F.col("page") * 2 + F.col("bad").cast("int")).alias("start"), F.concat(F.lit("<m:S xmlns:m='m' xmlns:s='s' xmlns:c='c'>"), "flows", F.when(F.col("bad"), "<").otherwise("</m:S>")).alias("body"))


def c4_sdmx_items(spark, d):
    return parse.sdmx_items(_flows(_items(spark, d))).select("source_id", "item_id", "item_name", "title")


def c7_sdmx_enrich(spark, d):
    text = F.concat_ws("+", F.lower("tags"), "title", F.lit(" A,b "))
    body = F.concat(F.lit("<m:S xmlns:m='m'><m:Annotation id='LAYOUT_DATAFLOW_KEYWORDS'><m:AnnotationText>"), text, F.lit("</m:AnnotationText></m:Annotation>"), F.when(F.col("ordinal") % 29 == 0, "").otherwise("</m:S>"))
    return parse.sdmx_enrich(_items(spark, d).select("item_id", body.alias("body"))).select("item_id", "tags", "notes", "granularity", "year_min", "year_max")


def c8_sdmx_years(spark, d):
    y = F.substring("modified", 1, 4)
    body = F.concat(F.lit("<m:S xmlns:m='m'><m:ObsKey><m:Value id='TIME_PERIOD' value='"), y, F.lit("'/></m:ObsKey><m:Obs TIME_PERIOD='1999-Q1'/>"), F.when(F.col("ordinal") % 29 == 0, "").otherwise("</m:S>"))
    return parse.sdmx_years(_items(spark, d).select("item_id", body.alias("body")))


def c10_enrich_dispatch(spark, d):
    items = _items(spark, d)
    html = parse.html_format(view(spark, d, "fx_html")).withColumn("item_id", F.col("page_id").cast("string"))
    ckan = parse.ckan_enrich(parse.of_protocol(view(spark, d, "fx_ckan_packages"), _registry(spark, d), "ckan"))
    return parse.enrich(items, _registry(spark, d), ckan, html).select("item_id", "enrich.enrich_method", "enrich.resource_format")


def _sdmx_bodies(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    n = F.col("ordinal")
    note = lambda name, text: F.concat(F.lit(f"<m:Annotation><m:AnnotationType>{name}</m:AnnotationType><m:AnnotationText>"), text, F.lit("</m:AnnotationText></m:Annotation>"))
    words = note("LAYOUT_DATAFLOW_KEYWORDS", F.concat_ws("+", F.lower("tags"), "title", F.lit(" A,b ")))
    body = F.concat(F.lit("<m:S xmlns:m='m'>"), words, F.when(n % 2 == 0, note("METADATA_URL", F.concat(F.lit("https://example.test/meta/"), F.col("item_id")))).otherwise(""), F.when(n % 29 == 0, "").otherwise("</m:S>"))
    annotations = items.select("source_id", "item_id", F.when(n % 23 == 0, 500).otherwise(200).alias("status_code"), body.alias("body"))
    seen = F.concat(F.lit("<m:S xmlns:m='m'><m:Obs TIME_PERIOD='"), F.substring("modified", 1, 4), F.lit("'/><m:Obs TIME_PERIOD='1999-Q1'/>"), F.when(n % 7 == 0, "").otherwise("</m:S>"))
    return annotations, items.select("source_id", "item_id", seen.alias("body"))


def c10_enrich_sdmx(spark, d):
    """The dispatch with SDMX: annotation and observation bodies of all items, some not 200, some malformed, some without METADATA_URL or years."""
    items = _items(spark, d)
    html = parse.html_format(view(spark, d, "fx_html")).withColumn("item_id", F.col("page_id").cast("string"))
    annotations, seen = _sdmx_bodies(items)
    sdmx = parse.sdmx_enrich(*[parse.of_protocol(x, _registry(spark, d), "sdmx") for x in (annotations, seen)])
    ckan = parse.ckan_enrich(parse.of_protocol(view(spark, d, "fx_ckan_packages"), _registry(spark, d), "ckan"))
    out = parse.enrich(items, _registry(spark, d), ckan, html, sdmx)
    return out.select("source_id", "item_id", "enrich.*")


def c16_error_rows(spark, d):
    return c16_isolated(spark, d).drop("check_notes")


def c16_isolated(spark, d):
    packages = parse.ckan_payload_status(view(spark, d, "fx_ckan_packages"))
    rows = check.isolated(packages, F.when(F.col("payload") != "ok", F.col("payload")), "ckan_package_show")
    return rows.select("source_id", "item_id", "enrich_method", "check_notes")


def _overlaid(spark, d):
    items, enriched = _items(spark, d).select("source_id", "item_id", "item_name", "title", "ordinal"), view(spark, d, "fx_enriched")
    return inventory.overlay(items, enriched, ["source_id", "item_id"])


def d9_method_fallback(spark, d):
    """Search is usable for odd sources, the list for all, the current list (a third of the items) for those that don't skip it."""
    registry = _registry(spark, d).where(F.col("protocol") == "ckan").select("source_id", "k", "skip_current_list")
    items = _items(spark, d).select("source_id", "item_id", "item_name", "title", "ordinal").join(registry.select("source_id", "k"), "source_id").withColumn("usable", F.lit(True))
    down = registry.where("k % 2 = 0").select("source_id", F.lit(False).alias("usable"))
    search = items.where("k % 2 = 1").drop("k").unionByName(down, allowMissingColumns=True)
    current = view(spark, d, "fx_enriched").withColumn("usable", F.lit(True))
    out, _ = inventory.method_fallback(search, items.drop("k"), current, current.limit(0), registry)
    return out.select("source_id", "item_id", "method", "title")


def c3b_partial_harvest(spark, d):
    a = view(spark, d, "fx_probe_attempts")
    n = F.regexp_extract("source_id", r"(\d+)", 1).cast("int")
    return inventory.partial_harvest(a.select(F.concat(F.lit("g"), (n % 40).cast("string")).alias("source_id"), n.alias("position"), F.col("attempt").alias("step"), F.coalesce(F.col("status_code") < 400, F.lit(False)).alias("ok"), F.col("status_code").alias("n_rows")))


def j1_stream_upsert(spark, d):
    """Checks of all items that are due land in three files, and are upserted file by file."""
    landed = _scratch(spark, "landed")
    _new_checks(spark, d).repartition(3).write.parquet(landed)
    return _shown(stream_checks(spark, landed, _scratch(spark, "checks"), _scratch(spark, "stream"), _existing(spark, d), buckets=8, files=1))


def _responses(spark, d, every: DataFrame | None = None) -> DataFrame:
    """Landed responses for each item of the recheck plan: HEAD, its CKAN package, SDMX bodies or page. every: all items, where they have been written already; the plan is written once, and packages are of its items alone."""
    every = _items(spark, d) if every is None else every
    items = _kept(spark, check.recheck_plan(every, _existing(spark, d, fx_items=every), _now(), keys=("source_id", "item_id")), "plan")
    plan = items.select("source_id", "item_id")
    link = F.coalesce("landing_page", "distribution_url")
    row = lambda df, url, method, status, kind, body: df.select("source_id", "item_id", url.alias("url"), F.lit(method).alias("method"), F.lit(1).alias("page"), status.cast("int").alias("status_code"), kind.alias("content_type"), F.lit(None).cast("map<string,string>").alias("headers"), body.alias("body"), F.lit(None).cast("string").alias("error_class"), _now().alias("fetched_at"))
    none = F.lit(None).cast("string")
    notes, seen = (x.join(_registry(spark, d).where("protocol = 'sdmx'").select("source_id"), "source_id") for x in _sdmx_bodies(items))
    packages = view(spark, d, "fx_ckan_packages", fx_items=items).join(_registry(spark, d).where("protocol = 'ckan'").select("source_id"), "source_id")
    pages = view(spark, d, "fx_html").withColumn("item_id", F.col("page_id").cast("string")).join(plan, "item_id")
    return inventory.union_sources(
        row(items, link, "HEAD", F.when(F.col("reachable"), 200).otherwise(404), none, none),
        row(packages, F.concat(F.lit("https://h.test/package_show?id="), F.col("item_id")), "GET", F.col("status_code"), F.col("content_type"), F.col("body")),
        row(notes, F.concat(F.lit("https://h.test/dataflow/IT1/"), F.col("item_id")), "GET", F.col("status_code"), F.lit("text/xml"), F.col("body")),
        row(seen, F.concat(F.lit("https://h.test/data/"), F.col("item_id")), "GET", F.lit(200), F.lit("text/xml"), F.col("body")),
        row(pages, F.col("url"), "GET", F.col("status_code"), F.lit("text/html"), F.col("html")),
    )


def j1_stream_responses(spark, d):
    """The whole of J1: responses of items that are due land in any of three sets of files, so that those of one check come in several batches; each batch is parsed, scored and upserted."""
    landed, items = _scratch(spark, "responses"), _kept(spark, _items(spark, d), "items")
    files = spark.sparkContext.defaultParallelism  # of a set: no task writes a third of all responses
    _responses(spark, d, items).repartition(3 * files, "item_id", "url", "method").write.parquet(landed)
    return _shown(stream_responses(spark, landed, _scratch(spark, "checks"), _scratch(spark, "stream"), items, _registry(spark, d), _existing(spark, d, fx_items=items), buckets=8, files=files))


def _head(spark, d):
    a = view(spark, d, "fx_probe_attempts").withColumn("url", F.when(F.col("attempt") == 3, "ftp://x").otherwise(F.col("url")))
    return check.head_outcome(a).select("source_id", "attempt", "reachable", "check_notes")


QUERIES = {
    "a4_inventory_roundtrip": a4_inventory_roundtrip,
    "b1_route": lambda s, d: inventory.route_sources(_registry(s, d)).select("source_id", "protocol", "status"),
    "b2_only_sources": _on_items(lambda x: inventory.only_sources(x, ["NATION_1", "NATION_7", "NATION_15"]).select("source_id", "item_id")),
    "b3_with_url": _on_items(lambda x: inventory.with_url(x).select("item_id", "landing_page", "distribution_url")),
    "b4_with_title": _on_items(lambda x: inventory.with_title(x).select("item_id", "title")),
    "b8_payload_gate": lambda s, d: parse.ckan_payload_status(view(s, d, "fx_ckan_packages")).select("source_id", "item_id", "payload"),
    "c1_ckan_items": lambda s, d: parse.ckan_items(view(s, d, "fx_ckan_packages")),
    "c2_ckan_names": c2_ckan_names,
    "c3_merge_pages": c3_merge_pages,
    "c3b_partial_harvest": c3b_partial_harvest,
    "c4_sdmx_items": c4_sdmx_items,
    "c5_group_bindings": lambda s, d: parse.group_bindings(view(s, d, "fx_bindings")).select("source_id", "dataset", "first_pos", "title", "distribution_count", F.array_join("urls", ",").alias("urls"), F.array_join("formats", ",").alias("formats"), F.array_join("themes", ",").alias("themes")),
    "c5b_sparql_items": lambda s, d: parse.sparql_items(parse.group_bindings(view(s, d, "fx_bindings"))),
    "c6_ckan_enrich": lambda s, d: parse.ckan_enrich(view(s, d, "fx_ckan_packages")).drop("enriched_title", "enriched_tags", "enriched_notes"),
    "c7_sdmx_enrich": c7_sdmx_enrich,
    "c8_sdmx_years": c8_sdmx_years,
    "c9_html_format": lambda s, d: parse.html_format(view(s, d, "fx_html")),
    "c10_enrich_dispatch": c10_enrich_dispatch,
    "c10_enrich_sdmx": c10_enrich_sdmx,
    "c11_fallback_infer": _on_items(lambda x: check.fallback_infer(x.select("item_id", "title", "tags", F.lit(T.UNKNOWN).alias("granularity"), F.lit(None).cast("int").alias("year_min"), F.lit(None).cast("int").alias("year_max"))).drop("title", "tags")),
    "c12_url_to_check": _on_items(lambda x: x.select("item_id", check.url_to_check(F.lit(None).cast("string"), F.col("landing_page"), F.col("distribution_url"), F.col("enrich_method")).alias("url"))),
    "c13_head_outcome": _head,
    "c15_intake_score": _on_items(lambda x: _checked(x).select("item_id", "granularity", "year_min", "year_max", "needs_review", "intake_score", "intake_candidate")),
    "c16_error_rows": c16_error_rows,
    "d1_overlay": _overlaid,
    "d3_recheck_plan": lambda s, d: check.recheck_plan(_items(s, d), _existing(s, d), _now()).select("item_id", "why"),
    "d5_upsert_latest": lambda s, d: check.upsert_latest(_new_checks(s, d), _existing(s, d)).select("item_id", "source_id", F.date_format("check_timestamp", "yyyy-MM-dd").alias("checked"), "intake_score"),
    "d5b_replace_sources": lambda s, d: inventory.replace_sources(_existing(s, d).select("source_id", "item_id", "intake_score"), _new_checks(s, d).where("source_id < 'NATION_2'").select("source_id", "item_id", "intake_score"), _items(s, d).where("source_id < 'NATION_2'")),
    "d5c_carry_report": lambda s, d: changes.carry_report(_report(s, d, "prev"), _report(s, d, "cur")),
    "d6_report_diff": lambda s, d: changes.report_diff(_report(s, d, "prev"), _report(s, d, "cur")),
    "d7_signals": lambda s, d: changes.signals(_report(s, d, "cur"), _report(s, d, "prev")),
    "d8_baseline_compare": lambda s, d: changes.baseline_compare(_report(s, d, "cur"), _registry(s, d)),
    "d9_method_fallback": d9_method_fallback,
    "e1_source_report": lambda s, d: changes.source_report(inventory.route_sources(_registry(s, d)), _items(s, d)),
    "e2_radar_counts": lambda s, d: radar.radar_counts(_registry(s, d), _source_probe(s, d)),
    "e3_value_counts": _on_items(lambda x: check.value_counts(x, "enrich_method")),
    "e4_check_summary": _on_items(lambda x: check.check_summary(_checked(x))),
    "e5_overlay_counts": lambda s, d: inventory.overlay_counts(_items(s, d), view(s, d, "fx_enriched")),
    "e6_sparql_summary": lambda s, d: parse.sparql_summary(view(s, d, "fx_bindings")),
    "e8_signal_counts": lambda s, d: changes.signal_counts(changes.signals(_report(s, d, "cur"), _report(s, d, "prev"))),
    "e10_inventory_profile": _on_items(lambda x: inventory.inventory_profile(x, "source_id", "enrich_method")),
    "e11_error_preview": lambda s, d: inventory.error_preview(view(s, d, "fx_probe_attempts").where("error_class is not null").withColumn("n", F.regexp_extract("source_id", r"(\d+)", 1).cast("int")).select(F.concat(F.lit("g"), (F.col("n") % 7).cast("string")).alias("source_id"), "n", "attempt", "error_class"), F.struct("n", "attempt"), F.col("error_class")),
    "f2_limit_per_source": _on_items(lambda x: inventory.limit_per_source(x, 5).select("source_id", "item_id", "ordinal")),
    "f4_systematic_sample": _on_items(lambda x: inventory.systematic_sample(x, 25).select("source_id", "item_id", "ordinal")),
    "g1_limit": _on_items(lambda x: inventory.first_n(x, 100).select("source_id", "item_id", "ordinal")),
    "g2_top_candidates": _on_items(lambda x: check.top_candidates(_checked(x))),
    "h1_union_sources": lambda s, d: inventory.union_sources(_items(s, d).select("source_id", "item_id", "title"), view(s, d, "fx_enriched").select("source_id", "item_id", "item_name")),
    "h3_recent_minus_updated": lambda s, d: check.recent_minus_updated(check.recent(_existing(s, d), _now()), _items(s, d).where(F.coalesce(F.try_to_timestamp("modified") > F.lit("2001-08-06").cast("timestamp"), F.lit(False)))),
    "i1_granularity": lambda s, d: s.read.parquet(f"{d}/documents.parquet").select("doc_id", T.granularity(F.coalesce("text", F.lit(""))).alias("granularity")),
    "i2_years": _on_items(lambda x: x.select("item_id", T.year_min(F.col("title")).alias("year_min"), T.year_max(F.col("title")).alias("year_max"))),
    "i3_ckan_api_base": lambda s, d: _registry(s, d).select("source_id", T.ckan_api_base(F.col("base_url")).alias("api_base")),
    "i4_ckan_endpoint": lambda s, d: _registry(s, d).select("source_id", T.ckan_endpoint(F.col("base_url"), "package_show").alias("endpoint")),
    "i5_sdmx_base": lambda s, d: _registry(s, d).select("source_id", T.sdmx_base(F.col("base_url")).alias("base")),
    "i6_strip_query": lambda s, d: _registry(s, d).select("source_id", T.strip_query(F.col("base_url")).alias("plain")),
    "i7_parse_int": _on_items(lambda x: x.select("item_id", T.parse_int(F.substring("modified", 1, 4)).alias("year"))),
    "i10_uri_name": lambda s, d: view(s, d, "fx_bindings").where("dataset is not null").select(F.col("dataset"), T.uri_name(F.col("dataset")).alias("name")).distinct(),
    "i11_format": _on_items(lambda x: x.select("item_id", T.norm_format(F.col("format")).alias("format"))),
    "i13_quote_path": _on_items(lambda x: x.select("item_id", T.quote_path(F.concat(F.lit("https://h.test/a b/"), F.coalesce("title", F.lit("è")), F.lit("?q=1 2"))).alias("url"))),
    "j1_stream_upsert": j1_stream_upsert,
    "j1_stream_responses": j1_stream_responses,
    "r1_status": lambda s, d: view(s, d, "fx_probe_attempts").select("source_id", "attempt", radar.radar_status(F.col("status_code")).alias("status")),
    "r2_ckan_health": lambda s, d: radar.ckan_health(view(s, d, "fx_probe_attempts").where("error_class is null")).select("source_id", "attempt", "status", "note"),
    "r3_is_sdmx": lambda s, d: _registry(s, d).select("source_id", radar.is_sdmx(F.col("base_url")).alias("sdmx")),
    "r4_probe_error": lambda s, d: radar.probe_error(view(s, d, "fx_probe_attempts")).select("source_id", "attempt", "status", "note"),
    "r5_ssl_fallback": lambda s, d: radar.probe_result(view(s, d, "fx_probe_attempts")).select("source_id", "attempt", "status", "http_code", "note"),
    "r6_collapse_attempts": _probe,
    "r8_source_lines": lambda s, d: radar.status_lines(_registry(s, d), _source_probe(s, d)),
    "r9_notes": lambda s, d: radar.status_notes(_registry(s, d), _source_probe(s, d)),
    "r10_stamp": lambda s, d: radar.stamp_probed(_registry(s, d), "2001-08-12").select("source_id", "last_probed"),
}
