"""The inventory in one call: landed responses of all protocols to rows of INVENTORY and a report of each source (K1, D9).

What a source's responses give is laid into one table of harvested rows, in which a row without an item tells what went wrong. Inventory and report are both read from
it, so every body is parsed once, whatever is asked of it afterwards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalume.operators import changes, inventory
from catalume.sources import parse, versions

# Where the rows of a list action lie, and transport errors after which what came before counts.
LISTS = {"package_search": "$.result.results", "package_list": "$.result", "current_package_list_with_resources": "$.result"}
TIMEOUTS = ("timeout", "connect_timeout")
HARVEST = "source_id string, action string, page int, failure string, item_id string, item_name string, item_slug string, title string, organization string, tags string, notes_excerpt string, ordinal int, issued string, modified string, landing_page string, distribution_url string, distribution_count int, format string, theme string"
REPORT = "source_id string, protocol string, status string, method string, row_count long, error string, reason string, warning string, package_search_error string, current_list_error string, rows_enriched long, rows_missing_metadata long, failed_page int, captured_at timestamp"


def _as_harvest(df: DataFrame, action: str | Column) -> DataFrame:
    fields = df.sparkSession.createDataFrame([], HARVEST).schema
    own = {"action": F.lit(action) if isinstance(action, str) else action}
    return df.select(*[own.get(f.name, F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields])


def _transport(responses: DataFrame) -> Column:
    """What kept a response from coming: its error, or its status."""
    return F.coalesce(F.col("error_class"), F.when(F.coalesce(F.col("status_code") >= 400, F.lit(True)), F.concat(F.lit("HTTP "), F.coalesce(F.col("status_code").cast("string"), F.lit("-")))))


def _ckan(responses: DataFrame) -> DataFrame:
    """Harvested rows of CKAN responses: of list actions one for each element, numbered through the pages, and one for each page that failed; of package_show one each."""
    docs = parse.with_doc(responses)
    out = []
    for action, path in LISTS.items():
        pages = parse.ckan_payload_status(docs.where(F.col("action") == action), path)
        later = (F.col("payload") == "no rows") & (F.col("page") > 1)  # a page behind the last one
        pages = pages.withColumn("failure", F.coalesce(_transport(pages), F.when((F.col("payload") != "ok") & ~later, F.col("payload"))))
        found = F.when(F.col("failure").isNull(), F.coalesce(F.try_variant_get("doc", path, "array<variant>"), F.array().cast("array<variant>")))
        rows = parse.numbered(pages.withColumn("found", found), F.col("found"), "page")
        if action == "package_list":
            name = F.try_variant_get("item", "$", "string")
            rows = rows.select("source_id", "page", "ordinal", name.alias("item_id"), name.alias("item_name"), name.alias("item_slug"))
        else:
            rows = parse.with_package(rows, "item").select("source_id", "page", "ordinal", *parse.package_columns())
        out += [_as_harvest(rows, action), _as_harvest(pages.where("failure is not null"), action)]
    shows = parse.ckan_payload_status(docs.where(F.col("action") == "package_show"))
    shows = parse.with_package(shows.withColumn("failure", F.coalesce(_transport(shows), F.when(F.col("payload") != "ok", F.col("payload")))).withColumn("item", F.try_variant_get("doc", "$.result", "variant")), "item", outer=True)
    failure = F.coalesce("failure", F.when(F.col("p").isNull(), "result is no package"))
    asked = F.col("item_id")  # stays the key, whatever id the package has
    out.append(_as_harvest(shows.select("source_id", "page", failure.alias("failure"), *parse.package_columns(asked)), "package_show"))
    return inventory.union_sources(*out)


def _sdmx(responses: DataFrame) -> DataFrame:
    bodies = parse.flow_lists(responses.withColumn("failure", _transport(responses)))
    bodies = bodies.withColumn("failure", F.coalesce("failure", F.when(F.col("corrupt"), "invalid XML")))
    rows = parse.numbered(bodies.where("failure is null"), F.col("flows"), "page").select("source_id", "page", *parse.flow_columns())
    return _as_harvest(rows, "dataflow").unionByName(_as_harvest(bodies.where("failure is not null"), "dataflow"))


def _sparql(responses: DataFrame) -> DataFrame:
    docs = parse.with_doc(responses)
    usable = F.try_variant_get("doc", "$.results.bindings", "array<variant>").isNotNull()
    failed = docs.withColumn("failure", F.coalesce(_transport(docs), F.when(F.col("doc").isNull(), "invalid JSON"), F.when(~usable, "no bindings"))).where("failure is not null")
    rows = parse.sparql_catalog(parse.group_bindings(parse.sparql_bindings(docs.where(usable & _transport(docs).isNull()))))
    return _as_harvest(rows, "sparql").unionByName(_as_harvest(failed, "sparql"))


PARSERS = {"ckan": _ckan, "sdmx": _sdmx, "sparql": _sparql}


def harvest(registry: DataFrame, responses: DataFrame) -> DataFrame:
    """HARVEST rows of responses (RESPONSES, perhaps with doc; pages of a list count from 1) of all inventoriable sources, each by the parser of its protocol. Registered protocols give rows of action `own`."""
    routed = inventory.route_sources(registry).where("status = 'inventoriable'").select("source_id", F.col("protocol").alias("routed_protocol"))
    action = F.substring_index(F.regexp_replace("url", r"[?#].*$", ""), "/", -1)
    df = responses.join(routed, "source_id").withColumn("action", action)
    of = lambda name: df.where(F.col("routed_protocol") == name).drop("routed_protocol")
    own = [_as_harvest(of(name).transform(parser), "own") for name, parser in inventory.PROTOCOLS.items() if name not in PARSERS]
    return inventory.union_sources(*[parser(of(name)) for name, parser in PARSERS.items()], *own)


def outcomes(rows: DataFrame, registry: DataFrame) -> DataFrame:
    """What each inventoriable source's harvested rows amount to: source_id, `way` (the actions whose rows count), from_page (pages of the current list from which on nothing counts), error, and what a warning says.

    CKAN goes by search, else by the list, which is overlaid with the current list or with a sample of packages. A current list that timed out after its first page counts up to there.
    """
    actions = (*LISTS, "package_show", "dataflow", "sparql", "own")
    of = lambda a: F.col("action") == a
    has = lambda a: F.count_if(of(a) & F.col("failure").isNull()).alias(f"n_{a}")
    first = lambda a: F.min(F.when(of(a) & F.col("failure").isNotNull(), F.struct("page", "failure"))).alias(f"f_{a}")
    seen = rows.groupBy("source_id").agg(*[has(a) for a in actions], *[first(a) for a in actions])
    settings = inventory.with_settings(inventory.route_sources(registry).where("status = 'inventoriable'")).select("source_id", "protocol", *inventory.SETTINGS)
    df = settings.join(seen, "source_id", "left")
    n, f = lambda a: F.coalesce(f"n_{a}", F.lit(0)), lambda a: F.col(f"f_{a}")
    said = lambda a: F.coalesce(f(a)["failure"], F.when(n(a) == 0, "no rows"))
    current = "current_package_list_with_resources"
    partial = f(current)["failure"].isin(*TIMEOUTS) & (f(current)["page"] > 1)
    usable = {"package_search": said("package_search").isNull() & ~F.col("skip_package_search"), "package_list": said("package_list").isNull(), current: (n(current) > 0) & (f(current).isNull() | F.coalesce(partial, F.lit(False)))}
    listed, ckan = usable["package_list"], F.col("protocol") == "ckan"
    search_error = F.when(F.col("skip_package_search"), "package_search skipped").otherwise(F.concat(F.lit("package_search: "), said("package_search")))
    way = F.when(usable["package_search"], F.array(F.lit("package_search"))).when(~listed, F.array().cast("array<string>")).when(F.col("skip_current_list"), F.when(F.col("package_show_sample"), F.array(F.lit("package_list"), F.lit("package_show"))).otherwise(F.array(F.lit("package_list")))).when(usable[current], F.array(F.lit("package_list"), F.lit(current))).otherwise(F.array(F.lit("package_list")))
    only = F.when(F.col("protocol") == "sdmx", "dataflow").when(F.col("protocol") == "sparql", "sparql").otherwise("own")
    failed = F.when(only == "dataflow", said("dataflow")).when(only == "sparql", said("sparql")).otherwise(F.when(n("own") == 0, "no rows"))
    out = df.withColumns({"ckan": ckan, "way": F.when(ckan, way).when(failed.isNull(), F.array(only)).otherwise(F.array().cast("array<string>"))})
    kind = F.when(~ckan | (F.size("way") == 0) | (F.col("way")[0] == "package_search"), None).when(F.col("skip_current_list") & F.col("package_show_sample"), "skip_current_package_list_with_package_show_sample").when(F.col("skip_current_list"), "skip_current_package_list").when(F.size("way") == 2, "fallback_current_package_list_with_resources").otherwise("fallback_package_list")
    error = F.when(ckan, F.when(F.size("way") == 0, F.concat(F.lit("package_list: "), said("package_list")))).otherwise(failed)
    shown = lambda *kinds: F.col("warning").isin(*kinds)
    return out.withColumns({"warning": kind, "error": error}).select(
        "source_id", "way", "error", "warning",
        F.when(F.array_contains("way", current) & F.coalesce(partial, F.lit(False)), f(current)["page"]).alias("failed_page"),
        F.when(shown("fallback_current_package_list_with_resources", "fallback_package_list"), search_error).alias("package_search_error"),
        F.when(shown("fallback_package_list"), F.concat(F.lit(f"{current}: "), said(current))).alias("current_list_error"),
    )


def items_of(rows: DataFrame, found: DataFrame, registry: DataFrame, captured_at: Column) -> tuple[DataFrame, DataFrame]:
    """Rows of INVENTORY by what outcomes() has found, and per source with an overlay how many rows it enriched and how many it did not."""
    keys, extra = ["source_id", "item_id"], F.col("action").isin("package_show", "current_package_list_with_resources")
    used = rows.where("failure is null and item_id is not null").join(found.where("size(way) > 0").select("source_id", "way", "failed_page"), "source_id")
    used = used.where(F.array_contains("way", F.col("action")) & (F.col("failed_page").isNull() | ~extra | (F.col("page") < F.col("failed_page")))).withColumn("over", extra).drop("way", "failed_page")
    own = [c for c in used.columns if c not in (*keys, "over", "ordinal", "page", "failure")]
    best = used.where("over").groupBy(*keys).agg(F.max_by(F.struct(*own), F.struct("page", "ordinal")).alias("e"))
    base = used.where("not over").join(best, keys, "left")
    items = base.select(*keys, "ordinal", *[F.when(F.col("e").isNotNull(), F.col(f"e.{c}")).otherwise(F.col(c)).alias(c) for c in own])
    protocol = registry.select("source_id", F.col("protocol").alias("p"))
    counts = base.groupBy("source_id").agg(F.count_if(F.col("e").isNull()).alias("rows_missing_metadata")).join(best.groupBy("source_id").agg(F.count("*").alias("rows_enriched")), "source_id", "left")
    df = items.join(protocol, "source_id")
    parts = [parse.inventory_rows(df.where(F.col("p") == name).drop("p"), registry, name, captured_at, F.col("action") if name == "ckan" else None) for name in PARSERS]
    others = df.where(~F.col("p").isin(*PARSERS)).drop("p")
    return inventory.union_sources(*parts, parse.inventory_rows(others, registry, "own", captured_at)), counts


def report_of(found: DataFrame, counts: DataFrame, items: DataFrame, registry: DataFrame, captured_at: Column) -> DataFrame:
    """REPORT rows of all watched sources: those that were harvested, those that failed, and those that are not inventoried, with the reason."""
    told = changes.full_report(inventory.route_sources(registry), items, found).drop("observed_method")
    more = found.join(counts, "source_id", "left").select("source_id", "package_search_error", "current_list_error", "failed_page", F.when(F.size("way") == 2, F.coalesce("rows_enriched", F.lit(0))).alias("rows_enriched"), F.when(F.size("way") == 2, F.col("rows_missing_metadata")).alias("rows_missing_metadata"))
    out = told.join(more, "source_id", "left").withColumn("captured_at", captured_at)
    fields = out.sparkSession.createDataFrame([], REPORT).schema
    return out.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields])


def build_inventory(spark: SparkSession, registry: DataFrame, responses: DataFrame, out_dir: str, captured_at: Column, only: list[str] | None = None, buckets: int = 64) -> tuple[DataFrame, DataFrame]:
    """Build the inventory of all sources of the registry, or of those in `only`, into versioned tables out_dir/inventory and out_dir/report; both as they are now.

    A rebuild of some sources replaces their rows and their part of the report, also where they have failed, and leaves all others. Nothing harvested at all is an error, and changes nothing.
    """
    if only is not None:
        registry, responses = inventory.only_sources(registry, only), inventory.only_sources(responses, only)
    harvest(registry, responses).write.mode("overwrite").parquet(f"{out_dir}/harvest")
    rows = spark.read.schema(HARVEST).parquet(f"{out_dir}/harvest")
    found = outcomes(rows, registry)
    items, counts = items_of(rows, found, registry, captured_at)
    items.write.mode("overwrite").parquet(f"{out_dir}/items")
    items = spark.read.schema(parse.INVENTORY).parquet(f"{out_dir}/items")
    if items.isEmpty():
        raise ValueError("no rows of any source were harvested")
    report = report_of(found, counts, items, registry, captured_at)
    for name, df, schema, keys in (("inventory", items, parse.INVENTORY, ("source_id",)), ("report", report, REPORT, ("source_id",))):
        path = f"{out_dir}/{name}"
        if versions.version(spark, path) is None:
            versions.create(spark.createDataFrame([], schema), path, keys, buckets if name == "inventory" else 1)
        gone = None if only is None else spark.createDataFrame([(x,) for x in only], "source_id string")
        keep = lambda old, new: new if gone is None else old.join(F.broadcast(gone), "source_id", "left_anti").unionByName(new)  # noqa: B023, E731
        versions.merge(spark, path, df, keep, touch=gone, whole=only is None)
    return versions.rows(spark, f"{out_dir}/inventory"), versions.rows(spark, f"{out_dir}/report")
