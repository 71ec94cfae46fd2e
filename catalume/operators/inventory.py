"""The item inventory: routing of sources, filters, limits, samples, overlays, rebuilds."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from catalume.functions.text import given
from catalume.sources import parse

PROTOCOLS: dict[str, Callable[[DataFrame], DataFrame]] = {"ckan": parse.ckan_names, "sdmx": parse.sdmx_items, "sparql": lambda x: parse.sparql_items(parse.group_bindings(parse.sparql_bindings(x)))}


def register_protocol(name: str, parser: Callable[[DataFrame], DataFrame]) -> None:
    """Let sources of a protocol count as inventoriable, parsed from landed responses by parser."""
    PROTOCOLS[name] = parser


def route_sources(registry: DataFrame) -> DataFrame:
    """Watched catalogs with status and reason: which can be inventoried, and why others cannot."""
    watched = registry.where((F.col("source_kind") == "catalog") & (F.col("observation_mode") == "catalog-watch"))
    supported = F.col("protocol").isin(*PROTOCOLS)
    status = F.when(F.col("non_inventoriable"), "non_inventariabile").when(~supported, "protocol_not_supported").otherwise("inventoriable")
    own = given(F.col("reason")) if "reason" in registry.columns else F.lit(None).cast("string")
    # Reasons where the registry gives none.
    reason = F.when(status == "non_inventariabile", F.coalesce(own, F.lit("Fonte non inventariabile."))).when(status == "protocol_not_supported", F.format_string("Protocollo %s non ancora supportato dal builder inventory.", "protocol"))
    return watched.withColumn("status", status).withColumn("reason", reason)


#: Settings of a source's inventory and what they are where the registry is silent.
SETTINGS = {"non_inventoriable": False, "skip_package_search": False, "skip_current_list": False, "package_show_sample": False, "sample_size": 25}


def inventory_setting(registry: DataFrame, name: str, default=None) -> Column:
    """A setting of the registry (a column of it, or a field of its struct `inventory`), or else its default."""
    default = F.lit(SETTINGS[name] if default is None else default)
    nested = registry.schema["inventory"].dataType.fieldNames() if "inventory" in registry.columns else []
    found = F.col(f"inventory.{name}") if name in nested else F.col(name) if name in registry.columns else None
    return (default if found is None else F.coalesce(found, default)).alias(name)


def with_settings(registry: DataFrame) -> DataFrame:
    """registry with all SETTINGS as columns."""
    return registry.withColumns({name: inventory_setting(registry, name) for name in SETTINGS})


def parsed_inventory(registry: DataFrame, responses: DataFrame) -> DataFrame:
    """Inventory rows of landed responses of all inventoriable sources, each by the parser of its source's protocol."""
    routed = route_sources(registry).where("status = 'inventoriable'").select("source_id", F.col("protocol").alias("routed_protocol"))
    df = responses.join(routed, "source_id")
    return union_sources(*[df.where(F.col("routed_protocol") == name).drop("routed_protocol").transform(parser) for name, parser in PROTOCOLS.items()])


def only_sources(items: DataFrame, ids: list[str] | DataFrame) -> DataFrame:
    """Rows of the sources in ids: a list, which reaches the scan as a filter, or a table (source_id) of any size."""
    return items.where(F.col("source_id").isin(*ids)) if isinstance(ids, list) else items.join(ids.select("source_id"), "source_id", "left_semi")


def with_url(items: DataFrame) -> DataFrame:
    return items.where(F.col("landing_page").isNotNull() | F.col("distribution_url").isNotNull())


def with_title(items: DataFrame) -> DataFrame:
    return items.where(F.col("title").isNotNull())


def limit_per_source(items: DataFrame, n: int) -> DataFrame:
    rank = F.row_number().over(W.partitionBy("source_id").orderBy("ordinal", "item_id"))
    return items.withColumn("rank", rank).where(F.col("rank") <= n).drop("rank")


def first_n(items: DataFrame, n: int) -> DataFrame:
    return items.orderBy("source_id", "ordinal", "item_id").limit(n)


def systematic_sample(items: DataFrame, size: int) -> DataFrame:
    """Both ends of each source and every step-th item between, about `size` in all; ordinals count from 1."""
    n, i = F.col("n_items"), F.col("ordinal") - 1
    step = F.greatest(F.floor(n / size), F.lit(1)) if size > 0 else F.lit(1)
    kept = (n <= size) | (i == 0) | (i == n - 1) | ((i % step == 0) & (F.floor(i / step) <= size - 2))
    counts = items.groupBy("source_id").agg(F.count("*").alias("n_items"))
    return items.join(counts, "source_id").where(kept & F.lit(size > 0)).drop("n_items")


def overlay(base: DataFrame, enriched: DataFrame, keys: list[str]) -> DataFrame:
    """base with the columns of the enriched row of the same key, nulls included; the ordinal stays. matched tells which. Of rows that repeat a key the one with the highest ordinal counts."""
    own = [c for c in enriched.columns if c not in keys and c in base.columns and c != "ordinal"]
    one = enriched.groupBy(*keys).agg(F.max_by(F.struct(*own), F.col("ordinal")).alias("e"))
    out = base.join(one, keys, "left")
    matched = F.col("e").isNotNull()
    return out.select(*[F.when(matched, F.col(f"e.{c}")).otherwise(F.col(c)).alias(c) if c in own else F.col(c) for c in base.columns], matched.alias("matched"))


def method_fallback(search: DataFrame, names: DataFrame, current: DataFrame, shows: DataFrame, registry: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Items by the best harvest that is usable per CKAN source, with method, and a report per source (source_id, method, error, warning).

    The harvests are rows of items (source_id, item_id, ordinal, ...), with `usable` false (and no item_id) in a row that tells of a failure. A source's harvest counts as usable
    if it has rows and none is false. registry: source_id, skip_current_list and perhaps skip_package_search. Search, else the list: overlaid with shows if skip_current_list and
    there are some, with current if that is usable, else bare. No usable list: an error, no items.
    """
    r = registry
    for name, df in (("search", search), ("names", names), ("current", current), ("shows", shows)):
        r = r.join(df.groupBy("source_id").agg((~F.bool_or(~F.coalesce("usable", F.lit(True)))).alias(name)), "source_id", "left").withColumn(name, F.coalesce(name, F.lit(False)))
    skip = F.coalesce("skip_current_list", F.lit(False))
    off = F.coalesce("skip_package_search", F.lit(False)) if "skip_package_search" in registry.columns else F.lit(False)
    method = F.when(F.col("search") & ~off, "package_search").when(~F.col("names"), None).when(skip & F.col("shows"), "package_list+package_show").when(skip | ~F.col("current"), "package_list").otherwise("package_list+current_list")
    r = r.withColumn("method", method)
    kind = F.when(F.col("method").isNull() | (F.col("method") == "package_search"), None).when(skip & F.col("shows"), "skip_current_package_list_with_package_show_sample").when(skip, "skip_current_package_list").when(F.col("current"), "fallback_current_package_list_with_resources").otherwise("fallback_package_list")
    way = r.select("source_id", "method")
    of = lambda df, *methods: df.where("item_id is not null").drop("usable").join(way.where(F.col("method").isin(*methods)), "source_id")
    keys = ["source_id", "item_id"]
    over = lambda extra, m: overlay(of(names, m), extra.where("item_id is not null").drop("usable"), keys)
    items = union_sources(of(search, "package_search"), of(names, "package_list"), over(current, "package_list+current_list"), over(shows, "package_list+package_show"))
    matched = items.groupBy("source_id").agg(F.count_if("matched").alias("rows_enriched"), F.count_if(~F.col("matched")).alias("rows_missing_metadata"))
    why = F.when(off, "package_search skipped").otherwise("package_search failed")
    warning = F.when(kind.isNotNull(), F.struct(kind.alias("type"), why.alias("package_search_error"), F.when(F.col("method").contains("+"), F.col("rows_enriched")).alias("rows_enriched"), F.when(F.col("method").contains("+"), F.col("rows_missing_metadata")).alias("rows_missing_metadata")))
    report = r.join(matched, "source_id", "left").select("source_id", "method", F.when(F.col("method").isNull(), "package_list unusable").alias("error"), warning.alias("warning"))
    return items.drop("matched"), report


def overlay_counts(base: DataFrame, enriched: DataFrame) -> DataFrame:
    """Per source: distinct enriched ids, and base rows without one."""
    hits = enriched.select("source_id", "item_id").distinct()
    rows = base.join(hits.withColumn("hit", F.lit(1)), ["source_id", "item_id"], "left").groupBy("source_id").agg(F.count_if(F.col("hit").isNull()).alias("rows_missing_metadata"))
    return rows.join(hits.groupBy("source_id").agg(F.count("*").alias("rows_enriched")), "source_id", "left").select("source_id", F.coalesce("rows_enriched", F.lit(0)).alias("rows_enriched"), "rows_missing_metadata")


def replace_sources(old: DataFrame, new: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of new, and rows of old whose source is not in ids (source_id)."""
    return old.join(ids.select("source_id").distinct(), "source_id", "left_anti").unionByName(new, allowMissingColumns=True)


def union_sources(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def inventory_profile(items: DataFrame, *by: str) -> DataFrame:
    return items.groupBy(*by).agg(F.count("*").alias("n_items"))


def partial_harvest(attempts: DataFrame) -> DataFrame:
    """Attempts (source_id, position, step, ok, n_rows): rows before the first position at which no step succeeded, and that position."""
    per = attempts.groupBy("source_id", "position").agg(F.bool_or("ok").alias("ok"), F.max(F.when(F.col("ok"), F.col("n_rows"))).alias("n_rows"), F.max("step").alias("last_step"))
    failed = per.where(~F.col("ok")).groupBy("source_id").agg(F.min_by(F.struct("position", "last_step"), "position").alias("f"))
    joined = per.join(failed, "source_id", "left")
    before = F.col("f").isNull() | (F.col("position") < F.col("f.position"))
    out = joined.groupBy("source_id").agg(F.coalesce(F.sum(F.when(before, F.col("n_rows"))), F.lit(0)).cast("long").alias("rows_collected"), F.max("f.position").alias("failed_offset"), F.max("f.last_step").alias("failed_limit"))
    return out.withColumn("status", F.when(F.col("failed_offset").isNull(), "ok").when(F.col("rows_collected") > 0, "partial").otherwise("error"))


def harvest_warning(attempts: DataFrame) -> DataFrame:
    """partial_harvest with `warning` (type, failed_offset, failed_limit, rows_collected, failure) where a harvest is partial. attempts: as there, with limit (100, 50 or 10, say) and failure of a step."""
    last = attempts.where(~F.coalesce("ok", F.lit(False))).groupBy("source_id", F.col("position").alias("failed_offset")).agg(F.max_by(F.struct("limit", "failure"), F.struct("step", "limit")).alias("last"))
    out = partial_harvest(attempts).drop("failed_limit").join(last, ["source_id", "failed_offset"], "left")
    warning = F.struct(F.lit("partial_current_package_list_with_resources").alias("type"), "failed_offset", F.col("last.limit").alias("failed_limit"), "rows_collected", F.col("last.failure").alias("failure"))
    return out.select("source_id", "status", "rows_collected", F.when(F.col("status") == "partial", warning).alias("warning"))


def sample_warning(errors: DataFrame, enriched: DataFrame, sampled: DataFrame, order: Column, message: Column) -> DataFrame:
    """Per source with errors in a sample: type, sample_size, rows_enriched, n_errors and the first messages."""
    sizes = sampled.groupBy("source_id").agg(F.count("*").alias("sample_size"))
    rich = enriched.groupBy("source_id").agg(F.count("*").alias("rows_enriched"))
    out = error_preview(errors, order, message).join(sizes, "source_id", "left").join(rich, "source_id", "left")
    return out.select("source_id", F.lit("package_show_sample_partial").alias("type"), F.coalesce("sample_size", F.lit(0)).alias("sample_size"), F.coalesce("rows_enriched", F.lit(0)).alias("rows_enriched"), "n_errors", "messages")


def error_preview(errors: DataFrame, order: Column, message: Column, n: int = 10) -> DataFrame:
    """Per source the number of errors and the first n messages; each task keeps no more than n a source."""
    ranked = errors.withColumn("rank", F.row_number().over(W.partitionBy("source_id").orderBy(order)))
    first = ranked.where(F.col("rank") <= n).groupBy("source_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", message.alias("m")))), lambda x: x["m"]), "; ").alias("messages"))
    return errors.groupBy("source_id").agg(F.count("*").alias("n_errors")).join(first, "source_id")
