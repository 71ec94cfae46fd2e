"""Landed response bodies (JSON, XML, HTML) to rows, by non-raising built-in parsers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from catalume.functions.text import CKAN_ACTIONS, UNKNOWN, bound, ckan_api_base, ckan_endpoint, first_given, given, granularity, parse_int, sdmx_base, sdmx_flow_url, stripped, uri_name, year_max, year_min, years
from catalume.sources import walks

# Extensions in the order in which they are looked for.
HTML_FORMATS = ("csv", "json", "xlsx", "xls", "xml", "zip", "pdf")
HTML_BYTES = 200_000
PACKAGE = """struct<id string, name string, title string, author string, maintainer string, notes string, organization struct<title string, name string>, tags array<variant>,
groups array<struct<display_name string, name string>>, resources array<struct<url string, format string>>, extras array<struct<key string, value string>>>""".replace("\n", " ")


def with_doc(responses: DataFrame) -> DataFrame:
    """responses with `doc`, their body as VARIANT (null if it is no JSON), unless they were landed with it: what follows reads doc, so a body is parsed once."""
    return responses if "doc" in responses.columns else responses.withColumn("doc", F.try_parse_json(F.col("body")))


def land(responses: DataFrame, path: str) -> None:
    """Write responses with their bodies parsed, as with_doc gives them, where read_landed finds them."""
    with_doc(responses).write.parquet(path)


def ckan_payload_status(df: DataFrame, rows: str | None = None) -> DataFrame:
    """payload: ok, or why a body (content_type, body, perhaps doc) is not usable, with a preview. rows: the JSON path of a list that the body has to hold and that has to have rows."""
    df = df if "doc" in df.columns else with_doc(df)
    preview, doc = F.left(F.regexp_replace("body", r"\s+", " "), F.lit(200)), F.col("doc")
    success = F.try_variant_get(doc, "$.success", "boolean")
    status = F.when(~F.coalesce(F.lower("content_type").contains("json"), F.lit(False)), F.concat(F.lit("non-JSON response: "), preview)).when(doc.isNull(), F.concat(F.lit("invalid JSON: "), preview)).when(~F.coalesce(success, F.lit(False)), "success is false")
    if rows is not None:
        found = F.try_variant_get(doc, rows, "array<variant>")
        status = status.when(found.isNull(), "result is not a list").when(F.size(found) == 0, "no rows")
    return df.withColumn("payload", status.otherwise("ok"))


def _package(df: DataFrame) -> DataFrame:
    """df with the package of each usable body."""
    usable = ckan_payload_status(df)
    return with_package(usable.withColumn("package", F.when(F.col("payload") == "ok", F.col("doc"))), "package", "$.result")


def with_package(df: DataFrame, column: str, path: str = "$", outer: bool = False) -> DataFrame:
    """df with p, the package in a VARIANT column, and tag_names, the names of its tags; rows without a package go, unless outer.

    The package comes by explode and not by a filter, before which Spark would put all that the package is made from once more.
    """
    package = F.try_variant_get(column, path, PACKAGE)
    out = df.withColumn("p", package) if outer else df.select("*", F.explode(F.array_compact(F.array(package))).alias("p"))
    return out.withColumn("tag_names", tag_names(F.col("p.tags")))


def tag_names(tags: Column) -> Column:
    """Names of tags (VARIANT) that are strings, or objects with display_name or name."""
    of = lambda x, path: F.try_variant_get(x, path, "string")
    name = lambda x: F.when(F.schema_of_variant(x).startswith("OBJECT"), first_given(of(x, "$.display_name"), of(x, "$.name"))).when(F.schema_of_variant(x) == "STRING", given(stripped(of(x, "$"))))
    return F.filter(F.transform(tags, name), lambda x: x.isNotNull())


def package_columns(item_id: Column | None = None) -> list[Column]:
    """Columns of INVENTORY that a package (p, with tag_names) tells; item_id, if it is known otherwise."""
    p = F.col("p")
    return [(first_given(p["id"], p["name"]) if item_id is None else item_id).alias("item_id"), first_given(p["name"], p["id"]).alias("item_name"), given(p["name"]).alias("item_slug"), given(p["title"]).alias("title"), first_given(p["organization"]["title"], p["organization"]["name"], p["author"], p["maintainer"]).alias("organization"), F.array_join("tag_names", ", ").alias("tags"), F.left(stripped(p["notes"]), F.lit(300)).alias("notes_excerpt")]


def ckan_items(packages: DataFrame) -> DataFrame:
    """One inventory row per usable package body."""
    return _package(packages).select("source_id", *package_columns(), "ordinal")


def ckan_enrich(packages: DataFrame) -> DataFrame:
    """Per usable package: first http resource, combined text's granularity, years from extras, else from the text; and title, tags and notes (300 characters) as the package has them."""
    df, p = _package(packages), F.col("p")
    resource = F.get(F.filter(p["resources"], lambda r: r["url"].startswith("http")), F.lit(0))
    groups = F.array_join(F.filter(F.transform(p["groups"], lambda g: first_given(g["display_name"], g["name"])), lambda x: x.isNotNull()), " ")
    text = F.concat_ws(" ", given(p["title"]), groups, F.array_join("tag_names", " "), F.left(p["notes"], F.lit(500)))
    extra = lambda *keys: first_given(*[F.get(F.reverse(F.transform(F.filter(p["extras"], lambda e: e["key"] == k), lambda e: e["value"])), F.lit(0)) for k in keys])
    start, end = extra("temporal_coverage_from", "issued"), extra("temporal_coverage_to", "modified")
    said = lambda t: bound(years(t), lambda y: F.struct(granularity(t).alias("granularity"), F.array_min(y).alias("first"), F.array_max(y).alias("last")))
    texts = {"enriched_title": given(p["title"]), "enriched_tags": given(F.array_join("tag_names", ", ")), "enriched_notes": given(F.left(stripped(p["notes"]), F.lit(300)))}
    found = df.select("source_id", "item_id", given(resource["url"]).alias("resource_url"), given(resource["format"]).alias("resource_format"), bound(text, said).alias("said"), year_min(start).alias("start"), year_max(end).alias("end"), *[c.alias(name) for name, c in texts.items()])
    return found.select("source_id", "item_id", "resource_url", "resource_format", "said.granularity", F.coalesce("start", "said.first").alias("year_min"), F.coalesce("end", "said.last").alias("year_max"), F.lit("ckan_package_show").alias("enrich_method"), *texts)


def numbered(df: DataFrame, lists: Column, start: str | None) -> DataFrame:
    """source_id, start (if there is one), item and ordinal of each element of lists, numbered through a source in the order of start. Only the sizes of the lists meet by source, not the lists."""
    keys = ["source_id"] if start is None else ["source_id", start]
    rows = df.select(*keys, lists.alias("list"))
    sizes = rows.groupBy(*keys).agg(F.sum(F.greatest(F.size("list"), F.lit(0))).alias("n"))
    order = W.partitionBy("source_id").orderBy(*keys).rowsBetween(W.unboundedPreceding, -1)
    if start is None:
        return rows.select("source_id", F.posexplode("list").alias("at", "item")).select("source_id", "item", (F.col("at") + 1).cast("int").alias("ordinal"))
    before = sizes.select(*keys, F.coalesce(F.sum("n").over(order), F.lit(0)).alias("before"))
    return rows.select(*keys, F.posexplode("list").alias("at", "item")).join(before, keys).select(*keys, "item", (F.col("before") + F.col("at") + 1).cast("int").alias("ordinal"))


def _names(responses: DataFrame) -> Column:
    """Names of a list body, from its doc where it was landed with one."""
    return F.try_variant_get("doc", "$.result", "array<string>") if "doc" in responses.columns else F.from_json("body", "struct<result array<string>>")["result"]


def ckan_names(responses: DataFrame) -> DataFrame:
    """Rows of package_list bodies (source_id, body or doc, and start where a list comes in pages, each once): names in order, numbered through each source."""
    rows = numbered(responses, _names(responses), "start" if "start" in responses.columns else None)
    return rows.select("source_id", F.col("item").alias("item_id"), F.col("item").alias("item_name"), F.col("item").alias("item_slug"), "ordinal")


def merge_pages(pages: DataFrame, page_size: int) -> DataFrame:
    """Items of paged bodies (source_id, start, body): pages up to the first short one, numbered through."""
    df = pages.withColumn("ids", _names(pages))
    last = df.groupBy("source_id").agg(F.min(F.when(F.size("ids") < page_size, F.col("start"))).alias("last"))
    df = df.join(last, "source_id").where(F.col("last").isNull() | (F.col("start") <= F.col("last")))
    return numbered(df, F.col("ids"), "start").select("source_id", F.col("item").alias("item_id"), "ordinal")


#: Where the dataflows of a body lie: under the root, in SDMX 2.0 and in SDMX 2.1. A body that is no XML lies whole in _corrupt_record, so it need not be parsed to know that.
FLOW = "array<struct<_id string, Name array<string>>>"
FLOWS = f"struct<Dataflow {FLOW}, Dataflows struct<Dataflow {FLOW}>, Structures struct<Dataflows struct<Dataflow {FLOW}>>, _corrupt_record string>"


def flow_columns() -> list[Column]:
    return [F.col("item._id").alias("item_id"), F.col("item._id").alias("item_name"), given(stripped(F.get("item.Name", F.lit(0)))).alias("title"), "ordinal"]


def flow_lists(responses: DataFrame) -> DataFrame:
    """responses with flows, the dataflows of an XML body (null if it has none), and corrupt: whether it is no XML."""
    xml = responses.withColumn("s", F.from_xml("body", FLOWS, {"ignoreNamespace": "true", "nullValue": "\u0000", "mode": "PERMISSIVE"}))
    flows = F.flatten(F.array_compact(F.array("s.Dataflow", "s.Dataflows.Dataflow", "s.Structures.Dataflows.Dataflow")))
    return xml.withColumns({"corrupt": F.col("body").isNull() | F.col("s._corrupt_record").isNotNull(), "flows": flows}).drop("s")


def sdmx_items(responses: DataFrame) -> DataFrame:
    """Dataflows of XML bodies (source_id, body, and start where a list comes in several bodies, each once): id, own first name (null if it has none or an empty one), order through the source."""
    return numbered(flow_lists(responses).where("not corrupt"), F.col("flows"), "start" if "start" in responses.columns else None).select("source_id", *flow_columns())


def _keys(df: DataFrame) -> list[str]:
    return [c for c in ("source_id", "item_id") if c in df.columns]


def _usable_xml(responses: DataFrame, walk: Callable[..., list[str | None]], *arguments) -> DataFrame:
    """Responses with texts, what walk finds in a body: what is not 200 (where a status is there) or not XML counts as absent."""
    df = responses.where("status_code = 200") if "status_code" in responses.columns else responses
    return df.select("*", F.inline(walks.walked(F.col("body"), walk, *arguments)))


def sdmx_enrich(responses: DataFrame, observations: DataFrame | None = None) -> DataFrame:
    """Keywords and years of annotation bodies (item_id, body, perhaps source_id and status_code); where keywords hold no year, those of observation bodies of the same keys."""
    xml = _usable_xml(responses, walks.annotations, ("LAYOUT_DATAFLOW_KEYWORDS", "METADATA_URL")).withColumns({"raw": F.col("texts")[0], "meta": F.col("texts")[1]})
    raw, keys = F.col("raw"), _keys(responses)
    words = F.filter(F.transform(F.split(raw, "[+,]"), lambda x: F.lower(stripped(x))), lambda x: x != "")
    out = xml.select(*keys, F.array_join(F.slice(words, 1, 10), ", ").alias("tags"), F.left(raw, F.lit(300)).alias("notes"), granularity(F.coalesce(raw, F.lit(""))).alias("granularity"), year_min(raw).alias("year_min"), year_max(raw).alias("year_max"), given(F.col("meta")).alias("resource_url"), F.lit("SDMX").alias("resource_format"), F.lit("sdmx_dataflow_annotations").alias("enrich_method"))
    if observations is None:
        return out
    seen = sdmx_years(observations).groupBy(*keys).agg(F.min("year_min").alias("obs_min"), F.max("year_max").alias("obs_max"))
    none = F.col("year_min").isNull()
    return out.join(seen, keys, "left").withColumns({"year_min": F.when(none, F.col("obs_min")).otherwise(F.col("year_min")), "year_max": F.when(none, F.col("obs_max")).otherwise(F.col("year_max"))}).drop("obs_min", "obs_max")


def sdmx_years(responses: DataFrame) -> DataFrame:
    """First and last year of observation bodies (item_id, body): TIME_PERIOD as a key's value or as an attribute."""
    xml = _usable_xml(responses, walks.periods)
    text = F.array_join("texts", " ")
    return xml.withColumn("found", years(text)).select(*_keys(responses), F.array_min("found").alias("year_min"), F.array_max("found").alias("year_max"))


#: Column of flat bindings -> variables of result bodies, the first given one counts. Spark takes distributionURL and distributionUrl for one name, so they share a column.
BINDINGS = {"dataset": ["dataset"], "title": ["title"], "description": ["description"], "publisher": ["publisherName"], "issued": ["issued"], "modified": ["modified"], "landing_page": ["landingPage"], "distribution_count": ["distributionCount"], "distribution_url": ["distributionURL", "distributionUrl", "distribution_url"], "download_url": ["downloadURL"], "access_url": ["accessURL"], "distribution": ["distribution"], "format": ["format"], "theme": ["theme"]}


def sparql_bindings(responses: DataFrame) -> DataFrame:
    """Flat bindings of JSON result bodies (source_id, body), in order: a column per variable that group_bindings knows."""
    rows = F.from_json("body", "struct<results struct<bindings array<map<string, struct<value string>>>>>")["results"]["bindings"]
    value = lambda names: first_given(*[stripped(F.try_element_at("b", F.lit(x))["value"]) for x in names])
    df = responses.select("source_id", F.posexplode(rows).alias("at", "b")).select("source_id", (F.col("at") + 1).alias("pos"), *[value(names).alias(c) for c, names in BINDINGS.items()])
    return df.withColumn("distribution_count", parse_int(F.col("distribution_count")))


SINGLES, LISTS = ("title", "description", "publisher", "issued", "modified", "landing_page"), ("url", "format", "theme")


def group_bindings(bindings: DataFrame) -> DataFrame:
    """One state per dataset of flat bindings (source_id, pos and columns of BINDINGS, those that are not there count as null): first given values, lists without repeats in order.

    Bindings of a dataset that share url, format and theme are reduced to one row before they are sent anywhere, and these rows to lists by dataset: a dataset of many bindings and few
    values is small by the time it is gathered, and never gathered in one task before.
    """
    text = lambda c: given(stripped(F.col(c))) if c in bindings.columns else F.lit(None).cast("string")
    url = first_given(*[text(c) for c in ("distribution_url", "download_url", "access_url", "distribution")])
    singles = [c for c in SINGLES if c in bindings.columns]  # what is not there is not carried through the shuffles
    counts = [c for c in ("distribution_count",) if c in bindings.columns]
    flat = bindings.where("dataset is not null").select("source_id", "dataset", "pos", url.alias("url"), text("format").alias("format"), text("theme").alias("theme"), *counts, *[text(c).alias(c) for c in singles])
    first = lambda c: F.min(F.when(F.col(c).isNotNull(), F.struct("pos", F.col(c).alias("v")))).alias(c)
    alike = flat.groupBy("source_id", "dataset", *LISTS).agg(F.min("pos").alias("pos"), *[first(c) for c in (*singles, *counts)])
    unique = lambda c: F.array_distinct(F.transform(F.array_sort(F.collect_list(F.when(F.col(c).isNotNull(), F.struct("pos", F.col(c).alias("v"))))), lambda x: x["v"])).alias(f"{c}s")
    states = alike.groupBy("source_id", "dataset").agg(F.min("pos").alias("first_pos"), *[F.min(c)["v"].alias(c) for c in (*singles, *counts)], *[unique(c) for c in LISTS])
    blank = lambda c: F.lit(None).cast("int" if c == "distribution_count" else "string").alias(c)
    return states.select("source_id", "dataset", "first_pos", *[F.col(c) if c in (*singles, *counts) else blank(c) for c in (*SINGLES, "distribution_count")], *[f"{c}s" for c in LISTS])


def _item_columns() -> list[Column]:
    """Columns of an inventory row that a grouped state tells."""
    count = F.coalesce("distribution_count", F.when(F.size("urls") > 0, F.size("urls")))
    return [F.col("source_id"), F.col("dataset").alias("item_id"), uri_name(F.col("dataset")).alias("item_name"), F.col("title"), F.get("urls", F.lit(0)).alias("distribution_url"), count.alias("distribution_count"), given(F.array_join("formats", ", ")).alias("format"), given(F.array_join("themes", ", ")).alias("theme")]


def sparql_items(states: DataFrame) -> DataFrame:
    """Inventory rows of grouped states."""
    return states.select(*_item_columns())


def sparql_catalog(states: DataFrame) -> DataFrame:
    """sparql_items with publisher, description (300 characters), dates, landing page, and ordinals by first appearance; first_pos counts through a source, equal ones go by dataset.

    Ordinals are counted per range of first_pos and dataset, so that no task numbers a whole source.
    """
    rows = states.select(*_item_columns(), F.col("publisher").alias("organization"), F.left("description", F.lit(300)).alias("notes_excerpt"), "issued", "modified", "landing_page", "first_pos")
    span = F.floor(F.col("first_pos") / NUMBERED_TOGETHER)
    before = rows.groupBy("source_id", span.alias("span")).agg(F.count("*").alias("n"))
    before = before.select("source_id", "span", F.coalesce(F.sum("n").over(W.partitionBy("source_id").orderBy("span").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    rank = F.row_number().over(W.partitionBy("source_id", "span").orderBy("first_pos", "item_id"))
    return rows.withColumn("span", span).join(before, ["source_id", "span"]).withColumn("ordinal", (F.col("before") + rank).cast("int")).drop("span", "before", "first_pos")


def sparql_summary(bindings: DataFrame, registry: DataFrame | None = None) -> DataFrame:
    """Bindings and datasets per source; with a registry (source_id and perhaps sparql_query_name) also query_name, which is `custom` where none is named."""
    out = bindings.groupBy("source_id").agg(F.count("*").alias("n_bindings"), F.count_distinct("dataset").alias("n_datasets"))
    if registry is None:
        return out
    name = F.col("sparql_query_name") if "sparql_query_name" in registry.columns else F.lit(None).cast("string")
    return out.join(registry.select("source_id", name.alias("query_name")), "source_id", "left").withColumn("query_name", F.coalesce("query_name", F.lit("custom")))


#: Rows of a source whose ordinals one task counts.
NUMBERED_TOGETHER = 10_000
#: The table that all parsers of catalogs fill.
INVENTORY = """captured_at timestamp, source_id string, source_kind string, protocol string, inventory_method string, item_kind string, item_id string, item_name string, item_slug string, title string, organization string, tags string,
notes_excerpt string, source_url string, api_base_url string, ordinal int, issued string, modified string, landing_page string, distribution_url string, distribution_count int, format string, theme string""".replace("\n", " ")
# How items of a protocol were counted where the registry names no method, and what they are.
METHODS = {"ckan": "package_list", "sdmx": "dataflow_count", "sparql": "sparql_query"}
KINDS = {"ckan": "dataset", "sdmx": "dataflow", "sparql": "dataset"}


def with_registry(items: DataFrame, registry: DataFrame, *columns: str) -> DataFrame:
    """items with columns of the registry's row of their source; Spark broadcasts the registry as long as its size allows."""
    return items.join(registry.select("source_id", *columns), "source_id", "left")


def inventory_rows(items: DataFrame, registry: DataFrame, protocol: str, captured_at: Column, action: str | Column | None = None) -> DataFrame:
    """Rows of a parser as rows of INVENTORY: what the parser does not know is null, what the registry knows is filled in.

    action: the CKAN action that the rows come from, one for all or a column; package_list takes the baseline's method, others are their own.
    """
    need = [c for c in ("source_kind", "protocol", "base_url", "baseline_method", "sparql_endpoint") if c in registry.columns]
    url = F.col("base_url")
    # what follows from a source's URL alone is worked out per source, before its items are met
    addresses = {"own_base": ckan_api_base(url) if protocol == "ckan" else sdmx_base(url) if protocol == "sdmx" else F.lit(None).cast("string")}
    addresses |= {f"own_{x}": ckan_endpoint(url, x) for x in CKAN_ACTIONS} if protocol == "ckan" else {}
    df = with_registry(items.drop("source_kind", "protocol"), registry.withColumns(addresses), *need, *addresses)
    method = F.coalesce(given(F.col("baseline_method")), F.lit(METHODS.get(protocol)))
    by = F.lit(action or "package_list") if not isinstance(action, Column) else action
    method = F.when(by == "package_show", "package_show_sample").when(by != "package_list", by).otherwise(method) if protocol == "ckan" else method
    endpoint = F.coalesce(*[F.when(by == x, F.col(f"own_{x}")) for x in CKAN_ACTIONS]) if protocol == "ckan" else None
    own = {
        "captured_at": captured_at,
        "inventory_method": method,
        "item_kind": F.lit(KINDS.get(protocol)),
        "source_url": endpoint if protocol == "ckan" else first_given(F.col("sparql_endpoint"), url) if "sparql_endpoint" in need and protocol == "sparql" else url,
        "api_base_url": F.col("own_base"),
    }
    fields = df.sparkSession.createDataFrame([], INVENTORY).schema
    return df.select(*[own.get(f.name, F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields])


def html_format(pages: DataFrame) -> DataFrame:
    """Format of the first known kind of file that a page (page_id, url, status_code, html) links to."""
    failed = ~F.coalesce(F.col("url").startswith("http"), F.lit(False)) | (F.col("status_code") >= 400) | (F.octet_length("html") > HTML_BYTES)
    found = F.when(failed, None)
    for x in HTML_FORMATS:
        found = found.when(F.col("html").rlike(rf"(?i)href=[\"']([^\"']*\.{x})[\"']"), x.upper())
    return pages.select("page_id", F.when(failed, "html_scrape_failed").otherwise("html_scrape").alias("enrich_method"), found.alias("format"))


ENRICHED = "struct<resource_url string, resource_format string, granularity string, year_min int, year_max int, enrich_method string>"
ENRICHERS: dict = {}


def register_enricher(name: str, enricher) -> None:
    """enricher: DataFrame of items -> source_id, item_id (each item once at most) and a struct `enrich` of the fixed shape, tried before the built-in ones in the order of registration."""
    ENRICHERS[name] = enricher


def _blocked(registry: DataFrame) -> Column:
    """Whether a source is known to block scraping: a column of the registry, or a field of its struct `inventory`."""
    nested = registry.schema["inventory"].dataType.fieldNames() if "inventory" in registry.columns else []
    found = [F.col(x) for x in ("scraping_blocked",) if x in registry.columns] + [F.col(f"inventory.{x}") for x in ("scraping_blocked",) if x in nested]
    return F.coalesce(*found, F.lit(False)).alias("scraping_blocked")


def enrich_requests(items: DataFrame, registry: DataFrame) -> DataFrame:
    """source_id, item_id, kind (ckan, sdmx, html, blocked, none) and url: what has to be fetched first to enrich each item.

    Protocol and base_url of the registry win over the row's (protocol, source_url), its item_slug over its name, its api_base_url, if it is one, over the base_url. Columns that items lack count as null.
    """
    of = lambda name: F.col(f"i.{name}") if name in items.columns else F.lit(None).cast("string")
    df = items.alias("i").join(registry.select("source_id", "protocol", "base_url", _blocked(registry)).alias("r"), F.col("i.source_id") == F.col("r.source_id"), "left")
    protocol, base = first_given(F.col("r.protocol"), of("protocol")), first_given(F.col("r.base_url"), of("source_url"))
    name, own = first_given(stripped(of("item_slug")), of("item_name"), of("item_id")), of("api_base_url")
    api, landing = F.when(own.startswith("http"), own).otherwise(base), of("landing_page")
    known, page = base.isNotNull() & name.isNotNull(), F.coalesce(landing.startswith("http"), F.lit(False))
    kind = F.when((protocol == "ckan") & known, "ckan").when((protocol == "sdmx") & known, "sdmx").when(page, F.when(F.col("r.scraping_blocked"), "blocked").otherwise("html")).otherwise("none")
    url = F.when(F.col("kind") == "ckan", F.concat("api", F.lit("/package_show?id="), "name")).when(F.col("kind") == "sdmx", sdmx_flow_url(F.col("api"), F.col("name"))).when(F.col("kind") == "html", F.col("landing"))
    return df.select("i.source_id", "i.item_id", kind.alias("kind"), api.alias("api"), name.alias("name"), landing.alias("landing")).select("source_id", "item_id", "kind", url.alias("url"))


def of_protocol(rows: DataFrame, registry: DataFrame, protocol: str) -> DataFrame:
    """rows of sources that the registry does not give another protocol, for no others can enrich an item: so the dispatch need not parse the bodies of those."""
    others = registry.where(given(F.col("protocol")) != protocol).select("source_id")
    return rows.join(others, "source_id", "left_anti")


def enrich(items: DataFrame, registry: DataFrame, ckan: DataFrame, html: DataFrame, sdmx: DataFrame | None = None) -> DataFrame:
    """Each item with the first of its enrichments that is there: registered ones, CKAN, SDMX, a blocked source, HTML, none.

    All enrichments are laid one under the other with their rank and meet the items in one aggregation by key, however many there are; only pages that know no source are joined first. Rows are dealt out by
    key before they are aggregated: hardly two of them share a key and kind, so aggregating before would sort all rows once more and make nothing smaller.
    """
    fields = items.sparkSession.createDataFrame([], f"e {ENRICHED}").schema["e"].dataType
    keys, protocols = ["source_id", "item_id"], [p for p, t in (("ckan", ckan), ("sdmx", sdmx)) if t is not None]
    r = registry.select("source_id", given(F.col("protocol")).alias("registry_protocol"), _blocked(registry))
    df = items.join(r, "source_id", "left")
    if "protocol" in items.columns:  # the registry's wins over the row's
        df = df.withColumn("registry_protocol", F.coalesce("registry_protocol", "protocol"))
    page = F.coalesce(F.col("landing_page").startswith("http"), F.lit(False))
    scraped = html.select(*_keys(html), F.lit("html").alias("kind"), F.struct(F.lit(None).cast("string").alias("resource_url"), F.col("format").alias("resource_format"), F.lit(UNKNOWN).alias("granularity"), F.lit(None).cast("int").alias("year_min"), F.lit(None).cast("int").alias("year_max"), "enrich_method").cast(fields).alias("e"))
    if "source_id" not in html.columns:
        scraped = items.select(*keys).join(scraped, "item_id")  # items that repeat do no harm
    rows = [df.select(*keys, F.lit("item").alias("kind"), F.lit(None).cast(fields).alias("e"), "registry_protocol", page.alias("page"), F.coalesce("scraping_blocked", F.lit(False)).alias("blocked")), scraped.select(*keys, "kind", "e")]
    for k, (name, enricher) in enumerate(ENRICHERS.items()):
        extra = own_enrichment(items, name, enricher)
        rows.append(extra.select(*keys, F.lit(f"own {k}").alias("kind"), F.col("enrich").alias("e")))
    rows += [t.select(*keys, F.lit(p).alias("kind"), F.struct(*fields.fieldNames()).cast(fields).alias("e")) for p, t in (("ckan", ckan), ("sdmx", sdmx)) if t is not None]
    both = rows[0]
    for more in rows[1:]:
        both = both.unionByName(more, allowMissingColumns=True)
    of = lambda kind: F.max(F.when(F.col("kind") == kind, F.col("e"))).alias(kind)
    own = [f"own {k}" for k in range(len(ENRICHERS))]
    met = both.repartition(*keys).groupBy(*keys).agg(F.count_if(F.col("kind") == "item").alias("n"), F.max("registry_protocol").alias("protocol"), F.max("page").alias("page"), F.max("blocked").alias("blocked"), *[of(k) for k in (*own, *protocols, "html")])
    best = _first_of([F.col(f"`{k}`") for k in own], {p: F.col(p) for p in protocols}, F.col("html"), fields)
    return met.where("n > 0").select(*keys, F.explode(F.array_repeat(best, F.col("n").cast("int"))).alias("enrich"))


def _first_of(own: list[Column], protocols: dict[str, Column], html: Column, fields: StructType) -> Column:
    """The first of an item's enrichments that is there, in a row with protocol, page (whether it has a landing page) and blocked."""
    nothing = lambda name: F.struct(*[(F.lit({"granularity": UNKNOWN, "enrich_method": name}.get(c)).cast(fields[c].dataType)).alias(c) for c in fields.fieldNames()])
    return F.coalesce(*own, *[F.when(F.col("protocol") == p, c) for p, c in protocols.items()], F.when(F.col("page") & F.col("blocked"), nothing("scraping_blocked")), F.when(F.col("page"), html), nothing("none"))


def own_enrichment(items: DataFrame, name: str, enricher: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What a registered enricher gives, if it has the fixed shape."""
    fields = items.sparkSession.createDataFrame([], f"e {ENRICHED}").schema["e"].dataType
    extra = items.transform(enricher)
    if (shape := extra.schema["enrich"].dataType.simpleString()) != fields.simpleString():
        raise ValueError(f"enricher {name} gives {shape}, not {fields.simpleString()}")
    return extra


def chosen(items: DataFrame, registry: DataFrame, own: list[str], protocols: dict[str, Column], html: Column) -> DataFrame:
    """items with e, the enrichment that enrich() would choose, where all that there are lie in the item's own row."""
    fields = items.sparkSession.createDataFrame([], f"e {ENRICHED}").schema["e"].dataType
    shaped = lambda c: F.when(c.isNotNull(), F.struct(*[c[x].alias(x) for x in fields.fieldNames()])).cast(fields)
    r = registry.select("source_id", given(F.col("protocol")).alias("registry_protocol"), _blocked(registry).alias("registry_blocked"))
    df = items.join(r, "source_id", "left")
    protocol = F.coalesce("registry_protocol", "protocol") if "protocol" in items.columns else F.col("registry_protocol")
    page = F.coalesce(F.col("landing_page").startswith("http"), F.lit(False))
    df = df.withColumns({"protocol": protocol, "page": page, "blocked": F.coalesce("registry_blocked", F.lit(False))})
    return df.withColumn("e", _first_of([F.col(f"`{k}`") for k in own], {p: shaped(c) for p, c in protocols.items()}, shaped(html), fields))
