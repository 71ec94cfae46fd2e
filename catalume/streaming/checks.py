"""Source checks as a stream: landed responses are kept by kind, parsed and scored as they come, and upserted into the table of checks (J1, D5).

Two tables of `sources.versions` stand behind it: what the last response of each kind told of every item, which is the state between batches, and the
checks. A batch parses its responses, merges what they tell into the first, takes all that is known of the items that it touches, and merges their checks
into the second. As both merges go by time and rewrite only the buckets they touch, the checks follow from which responses have landed, not from how
they were split into files or in which order they came, and a batch that is repeated after a failure does no harm.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalume.functions.text import UNKNOWN
from catalume.operators import inventory
from catalume.operators.check import CHECK_RESULT, finished, with_url
from catalume.sources import parse, versions
from catalume.sources.tables import CHECKS, RESPONSES

#: Responses of an item count as one check if they lie no further before its last one.
ONE_CHECK = "1 day"
BUCKETS = 64
#: What may be known of an item, and the last response of each kind: what orders responses, its body as a hash at the end, and what the body told.
KINDS = ("head", "ckan", "notes", "seen", "page")
FOUND = "struct<resource_url string, resource_format string, granularity string, year_min int, year_max int, enrich_method string, enriched_title string, enriched_tags string, enriched_notes string>"
LAST = f"struct<said struct<fetched_at timestamp, method string, url string, page int, status_code int, content_type string, error_class string, rest long>, found {FOUND}>"
STATE = f"source_id string, item_id string, {', '.join(f'{k} {LAST}' for k in KINDS)}"


def with_kind(responses: DataFrame, registry: DataFrame) -> DataFrame:
    """RESPONSES with kind: HEAD tells whether an item is reachable; among GETs, URLs with package_show are CKAN packages, those with /data/ of an SDMX source
    observations, other URLs of an SDMX source with /dataflow annotations, and all others landing pages."""
    url, sdmx = F.coalesce("url", F.lit("")), F.coalesce(F.col("protocol") == "sdmx", F.lit(False))
    kind = F.when(F.upper("method") == "HEAD", "head").when(url.contains("package_show"), "ckan").when(sdmx & url.contains("/data/"), "seen").when(sdmx & url.contains("/dataflow"), "notes").otherwise("page")
    return parse.with_registry(responses, registry, "protocol").withColumn("kind", kind).drop("protocol")


def findings(landed: DataFrame) -> DataFrame:
    """What each response of with_kind tells: source_id, item_id and a column for each kind, of which one has a LAST. Every response has a row without `found`, and one more with it if its body is of use; so each body is parsed once, and none is kept."""
    said = F.struct("fetched_at", F.upper("method").alias("method"), "url", "page", "status_code", "content_type", "error_class", F.xxhash64(F.array_sort(F.map_entries("headers")), "body").alias("rest"))
    keys, rows = ["source_id", "item_id"], landed.where("source_id is not null and item_id is not null").withColumn("said", said)
    of = lambda k: rows.where(F.col("kind") == k).withColumn("item_id", F.struct("item_id", "said"))
    text = lambda c: F.lit(None).cast("string").alias(c)
    unknown = [F.lit(None).cast("int").alias(c) for c in ("year_min", "year_max")]
    pages = parse.html_format(of("page").select(F.struct(*keys).alias("page_id"), "url", "status_code", F.col("body").alias("html")))
    enriched = {
        "page": pages.select("page_id.*", text("resource_url"), F.col("format").alias("resource_format"), F.lit(UNKNOWN).alias("granularity"), *unknown, "enrich_method"),
        "ckan": parse.ckan_enrich(of("ckan").where("status_code = 200")),
        "notes": parse.sdmx_enrich(of("notes")).drop("tags", "notes"),
        "seen": parse.sdmx_years(of("seen")),
    }
    fields = rows.sparkSession.createDataFrame([], f"found {FOUND}").schema["found"].dataType
    all_of = lambda df: F.struct(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields])
    parsed = [df.select("source_id", "item_id.item_id", F.lit(kind).alias("kind"), "item_id.said", all_of(df).alias("found")) for kind, df in enriched.items()]
    both = inventory.union_sources(rows.select(*keys, "kind", "said", F.lit(None).cast(fields).alias("found")), *parsed)
    return both.select(*keys, *[F.when(F.col("kind") == k, F.struct("said", "found")).cast(LAST).alias(k) for k in KINDS])


def last_of_kind(*found: DataFrame) -> DataFrame:
    """A row an item with the last response of each kind (of findings, or of earlier last_of_kind); of equal times the greatest, so that it does not depend on their order. Rows are dealt out by key before they are sorted, once."""
    keys = ["source_id", "item_id"]
    return inventory.union_sources(*found).repartition(*keys).groupBy(*keys).agg(*[F.max(k).alias(k) for k in KINDS])


def check_kinds(last: DataFrame, items: DataFrame, registry: DataFrame, window: str = ONE_CHECK) -> DataFrame:
    """Rows of CHECK_RESULT of the items that `last` (of last_of_kind) tells of, by C6 to C16, stamped with the time of their last response. What was fetched more than window before it is of an earlier check and does not count.

    All that is known of an item lies in one row, so it meets the items once, and nothing else but the registry and registered enrichers.
    """
    keys = ["source_id", "item_id"]
    at = F.col("checked_at")
    used = lambda k: F.when(at.isNull() | (F.col(f"{k}.said.fetched_at") >= at - F.expr(f"interval {window}")), F.col(k))
    times = last.withColumn("checked_at", F.greatest(*[F.col(f"{k}.said.fetched_at") for k in KINDS])).select(*keys, "checked_at", F.struct(*[used(k).alias(k) for k in KINDS]).alias("known"))
    own = items.drop("reachable", "enrich_method", "granularity", "year_min", "year_max", "checked_at", "known")
    own = own.withColumns({c: F.lit(None).cast("string") for c in ("landing_page", "distribution_url") if c not in own.columns})
    touched = times.join(own, keys, "left")
    df = touched
    for k, (name, enricher) in enumerate(parse.ENRICHERS.items()):
        df = df.join(parse.own_enrichment(touched.drop("known"), name, enricher).select(*keys, F.col("enrich").alias(f"own {k}")), keys, "left")
    of = lambda k: F.col(f"known.{k}.found")
    none = of("notes")["year_min"].isNull()
    year = lambda c: F.when(none, of("seen")[c]).otherwise(of("notes")[c])
    sdmx = F.when(of("notes").isNotNull(), of("notes").withField("year_min", year("year_min")).withField("year_max", year("year_max")))
    enrich = parse.chosen(df, registry, [f"own {k}" for k in range(len(parse.ENRICHERS))], {"ckan": of("ckan"), "sdmx": sdmx}, of("page"))
    mine = F.col("e.enrich_method") == "ckan_package_show"
    texts = F.col("e").withField("enriched_title", F.when(mine, of("ckan")["enriched_title"])).withField("enriched_tags", F.when(mine, of("ckan")["enriched_tags"])).withField("enriched_notes", F.when(mine, of("ckan")["enriched_notes"]))
    df = enrich.withColumn("e", texts)
    df = df.select(*keys, "checked_at", *[c for c in own.columns if c not in (*keys, "status_code", "error_class", "e", "url")], "e", F.col("known.head.said.status_code").alias("status_code"), F.col("known.head.said.error_class").alias("error_class"))
    return finished(with_url(df), own.columns)


def check_responses(responses: DataFrame, items: DataFrame, registry: DataFrame, window: str = ONE_CHECK) -> DataFrame:
    """CHECK_RESULT rows of the items that responses (RESPONSES) are of."""
    return check_kinds(last_of_kind(findings(with_kind(responses, registry))), items, registry, window)


def _incoming(keys: tuple[str, ...], columns: list[str]) -> Callable[[DataFrame, DataFrame], DataFrame]:
    """Merging of checks: the latest of each key stays; of equal times that of the batch, which knows more."""
    return lambda old, new: versions.newest_row(old, new, keys, F.col("check_timestamp"), columns)


def _seen() -> dict[str, Column]:
    """What a merge of checks observes of the rows that it writes."""
    return {f"n_{c}": F.count_if(F.coalesce(c, F.lit(False))) for c in ("reachable", "needs_review", "intake_candidate")}


def _table(spark: SparkSession, path: str, keys: tuple[str, ...], schema: str, start: DataFrame | None, buckets: int) -> None:
    """Create the table, with the rows of start, unless it is there."""
    if versions.version(spark, path) is None:
        fields = spark.createDataFrame([], schema)
        versions.create(fields if start is None else fields.unionByName(start, allowMissingColumns=True).select(*fields.columns), path, keys, buckets)


def _run(spark: SparkSession, in_dir: str, schema: str, checkpoint: str, upsert: Callable[[DataFrame, int], None], files: int | None) -> None:
    source = spark.readStream.schema(schema)
    source = source if files is None else source.option("maxFilesPerTrigger", files)
    query = source.parquet(in_dir).writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def stream_responses(spark: SparkSession, in_dir: str, out_dir: str, checkpoint: str, items: DataFrame, registry: DataFrame, start: DataFrame | None = None, keys: tuple[str, ...] = ("source_id", "item_id"), window: str = ONE_CHECK, buckets: int = BUCKETS, files: int | None = None) -> DataFrame:
    """Work off the RESPONSES that have landed in in_dir and stop: the table of checks (CHECK_RESULT, one row a key). start: earlier checks, used where there is no table yet.

    Responses of a check may land in any files, in any order. files: how many of them a batch takes at most. Without anything new the table stays as it is. The checkpoint names the stream, and with it which batches are in the tables.
    """
    state, checks = f"{out_dir}/responses", f"{out_dir}/checks"
    _table(spark, state, ("source_id", "item_id"), STATE, None, buckets)
    _table(spark, checks, keys, CHECK_RESULT, start, buckets)

    def upsert(batch: DataFrame, n: int) -> None:
        v = versions.merge(spark, state, findings(with_kind(batch, registry)), last_of_kind, checkpoint, n)
        touched = batch.select("source_id", "item_id").distinct()
        where = [r["b"] for r in touched.select(versions.bucket_of(v).alias("b")).distinct().collect()]  # at most `buckets`
        known = versions.rows(spark, state, v.number, where).join(touched, ["source_id", "item_id"], "left_semi")
        done = check_kinds(known, items, registry, window)
        versions.merge(spark, checks, done, _incoming(keys, done.columns), checkpoint, n, _seen())

    _run(spark, in_dir, RESPONSES, checkpoint, upsert, files)
    return versions.rows(spark, checks)


def stream_checks(spark: SparkSession, in_dir: str, out_dir: str, checkpoint: str, start: DataFrame | None = None, keys: tuple[str, ...] = ("item_id",), buckets: int = BUCKETS, files: int | None = None) -> DataFrame:
    """Work off the CHECKS that have landed in in_dir and stop: the table of checks, of which the latest of each key stays, whatever the order of arrival. start: as in stream_responses."""
    _table(spark, out_dir, keys, CHECKS, start, buckets)
    columns = spark.createDataFrame([], CHECKS).columns
    _run(spark, in_dir, CHECKS, checkpoint, lambda batch, n: versions.merge(spark, out_dir, batch, _incoming(keys, columns), checkpoint, n) and None, files)
    return versions.rows(spark, out_dir)
