"""Source checks: inference, scoring, incremental planning and upserts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from catalume.functions.text import UNKNOWN, first_given, given, granularity, norm_format, year_max, year_min

# Points of the intake score.
GRANULARITY_POINTS = {"comune": 40, "provincia": 30, "regione": 20, "nazionale": 10, "europeo": 5}
FORMAT_POINTS = {"CSV": 20, "JSON": 20, "XLSX": 12, "XLS": 10, "XML": 8, "SDMX": 8, "PDF": 2}
RICH_METHODS = ("ckan_package_show", "sdmx_dataflow_annotations")
CANDIDATE = 40


def points(value: Column, table: dict[str, int]) -> Column:
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), value), F.lit(0))


def fallback_infer(df: DataFrame) -> DataFrame:
    """Fill in granularity, year_min and year_max from title, tags and notes, where granularity or year_min is not known."""
    text = F.concat_ws(" ", *[given(F.col(c)) for c in ("title", "tags", "notes_excerpt") if c in df.columns])
    unknown = F.coalesce(F.col("granularity") == UNKNOWN, F.lit(True))
    runs = unknown | F.col("year_min").isNull()
    return df.select(
        *[c for c in df.columns if c not in ("granularity", "year_min", "year_max")],
        F.when(unknown, granularity(text)).otherwise(F.col("granularity")).alias("granularity"),
        F.when(runs, F.coalesce("year_min", year_min(text))).otherwise(F.col("year_min")).alias("year_min"),
        F.when(runs, F.coalesce("year_max", year_max(text))).otherwise(F.col("year_max")).alias("year_max"),
    )


def url_to_check(resource: Column, landing: Column, distribution: Column, method: Column) -> Column:
    return F.when(method == "sdmx_dataflow_annotations", first_given(landing, distribution)).otherwise(first_given(resource, landing, distribution))


def head_outcome(df: DataFrame) -> DataFrame:
    """reachable and check_notes from url, status_code, error_class (ssl_error, connection_error, connect_timeout, timeout, other)."""
    bad = ~F.coalesce(F.col("url").startswith("http"), F.lit(False))
    error = F.col("error_class")
    notes = F.when(bad, "url_missing_or_invalid").when(error == "ssl_error", "ssl_error").when(error.isin("connection_error", "connect_timeout"), "connection_error").when(error == "timeout", "timeout").when(error.isNotNull(), F.left(error, F.lit(120)))
    return df.withColumn("reachable", F.coalesce(~bad & error.isNull() & (F.col("status_code") < 400), F.lit(False))).withColumn("check_notes", notes)


def intake_score(df: DataFrame) -> DataFrame:
    """needs_review, intake_score (0 to 100) and intake_candidate."""
    review = F.coalesce(F.col("granularity") == UNKNOWN, F.lit(True)) | F.col("year_min").isNull()
    span = F.when(F.col("year_min").isNotNull() & F.col("year_max").isNotNull(), F.least(F.lit(20), F.greatest(F.lit(0), F.col("year_max") - F.col("year_min")))).when(F.col("year_min").isNotNull() | F.col("year_max").isNotNull(), 5).otherwise(0)
    quality = F.when(F.col("enrich_method").isin(*RICH_METHODS), 5).otherwise(0) - F.when(review, 5).otherwise(0)
    total = points(F.col("granularity"), GRANULARITY_POINTS) + span + F.when(F.col("reachable"), 20).otherwise(0) + points(norm_format(F.col("resource_format")), FORMAT_POINTS) + quality
    score = F.least(F.lit(100), F.greatest(F.lit(0), total)).cast("int")
    return df.withColumn("needs_review", review).withColumn("intake_score", score).withColumn("intake_candidate", (score >= CANDIDATE) & ~review)


#: The table of checks, a row an item.
CHECK_RESULT = """check_timestamp timestamp, source_id string, item_id string, item_name string, title string, organization string, tags string, notes string, url_checked string, http_status int, reachable boolean, check_notes string,
granularity string, year_min int, year_max int, resource_format string, enrich_method string, needs_review boolean, intake_score int, intake_candidate boolean""".replace("\n", " ")


def checked_urls(items: DataFrame, enriched: DataFrame) -> DataFrame:
    """items with `e`, their enrichment (source_id, item_id, resource_url, resource_format, granularity, year_min, year_max, enrich_method and perhaps enriched_title, enriched_tags, enriched_notes), and the url to check."""
    keys = ["source_id", "item_id"]
    return with_url(items.join(enriched.select(*keys, F.struct(*[c for c in enriched.columns if c not in keys]).alias("e")), keys, "left"))


def with_url(df: DataFrame) -> DataFrame:
    return df.withColumn("url", url_to_check(F.col("e.resource_url"), F.col("landing_page"), F.col("distribution_url"), F.coalesce("e.enrich_method", F.lit("none"))))


def finish_check(items: DataFrame, enriched: DataFrame, heads: DataFrame, now: Column) -> DataFrame:
    """Rows of CHECK_RESULT. heads: source_id, item_id, status_code, error_class of the probe of each item's url; no row is no answer. now: the time of the check, over the columns of items.

    An enriched title, tags and format win over the catalog's, but not if they are missing; what is not known of granularity and years is inferred from the catalog's texts.
    """
    keys = ["source_id", "item_id"]
    return finished(checked_urls(items.withColumn("checked_at", now), enriched).join(heads.select(*keys, "status_code", "error_class"), keys, "left"), items.columns)


def finished(df: DataFrame, known: list[str]) -> DataFrame:
    """finish_check of rows that hold all it takes: checked_at, e and url as checked_urls gives them, status_code and error_class of the probe, and columns of items, of which those in known count."""
    keys = ["source_id", "item_id"]
    told = df.schema["e"].dataType.fieldNames()
    own = lambda name: F.col(f"e.{name}") if name in told else F.lit(None).cast("string")
    df = head_outcome(df)
    have = [c for c in ("title", "tags", "notes_excerpt") if c in known]
    df = df.select(*keys, "checked_at", *have, "url", "status_code", "reachable", "check_notes", "e", *[c for c in ("item_name", "organization", "format") if c in known], F.col("e.granularity").alias("granularity"), F.col("e.year_min").alias("year_min"), F.col("e.year_max").alias("year_max"), F.coalesce("e.enrich_method", F.lit("none")).alias("enrich_method"))
    df = fallback_infer(df)
    of = lambda name: F.col(name) if name in df.columns else F.lit(None).cast("string")
    df = df.withColumn("resource_format", first_given(own("resource_format"), of("format")))
    out = {"check_timestamp": F.col("checked_at"), "title": first_given(own("enriched_title"), of("title")), "tags": first_given(own("enriched_tags"), of("tags")), "notes": own("enriched_notes"), "url_checked": F.col("url"), "http_status": F.when(F.coalesce(F.col("url").startswith("http"), F.lit(False)), F.col("status_code")), "item_name": of("item_name"), "organization": of("organization")}
    df = intake_score(df)
    fields = df.sparkSession.createDataFrame([], CHECK_RESULT).schema
    return df.select(*[out.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in fields])


def isolated(df: DataFrame, error: Column, method: str) -> DataFrame:
    """enrich_method and check_notes of rows of which some went wrong: where error is not null, `error` and its first 200 characters, else method and null. The others go on."""
    return df.withColumn("enrich_method", F.when(error.isNotNull(), "error").otherwise(method)).withColumn("check_notes", F.left(error, F.lit(200)))


def candidates(checks: DataFrame) -> DataFrame:
    return checks.where(F.coalesce("intake_candidate", F.lit(False)))


def top_candidates(checks: DataFrame, k: int = 5) -> DataFrame:
    return candidates(checks).orderBy(F.desc("intake_score"), "item_id").limit(k).select("source_id", "item_id", "title", "granularity", "intake_score")


def recent(existing: DataFrame, now: Column, days: int = 7) -> DataFrame:
    return existing.where(F.col("check_timestamp") >= now - F.make_interval(days=F.lit(days)))


def _planned(items: DataFrame, existing: DataFrame, now: Column, days: int, keys: tuple[str, ...]) -> DataFrame:
    """items with checked, when they were last checked if lately, and why they are to be checked, null if they are not."""
    fresh = recent(existing, now, days).groupBy(*keys).agg(F.max("check_timestamp").alias("checked"))
    updated = F.coalesce(F.try_to_timestamp("modified") > F.col("checked"), F.lit(False))
    return items.join(fresh, list(keys), "left").withColumn("why", F.when(F.col("checked").isNull(), "not_recent").when(updated, "updated"))


def recheck_plan(items: DataFrame, existing: DataFrame, now: Column, days: int = 7, keys: tuple[str, ...] = ("item_id",)) -> DataFrame:
    """Items to check, and why: not recent, or modified since. The source's modified date may be no date."""
    return _planned(items, existing, now, days, keys).where("why is not null").drop("checked")


def observed_plan(items: DataFrame, existing: DataFrame, now: Column, days: int = 7, keys: tuple[str, ...] = ("item_id",)) -> tuple[DataFrame, Observation]:
    """recheck_plan, and what its first action counts in passing: n_items, n_recent, n_reinspected (recent, but modified since), n_skipped."""
    seen, why = Observation(), F.col("why")
    counted = {"n_items": F.count("*"), "n_recent": F.count("checked"), "n_reinspected": F.count_if(F.coalesce(why == "updated", F.lit(False))), "n_skipped": F.count_if(why.isNull())}
    return _planned(items, existing, now, days, keys).observe(seen, *[c.alias(k) for k, c in counted.items()]).where("why is not null").drop("checked"), seen


def upsert_latest(new: DataFrame, old: DataFrame, keys: tuple[str, ...] = ("item_id",), ts: str = "check_timestamp") -> DataFrame:
    """The latest row of each key of both, by hash aggregation; of equal times, the greatest row."""
    both = old.join(new.select(*keys).distinct(), list(keys), "left_anti").unionByName(new, allowMissingColumns=True)
    rest = [c for c in both.columns if c not in keys]
    return both.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(F.col(ts), *[F.col(c) for c in rest if c != ts])).alias("row")).select(*keys, "row.*")


def recent_minus_updated(recent_ids: DataFrame, updated_ids: DataFrame) -> DataFrame:
    return recent_ids.select(F.col("item_id").cast("string").alias("item_id")).subtract(updated_ids.select(F.col("item_id").cast("string").alias("item_id")))


def value_counts(checks: DataFrame, column: str) -> DataFrame:
    return checks.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "value")


def check_summary(checks: DataFrame) -> DataFrame:
    yes = lambda c: F.count_if(F.coalesce(F.col(c), F.lit(False)))
    return checks.agg(F.count("*").alias("n"), yes("reachable").alias("n_reachable"), F.round(100.0 * yes("reachable") / F.count("*"), 1).alias("pct_reachable"), yes("needs_review").alias("n_review"), yes("intake_candidate").alias("n_candidates"), F.round(F.avg("intake_score"), 2).alias("mean_score"))
