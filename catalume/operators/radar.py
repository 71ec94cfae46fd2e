"""Health of sources from probe attempts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalume.functions.text import given

# Fixed values.
RETRYABLE = (500, 502, 503, 504)
ATTEMPTS = 3
STATUSES = ("GREEN", "YELLOW", "RED")
SDMX_MARKS = ("/rest/", "/SDMXWS/", "/sdmx/")


def radar_status(code: Column) -> Column:
    return F.when(code.between(200, 399), "GREEN").when(code.between(400, 499), "YELLOW").otherwise("RED")


def is_sdmx(url: Column) -> Column:
    out = F.lit(False)
    for mark in SDMX_MARKS:
        out = out | url.contains(mark)
    return out


def ckan_health(df: DataFrame) -> DataFrame:
    """status and note of responses (url, status_code, content_type, body)."""
    status = radar_status(F.col("status_code"))
    asked = F.col("url").contains("/api/3/action/") & (status == "GREEN")
    parsed = F.try_parse_json(F.col("body"))
    has_key = F.coalesce(F.array_contains(F.json_object_keys("body"), "success"), F.lit(False))
    note = F.when(asked & ~F.coalesce(F.lower("content_type").contains("json"), F.lit(False)), "CKAN API returned non-JSON content").when(asked & parsed.isNull(), "CKAN API returned invalid JSON").when(asked & ~has_key, "CKAN API payload missing expected keys")
    return df.withColumn("status", F.when(note.isNotNull(), "YELLOW").otherwise(status)).withColumn("note", note)


def probe_error(df: DataFrame) -> DataFrame:
    """status and note of attempts that failed with an error_class; ssl_failed tells whether the certificate check was given up before."""
    error, fell = F.col("error_class"), F.col("ssl_failed")
    timeout = error.isin("timeout", "connect_timeout")
    kind = F.when(timeout, F.when(fell, "fallback timed out").otherwise("Timeout")).when(error == "connection_error", F.when(fell, "fallback connection error").otherwise("Connection error")).otherwise(F.when(fell, "fallback request error").otherwise("Request error"))
    note = F.concat(F.when(fell, "SSL verify failed; ").otherwise(""), kind, F.lit(" ("), error, F.lit(")"))
    return df.where(error.isNotNull()).withColumn("status", F.when(timeout, "YELLOW").otherwise("RED")).withColumn("note", note)


def probe_result(df: DataFrame) -> DataFrame:
    """Outcome of each attempt, whether it ended in a response or an error, with the note that a fallback was used."""
    health = ckan_health(df)
    error = F.col("error_class")
    status = F.when(error.isin("timeout", "connect_timeout"), "YELLOW").when(error.isNotNull(), "RED").otherwise(F.col("status"))
    note = F.when(error.isNull(), given(F.concat_ws(" | ", F.when(F.col("ssl_failed"), "SSL verify failed, fallback used"), F.col("note")))).otherwise(error)
    return health.withColumn("status", status).withColumn("note", note).withColumn("http_code", F.when(error.isNull() & F.col("status_code").isNotNull(), F.col("status_code").cast("string")).otherwise("-"))


def collapse_attempts(df: DataFrame) -> DataFrame:
    """One outcome per source: the first attempt for most; for SDMX the first that is GREEN or not worth a retry, else the last. Retried outcomes lose ssl_fallback_used."""
    retry = is_sdmx(F.col("url"))
    results = probe_result(df).where(retry | (F.col("attempt") == 1))
    code = F.coalesce(F.col("http_code").try_cast("int"), F.lit(0))
    stop = (F.col("status") == "GREEN") | ~code.isin(*RETRYABLE)
    row = F.struct("attempt", "url", "status", "http_code", "note", "ssl_failed", stop.alias("stop"))
    one = results.groupBy("source_id").agg(F.min_by(F.when(stop, row), F.when(stop, F.col("attempt"))).alias("first"), F.max_by(row, "attempt").alias("last"))
    one = one.select("source_id", F.coalesce("first", "last").alias("r"))
    detail = F.coalesce(F.col("r.note"), F.lit("nessun dettaglio"))
    retried = is_sdmx(F.col("r.url")) & (F.col("r.status") != "GREEN")
    note = F.when(retried & ~F.col("r.stop"), F.concat(F.lit(f"SDMX retry esaurito ({ATTEMPTS} tentativi): "), detail)).when(retried & (F.col("r.attempt") > 1), F.concat(F.lit("Retry dopo "), (F.col("r.attempt") - 1).cast("string"), F.lit(" tentativi: "), detail)).otherwise(F.col("r.note"))
    lost = retried & (~F.col("r.stop") | (F.col("r.attempt") > 1))
    return one.select("source_id", F.col("r.status").alias("status"), F.col("r.http_code").alias("http_code"), note.alias("note"), (F.col("r.ssl_failed") & ~lost).alias("ssl_fallback_used"))


def status_lines(registry: DataFrame, probe: DataFrame) -> DataFrame:
    """One line of defaults and outcome per source; without a base_url it is RED."""
    missing = given(F.col("base_url")).isNull()
    df = registry.join(probe.select("source_id", "status", "http_code"), "source_id", "left")
    return df.select("source_id", F.when(missing, "RED").otherwise(F.coalesce("status", F.lit("RED"))).alias("status"), F.coalesce("http_code", F.lit("-")).alias("http_code"), F.coalesce("source_kind", F.lit("source")).alias("source_kind"), F.coalesce("protocol", F.lit("-")).alias("protocol"), F.coalesce("observation_mode", F.lit("radar-only")).alias("observation_mode"))


def status_notes(registry: DataFrame, probe: DataFrame) -> DataFrame:
    """A note for each source that is not GREEN or needed the fallback."""
    df = registry.select("source_id", "base_url").join(probe, "source_id").where((F.col("status") != "GREEN") | F.col("ssl_fallback_used"))
    note = given(F.concat_ws(" | ", F.when(F.col("http_code") != "-", F.concat(F.lit("HTTP "), F.col("http_code"))), F.col("note")))
    return df.select("source_id", "status", F.coalesce(note, F.lit("Nessuna nota")).alias("note"))


# Categories that are counted even where no source is of them, and texts of notes.
MODES = ("radar-only", "catalog-watch", "monitor-active")
SOURCE_KINDS = ("catalog", "portal", "source")
MISSING_URL, NO_NOTE = "Missing base_url in registry entry", "Nessuna nota"
CONTENT_TYPE, FINAL_URL = "content-type: ", "url finale: "


def probes(registry: DataFrame, outcomes: DataFrame) -> DataFrame:
    """The outcome of each source: one without a base_url is RED and says so, whatever was probed."""
    missing = given(F.col("base_url")).isNull()
    df = registry.select("source_id", "base_url").join(outcomes, "source_id", "left")
    fixed = {"status": F.lit("RED"), "http_code": F.lit("-"), "note": F.lit(MISSING_URL), "ssl_fallback_used": F.lit(False)}
    return df.select("source_id", *[F.when(missing, fixed[c]).otherwise(F.col(c)).alias(c) if c in fixed else F.when(~missing, F.col(c)).alias(c) for c in outcomes.columns if c != "source_id"])


def source_lines(registry: DataFrame, outcomes: DataFrame) -> DataFrame:
    """status_lines with the datasets that are in use (registry: datasets_in_use, an array), joined, or -."""
    datasets = F.coalesce(given(F.array_join("datasets_in_use", ", ")), F.lit("-"))
    return status_lines(registry, probes(registry, outcomes)).join(registry.select("source_id", datasets.alias("datasets")), "source_id")


def source_notes(registry: DataFrame, outcomes: DataFrame) -> DataFrame:
    """A note for each source that is not GREEN or needed the fallback: code, content type, final url, then the probe's note or else the registry's. outcomes may have content_type and final_url."""
    df = probes(registry, outcomes)
    text = lambda c: given(F.col(c)) if c in df.columns else F.lit(None).cast("string")
    kept = registry.select("source_id", (F.col("note") if "note" in registry.columns else F.lit(None).cast("string")).alias("registry_note"))
    df = df.join(kept, "source_id").where((F.col("status") != "GREEN") | F.col("ssl_fallback_used"))
    parts = (F.when(F.col("http_code") != "-", F.concat(F.lit("HTTP "), F.col("http_code"))), F.concat(F.lit(CONTENT_TYPE), text("content_type")), F.concat(F.lit(FINAL_URL), text("final_url")), F.coalesce(text("note"), given(F.col("registry_note"))))
    return df.select("source_id", "status", F.coalesce(given(F.concat_ws(" | ", *parts)), F.lit(NO_NOTE)).alias("note"))


def stamp_probed(registry: DataFrame, day: str) -> DataFrame:
    return registry.withColumn("last_probed", F.lit(day))


def category_counts(registry: DataFrame, probe: DataFrame) -> DataFrame:
    """group_name, category, n: radar_counts with zeros for modes and kinds too. Categories that are not fixed ones count as well."""
    fixed = [("status", x) for x in STATUSES] + [("mode", x) for x in MODES] + [("kind", x) for x in SOURCE_KINDS]
    every = registry.sparkSession.createDataFrame([(*x, 0) for x in fixed], "group_name string, category string, n long")
    return radar_counts(registry, probe).unionByName(every).groupBy("group_name", "category").agg(F.sum("n").alias("n"))


def radar_counts(registry: DataFrame, probe: DataFrame) -> DataFrame:
    """group, category, n: sources by status (all three, zeros too), by mode and by kind."""
    lines = status_lines(registry, probe)
    spark = registry.sparkSession
    every = spark.createDataFrame([(s,) for s in STATUSES], "category string")
    by = lambda c, name: lines.groupBy(F.col(c).alias("category")).agg(F.count("*").alias("n")).select(F.lit(name).alias("group_name"), "category", "n")
    statuses = every.join(by("status", "status"), "category", "left").select(F.lit("status").alias("group_name"), "category", F.coalesce("n", F.lit(0)).alias("n"))
    return statuses.unionByName(by("observation_mode", "mode")).unionByName(by("source_kind", "kind"))
