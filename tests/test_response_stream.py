"""The stream of responses: any split and order of files gives what a batch over all of them gives."""

import random

import pytest
from pyspark.sql import functions as F

from catalume.sources import versions
from catalume.sources.tables import RESPONSES
from catalume.streaming import checks

PACKAGE = '{"success": true, "result": {"name": "a", "title": "comuni 1990-2020", "tags": ["t"], "notes": " n ", "resources": [{"url": "http://f", "format": "CSV"}]}}'
NOTE = "<s><Annotation id='LAYOUT_DATAFLOW_KEYWORDS'><AnnotationText>regione+x</AnnotationText></Annotation></s>"
SEEN = "<s><Obs TIME_PERIOD='1999'/><Obs TIME_PERIOD='2004'/></s>"


def landed():
    rows = []

    def add(source, item, method, url, at, status=200, kind=None, body=None, error=None):
        rows.append((source, item, url, method, 1, status, kind, {"h": "1"}, body, error, f"2001-08-{at}"))

    add("c", "a", "HEAD", "https://x/a", "11 10:00:00", 404)
    add("c", "a", "HEAD", "https://x/a", "12 10:00:00")
    add("c", "a", "GET", "https://h/package_show?id=a", "12 10:00:00", 200, "application/json", PACKAGE)
    add("c", "a", "GET", "https://x/a", "12 09:59:00", 200, "text/html", "<a href='/f.pdf'>")
    add("c", "b", "GET", "https://h/package_show?id=b", "05 10:00:00", 200, "application/json", PACKAGE)  # of an earlier check
    add("c", "b", "HEAD", "https://x/b", "12 10:00:00", None, error="timeout")
    add("m", "f", "GET", "https://h/dataflow/IT1/f", "12 10:00:01", 200, "text/xml", NOTE)
    add("m", "f", "GET", "https://h/data/f", "12 10:00:02", 200, "text/xml", SEEN)
    add("m", "f", "HEAD", None, "12 10:00:00")
    add("c", "z", "HEAD", "https://nowhere", "12 10:00:00")  # of no item
    add("m", "p", "GET", "https://x/p", "12 10:00:00", 200, "text/html", '<a href="/f.csv">')
    add("m", "p", "GET", "https://x/p", "12 11:00:00", 500, "text/html", None)
    return rows


def tables(spark):
    items = spark.createDataFrame([("c", "a", "catalogo", "https://x/a"), ("c", "b", "Lombardia 2001", "https://x/b"), ("m", "f", None, "https://x/f"), ("m", "p", "dati", "https://x/p"), ("c", "q", "idle", None)], "source_id string, item_id string, title string, landing_page string")
    registry = spark.createDataFrame([("c", "ckan", False), ("m", "sdmx", False)], "source_id string, protocol string, scraping_blocked boolean")
    start = spark.createDataFrame([("c", "q", 9, "2001-01-01"), ("c", "a", 8, "2001-01-01"), ("m", "f", 7, "2001-09-01")], "source_id string, item_id string, intake_score int, check_timestamp string").withColumn("check_timestamp", F.col("check_timestamp").cast("timestamp"))
    return items, registry, start


def of(spark, rows):
    names = [x.split()[0] for x in RESPONSES.split(", ")]
    schema = RESPONSES.replace("fetched_at timestamp", "fetched_at string")
    return spark.createDataFrame(rows, schema).withColumn("fetched_at", F.col("fetched_at").cast("timestamp")).select(*names)


def shown(df):
    return sorted(map(repr, df.collect()))


def test_checks_of_all_kinds(spark):
    items, registry, _ = tables(spark)
    got = {x.item_id: x for x in checks.check_responses(of(spark, landed()), items, registry).collect()}
    a, b, f, p = (got[x] for x in "abfp")
    assert (a.title, a.tags, a.notes, a.url_checked, a.http_status, a.resource_format, a.intake_score, a.intake_candidate) == ("comuni 1990-2020", "t", "n", "http://f", 200, "CSV", 100, True)
    assert (b.enrich_method, b.title, b.notes, b.granularity, b.year_min, b.check_notes, b.reachable, b.http_status) == ("none", "Lombardia 2001", None, "regione", 2001, "timeout", False, None)
    assert (f.enrich_method, f.granularity, f.year_min, f.year_max, f.url_checked, f.reachable, str(f.check_timestamp)) == ("sdmx_dataflow_annotations", "regione", 1999, 2004, "https://x/f", True, "2001-08-12 10:00:02")
    assert (p.enrich_method, p.resource_format, p.needs_review, p.reachable) == ("html_scrape_failed", None, True, False)
    assert (got["z"].url_checked, got["z"].check_notes, got["z"].title) == (None, "url_missing_or_invalid", None)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_any_split_and_order_gives_the_batch(spark, tmp_path, seed):
    items, registry, start = tables(spark)
    rows, r = landed(), random.Random(seed)
    r.shuffle(rows)
    whole = checks.check_responses(of(spark, rows), items, registry)
    want = versions.newest_row(spark.createDataFrame([], whole.schema).unionByName(start, allowMissingColumns=True).select(*whole.columns), whole, ("source_id", "item_id"), F.col("check_timestamp"), whole.columns)
    cuts = sorted(r.sample(range(1, len(rows)), 3))
    run = lambda: checks.stream_responses(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/c", items, registry, start, buckets=4, files=1)
    for k, (i, j) in enumerate(zip([0, *cuts], [*cuts, len(rows)])):
        of(spark, rows[i:j]).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        if k in (1, 3):
            got = run()
    assert shown(got) == shown(want)
    n = versions.version(spark, f"{tmp_path}/out/checks").number
    assert shown(run()) == shown(want) and versions.version(spark, f"{tmp_path}/out/checks").number == n == 4


def test_a_batch_that_dies_between_the_tables_is_repeated(spark, tmp_path, monkeypatch):
    items, registry, start = tables(spark)
    of(spark, landed()).coalesce(1).write.parquet(f"{tmp_path}/in")
    run = lambda: checks.stream_responses(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/c", items, registry, None, buckets=4)
    plain = checks.check_kinds
    monkeypatch.setattr(checks, "check_kinds", lambda *x: (_ for _ in ()).throw(RuntimeError("executor lost")))
    with pytest.raises(Exception, match="executor lost"):
        run()
    assert versions.rows(spark, f"{tmp_path}/out/checks").count() == 0 and versions.version(spark, f"{tmp_path}/out/responses").number == 1
    monkeypatch.setattr(checks, "check_kinds", plain)
    assert shown(run()) == shown(checks.check_responses(of(spark, landed()), items, registry))
    assert versions.version(spark, f"{tmp_path}/out/responses").number == 1
