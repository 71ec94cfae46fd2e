"""The state between batches of the stream: what bodies told, not the bodies; a view over one that has been written."""

from test_response_stream import PACKAGE, of, tables

from catalume.fixtures import view
from catalume.sources import versions
from catalume.streaming import checks

SF = "/root/testdata/sf0.001"


def test_state_holds_a_row_an_item_and_no_bodies(spark, tmp_path):
    items, registry, _ = tables(spark)
    get = lambda at, status, body: ("c", "a", "https://h/package_show?id=a", "GET", 1, status, "application/json", {"h": "1"}, body, None, f"2001-08-12 {at}")
    for rows in ([get("10:00:00", 200, PACKAGE)], [get("11:00:00", 500, None), ("c", "a", "https://x/a", "HEAD", 1, 200, None, None, None, None, "2001-08-12 10:30:00")], [("c", None, "https://x", "HEAD", 1, 200, None, None, None, None, "2001-08-12 12:00:00")]):
        of(spark, rows).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        checks.stream_responses(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/c", items, registry, None, buckets=2)
        state = versions.rows(spark, f"{tmp_path}/out/responses")
        assert "body" not in state.columns and state.count() == 1
    last = state.first()
    assert (last.ckan.said.status_code, last.ckan.found, last.head.said.status_code) == (500, None, 200)  # the later failure hides the package
    done = versions.rows(spark, f"{tmp_path}/out/checks").collect()
    assert [(x.item_id, x.enrich_method, str(x.check_timestamp)) for x in done] == [("a", "none", "2001-08-12 11:00:00")]


def test_a_view_over_a_given_one(spark):
    items = view(spark, SF, "fx_items").where("ordinal = 2")
    got = view(spark, SF, "fx_ckan_packages", fx_items=items)
    assert {x.ordinal for x in got.select("ordinal").collect()} == {2} and view(spark, SF, "fx_items").where("ordinal = 1").count() > 0
