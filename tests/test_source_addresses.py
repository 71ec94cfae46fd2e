"""Addresses of a source are worked out once a source, not once an item."""

from catalume.plans import queries
from catalume.sources import parse

SF = "/root/testdata/sf0.001"


def test_no_pattern_is_applied_per_item(spark, capsys):
    names = spark.createDataFrame([("a", "x", 1), ("b", "y", 1), ("z", "q", 1)], "source_id string, item_id string, ordinal int")
    registry = spark.createDataFrame([("a", "catalog", "ckan", "https://h/api/3/action/package_list?limit=1", None), ("b", "catalog", "ckan", "https://g/odapi/package_list", "own")], "source_id string, source_kind string, protocol string, base_url string, baseline_method string")
    out = parse.inventory_rows(names, registry, "ckan", queries._now(), "package_search")
    rows = {x.source_id: (x.source_url, x.api_base_url, x.inventory_method) for x in out.collect()}
    assert rows == {"a": ("https://h/api/3/action/package_search", "https://h/api/3/action", "package_search"), "b": ("https://g/odapi/package_search", "https://g/odapi", "package_search"), "z": (None, None, "package_search")}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp" not in plan[: plan.index("Join")]
