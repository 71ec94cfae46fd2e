"""D9: which harvest of a CKAN source is used."""

from catalume.operators import inventory


def test_method_fallback_by_what_is_usable(spark):
    rows = "source_id string, item_id string, ordinal int, title string, usable boolean"
    make = lambda good, bad, title: spark.createDataFrame([(s, x, n, title, True) for s in good for n, x in ((1, "a"), (2, "b"))][:99] + [(s, None, None, None, False) for s in bad], rows)
    search, names = make("p", "qrstuv", "search"), make("pqrsu", "t", "list")
    current, shows = make("q", "r", "current").where("item_id is null or item_id = 'a'"), make("u", "", "show").where("item_id = 'a'")
    registry = spark.createDataFrame([(x, x in "su") for x in "pqrstuv"], "source_id string, skip_current_list boolean")
    items, report = inventory.method_fallback(search, names, current, shows, registry)
    found = {}
    for x in items.collect():
        found.setdefault((x.source_id, x.method), {})[x.item_id] = x.title
    bare = {"a": "list", "b": "list"}
    assert found == {("p", "package_search"): {"a": "search", "b": "search"}, ("q", "package_list+current_list"): bare | {"a": "current"}, ("r", "package_list"): bare, ("s", "package_list"): bare, ("u", "package_list+package_show"): bare | {"a": "show"}}
    told = {x.source_id: (x.error, x.warning and (x.warning.type, x.warning.rows_enriched, x.warning.rows_missing_metadata)) for x in report.collect()}
    assert told["p"] == (None, None) and told["t"] == told["v"] == ("package_list unusable", None)
    assert told["q"][1] == ("fallback_current_package_list_with_resources", 1, 1) and told["r"][1] == ("fallback_package_list", None, None)
    assert told["s"][1] == ("skip_current_package_list", None, None) and told["u"][1] == ("skip_current_package_list_with_package_show_sample", 1, 1)


def test_bindings_keep_all_fields_and_url_variables(spark):
    import json

    from catalume.sources import parse

    rows = [{"dataset": "d", "distributionUrl": "u1", "publisherName": "P"}, {"dataset": "d", "accessURL": "u2", "description": "D", "landingPage": "L"}, {"dataset": "d", "distribution": "u3", "issued": "2001", "modified": "2002"}]
    body = json.dumps({"results": {"bindings": [{k: {"value": v} for k, v in x.items()} for x in rows]}})
    x = parse.group_bindings(parse.sparql_bindings(spark.createDataFrame([("s", body)], "source_id string, body string"))).first()
    assert (x.urls, x.publisher, x.description, x.landing_page, x.issued, x.modified) == (["u1", "u2", "u3"], "P", "D", "L", "2001", "2002")


def test_names_are_numbered_through_pages(spark):
    from catalume.sources import parse

    pages = spark.createDataFrame([("s", 2, '{"result": ["c"]}'), ("s", 0, '{"result": ["a", "b"]}')], "source_id string, start int, body string")
    assert sorted((x.ordinal, x.item_id) for x in parse.ckan_names(pages).collect()) == [(1, "a"), (2, "b"), (3, "c")]
