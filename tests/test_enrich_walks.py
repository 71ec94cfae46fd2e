"""Bodies are parsed once and only where the dispatch asks for them; what is no XML never fails a query."""

import pytest
from pyspark.sql import functions as F

from catalume.fixtures import view
from catalume.plans import queries as base
from catalume.sources import parse

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("body", ["<a/> trailing", "<a/><b/>", "<a>", "x", "<a>&nope;</a>", "<a x='1' x='2'/>"])
def test_what_is_no_xml_is_absent(spark, body):
    df = spark.createDataFrame([("1", body), ("2", "<a><Obs TIME_PERIOD='2001'/></a>")], "item_id string, body string")
    assert [r.item_id for r in parse.sdmx_enrich(df).collect()] == ["2"]
    assert [tuple(r) for r in parse.sdmx_years(df).collect()] == [("2", 2001, 2001)]


def test_first_text_of_annotations(spark):
    note = lambda text, attributes=" id='METADATA_URL'": f"<x:Annotation{attributes}>{text}</x:Annotation>"
    text = lambda x: f"<AnnotationText>{x}</AnnotationText>"
    bodies = {
        "comment": (note(text("u<!--c-->v")), "u"),
        "cdata": (note(text("<![CDATA[c&d]]>e")), "c&d"),
        "entity": (note(text("a &amp; b")), "a & b"),
        "nested": (note(note(text("in")) + text("out")), "in"),
        "type behind the text": (note(text("t") + "<AnnotationType>META<b>DATA</b>_URL</AnnotationType>", ""), "t"),
        "second text": (note("<AnnotationText/>" + text("2nd")), "2nd"),
        "deeper": (note(f"<y>{text('no')}</y>"), None),
    }
    df = spark.createDataFrame([(k, f"<a>{b}</a>") for k, (b, _) in bodies.items()], "item_id string, body string")
    assert {r.item_id: r.resource_url for r in parse.sdmx_enrich(df).collect()} == {k: x for k, (_, x) in bodies.items()}


def test_a_package_is_read_once(spark):
    plan = _plan(parse.ckan_enrich(view(spark, SF, "fx_ckan_packages")))
    assert not [x for x in plan.splitlines() if x.lstrip(" :+-").startswith("Filter") and "variant_get" in x]


def test_enrichments_are_sorted_once(spark):
    out = base.c10_enrich_dispatch(spark, SF)
    plan = out._jdf.queryExecution().executedPlan().toString()
    above = plan[: plan.index("Union")]
    assert above.count("Sort ") == 1 and above.count("Exchange") == 1


def test_bodies_of_other_protocols_are_not_parsed(spark):
    registry = spark.createDataFrame([("a", "ckan"), ("b", "sdmx"), ("c", None), ("d", "")], "source_id string, protocol string")
    rows = spark.createDataFrame([(x,) for x in "abcde"], "source_id string")
    assert sorted(r.source_id for r in parse.of_protocol(rows, registry, "ckan").collect()) == ["a", "c", "d", "e"]
    assert sorted(r.source_id for r in parse.of_protocol(rows, registry, "sdmx").where(F.col("source_id") < "c").collect()) == ["b"]


def test_states_are_grouped_once_and_carry_what_is_there(spark):
    states = parse.group_bindings(view(spark, SF, "fx_bindings"))
    assert "publisher" in states.columns and "landing_page" in states.columns
    plan = _plan(parse.sparql_catalog(states))
    joins = [x for x in plan.splitlines() if x.lstrip(" :+-").startswith("Join")]
    grouped = [x for x in plan.splitlines() if x.lstrip(" :+-").startswith("Aggregate") and "collect_list" in x]
    assert len(joins) == 1 and len(grouped) == 1 and "publisher#" not in "".join(grouped)
