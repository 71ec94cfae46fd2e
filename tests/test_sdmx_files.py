"""SDMX listings in files: the same rows and ordinals as from bodies, with broken files set aside."""

import os

from catalume.sources import flows, parse

OPEN = "<m:S xmlns:m='m' xmlns:s='s' xmlns:c='c'><s:Dataflows>"
CLOSE = "</s:Dataflows></m:S>"


def flow(i, name="<c:Name xml:lang='it'> N{} </c:Name><c:Name>other</c:Name>"):
    return f"<s:Dataflow id='f{i}'>{name.format(i)}</s:Dataflow>"


def test_files_give_the_rows_of_bodies(spark, tmp_path):
    bodies = {("a", 10): OPEN + "".join(map(flow, range(30))) + CLOSE, ("a", 2): OPEN + "\n".join(map(flow, range(50, 55))) + CLOSE + "\n\n", ("a", 11): OPEN + flow(90) + "<", ("b", 0): OPEN + flow(1, "<c:Name/>") + flow(2, "") + CLOSE, ("b", 1): OPEN + CLOSE, ("c", 0): "nothing of that kind"}
    for (source, start), body in bodies.items():
        os.makedirs(folder := f"{tmp_path}/in/source_id={source}/start={start}")
        with open(f"{folder}/x.xml", "w") as out:
            out.write(body)
    flows.land_flows(spark, f"{tmp_path}/in", f"{tmp_path}/out")
    got = flows.flow_items(spark, f"{tmp_path}/out")
    rows = lambda df: sorted(map(repr, df.select("source_id", "item_id", "item_name", "title", "ordinal").collect()))
    want = parse.sdmx_items(spark.createDataFrame([(s, k, x) for (s, k), x in bodies.items()], "source_id string, start long, body string"))
    assert rows(got) == rows(want) and len(rows(got)) == 37
    assert sorted((x.source_id, x.start, x.reason) for x in spark.read.parquet(f"{tmp_path}/out/aside").collect()) == [("a", 11, "breaks off"), ("c", 0, "breaks off"), ("c", 0, "no XML")]


def test_a_listing_is_no_single_row(spark, tmp_path):
    os.makedirs(f"{tmp_path}/in/source_id=a/start=0")
    with open(f"{tmp_path}/in/source_id=a/start=0/x.xml", "w") as out:
        out.write(OPEN + "".join(map(flow, range(20_000))) + CLOSE)
    plan = flows.read_flows(spark, f"{tmp_path}/in")
    assert plan.count() == 20_000
    flows.land_flows(spark, f"{tmp_path}/in", f"{tmp_path}/out")
    got = flows.flow_items(spark, f"{tmp_path}/out").orderBy("ordinal").collect()
    assert [(x.item_id, x.title, x.ordinal) for x in got] == [(f"f{i}", f"N{i}", i + 1) for i in range(20_000)]
