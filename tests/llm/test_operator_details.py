"""What the first review found: each test failed before its finding was settled."""

import json
import os

import duckdb
import pytest

pytest.importorskip("public_tokenizers")

from catalume.llm import html  # noqa: E402
from catalume.llm.queries import ORACLES, QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_chat_query_has_schemas(spark, tmp_path):
    calls = [{"id": "a", "name": "search", "arguments": {"query": "x", "limit": 3}}, {"id": "b", "name": "search", "arguments": {"query": "x", "limit": "3"}}, {"id": "c", "name": "convert", "arguments": '{"value": 2, "unit": "m"}'}, {"id": "d", "name": "convert", "arguments": {"value": 2, "unit": 5}}]
    spark.createDataFrame([(1, 0, "assistant", json.dumps({"tool_calls": calls}))], "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    assert [(x.n_calls, x.n_valid) for x in QUERIES["op5_chat_format"](spark, str(tmp_path)).collect()] == [(4, 2)]


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")
def test_tool_calls_oracle(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    df, expected = QUERIES["op5_tool_calls"](spark, SF), con.sql(ORACLES["op5_tool_calls"])
    assert df.columns == expected.columns
    rows = [tuple(x) for x in df.collect()]
    assert sorted(map(repr, rows)) == sorted(map(repr, expected.fetchall()))
    by = {name: {x[df.columns.index(name)] for x in rows} for name in df.columns}
    assert by["n_valid"] == {0, 1, 2} and by["linked"] == {None, True, False} and by["order_step"] == {0, 1, 2}
    assert len({x[:2] for x in rows}) == len(rows)


LONG = "".join(f"<p>Long {i}, with commas, and more of them, {'and words ' * 12}.</p>" for i in range(10))
PARTS = f"<header><h1>The title</h1></header><section>{LONG}</section><section><p>Short one.</p><p>Short two.</p></section><ul><li>Item</li></ul><figure><figcaption>Figure</figcaption></figure><table><tr><td>Cell</td></tr></table>"
AROUND = '<nav><a href="/">Home</a></nav><div class="sidebar"><p>Side, of, the, page.</p></div>'


@pytest.mark.parametrize(
    "page",
    [
        f"<body>{AROUND}<article>{PARTS}</article><footer>us</footer></body>",
        f"<body>{AROUND}<main><div class='grid'><div>{PARTS}</div></div></main><footer>us</footer></body>",
        f"<body>{AROUND}<div><article><div><div>{PARTS}</div></div></article></div><footer>us</footer></body>",
        f"<body>{AROUND}<div id='content'>{PARTS.replace('header>', 'div>')}</div><footer>us</footer></body>",
    ],
)
def test_sectioned_and_wrapped_articles_are_whole(page):
    lines = html.main_text(page).split("\n")
    assert [lines[0], *lines[-5:]] == ["The title", "Short one.", "Short two.", "Item", "Figure", "Cell"] and len(lines) == 16


def test_sections_under_an_unnamed_wrapper_are_whole():
    parts = f"<div><section>{LONG}</section></div>" * 3
    lines = html.main_text(f"<body>{AROUND}<div>{parts}<section><p>Short one.</p></section></div><footer>us</footer></body>").split("\n")
    assert len(lines) == 31 and lines[-1] == "Short one." and not any("Side" in x or "Home" in x or x == "us" for x in lines)
