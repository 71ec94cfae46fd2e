"""The stages of the pipeline in their order, each against what it should keep."""

import random

import pytest

pytest.importorskip("public_tokenizers")

import corpus_pipeline  # noqa: E402


def test_stages(spark, tmp_path):
    r = random.Random(9)
    word = {"xx": lambda: "".join(r.choices("abcdefg", k=5)), "yy": lambda: "".join(r.choices("rstuvw", k=5))}
    rows = []
    for i in range(120):
        lang = ("xx", "yy")[i % 2]
        text = "\n".join(" ".join(word[lang]() for _ in range(15)).capitalize() + "." for _ in range(8))
        rows.append((i, text, lang, f"s{i % 3}", len(text)))
    rows += [(200 + i, rows[7][1].replace(".", ".", 1) + " more" * (i > 0), "yy", "s0", 1) for i in range(3)]
    rows += [(300, "#### $$$$ " * 60, "xx", "s0", 1), (301, None, None, None, None), (302, "", "xx", "s1", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    ids = lambda df: sorted(x.doc_id for x in df.select("doc_id").collect())
    clean = [*range(120), 200, 201, 202]
    wanted = {"quality_rules": clean, "language_id": clean, "jaccard_join": [*range(120)]}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, columns = docs, docs.columns
        docs = corpus_pipeline.stored(stage(spark, docs, str(tmp_path)), f"test_{name}")
        assert docs.columns == columns
        assert name not in wanted or ids(docs) == wanted[name]
        assert set(ids(docs)) <= set(ids(before))
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
    assert sorted(x.doc_id for x in packed if x.piece == 0) == ids(docs)


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_stages_keep_columns_that_clash(spark, tmp_path):
    names = ["quality", "q", "pattern_of_votes", "lang_pred", "score", "held_out", "k", "label", "mix", "s", "one"]
    r = random.Random(4)
    word = lambda: "".join(r.choices("abcdefg", k=5))
    text = lambda: "\n".join(" ".join(word() for _ in range(15)).capitalize() + "." for _ in range(8))
    same = text()
    rows = [(i, text(), "xx", "s", 1) for i in range(30)] + [(40, same, "xx", "s", 1), (40, same, "xx", "s", 1), (1, same + " more", "xx", "s", 1), (None, text(), None, None, None)]
    docs = spark.createDataFrame([(*x, *[f"mine {n}" for n in names]) for x in rows], SCHEMA + ", " + ", ".join(f"{n} string" for n in names))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = corpus_pipeline.stored(stage(spark, docs, str(tmp_path)), f"clash_{name}")
        assert out.columns == docs.columns and all(x[n] == f"mine {n}" for x in out.collect() for n in names)
        docs = out
        if name == "jaccard_join":  # of two equal rows and their near copy one stays: that with the smaller doc_id, though another text has that doc_id too
            assert sorted((x.doc_id is not None, x.doc_id or 0) for x in docs.collect()) == sorted([(False, 0), *[(True, i) for i in range(30)], (True, 1)])


def test_stages_pass_columns_of_any_type(spark, tmp_path):
    r = random.Random(6)
    text = lambda: "\n".join(" ".join("".join(r.choices("abcdefg", k=5)) for _ in range(15)).capitalize() + "." for _ in range(8))
    same = text()
    rows = [(i, text(), "xx", "s", 1) for i in range(20)] + [(40, same, "xx", "s", 1), (40, same, "xx", "s", 2), (41, same, "xx", "s", 3)]
    odd = {"m": "map('a', n_chars)", "v": "parse_json('{\"x\":[1,null]}')", "st": "struct(map(1, 'x') as inside, array(map('k', 1)) as list)", "b": "cast('bytes' as binary)", "d": "cast(1.5 as decimal(10,2))", "t": "timestamp'2001-01-01'", "nothing": "cast(null as map<string,int>)"}
    spark.createDataFrame(rows, SCHEMA).selectExpr("*", *[f"{e} as {k}" for k, e in odd.items()]).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = corpus_pipeline.stored(stage(spark, docs, str(tmp_path)), f"typed_{name}")
        assert out.schema.simpleString() == docs.schema.simpleString()
        docs = out
        if name == "jaccard_join":
            assert sorted(x.doc_id for x in docs.collect()) == [*range(20), 40]
    x = docs.first()
    assert x.m == {"a": x.n_chars} and str(x.v) == '{"x":[1,null]}' and bytes(x.b) == b"bytes" and x.nothing is None
