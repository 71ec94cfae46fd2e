"""Empty tables, repeated rows, null keys, clashing names, long texts and ties, operator by operator; and what the second round changed."""

import random
import time
import zlib

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

from catalume.llm import chat, grid, html, language, mixing, packing, quality, token_store, toxicity  # noqa: E402
from catalume.llm.common import scratch  # noqa: E402

PATH = public_tokenizers.path("byte_bpe_50k.json")


def plain_ids(text, end):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids + [end]


def test_empty_tables(spark):
    of = lambda schema: spark.createDataFrame([], schema)
    assert grid.near_duplicates(of("vec_id long, embedding array<float>")).count() == 0
    path = scratch(spark, "test_empty")
    token_store.write(of("doc_id long, text string"), path, PATH)
    assert token_store.read_documents(spark, path).count() == 0
    assert language.identified(of("doc_id long, text string, lang string")).count() == 0
    assert chat.formatted(of("conv_id long, turn long, role string, text string"), chat.SCHEMAS).count() == 0
    assert toxicity.judged(of("doc_id long, text string"), of("doc_id long, toxic int")).count() == 0
    assert quality.judged(of("doc_id long, text string")).count() == 0
    assert html.extracted(of("page_id long, url string, html string")).count() == 0


@pytest.mark.parametrize(("size", "part"), [(4, 256), (16, 256), (None, 8)])
def test_grid_recursion(spark, monkeypatch, size, part):
    monkeypatch.setattr(grid, "PART", part)
    r = np.random.default_rng(4)
    base = np.repeat(r.normal(size=(12, 10)), 12, axis=0) + r.normal(size=(144, 10)) * r.choice([0.01, 0.1, 0.3], size=(144, 1))
    x = np.concatenate([base, base[:6]]).astype(np.float32)
    ids = [*range(149), None]
    docs = spark.createDataFrame([(i, v.tolist(), "h1", 1) for i, v in zip(ids, x)], "vec_id long, embedding array<float>, h1 string, block int")
    got = sorted((repr(g.vec_id), g.n_links, g.component_id, g.kept) for g in grid.near_duplicates(docs, size=size).collect())
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    near = u @ u.T >= 0.95
    np.fill_diagonal(near, False)
    label = np.array([i if i is not None else 10**6 for i in ids])
    for _ in ids:
        label = np.array([min(label[i], *label[near[i]]) if near[i].any() else label[i] for i in range(len(ids))])
    assert got == sorted((repr(k), int(near[i].sum()), int(label[i]), k == label[i]) for i, k in enumerate(ids))


def test_packing_cuts_and_digests(spark):
    rows = [(1, "a long text of many words " * 30), (1, "a long text of many words " * 30), (None, "no id"), (2, None), (3, ""), (4, "one two three " * 400)]
    docs = spark.createDataFrame([(*x, 9, "x") for x in rows], "doc_id long, text string, length int, part string")
    got = sorted(((x.doc_id, x.piece, x.start, x.length, x.ids_crc32) for x in packing.pack(docs, PATH, capacity=64).collect()), key=repr)
    want = []
    for doc_id, text in rows:
        ids = np.array(plain_ids(text, 0), "<u4")
        cuts = [0, *range(len(ids) % 64 or 64, len(ids) + 1, 64)]
        want += [(doc_id, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    assert got == sorted(want, key=repr)


def test_token_store_ignores_other_columns(spark):
    path = scratch(spark, "test_clash")
    token_store.write(spark.createDataFrame([(2, "b", 7, "x"), (1, "a", 8, "y")], "doc_id long, text string, part int, shard string"), path, PATH)
    assert [x.doc_id for x in token_store.read_documents(spark, path).orderBy("start").collect()] == [1, 2]


def test_letters_and_ties_of_languages(spark):
    rows = [(i, w, k) for i in range(40) for k, w in [(("bb", "alpha beta"), ("aa", "alpha beta"))[i % 2]]]
    rows += [(100, "½ ²", "aa"), (101, "Ⅷ 12 !", None), (102, "al½pha²", None), (103, "日本", None), (None, "alpha", "aa")]
    out = {x.doc_id: x for x in language.identified(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert (out[100].lang_pred, out[101].lang_pred, out[100].score) == ("und", "und", 0)
    assert out[102].lang_pred != "und" and out[103].lang_pred == "aa" and out[None].held_out
    assert all(x.lang_pred == "aa" and x.score == pytest.approx(0.5, abs=0.2) for x in out.values() if x.doc_id is not None and x.doc_id < 40)


def test_every_language_is_learned(spark):
    r = random.Random(1)
    names = [f"l{i:03}" for i in range(230)]
    rows = [(i, " ".join(f"{name}x{'abcdefgh'[r.randrange(8)]}" .translate(str.maketrans("0123456789", "klmnopqrst")) for _ in range(12)), name) for i, name in enumerate(n for n in names for _ in range(4))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(docs, per_language=3000, in_all=460)
    assert model.languages == names
    out = language.predict(docs, language.fit(docs)).select("lang", "lang_pred").collect()
    assert all(x.lang == x.lang_pred for x in out)


def test_toxicity_repeats_and_long_texts(spark):
    r = random.Random(6)
    text = lambda bad: " ".join("vile" if bad and k % 9 == 0 else r.choice("abcdefghij") + r.choice("klmnop") for k in range(45))
    rows = [(i, text(i % 4 == 0)) for i in range(240)]
    rows += [(500, rows[0][1])] * 3 + [(600, "vile words and more " * 30_000), (700, "½ ² Ⅷ"), (None, None)]
    labels = [(i, int(i % 4 == 0)) for i in range(240)] + [(500, 1), (500, 1), (None, 1)]
    out = toxicity.judged(spark.createDataFrame([(*x, 1) for x in rows], "doc_id long, text string, held_out int"), spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    assert len(out) == len(rows)
    by = {x.doc_id: x for x in out}
    assert by[600].predicted == 1 and by[500].predicted == 1 and by[None].held_out
    assert len({x.score for x in out if x.doc_id == 500}) == 1


def simulated(n, seed):
    """Counts of vote patterns of n texts: rules right at planted rates on good and on bad texts, two of them by chance alone."""
    r = random.Random(seed)
    right = [(0.9, 0.8)] * 6 + [(0.5, 0.5)] * 2
    counts, truth = {}, []
    for _ in range(n):
        good = r.random() < 0.7
        code = 0
        for k, (on_good, on_bad) in enumerate(right):
            hit = r.random() < (on_good if good else on_bad)
            code += (1 if hit == good else 2) * 3**k
        counts[code] = counts.get(code, 0) + 1
        truth.append((code, good))
    return counts, truth, right


def test_estimate_recovers_planted_accuracies():
    counts, truth, right = simulated(40_000, 3)
    posterior = quality.estimate(counts)
    good = sum(posterior[code] * n for code, n in counts.items())
    for k, (on_good, on_bad) in enumerate(right):
        voted_good = sum(posterior[code] * n for code, n in counts.items() if quality.digits(code)[k] == 1) / good
        voted_bad = sum((1 - posterior[code]) * n for code, n in counts.items() if quality.digits(code)[k] == 2) / (40_000 - good)
        assert voted_good == pytest.approx(on_good, abs=0.02) and voted_bad == pytest.approx(on_bad, abs=0.02)
    best = {}  # the rule of Bayes with what was planted
    for code in counts:
        odds = 0.7 / 0.3
        for (on_good, on_bad), v in zip(right, quality.digits(code)):
            odds *= on_good / (1 - on_bad) if v == 1 else (1 - on_good) / on_bad
        best[code] = odds >= 1
    rate = lambda f: sum(f(code) == y for code, y in truth) / len(truth)
    assert rate(lambda code: posterior[code] >= 0.5) >= rate(best.get) - 0.002


def test_quality_keeps_other_columns(spark):
    text = ". ".join(" ".join(["word", "other", "words", "here", f"n{'abcdefghij'[i]}", f"m{'klmnopqrst'[i]}", "end"]) for i in range(10)) + "."
    docs = spark.createDataFrame([(1, text, "mine", 2), (1, text, "mine", 2)], "doc_id long, text string, q string, votes int")
    out = quality.judged(docs).collect()
    assert [(x.q, x.votes) for x in out] == [("mine", 2)] * 2 and out[0].quality == out[1].quality


def test_mixing_expectation_and_clashes(spark):
    names = ["s", "k", "one", "t", "key", "drawn", "mix_size", "mix_key", "leaf", "p", "mix"]
    r = random.Random(2)
    rows = [(i, "w " * r.randint(1, 9), f"s{i % 3}", *["mine"] * len(names)) for i in range(90)] + [(99, "w " * 20_000, "s1", *["mine"] * len(names))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, " + ", ".join(f"{x} string" for x in names))
    out = mixing.mixed(docs)
    assert out.columns == docs.columns and all(x.s == x.mix_key == "mine" for x in out.collect())
    # Over many seeds, each document is taken as often as its source's rate says.
    taken, rate = {}, {}
    for seed in range(60):
        rows = [(f"d{i}", 1 + i % 7, 0.3 + 0.05 * (i % 9)) for i in range(64)]
        for (key, _, p), (got, done) in zip(rows, mixing.settle([(k, n, p) for k, n, p in rows], seed, True)):
            assert done and got in (0.0, 1.0)
            taken[key], rate[key] = taken.get(key, 0) + got, p
    assert sum(taken.values()) / 60 == pytest.approx(sum(rate.values()), rel=0.03)
    assert max(abs(taken[k] / 60 - rate[k]) for k in rate) < 0.3


def article(n, word="word"):
    return "<p>" + ", ".join([word] * n) + ".</p>"


@pytest.mark.parametrize("names", ["content has-sidebar", "post no-comments", "content with-share", "page is-menu-open", "sidebar-left"])
def test_names_do_not_take_the_article(names):
    page = f'<body><div class="menu"><a href="x">Home</a></div><div class="{names}">{article(40)}{article(50)}</div><div class="sidebar">{article(5, "side")}</div><div class="footer">foot</div></body>'
    assert html.main_text(page) == "\n".join([", ".join(["word"] * n) + "." for n in (40, 50)])


def test_heads_of_articles_and_remarks():
    page = f'<body><div class="header">Site</div><article><div class="entry-header"><h1>Title</h1></div>{article(30)}<div class="share">Share, this, now</div></article><div class="comments">{article(60, "remark")}{article(60, "remark")}</div></body>'
    assert html.main_text(page) == "Title\n" + ", ".join(["word"] * 30) + "."


def test_html_time_is_linear(spark):
    pages = ["<div>" * n + "text, text, and text" + "</span>" * n for n in (4000, 16_000)] + ["<ul>" + "<span>" * n + "<p>x<li>" * n for n in (4000, 16_000)]
    took = []
    for page in pages:
        start = time.process_time()
        html.main_text(page)
        took.append(time.process_time() - start)
    assert took[1] < 10 * took[0] + 0.5 and took[3] < 10 * took[2] + 0.5
    row = (1, "u", f"<article>{article(9)}</article>")
    out = html.extracted(spark.createDataFrame([row, row], "page_id long, url string, html string")).collect()
    assert len(out) == 2 and out[0] == out[1] and out[0].text


def test_chat_long_and_repeated(spark):
    rows = [(1, 0, "user", "long " * 200_000), (1, 0, "user", "long " * 200_000), (None, None, "tool", '{"tool_call_id":"a","content":"x"}')]
    out = chat.formatted(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), chat.SCHEMAS).collect()
    assert len(out) == 3 and sum(len(x.message) > 1_000_000 for x in out) == 2


def test_chat_names_nulls_and_answers(spark):
    calls = '{"content":"x","tool_calls":[null,{"id":"a","name":"t","arguments":{"a.b":1}},{"id":"b","name":"t","arguments":{"a.b":"1"}}]}'
    rows = [(1, 0, "assistant", calls), (1, 1, "tool", '{"tool_call_id":"a","content":"1"}'), (1, 2, "tool", '{"tool_call_id":"a","content":"2"}')]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = {x.turn: x for x in chat.formatted(turns, {"t": {"a.b": ("bigint", True)}}).collect()}
    assert (out[0].n_calls, out[0].n_valid) == (2, 1)
    assert {(x.call_id, x.n_results) for x in chat.answers(turns).collect()} == {("a", 2), ("b", 0)}
