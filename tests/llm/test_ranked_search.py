"""Ranked search against scoring every document, with ties, copies, nulls, repeats, small blocks and several blocks of items."""

import math
import random
import re

import pytest

from catalume.llm import search
from catalume.llm.common import scratch

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(docs, items, top=10):
    found = [(d, TERM.findall((t or "").translate(LOWER))) for d, t in docs]
    n_all, l_all = sum(bool(x) for _, x in found), sum(len(x) for _, x in found)
    df = {}
    for _, x in found:
        for t in set(x):
            df[t] = df.get(t, 0) + 1
    out = []
    for item_id, text in items:
        rows = []
        for doc_id, x in found:
            score = 0
            for t in set(TERM.findall((text or "").translate(LOWER))) & set(x):
                tf, m = x.count(t), 10 + (90 * len(x) * n_all) // l_all
                score += math.floor(1000 * math.log((2 * n_all + 2) / (2 * df[t] + 1))) * ((10**9 * tf) // (1000 * tf + 8 * m))
            if score > 0:
                rows.append((-score, doc_id is None, doc_id or 0))
        out += [(item_id, k + 1, None if none else doc_id, -s) for k, (s, none, doc_id) in enumerate(sorted(rows)[:top])]
    return sorted(out, key=repr)


def fixture(seed):
    r = random.Random(seed)
    words = ["the", "The", "of", "É", "é", "x-y", "日本", "a_b", "0", "\x00z", "don't"] + [f"w{i}" for i in range(80)]
    docs = [(r.randint(-99, 400), " ".join(r.choices(words, k=r.choice([0, 1, 5, 30, 200])))) for _ in range(260)]
    docs += [(i, "w1 w2 w3 the copy") for i in range(1000, 1060)] + [(None, "w1 w2 w3 the copy"), (None, None), (3, ""), (3, "--- ..."), (9, "long tail " * 20_000), (7, "w1 w2"), (7, "w1 w2")]
    items = [(i, " ".join(r.choices(words, k=r.choice([1, 3, 40])))) for i in range(20)] + [(5, "w1 w2 w3"), (None, "the"), (50, None), (51, ""), (52, "nowhere"), (53, "COPY copy Copy")]
    return docs, items


@pytest.mark.parametrize(("seed", "most"), [(1, None), (2, 7), (3, 64)])
def test_search_against_all_scores(spark, monkeypatch, seed, most):
    docs, items = fixture(seed)
    if most:
        monkeypatch.setattr(search, "ITEM_BYTES", 300)
        monkeypatch.setattr(search, "FIRST", 2)
        monkeypatch.setattr(search, "MOST", 4)
    path = scratch(spark, "index")
    search.write(spark.createDataFrame([(*x, "x", 1) for x in docs], "doc_id long, text string, ids string, n_docs int").repartition(3), path, block_docs=most)
    got = search.ranked(spark.read.schema(search.SCHEMA).parquet(path), spark.createDataFrame([(*x, 1) for x in items], "item_id long, text string, query int"))
    assert sorted((tuple(x) for x in got.collect()), key=repr) == plain(docs, items)


def test_search_in_nothing_and_for_nothing(spark):
    docs, items = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert search.searched(docs, items).columns == ["item_id", "rank", "doc_id", "score"]
    assert search.searched(docs, items).count() == 0
    some = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    assert search.searched(some, items.limit(0)).count() == 0
    assert search.searched(some.where("doc_id = 2"), items).count() == 0
    assert [x.doc_id for x in search.searched(some, items).collect()] == [1]


def test_few_documents_are_scored(spark):
    docs = [(i, f"common rare{i % 50} " + "filler " * (i % 7)) for i in range(4000)]
    block = search.block_of([d for d, _ in docs], *numbered(docs))
    lists = search.Lists(block, {b"common": 0, b"rare7": 1}, search.np.array([1, 4000]), 4000, 24_000)
    scored = []
    plain_greatest = lists.greatest
    lists.greatest = lambda low, high: (scored.append(len(low)), plain_greatest(low, high))[1]
    best = lists.search([0, 1], [], 10)
    assert len(best) == 10 and all(i % 50 == 7 for _, _, i in best)
    assert sum(scored) < 1500  # intervals that were bounded, two for each document scored


def numbered(docs):
    vocabulary = {}
    numbers = [search.np.array([vocabulary.setdefault(t, len(vocabulary)) for t in search.terms(x.encode())]) for _, x in docs]
    return numbers, list(vocabulary)
