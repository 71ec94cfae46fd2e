"""Exact dedup against grouping by hand, in one to five batches; the filters and the byte check alone."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from catalume.llm import exact
from catalume.llm.common import scratch


@pytest.mark.parametrize("n", [1, 2, 3, 7, 100, 5000, 60000])
def test_filters_hold_their_keys_and_few_others(n):
    r = np.random.default_rng(n)
    keys = r.integers(-(1 << 63), (1 << 63) - 1, n, dtype=np.int64)
    fuse = exact.fused(np.concatenate([keys, keys[:3]]))
    assert exact.holds(fuse, keys).all()
    assert exact.holds(fuse, r.integers(-(1 << 63), (1 << 63) - 1, 50_000, dtype=np.int64)).mean() < 0.006
    assert len(fuse.prints) <= 1.5 * n + 64


def plain(rows):
    groups = {}
    for k, (doc_id, text) in enumerate(rows):
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", text or ""), []).append((doc_id is None, doc_id or 0, k))
    out = []
    for text, members in groups.items():
        first = min(members)
        out += [(rows[k][0], rows[first[2]][0], len(members), k == first[2], hashlib.sha256(text.encode()).hexdigest()) for _, _, k in members]
    return sorted(out, key=repr)


def rows_of(r, n=300):
    texts = [" ".join(r.choices(["a", "b", "é", "日本", "\t", "\x0b", ""], k=r.randint(0, 4))) for _ in range(60)] + [None, "", " ", "long " * 40_000]
    rows = [(r.randint(-50, 400), r.choice(texts)) for _ in range(n)] + [(None, "a b"), (None, "only without id"), (None, "only without id"), (5, "same"), (5, "same"), (5, "other")]
    return [*rows, *[(i, "hot  copy" if i % 2 else "hot\ncopy") for i in range(500, 700)]]


@pytest.mark.parametrize("batches", [1, 3, 5])
def test_against_grouping_by_hand(spark, monkeypatch, batches):
    monkeypatch.setattr(exact, "KEYS", 8)
    monkeypatch.setattr(exact, "SCREENED", 4)
    monkeypatch.setattr(exact, "BROADCAST", 1 << 18 if batches == 3 else 0)
    monkeypatch.setattr(exact, "HOT", 10)
    rows = rows_of(random.Random(batches))
    docs = spark.createDataFrame([(*x, 1, "x", 7) for x in rows], "doc_id long, text string, uid int, digest string, batch int").repartition(3)
    got = sorted((tuple(x) for x in exact.deduplicated(docs, batches).collect()), key=repr)
    assert got == plain(rows)


def test_no_rows_and_extreme_ids(spark):
    out = exact.deduplicated(spark.createDataFrame([], "doc_id long, text string"))
    assert out.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"] and out.count() == 0
    rows = [(-(1 << 63), "x"), ((1 << 63) - 1, "x"), (0, "y"), (None, None)]
    got = sorted((tuple(x) for x in exact.deduplicated(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=repr)
    assert got == plain(rows)


def test_equal_digests_of_unlike_texts_are_told_apart_by_bytes(spark):
    path = scratch(spark, "collide")
    of = lambda rows, at: spark.createDataFrame(rows, "doc_id long, text string").transform(exact.normalised).withColumn("digest", F.lit(42).cast("long")).write.parquet(f"{at}/rows")
    of([(1, "old"), (2, "older")], f"{path}/0")
    of([(3, "new"), (4, "old"), (5, "older"), (6, "new")], f"{path}/1")
    _, first = exact.arrived(spark, f"{path}/0", 0, [])
    groups, _ = exact.arrived(spark, f"{path}/1", 1, [first])
    assert sorted((x.first.doc_id, x.root.doc_id, x.n) for x in groups.collect()) == [(3, 3, 2), (4, 1, 1), (5, 2, 1)]
