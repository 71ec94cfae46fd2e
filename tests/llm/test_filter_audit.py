"""The filter audit against a plain walk over every order, with nulls, repeats, copies and clashing columns."""

import random
import re
from collections import Counter
from itertools import permutations

from catalume.llm import audit

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(docs, labels):
    good, toxic = {d for d, q, _ in labels if q == 1 and d is not None}, {d for d, _, t in labels if t == 1 and d is not None}
    least = {}
    for doc_id, text, _ in docs:
        if doc_id is not None:
            least[text or ""] = min(least.get(text or "", doc_id), doc_id)
    out = {}
    for part in {s or "" for _, _, s in docs}:
        rows = []
        for doc_id, text, source in docs:
            if (source or "") == part:
                t, words = text or "", WORD.findall(text or "")
                fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t), "D": bool(re.search("[#$%&*|]", t)), "E": doc_id is not None and doc_id > least[t]}
                rows.append((doc_id, {k for k, v in fails.items() if v}))
        shapley, found = Counter(), {}
        for order in map("".join, permutations("ABCDE")):
            left = list(rows)
            for k, f in enumerate(order):
                gone = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                failing = sum(f in x[1] for x in rows)
                found[order, k + 1] = (len(left), len(gone), failing - len(gone), sum(x[1] == {f} for x in rows), sum(x[0] in good for x in gone), sum(x[0] in toxic for x in gone))
                shapley[f] += len(gone)
        out |= {(part, order, k): (*v, shapley[order[k - 1]]) for (order, k), v in found.items()}
    return out


def fixture():
    r = random.Random(3)
    words = ["a", "b", "Cc", "x#", "long", "é", "Z", "\x0bq"] + [f"w{i}" for i in range(300)]
    texts = [" ".join(r.choices(words, k=r.choice([0, 3, 250, 400]))) for _ in range(30)] + [None, "", "  ", "AB ab", " x"] + ["one two " * 150] * 2 + [" ".join(words[8:]) + "\n"]
    docs = [(i, r.choice(texts), r.choice(["s", "t", None, ""])) for i in range(150)] + [(7, "again", "s"), (7, "again", "s"), (7, "again", "t"), (3, "again", "u"), (None, "again", "s"), (None, None, None)]
    labels = [(i, r.choice([0, 1, None]), r.choice([0, 1, None])) for i in range(0, 150, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1), (10**6, 1, 1)]
    return docs, labels


def test_audit_against_a_walk(spark):
    docs, labels = fixture()
    got = audit.audited(spark.createDataFrame([(*x, 1, "x", 9) for x in docs], "doc_id long, text string, source string, mask int, part string, good int"), spark.createDataFrame([(*x, "x") for x in labels], "doc_id long, quality int, toxic int, digest string")).collect()
    want = plain(docs, labels)
    assert len(got) == len(want) == 600 * len({s or "" for _, _, s in docs})
    assert {(x.part, x.filter_order, x.step): (*(x[m] for m in audit.MEASURES), x.shapley) for x in got} == want


def test_audit_of_nothing(spark):
    out = audit.audited(spark.createDataFrame([], "doc_id long, text string, source string"), spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert out.columns == ["part", "filter_order", "step", *audit.MEASURES, "shapley"] and out.count() == 0


def test_hot_copies_are_counted_before_they_meet(spark):
    docs = [(i, "same text", f"s{i % 3}") for i in range(3000)]
    marked = audit.cells(spark.createDataFrame(docs, "doc_id long, text string, source string"), spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert {(x.part, x.mask): x.n for x in marked.collect()} == {("s0", 1): 1, ("s0", 17): 999, ("s1", 17): 1000, ("s2", 17): 1000}
