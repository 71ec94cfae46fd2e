"""The Jaccard join against brute force, with cells split in Spark, and the choice of one row of each component."""

import random
import re

import pytest

pytest.importorskip("public_tokenizers")

from catalume.llm import jaccard  # noqa: E402

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sets(text):
    words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in WORD.findall(text or "")]
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def brute(rows):
    found, up = [sets(t) for _, t in rows], list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(found[i] & found[j])
            if both and 100 * both >= 80 * (len(found[i]) + len(found[j]) - both):
                up[top(i)] = top(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[top(i)] = min(doc_id, least.get(top(i), doc_id))
    return [(d, len(found[i]), least.get(top(i)) if found[i] else d) for i, (d, _) in enumerate(rows)]


def crowd(seed, copies):
    """Near copies of a text at every distance, long and short texts, a passage that all share, repeats, nulls and texts without words."""
    r = random.Random(seed)
    word = lambda: f"w{r.randrange(10**6)}"
    passage, base, out = [word() for _ in range(60)], [word() for _ in range(80)], []
    for i in range(copies):
        x = list(base)
        for at in r.sample(range(80), r.choice([0, 1, 2, 3, 5])):
            x[at] = word()
        out.append(" ".join(x[: 80 - r.choice([0, 0, 10])]))
    for _ in range(40):
        out.append(" ".join([*(word() for _ in range(r.choice([5, 40, 300]))), *passage]))
    out += [" ".join(passage), "one two", "One\ttwo", "a b c d e", "A b c D e f", None, "", " \n", None, "x " * 3000]
    rows = list(enumerate(out))
    return [*rows, (3, rows[3][1]), (4, "other words altogether " * 3), (None, rows[5][1]), (None, "nameless " * 9), (7, None)]


@pytest.mark.parametrize(("texts", "shingles"), [(1024, 1 << 22), (16, 1 << 22), (1024, 600)])
def test_against_brute_force(spark, monkeypatch, texts, shingles):
    monkeypatch.setattr(jaccard, "CELL_TEXTS", texts)
    monkeypatch.setattr(jaccard, "CELL_SHINGLES", shingles)
    rows = crowd(5, 60)
    docs = spark.createDataFrame([(i, t, 0, "x") for i, t in rows], "doc_id long, text string, c int, label string")
    key = lambda x: tuple((v is not None, v or 0) for v in x)
    got = sorted(((x.doc_id, x.n_shingles, x.component_id) for x in jaccard.linked(docs).collect()), key=key)
    assert got == sorted(brute(rows), key=key)


def test_one_of_each(spark):
    same, other = "alpha beta gamma delta epsilon zeta eta", "quite other words in this text here"
    rows = [(1, same), (1, other), (2, same), (3, same.upper()), (4, other), (4, other), (None, same), (None, "words of their own are these here"), (5, None), (5, ""), (6, "  ")]
    rows += [(7, "twice the very same row of words"), (7, "twice the very same row of words")]
    docs = spark.createDataFrame([(i, t, n) for n, (i, t) in enumerate(rows)], "doc_id long, text string, k int")
    got = sorted((x.k for x in jaccard.one_of_each(docs).collect()))
    assert got == [0, 1, 7, 8, 9, 10, 11]
    assert jaccard.one_of_each(docs).columns == docs.columns
    assert jaccard.one_of_each(docs.limit(0)).count() == 0


def test_steps_tell_what_decides(spark):
    r = random.Random(8)
    base = [" ".join(r.choices([f"w{i}" for i in range(4000)], k=120)) for _ in range(40)]
    rows = [(i, x) for i, x in enumerate(base)] + [(100 + 20 * i + j, f"{x} end{j} of{j}") for i, x in enumerate(base[:3]) for j in range(12)] + [(900, None), (901, base[5])]
    x = jaccard.steps(spark.createDataFrame(rows, "doc_id long, text string")).first()
    assert (x.n_sets, x.n_pairs, x.n_left, x.n_large) == (76, 76 * 75 // 2, 39, 0)
    assert x.pairs >= 3 * 13 * 12 // 2 and x.measured > 0 and x.parted + x.compared >= x.pairs
