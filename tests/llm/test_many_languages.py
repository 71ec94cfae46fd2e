"""Language identification with thousands of languages: sparse scores against plain ones, and memory that follows what is known."""

import math
import random
from collections import Counter

import numpy as np

from catalume.llm import language


def plain_scores(model_of, text, languages):
    """Sums of log frequencies by language, from plain dictionaries."""
    words, grams = model_of
    sums = np.zeros(len(languages))
    for word, times in language.word_counts(text).items():
        for k in (0, 4, 3, 2, 1):
            table = words if k == 0 else grams[k]
            padded = f" {word} "
            terms = [word] if k == 0 else [padded[i : i + k] for i in range(len(padded) - k + 1)]
            hits = [t for t in terms if t in table["terms"]]
            if hits:
                for j, lang in enumerate(languages):
                    sums[j] += times * sum(math.log(table["terms"][t].get(lang, 0.5) / max(1, table["totals"][lang])) for t in hits) / len(hits)
                break
    return sums


def test_sparse_scores_are_the_plain_ones(spark):
    r = random.Random(3)
    languages = ["aa", "bb", "cc"]
    letters = dict(zip(languages, ("abcde", "cdefg", "xyzab")))
    word = lambda lang: "".join(r.choices(letters[lang], k=r.randint(1, 5)))
    rows = [(i, " ".join(word(lang) for _ in range(12)), lang) for i in range(60) for lang in [languages[i % 3]]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(docs)
    tables = {k: {"terms": {}, "totals": Counter()} for k in range(5)}
    counted = Counter((lang, w) for _, text, lang in rows for w in text.split())
    for (lang, w), n in counted.items():
        padded = f" {w} "
        for k in range(5):
            for t in [w] if k == 0 else [padded[i : i + k] for i in range(max(1, len(padded) - k + 1))]:
                tables[k]["terms"].setdefault(t, Counter())[lang] += n
                tables[k]["totals"][lang] += n
    seen = language.Words()
    for text in ["abc abc xyz", "qqq", "cde zz y", "edcba gfedc zyxab b", "é a"]:
        counts = language.word_counts(text)
        at, times = seen.numbers(list(counts), model), np.array(list(counts.values()), float)
        level = seen.level[at]
        got = sum((t * model.lacking[k] for k, t in zip(level, times) if k >= 0), np.zeros(3))
        which, lang, add = seen.entries(at)
        np.add.at(got, lang, times[which] * add)
        assert np.allclose(got, plain_scores((tables[0], tables), text, languages))


def test_thousands_of_languages(spark):
    r = random.Random(2)
    n = 3000
    name = lambda i: "".join(chr(97 + int(c)) for c in f"{i:05}")
    rows = [(2 * i + k, " ".join(f"{name(i)}{r.choice('xyz')}" for _ in range(4)), f"l{i:05}") for i in range(n) for k in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(docs, in_all=10 * n)
    assert len(model.languages) == n and sum(len(x[3]) for x in model.levels) < 60 * n
    out = language.predict(docs, model).select("lang", "lang_pred").collect()
    assert sum(x.lang == x.lang_pred for x in out) > 0.99 * len(out)
