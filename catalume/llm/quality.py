"""Quality rules as weak supervision.

Eight rules each vote good (1) or bad (2) on a text or abstain (0). Expectation-maximisation over the counts of vote
patterns, of which there are at most 3^8, estimates how each rule votes on good and on bad texts; a text is kept if the
posterior probability that it is good is at least KEEP. The text is worked on by Spark's built-in functions alone.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalume.llm.common import SPACE, bound, n_words, stored

KEEP = 0.5
STEPS, STILL = 10_000, 1e-9  # the estimate ends when nothing changes by more than STILL, or after so many steps
MEASURES, VOTES = "__quality_measures", "__quality_votes"
RULES = ("length", "word_length", "symbols", "plain_words", "lines", "repeats", "capitals", "endings")
#: Where the estimate starts: the share of good texts, and for a rule that votes, its chance of voting good on a good text and
#: bad on a bad one. The start counts as much as START_TEXTS texts, however many there are.
START_GOOD, RIGHT_ON_GOOD, RIGHT_ON_BAD, START_TEXTS = 0.85, 0.98, 0.4, 20


def repeat_words(text: Column) -> Column:
    """Words in 3-word windows found twice or more, the first included: windows sorted by hash, then positions that they cover."""
    words = F.filter(F.split(text, f"{SPACE}+"), lambda x: x != "")

    def covered(pairs: Column) -> Column:
        same = lambda x, j: F.coalesce(F.get(pairs, j)["h"] == x["h"], F.lit(False))
        hits = F.filter(F.transform(pairs, lambda x, j: F.when(((j > 0) & same(x, F.greatest(j - 1, F.lit(0)))) | same(x, j + 1), x["i"])), lambda i: i.isNotNull())
        start = F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n"))
        return F.aggregate(F.array_sort(hits), start, lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(F.lit(3), i - a["last"])).alias("n")), lambda a: a["n"])

    def of_windows(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(bound(pairs, covered))

    def of_words(w: Column) -> Column:
        hashes = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
        return F.when(F.size(w) < 3, 0).otherwise(bound(hashes, of_windows))

    return bound(words, of_words).cast("long")


def measured(docs: DataFrame) -> DataFrame:
    """docs with a struct MEASURES of what the rules look at. Null text counts as empty."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = lambda f: bound(F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")), f)
    of_lines = lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup"), F.size(F.filter(x, lambda y: y.rlike(r"[.!?:;\"'»”)]\s*$"))).alias("ended"))
    return docs.withColumn(
        MEASURES,
        F.struct(
            n_words(text).alias("n_words"),
            F.char_length(F.regexp_replace(text, SPACE, "")).cast("long").alias("word_chars"),
            (F.char_length(text) - F.char_length(F.translate(text, "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
            F.regexp_count(text, F.lit(r"(?<![^\x20\x09-\x0D])\p{L}++[.,;:!?]?(?![^\x20\x09-\x0D])")).cast("long").alias("n_plain"),
            F.regexp_count(text, F.lit(r"\p{Lu}")).cast("long").alias("n_capitals"),
            repeat_words(text).alias("n_repeat_words"),
            lines(of_lines).alias("lines"),
        ),
    )


def votes(q: Column) -> dict[str, Column]:
    n, chars, lines = q["n_words"], q["word_chars"], q["lines"]["n"]
    vote = lambda good, bad: F.when(bad, 2).when(good, 1).otherwise(0)
    return {
        "length": vote(n >= 100, n < 50),
        "word_length": vote(chars.between(3 * n, 10 * n), (chars < 2 * n) | (chars > 14 * n)),
        "symbols": vote(20 * q["n_symbols"] <= n, 5 * q["n_symbols"] > n),
        "plain_words": vote(10 * q["n_plain"] >= 8 * n, 10 * q["n_plain"] < 7 * n),
        "lines": vote((lines >= 3) & (10 * q["lines"]["dup"] <= lines), (lines >= 3) & (10 * q["lines"]["dup"] > 3 * lines)),
        "repeats": vote(5 * q["n_repeat_words"] <= n, 10 * q["n_repeat_words"] > 4 * n),
        "capitals": vote(10 * q["n_capitals"] <= 2 * chars, 10 * q["n_capitals"] > 4 * chars),
        "endings": vote(2 * q["lines"]["ended"] >= lines, (lines >= 3) & (10 * q["lines"]["ended"] < lines)),
    }


def pattern(q: Column) -> Column:
    """All votes as one number to the base 3."""
    return sum((v * 3**k for k, v in enumerate(votes(q).values())), F.lit(0)).cast("int")


def digits(code: int) -> list[int]:
    return [code // 3**k % 3 for k in range(len(RULES))]


def estimate(counts: dict[int, int], steps: int = STEPS) -> list[float]:
    """Posterior probability of being good for every pattern, after EM over the counts of patterns (in double precision, in order of pattern).

    A rule that abstains says nothing; one that votes has an accuracy on good texts and one on bad texts.
    """
    prior = START_GOOD
    right = [[RIGHT_ON_GOOD, RIGHT_ON_BAD] for _ in RULES]

    def good(code: int) -> float:
        log = math.log(prior) - math.log(1 - prior)
        for (on_good, on_bad), v in zip(right, digits(code)):
            log += (0, math.log(on_good) - math.log(1 - on_bad), math.log(1 - on_good) - math.log(on_bad))[v]
        return 1 / (1 + math.exp(max(-700, min(700, -log))))

    patterns = [(n, code, digits(code)) for code, n in sorted(counts.items())]
    for _ in range(steps if patterns else 0):
        mass = [START_TEXTS * START_GOOD, START_TEXTS * (1 - START_GOOD)]
        voted = [[mass[0], mass[1]] for _ in RULES]
        hits = [[mass[0] * RIGHT_ON_GOOD, mass[1] * RIGHT_ON_BAD] for _ in RULES]
        for n, code, found in patterns:
            p = good(code)
            share = (p * n, (1 - p) * n)
            mass = [mass[0] + share[0], mass[1] + share[1]]
            for k, v in enumerate(found):
                for y in (0, 1) if v else ():
                    voted[k][y] += share[y]
                    hits[k][y] += share[y] * (v == y + 1)
        before = [prior, *(x for pair in right for x in pair)]
        prior = mass[0] / sum(mass)
        right = [[min(0.9999, max(0.0001, h / v)) for h, v in zip(x, y)] for x, y in zip(hits, voted)]
        if max(abs(x - y) for x, y in zip(before, [prior, *(x for pair in right for x in pair)])) < STILL:
            break
    return [good(code) for code in range(3 ** len(RULES))]


def judged(docs: DataFrame) -> DataFrame:
    """All columns of docs and a struct `quality` (accuracies are estimated on the texts that pass the base): n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, probability, kept.

    Null and empty texts have no words and fail. Repeated rows are judged alike and stay; no rows give no rows. A
    column named quality in docs is replaced. Measures are written once, so the text is worked on once.
    """
    q = F.col(MEASURES)
    failed = (q["n_words"] < 50) | (100 * q["n_repeat_words"] > 50 * q["n_words"])
    found = stored(measured(docs.drop("quality")).withColumn(VOTES, pattern(q)), "quality")
    counts = {r["votes"]: r["count"] for r in found.where(~failed).groupBy(F.col(VOTES).alias("votes")).count().collect()}  # at most 3^8 rows
    table = F.from_json(F.lit(json.dumps(estimate(counts))), "array<double>")
    probability = F.get(table, F.col(VOTES))
    verdict = F.struct(q["n_words"].alias("n_words"), q["word_chars"].alias("word_chars"), q["n_symbols"].alias("n_symbols"), q["lines"]["dup"].cast("long").alias("n_dup_lines"), q["n_repeat_words"].alias("n_repeat_words"), failed.alias("base_failed"), probability.alias("probability"), (~failed & (probability >= KEEP)).alias("kept"))
    return found.withColumn("quality", verdict).drop(MEASURES, VOTES)
