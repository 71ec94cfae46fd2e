"""Toxicity by class-conditional Kneser-Ney models.

Toxic and ordinary texts each get a bigram model (pairs count once a text) that backs off to continuation counts (in how many contexts a word follows)
of its class, and those to the continuation counts of both classes together. The absolute discounts are fitted from counts of counts, n1 / (n1 + 2 n2), for pairs and
words of each class; on top of them goes what the other class makes one expect, with room for doubt. So of a count stays what its class alone accounts for, and the rest goes to the
shared backoff: an expression that is rare, or about as usual in both classes, is judged alike by both. A text's score compares the two log-likelihoods, divided by its words; the threshold
and slope that turn it into a probability are fitted on training texts that the counts have not seen.

Models are fitted on a bounded sample: about TRAIN_TOXIC and TRAIN_ORDINARY documents, by a hash of doc_id among all labelled ones. One in FIT_SHARE of
them fits threshold and slope. Counts are made by Spark; the model holds what its classes do not judge alike, which the sample bounds. Every document is scored, over its whole text.
"""

from __future__ import annotations

import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalume.llm.common import crc32_of_id, prepare, stored, tidy
from catalume.llm.language import words

TRAIN_TOXIC, TRAIN_ORDINARY = 10_000, 40_000
FIT_SHARE = 4  # one in so many fits threshold and slope
DISCOUNT, TIMES, DOUBT = 0.9, 3.0, 4.0  # the discount counts where no two counts give one
START = ""  # before the first word

_WORD = re.compile(r"[^\W\d_]+")


class Models:
    """Log-likelihood ratios, toxic over ordinary. In pairs, the ordinary class comes first."""

    def __init__(self, model: dict):
        self.words, self.pairs, self.contexts = model["words"], model["pairs"], model["contexts"]
        self.backoff = model["backoff"]
        self.usual = math.log(self.backoff[1] / self.backoff[0])
        self.telling = self.words.keys() | self.contexts.keys()

    def ratio(self, previous: str, word: str) -> float:
        """The word's own part of the ratio, where its class or its pair tells anything."""
        one, context = self.words.get(word), self.contexts.get(previous)
        if one is None:  # neither the class nor any pair tells of this word
            return self.usual + (math.log(context[1] / context[0]) if context else 0)
        share, base = one
        log = []
        for c in (0, 1):
            p = share[c] + self.backoff[c] * base
            if context is not None:
                p = self.pairs.get((previous, word), (0.0, 0.0))[c] + context[c] * p
            log.append(math.log(p))
        return log[1] - log[0]

    def score(self, text: str | None) -> float:
        """Mean ratio over the words of text."""
        found = _WORD.findall((text or "").lower())
        if not all(map(str.isalpha, found)):  # numbers that are no digits, like ½, are no letters
            found = [y for x in found for y in (x if x.isalpha() else "".join(c if c.isalpha() else " " for c in x)).split()]
        if not found:
            return 0.0
        telling = self.telling
        at = [i for i, x in enumerate(found) if x in telling]
        # Elsewhere every word has the usual ratio: only those that tell anything, and those after a context that does, are looked at.
        at = {*at, *(i + 1 for i in at if i + 1 < len(found)), 0}
        apart = sum(self.ratio(found[i - 1] if i else START, found[i]) for i in sorted(at))
        return (apart + self.usual * (len(found) - len(at))) / len(found)


def discounts(counts: DataFrame) -> tuple[float, float]:
    """Of each class, from how many terms (n0, n1: how often a term occurs in the class) occur once and twice in it."""
    found = counts.agg(*[F.count_if(F.col(f"n{c}") == k).alias(f"{c}{k}") for c in (0, 1) for k in (1, 2)]).first()
    return tuple(found[f"{c}1"] / (found[f"{c}1"] + 2 * found[f"{c}2"]) if found[f"{c}1"] and found[f"{c}2"] else DISCOUNT for c in (0, 1))


def excess(n: F.Column, other: F.Column, ratio: float, discount: float) -> F.Column:
    """What of a count n is left when its discount and `ratio` times the other class's count, with room for doubt, are taken from it."""
    expected = (other + 0.5) * ratio
    return F.greatest(F.lit(0.0), n - TIMES * expected - DOUBT * F.sqrt(expected) - discount)


def fit(docs: DataFrame, labels: DataFrame, toxic: int = TRAIN_TOXIC, ordinary: int = TRAIN_ORDINARY) -> dict:
    """A model from docs (doc_id, text) and labels (doc_id, toxic).

    Labels other than 0 and 1 and null texts are left out; equal texts count once. Nothing to learn from: a model for which every text is as likely toxic as not.
    """
    labelled = labels.where(F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    have = {r["toxic"]: r["count"] for r in labelled.groupBy("toxic").count().collect()}
    rate = F.when(F.col("toxic") == 1, min(1.0, toxic / have.get(1, 1))).otherwise(min(1.0, ordinary / have.get(0, 1)))
    hashed = F.pmod(F.xxhash64(F.lit("toxicity"), "doc_id"), F.lit(1_000_003)) / 1_000_003.0
    sample = labelled.where(hashed < rate)
    texts = docs.select("doc_id", "text").where(F.col("text").isNotNull()).join(F.broadcast(sample), "doc_id").groupBy("text").agg(F.max("toxic").alias("toxic"))  # sample: about toxic + ordinary rows
    texts = stored(texts.withColumn("fits", F.pmod(F.xxhash64(F.lit("fits"), "text"), F.lit(FIT_SHARE)) == 0), "toxicity_sample")
    found = texts.where(~F.col("fits")).select("toxic", F.concat(F.array(F.lit(START)), words(F.col("text"))).alias("w"))
    pairs = F.transform(F.slice(F.col("w"), F.lit(2), F.size("w")), lambda x, i: F.concat_ws(" ", F.get(F.col("w"), i), x))  # strings, of which array_distinct keeps a hash set
    by_class = [F.count(F.when(F.col("toxic") == c, 1)).alias(f"n{c}") for c in (0, 1)]
    counted = stored(found.select("toxic", F.explode(F.array_distinct(pairs)).alias("p")).groupBy("p").agg(*by_class).select(F.substring_index("p", " ", 1).alias("before"), F.substring_index("p", " ", -1).alias("word"), "n0", "n1"), "toxicity_pairs")
    one = counted.groupBy("word").agg(F.count_if(F.col("n0") > 0).alias("n0"), F.count_if(F.col("n1") > 0).alias("n1"), F.count("*").alias("both"))
    t = one.agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.sum("both").alias("both"), F.count("*").alias("words")).first()
    tokens = counted.agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).first()
    model: dict = {"words": {}, "pairs": {}, "contexts": {}, "backoff": (1.0, 1.0), "numbers": (0.0, 1.0)}
    if not t["n0"] or not t["n1"]:
        return model
    over = lambda a, b, d: [excess(F.col("n0"), F.col("n1"), a / b, d[0]).alias("e0"), excess(F.col("n1"), F.col("n0"), b / a, d[1]).alias("e1")]
    left = one.select("word", "both", *over(t["n0"], t["n1"], discounts(one))).where((F.col("e0") > 0) | (F.col("e1") > 0))
    for r in sorted(left.collect(), key=lambda r: r["word"]):
        model["words"][r["word"]] = ((r["e0"] / t["n0"], r["e1"] / t["n1"]), (r["both"] + 1) / (t["both"] + t["words"]))
    model["backoff"] = tuple(max(1e-6, 1 - sum(x[0][c] for x in model["words"].values())) for c in (0, 1))
    contexts = counted.groupBy("before").agg(F.sum("n0").alias("c0"), F.sum("n1").alias("c1"))
    left = counted.select("before", "word", *over(tokens["n0"], tokens["n1"], discounts(counted))).where((F.col("e0") > 0) | (F.col("e1") > 0)).join(contexts, "before").join(one.select("word", "both"), "word")
    for r in sorted(left.collect(), key=lambda r: (r["before"], r["word"])):
        model["words"].setdefault(r["word"], ((0.0, 0.0), (r["both"] + 1) / (t["both"] + t["words"])))
        model["pairs"][r["before"], r["word"]] = share = tuple(r[f"e{c}"] / max(r[f"c{c}"], 1) for c in (0, 1))
        model["contexts"][r["before"]] = tuple(max(1e-6, x - y) for x, y in zip(model["contexts"].get(r["before"], (1.0, 1.0)), share))
    points = [(r["score"], r["toxic"]) for r in scored(texts.where("fits").select("text", "toxic"), model, raw=True).select("score", "toxic").collect()]  # about (toxic + ordinary) / FIT_SHARE rows
    return model | {"numbers": calibrated(points)}


def calibrated(points: list[tuple[float, int]]) -> tuple[float, float]:
    """Threshold and slope: the threshold halves the gap at which fewest of points (ratio, label) are wrong; the slope follows their spread."""
    points = sorted(points)
    positives = sum(y for _, y in points)
    if not positives or positives == len(points):
        return 0.0, 1.0
    wrong = best = len(points) - positives  # all above: every ordinary text is wrong
    lows, highs, at = [points[0][0]], [points[0][0]], points[0][0]
    for i, (x, y) in enumerate(points):
        wrong += 1 if y else -1
        following = points[i + 1][0] if i + 1 < len(points) else x
        if following > x or i + 1 == len(points):
            if wrong < best:
                best, at, highs = wrong, x, [following]
    middle = (at + highs[0]) / 2
    spread = sum(abs(x - middle) for x, _ in points) / len(points)
    return middle, 4 / max(spread, 1e-9)


def scored(docs: DataFrame, model: dict, raw: bool = False) -> DataFrame:
    """All columns of docs and score (0 to 1; raw: the mean ratio). Null and empty texts get the score of a ratio of 0. A column named score is replaced."""
    spark = prepare(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)  # bounded by the sample

    def score(batches):
        models, (middle, slope) = Models(shared.value), shared.value["numbers"]
        for batch in batches:
            found = [models.score(x) for x in batch.column(batch.schema.get_field_index("text")).to_pylist()]
            if not raw:
                found = [1 / (1 + math.exp(max(-700.0, min(700.0, -slope * (x - middle))))) for x in found]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.float64())], [*batch.schema.names, "score"])

    kept = docs.drop("score")
    return kept.mapInArrow(tidy(score), T.StructType([*kept.schema.fields, T.StructField("score", T.DoubleType())]))


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs (doc_id, text, ...) with held_out, score, predicted: learned from rows whose crc32(doc_id) mod 5 is not 0. Rows with null doc_id count as held out.

    Columns of docs with these names are replaced. Repeated rows are judged alike; no rows give no rows.
    """
    held_out = F.coalesce(crc32_of_id(F.col("doc_id")) % 5 == 0, F.lit(True))
    model = fit(docs.where(~held_out), labels.where(~held_out))
    return scored(docs, model).withColumn("held_out", held_out).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
