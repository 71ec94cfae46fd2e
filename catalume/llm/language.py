"""Language by words first, then by character n-grams.

A known word scores, for each language, its log frequency there. A word that no language knows falls back to its n-grams of
NGRAM characters, then to shorter ones, until some language knows one; it scores their mean. The language
with the greatest mean over the words of a text is predicted. Words are runs of letters, in lower case.

The model is fitted on a bounded sample: about TRAIN_DOCUMENTS documents a language, and TRAIN_TOTAL in all, chosen by a hash of doc_id among all of
that language. It holds every language, word and n-gram of the sample, as sorted hashes with the counts of those languages that have them; nothing
else bounds it. Counts are made by Spark; every document is scored, over its whole text.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalume.llm.common import bound, crc32_of_id, prepare, stored, tidy

TRAIN_DOCUMENTS, TRAIN_TOTAL = 3000, 60_000
NGRAM = 4
MISSING = 1.0  # how many times less often than once a word counts where a language lacks it
EVIDENCE = 20  # words of a text that count as evidence, at most
BROADCAST = 1 << 16  # languages whose counts are sent to all executors
CACHE = 100_000  # words that a task keeps, and four times as many of their entries
SLICE, NUMBERS = 256, 1 << 20  # texts whose words are scored at once, and their scores by language, at most

_WORD = re.compile(r"[^\W\d_]+")


def words(text) -> F.Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"\p{L}+"), F.lit(0))


def word_counts(text: str | None) -> Counter:
    """The runs of letters of text, in lower case, and how often they occur: what words() finds."""
    counts = Counter(_WORD.findall(text.lower())) if text else Counter()
    for odd in [x for x in counts if not x.isalpha()]:  # holds a number that is no digit, like ½
        times = counts.pop(odd)
        for part in "".join(c if c.isalpha() else " " for c in odd).split():
            counts[part] += times
    return counts


class Model:
    """Log frequencies by language of words (level 0) and of n-grams (level n), found by the hash of the term.

    levels: for each, sorted hashes, where the entries of each begin, and of every entry its language and by how much its log frequency is above that of a term that the language lacks.
    lacking: that log frequency, by level and language. So what is known of a term is as long as the list of languages that have it, however many there are.
    """

    def __init__(self, languages: list[str], levels: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]], totals: np.ndarray):
        self.languages = languages
        self.levels = [(keys, cuts, language, np.log(count * (1 + MISSING))) for keys, cuts, language, count in levels]
        self.lacking = -np.log(totals * (1 + MISSING)) if len(languages) else totals

    def known(self, level: int, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Which of hashes the level has; and for each entry of these which of them it is of, its language and what it adds."""
        keys, cuts, language, above = self.levels[level]
        at = np.minimum(np.searchsorted(keys, hashes), max(len(keys) - 1, 0))
        found = keys[at] == hashes if len(keys) else np.zeros(len(hashes), bool)
        at = at[found]
        many = cuts[at + 1] - cuts[at]
        entry = np.repeat(cuts[at] - np.append(0, np.cumsum(many)[:-1]), many) + np.arange(many.sum()) if len(at) else np.zeros(0, np.int64)
        return found, np.repeat(np.flatnonzero(found), many), language[entry], above[entry]

    def weighed(self, terms: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The level at which each word is known, -1 if at none; and for each word and language that has it: the word, the language, and what it adds there. Words fall back to their n-grams, of which it is the mean."""
        level, rows, languages, above = np.full(len(terms), -1), [], [], []
        found, row, language, add = self.known(0, hashed(terms))
        level[found] = 0
        rows, languages, above = [row], [language], [add]
        for k in range(NGRAM, 0, -1):
            left = np.flatnonzero(level < 0)
            grams = [[p[i : i + k] for i in range(len(p) - k + 1)] for p in (f" {terms[i]} " for i in left)]
            owner = np.repeat(np.arange(len(left)), np.array([len(x) for x in grams], np.int64))
            hit, gram, language, add = self.known(k, hashed([x for y in grams for x in y]))
            hits = np.bincount(owner[hit], minlength=len(left))
            level[left[hits > 0]] = k
            rows.append(left[owner[gram]])
            languages.append(language)
            above.append(add / hits[owner[gram]])
        many = max(1, len(self.languages))
        pairs, place = np.unique(np.concatenate(rows) * many + np.concatenate(languages), return_inverse=True)  # n-grams of a word share languages
        return level, pairs // many, (pairs % many).astype(np.int32), np.bincount(place, np.concatenate(above), len(pairs))


def hashed(terms: list[str]) -> np.ndarray:
    """Spark's xxhash64 of each string."""
    from xxhash import xxh64_intdigest

    return np.array([xxh64_intdigest(x.encode(), 42) for x in terms], np.uint64).view(np.int64)


def fit(docs: DataFrame, per_language: int = TRAIN_DOCUMENTS, in_all: int = TRAIN_TOTAL) -> Model:
    """A model from docs (doc_id, text, lang).

    Rows with null lang or text are left out. Nothing to learn from: no languages.
    """
    labelled = docs.select("doc_id", "text", "lang").where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    per_lang = labelled.groupBy("lang").agg(F.count("*").alias("documents"))
    languages = sorted(r["lang"] for r in per_lang.select("lang").collect())
    if not languages:
        return Model([], [], np.zeros((0, 0)))
    rate = max(1, min(per_language, in_all // len(languages))) / F.col("documents")
    draw = F.pmod(F.xxhash64(F.lit("language"), "doc_id"), F.lit(1_000_003)) / 1_000_003.0
    known = F.broadcast(per_lang) if len(languages) <= BROADCAST else per_lang  # else texts would move to one task a language
    sample = labelled.join(known, "lang").where(draw < rate)
    # Counting words before n-grams: an n-gram counts as often as the words that hold it.
    counted = stored(sample.select("lang", F.explode(words(F.col("text"))).alias("term")).groupBy("lang", "term").agg(F.count("*").alias("n")), "language_words")
    padded = F.concat(F.lit(" "), F.col("term"), F.lit(" "))
    gram = lambda k: bound(padded, lambda p: F.transform(F.sequence(F.lit(1), F.greatest(F.char_length(p) - (k - 1), F.lit(1))), lambda i: F.struct(F.lit(k).alias("k"), F.substring(p, i, F.lit(k)).alias("term"))))
    grams = counted.select("lang", "n", F.explode(F.flatten(F.array(*[gram(k) for k in range(1, NGRAM + 1)]))).alias("g")).groupBy("lang", "g.k", "g.term").agg(F.sum("n").alias("n"))
    terms = counted.select("lang", F.lit(0).alias("k"), "term", "n").unionByName(grams)
    numbers = docs.sparkSession.createDataFrame(list(enumerate(languages)), "language int, lang string")
    found = terms.join(numbers, "lang").select("k", F.xxhash64("term").alias("term"), "language", "n").toArrow()  # bounded by the sample
    k, term, language, n = (found.column(i).to_numpy() for i in range(4))
    totals, levels = np.ones((NGRAM + 1, len(languages))), []
    for level in range(NGRAM + 1):
        at = np.flatnonzero(k == level)
        at = at[np.lexsort((language[at], term[at]))]
        first = np.flatnonzero(np.append(True, term[at][1:] != term[at][:-1])) if len(at) else np.zeros(0, np.int64)
        totals[level] = np.maximum(1, np.bincount(language[at], n[at], len(languages)))
        levels.append((term[at][first], np.append(first, len(at)), language[at], n[at].astype(np.float64)))
    return Model(languages, levels, totals)


class Words:
    """Words that a task has met: level, and where the entries of each begin among those of all."""

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.level, self.cuts, self.language, self.above = np.zeros(0, np.int8), np.zeros(1, np.int64), np.zeros(0, np.int32), np.zeros(0)

    def numbers(self, words: list[str], m: Model) -> np.ndarray:
        """The number of each word; new ones are looked up in m."""
        if len(self.known) > CACHE or len(self.above) > 4 * CACHE:
            self.clear()
        if fresh := [w for w in dict.fromkeys(words) if w not in self.known]:
            self.known.update(zip(fresh, range(len(self.known), len(self.known) + len(fresh))))
            level, row, language, above = m.weighed(fresh)
            self.level = np.concatenate([self.level, level.astype(np.int8)])
            self.cuts = np.concatenate([self.cuts, self.cuts[-1] + np.cumsum(np.bincount(row, minlength=len(fresh)))])
            self.language, self.above = np.concatenate([self.language, language]), np.concatenate([self.above, above])
        return np.array([self.known[w] for w in words])

    def entries(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each entry of the words at: which of them, its language, and what it adds."""
        many = self.cuts[at + 1] - self.cuts[at]
        entry = np.repeat(self.cuts[at] - np.append(0, np.cumsum(many)[:-1]), many) + np.arange(many.sum())
        return np.repeat(np.arange(len(at)), many), self.language[entry], self.above[entry]


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of docs, lang_pred and score; columns of these names in docs are replaced.

    Null texts and those without a letter are `und` with score 0, as is any text if no language was learned. score is the
    probability of the predicted language, where each word counts as evidence but no more than EVIDENCE words do in all. Ties go to the first language by code point.
    """
    spark = prepare(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)  # bounded by the sample

    def judged_slice(texts: list[str | None], m: Model, seen: Words) -> tuple[list[str], list[float]]:
        counts = [word_counts(x) for x in texts]
        preds, scores = ["und"] * len(texts), [0.0] * len(texts)
        some = [i for i, c in enumerate(counts) if c]
        if not some or not m.languages:
            return preds, scores
        at = seen.numbers([w for i in some for w in counts[i]], m)
        times = np.array([t for i in some for t in counts[i].values()], np.float64)
        text = np.repeat(np.arange(len(some)), [len(counts[i]) for i in some])
        level = seen.level[at]
        told = np.zeros((len(some), NGRAM + 1))
        np.add.at(told, (text[level >= 0], level[level >= 0]), times[level >= 0])
        which, language, add = seen.entries(at)
        sums = told @ m.lacking + np.bincount(text[which] * len(m.languages) + language, times[which] * add, len(some) * len(m.languages)).reshape(len(some), -1)
        n = told.sum(1)
        best = sums.argmax(1)
        apart = (sums - sums[np.arange(len(some)), best][:, None]) * (np.minimum(n, EVIDENCE) / np.maximum(n, 1))[:, None]
        sure = 1 / np.exp(np.maximum(apart, -700)).sum(1)
        for i, b, p in zip(some, best.tolist(), sure.tolist()):
            preds[i], scores[i] = m.languages[b], p
        return preds, scores

    def score(batches):
        m, seen = shared.value, Words()
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            preds, scores = [], []
            step = max(1, min(SLICE, NUMBERS // max(1, len(m.languages))))
            for i in range(0, len(texts), step):
                p, s = judged_slice(texts.slice(i, step).to_pylist(), m, seen)
                preds += p
                scores += s
            rest = [i for i, f in enumerate(batch.schema) if f.name not in ("lang_pred", "score")]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in rest], pa.array(preds, pa.string()), pa.array(scores, pa.float64())], [*[batch.schema[i].name for i in rest], "lang_pred", "score"])

    kept = docs.drop("lang_pred", "score")
    return kept.mapInArrow(tidy(score), T.StructType([*kept.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]))


def identified(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text, lang, ...) with held_out, lang_pred, score: learned from rows whose crc32(doc_id) mod 4 is not 2. Rows with null doc_id count as held out.

    Columns of docs with these names are replaced. Repeated rows are judged alike; no rows give no rows.
    """
    held_out = F.coalesce(crc32_of_id(F.col("doc_id")) % 4 == 2, F.lit(True))
    model = fit(docs.where(~held_out))
    return predict(docs, model).withColumn("held_out", held_out)
