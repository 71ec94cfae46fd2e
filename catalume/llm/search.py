"""Ranked lexical search over an index of document blocks, best documents first.

The index is a Parquet table whose rows are blocks of documents, made where the documents lie: nothing is shuffled. A block has
its documents in ascending doc_id, its vocabulary, and for each term its posting list: places of documents and counts.

To search, the impacts of the posting lists of wanted terms are laid end to end, with a sparse table over them: level k holds where the
greatest of 2^k impacts from each place on is, so the greatest impact of any stretch of a posting list is found from two
entries. What an interval of documents can score at most is the sum of these over an item's terms. Intervals are taken best first:
each is split at the document of its greatest impact, which is scored exactly, and what lies left and right of it is bounded anew; an interval that
cannot reach the k-th best document so far is left. A task carries the best documents of an item from block to block.
"""

from __future__ import annotations

import math
import string
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from catalume.llm.common import prepare, scratch, stored, tidy

#: A block ends with the document that fills either; texts of items that are searched for at once; intervals that are split at once, at first and at most.
BLOCK_BYTES, BLOCK_DOCS, ITEM_BYTES, FIRST, MOST = 1 << 22, 1 << 13, 1 << 21, 16, 256
BINARY = ("ids", "no_id", "lengths", "vocabulary", "starts", "places", "counts")
SCHEMA = "n_docs long, n_terms long, " + ", ".join(f"{c} binary" for c in BINARY)
_LETTERS = frozenset((string.ascii_letters + string.digits).encode()) | frozenset(range(128, 256))
_PLAIN = bytes(x if x in _LETTERS else 32 for x in range(256)).lower()


def terms(raw: bytes) -> list[bytes]:
    """Terms of a text in UTF-8, in order: letters and digits of ASCII, in lower case, and all that is not ASCII."""
    return raw.translate(_PLAIN).split()


def block_of(ids: list, numbers: list[np.ndarray], vocabulary: list[bytes]) -> dict:
    """A row of the index. numbers: for each document the places of its terms in vocabulary."""
    n = len(ids)
    order = np.array(sorted(range(n), key=lambda k: (ids[k] is None, ids[k] or 0)), np.int64)
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    lengths = np.array([len(x) for x in numbers], np.int64)
    pairs, counts = np.unique(np.concatenate(numbers).astype(np.int64) * n + np.repeat(place, lengths), return_counts=True)
    return {
        "n_docs": int((lengths > 0).sum()),
        "n_terms": int(lengths.sum()),
        "ids": np.array([ids[k] or 0 for k in order], "<i8").tobytes(),
        "no_id": np.array([ids[k] is None for k in order], np.uint8).tobytes(),
        "lengths": lengths[order].astype("<i8").tobytes(),
        "vocabulary": b" ".join(vocabulary),
        "starts": np.searchsorted(pairs, np.arange(len(vocabulary) + 1) * n).astype("<u4").tobytes(),
        "places": (pairs % n).astype("<u4").tobytes(),
        "counts": counts.astype("<u4").tobytes(),
    }


def write(docs: DataFrame, path: str, block_bytes: int | None = None, block_docs: int | None = None) -> None:
    """Index every row and whole text of docs (doc_id, text; other columns are ignored). Null and empty texts have no terms. No rows, no blocks."""
    prepare(docs.sparkSession)
    most_bytes, most_docs = block_bytes or BLOCK_BYTES, block_docs or BLOCK_DOCS
    schema = pa.schema([("n_docs", pa.int64()), ("n_terms", pa.int64()), *((c, pa.binary()) for c in BINARY)])

    def build(batches):
        def fresh():
            vocabulary = defaultdict()
            vocabulary.default_factory = vocabulary.__len__
            return [], [], vocabulary, 0

        ids, numbers, vocabulary, size = fresh()
        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                some = batch.slice(i, 64)
                for doc_id, raw in zip(some.column(0).to_pylist(), some.column(1).to_pylist()):
                    found = terms(raw or b"")
                    ids.append(doc_id)
                    numbers.append(np.fromiter(map(vocabulary.__getitem__, found), np.uint32, len(found)))
                    size += len(raw or b"")
                    if size >= most_bytes or len(ids) >= most_docs:
                        yield pa.RecordBatch.from_pylist([block_of(ids, numbers, list(vocabulary))], schema)
                        ids, numbers, vocabulary, size = fresh()
        if ids:
            yield pa.RecordBatch.from_pylist([block_of(ids, numbers, list(vocabulary))], schema)

    texts = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    texts.mapInArrow(tidy(build), SCHEMA).write.option("parquet.block.row.count.limit", "16").parquet(path)


def frequencies(index: DataFrame, wanted: list[bytes]) -> np.ndarray:
    """How many documents hold each wanted term."""

    def count(batches):
        number = {w: k for k, w in enumerate(wanted)}
        total = np.zeros(len(wanted), np.int64)
        for batch in batches:
            for words, starts in zip(batch.column(0), batch.column(1)):
                df = np.diff(np.frombuffer(starts.as_buffer(), "<u4").astype(np.int64))
                for k, w in enumerate(words.as_py().split()):
                    if w in number:
                        total[number[w]] += df[k]
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["term", "df"])

    out = np.zeros(len(wanted), np.int64)
    for r in index.select("vocabulary", "starts").mapInArrow(tidy(count), "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():  # at most one row a wanted term
        out[r["term"]] = r["df"]
    return out


class Lists:
    """Posting lists of the wanted terms of a block, end to end, with their impacts (weight included) and a sparse table over them."""

    def __init__(self, row: dict, number: dict[bytes, int], weights: np.ndarray, n_all: int, l_all: int):
        self.ids, self.no_id = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["no_id"], np.uint8)
        self.n = n = len(self.ids)
        starts = np.frombuffer(row["starts"], "<u4").astype(np.int64)
        here = [(number[w], k) for k, w in enumerate(row["vocabulary"].split()) if w in number]
        self.at = {term: k for k, (term, _) in enumerate(here)}
        own = np.array([k for _, k in here], np.int64)
        sizes = starts[own + 1] - starts[own]
        self.ends = np.cumsum(sizes)
        self.begins = self.ends - sizes
        size = int(sizes.sum())
        source = np.repeat(starts[own] - self.begins, sizes) + np.arange(size)
        self.places = np.frombuffer(row["places"], "<u4")[source].astype(np.int64)
        tf = np.frombuffer(row["counts"], "<u4")[source].astype(np.int64)
        m = np.array([10 + 90 * x * n_all // l_all for x in np.frombuffer(row["lengths"], "<i8").tolist()], np.int64)
        self.impacts = np.repeat(weights[[t for t, _ in here]] if here else np.zeros(0, np.int64), sizes) * (1_000_000_000 * tf // (1000 * tf + 8 * m[self.places]))
        self.keys = np.repeat(np.arange(len(here)) * n, sizes) + self.places
        self.log = np.zeros(n + 2, np.int64)
        for k in range(2, n + 2):
            self.log[k] = self.log[k >> 1] + 1
        levels = [np.arange(size, dtype=np.int32)]
        for k in range(int(self.log[int(sizes.max(initial=1))])):
            low, half = levels[-1], 1 << k
            next_level = low.copy()
            a, b = low[:-half], low[half:]
            next_level[:-half] = np.where(self.impacts[b] > self.impacts[a], b, a)
            levels.append(next_level)
        self.size, self.table = size, np.concatenate(levels)

    def greatest(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The greatest impact of each stretch [low, high) of the lists and where it is; 0 for an empty one."""
        some = np.flatnonzero(high.ravel() > low.ravel())
        a, b = low.ravel()[some], high.ravel()[some]
        k = self.log[b - a]
        i, j = self.table[k * self.size + a], self.table[k * self.size + b - (1 << k)]
        x, y = self.impacts[i], self.impacts[j]
        value, where = np.zeros(low.size, np.int64), np.zeros(low.size, np.int64)
        value[some], where[some] = np.maximum(x, y), np.where(y > x, j, i)
        return value.reshape(low.shape), where.reshape(low.shape)

    def search(self, item: list[int], best: list[tuple], top: int) -> list[tuple]:
        """best (of blocks before) and the documents of this block: the top ones as (-score, no_id, doc_id), in that order."""
        lists = np.array([self.at[t] for t in item if t in self.at], np.int64)
        if not len(lists):
            return best
        first, last, low, high = np.zeros(1, np.int64), np.full(1, self.n), self.begins[lists][None], self.ends[lists][None]
        value, where = self.greatest(low, high)
        bound, split = value.sum(axis=1), where[np.arange(1), value.argmax(axis=1)]
        width = FIRST
        while True:
            alive = bound > 0
            if len(best) == top:
                worst, no_id, doc_id = best[-1]
                alive &= bound >= -worst
                tied = np.flatnonzero(alive & (bound == -worst))
                if len(tied):  # of equal scores, the smaller id counts: the smallest of an interval is its first
                    names = list(zip(self.no_id[first[tied]].tolist(), self.ids[first[tied]].tolist()))
                    alive[tied] = [x < (no_id, doc_id) for x in names]
            if not alive.all():
                first, last, low, high, bound, split = (x[alive] for x in (first, last, low, high, bound, split))
            if not len(bound):
                return best
            taken = np.ones(len(bound), bool)
            if len(bound) > width:
                taken[:] = False
                taken[np.argpartition(-bound, width - 1)[:width]] = True
            width = min(MOST, width * 2)
            doc = self.places[split[taken]]
            middle = np.searchsorted(self.keys, lists * self.n + doc[:, None])
            there = np.minimum(middle, self.size - 1)
            holds = (middle < high[taken]) & (self.keys[there] == lists * self.n + doc[:, None])
            scores = np.where(holds, self.impacts[there], 0).sum(axis=1)
            if len(best) == top:
                fit = scores >= -best[-1][0]
                found = doc[fit], scores[fit]
            else:
                found = doc, scores
            best = sorted([*best, *((-s, n, i) for s, n, i in zip(found[1].tolist(), self.no_id[found[0]].tolist(), self.ids[found[0]].tolist()) if s > 0)])[:top]
            parts_low = np.concatenate([low[taken], middle + holds])
            parts_high = np.concatenate([middle, high[taken]])
            value, where = self.greatest(parts_low, parts_high)
            best_term = value.argmax(axis=1)
            rest = ~taken
            first, last = np.concatenate([first[rest], first[taken], doc + 1]), np.concatenate([last[rest], doc, last[taken]])
            low, high = np.concatenate([low[rest], parts_low]), np.concatenate([high[rest], parts_high])
            bound = np.concatenate([bound[rest], value.sum(axis=1)])
            split = np.concatenate([split[rest], where[np.arange(len(where)), best_term]])


def weight(df: int, n_all: int) -> int:
    return math.floor(1000 * math.log((2 * n_all + 2) / (2 * df + 1)))


def ranked(index: DataFrame, items: DataFrame, top: int = 10) -> DataFrame:
    """item_id, rank (from 1), doc_id and score of the top documents of the index for each row of items (item_id, text; other columns are ignored), equal scores by ascending doc_id, null last.

    Null texts, and those none of whose terms is in a document, have no rows; rows of items that share an id are ranked each for itself. Items are searched for
    in blocks of about ITEM_BYTES of text, so that what is sent to tasks is bounded; a block of them is a pass over the index.
    """
    spark = prepare(index.sparkSession)
    asked = stored(items.select("item_id", F.monotonically_increasing_id().alias("query"), F.coalesce("text", F.lit("")).cast("binary").alias("text")), "items")
    n_all, l_all = (x or 0 for x in index.agg(F.sum("n_docs"), F.sum("n_terms")).first())
    none = spark.createDataFrame([], "query long, item_id long, doc_id long, score long")
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = math.ceil(size / ITEM_BYTES) if l_all else 0
    found = none
    for part in range(parts):
        some = asked.where(F.pmod(F.xxhash64("query"), F.lit(parts)) == part).collect()  # about ITEM_BYTES
        found = found.unionByName(_searched(index, [(r["query"], r["item_id"], set(terms(bytes(r["text"])))) for r in some], n_all, l_all, top))
    best = W.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")


def _searched(index: DataFrame, asked: list[tuple[int, int, set[bytes]]], n_all: int, l_all: int, top: int) -> DataFrame:
    """query, item_id, doc_id, score: for each task the top documents of its blocks."""
    wanted = sorted(set().union(*(x for _, _, x in asked)))
    weights = np.array([weight(df, n_all) for df in frequencies(index, wanted).tolist()], np.int64)
    number = {w: k for k, w in enumerate(wanted)}
    queries = [(q, i, [number[w] for w in sorted(x)]) for q, i, x in asked if x]

    def search(batches):
        best: list[list[tuple]] = [[] for _ in queries]
        for batch in batches:
            for k in range(batch.num_rows):
                lists = Lists(batch.slice(k, 1).to_pylist()[0], number, weights, n_all, l_all)
                for q, (_, _, item) in enumerate(queries):
                    best[q] = lists.search(item, best[q], top)
        rows = [(query, item_id, None if no_id else doc_id, -s) for (query, item_id, _), x in zip(queries, best) for s, no_id, doc_id in x]
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], pa.int64()) for c in range(4)], ["query", "item_id", "doc_id", "score"])

    return index.select("lengths", *[c for c in BINARY if c != "lengths"]).mapInArrow(tidy(search), "query long, item_id long, doc_id long, score long")


def searched(docs: DataFrame, items: DataFrame, top: int = 10) -> DataFrame:
    """ranked() over an index of docs, written to the shared folder."""
    path = scratch(docs.sparkSession, "search")
    write(docs, path)
    return ranked(docs.sparkSession.read.schema(SCHEMA).parquet(path), items, top)


ORACLE = """WITH tokens AS (SELECT doc_id, row, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM (SELECT *, row_number() OVER () AS row FROM documents)),
 tf AS (SELECT row, any_value(doc_id) AS doc_id, term, count(*) AS tf FROM tokens GROUP BY row, term),
 lengths AS (SELECT row, sum(tf) AS n FROM tf GROUP BY row),
 whole AS (SELECT count(*) AS n_all, sum(n) AS l_all FROM lengths),
 asked AS (SELECT DISTINCT item_id, query, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM (SELECT *, row_number() OVER () AS query FROM benchmark)),
 df AS (SELECT term, count(*) AS df FROM tf WHERE term IN (SELECT term FROM asked) GROUP BY term),
 impacts AS (SELECT tf.row, doc_id, tf.term, CAST(floor(1000 * ln(CAST(2 * n_all + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) * ((1000000000 * tf) // (1000 * tf + 8 * (10 + CAST((90 * n * n_all) // l_all AS BIGINT)))) AS impact
   FROM tf JOIN df ON tf.term = df.term JOIN lengths ON tf.row = lengths.row, whole),
 scores AS (SELECT query, item_id, row, doc_id, sum(impact) AS score FROM asked JOIN impacts ON asked.term = impacts.term GROUP BY ALL HAVING sum(impact) > 0),
 best AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, doc_id) AS rank FROM scores)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score FROM best WHERE rank <= 10"""
