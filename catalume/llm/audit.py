"""How filters interact: for every order in which they may be applied, what each step keeps, removes and loses.

A document is reduced to a mask, one bit a filter that it fails, and documents to cells: weights of each mask in each part.
A cell folds across all orders at once: `transform` over the array of orders, `aggregate` over the steps of an order. The
structs that come out, one for each order and step, are summed element by element over the cells of a part, of which there are
at most 2^5. The orders are 120 constants of the plan, and nothing but sums ever meets by a key.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalume.llm.common import SPACE, bound, stored

FILTERS = "ABCDE"
MEASURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
WEIGHTS = ("n", "good", "toxic")


def own_mask(text: Column) -> Column:
    """Which filters a text that is not null fails by itself: A to D, from bit 0 on. Its words are split once."""
    bit = lambda fails, k: F.when(fails, 1 << k).otherwise(0)
    words = F.array_remove(F.split(text, SPACE + "+"), "")
    few = bound(words, lambda w: bit(F.size(w) < 200, 0) + bit(100 * F.size(F.array_distinct(w)).cast("long") < 50 * F.size(w).cast("long"), 1))
    return few + bit(100 * F.regexp_count(text, F.lit("[A-Z]")).cast("long") > 2 * F.length(text).cast("long"), 2) + bit(text.rlike("[#$%&*|]"), 3)


def marked(docs: DataFrame) -> DataFrame:
    """doc_id, part, digest of the text, and mask of the filters A to D that it fails."""
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), F.sha2(text, 256).alias("digest"), own_mask(text).alias("mask"))


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, and n, good, toxic: how many documents of the part fail just the filters of mask, and how many of these are labelled so.

    Documents that share all but their doc_id are counted together before they meet others of the same text, so that copies of one text,
    however many, are few rows by then. Of copies, those with the smallest doc_id pass E.
    """
    said = labels.where("doc_id is not null").groupBy("doc_id").agg(F.coalesce(F.bool_or(F.col("quality") == 1), F.lit(False)).alias("good"), F.coalesce(F.bool_or(F.col("toxic") == 1), F.lit(False)).alias("toxic"))
    kind = ["digest", "part", "mask", "good", "toxic"]
    known = marked(docs).join(said, "doc_id", "left").fillna(False, ["good", "toxic"])
    rows = known.groupBy("doc_id", *kind).agg(F.count("*").alias("n"))  # one row a document: rows that repeat are counted
    kinds = rows.groupBy(*kind).agg(F.sum("n").alias("n"), F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))).alias("first"), F.coalesce(F.sum(F.when(F.col("doc_id").isNull(), F.col("n"))), F.lit(0)).alias("n_null"))
    kinds = stored(kinds, "audit_kinds")  # it is read twice, the texts once
    first = kinds.groupBy("digest").agg(F.min("first.doc_id").alias("least"))
    least = kinds.join(first, "digest").withColumn("passing", F.col("n_null") + F.when(F.col("first.doc_id") == F.col("least"), F.col("first.n")).otherwise(0))
    halves = F.explode(F.array(F.struct("mask", F.col("passing").alias("m")), F.struct((F.col("mask") + 16).alias("mask"), (F.col("n") - F.col("passing")).alias("m"))))
    each = least.select("part", "good", "toxic", halves.alias("half")).select("part", "good", "toxic", "half.*").where("m > 0")
    of = lambda c: F.sum(F.when(F.col(c), F.col("m")).otherwise(0)).alias(c)
    return each.groupBy("part", "mask").agg(F.sum("m").alias("n"), of("good"), of("toxic"))


def orders(filters: str = FILTERS) -> Column:
    """All orders of the filters, each an array of their bits, as one constant array."""
    return F.array(*[F.array(*[F.lit(1 << filters.index(x)) for x in order]) for order in permutations(filters)])


def folded(cell: Column) -> Column:
    """What a cell (struct of mask and WEIGHTS) adds to MEASURES of each order and step: an array of orders * steps structs."""
    nothing = F.lit(0).cast("long")

    def step(state: Column, bit: Column) -> Column:
        fails = cell["mask"].bitwiseAND(bit) != 0
        now, later = fails & ~state["gone"], fails & state["gone"]
        weigh = lambda when, weight: F.when(when, cell[weight]).otherwise(nothing)
        row = F.struct(
            weigh(~(state["gone"] | fails), "n").alias("kept"),
            weigh(now, "n").alias("removed"),
            weigh(later, "n").alias("redundant"),
            weigh(cell["mask"] == bit, "n").alias("unique_fails"),
            weigh(now, "good").alias("good_lost"),
            weigh(now, "toxic").alias("toxic_lost"),
        )
        return F.struct((state["gone"] | fails).alias("gone"), F.concat(state["rows"], F.array(row)).alias("rows"))

    none = F.from_json(F.lit("[]"), "array<struct<" + ",".join(f"{m}:bigint" for m in MEASURES) + ">>")
    start = F.struct(F.lit(False).alias("gone"), none.alias("rows"))
    return F.flatten(F.transform(orders(), lambda order: F.aggregate(order, start, step, lambda state: state["rows"])))


def added(a: Column, b: Column) -> Column:
    """Two arrays of MEASURES, summed element by element."""
    return F.zip_with(a, b, lambda x, y: F.struct(*[(x[m] + y[m]).alias(m) for m in MEASURES]))


def audited(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filter_order, step (1 to 5), MEASURES and shapley (what the step's filter removes, summed over all orders) of docs (doc_id, text, source; other columns are ignored).

    labels: doc_id, quality, toxic; a document that is labelled more than once counts as good or toxic if one label says so. Null texts are empty, and null sources the part of the empty string. Rows that share
    doc_id and text are not each other's copies and count each; a null doc_id is neither smaller nor larger than another. No documents: no parts, no rows.
    """
    cell = F.struct("mask", *WEIGHTS)
    per_part = cells(docs, labels).groupBy("part").agg(F.collect_list(cell).alias("cells"))  # at most 32 each
    parts = per_part.select("part", F.aggregate(F.slice("cells", 2, 31), folded(F.col("cells")[0]), lambda acc, c: added(acc, folded(c))).alias("rows"))
    names, letters = ["".join(x) for x in permutations(FILTERS)], [x for order in permutations(FILTERS) for x in order]
    named = F.transform("rows", lambda row, i: F.struct(F.get(F.lit(letters), i).alias("letter"), row.alias("row")))
    totals = F.transform(F.lit(list(FILTERS)), lambda x: F.aggregate(F.col("named"), F.lit(0).cast("long"), lambda acc, r: acc + F.when(r["letter"] == x, r["row"]["removed"]).otherwise(0)))
    out = parts.select("part", named.alias("named")).select("part", "named", F.map_from_arrays(F.lit(list(FILTERS)), totals).alias("totals"))
    flat = out.select("part", "totals", F.posexplode("named").alias("i", "one"))
    at = F.col("i").cast("int")
    return flat.select("part", F.get(F.lit(names), F.floor(at / 5).cast("int")).alias("filter_order"), (at % 5 + 1).cast("int").alias("step"), *[F.col(f"one.row.{m}").alias(m) for m in MEASURES], F.col("totals")[F.col("one.letter")].alias("shapley"))


ORACLE = """WITH text_of AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
 counted AS (SELECT *, list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w, min(doc_id) OVER (PARTITION BY t) AS least FROM text_of),
 said AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY 1),
 failing AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
   [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w), 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t), regexp_matches(t, '[#$%&*|]'), coalesce(counted.doc_id > least, false)] AS fails
   FROM counted LEFT JOIN said ON counted.doc_id = said.doc_id),
 cells AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM failing GROUP BY ALL),
 letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l, unnest([1, 2, 3, 4, 5]) AS k),
 perms AS (SELECT [a.k, b.k, c.k, d.k, e.k] AS p, a.l || b.l || c.l || d.l || e.l AS filter_order FROM letters a, letters b, letters c, letters d, letters e
   WHERE len(list_distinct([a.k, b.k, c.k, d.k, e.k])) = 5),
 steps AS (SELECT p, filter_order, step FROM perms, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
 folds AS (SELECT part, filter_order, step, p[step] AS filter, n, good, toxic, fails[p[step]] AS fail, len(list_filter(p[1:step - 1], lambda x: fails[x])) > 0 AS gone, len(list_filter(fails, lambda x: x)) AS n_fails FROM cells, steps),
 sums AS (SELECT part, filter_order, step, filter,
   sum(CASE WHEN NOT fail AND NOT gone THEN n ELSE 0 END) AS kept, sum(CASE WHEN fail AND NOT gone THEN n ELSE 0 END) AS removed,
   sum(CASE WHEN fail AND gone THEN n ELSE 0 END) AS redundant, sum(CASE WHEN fail AND n_fails = 1 THEN n ELSE 0 END) AS unique_fails,
   sum(CASE WHEN fail AND NOT gone THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN fail AND NOT gone THEN toxic ELSE 0 END) AS toxic_lost
   FROM folds GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
 CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, filter) AS BIGINT) AS shapley FROM sums"""
