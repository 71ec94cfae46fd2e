"""Mixing sources to target sizes by pivotal rounding.

Every document of a source should be taken rate = target / size of source times: the whole part for certain, the
rest with a probability. Pivotal rounding settles these probabilities two at a time: it moves words between two documents, in
a random direction that keeps both expectations, until one of them is taken or left. Words are conserved, so a source's
words come out right but for the one document left over. Documents are settled in small groups, then the groups' left-over
documents in a tree, so no task holds a source.
"""

from __future__ import annotations

import zlib
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from catalume.llm.common import n_words, prepare, stored

SHARE, MOST = 1.5, 2.0
WEIGHTS = (3, 1, 2)
LEAF, FAN = 2048, 64


def numbered(sizes: DataFrame) -> DataFrame:
    """sizes with `nth`: how many sources come before, in order of code points, null last. Sources are ranged over tasks and counted there, so none holds them all."""
    order = [F.col("source").isNull(), F.col("source").cast("binary")]
    ranged = stored(sizes.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()), "mix_ranged")
    part = F.shiftright("at", 33)
    parts = ranged.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))  # one row a task
    nth = F.col("before") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    return ranged.withColumn("part", part).join(parts.select("part", before.alias("before")), "part").withColumn("nth", nth).drop("part", "before", "at")


def targets(sizes: DataFrame, share: float = SHARE, most: float = MOST, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """source, source_size, n_docs, target: from one row per source (source, source_size, n_docs).

    Sources in order of code points, null last, weigh `weights` in turn. A target is the lesser of level x weight and most x size;
    the level is the one at which targets add up to share x all sizes. It rises from below: what sources that are full leave over is shared among the
    others, until no more fill up. Each step sums over all sources.
    """
    weight = F.get(F.array(*map(F.lit, weights)), (F.col("nth") % len(weights)).cast("int")).cast("double")
    df = stored(numbered(sizes).withColumn("weight", weight).withColumn("cap", most * F.col("source_size")).drop("nth"), "mix_weights")
    total = share * (df.agg(F.sum("source_size")).first()[0] or 0.0)
    level, full = 0.0, -1
    while True:
        fills = F.col("cap") <= level * F.col("weight")
        r = df.agg(F.count_if(fills).alias("full"), F.sum(F.when(fills, F.col("cap"))).alias("cap"), F.sum(F.when(~fills, F.col("weight"))).alias("weight")).first()
        if r["full"] == full or not r["weight"]:
            level = level if r["weight"] else float("inf")
            break
        full, level = r["full"], max(level, (total - (r["cap"] or 0.0)) / r["weight"])
    return df.select("source", "source_size", "n_docs", F.least(F.col("cap"), F.lit(level) * F.col("weight")).alias("target"))


def chance(seed: int, *what) -> float:
    """A number in (0, 1) that depends on its arguments alone."""
    value = zlib.crc32(repr((seed, *what)).encode())
    value = (value ^ (value >> 16)) * 0x45D9F3B & 0xFFFFFFFF
    value = (value ^ (value >> 16)) * 0x45D9F3B & 0xFFFFFFFF
    return ((value ^ (value >> 16)) + 0.5) / 2**32


def settle(rows: list[tuple[int, int, float]], seed: int, last: bool) -> list[tuple[float, bool]]:
    """For each of rows (key, size, probability), in a fixed order: probability or outcome, and whether it is one; all but one are."""
    out: list[tuple[float, bool]] = [(p, False) for _, _, p in rows]
    held = None
    for k, (key, n, y) in enumerate(rows):
        if y <= 0 or y >= 1 or n == 0:
            out[k] = (float(chance(seed, key) < y), True)
        elif held is None:
            held = k
        else:
            other, m, _ = rows[held]
            x = out[held][0]
            up, down = min((1 - x) * m, y * n), min(x * m, (1 - y) * n)  # words that may move to the one held, or from it
            moved = up if chance(seed, other, key, "pair") * (up + down) < down else -down
            pair = {held: x + moved / m, k: y - moved / n}
            held = None
            for i, p in pair.items():
                if p < 1e-12 or p > 1 - 1e-12:
                    out[i] = (float(round(p)), True)
                else:
                    out[i], held = (p, False), i
    if held is not None and last:
        out[held] = (float(chance(seed, rows[held][0], "last") < out[held][0]), True)
    return out


def mixed(docs: DataFrame, seed: int = 17) -> DataFrame:
    """All columns of docs and a struct `mix`: size, source_size, target, copies, taken (words).

    Null texts and empty ones have size 0; null is a source of its own. Groups are formed by a hash of doc_id and text, and within a
    group rows go in order of doc_id, so reruns agree; repeated rows are settled each on its own. No rows give no rows.
    """
    prepare(docs.sparkSession)
    # One row per document, numbered by nothing but its content; rows that are equal in that share their number's runs.
    own = [c for c in docs.columns if c != "mix"]
    sized = docs.select(*own, n_words(F.col("text")).alias("__mix_size"), F.xxhash64("doc_id", "text", "source").alias("__mix_key"))
    keys = stored(sized.groupBy("source", F.col("__mix_key").alias("key"), F.col("__mix_size").alias("one")).agg(F.count("*").alias("rows")), "mix_keys")
    sources = stored(targets(keys.groupBy("source").agg(F.sum(F.col("one") * F.col("rows")).cast("double").alias("source_size"), F.count("*").alias("n_docs"))), "mix_sources")
    named = sources.withColumnRenamed("source", "s")
    joined = keys.join(named, F.col("source").eqNullSafe(F.col("s")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    # Equal rows of a key are taken or left together: k rows count as one document of k times the size.
    leaf = F.pmod(F.xxhash64("key", F.lit(seed)), F.ceil(F.col("n_docs") / LEAF))
    level = joined.select("source", leaf.alias("leaf"), "key", "one", (F.col("one") * F.col("rows")).alias("size"), (rate - F.floor(rate)).alias("p"))
    groups = sources.agg(F.max(F.ceil(F.col("n_docs") / LEAF))).first()[0] or 0
    done = []
    depth = 0
    while groups:
        last, salt = groups <= 1, seed + depth

        def settled(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values(["key", "one"])
            found = settle(list(zip(pdf["key"].tolist(), pdf["size"].tolist(), pdf["p"].tolist())), salt, last)
            return pdf.assign(p=[x[0] for x in found], settled=[x[1] for x in found])

        found = stored(level.groupBy("source", "leaf").applyInPandas(settled, "source string, leaf long, key long, one long, size long, p double, settled boolean"), f"mix_level{depth}")
        done.append(found.where("settled"))
        level = found.where(~F.col("settled")).select("source", F.floor(F.col("leaf") / FAN).cast("long").alias("leaf"), "key", "one", "size", "p")
        groups = 0 if last else -(-groups // FAN)
        depth += 1
    if not done:
        return docs.limit(0).select(*own, F.expr("named_struct('size', 0L, 'source_size', 0L, 'target', 0D, 'copies', 0, 'taken', 0L)").alias("mix"))
    drawn = reduce(DataFrame.unionByName, done).join(named, F.col("source").eqNullSafe(F.col("s")))
    copies = (F.floor(rate) + F.col("p")).cast("int")
    taken = F.struct(F.col("one").alias("size"), F.col("source_size").cast("long").alias("source_size"), "target", copies.alias("copies"), (copies * F.col("one")).alias("taken"))
    drawn = drawn.select(F.col("source").alias("__mix_source"), F.col("key").alias("__mix_drawn"), taken.alias("mix"))
    same = (F.col("__mix_key") == F.col("__mix_drawn")) & F.col("source").eqNullSafe(F.col("__mix_source")) & (F.col("__mix_size") == F.col("mix.size"))
    return sized.join(drawn, same).select(*own, "mix")


def repeated(docs: DataFrame) -> DataFrame:
    """The rows of docs as often as the mix takes them. A column `mix` of docs is left out of the rows that come back."""
    out = mixed(docs)
    return out.withColumn("__mix_copy", F.explode(F.array_repeat(F.lit(1), F.col("mix")["copies"]))).drop("mix", "__mix_copy")
