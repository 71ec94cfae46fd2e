"""N-gram Jaccard join in metric space: regions around pivots, triangle-inequality windows, recursion, exact.

1 - Jaccard is a metric, in which texts link at distance 0.2 at most. Unrelated texts are all at distance 1, where no window separates anything, so
the space is first cut by what linked texts must share:

* In any one order of all shingles (here: frequent ones last, then by hash), linked sets share some of their first quarters. A set that has too few
  shingles there that any other set has, links with nothing and leaves. This looks at one shuffle of a quarter of the shingles.
* Of what is shared, the rarest shingles suffice: each is a region, its pivot the text of least priority. A text lies in the cell of each pivot of its
  regions, so linked texts meet in a cell, and near copies of one text mostly in a single one.

A cell is then joined by Voronoi cells of pivots drawn from it, replication within triangle-inequality windows, and recursion (`cells.join`), in one task.
A cell too large for a task is split by the same rule in Spark, round by round. Where that does not shrink it (near copies of one text, all about
equally far from each other), its texts are dealt into rings of distance around the pivot that links with most of them; blocks of the same or adjacent
rings are compared, but for those whose texts all link with that pivot.

Texts with equal sets are one from the start. Overlaps are compared in whole numbers, so the join is exact but for collisions of 64-bit hashes.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalume.llm import cells as cell
from catalume.llm.common import prepare, release, remove, stored, tidy
from catalume.llm.components import components
from catalume.llm.shingles import fingerprint, of_column

#: 100 * intersection >= PERCENT * union.
PERCENT = 80
#: A shingle in more sets than this goes last in the order of shingles (which changes the work to do, not the result).
FREQUENT = 32
#: Most shingles that go last, and bits for each: a bound on what is sent to tasks.
MOST_FREQUENT, BITS_EACH = 1 << 23, 16
#: A set's first shingles that are looked at are a fifth, which linked sets share one of, and one in SHARED more, of which they share as many.
SHARED = 20
BATCH = 1 << 22  # shingles whose frequencies a task counts at once
TASK = 1 << 20  # shingles for a task of a shuffle, about
CELL_TEXTS, CELL_SHINGLES = 1024, 1 << 22  # a cell beyond either is split before it goes to a task
PIVOTS = 16  # of a cell that is split
BROADCAST = 1 << 20  # keys of texts, 8 bytes each, that are sent to all executors; more are joined by a shuffle

RING = (100 - PERCENT) / 100 + 1e-9


def bitmap(values: DataFrame, log2: int) -> np.ndarray:
    """Bits at the lowest log2 bits of the values (one column of evenly spread longs), as bytes; gathered in 2^(log2 - 15) rows at most."""
    (name,) = values.columns
    slot = F.col(name).bitwiseAND(F.lit((1 << log2) - 1)) + 1
    found = values.select(F.bitmap_bucket_number(slot).alias("bucket"), F.bitmap_bit_position(slot).alias("bit")).groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))
    out = np.zeros(max(1 << (log2 - 3), 4096), np.uint8)
    for r in found.collect():
        out[(r["bucket"] - 1) * 4096 : r["bucket"] * 4096] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return out


def hit(marks: np.ndarray, values: np.ndarray) -> np.ndarray:
    at = values.view(np.uint64) & np.uint64(len(marks) * 8 - 1)
    return (marks[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def code(x: np.ndarray) -> int:
    """64 bits that stand for a set."""
    return int.from_bytes(fingerprint(x)[:8], "little", signed=True)


def classes(docs: DataFrame) -> DataFrame:
    """For each row of docs: doc_id, k (a hash of its text), n (size of its set), c (its set's code); and rows with the shingles that a task met often: often, times."""
    prepare(docs.sparkSession)
    names = ["doc_id", "k", "n", "c", "often", "times"]

    def run(batches):
        held, size, seen = [], 0, set()

        def often():
            found, times = np.unique(np.concatenate(held), return_counts=True) if held else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            found, times = found[times > 2], times[times > 2]
            return pa.RecordBatch.from_arrays([*[pa.nulls(len(found), pa.int64())] * 4, pa.array(found.view(np.int64)), pa.array(times)], names)

        for batch in batches:
            ns, cs = [], []
            for x in of_column(batch.column(1)):
                c = code(x)
                ns.append(len(x))
                cs.append(c)
                if c not in seen:
                    seen.add(c)
                    held.append(x)
                    size += len(x)
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), batch.column(2), pa.array(ns, pa.int64()), pa.array(cs, pa.int64()), *[pa.nulls(len(ns), pa.int64())] * 2], names)
            if size > BATCH:
                yield often()
                held, size, seen = [], 0, set()
        yield often()

    return docs.select("doc_id", "text", F.xxhash64("text").alias("k")).mapInArrow(tidy(run), ", ".join(f"{x} long" for x in names))


def frequent(often: DataFrame) -> np.ndarray:
    """A filter of the shingles in more than FREQUENT sets; if these are too many to send, of those in more sets still."""
    tally = often.groupBy("often").agg(F.sum("times").alias("t")).where(F.col("t") > FREQUENT).withColumn("power", F.floor(F.log2("t")))
    tally = stored(tally, "frequent")
    kept, least = 0, 64
    for r in sorted(tally.groupBy("power").count().collect(), reverse=True):
        if kept + r["count"] > MOST_FREQUENT:
            break
        kept, least = kept + r["count"], r["power"]
    out = bitmap(tally.where(F.col("power") >= least).select("often"), max(15, (BITS_EACH * max(kept, 1)).bit_length()))
    remove(often.sparkSession, tally)
    return out


def first_shingles(docs: DataFrame, marks: np.ndarray) -> DataFrame:
    """h, c, often: the shingles of each set that are looked at, frequent ones last; often: those that need not be met to know that others have them."""

    def run(batches):
        seen: set[int] = set()
        for batch in batches:
            hs, cs, often = [], [], []
            for x in of_column(batch.column(0)):
                c = code(x)
                if not len(x) or c in seen:
                    continue
                if len(seen) >= 100_000:
                    seen.clear()
                seen.add(c)
                p = len(x) - -(-len(x) * PERCENT // 100) + -(-len(x) // SHARED)
                last = hit(marks, x)
                first = np.concatenate([x[~last][:p], x[last]])[:p]
                hs.append(first)
                cs.append(np.full(len(first), c, np.int64))
                often.append(np.arange(len(first)) >= len(x) - last.sum())
            if hs:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(hs).view(np.int64)), pa.array(np.concatenate(cs)), pa.array(np.concatenate(often))], ["h", "c", "often"])

    return docs.select("text").mapInArrow(tidy(run), "h long, c long, often boolean")


def met_again(first: DataFrame, partitions: int) -> DataFrame:
    """h, c, times of the shingles that two sets at least have among those looked at. Frequent ones are met without their others, so no task gets a hot shingle whole."""

    def run(batches):
        h, c, often = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in zip(*[(np.zeros(0, np.int64),) * 2 + (np.zeros(0, bool),), *[tuple(b.column(i).to_numpy(zero_copy_only=False) for i in range(3)) for b in batches]]))
        if often.any():
            yield pa.RecordBatch.from_arrays([pa.array(h[often]), pa.array(c[often]), pa.array(np.full(int(often.sum()), np.iinfo(np.int64).max))], ["h", "c", "times"])
            h, c = h[~often], c[~often]
        if len(h):
            order = np.argsort(h)
            h, c = h[order], c[order]
            at = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
            times = np.diff(np.append(at, len(h)))
            several = np.repeat(np.minimum.reduceat(c, at) != np.maximum.reduceat(c, at), times)
            yield pa.RecordBatch.from_arrays([pa.array(h[several]), pa.array(c[several]), pa.array(np.repeat(times, times)[several])], ["h", "c", "times"])

    key = F.when(F.col("often"), F.xxhash64("c")).otherwise(F.col("h"))
    return first.repartition(partitions, key).mapInArrow(tidy(run), "h long, c long, times long")


def cells(docs: DataFrame, often: DataFrame, sizes: DataFrame) -> DataFrame:
    """p, c: the cell of pivot p holds the text c. Linked texts meet in a cell."""
    spark = docs.sparkSession
    marks = frequent(often)
    total = sizes.agg(F.sum("n")).first()[0] or 0
    met = met_again(first_shingles(docs, marks), _partitions(docs, total // 4))
    least = F.expr(f"(({PERCENT} * n + 99) div 100 + {SHARED - 1}) div {SHARED}")
    texts = met.groupBy("c").agg(F.array_sort(F.collect_set(F.struct("times", "h"))).alias("met")).join(sizes.select("c", "n"), "c")
    lying = texts.where(F.size("met") >= least).select("c", F.explode(F.slice("met", F.lit(1), (F.size("met") - least + 1).cast("int"))).alias("x")).select(F.col("x.h").alias("h"), "c")
    lying = stored(lying, "regions")
    release(spark)
    pivots = lying.groupBy("h").agg(F.min(F.struct(_priority(F.col("c")), "c")).alias("pivot"), F.count("*").alias("k")).where("k > 1")
    out = stored(lying.join(pivots, "h").select(F.col("pivot.c").alias("p"), "c").distinct(), "cells")
    remove(spark, lying)
    release(spark)
    return out


def sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """c, shingles of the texts whose hash is in wanted (k), each set once."""

    def run(batches):
        seen: set[int] = set()
        for batch in batches:
            cs, xs = [], []
            for x in of_column(batch.column(0)):
                c = code(x)
                if c not in seen:
                    if len(seen) >= 100_000:
                        seen.clear()
                    seen.add(c)
                    cs.append(c)
                    xs.append(x.view(np.int64))
            if xs:
                lists = pa.LargeListArray.from_arrays(np.append(0, np.cumsum([len(x) for x in xs])), pa.array(np.concatenate(xs))).cast(pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(cs, pa.int64()), lists], ["c", "shingles"])

    few = wanted.count() <= BROADCAST
    texts = docs.select("text", F.xxhash64("text").alias("k")).join(F.broadcast(wanted) if few else wanted, "k", "left_semi")
    return texts.select("text").mapInArrow(tidy(run), "c long, shingles array<bigint>").groupBy("c").agg(F.first("shingles").alias("shingles"))


def _priority(c: Column) -> Column:
    return F.xxhash64(c, F.lit("pivot"))


def _partitions(df: DataFrame, shingles: int) -> int:
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), int(shingles) // TASK + 1)


def _runs(batches, keys: int):
    """The rows of each run of equal keys (the first columns, longs, of sorted rows), one run after the other: arrays of the columns after the keys."""
    last, held = None, []

    def whole():
        table = pa.Table.from_batches(held).combine_chunks()
        return [table.column(i).combine_chunks() if isinstance(table.column(i), pa.ChunkedArray) else table.column(i) for i in range(keys, table.num_columns)]

    for batch in batches:
        if not batch.num_rows:
            continue
        key = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(keys)], 1)
        cuts = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1).tolist(), len(key)]
        for a, b in zip(cuts, cuts[1:]):
            if last is not None and tuple(key[a]) != last:
                yield last, whole()
                held = []
            last = tuple(key[a])
            held.append(batch.slice(a, b - a))
    if held:
        yield last, whole()


def _sets(column: pa.Array) -> list[np.ndarray]:
    values, cuts = column.values.to_numpy(), column.offsets.to_numpy()
    return [values[a:b] for a, b in zip(cuts, cuts[1:])]


def _edges(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[i] for x in pairs], pa.int64()) for i in (0, 1)], ["a", "b"])


def join_cells(members: DataFrame, partitions: int) -> DataFrame:
    """a, b: links that connect the texts of each cell (p, c, shingles) that are connected in it."""

    def run(batches):
        out: list[tuple[int, int]] = []
        for _, (c, shingles) in _runs(batches, 1):
            c = c.to_numpy()
            out += [(int(c[i]), int(c[j])) for i, j in cell.join(_sets(shingles), PERCENT)]
            if len(out) > 10_000:
                yield _edges(out)
                out = []
        yield _edges(out)

    return members.select("p", "c", "shingles").repartition(partitions, "p").sortWithinPartitions("p", "c").mapInArrow(tidy(run), "a long, b long")


def count_cells(members: DataFrame, partitions: int) -> DataFrame:
    """cells, pairs, measured, parted, compared: what join_cells does with the pairs of each cell of at most CELL_TEXTS texts, a row a task."""

    def run(batches):
        counts, n = np.zeros(4, np.int64), 0
        for _, (_, shingles) in _runs(batches, 1):
            cell.join(_sets(shingles), PERCENT, counts=counts)
            n += 1
        yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in (n, *counts.tolist())], ["cells", "pairs", "measured", "parted", "compared"])

    return members.select("p", "c", "shingles").repartition(partitions, "p").sortWithinPartitions("p", "c").mapInArrow(tidy(run), "cells long, pairs long, measured long, parted long, compared long")


def measure(members: DataFrame, partitions: int) -> DataFrame:
    """Of each text of each cell (p, blocks, c, shingles): p, blocks, c, q (pivots drawn from the cell), d (distances to them), links (to which it links), within (into whose cells it is replicated)."""
    block = F.pmod(F.xxhash64("c", F.lit("block")), F.col("blocks"))
    drawn = members.groupBy("p", "blocks", F.pmod(_priority(F.col("c")), F.lit(PIVOTS)).alias("j")).agg(F.min_by("c", F.struct(_priority(F.col("c")), "c")).alias("c"))
    known = members.select("c", "shingles").dropDuplicates(["c"])
    pivots = drawn.join(known, "c").select("p", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), F.lit(0).alias("kind"), "blocks", "c", "shingles")
    rows = members.select("p", block.alias("block"), F.lit(1).alias("kind"), "blocks", "c", "shingles").unionByName(pivots)

    def run(batches):
        for (p, _), (kind, blocks, c, shingles) in _runs(batches, 2):
            c, x, member = c.to_numpy(), _sets(shingles), kind.to_numpy() == 1
            some, q = [x[i] for i in np.flatnonzero(member)], [x[i] for i in np.flatnonzero(~member)]
            if not some:
                continue
            n, m, both = np.array([len(s) for s in some]), np.array([len(s) for s in q]), cell.overlaps(some, q)
            d = 1 - both / (n[:, None] + m[None, :] - both)
            linked, within = cell.linked(both, n, m, PERCENT), d <= d.min(1)[:, None] + 2 * RING
            names = c[~member]
            yield pa.RecordBatch.from_pylist([{"p": int(p), "blocks": blocks[0].as_py(), "c": int(a), "q": names.tolist(), "d": d[i].tolist(), "links": names[linked[i]].tolist(), "within": names[within[i]].tolist()} for i, a in enumerate(c[member])], schema=pa.schema([("p", pa.int64()), ("blocks", pa.int64()), ("c", pa.int64()), ("q", pa.list_(pa.int64())), ("d", pa.list_(pa.float64())), ("links", pa.list_(pa.int64())), ("within", pa.list_(pa.int64()))]))

    rows = rows.repartition(partitions, "p", "block").sortWithinPartitions("p", "block", "kind", "c")
    return rows.mapInArrow(tidy(run), "p long, blocks long, c long, q array<bigint>, d array<double>, links array<bigint>, within array<bigint>")


def join_rings(measured: DataFrame, known: DataFrame, partitions: int) -> DataFrame:
    """a, b: links that connect the texts of cells that no pivots split. Blocks of texts are compared, but those a ring apart, and those that link with one pivot in full."""
    hubs = measured.select("p", F.explode("links").alias("hub")).groupBy("p", "hub").count().groupBy("p").agg(F.max_by("hub", F.struct("count", "hub")).alias("hub"))
    dealt = measured.join(hubs, "p").select(
        "p",
        "c",
        F.floor(F.element_at("d", F.array_position("q", F.col("hub")).cast("int")) / F.lit(RING)).alias("ring"),
        F.array_contains("links", F.col("hub")).alias("inside"),
        F.pmod(F.xxhash64("c", F.lit("block")), F.col("blocks")).alias("bucket"),
    )
    dealt = stored(dealt.select("p", "c", "ring", F.struct("ring", "inside", "bucket").alias("block")), "rings")
    blocks = dealt.select("p", "ring", "block").distinct()
    beside = blocks.select("p", F.explode(F.array("ring", F.col("ring") + 1)).alias("ring"), F.col("block").alias("left"))
    pairs = beside.join(blocks.withColumnRenamed("block", "right"), ["p", "ring"]).where("left.ring < right.ring or left <= right").where("not (left.inside and right.inside)")
    pairs = pairs.select("p", F.xxhash64("p", "left", "right").alias("pair"), "left", "right")
    sides = pairs.select("p", "pair", F.lit(0).alias("side"), F.col("left").alias("block")).unionByName(pairs.where("left <> right").select("p", "pair", F.lit(1).alias("side"), F.col("right").alias("block")))
    rows = dealt.join(sides, ["p", "block"]).join(known, "c").select("pair", "side", "c", "shingles")

    def run(batches):
        for _, (side, c, shingles) in _runs(batches, 1):
            c, x, right = c.to_numpy(), _sets(shingles), side.to_numpy() == 1
            if not right.any():
                yield _edges([(int(c[i]), int(c[j])) for i, j in cell.join(x, PERCENT)])
            else:
                order = np.argsort(right, kind="stable")
                found = cell.join_between([x[i] for i in order if not right[i]], [x[i] for i in order if right[i]], PERCENT)
                yield _edges([(int(c[order[i]]), int(c[order[j]])) for i, j in found])

    return rows.repartition(partitions, "pair").sortWithinPartitions("pair", "side", "c").mapInArrow(tidy(run), "a long, b long")


def steps(docs: DataFrame) -> DataFrame:
    """One row that tells how many pairs of sets each step of the join decides: n_sets and n_pairs at all, n_left sets that may link with any other, n_large cells that are split in Spark, and of all others
    cells, pairs in them, pairs measured to a pivot, parted by windows, and compared in full."""
    every = stored(classes(docs), "classes")
    sizes = stored(every.where("n > 0").groupBy("c").agg(F.first("n").alias("n"), F.min("k").alias("k")), "sizes")
    inside = cells(docs, every.where(F.col("often").isNotNull()), sizes)
    active = inside.select("c").distinct().join(sizes, "c")
    known = stored(sets(docs, active.select("k")), "sets")
    weighed = inside.groupBy("p").agg(F.count("*").alias("k"))
    total = known.agg(F.sum(F.size("shingles"))).first()[0] or 0
    small = inside.join(weighed.where(F.col("k").between(2, CELL_TEXTS)).select("p"), "p").join(known, "c")
    counted = count_cells(small, _partitions(docs, total)).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("cells", "pairs", "measured", "parted", "compared")])
    n = sizes.agg(F.count("*").alias("n_sets")).withColumn("n_pairs", F.expr("n_sets * (n_sets - 1) div 2"))
    return n.crossJoin(active.agg(F.count("*").alias("n_left"))).crossJoin(weighed.agg(F.count_if(F.col("k") > CELL_TEXTS).alias("n_large"))).crossJoin(counted)  # of one row each


def links(docs: DataFrame, every: DataFrame) -> DataFrame:
    """a, b: links between sets, enough to connect all that are connected."""
    spark = docs.sparkSession
    sizes = stored(every.where("n > 0").groupBy("c").agg(F.first("n").alias("n"), F.min("k").alias("k")), "sizes")
    inside = cells(docs, every.where(F.col("often").isNotNull()), sizes)
    active = inside.select("c").distinct().join(sizes, "c")
    known = stored(sets(docs, active.select("k")), "sets")
    release(spark)
    found: list[DataFrame] = []
    while True:
        weighed = inside.join(sizes.select("c", "n"), "c").groupBy("p").agg(F.count("*").alias("k"), F.sum("n").alias("n"))
        weighed = stored(weighed.where("k > 1").withColumn("large", (F.col("k") > CELL_TEXTS) | ((F.col("n") > CELL_SHINGLES) & (F.col("k") > 2))), "weighed")
        moved = {r["large"]: r["n"] for r in weighed.groupBy("large").agg(F.sum("n").alias("n")).collect()}
        if False in moved:
            small = inside.join(weighed.where("not large").select("p"), "p").join(known, "c")
            found.append(stored(join_cells(small, _partitions(docs, moved[False])), "links"))
        if True not in moved:
            break
        partitions = _partitions(docs, moved[True])
        blocks = F.greatest(F.ceil(F.col("k") / (CELL_TEXTS // 2)), F.ceil(F.col("n") / (CELL_SHINGLES // 2))).cast("long").alias("blocks")
        members = inside.join(weighed.where("large").select("p", blocks), "p").join(known, "c")
        measured = stored(measure(members, partitions), "measured")
        found.append(measured.select(F.col("c").alias("a"), F.explode("links").alias("b")).where("a <> b"))
        split = measured.select("p", "c", F.explode("within").alias("q"))
        fewer = split.groupBy("p", "q").count().groupBy("p").agg((2 * F.sum(F.col("count") * F.col("count"))).alias("work")).join(weighed, "p")
        fewer = stored(fewer.select("p", (F.col("work") <= F.col("k") * F.col("k")).alias("shrinks")), "fewer")
        following = stored(split.join(fewer.where("shrinks").select("p"), "p").select(F.xxhash64("p", "q").alias("p"), "c"), "cells")
        found.append(stored(join_rings(measured.join(fewer.where("not shrinks").select("p"), "p"), known, partitions), "links"))
        remove(spark, inside, weighed)
        release(spark)
        inside = following
    return reduce(DataFrame.unionByName, found) if found else sizes.select(F.col("c").alias("a"), F.col("c").alias("b")).where("false")


def labelled(docs: DataFrame) -> DataFrame:
    """doc_id, k (a hash of the text), n (size of the set), label (equal for rows that links connect) for each row of docs; without words, n is 0 and label null."""
    every = stored(classes(docs), "classes")
    rows = every.where(F.col("c").isNotNull()).select("doc_id", "k", "n", "c")
    label = components(links(docs, every))
    out = rows.join(label.select(F.col("node").alias("c"), "label"), "c", "left")
    return stored(out.select("doc_id", "k", "n", F.when(F.col("n") > 0, F.coalesce("label", "c")).alias("label")), "labelled")


def linked(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id for each row of docs (doc_id, text; other columns are ignored).

    component_id is the smallest doc_id that links lead to. Null texts, and those without words, have an empty set and link with nothing; equal
    sets link. Repeated rows stay, and link as their text does. Rows with null doc_id get the smallest doc_id of their component, null if there is none. No rows give no rows.
    """
    rows = labelled(docs)
    least = rows.where("n > 0").groupBy("label").agg(F.min("doc_id").alias("least"))
    out = rows.where("n > 0").join(least, "label").select("doc_id", F.col("n").alias("n_shingles"), F.col("least").alias("component_id"))
    return out.unionByName(rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of docs (doc_id, text and any others) of which one stays for each component: that with the smallest doc_id, the smallest hash of its text among several.

    Rows without words stay, all of them. Of rows that repeat the one that stays, doc_id and text, one stays; rows that share only their doc_id
    go by their texts. A row with null doc_id stays only if no row of its component has one. No rows give no rows.
    """
    rows = labelled(docs)
    best = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "k")).alias("x")
    chosen = stored(rows.where("n > 0").groupBy("label").agg(best).select(F.col("x.doc_id").alias("__chosen_id"), F.col("x.k").alias("__chosen_k")).distinct(), "chosen")
    empty = ~F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    key = F.xxhash64("text")
    full = docs.where(~empty)
    kept = full.join(chosen, F.col("doc_id").eqNullSafe(F.col("__chosen_id")) & (key == F.col("__chosen_k")), "left_semi")
    repeated = rows.where("n > 0").groupBy("doc_id", "k").count().where("count > 1").select(F.col("doc_id").alias("__chosen_id"), F.col("k").alias("__chosen_k"))
    same = F.col("doc_id").eqNullSafe(F.col("__chosen_id")) & (key == F.col("__chosen_k"))
    once = kept.join(repeated, same, "left_anti")
    several = kept.join(repeated, same, "left_semi").groupBy(F.col("doc_id").alias("__chosen_id"), key.alias("__chosen_k")).agg(F.min_by(F.struct(*docs.columns), F.to_json(F.struct(*docs.columns))).alias("__row")).select("__row.*")
    return once.unionByName(several).unionByName(docs.where(empty))
