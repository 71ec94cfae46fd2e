"""Epsilon grid order join of unit vectors.

Vectors are turned to the principal axes of all vectors, so that the first coordinates spread most, and laid out in epsilon grid order: by
the cells (of side epsilon) of their leading coordinates, lexicographically. The sequence is cut into intervals of at most BLOCK vectors, and those
form a tree. Pairs of intervals are joined recursively from the root: a pair whose bounding boxes in the leading coordinates are more than
epsilon apart is skipped with everything below. Pairs of intervals that are left go to a task, which goes on in the same way with intervals of PART vectors: vectors that are too far
apart in the leading coordinates are dropped, the rest are decided by their cosine in double precision. Intervals are as long as a task's memory allows, since each is sent once for every one that it is compared with. Two unit vectors of cosine s are sqrt(2 - 2 s) apart.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalume.llm.common import prepare, stored, tidy
from catalume.llm.components import components

COSINE = 0.95
AXES = 6  # leading coordinates that order the sequence
FIRST = 16  # leading coordinates that bound intervals, and are compared before the rest
SKETCH = 256  # wider vectors are turned by as many fixed random axes before their principal ones are looked for
BLOCK, NUMBERS = 8192, 1 << 22  # vectors of an interval, and their numbers, at most
PART = 256
FAN = 8


def interval(width: int) -> int:
    return max(PART, min(BLOCK, NUMBERS // width))


def valid(embedding) -> F.Column:
    """Whether a vector has a direction: not null or empty, all components finite and not null, not zero."""
    good = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(embedding.isNotNull() & (F.size(embedding) > 0) & good & F.exists(embedding, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of an Arrow column of lists as float64, short ones filled with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    offsets = np.asarray(column.offsets)
    flat = column.values.to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.zeros((len(column), width))
    lengths = np.diff(offsets)
    rows = np.repeat(np.arange(len(column)), lengths)
    out[rows, np.arange(offsets[0], offsets[-1]) - np.repeat(offsets[:-1], lengths)] = flat[offsets[0] : offsets[-1]]
    return out


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def principal_axes(vectors: DataFrame, width: int) -> np.ndarray:
    """FIRST orthonormal columns at most, greatest spread first, from sums over all vectors: each task returns one matrix. Of vectors wider than SKETCH, the greatest spread within
    SKETCH fixed random directions: any orthonormal columns bound distances from below, so results are the same."""
    narrow = min(width, SKETCH)
    sketch = np.eye(width) if narrow == width else np.linalg.qr(np.random.default_rng(11).normal(size=(width, narrow)))[0]

    def sums(batches):
        total, square, n = np.zeros(narrow), np.zeros((narrow, narrow)), 0
        for batch in batches:
            x = unit(matrix(batch.column(0), width))
            x = x if narrow == width else x @ sketch
            total, square, n = total + x.sum(axis=0), square + x.T @ x, n + len(x)
        if n:
            cells = np.concatenate([square.ravel(), total, [n]])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(cells))), pa.array(cells)], ["cell", "value"])

    rows = vectors.select("embedding").mapInArrow(tidy(sums), "cell long, value double").groupBy("cell").agg(F.sum("value").alias("value")).collect()  # SKETCH^2 + SKETCH + 1 rows at most
    cells = np.zeros(narrow * narrow + narrow + 1)
    for r in rows:
        cells[r["cell"]] = r["value"]
    n = max(cells[-1], 1)
    mean = cells[narrow * narrow : -1] / n
    spread, axes = np.linalg.eigh(cells[: narrow * narrow].reshape(narrow, narrow) / n - np.outer(mean, mean))
    return sketch @ axes[:, ::-1][:, :FIRST]


def in_order(vectors: DataFrame, axes: np.ndarray, epsilon: float, size: int) -> DataFrame:
    """vec_id, embedding, block, rank, and y0.. (leading coordinates): the sequence in epsilon grid order, cut into intervals of size vectors."""
    width, k = axes.shape
    fields = T.StructType([*vectors.schema.fields, *[T.StructField(f"y{i}", T.DoubleType()) for i in range(k)]])

    def turned(batches):
        for batch in batches:
            y = unit(matrix(batch.column(batch.schema.get_field_index("embedding")), width)) @ axes[:, :k]
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(y[:, i]) for i in range(k)]], [*batch.schema.names, *[f"y{i}" for i in range(k)]])

    cells = [F.floor(F.col(f"y{i}") / epsilon) for i in range(min(AXES, k))]
    placed = vectors.mapInArrow(tidy(turned), fields).repartitionByRange(*cells, F.col("y0"), F.col("vec_id")).sortWithinPartitions(*cells, "y0", "vec_id")
    placed = stored(placed.withColumn("at", F.monotonically_increasing_id()), "grid_order")
    part = F.shiftright("at", 33)
    parts = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select("part", before.alias("before"))
    rank = F.col("before") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.withColumn("part", part).join(parts, "part").withColumn("rank", rank).withColumn("block", F.floor(F.col("rank") / size)).drop("part", "before", "at")


def interval_pairs(boxes: DataFrame, k: int, epsilon: float) -> DataFrame:
    """i <= j: the pairs of blocks that the recursion does not skip. boxes: block, lo0.., hi0.. ."""
    n = (boxes.agg(F.max("block")).first()[0] or 0) + 1
    levels = [boxes.withColumnRenamed("block", "node")]
    while n > 1:
        parent = levels[-1].withColumn("node", F.floor(F.col("node") / FAN))
        levels.append(parent.groupBy("node").agg(*[F.min(f"lo{i}").alias(f"lo{i}") for i in range(k)], *[F.max(f"hi{i}").alias(f"hi{i}") for i in range(k)]))
        n = -(-n // FAN)
    pairs = levels[-1].select(F.col("node").alias("i"), F.col("node").alias("j"))
    for level in levels[-2::-1]:
        child = level.withColumn("parent", F.floor(F.col("node") / FAN))
        a = child.select(F.col("parent").alias("i"), F.col("node").alias("a"), *[F.col(f"{x}{i}").alias(f"a_{x}{i}") for x in ("lo", "hi") for i in range(k)])
        b = child.select(F.col("parent").alias("j"), F.col("node").alias("b"), *[F.col(f"{x}{i}").alias(f"b_{x}{i}") for x in ("lo", "hi") for i in range(k)])
        gap = [F.greatest(F.lit(0.0), F.col(f"a_lo{i}") - F.col(f"b_hi{i}"), F.col(f"b_lo{i}") - F.col(f"a_hi{i}")) for i in range(k)]
        near = sum((g * g for g in gap), F.lit(0.0)) <= epsilon * epsilon + 1e-9
        pairs = stored(pairs.join(a, "i").join(b, "j").where("a <= b").where(near).select(F.col("a").alias("i"), F.col("b").alias("j")), "interval_pairs")
    return pairs


def compare(left: np.ndarray, right: np.ndarray, axes: np.ndarray, cosine: float, same: bool):
    """Positions of the pairs of unit vectors (left by right; same: each once) with this cosine or more, chunk by chunk: near copies may all be pairs, which no list could hold."""
    first = axes[:, :FIRST]
    a, b = left @ first, right @ first
    limit = 2 - 2 * cosine + 1e-9
    parts = [(at, min(at + PART, len(b))) for at in range(0, len(b), PART)]
    low, high = np.array([b[x:y].min(0) for x, y in parts]), np.array([b[x:y].max(0) for x, y in parts])
    for at in range(0, len(left), PART):
        part = a[at : at + PART]
        gap = np.maximum(0, np.maximum(low - part.max(0), part.min(0) - high))
        near = (gap * gap).sum(axis=1) <= limit
        if same:
            near[: at // PART] = False
        if not near.any():
            continue
        some = np.concatenate([np.arange(*parts[k]) for k in np.flatnonzero(near)])
        c = b[some]
        far = (part * part).sum(axis=1)[:, None] + (c * c).sum(axis=1)[None, :] - 2 * (part @ c.T)
        i, j = np.nonzero(far <= limit)
        i, j = i + at, some[j]
        if same:
            i, j = i[i < j], j[i < j]
        for k in range(0, len(i), 1 << 16):
            p, q = i[k : k + (1 << 16)], j[k : k + (1 << 16)]
            good = np.einsum("ij,ij->i", left[p], right[q]) >= cosine
            yield p[good], q[good]


def merge(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Let root, which maps every vector to the first one of its group, know of more links."""
    while True:
        a, b = root[i], root[j]
        apart = a != b
        if not apart.any():
            return
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while not (root == root[root]).all():
            root[:] = root[root]


def links(vectors: DataFrame, cosine: float = COSINE, size: int | None = None) -> DataFrame:
    """vec_id, n, root: per vector and pair of intervals in which it has links, the copies of those it links with and the smallest vec_id that they lead to.

    vectors: vec_id (unique), copies and embedding (valid, each once).
    """
    spark = prepare(vectors.sparkSession)
    width = vectors.agg(F.max(F.size("embedding"))).first()[0] or 1
    epsilon = math.sqrt(2 - 2 * cosine)
    axes = principal_axes(vectors, width)
    k = axes.shape[1]
    sequence = stored(in_order(vectors, axes, epsilon, size or interval(width)), "grid_blocks")
    boxes = sequence.groupBy("block").agg(*[F.min(f"y{i}").alias(f"lo{i}") for i in range(k)], *[F.max(f"y{i}").alias(f"hi{i}") for i in range(k)])
    pairs = interval_pairs(stored(boxes, "boxes"), k, epsilon)
    sides = pairs.select("i", "j", F.explode(F.when(F.col("i") == F.col("j"), F.array("i")).otherwise(F.array("i", "j"))).alias("block"))
    rows = sides.join(sequence.select("block", "rank", "vec_id", "copies", "embedding"), "block")
    shared = spark.sparkContext.broadcast(axes)  # FIRST * width numbers

    def joined(key, rows):
        rows = rows.combine_chunks().sort_by("rank")
        block = rows.column("block").to_numpy()
        ids = rows.column("vec_id").to_numpy()
        column = rows.column("embedding")
        x = unit(matrix(column, width))
        lengths = np.diff(np.asarray((column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).offsets))
        one = np.flatnonzero(block == block.min())
        two = np.flatnonzero(block != block.min())
        same = not len(two)
        copies, n, group = rows.column("copies").to_numpy(), np.zeros(len(ids), np.int64), np.arange(len(ids))
        for i, j in compare(x[one], x[one if same else two], shared.value, cosine, same):
            i, j = one[i], (one if same else two)[j]
            equal = lengths[i] == lengths[j]  # vectors of different length do not link
            i, j = i[equal], j[equal]
            np.add.at(n, i, copies[j])
            np.add.at(n, j, copies[i])
            merge(group, i, j)
        least = np.full(len(ids), np.iinfo(np.int64).max)
        np.minimum.at(least, group, ids)
        root = least[group]
        met = n > 0
        return pa.table({"vec_id": pa.array(ids[met]), "n": pa.array(n[met]), "root": pa.array(root[met])})

    return rows.groupBy("i", "j").applyInArrow(joined, "vec_id long, n long, root long")


def near_duplicates(table: DataFrame, cosine: float = COSINE, size: int | None = None) -> DataFrame:
    """vec_id, n_links, component_id, kept for each row of table (vec_id, embedding; other columns are ignored). size: vectors of an interval, by the width of the vectors if it is not given.

    Vectors link if their cosine, in double precision, is at least `cosine`. Null, empty and zero vectors, and those with null or non-finite components, link with
    nothing, nor do vectors of different length with each other. Equal vectors (by 128 bits of hashes) are compared once and link with each other. Rows that repeat vec_id and vector are links of each other too;
    rows with null vec_id take part in links, and are never the smallest of a component. No rows give no rows.
    """
    prepare(table.sparkSession)
    key = ["h1", "h2"]
    hashes = (F.xxhash64("embedding").alias("h1"), F.xxhash64(F.lit("again"), "embedding").alias("h2"))
    marked = table.select("vec_id", valid(F.col("embedding")).alias("valid"), *hashes, "embedding")
    groups = stored(marked.where("valid").groupBy(*key).agg(F.first("embedding").alias("embedding"), F.min("vec_id").alias("least"), F.count("*").alias("copies")), "vectors")
    # Class numbers stand for the vectors, so that a vec_id that repeats, or is null, does no harm; vectors themselves move no more.
    groups = stored(groups.withColumn("class", F.monotonically_increasing_id()), "vector_classes")
    found = stored(links(groups.select(F.col("class").alias("vec_id"), "copies", "embedding"), cosine, size), "links")
    others = found.groupBy(F.col("vec_id").alias("class")).agg(F.sum("n").alias("others"))
    label = components(found.select(F.col("vec_id").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "class")
    label = stored(groups.select("class", *key, "copies", "least").join(label, "class", "left").withColumn("label", F.coalesce("label", "class")), "vector_labels")
    least = label.groupBy("label").agg(F.min("least").alias("component_id"))
    known = label.join(least, "label").join(others, "class", "left").select(*key, (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), "component_id")
    rows = marked.where("valid").drop("embedding").join(known, key).select("vec_id", "n_links", "component_id")
    out = rows.unionByName(marked.where(~F.col("valid")).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
