"""Exact duplicates: batches of documents against immutable snapshots of all that came before, and among themselves.

A batch is grouped first by the SHA-256 of its normalised texts, so that from here on a text, however many copies it has, is
one row. What is new in a batch becomes a snapshot, which never changes: the batch's rows, its keys (a 64-bit digest and the row that
stands for each text), and static binary fuse filters, one for each bucket of digests. Digests of a later batch are screened
by the filters of their buckets (about one in 256 strangers passes); only positives are joined with the snapshot's keys, and
only the texts of what is found there are fetched and compared byte by byte.

A filter holds about KEYS digests whatever the size of a snapshot, so no task holds more than that and a share of the digests that are screened.
"""

from __future__ import annotations

from math import ceil, log
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalume.llm.common import prepare, scratch, stored

#: Digests a filter holds, about; digests that a task screens by one filter at once, about; pairs that are broadcast, at most (24 bytes each); a text of more than 1 in HOT rows is hot.
KEYS, SCREENED, BROADCAST, HOT = 1 << 13, 1 << 16, 1 << 18, 1000
FILTERS = "bucket long, seed long, segment long, segments long, prints binary"


class Fuse(NamedTuple):
    """A static filter of 64-bit keys in three-wise binary fuse form: each key has a place in three neighbouring segments, whose prints together give its own."""

    seed: int
    segment: int
    segments: int
    prints: np.ndarray


def scrambled(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    with np.errstate(over="ignore"):
        for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
            x = (x ^ x >> np.uint64(shift)) * np.uint64(factor)
    return x ^ x >> np.uint64(33)


def placed(keys: np.ndarray, seed: int, segment: int, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """The three places of each key, and its print of 8 bits."""
    with np.errstate(over="ignore"):
        high = scrambled(keys.astype(np.uint64) + np.uint64(seed) * np.uint64(0x9E3779B97F4A7C15))
        low = scrambled(high + np.uint64(0x9E3779B97F4A7C15))
    first = ((high >> np.uint64(32)) * np.uint64(segments) >> np.uint64(32)) * np.uint64(segment)
    inside = [low >> np.uint64(21 * k) & np.uint64(segment - 1) for k in range(3)]
    return np.stack([first + np.uint64(k * segment) + x for k, x in enumerate(inside)], axis=1).astype(np.int64), (high & np.uint64(0xFF)).astype(np.uint8)


def peeled(places: np.ndarray, size: int) -> list[tuple[np.ndarray, np.ndarray]] | None:
    """Rounds of (keys, their column of places that no key of this or a later round shares); None if some keys can't be told apart."""
    n = len(places)
    degree = np.bincount(places.ravel(), minlength=size)
    total = np.bincount(places.ravel(), weights=np.repeat(np.arange(n), 3), minlength=size).astype(np.int64)
    rounds, left, free = [], n, np.flatnonzero(degree == 1)
    while len(free):
        keys, at = np.unique(total[free], return_index=True)
        rounds.append((keys, (places[keys] == free[at, None]).argmax(axis=1)))
        touched = places[keys].ravel()
        np.subtract.at(degree, touched, 1)
        np.subtract.at(total, touched, np.repeat(keys, 3))
        left -= len(keys)
        touched = np.unique(touched)
        free = touched[degree[touched] == 1]
    return rounds if not left else None


def fused(keys: np.ndarray) -> Fuse:
    """The filter of keys (64-bit, repeats do no harm; at least one)."""
    keys = np.unique(keys)
    n = len(keys)
    segment = 1 << min(18, max(2, int(log(n) / log(3.33) + 2.25))) if n > 1 else 4
    wanted = ceil(n * max(1.125, 0.875 + 0.25 * log(1e6) / log(max(n, 2))))
    segments = max(1, ceil(wanted / segment) - 2)
    size = (segments + 2) * segment
    seed = 0
    while (rounds := peeled((found := placed(keys, seed, segment, segments))[0], size)) is None:
        seed += 1
        if seed % 50 == 0:  # a table of this size is too tight for so few keys
            segments += 1
            size += segment
    places, own = found
    prints = np.zeros(size, np.uint8)
    for some, column in reversed(rounds):
        all_three = prints[places[some]]
        at = places[some, column]
        prints[at] = own[some] ^ np.bitwise_xor.reduce(all_three, axis=1) ^ prints[at]
    return Fuse(seed, segment, segments, prints)


def holds(fuse: Fuse, keys: np.ndarray) -> np.ndarray:
    """For each key whether the filter may hold it: true for all that it was made of."""
    places, own = placed(keys, fuse.seed, fuse.segment, fuse.segments)
    return np.bitwise_xor.reduce(fuse.prints[places], axis=1) == own


class Snapshot(NamedTuple):
    """A batch that is done with: its number, the folder of its rows, keys and filters, and how many buckets of filters there are."""

    number: int
    path: str
    buckets: int


def normalised(docs: DataFrame) -> DataFrame:
    """doc_id, uid (a number for each row), digest, text_sha256 and text, in which white space is one blank; null is empty. Other columns of docs are ignored."""
    text = F.coalesce("text", F.lit(""))
    plain = F.regexp_replace(text, r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]", " ")  # a single blank stays as it is
    return docs.select("doc_id", F.monotonically_increasing_id().alias("uid"), plain.alias("text")).select("doc_id", "uid", F.xxhash64("text").alias("digest"), F.sha2("text", 256).alias("text_sha256"), "text")


def grouped(batch: DataFrame, number: int) -> DataFrame:
    """digest, text_sha256, n and first of each text of a batch: how often it comes, and the row that stands for it: the smallest doc_id (null last), then uid."""
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", F.lit(number).alias("batch"), "uid")
    return batch.groupBy("digest", "text_sha256").agg(F.count("*").alias("n"), F.min(order).alias("first"))


def write_filters(keys: DataFrame, path: str, buckets: int) -> None:
    """A filter for each bucket of keys (digest) that holds any."""
    prepare(keys.sparkSession)

    def build(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        fuse = fused(rows["digest"].to_numpy())
        return pd.DataFrame({"bucket": [key[0]], "seed": [fuse.seed], "segment": [fuse.segment], "segments": [fuse.segments], "prints": [fuse.prints.tobytes()]})

    in_bucket = keys.select("digest", F.pmod("digest", F.lit(buckets)).cast("long").alias("bucket"))
    in_bucket.groupBy("bucket").applyInPandas(build, FILTERS).write.parquet(path)


def screened(digests: DataFrame, n: int, snapshot: Snapshot) -> DataFrame:
    """The digests (digest, distinct; n of them) that the snapshot's filters may hold."""
    spark = prepare(digests.sparkSession)
    salts = ceil(n / (snapshot.buckets * SCREENED)) or 1
    filters = spark.read.schema(FILTERS).parquet(f"{snapshot.path}/filters").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = digests.select("digest", F.pmod("digest", F.lit(snapshot.buckets)).cast("long").alias("bucket"), F.pmod(F.shiftright("digest", 24), F.lit(salts)).cast("int").alias("salt"))

    def screen(rows: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        if not len(found) or not len(rows):
            return rows.iloc[:0][["digest"]]
        f = found.iloc[0]
        fuse = Fuse(int(f["seed"]), int(f["segment"]), int(f["segments"]), np.frombuffer(f["prints"], np.uint8))
        return rows.loc[holds(fuse, rows["digest"].to_numpy()), ["digest"]]

    return salted.groupBy("bucket", "salt").cogroup(filters.groupBy("bucket", "salt")).applyInPandas(screen, "digest long")


def texts_of(rows: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """digest, uid and text of the rows that are wanted (digest, uid; n of them): few are sent to the rows, many meet them by digest."""
    return rows.select("digest", "uid", "text").join(F.broadcast(wanted) if n <= BROADCAST else wanted, ["digest", "uid"])


def known(batch: DataFrame, groups: DataFrame, n: int, snapshot: Snapshot) -> DataFrame:
    """digest, text_sha256 and root of the groups (n of them) whose text the snapshot has, byte by byte; root is the row that stands for it there."""
    spark = batch.sparkSession
    passed = screened(groups.select("digest").distinct(), n, snapshot)
    keys = spark.read.parquet(f"{snapshot.path}/keys").select("digest", F.col("first").alias("root"))
    hits = stored(groups.join(passed, "digest", "left_semi").join(keys, "digest").select("digest", "text_sha256", F.col("first.uid").alias("uid"), "root"), "hits")
    n_hits = hits.count()
    mine = texts_of(batch, hits.select("digest", "uid").distinct(), n_hits).withColumnRenamed("text", "mine")
    there = texts_of(spark.read.parquet(f"{snapshot.path}/rows"), hits.select("digest", F.col("root.uid").alias("uid")).distinct(), n_hits)
    pairs = hits.join(mine, ["digest", "uid"]).join(there.select("digest", F.col("uid").alias("root_uid"), F.col("text").alias("theirs")), "digest")
    return pairs.where((F.col("root.uid") == F.col("root_uid")) & (F.col("mine") == F.col("theirs"))).select("digest", "text_sha256", "root")


def arrived(spark: SparkSession, path: str, number: int, snapshots: list[Snapshot]) -> tuple[DataFrame, Snapshot]:
    """Take the batch whose rows (of `normalised`) lie in path/rows: its groups with root, the row that stands for their text in all batches so far; and the batch as a snapshot."""
    batch = spark.read.parquet(f"{path}/rows")
    groups = stored(grouped(batch, number), "groups")
    n = groups.count()
    if snapshots and n:
        links = known(batch, groups, n, snapshots[0])
        for snapshot in snapshots[1:]:
            links = links.unionByName(known(batch, groups, n, snapshot))
        groups = stored(groups.join(stored(links, "links"), ["digest", "text_sha256"], "left").withColumn("root", F.coalesce("root", "first")), "rooted")
    else:
        groups = groups.withColumn("root", F.col("first"))
    new = groups.where("root = first")
    new.select("digest", "first").write.parquet(f"{path}/keys")
    keys = spark.read.parquet(f"{path}/keys")
    snapshot = Snapshot(number, path, max(1, ceil(keys.count() / KEYS)))
    write_filters(keys, f"{path}/filters", snapshot.buckets)
    return groups, snapshot


def deduplicated(docs: DataFrame, batches: int = 3) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every row of docs (doc_id, text; other columns are ignored), as if docs came in so many batches by doc_id.

    Null texts are empty ones. Of equal texts the smallest doc_id stays; null ids come last, and of rows that share an id one stays. The result does not
    depend on the number of batches. No rows give no rows.
    """
    spark = docs.sparkSession
    low, high = docs.agg(F.min("doc_id"), F.max("doc_id")).first()
    share = F.least(F.lit(batches - 1), F.floor((F.col("doc_id").cast("double") - float(low or 0)) / float((high or 0) - (low or 0) + 1) * batches)).cast("int")
    folder = scratch(spark, "exact")
    normalised(docs).withColumn("batch", F.coalesce(share, F.lit(batches - 1))).write.partitionBy("batch").parquet(f"{folder}/landed")
    landed = spark.read.schema("doc_id long, uid long, digest long, text_sha256 string, text string, batch int").parquet(f"{folder}/landed")
    snapshots, seen = [], []
    for number in [r["batch"] for r in landed.select("batch").distinct().orderBy("batch").collect()]:  # at most `batches`
        path = f"{folder}/snapshot-{number}"
        _move(spark, f"{folder}/landed/batch={number}", f"{path}/rows")
        groups, snapshot = arrived(spark, path, number, snapshots)
        seen.append(groups)
        snapshots.append(snapshot)
    if not snapshots:
        return spark.createDataFrame([], "doc_id long, keep_id long, group_size long, kept boolean, text_sha256 string")
    return judged(spark, snapshots, seen)


def judged(spark: SparkSession, snapshots: list[Snapshot], seen: list[DataFrame]) -> DataFrame:
    """Every row of every batch with what became of it. Rows meet the verdicts on their texts by digest, but those of hot texts, of which there are at most HOT a batch: these verdicts are sent to the rows."""
    groups = seen[0]
    for more in seen[1:]:
        groups = groups.unionByName(more)
    classes = groups.groupBy("root").agg(F.min("first").alias("keep"), F.sum("n").alias("group_size"))
    verdicts = stored(groups.join(classes, "root").select("digest", "text_sha256", F.col("first.batch").alias("batch"), "n", "keep", "group_size"), "verdicts")
    out = None
    for s in snapshots:
        rows = spark.read.parquet(f"{s.path}/rows").select("doc_id", "uid", "digest", "text_sha256")
        mine = verdicts.where(F.col("batch") == s.number)
        least = mine.agg(F.sum("n")).first()[0] // HOT + 1
        keys = ["digest", "text_sha256"]
        hot = F.broadcast(mine.where(F.col("n") > least))
        for df in (rows.join(hot, keys), rows.join(hot, keys, "left_anti").join(mine.where(F.col("n") <= least), keys)):
            kept = (F.col("uid") == F.col("keep.uid")) & (F.col("batch") == F.col("keep.batch"))
            df = df.select("doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size", kept.alias("kept"), "text_sha256")
            out = df if out is None else out.unionByName(df)
    return out


def _move(spark: SparkSession, old: str, new: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(old).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(path(new).getParent())
    if not fs.rename(path(old), path(new)):
        raise OSError(f"{old} could not be moved")


ORACLE = """WITH plain AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size, row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256 FROM plain"""
