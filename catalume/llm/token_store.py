"""Token ids in binary shards of directly addressable codes.

An id is cut into chunks of 8 bits. Level 0 holds the lowest chunk of every id, level k the next chunk of those ids
that need one. Beside each level lie a bitmap of which of its ids go on and a directory of the number of set
bits before each block of 512. The chunk of an id on the next level is found by rank in the bitmap: any
token is read from a few bytes, and no block is decoded.

The store is a Parquet table whose rows are shards: so Spark's own committed writers and readers reach it on any file system.
A shard ends with the document that fills SHARD_TOKENS. Columns: part and shard (their order is that of doc_id), n_tokens,
doc_ids, doc_tokens (ids per document), and binary chunks, more and ranks, one of each per level.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalume.llm.common import prepare, tidy
from catalume.llm.tokens import encoded

SHARD_TOKENS = 1 << 18
BITS, BLOCK = 8, 512
SCHEMA = "part int, shard int, n_tokens long, doc_ids array<bigint>, doc_tokens array<bigint>, chunks array<binary>, more array<binary>, ranks array<binary>"


def pack(ids: np.ndarray) -> tuple[list[bytes], list[bytes], list[bytes]]:
    """Chunks, bitmap and directory of each level."""
    chunks, more, ranks = [], [], []
    rest = np.asarray(ids, "<u4")
    while True:
        chunks.append((rest & 0xFF).astype(np.uint8).tobytes())
        high = rest >> BITS
        on = high > 0
        more.append(np.packbits(on, bitorder="little").tobytes())
        blocks = np.add.reduceat(on, np.arange(0, len(on), BLOCK), dtype="<u4") if len(on) else np.zeros(0, "<u4")
        ranks.append(np.concatenate([[0], np.cumsum(blocks)[:-1]]).astype("<u4").tobytes() if len(on) else b"")
        rest = high[on]
        if not len(rest):
            return chunks, more, ranks


def unpack(chunks: list[bytes], more: list[bytes]) -> np.ndarray:
    """All ids of a shard, in order."""
    ids = np.zeros(len(chunks[0]), "<u4")
    at = np.arange(len(ids))
    for level, raw in enumerate(chunks):
        ids[at] |= np.frombuffer(raw, np.uint8).astype("<u4") << np.uint32(BITS * level)
        at = at[np.unpackbits(np.frombuffer(more[level], np.uint8), count=len(at), bitorder="little").astype(bool)]
    return ids


def token_at(chunks: list[bytes], more: list[bytes], ranks: list[bytes], i: int) -> int:
    """The i-th id of a shard, by rank alone."""
    value, level = 0, 0
    while True:
        value |= chunks[level][i] << BITS * level
        if not more[level][i >> 3] >> (i & 7) & 1:
            return value
        block = i // BLOCK
        before = int.from_bytes(ranks[level][4 * block : 4 * block + 4], "little")
        first = block * BLOCK // 8
        bits = int.from_bytes(more[level][first : (i >> 3) + 1], "little")
        i = before + (bits & ((1 << i - block * BLOCK) - 1)).bit_count()
        level += 1


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, shard_tokens: int = SHARD_TOKENS) -> None:
    """Encode text of docs (doc_id, text; other columns are ignored) and write the store, in ascending doc_id, nulls first, then text.

    Null and empty texts hold end_id alone. Repeated rows are written as often as they occur. No rows: no shards.
    """
    prepare(docs.sparkSession)

    def shards(batches):
        from pyspark import TaskContext

        part, shard, ids, names, held = TaskContext.get().partitionId(), 0, [], [], 0
        schema = pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("n_tokens", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("doc_tokens", pa.list_(pa.int64())), *((k, pa.list_(pa.binary())) for k in ("chunks", "more", "ranks"))])

        def full():
            chunks, more, ranks = pack(np.concatenate(ids))
            row = {"part": part, "shard": shard, "n_tokens": held, "doc_ids": names, "doc_tokens": [len(x) for x in ids], "chunks": chunks, "more": more, "ranks": ranks}
            return pa.RecordBatch.from_pylist([row], schema)

        for batch in batches:
            for name, tokens in zip(batch.column(0).to_pylist(), encoded(batch.column(1), tokenizer, end_id)):
                ids.append(tokens)
                names.append(name)
                held += len(tokens)
                if held >= shard_tokens:
                    yield full()
                    shard, ids, names, held = shard + 1, [], [], 0
        if ids:
            yield full()

    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(tidy(shards), SCHEMA).write.parquet(path)


def starts(store: DataFrame) -> DataFrame:
    """part, shard and the number of ids in all shards before, from sums per part, then per shard within its part."""
    parts = store.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    parts = parts.select("part", F.coalesce(F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    within = F.coalesce(F.sum("n_tokens").over(W.partitionBy("part").orderBy("shard").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return store.select("part", "shard", within.alias("inside")).join(parts, "part").select("part", "shard", (F.col("before") + F.col("inside")).alias("shard_start"))


def read_documents(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (and ids) of each document, from the files of the store."""
    prepare(spark)
    store = spark.read.schema(SCHEMA).parquet(path)
    fields = "part int, shard int, doc_id long, inside long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids

    def documents(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids, cut = unpack(row["chunks"], row["more"]), np.cumsum([0, *row["doc_tokens"]])
                raw = [ids[a:b].tobytes() for a, b in zip(cut, cut[1:])]
                n = len(raw)
                columns = [pa.array([row["part"]] * n, pa.int32()), pa.array([row["shard"]] * n, pa.int32()), pa.array(row["doc_ids"], pa.int64()), pa.array(cut[:-1], pa.int64()), pa.array(row["doc_tokens"], pa.int64()), pa.array([zlib.crc32(x) for x in raw], pa.int64())]
                names = ["part", "shard", "doc_id", "inside", "n_tokens", "ids_crc32"]
                yield pa.RecordBatch.from_arrays([*columns, *([pa.array(raw, pa.binary())] if with_ids else [])], [*names, *["ids"] * with_ids])

    found = store.select("part", "shard", "doc_ids", "doc_tokens", "chunks", "more").mapInArrow(tidy(documents), fields)
    return found.join(starts(store), ["part", "shard"]).select("doc_id", (F.col("shard_start") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * with_ids)


def read_tokens(store: DataFrame, positions: DataFrame) -> DataFrame:
    """position, token_id for each position (from 0 over the whole store; out of range: no row), without decoding shards.

    Shards are found by an equi-join on blocks of SHARD_TOKENS positions that they overlap.
    """
    prepare(store.sparkSession)
    span = F.lit(SHARD_TOKENS)
    index = starts(store).join(store.select("part", "shard", "n_tokens"), ["part", "shard"])
    index = index.withColumn("block", F.explode(F.sequence(F.floor(F.col("shard_start") / span), F.floor((F.col("shard_start") + F.col("n_tokens") - 1) / span))))
    at = positions.select(F.col("position").cast("long")).distinct().withColumn("block", F.floor(F.col("position") / span))
    inside = F.col("position") - F.col("shard_start")
    hits = at.join(index, "block").where((inside >= 0) & (inside < F.col("n_tokens"))).select("part", "shard", "position", inside.alias("inside"))

    def lookup(batches):
        for batch in batches:
            for row in batch.to_pylist():
                found = [(x["position"], token_at(row["chunks"], row["more"], row["ranks"], x["inside"])) for x in row["hits"]]
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], ["position", "token_id"])

    wanted = hits.groupBy("part", "shard").agg(F.collect_list(F.struct("position", "inside")).alias("hits"))
    return store.join(wanted, ["part", "shard"]).select("chunks", "more", "ranks", "hits").mapInArrow(tidy(lookup), T.StructType([T.StructField("position", T.LongType()), T.StructField("token_id", T.LongType())]))
