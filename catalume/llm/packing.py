"""Best-two-fit packing of token sequences into bins of equal size.

Pieces of one length are interchangeable, so what has to be known together is only how many pieces there are of
each length: at most `capacity` counts, however many documents there are. Bins are planned over these counts: a
bin takes the longest piece left and is filled greedily with the longest that fit; then its smallest piece is
replaced by two pieces left over that fit the gap, so expanded, more tightly than it did. The plan is used as
often as the counts allow, so there are about as many plans as lengths. Pieces then find their places by their rank among
those of their length, in parallel.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from catalume.llm.common import prepare, stored, tidy
from catalume.llm.tokens import encoded

CAPACITY = 2048


def plans(counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Bins as ({length: pieces}, number of such bins)."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    here = np.arange(capacity + 1)
    out = []
    while left.any():
        spare = left.copy()
        chosen: list[int] = []
        gap = capacity
        while gap:
            fits = np.flatnonzero(spare[1 : gap + 1])
            if not len(fits):
                break
            length = int(fits[-1]) + 1
            take = min(int(spare[length]), gap // length)
            chosen += [length] * take
            spare[length] -= take
            gap -= take * length
        while gap and len(chosen) > 1:
            smallest = chosen[-1]
            room = gap + smallest
            best = np.maximum.accumulate(np.where(spare > 0, here, 0))
            first = np.flatnonzero(spare[: room + 1])
            second = np.minimum(best[room - first], first)
            alone = (second == first) & (spare[first] < 2)
            second = np.where(alone, best[np.maximum(first - 1, 0)], second)
            total = np.where(second > 0, first + second, 0)
            if not len(total) or total.max() <= smallest:
                break
            k = int(total.argmax())
            chosen[-1:] = sorted((int(first[k]), int(second[k])), reverse=True)
            for length, n in ((smallest, 1), (int(first[k]), -1), (int(second[k]), -1)):
                spare[length] += n
            chosen.sort(reverse=True)
            gap = capacity - sum(chosen)
        used = {x: chosen.count(x) for x in dict.fromkeys(chosen)}
        times = min(int(left[x]) // n for x, n in used.items())
        for x, n in used.items():
            left[x] -= n * times
        out.append((used, times))
    return out


def slots(found: list[tuple[dict[int, int], int]]) -> dict[str, np.ndarray]:
    """For each length and bin plan: the first rank that goes there, pieces per bin, first bin and place of the first piece."""
    ranks: dict[int, int] = {}
    rows, bins = [], 0
    for used, times in found:
        place = 0
        for length, n in used.items():
            low = ranks.get(length, 0)
            rows.append((length, low, n, bins, place))
            ranks[length] = low + n * times
            place += n * length
        bins += times
    rows.sort()
    return {k: np.array([r[i] for r in rows], np.int64) for i, k in enumerate(("length", "low", "each", "first", "place"))}


def pieces(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = CAPACITY) -> DataFrame:
    """Encode text of docs (doc_id, text; other columns are ignored): doc_id, piece, start, length, ids_crc32, part, nth.

    Null and empty texts are end_id alone. Documents of more than capacity ids are cut; the first piece holds what is
    over. Repeated rows stay. part and nth: the task, and how many pieces of the same length it met before.
    """
    prepare(docs.sparkSession)

    def cut(batches):
        from pyspark import TaskContext

        part, met = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            rows = []
            for name, ids in zip(batch.column(0).to_pylist(), encoded(batch.column(1), tokenizer, end_id)):
                first = len(ids) % capacity or capacity
                for k, (a, b) in enumerate(zip([0, *range(first, len(ids), capacity)], range(first, len(ids) + 1, capacity))):
                    rows.append((name, k, a, b - a, zlib.crc32(ids[a:b]), part, int(met[b - a])))
                    met[b - a] += 1
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
            names = ("doc_id", "piece", "start", "length", "ids_crc32", "part", "nth")
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], list(names))

    return docs.select("doc_id", "text").mapInArrow(tidy(cut), "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long")


def pack(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: every piece of docs in a sequence of at most capacity ids.

    Null and empty texts are end_id alone; repeated rows are packed as often as they come. Pieces of one length are interchangeable: which of them goes where follows from the order of tasks, so
    sequences may hold other pieces in a rerun over other partitions, but lengths and the number of sequences are the same. No rows: no sequences.
    """
    found = stored(pieces(docs, tokenizer, end_id, capacity), "pieces")
    per_part = found.groupBy("part", "length").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    ranked = found.join(per_part.select("part", "length", before.alias("before")), ["part", "length"])
    counts = {r["length"]: r["n"] for r in found.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most capacity rows
    to = slots(plans(counts, capacity))
    key = to["length"] << 48 | to["low"]

    def placed(batches):
        for batch in batches:
            length, rank = batch.column(3).to_numpy(), batch.column(5).to_numpy() + batch.column(6).to_numpy()
            at = np.searchsorted(key, length << 48 | rank, "right") - 1
            over, each = rank - to["low"][at], to["each"][at]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(to["first"][at] + over // each), pa.array(to["place"][at] + over % each * length)], ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "nth", "before"]
    return ranked.select(*columns).mapInArrow(tidy(placed), "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
