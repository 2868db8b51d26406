"""Best-fit packing by large-item matching, planned on the histogram of lengths.

Where a piece goes depends on its length alone, and lengths reach from 1 to the capacity. So the plan is
made on the number of pieces of each length, which never exceeds ``capacity`` rows however many documents
there are:

1. Pieces above a third of the capacity can share a bin with one other such piece at most. They are
   matched greedily, the longest with the longest that still fits beside it.
2. Shorter pieces, in falling length, go where they leave the least room (best fit); bins of equal room
   are filled as a run, so a step costs the same for ten bins or a billion.

The plan is a list of runs: pieces ``rank .. rank + n`` of a length go to bins ``bin .. `` with ``each`` of
them in a bin, from ``offset`` on. Its size is bounded by the capacity, so every task may hold it. A
piece's rank within its length is counted in salted buckets, never over one length in one task.

Defined cases: null texts count as empty, and an empty document has its end id alone; null doc_ids and
repeated rows are packed like any other row; other columns are ignored; an empty table gives no rows. A
length of 0 takes no room and gets offset 0 of a bin of its own; a length above the capacity is an error.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kymora.llm.chunks import encoder
from kymora.llm.common import batch_of, partitions, slices, stage, texts, tidy

Run = tuple[int, int, int, int, int, int]  # length, first rank, pieces, first bin, pieces in a bin, offset


def plan(counts: dict[int, int], capacity: int) -> tuple[list[Run], int]:
    """Runs for all pieces, and the number of bins."""
    if counts and (max(counts) > capacity or min(counts) < 0):
        raise ValueError("a length is outside 0 to the capacity")
    left = {n: c for n, c in counts.items() if c > 0}
    used: dict[int, int] = dict.fromkeys(left, 0)
    runs: list[Run] = []
    room: dict[int, list[tuple[int, int]]] = {}  # room in a bin -> runs of bins (first, number)
    bins = 0

    def put(length: int, n: int, first: int, each: int, offset: int) -> None:
        runs.append((length, used[length], n, first, each, offset))
        used[length] += n
        left[length] -= n

    def free(gap: int, first: int, n: int) -> None:
        if gap and n:
            room.setdefault(gap, []).append((first, n))

    large = sorted(n for n in left if 3 * n > capacity)
    while large:
        a = large[-1]
        k = bisect_right(large, capacity - a) - 1
        b = large[k] if k >= 0 else None
        if b is None:
            n = left[a]
            put(a, n, bins, 1, 0)
            free(capacity - a, bins, n)
        elif a == b:
            n = left[a] // 2
            if n:
                put(a, 2 * n, bins, 2, 0)
                free(capacity - 2 * a, bins, n)
                bins += n
            if left[a] and len(large) > 1:  # the odd one pairs with the next shorter length
                c = large[-2]
                n = 1
                put(a, 1, bins, 1, 0)
                put(c, 1, bins, 1, a)
                free(capacity - a - c, bins, 1)
                if not left[c]:
                    large.remove(c)
            elif left[a]:
                n = 1
                put(a, 1, bins, 1, 0)
                free(capacity - a, bins, 1)
            else:
                n = 0
        else:
            n = min(left[a], left[b])
            put(a, n, bins, 1, 0)
            put(b, n, bins, 1, a)
            free(capacity - a - b, bins, n)
            if not left[b]:
                large.remove(b)
        bins += n
        if not left[a]:
            large.remove(a)

    gaps = sorted(room)
    for s in sorted((n for n in left if left[n] and 3 * n <= capacity), reverse=True):
        if s == 0:
            put(0, left[0], bins, 1, 0)
            bins += used[0]
            continue
        k = bisect_right(gaps, s - 1)
        fresh: list[int] = []
        while left[s] and k < len(gaps):
            gap = gaps[k]
            each = gap // s
            while left[s] and room[gap]:
                first, n = room[gap].pop()
                full = min(n, left[s] // each)
                if full:
                    put(s, full * each, first, each, capacity - gap)
                    free(gap - each * s, first, full)
                    fresh.append(gap - each * s)
                if full < n:
                    rest = left[s]  # fewer than fill one bin
                    if rest:
                        put(s, rest, first + full, rest, capacity - gap)
                        free(gap - rest * s, first + full, 1)
                        fresh.append(gap - rest * s)
                        full += 1
                    free(gap, first + full, n - full)
            if room[gap]:
                break
            del room[gap], gaps[k]
        if left[s]:
            each = capacity // s
            full = left[s] // each
            if full:
                put(s, full * each, bins, each, 0)
                free(capacity - each * s, bins, full)
                fresh.append(capacity - each * s)
                bins += full
            if left[s]:
                rest = left[s]
                put(s, rest, bins, rest, 0)
                free(capacity - rest * s, bins, 1)
                fresh.append(capacity - rest * s)
                bins += 1
        for gap in set(fresh):
            if room.get(gap) and (not gaps or gaps[min(bisect_right(gaps, gap), len(gaps)) - 1] != gap):
                insort(gaps, gap)
    return runs, bins


def place(items: DataFrame, capacity: int) -> DataFrame:
    """``items`` with sequence_id and offset; needs ``uid`` (a written, unique long) and ``length``.

    ``items`` is read several times and must give the same rows each time (a written table).
    """
    spark = items.sparkSession
    salt = F.pmod(F.xxhash64("uid"), F.lit(max(partitions(spark), 8))).alias("salt")
    salted = items.withColumn("salt", salt)
    counts = salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # capacity + 1 rows at most
    runs, _ = plan(histogram, capacity)
    table = np.array(sorted(runs), np.int64).reshape(-1, 6)
    ranked = salted.join(starts, ["length", "salt"]).withColumn(
        "rank", F.col("before") + F.row_number().over(Window.partitionBy("length", "salt").orderBy("uid")) - 1
    )
    kept = [c for c in items.columns]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in items.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        firsts = table[:, 0] * (1 << 44) + table[:, 1]
        for batch in batches:
            length, rank = batch.column("length").to_numpy().astype(np.int64), batch.column("rank").to_numpy()
            of = table[np.searchsorted(firsts, length * (1 << 44) + rank, side="right") - 1]
            nth = rank - of[:, 1]
            each = np.maximum(of[:, 4], 1)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in kept], pa.array(of[:, 3] + nth // each), pa.array(of[:, 5] + nth % each * length)],
                [*kept, "sequence_id", "offset"],
            )

    return ranked.select(*kept, "rank").mapInArrow(tidy(run), f"{schema}, sequence_id long, offset long")


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, with_ids: bool = False) -> DataFrame:
    """Every document's ids and end id, cut only beyond the capacity, as written rows.

    (uid, doc_id, piece, start, length, ids_crc32), and ids with ``with_ids``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        fields = [("uid", pa.int64()), ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
        schema = pa.schema(fields + ([("ids", pa.list_(pa.int32()))] if with_ids else []))
        uid = TaskContext.get().partitionId() << 40
        for batch in slices(batches, "raw"):
            ids, bounds = encoder(tokenizer).encode(batch.column("raw"))
            ids = np.insert(ids, bounds[1:], np.uint32(end_id))
            n = np.diff(bounds) + 1
            parts = -(-n // capacity)
            doc = np.repeat(np.arange(len(n)), parts)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(parts) - parts, parts)
            start = piece * capacity
            length = np.minimum(n[doc] - start, capacity)
            stops = np.cumsum(length)
            whole = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B")
            crc = [zlib.crc32(whole[4 * (b - k) : 4 * b]) for b, k in zip(stops.tolist(), length.tolist())]
            out = {"uid": uid + np.arange(len(doc)), "doc_id": batch.column("doc_id").take(pa.array(doc)), "piece": piece.astype(np.int32), "start": start, "length": length, "ids_crc32": crc}
            if with_ids:
                out["ids"] = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], stops]), pa.int32()), pa.array(ids.astype(np.int32)))
            uid += len(doc)
            yield batch_of(out, schema)

    more = ", ids array<int>" if with_ids else ""
    return stage(texts(docs).mapInArrow(tidy(run), f"uid long, doc_id long, piece int, start long, length long, ids_crc32 long{more}"))


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = 4096, with_ids: bool = False) -> DataFrame:
    """Every piece of every document with its sequence_id and its offset there."""
    return place(token_pieces(docs, tokenizer, end_id, capacity, with_ids), capacity).drop("uid")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids) of the bins, from pieces with ids; a bin holds ``capacity`` ids at most."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda x: x["ids"])).alias("ids"))
