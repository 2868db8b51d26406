"""A sparse document-term matrix in row-compressed shards, its words numbered once for all shards.

1. Each slice of documents becomes a shard: its words are numbered in the order of their hash, its counts
   stand as (indptr, indices, data), and the shard's own list of words goes with it.
2. Only these lists are shuffled, cut into ranges of the hash: a word comes once from each shard, however
   often it occurs. A task reads a range shard by shard and numbers each word where it first appears, so it
   holds the range's distinct words and no lists; there are as many ranges as keep that to ``RANGE_BYTES``.
   Ranges begin where the ones before them end, so numbers have no gaps.
3. The numbers go back to their shard, which is rewritten with them: columns ascend within a row.

A shard is bounded by its bytes; one longer text stands alone. Its arrays are binary columns, first differences
as compressed little-endian integers (``packed``, ``unpacked``); its words stand in one binary, a space between any
two, which no word contains.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kymora.llm.common import batch_of, partitions, slices, stage, tidy
from kymora.llm.phrases import _seeds, mix
from kymora.llm.words import raw_bytes, split_words

SHARD_BYTES = 4 << 20
RANGE_BYTES = 2 << 20
HASH_BITS = 40
CSR = "indptr binary, indices binary, data binary"


def _list(values: pa.Array, kind: pa.DataType) -> pa.Array:
    """One row that holds all values."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values.cast(kind))


def packed(values: np.ndarray) -> bytes:
    """First differences as 64-bit integers, a plane of bytes after the other, compressed: columns ascend, so most planes are zeros."""
    steps = np.diff(np.asarray(values, "<i8"), prepend=0)
    return zstandard.compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def unpacked(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(blob), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<i8").reshape(-1))


def joined(words: pa.Array) -> bytes:
    """The words with a space between any two."""
    data, bounds = raw_bytes(words)
    out = np.full(max(len(data) + len(words) - 1, 0), 0x20, np.uint8)
    out[np.arange(len(data)) + np.repeat(np.arange(len(words)), np.diff(bounds))] = data
    return out.tobytes()


def parted(line: bytes) -> pa.Array:
    """The words of a joined line."""
    data = np.frombuffer(line, np.uint8)
    if not len(data):
        return pa.array([], pa.large_binary())
    space = data == 0x20
    bounds = np.concatenate([[0], np.flatnonzero(space) - np.arange(space.sum()), [len(data) - space.sum()]])
    return pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(data[~space])])


def word_keys(words: pa.Array) -> np.ndarray:
    """A hash of ``HASH_BITS`` bits for each word; a word has a byte at least."""
    data, bounds = raw_bytes(words)
    if not len(words):
        return np.zeros(0, np.int64)
    size = np.diff(bounds)
    place = np.arange(len(data)) - np.repeat(bounds[:-1], size)
    total = np.add.reduceat((data.astype(np.uint64) + np.uint64(1)) * _seeds(int(size.max()), 17)[place], bounds[:-1])
    return (mix(total + size.astype(np.uint64)) >> np.uint64(64 - HASH_BITS)).astype(np.int64)


def rows_of_words(index: np.ndarray, text: np.ndarray, n_texts: int, n_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(indptr, indices, data): how often each text holds each word, words ascending."""
    key, data = np.unique(text * max(n_words, 1) + index, return_counts=True)
    row, column = np.divmod(key, max(n_words, 1))
    return np.searchsorted(row, np.arange(n_texts + 1)), column, data


def local_shards(docs: DataFrame, facts: Callable[[pa.RecordBatch], dict[str, pa.Array]], kinds: dict[str, pa.DataType], ddl: str) -> DataFrame:
    """Written shards with numbers of their own: (shard, facts of each document, indptr, indices, data, words).

    ``docs`` has the texts as ``raw``; ``facts`` gives the columns, named by ``kinds`` and ``ddl``, that each document keeps.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        schema = pa.schema([("shard", pa.int64()), *[(k, pa.list_(t)) for k, t in kinds.items()], *[(c, pa.binary()) for c in ("indptr", "indices", "data", "words")]])
        shard = TaskContext.get().partitionId() << 32
        for batch in slices(batches, "raw", SHARD_BYTES):
            words = split_words(batch.column("raw"))
            order = np.argsort(word_keys(words.distinct), kind="stable")
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            indptr, indices, data = rows_of_words(place[words.index], words.text, batch.num_rows, len(order))
            told = facts(batch)
            yield batch_of(
                {
                    "shard": [shard], **{k: _list(told[k], t) for k, t in kinds.items()},
                    "indptr": [packed(indptr)], "indices": [packed(indices)], "data": [packed(data)], "words": [joined(words.distinct.take(pa.array(order)))],
                },
                schema,
            )
            shard += 1

    return stage(docs.mapInArrow(tidy(run), f"shard long, {ddl}, {CSR}, words binary"))


def numbered(shards: DataFrame) -> DataFrame:
    """(shard, first, nth, before, fresh, words): the numbers over all shards of a shard's words from ``first`` on.

    A word's number is ``before`` plus its entry in ``nth`` (binary, 32 bits). ``words`` are those that are met there
    for the first time; their numbers go on from ``before + fresh``.
    """
    held = shards.agg(F.sum(F.length("words"))).first()[0]
    ranges = max(1, -(-(held or 0) // RANGE_BYTES))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("range", pa.int64()), ("shard", pa.int64()), ("first", pa.int64()), ("words", pa.binary())])
        for batch in batches:
            for shard, line in zip(batch.column("shard").to_pylist(), batch.column("words").to_pylist()):
                words = parted(line)
                at = (word_keys(words) * ranges) >> HASH_BITS
                first = np.flatnonzero(np.diff(at, prepend=-1))
                place = np.append(raw_bytes(words)[1][first] + first, len(line) + 1).tolist()
                yield batch_of({"range": at[first], "shard": np.full(len(first), shard), "first": first, "words": [line[a : b - 1] for a, b in zip(place, place[1:])]}, schema)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("range", pa.int64()), ("shard", pa.int64()), ("first", pa.int64()), ("nth", pa.binary()), ("fresh", pa.int64()), ("words", pa.binary()), ("size", pa.int64())])
        now: int | None = None
        known: dict[bytes, int] = {}

        def row(*values) -> pa.RecordBatch:
            return batch_of({c: [v] for c, v in zip(schema.names, (now, *values))}, schema)

        for batch in batches:
            for at, shard, first, line in zip(*[batch.column(c).to_pylist() for c in ("range", "shard", "first", "words")]):
                if at != now:
                    if now is not None:
                        yield row(None, None, None, None, None, len(known))
                    now, known = at, {}
                fresh, words = len(known), line.split(b" ")
                nth = np.array([known.setdefault(w, len(known)) for w in words], "<i4")
                new = b" ".join([words[k] for k in np.flatnonzero(nth >= fresh).tolist()])
                yield row(shard, first, nth.tobytes(), fresh, new, None)
        if now is not None:
            yield row(None, None, None, None, None, len(known))

    lists = shards.select("shard", "words").mapInArrow(tidy(cut), "range long, shard long, first long, words binary")
    shape = "range long, shard long, first long, nth binary, fresh long, words binary, size long"
    told = stage(lists.repartition(max(ranges, partitions(shards.sparkSession)), "range").sortWithinPartitions("range", "shard").mapInArrow(tidy(number), shape))
    sizes = told.filter("size IS NOT NULL").select("range", "size")
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    starts = sizes.select("range", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("before"))
    return told.filter("size IS NULL").join(starts, "range").select("shard", "first", "nth", "before", "fresh", "words")


def dictionary(numbers: DataFrame) -> DataFrame:
    """(id, word) of all words."""
    new = numbers.filter(F.length("words") > 0).select("before", "fresh", F.posexplode(F.split(F.col("words").cast("string"), " ")).alias("k", "word"))
    return new.select((F.col("before") + F.col("fresh") + F.col("k")).alias("id"), "word")


def csr_shards(shards: DataFrame, numbers: DataFrame | None = None) -> DataFrame:
    """The shards with the numbers of all shards: (shard, facts of each document, indptr, indices, data)."""
    keep = [c for c in shards.columns if c != "words"]
    ids = (numbered(shards) if numbers is None else numbers).select(F.col("shard").alias("of"), "first", "nth", "before")

    def rewrite(left: pa.Table, right: pa.Table) -> pa.Table:
        indptr, indices, data = (unpacked(left.column(c)[0].as_py()) for c in ("indptr", "indices", "data"))
        parts = sorted(zip(*[right.column(c).to_pylist() for c in ("first", "before", "nth")]))
        number = np.concatenate([np.zeros(0, np.int64), *[before + np.frombuffer(nth, "<i4").astype(np.int64) for _, before, nth in parts]])
        row, column = np.repeat(np.arange(len(indptr) - 1), np.diff(indptr)), number[indices]
        order = np.lexsort((column, row))
        out = {c: left.column(c) for c in keep}
        out |= {"indices": pa.array([packed(column[order])]), "data": pa.array([packed(data[order])])}
        return pa.table(out)

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in shards.select(keep).schema)
    return shards.select(keep).groupBy("shard").cogroup(ids.groupBy("of")).applyInArrow(rewrite, schema)


def row_totals(csr: DataFrame, kinds: dict[str, pa.DataType], ddl: str) -> DataFrame:
    """One row a document: its facts, the sum of its row and the number of its nonzero entries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([*kinds.items(), ("row_sum", pa.int64()), ("nonzero", pa.int64())])
        for batch in batches:
            for k in range(batch.num_rows):
                indptr, data = (unpacked(batch.column(c)[k].as_py()) for c in ("indptr", "data"))
                total = np.concatenate([[0], np.cumsum(data)])
                yield batch_of({**{c: batch.column(c)[k].values for c in kinds}, "row_sum": np.diff(total[indptr]), "nonzero": np.diff(indptr).astype(np.int64)}, schema)

    return csr.select(*kinds, "indptr", "data").mapInArrow(tidy(run), f"{ddl}, row_sum long, nonzero long".replace("array<", "").replace(">", ""))
