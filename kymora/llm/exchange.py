"""Exchange clustering of all words, however many: neighbours kept by word, classes sent from word to word.

Words are numbers. Those that every task knows (*held*) have small ones, their classes are an array that goes to
every task. All others (*loose*) have 62 bits of their hash, from ``LOOSE`` on; two words of one hash would move as
one. Every word lives in a bucket, given by its number; a bucket is one partition and has what it needs to place its
words: who stands before and after each, and how often. Where the neighbour is held, its class is looked up;
where it is loose, its own bucket sends its class, after every round in which it may move, summed by word, side
and class. A word with ``SPLIT`` occurrences or more is dealt over several buckets, by its neighbours, and placed by
the driver from a row of class counts a bucket.

Nothing but the table of class bigrams, the classes of held words and the counts of split words (one for each
``SPLIT`` tokens at most) reaches the driver.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame

from kymora.llm.common import batch_of, give_back, tidy
from kymora.llm.words import raw_bytes

LOOSE = 1 << 62  # numbers of words that are not held begin here
CHUNK = 3 << 18  # symbols whose neighbours are counted at once
SHARE = 1 << 21  # tokens a bucket
SPLIT = 1 << 22  # occurrences of a word in one bucket
BATCH = 1 << 15  # words placed at once
NEAR, CAME, STATE, MOVED, PART = range(5)  # kinds of records


def hashed(words: pa.Array) -> np.ndarray:
    """The number of each word that is not held."""
    data, bounds = raw_bytes(words)
    if not len(data):
        return np.zeros(0, np.int64)
    place = np.arange(len(data)) - np.repeat(bounds[:-1], np.diff(bounds))
    z = (place * 256 + data + 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        z = (z ^ (z >> np.uint64(shift))) * np.uint64(factor)
    z ^= z >> np.uint64(31)
    return (np.add.reduceat(z, bounds[:-1]) >> np.uint64(2)).astype(np.int64) | LOOSE


def _pack(*arrays: np.ndarray) -> tuple[int, bytes]:
    raw = pickle.dumps(arrays, 5)
    return len(raw), pa.compress(raw, codec="zstd", asbytes=True)


def _unpack(size: int, blob: bytes) -> tuple[np.ndarray, ...]:
    return pickle.loads(pa.decompress(blob, size, codec="zstd", asbytes=True))


def _edges(x: np.ndarray) -> np.ndarray:
    """Where equal values begin, and the end."""
    return np.concatenate([[0], np.flatnonzero(np.diff(x)) + 1, [len(x)]]) if len(x) else np.zeros(1, np.int64)


def bucket_of(number: np.ndarray, buckets: int) -> np.ndarray:
    return number % buckets


def _distinct(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x[np.append(True, x[1:] != x[:-1])] if len(x) else x


def _order(key: np.ndarray) -> np.ndarray:
    """Where the keys, none below 0, stand in order; places ride in their low bits where there is room."""
    bits = len(key).bit_length()
    if not len(key) or int(key.max()).bit_length() + bits > 62:
        return np.argsort(key, kind="stable")
    return np.sort(key << bits | np.arange(len(key))) & ((1 << bits) - 1)


def _neighbours(numbers: list[np.ndarray], places: list[np.ndarray], end: int, shares: dict[int, int], buckets: int) -> Iterator[tuple[int, int, int, bytes]]:
    """Who stands beside whom in texts that each end with ``end``: one record a bucket. ``places`` say which of the numbers stand where."""
    u, at = np.unique(np.concatenate(numbers), return_inverse=True)
    first = np.cumsum([0, *map(len, numbers)])
    at = np.concatenate([at[p + k] for p, k in zip(places, first.tolist())])
    v, loose = len(u), u >= LOOSE
    key = np.sort(np.append(np.searchsorted(u, end), at[:-1]) * v + at)
    runs = _edges(key)
    key, n = key[runs[:-1]], np.diff(runs)
    a = key // v
    b = key - a * v
    w, o, after, n = np.append(a, b), np.append(b, a), np.repeat([1, 0], len(a)), np.append(n, n)
    kept = loose[w] | ~loose[o]  # a loose neighbour sends its class itself
    w, o, after, n = w[kept], o[kept], after[kept], n[kept]
    part = np.zeros(len(w), np.int64) if shares else 0
    for number, share in shares.items():
        mine = w == np.searchsorted(u, number) if number in u else np.zeros(len(w), bool)
        part[mine] = u[o[mine]] % share
    bucket = bucket_of(u, buckets)[w] if not shares else bucket_of(u[w] + part, buckets)
    order = _order(bucket * (2 * v) + w * 2 + after)
    w, o, after, n, bucket = w[order], o[order], after[order], n[order], bucket[order]
    edges = _edges(bucket)
    for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist()):
        far = loose[o[lo:hi]]
        fw, fo, fa, fn = (x[lo:hi][~far] for x in (w, o, after, n))
        runs = _edges(fw * 2 + fa)
        lw, lo2, la, ln = (x[lo:hi][far] for x in (w, o, after, n))
        yield int(bucket[lo]), NEAR, *_pack(
            u[fw[runs[:-1]]], fa[runs[:-1]].astype(bool), np.diff(runs).astype(np.int32), u[fo].astype(np.int32), fn.astype(np.int32), u[lw], la.astype(bool), u[lo2], ln.astype(np.int32)
        )


def neighbours(docs: DataFrame, symbols: Callable[[Iterator[pa.RecordBatch]], Iterator[tuple[np.ndarray, np.ndarray]]], end: int, shares: dict[int, int], buckets: int) -> DataFrame:
    """(bucket, kind, size, blob) of all texts; ``symbols`` gives numbers, and which of them stand where in whole texts, each with its end."""
    most = CHUNK

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("bucket", pa.int64()), ("kind", pa.int32()), ("size", pa.int64()), ("blob", pa.binary())])

        def counted(parts: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
            rows = [*zip(*_neighbours(*map(list, zip(*parts)), end, shares, buckets))]
            yield batch_of(dict(zip(schema.names, rows)), schema)

        parts: list[tuple[np.ndarray, np.ndarray]] = []
        for x in symbols(batches):
            parts.append(x)
            if sum(len(places) for _, places in parts) >= most:
                yield from counted(parts)
                parts = []
        if sum(len(places) for _, places in parts):
            yield from counted(parts)

    return docs.mapInArrow(tidy(run), "bucket long, kind int, size long, blob binary")


def _same(bucket: int) -> int:
    return bucket


def _dealt(records: RDD, buckets: int) -> RDD:
    return records.partitionBy(buckets, _same)  # the same function each time: a union then needs no shuffle


def _record(row) -> tuple[int, tuple[int, int, bytes]]:
    return row[0], (row[1], row[2], bytes(row[3]), 0, 0)


def h(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def likelihood(table: np.ndarray) -> float:
    """Of the class bigrams, up to a term that no exchange changes."""
    return float(h(table).sum() - h(table.sum(0)).sum() - h(table.sum(1)).sum())


def _entries(near: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, class, n) of all that are not 0."""
    at = np.flatnonzero(near.ravel() > 0)
    i = at // near.shape[1]
    return i, at - i * near.shape[1], near.ravel()[at]


def _gains(table: np.ndarray, words: int, i: np.ndarray, c: np.ndarray, n: np.ndarray) -> np.ndarray:
    """By word and class: what neighbours (word, class, n) add to h of the lines of the class."""
    kinds, at = np.unique(n * len(table) + c, return_inverse=True)
    n, c = np.divmod(kinds, len(table))
    lines = table[c.astype(np.int64)].T
    out = np.zeros((words, table.shape[1]))
    if len(i):
        edges = _edges(i)[:-1]
        out[i[edges]] = np.add.reduceat((h(lines + n) - h(lines)).take(at, axis=1), edges, axis=1).T
    return out


def _best(table: np.ndarray, own: np.ndarray, left: np.ndarray, right: np.ndarray, itself: np.ndarray, free: int) -> np.ndarray:
    words = np.arange(len(own))
    left, right = left.copy(), right.copy()
    left[words, own] -= itself  # its own repeats go with it
    right[words, own] -= itself
    n_left, n_right, rows, cols = left.sum(1) + itself, right.sum(1) + itself, table.sum(1), table.sum(0)
    after, before = _entries(right), _entries(left)
    gain = _gains(table[:free].T, len(own), *after) + _gains(table[:, :free], len(own), *before)
    # lines of other classes have lost the word's neighbours where they cross its own
    for mine, lost, crossing in ((right, left, table[:free].T), (left, right, table[:, :free])):
        i = np.flatnonzero(mine[words, own])
        line, n, gone = crossing[own[i]], mine[i, own[i]][:, None], lost[i, :free]
        gain[i] += h(line - gone + n) - h(line - gone) - (h(line + n) - h(line))
    # the corner belongs to both lines
    i, c = np.nonzero((left[:, :free] > 0) & (right[:, :free] > 0) | (itself > 0)[:, None])
    d, l, r = table[c, c], left[i, c], right[i, c]  # noqa: E741
    gain[i, c] += h(d + l + r + itself[i]) + h(d) - h(d + l) - h(d + r)
    for total, n in ((rows, n_right), (cols, n_left)):
        kinds, at = np.unique(n, return_inverse=True)
        gain -= (h(total[:free] + kinds[:, None]) - h(total[:free]))[at]
    # where it stands
    stay = np.zeros(len(own))
    for (i, c, n), lines in ((after, table), (before, table.T)):
        other = c != own[i]
        i, c, n = i[other], c[other], n[other]
        t = lines[own[i], c]
        stay += np.bincount(i, h(t) - h(t - n), len(own))
    d = table[own, own]
    stay += h(d) - h(d - left[words, own] - right[words, own] - itself)
    stay -= h(rows[own]) - h(rows[own] - n_right) + h(cols[own]) - h(cols[own] - n_left)
    gain[words, own] = stay
    top = gain.argmax(1)
    return np.where(gain[words, top] > stay + 1e-9, top, own)


def best_classes(table: np.ndarray, own: np.ndarray, left: np.ndarray, right: np.ndarray, itself: np.ndarray, free: int) -> np.ndarray:
    """Where among the first ``free`` classes each word does best by itself; left, right: its neighbours by class."""
    ends = np.cumsum(np.count_nonzero(left, 1) + np.count_nonzero(right, 1) + 1)
    cuts = np.unique(np.searchsorted(ends, np.arange(0, ends[-1] if len(ends) else 0, 1 << 15), "right"))
    out = [_best(table, own[a:b], left[a:b], right[a:b], itself[a:b], free) for a, b in zip(np.append(0, cuts), np.append(cuts, len(own))) if b > a]
    return np.concatenate([np.zeros(0, np.int64), *out])


Latest = tuple[int, int]  # the turn in which the loose words of either half sent their classes last


NEAR_TYPES = (np.int64, bool, np.int32, np.int32, np.int32, np.int64, bool, np.int64, np.int32)  # words, sides and lengths of runs, neighbours, n; loose words beside loose words
MERGED_TYPES = (np.int64, np.int32, bool, np.int32, np.int32, np.int64, np.int32, bool, np.int64, np.int32)  # words; the same by place among them
CAME_TYPES, STATE_TYPES = (np.int64, np.int32, np.int64), (np.int64, np.int32)


def _joined(blobs: list[tuple[np.ndarray, ...]], types: tuple) -> list[np.ndarray]:
    return [np.concatenate([np.zeros(0, t), *x]) for t, x in zip(types, [*zip(*blobs)] or [()] * len(types))]


def _merged(records: Iterator) -> Iterator:
    """All that a bucket has of its words and their neighbours as one record, each neighbour once."""
    blobs, at = [], -1
    for at, (_, size, blob, *_) in records:
        blobs.append(_unpack(size, blob))
    if not blobs:
        return
    run, after, length, other, n, far_w, far_after, far_other, far_n = _joined(blobs, NEAR_TYPES)
    del blobs
    words = _distinct(np.append(_distinct(run), _distinct(far_w)))
    most = int(other.max()) + 1 if len(other) else 1
    key = np.repeat((np.searchsorted(words, run) * 2 + after) * most, length) + other
    order = _order(key)
    key, n = key[order], n[order].astype(np.int64)
    first = _edges(key)[:-1]
    key, n = key[first], np.add.reduceat(n, first) if len(first) else n
    w = key // most
    runs = _edges(w)
    of_run = w[runs[:-1]]
    yield at, (NEAR, *_pack(
        words, (of_run // 2).astype(np.int32), of_run % 2 == 1, np.diff(runs).astype(np.int32), (key - w * most).astype(np.int32), n if n.max(initial=0) >> 31 else n.astype(np.int32),
        np.searchsorted(words, far_w).astype(np.int32), far_after, far_other, far_n,
    ), 0, 0)
    give_back()


def _read(records: Iterator, latest: Latest) -> list[list[np.ndarray]]:
    """By kind what a partition has; of classes that were sent, those of the latest turn of each half."""
    found: list[list] = [[], [], []]
    for _, (kind, size, blob, half, turn) in records:
        if kind == NEAR or kind <= STATE and latest[half] == turn:
            found[kind].append(_unpack(size, blob))
    return [list(rows[0]) if kind == NEAR and rows else _joined(rows, types) for kind, (rows, types) in enumerate(zip(found, (MERGED_TYPES, CAME_TYPES, STATE_TYPES)))]


def _half(words: np.ndarray, free: int) -> np.ndarray:
    """Which words are placed in even turns (0) and in odd ones (1)."""
    return (words // free + words) % 2


def _table(records: Iterator, latest: Latest, of: np.ndarray, k: int) -> np.ndarray:
    """Class bigrams of a bucket: how often class b follows class a."""
    (words, run, after, length, other, n, *_), (came_w, came_slot, came_n), (loose, classes) = _read(records, latest)
    order = np.argsort(loose)
    loose, classes = loose[order], classes[order]

    def cls(words: np.ndarray) -> np.ndarray:
        far = words >= LOOSE
        out = of[np.where(far, 0, words)]
        out[far] = classes[np.searchsorted(loose, words[far])]
        return out

    mine, came = np.repeat(after, length), came_slot >= k
    at = np.concatenate([np.repeat(cls(words)[run[after]] * k, length[after]) + of[other[mine]], cls(came_w[came]) * k + came_slot[came] - k])
    return np.bincount(at, np.concatenate([n[mine], came_n[came]]), k * k).reshape(k, k)


class _Bucket:
    """All that a partition has: words, their classes, and each word's neighbours by class as (word, side, class, n)."""

    def __init__(self, records: Iterator, latest: Latest, of: np.ndarray, free: int):
        near, came, state = _read(records, latest)
        words, run, after, length, self.other, self.n, far_w, self.far_after, self.far_other, self.far_n = near
        self.words = _distinct(np.append(words, _distinct(came[0])))
        place = np.searchsorted(self.words, words)
        self.w = np.repeat(place[run], length)
        self.after = np.repeat(after, length)
        self.far_w = place[far_w]
        self.came_w, self.came_slot, self.came_n = np.searchsorted(self.words, came[0]), came[1], came[2]
        self.loose = self.words >= LOOSE
        self.half = _half(self.words, free)
        self.of, self.k = of, free + 2
        self.cls = np.zeros(len(self.words), np.int64)
        self.cls[~self.loose] = of[self.words[~self.loose]]
        self.cls[self.loose] = self.words[self.loose] % free
        self.cls[np.searchsorted(self.words, state[0])] = state[1]

    def vectors(self, chosen: np.ndarray, batch: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Of some of the words: (places, neighbours before by class, after by class, how often it follows itself)."""
        k = self.k
        slot = self.after * k + self.of[self.other]
        again = self.after & (self.words[self.w] == self.other)
        far_again = self.far_after & (self.words[self.far_w] == self.far_other)
        itself = np.bincount(np.append(self.w[again], self.far_w[far_again]), np.append(self.n[again], self.far_n[far_again]), len(self.words))
        rank = np.full(len(self.words), -1)
        rank[chosen] = np.arange(len(chosen))
        a, b = rank[self.w], rank[self.came_w]
        x, y = a >= 0, b >= 0
        at, n = np.append(a[x] * (2 * k) + slot[x], b[y] * (2 * k) + self.came_slot[y]), np.append(self.n[x], self.came_n[y])
        for first in range(0, len(chosen), batch):
            some = chosen[first : first + batch]
            low, most = first * 2 * k, len(some) * 2 * k
            here = (at >= low) & (at < low + most)
            both = np.bincount(at[here] - low, n[here], most).reshape(len(some), 2, k)
            yield some, both[:, 0], both[:, 1], itself[some]

    def sent(self, half: int, buckets: int) -> Iterator[tuple[int, int, int, bytes]]:
        """The classes of loose words of one half, to the buckets of their neighbours."""
        k, mine = self.k, self.loose & (self.half == half)
        loose, far = mine[self.w], mine[self.far_w]
        slot = (~self.after[loose]) * k + self.cls[self.w[loose]]
        key = self.other[loose].astype(np.int64) * (2 * k) + slot
        order = _order(key)
        key, n = key[order], self.n[loose][order].astype(np.int64)
        runs = _edges(key)[:-1]
        key, n = key[runs], np.add.reduceat(n, runs) if len(runs) else n
        to = np.append(key // (2 * k), self.far_other[far])
        slots = np.append(key % (2 * k), (~self.far_after[far]) * k + self.cls[self.far_w[far]]).astype(np.int32)
        n = np.append(n, self.far_n[far])
        bucket = bucket_of(to, buckets)
        order = _order(bucket)
        to, slots, n, bucket = to[order], slots[order], n[order], bucket[order]
        edges = _edges(bucket)
        for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist()):
            yield int(bucket[lo]), CAME, *_pack(to[lo:hi], slots[lo:hi], n[lo:hi])


@dataclass
class Clusters:
    of: np.ndarray  # classes of held words, of rare words and ends
    table: np.ndarray
    loose: DataFrame  # (number, class)


def cluster(near: DataFrame, words: int, known: int, classes: int, rounds: int, shares: dict[int, int], buckets: int) -> Clusters:
    """Words are dealt to classes and exchanged; ``words`` held ones, ``known`` with the loose ones."""
    spark = near.sparkSession
    free = max(1, min(classes, known))
    batch = BATCH
    split = np.array(sorted(shares), np.int64)
    beside = _dealt(near.rdd.map(_record), buckets).mapPartitions(_merged, preservesPartitioning=True).persist(StorageLevel.DISK_ONLY)

    def with_classes(came: dict[int, RDD]) -> RDD:
        both = beside
        for records in came.values():
            both = both.union(records)
        if both.getNumPartitions() != beside.getNumPartitions():
            raise RuntimeError("buckets do not meet")
        return both

    def step(came: dict[int, RDD], latest: Latest, of: np.ndarray, table: np.ndarray | None, turn: int) -> RDD:
        def run(at: int, records: Iterator) -> Iterator:
            x = _Bucket(records, latest, of, free)
            if table is not None:
                new = x.cls.copy()
                for some, left, right, itself in x.vectors(np.flatnonzero((x.half == turn % 2) & (x.loose | (x.words < words))), batch):
                    apart = np.isin(x.words[some], split)
                    if apart.any():
                        yield at, (PART, *_pack(x.words[some[apart]], left[apart], right[apart], itself[apart]), 0, turn)
                    new[some[~apart]] = best_classes(table, x.cls[some[~apart]], left[~apart], right[~apart], itself[~apart], free)
                moved = (new != x.cls) & ~x.loose
                if moved.any():
                    yield at, (MOVED, *_pack(x.words[moved], new[moved]), 0, turn)
                x.cls = new
            for half in (0, 1) if table is None else (turn % 2,):
                mine = x.loose & (x.half == half)
                if mine.any():
                    yield at, (STATE, *_pack(x.words[mine], x.cls[mine].astype(np.int32)), half, turn)
                    for bucket, *record in x.sent(half, buckets):
                        yield bucket, (*record, half, turn)
            del x
            give_back()

        return _dealt(with_classes(came).mapPartitionsWithIndex(run), buckets)

    def class_table(came: dict[int, RDD], latest: Latest, of: np.ndarray) -> np.ndarray:
        def run(records: Iterator) -> Iterator[np.ndarray]:
            yield _table(records, latest, of, free + 2)
            give_back()

        return with_classes(came).mapPartitions(run).treeReduce(np.add)

    of = np.append(np.arange(words) % free, [free, free + 1])
    latest, came = (-1, -1), {-1: step({}, (-1, -1), of, None, -1)}
    table = class_table(came, latest, of)
    best = (likelihood(table), of, table, came, latest)
    for turn in range(rounds):
        moves = step(came, latest, of, table, turn)
        latest = (turn, latest[1]) if turn % 2 == 0 else (latest[0], turn)
        came = {t: records for t, records in [*came.items(), (turn, moves)] if t in latest}
        told = moves.filter(lambda r: r[1][0] >= MOVED).map(lambda r: r[1][:3]).collect()  # held words that move, one row a bucket of split ones
        of, parts = of.copy(), []
        for kind, size, blob in told:
            got = _unpack(size, blob)
            if kind == MOVED:
                of[got[0]] = got[1]
            else:
                parts.append(got)
        if parts:
            w, left, right, itself = (np.concatenate(x) for x in zip(*parts))
            number, at = np.unique(w, return_inverse=True)
            sums = [np.zeros((len(number), *x.shape[1:])) for x in (left, right, itself)]
            for total, x in zip(sums, (left, right, itself)):
                np.add.at(total, at, x)
            of[number] = best_classes(table, of[number], *sums, free)
        table = class_table(came, latest, of)
        if likelihood(table) > best[0]:
            best = (likelihood(table), of, table, came, latest)

    def classes_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("number", pa.int64()), ("class", pa.int32())])
        for batch in batches:
            for size, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                number, cls = _unpack(size, blob)
                yield batch_of({"number": number, "class": cls}, schema)

    beside.unpersist()
    _, of, table, came, latest = best
    state = spark.sparkContext.union([*came.values()]).filter(lambda r: r[1][0] == STATE and latest[r[1][3]] == r[1][4]).map(lambda r: r[1][1:3])
    loose = spark.createDataFrame(state, "size long, blob binary").mapInArrow(tidy(classes_of), "number long, class int")
    return Clusters(of, table, loose)
