"""Runs: maximal stretches of words with a period, found by uniting suffix classes by falling common prefix.

Every suffix of a text begins as a class of its own. Neighbours in suffix order are united in falling order
of their common prefix (Kruskal's rule): a union-find holds for each class its positions in ascending order,
the smaller class is merged into the larger. When two positions i < j become neighbours in a class at common
prefix ``l`` and the distance ``q = j - i`` is at most ``l``, the words from i up to j + l have period q, and
nothing extends them to the right; they seed a run if nothing extends them to the left either. For an
exponent of ``least`` the prefix must be ``(least - 1) * q`` or more, so classes are united down to the least
prefix that can seed a run, and words that repeat no such prefix are never touched.

Why nothing is lost or doubled: the first and second period of a run share exactly ``length - q`` words, and
no position between them shares that many (the run would have a smaller period), so they become neighbours
at that prefix. A seed whose period is a multiple of the smallest one, which only ties can make, has the same
stretch as the seed of the smallest, and the smallest is kept.

Defined cases: null and empty texts have no words and no runs; repeated rows give repeated results; a null
doc_id stays null and its text as it is; other columns are ignored; an empty table gives no rows. A text is
held in one task, with some 250 bytes a word; a slice of shorter ones is bounded by its bytes.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kymora.llm import suffixes
from kymora.llm.common import batch_of, slices, texts, tidy
from kymora.llm.words import split_words

SLICE = 4 << 20


@dataclass(frozen=True)
class Rule:
    """A run has at least ``words`` words and ``least`` periods."""

    words: int = 6
    least: int = 4

    @property
    def prefix(self) -> int:
        """The least common prefix that can seed a run."""
        return min(max((self.least - 1) * q, self.words - q) for q in range(1, self.words + 1))


class Positions:
    """Ascending positions in blocks of bounded length, so that an insertion never moves more than a block."""

    MOST = 1024

    def __init__(self, ascending: list[int]) -> None:
        half = self.MOST // 2
        self.blocks = [ascending[k : k + half] for k in range(0, len(ascending), half)]
        self.firsts = [block[0] for block in self.blocks]
        self.size = len(ascending)

    def __len__(self) -> int:
        return self.size

    def __iter__(self) -> Iterator[int]:
        return chain.from_iterable(self.blocks)

    def around(self, p: int) -> tuple[int, int]:
        """The positions before and after ``p``, which is not among them; -1 where there is none."""
        at = bisect_left(self.firsts, p) - 1
        if at < 0:
            return -1, self.firsts[0]
        block = self.blocks[at]
        k = bisect_left(block, p)
        if k < len(block):
            return block[k - 1], block[k]
        return block[-1], self.firsts[at + 1] if at + 1 < len(self.firsts) else -1

    def add(self, p: int) -> None:
        at = max(bisect_left(self.firsts, p) - 1, 0)
        block = self.blocks[at]
        insort(block, p)
        self.firsts[at] = block[0]
        self.size += 1
        if len(block) > self.MOST:
            half = self.MOST // 2
            self.blocks[at : at + 1] = [block[:half], block[half:]]
            self.firsts.insert(at + 1, block[half])


def around(held: list[int], p: int) -> tuple[int, int]:
    """As ``Positions.around``, in a plain list."""
    k = bisect_left(held, p)
    return held[k - 1] if k else -1, held[k] if k < len(held) else -1


def seeds(a: np.ndarray, b: np.ndarray, prefix: np.ndarray, rule: Rule) -> tuple[list[int], list[int], list[int]]:
    """(position, period, prefix) of positions that become neighbours; edges come in falling order of prefix."""
    place, where = np.unique(np.concatenate([a, b]), return_inverse=True)
    where = where.tolist()
    held: list = [[p] for p in place.tolist()]  # positions of a class, ascending, at its root
    root = list(range(len(place)))
    out: tuple[list[int], list[int], list[int]] = ([], [], [])
    more, words = rule.least - 1, rule.words

    def near(i: int, j: int, shared: int) -> None:
        if (j - i) * more <= shared and j - i + shared >= words:
            for values, value in zip(out, (i, j - i, shared)):
                values.append(value)

    for x, y, shared in zip(where[: len(a)], where[len(a) :], prefix.tolist()):
        while root[x] != x:
            root[x] = x = root[root[x]]
        while root[y] != y:
            root[y] = y = root[root[y]]
        if len(held[x]) < len(held[y]):
            x, y = y, x
        large, small = held[x], held[y]
        root[y], held[y] = x, None
        blocked = isinstance(large, Positions)
        for p in small:  # all looked up before any is added: neighbours are of the other class
            left, right = large.around(p) if blocked else around(large, p)
            if left >= 0:
                near(left, p, shared)
            if right >= 0:
                near(p, right, shared)
        if len(small) * 8 > len(large):
            joined = sorted([*large, *small])  # two ascending rows: a merge
            held[x] = Positions(joined) if len(joined) > Positions.MOST else joined
        elif blocked:
            for p in small:
                large.add(p)
        else:
            for p in small:
                insort(large, p)
            if len(large) > Positions.MOST:
                held[x] = Positions(large)
    return out


def find_runs(index: np.ndarray, bounds: np.ndarray, rule: Rule = Rule()) -> np.ndarray:
    """Rows (text, start, length, period) of all runs, by text, start and period; ``start`` counts from the text's first word."""
    n = len(index)
    none = np.zeros((0, 4), np.int64)
    if not n:
        return none
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    stop = bounds[1:][text]
    symbol, count = suffixes.symbols(index, text)
    suffix = suffixes.suffix_order(symbol, count, stop)
    shared = suffixes.shared_prefixes(symbol, suffix, stop)
    at = np.flatnonzero(shared >= rule.prefix)
    if not len(at):
        return none
    at = at[np.argsort(-shared[at], kind="stable")]
    i, q, prefix = (np.asarray(c, np.int64) for c in seeds(suffix[at - 1], suffix[at], shared[at], rule))
    first = bounds[text[i]]
    open_left = (i > first) & (symbol[np.maximum(i - 1, 0)] == symbol[np.maximum(i + q - 1, 0)])
    i, q, prefix, first = (c[~open_left] for c in (i, q, prefix, first))
    got = np.stack([text[i], i - first, q + prefix, q], 1)
    got = got[np.lexsort((got[:, 3], got[:, 2], got[:, 1], got[:, 0]))]
    # a stretch has one smallest period
    same = np.zeros(len(got), bool)
    same[1:] = (got[1:, :3] == got[:-1, :3]).all(1)
    got = got[~same]
    return got[np.lexsort((got[:, 3], got[:, 1], got[:, 0]))]


def planted(index: np.ndarray, bounds: np.ndarray, mark: np.ndarray) -> np.ndarray:
    """Word indexes with a periodic end in the texts whose mark divides by ten; a negative mark leaves a text as it is."""
    n = np.diff(bounds)
    g = mark // 10
    chosen = (mark >= 0) & (mark % 10 == 0) & (n > 0)
    a = np.where(chosen, g % np.maximum(n, 1), n)
    p = 1 + (n - a) // (3 + g % 8)
    each = np.arange(len(index)) - np.repeat(bounds[:-1], n)
    a, p = np.repeat(a, n), np.repeat(p, n)
    from_word = np.where(each >= a, a + (each - a) % p, each)
    return index[np.repeat(bounds[:-1], n) + from_word]


def best_run(rows: list[list[int]]) -> list[int] | None:
    """(start, length, period) of the greatest exponent, compared exactly; ties go to the smallest start, then period."""
    best = None
    for row in rows:
        if best is None or row[1] * best[2] > best[1] * row[2]:
            best = row
    return best


def digest(raw: pa.Array, mark: np.ndarray, rule: Rule) -> dict:
    """What ``periodic_runs`` returns of each text, without its doc_id."""
    words = split_words(raw)
    bounds = words.bounds
    index = planted(words.index, bounds, mark)
    runs = find_runs(index, bounds, rule)
    n_texts = len(bounds) - 1
    edge = np.zeros(len(index) + 1, np.int64)
    begin = bounds[runs[:, 0]] + runs[:, 1]
    np.add.at(edge, begin + runs[:, 3], 1)
    np.add.at(edge, begin + runs[:, 2], -1)
    kept = np.cumsum(edge[:-1]) == 0
    ends = np.concatenate([[0], np.cumsum(kept)])[bounds]
    left = words.distinct.take(pa.array(index[kept]))
    joined = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), left), pa.scalar(b" ", pa.large_binary()))
    of = np.searchsorted(runs[:, 0], np.arange(n_texts + 1))
    rows = runs[:, 1:].tolist()
    out: dict = {c: [] for c in ("start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")}
    for k, (a, b) in enumerate(zip(of.tolist(), of[1:].tolist())):
        top = best_run(rows[a:b])
        for name, value in zip(("start", "length", "period"), top or (None, None, None)):
            out[name].append(value)
        out["exponent_milli"].append(1000 * top[1] // top[2] if top else None)
        told = "".join(f"{s},{length},{q}\n" for s, length, q in rows[a:b])
        out["runs_sha256"].append(hashlib.sha256(told.encode()).hexdigest())
        out["collapsed_sha256"].append(hashlib.sha256(joined[k].as_buffer()).hexdigest())
    return {"n_runs": np.diff(of), **out}


def _marked(docs: DataFrame, plant: bool) -> DataFrame:
    """(doc_id, raw, mark): the mark is the checksum of the decimal doc_id, or -1."""
    mark = F.crc32(F.col("doc_id").cast("string").cast("binary")) if plant else F.lit(-1)
    return texts(docs).withColumn("mark", F.coalesce(mark.cast("long"), F.lit(-1).cast("long")))


def run_table(docs: DataFrame, rule: Rule = Rule(), plant: bool = False) -> DataFrame:
    """(doc_id, start, length, period) of every run of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(c, pa.int64()) for c in ("doc_id", "start", "length", "period")])
        for batch in slices(batches, "raw", SLICE):
            words = split_words(batch.column("raw"))
            got = find_runs(planted(words.index, words.bounds, batch.column("mark").to_numpy()), words.bounds, rule)
            yield batch_of({"doc_id": batch.column("doc_id").take(pa.array(got[:, 0])), "start": got[:, 1], "length": got[:, 2], "period": got[:, 3]}, schema)

    return _marked(docs, plant).mapInArrow(tidy(run), "doc_id long, start long, length long, period long")


def periodic_runs(docs: DataFrame, rule: Rule = Rule(), plant: bool = False) -> DataFrame:
    """One row a document: number of runs, the one of greatest exponent, checksums of all runs and of the words left.

    A word is left out if a run holds it after its first period. ``plant`` gives every text whose id's checksum
    divides by ten a periodic end first.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        longs = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli"]
        schema = pa.schema([*[(c, pa.int64()) for c in longs], ("runs_sha256", pa.string()), ("collapsed_sha256", pa.string())])
        for batch in slices(batches, "raw", SLICE):
            yield batch_of({"doc_id": batch.column("doc_id"), **digest(batch.column("raw"), batch.column("mark").to_numpy(), rule)}, schema)

    return _marked(docs, plant).mapInArrow(
        tidy(run), "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
    )
