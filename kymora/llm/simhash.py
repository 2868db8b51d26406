"""SimHash near-duplicates by a generalised pigeonhole over groups of correlated bits.

Fingerprints within ``tau`` bits of each other, cut into m groups of bits whose thresholds sum to
tau - m + 1, are within its threshold in at least one group. A group's threshold may be 0, 1, 2 or -1 (the
group is not probed). The plan is made from counts over all fingerprints: how often each bit, and each
pair of bits, is set. Correlated bits go into the same group, so that the others tell more; for every m
the thresholds are allocated by dynamic programming over the estimated candidates and probes; the cheapest
m is taken. A threshold of t is probed by masking every choice of t bits of the group: two fingerprints
that differ in at most t bits of the group share a masked key.

Links are looked for between distinct fingerprints, never between documents. Fingerprints that share a key
are compared exactly in a task, which gives a spanning forest of their links and not all pairs. A key with
more than ``BUCKET`` fingerprints is never compared at once: its remaining bits are cut into tau + 1 parts,
one of which must agree, and so on. Each turn fixes a third of the remaining bits, and ``BUCKET`` distinct
fingerprints differ in more than ten, so this ends, exactly, however large the group.

Defined cases: null and empty texts have fingerprint zero and link like any other; a text of fewer words
than a shingle is one shingle; repeated rows share a fingerprint; a component of null doc_ids alone has
a null component_id; other columns are ignored; an empty table gives no rows. A text is held in one task, with
some 150 bytes a word; its shingles are summed 65,536 at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kymora.llm.common import batch_of, slices, stage, texts, tidy
from kymora.llm.components import components

BITS, BUCKET, SEED = 64, 2048, 42


def fingerprint(words: list[bytes], width: int) -> int:
    """SimHash over all shingles of ``width`` words, repeats included."""
    if not words:
        return 0
    if len(words) <= width:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    else:
        line = b" ".join(words)
        size = np.fromiter(map(len, words), np.int64, len(words))
        stop = np.cumsum(size + 1) - 1
        begin = stop - size
        view, digest = memoryview(line), xxhash.xxh64_intdigest
        hashes = [digest(view[a:b], SEED) for a, b in zip(begin[: 1 - width or None].tolist(), stop[width - 1 :].tolist())]
    total = np.zeros(BITS, np.int64)
    for a in range(0, len(hashes), 1 << 16):
        part = np.array(hashes[a : a + (1 << 16)], "<u8")
        total += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """(doc_id, fp): the fingerprint of every whole text as a signed 64-bit integer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])
        for batch in slices(batches, "raw"):
            fps = np.array([fingerprint(raw.lower().split(), width) for raw in batch.column("raw").to_pylist()], np.uint64)
            yield batch_of({"doc_id": batch.column("doc_id"), "fp": fps.view(np.int64)}, schema)

    return texts(docs).mapInArrow(tidy(run), "doc_id long, fp long")


def bit_counts(nodes: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints, and for each pair of bits in how many both are set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((BITS, BITS)), 0
        for batch in batches:
            fps = batch.column("fp").to_numpy().astype("<i8")
            for a in range(0, len(fps), 1 << 15):
                x = np.unpackbits(fps[a : a + (1 << 15)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
                total += x.T @ x
            n += len(fps)
        at, to = np.divmod(np.arange(BITS * BITS), BITS)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(to, -1)), pa.array(np.append(total.reshape(-1), n))], ["a", "b", "n"])

    got = nodes.select("fp").mapInArrow(tidy(run), "a long, b long, n double").groupBy("a", "b").agg(F.sum("n").alias("n")).collect()  # 4,097 rows
    table = {(r["a"], r["b"]): r["n"] for r in got}
    n = int(table.pop((-1, -1), 0))
    return n, np.array([[table.get((a, b), 0.0) for b in range(BITS)] for a in range(BITS)])


def group_bits(n: int, both: np.ndarray, m: int) -> list[list[int]]:
    """m groups of about equal size, correlated bits together."""
    p = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    near = np.abs((both / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread))
    np.fill_diagonal(near, 0)
    left = set(range(BITS))
    groups = []
    for k in range(m):
        size = -(-len(left) // (m - k))
        group = [max(left, key=lambda b: (near[b, list(left)].sum(), -b))]
        left.remove(group[0])
        while len(group) < size:
            b = max(left, key=lambda b: (near[b, group].sum(), -b))
            group.append(b)
            left.remove(b)
        groups.append(sorted(group))
    return groups


def allocate(n: int, both: np.ndarray, tau: int) -> list[tuple[list[int], int]]:
    """Groups of bits and their thresholds, by the least estimated candidates and probes."""
    p = np.diag(both) / max(n, 1)
    differ = 2 * p * (1 - p)
    best: tuple[float, list[tuple[list[int], int]]] | None = None
    for m in range(1, 2 * tau + 3):
        groups = group_bits(n, both, m)
        costs = []
        for group in groups:
            spread = np.zeros(tau + 2)
            spread[0] = 1.0
            for b in group:  # chance that two fingerprints differ in exactly t bits of the group
                spread[1:] = spread[1:] * (1 - differ[b]) + spread[:-1] * differ[b]
                spread[0] *= 1 - differ[b]
            within = np.cumsum(spread)
            costs.append({-1: 0.0} | {t: n * comb(len(group), t) + n * n / 2 * within[t] for t in range(min(tau, len(group)) + 1)})
        # least cost for each sum of thresholds so far
        table: dict[int, tuple[float, tuple[int, ...]]] = {0: (0.0, ())}
        for cost in costs:
            nxt: dict[int, tuple[float, tuple[int, ...]]] = {}
            for total, (spent, chosen) in table.items():
                for t, c in cost.items():
                    if total + t not in nxt or spent + c < nxt[total + t][0]:
                        nxt[total + t] = (spent + c, (*chosen, t))
            table = nxt
        if tau - m + 1 in table and (best is None or table[tau - m + 1][0] < best[0]):
            spent, chosen = table[tau - m + 1]
            best = (spent, [(g, t) for g, t in zip(groups, chosen) if t >= 0])
    return best[1]


def _mask(bits) -> int:
    return sum(1 << b for b in bits)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def probe_masks(plan: list[tuple[list[int], int]]) -> list[int]:
    return [_mask(set(group) - set(out)) for group, t in plan for out in combinations(group, t)]


def finer_masks(mask: int, tau: int) -> list[int]:
    """The mask with each of tau + 1 parts of the remaining bits added."""
    rest = [b for b in range(BITS) if not mask >> b & 1]
    return [mask | _mask(rest[k :: tau + 1]) for k in range(tau + 1)]


def _keys(masks: list[int]) -> Column:
    return F.explode(F.array(*[F.struct(F.lit(_signed(m)).alias("mask"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for m in masks]))


def forest(fps: np.ndarray, tau: int) -> list[tuple[int, int]]:
    """Links that join whatever is joined by pairs within ``tau`` bits."""
    left = np.arange(len(fps))
    out = []
    while len(left):
        front, left = [left[0]], left[1:]
        while front and len(left):
            at = front.pop()
            near = np.bitwise_count(fps[left] ^ fps[at]) <= tau
            found = left[near].tolist()
            out += [(at, k) for k in found]
            front += found
            left = left[~near]
    return out


def compare(keyed: DataFrame, tau: int) -> DataFrame:
    """(a, b) links among the fingerprints of each (mask, key), which hold ``BUCKET`` at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["mask", "key", "fp"]
        rest = np.zeros((3, 0), np.int64)

        def work(x: np.ndarray) -> pa.RecordBatch:
            new = np.ones(x.shape[1], bool)
            new[1:] = (x[0, 1:] != x[0, :-1]) | (x[1, 1:] != x[1, :-1])
            start = np.flatnonzero(new)
            stop = np.append(start[1:], x.shape[1])
            fps, a, b = x[2].view(np.uint64), [], []
            two = stop - start == 2
            p = start[two]
            p = p[np.bitwise_count(fps[p] ^ fps[p + 1]) <= tau]
            a.append(x[2][p])
            b.append(x[2][p + 1])
            for s, e in zip(start[stop - start > 2].tolist(), stop[stop - start > 2].tolist()):
                links = np.array(forest(fps[s:e], tau), np.int64).reshape(-1, 2) + s
                a.append(x[2][links[:, 0]])
                b.append(x[2][links[:, 1]])
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])

        for batch in batches:
            x = np.concatenate([rest, np.stack([batch.column(c).to_numpy() for c in names])], axis=1)
            if not x.shape[1]:
                continue
            last = x[:2, -1]
            other = np.flatnonzero((x[0] != last[0]) | (x[1] != last[1]))
            cut = int(other[-1]) + 1 if len(other) else 0
            rest = x[:, cut:]
            if cut:
                yield work(x[:, :cut])
        if rest.shape[1]:
            yield work(rest)

    return keyed.repartition("mask", "key").sortWithinPartitions("mask", "key").mapInArrow(tidy(run), "a long, b long")


def links(nodes: DataFrame, tau: int, bucket: int = BUCKET) -> DataFrame:
    """(a, b) that join all distinct fingerprints ``fp`` within ``tau`` bits, by chains of links."""
    n, both = bit_counts(nodes)
    masks = probe_masks(allocate(n, both, tau))
    keyed = nodes.select("fp", _keys(masks).alias("k")).select("fp", "k.*")
    out = None
    while True:
        keyed = stage(keyed)
        hot = stage(keyed.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > bucket).drop("n"))
        some_hot = not hot.isEmpty()
        got = compare(keyed.join(hot, ["mask", "key"], "left_anti") if some_hot else keyed, tau)
        out = got if out is None else out.union(got)
        if not some_hot:
            return out
        old = [r["mask"] for r in hot.select("mask").distinct().collect()]  # as many as there are masks
        finer = F.create_map(*[x for m in old for x in (F.lit(m), F.array(*[F.lit(_signed(f)) for f in finer_masks(m % (1 << 64), tau)]))])
        keyed = keyed.join(hot, ["mask", "key"], "left_semi").select("fp", F.explode(finer[F.col("mask")]).alias("mask")).select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp")


def near_duplicates(docs: DataFrame, width: int = 3, tau: int = 2, bucket: int = BUCKET) -> DataFrame:
    """(doc_id, fp, component_id) for every row; component_id is the least doc_id reachable by links."""
    prints = stage(fingerprints(docs, width))
    nodes = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(links(nodes, tau, bucket))
    joined = nodes.join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    of = joined.join(named, "root").select("fp", "component_id")
    return prints.join(of, "fp").select("doc_id", "fp", "component_id")


def hex_print(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
