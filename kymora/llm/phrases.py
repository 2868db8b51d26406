"""Document fingerprints by locally consistent parsing.

A text is parsed level by level. At each level runs of one symbol become one symbol; deterministic coin
tossing then labels each symbol by the lowest bit in which it differs from its left neighbour, again and
again until labels are below six; a label greater than both neighbours starts a phrase; and a phrase gets
a name that depends on its symbols alone. Where a cut falls is decided by a bounded neighbourhood, so equal
substrings have equal phrases inside, wherever they stand.

A fingerprint is ``SLOTS`` minima, each under a permutation of its own, over the phrase names of the levels
in ``LEVELS`` (about 9 to 80 characters), 16 bits kept of each. The likeness of two fingerprints, the share
of equal slots, estimates the share of phrase names that the texts have in common.

Neighbouring rows are found without a global sort in one task: rows are dealt to ranges of descending
doc_id, and the first row of each range also goes to the range before it.

Defined cases: null texts count as empty; an empty text has a fingerprint of zeros, like 1 to another empty
one and 0 to any other; null doc_ids come last in descending order and rows of equal doc_id are ordered by
the hash of their text; the only row of a table is its own next document; other columns are ignored; an
empty table gives no rows. A text is held in one task beside the next one, with some 60 bytes a character.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kymora.llm.common import batch_of, partitions, slices, texts, tidy

SLOTS, LEVELS = 64, (2, 3, 4)
TOP = np.uint64(1 << 63)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit mixing step (the finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _seeds(n: int, of: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(of)) | np.uint64(1)


def _toss(label: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Twice the lowest bit in which a label differs from its left neighbour, plus that bit."""
    differ = label[1:] ^ label[:-1]
    one = label.dtype.type(1)
    low = differ & (~differ + one)
    out = np.empty(len(label), np.uint8)
    out[1:] = 2 * np.bitwise_count(low - one) + ((label[1:] & low) != 0)
    out[first] = (label[first] & one).astype(np.uint8)
    return out


def parse_level(names: np.ndarray, bounds: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Names of the phrases of one level, and where each text's phrases begin."""
    n = len(names)
    if not n:
        return names.astype(np.uint64), bounds
    starts = bounds[:-1][np.diff(bounds) > 0]
    new = np.ones(n, bool)
    new[1:] = names[1:] != names[:-1]
    new[starts] = True
    at = np.flatnonzero(new)
    run = np.diff(np.append(at, n))
    x = names[at]
    many = run > 1
    if x.dtype == np.uint32:  # code points leave eleven bits free
        long = run > 2047
        if long.any():  # longer runs are named as on the levels above; other names keep their value
            x = x.astype(np.uint64)
            x[long] = mix(x[long] + (run[long].astype(np.uint64) << np.uint64(21))) | TOP
            many &= ~long
        x[many] += run[many].astype(x.dtype) << x.dtype.type(21)
    else:
        x[many] = mix(x[many] + run[many].astype(np.uint64))
    bounds = np.searchsorted(at, bounds)
    first = bounds[:-1][np.diff(bounds) > 0]
    label = x
    for _ in range(4):
        label = _toss(label, first)
    cut = np.zeros(len(x), bool)
    cut[1:-1] = (label[1:-1] > label[:-2]) & (label[1:-1] > label[2:])
    if len(x) > 1:
        cut[-1] = label[-1] > label[-2]
    last = first[1:] - 1  # a text's last symbol has no right neighbour
    cut[last] = label[last] > label[np.maximum(last - 1, 0)]
    cut[first] = True
    begin = np.flatnonzero(cut)
    size = np.diff(np.append(begin, len(x)))
    place = np.arange(len(x)) - np.repeat(begin, size)
    weights = _seeds(int(size.max()), 77)
    total = np.add.reduceat(mix(x.astype(np.uint64) + np.uint64(level)) * weights[place], begin)
    return mix(total + size.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(level)), np.searchsorted(begin, bounds)


def fingerprints_of(codes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One row of ``SLOTS`` 16-bit values for each text of code points (u32); zeros for an empty one."""
    n = len(bounds) - 1
    out = np.full((n, SLOTS), np.uint64(0xFFFFFFFFFFFFFFFF))
    names, at = codes, bounds
    for level in range(1, max(LEVELS) + 1):
        names, at = parse_level(names, at, level)
        full = np.flatnonzero(np.diff(at) > 0)
        if level in LEVELS and len(full):
            for k, seed in enumerate(_seeds(SLOTS, 5)):
                out[full, k] = np.minimum(out[full, k], np.minimum.reduceat(names * seed, at[full]))
    out[np.diff(bounds) == 0] = 0
    return (out & np.uint64(0xFFFF)).astype(np.uint16)


def _codes(text: list[str]) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer("".join(text).encode("utf-32-le", "surrogatepass"), np.uint32)
    return data, np.concatenate([[0], np.cumsum(np.fromiter(map(len, text), np.int64, len(text)))])


def likeness(a: np.ndarray, b: np.ndarray, empty_a: np.ndarray, empty_b: np.ndarray) -> np.ndarray:
    return np.where(empty_a | empty_b, (empty_a & empty_b).astype(float), (a == b).mean(axis=1))


def with_next(docs: DataFrame) -> DataFrame:
    """Rows dealt to ranges of descending doc_id, sorted, each range ending with the next one's first row."""
    key = F.struct(F.col("doc_id").isNull().cast("int").alias("n"), F.coalesce(F.bitwise_not("doc_id"), F.lit(0)).alias("r"), "tie")
    rows = texts(docs, F.xxhash64("text").alias("tie")).withColumn("key", key)
    n = 2 * partitions(docs.sparkSession)
    firsts = rows.select("key").repartitionByRange(n, "key").groupBy(F.spark_partition_id()).agg(F.min("key").alias("key")).select("key.*")
    bounds = sorted(map(tuple, firsts.collect()))  # one row for each range
    if not bounds:
        return rows.select(F.lit(0).alias("range"), F.lit(0).alias("extra"), "key", "doc_id", "raw")
    keys = F.array(*[F.struct(F.lit(a).alias("n"), F.lit(b).cast("long").alias("r"), F.lit(c).cast("long").alias("tie")) for a, b, c in bounds])
    at = F.size(F.filter(keys, lambda b: b <= F.col("key"))) - 1
    own = F.struct(F.col("at").alias("range"), F.lit(0).alias("extra"))
    before = F.struct(F.pmod(F.col("at") - 1, F.lit(len(bounds))).alias("range"), F.lit(1).alias("extra"))
    placed = rows.withColumn("at", at).withColumn("to", F.explode(F.when(F.element_at(keys, F.col("at") + 1) == F.col("key"), F.array(own, before)).otherwise(F.array(own))))
    return placed.select("to.range", "to.extra", "key", "doc_id", "raw").repartition("range").sortWithinPartitions("range", "extra", "key")


def phrase_fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every row.

    The edited text has its last half replaced by the first half as long of the next document's.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        strings = ["edited_sha256", "fingerprint", "edited_fingerprint"]
        schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), *[(c, pa.string()) for c in strings], ("near_edited", pa.float64()), ("near_next", pa.float64())])
        held: list[tuple] = []  # the last row, whose next one is still to come
        for batch in slices(batches, "raw", 1 << 20):
            rows = held + [(r, e, d, raw.decode("utf-8", "replace")) for r, e, d, raw in zip(*[batch.column(c).to_pylist() for c in ("range", "extra", "doc_id", "raw")])]
            held = rows[-1:]
            own = [k for k in range(len(rows) - 1) if not rows[k][1] and rows[k][0] == rows[k + 1][0]]
            if not own:
                continue
            text = [r[3] for r in rows]
            edited = []
            for k in own:
                half = len(text[k]) // 2
                edited.append(text[k][: len(text[k]) - half] + text[k + 1][:half])
            prints = fingerprints_of(*_codes(text + edited))
            empty = np.array([not t for t in text + edited])
            mine, nxt, new = np.array(own), np.array(own) + 1, len(text) + np.arange(len(own))
            shown = [p.astype(">u2").tobytes().hex() for p in prints]
            yield batch_of({
                "doc_id": [rows[k][2] for k in own], "n_chars": [len(text[k]) for k in own], "edited_sha256": [hashlib.sha256(e.encode()).hexdigest() for e in edited],
                "fingerprint": [shown[k] for k in own], "edited_fingerprint": shown[len(text) :],
                "near_edited": likeness(prints[mine], prints[new], empty[mine], empty[new]), "near_next": likeness(prints[mine], prints[nxt], empty[mine], empty[nxt]),
            }, schema)

    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return with_next(docs).select("range", "extra", "doc_id", "raw").mapInArrow(tidy(run), schema)
