"""One document of each near-duplicate group, by SimHash links and verified similarity.

Two kinds of links join texts:

* fingerprints of all 3-word shingles within 2 bits of each other (``simhash.links``), and
* a Jaccard similarity of at least 0.8 over 5-word shingles. At that similarity whole-text fingerprints
  differ in some ten bits of 64, more than any pigeonhole can probe. Candidates therefore come from
  ``SAMPLES`` fingerprints, each the SimHash of the ``DRAWN`` shingles that a hash of its own ranks first:
  texts at 0.8 agree in one of them with a chance of 1 - (1 - 0.8**3)**16, above 0.9999.

All texts that share a sample are joined as if every pair of them had been compared, exactly, on whole texts.
First each is compared with the least text of the sample. Where the others are then still in several
components, a task takes them together and compares across components only, which gives a spanning forest of
their links (``partners``). Samples whose texts hold more than ``WEIGHT`` shingles are cut by size, since texts
at 0.8 have sizes within a factor of 1.25, and then into parts of which every two meet in a task.

Texts count once, whatever the number of their copies; a text is known by a 128-bit hash. A pair at 0.8 that shares no sample at all can stay
unlinked unless other texts join it; all links that are made are exact.

Defined cases: null texts count as empty; texts shorter than a shingle are one shingle; the document that
stays is that of least doc_id (null least), then least text hash; of equal rows one stays; all columns are
kept; an empty table gives no rows. A text is held in one task, with some 60 bytes a byte where its words are hashed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kymora.llm.common import batch_of, partitions, place_of, plain, slices, stage, texts, tidy
from kymora.llm.components import components
from kymora.llm.phrases import _seeds, mix
from kymora.llm.simhash import fingerprint, links
from kymora.llm.substrings import LEAST_ID, word_hashes

SAMPLES, DRAWN, WIDTH = 16, 3, 5
WEIGHT = 1 << 18  # shingles that a task compares at once
LED = 64  # texts that are compared with one copy of their leader


def identity(text: Column) -> Column:
    """128 bits that stand for a text; null counts as empty."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def shingle_set(hashes: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """Distinct hashes of the runs of ``width`` words, of all words together if they are fewer."""
    if not len(hashes):
        return np.zeros(0, np.uint64)
    width = min(width, len(hashes))
    total = np.zeros(len(hashes) - width + 1, np.uint64)
    for j, seed in enumerate(_seeds(width, 41)):
        total += hashes[j : len(hashes) - width + 1 + j] * seed
    return np.unique(mix(total + np.uint64(width)))


def sampled(shingles: np.ndarray) -> np.ndarray:
    """SimHash of the shingles that each of ``SAMPLES`` rankings puts first."""
    out = np.zeros(SAMPLES, np.uint64)
    k = min(DRAWN, len(shingles))
    if not k:
        return out
    for i, seed in enumerate(_seeds(SAMPLES, 59)):
        rank = mix(shingles ^ seed)
        first = np.sort(shingles[np.argpartition(rank, k - 1)[:k]])
        bits = np.unpackbits(first.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0)
        out[i] = np.packbits(2 * bits > k, bitorder="little").view("<u8")[0] + np.uint64(i)  # no sample meets another
    return out


def _lower_hashes(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return word_hashes(pa.array([r.lower() for r in raws], pa.binary()))


def sketches(docs: DataFrame) -> DataFrame:
    """(ord, h, fp, size, samples) of every row; h is the hash of its text, size the number of its shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("ord", pa.int64()), ("h", pa.binary()), ("fp", pa.int64()), ("size", pa.int64()), ("samples", pa.list_(pa.int64()))])
        for batch in slices(batches, "raw", 1 << 20):
            raws = batch.column("raw").to_pylist()
            hashes, at = _lower_hashes(raws)
            fps = np.array([fingerprint(r.lower().split(), 3) for r in raws], np.uint64).view(np.int64)
            sets = [shingle_set(hashes[a:b]) for a, b in zip(at[:-1], at[1:])]
            drawn = [sampled(x).view(np.int64).tolist() for x in sets]
            yield batch_of({"ord": batch.column("doc_id").fill_null(LEAST_ID), "h": batch.column("h"), "fp": fps, "size": [len(x) for x in sets], "samples": drawn}, schema)

    hashed = texts(docs, identity(F.col("text")).alias("h"))
    return hashed.mapInArrow(tidy(run), "ord long, h binary, fp long, size long, samples array<long>")


def sharing(nodes: DataFrame) -> DataFrame:
    """(key, h, size, least) of all texts that share a sample with another; least is the least of them."""
    keyed = nodes.select("h", "size", F.explode(F.array_distinct("samples")).alias("key"))
    several = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("h").alias("least")).filter("n > 1").select("key", "least")
    return keyed.join(several, "key")


def candidates(shared: DataFrame) -> DataFrame:
    """(a, b) with a > b: each text with the least of every sample it shares."""
    return shared.filter("h > least").select(F.col("h").alias("a"), F.col("least").alias("b")).distinct()


def squeezed(wanted: DataFrame, docs: DataFrame) -> DataFrame:
    """(h, z): the compressed text of each wanted ``h``."""

    def squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("h", pa.binary()), ("z", pa.binary())])
        press = zstandard.ZstdCompressor(level=1)
        for batch in slices(batches, "raw"):
            yield batch_of({"h": batch.column("h"), "z": [press.compress(x) for x in batch.column("raw").to_pylist()]}, schema)

    hashed = texts(docs, identity(F.col("text")).alias("h")).select("h", "raw").mapInArrow(tidy(squeeze), "h binary, z binary")
    return stage(hashed.join(wanted, "h", "left_semi").dropDuplicates(["h"]))


def alike(x: np.ndarray, y: np.ndarray, least: float) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both >= least * (len(x) + len(y) - both)


def verified(pairs: DataFrame, docs: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) of texts whose similarity is at least ``least``.

    ``b`` leads many pairs: its text comes once for every ``LED`` of them, and then theirs.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])
        now, leader = None, None
        for batch in slices(batches, "z", 1 << 18):
            hashes, at = _lower_hashes([zstandard.decompress(z) for z in batch.column("z").to_pylist()])
            kept: list[tuple] = []
            for k, (b, salt, a) in enumerate(zip(*[batch.column(c).to_pylist() for c in ("b", "salt", "a")])):
                mine = shingle_set(hashes[at[k] : at[k + 1]])
                if a is None:
                    now, leader = (b, salt), mine
                elif now == (b, salt) and alike(leader, mine, least):
                    kept.append((a, b))
            yield batch_of({"a": [k[0] for k in kept], "b": [k[1] for k in kept]}, schema)

    wanted = pairs.select(F.explode(F.array("a", "b")).alias("h")).distinct()
    held = squeezed(wanted, docs)
    parts = pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / LED).cast("long").alias("parts"))
    dealt = stage(pairs.join(parts, "b").select("a", "b", F.pmod(F.xxhash64("a"), F.col("parts")).alias("salt")))
    led = dealt.join(held.withColumnsRenamed({"h": "a"}), "a").select("b", "salt", "a", "z")
    leaders = dealt.select("b", "salt").distinct().join(held.withColumnsRenamed({"h": "b"}), "b").select("b", "salt", F.lit(None).cast("binary").alias("a"), "z")
    # nulls come first, so a leader stands before the texts that it leads
    return led.union(leaders).repartition("b", "salt").sortWithinPartitions("b", "salt", F.asc_nulls_first("a")).mapInArrow(tidy(run), "a binary, b binary")


def forest(sets: list[np.ndarray], roots: list[int], least: float) -> list[tuple[int, int]]:
    """Links that join whatever is joined by pairs of at least ``least``; texts of one root are joined already."""
    size = np.array([len(x) for x in sets], np.int64)
    _, ids = np.unique(np.concatenate(sets), return_inverse=True)
    at = np.append(0, np.cumsum(size))
    of = np.unique(np.array(roots), return_inverse=True)[1]
    marked = np.zeros(len(ids) + 1, bool)
    left, out = np.arange(len(sets)), []
    while len(left):
        front = left[of[left] == of[left[0]]].tolist()
        left = left[of[left] != of[left[0]]]
        held = None
        while front and len(left):
            if held is None:
                held = np.concatenate([ids[at[k] : at[k + 1]] for k in left])
                ends = np.append(0, np.cumsum(size[left]))
            x = front.pop()
            mine = ids[at[x] : at[x + 1]]
            marked[mine] = True
            met = np.append(0, np.cumsum(marked[held]))
            marked[mine] = False
            both = met[ends[1:]] - met[ends[:-1]]
            near = left[both >= least * (size[x] + size[left] - both)]
            if len(near):
                _, first = np.unique(of[near], return_index=True)
                out += [(x, k) for k in near[first].tolist()]
                joined = np.isin(of[left], of[near])
                front += left[joined].tolist()
                left, held = left[~joined], None
    return out


def partners(shared: DataFrame, groups: DataFrame, docs: DataFrame, least: float, weight: int = WEIGHT) -> DataFrame | None:
    """(a, b) links that are missing in ``groups`` among the texts of each sample, None if none can be.

    The least text of a sample has been compared with all others and is left out.
    """
    roots = groups.withColumnRenamed("node", "h")
    rest = shared.filter("h > least").select("key", "h", "size").join(roots, "h", "left").withColumn("root", F.coalesce("root", "h"))
    counts = [F.min("root").alias("lo"), F.max("root").alias("hi"), F.sum("size").alias("held")]
    members = [F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("h")).alias("x"), F.bit_xor(F.xxhash64("h", F.lit(1))).alias("y")]
    several = rest.groupBy("key").agg(*counts, *members).filter("lo < hi")
    once = several.groupBy("n", "x", "y", "held").agg(F.min("key").alias("key")).select("key", "held")  # samples of the same texts
    band = F.floor(F.log(F.greatest("size", F.lit(1))) / F.log(F.lit(1.01 / least))).cast("int")
    bands = F.when(F.col("held") > weight, F.array(band, band + 1)).otherwise(F.array(F.lit(-1)))
    sized = stage(rest.join(once, "key").select("key", "h", "size", "root", F.explode(bands).alias("band")))
    open_ = sized.groupBy("key", "band").agg(*counts).filter("lo < hi").select("key", "band", "held", F.ceil(F.col("held") / weight).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("key", "h"), F.col("parts")).cast("int")
    cut = sized.join(open_.drop("held"), ["key", "band"]).withColumn("part", part).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    cut = cut.filter("parts = 1 or part <> other").select("key", "band", F.least("part", "other").alias("p"), F.greatest("part", "other").alias("q"), "h", "root")
    cut = stage(cut)
    work = open_.agg(F.sum(F.col("held") * F.col("parts"))).first()[0]
    if work is None:
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])
        now, members = None, []

        def joined() -> pa.RecordBatch:
            found = forest([m[2] for m in members], [m[1] for m in members], least) if members else []
            return batch_of({"a": [members[i][0] for i, _ in found], "b": [members[j][0] for _, j in found]}, schema)

        for batch in slices(batches, "z", 1 << 18):
            for *group, h, root, z in zip(*[batch.column(c).to_pylist() for c in ("key", "band", "p", "q", "h", "root", "z")]):
                if group != now:
                    yield joined()
                    now, members = group, []
                members.append((h, root, shingle_set(_lower_hashes([zstandard.decompress(z)])[0])))
        yield joined()

    by = ["key", "band", "p", "q"]
    full = cut.join(squeezed(cut.select("h").distinct(), docs), "h")
    # as many tasks as there is work, which is the shingles held times the parts they meet, and not the bytes
    return full.repartition(max(partitions(docs.sparkSession), int(work // weight)), *by).sortWithinPartitions(*by).mapInArrow(tidy(run), "a binary, b binary")


def keep_one(docs: DataFrame, tau: int = 2, least: float = 0.8, weight: int = WEIGHT) -> DataFrame:
    """One row of ``docs`` of each group of near-duplicates, with all its columns."""
    nodes = stage(sketches(docs).groupBy("h").agg(F.min("ord").alias("ord"), F.first("fp").alias("fp"), F.first("size").alias("size"), F.first("samples").alias("samples")))
    prints = nodes.groupBy("fp").agg(F.min("h").alias("least"))
    same = nodes.join(prints, "fp").select(F.col("h").alias("a"), F.col("least").alias("b"))
    close = links(prints.select("fp"), tau)
    of = lambda c, to: prints.select(F.col("fp").alias(c), F.col("least").alias(to))
    bits = close.join(of("a", "x"), "a").join(of("b", "y"), "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
    shared = stage(sharing(nodes))
    near = verified(stage(candidates(shared)), docs, least)
    groups = components(same.union(bits).union(near))
    more = partners(shared, groups, docs, least, weight)
    if more is not None:
        groups = components(groups.select(F.col("node").alias("a"), F.col("root").alias("b")).union(more))
    named = nodes.select("h", "ord").join(groups.withColumnRenamed("node", "h"), "h", "left").withColumn("root", F.coalesce("root", "h"))
    first = named.groupBy("root").agg(F.min(F.struct("ord", "h")).alias("k")).select("k.*")
    renamed, names = plain(docs)
    text = F.coalesce(F.col(f"c{place_of(names, 'text')}"), F.lit(""))
    ord_ = F.coalesce(F.col(f"c{place_of(names, 'doc_id')}").cast("long"), F.lit(LEAST_ID))
    kept = renamed.withColumn("h", identity(text)).withColumn("ord", ord_).join(first, ["ord", "h"], "left_semi")
    return kept.dropDuplicates(["ord", "h"]).drop("ord", "h").toDF(*names)
