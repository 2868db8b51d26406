"""Exact substring removal by suffix automata over shards of the repeated parts of the corpus.

A window is ``WINDOW`` consecutive words. A word goes if a window that covers it also starts earlier: in a
text of smaller doc_id, or earlier in the same text.

Only repeated parts can match, so they alone become reference text. Every window has an anchor, the least
of the hashes of its ``GRAM``-word runs; equal windows have equal anchors. Consecutive windows of one
anchor make a stretch of at most WINDOW - GRAM + 1 windows. Stretches whose anchor occurs once are left
out; the others are routed to the shard of their anchor, so that a window meets all its equals in one
shard and no shard sees the rest of the corpus. Equal stretches (anchor and content hash) count once, with
the first place they occur at: all windows of a later copy start earlier there.

Within a shard, the distinct stretches of an anchor are inserted into a suffix automaton in order of their
first place; each state keeps the first end at which it was reached. Streaming a stretch through it gives
the matching statistics; the state of the last ``WINDOW`` words tells where that window first occurred, and
the windows that occurred before are removed. The union of these windows are the maximal spans. An anchor
with more than ``SHARD`` distinct stretches is split further by its windows themselves, each of which then
needs no more than the minimum of its places.

Word and content hashes are 64 bits; texts that an automaton compares are compared as words.

Defined cases: null texts have no words; texts shorter than a window are left whole; a null doc_id is
smaller than all others; rows of equal doc_id are ordered by the hash of their text, and equal rows are one
text whose result each of them gets; other columns are ignored; an empty table gives no rows. A text is held in one
task, with some 60 bytes a byte where its words are hashed.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from kymora.llm.common import batch_of, pick, place_of, plain, slices, stage, texts, tidy, with_text
from kymora.llm.phrases import _seeds, mix
from kymora.llm.words import IS_SPACE, raw_bytes

WINDOW, GRAM, SHARD = 20, 8, 4096
LEAST_ID = -(1 << 63)
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def word_hashes(raw: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word, and where each text's words begin."""
    data, bounds = raw_bytes(raw)
    space = IS_SPACE[data]
    begins = ~space
    begins[1:] &= space[:-1]
    inside = bounds[:-1][np.diff(bounds) > 0]
    begins[inside] = ~space[inside]
    at = np.flatnonzero(begins)
    if not len(at):
        return np.zeros(0, np.uint64), np.zeros(len(bounds), np.int64)
    kept = np.flatnonzero(~space)
    word = np.cumsum(begins)[kept] - 1
    place = kept - at[word]
    stops = np.append(np.flatnonzero(np.diff(word)) + 1, len(kept))
    size = np.diff(np.append(0, stops))
    total = np.add.reduceat((data[kept].astype(np.uint64) + np.uint64(1)) * _seeds(int(size.max()), 11)[place], np.append(0, stops[:-1]))
    return mix(total + size.astype(np.uint64)), np.searchsorted(at, bounds)


def _grams(words: np.ndarray, k: int) -> np.ndarray:
    """A hash of every run of k words."""
    seeds = _seeds(k, 23)
    out = np.zeros(len(words) - k + 1, np.uint64)
    for j in range(k):
        out += words[j : len(words) - k + 1 + j] * seeds[j]
    return mix(out)


def stretches(words: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, windows, anchor, whether the anchor stands in it twice) of every stretch."""
    none = np.zeros(0, np.int64)
    if len(words) < WINDOW:
        return none, none, none, none.astype(np.uint64), none.astype(bool)
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    gram, most = _grams(words, GRAM), WINDOW - GRAM + 1
    n = len(words) - WINDOW + 1
    low = gram[:n].copy()
    for j in range(1, most):
        np.minimum(low, gram[j : n + j], out=low)
    at = np.flatnonzero(text[:n] == text[WINDOW - 1 :])
    if not len(at):
        return none, none, none, none.astype(np.uint64), none.astype(bool)
    low = low[at]
    new = np.ones(len(at), bool)
    new[1:] = (low[1:] != low[:-1]) | (at[1:] != at[:-1] + 1)
    run = np.flatnonzero(new)
    new |= (np.arange(len(at)) - run[np.cumsum(new) - 1]) % most == 0
    first = np.flatnonzero(new)
    windows = np.diff(np.append(first, len(at)))
    start, anchor = at[first], low[first]
    each = windows + most - 1
    which = np.repeat(np.arange(len(first)), each)
    spot = start[which] + np.arange(len(which)) - (np.cumsum(each) - each)[which]
    twice = np.bincount(which[gram[spot] == anchor[which]], minlength=len(first)) > 1
    return text[start], start - bounds[text[start]], windows, anchor, twice


class Automaton:
    """Suffix automaton of several sequences; ``first`` is the earliest (sequence, end) of each state."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link, self.length, self.first = [-1], [0], [(-1, -1)]

    def _new(self, moves: dict, link: int, length: int, first: tuple[int, int]) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.length.append(length)
        self.first.append(first)
        return len(self.next) - 1

    def _clone(self, p: int, q: int, symbol) -> int:
        made = self._new(dict(self.next[q]), self.link[q], self.length[p] + 1, self.first[q])
        while p >= 0 and self.next[p].get(symbol) == q:
            self.next[p][symbol] = made
            p = self.link[p]
        self.link[q] = made
        return made

    def insert(self, sequence: list, name: int) -> None:
        """Sequences come in order of their place, so a state's first end never changes."""
        last = 0
        for end, symbol in enumerate(sequence):
            q = self.next[last].get(symbol)
            if q is not None:
                last = q if self.length[q] == self.length[last] + 1 else self._clone(last, q, symbol)
                continue
            made = self._new({}, 0, self.length[last] + 1, (name, end))
            p = last
            while p >= 0 and symbol not in self.next[p]:
                self.next[p][symbol] = made
                p = self.link[p]
            if p >= 0:
                q = self.next[p][symbol]
                self.link[made] = q if self.length[q] == self.length[p] + 1 else self._clone(p, q, symbol)
            last = made

    def firsts(self, sequence: list, width: int) -> list[tuple[int, int]]:
        """Where each run of ``width`` symbols first ended; (-1, -1) where it does not occur."""
        state, size, out = 0, 0, []
        for end, symbol in enumerate(sequence):
            while state and symbol not in self.next[state]:
                state = self.link[state]
                size = self.length[state]
            if symbol in self.next[state]:
                state, size = self.next[state][symbol], size + 1
            while state and self.length[self.link[state]] >= width:
                state = self.link[state]
                size = self.length[state]
            if end >= width - 1:
                out.append(self.first[state] if size >= width else (-1, -1))
        return out


def _anchors(docs: DataFrame) -> DataFrame:
    """(anchor, ord, tie, pack) of every stretch; pack: start, windows and whether the anchor stands twice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("anchor", pa.int64()), ("ord", pa.int64()), ("tie", pa.int64()), ("pack", pa.int64())])
        for batch in slices(batches, "raw", 1 << 20):
            text, start, windows, anchor, twice = stretches(*word_hashes(batch.column("raw")))
            of = pa.array(text)
            yield batch_of({"anchor": anchor.view(np.int64), "ord": batch.column("ord").take(of), "tie": batch.column("tie").take(of), "pack": start << 5 | windows << 1 | twice}, schema)

    return docs.select("ord", "tie", "raw").mapInArrow(tidy(run), "anchor long, ord long, tie long, pack long")


def _marked(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Every document once more: finished where nothing in it is repeated, else with text and stretches."""

    def squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("ord", pa.int64()), ("tie", pa.int64()), ("z", pa.binary())])
        press = zstandard.ZstdCompressor(level=1)
        for batch in slices(batches, "raw", 2 << 20):
            yield batch_of({"doc_id": batch.column("doc_id"), "ord": batch.column("ord"), "tie": batch.column("tie"), "z": [press.compress(x) for x in batch.column("raw").to_pylist()]}, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = pa.list_(pa.struct([("anchor", pa.int64()), ("content", pa.int64()), ("start", pa.int64()), ("windows", pa.int64()), ("twice", pa.bool_())]))
        schema = pa.schema([("doc_id", pa.int64()), ("ord", pa.int64()), ("tie", pa.int64()), ("n_words", pa.int64()), ("sha", pa.string()), ("z", pa.binary()), ("parts", part)])
        for batch in slices(batches, "z", 1 << 19):
            out: dict[str, list] = {n: [] for n in schema.names}
            for doc_id, ord_, tie, z, found in zip(*[batch.column(c).to_pylist() for c in ("doc_id", "ord", "tie", "z", "found")]):
                raw = zstandard.decompress(z)
                words = raw.split()
                parts, sha = None, None
                if found:
                    hashes, _ = word_hashes(pa.array([raw], pa.binary()))
                    anchor = np.array([f["anchor"] for f in found], np.int64)
                    pack = np.array([f["pack"] for f in found], np.int64)
                    start, windows = pack >> 5, pack >> 1 & 15
                    size = windows + WINDOW - 1
                    begin = np.cumsum(size) - size
                    place = np.arange(size.sum()) - np.repeat(begin, size)
                    content = mix(np.add.reduceat(hashes[np.repeat(start, size) + place] * _seeds(int(size.max()), 31)[place], begin) + size.astype(np.uint64))
                    parts = [dict(zip(("anchor", "content", "start", "windows", "twice"), x)) for x in zip(anchor.tolist(), content.view(np.int64).tolist(), start.tolist(), windows.tolist(), (pack & 1 > 0).tolist())]
                else:
                    sha, z = hashlib.sha256(b" ".join(words)).hexdigest(), None
                for name, x in zip(schema.names, (doc_id, ord_, tie, len(words), sha, z, parts)):
                    out[name].append(x)
            yield batch_of(out, schema)

    squeezed = docs.select("doc_id", "ord", "tie", "raw").mapInArrow(tidy(squeeze), "doc_id long, ord long, tie long, z binary")
    return squeezed.join(found, ["ord", "tie"], "left").select("doc_id", "ord", "tie", "z", "found").mapInArrow(
        tidy(run), "doc_id long, ord long, tie long, n_words long, sha string, z binary, parts array<struct<anchor:long,content:long,start:long,windows:long,twice:boolean>>"
    )


def _contents(held: DataFrame, wanted: DataFrame) -> DataFrame:
    """(anchor, content, ord, tie, start, words): the words of the first place of the wanted stretches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        longs = ["anchor", "content", "ord", "tie", "start"]
        schema = pa.schema([*[(c, pa.int64()) for c in longs], ("hot", pa.bool_()), ("words", pa.binary())])
        for batch in slices(batches, "z", 1 << 19):
            out: dict[str, list] = {n: [] for n in schema.names}
            for ord_, tie, z, wants in zip(*[batch.column(c).to_pylist() for c in ("ord", "tie", "z", "wants")]):
                words = zstandard.decompress(z).split()
                for w in wants:
                    row = (w["anchor"], w["content"], ord_, tie, w["start"], w["hot"], b" ".join(words[w["start"] : w["start"] + w["windows"] + WINDOW - 1]))
                    for name, x in zip(schema.names, row):
                        out[name].append(x)
            yield batch_of(out, schema)

    by_text = wanted.groupBy("ord", "tie").agg(F.collect_list(F.struct("anchor", "content", "start", "windows", "hot")).alias("wants"))
    return held.select("ord", "tie", "z").dropDuplicates(["ord", "tie"]).join(by_text, ["ord", "tie"]).mapInArrow(
        tidy(run), "anchor long, content long, ord long, tie long, start long, hot boolean, words binary"
    )


def _verdicts(contents: DataFrame) -> DataFrame:
    """(anchor, content, bits): which windows of each stretch's first place occurred before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("anchor", pa.int64()), ("content", pa.int64()), ("bits", pa.int64())])
        held: list[tuple] = []

        def judge() -> pa.RecordBatch:
            tree = Automaton()
            sequences = [words.split(b" ") for _, _, words in held]
            for k, s in enumerate(sequences):
                tree.insert(s, k)
            bits = [sum(1 << j for j, first in enumerate(tree.firsts(s, WINDOW)) if first < (k, j + WINDOW - 1)) for k, s in enumerate(sequences)]
            return batch_of({"anchor": [h[0] for h in held], "content": [h[1] for h in held], "bits": bits}, schema)

        for batch in batches:
            for row in zip(*[batch.column(c).to_pylist() for c in ("anchor", "content", "words")]):
                if held and held[0][0] != row[0]:
                    yield judge()
                    held = []
                held.append(row)
        if held:
            yield judge()

    dealt = contents.filter(~F.col("hot")).repartition("anchor").sortWithinPartitions("anchor", "ord", "tie", "start")
    return dealt.select("anchor", "content", "words").mapInArrow(tidy(run), "anchor long, content long, bits long")


def _hot_verdicts(contents: DataFrame) -> DataFrame:
    """The same for anchors with very many stretches, by the windows themselves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("anchor", pa.int64()), ("content", pa.int64()), ("ord", pa.int64()), ("tie", pa.int64()), ("pos", pa.int64()), ("nth", pa.int64()), ("window", pa.binary())])
        for batch in slices(batches, "words", 1 << 20):
            out: dict[str, list] = {n: [] for n in schema.names}
            for anchor, content, ord_, tie, start, joined in zip(*[batch.column(c).to_pylist() for c in ("anchor", "content", "ord", "tie", "start", "words")]):
                words = joined.split(b" ")
                for j in range(len(words) - WINDOW + 1):
                    for name, x in zip(schema.names, (anchor, content, ord_, tie, start + j, j, hashlib.blake2b(b" ".join(words[j : j + WINDOW]), digest_size=16).digest())):
                        out[name].append(x)
            yield batch_of(out, schema)

    each = contents.filter("hot").select("anchor", "content", "ord", "tie", "start", "words").mapInArrow(tidy(run), "anchor long, content long, ord long, tie long, pos long, nth long, window binary")
    each = stage(each)
    place = F.struct("ord", "tie", "pos")
    first = each.groupBy("window").agg(F.min(place).alias("first"))
    before = each.join(first, "window").filter(F.col("first") < place)
    return before.groupBy("anchor", "content").agg(F.bit_or(F.expr("shiftleft(1L, int(nth))")).alias("bits"))


def removed_spans(docs: DataFrame, shard: int = SHARD) -> tuple[DataFrame, DataFrame]:
    """All documents as ``_marked`` gives them, and (ord, tie, spans) with spans (start, windows, bits) of removed windows."""
    spark = docs.sparkSession
    marked = stage(_marked(docs, _candidates(docs)))
    held = marked.filter(F.col("z").isNotNull())
    places = stage(held.select("ord", "tie", F.explode("parts").alias("p")).select("ord", "tie", "p.*"))
    place = F.struct("ord", "tie", "start")
    # copies of a stretch count once, with their first place
    distinct = stage(places.groupBy("anchor", "content").agg(F.min(place).alias("first"), F.max("windows").alias("windows"), F.max("twice").alias("twice")))
    groups = distinct.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.max("twice").alias("any_twice")).filter("n > 1 or any_twice")
    wanted = distinct.join(groups, "anchor").select("anchor", "content", "first.*", "windows", (F.col("n") > shard).alias("hot"))
    contents = stage(_contents(held, wanted))
    verdicts = _verdicts(contents)
    if not contents.filter("hot").isEmpty():
        verdicts = verdicts.union(_hot_verdicts(contents))
    told = distinct.join(verdicts, ["anchor", "content"], "left").select("anchor", "content", "first", F.coalesce("bits", F.lit(0)).alias("bits"))
    bits = F.when(place == F.col("first"), F.col("bits")).otherwise(F.expr("shiftleft(1L, int(windows)) - 1"))
    spans = (
        places.join(told, ["anchor", "content"]).withColumn("bits", bits).filter("bits <> 0")
        .groupBy("ord", "tie").agg(F.collect_set(F.struct("start", "bits")).alias("spans"))
    )
    return marked, spans


def _candidates(docs: DataFrame) -> DataFrame:
    """(ord, tie, found): the stretches of each text whose anchor occurs elsewhere, or in them twice."""
    anchors = _anchors(docs)
    twice = F.col("pack").bitwiseAND(F.lit(1))
    shared = anchors.groupBy("anchor").agg(F.sum(1 + twice).alias("n")).filter("n > 1").select("anchor")
    # the side of distinct keys is hashed, which spares sorting all stretches
    kept = anchors.join(shared.hint("shuffle_hash"), "anchor", "left_semi")
    return kept.groupBy("ord", "tie").agg(F.collect_set(F.struct("anchor", "pack")).alias("found"))


def has_ties(docs: DataFrame) -> bool:
    """Whether rows share a doc_id; where none do, hashes of texts need not travel with the rows."""
    return not pick(docs, "doc_id").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty()


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, raw, ord, tie): ord orders the rows, tie tells rows of equal doc_id apart."""
    tie = F.xxhash64(F.coalesce("text", F.lit(""))) if has_ties(docs) else F.lit(0).cast("long")
    return texts(docs, tie.alias("tie")).withColumn("ord", F.coalesce("doc_id", F.lit(LEAST_ID)))


def cut_out(docs: DataFrame, shard: int = SHARD) -> DataFrame:
    """All rows and columns of ``docs``, without the removed words and the white space after them."""
    runs = remove_repeats(docs, shard, with_spans=True).filter("n_removed > 0").select("ord", "tie", "removed").dropDuplicates(["ord", "tie"])
    named, names = plain(docs)
    t = place_of(names, "text")
    text = F.coalesce(F.col(f"c{t}"), F.lit(""))
    ord_ = F.coalesce(F.col(f"c{place_of(names, 'doc_id')}").cast("long"), F.lit(LEAST_ID))
    tie = F.xxhash64(text) if has_ties(docs) else F.lit(0).cast("long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2 << 20):
            out = []
            for raw, removed in zip(batch.column("text").to_pylist(), batch.column("removed").to_pylist()):
                if removed:
                    at = [m.start() for m in WORD.finditer(raw)] + [len(raw)]
                    bounds = [0, *[x for r in removed for x in (at[r["start"]], at[r["stop"]])], len(raw)]
                    raw = b"".join(raw[a:b] for a, b in zip(bounds[::2], bounds[1::2]))
                out.append(raw)
            kept = [batch.column(f"c{i}") for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([*kept, pa.array([x.decode("utf-8", "replace") for x in out], pa.string()), pa.array([bool(x) for x in batch.column("removed").to_pylist()])], [*[f"c{i}" for i in range(len(names))], "text", "changed"])

    joined = named.withColumn("ord", ord_).withColumn("tie", tie).join(runs, ["ord", "tie"], "left")
    cols = [F.col(f"c{i}") for i in range(len(names))]
    schema = StructType([*named.schema.fields, StructField("text", StringType()), StructField("changed", BooleanType())])
    edited = joined.select(*cols, F.encode(text, "UTF-8").alias("text"), "removed").mapInArrow(tidy(run), schema)
    return with_text(edited, names, F.col("text"), F.col("changed"))


def _mask(n: int, spans) -> np.ndarray:
    edge = np.zeros(n + 1, np.int64)
    for s in spans or ():
        j, bits = s["start"], s["bits"]
        while bits:
            if bits & 1:
                edge[j] += 1
                edge[min(j + WINDOW, n)] -= 1
            bits >>= 1
            j += 1
    return np.cumsum(edge[:-1]) > 0


def remove_repeats(docs: DataFrame, shard: int = SHARD, with_spans: bool = False) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256), and with ``with_spans`` (ord, tie, removed): runs of removed words."""
    marked, spans = removed_spans(keyed(docs), shard)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = [("doc_id", pa.int64()), ("ord", pa.int64()), ("tie", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("removed", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))]
        schema = pa.schema(fields)
        for batch in slices(batches, "z", 1 << 19):
            out: dict[str, list] = {n: [] for n in schema.names}
            for doc_id, ord_, tie, z, found in zip(*[batch.column(c).to_pylist() for c in ("doc_id", "ord", "tie", "z", "spans")]):
                words = zstandard.decompress(z).split()
                gone = _mask(len(words), found)
                kept = hashlib.sha256(b" ".join([w for w, g in zip(words, gone.tolist()) if not g])).hexdigest()
                step = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
                runs = [{"start": a, "stop": b} for a, b in step.reshape(-1, 2).tolist()]
                for name, x in zip(schema.names, (doc_id, ord_, tie, len(words), int(gone.sum()), kept, runs)):
                    out[name].append(x)
            yield batch_of(out, schema)

    shape = "doc_id long, ord long, tie long, n_words long, n_removed long, kept_sha256 string, removed array<struct<start:long,stop:long>>"
    held = marked.filter(F.col("z").isNotNull()).select("doc_id", "ord", "tie", "z").join(spans, ["ord", "tie"], "left").select("doc_id", "ord", "tie", "z", "spans").mapInArrow(tidy(run), shape)
    done = marked.filter(F.col("z").isNull()).select("doc_id", "ord", "tie", "n_words", F.lit(0).cast("long").alias("n_removed"), F.col("sha").alias("kept_sha256"), F.array().cast("array<struct<start:long,stop:long>>").alias("removed"))
    both = done.union(held)
    return both if with_spans else both.select("doc_id", "n_words", "n_removed", "kept_sha256")
