"""Brown class-based bigram model: exchange clustering, class transitions, word emissions.

Training reads every text whose crc32(doc_id as text) mod 7 is not 2. Words and neighbouring words are
counted over all of them, with partial counts inside each task. Every word of the training texts is clustered;
words that they don't have form one class of their own, the end of a text another. (Who gives ``clustered``
clusters no more than so many of the ``held`` words, and those that occur ``min_count`` times or more; all others are
then in the class of unknown words.) The words that tasks know are dealt to ``classes`` by frequency, all others by
their hash, and then exchanged: in each round every word of one half moves to the class that raises the likelihood
of the class bigrams most, given the classes of its neighbours. The best assignment seen is kept.
A round is two jobs over one row a word and neighbour (``exchange``).

    log10 P(text) = sum of log10 P(class | class before) + log10 P(word | class)

Transitions are smoothed by ``ALPHA``; emissions are relative counts, with one added in the class of unknown (and
rare) words, where an unknown word takes the place of one more word.

Size: the ``held`` most frequent words with their counts are given to every task (bounded, about 4 MB); they are those
whose class a task looks up, no bound on what is clustered. Counts and classes of all other words stay in a table that
the remaining words, and neighbours of which neither is held, are joined to. A text is held in one task,
with some 100 bytes a word; its words are split two megabytes of text at a time.

Defined cases: null texts count as empty and have an end token alone; a null doc_id counts as empty text in
the crc32; repeated rows count and score each; other columns are ignored; an empty table gives no rows; with
no training text every word is unknown.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kymora.llm import exchange
from kymora.llm.common import batch_of, slices, stage, texts, tidy
from kymora.llm.exchange import LOOSE, hashed, likelihood  # noqa: F401
from kymora.llm.words import Words, raw_bytes, split_words

ALPHA = 0.1
MIN_COUNT = 1024  # where only some are clustered, a held word that occurs so often is


def is_held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 7 == 2


@dataclass
class Lexicon:
    """The most frequent words: their counts, and their numbers (by falling count)."""

    words: bytes
    ends: np.ndarray
    counts: np.ndarray
    clustered: int
    above: float  # words that are not held occur less often
    whole: bool = False  # words that are not held are clustered too
    name: str = field(default_factory=lambda: uuid.uuid4().hex)

    def numbers(self) -> dict[bytes, int]:
        if self.name not in _LEXICONS:
            _LEXICONS.clear()
            begin = np.append(0, self.ends[:-1]).tolist()
            _LEXICONS[self.name] = {self.words[a:b]: i for i, (a, b) in enumerate(zip(begin, self.ends.tolist()))}
        return _LEXICONS[self.name]

    def find(self, distinct: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The number of each word, -1 where it is not held, and the number that it has then."""
        number, loose = np.full(len(distinct), -1), hashed(distinct)
        if not len(self.ends) or not len(loose):
            return number, loose
        if _HASHES.get("name") != self.name:
            held = hashed(pa.Array.from_buffers(pa.large_binary(), len(self.ends), [None, pa.py_buffer(np.append(0, self.ends).astype(np.int64)), pa.py_buffer(self.words)]))
            order = np.argsort(held)
            _HASHES.update(name=self.name, order=order, hashes=held[order], twice=bool((np.diff(held[order]) == 0).any()))
        if _HASHES["twice"]:  # two held words of one hash
            known = self.numbers()
            return np.array([known.get(w, -1) for w in distinct.to_pylist()], np.int64), loose
        at = np.minimum(np.searchsorted(_HASHES["hashes"], loose), len(self.ends) - 1)
        at, hit = _HASHES["order"][at], _HASHES["hashes"][at] == loose
        # of those the bytes must agree
        data, bounds = raw_bytes(distinct)
        size, begin = np.diff(bounds), np.append(0, self.ends[:-1])
        hit &= (self.ends - begin)[at] == size
        some = np.flatnonzero(hit)
        if len(some):
            n = size[some]
            first = np.cumsum(n) - n
            inside = np.arange(n.sum()) - np.repeat(first, n)
            agree = data[np.repeat(bounds[:-1][some], n) + inside] == np.frombuffer(self.words, np.uint8)[np.repeat(begin[at[some]], n) + inside]
            some = some[np.logical_and.reduceat(agree, first)]
            number[some] = at[some]
        return number, loose


_LEXICONS: dict[str, dict[bytes, int]] = {}  # one entry, of the worker's own process
_HASHES: dict = {}  # of one lexicon, in the worker's own process


def count_words(docs: DataFrame) -> DataFrame:
    """(word, n) over all texts of (doc_id, raw)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("word", pa.binary()), ("n", pa.int64())])
        for batch in slices(batches, "raw", 2 << 20):
            words = split_words(batch.column("raw"), lower=True)
            if len(words.distinct):
                yield batch_of({"word": words.distinct.cast(pa.binary()), "n": np.bincount(words.index, minlength=len(words.distinct))}, schema)

    return docs.select("raw").mapInArrow(tidy(run), "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def make_lexicon(counts: DataFrame, held: int, clustered: int | None = None, min_count: int = MIN_COUNT) -> Lexicon:
    """The ``held`` most frequent words; of equally frequent ones those of the least hash. ``clustered`` None: all words are clustered."""
    step = F.floor(F.log2("n") * 16).cast("int")
    sizes = counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n")).collect()  # about a thousand rows at most
    total, least, part = 0, None, 0.0
    for r in sorted(sizes, key=lambda r: -r["step"]):
        room = held - total
        least, part = r["step"], min(1.0, (room + 6 * math.sqrt(room) + 20) / r["n"])  # hashes fall unevenly
        total += r["n"]
        if total >= held:
            break
    if least is None:
        return Lexicon(b"", np.zeros(0, np.int64), np.zeros(0, np.int64), 0, 0.0, clustered is None)
    # of the last step a share that is a little too large; what is too much is left out below
    marked = counts.select("word", "n", step.alias("step"), F.pmod(F.xxhash64("word"), F.lit(1 << 30)).alias("mark"))
    share = int(part * (1 << 30)) + 1
    rows = marked.filter((F.col("step") > least) | (F.col("step") == least) & (F.col("mark") < share)).collect()  # ``held`` and a few
    rows.sort(key=lambda r: (-r["step"], r["mark"], bytes(r["word"])))
    rows = sorted(rows[:held], key=lambda r: (-r["n"], bytes(r["word"])))
    words, n = [bytes(r["word"]) for r in rows], np.array([r["n"] for r in rows], np.int64)
    some = len(words) if clustered is None else max(min(clustered, len(words)), int((n >= min_count).sum()) if clustered else 0)
    return Lexicon(b"".join(words), np.cumsum([len(w) for w in words], dtype=np.int64), n, some, 2.0 ** ((least + 1) / 16), clustered is None)


def _numbers(lexicon: Lexicon, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Of each distinct word: where it is held (or -1), and its number (rare: ``clustered``)."""
    found, loose = lexicon.find(words.distinct)
    rare = lexicon.clustered
    return found, np.where(found < 0, loose, found) if lexicon.whole else np.where((found < 0) | (found >= rare), rare, found)


def neighbours(docs: DataFrame, lexicon: Lexicon, shares: dict[int, int], buckets: int) -> DataFrame:
    """Who stands beside whom in all texts, by bucket; an end also stands before a text."""

    def symbols(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for batch in slices(batches, "raw", 2 << 20):
            words = split_words(batch.column("raw"), lower=True)
            yield np.append(_numbers(lexicon, words)[1], lexicon.clustered + 1), np.insert(words.index, words.bounds[1:], len(words.distinct))

    return exchange.neighbours(docs.select("raw"), symbols, lexicon.clustered + 1, shares, buckets)


def best_class(table: np.ndarray, own: int, left: np.ndarray, right: np.ndarray, itself: float, free: int) -> int:
    """Where among the first ``free`` classes the word does best; left, right: its neighbours by class."""
    return int(exchange.best_classes(table, np.array([own]), left[None].astype(float), right[None].astype(float), np.array([itself]), free)[0])


@dataclass
class Model:
    lexicon: Lexicon
    of: np.ndarray
    transition: np.ndarray
    emission: np.ndarray
    tokens: int
    distinct: int
    ends: int
    rare_tokens: int
    rare_words: int
    own: np.ndarray  # words in each class, as they occur
    loose: DataFrame  # (number, class) of clustered words that are not held


def train(docs: DataFrame, held: int, clustered: int | None, classes: int, rounds: int, min_count: int = MIN_COUNT) -> tuple[Model, DataFrame]:
    """A model of the texts (doc_id, raw), and the counts of all words."""
    counts = stage(count_words(docs))
    ends = docs.count()
    n = counts.agg(F.count(F.lit(1)).alias("words"), F.coalesce(F.sum("n"), F.lit(0)).alias("tokens")).first()
    lexicon = make_lexicon(counts, held, clustered, min_count)
    seen = lexicon.counts[: lexicon.clustered]
    rare_tokens, rare_words = (0, 0) if lexicon.whole else (n["tokens"] - int(seen.sum()), n["words"] - len(seen))
    shares = {i: 1 + int(x) // exchange.SPLIT for i, x in enumerate(seen[seen >= exchange.SPLIT])}  # by falling count
    shares |= {lexicon.clustered + i: 1 + x // exchange.SPLIT for i, x in enumerate((rare_tokens, ends)) if x >= exchange.SPLIT}
    buckets = 1 + (n["tokens"] + ends) // exchange.SHARE
    known = n["words"] if lexicon.whole else lexicon.clustered
    found = exchange.cluster(neighbours(docs, lexicon, shares, buckets), lexicon.clustered, known, classes, rounds, shares, buckets)
    of, table, k = found.of, found.table, len(found.table)
    transition = np.log10((table + ALPHA) / (table.sum(1, keepdims=True) + ALPHA * k))
    own = np.maximum(table.sum(0), 1)
    emission = np.log10(seen / own[of[: len(seen)]])
    return Model(lexicon, of, transition, emission, n["tokens"] + ends, n["words"] + (ends > 0), ends, rare_tokens, rare_words, own, found.loose), counts


def _listed(key: np.ndarray, per_text: int, texts_: int, kind: pa.StructType, columns: Callable[[np.ndarray], list]) -> pa.ListArray:
    """For each text a list of its distinct keys, each once with its number; ``key`` is text * per_text + rest."""
    key, times = np.unique(key, return_counts=True)
    rows = pa.StructArray.from_arrays([*columns(key % per_text), pa.array(times.astype(np.int64))], fields=list(kind))
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(key // per_text, np.arange(texts_ + 1)).astype(np.int32)), rows)


def score(docs: DataFrame, held: int = 1 << 18, clustered: int | None = None, classes: int = 64, rounds: int = 6, min_count: int = MIN_COUNT) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row."""
    rows = texts(docs).withColumn("held_out", is_held_out(F.col("doc_id")))
    model, counts = train(rows.filter(~F.col("held_out")), held, clustered, classes, rounds, min_count)
    whole = float(model.tokens + model.distinct + 1)
    rare_whole = float(model.rare_tokens + model.rare_words + 1)
    lexicon, of, transition, emission, ends_seen, k = model.lexicon, model.of, model.transition, model.emission, model.ends, len(model.transition)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        rest = pa.struct([("word", pa.binary()), ("before", pa.int32()), ("after", pa.int32()), ("n", pa.int64())])
        pair = pa.struct([("word", pa.binary()), ("next", pa.binary()), ("n", pa.int64())])
        schema = pa.schema([("uid", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()), ("rest", pa.list_(rest)), ("pairs", pa.list_(pair))])
        uid = TaskContext.get().partitionId() << 40
        base = np.append(np.log10((lexicon.counts + 1) / whole), 0.0)  # the last place is for words not held
        rare = np.log10((lexicon.counts + 1) / rare_whole)
        emit = np.append(np.concatenate([emission, rare[lexicon.clustered :]]), 0.0)
        step = np.pad(transition, (0, 1))  # nothing yet for steps to and from a class that is not known here, which is -1
        for batch in slices(batches, "raw", 2 << 20):
            words = split_words(batch.column("raw"), lower=True)
            n = len(batch)
            held, number = _numbers(lexicon, words)
            found, far = held[words.index], number >= LOOSE
            cls = np.insert(np.where(far, -1, of[np.where(far, 0, number)])[words.index], words.bounds[1:], k - 1)
            ends = words.bounds[1:] + np.arange(n)
            before = np.append(cls[-1:] * 0 + k - 1, cls[:-1])
            begins = np.append(0, ends[:-1] + 1)
            total = np.add.reduceat(step[before, cls], begins) if n else np.zeros(0)
            base_score = np.full(n, np.log10((ends_seen + 1) / whole))
            known = np.full(n, int(ends_seen > 0))
            full = np.flatnonzero(words.counts)
            if len(full):
                at = words.bounds[:-1][full]
                base_score[full] += np.add.reduceat(base[found], at)
                total[full] += np.add.reduceat(emit[found], at)
                known[full] += np.add.reduceat((found >= 0).astype(np.int64), at)
            # words that are not held, with the classes beside them and their number in each text; and two of them in a row
            loose, text, width, m = found < 0, words.text, max(len(words.distinct), 1), k + 1
            place, names = np.flatnonzero(loose) + text[loose], words.distinct.cast(pa.binary())
            sides = [before[place], cls[place + 1]] if lexicon.whole else [np.full(len(place), -1)] * 2  # there the rare class's steps are taken above
            key = ((text[loose] * width + words.index[loose]) * m + sides[0] + 1) * m + sides[1] + 1
            two = np.flatnonzero(loose[:-1] & loose[1:] & (text[:-1] == text[1:])) if lexicon.whole else np.zeros(0, np.int64)
            yield batch_of({
                "uid": uid + np.arange(n), "doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"), "n_tokens": words.counts + 1, "n_known": known, "base_score": base_score, "score": total,
                "rest": _listed(key, width * m * m, n, rest, lambda x, names=names, m=m: [names.take(pa.array(x // (m * m))), pa.array((x // m % m - 1).astype(np.int32)), pa.array((x % m - 1).astype(np.int32))]),
                "pairs": _listed((text[two] * width + words.index[two]) * width + words.index[two + 1], width * width, n, pair, lambda x, names=names, width=width: [names.take(pa.array(x // width)), names.take(pa.array(x % width))]),
            }, schema)
            uid += n

    scored = stage(rows.select("doc_id", "held_out", "raw").mapInArrow(tidy(run), "uid long, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double, rest array<struct<word:binary,before:int,after:int,n:long>>, pairs array<struct<word:binary,next:binary,n:long>>"))
    others = counts.filter(F.col("n") <= lexicon.above * 1.001)
    others = stage(_with_number(others).join(model.loose, "number", "left").select("word", "n", "class")) if lexicon.whole else others.withColumn("class", F.lit(None).cast("int"))
    loose = scored.select("uid", F.explode("rest").alias("x")).select("uid", "x.word", "x.before", "x.after", F.col("x.n").alias("times")).join(others, "word", "left")
    more = loose.drop("word").mapInArrow(tidy(_parts(whole, rare_whole, model.own, transition)), "uid long, known long, base double, score double")
    if lexicon.whole:
        named = others.select("word", "class")
        pairs = scored.select("uid", F.explode("pairs").alias("x")).select("uid", "x.word", "x.next", F.col("x.n").alias("times")).join(named, "word", "left")
        pairs = pairs.select("uid", "times", F.col("class").alias("first"), F.col("next").alias("word")).join(named, "word", "left")
        more = more.union(pairs.drop("word").mapInArrow(tidy(_steps(transition)), "uid long, known long, base double, score double"))
    more = more.groupBy("uid").agg(*[F.sum(c).alias(f"more_{c}") for c in ("known", "base", "score")])
    zero = F.lit(0.0)
    return scored.drop("rest", "pairs").join(more, "uid", "left").select(
        "doc_id", "held_out", F.col("n_tokens").alias("n_tokens"), (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"), F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("more_base", zero)).alias("base_score"), (F.col("score") + F.coalesce("more_score", zero)).alias("score"),
    )


def _with_number(counts: DataFrame) -> DataFrame:
    """(word, n) with the numbers that the words have where they are not held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("n"), pa.array(hashed(batch.column("word")))], ["word", "n", "number"])

    return counts.select("word", "n").mapInArrow(tidy(run), "word binary, n long, number long")


_PARTS = pa.schema([("uid", pa.int64()), ("known", pa.int64()), ("base", pa.float64()), ("score", pa.float64())])


def _filled(batch: pa.RecordBatch, name: str, empty: int) -> np.ndarray:
    return batch.column(name).fill_null(empty).to_numpy(zero_copy_only=False)


def _parts(whole: float, rare_whole: float, own: np.ndarray, transition: np.ndarray) -> Callable:
    """What words that are not held add to their text: (uid, times, n, class, before, after), n null for unknown ones."""
    k = len(transition)
    step = np.pad(transition, (0, 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            uid, times, n, cls, before, after = (_filled(batch, x, 0 if x != "class" else -1) for x in ("uid", "times", "n", "class", "before", "after"))
            clustered = cls >= 0
            of = np.where(clustered, cls, k - 2)  # unknown and rare words have the class before that of ends
            emit = np.log10(np.where(clustered, n, n + 1) / np.where(clustered, own[of], rare_whole))
            yield batch_of({"uid": uid, "known": np.where(n > 0, times, 0), "base": times * np.log10((n + 1) / whole), "score": times * (emit + step[before, of] + step[of, after])}, _PARTS)

    return run


def _steps(transition: np.ndarray) -> Callable:
    """What the step between two words that are not held adds to their text: (uid, times, first, class)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            uid, times, first, cls = (_filled(batch, x, len(transition) - 2 if x in ("first", "class") else 0) for x in ("uid", "times", "first", "class"))
            yield batch_of({"uid": uid, "known": np.zeros(len(uid), np.int64), "base": np.zeros(len(uid)), "score": times * transition[first, cls]}, _PARTS)

    return run
