"""Class-based model against plain counts, and against the unigram model on texts held out."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from kymora.llm import classlm, exchange, queries
from tests.conftest import SF
from tests.llm.test_tokens import rows_of


def brute(rows):
    words = [(d, t.encode().lower().split()) for d, t in rows]
    held = [zlib.crc32(b"" if d is None else str(d).encode()) % 7 == 2 for d, _ in rows]
    train = [w for (_, w), h in zip(words, held) if not h]
    count = Counter(x for w in train for x in w)
    n, v = sum(count.values()) + len(train), len(count) + (len(train) > 0)
    out = []
    for (d, w), h in zip(words, held):
        base = sum(math.log10((c + 1) / (n + v + 1)) for c in [*(count[x] for x in w), len(train)])
        out.append((str(d), h, len(w) + 1, sum(count[x] > 0 for x in w) + (len(train) > 0), n, f"{base:.6f}"))
    return Counter(out)


@pytest.mark.parametrize("size", [{}, {"held": 300, "clustered": 100, "classes": 8, "rounds": 2}, {"held": 0}, {"held": 50, "min_count": 1}])
@pytest.mark.parametrize("which", ["odd", "small"])
def test_base(spark, odd, which, size):
    docs = odd if which == "odd" else queries.documents(spark, SF)
    got = classlm.score(docs, **size).collect()
    assert Counter((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, f"{r.base_score:.6f}") for r in got) == brute(rows_of(docs))
    assert all(r.score < 0 for r in got)
    if which == "small" and not size:
        out = [r for r in got if r.held_out]
        assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_exchange_takes_the_best_class():
    rng = np.random.default_rng(1)
    words, free = 12, 3
    seq = [words + 1, *rng.integers(0, words + 1, 400).tolist(), words + 1]
    pairs = Counter(zip(seq, seq[1:]))
    of = np.append(np.arange(words) % free, [free, free + 1])

    def table(of):
        t = np.zeros((free + 2, free + 2))
        for (a, b), n in pairs.items():
            t[of[a], of[b]] += n
        return t

    for w in range(words):
        left, right = np.zeros(free + 2), np.zeros(free + 2)
        for (a, b), n in pairs.items():
            left[of[a]] += n * (b == w)
            right[of[b]] += n * (a == w)
        got = classlm.best_class(table(of), int(of[w]), left, right, float(pairs[(w, w)]), free)
        values = []
        for c in range(free):
            other = of.copy()
            other[w] = c
            values.append(classlm.likelihood(table(other)))
        assert values[got] == pytest.approx(max(values))


def test_nothing_to_train_on(spark, empty):
    assert classlm.score(empty).count() == 0
    held = next(k for k in range(100) if zlib.crc32(str(k).encode()) % 7 == 2)
    (r,) = classlm.score(spark.createDataFrame([(held, "a b a")], "doc_id long, text string")).collect()
    assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score) == (4, 0, 0, 0.0)


def test_the_lexicon_is_filled_whatever_the_counts(spark):
    """A first step of equally frequent words that is larger than what may be held."""
    docs = spark.range(8000).selectExpr("id AS doc_id", "encode(concat('w', id), 'UTF-8') AS raw")
    counts = classlm.count_words(docs)
    for held in (0, 1, 1000, 7999, 8000, 10_000):
        lexicon = classlm.make_lexicon(counts, held, 100)
        assert len(lexicon.counts) == min(held, 8000) and lexicon.clustered == min(100, len(lexicon.counts))
    many = spark.range(9000).selectExpr("id AS doc_id", "encode(concat('w', id % 300, ' ', IF(id % 2 = 0, 'even', 'odd')), 'UTF-8') AS raw")
    lexicon = classlm.make_lexicon(classlm.count_words(many), 100, 10, 30)
    assert len(lexicon.counts) == 100 and sorted(lexicon.counts)[-2:] == [4500, 4500] and lexicon.clustered == len(lexicon.counts)


@pytest.mark.parametrize("size", [(1 << 18, 1 << 13, 64, 3, 64), (300, 50, 6, 2, 20)])
def test_score_is_the_plain_sum_over_class_bigrams(spark, size):
    docs = queries.documents(spark, SF)
    held, clustered, classes, rounds, least = size
    rows = classlm.texts(docs).withColumn("held_out", classlm.is_held_out(classlm.F.col("doc_id")))
    model, _ = classlm.train(rows.filter("NOT held_out"), held, clustered, classes, rounds, least)
    number = model.lexicon.numbers()
    rare, end = model.lexicon.clustered, model.lexicon.clustered + 1
    all_words = {r.doc_id: bytes(r.raw).lower().split() for r in rows.collect()}
    train = [all_words[r.doc_id] for r in rows.filter("NOT held_out").collect()]
    count = Counter(w for text in train for w in text)
    symbol = lambda w: min(number.get(w, rare), rare)
    table, own = np.zeros_like(model.transition), Counter()
    for text in train:
        of = [int(model.of[end]), *[int(model.of[symbol(w)]) for w in text], int(model.of[end])]
        for a, b in zip(of, of[1:]):
            table[a, b] += 1
        for w in text:
            own[int(model.of[symbol(w)])] += 1
    k = len(table)
    rare_words = sum(symbol(w) == rare for w in count)
    got = {r.doc_id: r.score for r in classlm.score(docs, *size).collect()}
    for doc_id, text in all_words.items():
        of = [int(model.of[end]), *[int(model.of[symbol(w)]) for w in text], int(model.of[end])]
        want = sum(math.log10((table[a, b] + classlm.ALPHA) / (table[a].sum() + classlm.ALPHA * k)) for a, b in zip(of, of[1:]))
        for w in text:
            c = int(model.of[symbol(w)])
            want += math.log10((count[w] + 1) / (own[c] + rare_words + 1)) if symbol(w) == rare else math.log10(count[w] / own[c])
        assert got[doc_id] == pytest.approx(want, rel=1e-9), doc_id


def plain_exchange(train, number, classes, rounds):
    """Every word of one half in turn goes where the likelihood of the whole is highest."""
    pairs = Counter((a, b) for text in train for a, b in zip(["", *text], [*text, ""]))

    def table(of):
        t = np.zeros((classes + 2, classes + 2))
        for (a, b), n in pairs.items():
            t[of[a], of[b]] += n
        return t

    of = {w: i % classes for w, i in number.items()} | {"": classes + 1}
    best = classlm.likelihood(table(of)), of
    for turn in range(rounds):
        t, new = table(of), dict(of)
        for w, i in number.items():
            if (i // classes + i + turn) % 2:
                continue
            values = []
            for c in range(classes):
                moved = t.copy()
                for (a, b), n in pairs.items():
                    if w in (a, b):
                        moved[of[a], of[b]] -= n
                        moved[c if a == w else of[a], c if b == w else of[b]] += n
                values.append(classlm.likelihood(moved))
            if max(values) > values[of[w]] + 1e-7:
                new[w] = int(np.argmax(values))
        of = new
        best = max(best, (classlm.likelihood(table(of)), of), key=lambda x: x[0])
    return best[1], table(best[1])


@pytest.mark.parametrize("held", [0, 30, 1 << 18])
def test_every_word_is_clustered(spark, monkeypatch, held):
    """Also those that no task holds: classes, table and scores are those of a plain exchange of all words."""
    for name, value in (("SHARE", 500), ("SPLIT", 40), ("CHUNK", 400), ("BATCH", 7)):
        monkeypatch.setattr(exchange, name, value)
    rng = np.random.default_rng(3)
    texts = [" ".join(f"W{x}" for x in np.minimum(rng.zipf(1.5, rng.integers(0, 60)) + 40 * (k % 2), 120) for _ in range(1 + (x % 7 == 0))) for k in range(120)]
    docs = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string").repartition(3)
    rows = classlm.texts(docs).filter(~classlm.is_held_out(classlm.F.col("doc_id")))
    model, _ = classlm.train(rows, held, None, 5, 3)
    train = [t.lower().split() for k, t in enumerate(texts) if zlib.crc32(str(k).encode()) % 7 != 2]
    count = Counter(w for t in train for w in t)
    number = {w.decode(): i for w, i in model.lexicon.numbers().items()}
    assert len(number) == min(held, len(count))
    beyond = sorted(set(count) - set(number))
    number |= dict(zip(beyond, exchange.hashed(classlm.pa.array([w.encode() for w in beyond], classlm.pa.binary())).tolist()))
    assert len(set(number.values())) == len(count)
    want, table = plain_exchange(train, number, 5, 3)
    loose = {r["number"]: r["class"] for r in model.loose.collect()}
    of = {w: int(model.of[i]) if i < exchange.LOOSE else loose.pop(i) for w, i in number.items()}
    assert not loose and of | {"": 6} == want and len(set(of.values())) > 1
    np.testing.assert_allclose(model.transition, np.log10((table + classlm.ALPHA) / (table.sum(1, keepdims=True) + classlm.ALPHA * 7)))
    got = {r.doc_id: r.score for r in classlm.score(docs, held, classes=5, rounds=3).collect()}
    own = Counter()
    for w, n in count.items():
        own[of[w]] += n
    of |= {"": 6}
    for k, t in enumerate(texts):
        cls = [6, *[of.get(w, 5) for w in t.lower().split()], 6]
        score = sum(model.transition[a, b] for a, b in zip(cls, cls[1:])) + sum(math.log10(count[w] / own[of[w]]) for w in t.lower().split() if w in count)
        assert got[k] == pytest.approx(score, rel=1e-9), k


def test_the_query_clusters_every_word(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(classlm, "train", lambda *a, real=classlm.train: seen.append(real(*a)) or seen[-1])
    rows = queries.op10_class_lm(spark, SF).count()
    (model, counts), words = seen[0], seen[0][1].count()
    assert rows == queries.documents(spark, SF).count()
    assert model.lexicon.whole and model.lexicon.clustered + model.loose.count() == words > 1 << 13 and model.rare_words == 0
