"""Texts that only a middle one joins, many of them in one sample."""

import random

import pytest

from kymora.llm import neardups
from kymora.llm.simhash import fingerprint
from tests.llm.test_pipeline import shingles


def corpus():
    """Two bases with edited copies, each near its base and far from the other copies, and lone texts."""
    rng = random.Random(5)
    make = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    rows = []
    for size, copies in ((300, 240), (90, 40)):
        base = make(size)
        rows.append(" ".join(base))
        for _ in range(copies):
            words = list(base)
            for at in rng.sample(range(0, size, 5), size // 60 + (size > 100)):
                words[at] = f"edit{rng.randrange(10**9)}"
            rows.append(" ".join(words[: rng.choice((size, size - 4))] + make(rng.randint(0, 3))))
    rows += [" ".join(make(100)) for _ in range(20)]
    rng.shuffle(rows)
    return rows


def kept(rows):
    sets = [shingles(t) for t in rows]
    prints = [fingerprint(t.encode().split(), 3) for t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2 or len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [i for i in range(len(rows)) if find(i) == i]


@pytest.mark.parametrize("weight", [neardups.WEIGHT, 4000])
def test_copies_of_one_base(spark, weight):
    rows = corpus()
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = neardups.keep_one(docs, weight=weight).select("doc_id").collect()
    assert sorted(r[0] for r in got) == kept(rows)
