"""SimHash groups against all pairs."""

import random

import numpy as np
import pytest
import xxhash

from kymora.llm import queries, simhash
from kymora.llm.components import components
from tests.conftest import SF
from tests.llm.test_tokens import rows_of


def print_of(text, width=3):
    w = text.encode().lower().split()
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + width]), 42) for i in range(max(1, len(w) - width + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(rows, tau=2):
    fps = sorted({f for _, f in rows})
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    a = np.array(fps, np.uint64)
    for i in range(len(a)):
        for j in np.flatnonzero(np.bitwise_count(a[i + 1 :] ^ a[i]) <= tau) + i + 1:
            root[find(fps[i])] = find(fps[j])
    least = {}
    for d, f in rows:
        if d is not None:
            least[find(f)] = min(least.get(find(f), d), d)
    return sorted((str(d), f, least.get(find(f))) for d, f in rows)


@pytest.mark.parametrize("which", ["odd", "small"])
def test_documents(spark, odd, which):
    docs = odd if which == "odd" else queries.documents(spark, SF)
    got = sorted((str(r.doc_id), r.fp % (1 << 64), r.component_id) for r in simhash.near_duplicates(docs).collect())
    assert got == groups([(d, print_of(t)) for d, t in rows_of(docs)])


@pytest.mark.parametrize("bucket", [2048, 30])
@pytest.mark.parametrize("tau", [1, 2, 3])
def test_dense_group(spark, bucket, tau):
    rng = random.Random(tau)
    bases = [rng.getrandbits(64) for _ in range(4)]
    fps = {rng.choice(bases) ^ sum({1 << rng.randrange(64) for _ in range(rng.randint(0, 6))}) for _ in range(700)}
    rows = list(enumerate(fps))
    nodes = spark.createDataFrame([(i, simhash._signed(f)) for i, f in rows], "least long, fp long")
    root = {r.node: r.root for r in components(simhash.links(nodes, tau, bucket)).collect()}
    least = {}
    for i, f in rows:
        k = root.get(simhash._signed(f), simhash._signed(f))
        least[k] = min(least.get(k, i), i)
    assert sorted((str(i), f, least[root.get(simhash._signed(f), simhash._signed(f))]) for i, f in rows) == groups(rows, tau)


def test_plan():
    both = np.full((64, 64), 25.0)
    np.fill_diagonal(both, 50.0)
    for n in (100, 10**6, 10**10):
        plan = simhash.allocate(n, both * n / 100, 2)
        bits = [b for g, _ in plan for b in g]
        assert len(bits) == len(set(bits))
        assert sum(t + 1 for _, t in plan) >= 3  # the pigeonhole bound
    assert any(t for _, t in simhash.allocate(10**10, both * 10**8, 2))


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(1000, 1200)] + [(5, k) for k in range(100, 400)] + [(7, 7), (8, 9), (9, 8)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(1000, 1201), 1000), 5: 5, **dict.fromkeys(range(100, 400), 5), 8: 8, 9: 8}


def test_empty(empty):
    assert simhash.near_duplicates(empty).count() == 0
