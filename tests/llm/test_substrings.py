"""Substring removal against a dictionary of all windows."""

import hashlib
import random
import re

import pytest

from kymora.llm import queries, substrings
from tests.conftest import SF
from tests.llm.test_tokens import rows_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, width=20):
    """Rows of distinct doc_id."""
    first, out = {}, []
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    for d, t in order:
        w = WORD.findall(t)
        gone = [False] * len(w)
        for i in range(len(w) - width + 1):
            key = tuple(w[i : i + width])
            if key in first:
                gone[i : i + width] = [True] * width
            else:
                first[key] = (d, i)
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((str(d), len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def result(df):
    return sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in df.collect())


@pytest.fixture(scope="module")
def planted(spark):
    rng = random.Random(4)
    vocabulary = [f"w{k}" for k in range(300)] + ["é", "日本"]
    make = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    passages = [make(rng.randint(15, 60)) for _ in range(6)]
    rows = []
    for d in range(150):
        parts = [make(rng.randint(0, 40)) for _ in range(3)]
        for p in passages[: rng.randint(0, 6)]:
            cut = rng.randint(0, 8)
            parts.insert(rng.randint(0, 2), p[cut:] if rng.random() < 0.5 else p)
        rows.append((d, "\n".join(" ".join(p) for p in parts)))
    base = make(200)
    for d in range(150, 220):  # near copies
        w = list(base)
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(len(w))] = "edit"
        rows.append((d, " ".join(w)))
    rows += [(220, "a " * 100), (221, "a " * 50), (222, "a b " * 60), (223, "b a " * 30), (224, ""), (225, " ".join(base)), (226, " ".join(base)), (None, " ".join(base[:50]))]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("shard", [4096, 3])
def test_planted(spark, planted, shard):
    docs = spark.createDataFrame(planted, "doc_id long, text string")
    assert result(substrings.remove_repeats(docs, shard)) == brute(planted)


def test_documents(spark):
    docs = queries.documents(spark, SF)
    assert result(substrings.remove_repeats(docs)) == brute(rows_of(docs))


def test_odd(spark, odd):
    got = {}
    for r in substrings.remove_repeats(odd).collect():
        got.setdefault(r.doc_id, set()).add((r.n_words, r.n_removed))
    assert got[24] == {(30_000, 29_999)}
    assert all(removed == 0 for d, x in got.items() if d != 24 for _, removed in x)
    assert sum(1 for _ in substrings.remove_repeats(odd).collect()) == odd.count()


def test_rows_that_share_an_id(spark):
    words = " ".join(f"x{k}" for k in range(30))
    rows = [(1, words), (1, words), (1, f"{words} more"), (2, words)]
    got = substrings.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    by = sorted((r.doc_id, r.n_words, r.n_removed) for r in got)
    assert by in ([(1, 30, 0), (1, 30, 0), (1, 31, 30), (2, 30, 30)], [(1, 30, 30), (1, 30, 30), (1, 31, 0), (2, 30, 30)])


def test_automaton_knows_where_a_run_came_first():
    rng = random.Random(2)
    for _ in range(100):
        sequences = [[rng.choice("ab") for _ in range(rng.randint(1, 12))] for _ in range(4)]
        tree = substrings.Automaton()
        for k, s in enumerate(sequences):
            tree.insert(s, k)
        for s in sequences + [[rng.choice("abc") for _ in range(12)]]:
            for width in (1, 2, 4):
                want = []
                for e in range(width - 1, len(s)):
                    run = s[e - width + 1 : e + 1]
                    want.append(next(((k, j + width - 1) for k, q in enumerate(sequences) for j in range(len(q) - width + 1) if q[j : j + width] == run), (-1, -1)))
                assert tree.firsts(s, width) == want


def test_empty(empty):
    assert substrings.remove_repeats(empty).count() == 0
