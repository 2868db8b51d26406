"""Runs against a plain search for every period."""

import hashlib
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from kymora.llm import queries, runs
from tests.conftest import SF


def plain_runs(words, rule=runs.Rule()):
    out, seen = [], set()
    for q in range(1, len(words) // rule.least + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(rule.words, rule.least * q) and (i, j + q) not in seen:
                seen.add((i, j + q))  # a greater period of the same stretch is not its smallest
                out.append((i, j - i + q, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text, plant=True):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if plant and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = plain_runs(words)
    top = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    dropped = {i for s, length, q in found for i in range(s + q, s + length)}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (
        doc_id, len(found), *(top or (None, None, None)), 1000 * top[1] // top[2] if top else None,
        sha("".join(f"{s},{length},{q}\n" for s, length, q in found)), sha(" ".join(w for i, w in enumerate(words) if i not in dropped)),
    )


def flat(texts):
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    return np.concatenate([*texts, []]).astype(np.int64), bounds


@pytest.mark.parametrize("rule", [runs.Rule(), runs.Rule(2, 2), runs.Rule(9, 3)])
def test_random_texts(rule):
    rng = np.random.default_rng(5)
    for _ in range(150):
        texts = []
        for _ in range(rng.integers(1, 6)):
            n = int(rng.integers(0, 90))
            w = rng.integers(0, rng.integers(1, 5), n)
            if n and rng.random() < 0.6:
                a, p = int(rng.integers(0, n)), int(rng.integers(1, 12))
                w[a:] = w[a + np.arange(n - a) % min(p, n - a)]
            texts.append(w)
        got = runs.find_runs(*flat(texts), rule)
        assert [tuple(r) for r in got.tolist()] == [(k, *r) for k, t in enumerate(texts) for r in plain_runs(t.tolist(), rule)]


def test_large_classes_in_blocks(monkeypatch):
    monkeypatch.setattr(runs.Positions, "MOST", 8)
    rng = np.random.default_rng(6)
    text = np.concatenate([np.append(np.zeros(int(k), int), i + 1) for i, k in enumerate(rng.integers(1, 30, 60))])
    got = runs.find_runs(*flat([text, text[::-1]]))
    assert [tuple(r) for r in got.tolist()] == [(k, *r) for k, t in enumerate([text, text[::-1]]) for r in plain_runs(t.tolist())]


@pytest.mark.parametrize("name", ["same", "periodic", "two", "unary"])
def test_long_texts(name):
    """A text of 300,000 words costs time in proportion: one run, or as many as are laid in."""
    n = 300_000
    rng = np.random.default_rng(7)
    if name == "unary":
        text, want = np.tile(np.append(np.zeros(29, int), 1), n // 30), [(0, 0, n, 30)]
        got = runs.find_runs(*flat([text]))
        assert len(got) == n // 30 + 1 and got[0].tolist() in ([0, 0, 29, 1], [0, 0, n, 30])
        return
    if name == "same":
        text, want = np.zeros(n, int), [(0, 0, n, 1)]
    elif name == "periodic":
        text, want = rng.permutation(5000)[np.arange(n) % 5000], [(0, 0, n, 5000)]
    else:
        text, want = np.arange(n) % 2, [(0, 0, n, 2)]
    assert [tuple(r) for r in runs.find_runs(*flat([text])).tolist()] == want


def test_documents(spark):
    rows = queries.documents(spark, SF).select("doc_id", "text").collect()
    got = {tuple(r) for r in queries.op12_periodic_runs(spark, SF).collect()}
    want = {plain_row(r.doc_id, r.text) for r in rows}
    assert got == want and any(r[1] for r in want) and any(not r[1] for r in want)


def test_odd(odd):
    plain = odd.toDF("doc_id", "text", *[f"x{i}" for i in range(len(odd.columns) - 2)])
    short = [r for r in plain.collect() if len(r.text or "") < 50_000]
    got = Counter(tuple(r) for r in runs.periodic_runs(odd, plant=True).collect())
    want = Counter(plain_row(r.doc_id, r.text) for r in short)
    assert not want - got and sum(got.values()) == odd.count()
    (word,) = [r for r in got if r[3] == 30_000]  # "word" 30,000 times
    assert word[1:6] == (1, 0, 30_000, 1, 30_000_000)
    table = runs.run_table(odd).where("length = 30000").collect()
    assert [tuple(r)[1:] for r in table] == [(0, 30_000, 1)]


def test_empty(empty):
    assert runs.periodic_runs(empty).count() == runs.run_table(empty).count() == 0
