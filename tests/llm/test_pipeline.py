"""Each stage of the pipeline against a plain restatement, and the whole run."""

import random
import re

import pytest

import corpus_pipeline
from kymora.llm import neardups, quality, secrets, substrings
from tests.conftest import SF
from tests.llm.test_secrets import brute as spans_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")
NAMES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def corpus(spark):
    """Clean texts, copies near and exact, shared passages and secrets, with awkward extra columns."""
    rng = random.Random(9)
    vocabulary = [f"w{k}" for k in range(3000)]
    make = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    rows, passage = [], " ".join(make(60))
    for d in range(60):
        words = make(rng.randint(60, 300))
        text = " ".join(words[:30]) + "\n" + " ".join(words[30:])
        if d % 5 == 0:
            text = f"{text}\n{passage} {d}"
        if d % 7 == 0:
            text += f"\npassword = hunter{d}22xyz"
        rows.append((d, text))
    for d in range(60, 90):  # near copies of 0..9: one edit in about 80 words
        words = rows[d % 10][1].split(" ")
        for _ in range(max(1, len(words) // 80)):
            words[rng.randrange(len(words))] = "edited"
        rows.append((d, " ".join(words)))
    rows += [(d, rows[d % 10][1]) for d in range(90, 110)]
    rows += [(110, None), (111, ""), (112, "too short"), (113, "again and again " * 40), (None, " ".join(make(80))), (5, " ".join(make(70))), (5, " ".join(make(70)))]
    rng.shuffle(rows)
    data = [(d, t, "en", "src0", len(t) if t is not None else None, 7, "ord") for d, t in rows]
    return spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long, TEXT int, h string")


def stage(spark, name, docs):
    out = NAMES[name](spark, docs, SF)
    assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
    return out


def rows_of(df):
    return [(r[0], r[1]) for r in df.collect()]


def test_quality_rules(spark, corpus):
    kept = {(str(d), t) for d, t in rows_of(stage(spark, "quality rules", corpus))}
    short = [(str(d), t) for d, t in rows_of(corpus) if t is None or len(t.split()) < 20 or t.startswith("again")]
    assert kept == {(str(d), t) for d, t in rows_of(corpus)} - set(short)


def shingles(text):
    w = text.lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


def test_near_duplicates(spark, corpus):
    docs = corpus.filter("doc_id is null or doc_id < 110 ")
    source = sorted(rows_of(docs), key=lambda r: (r[0] is not None, r[0] or 0))
    root = list(range(len(source)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    sets = [shingles(t) for _, t in source]
    for i in range(len(source)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    want = sorted(str(source[i][0]) for i in range(len(source)) if find(i) == i)
    assert sorted(str(d) for d, _ in rows_of(stage(spark, "near duplicates", docs))) == want


def test_substring_dedup(spark, corpus):
    docs = corpus.filter("doc_id < 60 and doc_id <> 5")
    got = {r[0]: (r[1], r[4]) for r in stage(spark, "substring dedup", docs).collect()}
    seen = set()
    for d, t in sorted(rows_of(docs)):
        w = WORD.findall(t)
        gone = [False] * len(w)
        for i in range(len(w) - 19):
            if tuple(w[i : i + 20]) in seen:
                gone[i : i + 20] = [True] * 20
            seen.add(tuple(w[i : i + 20]))
        assert got[d][0].split() == [x for x, g in zip(w, gone) if not g]
        assert got[d][1] == len(got[d][0])
        if not any(gone):
            assert got[d][0] == t
    assert any(len(got[d][0]) < len(t) for d, t in rows_of(docs))


def test_secret_scans(spark, corpus):
    source = {d: t for d, t in rows_of(corpus.filter("doc_id < 60 and doc_id <> 5"))}
    got = {r[0]: (r[1], r[4]) for r in stage(spark, "secret scans", corpus.filter("doc_id < 60 and doc_id <> 5")).collect()}
    assert set(got) == set(source)
    for d, t in source.items():
        if spans_of(t):
            assert secrets.MARK in got[d][0] and spans_of(got[d][0]) == "" and got[d][1] == len(got[d][0])
        else:
            assert got[d] == (t, len(t))


def test_run(spark):
    got = corpus_pipeline.run(spark, SF).collect()
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= corpus_pipeline.CAPACITY
    assert len({r.doc_id for r in got}) > 100


def test_empty(spark, empty):
    for name, f in corpus_pipeline.STAGES:
        assert f(spark, empty, SF).count() == 0
