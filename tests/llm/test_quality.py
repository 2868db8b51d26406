"""Repetition rules against plain restatements."""

import random
import re
from collections import Counter

import pyarrow as pa
import pytest

from kymora.llm import quality, queries
from kymora.llm.words import raw_bytes, split_words
from tests.conftest import SF
from tests.llm.test_tokens import rows_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def longest(w):
    best = [0] * len(w)
    for i in range(len(w)):
        for j in range(len(w)):
            k = 0
            while i != j and max(i, j) + k < len(w) and w[i + k] == w[j + k]:
                k += 1
            best[i] = max(best[i], k)
    return best


def base(text):
    w = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    inside = {j for i in range(len(w) - 7) if windows[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
    failed = len(w) < 20 or 100 * len(inside) > 30 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(inside), failed


@pytest.mark.parametrize("seed", range(5))
def test_suffix_array(seed):
    rng = random.Random(seed)
    texts = ["", " ", "a", "a a", "a a a a a a"] + [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 50))) for _ in range(40)]
    words = split_words(pa.array([t.encode() for t in texts], pa.binary()))
    got = quality.longest_repeats(words)
    for k, t in enumerate(texts):
        assert got[words.bounds[k] : words.bounds[k + 1]].tolist() == longest(t.split())


def test_lines():
    texts = ["x\ny\nx\n\n \n \nx ", "b\nb", "q\nq\n", "", "\n\n", "a\r\na\na\r"]
    assert quality.repeated_lines(*raw_bytes(pa.array([t.encode() for t in texts], pa.binary()))).tolist() == [base(t)[3] for t in texts]


@pytest.mark.parametrize("which", ["odd", "small"])
def test_base(spark, odd, which):
    docs = odd if which == "odd" else queries.documents(spark, SF)
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in quality.quality(docs).collect())
    assert got == Counter((d, *base(t)) for d, t in rows_of(docs))


def test_verdict(spark):
    rng = random.Random(1)
    clean = " ".join(f"w{rng.randrange(10**6)}" for _ in range(600))
    passage = " ".join(clean.split()[:30])
    texts = [clean, f"{clean} {passage}", " ".join(clean.split()[:100] + ["x", passage, "y", passage, "z", passage]), "a b c d e f " * 40, f"{clean} {clean}"]
    got = quality.quality(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [r.kept for r in got] == [True, True, False, False, False]
    assert [r.longest_repeat for r in got] == [0, 30, 30, 234, 600]


def test_empty(empty):
    assert quality.quality(empty).count() == 0
