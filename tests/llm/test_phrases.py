"""Phrase fingerprints: places do not matter, neighbours are the right ones."""

import hashlib

import numpy as np
import pytest

from kymora.llm import phrases, queries
from tests.conftest import SF
from tests.llm.test_tokens import rows_of


def test_a_text_alone_and_among_others():
    texts = ["", "a", "aaaa", "ab" * 500, "日本語テキスト" * 9, "x" * 5000, "one two three " * 40, ""]
    all_of = phrases.fingerprints_of(*phrases._codes(texts))
    for k, t in enumerate(texts):
        assert (phrases.fingerprints_of(*phrases._codes([t]))[0] == all_of[k]).all()


def test_shifted_text_keeps_its_phrases():
    rng = np.random.default_rng(1)
    text = "".join(rng.choice(list("etaoin shrdlu"), 4000))
    names, at = phrases._codes(["prefix" + text, text])
    for level in (1, 2, 3):
        names, at = phrases.parse_level(names, at, level)
        a, b = set(names[: at[1]].tolist()), set(names[at[1] :].tolist())
        assert len(a & b) >= 0.97 * len(b)


@pytest.mark.parametrize("which", ["odd", "small"])
def test_documents(spark, odd, which):
    docs = odd if which == "odd" else queries.documents(spark, SF)
    got = phrases.phrase_fingerprints(docs).collect()
    source = rows_of(docs)
    assert sorted((str(r.doc_id), r.n_chars) for r in got) == sorted((str(d), len(t)) for d, t in source)
    ids = [d for d, _ in source]
    if len(set(ids)) == len(ids):
        text = dict(source)
        order = sorted(text, reverse=True)
        after = dict(zip(order, order[1:] + order[:1]))
        for r in got:
            half = len(text[r.doc_id]) // 2
            edited = text[r.doc_id][: len(text[r.doc_id]) - half] + text[after[r.doc_id]][:half]
            assert hashlib.sha256(edited.encode()).hexdigest() == r.edited_sha256
            if text[r.doc_id] == edited:
                assert r.near_edited == 1 and r.fingerprint == r.edited_fingerprint
    by_text = {}
    for r in got:
        if r.edited_sha256 == hashlib.sha256(b"").hexdigest():
            assert set(r.edited_fingerprint) == {"0"}
    texts = {}
    for d, t in source:
        texts.setdefault(d, set()).add(t)
    for r in got:
        if len(texts[r.doc_id]) == 1:
            (t,) = texts[r.doc_id]
            assert by_text.setdefault(t, r.fingerprint) == r.fingerprint
    if which == "small":
        assert 0.25 < np.median([r.near_edited for r in got]) < 0.45 and np.median([r.near_next for r in got]) < 0.05


def test_one_row_and_none(spark, empty):
    (r,) = phrases.phrase_fingerprints(spark.createDataFrame([(4, "abcdef")], "doc_id long, text string")).collect()
    assert r.edited_sha256 == hashlib.sha256(b"abcabc").hexdigest() and r.near_next == 1
    assert phrases.phrase_fingerprints(empty).count() == 0


M = (1 << 64) - 1


def plain_mix(x):
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & M
    x = (x ^ x >> 27) * 0x94D049BB133111EB & M
    return x ^ x >> 31


def plain_seed(k, of):
    return plain_mix((k * 0x9E3779B97F4A7C15 + of) & M) | 1


def plain_level(names, level):
    """One level of one text, symbol after symbol."""
    runs = []
    for x in names:
        if runs and runs[-1][0] == x:
            runs[-1][1] += 1
        else:
            runs.append([x, 1])
    if level == 1:
        x = [c + (n << 21) if 1 < n <= 2047 else plain_mix(c + (n << 21)) | 1 << 63 if n > 2047 else c for c, n in runs]
    else:
        x = [plain_mix((c + n) & M) if n > 1 else c for c, n in runs]
    label = x
    for _ in range(4):
        new = []
        for k, v in enumerate(label):
            if not k:
                new.append(v & 1)
                continue
            differ = v ^ label[k - 1]
            low = (differ & -differ).bit_length() - 1
            new.append(2 * low + (v >> low & 1))
        label = new
    cuts = [k for k in range(len(x)) if not k or label[k] > label[k - 1] and (k + 1 == len(x) or label[k] > label[k + 1])]
    out = []
    for a, b in zip(cuts, [*cuts[1:], len(x)]):
        total = sum(plain_mix((v + level) & M) * plain_seed(j + 1, 77) for j, v in enumerate(x[a:b]))
        out.append(plain_mix((total + (b - a) * 0x9E3779B97F4A7C15 + level) & M))
    return out


def plain_print(text):
    names, kept = [ord(c) for c in text], []
    for level in range(1, max(phrases.LEVELS) + 1):
        names = plain_level(names, level)
        kept += names if level in phrases.LEVELS else []
    return [min(n * plain_seed(k + 1, 5) & M for n in kept) & 0xFFFF for k in range(phrases.SLOTS)] if text else [0] * phrases.SLOTS


TEXTS = ["", "a", "aa", "abcabc", "x" * 2047, "x" * 2048, "x" * 3000, "x" * 9000, "y" + "x" * 3000 + "z", "日本語テキスト、" * 5, "one two  three\n" * 30, "🙂é" * 40]


def test_fingerprints_by_a_plain_version(spark):
    texts = TEXTS + [r.text for r in queries.documents(spark, SF).where("text IS NOT NULL AND length(text) < 1500").orderBy("doc_id").limit(25).collect()]
    got = phrases.fingerprints_of(*phrases._codes(texts))
    for text, fingerprint in zip(texts, got.tolist()):
        assert fingerprint == plain_print(text), text[:40]


def test_likeness_by_a_plain_version(spark):
    docs = queries.documents(spark, SF).where("length(text) < 600")
    rows = dict(rows_of(docs))
    order = sorted(rows, reverse=True)
    prints = {d: plain_print(t) for d, t in rows.items()}
    like = lambda a, b: sum(x == y for x, y in zip(a, b)) / phrases.SLOTS
    for r in phrases.phrase_fingerprints(docs).collect():
        nxt = order[(order.index(r.doc_id) + 1) % len(order)]
        half = len(rows[r.doc_id]) // 2
        edited = plain_print(rows[r.doc_id][: len(rows[r.doc_id]) - half] + rows[nxt][:half])
        show = lambda p: np.array(p, ">u2").tobytes().hex()
        assert (r.fingerprint, r.edited_fingerprint) == (show(prints[r.doc_id]), show(edited))
        if rows[r.doc_id] and rows[nxt]:
            assert r.near_edited == pytest.approx(like(prints[r.doc_id], edited)) and r.near_next == pytest.approx(like(prints[r.doc_id], prints[nxt]))


def test_long_runs_differ():
    a, b = phrases.fingerprints_of(*phrases._codes(["x" * 3000, "x" * 9000]))
    assert (a == b).mean() < 0.1
