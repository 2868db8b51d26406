"""The audit against SQL and a plain count; the matrix against plain counts of words."""

import re
from collections import Counter
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest

from kymora.llm import audit, matrix, queries
from tests.conftest import SF


def plain_audit(docs, labels):
    first = {}
    for doc_id, text, _ in docs:
        if doc_id is not None:
            first[text or ""] = min(doc_id, first.get(text or "", doc_id))
    judged = []
    for doc_id, text, lang in docs:
        t = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {
            "A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)), "E": doc_id is not None and first[t] < doc_id,
        }
        judged.append((lang or "", {f for f in fails if fails[f]}, *labels.get(doc_id, (0, 0))))
    out = {}
    orders = ["".join(p) for p in permutations("ABCDE")]
    for part in {j[0] for j in judged}:
        mine = [j[1:] for j in judged if j[0] == part]
        removed_in = Counter()
        for order in orders:
            for k, f in enumerate(order):
                before = set(order[:k])
                here = [j for j in mine if f in j[0] and not j[0] & before]
                removed_in[f] += len(here)
                out[part, order, k + 1] = (
                    sum(not j[0] & (before | {f}) for j in mine), len(here), sum(f in j[0] and bool(j[0] & before) for j in mine),
                    sum(j[0] == {f} for j in mine), sum(j[1] for j in here), sum(j[2] for j in here),
                )
        for order in orders:
            for k, f in enumerate(order):
                out[part, order, k + 1] += (removed_in[f],)
    return out


def rows(df):
    return {tuple(r)[:3]: tuple(r)[3:] for r in df.collect()}


def test_small(spark, monkeypatch):
    monkeypatch.setattr(matrix, "SHARD_BYTES", 30_000)  # several shards in a task
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    want = plain_audit([(r.doc_id, r.text, r.lang) for r in docs.collect()], {r.doc_id: (int(r.quality == 1), int(r.toxic == 1)) for r in labels.collect()})
    assert rows(audit.audit(docs, labels)) == want


def test_odd(spark, odd):
    labels = spark.createDataFrame([(0, 1, 0, "x"), (0, None, 1, "y"), (3, 1, 1, "x"), (None, 1, 1, "x"), (999, 1, 1, "x")], "doc_id long, quality int, toxic int, lang string")
    more = spark.createDataFrame([(100, "WORDS # x", None), (101, "WORDS # x", ""), (102, "word " * 100, None)], "doc_id long, text string, lang string")
    plain = odd.toDF("doc_id", "text", "lang", "a", "b", "c").select("doc_id", "text", "lang")
    docs = [(r.doc_id, r.text, r.lang) for r in plain.unionAll(more).collect()]
    want = plain_audit(docs, {0: (1, 1), 3: (1, 1)})
    assert rows(audit.audit(plain.unionAll(more), labels)) == want
    assert rows(audit.audit(odd, labels)) == plain_audit([d for d in docs if d[0] is None or d[0] < 100], {0: (1, 1), 3: (1, 1)})


def test_empty(spark, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit.audit(empty, labels).count() == 0
    assert rows(audit.audit(queries.documents(spark, SF).where("doc_id < 20"), labels))


@pytest.mark.parametrize("shard_bytes,range_bytes", [(500, 10_000), (20_000, 1000), (16 << 20, 8 << 20)])
def test_matrix(spark, monkeypatch, shard_bytes, range_bytes):
    monkeypatch.setattr(matrix, "SHARD_BYTES", shard_bytes)
    monkeypatch.setattr(matrix, "RANGE_BYTES", range_bytes)
    docs = queries.documents(spark, SF).where("doc_id < 60").selectExpr("doc_id", "encode(coalesce(text, ''), 'UTF-8') AS raw").repartition(3, "doc_id")
    shards = matrix.local_shards(docs, lambda batch: {"doc_id": batch.column("doc_id")}, {"doc_id": pa.int64()}, "doc_id array<bigint>")
    lists = {r.shard: bytes(r.words).split(b" ") if r.words else [] for r in shards.collect()}
    numbers = matrix.numbered(shards)
    word = {r.id: r.word for r in matrix.dictionary(numbers).collect()}
    assert sorted(word) == list(range(len(word))) and len(set(word.values())) == len(word)
    told = numbers.collect()
    for r in told:
        nth = np.frombuffer(r.nth, "<i4")
        assert [word[r.before + k].encode() for k in nth.tolist()] == lists[r.shard][r.first : r.first + len(nth)]
    assert sum(len(r.nth) // 4 for r in told) == sum(map(len, lists.values()))
    got = {}
    for r in matrix.csr_shards(shards).collect():
        indptr, indices, data = (matrix.unpacked(x).tolist() for x in (r.indptr, r.indices, r.data))
        for k, doc_id in enumerate(r.doc_id):
            a, b = indptr[k], indptr[k + 1]
            assert indices[a:b] == sorted(set(indices[a:b]))
            got[doc_id] = {word[c]: n for c, n in zip(indices[a:b], data[a:b])}
    want = {r.doc_id: Counter(re.findall(r"[^\x20\x09-\x0D]+", bytes(r.raw).decode())) for r in docs.collect()}
    assert got == want
