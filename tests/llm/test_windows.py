"""Bounded-space packing: every id in one piece, windows whole, padding small, at any number of partitions."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from kymora.llm import queries, windows
from tests.conftest import SF

PATH = public_tokenizers.path(queries.WORDS)


def checked(docs, got, capacity):
    """Ids of all windows and of all documents agree with the library's; the share of padding."""
    library = Tokenizer.from_file(PATH)
    plain = docs.toDF(*["doc_id", "text", *[f"x{i}" for i in range(len(docs.columns) - 2)]])
    want = defaultdict(list)
    for r in plain.select("doc_id", "text").collect():
        want[r.doc_id].append(np.array([*library.encode(r.text or "", add_special_tokens=False).ids, 1], "<u4"))
    pieces, windows_ = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r.doc_id].append(r)
        windows_[r.sequence_id].append(r)
    assert set(pieces) == set(want)
    for key, all_ids in want.items():
        assert sum(r.length for r in pieces[key]) == sum(map(len, all_ids)) and all(r.length > 0 for r in pieces[key])
        if len(all_ids) > 1:
            continue  # rows of one id cannot be told apart
        at = 0
        for r in sorted(pieces[key], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(all_ids[0]))
            at += r.length
            assert zlib.crc32(all_ids[0][r.start : at].tobytes()) == r.ids_crc32
    padding = total = 0
    for rows in windows_.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
        total += at
        padding += capacity - at if at & (at - 1) else 0
    return padding / max(total, 1)


@pytest.mark.parametrize("options", [{}, {"open_windows": 1, "fan_in": 2}, {"open_windows": 3, "fan_in": 2, "slack": 0}, {"capacity": 100, "open_windows": 8, "slack": 2}])
def test_small(spark, options):
    docs = queries.documents(spark, SF).repartition(9)
    capacity = options.get("capacity", 2048)
    padding = checked(docs, windows.pack_windows(docs, PATH, **options).collect(), capacity)
    assert padding <= options.get("slack", 16) / (capacity / 2)


def test_odd(spark, odd):
    assert checked(odd, windows.pack_windows(odd.repartition(5), PATH, capacity=64, open_windows=4, slack=1, fan_in=2).collect(), 64) < 0.02


def test_hot_lengths_and_equal_rows(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "IF(id % 3 = 0, 'a b c', repeat('word ', CAST(id % 97 AS INT))) AS text").repartition(7)
    assert checked(docs, windows.pack_windows(docs, PATH, capacity=256, open_windows=4, slack=0).collect(), 256) == 0


def test_few_cuts(spark):
    """Cutting is the exception: most documents that fit a window are whole."""
    docs = queries.documents(spark, SF)
    got = windows.pack_windows(docs, PATH).where("doc_tokens <= 2048").groupBy("doc_id").count().collect()
    assert sum(r["count"] > 1 for r in got) < 0.15 * len(got)


def test_same_windows_again(spark):
    docs = queries.documents(spark, SF).repartition(6, "doc_id")
    a, b = (sorted(map(tuple, windows.pack_windows(docs, PATH, open_windows=5, fan_in=2).collect())) for _ in range(2))
    assert a == b


def test_empty(empty):
    assert windows.pack_windows(empty, PATH).count() == 0
