"""Token operators against the libraries themselves."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from kymora.llm import bpe, packing, queries, token_blocks, token_counts
from tests.conftest import SF

WORDS, BYTES = public_tokenizers.path(queries.WORDS), public_tokenizers.path(queries.BYTES)


def texts(df):
    return [(r["doc_id"], r["text"] or "") for r in df.select(df.columns[0], "text").toDF("doc_id", "text").collect()]


def rows_of(df):
    return texts(df.toDF(*["doc_id", "text", *[f"x{i}" for i in range(len(df.columns) - 2)]]))


def crc(ids):
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())


@pytest.fixture(scope="module", params=["odd", "small"])
def docs(request, spark, odd):
    return odd if request.param == "odd" else queries.documents(spark, SF)


def test_token_files(spark, docs):
    t = Tokenizer.from_file(WORDS)
    got = token_blocks.read_token_files(token_blocks.write_token_files(docs, token_blocks.token_folder(spark), WORDS, 2, file_ids=20_000)).collect()
    want = Counter((k, len(e) + 1, crc([*e.ids, 2])) for k, x in rows_of(docs) for e in [t.encode(x, add_special_tokens=False)])
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    start = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == start
        start += r.n_tokens
    keys = [-1 if r.doc_id is None else r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert keys == sorted(keys)


@pytest.mark.parametrize("n", [0, 1, 1023, 1024, 1025, 5000])
@pytest.mark.parametrize("high", [1, 2, 300, 49408, 2**32 - 1])
def test_blocks_round_trip(n, high):
    ids = np.random.default_rng(n).integers(0, high, n).astype(np.uint32)
    ids[n // 2 : n // 2 + 3] = 2**32 - 1
    file = token_blocks.TokenFile(token_blocks.to_bytes([5], [0], [n], ids))
    assert (file.ids() == ids).all() and file.doc_ids.tolist() == [5]
    assert (file.ids(n // 3, n // 2) == ids[n // 3 : n // 2]).all()


def test_token_counts(docs):
    t = Tokenizer.from_file(BYTES)
    got = Counter(map(tuple, token_counts.token_counts(docs, BYTES).collect()))
    want = Counter((k, len(x.encode()), n, n > 512) for k, x in rows_of(docs) for n in [len(t.encode(x, add_special_tokens=False))])
    assert got == want


def test_bpe(docs):
    t = Tokenizer.from_file(WORDS)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    got = Counter(map(tuple, bpe.encode_documents(docs, WORDS).collect()))
    want = Counter()
    for k, x in rows_of(docs):
        ids = t.encode(x, add_special_tokens=False).ids
        want[(k, len(ids), sha(" ".join(map(str, ids))), sha(t.decode(ids, skip_special_tokens=False)))] += 1
    assert got == want


def test_bpe_of_long_words_equals_that_of_short_ones():
    model = bpe.bpe(WORDS)
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("etaoinshr"), rng.integers(1, 60))).encode() for _ in range(300)]
    assert all((a == model.merge_long(w)).all() for w, a in zip(words, model.merge_many(words)))
    assert model.decode(model.encode("Hello, WORLD 12")) == "hello</w> ,</w> world</w> 1</w> 2</w>"


def check_bins(rows, capacity):
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_packing(docs):
    t = Tokenizer.from_file(WORDS)
    got = packing.pack_documents(docs, WORDS, end_id=1, capacity=256).collect()
    want = Counter()
    for k, x in rows_of(docs):
        ids = [*t.encode(x, add_special_tokens=False).ids, 1]
        want.update((k, p, s, len(ids[s : s + 256]), crc(ids[s : s + 256])) for p, s in enumerate(range(0, len(ids), 256)))
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    assert check_bins(got, 256) <= -(-sum(r.length for r in got) // 256) * 1.1 + 1


def test_sequences_hold_the_ids(spark, odd):
    packed = packing.pack_documents(odd, WORDS, capacity=512, with_ids=True)
    ids = {r.sequence_id: r.ids for r in packing.sequences(packed).collect()}
    for r in packed.collect():
        assert crc(ids[r.sequence_id][r.offset : r.offset + r.length]) == r.ids_crc32


def test_plan_uses_every_piece_once():
    rng = np.random.default_rng(5)
    for _ in range(200):
        capacity = int(rng.choice([10, 50, 4096]))
        counts = {int(n): int(rng.integers(1, 50)) for n in rng.integers(1, capacity + 1, rng.integers(1, 60))}
        runs, bins = packing.plan(counts, capacity)
        held, seen = defaultdict(list), Counter()
        for length, rank, n, first, each, offset in runs:
            assert rank == seen[length]
            seen[length] += n
            for i in range(n):
                held[first + i // each].append((offset + i % each * length, length))
        assert seen == counts and len(held) == bins
        for parts in held.values():
            at = 0
            for offset, length in sorted(parts):
                assert offset == at
                at += length
            assert at <= capacity
    assert packing.plan({1365: 3, 2731: 3}, 4096)[1] == 3
    with pytest.raises(ValueError):
        packing.plan({11: 1}, 10)


def test_empty_tables(spark, empty):
    assert token_counts.token_counts(empty, BYTES).count() == 0
    assert bpe.encode_documents(empty, WORDS).count() == 0
    assert packing.pack_documents(empty, WORDS).count() == 0
    files = token_blocks.write_token_files(empty, token_blocks.token_folder(spark), WORDS, 2)
    assert token_blocks.read_token_files(files).count() == 0


@pytest.mark.parametrize("most", [0, 3000, 1 << 20])
def test_what_an_encoder_remembers_is_bounded_by_bytes(most):
    """A Japanese text is one piece; ids do not depend on what is remembered."""
    import pyarrow as pa

    from kymora.llm import chunks

    t = Tokenizer.from_file(WORDS)
    texts = ["日本語のテキスト" * 50, "one two three one two", "four five " * 30, "日本語のテキスト" * 50, "six seven one two", ""] * 3
    e = chunks.PieceEncoder(WORDS, most)
    for a in range(0, len(texts), 4):
        part = texts[a : a + 4]
        ids, at = e.encode(pa.array([x.encode() for x in part], pa.binary()))
        assert [ids[i:j].tolist() for i, j in zip(at, at[1:])] == [t.encode(x, add_special_tokens=False).ids for x in part]
        assert sum(len(k) + len(v) + chunks.ENTRY for d in (e.known, e.older) for k, v in d.items()) <= most
