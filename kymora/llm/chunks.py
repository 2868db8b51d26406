"""Cuts texts where a tokenizer cuts them anyway, so that each distinct piece is encoded once.

A piece never crosses a place where the tokenizer starts a new word, so the ids of a text are the ids of
its pieces in a row. Places are found on the bytes of many texts at once. Only plain characters (ASCII
and U+00C0 to U+00FF) are cut inside a chunk; a chunk that holds an apostrophe, another script, a
control character or the start of a special token stays whole.
"""

from __future__ import annotations

import json
import os
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

WHOLE, SPACE, LETTER, DIGIT, OTHER = 0, 1, 2, 3, 4
ENTRY = 170  # bytes that a dictionary entry takes beside its piece and ids


def _classes() -> np.ndarray:
    table = np.full(256, WHOLE, np.uint8)
    table[0x21:0x7F] = OTHER
    table[[0x20, *range(0x09, 0x0E)]] = SPACE
    table[ord("0") : ord("9") + 1] = DIGIT
    table[ord("A") : ord("Z") + 1] = LETTER
    table[ord("a") : ord("z") + 1] = LETTER
    table[0x80:0xC0] = LETTER  # second bytes, after 0xC3 only
    table[0xC3] = LETTER
    table[ord("'")] = WHOLE
    return table


CLASSES = _classes()


@dataclass
class Pieces:
    """``distinct[index[k]]`` is piece k; text d holds pieces ``bounds[d]`` to ``bounds[d + 1]``."""

    distinct: list[bytes]
    plain: np.ndarray
    index: np.ndarray
    bounds: np.ndarray


def cut(raw: pa.Array, words: bool) -> Pieces:
    """``words``: letters fold to lower case, white space goes, digits stand alone. Else byte-level rules."""
    raw = raw.cast(pa.large_binary())
    ends = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset : raw.offset + len(raw) + 1]
    buffer = raw.buffers()[2]
    data = np.frombuffer(buffer, np.uint8)[ends[0] : ends[-1]] if buffer is not None else np.zeros(0, np.uint8)
    ends = ends - ends[0]
    n = len(data)
    if not n:
        return Pieces([], np.zeros(0, bool), np.zeros(0, np.int64), np.zeros(len(raw) + 1, np.int64))
    kind = CLASSES[data]
    after = data[1:]
    kind[1:][(after >= 0x80) & (after < 0xC0) & (data[:-1] != 0xC3)] = WHOLE
    kind[1:][(data[:-1] == 0xC3) & ((after == 0x97) | (after == 0xB7))] = WHOLE
    kind[:-1][(data[:-1] == ord("<")) & (after == ord("|"))] = WHOLE
    first = np.zeros(n + 1, bool)
    first[ends] = True
    space = kind == SPACE
    starts = first[:n].copy()
    if words:
        starts |= space
    else:  # one space or one line end between two plain characters; more than that stays in the chunk
        plain = kind >= LETTER
        alone = np.zeros(n, bool)
        alone[1:-1] = space[1:-1] & plain[:-2] & plain[2:] & ~first[1 : n - 1] & ~first[2:n]
        line = alone & (data == 0x0A)
        starts |= alone & ((data == 0x20) | line)
        starts[1:] |= line[:-1]
    # a chunk is plain if all its bytes are; its first may be white space
    odd = (kind == WHOLE) | (space & ~starts)
    at = np.flatnonzero(starts)
    chunk_plain = ~np.logical_or.reduceat(odd, at)
    plain_byte = np.repeat(chunk_plain, np.diff(np.append(at, n)))
    inner = plain_byte[1:] & ~space[:-1] & ~space[1:] & ((kind[1:] != kind[:-1]) | (words & (kind[1:] == DIGIT)))
    starts[1:] |= inner
    if words:
        data = data.copy()
        data[space] = 0x20
        data[plain_byte & (data >= ord("A")) & (data <= ord("Z"))] += 32
        upper = plain_byte[1:] & (data[:-1] == 0xC3) & (data[1:] < 0x9F)
        data[1:][upper] += 32
    at = np.flatnonzero(starts)
    offsets = np.append(at, n).astype(np.int64)
    pieces = pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    coded = pieces.dictionary_encode()
    index = coded.indices.to_numpy(zero_copy_only=False)
    distinct = coded.dictionary.to_pylist()
    flags = np.zeros(len(distinct), bool)
    flags[index] = plain_byte[at]
    return Pieces(distinct, flags, index, np.searchsorted(at, ends))


class PieceEncoder:
    """Ids of pieces by the tokenizers library; what was encoded of late is kept, in ``most`` bytes.

    ``words`` is read from the tokenizer's own description: white space dropped and word ends marked
    (such as word_bpe_49k), or plain byte-level rules (such as byte_bpe_50k). Other tokenizers get
    whole texts.
    """

    def __init__(self, path: str, most: int = 32 << 20) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        before, model, added = told.get("pre_tokenizer") or {}, told["model"], told.get("added_tokens") or []
        steps = [x["type"] for x in before.get("pretokenizers", [])]
        tame = all(not a["lstrip"] and not a["rstrip"] and not a["single_word"] and a["content"].startswith("<|") for a in added)
        self.suffix = model.get("end_of_word_suffix") or ""
        self.words = bool(tame and self.suffix and steps == ["Split", "ByteLevel"])
        self.cuts = self.words or bool(tame and before.get("type") == "ByteLevel" and before.get("use_regex") and not told.get("normalizer"))
        self.ends = np.zeros(max(self.tokenizer.get_vocab_size(), 1), bool)
        if self.suffix:
            self.ends[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith(self.suffix)]] = True
        # two generations: what the younger one does not meet again goes with the older one
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.held, self.most = 0, most

    def _alone(self, pieces: list[bytes]) -> list[bytes]:
        got = self.tokenizer.encode_batch_fast([p.decode("utf-8", "replace") for p in pieces], add_special_tokens=False)
        return [np.asarray(e.ids, np.uint32).tobytes() for e in got]

    def _together(self, pieces: list[bytes], most: int = 2048) -> list[bytes]:
        """Plain words in one text: each gives ids up to one that ends a word."""
        out: list[bytes] = []
        for a in range(0, len(pieces), most):
            part = pieces[a : a + most]
            ids = np.asarray(self.tokenizer.encode(b" ".join(part).decode("utf-8"), add_special_tokens=False).ids, np.uint32)
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) != len(part) or len(ids) != stops[-1]:
                out += self._alone(part)
            else:
                whole, begin = ids.tobytes(), 0
                for stop in (stops * 4).tolist():
                    out.append(whole[begin:stop])
                    begin = stop
        return out

    def learn(self, pieces: Pieces) -> list[bytes]:
        """The ids of each distinct piece, as little-endian unsigned 32-bit integers."""
        known, older = self.known, self.older
        fresh = {p: older[p] for p in pieces.distinct if p not in known and p in older}
        new = [k for k, p in enumerate(pieces.distinct) if p not in known and p not in fresh]
        easy = [pieces.distinct[k] for k in new if pieces.plain[k] and pieces.distinct[k].strip()] if self.words else []
        hard = [pieces.distinct[k] for k in new if not pieces.plain[k] or not pieces.distinct[k].strip()] if self.words else [pieces.distinct[k] for k in new]
        if easy:
            fresh.update(zip(easy, self._together([p.strip() for p in easy])))
        if hard:
            fresh.update(zip(hard, self._alone(hard)))
        out = [fresh[p] if p in fresh else known[p] for p in pieces.distinct]
        for p, ids in fresh.items():
            size = len(p) + len(ids) + ENTRY
            if 2 * (self.held + size) > self.most:
                self.older, self.known, self.held = self.known, {}, 0
            if 2 * size <= self.most:
                self.known[p] = ids
                self.held += size
        return out

    def pieces(self, raw: pa.Array) -> Pieces:
        if self.cuts:
            return cut(raw, self.words)
        coded = raw.cast(pa.large_binary()).dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        return Pieces(distinct, np.zeros(len(distinct), bool), coded.indices.to_numpy(zero_copy_only=False), np.arange(len(raw) + 1))

    def encode(self, raw: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in a row, and where each text's ids begin (one bound more than texts)."""
        pieces = self.pieces(raw)
        if not len(pieces.index):
            return np.zeros(0, np.uint32), np.zeros(len(raw) + 1, np.int64)
        coded = self.learn(pieces)
        flat = np.frombuffer(b"".join(coded), np.uint32)
        lengths = np.fromiter(map(len, coded), np.int64, len(coded)) // 4
        where = np.cumsum(lengths) - lengths
        each = lengths[pieces.index]
        stops = np.concatenate([[0], np.cumsum(each)])
        ids = flat[np.repeat(where[pieces.index] - stops[:-1], each) + np.arange(stops[-1])]
        return ids, stops[pieces.bounds]

    def counts(self, raw: pa.Array) -> np.ndarray:
        """Number of ids of each text."""
        pieces = self.pieces(raw)
        if not len(pieces.index):
            return np.zeros(len(raw), np.int64)
        lengths = np.fromiter(map(len, self.learn(pieces)), np.int64, len(pieces.distinct)) // 4
        return np.diff(np.concatenate([[0], np.cumsum(lengths[pieces.index])])[pieces.bounds])


@lru_cache(maxsize=4)
def encoder(path: str) -> PieceEncoder:
    """One encoder for each worker process and tokenizer file."""
    _made.append(PieceEncoder(path))
    return _made[-1]


_made: list[PieceEncoder] = []


def forget() -> None:
    """Drop the ids that encoders of this process remember; the tokenizers stay."""
    for e in _made:
        e.known, e.older, e.held = {}, {}, 0
