"""BPE encoding and decoding with a segment tree over adjacent pairs.

The leaves of the tree are the ranks of the pairs at each place of a word (no rank: infinite); a node
holds the lesser of its children, ties to the left, so the root gives the leftmost pair of lowest rank. A
merge changes at most three leaves, and each change climbs the tree once. The loop ends when the root is
infinite.

Distinct words of a batch are encoded side by side: one row of a matrix for each word, trees of the same
size together, and every step does one merge in each word that still has one. Words above ``WIDE`` bytes
get a tree of their own, at a logarithmic cost for each merge.

The text rules (composition, white space, lower case, word pattern, byte alphabet) are those of the
tokenizer file; ``Bpe`` refuses a file with other rules rather than encode it wrongly.

Defined cases: null texts count as empty and give no ids; repeated rows give repeated results; a null
doc_id stays null; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from kymora.llm.chunks import Pieces, cut
from kymora.llm.common import batch_of, slices, texts, tidy

NONE = np.int64(1) << 60
WIDE = 64
UNICODE_SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def byte_alphabet() -> list[str]:
    """The character that stands for each byte: itself where printable, else one from U+0100 on."""
    out, more = [], 0
    for b in range(256):
        if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF:
            out.append(chr(b))
        else:
            out.append(chr(0x100 + more))
            more += 1
    return out


class Bpe:
    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        model = told["model"]
        kinds = [x["type"] for x in (told.get("normalizer") or {}).get("normalizers", [])]
        steps = (told.get("pre_tokenizer") or {}).get("pretokenizers", [])
        if kinds != ["NFC", "Replace", "Lowercase"] or [x["type"] for x in steps] != ["Split", "ByteLevel"] or steps[0]["behavior"] != "Removed" or not steps[0]["invert"] or told.get("decoder") or model.get("dropout") or model.get("ignore_merges") or model.get("byte_fallback") or not model.get("end_of_word_suffix"):
            raise ValueError("these tokenizer rules are not supported")
        self.vocab: dict[str, int] = model["vocab"]
        self.special = {a["content"]: a["id"] for a in told["added_tokens"]}
        self.tokens = [""] * (max([*self.vocab.values(), *self.special.values()]) + 1)
        for t, i in [*self.vocab.items(), *self.special.items()]:
            self.tokens[i] = t
        self.pattern = regex.compile(steps[0]["pattern"]["Regex"])
        self.space = regex.compile(f"[{UNICODE_SPACE}]+")
        self.cut_special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        alphabet, suffix = byte_alphabet(), model["end_of_word_suffix"]
        self.inner = np.array([self.vocab[c] for c in alphabet], np.int64)
        self.last = np.array([self.vocab[c + suffix] for c in alphabet], np.int64)
        self.size = len(self.tokens)
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left = np.array([self.vocab[a] for a, _ in merges], np.int64)
        right = np.array([self.vocab[b] for _, b in merges], np.int64)
        keys = left * self.size + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.made = np.array([self.vocab[a + b] for a, b in merges], np.int64)
        self.pairs = dict(zip(keys.tolist(), range(len(merges))))

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, NONE where there is no merge."""
        want = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
        return np.where(self.keys[at] == want, self.ranks[at], NONE)

    def merge_many(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of words of at most ``WIDE`` bytes, all of them at once."""
        out: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(words)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        low = 0
        for width in (4, 8, 16, 32, WIDE):
            of = np.flatnonzero((lengths > low) & (lengths <= width))
            low = width
            for a in range(0, len(of), 1 << 15):
                self._merge_block([words[i] for i in of[a : a + (1 << 15)].tolist()], of[a : a + (1 << 15)], width, out)
        return out

    def _merge_block(self, words: list[bytes], of: np.ndarray, width: int, out: list) -> None:
        n = len(words)
        if not n:
            return
        size = np.fromiter(map(len, words), np.int64, n)
        raw = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(n, width)
        sym = self.inner[raw]
        sym[np.arange(n), size - 1] = self.last[raw[np.arange(n), size - 1]]
        live = np.arange(width) < size[:, None]
        after = np.broadcast_to(np.arange(1, width + 1), (n, width)).copy()  # place of the next symbol
        before = np.broadcast_to(np.arange(-1, width - 1), (n, width)).copy()
        tree = np.full((n, 2 * width), NONE, np.int64)  # a key is rank * width + place
        pair = self.rank(sym[:, :-1], sym[:, 1:])
        usable = live[:, 1:] & (pair < NONE)
        tree[:, width : 2 * width - 1] = np.where(usable, pair * width + np.arange(width - 1), NONE)
        half = width
        while half > 1:
            tree[:, half // 2 : half] = np.minimum(tree[:, half : 2 * half : 2], tree[:, half + 1 : 2 * half : 2])
            half //= 2
        rows = np.flatnonzero(tree[:, 1] < NONE)

        def set_leaf(r: np.ndarray, place: np.ndarray, key: np.ndarray) -> None:
            node = place + width
            tree[r, node] = key
            while True:
                node = node >> 1
                if not node[0]:
                    return
                tree[r, node] = np.minimum(tree[r, 2 * node], tree[r, 2 * node + 1])

        while len(rows):
            best = tree[rows, 1]
            place, rank = best % width, best // width
            gone = after[rows, place]
            sym[rows, place] = self.made[rank]
            live[rows, gone] = False
            nxt = after[rows, gone]
            after[rows, place] = nxt
            inside = nxt < size[rows]
            before[rows[inside], nxt[inside]] = place[inside]
            # the pair that began at the symbol that went, the one that begins here, the one before
            set_leaf(rows, gone, np.full(len(rows), NONE))
            here = np.full(len(rows), NONE)
            got = self.rank(sym[rows[inside], place[inside]], sym[rows[inside], nxt[inside]])
            here[inside] = np.where(got < NONE, got * width + place[inside], NONE)
            set_leaf(rows, place, here)
            prev = before[rows, place]
            has = prev >= 0
            if has.any():
                r, p = rows[has], prev[has]
                got = self.rank(sym[r, p], sym[r, place[has]])
                set_leaf(r, p, np.where(got < NONE, got * width + p, NONE))
            rows = rows[tree[rows, 1] < NONE]
        flat = sym[live].astype(np.uint32)
        stops = np.cumsum(live.sum(axis=1)).tolist()
        begin = 0
        for i, stop in zip(of.tolist(), stops):
            out[i] = flat[begin:stop]
            begin = stop

    def merge_long(self, word: bytes) -> np.ndarray:
        """Ids of one word of any length, by a tree of its own."""
        raw = np.frombuffer(word, np.uint8)
        n = len(raw)
        symbols = self.inner[raw]
        symbols[-1] = self.last[raw[-1]]
        width = 1 << max(1, (n - 1).bit_length())
        leaves = np.full(width, NONE, np.int64)
        pair = self.rank(symbols[:-1], symbols[1:])
        leaves[: n - 1] = np.where(pair < NONE, pair * width + np.arange(n - 1), NONE)
        levels = [leaves]
        while len(levels[-1]) > 1:
            levels.append(np.minimum(levels[-1][::2], levels[-1][1::2]))
        tree = [int(NONE)] + [x for level in reversed(levels) for x in level.tolist()]
        none, sym = int(NONE), symbols.tolist()
        after, before, live = list(range(1, n + 1)), list(range(-1, n - 1)), bytearray(b"\1" * n)

        def set_leaf(place: int, key: int) -> None:
            node = place + width
            tree[node] = key
            node >>= 1
            while node:
                least = min(tree[2 * node], tree[2 * node + 1])
                if tree[node] == least:
                    return
                tree[node] = least
                node >>= 1

        while tree[1] < none:
            rank, place = divmod(tree[1], width)
            gone = after[place]
            sym[place] = int(self.made[rank])
            live[gone] = 0
            nxt = after[gone]
            after[place] = nxt
            set_leaf(gone, none)
            key = none
            if nxt < n:
                before[nxt] = place
                r = self.pairs.get(sym[place] * self.size + sym[nxt])
                key = none if r is None else r * width + place
            set_leaf(place, key)
            prev = before[place]
            if prev >= 0:
                r = self.pairs.get(sym[prev] * self.size + sym[place])
                set_leaf(prev, none if r is None else r * width + prev)
        return np.array([s for s, on in zip(sym, live) if on], np.uint32)

    def words_of(self, chunk: str) -> list[bytes | int]:
        """The words of any text, and special tokens as their ids."""
        out: list[bytes | int] = []
        for part in self.cut_special.split(chunk) if self.cut_special else [chunk]:
            if part in self.special:
                out.append(self.special[part])
            elif part:
                text = self.space.sub(" ", unicodedata.normalize("NFC", part))
                # each character on its own, so a capital sigma is never a final one
                out += [w.encode() for w in self.pattern.findall(text.replace("Σ", "σ").lower())]
        return out

    def encode_pieces(self, pieces: Pieces) -> list[np.ndarray]:
        """Ids of each distinct piece."""
        words: list[bytes] = []
        shape: list[list[bytes | int]] = []
        for piece, plain in zip(pieces.distinct, pieces.plain.tolist()):
            if plain:
                word = piece.strip()
                parts: list[bytes | int] = [word] if word else []
            else:
                parts = self.words_of(piece.decode("utf-8", "replace"))
            shape.append(parts)
            words += [p for p in parts if not isinstance(p, int)]
        distinct = list(dict.fromkeys(words))
        short = [w for w in distinct if len(w) <= WIDE]
        known = dict(zip(short, self.merge_many(short)))
        known.update((w, self.merge_long(w)) for w in distinct if len(w) > WIDE)
        empty = np.zeros(0, np.uint32)
        return [
            known[p[0]] if len(p) == 1 and not isinstance(p[0], int)
            else np.concatenate([known[x] if not isinstance(x, int) else np.array([x], np.uint32) for x in p]) if p else empty
            for p in shape
        ]

    def encode(self, text: str) -> list[int]:
        got = self.encode_pieces(pieces := cut(pa.array([text.encode()], pa.binary()), True))
        return [int(x) for k in pieces.index.tolist() for x in got[k]]

    def decode(self, ids: list[int]) -> str:
        """Tokens joined by a space, as the file names no decoder."""
        return " ".join(self.tokens[i] for i in ids)


@lru_cache(maxsize=2)
def bpe(path: str) -> Bpe:
    return Bpe(path)


def encode_documents(docs: DataFrame, tokenizer: str, with_ids: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every whole text, and its ids with ``with_ids``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
        schema = pa.schema(fields + ([("ids", pa.list_(pa.int32()))] if with_ids else []))
        model = bpe(tokenizer)
        names = [t.encode() for t in model.tokens]
        digits = [b"%d" % i for i in range(len(names))]
        for batch in slices(batches, "raw", 4 << 20):
            pieces = cut(batch.column("raw"), True)
            got = model.encode_pieces(pieces)
            size = np.fromiter(map(len, got), np.int64, len(got))
            lists = [g.tolist() for g in got]
            as_ids = [b" ".join([digits[i] for i in x]) for x in lists]
            as_text = [b" ".join([names[i] for i in x]) for x in lists]
            index = pieces.index[size[pieces.index] > 0] if len(size) else pieces.index
            full = np.concatenate([[0], np.cumsum(size[pieces.index] > 0)])[pieces.bounds] if len(size) else pieces.bounds
            order = index.tolist()
            out: dict = {"doc_id": batch.column("doc_id"), "n_tokens": np.diff(np.concatenate([[0], np.cumsum(size[pieces.index])])[pieces.bounds]) if len(size) else np.zeros(len(batch), np.int64), "ids_sha256": [], "decoded_sha256": []}
            for a, b in zip(full[:-1].tolist(), full[1:].tolist()):
                own = order[a:b]
                out["ids_sha256"].append(hashlib.sha256(b" ".join([as_ids[k] for k in own])).hexdigest())
                out["decoded_sha256"].append(hashlib.sha256(b" ".join([as_text[k] for k in own])).hexdigest())
            if with_ids:
                out["ids"] = [[i for k in order[a:b] for i in lists[k]] for a, b in zip(full[:-1].tolist(), full[1:].tolist())]
            yield batch_of(out, schema)

    more = ", ids array<int>" if with_ids else ""
    return texts(docs).mapInArrow(tidy(run), f"doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string{more}")
