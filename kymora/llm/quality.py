"""Repetition rules from a suffix array over the words of each text.

All texts of a slice share one suffix array (``suffixes``). The longest repeat that begins at a word is the
greater of the prefixes shared with its two neighbours in it, which are the values of the LCP intervals that
hold it; the union of these spans is what the maximal repeats cover.

Verdict: a text is kept if the base rules hold (at least 20 words; words in 8-word windows found twice
at most 30 % of all), repeats of ``min_repeat`` words or more cover at most ``max_covered`` of its words,
and the longest repeat has at most ``max_longest`` words, or ``max_longest_share`` of all if that is more.

Defined cases: null and empty texts have no words and are not kept; repeated rows give repeated results; a
null doc_id stays null; other columns are ignored; an empty table gives no rows. A text is held in one task, with
some 150 bytes a word however it repeats itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame

from kymora.llm import suffixes
from kymora.llm.common import batch_of, place_of, plain, slices, texts, tidy
from kymora.llm.words import IS_SPACE, Words, per_text, raw_bytes, split_words

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
WINDOW, MIN_WORDS, MAX_REPEATED = 8, 20, 30


@dataclass(frozen=True)
class Limits:
    min_repeat: int = 5
    max_covered: float = 0.4
    max_longest: int = 200
    max_longest_share: float = 0.2


def longest_repeats(words: Words) -> np.ndarray:
    """For each word, the length of the longest run of words from it that occurs again in its text."""
    n = len(words.index)
    if not n:
        return np.zeros(0, np.int64)
    text = words.text
    stop = words.bounds[1:][text]  # first word after the text
    symbol, count = suffixes.symbols(words.index, text)
    suffix = suffixes.suffix_order(symbol, count, stop)
    shared = suffixes.shared_prefixes(symbol, suffix, stop)
    longest = np.zeros(n, np.int64)
    longest[suffix] = shared
    longest[suffix[:-1]] = np.maximum(longest[suffix[:-1]], shared[1:])
    return longest


def covered(longest: np.ndarray, least: int) -> np.ndarray:
    """Words inside a repeat of at least ``least`` words."""
    n = len(longest)
    edge = np.zeros(n + 1, np.int64)
    at = np.flatnonzero(longest >= least)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + longest[at], -1)
    return np.cumsum(edge[:-1]) > 0


def repeated_lines(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Lines with a word that equal an earlier line of the same text, for each text."""
    n_texts = len(bounds) - 1
    if not len(data):
        return np.zeros(n_texts, np.int64)
    feed = data == 0x0A
    kept = data[~feed]
    place = np.concatenate([[0], np.cumsum(~feed)])
    begin = np.zeros(len(data) + 1, bool)
    begin[bounds[:-1]] = True
    begin[1:] |= feed
    at = np.flatnonzero(begin[:-1])
    offsets = np.append(place[at], len(kept)).astype(np.int64)
    lines = pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(kept)]).dictionary_encode().indices.to_numpy(zero_copy_only=False)
    filled = np.logical_or.reduceat(~IS_SPACE[data], at)
    text = (np.searchsorted(bounds, at, side="right") - 1)[filled]
    _, first = np.unique(text * (int(lines.max()) + 1) + lines[filled], return_index=True)
    return np.bincount(text, minlength=n_texts) - np.bincount(text[first], minlength=n_texts)


def judge(raw: pa.Array, limits: Limits) -> dict[str, np.ndarray]:
    """What ``quality`` returns of each text, without its doc_id."""
    data, bounds = raw_bytes(raw)
    words = split_words(raw)
    n = words.counts
    longest = longest_repeats(words)
    in_window = per_text(covered(longest, WINDOW), words.bounds)
    share = per_text(covered(longest, limits.min_repeat), words.bounds) / np.maximum(n, 1)
    top = np.zeros(len(n), np.int64)
    if len(longest):
        top[n > 0] = np.maximum.reduceat(longest, words.bounds[:-1][n > 0])
    failed = (n < MIN_WORDS) | (100 * in_window > MAX_REPEATED * n)
    kept = ~failed & (share <= limits.max_covered) & (top <= np.maximum(limits.max_longest, limits.max_longest_share * n))
    chars = per_text(~IS_SPACE[data] & ((data & 0xC0) != 0x80), bounds)
    return {
        "n_words": n, "word_chars": chars, "n_symbols": per_text(SYMBOLS[data], bounds), "n_dup_lines": repeated_lines(data, bounds),
        "n_repeat_words": in_window, "covered": share, "longest_repeat": top, "base_failed": failed, "kept": kept,
    }


def quality(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, covered, longest_repeat, base_failed, kept).

    ``covered`` is the fraction of words in maximal repeats of ``limits.min_repeat`` words or more.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        longs = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
        schema = pa.schema([("doc_id", pa.int64()), *[(c, pa.int64()) for c in longs], ("covered", pa.float64()), ("longest_repeat", pa.int64()), ("base_failed", pa.bool_()), ("kept", pa.bool_())])
        for batch in slices(batches, "raw", 4 << 20):
            yield batch_of({"doc_id": batch.column("doc_id"), **judge(batch.column("raw"), limits)}, schema)

    return texts(docs).mapInArrow(tidy(run), "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, covered double, longest_repeat long, base_failed boolean, kept boolean")


def keep_good(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns; rows never leave their task."""
    named, names = plain(docs)
    t = place_of(names, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, t, 4 << 20):
            raw = pa.compute.fill_null(batch.column(t).cast(pa.large_binary()), b"")
            yield batch.filter(pa.array(judge(raw, limits)["kept"]))

    return named.mapInArrow(tidy(run), named.schema).toDF(*names)
