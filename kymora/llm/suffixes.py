"""Suffix order and common prefixes of the words of many texts at once, in memory linear in the words.

A word's symbol is its (text, word) pair, so suffixes of different texts never compare equal, and a suffix
that ends sorts before one that goes on. Ranks are doubled in place, for suffixes that still tie only.
Common prefixes follow the texts: where the words before a suffix and before its predecessor in the order
agree, the prefix is one shorter than that of the suffix before; only the others are compared word by
word, and their prefixes sum to n log n at most. About 150 bytes a word are held at a time.
"""

from __future__ import annotations

import numpy as np

COMPARED = 1 << 16  # words compared at once


def symbols(index: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The symbol of each word and how often each symbol occurs."""
    _, symbol, count = np.unique(text * (int(index.max()) + 1) + index, return_inverse=True, return_counts=True)
    return symbol.astype(np.int64), count


def suffix_order(symbol: np.ndarray, count: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """The suffixes' first words in suffix order; ``stop`` is the first word after each word's text."""
    n = len(symbol)
    rank = (np.cumsum(count) - count)[symbol]  # place of the suffix's group in the order
    active = np.flatnonzero(count[symbol] > 1)
    step = 1
    while len(active):
        nxt = active + step
        second = np.where(nxt < stop[active], rank[np.minimum(nxt, n - 1)] + 1, 0)
        key = rank[active] * (n + 1) + second
        order = np.argsort(key, kind="stable")
        key, moved = key[order], active[order]
        old = rank[moved]
        group, sub = np.ones(len(key), bool), np.ones(len(key), bool)
        group[1:] = old[1:] != old[:-1]
        sub[1:] = key[1:] != key[:-1]
        at = np.arange(len(key))
        rank[moved] = old + np.maximum.accumulate(np.where(sub, at, 0)) - np.maximum.accumulate(np.where(group, at, 0))
        size = np.diff(np.append(np.flatnonzero(sub), len(key)))
        active = np.sort(moved[np.repeat(size > 1, size)])
        step *= 2
    suffix = np.empty(n, np.int64)
    suffix[rank] = np.arange(n)
    return suffix


def common(symbol: np.ndarray, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """How many words from ``a`` and from ``b`` on agree, up to ``most`` of each pair."""
    got = np.zeros(len(a), np.int64)
    last = len(symbol) - 1
    for begin in range(0, len(a), COMPARED // 2):
        live = np.arange(begin, min(begin + COMPARED // 2, len(a)))
        live = live[most[live] > 0]
        while len(live):
            ahead = np.arange(max(COMPARED // len(live), 1))
            x, y = a[live] + got[live], b[live] + got[live]
            same = symbol[np.minimum(x[:, None] + ahead, last)] == symbol[np.minimum(y[:, None] + ahead, last)]
            same &= ahead < (most[live] - got[live])[:, None]
            whole = same.all(1)
            got[live] += np.where(whole, len(ahead), np.argmin(same, 1))
            live = live[whole & (got[live] < most[live])]
    return got


def shared_prefixes(symbol: np.ndarray, suffix: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """The words that each suffix shares with the one before it in the order; 0 for the first."""
    n = len(symbol)
    before = np.empty(n, np.int64)  # the suffix that stands before the one at each word
    before[suffix[1:]] = suffix[:-1]
    before[suffix[0]] = suffix[0]
    here = np.arange(n)
    live = (symbol == symbol[before]) & (before != here)
    follows = np.zeros(n, bool)
    follows[1:] = live[1:] & (before[1:] > 0) & (symbol[:-1] == symbol[before[1:] - 1])
    value = np.zeros(n, np.int64)
    fresh = np.flatnonzero(live & ~follows)
    value[fresh] = common(symbol, fresh, before[fresh], stop[fresh] - np.maximum(fresh, before[fresh]))
    origin = np.maximum.accumulate(np.where(follows, 0, here))
    return (value[origin] - (here - origin))[suffix]
