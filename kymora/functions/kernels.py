"""NumPy helpers that run inside Arrow tasks on one frame, one cycle or one block at a time."""

from __future__ import annotations

import numpy as np


def local_maxima(x: np.ndarray) -> np.ndarray:
    """Indices of strict local maxima; a plateau is represented by its middle sample."""
    n = len(x)
    if n < 3:
        return np.empty(0, dtype=np.int64)
    change = np.flatnonzero(x[1:] != x[:-1]) + 1
    first = np.concatenate(([0], change))
    last = np.concatenate((change - 1, [n - 1]))
    v = x[first]
    top = np.zeros(len(v), dtype=bool)
    top[1:-1] = (v[1:-1] > v[:-2]) & (v[1:-1] > v[2:])
    return (first[top] + last[top]) // 2


KEEP, DROP, OPEN, WAITING = 1, 0, -1, -2


def thin_by_distance(
    pos: np.ndarray, val: np.ndarray, distance: int, seen_from: float, seen_to: float, known: np.ndarray | None = None
) -> np.ndarray:
    """Three-valued verdict per peak of the highest-first spacing rule.

    A peak goes when a kept higher peak lies closer than ``distance``. Where the reach of a peak leaves
    the visible span [seen_from, seen_to], or depends on a neighbour that is itself open, it stays open.
    ``known`` gives peaks whose verdict is settled; the others wait.
    """
    verdict = np.full(len(pos), WAITING, dtype=np.int8) if known is None else known.astype(np.int8)
    shadow = np.zeros(len(pos), dtype=bool)
    low = np.searchsorted(pos, pos - distance, side="right")
    high = np.searchsorted(pos, pos + distance, side="left")
    cut_off = (pos - distance + 1 < seen_from) | (pos + distance - 1 > seen_to)
    for k in np.flatnonzero(verdict == KEEP):
        near = verdict[low[k] : high[k]]
        near[near == WAITING] = DROP
    for k in np.lexsort((pos, val))[::-1]:
        if verdict[k] != WAITING:
            continue
        reach = slice(low[k], high[k])
        if cut_off[k] or shadow[k]:
            verdict[k] = OPEN
            shadow[reach] = True
        else:
            near = verdict[reach]
            near[near == WAITING] = DROP
            verdict[k] = KEEP
    return verdict


def _side_verdict(side: np.ndarray, top: float, need: float, known: bool) -> int:
    """Walk away from a peak in growing steps until it is deep enough, overtopped, or out of view."""
    low, a, size = top, 0, 32
    while a < len(side):
        part = side[a : a + size]
        over = np.flatnonzero(part > top)
        seen = part[: over[0]] if len(over) else part
        if len(seen):
            low = min(low, seen.min())
        if top - low >= need:
            return KEEP
        if len(over):
            return DROP
        a, size = a + size, size * 4
    return DROP if known else OPEN


def reaches_prominence(
    pos: np.ndarray, val: np.ndarray, peaks: np.ndarray, need: float, left_known: bool, right_known: bool
) -> np.ndarray:
    """Three-valued test that each peak (row number in the extrema list) stands out by ``need``.

    ``pos``/``val`` list extrema and series ends. On each side the lowest value before a higher one
    counts; the search stops as soon as it is low enough.
    """
    out = np.empty(len(peaks), dtype=np.int8)
    for a, p in enumerate(peaks):
        left = _side_verdict(val[:p][::-1], val[p], need, left_known)
        right = DROP if left == DROP else _side_verdict(val[p + 1 :], val[p], need, right_known)
        out[a] = DROP if right == DROP else OPEN if OPEN in (left, right) else KEEP
    return out


def find_peaks(
    x: np.ndarray, height: float | None = None, distance: int | None = None, prominence: float | None = None
) -> np.ndarray:
    """Peaks of a complete short series: height, then spacing, then prominence."""
    tops = local_maxima(x)
    if height is not None:
        tops = tops[x[tops] >= height]
    if distance is not None and distance > 1 and len(tops):
        tops = tops[thin_by_distance(tops, x[tops], int(distance), -np.inf, np.inf) == KEEP]
    if prominence is not None and len(tops):
        tops = tops[reaches_prominence(np.arange(len(x)), x, tops, prominence, True, True) == KEEP]
    return tops


def hann(n: int) -> np.ndarray:
    """Periodic Hann window."""
    return 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(n) / n)


def hamming(n: int) -> np.ndarray:
    return 0.54 - 0.46 * np.cos(2 * np.pi * np.arange(n) / n)


def welch_rows(x: np.ndarray, fs: float, nperseg: int, noverlap: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Averaged one-sided power spectral density of mean-removed Hann segments, of each row."""
    nperseg = min(nperseg, x.shape[1])
    noverlap = nperseg // 2 if noverlap is None else noverlap
    w = hann(nperseg)
    starts = range(0, x.shape[1] - nperseg + 1, nperseg - noverlap)
    total = np.zeros((len(x), nperseg // 2 + 1))
    for a in starts:
        seg = x[:, a : a + nperseg]
        total += np.abs(np.fft.rfft((seg - seg.mean(axis=1, keepdims=True)) * w, axis=1)) ** 2
    p = total / len(starts) / (fs * (w * w).sum())
    p[:, 1 : (-1 if nperseg % 2 == 0 else None)] *= 2
    return np.fft.rfftfreq(nperseg, 1 / fs), p


def welch(x: np.ndarray, fs: float, nperseg: int, noverlap: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    freqs, p = welch_rows(np.asarray(x, dtype=float)[None], fs, nperseg, noverlap)
    return freqs, p[0]


def peak_to_median_rows(freqs: np.ndarray, psd: np.ndarray, above_hz: float = 5.0) -> tuple[np.ndarray, np.ndarray]:
    """(peak power over median power, peak frequency) above ``above_hz`` of each row; (0, nan) where undefined."""
    use = freqs > above_hz
    ratio, hz = np.zeros(len(psd)), np.full(len(psd), np.nan)
    if use.any() and len(psd):
        p = psd[:, use]
        mid = np.median(p, axis=1)
        ok = mid > 0
        at = np.argmax(p, axis=1)
        ratio[ok] = p[ok, at[ok]] / mid[ok]
        hz[ok] = freqs[use][at[ok]]
    return ratio, hz


def peak_to_median(freqs: np.ndarray, psd: np.ndarray, above_hz: float = 5.0) -> tuple[float, float]:
    ratio, hz = peak_to_median_rows(freqs, psd[None], above_hz)
    return float(ratio[0]), float(hz[0])


def band_fraction(freqs: np.ndarray, psd: np.ndarray, lo: float, hi: float) -> float:
    """Trapezoid power inside [lo, hi] over all power."""
    use = (freqs >= lo) & (freqs <= hi)
    total = np.trapezoid(psd, freqs)
    if not use.any() or not total > 0:
        return 0.0
    return float(np.trapezoid(psd[use], freqs[use]) / total)


def bandpower_ratio(x: np.ndarray, fs: float, target_hz: float, rel_width: float) -> float:
    if len(x) < 4 or not np.isfinite(target_hz) or target_hz <= 0:
        return 0.0
    centred = x - x.mean()
    f, p = welch(centred, fs, min(len(centred), max(int(fs * 8.0), 256)))
    return band_fraction(f, p, max(0.0, target_hz * (1 - rel_width)), target_hz * (1 + rel_width))


def stft_db_rows(x: np.ndarray) -> np.ndarray:
    """Decibel magnitude spectrum of one Hann frame a row, scaled by the window sum."""
    w = hann(x.shape[1])
    return 20 * np.log10(np.abs(np.fft.rfft(x * w, axis=1)) / w.sum() + 1e-12)


def band_energy_rows(x: np.ndarray, fs: float, lo: float, hi: float) -> np.ndarray:
    """Power spectrum summed over [lo, hi] of one mean-removed Hamming frame a row (all bins if none fall in)."""
    n = x.shape[1]
    w = hamming(n)
    p = np.abs(np.fft.rfft((x - x.mean(axis=1, keepdims=True)) * w, axis=1)) ** 2 / w.sum() ** 2
    p[:, 1 : (-1 if n % 2 == 0 else None)] *= 2
    f = np.fft.rfftfreq(n, 1 / fs)
    use = (f >= lo) & (f <= hi)
    return p[:, use].sum(axis=1) if use.any() else p.sum(axis=1)


def spectral_features(x: np.ndarray) -> tuple[float, float, float]:
    """(centroid in bins, standard deviation of magnitudes, energy) of the real spectrum."""
    mag = np.abs(np.fft.rfft(x))
    centroid = (np.arange(len(mag)) * mag).sum() / (mag.sum() + 1e-10)
    return float(centroid), float(mag.std()), float((mag * mag).sum())


def butterworth_power(freqs: np.ndarray, fs: float, low: float, high: float, order: int) -> np.ndarray:
    """Squared magnitude of a digital Butterworth band-pass (bilinear transform, pre-warped edges)."""
    warp = lambda f: np.tan(np.pi * np.minimum(f, fs / 2 * (1 - 1e-9)) / fs)
    w, wl, wh = warp(freqs), warp(np.asarray(low)), warp(np.asarray(high))
    with np.errstate(divide="ignore", over="ignore"):
        s = (w * w - wl * wh) / (w * (wh - wl))
        return 1.0 / (1.0 + s ** (2 * order))


def analytic_taps(fs: float, low: float, high: float, order: int, seconds: float) -> np.ndarray:
    """Complex FIR: the squared Butterworth band-pass as real part, its quadrature as imaginary part.

    Positive frequencies alone, sampled at sixteen times the length, brought back to ``seconds`` to either side
    under a cosine that falls over the outer half.
    """
    half = max(int(fs * seconds), 1)
    n = 1 << int(np.ceil(np.log2(16 * (2 * half + 1))))
    gain = np.zeros(n)
    f = np.arange(1, n // 2) * fs / n
    gain[1 : n // 2] = 2 * butterworth_power(f, fs, low, min(high, fs / 2 * 0.999), order)
    taps = np.fft.ifft(gain)[np.arange(-half, half + 1)]
    far = np.clip((np.abs(np.arange(-half, half + 1)) - half / 2) / (half / 2 + 1), 0, 1)
    return taps * (0.5 + 0.5 * np.cos(np.pi * far))


def odd_extend(x: np.ndarray, pad: int) -> np.ndarray:
    """``pad`` samples mirrored through the first; zeros beyond the length of the series."""
    m = min(pad, len(x) - 1)
    return np.concatenate((np.zeros(pad - m), 2 * x[0] - x[m:0:-1], x))


def turn_rate(x: np.ndarray, taps: np.ndarray, fs: float, first: bool, last: bool) -> np.ndarray:
    """Hz per sample of a block with its halo; ``first`` and ``last`` tell where the series itself ends."""
    half = len(taps) // 2
    if np.isnan(x).any():
        return np.full(len(x), np.nan)
    y = odd_extend(x, half) if first else x
    y = odd_extend(y[::-1], half)[::-1] if last else y
    size = 1 << int(np.ceil(np.log2(len(y) + len(taps))))
    z = np.fft.ifft(np.fft.fft(y, size) * np.fft.fft(taps, size))[half : half + len(y)]
    z = z[half:] if first else z
    z = z[: len(x)]
    turn = np.angle(z[1:] * np.conj(z[:-1]))
    if not len(turn):
        return np.zeros(len(x))
    rate = np.empty(len(x))
    rate[0], rate[-1] = turn[0], turn[-1]
    rate[1:-1] = (turn[1:] + turn[:-1]) / 2
    return rate * fs / (2 * np.pi)


def savgol(x: np.ndarray, window: int, poly: int) -> np.ndarray:
    """Least-squares polynomial smoothing; the ends use the polynomial fitted to the edge window."""
    h = window // 2
    k = np.arange(-h, h + 1)
    basis = np.vander(k, poly + 1, increasing=True)
    fit = np.linalg.pinv(basis)
    if len(x) < window:
        return x.astype(float)
    out = np.convolve(x, fit[0][::-1], mode="same")
    out[:h] = basis[:h] @ (fit @ x[:window])
    out[-h:] = basis[h + 1 :] @ (fit @ x[-window:])
    return out


def decimation_taps(factor: int) -> np.ndarray:
    """Low-pass FIR for keeping every ``factor``-th sample: Kaiser (beta 5), half length 10 * factor."""
    half = 10 * factor
    k = np.arange(-half, half + 1)
    taps = np.sinc(k / factor) / factor * np.kaiser(2 * half + 1, 5.0)
    return taps / taps.sum()


def znorm_rows(x: np.ndarray) -> np.ndarray:
    """Each row centred and scaled; a constant row is zero."""
    spread = x.std(axis=1, keepdims=True)
    varies = x.max(axis=1, keepdims=True) > x.min(axis=1, keepdims=True)
    return np.divide(x - x.mean(axis=1, keepdims=True), spread, out=np.zeros_like(x), where=varies & (spread > 0))


def warped_bound(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """What the warped distance of each pair of rows is at least.

    Every point is matched with some point of the other row, so it costs what it lies outside the other's
    range; first meets first and last meets last.
    """
    outside = lambda x, y: (np.maximum(x - y.max(axis=1, keepdims=True), 0) + np.maximum(y.min(axis=1, keepdims=True) - x, 0)).sum(axis=1)
    ends = np.abs(a[:, 0] - b[:, 0]) + (np.abs(a[:, -1] - b[:, -1]) if max(a.shape[1], b.shape[1]) > 1 else 0)
    return np.maximum(np.maximum(outside(a, b), outside(b, a)), ends) / max(a.shape[1], b.shape[1])


def warped(a: np.ndarray, b: np.ndarray, most: float = np.inf) -> np.ndarray:
    """Dynamic time warping distance of each pair of rows over the longer length; infinite where it is surely above ``most``.

    One anti-diagonal of all pairs at a time; every path crosses each diagonal or the next, so a pair whose last two
    are all above the limit is given up.
    """
    pairs, n = a.shape
    m = b.shape[1]
    out = np.full(pairs, np.inf)
    live = np.arange(pairs)
    before, last = np.full((pairs, n + 1), np.inf), np.full((pairs, n + 1), np.inf)
    before[:, 0] = 0.0
    limit = most * max(n, m) * (1 + 1e-9)
    for d in range(2, n + m + 1):
        i = np.arange(max(1, d - m), min(n, d - 1) + 1)
        cost = np.abs(a[:, i - 1] - b[:, d - i - 1])
        now = np.full_like(last, np.inf)
        now[:, i] = cost + np.minimum(np.minimum(last[:, i - 1], last[:, i]), before[:, i - 1])
        before, last = last, now
        if d % 8 == 0 and np.isfinite(limit):
            keep = np.minimum(before, last).min(axis=1) <= limit
            if not keep.all():
                live, a, b, before, last = live[keep], a[keep], b[keep], before[keep], last[keep]
    out[live] = last[:, n] / max(n, m)
    return out
