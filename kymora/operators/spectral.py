"""Frame-wise spectral jobs: native framing, one NumPy kernel per frame, native decisions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kymora.functions import kernels as kn
from kymora.operators import intervals as iv
from kymora.operators.peaks import find_peaks
from kymora.plans.blocks import BLK, BLOCK_ROWS, CORE, KEY, with_halo, with_key
from kymora.plans.grouped import _split_top, grouped_map
from kymora.session import durable


FRAME_VALUES = 1 << 20  # values of frames that a helper sees at once


def frame_map(
    samples: DataFrame, keys: Sequence[str], value: str, length: int, step: int, schema: str,
    helper: Callable[[np.ndarray], dict[str, np.ndarray]], t: str | None = "t", rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(keys, frame, ``schema``) and with ``t`` (t0, t1): what ``helper`` makes of each full frame of ``length`` samples.

    Frame f begins at sample f * ``step``. A block travels once with the samples its last frames reach into, a
    quarter of its rows at most; the frames are cut inside the task and handed over as a matrix, a
    bounded number at a time. A frame with a missing position is left out.
    """
    keys = list(keys)
    more = [F.col(t).cast("double").alias("_t")] if t else []
    spread = with_halo(samples.select(*keys, "i", F.col(value).cast("double").alias("_v"), *more), 0, length - 1, rows=rows)
    names = [part.strip().split(" ")[0] for part in _split_top(schema)]
    most = max(FRAME_VALUES // length, 1)

    def run(g: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        i, v = g["i"], g["_v"].astype(float)
        at = np.flatnonzero(g[CORE].astype(bool) & (i % step == 0))
        at = at[at + length <= len(i)]
        at = at[i[at + length - 1] - i[at] == length - 1]
        view = np.lib.stride_tricks.sliding_window_view(v, length) if len(at) else np.zeros((0, length))
        parts = [helper(view[at[k : k + most]]) for k in range(0, max(len(at), 1), most)]
        out = {n: [x for p in parts for x in p[n]] if isinstance(parts[0][n], list) else np.concatenate([p[n] for p in parts]) for n in names}
        if t:
            out |= {"t0": g["_t"][at], "t1": g["_t"][at + length - 1]}
        return {"frame": i[at] // step, **out}

    told = f"frame bigint, {schema}" + (", t0 double, t1 double" if t else "")
    return grouped_map(spread, [*keys, BLK], ["i"], ["i", "_v", CORE, *(["_t"] if t else [])], told, run).drop(BLK)


def frames(samples: DataFrame, keys: Sequence[str], value: str, length: int, step: int, t: str | None = "t", rows: int = BLOCK_ROWS) -> DataFrame:
    """Full frames only: (keys, frame, x ARRAY<DOUBLE>, t0, t1)."""
    return frame_map(samples, keys, value, length, step, "x array<double>", lambda x: {"x": list(x)}, t, rows)


def spectrum_sums(
    samples: DataFrame, keys: Sequence[str], columns: Sequence[str], fs: float, length: int, step: int, rows: int = BLOCK_ROWS
) -> DataFrame:
    """(keys, _blk, channel, p ARRAY<DOUBLE>, n): per block and column the sum of the spectra of its full frames, and their number.

    Frame f begins at sample f * ``step``; a frame with a missing position is left out, a block without frames too.
    A frame with an unknown value has no spectrum and does not count in its column.
    """
    keys, columns = list(keys), list(columns)
    spread = with_halo(samples.select(*keys, "i", *[F.col(c).cast("double").alias(c) for c in columns]), 0, length - 1, rows=rows)
    most = max(FRAME_VALUES // length, 1)

    def run(g: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        i = g["i"]
        at = np.flatnonzero(g[CORE].astype(bool) & (i % step == 0))
        at = at[at + length <= len(i)]
        at = at[i[at + length - 1] - i[at] == length - 1]
        told = columns if len(at) else []
        sums, counts = [], []
        for c in told:
            view = np.lib.stride_tricks.sliding_window_view(g[c].astype(float), length)
            total, count = np.zeros(length // 2 + 1), 0
            for k in range(0, len(at), most):
                p = kn.welch_rows(view[at[k : k + most]], fs, length)[1]
                known = ~np.isnan(p).any(axis=1)
                total, count = total + p[known].sum(axis=0), count + int(known.sum())
            sums.append(total)
            counts.append(count)
        return {"channel": list(told), "p": sums, "n": np.array(counts, np.int64)}

    return grouped_map(spread, [*keys, BLK], ["i"], ["i", CORE, *columns], "channel string, p array<double>, n bigint", run)


def _as_rows(col: pd.Series):
    return (np.asarray(v, dtype=float) for v in col)


def psd(x: Column, fs: float, nperseg: int, noverlap: int | None = None) -> Column:
    """Welch power spectral density of each array."""

    @F.pandas_udf("array<double>")
    def kernel(col: pd.Series) -> pd.Series:
        return pd.Series([kn.welch(v, fs, nperseg, noverlap)[1] for v in _as_rows(col)])

    return kernel(x)


def peaks_of_spectra(fs: float, nperseg: int, above_hz: float = 5.0) -> Callable[[np.ndarray], dict[str, np.ndarray]]:
    """For ``frame_map``: strongest PSD bin over the median bin, above ``above_hz``, and its frequency."""

    def helper(x: np.ndarray) -> dict[str, np.ndarray]:
        ratio, hz = kn.peak_to_median_rows(*kn.welch_rows(x, fs, nperseg), above_hz)
        return {"ratio": ratio, "peak_hz": hz}

    return helper


def narrowband(x: Column, fs: float, nperseg: int, above_hz: float = 5.0) -> Column:
    """STRUCT<ratio, peak_hz>: strongest PSD bin over the median bin, above ``above_hz``."""

    @F.pandas_udf("struct<ratio:double,peak_hz:double>")
    def kernel(col: pd.Series) -> pd.DataFrame:
        got = [kn.peak_to_median(*kn.welch(v, fs, nperseg), above_hz) for v in _as_rows(col)]
        return pd.DataFrame(got, columns=["ratio", "peak_hz"])

    return kernel(x)


def bandpower_ratio(x: Column, target_hz: Column, fs: float, rel_width: float) -> Column:
    @F.pandas_udf("double")
    def kernel(col: pd.Series, hz: pd.Series) -> pd.Series:
        return pd.Series([kn.bandpower_ratio(v, fs, f, rel_width) for v, f in zip(_as_rows(col), hz)])

    return kernel(x, target_hz)


def spectral_features(x: Column) -> Column:
    """STRUCT<centroid, spread, energy> of the real spectrum of each array."""

    @F.pandas_udf("struct<centroid:double,spread:double,energy:double>")
    def kernel(col: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([kn.spectral_features(v) for v in _as_rows(col)], columns=["centroid", "spread", "energy"])

    return kernel(x)


def spectrogram(
    samples: DataFrame, keys: Sequence[str], value: str, fs: float, nperseg: int = 2048, noverlap: int = 1536
) -> DataFrame:
    """Decibel spectrogram rows (keys, frame, t, db ARRAY<FLOAT>) of the mean-removed series."""
    mean = samples.groupBy(*keys).agg(F.avg(value).alias("_mean"))
    centred = samples.join(mean, list(keys)).withColumn("_y", F.col(value) - F.col("_mean"))
    f = frame_map(centred, keys, "_y", nperseg, nperseg - noverlap, "db array<float>", lambda x: {"db": list(kn.stft_db_rows(x).astype("float32"))}, None)
    t = (F.col("frame") * (nperseg - noverlap) + nperseg / 2) / F.lit(fs)
    return f.select(*keys, "frame", t.alias("t"), "db")


def psd_window(fs: float, seconds: float) -> tuple[int, int]:
    """(window samples, Welch segment samples) for narrowband search."""
    w = max(int(fs * seconds), 256)
    return w, min(w, max(int(fs * 0.5), 64))


def continuous_noise(
    samples: DataFrame, keys: Sequence[str], value: str, fs: float, window_s: float = 2.0, ratio: float = 10.0,
    min_s: float = 4.0,
) -> DataFrame:
    """Spans of at least ``min_s`` covered by frames with a narrowband peak."""
    w, nper = psd_window(fs, window_s)
    hot = frame_map(samples, keys, value, w, w // 2, "ratio double, peak_hz double", peaks_of_spectra(fs, nper)).filter(F.col("ratio") >= ratio)
    spans = hot.select(*keys, F.col("t0").alias("start"), F.col("t1").alias("end"))
    # adjacent frames meet at consecutive samples, which the mask form of the rule counts as one run
    merged = iv.merge_intervals(spans, keys, 1.5 / fs)
    return merged.filter(F.col("end") - F.col("start") >= min_s)


def periodic_flag(x: Column, fs: float, threshold: float = 0.3) -> Column:
    """Whether a whole short series has one dominating frequency (too short: no)."""
    nper = int(fs * 2)
    nb = narrowband(x, fs, nper)
    return (F.size(x) >= 256) & (nb["ratio"] > 1.0 / threshold)


def decimate(
    samples: DataFrame, keys: Sequence[str], columns: Sequence[str], factor: int, rows: int = BLOCK_ROWS
) -> DataFrame:
    """Anti-aliased keep-every-k: low-pass FIR on block plus halo, then the kept samples renumbered."""
    if factor <= 1:
        return samples
    taps = kn.decimation_taps(factor)
    half = len(taps) // 2
    rows = max(rows, factor * 1024) // factor * factor
    spread = with_halo(samples.select(*keys, "i", "t", *columns), half, half, rows=rows)

    def fir(g: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        keep = g[CORE].astype(bool) & (g["i"] % factor == 0)
        out = {"i": g["i"][keep] // factor, "t": g["t"][keep]}
        for c in columns:
            y = np.convolve(np.nan_to_num(g[c].astype(float)), taps, mode="full")[half : half + len(keep)]
            out[c] = y[keep]
        return out

    schema = "i bigint, t double, " + ", ".join(f"{c} double" for c in columns)
    return grouped_map(spread, [*keys, BLK], ["i"], ["i", "t", CORE, *columns], schema, fir).drop(BLK)


def instantaneous_frequency(
    samples: DataFrame, keys: Sequence[str], columns: Sequence[str], fs: float, low: float = 10.0, high: float = 5000.0,
    order: int = 4, halo_s: float = 1.0, rows: int | None = None,
) -> DataFrame:
    """Adds ``f_<column>`` in Hz: the turn of the band-passed analytic signal from sample to sample.

    One filter of fixed length (``kernels.analytic_taps``, ``halo_s`` to either side) gives band-pass and
    quadrature part at once, so a sample's value depends on the samples within its reach alone and is the
    same in blocks of any size. The series is centred by its own mean, unknown samples stand for the mean, and
    its ends are continued by odd reflection. A column with fewer than 4 known samples in a series is null there.
    """
    keys = list(keys)
    taps = kn.analytic_taps(fs, low, high, order, halo_s)
    half = len(taps) // 2
    rows = rows or max(8 * half, BLOCK_ROWS)
    value = {c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in columns}
    facts = samples.groupBy(*keys).agg(
        F.max("i").alias("_last"), *[F.avg(v).alias(f"_m_{c}") for c, v in value.items()], *[F.count(v).alias(f"_k_{c}") for c, v in value.items()]
    )
    facts = with_key(facts, keys).drop(*keys)
    centred = with_key(samples, keys).join(facts, KEY).select(
        *keys, "i", "_last",
        *[F.when(F.col(f"_k_{c}") >= 4, F.coalesce(v - F.col(f"_m_{c}"), F.lit(0.0))).alias(c) for c, v in value.items()],
    )
    spread = with_halo(centred, half + 1, half + 1, rows=rows)

    def kernel(g: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        core = g[CORE].astype(bool)
        at = {"first": g["i"][0] == 0, "last": g["i"][-1] == g["_last"][0]}
        out = {"i": g["i"][core]}
        for c in columns:
            out[f"f_{c}"] = kn.turn_rate(g[c].astype(float), taps, fs, **at)[core]
        return out

    schema = "i bigint, " + ", ".join(f"f_{c} double" for c in columns)
    done = grouped_map(spread, [*keys, BLK], ["i"], ["i", "_last", CORE, *columns], schema, kernel).drop(BLK)
    done = with_key(done, keys).select(KEY, "i", *[F.when(~F.isnan(f"f_{c}"), F.col(f"f_{c}")).alias(f"f_{c}") for c in columns])
    return with_key(samples, keys).join(done, [KEY, "i"]).drop(KEY).select(*samples.columns, *[f"f_{c}" for c in columns])


def savgol(samples: DataFrame, keys: Sequence[str], value: str, out: str, window: int = 51, poly: int = 3, rows: int = BLOCK_ROWS) -> DataFrame:
    """Savitzky-Golay smoothing; series no longer than the window pass through unchanged."""
    keys = list(keys)
    totals = samples.groupBy(*keys).agg(F.count(F.lit(1)).alias("_total"))
    # the edge fit needs a whole window next to the series end, so the halo is a full window
    spread = with_halo(samples.join(totals, keys), window, window, rows=rows)

    def kernel(g: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        x, core = g[value].astype(float), g[CORE].astype(bool)
        smooth = x if g["_total"][0] <= window or len(x) < window else kn.savgol(x, window, poly)
        return {"i": g["i"][core], out: smooth[core]}

    done = grouped_map(spread, [*keys, BLK], ["i"], ["i", value, CORE, "_total"], f"i bigint, {out} double", kernel).drop(BLK)
    return samples.join(done, [*keys, "i"])


def stomp_band_energy(
    signal: DataFrame, keys: Sequence[str], channels: Sequence[str], fs: float, search_s: float = 20.0,
    lo: float = 100.0, hi: float = 1000.0,
) -> DataFrame:
    """Per 0.5 s frame (0.1 s hop) of the mean absolute signal: power in the stomp band."""
    w, hop = max(int(0.5 * fs), 2), max(int(0.1 * fs), 1)
    mean_abs = sum((F.abs(F.col(c)) for c in channels[1:]), F.abs(F.col(channels[0]))) / len(channels)
    s = signal.filter(F.col("t") <= search_s).select(*keys, "i", "t", mean_abs.alias("v"))

    f = frame_map(s, keys, "v", w, hop, "energy double", lambda x: {"energy": kn.band_energy_rows(x, fs, lo, hi)}, None)
    mid = F.col("frame") * hop + w // 2
    return f.select(*keys, "frame", mid.alias("i"), "energy")


CORR_ROWS, CORR_PAIRS = 4096, 32  # samples of a block, pairs of blocks of a group


def movement_frequency(
    motion: DataFrame, keys: Sequence[str], angle: str, fs: float, max_fs: float = 50.0, first_lag_s: float = 30.0, rows: int = CORR_ROWS
) -> DataFrame:
    """Dominant movement rate (Hz) per recording from the autocorrelation of the thinned angle.

    The first lags usually hold the answer; recordings still without a peak get four times as many until their
    lags cover the whole series. A peak that stands out among fewer lags also does so among all, so the early
    answer is the final one.
    """
    keys = list(keys)
    ds = max(int(fs / max_fs), 1)
    eff = fs / ds
    low = max(int(eff * 0.5), 1)
    x = F.coalesce(F.nanvl(F.col(angle).cast("double"), F.lit(0.0)), F.lit(0.0))
    kept = F.col("i") % ds == 0
    mean = motion.groupBy(*keys).agg(F.avg(F.when(kept, x)).alias("_m"), F.count_if(kept).alias("_n"), F.count(F.lit(1)).alias("_all"))
    mean = with_key(mean.filter("_all >= 100"), keys).drop(*keys)
    thin = with_key(motion.filter(kept).select(*keys, F.floor(F.col("i") / ds).cast("long").alias("i"), x.alias("x")), keys)
    c = durable(thin.join(mean, KEY).select(*keys, "i", (F.col("x") - F.col("_m")).alias("x"), "_n"))
    lags = max(int(first_lag_s * eff), low + 2)
    acf, found, done = None, None, 0
    while True:
        more = lag_sums(c, keys, done, lags, rows)
        acf = durable(more if acf is None else acf.unionByName(more))
        zero = with_key(acf.filter("i = 0 AND s > 0").select(*keys, F.col("s").alias("_s0")), keys).drop(*keys)
        norm = with_key(acf.filter(F.col("i") >= low), keys).join(zero, KEY).select(*keys, (F.col("i") - low).alias("i"), (F.col("s") / F.col("_s0")).alias("r"))
        first = find_peaks(norm, keys, "r", prominence=0.1).groupBy(*keys).agg(F.min("i").alias("i"))
        got = durable(first.select(*keys, (F.lit(eff) / (F.col("i") + low)).alias("movement_hz")))
        found = got if found is None else found.unionByName(got)
        gone = with_key(got, keys).select(KEY)
        c = durable(with_key(c.filter(F.col("_n") > lags), keys).join(gone, KEY, "left_anti").drop(KEY))
        if c.isEmpty():
            return found
        acf = with_key(acf, keys).join(with_key(c.select(*keys).distinct(), keys).select(KEY), KEY, "left_semi").drop(KEY)
        done, lags = lags, lags * 4


def lag_sums(series: DataFrame, keys: Sequence[str], low: int, high: int, rows: int = CORR_ROWS) -> DataFrame:
    """(keys, _n, i = lag, s) for low <= lag < high: the sum of x[k] * x[k + lag] over the series (keys, _n, i, x) of _n samples.

    A series is cut into blocks of ``rows``. A block meets the blocks that its lags reach, each pair is one
    product of two spectra of fixed length, and the sums go by key and lag through a shuffle: no group has
    more than ``CORR_PAIRS`` pairs, however long a series or a lag is.
    """
    keys = list(keys)
    item = F.array_sort(F.collect_list(F.struct("i", "x")))
    blocks = with_key(series.groupBy(*keys, "_n", F.floor(F.col("i") / rows).cast("long").alias("_b")).agg(item.alias("_s")), keys)
    blocks = durable(blocks.select(KEY, *keys, "_n", "_b", F.col("_s.i").alias("_i"), F.col("_s.x").alias("_x")))
    reach = F.sequence(F.lit(low // rows), F.lit((high - 1) // rows + 1)).cast("array<bigint>")
    left = blocks.withColumn("_d", F.explode(reach)).withColumn("_to", F.col("_b") + F.col("_d"))
    right = blocks.select(KEY, F.col("_b").alias("_to"), F.col("_i").alias("_j"), F.col("_x").alias("_y"))
    pairs = left.join(right, [KEY, "_to"]).withColumn("_part", F.floor(F.col("_b") / CORR_PAIRS).cast("long")).drop(KEY)
    pairs = pairs.withColumn("_at", F.col("_d")).withColumn("_total", F.col("_n"))

    def laid(at: np.ndarray, x: np.ndarray) -> np.ndarray:
        out = np.zeros(2 * rows)
        out[np.asarray(at) % rows] = x
        return np.fft.rfft(out)

    def partial(g: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        total = sum(np.conj(laid(i, x)) * laid(j, y) for i, x, j, y in zip(g["_i"], g["_x"], g["_j"], g["_y"]))
        off = np.arange(1 - rows, rows)
        lag = int(g["_at"][0]) * rows + off
        use = (lag >= max(low, 0)) & (lag < min(high, int(g["_total"][0]))) & ((off >= 0) | (g["_at"][0] > 0))
        return {"i": lag[use], "s": np.fft.irfft(total, 2 * rows)[off[use]]}

    parts = grouped_map(pairs, [*keys, "_n", "_d", "_part"], ["_b"], ["_i", "_x", "_j", "_y", "_at", "_total"], "i bigint, s double", partial)
    return parts.groupBy(*keys, "_n", "i").agg(F.sum("s").alias("s"))


def periodic_artifacts(
    signal: DataFrame, motion_hz: DataFrame, spans: DataFrame, keys: Sequence[str], channels: Sequence[str], fs: float,
    window_s: float = 2.0, ratio: float = 10.0, tolerance_hz: float = 0.1, target_fs: float = 2000.0,
    rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Narrowband spans inside the exercise that are not a harmonic (1..5) of the movement itself.

    ``spans`` has (keys, span_start, span_end); ``motion_hz`` may lack recordings.
    """
    keys = list(keys)
    inside = signal.join(spans, keys).filter((F.col("t") >= F.col("span_start")) & (F.col("t") <= F.col("span_end")))
    first = inside.groupBy(*keys).agg(F.min("i").alias("_i0"), F.count(F.lit(1)).alias("_n")).filter("_n >= 256")
    inside = inside.join(first, keys).withColumn("i", F.col("i") - F.col("_i0")).select(*keys, "i", "t", *channels)
    factor = max(int(fs / target_fs), 1)
    slim = decimate(inside, keys, channels, factor, rows)
    long = slim.unpivot([*keys, "i", "t"], list(channels), "channel", "x")
    w, nper = psd_window(fs / factor, window_s)
    hot = frame_map(long, [*keys, "channel"], "x", w, w // 2, "ratio double, peak_hz double", peaks_of_spectra(fs / factor, nper), rows=rows).filter(F.col("ratio") >= ratio)
    hot = with_key(hot, keys).join(with_key(motion_hz, keys).drop(*keys), KEY, "left").drop(KEY)
    moving = F.exists(
        F.array(*[F.lit(h) for h in range(1, 6)]),
        lambda h: F.abs(F.col("peak_hz") - h * F.col("movement_hz")) < tolerance_hz,
    )
    hot = hot.filter(F.coalesce(~moving, F.lit(True)))
    return iv.merge_intervals(hot.select(*keys, "channel", F.col("t0").alias("start"), F.col("t1").alias("end")), [*keys, "channel"])
