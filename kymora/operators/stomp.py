"""Stomp detection: three detectors over the first seconds, consensus, and the guided refinement."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StructField, StructType

from kymora.operators.peaks import find_peaks
from kymora.operators.segments import peak_pairs
from kymora.operators.spectral import stomp_band_energy
from kymora.operators.windows import envelope, gradient, moving_average
from kymora.plans.blocks import BLOCK_ROWS, _changes
from kymora.session import durable
from kymora.sources.adapters import CHANNELS

SEARCH_S = 20.0
DETAIL_RATE = 4000.0
CONSENSUS_S = 0.5
MIN_ENERGY_RATIO = 1.2


def channel_set(columns: Sequence[str]) -> list[str]:
    """Filtered channels when all four are there, else the raw ones."""
    filtered = [f"f_{c}" for c in CHANNELS]
    return filtered if all(c in columns for c in filtered) else [c for c in CHANNELS if c in columns]


def _squares(signal: DataFrame, keys: Sequence[str], channels: Sequence[str], fs: float, window_s: float, search_s: float) -> tuple[DataFrame, int, int]:
    """(keys, i, t, q = sum of squares) of the samples that count, with the samples of a window and of a step."""
    k = max(1, int(fs / DETAIL_RATE))
    w = max(2, int(window_s * fs / k))
    total = sum((F.col(c) * F.col(c) for c in channels), F.lit(0.0))
    s = signal.filter((F.col("t") <= search_s) & (F.col("i") % k == 0)).select(
        *keys, F.floor(F.col("i") / k).cast("long").alias("i"), F.col("t").cast("double").alias("t"), total.alias("q")
    )
    return s, w, max(1, w // 4)


def window_energy(
    signal: DataFrame, keys: Sequence[str], channels: Sequence[str], fs: float, window_s: float, search_s: float = SEARCH_S
) -> DataFrame:
    """Strided RMS across all channels: (keys, i = window number, energy, t at mid-window)."""
    s, w, step = _squares(signal, keys, channels, fs, window_s, search_s)
    first = F.greatest(F.floor((F.col("i") - w) / step).cast("long") + 1, F.lit(0))
    spread = s.withColumn("w", F.explode(F.sequence(first, F.floor(F.col("i") / step).cast("long"))))
    g = spread.groupBy(*keys, "w").agg(
        F.sum("q").alias("q"), F.count(F.lit(1)).alias("n"),
        F.max(F.when(F.col("i") == F.col("w") * step + w // 2, F.col("t"))).alias("t"),
    )
    energy = F.sqrt(F.col("q") / (w * len(channels)))
    return g.filter(F.col("n") == w).select(*keys, F.col("w").alias("i"), energy.alias("energy"), "t")


def _strongest(df: DataFrame, keys: Sequence[str], score: str, time: str, value: str) -> DataFrame:
    best = F.max_by(F.struct("t", score), F.struct(score, (-F.col("i")).alias("o")))
    return df.groupBy(*keys).agg(best.alias("b")).select(*keys, F.col("b.t").alias(time), F.col(f"b.{score}").alias(value))


def _stretches(batch: pa.RecordBatch, keys: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last row of each stretch of consecutive samples that arrive one after the other, and each row's stretch."""
    i = batch.column("i").to_numpy()
    new = np.append(True, i[1:] != i[:-1] + 1)
    for k in keys:
        new[1:] |= _changes(batch.column(k))
    first = np.flatnonzero(new)
    return first, np.append(first[1:], len(i)) - 1, np.cumsum(new) - 1


def _expand(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every whole number from ``lo`` to ``hi``, and the row it is of."""
    n = np.maximum(hi - lo + 1, 0)
    row = np.repeat(np.arange(len(n)), n)
    return lo[row] + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n), row


def _loudest(keys: Sequence[str], w: int, step: int, channels: int):
    """Of rows (keys, i, t, q) the loudest window inside each stretch, and for windows over its ends the parts (keys, w, q, n, t)."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        first, last, of = _stretches(batch, keys)
        i, t = batch.column("i").to_numpy(), batch.column("t").to_numpy(zero_copy_only=False)
        known = batch.column("q").is_valid().to_numpy(zero_copy_only=False)
        q = np.where(known, batch.column("q").fill_null(0.0).to_numpy(), 0.0)
        # windows within a stretch
        c0, c1 = -(-i[first] // step), (i[last] - w + 1) // step
        at, s = _expand(c0, c1)
        begin = first[s] + at * step - i[first[s]]
        total, some = np.zeros(len(at)), np.zeros(len(at), bool)
        for k in range(w if len(at) else 0):
            total += q[begin + k]
            some |= known[begin + k]
        loud = np.where(some, np.sqrt(total / (w * channels)), -np.inf)
        order = np.lexsort((at, -loud, ~np.isnan(loud), s))  # NaN is above all else
        best = order[np.append(True, s[order][1:] != s[order][:-1])] if len(order) else order
        # the other windows a row lies in
        lo, hi = np.maximum((i - w) // step + 1, 0), i // step
        inside = (c1 >= c0)[of]
        left, r1 = _expand(lo, np.where(inside, np.minimum(hi, c0[of] - 1), hi))
        right, r2 = _expand(np.where(inside, np.maximum(lo, c1[of] + 1), hi + 1), hi)
        win, r = np.concatenate([left, right]), np.concatenate([r1, r2])
        rows = np.concatenate([begin[best], r])
        mid = np.concatenate([begin[best] + w // 2, r])
        timed = np.concatenate([np.ones(len(best), bool), i[r] == win * step + w // 2])
        return pa.RecordBatch.from_arrays(
            [*[batch.column(k).take(pa.array(rows)) for k in keys], pa.array(np.concatenate([at[best], win])),
             pa.array(np.concatenate([total[best], q[r]]), mask=~np.concatenate([some[best], known[r]])),
             pa.array(np.concatenate([np.full(len(best), w), np.ones(len(r), np.int64)])),
             pa.array(t[mid], mask=~timed | ~batch.column("t").is_valid().to_numpy(zero_copy_only=False)[mid])],
            [*keys, "w", "q", "n", "t"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(invalid="ignore", over="ignore"):
            for batch in batches:
                if batch.num_rows:
                    yield work(batch)

    return run


def stomp_by_energy(signal: DataFrame, keys: Sequence[str], channels: Sequence[str], fs: float, first_above: float | None = None) -> DataFrame:
    """Loudest 50 ms window; with ``first_above`` the first window at that share of the loudest.

    The loudest is sought where the samples are: of each stretch of samples that arrive in order travel its loudest
    window and the parts of windows over its ends.
    """
    if first_above is not None:
        e = window_energy(signal, keys, channels, fs, 0.05)
        top = e.groupBy(*keys).agg(F.max("energy").alias("_top"))
        hit = e.join(top, list(keys)).filter(F.col("energy") >= F.col("_top") * first_above)
        return hit.groupBy(*keys).agg(F.min_by("t", "i").alias("rms_time"), F.min_by("energy", "i").alias("rms_energy"))
    s, w, step = _squares(signal, keys, channels, fs, 0.05, SEARCH_S)
    told = StructType([*[s.schema[k] for k in keys], StructField("w", LongType()), StructField("q", DoubleType()), StructField("n", LongType()), StructField("t", DoubleType())])
    parts = s.filter(F.col("i").isNotNull()).mapInArrow(_loudest(list(keys), w, step, len(channels)), told)
    g = parts.groupBy(*keys, "w").agg(F.sum("q").alias("q"), F.sum("n").alias("n"), F.max("t").alias("t")).filter(F.col("n") == w)
    e = g.select(*keys, F.col("w").alias("i"), F.sqrt(F.col("q") / (w * len(channels))).alias("energy"), "t")
    return _strongest(e, keys, "energy", "rms_time", "rms_energy")


def _steepest(keys: Sequence[str], before: int, after: int):
    """Of rows (keys, i, t, e) the steepest change inside each stretch (``g``), and the rows next to its ends (``edge``: to be judged).

    A change hangs on ``before`` + 1 samples ahead and ``after`` + 1 behind; what lies closer to an end goes out with
    the samples it hangs on, and so does every stretch with an unknown value.
    """
    reach, m = max(before, after) + 1, before + after + 1

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        first, last, of = _stretches(batch, keys)
        e = batch.column("e").fill_null(float("nan")).to_numpy()
        n, at = len(e), np.arange(len(e))
        odd = np.logical_or.reduceat(np.isnan(e), first)
        edge = odd[of] | (at - first[of] < reach) | (last[of] - at < reach)
        near = odd[of] | (at - first[of] < 3 * reach) | (last[of] - at < 3 * reach)
        core = np.flatnonzero(~edge)
        smooth = np.zeros(n)
        for k in range(-before, after + 1):
            smooth += np.take(e, at + k, mode="clip")
        smooth = smooth / m if m > 1 else e
        g = np.abs((smooth[core + 1] - smooth[core - 1]) / 2)
        order = np.lexsort((core, -g, of[core]))
        best = order[np.append(True, of[core][order][1:] != of[core][order][:-1])] if len(order) else order
        out = np.flatnonzero(near)
        rows = pa.array(np.concatenate([core[best], out]))
        blank = np.zeros(len(best))
        return pa.RecordBatch.from_arrays(
            [*[batch.column(c).take(rows) for c in (*keys, "i", "t", "e")],
             pa.array(np.concatenate([g[best], np.zeros(len(out))]), mask=np.concatenate([blank, np.ones(len(out))]).astype(bool)),
             pa.array(np.concatenate([blank.astype(bool), edge[out]]))],
            [*keys, "i", "t", "e", "g", "edge"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(invalid="ignore", over="ignore"):
            for batch in batches:
                if batch.num_rows:
                    yield work(batch)

    return run


def stomp_by_onset(signal: DataFrame, keys: Sequence[str], channels: Sequence[str], fs: float, rows: int = BLOCK_ROWS, search_s: float = SEARCH_S) -> DataFrame:
    """Steepest change of the smoothed envelope in the first ``search_s`` seconds.

    It is sought where the samples are; only samples next to the ends of a stretch in order are shuffled.
    """
    keys, m = list(keys), max(1, int(0.01 * fs))
    s = signal.filter((F.col("t") <= search_s) & F.col("i").isNotNull()).select(
        *keys, F.col("i").cast("long").alias("i"), F.col("t").cast("double").alias("t"), envelope(list(channels)).cast("double").alias("e"))
    told = StructType([*s.schema.fields, StructField("g", DoubleType()), StructField("edge", BooleanType())])
    found = durable(s.mapInArrow(_steepest(keys, m // 2, (m - 1) // 2), told))
    s = found.filter("g IS NULL").drop("g")
    s = moving_average(s, keys, "e", m, "sm", rows) if m > 1 else s.withColumn("sm", F.col("e"))
    g = gradient(s, keys, "sm", "g", rows).filter("edge").withColumn("g", F.abs("g")).filter(F.col("g").isNotNull())
    some = [*keys, "i", "t", "g"]
    return _strongest(found.filter("g IS NOT NULL").select(*some).unionByName(g.select(*some)), keys, "g", "onset_time", "onset_magnitude")


def stomp_by_frequency(signal: DataFrame, keys: Sequence[str], channels: Sequence[str], fs: float, search_s: float = SEARCH_S) -> DataFrame:
    """Frame with most power between 100 and 1000 Hz in the first ``search_s`` seconds."""
    e = stomp_band_energy(signal, keys, channels, fs, search_s)
    timed = e.join(signal.filter(F.col("t") <= search_s).select(*keys, "i", "t"), [*keys, "i"])
    return _strongest(timed.withColumn("i", F.col("frame")), keys, "energy", "freq_time", "freq_energy")


def consensus(detectors: DataFrame) -> DataFrame:
    """Mean of the methods within half a second of the energy method, with their names."""
    others = F.array(
        F.struct(F.lit("onset").alias("m"), F.col("onset_time").alias("t")),
        F.struct(F.lit("freq").alias("m"), F.col("freq_time").alias("t")),
    )
    near = F.filter(others, lambda o: F.abs(o["t"] - F.col("rms_time")) <= CONSENSUS_S)
    used = F.concat(F.array(F.struct(F.lit("rms").alias("m"), F.col("rms_time").alias("t"))), near)
    total = F.aggregate(used, F.lit(0.0), lambda acc, o: acc + o["t"])
    return detectors.withColumn("consensus_time", total / F.size(used)).withColumn(
        "consensus_methods", F.array_join(F.transform(used, lambda o: o["m"]), ",")
    )


def detect(signal: DataFrame, keys: Sequence[str], fs: float, channels: Sequence[str] | None = None) -> DataFrame:
    """All detectors, their consensus and the span of their times, one row per recording."""
    chans = list(channels or channel_set(signal.columns))
    d = stomp_by_energy(signal, keys, chans, fs)
    d = d.join(stomp_by_onset(signal, keys, chans, fs), list(keys), "left")
    d = d.join(stomp_by_frequency(signal, keys, chans, fs), list(keys), "left")
    return consensus(d).withColumn("agreement_span", agreement_span("rms_time", "onset_time", "freq_time"))


def agreement_span(*times: str) -> Column:
    t = F.array_compact(F.array(*times))
    return F.array_max(t) - F.array_min(t)


def refine(
    signal: DataFrame, detected: DataFrame, targets: DataFrame, keys: Sequence[str], fs: float,
    channels: Sequence[str] | None = None,
) -> DataFrame:
    """Pick the recorded knee's stomp by the known left/right spacing.

    ``targets`` has (keys, recorded_knee, left_stomp, right_stomp). The pair of energy peaks that best
    matches the spacing is assigned to the knees in motion order; it is used when the recorded side is
    at least 1.2 times as loud, otherwise the consensus stays.
    """
    keys = list(keys)
    chans = list(channels or channel_set(signal.columns))
    e = window_energy(signal, keys, chans, fs, 0.1)
    k = max(1, int(fs / DETAIL_RATE))
    step = max(1, max(2, int(0.1 * fs / k)) // 4)
    floor = e.groupBy(*keys).agg((F.max("energy") * 0.3).alias("height"))
    tops = find_peaks(e.select(*keys, "i", "energy"), keys, "energy", distance=max(int(0.5 * fs / k / step), 1), per_key=floor)
    peaks = tops.join(e.select(*keys, "i", "t", "energy"), [*keys, "i"])
    want = targets.withColumn("expected_delta", F.abs(F.col("left_stomp") - F.col("right_stomp")))
    pair = peak_pairs(peaks, want, keys)
    d = detected.join(targets, keys, "left").join(pair, keys, "left")
    right_first = F.col("right_stomp") < F.col("left_stomp")
    recorded_first = (F.col("recorded_knee") == "right") == right_first
    own_t = F.when(recorded_first, F.col("t1")).otherwise(F.col("t2"))
    other_t = F.when(recorded_first, F.col("t2")).otherwise(F.col("t1"))
    own_e = F.when(recorded_first, F.col("e1")).otherwise(F.col("e2"))
    other_e = F.when(recorded_first, F.col("e2")).otherwise(F.col("e1"))
    ratio = F.when(other_e > 0, own_e / other_e).otherwise(F.lit(float("inf")))
    use = F.coalesce(ratio >= MIN_ENERGY_RATIO, F.lit(False)) & F.col("t1").isNotNull()
    return d.select(
        *detected.columns,
        F.when(use, "biomechanics").otherwise("consensus").alias("selected_method"),
        F.when(use, own_t).alias("bio_selected_time"), F.when(use, other_t).alias("contra_bio_selected_time"),
        F.when(use, ratio).alias("energy_ratio"),
        F.when(use, own_t).otherwise(F.col("consensus_time")).alias("selected_time"),
    )


def sync_record(refined: DataFrame, spans: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Synchronisation row: both offset directions, method, agreement and durations.

    ``spans`` has (keys, motion_stomp, audio_duration, motion_duration, sync_duration).
    """
    d = refined.join(spans, list(keys), "left")
    return d.select(
        *keys, "consensus_time", "consensus_methods", "rms_time", "onset_time", "freq_time", "selected_method",
        F.col("selected_time").alias("audio_stomp"), "motion_stomp",
        (F.col("selected_time") - F.col("motion_stomp")).alias("offset_audio_minus_motion"),
        (F.col("motion_stomp") - F.col("selected_time")).alias("shift_motion_minus_audio"),
        "agreement_span", "bio_selected_time", "contra_bio_selected_time", "energy_ratio",
        "audio_duration", "motion_duration", "sync_duration",
    )
