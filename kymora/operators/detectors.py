"""Stage-one signal quality detectors: dropout, spikes and their combination."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kymora.operators import intervals as iv
from kymora.operators.windows import sliding_stats, window_length
from kymora.plans.blocks import BLOCK_ROWS
from kymora.plans.quantiles import quantiles_of
from kymora.sources.adapters import CHANNELS

# Detector defaults (volts, volts squared, seconds).
SILENCE_RMS = 1.45
FLATLINE_VAR = 0.000001
DROPOUT_WINDOW_S = 0.5
DROPOUT_MIN_S = 0.1
SPIKE_SIGMA = 5.0
SPIKE_WINDOW_S = 0.01
SPIKE_MIN_S = 0.01

# A sample that lies exactly on the limit is no spike. Series of few distinct values meet the limit exactly,
# and there the rounding of a mean would decide; so the limit is raised by this share of the local mean.
TIE_MARGIN = 1e-9

RECORDING = ("recording_id",)


def _per_channel(masked: DataFrame, flags: Sequence[str], keys: Sequence[str], min_s: float, rows: int) -> DataFrame:
    return iv.flags_to_intervals(masked, keys, {f: f.removeprefix("_bad_") for f in flags}, min_s, rows)


def _flagged(
    signal: DataFrame, keys: Sequence[str], channels: Sequence[str], window: int, stats: Sequence[str], rule, rows: int
) -> DataFrame:
    s = sliding_stats(signal.select(*keys, "i", "t", *channels), keys, channels, window, stats, rows)
    return s.select(*keys, "i", "t", *[F.coalesce(rule(c), F.lit(False)).alias(f"_bad_{c}") for c in channels])


def _collect(flagged: DataFrame, keys, channels, min_s: float, per_channel: bool, rows: int) -> DataFrame:
    flags = [f"_bad_{c}" for c in channels]
    if per_channel:
        return _per_channel(flagged, flags, keys, min_s, rows)
    any_bad = reduce(lambda a, b: a | b, [F.col(f) for f in flags])
    return iv.mask_to_intervals(flagged, keys, any_bad, min_s, rows)


def dropout_rule(silence: float = SILENCE_RMS, flatline: float = FLATLINE_VAR):
    def rule(c: str) -> Column:
        return (F.col(f"{c}_rms") < silence) | (F.col(f"{c}_var") < flatline)

    return rule


def spike_rule(sigma: float = SPIKE_SIGMA, two_sided: bool = False, tie_margin: float = TIE_MARGIN):
    def rule(c: str) -> Column:
        reach = sigma * F.col(f"{c}_std") + F.abs(F.col(f"{c}_mean")) * tie_margin
        if two_sided:
            return F.abs(F.col(c) - F.col(f"{c}_mean")) > reach
        return F.abs(F.col(c)) > F.col(f"{c}_mean") + reach

    return rule


def detect_dropout(
    signal: DataFrame, fs: float, channels: Sequence[str] = CHANNELS, keys: Sequence[str] = RECORDING,
    silence: float = SILENCE_RMS, flatline: float = FLATLINE_VAR, window_s: float = DROPOUT_WINDOW_S,
    min_s: float = DROPOUT_MIN_S, per_channel: bool = True, rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Intervals where the sliding RMS or variance falls below its threshold."""
    w = window_length(fs, window_s, 10)
    flagged = _flagged(signal, keys, channels, w, ("rms", "var"), dropout_rule(silence, flatline), rows)
    return _collect(flagged, keys, channels, min_s, per_channel, rows)


def detect_spikes(
    signal: DataFrame, fs: float, channels: Sequence[str] = CHANNELS, keys: Sequence[str] = RECORDING,
    sigma: float = SPIKE_SIGMA, window_s: float = SPIKE_WINDOW_S, min_s: float = SPIKE_MIN_S,
    per_channel: bool = True, two_sided: bool = False, rows: int = BLOCK_ROWS, tie_margin: float = TIE_MARGIN,
) -> DataFrame:
    """Intervals where a sample exceeds its local mean by ``sigma`` local deviations, typed by length.

    A sample within ``tie_margin`` of the limit, relative to the local mean, is a tie and no spike.
    """
    w = window_length(fs, window_s, 5)
    flagged = _flagged(signal, keys, channels, w, ("mean", "std"), spike_rule(sigma, two_sided, tie_margin), rows)
    found = _collect(flagged, keys, channels, min_s, per_channel, rows)
    return found.withColumn("artifact_type", iv.artifact_type(F.col("end") - F.col("start")))


def overall_qc(dropout: DataFrame, artifact: DataFrame, keys: Sequence[str] = RECORDING) -> DataFrame:
    """Both detectors' overall intervals in one tagged table."""
    cols = [*keys, "kind", "start", "end"]
    return (
        dropout.withColumn("kind", F.lit("dropout")).select(*cols)
        .unionByName(artifact.withColumn("kind", F.lit("artifact")).select(*cols))
    )


def channel_qc(parts: dict[str, DataFrame], keys: Sequence[str] = RECORDING) -> DataFrame:
    """Dropout, spike and continuous intervals merged per channel without a gap."""
    return iv.union_merge(list(parts.values()), [*keys, "channel"], 0.0)


def stage_record(parts: dict[str, DataFrame], keys: Sequence[str] = RECORDING, gap_s: float = 0.5) -> DataFrame:
    """Long record (keys, kind, channel, start, end): each kind per channel, plus an overall channel."""
    cols = [*keys, "kind", "channel", "start", "end"]
    long = reduce(
        DataFrame.unionByName,
        [p.select(*keys, F.lit(kind).alias("kind"), "channel", "start", "end") for kind, p in parts.items()],
    )
    overall = iv.merge_intervals(long.select(*keys, "kind", "start", "end"), [*keys, "kind"], gap_s)
    return long.select(*cols).unionByName(overall.withColumn("channel", F.lit("overall")).select(*cols))


def calibrate_thresholds(
    signal: DataFrame, window: int, channels: Sequence[str] = CHANNELS, keys: Sequence[str] = ()
) -> DataFrame:
    """1st and 5th percentile of tumbling-window RMS and variance, per channel."""
    long = signal.unpivot(["recording_id", "i"], list(channels), "channel", "x")
    frames = long.groupBy("recording_id", "channel", F.floor(F.col("i") / window).alias("frame")).agg(
        F.sqrt(F.avg(F.col("x") * F.col("x"))).alias("rms"), F.var_pop("x").alias("var")
    )
    return quantiles_of(frames, [*keys, "channel"], {c: {f"{c}_p01": 0.01, f"{c}_p05": 0.05} for c in ("rms", "var")})
