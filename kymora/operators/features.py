"""Feature tables: per cycle, per participant, and the reshaping of intervals to wide columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kymora.operators import intervals as iv
from kymora.operators import spectral as sp
from kymora.plans import transform
from kymora.plans.quantiles import quantiles_of
from kymora.sources.adapters import CHANNELS


def sample_kurtosis(x: Column) -> Column:
    """Bias-adjusted excess kurtosis (null below four values, zero for a constant)."""
    n, g = F.count(x), F.kurtosis(x)
    return F.when((n > 3) & (F.stddev_pop(x) == 0), 0.0).when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g + 6))


def sample_skewness(x: Column) -> Column:
    """Bias-adjusted skewness (null below three values, zero for a constant)."""
    n, g = F.count(x), F.skewness(x)
    return F.when((n > 2) & (F.stddev_pop(x) == 0), 0.0).when(n > 2, g * F.sqrt(n * (n - 1)) / (n - 2))


def correlation(a: Column, b: Column) -> Column:
    """Pearson correlation; null when either side is constant."""
    return F.covar_pop(a, b) / F.nullif(F.stddev_pop(a) * F.stddev_pop(b), F.lit(0.0))


def moments(x: Column, prefix: str) -> list[Column]:
    return [
        F.avg(x).alias(f"{prefix}_mean"),
        F.stddev_pop(x).alias(f"{prefix}_std"),
        F.sqrt(F.avg(x * x)).alias(f"{prefix}_rms"),
        F.max(F.abs(x)).alias(f"{prefix}_peak"),
        (F.max(x) - F.min(x)).alias(f"{prefix}_peak_to_peak"),
        F.sum(x * x).alias(f"{prefix}_energy"),
        sample_kurtosis(x).alias(f"{prefix}_kurtosis"),
        sample_skewness(x).alias(f"{prefix}_skewness"),
    ]


def channel_features(samples: DataFrame, keys: Sequence[str], channels: Sequence[str] = CHANNELS) -> DataFrame:
    """Moments of every channel and of their mean signal, and all channel correlations, in one pass."""
    mean = sum((F.col(c) for c in channels[1:]), F.col(channels[0])) / len(channels)
    aggs = [a for c in channels for a in moments(F.col(c), c)]
    aggs += moments(mean, "avg")
    aggs += [correlation(F.col(a), F.col(b)).alias(f"corr_{a}_{b}") for k, a in enumerate(channels) for b in channels[k + 1 :]]
    return samples.groupBy(*keys).agg(*aggs)


def angle_features(samples: DataFrame, keys: Sequence[str], angle: str) -> DataFrame:
    a = F.col(angle)
    return samples.groupBy(*keys).agg(
        F.avg(a).alias("knee_angle_mean"), F.stddev_pop(a).alias("knee_angle_std"), F.min(a).alias("knee_angle_min"),
        F.max(a).alias("knee_angle_max"), (F.max(a) - F.min(a)).alias("knee_angle_range"),
    )


def temporal_features(samples: DataFrame, keys: Sequence[str]) -> DataFrame:
    g = samples.groupBy(*keys).agg(
        (F.max_by("t", "i") - F.min_by("t", "i")).alias("duration"), F.count(F.lit(1)).alias("num_samples")
    )
    return g.withColumn("sample_rate", F.when(F.col("duration") > 0, F.col("num_samples") / F.col("duration")))


def spectral_table(samples: DataFrame, ck: Sequence[str], channels: Sequence[str] = CHANNELS, whole: int = transform.ROWS) -> DataFrame:
    """Spectral features of each cycle's channels.

    A cycle of at most ``whole`` samples is one array a channel; the spectra of longer ones come from a transform that
    is split over two shuffles (``plans.transform``) and are summed by cycle and channel.
    """
    ck = list(ck)
    mean = sum((F.col(c) for c in channels[1:]), F.col(channels[0])) / len(channels)
    long = transform.numbered(samples.select(*ck, "i", *channels), ck).withColumn("avg", mean).unpivot([*ck, "n", "i"], [*channels, "avg"], "channel", "x")
    arrays = long.filter(F.col("n") <= whole).groupBy(*ck, "channel").agg(F.array_sort(F.collect_list(F.struct("i", "x"))).alias("s"))
    f = arrays.select(*ck, "channel", sp.spectral_features(F.col("s.x")).alias("f")).select(*ck, "channel", "f.*")
    large = long.filter(F.col("n") > whole)
    if not large.isEmpty():
        bins = transform.spectrum(large, [*ck, "channel"], whole)
        m = F.sqrt(F.col("re") * F.col("re") + F.col("im") * F.col("im"))
        f = f.unionByName(bins.groupBy(*ck, "channel").agg(
            (F.sum(F.col("i") * m) / (F.sum(m) + 1e-10)).alias("centroid"), F.stddev_pop(m).alias("spread"), F.sum(m * m).alias("energy")))
    pick = [
        F.max(F.when(F.col("channel") == c, F.col(k))).alias(f"{c}_spectral_{k}")
        for c in [*channels, "avg"] for k in ("centroid", "spread", "energy")
    ]
    return f.groupBy(*ck).agg(*pick)


def cycle_features(samples: DataFrame, ck: Sequence[str], angle: str | None = None, channels: Sequence[str] = CHANNELS) -> DataFrame:
    """All features of every cycle; a cycle whose values are unusable keeps its row with nulls."""
    ck = list(ck)
    out = channel_features(samples, ck, channels).join(temporal_features(samples, ck), ck)
    out = out.join(spectral_table(samples, ck, channels), ck, "left")
    return out.join(angle_features(samples, ck, angle), ck, "left") if angle else out


def feature_failures(features: DataFrame, ck: Sequence[str]) -> DataFrame:
    """Cycles the batch could not describe, one row each with the missing feature names."""
    names = [c for c in features.columns if c not in ck]
    missing = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in names]))
    return features.select(*ck, missing.alias("missing")).filter(F.size("missing") > 0)


def participant_features(features: DataFrame, by: Sequence[str], names: Sequence[str], statistic: str = "mean") -> DataFrame:
    """One row per participant: mean, median, max or min of every feature."""
    by = list(by)
    if statistic != "median":
        f = {"mean": F.avg, "max": F.max, "min": F.min}[statistic]
        return features.groupBy(*by).agg(*[f(n).alias(n) for n in names])
    return quantiles_of(features, by, {n: {f"_q_{n}": 0.5} for n in names}).withColumnsRenamed({f"_q_{n}": n for n in names})


def pivot_intervals(
    intervals: DataFrame, keys: Sequence[str], kinds: Sequence[str], channels: Sequence[str]
) -> DataFrame:
    """Flag, and flat [s1, e1, ...] array, per kind and channel; absent combinations are false and null."""
    pair = F.struct("start", "end")
    cells = [(k, c) for k in kinds for c in channels]
    wide = intervals.groupBy(*keys).agg(
        *[
            iv.flatten_pairs(
                F.array_sort(F.collect_list(F.when((F.col("kind") == k) & (F.col("channel") == c), pair)))
            ).alias(f"{k}_segments_{c}")
            for k, c in cells
        ]
    )
    return wide.select(
        *keys,
        *[(F.size(f"{k}_segments_{c}") > 0).alias(f"{k}_{c}") for k, c in cells],
        *[F.when(F.size(f"{k}_segments_{c}") > 0, F.col(f"{k}_segments_{c}")).alias(f"{k}_segments_{c}") for k, c in cells],
    )


def label_distribution(labels: DataFrame, label: str) -> DataFrame:
    return labels.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))


def distinct_by_key(rows: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """First row per non-null key under an explicit order, found by a mergeable minimum."""
    rest = [c for c in rows.columns if c != key]
    first = F.min_by(F.struct(*rest), F.struct(*order))
    return rows.filter(F.col(key).isNotNull()).groupBy(key).agg(first.alias("_r")).select(key, *[F.col(f"_r.{c}").alias(c) for c in rest])
