"""Interval algebra over rows (keys, start, end) in seconds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kymora.plans.blocks import BLOCK_ROWS, join_runs, local_runs, range_blocks, running, true_runs

TIME_BUCKET_S = 4.0


def mask_to_intervals(
    df: DataFrame, keys: Sequence[str], mask: Column, min_duration_s: float = 0.0, rows: int = BLOCK_ROWS
) -> DataFrame:
    """Runs of TRUE samples as [first, last] times that last at least ``min_duration_s``."""
    return _lasting(true_runs(df, keys, mask, rows=rows), keys, min_duration_s)


def flags_to_intervals(df: DataFrame, keys: Sequence[str], flags: dict[str, str], min_duration_s: float = 0.0, rows: int = BLOCK_ROWS) -> DataFrame:
    """The same for several flag columns at once: (keys, channel, start, end), ``flags`` names each column's channel.

    Runs are closed where the samples are, so what is shuffled are runs.
    """
    by = [*keys, "channel"]
    return _lasting(join_runs(local_runs(df, keys, flags, "channel", rows=rows), by, rows), by, min_duration_s)


def _lasting(runs: DataFrame, keys: Sequence[str], min_duration_s: float) -> DataFrame:
    return runs.filter(F.col("end") - F.col("start") >= min_duration_s).select(*keys, "start", "end")


def merge_intervals(intervals: DataFrame, keys: Sequence[str], gap_s: float = 0.0) -> DataFrame:
    """Join intervals that overlap or lie within ``gap_s`` of the furthest end so far."""
    longest = intervals.groupBy(*keys, "start").agg(F.max("end").alias("end"))
    cut = range_blocks(longest, keys, ["start"])
    reach = running(cut, keys, ["start"], {"_reach": ("max", F.col("end"))}, exclusive=True)
    opens = F.when(F.col("start") <= F.col("_reach") + F.lit(gap_s), 0).otherwise(1)
    island = running(reach, keys, ["start"], {"_island": ("sum", opens)})
    part = island.groupBy(*keys, "_island").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return part.select(*keys, "start", "end")


def union_merge(parts: Sequence[DataFrame], keys: Sequence[str], gap_s: float = 0.0) -> DataFrame:
    """Merge any number of interval tables into one."""
    cols = [*keys, "start", "end"]
    out = parts[0].select(*cols)
    for p in parts[1:]:
        out = out.unionByName(p.select(*cols))
    return merge_intervals(out, keys, gap_s)


def by_bucket(intervals: DataFrame, start: str, end: str, bucket_s: float) -> DataFrame:
    """One copy of each interval per time bucket it touches."""
    first = F.floor(F.col(start) / F.lit(bucket_s)).cast("long")
    last = F.floor(F.col(end) / F.lit(bucket_s)).cast("long")
    return intervals.withColumn("_bucket", F.explode(F.sequence(first, F.greatest(first, last))))


def drop_samples_inside(
    samples: DataFrame, intervals: DataFrame, keys: Sequence[str], t: str = "t",
    bucket_s: float = TIME_BUCKET_S, merged: bool = False,
) -> DataFrame:
    """Samples outside every interval (both interval ends count as inside)."""
    bad = intervals if merged else merge_intervals(intervals, keys)
    bad = by_bucket(bad, "start", "end", bucket_s).select(
        *[F.col(k).alias(f"_b_{k}") for k in keys], F.col("_bucket").alias("_b_bucket"), "start", "end"
    )
    s = samples.withColumn("_bucket", F.floor(F.col(t) / F.lit(bucket_s)).cast("long"))
    on = F.col("_bucket") == F.col("_b_bucket")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_b_{k}"))
    on = on & (F.col(t) >= F.col("start")) & (F.col(t) <= F.col("end"))
    return s.join(bad, on, "left_anti").drop("_bucket")


def shift(intervals: DataFrame, offsets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Move intervals from audio time to motion time by ``motion_stomp - audio_stomp``."""
    d = F.col("motion_stomp") - F.col("audio_stomp")
    joined = intervals.join(offsets.select(*keys, d.alias("_d")), list(keys))
    return joined.withColumn("start", F.col("start") + F.col("_d")).withColumn("end", F.col("end") + F.col("_d")).drop("_d")


def trim_to_windows(
    intervals: DataFrame, windows: DataFrame, keys: Sequence[str], window_id: Sequence[str] = ("cycle_index",),
    bucket_s: float = TIME_BUCKET_S,
) -> DataFrame:
    """Parts of intervals that fall strictly inside windows (keys, window_id, w_start, w_end)."""
    extra = [c for c in intervals.columns if c not in (*keys, "start", "end")]
    a = by_bucket(intervals, "start", "end", bucket_s)
    b = by_bucket(windows.select(*keys, *window_id, "w_start", "w_end"), "w_start", "w_end", bucket_s)
    both = a.join(b, [*keys, "_bucket"]).filter(
        (F.col("end") > F.col("w_start")) & (F.col("start") < F.col("w_end"))
    )
    # a pair that shares several buckets is kept only in the first one of them
    anchor = F.floor(F.greatest("start", "w_start") / F.lit(bucket_s)).cast("long")
    return both.filter(F.col("_bucket") == anchor).select(
        *keys, *window_id, *extra,
        F.greatest("start", "w_start").alias("start"), F.least("end", "w_end").alias("end"),
    )


def overlap_fraction(
    windows: DataFrame, intervals: DataFrame, keys: Sequence[str], window_id: Sequence[str] = ("cycle_index",)
) -> DataFrame:
    """Share of each window covered by intervals; overlaps are summed, so unmerged input counts twice.

    Covered time up to x is ``x * open(x) - (sum of starts - sum of ends)`` over the intervals begun
    or finished by x. One sweep over all end points gives it for every window edge: no pair of window
    and interval is ever formed.
    """
    null_ids = [F.lit(None).cast(windows.schema[c].dataType).alias(c) for c in window_id]
    live = intervals.filter(F.col("end") > F.col("start"))

    def interval_point(x: str, sign: int) -> DataFrame:
        return live.select(
            *keys, F.col(x).cast("double").alias("x"), F.lit(sign).alias("_n"),
            (F.lit(float(sign)) * F.col(x)).alias("_s"), F.lit(None).cast("int").alias("_side"), *null_ids,
        ).withColumn("_m", F.lit(1))

    def window_point(x: str, side: int) -> DataFrame:
        return windows.select(
            *keys, F.col(x).cast("double").alias("x"), F.lit(0).alias("_n"), F.lit(0.0).alias("_s"),
            F.lit(side).alias("_side"), *window_id, F.lit(0).alias("_m"),
        )

    ends = interval_point("start", 1).unionByName(interval_point("end", -1))
    # equal end points fold together before the shuffle
    ends = ends.groupBy(*keys, "x", "_side", *window_id, "_m").agg(F.sum("_n").alias("_n"), F.sum("_s").alias("_s"))
    points = ends.unionByName(window_point("w_start", -1)).unionByName(window_point("w_end", 1))
    order = ["x", "_m", "_side", *window_id]
    cut = range_blocks(points, keys, order)
    swept = running(cut, keys, order, {"_open": ("sum", F.col("_n")), "_sum": ("sum", F.col("_s"))})
    covered = F.col("x") * F.col("_open") - F.col("_sum")
    total = (
        swept.filter("_m = 0")
        .groupBy(*keys, *window_id)
        .agg(
            F.sum(F.col("_side") * covered).alias("_covered"),
            F.sum(F.col("_side") * F.col("x")).alias("_length"),
        )
    )
    frac = F.when(F.col("_length") > 0, F.greatest(F.col("_covered"), F.lit(0.0)) / F.col("_length")).otherwise(F.lit(0.0))
    return total.select(*keys, *window_id, frac.alias("overlap_fraction"))


def in_bad_interval(fractions: DataFrame, threshold: float = 0.1) -> DataFrame:
    return fractions.withColumn("in_bad_interval", F.col("overlap_fraction") >= threshold)


def artifact_type(duration: Column, intermittent_below_s: float = 4.0) -> Column:
    return F.when(duration < intermittent_below_s, F.lit("Intermittent")).otherwise(F.lit("Continuous"))


def duration_band(intervals: DataFrame, min_s: float = 0.05, max_s: float = 4.0) -> DataFrame:
    return intervals.filter((F.col("end") - F.col("start")).between(min_s, max_s))


def flatten_pairs(pairs: Column) -> Column:
    """ARRAY<STRUCT<start,end>> to [s1, e1, s2, e2, ...]."""
    return F.flatten(F.transform(pairs, lambda p: F.array(p["start"], p["end"])))


def unflatten_pairs(flat: Column) -> Column:
    """[s1, e1, ...] to ARRAY<STRUCT<start,end>>; an odd length gives an empty array."""
    empty = F.array().cast("array<struct<start:double,end:double>>")
    pairs = F.transform(
        F.sequence(F.lit(0), F.size(flat) - 2, F.lit(2)),
        lambda k: F.struct(
            F.get(flat, k.cast("int")).alias("start"), F.get(flat, (k + 1).cast("int")).alias("end")
        ),
    )
    return F.when((F.size(flat) >= 2) & (F.size(flat) % 2 == 0), pairs).otherwise(empty)


def spread_overall(overall: DataFrame, per_channel: DataFrame, keys: Sequence[str], channels: Sequence[str]) -> DataFrame:
    """Recordings without per-channel intervals take the overall ones on every channel."""
    have = per_channel.select(*keys).distinct()
    filled = overall.join(have, list(keys), "left_anti").withColumn(
        "channel", F.explode(F.array(*[F.lit(c) for c in channels]))
    )
    cols = [*keys, "channel", "start", "end"]
    return per_channel.select(*cols).unionByName(filled.select(*cols))


def overall_segments(per_channel: DataFrame, keys: Sequence[str], gap_s: float = 0.0) -> DataFrame:
    """Union of channel intervals, merged per recording."""
    return merge_intervals(per_channel.select(*keys, "start", "end"), keys, gap_s)


