"""Recording-level sound QC: walking passes by heel strikes, and periodic exercises."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from kymora.functions import kernels as kn
from kymora.functions import scalars as sc
from kymora.operators import spectral as sp
from kymora.operators.align import resample_uniform
from kymora.operators.intervals import by_bucket
from kymora.operators.peaks import find_peaks, heel_strikes
from kymora.operators.segments import gap_sessions, rate_segments
from kymora.operators.windows import moving_average
from kymora.plans.blocks import BLOCK_ROWS, KEY, index_blocks, running, time_blocks, whole_groups, with_key
from kymora.plans.quantiles import quantiles
from kymora.session import durable
from kymora.sources.adapters import CHANNELS

# Defaults for walking recordings, for one pre-cut pass, and for periodic exercises.
WALK = {
    "hz": 100.0, "height": 0.02, "prominence": 0.02, "min_step_hz": 0.5, "max_step_hz": 3.0, "least": 6, "gap_s": 2.0,
    "period_tolerance": 0.5, "min_coverage": 0.2, "rel_width": 0.35,
}
PASS = {
    "hz": 100.0, "height": 0.005, "prominence": 0.001, "min_step_hz": 0.2, "max_step_hz": 5.0, "least": 1, "gap_s": 2.0,
    "period_tolerance": 1.0, "min_coverage": 0.01, "rel_width": 0.35,
}
PERIODIC = {
    "flexion_extension": {"hz": 25.0, "height": 0.1, "period_tolerance": 0.3, "min_coverage": 0.5, "rel_width": 0.25},
    "sit_to_stand": {"hz": 25.0, "height": 0.08, "period_tolerance": 0.35, "min_coverage": 0.2, "rel_width": 0.3},
}


def mono(signal: DataFrame, keys: Sequence[str], channels: Sequence[str] = CHANNELS) -> DataFrame:
    """Mean of the channels that have a value, finite samples only."""
    known = [F.col(c).isNotNull() & ~F.isnan(c) for c in channels]
    total = sum((F.when(k, F.col(c)).otherwise(F.lit(0.0)) for k, c in zip(known, channels)), F.lit(0.0))
    n = sum((F.when(k, 1).otherwise(0) for k in known), F.lit(0))
    return signal.select(*keys, "i", "t", F.when(n > 0, total / n).alias("v")).filter("v IS NOT NULL AND t IS NOT NULL")


def numbered(events: DataFrame, keys: Sequence[str], rows: int = BLOCK_ROWS) -> DataFrame:
    """Events renumbered 0.. inside their key, in order of their sample index."""
    n = running(index_blocks(events, rows=rows), list(keys), ["i"], {"_k": ("sum", F.lit(1).cast("long"))})
    return n.select(*keys, (F.col("_k") - 1).alias("i"), "t")


def points_in_spans(points: DataFrame, spans: DataFrame, keys: Sequence[str], bucket_s: float = 60.0) -> DataFrame:
    """Every pair of a point ``t`` and a span that holds it, both ends included: an equi-join on time buckets.

    A point on the common edge of two spans is in both, and spans may overlap.
    """
    cut = with_key(by_bucket(spans, "start", "end", bucket_s), keys).drop(*keys)
    at = with_key(points.withColumn("_bucket", F.floor(F.col("t") / F.lit(bucket_s)).cast("long")), keys)
    return at.join(cut, [KEY, "_bucket"]).filter(F.col("t").between(F.col("start"), F.col("end"))).drop(KEY, "_bucket")


def strikes_in_passes(strikes: DataFrame, passes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Heel strikes with each pass they fall in."""
    return points_in_spans(strikes.select(*keys, "t"), passes.select(*keys, "start", "end"), keys)


def evaluate_passes(
    strikes: DataFrame, passes: DataFrame, keys: Sequence[str], hz: float, min_step_hz: float, max_step_hz: float,
    period_tolerance: float, min_coverage: float,
) -> DataFrame:
    """Cadence, coverage by regular steps and verdict of every pass with at least two strikes."""
    pk = [*keys, "start", "end"]
    s = strikes_in_passes(strikes, passes, keys)
    p = running(time_blocks(s, hz), pk, ["t"], {"_t0": ("last", F.col("t"))}, exclusive=True).withColumn("period", F.col("t") - F.col("_t0"))
    mid = quantiles(p.filter("period IS NOT NULL"), pk, "period", {"median": 0.5}).filter("median > 0")
    lo, hi = F.col("median") * (1 - period_tolerance), F.col("median") * (1 + period_tolerance)
    regular = F.col("period").between(lo, hi)
    g = p.join(mid, pk).groupBy(*pk, "median").agg(
        F.count(F.lit(1)).alias("heel_strike_count"), F.coalesce(F.sum(F.when(regular, F.col("period"))), F.lit(0.0)).alias("_valid"),
        F.count_if(regular).alias("_n_valid"),
    )
    g = g.withColumn("gait_cycle_hz", 1 / F.col("median")).filter(F.col("gait_cycle_hz").between(min_step_hz, max_step_hz))
    cover = F.col("_valid") / (F.col("end") - F.col("start"))
    return g.filter("end > start").select(
        *pk, "heel_strike_count", "gait_cycle_hz", cover.alias("coverage_frac"),
        ((cover >= min_coverage) & (F.col("_n_valid") >= 1)).alias("passed"),
    )


def _band_shares(group: Sequence[str], hz: float, rel_width: float, full: int):
    """Share of power near the target of each sorted span of four samples or more."""

    def work(table: pa.Table, at: np.ndarray) -> pa.RecordBatch:
        v, target = table.column("v").to_numpy(), table.column("target_hz").to_numpy()
        starts = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
        spots, shares = [], []
        for a, b in zip(starts.tolist(), np.append(starts[1:], len(at)).tolist()):
            if b - a < 4:
                continue
            p = kn.welch(v[a:b] - v[a:b].mean(), hz, full)[1]
            f = np.arange(len(p)) * hz / (b - a)
            near = p[(f >= max(target[a] * (1 - rel_width), 0.0)) & (f <= target[a] * (1 + rel_width))]
            total = p.sum() - (p[0] + p[-1]) / 2
            spots.append(a)
            shares.append((near.sum() - (near[0] + near[-1]) / 2) / total if total > 0 and len(near) else 0.0)
        spot = pa.array(spots, pa.int64())
        return pa.RecordBatch.from_arrays([*[table.column(c).take(spot).combine_chunks() for c in group], pa.array(shares, pa.float64())], [*group, "bandpower_ratio"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, at in whole_groups(batches, group):
            yield work(table, at)

    return run


def segment_bandpower(
    uniform: DataFrame, spans: DataFrame, keys: Sequence[str], hz: float, rel_width: float, seconds: float = 8.0
) -> DataFrame:
    """Share of power near ``target_hz`` per span: Welch segments spread by a shuffle, then averaged.

    ``spans`` has (keys, span_id, start, end, target_hz); a span shorter than one segment is one frame. The samples of a
    span whose length holds less than a segment travel once and give one row; blocks of longer spans give one
    spectrum each.
    """
    base_keys, keys = list(keys), [*keys, "span_id"]
    full = max(int(hz * seconds), 256)
    marks = spans.select(*base_keys, F.col("span_id").cast("long").alias("span_id"), "start", "end", F.col("target_hz").cast("double").alias("target_hz"))
    marks = reduce(lambda d, k: d.filter(F.col(k).isNotNull()), base_keys, marks)
    points = uniform.select(*base_keys, "t", "i", "v")

    def of_short(rows: DataFrame) -> DataFrame:
        src = rows.select(*keys, "i", "v", "target_hz").repartition(*keys).sortWithinPartitions(*keys, "i").drop("i")
        return src.mapInArrow(_band_shares(keys, hz, rel_width, full), StructType([*[src.schema[k] for k in keys], StructField("bandpower_ratio", DoubleType())]))

    # the grid is no denser than ``hz``
    short = F.coalesce((F.col("end") - F.col("start")) * F.lit(hz) + 2 < full, F.lit(True))
    out = of_short(points_in_spans(points, marks.filter(short), base_keys))
    marks = marks.filter(~short)
    if marks.isEmpty():
        return out
    inside = points_in_spans(points, marks, base_keys).select(*keys, "i", "v", "target_hz")
    size = durable(inside.groupBy(*keys).agg(F.min("i").alias("_f"), F.count(F.lit(1)).alias("_n"), F.avg("v").alias("_m")).filter("_n >= 4"))
    rel = inside.join(size, keys).select(*keys, (F.col("i") - F.col("_f")).alias("i"), (F.col("v") - F.col("_m")).alias("v"), "_n", "target_hz")
    out = out.unionByName(of_short(rel.filter(F.col("_n") < full)))
    sums = sp.spectrum_sums(rel.filter(F.col("_n") >= full), keys, ["v"], hz, full, full - full // 2)
    psd = sums.select(*keys, "n", F.posexplode("p").alias("bin", "p")).groupBy(*keys, "bin").agg((F.sum("p") / F.sum("n")).alias("p"))
    f = psd.join(marks.select(*keys, "target_hz"), keys)
    at = F.col("bin") * F.lit(hz) / F.lit(full)
    lo, hi = F.col("target_hz") * (1 - rel_width), F.col("target_hz") * (1 + rel_width)
    total = F.sum("p") - (F.max_by("p", "bin") + F.min_by("p", "bin")) / 2
    band_p = F.when(at.between(F.greatest(lo, F.lit(0.0)), hi), F.col("p"))
    band_k = F.when(band_p.isNotNull(), F.col("bin"))
    band = F.sum(band_p) - (F.max_by(band_p, band_k) + F.min_by(band_p, band_k)) / 2
    g = f.groupBy(*keys).agg(total.alias("_total"), band.alias("_band"))
    ratio = F.when(F.col("_total") > 0, F.coalesce("_band", F.lit(0.0)) / F.col("_total")).otherwise(F.lit(0.0))
    return out.unionByName(g.select(*keys, ratio.alias("bandpower_ratio")))


def walk_qc(
    signal: DataFrame, keys: Sequence[str], channels: Sequence[str] = CHANNELS, defaults: dict = WALK,
    segmentation: str = "gap", passes: DataFrame | None = None, min_bandpower: float | None = None,
    rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Pass table of walking recordings.

    ``segmentation`` is ``gap`` or ``rate`` (falling back to gaps where no steady rate is found);
    ``passes`` replaces it by given spans; ``whole`` treats the recording as one pass.
    """
    keys = list(keys)
    d = defaults
    uni = durable(resample_uniform(mono(signal, keys, channels), keys, "v", d["hz"]))
    strikes = heel_strikes(uni, keys, "v", d["hz"], d["height"], d["prominence"], d["max_step_hz"], rows).select(*keys, "i", "t")
    enough = strikes.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= d["least"]).select(*keys)
    strikes = durable(strikes.join(enough, keys, "left_semi"))
    events = numbered(strikes, keys, rows)
    if passes is None and segmentation == "whole":
        passes = uni.groupBy(*keys).agg(F.min("t").alias("start"), F.max("t").alias("end"))
    elif passes is None:
        gaps = gap_sessions(events, keys, d["gap_s"], d["least"], rows).select(*keys, "start", "end")
        if segmentation == "rate":
            rates = rate_segments(events, keys, d["least"])
            gaps = rates.unionByName(gaps.join(rates.select(*keys).distinct(), keys, "left_anti"))
        passes = gaps
    named = [c for c in passes.columns if c not in (*keys, "start", "end")]
    passes = durable(passes)
    res = evaluate_passes(strikes, passes.select(*keys, "start", "end"), keys, d["hz"], d["min_step_hz"], d["max_step_hz"],
                          d["period_tolerance"], d["min_coverage"])
    res = durable(res)
    spans = res.select(*keys, (F.col("start") * 1e6).cast("long").alias("span_id"), "start", "end", F.col("gait_cycle_hz").alias("target_hz"))
    bp = segment_bandpower(uni, spans, keys, d["hz"], d["rel_width"])
    out = res.withColumn("span_id", (F.col("start") * 1e6).cast("long")).join(bp, [*keys, "span_id"], "left").drop("span_id")
    out = out.withColumn("bandpower_ratio", F.coalesce("bandpower_ratio", F.lit(0.0)))
    ok = F.lit(True) if min_bandpower is None else F.col("bandpower_ratio") >= min_bandpower
    out = out.withColumn("passed", F.col("passed") & ok).withColumn("duration_s", F.col("end") - F.col("start"))
    return out.join(passes, [*keys, "start", "end"], "left") if named else out


def single_pass_qc(signal: DataFrame, keys: Sequence[str], channels: Sequence[str] = CHANNELS, **kw) -> DataFrame:
    """QC of recordings that already are one pass, with the lenient defaults."""
    return walk_qc(signal, keys, channels, PASS, "whole", **kw)


def periodic_qc(
    signal: DataFrame, keys: Sequence[str], maneuver: str, target_hz: float, tail_s: float,
    channels: Sequence[str] = CHANNELS, min_bandpower: float | None = None, rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Coverage of a recording by periods near the target, one row per recording (0 where it fails)."""
    keys = list(keys)
    d = PERIODIC[maneuver]
    hz, tol = d["hz"], d["period_tolerance"]
    m = durable(mono(signal, keys, channels))
    stop = m.groupBy(*keys).agg((F.max("t") - tail_s).alias("_stop"))
    body = m.join(stop, keys).filter(F.col("t") <= F.col("_stop")).drop("_stop")
    span = durable(body.groupBy(*keys).agg((F.max("t") - F.min("t")).alias("_total"), F.min("t").alias("start"), F.max("t").alias("end")))
    uni = durable(resample_uniform(body, keys, "v", hz))
    period = 1.0 / target_hz
    m_len = max(int(hz * min(period * 0.05, 0.25)), 3)
    smooth = moving_average(uni.withColumn("_e", F.abs("v")), keys, "_e", m_len, "sm", rows)
    tops = find_peaks(smooth, keys, "sm", d["height"], max(1, int(hz * period * (1 - tol))), rows=rows)
    times = numbered(tops.join(uni.select(*keys, "i", "t"), [*keys, "i"]), keys, rows)
    steps = running(index_blocks(times, rows=rows), keys, ["i"], {"_t0": ("last", F.col("t"))}, exclusive=True)
    step = F.col("t") - F.col("_t0")
    good = step.between(period * (1 - tol), period * (1 + tol))
    valid = steps.groupBy(*keys).agg(F.sum(F.when(good, step)).alias("_valid"))
    bp = segment_bandpower(uni, span.select(*keys, F.lit(0).alias("span_id"), "start", "end", F.lit(target_hz).alias("target_hz")),
                           keys, hz, d["rel_width"]).drop("span_id")
    every = signal.select(*keys).distinct()
    out = every.join(span, keys, "left").join(valid, keys, "left").join(bp, keys, "left")
    found = F.col("_valid").isNotNull()
    cover = F.when(found & (F.col("_total") > 0), F.col("_valid") / F.col("_total")).otherwise(F.lit(0.0))
    share = F.when(found, F.coalesce("bandpower_ratio", F.lit(0.0))).otherwise(F.lit(0.0))
    ok: Column = found & (cover >= d["min_coverage"])
    if min_bandpower is not None:
        ok = ok & (share >= min_bandpower)
    return out.select(*keys, ok.alias("passed"), cover.alias("coverage_frac"), share.alias("bandpower_ratio"))


def batch_qc(signal: DataFrame, maneuvers: DataFrame, keys: Sequence[str], target_hz: float = 0.25, tail_s: float = 5.0) -> DataFrame:
    """One result table for all recordings, each judged by the rule set of its maneuver.

    Short codes and long names of maneuvers count alike; a recording with any other name fails.
    """
    keys = list(keys)
    maneuvers = durable(maneuvers.withColumn("maneuver", sc.maneuver_name(F.col("maneuver"))))
    odd = maneuvers.filter(F.col("maneuver").isNull()).select(*keys)
    parts = [odd.select(*keys, F.lit(False).alias("passed"), F.lit(0.0).alias("coverage_frac"), F.lit(0.0).alias("bandpower_ratio"), F.lit(None).cast("string").alias("maneuver"))]
    for name in ("walk", "sit_to_stand", "flexion_extension"):
        s = signal.join(maneuvers.filter(F.col("maneuver") == name).select(*keys), keys, "left_semi")
        if name == "walk":
            p = walk_qc(s, keys)
            r = p.groupBy(*keys).agg(F.bool_and("passed").alias("passed"), F.avg("coverage_frac").alias("coverage_frac"),
                                     F.avg("bandpower_ratio").alias("bandpower_ratio"))
            r = s.select(*keys).distinct().join(r, keys, "left").select(
                *keys, F.coalesce("passed", F.lit(False)).alias("passed"),
                F.coalesce("coverage_frac", F.lit(0.0)).alias("coverage_frac"), F.coalesce("bandpower_ratio", F.lit(0.0)).alias("bandpower_ratio"),
            )
        else:
            r = periodic_qc(s, keys, name, target_hz, tail_s)
        parts.append(r.withColumn("maneuver", F.lit(name)))
    return reduce(DataFrame.unionByName, parts[1:], parts[0])
