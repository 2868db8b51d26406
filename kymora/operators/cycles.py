"""Movement cycles: cutting, shape and sound rules, artifacts and the final verdict."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from kymora.functions import kernels as kn
from kymora.operators import intervals as iv
from kymora.operators import spectral as sp
from kymora.operators.align import proximity_score
from kymora.operators.peaks import find_peaks, local_extrema
from kymora.operators.windows import envelope, neighbours, sliding_stats
from kymora.plans.blocks import BLK, BLOCK_ROWS, KEY, index_blocks, running, with_key
from kymora.plans.quantiles import quantiles
from kymora.session import durable
from kymora.sources.adapters import CHANNELS

# Cutting and shape limits in degrees, seconds and fractions of a cycle.
CUT = {
    "walk": {"spacing_s": 0.8, "prominence": 5.0},
    "sit_to_stand": {"spacing_s": 2.0, "prominence": 20.0},
    "flexion_extension": {"spacing_s": 1.8, "prominence": 10.0},
}
MIN_ROM = {"walk": 20.0, "sit_to_stand": 40.0, "flexion_extension": 40.0}
WALK_CUT_TOLERANCE = 7.5
ENERGY_THRESHOLD = 100.0
MIN_VALID_FRACTION = 0.8
# Accepted RMS range per movement phase.
PHASE_RANGES = {
    "walk": {"extension": (0.01, 10.0), "mid_phase": (0.01, 10.0), "flexion": (0.001, 5.0)},
    "sit_to_stand": {"standing": (0.001, 5.0), "transition": (0.01, 10.0), "sitting": (0.001, 5.0)},
    "flexion_extension": {"extension": (0.005, 10.0), "mid_phase": (0.01, 10.0), "flexion": (0.005, 10.0)},
}
OTHER_PHASES = {"low_angle": (0.001, 10.0), "mid_angle": (0.001, 10.0), "high_angle": (0.001, 10.0)}

CYCLE = "cycle_index"


def cut_cycles(
    synced: DataFrame, keys: Sequence[str], angle: str, fs: float, maneuver: str, rows: int = BLOCK_ROWS
) -> DataFrame:
    """Cycle bounds (keys, cycle_index, first_i, last_i) between successive angle minima."""
    keys = list(keys)
    rule = CUT[maneuver]
    src = synced.select(*keys, "i", F.col(angle).alias("a"))
    value = "a"
    if maneuver == "walk":
        src, value = sp.savgol(src, keys, "a", "smooth", rows=rows), "smooth"
    low = find_peaks(src, keys, value, None, int(rule["spacing_s"] * fs), rule["prominence"], negate=True, rows=rows)
    points = low.select(*keys, "i", "v", F.lit(0).alias("top"))
    if maneuver == "flexion_extension":
        high = find_peaks(src, keys, value, prominence=rule["prominence"], rows=rows)
        points = points.unionByName(high.select(*keys, "i", "v", F.lit(1).alias("top")))
    is_low = F.col("top") == 0
    marked = running(
        index_blocks(points, rows=rows), keys, ["i", "top"],
        {
            "_nl": ("next", F.when(is_low, F.struct("i", "v"))),
            "_nh": ("next", F.when(~is_low, F.col("i"))),
        },
        exclusive=True,
    ).filter(is_low)
    pairs = marked.filter(F.col("_nl").isNotNull())
    span = F.col("_nl.i") - F.col("i")
    if maneuver == "walk":
        ends = marked.filter(F.col("_nl").isNull()).select(*keys, F.col("i").alias("_final"))
        pairs = pairs.join(ends, keys)
        last = (F.col("_nl.i") == F.col("_final")).cast("int")
        ok = (F.abs(F.col("_nl.v") - F.col("v")) <= WALK_CUT_TOLERANCE) & (span + last > 10)
    elif maneuver == "flexion_extension":
        last = F.lit(0)
        ok = (span > 10) & (F.col("_nh") < F.col("_nl.i"))
    else:
        last = F.lit(0)
        ok = span > 10
    cuts = pairs.filter(ok).select(*keys, F.col("i").alias("first_i"), (F.col("_nl.i") - 1 + last).alias("last_i"))
    if maneuver == "sit_to_stand":
        many = low.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
        whole = synced.groupBy(*keys).agg(F.min("i").alias("first_i"), F.max("i").alias("last_i")).filter("last_i > first_i")
        cuts = cuts.unionByName(whole.join(many, keys, "left_anti"))
    return number_cycles(cuts, keys, rows)


def number_cycles(cuts: DataFrame, keys: Sequence[str], rows: int = BLOCK_ROWS) -> DataFrame:
    """Ordinal of each cycle in its recording, in order of its first sample."""
    b = index_blocks(cuts, "first_i", rows)
    n = running(b, keys, ["first_i"], {"_k": ("sum", F.lit(1))})
    return n.select(*keys, (F.col("_k") - 1).cast("int").alias(CYCLE), "first_i", "last_i")


def number_by_verdict(cycles: DataFrame, keys: Sequence[str], clean: Column, rows: int = BLOCK_ROWS) -> DataFrame:
    """Zero-based ordinal within the clean and within the outlier cycles of a recording."""
    b = index_blocks(cycles.withColumn("is_clean", clean), CYCLE, rows)
    n = running(b, [*keys, "is_clean"], [CYCLE], {"_k": ("sum", F.lit(1))})
    return n.withColumn("ordinal", (F.col("_k") - 1).cast("int")).drop("_k", BLK)


def samples_of_cycles(samples: DataFrame, cycles: DataFrame, keys: Sequence[str], rows: int = BLOCK_ROWS) -> DataFrame:
    """Samples inside a cycle, with its index: the latest cycle begun is carried along the series."""
    keys = list(keys)
    s_type = samples.select(F.struct(*[c for c in samples.columns if c not in keys]).alias("s")).schema["s"].dataType
    data = samples.select(*keys, "i", F.lit(1).alias("_side"), F.struct(*[c for c in samples.columns if c not in keys]).alias("_s"),
                          F.lit(None).cast("struct<k:int,last_i:bigint>").alias("_c"))
    marks = cycles.select(*keys, F.col("first_i").alias("i"), F.lit(0).alias("_side"), F.lit(None).cast(s_type).alias("_s"),
                          F.struct(F.col(CYCLE).alias("k"), F.col("last_i").cast("long").alias("last_i")).alias("_c"))
    both = index_blocks(data.unionByName(marks), rows=rows)
    carried = running(both, keys, ["i", "_side"], {"_in": ("last", F.col("_c"))})
    inside = carried.filter((F.col("_side") == 1) & (F.col("i") <= F.col("_in.last_i")))
    return inside.select(*keys, F.col("_in.k").alias(CYCLE), *[F.col(f"_s.{c}").alias(c) for c in samples.columns if c not in keys])


def cycle_bounds(samples: DataFrame, ck: Sequence[str]) -> DataFrame:
    """(cycle keys, first_i, n, start, end, duration)."""
    return samples.groupBy(*ck).agg(
        F.min("i").alias("first_i"), F.count(F.lit(1)).alias("n"), F.min("t").alias("start"), F.max("t").alias("end")
    ).withColumn("duration", F.col("end") - F.col("start"))


def cycle_energy(samples: DataFrame, ck: Sequence[str], channels: Sequence[str] = CHANNELS, rows: int = BLOCK_ROWS) -> DataFrame:
    """Sum over channels of the trapezoid area under the absolute signal."""
    s = neighbours(samples.select(*ck, "i", "t", *channels), ck, ["t", *channels], rows)
    dt = F.col("t") - F.col("t_prev")
    area = sum((F.abs(F.col(c)) + F.abs(F.col(f"{c}_prev")) for c in channels), F.lit(0.0)) * dt / 2
    return s.groupBy(*ck).agg(F.coalesce(F.sum(area), F.lit(0.0)).alias("acoustic_energy"))


def range_of_motion(samples: DataFrame, ck: Sequence[str], angle: str) -> DataFrame:
    a = F.expr(f"try_cast(`{angle}` AS double)")
    a = F.when(~F.isnan(a), a)
    return samples.groupBy(*ck).agg(
        F.coalesce(F.max(a) - F.min(a), F.lit(0.0)).alias("rom"),
        F.count(F.lit(1)).alias("n_rows"), F.count(a).alias("n_valid"),
    )


def cycle_statistics(cycles: DataFrame, by: Sequence[str], clean: Column) -> DataFrame:
    """Counts and duration statistics of the cycles of each synchronisation."""
    base = cycles.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_cycles"), F.count_if(clean).alias("clean_cycles"), F.count_if(~clean).alias("outlier_cycles"),
        F.avg("duration").alias("mean_duration"), F.min("duration").alias("min_duration"), F.max("duration").alias("max_duration"),
    )
    return base.join(quantiles(cycles, by, "duration", {"median_duration": 0.5}), list(by), "left")


def _valid_angle(samples: DataFrame, ck: Sequence[str], angle: str, rows: int) -> DataFrame:
    """Valid angle values with their position ``i`` renumbered inside the cycle."""
    a = F.expr(f"try_cast(`{angle}` AS double)")
    v = index_blocks(samples.select(*ck, "i", a.alias("a")).filter(F.col("a").isNotNull() & ~F.isnan("a")), rows=rows)
    n = running(v, list(ck), ["i"], {"_k": ("sum", F.lit(1).cast("long"))})
    return n.select(*ck, (F.col("_k") - 1).alias("i"), "a")


Rule = tuple[Column, str, Column]  # when it fails, its code, the value that was judged


def first_failure(rules: list[Rule], name: str) -> list[Column]:
    """<name>_ok, and the code and judged value of the first rule that fails (null where all hold)."""
    code, value = F.lit(None).cast("string"), F.lit(None).cast("double")
    for cond, reason, judged in reversed(rules):
        code = F.when(cond, F.lit(reason)).otherwise(code)
        value = F.when(cond, judged.cast("double")).otherwise(value)
    return [code.isNull().alias(f"{name}_ok"), code.alias(f"{name}_reason"), value.alias(f"{name}_value")]


def shape_rules(samples: DataFrame, ck: Sequence[str], angle: str, maneuver: str, min_rom: float | None = None, rows: int = BLOCK_ROWS) -> DataFrame:
    """Verdict on the knee-angle shape per cycle: (cycle keys, shape_ok, shape_reason, shape_value, rom)."""
    ck = list(ck)
    least = MIN_ROM.get(maneuver, 20.0) if min_rom is None else min_rom
    pre = range_of_motion(samples, ck, angle)
    v = _valid_angle(samples, ck, angle, rows)
    ends = v.groupBy(*ck).agg(F.min_by("a", "i").alias("a0"), F.max_by("a", "i").alias("a1"), F.count(F.lit(1)).alias("n"))
    info = pre.join(ends, ck, "left")
    rom = F.col("rom")
    share = 0.5 if maneuver == "sit_to_stand" else 0.3
    seated = F.col("a0") >= 45.0
    sign = F.when(F.lit(maneuver == "sit_to_stand") & seated, F.lit(-1.0)).otherwise(F.lit(1.0))
    need = info.select(*ck, F.greatest(rom * share, F.lit(5.0)).alias("prominence"), sign.alias("_sign"))
    # only where a cycle may start seated is its sign looked up for every sample
    signed = v.join(need, ck).select(*ck, "i", (F.col("a") * F.col("_sign")).alias("a")) if maneuver == "sit_to_stand" else v
    tops = find_peaks(signed, ck, "a", per_key=need, rows=rows)
    p = tops.groupBy(*ck).agg(
        F.count(F.lit(1)).alias("n_peaks"), F.min("i").alias("first_peak"),
        F.max_by(F.struct("i", "v"), F.struct("v", (-F.col("i")).alias("o"))).alias("best"),
    )
    d = info.join(p, ck, "left").withColumn("n_peaks", F.coalesce("n_peaks", F.lit(0)))
    diff = F.abs(F.col("a1") - F.col("a0"))
    best = F.col("best.i") / F.col("n")
    filled = F.col("n_valid") / F.col("n_rows")
    first = F.col("first_peak") / F.col("n")
    rule: list[Rule] = [
        (F.col("n_rows") < 10, "few_samples", F.col("n_rows")),
        (F.col("n_valid") == 0, "no_values", F.col("n_valid")),
        (filled < MIN_VALID_FRACTION, "low_valid_share", filled),
        (F.col("n_valid") < 10, "few_values", F.col("n_valid")),
        (rom < least, "small_range", rom),
    ]
    if maneuver == "walk":
        rule += [
            (diff > 10.0, "open_ends", diff),
            (F.col("n_peaks") == 0, "no_peak", F.col("n_peaks")),
            (F.col("n_peaks") > 2, "extra_peaks", F.col("n_peaks")),
            (~first.between(0.2, 0.8), "peak_position", first),
        ]
    elif maneuver == "flexion_extension":
        rule += [
            (diff > 15.0, "open_ends", diff),
            (F.col("n_peaks") == 0, "no_peak", F.col("n_peaks")),
            (F.col("n_peaks") > 3, "extra_peaks", F.col("n_peaks")),
            (~best.between(0.25, 0.75), "peak_position", best),
        ]
    elif maneuver == "sit_to_stand":
        depth = F.when(seated, F.col("a0") + F.col("best.v")).otherwise(F.col("best.v") - F.col("a0"))
        rule += [
            (diff > 20.0, "open_ends", diff),
            (F.col("n_peaks") == 0, "no_peak", F.col("n_peaks")),
            (~best.between(0.15, 0.85), "peak_position", best),
            (depth < rom * 0.5, "small_depth", depth),
        ]
    return d.select(*ck, *first_failure(rule, "shape"), "rom")


def two_stage(energy: DataFrame, shape: DataFrame, ck: Sequence[str], threshold: float = ENERGY_THRESHOLD) -> DataFrame:
    """Clean when loud enough and well shaped; the first failing stage gives the reason."""
    low = F.col("acoustic_energy") < threshold
    return energy.join(shape, list(ck)).select(
        *ck, "acoustic_energy", "rom", low.alias("energy_fail"), (~F.col("shape_ok")).alias("shape_fail"),
        (low | ~F.col("shape_ok")).alias("is_outlier"),
        F.when(low, F.lit("low_acoustic_energy")).when(~F.col("shape_ok"), F.col("shape_reason")).alias("outlier_reason"),
    )


def _envelope(samples: DataFrame, ck: Sequence[str], channels: Sequence[str]) -> DataFrame:
    return samples.select(*ck, "i", "t", envelope(list(channels)).alias("env"))


def _known(df: DataFrame, ck: Sequence[str]) -> DataFrame:
    """Rows of cycles whose key has no null part."""
    return df.filter(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in ck]))


def _envelope_stats(env: DataFrame, ck: Sequence[str], thirds: bool) -> DataFrame:
    """Length and moments of the envelope of each cycle with a key, with ``thirds`` the mean of each third too."""
    ck = list(ck)
    env = _known(env, ck)
    base = env.groupBy(*ck).agg(
        F.min("i").alias("first_i"), F.count(F.lit(1)).alias("n"), F.avg("env").alias("m"), F.stddev_pop("env").alias("s"),
        F.min("env").alias("lo"), F.max("env").alias("hi"),
    )
    if not thirds:
        return base
    third = F.floor(F.col("n") / 3)
    pos = F.col("i") - F.col("first_i")
    part = F.when(pos < third, 1).when(pos < 2 * third, 2).otherwise(3)
    parts = env.join(base.select(*ck, "first_i", "n"), ck).withColumn("_part", part).groupBy(*ck).agg(
        *[F.avg(F.when(F.col("_part") == k, F.col("env"))).alias(f"m{k}") for k in (1, 2, 3)]
    )
    return base.join(parts, ck)


def sound_rules(samples: DataFrame, ck: Sequence[str], maneuver: str, channels: Sequence[str] = CHANNELS, min_rms: float = 0.001, rows: int = BLOCK_ROWS) -> DataFrame:
    """Verdict on the acoustic envelope per cycle: (cycle keys, sound_ok, sound_reason, sound_value)."""
    env = _envelope(samples, ck, channels)
    extrema = local_extrema(env, ck, "env", rows) if maneuver in ("walk", "flexion_extension") else None
    return _sound_rules(env, _envelope_stats(env, ck, maneuver == "sit_to_stand"), extrema, ck, maneuver, min_rms, rows)


def _sound_rules(env: DataFrame, st: DataFrame, extrema: DataFrame | None, ck: Sequence[str], maneuver: str, min_rms: float = 0.001, rows: int = BLOCK_ROWS) -> DataFrame:
    """``sound_rules`` from the envelope, its statistics and (walk, flexion) its extrema."""
    ck = list(ck)
    cv = F.col("s") / F.col("m")
    rule: list[Rule] = [(F.col("hi") < min_rms, "quiet", F.col("hi"))]
    if maneuver in ("walk", "flexion_extension"):
        need = st.select(*ck, F.greatest((F.col("hi") - F.col("lo")) * 0.2, F.col("m") * 0.5).alias("prominence"))
        tops = find_peaks(env.select(*ck, "i", "env"), ck, "env", per_key=need, rows=rows, extrema=extrema)
        tops = tops.join(st.select(*ck, "first_i", "n"), ck).withColumn("pos", (F.col("i") - F.col("first_i")) / F.col("n"))
        p = tops.groupBy(*ck).agg(
            F.count(F.lit(1)).alias("n_peaks"), F.max_by("pos", F.struct("v", (-F.col("i")).alias("o"))).alias("main"),
            F.count_if(F.col("pos").between(0.3, 0.7)).alias("n_mid"),
        )
        st = st.join(p, ck, "left").withColumn("n_peaks", F.coalesce("n_peaks", F.lit(0)))
    checked = maneuver in ("walk", "flexion_extension", "sit_to_stand")
    if checked:
        rule += [(F.col("n") < 10, "few_samples", F.col("n")), (F.col("m") == 0, "zero_mean", F.col("m"))]
    if maneuver == "walk":
        rule += [
            (cv < 0.1, "flat", cv),
            (F.col("n_peaks") == 0, "no_peak", F.col("n_peaks")),
            (F.col("main") > 0.8, "peak_position", F.col("main")),
        ]
    elif maneuver == "flexion_extension":
        rule += [
            (cv < 0.15, "flat", cv),
            (F.col("n_peaks") == 0, "no_peak", F.col("n_peaks")),
            (F.col("n_mid") == 0, "no_middle_peak", F.col("n_mid")),
        ]
    elif maneuver == "sit_to_stand":
        ratio = F.col("m2") / F.greatest("m1", "m3")
        rule += [
            ((F.col("m2") < F.col("m1")) | (F.col("m2") < F.col("m3")), "no_middle_rise", ratio),
            (ratio < 1.2, "small_middle_rise", ratio),
        ]
    return st.select(*ck, *first_failure(rule, "sound"))


def sync_quality(
    samples: DataFrame, ck: Sequence[str], angle: str, maneuver: str, channels: Sequence[str] = CHANNELS, rows: int = BLOCK_ROWS
) -> DataFrame:
    """Cross-check of sound against motion: (cycle keys, sync_qc_pass, sync_quality_score)."""
    ck = list(ck)
    env = _envelope(samples, ck, channels)
    # statistics and extrema of the envelope serve both the sound rules and the check against motion
    st = durable(_envelope_stats(env, ck, maneuver == "sit_to_stand"))
    extrema = local_extrema(env, ck, "env", rows)
    sound = _sound_rules(env, st, extrema, ck, maneuver, rows=rows)
    a = F.expr(f"try_cast(`{angle}` AS double)")
    a = F.when(~F.isnan(a), a)
    ang = samples.groupBy(*ck).agg(F.count(a).alias("n_valid"), F.min(a).alias("a_lo"), F.max(a).alias("a_hi"))
    need = st.select(*ck, ((F.col("hi") - F.col("lo")) * 0.2).alias("prominence"))
    tops = find_peaks(env.select(*ck, "i", "env"), ck, "env", per_key=need, rows=rows, extrema=extrema)
    n_tops = tops.groupBy(*ck).agg(F.count(F.lit(1)).alias("n_peaks"))
    d = sound.join(st, ck).join(ang, ck, "left").join(n_tops, ck, "left")
    flat = (F.col("n_valid") < 10) | (F.col("hi") - F.col("lo") <= 0) | F.coalesce(F.col("n_peaks") == 0, F.lit(True))
    if maneuver == "walk":
        moving = samples.select(*ck, "i", a.alias("a")).filter(F.col("a").isNotNull())
        dips = find_peaks(moving, ck, "a", prominence=5.0, negate=True, rows=rows)
        far = st.select(*ck, (F.col("n") * 0.15).alias("far"))
        score = proximity_score(
            tops.join(far, ck).select(*ck, "i", F.col("i").cast("double").alias("t"), "far"),
            dips.select(*ck, "i", F.col("i").cast("double").alias("t")), ck, F.col("far"),
        ).select(*ck, "score")
        n_dips = dips.groupBy(*ck).agg(F.count(F.lit(1)).alias("n_dips"))
        d = d.join(score, ck, "left").join(n_dips, ck, "left")
        flat = flat | F.coalesce(F.col("n_dips") == 0, F.lit(True))
        cross, ok = F.col("score"), F.col("score") >= 0.3
    elif maneuver == "sit_to_stand":
        ratio = F.col("m2") / F.greatest(F.col("m1"), F.col("m3"), F.lit(1e-10))
        flat = flat | (F.floor(F.col("n") / 3) < 2)
        cross, ok = F.least(ratio / 2, F.lit(1.0)), ratio >= 1.1
    elif maneuver == "flexion_extension":
        at = tops.join(samples.select(*ck, "i", a.alias("a")), [*ck, "i"]).join(ang, ck)
        mid = F.col("a_lo") + (F.col("a_hi") - F.col("a_lo")) * 0.5
        near = at.groupBy(*ck).agg(F.count_if(F.abs(F.col("a") - mid) < (F.col("a_hi") - F.col("a_lo")) * 0.3).alias("n_near"))
        d = d.join(near, ck, "left")
        cross = F.coalesce("n_near", F.lit(0)) / F.col("n_peaks")
        ok = cross >= 0.3
    else:
        cross, ok = F.lit(0.5), F.col("sound_ok")
    return d.select(
        *ck,
        F.when(~F.col("sound_ok"), F.lit(False)).when(flat, F.lit(True)).otherwise(ok).alias("sync_qc_pass"),
        F.when(~F.col("sound_ok"), F.lit(0.0)).when(flat, F.lit(0.5)).otherwise(cross).alias("sync_quality_score"),
    )


def phase_levels(
    samples: DataFrame, ck: Sequence[str], angle: str, channels: Sequence[str] = CHANNELS, maneuver: str = "walk"
) -> DataFrame:
    """Mean channel RMS in each third of the angle range: (cycle keys, phase, n, phase_rms, in_range).

    The 33rd and 67th percentile cut the phases; a sample on a cut belongs to both sides.
    """
    ck = list(ck)
    names = PHASE_RANGES.get(maneuver, OTHER_PHASES)
    valid = samples.filter(F.col(angle).isNotNull() & ~F.isnan(angle))
    q = quantiles(valid, ck, angle, {"p33": 0.33, "p67": 0.67})
    enough = valid.groupBy(*ck).agg(F.count(F.lit(1)).alias("_n")).filter("_n >= 10").select(*ck)
    q = q.join(enough, ck, "left_semi")
    x = F.col(angle)
    labels = list(names)
    member = F.array_compact(F.array(
        F.when(x <= F.col("p33"), F.lit(labels[0])),
        F.when(x.between(F.col("p33"), F.col("p67")), F.lit(labels[1])),
        F.when(x >= F.col("p67"), F.lit(labels[2])),
    ))
    per = valid.join(q, ck).withColumn("phase", F.explode(member)).groupBy(*ck, "phase").agg(
        F.count(F.lit(1)).alias("n"), *[F.sqrt(F.avg(F.col(c) * F.col(c))).alias(f"_r_{c}") for c in channels]
    )
    level = sum((F.col(f"_r_{c}") for c in channels[1:]), F.col(f"_r_{channels[0]}")) / len(channels)
    level = F.when(F.col("n") >= 5, level)
    inside = reduce(
        lambda acc, kv: F.when(F.col("phase") == kv[0], F.col("phase_rms").between(*kv[1])).otherwise(acc), names.items(), F.lit(True)
    )
    return per.select(*ck, "phase", "n", level.alias("phase_rms")).withColumn("in_range", F.coalesce(inside, F.lit(False)))


def phase_score(levels: DataFrame, ck: Sequence[str]) -> DataFrame:
    """Share of phases in range (a phase without samples counts as out) and its pass mark of 0.75."""
    s = levels.groupBy(*ck).agg((F.count_if("in_range") / F.lit(3)).alias("phase_score"))
    return s.withColumn("phase_pass", F.col("phase_score") >= 0.75)


def intermittent_artifacts(
    samples: DataFrame, ck: Sequence[str], fs: float, channels: Sequence[str] = CHANNELS, fast_s: float = 0.005,
    slow_s: float = 0.05, sigma: float = 3.5, min_s: float = 0.05, max_s: float = 4.0, rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Bursts inside a cycle: short RMS above the slower RMS by ``sigma`` slow deviations."""
    fast = max(int(fs * fast_s), 3)
    slow = max(int(fs * slow_s), fast * 2)
    base = samples.select(*ck, "i", "t", *channels)
    quick = sliding_stats(base, ck, channels, fast, ("rms",), rows).withColumnsRenamed({f"{c}_rms": f"{c}_fast" for c in channels})
    both = sliding_stats(quick, ck, channels, slow, ("rms", "std"), rows)
    flags = [(F.col(f"{c}_fast") > F.col(f"{c}_rms") + sigma * F.col(f"{c}_std")).alias(c) for c in channels]
    runs = iv.flags_to_intervals(both.select(*ck, "i", "t", *flags), ck, {c: c for c in channels}, 0.0, rows)
    return iv.duration_band(runs, min_s, max_s)


def cycle_artifacts(parts: dict[str, DataFrame], ck: Sequence[str]) -> DataFrame:
    """Long table (cycle keys, channel, kind, start, end): each kind plus ``all`` merged per channel."""
    cols = [*ck, "channel", "kind", "start", "end"]
    tagged = [p.withColumn("kind", F.lit(k)).select(*cols) for k, p in parts.items()]
    long = durable(reduce(DataFrame.unionByName, tagged))  # read again by every pass of the merge
    merged = iv.merge_intervals(long.select(*ck, "channel", "start", "end"), [*ck, "channel"])
    return long.unionByName(merged.withColumn("kind", F.lit("all")).select(*cols))


def resample_cycles(env: DataFrame, ck: Sequence[str], value: str, length: int) -> DataFrame:
    """Each cycle's series brought to ``length`` points by linear interpolation on position.

    Every pair of neighbouring samples yields the few target points between them, so the work is on
    sample rows and a cycle of any length spreads over its blocks.
    """
    ck = list(ck)
    size = env.groupBy(*ck).agg(F.min("i").alias("_f"), F.count(F.lit(1)).alias("_n"))
    s = neighbours(env.select(*ck, "i", F.col(value).alias("y")), ck, ["y"]).join(size, ck)
    pos = F.col("i") - F.col("_f")
    scale = F.lit(float(length - 1)) / (F.col("_n") - 1)
    from_k = F.ceil(pos * scale - 1e-9).cast("int")
    to_k = F.when(F.col("y_next").isNull(), F.lit(length - 1)).otherwise((F.ceil((pos + 1) * scale - 1e-9) - 1).cast("int"))
    spots = F.when(F.col("_n") == 1, F.sequence(F.lit(0), F.lit(length - 1))).when(to_k >= from_k, F.sequence(from_k, to_k))
    out = s.withColumn("k", F.explode(spots))
    w = F.greatest(F.col("k") / scale - pos, F.lit(0.0))
    y = F.when(F.col("y_next").isNull(), F.col("y")).otherwise(F.col("y") + (F.col("y_next") - F.col("y")) * w)
    return out.select(*ck, "k", y.alias("y"))


TEMPLATES = 1024  # templates that are compared at once


def _against(y: DataFrame, refs: pa.Array, points: np.ndarray, ck: list[str], kind: str, min_r: float, max_dtw: float | None, work: bool) -> DataFrame:
    """Cycles (ck, y ARRAY) against a block of templates, a matrix of cycles with a matrix of templates at a time."""
    head = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in y.select(*ck).schema)
    scaled = kn.znorm_rows(points)
    flat = points.max(axis=1) == points.min(axis=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                x = np.array(part.column("y").to_pylist(), float).reshape(part.num_rows, -1)
                z = kn.znorm_rows(x)
                r = z @ scaled.T / scaled.shape[1]
                r[x.max(axis=1) == x.min(axis=1)] = np.nan
                r[:, flat] = np.nan
                at, to = np.nonzero(r >= min_r) if max_dtw is not None else (np.repeat(np.arange(len(x)), len(refs)), np.tile(np.arange(len(refs)), len(x)))
                keys = lambda rows: [part.column(c).take(pa.array(rows)) for c in ck]
                if max_dtw is None:
                    told = pa.array(r[at, to], from_pandas=True)
                    yield pa.RecordBatch.from_arrays([*keys(at), refs.take(pa.array(to)), told, pa.array(np.nan_to_num(r[at, to], nan=-np.inf) >= min_r)], [*ck, "template", "r", "match"])
                    continue
                near = np.concatenate([kn.warped_bound(z[at[k : k + 4096]], scaled[to[k : k + 4096]]) <= max_dtw * (1 + 1e-9) for k in range(0, len(at), 4096)] or [np.zeros(0, bool)])
                correlated, at, to = np.bincount(at, minlength=len(x)), at[near], to[near]
                if work:
                    yield pa.RecordBatch.from_arrays([*keys(np.arange(len(x))), pa.array(np.full(len(x), len(refs))), pa.array(correlated), pa.array(np.bincount(at, minlength=len(x)))], [*ck, "n_templates", "n_correlated", "n_warped"])
                    continue
                d = np.concatenate([kn.warped(z[at[k : k + 4096]], scaled[to[k : k + 4096]], max_dtw) for k in range(0, len(at), 4096)] or [np.zeros(0)])
                hit = d <= max_dtw
                at, to, d = at[hit], to[hit], d[hit]
                yield pa.RecordBatch.from_arrays([*keys(at), refs.take(pa.array(to)), pa.array(r[at, to]), pa.array(d)], [*ck, "template", "r", "dtw"])

    if work:
        return y.mapInArrow(run, f"{head}, n_templates bigint, n_correlated bigint, n_warped bigint")
    last = "match boolean" if max_dtw is None else "dtw double"
    return y.mapInArrow(run, f"{head}, template {kind}, r double, {last}")


def template_match(
    env: DataFrame, templates: DataFrame, ck: Sequence[str], value: str, length: int, min_r: float = 0.5, max_dtw: float | None = None,
    work: bool = False, block: int = TEMPLATES,
) -> DataFrame:
    """Cycles against templates (template, k, ref) of ``length`` points each.

    Without ``max_dtw``: Pearson r of every cycle with every template and whether it reaches ``min_r``. With it: the
    hits alone (ck, template, r, dtw), whose r reaches ``min_r`` and whose warped distance is at most ``max_dtw``. The
    distance is computed only where a lower bound leaves it open; ``work`` gives (ck, n_templates, n_correlated,
    n_warped) instead, which tells for how many. Templates are the query set: they are taken in blocks of about
    ``block``, each of which meets the cycles of a task as one matrix.
    """
    ck = list(ck)
    y = resample_cycles(env, ck, value, length).groupBy(*ck).agg(F.array_sort(F.collect_list(F.struct("k", "y"))).alias("_s"))
    y = durable(y.select(*ck, F.col("_s.y").alias("y")))
    kind = templates.schema["template"].dataType
    t = templates.groupBy("template").agg(F.array_sort(F.collect_list(F.struct("k", F.col("ref").cast("double").alias("ref")))).alias("_s"))
    t = durable(t.select("template", F.col("_s.ref").alias("ref")))
    blocks = max(1, -(-t.count() // block))
    out: DataFrame | None = None
    for b in range(blocks):
        held = t.filter(F.pmod(F.xxhash64("template"), F.lit(blocks)) == b).orderBy("template").collect()  # about ``block`` rows of ``length`` points
        if not held:
            continue
        points = np.array([r["ref"] for r in held], float).reshape(len(held), -1)
        refs = pa.array([r["template"] for r in held], to_arrow_type(kind))
        got = _against(y, refs, points, ck, kind.simpleString(), min_r, max_dtw, work)
        out = got if out is None else out.unionByName(got)
    if out is None:
        raise ValueError("there are no templates")
    return out.groupBy(*ck).agg(*[F.sum(c).alias(c) for c in ("n_templates", "n_correlated", "n_warped")]) if work else out


def best_template(hits: DataFrame, ck: Sequence[str]) -> DataFrame:
    """The hit of the least warped distance of each cycle; ties go to the lowest template."""
    rest = F.struct("template", "r", "dtw")
    return hits.groupBy(*ck).agg(F.min_by(rest, F.struct("dtw", "template")).alias("_h")).select(*ck, "_h.*")


def periodic_noise(samples: DataFrame, ck: Sequence[str], fs: float, channels: Sequence[str] = CHANNELS, threshold: float = 0.3) -> DataFrame:
    """Whole-cycle periodic noise per channel: averaged Welch spectrum, peak over median above 5 Hz.

    A block of a cycle travels once with all channels and adds up the spectra of its Welch segments; the sums of a
    cycle of several blocks are put together by a shuffle.
    """
    ck = list(ck)
    size = samples.groupBy(*ck).agg(F.min("i").alias("_f"), F.count(F.lit(1)).alias("_n")).filter("_n >= 256")
    nper = int(fs * 2)
    rel = samples.join(size, ck).select(*ck, (F.col("i") - F.col("_f")).alias("i"), "_n", *channels)
    short = size.filter(F.col("_n") < nper)
    sums = sp.spectrum_sums(rel.filter(F.col("_n") >= nper), ck, channels, fs, nper, nper - nper // 2)
    by = [*ck, "channel"]
    many = durable(sums.filter(F.col(BLK) > 0).select(*by).distinct())
    mean = sums.select(*by, F.transform("p", lambda x: x / F.nullif(F.col("n"), F.lit(0))).alias("p"))
    if not many.isEmpty():
        bins = sums.join(many, by, "left_semi").select(*by, "n", F.posexplode("p").alias("bin", "p"))
        avg = bins.groupBy(*by, "bin").agg((F.sum("p") / F.nullif(F.sum("n"), F.lit(0))).alias("p"))
        far = avg.groupBy(*by).agg(F.transform(F.array_sort(F.collect_list(F.struct("bin", "p"))), lambda x: x["p"]).alias("p"))
        mean = mean.join(many, by, "left_anti").unionByName(far)
    low = sum(k * fs / nper <= 5.0 for k in range(nper // 2 + 1))  # bins up to 5 Hz don't count
    ranked = mean.select(*by, F.array_sort(F.slice("p", low + 1, max(nper // 2 + 1 - low, 0))).alias("p")).filter(F.size("p") > 0)
    half = (F.size("p") - 1) / F.lit(2)
    mid = F.get("p", F.floor(half).cast("int")) * 0.5 + F.get("p", F.ceil(half).cast("int")) * 0.5
    spec = ranked.select(*by, F.element_at("p", -1).alias("peak"), mid.alias("mid"))
    flags = spec.select(*ck, "channel", F.coalesce((F.col("mid") > 0) & (F.col("peak") / F.col("mid") > 1 / threshold), F.lit(False)).alias("periodic"))
    # cycles shorter than one segment are a single frame of their own length
    small = rel.join(short.select(*ck), ck, "left_semi").unpivot([*ck, "i"], list(channels), "channel", "x")
    arrays = small.groupBy(*ck, "channel").agg(F.array_sort(F.collect_list(F.struct("i", "x"))).alias("s"))
    nb = sp.narrowband(F.col("s.x"), fs, nper)
    return flags.unionByName(arrays.select(*ck, "channel", (nb["ratio"] > 1 / threshold).alias("periodic")))


def verdicts(
    two: DataFrame, artifacts: DataFrame, sync: DataFrame, ck: Sequence[str], bad_overall: DataFrame | None = None,
    bad_channel: DataFrame | None = None, channels: Sequence[str] = CHANNELS,
) -> DataFrame:
    """Final row per cycle: overall and per-microphone audio flags, sync score, clean or outlier.

    Bad-interval overlap is added to the artifact failures, not put in their place.
    """
    ck = list(ck)
    hit = artifacts.filter(F.col("kind").isin("intermittent", "periodic")).groupBy(*ck).agg(
        *[F.max((F.col("kind") == k).cast("int")).alias(f"_any_{k}") for k in ("intermittent", "periodic")],
        *[F.max((F.col("channel") == c).cast("int")).alias(f"_hit_{c}") for c in channels],
    )
    d = two.join(hit, ck, "left").join(sync, ck, "left")
    bad_all = F.lit(False)
    if bad_overall is not None:
        d = d.join(bad_overall.select(*ck, F.col("in_bad_interval").alias("_bad")), ck, "left")
        bad_all = F.coalesce("_bad", F.lit(False))
    mic_bad = {c: F.lit(False) for c in channels}
    if bad_channel is not None:
        wide = bad_channel.filter("in_bad_interval").groupBy(*ck).agg(
            *[F.max((F.col("channel") == c).cast("int")).alias(f"_badmic_{c}") for c in channels]
        )
        d = d.join(wide, ck, "left")
        mic_bad = {c: F.coalesce(F.col(f"_badmic_{c}") == 1, F.lit(False)) for c in channels}
    flag = lambda n: F.coalesce(F.col(n) == 1, F.lit(False))
    inter, peri = flag("_any_intermittent"), flag("_any_periodic")
    return d.select(
        *ck, "acoustic_energy", "energy_fail", "shape_fail", "outlier_reason",
        inter.alias("intermittent_detected"), peri.alias("periodic_detected"),
        (~(inter | peri | bad_all)).alias("audio_qc_pass"),
        *[(~(flag(f"_hit_{c}") | mic_bad[c])).alias(f"audio_qc_{c}_pass") for c in channels],
        F.col("sync_qc_pass"), F.col("sync_quality_score"),
        (F.col("is_outlier") | bad_all).alias("is_outlier"),
    )


def rollup(periodic: DataFrame, sound: DataFrame, ck: Sequence[str], fail_on_periodic: bool = False) -> DataFrame:
    """One verdict from noise and sound shape: (cycle keys, periodic_noise, noise_ok, sound_ok, sound_reason, overall_ok).

    ``periodic`` has a flag per cycle and channel; noise fails a cycle only with ``fail_on_periodic``.
    """
    noisy = periodic.groupBy(*ck).agg(F.bool_or(F.coalesce("periodic", F.lit(False))).alias("periodic_noise"))
    d = with_key(sound, ck).join(with_key(noisy, ck).select(KEY, "periodic_noise"), KEY, "left").drop(KEY)
    noise = F.coalesce("periodic_noise", F.lit(False))
    ok = ~(noise & F.lit(fail_on_periodic))
    return d.select(*ck, noise.alias("periodic_noise"), ok.alias("noise_ok"), "sound_ok", "sound_reason", (ok & F.col("sound_ok")).alias("overall_ok"))


def overall_artifact_types(per_channel: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, artifact_types): each type once, in the order of channel and start at which it first occurs."""
    first = per_channel.groupBy(*keys, "artifact_type").agg(F.min(F.struct("channel", "start")).alias("at"))
    listed = F.array_sort(F.collect_list(F.struct("at", "artifact_type")))
    return first.groupBy(*keys).agg(F.transform(listed, lambda x: x["artifact_type"]).alias("artifact_types"))


def artifact_record(
    cycles: DataFrame, intervals: DataFrame, ck: Sequence[str], kinds: Sequence[str] = ("dropout", "continuous", "intermittent", "periodic"),
    channels: Sequence[str] = CHANNELS, recorded_at: Column | None = None,
) -> DataFrame:
    """Wide cycle record: failure tags, a flag and a flat timestamp array per kind and channel."""
    ck = list(ck)
    pair = F.struct("start", "end")

    def flat(cond: Column) -> Column:
        return iv.flatten_pairs(F.array_sort(F.collect_list(F.when(cond, pair))))

    aggs = []
    for k in kinds:
        aggs.append(flat(F.col("kind") == k).alias(f"{k}_timestamps"))
        aggs += [flat((F.col("kind") == k) & (F.col("channel") == c)).alias(f"{k}_timestamps_{c}") for c in channels]
    wide = intervals.groupBy(*ck).agg(*aggs)
    d = cycles.join(wide, ck, "left")
    names = [f"{k}_timestamps{s}" for k in kinds for s in ("", *[f"_{c}" for c in channels])]
    has = lambda n: F.coalesce(F.size(n) > 0, F.lit(False))
    tags = F.array_compact(F.array(*[F.when(has(f"{k}_timestamps"), F.lit(k)) for k in kinds]))
    out = d.select(
        *cycles.columns,
        F.when(F.size(tags) > 0, tags).alias("audio_qc_failures"), (F.size(tags) > 0).alias("audio_qc_fail"),
        *[has(n).alias(n.replace("_timestamps", "_fail")) for n in names],
        *[F.when(F.size(n) > 0, F.col(n)).alias(n) for n in names],
    )
    if recorded_at is not None:
        at = lambda s: recorded_at + F.make_dt_interval(secs=F.col(s).cast("decimal(18,6)"))
        out = out.withColumn("start_time", at("start")).withColumn("end_time", at("end"))
    return out
