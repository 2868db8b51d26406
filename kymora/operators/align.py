"""Alignment of differently sampled series: as-of, interpolation, resampling, shifting and clipping."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from kymora.operators.windows import steps
from kymora.plans.blocks import BLK, BLOCK_ROWS, KEY, index_blocks, range_blocks, running, whole_groups, with_key
from kymora.plans.quantiles import quantiles
from kymora.session import durable

MARGIN_S = 0.5
MIN_TOLERANCE_S = 0.02


def time_neighbours(
    left: DataFrame, right: DataFrame, keys: Sequence[str], t: str = "t", left_id: str = "i", right_id: str = "i"
) -> DataFrame:
    """Each left row with ``prev`` (latest right row at or before it) and ``next`` (first one after it).

    Both sides are laid into one ordered series; a scan over it carries right rows forward and
    backward. There is no inequality join, and a long series spreads over all its range partitions.
    """
    keys = list(keys)
    l_cols = [c for c in left.columns if c not in keys]
    r_cols = [c for c in right.columns if c not in keys]
    l_type = left.select(F.struct(*l_cols).alias("s")).schema["s"].dataType
    r_type = right.select(F.struct(*r_cols).alias("s")).schema["s"].dataType
    a = left.select(
        *keys, F.col(t).alias("_t"), F.lit(1).alias("_side"), F.col(left_id).cast("long").alias("_k"),
        F.struct(*l_cols).alias("_l"), F.lit(None).cast(r_type).alias("_r"),
    )
    b = right.filter(F.col(t).isNotNull()).select(
        *keys, F.col(t).alias("_t"), F.lit(0).alias("_side"), F.col(right_id).cast("long").alias("_k"),
        F.lit(None).cast(l_type).alias("_l"), F.struct(*r_cols).alias("_r"),
    )
    order = ["_t", "_side", "_k"]
    cut = range_blocks(a.unionByName(b), keys, order)
    scan = running(cut, keys, order, {"prev": ("last", F.col("_r")), "next": ("next", F.col("_r"))})
    return scan.filter("_side = 1").select(*keys, *[F.col(f"_l.{c}").alias(c) for c in l_cols], "prev", "next")


def asof_nearest(
    left: DataFrame, right: DataFrame, keys: Sequence[str], tolerance: Column | float, t: str = "t",
    left_id: str = "i", right_id: str = "i", prefix: str = "r_",
) -> DataFrame:
    """Nearest right row within ``tolerance``; an equal distance picks the earlier one."""
    near = time_neighbours(left, right, keys, t, left_id, right_id)
    back = F.col(t) - F.col(f"prev.{t}")
    ahead = F.col(f"next.{t}") - F.col(t)
    pick = F.when(ahead.isNull() | (back <= ahead), F.col("prev")).otherwise(F.col("next"))
    gap = F.abs(F.col(t) - F.col(f"_pick.{t}"))
    tol = tolerance if isinstance(tolerance, Column) else F.lit(float(tolerance))
    picked = near.withColumn("_pick", pick).withColumn("_pick", F.when(gap <= tol, F.col("_pick")))
    r_cols = [c for c in right.columns if c not in keys]
    return picked.select(*left.columns, *[F.col(f"_pick.{c}").alias(f"{prefix}{c}") for c in r_cols])


def step_tolerance(motion: DataFrame, keys: Sequence[str], rows: int = BLOCK_ROWS) -> DataFrame:
    """As-of tolerance per recording: the larger of 20 ms and the median motion step."""
    q = quantiles(steps(motion.select(*keys, "i", "t"), keys, "t", rows), keys, "step", {"_step": 0.5})
    return q.select(*keys, F.greatest(F.lit(MIN_TOLERANCE_S), F.col("_step")).alias("tolerance"))


def interpolate_inside(df: DataFrame, keys: Sequence[str], columns: Sequence[str], rows: int = BLOCK_ROWS) -> DataFrame:
    """Fill nulls linearly by row position between known values; ends stay null."""
    specs = {}
    for c in columns:
        known = F.when(F.col(c).isNotNull(), F.struct("i", F.col(c).alias("v")))
        specs[f"_p_{c}"] = ("last", known)
        specs[f"_n_{c}"] = ("next", known)
    s = running(index_blocks(df, rows=rows), keys, ["i"], specs)

    def filled(c: str) -> Column:
        p, n = F.col(f"_p_{c}"), F.col(f"_n_{c}")
        w = (F.col("i") - p["i"]) / (n["i"] - p["i"])
        return F.coalesce(F.col(c), p["v"] + (n["v"] - p["v"]) * w).alias(c)

    return s.select(*[filled(c) if c in columns else F.col(c) for c in df.columns])


def uniform_grid(series: DataFrame, keys: Sequence[str], fs: float, t: str = "t", rows: int = BLOCK_ROWS) -> DataFrame:
    """(keys, i, t): evenly spaced times from the first to the last sample."""
    b = series.groupBy(*keys).agg(F.min(t).alias("_t0"), F.max(t).alias("_t1")).filter("_t1 > _t0")
    n = F.floor((F.col("_t1") - F.col("_t0")) * F.lit(fs)).cast("long") + 1
    b = b.withColumn("_n", n)
    # two short sequences instead of one as long as the recording
    b = b.withColumn("_b", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / rows).cast("long"))))
    b = b.repartition(*keys, "_b")
    last = F.least((F.col("_b") + 1) * rows, F.col("_n")) - 1
    b = b.withColumn("i", F.explode(F.sequence(F.col("_b") * rows, last)))
    step = F.when(F.col("_n") > 1, (F.col("_t1") - F.col("_t0")) / (F.col("_n") - 1)).otherwise(F.lit(0.0))
    at = F.when((F.col("_n") > 1) & (F.col("i") == F.col("_n") - 1), F.col("_t1")).otherwise(F.col("_t0") + F.col("i") * step)
    return b.select(*keys, "i", at.alias(t))


def _onto_grid(group: Sequence[str], rows: int):
    """Values on the grid points of sorted blocks; a block begins with a row of its grid (``_t`` first time, ``_v`` last, ``_k`` points)."""

    def work(table: pa.Table, at: np.ndarray) -> pa.RecordBatch:
        blk, t, k, v = (table.column(c).to_numpy() for c in (BLK, "_t", "_k", "_v"))
        starts = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
        spots, points, times, values = [], [], [], []
        for a, b in zip(starts.tolist(), np.append(starts[1:], len(at)).tolist()):
            n, seen, x = int(k[a]), t[a + 1 : b], v[a + 1 : b]
            i = np.arange(int(blk[a]) * rows, min((int(blk[a]) + 1) * rows, n))
            g = t[a] + i * ((v[a] - t[a]) / (n - 1) if n > 1 else 0.0)
            if n > 1 and i[-1] == n - 1:
                g[-1] = v[a]
            before = np.searchsorted(seen, g, side="right") - 1
            after = np.minimum(before + 1, len(seen) - 1)
            w = (g - seen[before]) / (seen[after] - seen[before])
            spots.append(np.full(len(i), a))
            points.append(i)
            times.append(g)
            values.append(np.where(after == before, x[before], x[before] + (x[after] - x[before]) * w))
        spot = pa.array(np.concatenate(spots))
        return pa.RecordBatch.from_arrays(
            [*[table.column(c).take(spot).combine_chunks() for c in group if c != BLK], *[pa.array(np.concatenate(p)) for p in (points, times, values)]],
            [*[c for c in group if c != BLK], "_i", "_t", "_v"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(invalid="ignore", divide="ignore"):
            for table, at in whole_groups(batches, group):
                yield work(table, at)

    return run


def resample_uniform(series: DataFrame, keys: Sequence[str], value: str, fs: float, t: str = "t", right_id: str = "i", rows: int = BLOCK_ROWS) -> DataFrame:
    """Linear interpolation by time onto the uniform grid: (keys, i, t, value).

    A sample travels once, to the block of ``rows`` grid points its time falls in, and the grid is made there. Of a
    recording that is long or densely sampled, only the samples next to a grid point travel, and a block gets the
    last sample before it and the first one after it.
    """
    keys = list(keys)
    known = with_key(series.filter(F.col(value).isNotNull() & F.col(t).isNotNull()).select(
        *keys, F.col(t).cast("double").alias("_t"), F.col(right_id).cast("long").alias("_k"), F.col(value).cast("double").alias("_v")), keys).drop(*keys)
    grid = known.groupBy(KEY).agg(F.min("_t").alias("_t0"), F.max("_t").alias("_t1"), F.count(F.lit(1)).alias("_c")).filter("_t1 > _t0")
    grid = grid.withColumn("_n", F.floor((F.col("_t1") - F.col("_t0")) * F.lit(fs)).cast("long") + 1)
    grid = durable(grid.withColumn("_big", (F.col("_n") > rows) | (F.col("_c") > 4 * rows)))
    sample = [KEY, BLK, F.lit(1).alias("_side"), "_t", "_k", "_v"]
    parts = [known.join(grid.filter("NOT _big").select(KEY), KEY).withColumn(BLK, F.lit(0).cast("long")).select(*sample)]
    ends = F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / rows).cast("long"))
    blocks = grid.withColumn(BLK, F.explode(ends))
    parts.append(blocks.select(KEY, BLK, F.lit(0).alias("_side"), F.col("_t0").alias("_t"), F.col("_n").alias("_k"), F.col("_t1").alias("_v")))
    if not grid.filter("_big").isEmpty():
        near = durable(_beside_grid(known.join(grid.filter("_big"), KEY)).withColumn(BLK, F.floor(F.col("_cell") / rows).cast("long")))
        s = F.struct("_t", "_k", "_v")
        outer = blocks.filter("_big").select(KEY, BLK).join(near.groupBy(KEY, BLK).agg(F.min(s).alias("_a"), F.max(s).alias("_z")), [KEY, BLK], "left")
        ahead = Window.partitionBy(KEY).orderBy(BLK).rowsBetween(Window.unboundedPreceding, -1)
        behind = Window.partitionBy(KEY).orderBy(F.col(BLK).desc()).rowsBetween(Window.unboundedPreceding, -1)
        carried = F.array_compact(F.array(F.last("_z", ignorenulls=True).over(ahead), F.last("_a", ignorenulls=True).over(behind)))
        carried = outer.select(KEY, BLK, carried.alias("_s")).select(KEY, BLK, F.explode("_s").alias("_s")).select(KEY, BLK, "_s.*")
        parts += [near.select(*sample), carried.select(*sample)]
    group = [*keys, BLK]
    src = reduce(DataFrame.unionByName, parts).select(*[F.col(f"{KEY}.{k}").alias(k) for k in keys], BLK, "_side", "_t", "_k", "_v")
    src = src.repartition(*group).sortWithinPartitions(*group, "_side", "_t", "_k").drop("_side")
    told = StructType([*[src.schema[k] for k in keys], StructField("_i", LongType()), StructField("_t", DoubleType()), StructField("_v", DoubleType())])
    return src.mapInArrow(_onto_grid(group, rows), told).select(*keys, F.col("_i").alias("i"), F.col("_t").alias(t), F.col("_v").alias(value))


def _beside_grid(samples: DataFrame) -> DataFrame:
    """(KEY, _cell, _t, _k, _v): of the samples from a grid point up to the next those that interpolation can ask for.

    They are the first and the last of them, the last at the grid point itself and the first after it.
    """
    n = F.col("_n")
    step = F.when(n > 1, (F.col("_t1") - F.col("_t0")) / (n - 1)).otherwise(F.lit(0.0))
    time = lambda c: F.when((n > 1) & (c == n - 1), F.col("_t1")).otherwise(F.col("_t0") + c * step)
    cell = F.least(F.when(step > 0, F.floor((F.col("_t") - F.col("_t0")) / step).cast("long")).otherwise(F.lit(0).cast("long")), n - 1)
    s = samples.withColumn("_cell", cell)
    c = F.col("_cell")
    s = s.withColumn("_cell", F.when(F.col("_t") < time(c), c - 1).when((c < n - 1) & (F.col("_t") >= time(c + 1)), c + 1).otherwise(c))
    x, at = F.struct("_t", "_k", "_v"), time(F.col("_cell"))
    picks = [F.max(F.when(F.col("_t") == at, x)), F.min(F.when(F.col("_t") > at, x)), F.max(x), F.min(x)]
    few = s.groupBy(KEY, "_cell").agg(*[p.alias(f"_{j}") for j, p in enumerate(picks)])
    some = F.array_distinct(F.array_compact(F.array(*[f"_{j}" for j in range(len(picks))])))
    return few.select(KEY, "_cell", F.explode(some).alias("_s")).select(KEY, "_cell", "_s.*")


def resample_array(x: Column, length: int) -> Column:
    """Linear resampling of one array by position to ``length`` values (native)."""
    n = F.size(x)

    def at(k: Column) -> Column:
        pos = k * (n - 1) / F.lit(float(length - 1))
        lo = F.least(F.floor(pos).cast("int"), n - 1)
        hi = F.least(lo + 1, n - 1)
        return F.get(x, lo) + (F.get(x, hi) - F.get(x, lo)) * (pos - lo)

    return F.transform(F.sequence(F.lit(0), F.lit(length - 1)), at)


def shift_and_clip(
    audio: DataFrame, motion: DataFrame, bounds: DataFrame, keys: Sequence[str]
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Audio moved to motion time, both clipped to the pass window, and a status row per recording.

    ``bounds`` has (keys, audio_stomp, motion_stomp, pass_start, pass_end). The window reaches half a
    second beyond the pass on both sides and never beyond the audio.
    """
    reach = audio.groupBy(*keys).agg(F.min("t").alias("_a0"), F.max("t").alias("_a1"))
    shift = F.col("motion_stomp") - F.col("audio_stomp")
    b = bounds.join(reach, list(keys), "left").select(
        *keys, shift.alias("_shift"),
        (F.col("pass_start") - MARGIN_S).alias("_w0"), (F.col("pass_end") + MARGIN_S).alias("_w1"),
        (F.col("_a0") + shift).alias("_a0"), (F.col("_a1") + shift).alias("_a1"),
    )
    a = audio.join(b, list(keys)).withColumn("_ts", F.col("t") + F.col("_shift"))
    a = a.filter((F.col("_ts") >= F.col("_w0")) & (F.col("_ts") <= F.col("_w1")))
    moved = a.select(*[F.col("_ts").alias("t") if c == "t" else F.col(c) for c in audio.columns])
    kept_reach = moved.groupBy(*keys).agg(F.min("t").alias("_k0"), F.max("t").alias("_k1"), F.count(F.lit(1)).alias("audio_rows"))
    window = b.join(kept_reach, list(keys), "left")
    m = motion.join(window, list(keys)).filter(
        (F.col("t") >= F.greatest("_w0", "_k0")) & (F.col("t") <= F.least("_w1", "_k1"))
    )
    kept_motion = m.select(*motion.columns)
    counts = kept_motion.groupBy(*keys).agg(F.count(F.lit(1)).alias("motion_rows"))
    overlap = F.least("_w1", "_a1") - F.greatest("_w0", "_a0")
    asked = F.col("_w1") - F.col("_w0")
    status = window.join(counts, list(keys), "left").select(
        *keys,
        F.coalesce("audio_rows", F.lit(0)).alias("audio_rows"),
        F.coalesce("motion_rows", F.lit(0)).alias("motion_rows"),
        F.when(asked > 0, F.greatest(overlap, F.lit(0.0)) / asked).otherwise(F.lit(0.0)).alias("coverage"),
        F.when(F.col("_a0").isNull(), "no_audio")
        .when((F.col("_w1") < F.col("_a0")) | (F.col("_w0") > F.col("_a1")), "window_outside_audio")
        .when(F.coalesce("audio_rows", F.lit(0)) == 0, "empty_audio_clip")
        .when(F.coalesce("motion_rows", F.lit(0)) == 0, "empty_motion_clip")
        .when((F.col("_w0") < F.col("_a0")) | (F.col("_w1") > F.col("_a1")), "partial")
        .otherwise("ok").alias("status"),
    )
    return moved, kept_motion, status


def validate_synced(synced: DataFrame, keys: Sequence[str], audio: Sequence[str], motion: Sequence[str]) -> DataFrame:
    """Rule row per recording: rows, share of rows with motion, verdict."""
    has_audio = F.coalesce(*[F.col(c).cast("double") for c in audio]).isNotNull()
    has_motion = F.coalesce(*[F.expr(f"try_cast(`{c}` AS double)") for c in motion]).isNotNull()
    g = synced.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(has_audio).alias("audio_rows"), F.count_if(has_motion).alias("motion_rows")
    )
    cover = F.col("motion_rows") / F.col("n_rows")
    verdict = (
        F.when(F.col("audio_rows") == 0, "no_audio").when(F.col("motion_rows") == 0, "no_motion")
        .when(cover < 0.5, "low_coverage").otherwise("ok")
    )
    return g.withColumn("coverage", cover).withColumn("status", verdict)


def synchronize(
    audio: DataFrame, motion: DataFrame, bounds: DataFrame, keys: Sequence[str], motion_columns: Sequence[str],
    rows: int = BLOCK_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """The whole alignment: shift and clip, nearest as-of within tolerance, interpolate, status rows."""
    a, m, status = shift_and_clip(audio, motion, bounds, keys)
    tol = step_tolerance(m, keys, rows)
    a = a.join(tol, list(keys), "left").withColumn("tolerance", F.coalesce("tolerance", F.lit(MIN_TOLERANCE_S)))
    joined = asof_nearest(a, m.select(*keys, "i", "t", *motion_columns), keys, F.col("tolerance"), prefix="m_")
    named = joined.withColumnsRenamed({f"m_{c}": c for c in motion_columns}).drop("m_i", "m_t", "tolerance")
    return interpolate_inside(named, keys, motion_columns, rows), status


def proximity_score(a: DataFrame, b: DataFrame, keys: Sequence[str], max_distance: Column | float, t: str = "t") -> DataFrame:
    """Mean over A of how near the closest B lies: 1 at no distance, 0 beyond ``max_distance``."""
    near = time_neighbours(a, b, keys, t)
    d = F.least(F.col(t) - F.col(f"prev.{t}"), F.col(f"next.{t}") - F.col(t))
    far = max_distance if isinstance(max_distance, Column) else F.lit(float(max_distance))
    score = F.coalesce(F.greatest(1 - d / far, F.lit(0.0)), F.lit(0.0))
    return near.groupBy(*keys).agg(F.avg(score).alias("score"), F.count(F.lit(1)).alias("n"))


