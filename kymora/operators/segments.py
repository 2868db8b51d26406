"""Segments of event times: gap sessions, rate clusters, marker pairs and peak pairs."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kymora.plans import chains
from kymora.plans.blocks import BLK, BLOCK_ROWS, KEY, index_blocks, range_blocks, running, with_key
from kymora.plans.grouped import grouped_map
from kymora.session import durable, partitions


def gap_sessions(
    events: DataFrame, keys: Sequence[str], gap_s: float = 2.0, least: int = 6, rows: int = BLOCK_ROWS
) -> DataFrame:
    """Spans of events whose neighbours are at most ``gap_s`` apart, with at least ``least`` events.

    Events carry their position ``i`` within the key.
    """
    e = index_blocks(events.select(*keys, "i", "t"), rows=rows)
    prev = running(e, keys, ["i"], {"_prev": ("last", F.col("t"))}, exclusive=True)
    breaks = F.when(F.col("t") - F.col("_prev") > gap_s, 1).otherwise(0)
    s = running(prev, keys, ["i"], {"session": ("sum", breaks)})
    return (
        s.groupBy(*keys, "session")
        .agg(F.min("t").alias("start"), F.max("t").alias("end"), F.count(F.lit(1)).alias("n_events"))
        .filter(F.col("n_events") >= least)
        .drop("session")
    )


# Relative tolerances of the rate clusters.
RATE_LADDER = (0.05, 0.04, 0.03, 0.025)
RATE_SPLITS = (0.03, 0.02, 0.015)


def _left(rates: np.ndarray, first: float, tolerance: float) -> np.ndarray:
    """Which rates are too far from the first rate of a span."""
    with np.errstate(invalid="ignore"):
        return np.abs(rates - first) / first > tolerance


def steady_spans(steps: DataFrame, keys: Sequence[str], least: int, rows: int = BLOCK_ROWS) -> DataFrame:
    """(keys, start, end) of spans whose rate stays within ``tolerance`` of their first, with ``least`` events or more.

    ``steps`` has (keys, i, t0, t, hz, tolerance), one row a step between two events, i from 0 without gaps. The walk
    is sequential: a step that leaves the span's first rate begins the next span. A block's map tells from the
    rate that enters it the rate of the span that is open at its end; only rates outside all before them in the
    block can end a span that comes from outside, so a map is short, and maps are composed by a parallel
    prefix. Every block is then walked on its own from the rate that enters it.
    """
    keys = list(keys)
    cut = index_blocks(steps.select(*keys, "i", "t0", "t", "hz", "tolerance"), rows=rows)

    def walk(rate: np.ndarray, first: float, tolerance: float, at: int) -> list[int]:
        """Where spans begin from ``at`` on, when one of rate ``first`` is open."""
        found, size = [], 64
        while at < len(rate):
            hit = np.flatnonzero(_left(rate[at : at + size], first, tolerance))
            if not len(hit):
                at, size = at + size, size * 4
                continue
            at = at + int(hit[0])
            found.append(at)
            first, at, size = rate[at], at + 1, 64
        return found

    def ends(g: dict[str, np.ndarray]) -> dict[str, list]:
        rate, tol = g["hz"], float(g["tolerance"][0])
        met = chains.outermost(rate)
        last: dict[int, int] = {}  # the last span begun in the block, by where a span begins
        for k in met[::-1].tolist():
            at, seen = k, []
            while at not in last:
                seen.append(at)
                nxt = next(iter(walk_one(rate, at, tol)), None)
                if nxt is None:
                    last[at] = at
                else:
                    at = nxt
            for s in seen:
                last[s] = last[at]
        return {"met": [rate[met]], "out": [rate[[last[k] for k in met.tolist()]]], "limit": [tol]}

    def walk_one(rate: np.ndarray, at: int, tol: float) -> list[int]:
        """The next span's first step after a span that begins at ``at``, if there is one."""
        a, size = at + 1, 64
        while a < len(rate):
            hit = np.flatnonzero(_left(rate[a : a + size], rate[at], tol))
            if len(hit):
                return [a + int(hit[0])]
            a, size = a + size, size * 4
        return []

    maps = grouped_map(cut, [*keys, BLK], ["i"], ["hz", "tolerance"], "met array<double>, out array<double>, limit double", ends)
    maps = with_key(maps, keys).select(KEY, BLK, F.col("limit").alias("tolerance"), "met", "out")
    start = with_key(cut.filter("i = 0"), keys).select(KEY, F.col("hz").alias("state"))
    state = chains.entering(maps, start, _left)
    entered = with_key(cut, keys).join(state, [KEY, BLK]).select(*keys, BLK, "i", "t0", "t", "hz", "tolerance", "state")

    def begin(g: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        flags = np.zeros(len(g["i"]), np.int32)
        flags[walk(g["hz"], float(g["state"][0]), float(g["tolerance"][0]), 0)] = 1
        return {"i": g["i"], "t0": g["t0"], "t": g["t"], "begins": flags}

    walked = grouped_map(entered, [*keys, BLK], ["i"], ["i", "t0", "t", "hz", "tolerance", "state"], "i bigint, t0 double, t double, begins int", begin)
    spans = running(walked, keys, ["i"], {"_span": ("sum", F.col("begins"))})
    got = spans.groupBy(*keys, "_span").agg(F.min("t0").alias("start"), F.max("t").alias("end"), F.count(F.lit(1)).alias("_n"))
    return got.filter(F.col("_n") + 1 >= least).drop("_n", "_span")


def event_steps(events: DataFrame, keys: Sequence[str], rows: int = BLOCK_ROWS) -> DataFrame:
    """(keys, i, t0, t, hz) of the steps between events (keys, i, t); events of one time have an infinite rate."""
    e = index_blocks(events.select(*keys, "i", "t"), rows=rows)
    step = running(e, keys, ["i"], {"t0": ("last", F.col("t"))}, exclusive=True).filter(F.col("t0").isNotNull())
    gap = F.col("t") - F.col("t0")
    return step.select(*keys, (F.col("i") - 1).alias("i"), "t0", "t", F.when(gap != 0, 1 / F.nullif(gap, F.lit(0.0))).otherwise(F.lit(float("inf"))).alias("hz"))


LADDER_ROWS = 1 << 20  # steps that a task sees at once, over all tolerances that are tried together


def _ladder(steps: DataFrame, keys: Sequence[str], tolerances: Sequence[float], enough: int, least: int, rows: int) -> DataFrame:
    """(keys, rank, start, end): the steady spans at each tolerance, down to the first with ``enough`` spans at least.

    As many tolerances are tried together as leave a task ``LADDER_ROWS`` steps, one at least; recordings that have
    enough spans are left out of those after.
    """
    keys = list(keys)
    together = max(1, min(len(tolerances), partitions(steps.sparkSession) * LADDER_ROWS // max(steps.count(), 1)))
    found: DataFrame | None = None
    for a in range(0, len(tolerances), together):
        some = [F.struct(F.lit(k).alias("rank"), F.lit(float(v)).alias("tolerance")) for k, v in enumerate(tolerances)][a : a + together]
        tried = steps.withColumn("_r", F.explode(F.array(*some))).select(*keys, "_r.*", "i", "t0", "t", "hz")
        got = durable(steady_spans(tried, [*keys, "rank"], least, rows))
        found = got if found is None else found.unionByName(got)
        if a + together < len(tolerances):
            done = got.groupBy(*keys, "rank").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= enough).select(*keys).distinct()
            steps = durable(with_key(steps, keys).join(with_key(done, keys).select(KEY), KEY, "left_anti").select(*steps.columns))
            if steps.isEmpty():
                break
    return found


def rate_segments(events: DataFrame, keys: Sequence[str], least: int = 6, tolerance: float = 0.06, rows: int = BLOCK_ROWS) -> DataFrame:
    """Spans of steady event rate: a new span starts where the rate leaves the span's first rate.

    Walks down a ladder of tolerances until a recording has three spans, else takes the tolerance with
    most; of exactly two, the longest is split once more when a finer tolerance can.
    """
    keys = list(keys)
    steps = durable(event_steps(events, keys, rows))
    found = _ladder(steps, keys, (tolerance, *RATE_LADDER), 3, max(least, 2), rows)
    tally = found.groupBy(*keys, "rank").agg(F.count(F.lit(1)).alias("n"))
    enough = F.col("n") >= 3
    choice = F.struct(F.when(enough, 0).otherwise(1).alias("a"), F.when(enough, F.col("rank")).otherwise(-F.col("n")).alias("b"), "rank")
    chosen = with_key(tally.groupBy(*keys).agg(F.min_by("rank", choice).alias("_rank"), F.min_by("n", choice).alias("_n")), keys).drop(*keys)
    kept = with_key(found, keys).join(chosen, KEY).filter(F.col("rank") == F.col("_rank"))
    length = F.struct((F.col("end") - F.col("start")).alias("len"), (-F.col("start")).alias("s"), "end")
    longest = kept.filter("_n = 2").groupBy(KEY).agg(F.max(length).alias("_l")).select(KEY, (-F.col("_l.s")).alias("_a"), F.col("_l.end").alias("_b"))
    out = kept.select(*keys, "start", "end")
    longest = durable(longest)
    if longest.isEmpty():
        return out
    inner = with_key(steps, keys).join(longest, KEY).filter((F.col("t0") >= F.col("_a")) & (F.col("t") <= F.col("_b")))
    first = inner.groupBy(KEY).agg(F.min("i").alias("_i0"))
    inner = durable(inner.join(first, KEY).withColumn("i", F.col("i") - F.col("_i0")).select(*keys, "i", "t0", "t", "hz"))
    parts = _ladder(inner, keys, RATE_SPLITS, 2, max(least, 2), rows)
    several = parts.groupBy(*keys, "rank").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").groupBy(*keys).agg(F.min("rank").alias("_rank"))
    several = with_key(several, keys).drop(*keys)
    split = with_key(parts, keys).join(several, KEY).filter(F.col("rank") == F.col("_rank"))
    gone = longest.join(several, KEY).select(KEY, F.col("_a").alias("start"))
    whole = with_key(out, keys).join(gone, [KEY, "start"], "left_anti")
    return whole.select(*keys, "start", "end").unionByName(split.select(*keys, "start", "end"))


def speed_groups(passes: DataFrame, keys: Sequence[str], tolerance: float = 0.06) -> DataFrame:
    """Passes of a recording grouped by cadence: ascending, while within ``tolerance`` of the group mean.

    Cadences ascend, so a group ends at the first one that lies above the mean of the group so far by more than
    the tolerance. That mean is a difference of running sums, which all groups of a round are tested by at
    once: a minimum per recording, taken before the shuffle. A group begins above the one before it by more
    than the tolerance, so there are as many rounds as such steps fit between the lowest and the highest
    cadence, however many passes there are.
    """
    keys = list(keys)
    counted = passes.groupBy(*keys, "gait_cycle_hz").agg(
        F.count(F.lit(1)).alias("n"), F.sum("coverage_frac").alias("cov"), F.sum("bandpower_ratio").alias("bp"),
        F.sum(F.col("end") - F.col("start")).alias("dur"), F.sum("heel_strike_count").alias("heel"),
        F.sum(F.col("passed").cast("int")).alias("ok"),
    )
    order = ["gait_cycle_hz"]
    hz, total = F.col("gait_cycle_hz"), F.col("gait_cycle_hz") * F.col("n")
    cut = range_blocks(counted, keys, order)
    sums = durable(with_key(running(cut, keys, order, {"_s": ("sum", total), "_c": ("sum", F.col("n"))}, exclusive=True), keys))
    at = F.struct("gait_cycle_hz", "_s", "_c")
    now = durable(sums.groupBy(KEY).agg(F.min(at).alias("_g")))
    starts = now
    while True:
        mean = (F.col("_s") - F.col("_g._s")) / (F.col("_c") - F.col("_g._c"))
        after = sums.select(KEY, "gait_cycle_hz", "_s", "_c").join(now, KEY).filter(hz > F.col("_g.gait_cycle_hz"))
        now = durable(after.filter(F.abs(hz - mean) / mean > tolerance).groupBy(KEY).agg(F.min(at).alias("_g")))
        if now.isEmpty():
            break
        starts = starts.unionByName(now)
    flags = starts.select(KEY, F.col("_g.gait_cycle_hz").alias("gait_cycle_hz"), F.lit(1).alias("begins"))
    marked = sums.join(flags, [KEY, "gait_cycle_hz"], "left").drop(KEY)
    labelled = running(durable(marked), keys, order, {"speed_group": ("sum", F.coalesce("begins", F.lit(0)))})
    n = F.sum("n")
    return labelled.groupBy(*keys, F.col("speed_group").cast("int").alias("speed_group")).agg(
        (F.sum(total) / n).alias("gait_cycle_hz"),
        (F.sum("cov") / n).alias("coverage_frac"), (F.sum("bp") / n).alias("bandpower_ratio"),
        F.sum("dur").alias("duration_s"), F.sum("heel").alias("heel_strike_count"),
        (F.sum("ok") == n).alias("passed"), n.alias("pass_count"), (F.sum("ok") / n).alias("pass_rate"),
    )


def marker_sections(markers: DataFrame, keys: Sequence[str], header: Column, order: Sequence[str]) -> DataFrame:
    """Carry the latest section header (null on ordinary rows) down to the markers below it."""
    cut = range_blocks(markers.withColumn("_header", header), keys, list(order))
    return running(cut, keys, list(order), {"section": ("last", F.col("_header"))}).drop("_header", "_blk")


def marker_pairs(markers: DataFrame, keys: Sequence[str], name: str = "event", t: str = "t") -> DataFrame:
    """"... Pass n Start/End" markers paired by (section, pass): first start, last end."""
    number = F.regexp_extract(F.col(name), r"Pass\s+(\d+)", 1)
    m = markers.filter(F.col(name).rlike(r"Pass\s+\d+.*(Start|End)")).withColumn("pass_number", number.cast("int"))
    ends = F.col(name).contains("End")
    g = m.groupBy(*keys, "pass_number").agg(
        F.min(F.when(~ends, F.col(t))).alias("start"), F.max(F.when(ends, F.col(t))).alias("end")
    )
    return g.filter(F.col("end") > F.col("start"))


def peak_pairs(peaks: DataFrame, expected: DataFrame, keys: Sequence[str], tolerances: Sequence[float] = (0.20, 0.30)) -> DataFrame:
    """Best pair of stomp peaks about ``expected_delta`` apart: tightest tolerance, most energy, closest.

    Peaks come from the first seconds of a recording and are spaced apart, so a key holds a few dozen;
    the partner is looked up by its expected time bucket, never by pairing everything.
    """
    keys = list(keys)
    wide = max(tolerances)
    width = 2 * wide
    p = peaks.join(expected.select(*keys, "expected_delta"), keys)
    want = F.col("t") + F.col("expected_delta")
    first = p.select(*keys, F.col("t").alias("t1"), F.col("energy").alias("e1"), "expected_delta",
                     F.explode(F.sequence(F.floor((want - wide) / width).cast("long"), F.floor((want + wide) / width).cast("long"))).alias("_b"))
    second = peaks.select(*keys, F.col("t").alias("t2"), F.col("energy").alias("e2"), F.floor(F.col("t") / width).cast("long").alias("_b"))
    off = F.abs(F.col("t2") - F.col("t1") - F.col("expected_delta"))
    rank = F.lit(None).cast("int")
    for k, tol in reversed(list(enumerate(tolerances))):
        rank = F.when(F.col("gap_error") <= tol, F.lit(k)).otherwise(rank)
    pairs = first.join(second, [*keys, "_b"]).filter(F.col("t2") > F.col("t1")).withColumn("gap_error", off)
    pairs = pairs.withColumn("tolerance_rank", rank).filter(F.col("tolerance_rank").isNotNull())
    best = F.min_by(
        F.struct("t1", "t2", "e1", "e2", "gap_error", "tolerance_rank"),
        F.struct("tolerance_rank", (-(F.col("e1") + F.col("e2"))).alias("s"), "gap_error", "t1", "t2"),
    )
    return pairs.groupBy(*keys).agg(best.alias("p")).select(*keys, "p.*")
