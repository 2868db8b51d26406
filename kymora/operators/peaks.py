"""Peaks of long series: native reduction to extrema, then a spacing and prominence verdict per block."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from kymora.functions import kernels as kn
from kymora.plans.blocks import BLK, BLOCK_ROWS, CORE, KEY, index_blocks, running, whole_groups, with_halo, with_key
from kymora.plans.grouped import Together, grouped_map
from kymora.session import durable


MAX, MIN, ONLY, FIRST, LAST, OPENS, STOPS = range(7)
KINDS = ["max", "min", "only", "first", "last", "opens", "stops"]


def _turns(group: Sequence[str]):
    """Extrema and ends of the blocks that sorted rows make, and what a block leaves to the blocks around it.

    ``opens`` is the last place in a block where a plateau began, with the value before it, ``stops`` the end of a
    plateau that began in an earlier block, with the value after it. A null is like the end of the series to the
    samples next to it, and neither above nor below anything; NaN is above all else.
    """

    def above(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (a > b) | (np.isnan(a) & ~np.isnan(b))

    def work(rows: pa.Table, at: np.ndarray) -> pa.RecordBatch:
        n, no = len(at), rows.column("v").is_null().to_numpy()
        i, v = rows.column("i").to_numpy(), pc.fill_null(rows.column("v"), 0.0).to_numpy()
        core = rows.column(CORE).to_numpy()
        edge = at[1:] != at[:-1]
        # no sample before, or a null one; the value before
        none_p, none_n = np.append(True, edge | no[:-1]), np.append(edge | no[1:], True)
        prev, after = np.append(0.0, v[:-1]), np.append(v[1:], 0.0)
        starts = none_p | (~no & (above(prev, v) | above(v, prev)))
        stops = none_n | (~no & (above(after, v) | above(v, after)))
        place = np.arange(n)
        opened = np.maximum.accumulate(np.where(starts & core, place, -1))
        here = (opened >= 0) & (at[opened] == at)
        stop = core & stops & ~no & ~none_n
        begun = opened[stop & here]
        ends = place[stop & here]
        high = ~none_p[begun] & above(v[ends], prev[begun]) & above(v[ends], after[ends])
        low = ~none_p[begun] & above(prev[begun], v[ends]) & above(after[ends], v[ends])
        out = [(ends[m], (i[begun[m]] + i[ends[m]]) // 2, np.full(int(m.sum()), kind), np.zeros(int(m.sum())), np.zeros(int(m.sum()), bool)) for m, kind in ((high, MAX), (low, MIN))]
        e = np.flatnonzero(core & (none_p | none_n))
        out.append((e, i[e], np.where(none_p[e] & none_n[e], ONLY, np.where(none_p[e], FIRST, LAST)), np.zeros(len(e)), np.zeros(len(e), bool)))
        w = np.flatnonzero(stop & ~here)
        out.append((w, i[w], np.full(len(w), STOPS), after[w], np.zeros(len(w), bool)))
        final = np.flatnonzero(np.append(edge, True))  # a block that another follows ends with a row of it
        last = final[~core[final] & here[final]]
        o = opened[last]
        out.append((o, i[o], np.full(len(o), OPENS), prev[o], none_p[o]))
        spot, where, kind, side, gone = (np.concatenate(x) for x in zip(*out))
        return pa.RecordBatch.from_arrays(
            [*[rows.column(g).take(pa.array(spot)).combine_chunks() for g in group if g != BLK], pa.array(where.astype(np.int64)),
             rows.column("v").take(pa.array(spot)).combine_chunks(), pa.array(KINDS).take(pa.array(kind)), pa.array(side.astype(float), mask=gone)],
            [*[g for g in group if g != BLK], "i", "v", "kind", "side"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, at in whole_groups(batches, group):
            yield work(rows, at)

    return run


def local_extrema(signal: DataFrame, keys: Sequence[str], value: str, rows: int = BLOCK_ROWS) -> DataFrame:
    """(keys, i, v, kind): ``max``/``min`` per plateau (at its middle sample) and the two ``end`` samples.

    Blocks are judged from their sorted samples in one shuffle; plateaus that pass a block edge are put together
    from a row or two a block.
    """
    keys = list(keys)
    group = [*keys, BLK]
    src = with_halo(signal.select(*keys, F.col("i").cast("long").alias("i"), F.col(value).cast("double").alias("v")), 1, 1, rows=rows)
    src = src.select(*group, "i", "v", CORE).repartition(*group).sortWithinPartitions(*group, "i")
    told = StructType([*[src.schema[k] for k in keys], StructField("i", LongType()), StructField("v", DoubleType()), StructField("kind", StringType()), StructField("side", DoubleType())])
    found = durable(src.mapInArrow(_turns(group), told))
    whole = found.filter("kind NOT IN ('opens', 'stops')").select(*keys, "i", "v", "kind")
    parts = found.filter("kind IN ('opens', 'stops')")
    if parts.isEmpty():
        return whole
    opened = F.when(F.col("kind") == "opens", F.struct("i", F.col("side").alias("before")))
    run = running(index_blocks(parts, rows=rows), keys, ["i"], {"_open": ("last", opened)}).filter("kind = 'stops'")
    before, after = F.col("_open.before"), F.col("side")
    kind = (
        F.when((before < F.col("v")) & (after < F.col("v")), F.lit("max"))
        .when((before > F.col("v")) & (after > F.col("v")), F.lit("min"))
    )
    middle = F.floor((F.col("_open.i") + F.col("i")) / 2).cast("long")
    turning = run.select(*keys, middle.alias("i"), "v", kind.alias("kind")).filter(F.col("kind").isNotNull())
    return whole.unionByName(turning)


STEPS = 64  # extrema beside a peak that are looked at for all peaks at once


def _stand_out(val: np.ndarray, peaks: np.ndarray, need: np.ndarray, first: np.ndarray, stop: np.ndarray, left_known: np.ndarray, right_known: np.ndarray) -> np.ndarray:
    """``kernels.reaches_prominence`` for peaks of many groups; ``first`` and ``stop`` bound the rows of each peak's group.

    All peaks step away together, one extremum at a time; those that are still open after ``STEPS`` go on alone.
    """
    out = np.full(len(peaks), kn.KEEP, np.int8)
    for side, known in ((-1, left_known), (1, right_known)):
        todo = np.flatnonzero(out != kn.DROP)
        far = np.full(len(peaks), kn.WAITING, np.int8)
        for k in range(1, STEPS + 1):
            at = peaks[todo] + side * k
            inside = (at >= first[todo]) & (at < stop[todo])
            ended = todo[~inside]
            far[ended] = np.where(known[ended], kn.DROP, kn.OPEN)
            todo, at = todo[inside], at[inside]
            top, low = val[peaks[todo]], val[at]
            deep = (need[todo] <= 0) | ((low <= top) & (top - low >= need[todo]))
            far[todo[deep]] = kn.KEEP
            far[todo[~deep & (low > top)]] = kn.DROP
            todo = todo[~deep & ~(low > top)]
            if not len(todo):
                break
        for k in todo.tolist():
            p = peaks[k]
            part = val[first[k] : p][::-1] if side < 0 else val[p + 1 : stop[k]]
            far[k] = kn._side_verdict(part, val[p], need[k], known[k])
        out = np.where((out == kn.DROP) | (far == kn.DROP), kn.DROP, np.where((out == kn.OPEN) | (far == kn.OPEN), kn.OPEN, kn.KEEP)).astype(np.int8)
    return out


def _verdicts(distance: int, prominent: bool, rows: int, halo: int):
    """Verdicts on the candidates of sorted extrema, for all whole blocks of a batch at once."""

    def verdict(g: dict[str, np.ndarray], at: np.ndarray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
        pos, val, need, blk, end = (g[c] for c in ("i", "v", "_need", "_at", "_end"))
        starts = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
        stops = np.append(starts[1:], len(at))
        has_first, has_last = np.logical_or.reduceat(end < 0, starts), np.logical_or.reduceat(end > 0, starts)
        top = np.flatnonzero(g["_cand"].astype(bool))
        of = at[top]
        space = np.full(len(top), kn.KEEP, np.int8)
        if distance > 1 and len(top):
            # blocks are laid one behind the other, too far apart to reach each other
            length = pos[stops - 1] - pos[starts] + distance + 1
            shift = np.append(0, np.cumsum(length)[:-1]) - pos[starts]
            seen_from = np.where(has_first, -np.inf, blk[starts] * rows - halo + shift)
            seen_to = np.where(has_last, np.inf, (blk[starts] + 1) * rows + halo - 1 + shift)
            space = kn.thin_by_distance(pos[top] + shift[of], val[top], distance, seen_from[of], seen_to[of])
        stand = np.full(len(top), kn.KEEP, np.int8)
        if prominent and len(top):
            alive = np.flatnonzero(space != kn.DROP)
            odd = np.logical_or.reduceat(np.isnan(val), starts)[of[alive]]
            plain, odd = alive[~odd], alive[odd]
            b = of[plain]
            stand[plain] = _stand_out(val, top[plain], need[starts][b], starts[b], stops[b], has_first[b], has_last[b])
            for b in np.unique(of[odd]):  # blocks with an unknown value are judged one by one
                some, a, z = odd[of[odd] == b], starts[b], stops[b]
                stand[some] = kn.reaches_prominence(pos[a:z], val[a:z], top[some] - a, float(need[a]), has_first[b], has_last[b])
        own = pos[top] // rows == blk[top]
        spot = top[own]
        return spot, {"i": pos[spot], "v": val[spot], "space": space[own].astype(np.int32), "stand": stand[own].astype(np.int32)}

    return Together(verdict)


NONE = -1  # no peak of a zone is kept


def _round(gap: int, view: int):
    """What a block can tell of its open peaks when those kept next to them (``_fact``) are known.

    Rows of kind 0 are verdicts (position, verdict). Where the zone behind the block (closer than ``gap``) still
    has open peaks, at most one of them will be kept; rows of kind 1 tell for each of them, and for none, which
    peak of the block's own first zone is then kept. Kind 2 is the same from the zone before the block to the
    block's last zone. Kinds 3 and 4 are zones, first and last, that are settled whatever lies outside.
    """
    halo = view // 8 + 2 * gap

    def verdict(g: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        pos, val, blk = g["i"], g["v"], int(g["_at"][0])
        fact = np.where(g["_fact"].astype(bool), kn.KEEP, kn.WAITING)
        first, last = blk * view, (blk + 1) * view - 1
        seen = (first - halo, last + halo)
        plain = kn.thin_by_distance(pos, val, gap, *seen, fact)
        core = (pos >= first) & (pos <= last)
        own = core & (fact == kn.WAITING)
        out: list[tuple[int, int, int, int]] = [(0, p, v, 0) for p, v in zip(pos[own].tolist(), plain[own].tolist())]
        after, before = (pos > last) & (pos < last + gap), (pos < first) & (pos > first - gap)
        zones = {1: (after, core & (pos < first + gap - 1), blk), 2: (before, core & (pos > last - gap + 1), blk)}
        for kind, (outside, inside, at) in zones.items():
            if not (plain[inside] == kn.OPEN).any():
                held = pos[inside & (plain == kn.KEEP)]
                out.append((kind + 2, at, 0, int(held[0]) if len(held) else NONE))
                continue
            waiting = outside & (plain == kn.OPEN)
            if not waiting.any():
                continue
            edge = (seen[0], np.inf) if kind == 1 else (-np.inf, seen[1])
            far = pos > last if kind == 1 else pos < first
            for state in [NONE, *pos[waiting].tolist()]:
                known = np.where(far, np.where(plain == kn.KEEP, kn.KEEP, kn.DROP), fact)
                known[pos == state] = kn.KEEP
                got = kn.thin_by_distance(pos, val, gap, *edge, known)
                if not (got[inside] == kn.OPEN).any():
                    held = pos[inside & (got == kn.KEEP)]
                    out.append((kind, at, state, int(held[0]) if len(held) else NONE))
        rows = np.array(out, np.int64).reshape(-1, 4)
        return {"kind": rows[:, 0].astype(np.int32), "p": rows[:, 1], "s": rows[:, 2], "to": rows[:, 3]}

    return verdict


def _settle_spacing(waiting: DataFrame, facts: DataFrame, keys: Sequence[str], gap: int, view: int) -> DataFrame:
    """(KEY, i) of the peaks of ``waiting`` that the spacing rule keeps; ``facts`` are kept for certain.

    Both have (keys, i, v). Each round judges the open peaks in blocks of a fixed view. What the rule says of a
    block may hang on the zone next to it, and so on along an ascending chain; but of a zone at most one peak is
    kept, so a block is a map from the few states of one zone to those of the next. Following these maps by
    pointer jumping from the zones that are settled settles all zones of a chain in as many steps as its length
    has bits, after which every block is judged on its own. No view grows, and a round settles the
    highest open peak at least.
    """
    keys, names = list(keys), [*keys, "i", "v"]
    own = lambda x: F.floor(x / F.lit(view)).cast("long")
    halo = view // 8 + 2 * gap
    kept: DataFrame | None = None
    waiting = durable(waiting.select(*names))
    while not waiting.isEmpty():
        marked = waiting.select(*names, F.lit(False).alias("_fact")).unionByName(facts.select(*names, F.lit(True).alias("_fact")))
        spread = marked.withColumn(BLK, F.explode(F.sequence(F.greatest(own(F.col("i") - halo), F.lit(0)), own(F.col("i") + halo))))
        todo = with_key(waiting, keys).select(KEY, own(F.col("i")).alias(BLK)).distinct()
        # a settled zone tells its neighbours, so blocks next to open ones are looked at too
        todo = todo.select(KEY, F.explode(F.array(F.col(BLK) - 1, F.col(BLK), F.col(BLK) + 1)).alias(BLK)).distinct()
        spread = with_key(spread, keys).join(todo, [KEY, BLK], "left_semi").drop(KEY)
        got = grouped_map(spread.withColumn("_at", F.col(BLK)), [*keys, BLK], ["i"], ["i", "v", "_fact", "_at"], "kind int, p bigint, s bigint, to bigint", _round(gap, view)).drop(BLK)
        got = with_key(got, keys).drop(*keys)
        told = got.filter("kind = 0").select(KEY, F.col("p").alias("i"), F.col("s").cast("int").alias("_told"))
        zones = _follow(got)
        w = with_key(waiting, keys).join(told, [KEY, "i"]).filter("_told <> 0")
        # the zones that an open peak may lie in: first of its block, last of its block
        side = F.array(
            F.struct(F.lit(1).alias("side"), F.when(F.col("i") - own(F.col("i")) * view < gap - 1, own(F.col("i"))).alias("b")),
            F.struct(F.lit(2).alias("side"), F.when((own(F.col("i")) + 1) * view - F.col("i") < gap, own(F.col("i"))).alias("b")),
        )
        in_zone = w.filter("_told = -1").withColumn("_z", F.explode(side)).select(KEY, "i", "_z.*").filter("b IS NOT NULL")
        by_zone = in_zone.join(zones, [KEY, "side", "b"]).groupBy(KEY, "i").agg(F.max((F.col("state") == F.col("i")).cast("int")).alias("_zone"))
        w = durable(w.join(by_zone, [KEY, "i"], "left").withColumn("_told", F.when(F.col("_told") == -1, F.coalesce("_zone", F.lit(-1))).otherwise(F.col("_told"))))
        fresh = w.filter("_told = 1")
        kept = fresh.select(KEY, "i") if kept is None else kept.unionByName(fresh.select(KEY, "i"))
        facts, waiting = fresh, w.filter("_told = -1").select(*names)
    return kept


def _follow(got: DataFrame) -> DataFrame:
    """(KEY, side, b, state) of the zones that are settled, at once or along the maps; side 1 is a block's first zone, 2 its last."""
    start = got.filter("kind >= 3").select(KEY, (F.col("kind") - 2).alias("side"), F.col("p").alias("b"), F.col("to").alias("state"))
    # a map leads from the zone outside the block: the first of the next block, or the last of the one before
    step = F.when(F.col("kind") == 1, 1).otherwise(-1)
    jump = durable(got.filter("kind IN (1, 2)").select(
        KEY, F.col("kind").alias("side"), (F.col("p") + step).alias("b"), F.col("s").alias("state"), F.col("p").alias("b2"), F.col("to").alias("state2")))
    node = [KEY, "side", "b", "state"]
    known = durable(start)
    while True:
        reached = known.join(jump, node).select(KEY, "side", F.col("b2").alias("b"), F.col("state2").alias("state"))
        new = durable(reached.join(known, node, "left_anti").distinct())
        if new.isEmpty():
            return known
        known = known.unionByName(new)
        after = jump.select(KEY, "side", F.col("b").alias("b2"), F.col("state").alias("state2"), F.col("b2").alias("b3"), F.col("state2").alias("state3"))
        jump = durable(jump.join(after, [KEY, "side", "b2", "state2"]).select(KEY, "side", "b", "state", F.col("b3").alias("b2"), F.col("state3").alias("state2")))


FAN = 64  # entries of a group in the search tree


def _tree(extrema: DataFrame) -> list[DataFrame]:
    """Groups of at most ``FAN`` entries (KEY, g, items of place, lowest, highest), level by level up to one group a key."""
    top = extrema.agg(F.max("i")).first()[0] or 0
    item = F.struct(F.col("i").alias("p"), F.col("v").alias("lo"), F.col("v").alias("hi"))
    level = extrema.groupBy(KEY, F.floor(F.col("i") / FAN).cast("long").alias("g")).agg(F.collect_list(item).alias("items"))
    levels = [level]
    while top >= FAN:
        top //= FAN
        low, high = F.array_min(F.transform("items", lambda x: x["lo"])), F.array_max(F.transform("items", lambda x: x["hi"]))
        level = level.select(KEY, "g", F.struct(F.col("g").alias("p"), low.alias("lo"), high.alias("hi")).alias("x"))
        level = level.groupBy(KEY, F.floor(F.col("g") / FAN).cast("long").alias("g")).agg(F.collect_list("x").alias("items"))
        levels.append(level)
    return levels


def _settle_sides(peaks: DataFrame, extrema: DataFrame) -> DataFrame:
    """Of ``peaks`` (KEY, i, v, _need) those that stand out on both sides, however far that has to be looked.

    On each side the nearest extremum counts that is low enough or higher than the peak; low enough decides
    for the peak, higher or the end of the series against it. It is found by climbing a tree of lowest and
    highest values until a group has such an entry, and descending into that entry: two joins a level on
    groups of bounded size, never a look at a whole series.
    """
    levels = _tree(extrema)
    side = F.explode(F.array(F.lit(-1), F.lit(1))).alias("_side")
    s = peaks.select(KEY, "i", "v", "_need", F.col("i").alias("_p"), side, F.lit(None).cast("int").alias("_found"), F.lit(None).cast("double").alias("_x"))

    def nearest(within: Column | None) -> Column:
        hits = F.filter("items", lambda x: ((F.col("v") - x["lo"] >= F.col("_need")) | (x["hi"] > F.col("v"))) & (F.lit(True) if within is None else (x["p"] - within) * F.col("_side") > 0))
        keyed = F.transform(hits, lambda x: F.struct((x["p"] * F.col("_side")).alias("o"), x["p"].alias("p"), x["lo"].alias("lo")))
        return F.array_min(keyed)

    def step(s: DataFrame, level: DataFrame, g: Column, hit: Column, use: Column, found: Column, missed: Column, first: bool) -> DataFrame:
        j = s.withColumn("g", g).join(level, [KEY, "g"], "left").withColumn("_hit", F.when(use, hit))
        got = F.col("_hit").isNotNull()
        return j.select(
            KEY, "i", "v", "_need", "_side", F.when(got, F.col("_hit.p")).when(use, missed).otherwise(F.col("_p")).alias("_p"),
            F.when(got, found).otherwise(F.col("_found")).alias("_found"), F.when(got & F.lit(first), F.col("_hit.lo")).otherwise(F.col("_x")).alias("_x"),
        )

    up = F.floor(F.col("_p") / FAN).cast("long")
    for k, level in enumerate(levels):
        s = step(s, level, up, nearest(F.col("_p")), F.col("_found").isNull(), F.lit(k), up, k == 0)
    for k in range(len(levels) - 1, 0, -1):
        s = step(s, levels[k - 1], F.col("_p"), nearest(None), F.col("_found") >= k, F.col("_found"), F.col("_p"), k == 1)
    return s.groupBy(KEY, "i").agg(F.bool_and(F.coalesce(F.col("v") - F.col("_x") >= F.col("_need"), F.lit(False))).alias("_stands")).filter("_stands").drop("_stands")


def find_peaks(
    signal: DataFrame,
    keys: Sequence[str],
    value: str,
    height: float | None = None,
    distance: int | None = None,
    prominence: float | None = None,
    negate: bool = False,
    rows: int = BLOCK_ROWS,
    per_key: DataFrame | None = None,
    extrema: DataFrame | None = None,
) -> DataFrame:
    """Peaks (keys, i, v) by height, then highest-first spacing, then prominence.

    ``per_key`` may give (keys, height and/or prominence) where the limits differ from key to key, ``extrema`` the
    ``local_extrema`` of the same values where they are known already.

    Each block judges its own peaks from the extrema it can see. What stays open is settled in two ways:
    prominence by a search in a tree of block summaries (``_settle_sides``), spacing, which reaches as far as a
    chain of peaks that each lie closer than ``distance`` to a higher one, by following such chains from block
    to block (``_settle_spacing``).
    """
    keys = list(keys)
    gap = max(int(np.ceil(distance)), 1) if distance is not None else 1
    src = signal.withColumn(value, -F.col(value)) if negate else signal
    extrema = local_extrema(src, keys, value, rows) if extrema is None else extrema
    flip = -F.col("v") if negate else F.col("v")
    own_limits = [c for c in ("height", "prominence") if per_key is not None and c in per_key.columns]
    if own_limits:
        limits = with_key(per_key.select(*keys, *own_limits), keys).drop(*keys)
        extrema = with_key(extrema, keys).join(limits, KEY).drop(KEY)
    floor = F.col("height") if "height" in own_limits else F.lit(height)
    need = F.col("prominence") if "prominence" in own_limits else F.lit(prominence)
    candidate = F.col("kind") == "max"
    if height is not None or "height" in own_limits:
        candidate = candidate & (F.col("v") >= floor)
    extrema = extrema.select(
        *keys, "i", "v", F.coalesce(candidate, F.lit(False)).alias("_cand"), need.cast("double").alias("_need"),
        F.when(F.col("kind") == "first", -1).when(F.col("kind") == "last", 1).otherwise(0).cast("tinyint").alias("_end"),
    )
    prominent = prominence is not None or "prominence" in own_limits
    if gap <= 1 and not prominent:
        return extrema.filter("_cand").select(*keys, "i", flip.alias("v"))

    view = max(4 * rows, 8 * gap)
    halo = view // 8 + 2 * gap
    own = lambda x: F.floor(x / F.lit(view)).cast("long")
    spread = extrema.withColumn(BLK, F.explode(F.sequence(F.greatest(own(F.col("i") - halo), F.lit(0)), own(F.col("i") + halo))))
    judged = grouped_map(
        spread.withColumn("_at", F.col(BLK)), [*keys, BLK], ["i"], ["i", "v", "_end", "_cand", "_need", "_at"],
        "i bigint, v double, space int, stand int", _verdicts(gap, prominent, view, halo),
    ).drop(BLK)
    first = with_key(judged, keys)
    spaced = first.filter("space = 1 AND stand <> 0")
    # a peak that does not stand out still keeps others away, so its spacing is settled too
    wanted = first.filter("space = -1")
    far = first.filter("space = -1 OR (space = 1 AND stand = -1)")
    if not far.isEmpty():
        extrema = durable(extrema)
        if not wanted.isEmpty():
            kept = _settle_spacing(wanted, first.filter("space = 1"), keys, gap, view)
            spaced = spaced.unionByName(wanted.filter("stand <> 0").join(kept, [KEY, "i"], "left_semi").select(*first.columns))
        unsure = spaced.filter("stand = -1")
        if prominent and not unsure.isEmpty():
            keyed = with_key(extrema, keys)
            limits = keyed.filter("_cand").select(KEY, "i", "_need")
            good = _settle_sides(unsure.join(limits, [KEY, "i"]), keyed.select(KEY, "i", "v"))
            spaced = spaced.filter("stand = 1").unionByName(unsure.join(good, [KEY, "i"], "left_semi"))
    return spaced.select(*keys, "i", flip.alias("v"))


def heel_strikes(
    signal: DataFrame, keys: Sequence[str], value: str, hz: float, height: float = 0.02, prominence: float = 0.02,
    max_step_hz: float = 3.0, rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Peaks of the absolute signal spaced by at least one shortest step."""
    gap = max(int(hz / max_step_hz) if max_step_hz > 0 else 1, 1)
    s = signal.withColumn("_a", F.abs(F.col(value)))
    found = find_peaks(s, keys, "_a", height, gap, prominence, rows=rows)
    at = with_key(signal.select(*keys, "i", "t"), keys).drop(*keys)
    return with_key(found, keys).join(at, [KEY, "i"]).drop(KEY)


def peaks_of_arrays(x: Column, height: float | None = None, distance: int | None = None, prominence: float | None = None) -> Column:
    """Peak positions of one short array per row."""

    @F.pandas_udf("array<int>")
    def kernel(col: pd.Series) -> pd.Series:
        return col.map(lambda v: kn.find_peaks(np.asarray(v, dtype=float), height, distance, prominence).astype("int32"))

    return kernel(x)


def windowed_extrema(x: Column, min_distance: float = 0.1) -> Column:
    """Positions whose value is the least of a trailing-open window, for short arrays (native)."""
    m = F.greatest(F.lit(2), F.floor(F.size(x) * F.lit(min_distance)).cast("int"))
    n = F.size(x)
    spots = F.when(n > 2 * m, F.sequence(m, n - m - 1)).otherwise(F.array().cast("array<int>"))
    return F.filter(spots, lambda k: F.get(x, k) == F.array_min(F.slice(x, k - m + 1, 2 * m)))
