"""Samples that travel once: verdicts on many blocks together, resampling, band power, stomps."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from kymora.functions import kernels as kn
from kymora.operators import align, audioqc, cycles, peaks, stomp
from kymora.operators.windows import envelope, gradient, moving_average

K = ["recording_id"]
CH = ("ch1", "ch2", "ch3", "ch4")


def plan(df) -> str:
    return df._jdf.queryExecution().toString()


@pytest.mark.parametrize("distance", [1, 4])
def test_verdicts_on_many_blocks_are_those_of_each(distance):
    rng = np.random.default_rng(distance)
    rows, halo, groups = 64, 24, []
    for k in range(40):
        blk, size = int(rng.integers(0, 3)), int(rng.integers(1, 150))
        pos = np.sort(rng.choice(np.arange(max(blk * rows - halo, 0), (blk + 1) * rows + halo), min(size, 60), replace=False))
        val = rng.integers(0, 9, len(pos)).astype(float) if k % 2 else rng.normal(size=len(pos)).cumsum()
        if k % 7 == 0:
            val[rng.integers(0, len(pos))] = np.nan
        end = np.zeros(len(pos), np.int8)
        end[0], end[-1] = -(k % 3 == 0), k % 4 == 0
        groups.append({"i": pos, "v": val, "_end": end, "_cand": rng.random(len(pos)) < 0.6, "_need": np.full(len(pos), [0.0, 1.0, 3.0, np.nan][k % 4]), "_at": np.full(len(pos), blk)})
    table = {c: np.concatenate([g[c] for g in groups]) for c in groups[0]}
    at = np.repeat(np.arange(len(groups)), [len(g["i"]) for g in groups])
    spot, got = peaks._verdicts(distance, True, rows, halo).helper(table, at)
    want = []
    for g in groups:
        b, top = int(g["_at"][0]), np.flatnonzero(g["_cand"])
        first, last = (g["_end"] < 0).any(), (g["_end"] > 0).any()
        seen = (-np.inf if first else b * rows - halo, np.inf if last else (b + 1) * rows + halo - 1)
        space = kn.thin_by_distance(g["i"][top], g["v"][top], distance, *seen) if distance > 1 else np.full(len(top), kn.KEEP)
        stand = np.full(len(top), kn.KEEP)
        alive = np.flatnonzero(space != kn.DROP)
        stand[alive] = kn.reaches_prominence(g["i"], g["v"], top[alive], g["_need"][0], first, last)
        want += [(int(p), int(a), int(z)) for p, a, z in zip(g["i"][top], space, stand) if p // rows == b]
    assert list(zip(got["i"].tolist(), got["space"].tolist(), got["stand"].tolist())) == want and len(want) > 100


def test_a_tall_peak_looks_beyond_the_common_steps():
    n = 4 * peaks.STEPS
    val = np.append(np.linspace(5, 4, n), [9.0, *np.linspace(4, 5, n)])
    one = (val, np.array([n]), np.array([3.0]), np.array([0]), np.array([len(val)]))
    assert peaks._stand_out(*one, np.array([True]), np.array([True])).tolist() == [kn.KEEP]
    val[[0, -1]] = 1.0
    one = (val, np.array([n]), np.array([7.0]), np.array([0]), np.array([len(val)]))
    assert peaks._stand_out(*one, np.array([True]), np.array([True])).tolist() == [kn.KEEP]
    val[-1] = 2.5
    assert peaks._stand_out(*one, np.array([True]), np.array([False])).tolist() == [kn.OPEN]
    assert peaks._stand_out(*one, np.array([True]), np.array([True])).tolist() == [kn.DROP]


def test_artifacts_of_cycles_are_computed_once(spark):
    df = spark.createDataFrame([("a", 0, "ch1", 0.0, 1.0), ("a", 0, "ch1", 0.5, 2.0)], "recording_id string, cycle_index int, channel string, start double, end double")
    got = cycles.cycle_artifacts({"x": df.mapInPandas(lambda it: it, df.schema)}, [*K, "cycle_index"])
    assert "MapInPandas" not in plan(got)
    assert sorted((r.kind, r.start, r.end) for r in got.collect()) == [("all", 0.0, 2.0), ("x", 0.0, 1.0), ("x", 0.5, 2.0)]


@pytest.mark.parametrize("rows", [4, 7, 4096])
def test_resampling_of_long_dense_and_uneven_series(spark, rows):
    """Blocks without samples, many samples a grid step, repeated times, null keys."""
    rng = np.random.default_rng(rows)
    times = {"even": np.arange(90) / 10, None: np.sort(rng.random(400)) * 9, "gaps": np.array([0.0, 0.01, 0.02, 20.0, 20.5, 44.0, 44.0, 44.0, 60.0]), "two": np.array([1.0, 1.01])}
    series = {k: (t, rng.normal(size=len(t))) for k, t in times.items()}
    df = spark.createDataFrame([(k, i, float(a), float(b)) for k, (t, v) in series.items() for i, (a, b) in enumerate(zip(t, v))], "recording_id string, i long, t double, v double")
    got = {}
    for r in align.resample_uniform(df.repartition(5), K, "v", 2.0, rows=rows).collect():
        got.setdefault(r.recording_id, {})[r.i] = (r.t, r.v)
    for k, (t, v) in series.items():
        n = int((t[-1] - t[0]) * 2.0) + 1
        grid = t[0] + np.arange(n) * ((t[-1] - t[0]) / (n - 1) if n > 1 else 0.0)
        if n > 1:
            grid[-1] = t[-1]
        p = np.searchsorted(t, grid, side="right") - 1
        q = np.minimum(p + 1, len(t) - 1)
        want = [v[a] if a == b else v[a] + (v[b] - v[a]) * ((g - t[a]) / (t[b] - t[a])) for g, a, b in zip(grid, p, q)]
        assert sorted(got[k]) == list(range(n))
        np.testing.assert_allclose([got[k][i] for i in range(n)], np.array([grid, want]).T, rtol=1e-12)


def test_band_power_of_short_and_long_spans(spark):
    rng = np.random.default_rng(4)
    hz, full = 100.0, 800
    x = np.sin(2 * np.pi * 1.3 * np.arange(6000) / hz) + rng.normal(size=6000)
    uni = spark.createDataFrame([("a", i, i / hz, float(v)) for i, v in enumerate(x)], "recording_id string, i long, t double, v double")
    spans = [(1, 0.0, 3.0, 1.3), (2, 5.0, 12.985, 1.3), (3, 10.0, 17.99, 2.0), (4, 12.0, 55.0, 1.3), (5, 58.0, 58.02, 1.0)]
    df = spark.createDataFrame([("a", *s) for s in spans], "recording_id string, span_id long, start double, end double, target_hz double")
    out = audioqc.segment_bandpower(uni, df, K, hz, 0.35)
    assert "ArrowEvalPython" not in plan(out)
    got = {r.span_id: r.bandpower_ratio for r in out.collect()}
    t, want = np.arange(6000) / hz, {}
    for k, a, b, target in spans:
        part = x[(t >= a) & (t <= b)]
        if len(part) >= 4:
            freqs, p = kn.welch(part - part.mean(), hz, full)
            near = p[(freqs >= target * 0.65) & (freqs <= target * 1.35)]
            want[k] = (near.sum() - (near[0] + near[-1]) / 2) / (p.sum() - (p[0] + p[-1]) / 2) if len(near) else 0.0
    assert set(got) == set(want) == {1, 2, 3, 4}
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_mono_is_one_expression(spark):
    nan = float("nan")
    df = spark.createDataFrame([("a", 0, 0.0, 1.0, 2.0, None, nan), ("a", 1, 0.1, None, nan, None, nan), ("a", 2, 0.2, 1.0, 2.0, 3.0, 6.0), ("a", 3, None, 1.0, 1.0, 1.0, 1.0)],
                               "recording_id string, i long, t double, ch1 double, ch2 double, ch3 double, ch4 double")
    got = audioqc.mono(df, K)
    assert "lambda" not in plan(got)
    assert sorted((r.i, r.v) for r in got.collect()) == [(0, 1.5), (2, 3.0)]


@pytest.mark.parametrize("order", ["in order", "in no order"])
@pytest.mark.parametrize("fs", [100.0, 300.0])
def test_stomps_are_sought_where_the_samples_are(spark, order, fs):
    rng = np.random.default_rng(9)
    rows = []
    for k, n in (("a", 900), (None, 300), ("b", 17), ("c", 3), ("d", 200)):
        x = np.round(rng.normal(size=(n, 4)), 1)
        for i in range(n):
            if k == "d" and i in (50, 120):
                continue  # a gap
            v = [None if k == "d" and i % 40 == 7 and c == 2 else float(x[i, c]) for c in range(4)]
            rows.append((k, i, i / fs, *v))
    df = spark.createDataFrame(rows, "recording_id string, i long, t double, ch1 double, ch2 double, ch3 double, ch4 double").coalesce(1)
    df = df.repartition(6, F.xxhash64("i")) if order == "in no order" else df
    m = max(1, int(0.01 * fs))
    e = stomp.window_energy(df, K, CH, fs, 0.05)
    s = df.select(*K, "i", "t", envelope(list(CH)).alias("e"))
    s = moving_average(s, K, "e", m, "sm") if m > 1 else s.withColumn("sm", F.col("e"))
    g = gradient(s, K, "sm", "g").withColumn("g", F.abs("g")).filter("g IS NOT NULL")
    show = lambda d: sorted((repr(r[0]), r[1], round(r[2], 9)) for r in d.collect())
    loud = stomp.stomp_by_energy(df, K, CH, fs)
    assert "Generate" not in plan(loud)
    assert show(loud) == show(stomp._strongest(e, K, "energy", "x", "y"))
    assert show(stomp.stomp_by_onset(df, K, CH, fs)) == show(stomp._strongest(g, K, "g", "x", "y"))
