"""Results do not depend on where series are cut, nor on one key holding most rows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from kymora.functions import kernels as kn
from kymora.operators import align, cycles, detectors, intervals, peaks, segments, spectral, windows
from kymora.plans.blocks import true_runs, with_sample_index
from kymora.plans.quantiles import quantiles
from tests.conftest import series

K = ["recording_id"]


@pytest.fixture(scope="module")
def skewed(spark):
    """One recording with two thirds of the rows, several short ones."""
    rng = np.random.default_rng(7)
    parts = []
    for key, n in (("hot", 3000), ("b", 700), ("c", 300), ("d", 40), ("e", 1)):
        x = np.round(rng.normal(0, 1, n), 1)
        parts.append(pd.DataFrame({"recording_id": key, "i": np.arange(n), "t": np.arange(n) / 100, "x": x, "y": rng.normal(1, 0.2, n)}))
    pdf = pd.concat(parts, ignore_index=True)
    return spark.createDataFrame(pdf).cache(), pdf


def same(df, expected: pd.DataFrame, on, columns, tol=1e-9):
    got = df.toPandas().sort_values(on).reset_index(drop=True)
    want = expected.sort_values(on).reset_index(drop=True)
    assert len(got) == len(want)
    for c in columns:
        np.testing.assert_allclose(got[c].astype(float), want[c].astype(float), rtol=tol, atol=tol)


@pytest.mark.parametrize("window", [5, 21, 101])
@pytest.mark.parametrize("rows", [64, 16384])
def test_sliding_stats(skewed, window, rows):
    df, pdf = skewed
    h = window // 2

    def brute(g):
        x = g["x"].to_numpy()
        spans = [x[max(0, k - h) : k + h + 1] for k in range(len(x))]
        return g.assign(x_rms=[np.sqrt(np.mean(s * s)) for s in spans], x_var=[s.var() for s in spans], x_mean=[s.mean() for s in spans], x_std=[s.std() for s in spans])

    want = pd.concat([brute(g) for _, g in pdf.groupby("recording_id")])
    got = windows.sliding_stats(df, K, ["x"], window, rows=rows)
    same(got, want, ["recording_id", "i"], ["x_rms", "x_var", "x_mean", "x_std"], 1e-7)


def test_missing_samples_count_as_zero(spark):
    df = series(spark, {"t": [0.0, 1.0, 2.0], "x": [3.0, None, 3.0]})
    got = windows.sliding_stats(df, K, ["x"], 3, ("mean",)).orderBy("i").toPandas()["x_mean"]
    np.testing.assert_allclose(got, [1.5, 2.0, 1.5])


@pytest.mark.parametrize("rows", [16, 16384])
def test_true_runs(skewed, rows):
    df, pdf = skewed
    want = []
    for key, g in pdf.groupby("recording_id"):
        m = np.concatenate(([False], (g["x"] > -0.8).to_numpy(), [False])).astype(int)
        a, b = np.flatnonzero(np.diff(m) == 1), np.flatnonzero(np.diff(m) == -1) - 1
        want += [(key, int(p), int(q)) for p, q in zip(a, b)]
    got = true_runs(df, K, F.col("x") > -0.8, rows=rows)
    assert sorted((r.recording_id, r.first_i, r.last_i) for r in got.collect()) == sorted(want)


def test_one_run_over_many_blocks(spark):
    df = series(spark, {"t": np.arange(1000) / 10.0, "x": np.ones(1000)})
    assert [(r.first_i, r.last_i) for r in true_runs(df, K, F.col("x") > 0, rows=32).collect()] == [(0, 999)]


def test_sample_index_of_a_hot_key(skewed):
    df, pdf = skewed
    got = with_sample_index(df.drop("i"), K, ["t"]).toPandas()
    np.testing.assert_array_equal(got["i"], np.round(got["t"] * 100))


def test_quantiles(skewed):
    df, pdf = skewed
    got = quantiles(df, K, "x", {"q": 0.33, "m": 0.5}).toPandas().set_index("recording_id")
    for key, g in pdf.groupby("recording_id"):
        np.testing.assert_allclose([got.loc[key, "q"], got.loc[key, "m"]], [np.percentile(g["x"], 33), np.median(g["x"])])
    np.testing.assert_allclose(quantiles(df, [], "x", {"m": 0.5}).first()["m"], pdf["x"].median())


@pytest.mark.parametrize("rows", [32, 16384])
@pytest.mark.parametrize("rule", [dict(distance=7), dict(prominence=1.5), dict(height=0.5, distance=9, prominence=1.0), dict(prominence=6.5), dict(distance=400)])
def test_peaks_by_brute_force(skewed, rows, rule):
    df, pdf = skewed
    want = []
    for key, g in pdf.groupby("recording_id"):
        want += [(key, int(p)) for p in brute_peaks(g["x"].to_numpy(), **rule)]
    got = peaks.find_peaks(df, K, "x", rows=rows, **rule)
    assert sorted((r.recording_id, r.i) for r in got.collect()) == sorted(want)


def brute_peaks(x, height=None, distance=None, prominence=None):
    """Plain restatement of the peak rule, one sample at a time."""
    n, tops, k = len(x), [], 1
    while k < n - 1:
        if x[k - 1] < x[k]:
            e = k
            while e < n - 1 and x[e + 1] == x[k]:
                e += 1
            if e < n - 1 and x[e + 1] < x[k]:
                tops.append((k + e) // 2)
            k = e + 1
        else:
            k += 1
    if height is not None:
        tops = [p for p in tops if x[p] >= height]
    if distance is not None:
        keep = set(tops)
        for p in sorted(tops, key=lambda p: (x[p], p), reverse=True):
            if p in keep:
                keep -= {q for q in tops if q != p and abs(q - p) < distance}
        tops = sorted(keep)
    if prominence is not None:

        def stands(p):
            bases = []
            for step in (-1, 1):
                low, q = x[p], p
                while 0 <= q < n and x[q] <= x[p]:
                    low, q = min(low, x[q]), q + step
                bases.append(low)
            return x[p] - max(bases) >= prominence

        tops = [p for p in tops if stands(p)]
    return tops


def test_gradient_and_unwrap_match_numpy(skewed):
    df, pdf = skewed
    g = windows.gradient(df, K, "x", "g", rows=50).toPandas()
    u = windows.unwrap_phase(df.withColumn("p", F.col("y") * 9), K, "p", "u", rows=50).toPandas()
    for key in ("hot", "b", "d"):
        want = pdf[pdf.recording_id == key]
        np.testing.assert_allclose(g[g.recording_id == key].sort_values("i")["g"], np.gradient(want["x"]), atol=1e-12)
        np.testing.assert_allclose(u[u.recording_id == key].sort_values("i")["u"], np.unwrap(want["y"] * 9), atol=1e-9)


def test_interval_merge_is_idempotent_and_skew_proof(spark):
    rng = np.random.default_rng(3)
    s = rng.uniform(0, 500, 2000)
    pdf = pd.DataFrame({"recording_id": np.where(np.arange(2000) % 3 == 0, "hot", "x" ), "start": s, "end": s + rng.exponential(0.3, 2000)})
    df = spark.createDataFrame(pdf)
    once = intervals.merge_intervals(df, K, 0.1)
    want = []
    for key, g in pdf.sort_values("start").groupby("recording_id"):
        out = []
        for a, b in zip(g["start"], g["end"]):
            if out and a <= out[-1][1] + 0.1:
                out[-1][1] = max(out[-1][1], b)
            else:
                out.append([a, b])
        want += [(key, *o) for o in out]
    assert sorted(map(tuple, once.select("recording_id", "start", "end").collect())) == sorted(want)
    assert intervals.merge_intervals(once, K, 0.1).exceptAll(once).count() == 0


def test_unflatten_rejects_odd_lengths(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0],), ([1.0, 2.0, 3.0, 4.0],), ([],)], "f array<double>")
    got = [len(r.p) for r in df.select(intervals.unflatten_pairs(F.col("f")).alias("p")).collect()]
    assert got == [0, 2, 0]


def test_asof_ties_pick_the_earlier_row(spark):
    left = series(spark, {"t": [1.0, 5.0, 9.0]})
    right = series(spark, {"t": [0.5, 1.5, 6.5], "v": [1.0, 2.0, 3.0]})
    got = align.asof_nearest(left, right, K, 1.5).orderBy("t").collect()
    assert [r.r_v for r in got] == [1.0, 3.0, None]


def test_asof_matches_pandas(skewed, spark):
    df, pdf = skewed
    rng = np.random.default_rng(1)
    r = pd.concat([pd.DataFrame({"recording_id": k, "i": np.arange(n), "t": np.sort(rng.uniform(0, 30, n)), "v": rng.normal(size=n)}) for k, n in (("hot", 400), ("b", 50))])
    got = align.asof_nearest(df.select("recording_id", "i", "t"), spark.createDataFrame(r), K, 0.03).toPandas()
    for key in ("hot", "b", "c"):
        w = pd.merge_asof(pdf[pdf.recording_id == key][["t"]], r[r.recording_id == key][["t", "v"]], on="t", direction="nearest", tolerance=0.03)
        np.testing.assert_allclose(got[got.recording_id == key].sort_values("t")["r_v"].astype(float), w["v"], equal_nan=True)


def test_interpolation_fills_only_inside(spark):
    x = [None, 2.0, None, None, 8.0, None]
    df = series(spark, {"t": np.arange(6.0), "x": x})
    got = align.interpolate_inside(df, K, ["x"], rows=2).orderBy("i").toPandas()["x"]
    np.testing.assert_allclose(got, [np.nan, 2, 4, 6, 8, np.nan], equal_nan=True)


def test_savgol_and_decimation_ignore_block_edges(skewed):
    df, pdf = skewed
    for f in (lambda r: spectral.savgol(df, K, "x", "s", 51, 3, rows=r).select("recording_id", "i", "s"), lambda r: spectral.decimate(df, K, ["x"], 4, rows=r)):
        a, b = f(128), f(1 << 20)
        name = a.columns[-1]
        j = a.withColumnRenamed(name, "p").join(b.withColumnRenamed(name, "q"), ["recording_id", "i"])
        assert j.count() == a.count() == b.count()
        assert j.agg(F.max(F.abs(F.col("p") - F.col("q")))).first()[0] < 1e-9


def test_savgol_reproduces_a_cubic():
    t = np.linspace(0, 1, 200)
    y = 3 * t**3 - t + 2
    np.testing.assert_allclose(kn.savgol(y, 51, 3), y, atol=1e-9)


def test_movement_frequency_of_a_sine(spark):
    t = np.arange(6000) / 100.0
    df = series(spark, {"t": t, "a": 40 + 30 * np.sin(2 * np.pi * 0.25 * t)})
    got = spectral.movement_frequency(df, K, "a", 100.0).first()["movement_hz"]
    assert abs(got - 0.25) < 0.01


def test_slow_movement_needs_more_lags(spark):
    t = np.arange(6000) / 10.0
    df = series(spark, {"t": t, "a": np.sin(2 * np.pi * t / 100)})
    got = spectral.movement_frequency(df, K, "a", 10.0, first_lag_s=20.0).first()["movement_hz"]
    assert abs(got - 0.01) < 0.0005


def test_dropout_and_spikes_at_known_times(spark):
    rng = np.random.default_rng(2)
    fs = 1000.0
    x = 1.5 + rng.normal(0, 0.05, 5000)
    x[2000:3200] = 1.5
    x[4200:4220] += 3.0
    df = series(spark, {"t": np.arange(5000) / fs, "ch1": x})
    flat = detectors.detect_dropout(df, fs, ["ch1"], window_s=0.1).collect()
    assert len(flat) == 1 and abs(flat[0].start - 2.05) < 0.01 and abs(flat[0].end - 3.15) < 0.01
    hot = detectors.detect_spikes(df, fs, ["ch1"], window_s=2.0, min_s=0.005).collect()
    assert len(hot) == 1 and abs(hot[0].start - 4.2) < 0.002 and hot[0].artifact_type == "Intermittent"


def test_overlap_fraction_counts_unmerged_twice(spark):
    w = spark.createDataFrame([("a", 0, 0.0, 10.0), ("a", 1, 10.0, 20.0)], "recording_id string, cycle_index int, w_start double, w_end double")
    b = spark.createDataFrame([("a", 1.0, 3.0), ("a", 2.0, 4.0), ("a", 9.0, 11.0)], "recording_id string, start double, end double")
    got = {r.cycle_index: round(r.overlap_fraction, 9) for r in intervals.overlap_fraction(w, b, K).collect()}
    assert got == {0: 0.5, 1: 0.1}


def test_cycle_numbers_follow_their_start(spark):
    cuts = spark.createDataFrame([("a", 500, 600), ("a", 20, 90), ("a", 100, 400)], "recording_id string, first_i bigint, last_i bigint")
    got = {r.first_i: r.cycle_index for r in cycles.number_cycles(cuts, K, rows=64).collect()}
    assert got == {20: 0, 100: 1, 500: 2}


@pytest.mark.parametrize("seed", [0, 1])
@pytest.mark.parametrize("distance", [None, 5])
def test_peaks_far_from_their_bases_need_no_whole_series(spark, seed, distance):
    """A slow swell with ripples: bases lie many blocks away, the top peak mid-way, keys partly null."""
    from kymora.functions import kernels
    from kymora.operators import peaks
    from kymora.plans import grouped

    rng = np.random.default_rng(seed)
    n = 6000
    x = np.sin(np.pi * np.arange(n) / n) * 20 + rng.normal(size=n).cumsum() * 0.05 + rng.normal(size=n) * 0.3
    x[n // 2] += 10
    rows = [(None if k else "a", i, float(v)) for k in (0, 1) for i, v in enumerate(x if not k else x[::-1])]
    df = spark.createDataFrame(rows, "k string, i long, x double")
    largest, run = [], grouped.grouped_map

    def watched(df, group, order, columns, schema, helper):
        largest.append(df.groupBy(*group).count().agg({"count": "max"}).first()[0])
        return run(df, group, order, columns, schema, helper)

    peaks.grouped_map = watched
    try:
        got = peaks.find_peaks(df, ["k"], "x", distance=distance, prominence=1.0, rows=16).collect()
    finally:
        peaks.grouped_map = run
    want = {("a", int(i)) for i in kernels.find_peaks(x, None, distance, 1.0)} | {(None, int(i)) for i in kernels.find_peaks(x[::-1], None, distance, 1.0)}
    assert {(r.k, r.i) for r in got} == want and len(want) > 4
    assert max(largest) < n // 8


@pytest.mark.parametrize("parts", [1, 7, 60])
def test_sample_index_takes_one_shuffle(spark, parts):
    """Positions over many partitions, keys null, rows twice; what is read later needs no shuffle and holds no ordering columns."""
    rng = np.random.default_rng(8)
    rows = [(k, s, int(x), float(x % 3)) for k, s, n in [(None, "a", 40), (1, None, 500), (1, "a", 3), (2, "b", 90), (3, "b", 1)] for x in rng.integers(0, n, n)]
    df = spark.createDataFrame(rows, "k long, s string, x long, y double").repartition(5)
    got = with_sample_index(df, ["k", "s"], ["x"], kept=["k", "s", "y"], parts=parts)
    assert got.columns == ["k", "s", "y", "i"] and "Exchange" not in got._jdf.queryExecution().toString()
    found = sorted(map(repr, map(tuple, got.collect())))
    want = []
    for key in {r[:2] for r in rows}:
        own = sorted(r[2:] for r in rows if r[:2] == key)
        want += [(*key, y, i) for i, (_, y) in enumerate(own)]
    assert found == sorted(map(repr, want))
    assert with_sample_index(df.filter("false"), ["k", "s"], ["x"]).count() == 0
