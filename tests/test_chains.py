"""Rules that walk a series in order give the same in blocks of any size, and no group outgrows its bound."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from kymora.functions import kernels as kn
from kymora.operators import peaks, segments, spectral
from kymora.plans import chains
from tests.conftest import series

K = ["recording_id"]


def plain_spans(times, tolerance, least):
    """Spans of event times whose rate stays near the first rate of the span, one step after the other."""
    rate, found, first = 1.0 / np.diff(times), [], 0
    for k in range(1, len(rate) + 1):
        if k == len(rate) or abs(rate[k] - rate[first]) / rate[first] > tolerance:
            if k - first + 1 >= least:
                found.append((times[first], times[k]))
            first = k
    return found


def plain_segments(times, least, tolerance):
    ladder = (tolerance, *segments.RATE_LADDER)
    tried = [plain_spans(times, t, least) for t in ladder]
    full = [t for t in tried if len(t) >= 3]
    got = full[0] if full else max(tried, key=len)
    if len(got) != 2:
        return got
    a, b = max(got, key=lambda s: (s[1] - s[0], -s[0]))
    inner = times[(times >= a) & (times <= b)]
    parts = next((p for p in (plain_spans(inner, s, least) for s in segments.RATE_SPLITS) if len(p) > 1), None)
    return sorted([s for s in got if s != (a, b)] + parts) if parts else got


def walks(rng):
    yield "uneven", np.cumsum(rng.exponential(1.0, 900))
    yield "steady", np.cumsum(rng.uniform(0.49, 0.51, 900))  # no step that must begin a span
    yield "drifting", np.cumsum(1.0 / np.linspace(1.0, 3.0, 900))
    yield "waving", np.cumsum(1.0 / (2 + 0.3 * np.sin(np.arange(900) / 25) + rng.normal(0, 0.005, 900)))
    yield "two", np.cumsum(np.concatenate([rng.uniform(0.495, 0.505, 60), [9.0], rng.uniform(0.69, 0.695, 25), rng.uniform(0.70, 0.72, 30)]))
    yield "few", np.array([1.0, 2.0, 3.0])


@pytest.mark.parametrize("rows", [16, 64, 100_000])
def test_rate_segments(spark, rows):
    rng = np.random.default_rng(8)
    data = dict(walks(rng))
    df = None
    for name, t in data.items():
        part = series(spark, {"t": t}, key=name)
        df = part if df is None else df.unionByName(part)
    got = {}
    for r in segments.rate_segments(df, K, 4, 0.08, rows).collect():
        got.setdefault(r.recording_id, []).append((round(r.start, 6), round(r.end, 6)))
    for name, t in data.items():
        want = [(round(a, 6), round(b, 6)) for a, b in plain_segments(t, 4, 0.08)]
        assert sorted(got.get(name, [])) == sorted(want), name


def test_events_of_one_time_have_an_infinite_rate(spark):
    df = series(spark, {"t": np.array([0.0, 1.0, 2.0, 2.0, 3.0, 4.0, 5.0])})
    assert [r.hz for r in segments.event_steps(df, K).orderBy("i").collect()] == [1.0, 1.0, float("inf"), 1.0, 1.0, 1.0]
    assert [(r.start, r.end) for r in segments.rate_segments(df, K, 3, 0.1).collect()] == [(0.0, 2.0), (2.0, 5.0)]


def test_maps_compose_in_any_grouping():
    rng = np.random.default_rng(9)
    leaves = lambda met, state, tol: np.abs(met - state) > tol
    for _ in range(50):
        values = rng.normal(0, 1, 40)
        out = {}
        for k in reversed(range(40)):
            nxt = next((j for j in range(k + 1, 40) if abs(values[j] - values[k]) > 0.5), None)
            out[k] = values[k] if nxt is None else out[nxt]
        met = chains.outermost(values)
        for state in rng.normal(0, 2, 20):
            k = next((j for j in range(40) if abs(values[j] - state) > 0.5), None)
            assert chains.out_of(values[met], np.array([out[j] for j in met]), state, 0.5, leaves) == (state if k is None else out[k])


def plain_groups(rows, tolerance):
    out, now = [], []
    for hz, *rest in sorted(rows):
        if now and abs(hz - np.mean([r[0] for r in now])) / np.mean([r[0] for r in now]) > tolerance:
            out.append(now)
            now = []
        now.append((hz, *rest))
    return out + [now]


def test_speed_groups(spark):
    rng = np.random.default_rng(10)
    rows = [("wide", round(float(x), 2)) for x in rng.uniform(0.5, 3, 300)] + [("close", float(x)) for x in np.linspace(1, 1.5, 400)] + [("one", 1.0), ("one", 1.0), (None, 2.0), (None, 2.05)]
    df = spark.createDataFrame([(k, hz, 0.5 + i % 2 * 0.5, 0.25, float(i), float(i + 2), 3, i % 3 > 0) for i, (k, hz) in enumerate(rows)],
                               "recording_id string, gait_cycle_hz double, coverage_frac double, bandpower_ratio double, start double, end double, heel_strike_count int, passed boolean")
    got = {}
    for r in segments.speed_groups(df, K, 0.06).collect():
        got.setdefault(r.recording_id, []).append((r.speed_group, round(r.gait_cycle_hz, 9), r.pass_count, r.duration_s, r.heel_strike_count))
    for key in {k for k, _ in rows}:
        groups = plain_groups([(hz,) for k, hz in rows if k == key], 0.06)
        assert [(g[1], g[2]) for g in sorted(got[key])] == [(round(float(np.mean([r[0] for r in g])), 9), len(g)) for g in groups]
        assert all(d == 2.0 * n and h == 3 * n for _, _, n, d, h in got[key])


def largest(monkeypatch, module):
    """Records the largest group that the module hands to a helper."""
    seen = []
    inner = module.grouped_map

    def watch(df, group, *rest):
        seen.append(df.groupBy(*group).count().agg(F.max("count")).first()[0] or 0)
        return inner(df, group, *rest)

    monkeypatch.setattr(module, "grouped_map", watch)
    return seen


def ramps(rng, n):
    t = np.arange(n)
    yield "up", t * 0.01 + rng.uniform(0, 0.05, n)
    yield "down", -t * 0.01 + rng.uniform(0, 0.05, n)
    yield "saw", t * 0.01 + np.tile([0.0, 0.02], n // 2 + 1)[:n]
    yield "noisy", t * 0.01 + rng.uniform(0, 0.6, n)
    yield "hill", -np.abs(t - n / 3) * 0.01 + rng.uniform(0, 0.1, n)
    yield "valley", np.abs(t - n / 3) * 0.01 + rng.uniform(0, 0.1, n)
    yield "ties", np.tile([0.0, 1.0], n // 2 + 1)[:n]
    yield "random", rng.normal(0, 1, n)


@pytest.mark.parametrize("prominence", [None, 0.04])
def test_spacing_along_chains_over_a_hundred_blocks(spark, monkeypatch, prominence):
    gap, rows, n = 20, 64, 25_600
    data = dict(ramps(np.random.default_rng(11), n))
    df = spark.createDataFrame(pd.concat([pd.DataFrame({"recording_id": k, "i": np.arange(n), "x": v}) for k, v in data.items()]))
    seen = largest(monkeypatch, peaks)
    got = {}
    for r in peaks.find_peaks(df, K, "x", distance=gap, prominence=prominence, rows=rows).collect():
        got.setdefault(r.recording_id, []).append(r.i)
    for name, x in data.items():
        assert sorted(got.get(name, [])) == kn.find_peaks(x, distance=gap, prominence=prominence).tolist(), name
    view = max(4 * rows, 8 * gap)
    assert max(seen) <= view + 2 * (view // 8 + 2 * gap)


def test_lags_of_an_aperiodic_series_in_bounded_groups(spark, monkeypatch):
    rng = np.random.default_rng(12)
    n, rows = 3000, 64
    x = np.cumsum(rng.normal(0, 1, n))
    y = np.sin(np.arange(500) / 3) + rng.normal(0, 0.1, 500)
    df = spark.createDataFrame(pd.concat([pd.DataFrame({"recording_id": k, "_n": len(v), "i": np.arange(len(v)), "x": v}) for k, v in (("a", x), (None, y))]))
    seen = largest(monkeypatch, spectral)
    for low, high in ((0, 1000), (1000, 3100), (63, 65)):
        got = {(r.recording_id, r.i): r.s for r in spectral.lag_sums(df, K, low, high, rows).collect()}
        for key, v in (("a", x), (None, y)):
            lags = range(low, min(high, len(v)))
            np.testing.assert_allclose([got.pop((key, k)) for k in lags], [np.dot(v[: len(v) - k], v[k:]) for k in lags], atol=1e-6 * np.dot(v, v))
        assert not got
    assert max(seen) <= spectral.CORR_PAIRS


def test_movement_frequency_of_a_series_without_one(spark):
    """A peak far out, and none at all: all lags are tried."""
    t = np.arange(4000)
    late = np.sin(2 * np.pi * t / 900)
    df = series(spark, {"t": t / 10.0, "a": late}, key="late").unionByName(series(spark, {"t": t[:2000] / 10.0, "a": t[:2000] * 1.0}, key="ramp"))
    df = df.unionByName(series(spark, {"t": t[:99] / 10.0, "a": late[:99]}, key="short"))
    got = {r.recording_id: r.movement_hz for r in spectral.movement_frequency(df, K, "a", 10.0, first_lag_s=10.0, rows=128).collect()}
    assert set(got) == {"late"} and abs(got["late"] - 10 / 900) < 2e-4


@pytest.mark.parametrize("fs", [1000.0, 250.0])
def test_frequency_is_the_same_in_any_blocks(spark, fs):
    rng = np.random.default_rng(13)
    n = 20_000
    t = np.arange(n) / fs
    noisy = np.sin(2 * np.pi * 60 * t) + rng.normal(0, 0.5, n)
    gaps = np.where(np.arange(n) % 50 == 0, np.nan, np.sin(2 * np.pi * 40 * t))
    few = np.where(np.arange(n) < 3, 1.0, np.nan)
    df = series(spark, {"t": t, "x": noisy, "y": gaps, "z": few})
    parts = [spectral.instantaneous_frequency(df, K, ["x", "y", "z"], fs, 10, 110, rows=r).orderBy("i").toPandas() for r in (1 << 20, 10_000, 8_200)]
    for c in ("f_x", "f_y"):
        for p in parts[1:]:
            np.testing.assert_allclose(p[c], parts[0][c], atol=1e-6)
    assert parts[0]["f_z"].isna().all() and abs(parts[0]["f_y"][2000:-2000].median() - 40) < 0.2


def whole_series_frequency(x, fs, low, high, order=4):
    """Forward-backward band-pass and analytic signal over the whole series by its own transform."""
    pad = min(int(fs), len(x) - 1)
    y = x - x.mean()
    y = np.concatenate((2 * y[0] - y[pad:0:-1], y, 2 * y[-1] - y[-2 : -pad - 2 : -1]))
    f = np.fft.rfftfreq(len(y), 1 / fs)
    y = np.fft.irfft(np.fft.rfft(y) * kn.butterworth_power(f, fs, low, min(high, fs / 2 * 0.999), order), len(y))[pad : pad + len(x)]
    gain = np.zeros(len(y))
    gain[0], gain[1 : (len(y) + 1) // 2] = 1, 2
    gain[len(y) // 2] = 1 if len(y) % 2 == 0 else gain[len(y) // 2]
    return np.gradient(np.unwrap(np.angle(np.fft.ifft(np.fft.fft(y) * gain))), 1 / fs) / (2 * np.pi)


def test_frequency_is_close_to_that_of_the_whole_series(spark):
    fs, n = 1000.0, 40_000
    t = np.arange(n) / fs
    x = np.sin(2 * np.pi * 60 * t + 3 * np.sin(2 * np.pi * 0.3 * t)) + np.random.default_rng(14).normal(0, 0.05, n)
    got = spectral.instantaneous_frequency(series(spark, {"t": t, "x": x}), K, ["x"], fs, 10, 400, rows=8200).orderBy("i").toPandas()["f_x"].to_numpy()
    off = np.abs(got - whole_series_frequency(x, fs, 10, 400))
    assert np.median(off) < 0.01 and off[2000:-2000].max() < 0.05


def test_frames_are_cut_from_blocks_that_travel_once(spark, monkeypatch):
    rng = np.random.default_rng(15)
    n, length, step = 5000, 50, 13
    x = rng.normal(size=n)
    df = series(spark, {"t": np.arange(n) / 10, "x": x}).filter("i <> 3000").unionByName(series(spark, {"t": np.arange(20) / 10, "x": x[:20]}, key=None))
    sent = []
    inner = spectral.grouped_map
    monkeypatch.setattr(spectral, "grouped_map", lambda d, *rest: (sent.append(d.count()), inner(d, *rest))[1])
    monkeypatch.setattr(spectral, "FRAME_VALUES", 400)
    got = {r.frame: r for r in spectral.frame_map(df, K, "x", length, step, "m double, y array<double>", lambda v: {"m": v.mean(axis=1), "y": list(v[:, :2])}, rows=256).collect()}
    want = [f for f in range((n - length) // step + 1) if not f * step <= 3000 < f * step + length]
    assert sorted(got) == want and sent[0] <= 1.3 * df.count()
    for f in want:
        part = x[f * step : f * step + length]
        assert abs(got[f].m - part.mean()) < 1e-12 and got[f].y == part[:2].tolist() and (got[f].t0, got[f].t1) == (f * step / 10, (f * step + length - 1) / 10)
