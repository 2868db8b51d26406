"""Closed-form recordings: cutting, shape and sound rules, stomps, heel strikes and the whole job."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from kymora.functions import kernels as kn
from kymora.operators import audioqc, cycles, stomp
from kymora.plans import pipeline
from tests.conftest import series

K = ["recording_id"]
CK = ["recording_id", "cycle_index"]
CH = ["ch1", "ch2", "ch3", "ch4"]


def walk(n=4000, fs=1000.0):
    t = np.arange(n) / fs
    return t, 20 - 30 * np.cos(2 * np.pi * t)


def sit_to_stand(fs=1000.0):
    one = np.concatenate([np.full(int(2 * fs), 90.0), np.linspace(90, 10, int(fs)), np.full(int(2 * fs), 10.0)])
    a = np.tile(one, 3)
    return np.arange(len(a)) / fs, a


def flexion(n=10000, fs=1000.0):
    t = np.arange(n) / fs
    return t, 50 + 40 * np.sin(np.pi * t - np.pi / 2)


@pytest.mark.parametrize("rows", [700, 16384])
def test_walk_cycles(spark, rows):
    t, a = walk()
    got = cycles.cut_cycles(series(spark, {"t": t, "angle": a}), K, "angle", 1000.0, "walk", rows).orderBy("cycle_index").collect()
    assert [r.cycle_index for r in got] == [0, 1]
    assert [abs(r.first_i - w) <= 2 for r, w in zip(got, (1000, 2000))] == [True, True]
    assert got[0].last_i - got[0].first_i == 999 and got[1].last_i - got[1].first_i == 1000


def test_flexion_cycles(spark):
    t, a = flexion()
    got = cycles.cut_cycles(series(spark, {"t": t, "angle": a}), K, "angle", 1000.0, "flexion_extension").orderBy("first_i").collect()
    assert [(r.first_i, r.last_i) for r in got] == [(2000, 3999), (4000, 5999), (6000, 7999)]


def test_sit_to_stand_falls_back_to_the_whole(spark):
    t = np.arange(3000) / 1000.0
    one = series(spark, {"t": t, "angle": 50 + 0.001 * t})
    got = cycles.cut_cycles(one, K, "angle", 1000.0, "sit_to_stand").collect()
    assert [(r.first_i, r.last_i) for r in got] == [(0, 2999)]
    t, a = sit_to_stand()
    got = cycles.cut_cycles(series(spark, {"t": t, "angle": a}), K, "angle", 1000.0, "sit_to_stand").collect()
    assert len(got) == 1 and got[0].last_i > got[0].first_i


def _one(spark, angle, env=None):
    n = len(angle)
    env = np.ones(n) if env is None else env
    return series(spark, {"t": np.arange(n) / 100.0, "angle": np.asarray(angle, float), **{c: env for c in CH}}, cycle_index=0).withColumn("cycle_index", F.lit(0))


@pytest.mark.parametrize(
    "maneuver, angle, ok, code",
    [
        ("walk", 30 + 30 * np.sin(np.linspace(-np.pi / 2, 3 * np.pi / 2, 200)), True, None),
        ("walk", np.linspace(0, 5, 200), False, "small_range"),
        ("walk", np.linspace(0, 50, 200), False, "open_ends"),
        ("walk", np.concatenate([np.linspace(0, 60, 20), np.linspace(60, 0, 180)]), False, "peak_position"),
        ("walk", 30 + 30 * np.sin(np.linspace(-np.pi / 2, 7.5 * np.pi, 400)), False, "extra_peaks"),
        ("walk", [1.0] * 5, False, "few_samples"),
        ("flexion_extension", 50 + 40 * np.sin(np.linspace(-np.pi / 2, 3 * np.pi / 2, 200)), True, None),
        ("sit_to_stand", 50 + 40 * np.cos(np.linspace(0, 2 * np.pi, 200)), True, None),
        ("sit_to_stand", 50 - 40 * np.cos(np.linspace(0, 2 * np.pi, 200)), True, None),
        ("sit_to_stand", np.linspace(90, 10, 200), False, "open_ends"),
    ],
)
def test_shape_rules(spark, maneuver, angle, ok, code):
    row = cycles.shape_rules(_one(spark, angle), CK, "angle", maneuver).first()
    assert (row.shape_ok, row.shape_reason) == (ok, code) and (row.shape_value is None) == ok


def test_shape_ignores_missing_values_up_to_a_fifth(spark):
    angle = 30 + 30 * np.sin(np.linspace(-np.pi / 2, 3 * np.pi / 2, 200))
    few, many = angle.copy(), angle.copy()
    few[40:70], many[40:100] = np.nan, np.nan
    assert cycles.shape_rules(_one(spark, few), CK, "angle", "walk").first().shape_ok
    bad = cycles.shape_rules(_one(spark, many), CK, "angle", "walk").first()
    assert bad.shape_reason == "low_valid_share" and bad.shape_value == pytest.approx(0.7)


@pytest.mark.parametrize(
    "maneuver, env, ok",
    [
        ("walk", 0.1 + np.exp(-((np.arange(200) - 60) ** 2) / 50), True),
        ("walk", 0.1 + np.exp(-((np.arange(200) - 180) ** 2) / 50), False),
        ("walk", np.full(200, 0.5), False),
        ("sit_to_stand", np.where((np.arange(210) >= 70) & (np.arange(210) < 140), 1.0, 0.5), True),
        ("sit_to_stand", np.full(210, 0.5), False),
        ("flexion_extension", 0.1 + np.exp(-((np.arange(200) - 100) ** 2) / 50), True),
        ("flexion_extension", 0.1 + np.exp(-((np.arange(200) - 20) ** 2) / 50), False),
        ("walk", np.full(200, 1e-5), False),
    ],
)
def test_sound_rules(spark, maneuver, env, ok):
    assert cycles.sound_rules(_one(spark, np.zeros(len(env)), env), CK, maneuver).first().sound_ok is ok


def test_sync_quality_scores_nearness(spark):
    n = 400
    angle = 40 - 30 * np.cos(2 * np.pi * np.arange(n) / 200)
    near = 0.1 + sum(np.exp(-((np.arange(n) - c) ** 2) / 20) for c in (205,))
    far = 0.1 + sum(np.exp(-((np.arange(n) - c) ** 2) / 20) for c in (100,))
    assert cycles.sync_quality(_one(spark, angle, near), CK, "angle", "walk").first().sync_quality_score > 0.9
    row = cycles.sync_quality(_one(spark, angle, far), CK, "angle", "walk").first()
    assert row.sync_quality_score == 0.0 and not row.sync_qc_pass


def test_energy_is_the_trapezoid_area(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=500)
    got = cycles.cycle_energy(_one(spark, np.zeros(500), x), CK, rows=64).first().acoustic_energy
    np.testing.assert_allclose(got, 4 * np.trapezoid(np.abs(x), np.arange(500) / 100.0))


def test_template_match_prefers_its_own_shape(spark):
    up = np.linspace(0, 1, 80) ** 2
    env = _one(spark, np.zeros(80), up).select(*CK, "i", F.col("ch1").alias("e"))
    rows = [("same", k, float(v)) for k, v in enumerate(np.linspace(0, 1, 40) ** 2)] + [("other", k, float(-v)) for k, v in enumerate(np.linspace(0, 1, 40))]
    got = {r.template: r for r in cycles.template_match(env, spark.createDataFrame(rows, "template string, k int, ref double"), CK, "e", 40, 0.5, 0.5).collect()}
    assert set(got) == {"same"} and got["same"].r > 0.999 and got["same"].dtw < 0.1


def plain_warped(a, b):
    m = np.full((len(a) + 1, len(b) + 1), np.inf)
    m[0, 0] = 0
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            m[i, j] = abs(a[i - 1] - b[j - 1]) + min(m[i - 1, j], m[i, j - 1], m[i - 1, j - 1])
    return m[-1, -1] / max(len(a), len(b))


@pytest.mark.parametrize("n,m", [(17, 23), (23, 17), (12, 12), (1, 5), (1, 1)])
def test_warped_distances_and_their_bound(n, m):
    rng = np.random.default_rng(4)
    a, b = rng.normal(size=(40, n)), rng.normal(size=(40, m)) * rng.uniform(0.2, 3, (40, 1))
    want = np.array([plain_warped(x, y) for x, y in zip(a, b)])
    np.testing.assert_allclose(kn.warped(a, b), want)
    assert (kn.warped_bound(a, b) <= want + 1e-12).all()
    some = np.median(want)
    got = kn.warped(a, b, some)
    np.testing.assert_allclose(got[want <= some], want[want <= some])
    assert (got[want > some * (1 + 1e-6)] > some).all()


@pytest.mark.parametrize("block", [3, 1024])
def test_template_hits_are_those_of_all_pairs(spark, block):
    rng = np.random.default_rng(5)
    t = np.arange(50) / 50
    shapes = [np.sin(2 * np.pi * (t * f + p)) for f in (1, 2, 3) for p in (0, 0.2, 0.5)] + [np.zeros(50)]
    cycle = {k: np.interp(t, t ** rng.uniform(0.8, 1.25), shapes[k % 9]) + rng.normal(0, rng.choice([0.02, 0.6]), 50) for k in range(60)} | {60: np.ones(50)}
    env = spark.createDataFrame(pd.concat([pd.DataFrame({"recording_id": "a", "cycle_index": k, "i": np.arange(50) + 50 * k, "e": v}) for k, v in cycle.items()]))
    templates = spark.createDataFrame([(j, k, float(v)) for j, s in enumerate(shapes) for k, v in enumerate(s)], "template int, k int, ref double")
    z = lambda x: np.zeros_like(x) if x.std() == 0 else (x - x.mean()) / x.std()
    pairs = {(c, j): (float(z(x) @ z(s)) / 50, plain_warped(z(x), z(s))) for c, x in cycle.items() for j, s in enumerate(shapes) if x.std() > 0 and s.std() > 0}
    want = {p: v for p, v in pairs.items() if v[0] >= 0.3 and v[1] <= 0.4}
    got = {(r.cycle_index, r.template): (r.r, r.dtw) for r in cycles.template_match(env, templates, CK, "e", 50, 0.3, 0.4, block=block).collect()}
    assert set(got) == set(want) and len(want) > 10
    for p, v in want.items():
        np.testing.assert_allclose(got[p], v, atol=1e-9)
    work = cycles.template_match(env, templates, CK, "e", 50, 0.3, 0.4, work=True, block=block).collect()
    assert len(work) == 61 and all(r.n_templates == 10 for r in work)
    assert sum(r.n_correlated for r in work) == sum(v[0] >= 0.3 for v in pairs.values())
    assert len(want) <= sum(r.n_warped for r in work) < 0.8 * sum(r.n_correlated for r in work)
    every = cycles.template_match(env, templates, CK, "e", 50, 0.3, block=block).collect()
    assert len(every) == 610 and all((r.r is None) == ((r.cycle_index, r.template) not in pairs) for r in every)
    best = {r.cycle_index: r.template for r in cycles.best_template(spark.createDataFrame([("a", *p, *v) for p, v in want.items()], "recording_id string, cycle_index int, template int, r double, dtw double"), CK).collect()}
    assert best == {c: min((v[1], j) for (d, j), v in want.items() if d == c)[1] for c, _ in want}


def test_welch_finds_the_sine_and_keeps_its_power():
    fs, t = 1000.0, np.arange(8000) / 1000.0
    x = 2 * np.sin(2 * np.pi * 125 * t)
    f, p = kn.welch(x, fs, 1000)
    assert f[np.argmax(p)] == 125
    np.testing.assert_allclose(p.sum() * f[1], 2.0, rtol=1e-3)


def test_band_pass_keeps_the_band():
    fs, t = 2000.0, np.arange(8000) / 2000.0
    x = np.sin(2 * np.pi * 100 * t) + np.sin(2 * np.pi * 2 * t)
    y = np.convolve(x, kn.analytic_taps(fs, 10, 500, 4, 0.5), mode="same")
    np.testing.assert_allclose(np.abs(y[2000:6000]), 1.0, atol=4e-3)
    y = y.real
    np.testing.assert_allclose(y[2000:6000], np.sin(2 * np.pi * 100 * t)[2000:6000], atol=2e-3)


def _stomped(fs=2000.0, at=((4.0, 1.0), (5.0, 3.0))):
    rng = np.random.default_rng(9)
    n = int(12 * fs)
    t = np.arange(n) / fs
    x = rng.normal(0, 0.01, n)
    for when, size in at:
        k = (t >= when) & (t < when + 0.15)
        x[k] += size * np.sin(2 * np.pi * 300 * t[k])
    return t, x


def test_stomp_detectors_agree(spark):
    t, x = _stomped()
    got = stomp.detect(series(spark, {"t": t, **{c: x for c in CH}}), K, 2000.0).first()
    assert abs(got.rms_time - 5.07) < 0.06 and abs(got.onset_time - 5.0) < 0.2 and abs(got.freq_time - 5.05) < 0.3
    assert got.consensus_methods == "rms,onset,freq" and got.agreement_span < 0.5


@pytest.mark.parametrize("knee, method", [("left", "biomechanics"), ("right", "consensus")])
def test_guided_refinement(spark, knee, method):
    t, x = _stomped()
    s = series(spark, {"t": t, **{c: x for c in CH}})
    goal = spark.createDataFrame([("a", knee, 13.0, 12.0)], "recording_id string, recorded_knee string, left_stomp double, right_stomp double")
    got = stomp.refine(s, stomp.detect(s, K, 2000.0), goal, K, 2000.0).first()
    assert got.selected_method == method
    if method == "biomechanics":
        assert abs(got.bio_selected_time - 5.07) < 0.1 and abs(got.contra_bio_selected_time - 4.07) < 0.1 and got.energy_ratio > 2


def test_walk_passes_of_regular_steps(spark):
    fs = 200.0
    t = np.arange(int(40 * fs)) / fs
    x = np.zeros(len(t))
    for start in (2.0, 20.0):
        for k in range(16):
            x += np.exp(-((t - start - 0.6 * k) ** 2) / (2 * 0.02**2))
    got = audioqc.walk_qc(series(spark, {"t": t, **{c: x for c in CH}}), K).orderBy("start").collect()
    assert len(got) == 2 and all(r.passed and r.heel_strike_count == 16 for r in got)
    assert all(abs(r.gait_cycle_hz - 1 / 0.6) < 0.01 and r.coverage_frac > 0.99 for r in got)


def test_periodic_exercise(spark):
    fs = 100.0
    t = np.arange(int(60 * fs)) / fs
    x = 0.3 * np.maximum(np.sin(2 * np.pi * 0.25 * t), 0) ** 4
    good = audioqc.periodic_qc(series(spark, {"t": t, **{c: x for c in CH}}), K, "flexion_extension", 0.25, 4.0).first()
    assert good.passed and good.coverage_frac > 0.8
    bad = audioqc.periodic_qc(series(spark, {"t": t, **{c: 0.01 * x for c in CH}}), K, "flexion_extension", 0.25, 4.0).first()
    assert not bad.passed and bad.coverage_frac == 0.0


def test_whole_job_and_restart(spark, tmp_path):
    """Two recordings; one has its pass outside the audio, so its participant is not committed."""
    fs, rng = 500.0, np.random.default_rng(11)
    n = int(14 * fs)
    t = np.arange(n) / fs
    audio, motion = [], []
    for key in ("ok", "lost"):
        x = 1.5 + rng.normal(0, 0.05, n)
        x[int(2 * fs) : int(2.1 * fs)] += 4.0
        audio.append(pd.DataFrame({"recording_id": key, "i": np.arange(n), "t": t, **{c: x for c in CH}}))
        mt = np.arange(1400) / 100.0
        motion.append(pd.DataFrame({"recording_id": key, "i": np.arange(1400), "t": mt + 10, "knee_angle": 40 - 30 * np.cos(2 * np.pi * mt)}))
    recs = spark.createDataFrame(
        [("ok", 1, "left", "walk", 12.0, 13.0, 14.0, 22.0), ("lost", 2, "left", "walk", 12.0, 13.0, 200.0, 210.0)],
        "recording_id string, participant int, knee string, maneuver string, left_stomp double, right_stomp double, pass_start double, pass_end double",
    )
    store = pipeline.StageStore(spark, str(tmp_path))
    settings = pipeline.Settings(fs=fs, energy_threshold=0.1)
    out = pipeline.run(store, settings, recs, spark.createDataFrame(pd.concat(audio)), spark.createDataFrame(pd.concat(motion)))
    rows = out.orderBy("cycle_index").collect()
    assert {r.recording_id for r in rows} == {"ok"} and len(rows) >= 6
    assert {r.status for r in store.read("sync_status").collect()} == {"ok", "window_outside_audio"}
    assert all(abs(r.duration - 1.0) < 0.02 for r in rows)
    again = pipeline.run(store, settings, recs, start="cycles")
    assert again.count() == len(rows)
