"""Steps that many queries share: one shuffle of samples, and the same rows as a plain walk over them."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from kymora.operators import detectors, peaks, windows
from kymora.plans.blocks import local_runs, true_runs
from tests.conftest import series

K = ["recording_id"]


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def odd(spark):
    """Two recordings, one without a name, with plateaus, nulls and NaN."""
    rng = np.random.default_rng(3)
    rows = [(k, int(i), i / 100, None if i % 37 == 5 else float("nan") if i % 53 == 7 else float(rng.integers(0, 4))) for k in ("a", None) for i in range(200)]
    return spark.createDataFrame(rows, "recording_id string, i long, t double, x double").cache()


def test_narrow_windows_are_sums_of_their_samples(odd):
    got = windows.sliding_stats(odd, K, ["x"], 9, rows=64)
    assert "Window" not in plan_of(got)  # a row frame is built anew for each row and statistic
    rows = got.orderBy("recording_id", "i").collect()
    assert len(rows) == 400
    for name in ("a", None):
        mine = [r for r in rows if r.recording_id == name]
        x = np.array([0.0 if r.x is None or r.x != r.x else r.x for r in mine])
        for k, r in enumerate(mine):
            part = x[max(0, k - 4) : k + 5]
            np.testing.assert_allclose([r.x_rms, r.x_var, r.x_mean, r.x_std], [np.sqrt(np.mean(part**2)), part.var(), part.mean(), part.std()], atol=1e-12)


def walked(x: list) -> set:
    """Extrema by a walk over plateaus; a null is like an end to its neighbours."""
    order = lambda v: np.inf if v != v else v
    out, n = set(), len(x)
    for k in range(n):
        p, q = x[k - 1] if k else None, x[k + 1] if k + 1 < n else None
        if p is None or q is None:
            out.add((k, "only" if p is None and q is None else "first" if p is None else "last"))
    k = 0
    while k < n:
        e = k
        while e + 1 < n and x[k] is not None and x[e + 1] is not None and order(x[e + 1]) == order(x[k]):
            e += 1
        p, q = x[k - 1] if k else None, x[e + 1] if e + 1 < n else None
        if x[k] is not None and p is not None and q is not None:
            v, p, q = order(x[k]), order(p), order(q)
            if p < v > q:
                out.add(((k + e) // 2, "max"))
            if p > v < q:
                out.add(((k + e) // 2, "min"))
        k = e + 1
    return out


@pytest.mark.parametrize("rows", [4, 16, 16384])
def test_extrema_of_blocks_are_those_of_the_series(odd, rows):
    got = peaks.local_extrema(odd, K, "x", rows=rows)
    assert plan_of(got).count("Exchange") == 0 or rows < 16384  # judged in the block: no window, no join of the samples
    got = got.collect()
    for name in ("a", None):
        x = [r.x for r in odd.filter(F.col("recording_id").eqNullSafe(F.lit(name))).orderBy("i").collect()]
        mine = [(r.i, r.kind) for r in got if r.recording_id == name]
        assert len(mine) == len(set(mine)) and set(mine) == walked(x)


def test_a_plateau_over_many_blocks_has_one_top(spark):
    s = series(spark, {"x": [0.0, *[1.0] * 40, 0.0, 2.0]})
    got = {(r.i, r.kind) for r in peaks.local_extrema(s, K, "x", rows=8).collect()}
    assert got == {(0, "first"), (20, "max"), (41, "min"), (42, "last")}


def test_runs_leave_their_block_as_runs(spark):
    n = 1000
    x = np.where(np.arange(n) % 250 < 120, 0.0, np.where(np.arange(n) % 2 == 0, 2.0, 3.0))
    s = series(spark, {"t": np.arange(n) / 100, "x": x}).withColumn("bad", F.col("x") == 0)
    parts = local_runs(s.coalesce(1).sortWithinPartitions("recording_id", "i"), K, {"bad": "x"}, "channel")
    assert parts.count() == 4  # not one row a sample
    want = {(250 * k, 250 * k + 119) for k in range(4)}
    for rows in (16, 100, 16384):
        shuffled = true_runs(s.orderBy(F.rand(1)), K, F.col("bad"), rows=rows)
        assert {(r.first_i, r.last_i) for r in shuffled.collect()} == want
    found = detectors.detect_dropout(s, 100.0, ["x"], silence=0.5, flatline=-1.0, window_s=0.1, min_s=0.0)
    assert found.count() == 4 and {r.channel for r in found.collect()} == {"x"}


def test_stats_of_two_columns_do_not_shuffle_the_samples(spark):
    s = series(spark, {"x": np.arange(50.0), "y": np.arange(50.0)}).unionByName(series(spark, {"x": np.ones(3), "y": np.ones(3)}, key="b"))
    got = windows.minmax_band(windows.zscore(s, K, "x", "z"), K, "y", "band")
    assert "SortMergeJoin" not in plan_of(got)
    rows = got.toPandas()
    assert len(rows) == 53 and pd.isna(rows).sum().sum() == 0


def test_whole_cycle_spectra_are_means_over_all_blocks(spark):
    from kymora.functions import kernels as kn
    from kymora.operators import cycles

    rng = np.random.default_rng(2)
    sizes = {0: 300, 1: 40000, 2: 255}  # one block, several, too short
    data = {k: {c: rng.normal(0, 1, n) + (3 * np.sin(np.arange(n) * 0.8) if c == "ch2" else 0) for c in ("ch1", "ch2")} for k, n in sizes.items()}
    pdf = pd.concat([pd.DataFrame({"recording_id": "a", "cycle_index": k, "i": np.arange(len(x["ch1"])) + 7, "t": 0.0, **x}) for k, x in data.items()])
    pdf.loc[(pdf.cycle_index == 0) & (pdf.i == 290), "ch2"] = None  # the second frame of two is unknown
    data[0]["ch2"] = data[0]["ch2"][:200]
    got = cycles.periodic_noise(spark.createDataFrame(pdf), ["recording_id", "cycle_index"], 100.0, ["ch1", "ch2"], 0.2).collect()
    assert {(r.cycle_index, r.channel): r.periodic for r in got} == {
        (k, c): bool(kn.peak_to_median(*kn.welch(data[k][c], 100.0, 200), 5.0)[0] > 5) for k in (0, 1) for c in ("ch1", "ch2")}


def test_tolerances_may_be_tried_one_by_one(spark, monkeypatch):
    from kymora.operators import segments

    rng = np.random.default_rng(4)
    parts = [pd.DataFrame({"recording_id": k, "i": np.arange(n), "t": np.cumsum(s * (1 + rng.normal(0, 0.02, n)))}) for k, n, s in (("a", 60, 1.0), ("b", 40, np.repeat([1.0, 2.0], 20)), ("c", 30, 0.5))]
    events = spark.createDataFrame(pd.concat(parts))
    at_once = []
    plain = segments.steady_spans
    monkeypatch.setattr(segments, "steady_spans", lambda steps, *a: at_once.append(steps.select("tolerance").distinct().count()) or plain(steps, *a))
    together = {tuple(r) for r in segments.rate_segments(events, K, 3).collect()}
    monkeypatch.setattr(segments, "LADDER_ROWS", 1)
    at_once.clear()
    assert {tuple(r) for r in segments.rate_segments(events, K, 3).collect()} == together and together
    assert set(at_once) == {1}
