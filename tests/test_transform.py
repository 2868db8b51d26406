"""Transforms over two shuffles against those of a whole array."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from kymora.functions import kernels as kn
from kymora.operators import features
from kymora.plans import transform

K = ["recording_id"]


def lay(spark, data):
    return spark.createDataFrame(pd.concat([pd.DataFrame({"recording_id": k, "n": len(v), "i": np.arange(len(v)), "x": v}) for k, v in data.items()]))


@pytest.mark.parametrize("n", [1, 2, 12, 64, 97, 4096, 65536, 65537, 1 << 20])
def test_factors(n):
    got = transform.factors(n, 1024)
    assert got is None if n in (65537,) else got[0] * got[1] == n and max(got) <= 1024
    assert transform.chirp_length(n) >= 2 * n - 1


@pytest.mark.parametrize("most", [8, 40])
def test_series_of_any_length(spark, most):
    rng = np.random.default_rng(1)
    data = {f"k{n}": rng.normal(size=n) for n in (1, 2, 9, 30, 37, 61, 64, 60)} | {None: rng.normal(size=36)}
    most = max(most, 16)
    got = {}
    for r in transform.spectrum(lay(spark, data), K, most).collect():
        got.setdefault(r.recording_id, {})[r.i] = complex(r.re, r.im)
    assert set(got) == set(data)
    for key, x in data.items():
        want = np.fft.rfft(x)
        assert sorted(got[key]) == list(range(len(want)))
        np.testing.assert_allclose([got[key][f] for f in range(len(want))], want, atol=1e-9)


@pytest.mark.parametrize("n", [1 << 20, 70_001])
def test_a_cycle_that_fits_no_row(spark, monkeypatch, n):
    """A million samples by two shuffles, and a prime length by the chirp rule; no group has more than its bound."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=n) + np.sin(np.arange(n) / 9)
    seen = []
    inner = transform.grouped_map

    def watch(df, group, *rest):
        seen.append(df.groupBy(*group).count().agg(F.max("count")).first()[0] or 0)
        return inner(df, group, *rest)

    monkeypatch.setattr(transform, "grouped_map", watch)
    bins = transform.spectrum(lay(spark, {"a": x}), K, 1 << 12)
    m = bins.withColumn("m", F.sqrt(F.col("re") ** 2 + F.col("im") ** 2)).agg(F.sum(F.col("i") * F.col("m")) / F.sum("m"), F.stddev_pop("m"), F.sum(F.col("m") ** 2)).first()
    np.testing.assert_allclose(tuple(m), kn.spectral_features(x), rtol=1e-9)
    assert max(seen) <= 1 << 12


def test_features_do_not_depend_on_the_way(spark):
    rng = np.random.default_rng(3)
    parts = [pd.DataFrame({"recording_id": k, "i": np.arange(n) + 7, **{f"ch{c}": rng.normal(size=n) for c in range(1, 5)}}) for k, n in (("a", 50), ("b", 53), (None, 120))]
    df = spark.createDataFrame(pd.concat(parts))
    a, b = (features.spectral_table(df, K, whole=w).toPandas().sort_values("recording_id").reset_index(drop=True) for w in (1000, 16))
    pd.testing.assert_frame_equal(a[sorted(a)], b[sorted(b)], rtol=1e-9)
