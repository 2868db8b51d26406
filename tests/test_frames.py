"""Stored frames: bounded files whatever the recordings' sizes, pruned reads, and exact quantiles either way."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from kymora.plans import quantiles as qt
from kymora.sources import frames
from tests.conftest import series

K = ["recording_id"]


def signal(spark, sizes):
    return spark.createDataFrame(pd.concat([pd.DataFrame({"recording_id": pd.Series([k] * n, dtype="Int64"), "i": np.arange(n), "x": np.arange(n) * 0.5}) for k, n in sizes.items()]))


def test_files_are_of_bounded_size_and_number(spark, tmp_path):
    sizes = {0: 4000, **{k: 3 for k in range(1, 600)}}  # one recording holds most rows
    df = signal(spark, sizes).unionByName(spark.createDataFrame([(None, 0, 1.0), (None, 1, None)], "recording_id long, i long, x double"))
    manifest = frames.write_frames(df, str(tmp_path / "f"), rows_per_file=500).collect()
    assert sum(r.n_rows for r in manifest) == df.count() and len(manifest) <= 13 and max(r.n_rows for r in manifest) <= 1500
    back = frames.read_frames(spark, str(tmp_path / "f"))
    assert back.columns == df.columns and sorted(map(repr, back.collect())) == sorted(map(repr, df.collect()))


def test_a_read_of_some_recordings_opens_their_files_only(spark, tmp_path):
    df = signal(spark, {k: 20 for k in range(400)})
    path = str(tmp_path / "f")
    n_files = frames.write_frames(df, path, rows_per_file=400).count()
    got = frames.read_frames(spark, path, [7, 300])
    files = {r[0] for r in got.select(F.input_file_name()).distinct().collect()}
    assert len(files) <= 4 < n_files and len(got.inputFiles()) <= 4
    assert got.groupBy("recording_id").count().orderBy("recording_id").collect() == [(7, 20), (300, 20)]
    assert frames.read_frames(spark, path, [9999]).count() == 0 == frames.read_frames(spark, path, []).count()


def test_keys_of_several_parts_with_nulls(spark, tmp_path):
    rows = [(s, p, i) for s in range(30) for p in (None, "slow") for i in range(4)]
    df = spark.createDataFrame(rows, "study_id long, speed string, n int")
    frames.write_frames(df, str(tmp_path / "f"), ["study_id", "speed"], ["n"], rows_per_file=20)
    got = frames.read_frames(spark, str(tmp_path / "f"), [(3, None), (9, "slow")])
    assert {tuple(r) for r in got.collect()} == {(3, None, i) for i in range(4)} | {(9, "slow", i) for i in range(4)}


def test_stored_spectrogram(spark, tmp_path):
    rng = np.random.default_rng(1)
    df = series(spark, {"t": np.arange(400) / 100, "ch1": rng.normal(size=400), "ch2": rng.normal(size=400)}, key="a")
    frames.write_spectrograms(df, str(tmp_path / "s"), ["ch1", "ch2"], K, 100.0, 64, 48, rows_per_file=10)
    got = frames.read_frames(spark, str(tmp_path / "s"), ["a"])
    assert got.groupBy("channel").count().collect() and got.count() == 2 * 22 and len(got.first().db) == 33
    assert dict(got.dtypes)["db"] == "array<float>"


@pytest.mark.parametrize("small", [0, 40, 10_000])
def test_quantiles_of_several_columns(spark, small):
    rng = np.random.default_rng(2)
    data = {"a": rng.normal(size=300), "b": rng.integers(0, 5, 41).astype(float), None: rng.normal(size=17), "void": np.full(3, np.nan)}
    pdf = pd.concat([pd.DataFrame({"recording_id": k, "x": v, "y": np.where(np.arange(len(v)) % 3 == 0, np.nan, v * 2)}) for k, v in data.items()])
    df = spark.createDataFrame(pdf)
    got = qt.quantiles_of(df, K, {"x": {"x_05": 0.05, "x_50": 0.5}, "y": {"y_33": 0.33, "y_100": 1.0}}, small=small).toPandas()
    assert len(got) == 4
    for k, v in data.items():
        row = got[got.recording_id.isna()].iloc[0] if k is None else got[got.recording_id == k].iloc[0]
        y = np.where(np.arange(len(v)) % 3 == 0, np.nan, v * 2)
        if k == "void":
            assert row[["x_05", "x_50", "y_33", "y_100"]].isna().all()
            continue
        np.testing.assert_allclose([row.x_05, row.x_50, row.y_33, row.y_100], [np.quantile(v, 0.05), np.median(v), np.nanquantile(y, 0.33), np.nanmax(y)])
    one = qt.quantiles(df, K, "x", {"m": 0.5}).collect()
    assert {r.recording_id for r in one} == {"a", "b", None}
    assert qt.quantiles(df, [], "x", {"m": 0.5}).count() == 1


def test_a_read_of_many_recordings(spark, tmp_path):
    """Two thousand keys, as a list and as a table with repeats and nulls, from more files than tasks."""
    df = spark.range(9000).select(F.when(F.col("id") % 3000 != 5, F.col("id") % 3000).alias("recording_id"), F.col("id").alias("i"))
    path = str(tmp_path / "f")
    manifest = frames.write_frames(df, path, rows_per_file=5).collect()
    assert len(manifest) >= 1800 and max(r.n_rows for r in manifest) <= 5 and sum(r.n_rows for r in manifest) == 9000
    wanted = df.filter("recording_id < 2000 OR recording_id IS NULL").select("recording_id")
    want = sorted(map(repr, df.filter("recording_id < 2000 OR recording_id IS NULL").collect()))
    assert len(want) == 6000
    assert sorted(map(repr, frames.read_frames(spark, path, wanted).collect())) == want
    assert sorted(map(repr, frames.read_frames(spark, path, [None, *(k for k in range(2000) if k != 5)]).collect())) == want
