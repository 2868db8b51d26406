"""No rows are lost: null key parts, missing features, odd maneuver names, partial runs."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from kymora.operators import audioqc as aq
from kymora.operators import detectors as dt
from kymora.operators import intervals as iv
from kymora.operators import models as md
from kymora.operators import windows as wd
from kymora.plans import pipeline
from kymora.plans.blocks import index_blocks, running, with_sample_index
from kymora.plans.grouped import grouped_map
from kymora.plans.quantiles import quantiles
from kymora.sources import sheets
from tests.conftest import series

KEYS = ["k", "pass_number"]


def intervals(spark):
    rows = [("a", None, 0.0, 2.0), ("a", None, 1.0, 3.0), ("a", 1, 0.0, 1.0), ("a", 1, 5.0, 6.0), (None, 2, 0.0, 1.0), (None, 2, 0.5, 4.0)]
    return spark.createDataFrame(rows, "k string, pass_number int, start double, end double")


def test_merge_keeps_groups_with_null_key_parts(spark):
    got = {tuple(r) for r in iv.merge_intervals(intervals(spark), KEYS, 0.0).select(*KEYS, "start", "end").collect()}
    assert got == {("a", None, 0.0, 3.0), ("a", 1, 0.0, 1.0), ("a", 1, 5.0, 6.0), (None, 2, 0.0, 4.0)}


def test_prefixes_numbers_statistics_and_quantiles_keep_them_too(spark):
    rows = [(k, p, i, float(i)) for k, p in (("a", None), (None, 1), ("b", 2)) for i in range(10)]
    df = spark.createDataFrame(rows, "k string, pass_number int, i long, x double")
    sums = running(index_blocks(df, rows=3), KEYS, ["i"], {"s": ("sum", F.col("x"))})
    assert sums.count() == 30 and {r.s for r in sums.filter("i = 9").collect()} == {45.0}
    numbered = with_sample_index(df.drop("i"), KEYS, ["x"])
    assert numbered.filter("i = x").count() == 30
    assert wd.zscore(df, KEYS, "x", "z").count() == 30
    q = quantiles(df, KEYS, "x", {"m": 0.5}).collect()
    assert {(r.k, r.pass_number, r.m) for r in q} == {("a", None, 4.5), (None, 1, 4.5), ("b", 2, 4.5)}
    assert quantiles(df, [], "x", {"m": 0.5}).collect()[0].m == 4.5


def test_groups_of_a_helper_are_not_cut_at_null_key_parts(spark):
    df = spark.createDataFrame([(k, p, i, 1.0) for k, p in (("a", None), (None, 1), ("b", 2)) for i in range(5)], "k string, pass_number int, i long, x double")
    sizes = grouped_map(df, KEYS, ["i"], ["x"], "n long", lambda g: {"n": np.array([len(g["x"])])})
    assert {(r.k, None if r.pass_number is None else int(r.pass_number), r.n) for r in sizes.collect()} == {("a", None, 5), (None, 1, 5), ("b", 2, 5)}


def test_a_group_over_many_batches_is_whole(spark):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        df = spark.createDataFrame([(k, i) for k, n in (("a", 3), ("b", 50), ("c", 1), ("d", 22)) for i in range(n)], "k string, i long")
        got = grouped_map(df, ["k"], ["i"], ["i"], "n long, ordered boolean", lambda g: {"n": np.array([len(g["i"])]), "ordered": np.array([bool((np.diff(g["i"]) == 1).all())])})
        assert {tuple(r) for r in got.collect()} == {("a", 3, True), ("b", 50, True), ("c", 1, True), ("d", 22, True)}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


@pytest.mark.parametrize("window", [9, 129])
def test_a_large_offset_does_not_spoil_the_deviation(spark, window):
    x = np.where(np.arange(600) % 2 == 0, 1e8 - 0.5, 1e8 + 0.5)
    got = wd.sliding_stats(series(spark, {"t": np.arange(600) / 100.0, "ch1": x}), ["recording_id"], ["ch1"], window).filter("i = 300").first()
    part = x[300 - window // 2 : 301 + window // 2]
    assert got.ch1_std == pytest.approx(part.std(), rel=1e-6) and got.ch1_rms == pytest.approx(math.sqrt((part**2).mean()))


def test_a_sample_on_the_limit_is_no_spike(spark):
    # 0, 0, 0, 0, 1: mean 0.2, deviation 0.4, so the last one lies exactly two deviations above
    x = np.tile([0.0, 0.0, 1.0, 0.0, 0.0], 20)
    s = series(spark, {"t": np.arange(100) / 100.0, "ch1": x})
    at = lambda sigma: dt.detect_spikes(s, 100.0, ["ch1"], sigma=sigma, min_s=0.0).count()
    assert at(2.0) == 0 and at(1.999) > 0


def test_models_count_the_rows_they_use(spark):
    rng = np.random.default_rng(0)
    rows = [(i, float(i % 2), None if i % 4 == 0 else float(rng.normal() + i % 2), float("nan") if i == 1 else float(rng.normal())) for i in range(40)]
    df = spark.createDataFrame(rows, "study_id int, label double, a double, b double")
    folds = md.cross_validate(df, ["a", "b"], 3, ["study_id"], spark).collect()
    assert sum(r.n_test for r in folds) == 29 and all(r.n_train + r.n_test == 29 for r in folds)
    out = md.train_test(df, ["a", "b"], ["study_id"])
    assert out["missing_features"] == 11 and out["scored"].count() + out["training_samples"] == 29


def test_a_strike_on_a_common_edge_counts_in_both_passes(spark):
    strikes = spark.createDataFrame([(None, float(i)) for i in range(10)], "k string, t double")
    passes = spark.createDataFrame([(None, 0.0, 5.0), (None, 5.0, 9.0), (None, 2.0, 8.0)], "k string, start double, end double")
    got = aq.strikes_in_passes(strikes, passes, ["k"]).groupBy("start").agg(F.count(F.lit(1)).alias("n")).collect()
    assert {r.start: r.n for r in got} == {0.0: 6, 5.0: 5, 2.0: 7}


def test_unknown_maneuvers_fail_instead_of_vanishing(spark):
    fs = 100.0
    t = np.arange(1200) / fs
    sig = pd.concat([pd.DataFrame({"recording_id": k, "i": np.arange(len(t)), "t": t, **{f"ch{c}": np.sin(2 * np.pi * 0.25 * t) for c in range(1, 5)}}) for k in ("x", "y", "z")])
    kinds = spark.createDataFrame([("x", "sts"), ("y", "hopping"), ("z", "Flexion-Extension")], "recording_id string, maneuver string")
    got = {r.recording_id: (r.maneuver, r.passed) for r in aq.batch_qc(spark.createDataFrame(sig), kinds, ["recording_id"]).collect()}
    assert set(got) == {"x", "y", "z"} and got["x"][0] == "sit_to_stand" and got["z"][0] == "flexion_extension" and got["y"] == (None, False)


def test_legend_rows_with_an_unknown_label_are_reported(spark):
    cells = [("f", 0, 0, "L Knee")]
    for k in range(12):
        label = {0: "Walk", 4: "Hop", 8: "Sit-to-Stand"}.get(k)
        cells += [("f", 2 + k, 0, f"file{k // 4}"), ("f", 2 + k, 2, str(k % 4 + 1))] + ([("f", 2 + k, 1, label)] if label else [])
    df = spark.createDataFrame(cells, "uid string, row int, col int, value string")
    known, odd = sheets.legend(df, ["uid"]), sheets.legend_problems(df, ["uid"])
    assert known.count() == 8 and {r.maneuver_label for r in odd.collect()} == {"Hop"} and odd.count() == 4


def test_a_run_over_some_recordings_leaves_the_others(spark, tmp_path):
    store = pipeline.StageStore(spark, str(tmp_path))
    both = spark.createDataFrame([("a", 1), ("b", 1), (None, 1)], "recording_id string, x int")
    store.write("signal", both)
    store.write("facts", spark.createDataFrame([(1,)], "n int"))
    store.publish()
    part = pipeline.StageStore(spark, str(tmp_path), ("a",))
    assert part.read("signal").count() == 1
    part.write("signal", spark.createDataFrame([("a", 2, 5)], "recording_id string, x int, y int"))
    assert {tuple(r)[:2] for r in store.read("signal").collect()} == {("a", 1), ("b", 1), (None, 1)}  # not published yet
    part.publish()
    assert {tuple(r)[:2] for r in store.read("signal").collect()} == {("a", 2), ("b", 1), (None, 1)}
    assert store.read("facts").count() == 1
    gone = pipeline.StageStore(spark, str(tmp_path), ("b",))
    gone.write("signal", both.filter("false"))
    gone.publish()
    assert {r.recording_id for r in store.read("signal").collect()} == {"a", None}


def test_a_saved_run_switches_off_what_it_did_not_see(spark, tmp_path):
    from kymora.plans import persist

    store = pipeline.StageStore(spark, str(tmp_path))
    recs = [("r1", 1, "f1", "left", "walk", 1, "slow"), ("r2", 1, "f2", "left", "sts", None, None), ("r3", 2, "f3", "left", "walk", 1, "slow")]
    shape = "recording_id string, study_id long, audio_file_name string, knee string, maneuver string, pass_number int, speed string"

    def run(rows, outlier):
        store.write("artifact_interval", spark.createDataFrame([(rows[0][0], "spike", "ch1", 0.0, 1.0)], "recording_id string, kind string, channel string, start double, end double"))
        store.write("sync_status", spark.createDataFrame([(r[0], True) for r in rows], "recording_id string, ok boolean"))
        store.write("sync_record", spark.createDataFrame([(r[0], 1.0, 2.0) for r in rows], "recording_id string, audio_stomp double, motion_stomp double"))
        store.write("cycle", spark.createDataFrame([(r[0], k, outlier, True) for r in rows for k in range(2)], "recording_id string, cycle_index int, is_outlier boolean, audio_qc_pass boolean"))
        persist.save_run(store, spark.createDataFrame(rows, shape))

    run(recs, False)
    first = store.read("meta_cycle")
    assert first.count() == 6 and first.filter("is_active").count() == 6 and store.read("meta_audio").filter("qc_fail").count() == 1
    ids = {(r.study_id, r.maneuver, r.cycle_index): r.id for r in first.collect()}
    run([recs[0], ("r2", 1, "f9", "left", "sts", None, None)], True)
    audio = {r.audio_file_name: r.is_active for r in store.read("meta_audio").collect()}
    assert audio == {"f1": True, "f2": False, "f3": True, "f9": True}  # f3 is out of scope, f2 was not seen
    cycles = store.read("meta_cycle").collect()
    assert {(r.study_id, r.maneuver, r.cycle_index): r.id for r in cycles} == ids
    assert {r.study_id for r in cycles if r.is_outlier} == {1}
    persist.report(store, spark.createDataFrame([(1, 501)], "id long, study_participant_id long"), str(tmp_path / "report"))
    sheet = lambda n: spark.read.parquet(str(tmp_path / "report" / n))
    assert {r.participant_id for r in sheet("audio").collect()} == {501, 2}
    assert {r.id for r in sheet("sync").collect()} == {r.id for r in store.read("meta_sync").collect()} and sheet("cycles").count() == 6 and sheet("motion").isEmpty()
    assert {(r.participant_id, r.maneuver): r.value for r in sheet("summary").collect() if r.metric == "Movement Cycles"} == {(501, "walk"): 2, (501, "sts"): 2, (2, "walk"): 2}
