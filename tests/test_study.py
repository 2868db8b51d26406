"""Ingest, sheets, catalogue, metadata tables, clinical sheets and models on small fixtures."""

import json
from datetime import datetime

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from kymora.functions import scalars as sc
from kymora.operators import clinical as cl
from kymora.operators import models as md
from kymora.operators import tables as tb
from kymora.operators import validate as vd
from kymora.sources import catalog as ct
from kymora.sources import dump as dp
from kymora.sources import sheets as sh
from kymora.sources import sinks


def write_dump(path, packets=3, pad=2, seed=1):
    rng = np.random.default_rng(seed)
    header = bytearray(512)
    header[0:4] = (1234).to_bytes(4, "little")
    header[24:28] = (2).to_bytes(4, "little")
    header[61:65] = (77).to_bytes(4, "little")
    ticks = int((datetime(2024, 3, 12, 12, 40, 51) - datetime(1601, 1, 1)).total_seconds() * 10_000_000)
    header[65:73] = ticks.to_bytes(8, "big")
    data = rng.integers(0, 2**32, (packets, dp.DATA_WORDS + dp.TIME_WORDS), dtype=np.uint32)
    start = np.uint32(2**32 - 200)
    data[:, dp.DATA_WORDS :] = (start + np.arange(packets * dp.TIME_WORDS, dtype=np.uint32)).reshape(packets, -1)
    sync = np.zeros(128, dtype="<u4")
    sync[:4] = [1000, 2000, 3000, 4000]
    with open(path, "wb") as f:
        f.write(bytes(header) + data.astype("<u4").tobytes() + sync.tobytes() + bytes(512 * pad))
    return data


def test_dump_ingest(spark, tmp_path):
    data = write_dump(tmp_path / "HP_W11.2-1-20240312_124051.bin")
    words = dp.read_words(spark, str(tmp_path), packetsPerSplit="2")
    assert words.rdd.getNumPartitions() == 2 and words.count() == data.size
    s = dp.read_signal(spark, str(tmp_path)).orderBy("i").toPandas()
    raw = data[:, : dp.DATA_WORDS].reshape(-1)
    volt = lambda u: u.astype("uint16").astype("int16").astype(float) * 9 * np.sqrt(2) / 65536 + 1.5
    for name, want in (("ch1", raw[0::2] >> 16), ("ch2", raw[0::2] & 65535), ("ch3", raw[1::2] >> 16), ("ch4", raw[1::2] & 65535)):
        np.testing.assert_allclose(s[name], volt(want))
    np.testing.assert_allclose(s["t"], np.arange(len(s)) / 46875 + 3000 / 4096 - 2752 / 46875 - 1000 / 4096)
    h = dp.read_headers(spark, str(tmp_path)).first()
    assert h.device_serial[0] == 1234 and h.firmware_version == 2 and h.sd_blocks == 77
    assert dp.read_headers(spark, str(tmp_path)).select(F.col("file_time").cast("string")).first()[0] == "2024-03-12 12:40:51"
    blocks = dp.time_blocks(words).orderBy("i").toPandas()
    assert (np.diff(blocks["unwrapped"])[blocks["i"].diff()[1:] == 1] == 1).all()


def test_24_bit_codes(spark):
    df = spark.createDataFrame([(0,), (2**23 - 1,), (2**23,), (2**24 - 1,)], "c long")
    got = [r[0] for r in df.select(dp.volts(F.col("c"), 24)).collect()]
    np.testing.assert_allclose(got, np.array([0, 2**23 - 1, -(2**23), -1]) * 9 * np.sqrt(2) / 2**24 + 1.5)


def test_catalogue_and_sidecars(spark, tmp_path):
    for p in ("#AOA1011/Left Knee/Walking/HP_W11.2-1-20240312_124051.bin", "1012/right_knee/sit-to-stand/x.bin"):
        (tmp_path / p).parent.mkdir(parents=True)
        (tmp_path / p).write_bytes(b"x")
    got = {r.participant: r for r in ct.recordings(ct.list_files(spark, str(tmp_path), "*.bin")).collect()}
    assert (got[1011].knee, got[1011].maneuver, got[1011].device_serial) == ("left", "walk", "1")
    assert (got[1012].knee, got[1012].maneuver, got[1012].recorded_at) == ("right", "sit_to_stand", None)
    side = tmp_path / "meta"
    side.mkdir()
    (side / "a.json").write_text(json.dumps({"fs": 1000.0, "devFirmwareVersion": 2}))
    (side / "b.json").write_text("{broken")
    s = ct.read_sidecars(spark, str(side)).withColumn("name", F.regexp_extract("path", r"(\w)\.json$", 1))
    recs = spark.createDataFrame([("a",), ("b",), ("c",)], "name string")
    assert {r.name: r.fs for r in ct.with_sidecar(recs, s, ["name"]).collect()} == {"a": 1000.0, "b": 46875.0, "c": 46875.0}


def _legend_cells():
    rows = []
    for base, side in ((1, "L Knee"), (20, "R Knee")):
        rows.append((base, 0, side))
        rows += [(base + 1, k, h) for k, h in enumerate(("File Name", "Maneuvers", "Microphone", "Patellar Position", "Laterality", "Notes"))]
        for m, label in enumerate(("Walk (slow,medium, fast)", "Flexion - Extension", "Sit-to-Stand")):
            for mic in range(4):
                r = base + 2 + 4 * m + mic
                rows += [(r, 0, f"{side[0]}{m}"), (r, 2, str(mic + 1)), (r, 3, "Infrapatellar" if mic < 2 else "Suprapatellar"), (r, 4, "Lateral" if mic in (0, 3) else "Medial")]
                if mic == 0:
                    rows.append((r, 1, label))
    return [("w", *r) for r in rows]


def test_legend(spark):
    cells = spark.createDataFrame(_legend_cells(), "recording_id string, row int, col int, value string")
    got = sh.legend(cells, ["recording_id"])
    assert got.count() == 24
    r = got.filter("knee = 'right' AND maneuver = 'sit_to_stand' AND mic = 3").first()
    assert (r.file_name, r.patellar, r.laterality) == ("R2", "Suprapatellar", "Medial")


def test_second_legend_layout_and_reconcile(spark):
    rows = [(0, 2, "Date: 3/12/2024")]
    for k in range(4):
        for o in (0, 3):
            rows += [(3 + k, o, str(k + 1)), (3 + k, o + 1, "Infrapatellar"), (3 + k, o + 2, "Medial")]
    for base, side in ((10, "Left knee"), (20, "Right Knee")):
        rows.append((base, 0, side))
        for m, label in enumerate(("Walking", "Sit to Stand", "Flexion Extension")):
            rows += [(base + 2 + m, 0, f"file{base}{m}"), (base + 2 + m, 1, "12.5"), (base + 2 + m, 4, label)]
    fixed = sh.fixed_legend(spark.createDataFrame([("w", *r) for r in rows], "recording_id string, row int, col int, value string"), ["recording_id"])
    r = fixed.filter("knee = 'left' AND maneuver = 'walk' AND mic = 1").first()
    assert (r.file_name, r.file_size_mb, r.serial_number, str(r.recorded_on)[:10]) == ("file100", 12.5, "unknown", "2024-03-12")
    primary = sh.legend(spark.createDataFrame(_legend_cells(), "recording_id string, row int, col int, value string"), ["recording_id"])
    chosen, bad = sh.reconcile_legends(primary, fixed, ["recording_id"])
    assert chosen.count() == 24 and chosen.filter("file_name = 'L0'").count() == 4
    fields = {r.field for r in bad.filter("knee = 'left' AND maneuver = 'walk'").collect()}
    assert fields == {"file_name", "mic_1_laterality", "mic_3_patellar_position", "mic_4_patellar_position", "mic_4_laterality"}


def test_loose_cells(spark):
    df = spark.createDataFrame([("1.5",), ("0:01:30",), ("2 days",), ("1 day 00:00:01.5",), ("x",), (None,)], "v string")
    assert [r[0] for r in df.select(sc.to_seconds(F.col("v"))).collect()] == [1.5, 90.0, 172800.0, 86401.5, None, None]
    ids = spark.createDataFrame([(" aoa1011",), ("1002",), ("preOA1003",), ("12",), ("x1011",)], "v string")
    assert [r[0] for r in ids.select(sc.study_number(F.col("v"))).collect()] == [1011, 1002, 1003, None, None]
    names = spark.createDataFrame([("Left_Walk_Pass0012_slow",), ("a_p7_b",), ("none",)], "v string")
    assert [r[0] for r in names.select(sc.pass_number(F.col("v"))).collect()] == [12, 7, None]


def test_sheet_columns(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0)], "TIME double, `Left Knee Angle_X` double, `Right Knee Angle_X` double")
    assert sh.side_columns(df, "left", ["TIME"]).columns == ["TIME", "Knee Angle X"]
    assert sh.rename_events(spark.createDataFrame([("a", 1.0)], "`Event Info` string, `Time (sec)` double")).columns == ["event", "t"]


def test_export_without_clock(spark):
    df = spark.createDataFrame([("a", k, 1.0) for k in range(5)], "recording_id string, i int, ch1 double")
    got = sinks.export_channels(df, start=F.lit(2.0), stop=F.lit(4.0)).orderBy("i").collect()
    assert [r.tt for r in got] == ["2.000000", "2.500000", "3.000000", "3.500000", "4.000000"] and got[0].ch2 is None


SYNC = "study_id int, knee string, maneuver string, pass_number int, speed string, id long, is_active boolean, note string, path string"


def test_upsert_is_null_safe_and_repeatable(spark, tmp_path):
    cur = spark.createDataFrame([(1, "left", "sts", None, None, 5, False, "old", "p"), (1, "left", "walk", 1, "slow", 6, True, "old", "q")], SYNC)
    inc = spark.createDataFrame([(1, "left", "sts", None, None, "new", None), (2, "left", "sts", None, None, "new", "r")],
                                "study_id int, knee string, maneuver string, pass_number int, speed string, note string, path string")
    once = tb.upsert(cur, inc, tb.SYNC_KEY, keep_if_null=("path",))
    got = {r.id: (r.is_active, r.note, r.path) for r in once.collect()}
    assert got == {5: (True, "new", "p"), 6: (True, "old", "q"), 7: (True, "new", "r")}
    again = tb.upsert(once, inc, tb.SYNC_KEY, keep_if_null=("path",))
    assert once.exceptAll(again).count() == 0 and again.count() == 3
    assert vd.duplicate_keys(again, tb.SYNC_KEY).count() == 0
    tb.write_snapshot(cur, str(tmp_path))
    tb.write_snapshot(once, str(tmp_path))
    assert tb.read_snapshot(spark, str(tmp_path)).count() == 3


def test_motion_upsert_changes_status_only(spark):
    schema = "study_id int, biomechanics_file string, knee string, maneuver string, id long, is_active boolean, rate double, processing_status string, processing_date string, audio_processing_id long"
    cur = spark.createDataFrame([(1, "f", "left", "walk", 1, False, 100.0, "error", "d1", 9)], schema)
    inc = spark.createDataFrame([(1, "f", "left", "walk", 120.0, "success", "d2", None)], "study_id int, biomechanics_file string, knee string, maneuver string, rate double, processing_status string, processing_date string, audio_processing_id long")
    r = tb.upsert_motion(cur, inc).first()
    assert (r.rate, r.processing_status, r.processing_date, r.audio_processing_id, r.is_active) == (100.0, "success", "d2", 9, True)


def test_file_rules(spark):
    df = spark.sql("SELECT 1 AS id, 'walk' AS maneuver, CAST(NULL AS INT) AS pass_number, 'slow' AS speed, map(1,'a',2,'b',3,'c',4,'d') AS microphones "
                   "UNION ALL SELECT 2, 'sts', NULL, NULL, map(1,'a') ")
    assert {(r.id, r.rule) for r in vd.violations(df, ["id"], vd.file_rules()).collect()} == {(1, "walk_without_pass_or_speed"), (2, "microphones_not_1_to_4")}
    assert vd.missing_columns(df, ("id", "tt")) == ["tt"]


def test_clinical_sheets(spark):
    base = {"Study ID": ["1001", "AOA1002"], **{c: [1.0, 2.0] for c in cl.KOOS_ITEMS}}
    right, left = spark.createDataFrame(pd.DataFrame(base)), spark.createDataFrame(pd.DataFrame(base).iloc[:1])
    rows = {r.study_id: r for r in cl.koos(right, left).collect()}
    assert rows[1002]["s1_r_knee"] == 2.0 and rows[1002]["s1_l_knee"] is None and len(rows[1001]) == 1 + 2 * len(cl.KOOS_ITEMS)
    make = lambda cols, knees, v: spark.createDataFrame(pd.DataFrame([{"Study ID": "1001", "Knee": k, **{c: v for c in cols}} for k in knees]))
    tfm, pfm = make(cl.TFM_COLUMNS, ["Left", "right"], 1), make(cl.PFM_COLUMNS, ["right"], 2)
    r = cl.oai(tfm, pfm).first()
    assert r["OST MFC (0-3+)_left"] == 1 and r["JSN M (0-3+)_right"] == 2 and r["JSN M (0-3+)_left"] == 1
    assert [(x.sheet, x.knee) for x in cl.missing_knees(tfm, pfm).collect()] == [("PFM", "left")]
    both = cl.combined([cl.koos(right, left).select("study_id", "s1_r_knee"), cl.oai(tfm, pfm).select("study_id", "`OST MFC (0-3+)_left`")])
    assert both.count() == 2
    two = cl.outcomes({"R": spark.createDataFrame([("AOA1001", "y")], "`Study ID` string, pain string"), "L": spark.createDataFrame([("1001", "3")], "`Study ID` string, pain string")}, "pain")
    assert {(x.study_id, x.knee, x.pain) for x in two.collect()} == {("1001", "R", 1.0), ("1001", "L", 3.0)}


def _two_clouds(spark, n=60, seed=0):
    rng = np.random.default_rng(seed)
    y = np.arange(n) % 2
    x = rng.normal(size=(n, 2)) + y[:, None] * [1.5, 0.5]
    pdf = pd.DataFrame({"study_id": np.arange(n) // 4, "knee": np.where(np.arange(n) // 2 % 2, "R", "L"), "row": np.arange(n), "a": x[:, 0], "b": x[:, 1], "label": y.astype(float)})
    return spark.createDataFrame(pdf), pdf


def test_logistic_regression_is_ridge_of_strength_one(spark):
    df, pdf = _two_clouds(spark)
    model, _ = md.fit(df, ["a", "b"])
    x = pdf[["a", "b"]].to_numpy()
    x = (x - x.mean(0)) / x.std(0)
    w = np.zeros(3)
    z = np.c_[np.ones(len(x)), x]
    for _ in range(50):
        p = 1 / (1 + np.exp(-z @ w))
        w -= np.linalg.solve(z.T @ (z * (p * (1 - p))[:, None]) + np.diag([0, 1, 1]), z.T @ (p - pdf["label"]) + np.r_[0, w[1:]])
    np.testing.assert_allclose(model.coefficients.toArray(), w[1:], atol=1e-4)


def test_folds_are_stratified_and_keep_knees_whole(spark):
    df, _ = _two_clouds(spark)
    f = md.assign_folds(df.withColumn("label", (F.col("study_id") % 2).cast("double")), 5, ["study_id", "knee"])
    assert f.groupBy("study_id", "knee").agg(F.count_distinct("fold").alias("n")).filter("n > 1").count() == 0
    sizes = f.select("study_id", "knee", "label", "fold").distinct().groupBy("label", "fold").count().collect()
    for label in (0.0, 1.0):
        n = [r["count"] for r in sizes if r["label"] == label]
        assert len(n) == 5 and max(n) - min(n) <= 1


def test_split_guards_the_other_knee(spark):
    df, _ = _two_clouds(spark)
    out = md.train_test(df, ["a", "b"], ["study_id", "knee"], by_knee=True)
    assert out["excluded_contralateral"] > 0 and out["test"]["accuracy"] > 0.5 and out["confusion"].count() >= 2


def test_small_sets_leave_one_out(spark):
    rows = [(k, float(k > 2), float(k), float(k * k)) for k in range(5)]
    df = spark.createDataFrame(rows, "study_id int, label double, a double, b double")
    out = md.train_with_fallback(df, ["a", "b"], ["study_id"], ["study_id"])
    assert out["mode"] == "loocv" and out["samples"] == 5 and out["scored"] == 5
    with pytest.raises(ValueError):
        md.train_with_fallback(df.withColumn("label", F.lit(1.0)), ["a"], ["study_id"], ["study_id"])


def test_pipelines(spark):
    df, pdf = _two_clouds(spark, 120)
    knees = pdf.groupby(["study_id", "knee"], as_index=False)["label"].max().assign(pain=lambda d: np.where((d.study_id + (d.knee == "R")) % 2 == 0, "yes", "no"))[["study_id", "knee", "pain"]]
    out = md.knee_pipeline(df.select("study_id", "knee", "a", "b"), spark.createDataFrame(knees), ["a", "b"], "pain")
    assert out["mode"] == "train_test_split" and out["samples"] == 120
    with pytest.raises(ValueError):
        md.knee_pipeline(df, spark.createDataFrame(pd.concat([knees, knees.head(1)])), ["a", "b"], "pain")
    people = spark.createDataFrame([(k, "yes" if k % 3 else "no") for k in range(30)], "study_id int, pain string")
    assert md.participant_pipeline(df, people, ["a", "b"], "pain")["samples"] == 30
