"""Publication of runs: failed participants keep what they had, interleaved runs all survive, conflicts are found."""

import os

import pytest
from pyspark.sql import functions as F

from kymora.plans import persist
from kymora.plans.pipeline import Publication, PublicationConflict, StageStore

SHAPE = "recording_id string, study_id long, audio_file_name string, knee string, maneuver string, pass_number int, speed string, biomechanics_file string, file_size_mb double"


def rec(name, study, knee="left", maneuver="walk", size=1.0):
    walk = maneuver == "walk"
    return (name, study, f"{name}.bin", knee, maneuver, 1 if walk else None, "slow" if walk else None, f"AOA{study}_{knee}", size)


def lay(spark, store, rows, failed=(), cycles=2, stomp=1.0, outlier=False):
    """Stage tables as a run over ``rows`` leaves them: a failed recording has a status and no cycles."""
    good = [r[0] for r in rows if r[0] not in failed]
    store.write("artifact_interval", spark.createDataFrame([(r[0], "dropout", "ch1", 0.0, 0.5) for r in rows if r[1] % 2], "recording_id string, kind string, channel string, start double, end double"))
    store.write("sync_status", spark.createDataFrame([(r[0], r[0] not in failed) for r in rows], "recording_id string, ok boolean"))
    store.write("sync_record", spark.createDataFrame([(n, stomp, 2.0, 9.0) for n in good], "recording_id string, audio_stomp double, motion_stomp double, motion_duration double"))
    store.write("cycle", spark.createDataFrame([(n, k, outlier, True) for n in good for k in range(cycles)], "recording_id string, cycle_index int, is_outlier boolean, audio_qc_pass boolean"))
    return spark.createDataFrame(rows, SHAPE)


def tables(store):
    return {n: sorted(map(repr, store.read(n).collect())) for n in persist.KEYS}


def test_a_failed_participant_keeps_everything(spark, tmp_path):
    store = StageStore(spark, str(tmp_path))
    rows = [rec("a1", 1), rec("a2", 1, "right"), rec("b1", 2)]
    persist.save_run(store, lay(spark, store, rows))
    before = tables(store)
    assert len(before["meta_cycle"]) == 6 and len(before["meta_motion"]) == 3
    # one recording of participant 1 fails, and one of it is new
    again = [rec("a1", 1, size=7.0), rec("a2", 1, "right"), rec("a3", 1, maneuver="sts"), rec("b1", 2, size=7.0)]
    persist.save_run(store, lay(spark, store, again, failed=("a2",), stomp=5.0, outlier=True))
    after = tables(store)
    for name in persist.KEYS:
        assert [r for r in before[name] if "study_id=1" in r] == [r for r in after[name] if "study_id=1" in r], name
    changed = store.read("meta_cycle").filter("study_id = 2").collect()
    assert all(r.is_outlier and r.is_active for r in changed) and store.read("meta_audio").filter("study_id = 2").first().file_size_mb == 7.0


def test_a_recording_without_a_status_counts_as_failed(spark, tmp_path):
    store = StageStore(spark, str(tmp_path))
    recordings = lay(spark, store, [rec("a1", 1)])
    more = recordings.unionByName(spark.createDataFrame([rec("a9", 1, "right")], SHAPE))
    persist.save_run(store, more)
    assert store.read("meta_audio").isEmpty()


def test_links_between_tables(spark, tmp_path):
    store = StageStore(spark, str(tmp_path))
    persist.save_run(store, lay(spark, store, [rec("a1", 1), rec("b1", 2), rec("b2", 2, "right", "fe")]))
    audio = {r.id: r for r in store.read("meta_audio").collect()}
    motion = {r.id: r for r in store.read("meta_motion").collect()}
    sync = {r.id: r for r in store.read("meta_sync").collect()}
    for r in audio.values():
        m = motion[r.biomechanics_import_id]
        assert (m.study_id, m.knee, m.maneuver, m.audio_processing_id, m.duration_seconds) == (r.study_id, r.knee, r.maneuver, r.id, 9.0)
        assert (r.qc_fail, r.qc_failures, r.dropout_seconds) == ((True, "dropout", 0.5) if r.study_id == 1 else (False, "", 0.0))
    for r in store.read("meta_cycle").collect():
        s = sync[r.synchronization_id]
        assert (s.study_id, s.knee, s.maneuver, s.pass_number) == (r.study_id, r.knee, r.maneuver, r.pass_number) and s.audio_processing_id == r.audio_processing_id
        assert audio[r.audio_processing_id].study_id == r.study_id


def test_interleaved_runs_both_survive(spark, tmp_path):
    first = StageStore(spark, str(tmp_path))
    persist.save_run(first, lay(spark, first, [rec("a1", 1), rec("b1", 2)]))
    one, two = (StageStore(spark, str(tmp_path), only).begin() for only in (("a1",), ("b1", "c1")))
    rows_one, rows_two = lay(spark, one, [rec("a1", 1, size=3.0)], stomp=8.0), lay(spark, two, [rec("b1", 2, size=4.0), rec("c1", 3)], cycles=1)
    assert persist.save_run(two, rows_two) == 2
    assert persist.save_run(one, rows_one) == 3
    store = StageStore(spark, str(tmp_path))
    assert {(r.study_id, r.file_size_mb) for r in store.read("meta_audio").collect()} == {(1, 3.0), (2, 4.0), (3, 1.0)}
    assert {(r.recording_id, r.audio_stomp) for r in store.read("sync_record").collect()} == {("a1", 8.0), ("b1", 1.0), ("c1", 1.0)}
    active = {(r.study_id, r.cycle_index): r.is_active for r in store.read("meta_cycle").collect()}
    assert active == {(1, 0): True, (1, 1): True, (2, 0): True, (2, 1): False, (3, 0): True}
    ids = [r.id for r in store.read("meta_cycle").collect()]
    assert len(set(ids)) == len(ids)


def test_a_version_is_taken_once(spark, tmp_path):
    store = StageStore(spark, str(tmp_path))
    store.write("facts", spark.createDataFrame([(1,)], "n int"))
    store.publish()
    assert store._commit(Publication(2, {"facts": "x"}, ("facts",)))
    assert not StageStore(spark, str(tmp_path))._commit(Publication(2, {"facts": "y"}, ("facts",)))
    assert store.latest().tables == {"facts": "x"} and sorted(os.listdir(tmp_path / "_log")) == ["000000000001", "000000000002"]


def test_a_race_is_lost_and_won_later(spark, tmp_path, monkeypatch):
    """Another run commits between this run's look at the current version and its commit."""
    store, other = StageStore(spark, str(tmp_path), ("a",)), StageStore(spark, str(tmp_path), ("b",))
    shape = "recording_id string, x int"
    store.write("signal", spark.createDataFrame([("a", 1)], shape))
    other.write("signal", spark.createDataFrame([("b", 2)], shape))
    commit = StageStore._commit
    raced = []

    def late(self, new):
        if self is store and not raced:
            raced.append(other.publish())
        return commit(self, new)

    monkeypatch.setattr(StageStore, "_commit", late)
    assert store.publish() == 2 and raced == [1]
    assert {tuple(r) for r in StageStore(spark, str(tmp_path)).read("signal").collect()} == {("a", 1), ("b", 2)}


def test_a_run_whose_inputs_changed_is_refused(spark, tmp_path):
    store = StageStore(spark, str(tmp_path))
    shape = "recording_id string, x int"
    store.write("signal", spark.createDataFrame([("a", 1), ("b", 1)], shape))
    store.publish()
    stale, apart = StageStore(spark, str(tmp_path), ("a",)).begin(), StageStore(spark, str(tmp_path), ("b",)).begin()
    for s in (stale, apart):
        s.write("cycle", s.read("signal").withColumn("x", F.col("x") * 10))
    newer = StageStore(spark, str(tmp_path), ("a",))
    newer.write("signal", spark.createDataFrame([("a", 2)], shape))
    newer.publish()
    assert stale.read("signal").first().x == 1  # one version throughout
    with pytest.raises(PublicationConflict):
        stale.publish()
    apart.publish()
    assert {tuple(r) for r in store.read("cycle").collect()} == {("b", 10)}


def test_a_failure_before_the_commit_changes_nothing(spark, tmp_path):
    store = StageStore(spark, str(tmp_path))
    persist.save_run(store, lay(spark, store, [rec("a1", 1)]))
    before = store.latest()
    lay(spark, store, [rec("a1", 1, size=5.0)])

    def broken(tables):
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        store.publish(broken)
    assert StageStore(spark, str(tmp_path)).latest() == before


def test_saving_takes_one_join_of_the_records(spark):
    key = ["study_id", "knee", "maneuver", "pass_number"]
    shape = "study_id long, knee string, maneuver string, pass_number int, id long, is_active boolean, size int"
    current = spark.createDataFrame([
        (1, "left", "walk", None, 4, True, 1), (1, "left", "walk", 2, 5, True, 1), (1, "left", None, 1, 6, True, 1),
        (2, "left", "walk", 1, 7, True, 1), (1, "left", "walk", 3, 8, False, 1), (1, "left", "walk", 4, 9, None, 1)], shape)
    incoming = spark.createDataFrame([(1, "left", "walk", None, 2), (1, "left", "walk", 3, 2), (1, "left", None, 9, 2), (None, "left", "walk", 1, 2)], "study_id long, knee string, maneuver string, pass_number int, size int")
    scope = spark.createDataFrame([(1, "left", "walk"), (1, "left", None), (1, "left", "walk")], "study_id long, knee string, maneuver string")
    after = persist.save(current, incoming, scope, key)
    assert after.columns == current.columns and "LeftSemi" not in after._jdf.queryExecution().toString()
    assert {tuple(r) for r in after.collect()} == {
        (1, "left", "walk", None, 4, True, 2), (1, "left", "walk", 2, 5, False, 1), (1, "left", None, 1, 6, False, 1), (2, "left", "walk", 1, 7, True, 1),
        (1, "left", "walk", 3, 8, True, 2), (1, "left", "walk", 4, 9, False, 1), (None, "left", "walk", 1, 10, True, 2), (1, "left", None, 9, 11, True, 2)}
