"""Queries give the whole output of their operators."""

import __spark_entry__ as entry
from tests.conftest import SF


def test_continuous_artifacts_are_judged(spark):
    rows = entry.queries()["cycle_verdicts"](spark, SF).collect()
    table = entry.queries()["cycle_artifact_table"](spark, SF).filter("kind = 'continuous'").collect()
    judged = {(r.recording_id, r.cycle_index): r for r in rows}
    assert table
    for r in table:  # a quarter of a second of at most one
        row = judged[r.recording_id, r.cycle_index]
        assert not row.audio_qc_pass and not row.audio_qc_ch2_pass


def test_short_cycles_have_a_template_row(spark):
    got = entry.queries()["template_correlation_whole"](spark, SF)
    cycles = entry.queries()["cycle_energy"](spark, SF)
    keys = ["recording_id", "cycle_index"]
    assert cycles.join(got, keys, "left_anti").isEmpty()


def test_whole_output_is_registered(spark):
    q = entry.queries()
    features = q["channel_features_whole"](spark, SF).columns
    assert len(features) == 1 + 5 * 8 + 6
    assert len(q["participant_features_whole"](spark, SF).columns) == 1 + 4 * (5 * 8 + 6)
    assert {r.bin for r in q["stft_db_whole"](spark, SF).select("bin").distinct().collect()} == set(range(17))
    assert {"sound_reason", "sound_value"} <= set(q["sound_sit_to_stand_whole"](spark, SF).columns)
    assert q["legend_chosen"](spark, SF).count() == spark.read.parquet(f"{SF}/part.parquet").count()
