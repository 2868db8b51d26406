"""Metadata tables, reports, ingest, sheets, clinical tables and models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kymora.functions import scalars as sc
from kymora.operators import clinical as cl
from kymora.operators import features as ft
from kymora.operators import models as md
from kymora.operators import reports as rp
from kymora.operators import tables as tb
from kymora.operators import validate as vd
from kymora.queries.common import r, rounded
from kymora.session import durable
from kymora.sources import adapters as ad
from kymora.sources import catalog as ct
from kymora.sources import dump as dp
from kymora.sources import sheets as sh

# ---- ingest -------------------------------------------------------------------------------------


def _words(spark: SparkSession, sf: str) -> DataFrame:
    """Line items packed as device words: a file per supplier, two words per sample."""
    s = ad.signal_multi(spark, sf)
    code = lambda c: (F.round(F.col(c) * 10000).cast("long") % 65536)
    per = dp.DATA_WORDS // 2
    base = s.select(F.col("recording_id").alias("file"), F.floor(F.col("i") / per).cast("long").alias("packet"), (F.col("i") % per).alias("k"),
                    *[code(c).alias(c) for c in ad.CHANNELS])
    pair = F.posexplode(F.array(F.shiftleft("ch1", 16) + F.col("ch2"), F.shiftleft("ch3", 16) + F.col("ch4")))
    return base.select("file", "packet", "k", pair.alias("side", "word")).select(
        "file", "packet", (F.col("k") * 2 + F.col("side")).cast("int").alias("j"), "word")


def decode_dump(spark: SparkSession, sf: str) -> DataFrame:
    w = _words(spark, sf)
    ticks = w.select("file").distinct().select("file", (F.col("file") * 4096).alias("start_tick"), (F.col("file") * 8192 + 4096).alias("first_tick"))
    return rounded(dp.clock(dp.unpack(w), ticks))


def unwrap_counter(spark: SparkSession, sf: str) -> DataFrame:
    """Tick counters that roll over about every forty events."""
    e = ad.signal_irregular(spark, sf)
    words = e.select(F.col("recording_id").alias("file"), F.floor(F.col("i") / 128).alias("packet"), (F.col("i") % 128 + dp.DATA_WORDS).cast("int").alias("j"),
                     ((F.col("i") * 100_000_000 + 1) % 4294967296).alias("word"))
    return rounded(dp.time_blocks(words).select("file", "i", "unwrapped", "seconds"))


def file_name_parse(spark: SparkSession, sf: str) -> DataFrame:
    a = ad.audio_table(spark, sf)
    p = sc.file_name_parts(F.col("audio_file_name"))
    return a.select("id", p["device_serial"].alias("device_serial"), p["recorded_at"].cast("timestamp_ntz").alias("recorded_at"))


def uid_parse(spark: SparkSession, sf: str) -> DataFrame:
    """Motion uids built from orders, good and bad."""
    o = ad.table(spark, sf, "orders")
    kind = F.element_at(F.array(*[F.lit(x) for x in ("Walk0001", "SitToStand0001", "FlexExt0001", "Hop0001")]), (F.col("o_orderkey") % 4 + 1).cast("int"))
    code = F.element_at(F.array(*[F.lit(x) for x in ("SSP", "NSP", "FSP", "XSP")]), (F.col("o_custkey") % 4 + 1).cast("int"))
    raw = F.concat(F.lit("V3D\\AOA"), (F.col("o_custkey") + 1000).cast("string"), F.lit("_"), kind, F.lit("_"), code, (F.col("o_orderkey") % 9 + 1).cast("string"), F.lit("_Filt.c3d"))
    p = sc.uid_parts(F.col("uid"))
    d = o.select("o_orderkey", sc.clean_uid(raw).alias("uid"))
    return d.select("o_orderkey", "uid", *[v.alias(k) for k, v in p.items()], sc.uid_problem(p).alias("problem"))


def loose_times(spark: SparkSession, sf: str) -> DataFrame:
    """Seconds from numbers, clock text and days."""
    e = ad.table(spark, sf, "events")
    v, k = F.col("value"), F.col("event_id") % 4
    clock = F.concat(F.floor(v / 60).cast("string"), F.lit(":"), F.lpad(F.floor(v % 60).cast("string"), 2, "0"))
    text = F.when(k == 0, v.cast("string")).when(k == 1, clock).when(k == 2, F.concat(F.lit("2 days 01:"), clock)).otherwise(F.lit("n/a"))
    return rounded(e.select("event_id", sc.to_seconds(text).alias("seconds")))


def event_lookup(spark: SparkSession, sf: str) -> DataFrame:
    m = ad.markers(spark, sf)
    t = sh.event_times(m, ["recording_id"], {"slow": "Slow Speed", "pass_2_start": "Pass 2 Start", "pass_3_end": "Pass 3 End"})
    return rounded(t)


def missing_markers(spark: SparkSession, sf: str) -> DataFrame:
    m = ad.markers(spark, sf)
    return sh.missing_events(sh.event_times(m, ["recording_id"], {"pass_1": "Pass 1 Start", "pass_9": "Pass 9 End"}), ["recording_id"])


def _motion_cells(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """A workbook per user: three columns (clock and two angles) of header and value cells."""
    e = ad.signal_irregular(spark, sf)
    uid = F.concat(F.lit("V3D\\AOA"), (F.col("recording_id") + 1000).cast("string"), F.lit("_Walk0001_NSP1_Filt.c3d"))
    body = e.select("recording_id", uid.alias("uid"), (F.col("i") + 2).cast("int").alias("row"), F.posexplode(
        F.array(F.col("t").cast("string"), F.col("v").cast("string"), (F.col("v") * 2).cast("string"))).alias("col", "value"))
    head = e.select("recording_id", uid.alias("uid")).distinct().select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("row")).select(
        "*", F.posexplode(F.when(F.col("row") == 0, F.array(F.lit("Frame"), F.lit("Left Knee Angle"), F.lit("Right Knee Angle"))).otherwise(
            F.array(F.lit("t"), F.lit("X"), F.lit("Z")))).alias("col", "value"))
    events = e.filter("event = 'click'").select("recording_id", F.lit(" NS Pass 1 Start ").alias("event"), "t", F.col("i").alias("row"))
    return body.unionByName(head), events


def motion_import(spark: SparkSession, sf: str) -> DataFrame:
    cells, events = _motion_cells(spark, sf)
    series, _ = sh.import_motion(cells, events, ["recording_id"], ["Left Knee Angle_X", "Right Knee Angle_Z"])
    return rounded(series.withColumnsRenamed({"Left Knee Angle_X": "left_x", "Right Knee Angle_Z": "right_z"}))


def fill_down(spark: SparkSession, sf: str) -> DataFrame:
    """Labels given only on some rows, carried down."""
    e = ad.signal_irregular(spark, sf)
    return sh.fill_down(e, ["recording_id"], F.when(F.col("event") == "purchase", F.col("event_id")), "label", "i").select("recording_id", "i", "label")


def mic_positions(spark: SparkSession, sf: str) -> DataFrame:
    p = ad.table(spark, sf, "part")
    pat = F.when(F.col("p_size") % 2 == 0, "Infrapatellar").otherwise("suprapatellar ")
    lat = F.when(F.col("p_partkey") % 2 == 0, "Medial").otherwise(" lateral")
    return p.select("p_partkey", sc.mic_position(pat, lat).alias("position"), sc.pass_number(F.concat(F.lit("walk_p"), F.col("p_size").cast("string"), F.lit("_slow"))).alias("pass_number"))


def _legends(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Two legends built from parts: the chosen rows, and their disagreements."""
    p = ad.table(spark, sf, "part")
    base = p.select(F.floor(F.col("p_partkey") / 4).cast("long").alias("recording_id"), F.when(F.floor(F.col("p_partkey") / 4) % 2 == 0, "left").otherwise("right").alias("knee"),
                    F.lit("walk").alias("maneuver"), (F.col("p_partkey") % 4 + 1).cast("int").alias("mic"), "p_size", "p_brand")
    a = base.select("recording_id", "knee", "maneuver", "mic", F.when(F.col("recording_id") % 5 > 0, F.concat(F.lit("f"), F.col("recording_id").cast("string"))).alias("file_name"),
                    F.when(F.col("p_size") % 2 == 0, "Infrapatellar").otherwise("Suprapatellar").alias("patellar"), F.lit("Medial").alias("laterality"))
    b = base.select("recording_id", "knee", "maneuver", "mic", F.concat(F.lit("f"), F.col("recording_id").cast("string")).alias("file_name"),
                    F.when(F.col("p_size") % 3 == 0, "Infrapatellar").otherwise("Suprapatellar").alias("patellar"), F.lit("Medial").alias("laterality"))
    return sh.reconcile_legends(a, b, ["recording_id"])


def legend_reconcile(spark: SparkSession, sf: str) -> DataFrame:
    """The disagreements of two legends."""
    return _legends(spark, sf)[1]


def legend_chosen(spark: SparkSession, sf: str) -> DataFrame:
    """The legend rows chosen from two legends."""
    return _legends(spark, sf)[0]


def completeness_audit(spark: SparkSession, sf: str) -> DataFrame:
    have = ad.audio_table(spark, sf).select(F.col("study_id").alias("participant"), "knee", "maneuver")
    people = ad.table(spark, sf, "customer").select(F.col("c_custkey").alias("participant"))
    return ct.completeness_audit(ct.expected_matrix(people, {"knee": sc.KNEES, "maneuver": sc.MANEUVERS}), have, ["participant", "knee", "maneuver"])


def scope_selection(spark: SparkSession, sf: str) -> DataFrame:
    a = ad.audio_table(spark, sf).withColumnRenamed("study_id", "participant")
    return ct.select_scope(a, knees=["left"], maneuvers=["walk", "sts"], limit=50).select("id", "participant", "knee", "maneuver")


def committed_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Orders of customers none of whose orders failed."""
    a = ad.audio_table(spark, sf)
    status = a.select("study_id", (F.col("file_size_mb") < 450000).alias("ok"))
    return ct.committed(a, status, ["study_id"]).select("id", "study_id")


def processed_participants(spark: SparkSession, sf: str) -> DataFrame:
    logs = ad.audio_table(spark, sf).filter("maneuver = 'walk'").select(F.col("study_id").alias("participant"), "knee")
    return ct.processed_participants(logs)


# ---- rules and tables ---------------------------------------------------------------------------


def rule_violations(spark: SparkSession, sf: str) -> DataFrame:
    a = ad.audio_table(spark, sf).select(
        "id", (F.col("study_id") - 5).alias("study_id"), (F.col("biomechanics_import_id") - 3).alias("biomechanics_import_id"), "recording_date",
        (F.col("recording_time") + F.make_dt_interval(days=(F.col("id") % 50 == 0).cast("int"))).alias("recording_time"),
        (F.col("file_size_mb") - 1500).alias("file_size_mb"), (F.col("id") % 6).alias("num_channels"), (F.col("id") % 40 - 1.0).alias("sample_rate"),
        (F.col("id") % 30 - 1).alias("firmware_version"), F.when(F.col("id") % 2 == 0, F.col("id") % 10 - 1.0).alias("duration_seconds"))
    return vd.violations(a, ["id"], vd.audio_rules())


def motion_violations(spark: SparkSession, sf: str) -> DataFrame:
    m = ad.motion_table(spark, sf).select(
        "id", "maneuver", F.when(F.col("id") % 3 > 0, F.col("id") % 4).alias("pass_number"), F.when(F.col("id") % 5 > 0, "slow").alias("speed"),
        F.col("id").alias("audio_processing_id"), (F.col("id") % 9 - 1.0).alias("biomechanics_sample_rate"), F.lit(1).alias("num_sub_recordings"),
        (F.col("id") % 11 - 1).alias("num_passes"), F.lit(10).alias("num_data_points"), F.lit(1.0).alias("duration_seconds"))
    return vd.violations(m, ["id"], vd.motion_rules())


def sync_violations(spark: SparkSession, sf: str) -> DataFrame:
    s = ad.sync_table(spark, sf)
    some = lambda k, e=F.col("id") * 0.5: F.when(F.col("id") % k > 0, e)
    d = s.select(
        "id", "audio_processing_id", F.col("id").alias("biomechanics_import_id"), F.lit(3).alias("total_cycles_extracted"), F.lit(1).alias("clean_cycles"), F.lit(2).alias("outlier_cycles"),
        F.when(F.col("id") % 2 == 0, F.array(F.lit("consensus"), F.lit("biomechanics"))).when(F.col("id") % 3 == 0, F.array(F.lit("audio"))).alias("stomp_detection_methods"),
        some(5).alias("bio_selected_sync_time"), some(7).alias("contra_bio_selected_sync_time"), some(11).alias("audio_selected_sync_time"),
        some(13).alias("contra_audio_selected_sync_time"), some(2).alias("audio_sync_time_left"), some(3).alias("audio_sync_time_right"), some(5).alias("audio_sync_offset"))
    return vd.violations(d, ["id"], vd.sync_rules())


def cycle_violations(spark: SparkSession, sf: str) -> DataFrame:
    c = ad.cycle_table(spark, sf).select(
        "id", "audio_processing_id", F.lit(None).cast("int").alias("biomechanics_import_id"), "synchronization_id", (F.col("cycle_index") - 10).alias("cycle_index"),
        (F.col("start_time_s") - 2).alias("start_time_s"), "end_time_s", F.col("duration").alias("duration_s"),
        F.when(F.col("cycle_index") % 3 > 0, 1).alias("pass_number"), F.when(F.col("cycle_index") % 4 > 0, "slow").alias("speed"))
    return vd.violations(c, ["id"], vd.cycle_rules())


def domain_violations(spark: SparkSession, sf: str) -> DataFrame:
    o = ad.table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("maneuver"), F.lit("left").alias("knee"))
    return vd.violations(o, ["id"], vd.domain_rules({"maneuver": ("F", "O"), "knee": sc.KNEES}))


def key_uniqueness(spark: SparkSession, sf: str) -> DataFrame:
    return vd.duplicate_keys(ad.sync_table(spark, sf), tb.SYNC_KEY)


def orphan_records(spark: SparkSession, sf: str) -> DataFrame:
    c, s = ad.cycle_table(spark, sf), ad.sync_table(spark, sf).filter("sync_duration > 5")
    return vd.orphans(c, s, "synchronization_id", "id").select("id", "synchronization_id")


def outdated_records(spark: SparkSession, sf: str) -> DataFrame:
    a = ad.audio_table(spark, sf).select("id", (F.col("id") % 3).cast("int").alias("audio_qc_version"))
    return vd.outdated(a, "audio")


def _snapshots(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Synchronisations before and in a run, one per key; the run repeats some and brings others."""
    key = [*tb.SYNC_KEY]
    s = ad.sync_table(spark, sf)
    old = tb.latest_per_key(s.filter("id % 3 > 0"), key, ["id"]).select(*key, "id", "is_active", "sync_duration", "sync_file_name")
    new = tb.latest_per_key(s.filter("id % 3 < 2"), key, ["id"]).select(*key, (F.col("sync_duration") + 0.5).alias("sync_duration"), F.when(F.col("id") % 2 == 0, F.col("sync_file_name")).alias("sync_file_name"))
    return old, new


def upsert_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    old, new = _snapshots(spark, sf)
    return rounded(tb.upsert(old, new, tb.SYNC_KEY, keep_if_null=("sync_file_name",)))


def soft_delete(spark: SparkSession, sf: str) -> DataFrame:
    a = ad.audio_table(spark, sf).select("id", "study_id", "knee", "maneuver", "is_active")
    scope = a.filter("study_id % 4 = 0").select("study_id", "knee", "maneuver")
    return tb.soft_delete(a, a.filter("id % 3 = 0"), scope, ["study_id", "knee", "maneuver"])


def soft_delete_counts(spark: SparkSession, sf: str) -> DataFrame:
    a = ad.audio_table(spark, sf).select("id", "study_id", "knee", "maneuver", "is_active")
    after = soft_delete(spark, sf)
    return tb.deactivated_counts({"audio_processing": a}, {"audio_processing": after})


def get_or_create(spark: SparkSession, sf: str) -> DataFrame:
    s = ad.studies(spark, sf)
    have = s.filter("id % 2 = 0").withColumn("id", F.col("id") + 1)
    return tb.get_or_create(have, s, ["study_name", "study_participant_id"])


def link_motion(spark: SparkSession, sf: str) -> DataFrame:
    return tb.link_motion(ad.audio_table(spark, sf), ad.motion_table(spark, sf)).select("id", "biomechanics_import_id")


def filtered_read(spark: SparkSession, sf: str) -> DataFrame:
    return tb.find(ad.audio_table(spark, sf), ad.studies(spark, sf), study="AOA", maneuver="walk", knee="left").select("id", "study_participant_id")


def parent_lookup(spark: SparkSession, sf: str) -> DataFrame:
    s = ad.sync_table(spark, sf).select("id", "study_id", "knee", "maneuver")
    return tb.parent_ids(s, ad.audio_table(spark, sf), ["study_id", "knee", "maneuver"], "parent_id").select("id", "parent_id")


def reshaped_history(spark: SparkSession, sf: str) -> DataFrame:
    s = ad.studies(spark, sf)
    old = s.filter("id % 2 = 0").withColumnRenamed("study_participant_id", "participant_no")
    return tb.reshape([old, s.filter("id % 2 = 1").withColumn("note", F.lit("new"))], {"participant_no": "study_participant_id"})


# ---- reports ------------------------------------------------------------------------------------


def report_audio(spark: SparkSession, sf: str) -> DataFrame:
    d = rp.audio_sheet(ad.audio_table(spark, sf), ad.motion_table(spark, sf), ad.studies(spark, sf))
    return d.select("id", "participant_id", "knee", "maneuver", "audio_file_name", F.col("recording_datetime").cast("timestamp_ntz").alias("recording_datetime"), "linked_biomechanics_file", "linked_biomechanics_type")


def report_motion(spark: SparkSession, sf: str) -> DataFrame:
    return rp.motion_sheet(ad.motion_table(spark, sf), ad.studies(spark, sf)).select("id", "participant_id", "knee", "maneuver", "biomechanics_file")


def report_sync(spark: SparkSession, sf: str) -> DataFrame:
    return rp.sync_sheet(ad.sync_table(spark, sf), ad.audio_table(spark, sf), ad.studies(spark, sf)).select("id", "participant_id", "pass_number", "speed", "audio_file_name")


def report_cycles(spark: SparkSession, sf: str) -> DataFrame:
    d = rp.cycle_sheet(ad.cycle_table(spark, sf), ad.audio_table(spark, sf), ad.sync_table(spark, sf), ad.studies(spark, sf))
    return rounded(d.select("id", "participant_id", "pass_number", "speed", "cycle_index", "audio_file_name", "start_time_s", "is_outlier"))


def report_summary(spark: SparkSession, sf: str) -> DataFrame:
    return rp.summary(ad.audio_table(spark, sf), ad.motion_table(spark, sf), ad.sync_table(spark, sf), ad.cycle_table(spark, sf), ad.studies(spark, sf))


def knee_summary(spark: SparkSession, sf: str) -> DataFrame:
    c = ad.sync_table(spark, sf).filter("maneuver <> 'fe'").groupBy("study_id", "knee", "maneuver").agg(F.count(F.lit(1)).alias("n_sync"))
    return rp.knee_summary(c, ["study_id", "knee"], ["n_sync"])


def motion_statistics(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(rp.motion_statistics(ad.motion_table(spark, sf), ["study_id", "knee"]))


def recording_duration(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(rp.recording_duration(ad.signal_irregular(spark, sf), ["recording_id"], 100.0))


def distinct_by_key(spark: SparkSession, sf: str) -> DataFrame:
    s = ad.sync_table(spark, sf).withColumn("sync_file_name", F.when(F.col("id") % 10 > 0, F.col("sync_file_name"))).select("sync_file_name", "id", "knee")
    return ft.distinct_by_key(s, "sync_file_name", ["id"])


# ---- clinical and models ------------------------------------------------------------------------


def _sheet(spark: SparkSession, sf: str) -> DataFrame:
    c = ad.table(spark, sf, "customer")
    k = F.col("c_custkey")
    return c.select(
        F.when(k % 2 == 0, F.concat(F.lit(" aoa"), (k % 9000 + 1000).cast("string"))).otherwise((k % 9000 + 1000).cast("string")).alias("Study ID"),
        F.col("c_acctbal").cast("string").alias("BMI"), F.when(k % 7 == 0, "x").otherwise((k % 90).cast("string")).alias("Age (years)"),
        F.when(k % 2 == 0, "male").otherwise("Female").alias("Gender"), F.when(k % 3 == 0, "Yes").when(k % 3 == 1, "n").otherwise("?").alias("Knee Pain"),
        F.when(k % 5 == 0, "Y").otherwise("No").alias("Right Knee"), F.when(k % 4 == 0, "true").when(k % 4 == 1, "0").otherwise("2.5").alias("Left Knee"))


def demographics(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(cl.demographics(_sheet(spark, sf)))


def varus_thrust(spark: SparkSession, sf: str) -> DataFrame:
    return cl.varus_thrust(_sheet(spark, sf))


def kl_grades(spark: SparkSession, sf: str) -> DataFrame:
    o = ad.table(spark, sf, "orders")
    long = o.groupBy((F.col("o_custkey") % 9000 + 1000).cast("string").alias("Study ID"), F.when(F.col("o_orderkey") % 2 == 0, "Left ").otherwise("right").alias("Knee")).agg(
        F.max(F.col("o_orderkey") % 5).cast("string").alias("Grade"))
    return cl.kl_grades(long, "tfm")


def missing_knees(spark: SparkSession, sf: str) -> DataFrame:
    o = ad.table(spark, sf, "orders").select((F.col("o_custkey") % 9000 + 1000).cast("string").alias("Study ID"), F.when(F.col("o_orderkey") % 2 == 0, "Left").otherwise("Right").alias("Knee"), "o_orderstatus")
    return cl.missing_knees(o.filter("o_orderstatus = 'F'"), o.filter("o_orderstatus = 'O'"))


def wide_to_long_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(cl.outcomes(_sheet(spark, sf).withColumn("Study ID", F.upper(F.trim("Study ID"))), "outcome"))


def knee_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Cycle rows with their knee's yes/no outcome, and the label's distribution."""
    f = ad.cycle_table(spark, sf).select("study_id", "knee", F.col("duration").alias("x"))
    y = ad.audio_table(spark, sf).groupBy("study_id", "knee").agg(F.when(F.max("file_size_mb") > 400000, "Yes").otherwise("no").alias("pain"))
    return rounded(ft.label_distribution(md.knee_matrix(f, y, ["x"], "pain"), "label"))


def participant_labels(spark: SparkSession, sf: str) -> DataFrame:
    f = ad.cycle_table(spark, sf).select("study_id", "duration", "start_time_s")
    y = ad.table(spark, sf, "customer").select(F.col("c_custkey").alias("study_id"), F.when(F.col("c_acctbal") > 3000, " YES ").otherwise("no").alias("pain"))
    return rounded(md.participant_matrix(md.both_sides(f, y), y, ["duration", "start_time_s"], "pain"))


def contralateral_exclusion(spark: SparkSession, sf: str) -> DataFrame:
    a = ad.audio_table(spark, sf).select("id", "study_id", sc.knee_letter(F.col("knee")).alias("knee"))
    return md.exclude_contralateral(a.filter("id % 5 > 0"), a.filter("id % 5 = 0")).select("id", "study_id", "knee")


def duplicate_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    return md.duplicate_outcomes(ad.audio_table(spark, sf))


NAMES = ["n_chars", "n_words", "mean_word", "n_lines", "spaces"]


def _labelled(spark: SparkSession, sf: str) -> DataFrame:
    d = ad.table(spark, sf, "documents")
    words, lines = F.size(F.split("text", " ")), F.size(F.split("text", "\n"))
    x = d.select("doc_id", F.col("n_chars").cast("double").alias("n_chars"), words.cast("double").alias("n_words"), (F.col("n_chars") / words).alias("mean_word"),
                 lines.cast("double").alias("n_lines"), (words / lines).alias("spaces"))
    y = ad.table(spark, sf, "labels").select("doc_id", F.col("quality").cast("double").alias("label"))
    return durable(x.join(y, "doc_id"))


def logistic_cv(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(md.cross_validate(_labelled(spark, sf), NAMES, 5, ["doc_id"], spark))


def logistic_cv_summary(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(md.cross_validation_summary(md.cross_validate(_labelled(spark, sf), NAMES, 3, ["doc_id"], spark)))


def coefficient_topn(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(md.coefficients(md.train_test(_labelled(spark, sf), NAMES, ["doc_id"])["model"], NAMES, spark, 3))


def classifier_report(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(md.train_test(_labelled(spark, sf), NAMES, ["doc_id"])["report"])


QUERIES = {f.__name__: f for f in (
    decode_dump, unwrap_counter, file_name_parse, uid_parse, loose_times, event_lookup, missing_markers, motion_import, fill_down, mic_positions,
    legend_reconcile, legend_chosen, completeness_audit, scope_selection, committed_rows, processed_participants, rule_violations, motion_violations,
    sync_violations, cycle_violations, domain_violations, key_uniqueness, orphan_records, outdated_records, upsert_snapshot, soft_delete,
    soft_delete_counts, get_or_create, link_motion, filtered_read, parent_lookup, reshaped_history, report_audio, report_motion, report_sync,
    report_cycles, report_summary, knee_summary, motion_statistics, recording_duration, distinct_by_key, demographics, varus_thrust, kl_grades,
    missing_knees, wide_to_long_outcomes, knee_labels, participant_labels, contralateral_exclusion, duplicate_outcomes, logistic_cv,
    logistic_cv_summary, coefficient_topn, classifier_report,
)}

from kymora.queries.study_sql import ORACLES  # noqa: E402,F401
