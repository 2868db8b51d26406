"""SQL twins of the study queries."""

from kymora.queries.common import IRR, SIG, r

AUD = """aud AS (SELECT o_orderkey AS id, o_custkey AS study_id, 'HP_W11.2-' || o_custkey || '-' || strftime(o_orderdate, '%Y%m%d') || '_' ||
    lpad(CAST(o_orderkey % 86400 % 24 * 10000 AS VARCHAR), 6, '0') || '.bin' AS audio_file_name, CASE WHEN o_orderkey % 2 = 0 THEN 'left' ELSE 'right' END AS knee,
    CASE o_orderstatus WHEN 'F' THEN 'walk' WHEN 'O' THEN 'sts' ELSE 'fe' END AS maneuver, CASE WHEN o_orderkey % 3 > 0 THEN o_orderkey END AS biomechanics_import_id,
    o_totalprice AS file_size_mb, o_orderdate AS recording_date, o_orderpriority <> '5-LOW' AS is_active FROM orders)"""
MOT = f"""{AUD}, mot AS (SELECT id, study_id, 'AOA' || (study_id + 1000) || '_' || id AS biomechanics_file, CASE WHEN id % 5 = 0 THEN 'Gonio' ELSE 'Motion Analysis' END AS biomechanics_type,
    knee, maneuver, file_size_mb AS duration_seconds, id % 7 AS num_data_points, CAST(id % 4 AS INTEGER) AS pass_number, is_active FROM aud)"""
SYN = """syn AS (SELECT l_orderkey * 10 + l_linenumber AS id, study_id, knee, maneuver, CASE WHEN maneuver = 'walk' THEN l_linenumber END AS pass_number,
    CASE WHEN maneuver = 'walk' THEN CASE flag WHEN 'A' THEN 'slow' WHEN 'N' THEN 'medium' ELSE 'fast' END END AS speed, l_orderkey AS audio_processing_id,
    'sync_' || (l_orderkey % 5000) AS sync_file_name, q AS sync_duration, st = 'F' AS is_active
    FROM (SELECT l_orderkey, l_linenumber, min(l_quantity) AS q, min(l_returnflag) AS flag, min(l_linestatus) AS st FROM lineitem GROUP BY 1, 2) JOIN aud ON aud.id = l_orderkey)"""
CYC = """cyc AS (SELECT l_orderkey * 1000000 + l_linenumber * 100000 + l_partkey AS id, study_id, knee, maneuver, l_orderkey AS audio_processing_id,
    CASE WHEN l_linenumber < 7 THEN l_orderkey * 10 + l_linenumber END AS synchronization_id, CAST(l_partkey AS INTEGER) AS cycle_index, q AS start_time_s, q + p / 997 AS end_time_s,
    p / 997 AS duration, d > 0.07 AS is_outlier, d < 0.09 AS is_active
    FROM (SELECT l_orderkey, l_linenumber, l_partkey, sum(l_quantity) AS q, max(l_extendedprice) AS p, min(l_discount) AS d FROM lineitem GROUP BY 1, 2, 3) JOIN aud ON aud.id = l_orderkey)"""
STU = """stu AS (SELECT c_custkey AS id, CASE c_nationkey % 3 WHEN 0 THEN 'AOA' WHEN 1 THEN 'preOA' ELSE 'SMoCK' END AS study_name, c_custkey + 1000 AS study_participant_id FROM customer)"""
MARK = f"""{IRR}, mk AS (SELECT recording_id, i, t, CASE event WHEN 'error' THEN 'Fast Speed' WHEN 'signup' THEN 'Slow Speed' WHEN 'click' THEN 'Pass ' || (i // 4 + 1) || ' Start' ELSE 'Pass ' || (i // 4 + 1) || ' End' END AS event FROM irr)"""
SHEET = """sheet AS (SELECT CASE WHEN k % 2 = 0 THEN ' aoa' ELSE '' END || (k % 9000 + 1000) AS sid, CAST(k % 9000 + 1000 AS INTEGER) AS study_id, k, c_acctbal AS bmi FROM (SELECT c_custkey AS k, c_acctbal FROM customer))"""
_VOLT = "(CASE WHEN {c} >= 32768 THEN {c} - 65536 ELSE {c} END) * 2.0::DOUBLE * 4.5 * sqrt(2) / 65536 + 1.5"


def _rules(source: str, key: str, rules: dict[str, str]) -> str:
    return " UNION ALL ".join(f"SELECT {key}, '{name}' AS rule FROM {source} WHERE {cond}" for name, cond in rules.items())


ORACLES = {
    "decode_dump": f"""WITH {SIG}, c AS (SELECT recording_id AS file, i, {', '.join(f'CAST(round({x} * 10000) AS BIGINT) % 65536 AS {x}' for x in ('ch1', 'ch2', 'ch3', 'ch4'))} FROM sig)
      SELECT file, i, {', '.join(r(_VOLT.format(c=x), x) for x in ('ch1', 'ch2', 'ch3', 'ch4'))},
      {r('i / 46875.0::DOUBLE + file + 1 - 2752 / 46875.0::DOUBLE', 't')} FROM c""",
    "unwrap_counter": f"WITH {IRR} SELECT recording_id AS file, i, i * 100000000 + 1 AS unwrapped, {r('(i * 100000000 + 1) / 4096.0::DOUBLE', 'seconds')} FROM irr",
    "file_name_parse": f"WITH {AUD} SELECT id, CASE WHEN year(recording_date) >= 2000 THEN CAST(study_id AS VARCHAR) END AS device_serial, CASE WHEN year(recording_date) >= 2000 THEN CAST(recording_date + INTERVAL 1 HOUR * (id % 86400 % 24) AS TIMESTAMP) END AS recorded_at FROM aud",
    "uid_parse": """WITH u AS (SELECT o_orderkey, o_custkey, o_orderkey % 4 AS k, o_custkey % 4 AS c FROM orders), v AS (SELECT o_orderkey,
      'AOA' || (o_custkey + 1000) || '_' || (['Walk0001', 'SitToStand0001', 'FlexExt0001', 'Hop0001'])[k + 1] || '_' || (['SSP', 'NSP', 'FSP', 'XSP'])[c + 1] || (o_orderkey % 9 + 1) || '_Filt' AS uid,
      'AOA' AS study, CAST(o_custkey + 1000 AS INTEGER) AS study_id, (['walk', 'sit_to_stand', 'flexion_extension', NULL])[k + 1] AS maneuver,
      CASE WHEN k = 0 THEN CAST(o_orderkey % 9 + 1 AS INTEGER) END AS pass_number, CASE WHEN k = 0 THEN (['slow', 'normal', 'fast', NULL])[c + 1] END AS speed, k, c FROM u)
      SELECT o_orderkey, uid, study, study_id, maneuver, pass_number, speed, CASE WHEN k = 3 THEN 'unknown_maneuver' WHEN k = 0 AND c = 3 THEN 'unknown_speed' END AS problem FROM v""",
    "loose_times": f"SELECT event_id, {r('CASE event_id % 4 WHEN 0 THEN value WHEN 1 THEN floor(value) WHEN 2 THEN 172800 + 3600 + floor(value) END', 'seconds')} FROM events",
    "event_lookup": f"""WITH {MARK} SELECT recording_id, {r("min(t) FILTER (WHERE event = 'Slow Speed')", 'slow')}, {r("min(t) FILTER (WHERE event = 'Pass 2 Start')", 'pass_2_start')},
      {r("min(t) FILTER (WHERE event = 'Pass 3 End')", 'pass_3_end')} FROM mk GROUP BY 1""",
    "missing_markers": f"""WITH {MARK}, g AS (SELECT recording_id, bool_or(event = 'Pass 1 Start') AS a, bool_or(event = 'Pass 9 End') AS b FROM mk GROUP BY 1)
      SELECT recording_id, 'pass_1' AS missing_event FROM g WHERE NOT a UNION ALL SELECT recording_id, 'pass_9' FROM g WHERE NOT b""",
    "motion_import": f"""WITH {IRR}, s AS (SELECT recording_id, min(t) FILTER (WHERE event = 'click') AS s, min(t) AS t0 FROM irr GROUP BY 1)
      SELECT recording_id, 'AOA' || (recording_id + 1000) || '_Walk0001_NSP1_Filt' AS uid, 'walk' AS maneuver, 'normal' AS speed, 1 AS pass_number, i, {r('t - t0 + s', 't')}, {r('v', 'left_x')}, {r('v * 2', 'right_z')}
      FROM irr JOIN s USING (recording_id) WHERE s IS NOT NULL""",
    "fill_down": f"WITH {IRR} SELECT recording_id, i, last_value(CASE WHEN event = 'purchase' THEN event_id END IGNORE NULLS) OVER (PARTITION BY recording_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS label FROM irr",
    "mic_positions": "SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN 'IP' ELSE 'SP' END || CASE WHEN p_partkey % 2 = 0 THEN 'M' ELSE 'L' END AS position, p_size AS pass_number FROM part",
    "legend_reconcile": """SELECT p_partkey // 4 AS recording_id, CASE WHEN (p_partkey // 4) % 2 = 0 THEN 'left' ELSE 'right' END AS knee, 'walk' AS maneuver,
      'mic_' || (p_partkey % 4 + 1) || '_patellar_position' AS field, CASE WHEN p_size % 2 = 0 THEN 'Infrapatellar' ELSE 'Suprapatellar' END AS primary_value,
      CASE WHEN p_size % 3 = 0 THEN 'Infrapatellar' ELSE 'Suprapatellar' END AS fallback_value FROM part WHERE (p_partkey // 4) % 5 > 0 AND (p_size % 2 = 0) <> (p_size % 3 = 0)""",
    "legend_chosen": """SELECT p_partkey // 4 AS recording_id, CASE WHEN (p_partkey // 4) % 2 = 0 THEN 'left' ELSE 'right' END AS knee, 'walk' AS maneuver,
      CAST(p_partkey % 4 + 1 AS INTEGER) AS mic, 'f' || (p_partkey // 4) AS file_name,
      CASE WHEN p_size % (CASE WHEN (p_partkey // 4) % 5 > 0 THEN 2 ELSE 3 END) = 0 THEN 'Infrapatellar' ELSE 'Suprapatellar' END AS patellar, 'Medial' AS laterality FROM part""",
    "completeness_audit": f"""WITH {AUD} SELECT c_custkey AS participant, k.knee, m.maneuver FROM customer, (VALUES ('left'), ('right')) k(knee), (VALUES ('fe'), ('sts'), ('walk')) m(maneuver)
      WHERE NOT EXISTS (SELECT 1 FROM aud WHERE study_id = c_custkey AND aud.knee = k.knee AND aud.maneuver = m.maneuver)""",
    "scope_selection": f"""WITH {AUD}, f AS (SELECT * FROM aud WHERE knee = 'left' AND maneuver IN ('walk', 'sts'))
      SELECT id, study_id AS participant, knee, maneuver FROM f WHERE study_id IN (SELECT DISTINCT study_id FROM f ORDER BY study_id LIMIT 50)""",
    "committed_rows": f"WITH {AUD} SELECT id, study_id FROM aud WHERE study_id NOT IN (SELECT study_id FROM aud WHERE file_size_mb >= 450000)",
    "processed_participants": f"WITH {AUD} SELECT study_id AS participant FROM aud WHERE maneuver = 'walk' GROUP BY 1 HAVING count(DISTINCT knee) = 2",
    "rule_violations": f"WITH {AUD} " + _rules("aud", "id", {
        "study_id_negative": "study_id - 5 < 0", "motion_id_not_positive": "biomechanics_import_id - 3 <= 0", "time_not_on_recording_date": "id % 50 = 0",
        "sample_rate_not_positive": "id % 40 - 1 <= 0", "num_channels_not_1_to_4": "id % 6 NOT IN (1, 2, 3, 4)", "file_size_negative": "file_size_mb - 1500 < 0",
        "firmware_negative": "id % 30 - 1 < 0", "duration_negative": "id % 2 = 0 AND id % 10 - 1 < 0"}),
    "motion_violations": f"WITH {AUD} " + _rules("aud", "id", {
        "audio_id_not_positive": "id <= 0", "walk_without_pass": "maneuver = 'walk' AND id % 3 = 0", "pass_not_positive": "maneuver = 'walk' AND id % 3 > 0 AND id % 4 = 0",
        "pass_on_other_maneuver": "maneuver <> 'walk' AND id % 3 > 0", "walk_without_speed": "maneuver = 'walk' AND id % 5 = 0",
        "speed_on_other_maneuver": "maneuver <> 'walk' AND id % 5 > 0", "rate_not_positive": "id % 9 - 1 <= 0", "count_negative": "id % 11 = 0"}),
    "sync_violations": f"WITH {AUD}, {SYN} " + _rules("syn", "id", {
        "id_not_positive": "audio_processing_id <= 0 OR id <= 0", "motion_method_without_time": "id % 2 = 0 AND id % 5 = 0", "motion_method_without_contra": "id % 2 = 0 AND id % 7 = 0",
        "audio_method_without_time": "id % 2 = 1 AND id % 3 = 0 AND id % 11 = 0", "audio_method_without_contra": "id % 2 = 1 AND id % 3 = 0 AND id % 13 = 0",
        "both_sides_without_offset": "id % 2 > 0 AND id % 3 > 0 AND id % 5 = 0"}),
    "cycle_violations": f"WITH {AUD}, {CYC} " + _rules("cyc", "id", {
        "audio_id_not_positive": "audio_processing_id <= 0", "sync_id_not_positive": "synchronization_id <= 0", "cycle_index_negative": "cycle_index - 10 < 0",
        "time_negative": "start_time_s - 2 < 0 OR end_time_s < 0 OR duration < 0", "pass_and_speed_not_together": "(cycle_index % 3 = 0) <> (cycle_index % 4 = 0)"}),
    "domain_violations": "SELECT o_orderkey AS id, 'maneuver_unknown' AS rule FROM orders WHERE o_orderstatus NOT IN ('F', 'O')",
    "key_uniqueness": f"WITH {AUD}, {SYN} SELECT study_id, knee, maneuver, pass_number, speed, count(*) AS n FROM syn GROUP BY ALL HAVING count(*) > 1",
    "orphan_records": f"WITH {AUD}, {SYN}, {CYC} SELECT id, synchronization_id FROM cyc WHERE synchronization_id IS NOT NULL AND synchronization_id NOT IN (SELECT id FROM syn WHERE sync_duration > 5)",
    "outdated_records": "SELECT o_orderkey AS id, CAST(o_orderkey % 3 AS INTEGER) AS audio_qc_version FROM orders WHERE o_orderkey % 3 < 2",
    "upsert_snapshot": f"""WITH {AUD}, {SYN}, o AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY study_id, knee, maneuver, pass_number, speed ORDER BY id DESC) AS rn FROM syn WHERE id % 3 > 0) WHERE rn = 1),
      n AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY study_id, knee, maneuver, pass_number, speed ORDER BY id DESC) AS rn FROM syn WHERE id % 3 < 2) WHERE rn = 1),
      m AS (SELECT coalesce(o.study_id, n.study_id) AS study_id, coalesce(o.knee, n.knee) AS knee, coalesce(o.maneuver, n.maneuver) AS maneuver, coalesce(o.pass_number, n.pass_number) AS pass_number,
        coalesce(o.speed, n.speed) AS speed, o.id, n.id IS NOT NULL OR o.is_active AS is_active, CASE WHEN n.id IS NOT NULL THEN n.sync_duration + 0.5 ELSE o.sync_duration END AS sync_duration,
        coalesce(CASE WHEN n.id % 2 = 0 THEN n.sync_file_name END, o.sync_file_name) AS sync_file_name
        FROM o FULL JOIN n ON o.study_id = n.study_id AND o.knee = n.knee AND o.maneuver = n.maneuver AND o.pass_number IS NOT DISTINCT FROM n.pass_number AND o.speed IS NOT DISTINCT FROM n.speed)
      SELECT study_id, knee, maneuver, pass_number, speed, CASE WHEN id IS NOT NULL THEN id ELSE (SELECT max(id) FROM o) + row_number() OVER (PARTITION BY id IS NULL
        ORDER BY study_id, knee, maneuver, pass_number NULLS FIRST, speed NULLS FIRST) END AS id, is_active, {r('sync_duration', 'sync_duration')}, sync_file_name FROM m""",
    "soft_delete": f"WITH {AUD}, s AS (SELECT DISTINCT study_id FROM aud WHERE study_id % 4 = 0) SELECT id, study_id, knee, maneuver, is_active AND NOT (study_id % 4 = 0 AND id % 3 > 0) AS is_active FROM aud",
    "soft_delete_counts": f"WITH {AUD} SELECT 'audio_processing' AS \"table\", count(*) AS n FROM aud WHERE is_active AND study_id % 4 = 0 AND id % 3 > 0",
    "get_or_create": f"""WITH {STU} SELECT CASE WHEN id % 2 = 0 THEN id + 1 ELSE (SELECT max(id) + 1 FROM stu WHERE id % 2 = 0) + row_number() OVER (PARTITION BY id % 2 ORDER BY study_name, study_participant_id) END AS id,
      study_name, study_participant_id FROM stu""",
    "link_motion": f"""WITH {MOT}, b AS (SELECT study_id, knee, maneuver, max(id) AS m FROM mot WHERE is_active GROUP BY ALL)
      SELECT id, coalesce(m, biomechanics_import_id) AS biomechanics_import_id FROM aud LEFT JOIN b USING (study_id, knee, maneuver)""",
    "filtered_read": f"WITH {AUD}, {STU} SELECT aud.id, study_participant_id FROM aud JOIN stu ON stu.id = study_id WHERE study_name = 'AOA' AND maneuver = 'walk' AND knee = 'left' AND is_active",
    "parent_lookup": f"""WITH {AUD}, {SYN}, p AS (SELECT study_id, knee, maneuver, max_by(id, (CAST(is_active AS INTEGER), id)) AS parent_id FROM aud GROUP BY ALL)
      SELECT syn.id, parent_id FROM syn LEFT JOIN p USING (study_id, knee, maneuver)""",
    "reshaped_history": f"WITH {STU} SELECT id, study_name, study_participant_id, CASE WHEN id % 2 = 1 THEN 'new' END AS note FROM stu",
    "report_audio": f"""WITH {MOT} SELECT aud.id, study_id + 1000 AS participant_id, aud.knee, aud.maneuver, replace(audio_file_name, '.bin', '') AS audio_file_name,
      CAST(recording_date + INTERVAL 1 HOUR * CASE WHEN year(recording_date) >= 2000 THEN aud.id % 86400 % 24 ELSE 0 END AS TIMESTAMP) AS recording_datetime, mot.biomechanics_file AS linked_biomechanics_file, mot.biomechanics_type AS linked_biomechanics_type
      FROM aud LEFT JOIN (SELECT id, biomechanics_file, biomechanics_type FROM mot) mot ON mot.id = biomechanics_import_id WHERE aud.is_active""",
    "report_motion": f"WITH {MOT} SELECT id, study_id + 1000 AS participant_id, knee, maneuver, biomechanics_file FROM mot WHERE is_active",
    "report_sync": f"WITH {AUD}, {SYN} SELECT syn.id, syn.study_id + 1000 AS participant_id, pass_number, speed, audio_file_name FROM syn JOIN aud ON aud.id = audio_processing_id WHERE aud.is_active AND syn.is_active",
    "report_cycles": f"""WITH {AUD}, {SYN}, {CYC} SELECT cyc.id, cyc.study_id + 1000 AS participant_id, pass_number, speed, cycle_index, audio_file_name, {r('start_time_s', 'start_time_s')}, is_outlier
      FROM cyc JOIN aud ON aud.id = cyc.audio_processing_id LEFT JOIN syn ON syn.id = synchronization_id WHERE cyc.is_active AND aud.is_active""",
    "report_summary": f"""WITH {MOT}, {SYN}, {CYC}, l AS (SELECT study_id, knee, maneuver, 'Audio Records' AS metric, count(DISTINCT audio_file_name) AS value FROM aud WHERE is_active GROUP BY ALL
      UNION ALL SELECT study_id, knee, maneuver, 'Biomechanics Records', count(DISTINCT biomechanics_file) FROM mot WHERE is_active GROUP BY ALL
      UNION ALL SELECT syn.study_id, syn.knee, syn.maneuver, 'Synchronization Records', count(DISTINCT sync_file_name) FROM syn JOIN aud ON aud.id = audio_processing_id WHERE aud.is_active AND syn.is_active GROUP BY ALL
      UNION ALL SELECT cyc.study_id, cyc.knee, cyc.maneuver, 'Movement Cycles', count(*) FROM cyc JOIN aud ON aud.id = audio_processing_id WHERE aud.is_active AND cyc.is_active GROUP BY ALL),
      e AS (SELECT DISTINCT study_id, knee, maneuver, m.metric FROM l, (VALUES ('Audio Records'), ('Biomechanics Records'), ('Synchronization Records'), ('Movement Cycles')) m(metric))
      SELECT study_id + 1000 AS participant_id, study_id, knee, maneuver, metric, coalesce(value, 0) AS value FROM e LEFT JOIN l USING (study_id, knee, maneuver, metric)""",
    "knee_summary": f"""WITH {AUD}, {SYN}, c AS (SELECT study_id, knee, maneuver, count(*) AS n FROM syn WHERE maneuver <> 'fe' GROUP BY ALL)
      SELECT e.study_id, e.knee, m.maneuver, coalesce(n, 0) AS n_sync FROM (SELECT DISTINCT study_id, knee FROM c) e CROSS JOIN (VALUES ('fe'), ('sts'), ('walk')) m(maneuver)
      LEFT JOIN c ON c.study_id = e.study_id AND c.knee = e.knee AND c.maneuver = m.maneuver""",
    "motion_statistics": f"WITH {MOT} SELECT study_id, knee, CAST(sum(num_data_points) AS BIGINT) AS num_data_points, {r('max(duration_seconds)', 'duration_seconds')}, count(DISTINCT pass_number) AS num_passes FROM mot GROUP BY 1, 2",
    "recording_duration": f"WITH {IRR} SELECT recording_id, {r('max(t) - min(t)', 'duration_seconds')} FROM irr GROUP BY 1",
    "distinct_by_key": f"WITH {AUD}, {SYN} SELECT sync_file_name, min(id) AS id, arg_min(knee, id) AS knee FROM syn WHERE id % 10 > 0 GROUP BY 1",
    "demographics": f"""WITH {SHEET} SELECT study_id, {r('CASE WHEN k % 7 > 0 THEN k % 90 END', 'age')}, {r('bmi', 'bmi')}, CASE WHEN k % 2 = 0 THEN 'M' ELSE 'F' END AS gender, CASE k % 3 WHEN 0 THEN true WHEN 1 THEN false END AS knee_pain FROM sheet""",
    "varus_thrust": f"WITH {SHEET} SELECT study_id, k % 5 = 0 AS varus_thrust_right, CASE k % 4 WHEN 0 THEN true WHEN 1 THEN false END AS varus_thrust_left FROM sheet",
    "kl_grades": """SELECT CAST(o_custkey % 9000 + 1000 AS INTEGER) AS study_id, CAST(max(CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey % 5 END) AS INTEGER) AS kl_tfm_grade_left,
      CAST(max(CASE WHEN o_orderkey % 2 = 1 THEN o_orderkey % 5 END) AS INTEGER) AS kl_tfm_grade_right FROM orders GROUP BY 1""",
    "missing_knees": """WITH h AS (SELECT DISTINCT CAST(o_custkey % 9000 + 1000 AS INTEGER) AS study_id, CASE o_orderstatus WHEN 'F' THEN 'TFM' ELSE 'PFM' END AS sheet, CASE WHEN o_orderkey % 2 = 0 THEN 'left' ELSE 'right' END AS knee
      FROM orders WHERE o_orderstatus IN ('F', 'O')) SELECT i.study_id, s.sheet, k.knee FROM (SELECT DISTINCT study_id FROM h) i, (VALUES ('TFM'), ('PFM')) s(sheet), (VALUES ('left'), ('right')) k(knee)
      WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.study_id = i.study_id AND h.sheet = s.sheet AND h.knee = k.knee)""",
    "wide_to_long_outcomes": f"""WITH {SHEET} SELECT CAST(study_id AS VARCHAR) AS study_id, 'R' AS knee, {r('CASE WHEN k % 5 = 0 THEN 1 ELSE 0 END', 'outcome')} FROM sheet
      UNION ALL SELECT CAST(study_id AS VARCHAR), 'L', {r('CASE k % 4 WHEN 0 THEN 1 WHEN 1 THEN 0 ELSE 2.5 END', 'outcome')} FROM sheet""",
    "knee_labels": f"""WITH {AUD}, {CYC}, y AS (SELECT study_id, knee, CASE WHEN max(file_size_mb) > 400000 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label FROM aud GROUP BY 1, 2)
      SELECT label, count(*) AS n FROM cyc JOIN y USING (study_id, knee) GROUP BY 1""",
    "participant_labels": f"""WITH {AUD}, {CYC} SELECT study_id, {r('avg(duration)', 'duration')}, {r('avg(start_time_s)', 'start_time_s')}, CASE WHEN min(c_acctbal) > 3000 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label
      FROM cyc JOIN customer ON c_custkey = study_id GROUP BY 1""",
    "contralateral_exclusion": f"""WITH {AUD}, a AS (SELECT id, study_id, CASE knee WHEN 'left' THEN 'L' ELSE 'R' END AS knee FROM aud)
      SELECT id, study_id, knee FROM a WHERE id % 5 > 0 AND NOT EXISTS (SELECT 1 FROM a t WHERE t.id % 5 = 0 AND t.study_id = a.study_id AND t.knee <> a.knee)""",
    "duplicate_outcomes": f"WITH {AUD} SELECT study_id, knee, count(*) AS n FROM aud GROUP BY 1, 2 HAVING count(*) > 1",
}
