"""Queries over long series and whole runs, each with its SQL twin."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kymora.functions import kernels as kn
from kymora.operators import cycles as cy
from kymora.operators import segments as sg
from kymora.operators import tables as tb
from kymora.plans import persist as ps
from kymora.plans.pipeline import StageStore
from kymora.queries import alignment, cycles, samples
from kymora.queries.common import IRR, SIG, merged, peaks, r, rounded
from kymora.queries.study_sql import AUD
from kymora.session import checkpoint_dir
from kymora.sources import adapters as ad
from kymora.sources import frames as fr

K = ["recording_id"]
CK = ["recording_id", "cycle_index"]


def cadence_groups(spark: SparkSession, sf: str) -> DataFrame:
    """Line items read as passes of a supplier's recording, grouped by cadence."""
    li = ad.table(spark, sf, "lineitem")
    d = lambda c: F.col(c).cast("double")
    passes = li.select(
        F.col("l_suppkey").alias("recording_id"), (0.5 + d("l_quantity") / 20).alias("gait_cycle_hz"), d("l_discount").alias("coverage_frac"), d("l_tax").alias("bandpower_ratio"),
        d("l_linenumber").alias("start"), (d("l_linenumber") + d("l_quantity")).alias("end"), F.col("l_linenumber").alias("heel_strike_count"), (F.col("l_returnflag") != "R").alias("passed"))
    return rounded(sg.speed_groups(passes, K))


def template_best(spark: SparkSession, sf: str) -> DataFrame:
    """The template of the least warped distance of each cycle that has a hit."""
    hits = cy.template_match(cycles._blocks(spark, sf), cycles._templates(spark, sf), CK, "ch2", 64, 0.1, 0.8)
    return rounded(cy.best_template(hits, CK))


def template_work(spark: SparkSession, sf: str) -> DataFrame:
    """For how many templates of each cycle r suffices, and for how many the warped distance is computed."""
    return cy.template_match(cycles._blocks(spark, sf), cycles._templates(spark, sf), CK, "ch2", 64, 0.1, 0.8, work=True)


def stored_frames(spark: SparkSession, sf: str) -> DataFrame:
    """The signal stored in many files and read back, summed by recording; every fifth recording by a pruned read."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/frames-{uuid.uuid4().hex}"
    s = ad.signal_multi(spark, sf)
    held = fr.write_frames(s, path, rows_per_file=2000)
    fifth = s.select("recording_id").filter("recording_id % 5 = 0")
    n_files = held.count()
    def told(df: DataFrame, how: str) -> DataFrame:
        return df.groupBy("recording_id").agg(F.lit(how).alias("read"), F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in ad.CHANNELS], F.max("t").alias("t"))
    both = told(fr.read_frames(spark, path), "all").unionByName(told(fr.read_frames(spark, path, fifth), "some"))
    return rounded(both.withColumn("many_files", F.lit(n_files > 1)))


def stored_spectrogram(spark: SparkSession, sf: str) -> DataFrame:
    """Spectrograms of one channel written to stored frames and read back."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/spectra-{uuid.uuid4().hex}"
    fr.write_spectrograms(ad.signal_multi(spark, sf), path, ["ch2"], K, ad.SIGNAL_FS, 32, 24, rows_per_file=2000)
    bins = fr.read_frames(spark, path).select("recording_id", "frame", "t", F.posexplode("db").alias("bin", "db"))
    return rounded(bins.withColumn("db", F.col("db").cast("double")), 2)


# ---- publication of runs --------------------------------------------------------------------------

# number, rows of the run, recordings that succeed
RUNS = ((1, "id % 3 > 0", "size < 450000"), (2, "study_id % 2 = 0 AND id % 5 > 0", "size < 400000"), (3, "study_id % 2 = 1 AND id % 4 > 0", "size < 480000"))


def _lay(store: StageStore, rows: DataFrame, number: int, good: str) -> DataFrame:
    """Stage tables as a pipeline run over ``rows`` leaves them; the recordings of the run."""
    live = rows.filter(good)
    store.write("sync_status", rows.select("recording_id", F.expr(good).alias("ok")))
    store.write("sync_record", live.select("recording_id", (F.col("id") % 10 + number).cast("double").alias("audio_stomp"), F.lit(2.0).alias("motion_stomp"), (F.col("size") / 1000).alias("motion_duration")))
    kind = F.element_at(F.array(F.lit("dropout"), F.lit("spike"), F.lit("continuous")), (F.col("id") % 3 + 1).cast("int"))
    store.write("artifact_interval", rows.filter("id % 2 = 0").select("recording_id", kind.alias("kind"), F.lit("ch1").alias("channel"), F.lit(0.0).alias("start"), (F.col("id") % 7 + number).cast("double").alias("end")))
    store.write("cycle", live.select("recording_id", F.explode(F.sequence(F.lit(0), (F.col("id") % 3).cast("int"))).alias("cycle_index"), ((F.col("id") + number) % 2 == 0).alias("is_outlier")))
    return rows.withColumnRenamed("size", "file_size_mb")


def published_runs(spark: SparkSession, sf: str) -> DataFrame:
    """All records after three runs, of which the last two go on at once, participants with a failure left out.

    The third run publishes before the second, which began first.
    """
    a = ad.audio_table(spark, sf)
    walk = F.col("maneuver") == "walk"
    rows = a.select(
        F.col("id").alias("recording_id"), "id", "study_id", "audio_file_name", "knee", "maneuver", F.when(walk, (F.col("id") % 4).cast("int")).alias("pass_number"),
        F.when(walk, F.lit("slow")).alias("speed"), F.concat(F.lit("AOA"), F.col("study_id").cast("string"), F.lit("_"), (F.col("id") % 3).cast("string")).alias("biomechanics_file"),
        F.col("file_size_mb").cast("double").alias("size"))
    root = f"{checkpoint_dir(spark).rstrip('/')}/published-{uuid.uuid4().hex}"
    one, two, three = (StageStore(spark, root) for _ in RUNS)
    laid = {}
    for store, (number, chosen, good) in zip((one, two, three), RUNS):
        store.begin()
        laid[number] = _lay(store, rows.filter(chosen), number, good)
        if number == 1:
            ps.save_run(one, laid[1])
    ps.save_run(three, laid[3])
    ps.save_run(two, laid[2])
    out = None
    for name, (label, value, parent) in SHOWN.items():
        t = one.read(name)
        own = [c for c in ps.KEYS[name] if c in t.columns]
        flat = t.select(
            F.lit(name).alias("table"), *[(F.col(c) if c in own else F.lit(None)).cast(kind).alias(c) for c, kind in KEY_KINDS.items()],
            F.col(label).cast("string").alias("label"), "id", "is_active", F.col(value).cast("double").alias("value"), F.col(parent).alias("parent"))
        out = flat if out is None else out.unionByName(flat)
    return rounded(out)


KEY_KINDS = {"study_id": "long", "knee": "string", "maneuver": "string", "pass_number": "int", "speed": "string", "cycle_index": "int"}
# the further key or text, a value and the parent's id that the query shows of each table
SHOWN = {
    "meta_audio": ("audio_file_name", "file_size_mb", "biomechanics_import_id"), "meta_motion": ("biomechanics_file", "duration_seconds", "audio_processing_id"),
    "meta_sync": ("sync_file_name", "audio_stomp", "audio_processing_id"), "meta_cycle": ("is_outlier", "is_outlier", "synchronization_id"),
}

QUERIES = {f.__name__: f for f in (cadence_groups, template_best, template_work, stored_frames, stored_spectrogram, published_runs)}


def _same(a: str, b: str, key: tuple) -> str:
    return " AND ".join(f"{a}.{k} IS NOT DISTINCT FROM {b}.{k}" for k in key)


def _snapshot(table: str, number: int, before: int | None, values: str, incoming: str) -> str:
    """CTE of a table's next snapshot: upsert by key, ids in key order, other active rows of the scopes switched off."""
    key = ps.KEYS[f"meta_{table}"]
    names = [v.strip() for v in values.split(",")]
    listed, now = ", ".join(key), f"{table}{number}"
    one = f"{now}i AS (SELECT * EXCLUDE (rn, recording_id) FROM (SELECT *, row_number() OVER (PARTITION BY {listed} ORDER BY recording_id DESC) AS rn FROM ({incoming})) WHERE rn = 1)"
    old = f"{table}{before}" if before else f"(SELECT {listed}, {values}, 0::BIGINT AS id, false AS is_active FROM {now}i WHERE false)"
    own = ", ".join(f"CASE WHEN n.hit THEN n.{k} ELSE o.{k} END AS {k}" for k in key)
    vals = ", ".join(f"CASE WHEN n.hit THEN n.{v} ELSE o.{v} END AS {v}" for v in names)
    scope = f"(CASE WHEN n.hit THEN n.study_id ELSE o.study_id END, CASE WHEN n.hit THEN n.knee ELSE o.knee END, CASE WHEN n.hit THEN n.maneuver ELSE o.maneuver END) IN (SELECT (study_id, knee, maneuver) FROM good{number})"
    order = ", ".join(f"{k} NULLS FIRST" for k in key)
    return f"""{one}, {now}m AS (SELECT {own}, {vals}, o.id AS old_id, CASE WHEN n.hit THEN true WHEN {scope} THEN false ELSE o.is_active END AS is_active
        FROM (SELECT *, true AS was FROM {old}) o FULL JOIN (SELECT *, true AS hit FROM {now}i) n ON {_same('o', 'n', key)}),
      {now} AS (SELECT {listed}, {values}, is_active, coalesce(old_id, (SELECT coalesce(max(old_id), 0) FROM {now}m) + row_number() OVER (PARTITION BY old_id IS NULL ORDER BY {order})) AS id FROM {now}m)"""


def _run(number: int, before: int | None, chosen: str, good: str) -> str:
    """CTEs of one run: its whole participants, and the next snapshots of the four tables."""
    n, parts = number, []
    parts.append(f"good{n} AS (SELECT * FROM rec WHERE {chosen} AND study_id NOT IN (SELECT study_id FROM rec WHERE {chosen} AND NOT ({good})))")
    parts.append(_snapshot("audio", n, before, "file_size_mb, imp", f"SELECT id AS recording_id, study_id, audio_file_name, knee, maneuver, size AS file_size_mb, {'NULL::BIGINT' if not before else 'p.imp'} AS imp FROM good{n}"
                           + (f" g LEFT JOIN (SELECT {', '.join(f'{k} AS k_{k}' for k in tb.AUDIO_KEY)}, imp FROM audio{before}) p ON {' AND '.join(f'g.{k} = p.k_{k}' for k in tb.AUDIO_KEY)}" if before else "")))
    named = f"(SELECT g.*, x.id AS audio_id FROM good{n} g JOIN audio{n} x ON {_same('g', 'x', tb.AUDIO_KEY)})"
    parts.append(_snapshot("motion", n, before, "duration_seconds, audio_id", f"SELECT id AS recording_id, study_id, biomechanics_file, knee, maneuver, CASE WHEN {good} THEN size / 1000 END AS duration_seconds, audio_id FROM {named}"))
    sync = ", ".join(tb.SYNC_KEY)
    parts.append(_snapshot("sync", n, before, "sync_file_name, audio_stomp, audio_id", f"""SELECT id AS recording_id, {sync}, concat_ws('_', audio_file_name, 'synced', CAST(pass_number AS VARCHAR), speed) AS sync_file_name,
        CAST(id % 10 + {n} AS DOUBLE) AS audio_stomp, audio_id FROM {named}"""))
    parts.append(_snapshot("cycle", n, before, "is_outlier, sync_id", f"""SELECT g.recording_id, {', '.join(f'g.{k}' for k in tb.SYNC_KEY)}, CAST(c AS INTEGER) AS cycle_index, (g.recording_id + {n}) % 2 = 0 AS is_outlier, s.id AS sync_id
        FROM (SELECT id AS recording_id, * FROM good{n}) g JOIN sync{n} s ON {_same('g', 's', tb.SYNC_KEY)}, range(0, 3) q(c) WHERE c <= g.recording_id % 3"""))
    # the newest active import of the same study, knee and maneuver
    parts.append(f"""audio{n}x AS (SELECT a.* EXCLUDE (imp), coalesce(m.top, a.imp) AS imp FROM audio{n} a LEFT JOIN (SELECT study_id, knee, maneuver, max(id) AS top FROM motion{n} WHERE is_active GROUP BY ALL) m USING (study_id, knee, maneuver))""")
    return ", ".join(parts)


def _published() -> str:
    null = {k: f"CAST(NULL AS {'BIGINT' if t == 'long' else 'INTEGER' if t == 'int' else 'VARCHAR'})" for k, t in KEY_KINDS.items()}
    runs, before = [], None
    for number in (1, 3, 2):  # in the order of publication
        _, chosen, good = RUNS[number - 1]
        text = _run(number, before, chosen, good)
        runs.append(text.replace(f"audio{before}", f"audio{before}x") if before else text)
        before = number
    shown = {"audio": ("audio2x", "audio_file_name", "file_size_mb", "imp"), "motion": ("motion2", "biomechanics_file", "duration_seconds", "audio_id"),
             "sync": ("sync2", "sync_file_name", "audio_stomp", "audio_id"), "cycle": ("cycle2", "CAST(is_outlier AS VARCHAR)", "CAST(is_outlier AS INTEGER)", "sync_id")}
    out = " UNION ALL ".join(
        f"""SELECT 'meta_{name}' AS "table", {', '.join(f'{k if k in ps.KEYS[f"meta_{name}"] else null[k]} AS {k}' for k in KEY_KINDS)}, {label} AS label, id, is_active, {r(value, 'value')}, {parent} AS parent FROM {source}"""
        for name, (source, label, value, parent) in shown.items())
    return f"""WITH {AUD}, rec AS (SELECT id, study_id, audio_file_name, knee, maneuver, CASE WHEN maneuver = 'walk' THEN CAST(id % 4 AS INTEGER) END AS pass_number, CASE WHEN maneuver = 'walk' THEN 'slow' END AS speed,
      'AOA' || study_id || '_' || (id % 3) AS biomechanics_file, CAST(file_size_mb AS DOUBLE) AS size FROM aud), {', '.join(runs)} {out}"""


_LADDER = ", ".join(f"({k}, {v}::DOUBLE)" for k, v in enumerate((0.3, *sg.RATE_LADDER)))
_SPLITS = ", ".join(f"({k}, {v}::DOUBLE)" for k, v in enumerate(sg.RATE_SPLITS))
_OFF = "(NOT isinf(w.first) AND abs(s.hz - w.first) / w.first > w.tol)"
_RATES = f"""WITH RECURSIVE {IRR}, st AS (SELECT recording_id, i - 1 AS i, t0, t, CASE WHEN t > t0 THEN 1 / (t - t0) ELSE 'inf'::DOUBLE END AS hz
        FROM (SELECT recording_id, i, t, lag(t) OVER (PARTITION BY recording_id ORDER BY i) AS t0 FROM irr) WHERE t0 IS NOT NULL),
  wk AS (SELECT recording_id, rank, tol, i, t0, t, hz AS first, 0 AS span FROM st, (VALUES {_LADDER}) l(rank, tol) WHERE i = 0
    UNION ALL SELECT w.recording_id, w.rank, w.tol, s.i, s.t0, s.t, CASE WHEN {_OFF} THEN s.hz ELSE w.first END, w.span + CASE WHEN {_OFF} THEN 1 ELSE 0 END FROM wk w JOIN st s ON s.recording_id = w.recording_id AND s.i = w.i + 1),
  sp AS (SELECT recording_id, rank, span, min(t0) AS s, max(t) AS e, min(i) AS i0 FROM wk GROUP BY ALL HAVING count(*) + 1 >= 3),
  ch AS (SELECT * FROM (SELECT recording_id, rank, count(*) AS n FROM sp GROUP BY 1, 2)
    QUALIFY row_number() OVER (PARTITION BY recording_id ORDER BY CASE WHEN n >= 3 THEN 0 ELSE 1 END, CASE WHEN n >= 3 THEN rank ELSE -n END, rank) = 1),
  kp AS (SELECT sp.*, n FROM sp JOIN ch USING (recording_id, rank)),
  lg AS (SELECT recording_id, s AS a, e AS b, i0 FROM kp WHERE n = 2 QUALIFY row_number() OVER (PARTITION BY recording_id ORDER BY e - s DESC, s, e DESC) = 1),
  w2 AS (SELECT st.recording_id, rank, tol, i, t0, t, hz AS first, 0 AS span, b FROM lg JOIN st ON st.recording_id = lg.recording_id AND st.i = lg.i0, (VALUES {_SPLITS}) l(rank, tol)
    UNION ALL SELECT w.recording_id, w.rank, w.tol, s.i, s.t0, s.t, CASE WHEN {_OFF} THEN s.hz ELSE w.first END, w.span + CASE WHEN {_OFF} THEN 1 ELSE 0 END, w.b
      FROM w2 w JOIN st s ON s.recording_id = w.recording_id AND s.i = w.i + 1 AND s.t <= w.b),
  pt AS (SELECT recording_id, rank, span, min(t0) AS s, max(t) AS e FROM w2 GROUP BY ALL HAVING count(*) + 1 >= 3),
  sv AS (SELECT recording_id, min(rank) AS rank FROM (SELECT recording_id, rank FROM pt GROUP BY 1, 2 HAVING count(*) > 1) GROUP BY 1),
  un AS (SELECT kp.recording_id, kp.s, kp.e FROM kp LEFT JOIN sv USING (recording_id) LEFT JOIN lg ON lg.recording_id = kp.recording_id WHERE sv.recording_id IS NULL OR kp.s <> lg.a
    UNION ALL SELECT pt.recording_id, pt.s, pt.e FROM pt JOIN sv USING (recording_id, rank))
  SELECT recording_id, {r('s', 'start')}, {r('e', chr(34) + 'end' + chr(34))} FROM un"""

_MOVE = f"""WITH {SIG}, th AS (SELECT recording_id, i // 2 AS i, ch2 - avg(ch2) OVER (PARTITION BY recording_id) AS x FROM sig WHERE i % 2 = 0),
  big AS (SELECT recording_id FROM sig GROUP BY 1 HAVING count(*) >= 100),
  ac AS (SELECT a.recording_id, b.i - a.i AS l, sum(a.x * b.x) AS s FROM th a JOIN th b ON a.recording_id = b.recording_id AND b.i >= a.i WHERE a.recording_id IN (SELECT recording_id FROM big) GROUP BY 1, 2),
  nm AS (SELECT ac.recording_id, ac.l - 25 AS i, ac.s / z.s AS v FROM ac JOIN ac z ON z.recording_id = ac.recording_id AND z.l = 0 AND z.s > 0 WHERE ac.l >= 25),
  {peaks('pk', 'nm', 'recording_id', need='0.1')}
  SELECT recording_id, {r('50.0::DOUBLE / (min(i) + 25)', 'movement_hz')} FROM pk GROUP BY 1"""


def _frequency() -> str:
    """The fixed filter as a table of taps, which follow from the same rule."""
    taps = kn.analytic_taps(ad.SIGNAL_FS, 5.0, 40.0, 4, 1.0)
    half = len(taps) // 2
    rows = ", ".join(f"({k - half}, {z.real!r}::DOUBLE, {z.imag!r}::DOUBLE)" for k, z in enumerate(taps.tolist()))
    return f"""WITH {SIG}, tp(k, re, im) AS (VALUES {rows}),
      lg AS (SELECT recording_id, c.ch, i, CASE c.ch WHEN 1 THEN ch1 ELSE ch2 END AS x, count(*) OVER (PARTITION BY recording_id, c.ch) - 1 AS last FROM sig, (VALUES (1), (2)) c(ch)),
      ct AS (SELECT recording_id, ch, i, last, x - avg(x) OVER (PARTITION BY recording_id, ch) AS x FROM lg),
      ed AS (SELECT recording_id, ch, max(x) FILTER (WHERE i = 0) AS x0, max(x) FILTER (WHERE i = last) AS x1 FROM ct GROUP BY 1, 2),
      ex AS (SELECT recording_id, ch, i, last, x FROM ct UNION ALL SELECT recording_id, ch, -i, last, 2 * x0 - x FROM ct JOIN ed USING (recording_id, ch) WHERE i BETWEEN 1 AND {half}
        UNION ALL SELECT recording_id, ch, 2 * last - i, last, 2 * x1 - x FROM ct JOIN ed USING (recording_id, ch) WHERE last - i BETWEEN 1 AND {half}),
      z AS (SELECT recording_id, ch, last, i + k AS i, sum(x * re) AS re, sum(x * im) AS im FROM ex, tp WHERE i + k BETWEEN 0 AND last GROUP BY ALL),
      d AS (SELECT *, atan2(im * lag(re) OVER w - re * lag(im) OVER w, re * lag(re) OVER w + im * lag(im) OVER w) AS turn FROM z WINDOW w AS (PARTITION BY recording_id, ch ORDER BY i)),
      f AS (SELECT recording_id, ch, i, CASE WHEN last = 0 THEN 0 WHEN i = 0 THEN lead(turn) OVER w WHEN i = last THEN turn ELSE (turn + lead(turn) OVER w) / 2 END * 100.0 / (2 * pi()) AS f FROM d WINDOW w AS (PARTITION BY recording_id, ch ORDER BY i))
      SELECT recording_id, i, {r('max(f) FILTER (WHERE ch = 1)', 'f_ch1')}, {r('max(f) FILTER (WHERE ch = 2)', 'f_ch2')} FROM f GROUP BY 1, 2"""


_CADENCE = f"""WITH RECURSIVE c AS (SELECT l_suppkey AS recording_id, 0.5::DOUBLE + CAST(l_quantity AS DOUBLE) / 20 AS hz, count(*) AS n, sum(CAST(l_discount AS DOUBLE)) AS cov, sum(CAST(l_tax AS DOUBLE)) AS bp,
    sum(CAST(l_quantity AS DOUBLE)) AS dur, sum(l_linenumber) AS heel, sum(CAST(l_returnflag <> 'R' AS INTEGER)) AS ok FROM lineitem GROUP BY 1, 2),
  o AS (SELECT *, row_number() OVER (PARTITION BY recording_id ORDER BY hz) AS k FROM c),
  w AS (SELECT recording_id, k, hz * n AS s, n AS m, 1 AS g FROM o WHERE k = 1
    UNION ALL SELECT o.recording_id, o.k, CASE WHEN abs(o.hz - w.s / w.m) / (w.s / w.m) > 0.06 THEN 0 ELSE w.s END + o.hz * o.n, CASE WHEN abs(o.hz - w.s / w.m) / (w.s / w.m) > 0.06 THEN 0 ELSE w.m END + o.n,
      w.g + CASE WHEN abs(o.hz - w.s / w.m) / (w.s / w.m) > 0.06 THEN 1 ELSE 0 END FROM w JOIN o ON o.recording_id = w.recording_id AND o.k = w.k + 1)
  SELECT recording_id, CAST(g AS INTEGER) AS speed_group, {r('sum(hz * n) / sum(n)', 'gait_cycle_hz')}, {r('sum(cov) / sum(n)', 'coverage_frac')}, {r('sum(bp) / sum(n)', 'bandpower_ratio')}, {r('sum(dur)', 'duration_s')},
    CAST(sum(heel) AS BIGINT) AS heel_strike_count, sum(ok) = sum(n) AS passed, CAST(sum(n) AS BIGINT) AS pass_count, {r('sum(ok) / sum(n)', 'pass_rate')} FROM o JOIN w USING (recording_id, k) GROUP BY 1, 2"""


def _hits(most: float) -> str:
    """Cycles, templates, r where it suffices, and the whole warped distance of these, a diagonal at a time."""
    base = cycles.ORACLES["template_correlation"]
    head = base[: base.index("c AS (SELECT recording_id, cycle_index, template")].replace("WITH ", "WITH RECURSIVE ", 1)
    cells = "[CASE WHEN i BETWEEN greatest(1, d + 1 - 64) AND least(64, d) THEN abs(a[i] - b[d + 1 - i]) + least(last[i], last[i + 1], prev[i]) ELSE 'inf'::DOUBLE END FOR i IN range(1, 65)]"
    return f"""{head} c AS (SELECT recording_id, cycle_index, template, CASE WHEN min(y) < max(y) THEN corr(y, ref) END AS r, list(y ORDER BY k) AS y, list(ref ORDER BY k) AS ref FROM y JOIN t USING (k) GROUP BY 1, 2, 3),
      q AS (SELECT recording_id, cycle_index, template, r, [(v - list_avg(y)) / list_stddev_pop(y) FOR v IN y] AS a, [(v - list_avg(ref)) / list_stddev_pop(ref) FOR v IN ref] AS b FROM c WHERE r >= 0.1),
      w AS (SELECT recording_id, cycle_index, template, r, a, b, 1 AS d, ['inf'::DOUBLE FOR i IN range(0, 65)] AS last, [CASE WHEN i = 0 THEN 0::DOUBLE ELSE 'inf'::DOUBLE END FOR i IN range(0, 65)] AS prev FROM q
        UNION ALL SELECT recording_id, cycle_index, template, r, a, b, d + 1, ['inf'::DOUBLE] || {cells}, last FROM w WHERE d < 128),
      h AS (SELECT recording_id, cycle_index, template, r, last[65] / 64 AS dtw FROM w WHERE d = 128 AND last[65] / 64 <= {most})"""


_OUT = "coalesce(list_sum([greatest(v - list_max({y}), 0) + greatest(list_min({y}) - v, 0) FOR v IN {x}]), 0)"
_BOUND = f"bo AS (SELECT recording_id, cycle_index, template, greatest({_OUT.format(x='a', y='b')}, {_OUT.format(x='b', y='a')}, abs(a[1] - b[1]) + abs(a[64] - b[64])) / 64 AS least FROM q)"


_DFT = f"""WITH {SIG}, bl AS (SELECT *, CAST(i // 100 AS INTEGER) AS cycle_index, ch2 * 90 AS angle FROM sig),
  lg AS (SELECT recording_id, cycle_index, c.ch, i % 100 AS i, count(*) OVER (PARTITION BY recording_id, cycle_index, c.ch) AS n, CASE c.ch WHEN 'ch1' THEN ch1 WHEN 'ch2' THEN ch2 WHEN 'ch3' THEN ch3 WHEN 'ch4' THEN ch4 ELSE (ch1 + ch2 + ch3 + ch4) / 4 END AS x
    FROM bl, (VALUES ('ch1'), ('ch2'), ('ch3'), ('ch4'), ('avg')) c(ch)),
  ft AS (SELECT recording_id, cycle_index, ch, f, sqrt(sum(x * cos(2 * pi() * f * i / n)) ** 2 + sum(x * sin(2 * pi() * f * i / n)) ** 2) AS m FROM lg, range(0, 51) q(f) WHERE f <= n // 2 GROUP BY ALL),
  sf AS (SELECT recording_id, cycle_index, {', '.join(f"sum(f * m) FILTER (WHERE ch = '{c}') / (sum(m) FILTER (WHERE ch = '{c}') + 1e-10) AS {c}_spectral_centroid, stddev_pop(m) FILTER (WHERE ch = '{c}') AS {c}_spectral_spread, sum(m * m) FILTER (WHERE ch = '{c}') AS {c}_spectral_energy" for c in ('ch1', 'ch2', 'ch3', 'ch4', 'avg'))} FROM ft GROUP BY 1, 2),
  s AS (SELECT *, (ch1 + ch2 + ch3 + ch4) / 4 AS mid FROM bl),
  cf AS (SELECT recording_id, cycle_index, {', '.join(f'{v} AS {k}' for k, v in cycles._ALL.items())}, max(t) - min(t) AS duration, count(*) AS num_samples, avg(angle) AS knee_angle_mean, stddev_pop(angle) AS knee_angle_std,
    min(angle) AS knee_angle_min, max(angle) AS knee_angle_max FROM s GROUP BY 1, 2)"""
_FEATURES = [*cycles._ALL, "duration", *[f"{c}_spectral_{k}" for c in ("ch1", "ch2", "ch3", "ch4", "avg") for k in ("centroid", "spread", "energy")], "knee_angle_mean", "knee_angle_std", "knee_angle_min", "knee_angle_max"]

def _spectra(source: str, key: str, n: int, seg: int, hop: int, fs: float, above: float) -> str:
    """CTEs pk (key, ratio, hz): strongest Welch bin over the median bin of frames ``source`` (key, j, x) of n samples."""
    cut = f"SELECT {key}, s, j - s * {hop} AS j, x FROM {source}, range(0, {(n - seg) // hop + 1}) q(s) WHERE j >= s * {hop} AND j < s * {hop} + {seg}"
    return _welch(cut, key, seg, fs, above)


def _welch(segments: str, key: str, seg: int, fs: float, above: float) -> str:
    """The same from the segments (key, s, j, x) themselves."""
    first = int(above * seg / fs) + 1
    return f"""sg AS ({segments}),
      ce AS (SELECT {key}, s, j, (x - avg(x) OVER (PARTITION BY {key}, s)) * (0.5 - 0.5 * cos(2 * pi() * j / {seg})) AS x FROM sg),
      fq AS (SELECT {key}, s, f, (sum(x * cos(2 * pi() * f * j / {seg})) ** 2 + sum(x * sin(2 * pi() * f * j / {seg})) ** 2) * CASE WHEN f = {seg / 2} THEN 1 ELSE 2 END AS p FROM ce, range({first}, {seg // 2 + 1}) q(f) GROUP BY {key}, s, f),
      av AS (SELECT {key}, f, avg(p) AS p FROM fq GROUP BY {key}, f),
      pk AS (SELECT {key}, CASE WHEN median(p) > 0 THEN max(p) / median(p) ELSE 0 END AS ratio, max_by(f, p) * {fs}::DOUBLE / {seg} AS hz FROM av GROUP BY {key})"""


_SLIDE = """fr AS (SELECT {key}, frame, i - frame * {step} AS j, t, x FROM {source}, range(0, 10000) q(frame) WHERE i >= frame * {step} AND i < frame * {step} + {n}),
  fu AS (SELECT * FROM fr QUALIFY count(*) OVER (PARTITION BY {key}, frame) = {n}),
  tm AS (SELECT {key}, frame, min(t) AS s, max(t) AS e FROM fu GROUP BY {key}, frame)"""
_LONG = "lo AS (SELECT recording_id, c.channel, i, t, CASE c.channel WHEN 'ch1' THEN ch1 WHEN 'ch2' THEN ch2 WHEN 'ch3' THEN ch3 ELSE ch4 END AS x FROM sig, (VALUES ('ch1'), ('ch2'), ('ch3'), ('ch4')) c(channel))"
_CHK = "recording_id, channel"
_NARROW = f"""WITH {SIG}, {_LONG}, {_SLIDE.format(key=_CHK, source='lo', step=128, n=256)}, {_spectra('fu', _CHK + ', frame', 256, 64, 32, 100.0, 5.0)},
  ho AS (SELECT {_CHK}, s, e FROM pk JOIN tm USING (recording_id, channel, frame) WHERE ratio >= 2.5), me AS ({merged('ho', _CHK, 0.015)})
  SELECT {_CHK}, {r('s', 'start')}, {r('e', chr(34) + 'end' + chr(34))} FROM me WHERE e - s >= 2.0"""
_FLAG = f"""WITH {SIG}, so AS (SELECT recording_id, i, t, ch1 AS x FROM sig), {_SLIDE.format(key='recording_id', source='so', step=256, n=256)}, {_spectra('fu', 'recording_id, frame', 256, 200, 100, 100.0, 5.0)}
  SELECT recording_id, frame, ratio > 5.0 AS periodic FROM pk"""
_PERIODIC = f"""{_MOVE[: _MOVE.rindex('SELECT')]}, mh AS (SELECT recording_id, 50.0::DOUBLE / (min(i) + 25) AS hz FROM pk GROUP BY 1),
  sa AS (SELECT recording_id, max(t) - 0.5 AS b FROM sig GROUP BY 1), ins AS (SELECT sig.* FROM sig JOIN sa USING (recording_id) WHERE t >= 0.5 AND t <= b),
  big2 AS (SELECT recording_id, min(i) AS i0 FROM ins GROUP BY 1 HAVING count(*) >= 256), {_LONG.replace('FROM sig,', 'FROM (SELECT ins.* REPLACE (i - i0 AS i) FROM ins JOIN big2 USING (recording_id)),')},
  {_SLIDE.format(key=_CHK, source='lo', step=128, n=256)}, {_spectra('fu', _CHK + ', frame', 256, 64, 32, 100.0, 5.0).replace('pk AS', 'pz AS')},
  ho AS (SELECT {_CHK}, s, e FROM pz JOIN tm USING (recording_id, channel, frame) LEFT JOIN mh USING (recording_id)
    WHERE ratio >= 2.5 AND coalesce(NOT ({' OR '.join(f'abs(pz.hz - {h} * mh.hz) < 0.1' for h in range(1, 6))}), true)), me AS ({merged('ho', _CHK, 0.0)})
  SELECT {_CHK}, {r('s', 'start')}, {r('e', chr(34) + 'end' + chr(34))} FROM me"""
_NOISE_KEY = "recording_id, cycle_index, channel"
_NOISE = f"""WITH {SIG}, ha AS (SELECT *, CAST(i // 300 AS INTEGER) AS cycle_index FROM sig), en AS (SELECT recording_id, cycle_index, min(i) AS i0 FROM ha GROUP BY 1, 2 HAVING count(*) >= 256),
  lo AS (SELECT recording_id, cycle_index, c.channel, i - i0 AS i, t, CASE c.channel WHEN 'ch1' THEN ch1 WHEN 'ch2' THEN ch2 WHEN 'ch3' THEN ch3 ELSE ch4 END AS x
    FROM ha JOIN en USING (recording_id, cycle_index), (VALUES ('ch1'), ('ch2'), ('ch3'), ('ch4')) c(channel)),
  {_SLIDE.format(key=_NOISE_KEY, source='lo', step=100, n=200)}, {_welch(f'SELECT {_NOISE_KEY}, frame AS s, j, x FROM fu', _NOISE_KEY, 200, 100.0, 5.0)}
  SELECT {_NOISE_KEY}, ratio > 5.0 AS periodic FROM pk"""


def _weights(name: str, rows) -> str:
    return f"{name}(k, w) AS (VALUES {', '.join(f'({k}, {float(w)!r}::DOUBLE)' for k, w in rows)})"


def _decimated() -> str:
    taps = kn.decimation_taps(4)
    return f"""WITH {SIG}, {_weights('tp', enumerate(taps.tolist(), -(len(taps) // 2)))}, y AS (SELECT recording_id, i + k AS i, sum(ch1 * w) AS ch1, sum(ch2 * w) AS ch2 FROM sig, tp WHERE (i + k) % 4 = 0 GROUP BY 1, 2)
      SELECT recording_id, sig.i // 4 AS i, {r('sig.t', 't')}, {r('y.ch1', 'ch1')}, {r('y.ch2', 'ch2')} FROM y JOIN sig USING (recording_id, i)"""


def _smoothed(window: int = 11, poly: int = 2) -> str:
    """Weights of the middle, and of each place near an end, where the polynomial of the outermost window counts."""
    h = window // 2
    basis = np.vander(np.arange(-h, h + 1), poly + 1, increasing=True)
    hat = basis @ np.linalg.pinv(basis)
    rows = ", ".join(f"({p - h}, {k - h}, {w!r}::DOUBLE)" for p, line in enumerate(hat.tolist()) for k, w in enumerate(line))
    return f"""WITH {SIG}, hat(p, k, w) AS (VALUES {rows}), n AS (SELECT recording_id, count(*) AS n FROM sig GROUP BY 1),
      pl AS (SELECT recording_id, i, n, least(greatest(i, {h}), n - 1 - {h}) AS mid FROM sig JOIN n USING (recording_id))
      SELECT recording_id, i, {r(f'CASE WHEN any_value(n) <= {window} THEN max(x) FILTER (WHERE j = i) ELSE sum(x * w) END', 'smooth')} FROM (
        SELECT pl.recording_id, pl.i, n, s.i AS j, s.ch2 AS x, w FROM pl JOIN sig s ON s.recording_id = pl.recording_id AND (s.i BETWEEN mid - {h} AND mid + {h} OR s.i = pl.i) LEFT JOIN hat ON p = pl.i - mid AND k = s.i - mid) GROUP BY 1, 2"""


ORACLES = {
    "stored_frames": f"""WITH {SIG} SELECT recording_id, u.how AS "read", count(*) AS n, {', '.join(r(f'sum({c})', c) for c in ad.CHANNELS)}, {r('max(t)', 't')}, (SELECT count(*) > 2000 FROM sig) AS many_files
      FROM sig, (VALUES ('all'), ('some')) u(how) WHERE u.how = 'all' OR recording_id % 5 = 0 GROUP BY 1, 2""",
    "stored_spectrogram": alignment.ORACLES["stft_db_whole"],
    "published_runs": _published(),
    "cadence_groups": _CADENCE,
    "template_work": f"""{_hits(0.8)}, {_BOUND} SELECT recording_id, cycle_index, (SELECT count(DISTINCT template) FROM t) AS n_templates, count(*) FILTER (WHERE c.r >= 0.1) AS n_correlated,
      count(*) FILTER (WHERE bo.least <= 0.8) AS n_warped FROM c LEFT JOIN bo USING (recording_id, cycle_index, template) GROUP BY 1, 2""",
    "template_best": f"""{_hits(0.8)} SELECT recording_id, cycle_index, template, {r('r', 'r')}, {r('dtw', 'dtw')} FROM h QUALIFY row_number() OVER (PARTITION BY recording_id, cycle_index ORDER BY dtw, template) = 1""",
}
# twins of queries that stand elsewhere
alignment.ORACLES |= {
    "movement_frequency": _MOVE, "rate_segments": _RATES, "instantaneous_frequency": _frequency(), "narrowband_intervals": _NARROW, "periodic_flag": _FLAG,
    "periodic_artifacts": _PERIODIC, "decimated_signal": _decimated(),
}
samples.ORACLES |= {"savgol_smooth": _smoothed()}
cycles.ORACLES |= {
    "cycle_periodic_noise": _NOISE,
    "template_match": f"{_hits(0.8)} SELECT recording_id, cycle_index, template, {r('r', 'r')}, {r('dtw', 'dtw')} FROM h",
    "cycle_features": f"""{_DFT} SELECT recording_id, cycle_index, num_samples, {', '.join(r(k, k) for k in _FEATURES)}, {r('CASE WHEN duration > 0 THEN num_samples / duration END', 'sample_rate')},
      {r('knee_angle_max - knee_angle_min', 'knee_angle_range')} FROM cf JOIN sf USING (recording_id, cycle_index)""",
}
