"""Window, detector and interval queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kymora.operators import detectors as dt
from kymora.operators import features as ft
from kymora.operators import intervals as iv
from kymora.operators import spectral as sp
from kymora.operators import windows as wn
from kymora.queries.common import IRR, SIG, islands, merged, r, rounded
from kymora.sources import adapters as ad
from kymora.sources import sinks

K = ["recording_id"]
KC = ["recording_id", "channel"]
FS = ad.SIGNAL_FS
DROP = {"silence": 0.4, "flatline": 0.001, "window_s": 0.2, "min_s": 0.02}


def dropout_intervals(spark: SparkSession, sf: str) -> DataFrame:
    found = dt.detect_dropout(ad.signal_multi(spark, sf), FS, **DROP)
    return rounded(iv.merge_intervals(found, KC, 0.05))


def dropout_any_channel(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(dt.detect_dropout(ad.signal_multi(spark, sf), FS, per_channel=False, **DROP))


def dropout_wide_window(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(dt.detect_dropout(ad.signal_multi(spark, sf), FS, silence=0.53, flatline=0.0006, window_s=1.0, min_s=0.02))


def spike_intervals(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(dt.detect_spikes(ad.signal_multi(spark, sf), FS, sigma=1.2, min_s=0.01))


def combined_channel_qc(spark: SparkSession, sf: str) -> DataFrame:
    s = ad.signal_multi(spark, sf)
    parts = {"dropout": dt.detect_dropout(s, FS, **DROP), "spike": dt.detect_spikes(s, FS, sigma=1.5, min_s=0.0)}
    return rounded(dt.channel_qc(parts))


def overall_qc_table(spark: SparkSession, sf: str) -> DataFrame:
    s = ad.signal_multi(spark, sf)
    d = dt.detect_dropout(s, FS, per_channel=False, **DROP)
    a = dt.detect_spikes(s, FS, sigma=1.5, min_s=0.0, per_channel=False)
    return rounded(dt.overall_qc(d, a))


def stage_record_wide(spark: SparkSession, sf: str) -> DataFrame:
    s = ad.signal_multi(spark, sf)
    long = dt.stage_record({"dropout": dt.detect_dropout(s, FS, **DROP), "spike": dt.detect_spikes(s, FS, sigma=1.7, min_s=0.0)})
    w = ft.pivot_intervals(long, K, ["dropout", "spike"], [*ad.CHANNELS, "overall"])
    arrays = [c for c, t in w.dtypes if t.startswith("array")]
    text = [F.array_join(F.transform(c, lambda x: F.round(x * 100).cast("int").cast("string")), ",").alias(c) for c in arrays]
    return w.select(*[c for c in w.columns if c not in arrays], *text)


def _event_intervals(spark: SparkSession, sf: str, only: str | None = None) -> DataFrame:
    e = ad.signal_irregular(spark, sf)
    e = e.filter(F.col("event") == only) if only else e
    return e.select("recording_id", F.col("t").alias("start"), (F.col("t") + F.col("v") * 60).alias("end"))


def interval_merge(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(iv.merge_intervals(_event_intervals(spark, sf), K, 600.0))


def interval_classify(spark: SparkSession, sf: str) -> DataFrame:
    m = iv.merge_intervals(_event_intervals(spark, sf), K, 0.0)
    return rounded(iv.duration_band(m, 60.0, 86400.0).withColumn("artifact_type", iv.artifact_type(F.col("end") - F.col("start"), 3600.0)))


def overall_segments(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(iv.overall_segments(dt.detect_dropout(ad.signal_multi(spark, sf), FS, **DROP), K))


def _days(spark: SparkSession, sf: str) -> DataFrame:
    day = F.floor(F.col("t") / 86400).cast("int")
    d = ad.signal_irregular(spark, sf).select("recording_id", day.alias("cycle_index")).distinct()
    return d.withColumn("w_start", F.col("cycle_index") * 86400.0).withColumn("w_end", F.col("w_start") + 43200.0)


def interval_trim_to_window(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(iv.trim_to_windows(_event_intervals(spark, sf), _days(spark, sf), K, bucket_s=21600.0))


def interval_overlap_fraction(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(iv.in_bad_interval(iv.overlap_fraction(_days(spark, sf), _event_intervals(spark, sf), K), 0.0005))


def interval_shift(spark: SparkSession, sf: str) -> DataFrame:
    e = ad.signal_irregular(spark, sf)
    stomps = e.groupBy("recording_id").agg(F.min("t").alias("audio_stomp"), F.max("t").alias("motion_stomp"))
    return rounded(iv.shift(_event_intervals(spark, sf, "error"), stomps, K))


def interval_flatten_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Flat array per recording and back; the rows that come back are the rows that went in."""
    pairs = _event_intervals(spark, sf, "error").groupBy("recording_id").agg(
        iv.flatten_pairs(F.array_sort(F.collect_list(F.struct("start", "end")))).alias("flat"))
    back = pairs.select("recording_id", F.size("flat").alias("n_values"), F.explode(iv.unflatten_pairs(F.col("flat"))).alias("p"))
    return rounded(back.select("recording_id", "n_values", F.col("p.start").alias("start"), F.col("p.end").alias("end")))


def clip_bad_samples(spark: SparkSession, sf: str) -> DataFrame:
    s = ad.signal_irregular(spark, sf).select("recording_id", "event_id", "t")
    bad = _event_intervals(spark, sf, "error").withColumn("end", F.col("start") + 7200.0)
    return rounded(iv.drop_samples_inside(s, bad, K, bucket_s=3600.0))


def sliding_stats(spark: SparkSession, sf: str) -> DataFrame:
    s = wn.sliding_stats(ad.signal_multi(spark, sf).select("recording_id", "i", "ch1", "ch2"), K, ["ch1", "ch2"], 21)
    return rounded(s.select("recording_id", "i", *[f"{c}_{k}" for c in ("ch1", "ch2") for k in ("rms", "var", "mean", "std")]))


def sliding_stats_wide(spark: SparkSession, sf: str) -> DataFrame:
    s = wn.sliding_stats(ad.signal_multi(spark, sf), K, ["ch2"], 201)
    return rounded(s.select("recording_id", "i", "ch2_rms", "ch2_var", "ch2_mean", "ch2_std"))


def gradient(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(wn.gradient(ad.signal_multi(spark, sf), K, "ch2", "g").select("recording_id", "i", "g"))


def moving_average(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(wn.moving_average(ad.signal_multi(spark, sf), K, "ch1", 8, "ma").select("recording_id", "i", "ma"))


def envelope_rms(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(ad.signal_multi(spark, sf).select("recording_id", "i", wn.envelope(ad.CHANNELS).alias("env")))


def zscore(spark: SparkSession, sf: str) -> DataFrame:
    s = wn.zscore(ad.signal_multi(spark, sf), K, "ch1", "z")
    return rounded(wn.minmax_band(s, K, "ch2", "band").select("recording_id", "i", "z", "band"))


def unwrap_phase(spark: SparkSession, sf: str) -> DataFrame:
    s = ad.signal_multi(spark, sf).withColumn("phase", (F.col("ch1") - 0.5) * 6.0)
    return rounded(wn.unwrap_phase(s, K, "phase", "unwrapped").select("recording_id", "i", "unwrapped"))


def sample_rate(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(wn.sample_rate(ad.signal_irregular(spark, sf), K))


def axis_limits(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(wn.axis_limits(ad.signal_multi(spark, sf), K, "ch2"))


def plot_thinning(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(wn.thin(ad.signal_multi(spark, sf), K, 100).select("recording_id", "i", "ch1"))


def threshold_calibration(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(dt.calibrate_thresholds(ad.signal_multi(spark, sf), 50))


def channel_summary(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(sinks.channel_summary(ad.signal_multi(spark, sf), K))


def export_channels(spark: SparkSession, sf: str) -> DataFrame:
    return sinks.export_channels(ad.signal_multi(spark, sf).withColumnsRenamed({"t": "TT", "ch1": "CH1"}).drop("ch4"))


def savgol_smooth(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(sp.savgol(ad.signal_multi(spark, sf), K, "ch2", "smooth", 11, 2).select("recording_id", "i", "smooth"))


QUERIES = {f.__name__: f for f in (
    dropout_intervals, dropout_any_channel, dropout_wide_window, spike_intervals, combined_channel_qc, overall_qc_table,
    stage_record_wide, interval_merge, interval_classify, overall_segments, interval_trim_to_window, interval_overlap_fraction,
    interval_shift, interval_flatten_roundtrip, clip_bad_samples, sliding_stats, sliding_stats_wide, gradient, moving_average,
    envelope_rms, zscore, unwrap_phase, sample_rate, axis_limits, plot_thinning, threshold_calibration, channel_summary,
    export_channels, savgol_smooth,
)}

_FR = "OVER (PARTITION BY recording_id ORDER BY i ROWS BETWEEN {h} PRECEDING AND {h} FOLLOWING)"
_CH = ("ch1", "ch2", "ch3", "ch4")


def _long(inner: str) -> str:
    return " UNION ALL ".join(inner.format(c=c) for c in _CH)


def _dropout(silence: float, flat: float, h: int) -> str:
    fr = _FR.format(h=h)
    return _long(f"SELECT recording_id, '{{c}}' AS channel, i, t, (sqrt(avg({{c}}*{{c}}) {fr}) < {silence} OR var_pop({{c}}) {fr} < {flat}) AS bad FROM sig")


def _spikes(sigma: float) -> str:
    fr = _FR.format(h=2)
    return _long(f"SELECT recording_id, '{{c}}' AS channel, i, t, (abs({{c}}) > avg({{c}}) {fr} + {sigma} * sqrt(greatest(avg({{c}}*{{c}}) {fr} - (avg({{c}}) {fr}) * (avg({{c}}) {fr}), 0)) + 1e-9::DOUBLE * abs(avg({{c}}) {fr})) AS bad FROM sig")


_KC = "recording_id, channel"
_D = f"{SIG}, dlong AS ({_dropout(0.4, 0.001, 10)}), dint AS ({islands('dlong', _KC, 'bad', 0.02)})"
_S0 = f"slong AS ({_spikes(1.5)}), sint AS ({islands('slong', _KC, 'bad', 0.0)})"
_ANY = "SELECT recording_id, i, t, bool_or(bad) AS bad FROM {x} GROUP BY ALL"
_EV = "SELECT recording_id, t AS s, t + v * 60 AS e FROM irr"
_DAYS = "days AS (SELECT DISTINCT recording_id, CAST(floor(t / 86400) AS INTEGER) AS cycle_index FROM irr), win AS (SELECT *, cycle_index * 86400.0::DOUBLE AS ws, cycle_index * 86400.0::DOUBLE + 43200 AS we FROM days)"
_SE = f'{r("s", "start")}, {r("e", "\"end\"")}'


def _pick(kind: str, ch: str) -> str:
    lst = f"list([s, e] ORDER BY s, e) FILTER (WHERE kind = '{kind}' AND channel = '{ch}')"
    text = f"array_to_string(list_transform(flatten({lst}), lambda x: CAST(CAST(round(x * 100) AS INTEGER) AS VARCHAR)), ',')"
    return f"count(*) FILTER (WHERE kind = '{kind}' AND channel = '{ch}') > 0 AS {kind}_{ch}, {text} AS {kind}_segments_{ch}"


_W = "OVER (PARTITION BY recording_id ORDER BY i)"
ORACLES = {
    "dropout_intervals": f"WITH {_D} SELECT recording_id, channel, {_SE} FROM ({merged('dint', _KC, 0.05)})",
    "dropout_any_channel": f"WITH {_D}, a AS ({_ANY.format(x='dlong')}) SELECT recording_id, {_SE} FROM ({islands('a', 'recording_id', 'bad', 0.02)})",
    "dropout_wide_window": f"WITH {SIG}, dlong AS ({_dropout(0.53, 0.0006, 50)}) SELECT recording_id, channel, {_SE} FROM ({islands('dlong', _KC, 'bad', 0.02)})",
    "spike_intervals": f"WITH {SIG}, slong AS ({_spikes(1.2)}) SELECT recording_id, channel, {_SE}, CASE WHEN e - s < 4 THEN 'Intermittent' ELSE 'Continuous' END AS artifact_type FROM ({islands('slong', _KC, 'bad', 0.01)})",
    "combined_channel_qc": f"WITH {_D}, {_S0}, u AS (SELECT * FROM dint UNION ALL SELECT * FROM sint) SELECT recording_id, channel, {_SE} FROM ({merged('u', _KC, 0.0)})",
    "overall_qc_table": f"""WITH {_D}, {_S0}, a AS ({_ANY.format(x='dlong')}), b AS ({_ANY.format(x='slong')})
      SELECT recording_id, 'dropout' AS kind, {_SE} FROM ({islands('a', 'recording_id', 'bad', 0.02)})
      UNION ALL SELECT recording_id, 'artifact' AS kind, {_SE} FROM ({islands('b', 'recording_id', 'bad', 0.0)})""",
    "stage_record_wide": f"""WITH {_D}, slong AS ({_spikes(1.7)}), sint AS ({islands('slong', _KC, 'bad', 0.0)}),
      u AS (SELECT *, 'dropout' AS kind FROM dint UNION ALL SELECT *, 'spike' AS kind FROM sint),
      o AS ({merged('u', 'recording_id, kind', 0.5)}),
      al AS (SELECT recording_id, kind, channel, s, e FROM u UNION ALL SELECT recording_id, kind, 'overall' AS channel, s, e FROM o)
      SELECT recording_id, {', '.join(_pick(k, c) for k in ('dropout', 'spike') for c in ('ch1', 'ch2', 'ch3', 'ch4', 'overall'))} FROM al GROUP BY recording_id""",
    "interval_merge": f"WITH {IRR}, ev AS ({_EV}) SELECT recording_id, {_SE} FROM ({merged('ev', 'recording_id', 600.0)})",
    "interval_classify": f"WITH {IRR}, ev AS ({_EV}) SELECT recording_id, {_SE}, CASE WHEN e - s < 3600 THEN 'Intermittent' ELSE 'Continuous' END AS artifact_type FROM ({merged('ev', 'recording_id', 0.0)}) WHERE e - s BETWEEN 60 AND 86400",
    "overall_segments": f"WITH {_D} SELECT recording_id, {_SE} FROM ({merged('dint', 'recording_id', 0.0)})",
    "interval_trim_to_window": f"WITH {IRR}, ev AS ({_EV}), {_DAYS} SELECT recording_id, cycle_index, {r('greatest(s, ws)', 'start')}, {r('least(e, we)', chr(34) + 'end' + chr(34))} FROM ev JOIN win USING (recording_id) WHERE e > ws AND s < we",
    "interval_overlap_fraction": f"""WITH {IRR}, ev AS ({_EV}), {_DAYS}, f AS (SELECT recording_id, cycle_index, coalesce(sum(greatest(least(e, we) - greatest(s, ws), 0)), 0) / 43200.0 AS f
      FROM win LEFT JOIN ev USING (recording_id) GROUP BY ALL) SELECT recording_id, cycle_index, {r('f', 'overlap_fraction')}, f >= 0.0005 AS in_bad_interval FROM f""",
    "interval_shift": f"""WITH {IRR}, st AS (SELECT recording_id, max(t) - min(t) AS d FROM irr GROUP BY 1)
      SELECT recording_id, {r('t + d', 'start')}, {r('t + v * 60 + d', chr(34) + 'end' + chr(34))} FROM irr JOIN st USING (recording_id) WHERE event = 'error'""",
    "interval_flatten_roundtrip": f"""WITH {IRR} SELECT recording_id, CAST(2 * count(*) OVER (PARTITION BY recording_id) AS INTEGER) AS n_values, {r('t', 'start')}, {r('t + v * 60', chr(34) + 'end' + chr(34))} FROM irr WHERE event = 'error'""",
    "clip_bad_samples": f"""WITH {IRR} SELECT recording_id, event_id, {r('t', 't')} FROM irr a WHERE NOT EXISTS (SELECT 1 FROM irr b WHERE b.event = 'error'
      AND b.recording_id = a.recording_id AND a.t BETWEEN b.t AND b.t + 7200)""",
    "sliding_stats": f"WITH {SIG} SELECT recording_id, i, " + ", ".join(
        ", ".join([r(f"sqrt(avg({c}*{c}) {_FR.format(h=10)})", f"{c}_rms"), r(f"var_pop({c}) {_FR.format(h=10)}", f"{c}_var"),
                   r(f"avg({c}) {_FR.format(h=10)}", f"{c}_mean"), r(f"stddev_pop({c}) {_FR.format(h=10)}", f"{c}_std")]) for c in ("ch1", "ch2")) + " FROM sig",
    "sliding_stats_wide": f"WITH {SIG} SELECT recording_id, i, " + ", ".join(
        [r(f"sqrt(avg(ch2*ch2) {_FR.format(h=100)})", "ch2_rms"), r(f"var_pop(ch2) {_FR.format(h=100)}", "ch2_var"),
         r(f"avg(ch2) {_FR.format(h=100)}", "ch2_mean"), r(f"stddev_pop(ch2) {_FR.format(h=100)}", "ch2_std")]) + " FROM sig",
    "gradient": f"""WITH {SIG}, n AS (SELECT recording_id, i, ch2 AS x, lag(ch2) {_W} AS p, lead(ch2) {_W} AS q FROM sig)
      SELECT recording_id, i, {r('CASE WHEN p IS NULL THEN q - x WHEN q IS NULL THEN x - p ELSE (q - p) / 2 END', 'g')} FROM n""",
    "moving_average": f"WITH {SIG} SELECT recording_id, i, {r('sum(ch1) OVER (PARTITION BY recording_id ORDER BY i ROWS BETWEEN 4 PRECEDING AND 3 FOLLOWING) / 8', 'ma')} FROM sig",
    "envelope_rms": f"WITH {SIG} SELECT recording_id, i, {r('sqrt((ch1*ch1 + ch2*ch2 + ch3*ch3 + ch4*ch4) / 4)', 'env')} FROM sig",
    "zscore": f"""WITH {SIG} SELECT recording_id, i, {r('(ch1 - avg(ch1) OVER p) / stddev_pop(ch1) OVER p', 'z')},
      {r('0.25 + (ch2 - min(ch2) OVER p) / (max(ch2) OVER p - min(ch2) OVER p) * 0.5', 'band')} FROM sig WINDOW p AS (PARTITION BY recording_id)""",
    "unwrap_phase": f"""WITH {SIG}, d AS (SELECT recording_id, i, (ch1 - 0.5) * 6.0::DOUBLE AS x, (ch1 - 0.5) * 6.0::DOUBLE - lag((ch1 - 0.5) * 6.0::DOUBLE) {_W} AS d FROM sig),
      f AS (SELECT *, CASE WHEN d IS NULL OR abs(d) < pi() THEN 0 WHEN d > 0 THEN -2 * pi() ELSE 2 * pi() END AS fix FROM d)
      SELECT recording_id, i, {r('x + sum(fix) OVER (PARTITION BY recording_id ORDER BY i ROWS UNBOUNDED PRECEDING)', 'unwrapped')} FROM f""",
    "sample_rate": f"""WITH {IRR}, d AS (SELECT recording_id, t - lag(t) {_W} AS d FROM irr), m AS (SELECT recording_id, quantile_cont(d, 0.5) AS m, min(d) AS lo FROM d GROUP BY 1)
      SELECT recording_id, {r('CASE WHEN m > 0 THEN 1 / m ELSE 46875.0 END', 'fs')}, lo > 0 AS monotonic FROM m""",
    "axis_limits": f"""WITH {SIG}, q AS (SELECT recording_id, quantile_cont(ch2, 0.01) AS a, quantile_cont(ch2, 0.99) AS b FROM sig GROUP BY 1)
      SELECT recording_id, {r('a - (b - a) * 0.05', 'lo')}, {r('b + (b - a) * 0.05', 'hi')} FROM q""",
    "plot_thinning": f"WITH {SIG}, n AS (SELECT *, greatest(count(*) OVER (PARTITION BY recording_id) // 100, 1) AS k FROM sig) SELECT recording_id, i, {r('ch1', 'ch1')} FROM n WHERE i % k = 0",
    "threshold_calibration": f"""WITH {SIG}, l AS ({_long("SELECT recording_id, '{c}' AS channel, i, {c} AS x FROM sig")}),
      w AS (SELECT channel, sqrt(avg(x * x)) AS rms, var_pop(x) AS v FROM l GROUP BY recording_id, channel, i // 50)
      SELECT channel, {r('quantile_cont(rms, 0.01)', 'rms_p01')}, {r('quantile_cont(rms, 0.05)', 'rms_p05')}, {r('quantile_cont(v, 0.01)', 'var_p01')}, {r('quantile_cont(v, 0.05)', 'var_p05')} FROM w GROUP BY channel""",
    "channel_summary": f"""WITH {SIG}, l AS ({_long("SELECT recording_id, '{c}' AS channel, {c} AS x FROM sig")})
      SELECT recording_id, channel, {r('min(x)', chr(34) + 'min' + chr(34))}, {r('max(x)', chr(34) + 'max' + chr(34))}, {r('avg(x)', chr(34) + 'mean' + chr(34))}, count(x) > 0 AS has_data FROM l GROUP BY ALL""",
    "export_channels": f"""WITH {SIG} SELECT recording_id, i, printf('%.6f', t) AS tt, printf('%.6f', ch1) AS ch1, printf('%.6f', ch2) AS ch2, printf('%.6f', ch3) AS ch3, CAST(NULL AS VARCHAR) AS ch4 FROM sig""",
}
