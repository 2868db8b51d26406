"""Alignment, event segments, peaks and spectral queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kymora.operators import align as al
from kymora.operators import audioqc as aq
from kymora.operators import peaks as pk
from kymora.operators import segments as sg
from kymora.operators import spectral as sp
from kymora.operators import stomp as st
from kymora.queries.common import IRR, SIG, WAVE, peaks, r, rounded
from kymora.sources import adapters as ad

K = ["recording_id"]
FS = ad.SIGNAL_FS


def _of(spark: SparkSession, sf: str, event: str) -> DataFrame:
    return ad.signal_irregular(spark, sf).filter(F.col("event") == event).select("recording_id", F.col("event_id").alias("i"), "t", "v")


def asof_nearest(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(al.asof_nearest(_of(spark, sf, "click"), _of(spark, sf, "view"), K, 7200.0))


def asof_interpolate(spark: SparkSession, sf: str) -> DataFrame:
    """Irregular events joined to a thinned series, then filled by row position."""
    e = ad.signal_irregular(spark, sf).withColumn("v", F.when(F.col("i") % 3 == 0, F.col("v"))).select("recording_id", "i", "v")
    return rounded(al.interpolate_inside(e, K, ["v"]))


def resample_uniform(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(al.resample_uniform(ad.signal_irregular(spark, sf), K, "v", 1 / 14400.0).drop("t"))


def resample_waveform(spark: SparkSession, sf: str) -> DataFrame:
    w = ad.waveform(spark, sf).select("recording_id", F.posexplode(al.resample_array(F.col("x"), 25)).alias("k", "y"))
    return rounded(w)


def proximity_score(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(al.proximity_score(_of(spark, sf, "click"), _of(spark, sf, "view"), K, 86400.0))


def _motion(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Every fourth sample as the motion side, shifted by a stomp difference."""
    s = ad.signal_multi(spark, sf)
    audio = s.select("recording_id", "i", "t", "ch1")
    motion = s.filter(F.col("i") % 4 == 0).select("recording_id", F.floor(F.col("i") / 4).alias("i"), (F.col("t") + 2.0).alias("t"), (F.col("ch2") * 90).alias("knee"))
    reach = s.groupBy("recording_id").agg(F.max("t").alias("_end"))
    bounds = reach.select("recording_id", F.lit(1.0).alias("audio_stomp"), F.lit(3.0).alias("motion_stomp"),
                          F.lit(3.25).alias("pass_start"), (F.col("_end") * 0.5 + 2.0).alias("pass_end"))
    return audio, motion, bounds


def synchronize_series(spark: SparkSession, sf: str) -> DataFrame:
    synced, _ = al.synchronize(*_motion(spark, sf), K, ["knee"])
    return rounded(synced.select("recording_id", "i", "t", "ch1", "knee"))


def synchronize_status(spark: SparkSession, sf: str) -> DataFrame:
    audio, motion, bounds = _motion(spark, sf)
    _, _, status = al.shift_and_clip(audio, motion, bounds.withColumn("pass_end", F.col("pass_end") * (F.col("recording_id") % 3 + 1)), K)
    return rounded(status)


def validate_synced(spark: SparkSession, sf: str) -> DataFrame:
    near = al.asof_nearest(_of(spark, sf, "click"), _of(spark, sf, "view"), K, 86400.0)
    return rounded(al.validate_synced(near, K, ["v"], ["r_v"]))


def gap_sessions(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(sg.gap_sessions(ad.signal_irregular(spark, sf), K, 7200.0, 3))


def rate_segments(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(sg.rate_segments(ad.signal_irregular(spark, sf), K, 3, 0.3))


def marker_pairs(spark: SparkSession, sf: str) -> DataFrame:
    m = sg.marker_sections(ad.markers(spark, sf), K, F.when(F.trim("event").endswith("Speed"), F.col("event")), ["row"])
    return rounded(sg.marker_pairs(m, [*K, "section"]))


def peak_pairs(spark: SparkSession, sf: str) -> DataFrame:
    s = ad.signal_multi(spark, sf)
    e = st.window_energy(s, K, ad.CHANNELS, FS, 0.1)
    every = s.select("recording_id").distinct().withColumn("expected_delta", 0.7 + (F.col("recording_id") % 5) * 0.1)
    return rounded(sg.peak_pairs(e.select("recording_id", "t", "energy"), every, K))


def local_extrema(spark: SparkSession, sf: str) -> DataFrame:
    x = pk.local_extrema(ad.signal_multi(spark, sf), K, "ch1")
    return rounded(x.filter("kind IN ('max', 'min')"))


def find_peaks_full(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(pk.find_peaks(ad.signal_multi(spark, sf), K, "ch2", height=0.2, distance=10, prominence=0.3))


def peaks_of_waveforms(spark: SparkSession, sf: str) -> DataFrame:
    w = ad.waveform(spark, sf)
    return w.select("recording_id", F.explode(pk.peaks_of_arrays(F.col("x"), height=0.1)).alias("i"))


def windowed_minima(spark: SparkSession, sf: str) -> DataFrame:
    return ad.waveform(spark, sf).select("recording_id", F.explode(pk.windowed_extrema(F.col("x"))).alias("i"))


def heel_strikes(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(pk.heel_strikes(ad.signal_multi(spark, sf), K, "ch2", FS))


def welch_psd(spark: SparkSession, sf: str) -> DataFrame:
    w = ad.waveform(spark, sf)
    return rounded(w.select("recording_id", F.posexplode(sp.psd(F.col("x"), 64.0, 32)).alias("bin", "p")), 8)


def bandpower_ratio(spark: SparkSession, sf: str) -> DataFrame:
    w = ad.waveform(spark, sf)
    return rounded(w.select("recording_id", sp.bandpower_ratio(F.col("x"), F.lit(10.0), 64.0, 0.35).alias("ratio")))


def spectral_features(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(ad.waveform(spark, sf).select("recording_id", sp.spectral_features(F.col("x")).alias("f")).select("recording_id", "f.*"))


def stft_db(spark: SparkSession, sf: str) -> DataFrame:
    """All bins of every frame."""
    s = sp.spectrogram(ad.signal_multi(spark, sf), K, "ch2", FS, 32, 24)
    return rounded(s.select("recording_id", "frame", "t", F.posexplode("db").alias("bin", "db")).withColumn("db", F.col("db").cast("double")), 2)


def narrowband_intervals(spark: SparkSession, sf: str) -> DataFrame:
    long = ad.unpivot_channels(ad.signal_multi(spark, sf))
    return rounded(sp.continuous_noise(long, [*K, "channel"], "x", FS, ratio=2.5, min_s=2.0))


def periodic_flag(spark: SparkSession, sf: str) -> DataFrame:
    f = sp.frames(ad.signal_multi(spark, sf), K, "ch1", 256, 256)
    return f.select("recording_id", "frame", sp.periodic_flag(F.col("x"), FS, 0.2).alias("periodic"))


def periodic_artifacts(spark: SparkSession, sf: str) -> DataFrame:
    s = ad.signal_multi(spark, sf)
    hz = sp.movement_frequency(s, K, "ch2", FS)
    spans = s.groupBy("recording_id").agg(F.lit(0.5).alias("span_start"), (F.max("t") - 0.5).alias("span_end"))
    return rounded(sp.periodic_artifacts(s, hz, spans, K, ad.CHANNELS, FS, ratio=2.5, target_fs=100.0))


def movement_frequency(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(sp.movement_frequency(ad.signal_multi(spark, sf), K, "ch2", FS))


def instantaneous_frequency(spark: SparkSession, sf: str) -> DataFrame:
    f = sp.instantaneous_frequency(ad.signal_multi(spark, sf), K, ["ch1", "ch2"], FS, 5.0, 40.0)
    return rounded(f.select("recording_id", "i", "f_ch1", "f_ch2"))


def decimated_signal(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(sp.decimate(ad.signal_multi(spark, sf), K, ["ch1", "ch2"], 4))


def stomp_energy(spark: SparkSession, sf: str) -> DataFrame:
    s = ad.signal_multi(spark, sf)
    a = st.stomp_by_energy(s, K, ad.CHANNELS, FS).drop("rms_energy")
    return rounded(a.join(st.stomp_by_onset(s, K, ad.CHANNELS, FS).drop("onset_magnitude"), K))


def stomp_consensus(spark: SparkSession, sf: str) -> DataFrame:
    s = ad.signal_multi(spark, sf)
    d = st.stomp_by_energy(s, K, ad.CHANNELS, FS).join(st.stomp_by_onset(s, K, ad.CHANNELS, FS), K)
    d = d.select("recording_id", "rms_time", "onset_time", (F.col("rms_time") + (F.col("recording_id") % 4) * 0.2).alias("freq_time"))
    return rounded(st.consensus(d).withColumn("agreement_span", st.agreement_span("rms_time", "onset_time", "freq_time")))


def stomp_refined(spark: SparkSession, sf: str) -> DataFrame:
    s = ad.signal_multi(spark, sf)
    goal = s.select("recording_id").distinct().select(
        "recording_id", F.when(F.col("recording_id") % 2 == 0, "left").otherwise("right").alias("recorded_knee"),
        F.lit(1.0).alias("left_stomp"), (1.6 + (F.col("recording_id") % 7) * 0.2).alias("right_stomp"))
    return rounded(st.refine(s, st.detect(s, K, FS), goal, K, FS))


def walk_passes(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(aq.walk_qc(ad.signal_multi(spark, sf), K, segmentation="rate"))


def walk_speed_groups(spark: SparkSession, sf: str) -> DataFrame:
    p = aq.walk_qc(ad.signal_multi(spark, sf), K)
    return rounded(sg.speed_groups(p.withColumn("recording_id", F.col("recording_id") % 10), K))


def periodic_exercise(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(aq.periodic_qc(ad.signal_multi(spark, sf), K, "flexion_extension", 1.0, 1.0))


def batch_sound_qc(spark: SparkSession, sf: str) -> DataFrame:
    s = ad.signal_multi(spark, sf)
    kind = F.when(F.col("recording_id") % 3 == 0, "walk").when(F.col("recording_id") % 3 == 1, "sit_to_stand").otherwise("flexion_extension")
    return rounded(aq.batch_qc(s, s.select("recording_id").distinct().withColumn("maneuver", kind), K, 1.0, 1.0))


QUERIES = {f.__name__: f for f in (
    asof_nearest, asof_interpolate, resample_uniform, resample_waveform, proximity_score, synchronize_series, synchronize_status,
    validate_synced, gap_sessions, rate_segments, marker_pairs, peak_pairs, local_extrema, find_peaks_full, peaks_of_waveforms,
    windowed_minima, heel_strikes, welch_psd, bandpower_ratio, spectral_features, stft_db, narrowband_intervals, periodic_flag,
    periodic_artifacts, movement_frequency, instantaneous_frequency, decimated_signal, stomp_energy, stomp_consensus, stomp_refined,
    walk_passes, walk_speed_groups, periodic_exercise, batch_sound_qc,
)}
QUERIES["stft_db_whole"] = stft_db  # a name of an earlier time

_AB = f"{IRR}, a AS (SELECT * FROM irr WHERE event = 'click'), b AS (SELECT * FROM irr WHERE event = 'view')"
_NEAR = f"""{_AB},
  bk AS (SELECT a.event_id, max_by(b, (b.t, b.event_id)) AS p FROM a JOIN b ON a.recording_id = b.recording_id AND b.t <= a.t GROUP BY 1),
  fw AS (SELECT a.event_id, min_by(b, (b.t, b.event_id)) AS n FROM a JOIN b ON a.recording_id = b.recording_id AND b.t > a.t GROUP BY 1),
  nr AS (SELECT a.*, p, n FROM a LEFT JOIN bk USING (event_id) LEFT JOIN fw USING (event_id)),
  pk AS (SELECT *, CASE WHEN n.t IS NULL OR t - p.t <= n.t - t THEN p ELSE n END AS c FROM nr)"""


def _dft(source: str, key: str, n: int) -> str:
    """Real and imaginary sums per bin of (key, i, x)."""
    return f"""SELECT {key}, f, sum(x * cos(2 * pi() * f * i / {n})) AS re, sum(x * sin(2 * pi() * f * i / {n})) AS im
      FROM {source}, range(0, {n // 2 + 1}) AS g(f) GROUP BY {key}, f"""


_WELCH = f"""WITH {WAVE}, sg AS (SELECT recording_id, s, i - s * 16 AS i, x FROM wave, range(0, 3) AS q(s) WHERE i >= s * 16 AND i < s * 16 + 32),
  ct AS (SELECT recording_id, s, i, (x - avg(x) OVER (PARTITION BY recording_id, s)) * (0.5 - 0.5 * cos(2 * pi() * i / 32)) AS x FROM sg),
  ft AS ({_dft('ct', 'recording_id, s', 32)}),
  ps AS (SELECT recording_id, f, avg((re * re + im * im) / (64.0 * 12.0) * CASE WHEN f IN (0, 16) THEN 1 ELSE 2 END) AS p FROM ft GROUP BY 1, 2)
  SELECT recording_id, CAST(f AS INTEGER) AS bin, {r('p', 'p', 8)} FROM ps"""
_BAND = f"""WITH {WAVE}, ct AS (SELECT recording_id, i, (x - avg(x) OVER (PARTITION BY recording_id)) * (0.5 - 0.5 * cos(2 * pi() * i / 64)) AS x FROM wave),
  ft AS ({_dft('ct', 'recording_id', 64)}),
  ps AS (SELECT recording_id, f, (re * re + im * im) * CASE WHEN f IN (0, 32) THEN 1 ELSE 2 END AS p FROM ft)
  SELECT recording_id, {r('(sum(p) FILTER (WHERE f BETWEEN 7 AND 13) - (sum(p) FILTER (WHERE f IN (7, 13))) / 2) / (sum(p) - (sum(p) FILTER (WHERE f IN (0, 32))) / 2)', 'ratio')} FROM ps GROUP BY 1"""
_EN = """en AS (SELECT recording_id, w, sqrt(sum(q) / ({n} * 4.0)) AS energy, max(CASE WHEN i = w * {step} + {half} THEN t END) AS t
  FROM (SELECT *, ch1*ch1 + ch2*ch2 + ch3*ch3 + ch4*ch4 AS q FROM sig WHERE t <= 20) s
  JOIN (SELECT DISTINCT i AS w FROM sig) g ON s.i >= g.w * {step} AND s.i < g.w * {step} + {n} GROUP BY 1, 2 HAVING count(*) = {n})"""
_STOMP = f"""{SIG}, {_EN.format(n=5, step=1, half=2)},
  a AS (SELECT recording_id, max_by(t, (energy, -w)) AS rms_time FROM en GROUP BY 1),
  ev AS (SELECT recording_id, i, t, sqrt((ch1*ch1 + ch2*ch2 + ch3*ch3 + ch4*ch4) / 4) AS e FROM sig WHERE t <= 20),
  nb AS (SELECT *, lag(e) OVER w AS p, lead(e) OVER w AS n FROM ev WINDOW w AS (PARTITION BY recording_id ORDER BY i)),
  gr AS (SELECT *, abs(CASE WHEN p IS NULL THEN n - e WHEN n IS NULL THEN e - p ELSE (n - p) / 2 END) AS g FROM nb),
  b AS (SELECT recording_id, max_by(t, (g, -i)) AS onset_time FROM gr WHERE g IS NOT NULL GROUP BY 1)"""

ORACLES = {
    "asof_nearest": f"""WITH {_NEAR} SELECT recording_id, event_id AS i, {r('t', 't')}, {r('v', 'v')},
      CASE WHEN abs(t - c.t) <= 7200 THEN c.event_id END AS r_i, {r('CASE WHEN abs(t - c.t) <= 7200 THEN c.t END', 'r_t')}, {r('CASE WHEN abs(t - c.t) <= 7200 THEN c.v END', 'r_v')} FROM pk""",
    "asof_interpolate": f"""WITH {IRR}, k AS (SELECT recording_id, i, CASE WHEN i % 3 = 0 THEN v END AS v FROM irr),
      b AS (SELECT *, last_value(CASE WHEN v IS NOT NULL THEN i END IGNORE NULLS) OVER w AS pi, last_value(v IGNORE NULLS) OVER w AS pv,
        first_value(CASE WHEN v IS NOT NULL THEN i END IGNORE NULLS) OVER u AS ni, first_value(v IGNORE NULLS) OVER u AS nv FROM k
        WINDOW w AS (PARTITION BY recording_id ORDER BY i ROWS UNBOUNDED PRECEDING), u AS (PARTITION BY recording_id ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
      SELECT recording_id, i, {r('coalesce(v, pv + (nv - pv) * (i - pi) / (ni - pi))', 'v')} FROM b""",
    "resample_uniform": f"""WITH {IRR}, b AS (SELECT recording_id, min(t) AS t0, max(t) AS t1, CAST(floor((max(t) - min(t)) * (1 / 14400.0::DOUBLE)) AS BIGINT) + 1 AS n FROM irr GROUP BY 1 HAVING max(t) > min(t)),
      g AS (SELECT recording_id, k AS i, CASE WHEN n > 1 AND k = n - 1 THEN t1 WHEN n > 1 THEN t0 + k * ((t1 - t0) / (n - 1)) ELSE t0 END AS t FROM b, unnest(range(0, n)) AS u(k)),
      un AS (SELECT recording_id, t, 0 AS side, event_id AS k, v, NULL::BIGINT AS i FROM irr UNION ALL SELECT recording_id, t, 1, i, NULL, i FROM g),
      s AS (SELECT *, last_value(CASE WHEN side = 0 THEN t END IGNORE NULLS) OVER w AS pt, last_value(v IGNORE NULLS) OVER w AS pv,
        first_value(CASE WHEN side = 0 THEN t END IGNORE NULLS) OVER x AS nt, first_value(v IGNORE NULLS) OVER x AS nv FROM un
        WINDOW w AS (PARTITION BY recording_id ORDER BY t, side, k ROWS UNBOUNDED PRECEDING), x AS (PARTITION BY recording_id ORDER BY t, side, k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
      SELECT recording_id, i, {r('CASE WHEN nt IS NULL THEN pv ELSE pv + (nv - pv) * (t - pt) / (nt - pt) END', 'v')} FROM s WHERE side = 1""",
    "resample_waveform": f"""WITH p AS (SELECT vec_id AS recording_id, k, embedding AS x, k * (len(embedding) - 1) / 24.0::DOUBLE AS pos FROM embeddings, range(0, 25) AS u(k)),
      q AS (SELECT recording_id, k, pos - floor(pos) AS w, CAST(x[CAST(floor(pos) AS INTEGER) + 1] AS DOUBLE) AS a, CAST(x[least(CAST(floor(pos) AS INTEGER) + 2, len(x))] AS DOUBLE) AS b FROM p)
      SELECT recording_id, CAST(k AS INTEGER) AS k, {r('a + (b - a) * w', 'y')} FROM q""",
    "proximity_score": f"""WITH {_NEAR} SELECT recording_id, {r('avg(coalesce(greatest(1 - least(coalesce(t - p.t, 1e18), coalesce(n.t - t, 1e18)) / 86400, 0), 0))', 'score')}, count(*) AS n FROM nr GROUP BY 1""",
    "synchronize_status": f"""WITH {SIG}, b AS (SELECT recording_id, 2.75::DOUBLE AS w0, (max(t) * 0.5 + 2.0) * (recording_id % 3 + 1) + 0.5 AS w1, min(t) + 2.0 AS a0, max(t) + 2.0 AS a1 FROM sig GROUP BY 1),
      k AS (SELECT b.recording_id, min(t + 2.0) AS k0, max(t + 2.0) AS k1, count(*) AS n FROM b JOIN sig USING (recording_id) WHERE t + 2.0 BETWEEN w0 AND w1 GROUP BY 1),
      m AS (SELECT recording_id, count(*) AS n FROM sig JOIN b USING (recording_id) JOIN k USING (recording_id) WHERE i % 4 = 0 AND t + 2.0 BETWEEN greatest(w0, k0) AND least(w1, k1) GROUP BY 1)
      SELECT recording_id, coalesce(k.n, 0) AS audio_rows, coalesce(m.n, 0) AS motion_rows, {r('greatest(least(w1, a1) - greatest(w0, a0), 0) / (w1 - w0)', 'coverage')},
      CASE WHEN w1 < a0 OR w0 > a1 THEN 'window_outside_audio' WHEN coalesce(k.n, 0) = 0 THEN 'empty_audio_clip' WHEN coalesce(m.n, 0) = 0 THEN 'empty_motion_clip'
        WHEN w0 < a0 OR w1 > a1 THEN 'partial' ELSE 'ok' END AS status FROM b LEFT JOIN k USING (recording_id) LEFT JOIN m USING (recording_id)""",
    "validate_synced": f"""WITH {_NEAR}, g AS (SELECT recording_id, count(*) AS n_rows, count(v) AS audio_rows, count(CASE WHEN abs(t - c.t) <= 86400 THEN c.v END) AS motion_rows FROM pk GROUP BY 1)
      SELECT *, {r('motion_rows / n_rows', 'coverage')}, CASE WHEN audio_rows = 0 THEN 'no_audio' WHEN motion_rows = 0 THEN 'no_motion' WHEN motion_rows / n_rows < 0.5 THEN 'low_coverage' ELSE 'ok' END AS status FROM g""",
    "gap_sessions": f"""WITH {IRR}, p AS (SELECT recording_id, t, i, CASE WHEN t - lag(t) OVER w > 7200 THEN 1 ELSE 0 END AS b FROM irr WINDOW w AS (PARTITION BY recording_id ORDER BY i)),
      s AS (SELECT *, sum(b) OVER (PARTITION BY recording_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS g FROM p)
      SELECT recording_id, {r('min(t)', 'start')}, {r('max(t)', chr(34) + 'end' + chr(34))}, count(*) AS n_events FROM s GROUP BY recording_id, g HAVING count(*) >= 3""",
    "marker_pairs": f"""WITH {IRR}, m AS (SELECT recording_id, i, t, event, i // 4 + 1 AS p, last_value(CASE event WHEN 'error' THEN 'Fast Speed' WHEN 'signup' THEN 'Slow Speed' END IGNORE NULLS)
        OVER (PARTITION BY recording_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS section FROM irr),
      g AS (SELECT recording_id, section, CAST(p AS INTEGER) AS pass_number, min(t) FILTER (WHERE event = 'click') AS s, max(t) FILTER (WHERE event IN ('view', 'purchase')) AS e
        FROM m WHERE event IN ('click', 'view', 'purchase') GROUP BY ALL)
      SELECT recording_id, section, pass_number, {r('s', 'start')}, {r('e', chr(34) + 'end' + chr(34))} FROM g WHERE e > s""",
    "peak_pairs": f"""WITH {SIG}, {_EN.format(n=10, step=2, half=5)}, pk AS (SELECT recording_id, t, energy FROM en),
      pr AS (SELECT a.recording_id, a.t AS t1, b.t AS t2, a.energy AS e1, b.energy AS e2, abs(b.t - a.t - (0.7 + (a.recording_id % 5) * 0.1::DOUBLE)) AS gap_error
        FROM pk a JOIN pk b ON a.recording_id = b.recording_id AND b.t > a.t),
      rk AS (SELECT *, CASE WHEN gap_error <= 0.2 THEN 0 WHEN gap_error <= 0.3 THEN 1 END AS tolerance_rank FROM pr WHERE gap_error <= 0.3),
      o AS (SELECT *, row_number() OVER (PARTITION BY recording_id ORDER BY tolerance_rank, e1 + e2 DESC, gap_error, t1, t2) AS rn FROM rk)
      SELECT recording_id, {r('t1', 't1')}, {r('t2', 't2')}, {r('e1', 'e1')}, {r('e2', 'e2')}, {r('gap_error', 'gap_error')}, tolerance_rank FROM o WHERE rn = 1""",
    "find_peaks_full": f"""WITH RECURSIVE {SIG}, src AS (SELECT recording_id, i, ch2 AS v FROM sig), {peaks('pk', 'src', 'recording_id', 'v >= 0.2', 10, '0.3')}
      SELECT recording_id, i, {r('v', 'v')} FROM pk""",
    "heel_strikes": f"""WITH RECURSIVE {SIG}, src AS (SELECT recording_id, i, abs(ch2) AS v FROM sig), {peaks('pk', 'src', 'recording_id', 'v >= 0.02', 33, '0.02')}
      SELECT pk.recording_id, pk.i, {r('v', 'v')}, {r('t', 't')} FROM pk JOIN sig USING (recording_id, i)""",
    "local_extrema": f"""WITH {SIG}, d AS (SELECT recording_id, i, ch1 AS v, CASE WHEN ch1 = lag(ch1) OVER w THEN 0 ELSE 1 END AS c FROM sig WINDOW w AS (PARTITION BY recording_id ORDER BY i)),
      g AS (SELECT *, sum(c) OVER (PARTITION BY recording_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS g FROM d),
      q AS (SELECT recording_id, g, min(i) AS a, max(i) AS b, min(v) AS v FROM g GROUP BY 1, 2),
      n AS (SELECT *, lag(v) OVER w AS p, lead(v) OVER w AS x FROM q WINDOW w AS (PARTITION BY recording_id ORDER BY g))
      SELECT recording_id, CAST((a + b) // 2 AS BIGINT) AS i, {r('v', 'v')}, CASE WHEN v > p THEN 'max' ELSE 'min' END AS kind FROM n WHERE (v > p AND v > x) OR (v < p AND v < x)""",
    "peaks_of_waveforms": f"""WITH {WAVE}, n AS (SELECT *, lag(x) OVER w AS p, lead(x) OVER w AS q FROM wave WINDOW w AS (PARTITION BY recording_id ORDER BY i))
      SELECT recording_id, CAST(i AS INTEGER) AS i FROM n WHERE x > p AND x > q AND x >= 0.1""",
    "windowed_minima": f"""WITH {WAVE}, n AS (SELECT *, min(x) OVER (PARTITION BY recording_id ORDER BY i ROWS BETWEEN 6 PRECEDING AND 5 FOLLOWING) AS m FROM wave)
      SELECT recording_id, CAST(i AS INTEGER) AS i FROM n WHERE x = m AND i BETWEEN 6 AND 57""",
    "welch_psd": _WELCH,
    "bandpower_ratio": _BAND,
    "spectral_features": f"""WITH {WAVE}, ft AS ({_dft('wave', 'recording_id', 64)}), m AS (SELECT recording_id, f, sqrt(re * re + im * im) AS m FROM ft)
      SELECT recording_id, {r('sum(f * m) / (sum(m) + 1e-10)', 'centroid')}, {r('stddev_pop(m)', 'spread')}, {r('sum(m * m)', 'energy')} FROM m GROUP BY 1""",
    "stft_db": f"""WITH {SIG}, c AS (SELECT recording_id, i, (ch2 - avg(ch2) OVER (PARTITION BY recording_id)) AS x FROM sig),
      n AS (SELECT recording_id, count(*) AS n FROM sig GROUP BY 1), fr AS (SELECT recording_id, frame FROM n, unnest(range(0, (n - 32) // 8 + 1)) AS u(frame) WHERE n >= 32),
      s AS (SELECT fr.recording_id, frame, c.i - frame * 8 AS i, x * (0.5 - 0.5 * cos(2 * pi() * (c.i - frame * 8) / 32)) AS x FROM fr JOIN c ON c.recording_id = fr.recording_id AND c.i >= frame * 8 AND c.i < frame * 8 + 32),
      ft AS ({_dft('s', 'recording_id, frame', 32)})
      SELECT recording_id, frame, {r('(frame * 8 + 16) / 100.0', 't', 2)}, CAST(f AS INTEGER) AS bin, {r('CAST(20 * log10(sqrt(re * re + im * im) / 16 + 1e-12) AS FLOAT)', 'db', 2)} FROM ft WHERE f > 0 AND f < 16""",
    "stft_db_whole": f"""WITH {SIG}, c AS (SELECT recording_id, i, (ch2 - avg(ch2) OVER (PARTITION BY recording_id)) AS x FROM sig),
      n AS (SELECT recording_id, count(*) AS n FROM sig GROUP BY 1), fr AS (SELECT recording_id, frame FROM n, unnest(range(0, (n - 32) // 8 + 1)) AS u(frame) WHERE n >= 32),
      s AS (SELECT fr.recording_id, frame, c.i - frame * 8 AS i, x * (0.5 - 0.5 * cos(2 * pi() * (c.i - frame * 8) / 32)) AS x FROM fr JOIN c ON c.recording_id = fr.recording_id AND c.i >= frame * 8 AND c.i < frame * 8 + 32),
      ft AS ({_dft('s', 'recording_id, frame', 32)})
      SELECT recording_id, frame, {r('(frame * 8 + 16) / 100.0', 't', 2)}, CAST(f AS INTEGER) AS bin, {r('CAST(20 * log10(sqrt(re * re + im * im) / 16 + 1e-12) AS FLOAT)', 'db', 2)} FROM ft""",
    "stomp_energy": f"WITH {_STOMP} SELECT recording_id, {r('rms_time', 'rms_time')}, {r('onset_time', 'onset_time')} FROM a JOIN b USING (recording_id)",
    "stomp_consensus": f"""WITH {_STOMP}, d AS (SELECT recording_id, rms_time, onset_time, rms_time + (recording_id % 4) * 0.2::DOUBLE AS freq_time FROM a JOIN b USING (recording_id)),
      f AS (SELECT *, abs(onset_time - rms_time) <= 0.5 AS o, abs(freq_time - rms_time) <= 0.5 AS q FROM d)
      SELECT recording_id, {r('rms_time', 'rms_time')}, {r('onset_time', 'onset_time')}, {r('freq_time', 'freq_time')},
      {r('(rms_time + CASE WHEN o THEN onset_time ELSE 0 END + CASE WHEN q THEN freq_time ELSE 0 END) / (1 + CAST(o AS INTEGER) + CAST(q AS INTEGER))', 'consensus_time')},
      'rms' || CASE WHEN o THEN ',onset' ELSE '' END || CASE WHEN q THEN ',freq' ELSE '' END AS consensus_methods,
      {r('greatest(rms_time, onset_time, freq_time) - least(rms_time, onset_time, freq_time)', 'agreement_span')} FROM f""",
}
ORACLES["stft_db"] = ORACLES["stft_db_whole"]
