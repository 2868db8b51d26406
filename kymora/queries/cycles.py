"""Cycle cutting, quality rules and feature queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kymora.operators import cycles as cy
from kymora.operators import features as ft
from kymora.operators import intervals as iv
from kymora.queries.common import SIG, merged, peaks, r, rounded
from kymora.session import durable
from kymora.sources import adapters as ad

K = ["recording_id"]
CK = ["recording_id", "cycle_index"]
FS = ad.SIGNAL_FS


def _angled(spark: SparkSession, sf: str) -> DataFrame:
    """The second channel read as a knee angle in degrees."""
    return ad.signal_multi(spark, sf).withColumn("angle", F.col("ch2") * 90)


def _blocks(spark: SparkSession, sf: str) -> DataFrame:
    """Cycles of exactly one hundred samples."""
    return _angled(spark, sf).withColumn("cycle_index", F.floor(F.col("i") / 100).cast("int"))


def cycles_walk(spark: SparkSession, sf: str) -> DataFrame:
    return cy.cut_cycles(_angled(spark, sf), K, "angle", FS, "walk")


def cycles_sit_to_stand(spark: SparkSession, sf: str) -> DataFrame:
    return cy.cut_cycles(_angled(spark, sf), K, "angle", FS / 4, "sit_to_stand")


def cycles_flexion_extension(spark: SparkSession, sf: str) -> DataFrame:
    return cy.cut_cycles(_angled(spark, sf), K, "angle", FS / 4, "flexion_extension")


def samples_of_cycles(spark: SparkSession, sf: str) -> DataFrame:
    """Samples of every second block of fifty, through the carried cycle start."""
    s = ad.signal_multi(spark, sf)
    c = s.filter(F.col("i") % 100 == 0).select("recording_id", F.floor(F.col("i") / 100).cast("int").alias("cycle_index"),
                                             F.col("i").alias("first_i"), (F.col("i") + 49).alias("last_i"))
    return cy.samples_of_cycles(s.select("recording_id", "i", "t"), c, K).select("recording_id", "cycle_index", "i")


def cycle_energy(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(cy.cycle_energy(_blocks(spark, sf), CK))


def cycle_rom(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(cy.range_of_motion(_blocks(spark, sf), CK, "angle"))


def cycle_stats(spark: SparkSession, sf: str) -> DataFrame:
    b = cy.cycle_bounds(_blocks(spark, sf), CK)
    return rounded(cy.cycle_statistics(b, K, F.col("n") == 100))


def cycle_ordinals(spark: SparkSession, sf: str) -> DataFrame:
    e = cy.cycle_energy(_blocks(spark, sf), CK)
    return cy.number_by_verdict(e, K, F.col("acoustic_energy") >= 1.12).select("recording_id", "cycle_index", "is_clean", "ordinal")


def phase_rms(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(cy.phase_levels(_blocks(spark, sf), CK, "angle", maneuver="walk"))


def phase_score(spark: SparkSession, sf: str) -> DataFrame:
    levels = cy.phase_levels(_blocks(spark, sf).withColumn("ch1", F.col("ch1") * F.when(F.col("recording_id") % 3 == 0, 25.0).otherwise(1.0)), CK, "angle", maneuver="sit_to_stand")
    return rounded(cy.phase_score(levels, CK))


def shape_walk(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(cy.shape_rules(_blocks(spark, sf), CK, "angle", "walk"))


def shape_sit_to_stand(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(cy.shape_rules(_blocks(spark, sf), CK, "angle", "sit_to_stand"))


def shape_flexion_extension(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(cy.shape_rules(_blocks(spark, sf), CK, "angle", "flexion_extension"))


def two_stage_split(spark: SparkSession, sf: str) -> DataFrame:
    b = _blocks(spark, sf)
    return rounded(cy.two_stage(cy.cycle_energy(b, CK), cy.shape_rules(b, CK, "angle", "walk"), CK, 1.1))


def sound_walk(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(cy.sound_rules(_blocks(spark, sf), CK, "walk"))


def sound_sit_to_stand(spark: SparkSession, sf: str) -> DataFrame:
    """Verdict, code and judged value."""
    return rounded(cy.sound_rules(_blocks(spark, sf), CK, "sit_to_stand"))


def sync_quality_walk(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(cy.sync_quality(_blocks(spark, sf), CK, "angle", "walk"))


def sync_quality_flexion(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(cy.sync_quality(_blocks(spark, sf), CK, "angle", "flexion_extension"))


def resampled_cycles(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(cy.resample_cycles(_blocks(spark, sf), CK, "ch2", 33))


def _templates(spark: SparkSession, sf: str) -> DataFrame:
    """The mean waveform of each embedding label."""
    w = ad.waveform(spark, sf).select("label", F.posexplode("x").alias("k", "x"))
    return w.groupBy("label", "k").agg(F.avg("x").alias("ref")).select(F.col("label").alias("template"), "k", "ref")


def template_match(spark: SparkSession, sf: str) -> DataFrame:
    """Cycles and mean waveforms of embedding labels that are close, warped distance included."""
    return rounded(cy.template_match(_blocks(spark, sf), _templates(spark, sf), CK, "ch2", 64, 0.1, 0.8))


def template_correlation(spark: SparkSession, sf: str) -> DataFrame:
    """Every cycle with every template, short cycles too."""
    return rounded(cy.template_match(_blocks(spark, sf), _templates(spark, sf), CK, "ch2", 64, 0.1))


def intermittent_artifacts(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(cy.intermittent_artifacts(_blocks(spark, sf), CK, FS, sigma=0.5, min_s=0.01))


def cycle_periodic_noise(spark: SparkSession, sf: str) -> DataFrame:
    halves = ad.signal_multi(spark, sf).withColumn("cycle_index", F.floor(F.col("i") / 300).cast("int"))
    return cy.periodic_noise(halves, CK, FS, threshold=0.2)


def _cycle_intervals(b: DataFrame) -> DataFrame:
    parts = {
        "intermittent": cy.intermittent_artifacts(b, CK, FS, sigma=0.5, min_s=0.01),
        "continuous": cy.cycle_bounds(b, CK).filter("recording_id % 3 = 0").select(*CK, F.lit("ch2").alias("channel"), "start", (F.col("start") + 0.25).alias("end")),
    }
    return cy.cycle_artifacts(parts, CK)


def cycle_artifact_table(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_cycle_intervals(_blocks(spark, sf)))


def cycle_artifact_record(spark: SparkSession, sf: str) -> DataFrame:
    b = _blocks(spark, sf)
    rec = cy.artifact_record(cy.cycle_bounds(b, CK), _cycle_intervals(b).filter("kind <> 'all'"), CK, recorded_at=F.lit("2024-03-12 12:40:51").cast("timestamp_ntz"))
    arrays = [c for c, t in rec.dtypes if t == "array<double>"]
    text = [F.array_join(F.transform(c, lambda x: F.round(x, 4).cast("string")), ",").alias(c) for c in arrays]
    return rounded(rec.select(*[c for c in rec.columns if c not in arrays and c != "audio_qc_failures"], F.array_join("audio_qc_failures", ",").alias("failures"), *text))


def cycle_verdicts(spark: SparkSession, sf: str) -> DataFrame:
    """Energy, shape, artifacts, sound against motion and bad intervals rolled into one row per cycle."""
    b = _blocks(spark, sf)
    energy, shape = cy.cycle_energy(b, CK), durable(cy.shape_rules(b, CK, "angle", "walk"))
    artifacts = durable(_cycle_intervals(b))
    windows = cy.cycle_bounds(b, CK).select(*CK, F.col("start").alias("w_start"), F.col("end").alias("w_end"))
    bad = iv.merge_intervals(artifacts.filter("kind <> 'all'").select("recording_id", "start", "end"), K)
    overlap = iv.in_bad_interval(iv.overlap_fraction(windows, bad, K))
    mics = windows.withColumn("channel", F.explode(F.array(*[F.lit(c) for c in _CH])))
    own = iv.in_bad_interval(iv.overlap_fraction(mics, artifacts.filter("kind = 'all'").select("recording_id", "channel", "start", "end"), [*K, "channel"]))
    return rounded(cy.verdicts(cy.two_stage(energy, shape, CK, 1.1), artifacts, cy.sync_quality(b, CK, "angle", "walk"), CK, overlap, own))


def channel_features(spark: SparkSession, sf: str) -> DataFrame:
    """All four channels and all their correlations."""
    return rounded(ft.channel_features(ad.signal_multi(spark, sf), K))


def angle_features(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(ft.angle_features(_angled(spark, sf), K, "angle"))


def temporal_features(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(ft.temporal_features(_blocks(spark, sf), CK))


def cycle_features(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(ft.cycle_features(_blocks(spark, sf), CK, "angle"))


def participant_features(spark: SparkSession, sf: str) -> DataFrame:
    """Every feature of all four channels."""
    f = durable(ft.channel_features(_blocks(spark, sf), CK))
    names = [c for c in f.columns if c not in CK]
    out = None
    for stat in ("mean", "median", "max", "min"):
        p = ft.participant_features(f, K, names, stat).withColumnsRenamed({n: f"{n}_{stat}" for n in names})
        out = p if out is None else out.join(p, K)
    return rounded(out)


QUERIES = {f.__name__: f for f in (
    cycles_walk, cycles_sit_to_stand, cycles_flexion_extension, samples_of_cycles, cycle_energy, cycle_rom, cycle_stats, cycle_ordinals,
    phase_rms, phase_score, shape_walk, shape_sit_to_stand, shape_flexion_extension, two_stage_split, sound_walk, sound_sit_to_stand,
    sync_quality_walk, sync_quality_flexion, resampled_cycles, template_match, template_correlation, intermittent_artifacts,
    cycle_periodic_noise, cycle_artifact_table, cycle_artifact_record, cycle_verdicts, channel_features, angle_features,
    temporal_features, cycle_features, participant_features,
)}
WHOLE = ("sound_sit_to_stand", "template_correlation", "channel_features", "participant_features")
QUERIES |= {f"{name}_whole": QUERIES[name] for name in WHOLE}  # names of an earlier time

_BL = f"{SIG}, bl AS (SELECT *, CAST(i // 100 AS INTEGER) AS cycle_index, ch2 * 90 AS angle FROM sig)"
_CH = ("ch1", "ch2", "ch3", "ch4")
_ENERGY = f"""{_BL}, lg AS (SELECT *, {', '.join(f'lag({c}) OVER w AS p_{c}' for c in ('t', *_CH))} FROM bl WINDOW w AS (PARTITION BY recording_id, cycle_index ORDER BY i)),
  en AS (SELECT recording_id, cycle_index, coalesce(sum(({' + '.join(f'abs({c}) + abs(p_{c})' for c in _CH)}) * (t - p_t) / 2), 0) AS e FROM lg GROUP BY 1, 2)"""


def _phases(names: tuple[str, str, str], scale: str = "ch1") -> str:
    a, b, c = names
    return f"""{_BL}, qs AS (SELECT recording_id, cycle_index, quantile_cont(angle, 0.33) AS a, quantile_cont(angle, 0.67) AS b FROM bl GROUP BY 1, 2 HAVING count(*) >= 10),
      pl AS (SELECT bl.*, {scale} AS c1, ph FROM bl JOIN qs USING (recording_id, cycle_index), (VALUES ('{a}'), ('{b}'), ('{c}')) AS p(ph)
        WHERE (ph = '{a}' AND angle <= a) OR (ph = '{b}' AND angle BETWEEN a AND b) OR (ph = '{c}' AND angle >= b)),
      lv AS (SELECT recording_id, cycle_index, ph AS phase, count(*) AS n, CASE WHEN count(*) >= 5 THEN
        (sqrt(avg(c1 * c1)) + sqrt(avg(ch2 * ch2)) + sqrt(avg(ch3 * ch3)) + sqrt(avg(ch4 * ch4))) / 4 END AS phase_rms FROM pl GROUP BY 1, 2, 3)"""


def _fr(h: int) -> str:
    return f"OVER (PARTITION BY recording_id, cycle_index ORDER BY i ROWS BETWEEN {h} PRECEDING AND {h} FOLLOWING)"


_BURST = f"""{_BL}, ll AS ({' UNION ALL '.join(f"SELECT recording_id, cycle_index, '{c}' AS channel, i, t, {c} AS x FROM bl" for c in _CH)}),
  bs AS (SELECT *, sqrt(avg(x * x) OVER f) > sqrt(avg(x * x) OVER s) + 0.5 * sqrt(greatest(avg(x * x) OVER s - (avg(x) OVER s) * (avg(x) OVER s), 0)) AS bad FROM ll
    WINDOW f AS (PARTITION BY recording_id, cycle_index, channel ORDER BY i ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING),
           s AS (PARTITION BY recording_id, cycle_index, channel ORDER BY i ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)),
  bi AS (SELECT recording_id, cycle_index, channel, min(t) AS s, max(t) AS e FROM (SELECT *, i - row_number() OVER (PARTITION BY recording_id, cycle_index, channel ORDER BY i) AS g
    FROM bs WHERE bad) GROUP BY recording_id, cycle_index, channel, g HAVING max(t) - min(t) BETWEEN 0.01 AND 4)"""


def _moments(c: str) -> str:
    return ", ".join([
        r(f"avg({c})", f"{c}_mean"), r(f"stddev_pop({c})", f"{c}_std"), r(f"sqrt(avg({c} * {c}))", f"{c}_rms"), r(f"max(abs({c}))", f"{c}_peak"),
        r(f"max({c}) - min({c})", f"{c}_peak_to_peak"), r(f"sum({c} * {c})", f"{c}_energy"), r(f"kurtosis({c})", f"{c}_kurtosis"), r(f"skewness({c})", f"{c}_skewness")])


def _numbers(c: str) -> dict[str, str]:
    """Name and unrounded expression of every moment of a channel."""
    return {f"{c}_mean": f"avg({c})", f"{c}_std": f"stddev_pop({c})", f"{c}_rms": f"sqrt(avg({c} * {c}))", f"{c}_peak": f"max(abs({c}))",
            f"{c}_peak_to_peak": f"max({c}) - min({c})", f"{c}_energy": f"sum({c} * {c})", f"{c}_kurtosis": f"kurtosis({c})", f"{c}_skewness": f"skewness({c})"}


_ALL = {k: v for c in (*_CH, "mid") for k, v in _numbers(c).items()} | {
    f"corr_{a}_{b}": f"CASE WHEN min({a}) < max({a}) AND min({b}) < max({b}) THEN corr({a}, {b}) END" for k, a in enumerate(_CH) for b in _CH[k + 1 :]}
_ALL = {k.replace("mid_", "avg_"): v for k, v in _ALL.items()}

_AN = f"{SIG}, an AS (SELECT recording_id, i, ch2 * 90 AS v FROM sig), neg AS (SELECT recording_id, i, -v AS v FROM an)"
_NUMBER = "CAST(row_number() OVER (PARTITION BY recording_id ORDER BY first_i) - 1 AS INTEGER) AS cycle_index"


def _verdict(name: str, rules: list[tuple[str, str, str]], more: str = "") -> str:
    """Columns of the first rule that fails: (condition, code, judged value)."""
    code = " ".join(f"WHEN {c} THEN '{k}'" for c, k, _ in rules)
    value = " ".join(f"WHEN {c} THEN CAST({v} AS DOUBLE)" for c, _, v in rules)
    return f"recording_id, cycle_index, CASE {code} END IS NULL AS {name}_ok, CASE {code} END AS {name}_reason, {r(f'CASE {value} END', f'{name}_value')}{more}"


def _shape(maneuver: str) -> str:
    """CTEs ending in sh: the numbers of every cycle that its shape is judged by."""
    share = 0.5 if maneuver == "sit_to_stand" else 0.3
    sign = "CASE WHEN a0 >= 45 THEN -1.0::DOUBLE ELSE 1.0::DOUBLE END" if maneuver == "sit_to_stand" else "1.0::DOUBLE"
    return f"""{_BL}, rg AS (SELECT recording_id, cycle_index, count(*) AS n, max(angle) - min(angle) AS rom, min_by(angle, i) AS a0, max_by(angle, i) AS a1, min(i) AS i0 FROM bl GROUP BY 1, 2),
      src AS (SELECT recording_id, cycle_index, i - i0 AS i, angle * {sign} AS v, greatest(rom * {share}::DOUBLE, 5) AS need FROM bl JOIN rg USING (recording_id, cycle_index)),
      {peaks('pk', 'src', 'recording_id, cycle_index', need='need')},
      pp AS (SELECT recording_id, cycle_index, count(*) AS n_peaks, min(i) AS first_peak, max(v) AS top, min(i) FILTER (WHERE v = (SELECT max(q.v) FROM pk q WHERE q.recording_id = pk.recording_id AND q.cycle_index = pk.cycle_index)) AS best FROM pk GROUP BY 1, 2),
      sh AS (SELECT rg.*, coalesce(n_peaks, 0) AS n_peaks, first_peak / n AS first_at, best / n AS best_at, abs(a1 - a0) AS diff, CASE WHEN a0 >= 45 THEN a0 + top ELSE top - a0 END AS depth FROM rg LEFT JOIN pp USING (recording_id, cycle_index))"""


_SHORT = [("n < 10", "few_samples", "n")]
_SHAPE_RULES = {
    "walk": [*_SHORT, ("rom < 20", "small_range", "rom"), ("diff > 10", "open_ends", "diff"), ("n_peaks = 0", "no_peak", "0"), ("n_peaks > 2", "extra_peaks", "n_peaks"), ("NOT first_at BETWEEN 0.2 AND 0.8", "peak_position", "first_at")],
    "flexion_extension": [*_SHORT, ("rom < 40", "small_range", "rom"), ("diff > 15", "open_ends", "diff"), ("n_peaks = 0", "no_peak", "0"), ("n_peaks > 3", "extra_peaks", "n_peaks"), ("NOT best_at BETWEEN 0.25 AND 0.75", "peak_position", "best_at")],
    "sit_to_stand": [*_SHORT, ("rom < 40", "small_range", "rom"), ("diff > 20", "open_ends", "diff"), ("n_peaks = 0", "no_peak", "0"), ("NOT best_at BETWEEN 0.15 AND 0.85", "peak_position", "best_at"), ("depth < rom * 0.5", "small_depth", "depth")],
}
_SOUND_RULES = [("hi < 0.001", "quiet", "hi"), ("n < 10", "few_samples", "n"), ("m = 0", "zero_mean", "m"), ("s / m < 0.1", "flat", "s / m"), ("n_peaks = 0", "no_peak", "0"), ("main > 0.8", "peak_position", "main")]

ORACLES = {
    "cycles_sit_to_stand": f"""WITH RECURSIVE {_AN}, {peaks('lo', 'neg', 'recording_id', gap=50, need='20')},
      nx AS (SELECT recording_id, i, lead(i) OVER (PARTITION BY recording_id ORDER BY i) AS j, count(*) OVER (PARTITION BY recording_id) AS n FROM lo),
      cut AS (SELECT recording_id, i AS first_i, j - 1 AS last_i FROM nx WHERE j - i > 10
        UNION ALL SELECT recording_id, min(i), max(i) FROM an WHERE recording_id NOT IN (SELECT recording_id FROM nx WHERE n > 1) GROUP BY 1 HAVING max(i) > min(i))
      SELECT recording_id, {_NUMBER}, first_i, last_i FROM cut""",
    "cycles_flexion_extension": f"""WITH RECURSIVE {_AN}, {peaks('lo', 'neg', 'recording_id', gap=45, need='10')}, {peaks('up', 'an', 'recording_id', need='10')},
      nx AS (SELECT recording_id, i, lead(i) OVER (PARTITION BY recording_id ORDER BY i) AS j FROM lo),
      cut AS (SELECT recording_id, i AS first_i, j - 1 AS last_i FROM nx WHERE j - i > 10 AND EXISTS (SELECT 1 FROM up WHERE up.recording_id = nx.recording_id AND up.i >= nx.i AND up.i < nx.j))
      SELECT recording_id, {_NUMBER}, first_i, last_i FROM cut""",
    **{f"shape_{m}": f"WITH RECURSIVE {_shape(m)} SELECT {_verdict('shape', rules, ', ' + r('rom', 'rom'))} FROM sh" for m, rules in _SHAPE_RULES.items()},
    "two_stage_split": f"""WITH RECURSIVE {_shape('walk')}, v AS (SELECT {_verdict('shape', _SHAPE_RULES['walk'], ', rom')} FROM sh),
      e AS (WITH {_ENERGY} SELECT recording_id, cycle_index, e FROM en)
      SELECT recording_id, cycle_index, {r('e', 'acoustic_energy')}, {r('rom', 'rom')}, e < 1.1 AS energy_fail, NOT shape_ok AS shape_fail, e < 1.1 OR NOT shape_ok AS is_outlier,
        CASE WHEN e < 1.1 THEN 'low_acoustic_energy' ELSE shape_reason END AS outlier_reason FROM v JOIN e USING (recording_id, cycle_index)""",
    "sound_walk": f"""WITH RECURSIVE {_BL}, ev AS (SELECT recording_id, cycle_index, i - min(i) OVER (PARTITION BY recording_id, cycle_index) AS i, sqrt((ch1*ch1 + ch2*ch2 + ch3*ch3 + ch4*ch4) / 4) AS v FROM bl),
      st AS (SELECT recording_id, cycle_index, count(*) AS n, avg(v) AS m, stddev_pop(v) AS s, min(v) AS lo, max(v) AS hi FROM ev GROUP BY 1, 2),
      src AS (SELECT ev.*, greatest((hi - lo) * 0.2::DOUBLE, m * 0.5::DOUBLE) AS need FROM ev JOIN st USING (recording_id, cycle_index)), {peaks('pk', 'src', 'recording_id, cycle_index', need='need')},
      pp AS (SELECT recording_id, cycle_index, count(*) AS n_peaks, arg_max(i, v - i * 1e-12::DOUBLE) AS main_i FROM pk GROUP BY 1, 2),
      so AS (SELECT st.*, coalesce(n_peaks, 0) AS n_peaks, main_i / n AS main FROM st LEFT JOIN pp USING (recording_id, cycle_index))
      SELECT {_verdict('sound', _SOUND_RULES)} FROM so""",
    "samples_of_cycles": f"WITH {SIG} SELECT recording_id, CAST(i // 100 AS INTEGER) AS cycle_index, i FROM sig WHERE i % 100 < 50",
    "cycle_energy": f"WITH {_ENERGY} SELECT recording_id, cycle_index, {r('e', 'acoustic_energy')} FROM en",
    "cycle_rom": f"WITH {_BL} SELECT recording_id, cycle_index, {r('max(angle) - min(angle)', 'rom')}, count(*) AS n_rows, count(angle) AS n_valid FROM bl GROUP BY 1, 2",
    "cycle_stats": f"""WITH {_BL}, c AS (SELECT recording_id, cycle_index, count(*) AS n, max(t) - min(t) AS d FROM bl GROUP BY 1, 2)
      SELECT recording_id, count(*) AS total_cycles, count(*) FILTER (WHERE n = 100) AS clean_cycles, count(*) FILTER (WHERE n <> 100) AS outlier_cycles,
      {r('avg(d)', 'mean_duration')}, {r('min(d)', 'min_duration')}, {r('max(d)', 'max_duration')}, {r('quantile_cont(d, 0.5)', 'median_duration')} FROM c GROUP BY 1""",
    "cycle_ordinals": f"""WITH {_ENERGY} SELECT recording_id, cycle_index, e >= 1.12 AS is_clean,
      CAST(row_number() OVER (PARTITION BY recording_id, e >= 1.12 ORDER BY cycle_index) - 1 AS INTEGER) AS ordinal FROM en""",
    "phase_rms": f"""WITH {_phases(('extension', 'mid_phase', 'flexion'))} SELECT recording_id, cycle_index, phase, n, {r('phase_rms', 'phase_rms')},
      coalesce(phase_rms BETWEEN CASE phase WHEN 'flexion' THEN 0.001 ELSE 0.01 END AND CASE phase WHEN 'flexion' THEN 5 ELSE 10 END, false) AS in_range FROM lv""",
    "phase_score": f"""WITH {_phases(('standing', 'transition', 'sitting'), 'ch1 * CASE WHEN recording_id % 3 = 0 THEN 25.0::DOUBLE ELSE 1.0::DOUBLE END')},
      s AS (SELECT recording_id, cycle_index, count(*) FILTER (WHERE phase_rms BETWEEN CASE phase WHEN 'transition' THEN 0.01 ELSE 0.001 END AND CASE phase WHEN 'transition' THEN 10 ELSE 5 END) / 3.0::DOUBLE AS x FROM lv GROUP BY 1, 2)
      SELECT recording_id, cycle_index, {r('x', 'phase_score')}, x >= 0.75 AS phase_pass FROM s""",
    "sound_sit_to_stand": f"""WITH {_BL}, e AS (SELECT recording_id, cycle_index, i, sqrt((ch1*ch1 + ch2*ch2 + ch3*ch3 + ch4*ch4) / 4) AS e FROM bl),
      n AS (SELECT recording_id, cycle_index, count(*) AS n, max(e) AS hi, avg(e) AS m FROM e GROUP BY 1, 2),
      th AS (SELECT recording_id, cycle_index, n, hi, avg(e) FILTER (WHERE i % 100 < n // 3) AS a, avg(e) FILTER (WHERE i % 100 >= n // 3 AND i % 100 < 2 * (n // 3)) AS b,
        avg(e) FILTER (WHERE i % 100 >= 2 * (n // 3)) AS c FROM e JOIN n USING (recording_id, cycle_index) GROUP BY ALL)
      SELECT recording_id, cycle_index, CASE WHEN hi < 0.001 OR n < 10 THEN false WHEN b < a OR b < c THEN false WHEN b / greatest(a, c) < 1.2 THEN false ELSE true END AS sound_ok FROM th""",
    "resampled_cycles": f"""WITH {_BL}, n AS (SELECT recording_id, cycle_index, count(*) AS n FROM bl GROUP BY 1, 2),
      g AS (SELECT recording_id, cycle_index, k, n, k * (n - 1) / 32.0::DOUBLE AS pos FROM n, range(0, 33) AS u(k)),
      j AS (SELECT g.*, a.ch2 AS lo, b.ch2 AS hi FROM g JOIN bl a ON a.recording_id = g.recording_id AND a.cycle_index = g.cycle_index AND a.i % 100 = CAST(floor(pos) AS BIGINT)
        LEFT JOIN bl b ON b.recording_id = g.recording_id AND b.cycle_index = g.cycle_index AND b.i % 100 = CAST(floor(pos) AS BIGINT) + 1)
      SELECT recording_id, cycle_index, CAST(k AS INTEGER) AS k, {r('lo + (coalesce(hi, lo) - lo) * (pos - floor(pos))', 'y')} FROM j""",
    "template_correlation": f"""WITH {_BL}, n AS (SELECT recording_id, cycle_index FROM bl GROUP BY 1, 2 HAVING count(*) = 100),
      g AS (SELECT recording_id, cycle_index, k, k * 99 / 63.0::DOUBLE AS pos FROM n, range(0, 64) AS u(k)),
      j AS (SELECT g.*, a.ch2 AS lo, b.ch2 AS hi FROM g JOIN bl a ON a.recording_id = g.recording_id AND a.cycle_index = g.cycle_index AND a.i % 100 = CAST(floor(pos) AS BIGINT)
        LEFT JOIN bl b ON b.recording_id = g.recording_id AND b.cycle_index = g.cycle_index AND b.i % 100 = CAST(floor(pos) AS BIGINT) + 1),
      y AS (SELECT recording_id, cycle_index, k, lo + (coalesce(hi, lo) - lo) * (pos - floor(pos)) AS y FROM j),
      t AS (SELECT label AS template, k - 1 AS k, avg(CAST(embedding[k] AS DOUBLE)) AS ref FROM embeddings, range(1, 65) AS u(k) GROUP BY 1, 2),
      c AS (SELECT recording_id, cycle_index, template, corr(y, ref) AS r FROM y JOIN t USING (k) GROUP BY 1, 2, 3)
      SELECT recording_id, cycle_index, template, {r('r', 'r')}, r >= 0.1 AS match FROM c""",
    "template_correlation_whole": f"""WITH {_BL}, n AS (SELECT recording_id, cycle_index, count(*) AS n FROM bl GROUP BY 1, 2),
      g AS (SELECT recording_id, cycle_index, k, k * (n - 1) / 63.0::DOUBLE AS pos FROM n, range(0, 64) AS u(k)),
      j AS (SELECT g.*, a.ch2 AS lo, b.ch2 AS hi FROM g JOIN bl a ON a.recording_id = g.recording_id AND a.cycle_index = g.cycle_index AND a.i % 100 = CAST(floor(pos) AS BIGINT)
        LEFT JOIN bl b ON b.recording_id = g.recording_id AND b.cycle_index = g.cycle_index AND b.i % 100 = CAST(floor(pos) AS BIGINT) + 1),
      y AS (SELECT recording_id, cycle_index, k, lo + (coalesce(hi, lo) - lo) * (pos - floor(pos)) AS y FROM j),
      t AS (SELECT label AS template, k - 1 AS k, avg(CAST(embedding[k] AS DOUBLE)) AS ref FROM embeddings, range(1, 65) AS u(k) GROUP BY 1, 2),
      c AS (SELECT recording_id, cycle_index, template, CASE WHEN min(y) < max(y) THEN corr(y, ref) END AS r FROM y JOIN t USING (k) GROUP BY 1, 2, 3)
      SELECT recording_id, cycle_index, template, {r('r', 'r')}, coalesce(r >= 0.1, false) AS match FROM c""",
    "intermittent_artifacts": f"WITH {_BURST} SELECT recording_id, cycle_index, channel, {r('s', 'start')}, {r('e', chr(34) + 'end' + chr(34))} FROM bi",
    "cycle_artifact_table": f"""WITH {_BURST}, ct AS (SELECT recording_id, cycle_index, 'ch2' AS channel, min(t) AS s, min(t) + 0.25 AS e FROM bl WHERE recording_id % 3 = 0 GROUP BY 1, 2),
      u AS (SELECT * FROM bi UNION ALL SELECT * FROM ct), al AS (SELECT *, 'intermittent' AS kind FROM bi UNION ALL SELECT *, 'continuous' FROM ct
        UNION ALL SELECT *, 'all' FROM ({merged('u', 'recording_id, cycle_index, channel', 0.0)}))
      SELECT recording_id, cycle_index, channel, kind, {r('s', 'start')}, {r('e', chr(34) + 'end' + chr(34))} FROM al""",
    "sound_sit_to_stand_whole": f"""WITH {_BL}, e AS (SELECT recording_id, cycle_index, i, sqrt((ch1*ch1 + ch2*ch2 + ch3*ch3 + ch4*ch4) / 4) AS e FROM bl),
      n AS (SELECT recording_id, cycle_index, count(*) AS n, max(e) AS hi, avg(e) AS m FROM e GROUP BY 1, 2),
      th AS (SELECT recording_id, cycle_index, n, hi, m, avg(e) FILTER (WHERE i % 100 < n // 3) AS a, avg(e) FILTER (WHERE i % 100 >= n // 3 AND i % 100 < 2 * (n // 3)) AS b,
        avg(e) FILTER (WHERE i % 100 >= 2 * (n // 3)) AS c FROM e JOIN n USING (recording_id, cycle_index) GROUP BY ALL)
      SELECT {_verdict('sound', [*_SOUND_RULES[:3], ('b < a OR b < c', 'no_middle_rise', 'b / greatest(a, c)'), ('b / greatest(a, c) < 1.2', 'small_middle_rise', 'b / greatest(a, c)')])} FROM th""",
    "channel_features_whole": f"""WITH {SIG}, s AS (SELECT *, (ch1 + ch2 + ch3 + ch4) / 4 AS mid FROM sig)
      SELECT recording_id, {', '.join(r(v, k) for k, v in _ALL.items())} FROM s GROUP BY 1""",
    "participant_features_whole": f"""WITH {_BL}, s AS (SELECT *, (ch1 + ch2 + ch3 + ch4) / 4 AS mid FROM bl),
      f AS (SELECT recording_id, cycle_index, {', '.join(f'{v} AS {k}' for k, v in _ALL.items())} FROM s GROUP BY 1, 2)
      SELECT recording_id, {', '.join(r(fn.format(x=k), f'{k}_{n}') for n, fn in (('mean', 'avg({x})'), ('median', 'quantile_cont({x}, 0.5)'), ('max', 'max({x})'), ('min', 'min({x})')) for k in _ALL)}
      FROM f GROUP BY 1""",
    "channel_features": f"""WITH {SIG}, s AS (SELECT *, (ch1 + ch2) / 2 AS avg FROM sig) SELECT recording_id, {_moments('ch1')}, {_moments('ch2')}, {_moments('avg').replace('avg(avg)', 'avg(s.avg)')},
      {r('corr(ch1, ch2)', 'corr_ch1_ch2')} FROM s GROUP BY 1""",
    "angle_features": f"""WITH {_BL} SELECT recording_id, {r('avg(angle)', 'knee_angle_mean')}, {r('stddev_pop(angle)', 'knee_angle_std')}, {r('min(angle)', 'knee_angle_min')},
      {r('max(angle)', 'knee_angle_max')}, {r('max(angle) - min(angle)', 'knee_angle_range')} FROM bl GROUP BY 1""",
    "temporal_features": f"""WITH {_BL}, g AS (SELECT recording_id, cycle_index, max(t) - min(t) AS d, count(*) AS num_samples FROM bl GROUP BY 1, 2)
      SELECT recording_id, cycle_index, {r('d', 'duration')}, num_samples, {r('CASE WHEN d > 0 THEN num_samples / d END', 'sample_rate')} FROM g""",
    "participant_features": f"""WITH {_BL}, f AS (SELECT recording_id, cycle_index, sqrt(avg(ch1 * ch1)) AS a, stddev_pop(ch2) AS b, CASE WHEN stddev_pop(ch1) > 0 AND stddev_pop(ch2) > 0 THEN corr(ch1, ch2) END AS c FROM bl GROUP BY 1, 2)
      SELECT recording_id, {', '.join(r(fn.format(x=x), f'{n}_{s}') for s, fn in (('mean', 'avg({x})'), ('median', 'quantile_cont({x}, 0.5)'), ('max', 'max({x})'), ('min', 'min({x})'))
        for n, x in (('ch1_rms', 'a'), ('ch2_std', 'b'), ('corr_ch1_ch2', 'c')))} FROM f GROUP BY 1""",
}
ORACLES |= {name: ORACLES[f"{name}_whole"] for name in WHOLE}
