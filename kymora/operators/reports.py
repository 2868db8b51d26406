"""Report sheets as queries over the metadata tables, for one scope or for the whole cohort."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kymora.functions import scalars as sc

SCOPE = ("study_id", "knee", "maneuver")


def in_scope(df: DataFrame, study_id: int | None, maneuver: str | None, knee: str | None) -> DataFrame:
    for name, value in (("study_id", study_id), ("maneuver", maneuver), ("knee", knee)):
        if value is not None:
            df = df.filter(F.col(name) == value)
    return df.filter("is_active")


def with_participant(df: DataFrame, studies: DataFrame) -> DataFrame:
    s = studies.select(F.col("id").alias("study_id"), F.col("study_participant_id").alias("_number"))
    return df.join(s, "study_id", "left").withColumn("participant_id", F.coalesce("_number", "study_id")).drop("_number")


def _lead(df: DataFrame, lead: Sequence[str]) -> DataFrame:
    return df.select(*lead, *[c for c in df.columns if c not in lead])


def audio_sheet(audio: DataFrame, motion: DataFrame, studies: DataFrame, scope: tuple = (None, None, None)) -> DataFrame:
    """Audio rows with their motion import, participant number and a recording time from the file name first."""
    a = with_participant(in_scope(audio, *scope), studies)
    name = F.regexp_replace(F.regexp_replace("audio_file_name", "_with_freq$", ""), r"(?i)\.bin$", "")
    a = a.withColumn("audio_file_name", name)
    parsed = sc.file_name_parts(F.col("audio_file_name"))["recorded_at"]
    a = a.withColumn("recording_datetime", F.coalesce(parsed, "recording_date", "recording_time", "file_time"))
    m = motion.select(
        F.col("id").alias("biomechanics_import_id"), F.col("biomechanics_file").alias("linked_biomechanics_file"),
        F.col("biomechanics_type").alias("linked_biomechanics_type"), F.col("biomechanics_sample_rate").alias("linked_biomechanics_sample_rate"),
    )
    return _lead(a.join(m, "biomechanics_import_id", "left"), ["id", "participant_id", "knee", "maneuver", "audio_file_name", "recording_datetime"])


def motion_sheet(motion: DataFrame, studies: DataFrame, scope: tuple = (None, None, None)) -> DataFrame:
    return _lead(with_participant(in_scope(motion, *scope), studies), ["id", "participant_id", "knee", "maneuver", "biomechanics_file"])


def sync_sheet(sync: DataFrame, audio: DataFrame, studies: DataFrame, scope: tuple = (None, None, None)) -> DataFrame:
    """Synchronisations of active audio, ordered by pass and id."""
    a = audio.filter("is_active").select(F.col("id").alias("audio_processing_id"), "audio_file_name")
    s = with_participant(in_scope(sync, *scope).join(a, "audio_processing_id"), studies)
    return _lead(s, ["id", "participant_id", "pass_number", "speed", "audio_file_name"]).orderBy("pass_number", "id")


def cycle_sheet(cycles: DataFrame, audio: DataFrame, sync: DataFrame, studies: DataFrame, scope: tuple = (None, None, None)) -> DataFrame:
    """Cycles with the pass and speed of their synchronisation, ordered by pass and index."""
    a = audio.filter("is_active").select(F.col("id").alias("audio_processing_id"), "audio_file_name")
    s = sync.select(F.col("id").alias("synchronization_id"), F.col("pass_number").alias("_pass"), F.col("speed").alias("_speed"))
    cyc = in_scope(cycles, *scope).join(a, "audio_processing_id").join(s, "synchronization_id", "left")
    cyc = with_participant(cyc, studies).withColumn("pass_number", F.col("_pass")).withColumn("speed", F.col("_speed")).drop("_pass", "_speed")
    lead = ["id", "participant_id", "pass_number", "speed", "cycle_index", "audio_file_name"]
    return _lead(cyc, lead).orderBy(F.coalesce("pass_number", F.lit(0)), "cycle_index")


def summary(
    audio: DataFrame, motion: DataFrame, sync: DataFrame, cycles: DataFrame, studies: DataFrame, scope: tuple = (None, None, None)
) -> DataFrame:
    """(study_id, knee, maneuver, metric, value) counts of active rows for every scope at once."""
    live = audio.filter("is_active").select(F.col("id").alias("audio_processing_id"))
    parts: dict[str, tuple[DataFrame, Column]] = {
        "Audio Records": (audio, F.countDistinct("audio_file_name")),
        "Biomechanics Records": (motion, F.countDistinct("biomechanics_file")),
        "Synchronization Records": (sync.join(live, "audio_processing_id"), F.countDistinct("sync_file_name")),
        "Movement Cycles": (cycles.join(live, "audio_processing_id"), F.count(F.lit(1))),
    }
    counted = [
        in_scope(df, *scope).groupBy(*SCOPE).agg(agg.alias("value")).withColumn("metric", F.lit(metric))
        for metric, (df, agg) in parts.items()
    ]
    # one row a scope with a number for each metric, so every table is read once; absent ones are zero
    wide = reduce(DataFrame.unionByName, counted).groupBy(*SCOPE).agg(
        *[F.coalesce(F.max(F.when(F.col("metric") == m, F.col("value"))), F.lit(0)).alias(m) for m in parts]
    )
    out = wide.unpivot(list(SCOPE), [F.col(f"`{m}`") for m in parts], "metric", "value")
    return with_participant(out, studies).select("participant_id", *SCOPE, "metric", "value")


def knee_summary(counts: DataFrame, keys: Sequence[str], value_columns: Sequence[str], maneuvers: Sequence[str] = sc.MANEUVERS) -> DataFrame:
    """A row per maneuver for every knee, zeros where nothing was recorded."""
    every = counts.select(*keys).distinct().withColumn("maneuver", F.explode(F.array(*[F.lit(m) for m in maneuvers])))
    out = every.join(counts, [*keys, "maneuver"], "left")
    return out.select(*keys, "maneuver", *[F.coalesce(c, F.lit(0)).alias(c) for c in value_columns])


def motion_statistics(motion: DataFrame, keys: Sequence[str]) -> DataFrame:
    return motion.groupBy(*keys).agg(
        F.sum("num_data_points").alias("num_data_points"), F.max("duration_seconds").alias("duration_seconds"),
        F.countDistinct("pass_number").alias("num_passes"),
    )


def recording_duration(signal: DataFrame, keys: Sequence[str], fs: float) -> DataFrame:
    """Last minus first time, or (n - 1) / fs where time is missing."""
    g = signal.groupBy(*keys).agg((F.max_by("t", "i") - F.min_by("t", "i")).alias("_d"), F.count(F.lit(1)).alias("_n"))
    return g.select(*keys, F.coalesce("_d", (F.col("_n") - 1) / F.lit(fs)).alias("duration_seconds"))


def legend_sheet(mismatches: DataFrame) -> DataFrame:
    return mismatches.select("knee", "maneuver", "field", "primary_value", "fallback_value").orderBy("knee", "maneuver", "field")
