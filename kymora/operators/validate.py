"""Constraints as data: every rule yields violation rows instead of raising on a record."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kymora.functions import scalars as sc

Rules = dict[str, Column]
c = F.col


def _absent_or(cond: Column, name: str) -> Column:
    return c(name).isNotNull() & cond


def audio_rules() -> Rules:
    return {
        "study_id_negative": c("study_id") < 0,
        "motion_id_not_positive": _absent_or(c("biomechanics_import_id") <= 0, "biomechanics_import_id"),
        "time_not_on_recording_date": F.to_date("recording_time") != F.to_date("recording_date"),
        "sample_rate_not_positive": c("sample_rate") <= 0,
        "num_channels_not_1_to_4": ~c("num_channels").isin(1, 2, 3, 4),
        "file_size_negative": c("file_size_mb") < 0,
        "firmware_negative": c("firmware_version") < 0,
        "duration_negative": _absent_or(c("duration_seconds") < 0, "duration_seconds"),
    }


def motion_rules() -> Rules:
    walk = c("maneuver") == "walk"
    return {
        "audio_id_not_positive": _absent_or(c("audio_processing_id") <= 0, "audio_processing_id"),
        "walk_without_pass": walk & c("pass_number").isNull(),
        "pass_not_positive": walk & (c("pass_number") <= 0),
        "pass_on_other_maneuver": ~walk & c("pass_number").isNotNull(),
        "walk_without_speed": walk & c("speed").isNull(),
        "speed_on_other_maneuver": ~walk & c("speed").isNotNull(),
        "rate_not_positive": c("biomechanics_sample_rate") <= 0,
        "count_negative": (c("num_sub_recordings") < 0) | (c("num_passes") < 0) | (c("num_data_points") < 0),
        "duration_negative": c("duration_seconds") < 0,
    }


def sync_rules() -> Rules:
    uses = lambda m: F.coalesce(F.array_contains("stomp_detection_methods", m), F.lit(False))
    return {
        "id_not_positive": (c("audio_processing_id") <= 0) | (c("biomechanics_import_id") <= 0),
        "cycle_count_negative": (c("total_cycles_extracted") < 0) | (c("clean_cycles") < 0) | (c("outlier_cycles") < 0),
        "motion_method_without_time": uses("biomechanics") & c("bio_selected_sync_time").isNull(),
        "motion_method_without_contra": uses("biomechanics") & c("contra_bio_selected_sync_time").isNull(),
        "audio_method_without_time": uses("audio") & c("audio_selected_sync_time").isNull(),
        "audio_method_without_contra": uses("audio") & c("contra_audio_selected_sync_time").isNull(),
        "both_sides_without_offset": c("audio_sync_time_left").isNotNull() & c("audio_sync_time_right").isNotNull() & c("audio_sync_offset").isNull(),
    }


def cycle_rules() -> Rules:
    return {
        "audio_id_not_positive": c("audio_processing_id") <= 0,
        "motion_id_not_positive": _absent_or(c("biomechanics_import_id") <= 0, "biomechanics_import_id"),
        "sync_id_not_positive": _absent_or(c("synchronization_id") <= 0, "synchronization_id"),
        "cycle_index_negative": c("cycle_index") < 0,
        "time_negative": (c("start_time_s") < 0) | (c("end_time_s") < 0) | (c("duration_s") < 0),
        "pass_and_speed_not_together": c("pass_number").isNull() != c("speed").isNull(),
    }


def domain_rules(columns: dict[str, Sequence[str]]) -> Rules:
    """Closed vocabularies, e.g. ``{"knee": scalars.KNEES}``."""
    return {f"{name}_unknown": ~c(name).isin(*allowed) for name, allowed in columns.items()}


def record_domains() -> dict[str, Sequence[str]]:
    return {"study": sc.STUDIES, "knee": sc.KNEES, "maneuver": sc.MANEUVERS, "processing_status": sc.STATUSES}


def file_rules() -> Rules:
    """File-level keys: walking needs pass and speed, microphones are exactly 1 to 4."""
    walk = c("maneuver") == "walk"
    return {
        "walk_without_pass_or_speed": walk & (c("pass_number").isNull() | c("speed").isNull()),
        "pass_or_speed_on_other_maneuver": ~walk & (c("pass_number").isNotNull() | c("speed").isNotNull()),
        "microphones_not_1_to_4": F.array_sort(F.map_keys("microphones")) != F.array(*[F.lit(k) for k in (1, 2, 3, 4)]),
    }


def violations(df: DataFrame, keys: Sequence[str], rules: Rules) -> DataFrame:
    """(keys, rule): one row for every broken rule of every record, in one pass."""
    broken = F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in rules.items()]))
    return df.select(*keys, F.explode(broken).alias("rule"))


def duplicate_keys(df: DataFrame, natural: Sequence[str]) -> DataFrame:
    """Natural keys held by more than one row; null parts compare equal."""
    return df.groupBy(*natural).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    return [name for name in required if name not in df.columns]


SIGNAL_REQUIRED = ("tt", "ch1", "ch2", "ch3", "ch4")
EVENT_REQUIRED = ("Event Info", "Time (sec)")
MOTION_REQUIRED = ("TIME",)
SYNCED_REQUIRED = (*SIGNAL_REQUIRED, "f_ch1", "f_ch2", "f_ch3", "f_ch4", "TIME", "Knee Angle Z")


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose non-null reference has no parent."""
    p = parent.select(F.col(parent_key).alias("_p"))
    refs = child.filter(F.col(child_key).isNotNull())
    return refs.join(p, refs[child_key] == p["_p"], "left_anti")


def stamp_version(df: DataFrame, kind: str) -> DataFrame:
    return df.withColumn(f"{kind}_qc_version", F.lit(sc.QC_VERSIONS[kind]))


def outdated(df: DataFrame, kind: str, current: int | None = None) -> DataFrame:
    """Records judged by an older rule version, to be run again."""
    return df.filter(F.col(f"{kind}_qc_version") < (sc.QC_VERSIONS[kind] if current is None else current))
