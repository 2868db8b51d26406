"""Column expressions for names, ids, codes and loosely typed cells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Vocabulary of the study tables.
STUDIES = ("AOA", "preOA", "SMoCK")
KNEES = ("left", "right")
MANEUVERS = ("fe", "sts", "walk")
SPEEDS = ("slow", "medium", "fast", "comfortable")
STATUSES = ("not_processed", "success", "error")
SPEED_EVENT_CODES = {"slow": "SS", "normal": "NS", "fast": "FS"}
SPEED_HEADERS = {"Slow Speed": "SS", "Normal Speed": "NS", "Medium Speed": "NS", "Fast Speed": "FS"}
MANEUVER_FOLDERS = {"Walking": "walk", "Sit-Stand": "sit_to_stand", "Flexion-Extension": "flexion_extension"}
UID_MANEUVERS = {"walk": "walk", "sittostand": "sit_to_stand", "sitstand": "sit_to_stand", "flexext": "flexion_extension"}
DEFAULT_MICS = {1: "IPL", 2: "IPM", 3: "SPM", 4: "SPL"}
TRUE_WORDS = ("yes", "y", "true", "1")
FALSE_WORDS = ("no", "n", "false", "0")
QC_VERSIONS = {"audio": 2, "biomech": 2, "cycle": 2}
FILE_NAME_PATTERN = r"HP_W([\d.]+)-(\d+)-(20\d{2})(0\d|1[0-2])([0-3]\d)_(\d{6})"


def look_up(key: Column, table: dict[str, str]) -> Column:
    """CASE over a small fixed table; null when absent."""
    out = F.lit(None).cast("string")
    for k, v in table.items():
        out = F.when(key == F.lit(k), F.lit(v)).otherwise(out)
    return out


def device_from_name(name: Column) -> Column:
    """STRUCT(serial, firmware, recorded_on) from labelled parts of a file name, wherever they stand.

    Serials follow "sn" or "serial", firmware numbers "fw" or "firmware"; a date is yyyy[-_]mm[-_]dd. Missing
    parts are "unknown", 0 and null.
    """
    stem = F.regexp_replace(F.regexp_extract(name, r"([^/]*)$", 1), r"(?<=.)\.[^.]*$", "")
    serial = F.regexp_extract(stem, r"(?i)(?:serial|sn)[-_]?(\d+)", 1)
    firmware = F.regexp_extract(stem, r"(?i)(?:firmware|fw)[-_]?(\d+)", 1)
    day = F.regexp_replace(F.regexp_extract(stem, r"20\d{2}[-_]?[01]\d[-_]?[0-3]\d", 0), "[-_]", "")
    return F.struct(
        F.coalesce(F.nullif(serial, F.lit("")), F.lit("unknown")).alias("serial"),
        F.coalesce(firmware.try_cast("int"), F.lit(0)).alias("firmware"),
        F.try_to_timestamp(F.nullif(day, F.lit("")), F.lit("yyyyMMdd")).cast("date").alias("recorded_on"),
    )


def recording_identity(meta_serial: Column, raw_serial: Column, name_serial: Column, firmware: Column, file_time: Column, recording_date: Column, recording_time: Column, name_time: Column, default_time: Column) -> Column:
    """STRUCT(serial, firmware, file_time, recording_date, recording_time), each from the best source that has it.

    Serial: sidecar, raw header, file name, "UNKNOWN". Recording date: its own, the name's, the file's; recording
    time: its own, the file's, the name's; file time: its own, the recording time. Where all are missing the
    default stands for all; one that is still missing takes another's.
    """
    given = lambda c: F.nullif(F.trim(c), F.lit(""))
    date0 = F.coalesce(recording_date, name_time, file_time)
    time0 = F.coalesce(recording_time, file_time, name_time)
    file0 = F.coalesce(file_time, time0)
    return F.struct(
        F.coalesce(given(meta_serial), given(raw_serial), given(name_serial), F.lit("UNKNOWN")).alias("serial"),
        F.coalesce(firmware.try_cast("double").cast("int"), F.lit(0)).alias("firmware"),
        F.coalesce(file0, date0, time0, default_time).alias("file_time"),
        F.coalesce(date0, file0, time0, default_time).alias("recording_date"),
        F.coalesce(time0, file0, date0, default_time).alias("recording_time"),
    )


def maneuver_name(x: Column) -> Column:
    """The long name of a maneuver from its code or name; null for any other text."""
    plain = F.regexp_replace(F.lower(F.trim(x)), r"[\s-]+", "_")
    return look_up(plain, {"fe": "flexion_extension", "sts": "sit_to_stand", "walk": "walk", "sit_to_stand": "sit_to_stand", "flexion_extension": "flexion_extension"})


def to_seconds(x: Column) -> Column:
    """Seconds from a number, or from text as a number or [d days] [hh:]mm:ss[.f]."""
    s = F.trim(x.cast("string"))
    days = F.coalesce(F.regexp_extract(s, r"^(\d+)\s*days?\b", 1).try_cast("double"), F.lit(0.0))
    clock = F.regexp_extract(s, r"(?:(\d+):)?(\d+):(\d+(?:\.\d+)?)$", 0)
    h = F.coalesce(F.regexp_extract(s, r"(?:(\d+):)?(\d+):(\d+(?:\.\d+)?)$", 1).try_cast("double"), F.lit(0.0))
    m = F.regexp_extract(s, r"(?:(\d+):)?(\d+):(\d+(?:\.\d+)?)$", 2).try_cast("double")
    sec = F.regexp_extract(s, r"(?:(\d+):)?(\d+):(\d+(?:\.\d+)?)$", 3).try_cast("double")
    whole_days = F.regexp_like(s, F.lit(r"^\d+\s*days?$"))
    return (
        F.when(s.try_cast("double").isNotNull(), s.try_cast("double"))
        .when(F.length(clock) > 0, days * 86400 + h * 3600 + m * 60 + sec)
        .when(whole_days, days * 86400)
    )


def to_number(x: Column) -> Column:
    """Double, or null when the cell is not a number (NaN counts as missing)."""
    d = F.trim(x.cast("string")).try_cast("double")
    return F.when(~F.isnan(d), d)


def yes_no(x: Column) -> Column:
    """Boolean of a yes/no cell; null when it is neither."""
    s = F.lower(F.trim(x.cast("string")))
    return F.when(s.isin(*TRUE_WORDS), True).when(s.isin(*FALSE_WORDS), False)


def choice(x: Column, allowed: tuple[str, ...]) -> Column:
    s = F.lower(F.trim(x.cast("string")))
    return F.when(s.isin(*allowed), s)


def study_number(x: Column) -> Column:
    """Four-digit participant number, with or without the study prefix; null when malformed."""
    s = F.upper(F.trim(x.cast("string")))
    bare = F.regexp_replace(s, "^(SMOCK|PREOA|AOA)", "")
    return F.when(F.regexp_like(bare, F.lit(r"^\d{4}$")), bare.cast("int"))


def study_name(x: Column) -> Column:
    s = F.upper(F.trim(F.regexp_replace(x.cast("string"), "^#", "")))
    return F.when(s.startswith("SMOCK"), "SMoCK").when(s.startswith("PREOA"), "preOA").otherwise(F.lit("AOA"))


def maneuver_code(x: Column) -> Column:
    """fe, sts or walk; anything unknown is walk."""
    s = F.lower(F.trim(x))
    return F.when(s.isin("fe", "flexion_extension"), "fe").when(s.isin("sts", "sit_to_stand"), "sts").otherwise(F.lit("walk"))


def knee_side(x: Column) -> Column:
    return F.when(F.lower(F.trim(x)).startswith("l"), "left").otherwise(F.lit("right"))


def knee_letter(x: Column) -> Column:
    s = F.trim(x.cast("string"))
    return F.when(F.lower(s).isin("right", "r"), "R").when(F.lower(s).isin("left", "l"), "L").otherwise(s)


def speed_code(x: Column) -> Column:
    s = F.lower(F.trim(x))
    return F.when(s == "normal", "medium").otherwise(s)


def pass_number(name: Column) -> Column:
    """Pass number from ``Pass0001`` or ``_p7_`` in a name."""
    a = F.regexp_extract(name, r"(?i)pass[_ ]?0*(\d+)", 1)
    b = F.regexp_extract(name, r"(?i)_p0*(\d+)(?:_|$)", 1)
    return F.coalesce(a.try_cast("int"), b.try_cast("int"))


def mic_position(patellar: Column, laterality: Column) -> Column:
    """IPM, IPL, SPM or SPL."""
    p = F.when(F.lower(F.trim(patellar)).startswith("infra"), "IP").when(F.lower(F.trim(patellar)).startswith("supra"), "SP")
    side = F.when(F.lower(F.trim(laterality)).startswith("med"), "M").when(F.lower(F.trim(laterality)).startswith("lat"), "L")
    return F.concat(p, side)


def event_name(speed: Column, number: Column, edge: str) -> Column:
    """``SS Pass 1 Start`` and the like; movements other than walking use ``Movement Start``."""
    code = look_up(F.lower(speed), SPEED_EVENT_CODES)
    return F.when(speed.isNull(), F.lit(f"Movement {edge}")).otherwise(F.concat_ws(" ", code, F.lit("Pass"), number.cast("string"), F.lit(edge)))


def event_header(name: Column) -> Column:
    """Speed code of a section header row."""
    return look_up(F.trim(name), SPEED_HEADERS)


def clean_uid(uid: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(uid, r"^.*V3D\\", ""), r"\.c3d", "")


def uid_parts(uid: Column) -> dict[str, Column]:
    """study, study_id, maneuver, pass_number and speed of a cleaned motion uid."""
    token = F.split(uid, "_")
    head = F.get(token, F.lit(0))
    kind = F.lower(F.regexp_replace(F.get(token, F.lit(1)), "[^A-Za-z]", ""))
    maneuver = look_up(kind, UID_MANEUVERS)
    info = F.get(token, F.size(token) - 2)
    code = F.upper(F.regexp_replace(F.regexp_replace(info, "[^A-Za-z]", ""), "P", ""))
    walking = maneuver == "walk"
    return {
        "study": F.nullif(F.regexp_replace(head, "[^A-Za-z]", ""), F.lit("")),
        "study_id": F.regexp_replace(head, "[^0-9]", "").try_cast("int"),
        "maneuver": maneuver,
        "pass_number": F.when(walking, F.regexp_replace(info, "[^0-9]", "").try_cast("int")),
        "speed": F.when(walking, look_up(code, {v: k for k, v in SPEED_EVENT_CODES.items()})),
    }


def uid_problem(parts: dict[str, Column]) -> Column:
    """Code of the first thing wrong with a uid; null when it is fine."""
    walking = parts["maneuver"] == "walk"
    return (
        F.when(parts["study"].isNull(), "no_study_prefix").when(parts["study_id"].isNull(), "no_study_number")
        .when(parts["maneuver"].isNull(), "unknown_maneuver").when(walking & parts["speed"].isNull(), "unknown_speed")
        .when(walking & parts["pass_number"].isNull(), "no_pass_number")
    )


def file_name_parts(name: Column) -> dict[str, Column]:
    """Device serial and recording time from a dump's file name; null when it does not match."""
    part = lambda k: F.regexp_extract(name, FILE_NAME_PATTERN, k)
    stamp = F.concat(part(3), part(4), part(5), part(6))
    return {
        "device_serial": F.nullif(part(2), F.lit("")),
        "recorded_at": F.try_to_timestamp(F.nullif(stamp, F.lit("")), F.lit("yyyyMMddHHmmss")),
    }


def semantic_name(*parts: Column) -> Column:
    """Lower-case name of a stored frame from its key parts, empty ones left out."""
    return F.lower(F.concat_ws("_", *[F.nullif(p.cast("string"), F.lit("")) for p in parts]))


def motion_sync_method(system: Column) -> Column:
    """Goniometer recordings are synchronised by a flick, all others by a stomp."""
    return F.when(F.lower(system) == "gonio", "flick").otherwise(F.lit("stomp"))
