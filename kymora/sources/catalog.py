"""Recording catalogue by path convention, completeness audit, sidecars and all-or-nothing commits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kymora.functions import scalars as sc


def list_files(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """(path, length, modified) of the files below ``root``; contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(root)
    return files.select("path", "length", F.col("modificationTime").alias("modified"))


def recordings(files: DataFrame, path: str = "path") -> DataFrame:
    """Participant, knee, maneuver and file of every path ``#id/<Side> Knee/<Maneuver>/file``."""
    clean = F.regexp_replace(F.col(path), "%20", " ")
    clean = F.regexp_replace(clean, "%23", "#")
    owner = F.regexp_extract(clean, r"/#?((?:AOA|preOA|SMoCK)?\d+)/", 1)
    folder = F.regexp_extract(clean, r"(?i)/(?:left|right)[ _]knee/([^/]+)/", 1)
    plain = F.lower(F.regexp_replace(folder, r"[\s_-]+", ""))
    maneuver = (
        F.when(plain.isin("walking", "walk"), "walk").when(plain.isin("sitstand", "sittostand", "sts"), "sit_to_stand")
        .when(plain.isin("flexionextension", "flexext", "fe"), "flexion_extension")
    )
    name = F.element_at(F.split(clean, "/"), -1)
    return files.select(
        F.col(path).alias("path"), F.regexp_extract(owner, r"(\d+)$", 1).try_cast("int").alias("participant"), sc.study_name(owner).alias("study"),
        F.nullif(F.lower(F.regexp_extract(clean, r"(?i)/(left|right)[ _]knee/", 1)), F.lit("")).alias("knee"),
        maneuver.alias("maneuver"), name.alias("file_name"), *[v.alias(k) for k, v in sc.file_name_parts(name).items()],
    )


def expected_matrix(participants: DataFrame, axes: dict[str, Sequence[str]]) -> DataFrame:
    """Every participant with every combination of the (fixed, small) axes."""
    out = participants
    for name, values in axes.items():
        out = out.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))
    return out


def completeness_audit(expected: DataFrame, present: DataFrame, on: Sequence[str]) -> DataFrame:
    """Expected rows that are not present."""
    return expected.join(present.select(*on).distinct(), list(on), "left_anti")


def select_scope(
    df: DataFrame, participants: Sequence[int] | None = None, knees: Sequence[str] | None = None,
    maneuvers: Sequence[str] | None = None, limit: int | None = None, participant: str = "participant",
) -> DataFrame:
    """Rows of the chosen participants, knees and maneuvers; ``limit`` keeps the first participants."""
    for column, chosen in ((participant, participants), ("knee", knees), ("maneuver", maneuvers)):
        if chosen:
            df = df.filter(F.col(column).isin(*chosen))
    if limit is not None:
        first = df.select(participant).distinct().orderBy(participant).limit(limit)
        df = df.join(F.broadcast(first) if limit <= 10_000 else first, participant, "left_semi")
    return df


def read_sidecars(spark: SparkSession, path: str) -> DataFrame:
    """Sidecar metadata; unreadable files give a row with ``readable`` false."""
    schema = (
        "deviceSerial array<bigint>, devFirmwareVersion int, fileTime string, recordingTime string, fs double, "
        "numBits int, numSDBlocks int, startTime double, stopTime double, _corrupt_record string"
    )
    raw = spark.read.schema(schema).option("mode", "PERMISSIVE").option("multiLine", "true").json(path)
    return raw.select("*", F.col("_metadata.file_path").alias("path"), F.col("_corrupt_record").isNull().alias("readable")).drop("_corrupt_record")


def with_sidecar(recs: DataFrame, sidecars: DataFrame, on: Sequence[str], fallback_fs: float = 46875.0) -> DataFrame:
    """Recordings with their sidecar's rate, or the fallback where it is missing or bad."""
    ok = sidecars.filter("readable").select(*on, F.col("fs").alias("_fs"), F.col("devFirmwareVersion").alias("firmware_version"))
    return recs.join(ok, list(on), "left").withColumn("fs", F.coalesce(F.when(F.col("_fs") > 0, F.col("_fs")), F.lit(fallback_fs))).drop("_fs")


def first_known(*columns: str):
    """Precedence chain: the first non-null value."""
    return F.coalesce(*columns)


def committed(rows: DataFrame, status: DataFrame, owner: Sequence[str]) -> DataFrame:
    """Rows of participants none of whose stages failed: nothing of a failed one is written."""
    failed = status.filter(~F.col("ok")).select(*owner).distinct()
    return rows.join(failed, list(owner), "left_anti")


def processed_participants(logs: DataFrame, participant: str = "participant", both: bool = True) -> DataFrame:
    """Participants with a finished log for both knees, or for any."""
    g = logs.groupBy(participant).agg(
        F.count_if(F.lower("knee").startswith("l")).alias("_l"), F.count_if(F.lower("knee").startswith("r")).alias("_r")
    )
    ok = (F.col("_l") > 0) & (F.col("_r") > 0) if both else (F.col("_l") > 0) | (F.col("_r") > 0)
    return g.filter(ok).select(participant)
