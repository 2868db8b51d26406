"""Versioned metadata tables: natural-key upsert, soft delete, linking and filtered reads.

A table is a sequence of snapshots; every operation maps the current snapshot and the run's rows to
the next one. Keys may hold nulls, so all key joins are null-safe.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kymora.plans.blocks import with_sample_index
from kymora.session import durable

AUDIO_KEY = ("study_id", "audio_file_name", "knee", "maneuver")
MOTION_KEY = ("study_id", "biomechanics_file", "knee", "maneuver")
SYNC_KEY = ("study_id", "knee", "maneuver", "pass_number", "speed")
CYCLE_KEY = (*SYNC_KEY, "cycle_index")
MOTION_MUTABLE = ("processing_date", "processing_status", "audio_processing_id")


def lower_keys(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Text key parts in lower case, so case variants meet."""
    text = {f.name for f in df.schema if f.dataType.simpleString() == "string"}
    return df.select(*[F.lower(c).alias(c) if c in names and c in text else F.col(c) for c in df.columns])


def null_safe(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    on = F.lit(True)
    for a, b in pairs:
        on = on & left[a].eqNullSafe(right[b])
    return on


def latest_per_key(rows: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the last by ``order``; a mergeable maximum, so a hot key combines map-side."""
    rest = [c for c in rows.columns if c not in key]
    return rows.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r")).select(*key, "_r.*").select(*rows.columns)


def upsert(
    current: DataFrame, incoming: DataFrame, key: Sequence[str], id_column: str = "id", active: str = "is_active",
    mutable: Sequence[str] | None = None, keep_if_null: Sequence[str] = (), seen: str | None = None,
) -> DataFrame:
    """Next snapshot after saving ``incoming`` (one row per key) into ``current``.

    A known key takes the incoming values of the mutable columns (those in ``keep_if_null`` only when
    given) and becomes active again; a new key gets the next id. Untouched rows pass through. ``seen`` names one
    more column that tells which rows ``incoming`` has.
    """
    key = list(key)
    columns = [*current.columns, *([seen] if seen else [])]
    values_of = current.columns
    values = [c for c in values_of if c not in (*key, id_column, active)]
    writable = set(values if mutable is None else mutable)
    given = [c for c in values if c in incoming.columns]
    inc = incoming.select(*[F.col(c).alias(f"_k_{c}") for c in key], *[F.col(c).alias(f"_n_{c}") for c in given], F.lit(True).alias("_hit"))
    both = current.withColumn("_old", F.lit(True)).join(
        inc, null_safe(current, inc, [(k, f"_k_{k}") for k in key]), "full_outer"
    )
    old, hit = F.col("_old").isNotNull(), F.col("_hit").isNotNull()

    def value(c: str) -> Column:
        if c not in given:
            return F.col(c)
        new = F.col(f"_n_{c}")
        if c not in writable:
            return F.when(old, F.col(c)).otherwise(new).alias(c)
        kept = F.coalesce(new, F.col(c)) if c in keep_if_null else new
        return F.when(hit, F.when(old, kept).otherwise(new)).otherwise(F.col(c)).alias(c)

    merged = both.select(
        *[F.when(old, F.col(k)).otherwise(F.col(f"_k_{k}")).alias(k) for k in key],
        F.col(id_column), F.when(hit, F.lit(True)).otherwise(F.col(active)).alias(active),
        *[value(c).alias(c) for c in values], *([hit.alias(seen)] if seen else []),
    )
    merged = durable(merged)  # read twice below; the join above runs once
    known = merged.filter(F.col(id_column).isNotNull())
    fresh = assign_ids(merged.filter(F.col(id_column).isNull()), current, key, id_column)
    return known.select(*columns).unionByName(fresh.select(*columns))


def assign_ids(fresh: DataFrame, current: DataFrame, order: Sequence[str], id_column: str = "id") -> DataFrame:
    """Ids after the largest one in use, in key order, numbered without a global sort in one task."""
    top = current.agg(F.coalesce(F.max(id_column), F.lit(0)).alias("_top")).withColumn("_all", F.lit(0))
    numbered = with_sample_index(fresh.drop(id_column).withColumn("_all", F.lit(0)), ["_all"], list(order), "_pos")
    return numbered.join(F.broadcast(top), "_all").withColumn(
        id_column, (F.col("_top") + F.col("_pos") + 1).cast(dict(current.dtypes)[id_column])
    ).drop("_pos", "_top", "_all")


def get_or_create(current: DataFrame, wanted: DataFrame, key: Sequence[str], id_column: str = "id") -> DataFrame:
    """Dimension table with a row for every wanted key; existing rows keep their ids."""
    key = list(key)
    w = wanted.select(*key).distinct()
    known = current.select(*[F.col(k).alias(f"_k_{k}") for k in key])
    new = w.join(known, null_safe(w, known, [(k, f"_k_{k}") for k in key]), "left_anti")
    ids = assign_ids(new.withColumn(id_column, F.lit(None).cast("long")), current, key, id_column)
    return current.unionByName(ids.select(*key, id_column), allowMissingColumns=True)


def upsert_motion(current: DataFrame, incoming: DataFrame) -> DataFrame:
    """Known motion imports only change status, date, link and activity."""
    return upsert(current, incoming, MOTION_KEY, mutable=MOTION_MUTABLE, keep_if_null=("audio_processing_id",))


def soft_delete(current: DataFrame, seen: DataFrame, scope: DataFrame, on: Sequence[str], id_column: str = "id", active: str = "is_active") -> DataFrame:
    """Active rows of the processed scopes that the run did not see become inactive."""
    s = scope.select(*[F.col(c).alias(f"_s_{c}") for c in on]).distinct().withColumn("_in", F.lit(True))
    seen_ids = seen.select(F.col(id_column).alias("_seen")).distinct()
    j = current.join(s, null_safe(current, s, [(c, f"_s_{c}") for c in on]), "left")
    j = j.join(seen_ids, F.col(id_column) == F.col("_seen"), "left")
    gone = F.col("_in").isNotNull() & F.col("_seen").isNull()
    return j.select(*[F.when(gone, F.lit(False)).otherwise(F.col(active)).alias(active) if c == active else F.col(c) for c in current.columns])


def drop_unseen(current: DataFrame, seen: str, scope: DataFrame, on: Sequence[str], active: str = "is_active") -> DataFrame:
    """``soft_delete`` where column ``seen`` tells what the run saw: only active rows that it did not see meet the scopes."""
    s = scope.select(*[F.col(c).alias(f"_s_{c}") for c in on]).distinct().withColumn("_in", F.lit(True))
    columns = [c for c in current.columns if c != seen]
    safe = F.col(seen) | F.coalesce(~F.col(active), F.lit(False))
    rest = current.filter(~safe)
    j = rest.join(s, null_safe(rest, s, [(c, f"_s_{c}") for c in on]), "left")
    gone = F.col("_in").isNotNull()
    return current.filter(safe).select(*columns).unionByName(j.select(*[F.when(gone, F.lit(False)).otherwise(F.col(active)).alias(active) if c == active else F.col(c) for c in columns]))


def deactivated_counts(before: dict[str, DataFrame], after: dict[str, DataFrame], id_column: str = "id", active: str = "is_active") -> DataFrame:
    """(table, n): rows that turned inactive."""
    parts = []
    for name, old in before.items():
        a = old.filter(active).select(id_column)
        b = after[name].filter(active).select(id_column)
        parts.append(a.join(b, id_column, "left_anti").agg(F.lit(name).alias("table"), F.count(F.lit(1)).alias("n")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def link_motion(audio: DataFrame, motion: DataFrame, key: Sequence[str] = ("study_id", "knee", "maneuver")) -> DataFrame:
    """Audio rows pointed at the latest active motion import of the same study, knee and maneuver."""
    newest = motion.filter("is_active").groupBy(*key).agg(F.max("id").alias("_motion"))
    j = audio.join(newest, list(key), "left")
    link = F.coalesce("_motion", "biomechanics_import_id")
    return j.select(*[link.alias(c) if c == "biomechanics_import_id" else F.col(c) for c in audio.columns])


def find(
    table: DataFrame, studies: DataFrame, study: str | None = None, participant: int | None = None, maneuver: str | None = None,
    knee: str | None = None, active: bool | None = True,
) -> DataFrame:
    """Rows by study, participant number, maneuver, knee and activity; unset filters match all."""
    s = studies.select(F.col("id").alias("study_id"), "study_name", "study_participant_id")
    for column, wanted in (("study_name", study), ("study_participant_id", participant)):
        if wanted is not None:
            s = s.filter(F.col(column) == wanted)
    for column, wanted in (("maneuver", maneuver), ("knee", knee), ("is_active", active)):
        if wanted is not None:
            table = table.filter(F.col(column) == wanted)
    return table.join(s, "study_id")


def parent_ids(children: DataFrame, parents: DataFrame, key: Sequence[str], out: str) -> DataFrame:
    """For a partial rerun: the active parent of each row, else the newest inactive one."""
    rank = F.struct(F.col("is_active").cast("int").alias("a"), "id")
    best = parents.groupBy(*key).agg(F.max_by("id", rank).alias(out))
    renamed = best.select(*[F.col(k).alias(f"_p_{k}") for k in key], out)
    on = null_safe(children, renamed, [(k, f"_p_{k}") for k in key])
    return children.join(renamed, on, "left").drop(*[f"_p_{k}" for k in key])


def reshape(snapshots: Sequence[DataFrame], renames: dict[str, str]) -> DataFrame:
    """Old and new snapshots of a table brought under one set of columns."""
    out = snapshots[0].withColumnsRenamed(renames)
    for s in snapshots[1:]:
        out = out.unionByName(s.withColumnsRenamed(renames), allowMissingColumns=True)
    return out


def audio_records(recordings: DataFrame, qc: DataFrame, previous: DataFrame, key: Sequence[str] = AUDIO_KEY) -> DataFrame:
    """Audio rows of this run: file facts, QC columns, and the motion link of the last run where this one has none."""
    q = recordings.join(qc, "recording_id", "left")
    old = previous.select(*[F.col(k).alias(f"_o_{k}") for k in key], F.col("biomechanics_import_id").alias("_o_link"))
    j = q.join(old, null_safe(q, old, [(k, f"_o_{k}") for k in key]), "left")
    link = F.coalesce("biomechanics_import_id", "_o_link") if "biomechanics_import_id" in q.columns else F.col("_o_link")
    return j.withColumn("biomechanics_import_id", link).drop("_o_link", *[f"_o_{k}" for k in key])


def write_snapshot(df: DataFrame, root: str) -> str:
    """Write the next snapshot beside the others, then record it; readers never see half a snapshot."""
    name = f"snapshot-{uuid.uuid4().hex}"
    df.write.parquet(f"{root}/{name}")
    spark = df.sparkSession
    pointer = spark.createDataFrame([(name,)], "snapshot string").withColumn("at", F.current_timestamp())
    pointer.write.mode("append").parquet(f"{root}/pointer")
    return name


def read_snapshot(spark: SparkSession, root: str) -> DataFrame:
    """The snapshot recorded last."""
    last = spark.read.parquet(f"{root}/pointer").agg(F.max_by("snapshot", "at").alias("s")).first()
    return spark.read.parquet(f"{root}/{last['s']}")
