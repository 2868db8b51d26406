"""Saving a run: its records go into the metadata tables, what it no longer saw is switched off, all at once.

The tables (audio, motion, sync, cycle) live in a ``StageStore`` beside the stage tables. A run upserts its
records by their natural keys, rows of the processed scopes that it did not see become inactive, and one
publication makes stage and metadata tables current. Nothing of a participant with a failed recording is
saved: neither its records nor its scopes are part of the run, so what an earlier run saved of it stays.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kymora.operators import reports as rp
from kymora.operators import tables as tb
from kymora.plans import pipeline
from kymora.plans.pipeline import StageStore
from kymora.session import durable
from kymora.sources.catalog import committed
from kymora.sources.sinks import write_report

SCOPE = ("study_id", "knee", "maneuver")
KEYS = {"meta_audio": tb.AUDIO_KEY, "meta_motion": tb.MOTION_KEY, "meta_sync": tb.SYNC_KEY, "meta_cycle": tb.CYCLE_KEY}
# facts of a recording that are kept where ``recordings`` gives them
AUDIO_FACTS = {"file_size_mb": "double", "recording_date": "timestamp", "recording_time": "timestamp", "file_time": "timestamp"}
MOTION_FACTS = {"biomechanics_type": "string", "biomechanics_sample_rate": "double"}
KINDS = ("dropout", "spike", "continuous")


def save(current: DataFrame, incoming: DataFrame, scope: DataFrame, key: Sequence[str], on: Sequence[str] = SCOPE) -> DataFrame:
    """Next snapshot of one table: ``incoming`` (one row a key) upserted, other active rows of ``scope`` switched off."""
    return tb.drop_unseen(tb.upsert(current, incoming, key, seen="_seen"), "_seen", scope, list(on))


def whole(recordings: DataFrame, status: DataFrame, owner: Sequence[str] = ("study_id",)) -> DataFrame:
    """Recordings of participants all of whose recordings have a status and none of them a failure."""
    judged = recordings.select("recording_id", *owner).join(status.select("recording_id", "ok"), "recording_id", "left")
    return committed(recordings, judged.withColumn("ok", F.coalesce("ok", F.lit(False))), owner)


def _facts(recordings: DataFrame, facts: dict[str, str]) -> list[Column]:
    return [(F.col(c) if c in recordings.columns else F.lit(None)).cast(t).alias(c) for c, t in facts.items()]


def records(store: StageStore, recordings: DataFrame) -> dict[str, DataFrame]:
    """Records of a pipeline run from its stage tables, each with its ``recording_id``.

    ``recordings`` has (recording_id, study_id, audio_file_name, knee, maneuver, pass_number, speed), where known
    ``biomechanics_file`` and the facts above. Without ``biomechanics_file`` there are no motion records.
    """
    kind = store.read("artifact_interval").filter("channel <> 'overall'")
    found = kind.groupBy("recording_id").agg(
        F.array_join(F.array_sort(F.collect_set("kind")), ",").alias("qc_failures"),
        *[F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("end") - F.col("start"))), F.lit(0.0)).alias(f"{k}_seconds") for k in KINDS],
    )
    audio = recordings.join(found, "recording_id", "left").select(
        "recording_id", *tb.AUDIO_KEY, *_facts(recordings, AUDIO_FACTS), F.col("qc_failures").isNotNull().alias("qc_fail"),
        F.coalesce("qc_failures", F.lit("")).alias("qc_failures"), *[F.coalesce(f"{k}_seconds", F.lit(0.0)).alias(f"{k}_seconds") for k in KINDS],
    )
    record = store.read("sync_record")
    name = F.concat_ws("_", F.col("audio_file_name"), F.lit("synced"), F.col("pass_number").cast("string"), F.col("speed"))
    sync = recordings.select("recording_id", *tb.SYNC_KEY, name.alias("sync_file_name")).join(record, "recording_id")
    cycles = store.read("cycle")
    own = [c for c in cycles.columns if c not in ("participant", *tb.CYCLE_KEY, "recording_id")]
    cycle = recordings.select("recording_id", *tb.SYNC_KEY).join(cycles.select("recording_id", "cycle_index", *own), "recording_id")
    out = {"meta_audio": audio, "meta_sync": sync, "meta_cycle": cycle}
    if "biomechanics_file" in recordings.columns:
        length = [c for c in ("motion_duration",) if c in record.columns]
        out["meta_motion"] = recordings.filter("biomechanics_file IS NOT NULL").select(
            "recording_id", *tb.MOTION_KEY, *_facts(recordings, MOTION_FACTS), F.lit("success").alias("processing_status")
        ).join(record.select("recording_id", *[F.col(c).alias("duration_seconds") for c in length]), "recording_id", "left")
    return {name: tb.latest_per_key(df, KEYS[name], ["recording_id"]) for name, df in out.items()}


def _linked(rows: DataFrame, saved: DataFrame, key: Sequence[str], out: str) -> DataFrame:
    """``rows`` with the id that their key has in the saved table."""
    ids = saved.select(*[F.col(k).alias(f"_l_{k}") for k in key], F.col("id").alias(out))
    return rows.join(ids, tb.null_safe(rows, ids, [(k, f"_l_{k}") for k in key]), "left").drop(*[f"_l_{k}" for k in key])


def updates(store: StageStore, recordings: DataFrame) -> Callable[[dict[str, DataFrame]], dict[str, DataFrame]]:
    """The change of the metadata tables by this run, for ``StageStore.publish``."""
    good = durable(whole(recordings, store.read("sync_status")))
    incoming = {name: durable(df) for name, df in records(store, good).items()}
    scope = good.select(*SCOPE).distinct()
    of = good.select("recording_id", *tb.AUDIO_KEY)

    def update(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
        done: dict[str, DataFrame] = {}

        def put(name: str, rows: DataFrame, links: dict[str, str], again: bool = True) -> DataFrame:
            rows = rows.drop("recording_id")
            empty = rows.filter("false").withColumn("id", F.lit(None).cast("long")).withColumn("is_active", F.lit(None).cast("boolean"))
            old = tables.get(name)
            for column, kind in links.items():
                empty = empty if column in empty.columns else empty.withColumn(column, F.lit(None).cast(kind))
            current = empty if old is None else old.unionByName(empty, allowMissingColumns=True)
            saved = save(current, rows, scope, KEYS[name])
            done[name] = durable(saved) if again else saved  # what others link to is read again
            return done[name]

        def parent(rows: DataFrame) -> DataFrame:
            named = rows.join(of.select("recording_id", "audio_file_name"), "recording_id", "left") if "audio_file_name" not in rows.columns else rows
            return _linked(named, audio, tb.AUDIO_KEY, "audio_processing_id").drop("audio_file_name")

        audio = put("meta_audio", incoming["meta_audio"], {"biomechanics_import_id": "long"})
        if "meta_motion" in incoming:
            motion = put("meta_motion", parent(incoming["meta_motion"]), {})
            done["meta_audio"] = tb.link_motion(audio, motion)
        sync = put("meta_sync", parent(incoming["meta_sync"]), {})
        put("meta_cycle", _linked(parent(incoming["meta_cycle"]), sync, tb.SYNC_KEY, "synchronization_id"), {}, again=False)
        return done

    return update


def save_run(store: StageStore, recordings: DataFrame) -> int:
    """Save what the stage tables hold of these recordings; the first run creates the metadata tables."""
    return store.publish(updates(store, recordings))


def run(store: StageStore, settings: pipeline.Settings, recordings: DataFrame, *inputs: DataFrame, **how) -> DataFrame:
    """``pipeline.run`` whose records become current together with its stage tables."""
    return pipeline.run(store, settings, recordings, *inputs, save=updates, **how)


def activity(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, n_active, n_inactive) of each snapshot."""
    parts = [df.agg(F.lit(name).alias("table"), F.count_if("is_active").alias("n_active"), F.count_if(~F.col("is_active")).alias("n_inactive")) for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def report(store: StageStore, studies: DataFrame, path: str) -> None:
    """The audio, motion, sync, cycle and summary sheets of the current tables, a folder each."""
    known = store.current()
    audio, sync, cycles = (store.read(f"meta_{n}") for n in ("audio", "sync", "cycle"))
    shape = "id long, study_id long, biomechanics_file string, knee string, maneuver string, biomechanics_type string, biomechanics_sample_rate double, is_active boolean"
    motion = store.read("meta_motion") if "meta_motion" in known else store.spark.createDataFrame([], shape)
    write_report({
        "audio": rp.audio_sheet(audio, motion, studies), "motion": rp.motion_sheet(motion, studies), "sync": rp.sync_sheet(sync, audio, studies),
        "cycles": rp.cycle_sheet(cycles, audio, sync, studies), "summary": rp.summary(audio, motion, sync, cycles, studies),
    }, path)
