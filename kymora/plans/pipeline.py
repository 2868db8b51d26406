"""The whole job: raw signal and motion to judged movement cycles, in three restartable stages.

Every stage reads its inputs from stage tables and writes its outputs as stage tables, so a run may
begin at ``bin``, ``sync`` or ``cycles``. A recording that cannot be aligned becomes a status row, and
the final tables leave out every participant with a failed recording.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kymora.functions import scalars as sc
from kymora.operators import align as al
from kymora.operators import cycles as cy
from kymora.operators import detectors as dt
from kymora.operators import intervals as iv
from kymora.operators import spectral as sp
from kymora.operators import stomp as st
from kymora.operators.validate import stamp_version
from kymora.plans.blocks import BLOCK_ROWS
from kymora.session import file_system
from kymora.sources.adapters import CHANNELS, unpivot_channels
from kymora.sources.catalog import committed

KEYS = ["recording_id"]
CYCLE = ["recording_id", "cycle_index"]
STAGES = ("bin", "sync", "cycles")


class PublicationConflict(RuntimeError):
    """Another run published what this run had read."""


@dataclass(frozen=True)
class Publication:
    """One version: every table's folder, what this version changed, and for which recordings (None: all)."""

    version: int = 0
    tables: dict[str, str] = field(default_factory=dict)
    changed: tuple = ()
    only: tuple | None = None


@dataclass
class StageStore:
    """Named stage tables below one folder, published all at once.

    A run writes each table to a folder of its own and reads its own tables back. ``publish`` makes all of
    them current by one commit: a manifest is written aside and renamed to the folder of the next version, which
    fails if another run has taken that version (file systems with an atomic rename: POSIX, HDFS). The run
    then takes up the newer version and tries again; a run over some recordings (``only``) replaces the rows of
    these alone, so runs over different recordings all survive. What a run read since ``begin`` must not have
    been changed for its recordings meanwhile: that is a ``PublicationConflict``, and the run starts anew.
    """

    spark: SparkSession
    root: str
    only: tuple | None = None
    fresh: dict[str, str] = field(default_factory=dict)
    base: Publication | None = None
    used: set[str] = field(default_factory=set)

    def _manifest(self, version: int) -> dict:
        store, root = file_system(self.root)
        with store.open_input_stream(f"{root}/_log/{version:012d}/manifest.json") as f:
            return json.loads(f.read())

    def publication(self, version: int) -> Publication:
        told = self._manifest(version)
        return Publication(version, told["tables"], tuple(told["changed"]), None if told["only"] is None else tuple(told["only"]))

    def latest(self) -> Publication:
        """The current version; names alone are listed, and one manifest is read."""
        store, root = file_system(self.root)
        names = [f.base_name for f in store.get_file_info(fs.FileSelector(f"{root}/_log", allow_not_found=True))]
        versions = [int(n) for n in names if n.isdigit()]
        return self.publication(max(versions)) if versions else Publication()

    def begin(self) -> StageStore:
        """From here on all reads are of one version."""
        self.base, self.used = self.latest(), set()
        return self

    def current(self) -> dict[str, str]:
        """Folder of each published table."""
        return (self.base or self.latest()).tables

    def _new(self, name: str, df: DataFrame) -> str:
        path = f"{self.root}/{name}/{uuid.uuid4().hex}"
        df.write.parquet(path)
        return path

    def _mine(self, df: DataFrame, mine: bool = True) -> DataFrame:
        if self.only is None or "recording_id" not in df.columns:
            return df
        own = F.coalesce(F.col("recording_id").isin(*self.only), F.lit(False))
        return df.filter(own if mine else ~own)

    def write(self, name: str, df: DataFrame) -> DataFrame:
        self.fresh[name] = self._new(name, df)
        return self.read(name)

    def read(self, name: str) -> DataFrame:
        if name in self.fresh:
            return self.spark.read.parquet(self.fresh[name])
        self.used.add(name)
        return self._mine(self.spark.read.parquet(self.current()[name]))

    def _commit(self, new: Publication) -> bool:
        """Take the next version, unless it is taken."""
        store, root = file_system(self.root)
        name = uuid.uuid4().hex
        made, target = f"{root}/_log/new-{name}", f"{root}/_log/{new.version:012d}"
        store.create_dir(made, recursive=True)
        with store.open_output_stream(f"{made}/manifest.json") as f:
            f.write(json.dumps({"name": name, "tables": new.tables, "changed": new.changed, "only": new.only}).encode())
        try:
            store.move(made, target)  # a folder that is there already holds a manifest, so it is never replaced
        except OSError:
            pass
        won = self._manifest(new.version)["name"] == name
        for left in (made, f"{target}/new-{name}"):  # some systems move into the folder that is there
            if not won and store.get_file_info(left).type == fs.FileType.Directory:
                store.delete_dir(left)
        return won

    def _undisturbed(self, now: Publication) -> None:
        for version in range(self.base.version + 1, now.version + 1) if self.base else ():
            other = self.publication(version)
            met = self.only is None or other.only is None or not set(self.only).isdisjoint(other.only)
            if met and self.used & set(other.changed):
                raise PublicationConflict(f"version {version} changed {sorted(self.used & set(other.changed))}")

    def publish(self, update: Callable[[dict[str, DataFrame]], dict[str, DataFrame]] | None = None, attempts: int = 50) -> int:
        """Make this run's tables current, together with the rows of recordings that it left alone; the new version.

        ``update`` maps the current tables to the next snapshots of some of them, and is asked again where
        another run published in between.
        """
        kept: dict[tuple, str] = {}
        for _ in range(attempts):
            now = self.latest()
            self._undisturbed(now)
            tables = dict(now.tables)
            for name, path in self.fresh.items():
                old = now.tables.get(name)
                if self.only is not None and old:
                    if (name, old) not in kept:
                        rest = self._mine(self.spark.read.parquet(old), mine=False)
                        kept[name, old] = self._new(name, rest.unionByName(self.spark.read.parquet(path), allowMissingColumns=True))
                    path = kept[name, old]
                tables[name] = path
            changed = set(self.fresh)
            if update is not None:
                found = update({name: self.spark.read.parquet(path) for name, path in now.tables.items()})
                tables |= {name: self._new(name, df) for name, df in found.items()}
                changed |= set(found)
            if self._commit(Publication(now.version + 1, tables, tuple(sorted(changed)), self.only)):
                self.fresh.clear()
                self.base, self.used = None, set()
                return now.version + 1
        raise PublicationConflict(f"{attempts} attempts failed")


@dataclass(frozen=True)
class Settings:
    fs: float
    angle: str = "knee_angle"
    with_frequency: bool = False
    silence: float = dt.SILENCE_RMS
    flatline: float = dt.FLATLINE_VAR
    energy_threshold: float = cy.ENERGY_THRESHOLD
    rows: int = BLOCK_ROWS


def bin_stage(store: StageStore, signal: DataFrame, s: Settings) -> None:
    """Signal (with instantaneous frequency on request) and its bad intervals by kind and channel."""
    if s.with_frequency:
        signal = sp.instantaneous_frequency(signal, KEYS, CHANNELS, s.fs)
    signal = store.write("signal", signal)
    parts = {
        "dropout": dt.detect_dropout(signal, s.fs, silence=s.silence, flatline=s.flatline, rows=s.rows),
        "spike": dt.detect_spikes(signal, s.fs, rows=s.rows).drop("artifact_type"),
        "continuous": sp.continuous_noise(unpivot_channels(signal), [*KEYS, "channel"], "x", s.fs),
    }
    store.write("artifact_interval", stamp_version(dt.stage_record(parts), "audio"))


def sync_stage(store: StageStore, motion: DataFrame, recordings: DataFrame, s: Settings) -> None:
    """Stomp times, the aligned series, and one status row per recording.

    ``recordings`` has (recording_id, participant, knee, maneuver, left_stomp, right_stomp, pass_start,
    pass_end); the recorded knee's stomp is the motion-side anchor.
    """
    signal = store.read("signal")
    targets = recordings.select("recording_id", F.col("knee").alias("recorded_knee"), "left_stomp", "right_stomp")
    found = st.refine(signal, st.detect(signal, KEYS, s.fs), targets, KEYS, s.fs)
    anchor = F.when(F.col("knee") == "left", F.col("left_stomp")).otherwise(F.col("right_stomp"))
    spans = recordings.select("recording_id", anchor.alias("motion_stomp"), (F.col("pass_end") - F.col("pass_start")).alias("sync_duration"))
    lengths = signal.groupBy(*KEYS).agg((F.max("t") - F.min("t")).alias("audio_duration"))
    motion_lengths = motion.groupBy(*KEYS).agg((F.max("t") - F.min("t")).alias("motion_duration"))
    spans = spans.join(lengths, KEYS, "left").join(motion_lengths, KEYS, "left")
    record = store.write("sync_record", st.sync_record(found, spans, KEYS))
    bounds = record.join(recordings.select("recording_id", "pass_start", "pass_end"), KEYS).select(
        "recording_id", "audio_stomp", "motion_stomp", "pass_start", "pass_end"
    )
    synced, status = al.synchronize(signal, motion, bounds, KEYS, [s.angle], s.rows)
    synced = store.write("synced", synced)
    checked = al.validate_synced(synced, KEYS, CHANNELS, [s.angle]).select("recording_id", F.col("status").alias("_check"))
    whole = status.join(checked, KEYS, "left").withColumn(
        "ok", F.col("status").isin("ok", "partial") & F.coalesce(F.col("_check").isin("ok", "low_coverage"), F.lit(False))
    )
    named = whole.join(recordings.select("recording_id", "participant", F.col("maneuver").isNull().alias("_odd")), KEYS, "left")
    odd = F.coalesce("_odd", F.lit(False))
    store.write("sync_status", named.withColumn("status", F.when(odd, "unknown_maneuver").otherwise(F.col("status"))).withColumn("ok", F.col("ok") & ~odd).drop("_check", "_odd"))


def _renumber(synced: DataFrame) -> DataFrame:
    """Positions from zero inside the clipped series; clipping kept a contiguous range of samples."""
    first = synced.groupBy(*KEYS).agg(F.min("i").alias("_first"))
    return synced.join(first, KEYS).withColumn("i", F.col("i") - F.col("_first")).drop("_first")


def cycles_stage(store: StageStore, recordings: DataFrame, s: Settings) -> None:
    """Cycles, their artifacts and verdicts for every maneuver."""
    synced = _renumber(store.read("synced"))
    channels = st.channel_set(synced.columns)
    record = store.read("sync_record").select("recording_id", "audio_stomp", "motion_stomp")
    intervals = iv.shift(store.read("artifact_interval"), record, KEYS)
    kinds = recordings.select("recording_id", "maneuver")
    cuts, samples_by = [], {}
    for m in cy.CUT:
        part = synced.join(kinds.filter(F.col("maneuver") == m).select(*KEYS), KEYS, "left_semi")
        cuts.append(cy.cut_cycles(part, KEYS, s.angle, s.fs, m, s.rows))
    bounds = store.write("cycle_cut", reduce(DataFrame.unionByName, cuts))
    samples = store.write("cycle_sample", cy.samples_of_cycles(synced, bounds, KEYS, s.rows))
    cycles = cy.cycle_bounds(samples, CYCLE)
    windows = cycles.select(*CYCLE, F.col("start").alias("w_start"), F.col("end").alias("w_end"))
    exercise = cycles.groupBy(*KEYS).agg(F.min("start").alias("span_start"), F.max("end").alias("span_end"))
    hz = sp.movement_frequency(synced, KEYS, s.angle, s.fs)
    periodic = store.write("periodic_interval", sp.periodic_artifacts(synced, hz, exercise, KEYS, CHANNELS, s.fs, rows=s.rows))
    per_channel = intervals.filter("channel <> 'overall'")
    cont = per_channel.filter("kind = 'continuous'").select(*KEYS, "channel", "start", "end")
    drop = per_channel.filter("kind = 'dropout'").select(*KEYS, "channel", "start", "end")
    trimmed = {
        "intermittent": cy.intermittent_artifacts(samples, CYCLE, s.fs, rows=s.rows),
        "continuous": iv.trim_to_windows(cont, windows, KEYS),
        "periodic": iv.trim_to_windows(periodic, windows, KEYS),
    }
    artifacts = store.write("cycle_artifact", cy.cycle_artifacts(trimmed, CYCLE))
    bad = iv.in_bad_interval(iv.overlap_fraction(windows, iv.overall_segments(per_channel, KEYS), KEYS))
    # the same for each microphone, from its own intervals
    mic_windows = windows.withColumn("channel", F.explode(F.array(*[F.lit(c) for c in CHANNELS])))
    mic_bad = iv.merge_intervals(per_channel.select(*KEYS, "channel", "start", "end"), [*KEYS, "channel"], 0.0)
    bad_mic = iv.in_bad_interval(iv.overlap_fraction(mic_windows, mic_bad, [*KEYS, "channel"]))
    energy = cy.cycle_energy(samples, CYCLE, channels, s.rows)
    shapes, syncs = [], []
    for m in cy.CUT:
        samples_by[m] = samples.join(kinds.filter(F.col("maneuver") == m).select(*KEYS), KEYS, "left_semi")
        shapes.append(cy.shape_rules(samples_by[m], CYCLE, s.angle, m, rows=s.rows))
        syncs.append(cy.sync_quality(samples_by[m], CYCLE, s.angle, m, channels, rows=s.rows))
    two = cy.two_stage(energy, reduce(DataFrame.unionByName, shapes), CYCLE, s.energy_threshold)
    verdict = cy.verdicts(two, artifacts, reduce(DataFrame.unionByName, syncs), CYCLE, bad, bad_mic)
    all_kinds = artifacts.filter("kind <> 'all'").unionByName(
        iv.trim_to_windows(drop, windows, KEYS).withColumn("kind", F.lit("dropout")).select(*artifacts.columns)
    )
    wide = cy.artifact_record(cycles, all_kinds, CYCLE)
    table = verdict.join(wide, CYCLE).join(recordings.select("recording_id", "participant", "knee", "maneuver"), KEYS)
    store.write("cycle", stamp_version(committed(table, store.read("sync_status"), ["participant"]), "cycle"))


def run(
    store: StageStore, settings: Settings, recordings: DataFrame, signal: DataFrame | None = None, motion: DataFrame | None = None,
    start: str = "bin", only: Sequence | None = None, save: Callable | None = None, attempts: int = 3,
) -> DataFrame:
    """Run from ``start`` to the end and publish; ``only`` restricts the run to some recordings.

    Maneuvers may be given by code (fe, sts, walk) or name; any other becomes a failed status row. ``save``
    (``persist.updates``) maps the run's stage tables to changes of the metadata tables, which become current in the
    same publication. A run whose inputs another run replaced starts anew, ``attempts`` times at most. The
    result has the cycles of the recordings of this run.
    """
    recordings = recordings.withColumn("maneuver", sc.maneuver_name(F.col("maneuver")))
    if only is not None:
        recordings = recordings.filter(F.col("recording_id").isin(*only))
        signal = signal.filter(F.col("recording_id").isin(*only)) if signal is not None else None
        motion = motion.filter(F.col("recording_id").isin(*only)) if motion is not None else None
    at = STAGES.index(start)
    for left in reversed(range(attempts)):
        mine = StageStore(store.spark, store.root, tuple(only) if only is not None else None).begin()
        if at <= 0:
            bin_stage(mine, signal, settings)
        if at <= 1:
            sync_stage(mine, motion, recordings, settings)
        cycles_stage(mine, recordings, settings)
        out = mine.read("cycle")
        try:
            mine.publish(save(mine, recordings) if save else None)
            return out
        except PublicationConflict:
            if not left:
                raise
    raise ValueError("attempts must be 1 or more")
