"""Views of the delivered tables as the engine's own inputs (signals, waveforms, markers)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kymora.plans.blocks import with_sample_index
from kymora.session import partitions

SIGNAL_FS = 100.0
EVENTS_ORIGIN = "TIMESTAMP_NTZ '2024-01-01 00:00:00'"  # zero of the event clock
CHANNELS = ("ch1", "ch2", "ch3", "ch4")

ROWS_PER_TASK = 1 << 19

_built: dict[tuple, DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _signature(spark: SparkSession, path: str) -> tuple:
    """Names, sizes and times of the files behind a path, so a changed source is never served stale."""
    of = "_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time"
    return tuple(sorted(map(tuple, spark.read.parquet(path).select(*of).distinct().collect())))


def _stage(spark: SparkSession, sf_dir: str, name: str, source: str, build) -> DataFrame:
    """A stage table written once per application (by ``with_sample_index``) and read by every later job."""
    key = (spark.sparkContext.applicationId, name, _signature(spark, f"{sf_dir}/{source}.parquet"))
    if key not in _built:
        _built[key] = build()
    return _built[key]


def _parts(rows: DataFrame) -> int:
    """Partitions for ordering a source: more than the session's where a task would get too many rows."""
    return max(partitions(rows.sparkSession), -(-rows.count() // ROWS_PER_TASK))


def signal_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four-channel series per supplier: (recording_id, i, t, ch1..ch4)."""

    def build() -> DataFrame:
        li = table(spark, sf_dir, "lineitem").select(
            F.col("l_suppkey").alias("recording_id"),
            "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey",
            (F.col("l_quantity") / 51).alias("ch1"),
            (F.col("l_extendedprice") / 104729).alias("ch2"),
            F.col("l_discount").alias("ch3"),
            F.col("l_tax").alias("ch4"),
        )
        order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "ch1", "ch2", "ch3", "ch4"]
        indexed = with_sample_index(li, ["recording_id"], order, kept=["recording_id", *CHANNELS], parts=_parts(li))
        return indexed.select("recording_id", "i", (F.col("i") / SIGNAL_FS).alias("t"), *CHANNELS)

    return _stage(spark, sf_dir, "signal_multi", "lineitem", build)


def signal_irregular(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unevenly sampled single channel per user: (recording_id, i, t, v, event, event_id)."""

    def build() -> DataFrame:
        ev = table(spark, sf_dir, "events").select(
            F.col("user_id").alias("recording_id"),
            (F.expr(f"timestampdiff(MICROSECOND, {EVENTS_ORIGIN}, ts)") / F.lit(1e6)).alias("t"),
            F.col("value").alias("v"), F.col("event_type").alias("event"), "event_id",
        )
        return with_sample_index(ev, ["recording_id"], ["t", "event_id"], parts=_parts(ev))

    return _stage(spark, sf_dir, "signal_irregular", "events", build)


def waveform(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Short fixed-length waveforms: (recording_id, label, x ARRAY<DOUBLE>)."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("recording_id"), "label", F.col("embedding").cast("array<double>").alias("x")
    )


def unpivot_channels(signal: DataFrame, channels=CHANNELS) -> DataFrame:
    """One row per sample and channel: (recording_id, channel, i, t, x)."""
    return signal.unpivot(["recording_id", "i", "t"], list(channels), "channel", "x")


def markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event names with passes and section headers, in row order per user."""
    e = signal_irregular(spark, sf_dir)
    number = (F.floor(F.col("i") / 4) + 1).cast("string")
    name = (
        F.when(F.col("event") == "error", F.lit("Fast Speed"))
        .when(F.col("event") == "signup", F.lit("Slow Speed"))
        .when(F.col("event") == "click", F.concat(F.lit("Pass "), number, F.lit(" Start")))
        .otherwise(F.concat(F.lit(" Pass "), number, F.lit(" End ")))
    )
    return e.select("recording_id", "i", "t", F.col("i").alias("row"), name.alias("event"))


def studies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enrolments: (id, study_name, study_participant_id)."""
    c = table(spark, sf_dir, "customer")
    study = F.when(F.col("c_nationkey") % 3 == 0, "AOA").when(F.col("c_nationkey") % 3 == 1, "preOA").otherwise("SMoCK")
    return c.select(F.col("c_custkey").alias("id"), study.alias("study_name"), (F.col("c_custkey") + 1000).alias("study_participant_id"))


def _knee(key: str) -> Column:
    return F.when(F.col(key) % 2 == 0, "left").otherwise(F.lit("right"))


def audio_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One audio record per order."""
    o = table(spark, sf_dir, "orders")
    stamp = F.date_format("o_orderdate", "yyyyMMdd")
    maneuver = F.when(F.col("o_orderstatus") == "F", "walk").when(F.col("o_orderstatus") == "O", "sts").otherwise(F.lit("fe"))
    return o.select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("study_id"),
        F.concat(F.lit("HP_W11.2-"), F.col("o_custkey").cast("string"), F.lit("-"), stamp, F.lit("_"),
                 F.lpad((F.col("o_orderkey") % 86400 % 24 * 10000).cast("string"), 6, "0"), F.lit(".bin")).alias("audio_file_name"),
        _knee("o_orderkey").alias("knee"), maneuver.alias("maneuver"),
        F.when(F.col("o_orderkey") % 3 > 0, F.col("o_orderkey")).alias("biomechanics_import_id"),
        F.col("o_totalprice").alias("file_size_mb"), F.col("o_orderdate").alias("recording_date"),
        F.col("o_orderdate").alias("recording_time"), F.col("o_orderdate").alias("file_time"),
        (F.col("o_orderpriority") != "5-LOW").alias("is_active"),
    )


def motion_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One motion import per order."""
    a = audio_table(spark, sf_dir)
    return a.select(
        "id", "study_id", F.concat(F.lit("AOA"), (F.col("study_id") + 1000).cast("string"), F.lit("_"), F.col("id").cast("string")).alias("biomechanics_file"),
        F.when(F.col("id") % 5 == 0, "Gonio").otherwise("Motion Analysis").alias("biomechanics_type"),
        "knee", "maneuver", F.lit(100.0).alias("biomechanics_sample_rate"), F.col("file_size_mb").alias("duration_seconds"),
        (F.col("id") % 7).alias("num_data_points"), (F.col("id") % 4).cast("int").alias("pass_number"), "is_active",
    )


def sync_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One synchronisation per order line number, with null pass and speed outside walking."""
    li = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(
        F.min("l_quantity").alias("q"), F.min("l_shipdate").alias("d"), F.min("l_returnflag").alias("flag"), F.min("l_linestatus").alias("st"))
    a = audio_table(spark, sf_dir).select(F.col("id").alias("l_orderkey"), "study_id", "knee", "maneuver")
    walk = F.col("maneuver") == "walk"
    speed = F.when(F.col("flag") == "A", "slow").when(F.col("flag") == "N", "medium").otherwise("fast")
    return li.join(a, "l_orderkey").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), "study_id", "knee", "maneuver",
        F.when(walk, F.col("l_linenumber")).alias("pass_number"), F.when(walk, speed).alias("speed"),
        F.col("l_orderkey").alias("audio_processing_id"), F.concat(F.lit("sync_"), (F.col("l_orderkey") % 5000).cast("string")).alias("sync_file_name"),
        F.col("q").alias("sync_duration"), (F.col("st") == "F").alias("is_active"),
    )


def cycle_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One movement cycle per order, line number and part."""
    li = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber", "l_partkey").agg(
        F.sum("l_quantity").alias("q"), F.max("l_extendedprice").alias("p"), F.min("l_discount").alias("d"))
    a = audio_table(spark, sf_dir).select(F.col("id").alias("l_orderkey"), "study_id", "knee", "maneuver")
    return li.join(a, "l_orderkey").select(
        (F.col("l_orderkey") * 1000000 + F.col("l_linenumber") * 100000 + F.col("l_partkey")).alias("id"), "study_id", "knee", "maneuver",
        F.col("l_orderkey").alias("audio_processing_id"),
        F.when(F.col("l_linenumber") < 7, F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("synchronization_id"),
        F.lit(None).cast("int").alias("pass_number"), F.lit(None).cast("string").alias("speed"),
        F.col("l_partkey").cast("int").alias("cycle_index"), F.col("q").alias("start_time_s"), (F.col("q") + F.col("p") / 997).alias("end_time_s"),
        (F.col("p") / 997).alias("duration"), (F.col("d") > 0.07).alias("is_outlier"), (F.col("d") < 0.09).alias("is_active"),
    )
