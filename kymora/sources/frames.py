"""Stored frames: files of bounded number and size, sorted by recording, with a manifest of what each holds.

A folder per recording gives as many folders as there are recordings, and one file as large as the longest. Here
rows go to files by a range shuffle over (hashed bucket of the recording, recording, order): every file holds a
contiguous stretch of about ``rows_per_file`` rows, a hot recording takes several files and many short ones
share one. The manifest has one row a file with its first and last place, so a read of some recordings opens the
files that can hold them and no others: wanted keys meet the manifest by bucket and the rows by a join, however many
there are. Files are written first and the manifest last: without a manifest there is
nothing to read, and a rewrite goes to a new folder.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from kymora.operators import spectral as sp
from kymora.operators.tables import null_safe
from kymora.session import durable

ROWS_PER_FILE = 1 << 22
TASKS = 1024  # more files than that are cut from larger sorted partitions
BUCKET = "_bucket"


def _bucket(key: Sequence[str | Column]) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(1 << 16)).cast("int")


def write_frames(
    df: DataFrame, path: str, key: Sequence[str] = ("recording_id",), order: Sequence[str] = ("i",), rows_per_file: int = ROWS_PER_FILE
) -> DataFrame:
    """Write rows and their manifest below ``path``; the manifest (file, n_rows, low, high)."""
    key, order, spark = list(key), list(order), df.sparkSession
    df = durable(df)  # counted, then cut; both must see the same rows
    rows = df.count()
    files = max(1, -(-rows // rows_per_file))
    tasks = min(files, max(TASKS, -(-rows // ROWS_PER_FILE)))
    cut = df.withColumn(BUCKET, _bucket(key)).repartitionByRange(tasks, BUCKET, *key, *order).sortWithinPartitions(BUCKET, *key, *order)
    out = cut.write.mode("error")
    (out if tasks == files else out.option("maxRecordsPerFile", rows_per_file)).parquet(f"{path}/rows")
    place = F.struct(BUCKET, *key)
    told = spark.read.schema(cut.schema).parquet(f"{path}/rows").groupBy(F.col("_metadata.file_path").alias("file"))
    manifest = told.agg(F.count(F.lit(1)).alias("n_rows"), F.min(place).alias("low"), F.max(place).alias("high"))
    manifest.coalesce(1).write.mode("error").parquet(f"{path}/manifest")
    return spark.read.parquet(f"{path}/manifest")


def read_frames(spark: SparkSession, path: str, keys: Sequence | DataFrame | None = None) -> DataFrame:
    """All rows, or those of some keys: a value each, a tuple where the key has several parts, or a table of them."""
    manifest = spark.read.parquet(f"{path}/manifest")
    rows = spark.read.parquet(f"{path}/rows")
    if keys is None:
        return rows.drop(BUCKET)
    names = [f.name for f in manifest.schema["low"].dataType.fields if f.name != BUCKET]
    if isinstance(keys, DataFrame):
        wanted = keys.select(*[F.col(n).cast(rows.schema[n].dataType).alias(n) for n in names]).distinct()
    else:
        parts = [k if isinstance(k, tuple) else (k,) for k in keys]
        wanted = F.broadcast(spark.createDataFrame(parts, StructType([StructField(n, rows.schema[n].dataType) for n in names])))
    place = F.struct(BUCKET, *names)
    spans = manifest.withColumn(BUCKET, F.explode(F.sequence("low." + BUCKET, "high." + BUCKET)))
    found = wanted.withColumn(BUCKET, _bucket(names)).withColumn("_place", place).join(spans, BUCKET)
    files = [r["file"] for r in found.filter((F.col("_place") >= F.col("low")) & (F.col("_place") <= F.col("high"))).select("file").distinct().collect()]
    if not files:
        return rows.filter("false").drop(BUCKET)
    own = wanted.select(*[F.col(n).alias(f"_k_{n}") for n in names])
    held = spark.read.schema(rows.schema).parquet(*files)
    return held.join(own, null_safe(held, own, [(n, f"_k_{n}") for n in names]), "left_semi").drop(BUCKET)


def write_spectrograms(samples: DataFrame, path: str, channels: Sequence[str], keys: Sequence[str], fs: float, nperseg: int = 2048, noverlap: int = 1536, **how) -> DataFrame:
    """Decibel spectrograms of all channels as stored frames (keys, channel, frame, t, db ARRAY<FLOAT>)."""
    keys = list(keys)
    long = samples.unpivot([*keys, "i"], list(channels), "channel", "x")
    return write_frames(sp.spectrogram(long, [*keys, "channel"], "x", fs, nperseg, noverlap), path, keys, ["channel", "frame"], **how)
