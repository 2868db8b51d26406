"""Session defaults and the durable cut point shared by every multi-pass job."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "kymora", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder.

    Where none is named, a local session gets a temporary one. On a cluster that is an error: executors
    would write to their own disks and read back a part of the rows.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not named and (not sc.master.startswith("local") or sc.master.startswith("local-cluster")):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="kymora-checkpoint-"))
    return sc.getCheckpointDir()


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the checkpoint folder and continue from the written copy.

    Needed wherever a plan is used twice and its rows must be the same both times (range partition
    ids, for one), and wherever lineage must not reach back over a loop. Parquet rather than an RDD
    checkpoint: later steps read only the columns they use, and the planner knows the true size.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/stage-{uuid.uuid4().hex}"
    _stages.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_stages: list[str] = []


def file_system(path: str):
    """The file system of a path, and the path there."""
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def drop_stages() -> int:
    """Delete every stage that this process has written; frames that still read one can't be used after."""
    from pyarrow import fs

    dropped = 0
    while _stages:
        store, at = file_system(_stages.pop())
        if store.get_file_info(at).type == fs.FileType.Directory:
            store.delete_dir(at)
            dropped += 1
    return dropped


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


__all__ = ["build_session", "checkpoint_dir", "drop_stages", "durable", "file_system", "partitions"]
