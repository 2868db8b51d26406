"""What the operators of this folder share: column picking, byte-bounded slices, written stages."""

from __future__ import annotations

import ctypes
import sys
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE_BYTES = 8 << 20  # text handled at once inside a task
WORD_SPLIT = r"[\x20\x09-\x0D]+"


def pick(df: DataFrame, *names: str) -> DataFrame:
    """The named columns and no others; an exact spelling wins over one that differs in case only."""
    at = [place_of(df.columns, name) for name in names]
    if -1 in at:
        raise ValueError(f"column {names[at.index(-1)]} is missing; there are {df.columns}")
    return plain(df)[0].select(*[F.col(f"c{i}").alias(n) for i, n in zip(at, names)])


def texts(docs: DataFrame, *more: Column) -> DataFrame:
    """(doc_id, raw): every text whole, as UTF-8 bytes; null counts as empty."""
    return pick(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("raw"), *more
    )


@lru_cache(maxsize=1)
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="llm-stages-")


def shared_folder(spark: SparkSession) -> str:
    """A new path below the shared folder that the cluster names in ``spark.checkpoint.dir``.

    Where nothing is named, a local session gets a temporary folder; on a cluster that is an error, since
    a machine's own folder is not seen by the other machines.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        master = spark.conf.get("spark.master", "") or ""
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        named = _own_folder()
    app = spark.conf.get("spark.app.id", "app")
    return f"{named.rstrip('/')}/llm-{app}/{uuid.uuid4().hex}"


def stage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and go on from the written rows.

    For plans that are used more than once and must give the same rows each time, and to cut the
    lineage of loops: a lost executor then costs a reread, not a recomputation.
    """
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def plain(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """``df`` with its columns called c0, c1, ..., and their names: no name of ours can clash with them."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))]), df.columns


def place_of(names: list[str], name: str) -> int:
    """Where a column stands; an exact spelling wins over one that differs in case only; -1 if nowhere."""
    exact = [i for i, c in enumerate(names) if c == name]
    loose = [i for i, c in enumerate(names) if c.lower() == name.lower()]
    return (exact or loose or [-1])[0]


def give_back() -> None:
    """Return to the system what earlier slices and tasks of this worker have freed."""
    pa.default_memory_pool().release_unused()
    trim = _trim()
    if trim:
        trim(0)


@lru_cache(maxsize=1)
def _trim():
    try:
        return ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError):  # not the GNU library
        return None


def tidy(run: Callable) -> Callable:
    """``run`` for ``mapInArrow``; when a task ends, its worker gives back what the task held.

    A worker stays for the next task, which may be another stage's, or the JVM's own while the worker waits.
    """

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            chunks = sys.modules.get("kymora.llm.chunks")
            if chunks:
                chunks.forget()
            give_back()

    return tidied


def slices(batches: Iterator[pa.RecordBatch], column: str | int, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about equal bytes of ``column``; a longer row stands alone."""
    for batch in batches:
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_pylist()
        first, held = 0, 0
        for i, size in enumerate(sizes):
            if held and held + size > most:
                yield batch.slice(first, i - first)
                first, held = i, 0
            held += size
        if first < len(sizes):
            yield batch.slice(first)


def with_text(df: DataFrame, names: list[str], text: Column, changed: Column) -> DataFrame:
    """The columns c0, c1, ... under their names, with a new text, and its length where it changed."""
    t, n = place_of(names, "text"), place_of(names, "n_chars")
    out = []
    for i, name in enumerate(names):
        c = F.col(f"c{i}")
        if i == t:
            c = F.when(changed, text).otherwise(c)
        elif i == n:
            c = F.when(changed, F.length(text).cast(df.schema[f"c{i}"].dataType)).otherwise(c)
        out.append(c)
    return df.select(*out).toDF(*names)


def batch_of(columns: dict[str, Sequence], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, schema.field(n).type) for n, c in columns.items()], schema=schema
    )


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
