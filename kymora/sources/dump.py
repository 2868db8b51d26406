"""Device dumps: a splittable Spark data source for the packed words, decoded by native expressions.

Layout: 512 header bytes, packets of 5504 data and 128 time words, zero-padded 512-byte blocks at the
end, and one 512-byte block of four tick counters before the padding.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from kymora.operators.windows import unwrap_counter

# Layout of the dump.
HEADER_BYTES = 512
BLOCK_BYTES = 512
DATA_WORDS = 5504
TIME_WORDS = 128
PACKET_BYTES = (DATA_WORDS + TIME_WORDS) * 4
TICKS_PER_SECOND = 4096.0
SAMPLE_RATE = 46875.0
FILETIME_UNIX_OFFSET_S = 11644473600

PACKETS_PER_SPLIT = 512


def _open(path: str):
    from pyarrow import fs

    system, name = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path.removeprefix("file:"))
    return system, name


def data_end(handle, size: int) -> int:
    """Offset where the zero padding starts (whole blocks only), read backwards from the file end."""
    end = HEADER_BYTES + (size - HEADER_BYTES) // BLOCK_BYTES * BLOCK_BYTES
    while end > HEADER_BYTES:
        start = max(HEADER_BYTES, end - 128 * BLOCK_BYTES)
        handle.seek(start)
        chunk = handle.read(end - start)
        for k in range(len(chunk) // BLOCK_BYTES, 0, -1):
            if any(chunk[(k - 1) * BLOCK_BYTES : k * BLOCK_BYTES]):
                return start + k * BLOCK_BYTES
        end = start
    return HEADER_BYTES


class PacketRange(InputPartition):
    def __init__(self, path: str, size: int, first: int, last: int):
        super().__init__((path, first))
        self.path, self.size, self.first, self.last = path, size, first, last


class DumpReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.paths = [p for p in options["path"].split(",") if p]
        self.step = int(options.get("packetsPerSplit", PACKETS_PER_SPLIT))

    def partitions(self) -> Sequence[InputPartition]:
        from pyarrow import fs

        splits = []
        for path in self.paths:
            system, name = _open(path)
            # what from_uri took off the front; listed files need it again to be opened on an executor
            scheme = path.rstrip("/").removesuffix(name.rstrip("/")) if "://" in path else ""
            info = system.get_file_info(name)
            files = system.get_file_info(fs.FileSelector(name, recursive=True)) if info.type == fs.FileType.Directory else [info]
            for f in files:
                if f.type == fs.FileType.File and f.path.endswith(".bin"):
                    packets = max((f.size - HEADER_BYTES - BLOCK_BYTES) // PACKET_BYTES, 0)
                    full = path if len(files) == 1 and f.path == name else f"{scheme}{f.path}"
                    splits += [PacketRange(full, f.size, k, min(k + self.step, packets)) for k in range(0, packets, self.step)]
        return splits

    def read(self, partition: PacketRange) -> Iterator:
        import numpy as np
        import pyarrow as pa

        system, name = _open(partition.path)
        with system.open_input_file(name) as handle:
            usable = (data_end(handle, partition.size) - BLOCK_BYTES - HEADER_BYTES) // PACKET_BYTES
            for packet in range(partition.first, min(partition.last, usable)):
                handle.seek(HEADER_BYTES + packet * PACKET_BYTES)
                words = np.frombuffer(handle.read(PACKET_BYTES), dtype="<u4").astype("int64")
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([partition.path] * len(words)), pa.array(np.full(len(words), packet), pa.int64()),
                        pa.array(np.arange(len(words)), pa.int32()), pa.array(words),
                    ],
                    names=["file", "packet", "j", "word"],
                )


class DeviceDump(DataSource):
    """``spark.read.format("device_dump").load(path)``: (file, packet, j, word)."""

    @classmethod
    def name(cls) -> str:
        return "device_dump"

    def schema(self) -> str:
        return "file string, packet bigint, j int, word bigint"

    def reader(self, schema) -> DumpReader:
        return DumpReader(self.options)


def read_words(spark: SparkSession, path: str, **options: str) -> DataFrame:
    spark.dataSource.register(DeviceDump)
    return spark.read.format("device_dump").options(**options).load(path)


def _little_endian(content: Column, at: int, size: int) -> Column:
    """Unsigned little-endian integer at byte ``at`` of a binary column."""
    hexed = F.hex(F.substring(content, at + 1, size))
    swapped = F.concat(*[F.substring(hexed, 2 * k + 1, 2) for k in reversed(range(size))])
    return F.conv(swapped, 16, 10).cast("decimal(20,0)")


class DumpTicks(DataSource):
    """``device_dump_ticks``: header bytes and tick counters, one row per dump, without reading the rest."""

    @classmethod
    def name(cls) -> str:
        return "device_dump_ticks"

    def schema(self) -> str:
        return "file string, length bigint, header binary, start_tick bigint, stop_tick bigint, first_tick bigint, second_tick bigint"

    def reader(self, schema) -> DataSourceReader:
        return TickReader(self.options)


class TickReader(DumpReader):
    def partitions(self) -> Sequence[InputPartition]:
        return [p for p in super().partitions() if p.first == 0]

    def read(self, partition: PacketRange) -> Iterator:
        import numpy as np

        system, name = _open(partition.path)
        with system.open_input_file(name) as handle:
            header = handle.read(HEADER_BYTES)
            handle.seek(data_end(handle, partition.size) - BLOCK_BYTES)
            ticks = np.frombuffer(handle.read(16), dtype="<u4")
        yield (partition.path, partition.size, header, *[int(x) for x in ticks])


def read_ticks(spark: SparkSession, path: str) -> DataFrame:
    spark.dataSource.register(DumpTicks)
    return spark.read.format("device_dump_ticks").load(path)


def read_headers(spark: SparkSession, path: str) -> DataFrame:
    """One row per dump: serials, revision, firmware, block count and file time."""
    raw = read_ticks(spark, path)
    c = F.col("header")
    ticks = F.conv(F.hex(F.substring(c, 66, 8)), 16, 10).cast("decimal(20,0)")
    return raw.select(
        "file", "length",
        F.array(*[_little_endian(c, k, 4).cast("long") for k in (0, 4, 8, 12)]).alias("device_serial"),
        _little_endian(c, 16, 2).cast("int").alias("project_number"),
        _little_endian(c, 18, 2).cast("int").alias("hardware_major"), _little_endian(c, 20, 2).cast("int").alias("hardware_minor"),
        _little_endian(c, 22, 2).cast("int").alias("unit_serial"),
        _little_endian(c, 24, 4).cast("long").alias("firmware_version"), _little_endian(c, 61, 4).cast("long").alias("sd_blocks"),
        F.timestamp_micros((ticks / 10).cast("long") - FILETIME_UNIX_OFFSET_S * 1_000_000).alias("file_time"),
        F.lit(SAMPLE_RATE).alias("fs"),
    )


def volts(code: Column, bits: int = 16) -> Column:
    """Two's-complement code to volts."""
    signed = F.when(code >= F.lit(1 << (bits - 1)), code - F.lit(1 << bits)).otherwise(code)
    return signed * F.lit(2.0) * F.lit(4.5) * F.sqrt(F.lit(2.0)) / F.lit(float(1 << bits)) + F.lit(1.5)


def unpack(words: DataFrame, keys: Sequence[str] = ("file",)) -> DataFrame:
    """Pairs of words to one sample of four channels: (keys, i, ch1..ch4) in volts.

    Two words meet in one group, so the aggregation combines inside the scan task; the sample number
    comes from the packet number, without any pass over the series.
    """
    pair = F.floor(F.col("j") / 2).cast("long")
    per_packet = DATA_WORDS // 2
    hi = F.shiftrightunsigned("word", 16).bitwiseAND(F.lit(65535))
    lo = F.col("word").bitwiseAND(F.lit(65535))
    even = F.col("j") % 2 == 0
    data = words.filter(F.col("j") < DATA_WORDS).select(
        *keys, (F.col("packet") * per_packet + pair).alias("i"), even.alias("_even"), hi.alias("_hi"), lo.alias("_lo")
    )
    g = data.groupBy(*keys, "i").agg(
        F.max(F.when(F.col("_even"), F.col("_hi"))).alias("_1"), F.max(F.when(F.col("_even"), F.col("_lo"))).alias("_2"),
        F.max(F.when(~F.col("_even"), F.col("_hi"))).alias("_3"), F.max(F.when(~F.col("_even"), F.col("_lo"))).alias("_4"),
    )
    return g.select(*keys, "i", *[volts(F.col(f"_{k}")).alias(f"ch{k}") for k in (1, 2, 3, 4)])


def clock(samples: DataFrame, ticks: DataFrame, keys: Sequence[str] = ("file",), fs: float = SAMPLE_RATE) -> DataFrame:
    """Sample time from the index and the dump's tick counters."""
    buffered = (DATA_WORDS // 2) / fs
    t0 = F.col("first_tick") / TICKS_PER_SECOND - F.lit(buffered) - F.col("start_tick") / TICKS_PER_SECOND
    timed = samples.join(ticks.select(*keys, t0.alias("_t0")), list(keys))
    return timed.withColumn("t", F.col("i") / F.lit(fs) + F.col("_t0")).drop("_t0")


def time_blocks(words: DataFrame, keys: Sequence[str] = ("file",)) -> DataFrame:
    """Unwrapped tick counters of the time words, in seconds: (keys, i, tick, seconds)."""
    ticks = words.filter((F.col("j") >= DATA_WORDS) & (F.col("word") != 0)).select(
        *keys, (F.col("packet") * TIME_WORDS + F.col("j") - DATA_WORDS).alias("i"), F.col("word").alias("tick")
    )
    return unwrap_counter(ticks, keys, "tick", "unwrapped", 2**32).withColumn("seconds", F.col("unwrapped") / TICKS_PER_SECOND)


def read_signal(spark: SparkSession, path: str) -> DataFrame:
    """Dump files to (recording_id, i, t, ch1..ch4)."""
    s = clock(unpack(read_words(spark, path)), read_ticks(spark, path))
    return s.select(F.col("file").alias("recording_id"), "i", "t", "ch1", "ch2", "ch3", "ch4")
