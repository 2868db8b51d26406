"""CSV exports and report folders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kymora.functions import scalars as sc

SIGNAL_COLUMNS = ("ch1", "ch2", "ch3", "ch4")


def export_channels(
    df: DataFrame, keys: Sequence[str] = ("recording_id",), start: Column | None = None, stop: Column | None = None,
    fs: Column | None = None,
) -> DataFrame:
    """CSV-ready rows: lower-case names, numbers or null, six decimals, and a clock if none is there.

    Without ``tt`` the clock runs from ``start`` to ``stop`` over the rows, else by ``fs``, else it is
    the row number.
    """
    low = df.toDF(*[c.lower() for c in df.columns])
    clock = F.col("i").cast("double")
    if fs is not None:
        clock = F.when(fs > 0, F.coalesce(start, F.lit(0.0)) + F.col("i") / fs if start is not None else F.col("i") / fs).otherwise(clock)
    if "tt" not in low.columns and start is not None and stop is not None:
        n = low.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        low = low.join(n, list(keys))
        even = F.when(F.col("_n") > 1, start + (stop - start) * F.col("i") / (F.col("_n") - 1)).otherwise(start)
        clock = F.coalesce(even, clock)
    tt = sc.to_number(F.col("tt")) if "tt" in low.columns else clock
    cell = lambda c: sc.to_number(F.col(c)) if c in low.columns else F.lit(None).cast("double")
    fmt = lambda x: F.when(x.isNotNull(), F.format_string("%.6f", x))
    return low.select(*keys, "i", fmt(tt).alias("tt"), *[fmt(cell(c)).alias(c) for c in SIGNAL_COLUMNS])


def channel_summary(df: DataFrame, keys: Sequence[str], channels: Sequence[str] = SIGNAL_COLUMNS) -> DataFrame:
    """min, max, mean and whether there is any data, per channel."""
    long = df.unpivot(list(keys), list(channels), "channel", "x")
    x = F.when(~F.isnan("x"), F.col("x"))
    return long.groupBy(*keys, "channel").agg(
        F.min(x).alias("min"), F.max(x).alias("max"), F.avg(x).alias("mean"), (F.count(x) > 0).alias("has_data")
    )


def sheet_ready(df: DataFrame) -> DataFrame:
    """Arrays joined by ", " (empty ones null) and timestamps without zone."""

    def cell(f: T.StructField) -> Column:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.ArrayType):
            return F.when(F.size(c) > 0, F.array_join(F.transform(c, lambda x: x.cast("string")), ", ")).alias(f.name)
        if isinstance(f.dataType, T.TimestampType):
            return c.cast("timestamp_ntz").alias(f.name)
        return c.alias(f.name)

    return df.select(*[cell(f) for f in df.schema])


def write_report(sheets: dict[str, DataFrame], path: str, fmt: str = "parquet") -> None:
    """One folder per sheet."""
    for name, df in sheets.items():
        w = sheet_ready(df).write.mode("overwrite")
        (w.option("header", "true").csv if fmt == "csv" else w.parquet)(f"{path}/{name}")
