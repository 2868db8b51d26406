"""Discrete Fourier transforms of series that are too long for one row, by two shuffles.

A length is split as n = n1 * n2 and sample i = i1 * n2 + i2. Transforms of length n1 run over i1 for each i2, are
turned by exp(-2 pi j i2 f1 / n), and transforms of length n2 run over i2 for each f1: the value at f1 + n1 * f2.
Each of the two steps groups whole rows or columns up to ``ROWS`` samples, so no group holds more than
that, however long the series. A length without such a split is brought to a power of two by the chirp rule:
the transform is a convolution with a chirp, which takes three transforms of a length that can be split.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kymora.plans.blocks import KEY, with_key
from kymora.plans.grouped import grouped_map
from kymora.session import durable

ROWS = 1 << 16


def factors(n: int, most: int = ROWS) -> tuple[int, int] | None:
    """The split of a length into two parts of at most ``most``, the closest to a square; None if there is none."""
    a = int(np.sqrt(n))
    while a > 0 and n // a <= most:
        if n % a == 0:
            return a, n // a
        a -= 1
    return None


def chirp_length(n: int) -> int:
    """The power of two that holds a convolution of a series with its chirp."""
    return 1 << int(2 * n - 2).bit_length()


def _split(n: Column, most: int) -> Column:
    @F.pandas_udf("struct<n1:bigint,n2:bigint>")
    def kernel(col: pd.Series) -> pd.DataFrame:
        known = {k: factors(int(k), most) for k in col.unique()}
        return pd.DataFrame([known[k] or (None, None) for k in col], columns=["n1", "n2"], dtype="Int64")

    return kernel(n)


def dft(series: DataFrame, keys: Sequence[str], sign: int = -1, most: int = ROWS) -> DataFrame:
    """(keys, n, i = frequency, re, im) of series (keys, n, i, re, im) whose lengths can be split; missing samples are zeros."""
    keys = list(keys)
    lengths = series.select("n").distinct().withColumn("_f", _split(F.col("n"), most)).select("n", F.col("_f.n1").alias("n1"), F.col("_f.n2").alias("n2"))
    work = series.join(lengths, "n")
    group = [*keys, "n", "n1", "n2", "_c"]
    per = lambda other: F.greatest(F.floor(F.lit(most) / F.col(other)), F.lit(1)).cast("long")

    def columns(g: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        n, n1, n2 = (int(g[c][0]) for c in ("_len", "_len1", "_len2"))
        i1, i2 = np.divmod(g["i"], n2)
        at, place = np.unique(i2, return_inverse=True)
        table = np.zeros((n1, len(at)), complex)
        table[i1, place] = g["re"] + 1j * g["im"]
        out = np.fft.fft(table, axis=0) if sign < 0 else np.fft.ifft(table, axis=0) * n1
        f1 = np.arange(n1)
        out *= np.exp(sign * 2j * np.pi * ((f1[:, None] * at) % n) / n)
        return {"f1": np.repeat(f1, len(at)), "i2": np.tile(at, n1), "re": out.real.ravel(), "im": out.imag.ravel()}

    def rows(g: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        n1, n2 = int(g["_len1"][0]), int(g["_len2"][0])
        at, place = np.unique(g["f1"], return_inverse=True)
        table = np.zeros((len(at), n2), complex)
        table[place, g["i2"]] = g["re"] + 1j * g["im"]
        out = np.fft.fft(table, axis=1) if sign < 0 else np.fft.ifft(table, axis=1) * n2
        f = at[:, None] + n1 * np.arange(n2)
        return {"i": f.ravel(), "re": out.real.ravel(), "im": out.imag.ravel()}

    own = {"_len": F.col("n"), "_len1": F.col("n1"), "_len2": F.col("n2")}
    first = work.withColumn("_c", F.floor((F.col("i") % F.col("n2")) / per("n1")).cast("long")).withColumns(own)
    turned = grouped_map(first, group, ["i"], ["i", "re", "im", *own], "f1 bigint, i2 bigint, re double, im double", columns)
    second = turned.withColumn("_c", F.floor(F.col("f1") / per("n2")).cast("long")).withColumns(own)
    done = grouped_map(second, group, ["f1", "i2"], ["f1", "i2", "re", "im", *own], "i bigint, re double, im double", rows)
    return done.select(*keys, "n", "i", "re", "im")


def _chirp(i: Column, n: Column, sign: int) -> tuple[Column, Column]:
    """exp(sign * pi j i^2 / n), its angle reduced before it is rounded."""
    angle = F.lit(sign * np.pi) * ((i * i) % (2 * n)) / n
    return F.cos(angle), F.sin(angle)


def _times(df: DataFrame, a: tuple[Column, Column], b: tuple[Column, Column], scale: Column | None = None) -> DataFrame:
    re, im = a[0] * b[0] - a[1] * b[1], a[0] * b[1] + a[1] * b[0]
    return df.withColumns({"re": re if scale is None else re / scale, "im": im if scale is None else im / scale})


def spectrum(series: DataFrame, keys: Sequence[str], most: int = ROWS) -> DataFrame:
    """(keys, n, i, re, im) of real series (keys, n, i, x), i from 0 to n / 2, for series of any length."""
    keys = list(keys)
    base = durable(series.select(*keys, F.col("n").cast("long").alias("n"), F.col("i").cast("long").alias("i"), F.col("x").cast("double").alias("re"), F.lit(0.0).alias("im")))
    odd = durable(base.select("n").distinct().withColumn("_f", _split(F.col("n"), most)).filter("_f.n1 IS NULL").select("n"))
    half = F.col("i") <= F.floor(F.col("n") / 2)
    if odd.isEmpty():
        return dft(base, keys, -1, most).filter(half)
    even = dft(base.join(odd, "n", "left_anti"), keys, -1, most).filter(half)
    long = base.join(odd, "n", "left_semi").withColumn("_n", F.col("n"))
    m = F.expr("shiftleft(1L, length(bin(2 * _n - 2)))")  # as chirp_length
    own = [*keys, "_n"]
    turned = _times(long, (F.col("re"), F.col("im")), _chirp(F.col("i"), F.col("_n"), -1)).withColumn("n", m)
    a = dft(turned.select(*own, "n", "i", "re", "im"), own, -1, most)
    # the chirp of each length once: it stands at i and, from the end, at -i
    lengths = odd.select(F.col("n").alias("_n")).withColumn("n", m)
    spread = lengths.withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)))
    spots = spread.withColumn("i", F.explode(F.when(F.col("k") > 0, F.array("k", F.col("n") - F.col("k"))).otherwise(F.array("k"))))
    c = _chirp(F.col("k"), F.col("_n"), 1)
    b = dft(spots.select("_n", "n", "i", c[0].alias("re"), c[1].alias("im")), ["_n"], -1, most)
    both = a.join(b.select("_n", "i", F.col("re").alias("_re"), F.col("im").alias("_im")), ["_n", "i"])
    product = _times(both, (F.col("re"), F.col("im")), (F.col("_re"), F.col("_im")), F.col("n"))
    back = dft(product.select(*own, "n", "i", "re", "im"), own, 1, most).filter(F.col("i") <= F.floor(F.col("_n") / 2))
    done = _times(back, (F.col("re"), F.col("im")), _chirp(F.col("i"), F.col("_n"), -1))
    return even.unionByName(done.select(*keys, F.col("_n").alias("n"), "i", "re", "im"))


def numbered(samples: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``samples`` with ``n``, the size of their key, and i counted from 0; a key's positions have no gaps."""
    keys = list(keys)
    size = with_key(samples.groupBy(*keys).agg(F.min("i").alias("_i0"), F.count(F.lit(1)).alias("n")), keys).drop(*keys)
    return with_key(samples, keys).join(size, KEY).withColumn("i", F.col("i") - F.col("_i0")).drop(KEY, "_i0")
