"""Sequential rules over ordered rows as maps of blocks, composed by a parallel prefix.

Some rules walk a series in order and carry a state: the rate that a span began with, say. A block of rows is
then a map from the state that enters it to the state that leaves it. Maps compose, so the state that enters
every block follows from doubling: after k steps a block's map covers the 2^k blocks up to it, each step
is one join of maps with maps, and no task ever sees more than a block.

A map here is a list of escapes. A state passes a block unchanged unless it meets an escape that it does not
tolerate; the first such one tells the state that leaves. An escape holds the value that is met and the state
that leaves; those that an earlier one shadows are left out.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kymora.plans.blocks import BLK, KEY
from kymora.session import durable

Leaves = Callable[[np.ndarray, float, float], np.ndarray]  # (values met, state, tolerance) -> which of them end it


def out_of(met: np.ndarray, out: np.ndarray, state: float, tolerance: float, leaves: Leaves) -> float:
    """The state that leaves a map which ``state`` enters."""
    hit = np.flatnonzero(leaves(met, state, tolerance)) if len(met) else ()
    return float(out[hit[0]]) if len(hit) else float(state)


def outermost(values: np.ndarray, low: float = np.inf, high: float = -np.inf) -> np.ndarray:
    """Places of the values below all before them and ``low``, or above all before them and ``high``."""
    if not len(values):
        return np.empty(0, np.int64)
    least = np.minimum.accumulate(np.minimum(np.append(low, values), low))
    most = np.maximum.accumulate(np.maximum(np.append(high, values), high))
    return np.flatnonzero((values < least[:-1]) | (values > most[:-1]))


def entering(maps: DataFrame, start: DataFrame, leaves: Leaves) -> DataFrame:
    """(KEY, BLK, state): the state that enters each block.

    ``maps`` has (KEY, BLK, tolerance, met, out), one row a block and blocks numbered without gaps within a key;
    ``start`` has (KEY, state), the state that enters a key's first block.
    """

    @F.pandas_udf("struct<met:array<double>,out:array<double>>")
    def compose(met_a: pd.Series, out_a: pd.Series, met_b: pd.Series, out_b: pd.Series, tolerance: pd.Series) -> pd.DataFrame:
        rows = []
        for a, x, b, y, tol in zip(met_a, out_a, met_b, out_b, tolerance):
            if a is None:  # nothing stands before
                rows.append((b, y))
                continue
            through = [out_of(b, y, s, tol, leaves) for s in x]
            fresh = outermost(b, min(a, default=np.inf), max(a, default=-np.inf))
            rows.append((np.append(a, b[fresh]), np.append(through, y[fresh])))
        return pd.DataFrame(rows, columns=["met", "out"])

    @F.pandas_udf("double")
    def apply(met: pd.Series, out: pd.Series, state: pd.Series, tolerance: pd.Series) -> pd.Series:
        return pd.Series([s if m is None else out_of(m, o, s, tol, leaves) for m, o, s, tol in zip(met, out, state, tolerance)], dtype=float)

    first = maps.groupBy(KEY).agg(F.min(BLK).alias("_from"))
    now = durable(maps.join(first, KEY).withColumn("_at", F.col(BLK) - F.col("_from")).drop("_from"))
    last = now.agg(F.max("_at")).first()[0] or 0
    step = 1
    while step <= last:
        before = now.select(KEY, (F.col("_at") + step).alias("_at"), F.col("met").alias("_met"), F.col("out").alias("_out"))
        both = now.join(before, [KEY, "_at"], "left").withColumn("_new", compose("_met", "_out", "met", "out", "tolerance"))
        now = durable(both.select(KEY, BLK, "_at", "tolerance", F.col("_new.met").alias("met"), F.col("_new.out").alias("out")))
        step *= 2
    before = now.select(KEY, (F.col("_at") + 1).alias("_at"), F.col("met").alias("_met"), F.col("out").alias("_out"))
    entered = now.select(KEY, BLK, "_at", "tolerance").join(before, [KEY, "_at"], "left").join(start, KEY)
    return entered.select(KEY, BLK, apply("_met", "_out", "state", "tolerance").alias("state"))
