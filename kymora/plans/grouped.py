"""Run a NumPy helper over many bounded groups without paying for each group separately.

Spark partitions and sorts the rows; a task streams its Arrow batches, cuts them where the group
changes and calls the helper on array slices. Only the group at the end of a batch is carried over.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from kymora.plans.blocks import whole_groups
from kymora.session import durable, partitions


@dataclass
class Together:
    """A helper for ``grouped_map`` that takes all whole groups of a batch at once.

    It gets their arrays (unknown numbers are NaN) and for each row which group it is in, and gives for each row of
    its result a row of the group it belongs to, and the arrays of the result.
    """

    helper: Callable[[dict[str, np.ndarray], np.ndarray], tuple[np.ndarray, dict[str, np.ndarray]]]


def grouped_map(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    columns: Sequence[str],
    schema: str,
    helper: Callable[[dict[str, np.ndarray]], dict[str, np.ndarray]] | Together,
) -> DataFrame:
    """Rows (group columns, ``schema``): ``helper`` turns one group's arrays into equal-length arrays.

    ``df`` must already be cut into bounded groups (a block, a frame, a run of steps).
    """
    group, columns = list(group), list(columns)
    src = df.select(*group, *columns).repartition(partitions(df.sparkSession), *group).sortWithinPartitions(*group, *order)
    head = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema if f.name in group)
    names = [part.strip().split(" ")[0].strip("`") for part in _split_top(schema)]

    def work(pdf: pd.DataFrame, starts: np.ndarray) -> pd.DataFrame:
        arrays = {c: pdf[c].to_numpy() for c in columns}
        bounds = np.append(starts, len(pdf))
        pieces, sizes = [], []
        for a, b in zip(bounds[:-1], bounds[1:]):
            got = helper({c: v[a:b] for c, v in arrays.items()})
            pieces.append(got)
            sizes.append(len(got[names[0]]))
        out = {g: np.repeat(pdf[g].to_numpy()[starts], sizes) for g in group}
        for n in names:
            if any(isinstance(p[n], list) for p in pieces):
                out[n] = pd.Series([x for p in pieces for x in p[n]], dtype=object)
            else:
                out[n] = np.concatenate([p[n] for p in pieces])
        return pd.DataFrame(out)

    def changes(pdf: pd.DataFrame, before: pd.DataFrame | None) -> np.ndarray:
        """Where a group begins; nulls are equal to each other and to nothing else."""
        new = np.zeros(len(pdf), dtype=bool)
        new[0] = before is None
        for g in group:
            v = pdf[g] if before is None else pd.concat([before[g], pdf[g]])
            here, gone = v.to_numpy(), pd.isna(v).to_numpy()
            differ = (gone[1:] != gone[:-1]) | (~gone[1:] & ~gone[:-1] & (here[1:] != here[:-1]))
            new[1 if before is None else 0 :] |= differ
        return np.flatnonzero(new)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest: list[pd.DataFrame] = []  # the group that is still open; joined once, when it ends
        for pdf in batches:
            if pdf.empty:
                continue
            starts = changes(pdf, rest[-1].tail(1) if rest else None)
            if not len(starts):
                rest.append(pdf)
                continue
            first, last = int(starts[0]), int(starts[-1])
            if rest:
                yield work(pd.concat([*rest, pdf.iloc[:first]], ignore_index=True), np.array([0]))
            if last > first:
                yield work(pdf.iloc[first:last].reset_index(drop=True), starts[:-1] - first)
            rest = [pdf.iloc[last:]]
        if rest:
            yield work(pd.concat(rest, ignore_index=True), np.array([0]))

    def run_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, at in whole_groups(batches, group):
            spot, got = helper.helper({c: table.column(c).to_numpy() for c in columns}, at)
            taken = pa.array(spot, pa.int64())
            yield pa.RecordBatch.from_arrays([*[table.column(g).take(taken).combine_chunks() for g in group], *[pa.array(got[n]) for n in names]], [*group, *names])

    if isinstance(helper, Together):
        return durable(src.mapInArrow(run_together, f"{head}, {schema}"))
    # written before anything is joined to it, so the helper runs once and its rows are final
    return durable(src.mapInPandas(run, f"{head}, {schema}"))


def _split_top(schema: str) -> list[str]:
    """Split a DDL list at its outer commas."""
    parts, depth, current = [], 0, ""
    for ch in schema:
        depth += ch == "<"
        depth -= ch == ">"
        if ch == "," and depth == 0:
            parts.append(current)
            current = ""
        else:
            current += ch
    return [*parts, current]
