"""Block-wise processing of ordered rows, so that no recording is ever one task.

Ways to cut an ordered series, all keyed by (recording, block):

* ``index_blocks``  - the row carries its sample index, so the block is ``i div rows``; no pass needed.
* ``time_blocks``   - rows picked from an evenly sampled series, cut by time; no pass needed either.
* ``range_blocks``  - the row only has ordering columns; a range shuffle cuts at row-count quantiles,
  wherever they fall, so one hot recording is spread over as many partitions as its share of rows.
* ``with_halo``     - index blocks plus the neighbouring rows a sliding operator has to see.

``running`` turns any prefix computation (sum, max, last value, next value) into two bounded steps:
one summary row per block, then a window inside the block that starts from the carried summary.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StringType, StructField, StructType

from kymora.session import durable, partitions

BLK = "_blk"
CORE = "_core"
KEY = "_key"
BLOCK_ROWS = 16384
_PLACE, _FIRST, _EDGE = "_place", "_first", "_edge"


def index_blocks(df: DataFrame, i: str = "i", rows: int = BLOCK_ROWS) -> DataFrame:
    return df.withColumn(BLK, F.floor(F.col(i) / F.lit(rows)).cast("long"))


def time_blocks(df: DataFrame, hz: float, t: str = "t", rows: int = BLOCK_ROWS) -> DataFrame:
    """Blocks of rows drawn from an evenly sampled series: a stretch of time holds at most ``rows`` of it."""
    return df.withColumn(BLK, F.floor(F.col(t) * F.lit(hz / rows)).cast("long"))


def range_blocks(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Assign each row the range partition it falls in; bounds are fixed once by the checkpoint."""
    n = partitions(df.sparkSession)
    cut = df.repartitionByRange(n, *keys, *order).withColumn(BLK, F.spark_partition_id().cast("long"))
    return durable(cut)


def with_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All key parts in one struct column. A struct is never null and its null parts compare equal, in
    joins too, so a key with a null pass or speed keeps its rows."""
    if list(keys) == [KEY]:
        return df
    return df.withColumn(KEY, F.struct(*[F.col(k) for k in keys]) if len(keys) else F.struct(F.lit(0)))


def block_window(keys: Sequence[str], order: Sequence[str | Column]) -> WindowSpec:
    return Window.partitionBy(*keys, BLK).orderBy(*order)


def _changes(column: pa.Array) -> np.ndarray:
    """Where a value differs from the one before it; nulls are equal to each other, and so are NaNs."""
    if pa.types.is_nested(column.type):
        values = column.to_pylist()
        return np.array([x != y for x, y in zip(values[1:], values[:-1])], bool)
    here, before = column.slice(1), column.slice(0, len(column) - 1)
    differ = pc.fill_null(pc.not_equal(here, before), False)
    if pa.types.is_floating(column.type):
        both = pc.and_(pc.is_nan(here), pc.is_nan(before))
        differ = pc.and_not(differ, pc.fill_null(both, False))
    return pc.or_(differ, pc.xor(here.is_null(), before.is_null())).to_numpy(zero_copy_only=False)


def whole_groups(batches: Iterator[pa.RecordBatch], group: Sequence[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Sorted rows cut between groups: a stretch of whole groups and, for each of its rows, which of them it is in."""
    rest: list[tuple[pa.RecordBatch, np.ndarray]] = []  # the group that is still open
    last: list[pa.Array] | None = None

    def told(parts: list[tuple[pa.RecordBatch, np.ndarray]]) -> tuple[pa.Table, np.ndarray]:
        at = np.cumsum(np.concatenate([new for _, new in parts]))
        return pa.Table.from_batches([batch for batch, _ in parts]), at - at[0]

    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        new = np.zeros(n, bool)
        for c, name in enumerate(group):
            column = batch.column(name)
            new[0 if last else 1 :] |= _changes(pa.concat_arrays([last[c], column]) if last else column)
        last = [batch.column(name).slice(n - 1) for name in group]
        starts = np.flatnonzero(new)
        if not len(starts):
            rest.append((batch, new))
            continue
        cut = int(starts[-1])
        done = [(b, m) for b, m in [*rest, (batch.slice(0, cut), new[:cut])] if b.num_rows]
        rest = [(batch.slice(cut), new[cut:])]
        if done:
            yield told(done)
    if rest:
        yield told(rest)


def _numbered(keys: Sequence[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Adds to sorted rows their partition, their place in their key's stretch there, whether that stretch is the
    partition's first, and whether the row is the partition's first or last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        def marked(batch: pa.RecordBatch, first: np.ndarray, place: np.ndarray, edge: np.ndarray) -> pa.RecordBatch:
            more = [pa.array(np.full(batch.num_rows, block, np.int64)), pa.array(place.astype(np.int64)), pa.array(first), pa.array(edge)]
            return pa.RecordBatch.from_arrays([*batch.columns, *more], [*batch.schema.names, BLK, _PLACE, _FIRST, _EDGE])

        block, last, first, place, held = TaskContext.get().partitionId(), None, True, 0, None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            new = np.zeros(n, bool)
            for c, name in enumerate(keys):
                column = batch.column(name)
                new[0 if last else 1 :] |= _changes(pa.concat_arrays([last[c], column]) if last else column)
            last = [batch.column(name).slice(n - 1) for name in keys]
            rows = np.arange(n)
            start = np.maximum.accumulate(np.where(new, rows, -1))
            places, firsts, edges = np.where(start < 0, place + rows, rows - start), (start < 0) & first, np.zeros(n, bool)
            place, first = int(places[-1]) + 1, bool(firsts[-1])
            edges[0] = held is None
            if held is not None:
                yield marked(*held)
            held = batch, firsts, places, edges  # until it is known whether it is the last
        if held is not None:
            held[3][-1] = True
            yield marked(*held)

    return run


def with_sample_index(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], out: str = "i", kept: Sequence[str] | None = None, parts: int | None = None
) -> DataFrame:
    """Zero-based position of every row within ``keys``, without a window over the whole key.

    One range shuffle puts all rows in order; each partition numbers the stretch of every key in it, and is
    written. A key goes on from one partition to the next at most at its first stretch there, so one
    number for each partition, which the driver holds, completes the positions. Columns other than ``kept`` (and the
    keys) only order the rows and are not written. ``parts``: partitions of the shuffle.
    """
    keys = list(keys)
    kept = df.columns if kept is None else list(kept)
    names = [*kept, *[k for k in keys if k not in kept]]
    cut = df.repartitionByRange(parts or partitions(df.sparkSession), *keys, *order).sortWithinPartitions(*keys, *order).select(*names)
    marks = [StructField(BLK, LongType()), StructField(_PLACE, LongType()), StructField(_FIRST, BooleanType()), StructField(_EDGE, BooleanType())]
    rows = durable(cut.mapInArrow(_numbered(keys), StructType([*cut.schema.fields, *marks])))
    ahead, before, carried = [], None, 0  # rows of a partition's first key before that partition
    edges = rows.filter(_EDGE).select(BLK, _PLACE, _FIRST, F.struct(*keys).alias(KEY)).collect()  # two a partition
    for e in sorted(edges, key=lambda e: (e[BLK], not e[_FIRST], e[_PLACE])):
        if e[BLK] >= len(ahead):
            ahead += [0] * (e[BLK] - len(ahead)) + [carried if before is not None and _same_key(before, e[KEY]) else 0]
        before, carried = e[KEY], e[_PLACE] + 1 + (ahead[e[BLK]] if e[_FIRST] else 0)
    offsets = F.array(*[F.lit(n).cast("long") for n in ahead or [0]])
    place = F.col(_PLACE) + F.when(F.col(_FIRST), F.get(offsets, F.col(BLK).cast("int"))).otherwise(F.lit(0))
    return rows.select(*kept, place.alias(out))


def _same_key(a: Sequence, b: Sequence) -> bool:
    return all(x == y or (x != x and y != y) for x, y in zip(a, b))


def with_halo(
    df: DataFrame, before: int, after: int, i: str = "i", rows: int = BLOCK_ROWS
) -> DataFrame:
    """Give every block ``before`` rows ahead of it and ``after`` rows behind it.

    A row goes to each block whose reach covers it; ``_core`` marks the one block that owns it. Blocks
    are at least four times the reach, so at most a quarter of the rows is copied.
    """
    rows = max(rows, 4 * (before + after), 1)
    own = F.floor(F.col(i) / F.lit(rows)).cast("long")
    first = F.floor((F.col(i) - F.lit(after)) / F.lit(rows)).cast("long")
    last = F.floor((F.col(i) + F.lit(before)) / F.lit(rows)).cast("long")
    return df.withColumn(BLK, F.explode(F.sequence(F.greatest(first, F.lit(0)), last))).withColumn(
        CORE, F.col(BLK) == own
    )


def core_only(df: DataFrame) -> DataFrame:
    return df.filter(F.col(CORE)).drop(BLK, CORE)


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    specs: dict[str, tuple[str, Column]],
    exclusive: bool = False,
) -> DataFrame:
    """Prefix values over rows already carrying ``_blk``.

    ``specs`` maps an output column to (kind, expression); kinds are ``sum``, ``max``, ``last``
    (latest non-null so far) and ``next`` (earliest non-null still to come). With ``exclusive`` the
    current row is left out.
    """
    names = list(specs)
    work = with_key(df, keys).select("*", *[expr.alias(f"_x_{n}") for n, (_, expr) in specs.items()])
    position = F.struct(*[F.col(c) for c in order])
    summary = {
        "sum": lambda c: F.sum(c),
        "max": lambda c: F.max(c),
        "last": lambda c: F.max_by(c, F.when(c.isNotNull(), position)),
        "next": lambda c: F.min_by(c, F.when(c.isNotNull(), position)),
    }
    per_block = work.groupBy(KEY, BLK).agg(
        *[summary[kind](F.col(f"_x_{n}")).alias(f"_s_{n}") for n, (kind, _) in specs.items()]
    )
    ahead = Window.partitionBy(KEY).orderBy(BLK).rowsBetween(Window.unboundedPreceding, -1)
    behind = Window.partitionBy(KEY).orderBy(F.col(BLK).desc()).rowsBetween(Window.unboundedPreceding, -1)
    over_blocks = {
        "sum": lambda c: F.sum(c).over(ahead),
        "max": lambda c: F.max(c).over(ahead),
        "last": lambda c: F.last(c, ignorenulls=True).over(ahead),
        "next": lambda c: F.last(c, ignorenulls=True).over(behind),
    }
    carried = per_block.select(
        KEY, BLK, *[over_blocks[specs[n][0]](F.col(f"_s_{n}")).alias(f"_c_{n}") for n in names]
    )
    edge = -1 if exclusive else 0
    fwd = block_window([KEY], order).rowsBetween(Window.unboundedPreceding, edge)
    # looking ahead is looking back in descending order: a growing frame, not one rebuilt per row
    rev = block_window([KEY], [F.col(c).desc() for c in order]).rowsBetween(Window.unboundedPreceding, edge)

    def inside(name: str) -> Column:
        kind, x, c = specs[name][0], F.col(f"_x_{name}"), F.col(f"_c_{name}")
        if kind == "sum":
            return F.coalesce(c, F.lit(0)) + F.coalesce(F.sum(x).over(fwd), F.lit(0))
        if kind == "max":
            return F.greatest(c, F.max(x).over(fwd))
        if kind == "last":
            return F.coalesce(F.last(x, ignorenulls=True).over(fwd), c)
        return F.coalesce(F.last(x, ignorenulls=True).over(rev), c)

    joined = work.join(carried, [KEY, BLK])
    return joined.select(*df.columns, *[inside(n).alias(n) for n in names])


def local_runs(df: DataFrame, keys: Sequence[str], flags: dict[str, str], out: str, i: str = "i", t: str = "t", rows: int = BLOCK_ROWS) -> DataFrame:
    """Runs of TRUE among rows that arrive one after the other: (keys, ``out``, first_i, last_i, start, end).

    ``flags`` gives the value of ``out`` for each flag column. Rows in order make long runs, rows in no order short ones;
    ``join_runs`` makes the same of both. A run ends at a block edge, and at a sample without a time.
    """
    keys, names = list(keys), list(flags)
    src = df.select(*keys, F.col(i).cast("long").alias("_i"), F.col(t).cast("double").alias("_t"), *names).filter(F.col("_i").isNotNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            at, known = batch.column("_i").to_numpy(), batch.column("_t").is_valid().to_numpy(zero_copy_only=False)
            time = batch.column("_t").to_numpy(zero_copy_only=False)
            known = known & ~np.isnan(time)
            follows = np.zeros(n, bool)
            follows[1:] = (at[1:] == at[:-1] + 1) & (at[1:] % rows != 0) & known[1:] & known[:-1]
            for k in keys:
                follows[1:] &= ~_changes(batch.column(k))
            for name, value in flags.items():
                bad = pc.fill_null(batch.column(name), False).to_numpy(zero_copy_only=False)
                on = np.flatnonzero(bad)
                if not len(on):
                    continue
                begins = np.append(True, ~follows[on[1:]] | (on[1:] != on[:-1] + 1))
                first = np.flatnonzero(begins)
                last = np.append(first[1:], len(on)) - 1
                valued = batch.column("_t").take(pa.array(on[first])).is_valid().to_numpy(zero_copy_only=False)
                ends = [pa.array(f.reduceat(time[on], first), mask=~valued) for f in (np.minimum, np.maximum)]
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(k).take(pa.array(on[first])) for k in keys], pa.array([value] * len(first), pa.string()), pa.array(at[on[first]]), pa.array(at[on[last]]), *ends],
                    [*keys, out, "first_i", "last_i", "start", "end"],
                )

    more = [StructField(out, StringType()), *[StructField(c, LongType()) for c in ("first_i", "last_i")], *[StructField(c, DoubleType()) for c in ("start", "end")]]
    return src.mapInArrow(run, StructType([*[src.schema[k] for k in keys], *more]))


def join_runs(runs: DataFrame, keys: Sequence[str], rows: int = BLOCK_ROWS) -> DataFrame:
    """Maximal runs (keys, first_i, last_i, start, end) from parts that end at block edges.

    Parts are joined inside their block; only the at most two runs per block that touch a block edge
    are looked at again to be joined with their neighbours.
    """

    def joined(parts: DataFrame, within: str) -> DataFrame:
        w = Window.partitionBy(*keys, within).orderBy("first_i")
        opens = F.coalesce((F.col("first_i") != F.lag("last_i").over(w) + 1).cast("int"), F.lit(1))
        return parts.withColumn("_new", opens).withColumn("_g", F.sum("_new").over(w)).groupBy(*keys, within, "_g").agg(
            F.min("first_i").alias("first_i"), F.max("last_i").alias("last_i"), F.min("start").alias("start"), F.max("end").alias("end"),
        )

    local = joined(index_blocks(runs, "first_i", rows), BLK).drop("_g")
    # runs touching a block edge share one window per key, every other run stays in its own block's
    touches = (F.col("first_i") == F.col(BLK) * rows) | (F.col("last_i") == (F.col(BLK) + 1) * rows - 1)
    local = local.withColumn("_home", F.when(touches, F.lit(-1)).otherwise(F.col(BLK)))
    return joined(local, "_home").drop("_home", "_g")


def true_runs(
    df: DataFrame, keys: Sequence[str], mask: Column, i: str = "i", t: str = "t", rows: int = BLOCK_ROWS
) -> DataFrame:
    """Maximal runs of TRUE over consecutive ``i``: (keys, first_i, last_i, start, end)."""
    hits = df.select(*keys, i, t, mask.alias("_bad")).filter("_bad")
    return join_runs(local_runs(hits, keys, {"_bad": ""}, "_flag", i, t, rows).drop("_flag"), keys, rows)
