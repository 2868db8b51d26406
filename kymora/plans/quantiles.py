"""Exact grouped quantiles of one or several columns.

Spark's own ``percentile`` keeps every distinct value of a group in one aggregation buffer. That is the shortest way
where groups are small: all columns in one shuffle. Groups of more than ``SMALL`` rows are ranked instead, all columns
in one pass: equal values are counted first (combined map-side), the counted values are range partitioned, and the
two order statistics around each wanted rank are picked out of the running count. Both ways give the same numbers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kymora.plans.blocks import KEY, range_blocks, running, with_key
from kymora.session import durable

SMALL = 1 << 14


def quantiles(df: DataFrame, keys: Sequence[str], column: str, probs: dict[str, float]) -> DataFrame:
    """(keys, one column per entry of ``probs``) of one column; see ``quantiles_of``."""
    out = quantiles_of(df, keys, {column: probs})
    some = F.lit(False)
    for name in probs:
        some = some | F.col(name).isNotNull()
    return out.filter(some)


def quantiles_of(df: DataFrame, keys: Sequence[str], wanted: dict[str, dict[str, float]], small: int | None = None) -> DataFrame:
    """(keys, a column for each name in ``wanted[column]``), linearly interpolated between order statistics.

    Nulls and NaN don't count; a group without values has nulls. Null key parts compare equal.
    """
    keys, small = list(keys), SMALL if small is None else small
    base = durable(with_key(df.select(*keys, *[F.when(~F.isnan(c), F.col(c).cast("double")).alias(c) for c in wanted]), keys).drop(*keys))
    sizes = base.groupBy(KEY).agg(F.count(F.lit(1)).alias("_size"))
    large = durable(sizes.filter(F.col("_size") > small).select(KEY))
    names = [n for probs in wanted.values() for n in probs]
    some_large = not large.isEmpty()
    few = base.join(large, KEY, "left_anti") if some_large else base
    out = few.groupBy(KEY).agg(*[F.percentile(c, F.lit(float(p))).alias(n) for c, probs in wanted.items() for n, p in probs.items()])
    if some_large:
        long = base.join(large, KEY, "left_semi").unpivot([KEY], list(wanted), "_c", "_v").filter("_v IS NOT NULL")
        ranked = _ranked(long, sorted({float(p) for probs in wanted.values() for p in probs.values()}))
        picks = [F.max(F.when((F.col("_c") == c) & (F.col("_p") == float(p)), F.col("_q"))).alias(n) for c, probs in wanted.items() for n, p in probs.items()]
        out = out.unionByName(large.join(ranked.groupBy(KEY).agg(*picks), KEY, "left"))
    return out.select(*[F.col(f"{KEY}.{k}").alias(k) for k in keys], *names)


def _ranked(long: DataFrame, probs: list[float]) -> DataFrame:
    """(KEY, _c, _p, _q): quantiles of the values (KEY, _c, _v) by their ranks."""
    group = [KEY, "_c"]
    counted = long.groupBy(*group, "_v").agg(F.count(F.lit(1)).alias("_n"))
    cut = range_blocks(counted, group, ["_v"])
    pair = "_pair"
    ranked = running(cut.withColumn(pair, F.struct(*group)), [pair], ["_v"], {"_hi": ("sum", F.col("_n"))})
    totals = cut.groupBy(F.struct(*group).alias(pair)).agg(F.sum("_n").alias("_total"))
    ranked = ranked.join(totals, pair)
    picks = []
    for k, p in enumerate(probs):
        pos = F.lit(p) * (F.col("_total") - 1)
        lo = F.floor(pos)
        for tag, at in (("a", lo), ("b", F.least(lo + 1, F.col("_total") - 1))):
            inside = (at >= F.col("_hi") - F.col("_n")) & (at < F.col("_hi"))
            picks.append(F.max(F.when(inside, F.col("_v"))).alias(f"_{tag}{k}"))
        picks.append(F.max(pos - lo).alias(f"_f{k}"))
    got = ranked.groupBy(pair).agg(*picks)
    each = F.array(*[F.struct(F.lit(p).alias("_p"), (F.col(f"_a{k}") + (F.col(f"_b{k}") - F.col(f"_a{k}")) * F.col(f"_f{k}")).alias("_q")) for k, p in enumerate(probs)])
    return got.select(F.col(f"{pair}.{KEY}").alias(KEY), F.col(f"{pair}._c").alias("_c"), F.explode(each).alias("x")).select(KEY, "_c", "x.*")
