"""Pieces shared by the registered queries and their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, negative zero removed."""
    return df.select(*[
        (F.round(F.col(f.name), digits) + F.lit(0.0)).alias(f.name) if f.dataType.simpleString() in ("double", "float") else F.col(f.name)
        for f in df.schema
    ])


def r(expr: str, name: str, digits: int = 6) -> str:
    """SQL twin of :func:`rounded` for one column."""
    return f"round(CAST({expr} AS DOUBLE), {digits}) + 0.0 AS {name}"


SIG = """sig AS (
  SELECT l_suppkey AS recording_id, i, i / 100.0::DOUBLE AS t, l_quantity / 51 AS ch1, l_extendedprice / 104729 AS ch2, l_discount AS ch3, l_tax AS ch4
  FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_quantity,
          l_extendedprice, l_discount, l_tax) - 1 AS i FROM lineitem))"""

IRR = """irr AS (
  SELECT recording_id, t, v, event, event_id, row_number() OVER (PARTITION BY recording_id ORDER BY t, event_id) - 1 AS i
  FROM (SELECT user_id AS recording_id, (epoch_us(ts) - 1704067200000000) / 1000000.0::DOUBLE AS t, value AS v, event_type AS event, event_id FROM events))"""

WAVE = """wave AS (
  SELECT vec_id AS recording_id, label, k - 1 AS i, CAST(embedding[k] AS DOUBLE) AS x
  FROM embeddings, unnest(range(1, len(embedding) + 1)) AS u(k))"""


def islands(source: str, keys: str, mask: str, min_s: float) -> str:
    """SQL gaps-and-islands over a sample CTE."""
    return f"""SELECT {keys}, min(t) AS s, max(t) AS e FROM (
      SELECT {keys}, i, t, i - row_number() OVER (PARTITION BY {keys} ORDER BY i) AS g FROM {source} WHERE {mask}) GROUP BY {keys}, g
      HAVING max(t) - min(t) >= {min_s}"""


def merged(source: str, keys: str, gap: float) -> str:
    """SQL interval merge over (keys, s, e)."""
    return f"""SELECT {keys}, min(s) AS s, max(e) AS e FROM (
      SELECT *, sum(opens) OVER (PARTITION BY {keys} ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS g FROM (
        SELECT *, CASE WHEN s <= max(e) OVER (PARTITION BY {keys} ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + {gap}
          THEN 0 ELSE 1 END AS opens FROM {source})) GROUP BY {keys}, g"""


def peaks(name: str, source: str, keys: str, where: str = "true", gap: int = 1, need: str | None = None) -> str:
    """SQL CTEs (for WITH RECURSIVE) that end in ``name`` (keys, i, v): peaks of ``source`` (keys, i, v).

    Maxima of plateaus at their middle sample; then highest first, dropping what lies closer than ``gap``, one
    round of mutual bests at a time; then prominence of at least ``need``, a number or a column of ``source``.
    """
    on = " AND ".join(f"p.{k.strip()} = x.{k.strip()}" for k in keys.split(","))
    kp = ", ".join(f"p.{k.strip()}" for k in keys.split(","))
    w = f"PARTITION BY {keys} ORDER BY i"
    reach = f"OVER ({w} RANGE BETWEEN {gap - 1} PRECEDING AND {gap - 1} FOLLOWING)"
    own = "" if need is None or need.replace(".", "").isdigit() else f", any_value({need}) AS {need}"
    limit = "0" if need is None else need
    out = f"""{name}_g AS (SELECT *, sum(c) OVER ({w} ROWS UNBOUNDED PRECEDING) AS g FROM (SELECT *, CASE WHEN v = lag(v) OVER ({w}) THEN 0 ELSE 1 END AS c FROM {source})),
      {name}_m AS (SELECT {keys}, (a + b) // 2 AS i, v{', ' + need if own else ''} FROM (SELECT *, lag(v) OVER q AS before, lead(v) OVER q AS after FROM
        (SELECT {keys}, g, min(i) AS a, max(i) AS b, min(v) AS v{own} FROM {name}_g GROUP BY {keys}, g) WINDOW q AS (PARTITION BY {keys} ORDER BY g)) WHERE v > before AND v > after AND {where}),"""
    if gap > 1:
        out += f"""
      {name}_r AS (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY v, i) AS pr, 0 AS st FROM {name}_m
        UNION ALL SELECT * EXCLUDE (kept, near) REPLACE (CASE WHEN kept THEN 1 WHEN near THEN 2 ELSE 0 END AS st) FROM (
          SELECT *, max(CAST(kept AS INTEGER)) {reach} = 1 AS near FROM (SELECT *, pr = max(pr) {reach} AS kept FROM {name}_r WHERE st = 0))),
      {name}_s AS (SELECT * EXCLUDE (pr, st) FROM {name}_r WHERE st = 1),"""
    else:
        out += f"\n      {name}_s AS (SELECT * FROM {name}_m),"
    if need is None:
        return out + f"\n      {name} AS (SELECT * FROM {name}_s)"
    keep = f", p.{need}" if own else ""
    return out + f"""
      {name}_b AS (SELECT {kp}, p.i, p.v{keep}, max(x.i) FILTER (WHERE x.i < p.i AND x.v > p.v) AS l, min(x.i) FILTER (WHERE x.i > p.i AND x.v > p.v) AS h FROM {name}_s p JOIN {source} x ON {on} GROUP BY ALL),
      {name} AS (SELECT {keys}, i, v FROM (SELECT {kp}, p.i, p.v{keep}, min(x.v) FILTER (WHERE x.i < p.i AND x.i > coalesce(p.l, -1)) AS lo, min(x.v) FILTER (WHERE x.i > p.i AND (p.h IS NULL OR x.i < p.h)) AS hi
        FROM {name}_b p JOIN {source} x ON {on} GROUP BY ALL) WHERE v - lo >= {limit} AND v - hi >= {limit})"""
