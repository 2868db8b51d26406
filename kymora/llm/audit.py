"""Filter interaction audit: which of five filters removes what, in every order of them.

Word counts and distinct words are the row sums and nonzero counts of a document-term matrix (``matrix``);
capitals and symbols are counted where the matrix is built, and equal texts are found by a 128-bit digest
whose least doc_id is taken before the shuffle. All that the orders need is how many documents of a part
fail which set of filters: at most 32 sets, counted once, and each of the 600 steps sums over them.

Defined cases: a null or empty text has no words, fails A and, beside another such text of a smaller doc_id,
E; a null lang counts as an empty string; a null doc_id is never greater than another, so such a row does not
fail E, and has no labels; rows of one doc_id and text do not fail E on account of each other, of other texts
they do; repeated labels count once; other columns are ignored; an empty table gives no rows. A text longer
than a shard is a shard of its own: its task holds some 60 bytes a word.
"""

from __future__ import annotations

import hashlib
import json
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kymora.llm import matrix
from kymora.llm.common import pick, stage
from kymora.llm.words import per_text, raw_bytes

FILTERS = "ABCDE"
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#$%&*|")] = True
KINDS = {"doc_id": pa.int64(), "part": pa.string(), "c": pa.bool_(), "d": pa.bool_(), "digest": pa.binary()}
DDL = "doc_id array<bigint>, part array<string>, c array<boolean>, d array<boolean>, digest array<binary>"


def facts(batch: pa.RecordBatch) -> dict[str, pa.Array]:
    """What a document keeps beside its row: id, part, failures of C and D, digest of its text."""
    data, bounds = raw_bytes(batch.column("raw"))
    capitals, points = per_text((data >= 0x41) & (data <= 0x5A), bounds), per_text((data & 0xC0) != 0x80, bounds)
    whole = memoryview(np.ascontiguousarray(data))
    ends = bounds.tolist()
    return {
        "doc_id": batch.column("doc_id"), "part": batch.column("part"),
        "c": pa.array(100 * capitals > 10 * points), "d": pa.array(per_text(SYMBOLS[data], bounds) > 0),
        "digest": pa.array([hashlib.blake2b(whole[a:b], digest_size=16).digest() for a, b in zip(ends, ends[1:])], pa.binary()),
    }


def failures(docs: DataFrame) -> DataFrame:
    """(doc_id, part, digest, n_words, n_distinct, mask) of each document, bit k of the mask for filter k, as written rows."""
    named = pick(docs, "doc_id", "text", "lang").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("lang", F.lit("")).alias("part"), F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("raw")
    )
    totals = stage(matrix.row_totals(matrix.csr_shards(matrix.local_shards(named, facts, KINDS, DDL)), KINDS, DDL))
    first = totals.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).filter("doc_id IS NOT NULL").withColumn("first", F.lit(True))
    # joined on (doc_id, digest): no key of it is hot, however many copies a text has
    judged = totals.join(first, ["doc_id", "digest"], "left")
    fails = [F.col("row_sum") < 100, 100 * F.col("nonzero") < 80 * F.col("row_sum"), F.col("c"), F.col("d"), F.col("doc_id").isNotNull() & F.col("first").isNull()]
    mask = sum((F.when(f, 1 << k).otherwise(0) for k, f in enumerate(fails)), F.lit(0))
    return judged.select("doc_id", "part", "digest", F.col("row_sum").alias("n_words"), F.col("nonzero").alias("n_distinct"), mask.alias("mask"))


def steps() -> list[dict]:
    """All steps of all orders: the filter's bit and the bits of the filters before it."""
    out = []
    for order in permutations(range(len(FILTERS))):
        before = 0
        for k, f in enumerate(order):
            out.append({"filter_order": "".join(FILTERS[i] for i in order), "step": k + 1, "bit": 1 << f, "before": before})
            before |= 1 << f
    return out


def interaction(judged: DataFrame, labels: DataFrame) -> DataFrame:
    """Counts per part, order and step; ``judged`` has doc_id, part and mask."""
    told = pick(labels, "doc_id", "quality", "toxic").groupBy("doc_id").agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    both = judged.join(told, "doc_id", "left")
    cells = both.groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic")
    )
    parts = cells.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))  # 32 at most
    every = F.from_json(F.lit(json.dumps(steps())), "array<struct<filter_order string, step int, bit int, before int>>")
    at = parts.select("part", "cells", F.explode(every).alias("at")).select("part", "cells", "at.*")

    def total(where: str, value: str) -> F.Column:
        return F.expr(f"aggregate(cells, 0L, (s, x) -> s + IF({where}, x.{value}, 0L))")

    here = "x.mask & before = 0 AND x.mask & bit != 0"
    orders = len(steps()) // len(FILTERS)
    return at.select(
        "part", "filter_order", "step",
        total("x.mask & (before | bit) = 0", "n").alias("kept"),
        total(here, "n").alias("removed"),
        total("x.mask & before != 0 AND x.mask & bit != 0", "n").alias("redundant"),
        total("x.mask = bit", "n").alias("unique_fails"),
        total(here, "good").alias("good_lost"),
        total(here, "toxic").alias("toxic_lost"),
        # of the orders, one in as many as a document fails has this filter before the others that it fails
        F.expr(f"aggregate(cells, 0L, (s, x) -> s + IF(x.mask & bit != 0, x.n * ({orders} div greatest(bit_count(x.mask), 1)), 0L))").alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley)."""
    return interaction(failures(docs), labels)


ORACLE = r"""
WITH raw AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
split AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM raw),
fails AS (
  SELECT doc_id, part, len(w) < 100 AS a, 100 * len(list_distinct(w)) < 80 * len(w) AS b,
         100 * len(regexp_extract_all(t, '[A-Z]')) > 10 * length(t) AS c, regexp_matches(t, '[#$%&*|]') AS d,
         coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS e
  FROM split),
told AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS bad FROM labels GROUP BY doc_id),
docs AS (
  SELECT f.part, a::INT + 2 * b::INT + 4 * c::INT + 8 * d::INT + 16 * e::INT AS mask, coalesce(good, 0) AS good, coalesce(bad, 0) AS bad
  FROM fails f LEFT JOIN told USING (doc_id)),
letter AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) v(l, bit)),
orders AS (
  SELECT p.l || q.l || r.l || s.l || t.l AS filter_order, [p.bit, q.bit, r.bit, s.bit, t.bit] AS bits
  FROM letter p JOIN letter q ON q.l <> p.l JOIN letter r ON r.l NOT IN (p.l, q.l) JOIN letter s ON s.l NOT IN (p.l, q.l, r.l)
  JOIN letter t ON t.l NOT IN (p.l, q.l, r.l, s.l)),
steps AS (
  SELECT filter_order, step::INT AS step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS before
  FROM orders, range(1, 6) r(step)),
cells AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(bad) AS bad FROM docs GROUP BY part, mask),
per AS (
SELECT part, filter_order, step, bit,
       sum(CASE WHEN mask & (before | bit) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
       sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN n ELSE 0 END)::BIGINT AS removed,
       sum(CASE WHEN mask & before <> 0 AND mask & bit <> 0 THEN n ELSE 0 END)::BIGINT AS redundant,
       sum(CASE WHEN mask = bit THEN n ELSE 0 END)::BIGINT AS unique_fails,
       sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
       sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN bad ELSE 0 END)::BIGINT AS toxic_lost
FROM cells, steps GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       sum(removed) OVER (PARTITION BY part, bit)::BIGINT AS shapley
FROM per
"""
