"""Secret scans over an incremental blob ledger, with DataFrame functions only.

Every version of every document is addressed by the SHA-256 of its text. The ledger holds one row for each
blob and scan: which rule versions were applied and which spans they found. An update scans each distinct
blob once, with those rules whose version the ledger does not have for it, and appends rows; findings are
then joined back to all documents (paths) that hold the blob. Changing a rule changes its version, so
only that rule runs again.

A match's place is the summed length of what ``split`` leaves before it and of the matches before it, so
spans count code points. Copies of a text collapse before the shuffle and are scanned once; the join back
carries ids and hashes, never texts, and its hot blobs are split by AQE.

Defined cases: null texts count as empty; empty texts have no findings; repeated rows each get their
blob's findings; a null doc_id stays null; other columns are ignored; an empty table gives no rows. A text is held
in one task; time grows faster than the number of matches in one text (16,000 of them took 17 seconds).
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kymora.llm.common import pick, place_of, plain, shared_folder, with_text


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` whose ``group`` has at least ``least`` code points."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1

    @property
    def version(self) -> str:
        return f"{self.kind}-{hashlib.sha256(repr((self.kind, self.pattern, self.group, self.least)).encode()).hexdigest()[:16]}"


def either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


NAMES = "|".join(either_case(w) for w in ("password", "passwd", "secret", "token")) + "|" + either_case("api") + "_?" + either_case("key")
# a run's length stands in the pattern where a shorter run can hold no match of its own
RULES = (
    Rule("assign", rf"""({NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", "AKIA[A-Z0-9]{16,}"),
    Rule("hex", "[0-9a-f]{24,}"),
)
SPAN = "array<struct<kind:string,rule:string,start:int,end:int>>"
MARK = "[SECRET]"
PART = 256


def _spans(text: Column, rule: Rule) -> Column:
    """All matches of one rule, as an array of (kind, rule, start, end)."""
    whole = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else whole
    gaps = F.slice(F.split(text, rule.pattern, -1), 1, F.greatest(F.size(whole), F.lit(0)))
    steps = F.zip_with(F.zip_with(gaps, whole, lambda g, w: F.struct(F.length(g).alias("gap"), F.length(w).alias("size"))), value, lambda s, v: F.struct(s["gap"].alias("gap"), s["size"].alias("size"), (F.length(v) >= rule.least).alias("ok")))
    empty = F.lit(None).cast(SPAN)

    def add(acc: Column, s: Column) -> Column:
        start = acc["at"] + s["gap"]
        found = F.struct(F.lit(rule.kind).alias("kind"), F.lit(rule.version).alias("rule"), start.alias("start"), (start + s["size"]).alias("end"))
        full = F.size(acc["part"]) >= PART  # closed parts keep each step's copy short
        part = F.when(full, F.array(found)).otherwise(F.concat(acc["part"], F.array(found))).cast(SPAN)
        done = F.when(full, F.concat(acc["done"], F.array(acc["part"]))).otherwise(acc["done"])
        return F.struct(
            (start + s["size"]).alias("at"),
            F.when(s["ok"], part).otherwise(acc["part"]).cast(SPAN).alias("part"),
            F.when(s["ok"], done).otherwise(acc["done"]).cast(f"array<{SPAN}>").alias("done"),
        )

    none = F.coalesce(empty, F.array().cast(SPAN))
    start = F.struct(F.lit(0).alias("at"), none.alias("part"), F.array().cast(f"array<{SPAN}>").alias("done"))
    folded = F.aggregate(steps, start, add, lambda acc: F.concat(F.flatten(acc["done"]), acc["part"]))
    return F.when(F.size(whole) > 0, folded).otherwise(none)


class Ledger:
    """Scanned blobs in a table of (blob, rules, spans); rows are only ever added."""

    def __init__(self, spark: SparkSession, folder: str | None = None) -> None:
        self.spark, self.folder = spark, folder or f"{shared_folder(spark)}-ledger"

    SCHEMA = f"blob binary, rules array<string>, spans {SPAN}"

    def rows(self) -> DataFrame:
        try:
            return self.spark.read.schema(self.SCHEMA).parquet(self.folder)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], self.SCHEMA)

    def update(self, docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> None:
        """Scan the blobs of ``docs`` with the rule versions that the ledger has not seen on them."""
        new = blobs(docs).select("blob", "text").dropDuplicates(["blob"])
        seen = self.rows().groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("seen"))
        todo = new.join(seen, "blob", "left").withColumn(
            "rules", F.array_except(F.array(*[F.lit(r.version) for r in rules]), F.coalesce("seen", F.array().cast("array<string>")))
        ).filter(F.size("rules") > 0)
        found = [F.when(F.array_contains("rules", r.version), _spans(F.col("text"), r)).otherwise(F.array().cast(SPAN)) for r in rules]
        todo.select("blob", "rules", F.concat(*found).alias("spans")).write.mode("append").parquet(self.folder)

    def findings(self, rules: tuple[Rule, ...] = RULES) -> DataFrame:
        """(blob, spans) of the blobs in which the given rule versions found something."""
        current = F.array(*[F.lit(r.version) for r in rules])
        kept = self.rows().select("blob", F.filter("spans", lambda s: F.array_contains(current, s["rule"])).alias("spans")).filter(F.size("spans") > 0)
        return kept.groupBy("blob").agg(F.flatten(F.collect_list("spans")).alias("spans"))


def blobs(docs: DataFrame) -> DataFrame:
    """(doc_id, text, blob): the whole text, null as empty, and its address."""
    whole = pick(docs, "doc_id", "text").withColumn("text", F.coalesce("text", F.lit("")))
    return whole.withColumn("blob", F.unhex(F.sha2("text", 256)))


def in_order(spans: Column, rules: tuple[Rule, ...]) -> Column:
    """By start, then as the kinds are listed."""
    place = F.create_map(*[F.lit(x) for i, r in enumerate(rules) for x in (r.kind, i)])
    keyed = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), place[s["kind"]].alias("nth"), s["end"].alias("end"), s["kind"].alias("kind")))
    return F.array_sort(keyed)


def scan(docs: DataFrame, ledger: Ledger | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, blob, spans) for every row of ``docs``; spans are (start, nth, end, kind) in order."""
    ledger = ledger or Ledger(docs.sparkSession)
    ledger.update(docs, rules)
    paths = blobs(docs).select("doc_id", "blob")
    none = F.array().cast(SPAN)
    return paths.join(ledger.findings(rules), "blob", "left").select("doc_id", "blob", in_order(F.coalesce("spans", none), rules).alias("spans"))


def redact(text: Column, spans: Column) -> Column:
    """``text`` with every code point inside a span replaced, one mark for each run of spans that overlap."""

    def add(acc: Column, s: Column) -> Column:
        gap = s["start"] > acc["at"]
        kept = F.when(gap, F.substring(text, acc["at"] + 1, s["start"] - acc["at"])).otherwise(F.lit(""))
        mark = F.when(gap | (acc["at"] == 0) & (F.size(acc["out"]) == 0), F.lit(MARK)).otherwise(F.lit(""))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.concat(acc["out"], F.array(F.concat(kept, mark))).cast("array<string>").alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    cleaned = F.aggregate(spans, start, add, lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(text, acc["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, cleaned).otherwise(text)


def redact_documents(docs: DataFrame, ledger: Ledger | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """All rows and columns of ``docs``, with the spans found in a text replaced and n_chars set anew there."""
    ledger = ledger or Ledger(docs.sparkSession)
    ledger.update(docs, rules)
    named, names = plain(docs)
    text = F.coalesce(F.col(f"c{place_of(names, 'text')}"), F.lit(""))
    joined = named.withColumn("blob", F.unhex(F.sha2(text, 256))).join(ledger.findings(rules), "blob", "left").withColumn("spans", in_order(F.coalesce("spans", F.array().cast(SPAN)), rules))
    return with_text(joined, names, redact(text, F.col("spans")), F.size("spans") > 0)


def span_digest(scanned: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, n_<kind>, base_sha256, spans) with spans as kind:start:end joined by commas."""
    joined = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return scanned.select("doc_id", *[count(r.kind) for r in rules], F.sha2(joined, 256).alias("base_sha256"), joined.alias("spans"))


def _duck_spans(rule: Rule, nth: int) -> str:
    quoted = rule.pattern.replace("'", "''")
    matches = f"regexp_extract_all(text, '{quoted}', 0)"
    values = f"regexp_extract_all(text, '{quoted}', {rule.group})"
    return f"""SELECT doc_id, n, unnest(list_filter(list_transform(range(1, len(m) + 1), lambda i: struct_pack(
        s := CAST(list_sum(list_transform(p[1:i], lambda x: length(x))) + COALESCE(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS BIGINT),
        nth := {nth}, size := length(m[i]), ok := length(v[i]) >= {rule.least}, kind := '{rule.kind}')), lambda x: x.ok)) AS f
        FROM (SELECT doc_id, n, {matches} AS m, {values} AS v, string_split_regex(text, '{quoted}') AS p FROM t)"""


ORACLE = f"""
WITH t AS (SELECT doc_id, row_number() OVER () AS n, COALESCE(text, '') AS text FROM documents),
hits AS ({' UNION ALL '.join(_duck_spans(r, i) for i, r in enumerate(RULES))}),
told AS (
    SELECT n, string_agg(f.kind || ':' || f.s || ':' || (f.s + f.size), ',' ORDER BY f.s, f.nth) AS spans,
        {', '.join(f"count(*) FILTER (WHERE f.kind = '{r.kind}') AS n_{r.kind}" for r in RULES)}
    FROM hits GROUP BY n)
SELECT t.doc_id, {', '.join(f'COALESCE(n_{r.kind}, 0) AS n_{r.kind}' for r in RULES)},
    sha256(COALESCE(spans, '')) AS base_sha256, COALESCE(spans, '') AS spans
FROM t LEFT JOIN told USING (n)
"""
