"""Workbook sheets delivered as tables, or as long cell tables (keys, row, col, value)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kymora.functions import scalars as sc
from kymora.plans.blocks import BLK, BLOCK_ROWS, index_blocks, running

EVENT_SYNONYMS = {
    "event": ("event info", "event", "event name", "event_info"),
    "t": ("time (sec)", "time", "time (s)", "time sec", "time_sec"),
}


def read_sheet(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """A sheet exported as CSV (all text) or Parquet."""
    if path.endswith(".parquet"):
        return spark.read.parquet(path)
    return spark.read.option("header", str(header).lower()).csv(path)


def rename_events(df: DataFrame, synonyms: dict[str, tuple[str, ...]] = EVENT_SYNONYMS) -> DataFrame:
    """Bring event-sheet columns to their canonical names."""
    by_name = {c.strip().lower(): c for c in df.columns}
    found = {by_name[s]: canon for canon, names in synonyms.items() for s in names if s in by_name}
    return df.withColumnsRenamed(found)


def side_columns(df: DataFrame, side: str, keep: Sequence[str]) -> DataFrame:
    """Only one body side's columns, without the prefix and with blanks for underscores."""
    prefix = f"{side.capitalize()} "
    picked = [
        F.col(f"`{c}`").alias(c.removeprefix(prefix).replace("_", " "))
        for c in df.columns if c.startswith(prefix) and c not in keep
    ]
    return df.select(*keep, *picked)


def event_times(events: DataFrame, keys: Sequence[str], names: dict[str, str], name: str = "event", t: str = "t", order: str = "row") -> DataFrame:
    """One column per wanted event: time of its first row that has one, under the trimmed name."""
    sec = sc.to_seconds(F.col(t))
    at = {out: F.min_by(sec, F.when((F.trim(name) == F.lit(event.strip())) & sec.isNotNull(), F.col(order))) for out, event in names.items()}
    return events.groupBy(*keys).agg(*[v.alias(k) for k, v in at.items()])


def missing_events(times: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Violation rows for wanted events a recording lacks."""
    cols = [c for c in times.columns if c not in keys]
    gone = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in cols]))
    return times.select(*keys, F.explode(gone).alias("missing_event"))


def unique_ids(headers: DataFrame, keys: Sequence[str], name: str = "name") -> DataFrame:
    """Distinct recording ids among sheet columns, duplicates' ``.1`` suffixes removed."""
    return headers.select(*keys, F.regexp_replace(name, r"\.\d+$", "").alias("uid")).distinct()


def motion_cells(cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Cells of one data sheet, named by its two header rows: (keys, uid, row, name, value).

    Rows 0 and 1 give the composite name; the first column of a recording is its clock.
    """
    keys = list(keys)
    c = cells.withColumn("uid", sc.clean_uid(F.regexp_replace("uid", r"\.\d+$", "")))
    head = c.filter("row <= 1").groupBy(*keys, "uid", "col").agg(
        F.max(F.when(F.col("row") == 0, F.col("value"))).alias("_a"), F.max(F.when(F.col("row") == 1, F.col("value"))).alias("_b")
    )
    first = head.groupBy(*keys, "uid").agg(F.min("col").alias("_first"))
    named = head.join(first, [*keys, "uid"]).select(
        *keys, "uid", "col",
        F.when(F.col("col") == F.col("_first"), "TIME").otherwise(F.concat_ws("_", "_a", "_b")).alias("name"),
    )
    body = c.filter("row > 1").withColumn("row", F.col("row") - 2)
    return body.join(named, [*keys, "uid", "col"]).select(*keys, "uid", "row", "name", "value")


def import_motion(cells: DataFrame, events: DataFrame, keys: Sequence[str], variables: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Motion series (keys, uid, i, t, <variables>) on the event clock, and the problem rows.

    Walking recordings start at their own pass marker, all others at zero.
    """
    keys = list(keys)
    named = motion_cells(cells, keys)
    num = sc.to_number(F.col("value"))
    wide = named.groupBy(*keys, "uid", F.col("row").cast("long").alias("i")).agg(
        F.max(F.when(F.col("name") == "TIME", sc.to_seconds(F.col("value")))).alias("t"),
        *[F.max(F.when(F.col("name") == v, num)).alias(v) for v in variables],
    )
    parts = sc.uid_parts(F.col("uid"))
    ids = named.select(*keys, "uid").distinct().select(*keys, "uid", *[v.alias(k) for k, v in parts.items()])
    wanted = ids.withColumn("event", F.when(F.col("maneuver") == "walk", sc.event_name(F.col("speed"), F.col("pass_number"), "Start")))
    marks = events.select(*keys, F.trim("event").alias("event"), sc.to_seconds(F.col("t")).alias("_start"), "row")
    marks = marks.filter("_start IS NOT NULL").groupBy(*keys, "event").agg(F.min_by("_start", "row").alias("_start"))
    placed = wanted.join(marks, [*keys, "event"], "left")
    walking = F.col("maneuver") == "walk"
    start = F.when(walking, F.col("_start")).otherwise(F.lit(0.0))
    origin = wide.groupBy(*keys, "uid").agg(F.min_by("t", "i").alias("_t0"))
    clocked = wide.join(origin, [*keys, "uid"]).join(placed.select(*keys, "uid", "maneuver", "speed", "pass_number", start.alias("_at")), [*keys, "uid"])
    series = clocked.filter("_at IS NOT NULL").withColumn("t", F.col("t") - F.col("_t0") + F.col("_at"))
    problem = F.coalesce(sc.uid_problem(parts), F.when(walking & F.col("_start").isNull(), "missing_pass_marker"))
    bad = placed.withColumn("problem", problem).filter("problem IS NOT NULL").select(*keys, "uid", "problem")
    many = ids.filter("maneuver <> 'walk'").groupBy(*keys, "maneuver").agg(F.count(F.lit(1)).alias("n")).filter("n <> 1")
    bad = bad.unionByName(many.select(*keys, F.col("maneuver").alias("uid"), F.lit("expected_one_recording").alias("problem")))
    return series.select(*keys, "uid", "maneuver", "speed", "pass_number", "i", "t", *variables), bad


def motion_rate(motion: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Samples per second from the mean step, which is the span over the number of steps."""
    n = F.count("t") - 1
    return motion.groupBy(*keys).agg(
        F.when((n > 0) & (F.max_by("t", "i") > F.min_by("t", "i")), n / (F.max_by("t", "i") - F.min_by("t", "i"))).alias("motion_fs")
    )


def fill_down(cells: DataFrame, keys: Sequence[str], column: Column, out: str, order: str = "row", rows: int = BLOCK_ROWS) -> DataFrame:
    """Last non-null value of an expression at or above each row."""
    b = index_blocks(cells, order, rows)
    return running(b, list(keys), [order], {out: ("last", column)}).drop(BLK)


LEGEND_COLUMNS = {0: "file_name", 1: "maneuver_label", 2: "mic", 3: "patellar", 4: "laterality", 5: "notes"}


def legend_rows(cells: DataFrame, keys: Sequence[str], columns: dict[int, str] = LEGEND_COLUMNS) -> DataFrame:
    """Microphone legend rows (keys, knee, maneuver, mic, file_name, patellar, laterality, notes, maneuver_label)
    with a null maneuver where the label names none.

    A block starts at a cell "L Knee" or "R Knee"; below its header lie twelve rows, whose maneuver
    label stands only on the first of four.
    """
    keys = list(keys)
    wide = cells.groupBy(*keys, "row").agg(*[F.max(F.when(F.col("col") == k, F.col("value"))).alias(n) for k, n in columns.items()])
    first = next(iter(columns.values()))
    mark = F.regexp_extract(F.col(first), r"\b([LR]) Knee", 1)
    landmark = F.when(F.length(mark) > 0, F.struct(F.col("row").alias("at"), F.when(mark == "L", "left").otherwise("right").alias("knee")))
    placed = fill_down(wide, keys, landmark, "_block")
    inside = placed.filter(F.col("_block").isNotNull()).withColumn("_k", F.col("row") - F.col("_block.at")).filter("_k BETWEEN 2 AND 13")
    label = F.trim(F.regexp_replace(F.regexp_replace("maneuver_label", "-", " "), r"\s+", " "))
    inside = inside.withColumn("knee", F.col("_block.knee"))
    filled = fill_down(inside, [*keys, "knee"], F.nullif(label, F.lit("")), "_label")
    low = F.lower("_label")
    maneuver = (
        F.when(low.contains("sit to stand"), "sit_to_stand").when(low.contains("flexion extension"), "flexion_extension").when(low.contains("walk"), "walk")
    )
    return filled.select(
        *keys, "knee", maneuver.alias("maneuver"), sc.to_number(F.col("mic")).cast("int").alias("mic"),
        "file_name", "patellar", "laterality", "notes", F.col("_label").alias("maneuver_label"),
    )


def legend(cells: DataFrame, keys: Sequence[str], columns: dict[int, str] = LEGEND_COLUMNS) -> DataFrame:
    """Legend rows whose maneuver is known; the others are in ``legend_problems``."""
    return legend_rows(cells, keys, columns).filter("maneuver IS NOT NULL").drop("maneuver_label")


def legend_problems(cells: DataFrame, keys: Sequence[str], columns: dict[int, str] = LEGEND_COLUMNS) -> DataFrame:
    """(keys, knee, mic, file_name, maneuver_label, problem): filled legend rows that name no known maneuver."""
    rows = legend_rows(cells, keys, columns).filter("maneuver IS NULL AND coalesce(file_name, patellar, laterality) IS NOT NULL")
    return rows.select(*keys, "knee", "mic", "file_name", "maneuver_label", F.lit("unknown_maneuver").alias("problem"))


def fixed_legend(cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The second legend layout: microphones in rows 3..6, files two rows below a knee landmark."""
    keys = list(keys)
    offset = {"left": 0, "right": 3}
    cell = lambda r, c: F.max(F.when((F.col("row") == r) & (F.col("col") == c), F.trim("value")))
    top = cells.filter("row <= 6").groupBy(*keys).agg(
        cell(0, 2).alias("_date"),
        *[cell(3 + k, o + d).alias(f"_{knee}_{k}_{d}") for knee, o in offset.items() for k in range(4) for d in range(3)],
    )
    mics = F.explode(F.array(*[
        F.struct(F.lit(knee).alias("knee"), sc.to_number(F.col(f"_{knee}_{k}_0")).cast("int").alias("mic"),
                 F.col(f"_{knee}_{k}_1").alias("patellar"), F.col(f"_{knee}_{k}_2").alias("laterality"))
        for knee in offset for k in range(4)
    ]))
    day = F.try_to_timestamp(F.trim(F.regexp_extract("_date", r":\s*(.*)$", 1)), F.lit("M/d/yyyy"))
    positions = top.select(*keys, day.alias("recorded_on"), mics.alias("m")).select(*keys, "recorded_on", "m.*")
    wide = cells.groupBy(*keys, "row").agg(*[F.max(F.when(F.col("col") == k, F.trim("value"))).alias(f"c{k}") for k in range(6)])
    low = F.lower("c0")
    landmark = F.when(low.isin("left knee", "right knee"), F.struct(F.col("row").alias("at"), F.split(low, " ")[0].alias("knee")))
    placed = fill_down(wide, keys, landmark, "_b").withColumn("_k", F.col("row") - F.col("_b.at")).filter("_k BETWEEN 2 AND 4")
    label = F.lower(F.regexp_replace(F.regexp_replace("c4", "-", " "), r"\s+", " "))
    maneuver = (
        F.when(label.contains("sit to stand"), "sit_to_stand").when(label.contains("flexion extension"), "flexion_extension").when(label.contains("walk"), "walk")
    )
    files = placed.select(
        *keys, F.col("_b.knee").alias("knee"), maneuver.alias("maneuver"), F.col("c0").alias("file_name"),
        sc.to_number(F.col("c1")).alias("file_size_mb"), F.coalesce("c2", F.lit("unknown")).alias("serial_number"),
        F.col("c3").alias("timestamp"), F.col("c5").alias("notes"),
    ).filter("maneuver IS NOT NULL")
    # a file whose knee has no positions stays, without a microphone
    return files.join(positions, [*keys, "knee"], "left")


def reconcile_legends(primary: DataFrame, fallback: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(chosen legend rows, mismatch rows). The fallback fills files and microphones the primary lacks."""
    on = [*keys, "knee", "maneuver", "mic"]
    a = primary.select(*on, *[F.col(c).alias(f"_a_{c}") for c in ("file_name", "patellar", "laterality")])
    a_file = primary.groupBy(*keys, "knee", "maneuver").agg(F.max(F.nullif(F.trim("file_name"), F.lit(""))).alias("_a_file"))
    b = fallback.select(*on, *[F.col(c).alias(f"_b_{c}") for c in ("file_name", "patellar", "laterality")])
    b_file = fallback.groupBy(*keys, "knee", "maneuver").agg(F.max(F.nullif(F.trim("file_name"), F.lit(""))).alias("_b_file"))
    both = a.join(b, on, "full_outer").join(a_file, on[:-1], "left").join(b_file, on[:-1], "left")
    filled = F.col("_a_file").isNotNull()
    pick = lambda c: F.when(filled, F.coalesce(f"_a_{c}", f"_b_{c}")).otherwise(F.coalesce(f"_b_{c}", f"_a_{c}"))
    chosen = both.select(*on, F.coalesce("_a_file", "_b_file").alias("file_name"), pick("patellar").alias("patellar"), pick("laterality").alias("laterality"))
    fields = F.array(*[
        F.struct(F.concat(F.lit("mic_"), F.col("mic").cast("string"), F.lit(suffix)).alias("field"),
                 F.col(f"_a_{c}").alias("primary_value"), F.col(f"_b_{c}").alias("fallback_value"))
        for c, suffix in (("patellar", "_patellar_position"), ("laterality", "_laterality"))
    ])
    mic_bad = both.filter(filled).select(*on[:-1], F.explode(fields).alias("f")).select(*on[:-1], "f.*")
    file_bad = a_file.join(b_file, on[:-1]).select(
        *on[:-1], F.lit("file_name").alias("field"), F.col("_a_file").alias("primary_value"), F.col("_b_file").alias("fallback_value")
    )
    return chosen, mic_bad.unionByName(file_bad).filter("primary_value <> fallback_value")
