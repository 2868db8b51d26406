"""Clinical sheets per participant and outcome tables per knee."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kymora.functions import scalars as sc

# Item columns of the knee score sheet.
KOOS_ITEMS = (
    [f"s{k}" for k in range(1, 8)] + [f"p{k}" for k in range(1, 10)] + [f"a{k}" for k in range(1, 18)]
    + [f"sp{k}" for k in range(1, 6)] + [f"q{k}" for k in range(1, 5)] + ["Symptoms", "Pain", "ADL", "Sports/Rec", "QOL"]
)
# Score columns of the two joint compartments' sheets.
TFM_COLUMNS = (
    "OST MFC (0-3+)", "OST MTP (0-3+)", "OST LFC (0-3+)", "OST LTP (0-3+)", "JSN M (0-3+)", "JSN L (0-3+)",
    "MT Attrition (0=absent, 1=present)", "MT Sclerosis (0=absent, 1=present)", "LF Sclerosis (0=absent, 1=present)",
)
PFM_COLUMNS = (
    "OST MP (0-3+)", "OST MT (0-3+)", "OST LP (0-3+)", "OST LT (0-3+)", "JSN M (0-3+)", "JSN L (0-3+)",
    "MP Attrition (0=absent, 1=present)", "MT Attrition (0=absent, 1=present)", "MP Sclerosis (0=absent, 1=present)",
    "MT Sclerosis (0=absent, 1=present)", "LP Attrition (0=absent, 1=present)", "LT Attrition (0=absent, 1=present)",
    "LP Sclerosis (0=absent, 1=present)", "LT Sclerosis (0=absent, 1=present)",
)
SIDES = ("left", "right")


def _col(name: str) -> Column:
    return F.col(f"`{name}`")


def with_study_id(df: DataFrame, ids: Sequence[int] | None = None) -> DataFrame:
    out = df.withColumn("study_id", sc.study_number(_col("Study ID")))
    return out.filter(F.col("study_id").isin(*ids)) if ids else out


def demographics(sheet: DataFrame, ids: Sequence[int] | None = None) -> DataFrame:
    g = F.upper(F.substring(F.trim(_col("Gender")), 1, 1))
    return with_study_id(sheet, ids).select(
        "study_id", sc.to_number(_col("Age (years)")).alias("age"), sc.to_number(F.col("BMI")).alias("bmi"),
        F.when(g.isin("M", "F"), g).alias("gender"), sc.yes_no(_col("Knee Pain")).alias("knee_pain"),
    )


def _per_side(sheet: DataFrame, columns: dict[str, str], ids: Sequence[int] | None) -> DataFrame:
    """Long (id, knee, score) rows to one row per id; ``columns`` maps source to output stem."""
    long = with_study_id(sheet, ids).withColumn("_side", sc.choice(F.col("Knee"), SIDES))
    return long.groupBy("study_id").agg(*[
        F.max(F.when(F.col("_side") == side, sc.to_number(_col(src)).cast("int"))).alias(f"{stem}_{side}")
        for src, stem in columns.items() for side in SIDES
    ])


def kl_grades(sheet: DataFrame, joint: str, ids: Sequence[int] | None = None) -> DataFrame:
    """``kl_<joint>_grade_left/right``; joint is ``tfm`` or ``pfm``."""
    return _per_side(sheet, {"Grade": f"kl_{joint}_grade"}, ids)


def koos(right: DataFrame, left: DataFrame, ids: Sequence[int] | None = None) -> DataFrame:
    def side(sheet: DataFrame, suffix: str) -> DataFrame:
        return with_study_id(sheet, ids).select("study_id", *[sc.to_number(_col(c)).alias(f"{c}_{suffix}") for c in KOOS_ITEMS])

    return side(right, "r_knee").join(side(left, "l_knee"), "study_id", "full_outer")


def oai(tfm: DataFrame, pfm: DataFrame, ids: Sequence[int] | None = None) -> DataFrame:
    """Scores per knee; where both sheets name a column alike the second sheet's value counts."""
    a = _per_side(tfm, {c: c for c in TFM_COLUMNS}, ids)
    b = _per_side(pfm, {c: c for c in PFM_COLUMNS}, ids)
    shared = [c for c in b.columns if c in a.columns and c != "study_id"]
    j = a.join(b.select("study_id", *[_col(c).alias(f"_2_{c}") for c in b.columns if c != "study_id"]), "study_id", "full_outer")
    own = [F.coalesce(_col(f"_2_{c}"), _col(c)).alias(c) if c in shared else _col(c) for c in a.columns if c != "study_id"]
    more = [_col(f"_2_{c}").alias(c) for c in b.columns if c != "study_id" and c not in shared]
    return j.select("study_id", *own, *more)


def missing_knees(tfm: DataFrame, pfm: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """(study_id, sheet, knee) that a both-knees study lacks."""
    have = [
        with_study_id(s).select("study_id", F.lit(n).alias("sheet"), sc.choice(F.col("Knee"), SIDES).alias("knee")).distinct()
        for n, s in (("TFM", tfm), ("PFM", pfm))
    ]
    seen = have[0].unionByName(have[1])
    want = (ids if ids is not None else seen).select("study_id").distinct()
    want = want.withColumn("sheet", F.explode(F.array(F.lit("TFM"), F.lit("PFM")))).withColumn("knee", F.explode(F.array(*[F.lit(s) for s in SIDES])))
    return want.join(seen, ["study_id", "sheet", "knee"], "left_anti")


def varus_thrust(sheet: DataFrame, ids: Sequence[int] | None = None) -> DataFrame:
    return with_study_id(sheet, ids).select(
        "study_id", sc.yes_no(_col("Right Knee")).alias("varus_thrust_right"), sc.yes_no(_col("Left Knee")).alias("varus_thrust_left")
    )


def combined(parts: Sequence[DataFrame]) -> DataFrame:
    """All characteristics of a participant in one row."""
    return reduce(lambda a, b: a.join(b, "study_id", "full_outer"), parts)


def outcome_rows(sheet: DataFrame, outcome: str, side_column: str = "Knee", right: str = "Right Knee", left: str = "Left Knee") -> DataFrame:
    """(Study ID, knee, outcome) from a wide (one column per side) or long sheet."""
    if right in sheet.columns and left in sheet.columns:
        cells = F.explode(F.array(
            F.struct(F.lit("R").alias("knee"), _col(right).cast("string").alias("v")),
            F.struct(F.lit("L").alias("knee"), _col(left).cast("string").alias("v")),
        ))
        return sheet.select("Study ID", cells.alias("c")).select("Study ID", "c.knee", F.col("c.v").alias(outcome))
    return sheet.select("Study ID", _col(side_column).alias("knee"), _col(outcome).cast("string").alias(outcome))


def outcomes(sheets: DataFrame | dict[str, DataFrame], outcome: str, side_column: str = "Knee") -> DataFrame:
    """Normalised (study_id, knee, outcome): yes and no as 1 and 0, numbers as they are."""
    if isinstance(sheets, dict):
        tagged = [df.withColumn(side_column, F.lit(side)) for side, df in sheets.items()]
        raw = outcome_rows(reduce(DataFrame.unionByName, tagged), outcome, side_column)
    else:
        raw = outcome_rows(sheets, outcome, side_column)
    number = F.regexp_replace(F.trim(_col("Study ID").cast("string")), "^(AOA|AO|KAE)", "")
    flag = sc.yes_no(_col(outcome))
    value = F.when(flag.isNotNull(), flag.cast("double")).otherwise(sc.to_number(_col(outcome)))
    return raw.select(
        F.coalesce(number.try_cast("int").cast("string"), number).alias("study_id"), sc.knee_letter(F.col("knee")).alias("knee"), value.alias(outcome)
    )
