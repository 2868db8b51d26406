"""Labelled matrices, leakage guards and logistic regression on spark.ml.

Rows with a missing feature (null or NaN) take no part: they are set aside before folds are dealt, every
count and the penalty come from the rows really used, and the number set aside is reported.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kymora.functions import scalars as sc
from kymora.operators.features import participant_features
from kymora.plans.blocks import KEY, with_key, with_sample_index
from kymora.session import durable

SMALL = 5


def participant_matrix(features: DataFrame, outcome: DataFrame, names: Sequence[str], label: str, statistic: str = "mean") -> DataFrame:
    """One row per participant: aggregated features and 1 where the outcome says yes."""
    x = participant_features(features, ["study_id"], names, statistic)
    y = outcome.select("study_id", F.when(F.lower(F.trim(F.col(label).cast("string"))) == "yes", 1.0).otherwise(0.0).alias("label"))
    return x.join(y, "study_id")


def duplicate_outcomes(outcome: DataFrame) -> DataFrame:
    """(study_id, knee) with more than one outcome; a knee-level matrix must not be built from them."""
    return outcome.groupBy("study_id", "knee").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def knee_matrix(features: DataFrame, outcome: DataFrame, names: Sequence[str], label: str) -> DataFrame:
    """One row per cycle with its knee's outcome.

    The whole column decides the reading: numbers if all are numbers, else yes/no if all are, else text.
    """
    x = features.withColumn("knee", sc.knee_letter(F.col("knee")))
    y = outcome.select("study_id", sc.knee_letter(F.col("knee")).alias("knee"), F.col(label).cast("string").alias("_raw"))
    j = x.join(y, ["study_id", "knee"])
    kinds = j.agg(
        F.count_if(sc.to_number(F.col("_raw")).isNull()).alias("not_number"), F.count_if(sc.yes_no(F.col("_raw")).isNull()).alias("not_flag")
    ).first()
    if kinds["not_number"] == 0:
        value: Column = sc.to_number(F.col("_raw"))
    elif kinds["not_flag"] == 0:
        value = sc.yes_no(F.col("_raw")).cast("double")
    else:
        value = F.col("_raw")
    return j.select("study_id", "knee", *names, value.alias("label"))


def both_sides(ids: DataFrame, other: DataFrame, key: str = "study_id") -> DataFrame:
    """Rows whose participant also occurs in the other table."""
    return ids.join(other.select(key).distinct(), key, "left_semi")


def exclude_contralateral(train: DataFrame, test: DataFrame) -> DataFrame:
    """Training rows whose participant's other knee is not in the test set."""
    other = F.when(F.col("knee") == "R", "L").otherwise(F.lit("R"))
    held = test.select("study_id", other.alias("knee")).distinct()
    return train.join(held, ["study_id", "knee"], "left_anti")


def complete_rows(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rows in which every feature has a value."""
    known = F.lit(True)
    for n in names:
        known = known & F.col(n).isNotNull() & ~F.isnan(F.col(n).cast("double"))
    return df.filter(known)


def assign_folds(df: DataFrame, k: int, unit: Sequence[str], seed: int = 42) -> DataFrame:
    """Stratified fold per unit (a participant's knee, or a row key): the label's units in hashed order, dealt round."""
    unit = list(unit)
    units = df.groupBy(*unit).agg(F.max("label").alias("_label"))
    hashed = with_key(units.withColumn("_h", F.xxhash64(F.lit(seed), *unit)), unit).withColumnRenamed(KEY, "_unit")
    dealt = with_sample_index(hashed, ["_label"], ["_h", *unit], "_pos")
    fold = dealt.select(F.col("_unit").alias(KEY), (F.col("_pos") % k).cast("int").alias("fold"))
    return with_key(df, unit).join(fold, KEY).drop(KEY)


def _vectors(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(names), outputCol="features", handleInvalid="error").transform(df)


def scale(train: DataFrame, frames: Sequence[DataFrame], names: Sequence[str]) -> list[DataFrame]:
    """Centre and scale by the training rows' mean and population deviation (constant columns only centred)."""
    stats = train.agg(*[F.avg(n).alias(f"m_{k}") for k, n in enumerate(names)], *[F.stddev_pop(n).alias(f"s_{k}") for k, n in enumerate(names)]).first()

    def scaled(df: DataFrame) -> DataFrame:
        other = [c for c in df.columns if c not in names]
        cols = []
        for k, n in enumerate(names):
            m, s = stats[f"m_{k}"] or 0.0, stats[f"s_{k}"] or 1.0
            cols.append(((F.col(n) - F.lit(m)) / F.lit(s)).alias(n))
        return df.select(*other, *cols)

    return [scaled(f) for f in frames]


def fit(train: DataFrame, names: Sequence[str], *tests: DataFrame, scaled: bool = True):
    """Ridge logistic regression of strength 1; returns (model, scored rows of each test set, or of the training rows).

    Only complete rows are fitted and scored; the penalty is one over their number.
    """
    train = complete_rows(train, names)
    frames = [train, *[complete_rows(t, names) for t in tests or (train,)]]
    frames = scale(train, frames, names) if scaled else frames
    n = frames[0].count()
    model = LogisticRegression(regParam=1.0 / n, elasticNetParam=0.0, standardization=False, maxIter=1000, tol=1e-8).fit(_vectors(frames[0], names))
    scored = [model.transform(_vectors(t, names)).withColumn("probability_1", vector_to_array("probability")[1]).drop("features", "rawPrediction", "probability") for t in frames[1:]]
    return model, *scored


def confusion(scored: DataFrame) -> DataFrame:
    return scored.groupBy(F.col("label").cast("int").alias("label"), F.col("prediction").cast("int").alias("prediction")).agg(F.count(F.lit(1)).alias("n"))


def class_report(scored: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class."""
    cells = confusion(scored)
    hit = F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0))
    real = cells.groupBy(F.col("label").alias("class")).agg(hit.alias("tp"), F.sum("n").alias("support"))
    said = cells.groupBy(F.col("prediction").alias("class")).agg(F.sum("n").alias("predicted"))
    j = real.join(said, "class", "left")
    p, r = F.coalesce(F.col("tp") / F.col("predicted"), F.lit(0.0)), F.col("tp") / F.col("support")
    return j.select("class", p.alias("precision"), r.alias("recall"), F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0).alias("f1"), "support")


def scores(scored: DataFrame) -> dict[str, float]:
    row = scored.agg(F.avg((F.col("label") == F.col("prediction")).cast("double")).alias("accuracy"), F.count_distinct("label").alias("classes")).first()
    auc = float("nan")
    if row["classes"] == 2:
        auc = BinaryClassificationEvaluator(rawPredictionCol="probability_1", metricName="areaUnderROC").evaluate(scored)
    return {"accuracy": row["accuracy"], "auc": auc}


def train_test(
    df: DataFrame, names: Sequence[str], unit: Sequence[str], by_knee: bool = False, group_split: bool = True, row_key: Sequence[str] | None = None
) -> dict:
    """Stratified 80/20 fit. Whole knees are held out by default; ``group_split=False`` splits by row."""
    keys = list(unit) if group_split or not row_key else list(row_key)
    used = durable(complete_rows(df, names))
    missing = df.count() - used.count()
    folds = durable(assign_folds(used, 5, keys))
    test, train = folds.filter("fold = 0"), folds.filter("fold <> 0")
    kept = exclude_contralateral(train, test) if by_knee else train
    n_train, n_kept = train.count(), kept.count()
    if n_kept == 0:
        raise ValueError("no training rows remain after excluding contralateral knees")
    model, scored, on_train = fit(kept, names, test, kept)
    scored = durable(scored)
    return {
        "model": model, "scored": scored, "test": scores(scored), "train": scores(on_train), "confusion": confusion(scored),
        "report": class_report(scored), "training_samples": n_kept, "excluded_contralateral": n_train - n_kept, "missing_features": missing,
    }


def coefficients(model, names: Sequence[str], spark, top: int | None = None) -> DataFrame:
    """Feature weights by absolute size."""
    rows = [(n, float(v)) for n, v in zip(names, model.coefficients.toArray())]
    df = spark.createDataFrame(rows, "feature string, coefficient double").withColumn("abs_coefficient", F.abs("coefficient"))
    df = df.orderBy(F.desc("abs_coefficient"), "feature")
    return df if top is None else df.limit(top)


def cross_validate(df: DataFrame, names: Sequence[str], k: int, unit: Sequence[str], spark, by_knee: bool = False, seed: int = 42) -> DataFrame:
    """(fold, accuracy, auc, n_train, n_test): one fit per fold, scaled on that fold's training rows.

    Folds are dealt over the complete rows, so n_train and n_test are the rows fitted and scored.
    """
    folds = durable(assign_folds(complete_rows(df, names), k, unit, seed))
    rows = []
    for f in range(k):
        test, train = folds.filter(F.col("fold") == f), folds.filter(F.col("fold") != f)
        train = exclude_contralateral(train, test) if by_knee else train
        _, scored = fit(train, names, test)
        s = scores(scored)
        rows.append((f, s["accuracy"], s["auc"], train.count(), test.count()))
    return spark.createDataFrame(rows, "fold int, accuracy double, auc double, n_train bigint, n_test bigint")


def cross_validation_summary(folds: DataFrame) -> DataFrame:
    return folds.agg(
        F.avg("accuracy").alias("mean_accuracy"), F.stddev_pop("accuracy").alias("std_accuracy"),
        F.avg("auc").alias("mean_auc"), F.stddev_pop("auc").alias("std_auc"),
    )


def train_with_fallback(df: DataFrame, names: Sequence[str], unit: Sequence[str], row_key: Sequence[str], by_knee: bool = False) -> dict:
    """Leave-one-out for at most ``SMALL`` complete rows, a split otherwise. A fold that cannot be fitted is not scored."""
    whole, df = df, durable(complete_rows(df, names))
    missing = whole.count() - df.count()
    shape = df.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("label").alias("classes")).first()
    if shape["classes"] < 2:
        raise ValueError("outcome has fewer than two classes")
    if shape["n"] > SMALL:
        out = train_test(df, names, unit, by_knee)
        return {"mode": "train_test_split", "accuracy": out["test"]["accuracy"], "samples": shape["n"],
                "training_samples": out["training_samples"], "excluded_contralateral": out["excluded_contralateral"], "missing_features": missing}
    numbered = durable(with_sample_index(df.withColumn("_all", F.lit(0)), ["_all"], list(row_key), "fold"))
    hits, scored_rows, excluded = 0, 0, 0
    for f in range(shape["n"]):
        test, rest = numbered.filter(F.col("fold") == f), numbered.filter(F.col("fold") != f)
        train = exclude_contralateral(rest, test) if by_knee else rest
        excluded += rest.count() - train.count()
        if train.select("label").distinct().count() < 2:
            continue
        _, s = fit(train, names, test)
        hits += s.filter("label = prediction").count()
        scored_rows += 1
    return {"mode": "loocv", "accuracy": hits / scored_rows if scored_rows else float("nan"), "samples": shape["n"],
            "scored": scored_rows, "excluded_contralateral": excluded, "missing_features": missing}


def participant_pipeline(features: DataFrame, outcome: DataFrame, names: Sequence[str], label: str, statistic: str = "mean") -> dict:
    """Cycle features to a participant-level model."""
    x = durable(participant_matrix(both_sides(features, outcome), outcome, names, label, statistic))
    return train_with_fallback(x, names, ["study_id"], ["study_id"])


def knee_pipeline(features: DataFrame, outcome: DataFrame, names: Sequence[str], label: str, guard: bool = True) -> dict:
    """Cycle features to a knee-level model with the contralateral guard."""
    twice = duplicate_outcomes(outcome)
    if not twice.isEmpty():
        raise ValueError(f"duplicate outcome entries: {[tuple(r)[:2] for r in twice.limit(5).collect()]}")
    x = durable(knee_matrix(features, outcome, names, label).withColumn("_row", F.xxhash64(*names)))
    return train_with_fallback(x, names, ["study_id", "knee"], ["study_id", "knee", "_row"], by_knee=guard)
