"""Confusion matrices, class reports, model comparison and ranking.

Everything after :func:`confusion_matrix` works on at most classes x classes rows
per model, so the predictions are read and shuffled (pre-aggregated) once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelframe.functions.small import settle


def confusion_counts(
    predictions: DataFrame, label: str = "label", prediction: str = "prediction", by: Sequence[str] = ()
) -> DataFrame:
    """Rows ``(by..., label, prediction, n)`` of the cells that occur."""
    return predictions.groupBy(
        *by, F.col(label).alias("label"), F.col(prediction).alias("prediction")
    ).agg(F.count("*").alias("n"))


def confusion_matrix(
    predictions: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    by: Sequence[str] = (),
    classes: Sequence | None = None,
) -> DataFrame:
    """All cells over the class list, empty ones 0.

    Without ``classes`` the list holds every label and prediction that occurs.
    """
    counts = confusion_counts(predictions, label, prediction, by)
    kind = predictions.schema[label].dataType
    if classes is None:
        both = F.explode(F.array(F.col("label"), F.col("prediction"))).alias("c")
        seen = counts.select(both).where("c IS NOT NULL").distinct()
    else:
        seen = predictions.sparkSession.range(1).select(F.explode(F.array(*[F.lit(c).cast(kind) for c in classes])).alias("c"))
    # every pair of classes, for every group: the cells of the answer itself
    cells = seen.select(F.col("c").alias("label")).join(seen.select(F.col("c").alias("prediction")))
    zeros = counts.select(*by).distinct().join(cells) if by else cells
    zeros = zeros.select(*by, "label", "prediction", F.lit(0).cast("long").alias("n"))
    return counts.unionByName(zeros).groupBy(*by, "label", "prediction").agg(F.sum("n").alias("n"))


def accuracy(predictions: DataFrame, label: str = "label", prediction: str = "prediction", by: Sequence[str] = ()) -> DataFrame:
    right = F.col(label).eqNullSafe(F.col(prediction)).cast("double")
    return predictions.groupBy(*by).agg(F.avg(right).alias("accuracy"))


def _over(top: Column, bottom: Column) -> Column:
    """top / bottom, and 0 where the bottom is 0."""
    return F.coalesce(top / F.nullif(bottom, F.lit(0)), F.lit(0.0))


def class_report(confusion: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, F1 and support of every class of a confusion matrix."""
    side = F.explode(
        F.array(
            F.struct(F.col("label").alias("class"), F.col("n").alias("support"), F.lit(0).cast("long").alias("named")),
            F.struct(F.col("prediction").alias("class"), F.lit(0).cast("long").alias("support"), F.col("n").alias("named")),
        )
    )
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    sums = (
        confusion.select(*by, side.alias("s"), hit.alias("hit"))
        .select(*by, "s.*", "hit")
        .where(F.col("class").isNotNull())
        .groupBy(*by, "class")
        # a hit appears on both sides of its cell
        .agg(F.sum("support").alias("support"), F.sum("named").alias("named"), (F.sum("hit") / 2).alias("hits"))
    )
    rates = sums.select(
        *by,
        "class",
        _over(F.col("hits"), F.col("named")).alias("precision"),
        _over(F.col("hits"), F.col("support")).alias("recall"),
        _over(2 * F.col("hits"), F.col("named") + F.col("support")).alias("f1"),
        "support",
    )
    return rates


def macro_average(report: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return report.groupBy(*by).agg(*[F.avg(m).alias(f"macro_{m}") for m in ("precision", "recall", "f1")])


def weighted_average(report: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Averages weighted by support."""
    return report.groupBy(*by).agg(
        *[
            _over(F.sum(F.col(m) * F.col("support")), F.sum("support")).alias(f"weighted_{m}")
            for m in ("precision", "recall", "f1")
        ]
    )


def full_report(report: DataFrame, by: Sequence[str] = (), names: Mapping | None = None) -> DataFrame:
    """The class report with the rows ``macro avg`` and ``weighted avg`` below it.

    ``class`` is text: the name that ``names`` gives to a class, or the class itself.
    """
    named = F.col("class").cast("string")
    if names:
        known = F.create_map(*[F.lit(str(v)) for pair in names.items() for v in pair])
        named = F.coalesce(F.element_at(known, named), named)
    rates = ["precision", "recall", "f1"]
    parts = [report.select(*by, named.alias("class"), *rates, "support")]
    total = report.groupBy(*by).agg(F.sum("support").alias("support"))
    for name, average in (("macro", macro_average), ("weighted", weighted_average)):
        rows = average(report, by)
        rows = rows.join(total, list(by)) if by else rows.crossJoin(total)
        parts.append(rows.select(*by, F.lit(f"{name} avg").alias("class"), *[F.col(f"{name}_{m}").alias(m) for m in rates], "support"))
    return reduce(DataFrame.unionByName, parts)


def model_metrics(predictions: DataFrame, by: str = "model", label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row ``(model, macro_f1, weighted_f1, accuracy)`` per model, from one pass."""
    confusion = confusion_counts(predictions, label, prediction, [by])
    report = class_report(confusion, [by])
    averages = report.groupBy(by).agg(
        F.avg("f1").alias("macro_f1"),
        _over(F.sum(F.col("f1") * F.col("support")), F.sum("support")).alias("weighted_f1"),
        _over(F.sum(F.col("recall") * F.col("support")), F.sum("support")).alias("accuracy"),
    )
    return averages.select(F.col(by).alias("model"), "macro_f1", "weighted_f1", "accuracy")


def compare_models(metrics: DataFrame) -> DataFrame:
    return metrics.orderBy(F.desc("macro_f1"), "model")


def rank_models(metrics: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rank by macro F1 with the champion marked; list order decides between equals."""
    place = F.array_position(F.array(*[F.lit(m) for m in order]), F.col("model"))
    rank = F.row_number().over(Window.orderBy(F.desc("macro_f1"), place))
    return metrics.withColumn("rank", rank).withColumn("is_champion", F.col("rank") == 1)


def against_baselines(metrics: DataFrame, baselines: DataFrame, metric: str = "macro_f1") -> DataFrame:
    """Difference to a stored baseline; a model without one is compared with 0."""
    stored = baselines.select("model", F.col(metric).alias("baseline"))
    base = F.coalesce(F.col("baseline"), F.lit(0.0))
    return metrics.join(settle(stored), "model", "left").select(
        "model", metric, base.alias("baseline"), (F.col(metric) - base).alias("delta")
    )
