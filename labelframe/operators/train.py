"""Classifiers, feature importances and hyperparameter search."""

from __future__ import annotations

import itertools
import math
import random
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    OneVsRest,
    RandomForestClassifier,
)
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelframe.functions.checkpoints import materialize
from labelframe.functions.classes import class_counts, class_list
from labelframe.functions.reshape import vector
from labelframe.functions.small import large, local_table
from labelframe.operators import neighbors
from labelframe.operators.boosting import Boosted, fit_boosting
from labelframe.operators.evaluate import model_metrics
from labelframe.operators.extra_trees import ExtraTrees, fit_extra_trees
from labelframe.operators.resample import bucket_digits, number_rows

CLASS_MODELS_AT_ONCE = 4
MOST_DRAWS = 100
SCORED_AT_ONCE = 10

ESTIMATORS: dict[str, Callable] = {
    "logistic_regression": lambda **p: LogisticRegression(family="multinomial", **p),
    "decision_tree": DecisionTreeClassifier,
    "random_forest": RandomForestClassifier,
    # GBTClassifier knows two labels only, hence one model per class
    "boosted_trees": lambda **p: OneVsRest(classifier=GBTClassifier(**p), parallelism=CLASS_MODELS_AT_ONCE),
}

# models that are tables of nodes
TABLE_MODELS: dict[str, Callable] = {"extra_trees": ExtraTrees, "multinomial_boosting": Boosted}
KNN_OPTIONS = ("k", "probes", "block_rows", "seed")


def to_ml(df: DataFrame, features: Sequence[str] | str, label: str | None = None, classes: Sequence = ()) -> DataFrame:
    """Add ``_features`` (vector) and, with a label, its 0-based ``_label``."""
    made = isinstance(features, str) and isinstance(df.schema[features].dataType, VectorUDT)
    out = df.withColumn("_features", F.col(features) if made else array_to_vector(vector(features)))
    if label is not None:
        every = F.array(*[F.lit(c) for c in classes])
        out = out.withColumn("_label", (F.array_position(every, F.col(label)) - 1).cast("double"))
    return out


@dataclass
class Trained:
    """A fitted classifier together with its class list and feature columns."""

    kind: str
    model: object
    classes: list
    features: Sequence[str] | str

    def predict(self, df: DataFrame, output: str = "prediction") -> DataFrame:
        """The table with a column of predicted labels."""
        if self.kind in TABLE_MODELS:
            return self.model.predict(df, self.features, output)
        if self.kind == "knn":
            return self._predict_knn(df, output)
        scored = self.model.transform(to_ml(df, self.features))
        every = F.array(*[F.lit(c) for c in self.classes])
        label = F.element_at(every, F.col("_prediction").cast("int") + 1)
        return scored.select(*[F.col(f"`{c}`") for c in df.columns if c != output], label.alias(output))

    def _predict_knn(self, df: DataFrame, output: str) -> DataFrame:
        train, row_id, label, options = self.model
        found = neighbors.nearest(df, train, row_id, self.features, carry=label, **options)
        votes = neighbors.vote(found, label).select(
            F.col("id").alias("_id"), F.col("prediction").alias(output)
        )
        return df.drop(output).join(large(votes), F.col(row_id) == F.col("_id"), "left").drop("_id")

    def save(self, path: str) -> None:
        """Spark models in their own format, extra trees, multinomial boosting and neighbours as tables."""
        session = None
        if self.kind in TABLE_MODELS:
            session = _session()
            self.model.nodes.write.mode("overwrite").parquet(f"{path}/model")
        elif self.kind == "knn":
            train, row_id, label, options = self.model
            session = train.sparkSession
            names = [self.features] if isinstance(self.features, str) else list(self.features)
            train.select(row_id, label, *names).write.mode("overwrite").parquet(f"{path}/model")
        else:
            session = _session()
            PipelineModel([self.model]).write().overwrite().save(f"{path}/model")
        about = (self.kind, _as_text(self.features), isinstance(self.features, str), _settings(self))
        local_table(
            session, [about], "kind string, features array<string>, is_array boolean, settings map<string, string>"
        ).write.mode("overwrite").parquet(f"{path}/about")
        kind = {int: "long", float: "double", bool: "boolean"}.get(type(self.classes[0]), "string")
        table = local_table(session, list(enumerate(self.classes)), f"ordinal int, class {kind}")
        table.write.mode("overwrite").parquet(f"{path}/classes")

    @classmethod
    def load(cls, path: str) -> Trained:
        spark = _session()
        about = spark.read.parquet(f"{path}/about").first()
        classes = [r["class"] for r in spark.read.parquet(f"{path}/classes").orderBy("ordinal").collect()]
        features = about["features"][0] if about["is_array"] else list(about["features"])
        if about["kind"] in TABLE_MODELS:
            model = TABLE_MODELS[about["kind"]](classes, spark.read.parquet(f"{path}/model"))
        elif about["kind"] == "knn":
            s = about["settings"]
            options = {name: int(s[name]) for name in KNN_OPTIONS if name in s}
            model = (spark.read.parquet(f"{path}/model"), s["row_id"], s["label"], options)
        else:
            model = PipelineModel.load(f"{path}/model").stages[0]
        return cls(about["kind"], model, classes, features)


def _session() -> SparkSession:
    return SparkSession.getActiveSession()


def _as_text(features: Sequence[str] | str) -> list[str]:
    return [features] if isinstance(features, str) else list(features)


def _settings(trained: Trained) -> dict[str, str]:
    if trained.kind != "knn":
        return {}
    _, row_id, label, options = trained.model
    return {"row_id": row_id, "label": label, **{name: str(v) for name, v in options.items() if v is not None}}


def train(
    kind: str,
    df: DataFrame,
    label: str,
    features: Sequence[str] | str,
    params: Mapping | None = None,
    row_id: str | None = None,
    classes: Sequence | None = None,
) -> Trained:
    """Fit one classifier; ``params`` are those of its Spark estimator.

    ``multinomial_boosting`` takes the arguments of :func:`fit_boosting`; ``boosted_trees``
    is one gradient-boosted binary model of Spark's per class.  ``extra_trees`` takes the
    arguments of :func:`fit_extra_trees`, ``knn`` those of ``nearest``.  The classes are
    read off the table unless they are given.
    """
    params = dict(params or {})
    classes = list(classes) if classes is not None else class_list(df, label)
    if kind == "extra_trees":
        return Trained(kind, fit_extra_trees(df, label, features, **params), classes, features)
    if kind == "multinomial_boosting":
        return Trained(kind, fit_boosting(df, label, features, **params), classes, features)
    if kind == "knn":
        if row_id is None:
            raise ValueError("knn needs row_id")
        return Trained(kind, (df, row_id, label, {"k": 5, **params}), classes, features)
    estimator = ESTIMATORS[kind](**params)
    estimator = estimator.setFeaturesCol("_features").setLabelCol("_label").setPredictionCol("_prediction")
    ready = to_ml(df.where(F.col(label).isNotNull()), features, label, classes).select("_features", "_label")
    model = estimator.fit(ready)
    if getattr(model, "hasSummary", False):
        # a summary holds the training rows and the session, which cannot be sent to the executors
        model._java_obj.setSummary(df.sparkSession._jvm.scala.Option.apply(None))
    return Trained(kind, model, classes, features)


def train_all(
    kinds: Sequence[str], df: DataFrame, label: str, features: Sequence[str] | str,
    params: Mapping[str, Mapping] | None = None, row_id: str | None = None,
) -> dict[str, Trained]:
    """Fit a list of classifiers in order; the table is written once and read by each."""
    df = materialize(df)
    classes = class_list(df, label)
    return {k: train(k, df, label, features, (params or {}).get(k), row_id, classes) for k in kinds}


def importances(model: Trained) -> DataFrame:
    """Rows ``(ordinal, feature, importance)`` of a fitted tree or forest of Spark's: gains by feature, summing to 1."""
    shares = model.model.featureImportances.toArray()
    names = [f"{model.features}[{i}]" for i in range(len(shares))] if isinstance(model.features, str) else model.features
    rows = [(i, f, float(v)) for i, (f, v) in enumerate(zip(names, shares))]
    return local_table(_session(), rows, "ordinal int, feature string, importance double")


def forest_importances(
    df: DataFrame, label: str, features: Sequence[str], n_trees: int = 50, max_depth: int = 10, seed: int = 42
) -> DataFrame:
    """Rows ``(ordinal, feature, importance)`` of a random forest fitted to ``df``."""
    fitted = train(
        "random_forest", df, label, features,
        {"numTrees": n_trees, "maxDepth": max_depth, "seed": seed, "featureSubsetStrategy": "sqrt"},
    )
    return importances(fitted)


def select_features(importances: DataFrame, threshold: float = 0.0005) -> DataFrame:
    """Every feature, in order, with whether it reaches the threshold."""
    return importances.select(
        "ordinal", "feature", "importance", (F.col("importance") >= threshold).alias("selected")
    )


def selected_names(selection: DataFrame) -> list[str]:
    """The kept feature names, in column order."""
    return [r["feature"] for r in selection.where("selected").orderBy("ordinal").collect()]


def dropped_features(selection: DataFrame) -> DataFrame:
    return selection.where(~F.col("selected")).select("feature", "importance").orderBy("feature")


def apply_selection(df: DataFrame, names: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    return df.select(*keep, *[F.col(f"`{n}`") for n in names])


def draw_params(space: Mapping, n_trials: int, seed: int = 42) -> list[dict]:
    """Random settings: a list is chosen from, a pair (lo, hi) is a range.

    Ranges of two ints give ints.  No setting is drawn twice; a space with no more than
    ``n_trials`` settings is given whole, in order.
    """
    rng = random.Random(seed)
    sizes = [None if isinstance(c, tuple) and not _whole(c) and c[0] != c[1] else len(_values(c)) for c in space.values()]
    if None not in sizes and math.prod(sizes) <= n_trials:
        return [dict(zip(space, values)) for values in itertools.product(*map(_values, space.values()))]
    trials: list[dict] = []
    for _ in range(MOST_DRAWS * n_trials):  # a narrow range of floats may hold fewer values than trials
        drawn = {}
        for name, choice in space.items():
            if isinstance(choice, tuple):
                drawn[name] = rng.randint(*choice) if _whole(choice) else rng.uniform(*choice)
            else:
                drawn[name] = rng.choice(_values(choice))
        if drawn not in trials:
            trials.append(drawn)
        if len(trials) == n_trials:
            break
    return trials


def _whole(choice: tuple) -> bool:
    return all(isinstance(v, int) for v in choice)


def _values(choice: tuple | Sequence) -> Sequence:
    """The distinct settings of a list, of a range of ints or of a range that is one point, in order."""
    if isinstance(choice, tuple) and choice[0] == choice[1]:
        return [choice[0]]
    return range(choice[0], choice[1] + 1) if isinstance(choice, tuple) else list(dict.fromkeys(choice))


def stratified_folds(df: DataFrame, label: str, row_id: str, folds: int, seed: int = 42) -> DataFrame:
    """Add ``fold`` 0..folds-1, even within each class.

    Only real rows are dealt out; a synthetic row follows the row it was made from, its
    ``base_id``.
    """
    real = df.where(~F.col("is_synthetic")) if "is_synthetic" in df.columns else df
    keys = real.select(row_id, label)
    largest = max(class_counts(keys, label).values(), default=0)
    numbered = number_rows(keys, label, row_id, seed, "fold", bucket_digits(largest))
    table = numbered.select(F.col(row_id).alias("_id"), F.pmod(F.col("idx"), F.lit(folds)).cast("int").alias("fold"))
    return df.join(large(table), F.col("base_id" if "base_id" in df.columns else row_id) == F.col("_id")).drop("_id")


def _scored_together(fitted: Sequence[Trained], check: DataFrame, label: str) -> Iterator[DataFrame]:
    """``(model, label, prediction)`` of all models, some in each pass over the rows."""
    for lo in range(0, len(fitted), SCORED_AT_ONCE):
        some, scored = fitted[lo : lo + SCORED_AT_ONCE], check
        for i, model in enumerate(some):
            scored = model.predict(scored, f"_prediction_{i}")
        each = [F.struct(F.lit(str(lo + i)).alias("model"), F.col(f"_prediction_{i}").alias("prediction")) for i in range(len(some))]
        yield scored.select(F.col(label).alias("label"), F.inline(F.array(*each))).select("model", "label", "prediction")


def _knn_trials(
    learn: DataFrame, check: DataFrame, trials: Sequence[Mapping], label: str, row_id: str, features: Sequence[str] | str
) -> Iterator[DataFrame]:
    """``(model, label, prediction)`` of all trials: those that differ in ``k`` alone vote from one search."""
    alike: dict[tuple, dict[int, int]] = {}
    for t, params in enumerate(trials):
        rest = tuple(sorted((name, v) for name, v in params.items() if name != "k"))
        alike.setdefault(rest, {})[params.get("k", 5)] = t
    for rest, of_k in alike.items():
        found = neighbors.nearest(check, learn, row_id, features, k=max(of_k), carry=label, **dict(rest))
        votes = neighbors.vote_each(found, label, list(of_k))
        truth = check.select(F.col(row_id).alias("_id"), F.col(label).alias("label"), F.explode(F.array(*[F.lit(k) for k in of_k])).alias("_k"))
        both = truth.join(large(votes), (truth["_id"] == votes["id"]) & (truth["_k"] == votes["k"]), "left")
        number = F.element_at(F.create_map(*[F.lit(x) for k, t in of_k.items() for x in (k, str(t))]), F.col("_k"))
        yield both.select(number.alias("model"), "label", "prediction")


def search(
    kind: str,
    df: DataFrame,
    label: str,
    row_id: str,
    features: Sequence[str] | str,
    space: Mapping,
    n_trials: int = 10,
    folds: int = 3,
    seed: int = 42,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    parallelism: int = 2,
    prepare_first: bool = False,
) -> tuple[Trained, dict, float, DataFrame]:
    """Random search on cross-validated macro F1, then a refit on all rows.

    ``prepare`` is applied to the training part of each fold, e.g. to oversample it,
    so that no synthetic row is made from a validation row.  When the table already
    holds synthetic rows (``is_synthetic``), they are kept out of the validation
    parts.  ``prepare_first`` applies it to the whole table before the folds are dealt
    instead: rows made from a validation row may then be learned from, and validated on,
    which flatters the scores.  The trials of a fold are scored together: ``SCORED_AT_ONCE``
    models in a pass over its validation rows, and neighbour counts from one search.
    ``parallelism`` models are fitted, and folds scored, at once.  Returns the refitted model, its settings, its score and
    the trials.
    """
    spark = df.sparkSession
    if prepare_first:
        df = materialize(prepare(df)) if prepare else df
        df, prepare = df.drop("is_synthetic", "base_id", "synthetic_no"), None
    dealt = materialize(stratified_folds(df, label, row_id, folds, seed))
    real = ~F.col("is_synthetic") if "is_synthetic" in df.columns else F.lit(True)
    parts = []
    for fold in range(folds):
        learn = dealt.where(F.col("fold") != fold).drop("fold")
        learn = materialize(prepare(learn)) if prepare else learn
        parts.append((learn, dealt.where((F.col("fold") == fold) & real).drop("fold")))
    trials = draw_params(space, n_trials, seed)
    classes = class_list(dealt, label)

    def fit(job: tuple[int, int]) -> Trained:
        trial, fold = job
        return train(kind, parts[fold][0], label, features, trials[trial], row_id, classes)

    def fold_scores(fold: int) -> dict[int, float]:
        learn, check = parts[fold]
        if kind == "knn":
            tables = _knn_trials(learn, check, trials, label, row_id, features)
        else:
            tables = _scored_together([fitted[t, fold] for t in range(len(trials))], check, label)
        return {int(r["model"]): r["macro_f1"] for table in tables for r in model_metrics(table).collect()}

    jobs = [(t, fold) for fold in range(folds) for t in range(len(trials))] if kind != "knn" else []
    with ThreadPool(max(1, parallelism)) as pool:
        fitted = dict(zip(jobs, pool.map(inheritable_thread_target(spark)(fit), jobs)))
        results = pool.map(inheritable_thread_target(spark)(fold_scores), range(folds))
    rows = []
    for t, params in enumerate(trials):
        scores = [found[t] for found in results]
        rows.append((t, {k: str(v) for k, v in params.items()}, sum(scores) / len(scores)))
    best = max(rows, key=lambda r: (r[2], -r[0]))
    table = local_table(spark, rows, "trial int, params map<string, string>, cv_macro_f1 double")
    final = prepare(df) if prepare else df
    model = train(kind, final, label, features, trials[best[0]], row_id, classes)
    return model, trials[best[0]], best[2], table
