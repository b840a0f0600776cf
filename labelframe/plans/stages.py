"""From a raw labelled table to a ranked set of models, stage by stage.

Each stage is lazy but for the fitted parameters it needs (categories, scaler, class
counts), which are small.  Column names are arguments throughout.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelframe.functions.checkpoints import materialize
from labelframe.functions.formulas import add_features
from labelframe.operators import clean, encode, evaluate, expect, resample, split, train


@dataclass
class Parts:
    """Training and test rows with the same columns, and what the columns are."""

    train: DataFrame
    test: DataFrame
    row_id: str
    label: str
    quant: list[str]
    indicators: list[str]

    @property
    def features(self) -> list[str]:
        return [*self.quant, *self.indicators]


def clean_and_split(
    raw: DataFrame,
    row_id: str,
    label: str,
    names: Mapping[int, str],
    rules: clean.Rules,
    recodes: Sequence[tuple] = (),
    test_fraction: float = 0.2,
    seed: int = 42,
) -> tuple[DataFrame, DataFrame]:
    """Encode the label, recode, drop impossible rows, split exactly by class."""
    mapping = clean.class_map(raw.sparkSession, names)
    clean.require_known_labels(raw, label, mapping)
    coded = clean.encode_label(raw, label, mapping)
    for column, old, new in recodes:
        coded = clean.recode(coded, column, old, new)
    parted = split.stratified_split(clean.drop_impossible(coded, rules), label, row_id, test_fraction, seed)
    return tuple(parted.where(F.col("split") == s).drop("split") for s in ("train", "test"))


def build_features(
    train_rows: DataFrame,
    test_rows: DataFrame,
    row_id: str,
    label: str,
    formulas: Mapping[str, Column],
    drop: Sequence[str] = (),
    categorical: Sequence[str] = (),
) -> Parts:
    """Formulas on both tables, then indicators of the categories seen in training."""
    fitted = {c: encode.categories(encode.fit_one_hot(train_rows, c)) for c in categorical}

    def apply(df: DataFrame) -> DataFrame:
        out = add_features(df, formulas, drop)
        for column, cats in fitted.items():
            out = encode.one_hot(out, column, cats)
        return out

    indicators = [f"{c}_{v}" for c, cats in fitted.items() for v in cats]
    both = apply(train_rows), apply(test_rows)
    quant = [c for c in both[0].columns if c not in {row_id, label, *indicators}]
    expect.require(
        expect.same_columns(*both),
        expect.no_missing(both[0], check="no missing values in train"),
        expect.no_missing(both[1], check="no missing values in test"),
    )
    return Parts(*both, row_id, label, quant, indicators)


def balance(parts: Parts, targets: Mapping, k: int = 5, seed: int = 42) -> Parts:
    """Oversample the training rows only; the test rows stay as they are.

    The larger table is written once here: selection, scaling and training each read it.
    """
    grown = resample.smote(parts.train, parts.row_id, parts.label, parts.features, targets, k, seed)
    return Parts(materialize(grown), parts.test, parts.row_id, parts.label, parts.quant, parts.indicators)


def select(parts: Parts, threshold: float = 0.0005, n_trees: int = 50, max_depth: int = 10, seed: int = 42) -> Parts:
    """Keep the features whose forest importance, fitted on training rows, is enough."""
    table = train.forest_importances(parts.train, parts.label, parts.features, n_trees, max_depth, seed)
    kept = set(train.selected_names(train.select_features(table, threshold)))
    lost = [f for f in parts.features if f not in kept]
    return Parts(
        parts.train.drop(*lost),
        parts.test.drop(*lost),
        parts.row_id,
        parts.label,
        [f for f in parts.quant if f in kept],
        [f for f in parts.indicators if f in kept],
    )


def scale(parts: Parts) -> tuple[Parts, DataFrame]:
    """Scale the quantitative columns by training parameters; indicators are left alone."""
    params = encode.fit_scaler(parts.train, parts.quant)
    both = [encode.apply_scaler(df, params) for df in (parts.train, parts.test)]
    return Parts(*both, parts.row_id, parts.label, parts.quant, parts.indicators), params


def train_and_rank(
    parts: Parts, kinds: Sequence[str], params: Mapping[str, Mapping] | None = None
) -> tuple[dict[str, train.Trained], DataFrame, DataFrame]:
    """Fit every kind, score the test rows; the models, their predictions, their ranking."""
    models = train.train_all(kinds, parts.train, parts.label, parts.features, params, parts.row_id)
    scored = [
        m.predict(parts.test).select(F.lit(k).alias("model"), parts.row_id, F.col(parts.label).alias("label"), "prediction")
        for k, m in models.items()
    ]
    predictions = reduce(DataFrame.unionByName, scored)
    return models, predictions, evaluate.rank_models(evaluate.model_metrics(predictions), list(kinds))
