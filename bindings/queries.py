"""One query per operator.  Each reads whole tables below a folder of Parquet files."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelframe.functions import formulas
from labelframe.functions.checkpoints import run_folder
from labelframe.functions.classes import class_counts
from labelframe.functions.hashing import hex_to_long
from labelframe.functions.small import local_table
from labelframe.operators import boosting, clean, encode, evaluate, expect, explore, extra_trees, neighbors, profile
from labelframe.operators import resample, split, train
from labelframe.sources import tables

MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
SEED = 42
K_VALUES = [1, 3, 5, 7]
SEARCHED = [1, 5, 9]
SEASON_ENDS = (5, 9)
ITEM_RULES = {
    "l_quantity": (2, 49),
    "l_extendedprice": (1000, 100000),
    "l_discount": (0, 0.09),
    "l_tax": (0, 0.08),
}
PART_RULES = {"p_size": (5, 45), "p_retailprice": (905, 1500)}
# fixed values: the stored scores that models are compared with
BASELINES = [("knn_1", 0.05), ("knn_5", 0.1)]

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Round for comparison; + 0.0 turns a negative zero into zero."""
    shown = {c: f"round(`{c}`, {digits}) + 0.0D AS `{c}`" for c in columns}
    return df.selectExpr(*[shown.get(c, f"`{c}`") for c in df.columns])


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The embedding table with one double column per dimension, as many as its vectors have."""
    df = table(spark, sf_dir, "embeddings")
    least, most = df.agg(F.min(F.size("embedding")), F.max(F.size("embedding"))).first()
    if least != most:
        raise ValueError(f"vectors of {least} to {most} dimensions")
    each = [f"CAST(embedding[{i}] AS DOUBLE) AS e{i}" for i in range(most or 0)]
    return df.selectExpr("vec_id", "CAST(label AS BIGINT) AS label", *each)


def dimensions(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in ("vec_id", "label")]


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "embeddings")
    return df.select("vec_id", F.col("label").cast("long").alias("label"), "embedding")


def class_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class map ``(code, name)`` of the order priorities, read off the table."""
    names = table(spark, sf_dir, "orders").select("o_orderpriority").distinct()
    return names.select(F.substring("o_orderpriority", 1, 1).cast("long").alias("code"), F.col("o_orderpriority").alias("name"))


# profiling


def profile_shape(spark, d):
    return profile.shape(table(spark, d, "lineitem"))


def profile_head(spark, d):
    return profile.head(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), ["o_orderkey"], 5)


def profile_tail(spark, d):
    return profile.tail(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), ["o_orderkey"], 5)


def profile_describe(spark, d):
    out = profile.describe(table(spark, d, "lineitem"), MEASURES)
    return rounded(out.drop("ordinal"), "mean", "std", "min", "q25", "q50", "q75", "max")


def profile_missing(spark, d):
    return profile.missing_counts(table(spark, d, "lineitem")).drop("ordinal")


def profile_non_null(spark, d):
    return profile.column_info(table(spark, d, "customer")).select("column", "non_null")


def profile_duplicates(spark, d):
    return profile.duplicate_count(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


def profile_value_counts(spark, d):
    return profile.value_counts(table(spark, d, "events"), "event_type")


def profile_balance_ratio(spark, d):
    return rounded(profile.balance_ratio(table(spark, d, "labels"), "quality"), "ratio")


def profile_distinct_values(spark, d):
    return profile.distinct_values(table(spark, d, "part"), "p_type")


def profile_distinct_counts(spark, d):
    return profile.distinct_counts(table(spark, d, "part"), ["p_brand", "p_type", "p_size"]).drop("ordinal")


def profile_ranges(spark, d):
    return rounded(profile.value_ranges(table(spark, d, "lineitem"), MEASURES).drop("ordinal"), "min", "max")


def profile_negatives(spark, d):
    return profile.negative_audit(table(spark, d, "customer"), ["c_acctbal", "c_nationkey"]).drop("ordinal")


def profile_count_equal(spark, d):
    return profile.count_equal(table(spark, d, "part"), "p_size", 50)


def profile_class_distribution(spark, d):
    return rounded(profile.class_distribution(table(spark, d, "labels"), "quality"), "pct")


def profile_compare_distributions(spark, d):
    events = table(spark, d, "events")
    out = profile.compare_distributions(events, events.where(F.col("value") >= 5.0), "event_type")
    return rounded(out, "pct_after")


def profile_minorities(spark, d):
    return profile.minority_flags(table(spark, d, "labels"), "quality", 100)


# cleaning and splitting


def clean_invert_class_map(spark, d):
    return clean.invert_class_map(class_codes(spark, d))


def clean_unknown_labels(spark, d):
    known = class_codes(spark, d).where(F.col("code") <= 3)
    return clean.unknown_labels(table(spark, d, "orders"), "o_orderpriority", known)


def clean_encode_label(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    return clean.encode_label(orders, "o_orderpriority", class_codes(spark, d), "code")


def clean_decode_label(spark, d):
    codes = class_codes(spark, d)
    encoded = clean.encode_label(table(spark, d, "orders"), "o_orderpriority", codes, "code")
    return clean.decode_label(encoded.select("o_orderkey", "code"), "code", codes, "name")


def clean_recode(spark, d):
    return clean.recode(table(spark, d, "part").select("p_partkey", "p_size"), "p_size", 50, 0)


def clean_audit_ranges(spark, d):
    return clean.audit_ranges(table(spark, d, "lineitem"), ITEM_RULES).drop("ordinal")


def clean_drop_impossible(spark, d):
    return clean.drop_impossible(table(spark, d, "part"), PART_RULES).select("p_partkey", "p_size", "p_retailprice")


def label_distribution(spark, d):
    """Recode, encode and count by recoded status and code: the smallest whole slice of the cleaning stage."""
    orders = clean.recode(table(spark, d, "orders"), "o_orderstatus", "P", "O")
    encoded = clean.encode_label(orders, "o_orderpriority", class_codes(spark, d), "code")
    both = encoded.withColumn("both", F.concat_ws("-", "o_orderstatus", F.col("code").cast("string")))
    return rounded(profile.class_distribution(both, "both"), "pct")


def orders_split(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    return split.stratified_split(orders, "o_orderpriority", "o_orderkey", 0.2, SEED)


def split_stratified(spark, d):
    return orders_split(spark, d)


def split_imbalanced(spark, d):
    labels = table(spark, d, "labels").select("doc_id", "quality")
    return split.stratified_split(labels, "quality", "doc_id", 0.25, SEED)


def split_distribution(spark, d):
    out = profile.split_distribution(orders_split(spark, d), "o_orderpriority")
    return rounded(out, "train_pct", "test_pct")


# features


def feature_circular(spark, d):
    orders = table(spark, d, "orders")
    sine, cosine = formulas.circular(F.dayofyear("o_orderdate") * 360.0 / 366.0)
    out = formulas.add_features(
        orders.select("o_orderkey", "o_orderdate"), {"day_sin": sine, "day_cos": cosine}, drop=["o_orderdate"]
    )
    return rounded(out, "day_sin", "day_cos")


def item_formulas(items: DataFrame) -> DataFrame:
    q, p, disc, tax = [F.col(c) for c in MEASURES]
    return formulas.add_features(
        items.select("l_orderkey", *MEASURES),
        {
            "combined": formulas.euclidean(q, tax),
            "net": formulas.difference(p, q),
            "mean_rate": formulas.row_mean([q, disc, tax]),
            "interaction": formulas.product(q, disc),
            "rate_ratio": formulas.ratio(p, q),
        },
        drop=["l_extendedprice"],
    )


def feature_formulas(spark, d):
    out = item_formulas(table(spark, d, "lineitem"))
    return rounded(out, "l_discount", "l_tax", "combined", "net", "mean_rate", "interaction", "rate_ratio", digits=9)


def parts_split(spark, d):
    parts = table(spark, d, "part").select("p_partkey", "p_brand", "p_type", "p_size", "p_retailprice")
    return split.stratified_split(parts, "p_type", "p_partkey", 0.5, SEED)


def encode_fit_one_hot(spark, d):
    return encode.fit_one_hot(parts_split(spark, d).where("split = 'train'"), "p_brand")


def type_indicators(spark, d):
    cats = encode.categories(encode.fit_one_hot(parts_split(spark, d).where("split = 'train'"), "p_type"))
    return encode.one_hot(table(spark, d, "part").select("p_partkey", "p_type"), "p_type", cats), cats


def encode_one_hot(spark, d):
    """Fitted on the training part, applied to all."""
    return type_indicators(spark, d)[0]


def encode_unseen(spark, d):
    """Categories of cheap parts, counted over all parts: unseen ones add nothing."""
    parts = table(spark, d, "part")
    seen = parts.where((F.col("p_brand") < "Brand#2") & (F.col("p_size") <= 25))
    cats = encode.categories(encode.fit_one_hot(seen, "p_brand"))
    hot = encode.one_hot(parts.select("p_brand"), "p_brand", cats, prefix="b")
    return explore.indicator_counts(hot, [f"b_{c}" for c in cats]).drop("ordinal")


def encode_align_rows(spark, d):
    hot, _ = type_indicators(spark, d)
    sizes = table(spark, d, "part").select("p_partkey", "p_size")
    return encode.align_rows([sizes, hot], "p_partkey")


def encode_inverse(spark, d):
    parts = table(spark, d, "part").select("p_partkey", "p_brand")
    cats = encode.categories(encode.fit_one_hot(parts, "p_brand"))
    hot = encode.one_hot(parts, "p_brand", cats)
    return encode.inverse_one_hot(hot, [f"p_brand_{c}" for c in cats], "brand_no").select("p_partkey", "brand_no")


def scale_fit(spark, d):
    out = encode.fit_scaler(parts_split(spark, d).where("split = 'train'"), ["p_size", "p_retailprice"])
    return rounded(out.drop("ordinal"), "mean", "std")


def scale_apply(spark, d):
    parts = parts_split(spark, d)
    params = encode.fit_scaler(parts.where("split = 'train'"), ["p_size", "p_retailprice"])
    scaled = encode.apply_scaler(parts, params).select("p_partkey", "split", "p_size", "p_retailprice")
    return rounded(scaled, "p_size", "p_retailprice")


# expectations


def expect_no_missing(spark, d):
    return expect.no_missing(table(spark, d, "lineitem"), MEASURES)


def expect_in_range(spark, d):
    return expect.all_checks(
        expect.in_range(table(spark, d, "part"), "p_size", 1, 50),
        expect.in_range(table(spark, d, "customer"), "c_acctbal", 0, 10000),
    )


def expect_row_count(spark, d):
    return expect.row_count(table(spark, d, "events"), 10000)


# exploration


def explore_histogram(spark, d):
    out = explore.histogram(table(spark, d, "lineitem"), ["l_extendedprice", "l_discount"], 50)
    return rounded(out.drop("ordinal"), "lower", "upper")


def explore_histogram_skewed(spark, d):
    return rounded(explore.histogram(table(spark, d, "events"), ["value"], 50).drop("ordinal"), "lower", "upper")


def explore_skewness(spark, d):
    return rounded(explore.adjusted_skewness(table(spark, d, "lineitem"), MEASURES).drop("ordinal"), "skewness")


def explore_correlations(spark, d):
    out = explore.correlations(table(spark, d, "lineitem"), MEASURES).drop("ordinal_a", "ordinal_b")
    return rounded(out, "r")


def explore_correlations_wide(spark, d):
    df = embeddings(spark, d)
    out = explore.correlations(df, dimensions(df)).drop("ordinal_a", "ordinal_b")
    return rounded(out, "r")


def explore_strong_pairs(spark, d):
    price = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    items = table(spark, d, "lineitem").select(
        *MEASURES, price.alias("net_price"), (price * (1 + F.col("l_tax"))).alias("gross_price")
    )
    corr = explore.correlations(items, [*MEASURES, "net_price", "gross_price"])
    return rounded(explore.strong_pairs(corr, 0.85), "abs_r")


def explore_box_statistics(spark, d):
    out = explore.box_statistics(table(spark, d, "events"), ["value"], "event_type")
    return rounded(out.drop("ordinal"), "q25", "q50", "q75", "whisker_low", "whisker_high")


def explore_box_statistics_items(spark, d):
    out = explore.box_statistics(table(spark, d, "lineitem"), MEASURES, "l_returnflag")
    return rounded(out.drop("ordinal"), "q25", "q50", "q75", "whisker_low", "whisker_high")


def explore_violin(spark, d):
    out = explore.violin(table(spark, d, "events"), ["value"], "event_type", grid=100)
    return rounded(out.drop("ordinal"), "x", "density", "q25", "q50", "q75")


def explore_cross_tab(spark, d):
    return explore.cross_tab(table(spark, d, "lineitem"), "l_returnflag", "l_linestatus")


def explore_cross_tab_percent(spark, d):
    return rounded(explore.cross_tab_percent(table(spark, d, "documents"), "lang", "source"), "pct")


def brand_indicators(spark, d):
    parts = table(spark, d, "part")
    cats = encode.categories(encode.fit_one_hot(parts, "p_brand"))
    return encode.one_hot(parts.select("p_brand"), "p_brand", cats), [f"p_brand_{c}" for c in cats]


def explore_indicator_counts(spark, d):
    return explore.indicator_counts(*brand_indicators(spark, d)).drop("ordinal")


def explore_sparse_indicators(spark, d):
    hot, columns = brand_indicators(spark, d)
    return explore.sparse_indicators(hot, columns, share=0.04, below=70).drop("ordinal")


def encode_sparse(spark, d):
    """Indicators of a column of many categories, one of them unseen, as entries of a sparse vector."""
    events = table(spark, d, "events")
    fitted = encode.fit_one_hot(events.where("user_id % 10 <> 3"), "user_id")
    made = encode.one_hot_vector(events.select("event_id", "user_id", "value"), {"user_id": fitted}, "vec", dense=["value"])
    out = encode.vector_entries(made, "vec", ["event_id"]).where("index > 0")
    return out.select("event_id", F.col("index").cast("long").alias("index"), "value")


def expect_together(spark, d):
    """Several checks of one table from one aggregate."""
    items = table(spark, d, "lineitem")
    ranges = [expect.range_check(c, lo, hi) for c, (lo, hi) in ITEM_RULES.items()]
    return expect.run_checks(items, [expect.missing_check(items, MEASURES), *ranges, expect.count_check(60_000)])


def explore_sparse_categories(spark, d):
    out = explore.sparse_categories(table(spark, d, "events"), "user_id", share=0.0065, below=60)
    return rounded(out, "pct")


def variance_shares(spark, d):
    """An importance table that SQL can check: each dimension's share of the variance."""
    df = embeddings(spark, d)
    spread = encode.fit_scaler(df, dimensions(df))
    total = spread.agg(F.sum(F.col("std") * F.col("std"))).scalar()
    share = F.col("std") * F.col("std") / total
    return spread.select("ordinal", F.col("column").alias("feature"), share.alias("importance"))


def select_ranking(spark, d):
    out = explore.importance_ranking(variance_shares(spark, d), 1 / 64, 30)
    return rounded(out.drop("ordinal"), "importance")


def select_by_threshold(spark, d):
    return rounded(train.select_features(variance_shares(spark, d), 1 / 64).drop("ordinal"), "importance")


def select_dropped(spark, d):
    chosen = train.select_features(variance_shares(spark, d), 1 / 64)
    return rounded(train.dropped_features(chosen), "importance")


# resampling


def growth_targets(df: DataFrame) -> dict:
    """Every class below the largest one is raised to it."""
    counts = class_counts(df, "label")
    top = max(counts.values())
    return {c: top for c, n in counts.items() if n < top}


def resample_plan(spark, d):
    df = vectors(spark, d)
    return resample.oversampling_plan(df, "label", growth_targets(df))


def resample_neighbors(spark, d):
    df = vectors(spark, d)
    out = neighbors.nearest(df, df, "vec_id", "embedding", k=5, group="label", exclude_self=True)
    return rounded(out, "distance2")


def grown(spark, d):
    df = embeddings(spark, d)
    return df, resample.smote(df, "vec_id", "label", dimensions(df), growth_targets(df), 5, SEED)


def resample_smote(spark, d):
    """Real and synthetic rows together."""
    df, out = grown(spark, d)
    return rounded(out, *dimensions(df))


def resample_comparison(spark, d):
    before, after = grown(spark, d)
    return rounded(profile.compare_distributions(before, after, "label"), "pct_after")


def expect_class_targets(spark, d):
    before, after = grown(spark, d)
    return expect.class_targets_met(before, after, "label", growth_targets(before))


# learning


def vector_split(spark, d):
    df = split.stratified_split(vectors(spark, d), "label", "vec_id", 0.2, SEED)
    return df.where("split = 'train'").drop("split"), df.where("split = 'test'").drop("split")


def knn_on_oversampled(spark, d):
    """Split, oversample the training part, classify the test part by its real and new rows."""
    df = split.stratified_split(embeddings(spark, d), "label", "vec_id", 0.2, SEED)
    learn, check = (df.where(F.col("split") == s).drop("split") for s in ("train", "test"))
    more = resample.smote(learn, "vec_id", "label", dimensions(learn), growth_targets(learn), 5, SEED)
    return neighbors.classify(more, check, "vec_id", "label", dimensions(learn), k=5)


def knn_predictions(spark, d):
    """Predictions of four neighbour counts, from one neighbour search."""
    learn, check = vector_split(spark, d)
    found = neighbors.nearest(check, learn, "vec_id", "embedding", k=max(K_VALUES), carry="label")
    votes = neighbors.vote_each(found, "label", K_VALUES)
    truth = check.select(F.col("vec_id").alias("id"), "label")
    return votes.join(truth, "id").select(F.format_string("knn_%d", "k").alias("model"), "id", "label", "prediction")


def knn_classify(spark, d):
    learn, check = vector_split(spark, d)
    return neighbors.classify(learn, check, "vec_id", "label", "embedding", k=5)


def evaluate_confusion(spark, d):
    return evaluate.confusion_matrix(knn_predictions(spark, d), by=["model"])


def evaluate_accuracy(spark, d):
    return rounded(evaluate.accuracy(knn_predictions(spark, d), by=["model"]), "accuracy")


def knn_report(spark, d):
    return evaluate.class_report(evaluate.confusion_counts(knn_predictions(spark, d), by=["model"]), ["model"])


def evaluate_class_report(spark, d):
    return rounded(knn_report(spark, d), "precision", "recall", "f1")


def evaluate_full_report(spark, d):
    out = evaluate.full_report(knn_report(spark, d), ["model"], {i: f"class {i}" for i in range(10)})
    return rounded(out, "precision", "recall", "f1")


def evaluate_macro(spark, d):
    out = evaluate.macro_average(knn_report(spark, d), ["model"])
    return rounded(out, "macro_precision", "macro_recall", "macro_f1")


def evaluate_weighted(spark, d):
    out = evaluate.weighted_average(knn_report(spark, d), ["model"])
    return rounded(out, "weighted_precision", "weighted_recall", "weighted_f1")


def knn_metrics(spark, d):
    return evaluate.model_metrics(knn_predictions(spark, d))


def evaluate_comparison(spark, d):
    return rounded(evaluate.compare_models(knn_metrics(spark, d)), "macro_f1", "weighted_f1", "accuracy")


def evaluate_ranking(spark, d):
    ranked = evaluate.rank_models(knn_metrics(spark, d), [f"knn_{k}" for k in K_VALUES])
    out = ranked.select("model", "macro_f1", F.col("rank").cast("long").alias("rank"), "is_champion")
    return rounded(out, "macro_f1")


def evaluate_baselines(spark, d):
    stored = local_table(spark, BASELINES, "model string, macro_f1 double")
    out = evaluate.against_baselines(knn_metrics(spark, d), stored)
    return rounded(out, "macro_f1", "baseline", "delta")


def expect_metric_floor(spark, d):
    return expect.metric_above(knn_metrics(spark, d), "macro_f1", 0.06)


def extra_trees_first_cut(spark, d):
    """The root cut of eight trees."""
    forest = extra_trees.fit_extra_trees(vectors(spark, d), "label", "embedding", n_trees=8, max_depth=1, seed=SEED)
    roots = forest.table(spark).where((F.col("node") == 0) & (F.col("child") > 0))
    return rounded(roots.select(F.col("tree").cast("long").alias("tree"), F.col("feature").cast("long").alias("feature"), "threshold"), "threshold")


def extra_trees_two_levels(spark, d):
    """The cuts of the roots and of their children, of four trees."""
    forest = extra_trees.fit_extra_trees(vectors(spark, d), "label", "embedding", n_trees=4, max_depth=2, seed=SEED)
    cuts = forest.table(spark).where("child > 0")
    return rounded(cuts.selectExpr("CAST(tree AS long) AS tree", "CAST(node + 1 AS long) AS path", "CAST(feature AS long) AS feature", "threshold"), "threshold")


def seasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders with a label that their month decides: what a model should learn is known."""
    month = F.month("o_orderdate")
    label = F.when(month <= SEASON_ENDS[0], 0).when(month <= SEASON_ENDS[1], 1).otherwise(2)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        label.cast("long").alias("label"),
        month.cast("long").alias("month"),
        F.col("o_totalprice").alias("price"),
        (13.0 - month).alias("left"),
    )


def season_split(spark, d):
    df = split.stratified_split(seasons(spark, d), "label", "o_orderkey", 0.2, SEED)
    return tuple(df.where(F.col("split") == s).drop("split") for s in ("train", "test"))


MODELS = {
    "logistic_regression": ([], {"maxIter": 50, "regParam": 0.001}),
    "decision_tree": (["month", "price"], {"maxDepth": 5}),
    "random_forest": (["month", "price"], {"numTrees": 20, "maxDepth": 6, "featureSubsetStrategy": "all", "seed": SEED}),
    "boosted_trees": (["month", "price"], {"maxIter": 10, "maxDepth": 3, "seed": SEED}),
    "extra_trees": (["month", "left"], {"n_trees": 10, "max_depth": 12, "seed": SEED}),
    "stump": (["month"], {"maxDepth": 1}),
}


def season_predictions(spark, d, name):
    """Predictions of one model for the test part."""
    learn, check = season_split(spark, d)
    features, params = MODELS[name]
    if name == "logistic_regression":
        months = encode.categories(encode.fit_one_hot(learn, "month"))
        learn, check = (encode.one_hot(df, "month", months) for df in (learn, check))
        features = [f"month_{m}" for m in months]
    kind = "decision_tree" if name == "stump" else name
    return train.train(kind, learn, "label", features, params).predict(check).select("o_orderkey", "label", "prediction")


def train_logistic_regression(spark, d):
    return season_predictions(spark, d, "logistic_regression")


def train_decision_tree(spark, d):
    return season_predictions(spark, d, "decision_tree")


def train_random_forest(spark, d):
    return season_predictions(spark, d, "random_forest")


def train_extra_trees(spark, d):
    return season_predictions(spark, d, "extra_trees")


def train_boosted_trees(spark, d):
    return season_predictions(spark, d, "boosted_trees")


NOISY_FEATURES = ["month", "priority", "weekday"]


def noisy_seasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders; the label follows the month, but for every seventh order, where it is drawn by the key."""
    month, key = F.month("o_orderdate"), F.col("o_orderkey")
    band = F.when(month <= SEASON_ENDS[0], 0).when(month <= SEASON_ENDS[1], 1).otherwise(2)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(key % 7 == 0, key % 3).otherwise(band).cast("long").alias("label"),
        band.cast("long").alias("band"),
        month.cast("long").alias("month"),
        F.substring("o_orderpriority", 1, 1).cast("long").alias("priority"),
        F.dayofweek("o_orderdate").cast("long").alias("weekday"),
    )


def noisy_split(spark, d):
    df = split.stratified_split(noisy_seasons(spark, d), "label", "o_orderkey", 0.2, SEED)
    return tuple(df.where(F.col("split") == s).drop("split") for s in ("train", "test"))


def train_shallow_tree(spark, d):
    """Two levels of cuts by Gini gain on noisy labels, the most frequent label of each leaf."""
    learn, check = noisy_split(spark, d)
    model = train.train("decision_tree", learn, "label", NOISY_FEATURES, {"maxDepth": 2})
    return model.predict(check).select("o_orderkey", "label", "prediction")


def train_tree_importances(spark, d):
    """Gini gains by feature of the shallow tree; a cut whose sides predict the same label is no cut."""
    learn, _ = noisy_split(spark, d)
    model = train.train("decision_tree", learn, "label", NOISY_FEATURES, {"maxDepth": 2})
    return rounded(train.importances(model).drop("ordinal"), "importance")


def train_multinomial_boosting(spark, d):
    """Boosted trees of all classes see through the noise: the band is what they predict."""
    learn, check = noisy_split(spark, d)
    model = train.train("multinomial_boosting", learn, "label", NOISY_FEATURES, {"rounds": 10, "max_depth": 3, "min_child_weight": 20.0})
    return model.predict(check).select("o_orderkey", "label", "prediction")


def boosting_first_round(spark, d):
    """The trees of the first round: cuts and values of all nodes, named by the sides on the way to them."""
    model = boosting.fit_boosting(noisy_seasons(spark, d), "label", NOISY_FEATURES, rounds=1, max_depth=2)
    nodes = model.nodes.select("class", "node", "feature", "threshold", "child", "value")
    up = nodes.where("child >= 0").select(F.col("class").alias("c"), F.col("node").alias("up"), F.explode(F.array(*[F.struct((F.col("child") + i).alias("node"), F.lit(s).alias("side")) for i, s in enumerate("LR")])).alias("of"))
    first = nodes.join(up, (F.col("class") == F.col("c")) & (nodes["node"] == F.col("of.node")), "left")
    second = up.select(F.col("c").alias("c2"), F.col("of.node").alias("up2"), F.col("of.side").alias("side2"))
    named = first.join(second, (F.col("class") == F.col("c2")) & (F.col("up") == F.col("up2")), "left")
    names = F.array(*[F.lit(n) for n in NOISY_FEATURES])
    cut = F.col("feature") >= 0
    out = named.select(
        F.col("class").cast("long").alias("class"),
        F.concat(F.coalesce("side2", F.lit("")), F.coalesce("of.side", F.lit(""))).alias("path"),
        F.when(cut, F.get(names, F.col("feature"))).alias("feature"),
        F.when(cut, F.col("threshold")).alias("threshold"),
        "value",
    )
    return rounded(out, "threshold", "value")


def train_stump(spark, d):
    """One cut: the best Gini gain on the month, the larger class on each side."""
    return season_predictions(spark, d, "stump")


def train_importances(spark, d):
    """What must hold for the importances: one for each feature, none negative, sum 1, the month first."""
    learn, _ = season_split(spark, d)
    out = train.forest_importances(learn, "label", ["price", "month", "o_orderkey"], n_trees=20, max_depth=6, seed=SEED)
    return out.agg(
        F.max_by("feature", "importance").alias("first"),
        F.count("*").alias("n_features"),
        F.count_if(F.col("importance") < 0).alias("n_negative"),
        (F.round(F.sum("importance"), 6) + 0.0).alias("total"),
    )


def train_search(spark, d):
    """Cross-validated macro F1 of every neighbour count."""
    learn, _ = vector_split(spark, d)
    _, _, _, trials = train.search(
        "knn", learn, "label", "vec_id", "embedding", {"k": SEARCHED}, n_trials=len(SEARCHED), folds=3, seed=SEED
    )
    return rounded(trials.select(F.col("params")["k"].cast("long").alias("k"), "cv_macro_f1"), "cv_macro_f1")


def model_metrics_table(spark, d):
    """Metrics of models of four kinds on the held-out rows."""
    names = ["stump", "logistic_regression", "random_forest", "extra_trees"]
    parts = [season_predictions(spark, d, k).select(F.lit(k).alias("model"), "label", "prediction") for k in names]
    found = evaluate.compare_models(evaluate.model_metrics(reduce(DataFrame.unionByName, parts)))
    return rounded(found, "macro_f1", "weighted_f1", "accuracy")


# sources


def source_round_trip(spark, d):
    orders = table(spark, d, "orders")
    where = f"{run_folder(spark)}/round-trip-{uuid.uuid4().hex}"
    # a number for each row that any engine can compute
    text = F.concat_ws(
        "|", "o_orderkey", "o_custkey", "o_orderstatus", F.round(F.col("o_totalprice") * 100).cast("long"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"), "o_orderpriority",
    )
    digest = hex_to_long(F.substring(F.md5(text), 1, 8))
    both = [
        tables.round_trip(orders, f"{where}/{fmt}", fmt, digest).select(F.lit(fmt).alias("format"), "*")
        for fmt in ("parquet", "csv")
    ]
    return reduce(DataFrame.unionByName, both)


ALL: list[Query] = [
    profile_shape, profile_head, profile_tail, profile_describe, profile_missing, profile_non_null,
    profile_duplicates, profile_value_counts, profile_balance_ratio, profile_distinct_values,
    profile_distinct_counts, profile_ranges, profile_negatives, profile_count_equal,
    profile_class_distribution, profile_compare_distributions, profile_minorities,
    clean_invert_class_map, clean_unknown_labels, clean_encode_label, clean_decode_label, clean_recode,
    clean_audit_ranges, clean_drop_impossible, label_distribution,
    split_stratified, split_imbalanced, split_distribution,
    feature_circular, feature_formulas, encode_fit_one_hot, encode_one_hot, encode_unseen,
    encode_sparse, encode_align_rows, encode_inverse, scale_fit, scale_apply,
    expect_no_missing, expect_together, expect_in_range, expect_row_count,
    explore_histogram, explore_histogram_skewed, explore_skewness, explore_correlations,
    explore_correlations_wide, explore_strong_pairs, explore_box_statistics, explore_box_statistics_items,
    explore_violin, explore_cross_tab, explore_cross_tab_percent, explore_indicator_counts,
    explore_sparse_indicators, explore_sparse_categories, select_ranking, select_by_threshold, select_dropped,
    resample_plan, resample_neighbors, resample_smote, resample_comparison, expect_class_targets,
    knn_classify, knn_on_oversampled, evaluate_confusion, evaluate_accuracy, evaluate_class_report, evaluate_full_report, evaluate_macro,
    evaluate_weighted, evaluate_comparison, evaluate_ranking, evaluate_baselines, expect_metric_floor,
    extra_trees_first_cut, extra_trees_two_levels, train_shallow_tree, train_tree_importances, train_logistic_regression, train_decision_tree, train_random_forest,
    train_extra_trees, train_boosted_trees, train_multinomial_boosting, boosting_first_round, train_stump, train_importances, train_search, model_metrics_table,
    source_round_trip,
]


def queries() -> dict[str, Query]:
    return {q.__name__: q for q in ALL}
