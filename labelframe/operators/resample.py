"""Synthetic minority oversampling (Chawla et al., JAIR 2002)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelframe.functions.checkpoints import materialize
from labelframe.functions.hashing import draw_hex, draw_int, draw_unit
from labelframe.functions.reshape import quoted, vector
from labelframe.functions.small import large, local_table, settle
from labelframe.operators.neighbors import nearest

LEVEL = 2


def oversampling_plan(df: DataFrame, label: str, targets: Mapping) -> DataFrame:
    """Rows ``(class, n, target, to_add)``; classes without a target stay as they are."""
    kind = df.schema[label].dataType.simpleString()
    goal = local_table(df.sparkSession, [(c, int(t)) for c, t in targets.items()], f"class {kind}, goal long")
    counts = df.groupBy(F.col(label).alias("class")).agg(F.count("*").alias("n"))
    target = F.coalesce(F.col("goal"), F.col("n"))
    return counts.join(F.broadcast(goal), "class", "left").select(
        "class", "n", target.alias("target"), (target - F.col("n")).alias("to_add")
    )


def number_rows(df: DataFrame, label: str, row_id: str, seed: int, purpose: str, digits: int = 3) -> DataFrame:
    """Number the rows of each class 0..n-1 in the order of their digests.

    Rows are ranked inside buckets of the first hex digits of the digest and moved up
    by the size of the buckets before.  That size is summed along the tree of digits,
    ``LEVEL`` of them at a time: what comes before a bucket are, on each level, the lesser
    children of its ancestor.  So no window holds more than 16^LEVEL buckets or the rows
    of one bucket, whatever the size of a class.
    """
    h = draw_hex(seed, purpose, F.col(row_id))
    hashed = df.withColumn("_h", h).withColumn("_b", F.substring("_h", 1, digits))
    sizes = df.select(F.col(label).alias("_c"), F.substring(h, 1, digits).alias("_b"))
    sizes = sizes.groupBy("_c", "_b").agg(F.count("*").alias("_n"))
    starts = sizes.select("_c", "_b", F.lit(0).cast("long").alias("_start"))
    for level in range(0, digits, LEVEL):
        up, down = F.substring("_b", 1, level), F.substring("_b", 1, min(digits, level + LEVEL))
        summed = sizes.groupBy(F.col("_c").alias("_k"), up.alias("_up"), down.alias("_down")).agg(F.sum("_n").alias("_n"))
        before = Window.partitionBy("_k", "_up").orderBy("_down").rowsBetween(Window.unboundedPreceding, -1)
        below = summed.select("_k", "_down", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_more"))
        same = F.col("_c").eqNullSafe(F.col("_k")) & (F.substring("_b", 1, min(digits, level + LEVEL)) == F.col("_down"))
        starts = starts.join(below, same).select("_c", "_b", (F.col("_start") + F.col("_more")).alias("_start"))
    starts = settle(starts)
    inner = F.row_number().over(Window.partitionBy(label, "_b").orderBy("_h", row_id))
    ranked = hashed.withColumn("_rank", inner)
    same = (ranked[label] == starts["_c"]) & (ranked["_b"] == starts["_b"])
    return ranked.join(starts, same).select(
        *[ranked[c] for c in df.columns], (F.col("_start") + F.col("_rank") - 1).alias("idx")
    )


def bucket_digits(largest: int, rows_per_bucket: int = 50_000) -> int:
    """Hex digits that cut a class of ``largest`` rows into buckets one task can sort."""
    digits = 2
    while 16**digits * rows_per_bucket < largest and digits < 8:
        digits += 1
    return digits


def synthetic_rows(
    df: DataFrame, row_id: str, label: str, features: Sequence[str], targets: Mapping, k: int = 5, seed: int = 42
) -> DataFrame:
    """The new rows only: ``(row_id, label, features..., base_id, synthetic_no)``.

    Draw j of a class picks a row, one of its k neighbours in the class and a gap g in
    [0, 1); the new row is x + g (neighbour - x).  ``base_id`` is the id of the row x.
    ``row_id`` is new and unique: ids count on from the greatest one, and text ids
    have the greatest one as their beginning.
    """
    spark = df.sparkSession
    kind = df.schema[label].dataType.simpleString()
    plan = {r["class"]: r for r in oversampling_plan(df, label, targets).where(F.col("class").isin(list(targets))).collect()}
    for c, target in targets.items():
        if c not in plan:
            raise ValueError(f"class {c!r} has no rows")
        if target < plan[c]["n"]:
            raise ValueError(f"class {c!r} has {plan[c]['n']} rows, more than its target {target}")
        if target > plan[c]["n"] and plan[c]["n"] < k + 1:
            raise ValueError(f"class {c!r} has {plan[c]['n']} rows; {k} neighbours need {k + 1}")
    grown = sorted((c for c in targets if plan[c]["to_add"] > 0), key=str)
    minority = df.where(F.col(label).isin(grown)).select(row_id, label, vector(list(features)).alias("_vec"))
    moved = [f"_new[{i}] AS {quoted(f)}" for i, f in enumerate(features)]
    if not grown:
        none = minority.limit(0).withColumn("_new", F.col("_vec"))
        return none.selectExpr(
            quoted(row_id), quoted(label), *moved, f"{quoted(row_id)} AS base_id", "CAST(0 AS BIGINT) AS synthetic_no"
        )

    starts, total = [], 0
    for c in grown:
        starts.append(total)
        total += plan[c]["to_add"]
    # draw numbers are spread over the cluster; each finds its class by its position
    which = F.size(F.filter(F.array(*[F.lit(s).cast("long") for s in starts]), lambda s: s <= F.col("id")))

    def pick(values, kind):
        return F.element_at(F.array(*[F.lit(v).cast(kind) for v in values]), F.col("_which"))

    id_type = df.schema[row_id].dataType
    greatest = df.agg(F.max(row_id)).first()[0]
    if isinstance(id_type, T.IntegralType):
        new_id = (F.lit(greatest).cast("long") + 1 + F.col("id")).cast(id_type)
    elif isinstance(id_type, T.StringType):
        new_id = F.concat(F.lit(greatest), F.lit("~"), F.col("id").cast("string"))
    else:
        raise ValueError(f"{row_id} is {id_type.simpleString()}; new rows need an integer or text id")
    draws = spark.range(total).withColumn("_which", which).select(
        new_id.alias("_new_id"),
        pick(grown, kind).alias("_class"),
        (F.col("id") - pick(starts, "long")).alias("synthetic_no"),
        pick([plan[c]["n"] for c in grown], "long").alias("_n"),
    )
    key = [F.col("_class"), F.col("synthetic_no")]
    draws = draws.select(
        "_new_id",
        "_class",
        "synthetic_no",
        F.pmod(draw_int(seed, "smote-row", *key), F.col("_n")).alias("_idx"),
        (F.pmod(draw_int(seed, "smote-neighbour", *key), F.lit(k)) + 1).cast("int").alias("_rank"),
        draw_unit(seed, "smote-gap", *key).alias("_gap"),
    )
    digits = bucket_digits(max(plan[c]["n"] for c in grown))
    numbered = number_rows(minority.select(row_id, label), label, row_id, seed, "smote-order", digits)
    drawn = materialize(
        draws.join(large(numbered), (F.col("_class") == F.col(label)) & (F.col("_idx") == F.col("idx"))).select(
            F.col(row_id).alias("_base"), "_new_id", "synthetic_no", "_rank", "_gap"
        )
    )
    asked = minority.join(large(drawn.select(F.col("_base").alias(row_id)).distinct()), row_id, "left_semi")
    found = nearest(asked, minority, row_id, "_vec", k=k, group=label, exclude_self=True, seed=seed)
    found = found.select(F.col("id").alias("_id"), F.col("rank").alias("_r"), "neighbour")
    other = minority.select(F.col(row_id).alias("_other"), F.col("_vec").alias("_to"))
    made = (
        drawn.join(large(found), (F.col("_base") == F.col("_id")) & (F.col("_rank") == F.col("_r")))
        .join(large(minority), F.col("_base") == F.col(row_id))
        .join(large(other), F.col("neighbour") == F.col("_other"))
        .withColumn("_new", F.expr("zip_with(_vec, _to, (a, b) -> a + _gap * (b - a))"))
    )
    return made.selectExpr(f"_new_id AS {quoted(row_id)}", quoted(label), *moved, "_base AS base_id", "synthetic_no")


def append_synthetic(df: DataFrame, new_rows: DataFrame, row_id: str, label: str, features: Sequence[str]) -> DataFrame:
    """Real and synthetic rows together, told apart by ``is_synthetic``; a real row is its own base."""
    values = [f"CAST({quoted(f)} AS DOUBLE) AS {quoted(f)}" for f in features]
    real = df.selectExpr(
        quoted(row_id), quoted(label), *values, f"{quoted(row_id)} AS base_id",
        "CAST(NULL AS BIGINT) AS synthetic_no", "false AS is_synthetic",
    )
    return real.unionByName(new_rows.withColumn("is_synthetic", F.lit(True)))


def smote(
    df: DataFrame, row_id: str, label: str, features: Sequence[str], targets: Mapping, k: int = 5, seed: int = 42
) -> DataFrame:
    """The table with each class of ``targets`` raised to its target count."""
    new_rows = synthetic_rows(df, row_id, label, features, targets, k, seed)
    return append_synthetic(df, new_rows, row_id, label, features)
