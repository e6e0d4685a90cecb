"""Cross-fitted target encoding of zones and zone pairs.

A category's code is its mean price pulled towards the overall mean, the more so the fewer trips it has
and the more they scatter (empirical Bayes shrinkage, Micci-Barreca 2001). A training row's code is
computed from the other folds only, by taking its fold's sums away from the totals.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripflow.operators.features import ENCODED, bucket_of_100
from tripflow.session import settled
from tripflow.settings import Settings

_EXACT = "decimal(38,0)"


def _sums(value: str) -> list[Column]:
    v = F.col(value).cast("decimal(18,0)")
    return [
        F.count(v).alias("n"),
        F.sum(v).cast(_EXACT).alias("s"),
        F.sum((v * v).cast("decimal(28,0)")).cast(_EXACT).alias("q"),
    ]


def category_statistics(rows: DataFrame, keys: Sequence[str], value: str = "quoted_cents") -> DataFrame:
    """Count, mean and population variance per category, from exact sums."""
    return rows.groupBy(*keys).agg(*_sums(value)).select(
        *keys,
        F.col("n").alias("row_count"),
        (F.col("s").cast("double") / F.col("n")).alias("mean_value"),
        _variance(F.col("n"), F.col("s"), F.col("q")).alias("variance_value"),
    )


def _variance(n: Column, s: Column, q: Column) -> Column:
    """Population variance; numerator exact, so a constant category gives exactly zero."""
    return F.try_divide((n.cast("decimal(18,0)") * q - s * s).cast("double"), n.cast("double") * n)


def _code(n: Column, s: Column, q: Column, n0: Column, s0: Column, q0: Column) -> Column:
    """Shrunk mean in currency units; the overall mean where nothing is known about the category."""
    overall = F.try_divide(s0.cast("double"), n0)
    spread = _variance(n0, s0, q0)
    weight = n * spread / (n * spread + _variance(n, s, q))
    shrunk = weight * (s.cast("double") / n) + (1 - weight) * overall
    return F.when((n > 0) & (spread > 0), shrunk).otherwise(overall) / 100


def fold_of(settings: Settings) -> Column:
    return bucket_of_100(settings.seed + 1) % settings.encoding_folds


def fold_sums(rows: DataFrame, settings: Settings) -> DataFrame:
    """Exact sums per fold and combination of encoded features: all that any code needs to know of the rows.

    The rows are read once; codes are derived from this table, which has a row per zone pair and fold at most.
    """
    combined = rows.groupBy(*ENCODED, fold_of(settings).alias("fold")).agg(*_sums("quoted_cents"))
    return settled(combined, "fold-sums")


def _per_category(sums: DataFrame, *fold: str) -> DataFrame:
    """The sums per encoded feature and category, by fold as well where that is named."""
    entries = F.array(
        *(F.struct(F.lit(f).alias("feature"), F.col(f).cast("bigint").alias("category")) for f in ENCODED)
    )
    spread = sums.select("fold", "n", "s", "q", F.explode(entries).alias("e")).select("*", "e.feature", "e.category")
    return spread.groupBy("feature", "category", *fold).agg(
        F.sum("n").alias("n"), *(F.sum(c).cast(_EXACT).alias(c) for c in ("s", "q"))
    )


def fit_encodings(rows: DataFrame, sums: DataFrame | None = None) -> DataFrame:
    """(feature, category, code) from all rows, plus one row per feature with a NULL category: the code
    of an unseen category. `sums` are the rows' `fold_sums`, where they are known already."""
    if sums is None:
        sums = rows.groupBy(*ENCODED).agg(*_sums("quoted_cents")).withColumn("fold", F.lit(0))
    stats = _per_category(sums)
    whole = Window.partitionBy("feature")
    coded = stats.select(
        "feature",
        "category",
        *("n", "s", "q"),
        *(F.sum(c).over(whole).cast(_EXACT).alias(f"{c}0") for c in ("n", "s", "q")),
    )
    c = F.col
    seen = coded.select(
        "feature", "category", _code(c("n"), c("s"), c("q"), c("n0"), c("s0"), c("q0")).alias("code")
    )
    unseen = stats.groupBy("feature").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).select(
        "feature",
        F.lit(None).cast("bigint").alias("category"),
        (c("s").cast("double") / c("n") / 100).alias("code"),
    )
    return seen.unionByName(unseen)


def cross_fitted_codes(rows: DataFrame, settings: Settings, sums: DataFrame | None = None) -> DataFrame:
    """(feature, category, fold, code): the code a training row of that fold gets."""
    per_fold = _per_category(fold_sums(rows, settings) if sums is None else sums, "fold")
    by_category = Window.partitionBy("feature", "category")
    fold_totals = (
        per_fold.groupBy("feature", "fold")
        .agg(*(F.sum(c).cast(_EXACT).alias(f"{c}_fold") for c in ("n", "s", "q")))
        .select("*", *(
            F.sum(f"{c}_fold").over(Window.partitionBy("feature")).cast(_EXACT).alias(f"{c}_all")
            for c in ("n", "s", "q")
        ))
        .select("feature", "fold", *(
            (F.col(f"{c}_all") - F.col(f"{c}_fold")).alias(f"{c}0") for c in ("n", "s", "q")
        ))
    )
    rest = per_fold.select(
        "feature",
        "category",
        "fold",
        *((F.sum(c).over(by_category) - F.col(c)).cast(_EXACT).alias(c) for c in ("n", "s", "q")),
    )
    c = F.col
    return rest.join(fold_totals, ["feature", "fold"]).select(
        "feature",
        "category",
        "fold",
        _code(c("n"), c("s"), c("q"), c("n0"), c("s0"), c("q0")).alias("code"),
    )


def encode_training(rows: DataFrame, codes: DataFrame, settings: Settings) -> DataFrame:
    """`<feature>_code` for each encoded feature of the training rows."""
    # One join per feature reads the codes.
    out, codes = rows.withColumn("_fold", fold_of(settings)), settled(codes, "fold-codes")
    for name in ENCODED:
        table = codes.where(F.col("feature") == name).select(
            F.col("category").alias("_category"), F.col("fold").alias("_f"), F.col("code").alias(f"{name}_code")
        )
        match = (F.col(name).cast("bigint") == F.col("_category")) & (F.col("_fold") == F.col("_f"))
        out = out.join(table, match, "left").drop("_category", "_f")
    return out.drop("_fold")


def encode(rows: DataFrame, encodings: DataFrame) -> DataFrame:
    """`<feature>_code` for rows the encoding was not fitted on; unseen categories get the overall mean."""
    out = rows
    for name in ENCODED:
        own = encodings.where(F.col("feature") == name)
        fallback = own.where(F.col("category").isNull()).select("code").scalar()
        table = own.where(F.col("category").isNotNull()).select(
            F.col("category").alias("_category"), F.col("code").alias("_code")
        )
        out = (
            out.join(table, F.col(name).cast("bigint") == F.col("_category"), "left")
            .withColumn(f"{name}_code", F.coalesce(F.col("_code"), fallback))
            .drop("_category", "_code")
        )
    return out
