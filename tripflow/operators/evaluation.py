"""How good the quotes were."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.functions.errors import error_pct
from tripflow.functions.money import cents, mean_of
from tripflow.functions.order_stats import exact_median
from tripflow.schemas import AVERAGE, ERROR

# Per-row relative errors are summed as decimals of 12 places: the sum does not depend on row order.
_SHARE = "decimal(20,12)"


def error_sums() -> list[Column]:
    predicted, actual = F.col("predicted_amount"), F.col("actual_amount")
    error = (predicted - actual).cast("decimal(11,2)")
    relative = F.when(actual != 0, (F.abs(error) / F.abs(actual)).cast(_SHARE))
    return [
        F.count(F.lit(1)).alias("n"),
        F.sum(F.abs(error)).alias("abs_error"),
        F.sum((error * error).cast("decimal(22,4)")).alias("sq_error"),
        F.sum(relative).alias("rel_error"),
        F.count(relative).alias("rel_n"),
        F.sum(actual).alias("actual"),
        F.sum((actual * actual).cast("decimal(20,4)")).alias("sq_actual"),
        F.sum(predicted).alias("predicted"),
    ]


def r_squared() -> Column:
    """1 - SSE/SST, NULL where a group has fewer than two rows or no variance to explain.

    n * SST is an exact decimal, so a constant group gives exactly zero.
    """
    n = F.col("n").cast("decimal(12,0)")
    n_sst = n * F.col("sq_actual").cast("decimal(26,4)") - (
        F.col("actual").cast("decimal(18,2)") * F.col("actual").cast("decimal(18,2)")
    )
    sse = F.col("sq_error").cast("double")
    return F.when((F.col("n") > 1) & (n_sst > 0), 1 - sse * F.col("n") / n_sst.cast("double"))


def rmse() -> Column:
    return F.sqrt(F.col("sq_error").cast("double") / F.col("n"))


def evaluate_daily(predictions: DataFrame) -> DataFrame:
    """Error metrics per event-time day and model version."""
    n = F.col("n")
    return (
        predictions.groupBy(F.to_date("pickup_datetime").alias("eval_date"), "model_version")
        .agg(*error_sums())
        .select(
            "eval_date",
            "model_version",
            n.alias("predictions"),
            mean_of(F.col("abs_error"), n, ERROR).alias("mae"),
            rmse().cast(ERROR).alias("rmse"),
            mean_of(F.col("rel_error") * 100, F.col("rel_n"), ERROR).alias("mape"),
            F.round(r_squared(), 6).alias("r2"),
            mean_of(F.col("actual"), n, AVERAGE).alias("mean_actual"),
            mean_of(F.col("predicted"), n, AVERAGE).alias("mean_predicted"),
        )
    )


def regression_report(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """MAE, RMSE and R2 of a scored frame in one pass."""
    n = F.col("n")
    return scored.groupBy(*by).agg(*error_sums()).select(
        *by,
        n.alias("row_count"),
        mean_of(F.col("abs_error"), n, ERROR).alias("mae"),
        rmse().cast(ERROR).alias("rmse"),
        F.round(r_squared(), 6).alias("r2"),
    )


def improvement_pct(report: DataFrame, name: str, baseline: str, model: str) -> DataFrame:
    """By how many percent the model's MAE undercuts the baseline's."""
    mae_of = lambda who: F.max(F.when(F.col(name) == who, F.col("mae")))
    return report.agg(mae_of(baseline).alias("baseline_mae"), mae_of(model).alias("model_mae")).select(
        "baseline_mae",
        "model_mae",
        F.when(
            F.col("baseline_mae") != 0,
            (100 * (F.col("baseline_mae") - F.col("model_mae")) / F.col("baseline_mae")).cast("decimal(10,2)"),
        ).alias("improvement_pct"),
    )


def compare_models(evaluation: DataFrame, old: str, new: str) -> DataFrame:
    """Days both versions were evaluated on: both errors, the change, and who won."""
    mae_of = lambda who: F.max(F.when(F.col("model_version") == who, F.col("mae")))
    return (
        evaluation.where(F.col("model_version").isin(old, new))
        .groupBy("eval_date")
        .agg(mae_of(old).alias("old_mae"), mae_of(new).alias("new_mae"))
        .where("old_mae is not null and new_mae is not null")
        .select(
            "eval_date",
            "old_mae",
            "new_mae",
            F.when(
                F.col("old_mae") != 0,
                (100 * (F.col("new_mae") - F.col("old_mae")) / F.col("old_mae")).cast("decimal(12,2)"),
            ).alias("change_pct"),
            (F.col("new_mae") < F.col("old_mae")).alias("new_wins"),
        )
    )


def accuracy_shares(predictions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Share of quotes within 10 % and within 25 % of the price, and the median absolute error."""
    pct = F.abs(error_pct(F.col("predicted_amount"), F.col("actual_amount")))
    share = lambda limit: F.round(100 * F.count_if(pct < limit) / F.count(F.lit(1)), 4)
    shares = predictions.groupBy(*by).agg(
        F.count(F.lit(1)).alias("quotes"), share(10).alias("within_10_pct"), share(25).alias("within_25_pct")
    )
    sized = predictions.select(
        *by, cents(F.abs(F.col("predicted_amount") - F.col("actual_amount"))).alias("_cents")
    )
    medians = exact_median(sized, "_cents", by, "_m").withColumn(
        "median_abs_error", F.col("_m") / 100
    ).drop("_m")
    if by:
        return shares.join(medians, list(by))
    return shares.select("*", medians.select("median_abs_error").scalar().alias("median_abs_error"))
