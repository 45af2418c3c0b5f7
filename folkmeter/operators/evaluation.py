"""Training-row cleaning and evaluation of predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folkmeter.functions import scalars as S
from folkmeter.operators.cleaning import active, non_negative
from folkmeter.operators.quantiles import cap_at_quantile, quantile_row
from folkmeter.operators.relational import top_rows

ACTUAL, PREDICTED = "karma", "karma_predicted"


def clean_training(
    features: DataFrame, target: str = ACTUAL, prob: float = 0.99, method: str = "nearest"
) -> DataFrame:
    """Drop negative targets, inactive users and the top percent; add the log target."""
    kept = cap_at_quantile(active(non_negative(features, target)), target, prob, method)
    return kept.withColumn(f"log_{target}", S.log_target(F.col(target)))


def log_target_stats(cleaned: DataFrame, column: str = "log_karma") -> DataFrame:
    middle = quantile_row(cleaned, column, {"median": 0.5}, "linear").scalar()
    plain = cleaned.agg(
        F.avg(column).alias("mean"), F.stddev_samp(column).alias("std"), F.max(column).alias("max")
    )
    return plain.select("mean", middle.alias("median"), "std", "max")


def metric_columns(actual: Column, predicted: Column) -> dict[str, Column]:
    """MAE, RMSE and R2 as aggregates of one pass; R2 is 0 for a constant target."""
    error = actual - predicted
    total = F.var_pop(actual) * F.count(actual)
    explained = 1.0 - F.try_divide(F.sum(error * error), total)
    return {
        "mae": F.avg(F.abs(error)),
        "rmse": F.sqrt(F.avg(error * error)),
        "r2": F.when(total > 0, explained).otherwise(F.lit(0.0)),
    }


def _aggregate(df: DataFrame, metrics: dict[str, Column]) -> DataFrame:
    return df.agg(*[c.alias(n) for n, c in metrics.items()])


def _points(column: str) -> Column:
    return F.col(column).cast("double")


def metrics_raw(predictions: DataFrame) -> DataFrame:
    return _aggregate(predictions, metric_columns(_points(ACTUAL), _points(PREDICTED)))


def metrics_log(predictions: DataFrame) -> DataFrame:
    actual, predicted = S.log_target(F.col(ACTUAL)), S.log_target(F.col(PREDICTED))
    return _aggregate(predictions, metric_columns(actual, predicted))


def metrics_back_transformed(
    scored: DataFrame, log_actual: str = "log_karma", log_predicted: str = "prediction"
) -> DataFrame:
    """Errors in points of a model that was fitted on log scale, with the median error."""
    points = scored.select(
        F.expm1(log_actual).alias("_a"), S.back_transform(F.col(log_predicted)).alias("_p")
    ).withColumn("_e", F.abs(F.col("_a") - F.col("_p")))
    middle = quantile_row(points, "_e", {"medae": 0.5}, "linear").scalar()
    plain = _aggregate(points, metric_columns(F.col("_a"), F.col("_p")))
    return plain.select("mae", "rmse", middle.alias("medae"), "r2")


def residuals(predictions: DataFrame) -> DataFrame:
    """Actual and predicted values on both scales with the residual of each row."""
    log_actual, log_predicted = S.log_target(F.col(ACTUAL)), S.log_target(F.col(PREDICTED))
    return predictions.withColumns(
        {
            "log_actual": log_actual,
            "log_predicted": log_predicted,
            "residual": _points(ACTUAL) - _points(PREDICTED),
            "log_residual": log_actual - log_predicted,
        }
    )


def residual_stats(predictions: DataFrame) -> DataFrame:
    error = S.log_target(F.col(ACTUAL)) - S.log_target(F.col(PREDICTED))
    return predictions.agg(
        F.avg(error).alias("mean_residual"),
        F.stddev_samp(error).alias("std_residual"),
        F.min(error).alias("min_residual"),
        F.max(error).alias("max_residual"),
        F.avg(F.abs(error)).alias("mean_abs_residual"),
    )


def quartile_report(predictions: DataFrame, method: str = "nearest") -> DataFrame:
    """Errors per target quartile, with a row of its own for a zero target.

    ``approx`` cuts by the mergeable sketch; the other methods cut exactly.
    """
    named = {"q25": 0.25, "q50": 0.5, "q75": 0.75}
    row = quantile_row(predictions, ACTUAL, named, method)
    cut = row.select(F.struct(*named).alias("q")).scalar()
    actual, predicted = _points(ACTUAL), _points(PREDICTED)
    label = (
        F.when(actual == 0, "Q0 (zero)")
        .when(actual <= cut["q25"], "Q1")
        .when(actual <= cut["q50"], "Q2")
        .when(actual <= cut["q75"], "Q3")
        .otherwise("Q4 (top)")
    )
    return (
        predictions.withColumn("karma_quartile", label)
        .groupBy("karma_quartile")
        .agg(
            F.count("*").alias("count"),
            F.avg(actual).alias("avg_actual"),
            F.avg(predicted).alias("avg_predicted"),
            F.avg(F.abs(actual - predicted)).alias("avg_error"),
        )
        .orderBy("karma_quartile")
    )


def top_predictions(predictions: DataFrame, limit: int = 15) -> DataFrame:
    return top_rows(predictions, ACTUAL, "name", limit, ["name", ACTUAL, PREDICTED])


def compare_models(
    scored: DataFrame, base: str, optimized: str, actual: str = "actual", predicted: str = "predicted"
) -> DataFrame:
    """Rows (metric, base, optimized, improvement_pct) from a table (model, actual, predicted).

    Errors improve downwards, R2 upwards; a zero base gives no percentage.
    """
    measured = (
        scored.filter(F.col("model").isin(base, optimized))
        .groupBy("model")
        .agg(*[c.alias(n) for n, c in metric_columns(F.col(actual), F.col(predicted)).items()])
    )
    lines = [
        F.struct(F.lit(n).alias("metric"), F.round(n, 4).alias("value"))
        for n in ("mae", "rmse", "r2")
    ]
    long = measured.select("model", F.inline(F.array(*lines)))
    wide = long.groupBy("metric").agg(
        F.max(F.when(F.col("model") == base, F.col("value"))).alias("base"),
        F.max(F.when(F.col("model") == optimized, F.col("value"))).alias("optimized"),
    )
    gain = F.when(
        F.col("metric") == "r2", F.col("optimized") - F.col("base")
    ).otherwise(F.col("base") - F.col("optimized"))
    percent = F.round(F.try_divide(gain, F.abs("base")) * 100, 2)
    return wide.withColumn("improvement_pct", percent)


def evaluation_report(predictions: DataFrame, method: str = "approx") -> dict[str, DataFrame]:
    """The whole evaluation: both scales, residuals, quartiles."""
    return {
        "total_predictions": predictions.agg(F.count("*").alias("total_predictions")),
        "log_scale": metrics_log(predictions),
        "karma_scale": metrics_raw(predictions),
        "residual_stats": residual_stats(predictions),
        "quartile_analysis": quartile_report(predictions, method),
    }


def line_predictions(users: DataFrame, x: str = "followers") -> DataFrame:
    """Deterministic prediction column: the least-squares line of the target on ``x``."""
    rows = non_negative(users)
    fit = rows.agg(
        F.struct(
            F.regr_slope(ACTUAL, x).alias("slope"), F.regr_intercept(ACTUAL, x).alias("intercept")
        ).alias("f")
    ).scalar()
    predicted = F.greatest(fit["intercept"] + fit["slope"] * F.col(x), F.lit(0.0))
    return rows.withColumn(PREDICTED, predicted)
