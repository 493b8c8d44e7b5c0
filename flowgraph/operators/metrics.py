"""Errors of a forecast (node_id, t, prediction, target): over all rows, per batch, and as a running loss."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowgraph.functions.scalars import absolute_error, relative_error, squared_error
from flowgraph.operators.ordered import running_sum
from flowgraph.operators.panel import BATCH_STEPS, batch_in_order

# Fixed value: reported losses are per thousand samples.
LOSS_SCALE = 1000.0


def error_columns() -> list[Column]:
    """`n` counts the cells that the averages use, `skipped` those without a target or a prediction."""
    y, p = F.col("target"), F.col("prediction")
    missing = y.isNull() | p.isNull()
    return [
        F.count_if(~missing).alias("n"),
        F.count_if(missing).alias("skipped"),
        F.avg(absolute_error(y, p)).alias("mae"),
        F.avg(relative_error(y, p)).alias("mape"),
        F.sqrt(F.avg(squared_error(y, p))).alias("rmse"),
    ]


def metrics(forecast: DataFrame) -> DataFrame:
    return forecast.agg(*error_columns())


def batch_metrics(forecast: DataFrame, start: int, batch_steps: int = BATCH_STEPS) -> DataFrame:
    """Errors of each batch of consecutive steps."""
    batch = batch_in_order(F.col("t"), start, batch_steps).alias("batch_id")
    return forecast.groupBy(batch).agg(*error_columns())


def mean_batch_metrics(forecast: DataFrame, start: int, batch_steps: int = BATCH_STEPS) -> DataFrame:
    """Unweighted mean of the batch errors; its rmse differs from that of `metrics`."""
    per_batch = batch_metrics(forecast, start, batch_steps)
    return per_batch.agg(F.count("*").alias("batches"), *[F.avg(c).alias(c) for c in ("mae", "mape", "rmse")])


def batch_loss(forecast: DataFrame, batch: Column) -> DataFrame:
    """Mean squared error per batch."""
    return forecast.groupBy(batch.alias("batch_id")).agg(
        F.avg(squared_error(F.col("target"), F.col("prediction"))).alias("mse")
    )


def epoch_loss(losses: DataFrame, n_samples: int) -> DataFrame:
    return losses.agg((F.sum("mse") * F.lit(LOSS_SCALE) / F.lit(float(n_samples))).alias("loss"))


def running_loss(losses: DataFrame, n_samples: int) -> DataFrame:
    """Loss after each batch, in batch order."""
    summed = running_sum(losses, "batch_id", "mse", "_sum")
    return summed.select("batch_id", "mse", (F.col("_sum") * LOSS_SCALE / float(n_samples)).alias("loss"))


def value_bounds(forecast: DataFrame) -> DataFrame:
    """Joint range of prediction and target."""
    return forecast.agg(
        F.min(F.least("prediction", "target")).alias("low"), F.max(F.greatest("prediction", "target")).alias("high")
    )
