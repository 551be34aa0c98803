"""One full-batch logistic gradient step."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def weights_sql(weights) -> str:
    """ARRAY<DOUBLE> SQL literal of the weights (exact round-trip text)."""
    values = [float(x) for x in weights]
    if not values:
        return "CAST(array() AS ARRAY<DOUBLE>)"
    return "CAST(split('" + ",".join(repr(v) for v in values) + "', ',') AS ARRAY<DOUBLE>)"


def step_sql(weights, alpha: float, label: str = "label") -> str:
    """SQL for one row's (y - p) * alpha under ``weights``."""
    score = f"aggregate(fids, CAST(0 AS DOUBLE), (acc, f) -> acc + element_at({weights_sql(weights)}, f + 1))"
    return (f"((CASE WHEN `{label}` > 0 THEN 1.0D ELSE 0.0D END) - 1.0D / (1.0D + exp(-({score})))) "
            f"* CAST({float(alpha)!r} AS DOUBLE)")


def gradient(feats: DataFrame, weights, alpha: float, label: str = "label") -> DataFrame:
    """(fid, delta): sum over occurrences of (y - p) * alpha.

    ``feats`` holds labelled rows with ``fids``; ``weights`` is the current
    weight vector (one per feature id). The row score is a fold over the id
    list, p the logistic of it, y = 1 for label 1 else 0. The shuffle is keyed
    by ``fid`` after map-side partial sums: at most m rows per task, whatever
    the data size or skew.
    """
    # Score once per sentence, below the explode (not once per occurrence).
    per_row = feats.selectExpr("fids", f"{step_sql(weights, alpha, label)} AS _g")
    return (per_row.selectExpr("explode(fids) AS fid", "_g")
            .groupBy("fid").agg(F.sum("_g").alias("delta")))


def gradient_from_view(spark: SparkSession, view: str, weights, alpha: float,
                       label: str = "label") -> DataFrame:
    """:func:`gradient` over a registered view, as one SQL statement.

    A training loop re-plans every epoch; one statement keeps that to a
    single parse and analysis.
    """
    return spark.sql(
        f"SELECT fid, sum(_g) AS delta FROM ("
        f"SELECT explode(fids) AS fid, _g FROM ("
        f"SELECT fids, {step_sql(weights, alpha, label)} AS _g FROM {view})) GROUP BY fid")


def gradient_norm(delta: DataFrame) -> DataFrame:
    """One row: l1 = sum |delta| (0 when there are no features)."""
    return delta.agg(F.coalesce(F.sum(F.abs("delta")), F.lit(0.0)).alias("l1"))
