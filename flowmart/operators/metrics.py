"""Scores of (score, label) rows with an optional row weight."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from flowmart.operators.prefix import running_totals


def rank_metrics(df: DataFrame, score: str, label: str, weight: str | None = None) -> DataFrame:
    """Exact ROC-AUC (M8) and average precision (M9) in one row.

    Rows with equal scores are grouped first, so ties count half and the ordered
    part sees distinct scores only.
    """
    rows = F.lit(1) if weight is None else F.col(weight)
    positive = F.col(label).cast("boolean")
    by_score = df.groupBy(F.col(score).alias("score")).agg(
        F.coalesce(F.sum(F.when(positive, rows)), F.lit(0)).cast("bigint").alias("pos"),
        F.coalesce(F.sum(F.when(~positive, rows)), F.lit(0)).cast("bigint").alias("neg"),
    )
    ranked = running_totals(by_score, "score", ["pos", "neg"])
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    all_pos, all_neg = F.col("pos_all").cast("double"), F.col("neg_all").cast("double")
    hits = all_pos - F.col("pos_before")
    alarms = all_neg - F.col("neg_before")
    wins = pos * (F.col("neg_before") + neg / 2)
    gain = pos * F.try_divide(hits, hits + alarms)
    return ranked.agg(
        F.try_divide(F.sum(wins), F.max(all_pos) * F.max(all_neg)).alias("roc_auc"),
        F.try_divide(F.sum(gain), F.max(all_pos)).alias("average_precision"),
        F.max("pos_all").alias("positives"),
        (F.max("pos_all") + F.max("neg_all")).alias("n_rows"),
    )


def weighted_mean(value: Column, weight: Column) -> Column:
    """Aggregate mean of the set values over `weight` rows each; null on no rows."""
    return F.try_divide(F.sum(value * weight), F.sum(F.when(value.isNotNull(), weight)))


def brier(probability: Column, label: Column, weight: Column) -> Column:
    """Mean squared error of a probability."""
    miss = probability - label.cast("double")
    return weighted_mean(miss * miss, weight)


def mean_absolute_error(prediction: Column, actual: Column, weight: Column) -> Column:
    """M11."""
    return weighted_mean(F.abs(prediction - actual), weight)


def improvement_pct(model: Column, baseline: Column) -> Column:
    """Error removed relative to the baseline, in percent."""
    return F.try_divide(baseline - model, baseline) * 100
