"""Expected border delay: hurdle model, lookup baseline and their scores.

Every feature is a function of (crossing, hour, weekday, month), so readings
are counted per cell and minute value once. Training, prediction and all
metrics work on those counts with row weights; the archive is read a single
time however large it is.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce
from math import pi

from pyspark import inheritable_thread_target
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import Column, DataFrame, functions as F

from flowmart.functions.delay import is_measured
from flowmart.functions.timez import is_weekend
from flowmart.operators.lookup import fallback_means
from flowmart.operators.metrics import (
    brier,
    improvement_pct,
    mean_absolute_error,
    rank_metrics,
    weighted_mean,
)
from flowmart.operators.prefix import dense_codes
from flowmart.session import pin, shared_dir

CELL = ["crossing_name", "hour_of_day", "day_of_week", "month_of_year"]
FEATURES = [
    "crossing_code",
    "hour_of_day",
    "day_of_week",
    "month_of_year",
    "is_weekend",
    "hour_sin",
    "hour_cos",
    "month_sin",
    "month_cos",
]

# Split years, training settings and gates.
TRAIN_MAX_YEAR = 2018
TEST_YEAR = 2019
ROUNDS = 400
DEPTH = 6
RATE = 0.08
SAMPLING = 0.9
SEED = 42
GRID_MONTH = 7
MIN_LIVE_ROWS = 50
# Rows of one training task, and boosting rounds between two checkpoints.
TRAINING_PARTITION_BYTES = 32 << 20
CHECKPOINT_ROUNDS = 25
LIVE = "live_2026"


class EmptySplit(RuntimeError):
    """One side of the temporal split has no rows."""


def delay_cells(waits: DataFrame) -> DataFrame:
    """Measured commercial Canada-bound readings counted per cell and minutes.

    Keeps the local year where the rows have one. The count combines map-side,
    so a crossing holding most readings is no heavier than the rest.
    """
    lanes = waits.where(
        (F.col("traffic_type") == "commercial")
        & (F.col("direction") == "canada")
        & is_measured(F.col("delay_status"), F.col("delay_minutes"))
    )
    keys = [
        F.col("crossing_name"),
        F.col("local_hour_pt").alias("hour_of_day"),
        F.col("local_dow_pt").alias("day_of_week"),
        F.col("local_month_pt").alias("month_of_year"),
        F.col("delay_minutes"),
    ]
    if "local_year_pt" in waits.columns:
        keys.append(F.col("local_year_pt").alias("year"))
    return lanes.groupBy(*keys).agg(F.count("*").alias("n"))


def temporal_split(
    cells: DataFrame, train_max_year: int = TRAIN_MAX_YEAR, test_year: int = TEST_YEAR
) -> tuple[DataFrame, DataFrame]:
    """Cells up to the last training year, and cells of the test year (M2)."""
    return (
        cells.where(F.col("year") <= train_max_year),
        cells.where(F.col("year") == test_year),
    )


def with_side(
    cells: DataFrame, train_max_year: int = TRAIN_MAX_YEAR, test_year: int = TEST_YEAR
) -> DataFrame:
    """Cells of both sides of the split with `side`, train or test; one read for both.

    Pass pinned cells: else the filter on the year goes below the count of the
    cells and everything the year is made of is computed a second time.
    """
    side = F.when(F.col("year") <= train_max_year, "train").when(F.col("year") == test_year, "test")
    return cells.withColumn("side", side).where(F.col("side").isNotNull())


def by_side(cells: DataFrame, *measures: Column) -> DataFrame:
    """Measures of each side; a side without cells has its row too."""
    sides = cells.sparkSession.sql("select explode(array('train', 'test')) as side, 0L as n")
    return cells.unionByName(sides, allowMissingColumns=True).groupBy("side").agg(*measures)


def holdout_name(test_year: int = TEST_YEAR) -> str:
    """Name of the evaluation on the rows of one year."""
    return f"holdout_{test_year}"


def hurdle_minutes(probability: Column, log_minutes: Column) -> Column:
    """Expected delay: the chance of one times its length, which is never negative (M6)."""
    return probability * F.greatest(F.expm1(log_minutes), F.lit(0.0))


def require_rows(**sides: DataFrame) -> None:
    """Raise if a side of the split is empty (Q8)."""
    empty = [name for name, side in sides.items() if side.isEmpty()]
    if empty:
        raise EmptySplit(", ".join(empty))


def crossing_codes(train: DataFrame) -> DataFrame:
    """Alphabetical position of each training crossing (M3)."""
    return pin(dense_codes(train, "crossing_name", "crossing_code"), "codes")


def with_features(df: DataFrame, codes: DataFrame) -> DataFrame:
    """Add the feature columns to rows with the cell columns.

    A crossing without a code gets -1.
    """
    turn = F.col("hour_of_day") * F.lit(2 * pi) / 24
    year = F.col("month_of_year") * F.lit(2 * pi) / 12
    return df.join(codes, "crossing_name", "left").withColumns(
        {
            "crossing_code": F.coalesce("crossing_code", F.lit(-1)),
            "is_weekend": is_weekend(F.col("day_of_week")).cast("int"),
            "hour_sin": F.sin(turn),
            "hour_cos": F.cos(turn),
            "month_sin": F.sin(year),
            "month_cos": F.cos(year),
        }
    )


def lookup_scores(
    train: DataFrame,
    targets: DataFrame,
    minutes: str | None = "baseline",
    probability: str | None = "probability",
) -> DataFrame:
    """Historical mean delay and share of delayed readings for the cell of each
    target row, under the given names (M7); None leaves a column out."""
    delayed = F.when(F.col("delay_minutes") > 0, F.col("n")).otherwise(0)
    sums = pin(
        train.groupBy(*CELL).agg(
            F.sum(F.col("delay_minutes") * F.col("n")).alias("_minutes"),
            F.sum(delayed).alias("_delayed"),
            F.sum("n").alias("n"),
        ),
        "sums",
    )
    wanted = {minutes: "_minutes", probability: "_delayed"}
    totals = {name: total for name, total in wanted.items() if name}
    return fallback_means(sums, targets, CELL, totals, "n")


def lookup_baseline(train: DataFrame, targets: DataFrame) -> DataFrame:
    """Add `baseline`, the historical mean delay (M7)."""
    return lookup_scores(train, targets, probability=None)


@dataclass(frozen=True)
class HurdleModel:
    """P(delay > 0) and the length of a delay, with the crossing codes."""

    classifier: GBTClassificationModel
    regressor: GBTRegressionModel
    codes: DataFrame

    def predict(self, df: DataFrame) -> DataFrame:
        """Add `delay_probability` and `expected_delay_minutes` (M6).

        Predicts once per distinct cell, then joins back.
        """
        cells = _assemble(with_features(df.select(*CELL).distinct(), self.codes))
        staged = self.classifier.transform(cells).drop("rawPrediction", "prediction")
        scored = self.regressor.transform(staged)
        probability = vector_to_array("probability")[1]
        predictions = pin(
            scored.select(
                *CELL,
                probability.alias("delay_probability"),
                hurdle_minutes(probability, F.col("log_delay")).alias("expected_delay_minutes"),
            ),
            "predictions",
        )
        return df.join(predictions, CELL, "left")


def _assemble(df: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(df)


def training_cells(train: DataFrame, codes: DataFrame) -> DataFrame:
    """One row per cell with all that boosting needs to know of its readings.

    `clear` and `delayed` count readings, `log_minutes` is the mean over delayed ones. Readings
    of a cell have equal features, so no split parts them: with the cell's weight, its mean has
    the gradient, the gain of each split and the leaf values of the single readings.
    """
    late = F.col("delay_minutes") > 0
    logs = F.when(late, F.log1p("delay_minutes") * F.col("n"))
    cells = train.groupBy(*CELL).agg(
        F.coalesce(F.sum(F.when(~late, F.col("n"))), F.lit(0)).cast("double").alias("clear"),
        F.coalesce(F.sum(F.when(late, F.col("n"))), F.lit(0)).cast("double").alias("delayed"),
        F.sum(logs).alias("_logs"),
    )
    cells = cells.withColumn("log_minutes", F.col("_logs") / F.nullif("delayed", F.lit(0.0)))
    return _assemble(with_features(cells, codes)).select("features", "clear", "delayed", "log_minutes")


def stage_rows(cells: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Weighted rows of both stages: two labels a cell, and the cell's mean."""
    label = F.explode(
        F.array(
            F.struct(F.lit(0.0).alias("delayed"), F.col("clear").alias("weight")),
            F.struct(F.lit(1.0).alias("delayed"), F.col("delayed").alias("weight")),
        )
    ).alias("one")
    labelled = cells.select("features", label).select("features", "one.*").where("weight > 0")
    means = cells.where("delayed > 0").select("features", "log_minutes", F.col("delayed").alias("weight"))
    return labelled, means


def _packed(rows: DataFrame, label: str) -> DataFrame:
    """Rows in as few partitions as their bytes need: each tree level is a job over all of them."""
    pinned = pin(rows, label)
    size = int(str(pinned._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return pinned.coalesce(max(1, -(-size // TRAINING_PARTITION_BYTES)))


def fit_hurdle(
    train: DataFrame, rounds: int = ROUNDS, depth: int = DEPTH, codes: DataFrame | None = None
) -> HurdleModel:
    """Boosted trees for both stages (M4, M5), trained on weighted cells.

    The stages don't depend on each other, so their jobs share the cluster. Every
    `CHECKPOINT_ROUNDS` rounds the state goes to the shared folder, so lineage stays short.
    Rows are so few that walking a tree of six levels is cheaper than caching node ids.
    """
    shared_dir(train.sparkSession)
    codes = crossing_codes(train) if codes is None else codes
    labelled, means = stage_rows(pin(training_cells(train, codes), "training-cells"))
    settings = dict(
        featuresCol="features",
        weightCol="weight",
        maxIter=rounds,
        maxDepth=depth,
        stepSize=RATE,
        subsamplingRate=SAMPLING,
        featureSubsetStrategy=str(SAMPLING),
        cacheNodeIds=False,
        checkpointInterval=CHECKPOINT_ROUNDS,
        seed=SEED,
    )
    stages = [
        (GBTClassifier(labelCol="delayed", **settings), _packed(labelled, "labels")),
        (GBTRegressor(labelCol="log_minutes", predictionCol="log_delay", **settings), _packed(means, "means")),
    ]
    with ThreadPoolExecutor(len(stages)) as pool:
        fit = inheritable_thread_target(train.sparkSession)(lambda stage: stage[0].fit(stage[1]))
        classifier, regressor = pool.map(fit, stages)
    return HurdleModel(classifier, regressor, codes)


def prediction_grid(crossings: DataFrame, month: int = GRID_MONTH) -> DataFrame:
    """Every crossing, weekday and hour in a representative month.

    The weekday and hour lists are exploded per crossing; nothing is joined.
    """
    return crossings.select(
        "crossing_name", F.explode(F.sequence(F.lit(0), F.lit(6))).alias("day_of_week")
    ).select(
        "crossing_name",
        "day_of_week",
        F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hour_of_day"),
        F.lit(month).alias("month_of_year"),
    )


def grid_predictions(model: HurdleModel) -> DataFrame:
    """Prediction table keyed by crossing, weekday and hour."""
    grid = model.predict(prediction_grid(model.codes))
    return grid.select(
        "crossing_name",
        "day_of_week",
        "hour_of_day",
        "delay_probability",
        "expected_delay_minutes",
    )


def _long(row: DataFrame, evaluation: str, metrics: Sequence[str]) -> DataFrame:
    """One row of scores to (evaluation, metric, value, n_rows) rows."""
    return row.unpivot(["n_rows"], list(metrics), "metric", "value").select(
        F.lit(evaluation).alias("evaluation"), "metric", "value", "n_rows"
    )


def holdout_metrics(scored: DataFrame, evaluation: str = f"holdout_{TEST_YEAR}") -> DataFrame:
    """Scores of both stages against the baseline on weighted rows.

    `scored` has delay_minutes, n, delay_probability, expected_delay_minutes and
    baseline.
    """
    rows = pin(scored.withColumn("delayed", F.col("delay_minutes") > 0), "scored")
    weight, actual = F.col("n"), F.col("delay_minutes")
    plain = rows.agg(
        brier(F.col("delay_probability"), F.col("delayed"), weight).alias("stage1_brier"),
        mean_absolute_error(F.col("expected_delay_minutes"), actual, weight).alias(
            "model_mae_minutes"
        ),
        mean_absolute_error(F.col("baseline"), actual, weight).alias("baseline_mae_minutes"),
        weighted_mean(F.col("delayed").cast("double"), weight).alias("delayed_share"),
        F.sum("n").alias("n_rows"),
    ).withColumn(
        "improvement_over_baseline_pct",
        improvement_pct(F.col("model_mae_minutes"), F.col("baseline_mae_minutes")),
    )
    ranks = rank_metrics(rows, "delay_probability", "delayed", "n").select(
        F.col("roc_auc").alias("stage1_roc_auc"),
        F.col("average_precision").alias("stage1_pr_auc"),
        "n_rows",
    )
    return _long(ranks, evaluation, ["stage1_roc_auc", "stage1_pr_auc"]).unionByName(
        _long(
            plain,
            evaluation,
            [
                "stage1_brier",
                "model_mae_minutes",
                "baseline_mae_minutes",
                "delayed_share",
                "improvement_over_baseline_pct",
            ],
        )
    )


def drift_metrics(
    scored: DataFrame, evaluation: str = LIVE, min_rows: int = MIN_LIVE_ROWS
) -> DataFrame:
    """Error and delayed share on live rows, none below `min_rows` readings.

    The row count comes from the same aggregate as the scores.
    """
    weight, actual = F.col("n"), F.col("delay_minutes")
    scores = []
    if "expected_delay_minutes" in scored.columns:
        scores.append(
            mean_absolute_error(F.col("expected_delay_minutes"), actual, weight).alias(
                "model_mae_minutes"
            )
        )
    scores += [
        mean_absolute_error(F.col("baseline"), actual, weight).alias("baseline_mae_minutes"),
        weighted_mean((actual > 0).cast("double"), weight).alias("delayed_share"),
    ]
    row = scored.agg(*scores, F.sum("n").alias("n_rows")).where(F.col("n_rows") >= min_rows)
    return _long(row, evaluation, [c for c in row.columns if c != "n_rows"])


def train_and_score(
    history: DataFrame,
    live: DataFrame | None = None,
    rounds: int = ROUNDS,
    train_max_year: int = TRAIN_MAX_YEAR,
    test_year: int = TEST_YEAR,
    fitted: HurdleModel | None = None,
    cells: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Metric table and prediction grid of one training run (M16), or of a model fitted before.

    `history` and `live` are staged or mart rows; write the results with
    `replace_table` (S15). `cells` are the pinned cells of `history`, if they were
    counted before; it is not read again then.
    """
    cells = pin(delay_cells(history), "cells") if cells is None else cells
    train, test = temporal_split(cells, train_max_year, test_year)
    require_rows(train=train, test=test)
    model = fitted or fit_hurdle(train, rounds)
    scored = lookup_baseline(train, model.predict(test))
    parts = [holdout_metrics(scored, holdout_name(test_year))]
    if live is not None:
        now = pin(delay_cells(live), "live")
        parts.append(drift_metrics(lookup_baseline(train, model.predict(now))))
    metrics = reduce(DataFrame.unionByName, parts).withColumn(
        "evaluated_at", F.current_timestamp()
    )
    grid = grid_predictions(model).withColumn("generated_at", F.current_timestamp())
    return metrics, grid
