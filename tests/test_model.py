from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from flowmart.plans import model, serving, staging
from flowmart.session import pin
from flowmart.sources import adapters


@pytest.fixture(scope="module")
def history(spark, small):
    return pin(staging.stg_border_waits_historical(adapters.archive_raw(spark, small)), "history")


@pytest.fixture(scope="module")
def split(history):
    return model.temporal_split(pin(model.delay_cells(history), "cells"), 1999, 2000)


def test_cells_count_every_measured_reading(history):
    cells = model.delay_cells(history)
    measured = history.where(
        "traffic_type = 'commercial' and delay_status = 'reported' and delay_minutes is not null"
    )
    assert cells.agg(F.sum("n")).first()[0] == measured.count()


def test_features(spark):
    codes = spark.createDataFrame([("A", 0), ("B", 1)], "crossing_name string, crossing_code int")
    rows = spark.createDataFrame([("B", 6, 0, 12), ("Z", 0, 3, 3)], ", ".join(
        ["crossing_name string", "hour_of_day int", "day_of_week int", "month_of_year int"]))
    got = {r.crossing_name: r for r in model.with_features(rows, codes).collect()}
    assert (got["B"].crossing_code, got["Z"].crossing_code) == (1, -1)
    assert (got["B"].is_weekend, got["Z"].is_weekend) == (1, 0)
    assert got["B"].hour_sin == pytest.approx(1.0)
    assert got["Z"].month_cos == pytest.approx(math.cos(math.pi / 2), abs=1e-12)


def test_empty_side_stops_training(history):
    with pytest.raises(model.EmptySplit, match="test"):
        model.train_and_score(history, rounds=1, train_max_year=1999, test_year=2050)


def test_grid_is_complete(spark):
    names = spark.createDataFrame([("A",), ("B",)], "crossing_name string")
    grid = model.prediction_grid(names)
    assert grid.count() == grid.distinct().count() == 2 * 7 * 24


def test_training_run(spark, small, history, split):
    live = staging.stg_border_waits(adapters.border_raw(spark, small))
    metrics, grid = model.train_and_score(history, live, 3, 1999, 2000)
    metrics, grid = pin(metrics, "metrics"), pin(grid, "grid")
    found = {(r.evaluation, r.metric): r for r in metrics.collect()}
    holdout = model.holdout_name(2000)
    assert {m for e, m in found if e == holdout} == {
        "stage1_roc_auc", "stage1_pr_auc", "stage1_brier", "model_mae_minutes",
        "baseline_mae_minutes", "delayed_share", "improvement_over_baseline_pct",
    }
    assert {m for e, m in found if e == model.LIVE} == {
        "model_mae_minutes", "baseline_mae_minutes", "delayed_share",
    }
    _, test = split
    assert found[(holdout, "stage1_roc_auc")].n_rows == test.agg(F.sum("n")).first()[0]
    assert 0 <= found[(holdout, "stage1_roc_auc")].value <= 1
    base = found[(holdout, "baseline_mae_minutes")].value
    mae = found[(holdout, "model_mae_minutes")].value
    gain = found[(holdout, "improvement_over_baseline_pct")].value
    assert gain == pytest.approx((base - mae) / base * 100)
    crossings = grid.select("crossing_name").distinct().count()
    assert grid.count() == crossings * 168
    assert grid.where("delay_probability not between 0 and 1 or expected_delay_minutes < 0").count() == 0
    assert serving.peak_hour(grid).count() == crossings * 7
    summary = serving.model_summary(metrics, holdout, model.LIVE, F.current_timestamp()).first()
    assert summary.gain_pct == pytest.approx(gain)
    assert summary.retrained_at is not None and summary.age_label.endswith("min old")


def test_summary_counts_the_archive_once(spark, small, monkeypatch):
    from contract import queries

    counted, cells_of, fit = [], model.delay_cells, model.fit_hurdle
    monkeypatch.setattr(model, "delay_cells", lambda rows: counted.append(rows.columns) or cells_of(rows))
    monkeypatch.setattr(model, "fit_hurdle", lambda train: fit(train, 2))
    monkeypatch.setattr(queries, "_HURDLES", {})
    row = queries.REGISTRY["model_summary"](spark, small).first()
    assert ["local_year_pt" in columns for columns in counted] == [True, False]
    # What it says is what the rows say when they are counted anew.
    archive, live = queries.history(spark, small), queries.waits(spark, small)
    metrics, _ = model.train_and_score(archive, live, 2, 1999, 2000, queries._hurdle(spark, small)[1])
    found = {(r.evaluation, r.metric): r.value for r in metrics.collect()}
    assert row.roc_auc == pytest.approx(found[model.holdout_name(2000), "stage1_roc_auc"])
    assert row.model_mae_minutes == pytest.approx(found[model.holdout_name(2000), "model_mae_minutes"])
    assert row.live_delayed_share == pytest.approx(found[model.LIVE, "delayed_share"])


def test_cell_means_give_the_splits_of_single_readings(spark, split):
    from pyspark.ml.regression import DecisionTreeRegressor

    train, _ = split
    train = train.where("crossing_name < 'Office 5'")
    codes = model.crossing_codes(train)
    labelled, means = model.stage_rows(model.training_cells(train, codes))
    every = model._assemble(model.with_features(train, codes)).withColumn("one", F.explode(F.sequence(F.lit(1), "n")))
    every = every.withColumns(
        {"weight": F.lit(1.0), "log_minutes": F.log1p("delay_minutes"), "delayed": (F.col("delay_minutes") > 0).cast("double")}
    )
    assert every.count() == labelled.agg(F.sum("weight")).first()[0]
    for label, cells, rows in (("log_minutes", means, every.where("delayed = 1")), ("delayed", labelled, every)):
        tree = DecisionTreeRegressor(labelCol=label, weightCol="weight", maxDepth=4, maxBins=64, minInfoGain=1e-6)
        small, full = (tree.fit(pin(x.select("features", label, "weight"), "rows")) for x in (cells, rows))
        numbers = r"\d+\.\d{6,}(E-?\d+)?"
        import re

        short = [re.sub(numbers, lambda m: f"{float(m[0]):.8f}", t.toDebugString.split("\n", 1)[1]) for t in (small, full)]
        assert short[0] == short[1]


def test_learns_a_clear_pattern(spark):
    rows = [
        ("A", h, d, 7, 30 if h >= 12 else 0, 5) for h in range(24) for d in range(7)
    ]
    train = spark.createDataFrame(
        rows, "crossing_name string, hour_of_day int, day_of_week int, month_of_year int, "
              "delay_minutes int, n bigint")
    hurdle = model.fit_hurdle(pin(train, "train"), rounds=20, depth=2)
    got = hurdle.predict(train.where("day_of_week = 3"))
    by_hour = {r.hour_of_day: r for r in got.collect()}
    assert by_hour[20].delay_probability > 0.8 > 0.3 > by_hour[3].delay_probability
    assert by_hour[20].expected_delay_minutes > 10 * by_hour[3].expected_delay_minutes


def test_beats_the_constant_predictor_on_held_out_rows(spark):
    import random

    rnd = random.Random(6)

    def readings(count):
        out = []
        for _ in range(count):
            hour, day = rnd.randrange(24), rnd.randrange(7)
            delayed = rnd.random() < (0.8 if 7 <= hour < 11 else 0.15)
            out.append(("A", hour, day, 7, rnd.randint(20, 60) if delayed else 0, 1))
        return spark.createDataFrame(
            out, "crossing_name string, hour_of_day int, day_of_week int, month_of_year int, "
                 "delay_minutes int, n bigint")

    train, test = pin(readings(3000), "train"), pin(readings(1000), "test")
    scored = model.fit_hurdle(train, rounds=15, depth=3).predict(test)
    share = train.agg(F.avg((F.col("delay_minutes") > 0).cast("double"))).first()[0]
    mean = train.agg(F.avg("delay_minutes")).first()[0]
    late = (F.col("delay_minutes") > 0).cast("double")
    row = scored.agg(
        F.avg((F.col("delay_probability") - late) ** 2).alias("brier"),
        F.avg((F.lit(share) - late) ** 2).alias("constant_brier"),
        F.avg(F.abs(F.col("expected_delay_minutes") - F.col("delay_minutes"))).alias("mae"),
        F.avg(F.abs(F.lit(mean) - F.col("delay_minutes"))).alias("constant_mae"),
    ).first()
    assert row.brier < 0.85 * row.constant_brier
    assert row.mae < 0.95 * row.constant_mae


def test_drift_needs_enough_rows(spark):
    scored = spark.createDataFrame([(5, 4.0, 49)], "delay_minutes int, baseline double, n bigint")
    assert model.drift_metrics(scored).count() == 0
    assert model.drift_metrics(scored.withColumn("n", F.lit(50))).count() == 2
