"""Hierarchical fallback lookup."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F


def fallback_means(
    train: DataFrame, targets: DataFrame, keys: Sequence[str], totals: Mapping[str, str], weight: str
) -> DataFrame:
    """Means of the finest known cell for each target row.

    `keys` run from coarse to fine. `train` has one row of sums and a row count
    per finest cell; `totals` maps each output column to the column of its sum.
    Coarser tables add those rows up, so raw rows are read once. Cells missing at
    every grain get the global mean. Pass pinned cells: their file size then
    decides how each join runs.
    """
    result = targets
    depths = range(len(keys), 0, -1)
    for depth in depths:
        cell = list(keys[:depth])
        grain = train
        if depth < len(keys):
            sums = [F.sum(c).alias(c) for c in (*totals.values(), weight)]
            grain = train.groupBy(*cell).agg(*sums)
        means = [
            (F.col(total) / F.col(weight)).alias(f"_{name}_{depth}") for name, total in totals.items()
        ]
        result = result.join(grain.select(*cell, *means), cell, "left")
    overall = {
        name: train.select((F.sum(total) / F.sum(weight)).alias("overall")).scalar()
        for name, total in totals.items()
    }
    return result.select(
        *targets.columns,
        *[
            F.coalesce(*[F.col(f"_{name}_{depth}") for depth in depths], overall[name]).alias(name)
            for name in totals
        ],
    )
