"""Range join of positions with a table of boxes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from flowmart.session import Scratch

# Cells of the finest grid, in degrees; each coarser grid doubles them. 2^16 of them span the globe.
FINEST = 1 / 128
LEVELS = 17


def _cell_size(level: Column) -> Column:
    return F.lit(FINEST) * F.pow(F.lit(2.0), level)


def _cells(degrees: Column, level: Column) -> Column:
    return F.floor(degrees / _cell_size(level)).cast("int")


def box_cells(boxes: DataFrame) -> DataFrame:
    """Boxes once per grid cell they touch, four at most.

    A box goes to the grid whose cells are just larger than it. Boxes that hold no point,
    with a missing edge or edges in the wrong order, are left out.
    """
    size = F.greatest(F.col("north") - F.col("south"), F.col("east") - F.col("west"))
    level = F.greatest(F.lit(0.0), F.ceil(F.log2(F.greatest(size, F.lit(FINEST)) / FINEST)))
    placed = boxes.where("south <= north and west <= east").withColumn("level", level.cast("int"))
    rows = F.explode(F.sequence(_cells(F.col("south"), F.col("level")), _cells(F.col("north"), F.col("level"))))
    columns = F.explode(F.sequence(_cells(F.col("west"), F.col("level")), _cells(F.col("east"), F.col("level"))))
    return placed.withColumn("cell_row", rows).withColumn("cell_column", columns)


def region_by_boxes(points: DataFrame, boxes: DataFrame, lat: str, lon: str, name: str = "region") -> DataFrame:
    """Add the region of the first box, by priority, that holds a point; edges belong to it.

    `boxes` has region, south, west, north, east and priority; equal priorities follow the
    region's name. Points outside all boxes, or without a position, get null. Each distinct
    position is looked up once: an equi-join on the cells of the grids in use, then the exact
    edges. Neither side is taken to be small, Catalyst broadcasts the boxes if they are.
    """
    with Scratch(points.sparkSession) as scratch:
        cells = scratch.pin(
            box_cells(boxes).select("level", "cell_row", "cell_column", "south", "west", "north", "east", "priority", "region"),
            "box-cells",
        )
        # One number per grid, seventeen at most.
        levels = sorted(row.level for row in cells.select("level").distinct().collect())
        spots = points.select(F.col(lat).cast("double").alias("_lat"), F.col(lon).cast("double").alias("_lon"))
        spots = spots.where("_lat is not null and _lon is not null").distinct()
        placed = spots.withColumn("level", F.explode(F.array(*[F.lit(n) for n in levels]).cast("array<int>")))
        placed = placed.withColumns(
            {"cell_row": _cells(F.col("_lat"), F.col("level")), "cell_column": _cells(F.col("_lon"), F.col("level"))}
        )
        inside = F.col("_lat").between(F.col("south"), F.col("north")) & F.col("_lon").between(F.col("west"), F.col("east"))
        hits = placed.join(cells, ["level", "cell_row", "cell_column"]).where(inside)
        first = hits.groupBy("_lat", "_lon").agg(F.min(F.struct("priority", "region")).alias("_first"))
        found = scratch.pin(first.select("_lat", "_lon", F.col("_first.region").alias("_region")), "found")
        scratch.keep("found")
    same = [F.col(lat).cast("double") == found["_lat"], F.col(lon).cast("double") == found["_lon"]]
    return points.join(found, same, "left").select(*[points[c] for c in points.columns], F.col("_region").alias(name))
