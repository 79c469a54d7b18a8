"""Place filters: points along a space-filling curve, found by the ranges that cover a shape.

A cell is the interleaved bits of a point's longitude and latitude, 16 bits each, so that
near points have near cells and a square of any power of two is one range of cells. Points
are stored in cell order; a circle or box is covered by squares, whose ranges reach the scan
as a filter, and what the squares hold is tested exactly.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from quillon.session import fresh_path, materialize

LEVELS = 16
SIDE = 1 << LEVELS
#: Mean radius of the earth in metres.
EARTH = 6_371_008.8
#: Squares that cover one shape at most, and ranges written into the scan's own filter.
MAX_SQUARES = 64
PUSHED_RANGES = 128
_PAD = 1e-7


def _steps(value: Column, low: float, width: float) -> Column:
    return F.least(F.floor((value - low) / width * SIDE), F.lit(SIDE - 1)).cast("long")


def _spread(value: Column) -> Column:
    """The low 16 bits of a number, each followed by a free bit."""
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        value = value.bitwiseOR(F.shiftleft(value, shift)).bitwiseAND(F.lit(mask).cast("long"))
    return value


def cell_of(lon: Column, lat: Column) -> Column:
    """Place of a point on the curve, a long below 2 ** 32."""
    return F.shiftleft(_spread(_steps(lat, -90.0, 180.0)), 1).bitwiseOR(_spread(_steps(lon, -180.0, 360.0)))


def on_earth(lon: Column, lat: Column) -> Column:
    return lon.between(-180.0, 180.0) & lat.between(-90.0, 90.0)


def distance(lon: Column, lat: Column, lon2: Column, lat2: Column) -> Column:
    """Metres along the great circle."""
    up, across = F.sin(F.radians(lat2 - lat) / 2), F.sin(F.radians(lon2 - lon) / 2)
    chord = up * up + F.cos(F.radians(lat)) * F.cos(F.radians(lat2)) * across * across
    return 2 * EARTH * F.asin(F.sqrt(F.least(chord, F.lit(1.0))))


@dataclass(frozen=True)
class GeoIndex:
    """Written points (id, lon, lat, cell), in the order of their cells."""

    points: DataFrame
    path: str


def build_geo_index(points: DataFrame, *, id_column: str = "record_id", lon: str = "lon", lat: str = "lat") -> GeoIndex:
    """Write the points in cell order; those that share a cell are spread by their id.

    Points with a null id, without a place, or with one off the earth are left out.
    """
    spark = points.sparkSession
    rows = points.select(F.col(id_column).alias("id"), F.col(lon).cast("double").alias("lon"), F.col(lat).cast("double").alias("lat"))
    rows = rows.where(F.col("id").isNotNull() & on_earth(F.col("lon"), F.col("lat"))).withColumn("cell", cell_of(F.col("lon"), F.col("lat")))
    path = fresh_path(spark, "cells")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = materialize(rows, "places")  # ranges are sampled from it first
    rows.repartitionByRange(parts, "cell", "id").sortWithinPartitions("cell", "id").write.parquet(path)
    return GeoIndex(spark.read.schema(rows.schema).parquet(path), path)


def circle_boxes(lon: float, lat: float, radius: float) -> list[tuple[float, float, float, float]]:
    """Boxes (west, south, east, north) around a circle: two where it crosses the 180th meridian."""
    angle = radius / EARTH
    reach = math.degrees(angle) + _PAD
    south, north = lat - reach, lat + reach
    if south <= -90 or north >= 90:
        return [(-180.0, max(south, -90.0), 180.0, min(north, 90.0))]
    wide = math.degrees(math.asin(min(1.0, math.sin(angle) / math.cos(math.radians(lat))))) + _PAD
    return split_box(lon - wide, south, lon + wide, north)


def split_box(west: float, south: float, east: float, north: float) -> list[tuple[float, float, float, float]]:
    """A box as boxes that don't cross the 180th meridian; west above east crosses it."""
    if south > north:
        return []
    if west < -180:
        west += 360
    if east > 180:
        east -= 360
    if west > east:
        return [(west, south, 180.0, north), (-180.0, south, east, north)]
    return [(west, south, east, north)]


def _step(value: float, low: float, width: float) -> int:
    return max(0, min(math.floor((value - low) / width * SIDE), SIDE - 1))


def squares(boxes: list[tuple[float, float, float, float]], most: int = MAX_SQUARES) -> tuple[int, set[tuple[int, int]]]:
    """(level, squares as (x, y)): the finest level at which at most ``most`` squares cover the boxes.

    Level 0 is the whole earth as one square.
    """
    spans = [(_step(w, -180.0, 360.0), _step(e, -180.0, 360.0), _step(s, -90.0, 180.0), _step(n, -90.0, 180.0)) for w, s, e, n in boxes]
    for level in range(LEVELS, -1, -1):
        cut = LEVELS - level
        sides = [(x0 >> cut, x1 >> cut, y0 >> cut, y1 >> cut) for x0, x1, y0, y1 in spans]
        if level == 0 or sum((x1 - x0 + 1) * (y1 - y0 + 1) for x0, x1, y0, y1 in sides) <= most:
            return level, {(x, y) for x0, x1, y0, y1 in sides for x in range(x0, x1 + 1) for y in range(y0, y1 + 1)}
    raise AssertionError("level 0 always covers")


def _interleaved(x: int, y: int, level: int) -> int:
    return sum(((x >> b & 1) << 2 * b) | ((y >> b & 1) << (2 * b + 1)) for b in range(level))


def _covers(batches: Iterator[pa.RecordBatch], boxes_of) -> Iterator[pa.RecordBatch]:
    """(place, level, square) rows of shapes (place, four or three numbers)."""
    for batch in batches:
        places, levels, found = [], [], []
        for place, *shape in zip(*(c.to_pylist() for c in batch.columns)):
            boxes = boxes_of(*shape)
            if not boxes:
                continue
            level, cover = squares(boxes)
            for x, y in sorted(cover):
                places.append(place)
                levels.append(level)
                found.append(_interleaved(x, y, level))
        yield pa.RecordBatch.from_arrays(
            [pa.array(places, pa.int64()), pa.array(levels, pa.int32()), pa.array(found, pa.int64())], names=["place", "level", "square"])


def merged_ranges(found: list[tuple[int, int]], most: int = PUSHED_RANGES) -> list[tuple[int, int]]:
    """Sorted ranges without overlap; the smallest gaps are closed until ``most`` are left."""
    joined: list[list[int]] = []
    for low, high in sorted(found):
        if joined and low <= joined[-1][1] + 1:
            joined[-1][1] = max(joined[-1][1], high)
        else:
            joined.append([low, high])
    if len(joined) > most:
        gaps = sorted(range(1, len(joined)), key=lambda i: joined[i][0] - joined[i - 1][1], reverse=True)
        cuts = sorted(gaps[: most - 1])
        starts, ends = [0, *cuts], [*cuts, len(joined)]
        joined = [[joined[a][0], joined[b - 1][1]] for a, b in zip(starts, ends)]
    return [(a, b) for a, b in joined]


def covered(index: GeoIndex, covers: DataFrame, places: int) -> DataFrame:
    """(place, id, lon, lat): points in the squares (place, level, square) of any shape.

    Shapes up to a checked number put their merged ranges into the scan's filter. A point
    meets the squares of each level that occurs by equality, in one scan.
    """
    levels = sorted(r[0] for r in covers.select("level").distinct().collect())  # 17 at most
    points = index.points
    if places * MAX_SQUARES <= 100_000:
        cut = [(r.square << 2 * (LEVELS - r.level), ((r.square + 1) << 2 * (LEVELS - r.level)) - 1) for r in covers.collect()]
        ranges = merged_ranges(cut)
        points = points.where(functools.reduce(Column.__or__, (F.col("cell").between(a, b) for a, b in ranges), F.lit(False)))
    keys = F.array(*(F.struct(F.lit(v).alias("level"), F.shiftright("cell", 2 * (LEVELS - v)).alias("square")) for v in levels))
    if not levels:
        keys = F.array().cast("array<struct<level:int,square:bigint>>")
    return points.select("id", "lon", "lat", F.inline(keys)).join(covers, ["level", "square"]).select("place", "id", "lon", "lat")


def _within(index: GeoIndex, shapes: DataFrame, boxes_of, inside, out) -> DataFrame:
    """One row per shape and point row that pass the exact test."""
    numbered = materialize(shapes.distinct().withColumn("place", F.monotonically_increasing_id()), "shapes")
    numbers = [c for c in shapes.columns if c != "filter_id"]
    covers = numbered.select("place", *numbers).mapInArrow(functools.partial(_covers, boxes_of=boxes_of), "place long, level int, square long")
    covers = materialize(covers, "covers")
    met = covered(index, covers, numbered.count())
    renamed = numbered.select("place", "filter_id", *(F.col(n).alias(f"_{n}") for n in numbers))
    return met.join(renamed, "place").where(inside).select("filter_id", "id", *out)


def geo_circles(index: GeoIndex, circles: DataFrame) -> DataFrame:
    """(filter_id, id, metres): points at most ``radius`` metres from a circle's centre.

    ``circles`` has filter_id, lon, lat and radius. Circles with a null, a centre off the
    earth or a negative radius hold nothing; equal ones count once. Other columns are ignored.
    """
    shapes = circles.select("filter_id", *(F.col(c).cast("double").alias(c) for c in ("lon", "lat", "radius")))
    shapes = shapes.where(F.col("filter_id").isNotNull() & on_earth(F.col("lon"), F.col("lat")) & (F.col("radius") >= 0))
    shapes = shapes.where(~F.isnan("radius")).withColumn("radius", F.least("radius", F.lit(2 * math.pi * EARTH)))
    metres = distance(F.col("_lon"), F.col("_lat"), F.col("lon"), F.col("lat"))
    return _within(index, shapes, circle_boxes, metres <= F.col("_radius"), [metres.alias("metres")])


def geo_boxes(index: GeoIndex, boxes: DataFrame) -> DataFrame:
    """(filter_id, id): points in boxes (filter_id, west, south, east, north), borders included.

    A box whose west lies above its east crosses the 180th meridian. Boxes with a null or a
    corner off the earth hold nothing.
    """
    shapes = boxes.select("filter_id", *(F.col(c).cast("double").alias(c) for c in ("west", "south", "east", "north")))
    corners = on_earth(F.col("west"), F.col("south")) & on_earth(F.col("east"), F.col("north"))
    shapes = shapes.where(F.col("filter_id").isNotNull() & corners)
    lon, west, east = F.col("lon"), F.col("_west"), F.col("_east")
    across = F.when(west <= east, lon.between(west, east)).otherwise((lon >= west) | (lon <= east))
    return _within(index, shapes, split_box, across & F.col("lat").between(F.col("_south"), F.col("_north")), [])
