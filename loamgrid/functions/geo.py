"""Points, boxes and rings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def in_box(lon: Column, lat: Column, box: tuple[float, float, float, float]) -> Column:
    """Whether a point lies in (min lon, min lat, max lon, max lat), edges included."""
    return lon.between(box[0], box[2]) & lat.between(box[1], box[3])


def in_polygon(lon: Column, lat: Column, ring: list[tuple[float, float]]) -> Column:
    """Ray casting against a literal ring of three vertices or more; its box is tested first, so scans can prune."""
    if len(ring) < 3:
        raise ValueError("a polygon has three vertices at least")
    xs, ys = zip(*ring)
    odd = F.lit(False)
    for (x1, y1), (x2, y2) in zip(ring, [*ring[1:], ring[0]]):
        if y1 != y2:
            crosses = (F.lit(y1) > lat) != (F.lit(y2) > lat)
            odd = odd != (crosses & (lon < F.lit(float(x2 - x1)) * (lat - y1) / F.lit(float(y2 - y1)) + x1))
    return in_box(lon, lat, (min(xs), min(ys), max(xs), max(ys))) & odd


def in_ring(lon: Column, lat: Column, ring: Column) -> Column:
    """The same against a column of array<struct<lon, lat>>, for polygons that come as rows."""
    pairs = F.arrays_zip(ring.alias("a"), F.concat(F.slice(ring, 2, F.size(ring)), F.slice(ring, 1, 1)).alias("b"))

    def flip(odd: Column, pair: Column) -> Column:
        a, b = pair["a"], pair["b"]
        crosses = (a["lat"] > lat) != (b["lat"] > lat)
        at = (b["lon"] - a["lon"]) * (lat - a["lat"]) / F.nullif(b["lat"] - a["lat"], F.lit(0.0)) + a["lon"]
        return odd != F.coalesce(crosses & (lon < at), F.lit(False))

    return F.aggregate(pairs, F.lit(False), flip)


def all_in_box(points: Column, box: tuple[float, float, float, float]) -> Column:
    """Whether there is a point and every one lies in the box."""
    return (F.size(points) > 0) & F.forall(points, lambda p: in_box(p["lon"], p["lat"], box))


def ring_stats(rings: Column) -> Column:
    """struct(rings, vertices, complexity) of array<array<point>>: several rings, more than 20 vertices, or neither."""
    vertices = F.aggregate(rings, F.lit(0), lambda n, r: n + F.size(r))
    kind = F.when(F.size(rings) > 1, "multi-polygon").when(vertices > 20, "complex-polygon").otherwise("simple-polygon")
    return F.struct(F.size(rings).alias("rings"), vertices.alias("vertices"), kind.alias("complexity"))
