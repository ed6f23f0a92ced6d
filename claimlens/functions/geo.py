"""Points in polygons by ray casting, as expressions over arrays of coordinates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ring_edges(ring: Column) -> Column:
    """Edges (x1, y1, x2, y2) between consecutive vertices of a ring of [x, y] pairs, from the last to the first too."""
    return F.zip_with(ring, F.concat(F.slice(ring, 2, F.size(ring)), F.slice(ring, 1, 1)), lambda a, b: F.struct(a[0].alias("x1"), a[1].alias("y1"), b[0].alias("x2"), b[1].alias("y2")))


def crosses(x: Column, y: Column, e: Column) -> Column:
    """Whether an edge crosses the line from a point to the right."""
    straddles = (e["y1"] > y) != (e["y2"] > y)
    at = (e["x2"] - e["x1"]) * (y - e["y1"]) / F.when(e["y2"] != e["y1"], e["y2"] - e["y1"]) + e["x1"]
    return F.coalesce(straddles & (x < at), F.lit(False))


def odd_crossings(x: Column, y: Column, edges: Column, plain: int = 0) -> Column:
    """Even-odd rule over edges; up to `plain` of them are tested without a loop."""
    odd = F.aggregate(edges, F.lit(False), lambda odd, e: odd != crosses(x, y, e))
    if not plain:
        return odd
    few = crosses(x, y, F.get(edges, F.lit(0)))
    for i in range(1, plain):
        few = few != crosses(x, y, F.get(edges, F.lit(i)))
    return F.when(F.size(edges) <= plain, few).otherwise(odd)


def in_ring(x: Column, y: Column, ring: Column) -> Column:
    """Even-odd rule over consecutive vertices of a closed ring of [lon, lat] pairs."""
    return odd_crossings(x, y, ring_edges(ring))


def in_polygon(x: Column, y: Column, rings: Column) -> Column:
    """Inside the first ring and outside all others."""
    return in_ring(x, y, rings[0]) & ~F.exists(F.slice(rings, 2, F.size(rings)), lambda hole: in_ring(x, y, hole))


def ring_area(ring: Column) -> Column:
    """Area of a closed ring of [x, y] points, in the units of its coordinates."""
    pairs = F.zip_with(F.slice(ring, 1, F.size(ring) - 1), F.slice(ring, 2, F.size(ring) - 1), lambda a, b: a[0] * b[1] - b[0] * a[1])
    return F.abs(F.aggregate(pairs, F.lit(0.0), lambda total, x: total + x)) / 2


def largest_ring(rings: Column) -> Column:
    """The ring of the largest area."""
    return F.array_max(F.transform(rings, lambda r: F.struct(ring_area(r).alias("area"), r.alias("ring"))))["ring"]


def rounded(ring: Column, digits: int) -> Column:
    """A ring with rounded coordinates, successive equal points dropped."""
    points = F.transform(ring, lambda p: F.transform(p, lambda x: F.round(x, digits)))
    return F.filter(points, lambda p, i: (i == 0) | (p != points[F.greatest(i - 1, F.lit(0))]))
