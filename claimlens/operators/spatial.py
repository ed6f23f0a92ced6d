"""Points in polygons by grid cells: an equi-join on cells, ray casting in the cells of borders alone.

A polygon is cut into the cells that its edges touch and those that lie inside without touching any. A point of an inside
cell needs no test. The grid's step is a parameter: a finer one has more rows and fewer tests.

Rings meet rows by sorted joins: their size is not seen in that of the table they come from, so none is left to a broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimlens.functions import geo

#: Where a point without an area is tried again: some kilometres around it, first match in this order (fixed values).
PROBES = ((0.05, 0.0), (-0.05, 0.0), (0.0, 0.05), (0.0, -0.05), (0.05, 0.05), (-0.05, 0.05), (0.05, -0.05), (-0.05, -0.05))
#: Rings are widened by this share of a step when their cells are found, so that rounding of a cell's number loses no border.
SLACK = 1e-6
#: A cell of more points is dealt over several tasks, so many at a time.
SHARE = 256


def cell(x: Column, step: float) -> Column:
    return F.floor(x / F.lit(step)).cast("long")


def cover(areas: DataFrame, step: float) -> DataFrame:
    """(area, cx, cy, border) of areas (area, rings: closed rings of [x, y], holes after the first).

    An edge borders, in every column of cells that it crosses, the cells between its lowest and highest point there. In
    a column, cells between borders are inside or outside as a whole, as their centres are.
    """
    # few bytes give many rows: dealt by number, as by bytes they would stay in one task
    ring = areas.repartition(_width(areas), "area").select("area", F.explode("rings").alias("ring"))
    ends = ring.select("area", F.explode(F.zip_with(F.slice("ring", 1, F.size("ring") - 1), F.slice("ring", 2, F.size("ring") - 1), lambda a, b: F.struct(a[0].alias("x1"), a[1].alias("y1"), b[0].alias("x2"), b[1].alias("y2")))).alias("e")).select("area", "e.*")
    slack = step * SLACK
    low, high = F.least("x1", "x2") - slack, F.greatest("x1", "x2") + slack
    column = ends.withColumn("cx", F.explode(F.sequence(cell(low, step), cell(high, step))))
    left, right = F.col("cx") * step, (F.col("cx") + 1) * step
    slope = (F.col("y2") - F.col("y1")) / F.when(F.col("x2") != F.col("x1"), F.col("x2") - F.col("x1"))
    at = lambda x: F.col("y1") + slope * (F.least(F.greatest(x, F.least("x1", "x2")), F.greatest("x1", "x2")) - F.col("x1"))
    ya, yb = F.coalesce(at(left), F.col("y1")), F.coalesce(at(right), F.col("y2"))
    rows = F.sequence(cell(F.least(ya, yb) - slack, step), cell(F.greatest(ya, yb) + slack, step))
    border = column.select("area", "cx", F.explode(rows).alias("cy")).distinct()
    gap = border.withColumn("next", F.lead("cy").over(Window.partitionBy("area", "cx").orderBy("cy"))).where("next > cy + 1")
    middle = lambda c: (F.col(c) + 0.5) * step
    inner = gap.withColumn("mid", F.col("cy") + 1).join(areas.select("area", "rings").hint("merge"), "area")
    inner = inner.where(geo.in_polygon(middle("cx"), middle("mid"), F.col("rings"))).select("area", "cx", F.explode(F.sequence(F.col("cy") + 1, F.col("next") - 1)).alias("cy"))
    return border.withColumn("border", F.lit(True)).unionByName(inner.withColumn("border", F.lit(False)))


def _width(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _near(areas: DataFrame, covered: DataFrame, step: float) -> DataFrame:
    """The cover with, in cells of borders, the edges that a line to the right of the cell's points may cross: outer, holes."""
    edges = F.transform("rings", geo.ring_edges)
    cells = covered.join(areas.select("area", edges.alias("edges")).hint("merge"), "area")
    slack = step * SLACK
    left, low, high = F.col("cx") * step - slack, F.col("cy") * step - slack, (F.col("cy") + 1) * step + slack
    meets = lambda e: (F.least(e["y1"], e["y2"]) <= high) & (F.greatest(e["y1"], e["y2"]) >= low) & (F.greatest(e["x1"], e["x2"]) >= left)
    outer = F.filter(F.col("edges")[0], meets)
    holes = F.filter(F.transform(F.slice("edges", 2, F.size("edges")), lambda hole: F.filter(hole, meets)), lambda hole: F.size(hole) > 0)
    return cells.select("area", "cx", "cy", F.when(F.col("border"), outer).alias("outer"), F.when(F.col("border") & (F.size(holes) > 0), holes).alias("holes"))


def within(points: DataFrame, areas: DataFrame, covered: DataFrame, step: float) -> DataFrame:
    """(id, area) of points (id, x, y) for every area that holds them. covered: the areas' cover at this step.

    Pairs grow with points times areas and their number is not seen in the bytes of either side, so cells are dealt by number,
    and the points of a crowded one over several tasks. A pair in a cell of borders is tested on the edges near that cell alone.
    """
    placed = points.where("x is not null and y is not null").withColumn("cx", cell(F.col("x"), step)).withColumn("cy", cell(F.col("y"), step))
    # at most 65,536 cells are told; others hold less than that part of the points
    crowded = placed.groupBy("cx", "cy").agg(F.count("*").alias("n")).where(F.col("n") > SHARE).orderBy(F.desc("n"), "cx", "cy").limit(65_536)
    crowded = F.broadcast(crowded.select("cx", "cy", F.ceil(F.col("n") / SHARE).alias("parts")))
    key = ["cx", "cy", "part"]
    dealt = placed.join(crowded, ["cx", "cy"], "left").select("id", "x", "y", "cx", "cy", F.coalesce(F.pmod(F.xxhash64("id", "x", "y"), "parts"), F.lit(0)).alias("part"))
    cells = _near(areas, covered, step).join(crowded, ["cx", "cy"], "left")
    cells = cells.select("area", "cx", "cy", "outer", "holes", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("parts", F.lit(1)) - 1)).alias("part"))
    near = dealt.repartition(_width(points), *key).join(cells.repartition(_width(points), *key).hint("merge"), key)
    x, y = F.col("x"), F.col("y")
    hole = F.col("holes").isNotNull() & F.exists("holes", lambda edges: geo.odd_crossings(x, y, edges))
    return near.where(F.col("outer").isNull() | (geo.odd_crossings(x, y, F.col("outer"), plain=4) & ~hole)).select("id", "area")


def firsts(areas: DataFrame, covered: DataFrame) -> DataFrame:
    """(cx, cy, border, order, code, rings): in every cell the areas that can be the first around a point of it.

    The least area that holds the whole cell comes before all that follow it in the order of (rank, area), so only it and
    the borders before it are left: a cell keeps few areas, however many overlap there.
    """
    ranked = covered.join(areas.select("area", "code", F.struct("rank", "area").alias("order")).hint("merge"), "area")
    least = ranked.where("not border").groupBy("cx", "cy").agg(F.min("order").alias("least"))
    kept = ranked.join(least, ["cx", "cy"], "left").where("least is null or order <= least").drop("least")
    return kept.join(areas.select("area", "rings").hint("merge"), "area").drop("area")


def fill(points: DataFrame, areas: DataFrame, covered: DataFrame, step: float) -> DataFrame:
    """(id, code, basis): a point's own code where it is one (two letters), else that of the first area around it, else of the probes.

    points: id, x, y, own; areas: area, code, rank (areas that overlap: the least), rings. Without any, both are null.
    """
    own = F.upper(F.trim("own"))
    tagged = points.select("id", "x", "y", F.when(own.rlike("^[A-Z]{2}$"), own).alias("own"))
    asked = tagged.where("own is null").withColumn("p", F.explode(F.array(*[F.struct(F.lit(n).alias("probe"), F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for n, (dx, dy) in enumerate(((0.0, 0.0), *PROBES))])))
    tried = asked.select("id", "p.probe", (F.col("x") + F.col("p.dx")).alias("x"), (F.col("y") + F.col("p.dy")).alias("y")).where("x is not null and y is not null")
    tried = tried.withColumn("cx", cell(F.col("x"), step)).withColumn("cy", cell(F.col("y"), step))
    hits = tried.join(firsts(areas, covered).hint("merge"), ["cx", "cy"]).where(~F.col("border") | geo.in_polygon(F.col("x"), F.col("y"), F.col("rings")))
    best = hits.groupBy("id").agg(F.min_by("code", F.struct("probe", "order")).alias("found"))
    out = tagged.join(best, "id", "left")
    basis = F.when(F.col("own").isNotNull(), "tag").when(F.col("found").isNotNull(), "boundary lookup")
    return out.select("id", F.coalesce("own", "found").alias("code"), basis.alias("basis"))
