"""Cell border polygons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# The two pairs that pad a border to its fixed length.
PAD_ZERO, PAD_MAX = 0, 32767


def valid_border_length(border: Column) -> Column:
    """Vertices before the padding of an array of ``(dx, dy)``.

    Padding starts at the first two equal padding pairs in a row, or is a single
    pair at the very end.
    """
    mark = F.transform(border, lambda p: F.when((p["dx"] == PAD_ZERO) & (p["dy"] == PAD_ZERO), 1).when(
        (p["dx"] == PAD_MAX) & (p["dy"] == PAD_MAX), 2).otherwise(0))
    size = F.size(border)
    twice = F.transform(F.sequence(F.lit(1), F.greatest(size - 1, F.lit(1))), lambda i: F.coalesce(
        (F.element_at(mark, i) > 0) & (F.element_at(mark, i) == F.get(mark, i)), F.lit(False)))
    first = F.array_position(twice, F.lit(True))
    return F.when(first > 0, first - 1).when(F.element_at(mark, -1) > 0, size - 1).otherwise(size).cast("long")


def pack_borders(vertices: DataFrame, length: int = 32, pad: Column | None = None) -> DataFrame:
    """Vertex rows to one fixed-length array per cell."""
    fill = F.lit(PAD_MAX) if pad is None else pad
    v = F.transform(F.sort_array(F.collect_list(F.struct("idx", "dx", "dy"))),
                    lambda s: F.struct(s["dx"].cast("int").alias("dx"), s["dy"].cast("int").alias("dy")))
    packed = vertices.groupBy("chip", "cell_id").agg(v.alias("border"))
    padding = F.array_repeat(F.struct(fill.cast("int").alias("dx"), fill.cast("int").alias("dy")),
                             F.greatest(F.lit(0), length - F.size("border")))
    return packed.withColumn("border", F.concat("border", padding))


def _thinner(ring: Column) -> Column:
    """A ring of ``(dx, dy)`` without the vertex that spans the smallest triangle, the first of equal ones."""
    size = F.size(ring)

    def area(p: Column, i: Column) -> Column:
        a, b = F.get(ring, F.pmod(i - 1, size)), F.get(ring, F.pmod(i + 1, size))
        return F.struct(F.abs((p["dx"] - a["dx"]) * (b["dy"] - a["dy"]) - (b["dx"] - a["dx"]) * (p["dy"] - a["dy"])).alias("a"),
                        i.alias("i"))

    least = F.array(F.array_min(F.transform(ring, area))["i"])  # a variable of the function below, so computed once
    return F.element_at(F.transform(least, lambda i: F.concat(F.slice(ring, 1, i), F.slice(ring, i + 2, size))), 1)


def simplify_borders(vertices: DataFrame, n: int) -> DataFrame:
    """Drop the vertex spanning the smallest triangle until each ring has ``n`` vertices.

    A cell's ring is one array that is thinned as often as it needs, so a long
    ring costs nothing to the others and there is one shuffle.
    """
    rings = vertices.groupBy("chip", "cell_id").agg(F.sort_array(F.collect_list(F.struct("idx", "dx", "dy"))).alias("ring"))
    ring = F.transform("ring", lambda p: F.struct(p["dx"].alias("dx"), p["dy"].alias("dy")))
    spare = F.greatest(F.size("ring") - n, F.lit(0))
    thin = F.aggregate(F.array_repeat(F.lit(0), spare), ring, lambda r, _: _thinner(r))
    return (rings.select("chip", "cell_id", F.posexplode(thin).alias("idx", "p"))
            .select("chip", "cell_id", F.col("idx").cast("long").alias("idx"), "p.dx", "p.dy"))
