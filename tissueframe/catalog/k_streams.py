"""Streaming forms, run to completion over the given points."""

from pyspark.sql import functions as F

from ..session import scratch
from ..streaming import incremental
from . import query
from .d_aggregates import OBS


def _chunks(t):
    path = scratch(t.spark, "chunks")
    t.expression.repartition(8, "y").write.parquet(path)
    return path


@query("k01_stream_dnb", "select chip, x, y, least(cast(sum(mid) as bigint), 255) mid from expression group by chip, x, y")
def _(t):
    out = scratch(t.spark, "dnb")
    incremental.stream_dnb(t.spark, _chunks(t), out, scratch(t.spark, "state"), 4).awaitTermination()
    return incremental.read_dnb(t.spark, out)


@query("k02_stream_cell_counts", "with " + OBS + """
select o.chip, o.cell_id, area, round(cx,6) cx, round(cy,6) cy, mid, n_gene, n_dnb, coalesce(c.n, 0) n from obs o
left join (select e.chip, n.label cell_id, count(*) n from expression e
 join nuclei n on e.chip=n.chip and e.y=n.y and e.x between n.x0 and n.x1 group by 1,2) c on c.chip=o.chip and c.cell_id=o.cell_id""")
def _(t):
    out = scratch(t.spark, "counts")
    incremental.stream_cell_counts(t.spark, _chunks(t), t.nuclei, out, scratch(t.spark, "state"), 4).awaitTermination()
    return incremental.read_cell_obs(t.spark, out, t.nuclei).withColumns({c: F.round(c, 6) for c in ("cx", "cy")})
