"""Ranking, ordering, positions and top-k."""

from pyspark.sql import functions as F

from ..operators import borders, cells, components, masks, morphology, ranking, registration, slots, stitching
from ..plans import islands
from . import query
from .bindings import TRACK
from .c_joins import CENT, WINDOWS

PREFIX, TEMPLATE = registration.track_prefix(TRACK), (TRACK, TRACK)
R = lambda *names, n=6: [F.round(c, n).alias(c) for c in names]


@query("e01_consecutive_labels", """
with l as (select distinct chip, label from boundary)
select chip, label, row_number() over (partition by chip order by label) new_label from l""")
def _(t):
    return components.consecutive_labels(t.boundary)


@query("e02_scan_order_labels", "with " + CENT + WINDOWS + """,
w as (select chip, label, cx, cy, dense_rank() over (partition by chip order by wy, wx) scan_window from win)
select chip, label, scan_window, row_number() over (partition by chip, scan_window order by cy, cx, label) local_index,
 row_number() over (partition by chip order by scan_window, cy, cx, label) new_label from w""")
def _(t):
    return ranking.scan_order_labels(masks.centroids(t.nuclei), min_step=100).select(
        "chip", "label", "scan_window", "local_index", "new_label")


@query("e03_dedupe_first", """
with a as (select c.chip, c.cell_id, e.gene, e.x, e.y, e.mid from cells c join expression e on e.chip=c.chip
 and abs(e.x-c.cx)<30 and abs(e.y-c.cy)<30)
select chip, gene, x, y, mid, min(cell_id) cell_id from a group by 1,2,3,4,5""")
def _(t):
    near = cells.background_candidates(t.expression.withColumn("cell_id", F.lit(0)), t.cells, 30)
    return cells.dedupe_first(near, ("chip", "gene", "x", "y", "mid"))


@query("e04_rotated_nms")
def _(t):
    return ranking.rotated_nms(t.detection, conf=250).select("img", "id", "score", "rank")


CENTER = """cp as (select p.chip, p.fov_row, p.fov_col, id, x, y, row_number() over (partition by p.chip, p.fov_row, p.fov_col
 order by round((x-mx)*(x-mx)+(y-my)*(y-my),6), id) "rank" from track_point p join
 (select chip, fov_row, fov_col, avg(x) mx, avg(y) my from track_point group by 1,2,3) m
 on m.chip=p.chip and m.fov_row=p.fov_row and m.fov_col=p.fov_col)"""
FOV = ("chip", "fov_row", "fov_col")


@query("e05_center_points", "with " + CENTER + ' select * from cp where "rank"<=5')
def _(t):
    return registration.center_points(t.track_point.select(*FOV, "id", "x", "y"), 5, FOV)


@query("e06_top_density_tiles", """
with p as (select distinct chip, label, y//64 ty, unnest(generate_series(x0//64, x1//64)) tx from nuclei),
c as (select chip, ty, tx, count(*) objects from p group by 1,2,3),
r as (select *, row_number() over (partition by chip order by objects desc, ty, tx) "rank" from c)
select * from r where "rank"<=5""")
def _(t):
    return ranking.top_density_tiles(t.nuclei, 64)


VALLEY = """marg as (select chip, 'x' axis, x pos, sum(mid) total from dnb group by 1,2,3
  union all select chip, 'y', y, sum(mid) from dnb group by 1,2,3),
len as (select chip, axis, max(pos)+1 n from marg group by 1,2),
cand as (select chip, axis, unnest(generate_series(1, n-253)) shift from len where n-253>=1),
hit as (select chip, axis, pos-unnest([{p}]) shift, total from marg),
tot as (select c.chip, c.axis, c.shift, coalesce(sum(h.total),0) s from cand c left join hit h
  on h.chip=c.chip and h.axis=c.axis and h.shift=c.shift group by 1,2,3),
val as (select chip, axis, shift+1 as first, cast(s as bigint) total from tot
  qualify row_number() over (partition by chip, axis order by s, shift)=1)""".format(p=",".join(map(str, PREFIX)))


def _first(t):
    marginals = registration.axis_marginals(t.dnb)
    return marginals, registration.track_valley(marginals, template=TEMPLATE)


def _positions(t):
    marginals, first = _first(t)
    length = marginals.groupBy("chip", "axis").agg((F.max("pos") + 1).alias("length"))
    return registration.cyclic_positions(first.join(length, ["chip", "axis"]).select("chip", "axis", "first", "length"), TEMPLATE)


POS = VALLEY + """,
ks as (select v.chip, v.axis, v.first, l.n, unnest(generate_series(-9*3, 9*3)) k from val v join len l on l.chip=v.chip and l.axis=v.axis),
pos as (select chip, axis, first+cast(floor(k/9) as bigint)*294+list_extract([{p}], ((k%9)+9)%9+1) pos, ((k%9)+9)%9 idx, n from ks),
fin as (select chip, axis, pos, idx from pos where pos>=0 and pos<=n)""".format(p=",".join(map(str, PREFIX)))


@query("e07_cyclic_positions", "with " + POS + " select * from fin")
def _(t):
    return _positions(t)


@query("e07_template_lattice", "with " + POS + """
select a.chip, a.pos x, b.pos y, a.idx ix, b.idx iy from fin a join fin b on a.chip=b.chip and a.axis='x' and b.axis='y'""")
def _(t):
    return registration.template_lattice(_positions(t))


@query("e08_track_valley", "with " + VALLEY + " select * from val")
def _(t):
    return _first(t)[1]


@query("e09_runs_from_pixels", """
with p as (select img chip, v//64 label, y, x from pixel),
g as (select *, x-row_number() over (partition by chip, label, y order by x) k from p)
select chip, label, y, min(x) x0, max(x) x1 from g group by chip, label, y, k""")
def _(t):
    return islands.runs_from_pixels(t.pixel.select(F.col("img").alias("chip"), F.floor(F.col("v") / 64).alias("label"), "y", "x"))


SNAKE = "(case when (k//20)%2=1 then 19-k%20 else k%20 end)"


@query("e10_snake_reorder", f"""
select 'RD' mode, slide, k, k//20 r, {SNAKE} c from fov union all select 'LD', slide, k, k//20, 19-{SNAKE} from fov
union all select 'RU', slide, k, 19-k//20, {SNAKE} from fov union all select 'LU', slide, k, 19-k//20, 19-{SNAKE} from fov""")
def _(t):
    out = None
    for mode in ("RD", "LD", "RU", "LU"):
        part = stitching.snake_reorder(t.fov.select("slide", "k"), 20, 20, mode).withColumn("mode", F.lit(mode))
        out = part if out is None else out.unionByName(part)
    return out


@query("e11_mechanical_location", "select slide, r, c, c*1800 x, r*1350 y from fov")
def _(t):
    return stitching.mechanical_location(t.fov, 2000, 1500, 0.1)


@query("e12_line_scan_location", """
with med as (select slide, c, trunc(quantile_cont(dx,0.5)) dx, trunc(quantile_cont(dy,0.5)) dy from fov_jitter where axis='h' group by 1,2),
cols as (select f.slide, f.c, dx, dy from (select distinct slide, c from fov) f left join med on med.slide=f.slide and med.c=f.c),
par as (select slide, round_even(avg(case when c%2=0 then dx end),0) ex, round_even(avg(case when c%2=0 then dy end),0) ey,
 round_even(avg(case when c%2=1 then dx end),0) ox, round_even(avg(case when c%2=1 then dy end),0) oy from cols where dx is not null group by slide),
st as (select k.slide, c, coalesce(dx, case when c%2=1 then ox else ex end) sx, coalesce(dy, case when c%2=1 then oy else ey end) sy
 from cols k join par on par.slide=k.slide where c>0),
cum as (select slide, c, sum(sx+2000) over (partition by slide order by c) x, sum(sy) over (partition by slide order by c) y from st)
select f.slide, f.r, f.c, cast(coalesce(cum.x, f.c*1800) as bigint) x, cast(f.r*1800+coalesce(cum.y,0) as bigint) y
from fov f left join cum on cum.slide=f.slide and cum.c=f.c""")
def _(t):
    return stitching.line_scan_location(t.fov, t.fov_jitter, 2000, 2000, 0.1)


@query("e13_valid_border_length", "select cell_id, max(n) length from border_vertex group by cell_id")
def _(t):
    pad = F.when(F.col("cell_id") % 2 == 0, F.lit(borders.PAD_MAX)).otherwise(F.lit(borders.PAD_ZERO))
    packed = borders.pack_borders(t.border_vertex, 32, pad)
    return packed.select("cell_id", borders.valid_border_length(F.col("border")).alias("length"))


@query("e14_snap_tissue_corners", """
with px as (select chip, label, y, unnest(generate_series(x0,x1)) x from matrix),
ar as (select chip, label, count(*) area from px group by 1,2 qualify row_number() over (partition by chip order by area desc, label desc)=1),
o as (select px.* from px join ar on ar.chip=px.chip and ar.label=px.label),
edge as (select * from o where (select count(*) from o q where q.chip=o.chip and abs(q.y-o.y)+abs(q.x-o.x)=1)<4),
b as (select chip, min(x) l, max(x) r, min(y) t, max(y) b from edge group by chip),
k as (select chip, 0 k, l x, t y from b union all select chip, 1, r, t from b union all select chip, 2, r, b from b union all select chip, 3, l, b from b)
select e.chip, cast(k.k as bigint) k, e.x, e.y from edge e join k on k.chip=e.chip
qualify row_number() over (partition by e.chip, k.k order by (e.x-k.x)*(e.x-k.x)+(e.y-k.y)*(e.y-k.y), e.y, e.x)=1""")
def _(t):
    edge = islands.pixels_from_runs(morphology.outline(t.matrix))
    return ranking.snap_tissue_corners(edge.join(islands.area(t.matrix), ["chip", "label"]))


@query("e15_best_layer", """
with f as (select run, tech layer, count(*)+count(case when reuse>=0 then 1 end)+count(case when bal>2000 then 1 end) n from slots group by 1,2)
select run, layer, n fields from f qualify row_number() over (partition by run order by n desc, layer)=1""")
def _(t):
    fields = t.slots.select("run", F.col("tech").alias("layer"), F.col("slot").cast("double").alias("slot"),
                            F.when(F.col("reuse") >= 0, F.col("reuse").cast("double")).alias("reuse"),
                            F.when(F.col("bal") > 2000, F.col("bal")).alias("score"))
    return slots.best_layer(fields.unpivot(["run", "layer"], ["slot", "reuse", "score"], "name", "value"))
