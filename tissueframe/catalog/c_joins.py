"""Spatial and key joins."""

from pyspark.sql import functions as F

from ..functions import geometry
from ..operators import cells, masks, registration, ranking, slots
from ..plans.islands import area
from . import query
from .sql_parts import big_enough, components_of, fragments_kept, overlap_merge_of, pixels_of, runs_of

RND = lambda c, n=6: F.round(c, n).alias(c)


@query("c01_assign_cells", """
select e.chip, e.gene, e.x, e.y, e.mid, coalesce(n.label, 0) cell_id
from expression e left join nuclei n on e.chip=n.chip and e.y=n.y and e.x between n.x0 and n.x1""")
def _(t):
    return cells.assign_cells(t.expression, t.nuclei)


@query("c02_tissue_cut", """
select chip, gene, x//10 bx, y//10 as by, cast(sum(mid) as bigint) mid from expression e
where exists (select 1 from tissue s where s.chip=e.chip and s.y=e.y and e.x between s.x0 and s.x1)
group by 1,2,3,4""")
def _(t):
    return cells.tissue_cut(t.expression, t.tissue, 10)


@query("c03_fit_mask", """
with ext as (select chip, max(x)-20 width, max(y)-20 height from expression group by chip),
px as (select distinct n.chip, label, y//2 y, x//2 x from (
  select r.chip, label, y, unnest(generate_series(greatest(x0,0), least(x1, width-1))) x
  from nuclei r join ext on r.chip=ext.chip where y>=0 and y<height and x1>=0 and x0<width) n),
g as (select *, x-row_number() over (partition by chip,label,y order by x) k from px)
select chip, label, y, min(x) x0, max(x) x1 from g group by chip, label, y, k""")
def _(t):
    extent = t.expression.groupBy("chip").agg((F.max("x") - 20).alias("width"), (F.max("y") - 20).alias("height"))
    return masks.fit_mask(t.nuclei, extent, 2)


PAIRS = """pairs as (select a.chip, a.label label_a, b.label label_b,
  cast(sum(least(a.x1,b.x1)-greatest(a.x0,b.x0)+1) as bigint) cnt
  from {a} a join {b} b on a.chip=b.chip and a.y=b.y and a.x0<=b.x1 and b.x0<=a.x1 group by 1,2,3)"""


@query("c04_overlap_pairs", "with " + PAIRS.format(a="nuclei", b="boundary") + " select * from pairs")
def _(t):
    from ..plans.buckets import overlap_pairs
    return overlap_pairs(t.nuclei, t.boundary)


@query("c05_largest_overlap_map", "with " + PAIRS.format(a="matrix", b="nuclei") + """,
d as (select chip, 'a_to_b' direction, label_a label, label_b partner, cnt from pairs
 union all select chip, 'b_to_a', label_b, label_a, cnt from pairs)
select * from d qualify row_number() over (partition by chip, direction, label order by cnt desc, partner desc)=1""")
def _(t):
    return masks.largest_overlap_map(t.matrix, t.nuclei)


FRACTION = PAIRS + """,
best as (select * from pairs qualify row_number() over (partition by chip, label_a order by cnt desc, label_b desc)=1),
asz as (select chip, label, sum(x1-x0+1) area from {s} group by 1,2)
select best.chip, label_a label, label_b partner, round(cnt/area, 6) fraction
from best join asz on asz.chip=best.chip and asz.label={k}"""


@query("c06_overlap_fraction", "with " + FRACTION.format(a="nuclei", b="boundary", s="boundary", k="label_b"))
def _(t):
    return masks.overlap_fraction(t.nuclei, t.boundary, "b").withColumn("fraction", F.round("fraction", 6))


@query("c06_overlap_fraction_own", "with " + FRACTION.format(a="nuclei", b="boundary", s="nuclei", k="label_a"))
def _(t):
    return masks.overlap_fraction(t.nuclei, t.boundary, "a").withColumn("fraction", F.round("fraction", 6))


MINUS = "d as (select a.* from {a} a left join {b} b on b.chip=a.chip and b.y=a.y and b.x=a.x where b.x is null)"
BOTH = ", ".join((pixels_of("boundary", "bp"), pixels_of("nuclei", "np")))


@query("c07_mask_minus", "with recursive " + ", ".join((
    BOTH, MINUS.format(a="bp", b="np"), components_of("d", "cc", 4), big_enough("cc", "fin", 15))) + " select * from fin")
def _(t):
    return masks.mask_minus(t.boundary, t.nuclei)


@query("c08_mask_and", "with recursive " + ", ".join((
    BOTH, "d as (select bp.* from bp join np on np.chip=bp.chip and np.y=bp.y and np.x=bp.x)",
    components_of("d", "cc", 4), big_enough("cc", "fin", 15))) + " select * from fin")
def _(t):
    return masks.mask_and(t.boundary, t.nuclei)


@query("c09_keep_large_fragments", "with recursive " + ", ".join((
    BOTH, MINUS.format(a="bp", b="np"), components_of("bp", "ob", 8), fragments_kept("ob", "d", "kept", 0.2),
    runs_of("kept", "fin"))) + " select * from fin")
def _(t):
    from ..plans.islands import subtract
    return masks.keep_large_fragments(t.boundary, subtract(t.boundary, t.nuclei), 0.2)


@query("c10_overlap_merge", "with recursive " + ", ".join((
    BOTH, overlap_merge_of("np", "bp", "res", 0.2), runs_of("res", "fin"))) + " select * from fin")
def _(t):
    return masks.overlap_merge(t.nuclei, t.boundary, 0.2)[1]


@query("c11_multimodal_merge", "with recursive " + ", ".join((
    BOTH, pixels_of("interior", "ip"), overlap_merge_of("ip", "bp", "first_", 0.5),
    overlap_merge_of("np", "first_", "second_", 0.8), runs_of("second_", "fin"))) + " select * from fin")
def _(t):
    return masks.multimodal_merge(t.nuclei, t.boundary, t.interior)[2]


@query("c12_merge_layers")
def _(t):
    empty = t.matrix.where("false")
    cell, core = masks.merge_layers(t.nuclei, t.boundary, t.interior, empty)
    return (cell.select(F.lit("cell").alias("layer"), "chip", "y", "x0", "x1")
            .unionByName(core.select(F.lit("nuclei").alias("layer"), "chip", "y", "x0", "x1")))


@query("c13_merge_conflict", """
with hit as (select distinct b.chip, b.label from nuclei a join boundary b
  on a.chip=b.chip and a.y=b.y and a.x0<=b.x1 and b.x0<=a.x1)
select 'membrane' layer, chip, label, y, x0, x1 from boundary b
 where not exists (select 1 from hit where hit.chip=b.chip and hit.label=b.label)
union all select 'nuclear', chip, label, y, x0, x1 from nuclei""")
def _(t):
    return masks.merge_conflict(t.nuclei, t.boundary)


@query("c14_cells_inside_tissue", """
with px as (select distinct chip, y, unnest(generate_series(x0,x1)) x from tissue),
cov as (select c.chip, c.label, count(*) n from (select chip, label, y, unnest(generate_series(x0,x1)) x from boundary) c
  join px on c.chip=px.chip and c.y=px.y and c.x=px.x group by 1,2),
sz as (select chip, label, sum(x1-x0+1) n from boundary group by 1,2)
select b.* from boundary b join sz on sz.chip=b.chip and sz.label=b.label
join cov on cov.chip=b.chip and cov.label=b.label where cov.n=sz.n""")
def _(t):
    return masks.cells_inside_tissue(t.boundary, t.tissue)


@query("c15_clip_to_polygon", """
with e as (select a.chip, a.k, a.x ax, a.y ay, b.x bx, b.y by_ from corner a join corner b
  on a.chip=b.chip and b.k=(a.k+1)%4)
select p.chip, p.cell_id, p.cx x, p.cy y from cells p join e on e.chip=p.chip
group by 1,2,3,4 having min((bx-ax)*(p.cy-ay)-(by_-ay)*(p.cx-ax))>=0 or max((bx-ax)*(p.cy-ay)-(by_-ay)*(p.cx-ax))<=0""")
def _(t):
    points = t.cells.select("chip", "cell_id", F.col("cx").alias("x"), F.col("cy").alias("y"))
    return geometry.clip_to_polygon(points, t.corner)


NEAR = """near as (select d.chip, d.id, s.ix, s.iy, (d.x-s.x)*(d.x-s.x)+(d.y-s.y)*(d.y-s.y) d2
  from track_point d join template_point s on d.chip=s.chip
   and s.x between d.x-{r} and d.x+{r} and s.y between d.y-{r} and d.y+{r}
  qualify row_number() over (partition by d.chip, d.id order by d2, s.ix, s.iy)=1)"""


@query("c16_pair_nearest", "with " + NEAR.format(r=10) + """
select chip, id, ix, iy, round(sqrt(d2),6) dist from near where d2<100""")
def _(t):
    return registration.pair_nearest(t.track_point.select("chip", "id", "x", "y"), t.template_point, 10).select(
        "chip", "id", "ix", "iy", RND("dist"))


@query("c16_pair_nearest_band", "with " + NEAR.format(r=10) + """
select chip, id, ix, iy, round(sqrt(d2),6) dist from near where d2>4 and d2<25""")
def _(t):
    return registration.pair_nearest(t.track_point.select("chip", "id", "x", "y"), t.template_point, 5, 2).select(
        "chip", "id", "ix", "iy", RND("dist"))


@query("c17_cell_density", """
select a.chip, a.cell_id, count(*)-1 density from cells a join cells b on a.chip=b.chip
and (a.cx-b.cx)*(a.cx-b.cx)+(a.cy-b.cy)*(a.cy-b.cy)<=100*100 group by 1,2""")
def _(t):
    return cells.cell_density(t.cells.select("chip", "cell_id", F.col("cx").alias("x"), F.col("cy").alias("y")), 100)


@query("c18_background_candidates", """
with bg as (select e.* from expression e where not exists (select 1 from nuclei n
  where n.chip=e.chip and n.y=e.y and e.x between n.x0 and n.x1))
select c.chip, c.cell_id, count(*) n, cast(sum(mid) as bigint) mid, min(x) x0, max(x) x1
from cells c join bg on bg.chip=c.chip and abs(bg.x-c.cx)<50 and abs(bg.y-c.cy)<50 group by 1,2""")
def _(t):
    found = cells.background_candidates(cells.assign_cells(t.expression, t.nuclei), t.cells, 50)
    return found.groupBy("chip", "cell_id").agg(
        F.count("*").alias("n"), F.sum("mid").cast("long").alias("mid"),
        F.min("x").alias("x0"), F.max("x").alias("x1"))


CENT = """cen as (select chip, label, sum((x0+x1)*(x1-x0+1))/(2*sum(x1-x0+1)) cx,
  sum(y*(x1-x0+1))/sum(x1-x0+1) cy from nuclei group by 1,2)"""


@query("c19_centroid_containment", "with " + CENT + """,
hit as (select m.chip, m.label, count(*) n from cen join matrix m on m.chip=cen.chip and m.y=floor(cen.cy+0.5)
  and floor(cen.cx+0.5) between m.x0 and m.x1 group by 1,2),
lab as (select distinct chip, label from matrix)
select lab.chip, lab.label, coalesce(n,0) n, case when coalesce(n,0)<2 then 'single' else 'multi' end kind
from lab left join hit on hit.chip=lab.chip and hit.label=lab.label""")
def _(t):
    return masks.centroid_containment(t.matrix, t.nuclei)


@query("c20_split_multi_cells", "with " + CENT + """,
hit as (select m.chip, m.label, cen.label ref, cx, cy from cen join matrix m on m.chip=cen.chip and m.y=floor(cen.cy+0.5)
 and floor(cen.cx+0.5) between m.x0 and m.x1),
multi as (select chip, label from hit group by 1,2 having count(*)>=2),
px as (select chip, label, y, unnest(generate_series(x0,x1)) x from matrix),
own as (select p.chip, p.y, p.x, h.ref from px p join multi u on u.chip=p.chip and u.label=p.label join hit h on h.chip=p.chip and h.label=p.label
 qualify row_number() over (partition by p.chip, p.label, p.y, p.x order by (p.x-cx)*(p.x-cx)+(p.y-cy)*(p.y-cy), ref)=1),
nb as (select chip, y+1 y, x, ref from own union all select chip, y-1, x, ref from own union all select chip, y, x+1, ref from own
 union all select chip, y, x-1, ref from own),
bad as (select distinct o.chip, o.y, o.x from own o join nb on nb.chip=o.chip and nb.y=o.y and nb.x=o.x and nb.ref<>o.ref),
res as (select distinct chip, y, x from own o where not exists (select 1 from bad b where b.chip=o.chip and b.y=o.y and b.x=o.x)
 union select chip, y, x from px p where not exists (select 1 from multi u where u.chip=p.chip and u.label=p.label)), """
       + runs_of("res", "fin") + " select * from fin")
def _(t):
    return masks.split_multi_cells(t.matrix, t.nuclei)


WINDOWS = """,
sz as (select chip, label, sum(x1-x0+1) area from nuclei group by 1,2),
st as (select chip, greatest(100, cast(floor(sqrt(avg(area))*1.5) as bigint)) step from sz group by chip),
win as (select cen.chip, label, cx, cy, floor(cy/step) wy, floor(cx/step) wx from cen join st on st.chip=cen.chip)"""


@query("c21_assign_scan_window", "with " + CENT + WINDOWS + """
select chip, label, dense_rank() over (partition by chip order by wy, wx) scan_window from win""")
def _(t):
    return ranking.assign_scan_window(masks.centroids(t.nuclei), min_step=100).select("chip", "label", "scan_window")


FOVLOC = "loc as (select distinct chip, fov_row, fov_col, fov_col*330 x, fov_row*330 y from track_point)"


@query("c22_nearest_fov", "with " + FOVLOC + """
select p.chip, p.id, case when p.y<l.y then fov_row2-1 else fov_row2 end fov_row,
 case when p.x<l.x then fov_col2-1 else fov_col2 end fov_col
from track_point p join (select chip, fov_row fov_row2, fov_col fov_col2, x, y from loc) l on p.chip=l.chip
qualify row_number() over (partition by p.chip, p.id
 order by (p.x-l.x)*(p.x-l.x)+(p.y-l.y)*(p.y-l.y), fov_row2, fov_col2)=1""")
def _(t):
    loc = registration.nominal_fov_locations(t.track_point, 330)
    return registration.nearest_fov(t.track_point.select("chip", "id", "x", "y"), loc, 330).select(
        "chip", "id", "fov_row", "fov_col")


@query("c22_fov_error", "with " + FOVLOC + ", " + NEAR.format(r=50) + """,
own as (select p.chip, p.id, case when p.y<l.y then r2-1 else r2 end fov_row,
 case when p.x<l.x then c2-1 else c2 end fov_col
 from track_point p join (select chip, fov_row r2, fov_col c2, x, y from loc) l on p.chip=l.chip
 qualify row_number() over (partition by p.chip, p.id
  order by (p.x-l.x)*(p.x-l.x)+(p.y-l.y)*(p.y-l.y), r2, c2)=1),
err as (select own.chip, fov_row, fov_col, avg(sqrt(d2)) e from near join own on own.chip=near.chip and own.id=near.id
 where d2<2500 group by 1,2,3)
select loc.chip, loc.fov_row, loc.fov_col, round(coalesce(e, -1), 6) error from loc
left join err on err.chip=loc.chip and err.fov_row=loc.fov_row and err.fov_col=loc.fov_col""")
def _(t):
    loc = registration.nominal_fov_locations(t.track_point, 330)
    pairs = registration.pair_nearest(t.track_point.select("chip", "id", "x", "y"), t.template_point, 50)
    return registration.fov_error(pairs, loc, 330).select("chip", "fov_row", "fov_col", RND("error"))


@query("c23_align_rank", """
with rot as (select chip, 0 rot, x, y, ix, iy from template_point
 union all select chip, 1, 1500-y, x, abs(iy-8), ix from template_point
 union all select chip, 2, 1500-x, 1500-y, abs(iy-8), abs(ix-8) from template_point
 union all select chip, 3, y, 1500-x, iy, abs(ix-8) from template_point),
z as (select chip, rot, x, y, sqrt((x-700)*(x-700)+(y-650)*(y-650)) d from rot where ix=0 and iy=0 and x>0 and y>0)
select chip, cast(rot as bigint) rot, 700-x offset_x, 650-y offset_y, round(d,6) dist from z
qualify row_number() over (partition by chip, rot order by round(d,9), x, y)=1""")
def _(t):
    return registration.align_rank(t.template_point, (1500, 1500), (700, 650), (700, 650)).select(
        "chip", "rot", F.round("offset_x").cast("long").alias("offset_x"),
        F.round("offset_y").cast("long").alias("offset_y"), RND("dist"))


@query("c24_image_size_consistency", """
select a.run, a.slot, a.channel_align target, a.w, a.h, b.w target_w, b.h target_h from slots a join slots b
on a.run=b.run and a.channel_align=b.slot where a.w<>b.w or a.h<>b.h""")
def _(t):
    return slots.image_size_consistency(t.slots)


@query("c25_mask_iou", """
with a as (select distinct chip, y, unnest(generate_series(x0,x1)) x from boundary),
b as (select distinct chip, y, unnest(generate_series(x0,x1)) x from tissue),
j as (select coalesce(a.chip,b.chip) chip, count(a.x) na, count(b.x) nb, count(a.x+b.x) nab, count(*) n
 from a full join b on a.chip=b.chip and a.y=b.y and a.x=b.x group by 1)
select chip, round(nab/(n+1e-5), 6) iou from j""")
def _(t):
    return masks.mask_iou(t.boundary, t.tissue).select("chip", RND("iou"))


@query("c26_overlap_keep_remove", """
with b as (select distinct chip, y, unnest(generate_series(x0,x1)) x from boundary),
a as (select chip, label, y, unnest(generate_series(x0,x1)) x from matrix)
select a.chip, a.label, round(count(b.x)/count(*), 6) ratio, count(b.x)/count(*)>0.2 keep
from a left join b on a.chip=b.chip and a.y=b.y and a.x=b.x group by 1,2""")
def _(t):
    return masks.overlap_keep_remove(t.matrix, t.boundary, 0.2).withColumn("ratio", F.round("ratio", 6))


@query("c27_overlap_report", "with " + PAIRS.format(a="nuclei", b="boundary") + """,
an as (select chip, label, sum(x1-x0+1) area from nuclei group by 1,2),
ab as (select chip, label, sum(x1-x0+1) area from boundary group by 1,2),
fa as (select chip, label_a label, max(cnt) cnt from pairs group by 1,2),
fb as (select chip, label_b label, max(cnt) cnt from pairs group by 1,2),
n as (select an.chip, count(*) nuclei, avg(case when coalesce(cnt,0)/area>=0.5 then 1.0 else 0 end) s
 from an left join fa on fa.chip=an.chip and fa.label=an.label group by 1),
c as (select ab.chip, count(*) cells_n, avg(case when coalesce(cnt,0)/area>=0.1 then 1.0 else 0 end) s
 from ab left join fb on fb.chip=ab.chip and fb.label=ab.label group by 1)
select n.chip, nuclei, round(n.s,6) nuclei_share, cells_n as "cells", round(c.s,6) cells_share from n join c on n.chip=c.chip""")
def _(t):
    return masks.overlap_report(t.nuclei, t.boundary).select(
        "chip", "nuclei", "cells", RND("nuclei_share"), RND("cells_share"))


@query("c28_reuse_registration", """
select a.run, a.slot, a.tech, case when a.reuse>=0 then b.slot else a.slot end source_slot,
 case when a.reuse>=0 then b.bal else a.bal end score
from slots a left join slots b on a.run=b.run and a.reuse=b.slot""")
def _(t):
    return slots.reuse_registration(t.slots, "bal")


@query("c29_filter_cells_by_list", """
select e.chip, n.label cell_id, gene, cast(sum(mid) as bigint) mid
from expression e join nuclei n on e.chip=n.chip and e.y=n.y and e.x between n.x0 and n.x1
join cells c on c.cell_id=n.label where c.has_boundary group by 1,2,3""")
def _(t):
    matrix = cells.cell_gene_matrix(cells.assign_cells(t.expression, t.nuclei))
    flags = t.cells.select("chip", "cell_id", (~F.col("has_boundary")).cast("int").alias("flag"))
    return cells.filter_cells_by_list(matrix, flags)
