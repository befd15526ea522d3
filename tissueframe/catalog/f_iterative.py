"""Components, morphology, graph and iterative operators."""

from pyspark.sql import functions as F

from ..operators import borders, cells, cluster, components, masks, morphology, registration, stitching
from ..plans import islands
from . import query
from .bindings import TRACK
from .sql_parts import components_of, pixels_of

FOV = ("chip", "fov_row", "fov_col")


@query("f01_connected_components_4")
def _(t):
    return components.connected_components(t.tissue, 4)


@query("f01_connected_components_8", "with recursive both_layers as (select * from mask_run where layer in ('boundary','nuclei')), "
       + pixels_of("both_layers", "px") + ", " + components_of("px", "fin", 8) + " select * from fin")
def _(t):
    return components.connected_components(t.mask_run.where("layer in ('boundary', 'nuclei')"), 8)


@query("f01b_point_components")
def _(t):
    return components.point_components(t.track_point.select("chip", "id", "x", "y"), 36).select("chip", "id", "root")


@query("f02_expand_labels")
def _(t):
    return morphology.expand_labels(t.nuclei, 10)


@query("f03_fov_global_location")
def _(t):
    clean = stitching.jitter_consensus(t.fov_jitter)
    return stitching.fov_global_location(t.fov.select("slide", "r", "c"), clean, 2000, 2000, 0.1)


@query("f04_dilate", """
with px as (select distinct chip, y+dy y, x+dx x from (select chip, y, unnest(generate_series(x0,x1)) x from interior),
 (select unnest(generate_series(-3,3)) dy), (select unnest(generate_series(-3,3)) dx)),
g as (select *, x-row_number() over (partition by chip, y order by x) k from px)
select chip, cast(1 as bigint) label, y, min(x) x0, max(x) x1 from g group by chip, y, k""")
def _(t):
    return morphology.dilate(t.interior, 3)


@query("f04_erode", """
with px as (select distinct chip, y, unnest(generate_series(x0,x1)) x from boundary),
hit as (select p.chip, p.y, p.x from px p join (select chip, y+dy y, x+dx x from px,
 (select unnest(generate_series(-1,1)) dy), (select unnest(generate_series(-1,1)) dx)) q on q.chip=p.chip and q.y=p.y and q.x=p.x
 group by 1,2,3 having count(*)=9),
g as (select *, x-row_number() over (partition by chip, y order by x) k from hit)
select chip, cast(1 as bigint) label, y, min(x) x0, max(x) x1 from g group by chip, y, k""")
def _(t):
    return morphology.erode(t.boundary, 1)


@query("f04_outline", """
with px as (select chip, label, y, unnest(generate_series(x0,x1)) x from boundary),
hit as (select p.chip, p.label, p.y, p.x, count(q.chip) n from px p left join (
 select chip, label, y+1 y, x from px union all select chip, label, y-1, x from px
 union all select chip, label, y, x+1 from px union all select chip, label, y, x-1 from px) q
 on q.chip=p.chip and q.label=p.label and q.y=p.y and q.x=p.x group by 1,2,3,4 having count(q.chip)<4),
g as (select *, x-row_number() over (partition by chip, label, y order by x) k from hit)
select chip, label, y, min(x) x0, max(x) x1 from g group by chip, label, y, k""")
def _(t):
    return morphology.outline(t.boundary)


@query("f05_distance_band", """
with d as (select r.chip, r.y+dy y, unnest(generate_series(x0-5, x1+5)) x, x0, x1, dy from interior r, (select unnest(generate_series(-5,5)) dy)),
m as (select chip, y, x, min(dy*dy+greatest(0,x0-x,x-x1)*greatest(0,x0-x,x-x1)) d2 from d group by 1,2,3)
select chip, d2, count(*) n, min(x) min_x, max(y) max_y from m where d2>0 and d2<=25 group by 1,2""")
def _(t):
    band = morphology.distance_band(t.interior, 5)
    return band.groupBy("chip", "d2").agg(F.count("*").alias("n"), F.min("x").alias("min_x"), F.max("y").alias("max_y"))


@query("f06_instance_to_semantic", """
with px as (select chip, label, y, unnest(generate_series(x0,x1)) x from boundary),
f as (select chip, max(y)+1 h, max(x1)+1 w from boundary group by 1)
select p.chip, p.y, p.x, 1 v from px p join f on f.chip=p.chip left join px d on d.chip=p.chip and d.y=p.y+1 and d.x=p.x+1
left join px s on s.chip=p.chip and s.y=p.y+1 and s.x=p.x left join px e on e.chip=p.chip and e.y=p.y and e.x=p.x+1
where p.y=h-1 or p.x=w-1 or (coalesce(d.label,0)=p.label and coalesce(s.label,0)=coalesce(e.label,0))""")
def _(t):
    frame = t.boundary.groupBy("chip").agg((F.max("y") + 1).alias("h"), (F.max("x1") + 1).alias("w"))
    return morphology.instance_to_semantic(islands.pixels_from_runs(t.boundary), frame)


@query("f07_fill_holes")
def _(t):
    return morphology.fill_holes(t.tissue, 2000)


@query("f08_best_tissue_mask")
def _(t):
    return morphology.best_tissue_mask(t.tissue, t.nuclei, 30)


@query("f09_pca_features")
def _(t):
    out = cluster.pca_features(t.embeddings, "embedding", 8)
    return out.select("vec_id", *[F.round(F.col("pca")[i], 4).alias(f"pc{i}") for i in range(8)])


@query("f10_knn_graph", """
with v as (select vec_id, cast(embedding as double[]) f from embeddings),
d as (select a.vec_id src, b.vec_id dst, list_distance(a.f, b.f) dist from v a join v b on a.vec_id<>b.vec_id)
select src, dst, round(dist, 5) dist, row_number() over (partition by src order by round(dist, 9), dst) "rank" from d qualify "rank"<=10""")
def _(t):
    return cluster.knn_graph(t.embeddings, "vec_id", "embedding", 10).withColumn("dist", F.round("dist", 5))


@query("f10_spatial_knn", """
select a.chip, a.cell_id src, b.cell_id dst, (a.cx-b.cx)*(a.cx-b.cx)+(a.cy-b.cy)*(a.cy-b.cy) d2,
 row_number() over (partition by a.chip, a.cell_id order by (a.cx-b.cx)*(a.cx-b.cx)+(a.cy-b.cy)*(a.cy-b.cy), b.cell_id) "rank"
from cells a join cells b on a.chip=b.chip and a.cell_id<>b.cell_id qualify "rank"<=8""")
def _(t):
    return cluster.spatial_knn(t.cells.select("chip", F.col("cell_id").alias("id"), F.col("cx").alias("x"), F.col("cy").alias("y")), 8, 20)


@query("f11_community_labels")
def _(t):
    return cluster.community_labels(cluster.knn_graph(t.embeddings, "vec_id", "embedding", 10))


@query("f12_rotate_search", """
with m as (select chip, fov_row, fov_col, avg(x) mx, avg(y) my from track_point group by 1,2,3),
cp as (select p.*, row_number() over (partition by p.chip, p.fov_row, p.fov_col order by round((x-mx)*(x-mx)+(y-my)*(y-my),6), id) rk
 from track_point p join m on m.chip=p.chip and m.fov_row=p.fov_row and m.fov_col=p.fov_col),
h as (select p.chip, p.fov_row, p.fov_col, c.rk, a.a, count(*) hits,
 round(avg(abs(sin(radians(a.a))*(p.x-c.x)-cos(radians(a.a))*(p.y-c.y))),6) me
 from track_point p join cp c on c.rk<=5 and p.chip=c.chip and p.fov_row=c.fov_row and p.fov_col=c.fov_col, (select unnest(generate_series(-45,44)) a) a
 where round(abs(sin(radians(a.a))*(p.x-c.x)-cos(radians(a.a))*(p.y-c.y)),9)<=10 group by 1,2,3,4,5),
b as (select * from h qualify row_number() over (partition by chip, fov_row, fov_col, rk order by hits desc, me, a)=1),
v as (select chip, fov_row, fov_col, a, count(*) votes, min(rk) f from b group by 1,2,3,4)
select chip, fov_row, fov_col, a angle, votes from v qualify row_number() over (partition by chip, fov_row, fov_col order by votes desc, f)=1""")
def _(t):
    return registration.rotate_search(t.track_point.select(*FOV, "id", "x", "y"), FOV)


@query("f13_scale_search")
def _(t):
    return registration.scale_search(t.track_point.select(*FOV, "id", "x", "y"), FOV, (0.8, 0.9, 1.0, 1.1, 1.2), template=(TRACK, TRACK))


@query("f14_gmm_correct")
def _(t):
    return cluster.gmm_correct(cells.assign_cells(t.expression, t.nuclei), t.cells, 50, 20.0)


@query("f15_simplify_borders")
def _(t):
    return borders.simplify_borders(t.border_vertex, 16)
