"""Aggregations over points, masks, images and fields of view."""

from pyspark.sql import functions as F

from ..functions import intensity
from ..operators import cells, images, masks, morphology, registration, slots, stitching
from ..plans.islands import area
from . import query

R = lambda *names, n=6: [F.round(c, n).alias(c) for c in names]
ASSIGNED = """assigned as (select e.*, coalesce(n.label,0) cell_id from expression e left join nuclei n
 on e.chip=n.chip and e.y=n.y and e.x between n.x0 and n.x1)"""
OBS = ASSIGNED + """,
shape as (select chip, label cell_id, cast(sum(x1-x0+1) as bigint) area,
 sum((x0+x1)*(x1-x0+1))/(2*sum(x1-x0+1)) cx, sum(y*(x1-x0+1))/sum(x1-x0+1) cy from nuclei group by 1,2),
cnt as (select chip, cell_id, cast(sum(mid) as bigint) mid, count(distinct gene) n_gene, count(distinct x*100000+y) n_dnb
 from assigned where cell_id>0 group by 1,2),
obs as (select s.*, coalesce(mid,0) mid, coalesce(n_gene,0) n_gene, coalesce(n_dnb,0) n_dnb
 from shape s left join cnt on cnt.chip=s.chip and cnt.cell_id=s.cell_id)"""


def assigned(t):
    return cells.assign_cells(t.expression, t.nuclei)


def obs(t):
    return cells.cell_obs(assigned(t), t.nuclei)


@query("d01_dnb_heatmap", """
select chip, x, y, least(cast(sum(mid) as bigint), 255) mid from expression group by chip, x, y""")
def _(t):
    return cells.dnb_heatmap(t.expression, 8)


@query("d02_bin_heatmap", """
select chip, x//20 bx, y//20 as "by", cast(sum(mid) as bigint) mid from expression group by 1,2,3""")
def _(t):
    return cells.bin_heatmap(t.expression, 20)


@query("d03_bin_gene_matrix", """
select chip, gene, x//50 bx, y//50 as "by", cast(sum(mid) as bigint) mid from expression group by 1,2,3,4""")
def _(t):
    return cells.bin_gene_matrix(t.expression, 50)


@query("d04_cell_gene_matrix", "with " + ASSIGNED + """
select chip, cell_id, gene, cast(sum(mid) as bigint) mid from assigned where cell_id>0 group by 1,2,3""")
def _(t):
    return cells.cell_gene_matrix(assigned(t))


@query("d05_cell_obs", "with " + OBS + """
select chip, cell_id, area, round(cx,6) cx, round(cy,6) cy, mid, n_gene, n_dnb from obs""")
def _(t):
    return obs(t).select("chip", "cell_id", "area", *R("cx", "cy"), "mid", "n_gene", "n_dnb")


@query("d06_cell_summary", "with " + OBS + """
select chip, count(*) n_cells, cast(floor(avg(area)) as bigint) mean_area,
 cast(floor(quantile_cont(area,0.5)) as bigint) median_area, cast(floor(avg(n_gene)) as bigint) mean_n_gene,
 cast(floor(quantile_cont(n_gene,0.5)) as bigint) median_n_gene, cast(floor(avg(mid)) as bigint) mean_mid,
 cast(floor(quantile_cont(mid,0.5)) as bigint) median_mid from obs group by chip""")
def _(t):
    return cells.cell_summary(obs(t))


@query("d07_fraction_rich_cells", "with " + OBS + """
select chip, round(avg(case when n_gene>2 then 1.0 else 0 end),6) fraction,
 printf('%.1f%%', avg(case when n_gene>2 then 1.0 else 0 end)*100) percent from obs group by chip""")
def _(t):
    return cells.fraction_rich_cells(obs(t), 2).select("chip", *R("fraction"), "percent")


@query("d08_cell_to_tissue_ratio", "with " + ASSIGNED + """,
tis as (select chip, sum(mid) m from expression e where exists (select 1 from tissue s where s.chip=e.chip and s.y=e.y
 and e.x between s.x0 and s.x1) group by chip)
select a.chip, cast(coalesce(sum(case when cell_id>0 then mid end),0) as bigint) cell_mid,
 cast(max(tis.m) as bigint) base_mid, round(sum(case when cell_id>0 then mid end)/max(tis.m),6) ratio
from assigned a join tis on tis.chip=a.chip group by a.chip""")
def _(t):
    return cells.cell_to_tissue_ratio(assigned(t), cells.tissue_cut(t.expression, t.tissue)).select(
        "chip", "cell_mid", "base_mid", *R("ratio"))


@query("d09_five_number", "with " + OBS + """,
l as (select chip, unnest(['area','mid','n_gene']) as name, unnest([area,mid,n_gene]) as value from obs),
q as (select chip, name, min(value) mn, quantile_cont(value,0.25) q1, quantile_cont(value,0.5) q2,
 quantile_cont(value,0.75) q3, max(value) mx from l group by 1,2)
select l.chip, l.name, round(max(mn),3) "min", round(max(q1),3) q1, round(max(q2),3) median, round(max(q3),3) q3,
 round(max(mx),3) "max", cast(sum(case when value<=q3+2*(q3-q1) then 1 else 0 end) as bigint) plotted
from l join q on q.chip=l.chip and q.name=l.name group by 1,2""")
def _(t):
    return cells.five_number(obs(t), ("area", "mid", "n_gene"))


@query("d10_axis_marginals", """
select chip, 'x' axis, x pos, cast(sum(mid) as bigint) total from dnb group by 1,2,3
union all select chip, 'y', y, cast(sum(mid) as bigint) from dnb group by 1,2,3""")
def _(t):
    return registration.axis_marginals(t.dnb)


@query("d11_mass_center", """
select chip, round(sum(x*mid)/sum(mid),6) x, round(sum(y*mid)/sum(mid),6) y from expression group by chip""")
def _(t):
    return registration.mass_center(t.expression).select("chip", *R("x", "y"))


@query("d12_chip_box", """
with ext as (select chip, (max(x)+1)//4 gw, (max(y)+1)//4 gh from dnb group by chip),
g as (select chip, gw, gh, gy, unnest(generate_series(0, gw-1)) gx from
  (select *, unnest(generate_series(0, gh-1)) gy from ext)),
near as (select distinct d.chip, gy, gx from (select chip, gx, unnest(generate_series((y-12+3)//4, (y+8)//4)) gy, y
   from (select chip, y, x, unnest(generate_series((x-12+3)//4, (x+8)//4)) gx from dnb)) d),
cov as (select g.chip, g.gy, g.gx, gw, gh, case when n.chip is null then 0 else 1 end v from g left join near n
  on n.chip=g.chip and n.gy=g.gy and n.gx=g.gx),
h as (select *, sum(v) over (partition by chip, gy order by gx rows between current row and 89 following) hs from cov),
b as (select *, sum(hs) over (partition by chip, gx order by gy rows between current row and 89 following) s from h)
select chip, gx*4 x, gy*4 y, cast(s as bigint) covered from b where gx<gw-90 and gy<gh-90
qualify row_number() over (partition by chip order by s desc, gy, gx)=1""")
def _(t):
    return registration.chip_box_from_expression(t.dnb, 360)


@query("d13_area_ratio", """
with a as (select distinct chip, y, unnest(generate_series(x0,x1)) x from nuclei),
b as (select distinct chip, y, unnest(generate_series(x0,x1)) x from tissue)
select b.chip, round(count(a.x)/count(*),6) ratio from b left join a on a.chip=b.chip and a.y=b.y and a.x=b.x group by 1""")
def _(t):
    return images.area_ratio(t.nuclei, t.tissue).select("chip", *R("ratio"))


def chip_pixels(t):
    return t.pixel.withColumnRenamed("img", "chip")


@query("d14_intensity_ratio", """
with a as (select distinct chip, y, unnest(generate_series(x0,x1)) x from nuclei),
b as (select distinct chip, y, unnest(generate_series(x0,x1)) x from tissue)
select p.img chip, round(sum(case when a.x is not null then v else 0 end)/sum(v),6) ratio from pixel p
join b on b.chip=p.img and b.y=p.y and b.x=p.x left join a on a.chip=p.img and a.y=p.y and a.x=p.x group by 1""")
def _(t):
    return images.intensity_ratio(t.nuclei, t.tissue, chip_pixels(t)).select("chip", *R("ratio"))


MEANS = """m as (select n.chip, n.label, coalesce(sum(v),0) s from nuclei n left join pixel p
 on p.img=n.chip and p.y=n.y and p.x between n.x0 and n.x1 group by 1,2),
ar as (select chip, label, sum(x1-x0+1) a from nuclei group by 1,2),
means as (select m.chip, m.label, s/a as mean from m join ar on ar.chip=m.chip and ar.label=m.label)"""


@query("d15_object_intensity", "with " + MEANS + " select chip, label, round(mean,6) mean from means")
def _(t):
    return images.object_intensity(t.nuclei, chip_pixels(t)).select("chip", "label", *R("mean"))


@query("d15_intensity_histogram", "with " + MEANS + """
select chip, cast(floor(mean/8) as bigint) bin, count(*) n from means group by 1,2""")
def _(t):
    return images.intensity_histogram(images.object_intensity(t.nuclei, chip_pixels(t)), 8)


TRACE = """trace as (select chip, label, max(y)-min(y)+1 h, max(x1)-min(x0)+1 w,
 cast(sum(x1-x0+1) as bigint) area from matrix group by 1,2)"""


@query("d16_object_trace", "with " + TRACE + " select * from trace where not (h=11 and w=33)")
def _(t):
    frame = t.cells.select("chip").distinct().select("chip", F.lit(11).alias("h"), F.lit(33).alias("w"))
    return cells.object_trace(t.matrix, frame)


@query("d17_trace_exceed", "with " + TRACE + """
select chip, round(avg(case when area>140 then 1.0 else 0 end),6) area_share,
 round(avg(case when h>10 then 1.0 else 0 end),6) height_share,
 round(avg(case when w>10 then 1.0 else 0 end),6) width_share from trace group by chip""")
def _(t):
    return cells.trace_exceed(cells.object_trace(t.matrix), 140, 10).select(
        "chip", *R("area_share", "height_share", "width_share"))


@query("d18_uncovered_tiles", """
with a as (select distinct chip, y, unnest(generate_series(x0,x1)) x from nuclei),
b as (select distinct chip, y, unnest(generate_series(x0,x1)) x from tissue),
bare as (select b.* from b left join a on a.chip=b.chip and a.y=b.y and a.x=b.x where a.x is null),
f as (select chip, y//5 ty, x//5 tx, count(*) n from bare group by 1,2,3),
c as (select chip, count(*) tiles from f where n=25 group by chip),
ta as (select chip, count(*) n from b group by chip)
select ta.chip, coalesce(tiles,0) tiles, round(coalesce(tiles,0)*25/n,6) missing_ratio from ta left join c on c.chip=ta.chip""")
def _(t):
    return images.uncovered_tiles(t.tissue, t.nuclei, 5).select("chip", "tiles", *R("missing_ratio"))


@query("d19_clarity_counts", "select img, cls, count(*) n from tile_class group by 1,2")
def _(t):
    return images.clarity_counts(t.tile_class)


@query("d19_clarity_score", """
select img, round(sum(case cls when 1 then 1.0 when 2 then 0.2 when 4 then 0.9 else 0 end)
 /sum(case when cls<>0 then 1 else 0 end),6) score from tile_class group by img""")
def _(t):
    return images.clarity_score(t.tile_class).select("img", *R("score"))


@query("d20_fov_track_score", """
with f as (select chip, fov_row, fov_col, count(*) n, avg(conf_pct/100) conf, min(angle) angle from track_point
 where conf_pct>50 group by 1,2,3),
s as (select chip, sum((case when n>=20 then 2 when n>=5 then 1 else 0 end)/2*conf) score,
 sum(case when n>=5 then 1 else 0 end) good_fov from f group by 1),
m as (select chip, angle from f where n>=5 group by chip, angle
 qualify row_number() over (partition by chip order by count(*) desc, angle)=1)
select s.chip, round(score,6) score, cast(good_fov as bigint) good_fov, angle from s left join m on m.chip=s.chip""")
def _(t):
    track = t.track_point.withColumn("conf", F.col("conf_pct") / 100).where(F.col("conf") > 0.5)
    return registration.fov_track_score(track).select("chip", *R("score"), "good_fov", "angle")


NEAREST = """near as (select d.chip, d.id, d.x-s.x ddx, d.y-s.y ddy, (d.x-s.x)*(d.x-s.x)+(d.y-s.y)*(d.y-s.y) d2
  from track_point d join template_point s on d.chip=s.chip
   and s.x between d.x-10 and d.x+10 and s.y between d.y-10 and d.y+10
  qualify row_number() over (partition by d.chip, d.id order by d2, s.ix, s.iy, s.x, s.y)=1)"""


@query("d21_template_eval", "with " + NEAREST + """,
p as (select chip, avg(sqrt(d2)) me, stddev_pop(sqrt(d2)) sd, sum(case when d2<25 then 1 else 0 end) k from near where d2<100 group by chip),
nd as (select chip, count(*) n from track_point group by chip), nt as (select chip, count(*) n from template_point group by chip)
select nd.chip, round(me,6) mean, round(sd,6) std, round(k/nd.n,6) recall_detected, round(k/nt.n,6) recall_template,
 k/nd.n>0.5 passed from nd join nt on nt.chip=nd.chip left join p on p.chip=nd.chip""")
def _(t):
    return registration.template_eval(t.track_point.select("chip", "id", "x", "y"), t.template_point).select(
        "chip", *R("mean", "std", "recall_detected", "recall_template"), "passed")


@query("d22_point_cluster_area")
def _(t):
    return registration.point_cluster_area(t.track_point.select("chip", "id", "x", "y"), 42, (1500, 1500)).select(
        "chip", *R("area_ratio"))


HIST = """hist as (select img, v, count(*) n from pixel group by 1,2),
c as (select *, sum(n) over (partition by img) tn, sum(n*v) over (partition by img) ts,
 sum(n) over (partition by img order by v) w0, sum(n*v) over (partition by img order by v) s0 from hist)"""


@query("d23_threshold_mean", "select img, round(avg(v),6) theta from pixel group by img")
def _(t):
    return images.hist_threshold(t.pixel, "mean").select("img", *R("theta"))


@query("d23_threshold_otsu", "with " + HIST + """
select img, cast(v as double) theta from c where w0<tn qualify row_number() over (partition by img order by
 round(w0/tn*((tn-w0)/tn)*(s0/w0-(ts-s0)/(tn-w0))*(s0/w0-(ts-s0)/(tn-w0)),9) desc, v)=1""")
def _(t):
    return images.hist_threshold(t.pixel, "otsu")


@query("d23_threshold_yen", "with " + HIST + """,
q as (select *, sum((n/tn)*(n/tn)) over (partition by img order by v) q0, sum((n/tn)*(n/tn)) over (partition by img) q from c)
select img, cast(v as double) theta from q where w0<tn and q-q0>1e-15 qualify row_number() over (partition by img order by
 round(ln((w0/tn)*(w0/tn)*(1-w0/tn)*(1-w0/tn)/(q0*(q-q0))),9) desc, v)=1""")
def _(t):
    return images.hist_threshold(t.pixel, "yen")


@query("d23_threshold_entropy", "with " + HIST + """,
q as (select *, sum(n*ln(n)) over (partition by img order by v) e0, sum(n*ln(n)) over (partition by img) e from c)
select img, cast(v as double) theta from q where w0<tn qualify row_number() over (partition by img order by
 round(ln(w0)-e0/w0+ln(tn-w0)-(e-e0)/(tn-w0),9) desc, v)=1""")
def _(t):
    return images.hist_threshold(t.pixel, "entropy")


for _m in ("li", "isodata", "minimum", "triangle", "shanbhag"):
    def _run(t, m=_m):
        return images.hist_threshold(t.pixel, m).select("img", *R("theta"))
    query(f"d23_threshold_{_m}")(_run)


@query("d24_local_threshold", """
with w as (select p.img, p.y, p.x, p.v, sum(q.v) s, sum(q.v*q.v) ss from pixel p join
  (select img, y, v, unnest(generate_series(x-7,x+7)) x from (select img, v, x, unnest(generate_series(y-7,y+7)) y from pixel)) q
  on q.img=p.img and q.y=p.y and q.x=p.x group by 1,2,3,4)
select img, y, x from w where v > s/225*(1+0.2::double*(sqrt(greatest(ss/225-(s/225)*(s/225),0))/128-1))""")
def _(t):
    return images.local_threshold(t.pixel, 15, 0.2, 128.0)


@query("d25_block_sum", """
select img, cast(y//4 as bigint) as "by", cast(x//4 as bigint) bx, cast(sum(v) as bigint) v from pixel group by 1,2,3""")
def _(t):
    return intensity.block_sum(t.pixel, 4)


@query("d25_stride_sample", "select img, y//5 y, x//5 x, v from pixel where x%5=0 and y%5=0")
def _(t):
    return intensity.stride_sample(t.pixel, 5)


CANDS = [(0, dx, dy) for dx in (-7, 0, 7) for dy in (-7, 0, 7)]
TURNS = [(r, dx, dy) for r in range(4) for dx in (-3, 0, 3) for dy in (-3, 0, 3)]


def fixed_moving(t):
    mask = t.sql("select chip img, y, x, cast(1+c%3 as bigint) v from "
                 "(select chip, c, cy y, SERIES(cx-2, cx+2) x from {cells}) q")
    return t.pixel, mask


MOVING = "moving as (select chip img, y, x, 1+c%3 v from (select chip, c, cy y, unnest(generate_series(cx-2,cx+2)) x from cells))"


@query("d26_align_score", "with " + MOVING + """,
cand as (select 0 rot, a.v dx, b.v dy from (values (-7),(0),(7)) a(v), (values (-7),(0),(7)) b(v)),
sc as (select p.img, dx, dy, sum(p.v*m.v) s from moving m, cand, pixel p where p.img=m.img and p.x=m.x+dx and p.y=m.y+dy group by 1,2,3),
im as (select distinct img from moving where img in (select img from pixel))
select im.img, cast(c.rot as bigint) rot, cast(c.dx as bigint) dx, cast(c.dy as bigint) dy, cast(coalesce(s, 0) as bigint) score
from im cross join cand c left join sc on sc.img=im.img and sc.dx=c.dx and sc.dy=c.dy""")
def _(t):
    return registration.align_score(*fixed_moving(t), CANDS)


@query("d26_align_score_absdiff", "with " + MOVING + """,
dil as (select img, y, x, max(v) v from (select img, y+dy y, x+dx x, v from moving,
  (select unnest(generate_series(-4,4)) dx), (select unnest(generate_series(-4,4)) dy)) group by 1,2,3),
cand as (select a.v dx, b.v dy from (values (-7),(0),(7)) a(v), (values (-7),(0),(7)) b(v)),
s as (select img, dx, dy, x+dx x, y+dy y, v from dil, cand), pc as (select pixel.*, dx, dy from pixel, cand)
select coalesce(p.img,s.img) img, cast(0 as bigint) rot, cast(coalesce(p.dx,s.dx) as bigint) dx, cast(coalesce(p.dy,s.dy) as bigint) dy,
 cast(sum(abs(coalesce(p.v,0)-coalesce(s.v,0))) as bigint) score
from pc p full join s on p.img=s.img and p.dx=s.dx and p.dy=s.dy and p.x=s.x and p.y=s.y group by 1,2,3,4""")
def _(t):
    return registration.align_score(*fixed_moving(t), CANDS, "absdiff")


@query("d27_best_alignment", "with " + MOVING + """,
rot as (select img, 0 rot, x, y, v from moving union all select img, 1, 460-y, x, v from moving
 union all select img, 2, 460-x, 460-y, v from moving union all select img, 3, y, 460-x, v from moving),
cand as (select a.v dx, b.v dy from (values (-3),(0),(3)) a(v), (values (-3),(0),(3)) b(v)),
sc as (select p.img, rot, dx, dy, sum(p.v*m.v) score from rot m, cand, pixel p
 where p.img=m.img and p.x=m.x+dx and p.y=m.y+dy group by 1,2,3,4)
select img, cast(rot as bigint) rot, cast(dx as bigint) dx, cast(dy as bigint) dy, cast(score as bigint) score from sc
qualify row_number() over (partition by img order by score desc, rot, dx, dy)=1""")
def _(t):
    return registration.best_alignment(registration.align_score(*fixed_moving(t), TURNS, shape=(460, 460)))


@query("d28_normalized_correlation", "with " + MOVING + """,
a as (select img, sum(v) sa, sum(v*v) saa from pixel group by 1), b as (select img, sum(v) sb, sum(v*v) sbb from moving group by 1),
ab as (select p.img, sum(p.v*m.v) sab from pixel p join moving m on p.img=m.img and p.x=m.x and p.y=m.y group by 1)
select a.img, round((sab-sa*sb/(460.0*460.0))/(sqrt(saa)*sqrt(sbb)),6) ncc from a join b on a.img=b.img join ab on ab.img=a.img""")
def _(t):
    return registration.normalized_correlation(*fixed_moving(t), (460, 460)).select("img", *R("ncc"))


def _fence(comp):
    prev = {"dx": "fov_jitter", "dy": "f1"}[comp]
    return f"""
v_{comp} as (select slide, axis, {comp} val, row_number() over (partition by slide, axis order by {comp})-1 rn,
 count(*) over (partition by slide, axis) n from {prev} where {comp} is not null and conf>5),
q_{comp} as (select slide, axis, max(n) n,
 (max(case when rn=floor(0.25*(n-1)) then val end)+max(case when rn=ceil(0.25*(n-1)) then val end))/2.0 q1,
 (max(case when rn=floor(0.75*(n-1)) then val end)+max(case when rn=ceil(0.75*(n-1)) then val end))/2.0 q3
 from v_{comp} group by 1,2),
b_{comp} as (select slide, axis, q1-1.5*i lo, q3+1.5*i hi, 0.6*i wid from
 (select *, case when q3-q1>5 then q3-q1 else q3-q1+3 end i from q_{comp} where n>3))"""


def _step(comp, src, out):
    return f"""
{out} as (select s.slide, r, c, s.axis, case when bad then null else dx end dx, case when bad then null else dy end dy,
 case when bad then 0 else conf end conf from (select j.*, coalesce({comp} > hi+case when conf>15 then wid else 0 end
  or {comp} < lo-case when conf>15 then wid else 0 end, false) bad
  from {src} j left join b_{comp} on b_{comp}.slide=j.slide and b_{comp}.axis=j.axis) s)"""


@query("d29_filter_abnormal_offset", "with " + _fence("dx").lstrip() + "," + _step("dx", "fov_jitter", "f1") + ","
       + _fence("dy") + "," + _step("dy", "f1", "f2") + " select * from f2")
def _(t):
    return stitching.filter_abnormal_offset(t.fov_jitter, 5)


def _consensus(comp, src="fov_jitter", gap=2):
    return f"""
d_{comp} as (select slide, axis, {comp} val, count(*) n from {src} where {comp} is not null group by 1,2,3),
g_{comp} as (select *, sum(brk) over (partition by slide, axis order by val) isl from
 (select *, case when val-lag(val) over (partition by slide, axis order by val)<={gap} then 0 else 1 end brk from d_{comp})),
k_{comp} as (select slide, axis, val from (select *, sum(n) over (partition by slide, axis, isl) k,
 sum(n) over (partition by slide, axis) tot from g_{comp}) where k>=0.1*tot)"""


def _agreed(src="fov_jitter"):
    return f"""
select j.slide, j.r, j.c, j.axis, case when kx.val is not null and ky.val is not null then dx end dx,
 case when kx.val is not null and ky.val is not null then dy end dy, conf from {src} j
left join k_dx kx on kx.slide=j.slide and kx.axis=j.axis and kx.val=dx
left join k_dy ky on ky.slide=j.slide and ky.axis=j.axis and ky.val=dy"""


#: Offsets inside the fence of confidence 5 that agree with others, as table ``clean``.
CLEAN = (_fence("dx").lstrip() + "," + _step("dx", "fov_jitter", "f1") + "," + _fence("dy") + "," + _step("dy", "f1", "f2")
         + "," + _consensus("dx", "f2", 10) + "," + _consensus("dy", "f2", 10) + ", clean as (" + _agreed("f2") + ")")


@query("d30_jitter_consensus", "with " + _consensus("dx").lstrip() + "," + _consensus("dy") + _agreed())
def _(t):
    return stitching.jitter_consensus(t.fov_jitter, gap=2)


@query("d31_drop_small_objects", """
select * from boundary b where (select sum(x1-x0+1) from boundary s where s.chip=b.chip and s.label=b.label)>=100""")
def _(t):
    return morphology.drop_small_objects(t.boundary, 100).select("chip", "label", "y", "x0", "x1")


@query("d32_stitch_error", """
with e as (select slide, r, c, axis, case when dx is null or dy is null then -1
 else floor(sqrt(power(dx+case when axis='h' then 200 else 0 end,2)+power(dy+case when axis='v' then 200 else 0 end,2))) end e
 from fov_jitter)
select slide, r, c, cast(max(e) as bigint) error, cast(max(case when axis='h' then e else -1 end) as bigint) h_error,
 cast(max(case when axis='v' then e else -1 end) as bigint) v_error from e group by 1,2,3""")
def _(t):
    return stitching.stitch_error(t.fov_jitter, 2000, 2000, 0.1)


@query("d33_mad_outliers", "with " + OBS + """,
g as (select chip, floor(count(*)/100)+1 n, max(cx) mx, max(cy) my from obs group by chip),
t as (select obs.*, floor(cx/(mx/n)) kx, floor(cy/(my/n)) ky, mx/n sx, my/n sy, n from obs join g on g.chip=obs.chip),
r as (select * from t where cx>kx*sx and cx<(kx+1)*sx and kx<n and cy>ky*sy and cy<(ky+1)*sy and ky<n),
m as (select chip, kx, ky, quantile_cont(area,0.5) ma, quantile_cont(mid,0.5) mm from r group by 1,2,3),
d as (select r.chip, r.kx, r.ky, quantile_cont(abs(area-ma),0.5) da, quantile_cont(abs(mid-mm),0.5) dm
 from r join m on m.chip=r.chip and m.kx=r.kx and m.ky=r.ky group by 1,2,3)
select r.chip, cell_id, case when area>ma+3*da then 1 else 0 end by_area, case when mid>mm+3.5*dm then 1 else 0 end by_mid,
 case when area>ma+3*da or mid>mm+3.5*dm then 1 else 0 end flag from r join m on m.chip=r.chip and m.kx=r.kx and m.ky=r.ky
join d on d.chip=r.chip and d.kx=r.kx and d.ky=r.ky""")
def _(t):
    return cells.mad_outliers(obs(t), cells_per_region=100)


@query("d34_highly_variable", "with " + ASSIGNED + """,
cg as (select chip, cell_id, gene, sum(mid) mid from assigned where cell_id>0 group by 1,2,3),
cl as (select chip, cell_id, sum(mid) total, count(*) g from cg group by 1,2 having sum(mid)>=20 and count(*) between 2 and 2500),
sc as (select chip, quantile_cont(total,0.5) med, count(*) n from cl group by chip),
nv as (select cg.chip, gene, ln(1+cg.mid*med/total) v, n from cg join cl on cl.chip=cg.chip and cl.cell_id=cg.cell_id
 join sc on sc.chip=cg.chip),
ge as (select chip, gene, sum(v)/max(n) mean, (sum(v*v)-max(n)*(sum(v)/max(n))*(sum(v)/max(n)))/(max(n)-1) va from nv group by 1,2),
st as (select chip, gene, mean, va/mean disp, ntile(3) over (partition by chip order by mean, gene) bin from ge),
z as (select *, case when stddev_samp(disp) over (partition by chip, bin)>0 then
 (disp-avg(disp) over (partition by chip,bin))/stddev_samp(disp) over (partition by chip, bin) else 1.0 end nd from st),
f as (select *, row_number() over (partition by chip order by nd desc, gene) rk from z where mean>0.0125 and mean<3 and nd>=0.5)
select chip, gene, round(mean,6) mean, round(disp,6) disp, round(nd,6) norm_disp, rk as "rank" from f where rk<=5000""")
def _(t):
    return cells.highly_variable(cells.cell_gene_matrix(assigned(t)), min_counts=20, min_genes=2, n_bins=3).select(
        "chip", "gene", *R("mean", "disp", "norm_disp"), "rank")


@query("d35_median_offset", "with " + NEAREST + """
select chip, -quantile_cont(ddx,0.5) dx, -quantile_cont(ddy,0.5) dy from near where d2<100 group by chip""")
def _(t):
    return registration.median_offset(registration.pair_nearest(
        t.track_point.select("chip", "id", "x", "y"), t.template_point, 10))


@query("d36_line_angle", """
select chip, fov_row, round(degrees(atan(regr_slope(y,x))),6) angle from track_point group by 1,2""")
def _(t):
    return registration.line_angle(t.track_point, "chip", "fov_row").select("chip", "fov_row", *R("angle"))


@query("d37_location_model", """
with p as (select slide, c*1800 sx, r*1800 sy, c*1803+r*2+(k*7)%5 gx, r*1798-c+(k*3)%7 gy from fov),
s as (select slide, avg(sx) mx, avg(sy) my, avg(gx) mu, avg(gy) mv, var_pop(sx) xx, var_pop(sy) yy, covar_pop(sx,sy) xy,
 covar_pop(sx,gx) xu, covar_pop(sx,gy) xv, covar_pop(sy,gx) yu, covar_pop(sy,gy) yv from p group by slide),
m as (select *, xx*yy-xy*xy d from s),
ab as (select *, (xu*yy-yu*xy)/d au, (yu*xx-xu*xy)/d bu, (xv*yy-yv*xy)/d av, (yv*xx-xv*xy)/d bv from m)
select slide, round(au,6) a_gx, round(bu,6) b_gx, round(mu-au*mx-bu*my,3) c_gx, round(av,6) a_gy, round(bv,6) b_gy,
 round(mv-av*mx-bv*my,3) c_gy from ab""")
def _(t):
    pairs = t.sql("select slide, c*1800 sx, r*1800 sy, c*1803+r*2+(k*7)%5 gx, r*1798-c+(k*3)%7 gy from {fov}")
    return registration.location_model(pairs).select("slide", *R("a_gx", "b_gx", "a_gy", "b_gy"), *R("c_gx", "c_gy", n=3))


@query("d38_cluster_report", """
with k as (select nat, chip, count(*) n, dense_rank() over (partition by chip order by nat) rk from cells group by chip, nat)
select cl.chip, cell_id, cast(cl.nat as varchar) cluster, rk cluster_rank, n cluster_size, cx//10 bx, cy//10 as "by"
from cells cl join k on k.chip=cl.chip and k.nat=cl.nat""")
def _(t):
    return images.cluster_report(t.cells.select("chip", "cell_id", F.col("nat").cast("string").alias("cluster"), "cx", "cy"))


def record(t):
    return t.slots.select("run", F.col("tech").alias("layer"), "w", "h", F.when(F.col("bal") > 2000, F.col("bal")).alias("score"),
                          F.when(F.col("reuse") >= 0, F.col("reuse")).alias("reuse"), "slot")


@query("d39_image_report", """
with s as (select run, tech layer, slot, round(cast(w as double)*0.0005,3) wm, round(cast(h as double)*0.0005,3) hm, case when reuse>=0 then reuse end ru, count(*) over (partition by run) ni from slots)
select run, layer, name, value from (
select run, layer, 'width_mm' as name, cast(wm as varchar) as value from s union all select run, layer, 'height_mm', cast(hm as varchar) from s
union all select run, layer, 'images', cast(ni as varchar) from s
union all select run, layer, 'reuse', cast(ru as varchar) from s union all select run, layer, 'slot', cast(slot as varchar) from s)
where value is not null""")
def _(t):
    return slots.image_report(record(t).drop("score"))


@query("d40_mask_size_estimate", """
with a as (select chip, label, cast(sum(x1-x0+1) as bigint) area from matrix group by 1,2),
m as (select chip, avg(area)*1.5 lim from a group by chip)
select a.chip, label, area, round(lim,6) "limit" from a join m on m.chip=a.chip where area>lim""")
def _(t):
    return cells.mask_size_estimate(t.matrix).select("chip", "label", "area", *R("limit"))


@query("d41_landmark_fit", """
with m as (select grp, avg(x) mx, avg(y) my, avg(u) mu, avg(v) mv from landmark group by grp),
d as (select l.grp, x-mx x, y-my y, u-mu u, v-mv v from landmark l join m on m.grp=l.grp),
s as (select grp, atan2(sum(x*v)-sum(y*u), sum(x*u)+sum(y*v)) rad from d group by grp),
r as (select d.*, rad, x*cos(rad)-y*sin(rad) rx, x*sin(rad)+y*cos(rad) ry from d join s on s.grp=d.grp),
sc as (select grp, sqrt(sum(u*u)/sum(rx*rx)) sx, sqrt(sum(v*v)/sum(ry*ry)) sy from r group by grp)
select r.grp, round(max(degrees(rad)),6) angle, round(max(sx),6) scale_x, round(max(sy),6) scale_y,
 round(sum(sqrt(power(rx*sx-u,2)+power(ry*sy-v,2))),6) residual from r join sc on sc.grp=r.grp group by r.grp""")
def _(t):
    return registration.landmark_fit(t.landmark).select("grp", *R("angle", "scale_x", "scale_y", "residual"))


@query("d42_landmark_fit_triples", """
with t as (select a.grp, a.k k1, b.k k2, c.k k3, a.x x1, a.y y1, a.u u1, a.v v1, b.x x2, b.y y2, b.u u2, b.v v2,
 c.x x3, c.y y3, c.u u3, c.v v3, a.x*(b.y-c.y)+b.x*(c.y-a.y)+c.x*(a.y-b.y) det
 from landmark a join landmark b on a.grp=b.grp and a.k<b.k join landmark c on c.grp=a.grp and b.k<c.k),
m as (select *, (u1*(y2-y3)+u2*(y3-y1)+u3*(y1-y2))/det au, (u1*(x3-x2)+u2*(x1-x3)+u3*(x2-x1))/det bu,
 (v1*(y2-y3)+v2*(y3-y1)+v3*(y1-y2))/det av, (v1*(x3-x2)+v2*(x1-x3)+v3*(x2-x1))/det bv from t where abs(det)>1e-9),
r as (select m.grp, k1, k2, k3, round(sum(sqrt(power(au*l.x+bu*l.y+(u1-au*x1-bu*y1)-l.u,2)+power(av*l.x+bv*l.y+(v1-av*x1-bv*y1)-l.v,2))),6) residual
 from m join landmark l on l.grp=m.grp group by 1,2,3,4)
select * from r qualify row_number() over (partition by grp order by residual, k1, k2, k3)=1""")
def _(t):
    return registration.landmark_fit_triples(t.landmark).select("grp", "k1", "k2", "k3", "residual")


@query("d43_overlap_pool", """
with w as (select img, v, unnest(generate_series(greatest(0, cast(ceil((y-2)/2) as bigint)), y//2)) wy, x from pixel where v<>0),
w2 as (select img, v, wy, unnest(generate_series(greatest(0, cast(ceil((x-2)/2) as bigint)), x//2)) wx from w)
select img, wy, wx, round(avg(v),6) v from w2 group by 1,2,3""")
def _(t):
    return intensity.overlap_pool(t.pixel, 3, 2).select("img", "wy", "wx", *R("v"))
