"""Composite jobs."""

from pyspark.sql import functions as F

from .. import jobs
from ..operators import cells, registration
from ..session import scratch
from ..sources import cell_tables
from . import query
from .bindings import TRACK
from .d_aggregates import CLEAN, NEAREST, OBS, TURNS, assigned, fixed_moving

R = lambda *names, n=6: [F.round(c, n).alias(c) for c in names]


def _cell_sql(mask: str) -> str:
    return f"""a_{mask} as (select e.*, n.label cell_id from inside e join {mask} n on e.chip=n.chip and e.y=n.y and e.x between n.x0 and n.x1),
s_{mask} as (select chip, label cell_id, cast(sum(x1-x0+1) as bigint) area from {mask} group by 1,2),
c_{mask} as (select chip, cell_id, cast(sum(mid) as bigint) mid, count(distinct gene) n_gene, count(distinct x*100000+y) n_dnb
 from a_{mask} group by 1,2)"""


def _cell_rows(mask: str, name: str) -> str:
    return f"""union all select chip, '{name}_gene', cell_id, gene, null, null, cast(sum(mid) as bigint), null, null, null from a_{mask} group by 1,3,4
union all select s.chip, '{name}_cell', s.cell_id, null, null, null, coalesce(mid,0), area, coalesce(n_gene,0), coalesce(n_dnb,0)
 from s_{mask} s left join c_{mask} c on c.chip=s.chip and c.cell_id=s.cell_id"""


@query("l01_extract_matrix", """with inside as (select e.* from expression e where exists (select 1 from tissue s
 where s.chip=e.chip and s.y=e.y and e.x between s.x0 and s.x1)), """ + _cell_sql("nuclei") + ", " + _cell_sql("boundary") + """
select chip, 'tissue' as matrix, cast(null as bigint) cell_id, gene, x, y, cast(sum(mid) as bigint) mid, cast(null as bigint) area,
 cast(null as bigint) n_gene, cast(null as bigint) n_dnb from inside group by chip, gene, x, y
""" + _cell_rows("nuclei", "nuclear") + " " + _cell_rows("boundary", "cell"))
def _(t):
    out = jobs.extract_matrix(t.expression, t.tissue, t.nuclei, t.boundary)
    total = None
    for name, part in out.items():
        part = part.withColumnsRenamed({"bx": "x", "by": "y"}).drop("cx", "cy").withColumn("matrix", F.lit(name))
        total = part if total is None else total.unionByName(part, allowMissingColumns=True)
    return total.select("chip", "matrix", "cell_id", "gene", "x", "y", "mid", "area", "n_gene", "n_dnb")


INSIDE = """inside as (select e.* from expression e where exists (select 1 from tissue s
 where s.chip=e.chip and s.y=e.y and e.x between s.x0 and s.x1))"""


def _stored(mask: str, name: str) -> str:
    return f"""select '{name}' matrix, s.chip, s.cell_id, area, coalesce(mid,0) mid, coalesce(n_gene,0) genes_stored
 from s_{mask} s left join c_{mask} c on c.chip=s.chip and c.cell_id=s.cell_id"""


@query("l01_write_matrix", "with " + INSIDE + ", " + _cell_sql("nuclei") + ", " + _cell_sql("boundary") + " "
       + _stored("nuclei", "nuclear") + " union all " + _stored("boundary", "cell"))
def _(t):
    path = scratch(t.spark, "matrix")
    jobs.write_matrix(jobs.extract_matrix(t.expression, t.tissue, t.nuclei, t.boundary), path)
    total = None
    for name in ("nuclear", "cell"):
        cell, gene = cell_tables.read_cells(t.spark, f"{path}/{name}")
        k = gene.groupBy("chip", "cell_id").agg(F.count("*").alias("k"))
        part = cell.join(k, ["chip", "cell_id"], "left").select(
            F.lit(name).alias("matrix"), "chip", "cell_id", "area", "mid", F.coalesce("k", F.lit(0)).cast("long").alias("genes_stored"))
        total = part if total is None else total.unionByName(part)
    return total


@query("l02_metrics")
def _(t):
    return jobs.metrics_job(t.expression, t.nuclei, t.tissue, 100).withColumn("value", F.round("value", 5))


@query("l02_metrics_by_variant")
def _(t):
    return jobs.metrics_by_variant(t.expression, {"nuclear": t.nuclei, "cell": t.boundary}, t.tissue, radius=100).withColumn(
        "value", F.round("value", 5))


def _heat(points: str, name: str) -> str:
    return f"""select chip, '{name}' as variant, 'heatmap' as part, x//20 a, y//20 b, cast(sum(mid) as double) v from {points} group by 1,4,5"""


def _mask_tables(mask: str, name: str) -> str:
    return f"""select s.chip, '{name}' as variant, 'ratio' as part, null a, null b, sum(case when q.x is not null then p.v else 0 end)/sum(p.v) v
 from pixel p join tissue_px s on p.img=s.chip and p.y=s.y and p.x=s.x left join {mask}_px q on q.chip=s.chip and q.y=s.y and q.x=s.x group by 1
union all select chip, '{name}', 'intensity', cast(floor(mean/8) as bigint), null, cast(count(*) as double) from {mask}_mean group by 1,4"""


def _px(runs: str) -> str:
    return f"{runs}_px as (select distinct chip, y, unnest(generate_series(x0,x1)) x from {runs})"


def _mean(runs: str) -> str:
    return f"""{runs}_sum as (select n.chip, n.label, sum(v) s from {runs} n join pixel p
 on p.img=n.chip and p.y=n.y and p.x between n.x0 and n.x1 group by 1,2),
{runs}_mean as (select n.chip, n.label, coalesce(max(s),0)/sum(x1-x0+1) mean from {runs} n left join {runs}_sum k
 on k.chip=n.chip and k.label=n.label group by 1,2)"""


@query("l02_metrics_tables", "with " + ", ".join([
    INSIDE, _px("tissue"), _px("nuclei"), _px("boundary"), _mean("nuclei"), _mean("boundary"),
    "in_nuclei as (select i.* from inside i join nuclei_px n on n.chip=i.chip and n.y=i.y and n.x=i.x)",
    "in_boundary as (select i.* from inside i join boundary_px n on n.chip=i.chip and n.y=i.y and n.x=i.x)",
    "size as (select chip, nat, count(*) n from cells group by 1,2)"]) + """
select chip, variant, part, a, b, round(v, 6) as "value" from (
""" + " union all ".join([_heat("inside", "tissue"), _heat("in_nuclei", "nuclear"), _heat("in_boundary", "cell"),
                          _mask_tables("nuclei", "nuclear"), _mask_tables("boundary", "cell"),
                          """select c.chip, cast(c.nat as varchar), 'cluster', cx//10, cy//10, cast(n as double)
 from cells c join size z on z.chip=c.chip and z.nat=c.nat"""]) + ") q")
def _(t):
    pixels = t.pixel.withColumnRenamed("img", "chip")
    clusters = t.cells.select("chip", "cell_id", F.col("nat").cast("string").alias("cluster"), "cx", "cy")
    out = jobs.metrics_tables(t.expression, {"nuclear": t.nuclei, "cell": t.boundary}, t.tissue, pixels, clusters)
    null = F.lit(None).cast("long")
    row = lambda name, part, a, b, v: out[name].select("chip", "variant", F.lit(part).alias("part"), a.alias("a"), b.alias("b"),
                                                       F.round(F.col(v).cast("double"), 6).alias("value"))
    out["clusters"] = out["clusters"].withColumnRenamed("cluster", "variant")
    return (row("heatmap", "heatmap", F.col("bx"), F.col("by"), "mid").unionByName(row("ratio", "ratio", null, null, "ratio"))
            .unionByName(row("intensity", "intensity", F.col("bin"), null, "n"))
            .unionByName(row("clusters", "cluster", F.col("bx"), F.col("by"), "cluster_size")))


@query("l03_mask_job")
def _(t):
    return jobs.mask_job(t.nuclei, t.boundary, t.interior, t.matrix)


@query("l04_double_cell_filter", "with " + OBS + """,
g as (select chip, floor(count(*)/100)+1 n, max(cx) mx, max(cy) my from obs group by chip),
t as (select obs.*, floor(cx/(mx/n)) kx, floor(cy/(my/n)) ky, mx/n sx, my/n sy, n from obs join g on g.chip=obs.chip),
r as (select * from t where cx>kx*sx and cx<(kx+1)*sx and kx<n and cy>ky*sy and cy<(ky+1)*sy and ky<n),
m as (select chip, kx, ky, quantile_cont(area,0.5) ma, quantile_cont(mid,0.5) mm from r group by 1,2,3),
d as (select r.chip, r.kx, r.ky, quantile_cont(abs(area-ma),0.5) da, quantile_cont(abs(mid-mm),0.5) dm
 from r join m on m.chip=r.chip and m.kx=r.kx and m.ky=r.ky group by 1,2,3),
ok as (select r.chip, cell_id from r join m on m.chip=r.chip and m.kx=r.kx and m.ky=r.ky
 join d on d.chip=r.chip and d.kx=r.kx and d.ky=r.ky where not (area>ma+3*da or mid>mm+3.5*dm))
select a.chip, a.cell_id, gene, cast(sum(a.mid) as bigint) mid from assigned a join ok on ok.chip=a.chip and ok.cell_id=a.cell_id group by 1,2,3""")
def _(t):
    return jobs.double_cell_filter(t.expression, t.nuclei, 100)


@query("l05_gene_registration")
def _(t):
    _, image = fixed_moving(t)
    out = jobs.gene_registration(t.dnb, image, TURNS, (460, 460), 360, (TRACK, TRACK))
    n = out["template"].groupBy("chip").agg(F.count("*").alias("template_points"))
    box = out["chip_box"].withColumnsRenamed({"x": "box_x", "y": "box_y"})
    return (out["alignment"].withColumnRenamed("img", "chip").join(n, "chip", "left").join(box, "chip", "left")
            .join(out["center"].select("chip", *R("x", "y")), "chip"))


@query("l05_register_points", "with " + NEAREST + """,
off as (select chip, count(*) pairs, -quantile_cont(ddx,0.5) dx, -quantile_cont(ddy,0.5) dy from near where d2<100 group by chip),
rot as (select chip, 0 rot, x, y, ix, iy from template_point union all select chip, 1, 1500-y, x, abs(iy-8), ix from template_point
 union all select chip, 2, 1500-x, 1500-y, abs(iy-8), abs(ix-8) from template_point
 union all select chip, 3, y, 1500-x, iy, abs(ix-8) from template_point),
z as (select chip, rot, x, y, round(sqrt((x-700)*(x-700)+(y-650)*(y-650)),9) d from rot where ix=0 and iy=0 and x>0 and y>0
 qualify row_number() over (partition by chip order by d, rot, 700-x, 650-y)=1)
select z.chip, cast(rot as bigint) rot, 700-x offset_x, 650-y offset_y, round(d,6) dist, pairs, dx, dy
from z left join off on off.chip=z.chip""")
def _(t):
    out = jobs.register_points(t.track_point.select("chip", "id", "x", "y"), t.template_point, (1500, 1500), (700, 650))
    whole = lambda c: F.round(c).cast("long").alias(c)
    n = out["pairs"].groupBy("chip").agg(F.count("*").alias("pairs"))
    return out["turn"].join(n, "chip", "left").join(out["offset"], "chip", "left").select(
        "chip", "rot", whole("offset_x"), whole("offset_y"), *R("dist"), "pairs", "dx", "dy")


@query("l06_stitch_slides", "with " + CLEAN + """,
med as (select slide, c, trunc(quantile_cont(dx,0.5)) dx, trunc(quantile_cont(dy,0.5)) dy from clean where axis='h' group by 1,2),
cols as (select f.slide, f.c, dx, dy from (select distinct slide, c from fov) f left join med on med.slide=f.slide and med.c=f.c),
par as (select slide, round_even(avg(case when c%2=0 then dx end),0) ex, round_even(avg(case when c%2=0 then dy end),0) ey,
 round_even(avg(case when c%2=1 then dx end),0) ox, round_even(avg(case when c%2=1 then dy end),0) oy from cols where dx is not null group by slide),
st as (select k.slide, c, coalesce(dx, case when c%2=1 then ox else ex end) sx, coalesce(dy, case when c%2=1 then oy else ey end) sy
 from cols k join par on par.slide=k.slide where c>0),
cum as (select slide, c, sum(sx+2000) over (partition by slide order by c) x, sum(sy) over (partition by slide order by c) y from st)
select f.slide, cast(f.r*1800+coalesce(cum.y,0)+100 as bigint) y, cast(coalesce(cum.x, f.c*1800)+100 as bigint) x, k%251 v
from fov f left join cum on cum.slide=f.slide and cum.c=f.c""")
def _(t):
    paths = t.sql("select slide, concat('/slides/', slide, '/img_', lpad(cast(k div 20 as string),4,'0'), '_', "
                  "lpad(cast(k%20 as string),4,'0'), '_z.tif') path from {fov}")
    pixels = t.sql("select slide, r, c, cast(100 as bigint) y, cast(100 as bigint) x, k%251 v from {fov}")
    out = jobs.stitch_slides(paths, t.fov_jitter, pixels, 2000, 2000, 20, conf=5, line_scan=True)
    return out["mosaic"]


@query("l07_field_fit")
def _(t):
    step = 330
    boxes = registration.nominal_fov_locations(t.track_point, step).withColumnsRenamed({"x": "x0", "y": "y0"})
    local = t.track_point.select("chip", "fov_row", "fov_col", "id", (F.col("x") - F.col("fov_col") * step).alias("x"),
                                 (F.col("y") - F.col("fov_row") * step).alias("y"), (F.col("conf_pct") / 100).alias("conf"))
    out = jobs.field_fit(local, boxes, (1500, 1500), (0.8, 0.9, 1.0, 1.1, 1.2), 42, template=(TRACK, TRACK))
    return out["scale"].join(out["area"].select("chip", *R("area_ratio"), "passed"), "chip")


@query("l06_stitch_plan")
def _(t):
    out = jobs.stitch_plan(t.fov.select("slide", "r", "c"), t.fov_jitter, 2000, 2000)
    return out["location"].join(out["error"], ["slide", "r", "c"], "left")


@query("l07_template_fit", "with good as (select * from track_point where conf_pct/100>0.5), "
       + NEAREST.replace("track_point", "good") + """,
f as (select chip, fov_row, fov_col, count(*) n, avg(conf_pct/100) conf from good group by 1,2,3),
s as (select chip, sum((case when n>=20 then 2 when n>=5 then 1 else 0 end)/2*conf) score,
 cast(sum(case when n>=5 then 1 else 0 end) as bigint) good_fov from f group by 1),
p as (select chip, avg(sqrt(d2)) me, stddev_pop(sqrt(d2)) sd, sum(case when d2<25 then 1 else 0 end) k,
 -quantile_cont(ddx,0.5) dx, -quantile_cont(ddy,0.5) dy from near where d2<100 group by chip),
nd as (select chip, count(*) n from good group by chip), nt as (select chip, count(*) n from template_point group by chip)
select s.chip, round(score,6) score, good_fov, round(me,6) mean, round(sd,6) std, round(k/nd.n,6) recall_detected,
 round(k/nt.n,6) recall_template, k/nd.n>0.5 passed, dx, dy
from s join nd on nd.chip=s.chip join nt on nt.chip=s.chip left join p on p.chip=s.chip""")
def _(t):
    out = jobs.template_fit(t.track_point.withColumn("conf", F.col("conf_pct") / 100), t.template_point)
    return (out["score"].select("chip", *R("score"), "good_fov").join(
        out["quality"].select("chip", *R("mean", "std", "recall_detected", "recall_template"), "passed"), "chip")
        .join(out["offset"], "chip", "left"))


@query("l08_cluster_job")
def _(t):
    return jobs.cluster_job(cells.cell_gene_matrix(assigned(t)), min_counts=20, min_genes=2, n_bins=3)
