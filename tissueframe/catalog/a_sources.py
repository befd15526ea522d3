"""Readers and writers: each query writes the given data and reads it back."""

from pyspark.sql import functions as F

from ..operators import cells, masks
from ..plans.islands import pixels_from_runs
from ..session import scratch
from ..sources import cell_tables, gem, masks as mask_io, records
from . import query
from .d_aggregates import ASSIGNED, OBS, assigned, obs

R = lambda *names, n=6: [F.round(c, n).alias(c) for c in names]


def _gem(t):
    path = scratch(t.spark, "points") + ".gem"
    gem.write_gem(t.expression, path, 18, 21)
    return gem.read_gem(t.spark, path)


@query("a01_read_gem", "select chip, gene, x, y, mid from expression")
def _(t):
    return _gem(t)[0]


@query("a01_read_gem_meta", "select distinct chip, cast(18 as bigint) x_start, cast(21 as bigint) y_start, cast(1 as bigint) binx from expression")
def _(t):
    return _gem(t)[1]


@query("a02_read_expression", "select chip, gene, x, y, mid, y//2000 tile_y, x//2000 tile_x from expression")
def _(t):
    path = scratch(t.spark, "store")
    gem.write_expression(t.expression, path)
    return gem.read_expression(t.spark, path)[0]


@query("a03_chip_bounds", """
select chip, cast(1 as bigint) binx, min(x) min_x, min(y) min_y, max(x)-min(x)+1 width, max(y)-min(y)+1 height from expression group by chip""")
def _(t):
    return gem.chip_bounds(t.expression)


@query("a04_transcripts_to_expression", """
select feature_name gene, cast(round_even(x_location/0.2125::double,0) as bigint) x, cast(round_even(y_location/0.2125::double,0) as bigint) y,
 cast(1 as bigint) mid from transcript""")
def _(t):
    return gem.transcripts_to_expression(t.transcript)


@query("a05_write_gem", "select chip, count(*) n, cast(sum(mid) as bigint) mid from expression group by chip")
def _(t):
    return _gem(t)[0].groupBy("chip").agg(F.count("*").alias("n"), F.sum("mid").cast("long").alias("mid"))


@query("a06_write_profile", "with " + ASSIGNED + " select chip, gene, x, y, mid, cell_id from assigned")
def _(t):
    path = scratch(t.spark, "profile")
    gem.write_profile(assigned(t), path)
    return gem.read_profile(t.spark, path)


@query("a07_write_multires", """
select b as "bin", chip, gene, x//b bx, y//b as "by", cast(sum(mid) as bigint) mid
from expression, (select unnest([1,10,20,50,100,200,500]) b) group by 1,2,3,4,5""")
def _(t):
    path = scratch(t.spark, "multires")
    gem.write_multires(t.expression, path)
    return gem.read_multires(t.spark, path)


@query("a08_write_cells", "with " + OBS + """
select o.chip, o.cell_id, area, mid, n_gene, coalesce(g.k,0) genes_stored from obs o left join
 (select chip, cell_id, count(distinct gene) k from assigned where cell_id>0 group by 1,2) g on g.chip=o.chip and g.cell_id=o.cell_id""")
def _(t):
    path = scratch(t.spark, "cells")
    cell_tables.write_cells(obs(t), cells.cell_gene_matrix(assigned(t)), path)
    cell, cg = cell_tables.read_cells(t.spark, path)
    k = cg.groupBy("chip", "cell_id").agg(F.count("*").alias("k"))
    return cell.join(k, ["chip", "cell_id"], "left").select(
        "chip", "cell_id", "area", "mid", "n_gene", F.coalesce("k", F.lit(0)).cast("long").alias("genes_stored"))


@query("a09_write_cell_blocks", """
with b as (select chip, count(*) n, min(cx) x0, min(cy) y0, greatest(max(cx)-min(cx),1) w, greatest(max(cy)-min(cy),1) h from cells group by chip),
p as (select *, greatest(0, cast(ceil(log2(greatest(w,h)/(1.415*least(w,h)))) as bigint)) pre from b),
d as (select *, (select min(d) from (select unnest(generate_series(0,20)) d) q where floor(n/(power(2,pre)*power(4,d)))<=100) dep from p),
g as (select *, cast(power(2, case when w>h then pre+dep else dep end) as bigint) gx, cast(power(2, case when w>h then dep else pre+dep end) as bigint) gy from d)
select c.chip, cell_id, least(cast(floor((cx-x0)/(w/gx)) as bigint), gx-1) chunk_x, least(cast(floor((cy-y0)/(h/gy)) as bigint), gy-1) chunk_y
from cells c join g on g.chip=c.chip""")
def _(t):
    path = scratch(t.spark, "blocks")
    cell_tables.write_cell_blocks(t.cells.select("chip", "cell_id", F.col("cx").alias("x"), F.col("cy").alias("y")), path, 100)
    return cell_tables.read_cell_blocks(t.spark, path).select("chip", "cell_id", "chunk_x", "chunk_y")


@query("a10_export_label_pixels", """
select x "X coordinate", y "Y coordinate", 'tissue' "Group name", printf('Label %02d', label) "Label name", 1 "Bin size"
from (select label, y, unnest(generate_series(x0,x1)) x from interior)""")
def _(t):
    path = scratch(t.spark, "labels")
    cell_tables.export_label_pixels(pixels_from_runs(t.interior), path)
    return cell_tables.read_label_pixels(t.spark, path)


@query("a11_export_geojson", """
select cell_id, max(n)+1 points, min(cx+dx) min_x, max(cy+dy) max_y from border_vertex group by cell_id""")
def _(t):
    path = scratch(t.spark, "geojson")
    ring = t.border_vertex.select("chip", "cell_id", "idx", (F.col("cx") + F.col("dx")).alias("x"), (F.col("cy") + F.col("dy")).alias("y"))
    cell_tables.export_geojson(ring, path)
    shape = "id bigint, geometry struct<coordinates: array<array<array<bigint>>>>"
    f = t.spark.read.text(path).select(F.from_json("value", shape).alias("f"))
    pts = F.col("f.geometry.coordinates")[0]
    return f.select(F.col("f.id").alias("cell_id"), F.size(pts).cast("long").alias("points"),
                    F.array_min(F.transform(pts, lambda p: p[0])).alias("min_x"), F.array_max(F.transform(pts, lambda p: p[1])).alias("max_y"))


def _extent(t):
    return t.cells.select("chip").distinct().withColumn("width", F.lit(41).cast("long"))


FOLD = """f as (select chip, layer, y*41+x0%41+1 as start, least(x1-x0, 40-x0%41)+1 length from mask_run where layer in ('boundary','interior')),
d as (select distinct * from f), u as (select chip, layer, start, max(length) length from d group by 1,2,3),
px as (select distinct chip, layer, start+unnest(generate_series(0,length-1)) p from u),
g as (select *, p-row_number() over (partition by chip, layer order by p) k from px),
want as (select chip, layer, min(p) as start, count(*) length from g group by chip, layer, k)"""


def _folded(t):
    """Masks folded into a 41-pixel wide frame, so that many runs reach the row border."""
    from ..plans.islands import merge_runs
    x0 = F.col("x0") % 41
    folded = t.mask_run.where(F.col("layer").isin("boundary", "interior")).select(
        "chip", "layer", "y", x0.alias("x0"), F.least(x0 + F.col("x1") - F.col("x0"), F.lit(40)).alias("x1"))
    return merge_runs(folded, ("chip", "layer", "y"))


@query("a12_rle_encode", "with " + FOLD + " select * from want")
def _(t):
    return mask_io.rle_encode(_folded(t), _extent(t))


@query("a12_rle_decode", "with " + FOLD + """,
r as (select chip, layer, (p-1)//41 y, (p-1)%41 x from px),
h as (select *, x-row_number() over (partition by chip, layer, y order by x) k from r)
select chip, layer, y, min(x) x0, max(x) x1 from h group by chip, layer, y, k""")
def _(t):
    return mask_io.rle_decode(mask_io.rle_encode(_folded(t), _extent(t)), _extent(t))


@query("a13_write_pyramid", """
select 1 mag, img, y, x, v from pixel union all select 10, img, y//10, x//10, v from pixel where x%10=0 and y%10=0
union all select 50, img, y//50, x//50, v from pixel where x%50=0 and y%50=0""")
def _(t):
    path = scratch(t.spark, "pyramid")
    mask_io.write_pyramid(t.pixel, path)
    out = None
    for mag in (1, 10, 50):
        level = mask_io.read_pyramid(t.spark, path, mag).withColumn("mag", F.lit(mag))
        out = level if out is None else out.unionByName(level)
    return out


@query("a14_write_metrics", "with " + OBS + """
select chip, 'cells' as section, 'n_cells' as name, cast(count(*) as varchar) as value from obs group by chip
union all select chip, 'cells', 'total_mid', cast(cast(sum(mid) as bigint) as varchar) from obs group by chip
union all select chip, 'points', 'mid', cast(cast(sum(mid) as bigint) as varchar) from expression group by chip""")
def _(t):
    o = obs(t).groupBy("chip").agg(F.count("*").cast("string").alias("n_cells"), F.sum("mid").cast("string").alias("total_mid"))
    e = t.expression.groupBy("chip").agg(F.sum("mid").cast("string").alias("mid"))
    metric = (o.unpivot(["chip"], ["n_cells", "total_mid"], "name", "value").withColumn("section", F.lit("cells"))
              .unionByName(e.unpivot(["chip"], ["mid"], "name", "value").withColumn("section", F.lit("points"))))
    path = scratch(t.spark, "metrics")
    records.write_metrics(metric, path)
    return records.read_metrics(t.spark, path)


def _params(t, name):
    """One parameter document per run, as line-delimited JSON."""
    path = scratch(t.spark, name)
    slot = """struct(concat('img', s, '.tif') file_path, tech tech_type, s%2=0 chip_detect, s%3=0 quality_control,
 true tissue_segmentation, tech<>'Protein' cell_segmentation, 10 correct_r, channel_align,
 struct(-1 fixed_image, s%2=1 trackline, reuse) registration)"""
    doc = t.sql(f"""select run, to_json(struct(map_from_entries(collect_list(struct(cast(slot as string), {slot}))) image_process,
 map('0', struct(cast(min(slot) as int) exp_matrix, map('nuclei', array(0)) cell_mask, '' extra_method, cast(run%5+5 as int) correct_r)) molecular_classify,
 struct(true qc, run%2=0 alignment, true matrix_extract, false report, false annotation) run)) value from {{slots}} group by run""")
    doc.select("value").write.text(path)
    return path


@query("a15_read_params", """
select cast(slot as int) slot, 'img'||s||'.tif' file_path, tech tech_type, s%2=0 chip_detect, s%3=0 quality_control, tech<>'Protein' cell_segmentation,
 channel_align, reuse, s%2=1 trackline from slots""")
def _(t):
    slots, _, _ = records.read_params(t.spark, _params(t, "params"), multiline=False)
    return slots.select("slot", "file_path", "tech_type", "chip_detect", "quality_control", "cell_segmentation", "channel_align", "reuse", "trackline")


@query("a16_key_metrics", """
select run chip, slot layer, 'ImageInfo' as section, 'w' as name, cast(w as varchar) as value from slots
union all select run, slot, 'ImageInfo', 'h', cast(h as varchar) from slots
union all select run, slot, 'QCInfo', 'tech', tech from slots
union all select run, slot, 'Register', 'reuse', cast(reuse as varchar) from slots""")
def _(t):
    path = scratch(t.spark, "record")
    t.sql("""select run chip, slot layer, struct(w, h, 'x' version) ImageInfo, struct(tech, true Preview) QCInfo,
 struct(reuse, array(1,2) offsets, false ManualState) Register, struct(h area) TissueSeg from {slots}""").write.parquet(path)
    return records.key_metrics(t.spark.read.parquet(path))


@query("a17_scan_fov_listing", """
select '/slides/'||slide||'/img_'||lpad(cast(r+1 as varchar),4,'0')||'_'||lpad(cast(c+1 as varchar),4,'0')||'_z.tif' path, r, c from fov""")
def _(t):
    paths = t.sql("select concat('/slides/', slide, '/img_', lpad(cast(r+1 as string),4,'0'), '_', lpad(cast(c+1 as string),4,'0'), '_z.tif') path from {fov}")
    return records.scan_fov_listing(paths, "*_{xxx}_{xxx}_*", index0=False)


@query("a18_write_mask_layers", "select layer, chip, label, y, x0, x1 from mask_run")
def _(t):
    path = scratch(t.spark, "layers")
    mask_io.write_mask_layers(t.mask_run, path)
    return mask_io.read_mask_layers(t.spark, path)


@query("a19_kit_table", """
select distinct tech stain, s%2=0 chip_detect, s%3=0 quality_control, true tissue_segmentation, tech<>'Protein' cell_segmentation,
 cast(run%5+5 as int) radius, true qc, run%2=0 alignment, true matrix_extract, false report from slots""")
def _(t):
    return records.kit_table(t.spark, _params(t, "kits"), multiline=False).drop("kit").distinct()
