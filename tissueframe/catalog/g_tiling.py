"""Tile plans, seams, mosaics and per-tile functions."""

import pandas as pd
from pyspark.sql import functions as F

from ..operators import stitching, tiling
from ..session import deal
from . import query

R = lambda *names, n=6: [F.round(c, n).alias(c) for c in names]


def _axis(length, back):
    lo = f"case when {back} and t*224+256>{length} then greatest(0,{length}-256) else t*224 end"
    return f"select img, {lo} lo, least(t*224+256, {length}) hi from (select img, {length}, unnest(generate_series(0, cast(ceil({length}/224) as bigint)-1)) t from image_size)"


def _plan(back):
    return f"""with ys as ({_axis('h', back)}), xs as ({_axis('w', back)})
select ys.img, ys.lo y0, ys.hi y1, xs.lo x0, xs.hi x1 from ys join xs on ys.img=xs.img where ys.lo<ys.hi and xs.lo<xs.hi"""


@query("g01_tile_plan", _plan("false"))
def _(t):
    return tiling.tile_plan(t.image_size, 256, 32)


@query("g01_tile_plan_win_back", _plan("true"))
def _(t):
    return tiling.tile_plan(t.image_size, 256, 32, win_back=True)


@query("g01_tile_plan_fraction", """
with ys as (select img, cast(round_even(t*256-t*0.1::double*256,0) as bigint) lo, h from
 (select img, h, unnest(generate_series(0, cast(floor(h/(0.9::double*256)) as bigint))) t from image_size)),
xs as (select img, cast(round_even(t*256-t*0.1::double*256,0) as bigint) lo, w from
 (select img, w, unnest(generate_series(0, cast(floor(w/(0.9::double*256)) as bigint))) t from image_size))
select ys.img, ys.lo y0, least(ys.lo+256,h) y1, xs.lo x0, least(xs.lo+256,w) x1 from ys join xs on ys.img=xs.img where ys.lo<h and xs.lo<w""")
def _(t):
    return tiling.tile_plan(t.image_size, 256, 0.1)


@query("g02_tile_plan_padded", """
with ys as (select img, h, t, n from (select img, h, n, unnest(generate_series(0, n-1)) t from
 (select img, h, greatest(1, cast(floor((h-48)/452) as bigint)+1) n from image_size))),
xs as (select img, w, t, n from (select img, w, n, unnest(generate_series(0, n-1)) t from
 (select img, w, greatest(1, cast(floor((w-48)/452) as bigint)+1) n from image_size))),
yy as (select img, case when t=n-1 then greatest(0,h-500) else t*452 end lo, h from ys),
xx as (select img, case when t=n-1 then greatest(0,w-500) else t*452 end lo, w from xs)
select yy.img, yy.lo y0, least(h, yy.lo+500) y1, xx.lo x0, least(w, xx.lo+500) x1 from yy join xx on yy.img=xx.img""")
def _(t):
    return tiling.tile_plan_padded(t.image_size, 500, 48)


@query("g03_halo_blocks", """
with b as (select chip, min(y)-10 oy, min(x0)-10 ox from boundary group by chip),
r as (select n.*, oy, ox from boundary n join b on b.chip=n.chip),
y as (select *, unnest(generate_series(greatest(0, cast(floor((y-oy-10)/100) as bigint)), (y-oy+10)//100)) ty from r),
x as (select *, unnest(generate_series(greatest(0, cast(floor((x0-ox-10)/100) as bigint)), (x1-ox+10)//100)) tx from y)
select chip, label, ty as "by", tx bx, y, greatest(x0, ox+tx*100-10) x0, least(x1, ox+tx*100+109) x1 from x""")
def _(t):
    return tiling.halo_blocks(t.boundary, 100, 10)


TILED = """size as (select img, max(y)+1 h, max(x)+1 w from pixel group by img),
ys as (select img, t*112 lo, least(t*112+128,h) hi, h from (select img, h, unnest(generate_series(0, cast(ceil(h/112) as bigint)-1)) t from size)),
xs as (select img, t*112 lo, least(t*112+128,w) hi, w from (select img, w, unnest(generate_series(0, cast(ceil(w/112) as bigint)-1)) t from size)),
tiled as (select p.img, ys.lo y0, ys.hi y1, xs.lo x0, xs.hi x1, h, w, y, x, v from pixel p join ys on ys.img=p.img and y>=ys.lo and y<ys.hi
 join xs on xs.img=p.img and x>=xs.lo and x<xs.hi)"""


def _tiled(t):
    from ..session import small
    size = small(t.pixel.groupBy("img").agg((F.max("y") + 1).alias("h"), (F.max("x") + 1).alias("w")))
    plan = tiling.tile_plan(size, 128, 16)
    return tiling.pixels_in_boxes(t.pixel, plan, 128).join(size, "img")


@query("g04_own_tile", "with " + TILED + """
select img, y0, x0, y, x, v from tiled where y>=y0+case when y0<>0 then 8 else 0 end and y<y1-case when y1<>h then 8 else 0 end
and x>=x0+case when x0<>0 then 8 else 0 end and x<x1-case when x1<>w then 8 else 0 end""")
def _(t):
    return tiling.own_tile(_tiled(t), 16).select("img", "y0", "x0", "y", "x", "v")


@query("g05_merge_tiles_or", "with " + TILED + """
select img, y, x, max(case when (v+y0+x0)%3=0 then 1 else 0 end) v from tiled group by 1,2,3""")
def _(t):
    hit = F.when((F.col("v") + F.col("y0") + F.col("x0")) % 3 == 0, 1).otherwise(0)
    return tiling.merge_tiles_or(_tiled(t).withColumn("v", hit))


FOVPX = """fpx as (select slide, r, c, y, x, (k*7+y*3+x*5)%251 v from (select slide, r, c, k, y, unnest(generate_series(0,5)) x from
 (select slide, r, c, k, unnest(generate_series(0,5)) y from fov)))"""


def _fov_pixels(t):
    # fields are dealt before they become pixels, which then are where the join with their places wants them
    return t.sql("""select slide, r, c, y, x, (k*7+y*3+x*5)%251 v from (select slide, r, c, k, y, SERIES(0, 5) x from
 (select slide, r, c, k, SERIES(0, 5) y from {fov}) a) b""", fov=deal(t.fov, "slide", "r", "c"))


@query("g06_blend_tiles", "with " + FOVPX + """,
p as (select slide, r, c, r*4+y gy, c*4+x gx, v, case when x<2 then sin(radians(x*45.0::double)) else 1 end wx,
 case when y<2 then sin(radians(y*45.0::double)) else 1 end wy from fpx),
a as (select *, lag(v) over (partition by slide, r, gy, gx order by c) o, lead(v) over (partition by slide, r, gy, gx order by c) nx from p),
b as (select slide, r, gy, gx, wy, case when o is null then v else o*(1-wx)+v*wx end v from a where nx is null),
d as (select *, lag(v) over (partition by slide, gy, gx order by r) o, lead(v) over (partition by slide, gy, gx order by r) nx from b)
select slide, gy y, gx x, round(case when o is null then v else o*(1-wy)+v*wy end,5) v from d where nx is null""")
def _(t):
    loc = t.fov.select("slide", "r", "c", (F.col("c") * 4).alias("x"), (F.col("r") * 4).alias("y"))
    return stitching.blend_tiles(_fov_pixels(t), loc, 2).select("slide", "y", "x", *R("v", n=5))


@query("g07_mosaic", "with " + FOVPX + """
select slide, r*4+y y, c*4+x x, v from fpx qualify row_number() over (partition by slide, r*4+fpx.y, c*4+fpx.x order by r*20+c desc)=1""")
def _(t):
    loc = t.fov.select("slide", "r", "c", (F.col("c") * 4).alias("x"), (F.col("r") * 4).alias("y"))
    return stitching.mosaic(_fov_pixels(t), loc, 20)


@query("g08_chip_blocks", """
with e as (select chip, max(y)+1 h, max(x)+1 w from expression group by chip)
select p.chip, least(x//(w//4),3)*3+least(y//(h//3),2) block, count(*) n, cast(sum(mid) as bigint) mid
from expression p join e on e.chip=p.chip group by 1,2""")
def _(t):
    extent = t.expression.groupBy("chip").agg((F.max("y") + 1).alias("h"), (F.max("x") + 1).alias("w"))
    return tiling.chip_blocks(t.expression, extent, 3, 4).groupBy("chip", "block").agg(
        F.count("*").alias("n"), F.sum("mid").cast("long").alias("mid"))


@query("g09_map_tiles", """
with z as (select img, y//64 ty, x//64 tx, cast(sum(v) as bigint) total, count(*) n from pixel group by 1,2,3)
select img, ty, tx, case when total=0 then 0.0::double else round(total/n,6) end score from z""")
def _(t):
    tiles = t.pixel.groupBy("img", F.floor(F.col("y") / 64).alias("ty"), F.floor(F.col("x") / 64).alias("tx")).agg(
        F.sum("v").cast("long").alias("total"), F.count("*").alias("n"))

    def score(pdf: pd.DataFrame) -> pd.DataFrame:
        return pdf.assign(score=(pdf["total"] / pdf["n"]).round(6))[["img", "ty", "tx", "score"]]

    return tiling.map_tiles(tiles, score, "img long, ty long, tx long, score double", F.col("total") == 0,
                            lambda e: e.select("img", "ty", "tx", F.lit(0.0).alias("score")))
