"""Column functions: coordinates, intensities, names and flags."""

from pyspark.sql import functions as F

from ..functions import chip, geometry, intensity
from ..operators import registration, slots, stitching
from . import query

R = lambda *names, n=6: [F.round(c, n).alias(c) for c in names]


@query("b01_rebase", "select chip, gene, x-18 x, y-18 y, mid from expression")
def _(t):
    return geometry.rebase(t.expression, 18, 18)


@query("b02_window_filter", "select * from expression where x>100 and x<300 and y>100 and y<320")
def _(t):
    return geometry.window_filter(t.expression, (150, 150, 250, 270), 50)


@query("b03_saturate", """
select chip, gene, least(cast(sum(mid) as bigint), 65535) s16, least(cast(sum(mid) as bigint), 255) s8
from expression group by 1,2""")
def _(t):
    from ..operators.cells import saturate
    return t.expression.groupBy("chip", "gene").agg(saturate(F.sum("mid"), 16).alias("s16"), saturate(F.sum("mid"), 8).alias("s8"))


@query("b04_affine_points", """
select chip, id, round(1.25*(cos(radians(30))*(x-800)-sin(radians(30))*(y-700)) + 1.25*(1600*cos(radians(30))+1400*sin(radians(30)))/2,5) x,
 round(1.25*(sin(radians(30))*(x-800)+cos(radians(30))*(y-700)) + 1.25*(1600*sin(radians(30))+1400*cos(radians(30)))/2,5) y
from track_point""")
def _(t):
    return geometry.affine_points(t.track_point, (1400, 1600), 1.25, 30).select("chip", "id", *R("x", "y", n=5))


@query("b05_flip_points", """
select chip, 0 axis, 1499-x x, y, 8-ix ix, iy from template_point
union all select chip, 1, x, 1499-y, ix, 8-iy from template_point""")
def _(t):
    return geometry.flip_points(t.template_point, (1500, 1500), 0).withColumn("axis", F.lit(0)).unionByName(
        geometry.flip_points(t.template_point, (1500, 1500), 1).withColumn("axis", F.lit(1)))


@query("b05_flip_corners", """
select chip, 0 flip, 3-k k, round(1200-x,6) x, round(y,6) y from corner
union all select chip, 1, case k when 0 then 1 when 1 then 0 when 2 then 3 else 2 end, round(x,6), round(1300-y,6) from corner""")
def _(t):
    return geometry.flip_corners(t.corner, (1300, 1200), 0).withColumn("flip", F.lit(0)).unionByName(
        geometry.flip_corners(t.corner, (1300, 1200), 1).withColumn("flip", F.lit(1))).select("chip", "flip", "k", *R("x", "y"))


@query("b06_rot90_points", """
select chip, 1 n, 1300-y x, x y, abs(iy-8) ix, ix iy from template_point
union all select chip, 2, 1500-x, 1300-y, abs(iy-8), abs(ix-8) from template_point
union all select chip, 3, y, 1500-x, iy, abs(ix-8) from template_point""")
def _(t):
    turned = [geometry.rot90_points(t.template_point, (1300, 1500), n).withColumn("n", F.lit(n)) for n in (1, 2, 3)]
    return turned[0].unionByName(turned[1]).unionByName(turned[2])


@query("b07_rotate_about_center", """
with p as (select chip, id, x-750.0 dx, y-650.0 dy, radians(25) a from track_point)
select chip, id, round(dx*cos(a)+dy*sin(a)+750+(round(1300*sin(a)+1500*cos(a))-1500)/2,5) x,
 round(dy*cos(a)-dx*sin(a)+650+(round(1500*sin(a)+1300*cos(a))-1300)/2,5) y from p""")
def _(t):
    return geometry.rotate_about_center(t.track_point, 25, (1300, 1500)).select("chip", "id", *R("x", "y", n=5))


SRC4 = ((0, 0), (0, 1500), (1500, 1500), (1500, 0))
DST4 = ((10, 20), (-5, 1480), (1530, 1510), (1490, 12))


@query("b08_perspective_points", """
with h as (select chip, id, x, y, {6:.17e}*x+{7:.17e}*y+1 d from track_point)
select chip, id, round(({0:.17e}*x+{1:.17e}*y+{2:.17e})/d,5) x, round(({3:.17e}*x+{4:.17e}*y+{5:.17e})/d,5) y from h""".format(
    *geometry.homography(SRC4, DST4)))
def _(t):
    return geometry.perspective_points(t.track_point, SRC4, DST4).select("chip", "id", *R("x", "y", n=5))


@query("b09_template_index", """
with rx as (select chip, x, dense_rank() over (partition by chip order by x) r from template_point),
ry as (select chip, y, dense_rank() over (partition by chip order by y) r from template_point),
zx as (select distinct chip, r z from rx where x=87), zy as (select distinct chip, r z from ry where y=54)
select p.chip, p.x, p.y, ((a.r-zx.z)%9+9)%9 ix, ((b.r-zy.z)%9+9)%9 iy from (select distinct chip, x, y from template_point) p
join (select distinct * from rx) a on a.chip=p.chip and a.x=p.x join (select distinct * from ry) b on b.chip=p.chip and b.y=p.y
join zx on zx.chip=p.chip join zy on zy.chip=p.chip""")
def _(t):
    return registration.template_index(t.template_point.select("chip", "x", "y"), F.lit(87), F.lit(54))


MM = "with m as (select img, min(v) lo, max(v) hi, avg(v) av from {t} group by img)"


@query("b10_to_8bit", MM.format(t="pixel16") + """
select p.img, y, x, cast(floor(least((v-lo)*(256.0::double/(hi-lo+1))+0.5, 255)) as bigint) v
from pixel16 p join m on m.img=p.img""")
def _(t):
    return intensity.to_8bit(t.pixel16)


@query("b11_minmax_scale", MM.format(t="pixel16") + """
select p.img, y, x, round((v-lo)/(hi-lo)*100,5) v from pixel16 p join m on m.img=p.img""")
def _(t):
    return intensity.minmax_scale(t.pixel16, 100).select("img", "y", "x", *R("v", n=5))


@query("b11_minmax_rint", MM.format(t="pixel16") + """
select p.img, y, x, cast(round_even((v-lo)/(hi-lo)*255,0) as bigint) v from pixel16 p join m on m.img=p.img""")
def _(t):
    return intensity.minmax_scale(t.pixel16, 255, rounded=True)


@query("b12_percentile_clip", """
with q as (select img, quantile_cont(v, 0.95) q from pixel16 where v>0 group by img)
select p.img, y, x, round(case when v>q then q else v end,6) v from pixel16 p left join q on q.img=p.img""")
def _(t):
    return intensity.percentile_clip(t.pixel16, 95).select("img", "y", "x", *R("v"))


LIMITS = """with r as (select img, min(v) lo, max(v) hi, count(*) size from pixel16 group by img),
h as (select p.img, cast(floor(least(floor((v-lo)*256/(hi-lo)),255)) as bigint) bin, count(*) n, max(lo) lo, max(hi) hi, max(size) size
 from pixel16 p join r on r.img=p.img group by 1,2),
f as (select img, min(case when n<=size/10 and n>size/5000 and bin between 1 and 254 then bin end) b0,
 max(case when n<=size/10 and n>size/5000 and bin>=1 then bin end) b1, max(lo) lo, max(hi) hi from h group by img),
l0 as (select img, greatest(0, cast(floor(lo+coalesce(b0,0)*(hi-lo)/256) as bigint)) h0,
 least(65535, cast(floor(lo+coalesce(b1,65535)*(hi-lo)/256) as bigint)) h1 from f),
l as (select img, case when h1>h0 then h0 else 0 end hmin, case when h1>h0 then h1 else 0 end hmax from l0)"""


@query("b13_gray_limits", LIMITS + " select * from l")
def _(t):
    return intensity.gray_limits(t.pixel16, 16)


@query("b13_auto_contrast", LIMITS + """
select p.img, y, x, case when hmax>hmin then cast(round_even((greatest(least(v,hmax),hmin)-hmin)*65535.0::double/(hmax-hmin),0) as bigint) else v end v
from pixel16 p join l on l.img=p.img""")
def _(t):
    return intensity.auto_contrast(t.pixel16, 16)


ENC = """
select p.img, y, x, cast(case when mx-mn<=0 then v%256 when v>mx then 255 else floor((v-mn)*(255.0::double/(mx-mn))) end as bigint) v
from pixel16 p join e on e.img=p.img"""


@query("b14_threshold_encode_median", """
with e as (select a.img, mn, mx from (select img, min(v) mn from pixel16 group by img) a join
 (select img, quantile_cont(v,0.5)+stddev_pop(v) mx from pixel16 where v<=300 group by img) b on a.img=b.img)""" + ENC)
def _(t):
    return intensity.threshold_encode(t.pixel16, "median", 300)


@query("b14_threshold_encode_hist", """
with h as (select img, v, count(*) n from pixel16 where v<=300 group by 1,2),
k as (select img, v peak from h qualify row_number() over (partition by img order by n desc, v)=1),
e as (select k.img, mn, 2.0::double*peak-mn mx from k join (select img, min(v) mn from pixel16 group by img) a on a.img=k.img)""" + ENC)
def _(t):
    return intensity.threshold_encode(t.pixel16, "hist", 300)


@query("b15_rgb_to_gray", """
select img, y, x, (r*4899+g*9617+b*1868+8192)//16384 gray, 255-(r*4899+g*9617+b*1868+8192)//16384 inverted from pixel_rgb""")
def _(t):
    rgb = [F.col(c) for c in "rgb"]
    return t.pixel_rgb.select("img", "y", "x", intensity.rgb_to_gray(*rgb).alias("gray"),
                              intensity.rgb_to_gray(*rgb, invert=True).alias("inverted"))


@query("b15_rgb_saturation", """
with s as (select img, y, x, case when greatest(r,g,b)=0 then 0 else
 cast(floor((greatest(r,g,b)-least(r,g,b))*255/greatest(r,g,b)+0.5) as bigint) end v from pixel_rgb),
m as (select img, avg(v) av from s group by img)
select s.img, y, x, cast(floor(least(v*(v/av)*(v/av),255)) as bigint) v from s join m on m.img=s.img""")
def _(t):
    return intensity.rgb_saturation(t.pixel_rgb)


@query("b16_range_threshold", "select img, y, x, case when v between 40 and 200 and v>0 then 1 else 0 end v from pixel")
def _(t):
    return t.pixel.withColumn("v", intensity.range_threshold(F.col("v"), 40, 200))


@query("b17_cell_diameter", """
select chip, label, round(2*sqrt(sum(x1-x0+1)/pi())*500/1000,6) diameter from nuclei group by 1,2""")
def _(t):
    from ..plans.islands import area
    return area(t.nuclei).select("chip", "label", F.round(intensity.cell_diameter(F.col("area")), 6).alias("diameter"))


@query("b18_null_sentinels", """
select slide, r, c, axis, case when v is null or v=-999 then null else v end dx, case when w=999 or w is null then null else w end dy
from (select slide, r, c, axis, coalesce(dx,-999) v, coalesce(dy,999) w from fov_jitter) q""")
def _(t):
    coded = t.fov_jitter.select("slide", "r", "c", F.col("axis"), F.coalesce("dx", F.lit(-999).cast("long")).alias("dx"),
                                F.coalesce("dy", F.lit(999).cast("long")).alias("dy"))
    return intensity.null_sentinels(coded, 999)


KIND = """k as (select c, sn, case when length(sn)=0 or instr('ABCDYEFGHQJKLMNPS', substr(sn,1,1))=0 then 'unknown'
 when length(sn) in (8,10) and regexp_full_match(substr(sn,7,1),'[A-Za-z]') and
  (length(sn)<>8 or substr(sn,1,1) in ('Y','Q') or regexp_full_match(substr(sn,8,1),'[0-9]')) then 'short'
 when length(sn) in (14,16,17,18) then 'long' else 'unknown' end kind from chip_name),
z as (select *, case when kind='short' then right(sn,4) else list_extract(string_split(sn,'_'),-1) end tail from k),
y as (select *, substr(tail, greatest(length(tail)-3,1),1) a, substr(tail,length(tail)-2,1) p, substr(tail,length(tail)-1,1) b, right(tail,1) q from z),
s as (select *, kind='unknown' or (kind='short' and length(sn)=8) or (kind='long' and length(tail)=2) single,
 right(tail,2) in ('11','12','13','14') half, try_cast(q as int)-try_cast(p as int)+1 dw,
 case when instr('ACDEFG',a)>0 and instr('ACDEFG',b)>0 then instr('ACDEFG',b)-instr('ACDEFG',a) else ascii(b)-ascii(a) end+1 dh from y)"""


@query("b19_parse_chip_no", "with " + KIND + """
select sn, c, kind name_type, kind<>'unknown' and substr(sn,1,1) in ('Y','Q') large,
 cast(case when single then 1 when half then 0.5 when dw is not null then dw else 1 end as double) w,
 cast(case when single then 1 when half then 0.5 when dw is not null then dh else 1 end as double) h,
 case when kind<>'short' or regexp_matches(right(sn,4),'[BIO]') then false
  when not regexp_full_match(substr(sn,2,5),'[0-9]{5}') then true
  when substr(sn,1,1) in ('A','B','C','D') then cast(substr(sn,2,5) as int)>=3205
  when substr(sn,1,1)='Y' then cast(substr(sn,2,5) as int)>=395 else true end late from s""")
def _(t):
    sn = F.col("sn")
    w, h = chip.chip_spec(sn)
    return t.chip_name.select("sn", "c", chip.name_type(sn).alias("name_type"), chip.is_large(sn).alias("large"),
                              w.alias("w"), h.alias("h"), chip.is_late(sn).alias("late"))


@query("b20_chip_size", """
select img, 1+img%4 spec, cast(floor(2940*((1+img%4)*6.8::double+0.2::double)) as bigint) px,
 cast(floor(2940*(0.5::double*6.8::double+0.2::double)) as bigint) half_px from image_size""")
def _(t):
    spec = 1 + F.col("img") % 4
    return t.image_size.select("img", spec.alias("spec"), chip.chip_size(spec).alias("px"), chip.chip_size(F.lit(0.5)).alias("half_px"))


@query("b21_kit_and_group", """
with s as (select s, tech, 'C'||cast(s as varchar) sn, case when s%3=0 then 'C'||cast(s as varchar)||'_CD3_IF' when s%3=1
 then 'tag_IF_CD4' else 'plain' end tag, case when s%2=0 then 'Seq-T kit' when s%5=1 then 'Seq-P kit' else 'none' end kit from slots)
select s, case when kit like '%Seq-T%' then 'Transcriptomics' when kit like '%Seq-P%' then 'Protein' else 'UNKNOWN' end kind,
 case when contains(tag,'IF') and contains(tag,sn) then trim(array_to_string(string_split(tag,sn),'_'),'_')
  when contains(tag,'IF') then trim(array_to_string(string_split(tag,'IF'),'_'),'_')||'_IF'
  when tech='IF' then tag||'_IF' else tech end grp from s""")
def _(t):
    s = t.sql("""select s, tech, 'C'||cast(s as string) sn, case when s%3=0 then 'C'||cast(s as string)||'_CD3_IF' when s%3=1
 then 'tag_IF_CD4' else 'plain' end tag, case when s%2=0 then 'Seq-T kit' when s%5=1 then 'Seq-P kit' else 'none' end kit from {slots}""")
    return s.select("s", chip.kit_to_type(F.col("kit"), "Seq-T", "Seq-P").alias("kind"),
                    chip.group_name(F.col("tag"), F.col("sn"), F.col("tech")).alias("grp"))


FLAGS = "(select run, slot, tech, unnest(['chip_detect','clarity','tissue','cell']) as module, true flag from slots)"
SUPPORTED = [("ssDNA", "chip_detect"), ("DAPI", "chip_detect"), ("HE", "chip_detect"), ("ssDNA", "clarity"), ("DAPI", "clarity"),
             ("HE", "clarity"), ("ssDNA", "tissue"), ("DAPI", "tissue"), ("HE", "tissue"), ("IF", "tissue"), ("Transcriptomics", "tissue"),
             ("ssDNA", "cell"), ("DAPI", "cell"), ("HE", "cell"), ("IF", "cell"), ("Transcriptomics", "cell")]


@query("b22_validate_slots", "with f as " + FLAGS + ", sup(tech, module) as (values "
       + ", ".join(f"('{a}','{b}')" for a, b in SUPPORTED) + """)
select run, slot, f.tech, f.module, sup.tech is not null flag,
 case when sup.tech is null then f.tech||' not supported by '||f.module end warning
from f left join sup on sup.tech=f.tech and sup.module=f.module""")
def _(t):
    flags = t.slots.select("run", "slot", "tech", F.explode(F.array(*[F.lit(m) for m in ("chip_detect", "clarity", "tissue", "cell")]))
                           .alias("module")).withColumn("flag", F.lit(True))
    return slots.validate_slots(flags, t.spark.createDataFrame(SUPPORTED, "tech string, module string"))


@query("b23_confidence_filter", "select chip, fov_row, fov_col, id, x, y, conf_pct from track_point where conf_pct/100>0.5")
def _(t):
    return t.track_point.where(F.col("conf_pct") / 100 > 0.5).select("chip", "fov_row", "fov_col", "id", "x", "y", "conf_pct")


@query("b24_outline_filter", """
select chip, id, x, y from track_point where abs(x-700)<=400 and abs(y-700)<=400 and x between 0 and 1000 and y between 0 and 1000""")
def _(t):
    return t.track_point.where((F.abs(F.col("x") - 700) <= 400) & (F.abs(F.col("y") - 700) <= 400)
                               & F.col("x").between(0, 1000) & F.col("y").between(0, 1000)).select("chip", "id", "x", "y")


@query("b25_human_format", """
with v as (select o_orderkey k, o_totalprice*(case o_orderkey%4 when 0 then 0.001 when 1 then 1 when 2 then 1000 else 1000000 end) v from orders),
s as (select k, round(v/power(10.0,floor(log10(abs(v)))-2))*power(10.0,floor(log10(abs(v)))-2) g from v),
m as (select k, g, case when abs(g)>=1e12 then 4 when abs(g)>=1e9 then 3 when abs(g)>=1e6 then 2 when abs(g)>=1e3 then 1 else 0 end s from s)
select k, regexp_replace(regexp_replace(printf('%.6f', g/power(1000.0,s)),'0+$',''),'\\.$','')||list_extract(['','K','M','B','T'],s+1) as label from m""")
def _(t):
    v = F.col("o_totalprice") * F.element_at(F.array(*[F.lit(f) for f in (0.001, 1.0, 1e3, 1e6)]), (F.col("o_orderkey") % 4 + 1).cast("int"))
    return t.orders.select(F.col("o_orderkey").alias("k"), intensity.human_format(v).alias("label"))


@query("b26_local_to_global", """
with box as (select distinct chip, fov_row, fov_col, fov_col*330 x0, fov_row*330 y0 from track_point)
select p.chip, id, p.x+x0 x, p.y+y0 y from track_point p join box b on b.chip=p.chip and b.fov_row=p.fov_row and b.fov_col=p.fov_col""")
def _(t):
    from ..session import small
    box = registration.nominal_fov_locations(t.track_point, 330).withColumnsRenamed({"x": "x0", "y": "y0"})
    return t.track_point.join(small(box), ["chip", "fov_row", "fov_col"]).select(
        "chip", "id", (F.col("x") + F.col("x0")).alias("x"), (F.col("y") + F.col("y0")).alias("y"))


@query("b27_fov_scale", """
with s as (select img, (greatest(w,h)/1200.0::double+least(w,h)/1000.0::double)/2 s from image_size)
select img, round(s,6) scale, cast(floor(2000*s) as bigint) win_w, cast(floor(1500*s) as bigint) win_h from s""")
def _(t):
    s = chip.fov_scale(F.col("w"), F.col("h"), F.lit(1000.0), F.lit(1200.0))
    return t.image_size.select("img", F.round(s, 6).alias("scale"), F.floor(s * 2000).alias("win_w"), F.floor(s * 1500).alias("win_h"))


@query("b28_chip_box_check", """
with e as (select a.chip, a.k, a.w, a.h, sqrt(power(a.x-b.x,2)+power(a.y-b.y,2)) len,
 case when a.x=b.x then sign(a.y-b.y)*90 else degrees(atan((a.y-b.y)/(a.x-b.x))) end ang
 from corner a join corner b on a.chip=b.chip and b.k=(a.k+1)%4),
t as (select p.chip, n.ang-p.ang d from e p join e n on p.chip=n.chip and n.k=(p.k+1)%4),
o as (select chip, max(abs(90-case when d<0 then d+180 else d end)) off from t group by chip),
l as (select chip, max(len)/min(len) hi, min(len)/max(len) lo, max(w) w, max(h) h from e group by chip)
select l.chip, round(hi,6) max_ratio, round(off,6) max_angle, abs(hi-greatest(w,h)/least(w,h))<=0.05 and
 abs(lo-least(w,h)/greatest(w,h))<=0.05 and off<=2 available from l join o on o.chip=l.chip""")
def _(t):
    return geometry.chip_box_check(t.corner).select("chip", *R("max_ratio", "max_angle"), "available")


@query("b29_calibration_flag", """
select slide, r, c, axis, sqrt((dx+200)*(dx+200)+dy*dy)<=20 flag from fov_jitter""")
def _(t):
    return t.fov_jitter.select("slide", "r", "c", "axis", chip.calibrated((F.col("dx") + 200).cast("double"), F.col("dy").cast("double")).alias("flag"))


@query("b30_scope_transform_params", """
with p as (select run, slot, reuse, case when s%3=0 then 0.5+s%7*0.25 end scale, case when s%3=0 then s%4*1.5 end rotation,
 case when s%3=0 then s*2.0 end dx, case when s%3=0 then s*3.0 end dy, case when s%4=1 then 0.9 end bs, case when s%4=1 then 2.5 end br from slots)
select a.run, a.slot, round(1/cast(coalesce(a.scale,a.bs,b.scale) as double),6) scale,
 cast(coalesce(a.rotation,a.br,b.rotation,0) as double) rotation, cast(coalesce(a.dx,b.dx,0) as double) dx, cast(coalesce(a.dy,b.dy,0) as double) dy,
 case when a.scale is not null then 'own' when a.bs is not null then 'chip_box' when b.scale is not null then 'reused' else 'none' end source
from p a left join p b on a.run=b.run and a.reuse=b.slot""")
def _(t):
    p = t.sql("""select run, slot, cast(reuse as bigint) reuse, cast(case when s%3=0 then 0.5+s%7*0.25 end as double) scale,
 cast(case when s%3=0 then s%4*1.5 end as double) rotation, cast(case when s%3=0 then s*2.0 end as double) dx,
 cast(case when s%3=0 then s*3.0 end as double) dy, cast(case when s%4=1 then 0.9 end as double) box_scale,
 cast(case when s%4=1 then 2.5 end as double) box_rotation from {slots}""")
    return slots.scope_transform_params(p).withColumn("scale", F.round("scale", 6))


@query("b31_binarize_logit", "select img, y, x, case when 1/(1+exp(-((v-128)/32.0::double)))>=0.5 then 1 else 0 end v from pixel")
def _(t):
    return t.pixel.withColumn("v", intensity.binarize_logit((F.col("v") - 128) / 32))


@query("b32_chip_grid", "select img, h*50//20000 gh, w*50//20000 gw from image_size")
def _(t):
    gh, gw = chip.chip_grid(F.col("h") * 50, F.col("w") * 50)
    return t.image_size.select("img", gh.alias("gh"), gw.alias("gw"))


@query("b33_match_extent", """
select 'min' mode, chip, id, x, y from track_point where x<900 and y<1000
union all select 'max', chip, id, x, y from track_point
union all select 'same', chip, id, x-300, y-200 from track_point where x-300>=0 and x-300<900 and y-200>=0 and y-200<1000""")
def _(t):
    p = t.track_point.select("chip", "id", "x", "y")
    parts = [geometry.match_extent(p, (1400, 1500), (1000, 900), m).withColumn("mode", F.lit(m)) for m in ("min", "max", "same")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
