"""Domain tables derived from the given TPC-H-like tables.

Each binding is one SQL text used by both engines.  ``{name}`` marks a source
and ``SERIES(a, b)`` a row per integer from a to b.  All are plain projections
over whole tables, so they grow with the data: 400 cells per chip, 1 600 track
points per chip, 400 fields of view per slide, 10 slots per run.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from ..session import deal, spread

BASE = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
        "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

#: Track steps of the fixture tables, a tenth of a chip's.
TRACK = (24, 30, 33, 39, 39, 33, 30, 24, 42)
PITCH = "(case i when 0 then 0 when 1 then 24 when 2 then 54 when 3 then 87 when 4 then 126 " \
        "when 5 then 165 when 6 then 198 when 7 then 228 else 252 end)"

BINDINGS: dict[str, str] = {
    "cells": """
select cast(floor(c/400) as bigint) chip, c+1 cell_id, c,
 (c%20)*20+30 cx, cast(floor((c%400)/20) as bigint)*20+30 cy,
 3+c%3 rn, 3+c%3+cast(floor(c/3) as bigint)%3 rb, c%5-2 sh,
 acct >= 0 has_boundary, seg in ('BUILDING','FURNITURE') has_interior,
 seg='MACHINERY' or seg='HOUSEHOLD' wide, nat >= 6 in_tissue, nat
from (select c_custkey c, c_acctbal acct, c_mktsegment seg, cast(c_nationkey as bigint) nat from {customer}) q""",
    "expression": """
select chip, gene, cx+(pk*31+ln*7)%25-12 x, cy+(sk*17+pk*3+ln*11)%25-12 y, mid
from (select l_orderkey ok, l_partkey pk, l_suppkey sk, cast(l_linenumber as bigint) ln,
             cast(floor(l_quantity) as bigint) mid from {lineitem}) l
 join (select o_orderkey, o_custkey from {orders}) o on l.ok=o.o_orderkey
 join {cells} cl on o.o_custkey=cl.c
 join (select p_partkey, p_brand gene from {part}) p on l.pk=p.p_partkey""",
    "mask_run": """
select chip, 'nuclei' layer, cell_id label, cy+d y, cx-(rn-abs(d)) x0, cx+(rn-abs(d)) x1
 from (select chip, cell_id, cx, cy, rn, SERIES(-rn, rn) d from {cells}) a
union all select chip, 'boundary', cell_id, cy+d, cx+sh-rb, cx+sh+rb
 from (select chip, cell_id, cx, cy, rb, sh, SERIES(-rb, rb) d from {cells} where has_boundary) b
union all select chip, 'interior', cell_id, cy+d, cx+1, cx+5
 from (select chip, cell_id, cx, cy, SERIES(-2, 2) d from {cells} where has_interior) e
union all select chip, 'matrix', cell_id, cy+d+(c%2)*13, cx-6, case when wide and c%2=0 then cx+26 else cx+6 end
 from (select chip, cell_id, c, cx, cy, wide, SERIES(-5+(c%2)*4, 5-(c%2)*4) d from {cells}) f
union all select chip, 'tissue', cast(1 as bigint), cy+d, cx-10, cx+9
 from (select chip, cx, cy, SERIES(-10, 9) d from {cells} where in_tissue) g""",
    "nuclei": "select chip, label, y, x0, x1 from {mask_run} where layer='nuclei'",
    "boundary": "select chip, label, y, x0, x1 from {mask_run} where layer='boundary'",
    "interior": "select chip, label, y, x0, x1 from {mask_run} where layer='interior'",
    "matrix": "select chip, label, y, x0, x1 from {mask_run} where layer='matrix'",
    "tissue": "select chip, label, y, x0, x1 from {mask_run} where layer='tissue'",
    "pixel": """
select chip img, y, x, cast(sum(mid) as bigint)*7%256 v from {expression} group by chip, y, x""",
    "pixel16": """
select chip img, y, x, cast(sum(mid) as bigint)*7 v from {expression} group by chip, y, x""",
    "pixel_rgb": """
select img, y, x, (v*3+x)%256 r, (v*5+y)%256 g, (v*11+x+y)%256 b from {pixel}""",
    "dnb": "select chip, x, y, cast(sum(mid) as bigint) mid from {expression} group by chip, x, y",
    "track_point": f"""
select chip, cast(floor(iy/10) as bigint) fov_row, cast(floor(ix/10) as bigint) fov_col,
 cast(floor(ix/9) as bigint)*294+px+(p*7)%9-4 x, cast(floor(iy/9) as bigint)*294+py+(p*5)%9-4 y,
 p%100 conf_pct, cast(floor(p/7) as bigint)%4 angle, p id
from (select chip, p, ix, iy, {PITCH.replace(' i ', ' ix%9 ')} px, {PITCH.replace(' i ', ' iy%9 ')} py
      from (select cast(floor(p_partkey/1600) as bigint) chip, p_partkey p, p_partkey%40 ix,
                   cast(floor(p_partkey/40) as bigint)%40 iy from {{part}}) a) b""",
    "template_point": f"""
select chip, cast(floor(ix/9) as bigint)*294+px x, cast(floor(iy/9) as bigint)*294+py y, ix%9 ix, iy%9 iy
from (select chip, ix, iy, {PITCH.replace(' i ', ' ix%9 ')} px, {PITCH.replace(' i ', ' iy%9 ')} py
      from (select cast(floor(p_partkey/1600) as bigint) chip, p_partkey%40 ix,
                   cast(floor(p_partkey/40) as bigint)%40 iy from {{part}}) a) b""",
    "fov": """
select cast(floor(p_partkey/400) as bigint) slide, cast(floor(p_partkey%400/20) as bigint) r, p_partkey%20 c,
 p_partkey%400 k from {part}""",
    "fov_jitter": """
select slide, r, c, 'h' axis,
 case when p%41=0 then null else -200+(p*13)%7-3+case when p%37=0 then 150 else 0 end end dx,
 case when p%41=0 then null else (p*11)%5-2 end dy, 3+p%20 conf
from (select cast(floor(p_partkey/400) as bigint) slide, cast(floor(p_partkey%400/20) as bigint) r,
             p_partkey%20 c, p_partkey p from {part}) a where c>0
union all select slide, r, c, 'v',
 case when p%43=0 then null else (p*11)%5-2 end,
 case when p%43=0 then null else -200+(p*17)%7-3 end, 3+p%17
from (select cast(floor(p_partkey/400) as bigint) slide, cast(floor(p_partkey%400/20) as bigint) r,
             p_partkey%20 c, p_partkey p from {part}) b where r>0""",
    "tile_class": """
select cast(floor(event_id/5000) as bigint) img, cast(floor(event_id%5000/100) as bigint) ty,
 event_id%100 tx, (event_id*7+cast(floor(event_id/13) as bigint))%6 cls from {events}""",
    "slots": """
select cast(floor(s/10) as bigint) run, s%10 slot,
 case s%6 when 0 then 'ssDNA' when 1 then 'DAPI' when 2 then 'HE' when 3 then 'IF'
          when 4 then 'Transcriptomics' else 'Protein' end tech,
 case when s%5=3 then 0 else -1 end channel_align, case when s%7=3 then 1 else -1 end reuse,
 1000+(nat%2)*50 w, cast(1000 as bigint) h, s, bal
from (select s_suppkey s, cast(s_nationkey as bigint) nat, s_acctbal bal from {supplier}) q""",
    "image_size": """
select s_suppkey img, 500+(s_suppkey*137)%900 h, 400+(s_suppkey*211)%1100 w from {supplier}""",
    "detection": """
select cast(floor(e/2500) as bigint) img, e id, (e*37)%1009 cx, (e*91)%1013 cy, 10+e%7 w, 12+e%5 h,
 (e*7919)%10007 score, e%3 cls from (select event_id e from {events}) q""",
    "chip_name": """
select c, case c%8
 when 0 then letter || num5 || tail || cast(c%9+1 as varchar(4))
 when 1 then letter || num5 || tail || cast(c%6+1 as varchar(4)) || tail2 || cast(c%6+1+c%3 as varchar(4))
 when 2 then letter || num5 || 'A1' || '11'
 when 3 then 'SS200000' || num5 || '_' || tail || cast(c%9 as varchar(4))
 when 4 then 'DP84000' || num5 || '_' || tail || cast(c%4+1 as varchar(4)) || tail2 || cast(c%4+1+c%3 as varchar(4))
 when 5 then letter || num5 || '9' || tail
 when 6 then letter || 'X' || substr(num5,2) || tail || cast(c%9 as varchar(4))
 else letter || num5 end sn
from (select c_custkey c, substr('ABCDYEFGHQJKLMNPSIZ', cast(c_custkey%19+1 as int), 1) letter,
  substr('ABCDEFG', cast(c_custkey%7+1 as int), 1) tail,
  substr('ABCDEFGH', cast(c_custkey%7+1+c_custkey%2 as int), 1) tail2,
  lpad(cast((c_custkey*7919)%100000 as varchar(8)), 5, '0') num5 from {customer}) q""",
    "border_vertex": """
select cell_id, chip, cx, cy, k idx,
 cast(floor((6+(c+k*k)%5)*cos(k*6.283185307179586/n)+0.50001) as bigint) dx,
 cast(floor((6+(c*3+k)%4)*sin(k*6.283185307179586/n)+0.50001) as bigint) dy, n
from (select cell_id, chip, cx, cy, c, n, SERIES(0, n-1) k
      from (select cell_id, chip, cx, cy, c, 5+c%28 n from {cells}) a) b""",
    "landmark": """
select grp, k, x, y, cast(x*1.5-y*0.25+12.0+k%3*0.125 as double) u, cast(x*0.25+y*1.5-7.0-k%2*0.25 as double) v
from (select cast(floor(s_suppkey/8) as bigint) grp, s_suppkey%8 k,
        cast((s_suppkey*s_suppkey*53)%997 as double) x, cast((s_suppkey*s_suppkey*29+s_suppkey*7)%991 as double) y from {supplier}) q""",
    "corner": """
select chip, k, cast(100.0+case when k in (2,3) then w else 0 end+(chip%4)*0.5*k as double) x,
 cast(100.0+case when k in (1,2) then h else 0 end+(chip%3)*1.25*k+case when chip%5=4 and k=2 then 40.0 else 0.0 end as double) y,
 w, h
from (select s_suppkey chip, cast(1000 as double) w, cast(1000+(s_suppkey%2)*200 as double) h, SERIES(0, 3) k from {supplier}) q""",
    "transcript": """
select l_orderkey, l_linenumber, p_brand feature_name, (l_extendedprice-floor(l_extendedprice/400)*400) x_location,
 l_quantity*7.25 y_location from {lineitem} l join {part} p on l.l_partkey=p.p_partkey""",
}

#: Bindings that join growing tables: by name, the sources that shuffle, as the planner takes their files for small.
SPREAD: dict[str, tuple[str, ...]] = {"expression": ("orders", "cells", "part"), "transcript": ("part",)}

#: Bindings that make many rows of one: by name, the source and its key that are dealt to many tasks before, as one task reads a small file.
DEAL: dict[str, tuple[str, str]] = {"mask_run": ("cells", "c")}

_NAME = re.compile(r"\{(\w+)\}")
_SERIES = re.compile(r"SERIES\(([^,]+(?:\([^)]*\)[^,]*)*), ([^()]*(?:\([^()]*\)[^()]*)*)\)")


def _spark(text: str) -> str:
    return _SERIES.sub(r"explode(sequence(cast(\1 as bigint), cast(\2 as bigint)))", text)


def _duck(text: str) -> str:
    text = _SERIES.sub(r"unnest(generate_series(cast(\1 as bigint), cast(\2 as bigint)))", text)
    return _NAME.sub(r"\1", text)


class Tables:
    """Lazy access to base tables and bindings as DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in BASE:
            return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        if name not in BINDINGS:
            raise AttributeError(name)
        text = BINDINGS[name]
        sources = {dep: getattr(self, dep) for dep in set(_NAME.findall(text))}
        sources |= {dep: spread(sources[dep]) for dep in SPREAD.get(name, ())}
        if name in DEAL:
            dep, key = DEAL[name]
            sources[dep] = deal(sources[dep], key, share=4)
        return self.spark.sql(_spark(text), **sources)

    def sql(self, text: str, **given: DataFrame) -> DataFrame:
        """Spark SQL over bindings named as ``{name}``, or over the tables ``given`` by that name."""
        return self.spark.sql(_spark(text), **{d: given[d] if d in given else getattr(self, d) for d in set(_NAME.findall(text))})


def _closure(name: str, out: list[str]) -> None:
    if name in out or name not in BINDINGS:
        return
    for dep in dict.fromkeys(_NAME.findall(BINDINGS[name])):
        _closure(dep, out)
    out.append(name)


def oracle_text(sql: str) -> str:
    """Prefix the bindings a statement mentions as common table expressions."""
    sql = sql.strip()
    needed: list[str] = []
    for name in BINDINGS:
        if re.search(rf"\b{name}\b", sql):
            _closure(name, needed)
    ctes = [f"{n} as ({_duck(BINDINGS[n]).strip()})" for n in needed]
    body = _SERIES.sub(r"unnest(generate_series(cast(\1 as bigint), cast(\2 as bigint)))", sql)
    head, recursive = body.lower(), False
    if head.startswith("with recursive "):
        ctes_own, recursive = body[len("with recursive "):], True
    elif head.startswith("with "):
        ctes_own = body[len("with "):]
    else:
        return f"with {', '.join(ctes)} {body}" if ctes else body
    return f"with {'recursive ' if recursive else ''}{', '.join([*ctes, ctes_own])}"
