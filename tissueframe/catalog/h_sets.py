"""Set operations on points and masks."""

from pyspark.sql import functions as F

from ..operators import masks
from . import query


@query("h01_stack_points", """
select chip, 'detected' source, x, y from track_point union all select chip, 'template', x, y from template_point""")
def _(t):
    return (t.track_point.select("chip", F.lit("detected").alias("source"), "x", "y")
            .unionByName(t.template_point.select("chip", F.lit("template").alias("source"), "x", "y")))


@query("h02_mask_union", """
with p as (select distinct chip, y, unnest(generate_series(x0,x1)) x from (select * from boundary union all select * from matrix)),
g as (select *, x-row_number() over (partition by chip, y order by x) k from p)
select chip, cast(1 as bigint) label, y, min(x) x0, max(x) x1 from g group by chip, y, k""")
def _(t):
    return masks.mask_union(t.boundary, t.matrix)


@query("h03_label_in", "select b.* from boundary b where exists (select 1 from interior i where i.chip=b.chip and i.label=b.label)")
def _(t):
    return t.boundary.join(t.interior.select("chip", "label").distinct(), ["chip", "label"], "left_semi").select(
        "chip", "label", "y", "x0", "x1")


@query("h03_label_not_in", "select b.* from boundary b where not exists (select 1 from interior i where i.chip=b.chip and i.label=b.label)")
def _(t):
    return t.boundary.join(t.interior.select("chip", "label").distinct(), ["chip", "label"], "left_anti").select(
        "chip", "label", "y", "x0", "x1")


@query("h04_distinct_labels", "select distinct layer, chip, label from mask_run")
def _(t):
    return t.mask_run.select("layer", "chip", "label").distinct()
