"""Functions on groups, and the library's functions called from SQL."""

import pandas as pd

from ..functions import sql
from ..plans.groups import group_apply
from . import ORACLES, query


@query("i01_group_apply", """
select chip, gene, count(*) n, cast(sum(mid) as bigint) mid, min(x) x0, max(x) x1 from expression group by chip, gene""")
def _(t):
    def part(rows):
        return pd.DataFrame({"chip": [rows["chip"].iloc[0]], "gene": [rows["gene"].iloc[0]], "n": [len(rows)], "mid": [rows["mid"].sum()],
                             "x0": [rows["x"].min()], "x1": [rows["x"].max()]})

    def merge(parts):
        return pd.DataFrame({"chip": [parts["chip"].iloc[0]], "gene": [parts["gene"].iloc[0]], "n": [parts["n"].sum()], "mid": [parts["mid"].sum()],
                             "x0": [parts["x0"].min()], "x1": [parts["x1"].max()]})

    points = t.expression.select("chip", "gene", "x", "mid")
    return group_apply(points, ("chip", "gene"), part, "chip long, gene string, n long, mid long, x0 long, x1 long", merge, limit=200)


@query("i02_sql_functions")
def _(t):
    sql.register(t.spark)
    return t.sql("select sn, c, chip_name_type(sn) name_type, chip_is_large(sn) large, chip_width(sn) w, chip_height(sn) h, "
                 "chip_is_late(sn) late from {chip_name}")


ORACLES["i02_sql_functions"] = ORACLES["b19_parse_chip_no"]  # the same columns, by functions of the session


@query("i02_table_function", """
select img, cast(floor(y/64) as bigint) ty, cast(floor(x/64) as bigint) tx, count(*) n, cast(sum(v) as bigint) total, max(v) largest
from pixel group by 1,2,3""")
def _(t):
    def stats(rows):
        return pd.DataFrame({"img": [rows["img"].iloc[0]], "ty": [rows["ty"].iloc[0]], "tx": [rows["tx"].iloc[0]], "n": [len(rows)],
                             "total": [rows["v"].sum()], "largest": [rows["v"].max()]})

    sql.tile_function(t.spark, "tile_stats", stats, "img bigint, ty bigint, tx bigint, n bigint, total bigint, largest bigint")
    tiles = t.sql("select img, cast(floor(y/64) as bigint) ty, cast(floor(x/64) as bigint) tx, v from {pixel}")
    return sql.map_tiles(t.spark, "tile_stats", tiles, ("img", "ty", "tx"))
