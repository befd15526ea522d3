"""SQL fragments shared by several DuckDB statements."""

from __future__ import annotations


def runs_of(src: str, out: str, label: str = "cast(1 as bigint)") -> str:
    """Pixels ``src(chip, y, x)`` as runs ``out(chip, label, y, x0, x1)``."""
    return f"""{out}_g as (select chip, y, x, x-row_number() over (partition by chip, y order by x) k from {src}),
{out} as (select chip, {label} label, y, min(x) x0, max(x) x1 from {out}_g group by chip, y, k)"""


def pixels_of(runs: str, out: str) -> str:
    return f"{out} as (select distinct chip, y, unnest(generate_series(x0, x1)) x from {runs})"


def components_of(src: str, out: str, conn: int) -> str:
    """Label pixels ``src(chip, y, x)``: ``out(chip, label, y, x0, x1)`` by closing the run graph.

    Only for masks of small objects: the closure has a row per pair of runs of an object.
    """
    reach = 1 if conn == 8 else 0
    return f"""{runs_of(src, out + '_r')},
{out}_n as (select *, y*2147483648+x0+1 id from {out}_r),
{out}_e as (select a.chip, a.id u, b.id v from {out}_n a join {out}_n b on a.chip=b.chip and b.y=a.y+1
  and b.x0<=a.x1+{reach} and b.x1>=a.x0-{reach}),
{out}_b as (select chip, u, v from {out}_e union all select chip, v, u from {out}_e),
{out}_c as (select chip, id u, id v from {out}_n union select c.chip, c.u, b.v from {out}_c c join {out}_b b on b.chip=c.chip and b.u=c.v),
{out}_m as (select chip, u, min(v) root from {out}_c group by chip, u),
{out} as (select n.chip, m.root label, y, x0, x1 from {out}_n n join {out}_m m on m.chip=n.chip and m.u=n.id)"""


def big_enough(src: str, out: str, size: int) -> str:
    return f"""{out} as (select s.* from {src} s join (select chip, label from {src} group by 1,2 having sum(x1-x0+1)>={size}) k
  on k.chip=s.chip and k.label=s.label)"""


def fragments_kept(objects: str, frag_px: str, out: str, thr: float) -> str:
    """Pixels of the fragments that keep at least ``thr`` of their object (labelled runs ``objects``)."""
    return f"""{out}_op as (select chip, label, y, unnest(generate_series(x0,x1)) x from {objects}),
{out}_in as (select o.chip, o.y, o.x from {out}_op o join {frag_px} f on f.chip=o.chip and f.y=o.y and f.x=o.x),
{components_of(out + '_in', out + '_pc', 4)},
{out}_pp as (select chip, label, y, unnest(generate_series(x0,x1)) x from {out}_pc),
{out}_sz as (select chip, label, count(*) n from {out}_op group by 1,2),
{out}_ok as (select p.chip, p.label from {out}_pp p join {out}_op o on o.chip=p.chip and o.y=p.y and o.x=p.x
  join {out}_sz s on s.chip=o.chip and s.label=o.label group by p.chip, p.label, o.label, s.n having count(*)/s.n>={thr}),
{out} as (select p.chip, p.y, p.x from {out}_pp p join {out}_ok k on k.chip=p.chip and k.label=p.label
  union select f.chip, f.y, f.x from {frag_px} f where not exists (select 1 from {out}_op o where o.chip=f.chip and o.y=f.y and o.x=f.x))"""


def overlap_merge_of(sec: str, pri: str, out: str, thr: float, size: int = 15) -> str:
    """Pixels ``out`` of primary plus kept secondary without the outline of the kept part."""
    o = out
    return f"""{o}_d as (select a.* from {sec} a left join {pri} b on b.chip=a.chip and b.y=a.y and b.x=a.x where b.x is null),
{components_of(o + '_d', o + '_cc', 4)}, {big_enough(o + '_cc', o + '_lf', size)}, {pixels_of(o + '_lf', o + '_lp')},
{components_of(sec, o + '_ob', 8)}, {fragments_kept(o + '_ob', o + '_lp', o + '_kept', thr)},
{o}_edge as (select k.* from {o}_kept k left join (select chip, y+1 y, x from {o}_kept union all select chip, y-1, x from {o}_kept
  union all select chip, y, x+1 from {o}_kept union all select chip, y, x-1 from {o}_kept) q on q.chip=k.chip and q.y=k.y and q.x=k.x
  group by k.chip, k.y, k.x having count(q.x)<4),
{o}_un as (select * from {pri} union select * from {o}_kept),
{o} as (select u.* from {o}_un u left join {o}_edge e on e.chip=u.chip and e.y=u.y and e.x=u.x where e.x is null)"""
