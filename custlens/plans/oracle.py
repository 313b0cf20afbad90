"""Oracle SQL (DuckDB) for the registered queries.

Each string reads only the driver tables (fixture views are inlined as CTEs)
and must return the same columns, values and rows as the Spark query of the
same name.  Doubles listed by ``tidy.needs_rounding`` are rounded to 4
decimals on both sides; integers are ``bigint`` on both sides.
"""

from __future__ import annotations

from custlens.plans.oracle_views import with_views

R = "round({}, 4)"

T_CTE = ("t", """
select id, trx_tm as tm, amt,
       cast(weekofyear(trx_tm) as bigint) as week, cast(isodow(trx_tm) - 1 as bigint) as weekday,
       cast(hour(trx_tm) as bigint) as hour,
       case flg1 when 'B' then 0 when 'C' then 1 end as d1,
       flg3 as f3, cod1 as c1, cod2 as c2
from trd""")

# name -> (expression, numeric?) of the columns counted per customer
HIST_SOURCES = {
    "d1": ("d1", True), "f3": ("f3", False), "c1": ("c1", False), "c2": ("c2", False),
    "week": ("week", True), "weekday": ("weekday", True), "hour": ("hour", True),
    "amt_positive": ("case when amt > 0 then amt end", True),
    "amt_negative": ("case when amt < 0 then amt end", True),
}


def _mean(x: str) -> str:
    return f"round(sum({x}), 2) / nullif(count({x}), 0)"


def profile_columns(families: list[str]) -> tuple[list[tuple[str, str]], set[str]]:
    """Ordered ``(output, sql expression)`` over aliases ``w`` (wide aggregate)
    and ``h_<name>`` (histogram stats per column), plus the histogram columns used."""
    cols: list[tuple[str, str]] = []
    used: set[str] = set()

    def hist(name: str, stat: str) -> str:
        used.add(name)
        if stat == "mode":
            return (f"h_{name}.mode_s" if not HIST_SOURCES[name][1]
                    else f"cast(h_{name}.mode_x as bigint)")
        return f"h_{name}.{stat}"

    fam = set(families)
    if "flag1" in fam:
        cols += [("dat1_count", "w.dat1_count"),
                 ("dat1_nunique", f"coalesce({hist('d1', 'nunique')}, 0)"),
                 ("dat1_mean", "w.dat1_mean"),
                 ("dat1_modev", f"coalesce({hist('d1', 'freq')}, 0)")]
    if "codes" in fam:
        for src, out in (("f3", "dat3"), ("c1", "trx1"), ("c2", "trx2")):
            cols += [(f"{out}_nunique", f"coalesce({hist(src, 'nunique')}, 0)"),
                     (f"{out}_mode", hist(src, "mode")),
                     (f"{out}_modev", f"coalesce({hist(src, 'freq')}, 0)")]
    a = "cny_trx_amt"
    if "amount" in fam:
        cols += [(f"{a}_min", f"w.{a}_min"), (f"{a}_max", f"w.{a}_max"),
                 (f"{a}_mean", f"w.{a}_mean"), (f"{a}_median", R.format(f"w.{a}_median")),
                 (f"{a}_sum", f"w.{a}_sum")]
    if "signed" in fam:
        for sign, ext in (("positive", "min"), ("negative", "max")):
            cols += [(f"{a}_{sign}_nunique", hist(f"amt_{sign}", "nunique")),
                     (f"{a}_{sign}_{ext}", f"w.{a}_{sign}_{ext}"),
                     (f"{a}_{sign}_mean", f"w.{a}_{sign}_mean"),
                     (f"{a}_{sign}_median", R.format(f"w.{a}_{sign}_median")),
                     (f"{a}_{sign}_std", R.format(f"w.{a}_{sign}_std")),
                     (f"{a}_{sign}_sum", f"w.{a}_{sign}_sum")]
    if "calendar" in fam:
        cols += [("week_std2", R.format("w.week_std2")),
                 ("week_nunique2", f"coalesce({hist('week', 'nunique')}, 0)"),
                 ("week_mode2", hist("week", "mode")),
                 ("week_median2", "w.week_median2"), ("week_mean2", "w.week_mean2"),
                 ("week_mode2v", f"coalesce({hist('week', 'freq')}, 0)"),
                 ("week_kurl2", "w.week_kurl2"), ("week_mm2", "w.week_mm2"),
                 ("weekday_nunique2", f"coalesce({hist('weekday', 'nunique')}, 0)"),
                 ("weekday_mode2", hist("weekday", "mode")),
                 ("weekday_mode2v", f"coalesce({hist('weekday', 'freq')}, 0)"),
                 ("hour_nunique2", f"coalesce({hist('hour', 'nunique')}, 0)"),
                 ("hour_mode2v", f"coalesce({hist('hour', 'freq')}, 0)")]
    if "flag3" in fam:
        for v in ("A", "B", "C"):
            for s in ("max", "min", "median", "std", "mean", "sum"):
                e = f"coalesce(w.{v}_{s}, 0)"
                cols.append((f"{v}_{s}", R.format(e) if s in ("median", "std") else e))
    if "buckets" in fam:
        cols += [("week_max2", hist("week", "freq")), ("week_min2", hist("week", "minfreq")),
                 ("weekday_max2", hist("weekday", "freq")),
                 ("weekday_min2", hist("weekday", "minfreq"))]
    return cols, used


def wide_aggregates(families: list[str]) -> list[str]:
    fam = set(families)
    a = "cny_trx_amt"
    out = []
    if "flag1" in fam:
        out += ["count(d1) as dat1_count", "avg(d1) as dat1_mean"]
    if "amount" in fam:
        out += [f"min(amt) as {a}_min", f"max(amt) as {a}_max", f"{_mean('amt')} as {a}_mean",
                f"median(amt) as {a}_median", f"coalesce(round(sum(amt), 2), 0) as {a}_sum"]
    if "signed" in fam:
        for sign, op, ext in (("positive", ">", "min"), ("negative", "<", "max")):
            x = f"case when amt {op} 0 then amt end"
            out += [f"{ext}({x}) as {a}_{sign}_{ext}", f"{_mean(x)} as {a}_{sign}_mean",
                    f"median({x}) as {a}_{sign}_median", f"stddev_samp({x}) as {a}_{sign}_std",
                    f"round(sum({x}), 2) as {a}_{sign}_sum"]
    if "calendar" in fam:
        out += ["stddev_samp(week) as week_std2", "cast(median(week) as double) as week_median2",
                "avg(week) as week_mean2",
                "avg(week) - cast(median(week) as double) as week_kurl2",
                "max(week) - min(week) as week_mm2"]
    if "flag3" in fam:
        for v in ("A", "B", "C"):
            x = f"case when f3 = '{v}' then amt end"
            out += [f"max({x}) as {v}_max", f"min({x}) as {v}_min", f"median({x}) as {v}_median",
                    f"stddev_samp({x}) as {v}_std", f"{_mean(x)} as {v}_mean",
                    f"round(sum({x}), 2) as {v}_sum"]
    return out


def _mode_cte(name: str, numeric: bool) -> tuple[str, str]:
    return (f"h_{name}", f"""
select id, count(*) as nunique, max(c) as freq, min(c) as minfreq,
       max(case when rn = 1 then x end) as mode_x, max(case when rn = 1 then s end) as mode_s
from (select *, row_number() over (partition by id order by c desc, x asc, s asc) as rn
      from hc_{name})
group by id""")


def profile_ctes(families: list[str]) -> tuple[list[tuple[str, str]], list[str]]:
    """CTEs ending in ``p`` (one row per customer present in ``trd``) and the
    output column names."""
    cols, used = profile_columns(families)
    ctes = [T_CTE]
    aggs = wide_aggregates(families)
    ctes.append(("w", "select id, " + ", ".join(["count(*) as _rows"] + aggs)
                 + " from t group by id"))
    joins = ""
    for name in sorted(used):
        expr, numeric = HIST_SOURCES[name]
        x = f"cast({expr} as double)" if numeric else "cast(null as double)"
        s = "cast(null as varchar)" if numeric else f"cast({expr} as varchar)"
        ctes.append((f"hc_{name}", f"""
select id, x, s, count(*) as c
from (select id, {x} as x, {s} as s from t) where x is not null or s is not null
group by id, x, s"""))
        ctes.append(_mode_cte(name, numeric))
        joins += f" left join h_{name} on h_{name}.id = w.id"
    ctes.append(("p", "select w.id, " + ", ".join(f"{e} as {o}" for o, e in cols)
                 + " from w" + joins))
    return ctes, [o for o, _ in cols]


def per_customer_profile_sql(families: list[str]) -> str:
    """Customers left-joined to the transaction profile of ``families``."""
    ctes, names = profile_ctes(families)
    return with_views(["trd", "tag"], ctes,
                      "select tag.id, " + ", ".join(f"p.{o}" for o in names)
                      + " from tag left join p on p.id = tag.id")


def gap_sql(source: str, tm: str, suffix: str) -> str:
    return with_views([source, "tag"], [("g", f"""
select id, date_sub('day', lag({tm}) over (partition by id order by {tm}), {tm}) as days
from {source} where {tm} is not null"""), ("s", f"""
select id, max(days) as max_day_diff{suffix}, avg(days) as mean_day_diff{suffix},
       round(stddev_samp(days), 4) as std_day_diff{suffix}
from g group by id""")],
        f"select tag.id, s.max_day_diff{suffix}, s.mean_day_diff{suffix}, s.std_day_diff{suffix} "
        f"from tag left join s on s.id = tag.id")
