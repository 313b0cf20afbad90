"""Oracle SQL strings keyed like ``custlens.plans.queries.QUERIES``."""

from __future__ import annotations

from custlens.plans.oracle import R, gap_sql, per_customer_profile_sql, profile_ctes
from custlens.plans.oracle_views import with_views

ORACLE: dict[str, str] = {
    "spend_profile": per_customer_profile_sql(["amount", "calendar"]),
    "signed_spend_profile": per_customer_profile_sql(["signed"]),
    "flag_profile": per_customer_profile_sql(["flag1"]),
    "code_profile": per_customer_profile_sql(["codes"]),
    "spend_by_flag_pivot": per_customer_profile_sql(["flag3"]),
    "bucket_extremes": per_customer_profile_sql(["buckets"]),
    "trx_gap_stats": gap_sql("trd", "trx_tm", ""),
    "page_gap_stats": gap_sql("beh", "page_tm", "2"),
    "calendar_parts": with_views(["beh"], [], """
select id, page_tm, page, cast(dayofyear(page_tm) as bigint) as day,
       cast(weekofyear(page_tm) as bigint) as week, cast(isodow(page_tm) - 1 as bigint) as weekday,
       cast(hour(page_tm) as bigint) as hour
from beh"""),
    "bucket_counts_rowwise": with_views(["trd"], [("t", """
select id, l_orderkey, l_linenumber, trx_tm,
       cast(weekofyear(trx_tm) as bigint) as week, cast(isodow(trx_tm) - 1 as bigint) as weekday
from trd""")], """
select id, l_orderkey, l_linenumber, trx_tm, week, weekday,
       count(trx_tm) over (partition by id, week) as trx_tm_week,
       count(trx_tm) over (partition by id, weekday) as trx_tm_weekday
from t"""),
}


SENT = "(chr(92) || 'N', '31', '30')"


def _money_sql(user_views: list[str], users_ctes: list[tuple[str, str]], users: str,
               cats: list[str], keep: list[str], drop_cats: bool,
               rows: str = "select id, amt from trd") -> str:
    """Category money encodings of ``cats`` (columns of CTE ``users``) over ``rows``."""
    unions = " union all ".join(
        f"select '{c}' as n, cast(u.{c} as varchar) as v, x.amt from x join {users} u on u.id = x.id "
        f"where u.{c} is not null" for c in cats)
    ctes = users_ctes + [("x", rows), ("lng", unions), ("enc", """
select n, v,
       round(median(amt), 4) as m_all, coalesce(round(sum(amt), 2), 0) as s_all,
       round(median(case when amt > 0 then amt end), 4) as m_pos,
       round(sum(case when amt > 0 then amt end), 2) as s_pos,
       round(median(case when amt < 0 then amt end), 4) as m_neg,
       round(sum(case when amt < 0 then amt end), 2) as s_neg
from lng group by n, v""")]
    sel = [f"{users}.{k}" for k in keep]
    if not drop_cats:
        sel += [f"{users}.{c}" for c in cats]
    joins = ""
    for i, c in enumerate(cats):
        a = f"e{i}"
        sel += [f"{a}.m_all as {c}_cny_median", f"{a}.s_all as {c}_cny_sum",
                f"{a}.m_pos as {c}pos_cny_median", f"{a}.s_pos as {c}pos_cny_sum",
                f"{a}.m_neg as {c}neg_cny_median", f"{a}.s_neg as {c}neg_cny_sum"]
        joins += (f" left join enc {a} on {a}.n = '{c}' and "
                  f"{a}.v = cast({users}.{c} as varchar)")
    return with_views(user_views, ctes, "select " + ", ".join(sel) + f" from {users}" + joins)


def _mode_money_sql() -> str:
    ctes, _ = profile_ctes(["codes", "calendar"])
    ctes = ctes + [("um", "select tag.id, tag.split, " + ", ".join(f"p.{c}" for c in
                    ["dat3_mode", "trx1_mode", "trx2_mode", "week_mode2", "weekday_mode2"])
                    + " from tag left join p on p.id = tag.id")]
    return _money_sql(["trd", "tag"], ctes, "um",
                      ["dat3_mode", "trx1_mode", "trx2_mode", "week_mode2", "weekday_mode2"],
                      ["id", "split"], drop_cats=True)


_IMP_CTES = [("thr", """
select feature, quantile_cont(importance_split, 0.25) as ts,
       quantile_cont(importance_gain, 0.25) as tg
from imp_actual where feature is not null group by feature"""), ("agg", """
select n.feature, count(*) as r,
       sum(case when n.importance_split < thr.ts then 1 else 0 end) as hs,
       sum(case when n.importance_gain < thr.tg then 1 else 0 end) as hg
from imp_null n join thr on n.feature = thr.feature group by n.feature"""), ("sc", """
select thr.feature, cast(100 as double) * agg.hs / agg.r as split_score,
       cast(100 as double) * agg.hg / agg.r as gain_score
from thr left join agg on agg.feature = thr.feature""")]

_SCORED = [("s", """
select scores.model, scores.fold, scores.score, tag.flag as label
from scores join tag on scores.id = tag.id"""), ("g", """
select model, fold, score, sum(label) as pos, count(*) - sum(label) as neg
from s group by model, fold, score"""), ("cu", """
select *, sum(neg) over (partition by model, fold order by score
                         rows between unbounded preceding and current row) as cneg
from g"""), ("a", """
select cast(model as bigint) as model, cast(fold as bigint) as fold,
       sum(pos * (cneg - neg + cast(0.5 as double) * neg)) / (sum(pos) * sum(neg)) as auc,
       cast(sum(pos) as bigint) as n_pos, cast(sum(neg) as bigint) as n_neg
from cu group by model, fold""")]

ORACLE.update({
    "member_fill": with_views(["tag", "beh"], [
        ("m", "select distinct id, 1 as has_beh from beh where id is not null"),
        ("c", """
select id, count(*) filter (where page = 'click') as click,
       count(*) filter (where page = 'error') as error,
       count(*) filter (where page = 'purchase') as purchase,
       count(*) filter (where page = 'signup') as signup,
       count(*) filter (where page = 'view') as "view"
from beh group by id""")], """
select tag.id, cast(coalesce(m.has_beh, 0) as bigint) as has_beh,
       case when m.has_beh = 1 then coalesce(c.click, 0) end as click,
       case when m.has_beh = 1 then coalesce(c.error, 0) end as error,
       case when m.has_beh = 1 then coalesce(c.purchase, 0) end as purchase,
       case when m.has_beh = 1 then coalesce(c.signup, 0) end as signup,
       case when m.has_beh = 1 then coalesce(c."view", 0) end as "view"
from tag left join m on m.id = tag.id left join c on c.id = tag.id"""),
    "product_features": with_views(["tag"], [], """
select id, buy_a, buy_b, buy_c, buy_a * buy_b as rate_ab, buy_a * buy_c as rate_ac,
       buy_b * buy_c as rate_bc
from tag"""),
    "ratio_features": with_views(["tag"], [("r", """
select id, buy_a, buy_b, buy_c,
       coalesce(buy_a, 0) + coalesce(buy_b, 0) + coalesce(buy_c, 0) as buy_sum from tag""")], """
select id, buy_a, buy_b, buy_c, buy_sum, buy_a / (buy_sum + 1) as buy_a_ratio,
       buy_b / (buy_sum + 1) as buy_b_ratio, buy_c / (buy_sum + 1) as buy_c_ratio
from r"""),
    "null_sentinels": with_views(["tag_text"], [("p", f"""
select max(case when brand_txt in {SENT} then 1 else 0 end) as bs,
       max(case when brand_txt = '-1' and split = 'train' then 1 else 0 end) as bn,
       max(case when type_txt in {SENT} then 1 else 0 end) as ts,
       max(case when type_txt = '-1' and split = 'train' then 1 else 0 end) as tn,
       min(case when split = 'train' then try_cast(case when size_txt not in {SENT}
           then size_txt end as double) end) as smt,
       min(case when split <> 'train' then try_cast(case when size_txt not in {SENT}
           then size_txt end as double) end) as sms
from tag_text"""), ("x", f"""
select id, split, brand_txt, type_txt,
       try_cast(case when size_txt not in {SENT} then size_txt end as double) as size_num
from tag_text""")], f"""
select x.id, x.split,
       case when p.bs = 0 then x.brand_txt
            when p.bn = 0 then case when x.brand_txt in {SENT} then null else x.brand_txt end
            else case when x.brand_txt in {SENT} or x.brand_txt = '-1' then null
                      else x.brand_txt end end as brand_txt,
       case when p.ts = 0 then x.type_txt
            when p.tn = 0 then case when x.type_txt in {SENT} then null else x.type_txt end
            else case when x.type_txt in {SENT} or x.type_txt = '-1' then null
                      else x.type_txt end end as type_txt,
       case when (p.smt = -1 or p.sms = -1) and x.size_num = -1 then null
            else x.size_num end as size_txt
from x, p"""),
    "clean_customers": """
select id, split, cast(age as double) as age, try_cast(case
         when split = 'score' and mixed in (chr(92) || 'N', '31', '30') then null else mixed end as double) as mixed
from (select p_partkey as id, case when p_partkey % 5 = 0 then 'score' else 'train' end as split,
             case when p_partkey % 13 = 0 then '-1' else cast(p_size as varchar) end as age,
             case when p_partkey % 85 = 0 then chr(92) || 'N' else cast(p_size as varchar) end as mixed
      from part)""",
    "narrow_types": """
select cast(l_orderkey as smallint) as l_orderkey, cast(l_partkey as smallint) as l_partkey,
       cast(l_suppkey as tinyint) as l_suppkey, cast(l_linenumber as tinyint) as l_linenumber,
       cast(l_quantity as float) as l_quantity, cast(l_extendedprice as float) as l_extendedprice,
       cast(l_discount as float) as l_discount, cast(l_tax as float) as l_tax,
       l_returnflag, l_linestatus, l_shipdate
from lineitem""",
    "woe_encode": with_views(["tag"], [
        ("tr", "select * from tag where split = 'train'"),
        ("tot", "select sum(flag) as pos, count(*) - sum(flag) as neg from tr"),
        ("cls", """
select seg_cd as v, sum(flag) as pos_c, count(*) as n_c from tr
where seg_cd is not null group by seg_cd"""),
        ("w", """
select v, ln((pos_c / (select pos from tot)) * ((select neg from tot) / (n_c - pos_c))) as woe
from cls""")], """
select cast(tag.id as bigint) as id, cast(tag.flag as bigint) as flag, tag.split, tag.seg_cd,
       tag.nat_cd, round(w.woe, 4) as seg_cd_crossentroy
from tag left join w on w.v = tag.seg_cd"""),
    "woe_out_of_fold": with_views(["tag"], [
        ("u", "select *, cast(id % 5 as integer) as fold from tag"),
        ("tr", "select * from u where split = 'train'"),
        ("tot", "select sum(flag) as pos, count(*) - sum(flag) as neg from tr"),
        ("ft", "select fold, sum(flag) as fp, count(*) as fn from tr group by fold"),
        ("cls", """
select seg_cd as v, sum(flag) as pos_c, count(*) as n_c from tr
where seg_cd is not null group by seg_cd"""),
        ("clf", """
select seg_cd as v, fold, sum(flag) as pf, count(*) as nf from tr
where seg_cd is not null group by seg_cd, fold"""),
        ("w", """
select v, ln((pos_c / (select pos from tot)) * ((select neg from tot) / (n_c - pos_c))) as woe
from cls"""),
        ("wf", """
select cls.v, ft.fold,
       ln(((cls.pos_c - coalesce(clf.pf, 0)) / ((select pos from tot) - ft.fp))
          * (((select neg from tot) - (ft.fn - ft.fp))
             / ((cls.n_c - coalesce(clf.nf, 0)) - (cls.pos_c - coalesce(clf.pf, 0))))) as woe
from cls cross join ft left join clf on clf.v = cls.v and clf.fold = ft.fold""")], """
select cast(u.id as bigint) as id, cast(u.flag as bigint) as flag, u.split, u.seg_cd, u.nat_cd,
       cast(u.fold as bigint) as fold,
       round(case when u.split = 'train' then wf.woe else w.woe end, 4) as seg_cd_crossentroy
from u left join w on w.v = u.seg_cd left join wf on wf.v = u.seg_cd and wf.fold = u.fold"""),
    "category_money": _money_sql(["trd", "tag"], [], "tag", ["seg_cd", "nat_cd"],
                                 ["id", "split"], drop_cats=False),
    "mode_money": _mode_money_sql(),
    "importance_scores": with_views(["imp_null", "imp_actual"], _IMP_CTES,
                                    "select feature, split_score, gain_score from sc"),
    "importance_select": with_views(["imp_null", "imp_actual"], _IMP_CTES, """
select feature, gain_score, false as is_categorical from sc where gain_score >= 40"""),
    "token_sequences": with_views(["trd"], [("r", """
select id, coalesce(cast(cod2 as varchar), 'nan') as tok,
       row_number() over (partition by id order by trx_tm nulls first, l_orderkey nulls first,
                          l_linenumber nulls first, coalesce(cast(cod2 as varchar), 'nan')) as rn
from trd where id is not null""")], """
select id, cast(floor((rn - 1) / 1000) as bigint) as seq_no, list(tok order by rn) as tokens
from r group by id, seq_no"""),
    "mean_vector": """
with e as (select label, unnest(embedding) as x,
                  unnest(generate_series(0, len(embedding) - 1)) as pos
           from embeddings),
     m as (select label, pos, avg(cast(x as double)) as m from e group by label, pos)
select cast(label as bigint) as label, list(round(m, 6) order by pos) as mean_vec
from m group by label""",
    "fold_assign": with_views(["tag", "trd"], [
        ("u", """
select tag.id, case when exists (select 1 from trd where trd.id = tag.id) then 1 else 0 end
       as has_trx
from tag where split = 'train'"""),
        ("c", "select has_trx, count(*) as n from u group by has_trx"),
        ("f", "select has_trx, n, unnest([0, 1, 2, 3, 4]) as fold from c")], """
select cast(has_trx as bigint) as has_trx, cast(fold as bigint) as fold,
       cast((n - fold + 4) // 5 as bigint) as n
from f where (n - fold + 4) // 5 > 0"""),
    "auc_by_fold": with_views(["tag", "scores"], _SCORED, "select * from a"),
    "auc_summary": with_views(["tag", "scores"], _SCORED, """
select model, round(avg(auc), 4) as mean_auc, round(stddev_pop(auc), 4) as std_auc
from a group by model"""),
    "score_blend": with_views(["tag", "scores"], [
        ("pm", "select id, model, avg(score) as m from scores group by id, model")], """
select id, round(avg(m), 4) as score from pm group by id"""),
})


def _gap_ctes(source: str, tm: str, suffix: str, name: str) -> list[tuple[str, str]]:
    return [(f"{name}_g", f"""
select id, date_sub('day', lag({tm}) over (partition by id order by {tm}), {tm}) as days
from {source} where {tm} is not null"""), (name, f"""
select id, max(days) as max_day_diff{suffix}, avg(days) as mean_day_diff{suffix},
       round(stddev_samp(days), 4) as std_day_diff{suffix}
from {name}_g group by id""")]


def _customer_features_sql() -> str:
    from custlens.operators.profile import FAMILIES
    prof, prof_cols = profile_ctes(list(FAMILIES))
    base = ("b", """
select id, flag, split, seg_cd, nat_cd, buy_a, buy_b, buy_c,
       buy_a * buy_b as rate_ab, buy_a * buy_c as rate_ac, buy_b * buy_c as rate_bc,
       buy_sum, buy_a / (buy_sum + 1) as buy_a_ratio, buy_b / (buy_sum + 1) as buy_b_ratio,
       buy_c / (buy_sum + 1) as buy_c_ratio
from (select *, coalesce(buy_a, 0) + coalesce(buy_b, 0) + coalesce(buy_c, 0) as buy_sum from tag)""")
    woe = [("wtr", "select * from tag where split = 'train'"),
           ("wtot", "select sum(flag) as pos, count(*) - sum(flag) as neg from wtr"),
           ("wcls", "select seg_cd as v, sum(flag) as pos_c, count(*) as n_c from wtr "
                    "where seg_cd is not null group by seg_cd"),
           ("wmap", "select v, ln((pos_c / (select pos from wtot)) * ((select neg from wtot) / "
                    "(n_c - pos_c))) as woe from wcls")]
    cats = ["seg_cd", "nat_cd"]
    unions = " union all ".join(
        f"select '{c}' as n, cast(b.{c} as varchar) as v, mx.amt from mx join b on b.id = mx.id "
        f"where b.{c} is not null" for c in cats)
    money = [("mx", "select id, amt from trd"), ("mlng", unions), ("menc", """
select n, v,
       round(median(amt), 4) as m_all, coalesce(round(sum(amt), 2), 0) as s_all,
       round(median(case when amt > 0 then amt end), 4) as m_pos,
       round(sum(case when amt > 0 then amt end), 2) as s_pos,
       round(median(case when amt < 0 then amt end), 4) as m_neg,
       round(sum(case when amt < 0 then amt end), 2) as s_neg
from mlng group by n, v""")]
    sel = ["b.*"] + [f"p.{c}" for c in prof_cols]
    sel += [f"s1.{c}_day_diff" for c in ("max", "mean", "std")]
    sel += [f"s2.{c}_day_diff2" for c in ("max", "mean", "std")]
    sel.append("round(wmap.woe, 4) as seg_cd_crossentroy")
    joins = (" left join p on p.id = b.id left join s1 on s1.id = b.id"
             " left join s2 on s2.id = b.id left join wmap on wmap.v = b.seg_cd")
    for i, c in enumerate(cats):
        a = f"e{i}"
        sel += [f"{a}.m_all as {c}_cny_median", f"{a}.s_all as {c}_cny_sum",
                f"{a}.m_pos as {c}pos_cny_median", f"{a}.s_pos as {c}pos_cny_sum",
                f"{a}.m_neg as {c}neg_cny_median", f"{a}.s_neg as {c}neg_cny_sum"]
        joins += f" left join menc {a} on {a}.n = '{c}' and {a}.v = cast(b.{c} as varchar)"
    ctes = ([base] + prof + _gap_ctes("trd", "trx_tm", "", "s1")
            + _gap_ctes("beh", "page_tm", "2", "s2") + woe + money)
    return with_views(["trd", "tag", "beh"], ctes, "select " + ", ".join(sel) + " from b" + joins)


ORACLE["customer_features"] = _customer_features_sql()


_FLAGGED = ["cny_trx_amt_max", "cny_trx_amt_positive_median", "cny_trx_amt_negative_std", "buy_a"]


def _missing_flags_sql() -> str:
    ctes, _ = profile_ctes(["amount", "signed"])
    ctes.append(("r", "select tag.id, tag.split, tag.buy_a, p.* exclude (id) from tag left join p on p.id = tag.id"))
    ctes.append(("f", "select " + ", ".join(
        f"count(*) - count({c}) as k_{c}, coalesce(case when count(*) > count({c}) then median({c}) else avg({c}) end, 0)"
        f" as v_{c}" for c in _FLAGGED) + " from r where split = 'train'"))
    return with_views(["trd", "tag"], ctes, "select r.id, r.split, " + ", ".join(
        f"{R.format(f'coalesce(r.{c}, f.v_{c})')} as {c}, "
        f"cast(case when f.k_{c} > 0 and r.{c} is null then 1 else 0 end as bigint) as {c}_missing"
        for c in _FLAGGED) + " from r, f")


def _ordered_target_sql() -> str:
    before = "(partition by {} order by h, id rows between unbounded preceding and 1 preceding)"
    own = ", ".join(f"(coalesce(sum(flag) over {before.format(c)}, 0) + prior)"
                    f" / (count(*) over {before.format(c)} + 1) as own_{c}" for c in ("seg_cd", "nat_cd"))
    ctes = [("tr", "select *, md5(cast(id as varchar) || ':999') as h from tag where split = 'train'"),
            ("pr", "select cast(avg(flag) as double) as prior from tr"),
            ("o", f"select tr.id, {own} from tr, pr")]
    ctes += [(f"t_{c}", f"select {c}, (sum(flag) + any_value(prior)) / (count(*) + 1) as v from tr, pr group by {c}")
             for c in ("seg_cd", "nat_cd")]
    value = ", ".join(f"case when tag.{c} is null then null when tag.split = 'train' then o.own_{c} "
                      f"else coalesce(t_{c}.v, prior) end as {c}_target" for c in ("seg_cd", "nat_cd"))
    return with_views(["tag"], ctes, f"""
select cast(tag.id as bigint) as id, cast(tag.flag as bigint) as flag, tag.split, tag.seg_cd, tag.nat_cd, {value}
from tag cross join pr left join o on o.id = tag.id left join t_seg_cd on t_seg_cd.seg_cd = tag.seg_cd
     left join t_nat_cd on t_nat_cd.nat_cd = tag.nat_cd""")


def _page_profile_sql() -> str:
    ctes, names = profile_ctes(["flag1", "codes", "calendar", "flag3"])
    return with_views(["page_trd", "tag"], [("trd", "select * from page_trd"), *ctes],
                      "select tag.id, " + ", ".join(f"p.{o}" for o in names) + " from tag left join p on p.id = tag.id")


def _narrow_plan_sql() -> str:
    ints = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    floats = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    bounds = [f"min({c}) as lo_{c}, max({c}) as hi_{c}" for c in ints + floats]
    rows = [f"""
select '{c}' as "column", case when lo_{c} > -128 and hi_{c} < 127 then 'tinyint'
       when lo_{c} > -32768 and hi_{c} < 32767 then 'smallint'
       when lo_{c} > -2147483648 and hi_{c} < 2147483647 then 'int' else 'bigint' end as type from b""" for c in ints]
    rows += [f"""
select '{c}' as "column", case when lo_{c} > -3.4028235e38 and hi_{c} < 3.4028235e38 then 'float' else 'double' end as type
from b""" for c in floats]
    rows += [f"select '{c}', '{t}'" for c, t in
             (("l_returnflag", "string"), ("l_linestatus", "string"), ("l_shipdate", "timestamp_ntz"))]
    return with_views([], [("b", "select " + ", ".join(bounds) + " from lineitem")], " union all ".join(rows))


ORACLE.update({
    "category_money_copies2": _money_sql(
        ["trd", "tag"], [], "tag", ["seg_cd", "nat_cd"], ["id", "split"], drop_cats=False,
        rows="select id, amt from trd union all "
             "select trd.id, amt from trd join tag on tag.id = trd.id where tag.split = 'score'"),
    "ordered_target": _ordered_target_sql(),
    "missing_flags": _missing_flags_sql(),
    "rejects": with_views(["text_amounts"], [], """
select 'lineitem' as source, id,
       concat_ws(',', case when quantity is not null and try_cast(quantity as double) is null then 'quantity' end,
                 case when shipped is not null and try_cast(shipped as date) is null then 'shipped' end) as bad_columns,
       quantity, shipped
from text_amounts
where (quantity is not null and try_cast(quantity as double) is null)
   or (shipped is not null and try_cast(shipped as date) is null)"""),
    "parsed_rows": with_views(["text_amounts"], [], """
select id, try_cast(quantity as double) as quantity, try_cast(shipped as date) as shipped from text_amounts
where not (quantity is not null and try_cast(quantity as double) is null)
  and not (shipped is not null and try_cast(shipped as date) is null)"""),
    "page_profile": _page_profile_sql(),
    "token_sequences_short": ORACLE["token_sequences"].replace("(rn - 1) / 1000", "(rn - 1) / 7"),
    "narrow_plan": _narrow_plan_sql(),
    "woe_table": with_views(["tag"], [
        ("lng", "select 'seg_cd' as c, seg_cd as v, flag, split from tag union all "
                "select 'nat_cd' as c, nat_cd as v, flag, split from tag"),
        ("tot", "select sum(flag) as pos, count(*) - sum(flag) as neg from tag where split = 'train'"),
        ("cls", "select c, v, sum(flag) as pos_c, count(*) as n_c from lng "
                "where split = 'train' and v is not null group by c, v"),
        ("ok", "select c from cls group by c having min(n_c) > 100"),
        ("seen", "select distinct c, v from lng")], """
select seen.c as "column", seen.v as value,
       round(ln((cls.pos_c / tot.pos) * (tot.neg / (cls.n_c - cls.pos_c))), 4) as woe
from seen join ok on ok.c = seen.c cross join tot left join cls on cls.c = seen.c and cls.v = seen.v"""),
})


def _category_codes_sql() -> str:
    """Ranks of the train values, or hashed codes for a column of more than sixty."""
    cols = ["seg_cd", "nat_cd", "home_cd"]
    views = [("t", "select id, split, seg_cd, nat_cd, concat_ws('-', nat_cd, seg_cd) as home_cd from tag")]
    picks, joins = [], []
    for c in cols:
        views += [(f"k_{c}", f"select v, row_number() over (order by v) - 1 as code from "
                             f"(select distinct {c} as v from t where split = 'train' and {c} is not null)"),
                  (f"n_{c}", f"select count(*) as n from k_{c}")]
        picks.append(f"""
       cast(case when t.{c} is null then least(n_{c}.n, 60)
                 when n_{c}.n > 60 then cast('0x' || substr(md5(t.{c}), 1, 8) as bigint) % 60
                 else coalesce(k_{c}.code, n_{c}.n + 1) end as bigint) as {c}_code""")
        joins.append(f"cross join n_{c} left join k_{c} on k_{c}.v = t.{c}")
    return with_views(["tag"], views, "\nselect cast(t.id as bigint) as id, t.split, t.seg_cd, t.nat_cd, t.home_cd,"
                      + ",".join(picks) + "\nfrom t " + "\n     ".join(joins))


ORACLE["category_codes"] = _category_codes_sql()
ORACLE["decimal_modes"] = """
with t as (select l_suppkey, cast(12345678901234567.00 + cast(l_discount as decimal(4,2)) as decimal(20,2)) as big,
                  cast(l_tax as decimal(6,4)) as tax from lineitem),
     b as (select l_suppkey, big, count(*) as c from t where big is not null group by l_suppkey, big),
     x as (select l_suppkey, tax, count(*) as c from t where tax is not null group by l_suppkey, tax),
     rb as (select *, row_number() over (partition by l_suppkey order by c desc, big) as r,
                   count(*) over (partition by l_suppkey) as k from b),
     rx as (select *, row_number() over (partition by l_suppkey order by c desc, tax) as r from x)
select cast(rb.l_suppkey as bigint) as l_suppkey, rb.k as big_nunique, rb.c as big_freq,
       cast(rb.big as varchar) as big_mode, cast(rx.tax as varchar) as tax_mode,
       cast(rb.l_suppkey as bigint) as key_mode
from rb join rx on rx.l_suppkey = rb.l_suppkey and rx.r = 1 where rb.r = 1"""
