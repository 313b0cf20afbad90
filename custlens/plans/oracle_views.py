"""DuckDB SQL for the fixture views (same rows as ``custlens.sources.fixtures``).

The oracle SQL of each registered query starts from the driver tables, so
these view bodies are inlined as CTEs.  ``chr(92)`` is the backslash.
"""

from __future__ import annotations

VIEW_SQL = {
    "tag": """
select c_custkey as id,
       case when c_acctbal < 1000 then 1 else 0 end as flag,
       case when c_custkey % 5 = 0 then 'score' else 'train' end as split,
       c_mktsegment as seg_cd, cast(c_nationkey as varchar) as nat_cd,
       cast(c_custkey % 7 as double) as buy_a, cast(c_custkey % 11 as double) as buy_b,
       cast(c_custkey % 13 as double) as buy_c
from customer""",
    "trd": """
select o_custkey as id, l_orderkey, l_linenumber, l_shipdate as trx_tm,
       case when l_returnflag = 'R' then -l_extendedprice else l_extendedprice end as amt,
       case when l_linestatus = 'F' then 'B' else 'C' end as flg1,
       case l_returnflag when 'A' then 'A' when 'N' then 'B' else 'C' end as flg3,
       o_orderpriority as cod1, p_brand as cod2
from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey""",
    "beh": """
select user_id as id, ts as page_tm, event_type as page from events""",
    "page_trd": """
select user_id as id, ts as trx_tm, case when event_type = 'click' then -value else value end as amt,
       case event_type when 'click' then 'B' when 'view' then 'C' else 'D' end as flg1,
       case event_type when 'click' then 'A' when 'view' then 'B' else 'C' end as flg3,
       event_type as cod1, substr(event_type, 1, 1) as cod2
from events""",
    "text_amounts": """
select l_orderkey || '-' || l_linenumber as id,
       case when (l_orderkey * 8 + l_linenumber) % 97 = 0 then 'n/a'
            else cast(cast(l_quantity as integer) as varchar) end as quantity,
       case when (l_orderkey * 8 + l_linenumber) % 101 = 0 then '2020-02-30'
            when (l_orderkey * 8 + l_linenumber) % 53 = 0 then null
            else strftime(l_shipdate, '%Y-%m-%d') end as shipped
from lineitem""",
    "tag_text": """
select p_partkey as id, case when p_partkey % 5 = 0 then 'score' else 'train' end as split,
       case when p_partkey % 17 = 0 then chr(92) || 'N' else p_brand end as brand_txt,
       case when p_partkey % 17 = 0 then chr(92) || 'N' when p_partkey % 19 = 0 then '-1'
            else p_type end as type_txt,
       case when p_partkey % 17 = 0 then chr(92) || 'N' when p_partkey % 13 = 0 then '-1'
            else cast(p_size as varchar) end as size_txt
from part""",
    "imp_null": """
select p_brand as feature, p_retailprice as importance_gain, p_size as importance_split
from part""",
    "imp_actual": """
select p_brand as feature,
       p_retailprice + case when length(p_brand) = 8 then 20 else 0 end as importance_gain,
       p_size as importance_split
from part""",
    "scores": """
select model, fold, id,
       cast((id * 31 + fold * 7 + model * 13) % 1000 as double) / 1000 as score
from (select id, model, unnest([0, 1, 2, 3, 4]) as fold
      from (select id, unnest([1, 2, 3]) as model from tag where split = 'score'))""",
}


def with_views(views: list[str], ctes: list[tuple[str, str]], final: str) -> str:
    """``WITH <views>, <ctes> <final>``."""
    parts = [f"{v} AS ({VIEW_SQL[v]}\n)" for v in views]
    parts += [f"{name} AS ({body}\n)" for name, body in ctes]
    return "WITH " + ",\n".join(parts) + "\n" + final
