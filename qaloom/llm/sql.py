"""The results that SQL can express on whole tables, for comparison."""

from __future__ import annotations

from qaloom.llm.survivor import STAND_IN_DATES, STAND_INS

SQL: dict[str, str] = {}

_quoted = lambda xs: ", ".join(f"'{x}'" for x in xs)
_BARE = r"lower(regexp_replace(regexp_replace(translate({c}, '{wide}', '{half}'), '<[^<>]*>|&[A-Za-z#0-9]+;', '', 'g'), '[\p{{Z}}\p{{C}}\p{{P}}\p{{S}}\s]+', '', 'g'))"


def _text_ok(c: str) -> str:
    wide = "".join(chr(x) for x in range(0xFF01, 0xFF5F))
    half = "".join(chr(x - 0xFEE0) for x in range(0xFF01, 0xFF5F)).replace("'", "''")
    bare = _BARE.format(c=c, wide=wide, half=half)
    return f"({c} is not null and {bare} <> '' and {bare} not in ({_quoted(STAND_INS)}))"


SQL["p6_found"] = f"""
with m as (
  select distinct cluster_id, unnest(members) as pos from final_clusters where cluster_id is not null
), r as (
  select m.cluster_id, m.pos, coalesce(k.trust, -1) as trust, s.updated_at,
         {_text_ok("s.answer")} as ok_answer, {_text_ok("s.category")} as ok_category,
         (s.valid_from is not null and cast(s.valid_from as varchar) not in ({_quoted(STAND_IN_DATES)})) as ok_valid_from
  from m join stage1_clean s on s.pos = m.pos left join kb_sources k on k.kb = s.kb
), f as (
  select cluster_id, pos, trust, updated_at, 'answer' as field_name from r where ok_answer
  union all select cluster_id, pos, trust, updated_at, 'category' from r where ok_category
  union all select cluster_id, pos, trust, updated_at, 'valid_from' from r where ok_valid_from
)
select cluster_id, field_name, pos from f
qualify row_number() over (partition by cluster_id, field_name order by trust desc, updated_at desc nulls last, pos) = 1
"""

_FUSED = """
with p as (
  select least(i, j) as i, greatest(i, j) as j,
         avg(ce_main) filter (where not isnan(ce_main)) as a, avg(ce_aux1) filter (where not isnan(ce_aux1)) as b,
         avg(ce_aux2) filter (where not isnan(ce_aux2)) as c
  from stage3_ranked_pairs where i <> j group by 1, 2
), q as (
  select i, j, count(*) over (partition by i) as n,
    case when a is not null then (rank() over (partition by i order by a nulls last) - 1 + count(*) over (partition by i, a) / 2.0) / count(a) over (partition by i) end as a,
    case when b is not null then (rank() over (partition by i order by b nulls last) - 1 + count(*) over (partition by i, b) / 2.0) / count(b) over (partition by i) end as b,
    case when c is not null then (rank() over (partition by i order by c nulls last) - 1 + count(*) over (partition by i, c) / 2.0) / count(c) over (partition by i) end as c
  from p
), v as (
  select i, j, n, list_sort([round(coalesce(a, m), 12), round(coalesce(b, m), 12), round(coalesce(c, m), 12)]) as fused
  from (select *, coalesce((coalesce(a, 0) + coalesce(b, 0) + coalesce(c, 0)) / nullif((a is not null)::int + (b is not null)::int + (c is not null)::int, 0), 0.5) as m from q)
)
"""
SQL["p4_found"] = _FUSED + "select i, j from v where n >= 8 qualify row_number() over (partition by i order by fused desc, j) = 1"
SQL["p4_ranking"] = _FUSED + "select i, j, row_number() over (partition by i order by fused desc, j) as place, fused[1] as weakest from v"

SQL["p3_found"] = """
with v as (select pos, emb_a::double[] as e from emb_a where emb_a is not null and len(emb_a) = 64 and not list_bool_or([isnan(x) for x in emb_a])),
u as (select pos, e, sqrt(list_dot_product(e, e)) as n from v), ok as (select * from u where n > 0),
s as (select a.pos as q, b.pos as j, round(list_dot_product(a.e, b.e) / (a.n * b.n), 9) as cos
      from (select distinct pos from emb_probes) p join ok a on a.pos = p.pos join ok b on b.pos <> p.pos),
t as (select q, j from s qualify row_number() over (partition by q order by cos desc, j) <= 10)
select distinct least(q, j) as pos_a, greatest(q, j) as pos_b from t
"""

SQL["p5_found"] = """
with recursive e as (select distinct i as a, j as b from stage3_ranked_pairs where ce_final >= 0.83 and i <> j),
both_ as (select a, b from e union select b, a from e),
reach(node, root) as (select a, a from both_ union select k.b, r.root from reach r join both_ k on k.a = r.node where r.root < k.b)
select min(root) as group_pos, node as pos from reach group by node
"""
