"""The same results in SQL, written independently of the operators."""

from __future__ import annotations

import unicodedata

from qaloom.functions.signals import CONDITIONS, DATE_WORDS, NEGATIONS, PLACES
from qaloom.functions.text import BLACKLIST, FULL_WIDTH, HALF_WIDTH, PUNCTUATION, WHITELIST

SQL: dict[str, str] = {}


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_RADICALS = "".join(chr(c) for c in range(0x2F00, 0x2FD6))
_SPACES = "\u00a0" + "".join(map(chr, range(0x2000, 0x200B))) + "\u202f\u205f\u3000"
_FROM = FULL_WIDTH + _RADICALS + _SPACES
_TO = HALF_WIDTH + unicodedata.normalize("NFKC", _RADICALS) + " " * len(_SPACES)


def _norm(c: str) -> str:
    """Normalisation in SQL: the compatibility characters of these tables are single ones."""
    wide = f"replace(translate(nfc_normalize({c}), {_q(_FROM)}, {_q(_TO)}), '…', '...')"
    flat = f"regexp_replace({wide}, '[\\x00-\\x1F\\x7F]', ' ', 'g')"
    punct = f"translate({flat}, {_q(''.join(PUNCTUATION))}, {_q(''.join(PUNCTUATION.values()))})"
    return f"regexp_replace(regexp_replace({punct}, '\\s+', ' ', 'g'), '^ | $', '', 'g')"


_REASON = f"case when regexp_matches(question, {_q('|'.join(WHITELIST))}) then 'whitelist' when regexp_matches(question, {_q('|'.join(BLACKLIST))}) then 'blacklist' else 'keep' end"
_CLEANED = f"cleaned as (select pos, question, answer, {_REASON} as reason from (select pos, {_norm('question')} as question, answer from stage1_clean where question is not null))"

SQL["normalize_text"] = f"select pos, {_norm('question')} as question, {_norm('answer')} as answer from stage1_clean"
SQL["to_halfwidth"] = f"select doc_id, translate(text, {_q(FULL_WIDTH)}, {_q(HALF_WIDTH)}) as half from documents"
SQL["filter_reason"] = f"with {_CLEANED} select pos, reason, reason <> 'blacklist' as keep from cleaned"
SQL["filter_reason_counts"] = f"with {_CLEANED} select reason, count(*) as n from cleaned group by reason order by n desc, reason limit 20"
SQL["filter_stats"] = f"with {_CLEANED} select count(*) as input, count(*) filter (where reason <> 'blacklist') as kept, round(count(*) filter (where reason <> 'blacklist') / greatest(1, count(*)), 6) as keep_rate from cleaned"
SQL["dense_position"] = f"with {_CLEANED} select pos, row_number() over (order by pos) - 1 as place from cleaned where reason <> 'blacklist'"
SQL["stage1_positions"] = f"""
with kept as (select pos, id, question, answer, kb, category, {_REASON} as reason
              from (select pos, id, {_norm('question')} as question, answer, kb, category from stage1_clean where question is not null))
select row_number() over (order by pos) - 1 as pos, id, question, answer, kb, category from kept where reason <> 'blacklist'
"""
SQL["auto_id"] = "select doc_id, source, row_number() over (order by doc_id) - 1 as id from documents"

_GRAMS = "case when length({c}) >= 3 then list_distinct([substring({c}, i, 3) for i in range(1, length({c}) - 1)]) else [] end"
SQL["char_ngrams"] = f"select pos, len(g)::int as n, array_to_string(list_sort(g), '|') as grams from (select pos, {_GRAMS.format(c='question')} as g from stage1_clean where question is not null)"
SQL["ngram_jaccard_pairs"] = f"""
with p as (select distinct least(i, j) as i, greatest(i, j) as j from stage3_ranked_pairs where i <> j),
g as (select pos, length(question) as n, {_GRAMS.format(c="question")} as g from stage1_clean where question is not null),
s as (select p.i, p.j, least(a.n, b.n) as n, case when len(a.g) = 0 and len(b.g) = 0 then 1.0 else len(list_intersect(a.g, b.g)) / len(list_distinct(list_concat(a.g, b.g))) end as s
      from p join g a on a.pos = p.i join g b on b.pos = p.j)
select i, j, round(s, 6) as jaccard, s >= case when n < 10 then 0.50 else 0.45 end as hit from s
"""
_CODES = "list_transform(range(1, length({c}) + 1), lambda i: [unicode(substring({c}, i::int, 1))::bigint])"
SQL["edit_distance"] = f"""
with p as (select distinct least(i, j) as i, greatest(i, j) as j from stage3_ranked_pairs where i <> j),
t as (select pos, {_CODES.format(c="question")} as c from stage1_clean where question is not null),
w as (select p.i, p.j, a.c as a, b.c as b, list_transform(range(1, len(b.c) + 1), lambda k: [k]) as steps from p join t a on a.pos = p.i join t b on b.pos = p.j)
select i, j, list_reduce(a, lambda up, x: list_reduce(steps, lambda row, k: list_append(row, least(row[-1] + 1, up[k[1] + 1] + 1, up[k[1]] + (b[k[1]] <> x)::bigint)), [up[1] + 1]), range(0, len(b) + 1))[-1]::int as distance from w
"""
SQL["ngram_pairs"] = f"""
with r as (select pos, question as text, length(question) as n, {_GRAMS.format(c="question")} as g from stage1_clean where question is not null),
u as (select pos, n, len(g) as size, unnest(g) as gram from r),
s as (select a.pos as i, b.pos as j, any_value(a.n) as n, any_value(b.n) as m, count(*) as common, any_value(a.size) + any_value(b.size) - count(*) as either from u a join u b on a.gram = b.gram and a.pos < b.pos group by 1, 2),
e as (select pos, n from r where len(g) = 0)
select i, j, round(common / either, 6) as jaccard from s where common / either >= case when least(n, m) < 10 then 0.50 else 0.45 end
union all select a.pos, b.pos, 1.0 from e a join e b on a.pos < b.pos
"""
SQL["l2_normalize"] = """
with e as (select vec_id, [x::double * 3 for x in embedding] as v from embeddings),
n as (select vec_id, v, greatest(sqrt(list_dot_product(v, v)), 1e-12) as n from e)
select vec_id, (unnest(range(1, len(v) + 1)) - 1)::int as k, round(unnest(v) / n, 5) as x from n
"""
_KNN = """
e as (select vec_id, embedding::double[] as v from embeddings),
u as (select vec_id, [(x / greatest(sqrt(list_dot_product(v, v)), 1e-12))::float::double for x in v] as v from e),
s as (select a.vec_id as q, b.vec_id as j, round(list_dot_product(a.v, b.v), 9) as score from u a join u b on a.vec_id <> b.vec_id),
knn as (select q, j, row_number() over (partition by q order by score desc, j)::int as rank, score from s qualify rank <= 10)
"""
SQL["knn_exact"] = f"with {_KNN} select q, j, rank, round(score, 5) as score from knn"
SQL["candidate_pairs"] = f"with {_KNN} select distinct least(q, j) as i, greatest(q, j) as j from knn"
_VIEW = "(list_dot_product(a.e[{f}:{t}]::double[], b.e[{f}:{t}]::double[]) / sqrt(list_dot_product(a.e[{f}:{t}]::double[], a.e[{f}:{t}]::double[])) / sqrt(list_dot_product(b.e[{f}:{t}]::double[], b.e[{f}:{t}]::double[])))"
SQL["consistency_vote"] = f"""
with {_KNN}, p as (select distinct least(q, j) as i, greatest(q, j) as j from knn),
x as (select vec_id, embedding as e from embeddings),
c as (select p.i, p.j, {_VIEW.format(f=1, t=22)} as c0, {_VIEW.format(f=23, t=43)} as c1, {_VIEW.format(f=44, t=64)} as c2 from p join x a on a.vec_id = p.i join x b on b.vec_id = p.j),
d as (select i, j, (c0 >= 0.3)::int + (c1 >= 0.3)::int + (c2 >= 0.3)::int as votes, list_stddev_pop([c0, c1, c2]) as spread from c)
select i, j, votes, round(spread, 5) as spread, votes >= 2 and spread <= 0.15 as consistent from d
"""
_FUSED = "0.7 * ce_main + 0.3 * greatest(ce_aux1, ce_aux2)"
SQL["fusion_tiers"] = f"select i, j, round(c, 9) as ce_final, case when c >= 0.83 then 'high' when c >= 0.77 then 'mid' else 'low' end as label from (select i, j, {_FUSED} as c from stage3_ranked_pairs) where c >= 0.77"
SQL["score_percentiles"] = """
select count(ce_final) as n, round(quantile_cont(ce_final, 0.1), 6) as p10, round(quantile_cont(ce_final, 0.5), 6) as p50, round(quantile_cont(ce_final, 0.9), 6) as p90,
       round(avg((ce_final >= 0.83)::int), 6) as high_ratio, round(avg((ce_final >= 0.77 and ce_final < 0.83)::int), 6) as mid_ratio from stage3_ranked_pairs
"""
SQL["score_histogram"] = """
with m as (select min(ce_final) as lo, max(ce_final) as hi from stage3_ranked_pairs)
select least(49, floor((ce_final - lo) / (hi - lo) * 50))::int as bin, count(*) as n from stage3_ranked_pairs, m where ce_final is not null group by 1
"""
_EDGES = "e as (select least(i, j) as a, greatest(i, j) as b, max(ce_final) as w from {t} where ce_final >= 0.83 and i <> j group by 1, 2)"
_COMP = """
both_ as (select a as src, b as dst, w from e union all select b, a, w from e),
reach(node, root) as (select src, src from both_ union select b.dst, r.root from reach r join both_ b on b.src = r.node where r.root < b.dst),
comp as (select min(root) as cluster, node from reach group by node)
"""
_GRAPH = f"recursive {_EDGES.format(t='stage3_ranked_pairs')}, {_COMP}"
SQL["connected_components"] = f"with {_GRAPH} select cluster as component, node from comp"
_INNER = """
inner_ as (select c.cluster, b.src, b.dst, b.w from both_ b join comp c on c.node = b.src join comp d on d.node = b.dst and d.cluster = c.cluster),
means as (select cluster, src as node, round(avg(w), 12) as mean from inner_ group by 1, 2),
center as (select cluster, node as center from means qualify row_number() over (partition by cluster order by mean desc, node) = 1),
met as (select k.cluster, k.center, s.size, count(*) / greatest(1, s.size - 1) as coverage, avg(i.w) as mean, median(i.w) as median, quantile_cont(i.w, 0.1) as p10
        from center k join inner_ i on i.cluster = k.cluster and i.src = k.center join (select cluster, count(*) as size from comp group by 1) s on s.cluster = k.cluster group by k.cluster, k.center, s.size),
val as (select *, coverage >= 0.85 - 1e-9 and mean >= 0.85 - 1e-9 and median >= 0.845 - 1e-9 and p10 >= 0.80 - 1e-9 as ok from met)
"""
SQL["center_metrics"] = f"with {_GRAPH}, {_INNER} select cluster, center, size, round(coverage, 9) as coverage, round(mean, 9) as mean, round(median, 9) as median, round(p10, 9) as p10, ok from val"
_PAIRS = "prot as (select distinct i.src as a, i.dst as b, i.w from inner_ i join val v on v.cluster = i.cluster and not v.ok where i.src < i.dst and i.w >= 0.86)"
SQL["protected_pairs"] = f"with {_GRAPH}, {_INNER}, {_PAIRS} select a, b, round(w, 6) as w from prot"
SQL["constrained_clusters"] = f"""
with {_GRAPH}, {_INNER}, {_PAIRS}, lists as (
  select v.center, list_sort(list(c.node)) as members from val v join comp c on c.cluster = v.cluster where v.ok group by v.cluster, v.center
  union all select a, [a, b] from prot)
select row_number() over (order by members) - 1 as cluster_id, center, array_to_string(members, ',') as members from lists
"""
SQL["degree_centers"] = f"""
with {_GRAPH}, deg as (select src as node, count(*) as degree from both_ group by 1),
best as (select c.cluster, c.node from comp c join deg d on d.node = c.node qualify row_number() over (partition by c.cluster order by d.degree desc, c.node) = 1)
select c.cluster as community, b.node as center, array_to_string(list_sort(list(c.node)), ',') as members, count(*) as size from comp c join best b on b.cluster = c.cluster group by 1, 2
"""
SQL["modularity"] = f"""
with {_GRAPH}, tot as (select sum(w) as m from e), vol as (select c.cluster, sum(b.w) as d from both_ b join comp c on c.node = b.src group by 1)
select round((select sum(e.w) from e join comp x on x.node = e.a join comp y on y.node = e.b and y.cluster = x.cluster) / m - (select sum(d * d) from vol) / (4 * m * m), 6) as modularity from tot
"""
SQL["community_stats"] = f"""
with {_GRAPH}, s as (select cluster, count(*) as n from comp group by 1)
select (select count(*) from comp) as nodes, (select count(*) from e) as edges, count(*) as clusters, round(avg(n), 6) as size_avg, max(n) as size_max, min(n) as size_min, 'connected_components' as method, 1.0::double as resolution from s
"""
_CLUSTERS = "cl as (select cluster_id, min(members) as members from final_clusters group by 1)"
SQL["cluster_stats"] = f"with {_CLUSTERS} select count(*) as clusters, round(median(len(members)), 6) as size_p50, round(quantile_cont(len(members), 0.9), 6) as size_p90, max(len(members))::int as size_max, 'parallel' as method from cl"
SQL["members_text"] = f"with {_CLUSTERS} select cluster_id, coalesce(array_to_string(members, ','), '') as members from cl"
SQL["govern_stats"] = "select count(*) as clusters, count(*) filter (where conflict) as conflict_clusters, round(avg((merged_answer <> representative_answer)::int), 6) as merge_rate from final_clusters"


def _words(c: str, words: list[str]) -> str:
    return f"[w for w in [{', '.join(map(_q, words))}] if contains({c}, w)]"


_DATE = r"\d{4}年\d{1,2}月(?:\d{1,2}日)?"


def _dates(c: str) -> str:
    return f"list_concat(regexp_extract_all({c}, '{_DATE}'), {_words(c, DATE_WORDS)})"


SQL["extract_signals"] = rf"""
with a as (select pos, {_norm("answer")} as s from stage1_clean where answer is not null)
select pos, array_to_string(regexp_extract_all(s, '(?:人民币|RMB|￥)?\s*[0-9]+(?:\.[0-9]+)?\s*(?:元|块|万元|千元|角|分)?'), '|') as money,
  array_to_string(regexp_extract_all(s, '[0-9]+(?:\.[0-9]+)?%'), '|') as percent, array_to_string({_dates("s")}, '|') as date,
  array_to_string({_words("s", NEGATIONS)}, '|') as neg, array_to_string({_words("s", CONDITIONS)}, '|') as cond, array_to_string({_words("s", PLACES)}, '|') as orgloc,
  array_to_string(regexp_extract_all(s, '[0-9]+(?:\.[0-9]+)?'), '|') as nums from a
"""


def _answers(clusters: str) -> str:
    return f"""flat as (select cluster_id, unnest(members) as pos, unnest(range(1, len(members) + 1)) as ord from {clusters}),
ans as (select f.cluster_id, f.ord, {_norm("s.answer")} as a from flat f join stage1_clean s on s.pos = f.pos where s.answer is not null)"""


_REP = "cnt as (select cluster_id, a, count(*) as n, min(ord) as ord from ans group by 1, 2), rep as (select cluster_id, a as representative from cnt qualify row_number() over (partition by cluster_id order by n desc, ord) = 1)"
_MERGED = "mrg as (select cluster_id, string_agg(a, '；' order by ord) as merged from cnt group by 1)"
# Pairs of distinct answers: the definition itself, to test the linear form against.
_CONFLICT = rf"""
sig as (select distinct cluster_id, a, try_cast(nullif(regexp_extract(a, '[0-9]+(?:\.[0-9]+)?'), '') as double) as num, len({_words("a", NEGATIONS)}) > 0 as neg, {_dates("a")} as ds from ans),
day as (select cluster_id, a, num, neg, ds, [try_cast(concat(regexp_extract(d, '(\d{{4}})年', 1), '-', lpad(regexp_extract(d, '年(\d{{1,2}})月', 1), 2, '0'), '-', lpad(coalesce(nullif(regexp_extract(d, '月(\d{{1,2}})日', 1), ''), '1'), 2, '0')) as date) for d in ds] as dd from sig),
con as (
  select x.cluster_id, bool_or(coalesce(abs(x.num - y.num) / greatest(1e-6, x.num, y.num) > 0.05, false) or x.neg <> y.neg
    or (len(x.ds) > 0 and len(y.ds) > 0 and not list_bool_or([list_bool_or([coalesce(abs(p - q) <= 1, true) for q in y.dd]) for p in x.dd]))) as conflict
  from day x join day y on x.cluster_id = y.cluster_id and x.a <= y.a group by 1)
"""
SQL["hard_conflict"] = f"with {_CLUSTERS}, {_answers('cl')}, {_CONFLICT} select cluster_id as cluster, conflict from con"
SQL["representative_answer"] = f"with {_CLUSTERS}, {_answers('cl')}, {_REP} select cluster_id as cluster, representative from rep"
SQL["merge_answers"] = f"with {_CLUSTERS}, {_answers('cl')}, {_REP}, {_MERGED} select cluster_id as cluster, merged from mrg"
_KEPT = f"{_CLEANED}, kept as (select * from cleaned where reason <> 'blacklist'), good as (select p.* from stage3_ranked_pairs p where i in (select pos from kept) and j in (select pos from kept))"
SQL["qa_pipeline"] = f"""
with recursive {_KEPT}, {_EDGES.format(t="good")}, {_COMP}, grp as (select cluster as cluster_id, list_sort(list(node)) as members from comp group by 1),
{_answers("grp")}, {_REP}, {_MERGED}, {_CONFLICT}
select g.cluster_id, k.question as center_question, array_to_string(g.members, ',') as members, coalesce(r.representative, '') as representative_answer,
  coalesce(case when coalesce(c.conflict, false) then r.representative else m.merged end, '') as merged_answer, coalesce(c.conflict, false) as conflict
from grp g join kept k on k.pos = g.cluster_id left join rep r on r.cluster_id = g.cluster_id left join mrg m on m.cluster_id = g.cluster_id left join con c on c.cluster_id = g.cluster_id
"""
SQL["recall_stats"] = f"""
with {_KNN}, p as (select least(q, j) as i, greatest(q, j) as j, max(score) as score, bool_or(score >= 0.3) as hit from knn group by 1, 2)
select (select count(*) from knn) as pairs_vector_raw, (select count(*) from knn where score >= 0.3) as ngram_hits, count(*) as pairs_union, count(*) filter (where hit) as pairs_ngram,
       (select count(distinct q) from knn) as self_removed, count(*) filter (where hit) as pairs_ngram_raw,
       count(*) filter (where score >= 0.25) as pairs_consistent, round(avg((score >= 0.25)::int), 6) as pass_rate from p
"""
SQL["csv_round_trip"] = "select kb, kind, trust::varchar as trust, main_lang from kb_sources"
SQL["stream_filter"] = f"with {_CLEANED} select pos, question from cleaned where reason <> 'blacklist'"
