"""DuckDB texts of those queries that SQL can express on whole tables. They share no code with the operators."""

from __future__ import annotations

from lumenfold.llm import url_filter

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP9 = f"""with d as (select doc_id, {WORDS} w from documents),
win as (select doc_id, i, list_aggregate(w[i:i + 12], 'string_agg', ' ') s from (select doc_id, w, unnest(range(1, len(w) - 11)) i from d where len(w) >= 13)),
low as (select s, min(doc_id) lo from win group by s),
gone as (select distinct doc_id, i + k pos from win join low using (s), range(13) r(k) where lo < doc_id),
tok as (select doc_id, unnest(w) word, generate_subscripts(w, 1) pos from d),
kept as (select doc_id, string_agg(word, ' ' order by pos) t from tok anti join gone using (doc_id, pos) group by doc_id),
cut as (select doc_id, count(*) n from gone group by doc_id)
select doc_id, len(w)::bigint n_words, coalesce(n, 0)::bigint n_removed, sha256(coalesce(t, '')) kept_sha256 from d left join cut using (doc_id) left join kept using (doc_id)"""

OP5 = f"""with d as (select doc_id, {WORDS} w from documents),
win as (select doc_id, i, md5(list_aggregate(w[i:i + 49], 'string_agg', ' ')) s from (select doc_id, w, unnest(range(1, len(w) - 48)) i from d where len(w) >= 50)),
low as (select s, min(doc_id) lo, max(doc_id) hi from win group by s having min(doc_id) < max(doc_id)),
hit as (select doc_id, i, lo from win join low using (s)),
cover as (select distinct doc_id, i + k pos from hit, range(50) r(k)),
later as (select distinct doc_id, i + k pos from hit, range(50) r(k) where lo < doc_id),
edge as (select doc_id, pos, case when lag(pos) over (partition by doc_id order by pos) = pos - 1 then 0 else 1 end e from cover),
a as (select doc_id, count(*) n_repeated, sum(e)::bigint n_spans from edge group by doc_id), b as (select doc_id, count(*) n_removable from later group by doc_id)
select doc_id, len(w)::bigint n_words, n_repeated, coalesce(n_removable, 0) n_removable, n_spans from a join d using (doc_id) left join b using (doc_id)"""

OP4 = rf"""with recursive d as (select doc_id, regexp_extract_all(coalesce({LOWER}, ''), '[^\x20\x09-\x0D]+') w from documents),
sh as (select doc_id, case when len(w) >= 4 then list_distinct(list_transform(range(1, len(w) - 2), lambda i: list_aggregate(w[i:i + 3], 'string_agg', ' '))) when len(w) > 0 then [list_aggregate(w, 'string_agg', ' ')] else [] end s, len(w) n_w from d),
t as (select doc_id, len(s) n, unnest(s) || case when n_w < 4 then chr(10) else '' end g from sh),
p as (select a.doc_id a, b.doc_id b, any_value(a.n) na, any_value(b.n) nb, count(*) c from t a join t b on a.g = b.g and a.doc_id < b.doc_id group by all),
e as (select a, b from p where 100 * c >= 85 * (na + nb - c) union all select b, a from p where 100 * c >= 85 * (na + nb - c)),
r(id, c) as (select doc_id, doc_id from sh union select e.b, r.c from r join e on e.a = r.id)
select doc_id, len(s)::bigint n_shingles, component_id from sh join (select id doc_id, min(c) component_id from r group by id) using (doc_id)"""


def op3() -> str:
    """The same training table, kernel and steps; then rules before the model."""
    lit = lambda t: t.replace("'", "''")
    n = len(url_filter.LABELLED)
    labelled = ", ".join(f"({i}, '{lit(u)}', {float(y)}::double)" for i, (u, y) in enumerate(url_filter.LABELLED))
    tail = "case when instr(coalesce(url, ''), '://') > 0 then substr(url, instr(url, '://') + 3) else '' end"
    host = f"translate(regexp_extract({tail}, '^([^/?#]*)', 1), '{url_filter.UPPER}', '{url_filter.LOWER}')"
    path = f"regexp_extract({tail}, '^[^/?#]*([^?#]*)', 1)"

    def grams(mark: str, text: str) -> str:
        t = f"('{mark}^' || {text} || '$')"
        return " || ".join(f"list_transform(range(1, greatest(1, len({t}) - {k - 2})), lambda i: substr({t}, i::int, {k}))" for k in (3, 4))

    buckets = f"list_transform({grams('h', 'host')} || {grams('p', 'path')} || ['bias'], lambda g: ('0x' || substr(md5(g), 1, 3))::int)"
    rules = sorted(url_filter.RULES, key=lambda r: -(len(r[0]) + len(r[1])))
    fits = lambda h, p: f"(host = '{h}' or host like '%.{h}') and starts_with(path, '{p}')"
    rule = "case " + " ".join(f"when {fits(h, p)} then '{h}{p}'" for h, p, _ in rules) + " end"
    verdict = "case " + " ".join(f"when {fits(h, p)} then '{v}'" for h, p, v in rules) + " end"
    return f"""with recursive lab(i, url, y) as (values {labelled}), lb as (select i, y, unnest({buckets}) b from (select i, y, {host} host, {path} path from lab)),
c as (select i, any_value(y) y, b, count(*)::double c from lb group by i, b), nm as (select i, sqrt(sum(c * c)) n from c group by i), x as (select i, y, b, c / n v from c join nm using (i)),
k as (select p.i, q.i j, sum(p.v * q.v) k from x p join x q using (b) group by p.i, q.i),
m as (select i, list(coalesce(k, 0) order by j) row from (select a.range::int i, b.range::int j from range({n}) a, range({n}) b) g left join k using (i, j) group by i),
one as (select list(row order by i) m, (select list(y order by i) from lab) y from m),
gd(t, a) as (select 0, list_transform(range({n}), lambda i: 0.0::double) union all select t + 1, list_transform(range(1, {n + 1}), lambda i: a[i] * (1 - {url_filter.RATE * url_filter.DECAY}::double) - {url_filter.RATE}::double * (1 / (1 + exp(-list_dot_product(m[i], a))) - y[i]) / {n}) from gd, one where t < {url_filter.STEPS}),
al as (select unnest(a) a, generate_subscripts(a, 1) - 1 i from gd where t = {url_filter.STEPS}), w as (select b, sum(a * v) w from x join al using (i) group by b),
pg as (select row_number() over () r, page_id, {host} host, {path} path from pages), z as (select r, sum(coalesce(w, 0)) z from (select r, unnest({buckets}) b from pg) left join w using (b) group by r)
select page_id, host, path, {rule} rule, coalesce({verdict}, case when z >= 0 then 'block' else 'allow' end) verdict from pg join z using (r)"""


ORACLES = {"op3_url_filters": op3(), "op4_jaccard_join": OP4, "op5_suffix_dedup": OP5, "op9_substring_dedup": OP9}
