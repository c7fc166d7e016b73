"""The queries' rows in DuckDB SQL, where SQL can express them."""

CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SPACED = r"[^\x20\x09-\x0D]+"

OP9 = f"""
with d as (
  select row_number() over () as row, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{CAPITALS}', '{SMALL}'), '{ALNUM}') as w
  from documents
), b as (
  select item_id::varchar as item_id,
         regexp_extract_all(translate(coalesce(text, ''), '{CAPITALS}', '{SMALL}'), '{ALNUM}') as w
  from benchmark
), item_windows as (
  select distinct item_id, array_to_string(w[s : s + n - 1], ' ') as win, n
  from (select item_id, w, n, unnest(range(1, len(w) - n + 2)) as s
        from (select *, least(13, len(w)) as n from b where len(w) > 0))
), doc_windows as (
  select row, n, s, array_to_string(w[s : s + n - 1], ' ') as win
  from (select row, w, n, unnest(range(1, len(w) - n + 2)) as s
        from d, (select distinct n from item_windows) where len(w) >= n)
), hits as (
  select distinct row, s, d.n, item_id from doc_windows d join item_windows i on d.win = i.win and d.n = i.n
), places as (
  select row, count(distinct pos) as n_hit
  from (select row, unnest(range(s, s + n)) as pos from (select distinct row, s, n from hits)) group by row
), items as (
  select row, count(*) as n_items, string_agg(item_id, ',' order by item_id) as ids
  from (select distinct row, item_id from hits) group by row
)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
       sha256(coalesce(ids, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from d left join places using (row) left join items using (row)
"""

SCORES = ("symbols", "marks", "capitals", "dup_lines", "repeats")
CUTOFFS = (900, 700, 500, 400, 300, 200, 150, 100, 75, 50, 30, 20, 10, 5)

OP3 = f"""
with d as (
  select row_number() over () as row, doc_id, lang, coalesce(text, '') as text,
         regexp_extract_all(coalesce(text, ''), '{SPACED}') as w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '{SPACED}')) as lines
  from documents
), wins as (
  select row, s, array_to_string(w[s : s + 7], ' ') as win
  from (select row, w, unnest(range(1, len(w) - 6)) as s from d where len(w) >= 8)
), twice as (
  select row, s from (select row, s, count(*) over (partition by row, win) as n from wins) where n > 1
), repeated as (
  select row, count(distinct pos) as n from (select row, unnest(range(s, s + 8)) as pos from twice) group by row
), c as (
  select row, doc_id, lang, len(w)::bigint as n_words,
         length(regexp_replace(text, '[\\x20\\x09-\\x0D]+', '', 'g'))::bigint as word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::bigint as n_symbols,
         length(regexp_replace(text, '[^!?]+', '', 'g'))::bigint as n_marks,
         length(regexp_replace(text, '[^A-Z]+', '', 'g'))::bigint as n_capitals,
         (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines, len(lines)::bigint as n_lines,
         coalesce(n, 0)::bigint as n_repeat_words
  from d left join repeated using (row)
), m as (
  select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed,
         case when word_chars > 0 then 1000 * n_symbols // word_chars else 0 end as symbols,
         case when word_chars > 0 then 1000 * n_marks // word_chars else 0 end as marks,
         case when word_chars > 0 then 1000 * n_capitals // word_chars else 0 end as capitals,
         case when n_lines > 0 then 1000 * n_dup_lines // n_lines else 0 end as dup_lines,
         case when n_words > 0 then 1000 * n_repeat_words // n_words else 0 end as repeats
  from c
), held as (
  select lang, quality, score, value
  from (select * from m where not base_failed) join labels using (doc_id),
       lateral (select unnest({list(SCORES)}) as score, unnest([symbols, marks, capitals, dup_lines, repeats]) as value)
  where quality is not null
), trials as (
  select lang, score, cutoff, count(*) filter (quality = 1) as n,
         count(*) filter (quality = 1 and value > cutoff) as good,
         count(*) filter (quality = 0 and value > cutoff) as bad
  from held, (select unnest({list(CUTOFFS)}) as cutoff) group by all
), tails as (
  select *, list_sum(list_transform(range(0, good + 1), lambda k:
    exp(lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1) + k * ln(0.002::double) + (n - k) * ln(0.998::double)))) as tail
  from trials where bad > good
), chosen as (
  select lang as of, score as of_score, max_by(cutoff, (bad - good) * 1000 + cutoff) as cut
  from tails where tail <= 0.05::double / (5 * (select count(*) from (select distinct lang from trials)))
  group by all
), refused as (
  select distinct row
  from m, lateral (select unnest({list(SCORES)}) as score, unnest([symbols, marks, capitals, dup_lines, repeats]) as value)
  join chosen on lang is not distinct from of and score = of_score and value > cut
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and r.row is null as kept
from m left join refused r on m.row = r.row
"""

OP6 = f"""
with p as (
  select page_id, coalesce(url, '') as url,
         translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1), '{CAPITALS}', '{SMALL}') as host,
         regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) as path
  from pages
), rules as (
  select * from (values ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
                        ('net', '/es/', 'block'), ('net', '/fr/', 'block')) as r(rule_host, rule_path, rule_verdict)
), best as (
  select page_id, url, max_by(rule_host || rule_path, length(rule_host || rule_path)) as rule,
         max_by(rule_verdict, length(rule_host || rule_path)) as rule_verdict
  from p join rules on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
  group by all
), listed as (
  select distinct host || path as key from p where regexp_matches(url, '[?&]utm_')
)
select p.page_id, host, path, rule,
       coalesce(rule_verdict, case when key is not null then 'block' else 'allow' end) as verdict
from p left join best on p.page_id is not distinct from best.page_id and p.url = best.url
left join listed on host || path = key
"""

OP10 = f"""
with lines as (
  select row, source, l
  from (select row_number() over () as row, source, string_split(text, chr(10)) as ls from documents),
       lateral (select distinct l from (select unnest(ls) as l) where regexp_matches(l, '{SPACED}'))
), totals as (
  select source, count(*) as pages from documents group by source
), dropped as (
  select h.source, l from (select source, l, count(*) as held from lines group by all) h
  join totals t on h.source is not distinct from t.source and held >= 3 and held > 0.1 * pages
)
select doc_id, d.source, coalesce(len(ls), 0)::bigint as n_lines, coalesce(len(ls) - len(kept), 0)::bigint as n_dropped,
       case when ls is not null then array_to_string(kept, chr(10)) end as text
from (
  select doc_id, d.source, string_split(text, chr(10)) as ls,
         list_filter(string_split(text, chr(10)), lambda l: not list_contains(coalesce(gone, []), l)) as kept
  from documents d left join (select source, list(l) as gone from dropped group by source) g
  on d.source is not distinct from g.source
) d
"""

OP13 = """
with v as (
  select distinct vec_id, list_transform(embedding, lambda x: floor(64 * x::double)) as v
  from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), ranked as (
  select q.vec_id as query_id, c.vec_id as vec_id, list_inner_product(q.v, c.v)::bigint as score,
         row_number() over (partition by q.vec_id, q.v order by list_inner_product(q.v, c.v) desc, c.vec_id, c.v) as rank
  from v q join v c on q.vec_id <> c.vec_id or q.v <> c.v
  where q.vec_id % 20 = 0
)
select query_id, rank::integer as rank, vec_id, score from ranked where rank <= 20
"""

ORACLES = {"op3_quality_rules": OP3, "op6_url_filter": OP6, "op9_decontaminate": OP9, "op10_line_dedup": OP10, "op13_topk_search": OP13}
