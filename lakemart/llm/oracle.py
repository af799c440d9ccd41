"""DuckDB statements that the corpus queries must equal, where SQL can express them."""

_SPACE = r"[\x20\x09-\x0D]+"
_WORD = r"[^\x20\x09-\x0D]+"

_EXACT = f"""
with d as (
    select doc_id, sha256(regexp_replace(coalesce(text, ''), '{_SPACE}', ' ', 'g')) as text_sha256 from documents
)
select doc_id,
       min(doc_id) over (partition by text_sha256) as keep_id,
       count(*) over (partition by text_sha256) as group_size,
       doc_id is not distinct from min(doc_id) over (partition by text_sha256) as kept,
       text_sha256
from d
"""

_MIX = f"""
with recursive d as (
    select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORD}'))::bigint as size from documents
),
totals as (
    select source, sum(size)::bigint as source_size,
           list_extract([5.0, 2.0, 1.0], (((row_number() over (order by source nulls last)) - 1) % 3 + 1)::int)::double as weight
    from d group by source
),
levels(step, level) as (
    select 0, 0::double
    union all
    select step + 1,
           (1.5::double * (select sum(source_size) from totals)::double
            - sum(case when weight * level >= 2.0 * source_size then 2.0 * source_size else 0 end)::double)
           / sum(case when weight * level >= 2.0 * source_size then 0 else weight end)::double
    from levels, totals
    where step <= (select count(*) from totals)
    group by step, level
    having sum(case when weight * level >= 2.0 * source_size then 0 else weight end) > 0
),
rates as (
    select source, source_size, least(2.0::double * source_size, weight * (select arg_max(level, step) from levels)) as target
    from totals
),
drawn as (
    select r.*, doc_id, size, seed,
           case when source_size > 0 then target / source_size else 0 end as rate,
           ('0x' || substr(md5(seed || ':' || coalesce(doc_id::varchar, 'null')), 1, 12))::bigint::double
               / 281474976710656.0::double as u
    from d join rates r on d.source is not distinct from r.source cross join range(16) as s(seed)
),
tried as (
    select source, seed,
           abs(floor(any_value(rate)) * sum(size) + sum(case when u < rate - floor(rate) then size else 0 end)
               - any_value(target)) as off
    from drawn group by source, seed
),
best as (
    select source, seed from tried qualify row_number() over (partition by source order by off, seed) = 1
)
select doc_id, size, source_size, target, w.source,
       (floor(rate) + (u < rate - floor(rate))::int)::bigint as copies,
       (floor(rate) + (u < rate - floor(rate))::int)::bigint * size as taken
from drawn w join best b on w.source is not distinct from b.source and w.seed = b.seed
"""

_CHAT = r"""
with said as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all select -7, 0, 'user', '</s>[INST] ok [/INST]'
    union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'
),
long as (
    select *,
           length(replace(text, '\', '\\')) + length(replace(role, '\', '\\'))
           + len(regexp_extract_all(text, '<\|turn\|>|<\|text\|>|<\|end\|>|<\|endoftext\|>|<\|startoftext\|>|<\|im_start\|>|<\|im_end\|>|<s>|</s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>'))
           + len(regexp_extract_all(role, '<\|turn\|>|<\|text\|>|<\|end\|>|<\|endoftext\|>|<\|startoftext\|>|<\|im_start\|>|<\|im_end\|>|<s>|</s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>'))
           + 23 as chars
    from said
)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls last, role, text)) as turns_sha256,
       coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn nulls last, role, text) filter (role = 'assistant'), '')) as loss_sha256,
       sum(chars)::bigint as formatted_chars
from long group by conv_id
"""

_NEAR = f"""
with recursive w as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') as words
    from documents
),
s as (
    select distinct doc_id, array_to_string(words[i : i + 4], ' ') as shingle
    from w, unnest(generate_series(1, greatest(len(words) - 4, 1))) as u(i) where len(words) > 0
),
n as (select doc_id, count(*) as n from s group by doc_id),
pairs as (
    select x.doc_id as a, y.doc_id as b, count(*) as common
    from s x join s y on x.shingle = y.shingle and x.doc_id < y.doc_id group by 1, 2
),
links as (
    select a, b from pairs join n na on a = na.doc_id join n nb on b = nb.doc_id
    where 100 * common >= 85 * (na.n + nb.n - common)
),
edges as (select a, b from links union all select b, a from links),
reach(a, b) as (select a, b from edges union select r.a, e.b from reach r join edges e on r.b = e.a),
nearest as (select a, min(b) as b from reach group by a)
select w.doc_id, coalesce(n.n, 0) as n_shingles, least(w.doc_id, coalesce(b, w.doc_id)) as component_id,
       w.doc_id = least(w.doc_id, coalesce(b, w.doc_id)) as kept
from w left join n on w.doc_id = n.doc_id left join nearest on w.doc_id = a
"""

_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_DIVERGENCE = rf"""
with d as (
    select row_number() over () as doc, coalesce(lang, '') as lang, coalesce(source, '') as source,
           regexp_extract_all({_LOWERED}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as words
    from documents
),
w as (select doc, lang, source, unnest(words) as term from d),
counts as (select lang, source, term, count(*)::hugeint as n, count(distinct doc) as docs from w group by all),
kept as (select lang, term, sum(n)::hugeint as n from counts group by all having sum(docs) >= 3),
sizes as (select lang, count(*)::hugeint as v, sum(n)::hugeint as total from kept group by all),
sources as (select distinct lang, source from d),
full_counts as (
    select s.lang, s.source, k.term, coalesce(c.n, 0)::hugeint as n, k.n as lang_n
    from sources s join kept k on s.lang = k.lang
    left join counts c on c.lang = s.lang and c.source = s.source and c.term = k.term
),
totals as (select lang, source, sum(n)::hugeint as total from full_counts group by all),
p as (
    select f.lang, f.source, f.term, f.n,
           1 + (1000000000::hugeint * (f.n + 1)) // (t.total + z.v) as p,
           1 + (1000000000::hugeint * (f.lang_n + 1)) // (z.total + z.v) as lang_p
    from full_counts f join totals t on t.lang = f.lang and t.source = f.source join sizes z on z.lang = f.lang
),
summed as (
    select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // b.p) as value
    from p a join p b on a.lang = b.lang and a.term = b.term group by all
),
found as (
    select a.lang, a.source, 'pair' as part, b.source as item, coalesce(value, 0)::bigint as value
    from sources a join sources b on a.lang = b.lang and a.source <> b.source
    left join summed s on s.lang = a.lang and s.source = a.source and s.item = b.source
    union all
    select lang, source, 'term', term, ((p - lang_p) * (p - lang_p) // lang_p)::bigint from p where n > 0 and p > lang_p
),
ranked as (
    select *, (row_number() over (partition by lang, source, part order by value desc, item))::int as rank from found
)
select * from ranked where part = 'pair' or rank <= 200
"""

_SEARCH = rf"""
with d as (
    select row_number() over () as doc, doc_id, regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as words
    from documents
),
whole as (select count(*) filter (len(words) > 0) as docs, sum(len(words))::bigint as words from d),
tfs as (select doc, term, count(*) as tf from (select doc, unnest(words) as term from d) group by all),
dfs as (select term, count(*) as df from tfs group by all),
queries as (
    select item_id, term, count(*) as repeats
    from (select item_id, unnest(regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark)
    group by all
),
weighted as (
    select item_id, q.term, repeats * floor(1000 * ln((2 * docs + 2) / (2 * df + 1)))::bigint as weight
    from queries q join dfs f on q.term = f.term cross join whole
),
sizes as (select doc, doc_id, 25 + (75 * len(d.words) * w.docs) // w.words as m from d cross join whole w),
scored as (
    select item_id, doc, sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * m)))::bigint as score
    from weighted w join tfs t on w.term = t.term join sizes s using (doc) group by all
),
ranked as (
    select item_id, (row_number() over (partition by item_id order by score desc, doc_id nulls first))::int as rank, doc_id, score
    from scored join d using (doc) where score > 0
)
select * from ranked where rank <= 10
"""

ORACLES = {
    "op1_minhash": _NEAR,
    "op5_exact_dedup": _EXACT,
    "op9_mixing": _MIX,
    "op10_chat_format": _CHAT,
    "op11_divergence": _DIVERGENCE,
    "op13_ball_search": _SEARCH,
}
