"""SQL for the queries that SQL can express, over the same tables."""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_FOLDED = f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')"
_BLANKS = "concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))"

OP3 = f"""
with recursive w as (
  select doc_id, regexp_extract_all({_FOLDED}, '[^\\x20\\x09-\\x0D]+') as ws from documents
), s as (
  select distinct doc_id, unnest(case when len(ws) = 0 then [] when len(ws) < 5 then [array_to_string(ws, ' ')]
    else list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) end) as shingle
  from w
), n as (
  select w.doc_id, count(shingle) as n_shingles from w left join s on w.doc_id = s.doc_id group by w.doc_id
), p as (
  select a.doc_id as x, b.doc_id as y, count(*) as shared
  from s a join s b on a.shingle = b.shingle and a.doc_id <> b.doc_id group by all
), e as (
  select x, y from p join n m on x = m.doc_id join n k on y = k.doc_id
  where 100 * shared >= 80 * (m.n_shingles + k.n_shingles - shared)
), r as (
  select doc_id as node, doc_id as seen from documents
  union
  select r.node, e.y from r join e on r.seen = e.x
)
select n.doc_id, n_shingles, min(seen) as component_id from n join r on n.doc_id = r.node
group by n.doc_id, n_shingles
"""

_WORDS = f"regexp_extract_all({_FOLDED}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

OP4 = f"""
with b as (
  select item_id, {_WORDS} as ws from benchmark
), iw as (
  select distinct item_id, size, unnest(list_transform(range(1, len(ws) - size + 2),
    lambda i: array_to_string(ws[i:i + size - 1], ' '))) as w
  from (select *, least(10, len(ws)) as size from b where len(ws) > 0)
), d as (
  select doc_id, {_WORDS} as ws from documents
), dw as (
  select doc_id, size, unnest(range(1, greatest(len(ws) - size + 2, 1))) as pos, ws
  from d cross join (select distinct size from iw)
), hit as (
  select doc_id, pos, dw.size, item_id
  from dw join iw on dw.size = iw.size and array_to_string(ws[pos:pos + dw.size - 1], ' ') = iw.w
), covered as (
  select doc_id, count(distinct word) as n_hit
  from (select doc_id, unnest(range(pos, pos + size)) as word from hit) group by doc_id
), items as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as said
  from (select distinct doc_id, cast(item_id as varchar) as item from hit) group by doc_id
)
select d.doc_id, cast(len(ws) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(said, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join covered on d.doc_id = covered.doc_id left join items on d.doc_id = items.doc_id
"""

OP10 = f"""
with l as (
  select doc_id, unnest(ls) as line, generate_subscripts(ls, 1) as pos
  from (select doc_id, string_split(coalesce(text, ''), chr(10)) as ls from documents)
), k as (
  select *, translate(trim(line, {_BLANKS}), '{_UPPER}', '{_LOWER}') as line_key from l
), h as (
  select line_key, min(doc_id) as first_doc, count(distinct doc_id) as holders
  from k where length(line_key) >= 10 group by line_key
), j as (
  select k.*, coalesce(holders >= 2 and k.doc_id <> first_doc, false) as gone
  from k left join h on k.line_key = h.line_key
)
select doc_id, count(*) as n_lines, cast(count_if(gone) as bigint) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '')) as kept_sha256
from j group by doc_id
"""

OP11 = f"""
with p as (
  select coalesce(lang, 'und') as lang, unnest(string_split_regex({_FOLDED}, '[.,;:!?\\x0A-\\x0D]')) as piece from documents
), w as (
  select lang, regexp_extract_all(piece, '[^\\x20\\x09]+') as ws from p
), t as (
  select lang, cast(sum(len(ws)) as bigint) as n from w group by lang
), g as (
  select lang, size, unnest(list_transform(range(1, len(ws) - size + 2), lambda i: ws[i:i + size - 1])) as g
  from w cross join (select unnest([1, 2, 3, 4]) as size) where len(ws) >= size
), f as (
  select lang, size, g, count(*) as a from g group by all having count(*) >= 30
), around as (
  select lang, size, a, unnest(list_transform(range(2, size), lambda k:
    list_transform(range(1, size - k + 2), lambda i: g[i:i + k - 1])), max_depth := 2) as g
  from f where size > 2
), longer as (
  select lang, g, max(a) as most from around group by all
), c as (
  select f.* from f left join longer using (lang, g) where size > 1 and not coalesce(100 * most::hugeint >= 80 * a::hugeint, false)
), cut as (
  select lang, g, a, size, unnest(range(1, size)) as k from c
), s as (
  select cut.lang, cut.g, cut.a, k, x.a as l, y.a as r, (2000000::hugeint * cut.a) // (x.a::hugeint + y.a) as score
  from cut join f x on x.lang = cut.lang and x.g = cut.g[1:k]
  join f y on y.lang = cut.lang and y.g = cut.g[k + 1:cut.size]
), b as (
  select * from s qualify row_number() over (partition by lang, g order by score, k) = 1
), r as (
  select *, array_to_string(g, ' ') as phrase,
         row_number() over (partition by lang order by score desc, a desc, array_to_string(g, ' ')) as rank from b
)
select lang, rank, phrase, a, l, r.r, n, cast(score as bigint) as score from r join t using (lang) where rank <= 2000
"""

_CRC_TABLE = """list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)),
    lambda x, i: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end))"""

OP13 = f"""
with table_of as (
  select {_CRC_TABLE} as crc
), runs as (
  select doc_id, unnest(regexp_extract_all({_FOLDED}, '[a-zÀ-ÿ]{{7,}}')) as run from documents
), counted as (
  select doc_id, run, count(*) as n, coalesce(doc_id::varchar, '') || ':' || run as said from runs group by all
), bytes as (
  select doc_id, run, n, list_transform(regexp_extract_all(hex(encode(said)), '..'), lambda h: ('0x' || h)::bigint) as bs
  from counted
), hashed as (
  select run, n, xor(list_reduce(list_prepend(4294967295, bs), lambda x, b: xor(crc[(xor(x, b) & 255) + 1], x >> 8)), 4294967295) as h
  from bytes cross join table_of
), words as (
  select case when h % 31 = 0 then run[1:h % length(run)] || run[h % length(run) + 2:] else run end as word, sum(n) as n
  from hashed group by all
), v as (
  select word, cast(n as bigint) as n from words where length(word) >= 7 and n >= 2
), place as (
  select word, n, unnest(range(1, length(word) + 1)) as i from v
), gap as (
  select word, n, i, word[1:i - 1] as head, word[i + 1:] as rest from place
), near as (
  select a.word, a.n, b.word as other, b.n as other_n from gap a join gap b on a.head = b.head and a.rest = b.rest and a.word <> b.word
  union
  select v.word, v.n, gap.word, gap.n from gap join v on v.word = gap.head || gap.rest
  union
  select gap.word, gap.n, v.word, v.n from gap join v on v.word = gap.head || gap.rest
), best as (
  select word, n, count(*) as n_near, arg_min(other, (-other_n, other)) as other, max(other_n) as other_n from near group by all
), forms as (
  select word, n_near, case when other_n >= 10 * n then other end as form, case when other_n >= 10 * n then other_n end as form_n from best
), follow as (
  with recursive chain as (
    select word, form as reached, 1 as steps from forms where form is not null
    union all
    select chain.word, forms.form, steps + 1 from chain join forms on forms.word = chain.reached where forms.form is not null
  )
  select word, arg_max(reached, steps) as root from chain group by word
)
select v.word, form, coalesce(root, v.word) as root, v.n, coalesce(n_near, 0) as n_near, form_n
from v left join forms on v.word = forms.word left join follow on v.word = follow.word
"""
