"""SQL that must give the rows of a query, for the operators that SQL can express."""

CHAT_SQL = r"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select * from (values (-7, 0, 'user', '\### Assistant: </turn> ok'),
                                  (-7, 1, 'assistant', '\### Assistant: </turn> ok'))),
sized as (
  select *, case when role in ('user', 'assistant', 'system') then length(role) + 6 else length(role) + 7 end
      + length(text) + 9 + len(regexp_extract_all(text, '### (?:User|Assistant|System|=)|</turn>')) as chars
  from turns)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn) filter (role = 'assistant'), '')) as loss_sha256,
  cast(sum(chars) as bigint) as formatted_chars
from sized group by conv_id
"""
# The exact answer: what the search gives with a share of 1, and what its recall is measured against.
NEAREST_SQL = """
with rows as (select vec_id, cast(embedding as double[]) as v from embeddings),
scored as (
  select q.vec_id as query_id, c.vec_id, list_inner_product(q.v, c.v) as score
  from rows q join rows c on c.vec_id <> q.vec_id where q.vec_id % 20 = 0),
ranked as (
  select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank from scored)
select query_id, rank, vec_id, score from ranked where rank <= 20
"""

# Tags and entities as the given pages have them; everything else about a page is up to the operator.
PAGES_SQL = r"""
with inside as (
  select page_id, url,
    regexp_replace(regexp_extract(coalesce(html, ''), '<article>(.*)</article>', 1, 's'), '</?b>', '', 'g') as raw
  from pages),
bare as (select page_id, url, regexp_replace(raw, '<[^>]*>', ' ', 'g') as raw from inside),
decoded as (
  select page_id, url, regexp_replace(replace(replace(replace(raw, '&quot;', '"'), '&lt;', '<'), '&gt;', '>'),
    '&amp;?', '&', 'g') as raw
  from bare),
shown as (select page_id, url, trim(regexp_replace(raw, '\s+', ' ', 'g')) as text from decoded)
select page_id, url, text, cast(length(text) as bigint) as n_chars from shown
"""

NEAR_DUP_SQL = r"""
with recursive words as (
  select doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
  from documents),
shingled as (
  select doc_id, case when len(w) = 0 then [] else list_distinct(
    [array_to_string(w[i:i + 4], ' ') for i in range(1, greatest(2, len(w) - 3))]) end as s
  from words),
sized as (select doc_id, cast(len(s) as bigint) as n from shingled),
members as (select doc_id, unnest(s) as shingle from shingled),
shared as (
  select a.doc_id as one, b.doc_id as other, count(*) as n_both from members a join members b using (shingle)
  where a.doc_id < b.doc_id group by all),
links as (
  select one, other from shared join sized x on x.doc_id = one join sized y on y.doc_id = other
  where 100 * n_both >= 85 * (x.n + y.n - n_both)),
ways as (select one as a, other as b from links union all select other, one from links),
reached as (select a, b from ways union select r.a, w.b from reached r join ways w on w.a = r.b),
tops as (select a, min(b) as top from reached group by a)
select doc_id, n as n_shingles, least(coalesce(top, doc_id), doc_id) as component_id,
  least(coalesce(top, doc_id), doc_id) = doc_id as kept
from sized left join tops on tops.a = doc_id
"""

# Whole numbers stay exact in a sum of doubles as long as they are this small.
HARD_NEGATIVES_SQL = """
with taken as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v
  from embeddings
  where label is not null and embedding is not null and len(embedding) = len(list_filter(embedding, lambda x: isfinite(x)))),
scored as (
  select a.vec_id as anchor_id, b.vec_id, a.label = b.label as same,
    cast(list_inner_product(a.v, b.v) as bigint) as score
  from taken a join taken b on a.vec_id <> b.vec_id where a.vec_id % 100 = 0),
positives as (
  select anchor_id, vec_id as positive_id, score as positive_score from scored where same
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5),
ranked as (
  select anchor_id, positive_id, vec_id as negative_id, positive_score, score as negative_score,
    cast(row_number() over (partition by anchor_id, positive_id order by score desc, vec_id) as integer) as rank
  from positives join scored using (anchor_id)
  where not same and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from ranked where rank <= 10
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SEARCH_SQL = rf"""
with terms as (
  select doc_id, unnest(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) as term from documents),
wanted as (
  select item_id, unnest(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) as term from benchmark),
sizes as (select doc_id, count(*) as n from terms group by doc_id),
total as (select count(*) as docs, cast(sum(n) as bigint) as words from sizes),
counts as (select doc_id, term, count(*) as tf from terms where term in (select term from wanted) group by doc_id, term),
weights as (
  select term, cast(floor(1000 * ln((2 * (select docs from total) + 2) / (2 * count(*) + 1))) as bigint) as w
  from counts group by term),
scored as (
  select item_id, doc_id, cast(sum(w * ((1000000000 * tf) //
      (1000 * tf + 12 * (100 - 25 + (25 * n * (select docs from total)) // (select words from total))))) as bigint) as score
  from wanted join counts using (term) join weights using (term) join sizes using (doc_id) group by item_id, doc_id),
ranked as (
  select *, cast(row_number() over (partition by item_id order by score desc, doc_id) as integer) as rank
  from scored where score > 0)
select item_id, rank, doc_id, score from ranked where rank <= 20
"""

CONTAMINATION_SQL = rf"""
with docs as (
  select doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
items as (
  select item_id, w, least(10, len(w)) as size from (
    select item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark)
  where len(w) > 0),
windows as (
  select distinct item_id, size, array_to_string(w[i:i + size - 1], ' ') as words
  from (select *, unnest(range(1, len(w) - size + 2)) as i from items)),
places as (
  select doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') as words
  from (select *, unnest(range(1, len(w) - size + 2)) as i
        from docs cross join (select distinct size from windows) where len(w) >= size)),
found as (select doc_id, item_id, size, i from places join windows using (size, words)),
hit as (select doc_id, count(distinct place) as n_hit from (
  select doc_id, unnest(range(i, i + size)) as place from found) group by doc_id),
held as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as ids
  from (select distinct doc_id, cast(item_id as varchar) as item from found) group by doc_id)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(ids, '')) as items_sha256, n_hit is not null as contaminated
from docs left join hit using (doc_id) left join held using (doc_id)
"""
