"""DuckDB SQL for the queries that SQL can state over the whole tables."""

OP8_WARC = """
with p as (select page_id, encode(coalesce(html, '')) as b from pages),
r as (select page_id, octet_length(b) as n, sha256(b) as d from p),
f as (select d, min(page_id) as first_page from r where n >= 100 group by d)
select r.page_id, cast(r.n as bigint) as payload_bytes, r.d as payload_digest,
  case when f.first_page <> r.page_id then 'revisit' else 'response' end as record_type,
  case when f.first_page <> r.page_id then f.first_page end as refers_to
from r left join f on r.d = f.d
"""

OP5_LINES = r"""
with l as (select doc_id, source, pos, line, trim(line) as k from (
    select doc_id, source, unnest(string_split(text, chr(10))) as line,
      generate_subscripts(string_split(text, chr(10)), 1) as pos from documents)),
b as (select k from l where regexp_matches(line, '[^\x20\x09-\x0D]') group by k
  having count(distinct coalesce(source, chr(0))) >= case
    when regexp_matches(k, '[^ \t]+[ \t]+[^ \t]+[ \t]+[^ \t]') or regexp_matches(k,
      '([\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}][^\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}]*){6}')
    then 3 else 6 end),
r as (select l.*, case when b.k is null then 0 when row_number() over (partition by l.k order by doc_id, pos) = 1 then 0
    else 1 end as gone from l left join b on l.k = b.k)
select doc_id, cast(sum(gone) as bigint) as n_removed,
  coalesce(string_agg(line, chr(10) order by pos) filter (where gone = 0), '') as text
from r group by doc_id
"""

OP12_PHRASES = r"""
with pieces as (
  select coalesce(lang, 'und') as lang, row_number() over () as doc,
    unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[.,;:!?\x0A-\x0D]')) as piece from documents where text is not null),
listed as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces),
found as (
  select lang, k, w[i:i + k - 1] as words, count(*) as f
  from (select lang, w, k, unnest(range(1, len(w) - k + 2)) as i from listed, (values (1), (2), (3), (4)) as t(k))
  group by lang, k, w[i:i + k - 1]),
totals as (select lang, sum(f) as n from found where k = 1 group by lang),
cand as (select lang, k, words, f as a from found where k >= 2 and f >= 30),
inner_parts as (
  select c.lang, c.words[i:i + j - 1] as words, max(c.a) as longer
  from (select lang, words, a, k, unnest(range(1, 4)) as i from cand) c, (values (2), (3)) as t(j)
  where j < c.k and i + j - 1 <= c.k group by c.lang, c.words[i:i + j - 1]),
kept as (
  select c.* from cand c left join inner_parts p on p.lang = c.lang and p.words = c.words
  where p.longer is null or 100 * p.longer < 80 * c.a),
cuts as (select lang, k, words, a, unnest(range(1, k)) as cut from kept),
scored as (
  select c.lang, c.words, c.a, c.cut, x.f as l, y.f as r,
    cast((cast(2000000 as hugeint) * c.a) // (x.f + y.f) as bigint) as score
  from cuts c join found x on x.lang = c.lang and x.words = c.words[1:c.cut]
  join found y on y.lang = c.lang and y.words = c.words[c.cut + 1:c.k]),
low as (select *, row_number() over (partition by lang, words order by score, cut) as nth from scored),
ranked as (
  select lang, array_to_string(words, ' ') as phrase, a, l, r, score,
    row_number() over (partition by lang order by score desc, a desc, array_to_string(words, ' ')) as rank
  from low where nth = 1)
select ranked.lang, cast(rank as bigint) as rank, phrase, cast(a as bigint) as a, cast(l as bigint) as l,
  cast(r as bigint) as r, cast(n as bigint) as n, score
from ranked join totals on totals.lang = ranked.lang where rank <= 2000
"""



def mixing_sql(block_words: int = 16, shard_words: int = 1 << 20) -> str:
    """Op 13 with weights 5, 2, 1, three passes and seed 13. Caps by a running sum over the sources in order of size over
    weight; seats by ranking all quotients."""
    return rf"""
with rows as (
  select doc_id, source, cast(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as bigint) as size from documents),
keyed as (
  select *, cast('0x' || substr(md5('13:' || coalesce(cast(doc_id as varchar), '') || ':' || size), 1, 15) as bigint) as key from rows),
sized as (select source, cast(sum(size) as bigint) as source_size from rows group by source),
ordered as (select *, row_number() over (order by source nulls last) as party from sized),
weighed as (select *, [5, 2, 1][cast((party - 1) % 3 + 1 as int)] as weight from ordered),
sums as (
  select *, sum(source_size) over () as size,
    coalesce(sum(3 * source_size) over (w rows between unbounded preceding and 1 preceding), 0) as before,
    sum(weight) over (w rows between current row and unbounded following) as open
  from weighed window w as (order by source_size * 10 // weight, party)),
level as (
  select size - before as rest, open from sums where 3 * source_size * open > weight * (size - before)
  order by source_size * 10 // weight, party limit 1),
targets as (
  select s.*, case when level.open is null or 3 * source_size * level.open <= weight * rest then cast(3 * source_size as double)
    else cast(weight * rest as double) / cast(level.open as double) end as target
  from sums s left join level on true),
quotients as (
  select party, target, target / (2 * k + 1) as quotient
  from (select *, unnest(range(0, cast(floor(target / {block_words}) as bigint) + 3 + (select count(*) from sized))) as k from targets)),
seats as (
  select party, count(*) as seats from (
    select party, row_number() over (order by quotient desc, party) as nth from quotients where target > 0)
  where nth <= (select (2 * sum(size) + {block_words}) // {2 * block_words} from rows) group by party),
plan as (
  select *, case when source_size > 0 then words // source_size else 0 end as passes,
    case when source_size > 0 then (2 * (words % source_size) + {block_words}) // {2 * block_words} else 0 end as blocks,
    greatest((source_size + {shard_words - 1}) // {shard_words}, 1) as shards
  from (select t.*, least(coalesce(seats, 0) * {block_words}, 3 * source_size) as words
    from targets t left join seats on seats.party = t.party)),
held as (
  select k.doc_id, k.size, k.key, p.*exclude (size), (k.key >> 6) % p.shards as shard
  from keyed k join plan p on p.source is not distinct from k.source where k.size > 0),
cells as (
  select *, case when whole > 0 then cast('0x' || substr(md5('13:' || party || ':' || shard), 1, 15) as bigint) % whole else 0 end as start,
    least(sum(whole) over (partition by party), blocks) as total
  from (select party, shard, cast(sum(size) // {block_words} as bigint) as whole, any_value(blocks) as blocks from held group by party, shard)),
dealt as (
  select party, shard, count(*) as quota from (
    select party, shard, total, row_number() over (partition by party order by whole / (2 * k + 1) desc, shard) as nth
    from (select *, unnest(range(0, whole)) as k from cells))
  where nth <= total group by party, shard),
laid as (
  select h.*, whole, start, coalesce(quota, 0) as quota,
    sum(size) over (partition by h.party, h.shard order by key, size, doc_id rows unbounded preceding) as stop
  from held h join cells c on c.party = h.party and c.shard = h.shard
  left join dealt d on d.party = h.party and d.shard = h.shard),
ends as (select *, x, least(x // {block_words}, whole) as spot from (select *, unnest([stop - size, stop]) as x from laid)),
counted as (
  select *, case when whole = 0 then 0 else (spot * quota + start) // whole * {block_words}
    + case when spot < whole and ((spot + 1) * quota + start) // whole > (spot * quota + start) // whole then x - spot * {block_words} else 0 end
    end as chosen from ends)
select doc_id, size, source_size, target, cast(passes * size + max(chosen) - min(chosen) as bigint) as taken
from counted group by doc_id, size, key, source_size, target, passes, party, shard, stop
union all
select k.doc_id, k.size, t.source_size, t.target, 0 from keyed k join targets t on t.source is not distinct from k.source where k.size = 0
"""


ORACLES: dict[str, str] = {"op5_lines": OP5_LINES, "op8_warc": OP8_WARC,
                           "op12_phrases": OP12_PHRASES, "op13_mix": mixing_sql()}
