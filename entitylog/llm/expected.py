"""What the queries return, as SQL over the same tables, where SQL can say it."""

from __future__ import annotations

from entitylog.llm import mix, quality, shards, spelling, warc

WORDS = "regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')"


def running_order(seed: str) -> str:
    return f"md5('{seed}:' || coalesce(cast(doc_id as varchar), ''))"


MEASURED = f"""
split_ as (select *, {WORDS} as w, list_filter(string_split(coalesce(text, ''), chr(10)),
      lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as l, row_number() over () as row_id from documents),
windows as (select row_id, p, count(*) over (partition by row_id, s) as n
  from (select row_id, p, array_to_string(w[p:p + 7], chr(32)) as s
    from (select row_id, w, unnest(range(1, len(w) - 6)) as p from split_) u) v),
repeats as (select row_id, count(distinct p + o) as n from windows, range(8) offsets(o) where n > 1 group by 1),
measured as (select split_.*, coalesce(n, 0) as n_repeat_words from split_ left join repeats using (row_id)),
verdict as (select *, len(w) < 20 or 100 * n_repeat_words > 30 * len(w) as base_failed from measured),
hosts as (select source, count(*) as n, count(*) filter (base_failed) as k from verdict group by 1),
mean as (select sum(k) / sum(n) as m from hosts),
spread as (select m, sum(n * pow(k / n - m, 2)) / sum(n) as v from hosts, mean group by m),
prior as (select m, case when v > 0 then least(greatest(m * (1 - m) / v - 1, 20.0), 1e6) else 1e6 end as a from spread),
rates as (select source, (k + m * a) / (n + a) > {quality.MAX_RATE} as host_failed from hosts, prior)
"""

QUALITY = f"""
with {MEASURED}
select doc_id, cast(len(w) as bigint) as n_words,
  cast(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) as bigint) as word_chars,
  cast(length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
  cast(len(l) - len(list_distinct(l)) as bigint) as n_dup_lines,
  cast(n_repeat_words as bigint) as n_repeat_words, base_failed, not base_failed and not host_failed as kept
from verdict join rates on verdict.source is not distinct from rates.source
"""

# The checksum's polynomial, 0xEDB88320 in reversed order, is a fixed value.
TAB = """tab as (select list(c order by n) as t from (
    select n, list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
      lambda x, y: case when x % 2 = 1 then xor(x // 2, 3988292384) else x // 2 end) as c
    from (select cast(unnest(range(256)) as bigint) as n) r) s)"""


def checksum(text: str) -> str:
    """The CRC-32 of a text in UTF-8, beside ``TAB``."""
    return f"""xor(4294967295, list_reduce([4294967295] || list_transform(
      regexp_extract_all(hex(encode({text})), '..'), lambda h: cast('0x' || h as bigint)),
      lambda c, b: xor(c // 256, t[xor(c, b) % 256 + 1])))"""


SHARDING = f"""
with {TAB},
rows as (select doc_id, strlen(coalesce(text, '')) + 16 as size,
    case when source is null then '1' else '0' || source end as stratum, {running_order(shards.SEED)} as ord,
    {checksum("coalesce(text, '')")} as crc
  from documents, tab),
ranked as (select *, (row_number() over (partition by stratum order by ord, doc_id, size, crc) - 1 + 0.5::double)
    / count(*) over (partition by stratum) as fraction from rows),
placed as (select *, row_number() over (order by fraction, stratum, ord, doc_id, size, crc) - 1 as p,
    count(*) over () as n from ranked),
cut as (select *, p * 40 // n as shard from placed)
select doc_id, cast(size as bigint) as size, cast(crc as bigint) as text_crc32, 'rows' as law,
  cast(shard as integer) as shard, cast(p - (shard * n + 39) // 40 as bigint) as slot, cast(null as integer) as grown_shard
from cut
"""


def mix_tables(documents: str, block: int = mix.BLOCK, fine: int = mix.FINE) -> str:
    """``taken`` per row of ``documents``, a table with ``size`` and a ``row_id`` of its own."""
    return f"""
m_docs as (select *, coalesce(sum(size) over (partition by stratum order by ord, doc_id, size, row_id
    rows between unbounded preceding and 1 preceding), 0)::bigint as start
  from (select *, case when source is null then '1' else '0' || source end as stratum,
    {running_order(mix.SEED)} as ord from {documents}) d),
m_each as (select stratum, sum(size)::bigint as s, ((row_number() over (order by stratum) - 1) % 3 + 1)::bigint as w
  from m_docs group by 1),
m_rest as (select *, sum(s) over () as total, 3 * s as cap,
    (sum(s) over () - coalesce(sum(3 * s) over (order by 3 * s / w, stratum
      rows between unbounded preceding and 1 preceding), 0)) as rest,
    sum(w) over (order by 3 * s / w, stratum rows between current row and unbounded following) as weights
  from m_each),
m_full as (select *, cap * weights <= w * rest as full_ from m_rest),
m_target as (select *, case when full_ then cap::double else
    (total - sum(case when full_ then cap else 0 end) over ())::double * w
      / greatest(sum(case when full_ then 0 else w end) over (), 1)::double end as target,
    least(s, greatest((s + {block - 1}) // {block}, {fine})) as blocks from m_full),
m_due as (select *, coalesce(case when s > 0 then round(target / s::double * blocks) end, 0)::bigint as due from m_target),
m_low as (select *, coalesce(sum(due) over (order by stratum rows between unbounded preceding and 1 preceding), 0)::bigint as low
  from m_due),
m_point as (select slot, floor((slot % {mix.MODULUS}) * {mix.GOLDEN} % {mix.MODULUS} / {mix.MODULUS}::double
    * (select sum(due) from m_low)::bigint)::bigint as point
  from (select unnest(range((select coalesce(sum(due), 0)::bigint from m_low))) as slot) r),
m_ranked as (select l.stratum, l.blocks, row_number() over (partition by l.stratum order by slot) - 1 as r
  from m_point, m_low l where point >= low and point < low + due),
m_times as (select stratum, r % blocks as block, count(*) as times from m_ranked where r < 3 * blocks group by 1, 2),
m_block as (select row_id, start, size, d.stratum, s, blocks,
    unnest(range((((start + 1)::hugeint * blocks - 1) // s)::bigint,
      (((start + size)::hugeint * blocks - 1) // s)::bigint + 1)) as block
  from m_docs d join m_low using (stratum) where size > 0),
m_words as (select row_id, sum(times * (least(((block + 1)::hugeint * s // blocks)::bigint, start + size)
    - greatest((block::hugeint * s // blocks)::bigint, start))) as words
  from m_block join m_times using (stratum, block) group by 1),
m_taken as (select m_docs.*, s as source_size, target, coalesce(words, 0)::bigint as taken
  from m_docs join m_low using (stratum) left join m_words using (row_id))
"""


MIXING = f"""
with sized as (select *, len({WORDS})::bigint as size, row_number() over () as row_id from documents),
{mix_tables('sized')}
select doc_id, size, source_size, target, taken from m_taken
"""

ARCHIVE = f"""
with p as (select page_id, strlen(coalesce(html, '')) as size, sha256(coalesce(html, '')) as digest from pages),
firsts as (select digest, min(page_id) as first from p where size >= {warc.LEAST} group by 1),
r as (select p.*, first, coalesce(first <> page_id, false) as again from p left join firsts using (digest))
select page_id, size::bigint as payload_bytes, digest as payload_digest,
  case when again then 'revisit' else 'response' end as record_type, case when again then first end as refers_to
from r
"""

UPPER, LOWER = (bytes(range(a, a + 26)).decode() for a in (65, 97))
SPELLING = f"""
with recursive {TAB},
runs as (select doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\u00C0-\u00FF]+')),
    '{UPPER}', '{LOWER}') as run from documents),
each_ as (select doc_id, run, count(*) as n from runs group by all),
marked as (select *, {checksum("coalesce(doc_id::varchar, '') || ':' || run")} as h from each_, tab),
kept as (select n, case when h % {spelling.ONE_IN} = 0
    then left(run, (h % length(run))::int) || substr(run, (h % length(run))::int + 2) else run end as word from marked),
words as (select word, sum(n)::bigint as n from kept where length(word) >= {spelling.LEAST_LETTERS} group by 1
  having sum(n) >= {spelling.LEAST_COUNT}),
cuts as (select word, n, i, left(word, i::int) || substr(word, i::int + 2) as cut
  from (select *, unnest(range(length(word))) as i from words) w),
pairs as (select distinct a.word, b.word as other, b.n as m from cuts a join cuts b
    on a.cut = b.cut and a.i = b.i and a.word <> b.word
  union select a.word, b.word, b.n from cuts a join words b on a.cut = b.word
  union select b.word, a.word, a.n from cuts a join words b on a.cut = b.word),
near as (select word, count(*) as n_near, min(struct_pack(n := -m, word := other)) as best from pairs group by 1),
formed as (select word, n, coalesce(n_near, 0)::bigint as n_near,
    case when -best.n >= 2 * n then best.word end as form, case when -best.n >= 2 * n then -best.n end as form_n
  from words left join near using (word)),
walk as (select word, form as root from formed where form is not null
  union all select w.word, f.form from walk w join formed f on f.word = w.root where f.form is not null),
lasts as (select w.word, w.root from walk w join formed f on f.word = w.root where f.form is null)
select word, n, n_near, form, form_n::bigint as form_n, coalesce(root, word) as root
from formed left join lasts using (word)
"""

TURN = "md5(strlen(r)::varchar || ':' || r || x)"
TRIE = f"""
with {TAB},
said as (select conv_id as c, turn, coalesce(role, '') as r, coalesce(text, '') as x from conversations where conv_id is not null),
placed as (select c, {TURN} as id, length(x) as chars, row_number() over (partition by c order by turn nulls first, {TURN}) as nth
  from said),
convs as (select c, {checksum("c::varchar")} % 6 as h from (select distinct c from placed) p, tab),
parts as (select convs.c, 0 as part, nth, id, chars from convs join placed p on p.c = convs.c - convs.c % 100 and nth <= h
  union all select c, 1, nth, id, chars from placed join convs using (c) where nth > h),
whole as (select c, coalesce(ids, []) as ids, coalesce(chars, []) as chars from convs left join
  (select c, list(id order by part, nth) as ids, list(chars order by part, nth) as chars from parts group by 1) p using (c)),
ways as (select c, d, array_to_string(ids[:d], '') as way, chars[d] as size, len(ids) = d as ends
  from (select *, unnest(range(len(ids) + 1)) as d from whole) w),
nodes as (select way, d, min(c) as conv, count(*) as n, any_value(size) as size,
    sha256(coalesce(string_agg(c::varchar, ',' order by c) filter (ends), '')) as ends_sha256 from ways group by 1, 2),
born as (select left(way, 32 * (d - 1)) as way, count(*) as children from nodes where d > 0 group by 1),
known as (select nodes.*, coalesce(children, 0) as children from nodes left join born using (way)),
above as (select left(way, 32 * e) as way, count(*) filter (children = 0) as leaves,
    sum(case when d = 0 then 0 else (n - 1) * size end) as saved
  from (select *, unnest(range(d + 1)) as e from known) k group by 1)
select k.conv as conv_id, k.d::bigint as depth, p.conv as parent_conv_id, k.n::bigint as n_convs, k.children::bigint as n_children,
  leaves::bigint as n_leaves, saved::bigint as saved_tokens, k.ends_sha256
from known k join above using (way) left join known p on k.d > 0 and p.way = left(k.way, 32 * (k.d - 1))
"""

STATEMENTS = {
    "op5_mixing": MIXING,
    "op9_quality": QUALITY,
    "op10_sharding": SHARDING,
    "op11_warc": ARCHIVE,
    "op12_spelling": SPELLING,
    "op13_conversations": TRIE,
}


def sql() -> dict[str, str]:
    return dict(STATEMENTS)
