"""SQL of an independent engine for the operators that SQL can express."""

from __future__ import annotations

LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

MINHASH_DEDUP = rf"""
with recursive tokens as (
  select doc_id, regexp_extract_all({LOWERED}, '[^\x20\x09-\x0D]+') as ws from documents),
shingles as (
  select distinct doc_id, s from (
    select doc_id, unnest(case
      when len(ws) >= 5 then
        list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
      when len(ws) > 0 then [array_to_string(ws, ' ')] else [] end) as s
    from tokens)),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
common as (
  select a.doc_id as u, b.doc_id as v, count(*) as c
  from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id group by all),
linked as (
  select u, v from common join sizes x on x.doc_id = u join sizes y on y.doc_id = v
  where 100 * c >= 75 * (x.n + y.n - c)),
both_ways as (select u, v from linked union all select v, u from linked),
reached(doc_id, root) as (
  select doc_id, doc_id from documents
  union
  select b.v, r.root from reached r join both_ways b on b.u = r.doc_id where r.root < b.v)
select d.doc_id, coalesce(s.n, 0) as n_shingles, r.root as component_id,
  d.doc_id = r.root as kept
from documents d left join sizes s using (doc_id)
join (select doc_id, min(root) as root from reached group by doc_id) r using (doc_id)
"""

MIXING = r"""
with sized as (
  select doc_id, source,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size
  from documents),
sources as (
  select source, sum(size)::bigint as source_size,
    ((count(*) + 4095) // 4096)::bigint as shards,
    row_number() over (order by source nulls last) - 1 as place
  from sized group by source),
weighted as (
  select *, case place % 3 when 0 then 5.0 when 1 then 2.0 else 1.0 end::double as weight,
    sum(source_size) over () * 1.5::double as budget
  from sources),
levels as (
  select *, (budget - coalesce(sum(2 * source_size) over (
      order by 2 * source_size / weight, place
      rows between unbounded preceding and 1 preceding), 0))
    / sum(weight) over (order by 2 * source_size / weight, place
      rows between current row and unbounded following) as level
  from weighted),
targets as (
  select *, least(2.0::double * source_size, max(level) over () * weight) as target from levels),
wanted as (select *, floor(sum(target) over () / 32 + 0.5)::bigint as blocks from targets),
quotients as (
  select place, target / (2 * k + 1) as q, blocks
  from wanted, lateral (select unnest(range(0, (target / 32)::bigint + 1000)) as k) t),
seats as (
  select place, count(*) as source_blocks from (
    select place, row_number() over (order by q desc, place) as r, blocks
    from quotients where q > 0)
  where r <= blocks group by place),
planned as (
  select w.source, source_size, shards, weight, target, coalesce(source_blocks, 0) as source_blocks
  from wanted w left join seats using (place)),
placed as (
  select d.doc_id, d.source, d.size, p.source_size, p.weight, p.target, p.source_blocks,
    'mix-1:' || coalesce(d.doc_id::varchar, '') as seed,
    cast('0x' || substr(md5('mix-1:' || coalesce(d.doc_id::varchar, '')), 1, 12) as bigint)
      % p.shards as shard
  from sized d join planned p on d.source is not distinct from p.source),
cells as (
  select source, shard, sum(size)::bigint as cell_size, any_value(source_blocks) as source_blocks
  from placed group by source, shard),
cell_quotients as (
  select source, shard, cell_size / (2 * k + 1) as q, source_blocks
  from cells, lateral (select unnest(range(0, cell_size // 16 + 1000)) as k) t
  where cell_size > 0),
cell_seats as (
  select source, shard, count(*) as quota from (
    select source, shard, source_blocks,
      row_number() over (partition by source order by q desc, shard) as r
    from cell_quotients)
  where r <= source_blocks group by source, shard),
ready as (
  select c.source, c.shard, cell_size, least(coalesce(quota, 0) * 32, cell_size * 2) as words,
    case when cell_size > 0 then
      cast('0x' || substr(md5('mix-1:' || coalesce(c.source, '') || ':' || c.shard::varchar), 1, 12)
        as bigint) % ((cell_size + 31) // 32) * 32 else 0 end as start
  from cells c left join cell_seats s
    on c.source is not distinct from s.source and c.shard = s.shard),
laid as (
  select p.*, cell_size, words, start,
    sum(size) over (partition by p.source, p.shard order by md5(seed), size, doc_id
      rows between unbounded preceding and current row)::bigint as upto
  from placed p join ready r
    on p.source is not distinct from r.source and p.shard = r.shard)
select doc_id, source, size, source_size, weight, target, shard,
  (greatest(0, least(upto, start + words) - greatest(upto - size, start))
  + greatest(0, least(upto + cell_size, start + words) - greatest(upto - size + cell_size, start))
  + greatest(0, least(upto + 2 * cell_size, start + words)
      - greatest(upto - size + 2 * cell_size, start)))::bigint as taken
from laid
"""

WORDS = rf"regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATION = rf"""
with docs as materialized (
  select row_number() over () as i, doc_id, {WORDS} as ws from documents),
items as materialized (
  select coalesce(item_id::varchar, '') as item, {WORDS} as ws from benchmark),
patterns as materialized (
  select distinct item, least(len(ws), 10) as n,
    array_to_string(ws[s:s + least(len(ws), 10) - 1], ' ') as w
  from (select *, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) as s
        from items where len(ws) > 0) starts),
places as (
  select i, n, s, array_to_string(ws[s:s + n - 1], ' ') as w
  from (select i, ws, n, unnest(range(1, len(ws) - n + 2)) as s
        from docs, (select distinct n from patterns) lengths where len(ws) >= n) starts),
found as materialized (
  select i, s, p.n, item from places join patterns p on p.w = places.w and p.n = places.n),
hits as (
  select i, count(distinct word) as n_hit
  from (select i, unnest(range(s, s + n)) as word from found) words group by i),
named as (
  select i, count(*) as n_items, string_agg(item, ',' order by item) as names
  from (select distinct i, item from found) pairs group by i)
select doc_id, len(ws)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit,
  coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(names, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 as contaminated
from docs left join hits using (i) left join named using (i)
"""


def crc32_sql(text: str) -> str:
    """CRC-32 of an ASCII text: every byte goes in, then eight steps of one bit."""
    bits = "list_reduce(range(8), lambda c, i: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, {0})"
    letters = f"list_transform(range(1, length({text}) + 1), lambda i: ascii(substr({text}, i, 1))::bigint)"
    return (
        f"xor(list_reduce({letters}, lambda crc, b: "
        f"{bits.format('xor(crc, b)')}, 4294967295::bigint), 4294967295)"
    )


def _repair_sql() -> str:
    """Row by row, the cheapest (cost and audit, text) of each state; infinite ones are null."""

    def add(of: str, cost: str, edit: str, line: str = "") -> str:
        text = f"{of}.t || case when {of}.t = '' then '' else chr(10) end || {line}" if line else f"{of}.t"
        return (
            f"case when {of} is not null then struct_pack("
            f"k := lpad((left({of}.k, 12)::bigint + {cost})::varchar, 12, '0') "
            f"|| substr({of}.k, 13) || '{edit}', t := {text}) end"
        )

    def least(*choices: str) -> str:
        return f"list_min(list_filter([{', '.join(choices)}], lambda x: x is not null))"

    # insertions: states 2 (behind user) and 3 (behind assistant) get at most two of them
    user, assistant = "'user:'", "'assistant:'"
    once = {
        "i0": "s0", "i1": "s1",
        "i2": least("s2", add("s0", "5", "I", user), add("s1", "5", "I", user), add("s3", "5", "I", user)),
        "i3": least("s3", add("s2", "5", "I", assistant)),
    }
    twice = {
        "j0": "i0", "j1": "i1",
        "j2": least("i2", add("i3", "5", "I", user)),
        "j3": least("i3", add("i2", "5", "I", assistant)),
    }
    line = "name || ':' || body"
    may = "not deleted"
    late = "case when late then 5 else 0 end"

    def when(test: str, value: str) -> str:
        return f"case when {may} and {test} then {value} end"

    edited = {
        "s0": add("j0", "2", "D"),
        "s1": least(add("j1", "2", "D"), when("role = 's'", add("j0", late, "K", line))),
        "s2": least(
            add("j2", "2", "D"),
            *[when("role = 'u'", add(f"j{q}", late, "K", line)) for q in (0, 1, 3)],
            *[when("true", add(f"j{q}", f"1 + {late}", "R", "'user:' || body")) for q in (0, 1, 3)],
        ),
        "s3": least(
            add("j3", "2", "D"), when("role = 'a'", add("j2", late, "K", line)),
            when("true", add("j2", f"1 + {late}", "R", "'assistant:' || body")),
        ),
    }

    def columns(steps: dict) -> str:
        return ", ".join(f"{value} as {name}" for name, value in steps.items())

    blank = r"[^\x20\x09-\x0D]"
    return rf"""
with recursive checked as (
  select conv_id, turn, {crc32_sql("name")} % 20 as fate,
    coalesce(role, ' ') as role, coalesce(text, ' ') as text
  from (select *, coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as name
        from conversations) named),
damaged as (
  select conv_id, turn, case when fate = 4 then 'user' else role end as name,
    case when fate = 1 then '' when fate = 2 then translate(text, '.!?', '') else text end as body,
    unnest(range(case when fate = 3 then 2 else 1 end)) as copy
  from checked where fate <> 0),
placed as (
  select *, left(name, 1) as role,
    row_number() over (partition by conv_id order by turn nulls first, name, body, copy) as place,
    row_number() over (partition by conv_id, name, body order by turn nulls first, copy) as again
  from damaged),
faults as materialized (
  select *, not regexp_matches(body, '{blank}') as blank,
    regexp_matches(body, '{blank}') and again > 1 as duplicate,
    regexp_matches(body, '{blank}') and again = 1
      and not regexp_matches(body, '[.!?][ 	-
]*$') as late,
    lag(role) over (partition by conv_id order by place) as before
  from placed),
marked as materialized (select *, blank or duplicate as deleted from faults),
counts as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0)::bigint as gaps,
    count(*) filter (where blank) as blank, count(*) filter (where duplicate) as duplicate,
    count(*) filter (where late) as truncated,
    count(*) filter (where before is not null and before || role not in ('su', 'ua', 'au')) as illegal,
    count(*) as n
  from marked group by conv_id),
steps as (
  select conv_id, 0::bigint as place,
    struct_pack(k := '000000000000', t := '') as s0,
    null::struct(k varchar, t varchar) as s1, null::struct(k varchar, t varchar) as s2,
    null::struct(k varchar, t varchar) as s3
  from counts
  union all
  select conv_id, place, {columns(edited)}
  from (select conv_id, place, name, body, role, deleted, late, {columns(twice)}
        from (select m.conv_id, m.place, name, body, role, deleted, late, {columns(once)}
              from steps s join marked m
              on m.conv_id is not distinct from s.conv_id and m.place = s.place + 1) a) b),
ends as (
  select conv_id, {least("s0", "s3", add("u", "5", "I", assistant))} as best
  from (select s.*, {least("s2", add("s1", "5", "I", user))} as u
        from steps s join counts c on s.conv_id is not distinct from c.conv_id and s.place = c.n) l)
select o.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank,
  coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated,
  coalesce(illegal, 0) as illegal, coalesce(left(best.k, 12)::bigint, 0) as cost,
  coalesce(substr(best.k, 13), '') as audit, sha256(coalesce(best.t, '')) as repaired_sha256
from (select distinct conv_id from conversations) o
left join counts c on c.conv_id is not distinct from o.conv_id
left join ends e on e.conv_id is not distinct from o.conv_id
"""


CONVERSATION_REPAIR = _repair_sql()


def _clustering(clusters: int = 40, rounds: int = 5) -> str:
    """Every round a table of centroids (k, c) and one of choices (vec_id, x, k, d)."""
    steps = []
    for turn in range(rounds + 1):
        steps.append(f"""
chosen{turn} as materialized (
  select i, vec_id, x, min(struct_pack(d := d, k := k)) as best from (
    select i, vec_id, x, k, list_sum(list_transform(list_zip(x, c),
      lambda p: ((p[1] - p[2]) * (p[1] - p[2]))::hugeint))::hugeint as d
    from kept, centroids{turn}) every_pair group by all)""")
        if turn < rounds:
            steps.append(f"""
sums{turn} as (
  select best.k as k, place, sum(x[place])::hugeint as s, count(*) as n
  from chosen{turn}, range(1, 65) t(place) group by all),
centroids{turn + 1} as materialized (
  select o.k, coalesce(m.c, o.c) as c from centroids{turn} o left join (
    select k, list((s - ((s % n) + n) % n) // n order by place) as c from sums{turn} group by k) m
  using (k))""")
    return f"""
with kept as materialized (
  select row_number() over () as i, vec_id,
    list_transform(embedding, lambda e: floor(256 * e::double)::bigint) as x
  from embeddings
  where len(embedding) = 64
    and len(list_filter(embedding, lambda e: e is not null and isfinite(e))) = 64),
centroids0 as materialized (
  select row_number() over (order by h, x) - 1 as k, x as c from (
    select x, sha256('2:' || coalesce(vec_id::varchar, '')) as h from kept
    order by h, x limit {clusters}) first_ones),
{",".join(steps)}
select vec_id, best.k::int as cluster, best.d::bigint as distance,
  sum(best.d) over (partition by best.k)::bigint as cluster_inertia,
  sum(best.d) over ()::bigint as inertia,
  sha256(array_to_string(c, ',')) as centroid_sha256
from chosen{rounds} join centroids{rounds} on k = best.k
"""


CENTROID_CLUSTERING = _clustering()

# Lengths of finite floats neither overflow nor vanish in doubles.
EMBEDDING_DEDUP = """
with recursive vectors as materialized (
  select row_number() over () as r, vec_id, label,
    case when vec_id is not null and label is not null and len(embedding) > 0
      and len(list_filter(embedding, lambda e: e is null or not isfinite(e))) = 0
      and len(list_filter(embedding, lambda e: e <> 0)) > 0
      then list_transform(embedding, lambda e: e::double) end as x
  from embeddings),
usable as materialized (
  select *, list_dot_product(x, x) as squared from vectors where x is not null),
links as materialized (
  select a.r, b.r as other, a.vec_id, b.vec_id as other_id
  from usable a join usable b on a.label = b.label and len(a.x) = len(b.x) and a.r <> b.r
  where list_dot_product(a.x, b.x) / sqrt(a.squared * b.squared) >= 0.98),
reached as (
  select vec_id, vec_id as root from vectors where vec_id is not null
  union
  select l.other_id, reached.root from reached join links l using (vec_id)),
roots as (select vec_id, min(root) as root from reached group by vec_id),
counts as (select r, count(*) as n from links group by r)
select v.vec_id, coalesce(n, 0)::bigint as n_links, root::bigint as component_id,
  coalesce(root = v.vec_id, false) as kept
from vectors v left join roots using (vec_id) left join counts using (r)
"""
