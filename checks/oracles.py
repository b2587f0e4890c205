"""SQL for every query in ``queries.py``, for an independent engine (DuckDB).

Written from the rules, over the plain columns of the given tables: no JSON is parsed
here and nothing is shared with the library but the expected values.
"""

from __future__ import annotations

# Messages as derived in messages.py, fields still typed.
FX = """
fx0 as (
  select event_id, user_id, props, epoch_us(ts) as us, epoch_us(ts) // 1000 as ms,
    case when event_id % 89 = 0 then null when event_id % 97 = 0 then ''
         else cast(user_id as varchar) end as rowkey,
    cast(user_id % 4 as int) as part,
    'c-' || user_id as uuid,
    cast(case event_type when 'signup' then 3506 when 'view' then 301 when 'click' then 303
         when 'purchase' then 2649 else 2650 end as int) as counted_eid,
    cast(case when event_id % 11 = 0 then 312 else counted_eid end as int) as eid,
    cast(case when event_id % 3 = 0 then 0 else user_id end as int) as uid,
    cast(case when event_id % 5 <> 0 then epoch_us(ts) // 1000000 end as int) as dt,
    case when event_id % 4 <> 0 then (epoch_us(ts) // 1000000) || '.' ||
      lpad(cast(epoch_us(ts) % 1000000 as varchar), 6, '0') end as dtm_text,
    [1,96,141,3,95,2,148,149,150,4,6,12,209,163,null,null,null][1 + event_id % 17] as src_id,
    [11,12,13,4,6,104,106,112,100,211,null][1 + (event_id // 17) % 11] as src,
    [0,1,3,17,18,23,null,null][1 + (event_id // 7) % 8] as app,
    case when event_id % 7 = 0 then null when event_id % 10 = 0
      then 'Mozilla/5.0 LoadTest' else 'Mozilla/5.0' end as ua,
    cast(event_id % 1000 as int) as cid
  from events),
fx as (
  select *, cast(dtm_text as double) as dtm,
    '{"uuid":"' || uuid || '","eid":' || eid || ',"uid":' || uid
    || coalesce(',"dt":' || dt, '') || coalesce(',"dtm":' || dtm_text, '')
    || coalesce(',"src_id":' || src_id, '') || coalesce(',"src":' || src, '')
    || coalesce(',"app":' || app, '') || coalesce(',"ua":"' || ua || '"', '')
    || ',"cid":' || cid || ',"params":"' || replace(props, '"', '\\"') || '"}' as doc
  from fx0)"""

CORE = (
    FX
    + """,
core0 as (
  select *,
    case when src > 100 then src % 100 when src < 100 then src % 10 end as code,
    coalesce(app = 17 and (src_id in (2, 141) or src = 12), false) as mobile_api,
    coalesce(app = 18 and src_id = 141, false) as recommender
  from fx),
core as (
  select *,
    cast(case when dtm > 0 then trunc(dtm * 1000)
         when dt > 0 then cast(dt as bigint) * 1000 else 0 end as bigint) as server_time,
    cast(case when src_id in (148, 149, 150) then 11 when mobile_api then 3
         when recommender then 1 when src_id > 0 then src_id
         else coalesce(code, 0) end as bigint) as apptype,
    cast(case src_id when 148 then 3 when 149 then 23 when 150 then 1
         else case when app > 0 and app <> 17 and not recommender then app else 0 end
         end as bigint) as clientapp,
    cast(case
      when src_id in (1, 96) or (src_id is null and src = 11) or recommender then 1
      when src_id in (3, 95) or (src_id is null and src = 13) or mobile_api then 2
      when app = 3 or src_id = 148 then 3
      when app = 1 or src_id = 150 then 4
      when src_id = 4 or (src_id is null and code = 4) then 5
      when src_id = 6 or (src_id is null and code = 6) then 6
      when app = 23 or src_id = 149 then 7
      when src_id in (12, 209) or (src_id is null and code = 12) then 16547000007
      when src_id = 163 then 8 else 0 end as bigint) as platform,
    cast(case when contains(ua, 'LoadTest') then 1 else 0 end as bigint) as is_test
  from core0),
counted as (
  select * from core where rowkey > '' and is_test = 0
    and eid in (3506, 301, 303, 2649, 2650))"""
)

# All events on the compressed clock, keyed by user.
FAST = (
    FX
    + """,
fast as (
  select event_id, cast(user_id as varchar) as rowkey, counted_eid as eid, uid,
    1704067200000 + (ms - 1704067200000) // 2000 as server_time from fx)"""
)

COUNTS = """
  cast(max(case when uid > 0 then 1 else 0 end) as int) as is_logged_in,
  cast(count(*) filter (where eid = 3506) as bigint) as cnt_pixel,
  cast(count(*) filter (where eid = 301) as bigint) as cnt_item_view,
  cast(count(*) filter (where eid = 303) as bigint) as cnt_phone_view,
  cast(count(*) filter (where eid = 2649) as bigint) as cnt_app_item,
  cast(count(*) filter (where eid = 2650) as bigint) as cnt_app_call"""


def hopping(source: str, where: str = "true") -> str:
    """Every window start of the last ten minutes, two minutes apart."""
    return f"""
  select rowkey, ws as agg_time, rowkey as u, {COUNTS}
  from (select *, server_time - server_time % 120000 - 120000 * k as ws
        from {source}, range(5) hops(k)) expanded
  where {where} group by rowkey, ws"""


def tumbling(source: str) -> str:
    return f"""
  select rowkey, server_time - server_time % 600000 as agg_time, rowkey as u, {COUNTS}
  from {source} group by rowkey, server_time - server_time % 600000"""


def sessions(source: str, gap: int = 600000) -> str:
    return f"""
  select rowkey, min(server_time) as agg_time, max(server_time) + {gap} as session_end,
    rowkey as u, {COUNTS}
  from (select *, sum(fresh) over (partition by rowkey order by server_time, event_id
                                   rows unbounded preceding) as session
        from (select *, case when server_time - lag(server_time) over (
                partition by rowkey order by server_time, event_id) <= {gap}
                then 0 else 1 end as fresh from {source}) marked) numbered
  group by rowkey, session"""


def feature_rows(windows: str, mode: str) -> str:
    def ratio(part: str, whole: str, default: int) -> str:
        value = {
            "integer": f"({part} // {whole})",
            "fraction": f"({part} / {whole})",
        }[mode]
        return f"case when {whole} >= 5 then {value} else {default} end"

    return f"""
  select u, max(agg_time) as agg_time, max(cnt_pixel) > 0 as has_pixel,
    max({ratio('cnt_phone_view', 'cnt_item_view', 0)}) > 0.95 as has_ctr_broken,
    min({ratio('cnt_app_item', 'cnt_item_view', 1)}) < 0.2 as has_frontback_iv_broken,
    min({ratio('cnt_app_call', 'cnt_phone_view', 1)}) < 0.2 as has_frontback_ph_broken
  from ({windows}) w group by u"""


# Payloads of messy messages: text and expected readings, by case.
MESSY = (
    FX
    + """,
messy0 as (
  select *, event_id % 16 as k, cast(user_id as varchar) as usr from fx),
messy as (
  select *,
    case k when 0 then '{"uid":' || usr || ', "eid"' when 1 then '[1, ' || usr || ']'
      when 2 then null when 3 then '{}'
      when 4 then '{"uid":"' || usr || '","eid":"bad","ua":"null"}'
      when 5 then '{"uid":' || usr || '.0,"eid":3000000000,"ua":""}'
      when 6 then '{"eid":5,"eid":6,"EID":7,"Uid":' || usr || '}'
      when 7 then '{"uid":' || usr || ',"uid":null,"eid":""}'
      when 8 then '{"a":tru,"uid":' || usr || '}'
      when 9 then '{"o":{"uid":1,"b":[1,2]},"uid":' || usr || ',"ua":"a\\tb\\/\\u0430"}'
      else doc end as value,
    case when k in (0, 1, 2, 3, 6, 8) then null when k = 5 then usr || '.0'
      when k in (4, 7, 9) then usr else cast(uid as varchar) end as uid_text,
    case when k in (0, 1, 2, 3, 7, 8, 9) then null when k = 4 then 'bad'
      when k = 5 then '3000000000' when k = 6 then '6' else cast(eid as varchar) end as eid_text,
    case when k in (0, 1, 2, 3, 6, 7, 8, 4, 5) then null
      when k = 9 then 'a' || chr(9) || 'b/' || chr(1072) else ua end as ua_text,
    case when k = 9 then '{"uid":1,"b":[1,2]}' end as o_text
  from messy0)"""
)

# Number-like text; sign, digits and float prefix taken apart once.
ODD = """
odd0 as (
  select event_id, case event_id % 12
    when 0 then cast(user_id as varchar) when 1 then '  -' || user_id
    when 2 then user_id || 'xyz' when 3 then user_id || '.75' when 4 then 'true'
    when 5 then 'on' when 6 then 'garbage' when 7 then user_id || '00000000000'
    when 8 then user_id || '9999999999999999999999'
    when 9 then '-9' || lpad(cast(user_id as varchar), 20, '9')
    when 10 then user_id || 'e3' else '+00' || user_id || '.5e1z' end as text
  from events),
odd1 as (
  select *, regexp_extract(text, '^\\s*([+-]?)[0-9]+', 1) as sign,
    regexp_extract(text, '^\\s*[+-]?0*([0-9]*)', 1) as digits,
    regexp_extract(text, '^\\s*([+-]?[0-9]+\\.?[0-9]*(e[0-9]+)?)', 1) as float_text
  from odd0),
odd2 as (
  select *, case when digits = '' then 0::hugeint when length(digits) > 20
      then 100000000000000000000::hugeint else digits::hugeint end as magnitude from odd1),
odd as (
  select *,
    least(greatest(case when sign = '-' then -magnitude else magnitude end,
      -9223372036854775808::hugeint), 9223372036854775807::hugeint) as i64,
    case when magnitude > 18446744073709551615::hugeint then 18446744073709551615::hugeint
      when sign = '-' and magnitude > 0 then 18446744073709551616::hugeint - magnitude
      else magnitude end as u64 from odd2)"""

I32 = (
    "case when (i64 % 4294967296 + 4294967296) % 4294967296 >= 2147483648 "
    "then (i64 % 4294967296 + 4294967296) % 4294967296 - 4294967296 "
    "else (i64 % 4294967296 + 4294967296) % 4294967296 end"
)
U8 = "((i64 % 256 + 256) % 256)"
WORD = "text in ('t', 'true', 'on')"


def xxhash_sql(texts: str) -> str:
    """Public 64-bit hashes (seed 42) of texts under 32 bytes, in wrapping 64 bits.

    A recursive step takes the next eight bytes, else four, else one; each kind has its
    own multipliers and rotation.
    """
    # fixed values: the five primes of the public definition
    p1, p2, p3, p4, p5 = (
        f"{prime}::uhugeint"
        for prime in (
            11400714785074694791, 14029467366897019727, 1609587929392839161,
            9650029242287828579, 2870177450012600261,
        )
    )
    modulus = f"{1 << 64}::uhugeint"

    def power(exponent: int) -> str:
        return f"{1 << exponent}::uhugeint"

    def number(size: int) -> str:
        return " + ".join(
            f"('0x' || substr(hx, 1 + 2 * (t.pos + {i}), 2))::uhugeint * {power(8 * i)}"
            for i in range(size)
        )

    def turned(value: str, by: int) -> str:
        return f"(({value}) * {power(by)} % {modulus} + ({value}) // {power(64 - by)})"

    eight = f"{turned('lane', 31)} * {p1} % {modulus}"
    kinds = ((8, "k = 8", 27, p1, p4), (4, "k = 4", 23, p2, p3), (1, "k = 1", 11, p1, "0::uhugeint"))
    mixed = " ".join(
        f"when {test} then ({turned('x', by)} * {factor} + {extra}) % {modulus}"
        for _, test, by, factor, extra in kinds
    )
    return f"""
  texts as materialized (
    select row_number() over () as id, text, octet_length(encode(text)) as len,
      rpad(hex(encode(text)), 2 * octet_length(encode(text))::int + 16, '0') as hx
    from (select distinct text from ({texts}) t where text is not null) d),
  steps as (
    select id, 0::bigint as pos, (42::uhugeint + {p5} + len::uhugeint) % {modulus} as h from texts
    union all
    select id, pos + k, case {mixed} end as h
    from (
      select *, xor(h, case when k = 8 then {eight} else lane end) as x
      from (
        select t.id, t.pos, t.h, case when len - t.pos >= 8 then 8 when len - t.pos >= 4 then 4 else 1 end as k,
          case when len - t.pos >= 8 then ({number(8)}) * {p2} % {modulus}
            when len - t.pos >= 4 then ({number(4)}) * {p1} % {modulus}
            else ({number(1)}) * {p5} % {modulus} end as lane
        from steps t join texts using (id) where t.pos < len) taken) joined),
  spread as (
    select text, xor(h, h // {power(33)}) * {p2} % {modulus} as h
    from steps join texts using (id) where pos = len),
  spread2 as (select text, xor(h, h // {power(29)}) * {p3} % {modulus} as h from spread),
  hashes as (
    select text, (xor(h, h // {power(32)}) // 2)::bigint as hash from spread2)"""


def hash_sql(texts: str) -> str:
    """Hashes of the column ``text`` of a query, block by block, in wrapping 64 bits.

    A recursive step adds one 24-byte block and mixes; the mixing is a tower of
    subqueries, one per step, that rotate the three words. The last, partial block
    (possibly empty) counts the length and moves its third word up by a byte.
    """
    shifts = (43, -9, 8, 38, -23, 5, 35, -49, 11, 12, -18, 22)
    modulus = "18446744073709551616::hugeint"

    def word(number: int) -> str:
        return " + ".join(
            f"(('0x' || substr(hx, {1 + 16 * number + 2 * i}, 2))::hugeint << {8 * i})"
            for i in range(8)
        )

    inner = f"""
      select s.id, s.block + 1 as block,
        (a + w0) % {modulus} as x, (b + w1) % {modulus} as y, (c + w2) % {modulus} as z
      from steps s join words w on w.id = s.id and w.block = s.block"""
    for shift in shifts:
        moved = f"z >> {shift}" if shift > 0 else f"(z << {-shift}) % {modulus}"
        inner = f"""
      select id, block, y as x, z as y,
        xor((x - y - z + 2 * {modulus}) % {modulus}, {moved}) as z
      from ({inner})"""
    return f"""
  texts as materialized (
    select row_number() over () as id, text, hex(encode(text)) as hx,
      octet_length(encode(text)) as len, octet_length(encode(text)) // 24 as blocks
    from (select distinct text from ({texts}) t where text is not null) d),
  pieces as (
    select id, len, blocks, block, rpad(substr(hx, 1 + 48 * block, 48), 48, '0') as hx
    from (select *, unnest(range(blocks + 1)) as block from texts) cut),
  words as materialized (
    select id, block, {word(0)} as w0, {word(1)} as w1,
      case when block < blocks then {word(2)}
           else (({word(2)}) << 8) % {modulus} + len end as w2 from pieces),
  steps as (
    select id, 0::bigint as block, 200::hugeint as a, 200::hugeint as b,
      {modulus} - 7046029254386353133::hugeint as c from texts
    union all
    select id, block, x as a, y as b, z as c from ({inner})),
  hashes as (
    select text, (c >> 1)::bigint as hash
    from steps join texts using (id) where block > blocks)"""


def _with(ctes: str, body: str, recursive: bool = False) -> str:
    return f"with {'recursive ' if recursive else ''}{ctes}\n{body}"


def limited(order: str, condition: str) -> str:
    return _with(
        FX,
        f"""select partition, "offset", key, value from (
  select part as partition, event_id as "offset", rowkey as key, doc as value,
    row_number() over ({order}) as place from fx where {condition.split('|')[0]}) t
where {condition.split('|')[1]}""",
    )


EVENT_HASH_TEXTS = """
  select uuid as text from fx union all select ua from fx union all select rowkey from fx
  union all select props from fx union all select cast(cid as varchar) from fx"""

TABLE_COLUMNS = """
  select part as _partition, event_id as _offset, ms as _timestamp, cast(eid as bigint) as eid,
    uid, dtm, ua, cast(app as smallint) as app from fx"""


def oracle_sql() -> dict[str, str]:
    sql: dict[str, str] = {}
    core_fields = {
        "core_server_time": "server_time",
        "core_apptype": "apptype",
        "core_clientapp": "clientapp",
        "core_platform": "platform",
        "core_is_test": "is_test",
    }
    for name, field in core_fields.items():
        sql[name] = _with(CORE, f'select event_id as "offset", {field} from core')
    enriched = (
        "rowkey, uuid, dt, dtm, eid, src_id, src, app, uid, ua, cid, props as params, "
        "server_time as _server_time, apptype as _apptype_id, "
        "clientapp as _clientsideapp_id, platform as _platform_id, is_test as _ua_is_test"
    )
    sql["core_enriched"] = _with(
        CORE, f'select part as partition, event_id as "offset", {enriched} from core'
    )
    extended = (
        "substr(doc, 1, length(doc) - 1) || ',\"_server_time\":' || server_time "
        "|| ',\"_apptype_id\":' || apptype || ',\"_clientsideapp_id\":' || clientapp "
        "|| ',\"_platform_id\":' || platform || ',\"_ua_is_test\":' || is_test || '}'"
    )
    sql["core_extend_json"] = _with(
        CORE, f'select event_id as "offset", rowkey, {extended} as value from core'
    )
    sql["core_rekey"] = sql["core_extend_json"]
    sql["core_extend_json_ends"] = _with(
        CORE,
        f"""select event_id as "offset", rowkey,
  case when event_id % 6 <> 3 then {extended} end as value from core""",
    )
    sql["rejects_ends"] = _with(
        FX,
        """select part as partition, event_id as "offset", 'trailing_text' as reason
from fx where event_id % 6 = 3""",
    )
    sql["core_extend_json_messy"] = _with(
        MESSY,
        """select event_id as "offset", k not in (0, 1, 2, 8) as extended from messy""",
    )

    sql["parse_top_level"] = _with(
        MESSY,
        """select event_id as "offset", eid_text as eid, uid_text as uid, ua_text as ua,
  o_text as o from messy""",
    )
    sql["parse_typed"] = _with(
        MESSY,
        """select event_id as "offset",
  case when k in (4, 5) then null else cast(eid_text as int) end as eid,
  cast(case when k = 5 then usr else uid_text end as int) as uid from messy""",
    )
    sql["parse_case_fallback"] = _with(
        MESSY,
        """select event_id as "offset", case when k = 6 then 7 when k in (4, 5) then null
    else cast(eid_text as int) end as eid,
  cast(case when k in (5, 6) then usr else uid_text end as int) as uid from messy""",
    )
    sql["null_normalise"] = _with(
        MESSY,
        """select case when k = 4 then 'null' when k = 5 then '' else coalesce(ua_text, 'absent')
    end as raw, ua_text as text, count(*) as n from messy group by all""",
    )
    sql["parse_rejects"] = _with(
        MESSY,
        """select part as partition, event_id as "offset", case k when 2 then 'missing'
    when 1 then 'not_object' else 'malformed' end as reason, value
from messy where k in (0, 1, 2, 8)""",
    )
    sql["parse_whole_document"] = _with(
        MESSY, 'select event_id as "offset", rowkey, value as document from messy'
    )
    sql["declared_stream"] = _with(
        CORE,
        """select rowkey, eid, uid, server_time as _server_time, cast(is_test as int) as _ua_is_test,
  server_time as event_ms from core""",
    )

    # integer-like text for DuckDB's casts, which round where Spark rejects
    whole = "regexp_matches(text, '^\\s*[+-]?[0-9]+$')"
    number = "regexp_matches(text, '^\\s*[+-]?[0-9]+(\\.[0-9]+)?(e[0-9]+)?$')"
    sql["coerce_strict"] = _with(
        ODD,
        f"""select event_id as "offset", case when {whole} then try_cast(text as int) end as i32,
  case when {whole} then try_cast(text as bigint) end as i64,
  case when {number} then try_cast(text as double) end as f64,
  case when {whole} and i64 between 0 and 255 then cast(i64 as smallint) end as u8,
  case when text in ('true', '1') then true when text = '0' then false end as flag from odd""",
    )
    sql["coerce_number"] = _with(
        ODD,
        f"""select event_id as "offset",
  case when {number} then try_cast(trunc(try_cast(text as double)) as int) end as i32 from odd""",
    )
    sql["coerce_prefix_int"] = _with(
        ODD, f'select event_id as "offset", cast({I32} as int) as i32, cast(i64 as bigint) as i64 from odd'
    )
    sql["coerce_unsigned"] = _with(
        ODD,
        f"""select event_id as "offset", cast({U8} as smallint) as u8,
  cast(u64 % 4294967296 as bigint) as u32, cast(u64 as varchar) as u64 from odd""",
    )
    sql["coerce_truthy"] = _with(
        ODD,
        f"""select event_id as "offset",
  cast(case when {WORD} then 1 else {U8} end as smallint) as u8,
  cast(case when {WORD} then 1 else {I32} end as int) as i32,
  cast(case when {WORD} then 1 else i64 end as bigint) as i64 from odd""",
    )
    sql["coerce_float"] = _with(
        ODD,
        """select event_id as "offset",
  case when float_text = '' then 0 else cast(float_text as double) end as f64 from odd""",
    )
    sql["coerce_boolean"] = _with(
        ODD, """select event_id as "offset", text like 't%' as flag from odd"""
    )
    imported = """
imported as (
  select event_id, case when event_id % 6 = 0 then 'bad' else cast(user_id as varchar) end as id_text,
    case when event_id % 5 = 0 then '' when event_id % 5 = 1 then 'x1' else cast(value as varchar) end as amount_text,
    case when event_id % 7 = 0 then '2024-13-01' else strftime(ts, '%Y-%m-%d') end as day_text,
    event_type as kind from events)"""
    sql["import_null_safe"] = _with(
        imported,
        """select event_id, try_cast(id_text as int) as id, try_cast(nullif(amount_text, '') as double) as amount,
  cast(try_cast(day_text as date) as varchar) as day, kind from imported
where try_cast(id_text as int) is not null""",
    )
    sql["import_rejected"] = _with(
        imported,
        """select event_id, id_text as id, amount_text as amount, day_text as day, kind,
  'id' as missing from imported where try_cast(id_text as int) is null""",
    )

    sql["filter_cookie_events"] = _with(
        CORE, 'select event_id as "offset", rowkey, eid, uid, server_time from counted'
    )
    sql["cookies_hopping"] = _with(CORE, hopping("counted"))
    sql["cookies_hopping_panes"] = sql["cookies_hopping"]
    sql["cookies_hopping_untimely"] = _with(
        CORE
        + """,
timely as (
  select rowkey, eid, uid, server_time from counted where event_id % 50 > 1
  union all select rowkey, 301, 1, 0 from core where event_id % 50 = 1 and rowkey > '')""",
        hopping("timely"),
    )
    sql["cookies_hopping_fast"] = _with(FAST, hopping("fast"))
    sql["cookies_hopping_fast_panes"] = sql["cookies_hopping_fast"]
    sql["cookies_tumbling"] = _with(CORE, tumbling("counted"))
    sql["cookies_session"] = _with(CORE, sessions("counted"))
    sql["latest_by_offset"] = _with(
        FX,
        """select rowkey, arg_max(ua, event_id) filter (where ua is not null) as ua,
  arg_max(src_id, event_id) filter (where src_id is not null) as src_id,
  arg_max(uid, event_id) as uid from fx where rowkey is not null group by rowkey""",
    )
    for mode in ("integer", "fraction"):
        sql[f"features_{mode}"] = _with(FAST, feature_rows(hopping("fast"), mode))
        sql[f"features_{mode}_messages"] = _with(
            CORE, feature_rows(hopping("counted"), mode)
        )
    sql["sql_job"] = sql["features_integer_messages"]

    blank = "coalesce({}, '')"
    sql["export_json_lines"] = _with(
        FX,
        "select part || '|' || event_id || '|' || coalesce(rowkey, '') || '|' || ms || '|' || doc as line from fx",
    )
    sql["export_columns"] = _with(
        FX,
        """select concat_ws('|', ms, uid, eid, coalesce(cast(dt as varchar), ''), coalesce(dtm_text, ''),
  coalesce(cast(src_id as varchar), ''), coalesce(cast(src as varchar), ''), coalesce(ua, '')) as line from fx""",
    )
    sql["export_columns_messy"] = _with(
        MESSY,
        f"""select concat_ws(';', event_id, {blank.format('uid_text')}, {blank.format('eid_text')},
  {blank.format('o_text')}) as line from messy""",
    )
    sql["export_grouped"] = _with(
        FX,
        """select concat_ws('|', part, event_id, uid,
  '{' || eid || ',' || coalesce(cast(app as varchar), '') || '}', cid,
  '{' || coalesce(cast(dt as varchar), '') || ',' || coalesce(cast(src as varchar), '') || ','
      || coalesce(dtm_text, '') || '}') as line from fx""",
    )
    sql["export_eav"] = _with(
        MESSY
        + """,
fields as (
  select event_id, unnest([
    {'field': 'uuid', 'text': uuid}, {'field': 'eid', 'text': cast(eid as varchar)},
    {'field': 'uid', 'text': cast(uid as varchar)}, {'field': 'dt', 'text': cast(dt as varchar)},
    {'field': 'dtm', 'text': dtm_text}, {'field': 'src_id', 'text': cast(src_id as varchar)},
    {'field': 'src', 'text': cast(src as varchar)}, {'field': 'app', 'text': cast(app as varchar)},
    {'field': 'ua', 'text': ua}, {'field': 'cid', 'text': cast(cid as varchar)},
    {'field': 'params', 'text': props}]) as pair from messy where k > 9),
odd_pairs as (
  select event_id, unnest(case k
    when 4 then [{'field': 'uid', 'text': usr}, {'field': 'eid', 'text': 'bad'}, {'field': 'ua', 'text': 'null'}]
    when 5 then [{'field': 'uid', 'text': usr || '.0'}, {'field': 'eid', 'text': '3000000000'}, {'field': 'ua', 'text': ''}]
    when 6 then [{'field': 'eid', 'text': '5'}, {'field': 'eid', 'text': '6'}, {'field': 'EID', 'text': '7'}, {'field': 'Uid', 'text': usr}]
    when 7 then [{'field': 'uid', 'text': usr}, {'field': 'uid', 'text': 'null'}, {'field': 'eid', 'text': ''}]
    when 9 then [{'field': 'o', 'text': '{"uid":1,"b":[1,2]}'}, {'field': 'uid', 'text': usr},
                 {'field': 'ua', 'text': 'a' || chr(9) || 'b/' || chr(1072)}]
    end) as pair from messy where k in (4, 5, 6, 7, 9))""",
        """select cast(event_id as varchar) as "offset", pair.field as field, pair.text as text
from (select * from fields where pair.text is not null union all select * from odd_pairs) p""",
    )
    sql["export_sparse_map"] = _with(
        FX,
        """select cast(event_id as varchar) as "offset", pair.grp as grp, pair.field as field, pair.text as text
from (select event_id, unnest([
    {'grp': 'values', 'field': 'uid', 'text': cast(uid as varchar)},
    {'grp': 'values', 'field': 'dt', 'text': cast(dt as varchar)},
    {'grp': 'values', 'field': 'dtm', 'text': dtm_text},
    {'grp': 'agent', 'field': 'ua', 'text': ua},
    {'grp': 'agent', 'field': 'app', 'text': cast(app as varchar)}]) as pair from fx) p
where pair.text is not null""",
    )
    sql["export_sparse_positions"] = sql["export_sparse_map"].replace(
        "pair.field as field", "pair.place as place"
    )
    for field, place in (("uid", 0), ("dt", 1), ("dtm", 2), ("ua", 0), ("app", 1)):
        sql["export_sparse_positions"] = sql["export_sparse_positions"].replace(
            f"'field': '{field}'", f"'place': {place}"
        )
    sql["export_text_files"] = sql["export_grouped"]
    sql["export_hash"] = _with(
        FX + "," + hash_sql("select uuid as text from fx union all select ua from fx"),
        """select concat_ws('|', event_id, u.hash, fx.uid, coalesce(cast(a.hash as varchar), '')) as line
from fx join hashes u on u.text = fx.uuid left join hashes a on a.text = fx.ua""",
        recursive=True,
    )
    spelled = """
spelled as (
  select event_id, props, user_id || '.50' as first, user_id || '.500' as uid,
    '{"uid":' || user_id || '.5, "b":[1,  {"c":"]}"}]}' as o,
    'a\\tb\\/' || event_type || '\\u0430\\"' as s, '{\\"uid\\": 1.0}' as p
  from events)"""
    sql["export_columns_spelled"] = _with(
        spelled,
        """select concat_ws('|', event_id, uid, regexp_replace(o, '[ ]', '', 'g'), '{"uid": 1.0}',
  regexp_replace(props, '[ ]', '', 'g')) as line from spelled""",
    )
    sql["export_message_spelling"] = _with(
        spelled
        + ","
        + hash_sql("select props as text from spelled union all select s from spelled union all select 'null'"),
        """select concat_ws('|', event_id, '{' || uid || ',' || n.hash || '}', o, '{' || s || ',' || t.hash || '}', p,
  h.hash) as line from spelled join hashes h on h.text = props join hashes t on t.text = s
  join hashes n on n.text = 'null'""",
        recursive=True,
    )
    sql["export_eav_spelling"] = _with(
        spelled,
        """select concat_ws('|', event_id, pair.field, pair.text) as line
from spelled, unnest([{'field': 'uid', 'text': first}, {'field': 'o', 'text': o},
  {'field': 's', 'text': s}, {'field': 'p', 'text': p}, {'field': 'params', 'text': props},
  {'field': 'uid', 'text': uid}, {'field': 'uid', 'text': 'null'}]) as u(pair)""",
    )
    event_hashes = """select fx.event_id as "offset", u.hash as uuid_hash, a.hash as ua_hash, k.hash as key_hash,
  p.hash as props_hash, c.hash as cid_hash
from fx left join hashes u on u.text = fx.uuid left join hashes a on a.text = fx.ua
  left join hashes k on k.text = fx.rowkey left join hashes p on p.text = fx.props
  left join hashes c on c.text = cast(fx.cid as varchar)"""
    sql["hash_compat"] = _with(
        FX + "," + hash_sql(EVENT_HASH_TEXTS), event_hashes, recursive=True
    )
    sql["hash_xxhash"] = _with(
        FX + "," + xxhash_sql(EVENT_HASH_TEXTS), event_hashes, recursive=True
    )
    sql["hash_documents"] = _with(
        hash_sql("select text from documents").lstrip(),
        "select doc_id, hash as text_hash from documents left join hashes using (text)",
        recursive=True,
    )
    sql["orc_roundtrip"] = _with(
        FX,
        """select cast(src_id as bigint) as src_id, cast(src as bigint) as src, uuid,
  cast(uid as bigint) as uid, cast(eid as bigint) as eid, cast(dt as bigint) as dt, dtm,
  case when ua is not null then false end as flag from fx""",
    )
    sql["typed_batch"] = _with(
        FX + "," + hash_sql("select rowkey as text from fx union all select ua from fx"),
        """select ms // 1000 as _timestamp, k.hash as _key, fx.eid, cast(fx.dt as bigint) as dt,
  false as ok, a.hash as ua
from fx left join hashes k on k.text = fx.rowkey left join hashes a on a.text = fx.ua""",
        recursive=True,
    )

    sql["table_append"] = _with(FX, TABLE_COLUMNS)
    sql["table_append_defaults"] = _with(
        FX,
        """select part as _partition, event_id as _offset, ms as _timestamp, cast(eid as bigint) as eid,
  uid, coalesce(dtm, 0) as dtm, coalesce(ua, '') as ua, cast(coalesce(app, 0) as smallint) as app from fx""",
    )
    sql["table_append_self_filled"] = _with(
        FX, "select event_id as _offset, uid, 'stream' as origin from fx"
    )
    sql["task_spec_limit"] = limited(
        "partition by part order by event_id",
        "(part = 0 and event_id >= 100) or part in (1, 3)|"
        "(partition = 0 and place <= 700) or (partition = 1 and place <= 55) or (partition = 3 and place <= 100000)",
    )
    sql["task_spec_range"] = limited(
        "order by part, event_id", "part between 1 and 3 and event_id >= 500|place <= 3000"
    )
    sql["task_spec_two_topics"] = _with(
        FX,
        """, placed as (
  select case when event_id % 3 = 0 then 'second' else 'user-keyed-clickstream' end as topic,
    part, event_id from fx where (part < 3 and event_id >= 5) or part = 3),
numbered as (
  select *, row_number() over (partition by topic, part = 3 order by part, event_id) as place
  from placed)
select topic, part as partition, event_id as "offset" from numbered
where place <= case when part = 3 then 7 else 60 end""",
    )
    sql["task_spec_total"] = limited("order by part, event_id", "true|place <= 4321")
    sql["task_spec_resume"] = limited("order by part, event_id", "true|place <= 1500 + 2200")
    sql["stream_limits"] = _with(
        FX,
        """select part as partition, event_id as "offset", rowkey as key, doc as value from (
  select *, row_number() over (partition by least(part, 2)
    order by event_id * 3 // (select max(event_id) + 1 from events), part, event_id) as place
  from fx where part <> 0 or event_id >= 40) t
where place <= case part when 0 then 700 when 1 then 300 else 1100 end""",
    )
    sql["task_spec_stored"] = limited(
        "order by part, event_id",
        "(part = 0 and event_id >= 900) or (part = 1 and event_id >= 10) or part in (2, 3)|place <= 6000",
    )

    closed = "and ws + 600000 <= (select max(server_time) from counted) - 60000"
    fast_closed = "ws + 600000 <= (select max(server_time) from fast) - 60000"
    sql["stream_append_final"] = _with(CORE, hopping("counted", f"true {closed}"))
    sql["stream_append_panes"] = _with(FAST, hopping("fast", fast_closed))
    sql["stream_update_upsert"] = sql["cookies_hopping"]
    counts = "u, agg_time, cnt_pixel, cnt_item_view, cnt_phone_view, cnt_app_item, cnt_app_call"
    sql["sql_stream_changes"] = _with(CORE, f"select {counts} from ({hopping('counted')}) w")
    sql["sql_stream_final"] = _with(
        CORE, f"select {counts} from ({hopping('counted', f'true {closed}')}) w"
    )
    sql["sql_job_core"] = _with(
        CORE,
        """select event_id as "offset", case when event_id % 6 <> 3 then
  substr(doc, 1, length(doc) - 1) || ',"_server_time":' || server_time
  || ',"_platform_id":' || platform || '}' end as value from core""",
    )
    sql["stream_tumbling"] = sql["cookies_tumbling"]
    sql["stream_session"] = _with(
        CORE,
        f"""select * from ({sessions('counted')}) s
where session_end <= (select max(server_time) from counted) - 60000""",
    )
    sql["stream_documents"] = _with(
        CORE,
        f"""select rowkey as key, {extended} as value, 'CLICKSTREAM_CORE' as topic, part as partition,
  event_id as "offset" from (select * replace (
    case when dtm > 0 or dt > 0 then server_time else ms end as server_time) from core) c""",
    )
    sql["stream_rejects"] = sql["parse_rejects"]
    sql["stream_compacted"] = _with(FAST, hopping("fast"))
    sql["stream_retention"] = _with(
        FAST,
        hopping(
            "fast",
            f"""{fast_closed} and ws // 240000 >=
    ((select max(server_time) from fast) - 60000 - 360000) // 240000""",
        ),
    )
    sql["stream_far_future"] = _with(
        FAST,
        hopping(
            "fast",
            """event_id % 53 <> 0 and ws + 600000 <=
    (select max(server_time) from fast where event_id % 53 <> 0) - 60000""",
        ),
    )
    sql["stream_split"] = _with(
        CORE,
        f"""select part as partition, event_id as "offset",
  case when event_id % 6 <> 3 then rowkey end as key,
  case when event_id % 6 <> 3 then {extended} end as value,
  case when event_id % 6 = 3 then 'trailing_text' end as reason from core""",
    )
    late = "event_id % 10 = 9"
    sql["stream_late_rows"] = _with(
        FAST,
        f"""select rowkey, event_id as "offset", eid, server_time as _server_time,
  ws as agg_time, cut as watermark_ms
from (select *, server_time - server_time % 120000 - 120000 * k as ws from fast, range(5) hops(k)) e,
  (select max(server_time) - 60000 as cut from fast where not ({late})) c
where {late} and ws + 600000 <= cut""",
    )
    # panes that closed, the watermark that their first events make, and what ended by it
    sql["stream_session_panes"] = _with(
        FAST
        + """,
keyed as (select * replace (case when event_id % 3 = 0 then 'hot' else rowkey end as rowkey)
          from fast),
paned as (select * from keyed where (server_time // 20000 + 1) * 20000 <=
          (select max(server_time) from keyed) - 60000),
firsts as (select min(server_time) as first_ms from paned group by rowkey, server_time // 20000)""",
        f"""select * from ({sessions('paned', 20000)}) s
where session_end <= (select max(first_ms) - 20000 from firsts)""",
    )
    sql["stream_late_drop"] = _with(
        FAST,
        hopping(
            "fast",
            f"""not ({late}) or ws + 600000 >
    (select max(server_time) from fast where not ({late})) - 60000""",
        ),
    )
    sql["stream_late_counters"] = sql["stream_late_drop"]
    sql["stream_features"] = _with(
        FAST, feature_rows(hopping("fast", fast_closed), "integer")
    )
    own_time = """,
timed as (select * replace (case when dtm > 0 or dt > 0 then server_time else ms end
  as server_time) from counted)"""
    timed_closed = "ws + 600000 <= (select max(server_time) from timed) - 60000"
    sql["pipeline_end_to_end"] = _with(
        CORE + own_time, feature_rows(hopping("timed", timed_closed), "integer")
    )
    sql["stream_table_append"] = sql["table_append"]
    sql["stream_export_columns"] = sql["export_columns"]
    return sql
