"""The same results in plain SQL on the given tables, for checking."""

from __future__ import annotations

NS = "epoch_us({0}) * 1000"

EV = """select 'ev.' || event_type as channel, 'user_id=' || user_id as tags_key,
  epoch_us(ts) * 1000 as ts_ns, event_id as seq, value as v_double from events"""

EVS = """select 'evs.' || event_type as channel, '' as tags_key, epoch_us(ts) * 1000 as ts_ns,
  event_id as seq, props from events"""

EMB = """select 'emb.' || label as channel, '' as tags_key, vec_id * 1000000000 as ts_ns, vec_id as seq,
  embedding from embeddings"""

CONV = """select 'conv.' || role as channel, 'conv_id=' || conv_id as tags_key,
  conv_id * 1000000000 + turn as ts_ns, turn as seq, text from conversations"""

CONVA = """select 'conva' as channel, '' as tags_key, conv_id * 1000000000 + turn as ts_ns,
  conv_id * 1000000000 + turn as seq, role || '|' || text as sa from conversations"""

ORDI = """select 'ord.' || o_orderpriority as channel, 'status=' || o_orderstatus as tags_key,
  epoch_us(o_orderdate) * 1000 as ts_ns, o_orderkey as seq, o_custkey from orders"""

U64 = """select 'u64' as channel, '' as tags_key, epoch_us(ts) * 1000 as ts_ns, event_id as seq,
  case when event_id % 2 = 0 then 18446744073709551615::hugeint - event_id
       else event_id::hugeint end as u from events"""

WRAP = "(case when u >= 9223372036854775808::hugeint then u - 18446744073709551616::hugeint else u end)::bigint"


def _all(columns: str = "") -> str:
    extra = f", {columns}" if columns else ""
    parts = {"double": EV, "struct": EVS, "double_array": EMB, "string": CONV, "string_array": CONVA,
             "int": ORDI, "uint64": U64}
    return " union all ".join(
        f"select channel, tags_key, ts_ns, seq, '{kind}' as kind{extra} from ({sql})" for kind, sql in parts.items()
    )


PACKED = f"""select channel, tags_key, batch, min(kind) as kind, count(*) as n,
  arg_min(ts_ns, seq) as first_ts, arg_max(ts_ns, seq) as last_ts
from (select *, (row_number() over (partition by channel, tags_key order by seq) - 1) // 250000 as batch
      from ({_all()}))
group by channel, tags_key, batch"""

BATCHED = f"""select *, (row_number() over (partition by channel, tags_key order by seq) - 1) // 4 as batch
from ({EV})"""

BLOCKS = f"""select channel as shard, channel, tags_key, batch, count(*) as n, max(seq) as last_seq
from ({BATCHED}) group by channel, tags_key, batch"""


def _next_fit(blocks: str, order: str, capacity: int) -> str:
    """Rows of ``blocks`` (shard, n, ...) with request_id, one recursion step per block of a shard."""
    return f"""with recursive b as (
  select *, row_number() over (partition by shard order by {order}) as i from ({blocks})),
 w as (
  select shard, i, n as c, 0::bigint as request_id from b where i = 1
  union all
  select b.shard, b.i,
    case when w.c = 0 or w.c + b.n <= {capacity} then w.c + b.n else b.n end,
    case when w.c = 0 or w.c + b.n <= {capacity} then w.request_id else w.request_id + 1 end
  from w join b on b.shard = w.shard and b.i = w.i + 1)
select b.*, w.request_id from b join w on b.shard = w.shard and b.i = w.i"""


def _delay(keys: str, points: int, delay_ns: int) -> str:
    same = " and ".join(f"b.{k} = w.{k}" for k in keys.split(", "))
    cols = ", ".join(f"b.{k}" for k in keys.split(", "))
    late = f"(w.waiting + 1 >= {points} or b.ts_ns > w.last + {delay_ns})"
    return f"""with recursive b as (
  select {keys}, ts_ns, row_number() over (partition by {keys} order by ts_ns, seq) as i from ({EV})),
 w as (
  select {keys}, i, case when {points} <= 1 then ts_ns else ts_ns end as last,
    case when {points} <= 1 then 0 else 1 end as waiting, 0::bigint as batch,
    case when {points} <= 1 then 1 else 0 end::bigint as next
  from b where i = 1
  union all
  select {cols}, b.i, case when {late} then b.ts_ns else w.last end,
    case when {late} then 0 else w.waiting + 1 end, w.next,
    case when {late} then w.next + 1 else w.next end
  from w join b on {same} and b.i = w.i + 1)
select {keys}, batch, count(*) as n from w group by {keys}, batch"""


REQUESTS = _next_fit(BLOCKS, "last_seq, channel, tags_key, batch", 50)

_BRANCHES = """
select channel, ts_ns, 0 as tag, v_double as d, null::bigint as l, null::varchar as s, null::varchar as json,
  null::integer as da_n, null::double as da_first, null::varchar as sa from ({ev})
union all select channel, ts_ns, 5, null, null, null, props, null, null, null from ({evs})
union all select channel, ts_ns, 3, null, null, null, null, len(embedding)::integer, embedding[1]::double, null
  from ({emb})
union all select channel, ts_ns, 1, null, null, text, null, null, null, null from ({conv})
union all select channel, ts_ns, 4, null, null, null, null, null, null, sa from ({conva})
union all select channel, ts_ns, 2, null, o_custkey, null, null, null, null, null from ({ordi})
union all select channel, ts_ns, 2, null, {wrap}, null, null, null, null, null from ({u64})
""".format(ev=EV, evs=EVS, emb=EMB, conv=CONV, conva=CONVA, ordi=ORDI, u64=U64, wrap=WRAP)

_RECORDS = f"select channel, tags_key, n, first_ts, last_ts from ({PACKED})"

_LI = """select '{0}' as channel, 'linestatus=' || l_linestatus || ';returnflag=' || l_returnflag as tags_key,
  epoch_us(l_shipdate) * 1000 as ts_ns, '{1}' as kind, {2} as v_double, {3} as v_string from lineitem"""

ORACLES = {
    "channel_key_plain": "select 'ev.' || event_type as channel, '' as tags_key, count(*) as n from events group by 1, 2",
    "channel_key_tagged": """select 'li' as channel,
      'linestatus=' || l_linestatus || ';returnflag=' || l_returnflag as tags_key, count(*) as n
      from lineitem group by 1, 2""",
    "ts_split_trunc": """select event_id as id, (epoch_us(ts) * 1000 - 1705000000000000000) // 1000000000 as secs,
      ((epoch_us(ts) * 1000 - 1705000000000000000) % 1000000000)::integer as nanos from events""",
    "ts_split_euclid": """select event_id as id, epoch_us(ts) * 1000 // 1000000000 as secs,
      (epoch_us(ts) * 1000 % 1000000000)::integer as nanos from events""",
    "ts_from_interval": "select event_id as id, epoch_us(ts) * 1000 as ts_ns from events",
    "ts_from_datetime": "select event_id as id, epoch_us(ts) * 1000 as ts_ns from events",
    "ts_from_iso": "select event_id as id, epoch_us(ts) * 1000 + 123 as ts_ns from events",
    "ts_recombine": "select event_id as id, epoch_us(ts) * 1000 as ts_ns from events",
    "infer_kind_scalar": """select c.channel, c.kind, n from (select count(*) as n from lineitem),
      (values ('quantity', 'double'), ('orderkey', 'double'), ('returnflag', 'string'),
              ('linenumber', 'int'), ('suppkey', 'int')) c(channel, kind)""",
    "infer_kind_batch": """select c.channel, c.kind, 2 * n as n from (select count(*) as n from lineitem),
      (values ('prices', 'double'), ('keys', 'double'), ('flags', 'string')) c(channel, kind)""",
    "struct_to_json": "select event_id as id, event_id::varchar as k, event_type from events",
    "struct_passthrough": "select event_id as id, props as v_json from events",
    "u64_wrap": f"select seq as id, {WRAP} as v from ({U64})",
    "series_len_guard": """select l_returnflag as channel, count(*) filter (l_linestatus = 'O') as ok_n,
      count(*) filter (l_linestatus <> 'O') as bad_n from lineitem group by 1""",
    "default_channel": """select coalesce(nullif(event_type, 'error'), 'values') as channel, count(*) as n
      from events group by 1""",
    "points_from_rows": f"select channel, tags_key, ts_ns, v_double from ({EV})",
    "points_from_series": """select 'emb.' || label as channel, vec_id * 1000000000 + i - 1 as ts_ns, i - 1 as seq,
      embedding[i]::double as v_double
      from (select *, unnest(generate_series(1, len(embedding))) as i from embeddings)""",
    "points_from_wide": " union all ".join([
        _LI.format("li.quantity", "double", "l_quantity", "null::varchar"),
        _LI.format("li.extendedprice", "double", "l_extendedprice", "null"),
        _LI.format("li.discount", "double", "l_discount", "null"),
        _LI.format("li.returnflag", "string", "null", "l_returnflag"),
    ]),
    "points_from_map": " union all ".join(
        f"""select 'li.{c}' as channel, 'returnflag=' || l_returnflag as tags_key,
        epoch_us(l_shipdate) * 1000 as ts_ns, l_{c} as v_double from lineitem""" for c in ("tax", "discount")
    ),
    "points_from_struct": """select 'evs.' || event_type as channel, epoch_us(ts) * 1000 as ts_ns,
      (props->>'$.k')::bigint as k from events""",
    "points_from_double_array": """select channel, ts_ns, i - 1 as idx, embedding[i]::double as v
      from (select *, unnest(generate_series(1, len(embedding))) as i from (""" + EMB + "))",
    "points_from_string_array": """select 'conva' as channel, conv_id * 1000000000 + turn as ts_ns, 0::bigint as idx,
      role as v from conversations union all
      select 'conva', conv_id * 1000000000 + turn, 1, text from conversations""",
    "points_int": f"select channel, ts_ns, o_custkey as value from ({ORDI})",
    "points_uint64": f"select channel, ts_ns, u::varchar as value from ({U64})",
    "points_double": "select 'li.tax' as channel, epoch_us(l_shipdate) * 1000 as ts_ns, l_tax as value from lineitem",
    "points_string": f"select channel, ts_ns, text as value from ({CONV})",
    "points_from_typed_blocks": f"""select channel, 0::bigint as block_id, count(*) as n from ({EV}) group by 1
      union all select channel, 1, count(*) from ({EVS}) group by 1
      union all select channel, 2, count(*) from ({ORDI}) group by 1""",
    "pack_series": PACKED,
    "batch_by_count": f"select channel, tags_key, batch, count(*) as n from ({BATCHED}) group by 1, 2, 3",
    "batch_by_delay": _delay("channel, tags_key", 4, 86_400 * 10**9),
    "batch_by_delay_busy": _delay("channel", 100, 3600 * 10**9),
    "pack_requests_next_fit": "select shard, request_id, count(*) as n_blocks, sum(n)::bigint as n_points from ("
    + _next_fit(
        """select o_orderpriority as shard, o_orderkey as block_id, count(l_orderkey) as n
           from orders left join lineitem on o_orderkey = l_orderkey group by 1, 2""", "block_id", 50)
    + ") group by 1, 2",
    "build_requests": f"""select shard, request_id, count(distinct (channel, tags_key)) as n_series, sum(n)::bigint as n_points,
      sum(n)::bigint as n_values from ({REQUESTS}) group by 1, 2""",
    "request_sizes": f"""select shard, count(*) as n_requests, min(p)::bigint as least, max(p)::bigint as most,
      sum(k)::bigint as n_series
      from (select shard, request_id, sum(n) as p, count(distinct (channel, tags_key)) as k
        from ({REQUESTS}) group by 1, 2) group by 1""",
    "kind_conflicts": f"""select channel, tags_key, 2::bigint as n_kinds from ({EV}) where channel = 'ev.error'
      group by 1, 2""",
    "block_point_count": """select 'emb.' || label as channel, vec_id as block_id,
      case when label <> 0 then len(embedding) else 0 end as n from embeddings""",
    "unpack_series": f"select channel, tags_key, ts_ns, v_double from ({EV})",
    "pack_series_by_size": """with recursive b as (
  select 'doc.' || lang as channel, 16 + strlen(text) as size, row_number() over (partition by lang order by doc_id) as i from documents),
 w as (
  select channel, i, size, size as bytes, 1 as points, 0::bigint as batch from b where i = 1
  union all
  select b.channel, b.i, b.size, case when w.bytes + b.size <= 20000 and w.points < 50 then w.bytes + b.size else b.size end,
    case when w.bytes + b.size <= 20000 and w.points < 50 then w.points + 1 else 1 end,
    case when w.bytes + b.size <= 20000 and w.points < 50 then w.batch else w.batch + 1 end
  from w join b on b.channel = w.channel and b.i = w.i + 1)
select channel, batch, count(*) as n, sum(size)::bigint as bytes from w group by channel, batch""",
    "unpack_series_ties": """select 'li.tax' as channel, 'returnflag=' || l_returnflag as tags_key, count(*) as n,
      count(*) as n_seq, count(*) as span from lineitem group by 2""",
    "encode_union": _BRANCHES,
    "encode_empty": """select 'emb.' || label as channel,
      sum(case when label <> 0 then len(embedding) else 0 end)::bigint as n_ts,
      sum(case when label <> 0 then len(embedding) else 0 end)::bigint as n_vals from embeddings group by 1""",
    "file_records": _RECORDS,
    "file_roundtrip": _RECORDS,
    "read_series_file": f"""select channel, 'dataset-1' as dataset_id, count(*) as n, count(*) as n_values
      from ({_all()}) group by 1""",
    "file_point_total": f"select count(*) as total from ({_all()})",
    "file_channels": f"select channel, count(*) as n from ({PACKED}) group by 1",
    "file_values_by_branch": _BRANCHES,
    "point_counts_by_channel": f"select channel, min(kind) as kind, count(*) as n from ({_all()}) group by 1",
    "series_counts_by_channel": f"select channel, 'double' as kind, count(*) as n from ({EV}) group by 1",
    "total_double_points": f"select count(*) as n from ({EV}) where channel = 'ev.click'",
    "last_series_per_channel": f"""select channel, request_id, n from (select *,
      row_number() over (partition by channel order by request_id desc, last_seq desc) as k from (
        select channel, tags_key, request_id, sum(n)::bigint as n, max(last_seq) as last_seq
        from ({REQUESTS}) group by 1, 2, 3))
      where k = 1""",
}

_EV_BLOCKS_50 = f"""select 0 as shard, channel, tags_key, batch, count(*) as n, max(seq) as last_seq from (
  select *, (row_number() over (partition by channel, tags_key order by seq) - 1) // 50 as batch from ({EV}))
  group by channel, tags_key, batch"""

DELIVERY_ORACLES = {
    "admitted_points": f"select channel, 'double' as kind, count(*) as n, true as bounded from ({EV}) group by 1",
    "stream_equals_batch": f"select channel, 'double' as kind, count(*) as n from ({EV}) group by 1",
    "batch_stream": ORACLES["batch_by_delay"],
    "fallback_route": f"""select case when channel = 'ev.click' then 'fallback' else 'primary' end as sink, channel,
      count(distinct request_id) as requests, sum(n)::bigint as n from ({REQUESTS}) group by 1, 2""",
    "streamed_requests": """select 'emb.' || label as channel, true as ok, count(*) as requests,
      count(distinct vec_id) as keys, sum(len(embedding))::bigint as n from embeddings group by 1""",
    "dual_write": f"""select s.sink, channel, n from (select channel, count(*) as n from ({EV}) group by 1),
      (values ('table'), ('files')) s(sink)""",
    "spool_ingest": f"select channel, count(*) as n from ({_all()}) group by 1",
    "delivery_stats": f"""select 0::bigint as batch, count(distinct request_id) as requests, sum(n)::bigint as points
      from ({_next_fit(_EV_BLOCKS_50, "last_seq, channel, tags_key, batch", 50)})""",
}
