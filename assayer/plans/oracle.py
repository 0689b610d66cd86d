"""The registered queries as plain SQL for an independent engine.

Written against the given tables, without any result of the Spark code. Two
notes on exactness: averages are computed in integers, rounded half up to six
and then to two decimals, since the other engine averages in floating point;
amounts have two decimals in the tables, so casting them is exact.
"""

from __future__ import annotations

BRONZE = """
bronze as (
  select
    cast(event_id as varchar) as event_id,
    cast(user_id as varchar) as user_id,
    concat(user_id, '-', strftime(ts, '%Y%m%d')) as session_id,
    event_type,
    cast(k as varchar) as product_id,
    cast(null as varchar) as product_name,
    concat('k', k // 10) as category,
    value as amount,
    cast(null as varchar) as currency,
    cast(null as bigint) as quantity,
    cast(null as varchar) as email,
    cast(null as varchar) as ip_address,
    cast(null as varchar) as user_agent,
    cast(null as varchar) as country,
    strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') as event_ts,
    strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') as ingested_at,
    cast(case when ts < timestamp '2024-01-11' then 0
      when ts < timestamp '2024-01-21' then 1 else 2 end as bigint) as load_id
  from (select *, cast(json_extract_string(props, '$.k') as int) as k from events)
)"""

TYPED = """
typed as (
  select
    *,
    try_cast(amount as decimal(12,2)) as money,
    try_cast(quantity as int) as pieces,
    try_cast(event_ts as timestamp) as happened,
    try_cast(ingested_at as timestamp) as ingested
  from bronze
),
judged as (
  select
    *,
    case
      when event_id is null or user_id is null or amount is null or isnan(amount)
        or event_ts is null then 'missing_required'
      when happened is null then 'bad_event_ts'
      when money is null then 'amount_out_of_range'
      when money <= 0 then 'non_positive_amount'
      when event_type is null or event_type not in
        ('purchase', 'add_to_cart', 'view', 'wishlist', 'checkout') then 'bad_event_type'
      else 'ok'
    end as reason
  from typed
)"""

IP_MASK = """
case when value is null then null
  when len(string_split(value, '.')) = 4
    then concat(string_split(value, '.')[1], '.x.x.x')
  else 'x.x.x.x' end"""

SILVER = """
silver as (
  select
    event_id, user_id, session_id, event_type, product_id, product_name, category,
    money as amount, currency, pieces as quantity,
    sha256(email) as email_hash, cast(null as varchar) as ip_masked, country,
    happened as event_ts, ingested as ingested_at, load_id
  from judged where reason = 'ok'
)"""

SILVER_COLUMNS = """
event_id, user_id, session_id, event_type, product_id, product_name, category, amount,
currency, quantity, email_hash, ip_masked, country, event_ts, ingested_at"""


def measures(amount: str, row_id: str, buyer: str) -> str:
    """The six measures over ``amount``, a positive decimal with two decimals."""
    cents = f"sum(cast({amount} * 100 as bigint))"
    n = f"count({amount})"
    # Half up to six decimals, then to two.
    average = f"(((2 * {cents} * 10000 + {n}) // (2 * {n})) + 5000) // 10000"
    average = f"cast({average} as decimal(18,2)) * 0.01"
    return f"""
    cast(sum({amount}) as decimal(18,2)) as total_revenue,
    count({row_id}) as transaction_count,
    cast({average} as decimal(18,2)) as avg_order_value,
    cast(max({amount}) as decimal(18,2)) as max_order_value,
    cast(min({amount}) as decimal(18,2)) as min_order_value,
    count(distinct {buyer}) as unique_buyers"""


GOLD = f"""
gold as (
  select date_trunc('hour', event_ts) as hour_bucket, category,
    {measures('amount', 'event_id', 'user_id')}
  from silver where event_type = 'purchase'
  group by date_trunc('hour', event_ts), category
),
gold_by_load as (
  select date_trunc('hour', event_ts) as hour_bucket, category, load_id,
    {measures('amount', 'event_id', 'user_id')}
  from silver where event_type = 'purchase'
  group by date_trunc('hour', event_ts), category, load_id
)"""

GOLD_COLUMNS = """
hour_bucket, category, total_revenue, transaction_count, avg_order_value,
max_order_value, min_order_value, unique_buyers"""

# The rows of a day are a load. The table begins anew with the load of the 1st, 11th,
# 21st and 31st (and with the first load); a last snapshot goes back to number 14.
SNAPSHOTS = f"""
daily as (
  select *, cast(strftime(hour_bucket, '%Y%m%d') as bigint) as load_id from gold
),
numbered as (
  select load_id, count(*) as added_records, max(hour_bucket) as committed_at,
    row_number() over (order by load_id) - 1 as snapshot_id
  from daily group by load_id
),
started as (
  select *, load_id % 10 = 1 or snapshot_id = 0 as starts from numbered
),
grouped as (
  select *, sum(cast(starts as int)) over (order by snapshot_id) as period from started
),
visible as (
  select s.snapshot_id, l.load_id, l.added_records
  from grouped s join grouped l on l.period = s.period and l.snapshot_id <= s.snapshot_id
),
appended as (
  select s.snapshot_id, s.committed_at,
    case when s.starts then 'replace' else 'append' end as operation, s.added_records,
    (select cast(sum(v.added_records) as bigint) from visible v
      where v.snapshot_id = s.snapshot_id) as total_records
  from grouped s
),
snapshots as (
  select * from appended
  union all
  select (select max(snapshot_id) + 1 from appended),
    (select max(committed_at) + interval 1 day from appended), 'restore', 0, total_records
  from appended where snapshot_id = 14
)"""


def _with(*parts: str, select: str) -> str:
    return "with " + ",".join(parts) + "\n" + select.strip()


def _bronze(select: str) -> str:
    return _with(BRONZE, select=select)


def _typed(select: str) -> str:
    return _with(BRONZE, TYPED, select=select)


def _silver(select: str) -> str:
    return _with(BRONZE, TYPED, SILVER, select=select)


def _gold(select: str) -> str:
    return _with(BRONZE, TYPED, SILVER, GOLD, select=select)


def _history(select: str) -> str:
    return _with(BRONZE, TYPED, SILVER, GOLD, SNAPSHOTS, select=select)


def _as_of(snapshot: str) -> str:
    return f"""
select {GOLD_COLUMNS} from daily
where load_id in (select load_id from visible where snapshot_id = {snapshot})"""


def _percent(part: str, whole: str) -> str:
    tenths = f"({part} * 2000 + {whole}) // (2 * {whole})"
    return f"cast(cast({tenths} as decimal(9,0)) * 0.1 as decimal(6,1))"


BRONZE_ROWS = _bronze("select * exclude (load_id) from bronze")
SILVER_ROWS = _silver(f"select {SILVER_COLUMNS} from silver")
GOLD_ROWS = _gold(f"select {GOLD_COLUMNS} from gold")

LAYER_SUMMARY = _gold(f"""
select 'bronze' as layer, count(*) as records, cast(null as bigint) as dropped,
  cast(null as decimal(6,1)) as dropped_pct, cast(null as decimal(18,2)) as total_revenue
from bronze
union all
select 'silver', s.n, b.n - s.n, {_percent('(b.n - s.n)', 'b.n')}, null
from (select count(*) as n from bronze) b, (select count(*) as n from silver) s
union all
select 'gold', count(*), null, null,
  cast(sum(total_revenue) filter (where total_revenue > 0) as decimal(18,2))
from gold""")

EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
IPV4 = r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}"


def _found(pattern: str) -> str:
    return f"""
  select 'documents' as source, doc_id as row_id,
    unnest(regexp_extract_all(text, '{pattern}')) as value from documents
  union all
  select 'pages', page_id, unnest(regexp_extract_all(html, '{pattern}')) from pages"""


# Several given tables, mixed up by their sender; see ``fixture.mixed_feed``.
MIXED = BRONZE.replace("bronze as (", "given as (", 1) + """,
bronze as (
  select * exclude (load_id) from given
  union all by name
  select cast(o_orderkey as varchar) as event_id, cast(o_custkey as varchar) as user_id,
    case when o_orderstatus = 'F' then 'purchase' else o_orderstatus end as event_type,
    o_orderpriority as category, c_acctbal as amount,
    strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%f') as event_ts, o_orderstatus as ingested_at
  from orders left join customer on o_custkey = c_custkey
  union all by name
  select concat(l_orderkey, '-', l_linenumber) as event_id,
    cast(l_suppkey as varchar) as user_id, 'purchase' as event_type, l_returnflag as category,
    case when l_linestatus = 'O' then cast(epoch_us(l_shipdate) as double)
      else l_extendedprice end as amount,
    case when l_returnflag = 'R' then epoch_us(l_shipdate)
      else cast(l_quantity as bigint) end as quantity,
    strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S.%f') as event_ts
  from lineitem
  union all by name
  select cast(p_partkey as varchar) as event_id, p_brand as user_id, 'view' as event_type,
    p_retailprice as amount, p_name as event_ts
  from part
  union all by name
  select cast(d.doc_id as varchar) as event_id, source as user_id, 'view' as event_type,
    lang as category, cast(q as double) as amount, lang as event_ts
  from documents d
  left join (select doc_id, max(quality) as q from labels group by doc_id) l
    on l.doc_id = d.doc_id
)"""


def _mixed(select: str) -> str:
    silver = SILVER.replace("ingested as ingested_at, load_id", "ingested as ingested_at")
    return _with(MIXED, TYPED, silver, select=select)


def _drops(judged: str) -> str:
    return f"""
select r.position, r.reason, count(j.reason) as rows,
  {_percent('count(j.reason)', '(select count(*) from bronze)')} as rows_pct
from (values (0, 'missing_required'), (1, 'bad_event_ts'), (2, 'amount_out_of_range'),
    (3, 'non_positive_amount'), (4, 'bad_event_type'), (5, 'ok')) r(position, reason)
left join {judged} j on j.reason = r.reason
group by r.position, r.reason"""


RECORDS = """
records as (
  select 'events' as source, event_id as row_id, props as record from events
  union all select 'conversations', conv_id, text from conversations
  union all select 'documents', doc_id, text from documents
  union all select 'pages', page_id, html from pages
)"""

MIXED_SUMMARY = _with(
    MIXED,
    TYPED,
    SILVER.replace("ingested as ingested_at, load_id", "ingested as ingested_at"),
    GOLD.partition(",\ngold_by_load")[0],
    select=LAYER_SUMMARY[LAYER_SUMMARY.index("select 'bronze'") :],
)


def _buyers(grain: str, *keys: str) -> str:
    group = "".join(f", {key}" for key in keys)
    return _silver(f"""
select date_trunc('{grain}', event_ts) as {grain}_bucket{group},
  count(distinct user_id) as unique_buyers, true as sketch_is_near
from silver where event_type = 'purchase' group by all""")


MIXED_SILVER = _mixed(f"select {SILVER_COLUMNS} from silver")

ORACLE: dict[str, str] = {
    "bronze_events": BRONZE_ROWS,
    "bronze_json_fields": """
select event_id, props, cast(json_extract_string(props, '$.k') as int) as k,
  not json_valid(props) as is_corrupt
from events""",
    "bronze_json_events": BRONZE_ROWS,
    "silver_required_fields": _bronze("""
select event_id, user_id, amount, event_ts from bronze
where user_id is not null and amount is not null and not isnan(amount)
  and event_id is not null and event_ts is not null"""),
    "silver_typed": _typed("""
select event_id, money as amount, pieces as quantity, happened as event_ts,
  ingested as ingested_at
from typed"""),
    "silver_positive_amount": _typed("""
select event_id, money as amount from typed where money > 0"""),
    "silver_event_enum": _bronze("""
select event_id, event_type from bronze
where event_type in ('purchase', 'add_to_cart', 'view', 'wishlist', 'checkout')"""),
    "silver_events": SILVER_ROWS,
    "silver_drop_accounting": _typed(_drops("judged")),
    "pii_email_hash": f"""
select source, row_id, sha256(value) as email_hash from ({_found(EMAIL)})""",
    "pii_ip_mask": f"""
select source, row_id, {IP_MASK} as ip_masked from ({_found(IPV4)})""",
    "pii_sql_functions": f"""
select source, row_id, 'email' as kind, sha256(value) as masked from ({_found(EMAIL)})
union all
select source, row_id, 'ipv4', {IP_MASK} from ({_found(IPV4)})""",
    "pii_documents": f"""
select row_id as doc_id, 'email' as kind, sha256(value) as masked from ({_found(EMAIL)})
where source = 'documents'
union all
select row_id, 'ipv4', {IP_MASK} from ({_found(IPV4)}) where source = 'documents'""",
    "gold_revenue_per_hour": GOLD_ROWS,
    "gold_total_clean_revenue": """
select cast(sum(cast(c_acctbal as decimal(12,2))) as decimal(18,2)) as total_revenue
from customer where c_acctbal > 0""",
    "gold_negative_rows": """
select c_custkey, cast(c_acctbal as decimal(18,2)) as total_revenue
from customer where c_acctbal < 0""",
    "gold_negative_audit": """
with loads as (
  select c_mktsegment as load_id, count(*) as n,
    count(*) filter (where c_acctbal < 0) as negative,
    row_number() over (order by c_mktsegment) - 1 as snapshot_id
  from customer group by c_mktsegment
)
select s.snapshot_id,
  case when s.snapshot_id = 0 then 'replace' else 'append' end as operation,
  cast(sum(l.n) as bigint) as records,
  case when s.snapshot_id > 0 then max(s.n) end as record_change,
  cast(sum(l.negative) as bigint) as negative_rows
from loads s join loads l on l.snapshot_id <= s.snapshot_id
group by s.snapshot_id""",
    "orders_per_day": f"""
with sold as (select *, cast(o_totalprice as decimal(12,2)) as amount from orders)
select date_trunc('day', o_orderdate) as day_bucket, o_orderpriority,
  {measures('amount', 'o_orderkey', 'o_custkey')}
from sold group by all""",
    "lineitem_per_day": f"""
with sold as (select *, cast(l_extendedprice as decimal(12,2)) as amount from lineitem)
select date_trunc('day', l_shipdate) as day_bucket, l_returnflag,
  {measures('amount', 'l_orderkey', 'l_suppkey')}
from sold group by all""",
    "layer_summary": LAYER_SUMMARY,
    "layer_build": LAYER_SUMMARY,
    "layer_tables": _silver(f"""
select date_trunc('hour', event_ts) as hour_bucket, category,
  cast(case when load_id = 2 then 1 else 0 end as bigint) as load_id,
  {measures('amount', 'event_id', 'user_id')}
from silver where event_type = 'purchase'
group by 1, 2, 3"""),
    "snapshot_append": _history(_as_of("(select max(snapshot_id) from appended)")),
    "snapshot_history": _history("""
select * from snapshots order by committed_at desc, snapshot_id desc limit 5"""),
    "snapshot_history_sql": _history("""
select snapshot_id, operation, total_records,
  (select count(*) from daily where load_id in
    (select load_id from visible where snapshot_id = 14)) as current_rows
from snapshots order by committed_at desc, snapshot_id desc limit 5"""),
    "snapshot_as_of": _history(_as_of("14")),
    "snapshot_restore": _history(_as_of("14")),
    "snapshot_expire": _history("""
select g.load_id, g.committed_at, g.added_records
from grouped g
where g.load_id not in (
  select v.load_id from visible v join appended k using (snapshot_id)
  where k.committed_at > (select max(committed_at) from appended) - interval 7 days
    or k.snapshot_id = (select max(snapshot_id) from appended))"""),
    "lineage_gold_to_silver": _gold("""
select g.hour_bucket, g.category, g.load_id, g.total_revenue, g.transaction_count,
  s.event_id, s.amount
from silver s join gold_by_load g on date_trunc('hour', s.event_ts) = g.hour_bucket
  and s.category is not distinct from g.category and s.load_id = g.load_id
where s.event_type = 'purchase'"""),
    "lineage_gold_to_bronze": _typed("""
select * exclude (money, pieces, happened, ingested, reason) from judged
where reason = 'ok' and event_type = 'purchase'"""),
    "lineage_bronze_to_gold": _gold(f"""
select {GOLD_COLUMNS}, load_id, transaction_count as bronze_rows
from gold_by_load where load_id = 2"""),
    "lineage_silver_to_bronze": _silver("""
select load_id, cast(1 as bigint) as silver_rows, cast(1 as bigint) as bronze_rows,
  count(*) as origins
from silver group by load_id"""),
    "stream_silver": SILVER_ROWS,
    "stream_gold": GOLD_ROWS,
    "stream_quarantine": _mixed("""
select reason, event_id, user_id, event_type, category, amount, event_ts, quantity
from judged where reason <> 'ok'"""),
    "stream_quarantine_silver": MIXED_SILVER,
    "mixed_drop_accounting": _mixed(_drops("judged")),
    "mixed_silver": MIXED_SILVER,
    "mixed_required_fields": _mixed("""
select event_id, user_id, amount, event_ts from bronze
where user_id is not null and amount is not null and not isnan(amount)
  and event_id is not null and event_ts is not null"""),
    "mixed_typed": _mixed("""
select event_id, user_id, quantity as raw_quantity, money as amount, pieces as quantity,
  happened as event_ts, ingested as ingested_at
from typed"""),
    "bronze_variant_fields": _with(RECORDS, select="""
select source, row_id,
  case when json_valid(record) then cast(json_extract_string(record, '$.k') as int) end as k,
  not json_valid(record) as is_corrupt
from records"""),
    "bronze_variant_drift": _with(RECORDS, """
fields as (
  select source, unnest(json_keys(record)) as field from records
  where source = 'events' and json_valid(record)
)""", select="""
select r.source, r.records, r.corrupt_records, f.field,
  case when f.field is not null then 'BIGINT' end as field_type, f.n as field_records
from (
  select source, count(*) as records, count(*) filter (where not json_valid(record))
    as corrupt_records
  from records group by source
) r
left join (select source, field, count(*) as n from fields group by all) f using (source)"""),
    "layer_codecs": _gold("""
select 'bronze' as layer, 'snappy' as codec, count(*) as rows from bronze
union all select 'silver', 'zstd', count(*) from silver
union all select 'gold', 'zstd', count(*) from gold_by_load"""),
    "silver_processed_at": _silver("""
select count(*) as stamped_rows, cast(1 as bigint) as times, true as not_ahead from silver"""),
    "incident_audit": _gold("""
select cast(0 as bigint) as snapshot_id, 'replace' as operation, count(*) as records,
  cast(null as bigint) as record_change, count(*) filter (where total_revenue < 0)
    as negative_rows, cast(sum(total_revenue) as decimal(18,2)) as revenue
from gold
union all
select 1, 'append', count(*) + 2, 2, 2, cast(sum(total_revenue) - 250 as decimal(18,2))
from gold"""),
    "incident_changes": """
select timestamp '2024-02-01' as hour_bucket, 'k1' as category,
  cast(-50 as decimal(18,2)) as total_revenue, 'added' as change, cast(1 as bigint) as times
union all select timestamp '2024-02-01', 'k2', -200, 'added', 1""",
    "incident_recovery": GOLD_ROWS,
    "layer_build_counts": MIXED_SUMMARY,
    "layer_build_drops": _mixed(_drops("judged")),
    "gold_buyers_per_day": _buyers("day", "category"),
    "gold_buyers_per_month": _buyers("month"),
    "order_buyers_per_month": """
select cast(date_trunc('month', o_orderdate) as timestamp) as month_bucket, o_orderpriority,
  count(distinct o_custkey) as unique_buyers, true as sketch_is_near
from orders group by all""",
    "snapshot_retention": _history(f"""
select {GOLD_COLUMNS}, load_id from daily
where load_id in (
  select v.load_id from visible v join appended k using (snapshot_id)
  where k.committed_at > (select max(committed_at) from appended) - interval 7 days
    or k.snapshot_id = (select max(snapshot_id) from appended))"""),
    "snapshot_changes": _with(BRONZE, TYPED, SILVER, """
rolling as (
  select cast(strftime(cast(event_ts as date) + cast(i as int), '%Y%m%d') as bigint) as load_id,
    user_id, cast(sum(amount) as decimal(18,2)) as revenue, count(*) as purchases
  from silver, range(7) r(i)
  where event_type = 'purchase' group by all
),
numbered as (
  select *, dense_rank() over (order by load_id) - 1 as snapshot_id from rolling
),
a as (select user_id, revenue, purchases from numbered where snapshot_id = 14),
b as (select user_id, revenue, purchases from numbered where snapshot_id = 18),
sides as (
  select *, 'added' as side from (select * from b except all select * from a)
  union all
  select *, 'removed' from (select * from a except all select * from b)
)""", select="""
select user_id, revenue, purchases,
  case when min(side) over (partition by user_id) <> max(side) over (partition by user_id)
    then 'changed' else side end as change,
  side, n as times
from (select user_id, revenue, purchases, side, count(*) as n from sides group by all)"""),
    "events_as_of": _history("""
select e.event_id, e.ts as at, s.committed_at, s.snapshot_id, s.total_records
from events e asof left join appended s on e.ts >= s.committed_at"""),
    "events_after_purchase": """
select e.event_id, e.user_id, e.ts, p.ts as bought_at, p.event_id as purchase_id
from events e asof left join
  (select * from events where event_type = 'purchase') p
  on e.user_id = p.user_id and e.ts >= p.ts""",
}
