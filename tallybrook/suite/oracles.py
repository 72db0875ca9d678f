"""DuckDB SQL with the answer of every query, over the same tables."""

from ..functions.metric_names import RULES
from ..sources.testdata import BEAN_ATTRIBUTES

ORDERS = """
f_orders as (
  select cast(user_id as varchar) as key, cast(event_id as varchar) as order_id,
         cast(round(value * 100) as bigint) as amount_cents, event_type as currency,
         ts as "timestamp", cast(user_id % 6 as integer) as partition, event_id as "offset",
         event_id + (event_id * 7919) % 50 as arrival
  from events)"""

HISTORY = """
f_history as (
  select c_custkey as k, c_custkey as "offset", timestamp '2023-12-31 00:00:00' as "timestamp",
         case c_mktsegment when 'AUTOMOBILE' then 'FREE' when 'BUILDING' then 'FREE'
              when 'FURNITURE' then 'PRO' when 'HOUSEHOLD' then 'ENTERPRISE' end as tier,
         false as deleted
  from customer where c_mktsegment <> 'MACHINERY'
  union all
  select c_custkey, 10000000 + c_custkey, timestamp '2024-01-10 00:00:00', 'ENTERPRISE', false
  from customer where c_custkey % 3 = 0
  union all
  select c_custkey, 20000000 + c_custkey, timestamp '2024-01-20 00:00:00', null, true
  from customer where c_custkey % 7 = 0),
versions as (
  select cast(k as varchar) as key, cast(k % 6 as integer) as partition, "offset", "timestamp",
         tier, deleted
  from f_history)"""

LATEST = """
latest as (
  select * from (
    select key, max("offset") as "offset", arg_max(tier, "offset") as newest_tier,
           arg_max(deleted, "offset") as gone, arg_max("timestamp", "offset") as "timestamp"
    from versions group by key)
  where not gone)"""

# newest profile of every customer, upgrades and deletions included
BASE = f"""{HISTORY},{LATEST},
base as (select key, newest_tier as tier from latest)"""


def _with(*parts):
    return "with " + ",".join(parts) + "\n"


def _window_of(size, ts='"timestamp"'):
    start = f"time_bucket(interval '{size}', {ts}, timestamp '1970-01-01')"
    return start, f"{start} + interval '{size}'"


def _a1(size):
    start, end = _window_of(size)
    return f"""
a1 as (
  select o.key as customer_id, tier, currency, {start} as window_start, {end} as window_end,
         count(*) as order_count, cast(sum(amount_cents) as bigint) as total_amount_cents
  from f_orders o join base b on o.key = b.key
  group by all)"""


def _changelog(amount="amount_cents"):
    start, end = _window_of("1 day")
    over = 'over (partition by o.key, tier, currency, ws order by "offset")'
    return f"""
changelog as (
  select o.key as customer_id, tier, currency, ws as window_start,
         ws + interval '1 day' as window_end, count(*) {over} as order_count,
         cast(sum({amount}) {over} as bigint) as total_amount_cents,
         order_id, partition, "offset", "timestamp"
  from (select *, {start} as ws from f_orders) o join base b on o.key = b.key)"""


STRICT = """
timed as (
  select o.*, max("timestamp") over (partition by partition order by arrival, "offset"
           rows between unbounded preceding and current row) as stream_time,
         time_bucket(interval '5 minutes', "timestamp", timestamp '1970-01-01')
           + interval '5 minutes' as window_end
  from f_orders o where key in (select key from base))"""

REPEATED = """
r_orders as (
  select * from f_orders
  union all
  select key, order_id, amount_cents, currency, "timestamp", partition,
         "offset" + 1000000000000, arrival
  from f_orders where "offset" % 100 = 0
  union all
  select key, order_id, amount_cents, currency, "timestamp", (partition + 1) % 6, "offset", arrival
  from f_orders where "offset" % 100 = 50
  union all
  select key, order_id, amount_cents, currency, "timestamp", (partition + 1) % 6, "offset" - 25, arrival
  from f_orders where "offset" % 100 = 75)"""

ORDER_CHECKS = """
records as (
  select key, partition, "offset",
         case when "offset" % 1000000000000 % 101 = 0 then '' else order_id end as order_id,
         case when "offset" % 1000000000000 % 103 = 0 then 'nobody' else key end as customer_id
  from r_orders where "offset" % 1000000000000 % 97 <> 0),
order_checks as (
  select key, "offset", order_id,
         concat_ws(', ', case when order_id = '' then 'missing order id' end,
           case when customer_id is distinct from key then 'key mismatch' end,
           case when order_id <> '' and row_number() over (
                  partition by order_id order by partition, "offset") > 1
                then 'duplicate order id' end) as violations
  from records)"""

WINDOW_CHECKS = """
broken as (
  select customer_id, tier, currency, window_start, "offset",
         case when "offset" % 59 = 0 then 'OTHER' else tier end as v_tier,
         case when "offset" % 61 = 0 then window_end + interval '1 day' else window_end end as v_end,
         case when "offset" % 67 = 0 then order_count - 1 else order_count end as v_count,
         case when "offset" % 71 = 0 then total_amount_cents + 1
              when "offset" % 67 = 0 then total_amount_cents - 4242
              else total_amount_cents end as v_total
  from changelog where "offset" % 73 <> 0),
previous as (
  select *, lag(v_count) over w as p_count, lag(v_total) over w as p_total
  from broken window w as (partition by customer_id, tier, currency, window_start order by "offset")),
window_checks as (
  select customer_id, "offset", v_count as order_count, v_total as total_amount_cents,
         concat_ws(', ', case when v_total <> v_count * 4242 then 'sum' end,
           case when v_tier <> tier then 'dims' end,
           case when v_end - window_start <> interval '1 day' then 'window width' end,
           case when v_count < p_count or v_total < p_total then 'non-monotonic' end) as violations
  from previous)"""

ENRICHED_COLUMNS = """o.key, order_id, currency, tier, cast(1 as bigint) as order_count,
       amount_cents as total_amount_cents, o.partition, o."offset", o."timestamp\""""

ASOF = f"""
matched as (
  select o.*, case when not v.deleted then v.tier end as tier
  from f_orders o asof left join versions v
    on o.key = v.key and o."timestamp" >= v."timestamp")"""

REPLAY = """
queue as (
  select *, max("timestamp") over (partition by partition order by arrival, "offset") as clock
  from f_orders),
table_queue as (
  select *, max("timestamp") over (partition by partition order by "offset") as clock
  from versions),
merged as (
  select key, clock, 0 as side, "offset", case when not deleted then tier end as tier,
         "offset" as version, null as order_id
  from table_queue
  union all
  select key, clock, 1, arrival * 1000000 + "offset" % 1000000, null, null, order_id from queue),
seen as (
  select *, last_value(version ignore nulls) over (partition by key order by clock, side, "offset")
              as current_version
  from merged),
matched as (
  select q.*, case when not v.deleted then v.tier end as tier
  from queue q join seen s on s.order_id = q.order_id
  left join versions v on v.key = q.key and v."offset" = s.current_version)"""

RAW = """
raw_records as (
  select event_id as "offset",
         case when event_id % 83 = 0 then '000000'
              else (case when event_id % 89 = 0 then '01' else '00' end)
                   || printf('%08X', event_id % 6007) || hex(encode(props)) end as digits
  from events),
prefix as (
  select "offset", case when digits[1:2] = '01' then 1 else 0 end as magic, digits,
         length(digits) >= 10 as long_enough
  from raw_records),
split as (
  select "offset", magic,
         case when long_enough and magic = 0 then cast('0x' || digits[3:10] as bigint) end
           as schema_id,
         case when long_enough and magic = 0 then digits[11:] end as payload,
         case when not long_enough then 'short_prefix' when magic <> 0 then 'bad_magic' end
           as wire_error
  from prefix),
id_counts as (
  select schema_id, count(*) as records from split where schema_id is not null group by 1)"""

REGISTRY = """
part_versions as (
  select p_partkey as p, v as version, p_partkey * 2 + v as global_id,
         p_partkey * 2 + v + p_partkey % 3 as content_id,
         'topic-' || p_partkey || '-value' as subject
  from part cross join (values (1), (2)) t(v)),
known_fields as (
  select * from (values
    ('orderId', false), ('id', false), ('customerId', false), ('amountCents', false),
    ('currency', true), ('placedAt', false), ('note', true), ('channel', false)
  ) f(field, has_default)),
registry as (
  select subject, version, global_id, content_id, field, has_default
  from part_versions, known_fields
  where case field
    when 'orderId' then not (version = 2 and p % 5 = 0)
    when 'id' then version = 2 and p % 5 = 0
    when 'amountCents' then not (version = 2 and p % 13 = 0)
    when 'note' then version = 2 and p % 7 = 0
    when 'channel' then version = 2 and p % 11 = 0
    else true end)"""


def _samples(value):
    return f"""
samples as (
  select 'kafka-' || (user_id % 3 + 1) as instance, ts, cast({value} as double) as value
  from events)"""


MESSAGES = _samples("event_id % 5000")
URP = _samples(
    "case when event_id % 1000 between 250 and 399 then 65 "
    "when event_id % 1000 between 400 and 449 then 20 else 0 end"
)
IDLE = _samples("case when event_id % 40 = 0 then 0.5 else 2.0 end")


def _quoted(text):
    return "'" + text.replace("'", "''") + "'"


def _parts(template):
    """Literal texts and group numbers of a template."""
    pieces = template.split("$")
    for i, piece in enumerate(pieces):
        if i:
            yield int(piece[0])
            piece = piece[1:]
        if piece:
            yield piece


def _fill_sql(template, pattern):
    parts = [
        f"regexp_extract(attribute, {_quoted(pattern)}, {p})" if isinstance(p, int) else _quoted(p)
        for p in _parts(template)
    ]
    return " || ".join(parts) or "''"


def _metric_normalise():
    names = ", ".join(_quoted(a) for a in BEAN_ATTRIBUTES)
    safe = "regexp_replace(regexp_replace({}, '[^a-zA-Z0-9:_]', '_', 'g'), '_+', '_', 'g')"
    branches = {"metric": [], "kind": [], "labels": []}
    for rule in RULES:
        test = f"when regexp_matches(attribute, {_quoted(rule.pattern)}) then "
        pairs = [
            f"case when {_fill_sql(v, rule.pattern)} <> '' then "
            f"{safe.format(_fill_sql(k, rule.pattern))} || '=' || {_fill_sql(v, rule.pattern)} end"
            for k, v in rule.labels.items()
        ]
        labels = (
            f"array_to_string(list_sort(list_filter([{', '.join(pairs)}], lambda x: x is not null)), ',')"
            if pairs
            else "''"
        )
        branches["metric"].append(test + f"lower({safe.format(_fill_sql(rule.name, rule.pattern))})")
        branches["kind"].append(test + _quoted(rule.kind))
        branches["labels"].append(test + labels)
    columns = ",\n".join(
        f"case {' '.join(cases)} end as {name}" for name, cases in branches.items()
    )
    return f"""
with beans as (
  select event_id as sample_id,
         replace(replace(replace(([{names}])[event_id % {len(BEAN_ATTRIBUTES)} + 1],
           '$c', 'client-' || (user_id % 100)), '$t', event_type), '$p', cast(user_id % 6 as varchar))
           as attribute
  from events)
select * from (select sample_id, {columns} from beans) where metric is not null"""


RECONCILED = """
, damaged as (
  select * replace (order_count + case when cast(customer_id as bigint) % 51 = 0 then 1 else 0 end
                    as order_count)
  from a1 where cast(customer_id as bigint) % 50 <> 0)
select e.customer_id, e.tier, e.currency, e.window_start, e.window_end,
       coalesce(w.order_count, 0) as written_count,
       coalesce(w.total_amount_cents, 0) as written_cents,
       e.order_count as expected_count, e.total_amount_cents as expected_cents,
       case when w.order_count is null then 'missing' else 'different' end as verdict
from a1 e left join damaged w using (customer_id, tier, currency, window_start, window_end)
where w.order_count is null or w.order_count <> e.order_count"""


def all_oracles():
    a1, a1_day = _a1("5 minutes"), _a1("1 day")
    return {
        "scan_orders": _with(ORDERS)
        + 'select key, order_id, amount_cents, currency, "timestamp" as placed_at, partition,'
        ' "offset" from f_orders',
        "generated_orders": """
select c.name as key, md5(cast(event_id as varchar)) as order_id,
       (['HUF', 'EUR', 'USD'])[event_id % 3 + 1] as currency, c.tier,
       cast(4242 as bigint) as total_amount_cents, event_id as "offset", ts as "timestamp"
from events join (values (0, 'alice', 'FREE'), (1, 'bob', 'PRO'), (2, 'carol', 'PRO'),
                         (3, 'david', 'ENTERPRISE')) c(i, name, tier) on event_id % 4 = c.i""",
        "conform_orders": _with(ORDERS)
        + """
select key, "offset", case when "offset" % 3 <> 2 then order_id end as order_id,
       case when "offset" % 3 = 1 then 'EUR' else currency end as currency,
       case when "offset" % 3 = 2 then 'missing required field: order_id' end as reason
from f_orders""",
        "latest_profiles": _with(HISTORY, LATEST)
        + """
select key, n_name as country, newest_tier as tier, "offset", "timestamp"
from latest join customer on cast(c_custkey as varchar) = key join nation on n_nationkey = c_nationkey""",
        "orders_enriched": _with(ORDERS, HISTORY, LATEST)
        + f"""
select {ENRICHED_COLUMNS}
from f_orders o left join (select key, newest_tier as tier from latest) l on o.key = l.key""",
        "orders_unmatched": _with(ORDERS, HISTORY, LATEST)
        + """
select key, order_id, amount_cents, "offset", "timestamp" from f_orders
where key not in (select key from latest)""",
        "orders_dead_letter": _with(ORDERS)
        + """
, profiles as (
  select cast(c_custkey as varchar) as key,
         case when c_acctbal < 0 then 'TRIAL' else
           case c_mktsegment when 'AUTOMOBILE' then 'FREE' when 'BUILDING' then 'FREE'
              when 'FURNITURE' then 'PRO' when 'HOUSEHOLD' then 'ENTERPRISE' end end as tier
  from customer where c_mktsegment <> 'MACHINERY'),
keyed as (
  select * replace (case when "offset" % 50 <> 0 then key end as key) from f_orders)
select o.key, order_id, tier, "offset",
       case when o.key is null then 'missing key' when tier is null then 'no profile'
            else 'unknown tier' end as reason
from keyed o left join profiles p on o.key = p.key
where o.key is null or tier is null or tier not in ('FREE', 'PRO', 'ENTERPRISE')""",
        "enrich_asof": _with(ORDERS, HISTORY, ASOF)
        + f"select {ENRICHED_COLUMNS} from matched o",
        "enrich_replay": _with(ORDERS, HISTORY, REPLAY)
        + f"select {ENRICHED_COLUMNS} from matched o",
        "enrich_table_first": _with(ORDERS, HISTORY, LATEST)
        + f"""
select {ENRICHED_COLUMNS}
from f_orders o left join (select key, newest_tier as tier from latest) l on o.key = l.key""",
        "orders_per_window": _with(ORDERS, BASE, a1) + "select * from a1",
        "orders_per_window_1d": _with(ORDERS, BASE, a1_day) + "select * from a1",
        "orders_per_window_asof": _with(ORDERS, HISTORY, ASOF)
        + f"""
select key as customer_id, tier, currency, {_window_of("1 day")[0]} as window_start,
       {_window_of("1 day")[1]} as window_end, count(*) as order_count,
       cast(sum(amount_cents) as bigint) as total_amount_cents
from matched where tier is not null group by all""",
        "window_changelog": _with(ORDERS, BASE, _changelog()) + "select * from changelog",
        "orders_strict_no_grace": _with(ORDERS, BASE, STRICT)
        + """
select key, partition, order_id, amount_cents, arrival, "timestamp" from timed
where window_end > stream_time""",
        "late_orders": _with(ORDERS, BASE, STRICT)
        + """
select key, partition, order_id, arrival, window_end, stream_time from timed
where window_end <= stream_time""",
        "window_retention": _with(ORDERS, BASE, a1)
        + """
select * from a1
where window_end + interval '86700 seconds' > (select max(ts) from events)""",
        "window_string_key": _with(ORDERS, BASE, a1)
        + """
select customer_id || '@' || strftime(window_start, '%Y-%m-%dT%H:%M:%SZ') as label, tier,
       currency, order_count, true as well_formed
from a1""",
        "duplicate_orders": _with(ORDERS, REPEATED)
        + """
select key, order_id, "offset", first_seen from (
  select key, order_id, "offset", first_value("offset") over places as first_seen,
         row_number() over places as place
  from r_orders window places as (partition by order_id order by partition, "offset"))
where place > 1""",
        "validate_orders": _with(ORDERS, REPEATED, ORDER_CHECKS) + "select * from order_checks",
        "validate_windows": _with(ORDERS, BASE, _changelog("4242"), WINDOW_CHECKS)
        + "select * from window_checks",
        "validation_summary": _with(
            ORDERS, REPEATED, ORDER_CHECKS, BASE, _changelog("4242"), WINDOW_CHECKS
        )
        + """
select count(*) as validated, count(*) filter (violations <> '') as failed, 'orders' as checked
from order_checks
union all
select count(*), count(*) filter (violations <> ''), 'windows' from window_checks""",
        "window_value_conflicts": _with(ORDERS, BASE, _changelog())
        + """
select customer_id, tier, currency, window_start, window_end,
       min(total_amount_cents) as lowest_cents, max(total_amount_cents) as highest_cents,
       count(*) as occurrences
from changelog group by all having count(distinct total_amount_cents) > 1""",
        "reconcile_windows": _with(ORDERS, BASE, a1_day) + RECONCILED,
        "stream_reconcile_windows": _with(ORDERS, BASE, a1_day) + RECONCILED,
        "wire_prefix": _with(RAW)
        + "select * replace (coalesce(schema_id, -1) as schema_id) from split",
        "dangling_schema_ids": _with(RAW, REGISTRY)
        + "select * from id_counts where schema_id not in (select content_id from registry)",
        "ambiguous_schema_ids": _with(RAW, REGISTRY)
        + """
select g.global_id as schema_id, g.subject as global_subject, c.subject as content_subject,
       coalesce(records, 0) as records
from (select distinct global_id, subject from registry where content_id <> global_id) g
join (select distinct content_id, subject from registry) c on g.global_id = c.content_id
left join id_counts on schema_id = g.global_id""",
        "schema_compat_diff": _with(REGISTRY)
        + """
select coalesce(n.subject, o.subject) as subject, 1 as old_version, 2 as version,
       coalesce(n.field, o.field) as field,
       case when o.field is null then 'backward' else 'forward' end as direction
from (select * from registry where version = 2) n
full outer join (select * from registry where version = 1) o
  on n.subject = o.subject and n.field = o.field
where (o.field is null and not n.has_default) or (n.field is null and not o.has_default)""",
        "metric_normalise": _metric_normalise(),
        "gauge_latest": _with(URP)
        + """
select instance, time_bucket(interval '15 seconds', ts, timestamp '1970-01-01') as step,
       arg_max(value, ts) as value
from samples group by all""",
        "latency_p99": """
select (['Produce', 'Fetch', 'FetchFollower', 'Metadata'])[user_id % 4 + 1] as request,
       'kafka-' || (user_id % 3 + 1) as instance, ts, value
from events where event_id % 3 = 2 and user_id % 4 in (0, 1)""",
        "counter_rate": _with(MESSAGES)
        + """
, steps as (
  select *, lag(value) over (partition by instance order by ts) as previous from samples)
select time_bucket(interval '1 minute', ts, timestamp '1970-01-01') as window_start,
       sum(case when value >= previous then value - previous else value end) / 60 as per_second
from steps where previous is not null group by all""",
        "relative_drop": _with(IDLE)
        + """
select instance, ts, value, round(of_mean, 9) as of_mean from (
  select *, value / avg(value) over (partition by instance order by ts
              range between interval '1 hour' preceding and current row) as of_mean
  from samples)
where of_mean < 0.5""",
        "outage_episodes": _with(URP)
        + """
, held as (
  select instance, ts, max(value) as value from samples group by all),
places as (
  select p.ts, i.instance from (select distinct ts from held) p, (select distinct instance from held) i),
filled as (
  select p.ts, s.value from places p asof join held s on p.instance = s.instance and p.ts >= s.ts
  where s.ts + interval '5 minutes' > p.ts),
series as (
  select 'instance' as scope, instance, ts, value from samples
  union all
  select 'cluster', null, ts, sum(value) from filled group by ts),
marked as (
  select *, count(*) filter (value = 0) over (partition by scope, instance order by ts
              rows between unbounded preceding and 1 preceding) as zeros
  from series)
select scope, instance, min(ts) filter (value <> 0) as started_at,
       max(ts) filter (value <> 0) as last_seen_at, min(ts) filter (value = 0) as recovered_at,
       max(value) filter (value <> 0) as peak, count(*) filter (value <> 0) as samples
from marked group by scope, instance, zeros having count(*) filter (value <> 0) > 0""",
        "consumer_lag": """
with ends as (
  select event_type as topic, user_id % 6 as p, arg_max(event_id, ts) as end_offset
  from events group by all),
reached as (
  select 'group-' || (event_id % 4) as "group", event_type as topic, user_id % 6 as p,
         arg_max(event_id - user_id % 100, ts) as committed
  from events group by all)
select "group", topic, max(end_offset - committed) as max_lag,
       cast(sum(end_offset - committed) as bigint) as total_lag
from reached join ends using (topic, p) group by all""",
        "stream_orders_per_window": _with(ORDERS, BASE, a1) + "select * from a1",
        "stream_watermark_windows": _with(ORDERS, BASE, a1) + "select * from a1",
        "stream_final_windows": _with(ORDERS, BASE, a1)
        + """
select * from a1 where window_end <= (select max("timestamp") from f_orders)""",
        "stream_strict_no_grace": _with(ORDERS, BASE, STRICT)
        + """
select key, partition, order_id, amount_cents, arrival, "timestamp" from timed
where window_end > stream_time""",
        "stream_enrich_asof": _with(ORDERS, HISTORY, ASOF)
        + f"select {ENRICHED_COLUMNS} from matched o",
        "stream_enrich_current": _with(ORDERS, HISTORY)
        + f"""
select {ENRICHED_COLUMNS}
from (select *, "offset" * 8 // ((select max("offset") from f_orders) + 1) as nth from f_orders) o
left join (
  select key, i, arg_max(struct_pack(t := tier), "offset").t as tier
  from versions v join range(8) r(i) on v."offset" // 10000000 <= i
  group by key, i) l on o.key = l.key and o.nth = l.i""",
        "stream_window_changelog": _with(ORDERS, BASE, _changelog()) + "select * from changelog",
        "stream_validate_windows": _with(ORDERS, BASE, _changelog("4242"), WINDOW_CHECKS)
        + "select * from window_checks",
        "stream_validate_orders": _with(ORDERS, REPEATED, ORDER_CHECKS)
        + "select * from order_checks",
        "stream_dedup": _with(ORDERS) + "select key, order_id, amount_cents, currency from f_orders",
        "stream_dead_letter": _with(ORDERS, HISTORY, LATEST)
        + """
select key, order_id, "offset", 'no profile' as reason from f_orders
where key not in (select key from latest)""",
    }
