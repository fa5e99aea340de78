"""The catalogue's queries as plain SQL, for checking against another engine."""

from __future__ import annotations

# Each step is one common table expression; a query takes the steps up to the
# one it reads from.

RECORDS = """
numbered as (
  select e.*, unnest(case when event_id % 50 = 0 then [0, 1] else [0] end) as copy from events e),
kinds as (
  select *,
    case event_type when 'click' then 'voice' when 'view' then 'voice' when 'purchase' then 'data'
      when 'signup' then 'sms' when 'error' then 'fax' end as record_type,
    '2126' || lpad(cast(user_id as varchar), 8, '0') as party,
    case when event_id % 89 = 0 then -cast(floor(value * 5) as integer)
      else cast(floor(value * 5) as integer) end as seconds
  from numbered),
cdr as (
  select record_type,
    date_trunc('second', ts) as "timestamp",
    case when record_type in ('voice', 'fax') then party end as caller_id,
    case when record_type in ('voice', 'fax') then '212600000000' end as callee_id,
    case when record_type = 'sms' then party end as sender_id,
    case when record_type = 'sms' then '212600000000' end as receiver_id,
    case when record_type = 'data' then party end as user_id,
    case when record_type in ('voice', 'fax') then seconds end as duration_sec,
    case when record_type = 'data' then seconds end as session_duration_sec,
    case when record_type = 'data'
      then cast(cast(round(value * 20, 2) as decimal(10, 2)) as double) end as data_volume_mb,
    case when event_id % 97 <> 0 then 'CELL_' || cast(event_id % 50 + 1 as varchar) end as cell_id,
    case when record_type = 'fax' then 'INVALID_TECH'
      else (['2G', '3G', '4G', '5G', 'LTE'])[event_id % 5 + 1] end as technology,
    event_id
  from kinds)"""

FLAGGED = """
checked as (
  select *,
    coalesce(record_type in ('voice', 'sms', 'data'), false) as service_known,
    coalesce(technology in ('2G', '3G', '4G', '5G', 'LTE'), false) as technology_known
  from cdr),
reasoned as (
  select *,
    concat_ws(',',
      case when not service_known then 'service_unknown' end,
      case when "timestamp" is null then 'timestamp_missing' end,
      case when cell_id is null then 'cell_missing' end,
      case when technology is null then 'technology_missing' end,
      case when not technology_known then 'technology_unknown' end,
      case when record_type = 'voice' and caller_id is null then 'caller_missing' end,
      case when record_type = 'voice' and callee_id is null then 'callee_missing' end,
      case when record_type = 'voice' and not coalesce(duration_sec > 0, false)
        then 'duration_not_positive' end,
      case when record_type = 'sms' and sender_id is null then 'sender_missing' end,
      case when record_type = 'sms' and receiver_id is null then 'receiver_missing' end,
      case when record_type = 'data' and user_id is null then 'user_missing' end,
      case when record_type = 'data' and not coalesce(data_volume_mb > 0, false)
        then 'volume_not_positive' end,
      case when record_type = 'data' and not coalesce(session_duration_sec > 0, false)
        then 'session_not_positive' end) as reasons
  from checked),
flagged as (select *, reasons = '' as is_valid from reasoned)"""

PRICE = """
    case
      when record_type = 'voice' then case when duration_sec > 0 then
        cast(duration_sec * (case when extract(hour from event_time) between 8 and 11
          or extract(hour from event_time) between 17 and 19 then 0.015 else 0.010 end)
          as decimal(10, 4)) else 0 end
      when record_type = 'sms' then 0.05
      when record_type = 'data' then case when data_volume_mb > 0 then
        cast(cast(data_volume_mb as decimal(14, 6)) * (case technology
          when '3G' then case when data_volume_mb > 1000 then 0.0680 else 0.0800 end
          when '4G' then case when data_volume_mb > 1000 then 0.0850 else 0.1000 end
          when '5G' then case when data_volume_mb > 1000 then 0.1020 else 0.1200 end
          when 'LTE' then case when data_volume_mb > 1000 then 0.0765 else 0.0900 end
        end) as decimal(10, 4)) else 0 end
      else 0
    end"""


def digest(*parts: str) -> str:
    framed = " || ".join(f"coalesce(cast(length({p}) as varchar) || ':' || {p}, '-')" for p in parts)
    return f"md5({framed})"


EVENT_KEY = digest(
    "record_type", "user_identifier", "cast(epoch_us(event_time) as varchar)", "cell_id"
)


def usage(name: str, source: str, condition: str) -> str:
    return f"""
{name} as (
  select record_type, "timestamp" as event_time,
    coalesce(caller_id, sender_id, user_id) as user_identifier,
    cell_id, technology, duration_sec, data_volume_mb
  from {source} where {condition})"""


def priced(name: str, source: str) -> str:
    return f"""
{name}_cost as (select *, cast({PRICE} as decimal(10, 4)) as cost from {source}),
{name} as (
  select record_type, event_time, user_identifier, cell_id, technology, cost, duration_sec,
    data_volume_mb, case when cost > 0 or (cost = 0 and record_type = 'data'
      and data_volume_mb > 0) then 'rated' else 'unrated' end as rating_status
  from {name}_cost)"""


UNIQUE_USAGE = f"""{usage("all_usage", "flagged", "is_valid")},
unique_usage as (
  select * from all_usage
  qualify row_number() over (
    partition by event_time, user_identifier, cell_id, record_type
    order by technology nulls first, duration_sec nulls first, data_volume_mb nulls first) = 1)"""

CLAMPED = """
    greatest(coalesce(duration_sec, 0), 0) as duration_sec,
    cast(greatest(coalesce(data_volume_mb, 0), 0) as decimal(10, 2)) as data_volume_mb"""

RATED = f"""{UNIQUE_USAGE},{priced("priced", "unique_usage")},
rated as (
  select {EVENT_KEY} as event_id, record_type, event_time, user_identifier, cell_id, technology,
    cost, {CLAMPED}, rating_status
  from priced where cell_id is not null and user_identifier is not null and cost >= 0)"""

MONTHLY = """
monthly as (
  select user_identifier, cast(year(event_time) as integer) as billing_year,
    cast(month(event_time) as integer) as billing_month, record_type,
    cast(sum(duration_sec) as bigint) as total_duration_sec,
    cast(sum(data_volume_mb) as decimal(20, 2)) as total_data_mb,
    cast(sum(cost) as decimal(20, 4)) as total_cost,
    count(*) as event_count
  from rated where rating_status = 'rated' group by all)"""

ADJUSTED = """
adjusted as (
  select *,
    case when record_type = 'voice' and total_duration_sec <= 6000 then cast(0 as double)
      when record_type = 'voice' and total_duration_sec > 6000
        then cast(total_duration_sec - 6000 as double) * cast(0.01 as double) / cast(60 as double)
      else cast(total_cost as double) end as adjusted_cost
  from monthly)"""


def bills(reduced: str) -> str:
    """Bills are rounded by their decimal text, as a cast to decimal does it:
    rounding the binary number moves values just below a half cent up."""
    return f"""
reduced as (
  select *, adjusted_cost * cast(0.9 as double) - cast(20 as double) as full_reduction
  from adjusted),
discounted as (select *, {reduced} as discounted_cost from reduced),
summary as (
  select user_identifier as customer_id, billing_year, billing_month, record_type as service,
    event_count, total_cost, adjusted_cost, discounted_cost,
    cast(round(cast(cast(discounted_cost * cast(1.2 as double) as varchar) as decimal(38, 20)), 2)
      as decimal(18, 2)) as final_cost
  from discounted)"""


BILLS = bills("full_reduction")
BILLS_FLOORED = bills("greatest(full_reduction, cast(0 as double))")

INVOICES = f"""
totals as (
  select user_identifier as user_id, cast(date_trunc('month', event_time) as date) as first_day,
    cast(sum(cost) as decimal(20, 4)) as total_cost
  from rated group by all),
invoices as (
  select {digest("user_id", "cast(first_day as varchar)")} as invoice_id, user_id,
    first_day as billing_period_start, last_day(first_day) as billing_period_end, total_cost,
    false as paid
  from totals)"""

INVOICE_OF_EVENT = digest(
    "user_identifier", "cast(cast(date_trunc('month', event_time) as date) as varchar)"
)
ITEMS = f"""
items as (select {INVOICE_OF_EVENT} as invoice_id, event_id from rated)"""

WIRE_COLUMNS = (
    'record_type, "timestamp", caller_id, callee_id, sender_id, receiver_id, user_id, '
    "duration_sec, session_duration_sec, data_volume_mb, cell_id, technology"
)
SUMMARY_COLUMNS = (
    "customer_id, billing_year, billing_month, service, event_count, total_cost, adjusted_cost, "
    "discounted_cost, final_cost"
)
SUBSCRIBER_KEY = (
    '"timestamp", coalesce(caller_id, sender_id, user_id) as subscriber, cell_id, record_type'
)

DOCUMENTS = """
  select customer_id,
    cast(billing_year as varchar) || '-' || lpad(cast(billing_month as varchar), 2, '0')
      as billing_period,
    service, event_count as total_events, cast(final_cost as double) as "final_cost_MAD",
    cast(total_cost as double) as original_cost, adjusted_cost, discounted_cost
  from summary"""


def steps(*parts: str) -> str:
    return "with " + ",".join(part.rstrip() for part in parts)


TO_RATED = (RECORDS, FLAGGED, RATED)
TO_SUMMARY = (*TO_RATED, MONTHLY, ADJUSTED, BILLS)


def constraint_lines(table: str, source: str, rules: dict[str, str], key: str) -> list[str]:
    lines = [
        f"select '{table}' as table_name, '{rule}' as rule, "
        f"count(*) filter (where {broken}) as violations from {source}"
        for rule, broken in rules.items()
    ]
    lines.append(
        f"select '{table}', 'primary key unique', "
        f"count(*) - (select count(*) from (select distinct {key} from {source})) from {source}"
    )
    return lines


def not_null(*columns: str) -> dict[str, str]:
    return {f"{c} not null": f"{c} is null" for c in columns}


EVENT_RULES = {
    **not_null(
        "event_id",
        "record_type",
        "event_time",
        "user_identifier",
        "cell_id",
        "technology",
        "cost",
    ),
    "record_type at most 10 characters": "length(record_type) > 10",
    "user_identifier at most 15 characters": "length(user_identifier) > 15",
    "cell_id at most 50 characters": "length(cell_id) > 50",
    "technology at most 5 characters": "length(technology) > 5",
    "record_type in service list": "record_type not in ('voice', 'sms', 'data')",
    "cost not negative": "cost < 0",
    "data_volume_mb fits its column": "abs(data_volume_mb) >= 99999999.995",
}
INVOICE_RULES = {
    **not_null(
        "invoice_id",
        "user_id",
        "billing_period_start",
        "billing_period_end",
        "total_cost",
        "paid",
    ),
    "user_id at most 15 characters": "length(user_id) > 15",
    "total_cost not negative": "total_cost < 0",
    "total_cost fits its column": "abs(total_cost) > 999999.9999",
}


def union(lines: list[str]) -> str:
    return "\nunion all ".join(lines)


def referential(items: str) -> str:
    return f"""
select 'invoice' as reference, count(distinct invoice_id) as missing_keys, count(*) as orphan_items
  from {items} where invoice_id not in (select invoice_id from invoices)
union all select 'event', count(distinct event_id), count(*)
  from {items} where event_id not in (select event_id from rated)"""


RUNNING = """
arrivals as (
  select coalesce(caller_id, sender_id, user_id) as subscriber, "timestamp" < max("timestamp") over (
    partition by coalesce(caller_id, sender_id, user_id) order by event_id
    rows between unbounded preceding and current row) as late
  from cdr where coalesce(caller_id, sender_id, user_id) is not null and "timestamp" is not null)"""

DELIVERED = """
delivered as (
  select f.*, cast(floor((day(e.ts) - 1) / 8) as integer)
      + case when f.event_id % 10 = 0 then 1 else 0 end as delivery
  from flagged f join events e using (event_id)),
highest as (
  select n.delivery, (select max("timestamp") from delivered d
    where d.is_valid and d.delivery < n.delivery) as seen
  from (select distinct delivery from delivered) n)"""

# Call durations take turns in being badly typed; every eleventh line is no JSON.
DAMAGED = RECORDS.replace("cdr as (", "whole as (") + """,
cdr as (
  select * replace (
      case event_id % 5 when 0 then if(duration_sec is null, null, 60) end as duration_sec),
    duration_sec is not null and event_id % 5 in (1, 2, 3) as wrong_type
  from whole where event_id % 11 <> 0
  union all by name
  select cast(null as varchar) as record_type, cast(null as timestamp) as "timestamp",
    event_id, false as wrong_type
  from whole where event_id % 11 = 0)"""


def anomalies(corrupt: str) -> str:
    return f"""
select 'missing_field' as anomaly, count(*) filter (where
    record_type is null or "timestamp" is null or cell_id is null or technology is null
    or (record_type = 'voice' and (caller_id is null or callee_id is null
      or (duration_sec is null and not {corrupt})))
    or (record_type = 'sms' and (sender_id is null or receiver_id is null))
    or (record_type = 'data' and (user_id is null or data_volume_mb is null
      or session_duration_sec is null))) as records from cdr
union all select 'corrupt_value', count(*) filter (where duration_sec < 0
    or session_duration_sec < 0 or data_volume_mb < 0 or {corrupt} or 'INVALID' in
    (caller_id, callee_id, sender_id, receiver_id, user_id, cell_id, technology)) from cdr
union all select 'invalid_service', count(*) filter (where
    record_type not in ('voice', 'sms', 'data')) from cdr
union all select 'duplicate', count(*) - (select count(*) from (
    select distinct {SUBSCRIBER_KEY} from cdr)) from cdr
union all select 'out_of_order', count(*) filter (where late) from arrivals"""


SQL: dict[str, str] = {
    "cdr_from_events": f"{steps(RECORDS)} select * from cdr",
    "cdr_json_roundtrip": f"{steps(RECORDS)} select {WIRE_COLUMNS} from cdr",
    "cdr_validated": f"""{steps(RECORDS, FLAGGED)}
select event_id, record_type, is_valid, reasons from flagged""",
    "cdr_validated_per_service": f"""{steps(RECORDS, FLAGGED)},
strict as (
  select *, is_valid and case record_type
    when 'voice' then technology in ('2G', '3G', '4G', '5G')
    when 'sms' then technology in ('2G', '3G', '4G')
    when 'data' then technology in ('3G', '4G', '5G', 'LTE') end as accepted
  from flagged)
select record_type, technology, count(*) filter (where accepted) as valid,
  count(*) filter (where accepted is not true) as rejected
from strict group by all""",
    "cdr_clean": f"""{steps(RECORDS, FLAGGED)}
select {WIRE_COLUMNS} from flagged where is_valid
qualify row_number() over (
  partition by "timestamp", coalesce(caller_id, sender_id, user_id), cell_id, record_type
  order by caller_id nulls first, callee_id nulls first, sender_id nulls first,
    receiver_id nulls first, user_id nulls first, duration_sec nulls first,
    session_duration_sec nulls first, data_volume_mb nulls first, technology nulls first) = 1""",
    "cdr_dead_letter": f"""{steps(RECORDS, FLAGGED)}
select {WIRE_COLUMNS}, is_valid, reasons from flagged where not is_valid""",
    "reject_reasons": f"""{steps(RECORDS, FLAGGED)}
select record_type, reason, count(*) as records
from (select record_type, unnest(string_split(reasons, ',')) as reason
  from flagged where not is_valid)
group by all""",
    "event_time_formats": """
select event_id, case event_id % 7
  when 0 then date_trunc('millisecond', ts)
  when 1 then date_trunc('second', ts)
  when 2 then date_trunc('second', ts)
  when 3 then cast(cast(ts as date) as timestamp) end as parsed
from events""",
    "json_wrong_types": f"""{steps(DAMAGED, FLAGGED)}
select {WIRE_COLUMNS}, is_valid, wrong_type from flagged""",
    "dedup_subscriber_key": f"""{steps(RECORDS, FLAGGED)}
select distinct {SUBSCRIBER_KEY} from flagged where is_valid""",
    "dedup_caller_key": f"""{steps(RECORDS, FLAGGED)}
select distinct "timestamp", caller_id, record_type from flagged where is_valid""",
    "repeated_records": f"""{steps(RECORDS, FLAGGED)}
select {SUBSCRIBER_KEY}, count(*) - 1 as surplus from flagged where is_valid
group by all having count(*) > 1""",
    "rated_events": f"{steps(*TO_RATED)} select * from rated",
    "rated_via_rate_card": f"{steps(*TO_RATED)} select * from rated",
    "rating_status_counts": f"""{steps(*TO_RATED)}
select record_type, rating_status, count(*) as events,
  cast(sum(cost) as decimal(20, 4)) as total_cost
from priced group by all""",
    "load_report": f"""{steps(RECORDS, usage("use", "cdr", "true"), priced("unchecked", "use"))}
select count(*) as read_rows,
  count(*) filter (where cell_id is not null and user_identifier is not null and cost >= 0)
    as loaded_rows,
  count(*) filter (where cell_id is null) as without_cell,
  count(*) filter (where user_identifier is null) as without_subscriber,
  count(*) filter (where cost is null) as without_price,
  count(*) filter (where cost < 0) as negative_cost,
  count(*) filter (where abs(data_volume_mb) >= 99999999.995) as volume_too_wide
from unchecked""",
    "filled_and_clamped": f"""
{steps(RECORDS, usage("use", "cdr", "true"), priced("unchecked", "use"))}
select record_type, event_time, user_identifier, cell_id, technology, cost, {CLAMPED}, rating_status
from unchecked""",
    "voice_peak_split": f"""{steps(*TO_RATED)}
select extract(hour from event_time) between 8 and 11
    or extract(hour from event_time) between 17 and 19 as peak,
  count(*) as events, cast(sum(duration_sec) as bigint) as seconds,
  cast(sum(cost) as decimal(20, 4)) as total_cost
from rated where record_type = 'voice' group by all""",
    "volume_discount_effect": f"""{steps(*TO_RATED)}
select technology, data_volume_mb > 1000 as discounted, count(*) as events,
  cast(sum(data_volume_mb) as decimal(20, 2)) as megabytes,
  cast(sum(cost) as decimal(20, 4)) as total_cost
from rated where record_type = 'data' group by all""",
    "service_pivot": f"""{steps(*TO_RATED)}
select user_identifier,
  cast(sum(cost) filter (where record_type = 'voice') as decimal(20, 4)) as voice_cost,
  cast(sum(cost) filter (where record_type = 'sms') as decimal(20, 4)) as sms_cost,
  cast(sum(cost) filter (where record_type = 'data') as decimal(20, 4)) as data_cost,
  cast(sum(cost) as decimal(20, 4)) as total_cost, date '2024-02-01' as invoice_date
from rated group by all""",
    "monthly_usage": f"{steps(*TO_RATED, MONTHLY)} select * from monthly",
    "adjusted_cost": f"{steps(*TO_RATED, MONTHLY, ADJUSTED)} select * from adjusted",
    "billing_summary": f"{steps(*TO_SUMMARY)} select {SUMMARY_COLUMNS} from summary",
    "billing_summary_floored": f"""{steps(*TO_RATED, MONTHLY, ADJUSTED, BILLS_FLOORED)}
select {SUMMARY_COLUMNS} from summary""",
    "invoice_documents": f"{steps(*TO_SUMMARY)} {DOCUMENTS}",
    "invoice_header": f"{steps(*TO_RATED, INVOICES)} select * from invoices",
    "invoice_line_items": f"{steps(*TO_RATED, ITEMS)} select * from items",
    "invoice_line_items_joined": f"""{steps(*TO_RATED, INVOICES)}
select i.invoice_id, r.event_id from rated r join invoices i
  on i.user_id = r.user_identifier
  and i.billing_period_start = cast(date_trunc('month', r.event_time) as date)""",
    "constraint_report": f"""{steps(*TO_RATED, INVOICES, ITEMS)} {union([
        *constraint_lines("rated_events", "rated", EVENT_RULES, "event_id"),
        *constraint_lines("invoices", "invoices", INVOICE_RULES, "invoice_id"),
        *constraint_lines(
            "invoice_line_items", "items", not_null("invoice_id", "event_id"),
            "invoice_id, event_id"),
    ])}""",
    "constraint_report_unchecked": f"""
{steps(RECORDS, usage("use", "cdr", "true"), priced("unchecked", "use"),
       f" keyed as (select *, {EVENT_KEY} as event_id from unchecked)")}
{union(constraint_lines("rated_events", "keyed", EVENT_RULES, "event_id"))}""",
    "referential_check": f"{steps(*TO_RATED, INVOICES, ITEMS)} {referential('items')}",
    "referential_check_unloaded": f"""{steps(*TO_RATED, INVOICES,
        f" keyed as (select *, {EVENT_KEY} as event_id from priced)",
        f" all_items as (select {INVOICE_OF_EVENT} as invoice_id, event_id from keyed)")}
{referential("all_items")}""",
    "anomaly_report": f"{steps(RECORDS, RUNNING)} {anomalies('false')}",
    "anomaly_report_wire": f"{steps(DAMAGED, RUNNING)} {anomalies('wrong_type')}",
    "out_of_order_by_subscriber": f"""{steps(RECORDS, RUNNING)}
select subscriber, count(*) as records, count(*) filter (where late) as late_records
from arrivals group by all""",
    "stream_mediation_dead_letter": f"""{steps(RECORDS, FLAGGED)}
select {WIRE_COLUMNS}, reasons, true as raw_says_the_same from flagged where not is_valid""",
    "stream_mediation_both": f"""{steps(RECORDS, FLAGGED)}
select record_type, 'clean' as output, count(distinct ({SUBSCRIBER_KEY.replace(" as subscriber", "")}))
  as records from flagged where is_valid group by all
union all select record_type, 'dead letter', count(*) from flagged where not is_valid group by all""",
    "stream_late_rows": f"""{steps(RECORDS, FLAGGED, DELIVERED)}
select delivery, count(*) filter (where is_valid and "timestamp" <= seen - interval 5 minute)
  as late_rows
from delivered join highest using (delivery) group by all""",
    "tiny_volumes": f"""{steps(RECORDS)},
tiny as (
  select technology, cast(data_volume_mb / 2e6 as decimal(20, 10)) as volume from cdr
  where record_type = 'data'),
costs as (
  select technology, volume,
    case when volume > 0 then cast(volume * (case technology when '3G' then 0.0800
      when '4G' then 0.1000 when '5G' then 0.1200 when 'LTE' then 0.0900 end) as decimal(10, 4))
    else 0 end as cost
  from tiny)
select technology, case when cost is not null and volume > 0 then 'rated' else 'unrated' end
    as rating_status,
  count(*) as events, count(*) filter (where cost = 0) as shown_as_zero
from costs group by all""",
    "single_pass_late_data": f"""{steps(RECORDS, FLAGGED, DELIVERED)}
select distinct {WIRE_COLUMNS}, 'clean' as output from delivered join highest using (delivery)
where is_valid and (seen is null or "timestamp" > seen - interval 5 minute)
union all
select {WIRE_COLUMNS}, 'late' from delivered join highest using (delivery)
where is_valid and "timestamp" <= seen - interval 5 minute""",
    "stream_late_data": f"""{steps(RECORDS, FLAGGED, DELIVERED)}
select distinct {SUBSCRIBER_KEY} from delivered join highest using (delivery)
where is_valid and (seen is null or "timestamp" > seen - interval 5 minute)""",
}

SQL |= {
    "quality_ledger": f"""
{steps(RECORDS, usage("use", "cdr", "true"), priced("unchecked", "use"),
       f" keyed as (select *, {EVENT_KEY} as event_id from unchecked)")}
select table_name, rule, violations from (
{union(constraint_lines("rated_events", "keyed", EVENT_RULES, "event_id"))})
where rule <> 'primary key unique'""",
    "lost_by_delay": f"""{steps(RECORDS, FLAGGED, DELIVERED)},
tops as (select record_type, delivery, max("timestamp") as top from delivered where is_valid group by all),
behind as (
  select d.record_type, d.delivery,
    epoch_us((select max(top) from tops t where t.record_type = d.record_type and t.delivery < d.delivery))
      - epoch_us(d."timestamp") as late_by
  from delivered d where d.is_valid)
select record_type, hours, count(*) as accepted,
  count(*) filter (where late_by >= hours * 3600000000) as lost, true as sketch_agrees
from behind, (values (1), (24), (96), (168)) as delays(hours) group by all""",
    "dated_rates": f"""{steps(RECORDS, FLAGGED)},
card(rate_key, valid_from, valid_to, price) as (values
  ('voice/peak', timestamp '2024-01-01', null, 0.0150),
  ('voice/base', timestamp '2024-01-01', timestamp '2024-01-11', 0.0100),
  ('voice/base', timestamp '2024-01-11', null, 0.0120),
  ('sms/flat', timestamp '2024-01-01', timestamp '2024-01-08', 0.0500),
  ('sms/flat', timestamp '2024-01-10', timestamp '2024-01-20 12:00:00', 0.0600),
  ('data/3G', timestamp '2024-01-05', null, 0.0800),
  ('data/4G', timestamp '2024-01-01', timestamp '2024-01-25', 0.1000),
  ('data/5G', timestamp '2024-01-01', null, 0.1200)),
keyed as (
  select "timestamp" as event_time, coalesce(caller_id, sender_id, user_id) as user_identifier,
    case record_type
      when 'voice' then case when extract(hour from "timestamp") between 8 and 11
        or extract(hour from "timestamp") between 17 and 19 then 'voice/peak' else 'voice/base' end
      when 'sms' then 'sms/flat' when 'data' then 'data/' || technology end as rate_key
  from flagged where is_valid)
select k.event_time, k.user_identifier, k.rate_key, c.valid_from, cast(c.price as decimal(10, 4)) as price
from keyed k left join card c on c.rate_key = k.rate_key and k.event_time >= c.valid_from
  and (c.valid_to is null or k.event_time < c.valid_to)""",
    "balanced_split": f"""{steps(*TO_RATED)} select count(*) as events, true as balanced from rated""",
    "service_pivot_today": SQL["service_pivot"].replace("date '2024-02-01' as invoice_date", "current_date as invoice_date"),
}

# Deliveries in the order of time leave nothing late, and a sink changes no values.
SQL |= {
    "stream_mediation_clean": SQL["cdr_clean"],
    "stream_rating": SQL["rated_events"],
    "stream_rating_update_mode": SQL["rated_events"],
    "stream_caller_key": SQL["dedup_caller_key"],
    "single_pass_both": SQL["stream_mediation_both"],
    "single_pass_after_resizing": SQL["stream_late_data"],
    "rated_via_shuffled_rate_card": SQL["filled_and_clamped"],
    "idempotent_period_write": f"""{steps(*TO_SUMMARY)}
select {SUMMARY_COLUMNS}, timestamp '2024-02-01 08:30:00' as generated_at from summary""",
    "incremental_rebilling": SQL["billing_summary"],
    "rebilling_replaced_batch": SQL["billing_summary"],
    "compacted_rated_events": SQL["rated_events"],
    "invoice_document_files": SQL["invoice_documents"],
}
