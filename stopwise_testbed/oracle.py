"""The same results in SQL over the test tables, for DuckDB."""

from __future__ import annotations

# Arrivals, stop lists and boroughs as in stopwise_testbed.roles.
ARRIVALS = """
with st as (
  select event_id as trip_id, user_id as stop_id,
         substr(cast(ts as varchar), 12, 8) as arrival_time,
         cast(substr(cast(ts as varchar), 12, 2) as int) as hour,
         event_type as route_id,
         case when value >= 50 then 1 else 0 end as direction_id
  from events),
stops as (
  select c_custkey as stop_id, c_name as stop_name, c_acctbal as stop_lat,
         cast(c_nationkey as double) as stop_lon, r_name as borough
  from customer join nation on c_nationkey = n_nationkey
  join region on n_regionkey = r_regionkey),
depots as (
  select s_suppkey as stop_id, s_name as stop_name, s_acctbal as stop_lat,
         cast(s_nationkey as double) as stop_lon, r_name as borough
  from supplier join nation on s_nationkey = n_nationkey
  join region on n_regionkey = r_regionkey),
routes as (
  select distinct event_type as route_id,
         concat('#', upper(substr(event_type, 1, 6))) as route_color
  from events where event_type <> 'error'),
arr as (
  select st.*, stops.borough, routes.route_color
  from st left join stops on st.stop_id = stops.stop_id
  left join routes on st.route_id = routes.route_id)
"""


def _kpi(hour: int, before: int, source: str) -> str:
    columns = []
    for name, short, value in [
        ("arrivals", "arrival", "count(case when hour = {h} then 1 end)"),
        ("routes", "route", "count(distinct case when hour = {h} then route_id end)"),
        ("stops", "stop", "count(distinct case when hour = {h} then stop_id end)"),
    ]:
        now, then = value.format(h=hour), value.format(h=before)
        columns.append(
            f"{now} as curr_{name}, {then} as prev_{name}, "
            f"case when {then} = 0 then 0.0e0 "
            f"else cast({now} - {then} as double) / {then} end as {short}_rate"
        )
    return f"select {', '.join(columns)} from {source}"


def _all_hours() -> str:
    columns = []
    for name, short in [("arrivals", "arrival"), ("routes", "route"), ("stops", "stop")]:
        now, then = f"coalesce(c.{name}, 0)", f"coalesce(p.{name}, 0)"
        columns.append(
            f"{now} as curr_{name}, {then} as prev_{name}, case when {then} = 0 then 0.0e0 "
            f"else cast({now} - {then} as double) / {then} end as {short}_rate"
        )
    return (
        ARRIVALS
        + ", h as (select hour, count(*) as arrivals, count(distinct route_id) as routes,"
        + " count(distinct stop_id) as stops from arr group by hour),"
        + " day as (select cast(range as int) as hour from range(24))"
        + f" select day.hour, {', '.join(columns)} from day left join h c on c.hour = day.hour"
        + " left join h p on p.hour = (day.hour + 23) % 24"
    )


def _kpi_lines() -> str:
    lines = []
    for label, name, short, text, suffix in [
        ("Total Arrivals", "arrivals", "arrival", "format('{:,}', curr_arrivals)", " vs last hour"),
        ("Active Routes", "routes", "route", "cast(curr_routes as varchar)", ""),
        ("Active Stops", "stops", "stop", "format('{:,}', curr_stops)", ""),
    ]:
        rate = f"{short}_rate"
        lines.append(
            f"select '{label}' as metric, curr_{name} as current_value, "
            f"prev_{name} as previous_value, {rate} as rate, "
            f"case when {rate} >= 0 then 'increase' else 'decrease' end as direction, "
            f"{text} as value_text, concat(case when {rate} < 0 then '-' else '+' end, "
            f"cast(cast(round_even(abs({rate} * 100), 0) as bigint) as varchar), "
            f"'%{suffix}') as caption from k"
        )
    return ARRIVALS + f", k as ({_kpi(8, 7, 'arr')}) " + " union all ".join(lines)


_MAP_PLACE = "s.stop_name, s.stop_lat, s.stop_lon"

_SILVER = """select event_type, count(*) as n from events
  where event_type <> 'error' group by event_type"""

_FEED_STOP_TIMES = """
  select cast(trip_id as varchar) as trip_id, cast(st.stop_id as varchar) as stop_id,
         arrival_time, hour, borough
  from st join stops on st.stop_id = stops.stop_id"""

ORACLE: dict[str, str] = {
    "bronze_silver": _SILVER,
    "bronze_silver_stream": _SILVER,
    "json_ingest": "select event_id, user_id, event_type, value, props from events",
    "table_roundtrip": "select * from orders",
    "append_write": "select * from orders union all select * from orders",
    "partitioned_write": "select * from orders",
    "schema_replace_write": "select o_orderkey, o_totalprice as price from orders",
    "raw_landing": """
        select event_id, user_id, event_type, event_type <> 'error' as is_assigned
        from events""",
    "schema_evolution_append": """
        select o_orderkey, o_orderstatus, cast(null as varchar) as o_orderpriority
        from orders where o_orderstatus = 'F'
        union all
        select o_orderkey, cast(null as varchar) as o_orderstatus, o_orderpriority
        from orders where o_orderstatus <> 'F'""",
    "schema_evolution_overwrite": """
        select o_orderkey, cast(null as varchar) as o_orderstatus, o_orderpriority
        from orders where o_orderstatus <> 'F'""",
    "self_overwrite": "select * replace (o_totalprice * 2 as o_totalprice) from orders",
    "temp_view_sql": "select * from orders",
    "preview_limit": "select o_orderkey from orders order by o_orderkey limit 1000",
    "csv_scan": "select o_orderkey, o_orderstatus, o_totalprice from orders",
    "expect_or_drop": "select * from orders where o_orderstatus = 'F'",
    "expect_all": """
        select o_orderkey, (not (o_totalprice between 1000 and 400000)
          or not (o_orderstatus <> 'P')) as is_quarantined from orders""",
    "expect_all_null": """
        select o_orderkey, (not (nullif(o_orderstatus, 'P') <> 'F')
          or not (o_totalprice > 100000)) as is_quarantined from orders""",
    "expect_all_strict": """
        select o_orderkey, (not coalesce(nullif(o_orderstatus, 'P') <> 'F', false)
          or not (o_totalprice > 100000)) as is_quarantined from orders""",
    "expect_or_fail_count": """
        select count(*) as failing from lineitem where not (l_quantity > 10)""",
    "expect_or_fail_pass": "select * from lineitem",
    "expectation_report": """
        with checked as (
          select 'finished' as name, nullif(o_orderstatus, 'P') = 'F' as ok from orders
          union all select 'price' as name, o_totalprice > 100000 as ok from orders)
        select name, count(case when ok then 1 end) as passed,
               count(case when not ok then 1 end) as failed,
               count(case when ok is null then 1 end) as unknown
        from checked group by name""",
    "decorator_order": """
        select 'view outermost' as view, count(*) as n_rows from orders
          where o_orderstatus = 'F'
        union all select 'view innermost' as view, count(*) as n_rows from orders""",
    "arrival_hour": ARRIVALS + "select trip_id, hour from st",
    "route_color": """
        select c_custkey, concat('#', trim(concat(' ', c_mktsegment, ' '))) as route_color
        from customer""",
    "hour_labels": ARRIVALS
    + """, day as (select cast(range as int) as hour from range(24))
        select day.hour, concat(lpad(cast(day.hour as varchar), 2, '0'), ':00 - ',
            lpad(cast(day.hour + 1 as varchar), 2, '0'), ':00') as label,
          count(st.trip_id) as arrivals
        from day left join st on st.hour = day.hour group by day.hour""",
    "trip_left_join": """
        select l_orderkey, l_linenumber, o.o_orderstatus from lineitem
        left join (select * from orders where o_orderstatus <> 'P') o
        on l_orderkey = o.o_orderkey""",
    "trip_inner_join": """
        select l_orderkey, l_linenumber, o.o_orderstatus from lineitem
        join (select * from orders where o_orderstatus <> 'P') o
        on l_orderkey = o.o_orderkey""",
    "route_color_join": """
        select c_custkey, c_nationkey as route_id, n.n_name as route_color from customer
        left join (select * from nation where n_regionkey <> 0) n
        on c_nationkey = n.n_nationkey""",
    "fanout_join": ARRIVALS
    + """select a.stop_id, a.borough, a.arrivals, s.stop_name
        from (select stop_id, borough, count(*) as arrivals from arr group by 1, 2) a
        join (select * from stops union all select * from depots) s on a.stop_id = s.stop_id""",
    "fanout_join_tagged": ARRIVALS
    + """select a.stop_id, a.borough, a.arrivals, s.stop_name
        from (select stop_id, borough, count(*) as arrivals from arr group by 1, 2) a
        join (select * from stops union all select * from depots) s
        on a.stop_id = s.stop_id and a.borough = s.borough""",
    "subway_arrivals": ARRIVALS
    + """select cast(trip_id as varchar) as trip_id, cast(stop_id as varchar) as stop_id,
          arrival_time,
          case when st.route_id <> 'signup' then st.route_id end as route_id,
          case when st.route_id <> 'signup' then direction_id end as direction_id,
          case when st.route_id <> 'signup' then concat('S-', st.route_id) end as shape_id,
          case when st.route_id <> 'signup' then route_color end as route_color, hour
        from st left join routes on st.route_id = routes.route_id""",
    "feed_union": ARRIVALS
    + f""", tr as (
          select cast(event_id as varchar) as trip_id,
                 regexp_extract(props, '[0-9]+') as route_id
          from events where value >= 1)
        select f.*, tr.route_id from ({_FEED_STOP_TIMES}) f join tr on f.trip_id = tr.trip_id""",
    "feed_union_stops": ARRIVALS
    + """select cast(stop_id as varchar) as stop_id, stop_name, stop_lat, stop_lon, borough
        from stops""",
    "route_summary": ARRIVALS
    + """select route_id, count(trip_id) as total_arrivals,
          count(distinct stop_id) as unique_stops, count(distinct direction_id) as directions
        from arr where route_id in ('click', 'view') group by route_id""",
    "borough_summary": ARRIVALS
    + """select borough, count(trip_id) as total_arrivals,
          count(distinct route_id) as unique_routes, count(distinct stop_id) as unique_stops
        from arr where borough in ('ASIA', 'EUROPE') group by borough""",
    "hourly_trend": ARRIVALS
    + "select hour, route_id, count(*) as arrivals from arr group by hour, route_id",
    "hourly_trend_borough": ARRIVALS
    + """select hour, borough, count(*) as arrivals from arr
        where borough is not null group by hour, borough""",
    "empty_selection": ARRIVALS
    + """select route_id, count(trip_id) as total_arrivals,
          count(distinct stop_id) as unique_stops, count(distinct direction_id) as directions
        from arr where 1 = 0 group by route_id""",
    "stop_density": ARRIVALS
    + f"""select d.*, {_MAP_PLACE} from
        (select stop_id, route_id, route_color, count(*) as stop_count from arr
         where hour = 8 and route_color is not null group by 1, 2, 3) d
        left join depots s on d.stop_id = s.stop_id""",
    "stop_density_borough": ARRIVALS
    + f"""select d.*, {_MAP_PLACE} from
        (select stop_id, borough, route_id, count(*) as stop_count from arr
         where hour = 8 and borough in ('ASIA', 'EUROPE') group by 1, 2, 3) d
        join depots s on d.stop_id = s.stop_id""",
    "city_map": ARRIVALS
    + f"""select d.*, {_MAP_PLACE} from
        (select stop_id, route_id, route_color, count(*) as stop_count from arr
         where hour = 8 and route_color is not null group by 1, 2, 3) d
        left join stops s on d.stop_id = s.stop_id
        order by md5(concat_ws('-', cast(d.stop_id as varchar), route_id, route_color, '42')),
          d.stop_id, route_id limit 100""",
    "city_map_borough": ARRIVALS
    + f"""select d.*, {_MAP_PLACE} from
        (select stop_id, borough, route_id, count(*) as stop_count from arr
         where hour = 8 and borough is not null group by 1, 2, 3) d
        join stops s on d.stop_id = s.stop_id
        order by md5(concat_ws('-', cast(d.stop_id as varchar), d.borough, route_id, '42')),
          d.stop_id, route_id limit 100""",
    "top_stops": ARRIVALS
    + """select a.stop_id, arrivals, stop_name from
        (select stop_id, count(*) as arrivals from arr where hour = 8 group by stop_id) a
        left join depots s on a.stop_id = s.stop_id
        order by arrivals desc, a.stop_id, stop_name limit 10""",
    "top_stops_borough": ARRIVALS
    + """select a.stop_id, a.borough, arrivals, stop_name from
        (select stop_id, borough, count(*) as arrivals from arr
         where hour = 8 and borough is not null group by 1, 2) a
        join (select * from stops union all select * from depots) s on a.stop_id = s.stop_id
        order by arrivals desc, a.stop_id, a.borough, stop_name limit 10""",
    "map_sample": """
        select l_orderkey, l_linenumber, l_partkey from lineitem
        order by md5(concat_ws('-', cast(l_orderkey as varchar), cast(l_linenumber as varchar),
          cast(l_partkey as varchar), '42')), l_orderkey, l_linenumber, l_partkey limit 12000""",
    "hour_kpi": ARRIVALS + _kpi(8, 7, "arr"),
    "hour_kpi_wrap": ARRIVALS
    + _kpi(0, 23, "(select * from arr where route_id in ('click', 'view')) x"),
    "hour_kpi_borough": ARRIVALS
    + _kpi(8, 7, "(select * from arr where borough in ('ASIA', 'EUROPE')) x"),
    "hour_kpi_all": _all_hours(),
    "kpi_table": _kpi_lines(),
    "distinct_routes": """
        select distinct event_type as route_id from events
        where event_type is not null order by 1""",
    "selection_status": """
        select string_agg(event_type, ', ' order by event_type) as value_text,
          concat('Analyzing ', cast(count(*) as varchar), ' subway routes') as caption
        from (select distinct event_type from events) x""",
}

ORACLE["expect_or_fail_many"] = "select * from lineitem"
ORACLE["checked_write"] = "select * from orders"
ORACLE["foreign_append"] = "select * from orders"
ORACLE["borough_domain"] = "select r_name as borough from region"
ORACLE["borough_status"] = """
  select string_agg(r_name, ', ' order by r_regionkey) as value_text,
    concat('Analyzing ', cast(count(*) as varchar), ' regions') as caption from region"""
ORACLE["chosen_status"] = """
  select string_agg(cast(c_nationkey as varchar), ', ' order by n desc, c_nationkey) as value_text,
    concat('Analyzing ', cast(count(*) as varchar), ' subway routes') as caption
  from (select c_nationkey, count(*) as n from customer group by 1
        order by n desc, c_nationkey limit 3) x"""
ORACLE["stored_digest"] = (
    ARRIVALS
    + """select hour, stop_id, route_id, direction_id, route_color, count(*) as n_rows,
          count(trip_id) as n_trips from arr group by all"""
)
ORACLE["stored_route_summary"] = ORACLE["route_summary"]
ORACLE["stored_kpi_day"] = ORACLE["hour_kpi_all"]
ORACLE["side_by_side_append"] = "select * from orders"
ORACLE["batch_once"] = "select * from orders"
ORACLE["partition_replace"] = """
  select * replace (
    case when o_orderstatus <> 'F' then 2 * o_totalprice else o_totalprice end as o_totalprice)
  from orders"""
ORACLE["stream_beside_batch"] = "select event_type, count(*) as n from events group by event_type"
ORACLE["merged_digest"] = ORACLE["stored_digest"]
ORACLE["indexed_kpi_day"] = ORACLE["hour_kpi_all"]
ORACLE["indexed_kpi"] = ORACLE["hour_kpi"]
ORACLE["indexed_route_summary"] = ORACLE["route_summary"]
ORACLE["quality_history"] = """
  with lines as (
    select *, l_linestatus = 'F' and l_quantity > 1 as kept from lineitem),
  runs as (select unnest(['first', 'second']) as run),
  verdicts as (
    select run, 'shipped' as rule, 'drop' as kind, l_linestatus = 'F' as v from lines, runs
    union all select run, 'some', 'drop', l_quantity > 1 from lines, runs
    union all select run, 'cheap', 'flag', l_extendedprice < 50000 from lines, runs where kept
    union all select run, 'known', 'flag', nullif(l_returnflag, 'A') <> 'N' from lines, runs where kept
    union all select run, 'taxed', 'fail', case when run = 'first' then l_tax >= 0 else l_tax > 0 end
      from lines, runs where kept)
  select run, rule, kind, count(*) as rows, count(*) filter (v) as passed,
    count(*) filter (not v) as failed, count(*) filter (v is null) as unknown
  from verdicts group by run, rule, kind"""
ORACLE["drifting_json"] = """
  select event_id, case when event_id % 2 = 0 then value end as value,
    case when event_id % 2 = 1 then event_type end as event_type,
    case when event_id % 2 = 1 then props end as detail_text,
    case when event_id % 2 = 1 then user_id end as detail_user_id
  from events"""
ORACLE["stream_unique"] = "select event_type, count(*) as n from events group by event_type"
