"""The SQL twins of the named queries, written independently of the DataFrame code."""

from __future__ import annotations

from gaugeworks import schemas

DAILY = """daily as (
  select cast(l_suppkey as varchar) ec_station_id, cast(l_shipdate as date) datetime,
         max(case when l_returnflag <> 'R' then l_quantity end) total_precip
  from lineitem group by 1, 2)"""

HOURLY = """hourly as (
  select cast(user_id as varchar) ec_station_id, 'C' || user_id climate_id, date_trunc('hour', ts) datetime,
         avg(value) temp
  from events group by all)"""

STATIONS = """stations as (
  select cast(s_suppkey as varchar) station_id, 'C' || s_suppkey climate_id, s_name "name", n_name province,
         case when s_suppkey % 4 = 0 then chr(cast(65 + s_suppkey % 26 as int))
              || chr(cast(65 + (s_suppkey // 26) % 26 as int)) || chr(cast(65 + s_suppkey % 7 as int)) end tc_id,
         cast(48 + (s_suppkey * 53 % 120) / 10.0 as double) lat,
         cast(-139 + (s_suppkey * 37 % 250) / 10.0 as double) lon,
         1995 + s_suppkey % 3 dly_first_year, 2001 - s_suppkey % 2 dly_last_year,
         case when s_suppkey % 5 > 0 then 1998 + s_suppkey % 2 end hly_first_year,
         case when s_suppkey % 5 > 0 then 2000 end hly_last_year,
         case when s_suppkey % 3 > 0 then 1990 + s_suppkey % 7 end mly_first_year,
         case when s_suppkey % 3 > 0 then 1999 end mly_last_year
  from supplier join nation on s_nationkey = n_nationkey),
provinces as (
  select chr(65 + n_nationkey) || chr(65 + n_nationkey % 5) code, n_name province from nation)"""

REP_YEAR = DAILY + """,
rep as (
  select ec_station_id, month(datetime) || '-' || day(datetime) as idx, avg(total_precip) m, count(total_precip) n
  from daily where ec_station_id in (select ec_station_id from daily where total_precip is not null)
  group by 1, 2)"""

# Every ordered pair of different stations with its distance in metres, to the millimetre.
PAIRS = STATIONS + """,
pairs as (
  select a.station_id active_station, b.station_id,
         round(2 * 6371008.8 * asin(sqrt(
           pow(sin(radians(b.lat - a.lat) / 2), 2)
           + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lon - a.lon) / 2), 2))), 3) distance
  from stations a, stations b where a.station_id <> b.station_id),
ranked as (
  select *, row_number() over (partition by active_station order by distance, station_id) nth,
         min(distance) over (partition by active_station) lo, max(distance) over (partition by active_station) hi
  from pairs)"""

# Composite weights of all ordered pairs of stations with a representative year.
WEIGHTS = PAIRS + ", " + REP_YEAR + """,
days as (select * from rep where idx <> '2-29'),
whole as (select ec_station_id station_id, count(m) / count(*) rep_year_completeness from days group by 1),
matched as (
  select x.ec_station_id active_station, y.ec_station_id station_id,
         case when min(x.m) = max(x.m) or min(y.m) = max(y.m) then null
              else covar_pop(x.m, y.m) / nullif(stddev_pop(x.m) * stddev_pop(y.m), 0) end r
  from days x join days y on x.idx = y.idx and x.ec_station_id <> y.ec_station_id
  where x.m is not null and y.m is not null group by 1, 2),
weights as (
  select active_station, station_id, nth, distance,
         case when rep_year_completeness = 0 then 0 else r * rep_year_completeness end corr_weight,
         rep_year_completeness, 1 - (distance - lo) / nullif(hi - lo, 0) dist_weight,
         0.75 * (case when rep_year_completeness = 0 then 0 else r * rep_year_completeness end)
           + 0.25 * (1 - (distance - lo) / nullif(hi - lo, 0)) comp_weight
  from ranked join whole using (station_id) left join matched using (active_station, station_id)
  where active_station in (select ec_station_id from rep)),
best as (
  select *, row_number() over (partition by active_station order by comp_weight desc, station_id) place
  from weights where comp_weight > 0)"""

FILLED = WEIGHTS + """,
span as (select * from daily where {period}),
fills as (
  select t.ec_station_id, t.datetime, sum(v.total_precip * w.comp_weight) / nullif(sum(w.comp_weight), 0) fill, count(*) n
  from span t join best w on w.active_station = t.ec_station_id and w.place <= 100
  join span v on v.ec_station_id = w.station_id and v.datetime = t.datetime
  where t.total_precip is null and v.total_precip is not null group by 1, 2),
filled as (
  select ec_station_id, datetime, coalesce(total_precip, fill) total_precip, total_precip og_total_precip,
         case when total_precip is null then 'interpolated' else 'recorded' end precip_intp_flag,
         coalesce(n, 0) n_neighbours
  from span left join fills using (ec_station_id, datetime))"""
EVERYTHING = FILLED.format(period="true")

NEW_DAILY = DAILY + """,
batch as (select * from daily where datetime < date '2001-06-01'),
fresh as (
  select 'C' || ec_station_id climate_id, * from batch
  where not exists (select 1 from lineitem where l_linestatus = 'F' and cast(l_suppkey as varchar) = ec_station_id
    and cast(l_shipdate as date) = datetime))"""

ADDED_DAILY = NEW_DAILY + """,
added as (
  select case when cast(ec_station_id as int) % 10 <> 0 then 'C' || ec_station_id end climate_id, * from batch
  where cast(ec_station_id as int) % 10 = 0 or exists (
    select 1 from fresh f where f.ec_station_id = batch.ec_station_id and f.datetime = batch.datetime))"""

UNDATED = DAILY + """,
undated as (
  select ec_station_id, datetime, total_precip from daily
  union all select cast(s_suppkey as varchar), null, null from supplier)"""

SELECTORS = "'DD', '7', '42', 'EAE', 'IAB', 'ZZZ', '999999999', 'QQ', 'x', 'north shore'"

KEYS = STATIONS + """,
keys as (
  select 'station' kind, station_id "key", station_id from stations
  union all select 'airport', tc_id, station_id from stations where length(tc_id) = 3
  union all select 'province', code, station_id from stations join provinces using (province))"""

CHOSEN = KEYS + f""",
chosen as (select * from stations where station_id in (select station_id from keys where "key" in ({SELECTORS})))"""

BUCKETS = DAILY + """,
years as (select min(year(datetime)) lo, max(year(datetime)) hi from daily),
cuts as (
  select k, hi - {step} * k top, hi - {step} * (k + 1) bottom, lo,
         k = greatest(cast(ceil((hi - lo + 1) / {step}) as int) - 2, 0) oldest
  from years, range(0, 100) r(k) where k <= greatest(cast(ceil((hi - lo + 1) / {step}) as int) - 2, 0))
select ec_station_id, datetime, (case when oldest then lo else bottom end) || '-' || top bucket
from daily join cuts on year(datetime) >= (case when oldest then lo else bottom end)
  and (year(datetime) < top or (k = 0 and year(datetime) = top))"""

# Requested periods against availability; a is the first month on offer and b the last.
_CLIP = {
    "open": ("true", "a", "b"),
    "start": ("date '1996-05-01' <= b", "greatest(a, date '1996-05-01')", "b"),
    "end": ("date '2000-01-01' >= a", "a", "least(b, date '2000-01-01')"),
    "range": ("date '1985-01-01' <= b and date '1996-03-01' >= a", "date '1985-01-01'", "date '1996-03-01'"),
    "date": ("date '2001-03-01' between a and b", "date '2001-03-01'", "date '2001-03-01'"),
    "late_1998": ("date '1998-11-01' <= b", "greatest(a, date '1998-11-01')", "b"),
    "to_1999": ("date '1999-08-01' >= a", "a", "least(b, date '1999-08-01')"),
}


def _clip(period: str) -> str:
    keep, first, last = _CLIP[period]
    return STATIONS + f""",
offers as (
  select station_id, kind, make_date(f, 1, 1) a, make_date(l, 12, 1) b from (
    select station_id, 'monthly' kind, cast(mly_first_year as int) f, cast(mly_last_year as int) l from stations
    union all select station_id, 'daily', cast(dly_first_year as int), cast(dly_last_year as int) from stations
    union all select station_id, 'hourly', cast(hly_first_year as int), cast(hly_last_year as int) from stations)
  where f is not null),
clipped as (
  select station_id, kind, {first} first_day, {last} last_day from offers where {keep}
  union all select station_id, 'climate', null, null from stations)"""


def _plan(period: str, kinds: str) -> str:
    return "with " + _clip(period) + f""",
plan as (
  select station_id, kind, cast(null as int) "year", cast(null as int) "month" from clipped where kind in ('monthly', 'climate')
  union all
  select station_id, kind, unnest(range(year(first_day), year(last_day) + 1)), null from clipped where kind = 'daily'
  union all
  select station_id, kind, year(m), month(m) from (
    select station_id, kind, unnest(generate_series(first_day, last_day, interval 1 month)) m from clipped where kind = 'hourly'))
select station_id, kind, "year", "month" from plan where kind in ({kinds})"""


RAW = """raw as (
  select l_orderkey, l_linenumber,
         case l_returnflag when 'R' then '<' || cast(l_quantity as int) when 'A' then cast(l_quantity as int) || '.5'
           else case when l_linestatus = 'O' then (case when l_linenumber > 3 then 'M' else '' end)
                     when l_linenumber > 3 then 'NA' end end raw
  from lineitem)"""


def r6(name: str, expression: str | None = None) -> str:
    return f'round({expression or name}, 6) + 0.0 as "{name}"'


_W = ", ".join(["active_station", "station_id", *(
    r6(c) for c in ("corr_weight", "rep_year_completeness", "dist_weight", "comp_weight"))])
_F = f"ec_station_id, datetime, {r6('total_precip')}, {r6('og_total_precip')}, precip_intp_flag, n_neighbours"
_OBSERVED = "select ec_station_id, datetime, total_precip from daily where "
_LISTED = 'select station_id, "name", province, tc_id from '

# What the raw files hold of the 32 and 31 columns; the others are NULL.
READ_DAILY = {
    "ec_station_id": "ec_station_id", "climate_id": "'C' || ec_station_id", "station_name": "'Station ' || ec_station_id",
    "datetime": "datetime", "year": "year(datetime)", "month": "month(datetime)", "day": "day(datetime)", "total_precip": "total_precip",
    "spd_of_max_gust": "case when year(datetime) < 1998 then cast(day(datetime) + 30 as double) end",
    "spd_of_max_gust_flag": "case when year(datetime) < 1998 then 'E' end",
}
READ_HOURLY = {
    "ec_station_id": "ec_station_id", "climate_id": "climate_id", "datetime": "datetime", "time": "strftime(datetime, '%H:%M')",
    "temp": "round(temp, 6) + 0.0", "weather": "'Rain,Fog'",
}


def _whole(kind: str, known: dict[str, str]) -> str:
    """Every column of a table of observations."""
    types = {"string": "varchar", "timestamp_ntz": "timestamp"}
    fields = [(f.name, f.dataType.simpleString()) for f in schemas.observation_schema(kind)]
    return ", ".join(f'{known.get(c, f"cast(null as {types.get(t, t)})")} "{c}"' for c, t in fields)


SQL: dict[str, str] = {
    "rep_year": f"""with {REP_YEAR}
        select ec_station_id, 'Station ' || ec_station_id station_name, idx as "index",
               {r6('mean_total_precip', 'm')}, n n_total_precip from rep""",
    "completeness": f"""with {REP_YEAR}
        select ec_station_id, {r6('rep_year_completeness', 'count(m) / count(*)')}
        from rep where idx <> '2-29' group by 1""",
    "stations_without": """select cast(l_orderkey as varchar) ec_station_id from lineitem
        group by l_orderkey having count(*) = count(*) filter (where l_returnflag = 'R')""",
    "distance_range": f"""with {PAIRS} select active_station station_id, {r6('min_distance', 'min(distance)')},
        {r6('max_distance', 'max(distance)')} from pairs group by 1""",
    "nearest_stations": f"""with {PAIRS}
        select active_station, station_id, {r6('distance')} from ranked where nth <= 300""",
    "distance_weight": f"""with {PAIRS} select active_station, station_id,
        {r6('dist_weight', '1 - (distance - lo) / nullif(hi - lo, 0)')} from ranked where nth <= 300""",
    "rep_year_corr": f"""with {WEIGHTS} select active_station, station_id, {r6('distance')}, {r6('corr', 'r')}
        from ranked left join matched using (active_station, station_id) where nth <= 300""",
    "pairwise_weights": f"with {WEIGHTS} select {_W} from weights where nth <= 300",
    "station_weights_top": f"with {WEIGHTS} select {_W} from best where place <= 100",
    "stored_weights_top": f"""with {WEIGHTS}, near as (
        select *, row_number() over (partition by active_station order by comp_weight desc, station_id) spot
        from weights where nth <= 300 and comp_weight > 0) select {_W} from near where spot <= 100""",
    "interpolate_precip": f"with {EVERYTHING} select {_F} from filled",
    "interpolate_range": "with " + FILLED.format(period="datetime between date '1996-02-01' and date '1997-06-30'")
        + f" select {_F} from filled",
    "interpolation_summary": f"""with {EVERYTHING} select precip_intp_flag, count(*) n_rows,
        count(total_precip) n_values, count(*) - count(total_precip) n_unfilled from filled group by 1""",
    "range_scan_both": f"with {DAILY} {_OBSERVED} datetime between date '1996-02-01' and date '1997-12-31'",
    "range_scan_start": f"with {DAILY} {_OBSERVED} datetime >= date '1999-07-15'",
    "range_scan_end": f"with {DAILY} {_OBSERVED} datetime <= date '1996-02-29'",
    "interpolated_record": f"with {EVERYTHING} select {_F} from filled",
    "range_scan_hourly": f"""with {HOURLY} select ec_station_id, datetime, {r6('temp')} from hourly
        where datetime >= timestamp '2024-01-10' and datetime < timestamp '2024-01-21'""",
    "insert_daily": f"with {ADDED_DAILY} select climate_id, ec_station_id, datetime, total_precip from added",
    "insert_hourly": f"""with {HOURLY}
        select case when cast(ec_station_id as int) % 10 <> 0 then climate_id end climate_id, ec_station_id, datetime,
          strftime(datetime, '%H:%M') as "time", {r6('temp')} from hourly
        where datetime < timestamp '2024-01-25' and (cast(ec_station_id as int) % 10 = 0 or (ec_station_id, datetime) not in (
          select cast(user_id as varchar), date_trunc('hour', ts) from events where event_type = 'click'))""",
    **dict.fromkeys(("insert_stream", "insert_keyed_stream"), f"""with {NEW_DAILY}
        select 'C' || ec_station_id climate_id, ec_station_id, datetime, total_precip from batch"""),
    "update_log": f"""with {ADDED_DAILY}, runs(run) as (values (1), (2))
        select 'daily' as "table", run, 2 * count(*) batch_rows, case when run = 1 then (select count(*) from added) else 0 end inserted_rows,
          cast(min(datetime) as varchar) min_dt, cast(max(datetime) as varchar) max_dt from batch, runs group by run""",
    "last_update": """select 'daily' as "table", 2 run, 0 inserted_rows""",
    "truncate_daily": f"with {DAILY} {_OBSERVED} datetime < date '2000-03-01'",
    "truncate_hourly": f"with {DAILY} {_OBSERVED} datetime < date '1998-07-01'",
    "truncate_hourly_strict": f"with {DAILY} {_OBSERVED} year(datetime) < 1998 or month(datetime) <= 6",
    **{f"year_bucket_{n}": "with " + BUCKETS.format(step=n) for n in (2, 3, 5, 10)},
    "keep_newest_3": f"""with {DAILY}, months as (
          select distinct cast(date_trunc('month', datetime) as date) d from daily order by d desc limit 3)
        select d snapshot_date, ec_station_id, datetime, total_precip
        from daily join months on cast(date_trunc('month', datetime) as date) = d""",
    "province_codes": f"with {STATIONS} select station_id, province, code from stations join provinces using (province)",
    "province_stations": f"""with {STATIONS} select station_id, province from stations join provinces using (province)
        where code in ('DD', 'IE', 'ID', 'MC')""",
    "active_stations": f"with {STATIONS} select station_id, dly_last_year >= 2001 active from stations",
    "station_keys": f'with {KEYS} select kind, "key", station_id from keys',
    "select_stations": f"with {CHOSEN} {_LISTED} chosen",
    "select_all_stations": f"with {CHOSEN} {_LISTED} stations",
    "unmatched_selectors": f"""with {KEYS}, asked as (select unnest([{SELECTORS}]) selector)
        select selector, case when regexp_full_match(selector, '[A-Za-z]{{3}}') then 'airport'
          when regexp_full_match(selector, '[0-9]+') then 'station' when length(selector) = 2 then 'province'
          else 'invalid' end kind from asked where selector not in (select "key" from keys)""",
    "station_info": f"""with {CHOSEN}
        select station_id, 'station_id' field, station_id as "value" from chosen
        union all select station_id, 'climate_id', climate_id from chosen
        union all select station_id, 'name', "name" from chosen
        union all select station_id, 'province', province from chosen
        union all select station_id, 'tc_id', tc_id from chosen
        """ + " ".join(f"union all select station_id, '{c}', cast({c} as varchar) from chosen" for c in (
            "lat", "lon", "dly_first_year", "dly_last_year", "hly_first_year", "hly_last_year", "mly_first_year", "mly_last_year")),
    **{f"clip_period_{p}": "with " + _clip(p) + """ select station_id, kind, strftime(first_day, '%Y-%m') first_month,
        strftime(last_day, '%Y-%m') last_month from clipped""" for p in ("open", "start", "end", "range", "date")},
    "plan_daily": _plan("open", "'daily'"),
    "plan_hourly": _plan("late_1998", "'hourly'"),
    "plan_files": _plan("to_1999", "'monthly', 'daily', 'hourly', 'climate'"),
    "missing_files": f"""select * from ({_plan("open", "'hourly'")}) p where (station_id, "year", "month") not in (
        select cast(l_suppkey as varchar), year(l_shipdate), month(l_shipdate) from lineitem where l_quantity = 50)""",
    "strip_speed": f"""with {RAW} select *,
        try_cast(nullif(regexp_replace(raw, '[^0-9.]', '', 'g'), '') as double) speed from raw""",
    "strip_speed_strict": f"with {RAW} select *, regexp_replace(raw, '[^0-9]', '', 'g') speed from raw",
    "to_typed": f"""with {RAW} select l_orderkey, l_linenumber,
        case when raw not in ('', 'NA') then raw end as "text", try_cast(raw as double) "real",
        case when raw not like '%.%' then try_cast(raw as int) end whole from raw""",
    "clean_names": """select p_partkey, lower(replace(trim(replace(regexp_replace(
        ' Stn. ' || p_brand || ' (' || p_type || ') ' || p_name || ' Flag (%) ', '\\(.*\\)', '', 'g'), '.', '')),
        ' ', '_')) column_name from part""",
    "matching_columns": """select * exclude (c_custkey, o_orderdate) replace (cast(floor(o_totalprice) as bigint) as o_totalprice,
        cast(floor(c_acctbal) as bigint) as c_acctbal) from orders join customer on c_custkey = o_custkey""",
    "parse_dates": """select o_orderkey, case when o_orderstatus in ('F', 'O') or o_orderkey % 3 = 0 then cast(o_orderdate as date) end as "day",
        case when o_orderstatus in ('F', 'O') then date_trunc('minute', o_orderdate) end as "minute",
        case o_orderstatus when 'F' then cast(date_trunc('year', o_orderdate) as date)
          when 'O' then cast(date_trunc('month', o_orderdate) as date) end as "month" from orders""",
    "update_window": """select o_orderkey, strftime(cast(o_orderdate as date) - 31, '%Y-%m') first_month,
        strftime(o_orderdate, '%Y-%m') last_month from orders""",
    "stack_tables": """select o_orderkey id, o_totalprice price, cast(null as double) tax from orders
        union all select l_orderkey, null, l_tax from lineitem""",
    "ingest_daily": f"with {DAILY} select {_whole('daily', READ_DAILY)} from daily",
    "ingest_hourly": f"with {HOURLY} select {_whole('hourly', READ_HOURLY)} from hourly",
    "ingest_tree_daily": f"with {DAILY} select {_whole('daily', READ_DAILY)} from daily",
    "ingest_tree_hourly": f"with {HOURLY} select {_whole('hourly', READ_HOURLY)} from hourly",
    "delivered_files": f"""with {DAILY}, {HOURLY}
        select distinct ec_station_id station_id, 'daily' kind, year(datetime) "year", cast(null as int) "month" from daily
        union all select distinct ec_station_id, 'hourly', year(datetime), month(datetime) from hourly""",
    "station_list": f"""with {STATIONS} select "name", province, climate_id, station_id, {r6('lat')}, {r6('lon')},
        dly_first_year, dly_last_year from stations""",
    "file_periods": f"""with {DAILY}, {HOURLY}
        select distinct '/raw/' || ec_station_id || '/daily/en_climate_daily_C' || ec_station_id || '_'
            || year(datetime) || '_P1D.csv' path,
          year(datetime) "year", cast(null as int) "month", ec_station_id from daily
        union all select distinct '/raw/' || ec_station_id || '/hourly/en_climate_hourly_'
            || strftime(datetime, '%m-%Y') || '_P1H.csv', year(datetime), month(datetime), ec_station_id from hourly""",
    "delete_after_daily": f"with {UNDATED} select * from undated where datetime is null or datetime < date '2000-03-01'",
    "delete_after_hourly": f"with {UNDATED} select * from undated where datetime is null or datetime < date '1998-07-01'",
    "delete_after_hourly_strict": f"with {UNDATED} select * from undated where datetime is null or year(datetime) < 1998 or month(datetime) <= 6",
    "sql_station_months": f"""with {DAILY}, {STATIONS},
      near as (
        select station_id, province, 2 * 6371008.8 * asin(sqrt(pow(sin(radians(52 - lat) / 2), 2)
          + cos(radians(lat)) * cos(radians(52)) * pow(sin(radians(-130 - lon) / 2), 2))) far from stations)
      select station_id, province, strftime(datetime, '%Y-%m') "month", min(month(datetime) || '-' || day(datetime)) first_index,
        {r6('total_precip', 'sum(total_precip)')}, {r6('distance', 'max(far)')}
      from daily join near on station_id = ec_station_id
      where far < 500000 and datetime between date '1996-02-01' and date '1997-12-31' group by 1, 2, 3""",
    "stored_extremes": f"""with {DAILY} select min(datetime) min_datetime, max(datetime) max_datetime, min(year(datetime)) min_year,
        max(year(datetime)) max_year, count(*) n_rows from daily""",
    "named_records": f"""with {EVERYTHING}, spans as (
        select ec_station_id, strftime(min(datetime), '%Y%m%d') a, strftime(max(datetime), '%Y%m%d') b from filled group by 1)
      select 'stat_' || ec_station_id || '_' || a || '-' || b || '.csv' file, ec_station_id, datetime, {r6('total_precip')}, precip_intp_flag
      from filled join spans using (ec_station_id)""",
    "named_buckets": f"""with bucketed(ec_station_id, datetime, bucket) as (with {BUCKETS.format(step=5)}), {DAILY}
      select 'daily_' || cast(ec_station_id as int) % 3 || '_' || bucket || '.csv' file, ec_station_id, datetime, total_precip
      from bucketed join daily using (ec_station_id, datetime)""",
    "missing_delivered": f"""with {DAILY}, {HOURLY}, planned as ({_plan("open", "'daily', 'hourly'")})
      select * from planned p where case kind
        when 'daily' then not exists (select 1 from daily where ec_station_id = p.station_id and year(datetime) = p."year")
        else not exists (select 1 from hourly where ec_station_id = p.station_id and year(datetime) = p."year" and month(datetime) = p."month") end""",
}
SQL |= {"insert_bucketed_daily": SQL["insert_daily"], "insert_bucketed_hourly": SQL["insert_hourly"], "rep_year_updated": SQL["rep_year"],
        "weights_updated": SQL["pairwise_weights"]}
