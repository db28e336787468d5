"""DuckDB SQL that recomputes the catalogue's results from the same tables.

Each check is written on its own from the meaning of the query; the only shared
parts are the common table expressions below, which derive the event model.
"""

from __future__ import annotations

from datetime import date, timedelta


def _holiday_list(first_year: int, last_year: int) -> str:
    """US federal holidays by counting through the calendar, as SQL rows."""
    found: set[date] = set()
    for year in range(first_year, last_year + 1):
        for month, day in ((1, 1), (6, 19), (7, 4), (11, 11), (12, 25)):
            d = date(year, month, day)
            found |= {d, d + timedelta({5: -1, 6: 1}.get(d.weekday(), 0))}
        days = [date(year, 1, 1) + timedelta(i) for i in range(365)]

        def weekdays(month: int, weekday: int) -> list[date]:
            return [d for d in days if d.month == month and d.weekday() == weekday]

        found |= {weekdays(1, 0)[2], weekdays(2, 0)[2], weekdays(5, 0)[-1], weekdays(9, 0)[0]}
        found |= {weekdays(10, 0)[1], weekdays(11, 3)[3]}
    return ", ".join(f"(date '{d}')" for d in sorted(found))


KEYS = (
    "zone_id, event_date, event_hour, weekday, \"month\", \"quarter\", is_weekend, is_holiday, is_business_hour, "
    "is_after_hours"
)
CALENDAR = """
  date_trunc('hour', event_datetime) weather_hour, cast(event_datetime as date) event_date,
  cast(hour(event_datetime) as integer) event_hour, cast(isodow(event_datetime) - 1 as integer) weekday,
  dayname(event_datetime) weekday_name, cast(month(event_datetime) as integer) "month",
  monthname(event_datetime) month_name, cast(quarter(event_datetime) as integer) "quarter",
  cast(year(event_datetime) as integer) "year",
  case when month(event_datetime) in (12, 1, 2) then 'Winter' when month(event_datetime) <= 5 then 'Spring'
       when month(event_datetime) <= 8 then 'Summer' else 'Fall' end season,
  isodow(event_datetime) >= 6 is_weekend,
  cast(event_datetime as date) in (select holiday from holidays) is_holiday,
  hour(event_datetime) between 8 and 17 and isodow(event_datetime) < 6
    and cast(event_datetime as date) not in (select holiday from holidays) is_business_hour
"""
WEATHER = "temperature_2m, relative_humidity_2m, precipitation, rain, snowfall, weather_code, wind_speed_10m"


def _fact(source: str) -> str:
    return f"""
  select c.*, not is_business_hour is_after_hours, sector, precinct,
    {", ".join("w." + c.strip() for c in WEATHER.split(","))}, cast(1 as integer) demand_count
  from (select *, {CALENDAR} from {source}) c
  left join lookup l on c.zone_id = l.zone_id left join weather w on c.weather_hour = w.weather_hour
"""


def _rollup(source: str) -> str:
    means = ", ".join(
        f"avg({c.strip()}) {c.strip()}" for c in WEATHER.split(",") if c.strip() != "weather_code"
    )
    return f"""
  select a.*, top1 category_mix_top_1_share, top3 category_mix_top_3_share,
    cast(a.event_date as timestamp) + to_hours(a.event_hour) date_hour
  from (select {KEYS}, count(*) target_demand_count, {means}, min(weather_code) weather_code
        from {source} group by all) a
  join (select zone_id, event_date, event_hour, sum(case when r <= 1 then n else 0 end) / sum(n) top1,
          sum(case when r <= 3 then n else 0 end) / sum(n) top3
        from (select *, row_number() over (partition by zone_id, event_date, event_hour
                                           order by n desc, category) r
              from (select zone_id, event_date, event_hour, category, count(*) n from {source} group by all))
        group by all) m
  on a.zone_id = m.zone_id and a.event_date = m.event_date and a.event_hour = m.event_hour
"""


def _features(rollup: str) -> str:
    return f"""
  select z.*, cast(target_demand_count > threshold as integer) high_demand_flag
  from (select *,
          coalesce(lag(target_demand_count, 1) over t, 0) lag_1_hour_demand,
          coalesce(lag(target_demand_count, 24) over t, 0) lag_24_hour_demand,
          coalesce(lag(target_demand_count, 168) over t, 0) prior_week_same_hour_demand,
          coalesce(avg(target_demand_count) over (partition by zone_id order by date_hour
                   rows between 168 preceding and 1 preceding), 0) rolling_7_day_avg
        from {rollup} window t as (partition by zone_id order by date_hour)) z
  join (select zone_id, quantile_cont(target_demand_count, 0.75) threshold from {rollup} group by 1) q
  on z.zone_id = q.zone_id
"""


# name -> (SQL, names it builds on)
CTES: dict[str, tuple[str, tuple[str, ...]]] = {
    "holidays(holiday)": (f"values {_holiday_list(1990, 2035)}", ()),
    "service": (
        """
  select cast(event_id as varchar) event_id, ts event_datetime,
    case when user_id % 50 <> 49 then concat('Z0', cast(user_id % 8 as varchar)) end beat,
    event_type final_call_type,
    case when event_id % 97 <> 0 then json_extract_string(props, '$.k') end disposition,
    case when event_id % 31 <> 0 then 47.5::double + (user_id % 100)::double / 1000 end latitude,
    case when event_id % 31 <> 0 then -122.4::double + (user_id % 70)::double / 1000 end longitude,
    value, props raw_props
  from events""",
        (),
    ),
    "cleaned": (
        """
  select *, coalesce(beat, 'UNKNOWN') zone_id,
    upper(final_call_type[1]) || lower(final_call_type[2:]) category,
    case when beat is null then 'missing_zone' else 'ok' end data_quality_flag
  from service""",
        ("service",),
    ),
    "weather": (
        """
  select h weather_hour, case when n % 97 <> 0 then (n * 7 % 350) / 10.0::double - 5 end temperature_2m,
    (n % 50 + 40)::double relative_humidity_2m, p precipitation, p * 0.8::double rain,
    case when n % 50 = 0 then 1.5::double else 0 end snowfall, (n % 5)::double weather_code,
    case when n % 53 <> 0 then (n % 23) * 0.5::double end wind_speed_10m
  from (select *, case when n % 4 = 0 then (n % 37) / 3.0::double else 0 end p
        from (select distinct date_trunc('hour', ts) h,
                date_diff('day', date '2024-01-01', cast(ts as date)) * 24 + hour(ts) n
              from events where day(ts) <= 20))""",
        (),
    ),
    "lookup": (
        """
  select concat('Z0', cast(n_nationkey as varchar)) zone_id, upper(n_name) sector, upper(r_name) precinct
  from nation join region on n_regionkey = r_regionkey where n_nationkey < 7""",
        (),
    ),
    "fact": (_fact("cleaned"), ("holidays(holiday)", "cleaned", "weather", "lookup")),
    "zone_hours": (_rollup("fact"), ("fact",)),
    "features": (_features("zone_hours"), ("zone_hours",)),
    "order_cleaned": (
        """
  select cast(o_orderkey as varchar) event_id, o_orderdate event_datetime,
    concat('Z0', cast(c_nationkey % 8 as varchar)) zone_id, o_orderpriority final_call_type,
    array_to_string(list_transform(regexp_extract_all(
      regexp_replace(regexp_replace(o_orderpriority, '\\s*-\\s*', ' - ', 'g'), '\\s+', ' ', 'g'),
      '[A-Za-z]+|[^A-Za-z]+'), lambda x: upper(x[1]) || lower(x[2:])), '') category,
    'ok' data_quality_flag
  from orders join customer on o_custkey = c_custkey""",
        (),
    ),
    "order_facts": (_fact("order_cleaned"), ("holidays(holiday)", "order_cleaned", "weather", "lookup")),
    "order_hours": (_rollup("order_facts"), ("order_facts",)),
    "order_features": (_features("order_hours"), ("order_hours",)),
}


def _with(names: tuple[str, ...], body: str) -> str:
    """The body behind the CTEs it needs, each once and after those it builds on."""
    chain: list[str] = []

    def add(name: str) -> None:
        for below in CTES[name][1]:
            add(below)
        if name not in chain:
            chain.append(name)

    for name in names:
        add(name)
    parts = []
    for name in chain:
        keep = "" if "(" in name else " materialized" if name in ("fact", "zone_hours", "features") else ""
        parts.append(f"{name} as{keep} ({CTES[name][0]})")
    return "with " + ",\n".join(parts) + "\n" + body


ORACLE: dict[str, str] = {}


def _check(name: str, needs: tuple[str, ...], body: str) -> None:
    ORACLE[name] = _with(needs, body) if needs else body


_check(
    "zone_hour_features",
    ("features",),
    """
select zone_id, cast(event_date as varchar) "date", date_hour, event_hour "hour", weekday, "month", "quarter", is_weekend, is_holiday,
  is_business_hour, is_after_hours, round(temperature_2m, 6) temperature_2m,
  round(relative_humidity_2m, 6) relative_humidity_2m, round(precipitation, 6) precipitation,
  round(rain, 6) rain, round(snowfall, 6) snowfall, weather_code, round(wind_speed_10m, 6) wind_speed_10m,
  lag_1_hour_demand, lag_24_hour_demand, round(rolling_7_day_avg, 6) rolling_7_day_avg,
  prior_week_same_hour_demand, round(category_mix_top_1_share, 6) category_mix_top_1_share,
  round(category_mix_top_3_share, 6) category_mix_top_3_share, target_demand_count, high_demand_flag
from features""",
)


# --- calendar and enrichment ----------------------------------------------

_check(
    "calendar_features",
    ("holidays(holiday)", "cleaned"),
    f"""
select event_id, weather_hour, cast(event_date as varchar) event_date, event_hour, weekday, weekday_name, "month",
  month_name, "quarter", "year", season, is_weekend, is_holiday, is_business_hour, not is_business_hour is_after_hours
from (select *, {CALENDAR} from cleaned)""",
)
_check(
    "holiday_flags",
    ("order_facts",),
    """
select cast(event_date as varchar) event_date, is_holiday, season, count(*) events from order_facts group by all""",
)
_ROUNDED_WEATHER = ", ".join(f"round({c.strip()}, 6) {c.strip()}" for c in WEATHER.split(","))
_check(
    "enrich_fact",
    ("fact",),
    f"""
select event_id, event_datetime, weather_hour, cast(event_date as varchar) event_date, event_hour, weekday,
  weekday_name, "month", month_name, "quarter", "year", season, is_weekend, is_holiday, is_business_hour,
  is_after_hours, zone_id, coalesce(beat, zone_id) beat, sector, precinct, round(latitude, 6) latitude,
  round(longitude, 6) longitude, cast(null as varchar) initial_call_type, final_call_type,
  category normalized_service_category, disposition, {_ROUNDED_WEATHER}, data_quality_flag, demand_count
from fact""",
)
_check(
    "weather_coverage",
    ("fact",),
    """
select count(*) fact_rows, count(temperature_2m) weather_rows,
  round(count(temperature_2m)::double / count(*), 6) weather_join_coverage,
  min(event_datetime) first_event, max(event_datetime) last_event
from fact""",
)
_check(
    "lineage_check",
    ("fact",),
    """
select (select count(*) from cleaned) input_rows, (select count(*) from fact) output_rows,
  (select count(distinct event_id) from cleaned) input_ids, (select count(distinct event_id) from fact) output_ids,
  (select count(*) from (select event_id from cleaned except select event_id from fact)) missing_ids,
  (select count(*) from (select event_id from fact except select event_id from cleaned)) new_ids,
  (select count(*) - count(distinct event_id) from fact) duplicate_rows,
  (select round((count(*) - count(distinct event_id))::double / count(*), 6) from fact) duplicate_impact""",
)

# --- zone-hour features ---------------------------------------------------

_check(
    "zone_hour_demand",
    ("zone_hours",),
    f"select zone_id, date_hour, target_demand_count, {_ROUNDED_WEATHER} from zone_hours",
)
_check(
    "category_mix",
    ("zone_hours",),
    """
select zone_id, date_hour, round(category_mix_top_1_share, 6) category_mix_top_1_share,
  round(category_mix_top_3_share, 6) category_mix_top_3_share
from zone_hours""",
)
_check(
    "lag_features",
    ("features",),
    """
select zone_id, date_hour, target_demand_count, lag_1_hour_demand, lag_24_hour_demand, prior_week_same_hour_demand
from features""",
)
_check(
    "rolling_mean",
    ("features",),
    "select zone_id, date_hour, round(rolling_7_day_avg, 6) rolling_7_day_avg from features",
)
for _name, _quantile in (("exact", "quantile_cont"), ("approx", "quantile_disc")):
    _check(
        f"high_demand_{_name}",
        ("zone_hours",),
        f"""
select z.zone_id, date_hour, threshold zone_high_threshold,
  cast(target_demand_count > threshold as integer) high_demand_flag
from zone_hours z join (select zone_id, cast({_quantile}(target_demand_count, 0.75) as double) threshold
                        from zone_hours group by 1) q on z.zone_id = q.zone_id""",
    )
CTES["dense_hours"] = (
    """
  select s.zone_id, s.date_hour, cast(s.date_hour as date) event_date, cast(hour(s.date_hour) as integer) event_hour,
    cast(isodow(s.date_hour) - 1 as integer) weekday, isodow(s.date_hour) >= 6 is_weekend,
    cast(s.date_hour as date) in (select holiday from holidays) is_holiday,
    coalesce(target_demand_count, 0) target_demand_count
  from (select zone_id, unnest(generate_series(min(date_hour), max(date_hour), interval 1 hour)) date_hour
        from zone_hours group by zone_id) s
  left join zone_hours z on s.zone_id = z.zone_id and s.date_hour = z.date_hour""",
    ("zone_hours",),
)
CTES["dense_features"] = (_features("dense_hours"), ("dense_hours",))
_check(
    "dense_zone_hour",
    ("dense_features",),
    """
select zone_id, date_hour, event_hour "hour", weekday, is_weekend, is_holiday, target_demand_count,
  lag_1_hour_demand, lag_24_hour_demand, prior_week_same_hour_demand, round(rolling_7_day_avg, 6) rolling_7_day_avg,
  high_demand_flag
from dense_features""",
)

# --- named reports --------------------------------------------------------

_check(
    "q01_demand_by_hour_weekday",
    ("fact",),
    "select weekday_name, event_hour, count(*) demand_count from fact group by all",
)
_check(
    "q02_demand_by_month",
    ("order_facts",),
    'select "year", "month", month_name, count(*) demand_count from order_facts group by all',
)
_check(
    "q03_demand_by_zone", ("fact",), "select zone_id, precinct, sector, count(*) demand_count from fact group by all"
)
_check(
    "q04_demand_by_service_category",
    ("order_facts",),
    "select category normalized_service_category, count(*) demand_count from order_facts group by all",
)
_check(
    "q05_top_demand_zones",
    ("fact",),
    "select zone_id, count(*) demand_count from fact group by all order by demand_count desc, zone_id limit 25",
)
_check(
    "q06_peak_demand_windows",
    ("fact",),
    """
select weekday_name, event_hour, demand_count
from (select weekday, weekday_name, event_hour, count(*) demand_count from fact group by all)
order by demand_count desc, weekday, event_hour limit 25""",
)
_check(
    "q07_weekend_vs_weekday_demand", ("fact",), "select is_weekend, count(*) demand_count from fact group by all"
)
_check(
    "q08_business_vs_after_hours_demand",
    ("fact",),
    "select is_after_hours, count(*) demand_count from fact group by all",
)
_check(
    "q09_weather_and_demand_relationship",
    ("fact",),
    """
select round(temperature_2m, 0) temperature_bucket,
  case when precipitation > 0 then 'precipitation_observed' else 'no_precipitation' end precipitation_flag,
  count(*) demand_count
from fact group by all""",
)
_check(
    "q10_zone_category_concentration",
    ("fact",),
    "select zone_id, category normalized_service_category, count(*) demand_count from fact group by all",
)
_check(
    "q11_demand_volatility_by_zone",
    ("zone_hours",),
    """
select zone_id, round(avg(target_demand_count), 6) avg_hourly_demand,
  round(var_pop(target_demand_count), 6) demand_variance
from zone_hours group by all""",
)
_check(
    "q12_monthly_trend", ("order_facts",), 'select "year", "month", count(*) demand_count from order_facts group by all'
)
_check(
    "q13_workload_risk_score_by_zone",
    ("features",),
    """
select zone_id, round(avg(target_demand_count), 6) avg_hourly_demand, round(avg(high_demand_flag), 6) high_demand_rate,
  round(avg(cast(is_after_hours as integer)), 6) after_hours_share,
  round(avg(cast(is_weekend as integer)), 6) weekend_share
from features group by all""",
)
CTES["predictions"] = (
    """
  select zone_id, date_hour, target_demand_count::double target_demand_count, high_demand_flag actual_high_demand,
    cast(prior_week_same_hour_demand >= threshold as integer) baseline_prediction,
    least(greatest(prior_week_same_hour_demand / greatest(threshold, 1.0::double), 0), 1) probability
  from features, (select quantile_disc(date_hour, 0.8) cutoff, max(date_hour) final from features),
    (select quantile_disc(target_demand_count, 0.75)::double threshold from features
     where date_hour <= (select quantile_disc(date_hour, 0.8) from features))
  where date_hour > cutoff or cutoff = final""",
    ("features",),
)
_check(
    "q14_top_forecasted_high_demand_zones",
    ("predictions",),
    """
select zone_id, round(avg(probability), 6) avg_predicted_probability,
  round(avg(round_even(probability * 100, 1)), 6) avg_workload_risk_score
from predictions group by all order by avg(probability) desc, zone_id limit 25""",
)


def _segment_features(features: str) -> str:
    return f"""
  select b.*, peak_hour_concentration, coalesce(month_to_month_variability, 0) month_to_month_variability
  from (select zone_id, avg(target_demand_count) avg_hourly_demand, avg(cast(is_weekend as integer)) weekend_share,
          avg(cast(is_after_hours as integer)) after_hours_share, avg(category_mix_top_1_share) top_category_share,
          coalesce(stddev_samp(target_demand_count), 0) demand_volatility,
          coalesce(case when var_pop(coalesce(precipitation, 0) + coalesce(rain, 0)) > 0
                         and var_pop(target_demand_count) > 0
            then abs(corr(target_demand_count, coalesce(precipitation, 0) + coalesce(rain, 0))) end, 0)
            weather_sensitivity_proxy,
          avg(cast(is_business_hour as integer)) business_hour_share
        from {features} group by zone_id) b
  join (select zone_id, max(d)::double / sum(d) peak_hour_concentration
        from (select zone_id, event_hour, sum(target_demand_count) d from {features} group by all) group by all) p
    on b.zone_id = p.zone_id
  join (select zone_id, stddev_samp(d) month_to_month_variability
        from (select zone_id, "month", sum(target_demand_count) d from {features} group by all) group by all) m
    on b.zone_id = m.zone_id
"""


SEGMENT_FEATURES = (
    "avg_hourly_demand weekend_share after_hours_share top_category_share demand_volatility "
    "weather_sensitivity_proxy peak_hour_concentration month_to_month_variability business_hour_share"
).split()
CTES["zone_vectors"] = (_segment_features("features"), ("features",))
CTES["quintiles"] = (
    "select *, cast(ntile(5) over (order by avg_hourly_demand, zone_id) - 1 as integer) cluster_id from zone_vectors",
    ("zone_vectors",),
)
CTES["named"] = (
    f"""
  select q.*, n.cluster_name
  from quintiles q join (
    select cluster_id, case
      when avg_hourly_demand >= m_avg_hourly_demand and demand_volatility <= m_demand_volatility
        then 'High-volume steady demand zones'
      when weekend_share >= m_weekend_share and peak_hour_concentration >= m_peak_hour_concentration
        then 'Weekend/event-driven zones'
      when after_hours_share >= m_after_hours_share then 'Late-night demand zones'
      when weather_sensitivity_proxy >= m_weather_sensitivity_proxy and weather_sensitivity_proxy > 0
        then 'Weather-sensitive zones'
      else 'Low-volume stable zones' end cluster_name
    from (select cluster_id, {", ".join(f"round(avg({f}), 9) {f}" for f in SEGMENT_FEATURES)} from quintiles group by 1),
      (select {", ".join(f"round(median({f}), 9) m_{f}" for f in SEGMENT_FEATURES)} from quintiles)) n
  on q.cluster_id = n.cluster_id""",
    ("quintiles",),
)
_check(
    "q15_cluster_profile_summary",
    ("named",),
    """
select cluster_id, cluster_name, count(*) zone_count, round(avg(avg_hourly_demand), 6) avg_hourly_demand,
  round(avg(after_hours_share), 6) after_hours_share
from named group by all""",
)
_check(
    "q16_data_quality_summary", ("fact",), "select data_quality_flag, count(*) row_count from fact group by all"
)
_check(
    "q17_zone_hour_weather_summary",
    ("features",),
    """
select case when coalesce(precipitation, 0) + coalesce(rain, 0) > 0 then 'precipitation_observed'
            else 'no_precipitation' end precipitation_flag,
  round(temperature_2m, 0) temperature_bucket, count(*) observed_zone_hours,
  round(avg(target_demand_count), 6) avg_demand, round(avg(high_demand_flag), 6) high_demand_rate
from features group by all""",
)

# --- dimensions and marts -------------------------------------------------

_check(
    "dim_date",
    ("fact",),
    """
select distinct cast(event_date as varchar) event_date, weekday, weekday_name, "month", month_name, "quarter", "year",
  season, is_weekend, is_holiday from fact""",
)
_check(
    "dim_location",
    ("fact",),
    """
select distinct zone_id, coalesce(beat, zone_id) beat, sector, precinct, round(latitude, 6) latitude,
  round(longitude, 6) longitude from fact""",
)
_check("dim_service_category", ("fact",), "select distinct category normalized_service_category from fact")
_check("dim_weather_hour", ("fact",), f"select distinct weather_hour, {_ROUNDED_WEATHER} from fact")


def _mart_rows(features: str) -> str:
    return f"""
  select zone_id, event_date, event_hour "hour", weekday, dayname(event_date) weekday_name,
    strftime(event_date, '%Y-%m') "period", cast(year(event_date) as integer) "year",
    cast(month(event_date) as integer) "month", target_demand_count demand_count, is_weekend, is_after_hours,
    high_demand_flag, temperature_2m, precipitation, rain
  from {features}
"""


CTES["mart"] = (_mart_rows("features"), ("features",))
CTES["order_mart"] = (_mart_rows("order_features"), ("order_features",))
SELECTED = '"period" between \'1996-03\' and \'1997-11\''


def _summary(source: str, by: str = "", where: str = "true") -> str:
    names = [b.strip() for b in by.split(",") if b.strip()] + ["zone_id"]
    keys = ", ".join(names)
    return f"""
select s.*, p.peak_hour
from (select {keys}, cast(sum(demand_count) as bigint) total_service_demand, count(*) zone_hour_records,
        cast(sum(case when is_weekend then demand_count else 0 end) as bigint) weekend_demand,
        cast(sum(case when is_after_hours then demand_count else 0 end) as bigint) after_hours_demand,
        cast(sum(high_demand_flag) as bigint) high_demand_hours, max(demand_count) peak_hour_demand,
        round(sum(demand_count)::double / count(*), 6) avg_calls_per_zone_hour,
        round(sum(case when is_weekend then demand_count else 0 end)::double / sum(demand_count), 6) weekend_share,
        round(sum(case when is_after_hours then demand_count else 0 end)::double / sum(demand_count), 6)
          after_hours_share,
        round(sum(high_demand_flag)::double / count(*), 6) high_demand_hour_rate
      from {source} where {where} group by all) s
join (select {keys}, "hour" peak_hour
      from (select {keys}, "hour", row_number() over (partition by {keys} order by sum(demand_count) desc, "hour") r
            from {source} where {where} group by {keys}, "hour")
      where r = 1) p on {" and ".join(f"s.{n} = p.{n}" for n in names)}"""


_check("zone_summary", ("mart",), _summary("mart"))
_check("zone_summary_by_period", ("order_mart",), _summary("order_mart", '"period", "year", "month"'))
_check(
    "hourly_demand",
    ("mart",),
    """
select "period", "year", "month", cast(event_date as varchar) "date", "hour", is_weekend,
  cast(sum(demand_count) as bigint) demand_count, count(*) zone_hour_records
from mart group by all""",
)
_check(
    "daily_demand",
    ("order_mart",),
    """
select "period", "year", "month", cast(event_date as varchar) "date", weekday, weekday_name, is_weekend,
  cast(sum(demand_count) as bigint) demand_count, count(*) zone_hour_records
from order_mart group by all""",
)
_check(
    "demand_heatmap",
    ("mart",),
    """
select "period", "year", "month", zone_id, "hour", is_weekend, cast(sum(demand_count) as bigint) demand_count,
  count(*) zone_hour_records
from mart group by all""",
)
CTES["banded"] = (
    """
  select *, case when coalesce(precipitation, rain, 0) <= 0 then 'No measured precipitation'
      when coalesce(precipitation, rain, 0) <= 0.5 then 'Trace to 0.5 mm'
      when coalesce(precipitation, rain, 0) <= 2 then '0.5 to 2 mm'
      when coalesce(precipitation, rain, 0) <= 10 then '2 to 10 mm' else '10+ mm' end wet_band,
    case when temperature_2m is null then 'nan' when temperature_2m <= 0 then 'Below 0 C'
      when temperature_2m <= 5 then '0 to 5 C' when temperature_2m <= 10 then '5 to 10 C'
      when temperature_2m <= 15 then '10 to 15 C' when temperature_2m <= 20 then '15 to 20 C'
      when temperature_2m <= 25 then '20 to 25 C' else '25+ C' end warm_band
  from mart where coalesce(temperature_2m, precipitation, rain) is not null""",
    ("mart",),
)
_check(
    "weather_context",
    ("banded",),
    """
select "period", "year", "month", 'Precipitation band' "view", wet_band band,
  cast(sum(demand_count) as bigint) demand_count, count(*) zone_hour_records,
  round(sum(demand_count)::double / count(*), 6) avg_demand_per_zone_hour
from banded group by all
union all
select "period", "year", "month", 'Temperature band' "view", warm_band band,
  cast(sum(demand_count) as bigint) demand_count, count(*) zone_hour_records,
  round(sum(demand_count)::double / count(*), 6) avg_demand_per_zone_hour
from banded group by all""",
)
_check(
    "weather_band_totals",
    ("banded",),
    "select warm_band band, cast(sum(demand_count) as bigint) demand_count from banded group by all",
)
_check(
    "category_mix_mart",
    ("order_facts",),
    """
select strftime(event_date, '%Y-%m') "period", "year", "month", zone_id, category service_category,
  count(*) demand_count, count(*) event_rows, false sample_based
from order_facts group by all""",
)
_check(
    "category_share",
    ("fact",),
    """
select category normalized_service_category, count(*) demand_count,
  round(count(*)::double / (select count(*) from fact), 6) share_of_total
from fact group by all""",
)
_check(
    "peak_hours",
    ("mart",),
    """
select zone_id, "hour" peak_hour, d peak_demand
from (select zone_id, "hour", cast(sum(demand_count) as bigint) d,
        row_number() over (partition by zone_id order by sum(demand_count) desc, "hour") r
      from mart group by zone_id, "hour")
where r = 1""",
)


def _hour_columns(hour: str, amount: str) -> str:
    return ", ".join(f"cast(coalesce(sum({amount}) filter ({hour} = {h}), 0) as bigint) h{h}" for h in range(24))


_check(
    "weekday_hour_pivot",
    ("fact",),
    f"select weekday_name, {_hour_columns('event_hour', 'demand_count')} from fact group by all",
)
_check(
    "top_zone_heatmap",
    ("mart",),
    f"""
select zone_id, {_hour_columns('"hour"', 'demand_count')} from mart
where zone_id in (select zone_id from mart group by 1 order by sum(demand_count) desc, 1 limit 5) group by all""",
)
_check("filtered_view", ("order_mart",), _summary("order_mart", "", SELECTED))
_check("incremental_mart", ("order_mart",), _summary("order_mart", '"period", "year", "month"'))
_check("incremental_view", ("order_mart",), _summary("order_mart", "", f"{SELECTED} and is_weekend"))
_check(
    "sketch_view",
    ("order_mart",),
    f"""
select zone_id, count(*) zone_hours, true p50_within, true p75_within, true p95_within, true days_within
from order_mart where {SELECTED} group by all""",
)
_check("weekend_view", ("order_mart",), _summary("order_mart", "", f"{SELECTED} and is_weekend"))
_check(
    "view_kpis",
    ("order_mart",),
    f"""
select (select cast(sum(demand_count) as bigint) from order_mart where {SELECTED} and not is_weekend) selected_demand,
  (select count(*) from order_mart where {SELECTED} and not is_weekend) selected_records,
  (select count(distinct zone_id) from order_mart where {SELECTED} and not is_weekend) active_zones,
  z.zone_id top_zone, z.d top_zone_demand, h."hour" peak_hour, 'Weekday' peak_context
from (select zone_id, cast(sum(demand_count) as bigint) d from order_mart where {SELECTED} and not is_weekend
      group by all order by d desc, zone_id limit 1) z,
  (select "hour", sum(demand_count) d from order_mart where {SELECTED} and not is_weekend
   group by all order by d desc, "hour" limit 1) h""",
)
_RHYTHM = """
select "hour", is_weekend, cast(sum(demand_count) as bigint) demand_count,
  case when is_weekend then 'Weekend' else 'Weekday' end period_type
from mart group by all"""
_check("hourly_rhythm", ("mart",), _RHYTHM)
_check(
    "rhythm_peak",
    ("mart",),
    f"""
select "hour", period_type, demand_count from ({_RHYTHM}) order by demand_count desc, "hour", is_weekend limit 1""",
)
_check(
    "weekly_pattern",
    ("mart",),
    "select weekday, weekday_name, cast(sum(demand_count) as bigint) demand_count from mart group by all",
)
_check(
    "top_categories",
    ("order_facts",),
    """
select category service_category, count(*) demand_count from order_facts group by all
order by demand_count desc, service_category limit 12""",
)

# --- zone profile, risk, plan ---------------------------------------------


def _mode(column: str) -> str:
    return f"""
    (select zone_id, v from (select *, row_number() over (partition by zone_id order by n desc, v) r
       from (select zone_id, {column} v, count(*) n from fact where {column} is not null group by 1, 2))
     where r = 1)"""


CTES["zone_profiles"] = (
    f"""
  select z.*, p.v primary_precinct, s.v primary_sector, c.v top_category
  from (select zone_id, count(*) total_events, min(event_datetime) first_event, max(event_datetime) last_event
        from fact group by all) z
  left join {_mode("precinct")} p on z.zone_id = p.zone_id
  left join {_mode("sector")} s on z.zone_id = s.zone_id
  left join {_mode("category")} c on z.zone_id = c.zone_id""",
    ("fact",),
)
CTES["zone_stats"] = (
    """
  select zone_id, avg(target_demand_count) avg_hourly_demand, stddev_samp(target_demand_count) demand_volatility,
    var_pop(target_demand_count) demand_variance, avg(cast(is_after_hours as integer)) after_hours_share,
    avg(cast(is_weekend as integer)) weekend_share, avg(high_demand_flag) high_demand_rate
  from features group by all""",
    ("features",),
)
RISK = {
    "total_events": 0.35, "avg_hourly_demand": 0.25, "demand_volatility": 0.2, "after_hours_share": 0.1,
    "weekend_share": 0.1,
}


def _scaled(c: str) -> str:
    v = f"coalesce({c}::double, 0)"
    return (
        f"case when max({v}) over () = min({v}) over () then 50 else round_even(({v} - min({v}) over ()) / "
        f"(max({v}) over () - min({v}) over ()) * 100, 1) end"
    )


CTES["risk"] = (
    f"""
  select *, round_even({" + ".join(f"({_scaled(c)}) * {w}::double" for c, w in RISK.items())}, 1) workload_risk_score
  from zone_profiles join zone_stats using (zone_id)""",
    ("zone_profiles", "zone_stats"),
)
_check(
    "zone_profile",
    ("zone_profiles",),
    """
select zone_id, total_events, first_event, last_event, primary_precinct, primary_sector, top_category
from zone_profiles""",
)
_check(
    "zone_statistics",
    ("zone_stats",),
    """
select zone_id, round(avg_hourly_demand, 6) avg_hourly_demand, round(demand_volatility, 6) demand_volatility,
  round(demand_variance, 6) demand_variance, round(after_hours_share, 6) after_hours_share,
  round(weekend_share, 6) weekend_share, round(high_demand_rate, 6) high_demand_rate
from zone_stats""",
)
_check(
    "risk_score",
    ("risk",),
    """
select zone_id, workload_risk_score, total_events, round(avg_hourly_demand, 6) avg_hourly_demand,
  round(after_hours_share, 6) after_hours_share, round(weekend_share, 6) weekend_share,
  round(high_demand_rate, 6) high_demand_rate,
  cast(row_number() over (order by workload_risk_score desc, zone_id) as integer) "rank"
from risk""",
)
_check(
    "scenario_plan",
    ("risk",),
    """
select zone_id, total_events::double baseline_events, workload_risk_score, round(weight, 6) priority_weight,
  round(projected, 6) projected_demand, round(projected * 0.85 / 12, 6) resources_needed,
  round(30 * weight, 6) allocated_resources, round(30 * weight * 12, 6) projected_capacity,
  round(greatest(projected * 0.85 - 30 * weight * 12, 0), 6) workload_gap,
  round(30 * weight * 12 / projected, 6) coverage_pct,
  case when workload_risk_score >= 70 then 'Prioritize workload-risk review'
       else 'Monitor recurring demand pattern' end recommendation_text
from (select *, workload_risk_score / sum(workload_risk_score) over () weight,
        total_events * 1.1::double * 1.05::double projected
      from (select * from risk order by workload_risk_score desc, zone_id limit 25))""",
)


def _recommendations() -> str:
    from zoneflow.operators.planner import RECOMMENDATION_COLUMNS, RECOMMENDATIONS

    rows = ", ".join("(" + ", ".join(f"'{v}'" for v in r) + ")" for r in RECOMMENDATIONS)
    names = ", ".join(RECOMMENDATION_COLUMNS)
    return f"""
select * replace (replace(replace(evidence_signal, '{{zone}}',
    (select zone_id from risk order by workload_risk_score desc, zone_id limit 1)), '{{category}}',
    (select category from fact group by category order by count(*) desc, category limit 1)) as evidence_signal)
from (values {rows}) t({names})"""


_check("recommendations", ("risk", "fact"), _recommendations())
_check(
    "executive_kpis",
    ("risk", "fact"),
    """
select * from (values
  ('total_service_events', (select count(*) from fact)::varchar, 'Rows in the fact table'),
  ('date_start', (select strftime(min(event_datetime), '%Y-%m-%d %H:%M:%S') from fact),
   'Earliest service-event timestamp'),
  ('date_end', (select strftime(max(event_datetime), '%Y-%m-%d %H:%M:%S') from fact),
   'Latest service-event timestamp'),
  ('unique_zones', (select count(distinct zone_id) from fact)::varchar, 'Distinct zones/beats'),
  ('unique_categories', (select count(distinct category) from fact)::varchar,
   'Distinct normalized service categories'),
  ('top_workload_risk_zone', (select zone_id from risk order by workload_risk_score desc, zone_id limit 1),
   'Highest workload-risk score'),
  ('top_service_category', (select category from fact group by category order by count(*) desc, category limit 1),
   'Largest event category'),
  ('sample_mode', 'False', 'Whether the run used sample mode')) t(metric, "value", detail)""",
)
_check(
    "dashboard_kpis",
    ("order_mart", "order_facts"),
    """
select (select count(*) from order_mart) zone_hour_records,
  (select count(distinct zone_id) from order_mart) active_zones_beats,
  (select cast(min(event_date) as varchar) from order_mart) date_start,
  (select cast(max(event_date) as varchar) from order_mart) date_end,
  (select string_agg("period", ',' order by "period") from (select distinct "period" from order_mart)) periods,
  (select count(*) from order_cleaned) cleaned_input_events, (select count(*) from order_facts) fact_output_rows,
  (select count(distinct event_id) from order_facts) unique_event_ids,
  (select count(*) - count(distinct event_id) from order_facts) post_enrichment_duplicate_fact_rows,
  (select round((count(*) - count(distinct event_id))::double / count(*), 6) from order_facts)
    post_enrichment_duplicate_impact,
  (select min("period") from order_mart) period_start, (select max("period") from order_mart) period_end,
  cast(7 as integer) mapped_beat_polygons""",
)

# --- cleaning, collapse, audit, quality -----------------------------------

CTES["raw_clean"] = (
    r"""
  select event_id, case when cast(event_id as bigint) % 5 <> 2
      then date_trunc('second', event_datetime) end event_datetime,
    case when cast(event_id as bigint) % 7 <> 0 then upper(final_call_type) || '- o''neil/7-eleven' end final_call_type,
    case when cast(event_id as bigint) % 3 = 0 then 'dv -no ' || final_call_type end service_category,
    disposition, upper(beat) beat,
    case when cast(event_id as bigint) % 11 = 0 then 1047.5 when cast(event_id as bigint) % 11 = 1 then null
      else latitude end latitude
  from service""",
    ("service",),
)
_check(
    "clean_events",
    ("raw_clean",),
    r"""
select *, concat_ws(';', case when event_datetime is null then 'missing_datetime' end,
    case when beat is null then 'missing_zone' end,
    case when normalized_service_category = 'Uncategorized' then 'missing_category' end,
    case when event_datetime is not null and beat is not null and normalized_service_category <> 'Uncategorized'
      then 'ok' end) data_quality_flag
from (
  select event_id, event_datetime, final_call_type call_type, cast(null as varchar) initial_call_type,
    final_call_type, service_category,
    coalesce(array_to_string(list_transform(regexp_extract_all(
        regexp_replace(regexp_replace(coalesce(service_category, final_call_type), '\s*-\s*', ' - ', 'g'),
          '\s+', ' ', 'g'), '[A-Za-z]+|[^A-Za-z]+'), lambda x: upper(x[1]) || lower(x[2:])), ''), 'Uncategorized')
      normalized_service_category,
    disposition, coalesce(beat, 'UNKNOWN') zone_id, beat, cast(null as varchar) sector, cast(null as varchar) precinct,
    round(latitude, 6) latitude, cast(null as double) longitude, cast(null as varchar) neighborhood,
    cast(null as varchar) reporting_area
  from raw_clean)""",
)
_check(
    "record_completeness",
    ("cleaned",),
    """
select cast(3 + (beat is not null)::integer + (latitude is not null)::integer + (longitude is not null)::integer
            + (disposition is not null)::integer as integer) record_completeness_score, count(*) events
from cleaned group by all""",
)
_ORDER = "l_shipdate, l_extendedprice, l_partkey, l_suppkey, l_quantity"
_check(
    "collapse_duplicates",
    (),
    f"""
select l_orderkey, l_linenumber, {_ORDER}, duplicate_count
from (select *, count(*) over (partition by l_orderkey, l_linenumber) duplicate_count,
        row_number() over (partition by l_orderkey, l_linenumber order by
          {", ".join(f"{c.strip()} desc" for c in _ORDER.split(","))}) r
      from lineitem) where r = 1""",
)
_check(
    "first_per_key",
    (),
    f"""
select l_orderkey, l_linenumber, {_ORDER}
from (select *, row_number() over (partition by l_orderkey, l_linenumber order by {_ORDER}) r from lineitem)
where r = 1""",
)
CTES["copies"] = (
    """
  select *, 1 source_row_number from service
  union all
  select event_id, case when k in (2, 6) then event_datetime + interval 1 minute else event_datetime end,
    case when k = 3 then 'Z99' else beat end, case when k in (4, 6) then 'moved' else final_call_type end,
    case when k = 5 then 'x' else disposition end, latitude, longitude, value,
    case when k = 1 then raw_props || ' ' else raw_props end, 2
  from (select *, cast(event_id as bigint) % 40 k from service) where k <= 6""",
    ("service",),
)
CTES["audited"] = (
    """
  select event_id, count(*) duplicate_group_size, count(*) observed_rows_in_audit_pass, count(*) - 1 rows_beyond_first,
    k = 0 exact_duplicate_all_fields, k = 1 same_event_id_identical_core_fields,
    k in (2, 6) same_event_id_conflicting_timestamp, k = 3 same_event_id_conflicting_location,
    k in (4, 6) same_event_id_conflicting_category, k = 5 same_event_id_conflicting_disposition,
    k >= 2 possible_event_update_or_history,
    cast(case when k = 6 then 2 when k >= 2 then 1 else 0 end as integer) conflict_type_count,
    case k when 0 then 'A. exact_duplicate_all_fields' when 1 then 'B. same_event_id_identical_core_fields'
      when 2 then 'C. same_event_id_conflicting_timestamp' when 3 then 'D. same_event_id_conflicting_location'
      when 4 then 'E. same_event_id_conflicting_category' when 5 then 'F. same_event_id_conflicting_disposition'
      else 'G. possible_event_update_or_history' end duplicate_reason
  from (select *, cast(event_id as bigint) % 40 k from copies) group by event_id, k having count(*) > 1""",
    ("copies",),
)
_check(
    "collapse_events",
    ("audited",),
    """
select event_id, event_datetime, coalesce(beat, 'UNKNOWN') zone_id,
  upper(final_call_type[1]) || lower(final_call_type[2:]) normalized_service_category, disposition,
  source_row_number, score record_completeness_score, coalesce(duplicate_group_size, 1) duplicate_count,
  coalesce(duplicate_reason, 'not_duplicated') duplicate_reason, duplicate_group_size is not null has_duplicate_history,
  'max(record_completeness_score, event_datetime, source_row_number)' duplicate_collapse_rule
from (select *, row_number() over (partition by event_id order by score desc, event_datetime desc,
        source_row_number desc) r
      from (select *, cast(3 + (beat is not null)::integer + (latitude is not null)::integer
              + (longitude is not null)::integer + (disposition is not null)::integer as integer) score
            from copies)) c
left join audited using (event_id) where r = 1""",
)
_check("duplicate_audit", ("audited",), "select * from audited")
_check(
    "audit_reasons",
    ("audited",),
    """
select duplicate_reason, count(*) event_ids, cast(sum(rows_beyond_first) as bigint) rows_beyond_first
from audited group by all""",
)
_FLAGS = (
    "exact_duplicate_all_fields same_event_id_identical_core_fields same_event_id_conflicting_timestamp "
    "same_event_id_conflicting_location same_event_id_conflicting_category same_event_id_conflicting_disposition "
    "possible_event_update_or_history"
).split()
_check(
    "audit_flags",
    ("audited",),
    " union all ".join(
        f"select '{f}' category, count(*) filter ({f}) event_ids, "
        f"cast(coalesce(sum(rows_beyond_first) filter ({f}), 0) as bigint) rows_beyond_first from audited"
        for f in _FLAGS
    ),
)
_check(
    "audit_verdict",
    ("audited",),
    f"""
select *, round(non_exact_rows::double / rows_beyond_first, 6) non_exact_share,
  case when non_exact_rows::double / rows_beyond_first > 0.01 or conflicting_rows > 0
    then 'FAIL - current event_id-only collapse is too aggressive'
    else 'PASS - removed duplicates are overwhelmingly exact' end status
from (select count(*) duplicated_event_ids, cast(sum(duplicate_group_size) as bigint) rows_in_groups,
        cast(sum(rows_beyond_first) as bigint) rows_beyond_first, max(duplicate_group_size) largest_group,
        cast(sum(rows_beyond_first) filter (not exact_duplicate_all_fields) as bigint) non_exact_rows,
        cast(sum(rows_beyond_first) filter ({" or ".join(_FLAGS[2:])}) as bigint) conflicting_rows
      from audited)""",
)
_check(
    "audit_largest",
    ("audited",),
    """
select event_id, duplicate_group_size, duplicate_reason from audited
order by duplicate_group_size desc, event_id limit 20""",
)
_check(
    "audit_samples",
    ("audited",),
    """
select c.event_id, cast(source_row_number as integer) source_row_number,
  strftime(event_datetime, '%Y-%m-%d %H:%M:%S') queued_datetime, coalesce(beat, 'UNKNOWN') zone_id,
  upper(final_call_type[1]) || lower(final_call_type[2:]) normalized_service_category, disposition,
  duplicate_group_size, duplicate_reason
from copies c join audited a on c.event_id = a.event_id
where c.event_id in (select event_id from audited order by duplicate_group_size desc, event_id limit 20)
  or c.event_id in (select event_id from (select event_id, row_number() over (partition by duplicate_reason
       order by duplicate_group_size desc, event_id) r from audited) where r <= 10)""",
)


def _quality() -> str:
    def missing(c: str) -> str:
        return f"round_even(count(*) filter ({c} is null)::double / count(*) * 100, 2)"

    whole = "from fact"
    fixed = [
        ("sample_mode", "select 'False'", "Pipeline run mode"),
        ("fact_rows", f"select count(*) {whole}", "Rows in fact_service_events"),
        ("duplicate_event_ids", f"select count(*) - count(distinct event_id) {whole}",
         "Duplicate event identifiers after cleaning"),
        ("date_start", f"select strftime(min(event_datetime), '%Y-%m-%d %H:%M:%S') {whole}",
         "Earliest parsed service-event timestamp"),
        ("date_end", f"select strftime(max(event_datetime), '%Y-%m-%d %H:%M:%S') {whole}",
         "Latest parsed service-event timestamp"),
        ("missing_event_datetime_pct", f"select {missing('event_datetime')} {whole}",
         "Missing or unparsed event timestamps"),
        ("missing_zone_id_pct", f"select {missing('zone_id')} {whole}", "Zone/beat coverage"),
        ("distinct_zone_id", f"select count(distinct zone_id) {whole}", "Zone/beat coverage"),
        ("missing_normalized_service_category_pct", f"select {missing('category')} {whole}",
         "Service category coverage"),
        ("distinct_normalized_service_category", f"select count(distinct category) {whole}",
         "Service category coverage"),
        ("missing_temperature_2m_pct", f"select {missing('temperature_2m')} {whole}", "Weather join coverage"),
        ("missing_latitude_pct", f"select {missing('latitude')} {whole}", "Latitude availability"),
        ("missing_longitude_pct", f"select {missing('longitude')} {whole}", "Longitude availability"),
        ("zone_hour_rows", "select count(*) from features", "Rows in zone-hour feature table"),
        ("high_demand_rate_pct", "select round_even(avg(high_demand_flag) * 100, 2) from features",
         "Share of observed zone-hours above zone-specific threshold"),
    ]
    fixed_rows = [f"select '{m}' metric, cast(({q}) as varchar) \"value\", '{d}' detail" for m, q, d in fixed]
    columns = ["sector", "precinct", "latitude", "longitude", "disposition", *map(str.strip, WEATHER.split(","))]
    columns_rows = [
        f"select 'column_missingness:{c}' metric, cast({missing(c)} as varchar) \"value\", "
        f"'Column-level missingness' detail {whole} having count(*) filter ({c} is null) > 0"
        for c in columns
    ]
    empty = "select 'column_missingness:initial_call_type' metric, '100.0' \"value\", 'Column-level missingness' detail"
    return " union all ".join([*fixed_rows, *columns_rows, empty])


_check("quality_metrics", ("features",), _quality())
_check(
    "missing_ratios",
    ("fact",),
    """
select count(*) fact_rows, round(count(temperature_2m)::double / count(*), 6) weather_join_coverage,
  round(count(*) filter (latitude is null)::double / count(*), 6) missing_latitude_pct,
  round(count(*) filter (longitude is null)::double / count(*), 6) missing_longitude_pct
from fact""",
)
_check(
    "row_fingerprints",
    ("service",),
    "select event_id, sha256(event_id || '-' || coalesce(beat, '') || '-' || final_call_type) fallback_key from service",
)
_check(
    "upsert_merge",
    ("copies",),
    """
select event_id, event_datetime, beat, final_call_type, disposition,
  cast(source_row_number as integer) source_row_number
from (select *, row_number() over (partition by event_id order by source_row_number desc) r from copies) where r = 1""",
)

# --- segments -------------------------------------------------------------

_VECTOR = ", ".join(f"round({f}, 6) {f}" for f in SEGMENT_FEATURES)
CTES["order_vectors"] = (_segment_features("order_features"), ("order_features",))
_check("zone_cluster_features", ("order_vectors",), f"select zone_id, {_VECTOR} from order_vectors")
_check("zone_feature_vector", ("zone_vectors",), f"select zone_id, {_VECTOR} from zone_vectors")
_check(
    "quintile_segments",
    ("quintiles",),
    "select zone_id, cluster_id, round(avg_hourly_demand, 6) avg_hourly_demand from quintiles",
)
_check("cluster_names", ("named",), "select zone_id, cluster_id, cluster_name from named")
_check(
    "cluster_rollup",
    ("named",),
    """
select cluster_name, count(*) zone_count, round(avg(avg_hourly_demand), 6) avg_hourly_demand from named group by all""",
)

# --- forecast -------------------------------------------------------------

_check(
    "model_frame",
    ("features",),
    """
select part, count(*) "rows", cast(min(epoch(date_hour)) as bigint) first_epoch,
  cast(max(epoch(date_hour)) as bigint) last_epoch, cast(sum(high_demand_flag) as bigint) high_demand_rows
from (select *, case when date_hour <= (select quantile_disc(date_hour, 0.8) from features) then 'train'
                     else 'test' end part from features)
group by all""",
)
_check(
    "baseline_predictions",
    ("predictions",),
    """
select zone_id, date_hour, target_demand_count, actual_high_demand, baseline_prediction,
  round(probability, 6) baseline_probability, baseline_prediction ml_prediction,
  round(probability, 6) predicted_high_demand_probability, round_even(probability * 100, 1) workload_risk_score
from predictions""",
)
CTES["confusion"] = (
    """
  select count(*) filter (y = 0 and p = 0) tn, count(*) filter (y = 0 and p = 1) fp,
    count(*) filter (y = 1 and p = 0) fn, count(*) filter (y = 1 and p = 1) tp
  from (select actual_high_demand y, baseline_prediction p from predictions)""",
    ("predictions",),
)
_check(
    "baseline_metrics",
    ("confusion",),
    """
select 'baseline' model, tn, fp, fn, tp, round((tn + tp)::double / (tn + fp + fn + tp), 6) accuracy,
  case when tp + fp = 0 then 0 else round(tp::double / (tp + fp), 6) end "precision",
  case when tp + fn = 0 then 0 else round(tp::double / (tp + fn), 6) end recall,
  case when 2 * tp + fp + fn = 0 then 0 else round(2 * tp::double / (2 * tp + fp + fn), 6) end f1
from confusion""",
)
_check(
    "baseline_auc",
    ("predictions",),
    """
select cast(sum(y) as bigint) positives, cast(sum(1 - y) as bigint) negatives,
  round((sum(y * mid) - sum(y) * (sum(y) + 1) / 2.0::double) / (sum(y) * sum(1 - y)), 6) roc_auc
from (select actual_high_demand y,
        rank() over (order by probability) + (count(*) over (partition by probability) - 1) / 2.0::double mid
      from predictions)""",
)
CTES["classes"] = (
    """
  select '0' label, case when tn + fn = 0 then 0 else tn::double / (tn + fn) end p,
    case when tn + fp = 0 then 0 else tn::double / (tn + fp) end r,
    case when 2 * tn + fn + fp = 0 then 0 else 2 * tn::double / (2 * tn + fn + fp) end f, tn + fp n, tn hit
  from confusion
  union all
  select '1', case when tp + fp = 0 then 0 else tp::double / (tp + fp) end,
    case when tp + fn = 0 then 0 else tp::double / (tp + fn) end,
    case when 2 * tp + fp + fn = 0 then 0 else 2 * tp::double / (2 * tp + fp + fn) end, tp + fn, tp
  from confusion""",
    ("confusion",),
)
_check(
    "baseline_report",
    ("classes",),
    """
select label, round(p, 6) "precision", round(r, 6) recall, round(f, 6) f1, n support from classes
union all
select 'accuracy', round(sum(hit)::double / sum(n), 6), round(sum(hit)::double / sum(n), 6),
  round(sum(hit)::double / sum(n), 6), cast(sum(n) as bigint) from classes
union all
select 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6), cast(sum(n) as bigint) from classes
union all
select 'weighted avg', round(sum(p * n) / sum(n), 6), round(sum(r * n) / sum(n), 6), round(sum(f * n) / sum(n), 6),
  cast(sum(n) as bigint) from classes""",
)
_check(
    "highest_risk_hours",
    ("predictions",),
    """
select zone_id, date_hour, target_demand_count, actual_high_demand, baseline_prediction,
  round(probability, 6) baseline_probability, baseline_prediction ml_prediction,
  round(probability, 6) predicted_high_demand_probability, round_even(probability * 100, 1) workload_risk_score
from predictions order by probability desc, zone_id, date_hour limit 20""",
)

# --- statistics -----------------------------------------------------------

CTES["demand_mid_ranks"] = (
    """
  select *, rank() over (order by target_demand_count)
      + (count(*) over (partition by target_demand_count) - 1) / 2.0::double mid from features""",
    ("features",),
)
_TIES = "(select sum(t * t * t - t) from (select count(*)::double t from features group by target_demand_count))"


def _erfc(x: str) -> str:
    """Complementary error function of a non-negative expression by a published Chebyshev fit."""
    # Coefficients of the fit, highest power first.
    poly = "0.0"
    for c in (0.17087277, -0.82215223, 1.48851587, -1.13520398, 0.27886807, -0.18628806, 0.09678418, 0.37409196,
              1.00002368, -1.26551223):
        poly = f"({poly} / (1 + 0.5 * ({x})) + {c})"
    return f"exp(-({x}) * ({x}) + {poly}) / (1 + 0.5 * ({x}))"


_check(
    "wilcoxon",
    ("demand_mid_ranks",),
    f"""
select w statistic, round(z, 6) z, round({_erfc("abs(z) / sqrt(2)")}, 6) p_value, cast(n1 as bigint) n_false, cast(n2 as bigint) n_true, round(m1, 6) mean_false, round(m2, 6) mean_true,
  round(m2 - m1, 6) mean_difference
from (select *, (w - n1 * n2 / 2 - sign(w - n1 * n2 / 2) * 0.5) /
        sqrt(n1 * n2 / 12 * (n1 + n2 + 1 - ties / ((n1 + n2) * (n1 + n2 - 1)))) z
      from (select r1 - n1 * (n1 + 1) / 2 w, *
      from (select count(*) filter (not is_weekend)::double n1, count(*) filter (is_weekend)::double n2,
              sum(mid) filter (not is_weekend) r1, avg(target_demand_count) filter (not is_weekend) m1,
              avg(target_demand_count) filter (is_weekend) m2, {_TIES} ties
            from demand_mid_ranks)))""",
)


def _kruskal(groups: str) -> str:
    """Test over a query that gives the size and the rank sum of each group."""
    odd = f"{_erfc('sqrt(h / 2)')} + exp(-h / 2) * coalesce(list_sum(list_transform(range(0, (degrees - 1) // 2), lambda i: (h / 2) ^ (i + 0.5) / gamma(i + 1.5))), 0)"
    even = "exp(-h / 2) * list_sum(list_transform(range(0, degrees // 2), lambda i: (h / 2) ^ i / gamma(i + 1.0)))"
    return f"""
select round(h, 6) statistic, degrees, round(case when degrees % 2 = 1 then {odd} else {even} end, 6) p_value, cast(n as bigint) "rows"
from (select *, (12 / (n * (n + 1)) * q - 3 * (n + 1)) / (1 - ties / (n * n * n - n)) h
      from (select sum(size) n, sum(ranks * ranks / size) q, count(*) - 1 degrees, {_TIES} ties from ({groups})))"""


_check(
    "kruskal",
    ("demand_mid_ranks",),
    _kruskal("select zone_id, count(*)::double size, sum(mid) ranks from demand_mid_ranks group by all"),
)
_check(
    "kruskal_by_cluster",
    ("demand_mid_ranks", "named"),
    _kruskal(
        "select cluster_name, count(*)::double size, sum(mid) ranks from demand_mid_ranks join named using (zone_id) group by all"
    ),
)
_check(
    "group_ci_by_cluster",
    ("features", "named"),
    """
select cluster_name, round(m, 6) mean, round(s, 6) sd, n, round(m - 1.96::double * s / sqrt(n), 6) ci_low,
  round(m + 1.96::double * s / sqrt(n), 6) ci_high
from (select cluster_name, avg(target_demand_count) m, stddev_samp(target_demand_count) s, count(*) n
      from features join named using (zone_id) group by all)""",
)
_check(
    "group_ci",
    ("features",),
    """
select zone_id, round(m, 6) mean, round(s, 6) sd, n, round(m - 1.96::double * s / sqrt(n), 6) ci_low,
  round(m + 1.96::double * s / sqrt(n), 6) ci_high
from (select zone_id, avg(target_demand_count) m, stddev_samp(target_demand_count) s, count(*) n
      from features group by all)""",
)
_check(
    "ols_single",
    ("features",),
    """
select round(regr_slope(target_demand_count, temperature_2m), 6) slope,
  round(regr_intercept(target_demand_count, temperature_2m), 6) intercept,
  round(regr_r2(target_demand_count, temperature_2m), 6) r2, count(temperature_2m) "rows"
from features""",
)
_check(
    "demand_ranks",
    ("zone_hours",),
    """
select zone_id, date_hour, target_demand_count,
  cast(row_number() over (order by target_demand_count, zone_id, date_hour) as integer) "rank"
from zone_hours""",
)
_check(
    "event_ranks",
    ("service",),
    """
select event_id, cast(disposition as double) measure,
  cast(row_number() over (order by cast(disposition as double) nulls first, event_id) as integer) "rank"
from service""",
)

# --- geography ------------------------------------------------------------

CTES["shapes"] = (
    """
  select concat('C', cast(c_custkey as varchar)) zone_id, c_custkey % 3 kind, (c_custkey % 100)::double x,
    (c_nationkey * 5)::double y, (c_nationkey + 4)::double s
  from customer""",
    (),
)
_check(
    "polygon_centroid",
    ("shapes",),
    """
select zone_id, round(case kind when 1 then s * s - 4 when 2 then 2 * s * s else s * s end, 6) area,
  round(case kind when 1 then ((x + s / 2) * s * s - (x + 2) * 4) / (s * s - 4) when 2 then x + s / 2 + 100
             else x + s / 2 end, 6) centroid_x,
  round(case kind when 1 then ((y + s / 2) * s * s - (y + 2) * 4) / (s * s - 4) else y + s / 2 end, 6) centroid_y
from shapes""",
)
_check(
    "polygon_vertices",
    ("shapes",),
    """
select zone_id, cast(part as integer) part, cast(seq as integer) seq,
  x + 200 * part + case when seq in (1, 2) then s else 0 end x, y + case when seq in (2, 3) then s else 0 end y
from shapes, unnest([0, 1]) p(part), unnest([0, 1, 2, 3, 4]) q(seq) where part = 0 or kind = 2""",
)


def _ring_text(x: str, y: str, s: str) -> str:
    corners = [(x, y), (f"{x} + {s}", y), (f"{x} + {s}", f"{y} + {s}"), (x, f"{y} + {s}"), (x, y)]
    points = " || ', ' || ".join(f"cast({a} as varchar) || ' ' || cast({b} as varchar)" for a, b in corners)
    return f"'(' || {points} || ')'"


_check(
    "polygon_wkt",
    ("shapes",),
    f"""
select zone_id, case kind when 0 then 'POLYGON (' || {_ring_text("x", "y", "s")} || ')'
  when 1 then 'POLYGON (' || {_ring_text("x", "y", "s")} || ', ' || {_ring_text("x + 1", "y + 1", "2")} || ')'
  else 'MULTIPOLYGON ((' || {_ring_text("x", "y", "s")} || '), (' || {_ring_text("x + 200", "y", "s")} || '))'
  end geometry_wkt
from shapes""",
)
CTES["coloured"] = (
    """
  with totals as (
    select zone_id, sum(demand_count)::double d, count(*) n,
      sum(case when is_weekend then demand_count else 0 end)::double w from mart group by all),
  peaks as (
    select zone_id, "hour" peak_hour
    from (select zone_id, "hour", row_number() over (partition by zone_id order by sum(demand_count) desc, "hour") r
          from mart group by zone_id, "hour") where r = 1),
  ranked as (select *, row_number() over (order by d desc, zone_id) rk, greatest(max(d) over (), 1) top from totals)
  select p.zone_id, coalesce(d, 0) total_service_demand, coalesce(d / n, 0) avg_calls_per_zone_hour,
    coalesce(w / d, 0) weekend_share, peak_hour, cast(rk as integer) "rank", d is not null matched,
    coalesce(d / top, 0) intensity,
    case when d is null then 'rgba(216,226,235,0.34)' else concat('rgba(', cast(floor(38 + 160 * d / top) as integer),
      ',', cast(floor(185 - 80 * d / top) as integer), ',148,0.72)') end fill_color
  from (select zone_id from lookup union all select 'Z99') p
  left join ranked r on p.zone_id = r.zone_id left join peaks k on p.zone_id = k.zone_id""",
    ("mart", "lookup"),
)
_check(
    "choropleth",
    ("coloured",),
    """
select zone_id, total_service_demand, round(avg_calls_per_zone_hour, 6) avg_calls_per_zone_hour,
  round(weekend_share, 6) weekend_share, peak_hour::double peak_hour, "rank"::double "rank", matched,
  round(intensity, 6) intensity, fill_color
from coloured""",
)
_check(
    "map_coverage",
    ("coloured",),
    """
select count(*) polygons, count(*) filter (matched) matched_polygons,
  min(total_service_demand) filter (total_service_demand > 0) lowest_demand,
  max(total_service_demand) filter (total_service_demand > 0) highest_demand,
  (select count(distinct zone_id) from mart) analytic_zones,
  case when min(total_service_demand) filter (total_service_demand > 0) >= 1000
    then printf('%.1fK', min(total_service_demand) filter (total_service_demand > 0) / 1000)
    else cast(cast(min(total_service_demand) filter (total_service_demand > 0) as bigint) as varchar) end low_label,
  case when max(total_service_demand) filter (total_service_demand > 0) >= 1000
    then printf('%.1fK', max(total_service_demand) filter (total_service_demand > 0) / 1000)
    else cast(cast(max(total_service_demand) filter (total_service_demand > 0) as bigint) as varchar) end high_label
from coloured""",
)


# --- streaming and files --------------------------------------------------

_check(
    "stream_zone_hour",
    (),
    """
select zone_id, h date_hour, n demand_count
from (select concat('Z0', cast(user_id % 8 as varchar)) zone_id, date_trunc('hour', ts) h, count(*) n
      from events group by all)""",
)
_check(
    "stream_dedupe",
    (),
    """
select l_linenumber, count(*) "lines" from (select distinct l_orderkey, l_linenumber from lineitem) group by all""",
)
_check(
    "stream_upsert",
    (),
    """
select zone_id, event_id, event_datetime, final_call_type
from (select concat('Z0', cast(user_id % 8 as varchar)) zone_id, cast(event_id as varchar) event_id,
        ts event_datetime, event_type final_call_type,
        row_number() over (partition by user_id % 8 order by ts desc, cast(event_id as varchar) desc) r
      from events) where r = 1""",
)
_check(
    "upsert_levels",
    (),
    """
select user_id, event_id, ts, event_type, round(value, 6) "value", 'run-' || cast(event_id % 12 as varchar) load_tag
from (select *, row_number() over (partition by user_id order by event_id % 12 desc, ts desc, event_id desc) r from events)
where r = 1""",
)
_check(
    "csv_round_trip",
    ("raw_clean",),
    """
select coalesce(beat, 'UNKNOWN') zone_id, concat_ws(';', case when event_datetime is null then 'missing_datetime' end,
    case when beat is null then 'missing_zone' end,
    case when coalesce(service_category, final_call_type) is null then 'missing_category' end,
    case when event_datetime is not null and beat is not null
      and coalesce(service_category, final_call_type) is not null then 'ok' end) data_quality_flag, count(*) events
from raw_clean group by all""",
)
_check(
    "numbered_source_rows",
    (),
    'select count(*) "rows", count(*) highest_numbers, count(*) numbers from lineitem',
)
_check(
    "report_export",
    ("order_facts",),
    """
select 'monthly_trend' "name", count(distinct ("year", "month")) "rows", false failed from order_facts
union all select 'demand_by_service_category', count(distinct category), false from order_facts
union all select 'demand_volatility_by_zone', -1, true""",
)
_check(
    "catalog_load",
    ("service",),
    """
select event_id, strftime(event_datetime, '%Y-%m-%d %H:%M:%S') event_datetime, coalesce(beat, 'UNKNOWN') zone_id,
  cast(cast(event_id as bigint) % 2 = 0 as integer) is_even, cast(cast(event_id as bigint) % 3 as integer) batch
from service""",
)
_check(
    "capped_sample",
    (),
    """
select event_id, event_type, user_id
from (select *, row_number() over (partition by event_type order by sha256('42:' || event_id), event_id) r from events)
where r <= 100""",
)
_check(
    "capped_sample_all",
    (),
    "select o_orderkey, o_custkey from orders order by sha256('7:' || o_orderkey), o_orderkey limit 500",
)
_check(
    "tracked_build",
    (),
    """
select 0 step, 'built' decision, cast(count(*) as bigint) events from events where "value" >= 0
union all select 1, 'skipped', count(*) from events where "value" >= 0
union all select 2, 'rebuilt', count(*) from events where "value" >= 5
union all select 3, 'extended', count(*) + count(*) filter (event_id % 2 = 0) from events where "value" >= 5""",
)
_check(
    "time_history",
    ("dense_features",),
    """
select zone_id, date_hour, target_demand_count, lag_1_hour_demand, lag_24_hour_demand, prior_week_same_hour_demand,
  round(rolling_7_day_avg, 6) rolling_7_day_avg
from dense_features where target_demand_count > 0""",
)
_check(
    "stream_late_events",
    (),
    """
select concat('Z0', cast(user_id % 8 as varchar)) zone_id, date_trunc('hour', ts) date_hour, count(*) demand_count
from events group by all""",
)


# --- models by what is exact in them ---------------------------------------

CTES["training"] = (
    """
  select * from features
  where epoch(date_hour) <= (select quantile_disc(epoch(date_hour), 0.8) from features)""",
    ("features",),
)

_SOUND = """
select zone_id, date_hour, actual_high_demand, baseline_prediction, round(probability, 6) baseline_probability,
  true is_probability, true flag_follows, true risk_follows
from predictions"""
_check("forest_checked", ("predictions",), _SOUND)
_check("network_checked", ("predictions",), _SOUND)
_check(
    "network_steps",
    ("training",),
    """
select count(*) filter (d >= 10) fit_rows, count(*) filter (d < 10) validation_rows, 1::bigint kept_steps,
  true losses_finite, true best_kept, true stopped_by_rule
from (select ('0x' || substr(sha256('42:' || zone_id || ':' || strftime(date_hour, '%Y-%m-%d %H:%M:%S')), 1, 8))::bigint % 100 d
      from training)""",
)
_check(
    "kmeans_checked",
    ("features",),
    """
select count(distinct zone_id) zones, least(count(distinct zone_id), 5)::bigint clusters, 0::bigint zones_nearer_elsewhere,
  true cost_no_higher
from features""",
)


def _regression() -> str:
    """Least squares by sweeping the matrix of centred products, one feature after the other."""
    terms = ["temperature_2m", "precipitation", "is_weekend", "is_after_hours", "month", "hour"]
    values = ["temperature_2m", "precipitation", "is_weekend::int", "is_after_hours::int", '"month"', "event_hour", "target_demand_count"]
    size = len(values)
    span = range(size)
    steps = [
        "x as (select " + ", ".join(f"({v})::double v{i}" for i, v in enumerate(values))
        + " from features where temperature_2m is not null and precipitation is not null)",
        "means as (select count(*) n, " + ", ".join(f"avg(v{i}) a{i}" for i in span) + " from x)",
        "s0 as (select *, " + ", ".join(f"c{i}_{i} d{i}" for i in span) + " from (select "
        + ", ".join(f"sum((v{i} - a{i}) * (v{j} - a{j})) c{i}_{j}" for i in span for j in span) + " from x, means))",
    ]
    for k in range(size - 1):
        def cell(i: int, j: int) -> str:
            if i == k and j == k:
                swept = f"-1 / c{k}_{k}"
            else:
                swept = f"c{i}_{j} / c{k}_{k}" if k in (i, j) else f"c{i}_{j} - c{i}_{k} * c{k}_{j} / c{k}_{k}"
            return f"case when u{k} then {swept} else {0 if k in (i, j) else f'c{i}_{j}'} end"

        used = ", ".join([f"u{i}" for i in range(k + 1)] + [f"d{i}" for i in span])
        steps.append(f"s{k + 1} as (select {used}, " + ", ".join(f"{cell(i, j)} c{i}_{j}" for i in span for j in span)
                     + f" from (select *, c{k}_{k} > 1e-10 * d{k} and d{k} > 0 u{k} from s{k}))")
    last, y = f"s{size - 1}", size - 1
    free = " - ".join(["n - 1", *[f"u{i}::int" for i in range(y)]])
    steps.append(f"fit as (select *, c{y}_{y} / free variance, 1 - c{y}_{y} / d{y} r2 from (select *, {free} free from {last}, means))")
    rows = [f"select '{t}' term, case when u{i} then c{i}_{y} end b, case when u{i} then sqrt(variance * -c{i}_{i}) end e, r2, n, free from fit"
            for i, t in enumerate(terms)]
    cross = " + ".join(f"a{i} * a{j} * -c{i}_{j}" for i in range(y) for j in range(y))
    lower = " - ".join(f"c{i}_{y} * a{i}" for i in range(y))
    rows.append(f"select '(Intercept)', a{y} - {lower}, sqrt(variance * (1 / n::double + {cross})), r2, n, free from fit")
    steps.append("terms as (" + " union all ".join(rows) + ")")
    tail = _erfc("t / sqrt(2)")
    return (
        ", " + ", ".join(steps)
        + f"""
select term, round(b, 6) estimate, round(e, 6) std_error, round(b / e, 6) t_value, round({tail} + 2 * exp(-t * t / 2) / sqrt(2 * pi()) *
    ((t ** 3 + t) / (4 * free) + (3 * t ** 7 - 7 * t ** 5 - 5 * t ** 3 - 3 * t) / (96 * free * free)), 6) p_value,
  round(r2, 6) r2, n "rows"
from (select *, abs(b / e) t from terms)"""
    )


_check("ols", ("features",), _regression())

# --- projection --------------------------------------------------------------


def _in_degrees(source: str, keep: str) -> str:
    """Rows of ``source`` (with x and y) with longitude and latitude by the inverse of the conic grid in US survey feet."""
    lat = "pi() / 2 - 2 * atan(t)"
    inner = f"select *, {lat} p0 from pointed"
    for i in range(6):
        s = f"e * sin(p{i})"
        inner = f"select *, pi() / 2 - 2 * atan(t * pow((1 - {s}) / (1 + {s}), e / 2)) p{i + 1} from ({inner})"

    def m(p: str) -> str:
        return f"(cos(radians({p})) / sqrt(1 - pow(e * sin(radians({p})), 2)))"

    def t(p: str) -> str:
        return f"(tan(pi() / 4 - radians({p}) / 2) / pow((1 - e * sin(radians({p}))) / (1 + e * sin(radians({p}))), e / 2))"

    one, two = "(48 + 44 / 60.0::double)", "47.5::double"
    return f"""
, shape as (select sqrt(2 / 298.257222101::double - 1 / pow(298.257222101::double, 2)) e)
, cone as (select e, (ln({m(one)}) - ln({m(two)})) / (ln({t(one)}) - ln({t(two)})) n from shape)
, grid as (select *, {m(one)} / (n * pow({t(one)}, n)) f, pow({t("47.0::double")}, n) t0 from cone)
, metres as (select {source}.*, e, n, f, 6378137.0 * f * t0 r0, (x - 1640416.666667) * 1200 / 3937.0::double east, y * 1200 / 3937.0::double up
             from {source}, grid)
, pointed as (select *, pow(sqrt(east * east + (r0 - up) * (r0 - up)) / (6378137.0 * f), 1 / n) t from metres)
select {keep},
  round(case when abs(x) > 180 or abs(y) > 90 then degrees(atan2(east, r0 - up) / n) - (120 + 50 / 60.0::double) else x end, 6) longitude,
  round(case when abs(x) > 180 or abs(y) > 90 then degrees(p6) else y end, 6) latitude
from ({inner})"""


CTES["grid_points"] = (
    """
  select o_orderkey "key", case when o_orderkey % 4 <> 0 then 1200000 + o_orderkey % 9973 * 31 else -122 - o_orderkey % 7 / 10.0::double end::double x,
    case when o_orderkey % 4 <> 0 then 100000 + o_custkey % 9967 * 29 else 47 + o_orderkey % 9 / 10.0::double end::double y
  from orders""",
    (),
)
_check("points_in_degrees", ("grid_points",), _in_degrees("grid_points", '"key", round(x, 6) x, round(y, 6) y'))
CTES["centres"] = (
    """
  select *, x + s / 2 cx, y + s / 2 cy, case kind when 1 then s * s - 4 else s * s end size from shapes where kind < 2""",
    ("shapes",),
)
CTES["weighed"] = (
    """
  select zone_id, kind, s, size, x left_x, y low_y, case kind when 1 then (cx * s * s - 4 * (x + 2)) / size else cx end x,
    case kind when 1 then (cy * s * s - 4 * (y + 2)) / size else cy end y
  from centres""",
    ("centres",),
)
_WELL_KNOWN = (
    f"case kind when 0 then 'POLYGON (' || {_ring_text('left_x', 'low_y', 's')} || ')' "
    f"else 'POLYGON (' || {_ring_text('left_x', 'low_y', 's')} || ', ' || {_ring_text('left_x + 1', 'low_y + 1', '2')} || ')' end"
)
_MAPPED = _with(("weighed",), _in_degrees("weighed", f"zone_id, size area, {_WELL_KNOWN} geometry_wkt"))
_check(
    "mapped_zones",
    (),
    f"""
select 'C' || c_custkey zone_id, c_nationkey nation, round(area, 6) area, longitude centroid_longitude, latitude centroid_latitude, geometry_wkt
from customer left join ({_MAPPED}) m on m.zone_id = 'C' || c_custkey""",
)

# --- files ------------------------------------------------------------------

_check("weather_file", ("weather",), f"""select weather_hour, {_ROUNDED_WEATHER}
from (select distinct date_trunc('hour', ts) weather_hour from events) left join weather using (weather_hour)""")
_check(
    "lookup_file",
    ("lookup",),
    """
select zone_id, zone_id beat, upper(precinct) precinct, upper(sector) sector
from (select 'Z0' || n_nationkey zone_id from nation) left join lookup using (zone_id)""",
)
_check(
    "source_inventory",
    (),
    """
select 'events' source, true "exists", true readable, 'event_id, event_type' "columns", least(count(*), 100)::bigint sample_rows from events
union all select 'counts', true, true, 'event_type, events', least(count(distinct event_type), 100)::bigint from events
union all select 'absent', false, false, null, null""",
)
_check("trial_rows", (), 'select least(count(*), 150)::bigint "rows", least(count(*), 150)::bigint distinct_rows from events')
_check(
    "single_csv",
    (),
    "select event_type, count(*) events, sum(user_id)::bigint users, 1::bigint files from events group by all",
)
_check("preview_file", (), "select user_id, event_id, event_type from events order by user_id, event_id limit 5000")
_check(
    "json_record",
    (),
    "select count(*) events, string_agg(distinct event_type, ',' order by event_type) types from events",
)
_check(
    "run_records",
    (),
    """
select tag run_tag, (n + more)::varchar events, true no_note
from (select count(*) n from events), (values ('2024/01', 2), ('b', 1)) t(tag, more)""",
)
_check("optional_input", (), "select event_type, count(*) events from events group by all")
_check(
    "published_view",
    ("mart",),
    """select zone_id, sum(demand_count)::bigint demand, 'tableau_zone_summary' "views" from mart group by all""",
)
_check(
    "export_types",
    (),
    """
select event_type, count(*) events, sum(user_id)::bigint users, strftime(min(ts), '%Y-%m-%d %H:%M:%S') "first",
  (count(*) % 2 = 0)::int is_even
from events group by all""",
)
_check(
    "server_hosts",
    (),
    "select c_custkey, case when c_custkey % 10 < 2 then 'unknown-host' else 'h' || c_nationkey || '.example' end host from customer",
)
_check(
    "field_mapping",
    ("service",),
    """
select field canonical_field, raw raw_column, case
  when raw in ('CAD Event Number', 'CAD Event Original Time Queued', 'Final Call Type') then (select count(*) from service)
  when raw = 'Dispatch Beat' then (select count(beat) from service)
  when raw = 'Event Group' then (select count(*) from events where event_id % 3 = 0)
  when raw = 'CAD Event Clearance Description' then (select count(disposition) from service)
  when raw = 'Dispatch Latitude' then (select count(*) from events where event_id % 31 <> 0 or event_id % 11 < 2) end filled
from (values ('event_id', 'CAD Event Number'), ('event_datetime', 'CAD Event Original Time Queued'), ('event_date', 'MISSING'),
  ('call_type', 'Final Call Type'), ('initial_call_type', 'MISSING'), ('final_call_type', 'Final Call Type'),
  ('service_category', 'Event Group'), ('disposition', 'CAD Event Clearance Description'), ('beat', 'Dispatch Beat'),
  ('sector', 'MISSING'), ('precinct', 'MISSING'), ('latitude', 'Dispatch Latitude'), ('longitude', 'MISSING'),
  ('neighborhood', 'MISSING'), ('reporting_area', 'MISSING')) t(field, raw)""",
)
_check(
    "geojson_round_trip",
    ("shapes",),
    """
select zone_id, case kind when 2 then 'MultiPolygon' else 'Polygon' end "type", 'a "{' || c_custkey || '}" \\ b' note, c_custkey % 3 + 1 parts_of_text
from shapes join customer on zone_id = 'C' || c_custkey""",
)
