"""DuckDB oracle SQL for the correctness check.

Each model is written once as DuckDB SQL from its rules, independent of the
Spark code (QUALIFY, correlated frames, the plain nearest-rate join).
``normalized(names, select)`` prefixes the CTEs a query needs, in dependency
order.

Comparison conventions shared with ``__spark_entry__._normalize``: NUMERIC
columns are compared exactly, as text with 9 digits; doubles are rounded to 6
digits; integers BIGINT; timestamps zoneless UTC.
"""

from __future__ import annotations

# --- raw landing tables from the driver tables (FIXTURES.md section B) ---
RAW = {
    "raw_transactions": ("""
select cast(e.event_id as varchar) trans_num, cast(e.user_id as varchar) user_id,
 strftime(e.ts + to_seconds(dup),'%Y-%m-%d %H:%M:%S') trans_date_trans_time,
 concat('fraud_', s.s_name) merchant, e.event_type category,
 epoch_us(e.ts)//1000000 + dup unix_time, e.value original_amt,
 (['dkk','NOK','SEK','eur','USD'])[e.event_id % 5 + 1] currency,
 case when e.event_type='error' then 1 else 0 end is_fraud
from (select *, 0 dup from events union all select *, 1 dup from events where event_id % 10 = 0) e
cross join (select count(*) n from supplier) c
join supplier s on s.s_suppkey = (e.event_id * 7 + e.user_id) % c.n""", []),
    "raw_fx_rates": ("""
select strftime(ts,'%Y-%m-%dT%H:%M:%S.%fZ') "timestamp", 'usd' base_currency,
 (['DKK','nok','SEK','EUR'])[event_id % 4 + 1] currency, 0.5::double + value/100 rate
from events""", []),
    "raw_users": ("""
select e.ts + interval 1 minute _airbyte_emitted_at,
 case when e.event_id % 17 = 0 then null else strftime(e.ts,'%Y-%m-%dT%H:%M:%S.%f')||'+00:00' end _ab_cdc_updated_at,
 cast(e.user_id as varchar) user_id, 'Customer' first_name, right(c.c_name,9) last_name,
 (['M','f','X'])[e.user_id % 3 + 1] gender, concat('Street ', e.user_id) street, n.n_name city,
 case when e.event_id % 7 = 0 then 0 else 10000 + e.event_id % 90000 end zip, c.c_acctbal/1000 lat, -c.c_acctbal/500 "long",
 case when e.user_id % 11 = 0 then {'member0': null::varchar, 'member1': null::varchar}
      when e.user_id % 2 = 0 then {'member0': (date '1950-01-01' + ((e.user_id*37) % 20000)::int)::varchar, 'member1': null::varchar}
      else {'member0': null::varchar, 'member1': (date '1950-01-01' + ((e.user_id*37) % 20000)::int)::varchar} end dob,
 json_extract_string(e.props,'$.k') job
from (select * from events union all select * from events where event_id % 9 = 0) e
join customer c on c.c_custkey=e.user_id join nation n on n.n_nationkey=c.c_nationkey
where e.event_type='signup'""", []),
    "raw_merchants": ("""
select timestamp '2024-01-01 00:00:00' _airbyte_emitted_at, concat('fraud_', s_name) merchant,
 s_acctbal/200 merch_lat, case when s_suppkey % 9 = 0 then null else -s_acctbal/100 end merch_long,
 case when s_suppkey % 8 = 0 then 0 else 10000 + s_suppkey end merch_zipcode
from supplier""", []),
}

# exact NUMERIC division a / r, rounded once half away from zero to ``scale``
# digits (DuckDB divides decimals in DOUBLE, so the quotient is formed on
# integers: both operands have at most 9 decimals)
_A = "cast(cast({a} as decimal(38,9)) * 1000000000 as hugeint)"
_R = "cast(cast({r} as decimal(38,9)) * 1000000000 as hugeint)"


def numeric_div(a: str, r: str, scale: int = 9) -> str:
    A, R = _A.format(a=a), _R.format(r=r)
    p = 10 ** scale
    q = f"((2 * abs({A}) * {p} + abs({R})) // (2 * abs({R})))"
    sign = f"(case when sign({A}) * sign({R}) < 0 then '-' else '' end)"
    return (f"cast({sign} || cast({q} // {p} as varchar) || '.' || "
            f"lpad(cast({q} % {p} as varchar), {scale}, '0') as decimal(38,{scale}))")


def exact_avg(x: str, over: str = "") -> str:
    """AVG of a NUMERIC: sum / count rounded once, half away from zero, to 9 digits."""
    s, n = f"sum({x}){over}", f"count({x}){over}"
    return f"(case when {n} = 0 then null else {numeric_div(s, n, 9)} end)"


MODELS = {
    "stg_transactions": ("""
select * from (
  select cast(user_id as varchar) user_id, cast(trans_num as varchar) transaction_id,
    try_cast(trans_date_trans_time as timestamp) transaction_datetime_UTC,
    regexp_replace(merchant, '^fraud_', '') merchant_name,
    try_cast(unix_time as bigint) unix_time_seconds,
    try_cast(original_amt as decimal(28,9)) original_amount,
    upper(currency) currency,
    try_cast(is_fraud as boolean) is_fraud,
    category
  from raw_transactions)
qualify row_number() over (partition by transaction_id
  order by transaction_datetime_UTC desc nulls last, unix_time_seconds desc nulls last) = 1""",
                         ["raw_transactions"]),
    "stg_fx_rates": ("""
select timezone('UTC', try_cast("timestamp" as timestamptz)) datetime_fetched_UTC,
  upper(base_currency) base_currency, upper(currency) transaction_currency,
  try_cast(rate as decimal(18,9)) rate
from raw_fx_rates""", ["raw_fx_rates"]),
    "stg_merchants": ("""
select _airbyte_emitted_at raw_loaded_at, regexp_replace(merchant, '^fraud_', '') merchant_name,
  try_cast(merch_lat as double) merchant_latitude, try_cast(merch_long as double) merchant_longitude,
  nullif(try_cast(merch_zipcode as bigint), 0) merchant_zipcode
from raw_merchants""", ["raw_merchants"]),
    "stg_users_changes": ("""
select _airbyte_emitted_at raw_loaded_at,
  case when regexp_full_match(_ab_cdc_updated_at, '[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]+)?[+-][0-9]{2}:[0-9]{2}')
       then timezone('UTC', try_cast(_ab_cdc_updated_at as timestamptz)) end updated_at,
  cast(user_id as varchar) user_id, first_name, last_name,
  case when upper(gender) = 'M' then 'Male' when upper(gender) = 'F' then 'Female' else null end gender,
  street address, city city_name, nullif(try_cast(zip as bigint), 0) zip_code,
  try_cast(lat as double) latitude, try_cast("long" as double) longitude,
  coalesce(try_cast(dob.member0 as date), try_cast(dob.member1 as date)) date_of_birth,
  job
from raw_users""", ["raw_users"]),
    "stg_users_latest": ("""
select * from stg_users_changes
qualify row_number() over (partition by user_id order by updated_at desc nulls last,
  raw_loaded_at desc nulls last) = 1""", ["stg_users_changes"]),
    "int_transactions_fx_enriched": (f"""
select *, case when currency = 'USD' then cast(original_amount as decimal(38,9))
  when fx_rate_to_currency is null or fx_rate_to_currency = 0 then null
  else {numeric_div('original_amount', 'fx_rate_to_currency')} end amount_usd
from (
  select tx.*, fx.rate fx_rate_to_currency, fx.datetime_fetched_UTC fx_rate_timestamp_UTC
  from stg_transactions tx
  left join (select * from stg_fx_rates where datetime_fetched_UTC is not null) fx
    on tx.currency = fx.transaction_currency
  qualify row_number() over (partition by tx.transaction_id order by
    abs(trunc((epoch_us(tx.transaction_datetime_UTC) - epoch_us(fx.datetime_fetched_UTC)) / 1000000.0)) asc nulls first,
    fx.datetime_fetched_UTC desc nulls last) = 1)""", ["stg_transactions", "stg_fx_rates"]),
    "dim_date": ("""
select row_number() over (order by day_date) date_key, day_date date_day,
  year(day_date) year_number, quarter(day_date) quarter_number, month(day_date) month_number,
  strftime(day_date, '%B') month_name, weekofyear(day_date) iso_week_number,
  day(day_date) day_of_month, dayofweek(day_date) + 1 day_of_week, strftime(day_date, '%A') day_name,
  isoyear(day_date) iso_year_number
from (select unnest(generate_series(min_date, max_date, interval 1 day))::date day_date
      from (select min(cast(transaction_datetime_UTC as date)) min_date,
                   max(cast(transaction_datetime_UTC as date)) max_date from stg_transactions)
      where min_date is not null)""", ["stg_transactions"]),
    "dim_time": ("""
select h * 10000 + m * 100 + s time_key, printf('%02d:%02d:%02d', h, m, s) time_of_day,
  h hour_24, m minute_number, s second_number, printf('%02d:00-%02d:59', h, h) hour_bucket,
  case when h between 0 and 5 then 'Night' when h between 6 and 11 then 'Morning'
       when h between 12 and 17 then 'Afternoon' else 'Evening' end part_of_day,
  case when h between 9 and 16 then true else false end is_business_hours
from (select sec // 3600 h, (sec % 3600) // 60 m, sec % 60 s from range(86400) t(sec))""", []),
    "dim_merchants": ("""
select merchant_name, merchant_latitude, merchant_longitude, merchant_zipcode, raw_loaded_at
from stg_merchants""", ["stg_merchants"]),
    "dim_users_history": ("""
select md5(cast(user_id as varchar) || '|' || strftime(valid_from, '%Y-%m-%d %H:%M:%S.%f')) user_version_id,
  user_id, first_name, last_name,
  nullif(trim(coalesce(first_name, '') || ' ' || coalesce(last_name, '')), '') full_name,
  gender, address, city_name, zip_code, latitude, longitude, date_of_birth, job, updated_at, raw_loaded_at,
  valid_from dbt_valid_from, valid_to dbt_valid_to
from (
  select *, lead(valid_from) over (partition by user_id order by valid_from, raw_loaded_at) valid_to
  from (select *, coalesce(updated_at, raw_loaded_at) valid_from from stg_users_changes
        where user_id is not null and coalesce(updated_at, raw_loaded_at) is not null))""",
                          ["stg_users_changes"]),
    "dim_users_current": ("""
select user_version_id, user_id, first_name, last_name, full_name, gender, address, city_name, zip_code,
  latitude, longitude, date_of_birth, job, updated_at, raw_loaded_at, dbt_valid_from
from dim_users_history where dbt_valid_to is null""", ["dim_users_history"]),
    "fct_transactions": ("""
select tx.transaction_id, tx.user_id, uh.user_version_id, tx.merchant_name, dd.date_key,
  hour(tx.transaction_datetime_UTC) * 10000 + minute(tx.transaction_datetime_UTC) * 100
    + second(tx.transaction_datetime_UTC) time_key,
  tx.transaction_datetime_UTC, tx.unix_time_seconds, tx.currency, tx.original_amount,
  tx.fx_rate_to_currency, tx.fx_rate_timestamp_UTC, tx.amount_usd, tx.is_fraud
from int_transactions_fx_enriched tx
left join dim_users_history uh on tx.user_id = uh.user_id
  and tx.transaction_datetime_UTC >= uh.dbt_valid_from
  and tx.transaction_datetime_UTC < coalesce(uh.dbt_valid_to, timestamp '9999-12-31')
left join dim_date dd on cast(tx.transaction_datetime_UTC as date) = dd.date_day""",
                         ["int_transactions_fx_enriched", "dim_users_history", "dim_date"]),
}

KPI = f"""count(*) txn_count, cast(count_if(is_fraud) as bigint) fraud_txn_count,
  case when count(*) = 0 then null else count_if(is_fraud) / count(*) end fraud_rate,
  sum(coalesce(amount_usd, 0)) amount_usd_total, {exact_avg('amount_usd')} amount_usd_avg,
  sum(case when is_fraud then coalesce(amount_usd, 0) else 0 end) amount_usd_fraud_total"""

MODELS.update({
    "mart_kpi_daily": (f"""
select date_key, {KPI}, count(distinct user_id) distinct_users, count(distinct merchant_name) distinct_merchants
from fct_transactions group by date_key""", ["fct_transactions"]),
    "mart_kpi_hourly": (f"""
select date_key, time_key, {KPI}, count(distinct user_id) distinct_users,
  count(distinct merchant_name) distinct_merchants
from (select tx.*, dt.hour_24 from fct_transactions tx left join dim_time dt on tx.time_key = dt.time_key)
group by date_key, time_key""", ["fct_transactions", "dim_time"]),
    "mart_kpi_user_daily": (f"""
select date_key, user_id, md5(cast(date_key as varchar) || '|' || cast(user_id as varchar)) date_user_key,
  {KPI}, count(distinct merchant_name) distinct_merchants
from fct_transactions group by date_key, user_id""", ["fct_transactions"]),
    "mart_kpi_merchant_daily": (f"""
select date_key, merchant_name,
  md5(cast(date_key as varchar) || '|' || cast(merchant_name as varchar)) date_merchant_key,
  {KPI}, count(distinct user_id) distinct_users
from fct_transactions group by date_key, merchant_name""", ["fct_transactions"]),
    "mart_kpi_merchant_overall": (f"""
select merchant_name, {KPI}, count(distinct user_id) distinct_users,
  min(date_key) first_date_key, max(date_key) last_date_key
from fct_transactions group by merchant_name""", ["fct_transactions"]),
    "mart_kpi_currency_daily": (f"""
select date_key, currency, md5(cast(date_key as varchar) || '|' || cast(currency as varchar)) date_currency_key,
  {KPI}, count(distinct user_id) distinct_users, count(distinct merchant_name) distinct_merchants
from fct_transactions group by date_key, currency""", ["fct_transactions"]),
    "mart_kpi_user_segments_daily": (f"""
select date_key, gender, age_band,
  md5(cast(date_key as varchar) || '|' || cast(gender as varchar) || '|' || cast(age_band as varchar))
    date_user_segment_key,
  {KPI}, count(distinct user_id) distinct_users, count(distinct merchant_name) distinct_merchants
from (
  select tx.date_key, tx.transaction_id, tx.user_id, tx.merchant_name, tx.amount_usd, tx.is_fraud,
    coalesce(du.gender, 'Unknown') gender,
    case when du.date_of_birth is null then 'Unknown'
      when date_diff('year', du.date_of_birth, dd.date_day) < 25 then '<25'
      when date_diff('year', du.date_of_birth, dd.date_day) between 25 and 34 then '25-34'
      when date_diff('year', du.date_of_birth, dd.date_day) between 35 and 44 then '35-44'
      when date_diff('year', du.date_of_birth, dd.date_day) between 45 and 54 then '45-54'
      else '55+' end age_band
  from fct_transactions tx
  left join dim_date dd on tx.date_key = dd.date_key
  left join dim_users_current du on tx.user_id = du.user_id)
group by date_key, gender, age_band""", ["fct_transactions", "dim_date", "dim_users_current"]),
})


def _frame(keys: str, width: int) -> str:
    return (f" over (partition by {keys} order by unix_time_seconds "
            f"range between {width} preceding and 1 preceding)")


def _rolling(agg: str, keys: str, width: int) -> str:
    if agg == "avg(original_amount)":
        return exact_avg("original_amount", _frame(keys, width))
    return agg + _frame(keys, width)


def _recency(keys: str) -> str:
    return (f"cast(trunc((epoch_us(event_ts) - epoch_us(lag(event_ts) over (partition by {keys} "
            f"order by event_ts, transaction_id))) / 1000000.0) as bigint)")


MODELS["fraud_features"] = (f"""
select transaction_id, user_id, merchant_name, transaction_datetime_UTC, unix_time_seconds, is_fraud,
  original_amount, ln(1 + cast(original_amount as double)) amount_log1p_original,
  year_number, quarter_number, month_number, iso_week_number, day_of_week, day_name,
  hour_24, part_of_day, is_business_hours, is_weekend,
  merchant_latitude, merchant_longitude, merchant_zipcode, has_merchant_geo,
  {_recency('user_id')} user_recency_seconds,
  {_recency('merchant_name')} merchant_recency_seconds,
  {_recency('user_id, merchant_name')} user_merchant_recency_seconds,
  {_rolling('count(*)', 'user_id', 86400)} user_txn_count_24h,
  {_rolling('count(*)', 'user_id', 2592000)} user_txn_count_30d,
  {_rolling('sum(original_amount)', 'user_id', 86400)} user_original_amount_sum_24h,
  {_rolling('avg(original_amount)', 'user_id', 86400)} user_original_amount_avg_24h,
  {_rolling('max(original_amount)', 'user_id', 86400)} user_original_amount_max_24h,
  {_rolling('sum(original_amount)', 'user_id', 2592000)} user_original_amount_sum_30d,
  {_rolling('avg(original_amount)', 'user_id', 2592000)} user_original_amount_avg_30d,
  {_rolling('max(original_amount)', 'user_id', 2592000)} user_original_amount_max_30d,
  {_rolling('count(*)', 'merchant_name', 2592000)} merchant_txn_count_30d,
  {_rolling('avg(original_amount)', 'merchant_name', 2592000)} merchant_original_amount_avg_30d,
  {_rolling('count(*)', 'user_id, merchant_name', 2592000)} user_merchant_txn_count_30d,
  {_rolling('avg(original_amount)', 'user_id, merchant_name', 2592000)} user_merchant_original_amount_avg_30d
from (
  select b.*, d.year_number, d.quarter_number, d.month_number, d.iso_week_number, d.day_of_week, d.day_name,
    t.hour_24, t.part_of_day, t.is_business_hours, (d.day_of_week in (1, 7)) is_weekend,
    m.merchant_latitude, m.merchant_longitude, m.merchant_zipcode,
    (m.merchant_latitude is not null and m.merchant_longitude is not null) has_merchant_geo
  from (select transaction_id, user_id, merchant_name, transaction_datetime_UTC,
          transaction_datetime_UTC event_ts, unix_time_seconds, date_key, time_key, original_amount, is_fraud
        from fct_transactions) b
  left join dim_date d on b.date_key = d.date_key
  left join dim_time t on b.time_key = t.time_key
  left join dim_merchants m on b.merchant_name = m.merchant_name)""",
                            ["fct_transactions", "dim_date", "dim_time", "dim_merchants"])

# JN2 from its rule alone: a change row holds from its time until the next later
# one of the user; of rows with one time the last landed holds (equal rows are
# one).  No window: the successor is a minimum over a self-join.
SCD2_JOIN = """
select * from (with c as (select distinct *, coalesce(updated_at, raw_loaded_at) since from stg_users_changes
  where user_id is not null and coalesce(updated_at, raw_loaded_at) is not null),
l as (select user_id, since, max(raw_loaded_at) loaded from c group by user_id, since),
v as (select a.user_id, a.since, min(b.since) until, a.loaded from l a left join l b on a.user_id = b.user_id and b.since > a.since
  group by all)
select t.transaction_id, t.user_id, t.transaction_datetime_UTC,
  case when v.since is not null then md5(t.user_id || '|' || strftime(v.since, '%Y-%m-%d %H:%M:%S.%f')) end user_version_id,
  v.since dbt_valid_from, v.until dbt_valid_to, c.job
from stg_transactions t
left join v on t.user_id = v.user_id and t.transaction_datetime_UTC >= v.since
  and (v.until is null or t.transaction_datetime_UTC < v.until)
left join c on c.user_id = v.user_id and c.since = v.since and c.raw_loaded_at = v.loaded)"""

MODELS["fraud_features_serving"] = ("select * exclude (is_fraud) from fraud_features", ["fraud_features"])

ALL = {**RAW, **MODELS}


def _order(names: list[str]) -> list[str]:
    seen: list[str] = []

    def visit(n):
        if n in seen:
            return
        for d in ALL[n][1]:
            visit(d)
        seen.append(n)

    for n in names:
        visit(n)
    return seen


def with_models(names: list[str], body: str) -> str:
    ctes = ",\n".join(f"{n} as ({ALL[n][0]}\n)" for n in _order(names))
    return f"with {ctes}\n{body}"


DOUBLES = {"merchant_latitude", "merchant_longitude", "latitude", "longitude", "lat", "long", "merch_lat", "merch_long",
           "fraud_rate", "fraud_rate_avg", "fraud_amount_share", "fraud_rate_amount", "fraud_rate_by_merchant",
           "amount_log1p_original", "log1p_amount", "safe_ratio", "original_amt", "amt", "amount"}


def normalized(names: list[str], body: str, floats: list[str] = (), ints: list[str] = ()) -> str:
    """``body`` over the models, with the compare conventions applied: NUMERIC
    columns as text with 9 digits, doubles (known names, or marked ``:double``)
    rounded to 6."""
    doubles = DOUBLES | {c.removesuffix(":double") for c in floats if c.endswith(":double")}
    floats = [c.removesuffix(":double") for c in floats]
    repl = [f"cast(round(try_cast({c} as decimal(38,13)), 6) as double) as {c}" if c in doubles else
            f"cast(cast({c} as decimal(38,9)) as varchar) as {c}" for c in floats]
    repl += [f"cast({c} as bigint) as {c}" for c in ints]
    outer = f"select * replace ({', '.join(repl)}) from (\n{body}\n)" if repl else body
    return with_models(names, outer)


# --- data tests (dbt generic-test SQL shapes) ---------------------------------
def dq_suite_sql(checks) -> str:
    parts, models = [], set()
    for c in checks:
        models.add(c.model)
        lit = f"'{c.model}' model, '{c.column}' column_name, '{c.test}' test_name"
        col = f'"{c.column}"'
        if c.test == "not_null":
            q = f"select {lit}, count(*) failing_rows from {c.model} where {col} is null"
        elif c.test == "accepted_values":
            vals = ", ".join(f"'{v}'" for v in c.values)
            q = (f"select {lit}, count(*) failing_rows from (select {col} from {c.model} group by {col}) "
                 f"where {col} not in ({vals})")
        elif c.test == "unique":
            q = (f"select {lit}, count(*) failing_rows from (select {col} from {c.model} where {col} is not null "
                 f"group by {col} having count(*) > 1)")
        else:
            models.add(c.to_model)
            q = (f"select {lit}, count(*) failing_rows from {c.model} child left join {c.to_model} parent "
                 f"on child.{col} = parent.\"{c.to_field}\" where child.{col} is not null "
                 f"and parent.\"{c.to_field}\" is null")
        parts.append(q)
    body = "select *, failing_rows = 0 passed from (\n" + "\nunion all\n".join(parts) + ")"
    return with_models(sorted(models), body)


# --- report queries (visual + measure definitions) -----------------------------
REPORTS = {
    "rp01_by_currency": (["mart_kpi_currency_daily"], """
select currency, sum(amount_usd_total) amount_usd_total, avg(fraud_rate) fraud_rate_avg,
  sum(amount_usd_fraud_total) amount_usd_fraud_total
from mart_kpi_currency_daily group by currency""", ["amount_usd_total", "fraud_rate_avg", "amount_usd_fraud_total"]),
    "rp02_merchant_map": (["mart_kpi_merchant_overall", "dim_merchants"], """
select d.merchant_longitude, d.merchant_latitude, sum(m.amount_usd_total) amount_usd_total
from mart_kpi_merchant_overall m left join dim_merchants d on m.merchant_name = d.merchant_name
group by d.merchant_longitude, d.merchant_latitude""", ["merchant_longitude", "merchant_latitude", "amount_usd_total"]),
    "rp03_by_hour": (["mart_kpi_hourly", "dim_time"], """
select t.hour_24, sum(h.amount_usd_total) amount_usd_total, sum(h.amount_usd_fraud_total) amount_usd_fraud_total
from mart_kpi_hourly h left join dim_time t on h.time_key = t.time_key group by t.hour_24""",
                     ["amount_usd_total", "amount_usd_fraud_total"]),
    "rp04_fraud_share_by_part_of_day": (["mart_kpi_hourly", "dim_time"], """
select part_of_day, amount_usd_fraud_total,
  cast(amount_usd_fraud_total as double) / nullif(sum(cast(amount_usd_fraud_total as double)) over (), 0) fraud_amount_share
from (select t.part_of_day, sum(h.amount_usd_fraud_total) amount_usd_fraud_total
      from mart_kpi_hourly h left join dim_time t on h.time_key = t.time_key group by t.part_of_day)""",
                                        ["amount_usd_fraud_total", "fraud_amount_share"]),
    "rp05_fraud_rate_card": (["mart_kpi_daily"], """
select cast(sum(amount_usd_fraud_total) as double) / nullif(cast(sum(amount_usd_total) as double), 0) fraud_rate_amount
from mart_kpi_daily""", ["fraud_rate_amount"]),
    "rp06_distinct_by_currency": (["mart_kpi_currency_daily"], """
select currency, cast(sum(distinct_users) as bigint) distinct_users,
  cast(sum(distinct_merchants) as bigint) distinct_merchants
from mart_kpi_currency_daily group by currency""", []),
    "rp07_daily_by_currency": (["mart_kpi_currency_daily", "dim_date"], """
select d.date_day, c.currency, sum(c.amount_usd_total) amount_usd_total
from mart_kpi_currency_daily c left join dim_date d on c.date_key = d.date_key
group by d.date_day, c.currency""", ["amount_usd_total"]),
    "rp08_fraud_rate_by_merchant": (["mart_kpi_merchant_overall"], """
select merchant_name,
  cast(sum(amount_usd_fraud_total) as double) / nullif(cast(sum(amount_usd_total) as double), 0) fraud_rate_by_merchant
from mart_kpi_merchant_overall group by merchant_name""", ["fraud_rate_by_merchant"]),
}


# --- ingest-side jobs -----------------------------------------------------------
def uuid5_sql(name: str) -> str:
    h = f"sha1(unhex('6ba7b8109dad11d180b400c04fd430c8') || encode({name}))"
    return (f"(substr({h},1,8) || '-' || substr({h},9,4) || '-5' || substr({h},14,3) || '-' || "
            f"lower(printf('%x', ((('0x' || substr({h},17,1))::int) & 3) | 8)) || substr({h},18,3) || '-' || "
            f"substr({h},21,12))")


INGEST = {
    "wide_export": (r"""
select strftime(e.ts, '%Y-%m-%d %H:%M:%S') trans_date_trans_time, concat('fraud_', s.s_name) merchant,
  e.event_type category, e.value amt, ' Customer' "first", right(c.c_name, 9) "last",
  case when e.user_id % 2 = 0 then 'M' else 'F' end gender, concat('Street ', e.user_id,
    case when e.user_id % 5 = 0 then ' "a; b", c' || chr(10) || '\d "" \' else '' end) street, n.n_name city,
  cast(10000 + e.user_id as bigint) zip, c.c_acctbal/1000 lat, -c.c_acctbal/500 "long",
  case when e.user_id % 7 = 0 then '' else 'Engineer' end job,
  cast(date '1950-01-01' + ((e.user_id*37) % 20000)::int as varchar) dob, cast(e.event_id as varchar) trans_num,
  epoch_us(e.ts)//1000000 unix_time, cast(case when e.event_type='error' then 1 else 0 end as bigint) is_fraud,
  s.s_acctbal/200 merch_lat, -s.s_acctbal/100 merch_long,
  case when s.s_suppkey % 8 = 0 then null else cast(10000 + s.s_suppkey as double) end merch_zipcode
from events e cross join (select count(*) n from supplier) cn
join supplier s on s.s_suppkey = (e.event_id * 7 + e.user_id) % cn.n
left join customer c on c.c_custkey = e.user_id left join nation n on n.n_nationkey = c.c_nationkey""", []),
    "wide_keyed": (f"""
select * exclude ("first", "last", merch_zipcode),
  {uuid5_sql("lower(trim(\"first\")) || '|' || lower(trim(\"last\"))")} user_id,
  "first" first_name, "last" last_name, cast(coalesce(merch_zipcode, 0) as bigint) merch_zipcode
from wide_export""", ["wide_export"]),
    "split_events": ("""
select trans_date_trans_time, user_id, merchant, category, amt, trans_num, unix_time, is_fraud
from wide_keyed""", ["wide_keyed"]),
    "split_users": ("""
select user_id, first_name, last_name, gender, street, city, zip, lat, "long", job, dob from wide_keyed
qualify row_number() over (partition by user_id order by unix_time, trans_num) = 1""", ["wide_keyed"]),
    "split_merchants": ("""
select merchant, merch_lat, merch_long, merch_zipcode from wide_keyed
qualify row_number() over (partition by merchant order by unix_time, trans_num) = 1""", ["wide_keyed"]),
    "enriched_events": ("""
select trans_date_trans_time, user_id, merchant, category, trans_num, unix_time, is_fraud,
  amt / (case currency when 'EUR' then 1.17::double when 'DKK' then 0.16::double
         when 'SEK' then 0.11::double when 'NOK' then 0.10::double end) original_amt, currency
from (select *, (['EUR','DKK','SEK','NOK'])[(('0x' || substr(md5(trans_num),1,8))::bigint % 4) + 1] currency
      from split_events)""", ["split_events"]),
}
ALL.update(INGEST)

INGEST_QUERIES = {
    "src01_csv_roundtrip": (["raw_transactions"], r"""
select * replace (cast(is_fraud as bigint) as is_fraud, case cast(trans_num as bigint) % 20
  when 0 then 'say "hi"; ' || category || chr(10) || '"second"; line' when 1 then ''
  when 2 then '\ back\"slash ' || category || '\' when 3 then ' ;' || category || ' ' when 4 then null
  else category end as category) from raw_transactions""", ["original_amt"]),
    "md24_fx_landing": (["raw_fx_rates"], """
select "timestamp", 'USD' base_currency, q.c currency, rate + q.i rate,
  year(try_cast("timestamp" as timestamptz) at time zone 'UTC') "year",
  month(try_cast("timestamp" as timestamptz) at time zone 'UTC') "month",
  day(try_cast("timestamp" as timestamptz) at time zone 'UTC') "day"
from raw_fx_rates cross join (values ('DKK', 0), ('nok', 1), ('SEK', 2), ('EUR', 3)) q(c, i)""", ["rate:double"]),
    "md23_split_events": (["split_events"], "select * from split_events", ["amt"]),
    "md23_split_users": (["split_users"], "select * from split_users", ["lat", "long"]),
    "md23_split_merchants": (["split_merchants"], "select * from split_merchants", ["merch_lat", "merch_long"]),
    "st05_enrich_events": (["enriched_events"], "select * from enriched_events", ["original_amt"]),
    "st08_event_preview": (["enriched_events"], """
select trans_date_trans_time, user_id, merchant, category, original_amt amount,
  coalesce(currency, 'USD') currency, is_fraud from enriched_events""", ["amount"]),
    "md25_stream_landing": (["enriched_events"], "select * from enriched_events", ["original_amt"]),
    "st04_quarantine": (["split_events"], """
select case when cast(trans_num as bigint) % 25 = 0 then '{broken ' || trans_num else '' end "value"
from split_events where cast(trans_num as bigint) % 25 < 2""", []),
}


SCALARS = {
    "fs_strings": (["raw_users"], f"""
select user_id, _ab_cdc_updated_at updated_raw, upper(gender) gender_upper,
  case when upper(gender) = 'M' then 'Male' when upper(gender) = 'F' then 'Female' else null end gender_label,
  regexp_replace('fraud_' || last_name, '^fraud_', '') stripped,
  first_name || ' ' || job concat_nullable,
  nullif(trim(coalesce(first_name, '') || ' ' || coalesce(last_name, '')), '') full_name,
  nullif(try_cast(zip as bigint), 0) zip_code, coalesce(job, 'n/a') job_or_na,
  md5(cast(user_id as varchar) || '|' || cast(job as varchar)) user_job_key,
  {uuid5_sql("lower(trim(first_name)) || '|' || lower(trim(last_name))")} name_uuid
from raw_users""", []),
    "fd_dates": (["raw_transactions"], """
select trans_num, unix_time, d "day", year(d) year_number, quarter(d) quarter_number, month(d) month_number,
  day(d) day_of_month, weekofyear(d) iso_week_number, isoyear(d) iso_year_number, dayofweek(d) + 1 day_of_week,
  strftime(d, '%B') month_name, strftime(d, '%A') day_name,
  hour(t) * 10000 + minute(t) * 100 + second(t) time_key, printf('%02d:00-%02d:59', hour(t), hour(t)) hour_bucket,
  hour(t) * 3600 + minute(t) * 60 + second(t) second_of_day,
  cast(trunc((epoch_us(t) - unix_time * 1000000) / 1000000.0) as bigint) seconds_vs_epoch,
  date_diff('year', date '1999-12-31', d) years_since,
  coalesce(t, timestamp '9999-12-31 00:00:00') t_or_far
from (select *, try_cast(trans_date_trans_time as timestamp) t,
             cast(try_cast(trans_date_trans_time as timestamp) as date) d from raw_transactions)""", []),
    "fm_math": (["raw_transactions"], f"""
select trans_num, abs(a - 50) abs_diff, ln(1 + cast(a as double)) log1p_amount,
  case when unix_time % 7 = 0 then null else is_fraud / (unix_time % 7) end safe_ratio,
  case when upper(currency) = 'USD' then cast(a as decimal(38,9))
       when unix_time % 7 = 0 then null
       else {numeric_div('a', 'cast(unix_time % 7 as decimal(18,9))')} end guarded_division
from (select *, try_cast(original_amt as decimal(28,9)) a from raw_transactions)""",
                ["abs_diff", "log1p_amount", "safe_ratio", "guarded_division"]),
    "fj_json": (["raw_users"], """
select user_id, _ab_cdc_updated_at, dob.member0 member0, dob.member1 member1,
  cast(zip as bigint) zip_roundtrip, job
from raw_users""", []),
}


# The field each registered run updates, and the value pools.
UPDATED_FIELD = {"run-1": "city", "run-2": "job", "run-3": "zip"}
CITIES = ["New York", "Los Angeles", "Chicago", "Houston", "Phoenix", "Philadelphia", "San Antonio", "San Diego", "Dallas",
          "San Jose", "Austin", "Jacksonville", "San Francisco", "Columbus", "Fort Worth", "Charlotte", "Seattle", "Denver",
          "Boston", "El Paso", "Detroit", "Nashville", "Portland", "Oklahoma City", "Las Vegas", "Memphis", "Louisville",
          "Baltimore", "Milwaukee", "Albuquerque"]
JOBS = ["Software Engineer", "Data Scientist", "Product Manager", "Marketing Manager", "Sales Representative",
        "Accountant", "Teacher", "Nurse", "Doctor", "Lawyer", "Consultant", "Designer", "Analyst", "Manager", "Director",
        "Engineer", "Developer", "Architect", "Administrator", "Specialist", "Coordinator", "Assistant", "Executive",
        "Supervisor", "Technician"]

# Three failing checks over rows with planted faults, and the orphans they leave
VIOLATIONS = """
with t as (
  select case when cast(transaction_id as bigint) % 11 = 0 then null else user_id end user_id, transaction_id,
    case when cast(transaction_id as bigint) % 17 = 0 then 'X' || (cast(transaction_id as bigint) % 3) else currency end currency
  from stg_transactions
  union all select user_id, transaction_id, currency from stg_transactions where cast(transaction_id as bigint) % 10 = 0),
u as (select user_id from dim_users_current where cast(user_id as bigint) % 7 <> 0)
select *, failing_rows = 0 passed from (
  select 't' model, 'user_id' column_name, 'not_null' test_name, count(*) failing_rows from t where user_id is null
  union all select 't', 'transaction_id', 'unique', count(*)
    from (select transaction_id from t group by transaction_id having count(*) > 1)
  union all select 't', 'currency', 'accepted_values', count(distinct currency) from t
    where currency not in ('USD', 'EUR', 'DKK', 'NOK', 'SEK')
  union all select 't', 'user_id', 'relationships', count(*) from t
    where user_id is not null and user_id not in (select user_id from u)
  union all select 'u', 'user_id', 'unique', 0)"""
ORPHANS = """
select f.user_id, count(*) "rows" from fct_transactions f
where f.user_id is not null and not exists (
  select 1 from dim_users_current u where u.user_id = f.user_id and cast(u.user_id as bigint) % 7 <> 0)
group by f.user_id"""

_ML_FEATURES = """original_amount amount_log1p_original year_number quarter_number month_number iso_week_number
day_of_week hour_24 is_business_hours is_weekend has_merchant_geo user_recency_seconds merchant_recency_seconds
user_merchant_recency_seconds user_txn_count_24h user_txn_count_30d user_original_amount_sum_24h
user_original_amount_avg_24h user_original_amount_max_24h user_original_amount_sum_30d user_original_amount_avg_30d
user_original_amount_max_30d merchant_txn_count_30d merchant_original_amount_avg_30d user_merchant_txn_count_30d
user_merchant_original_amount_avg_30d""".split()


def _as_double(c: str) -> str:
    return f"cast(cast({c} as int) as double)" if c.startswith(("is_", "has_")) else f"cast({c} as double)"


def ml_sql() -> dict[str, str]:
    """ML5 features as numbers, ML1 imputation and scaling figures, ML4 threshold on probabilities made from the data."""
    frame = ", ".join(f"cast(round(try_cast({_as_double(c)} as decimal(38,13)), 6) as double) {c}" for c in _ML_FEATURES)
    stats = " union all ".join(
        f"select '{c}' feature, m fill_value, avg(coalesce(x, m)) mean_value, stddev_samp(coalesce(x, m)) std_value "
        f"from (select {_as_double(c)} x, avg({_as_double(c)}) over () m from fraud_features where is_fraud is not null) "
        "group by m" for c in _ML_FEATURES)
    names = ("fill_value", "mean_value", "std_value")
    stats = f"select feature, {', '.join(f'cast(round(try_cast({n} as decimal(38,13)), 6) as double) {n}' for n in names)} from ({stats})"
    return {
        "ml05_feature_frame": with_models(["fraud_features"], f"select transaction_id, {frame} from fraud_features"),
        "ml01_scaling_stats": with_models(["fraud_features"], stats),
        "ml04_threshold": with_models(["stg_transactions"], """
select transaction_id, cast((unix_time_seconds % 1000) / 1000 as double) fraud_probability,
  unix_time_seconds % 1000 >= 100 predicted_fraud from stg_transactions"""),
    }


def user_updates_sql(run_ts: str = "2024-02-01T00:00:00", salt: str = "run-1", fraction: float = 0.01) -> str:
    """MD26: the salted-md5 top-n sample of current users with one field rewritten."""
    field = UPDATED_FIELD[salt]

    def h(expr, s):
        return f"('0x' || substr(md5(cast({expr} as varchar) || '{s}'), 1, 15))::bigint"

    lst = lambda xs: "[" + ", ".join("'" + x.replace("'", "''") + "'" for x in xs) + "]"
    new = {"city": f"({lst(CITIES)})[{h('user_id', salt + 'v')} % {len(CITIES)} + 1]",
           "job": f"({lst(JOBS)})[{h('user_id', salt + 'v')} % {len(JOBS)} + 1]",
           "zip": f"cast({h('user_id', salt + 'v')} % 90000 + 10000 as integer)"}[field]
    cols = {"city": "city", "zip": "cast(zip as bigint) zip", "job": "job"}
    cols[field] = f"{new} {field}" if field != "zip" else f"cast({new} as bigint) zip"
    ts = run_ts.replace("T", " ")
    body = f"""
select timestamp '{ts}' _airbyte_emitted_at, strftime(timestamp '{ts}', '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' _ab_cdc_updated_at,
  user_id, first_name, last_name, gender, street, {cols['city']}, {cols['zip']}, lat, "long",
  dob.member0 dob_member0, dob.member1 dob_member1, {cols['job']}
from (
  select * from (
    select *, {h('user_id', salt)} hh from raw_users
    qualify row_number() over (partition by user_id order by
      coalesce(timezone('UTC', try_cast(_ab_cdc_updated_at as timestamptz)), _airbyte_emitted_at) desc nulls last) = 1)
  qualify row_number() over (order by hh, user_id) <= greatest(1, floor((select count(distinct user_id) from raw_users) * {fraction})))"""
    return normalized(["raw_users"], body, ["lat", "long"])


INGEST_QUERIES["st07_staged_from_landing"] = (["enriched_events"], """
select * from (
  select cast(user_id as varchar) user_id, cast(trans_num as varchar) transaction_id,
    try_cast(trans_date_trans_time as timestamp) transaction_datetime_UTC,
    regexp_replace(merchant, '^fraud_', '') merchant_name, try_cast(unix_time as bigint) unix_time_seconds,
    try_cast(original_amt as decimal(28,9)) original_amount, upper(currency) currency,
    try_cast(is_fraud as boolean) is_fraud, category
  from (select * from enriched_events union all
        select * replace (unix_time + 60 as unix_time) from enriched_events where cast(trans_num as bigint) % 10 = 0))
qualify row_number() over (partition by transaction_id
  order by transaction_datetime_UTC desc nulls last, unix_time_seconds desc nulls last) = 1""", ["original_amount"])


# --- filter context over the report's relationships ------------------------------
_LATE = "select date_key from dim_date where month_number = 1 and day_of_month > 20"
_GOOD_DAYS = """select date_key from dim_date where day_of_week <> 1
  and date_key in (select date_key from mart_kpi_daily where fraud_rate >= 0.2)"""
_OVERALL = "select merchant_name from mart_kpi_merchant_overall where"


def filter_context_sql() -> str:
    """JN10: each table's condition under each context, written out by hand."""
    by_date = ("mart_kpi_daily", "mart_kpi_currency_daily", "mart_kpi_merchant_daily", "mart_kpi_user_daily")
    late, good = f"in ({_LATE})", f"in ({_GOOD_DAYS})"
    conditions = {
        "month": {**{t: f"date_key {late}" for t in (*by_date, "dim_date")},
                  "mart_kpi_merchant_overall": f"first_date_key {late}",
                  "dim_merchants": f"merchant_name in ({_OVERALL} first_date_key {late})"},
        "merchant": {"mart_kpi_merchant_overall": "fraud_txn_count >= 20",
                     "dim_merchants": f"merchant_name in ({_OVERALL} fraud_txn_count >= 20)"},
        "last_date": {**{t: f"date_key {late}" for t in (*by_date, "dim_date")},
                      "mart_kpi_merchant_overall": f"last_date_key {late}",
                      "dim_merchants": f"merchant_name in ({_OVERALL} last_date_key {late})"},
        "daily": {**{t: f"date_key {good}" for t in (*by_date, "dim_date")},
                  "mart_kpi_merchant_overall": f"first_date_key {good}",
                  "dim_merchants": f"merchant_name in ({_OVERALL} first_date_key {good})"},
    }
    tables = (*by_date, "mart_kpi_merchant_overall", "dim_merchants", "dim_date")
    body = " union all ".join(
        f"select '{c}' context, '{t}' table_name, count(*) row_count, "
        f"{'sum(amount_usd_total)' if t.startswith('mart') else 'null::decimal(38,9)'} amount_usd_total from {t}"
        f" where {of.get(t, 'true')}" for c, of in conditions.items() for t in tables)
    return normalized(list(tables), body, ["amount_usd_total"])


def filtered_visuals_sql() -> str:
    body = """
select day_name, currency, sum(amount_usd_total) amount_usd_total
from mart_kpi_currency_daily m join dim_date d using (date_key) where day_of_month > 20 group by all
union all
select day_name, 'all, by last day', sum(amount_usd_total)
from mart_kpi_merchant_overall m join dim_date d on d.date_key = m.last_date_key where day_of_month > 20 group by all"""
    return normalized(["mart_kpi_currency_daily", "mart_kpi_merchant_overall", "dim_date"], body, ["amount_usd_total"])


# --- the change log as a log -------------------------------------------------------
_LOG_ACTIONS = """
e as (
  select distinct u.*, e.event_id lsn, e.ts committed_at,
    case when event_id % 13 = 0 then 'D' when event_id % 29 = 0 then 'M' else 'W' end kind
  from raw_users u join events e on e.event_type = 'signup' and cast(e.user_id as varchar) = u.user_id
    and u._airbyte_emitted_at = e.ts + interval 1 minute),
a as (
  select user_id k, lsn, 0 step, kind, committed_at, e from e where kind <> 'W'
  union all
  select case when kind = 'M' then '9' || user_id else user_id end, lsn, 1, 'W', committed_at, e from e where kind <> 'D')"""


def change_log_sql() -> dict[str, str]:
    """SRC10: the last action of each key, and each write with its next action."""
    current = f"""
select k user_id, lsn, e.first_name, e.last_name, e.gender, e.street, e.city, cast(e.zip as bigint) zip, e.lat, e."long", e.job
from (with {_LOG_ACTIONS} select * from a qualify row_number() over (partition by k order by lsn desc, step desc) = 1)
where step = 1"""
    history = f"""
select md5(k || '|' || strftime(committed_at, '%Y-%m-%d %H:%M:%S.%f')) user_version_id, k user_id, e.first_name, e.last_name,
  nullif(trim(coalesce(e.first_name, '') || ' ' || coalesce(e.last_name, '')), '') full_name,
  case when upper(e.gender) = 'M' then 'Male' when upper(e.gender) = 'F' then 'Female' end gender, e.street address,
  e.city city_name, nullif(cast(e.zip as bigint), 0) zip_code, e.lat latitude, e."long" longitude,
  coalesce(try_cast(e.dob.member0 as date), try_cast(e.dob.member1 as date)) date_of_birth, e.job,
  committed_at dbt_valid_from, ended_at dbt_valid_to, ended_by
from (with {_LOG_ACTIONS}
  select *, lead(committed_at) over (partition by k order by lsn, step) ended_at,
    lead(case kind when 'D' then 'delete' when 'M' then 'move' else 'update' end) over (partition by k order by lsn, step) ended_by
  from a) where step = 1"""
    return {"src10_apply_log": normalized(["raw_users"], current, ["lat", "long"]),
            "src10_log_history": normalized(["raw_users"], history, ["latitude", "longitude"])}


# --- scoring ----------------------------------------------------------------------
def _logit(terms: list[str]) -> str:
    return "1 / (1 + exp(-(" + " + ".join(terms) + ")))"


# The coefficients (features in order, then the constant) of the fit on the tables at sf 0.01, found by a
# plain Newton iteration over all rows (tests/test_logistic.py holds the distributed fit to the same)
MD22_COEFFICIENTS = [
    0.02136986444520912, -0.02492850609406667, 0.0, 0.0, 0.0, -0.03236727320984129, 0.029819395266166775,
    -0.02128592400208337, -0.022853309548138467, 0.010538110325547256, -0.019982705698752854, 0.047311406699007796,
    -0.01391780550978116, 0.002208584552565221, 0.09218463420380747, -0.25851685522539175, -0.06650252103765548,
    -0.024279266908179, 0.0725770964602608, 0.1850435843294391, -0.0629821550279828, 0.04031923267031549,
    0.09373532635628685, -0.019079797641008513, 0.0111343888502902, 0.011385313038394925, -1.3812718059836824,
]


def scoring_sql() -> dict[str, str]:
    """ML2 / MC1 as a dot product with the fixed coefficients; MD22 with the fitted ones."""
    fixed = [f"{(7 * i % 11 - 5) / 10} * (coalesce({_as_double(c)}, {i / 2}) - {i}) / {1000.0 * (1 + i)}::double"
             for i, c in enumerate(_ML_FEATURES)]
    p = _logit([*fixed, "-0.25::double"])
    scored = f"select transaction_id, {p} p from fraud_features"
    stats = ", ".join(f"avg({_as_double(c)}) over () m{i}, stddev_samp({_as_double(c)}) over () * sqrt((count({c}) over () - 1) / "
                      f"(count(*) over () - 1)) s{i}" for i, c in enumerate(_ML_FEATURES))
    fitted = [f"case when s{i} > 0 then {b!r}::double * (coalesce({_as_double(c)}, m{i}) - m{i}) / s{i} else 0 end"
              for i, (c, b) in enumerate(zip(_ML_FEATURES, MD22_COEFFICIENTS))]
    md22 = _logit([*fitted, f"{MD22_COEFFICIENTS[-1]!r}::double"])
    return {
        "ml02_predict_function": normalized(["fraud_features"], f"""
select transaction_id, p >= 0.5 predicted_is_fraud, p prob_true, greatest(p, 1 - p) prob_first from ({scored})""",
                                            ["prob_true:double", "prob_first:double"]),
        "mc01_threshold": with_models(["fraud_features"], f"""
select p >= threshold predicted_fraud, count(*) row_count, threshold
from ({scored}), (values (0.1::double), (0.45::double)) t(threshold) group by all"""),
        "md22_fraud_predictions": normalized(["fraud_features"], f"""
select transaction_id, p fraud_probability, p >= 0.1 predicted_fraud, true has_time
from (select *, {md22} p from (select *, {stats} from fraud_features))""", ["fraud_probability:double"]),
    }


# --- mergeable distinct counts -----------------------------------------------------
DISTINCT_LEVELS = """
select case when grouping(date_key) = 0 and grouping(currency) = 0 then 'day and currency'
    when grouping(date_key) = 0 then 'day' when grouping(currency) = 0 then 'currency' else 'all' end as "level",
  date_key, currency, count(distinct user_id) distinct_users, count(distinct merchant_name) distinct_merchants
from fct_transactions group by grouping sets ((date_key, currency), (date_key), (currency), ())"""


INGEST_QUERIES["st01_group_progress"] = (["enriched_events"], """
select 'all' consumer_group, count(*) events, cast(sum(is_fraud) as bigint) fraud_events, 2::bigint batches from enriched_events
union all
select 'late', count(*), cast(sum(is_fraud) as bigint), 1::bigint from enriched_events where cast(trans_num as bigint) % 2 = 0""", [])
