"""Independent SQL for each registered query, run by DuckDB on the same tables."""

from __future__ import annotations

INPUTS = """
geo as (
  select c_custkey, r_name as state, n_name as district
  from customer join nation on c_nationkey = n_nationkey
  join region on n_regionkey = r_regionkey),
base as (
  select o_orderkey as id, o_custkey, o_totalprice as p, o_orderdate, state, district
  from orders join geo on o_custkey = c_custkey),
clean as (
  select id,
    case when id % 103 = 0 then 'not-a-date' else strftime(o_orderdate, '%d-%m-%Y') end as date,
    case when id % 97 = 0 then null when id % 101 = 0 then '  ' else state end as state,
    case when id % 71 = 0 then ' ' || lower(district) || ' ' else district end as district,
    case when id % 89 = 0 then cast(100000 + o_custkey as varchar) || '.0'
         when id % 83 = 0 then substr(cast(100000 + o_custkey as varchar), 1, 5)
         else cast(100000 + o_custkey as varchar) end as pincode,
    cast(case when id % 79 = 0 then -(cast(floor(p) as bigint) % 100) - 1
         when id % 61 = 0 then null
         else cast(floor(p) as bigint) % 100 end as integer) as age_0_5,
    cast(cast(floor(p / 100) as bigint) % 100 as integer) as age_5_17,
    cast(floor(p / 10000) as integer) as age_18_greater
  from base),
raw as (
  select date, state, district, pincode, age_0_5, age_5_17, age_18_greater,
    id * 2 as ingest_seq from clean
  union all
  select date, state, district, pincode, age_0_5, age_5_17,
    age_18_greater + cast(id % 106 = 0 as integer), id * 2 + 1 from clean where id % 53 = 0),
parsed as (
  select *, cast(try_strptime(date, '%d-%m-%Y') as date) as d,
    cast(coalesce(age_0_5, 0) + coalesce(age_5_17, 0) + coalesce(age_18_greater, 0) as bigint)
      as total
  from raw),
monthly as (select *, strftime(d, '%Y-%m') as month from parsed),
demo as (
  select strftime(l_shipdate, '%d-%m-%Y') as date, state, district,
    cast(100000 + o_custkey as varchar) as pincode,
    cast(floor(l_quantity) as integer) as demo_age_5_17, l_linenumber as demo_age_17
  from lineitem join orders on l_orderkey = o_orderkey join geo on o_custkey = c_custkey),
bio as (
  select strftime(cast(ts as date) - 9000, '%d-%m-%Y') as date, state, district,
    cast(100000 + user_id as varchar) as pincode,
    cast(floor(value) as integer) as bio_age_5_17, cast(event_id % 10 as integer) as bio_age_17
  from events join geo on user_id = c_custkey),
"""


LOCATION_KEY = "md5(" + " || ".join(
    f"coalesce(length({c}) || ':' || {c}, '-')" for c in ("state", "district", "pincode")
) + ")"


def _key_rows(table: str, label: str = "lower(trim({c}))") -> str:
    return f"""
  select strftime(try_strptime(date, '%d-%m-%Y'), '%Y-%m-%d') as date_key,
    {label.format(c="state")} as state_key, {label.format(c="district")} as district_key,
    trim(regexp_replace(pincode, '\\.0$', '')) as pincode_key
  from {table}"""


def _keys(table: str, compat: bool = False) -> str:
    label = "coalesce(lower(trim({c})), 'nan')" if compat else "lower(trim({c}))"
    return f"""(select distinct * from ({_key_rows(table, label)})
  where date_key is not null and state_key is not null
    and district_key is not null and pincode_key is not null)"""


KEY_SETS = f"""
ek as {_keys("raw")}, dk as {_keys("demo")}, bk as {_keys("bio")},
"""
COMPAT_SETS = f"""
ek as {_keys("raw", True)}, dk as {_keys("demo", True)}, bk as {_keys("bio", True)},
"""
USING = "using (date_key, state_key, district_key, pincode_key)"

FIRST = """
first as (
  select * exclude (rn) from (
    select *, row_number() over (
      partition by date, state, district, pincode order by ingest_seq) as rn from raw)
  where rn = 1),
"""

VALID = """
judged as (
  select *,
    d is not null as ok_date,
    coalesce(regexp_full_match(regexp_replace(pincode, '\\.0$', ''), '[0-9]{6}'), false) as ok_pin,
    coalesce(age_0_5 >= 0 and age_5_17 >= 0 and age_18_greater >= 0, false) as ok_age,
    coalesce(trim(state) <> '', false) as ok_state,
    coalesce(trim(district) <> '', false) as ok_district
  from parsed),
"""

# the labels are one or two words, with digits after an underscore
TITLE = (
    "list_aggregate(list_transform(string_split(lower(trim({c})), ' '), "
    "lambda w: upper(w[1]) || w[2:]), 'string_agg', ' ')"
)


def _silver(aliased: bool) -> str:
    title = TITLE.format(c="district")
    district = f"coalesce(n_name, {title})" if aliased else title
    join = "left join nation on lower(trim(district)) = lower(n_name)" if aliased else ""
    return f"""{VALID}
valid as (
  select d as date, {TITLE.format(c="state")} as state, {district} as district,
    trim(regexp_replace(pincode, '\\.0$', '')) as pincode,
    cast(age_0_5 as bigint) as age_0_5, cast(age_5_17 as bigint) as age_5_17,
    cast(age_18_greater as bigint) as age_18_greater, ingest_seq
  from judged {join}
  where ok_date and ok_pin and ok_age and ok_state and ok_district),
silver as (
  select * exclude (rn) from (
    select *, row_number() over (
      partition by date, state, district, pincode order by ingest_seq) as rn from valid)
  where rn = 1),
"""


SERIES = """
series as (
  select state, month, cast(sum(total) as bigint) as total from monthly
  where state is not null and month is not null group by state, month),
"""

ANOMALY = (
    SERIES
    + """
scored as (
  select *,
    total / nullif(cast(lag(total) over (partition by state order by month) as double), 0) - 1
      as pct,
    (total - avg(total) over (partition by state))
      / nullif(stddev_samp(total) over (partition by state), 0) as z
  from series),
"""
)


def _anomaly(pct: float, z: float) -> str:
    return f"""select state, month, total, round(pct, 6) as pct_change, round(z, 6) as z,
      case when abs(pct) > {pct} and abs(z) > {z} then 'likely_data_issue' else 'normal' end
        as anomaly_class from scored"""


def _edges(source: str) -> str:
    """Distinct deciles of ``total``, interpolated in numpy's order of operations."""
    return f"""
edges as (
  select list_sort(list_distinct(list(
    case when t >= 0.5 then b - (b - a) * (1 - t) else a + (b - a) * t end))) as e
  from (
    select cast(v[cast(floor(h) as bigint) + 1] as double) as a,
      cast(v[cast(ceil(h) as bigint) + 1] as double) as b, h - floor(h) as t
    from (
      select v, (len(v) - 1) * (case when i = 10 then 1.0::double else i * 0.1::double end) as h
      from (select list_sort(list(total)) as v from {source}), range(0, 11) r(i)))),
"""


def _psi(period: str, include_base: bool) -> tuple[str, str]:
    """CTEs and final select of the drift over a text period expression."""
    ctes = f"""
rows_ as (select {period} as period, total from parsed where d is not null),
base_ as (select total from rows_ where period = (select min(period) from rows_)),
{_edges("base_")}
binned as (
  select period, least(len(list_filter(e, lambda y: y <= total)), len(e) - 1) as bin
  from rows_, edges where total between e[1] and e[len(e)]),
grid as (
  select period, bin from (select distinct period from rows_),
    (select unnest(range(1, len(e))) as bin from edges)),
counted as (
  select g.period, g.bin, count(b.bin) as n from grid g
  left join binned b on b.period = g.period and b.bin = g.bin group by all),
shares as (
  select period, bin,
    greatest(n / greatest(sum(n) over (partition by period), 1), 1e-6) as share from counted),
psi_ as (
  select a.period,
    case when (select len(e) from edges) >= 3
      then round(sum((a.share - b.share) * ln(a.share / b.share)), 6) end as psi
  from shares a join shares b on a.bin = b.bin
    and b.period = (select min(period) from rows_)
  group by a.period),
"""
    keep = "" if include_base else "where period > (select min(period) from rows_)"
    return ctes, f"from psi_ {keep}"


PROFILE_COLUMNS = ["date", "state", "district", "pincode", "age_0_5", "age_5_17", "age_18_greater"]
TYPES = dict.fromkeys(PROFILE_COLUMNS[:4], "string") | dict.fromkeys(PROFILE_COLUMNS[4:], "int")
ROLES = {
    "date": "Time Dimension",
    "state": "Location Dimension",
    "district": "Location Dimension",
    "pincode": "Location Dimension",
    "age_0_5": "Measure",
    "age_5_17": "Measure",
    "age_18_greater": "Measure",
}


def _per_column(template: str, columns=PROFILE_COLUMNS) -> str:
    return "\nunion all\n".join(template.replace("@c", c) for c in columns)


NULL_PCT = "round(100.0 * count(*) filter (@c is null) / greatest(count(*), 1), 6)"
BLANKS = "count(*) filter (trim(cast(@c as varchar)) = '')"

DUPLICATE_COUNTS = """
dup_full as (select cast(sum(n - 1) as bigint) as v from (
  select count(*) as n from raw
  group by date, state, district, pincode, age_0_5, age_5_17, age_18_greater)),
dup_key as (select cast(sum(n - 1) as bigint) as v from (
  select count(*) as n from raw group by date, state, district, pincode)),
"""

NULL_KEYS = "count(*) filter (date is null) + count(*) filter (state is null) + count(*) filter (district is null) " \
    "+ count(*) filter (pincode is null)"
NULL_CELLS = NULL_KEYS + " + count(*) filter (age_0_5 is null) + count(*) filter (age_5_17 is null) " \
    "+ count(*) filter (age_18_greater is null)"
NEGATIVE = "count(*) filter (age_0_5 < 0 or age_5_17 < 0 or age_18_greater < 0)"

QUALITY = (
    DUPLICATE_COUNTS
    + ANOMALY
    + f"""
m as (
  select 'key_duplicates' as metric, v as value from dup_key
  union all select 'full_duplicates', v from dup_full
  union all select 'null_keys', cast({NULL_KEYS} as bigint) from raw
  union all select 'null_cells', cast({NULL_CELLS} as bigint) from raw
  union all select 'negative_rows', {NEGATIVE} from raw
  union all select 'pincode_conflicts', count(*) from (
    select pincode from raw group by pincode having count(distinct district) > 1)
  union all select 'spelling_variants', count(*) from (
    select lower(trim(district)) from raw group by 1 having count(distinct district) > 1)
  union all select 'anomalies', count(*) from scored where abs(pct) > 0.6 and abs(z) > 3),
"""
)


def _with(*parts: str, select: str) -> str:
    body = "".join(parts).rstrip().rstrip(",")
    return f"with {body}\n{select}"


def _raw(select: str, *ctes: str) -> str:
    return _with(INPUTS, *ctes, select=select)


def _coverage(sets: str) -> str:
    counts = [("enroll", "demo"), ("enroll", "bio"), ("demo", "enroll"), ("bio", "enroll")]
    short = {"enroll": "ek", "demo": "dk", "bio": "bk"}
    return _raw(
        "\nunion all\n".join(
            f"select '{a}_not_in_{b}' as metric, count(*) as value "
            f"from {short[a]} anti join {short[b]} {USING}"
            for a, b in counts
        ),
        sets,
    )


def _contract(table: str, *ctes: str) -> str:
    return _raw(
        f"""select 'valid_date' as "check",
      count(*) filter (try_strptime(date, '%d-%m-%Y') is null) as failed_rows from {table}
    union all select 'valid_6_digit_pincode', count(*) filter (not coalesce(regexp_full_match(
      regexp_replace(pincode, '\\.0$', ''), '[0-9]{{6}}'), false)) from {table}
    union all select 'non_negative_age', count(*) filter (not coalesce(
      age_0_5 >= 0 and age_5_17 >= 0 and age_18_greater >= 0, false)) from {table}""",
        *ctes,
    )


def all_oracles() -> dict[str, str]:
    yearly_ctes, yearly = _psi("strftime(d, '%Y')", False)
    monthly_ctes, by_month = _psi("strftime(d, '%Y-%m')", True)
    rule = "select '{0}' as rule, '{1}' as expected, value as current, " \
        "case when value = 0 then 'Pass' else 'Fail' end as pass_flag from m where metric = '{2}'"
    risk = "select '{0}' as risk_id, '{1}' as risk, '{2}' as severity, '{3}' as \"check\", " \
        "value as current, case when value = 0 then 'Closed' else 'Open' end as status " \
        "from m where metric = '{4}'"
    value_of = "(select value from m where metric = '{}')".format
    pin = "trim(regexp_replace(pincode, '\\.0$', ''))"
    valid_pin = (
        "coalesce(regexp_full_match(regexp_replace(pincode, '\\.0$', ''), '[0-9]{6}'), false)"
    )
    return {
        "schema_conform": _raw("select * from demo"),
        "load_audit_counts": _raw(
            """select case when ingest_seq % 2 = 0 then 'base' else 'copies' end as source,
              count(*) as rows, count(*) filter (d is null) as bad_rows from parsed group by 1"""
        ),
        "scan_full": _raw("select * from raw"),
        "merged_row_count": "select count(*) as total_merged_rows from orders",
        "bronze_lineage": _raw(
            """select ingest_seq, 'orders' as source, cast(d as timestamp) as event_ts,
              timestamp '2002-01-01' as ingest_ts, 'enrolment' as topic,
              ingest_seq as "offset", cast(7 as bigint) as batch_id from parsed"""
        ),
        "union_shards": "select * from orders",
        "key_projection": _raw("select date, state, district, pincode, ingest_seq from raw"),
        "preview_ordered": _raw("select * from raw order by ingest_seq limit 10"),
        "parse_date": _raw("select ingest_seq, date, d as parsed from parsed"),
        "normalize_pincode": _raw(
            f"select ingest_seq, pincode, {pin} as normalized from raw"
        ),
        "normalize_name": _raw(
            """select ingest_seq, lower(trim(state)) as state_name,
              lower(trim(district)) as district_name from raw"""
        ),
        "title_name": _raw(
            f"""select ingest_seq, {TITLE.format(c="state")} as state_title,
              {TITLE.format(c="district")} as district_title from raw"""
        ),
        "numeric_coerce": _raw(
            """select ingest_seq, try_cast(pincode as double) as pincode_number,
              try_cast(date as double) as date_number,
              try_cast(try_cast(pincode as double) as bigint) as pincode_whole from raw"""
        ),
        "row_total": _raw("select ingest_seq, total from parsed"),
        "negative_rows": _raw(
            "select * from raw where age_0_5 < 0 or age_5_17 < 0 or age_18_greater < 0"
        ),
        "state_slice": _raw("select * from raw where lower(trim(state)) = 'middle east'"),
        "drop_null_keys": _raw(
            """select * from raw where date is not null and state is not null
              and district is not null and pincode is not null"""
        ),
        "month_bucket": _raw(
            "select ingest_seq, month, coalesce(month, 'NaT') as month_or_nat from monthly"
        ),
        "valid_pincode_flag": _raw(f"select ingest_seq, {valid_pin} as valid_pincode from raw"),
        "blank_rows": _raw("select * from raw where trim(state) = ''"),
        "pincode_length_dist": _raw(
            f"select cast(length({pin}) as bigint) as length, count(*) as n from raw group by 1"
        ),
        "surrogate_code": "select p_partkey, printf('SCH%04d', p_partkey + 1) as scheme_id from part",
        "ratio_guarded": _raw(
            """select ingest_seq, round(coalesce(cast(age_0_5 as double)
              / nullif(cast(age_5_17 as double), 0), 0) * 100, 2) as ratio_pct from raw"""
        ),
        "canonical_names": _raw(
            f"""select ingest_seq, {TITLE.format(c="state")} as state,
              coalesce(n_name, {TITLE.format(c="district")}) as district
              from raw left join nation on lower(trim(district)) = lower(n_name)"""
        ),
        "conformed_key": _raw("select * from ek", KEY_SETS),
        "conformed_key_compat": _raw("select * from ek", COMPAT_SETS),
        "missing_keys_ab": _raw(f"select * from ek anti join dk {USING}", KEY_SETS),
        "missing_keys_ba": _raw(f"select * from dk anti join ek {USING}", KEY_SETS),
        "missing_keys_ac": _raw(f"select * from ek anti join bk {USING}", KEY_SETS),
        "missing_keys_ca": _raw(f"select * from bk anti join ek {USING}", KEY_SETS),
        "matched_keys": _raw(f"select * from ek semi join bk {USING}", KEY_SETS),
        "merge_indicator": _raw(
            f"""select ek.*, case when f.found then 'both' else 'left_only' end as merge_status
              from ek left join (select *, true as found from dk) f {USING}""",
            KEY_SETS,
        ),
        "coverage_pct": _raw(
            f"""select (select count(*) from ek) as enroll_key_count,
              round(100 * (1 - (select count(*) from ek anti join dk {USING})
                / greatest((select count(*) from ek), 1)), 4) as enroll_in_demo_pct,
              round(100 * (1 - (select count(*) from ek anti join bk {USING})
                / greatest((select count(*) from ek), 1)), 4) as enroll_in_bio_pct""",
            KEY_SETS,
        ),
        "coverage_summary": _coverage(KEY_SETS),
        "coverage_summary_compat": _coverage(COMPAT_SETS),
        "conformed_wide": _raw(
            f"""select date_key, state_key, district_key, pincode_key,
              cast(age_0_5 as bigint) as age_0_5, cast(age_5_17 as bigint) as age_5_17,
              cast(age_18_greater as bigint) as age_18_greater,
              cast(demo_age_5_17 as bigint) as demo_age_5_17,
              cast(demo_age_17 as bigint) as demo_age_17,
              cast(bio_age_5_17 as bigint) as bio_age_5_17,
              cast(bio_age_17 as bigint) as bio_age_17
              from e full join b {USING} full join f {USING}""",
            *[
                f"""{name} as (
  select date_key, state_key, district_key, pincode_key, {sums} from (
    select k.*, {measures} from ({_key_rows(table).replace("select", "select *,", 1)}) k)
  where date_key is not null and state_key is not null and district_key is not null
    and pincode_key is not null group by all),
"""
                for name, table, sums, measures in [
                    (
                        "e",
                        "raw",
                        "sum(age_0_5) as age_0_5, sum(age_5_17) as age_5_17, "
                        "sum(age_18_greater) as age_18_greater",
                        "1 as one",
                    ),
                    (
                        "b",
                        "demo",
                        "sum(demo_age_5_17) as demo_age_5_17, sum(demo_age_17) as demo_age_17",
                        "1 as one",
                    ),
                    (
                        "f",
                        "bio",
                        "sum(bio_age_5_17) as bio_age_5_17, sum(bio_age_17) as bio_age_17",
                        "1 as one",
                    ),
                ]
            ],
        ),
        "fact_star_join": _raw(
            f"""select cast(strftime(date, '%Y%m%d') as integer) as date_key,
              {LOCATION_KEY} as location_key,
              cast(year(date) as integer) as year, cast(quarter(date) as integer) as quarter,
              strftime(date, '%Y-%m') as month, state, district, pincode,
              ingest_seq, age_0_5, age_5_17, age_18_greater from silver""",
            _silver(True),
        ),
        "active_interval_join": """
            select l_orderkey, l_linenumber, l_partkey, cast(l_shipdate as date) as date,
              date '1995-01-01' + p_size as start_date,
              date '1995-01-01' + p_size + 1000 as end_date
            from lineitem join part on l_partkey = p_partkey
            where cast(l_shipdate as date)
              between date '1995-01-01' + p_size and date '1995-01-01' + p_size + 1000""",
        "bucketed_interval_join": """
            select l_orderkey, l_linenumber, l_partkey, cast(l_shipdate as date) as date, k::INTEGER as k,
              date '1994-01-01' + (p_size + 45 * k)::INTEGER as start_date,
              date '1994-01-01' + (p_size + 45 * k + 60)::INTEGER as end_date
            from lineitem join part on l_partkey = p_partkey, range(41) r(k)
            where cast(l_shipdate as date) between date '1994-01-01' + (p_size + 45 * k)::INTEGER
              and date '1994-01-01' + (p_size + 45 * k + 60)::INTEGER""",
        "change_log_state": """
            select user_id, event_type, value, cast(ts as date) as day from (
              select *, row_number() over (partition by user_id, event_type order by event_id desc) as n from events)
            where n = 1 and event_id % 10 <> 0""",
        "alias_proposals": """
            with named as (
              select c_custkey as k, 'The ' || n_name as name from customer join nation on c_nationkey = n_nationkey),
            labels as (
              select lower(trim(case when k % 97 = 0 then replace(name, 'ATI', 'TI')
                when k % 89 = 0 then replace(name, 'ATI', 'AATI') when k % 83 = 0 then replace(name, 'ATI', 'ETI')
                when k % 79 = 0 then upper('  ' || name) when k % 73 = 0 then null when k % 71 = 0 then '  '
                else name end)) as label from named),
            counts as (select label, count(*) as n from labels where label <> '' group by label),
            pairs as (
              select a.label as alias, b.label as canonical, a.n as n_alias, b.n as n_canonical,
                levenshtein(a.label, b.label)::INTEGER as distance
              from counts a join counts b on b.n >= 10 * a.n where levenshtein(a.label, b.label) <= 1)
            select * from pairs
            qualify row_number() over (partition by alias order by n_canonical desc, distance, canonical) = 1""",
        "messages_parsed": """
            select strftime(ts, '%-d-%-m-%Y') as date, event_type as state, null::VARCHAR as district,
              cast(user_id + 100000 as varchar) as pincode, cast(event_id % 7 as varchar) as age_0_5,
              null::VARCHAR as age_5_17, null::VARCHAR as age_18_greater,
              case when event_id % 11 = 0 then '{"camp":"' || event_id % 5 || '"}' end as rest,
              'feed' as topic, (event_id % 3)::INTEGER as partition, event_id as "offset", ts as event_ts
            from events where event_id % 29 > 0 and event_id % 23 > 0 and event_id % 19 > 0 and event_id % 17 > 0""",
        "messages_dead_letters": """
            select case when event_id % 29 = 0 then null when event_id % 23 = 0 then '[1,2]'
                when event_id % 19 = 0 then '{"date":"' || strftime(ts, '%-d-%-m-%Y') || '","state":"' || event_type
                  || '","pincode":"' || (user_id + 100000) || '","age_0_5":"' || event_id % 7 || '"'
                  || case when event_id % 11 = 0 then ',"camp":"' || event_id % 5 || '"' else '' end
                else '{"camp":"1"}' end as raw,
              case when event_id % 29 = 0 then 'no value' when event_id % 23 = 0 then 'not an object'
                when event_id % 19 = 0 then 'unreadable JSON' else 'no declared field' end as reason,
              'feed' as topic, (event_id % 3)::INTEGER as partition, event_id as "offset", ts as event_ts
            from events where event_id % 29 = 0 or event_id % 23 = 0 or event_id % 19 = 0 or event_id % 17 = 0""",
        "window_day_totals": """
            select date_trunc('day', ts) as window_start, event_type, count(*) as rows, round(sum(value), 4) as value
            from events group by all""",
        "table_shape": _raw("select count(*) as rows, cast(7 as bigint) as columns from raw"),
        "dup_full_count": _raw("select v as full_duplicates from dup_full", DUPLICATE_COUNTS),
        "dup_key_count": _raw("select v as key_duplicates from dup_key", DUPLICATE_COUNTS),
        "merged_sketches": _raw(
            " union all ".join(
                f"""select '{c}' as "column", count(*) as rows, count(*) filter ({c} is null) as null_count,
                  {"count(*) filter (trim(" + c + ") = '')" if c in ("date", "state", "district", "pincode") else "0::BIGINT"} as blank_count,
                  {f"min({c})::DOUBLE" if c.startswith("age") else "null::DOUBLE"} as min,
                  {f"max({c})::DOUBLE" if c.startswith("age") else "null::DOUBLE"} as max,
                  true as unique_within_bound from raw"""
                for c in ("date", "state", "district", "pincode", "age_0_5", "age_5_17", "age_18_greater")
            )
        ),
        "null_profile": _raw(
            _per_column(
                f"select '@c' as \"column\", count(*) filter (@c is null) as null_count, "
                f"{NULL_PCT} as null_pct from raw"
            )
        ),
        "blank_profile": _raw(
            _per_column(f"select '@c' as \"column\", {BLANKS} as blank_count from raw")
        ),
        "missing_profile": _raw(
            _per_column(
                f"select '@c' as \"column\", {NULL_PCT} as null_pct, {BLANKS} as blank_count, "
                f"count(*) filter (@c is null) + {BLANKS} as missing_count from raw"
            )
        ),
        "fully_empty_rows": _raw(
            f"select count(*) filter ({' and '.join(c + ' is null' for c in PROFILE_COLUMNS)}) "
            "as fully_empty_rows from raw"
        ),
        "column_profile": _raw(
            "\nunion all\n".join(
                f"select '{c}' as \"column\", '{TYPES[c]}' as dtype, count({c}) as non_null_count, "
                f"count(*) filter ({c} is null) as null_count, {NULL_PCT.replace('@c', c)} as null_pct, "
                f"count(distinct {c}) as unique_count from raw"
                for c in PROFILE_COLUMNS
            )
        ),
        "describe_numeric": _raw(
            _per_column(
                """select '@c' as "column", count(@c) as count, round(avg(@c), 6) as mean,
              round(stddev_samp(@c), 6) as std, cast(min(@c) as double) as min,
              round(quantile_cont(@c, 0.25), 6) as q25, round(quantile_cont(@c, 0.5), 6) as q50,
              round(quantile_cont(@c, 0.75), 6) as q75, cast(max(@c) as double) as max from raw""",
                PROFILE_COLUMNS[4:],
            )
        ),
        "describe_text": _raw(
            _per_column(
                """select '@c' as "column", cast(sum(n) as bigint) as count,
              count(*) as "unique", arg_min(v, (-n, v)) as top, max(n) as freq
              from (select @c as v, count(*) as n from raw where @c is not null group by 1)""",
                PROFILE_COLUMNS[:4],
            )
        ),
        "distinct_counts": _raw(
            _per_column(
                "select '@c' as \"column\", count(distinct @c) as unique_count from monthly",
                ["state", "district", "pincode", "month"],
            )
        ),
        "distinct_labels": _raw("select distinct district from raw where district is not null"),
        "districts_per_state": _raw(
            """select state, count(distinct district) as district_nunique from raw
              where state is not null group by state"""
        ),
        "fd_pincode_district": _raw(
            """select pincode, count(distinct district) as district_nunique from raw
              group by pincode having count(distinct district) > 1"""
        ),
        "fd_district_state": _raw(
            """select district, count(distinct state) as state_nunique from raw
              group by district having count(distinct state) > 1"""
        ),
        "fd_violation_counts": _raw(
            """select 'pincode_district' as metric, count(*) as value from (
                select pincode from raw group by pincode having count(distinct district) > 1)
              union all select 'district_state', count(*) from (
                select district from raw group by district having count(distinct state) > 1)"""
        ),
        "fd_in_state": _raw(
            """select pincode, count(distinct district) as district_count from raw
              where lower(trim(state)) = 'asia' group by pincode
              having count(distinct district) > 1"""
        ),
        "date_range": _raw(
            """select min(d) as min_date, max(d) as max_date,
              count(*) filter (d is null) as null_dates from parsed"""
        ),
        "monthly_total": _raw(
            """select month, cast(sum(total) as bigint) as total from monthly
              where month is not null group by month"""
        ),
        "monthly_total_with_invalid": _raw(
            """select coalesce(month, 'NaT') as month, cast(sum(total) as bigint) as total
              from monthly group by 1"""
        ),
        "monthly_rows": _raw(
            "select coalesce(month, 'NaT') as month, count(*) as row_count from monthly group by 1"
        ),
        "state_month_total": _raw("select * from series", SERIES),
        "decile_edges": _raw(
            """select cast(i - 1 as integer) as idx, round(e[i], 6) as edge
              from (select e, unnest(range(1, len(e) + 1)) as i from edges)""",
            _edges("parsed"),
        ),
        "histogram_counts": _raw(
            """select cast(g.bin as integer) as bin, round(e[g.bin], 6) as lower_edge,
              round(e[g.bin + 1], 6) as upper_edge, count(b.bin) as n
              from (select e, unnest(range(1, len(e))) as bin from edges) g
              left join binned b on g.bin = b.bin group by 1, 2, 3""",
            _edges("parsed")
            + """binned as (select least(len(list_filter(e, lambda y: y <= total)), len(e) - 1) as bin
              from parsed, edges where total between e[1] and e[len(e)]),""",
        ),
        "kpi_rollup": _raw(
            """select strftime(date, '%Y-%m') as month, state, district,
              cast(grouping(strftime(date, '%Y-%m'), state, district) as bigint) as level,
              cast(sum(age_0_5) as bigint) as age_0_5, cast(sum(age_5_17) as bigint) as age_5_17,
              cast(sum(age_18_greater) as bigint) as age_18_greater
              from silver group by grouping sets (
                (strftime(date, '%Y-%m'), state, district),
                (strftime(date, '%Y-%m'), state), (strftime(date, '%Y-%m')))""",
            _silver(False),
        ),
        "kpi_cube": _raw(
            """select state, month, cast(grouping(state, month) as bigint) as level,
              cast(sum(age_0_5) as bigint) as age_0_5, cast(sum(age_5_17) as bigint) as age_5_17,
              cast(sum(age_18_greater) as bigint) as age_18_greater
              from (select *, strftime(date, '%Y-%m') as month from silver)
              group by cube (state, month)""",
            _silver(False),
        ),
        "dedup_keep_first": _raw("select * from first", FIRST),
        "duplicate_groups": _raw(
            """select * exclude (n) from (select *, count(*) over (
                partition by date, state, district, pincode) as n from raw) where n > 1"""
        ),
        "zscore_outliers": _raw(
            """select date, state, district, pincode, ingest_seq, total, round(z, 6) as z
              from (select *, (total - (select avg(total) from parsed))
                / nullif((select stddev_samp(total) from parsed), 0) as z from parsed)
              where abs(z) > 1.5"""
        ),
        "state_month_pct_change": _raw(
            "select state, month, total, round(pct, 6) as pct_change from scored", ANOMALY
        ),
        "mom_growth": _raw(
            """select month, total, round((total / nullif(cast(
                lag(total) over (order by month) as double), 0) - 1) * 100, 6) as mom_growth_pct
              from (select month, cast(sum(total) as bigint) as total from monthly
                where month is not null group by month)"""
        ),
        "trend_moving_avg": _raw(
            """select state, month, total,
              round(avg(total) over (partition by state order by month
                rows between 2 preceding and current row), 6) as moving_avg_3,
              cast(sum(total) over (partition by state order by month
                rows unbounded preceding) as bigint) as cumulative from series""",
            SERIES,
        ),
        "state_rank_by_month": _raw(
            """select * from (select *, rank() over (
                partition by month order by total desc) as rank from series) where rank <= 3""",
            SERIES,
        ),
        "top_conflict_pincodes": _raw(
            """select pincode, count(distinct district) as district_nunique from raw
              group by pincode having count(distinct district) > 1
              order by 2 desc, 1 limit 20"""
        ),
        "last_n_months": _raw(
            """select month, count(*) as row_count from monthly where month is not null
              group by month order by month desc limit 24"""
        ),
        "distinct_keys": _raw(
            """select distinct state, district, pincode from raw where state is not null
              and district is not null and pincode is not null"""
        ),
        "key_except": _raw("select * from ek except select * from dk", KEY_SETS),
        "key_intersect": _raw("select * from ek intersect select * from dk", KEY_SETS),
        "duplicate_impact": _raw(
            """select 'full_row_duplicates_before' as metric, v as value from dup_full
              union all select 'grain_duplicates_before', v from dup_key
              union all select 'rows_before', count(*) from raw
              union all select 'grain_duplicates_after', coalesce(cast(sum(n - 1) as bigint), 0)
                from (select count(*) as n from first group by date, state, district, pincode)
              union all select 'rows_after', count(*) from first""",
            DUPLICATE_COUNTS,
            FIRST,
        ),
        "contract_check": _contract("first", FIRST),
        "contract_check_raw": _contract("raw"),
        "key_null_check": _raw(
            _per_column(
                """select '@c' as key_column, count(*) filter (@c is null) as null_count,
              round(100.0 * count(*) filter (@c is null) / greatest(count(*), 1), 4) as null_pct from raw""",
                PROFILE_COLUMNS[:4],
            )
        ),
        "column_roles": _raw(
            "\nunion all\n".join(
                f"select '{c}' as \"column\", '{role}' as role, '{dtype}' as dtype, "
                f"{NULL_PCT.replace('@c', c)} as null_pct, "
                f"count(distinct {c}) as unique_count from raw"
                for c, role, dtype in [
                    *[(c, ROLES[c], TYPES[c]) for c in PROFILE_COLUMNS],
                    ("ingest_seq", "Attribute", "bigint"),
                ]
            )
        ),
        "key_feasibility": _raw(
            """select 'enrollment' as "table", count(*) as rows, true as has_all_keys from raw
              union all select 'demographic', count(*), true from demo
              union all select 'biometric', count(*), true from bio"""
        ),
        "psi_drift": _raw(f"select period as year, psi {yearly}", yearly_ctes),
        "psi_drift_monthly": _raw(f"select period as month, psi {by_month}", monthly_ctes),
        "state_month_anomaly": _raw(_anomaly(0.6, 3), ANOMALY),
        "state_month_anomaly_sensitive": _raw(_anomaly(0.2, 1.5), ANOMALY),
        "rule_status": _raw(
            "\nunion all\n".join(
                rule.format(*r)
                for r in [
                    ("Natural key uniqueness", "0 duplicates", "key_duplicates"),
                    ("Key null checks", "0 null keys", "null_keys"),
                    ("No negative age counts", "0 negative rows", "negative_rows"),
                    ("Pincode stability", "minimal conflicts", "pincode_conflicts"),
                    ("Trend stability", "explainable spikes", "anomalies"),
                ]
            ),
            QUALITY,
        ),
        "risk_register": _raw(
            "\nunion all\n".join(
                risk.format(*r)
                for r in [
                    (
                        "R1",
                        "Duplicate business keys",
                        "High",
                        "key duplicate count",
                        "key_duplicates",
                    ),
                    (
                        "R2",
                        "Null key fields",
                        "High",
                        "nulls in date/state/district/pincode",
                        "null_keys",
                    ),
                    (
                        "R3",
                        "District/state naming inconsistency",
                        "Medium",
                        "mapping coverage and mismatch rows",
                        "spelling_variants",
                    ),
                    (
                        "R4",
                        "Pincode referential conflicts",
                        "Medium",
                        "pincode->district/state nunique",
                        "pincode_conflicts",
                    ),
                    (
                        "R5",
                        "Outlier spikes",
                        "Medium",
                        "z-score and pct-change anomalies",
                        "anomalies",
                    ),
                ]
            ),
            QUALITY,
        ),
        "summary_metrics": _raw(
            f"""select 'rows' as metric, count(*) as value from raw
              union all select 'columns', 7
              union all select 'null_cells_total', cast({NULL_CELLS} as bigint) from raw
              union all select 'full_row_duplicates', v from dup_full
              union all select 'duplicates_key', v from dup_key
              union all select 'unique_states', count(distinct state) from raw""",
            DUPLICATE_COUNTS,
        ),
        "findings_table": _raw(
            f"""select 'Grain' as section,
                'enrolment counts, one row per date-state-district-pincode' as details
              union all select 'Natural Key', '(date, state, district, pincode)'
              union all select 'Identified issues', printf(
                'Full duplicates=%d; Key duplicates=%d; Total nulls=%d; Negative-age rows=%d',
                {value_of("full_duplicates")}, {value_of("key_duplicates")},
                {value_of("null_cells")}, {value_of("negative_rows")})
              union all select 'Data inconsistencies', printf(
                'Pincode mapped to multiple districts=%d', {value_of("pincode_conflicts")})
              union all select 'Expected fixes',
                'Keep one row per key; enforce contracts; map names; quarantine'
              union all select 'Modeling direction',
                'Join facts on date and location; publish checked rows only'""",
            QUALITY,
        ),
        "month_completeness": _raw(
            """select strftime(s.m, '%Y-%m') as month, count(p.d) as row_count,
              min(p.d) as min_date, max(p.d) as max_date
              from (select unnest(generate_series(
                  (select date_trunc('month', min(d)) from parsed),
                  (select date_trunc('month', max(d)) from parsed), interval 1 month)) as m) s
              left join parsed p on date_trunc('month', p.d) = s.m group by s.m"""
        ),
        "silver_valid": _raw("select * from valid", _silver(True)),
        "silver_quarantine": _raw(
            """select date, state, district, pincode, cast(age_0_5 as bigint) as age_0_5,
              cast(age_5_17 as bigint) as age_5_17,
              cast(age_18_greater as bigint) as age_18_greater, ingest_seq,
              concat_ws(',', case when not ok_date then 'valid_date' end,
                case when not ok_pin then 'valid_6_digit_pincode' end,
                case when not ok_age then 'non_negative_age' end,
                case when not ok_state then 'state_present' end,
                case when not ok_district then 'district_present' end) as reasons
              from judged
              where not (ok_date and ok_pin and ok_age and ok_state and ok_district)""",
            VALID,
        ),
        "silver_rows": _raw("select * from silver", _silver(True)),
        "quality_score": _raw(
            """select count(*) as rows, round((1 - (
                3.0 * count(*) filter (not ok_date) + 2.0 * count(*) filter (not ok_pin)
                + 3.0 * count(*) filter (not ok_age) + 3.0 * count(*) filter (not ok_state)
                + 1.0 * count(*) filter (not ok_district)) / count(*) / 12.0) * 100, 6) as quality_score
              from judged""",
            VALID,
        ),
        "freshness": _raw(
            """select state, max(d) as max_date,
              cast(date '2001-12-31' - max(d) as bigint) as lag_days
              from parsed where state is not null group by state"""
        ),
        "balance_check": """
            with o as (
              select sum(q) as total, coalesce(sum(q) filter (l_returnflag = 'A'), 0) as a,
                coalesce(sum(q) filter (l_returnflag = 'N'), 0) as n,
                coalesce(sum(q) filter (l_returnflag = 'R'), 0) as r,
                coalesce(sum(q) filter (l_linestatus = 'F'), 0) as f, max(net) as top_line,
                any_value(o_totalprice) as price
              from (select *, floor(l_quantity) as q,
                  cast(l_extendedprice as decimal(18,2))
                    * (1 - cast(l_discount as decimal(4,2))) as net
                from lineitem join orders on l_orderkey = o_orderkey)
              group by l_orderkey)
            select 'flags_sum_to_total' as "check", count(*) filter (a + n + r <> total) as failed_rows
              from o
            union all select 'finished_within_total', count(*) filter (f > total) from o
            union all select 'line_within_order',
              count(*) filter (top_line > cast(price as decimal(18,2))) from o""",
        "dim_date": _raw(
            """select cast(strftime(x, '%Y%m%d') as integer) as date_key, cast(x as date) as date,
              cast(year(x) as integer) as year, cast(quarter(x) as integer) as quarter,
              cast(month(x) as integer) as month_of_year, cast(day(x) as integer) as day_of_month,
              strftime(x, '%Y-%m') as month
              from (select unnest(generate_series(cast((select min(d) from parsed) as timestamp),
                cast((select max(d) from parsed) as timestamp), interval 1 day)) as x)"""
        ),
        "dim_location": _raw(
            f"""select distinct {LOCATION_KEY} as location_key,
              state, district, pincode from silver""",
            _silver(False),
        ),
        "linkage_kpi": """
            with geo as (
              select c_custkey, r_name as state from customer
              join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey)
            select state, strftime(o_orderdate, '%Y-%m') as month, count(*) as total,
              count(*) filter (o_orderstatus = 'F') as linked, count(*) filter (o_orderstatus = 'P') as pending,
              count(*) filter (o_orderstatus = 'O') as rejected,
              round(100.0 * (cast(count(*) filter (o_orderstatus = 'F') as double) / count(*)), 2)
                as linkage_pct
            from orders join geo on o_custkey = c_custkey group by 1, 2""",
        "net_change_kpi": """
            with geo as (
              select c_custkey, r_name as state from customer
              join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey),
            s as (
              select state, strftime(l_shipdate, '%Y-%m') as month,
                cast(sum(q) as bigint) as total,
                cast(sum(case when l_returnflag = 'A' then q else 0 end) as bigint) as accepted,
                cast(sum(case when l_returnflag = 'N' then q else 0 end) as bigint) as normal,
                cast(sum(case when l_linestatus = 'O' then q else 0 end) as bigint) as "new",
                cast(sum(case when l_returnflag = 'R' then q else 0 end) as bigint) as deletions
              from (select *, cast(floor(l_quantity) as bigint) as q from lineitem)
              join orders on l_orderkey = o_orderkey join geo on o_custkey = c_custkey
              group by 1, 2)
            select *, "new" - deletions as net_change,
              greatest(total - accepted - normal, 0) as other from s""",
        "scheme_funnel_kpi": """
            with s as (
              select coalesce(p_type, 'Other') as scheme_type,
                cast(sum(q) as bigint) as applications,
                cast(sum(case when l_returnflag <> 'R' then q else 0 end) as bigint) as approved,
                cast(sum(case when l_returnflag <> 'R' and l_linestatus = 'F' then q else 0 end)
                  as bigint) as disbursed,
                cast(sum(cast(l_extendedprice as decimal(18,2))
                  * (1 - cast(l_discount as decimal(4,2)))) as double) as amount
              from (select *, cast(floor(l_quantity) as bigint) as q from lineitem)
              left join part on l_partkey = p_partkey group by 1)
            select *, round(cast(approved as double) / nullif(applications, 0) * 100, 2)
                as approval_pct,
              round(cast(disbursed as double) / nullif(approved, 0) * 100, 2) as disbursal_pct,
              round(coalesce(amount / nullif(disbursed, 0), 0), 4) as amount_per_head from s""",
        "location_pool": _raw(
            """select state, district, cast(base + i as varchar) as pincode
              from (select state, district, 100000 + min(c_custkey) * 10 as base
                from geo group by all), (select unnest(range(0, 4)) as i)"""
        ),
        "dense_location_month": _raw(
            """select l.state, l.district, strftime(m, '%Y-%m') as month,
              cast(coalesce(sum(age_0_5), 0) as bigint) as age_0_5,
              cast(coalesce(sum(age_5_17), 0) as bigint) as age_5_17,
              cast(coalesce(sum(age_18_greater), 0) as bigint) as age_18_greater
              from (select distinct state, district from silver) l
              cross join (select unnest(generate_series(
                (select date_trunc('month', min(date)) from silver),
                (select date_trunc('month', max(date)) from silver), interval 1 month)) as m)
              left join silver s on s.state = l.state and s.district = l.district
                and date_trunc('month', s.date) = m
              group by 1, 2, 3""",
            _silver(False),
        ),
    }
