"""SQL for DuckDB that gives the registered queries' rows from the same tables."""

from __future__ import annotations

_LONG = """
ev as (
  select cast(user_id as varchar) as uuid, concat('g', cast(event_id % 2 as varchar)) as "group",
    cast(row_number() over (partition by user_id, event_id % 2 order by ts, event_id) - 1 as bigint) as sample_offset, event_type as channel_id,
    (epoch_us(ts) - min(epoch_us(ts)) over (partition by user_id, event_id % 2)) / 1e6 as elapsed_time_s,
    strftime(ts, '%Y-%m-%d %H:%M:%S') as "timestamp", value, concat('S', cast(user_id % 4 as varchar)) as series, event_id, props
  from events)"""
_MAP = """
mp(series, raw_channel, std) as (values ('S0', 'view', 'Stack Voltage'), ('S0', 'click', 'Current density'), ('S1', 'view', 'Faradaic Efficiency of CO'),
  ('S2', 'purchase', 'Energy Efficiency'), ('S3', 'error', 'Single Pass Conversion Efficiency'))"""
_SIG = """
sig as (
  select e.uuid, e."group", e.series, e.channel_id, coalesce(mp.std, e.channel_id) as std_channel, concat('u', cast(length(e.channel_id) as varchar)) as unit,
    cast(row_number() over (partition by e.uuid, e."group" order by e.channel_id) - 1 as int) as column_index
  from (select distinct uuid, "group", series, channel_id from ev) e left join mp on mp.series = e.series and mp.raw_channel = e.channel_id)"""
_FACT = """
fact as (
  select s.uuid, s."group", s.series, s.std_channel, e.sample_offset, e.elapsed_time_s, strptime(e."timestamp", '%Y-%m-%d %H:%M:%S') as ts, e.value
  from ev e join sig s using (uuid, "group", channel_id))"""
_BINS = """
bins as (
  select uuid, "group", series, std_channel, cast(floor(elapsed_time_s / 60) * 60 as bigint) as elapsed_bin_s, min(elapsed_time_s) as elapsed_time_s,
    first(ts order by elapsed_time_s, sample_offset) as ts, avg(value) as value_mean, min(value) as value_min, max(value) as value_max, count(value) as value_count
  from fact where elapsed_time_s is not null and not isnan(elapsed_time_s) and value is not null group by all)"""
_ALL = f"with {_LONG}, {_MAP}, {_SIG}, {_FACT}, {_BINS}"
_SHOW = """select uuid, "group", series, std_channel, elapsed_bin_s, round(elapsed_time_s, 6) as elapsed_time_s, epoch_us(ts) as ts_us,
  round(value_mean, 6) as value_mean, round(value_min, 6) as value_min, round(value_max, 6) as value_max, cast(value_count as bigint) as value_count"""


def _tier(seconds: int) -> str:
    return f"""
tier as (
  select uuid, "group", series, std_channel, cast(floor(elapsed_bin_s / {seconds}) * {seconds} as bigint) as elapsed_bin_s, min(elapsed_time_s) as elapsed_time_s,
    first(ts order by b.elapsed_bin_s) as ts, sum(value_mean * value_count) / sum(value_count) as value_mean, min(value_min) as value_min,
    max(value_max) as value_max, sum(value_count) as value_count
  from bins b group by uuid, "group", series, std_channel, floor(elapsed_bin_s / {seconds}))"""


_FACT_SHOW = """select uuid, "group", series, std_channel, sample_offset, round(elapsed_time_s, 6) as elapsed_time_s, round(value, 6) as value,
  epoch_us(ts) as ts_us, cast(null as varchar) as value_str from fact"""

_WIDE = """
w as (
  select concat('file-', cast(l_suppkey as varchar)) as uuid, l_returnflag as "group",
    cast(row_number() over (partition by l_suppkey, l_returnflag order by l_shipdate, l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity, l_discount, l_tax) - 1 as bigint) as sample_offset,
    l_quantity as current, l_extendedprice / 10000 as v_stack, l_discount * 1000 as fe_co, l_tax * 1000 as fe_h2, l_quantity * 2 as fe_o2, l_quantity / 10 as co2_in,
    l_discount * 1000 as ratio, l_tax as p_in, l_discount as p_out
  from lineitem),
m0 as (
  select *, fe_co / 100 * current / (2 * 96485.3) * 22.414 * 60 as co, fe_h2 / 100 * current / (2 * 96485.3) * 22.414 * 60 as h2,
    fe_o2 / 100 * current / (4 * 96485.3) * 22.414 * 60 as o2, ratio / 100 as r from w),
m1 as (select *, co2_in - co as total, case when 1 - r = 0 then null else r * o2 / (1 - r) end as anode from m0),
m as (
  select uuid, "group", sample_offset, case when v_stack = 0 then null else 1.48 * fe_co / (v_stack / 5) end as dm1, p_in - p_out as dm2, 1000 * current / 88.0 as dm3,
    fe_co + fe_h2 as dm4, co as dm5, h2 as dm6, o2 as dm7, total as dm8, anode as dm9, total - anode as dm10, case when h2 = 0 then null else co / h2 end as dm11,
    case when co2_in = 0 then null else 100 * (current * (fe_co / 100) / (2 * 96485.3)) / (co2_in / 60 / 5 / 22.414) end as dm12
  from m1)"""
_SIGNALS = ["current", "v_stack", "fe_co", "fe_h2", "fe_o2", "co2_in", "ratio", "p_in", "p_out"]
_CHANNELS = ", ".join(f"('{s}')" for s in _SIGNALS)

_CHECKED = f"""with {_LONG},
ck0 as (select uuid, "group", sample_offset, channel_id, value, event_id,
  case when event_id % 11 = 0 then null when event_id % 13 = 0 then 'garbage' else "timestamp" end as "timestamp" from ev)"""
_TWICE = f"""{_CHECKED},
ck as (select * from ck0 union all select * from ck0 where event_id % 17 = 0),
fl as (
  select *, 'ts_timestamp_not_null' as rule_id, false as is_blocking from ck where "timestamp" is null
  union all select *, 'ts_timestamp_parseable', false from ck where "timestamp" = 'garbage'
  union all select *, 'ts_unique_point', true from (select * from ck qualify count(*) over (partition by uuid, "group", sample_offset, channel_id) > 1))"""
_KEY = 'uuid, "group", sample_offset, channel_id'
_IN = f'({_KEY}) in (select ({_KEY}) from fl)'

_FORMATS = ["%Y-%m-%d %H:%M:%S", "%Y-%m-%d %H:%M:%S.%g", "%Y/%m/%d %H:%M:%S", "%d.%m.%Y %H:%M:%S", "%m/%d/%Y %H:%M:%S", "%Y-%m-%dT%H:%M:%S", "%Y-%m-%dT%H:%M:%S.%g"]
_RAW = "case event_id % 8 " + " ".join(f"when {k} then strftime(ts, '{f}')" for k, f in enumerate(_FORMATS)) + " else 'garbage' end"

_FILES = """
f as (select concat('series-', cast(o_custkey % 10 as varchar), '/', cast(o_orderkey as varchar), '.xlsx') as blob_path, o_orderkey as file_size, o_orderdate as last_modified,
  case when o_orderstatus = 'F' then 'FAILED' else 'SUCCESS' end as status, cast(o_orderkey % 8 as int) as retry_count from orders),
t as (select blob_path, file_size, case when file_size % 5 = 0 then last_modified - interval 1 day else last_modified end as last_modified, status,
  case when status = 'FAILED' then 'bad' end as error_message, 1.0::double as duration_seconds, retry_count from f where file_size % 3 <> 0)"""

_GRID = """
n as (select concat('file-', cast(l_suppkey as varchar)) as uuid, l_returnflag as "group", l_shipdate, l_quantity, l_linenumber, l_linestatus,
  row_number() over (partition by l_suppkey, l_returnflag order by l_shipdate, l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity, l_discount, l_tax) - 1 as i from lineitem),
x as (select uuid, "group", cast(i as bigint) as sample_offset, cast(i + case when "group" = 'A' then 3 else 2 end as bigint) as row_idx,
  concat(strftime(l_shipdate, '%Y-%m-%d'), ' 10:', lpad(cast(i % 60 as varchar), 2, '0'), ':00') as "timestamp", cast(i + 10 as double) as elapsed_time_s,
  cast(l_quantity as int)::double as ch, cast(l_quantity * 10 as int)::double as ch1, l_linenumber * 30.0::double as eff, concat('is ', l_linestatus) as note from n)"""


_DENSE = """
b as (select series, experiment_id, cast(floor(t / 600) * 600 as bigint) as elapsed_bin_s, min(t) as elapsed_time_s, min(t) as ts, avg(v) as value_mean, min(v) as value_min, max(v) as value_max, count(v) as value_count
  from (select "group" as series, cast(regexp_extract(uuid, '[0-9]+') as bigint) as experiment_id, sample_offset * 20 as t, v_stack as v, current, fe_co from w) where current < 48 and fe_co > 5 group by all)"""
_DENSE_SHOW = """series, experiment_id, elapsed_bin_s, round(cast(elapsed_time_s as double), 6) as elapsed_time_s, cast(ts * 1000000 as bigint) as ts_us,
  round(value_mean * value_count, 6) as value_total, round(value_min, 6) as value_min, round(value_max, 6) as value_max, cast(value_count as bigint) as value_count"""


def _digest(c: str) -> str:
    return f"sha1(unhex('a1b2c3d4e5f67890abcdef1234567890') || encode({c}))"


def _uuid5(c: str) -> str:
    """A version-5 UUID from the digest ``d``."""
    return "concat(substr(d, 1, 8), '-', substr(d, 9, 4), '-5', substr(d, 14, 3), '-', format('{:x}', 8 + (instr('0123456789abcdef', substr(d, 17, 1)) - 1) % 4), substr(d, 18, 3), '-', substr(d, 21, 12))"


def _derived_sheet() -> str:
    """Metrics that the grids' inputs allow: current density, in sheets whose second channel is called Current."""
    return """union all select uuid, "group", sample_offset, "timestamp", elapsed_time_s, 'Current density', 1000 * ch1 / 88.0, null from x where "group" <> 'N'"""


def _jobs() -> str:
    """The line items' sheets in all gold tables."""
    tier = lambda s: f"""t{s} as (select uuid, "group", series, std_channel, cast(floor(elapsed_time_s / {s}) * {s} as double) as "at", count(value) as n, sum(value) as total from f where value is not null group by all)"""
    show = """select '{}' as of_table, uuid, "group", series, std_channel, {} as "at", {} as n, round({}, 6) as total, {} as info from {}"""
    volt = "std_channel = 'Stack Voltage'"
    parts = [
        show.format("timeseries", "elapsed_time_s", "sample_offset", "value", "coalesce(note, \"timestamp\")", "f"),
        *[show.format(f"timeseries_agg_{m}min", "\"at\"", "n", "total", "cast(null as varchar)", f"t{m * 60}") for m in (1, 15, 60)],
        show.format("experiment_index", "\"at\"", "n", "total", "info", "i"),
        show.format("channel_catalog_experiment", "cast(null as double)", "n", "cast(null as double)", "unit", "c"),
    ]
    return f"""with {_GRID},
l as (select uuid, "group", sample_offset, "timestamp", elapsed_time_s, 'CH' as channel_id, ch as value, null as note from x
  union all select uuid, "group", sample_offset, "timestamp", elapsed_time_s, 'CH_1', ch1, null from x
  union all select uuid, "group", sample_offset, "timestamp", elapsed_time_s, 'Efficiency', case when "group" = 'R' then eff else least(eff, 100.0) end, null from x
  union all select uuid, "group", sample_offset, "timestamp", elapsed_time_s, 'Note', null, note from x {_derived_sheet()}),
f as (select l.*, concat('S', cast(cast(regexp_extract(uuid, '[0-9]+') as bigint) % 2 as varchar)) as series,
    case when channel_id = 'CH' and "group" <> 'N' and cast(regexp_extract(uuid, '[0-9]+') as bigint) % 2 = 0 then 'Stack Voltage'
      when channel_id = 'Efficiency' and cast(regexp_extract(uuid, '[0-9]+') as bigint) % 2 = 1 then 'Energy Efficiency' else channel_id end as std_channel from l),
{tier(60)}, {tier(900)}, {tier(3600)},
i as (select uuid, "group", series, cast(null as varchar) as std_channel, max(floor(elapsed_time_s / 60) * 60) + 60 - min(elapsed_time_s) as "at", count(value) as n,
    sum(value) filter ({volt}) / count(value) filter ({volt}) as total, concat(uuid, '.xlsx') as info from f where value is not null group by uuid, "group", series),
c as (select uuid, "group", series, std_channel, case when count(value) > 0 then 1::bigint else 0::bigint end as n,
    case when channel_id = 'Current density' then 'mA/cm²' when "group" = 'R' or channel_id = 'Note' then '' when channel_id = 'CH' then 'V' when channel_id = 'CH_1' then 'A' else '%' end as unit
  from f group by uuid, "group", series, std_channel, channel_id)
""" + " union all ".join(parts)


def oracle_sql() -> dict[str, str]:
    index = f"""{_ALL}
select series, uuid, "group", count(distinct std_channel) as channel_count, cast(sum(value_count) as bigint) as total_data_points, concat(uuid, '.xlsx') as source_file_name,
  any_value(n) as source_file_size, round(min(elapsed_time_s), 6) as start_time_s, round(max(cast(elapsed_bin_s as double) + 60), 6) as end_time_s,
  round(max(cast(elapsed_bin_s as double) + 60) - min(elapsed_time_s), 6) as duration_s,
  {", ".join(f"round(sum(value_mean * value_count) filter (std_channel = '{c}') / sum(value_count) filter (std_channel = '{c}'), 6) as {n}" for n, c in (("avg_stack_voltage_v", "Stack Voltage"), ("avg_energy_efficiency_pct", "Energy Efficiency"), ("avg_fe_co_pct", "Faradaic Efficiency of CO"), ("avg_fe_h2_pct", "Faradaic Efficiency of H2"), ("avg_spce_pct", "Single Pass Conversion Efficiency")))},
  round(max(value_max) filter (std_channel = 'Current density'), 6) as peak_current_density_ma_cm2, epoch_us(min(ts)) as start_timestamp, epoch_us(max(ts)) as end_timestamp,
  epoch_us(any_value(last)) as source_last_modified, epoch_us(any_value(last)) as ingested_at
from bins join (select uuid, "group", count(*) as n, strptime(max("timestamp"), '%Y-%m-%d %H:%M:%S') as last from ev group by all) using (uuid, "group") group by uuid, "group", series"""
    return {
        "agg_1min": f"{_ALL} {_SHOW} from bins",
        "agg_15min": f"{_ALL}, {_tier(900)} {_SHOW} from tier",
        "agg_60min": f"{_ALL}, {_tier(3600)} {_SHOW} from tier",
        "gold_fact": f"{_ALL} {_FACT_SHOW}",
        "gold_fact_new_only": f"{_ALL} {_FACT_SHOW} where \"group\" <> 'g0'",
        "agg_backfill": f"{_ALL} {_SHOW} from bins where \"group\" = 'g0'",
        "experiment_index": index,
        "channel_catalog_experiment": f"""{_ALL} select s.uuid, s."group", s.series, s.std_channel, s.unit, s.std_channel <> 'signup' and b.uuid is not null as has_data
            from sig s left join (select distinct uuid, "group", std_channel from bins) b using (uuid, "group", std_channel)""",
        "channel_catalog_series": f"{_ALL} select distinct series, std_channel, unit from sig",
        "serve_series": f"{_ALL}, {_tier(3600)} {_SHOW} from tier where series = 'S0' and std_channel in ('Stack Voltage', 'purchase')",
        "serve_drilldown": f"{_ALL} {_SHOW} from bins where series = 'S0' and std_channel = 'Stack Voltage' and uuid = '4' and \"group\" = 'g0'",
        "unpivot_long": f"""with {_WIDE} select uuid, "group", sample_offset, channel_id,
            round(case channel_id {" ".join(f"when '{s}' then {s if s != 'p_out' else 'case when p_out > 0 then p_out end'}" for s in _SIGNALS)} end, 6) as value, cast(null as varchar) as value_str
            from w cross join (values {_CHANNELS}) c(channel_id)""",
        "value_split": """select event_id, round(case when event_id % 3 = 0 then round(value, 3) end, 6) as value,
            case when event_id % 3 = 0 then null when event_id % 7 = 1 then concat(cast(event_id as varchar), 'd') else props end as value_str from events""",
        "derived_metrics": f"""with {_WIDE} select uuid, "group", sample_offset, {", ".join(f"round(dm{k}, 6) as dm{k}" for k in range(1, 13))} from m""",
        "plausibility_clip": f"""with {_WIDE} select uuid, "group", sample_offset, metric, round(least(greatest(v, 0.0), 100.0), 6) as value from (
            select uuid, "group", sample_offset, metric, case metric when 'dm1' then dm1 when 'dm4' then dm4 else dm12 end as v from m cross join (values ('dm1'), ('dm4'), ('dm12')) c(metric))
            where v is not null union all select uuid, "group", sample_offset, metric, null from (
            select uuid, "group", sample_offset, metric, case metric when 'dm1' then dm1 when 'dm4' then dm4 else dm12 end as v from m cross join (values ('dm1'), ('dm4'), ('dm12')) c(metric)) where v is null""",
        "sheet_statistics": f"""with {_WIDE} select uuid, "group", cast(9 as int) as n_channels, count(distinct sample_offset) as n_rows, 9 * count(distinct sample_offset) as n_timeseries_rows from w group by all""",
        "channel_rows": f"""with {_WIDE} select uuid, "group", channel_id, channel_id as raw_channel, case when channel_id like 'fe%' then '%' else '' end as unit,
            cast(row_number() over (partition by uuid, "group" order by channel_id) - 1 as int) as column_index from (select distinct uuid, "group" from w) cross join (values {_CHANNELS}) c(channel_id)""",
        "dim_experiment": f"""with {_LONG} select distinct uuid, "group", series, cast(1 as bigint) as ids from ev where cast(uuid as bigint) % 10 <> 3""",
        "dim_experiment_orphans": f"""with {_LONG} select distinct uuid, "group" from ev where cast(uuid as bigint) % 10 = 3""",
        "dim_signal": f"""{_ALL} select uuid, "group", series, std_channel, channel_id, channel_id as raw_channel, unit, column_index from sig""",
        "dim_signal_conflicts": f"""with {_LONG} select uuid, "group", 'Stack Voltage' as std_channel, cast(2 as bigint) as n, 'click,view' as channels from ev
            where series = 'S0' and channel_id in ('click', 'view') group by uuid, "group" having count(distinct channel_id) = 2""",
        "parse_timestamps": f"""select event_id, raw, epoch_us(coalesce({", ".join(f"try_strptime(raw, '{f}')" for f in _FORMATS)})) as ts_us from (select event_id, {_RAW} as raw from events)""",
        "dq_not_null": f"""{_CHECKED} select uuid, "group", sample_offset, channel_id, 'ts_timestamp_not_null' as rule_id, event_id, 'high' as severity, 'FAILED' as status from ck0 where "timestamp" is null""",
        "dq_timestamp_parse": f"""{_CHECKED} select uuid, "group", sample_offset, channel_id, 'ts_parse' as rule_id, event_id, "timestamp" from ck0 where "timestamp" = 'garbage' and channel_id in ('view', 'click')""",
        "dq_duplicate_key": """select concat('file-', cast(l_suppkey as varchar)) as uuid, l_returnflag as "group", l_orderkey as sample_offset, concat('c', cast(l_linenumber as varchar)) as channel_id, 'dup' as rule_id,
            strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') as "timestamp", round(l_quantity, 6) as value from lineitem qualify count(*) over (partition by l_orderkey, l_linenumber) > 1""",
        "dq_monotonic": """select uuid, "group", sample_offset, channel_id, 'mono' as rule_id, "timestamp" from (
            select *, lag("timestamp") over (partition by uuid, "group" order by sample_offset, channel_id) as before from (
              select distinct concat('file-', cast(l_suppkey as varchar)) as uuid, l_returnflag as "group", l_orderkey as sample_offset, concat('c', cast(l_linenumber as varchar)) as channel_id,
                lpad(cast(l_orderkey * 7919 % 86400 as varchar), 5, '0') as "timestamp" from lineitem)) where "timestamp" < before""",
        "dq_all": f"""{_TWICE} select {_KEY}, rule_id, is_blocking, cast(7 as bigint) as dq_batch_id, count(*) as n, max("timestamp") as observed from fl group by all""",
        "dq_summary": f"""{_TWICE} select rule_id, case rule_id when 'ts_timestamp_not_null' then 'Timestamp must be present' when 'ts_timestamp_parseable' then 'Timestamp must be parseable' else 'Timeseries point key must be unique' end as rule_name,
            'high' as severity, is_blocking, count(*) as total_failed, count(distinct uuid) as affected_files from fl group by all""",
        "dq_clean": f"""{_TWICE} select event_id, sample_offset, true as is_valid from ck where ({_KEY}) not in (select ({_KEY}) from fl where is_blocking)""",
        "dq_flag": f"""{_TWICE} select event_id, sample_offset, not {_IN} as is_valid from ck""",
        "dq_delete": f"""{_TWICE} select event_id, sample_offset from ck where not {_IN}""",
        "sanitize_name": r"""select page_id, trim(regexp_replace(regexp_replace(url, '[<>:"/\\|?*()\[\] ]', '_', 'g'), '_+', '_', 'g'), '_') as name from pages""",
        "series_from_path": """select page_id, case when len(p) >= 2 then p[-2] end as series from (
            select page_id, list_filter([trim(x) for x in string_split(replace(url, '\\', '/'), '/')], lambda x: x <> '') as p from pages)""",
        "unit_row_detection": """select distinct concat('file-', cast(l_suppkey as varchar)) as uuid, l_returnflag as "group", cast(r as bigint) as row_idx,
            (l_returnflag = 'A' and r = 2) or (l_returnflag = 'N' and r = 1) as is_units from lineitem cross join (values (1), (2)) c(r)""",
        "unique_channel_names": """select o_custkey as uuid, o_orderkey as col_idx, case when k = 0 then b else concat(b, '_', cast(k as varchar)) end as channel_id from (
            select *, row_number() over (partition by o_custkey, b order by o_orderkey) - 1 as k from (select o_custkey, o_orderkey, case when o_orderstatus = 'P' then 'unnamed' else o_orderstatus end as b from orders))""",
        "tracking_new_files": f"""with {_FILES} select f.blob_path, f.file_size from f where not exists (
            select 1 from t where t.status = 'SUCCESS' and t.blob_path = f.blob_path and t.file_size = f.file_size and t.last_modified = f.last_modified)""",
        "tracking_watermark": f"""with {_FILES}, k as (select blob_path, file_size, status, last_modified - interval 60 days as last_modified from t)
            select blob_path, file_size from f where (last_modified >= (select max(last_modified) from k where status = 'SUCCESS') or not exists (select 1 from k where status = 'SUCCESS'))
            and not exists (select 1 from k where k.status = 'SUCCESS' and k.blob_path = f.blob_path and k.file_size = f.file_size and k.last_modified = f.last_modified)""",
        "tracking_exhausted": f"""with {_FILES} select blob_path, retry_count from f where blob_path not in (select blob_path from t where status = 'FAILED' and retry_count >= 5)""",
        "tracking_upsert": f"""with {_FILES}, s as (select blob_path, file_size, case when month(last_modified) <= 6 then 'SUCCESS' else 'FAILED' end as status from f join (select o_orderkey as file_size from orders where o_orderstatus <> 'P') using (file_size))
            select coalesce(s.blob_path, t.blob_path) as blob_path, coalesce(s.file_size, t.file_size) as file_size, coalesce(s.status, t.status) as status,
              case when s.blob_path is null then t.error_message when s.status <> 'SUCCESS' then 'new' end as error_message,
              cast(case when s.blob_path is null then t.retry_count when s.status = 'SUCCESS' then 0 else coalesce(t.retry_count, 0) + 1 end as int) as retry_count,
              case when s.blob_path is null then t.duration_seconds else 2.0::double end as duration_seconds from t full join s on s.blob_path = t.blob_path""",
        "tracking_status_counts": """select count(*) filter (o_orderstatus <> 'F') as succeeded, count(*) filter (o_orderstatus = 'F') as failed from orders""",
        "validate_orphans": """select distinct o_custkey from orders where o_custkey not in (select c_custkey from customer where c_acctbal > 0)""",
        "validate_report": """select 'exists:orders' as "check", 'OK' as status, '' as detail, count(*) as n from orders union all select 'exists:lineitem', 'OK', '', count(*) from lineitem
            union all select 'columns:orders', 'FAILED', 'o_missing', 1
            union all select 'orphans:lineitem->orders', case when count(*) = 0 then 'OK' else 'FAILED' end, '', count(*) from (select distinct l_orderkey from lineitem where l_orderkey not in (select o_orderkey from orders))
            union all select 'orphans:orders->customer', case when count(*) = 0 then 'OK' else 'FAILED' end, '', count(*) from (select distinct o_custkey from orders where o_custkey not in (select c_custkey from customer where c_acctbal > 0))""",
        "extension_filter": """select concat(p, e) as blob_path, case e when '' then 'xlsx' else 'xls' end as extension from (select concat('series-', cast(o_custkey % 10 as varchar), '/', cast(o_orderkey as varchar), '.xlsx') as p,
            case o_orderkey % 3 when 0 then '.BAK' when 1 then '' else '.XLS' end as e from orders) where e <> '.BAK'""",
        "file_uuid": f"select page_id, {_uuid5('url')} as file_uuid from (select page_id, url, {_digest('url')} as d from pages)",
        "filemeta": f"""with {_FILES} select {_uuid5('blob_path')} as uuid, blob_path as file_path, string_split(blob_path, '/')[2] as raw_file_name, file_size, epoch_us(cast(last_modified as timestamp)) as last_modified,
            string_split(blob_path, '/')[1] as series, 'Sheet1' as "group" from (select *, {_digest('blob_path')} as d from f)""",
        "sheet_canonical": f"""with {_GRID}, h as (select distinct uuid, "group", cast(regexp_extract(uuid, '[0-9]+') as bigint) % 2 as odd from x),
            c(k, name) as (values (0, 'Real time'), (1, 'Column_1'), (2, 'Time'), (3, 'Stack Voltage'), (4, 'Current'), (5, 'Efficiency'), (6, 'Note')),
            r as (select *, case when "group" = 'N' and k in (3, 4) then 'CH' else name end as raw_channel from h cross join c)
            select uuid, "group", cast(k as int) as col_idx, raw_channel, case when odd = 0 and raw_channel = 'CH' then 'Cell Voltage' when odd = 0 and raw_channel = 'Efficiency' then 'Energy Efficiency'
              when odd = 1 and raw_channel = 'Current' then 'Stack Current' else raw_channel end as std_channel from r""",
        "latest_version": """select concat('file-', cast(l_suppkey as varchar)) as uuid, l_returnflag as "group", l_orderkey as sample_offset, concat('c', cast(l_linenumber as varchar)) as channel_id, round(l_quantity, 6) as value
            from lineitem qualify l_shipdate = max(l_shipdate) over (partition by l_orderkey)""",
        "dense_bins": f"with {_WIDE}, {_DENSE} select {_DENSE_SHOW} from b",
        "dense_tier": f"""with {_WIDE}, {_DENSE}, t as (select series, experiment_id, cast(floor(elapsed_bin_s / 3600) * 3600 as bigint) as elapsed_bin_s, min(elapsed_time_s) as elapsed_time_s, first(ts order by b.elapsed_bin_s) as ts,
            sum(value_mean * value_count) / sum(value_count) as value_mean, min(value_min) as value_min, max(value_max) as value_max, sum(value_count) as value_count
            from b group by series, experiment_id, floor(elapsed_bin_s / 3600)) select {_DENSE_SHOW} from t""",
        "datetime_merge": f"""with {_GRID} select uuid, "group", row_idx, "timestamp" from x""",
        "structural_split": f"""with {_GRID}, h as (select distinct uuid, "group" from x), c(k, id, name, unit, role) as (values (0, 'Real time', 'Real time', '', 'signal'), (1, 'unnamed', 'Column_1', '', 'signal'),
            (2, 'Time', 'Time', 's', 'elapsed'), (3, 'CH', 'Stack Voltage', 'V', 'signal'), (4, 'CH_1', 'Current', 'A', 'signal'), (5, 'Efficiency', 'Efficiency', '%', 'signal'), (6, 'Note', 'Note', '', 'signal'))
            select uuid, "group", cast(k as int) as col_idx, id as channel_id, case when "group" = 'N' and k in (3, 4) then 'CH' else name end as raw_channel, case when "group" = 'R' then '' else unit end as unit, role from h cross join c""",
        "sheet_to_long": f"""with {_GRID} select uuid, "group", sample_offset, "timestamp", elapsed_time_s, channel_id, round(value, 6) as value, value_str from (
            select uuid, "group", sample_offset, "timestamp", elapsed_time_s, 'CH' as channel_id, ch as value, null as value_str from x
            union all select uuid, "group", sample_offset, "timestamp", elapsed_time_s, 'CH_1', ch1, null from x
            union all select uuid, "group", sample_offset, "timestamp", elapsed_time_s, 'Efficiency', case when "group" <> 'R' and eff > 100 then 100.0 else eff end, null from x
            union all select uuid, "group", sample_offset, "timestamp", elapsed_time_s, 'Note', null, note from x {_derived_sheet()})""",
        "sheet_channels": f"""with {_GRID}, h as (select distinct uuid, "group" from x), c(k, id, name, unit) as (values (0, 'CH', 'Stack Voltage', 'V'), (1, 'CH_1', 'Current', 'A'), (2, 'Efficiency', 'Efficiency', '%'), (3, 'Note', 'Note', ''), (4, 'Current density', 'Current density', 'mA/cm²'))
            select uuid, "group", id as channel_id, case when "group" = 'N' and k in (0, 1) then 'CH' else name end as raw_channel, case when "group" = 'R' and k < 4 then '' else unit end as unit, cast(k as int) as column_index
            from h cross join c where "group" <> 'N' or k < 4""",
        "dq_flag_stored": f"""{_TWICE} select event_id, sample_offset, not {_IN} as is_valid from ck""",
        "dq_delete_stored": f"""{_TWICE} select event_id, sample_offset from ck where not {_IN}""",
        "stream_dq_keys": """select concat('file-', cast(l_suppkey as varchar)) as uuid, l_returnflag as "group", l_orderkey as sample_offset, concat('c', cast(l_linenumber as varchar)) as channel_id, 'dup' as rule_id,
            strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') as "timestamp", round(l_quantity, 6) as value from lineitem qualify count(*) over (partition by l_orderkey, l_linenumber) > 1""",
        "stream_dq_order": f"""with {_LONG} select uuid, "group", sample_offset, channel_id, 'fall' as rule_id, round(value, 6) as value from (
            select *, lag(value) over (partition by uuid, "group" order by sample_offset, channel_id) as before from ev) where value < before""",
        "gold_versions": f"""with {_LONG}, {_MAP}, {_SIG},
            fact as (select s.uuid, s."group", s.series, s.std_channel, e.sample_offset, e.elapsed_time_s, strptime(e."timestamp", '%Y-%m-%d %H:%M:%S') as ts, case when e."group" = 'g1' then 2 * e.value else e.value end as value
              from ev e join sig s using (uuid, "group", channel_id) where e."group" = 'g0' or channel_id <> 'click'), {_BINS} {_SHOW} from bins""",
        "jobs_gold_tables": _jobs(),
        "stream_bronze": f"""with {_LONG} select uuid, "group", sample_offset, channel_id, "timestamp", round(elapsed_time_s, 6) as elapsed_time_s, round(value, 6) as value from ev""",
        "stream_dq": f"""with {_LONG} select uuid, "group", count(*) filter (channel_id = 'view') as failed, count(*) filter (channel_id <> 'view') as valid from ev group by all""",
        "compact_sorted": "select l_returnflag, l_suppkey, count(*) as n, cast(0 as bigint) as falls, cast(1 as bigint) as files from lineitem group by all",
        "compact_clustered": "select l_suppkey, count(*) as n, round(sum(l_quantity), 6) as quantity, true as skips_l_suppkey, true as skips_l_quantity from lineitem group by all",
        "sheet_read": f"""with o as (select concat('supplier=file-', cast(l_suppkey as varchar)) as book, l_linenumber, l_returnflag, l_orderkey,
              cast(row_number() over (partition by l_suppkey order by l_shipdate, l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity, l_discount, l_tax) - 1 as bigint) as row_idx from lineitem),
            u as (select *, {_uuid5("book")} as uuid from (select *, {_digest("book")} as d from o)),
            wide as (select uuid, max(case when l_linenumber = 7 then 1 when l_linenumber % 3 = 2 then 3 when l_linenumber % 3 = 1 then 2 else 1 end) as n from u group by uuid)
            select uuid, row_idx, cast(c as int) as col_idx, case when l_linenumber = 7 then null when c = 0 then cast(l_orderkey as varchar) when c = 1 and l_linenumber % 3 > 0 then concat('a,"', l_returnflag, '"') when c = 2 and l_linenumber % 3 > 1 then 'z' end as cell
            from u join wide using (uuid), unnest(range(n)) r(c)""",
        "derived_active_area": f"""with {_WIDE}, a as (select coalesce(first(area order by p_brand), 88.0) as area from (select p_brand, avg(p_size) as area from part group by p_brand having min(p_size) = 1))
            select uuid, "group", sample_offset, round(1000 * current / area, 6) as density from w, a""",
        "tracking_log": f"""with {_FILES}, s as (select blob_path from f where status = 'FAILED')
            select blob_path, case when s.blob_path is not null then 'FAILED' else t.status end as status, case when s.blob_path is not null then 'again' else t.error_message end as error_message,
              cast(case when s.blob_path is null then t.retry_count else coalesce(t.retry_count, 0) + 1 end as int) as retry_count, cast(case when t.blob_path is null or s.blob_path is null then 1 else 2 end as bigint) as "rows"
            from t full join s using (blob_path)""",
        "file_listing": """select concat('year=y ', cast(year(o_orderdate) as varchar), '/month=', cast(month(o_orderdate) as varchar)) as folder, 'txt' as extension, cast(1 as bigint) as files, cast(1 as bigint) as ids,
            cast(sum(length(concat(cast(o_orderkey as varchar), ',', o_orderstatus)) + 1) as bigint) as bytes, true as named from orders group by all""",
        "mapping_scan": """with e as (select p_brand, p_name as raw_channel, case when p_name like '%bolt' then 'Date' when p_name not like '%ring' then p_type end as std, p_type = 'PROMO' as calculated from part)
            select distinct p_brand as series, raw_channel, std as mapped_std_channel, c as for_converter from e, (values (true), (false)) m(c) where std is not null and (c or (not calculated and std <> 'Date'))""",
        "table_writes": """with w as (select count(*) filter (month(l_shipdate) <= 6) as early, count(*) filter (month(l_shipdate) > 6) as late from lineitem)
            select l_returnflag, l_returnflag as part, count(*) as n, round(sum(l_quantity), 6) as quantity, any_value(early) as write_0, any_value(early) as write_1, any_value(late) as write_2 from lineitem, w group by all""",
        "append_incremental": f"""with {_LONG}, x as (select distinct uuid, "group", series from ev)
            select *, count(*) filter ("group" = 'g0') over () as run_0, count(*) filter ("group" <> 'g0') over () as run_1, cast(0 as bigint) as run_2 from x""",
        "converter_tables": """with x as (select concat('file-', cast(l_suppkey as varchar)) as uuid, l_returnflag as "group", count(*) as n, case when l_returnflag = 'N' then 4 else 5 end as channels from lineitem group by all)
            select t as of_table, uuid, "group", cast(case t when 'channel' then channels when 'timeseries' then channels * n else 1 end as bigint) as n from x, (values ('filemeta'), ('channel'), ('timeseries'), ('statistics')) m(t)
            union all select distinct 'tracking', concat(uuid, suffix), status, retries from x, (values ('', 'SUCCESS', cast(0 as bigint)), ('-lost', 'FAILED', cast(1 as bigint))) m(suffix, status, retries)""",
        "tracking_upgrade": f"""with {_FILES}, s as (select blob_path from f where status = 'FAILED')
            select 'old' as of_table, blob_path, case when s.blob_path is not null then 'FAILED' else t.status end as status, case when s.blob_path is not null then 'again' else t.error_message end as error_message,
              case when s.blob_path is not null then 1 end as retry_count from t full join s using (blob_path)
            union all select 'none', blob_path, 'FAILED', 'again', 1 from s""",
        "dq_rule_report": f"""{_CHECKED}, found as (select case when "timestamp" is null then 'ts_timestamp_not_null' else 'ts_timestamp_parseable' end as rule_id, uuid from ck0 where "timestamp" is null or "timestamp" = 'garbage'),
            rules(rule_id, rule_type, enabled, channel, first_format) as (values ('ts_timestamp_not_null', 'not_null', true, null, null), ('ts_timestamp_parseable', 'timestamp_parseable', true, null, 'yyyy-MM-dd HH:mm:ss'),
              ('far', 'not_null', true, 'none', null), ('off', 'not_null', false, null, null))
            select r.*, count(uuid) as total_failed, count(distinct uuid) as affected_files from rules r left join found using (rule_id) group by all""",
    }
