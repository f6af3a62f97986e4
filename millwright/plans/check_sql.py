"""Check SQL for the registered queries, written independently of the operators: direct windows,
medians and joins, which a single-node engine can afford."""

from __future__ import annotations

import math

from millwright.contracts import AXES, HRSS_TELEMETRY, LOGISTICS_EVENTS, VALUE_RANGES
from millwright.plans import queries as q
from millwright.plans.fixtures import check_views

_NEEDS = {"wire_rows": ("logistics_events",), "deliveries": ("hrss_telemetry",)}


def _with(body: str, *views: str, also: dict[str, str] | None = None, parts: bool = False) -> str:
    known = check_views(parts)
    order: list[str] = []
    for view in views:
        for name in (*_NEEDS.get(view, ()), view):
            if name not in order:
                order.append(name)
    parts = [f"{name} as ({known[name]})" for name in order]
    parts += [f"{name} as ({sql})" for name, sql in (also or {}).items()]
    return f"with {', '.join(parts)} {body}"


def _quarter(ts: str) -> str:
    return f"cast(date_trunc('quarter', {ts}) as date)"


def _mean(column: str, precision: int, places: int) -> str:
    return (
        f"cast(round(cast(sum({column}) as double)/nullif(count({column}),0), {places})"
        f" as decimal({precision},{places}))"
    )


def _rate(condition: str) -> str:
    return (
        f"cast(round(cast(sum(case when {condition} then 1 else 0 end) as double)/count(*), 4)"
        " as decimal(5,4))"
    )


_POWER = "(" + " + ".join(f"coalesce({a}_power_w,0)" for a in AXES) + ")"
_FLAGS = "is_anomalous, is_optimised"

LOGISTICS_FEATURES = f"""
select {_quarter('event_timestamp')} as quarter_start, asset_id,
       count(*) as event_count,
       {_rate('logistics_delay')} as delay_rate,
       {_mean('waiting_time_min', 8, 2)} as avg_waiting_time_min,
       {_mean('inventory_level', 10, 2)} as avg_inventory_level,
       {_mean('asset_utilization_pct', 5, 2)} as avg_asset_utilization_pct,
       {_mean('temperature_c', 6, 2)} as avg_temperature_c,
       {_mean('humidity_pct', 6, 2)} as avg_humidity_pct,
       cast(sum(user_transaction_amount) as bigint) as total_transaction_amount
from logistics_events group by 1, 2"""

HRSS_FEATURES = f"""
select {_quarter('reading_timestamp')} as quarter_start, is_anomalous, is_optimised,
       count(*) as reading_count,
       {', '.join(f"{_mean(f'{a}_power_w', 10, 2)} as avg_{a}_power_w" for a in AXES)},
       cast(sum({_POWER}) as decimal(24,2)) as total_power_w,
       {_rate('label = 1')} as anomaly_label_rate
from hrss_telemetry group by 1, 2, 3"""


def _poisson_points(rate: float) -> list[int]:
    """Where the distribution function of a Poisson number steps, on a scale of 2**32; steps too small to be hit are left out."""
    below = [sum(math.exp(-rate) * rate**j / math.factorial(j) for j in range(k + 1)) for k in range(30)]
    return [p for p in (math.floor(b * 2**32) for b in below) if p < 2**32 - 1]


#: Kinds of the readings' columns that aren't whole numbers (fixed values).
_READING_KINDS = {
    "reading_timestamp": "timestamp", "cycle_elapsed_sec": "numeric", "is_anomalous": "boolean", "is_optimised": "boolean",
}


def _by_axis(select: str) -> str:
    return " union all ".join(select.replace("AXIS", axis) for axis in AXES)


def _efficiency(axis_column: str, power: str) -> str:
    mean = "cast(sum(case when {w} then {p} end) as double)/nullif(count(case when {w} then {p} end),0)"
    opt = mean.format(w="is_optimised", p=power)
    std = mean.format(w="not is_optimised", p=power)
    return f"""
        select quarter_start, {axis_column}
               cast(round(p_opt, 4) as decimal(18,4)) as optimised_power_w,
               cast(round(p_std, 4) as decimal(18,4)) as standard_power_w,
               cast(round(p_opt/nullif(p_std,0), 4) as decimal(18,4)) as power_ratio,
               cast(round(100*(1 - p_opt/nullif(p_std,0)), 4) as decimal(18,4)) as saving_pct
        from (select {_quarter('reading_timestamp')} as quarter_start, {opt} as p_opt,
                     {std} as p_std from hrss_telemetry group by 1)"""


def _cast(field) -> str:
    kind = field.dataType.simpleString()
    if kind == "timestamp":
        return f"try_cast(replace({field.name}, 'Z', '') as timestamp)"
    if kind == "int":
        return f"try_cast(round_even(try_cast({field.name} as double), 0) as integer)"
    return field.name if kind == "string" else f"try_cast({field.name} as {kind})"


_WIRE = [f for f in LOGISTICS_EVENTS.fields if f.name not in ("event_id", "ingested_at")]

_TYPED = f"select event_id, {', '.join(f'{_cast(f)} as {f.name}' for f in _WIRE)} from wire_rows"


def _reasons() -> str:
    parts = []
    for f in _WIRE:
        if not f.nullable:
            parts.append(f"case when {f.name} is null then 'missing:{f.name}' end")
        if f.dataType.simpleString() != "string":
            parts.append(
                f"case when {f.name} is not null and {_cast(f)} is null then 'type:{f.name}' end"
            )
        if "max_length" in f.metadata:
            parts.append(
                f"case when length({f.name}) > {f.metadata['max_length']} then 'length:{f.name}' end"
            )
    return ", ".join(parts)


def _profile(table: str, columns: list[str], booleans: list[str]) -> str:
    return " union all ".join(
        f"""select '{c}' as "column", count(*) as row_count, count({c}) as non_null_count,
            cast(round(1 - cast(count({c}) as double)/greatest(count(*),1), 6) as decimal(7,6))
                as null_rate,
            cast({f"round(cast(count(*) filter (where {c}) as double)/nullif(count({c}),0), 6)"
                  if c in booleans else "null"} as decimal(7,6)) as true_rate
            from {table}"""
        for c in columns
    )


def _exact_mean(c: str) -> str:
    """Whole-number division: halves go away from zero in any engine."""
    one = 10 ** getattr(HRSS_TELEMETRY[c].dataType, "scale", 0)
    total, below = f"sum(cast({c} * {one} as hugeint))", f"nullif(count({c}) * cast({one} as hugeint), 0)"
    return f"""cast(cast(sign({total}) as decimal(18,0))
        * cast((abs({total}) * 20000 + {below}) // (2 * {below}) as decimal(18,0)) * 0.0001 as decimal(18,4))"""


def _quantiles() -> str:
    return " union all ".join(
        f"""select '{c}' as "column", count({c}) as non_null_count,
            cast(round(min(cast({c} as double)), 4) as decimal(18,4)) as min_value,
            {', '.join(f"cast(round(quantile_cont(cast({c} as double), {p}), 4) as decimal(18,4)) as p{round(p * 100)}" for p in (0.25, 0.5, 0.75))},
            cast(round(max(cast({c} as double)), 4) as decimal(18,4)) as max_value,
            {_exact_mean(c)} as mean_value,
            cast(round(stddev_samp(cast({c} as double)), 4) as decimal(18,4)) as stddev_value
            from hrss_telemetry"""
        for c in q.QUANTILE_COLUMNS
    )


def _arrivals(source: str, table: str, ts: str) -> str:
    return f"""select '{source}' as source, date_trunc('minute', {ts}) as minute,
        count(*) as row_count, cast(round(count(*)/60.0::double, 4) as decimal(18,4))
        as rows_per_second from {table} group by 1, 2"""


def _uniqueness(name: str, rows: str, key: str) -> str:
    return f"""select '{name}' as table_name, count(*) as key_count,
        count(*) filter (where n > 1) as duplicated_keys,
        cast(sum(n - 1) as bigint) as surplus_rows
        from (select {key}, count(*) as n from {rows} group by {key})"""


_LINE = r"^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}),(\d{3}) ([A-Z]+) ([^ :]+): (.*)$"

_PARSED = f"""
select service,
       case when starts_with(line, '{{') then cast(line->>'time' as timestamp)
            when m then cast(concat(regexp_extract(line, '{_LINE}', 1), '.',
                 regexp_extract(line, '{_LINE}', 2)) as timestamp) end as log_time,
       case when starts_with(line, '{{') then line->>'level'
            when m then regexp_extract(line, '{_LINE}', 3) end as level,
       case when starts_with(line, '{{') then line->>'logger'
            when m then regexp_extract(line, '{_LINE}', 4) end as logger,
       case when starts_with(line, '{{') then line->>'message'
            when m then regexp_extract(line, '{_LINE}', 5) else line end as message,
       case when starts_with(line, '{{') then 'json' when m then 'plain' else 'unparsed' end
           as layout
from (select *, regexp_matches(line, '{_LINE}') as m from log_lines)
where not regexp_matches(line, 'GET /(health|healthz|ready)\\b')"""


#: Lines in file order, numbered by the headers up to them; lines before a file's first header stay alone.
_ENTRIES = f"""
with lines as ({_PARSED.replace("select service,", "select service, line, ts, event_id,").replace("from log_lines", "from placed_lines")
    .split("where not regexp_matches")[0]}),
numbered as (
  select *, sum(case when layout <> 'unparsed' then 1 else 0 end)
    over (partition by service order by ts, event_id rows unbounded preceding) as entry from lines),
alone as (select *, case when entry = 0 then -1 - event_id else entry end as key from numbered),
heads as (select * from alone where layout <> 'unparsed' or entry = 0),
rest as (
  select service, key, string_agg(line, chr(10) order by ts, event_id) as trace, count(*) as n
  from alone where layout = 'unparsed' and entry > 0 group by 1, 2)
select service, log_time, level, logger, message, layout, trace, 1 + coalesce(n, 0) as line_count
from heads left join rest using (service, key)"""

_GAPS = f"""
select asset_id, gap_start, gap_end from (
  select asset_id, lag(event_timestamp) over (partition by asset_id order by event_timestamp) as gap_start,
    event_timestamp as gap_end from logistics_events)
where epoch_us(gap_end) - epoch_us(gap_start) > {q.ASSET_GAP_SECONDS * 1000000}"""

_COVERAGE = f"""
with ends as (
  select asset_id, min(event_timestamp) as first, max(event_timestamp) as last from logistics_events group by 1),
quarters as (
  select asset_id, cast(unnest(generate_series(
    date_trunc('quarter', cast(first as timestamp)), date_trunc('quarter', cast(last as timestamp)), interval 3 months)) as timestamp) as q
  from ends),
missing as (
  select * from gaps union all
  select asset_id, date_trunc('quarter', first), first from ends
  where epoch_us(first) - epoch_us(cast(date_trunc('quarter', first) as timestamp)) > {q.ASSET_GAP_SECONDS * 1000000}
  union all
  select asset_id, last, cast(date_trunc('quarter', last) as timestamp) + interval 3 months from ends
  where epoch_us(cast(date_trunc('quarter', last) as timestamp) + interval 3 months) - epoch_us(last)
    > {q.ASSET_GAP_SECONDS * 1000000}),
pieces as (
  select s.asset_id, q, greatest(epoch_us(gap_start), epoch_us(q)) as a,
    least(epoch_us(gap_end), epoch_us(q + interval 3 months)) as b
  from quarters s join missing m on s.asset_id = m.asset_id and gap_start < q + interval 3 months and gap_end > q),
sums as (select asset_id, q, count(*) as n, cast(sum(b - a) as bigint) as lost from pieces group by 1, 2)
select s.asset_id, cast(s.q as date) as quarter_start, coalesce(n, 0) as missing_count, coalesce(lost, 0) as missing_micros,
  cast(round(cast(epoch_us(s.q + interval 3 months) - epoch_us(s.q) - coalesce(lost, 0) as double)
    / (epoch_us(s.q + interval 3 months) - epoch_us(s.q)), 6) as decimal(7,6)) as covered_share
from quarters s left join sums on s.asset_id = sums.asset_id and s.q = sums.q"""


def _json_fields() -> str:
    parts = []
    for f in LOGISTICS_EVENTS.fields:
        kind = f.dataType.simpleString()
        if f.name == "ingested_at":
            continue
        if kind == "timestamp":
            text = f"""'"' || strftime({f.name}, '%Y-%m-%dT%H:%M:%SZ') || '"'"""
        elif kind == "string":
            text = f"""'"' || {f.name} || '"'"""
        else:
            text = f"cast({f.name} as varchar)"
        parts.append(f"""'"{f.name}":' || coalesce({text}, 'null')""")
    return " || ',' || ".join(parts)


def _rolling_frame(unit: str) -> str:
    return f"(partition by asset_id order by {unit} range between {{span}} preceding and current row)"


def oracle() -> dict[str, str]:
    logistics_booleans = ["logistics_delay"]
    untagged = [f.name for f in HRSS_TELEMETRY.fields if f.name not in ("ingested_at",)]
    wire_hrss = list(q.HRSS_COLUMNS)
    event_frame = _rolling_frame("event_timestamp").format(span="interval 7 days")
    day_frame = _rolling_frame("event_date").format(span="interval 6 days")
    quarter_end = f"date '{q.QUARTER}' + interval 3 months"
    poisson = " + ".join(
        f"case when point >= {t} then 1 else 0 end" for t in _poisson_points(q.BOOTSTRAP_RATE)
    )
    sql: dict[str, str] = {}

    sql["logistics_features_quarterly"] = _with(LOGISTICS_FEATURES, "logistics_events", parts=True)
    sql["hrss_features_quarterly"] = _with(HRSS_FEATURES, "hrss_telemetry")
    sql["live_features"] = sql["hrss_features_quarterly"]
    sql["overwritten_quarters"] = sql["hrss_features_quarterly"]
    sql["anomaly_rate_quarterly"] = _with(
        f"""select {_quarter('reading_timestamp')} as quarter_start, count(*) as reading_count,
        count(*) filter (where is_anomalous) as anomalous_count,
        {_rate('is_anomalous')} as anomaly_rate from hrss_telemetry group by 1""",
        "hrss_telemetry",
    )
    sql["anomaly_rate_by_axis"] = _with(
        _by_axis(f"""select {_quarter('reading_timestamp')} as quarter_start, 'AXIS' as axis,
        cast(round(cast(sum(case when is_anomalous then AXIS_power_w else 0 end) as double)
            /nullif(sum(AXIS_power_w),0), 4) as decimal(5,4)) as anomalous_power_share
        from hrss_telemetry group by 1"""),
        "hrss_telemetry",
    )
    sql["energy_efficiency"] = _with(_efficiency("", _POWER), "hrss_telemetry")
    sql["energy_efficiency_by_axis"] = _with(
        _by_axis(_efficiency("'AXIS' as axis,", "coalesce(AXIS_power_w,0)")), "hrss_telemetry"
    )
    sql["quarterly_tables"] = _with(
        f"""select e.quarter_start, e.axis, e.power_ratio, a.anomalous_power_share, r.anomaly_rate, r.reading_count
        from ({_by_axis(_efficiency("'AXIS' as axis,", "coalesce(AXIS_power_w,0)"))}) e
        join ({_by_axis(f"""select {_quarter('reading_timestamp')} as quarter_start, 'AXIS' as axis,
            cast(round(cast(sum(case when is_anomalous then AXIS_power_w else 0 end) as double)
                /nullif(sum(AXIS_power_w),0), 4) as decimal(5,4)) as anomalous_power_share
            from hrss_telemetry group by 1""")}) a using (quarter_start, axis)
        join (select {_quarter('reading_timestamp')} as quarter_start, count(*) as reading_count,
            {_rate('is_anomalous')} as anomaly_rate from hrss_telemetry group by 1) r using (quarter_start)
        where e.quarter_start = date '{q.REBUILT_QUARTER}'""",
        "hrss_telemetry",
    )
    sql["class_rollup"] = _with(
        f"""select is_anomalous, is_optimised,
        cast(grouping(is_anomalous)*2 + grouping(is_optimised) as int) as level,
        count(*) as reading_count, cast(sum({_POWER}) as bigint) as total_power_w
        from hrss_telemetry
        group by grouping sets ((is_anomalous, is_optimised), (is_anomalous), ())""",
        "hrss_telemetry",
    )
    sql["rolling_asset_stats"] = _with(
        f"""select event_id, asset_id, event_timestamp,
        count(*) over w as rolling_events,
        cast(coalesce(sum(waiting_time_min) over w, 0) as bigint) as rolling_waiting_min,
        cast(round(cast(sum(waiting_time_min) over w as double)
            /nullif(count(waiting_time_min) over w,0), 4) as decimal(12,4))
            as rolling_avg_waiting_min,
        cast(round(cast(sum(case when logistics_delay then 1 else 0 end) over w as double)
            /count(*) over w, 4) as decimal(5,4)) as rolling_delay_rate
        from logistics_events window w as {event_frame}""",
        "logistics_events",
    )
    sql["rolling_daily_stats"] = _with(
        f"""select asset_id, event_date, cast(sum(n) over w as bigint) as rolling_events,
        cast(sum(wait) over w as bigint) as rolling_waiting_min,
        cast(round(cast(sum(wait) over w as double)/nullif(sum(waits) over w,0), 4)
            as decimal(12,4)) as rolling_avg_waiting_min,
        cast(round(cast(sum(late) over w as double)/sum(n) over w, 4) as decimal(5,4))
            as rolling_delay_rate
        from (select asset_id, cast(event_timestamp as date) as event_date, count(*) as n,
              coalesce(sum(waiting_time_min),0) as wait, count(waiting_time_min) as waits,
              count(*) filter (where logistics_delay) as late
              from logistics_events group by 1, 2)
        window w as {day_frame}""",
        "logistics_events",
    )
    sql["quarter_over_quarter"] = _with(
        """select asset_id, quarter_start, lag(quarter_start) over w as previous_quarter,
        event_count - lag(event_count) over w as event_count_change,
        cast(delay_rate - lag(delay_rate) over w as decimal(6,4)) as delay_rate_change,
        cast(avg_waiting_time_min - lag(avg_waiting_time_min) over w as decimal(9,2))
            as avg_waiting_time_change
        from features window w as (partition by asset_id order by quarter_start)""",
        "logistics_events", also={"features": LOGISTICS_FEATURES},
    )

    sql["project_logistics"] = _with(
        "select event_id, " + ", ".join(
            n for n in q.LOGISTICS_COLUMNS if n != "event_timestamp"
        ) + " from logistics_events", "logistics_events", parts=True,
    )
    sql["project_hrss"] = _with(
        "select reading_id, " + ", ".join(
            n for n in q.HRSS_COLUMNS if n != "reading_timestamp"
        ) + " from hrss_telemetry", "hrss_telemetry",
    )
    sql["typed_events"] = _with(_TYPED, "wire_rows", parts=True)
    sql["iso_timestamps"] = _with(
        """select event_id, strftime(event_timestamp, '%Y-%m-%dT%H:%M:%SZ') as iso,
        date_trunc('second', event_timestamp) as parsed from logistics_events""",
        "logistics_events",
    )
    sql["window_filter"] = _with(
        f"""select * from logistics_events where event_timestamp between
        timestamp '{q.WINDOW_END}' - interval {q.WINDOW_DAYS} days and timestamp '{q.WINDOW_END}'""",
        "logistics_events", parts=True,
    )
    sql["quarter_filter"] = _with(
        f"""select * from logistics_events where event_timestamp >= date '{q.QUARTER}'
        and event_timestamp < {quarter_end}""",
        "logistics_events", parts=True,
    )
    sql["class_filter"] = _with(
        "select * from hrss_telemetry where is_anomalous and not is_optimised", "hrss_telemetry"
    )
    sql["clip_values"] = _with(
        """select event_id,
        case when waiting_time_min < 10 then 10 when waiting_time_min > 60 then 60
             else waiting_time_min end as waiting_time_min,
        case when inventory_level < 100 then 100 when inventory_level > 400 then 400
             else inventory_level end as inventory_level
        from logistics_events""",
        "logistics_events", parts=True,
    )
    sql["rint_values"] = _with(
        """select reading_id,
        cast(round_even(cast(cycle_elapsed_sec as double)*2, 0) as bigint) as doubled,
        cast(round_even(cast(cycle_elapsed_sec as double), 0) as bigint) as elapsed
        from hrss_telemetry""",
        "hrss_telemetry",
    )
    sql["to_json_rows"] = _with(
        f"select '{{' || {_json_fields()} || '}}' as value from logistics_events",
        "logistics_events", parts=True,
    )
    kinds = {  # written out, not taken from the library
        "event_timestamp": "timestamp", "asset_id": "categorical", "latitude": "numeric", "longitude": "numeric",
        "inventory_level": "integer", "shipment_status": "categorical", "temperature_c": "numeric",
        "humidity_pct": "numeric", "traffic_status": "categorical", "waiting_time_min": "integer",
        "user_transaction_amount": "integer", "user_purchase_frequency": "integer",
        "logistics_delay_reason": "categorical", "asset_utilization_pct": "numeric", "demand_forecast": "integer",
        "logistics_delay": "boolean",
    }
    listed = ", ".join(f"('{n}', '{k}')" for n, k in kinds.items())
    sql["profile_csv"] = _with(
        """select p."column", k.kind, row_count, non_null_count, null_rate, true_rate
        from (""" + _profile("logistics_events", list(kinds), logistics_booleans) + f""") p
        join (values {listed}) as k("column", kind) on p."column" = k."column" """,
        "logistics_events",
    )
    sql["pseudonymised_assets"] = _with(
        f"""select event_id, sha256('{len(q.SALT)}:{q.SALT}:' || asset_id) as asset_id, event_timestamp, waiting_time_min,
        logistics_delay from logistics_events""",
        "logistics_events",
    )
    kept_readings = ", ".join(f.name for f in HRSS_TELEMETRY.fields if f.name != "ingested_at")
    sql["retained_readings"] = _with(
        f"select {kept_readings} from hrss_telemetry where reading_timestamp >= date '{q.OLDEST_DAY}'",
        "hrss_telemetry",
    )
    sql["erased_readings"] = _with(
        f"select {kept_readings} from hrss_telemetry where reading_id % {q.ERASED_EVERY} <> 0", "hrss_telemetry",
    )
    sql["tagged_union"] = _with(
        f"select {', '.join(untagged)} from hrss_telemetry", "hrss_telemetry"
    )

    sql["tagged_files"] = _with(
        "select " + ", ".join(n for n in q.HRSS_COLUMNS if n != "reading_timestamp")
        + " from hrss_telemetry", "hrss_telemetry",
    )
    sql["served_sql"] = _with(
        """select quarter_start, cast(sum(reading_count) as bigint) as readings,
        max(avg_hl_power_w) as peak_hl_power_w from features where not is_anomalous group by 1""",
        "hrss_telemetry", also={"features": HRSS_FEATURES},
    )

    sql["profile_nulls"] = _with(
        _profile("logistics_events", q.LOGISTICS_COLUMNS, logistics_booleans), "logistics_events"
    )
    sql["profile_kinds"] = _with(
        " union all ".join(
            f"""select '{n}' as "column", '{_READING_KINDS.get(n, "integer")}' as kind,
            count(*) as row_count, count({n}) as non_null_count from hrss_telemetry"""
            for n in q.HRSS_COLUMNS
        ),
        "hrss_telemetry",
    )
    sql["profile_categories"] = _with(
        " union all ".join(
            f"""select '{n}' as "column", {n} as category, count(*) as category_count,
            cast(round(cast(count(*) as double)/sum(count(*)) over (), 6) as decimal(7,6))
                as frequency
            from logistics_events where {n} is not null group by {n}"""
            for n in q.CATEGORICAL
        ),
        "logistics_events",
    )
    sql["class_weights"] = _with(
        f"""select {_FLAGS}, count(*) as reading_count,
        cast(round(cast(count(*) as double)/sum(count(*)) over (), 6) as decimal(7,6))
            as class_weight from hrss_telemetry group by 1, 2""",
        "hrss_telemetry",
    )
    sql["profile_quantiles"] = _with(_quantiles(), "hrss_telemetry")
    sql["median_by_group"] = _with(
        """select asset_id, count(user_transaction_amount) as non_null_count,
        cast(round(median(cast(user_transaction_amount as double)), 4) as decimal(18,4))
            as median_value
        from logistics_events group by 1""",
        "logistics_events",
    )
    sql["hour_profile"] = _with(
        """select cast(hour(event_timestamp) as int) as hour_of_day, count(*) as event_count,
        cast(round(cast(count(*) as double)/sum(count(*)) over (), 6) as decimal(7,6)) as share
        from logistics_events group by 1""",
        "logistics_events",
    )
    sql["arrival_rate"] = _with(
        _arrivals("logistics_events", "logistics_events", "event_timestamp") + " union all "
        + _arrivals("hrss_telemetry", "hrss_telemetry", "reading_timestamp"),
        "logistics_events", "hrss_telemetry",
    )
    sql["top_delay_reasons"] = _with(
        f"""select logistics_delay_reason, count(*) as category_count from logistics_events
        where logistics_delay_reason is not null group by 1
        order by category_count desc, logistics_delay_reason limit {q.TOP_K}""",
        "logistics_events",
    )
    sql["sort_events"] = _with(
        """select event_id, event_timestamp,
        row_number() over (order by event_timestamp, event_id) as position from logistics_events""",
        "logistics_events",
    )

    sql["validate_events"] = _with(
        f"select event_id, concat_ws(',', {_reasons()}) as reasons from wire_rows", "wire_rows",
    )
    sql["range_violations"] = _with(
        " union all ".join(
            f"""select '{n} in [{low}, {high}]' as "rule", count({n}) as checked,
            count(*) filter (where {n} < {low} or {n} > {high}) as violations from typed"""
            for n, (low, high) in VALUE_RANGES.items() if n in LOGISTICS_EVENTS.names
        ),
        "wire_rows", also={"typed": _TYPED},
    )
    sql["outliers_mad"] = _with(
        f"""select event_id, e.asset_id, user_transaction_amount,
        cast(round(med, 4) as decimal(18,4)) as group_median,
        cast(round(mad, 4) as decimal(18,4)) as group_mad
        from logistics_events e join
             (select asset_id, median(user_transaction_amount) as med,
              mad(cast(user_transaction_amount as double)) as mad
              from logistics_events group by 1) p on e.asset_id = p.asset_id
        where abs(user_transaction_amount - med) > {q.MAD_K}*mad""",
        "logistics_events",
    )
    sql["missing_by_quarter"] = _with(
        " union all ".join(
            f"""select {_quarter('event_timestamp')} as quarter_start, '{n}' as "column",
            count(*) - count({n}) as missing_count,
            cast(round(cast(count(*) - count({n}) as double)/count(*), 6) as decimal(7,6))
                as missing_rate
            from logistics_events group by 1"""
            for n in q.LOGISTICS_COLUMNS
        ),
        "logistics_events",
    )
    sql["key_uniqueness"] = _with(
        _uniqueness("logistics_features_quarterly", "lf", "quarter_start, asset_id")
        + " union all "
        + _uniqueness("hrss_features_quarterly", "hf", f"quarter_start, {_FLAGS}")
        + " union all "
        + _uniqueness("logistics_events", "logistics_events", "asset_id, event_timestamp"),
        "logistics_events", "hrss_telemetry",
        also={"lf": LOGISTICS_FEATURES, "hf": HRSS_FEATURES},
    )
    sql["raw_readiness"] = _with(
        f"""select {_quarter('reading_timestamp')} as quarter_start, count(*) as row_count,
        max(reading_timestamp) as last_event,
        count(*) >= {q.READY_ROWS} and
            date_diff('day', cast(max(reading_timestamp) as date),
                cast({_quarter('min(reading_timestamp)')} + interval 3 months as date))
            <= {q.READY_GAP_DAYS} as is_ready
        from hrss_telemetry group by 1""",
        "hrss_telemetry",
    )
    sql["dedup_events"] = _with(
        """select topic, "partition", "offset", reading_timestamp, blo_power_w, is_anomalous,
        delivery from (select *, row_number() over (partition by topic, "partition", "offset"
            order by delivery) as n from deliveries) where n = 1""",
        "deliveries",
    )
    sql["lineage_semi"] = _with(
        f"""select {_quarter('event_timestamp')} as quarter_start, asset_id, event_id,
        event_timestamp, logistics_delay from logistics_events
        where ({_quarter('event_timestamp')}, asset_id) in
            (select (quarter_start, asset_id) from features where delay_rate > 0.4)""",
        "logistics_events", also={"features": LOGISTICS_FEATURES},
    )
    sql["reconcile_anti"] = _with(
        f"""select quarter_start, asset_id, raw_count,
        nullif(flagged, 0) as feature_count,
        case when flagged = 0 then 'missing_feature' else 'count_mismatch' end as status
        from (select {_quarter('event_timestamp')} as quarter_start, asset_id,
              count(*) as raw_count, count(logistics_delay) as flagged
              from logistics_events group by 1, 2)
        where flagged <> raw_count""",
        "logistics_events",
    )

    sql["bootstrap_sample"] = _with(
        f"""select {kept_readings},
        unnest(range(1, copies + 1))::int as copy
        from (select *, {poisson} as copies from
              (select *, cast('0x' || substring(md5('{q.SAMPLE_SEED}:' || reading_id), 1, 8)
               as bigint) as point from hrss_telemetry))""",
        "hrss_telemetry",
    )
    sql["bootstrap_exact"] = _with(
        f"""select {kept_readings}, draw from
        (select *, row_number() over (order by reading_id) as position from hrss_telemetry) join
        (select draw, 1 + cast('0x' || substring(md5('{q.SAMPLE_SEED}/' || draw), 1, 15) as bigint)
           % (select count(*) from hrss_telemetry) as position
         from (select unnest(range(1, {q.BOOTSTRAP_ROWS} + 1)) as draw)) using (position)""",
        "hrss_telemetry",
    )
    sql["heavy_hitters"] = _with(
        f"""select user_transaction_amount, count(*) as category_count from logistics_events
        where user_transaction_amount is not null group by 1
        order by category_count desc, user_transaction_amount limit {q.HEAVY_K}""",
        "logistics_events",
    )
    longer = _reasons().replace("> 50 then 'length:asset_id'", f"> {q.LONGER_ASSET_ID} then 'length:asset_id'")
    wire_logistics = ", ".join(f.name for f in _WIRE)
    sql["replayed_quarantine"] = _with(
        f"""select {wire_logistics} from typed where event_id in
        (select event_id from wire_rows where concat_ws(',', {longer}) = '')""",
        "wire_rows", also={"typed": _TYPED},
    )
    sql["stratified_sample"] = _with(
        f"""select {kept_readings} from
        (select *, row_number() over (partition by {_FLAGS}
             order by md5('{q.SAMPLE_SEED}:' || reading_id), reading_id) as r,
             count(*) over (partition by {_FLAGS}) as n from hrss_telemetry)
        where r <= ceil(n*{q.SAMPLE_PERCENT}/100.0)""",
        "hrss_telemetry",
    )

    sql["tumbling_counts"] = _with(
        """select date_trunc('hour', reading_timestamp) as window_start,
        date_trunc('hour', reading_timestamp) + interval 1 hour as window_end, is_anomalous,
        count(*) as event_count from hrss_telemetry group by 1, 2, 3""",
        "hrss_telemetry",
    )
    sql["tumbling_counts_by_asset"] = _with(
        """select cast(date_trunc('day', event_timestamp) as timestamp) as window_start,
        cast(date_trunc('day', event_timestamp) as timestamp) + interval 1 day as window_end,
        asset_id, count(*) as event_count from logistics_events group by 1, 2, 3""",
        "logistics_events",
    )
    sql["parse_logs"] = _with(_PARSED, "log_lines")
    sql["log_levels_daily"] = _with(
        f"""select cast(log_time as date) as log_date, service, level, count(*) as line_count
        from ({_PARSED}) group by 1, 2, 3""",
        "log_lines",
    )
    sql["compacted_readings"] = _with(f"select {kept_readings} from hrss_telemetry", "hrss_telemetry")
    sql["incremental_hrss_features"] = _with(HRSS_FEATURES, "hrss_telemetry")
    sql["incremental_logistics_features"] = _with(LOGISTICS_FEATURES, "logistics_events")
    sql["recognised_messages"] = _with(f"select distinct {', '.join(wire_hrss)} from hrss_telemetry", "hrss_telemetry")
    sql["missing_intervals"] = _with(_GAPS, "logistics_events")
    sql["quarter_coverage"] = _with("select * from coverage", "logistics_events", also={"gaps": _GAPS, "coverage": _COVERAGE})
    sql["log_entries"] = _with("select * from entries", "placed_lines", also={"entries": _ENTRIES})
    sql["traced_events"] = _with(
        f"""select *, {_quarter('event_timestamp')} as quarter_start from logistics_events
        where ({_quarter('event_timestamp')}, asset_id) in
            (select (quarter_start, asset_id) from features where delay_rate > {q.LATE_RATE})""",
        "logistics_events", also={"features": LOGISTICS_FEATURES},
    )
    sql["csv_quarantine"] = sql["validate_events"]
    sql["folded_features"] = _with(HRSS_FEATURES, "hrss_telemetry")
    sql["merged_quantiles"] = _with(
        " union all ".join(
            f"""select '{n}' as "column", cast(p as double) as probability, count({n}) as row_count, true as within_error
            from hrss_telemetry, (select unnest([{', '.join(map(str, q.MERGED_AT))}]) as p) group by p"""
            for n in q.QUANTILE_COLUMNS
        ),
        "hrss_telemetry",
    )
    sql["ingest_stream"] = _with(
        f"select {', '.join(wire_hrss)} from hrss_telemetry", "hrss_telemetry"
    )
    return sql
