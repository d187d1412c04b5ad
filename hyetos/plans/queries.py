"""Every operator as a query over the test tables, with its SQL counterpart.

Each query takes ``(spark, sf_dir)`` and reads the whole ``events`` table. Timestamps
leave without a time zone and dates as text, so both sides have the same types.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hyetos.functions.conditions import GLYPHS, OTHER, RULES, UNKNOWN, with_condition_class
from hyetos.functions.timestamps import parse_timestamp, wall_clock, with_calendar_parts
from hyetos.operators import alerts, asof, cities, daily, flatten, revisions, sketches, trends
from hyetos.params import SliceParams, Thresholds, TrendParams
from hyetos.plans import serving
from hyetos.session import names_descending, work_dir
from hyetos.sources import documents, events, snapshots
from hyetos.streaming import queries as streams
from hyetos.streaming import spells

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

TREND = TrendParams(window="10 minutes", decimals=2)
SLICE = SliceParams(as_of=datetime(2024, 1, 15, 12))
STRICT = Thresholds(high_temp=35.0, low_temp=-5.0, high_wind=28.0)
CITIES = ("CITY_0", "CITY_2", "CITY_3", "CITY_5", "CITY_9")
CITY = "CITY_3"

FORECAST_SQL = """forecast as (
  select event_id,
         concat('CITY_', cast(user_id % 7 as varchar)) as name,
         ts as fetch_time,
         strftime(ts, '%Y-%m-%d') as forecast_date,
         date_trunc('hour', ts) as forecast_time,
         value - 10.0::double as temp,
         cast(json_extract_string(props, '$.k') as int) as humidity,
         cast(json_extract_string(props, '$.k') as double) * 0.25 + 6.5 as wind_speed,
         event_type as condition
  from events)"""

TREND_SQL = f"""{FORECAST_SQL},
bucketed as (
  select time_bucket(interval '10 minutes', forecast_time, timestamp '1970-01-01') as ws, *
  from forecast where forecast_time is not null),
window_mode as (
  select ws, name, condition from (
    select ws, name, condition,
           row_number() over (partition by ws, name order by count(*) desc, condition) as r
    from bucketed where condition is not null group by ws, name, condition) where r = 1),
measures as (
  select ws, name,
         cast(sum(cast(temp as decimal(12,2))) as double) / count(temp) as avg_temp,
         max(temp) as max_temp, min(temp) as min_temp,
         avg(humidity) as avg_humidity, avg(wind_speed) as avg_wind_speed
  from bucketed group by ws, name),
trend as (
  select measures.ws as window_start, measures.ws + interval '10 minutes' as window_end,
         measures.name, avg_temp, max_temp, min_temp, avg_humidity, avg_wind_speed,
         window_mode.condition as common_condition
  from measures left join window_mode on measures.ws = window_mode.ws
                                     and measures.name = window_mode.name)"""


def _alert_sql(source: str, t: Thresholds = Thresholds()) -> str:
    hot, cold, windy = (
        f"temp > {t.high_temp}::double",
        f"temp < {t.low_temp}::double",
        f"wind_speed > {t.high_wind}::double",
    )
    return f"""select name, forecast_time as "timestamp", temp as temperature, wind_speed,
         case when {hot} then 'HIGH TEMPERATURE' when {cold} then 'LOW TEMPERATURE'
              when {windy} then 'HIGH WIND' end as alert_type
  from {source} where {hot} or {cold} or {windy}"""


ALERT_SQL = f"alerts as ({_alert_sql('forecast')})"

FIRST_ALERT_SQL = """first_alert as (
  select name, "timestamp" as alert_time, alert_type, alert_value,
         case when alert_type = 'HIGH WIND' then 'Km/h' else '°C' end as alert_unit
  from (
    select *, row_number() over (partition by name order by "timestamp" nulls last, rank, alert_value) as r
    from (
      select *, case when alert_type = 'HIGH WIND' then wind_speed else temperature end as alert_value,
             case alert_type when 'HIGH TEMPERATURE' then 0 when 'LOW TEMPERATURE' then 1 else 2 end as rank
      from alerts))
  where r = 1)"""

DAILY_SQL = """days as (select strftime(window_start, '%Y-%m-%d') as date_str, * from trend),
rollup_rows as (
  select name, date_str, date_str as date, max(max_temp) as max_temp, min(min_temp) as min_temp,
         round(avg(avg_wind_speed), 9) as avg_wind_speed, round(avg(avg_humidity), 9) as avg_humidity
  from days group by name, date_str),
day_mode as (
  select name, date_str, common_condition from (
    select name, date_str, common_condition,
           row_number() over (partition by name, date_str order by count(*) desc, common_condition) as r
    from days where common_condition is not null group by name, date_str, common_condition)
  where r = 1)"""


def _quoted(texts) -> str:
    return ", ".join("'" + t.replace("'", "''") + "'" for t in texts)


def _class_sql(column: str) -> str:
    exact = "\n".join(f"when {column} = '{p}' then '{c}'" for p, c in RULES)
    partial = "\n".join(
        f"when contains(lower({column}), '{p.lower()}') then '{c}'" for p, c in RULES
    )
    return (
        f"case when {column} is null or {column} = '' then '{UNKNOWN}'\n{exact}\n{partial}\n"
        f"else '{OTHER}' end"
    )


def _glyph_sql(column: str) -> str:
    whens = " ".join(f"when '{c}' then '{g}'" for c, g in GLYPHS.items())
    return f"case {column} {whens} end"


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, where there is one, the SQL with the same result."""

    def register(function: Query) -> Query:
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = oracle
        return function

    return register


def _forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.forecast_view(events.read_events(spark, sf_dir))


def _trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trends.with_window_bounds(trends.trend(_forecast(spark, sf_dir), TREND))


def _plain_times(df: DataFrame) -> DataFrame:
    """Timestamps without time zone, as the tables have them."""
    zoned = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp"]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned})


def _rounded_means(daily_rows: DataFrame) -> DataFrame:
    """Means of means at nine digits, below which the order of summation shows."""
    means = ("avg_wind_speed", "avg_humidity")
    rounded = daily_rows.withColumns({c: F.round(c, 9) for c in means})
    return rounded.withColumn("date", F.col("date").cast("string"))


# Sources and flattening


def _lead_sql() -> str:
    rows = ", ".join(f"({i}, {lead})" for i, lead in enumerate(events.LEAD_HOURS))
    return f"""hours as (
  select event_id, name, fetch_time, condition, humidity, wind_speed,
         temp + position * 0.5::double as temp, forecast_time + to_hours(lead) as forecast_time
  from forecast, (values {rows}) as leads(position, lead))"""


HOURS_SQL = f"""with {FORECAST_SQL}, {_lead_sql()}
select name, fetch_time, strftime(forecast_time, '%Y-%m-%d') as forecast_date, forecast_time,
       temp, humidity, wind_speed, condition, event_id from hours"""


@query("nested_flatten", HOURS_SQL)
def nested_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as JSON text, read with the declared schema and flattened."""
    text = events.document_view(events.read_events(spark, sf_dir)).select(
        F.to_json(F.struct("*")).alias("text")
    )
    docs = text.select(F.from_json("text", events.EVENT_DOCUMENT).alias("doc")).select("doc.*")
    return _plain_times(flatten.flatten(docs, hour_extra=("event_id",)))


@query("stream_flatten", HOURS_SQL)
def stream_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents landed as JSON files, streamed and flattened into a history."""
    root = work_dir(spark, "stream_flatten")
    landing = f"{root}/landing"
    documents.land_documents(events.document_view(events.read_events(spark, sf_dir)), landing)
    docs = documents.stream_documents(spark, landing, events.EVENT_DOCUMENT)
    streams.await_all([streams.start_flatten(docs, root, hour_extra=("event_id",), once=True)])
    return _plain_times(snapshots.read_history(spark, root, streams.FORECAST).drop("batch_id"))


@query("land_then_read", HOURS_SQL)
def land_then_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents landed as JSON files and read back, both with their defaults."""
    landing = f"{work_dir(spark, 'land_then_read')}/landing"
    documents.land_documents(events.document_view(events.read_events(spark, sf_dir)), landing)
    docs = documents.read_documents(spark, landing, events.EVENT_DOCUMENT)
    return _plain_times(flatten.flatten(docs, hour_extra=("event_id",)))


@query(
    "current_conditions",
    f"""with {FORECAST_SQL}
select name, fetch_time, temp as current_temp, humidity as current_humidity,
       wind_speed as current_wind, condition as current_condition from forecast""",
)
def current_conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = events.document_view(events.read_events(spark, sf_dir))
    return _plain_times(flatten.current_conditions(docs))


@query(
    "timestamp_parse",
    """select event_id, text, try_cast(text as timestamp) as fetch_time
from (select event_id, case when event_type = 'error' then concat('at ', iso) else iso end as text
      from (select event_id, event_type, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') as iso from events))""",
)
def timestamp_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ISO text to timestamps, where the text of one event type is no timestamp."""
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    text = F.when(F.col("event_type") == "error", F.concat(F.lit("at "), iso)).otherwise(iso)
    texts = events.read_events(spark, sf_dir).select("event_id", text.alias("text"))
    return _plain_times(texts.withColumn("fetch_time", parse_timestamp(F.col("text"))))


# Forms of time text by event_id modulo 8.
@query(
    "timestamp_forms",
    """select event_id, text, case when k in (5, 6, 7) then null when k = 2 then date_trunc('day', ts)
         when k in (1, 3) then date_trunc('minute', ts) when k = 4 then ts - interval '2 hours 30 minutes'
         else ts end as parsed
from (select event_id, ts, k, case k
        when 0 then strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ')
        when 1 then strftime(ts, '%Y-%m-%d %H:%M')
        when 2 then strftime(ts, '%Y-%m-%d')
        when 3 then strftime(ts, '%Y-%m-%dT%H:%M')
        when 4 then strftime(ts, '%Y-%m-%dT%H:%M:%S.%f+02:30')
        when 5 then strftime(ts, '%H:%M:%S')
        when 6 then strftime(ts, '%d.%m.%Y %H:%M')
        else '' end as text
      from (select *, event_id % 8 as k from events))""",
)
def timestamp_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates, minutes, zones and offsets; a time alone, another order and no text are none."""
    kind = F.col("event_id") % 8
    patterns = {
        0: "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'",
        1: "yyyy-MM-dd HH:mm",
        2: "yyyy-MM-dd",
        3: "yyyy-MM-dd'T'HH:mm",
        4: "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+02:30'",
        5: "HH:mm:ss",
        6: "dd.MM.yyyy HH:mm",
    }
    text = F.lit("")
    for number, pattern in patterns.items():
        text = F.when(kind == number, F.date_format("ts", pattern)).otherwise(text)
    texts = events.read_events(spark, sf_dir).select("event_id", text.alias("text"))
    return _plain_times(texts.withColumn("parsed", parse_timestamp(F.col("text"))))


@query(
    "calendar_parts",
    f"""with {FORECAST_SQL}
select event_id, forecast_time, strftime(forecast_time, '%Y-%m-%d') as date,
       cast(hour(forecast_time) as int) as hour, strftime(forecast_time, '%H:%M') as time_str,
       strftime(forecast_time, '%Y-%m-%d') as date_str,
       strftime(forecast_time, '%m-%d %H:%M') as display_time from forecast""",
)
def calendar_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    times = _forecast(spark, sf_dir).select("event_id", "forecast_time")
    parts = with_calendar_parts(times, "forecast_time")
    return parts.withColumn("date", F.col("date").cast("string"))


# Trends


@query("trend_window", f"with {TREND_SQL} select * from trend")
def trend_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    ordered = trends.order_trend(trends.trend(_forecast(spark, sf_dir), TREND))
    return trends.with_window_bounds(ordered)


@query(
    "trend_default",
    f"""with {TREND_SQL} select * replace (round(avg_temp, 9) as avg_temp) from trend""",
)
def trend_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trend with temperatures summed as doubles, at nine digits."""
    found = trends.with_window_bounds(trends.trend(_forecast(spark, sf_dir)))
    return found.withColumn("avg_temp", F.round("avg_temp", 9))


@query(
    "mode_condition",
    f"""with {FORECAST_SQL}
select name, forecast_date, condition as common_condition from (
  select name, forecast_date, condition,
         row_number() over (partition by name, forecast_date
                            order by case when condition is null then 1 else 0 end,
                                     count(*) desc, condition) as r
  from forecast group by name, forecast_date, condition) where r = 1""",
)
def mode_condition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trends.modal_condition(_forecast(spark, sf_dir), "name", "forecast_date")


SLIDING_SQL = TREND_SQL.replace(
    "timestamp '1970-01-01') as ws, *\n  from forecast",
    "timestamp '1970-01-01') - to_minutes(10 * pane) as ws, *\n  from forecast, range(18) as panes(pane)",
).replace("interval '10 minutes' as window_end", "interval '3 hours' as window_end")


@query("sliding_trend", f"with {SLIDING_SQL} select * from trend")
def sliding_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trend of three hours, every ten minutes."""
    sliding = trends.sliding_trend(_forecast(spark, sf_dir), TREND, panes=18)
    return _plain_times(trends.with_window_bounds(sliding))


_CUBE_SETS = "grouping sets ((name, forecast_date), (name), (forecast_date))"


@query(
    "trend_cube",
    f"""with {FORECAST_SQL},
measures as (
  select name, forecast_date, cast(grouping(name, forecast_date) as bigint) as "grouping",
         cast(sum(cast(temp as decimal(12,2))) as double) / count(temp) as avg_temp,
         max(temp) as max_temp, min(temp) as min_temp,
         avg(humidity) as avg_humidity, avg(wind_speed) as avg_wind_speed
  from forecast group by {_CUBE_SETS}),
modes as (
  select name, forecast_date, "grouping", condition from (
    select *, row_number() over (partition by name, forecast_date, "grouping"
                                 order by condition is null, n desc, condition) as r
    from (select name, forecast_date, condition, count(*) as n,
                 cast(grouping(name, forecast_date) as bigint) as "grouping"
          from forecast
          group by grouping sets ((name, forecast_date, condition), (name, condition), (forecast_date, condition))))
  where r = 1)
select m.*, condition as common_condition from measures as m join modes as o
  on m.name is not distinct from o.name and m.forecast_date is not distinct from o.forecast_date
     and o."grouping" = m."grouping" """,
)
def trend_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trend by location and day, by location, and by day."""
    sets = [["name", "forecast_date"], ["name"], ["forecast_date"]]
    return trends.trend_cube(_forecast(spark, sf_dir), sets, TREND)


@query("stream_trend", f"with {TREND_SQL} select * from trend")
def stream_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trend kept by a stream in complete mode, read from its latest snapshot."""
    root = work_dir(spark, "stream_trend")
    forecast = events.forecast_view(events.stream_events(spark, sf_dir))
    streams.await_all([streams.start_trend(forecast, root, TREND, once=True)])
    latest = snapshots.read_latest(spark, root, streams.TRENDS)
    return _plain_times(trends.with_window_bounds(latest))


@query(
    "stream_trend_bounded",
    f"""with {TREND_SQL} select * from trend
where window_end <= (select max(forecast_time) from forecast) - interval '8 days'""",
)
def stream_trend_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows that a stream with a watermark has closed, each written once."""
    root = work_dir(spark, "stream_trend_bounded")
    forecast = events.forecast_view(events.stream_events(spark, sf_dir))
    streams.await_all([streams.start_trend_bounded(forecast, root, TREND, once=True)])
    closed = snapshots.read_history(spark, root, streams.TRENDS_BOUNDED).drop("batch_id")
    return _plain_times(trends.with_window_bounds(closed))


@query(
    "serve_bounded",
    f"""with {TREND_SQL.replace("trend as (", "all_trend as (")},
trend as (select * from all_trend
          where window_end <= (select max(forecast_time) from forecast) - interval '8 days'),
{DAILY_SQL}
select * from rollup_rows""",
)
def serve_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed windows of a bounded stream through to the daily table."""
    root = work_dir(spark, "serve_bounded")
    forecast = events.forecast_view(events.stream_events(spark, sf_dir))
    streams.await_all([streams.start_trend_bounded(forecast, root, TREND, once=True)])
    closed = snapshots.read_history(spark, root, streams.TRENDS_BOUNDED).drop("batch_id")
    return _rounded_means(daily.daily_rollup(trends.with_window_bounds(closed)))


# Streams over several batches, each begun anew from its checkpoint


def _run_in_slices(
    spark: SparkSession, sf_dir: str, label: str, start: Callable[..., StreamingQuery], slices: int = 3, **options
) -> str:
    """Land the events in slices of time and run the stream to its end after each of them.

    So the stream sees several batches, stops in between and goes on from its checkpoint.
    """
    root = work_dir(spark, label)
    landing = f"{root}/landing"
    table = events.read_events(spark, sf_dir)
    first, last = table.agg(F.min("ts"), F.max("ts")).first()
    for number in range(slices):
        part = table
        if first is not None:
            low, high = (first + (last - first) * (number + i) / slices for i in (0, 1))
            if number:
                part = part.where(F.col("ts") >= wall_clock(low))
            if number < slices - 1:
                before = F.col("ts") < wall_clock(high)
                part = part.where(before if number else before | F.col("ts").isNull())
        part.write.mode("append").parquet(landing)
        arrived = spark.readStream.schema(table.schema).parquet(landing)
        streams.await_all([start(events.forecast_view(arrived), root, once=True, **options)])
    return root


@query(
    "stream_alerts_once",
    f"with {FORECAST_SQL}, {ALERT_SQL} select distinct name, \"timestamp\", alert_type from alerts",
)
def stream_alerts_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts without repeats; which of the repeats is kept depends on their arrival."""
    root = _run_in_slices(spark, sf_dir, "stream_alerts_once", streams.start_alerts_once_per_hour)
    found = snapshots.read_history(spark, root, streams.EXTREME_ONCE)
    return _plain_times(found.select("name", "timestamp", "alert_type"))


LATEST_SQL = f"""{FORECAST_SQL},
latest as (
  select * exclude (r) from (
    select *, row_number() over (partition by name, forecast_time
                                 order by fetch_time desc nulls last, event_id desc) as r
    from forecast) where r = 1)"""


@query("stream_revisions", f"with {LATEST_SQL} select * from latest")
def stream_revisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest revision of each hour, from the changes that a stream wrote."""
    tiebreak = ("event_id",)
    root = _run_in_slices(spark, sf_dir, "stream_revisions", streams.start_revisions, tiebreak=tiebreak)
    changes = snapshots.read_history(spark, root, streams.REVISIONS).drop("batch_id")
    return _plain_times(revisions.latest_revision(changes, tiebreak))


SESSION_SQL = """marked as (
  select *, case when lag("timestamp") over (partition by name order by "timestamp") + interval '90 minutes'
                      > "timestamp" then 0 else 1 end as opens
  from alerts where "timestamp" is not null),
numbered as (
  select *, sum(opens) over (partition by name order by "timestamp" range unbounded preceding) as session
  from marked),
sessions as (
  select name, min("timestamp") as session_start, max("timestamp") as last_alert, count(*) as n_alerts,
         max(temperature) as peak_temperature, max(wind_speed) as peak_wind_speed
  from numbered group by name, session)"""


@query(
    "stream_alert_sessions",
    f"""with {FORECAST_SQL}, {ALERT_SQL}, {SESSION_SQL}
select * from sessions
where last_alert + interval '90 minutes' <= (select max("timestamp") from alerts) - interval '8 days'""",
)
def stream_alert_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of extreme hours that a stream has closed, each written once."""
    root = _run_in_slices(spark, sf_dir, "stream_alert_sessions", streams.start_sessions)
    return _plain_times(snapshots.read_history(spark, root, streams.SESSIONS).drop("batch_id"))


@query(
    "stream_alert_withdrawn",
    f"""with {FORECAST_SQL},
raised as ({_alert_sql('forecast').replace("select name", "select event_id, fetch_time, name", 1)}),
calm as (
  select name, forecast_time, fetch_time, temp from forecast
  where not coalesce(temp > 30 or temp < 0 or wind_speed > 25, false)),
passed as (
  select least((select max(fetch_time) from raised), (select max(fetch_time) from calm)) - interval '10 minutes' as mark),
earliest as (
  select event_id, min(c.fetch_time) as withdrawn_at, min_by(c.temp, struct_pack(c.fetch_time, c.temp)) as temperature_then
  from raised as r join calm as c
    on r.name = c.name and r."timestamp" = c.forecast_time
       and c.fetch_time > r.fetch_time and c.fetch_time <= r.fetch_time + interval '30 minutes'
  group by event_id)
select r.*, withdrawn_at, temperature_then
from raised as r left join earliest using (event_id)
where withdrawn_at is not null or fetch_time + interval '30 minutes' <= (select mark from passed)""",
)
def stream_alert_withdrawn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts that a later revision of their hour withdrew, and those that none can any more."""
    root = _run_in_slices(
        spark, sf_dir, "stream_alert_withdrawn", streams.start_withdrawn, keep=("event_id",)
    )
    history = snapshots.read_history(spark, root, streams.WITHDRAWN)
    return _plain_times(streams.first_withdrawal(history))


@query(
    "stream_alert_spells",
    f"""with {FORECAST_SQL},
hours as (
  select name, date_trunc('hour', fetch_time) as hour, max(temp) as peak from forecast group by all),
closed as (
  select *, (select max(fetch_time) from forecast) - interval '10 minutes' as mark from hours
  where hour + interval '1 hour' <= (select max(fetch_time) from forecast) - interval '10 minutes'),
parted as (
  select *, sum(gap) over (partition by name order by hour rows unbounded preceding) as part from (
    select *, case when hour - lag(hour) over (partition by name order by hour) > interval '2 hours'
                   then 1 else 0 end as gap from closed)),
hot as (
  select *, coalesce(last_value(signal ignore nulls) over (
              partition by name, part order by hour rows unbounded preceding), 0) as hot
  from (select *, case when peak > 30 then 1 when peak <= 25 then 0 end as signal from parted)),
numbered as (
  select *, sum(1 - hot) over (partition by name, part order by hour rows unbounded preceding) as spell,
         lead(hour) over (partition by name, part order by hour) as following,
         lead(hour) over (partition by name order by hour) as later
  from hot)
select name, min(hour) as opened, max(hour) as last_hour, count(*) as n_hours, max(peak) as peak,
       case when arg_max(following is not null, hour) then 'calm' else 'quiet' end as closed_by
from numbered where hot = 1
group by name, part, spell
having arg_max(later is not null, hour) or max(hour) + interval '3 hours' <= any_value(mark)""",
)
def stream_alert_spells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Heat spells that a stream with explicit state and timers has closed."""
    root = _run_in_slices(spark, sf_dir, "stream_alert_spells", spells.start_spells)
    return _plain_times(snapshots.read_history(spark, root, streams.SPELLS).drop("batch_id"))


# The main path: array files landed, several batches, both streams side by side

PIPELINE_SQL = f"with {FORECAST_SQL}, {_lead_sql()}"
PIPELINE_TREND_SQL = f"with {TREND_SQL}".replace(
    "bucketed as (", f"{_lead_sql()},\nbucketed as (", 1
).replace("from forecast where forecast_time", "from hours where forecast_time", 1)


def _run_pipeline(spark: SparkSession, sf_dir: str, label: str) -> str:
    root = work_dir(spark, label)
    landing = f"{root}/landing"
    docs = events.document_view(events.read_events(spark, sf_dir))
    documents.land_arrays(docs, landing, least_files=200)
    most = _files_per_batch(spark, landing)

    def forecast() -> DataFrame:
        read = documents.stream_documents(
            spark, landing, events.EVENT_DOCUMENT, arrays=True, max_files=most
        )
        return flatten.flatten(read)

    streams.await_all(
        [
            streams.start_trend(forecast(), root, TREND, once=True),
            streams.start_alerts(forecast(), root, once=True),
        ]
    )
    return root


def _run_shared(spark: SparkSession, sf_dir: str, label: str) -> str:
    root = work_dir(spark, label)
    landing = f"{root}/landing"
    table = events.read_events(spark, sf_dir)
    most = -(-table.count() // 8)
    documents.land_documents(events.document_view(table), landing, max(most, 1))
    _start_shared_in_batches(spark, root, landing)
    return root


def _files_per_batch(spark: SparkSession, landing: str, batches: int = 3) -> int:
    """As many files as give about so many batches, whatever the number of files."""
    n_files = sum(1 for _ in names_descending(spark, f"{landing}/part-*"))
    return max(1, -(-n_files // batches))


def _start_shared_in_batches(spark: SparkSession, root: str, landing: str) -> None:
    most = _files_per_batch(spark, landing)
    judged = documents.stream_judged(spark, landing, events.EVENT_DOCUMENT, max_files=most)
    streams.await_all([streams.start_shared(judged, root, TREND, once=True)])


@query("pipeline_shared_trend", f"{PIPELINE_TREND_SQL} select * from trend")
def pipeline_shared_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trend of a stream that parses each document once for trend and alerts."""
    root = _run_shared(spark, sf_dir, "pipeline_shared_trend")
    return _plain_times(trends.with_window_bounds(streams.shared_trend(spark, root, TREND)))


@query("pipeline_shared_alerts", f"{PIPELINE_SQL} {_alert_sql('hours')}")
def pipeline_shared_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The alerts of the same stream."""
    root = _run_shared(spark, sf_dir, "pipeline_shared_alerts")
    found = snapshots.read_group(spark, root, streams.SHARED, streams.EXTREME)
    return _plain_times(found.drop("batch_id"))


# Faults by event_id modulo 50: text behind a document, two documents, half a document, another type.
_FAULTS_SQL = """case event_id % 50 when 0 then 'not one document' when 1 then 'not one document'
       when 2 then 'not one document' when 3 then 'forecast is of another type' end"""


@query(
    "quarantine",
    f"""with {PIPELINE_SQL.removeprefix('with ')}
select event_id, {_FAULTS_SQL} as fault, null as n_alerts from events where event_id % 50 < 4
union all
select null, null, count(*) from (
  {_alert_sql('hours').replace('select name', 'select event_id, name', 1)}) where event_id % 50 >= 4""",
)
def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of which some are damaged: those that were set aside, and the alerts of the rest."""
    root = work_dir(spark, "quarantine")
    table = events.read_events(spark, sf_dir)
    docs = events.document_view(table, keep=("event_id",))
    parts = [c for c in docs.columns if c != "event_id"]
    named = F.col("event_id").alias("source_event")
    text = F.to_json(F.struct(named, *parts))
    wrong = F.to_json(F.struct(named, *[c for c in parts if c != "forecast"], F.lit("sunny").alias("forecast")))
    kind = F.col("event_id") % 50
    value = (
        F.when(kind == 0, F.concat(text, F.lit(" junk")))
        .when(kind == 1, F.concat(text, text))
        .when(kind == 2, F.substr(text, F.lit(1), (F.length(text) / 2).cast("int")))
        .when(kind == 3, wrong)
        .otherwise(text)
    )
    most = max(1, -(-table.count() // 8))
    writer = docs.select(value.alias("value")).write.option("maxRecordsPerFile", most)
    writer.text(f"{root}/landing")
    _start_shared_in_batches(spark, root, f"{root}/landing")
    damaged = snapshots.read_group(spark, root, streams.SHARED, streams.DAMAGED)
    counts = snapshots.group_counts(spark, root, streams.SHARED)
    event = F.regexp_extract("text", '"source_event":(\\d+)', 1).cast("bigint")
    n_alerts = F.sum(F.col("counts")[streams.EXTREME]).alias("n_alerts")
    total = counts.agg(n_alerts)
    return damaged.select(event.alias("event_id"), "fault").unionByName(total, allowMissingColumns=True)


@query("pipeline_trend", f"{PIPELINE_TREND_SQL} select * from trend")
def pipeline_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Array files landed, then trend and alerts as two streams; the latest trend."""
    root = _run_pipeline(spark, sf_dir, "pipeline_trend")
    return _plain_times(
        trends.with_window_bounds(snapshots.read_latest(spark, root, streams.TRENDS))
    )


@query("pipeline_alerts", f"{PIPELINE_SQL} {_alert_sql('hours')}")
def pipeline_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same two streams; the alerts of all batches."""
    root = _run_pipeline(spark, sf_dir, "pipeline_alerts")
    return _plain_times(snapshots.read_history(spark, root, streams.EXTREME).drop("batch_id"))


# Revisions


@query("latest_revision", f"with {LATEST_SQL} select * from latest")
def latest_revision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return revisions.latest_revision(_forecast(spark, sf_dir), tiebreak=("event_id",))


@query("dedup_alerts", f"with {LATEST_SQL} {_alert_sql('latest')}")
def dedup_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts.extreme_latest(_forecast(spark, sf_dir), tiebreak=("event_id",))


# Alerts


@query(
    "alert_summary_join",
    f"""with {FORECAST_SQL}, {ALERT_SQL}, {FIRST_ALERT_SQL}
select cities.name, alert_time, alert_type, alert_value, alert_unit
from (select distinct name from forecast) as cities
left join first_alert on cities.name = first_alert.name""",
)
def alert_summary_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same summary for given names and alerts, by a join."""
    forecast = _forecast(spark, sf_dir)
    names = forecast.select("name").distinct()
    return alerts.alert_summary(alerts.extreme(forecast), names)


@query("extreme_alerts", f"with {FORECAST_SQL} {_alert_sql('forecast')}")
def extreme_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts.extreme(_forecast(spark, sf_dir))


@query("stream_alerts", f"with {FORECAST_SQL} {_alert_sql('forecast')}")
def stream_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts of a stream in append mode, all batches of its history."""
    root = work_dir(spark, "stream_alerts")
    forecast = events.forecast_view(events.stream_events(spark, sf_dir))
    streams.await_all([streams.start_alerts(forecast, root, once=True)])
    return snapshots.read_history(spark, root, streams.EXTREME).drop("batch_id")


@query(
    "alert_summary",
    f"""with {FORECAST_SQL}, {ALERT_SQL}, {FIRST_ALERT_SQL}
select cities.name, alert_time, alert_type, alert_value, alert_unit
from (select distinct name from forecast) as cities
left join first_alert on cities.name = first_alert.name""",
)
def alert_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts.forecast_alerts(_forecast(spark, sf_dir))


@query("alert_sessions", f"with {FORECAST_SQL}, {ALERT_SQL}, {SESSION_SQL} select * from sessions")
def alert_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of extreme hours of every location."""
    return _plain_times(alerts.alert_sessions(alerts.extreme(_forecast(spark, sf_dir))))


@query(
    "asof_revision",
    f"""with {FORECAST_SQL}, alerts as (
  select event_id, name, forecast_time as "timestamp", temp as temperature, wind_speed
  from forecast where temp > 30 or temp < 0 or wind_speed > 25),
revisions as (
  select * exclude (r) from (
    select *, row_number() over (partition by name, fetch_time order by event_id desc) as r from forecast)
  where r = 1)
select a.*, r.fetch_time as valid_since, r.event_id as valid_event, r.temp as valid_temp,
       r.condition as valid_condition
from alerts as a asof left join revisions as r
  on a.name = r.name and a."timestamp" >= r.fetch_time""",
)
def asof_revision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each alert with the last forecast of its location that had been issued by its hour."""
    forecast = _forecast(spark, sf_dir)
    found = alerts.extreme(forecast, keep=("event_id",)).drop("alert_type")
    taken = {"fetch_time": "valid_since", "event_id": "valid_event", "temp": "valid_temp", "condition": "valid_condition"}
    return asof.asof_join(
        found, forecast, ["name"], "timestamp", "fetch_time", taken, tiebreak=["event_id"]
    )


# Locations


@query(
    "city_timeline",
    f"""with {TREND_SQL}
select *, strftime(window_start, '%Y-%m-%d') as date, cast(hour(window_start) as int) as hour,
       strftime(window_start, '%H:%M') as time_str, strftime(window_start, '%Y-%m-%d') as date_str,
       strftime(window_start, '%m-%d %H:%M') as display_time from trend""",
)
def city_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    timeline = cities.city_timeline(_trend(spark, sf_dir))
    return timeline.withColumn("date", F.col("date").cast("string"))


@query("city_filter", f"with {TREND_SQL} select * from trend where name = '{CITY}'")
def city_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cities.for_city(_trend(spark, sf_dir), CITY)


@query("distinct_cities", f"with {FORECAST_SQL} select distinct name from forecast")
def distinct_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cities.distinct_cities(_forecast(spark, sf_dir))


@query(
    "monitored_cities",
    f"with {FORECAST_SQL} select * from forecast where name in ({_quoted(CITIES)})",
)
def monitored_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cities.monitored(_forecast(spark, sf_dir), CITIES)


@query(
    "latest_per_city",
    f"""with {TREND_SQL}
select * exclude (r) from (
  select *, row_number() over (partition by name order by window_start desc) as r from trend)
where r = 1""",
)
def latest_per_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cities.latest_per_city(_trend(spark, sf_dir))


@query(
    "hourly_slice",
    f"""with {TREND_SQL}
select name, window_start, strftime(window_start, '%m-%d %H:%M') as display_time,
       round_even(avg_temp * 100.0::double, 0) / 100.0::double as temperature_c
from trend where window_start between timestamp '{SLICE.start}' and timestamp '{SLICE.end}'""",
)
def hourly_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = events.read_events(spark, sf_dir)
    near = events.events_between(table, SLICE.start, SLICE.end, TREND.window)
    return serving.slice_from_forecast(events.forecast_view(near), SLICE, TREND)


@query(
    "city_card",
    f"""with {TREND_SQL}, {ALERT_SQL}, {FIRST_ALERT_SQL},
last_rows as (
  select * exclude (r), {_class_sql('common_condition')} as condition_class from (
    select *, row_number() over (partition by name order by window_start desc) as r from trend)
  where r = 1)
select last_rows.name, window_start, avg_temp, avg_humidity,
       printf('%.1f°C', avg_temp) as temperature_text,
       concat(printf('%.0f', avg_humidity), '%') as humidity_text,
       condition_class, {_glyph_sql('condition_class')} as condition_glyph,
       alert_time, alert_type, alert_value, alert_unit,
       printf('%.1f', alert_value) || alert_unit as alert_text
from last_rows left join first_alert on last_rows.name = first_alert.name""",
)
def city_card(spark: SparkSession, sf_dir: str) -> DataFrame:
    forecast = _forecast(spark, sf_dir)
    trend = trends.with_window_bounds(trends.trend(forecast, TREND))
    return serving.city_card(trend, alerts.extreme(forecast))


# Days


@query("daily_rollup", f"with {TREND_SQL}, {DAILY_SQL} select * from rollup_rows")
def daily_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded_means(daily.daily_rollup(_trend(spark, sf_dir)))


@query(
    "daily_condition",
    f"""with {TREND_SQL}, {DAILY_SQL}
select k.name, k.date_str, common_condition from (select distinct name, date_str from days) as k
left join day_mode on k.name = day_mode.name and k.date_str = day_mode.date_str""",
)
def daily_condition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily.daily_condition(_trend(spark, sf_dir))


@query(
    "daily_last_condition",
    f"""with {TREND_SQL}, {DAILY_SQL}
select name, date_str, max_by(common_condition, window_start)
         filter (where common_condition is not null) as last_condition
from days group by name, date_str""",
)
def daily_last_condition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily.daily_last_condition(_trend(spark, sf_dir), "common_condition")


_DAILY_FORECAST_CTE = f"""{TREND_SQL}, {DAILY_SQL},
joined as (
  select r.name, r.date_str, r.date, max_temp, min_temp, avg_wind_speed, avg_humidity, common_condition
  from rollup_rows as r left join day_mode as m on r.name = m.name and r.date_str = m.date_str),
classed as (select *, {_class_sql('common_condition')} as condition_class from joined),
labelled as (
  select *, {_glyph_sql('condition_class')} as condition_glyph,
         coalesce(nullif(common_condition, ''), 'Unknown') as condition_text,
         strftime(cast(date_str as date), '%a %d') as day_label
  from classed)"""

DAILY_FORECAST_SQL = f"with {_DAILY_FORECAST_CTE} select * from labelled"


@query("daily_forecast", DAILY_FORECAST_SQL)
def daily_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded_means(daily.daily_forecast(_trend(spark, sf_dir)))


@query("daily_forecast_join", DAILY_FORECAST_SQL)
def daily_forecast_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table by a left join of the rollup and the daily conditions."""
    trend = _trend(spark, sf_dir)
    joined = daily.join_condition(daily.daily_rollup(trend), daily.daily_condition(trend))
    return _rounded_means(daily.label_days(joined))


@query(
    "daily_display",
    f"""with {_DAILY_FORECAST_CTE}
select name, date_str, day_label, condition_text, condition_glyph,
       printf('%.1f°C', max_temp) as max_temp_text, printf('%.1f°C', min_temp) as min_temp_text,
       printf('%.1fKm/h', avg_wind_speed) as avg_wind_speed_text,
       concat(printf('%.1f', avg_humidity), '%') as avg_humidity_text from labelled""",
)
def daily_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = _rounded_means(daily.daily_forecast(_trend(spark, sf_dir)))
    return daily.display_days(days)


# Conditions

# Texts that reach every branch: exact, part of a rule, first rule wins, no rule.
CONDITION_TEXTS = {
    "click": "Sunny",
    "error": "heavy SNOW showers",
    "purchase": "Moderate or heavy rain in area with thunder",
    "signup": "hail",
}

_TEXT_SQL = " ".join(f"when event_type = '{k}' then '{v}'" for k, v in CONDITION_TEXTS.items())


@query(
    "condition_class",
    f"""with texts as (
  select event_id, case {_TEXT_SQL} when event_id % 2 = 0 then '' end as common_condition from events),
classed as (select *, {_class_sql('common_condition')} as condition_class from texts)
select *, {_glyph_sql('condition_class')} as condition_glyph from classed""",
)
def condition_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.col("event_id") % 2 == 0, "")
    for event_type, value in CONDITION_TEXTS.items():
        text = F.when(F.col("event_type") == event_type, value).otherwise(text)
    texts = events.read_events(spark, sf_dir).select("event_id", text.alias("common_condition"))
    return with_condition_class(texts, "common_condition")


# All patterns in five forms: as they are, upper case, lower case, inside a text, before another.
# The oracle is written out by hand: its own list of exact texts, and the few words that decide otherwise.
CONDITION_FORMS_SQL = """
with exact(place, pattern, class) as (values
  (0, 'Sunny', 'clear'), (1, 'Clear', 'clear'), (2, 'Partly cloudy', 'partly_cloudy'),
  (3, 'Partly Cloudy', 'partly_cloudy'), (4, 'Cloudy', 'cloudy'), (5, 'Overcast', 'cloudy'),
  (6, 'Mist', 'fog'), (7, 'Fog', 'fog'), (8, 'Freezing fog', 'freezing_fog'),
  (9, 'Patchy rain possible', 'showers'), (10, 'Light rain', 'rain'), (11, 'Light rain shower', 'rain'),
  (12, 'Moderate rain', 'rain'), (13, 'Heavy rain', 'rain'), (14, 'Heavy rain at times', 'rain'),
  (15, 'Moderate or heavy rain shower', 'rain'), (16, 'Torrential rain shower', 'rain'),
  (17, 'Rain', 'rain'), (18, 'Drizzle', 'rain'), (19, 'Thundery outbreaks possible', 'thunder'),
  (20, 'Patchy light rain with thunder', 'thunder'), (21, 'Moderate or heavy rain with thunder', 'thunder'),
  (22, 'Thunderstorm', 'thunder'), (23, 'Patchy snow possible', 'snow'), (24, 'Patchy light snow', 'snow'),
  (25, 'Light snow', 'snow'), (26, 'Patchy moderate snow', 'snow'), (27, 'Moderate snow', 'snow'),
  (28, 'Patchy heavy snow', 'heavy_snow'), (29, 'Heavy snow', 'heavy_snow'), (30, 'Blizzard', 'heavy_snow'),
  (31, 'Blowing snow', 'blowing_snow'), (32, 'Patchy light rain with snow', 'rain_and_snow'),
  (33, 'Moderate or heavy rain with snow', 'rain_and_snow'), (34, 'Light sleet', 'sleet'),
  (35, 'Moderate or heavy sleet', 'sleet'), (36, 'Ice pellets', 'ice'),
  (37, 'Light sleet showers', 'sleet'), (38, 'Moderate or heavy sleet showers', 'sleet')),
texts as (
  select event_id, case event_id // 39 % 5 when 0 then p.pattern when 1 then upper(p.pattern)
           when 2 then lower(p.pattern) when 3 then 'so ' || p.pattern || ' it is'
           else p.pattern || ' then ' || lower(o.pattern) end as text
  from events join exact as p on p.place = event_id % 39 join exact as o on o.place = event_id // 195 % 39)
select event_id, text as common_condition, coalesce(e.class, case
    when l like '%sunny%' or l like '%clear%' then 'clear'
    when l like '%partly cloudy%' then 'partly_cloudy'
    when l like '%cloudy%' or l like '%overcast%' then 'cloudy'
    when l like '%mist%' or l like '%fog%' then 'fog'
    when l like '%patchy rain possible%' then 'showers'
    when l like '%rain%' or l like '%drizzle%' then 'rain'
    when l like '%thundery outbreaks possible%' or l like '%thunderstorm%' then 'thunder'
    when l like '%patchy snow possible%' or l like '%light snow%' or l like '%moderate snow%' then 'snow'
    when l like '%heavy snow%' or l like '%blizzard%' then 'heavy_snow'
    when l like '%blowing snow%' then 'blowing_snow'
    when l like '%light sleet%' or l like '%moderate or heavy sleet%' then 'sleet'
    when l like '%ice pellets%' then 'ice' else 'other' end) as condition_class
from (select *, lower(text) as l from texts) left join exact as e on text = e.pattern
"""


@query("condition_forms", CONDITION_FORMS_SQL)
def condition_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    patterns = F.array(*[F.lit(pattern) for pattern, _ in RULES])
    event = F.col("event_id")
    form = F.floor(event / len(RULES)) % 5
    own = F.get(patterns, (event % len(RULES)).cast("int"))
    other = F.get(patterns, (F.floor(event / (5 * len(RULES))) % len(RULES)).cast("int"))
    text = (
        F.when(form == 0, own)
        .when(form == 1, F.upper(own))
        .when(form == 2, F.lower(own))
        .when(form == 3, F.concat(F.lit("so "), own, F.lit(" it is")))
        .otherwise(F.concat(own, F.lit(" then "), F.lower(other)))
    )
    texts = events.read_events(spark, sf_dir).select("event_id", text.alias("common_condition"))
    return with_condition_class(texts, "common_condition").drop("condition_glyph")


# Sketches


@query(
    "sketch_daily",
    f"""with {FORECAST_SQL}
select forecast_date, count(*) as n_rows, count(distinct name) as n_locations,
       true as median_within, true as p95_within from forecast group by forecast_date""",
)
def sketch_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches of five batches, stored and merged, and whether their quantiles are within the bound.

    A quantile is within it if the share of the day's readings below it, and up to it, enclose its
    rank but for the stated error.
    """
    root = work_dir(spark, "sketch_daily")
    forecast = _forecast(spark, sf_dir)
    for batch_id in range(5):
        own = forecast.where(F.col("event_id") % 5 == batch_id)
        snapshots.write_snapshot(sketches.daily_sketches(own), batch_id, root, "sketches")
    merged = sketches.merged_sketches(snapshots.read_history(spark, root, "sketches"))
    ranks = {"median": 0.5, "p95": 0.95}
    found = sketches.read_sketches(merged, ranks)
    day = F.col("forecast_date") == F.col("day")
    readings = forecast.select(F.col("forecast_date").alias("day"), "temp")
    shares = []
    for name in ranks:
        shares.append(F.avg((F.col("temp") < F.col(name)).cast("double")).alias(f"{name}_below"))
        shares.append(F.avg((F.col("temp") <= F.col(name)).cast("double")).alias(f"{name}_up_to"))
    measured = found.join(readings, day).groupBy(*found.columns).agg(*shares)
    within = [
        (
            (F.col(f"{name}_below") <= rank + sketches.RANK_ERROR)
            & (F.col(f"{name}_up_to") >= rank - sketches.RANK_ERROR)
        ).alias(f"{name}_within")
        for name, rank in ranks.items()
    ]
    return measured.select("forecast_date", "n_rows", "n_locations", *within)


# Snapshots


@query(
    "latest_snapshot",
    f"""with {FORECAST_SQL}, strict as ({_alert_sql('forecast', STRICT)})
select *, count(*) over () as snapshot_rows from strict""",
)
def latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two snapshots are written; the second is read back with its recorded row count."""
    root = work_dir(spark, "latest_snapshot")
    forecast = _forecast(spark, sf_dir)
    for batch_id, thresholds in enumerate((Thresholds(), STRICT)):
        found = alerts.extreme(forecast, thresholds)
        snapshots.write_snapshot(found, batch_id, root, streams.EXTREME)
    entry = snapshots.latest_entry(spark, root, streams.EXTREME)
    latest = snapshots.read_latest(spark, root, streams.EXTREME)
    return latest.withColumn("snapshot_rows", F.lit(entry.n_rows).cast("bigint"))


@query(
    "compacted_history",
    f"with {FORECAST_SQL}, {ALERT_SQL.replace('select name', 'select event_id % 7 as batch_id, name', 1)} select * from alerts",
)
def compacted_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven batches, compacted twice and trimmed in between, read as one history."""
    root = work_dir(spark, "compacted_history")
    found = alerts.extreme(_forecast(spark, sf_dir), keep=("event_id",))
    for batch_id in range(7):
        own = found.where(F.col("event_id") % 7 == batch_id).drop("event_id")
        snapshots.write_snapshot(own, batch_id, root, streams.EXTREME)
        if batch_id in (2, 4, 5):
            snapshots.compact(spark, root, streams.EXTREME)
            snapshots.expire(spark, root, streams.EXTREME)
    return snapshots.read_history(spark, root, streams.EXTREME)


@query("snapshot_json_roundtrip", f"with {TREND_SQL} select * from trend")
def snapshot_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trend exported as JSON records and read back."""
    path = f"{work_dir(spark, 'snapshot_json')}/trends"
    snapshots.export_records(trends.trend(_forecast(spark, sf_dir), TREND), path)
    return _plain_times(snapshots.read_trend_records(spark, path))


# Queries that run a stream or write tables before they return.
STREAM_KEYS = {
    "land_then_read",
    "serve_bounded",
    "pipeline_trend",
    "pipeline_alerts",
    "pipeline_shared_trend",
    "pipeline_shared_alerts",
    "quarantine",
    "compacted_history",
    "sketch_daily",
    "stream_flatten",
    "stream_trend",
    "stream_trend_bounded",
    "stream_alerts",
    "stream_alerts_once",
    "stream_revisions",
    "stream_alert_sessions",
    "stream_alert_withdrawn",
    "stream_alert_spells",
    "latest_snapshot",
    "snapshot_json_roundtrip",
}
