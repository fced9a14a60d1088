"""DuckDB SQL for the registered queries: the same results, from the same tables."""

from __future__ import annotations

BASE = """
with trips_raw as (
  select event_id as trip_id,
    ts as tpep_pickup_datetime,
    ts + to_minutes(cast(event_id % 60 - 5 as integer)) as tpep_dropoff_datetime,
    cast((event_id * 7) % 200 as double) / 10 as trip_distance,
    case when event_id % 89 = 0 then null else user_id % 27 end as PULocationID,
    (event_id * 13) % 27 as DOLocationID,
    case when event_id % 50 = 0 then -value
         when event_id % 53 = 0 then null
         when event_id % 101 = 0 then cast('NaN' as double)
         else value end as fare_amount,
    case when event_id % 11 = 0 then null else value * 0.125 end as tip_amount,
    case when event_id % 17 = 0 then null else event_id % 6 + 1 end as passenger_count,
    case when event_id % 19 = 0 then null else event_id % 8 end as payment_type
  from events),
zones as (
  select n_nationkey as LocationID, r_name as Borough, n_name as Zone,
    r_name || ' Zone' as service_zone
  from nation join region on n_regionkey = r_regionkey),
labelled as (
  select * replace (
    case payment_type when 1 then 'Card' when 2 then 'Cash' when 3 then 'No Charge'
      when 4 then 'Dispute' when 6 then 'Voided' else 'Unknown' end as payment_type)
  from trips_raw),
normalized as (
  select trip_id,
    cast(tpep_pickup_datetime as varchar) as pickup_datetime,
    cast(tpep_dropoff_datetime as varchar) as dropoff_datetime,
    trip_distance, PULocationID as pickup_location_id, DOLocationID as dropoff_location_id,
    fare_amount, coalesce(tip_amount, 0.0::double) as tip_amount,
    coalesce(passenger_count, 1) as passenger_count, payment_type
  from labelled
  where PULocationID is not null and DOLocationID is not null
    and fare_amount is not null and trip_distance is not null),
feed as (
  select * replace (
    case when trip_id % 97 = 0 then 'NaT' else pickup_datetime end as pickup_datetime)
  from normalized),
present as (
  select * from feed
  where pickup_datetime is not null and dropoff_datetime is not null
    and trip_distance is not null and fare_amount is not null and not isnan(fare_amount)),
parsed as (
  select * replace (
    try_cast(pickup_datetime as timestamp) as pickup_datetime,
    try_cast(dropoff_datetime as timestamp) as dropoff_datetime)
  from feed
  where try_cast(pickup_datetime as timestamp) is not null
    and try_cast(dropoff_datetime as timestamp) is not null),
timed as (
  select *,
    (epoch(date_trunc('second', dropoff_datetime))
      - epoch(date_trunc('second', pickup_datetime))) / 60.0 as ride_duration_minutes,
    cast(hour(pickup_datetime) as integer) as pickup_hour
  from parsed),
rides as (
  select * from timed
  where ride_duration_minutes > 0 and fare_amount > 0 and not isnan(fare_amount)
    and trip_distance > 0),
named as (
  select rides.*, p.Zone as pickup_zone, q.Zone as dropoff_zone
  from rides
  left join zones p on p.LocationID = pickup_location_id
  left join zones q on q.LocationID = dropoff_location_id),
requests as (
  select event_id as request_id,
    cast((event_id * 7) % 1100 as double) / 10 as trip_distance,
    event_id % 8 as passenger_count,
    cast(event_id % 26 as integer) as pickup_hour,
    p.Zone as pickup_zone, q.Zone as dropoff_zone
  from events
  left join zones p on p.LocationID = user_id % 27
  left join zones q on q.LocationID = (event_id * 13) % 27)
"""

FEED_COLUMNS = """pickup_datetime, dropoff_datetime, trip_distance, pickup_location_id,
  dropoff_location_id, tip_amount, passenger_count, payment_type"""

NAN_FARE = """case when isnan(fare_amount) then null else fare_amount end as fare_amount,
  coalesce(isnan(fare_amount), false) as fare_is_nan"""

RIDE_COLUMNS = f"{FEED_COLUMNS}, fare_amount, ride_duration_minutes, pickup_hour"

FEED_ROWS = f"select {FEED_COLUMNS}, {NAN_FARE} from feed"
NORMALIZED_ROWS = f"select {FEED_COLUMNS}, {NAN_FARE} from normalized"

PER_ZONE = """select pickup_zone, count(*) as trips from named
  where pickup_zone is not null group by pickup_zone"""

MD5 = "md5(cast(trip_id as varchar))"
BUCKET = f"cast('0x' || substr({MD5}, 1, 6) as bigint) % 100"
POSITION = f"cast('0x' || substr({MD5}, 7, 12) as bigint) / cast(281474976710656 as double)"


def _zone_indexes(source: str) -> str:
    """Frequency ranks of both zone columns of ``source``, as further CTEs."""
    ranks = [
        f"""{side}_ranks as (
  select {side}_zone, row_number() over (order by count(*) desc, {side}_zone) - 1 as rank
  from {source} where {side}_zone is not null group by {side}_zone)"""
        for side in ("pickup", "dropoff")
    ]
    return f""", {", ".join(ranks)}, indexed as (
  select s.*,
    cast(coalesce(p.rank, (select count(*) from pickup_ranks)) as double) as pickup_zone_idx,
    cast(coalesce(d.rank, (select count(*) from dropoff_ranks)) as double) as dropoff_zone_idx
  from {source} s
  left join pickup_ranks p on p.pickup_zone = s.pickup_zone
  left join dropoff_ranks d on d.dropoff_zone = s.dropoff_zone)"""


TRAINING = """, training as (
  select r.*, p.Zone as pickup_zone, q.Zone as dropoff_zone
  from (
    select trip_id, fare_amount, trip_distance, passenger_count, PULocationID, DOLocationID,
      cast(hour(tpep_pickup_datetime) as integer) as pickup_hour,
      (epoch(date_trunc('second', tpep_dropoff_datetime))
        - epoch(date_trunc('second', tpep_pickup_datetime))) / 60.0 as ride_duration_minutes
    from trips_raw
    where fare_amount > 0 and not isnan(fare_amount) and trip_distance > 0) r
  left join zones p on p.LocationID = PULocationID
  left join zones q on q.LocationID = DOLocationID
  where ride_duration_minutes > 0)"""

JUDGED = """select trip_id, feed.* exclude (trip_id), case
        when pickup_datetime is null or dropoff_datetime is null or trip_distance is null
          or fare_amount is null or isnan(fare_amount) then 'missing value'
        when fare_amount <= 0 then 'fare not positive'
        when trip_distance <= 0 then 'distance not positive'
        when t.trip_id is null then 'time not readable'
        when t.minutes <= 0 then 'duration not positive'
      end as reason
      from feed left join
        (select trip_id, ride_duration_minutes as minutes from timed) t using (trip_id)"""

REPLAYED = f"""select trip_id, {RIDE_COLUMNS} from (
    select *,
      (epoch(date_trunc('second', dropoff_datetime))
        - epoch(date_trunc('second', pickup_datetime))) / 60.0 as ride_duration_minutes,
      cast(hour(pickup_datetime) as integer) as pickup_hour
    from (select * replace (
        cast(pickup_datetime as timestamp) as pickup_datetime,
        cast(dropoff_datetime as timestamp) as dropoff_datetime) from normalized))
  where ride_duration_minutes > 0 and fare_amount > 0 and not isnan(fare_amount)
    and trip_distance > 0"""

def _exact(name: str) -> str:
    """Sum of a double column in whole numbers of 2^-60, which the order of rows cannot change."""
    return f"cast(sum(cast({name} * power(2, 60) as hugeint)) as double) / power(2, 60)"


_SELECTS = {
    # Sources
    "scan_trips": f"select * exclude (fare_amount), {NAN_FARE} from trips_raw",
    "scan_mixed_history": f"select * exclude (fare_amount), {NAN_FARE} from trips_raw",
    "scan_zones": "select * from zones",
    "zone_list": "select distinct Zone from zones where Zone is not null order by Zone",
    "feed_files": f"select {FEED_COLUMNS}, {NAN_FARE}, true as within_limit from feed",
    # Normalisation
    "rename_trips": f"""select trip_id, tpep_pickup_datetime as pickup_datetime,
      tpep_dropoff_datetime as dropoff_datetime, trip_distance,
      PULocationID as pickup_location_id, DOLocationID as dropoff_location_id,
      tip_amount, passenger_count, payment_type, {NAN_FARE} from trips_raw""",
    "normalize_feed": f"select trip_id, {FEED_COLUMNS}, {NAN_FARE} from normalized",
    "payment_labels": """select trip_id, t.payment_type as payment_code,
      l.payment_type as payment_type from trips_raw t join labelled l using (trip_id)""",
    "malformed_rows": f"""select trip_id, tpep_pickup_datetime as pickup_datetime,
      tpep_dropoff_datetime as dropoff_datetime, trip_distance,
      PULocationID as pickup_location_id, DOLocationID as dropoff_location_id,
      tip_amount, passenger_count, payment_type, {NAN_FARE} from trips_raw
      where PULocationID is null or DOLocationID is null
        or fare_amount is null or trip_distance is null""",
    # Cleaning
    "drop_missing": "select * from present",
    "positive_fare": "select * from present where fare_amount > 0",
    "positive_distance": "select * from present where trip_distance > 0",
    "parse_timestamps": "select trip_id, pickup_datetime, dropoff_datetime from parsed",
    "ride_duration": """select trip_id, ride_duration_minutes from timed
      where ride_duration_minutes > 0""",
    "pickup_hour": "select trip_id, pickup_hour from timed",
    "clean_rides": "select * from named",
    "reject_reasons": f"""select reason, count(*) as trips from ({JUDGED})
      where reason is not null group by reason""",
    # Joins
    "join_pickup_zone": "select trip_id, pickup_location_id, pickup_zone from named",
    "join_dropoff_zone": "select trip_id, dropoff_location_id, dropoff_zone from named",
    "join_large_dimension": "select trip_id, pickup_location_id, pickup_zone from named",
    # Reports
    "kpi_summary": f"""select count(*) as total_trips,
      coalesce({_exact('fare_amount')}, 0) as total_revenue,
      {_exact('fare_amount')} / count(fare_amount) as average_fare,
      {_exact('ride_duration_minutes')} / count(ride_duration_minutes) as average_duration,
      {_exact('trip_distance')} / count(trip_distance) as average_distance from rides""",
    "kpi_display": """select format('{:,}', count(*)) as total_trips,
      format('${:,.0f}', sum(fare_amount)) as total_revenue,
      format('${:,.2f}', avg(fare_amount)) as average_fare,
      format('{:.1f} min', avg(ride_duration_minutes)) as average_duration,
      format('{:.2f} mi', avg(trip_distance)) as average_distance,
      format('{:,} rides processed', count(*)) as status from rides""",
    "live_incoming": """select count(*) as live_incoming from rides
      where cast(pickup_datetime as date) >=
        (select max(cast(pickup_datetime as date)) from rides)""",
    "avg_tip": f"select {_exact('tip_amount')} / count(tip_amount) as average_tip from rides",
    "trips_per_hour": """select pickup_hour, count(*) as trips from rides
      group by pickup_hour order by pickup_hour""",
    "peak_hour": """select pickup_hour, count(*) as trips,
      lpad(cast(pickup_hour as varchar), 2, '0') || ':00' as hour_label from rides
      group by pickup_hour order by trips desc, pickup_hour limit 1""",
    "payment_mix": """select payment_type, count(*) as trips,
      count(*) / cast(sum(count(*)) over () as double) as share from rides
      where payment_type is not null group by payment_type
      order by trips desc, payment_type""",
    "trips_per_zone": PER_ZONE,
    "busiest_zone": f"{PER_ZONE} order by trips desc, pickup_zone limit 1",
    "top_pickup_zones": f"{PER_ZONE} order by trips desc, pickup_zone limit 10",
    "trips_by_borough": """select coalesce(b.borough, 'Unknown') as borough, count(*) as trips
      from named left join (
        select Zone as zone_name, max(Borough) as borough from zones group by Zone) b
      on zone_name = pickup_zone
      group by 1 order by trips desc, borough""",
    "avg_fare_by_hour_sql": """select pickup_hour, round(avg(fare_amount), 2) as avg_fare
      from rides group by pickup_hour order by avg_fare desc, pickup_hour limit 5""",
    "recent_rides": "select * from named order by pickup_datetime desc, trip_id limit 10",
    "recent_rides_display": """select strftime(pickup_datetime, '%b %d, %H:%M') as "Pickup Time",
      pickup_zone as "From", dropoff_zone as "To",
      format('{:.2f} mi', trip_distance) as "Distance",
      format('${:,.2f}', fare_amount) as "Fare"
      from (select * from named order by pickup_datetime desc, trip_id limit 10)""",
    "fare_per_mile": """select trip_id, case when trip_distance <> 0
      then fare_amount / trip_distance else 0.0 end as fare_per_mile from present""",
    # Streams
    "stream_csv_ingest": FEED_ROWS,
    "stream_parquet_ingest": NORMALIZED_ROWS,
    "stream_union_feeds": f"{FEED_ROWS} union all {FEED_ROWS}",
    "stream_clean_rides": f"select {RIDE_COLUMNS}, pickup_zone, dropoff_zone from named",
    "stream_batch_counts": """select trip_id % 4 as batch_id, count(*) as arrivals
      from trips_raw group by batch_id""",
    "stream_one_file_per_batch": """select 1 as files, count(*) as rows, true as within_limit
      from trips_raw""",
    "stream_replay_idempotent": REPLAYED,
    "stream_two_checkpoints": REPLAYED,
    "stream_csv_rejects": f"""select reason, pickup_datetime_text, trip_distance_text,
        tip_amount_text, payment_type_text, count(*) as trips
      from (
        select case when broken then 'record not readable' else reason end as reason,
          case when broken then pickup_datetime end as pickup_datetime_text,
          case when broken and trip_id % 37 = 0 then 'far'
            when broken then cast(trip_distance as varchar) end as trip_distance_text,
          case when broken and trip_id % 31 = 0 then 'abc'
            when broken then 'number' end as tip_amount_text,
          case when broken then payment_type end as payment_type_text
        from (select *, trip_id % 31 = 0 or trip_id % 37 = 0 as broken from ({JUDGED})
          where not isnan(fare_amount)))
      where reason is not null group by all""",
    "stream_rejects": f"""select trip_id % 4 as batch_id, reason, count(*) as trips
      from ({JUDGED}) where reason is not null group by all""",
    "stream_batch_totals": f"""select trip_id % 4 as batch_id, count(*) as arrived,
      count(*) filter (reason is null) as kept, count(reason) as rejected
      from ({JUDGED}) group by all""",
    "stream_zone_versions": """select trip_id % 4 as batch_id,
      case when trip_id % 4 < 2 then '' else 'New ' end || pickup_zone as pickup_zone,
      count(*) as trips from named group by all""",
    "stream_checked_files": """select 'ride' as kind, pickup_zone as name, count(*) as trips
      from named where trip_id % 4 < 2 group by all
      union all select 'set aside', 'fare_amount is string', null
      union all select 'set aside', 'tip_amount is not there', null""",
    # Sampling and the fare model
    "training_sample": f"""select trip_id, fare_amount from rides
      where {POSITION} < 5000.0::double / (select count(*) from rides)""",
    "train_test_split": f"""select trip_id,
      case when {BUCKET} < 80 then 'train' else 'test' end as split from rides""",
    "rmse_baseline": f"""select count(*) as test_rows, round(sqrt(avg(
        (fare_amount - mean) * (fare_amount - mean))), 6) as rmse
      from rides, (select avg(fare_amount) as mean from rides where {BUCKET} < 80)
      where {BUCKET} >= 80""",
    "valid_requests": """select * from requests where trip_distance between 0.1 and 100.0
      and passenger_count between 1 and 6 and pickup_hour between 0 and 23""",
    "request_features": """select *, trip_distance / 15.0 * 60.0 as ride_duration_minutes
      from requests""",
}

def oracle_sql() -> dict[str, str]:
    sql = {name: f"{BASE}{select}" for name, select in _SELECTS.items()}
    sql["zone_index"] = (
        f"{BASE}{_zone_indexes('named')} "
        "select trip_id, pickup_zone_idx, dropoff_zone_idx from indexed"
    )
    sql["training_features"] = (
        f"{BASE}{TRAINING}{_zone_indexes('training')} "
        """select trip_id, trip_distance, cast(pickup_hour as double) as pickup_hour,
          cast(passenger_count as double) as passenger_count, ride_duration_minutes,
          pickup_zone_idx, dropoff_zone_idx
        from indexed where passenger_count is not null"""
    )
    # Neither fares nor passengers are missing in a test row that can be scored.
    tested = f"from training where passenger_count is not null and {BUCKET} >= 80"
    sql["fare_model_rmse"] = (
        f"{BASE}{TRAINING} select count(*) as test_rows, true as near_mean_predictor {tested}"
    )
    sql["fare_model_predictions"] = (
        f"{BASE}{TRAINING} select trip_id, fare_amount, true as within_train_range {tested}"
    )
    sql["score_requests"] = f"""{BASE} select *,
      trip_distance / 15.0 * 60.0 as ride_duration_minutes, true as within_train_range,
      true as per_mile_agrees, true as has_fare_text,
      lpad(cast(pickup_hour as varchar), 2, '0') || ':00' as hour_text from requests"""
    return sql
