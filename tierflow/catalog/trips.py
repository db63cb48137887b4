"""Trip table, rolling window and trip reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from tierflow.catalog.registry import Tables, query
from tierflow.plans import trips

_TRIP = """VendorID, cast(tpep_pickup_datetime as varchar) tpep_pickup_datetime,
           PULocationID, DOLocationID, fare_amount"""


@query("trips_partitioned", f"""
    select {_TRIP}, year(tpep_pickup_datetime) pickup_year, month(tpep_pickup_datetime) pickup_month
    from trips where year(tpep_pickup_datetime) = 2000""")
def trips_partitioned(t: Tables):
    table = trips.load_trips(t.spark, t.trips, f"{t.scratch}/trips", 2000)
    return table.select("VendorID", "tpep_pickup_datetime", "PULocationID", "DOLocationID", "fare_amount",
                        "pickup_year", "pickup_month")


_WINDOW = """
    from trips where tpep_pickup_datetime >=
      (select max(tpep_pickup_datetime) - interval '2' month from trips)"""


@query("rolling_two_months", f"""
    select {_TRIP}, (select cast(max(tpep_pickup_datetime) - interval '2' month as varchar)
                     from trips) cutoff_date,
           month(tpep_pickup_datetime) pickup_month_number, monthname(tpep_pickup_datetime) pickup_month_name
    {_WINDOW}""")
def rolling_two_months(t: Tables):
    table = trips.load_trips(t.spark, t.trips, f"{t.scratch}/trips")
    return trips.rolling_window(table, newest=trips.newest_month(t.spark, f"{t.scratch}/trips")).select(
        "VendorID", "tpep_pickup_datetime", "PULocationID", "DOLocationID", "fare_amount", "cutoff_date",
        "pickup_month_number", "pickup_month_name")


@query("run_trips_from_months", """
    select month(tpep_pickup_datetime) pickup_month, count(*) rides,
           cast(sum(cast(fare_amount as decimal(18,2))) as double) revenue
    from trips where year(tpep_pickup_datetime) = (select max(year(tpep_pickup_datetime)) from trips)
      and month(tpep_pickup_datetime) in (1, 2) group by 1""")
def run_trips_from_months(t: Tables):
    """Landing files of two months, named by month, to the partitioned table and a report."""
    dated = trips.with_calendar(t.trips)
    year = dated.agg(F.max("pickup_year")).first()[0]
    for month, path in zip((1, 2), trips.month_files(f"{t.scratch}/landing", "yellow", year, [1, 2])):
        dated.filter((F.col("pickup_year") == year) & (F.col("pickup_month") == month)).drop(*trips.PARTITIONS).write.parquet(path)
    table = trips.load_months(t.spark, f"{t.scratch}/landing", "yellow", year, [1, 2], f"{t.scratch}/months")
    return trips.monthly_kpis(table).drop("pickup_year")


@query("rolling_month_counts", f"""
    select month(tpep_pickup_datetime) pickup_month_number, count(*) trips {_WINDOW} group by 1""")
def rolling_month_counts(t: Tables):
    return trips.monthly_counts(trips.rolling_window(trips.with_calendar(t.trips)))


@query("trip_kpis_monthly", """
    select year(tpep_pickup_datetime) pickup_year, month(tpep_pickup_datetime) pickup_month,
           cast(sum(cast(fare_amount as decimal(18,2))) as double) revenue, count(*) rides
    from trips group by 1, 2""")
def trip_kpis_monthly(t: Tables):
    return trips.monthly_kpis(t.trips)


@query("trip_vendor_share", """
    select VendorID, count(*) rides, cast(sum(cast(fare_amount as decimal(18,2))) as double) revenue,
           count(*) / (select count(*) from trips) ride_share
    from trips group by VendorID""")
def trip_vendor_share(t: Tables):
    return trips.vendor_share(t.trips)


@query("trip_top_pickup_zones", """
    select PULocationID, count(*) rides from trips group by 1 order by 2 desc, 1 limit 5""")
def trip_top_pickup_zones(t: Tables):
    return trips.top_zones(t.trips, "PULocationID")


@query("trip_top_dropoff_zones", """
    select DOLocationID, count(*) rides from trips group by 1 order by 2 desc, 1 limit 5""")
def trip_top_dropoff_zones(t: Tables):
    return trips.top_zones(t.trips, "DOLocationID")


@query("trip_max_duration", """
    select max(date_diff('minute', tpep_pickup_datetime, tpep_dropoff_datetime)) max_trip_minutes from trips""")
def trip_max_duration(t: Tables):
    return trips.longest_trip(t.trips)


@query("trip_yield", """
    select cast(sum(cast(fare_amount as decimal(18,2))) as double)
             / cast(sum(cast(trip_distance as decimal(18,2))) as double) yield_per_mile,
           cast(sum(cast(fare_amount as decimal(18,2))) as double)
             / sum(date_diff('minute', tpep_pickup_datetime, tpep_dropoff_datetime)) yield_per_minute
    from trips""")
def trip_yield(t: Tables):
    return trips.yields(t.trips)
