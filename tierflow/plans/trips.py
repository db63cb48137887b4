"""Trip tables: calendar partitions, a rolling window and the reports on it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow import fixed_values as fx
from tierflow.functions.columns import money, year_month
from tierflow.operators.cleanse import EXACT
from tierflow.sinks.files import write_partitioned

PICKUP, DROPOFF = "tpep_pickup_datetime", "tpep_dropoff_datetime"
PARTITIONS = ["pickup_year", "pickup_month"]


def with_calendar(trips: DataFrame) -> DataFrame:
    return trips.withColumns({"pickup_year": F.year(PICKUP), "pickup_month": F.month(PICKUP)})


def month_files(root: str, kind: str, year: int, months: list[int]) -> list[str]:
    """Landing files of the wanted months."""
    return [f"{root.rstrip('/')}/{kind}_tripdata_{year}-{month:02d}.parquet" for month in months]


def load_months(spark: SparkSession, root: str, kind: str, year: int, months: list[int], path: str) -> DataFrame:
    """The table of one year from its landing files, one for each month."""
    return load_trips(spark, spark.read.parquet(*month_files(root, kind, year, months)), path, year)


def newest_month(spark: SparkSession, path: str) -> int | None:
    """``yyyymm`` of the newest month folder, from two folder listings; no file is opened."""
    def newest(folder: str, key: str) -> int | None:
        at = spark._jvm.org.apache.hadoop.fs.Path(folder)
        fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []
        return max((int(n.split("=")[1]) for n in names if n.startswith(f"{key}=") and n.split("=")[1].isdigit()), default=None)

    year = newest(path, PARTITIONS[0])
    month = None if year is None else newest(f"{path}/{PARTITIONS[0]}={year}", PARTITIONS[1])
    return None if month is None else year * 100 + month


def load_trips(spark: SparkSession, trips: DataFrame, path: str, year: int | None = None) -> DataFrame:
    """Rebuild the table, of one year when given, partitioned by month."""
    dated = with_calendar(trips)
    if year is not None:
        dated = dated.filter(F.col("pickup_year") == year)
    write_partitioned(dated, path, PARTITIONS)
    declared = dated.select(*[c for c in dated.columns if c not in PARTITIONS], *PARTITIONS).schema
    return spark.read.schema(declared).parquet(path)


def rolling_window(trips: DataFrame, months: int = fx.ROLLING_MONTHS, newest: int | None = None) -> DataFrame:
    """Trips of the last months before the newest pickup, with cutoff, month number and name.

    ``trips`` carries the calendar columns. With ``newest``, the newest month from the folder listing
    (``newest_month``), the newest pickup is looked for in that month only, and the cutoff is also tested
    on the partition columns, so older folders are never opened. Without it the newest month takes a pass
    over the calendar columns.
    """
    month_key = F.col("pickup_year") * 100 + F.col("pickup_month")
    last_month = trips.select(F.max(month_key)).scalar() if newest is None else F.lit(newest)
    cutoff = (
        trips.filter(month_key == last_month)
        .select(F.max(PICKUP) - F.expr(f"INTERVAL {months} MONTHS")).scalar()
    )
    return (
        trips.filter(month_key >= year_month(cutoff))
        .withColumn("cutoff_date", cutoff)
        .filter(F.col(PICKUP) >= F.col("cutoff_date"))
        .withColumns({
            "pickup_month_number": F.month(PICKUP),
            "pickup_month_name": F.date_format(PICKUP, "MMMM"),
        })
    )


# --- reports ------------------------------------------------------------------------------

def monthly_counts(window: DataFrame) -> DataFrame:
    return window.groupBy("pickup_month_number").agg(F.count(F.lit(1)).alias("trips"))


def monthly_kpis(trips: DataFrame) -> DataFrame:
    """Revenue next to ride volume."""
    return trips.groupBy(F.year(PICKUP).alias("pickup_year"), F.month(PICKUP).alias("pickup_month")).agg(
        F.sum(money(F.col("fare_amount"))).alias("revenue"), F.count(F.lit(1)).alias("rides")
    )


def vendor_share(trips: DataFrame) -> DataFrame:
    """Rides and revenue per vendor, and the vendor's part of all rides.

    The total reads no column: Parquet row counts come from the file footers.
    """
    per_vendor = trips.groupBy("VendorID").agg(
        F.count(F.lit(1)).alias("rides"), F.sum(money(F.col("fare_amount"))).alias("revenue")
    )
    total = trips.select(F.count(F.lit(1))).scalar()
    return per_vendor.withColumn("ride_share", F.col("rides") / total)


def longest_trip(trips: DataFrame) -> DataFrame:
    """Largest duration in minutes, to show logging errors."""
    return trips.agg(F.max(_minutes()).alias("max_trip_minutes"))


def top_zones(trips: DataFrame, zone: str, count: int = fx.TOP_ZONES) -> DataFrame:
    """Busiest zones; the lower zone id wins a tie."""
    return trips.groupBy(zone).agg(F.count(F.lit(1)).alias("rides")).orderBy(F.desc("rides"), zone).limit(count)


def yields(trips: DataFrame) -> DataFrame:
    """Revenue per mile and per minute, as ratios of sums; NULL without any distance or time."""
    revenue = F.sum(money(F.col("fare_amount"))).cast("double")
    miles = F.sum(F.col("trip_distance").cast(EXACT)).cast("double")
    minutes = F.sum(_minutes()).cast("double")
    return trips.agg(
        F.try_divide(revenue, miles).alias("yield_per_mile"),
        F.try_divide(revenue, minutes).alias("yield_per_minute"),
    )


def _minutes():
    return F.timestamp_diff("MINUTE", F.col(PICKUP), F.col(DROPOFF))
