from datetime import date, datetime

from pyspark.sql import functions as F

from tierflow import fixed_values as fx
from tierflow.functions import columns as fn


def values(spark, expression, inputs, dtype):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, x {dtype}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("x"))).collect()]


def test_age_groups_at_their_edges(spark):
    got = values(spark, fn.age_group, [17, 18, 64, 65, None], "int")
    assert got == ["Pediatric", "Adult", "Adult", "Geriatric", "Unknown"]


def test_age_is_the_difference_of_years_and_unknown_for_the_sentinel(spark):
    as_of = F.lit("2026-01-01").cast("date")
    born = [date(2008, 12, 31), date(1900, 1, 1), None]
    assert values(spark, lambda c: fn.age_in_years(c, as_of), born, "date") == [18, None, None]


def test_value_segments_at_their_edges(spark):
    got = values(spark, lambda c: fn.value_segment(c.cast("decimal(18,2)")),
                 ["99999.99", "100000", "499999.99", "500000", None], "string")
    assert got == ["LOW_VALUE", "MEDIUM_VALUE", "MEDIUM_VALUE", "HIGH_VALUE", "LOW_VALUE"]


def test_stay_days_only_lift_zero(spark):
    t = datetime(2021, 7, 2, 14, 46)
    df = spark.createDataFrame(
        [(0, t, datetime(2021, 7, 2, 23, 0)), (1, t, datetime(2021, 7, 3, 0, 1)),
         (2, t, datetime(2021, 6, 30, 1, 0)), (3, t, None)], "i int, a timestamp, d timestamp")
    got = [r[0] for r in df.orderBy("i").select(fn.stay_days(F.col("a"), F.col("d"))).collect()]
    assert got == [1, 1, -2, None]


def test_padded_and_fractional_timestamps(spark):
    got = values(spark, lambda c: fn.parse_timestamp(c, fx.DISCHARGE_FORMAT),
                 ["Jul  2 2021  2:46PM", "Jul 12 2021 12:00AM", "garbage", "", None], "string")
    assert got == [datetime(2021, 7, 2, 14, 46), datetime(2021, 7, 12, 0, 0), None, None, None]
    got = values(spark, lambda c: fn.parse_timestamp(c, fx.ADMISSION_FORMAT),
                 ["2021-07-02 14:46:00.1234567", "2021-07-02"], "string")
    assert got == [datetime(2021, 7, 2, 14, 46, 0, 123456), None]


def test_birth_dates(spark):
    unknown = date(1900, 1, 1)
    got = values(spark, fn.birth_date, ["7/4/1980 0:00", "  12/31/1999 ", "1980-07-04", "", None], "string")
    assert got == [date(1980, 7, 4), date(1999, 12, 31), unknown, unknown, unknown]


def test_first_matching_date_format(spark):
    got = values(spark, lambda c: fn.parse_date(c, ("M/d/yyyy", "yyyy-MM-dd")),
                 ["4/1/2010", "2010-04-01", "2010/04/01"], "string")
    assert got == [date(2010, 4, 1), date(2010, 4, 1), None]


def test_count_if_of_no_rows_is_null(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "x string")
    assert df.agg(fn.count_if(F.col("x") == "a")).first()[0] == 1
    assert df.filter("x = 'z'").agg(fn.count_if(F.col("x") == "a")).first()[0] is None
