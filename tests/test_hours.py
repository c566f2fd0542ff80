import datetime as dt

from pyspark.sql import functions as F

from eventmill.functions.hours import hour_grid, hour_key, hour_path, path_hour, trailing_window, utc


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def hours(spark, start, end):
    return [r.hour for r in hour_grid(spark, start, end).orderBy("hour").collect()]


def test_path_and_key_have_an_unpadded_hour(spark):
    hour = utc(dt.datetime(2026, 8, 6, 9))
    assert one(spark, hour_path(hour)) == "raw/2026/08/06/9.json.gz"
    assert one(spark, hour_key(hour)) == "2026-08-06-9.json.gz"


def test_path_round_trip(spark):
    grid = hour_grid(spark, dt.datetime(2024, 2, 28, 22), dt.datetime(2024, 3, 1, 2))
    back = grid.select("hour", path_hour(hour_path(F.col("hour"), "/x/raw")).alias("back"))
    assert back.where("hour <> back or back is null").count() == 0
    assert one(spark, path_hour(F.lit("raw/2024/01/02/readme.txt"))) is None


def test_grid_is_half_open_and_cut_to_the_hour(spark):
    got = hours(spark, dt.datetime(2024, 1, 1, 0, 59), dt.datetime(2024, 1, 1, 3, 30))
    assert got == [dt.datetime(2024, 1, 1, h) for h in (0, 1, 2)]


def test_empty_and_reversed_grids(spark):
    noon = dt.datetime(2024, 1, 1, 12)
    assert hours(spark, noon, noon) == []
    assert hours(spark, noon, noon - dt.timedelta(hours=5)) == []


def test_zoned_bounds_are_taken_in_utc(spark):
    zone = dt.timezone(dt.timedelta(hours=2))
    got = hours(spark, dt.datetime(2024, 1, 1, 2, tzinfo=zone), dt.datetime(2024, 1, 1, 3, tzinfo=zone))
    assert got == [dt.datetime(2024, 1, 1, 0)]


def test_trailing_window(spark):
    start, end = trailing_window(dt.datetime(2024, 1, 3, 3, 20))
    assert (start, end) == (dt.datetime(2024, 1, 2, 1, 20), dt.datetime(2024, 1, 3, 1, 20))
    assert len(hours(spark, start, end)) == 24
    assert trailing_window(end, hours=3)[0] == end - dt.timedelta(hours=5)
