import datetime as dt

from pyspark.sql import functions as F

from gridtally.functions.dates import trailing_days, weekly_window, window_bounds


# Written out by hand from a calendar, for Monday 15 to Sunday 21 January 2024:
# first and last day of each variant's window.
WINDOWS = {
    15: {"kpi": ("20240108", "20240114"), "enb": ("20240113", "20240115"),
         "gnb": ("20240114", "20240115")},
    16: {"kpi": ("20240108", "20240114"), "enb": ("20240113", "20240116"),
         "gnb": ("20240114", "20240116")},
    17: {"kpi": ("20240108", "20240114"), "enb": ("20240113", "20240117"),
         "gnb": ("20240114", "20240117")},
    18: {"kpi": ("20240108", "20240114"), "enb": ("20240113", "20240118"),
         "gnb": ("20240114", "20240118")},
    19: {"kpi": ("20240108", "20240114"), "enb": ("20240113", "20240119"),
         "gnb": ("20240114", "20240119")},
    20: {"kpi": ("20240108", "20240114"), "enb": ("20240113", "20240119"),
         "gnb": ("20240114", "20240120")},
    21: {"kpi": ("20240108", "20240114"), "enb": ("20240113", "20240119"),
         "gnb": ("20240114", "20240120")},
}


def test_weekly_windows_every_weekday(spark):
    for day, by_variant in WINDOWS.items():
        today = dt.date(2024, 1, day)
        for variant, (first, last) in by_variant.items():
            assert window_bounds(today, variant) == (first, last), (today, variant)
            got = spark.range(1).select(weekly_window(today, variant).alias("w")).first().w
            span = dt.datetime.strptime(last, "%Y%m%d") - dt.datetime.strptime(first, "%Y%m%d")
            assert [got[0].strftime("%Y%m%d"), got[-1].strftime("%Y%m%d")] == [first, last]
            assert len(got) == span.days + 1


def test_trailing_days(spark):
    got = spark.range(1).select(trailing_days("2024-01-17", 9).alias("d")).first().d
    assert got[0] == dt.date(2024, 1, 9) and got[-1] == dt.date(2024, 1, 17) and len(got) == 9


def test_window_as_column(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 17),)], "d date")
    got = df.select(F.size(weekly_window(F.col("d"), "enb"))).first()[0]
    assert got == 5  # Sat 13th .. Wed 17th, never past as_of
