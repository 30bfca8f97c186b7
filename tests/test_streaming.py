"""Hours of a stream: closed by the watermark, written once, late rows without effect."""

import pytest
from pyspark.sql import functions as F

from helpers import series
from meterloom.operators import resample
from meterloom.streaming import slots

COLUMNS = "series_id string, ts timestamp, load_kwh double"


@pytest.fixture
def feed(spark, tmp_path):
    """A folder of input files, and a run over those that are new."""

    class Feed:
        folder = tmp_path

        def put(self, *rows, series_id="a"):
            series(spark, rows, ["load_kwh double"], series_id).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")

        def run(self):
            (tmp_path / "in").mkdir(exist_ok=True)
            sums = slots.slot_sums(spark.readStream.schema(COLUMNS).parquet(f"{tmp_path}/in"))
            slots.write_closed(sums, f"{tmp_path}/out").awaitTermination()
            return slots.read_closed(spark, f"{tmp_path}/out", sums)

        def batch(self):
            return spark.read.schema(COLUMNS).parquet(f"{tmp_path}/in")

    return Feed()


def hours(df):
    return {(r.series_id, r.ts.hour, r.ts.day): (r.total, r.n_known, r.n_rows) for r in df.collect()}


def test_hours_close_once_and_late_rows_change_nothing(feed):
    feed.put((0, 1.0), (15, 2.0), (59, None), (60, 4.0))
    assert hours(feed.run()) == {}  # latest stamp 01:00, two hours of delay: nothing is closed
    feed.put((30, 3.0), (180, 8.0))
    first = {("a", 0, 1): (6.0, 3, 4)}
    assert hours(feed.run()) == first  # 03:00 closes the hour that ends at 01:00, the row at 00:30 came in time
    assert hours(feed.run()) == first  # nothing new
    feed.put((45, 100.0), (400, 1.0))  # late for the first hour
    assert hours(feed.run()) == first | {("a", 1, 1): (4.0, 1, 1), ("a", 3, 1): (8.0, 1, 1)}


def test_empty_feed_and_rows_without_stamp(spark, feed):
    assert hours(feed.run()) == {}
    feed.put((0, None), (600, 1.0))
    spark.createDataFrame([("a", None, 5.0)], COLUMNS).write.mode("append").parquet(f"{feed.folder}/in")
    closed = feed.run()
    assert hours(closed) == {("a", 0, 1): (None, 0, 1)}
    assert slots.hourly_means(closed).count() == 0
    assert [tuple(r)[2:] for r in slots.day_totals(closed).collect()] == [(0.0, 0)]
    assert [tuple(r)[2:] for r in slots.day_totals(closed, "mean").collect()] == [(None, 0)]


def test_closed_hours_are_those_of_the_batch(feed):
    """Series with gaps over a clock change, in three runs; a last row far ahead closes all hours before it."""
    shift = 60 * 24 * 89  # 30 March 2024, a day before the clocks change
    for part in range(3):
        rows = [(shift + 15 * i, float(i % 7) if i % 5 else None) for i in range(96 * part, 96 * part + 96) if i % 11]
        feed.put(*rows)
        feed.put(*rows[::2], series_id="b")
        feed.run()
    feed.put((shift + 60 * 24 * 10, 1.0))
    closed = feed.run()
    batch = feed.batch().where(F.col("ts") < "2024-04-08")
    for got, wanted in (
        (slots.hourly_means(closed), resample.hourly_mean(batch)),
        (slots.day_totals(closed), resample.local_days(batch)),
        (slots.day_totals(closed, "mean"), resample.local_days(batch, how="mean")),
        (resample.complete_days(slots.day_totals(closed)), resample.complete_days(resample.local_days(batch))),
    ):
        def table(df):
            return sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.collect())

        assert table(got) == table(wanted)


def test_days_know_two_forms(spark):
    with pytest.raises(ValueError):
        slots.day_totals(slots.slot_sums(spark.createDataFrame([], COLUMNS)), "median")
