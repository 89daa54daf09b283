import datetime as dt

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from tallywork.operators import inference
from tallywork.session import shared_dir
from tallywork.sources.activity import arms, events
from tallywork.streaming import live

DDL = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def write(spark, folder, rows):
    made = [(i, t, u, k, v, "{}") for i, t, u, k, v in rows]
    spark.createDataFrame(made, DDL).coalesce(1).write.mode("append").parquet(f"{folder}/events.parquet")


def test_folder_of_files_and_late_rows(spark, tmp_path):
    """Append mode emits closed days only and drops rows older than the watermark."""
    day = lambda d, h=0: dt.datetime(2024, 1, d, h)
    folder = str(tmp_path)
    write(spark, folder, [(1, day(1, 5), 1, "view", 1.0), (2, day(1, 6), 2, "view", 2.0), (3, day(4), 1, "view", 1.0)])

    def run():
        counts = live.daily_counts(live.event_stream(spark, folder, late="1 day"))
        q = (
            counts.writeStream.outputMode("append").format("parquet").option("path", f"{folder}/out")
            .option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
        )
        q.awaitTermination()
        return {(r.day.day, r.n) for r in spark.read.parquet(f"{folder}/out").collect()}

    assert run() == {(1, 2)}
    write(spark, folder, [(4, day(1, 7), 3, "view", 9.0), (5, day(9), 1, "view", 1.0)])  # the first is too late
    assert run() == {(1, 2), (4, 1)}  # same checkpoint: goes on, nothing is counted twice


def test_stream_equals_batch(spark):
    got = live.settle(live.daily_counts(live.event_stream(spark, SMALL)), "t-days")
    want = events(spark, SMALL).groupBy("day", "kind").agg(
        F.count("*").alias("n"), F.sum(F.col("value").cast("decimal(15,2)")).alias("amount")
    )
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_looks_equal_batch(spark):
    got = live.settle(live.arm_counts(live.event_stream(spark, SMALL)), "t-looks", live.arm_looks)
    want = inference.sequential_looks(arms(events(spark, SMALL)), "day", "arm", "converted", "A", "B")
    assert [tuple(r) for r in got.orderBy("day").collect()] == [tuple(r) for r in want.orderBy("day").collect()]


def test_flags_are_stateless(spark):
    flagged = live.flag_readings(live.event_stream(spark, SMALL), live.sensor_baseline(events(spark, SMALL)))
    rows = live.drain(flagged, "t-flags")
    assert 0 < rows.count() < events(spark, SMALL).count()


def test_results_do_not_depend_on_the_session_zone(spark):
    def run(zone):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            days = live.settle(live.daily_counts(live.event_stream(spark, SMALL)), "t-zone").collect()
            weeks = live.settle(live.daily_counts(live.event_stream(spark, SMALL)), "t-zone", live.sliding_week).collect()
            return sorted(map(str, days)), sorted(map(str, weeks))
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")

    assert run("UTC") == run("Asia/Tokyo") == run("America/New_York")


def test_a_stream_without_events_gives_an_empty_frame(spark, tmp_path):
    folder = str(tmp_path)
    spark.createDataFrame([], DDL).write.parquet(f"{folder}/events.parquet")
    got = live.settle(live.daily_counts(live.event_stream(spark, folder)), "t-none")
    assert got.columns == ["day", "kind", "n", "amount"] and got.isEmpty()


def test_baseline_may_come_from_many_files(spark, tmp_path):
    folder = str(tmp_path)
    rows = [(i, dt.datetime(2024, 1, 1 + i % 20), i % 7, "view", float(i % 50)) for i in range(400)]
    for k in range(4):
        write(spark, folder, rows[k::4] + [(1000 + k, dt.datetime(2024, 1, 3), 1, "view", 1e4)])
    hours = live.hourly_flags(live.flag_readings(live.event_stream(spark, folder), live.sensor_baseline(events(spark, folder))))
    got = live.settle(hours, "t-hours").collect()
    assert [(r.machine_id, r.flags, r.highest) for r in got] == [("M-02", 4, 1e4)]


def test_shared_folder_is_the_one_the_session_names(spark):
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    a, b = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert a.startswith(named) and a != b


def test_every_window_of_the_week_counts_each_event(spark):
    got = live.settle(live.daily_counts(live.event_stream(spark, SMALL)), "t-week", live.sliding_week)
    assert got.agg(F.sum("n")).first()[0] == 7 * events(spark, SMALL).count()
    assert got.where(F.col("mean_value").isNull()).count() == 0
    assert pytest.approx(got.count(), abs=0) == got.select("first_day", "kind").distinct().count()


def test_replay_of_a_whole_table_loses_no_row(spark, tmp_path, monkeypatch):
    """Files out of time order in several batches: dropped rows are an error, not a smaller result."""
    from tallywork.plans.queries_streams import stream_closed_days

    monkeypatch.setattr(live, "FILES_PER_BATCH", 1)
    folder = str(tmp_path)
    for i, n in enumerate((1, 9, 10, 2, 12)):
        write(spark, folder, [(i, dt.datetime(2024, 1, n), 3, "view", 1.0)])
    with pytest.raises(ValueError, match="behind the watermark"):
        stream_closed_days(spark, folder)


def test_only_touched_days_are_rewritten(spark, tmp_path):
    """Three files in three batches, a late row, a replayed batch; no state."""
    day = lambda d, h=0: dt.datetime(2024, 1, d, h)
    folder, base = str(tmp_path), str(tmp_path / "kept")
    sums = {"n": F.count("*"), "amount": F.sum(F.col("value").cast("decimal(15,2)"))}

    def run():
        days = live.upkeep(live.event_stream(spark, folder), base, ["day", "kind"], sums, "day")
        return {(r.day.day, r.kind): (r.n, float(r.amount)) for r in days.collect()}

    def files():
        return {str(p.relative_to(base)) for p in (tmp_path / "kept" / "table").rglob("*.parquet")}

    write(spark, folder, [(1, day(1, 5), 1, "view", 1.0), (2, day(1, 6), 2, "click", 2.0), (3, day(4), 1, "view", 1.5)])
    assert run() == {(1, "view"): (1, 1.0), (1, "click"): (1, 2.0), (4, "view"): (1, 1.5)}
    before = files()
    write(spark, folder, [(4, day(9), 1, "view", 1.0)])
    run()
    assert before < files()  # the days of the first batch were left alone
    write(spark, folder, [(5, day(1, 7), 3, "view", 9.0), (6, day(4), 3, "error", 2.5)])  # the first is a week late
    want = {(1, "view"): (2, 10.0), (1, "click"): (1, 2.0), (4, "view"): (1, 1.5), (4, "error"): (1, 2.5), (9, "view"): (1, 1.0)}
    assert run() == want
    # the last batch runs once more, as after a driver that was lost before it could say that it was done
    commits = sorted((tmp_path / "kept" / "state" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    commits[-1].unlink()
    (commits[-1].parent / f".{commits[-1].name}.crc").unlink(missing_ok=True)
    assert run() == want
    assert not (tmp_path / "kept" / "state" / "state").exists()


def test_upkeep_of_an_empty_stream(spark, tmp_path):
    write(spark, str(tmp_path), [])
    days = live.upkeep(live.event_stream(spark, str(tmp_path)), str(tmp_path / "kept"), ["day", "kind"], {"n": F.count("*")}, "day")
    assert days.count() == 0 and days.columns == ["day", "kind", "n"]
