"""Streaming jobs on file streams, with the batch results they must agree with."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerline.sources import jobs
from ledgerline.streaming import requests as R

START = dt.datetime(2024, 1, 1)


def at(minutes):
    return START + dt.timedelta(minutes=minutes)


def stream(spark, folder, batches, schema):
    """A file stream that takes one file a batch, in order."""
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}/b{i}")
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/b*")


def drained(df, tmp_path, name, mode="append"):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
    q.awaitTermination()
    return df.sparkSession.table(name)


REQUESTS = "event_id long, ts timestamp, user_id string, route string, status int, ms double"


def test_days_hold_each_event_once_and_late_rows_follow(spark, tmp_path):
    one = [(1, at(0), "a", "/x", 200, 1.0), (2, at(60 * 23 + 59), "a", "/x", 200, 1.0), (1, at(0), "a", "/x", 200, 1.0)]
    two = [(2, at(60 * 23 + 59), "a", "/x", 200, 1.0), (3, at(60 * 24 * 5), "b", "/x", 500, 3.0)]
    three = [(4, at(60 * 24 * 9), "b", "/x", 500, 3.0)]
    late = [(5, at(10), "c", "/y", 200, 2.0), (5, at(10), "c", "/y", 200, 2.0)]
    source = stream(spark, str(tmp_path / "in"), [one, two, three, late], REQUESTS)
    R.write_days(source, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r.event_id for r in out.collect()) == [1, 2, 3, 4]
    raw = spark.read.schema(REQUESTS).parquet(str(tmp_path / "in") + "/b*")
    whole = R.move_late_rows(spark, str(tmp_path / "out"), raw, "late-1")
    assert sorted((r.event_id, r.day) for r in whole.filter("day = DATE '2024-01-01'").collect()) == [(i, dt.date(2024, 1, 1)) for i in (1, 2, 5)] and whole.count() == 5


def test_counters_and_rollup_equal_the_batch(spark, tmp_path):
    rows = [(i, at(i * 7 % 1440), "ab"[i % 2], f"/{i % 3}", 200 + 100 * (i % 3), float(i)) for i in range(60)]
    source = stream(spark, str(tmp_path / "in"), [rows[:30], rows[30:]], REQUESTS)
    days = {(r.user_id, str(r.day)): r.n for r in drained(R.day_counters(source, "3 days"), tmp_path, "days", "update").collect()}
    assert days == {("a", "2024-01-01"): 30, ("b", "2024-01-01"): 30}
    got = drained(R.rollup_stream(source, "3 days"), tmp_path, "rollup", "complete").collect()
    batch = spark.createDataFrame(rows, REQUESTS).groupBy("route", (F.col("status") / 100).cast("int").alias("c")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("user_id").alias("u")).collect()
    assert sorted((r.route, r.status_class, r.n, r.users) for r in got) == sorted((r.route, r.c, r.n, r.u) for r in batch)
    sliding = drained(R.minute_counters(source, "3 days"), tmp_path, "sliding", "complete")
    assert sliding.agg(F.sum("n")).first()[0] == 6 * 60


PROBES = "target string, ts timestamp, ok boolean, ms double"


def test_probe_tallies_and_day_summary(spark, tmp_path):
    rows = [("t", at(5 * i), i % 4 != 0, float(i)) for i in range(24)]
    source = stream(spark, str(tmp_path / "in"), [rows], PROBES)
    tallies = drained(R.probe_tallies(source, "1 day"), tmp_path, "tallies", "complete")
    assert [(r.n, r.failures, r.ms_max) for r in tallies.orderBy("hour").collect()] == [(12, 3, 11.0), (12, 3, 23.0)]
    r = R.day_summary(tallies).first()
    assert (r.n, r.failures, r.ms_mean, r.ms_max) == (24, 6, 11.5, 23.0)


def test_a_success_resets_failures_and_quiet_time(spark, tmp_path):
    batches = [[("t", at(0), False, 1.0), ("t", at(5), False, 1.0)], [("t", at(10), False, 1.0), ("t", at(15), True, 1.0)], [("t", at(25), False, 1.0), ("t", at(20), False, 1.0)], [("t", at(400), False, 1.0), ("u", at(1), False, 1.0)]]
    got = drained(R.consecutive_failures(stream(spark, str(tmp_path / "in"), batches, PROBES)), tmp_path, "failures")
    assert sorted((r.target, r.ts, r.failures) for r in got.collect()) == [("t", at(5), 2), ("t", at(25), 2), ("t", at(400), 3)]


def test_alerts_are_throttled_until_fresh(spark, tmp_path):
    batches = [[("k", at(0), True), ("k", at(10), True)], [("k", at(20), False), ("k", at(30), True)], [("k", at(30 + 1440), True)]]
    got = drained(R.alert_throttle(stream(spark, str(tmp_path / "in"), batches, "key string, ts timestamp, stale boolean")), tmp_path, "alerts")
    assert sorted(r.ts for r in got.collect()) == [at(0), at(30), at(30 + 1440)]


def test_only_changes_pass(spark, tmp_path):
    batches = [[("k", at(0), 1.0), ("k", at(2), 1.0)], [("k", at(3), 2.0), ("j", at(1), 1.0)], [("k", at(4), 2.0 + 1e-12), ("k", at(5), 1.0)]]
    got = drained(R.change_points(stream(spark, str(tmp_path / "in"), batches, "key string, ts timestamp, value double")), tmp_path, "changes")
    assert sorted((r.key, r.ts, r.value) for r in got.collect()) == [("j", at(1), 1.0), ("k", at(0), 1.0), ("k", at(3), 2.0), ("k", at(5), 1.0)]


def test_keys_without_news_are_forgotten(spark, tmp_path):
    day = 1440
    batches = [[("k", at(0), 1.0), ("other", at(0), 1.0)], [("other", at(40 * day), 2.0)], [("other", at(41 * day), 2.0)], [("k", at(42 * day), 1.0)], [("k", at(43 * day), 1.0)]]
    got = drained(R.change_points(stream(spark, str(tmp_path / "in"), batches, "key string, ts timestamp, value double")), tmp_path, "forgotten")
    assert sorted((r.key, r.ts) for r in got.collect()) == [("k", at(0)), ("k", at(42 * day)), ("other", at(0)), ("other", at(40 * day))]


def test_null_readings_and_late_rows_change_nothing(spark, tmp_path):
    batches = [[("k", at(0), 1.0), ("k", at(1), None)], [("k", at(20), 2.0), ("j", at(0), None)], [("k", at(10), 7.0), ("k", at(25), 2.0)], [("k", at(30), 1.0), ("j", at(30), 4.0)]]
    got = drained(R.change_points(stream(spark, str(tmp_path / "in"), batches, "key string, ts timestamp, value double")), tmp_path, "nulls")
    assert sorted((r.key, r.ts, r.value) for r in got.collect()) == [("j", at(30), 4.0), ("k", at(0), 1.0), ("k", at(20), 2.0), ("k", at(30), 1.0)]
    batches = [[("t", at(0), False, 1.0), ("t", at(5), None, 1.0)], [("t", at(10), False, 1.0)], [("t", at(7), True, 1.0), ("t", at(12), False, 1.0)]]
    got = drained(R.consecutive_failures(stream(spark, str(tmp_path / "in2"), batches, PROBES)), tmp_path, "late")
    assert [(r.ts, r.failures) for r in got.collect()] == [(at(10), 2)]


CATALOG = "series_id string, min_value double, max_value double, max_step double"


def test_merge_keeps_revisions_over_batches(spark, tmp_path):
    day, next_day = dt.date(2020, 1, 31), dt.date(2020, 2, 29)
    schema = "series_id string, obs_date date, dims_key string, value double, seq long"
    batches = [
        [("a", day, "{}", 1.0, 1), ("a", day, "{}", 2.0, 2), ("no", day, "{}", 1.0, 3), ("c", day, '{"x":"1","y":"2"}', 1.0, 9)],
        [("a", day, "{}", 3.0, 4), ("b", day, "{}", 99.0, 5)],
        [("a", day, "{}", 3.0, 6), ("c", next_day, '{"x":"1"}', 8.0, 7), ("c", next_day, '{"y":"3"}', 8.0, 8)],
    ]
    catalog = spark.createDataFrame([(s, 0.0, 10.0, 5.0) for s in "abc"], CATALOG)
    store = jobs.observation_store(spark, str(tmp_path / "store"), 8)
    source = stream(spark, str(tmp_path / "in"), batches, schema)
    R.stream_merge(source, catalog, store, str(tmp_path / "cp")).awaitTermination()
    assert store.batches() == [0, 1, 2]
    assert sorted((r.series_id, r.dims_key, r.value, r.flagged) for r in store.read().collect()) == [("a", "{}", 3.0, False), ("c", '{"x":"1","y":"2"}', 1.0, False), ("c", '{"x":"1"}', 8.0, True), ("c", '{"y":"3"}', 8.0, False)]
    assert [(r.series_id, r.value) for r in store.log().collect()] == [("a", 2.0)]


def test_a_batch_rewrites_its_buckets_once(spark, tmp_path):
    schema = "series_id string, obs_date date, dims_key string, value double, flagged boolean"
    day = dt.date(2020, 1, 31)
    rows = lambda *pairs: spark.createDataFrame([(s, day, "{}", v, f) for s, v, f in pairs], schema)
    store = jobs.observation_store(spark, str(tmp_path / "store"), 16)
    add = lambda df, n: store.merge(df, n, lambda old, new: jobs.with_revisions(old, new, F.current_timestamp()))
    assert add(rows(*[(f"s{i}", 1.0, False) for i in range(40)]), 0)
    before = store.current()
    files = lambda: {p: p.stat().st_mtime_ns for p in (tmp_path / "store").rglob("*.parquet")}
    kept = files()
    assert add(rows(("s1", 2.0, False), ("s2", 1.0, True)), 1)
    after = store.current()
    assert {b for b in after if after[b] != before[b]} == {b for b in after if after[b] == 1} and 1 <= sum(n == 1 for n in after.values()) <= 2
    assert kept.items() <= files().items()
    stamps = {r.series_id: (r.value, r.flagged, r.revised_at) for r in store.read().collect()}
    old = {r.series_id: r.revised_at for r in spark.read.parquet(str(tmp_path / "store/rows/batch=0")).collect()}
    assert len(stamps) == 40 and stamps["s2"] == (1.0, True, old["s2"]) and stamps["s1"][2] > old["s1"]
    seen = files()
    assert not add(rows(("s1", 9.0, False)), 1) and files() == seen and [r.value for r in store.log().collect()] == [1.0]
    (tmp_path / "store/rows/batch=2/bucket=0").mkdir(parents=True)  # what a broken run left behind
    assert add(rows(("s1", 3.0, False)), 2) and {r.value for r in store.read().filter("series_id = 's1'").collect()} == {3.0}


def test_updates_reach_subscribers_once(spark, tmp_path):
    hooks = spark.createDataFrame([(1, "a", None), (1, None, "m"), (2, None, "m"), (3, "z", None)], "hook_id long, series_id string, module string")
    catalog = spark.createDataFrame([("a", "m"), ("b", "n")], "series_id string, module string")
    latest = spark.createDataFrame([("a", 5.0)], "series_id string, value double")
    got = []
    R.notify_updates(stream(spark, str(tmp_path / "in"), [[("a",), ("a",), ("b",)]], "series_id string"), hooks, catalog, lambda: latest, lambda df, n: got.extend((r.hook_id, r.series_id, r.value) for r in df.collect()), str(tmp_path / "cp")).awaitTermination()
    assert sorted(got) == [(1, "a", 5.0), (2, "a", 5.0)]


@pytest.fixture(autouse=True)
def few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)
