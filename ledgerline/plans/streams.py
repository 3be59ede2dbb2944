"""Queries that drain a stream of the given events, each with the SQL of the batch result it must agree with."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.plans import adapters as A
from ledgerline.plans.registry import query, rounded
from ledgerline.session import scratch_dir
from ledgerline.sources import jobs
from ledgerline.sources.tables import read_table
from ledgerline.streaming import requests as R


def _stream(rows: DataFrame) -> DataFrame:
    """Rows written as files and read as a stream; times of day without a zone are taken in the session's."""
    folder = scratch_dir(rows.sparkSession)
    rows = rows.withColumn("ts", F.col("ts").cast("timestamp")) if "ts" in rows.columns else rows
    rows.write.parquet(folder)
    return rows.sparkSession.readStream.schema(rows.schema).parquet(folder)


def _drained(stream: DataFrame, mode: str) -> DataFrame:
    """What a stream gives until its source is empty: every batch of an appending one, the last of one that is complete."""
    folder = scratch_dir(stream.sparkSession)

    def each(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/rows/batch={number if mode == 'append' else 0}")

    stream.writeStream.foreachBatch(each).outputMode(mode).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{folder}/rows").select(*stream.columns)


@query(f"WITH {A.LOG} SELECT day, count(*) AS n, count(DISTINCT event_id) AS events FROM log GROUP BY 1")
def stream_requests(spark, d):
    """Every event once in its day's partition, also where the source repeats some."""
    log, folder = A.request_log(spark, d), scratch_dir(spark)
    R.write_days(_stream(log.unionByName(log.filter("event_id % 9 = 0"))), f"{folder}/days", f"{folder}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{folder}/days").groupBy("day").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("event_id").alias("events"))


@query(f"WITH {A.LOG} SELECT day, count(*) AS n FROM log GROUP BY 1")
def stream_late_rows(spark, d):
    """Rows that a stream never saw, moved into their day."""
    log, folder = A.request_log(spark, d), scratch_dir(spark)
    R.write_days(_stream(log.filter("event_id % 5 <> 2")), f"{folder}/days", f"{folder}/checkpoint").awaitTermination()
    return R.move_late_rows(spark, f"{folder}/days", log.withColumn("ts", F.col("ts").cast("timestamp")), "late").groupBy("day").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {A.LOG} SELECT day, user_id, count(*) AS n FROM log GROUP BY 1, 2")
def stream_day_counters(spark, d):
    return _drained(R.day_counters(_stream(A.request_log(spark, d)), "30 days"), "complete")


@query(f"WITH {A.LOG} SELECT time_bucket(INTERVAL 10 SECOND, ts) - to_seconds(10 * k) AS start, user_id, count(*) AS n FROM log, range(6) r(k) GROUP BY 1, 2")
def stream_minute_counters(spark, d):
    return _drained(R.minute_counters(_stream(A.request_log(spark, d)), "30 days"), "complete")


_PROBES = "probes AS (SELECT 't' || CAST(user_id % 5 AS VARCHAR) AS target, ts, CASE WHEN event_id % 11 <> 0 THEN event_id % 3 <> 0 END AS ok, value AS ms, event_id FROM events)"


def _probes(spark, d):
    e, n = read_table(spark, d, "events"), F.col("event_id")
    return e.select(F.concat(F.lit("t"), (F.col("user_id") % 5).cast("string")).alias("target"), "ts", F.when(n % 11 != 0, n % 3 != 0).alias("ok"), F.col("value").alias("ms"), "event_id")


@query(f"WITH {_PROBES} SELECT date_trunc('hour', ts) AS hour, target, count(*) AS n, count(*) FILTER (ok IS NOT true) AS failures, round(sum(ms), 4) AS ms_total, max(ms) AS ms_max FROM probes GROUP BY 1, 2")
def stream_probe_tallies(spark, d):
    return rounded(_drained(R.probe_tallies(_stream(_probes(spark, d)), "30 days"), "complete"), "ms_total", digits=4)


@query(f"""WITH RECURSIVE {_PROBES}, p AS (SELECT *, row_number() OVER (PARTITION BY target ORDER BY ts) AS n FROM probes WHERE ok IS NOT NULL),
w AS (SELECT target, n, ts, CASE WHEN ok THEN 0 ELSE 1 END AS row, CAST(NULL AS TIMESTAMP) AS alerted, false AS said FROM p WHERE n = 1 UNION ALL
SELECT p.target, p.n, p.ts, CASE WHEN ok THEN 0 ELSE w.row + 1 END, CASE WHEN ok THEN NULL WHEN x.says THEN p.ts ELSE w.alerted END, x.says FROM w JOIN p ON p.target = w.target AND p.n = w.n + 1,
LATERAL (SELECT NOT p.ok AND w.row + 1 >= 2 AND (w.alerted IS NULL OR epoch_us(p.ts) - epoch_us(w.alerted) >= 21600000000) AS says) x)
SELECT target, ts, CAST(row AS BIGINT) AS failures FROM w WHERE said""")
def stream_consecutive_failures(spark, d):
    return _drained(R.consecutive_failures(_stream(_probes(spark, d))), "append")


@query(f"""WITH RECURSIVE {_PROBES}, p AS (SELECT target AS key, ts, NOT ok AS stale, row_number() OVER (PARTITION BY target ORDER BY ts) AS n FROM probes WHERE ok IS NOT NULL),
w AS (SELECT key, n, ts, CASE WHEN stale THEN ts END AS alerted, stale AS said FROM p WHERE n = 1 UNION ALL
SELECT p.key, p.n, p.ts, CASE WHEN NOT stale THEN NULL WHEN x.says THEN p.ts ELSE w.alerted END, x.says FROM w JOIN p ON p.key = w.key AND p.n = w.n + 1,
LATERAL (SELECT p.stale AND (w.alerted IS NULL OR epoch_us(p.ts) - epoch_us(w.alerted) >= 3600000000) AS says) x) SELECT key, ts FROM w WHERE said""")
def stream_alert_throttle(spark, d):
    return _drained(R.alert_throttle(_stream(_probes(spark, d).select(F.col("target").alias("key"), "ts", (~F.col("ok")).alias("stale"))), 3600), "append")


@query(f"""WITH {_PROBES}, v AS (SELECT target AS key, ts, CASE WHEN event_id % 4 = 0 THEN CAST(floor(ms / 5) AS DOUBLE) ELSE 1.0 END AS value FROM probes WHERE event_id % 7 <> 0), l AS (SELECT *, lag(value) OVER (PARTITION BY key ORDER BY ts) AS was FROM v)
SELECT key, ts, value FROM l WHERE was IS NULL OR was <> value""")
def stream_change_points(spark, d):
    n = F.col("event_id")
    value = F.when(n % 7 != 0, F.when(n % 4 == 0, F.floor(F.col("ms") / 5).cast("double")).otherwise(1.0))
    return _drained(R.change_points(_stream(_probes(spark, d).select(F.col("target").alias("key"), "ts", value.alias("value")))), "append")


@query("""WITH r AS (SELECT event_type AS series_id, CAST(ts AS DATE) AS obs_date, '{}' AS dims_key, value, row_number() OVER (PARTITION BY event_type, CAST(ts AS DATE) ORDER BY event_id DESC) AS rn FROM events) SELECT series_id, obs_date, dims_key, value FROM r WHERE rn = 1 AND value <= 60""")
def stream_merge(spark, d):
    """A stream merged into a bucketed store, and once more from the beginning, which changes nothing."""
    e = read_table(spark, d, "events").select(F.col("event_type").alias("series_id"), F.to_date("ts").alias("obs_date"), F.lit("{}").alias("dims_key"), "value", F.col("event_id").alias("seq"))
    catalog = e.select("series_id").distinct().select("series_id", F.lit(0.0).alias("min_value"), F.lit(60.0).alias("max_value"), F.lit(None).cast("double").alias("max_step"))
    store, source = jobs.observation_store(spark, scratch_dir(spark), 16), _stream(e)
    for _ in range(2):
        R.stream_merge(source, catalog, store, scratch_dir(spark)).awaitTermination()
    return store.read().select("series_id", "obs_date", "dims_key", "value")


@query(f"WITH {A.CATALOG}, u AS (SELECT DISTINCT series_id, module FROM catalog WHERE is_active) SELECT 1 AS hook_id, series_id FROM u WHERE series_id = 'Brand#12' UNION ALL SELECT 2, series_id FROM u WHERE module = 'module_1'")
def stream_notify_updates(spark, d):
    catalog = A.catalog(spark, d)
    hooks = spark.createDataFrame([(1, "Brand#12", None), (2, None, "module_1"), (3, "none", None)], "hook_id int, series_id string, module string")
    updates, folder = catalog.filter("is_active").select("series_id"), scratch_dir(spark)
    latest = lambda: catalog.select("series_id", F.lit(1.0).alias("value"))
    deliver = lambda df, n: df.select("hook_id", "series_id").write.mode("overwrite").parquet(f"{folder}/out/batch={n}")
    R.notify_updates(_stream(updates.unionByName(updates)), hooks, catalog, latest, deliver, f"{folder}/checkpoint").awaitTermination()
    return spark.read.schema("hook_id int, series_id string").parquet(f"{folder}/out").select("hook_id", "series_id")


@query(f"WITH {A.LOG} SELECT day, route, CAST(status // 100 AS INTEGER) AS status_class, count(*) AS n, true AS in_order FROM log GROUP BY 1, 2, 3")
def stream_rollup(spark, d):
    out = _drained(R.rollup_stream(_stream(A.request_log(spark, d)), "30 days"), "complete")
    return out.select("day", "route", "status_class", "n", ((F.col("users") >= 1) & (F.col("p50") <= F.col("p95"))).alias("in_order"))
