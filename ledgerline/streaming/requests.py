"""Streams of requests, readings and observations on Structured Streaming: day partitions, window counts, alerts, merges."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery
from pyspark.sql.window import Window

from ledgerline.operators import merge
from ledgerline.operators.derived import webhook_matches
from ledgerline.sources.jobs import with_revisions
from ledgerline.sources.store import BucketStore


def with_day(requests: DataFrame, delay: str = "1 day") -> DataFrame:
    """Events once each, with their UTC day as the partition column of the sink; later rows go to a batch reconciliation."""
    return requests.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["event_id"]).withColumn("day", F.to_date("ts"))


def write_days(requests: DataFrame, path: str, checkpoint: str, delay: str = "1 day") -> StreamingQuery:
    """Drain a stream into day partitions, and end. Each micro-batch has a folder of its own that a repeated batch overwrites:
    at least once from the source, once in the files."""

    def each(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").partitionBy("day").parquet(f"{path}/batch={number}")

    return with_day(requests, delay).writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def move_late_rows(spark: SparkSession, path: str, all_rows: DataFrame, run: str) -> DataFrame:
    """Rows that the stream left out as too late are moved into their day: what is in the raw log and in no partition yet, each
    event once, as the batch `run`, which must be new."""
    have = spark.read.parquet(path).select("event_id")
    missed = all_rows.dropDuplicates(["event_id"]).join(have, "event_id", "left_anti").withColumn("day", F.to_date("ts"))
    missed.write.partitionBy("day").parquet(f"{path}/batch={run}")
    return spark.read.parquet(path)


def minute_counters(requests: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Sliding 60-second counts by user, every 10 seconds."""
    w = F.window("ts", "60 seconds", "10 seconds")
    return requests.withWatermark("ts", delay).groupBy(w, "user_id").agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("start"), "user_id", "n")


def day_counters(requests: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Counts by user and UTC day."""
    w = F.window("ts", "1 day")
    return requests.withWatermark("ts", delay).groupBy(w, "user_id").agg(F.count(F.lit(1)).alias("n")).select(F.to_date("window.start").alias("day"), "user_id", "n")


def probe_tallies(probes: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Hourly count, failures, total and longest time by target."""
    w = F.window("ts", "1 hour")
    out = probes.withWatermark("ts", delay).groupBy(w, "target").agg(F.count(F.lit(1)).alias("n"), F.sum(F.when(F.col("ok"), 0).otherwise(1)).alias("failures"), F.sum("ms").alias("ms_total"), F.max("ms").alias("ms_max"))
    return out.select(F.col("window.start").alias("hour"), "target", "n", "failures", "ms_total", "ms_max")


def day_summary(tallies: DataFrame) -> DataFrame:
    """The last 24 hourly tallies of each target as one row: checks, failures, mean and longest time."""
    newest = F.max("hour").over(Window.partitionBy("target"))
    j = tallies.withColumn("newest", newest).filter(F.col("hour") > F.col("newest") - F.expr("interval 24 hours"))
    return j.groupBy("target").agg(F.sum("n").alias("n"), F.sum("failures").alias("failures"), (F.sum("ms_total") / F.sum("n")).alias("ms_mean"), F.max("ms_max").alias("ms_max"))


#: How long a key without news is remembered.
KEEP_S = 30 * 24 * 3600


class _Keyed(StatefulProcessor):
    """Takes each key's rows in the order of their time. advance(key, row, state) -> (new state, output row or None), where
    state is None for a key that is new or forgotten. A row from before the last one taken is left out, as what came after it
    is decided; a key without rows for keep_s, by the watermark, is forgotten."""

    def __init__(self, advance, fields: str, out: list[str], keep_s: int):
        self.advance, self.fields, self.out, self.keep_ms = advance, fields, out, 1000 * keep_s

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", f"last_ms long, {self.fields}")

    def handleInputRows(self, key, rows, timerValues):
        last, state = None, None
        if self.state.exists():
            last, *state = self.state.get()
            self.handle.deleteTimer(last + self.keep_ms)
        out = []
        for row in pd.concat(list(rows)).sort_values("ts", kind="stable").itertuples(index=False):
            ms = row.ts.value // 1_000_000
            if last is not None and ms < last:
                continue
            last = ms
            state, said = self.advance(key[0], row, state)
            if said is not None:
                out.append(said)
        if last is not None:
            self.state.update((last, *(state or [None] * self.fields.count(" "))))
            self.handle.registerTimer(last + self.keep_ms)
        yield pd.DataFrame(out, columns=self.out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        if self.state.exists() and self.state.get()[0] + self.keep_ms <= expiredTimerInfo.getExpiryTimeInMs():
            self.state.clear()
        yield pd.DataFrame([], columns=self.out)

    def close(self) -> None:
        pass


def _by_key(df: DataFrame, key: str, advance, fields: str, out: str, keep_s: int, delay: str) -> DataFrame:
    """Stateful rows by key with timers, which need the RocksDB state store: set here where the session has the default one."""
    conf, name = df.sparkSession.conf, "spark.sql.streaming.stateStore.providerClass"
    if conf.get(name).endswith("HDFSBackedStateStoreProvider"):
        conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    columns = [c.split()[0] for c in out.split(", ")]
    processor = _Keyed(advance, fields, columns, keep_s)
    return df.withWatermark("ts", delay).groupBy(key).transformWithStateInPandas(processor, out, "append", "eventTime")


def consecutive_failures(probes: DataFrame, after: int = 2, quiet_s: int = 6 * 3600, keep_s: int = KEEP_S, delay: str = "1 hour") -> DataFrame:
    """probes (target, ts, ok) -> an alert at the second failure in a row and not again for six hours while it lasts; a success
    resets both the row of failures and the quiet time, so that a new outage alerts at once. A probe without a result is
    none. Rows are taken as in _Keyed."""

    def advance(key, r, state):
        row, alerted = state or (0, None)
        if r.ok is None or pd.isna(r.ok):
            return state, None
        if r.ok:
            return (0, None), None
        now = r.ts.timestamp()
        if row + 1 >= after and (alerted is None or now - alerted >= quiet_s):
            return (row + 1, now), (key, r.ts, row + 1)
        return (row + 1, alerted), None

    return _by_key(probes, "target", advance, "row long, alerted double", "target string, ts timestamp, failures long", keep_s, delay)


def alert_throttle(states: DataFrame, ttl_s: int = 24 * 3600, delay: str = "1 hour") -> DataFrame:
    """states (key, ts, stale) -> alerts: the first stale reading of a key, and again only after the time to live; a fresh
    reading clears the key, so that its next lapse alerts at once. A key without readings for the time to live is forgotten,
    which changes no alert. Null says nothing. Rows are taken as in _Keyed."""

    def advance(key, r, state):
        (alerted,) = state or (None,)
        if r.stale is None or pd.isna(r.stale):
            return state, None
        if not r.stale:
            return (None,), None
        now = r.ts.timestamp()
        if alerted is None or now - alerted >= ttl_s:
            return (now,), (key, r.ts)
        return (alerted,), None

    return _by_key(states, "key", advance, "alerted double", "key string, ts timestamp", ttl_s, delay)


def change_points(readings: DataFrame, tolerance: float = 1e-9, keep_s: int = KEEP_S, delay: str = "1 hour") -> DataFrame:
    """readings (key, ts, value) -> only those whose value differs from the key's last one. A null is no reading: it passes
    nothing and changes nothing. After keep_s without a reading the next one passes as a first one. Rows as in _Keyed."""

    def advance(key, r, state):
        (last,) = state or (None,)
        if pd.isna(r.value):
            return state, None
        if last is None or abs(r.value - last) > tolerance:
            return (r.value,), (key, r.ts, r.value)
        return (last,), None

    return _by_key(readings, "key", advance, "last double", "key string, ts timestamp, value double", keep_s, delay)


def stream_merge(incoming: DataFrame, catalog: DataFrame, store: BucketStore, checkpoint: str, today: Column | None = None) -> StreamingQuery:
    """Each micro-batch of (point, value, seq) through duplicates, gates and the merge with revisions into a store of
    observations (jobs.observation_store). Only the buckets of the batch's series are read and written again, and a batch
    that comes again changes nothing."""

    def each(batch: DataFrame, number: int) -> None:
        batch = batch.persist()

        def apply(stored: DataFrame, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
            last = merge.dedupe_last(rows, merge.POINT, "seq")
            judged = merge.validate(last, catalog, merge.latest_value(last, stored), F.current_date() if today is None else today)
            return with_revisions(stored, judged.filter("reason is null"), F.current_timestamp())

        store.merge(batch, number, apply)
        batch.unpersist()

    return incoming.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def notify_updates(updates: DataFrame, hooks: DataFrame, catalog: DataFrame, latest: Callable[[], DataFrame], deliver: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Payload rows for the subscribers of updated series and modules, each subscriber and series once a batch."""

    def each(batch: DataFrame, number: int) -> None:
        deliver(webhook_matches(batch, hooks, catalog, latest()), number)

    return updates.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def rollup_stream(requests: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Usage by day, route and status class as it comes in: count, approximate percentiles of the time and different users."""
    w = F.window("ts", "1 day")
    g = requests.withWatermark("ts", delay).groupBy(w, "route", (F.col("status") / 100).cast("int").alias("status_class"))
    out = g.agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("ms", [0.5, 0.95]).alias("p"), F.approx_count_distinct("user_id").alias("users"))
    return out.select(F.to_date("window.start").alias("day"), "route", "status_class", "n", F.col("p")[0].alias("p50"), F.col("p")[1].alias("p95"), "users")
