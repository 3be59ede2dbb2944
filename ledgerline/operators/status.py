"""Freshness of modules, data sets and jobs, and what the operators' pages and mails report."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Days after which a cadence is delayed and stale, and days of one release cycle.
THRESHOLDS = {"daily": (3, 8), "weekly": (10, 21), "monthly": (45, 95), "quarterly": (150, 220), "annual": (550, 640), "yearly": (550, 640), "irregular": (45, 95), "census": (4000, 4500), "survey": (1500, 2200)}
OTHER_THRESHOLD = (45, 70)
CYCLES = {"monthly": 40, "quarterly": 100, "half_yearly": 190, "annual": 380}
#: Statuses that count as a good run, and how recent a run without new data must be to vouch for its source.
GOOD, AWAITING_DAYS = ["success", "no_new_data", "partial"], 21


def by_value(key: Column, values: dict, other) -> Column:
    """A small look-up as an expression."""
    out = F.lit(other)
    for k, v in values.items():
        out = F.when(key == k, v).otherwise(out)
    return out


def job_latest(runs: DataFrame) -> DataFrame:
    """Each job's latest run and the start of its latest good one, from one aggregate."""
    last = F.max(F.struct("started_at", "run_id", "status", "rows_upserted", "error")).alias("last")
    ok = F.max(F.when(F.col("status").isin(*GOOD), F.col("started_at"))).alias("last_success_at")
    return runs.groupBy("job_name").agg(last, ok).select("job_name", F.col("last.status").alias("last_status"), F.col("last.started_at").alias("last_run_at"), F.col("last.rows_upserted").alias("last_rows"), "last_success_at")


def observation_counts(obs: DataFrame, catalog: DataFrame) -> DataFrame:
    """Points by module: summed by series before the catalog is joined."""
    n = obs.groupBy("series_id").agg(F.count(F.lit(1)).alias("n"))
    return n.join(catalog.filter("is_active").select("series_id", "module"), "series_id").groupBy("module").agg(F.sum("n").alias("n_points"))


def age_state(age: Column, frequency: Column) -> Column:
    """fresh, current (past one release cycle, yet within its usual lag), delayed or stale."""
    delayed = by_value(frequency, {k: v[0] for k, v in THRESHOLDS.items()}, OTHER_THRESHOLD[0])
    stale = by_value(frequency, {k: v[1] for k, v in THRESHOLDS.items()}, OTHER_THRESHOLD[1])
    cycle = by_value(frequency, CYCLES, 10**6)
    return F.when(age.isNull() | (age > stale), "stale").when(age > delayed, "delayed").when(age > cycle, "current").otherwise("fresh")


def sources_current(feeders: DataFrame, runs: DataFrame, now: Column) -> DataFrame:
    """(module, job_name) -> modules that are old only because their source has published nothing: no feeder's latest run
    failed, and one that ran in the last three weeks found no new data."""
    last = job_latest(runs).select("job_name", "last_status", (F.col("last_run_at") > now - F.expr(f"interval {AWAITING_DAYS} days")).alias("recent"))
    g = feeders.join(last, "job_name").groupBy("module").agg(F.max(F.col("last_status") == "failed").alias("broken"), F.max((F.col("last_status") == "no_new_data") & F.col("recent")).alias("waiting"))
    return g.filter("waiting and not broken").select("module", F.lit(True).alias("source_current"))


def module_status(catalog: DataFrame, obs: DataFrame, feeders: DataFrame, runs: DataFrame, today: Column) -> DataFrame:
    """Per module: newest date (never ahead of today), series, points, most common cadence, age and state. catalog carries
    last_date. A module behind its cadence is `current` where its feeders have looked and found nothing new."""
    m = catalog.filter("is_active").groupBy("module").agg(F.least(F.max("last_date"), today).alias("last_date"), F.count(F.lit(1)).alias("series_count"), F.mode(F.lower("frequency"), deterministic=True).alias("frequency"))
    j = m.join(observation_counts(obs, catalog), "module", "left").join(sources_current(feeders, runs, today.cast("timestamp")), "module", "left")
    j = j.withColumn("age_days", F.datediff(today, "last_date")).withColumn("state", age_state(F.col("age_days"), F.col("frequency")))
    waits = F.col("state").isin("stale", "delayed") & F.coalesce("source_current", F.lit(False)) & F.col("age_days").isNotNull()
    return j.select("module", "last_date", "series_count", F.coalesce("n_points", F.lit(0)).alias("observation_count"), "frequency", "age_days", F.when(waits, "current").otherwise(F.col("state")).alias("state"))


def dataset_states(status: DataFrame, cadence: DataFrame, today: Column) -> DataFrame:
    """Rows of union_status with the age and state of each table; cadence: (name, frequency)."""
    s = status.join(cadence, "name", "left").withColumn("age_days", F.greatest(F.datediff(today, "last_date"), F.lit(0)))
    return s.withColumn("state", age_state(F.col("age_days"), F.col("frequency")))


def catalog_totals(catalog: DataFrame, navs: DataFrame, securities: DataFrame, today: Column, days: int = 30) -> DataFrame:
    """One row: live series, funds priced in the last days, securities."""
    live = navs.filter(F.col("obs_date") > F.date_sub(today, days))
    parts = [catalog.filter("is_active").agg(F.count(F.lit(1)).alias("n")).withColumn("what", F.lit("series")), live.agg(F.countDistinct("fund_id").alias("n")).withColumn("what", F.lit("funds")), securities.agg(F.countDistinct("code").alias("n")).withColumn("what", F.lit("securities"))]
    return reduce(DataFrame.unionByName, parts).select("what", "n")


def runs_summary(runs: DataFrame, now: Column, hours: int = 24, days: int = 7) -> DataFrame:
    """Per job over the last day: runs, failed, partial, latest status and error; and its failures in a week, its last good
    run. One aggregate over the week."""
    recent = F.col("started_at") > now - F.expr(f"interval {hours} hours")
    week = F.col("started_at") > now - F.expr(f"interval {days} days")
    last = F.max(F.when(recent, F.struct("started_at", "run_id", "status", "error"))).alias("last")
    g = runs.filter(F.col("started_at") <= now).groupBy("job_name").agg(
        F.count_if(recent).alias("runs"), F.count_if(recent & (F.col("status") == "failed")).alias("failed"), F.count_if(recent & (F.col("status") == "partial")).alias("partial"),
        F.count_if(week & (F.col("status") == "failed")).alias("failed_7d"), last, F.max(F.when(F.col("status").isin(*GOOD), F.col("started_at"))).alias("last_ok"),
    )
    return g.select("job_name", "runs", "failed", "partial", "failed_7d", F.col("last.status").alias("latest_status"), F.col("last.error").alias("latest_error"), "last_ok")


def stale_jobs(runs: DataFrame, intervals: DataFrame, now: Column) -> DataFrame:
    """(job_name, every_hours, by_run) -> jobs whose last fresh run is too old, or that have none. A partial run counts only
    if it stored rows; jobs with by_run are judged by any run, as their source changes rarely."""
    fresh = F.col("status").isin("success", "no_new_data") | ((F.col("status") == "partial") & (F.col("rows_upserted") > 0))
    g = runs.filter(F.col("started_at") <= now).groupBy("job_name").agg(F.max(F.when(fresh, F.col("started_at"))).alias("last_fresh"), F.max("started_at").alias("last_run"))
    j = intervals.join(g, "job_name", "left").withColumn("seen", F.when(F.col("by_run"), F.col("last_run")).otherwise(F.col("last_fresh")))
    j = j.withColumn("hours_since", (F.unix_timestamp(now) - F.unix_timestamp("seen")) / 3600)
    return j.filter(F.col("seen").isNull() | (F.col("hours_since") > F.col("every_hours"))).select("job_name", "every_hours", "seen", "hours_since")


def stuck_runs(runs: DataFrame, now: Column, hours: int) -> DataFrame:
    """Runs that have been `running` for longer than so many hours: their process is presumed dead."""
    return runs.filter((F.col("status") == "running") & (F.col("started_at") < now - F.expr(f"interval {hours} hours")))


def catalog_admin(catalog: DataFrame) -> DataFrame:
    """Live series, derived ones among them and retired ones, by module and source."""
    return catalog.groupBy("module", "source").agg(F.count_if("is_active").alias("live"), F.count_if(F.col("is_active") & F.col("canonical_id").isNotNull()).alias("copies"), F.count_if(~F.col("is_active")).alias("retired"))


def overview(users: DataFrame, prices: dict[str, float], today: Column) -> DataFrame:
    """Per plan: users, sign-ups of today, since 7 and since 30 days ago, those seen since 30 days ago, and revenue at the
    plan's price. The day so many days ago counts, as do later days than today but for `today`."""
    since = lambda c, days: F.count_if(F.col(c) >= F.date_sub(today, days))
    g = users.groupBy("plan").agg(F.count(F.lit(1)).alias("users"), F.count_if(F.col("signed_up") == today).alias("today"), since("signed_up", 7).alias("week"), since("signed_up", 30).alias("month"), since("last_seen", 30).alias("active"))
    return g.withColumn("revenue", F.col("users") * by_value(F.col("plan"), prices, 0.0))


def traffic(log: DataFrame, routes: int = 40) -> DataFrame:
    """Requests by day, by route (the most frequent ones) and by user (with its different routes), in one long table."""
    day = log.groupBy(F.col("day").cast("string").alias("key")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("user_id").alias("distinct")).withColumn("kind", F.lit("day"))
    route = log.groupBy(F.col("route").alias("key")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("user_id").alias("distinct")).orderBy(F.desc("n"), "key").limit(routes).withColumn("kind", F.lit("route"))
    user = log.groupBy(F.col("user_id").alias("key")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("route").alias("distinct")).withColumn("kind", F.lit("user"))
    return day.unionByName(route).unionByName(user)


def edge_daily(samples: DataFrame, problem_share: float = 0.05) -> DataFrame:
    """(day, groups array<struct<status, n, interval>>): sampled counts weighted by their interval, by status class, and
    whether server errors are more than a share of a day's requests."""
    g = samples.select("day", F.explode("groups").alias("g")).withColumn("weight", F.col("g.n") * F.col("g.interval"))
    out = g.groupBy("day").agg(F.sum("weight").alias("requests"), *[F.sum(F.when(F.floor(F.col("g.status") / 100) == c, F.col("weight")).otherwise(0)).alias(f"n_{c}xx") for c in (2, 3, 4, 5)])
    return out.withColumn("problem", F.col("n_5xx") > problem_share * F.col("requests"))


def findings_report(findings: DataFrame) -> DataFrame:
    """Findings by detector and verdict, open ones counted, with how many series they touch."""
    return findings.groupBy("detector").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("series_id").alias("n_series"), F.count_if(F.col("verdict").isNull()).alias("open"), F.count_if(F.col("verdict") == "confirmed").alias("confirmed"))


def shared_names(catalog: DataFrame) -> DataFrame:
    """Names that more than one live series carries."""
    return catalog.filter("is_active").groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.min("series_id").alias("first_id")).filter("n > 1")


def market_spans(prices: DataFrame, markets: DataFrame) -> DataFrame:
    """Every market with its first and last priced day, null where it has none."""
    return markets.join(prices.groupBy("market").agg(F.min("obs_date").alias("first_date"), F.max("obs_date").alias("last_date")), "market", "left")


def amc_profile(funds: DataFrame, expenses: DataFrame) -> DataFrame:
    """Per manager: funds, oldest, categories, ratings, and the mean of each fund's newest expense ratio."""
    newest = expenses.filter("ter is not null").groupBy("fund_id").agg(F.max_by("ter", "obs_date").alias("ter"))
    j = funds.join(newest, "fund_id", "left")
    return j.groupBy("amc").agg(F.count(F.lit(1)).alias("n_funds"), F.min("inception_date").alias("oldest"), F.avg("ter").alias("mean_ter"), F.concat_ws(",", F.array_sort(F.collect_set("category"))).alias("categories"), F.count_if("rated").alias("n_rated"))
