"""Queries of freshness, jobs, usage and catalog reports, each with the SQL it must agree with."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.operators import editions, status
from ledgerline.plans import adapters as A
from ledgerline.plans.registry import query, rounded
from ledgerline.sources.tables import read_table

_NOW = "TIMESTAMP '2024-01-25 12:00:00'"


def _now():
    return F.lit("2024-01-25 12:00:00").cast("timestamp")


def _today():
    return F.lit("2001-12-31").cast("date")


@query(f"""WITH {A.RUNS}, r AS (SELECT *, row_number() OVER (PARTITION BY job_name ORDER BY started_at DESC, run_id DESC) AS rn FROM runs),
ok AS (SELECT job_name, max(started_at) AS last_success_at FROM runs WHERE status NOT IN ('failed', 'running') GROUP BY 1)
SELECT job_name, status AS last_status, started_at AS last_run_at, rows_upserted AS last_rows, last_success_at FROM r LEFT JOIN ok USING (job_name) WHERE rn = 1""")
def job_latest(spark, d):
    return status.job_latest(A.runs(spark, d))


_STATUS = f"""{A.RUNS}, {A.MONTHLY}, {A.CATALOG}, f AS (SELECT DISTINCT job_name, 'module_' || right(job_name, 1) AS module FROM runs),
r AS (SELECT *, row_number() OVER (PARTITION BY job_name ORDER BY started_at DESC, run_id DESC) AS rn FROM runs)"""


def _cadence():
    state = "CASE WHEN age IS NULL OR age > late THEN 'stale' WHEN age > slow THEN 'delayed' WHEN age > cycle THEN 'current' ELSE 'fresh' END"
    rows = ", ".join(f"('{k}', {a}, {b}, {status.CYCLES.get(k, 10**6)})" for k, (a, b) in status.THRESHOLDS.items())
    return state, f"cadence(frequency, slow, late, cycle) AS (VALUES {rows})"


_STATE, _CADENCE = _cadence()


@query(f"""WITH {_STATUS}, {_CADENCE}, newest AS (SELECT series_id, max(obs_date) AS last_date, count(*) AS n FROM monthly GROUP BY 1),
g AS (SELECT module, frequency, count(*) AS n FROM catalog WHERE is_active GROUP BY 1, 2), top AS (SELECT module, frequency FROM (SELECT *, row_number() OVER (PARTITION BY module ORDER BY n DESC, frequency) AS rn FROM g) WHERE rn = 1),
m AS (SELECT module, least(max(last_date), DATE '2001-12-31') AS last_date, count(*) AS series_count, coalesce(sum(n), 0) AS observation_count FROM catalog LEFT JOIN newest USING (series_id) WHERE is_active GROUP BY 1),
w AS (SELECT module FROM f JOIN r USING (job_name) WHERE rn = 1 GROUP BY 1 HAVING bool_or(status = 'no_new_data' AND started_at > TIMESTAMP '2001-12-10') AND NOT bool_or(status = 'failed')),
a AS (SELECT m.*, top.frequency, DATE '2001-12-31' - last_date AS age FROM m JOIN top USING (module))
SELECT module, last_date, series_count, CAST(observation_count AS BIGINT) AS observation_count, frequency, CAST(age AS INTEGER) AS age_days,
CASE WHEN {_STATE} IN ('stale', 'delayed') AND module IN (SELECT module FROM w) THEN 'current' ELSE {_STATE} END AS state FROM a JOIN cadence USING (frequency)""")
def module_status(spark, d):
    obs, runs = A.monthly(spark, d), A.runs(spark, d)
    catalog = A.catalog(spark, d).join(obs.groupBy("series_id").agg(F.max("obs_date").alias("last_date")), "series_id", "left")
    feeders = runs.select("job_name", F.concat(F.lit("module_"), F.substring_index("job_name", "_", -1)).alias("module")).distinct()
    return status.module_status(catalog, obs, feeders, runs, _today())


@query(f"WITH {A.MONTHLY}, {A.CATALOG} SELECT module, count(*) AS n_points FROM monthly JOIN catalog USING (series_id) WHERE is_active GROUP BY 1")
def observation_counts(spark, d):
    return status.observation_counts(A.monthly(spark, d), A.catalog(spark, d))


@query(f"""WITH {_CADENCE}, s AS (SELECT 'orders' AS name, count(*) AS records, count(DISTINCT o_custkey) AS entities, CAST(max(o_orderdate) AS DATE) AS last_date, 'monthly' AS frequency FROM orders
UNION ALL SELECT 'lineitem', count(*), count(DISTINCT l_partkey), CAST(max(l_shipdate) AS DATE), 'quarterly' FROM lineitem UNION ALL SELECT 'events', count(*), count(DISTINCT user_id), CAST(max(ts) AS DATE), 'daily' FROM events),
a AS (SELECT *, greatest(DATE '2002-03-31' - last_date, 0) AS age FROM s) SELECT name, records, entities, last_date, frequency, CAST(age AS INTEGER) AS age_days, {_STATE} AS state FROM a JOIN cadence USING (frequency)""")
def dataset_states(spark, d):
    t = lambda n: read_table(spark, d, n)
    s = editions.union_status({"orders": (t("orders"), "o_custkey", "o_orderdate"), "lineitem": (t("lineitem"), "l_partkey", "l_shipdate"), "events": (t("events"), "user_id", "ts")})
    cadence = s.select("name", F.when(F.col("name") == "orders", "monthly").when(F.col("name") == "lineitem", "quarterly").otherwise("daily").alias("frequency"))
    return status.dataset_states(s, cadence, F.lit("2002-03-31").cast("date")).drop("first_date")


@query(f"""WITH {A.CATALOG}, {A.NAVS} SELECT 'series' AS what, count(*) AS n FROM catalog WHERE is_active UNION ALL
SELECT 'funds', count(DISTINCT fund_id) FROM navs WHERE obs_date > DATE '2001-06-01' - 30 UNION ALL SELECT 'securities', count(DISTINCT p_type) FROM part""")
def catalog_totals(spark, d):
    return status.catalog_totals(A.catalog(spark, d), A.navs(spark, d), read_table(spark, d, "part").select(F.col("p_type").alias("code")), F.lit("2001-06-01").cast("date"))


@query(f"""WITH {A.RUNS}, r AS (SELECT * FROM runs WHERE started_at <= {_NOW}), l AS (SELECT job_name, status, error, row_number() OVER (PARTITION BY job_name ORDER BY started_at DESC, run_id DESC) AS rn FROM r WHERE started_at > {_NOW} - INTERVAL 24 HOUR),
c AS (SELECT job_name, count(*) FILTER (started_at > {_NOW} - INTERVAL 24 HOUR) AS runs, count(*) FILTER (status = 'failed' AND started_at > {_NOW} - INTERVAL 24 HOUR) AS failed,
count(*) FILTER (status = 'partial' AND started_at > {_NOW} - INTERVAL 24 HOUR) AS partial, count(*) FILTER (status = 'failed' AND started_at > {_NOW} - INTERVAL 7 DAY) AS failed_7d,
max(started_at) FILTER (status NOT IN ('failed', 'running')) AS last_ok FROM r GROUP BY 1)
SELECT job_name, runs, failed, partial, failed_7d, status AS latest_status, error AS latest_error, last_ok FROM c LEFT JOIN l ON c.job_name = l.job_name AND rn = 1""".replace("SELECT job_name, runs", "SELECT c.job_name, runs"))
def runs_summary(spark, d):
    return status.runs_summary(A.runs(spark, d), _now())


@query(f"""WITH {A.RUNS}, i AS (SELECT DISTINCT job_name, CAST(4 + 10 * (user_id % 3) AS INTEGER) AS every_hours, user_id % 3 = 1 AS by_run FROM events JOIN runs ON run_id = event_id),
l AS (SELECT job_name, max(started_at) AS run, max(started_at) FILTER (status IN ('success', 'no_new_data') OR (status = 'partial' AND rows_upserted >= 1)) AS fresh FROM runs WHERE started_at <= {_NOW} GROUP BY 1),
j AS (SELECT job_name, every_hours, CASE WHEN by_run THEN run ELSE fresh END AS seen FROM i LEFT JOIN l USING (job_name)),
h AS (SELECT *, (epoch({_NOW}) - floor(epoch(seen))) / 3600 AS hours_since FROM j) SELECT job_name, every_hours, seen, round(hours_since, 6) AS hours_since FROM h WHERE seen IS NULL OR hours_since > every_hours""")
def stale_jobs(spark, d):
    runs = A.runs(spark, d)
    n = F.substring_index("job_name", "_", -1).cast("int")
    intervals = runs.select("job_name", (4 + 10 * n).alias("every_hours"), (n == 1).alias("by_run")).distinct()
    return rounded(status.stale_jobs(runs, intervals, _now()), "hours_since")


@query(f"WITH {A.RUNS} SELECT run_id, job_name, started_at FROM runs WHERE status = 'running' AND started_at + INTERVAL 6 HOUR < {_NOW}")
def stuck_runs(spark, d):
    return status.stuck_runs(A.runs(spark, d), _now(), 6).select("run_id", "job_name", "started_at")


@query(f"""WITH {A.CATALOG} SELECT module, source, CAST(sum(CASE WHEN is_active THEN 1 ELSE 0 END) AS BIGINT) AS live, CAST(sum(CASE WHEN is_active AND canonical_id IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS copies,
CAST(sum(CASE WHEN is_active THEN 0 ELSE 1 END) AS BIGINT) AS retired FROM catalog GROUP BY 1, 2""")
def catalog_admin(spark, d):
    return status.catalog_admin(A.catalog(spark, d))


@query("""WITH u AS (SELECT o_custkey, min(CAST(o_orderdate AS DATE)) AS signed_up, max(CAST(o_orderdate AS DATE)) AS last_seen FROM orders GROUP BY 1), p AS (SELECT c_mktsegment AS plan, signed_up, last_seen FROM u JOIN customer ON c_custkey = o_custkey)
SELECT plan, count(*) AS users, count(*) FILTER (signed_up = DATE '1996-03-02') AS today, count(*) FILTER (signed_up >= DATE '1996-02-24') AS week, count(*) FILTER (signed_up >= DATE '1996-02-01') AS month,
count(*) FILTER (last_seen >= DATE '1996-02-01') AS active, CAST(count(*) * CASE plan WHEN 'BUILDING' THEN 9.5 WHEN 'MACHINERY' THEN 30.0 ELSE 0.0 END AS DOUBLE) AS revenue FROM p GROUP BY 1""")
def overview(spark, d):
    day = F.to_date("o_orderdate")
    seen = read_table(spark, d, "orders").groupBy("o_custkey").agg(F.min(day).alias("signed_up"), F.max(day).alias("last_seen"))
    users = seen.join(read_table(spark, d, "customer"), F.col("c_custkey") == F.col("o_custkey")).withColumnRenamed("c_mktsegment", "plan")
    return status.overview(users, {"BUILDING": 9.5, "MACHINERY": 30.0}, F.lit("1996-03-02").cast("date"))


@query(f"""WITH {A.LOG} SELECT 'day' AS kind, CAST(day AS VARCHAR) AS key, count(*) AS n, count(DISTINCT user_id) AS "distinct" FROM log GROUP BY 2
UNION ALL SELECT * FROM (SELECT 'route', route, count(*) AS n, count(DISTINCT user_id) FROM log GROUP BY 2 ORDER BY n DESC, route LIMIT 3) UNION ALL SELECT 'user', user_id, count(*), count(DISTINCT route) FROM log GROUP BY 2""")
def traffic(spark, d):
    return status.traffic(A.request_log(spark, d), 3)


@query(f"""WITH {A.LOG}, w AS (SELECT day, status, count(*) * 10 AS n FROM log GROUP BY 1, 2)
SELECT day, CAST(sum(n) AS BIGINT) AS requests, CAST(coalesce(sum(n) FILTER (status < 300), 0) AS BIGINT) AS n_2xx, CAST(coalesce(sum(n) FILTER (status BETWEEN 300 AND 399), 0) AS BIGINT) AS n_3xx,
CAST(coalesce(sum(n) FILTER (status BETWEEN 400 AND 499), 0) AS BIGINT) AS n_4xx, CAST(coalesce(sum(n) FILTER (status >= 500), 0) AS BIGINT) AS n_5xx, coalesce(sum(n) FILTER (status >= 500), 0) / sum(n) > 0.2 AS problem FROM w GROUP BY 1""")
def edge_daily(spark, d):
    counts = A.request_log(spark, d).groupBy("day", "status").agg(F.count(F.lit(1)).alias("n"))
    samples = counts.groupBy("day").agg(F.collect_list(F.struct("status", "n", F.lit(10).alias("interval"))).alias("groups"))
    return status.edge_daily(samples, 0.2)


@query(f"""WITH {A.MONTHLY}, f AS (SELECT series_id, CASE WHEN value > 50000 THEN 'high' ELSE 'low' END AS detector, CASE WHEN month(obs_date) = 1 THEN 'confirmed' WHEN month(obs_date) = 2 THEN 'differs' END AS verdict FROM monthly)
SELECT detector, count(*) AS n, count(DISTINCT series_id) AS n_series, count(*) - count(verdict) AS open, count(*) FILTER (verdict = 'confirmed') AS confirmed FROM f GROUP BY 1""")
def dq_report(spark, d):
    m = A.monthly(spark, d)
    verdict = F.when(F.month("obs_date") == 1, "confirmed").when(F.month("obs_date") == 2, "differs")
    return status.findings_report(m.select("series_id", F.when(F.col("value") > 50000, "high").otherwise("low").alias("detector"), verdict.alias("verdict")))


@query("SELECT p_name AS name, count(*) AS n, CAST(min(p_partkey) AS VARCHAR) AS first_id FROM part GROUP BY 1 HAVING count(*) >= 2")
def shared_names(spark, d):
    catalog = read_table(spark, d, "part").select(F.col("p_partkey").alias("series_id"), F.col("p_name").alias("name"), F.lit(True).alias("is_active"))
    return status.shared_names(catalog).withColumn("first_id", F.col("first_id").cast("string"))


@query(f"WITH {A.PRICES} SELECT n_name AS market, min(week) AS first_date, max(week) AS last_date FROM nation LEFT JOIN prices ON city = n_name GROUP BY 1")
def agri_markets(spark, d):
    prices = A.prices(spark, d).select(F.col("city").alias("market"), F.col("week").alias("obs_date"))
    return status.market_spans(prices, read_table(spark, d, "nation").select(F.col("n_name").alias("market")))


@query(f"""WITH {A.NAVS}, f AS (SELECT fund_id, 'amc_' || CAST(fund_id % 6 AS VARCHAR) AS amc, min(obs_date) AS inception_date, 'cat_' || CAST(fund_id % 4 AS VARCHAR) AS category, fund_id % 3 = 0 AS rated FROM navs GROUP BY 1),
e AS (SELECT fund_id, arg_max(nav / 100000, obs_date) AS ter FROM navs WHERE month(obs_date) = 6 GROUP BY 1)
SELECT amc, count(*) AS n_funds, min(inception_date) AS oldest, round(avg(ter), 6) AS mean_ter, string_agg(DISTINCT category, ',' ORDER BY category) AS categories, count(*) FILTER (rated) AS n_rated FROM f LEFT JOIN e USING (fund_id) GROUP BY 1""")
def amc_profile(spark, d):
    n, i = A.navs(spark, d), F.col("fund_id")
    funds = n.groupBy("fund_id").agg(F.min("obs_date").alias("inception_date")).select("fund_id", "inception_date", F.concat(F.lit("amc_"), (i % 6).cast("string")).alias("amc"), F.concat(F.lit("cat_"), (i % 4).cast("string")).alias("category"), (i % 3 == 0).alias("rated"))
    expenses = n.select("fund_id", "obs_date", F.when(F.month("obs_date") == 6, F.col("nav") / 100000).alias("ter"))
    return rounded(status.amc_profile(funds, expenses), "mean_ter")
