"""Queries of the quality, edition and summary operators, each with the SQL it must agree with."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.operators import editions, facts, merge, quality, series, summaries
from ledgerline.plans import adapters as A
from ledgerline.plans.registry import _OUT, _POINT, _last, _points, query, rounded
from ledgerline.sources.tables import read_table

_FLIP = "flip AS (SELECT series_id, dims_key, obs_date, value * CASE WHEN (year(obs_date) + month(obs_date)) % 7 = 0 THEN -1 ELSE 1 END AS value FROM monthly)"


@query(f"""WITH {A.MONTHLY}, {_FLIP}, {A.around("flip", series.KEY)} {_OUT} FROM around
WHERE pv / nv > 0.8 AND pv / nv < 1.2 AND value / pv > -1.2 AND value / pv < -0.8""")
def sign_flip(spark, d):
    m = A.monthly(spark, d).withColumn("value", F.col("value") * F.when((F.year("obs_date") + F.month("obs_date")) % 7 == 0, -1).otherwise(1))
    return rounded(quality.sign_flip(series.neighbours(m)), "value", "pv", "nv")


_NAV_ZERO = "dented AS (SELECT fund_id, obs_date, CASE WHEN day(obs_date) = 7 AND fund_id % 7 = 0 THEN 0 ELSE nav END AS nav FROM navs)"
_NAV_NEAR = f"{_NAV_ZERO}, {A.around('dented', ['fund_id'], value='nav')}"
_NAV_BAD = "(nav <= 0 OR (least(nav, pv, nv) > 0 AND pv IS NOT NULL AND nv IS NOT NULL AND pv / nv > 0.9 AND pv / nv < 1.1 AND NOT nav / pv BETWEEN 0.6 AND 1.4))"


def _dented(spark, d):
    """Prices with a few zeros among them."""
    return A.navs(spark, d).withColumn("nav", F.when((F.dayofmonth("obs_date") == 7) & (F.col("fund_id") % 7 == 0), 0.0).otherwise(F.col("nav")))


def _nav_spikes(spark, d):
    return quality.price_spikes(quality.beside(_dented(spark, d), ["fund_id"], "obs_date", "nav"), "nav", 0.1, 0.6, 1.4, nonpositive=True)


@query(f"WITH {A.NAVS}, {_NAV_NEAR} SELECT fund_id, obs_date, round(nav, 6) AS nav, round(pv, 6) AS pv, round(nv, 6) AS nv FROM around WHERE {_NAV_BAD}")
def nav_spikes(spark, d):
    return rounded(_nav_spikes(spark, d), "nav", "pv", "nv")


@query(f"WITH {A.NAVS}, {_NAV_NEAR} SELECT fund_id, obs_date, round(nav, 6) AS nav, CASE WHEN {_NAV_BAD} THEN 'spike' END AS reason FROM around")
def quarantine(spark, d):
    return rounded(quality.quarantine(_dented(spark, d), _nav_spikes(spark, d), ["fund_id", "obs_date"], "spike"), "nav")


@query(f"""WITH {A.PRICES}, late AS (SELECT * FROM prices WHERE week > DATE '1996-01-01'), {A.around("late", ["item", "city"], "week")}
SELECT item, city, week, value, pv, nv FROM around WHERE least(value, pv, nv) > 0 AND pv IS NOT NULL AND nv IS NOT NULL AND pv / nv > 0.7 AND pv / nv < 1.3 AND NOT value / pv BETWEEN 0.25 AND 4""")
def agri_spikes(spark, d):
    recent = A.prices(spark, d).filter("week > DATE '1996-01-01'")
    return quality.price_spikes(quality.beside(recent, ["item", "city"], "week", "value"), "value", 0.3, 0.25, 4)


@query(f"""WITH {A.MONTHLY}, {_FLIP}, {A.CATALOG} SELECT series_id, dims_key, obs_date, round(value, 6) AS value, unit FROM flip JOIN catalog USING (series_id)
WHERE CASE unit WHEN 'percent' THEN value NOT BETWEEN -100 AND 1000 WHEN 'pkr_per_kg' THEN value <= 0 ELSE value < 0 END""")
def out_of_range(spark, d):
    m = A.monthly(spark, d).withColumn("value", F.col("value") * F.when((F.year("obs_date") + F.month("obs_date")) % 7 == 0, -1).otherwise(1))
    return rounded(quality.out_of_range(m, A.catalog(spark, d)), "value")


@query(f"""WITH {A.MONTHLY}, y AS (SELECT a.series_id, a.dims_key, a.obs_date, (a.value / b.value - 1) * 100 AS own FROM monthly a JOIN monthly b ON a.series_id = b.series_id
AND a.dims_key = b.dims_key AND b.obs_date = last_day(a.obs_date - INTERVAL 12 MONTH) WHERE b.value <> 0)
SELECT series_id, dims_key, obs_date, round(own + 1, 6) AS published, round(own, 6) AS own FROM y WHERE month(obs_date) % 5 = 0""")
def yoy_vs_index(spark, d):
    own = series.against_month(A.monthly(spark, d), 12)
    printed = own.withColumn("result", F.col("result") + F.when(F.month("obs_date") % 5 == 0, 1).otherwise(0))
    return rounded(quality.yoy_vs_index(printed, own).select("series_id", "dims_key", "obs_date", F.col("result").alias("published"), "own"), "published", "own")


@query(f"""WITH {A.TRADE}, s AS (SELECT fy, country, sum(value) AS parts FROM trade GROUP BY 1, 2)
SELECT fy, country, round(parts * 1.05, 2) AS value, round(parts, 2) AS parts FROM s WHERE fy % 2 = 0""")
def sum_identity(spark, d):
    t = A.trade(spark, d)
    totals = t.groupBy("fy", "country").agg((F.sum("value") * F.when(F.col("fy") % 2 == 0, 1.05).otherwise(1.0)).alias("value"))
    return rounded(quality.sum_identity(t.groupBy("fy", "country", "flow").agg(F.sum("value").alias("value")), totals, ["fy", "country"], 0.01), "value", "parts", digits=2)


@query(f"""WITH {A.DAILY}, q AS (SELECT series_id, obs_date, max(value) FILTER (dims_key LIKE '%"0"%') AS bid, max(value) FILTER (dims_key LIKE '%"1"%') AS offer FROM daily GROUP BY 1, 2)
SELECT series_id, obs_date, round(bid, 6) AS bid, round(offer, 6) AS offer FROM q WHERE bid > offer""")
def bid_above_offer(spark, d):
    k = F.col("dims_key")
    side = F.when(F.contains(k, F.lit('"0"')), "bid").when(F.contains(k, F.lit('"1"')), "offer")
    return rounded(quality.bid_above_offer(A.daily(spark, d), ["series_id", "obs_date"], side), "bid", "offer")


@query(f"""WITH {A.PRICES}, m AS (SELECT item, week, avg(value) AS city_mean, count(value) AS n_cities FROM prices GROUP BY 1, 2 HAVING count(value) >= 10),
n AS (SELECT item, week, median(value) AS value FROM prices GROUP BY 1, 2)
SELECT item, week, round(value, 6) AS value, round(city_mean, 6) AS city_mean, n_cities FROM n JOIN m USING (item, week) WHERE abs(value / city_mean - 1) > 0.02""")
def national_vs_cities(spark, d):
    p = A.prices(spark, d)
    return rounded(quality.national_vs_cities(p.groupBy("item", "week").agg(F.median("value").alias("value")), p, ["item", "week"]), "value", "city_mean")


@query(f"""WITH {A.NAVS}, j AS (SELECT fund_id, obs_date, CASE WHEN fund_id % 3 = 0 AND day(obs_date) = 5 THEN false ELSE true END AS same FROM navs WHERE month(obs_date) <> 2)
SELECT fund_id, count(*) AS n_shared, round(avg(CAST(same AS INTEGER)), 6) AS agreement, arg_max(same, obs_date) AS newest_agrees,
arg_max(same, obs_date) AND avg(CAST(same AS INTEGER)) >= 0.99 AS trusted FROM j GROUP BY 1""")
def shared_dates(spark, d):
    ours = A.navs(spark, d).withColumnRenamed("nav", "value")
    theirs = ours.filter(F.month("obs_date") != 2).withColumn("value", F.col("value") * F.when((F.col("fund_id") % 3 == 0) & (F.dayofmonth("obs_date") == 5), 1.1).otherwise(1.0))
    return rounded(quality.shared_dates(ours, theirs, ["fund_id"]), "agreement")


@query(f"""WITH {A.NAVS}, f AS (SELECT fund_id, min(obs_date) + CAST(30 * (fund_id % 5) AS INTEGER) AS inception_date FROM navs GROUP BY 1)
SELECT fund_id, inception_date, count(*) AS n, min(obs_date) AS first_date FROM navs JOIN f USING (fund_id) WHERE obs_date < inception_date - 60 GROUP BY 1, 2""")
def navs_before_inception(spark, d):
    n = A.navs(spark, d)
    funds = n.groupBy("fund_id").agg(F.date_add(F.min("obs_date"), (30 * (F.col("fund_id") % 5)).cast("int")).alias("inception_date"))
    return quality.before_start(n, funds, "fund_id", "inception_date")


@query(f"""WITH a AS {_last('WHERE o_orderkey % 5 <> 0')}, b AS (SELECT * REPLACE (CASE WHEN seq % 7 = 0 THEN value * 1.01 ELSE value END AS value) FROM {_last('WHERE o_orderkey % 5 <> 1')}),
k AS (SELECT coalesce(a.series_id, b.series_id) AS series_id, CASE WHEN a.seq IS NULL THEN 'missing_ours' WHEN b.seq IS NULL THEN 'missing_source'
WHEN abs(a.value - b.value) <= 1e-6 * greatest(abs(a.value), abs(b.value)) THEN 'matched' ELSE 'value' END AS kind
FROM a FULL OUTER JOIN b ON a.series_id = b.series_id AND a.obs_date = b.obs_date AND a.dims_key = b.dims_key)
SELECT series_id, count(*) FILTER (kind = 'matched') AS n_matched, count(*) FILTER (kind = 'value') AS n_value, count(*) FILTER (kind = 'missing_ours') AS n_missing_ours,
count(*) FILTER (kind = 'missing_source') AS n_missing_source, count(*) FILTER (kind <> 'matched') = 0 AS clean FROM k GROUP BY 1""")
def reconcile_checks(spark, d):
    p = _points(spark, d)
    ours = merge.dedupe_last(p.filter("seq % 5 <> 0"), merge.POINT, "seq")
    theirs = merge.dedupe_last(p.filter("seq % 5 <> 1"), merge.POINT, "seq").withColumn("value", F.when(F.col("seq") % 7 == 0, F.col("value") * 1.01).otherwise(F.col("value")))
    return quality.reconcile_checks(merge.compare_points(ours, theirs, merge.POINT), ["series_id"])


@query(f"""WITH {A.NAVS}, {_NAV_NEAR}, s AS (SELECT *, year(obs_date) AS y FROM around WHERE {_NAV_BAD}), c AS (SELECT fund_id, y, count(*) AS n_findings FROM s GROUP BY 1, 2 HAVING count(*) < 3)
SELECT fund_id, y, obs_date, round(nav, 6) AS nav, n_findings FROM s JOIN c USING (fund_id, y)""")
def notable(spark, d):
    return rounded(quality.notable(_nav_spikes(spark, d).withColumn("y", F.year("obs_date")), ["fund_id", "y"]).select("fund_id", "y", "obs_date", "nav", "n_findings"), "nav")


_FILES = """f AS (SELECT 'file_' || CAST(1990 + l_linenumber AS VARCHAR) AS file, l_partkey AS code, l_suppkey AS partner, l_quantity AS quantity, l_extendedprice AS value FROM lineitem)"""


@query(f"""WITH {_FILES}, s AS (SELECT file, code, partner, sum(quantity) AS quantity, sum(value) AS value FROM f GROUP BY 1, 2, 3)
SELECT file, code, partner, round(quantity, 2) AS quantity, round(value, 2) AS value FROM (SELECT *, row_number() OVER (PARTITION BY code, partner ORDER BY file DESC) AS rn FROM s) WHERE rn = 1""")
def merge_files(spark, d):
    f = read_table(spark, d, "lineitem").select(F.concat(F.lit("file_"), (1990 + F.col("l_linenumber")).cast("string")).alias("file"), F.col("l_partkey").alias("code"), F.col("l_suppkey").alias("partner"), F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("value"))
    return rounded(editions.merge_files(f, ["code", "partner"], ["quantity", "value"], F.col("file")), "quantity", "value", digits=2)


@query("""WITH r AS (SELECT o_custkey AS code, year(o_orderdate) AS fy, max(CASE WHEN o_orderkey % 4 = 0 THEN ' ' ELSE o_orderpriority END) AS description, max(CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus END) AS unit FROM orders GROUP BY 1, 2)
SELECT code, arg_max(description, fy) FILTER (length(trim(description)) > 0) AS description, arg_max(unit, fy) FILTER (unit IS NOT NULL) AS unit, min(fy) AS first_fy, max(fy) AS last_fy FROM r GROUP BY 1""")
def code_span(spark, d):
    o = read_table(spark, d, "orders")
    rows = o.groupBy(F.col("o_custkey").alias("code"), F.year("o_orderdate").alias("fy")).agg(F.max(F.when(F.col("o_orderkey") % 4 == 0, " ").otherwise(F.col("o_orderpriority"))).alias("description"), F.max(F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderstatus"))).alias("unit"))
    return editions.code_span(rows)


@query(f"SELECT {_POINT}, o_orderkey AS seq, row_number() OVER (PARTITION BY o_orderpriority, CAST(o_orderdate AS DATE), o_custkey % 20 ORDER BY o_orderkey) - 1 AS seq_no FROM orders")
def number_repeats(spark, d):
    return editions.number_repeats(_points(spark, d), merge.POINT, [F.col("seq")]).drop("value")


@query(f"""WITH p AS {_last('WHERE o_orderkey % 2 = 0 AND o_orderdate < DATE ' + "'1999-01-01'")}, s AS {_last('WHERE o_orderkey % 2 = 1')}, l AS (SELECT series_id, dims_key, max(obs_date) AS last_date FROM p GROUP BY 1, 2)
SELECT * FROM p UNION ALL SELECT s.* FROM s LEFT JOIN l USING (series_id, dims_key) WHERE last_date IS NULL OR obs_date > last_date""")
def fill_after(spark, d):
    p = _points(spark, d)
    first = merge.dedupe_last(p.filter("seq % 2 = 0 and obs_date < DATE '1999-01-01'"), merge.POINT, "seq")
    return editions.fill_after(first, merge.dedupe_last(p.filter("seq % 2 = 1"), merge.POINT, "seq"), ["series_id", "dims_key"])


@query("""WITH a AS (SELECT p_brand, p_type, CAST(p_size AS BIGINT) AS size FROM part WHERE p_partkey % 5 <> 0), b AS (SELECT p_brand, p_type, CAST(p_size AS BIGINT) AS size FROM part WHERE p_partkey % 5 <> 1)
SELECT *, 'removed' AS change FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) UNION ALL SELECT *, 'added' AS change FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)""")
def edition_changes(spark, d):
    p = read_table(spark, d, "part")
    cols = ["p_brand", "p_type", F.col("p_size").cast("long").alias("size")]
    return editions.edition_changes(p.filter("p_partkey % 5 <> 0").select(*cols), p.filter("p_partkey % 5 <> 1").select(*cols))


@query(f"""WITH {A.MONTHLY}, s AS (SELECT series_id, min(obs_date) AS first_date, max(obs_date) AS last_date, false AS is_active FROM monthly WHERE year(obs_date) BETWEEN 1997 AND 1998 GROUP BY 1),
b AS (SELECT series_id, min(obs_date) AS lo, max(obs_date) AS hi, bool_or(value <> 0) AS alive FROM monthly WHERE month(obs_date) = 6 AND series_id NOT LIKE '%1' GROUP BY 1)
SELECT series_id, least(first_date, lo) AS first_date, greatest(last_date, hi) AS last_date, is_active OR coalesce(alive, false) AS is_active FROM s LEFT JOIN b USING (series_id)""")
def series_bounds(spark, d):
    m = A.monthly(spark, d)
    s = m.filter(F.year("obs_date").between(1997, 1998)).groupBy("series_id").agg(F.min("obs_date").alias("first_date"), F.max("obs_date").alias("last_date"), F.lit(False).alias("is_active"))
    return editions.widen_bounds(s, m.filter((F.month("obs_date") == 6) & ~F.col("series_id").endswith("1")))


@query(f"""WITH c AS {_last()}, a AS (SELECT {_POINT}, o_totalprice AS value, o_orderkey AS seq FROM orders),
r AS (SELECT a.series_id, a.obs_date, a.dims_key, count(*) AS n, arg_min(a.value, a.seq) AS f FROM a JOIN c USING (series_id, obs_date, dims_key) WHERE a.seq < c.seq GROUP BY 1, 2, 3)
SELECT series_id, obs_date, dims_key, value, coalesce(n, 0) AS n_prints, coalesce(f, value) AS first_print, n IS NOT NULL AS revised FROM c LEFT JOIN r USING (series_id, obs_date, dims_key)""")
def revision_history(spark, d):
    p = _points(spark, d)
    now = merge.dedupe_last(p, merge.POINT, "seq")
    past = p.join(now.select(*merge.POINT, F.col("seq").alias("newest")), merge.POINT).filter("seq < newest").withColumn("superseded_at", F.timestamp_seconds("seq"))
    return editions.revision_history(now.drop("seq"), past, merge.POINT).withColumn("n_prints", F.size("prints").cast("long")).drop("prints")


@query("""WITH p AS (SELECT o_custkey AS k, o_orderkey AS issue, o_orderkey % 3 AS value FROM orders), n AS (SELECT *, lag(value) OVER w AS b, lead(value) OVER w AS a FROM p WINDOW w AS (PARTITION BY k ORDER BY issue))
SELECT k, issue, value FROM n WHERE NOT coalesce(a = b AND value <> b, false)""")
def drop_blips(spark, d):
    o = read_table(spark, d, "orders")
    return editions.drop_blips(o.select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("issue"), (F.col("o_orderkey") % 3).alias("value")), ["k"], "issue")


@query("""WITH r AS (SELECT o_orderkey AS id, o_custkey % 40 AS number, CAST(o_orderdate AS DATE) AS listed FROM orders), a AS (SELECT id, number, listed FROM r UNION ALL SELECT id, number + 1, listed FROM r),
m AS (SELECT a.id AS new_id, a.listed AS new_on, r.id AS old_id, row_number() OVER (PARTITION BY a.id, a.number ORDER BY r.listed DESC, r.id DESC) AS rn
FROM a JOIN r ON a.number = r.number AND r.listed <= a.listed AND r.id <> a.id),
o AS (SELECT *, row_number() OVER (PARTITION BY old_id ORDER BY new_on, new_id) AS place FROM m WHERE rn = 1)
SELECT old_id AS ruling_id, new_id AS superseded_by, new_on AS superseded_on FROM o WHERE place = 1""")
def link_supersessions(spark, d):
    o = read_table(spark, d, "orders")
    names = F.array((F.col("o_custkey") % 40).cast("string"), (F.col("o_custkey") % 40 + 1).cast("string"))
    return editions.link_supersessions(o.select(F.col("o_orderkey").alias("ruling_id"), (F.col("o_custkey") % 40).cast("string").alias("number"), F.to_date("o_orderdate").alias("listed_on"), names.alias("supersedes")))


@query("""SELECT 'orders' AS name, count(*) AS records, count(DISTINCT o_custkey) AS entities, min(CAST(o_orderdate AS DATE)) AS first_date, max(CAST(o_orderdate AS DATE)) AS last_date FROM orders
UNION ALL SELECT 'lineitem', count(*), count(DISTINCT l_partkey), min(CAST(l_shipdate AS DATE)), max(CAST(l_shipdate AS DATE)) FROM lineitem
UNION ALL SELECT 'events', count(*), count(DISTINCT user_id), min(CAST(ts AS DATE)), max(CAST(ts AS DATE)) FROM events""")
def dataset_status(spark, d):
    t = lambda n: read_table(spark, d, n)
    return editions.union_status({"orders": (t("orders"), "o_custkey", "o_orderdate"), "lineitem": (t("lineitem"), "l_partkey", "l_shipdate"), "events": (t("events"), "user_id", "ts")})


@query(f"""WITH {A.TRADE}, {A.RATES}, y AS (SELECT country, fy, sum(value) AS value FROM trade GROUP BY 1, 2)
SELECT country, min(fy) AS first_fy, max(fy) AS last_fy, round(sum(value / rate), 4) AS all_fx, round(sum(value / rate) FILTER (fy >= 1999), 4) AS recent_fx,
coalesce(sum(value / rate), 0) >= (SELECT avg(t) FROM (SELECT sum(value / rate) AS t FROM y LEFT JOIN rates USING (fy) GROUP BY country)) AND NOT starts_with(country, 'NATION_1') AS indexable FROM y LEFT JOIN rates USING (fy) GROUP BY 1""")
def partner_index(spark, d):
    trade, rates = A.trade(spark, d), A.rates(spark, d)
    mean = summaries.partner_index(trade, rates, 1999).agg(F.avg("all_fx")).first()[0]
    return rounded(summaries.partner_index(trade, rates, 1999, mean, "^NATION_1"), "all_fx", "recent_fx", digits=4)


@query("""WITH h AS (SELECT event_type AS series_id, date_trunc('hour', ts) AS hour, avg(value) AS value FROM events GROUP BY 1, 2)
SELECT series_id, CAST(hour AS DATE) AS obs_date, round(avg(value), 6) AS mean, round(max(value), 6) AS peak, round(min(value), 6) AS low, count(value) AS n_hours FROM h GROUP BY 1, 2 HAVING count(value) >= 12""")
def hourly_to_daily(spark, d):
    h = read_table(spark, d, "events").groupBy(F.col("event_type").alias("series_id"), F.date_trunc("hour", "ts").alias("hour")).agg(F.avg("value").alias("value"))
    return rounded(summaries.hourly_to_daily(h, ["series_id"], 12), "mean", "peak", "low")


@query(f"""WITH {A.CALLS} SELECT coalesce(direction, 'all') AS direction, coalesce(commodity, 'all') AS cargo, round(sum(tonnes), 2) AS value, count(*) AS n FROM calls GROUP BY CUBE (direction, commodity)""")
def container_cube(spark, d):
    c = A.calls(spark, d).select("direction", F.col("commodity").alias("cargo"), F.col("tonnes").alias("value"))
    return rounded(summaries.container_cube(c), "value", digits=2)


@query("""WITH r AS (SELECT r_name AS province, n_name AS district, c_acctbal AS value FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
p AS (SELECT r_name AS province, 'all' AS district, CAST(1000 * (r_regionkey + 1) AS DOUBLE) AS printed FROM region WHERE r_regionkey % 2 = 0),
u AS (SELECT coalesce(province, 'all') AS province, coalesce(district, 'all') AS district, sum(value) AS summed FROM r GROUP BY ROLLUP (province, district))
SELECT province, district, round(coalesce(printed, summed), 2) AS value, printed IS NOT NULL AS is_printed FROM u LEFT JOIN p USING (province, district)""")
def district_rollup(spark, d):
    c, n, r = (read_table(spark, d, t) for t in ("customer", "nation", "region"))
    rows = c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    printed = r.filter("r_regionkey % 2 = 0").select(F.col("r_name").alias("province"), F.lit("all").alias("district"), (1000 * (F.col("r_regionkey") + 1)).cast("double").alias("printed"))
    return rounded(summaries.district_rollup(rows.select(F.col("r_name").alias("province"), F.col("n_name").alias("district"), F.col("c_acctbal").alias("value")), printed), "value", digits=2)


@query(f"""WITH {A.CALLS} SELECT direction, last_day(day) AS month, round(sum(tonnes), 2) AS value, count(DISTINCT day) AS n_days FROM calls GROUP BY 1, 2 HAVING count(DISTINCT day) = day(last_day(max(day)))""")
def complete_month_totals(spark, d):
    c = A.calls(spark, d).select("direction", "day", F.col("tonnes").alias("value"))
    return rounded(summaries.complete_month_totals(c, ["direction"]), "value", digits=2)


@query(f"""WITH {A.LOG}, c AS (SELECT user_id, day, count(*) AS seen FROM log GROUP BY 1, 2), s AS (SELECT user_id, day, CAST(5 AS BIGINT) AS n FROM c WHERE day(day) % 2 = 0)
SELECT user_id, day, greatest(n, seen) AS n FROM c LEFT JOIN s USING (user_id, day)""")
def user_daily(spark, d):
    log = A.request_log(spark, d)
    return summaries.user_daily(log.filter(F.dayofmonth("day") % 2 == 0).select("user_id", "day").distinct().withColumn("n", F.lit(5).cast("long")), log)


@query(f"WITH {A.LOG} SELECT route, count(*) AS n, round(avg(ms), 6) AS mean_ms, count(*) FILTER (status >= 400) AS errors FROM log GROUP BY 1")
def endpoint_usage(spark, d):
    log = A.request_log(spark, d)
    past = log.filter(F.dayofmonth("day") < 20).groupBy("day", "route").agg(F.count(F.lit(1)).alias("n"), F.avg("ms").alias("ms"), F.count_if(F.col("status") >= 400).alias("errors"))
    return rounded(summaries.endpoint_usage(past, log), "mean_ms")


@query("""WITH e AS (SELECT 'part' AS kind, p_partkey AS key, p_name AS title, lower(p_name || ' ' || p_brand || ' ' || p_type) AS haystack FROM part
UNION ALL SELECT 'customer', c_custkey, c_name, lower(c_name || ' ' || c_mktsegment) FROM customer)
SELECT kind, key, title, CASE WHEN lower(title) = 'customer 1' THEN 0 WHEN starts_with(lower(title), 'customer 1') THEN 1 WHEN contains(lower(title), 'customer 1') THEN 2 ELSE 3 END AS tier
FROM e WHERE contains(haystack, 'customer') AND contains(haystack, '1')""")
def word_search(spark, d):
    p, c = read_table(spark, d, "part"), read_table(spark, d, "customer")
    parts = p.select(F.lit("part").alias("kind"), F.col("p_partkey").alias("key"), F.col("p_name").alias("title"), F.lower(F.concat_ws(" ", "p_name", "p_brand", "p_type")).alias("haystack"))
    people = c.select(F.lit("customer").alias("kind"), F.col("c_custkey").alias("key"), F.col("c_name").alias("title"), F.lower(F.concat_ws(" ", "c_name", "c_mktsegment")).alias("haystack"))
    return summaries.word_search(parts.unionByName(people), ["customer", "1"]).drop("haystack")


@query(f"""WITH {A.NAVS}, l AS (SELECT fund_id, max(obs_date) AS last_date, arg_max(nav, obs_date) AS last_nav FROM navs GROUP BY 1),
p AS (SELECT *, max(nav) OVER (PARTITION BY fund_id ORDER BY obs_date) AS peak FROM navs WHERE nav > 0), w AS (SELECT fund_id, round(min(nav / peak - 1) * 100, 4) AS max_drawdown_pct FROM p GROUP BY 1)
SELECT fund_id, last_date, round(last_nav, 6) AS last_nav, max_drawdown_pct FROM l LEFT JOIN w USING (fund_id)""")
def fund_screener(spark, d):
    n = A.navs(spark, d)
    last = n.groupBy("fund_id").agg(F.max("obs_date").alias("last_date"), F.max_by("nav", "obs_date").alias("last_nav"))
    return rounded(last.join(facts.fund_drawdown(n), "fund_id", "left"), "last_nav")
