"""Queries of derived indicators and their joins, each with the SQL it must agree with."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.operators import derived
from ledgerline.plans import adapters as A
from ledgerline.plans.registry import query, rounded
from ledgerline.sources.tables import read_table

_AB = f"""WITH {A.MONTHLY}, a AS (SELECT series_id, obs_date, value FROM monthly WHERE dims_key LIKE '%"A"%'), b AS (SELECT series_id, obs_date, value FROM monthly WHERE dims_key LIKE '%"N"%')"""


def _ab(spark, d):
    m = A.monthly(spark, d)
    return [m.filter(F.get_json_object("dims_key", "$.flag") == f).select("series_id", "obs_date", "value") for f in ("A", "N")]


@query(f"{_AB} SELECT a.series_id, a.obs_date, round(a.value - b.value, 6) AS value FROM a JOIN b USING (series_id, obs_date)")
def difference(spark, d):
    return rounded(derived.difference(*_ab(spark, d), ["series_id"]), "value")


@query(f"{_AB} SELECT a.series_id, a.obs_date, round(a.value / b.value / 10, 6) AS value FROM a JOIN b USING (series_id, obs_date)")
def share_pct(spark, d):
    return rounded(derived.share_pct(*_ab(spark, d), ["series_id"], 1000.0), "value")


@query(f"{_AB}, c AS (SELECT * FROM b WHERE month(obs_date) % 4 = 1) SELECT a.series_id, a.obs_date, round(a.value - c.value, 6) AS value FROM a ASOF JOIN c ON a.series_id = c.series_id AND a.obs_date >= c.obs_date")
def difference_asof(spark, d):
    a, b = _ab(spark, d)
    return rounded(derived.difference_asof(a, b.filter(F.month("obs_date") % 4 == 1), ["series_id"]), "value")


_WEEKLY = f"WITH {A.PRICES}, o(rk, days) AS (VALUES {', '.join(f'({i}, {n})' for i, n in enumerate(derived.OFFSETS))})"


@query(f"""{_WEEKLY}, j AS (SELECT a.item, a.city, a.week AS obs_date, a.value, b.value AS past, days, row_number() OVER (PARTITION BY a.item, a.city, a.week ORDER BY rk) AS rn
FROM prices a JOIN prices b ON a.item = b.item AND a.city = b.city JOIN o ON a.week - b.week = days) SELECT item, city, obs_date, value, past, CAST(days AS INTEGER) AS days FROM j WHERE rn = 1""")
def offset_match(spark, d):
    return derived.offset_match(A.prices(spark, d).withColumnRenamed("week", "obs_date"), ["item", "city"])


_BASKET = "basket(item, qty) AS (VALUES ('PROMO', 2.0), ('ECONOMY', 0.5), ('STANDARD', 1.0))"


@query(f"""WITH {A.PRICES}, {_BASKET}, own AS (SELECT * FROM prices SEMI JOIN basket USING (item)), w AS (SELECT DISTINCT city, week FROM own),
c AS (SELECT w.city, w.week, b.qty, arg_max(p.value, p.week) AS value FROM w CROSS JOIN basket b JOIN own p ON p.city = w.city AND p.item = b.item AND p.week BETWEEN w.week - 28 AND w.week GROUP BY w.city, w.week, b.item, b.qty)
SELECT city, week AS obs_date, round(sum(qty * value), 4) AS value FROM c GROUP BY 1, 2 HAVING count(*) = 3""")
def basket_cost(spark, d):
    basket = spark.createDataFrame([("PROMO", 2.0), ("ECONOMY", 0.5), ("STANDARD", 1.0)], "item string, qty double")
    return rounded(derived.basket_cost(A.prices(spark, d).withColumnRenamed("week", "obs_date"), basket, ["city"], 28), "value", digits=4)


@query(f"""{_AB}, c AS (SELECT * FROM a WHERE month(obs_date) % 3 = 0), fx AS (SELECT last_day(CAST(o_orderdate AS DATE)) AS obs_date, avg(o_totalprice) / 1000 AS rate FROM orders GROUP BY 1),
e AS (SELECT s.series_id, fx.obs_date, rate FROM (SELECT series_id, min(obs_date) AS f FROM c GROUP BY 1) s JOIN fx ON fx.obs_date >= s.f AND fx.obs_date <= DATE '2000-12-31')
SELECT e.series_id, e.obs_date, round(c.value / rate, 4) AS value FROM e ASOF JOIN c ON e.series_id = c.series_id AND e.obs_date >= c.obs_date""")
def in_usd_month_end(spark, d):
    changes = _ab(spark, d)[0].filter(F.month("obs_date") % 3 == 0)
    fx = read_table(spark, d, "orders").groupBy(F.last_day(F.to_date("o_orderdate")).alias("obs_date")).agg((F.avg("o_totalprice") / 1000).alias("value"))
    return derived.in_usd_month_end(changes, fx, ["series_id"], F.lit("2000-12-31").cast("date"))


@query(f"""WITH {A.MONTHLY}, n AS (SELECT DISTINCT p_brand AS series_id, regexp_extract(p_brand, '#(\\d)(\\d)$', 1) AS kind, regexp_extract(p_brand, '#(\\d)(\\d)$', 2) AS tenor FROM part),
j AS (SELECT kind, tenor, obs_date, value, series_id, row_number() OVER (PARTITION BY kind, tenor, obs_date ORDER BY series_id, value) AS rn FROM monthly JOIN n USING (series_id) WHERE kind <> '' AND value BETWEEN 10000 AND 60000)
SELECT kind, tenor, obs_date, round(value, 6) AS value, series_id AS source_id FROM j WHERE rn = 1""")
def collect_mapped(spark, d):
    return rounded(derived.collect_mapped(A.catalog(spark, d), A.monthly(spark, d), r"#(\d)(\d)$", 10000, 60000), "value")


@query(f"""WITH {A.MONTHLY}, {A.PRICES}, x AS (SELECT obs_date, value FROM monthly WHERE series_id = 'Brand#12' AND dims_key LIKE '%"A"%'), y AS (SELECT obs_date, value FROM monthly WHERE series_id = 'Brand#13' AND dims_key LIKE '%"A"%'),
s AS (SELECT obs_date, round(x.value - y.value, 6) AS value FROM x JOIN y USING (obs_date) WHERE x.value - y.value BETWEEN -20000 AND 20000), f AS (SELECT last_day(CAST(o_orderdate AS DATE)) AS obs_date, median(o_totalprice / 2) AS value FROM orders WHERE o_orderstatus = 'F' GROUP BY 1)
SELECT 'spread' AS series_id, obs_date, value, CAST(1 AS INTEGER) AS version FROM s UNION ALL SELECT 'ratio', obs_date, round(100 * x.value / y.value, 6), 2 FROM x JOIN y USING (obs_date) WHERE 100 * x.value / y.value <= 120
UNION ALL SELECT 'spread_pct', obs_date, round(100 * s.value / x.value, 6), 1 FROM s JOIN x USING (obs_date) UNION ALL SELECT 'basket', week, round(sum(value), 6), 1 FROM prices WHERE city = (SELECT min(city) FROM prices) GROUP BY 2 HAVING sum(value) >= 1000
UNION ALL SELECT 'funds', obs_date, round(value, 6), 1 FROM f""")
def run_specs(spark, d):
    """Five indicators, of which one reads another's result; a city's prices and a category's funds are inputs too."""
    prices = A.prices(spark, d).withColumnRenamed("week", "obs_date")
    city = prices.agg(F.min("city")).first()[0]
    funds = read_table(spark, d, "orders").select(F.col("o_orderstatus").alias("category"), (F.col("o_custkey") % 50).alias("fund_id"), F.last_day(F.to_date("o_orderdate")).alias("obs_date"), F.col("o_totalprice").alias("d30"), (F.col("o_totalprice") / 2).alias("d365"))
    inputs = {"x": "Brand#12|flag=A", "y": "Brand#13|flag=A"}
    one = lambda agg: lambda i: i["p"].groupBy("obs_date").agg(agg("value").alias("value"))
    specs = [
        derived.Spec("spread_pct", {"s": "=spread", "x": "Brand#12|flag=A"}, lambda i: derived.share_pct(i["s"], i["x"], [])),
        derived.Spec("spread", inputs, lambda i: derived.difference(i["x"], i["y"], []), -20000, 20000),
        derived.Spec("ratio", inputs, lambda i: derived.share_pct(i["x"], i["y"], []), high=120, version=2),
        derived.Spec("basket", {"p": f"spi:{city}"}, one(F.sum), low=1000),
        derived.Spec("funds", {"p": "funds:F:d365"}, one(F.median)),
    ]
    return derived.run_specs(A.monthly(spark, d), specs, prices=prices, funds=funds)


_KEYS = "series_id, dims_key"


@query(f"""WITH {A.MONTHLY}, o AS (SELECT *, list_value('daily', 'weekly', 'Monthly', 'quarterly', 'survey')[1 + CAST(substring(series_id, 7) AS INTEGER) % 5] AS frequency FROM monthly), c AS (SELECT {_KEYS}, CAST(max(obs_date) - INTERVAL 36 MONTH AS DATE) AS cutoff FROM o GROUP BY 1, 2), j AS (SELECT * FROM o JOIN c USING ({_KEYS})),
s AS (SELECT {_KEYS}, CASE frequency WHEN 'daily' THEN CAST(date_trunc('week', obs_date) AS DATE) ELSE obs_date END AS slot, max(obs_date) AS obs_date, arg_max(value, obs_date) AS value FROM j WHERE obs_date >= cutoff GROUP BY ALL),
n AS (SELECT {_KEYS}, count(*) AS n_recent FROM s GROUP BY 1, 2), w AS (SELECT *, count(*) OVER k AS points FROM j WHERE obs_date < cutoff WINDOW k AS (PARTITION BY {_KEYS})),
u AS (SELECT w.*, CASE WHEN frequency IN ('daily', 'weekly') THEN CASE WHEN points > greatest(85 - coalesce(n_recent, 0), 8) THEN 'year' ELSE 'month' END WHEN frequency = 'Monthly' OR (frequency = 'quarterly' AND points > greatest(85 - coalesce(n_recent, 0), 8)) THEN 'year' END AS unit FROM w LEFT JOIN n USING ({_KEYS}))
SELECT {_KEYS}, obs_date, round(value, 6) AS value, NULL AS avg FROM s UNION ALL SELECT {_KEYS}, obs_date, round(value, 6), NULL FROM u WHERE unit IS NULL
UNION ALL SELECT {_KEYS}, CAST(date_trunc(unit, obs_date) AS DATE), round(round(avg(value) / pow(10.0, floor(log10(avg(value))) - 5)) * pow(10.0, floor(log10(avg(value))) - 5), 6), unit FROM u WHERE unit IS NOT NULL GROUP BY 1, 2, 3, 5""")
def chart_points(spark, d):
    kinds = F.array(*map(F.lit, ("daily", "weekly", "Monthly", "quarterly", "survey")))
    obs = A.monthly(spark, d).withColumn("frequency", F.get(kinds, F.substring("series_id", 7, 9).cast("int") % 5))
    return rounded(derived.chart_points(obs, 85, 3, 8), "value")


@query(f"""WITH {A.PRICES}, v AS (SELECT DISTINCT item, CASE WHEN ends_with(city, '2') THEN 'national' ELSE city END AS v FROM prices) SELECT item AS series_id, 'city' AS dim, coalesce(max(v) FILTER (v = 'national'), min(v)) AS val FROM v GROUP BY 1""")
def default_group(spark, d):
    city = F.when(F.col("city").endswith("2"), "national").otherwise(F.col("city"))
    obs = A.prices(spark, d).select(F.col("item").alias("series_id"), F.to_json(F.struct(city.alias("city"))).alias("dims_key"))
    return derived.default_group(obs, ["city", "side"])


_NOTICES = """raw AS (SELECT o_custkey % 40 AS fuel, row_number() OVER (PARTITION BY o_custkey % 40 ORDER BY o_orderdate DESC, o_orderkey) AS pos,
CAST(CASE WHEN o_orderkey % 23 = 0 THEN o_orderdate + INTERVAL 5 YEAR WHEN o_orderkey % 29 = 0 THEN o_orderdate - INTERVAL 2 YEAR ELSE o_orderdate END AS DATE) AS obs_date,
CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE (100 + o_orderkey % 20) * CASE WHEN o_orderkey % 17 = 0 THEN 10 WHEN o_orderkey % 19 = 0 THEN 0.1 ELSE 1 END END AS value FROM orders)"""


@query(f"""WITH RECURSIVE {_NOTICES}, s AS (SELECT *, row_number() OVER (PARTITION BY fuel ORDER BY pos) AS n, lead(obs_date) OVER (PARTITION BY fuel ORDER BY pos) AS older FROM raw WHERE value IS NOT NULL),
walk AS (SELECT fuel, n, obs_date AS newer, true AS kept FROM s WHERE n = 1 UNION ALL SELECT s.fuel, s.n, CASE WHEN x.bad THEN w.newer ELSE s.obs_date END, NOT x.bad FROM walk w JOIN s ON s.fuel = w.fuel AND s.n = w.n + 1,
LATERAL (SELECT coalesce(w.newer >= s.older AND (s.obs_date > w.newer OR s.obs_date < s.older), false) AS bad) x),
c AS (SELECT s.fuel, s.pos, s.obs_date, s.value, row_number() OVER (PARTITION BY s.fuel ORDER BY s.pos) AS m FROM s JOIN walk USING (fuel, n) WHERE kept),
j AS (SELECT c.*, o.value AS pv, y.value AS nv FROM c LEFT JOIN c o ON o.fuel = c.fuel AND o.m = c.m + 1 LEFT JOIN c y ON y.fuel = c.fuel AND y.m = c.m - 1),
g AS (SELECT fuel, pos, obs_date, value, row_number() OVER (PARTITION BY fuel, obs_date ORDER BY pos) AS rn FROM j WHERE NOT CASE WHEN pv IS NOT NULL AND nv IS NOT NULL THEN abs(pv / nv - 1) < 0.25 AND (value > 3 * pv AND value > 3 * nv OR 3 * value < pv AND 3 * value < nv)
WHEN pv IS NULL AND nv IS NULL THEN false ELSE value > 3 * coalesce(pv, nv) OR 3 * value < coalesce(pv, nv) END) SELECT fuel, pos, obs_date, CAST(value AS DOUBLE) AS value FROM g WHERE rn = 1""")
def price_notice_clean(spark, d):
    k, day = F.col("o_orderkey"), F.to_date("o_orderdate")
    pos = F.row_number().over(Window.partitionBy(F.col("o_custkey") % 40).orderBy(F.desc("o_orderdate"), "o_orderkey")).cast("long")
    date = F.when(k % 23 == 0, F.add_months(day, 60)).when(k % 29 == 0, F.add_months(day, -24)).otherwise(day)
    value = F.when(k % 31 != 0, (100 + k % 20) * F.when(k % 17 == 0, 10.0).when(k % 19 == 0, 0.1).otherwise(1.0))
    return derived.price_notices(read_table(spark, d, "orders").select((F.col("o_custkey") % 40).alias("fuel"), pos.alias("pos"), date.alias("obs_date"), value.alias("value")), ["fuel"], "pos")


_HOURS = "hours AS (SELECT event_type AS series_id, date_trunc('hour', ts) AS hour, sum(value) AS value FROM events GROUP BY 1, 2)"


def _hours(spark, d):
    return read_table(spark, d, "events").groupBy(F.col("event_type").alias("series_id"), F.date_trunc("hour", "ts").alias("hour")).agg(F.sum("value").alias("value"))


@query(f"WITH {_HOURS} SELECT series_id, CAST(hour AS DATE) AS obs_date, round(avg(value), 6) AS average, round(max(value), 6) AS peak FROM hours GROUP BY 1, 2 HAVING count(value) >= 20")
def daily_avg_peak(spark, d):
    return rounded(derived.daily_peaks(_hours(spark, d), ["series_id"]), "average", "peak")


@query(f"WITH {A.DAILY} SELECT series_id, last_day(obs_date) AS month, round(avg(value), 6) AS value FROM daily GROUP BY 1, 2 HAVING count(DISTINCT obs_date) >= day(last_day(max(obs_date))) - 1")
def daily_to_monthly(spark, d):
    return rounded(derived.daily_to_monthly(A.daily(spark, d), ["series_id"]), "value")


@query("""WITH h AS (SELECT date_trunc('hour', ts) AS hour, 'plant_' || CAST(user_id % 9 AS VARCHAR) AS plant, event_type AS fuel, value AS kwh FROM events)
SELECT CAST(hour AS DATE) AS obs_date, plant, fuel, round(sum(kwh) / 1000, 6) AS mwh FROM h GROUP BY 1, 2, 3 UNION ALL SELECT CAST(hour AS DATE), 'all', fuel, round(sum(kwh) / 1000, 6) FROM h GROUP BY 1, 3""")
def plant_daily(spark, d):
    h = read_table(spark, d, "events").select(F.date_trunc("hour", "ts").alias("hour"), F.concat(F.lit("plant_"), (F.col("user_id") % 9).cast("string")).alias("plant"), F.col("event_type").alias("fuel"), F.col("value").alias("kwh"))
    return rounded(derived.plant_daily(h), "mwh")


@query(f"""WITH {A.CALLS}, c AS (SELECT port, direction, CASE vessel % 4 WHEN 0 THEN 'containers' WHEN 1 THEN 'break_bulk' WHEN 2 THEN 'bulk' ELSE 'liquid' END AS own, tonnes FROM calls),
w(own, cargo) AS (VALUES ('containers', 'containers'), ('break_bulk', 'break_bulk'), ('bulk', 'bulk'), ('liquid', 'liquid'), ('containers', 'general'), ('break_bulk', 'general'), ('containers', 'dry'), ('break_bulk', 'dry'), ('bulk', 'dry'), ('containers', 'all'), ('break_bulk', 'all'), ('bulk', 'all'), ('liquid', 'all'))
SELECT port, coalesce(direction, 'all') AS direction, cargo, round(sum(tonnes), 2) AS tonnes FROM c JOIN w USING (own) GROUP BY GROUPING SETS ((port, direction, cargo), (port, cargo))""")
def cargo_types(spark, d):
    kind = F.element_at(F.array(*map(F.lit, ("containers", "break_bulk", "bulk", "liquid"))), (F.col("vessel") % 4 + 1).cast("int"))
    return rounded(derived.cargo_types(A.calls(spark, d).select("port", "direction", kind.alias("cargo"), "tonnes"), ["port"]), "tonnes", digits=2)


@query(f"WITH {A.CALLS} SELECT port, commodity, coalesce(direction, 'all') AS direction, round(sum(tonnes), 2) AS value FROM calls GROUP BY GROUPING SETS ((port, commodity, direction), (port, commodity))")
def all_direction_sums(spark, d):
    return rounded(derived.all_direction_sums(A.calls(spark, d).withColumnRenamed("tonnes", "value"), ["port", "commodity"]), "value", digits=2)


@query("""WITH p AS (SELECT o_custkey AS fund_id, last_day(CAST(o_orderdate AS DATE)) AS as_of, o_orderpriority AS asset, sum(o_totalprice) AS weight FROM orders GROUP BY 1, 2, 3), r AS (SELECT *, rank() OVER (PARTITION BY fund_id ORDER BY as_of DESC) AS k FROM p)
SELECT fund_id, as_of, asset, round(weight, 2) AS weight, row_number() OVER (PARTITION BY fund_id ORDER BY weight DESC, asset) AS place FROM r WHERE k = 1""")
def latest_allocation(spark, d):
    p = read_table(spark, d, "orders").groupBy(F.col("o_custkey").alias("fund_id"), F.last_day(F.to_date("o_orderdate")).alias("as_of"), F.col("o_orderpriority").alias("asset")).agg(F.sum("o_totalprice").alias("weight"))
    return rounded(derived.latest_allocation(p), "weight", digits=2)


_CENSUS = "census AS (SELECT o_orderstatus AS indicator, o_custkey % 40 AS district, make_date(year(o_orderdate), 1, 1) AS obs_date, sum(o_totalprice) AS value FROM orders WHERE o_custkey % 40 <> 5 OR year(o_orderdate) < 1999 GROUP BY 1, 2, 3)"


@query(f"WITH {_CENSUS}, a AS (SELECT DISTINCT district FROM census WHERE obs_date = (SELECT max(obs_date) FROM census)) SELECT district, " + ", ".join(f"round(arg_max(value, obs_date) FILTER (indicator = '{k}'), 2) AS {k}" for k in "FOP") + " FROM census SEMI JOIN a USING (district) GROUP BY 1")
def districts_index(spark, d):
    o = read_table(spark, d, "orders").filter("o_custkey % 40 <> 5 or year(o_orderdate) < 1999")
    census = o.groupBy(F.col("o_orderstatus").alias("indicator"), (F.col("o_custkey") % 40).alias("district"), F.make_date(F.year("o_orderdate"), F.lit(1), F.lit(1)).alias("obs_date")).agg(F.sum("o_totalprice").alias("value"))
    return rounded(derived.districts_index(census, ["F", "O", "P"]), "F", "O", "P", digits=2)


@query(f"""WITH {A.DAILY}, c AS (SELECT series_id AS berth, dims_key AS line, obs_date AS day, floor(value) AS last_24h, sum(floor(value)) OVER (PARTITION BY series_id, dims_key ORDER BY obs_date) - floor(value) + CASE WHEN day(obs_date) = 9 THEN 5 ELSE 0 END AS before FROM daily)
SELECT c.berth, c.line, c.day, CASE WHEN p.day IS NULL THEN NULL WHEN abs(p.before + p.last_24h - c.before) <= 1 THEN 'ok' ELSE 'broken' END AS chain FROM c LEFT JOIN c p ON p.berth = c.berth AND p.line = c.line AND p.day = c.day - 1""")
def prev_day_chain(spark, d):
    n = F.floor("value").cast("double")
    total = F.sum(n).over(Window.partitionBy("series_id", "dims_key").orderBy("obs_date"))
    calls = A.daily(spark, d).select(F.col("series_id").alias("berth"), F.col("dims_key").alias("line"), F.col("obs_date").alias("day"), n.alias("last_24h"), (total - n + F.when(F.dayofmonth("obs_date") == 9, 5).otherwise(0)).alias("before"))
    return derived.prev_day_chain(calls, ["berth", "line"]).select("berth", "line", "day", "chain")


@query(f"""WITH {A.MONTHLY}, {A.CATALOG}, u AS (SELECT DISTINCT series_id FROM monthly WHERE obs_date >= DATE '2001-10-01'), h AS (SELECT s_suppkey AS hook_id, CASE WHEN s_suppkey % 2 = 0 THEN 'Brand#' || CAST(s_suppkey % 25 AS VARCHAR) END AS series_id, CASE WHEN s_suppkey % 3 = 0 THEN 'module_' || CAST(s_suppkey % 5 AS VARCHAR) END AS module FROM supplier),
l AS (SELECT series_id, arg_max(value, (obs_date, dims_key)) AS value FROM monthly GROUP BY 1) SELECT DISTINCT hook_id, u.series_id, round(value, 6) AS value FROM u JOIN catalog c USING (series_id) JOIN h ON h.series_id = u.series_id OR h.module = c.module LEFT JOIN l ON l.series_id = u.series_id""")
def webhook_matches(spark, d):
    m, k = A.monthly(spark, d), F.col("s_suppkey")
    hooks = read_table(spark, d, "supplier").select(k.alias("hook_id"), F.when(k % 2 == 0, F.concat(F.lit("Brand#"), (k % 25).cast("string"))).alias("series_id"), F.when(k % 3 == 0, F.concat(F.lit("module_"), (k % 5).cast("string"))).alias("module"))
    latest = m.groupBy("series_id").agg(F.max_by("value", F.struct("obs_date", "dims_key")).alias("value"))
    return rounded(derived.webhook_matches(m.filter("obs_date >= DATE '2001-10-01'"), hooks, A.catalog(spark, d), latest), "value")


@query(f"WITH {A.NAVS} SELECT c_custkey AS fund_id, c_name FROM customer WHERE c_custkey IN (SELECT fund_id FROM navs WHERE obs_date > DATE '2001-07-30' - 60)")
def entities_seen_recently(spark, d):
    funds = read_table(spark, d, "customer").select(F.col("c_custkey").alias("fund_id"), "c_name")
    return derived.seen_recently(funds, A.navs(spark, d), "fund_id", F.lit("2001-07-30").cast("date"))


@query(f"""WITH {A.PRICES} SELECT item AS commodity, city AS market, max(week) AS obs_date, arg_max(value, week) AS value FROM prices WHERE item IN ('PROMO', 'ECONOMY') AND week BETWEEN DATE '2000-06-02' AND DATE '2000-06-02' + 60 GROUP BY 1, 2""")
def crop_across_regions(spark, d):
    prices = A.prices(spark, d).select(F.col("item").alias("commodity"), F.col("city").alias("market"), F.col("week").alias("obs_date"), "value")
    crops = prices.select("commodity").distinct().withColumn("crop", F.when(F.col("commodity").isin("PROMO", "ECONOMY"), "wheat").otherwise("rice"))
    return derived.crop_across_regions(prices, crops, "wheat", F.lit("2000-08-01").cast("date"), 60)


@query(f"""WITH {A.NAVS}, r AS (SELECT *, row_number() OVER (PARTITION BY fund_id ORDER BY obs_date DESC) AS k FROM navs) SELECT c.c_custkey AS code, a.obs_date, round(a.nav, 6) AS value, round(a.nav - b.nav, 6) AS change FROM customer c LEFT JOIN r a ON a.fund_id = c_custkey AND a.k = 1 LEFT JOIN r b ON b.fund_id = c_custkey AND b.k = 2""")
def securities_latest(spark, d):
    prices = A.navs(spark, d).select(F.col("fund_id").alias("code"), "obs_date", F.col("nav").alias("value"))
    return rounded(derived.securities_latest(read_table(spark, d, "customer").select(F.col("c_custkey").alias("code")), prices), "value", "change")


@query(f"WITH {A.MONTHLY}, {A.CATALOG}, r AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY obs_date DESC, dims_key DESC) AS k FROM monthly) SELECT c.series_id, name, obs_date, dims_key, round(value, 6) AS value FROM catalog c LEFT JOIN r ON r.series_id = c.series_id AND k = 1")
def derived_hub(spark, d):
    return rounded(derived.derived_hub(A.catalog(spark, d), A.monthly(spark, d)), "value")


@query(f"WITH {A.TRADE}, {A.RATES}, s AS (SELECT country, flow, fy, sum(value) AS value FROM trade GROUP BY 1, 2, 3) SELECT country, flow, fy, round(value, 2) AS value, round(value / rate, 4) AS value_fx FROM s LEFT JOIN rates USING (fy)")
def partner_history(spark, d):
    return rounded(rounded(derived.partner_history(A.trade(spark, d), A.rates(spark, d)), "value_fx", digits=4), "value", digits=2)


@query(f"""WITH {A.TRADE}, s AS (SELECT flow, country, sum(value) AS value FROM trade GROUP BY 1, 2), t AS (SELECT flow, sum(value) AS total, count(*) AS ranked FROM s GROUP BY 1)
SELECT flow, country, round(value, 2) AS value, (SELECT count(*) FROM s x WHERE x.flow = s.flow AND x.value > s.value) + 1 AS place, ranked, round(100 * value / total, 4) AS share_pct FROM s JOIN t USING (flow)""")
def rank_and_share(spark, d):
    return rounded(rounded(derived.rank_and_share(A.trade(spark, d)), "share_pct", digits=4), "value", digits=2)
