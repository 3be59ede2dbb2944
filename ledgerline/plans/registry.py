"""Named queries over the given tables, each with the SQL it must agree with."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators import facts, merge, reads, series
from ledgerline.plans import adapters as A
from ledgerline.sources.tables import read_table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def rounded(df: DataFrame, *cols: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in cols})


@query(f"""WITH {A.TRADE}, {A.RATES}, s AS (SELECT flow, fy, country, sum(value) AS value FROM trade GROUP BY 1, 2, 3)
SELECT flow, fy, country, round(value, 2) AS value, round(100 * value / sum(value) OVER (PARTITION BY flow, fy), 4) AS share_pct,
  round(value / rate, 4) AS value_fx, row_number() OVER (PARTITION BY flow, fy ORDER BY value DESC, country) AS place
FROM s LEFT JOIN rates USING (fy)""")
def rank_partners(spark, d):
    return rounded(facts.rank_partners(A.trade(spark, d), A.rates(spark, d)), "share_pct", "value_fx", digits=4).withColumn("value", F.round("value", 2))


@query(f"""WITH {A.TRADE} SELECT code, fy, round(sum(value) FILTER (flow = 'A'), 2) AS A, round(sum(value) FILTER (flow = 'N'), 2) AS N,
  round(sum(value) FILTER (flow = 'R'), 2) AS R FROM trade GROUP BY 1, 2""")
def product_history(spark, d):
    return rounded(facts.product_history(A.trade(spark, d), ["A", "N", "R"]), "A", "N", "R", digits=2)


_FLOWS = "two AS (SELECT CASE flow WHEN 'A' THEN 'export' WHEN 'R' THEN 'import' ELSE 'other' END AS flow, fy, code, country, value FROM trade)"
_PAGES = f"""{A.TRADE}, {A.RATES}, {_FLOWS}, newest AS (SELECT max(fy) AS fy FROM two),
fx AS (SELECT code, flow, value / rate / 3 AS v FROM two JOIN rates USING (fy) WHERE fy > (SELECT fy FROM newest) - 3 AND length(code) = 8),
by_code AS (SELECT code, coalesce(sum(v) FILTER (flow = 'export'), 0) AS ex, coalesce(sum(v) FILTER (flow = 'import'), 0) AS im FROM fx WHERE flow <> 'other' GROUP BY 1),
pages AS (SELECT code AS page, 'code' AS kind, left(code, 4) AS heading, ex, im FROM by_code UNION ALL SELECT left(code, 4), 'heading', left(code, 4), sum(ex), sum(im) FROM by_code GROUP BY 1)"""


def _pages(spark, d):
    flow = F.when(F.col("flow") == "A", "export").when(F.col("flow") == "R", "import").otherwise("other")
    return facts.page_index(A.trade(spark, d).withColumn("flow", flow), A.rates(spark, d))


@query(f"WITH {_PAGES} SELECT page, kind, heading, round(ex, 4) AS export, round(im, 4) AS import FROM pages")
def page_index(spark, d):
    return rounded(_pages(spark, d), "export", "import", digits=4)


@query(f"""WITH {_PAGES} SELECT p.page, p.kind, CASE WHEN p.kind = 'heading' THEN p.ex + p.im >= 1000 ELSE p.ex + p.im >= 500 AND p.ex + p.im < 0.9 * (h.ex + h.im) END AS indexable
FROM pages p JOIN pages h ON h.kind = 'heading' AND h.page = p.heading""")
def indexable(spark, d):
    return facts.indexable(_pages(spark, d), code_least=500).select("page", "kind", "indexable")


@query(f"""WITH {A.TRADE}, s AS (SELECT flow, country, code, sum(value) AS value FROM trade GROUP BY 1, 2, 3),
r AS (SELECT *, row_number() OVER (PARTITION BY flow, country ORDER BY value DESC, code) AS place FROM s)
SELECT flow, country, code, round(value, 2) AS value, place FROM r WHERE place <= 10""")
def top_products(spark, d):
    s = A.trade(spark, d).groupBy("flow", "country", "code").agg(F.sum("value").alias("value"))
    return rounded(facts.top_n_per_group(s, ["flow", "country"], [F.desc("value"), F.col("code")], 10), "value", digits=2)


def _series(name: str):
    return f"SELECT series_id, dims_key, obs_date, round(value, 6) AS value, round({name}, 6) AS result FROM "


@query(f"WITH {A.MONTHLY}, l AS (SELECT *, lag(value) OVER (PARTITION BY series_id, dims_key ORDER BY obs_date) AS p FROM monthly) " + _series("CASE WHEN p <> 0 THEN (value / p - 1) * 100 END") + "l")
def pct_change(spark, d):
    return rounded(series.pct_change(A.monthly(spark, d)), "value", "result")


@query(f"""WITH {A.MONTHLY} SELECT a.series_id, a.dims_key, a.obs_date, round(a.value, 6) AS value,
  round(CASE WHEN b.value <> 0 THEN (a.value / b.value - 1) * 100 END, 6) AS result
FROM monthly a LEFT JOIN monthly b ON a.series_id = b.series_id AND a.dims_key = b.dims_key AND b.obs_date = last_day(a.obs_date - INTERVAL 12 MONTH)""")
def yoy(spark, d):
    return rounded(series.against_month(A.monthly(spark, d), 12, month_ends=True), "value", "result")


@query(f"""WITH {A.MONTHLY} SELECT a.series_id, a.dims_key, a.obs_date, round(a.value, 6) AS value,
  round(CASE WHEN b.value <> 0 THEN (a.value / b.value - 1) * 100 END, 6) AS result
FROM monthly a LEFT JOIN monthly b ON a.series_id = b.series_id AND a.dims_key = b.dims_key AND b.obs_date = last_day(date_trunc('month', a.obs_date) - INTERVAL 1 DAY)""")
def mom(spark, d):
    return rounded(series.against_month(A.monthly(spark, d), 1, month_ends=True), "value", "result")


_SLOW = """slow AS (SELECT p_brand AS series_id, kind AS dims_key, CASE kind WHEN 'weekly' THEN CAST(date_trunc('week', l_shipdate) AS DATE) + 4 WHEN 'monthly' THEN CAST(date_trunc('month', l_shipdate) AS DATE) + 14
  WHEN 'quarterly' THEN CAST(date_trunc('quarter', l_shipdate) AS DATE) ELSE CAST(date_trunc('year', l_shipdate) AS DATE) END AS obs_date, sum(l_extendedprice) AS value
  FROM lineitem JOIN part ON l_partkey = p_partkey, (VALUES ('weekly'), ('monthly'), ('quarterly'), ('annual')) k(kind) GROUP BY 1, 2, 3)"""


def _slow(spark, d):
    """Points by frequency: weeks dated on Fridays, months in their middle, quarters and years on their first day."""
    j = read_table(spark, d, "lineitem").join(read_table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    start = lambda unit, days: F.date_add(F.to_date(F.date_trunc(unit, "l_shipdate")), days)
    kinds = {"weekly": start("week", 4), "monthly": start("month", 14), "quarterly": start("quarter", 0), "annual": start("year", 0)}
    e = F.explode(F.array(*[F.struct(F.lit(k).alias("dims_key"), c.alias("obs_date")) for k, c in kinds.items()]))
    return j.select(F.col("p_brand").alias("series_id"), e.alias("e"), "l_extendedprice").groupBy("series_id", "e.dims_key", "e.obs_date").agg(F.sum("l_extendedprice").alias("value"))


@query(f"""WITH {_SLOW} SELECT a.series_id, a.dims_key, a.obs_date, round(a.value, 2) AS value, round(CASE WHEN b.value <> 0 THEN (a.value / b.value - 1) * 100 END, 6) AS result
FROM slow a LEFT JOIN slow b ON a.series_id = b.series_id AND a.dims_key = b.dims_key AND b.obs_date = a.obs_date - INTERVAL 12 MONTH""")
def yoy_frequencies(spark, d):
    return rounded(rounded(series.against_month(_slow(spark, d), 12), "value", digits=2), "result")


_LOOK = {"weekly": 63, "monthly": 135, "quarterly": 360, "annual": 1200}


@query(f"""WITH {_SLOW}, w AS (SELECT * FROM slow WHERE obs_date >= DATE '1996-02-10' - CASE dims_key {' '.join(f"WHEN '{k}' THEN {v}" for k, v in _LOOK.items())} END),
n AS (SELECT *, row_number() OVER (PARTITION BY series_id, dims_key ORDER BY obs_date) AS rn FROM w)
SELECT a.series_id, a.dims_key, a.obs_date, round(a.value, 2) AS value, round((a.value + b.value + c.value) / 3, 4) AS result FROM n a
LEFT JOIN n b ON b.series_id = a.series_id AND b.dims_key = a.dims_key AND b.rn = a.rn - 1 LEFT JOIN n c ON c.series_id = a.series_id AND c.dims_key = a.dims_key AND c.rn = a.rn - 2 WHERE a.obs_date >= DATE '1996-02-10'""")
def transform_ma3(spark, d):
    slow = _slow(spark, d)
    parts = [reads.transform(slow.filter(F.col("dims_key") == k), "3ma", k, "1996-02-10") for k in _LOOK]
    return rounded(rounded(reduce(DataFrame.unionByName, parts), "value", digits=2), "result", digits=4)


_W3 = "OVER (PARTITION BY series_id, dims_key ORDER BY obs_date ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"


@query(f"WITH {A.DAILY}, l AS (SELECT *, avg(value) {_W3} AS m, count(value) {_W3} AS n FROM daily) " + _series("CASE WHEN n = 3 THEN m END") + "l")
def ma3(spark, d):
    return rounded(series.ma3(A.daily(spark, d)), "value", "result")


@query(f"WITH {A.MONTHLY}, l AS (SELECT *, first_value(value IGNORE NULLS) OVER (PARTITION BY series_id, dims_key ORDER BY obs_date ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS b FROM monthly) " + _series("CASE WHEN b <> 0 THEN value / b * 100 END") + "l")
def index_100(spark, d):
    return rounded(series.index_100(A.monthly(spark, d)), "value", "result")


@query(f"WITH {A.MONTHLY}, l AS (SELECT *, row_number() OVER (PARTITION BY series_id, dims_key ORDER BY obs_date DESC) AS rn FROM monthly) SELECT series_id, dims_key, obs_date, round(value, 6) AS value FROM l WHERE rn = 1")
def latest(spark, d):
    return rounded(series.latest(A.monthly(spark, d)), "value")


_ROLL = f"""WITH {A.MONTHLY}, m AS (SELECT *, year(obs_date) * 12 + month(obs_date) AS no FROM monthly),
r AS (SELECT *, count(value) OVER w AS n, sum(value) OVER w AS s FROM m WINDOW w AS (PARTITION BY series_id, dims_key ORDER BY no RANGE BETWEEN %d PRECEDING AND CURRENT ROW)) """


@query(_ROLL % 11 + _series("s") + "r WHERE n = 12")
def rolling_sum_months(spark, d):
    return rounded(series.rolling_sum_months(A.monthly(spark, d), 12), "value", "result")


@query(f"""WITH {A.MONTHLY}, den AS (SELECT series_id, dims_key, obs_date, value + 1000 * month(obs_date) AS v FROM monthly),
t AS (SELECT a.series_id, a.dims_key, a.obs_date, sum(b.v) AS s FROM den a JOIN den b ON a.series_id = b.series_id AND a.dims_key = b.dims_key AND datediff('month', b.obs_date, a.obs_date) BETWEEN 0 AND 2 GROUP BY 1, 2, 3 HAVING count(b.v) = 3)
SELECT series_id, dims_key, obs_date, round(value, 6) AS value, round(3 * value / s, 6) AS result FROM monthly JOIN t USING (series_id, dims_key, obs_date) WHERE s > 0""")
def ratio_to_trailing_mean(spark, d):
    m = A.monthly(spark, d)
    return rounded(series.ratio_to_trailing_mean(m, m.withColumn("value", F.col("value") + 1000 * F.month("obs_date")), 3), "value", "result")


@query(f"WITH {A.DAILY} SELECT series_id, dims_key, last_day(obs_date) AS obs_date, round(avg(value), 6) AS result FROM daily GROUP BY 1, 2, 3 HAVING count(value) >= 20")
def monthly_mean(spark, d):
    return rounded(series.monthly_mean(A.daily(spark, d), 20), "result")


_STEPS = "SELECT o_orderpriority AS k, CAST(o_orderdate AS DATE) AS obs_date, max(o_totalprice) AS value FROM orders WHERE o_orderstatus = 'F' GROUP BY 1, 2"


@query(f"""WITH c AS ({_STEPS}), t AS (SELECT DISTINCT o_orderpriority AS k, last_day(CAST(o_orderdate AS DATE)) AS obs_date FROM orders)
SELECT t.k, t.obs_date, round(c.value, 6) AS in_force FROM t ASOF JOIN c ON t.k = c.k AND t.obs_date >= c.obs_date""")
def step_asof(spark, d):
    o = read_table(spark, d, "orders").withColumn("k", F.col("o_orderpriority"))
    changes = o.filter("o_orderstatus = 'F'").groupBy("k", F.to_date("o_orderdate").alias("obs_date")).agg(F.max("o_totalprice").alias("value"))
    dates = o.select("k", F.last_day(F.to_date("o_orderdate")).alias("obs_date")).distinct()
    return rounded(series.step_asof(changes, dates, ["k"]), "in_force")


@query(f"""WITH c AS ({_STEPS}), t AS (SELECT DISTINCT o_orderpriority AS k, last_day(CAST(o_orderdate AS DATE)) AS target FROM orders), j AS (
SELECT t.k, target, c.value, target - c.obs_date AS days_back, row_number() OVER (PARTITION BY t.k, target ORDER BY c.obs_date DESC) AS rn
FROM t JOIN c ON t.k = c.k AND c.obs_date BETWEEN target - 7 AND target)
SELECT k, target, round(value, 6) AS value, CAST(days_back AS INTEGER) AS days_back FROM j WHERE rn = 1""")
def nearest_prior(spark, d):
    o = read_table(spark, d, "orders").withColumn("k", F.col("o_orderpriority"))
    points = o.filter("o_orderstatus = 'F'").groupBy("k", F.to_date("o_orderdate").alias("obs_date")).agg(F.max("o_totalprice").alias("value"))
    return rounded(facts.nearest_prior(points, o.select("k", F.last_day(F.to_date("o_orderdate")).alias("target")).distinct(), ["k"]), "value")


@query("""WITH s AS (SELECT o_custkey AS k, CAST(o_orderdate AS DATE) AS obs_date, min(o_totalprice) AS value, CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS p
FROM orders GROUP BY 1, 2, 4), r AS (SELECT *, row_number() OVER (PARTITION BY k, obs_date ORDER BY p) AS rn FROM s)
SELECT k, obs_date, round(value, 6) AS value, CAST(p AS INTEGER) AS source_no FROM r WHERE rn = 1""")
def splice(spark, d):
    o = read_table(spark, d, "orders").select(F.col("o_custkey").alias("k"), F.to_date("o_orderdate").alias("obs_date"), F.col("o_totalprice").alias("value"), "o_orderstatus")
    sources = [o.filter(F.col("o_orderstatus") == s).groupBy("k", "obs_date").agg(F.min("value").alias("value")) for s in ("F", "O", "P")]
    return rounded(series.splice(sources, ["k", "obs_date"]), "value")


_FLAT = """flat AS (SELECT event_type AS series_id, '{}' AS dims_key, CAST(ts AS DATE) AS obs_date, CAST(count(*) // 40 AS DOUBLE) AS value FROM events GROUP BY 1, 2, 3)"""


def _flat(spark, d):
    e = read_table(spark, d, "events").groupBy(F.col("event_type").alias("series_id"), F.lit("{}").alias("dims_key"), F.to_date("ts").alias("obs_date")).agg(F.count(F.lit(1)).alias("n"))
    return e.select("series_id", "dims_key", "obs_date", F.floor(F.col("n") / 40).cast("double").alias("value"))


@query(f"""WITH {_FLAT}, c AS (SELECT *, CASE WHEN value IS NOT DISTINCT FROM lag(value) OVER (PARTITION BY series_id, dims_key ORDER BY obs_date) THEN 0 ELSE 1 END AS ch FROM flat),
r AS (SELECT *, sum(ch) OVER (PARTITION BY series_id, dims_key ORDER BY obs_date) AS run FROM c)
SELECT series_id, dims_key, value, min(obs_date) AS start_date, max(obs_date) AS end_date, count(*) AS length FROM r WHERE value <> 0 GROUP BY series_id, dims_key, run, value HAVING count(*) >= 2""")
def flat_runs(spark, d):
    return series.flat_runs(_flat(spark, d), 2)


_OUT = "SELECT series_id, dims_key, obs_date, round(value, 6) AS value, round(pv, 6) AS pv, round(nv, 6) AS nv"
_UNITS = f"{A.CATALOG}, units AS (SELECT series_id, unit FROM catalog WHERE is_active)"
_NUMBERED = A.around("monthly", series.KEY)


@query(f"""WITH {A.MONTHLY}, {_UNITS}, {_NUMBERED} {_OUT} FROM around JOIN units USING (series_id)
WHERE unit <> 'percent' AND value * pv > 0 AND value * nv > 0 AND pv / nv > 0.7 AND pv / nv < 1.3 AND NOT value / pv BETWEEN 1.0 / 3 AND 3""")
def spike_level(spark, d):
    return rounded(series.spike_level(series.neighbours(A.monthly(spark, d)), A.catalog(spark, d)), "value", "pv", "nv")


_SLIP = """slip AS (SELECT series_id, dims_key, obs_date, value * CASE WHEN (year(obs_date) + month(obs_date)) % 7 = 0 THEN 1000 ELSE 1 END AS value FROM monthly)"""
_MID = "exp((ln(abs(pv)) + ln(abs(nv))) / 2)"
_SLIPS = f"""{A.MONTHLY}, {_UNITS}, {_SLIP}, {A.around("slip", series.KEY)}, agreed AS (SELECT *, least(abs(pv), abs(nv)) AS lo, greatest(abs(pv), abs(nv)) AS hi FROM around JOIN units USING (series_id)
WHERE unit NOT IN ('percent', 'index', 'ratio') AND value * pv > 0 AND value * nv > 0 AND pv / nv BETWEEN 0.67 AND 1.5),
found AS (SELECT *, pow(1000.0, round(ln(abs(value) / {_MID}) / ln(1000.0))) AS factor FROM agreed WHERE lo >= 1)"""


def _slipped(spark, d):
    return A.monthly(spark, d).withColumn("value", F.col("value") * F.when((F.year("obs_date") + F.month("obs_date")) % 7 == 0, 1000).otherwise(1))


@query(f"""WITH {A.MONTHLY}, {_UNITS}, {_SLIP}, {A.around("slip", series.KEY)}, rates AS (SELECT * FROM around JOIN units USING (series_id) WHERE unit = 'percent'),
usual AS (SELECT series_id, dims_key, quantile_cont(CASE WHEN value > pv THEN value - pv ELSE pv - value END, 0.5) AS move FROM rates GROUP BY 1, 2)
{_OUT}, round(move, 6) AS mad FROM rates JOIN usual USING (series_id, dims_key)
WHERE pv - nv BETWEEN -greatest(0.2, 2 * move) AND greatest(0.2, 2 * move) AND NOT 2 * value - pv - nv BETWEEN -greatest(2.0, 16 * move) AND greatest(2.0, 16 * move)""")
def spike_rate(spark, d):
    return rounded(series.spike_rate(series.neighbours(_slipped(spark, d)), A.catalog(spark, d)), "value", "pv", "nv", "mad")


def _slips(spark, d):
    m = _slipped(spark, d)
    return m, series.scale_slips(series.neighbours(m), A.catalog(spark, d))


@query(f"WITH {_SLIPS} {_OUT}, factor FROM found WHERE factor <> 1 AND abs(value) / factor >= lo * 4 / 5 AND abs(value) / factor <= hi * 5 / 4")
def scale_slips(spark, d):
    return rounded(_slips(spark, d)[1], "value", "pv", "nv")


_POINT = "o_orderpriority AS series_id, CAST(o_orderdate AS DATE) AS obs_date, CAST(o_custkey % 20 AS VARCHAR) AS dims_key"


def _points(spark, d):
    return read_table(spark, d, "orders").select(F.col("o_orderpriority").alias("series_id"), F.to_date("o_orderdate").alias("obs_date"), (F.col("o_custkey") % 20).cast("string").alias("dims_key"), F.col("o_totalprice").alias("value"), F.col("o_orderkey").alias("seq"))


def _last(where: str = "") -> str:
    return f"(SELECT series_id, obs_date, dims_key, value, seq FROM (SELECT *, row_number() OVER (PARTITION BY series_id, obs_date, dims_key ORDER BY seq DESC) AS rn FROM (SELECT {_POINT}, o_totalprice AS value, o_orderkey AS seq FROM orders {where})) WHERE rn = 1)"


@query(f"SELECT * FROM {_last()}")
def dedupe_last(spark, d):
    return merge.dedupe_last(_points(spark, d), merge.POINT, "seq")


@query(f"""WITH s AS {_last('WHERE o_orderkey % 3 <> 0')}, i AS {_last('WHERE o_orderkey % 3 <> 1')}, o AS (SELECT *, seq % 5 = 0 AS flagged FROM s), n AS (SELECT *, seq % 10 = 0 AS flagged FROM i),
j AS (SELECT *, CASE WHEN o.seq IS NULL THEN 'new' WHEN n.seq IS NULL THEN 'kept' WHEN o.value IS DISTINCT FROM n.value THEN 'changed' WHEN o.flagged IS DISTINCT FROM n.flagged THEN 'flagged' ELSE 'same' END AS act FROM o FULL OUTER JOIN n ON o.series_id = n.series_id AND o.obs_date = n.obs_date AND o.dims_key = n.dims_key)
SELECT coalesce(j.series_id, j.series_id_1) AS series_id, coalesce(j.obs_date, j.obs_date_1) AS obs_date, coalesce(j.dims_key, j.dims_key_1) AS dims_key, CASE act WHEN 'kept' THEN value ELSE value_1 END AS value, CASE act WHEN 'kept' THEN flagged ELSE flagged_1 END AS flagged,
CASE WHEN act IN ('new', 'changed') THEN TIMESTAMP '2024-01-01' ELSE TIMESTAMP '2020-01-01' END AS revised_at, CASE act WHEN 'new' THEN TIMESTAMP '2024-01-01' ELSE TIMESTAMP '2020-01-01' END AS first_seen_at,
act AS action, CASE act WHEN 'changed' THEN value END AS prior_value FROM j""")
def merge_observations(spark, d):
    p, old = _points(spark, d), F.lit("2020-01-01").cast("timestamp")
    stored = merge.dedupe_last(p.filter("seq % 3 <> 0"), merge.POINT, "seq").select(*merge.POINT, "value", (F.col("seq") % 5 == 0).alias("flagged"), old.alias("revised_at"), old.alias("first_seen_at"))
    batch = merge.dedupe_last(p.filter("seq % 3 <> 1"), merge.POINT, "seq").withColumn("flagged", F.col("seq") % 10 == 0)
    return merge.merge_observations(stored, batch, F.lit("2024-01-01").cast("timestamp"))


_WIDE = """obs AS (SELECT p_brand AS series_id, CASE l_linenumber % 3 WHEN 0 THEN '{"flag":"' || l_returnflag || '"}' WHEN 1 THEN '{"flag":"' || l_returnflag || '","mode":"' || CAST(l_suppkey % 4 AS VARCHAR) || '"}' ELSE '{"mode":"' || CAST(l_suppkey % 4 AS VARCHAR) || '","year":"' || CAST(year(l_shipdate) AS VARCHAR) || '"}' END AS dims_key,
last_day(CAST(l_shipdate AS DATE)) AS obs_date, max(l_extendedprice) AS value FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3)"""


def _wide(spark, d):
    j = read_table(spark, d, "lineitem").join(read_table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    mode = (F.col("l_suppkey") % 4).cast("string")
    kinds = [F.to_json(F.struct(F.col("l_returnflag").alias("flag"))), F.to_json(F.struct(F.col("l_returnflag").alias("flag"), mode.alias("mode"))), F.to_json(F.struct(mode.alias("mode"), F.year("l_shipdate").cast("string").alias("year")))]
    n = F.col("l_linenumber") % 3
    key = F.when(n == 0, kinds[0]).when(n == 1, kinds[1]).otherwise(kinds[2])
    return j.groupBy(F.col("p_brand").alias("series_id"), key.alias("dims_key"), F.last_day(F.to_date("l_shipdate")).alias("obs_date")).agg(F.max("l_extendedprice").alias("value"))


_ASKED = ['{"flag":"A"}', '{"mode":"2"}', '{"flag":"R","mode":"1"}', '{"mode":"3","year":"1999"}', '{"year":"1998"}', "{}", '{"flag":"none"}']


@query(f"""WITH {_WIDE}, asked AS (SELECT DISTINCT series_id, k AS dims_key FROM obs, (VALUES {', '.join(f"('{k}')" for k in _ASKED)}) v(k)),
hit AS (SELECT a.series_id, a.dims_key, o.obs_date, o.value, row_number() OVER (PARTITION BY a.series_id, a.dims_key ORDER BY o.obs_date DESC, o.dims_key <> a.dims_key, o.dims_key) AS rn FROM asked a JOIN obs o ON o.series_id = a.series_id AND json_contains(CAST(o.dims_key AS JSON), CAST(a.dims_key AS JSON)))
SELECT series_id, dims_key, obs_date AS last_date, value AS last_value FROM hit WHERE rn = 1""")
def latest_value(spark, d):
    obs = _wide(spark, d)
    asked = obs.select("series_id").distinct().withColumn("dims_key", F.explode(F.array(*map(F.lit, _ASKED))))
    return merge.latest_value(asked, obs)


@query(f"""WITH r AS {_last()}, c AS (SELECT series_id, min(value) * 2 AS lo, max(value) * 0.9 AS hi, 100000.0 AS step FROM r WHERE series_id <> '5-LOW' GROUP BY 1),
n AS (SELECT series_id, dims_key, max(obs_date) AS last_date, arg_max(value, obs_date) AS last_value FROM r WHERE obs_date < DATE '2000-01-01' GROUP BY 1, 2)
SELECT r.series_id, r.obs_date, r.dims_key, r.value, r.seq, CASE WHEN r.obs_date > DATE '2001-06-01' THEN 'future date' WHEN c.series_id IS NULL THEN 'not in catalog'
WHEN value < lo THEN 'below minimum' WHEN value > hi THEN 'above maximum' END AS reason,
coalesce(r.obs_date > last_date AND abs(value - last_value) > step, false) AS flagged
FROM r LEFT JOIN c USING (series_id) LEFT JOIN n USING (series_id, dims_key)""")
def validate(spark, d):
    r = merge.dedupe_last(_points(spark, d), merge.POINT, "seq")
    catalog = r.filter("series_id <> '5-LOW'").groupBy("series_id").agg((F.min("value") * 2).alias("min_value"), (F.max("value") * 0.9).alias("max_value"), F.lit(100000.0).alias("max_step"))
    newest = r.filter("obs_date < DATE '2000-01-01'").groupBy("series_id", "dims_key").agg(F.max("obs_date").alias("last_date"), F.max_by("value", "obs_date").alias("last_value"))
    return merge.validate(r, catalog, newest, F.lit("2001-06-01").cast("date"))


@query(f"""WITH s AS {_last('WHERE o_orderkey % 3 <> 0')}, i AS {_last('WHERE o_orderkey % 3 <> 1')}
SELECT * FROM s UNION ALL SELECT * FROM i WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.series_id = i.series_id AND s.obs_date = i.obs_date AND s.dims_key = i.dims_key)""")
def insert_only(spark, d):
    p = _points(spark, d)
    return merge.insert_only(merge.dedupe_last(p.filter("seq % 3 <> 0"), merge.POINT, "seq"), merge.dedupe_last(p.filter("seq % 3 <> 1"), merge.POINT, "seq"), merge.POINT)


@query(f"""WITH s AS (SELECT {_POINT}, o_totalprice AS value, o_orderkey AS seq FROM orders), i AS (SELECT * FROM s WHERE month(obs_date) = 3), p AS (SELECT DISTINCT series_id, obs_date FROM i)
SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.series_id = s.series_id AND p.obs_date = s.obs_date) UNION ALL SELECT series_id, obs_date, dims_key, value + 1, seq FROM i""")
def replace_partition(spark, d):
    p = _points(spark, d)
    return merge.replace_partition(p, p.filter(F.month("obs_date") == 3).withColumn("value", F.col("value") + 1), ["series_id", "obs_date"])


@query(f"""WITH r AS {_last()} SELECT series_id, -50 * max(abs(value)) AS min_value, 50 * max(abs(value)) AS max_value FROM r GROUP BY 1 HAVING count(value) >= 8""")
def learn_bounds(spark, d):
    return merge.learn_bounds(merge.dedupe_last(_points(spark, d), merge.POINT, "seq"))


_KNOWN = f"""WITH a AS (SELECT {_POINT}, o_totalprice AS value, o_orderkey AS seq FROM orders),
c AS (SELECT *, TIMESTAMP '1996-01-01' + to_days(CAST(seq % 3000 AS INTEGER)) AS revised_at, CASE WHEN seq % 3 = 0 THEN TIMESTAMP '1996-01-01' + to_days(CAST(seq % 2500 AS INTEGER)) END AS first_seen_at FROM {_last()}),
v AS (SELECT a.*, TIMESTAMP '1996-01-01' + to_days(CAST((a.seq * 7) % 3000 AS INTEGER)) AS superseded_at FROM a),
r AS (SELECT series_id, obs_date, dims_key, min(superseded_at) AS first_cut, arg_min(value, superseded_at) FILTER (superseded_at >= TIMESTAMP '2000-01-02') AS was,
  bool_or(superseded_at >= TIMESTAMP '2000-01-02') AS later FROM v GROUP BY 1, 2, 3)
"""


def _known(spark, d):
    p = _points(spark, d)
    at = lambda n: F.date_add(F.lit("1996-01-01").cast("date"), (n % 3000).cast("int")).cast("timestamp")
    n = F.col("seq")
    first = F.when(n % 3 == 0, F.date_add(F.lit("1996-01-01").cast("date"), (n % 2500).cast("int")).cast("timestamp"))
    obs = merge.dedupe_last(p, merge.POINT, "seq").withColumn("revised_at", at(n)).withColumn("first_seen_at", first).drop("seq")
    return obs, p.withColumn("superseded_at", at(n * 7))


@query(_KNOWN + """SELECT c.series_id, c.obs_date, c.dims_key, CASE WHEN later THEN was ELSE value END AS known_value FROM c LEFT JOIN r USING (series_id, obs_date, dims_key)
WHERE coalesce(first_seen_at, CASE WHEN obs_date < DATE '1998-06-01' THEN least(revised_at, coalesce(first_cut, revised_at), TIMESTAMP '1998-06-01') ELSE least(revised_at, coalesce(first_cut, revised_at)) END) < TIMESTAMP '2000-01-02'""")
def known_asof(spark, d):
    return merge.known_asof(*_known(spark, d), F.lit("2000-01-01").cast("date"), F.lit("1998-06-01").cast("date"), "seq")


@query(_KNOWN + """SELECT c.series_id, c.obs_date, c.dims_key, CASE WHEN later THEN was ELSE value END AS known_value FROM c LEFT JOIN r USING (series_id, obs_date, dims_key), LATERAL (SELECT coalesce(first_seen_at,
CASE WHEN obs_date < DATE '2001-01-01' THEN least(revised_at, coalesce(first_cut, revised_at), TIMESTAMP '2001-01-01') ELSE least(revised_at, coalesce(first_cut, revised_at)) END) AS since)
WHERE since < TIMESTAMP '2000-01-02' OR (obs_date < DATE '2000-01-01' AND since >= TIMESTAMP '2001-01-01')""")
def known_before_tracking(spark, d):
    return merge.known_asof(*_known(spark, d), F.lit("2000-01-01").cast("date"), F.lit("2001-01-01").cast("date"), "seq")


@query(f"""WITH a AS {_last('WHERE o_orderkey % 5 <> 0')}, b AS (SELECT * REPLACE (CASE WHEN seq % 7 = 0 THEN value * 1.01 ELSE value END AS value) FROM {_last('WHERE o_orderkey % 5 <> 1')})
SELECT coalesce(a.series_id, b.series_id) AS series_id, coalesce(a.obs_date, b.obs_date) AS obs_date, coalesce(a.dims_key, b.dims_key) AS dims_key, round(a.value, 6) AS ours, round(b.value, 6) AS theirs,
CASE WHEN a.seq IS NULL THEN 'missing_ours' WHEN b.seq IS NULL THEN 'missing_source' WHEN abs(a.value - b.value) <= 1e-6 * greatest(abs(a.value), abs(b.value)) THEN 'matched' ELSE 'value' END AS kind
FROM a FULL OUTER JOIN b ON a.series_id = b.series_id AND a.obs_date = b.obs_date AND a.dims_key = b.dims_key""")
def compare_points(spark, d):
    p = _points(spark, d)
    ours = merge.dedupe_last(p.filter("seq % 5 <> 0"), merge.POINT, "seq")
    theirs = merge.dedupe_last(p.filter("seq % 5 <> 1"), merge.POINT, "seq").withColumn("value", F.when(F.col("seq") % 7 == 0, F.col("value") * 1.01).otherwise(F.col("value")))
    return rounded(merge.compare_points(ours, theirs, merge.POINT), "ours", "theirs")


@query(f"""WITH {A.PRICES}, b AS (SELECT city, item, value AS base FROM prices WHERE week = DATE '1998-03-06' AND value > 0),
c AS (SELECT city, count(*) AS basket_n FROM b GROUP BY 1 HAVING count(*) >= 3)
SELECT city, week, basket_n, round(100 * sum(value / base) / count(*), 2) AS cost_index, count(*) AS n_items FROM prices JOIN b USING (city, item) JOIN c USING (city) GROUP BY 1, 2, 3""")
def city_cost_index(spark, d):
    return facts.city_cost_index(A.prices(spark, d), 3, "1998-03-06")


_OFFS = ", ".join(f"({i}, {o})" for i, o in enumerate(facts.OFFSETS))


@query(f"""WITH {A.PRICES}, o(rk, days) AS (VALUES {_OFFS}), p AS (SELECT item, city, week AS obs_date, value FROM prices WHERE value > 0),
j AS (SELECT a.item, a.city, a.obs_date, a.value, arg_min(b.value, rk) AS past FROM p a, o, p b WHERE a.item = b.item AND a.city = b.city AND b.obs_date = a.obs_date - CAST(days AS INTEGER) GROUP BY 1, 2, 3, 4)
SELECT city, obs_date, round((exp(avg(ln(value / past))) - 1) * 100, 6) AS yoy_pct, count(*) AS n_items FROM j GROUP BY 1, 2 HAVING count(*) >= 2""")
def jevons_yoy(spark, d):
    return rounded(facts.jevons_yoy(A.prices(spark, d).withColumnRenamed("week", "obs_date"), 2), "yoy_pct")


@query(f"""WITH {A.PRICES}, m AS (SELECT item, week, median(value) AS mid, count(value) AS cities FROM prices GROUP BY 1, 2)
SELECT item, week, round(avg(value), 6) AS value, count(value) AS n_cities FROM prices JOIN m USING (item, week) WHERE cities < 5 OR value BETWEEN 0.3 * mid AND 3 * mid GROUP BY 1, 2""")
def national_mean(spark, d):
    return rounded(facts.national_mean(A.prices(spark, d)), "value")


@query(f"""WITH {A.NAVS}, w AS (SELECT *, obs_date + CAST((12 - isodow(obs_date)) % 7 AS INTEGER) AS week FROM navs),
l AS (SELECT fund_id, week, arg_max(nav, obs_date) AS v, max(obs_date) AS od FROM w GROUP BY 1, 2)
SELECT week, max(od) AS obs_date, round(median(v), 6) AS median_value, count(*) AS n FROM l GROUP BY 1 HAVING count(*) >= 5""")
def weekly_median(spark, d):
    v = A.navs(spark, d).select(F.col("fund_id").alias("entity"), "obs_date", F.col("nav").alias("value"), F.date_add("obs_date", F.pmod(F.lit(4) - F.weekday("obs_date"), F.lit(7)).cast("int")).alias("week"))
    return rounded(facts.weekly_median(v), "median_value")


_LAST = "l AS (SELECT fund_id, min(obs_date) AS first_date, max(obs_date) AS last_date, arg_min(nav, obs_date) AS first, arg_max(nav, obs_date) AS last FROM navs GROUP BY 1 HAVING count(*) >= 2)"
_BASES = [*[(k, f"last_date - {n}") for k, n in facts.HORIZONS.items()], ("ytd", "date_trunc('year', last_date)")]


@query(f"""WITH {A.NAVS}, {_LAST}, t AS (SELECT fund_id, """ + ", ".join(f"{day} AS day_{k}" for k, day in _BASES) + """ FROM l)
SELECT fund_id, first_date, last_date, """ + ", ".join(f"round(100 * last / n_{k}.nav - 100, 2) AS ret_{k}" for k, _ in _BASES) + """, round(100 * last / first - 100, 2) AS ret_inception, """
    + ", ".join(f"round(100 * exp(ln(last / n_{k}.nav) * 365.25 / {facts.HORIZONS[k]}) - 100, 2) AS yearly_{k}" for k in facts.YEARLY) + """,
CASE WHEN last_date - first_date > 365.25 / 2 THEN round(100 * exp(ln(last / first) * 365.25 / (last_date - first_date)) - 100, 2) END AS cagr
FROM l JOIN t USING (fund_id) """ + " ".join(f"ASOF LEFT JOIN navs n_{k} ON n_{k}.fund_id = t.fund_id AND t.day_{k} >= n_{k}.obs_date" for k, _ in _BASES))
def fund_returns(spark, d):
    return facts.fund_returns(A.navs(spark, d))


@query(f"WITH {A.NAVS}, p AS (SELECT *, max(nav) OVER (PARTITION BY fund_id ORDER BY obs_date) AS peak FROM navs WHERE nav > 0) SELECT fund_id, round(min(nav / peak - 1) * 100, 4) AS max_drawdown_pct FROM p GROUP BY 1")
def fund_drawdown(spark, d):
    return facts.fund_drawdown(A.navs(spark, d))


@query(f"""WITH {A.NAVS}, e AS (SELECT fund_id, last_day(obs_date) AS mon, arg_max(nav, obs_date) AS nav FROM navs GROUP BY 1, 2),
r AS (SELECT fund_id, nav / lag(nav) OVER (PARTITION BY fund_id ORDER BY mon) - 1 AS r FROM e)
SELECT fund_id, count(r) AS n, round(stddev_samp(r) * sqrt(12) * 100, 4) AS volatility_pct FROM r GROUP BY 1 HAVING count(r) >= 6""")
def fund_volatility(spark, d):
    return facts.fund_volatility(A.navs(spark, d))


@query(f"""WITH {A.CALLS} SELECT port, day, coalesce(direction, 'all') AS direction, coalesce(commodity, 'total') AS commodity, round(sum(tonnes), 2) AS tonnes, count(DISTINCT vessel) AS ships
FROM calls GROUP BY GROUPING SETS ((port, day), (port, day, direction), (port, day, commodity), (port, day, direction, commodity))""")
def port_day_series(spark, d):
    return rounded(facts.port_day_series(A.calls(spark, d)), "tonnes", digits=2)


@query(f"""WITH {A.LOG} SELECT day, user_id, auth, route, status // 100 AS status_class, count(*) AS n, round(quantile_cont(ms, 0.5), 6) AS p50, round(quantile_cont(ms, 0.95), 6) AS p95,
CAST(sum(bytes) AS BIGINT) AS bytes, count(*) FILTER (cache = 'hit') AS cache_hits FROM log GROUP BY 1, 2, 3, 4, 5""")
def usage_rollup(spark, d):
    return rounded(facts.usage_rollup(A.request_log(spark, d)), "p50", "p95")


@query(f"""WITH {A.LOG} SELECT route, CAST(date_trunc('week', day) AS DATE) AS week, count(*) AS n, CAST(sum(bytes) AS BIGINT) AS bytes, count(DISTINCT address) AS addresses, true AS p50_fits, true AS p95_fits FROM log GROUP BY 1, 2""")
def merged_usage(spark, d):
    """Stored sketches of days merged to weeks; whether each quantile's rank in the log is within 3 % of what was asked."""
    log = A.request_log(spark, d)
    week = lambda df: df.withColumn("week", F.date_trunc("week", "day").cast("date"))
    merged = facts.merged_usage(week(facts.usage_sketches(log, ["route"])), ["route", "week"])
    near = lambda p, share: F.abs(F.avg((F.col("ms") <= F.col(p)).cast("int")) - share) <= 0.03 + 1 / F.count("ms")
    ranks = week(log).join(merged.select("route", "week", "p50", "p95"), ["route", "week"]).groupBy("route", "week").agg(near("p50", 0.5).alias("p50_fits"), near("p95", 0.95).alias("p95_fits"))
    return merged.drop("p50", "p95").join(ranks, ["route", "week"])


@query(f"WITH {A.LOG} SELECT day, count(DISTINCT address) AS visitors FROM log GROUP BY 1")
def unique_visitors(spark, d):
    return facts.unique_visitors(A.request_log(spark, d))


@query(f"""WITH {A.LOG}, u AS (SELECT 'route_public' AS dim, route AS val FROM log WHERE auth = 'public' UNION ALL SELECT 'user_id', user_id FROM log UNION ALL SELECT 'subject', route || ' ' || subject FROM log WHERE subject <> '' UNION ALL SELECT 'status', CAST(status AS VARCHAR) FROM log),
c AS (SELECT dim, val, count(*) AS n FROM u GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY dim ORDER BY n DESC, val) AS place FROM c) SELECT * FROM r WHERE place <= 50""")
def top_values(spark, d):
    dims = {"route_public": F.when(F.col("auth") == "public", F.col("route")), "user_id": F.col("user_id"), "subject": F.when(F.col("subject") != "", F.concat_ws(" ", "route", "subject")), "status": F.col("status")}
    return facts.top_values(A.request_log(spark, d), dims, 50)


_CODES = """codes AS (SELECT 2024 AS fy, lpad(CAST(p_partkey * 37 % 100000000 AS VARCHAR), 8, '0') AS code FROM part),
entries AS (SELECT CAST(s_suppkey AS BIGINT) AS entry, 2024 AS fy, substring(lpad(CAST(s_suppkey * 3700 % 100000000 AS VARCHAR), 8, '0'), 1, CAST(4 + 2 * (s_suppkey % 3) AS INTEGER)) AS printed FROM supplier)"""


def _codes(spark, d):
    codes = read_table(spark, d, "part").select(F.lit(2024).alias("fy"), F.lpad((F.col("p_partkey") * 37 % 100000000).cast("string"), 8, "0").alias("code"))
    s = read_table(spark, d, "supplier")
    text = F.lpad((F.col("s_suppkey") * 3700 % 100000000).cast("string"), 8, "0")
    return s.select(F.col("s_suppkey").alias("entry"), F.lit(2024).alias("fy"), F.substring(text, F.lit(1), (4 + 2 * (F.col("s_suppkey") % 3)).cast("int")).alias("printed")), codes


@query(f"WITH {_CODES} SELECT entry, e.fy, printed, code FROM entries e JOIN codes c ON e.fy = c.fy AND starts_with(c.code, e.printed)")
def expand_printed_codes(spark, d):
    return facts.expand_printed_codes(*_codes(spark, d))


@query(f"""WITH {_CODES}, m AS (SELECT entry, e.fy, printed, code, row_number() OVER (PARTITION BY e.fy, code ORDER BY length(printed) DESC, entry) AS rn FROM entries e JOIN codes c ON e.fy = c.fy AND starts_with(c.code, e.printed))
SELECT entry, fy, printed, code FROM m WHERE rn = 1""")
def most_specific_prefix(spark, d):
    return facts.most_specific_prefix(facts.expand_printed_codes(*_codes(spark, d)))


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
