"""The given tables in the library's shapes, each as a DataFrame and as the SQL that an oracle puts in front."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.calendar import fiscal_year
from ledgerline.sources.tables import read_table

AROUND = """numbered AS (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rn FROM {table}),
around AS (SELECT m.*, l.{value} AS pv, r.{value} AS nv FROM numbered m LEFT JOIN numbered l ON {l} AND l.rn + 1 = m.rn LEFT JOIN numbered r ON {r} AND r.rn - 1 = m.rn)"""


def around(table: str, key: list[str], order: str = "obs_date", value: str = "value") -> str:
    """SQL of each row with its neighbours' values, by joins on row numbers."""
    same = lambda x: " AND ".join(f"{x}.{k} = m.{k}" for k in key)
    return AROUND.format(table=table, key=", ".join(key), order=order, value=value, l=same("l"), r=same("r"))


MONTHLY = """monthly AS (
  SELECT p_brand AS series_id, '{"flag":"' || l_returnflag || '"}' AS dims_key, last_day(CAST(l_shipdate AS DATE)) AS obs_date,
         avg(l_extendedprice) AS value
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3)"""
DAILY = """daily AS (
  SELECT event_type AS series_id, '{"bucket":"' || CAST(user_id % 4 AS VARCHAR) || '"}' AS dims_key, CAST(ts AS DATE) AS obs_date,
         avg(value) AS value
  FROM events GROUP BY 1, 2, 3)"""
TRADE = """trade AS (
  SELECT l_returnflag AS flow, year(o_orderdate) + CASE WHEN month(o_orderdate) >= 7 THEN 1 ELSE 0 END AS fy,
         lpad(CAST(l_partkey AS VARCHAR), 8, '0') AS code, n_name AS country, l_extendedprice AS value, l_quantity AS quantity
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""
RATES = """rates AS (
  SELECT year(o_orderdate) + CASE WHEN month(o_orderdate) >= 7 THEN 1 ELSE 0 END AS fy, avg(o_totalprice) / 1000 AS rate
  FROM orders GROUP BY 1)"""
NAVS = """navs AS (
  SELECT o_custkey % 50 AS fund_id, CAST(o_orderdate AS DATE) AS obs_date, avg(o_totalprice) AS nav FROM orders GROUP BY 1, 2)"""
PRICES = """prices AS (
  SELECT p_type AS item, n_name AS city,
         CAST(l_shipdate AS DATE) + CAST((12 - isodow(l_shipdate)) % 7 AS INTEGER) AS week, round(sum(l_extendedprice), 2) AS value
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
  GROUP BY 1, 2, 3)"""
CALLS = """calls AS (
  SELECT o_orderpriority AS port, CAST(o_orderdate AS DATE) AS day, CASE WHEN o_custkey % 2 = 0 THEN 'import' ELSE 'export' END AS direction,
         o_orderstatus AS commodity, o_custkey AS vessel, o_totalprice AS tonnes FROM orders)"""
LOG = """log AS (
  SELECT event_id, ts, CAST(ts AS DATE) AS day, event_type AS route, CAST(200 + 100 * (user_id % 4) AS INTEGER) AS status, value AS ms,
         CAST(user_id AS VARCHAR) AS user_id, CAST(props AS VARCHAR) AS subject, CASE user_id % 3 WHEN 0 THEN 'key' ELSE 'public' END AS auth,
         CAST(length(props) AS BIGINT) AS bytes, CASE WHEN event_id % 5 = 0 THEN 'hit' ELSE 'miss' END AS cache, CAST(user_id % 7 AS VARCHAR) AS address FROM events)"""
CATALOG = """catalog AS (
  SELECT series_id, 'Series ' || series_id AS name, 'Mean price of ' || lower(series_id) AS description,
         CASE no % 4 WHEN 1 THEN 'percent' WHEN 2 THEN 'index' WHEN 3 THEN 'count' ELSE 'pkr_per_kg' END AS unit,
         CASE WHEN no % 3 = 0 THEN 'daily' WHEN no % 3 = 1 THEN 'monthly' ELSE 'annual' END AS frequency,
         'module_' || CAST(no % 4 AS VARCHAR) AS module, 'source_' || CAST(no % 3 AS VARCHAR) AS source, no % 5 <> 0 AS is_active,
         CASE WHEN no % 6 = 0 AND no >= 12 THEN 'Brand#' || CAST(no - 12 AS VARCHAR) END AS canonical_id
  FROM (SELECT DISTINCT p_brand AS series_id, CAST(substring(p_brand, 7) AS INTEGER) AS no FROM part))"""
RUNS = """runs AS (
  SELECT event_id AS run_id, event_type || '_' || CAST(user_id % 3 AS VARCHAR) AS job_name, ts AS started_at,
         CASE user_id % 5 WHEN 0 THEN 'success' WHEN 1 THEN 'failed' WHEN 2 THEN 'partial' WHEN 3 THEN 'no_new_data' ELSE 'running' END AS status,
         CAST(event_id % 3 AS BIGINT) AS rows_upserted, CASE WHEN user_id % 5 = 1 THEN props END AS error FROM events)"""
CODES = """codes AS (
  SELECT lpad(CAST(p_partkey AS VARCHAR), 8, '0') AS code, p_name AS name, p_type AS short_name, p_brand AS heading,
         'size ' || CAST(p_size AS VARCHAR) AS description FROM part)"""
RULINGS = """rulings AS (
  SELECT o_orderkey AS ruling_id, CASE WHEN o_custkey % 5 = 0 THEN 'withdrawal' ELSE 'values' END AS kind, CAST(o_orderdate AS DATE) AS issued_on,
         CASE WHEN o_custkey % 2 = 0 THEN CAST(o_orderdate AS DATE) + 400 END AS superseded_on FROM orders)"""
TARIFF = """tariff AS (
  SELECT lpad(CAST(p_partkey * 37 % 100000000 AS VARCHAR), 8, '0') AS code, CAST(2024 + p_partkey % 3 AS INTEGER) AS fy, p_name AS description FROM part),
duties AS (
  SELECT code, fy, c.component, CASE WHEN (hashed + c.k) % 7 = 0 THEN NULL ELSE CAST((hashed + c.k) % 5 * 5 AS DOUBLE) END AS rate_pct,
         CASE WHEN (hashed + c.k) % 7 = 0 THEN 'Rs.' || CAST(hashed % 100 AS VARCHAR) || '/kg' END AS rate_text
  FROM (SELECT *, CAST(code AS BIGINT) AS hashed FROM tariff), (VALUES ('cd', 0), ('rd', 1), ('acd', 2)) c(component, k) WHERE c.k = 0 OR hashed % (c.k + 1) = 0)"""

PRINTS = """current AS (SELECT series_id, obs_date, value FROM monthly WHERE dims_key = '{"flag":"A"}'),
cells AS (
  SELECT 'bulletin' AS source, last_day(obs_date + to_months(CAST(k AS INTEGER))) AS published, series_id AS row_id,
         CASE WHEN k = 5 THEN 'BRAND' ELSE 'Brand' END || ' x' || translate(substring(series_id, 7), '0123456789', 'abcdefghij') || 'z, Rs (base 2010-11=100)' AS label, obs_date,
         round(value * CASE WHEN k = 0 AND month(obs_date) % 3 = 0 THEN 1.02 WHEN k = 2 AND month(obs_date) = 5 THEN 3 ELSE 1 END / 1000, 1) AS pub, CAST(1 AS INTEGER) AS dp
  FROM current, range(6) r(k))"""


def monthly(spark: SparkSession, d: str) -> DataFrame:
    j = read_table(spark, d, "lineitem").join(read_table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    key = F.concat(F.lit('{"flag":"'), F.col("l_returnflag"), F.lit('"}'))
    return j.groupBy(F.col("p_brand").alias("series_id"), key.alias("dims_key"), F.last_day(F.to_date("l_shipdate")).alias("obs_date")).agg(F.avg("l_extendedprice").alias("value"))


def daily(spark: SparkSession, d: str) -> DataFrame:
    key = F.concat(F.lit('{"bucket":"'), (F.col("user_id") % 4).cast("string"), F.lit('"}'))
    return read_table(spark, d, "events").groupBy(F.col("event_type").alias("series_id"), key.alias("dims_key"), F.to_date("ts").alias("obs_date")).agg(F.avg("value").alias("value"))


def trade(spark: SparkSession, d: str) -> DataFrame:
    line, orders, customer, nation = (read_table(spark, d, t) for t in ("lineitem", "orders", "customer", "nation"))
    j = line.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(customer, F.col("o_custkey") == F.col("c_custkey")).join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return j.select(F.col("l_returnflag").alias("flow"), fiscal_year(F.col("o_orderdate")).alias("fy"), F.lpad(F.col("l_partkey").cast("string"), 8, "0").alias("code"), F.col("n_name").alias("country"), F.col("l_extendedprice").alias("value"), F.col("l_quantity").alias("quantity"))


def rates(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "orders").groupBy(fiscal_year(F.col("o_orderdate")).alias("fy")).agg((F.avg("o_totalprice") / 1000).alias("rate"))


def navs(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "orders").groupBy((F.col("o_custkey") % 50).alias("fund_id"), F.to_date("o_orderdate").alias("obs_date")).agg(F.avg("o_totalprice").alias("nav"))


def prices(spark: SparkSession, d: str) -> DataFrame:
    line, part, supplier, nation = (read_table(spark, d, t) for t in ("lineitem", "part", "supplier", "nation"))
    j = line.join(part, F.col("l_partkey") == F.col("p_partkey")).join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    week = F.date_add(F.to_date("l_shipdate"), F.pmod(F.lit(4) - F.weekday("l_shipdate"), F.lit(7)).cast("int"))
    return j.groupBy(F.col("p_type").alias("item"), F.col("n_name").alias("city"), week.alias("week")).agg(F.round(F.sum("l_extendedprice"), 2).alias("value"))


def calls(spark: SparkSession, d: str) -> DataFrame:
    o = read_table(spark, d, "orders")
    return o.select(F.col("o_orderpriority").alias("port"), F.to_date("o_orderdate").alias("day"), F.when(F.col("o_custkey") % 2 == 0, "import").otherwise("export").alias("direction"), F.col("o_orderstatus").alias("commodity"), F.col("o_custkey").alias("vessel"), F.col("o_totalprice").alias("tonnes"))


def request_log(spark: SparkSession, d: str) -> DataFrame:
    e, user = read_table(spark, d, "events"), F.col("user_id")
    return e.select(
        "event_id", "ts", F.to_date("ts").alias("day"), F.col("event_type").alias("route"), (200 + 100 * (user % 4)).cast("int").alias("status"), F.col("value").alias("ms"),
        user.cast("string").alias("user_id"), F.col("props").alias("subject"), F.when(user % 3 == 0, "key").otherwise("public").alias("auth"),
        F.length("props").cast("long").alias("bytes"), F.when(F.col("event_id") % 5 == 0, "hit").otherwise("miss").alias("cache"), (user % 7).cast("string").alias("address"),
    )


def catalog(spark: SparkSession, d: str) -> DataFrame:
    b = read_table(spark, d, "part").select(F.col("p_brand").alias("series_id"), F.substring("p_brand", 7, 9).cast("int").alias("no")).distinct()
    no = F.col("no")
    return b.select(
        "series_id",
        F.concat(F.lit("Series "), "series_id").alias("name"),
        F.concat(F.lit("Mean price of "), F.lower("series_id")).alias("description"),
        F.element_at(F.array(*map(F.lit, ("pkr_per_kg", "percent", "index", "count"))), no % 4 + 1).alias("unit"),
        F.element_at(F.array(*map(F.lit, ("daily", "monthly", "annual"))), no % 3 + 1).alias("frequency"),
        F.concat(F.lit("module_"), (no % 4).cast("string")).alias("module"),
        F.concat(F.lit("source_"), (no % 3).cast("string")).alias("source"),
        (no % 5 != 0).alias("is_active"),
        F.when((no % 6 == 0) & (no >= 12), F.concat(F.lit("Brand#"), (no - 12).cast("string"))).alias("canonical_id"),
    )


def runs(spark: SparkSession, d: str) -> DataFrame:
    e = read_table(spark, d, "events")
    status = F.element_at(F.array(*map(F.lit, ("success", "failed", "partial", "no_new_data", "running"))), (F.col("user_id") % 5 + 1).cast("int"))
    return e.select(F.col("event_id").alias("run_id"), F.concat("event_type", F.lit("_"), (F.col("user_id") % 3).cast("string")).alias("job_name"), F.col("ts").alias("started_at"), status.alias("status"), (F.col("event_id") % 3).alias("rows_upserted"), F.when(F.col("user_id") % 5 == 1, F.col("props")).alias("error"))


def codes(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "part").select(F.lpad(F.col("p_partkey").cast("string"), 8, "0").alias("code"), F.col("p_name").alias("name"), F.col("p_type").alias("short_name"), F.col("p_brand").alias("heading"), F.concat(F.lit("size "), F.col("p_size").cast("string")).alias("description"))


def rulings(spark: SparkSession, d: str) -> DataFrame:
    day = F.to_date("o_orderdate")
    return read_table(spark, d, "orders").select(F.col("o_orderkey").alias("ruling_id"), F.when(F.col("o_custkey") % 5 == 0, "withdrawal").otherwise("values").alias("kind"), day.alias("issued_on"), F.when(F.col("o_custkey") % 2 == 0, F.date_add(day, 400)).alias("superseded_on"))


def tariff(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "part").select(F.lpad((F.col("p_partkey") * 37 % 100000000).cast("string"), 8, "0").alias("code"), (2024 + F.col("p_partkey") % 3).cast("int").alias("fy"), F.col("p_name").alias("description"))


def duties(spark: SparkSession, d: str) -> DataFrame:
    kinds = F.explode(F.array(*[F.struct(F.lit(c).alias("component"), F.lit(k).alias("k")) for k, c in enumerate(("cd", "rd", "acd"))]))
    t = tariff(spark, d).select("code", "fy", F.col("code").cast("long").alias("h"), kinds.alias("c")).select("code", "fy", "h", "c.component", "c.k")
    t = t.filter((F.col("k") == 0) | (F.col("h") % (F.col("k") + 1) == 0))
    specific, n = (F.col("h") + F.col("k")) % 7 == 0, F.col("h") + F.col("k")
    return t.select("code", "fy", "component", F.when(~specific, (n % 5 * 5).cast("double")).alias("rate_pct"), F.when(specific, F.concat(F.lit("Rs."), (F.col("h") % 100).cast("string"), F.lit("/kg"))).alias("rate_text"))


def current(spark: SparkSession, d: str) -> DataFrame:
    """Today's values of one flag's series."""
    return monthly(spark, d).filter(F.col("dims_key") == '{"flag":"A"}').select("series_id", "obs_date", "value")


def cells(spark: SparkSession, d: str) -> DataFrame:
    """What six issues of a bulletin printed for each of today's values, in thousands: some first prints were other, some are misprints."""
    month, k = F.month("obs_date"), F.col("k")
    c = current(spark, d).withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(5))))
    off = F.when((k == 0) & (month % 3 == 0), 1.02).when((k == 2) & (month == 5), 3).otherwise(1)
    return c.select(
        F.lit("bulletin").alias("source"), F.last_day(F.add_months("obs_date", k)).alias("published"), F.col("series_id").alias("row_id"),
        F.concat(F.when(k == 5, "BRAND").otherwise("Brand"), F.lit(" x"), F.translate(F.substring("series_id", 7, 9), "0123456789", "abcdefghij"), F.lit("z, Rs (base 2010-11=100)")).alias("label"),
        "obs_date", F.round(F.col("value") * off / 1000, 1).alias("pub"), F.lit(1).alias("dp"),
    )
