"""Queries of the loads, each with the SQL it must agree with."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.operators import loads
from ledgerline.plans import adapters as A
from ledgerline.plans.registry import query, rounded
from ledgerline.sources.tables import read_table


@query(f"WITH {A.MONTHLY} SELECT CASE WHEN series_id LIKE 'Brand#1%' THEN 'first.' || substring(series_id, 8) WHEN series_id LIKE 'Brand#%' THEN 'b.' || substring(series_id, 7) ELSE series_id END AS series_id, count(*) AS n FROM monthly GROUP BY 1")
def canonicalize_ids(spark, d):
    return loads.canonicalize_ids(A.monthly(spark, d), {"Brand#1": "first.", "Brand#": "b.", "B": "never."}).groupBy("series_id").agg(F.count(F.lit(1)).alias("n"))


@query("""WITH s AS (SELECT o_custkey AS fund_id, max(o_totalprice) AS price, CAST(NULL AS VARCHAR) AS note FROM orders WHERE o_orderstatus = 'F' GROUP BY 1),
i AS (SELECT o_custkey AS fund_id, CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice END AS price, o_orderpriority AS note, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS rn FROM orders SEMI JOIN customer ON c_custkey = o_custkey AND c_nationkey < 20)
SELECT coalesce(s.fund_id, i.fund_id) AS fund_id, coalesce(i.price, s.price) AS price, coalesce(i.note, s.note) AS note FROM s FULL JOIN (SELECT * FROM i WHERE rn = 1) i ON s.fund_id = i.fund_id""")
def merge_coalesce(spark, d):
    o = read_table(spark, d, "orders")
    stored = o.filter("o_orderstatus = 'F'").groupBy(F.col("o_custkey").alias("fund_id")).agg(F.max("o_totalprice").alias("price")).withColumn("note", F.lit(None).cast("string"))
    batch = o.select(F.col("o_custkey").alias("fund_id"), F.when(F.col("o_orderkey") % 2 == 0, F.col("o_totalprice")).alias("price"), F.col("o_orderpriority").alias("note"), F.col("o_orderkey").alias("seq"))
    owners = read_table(spark, d, "customer").filter("c_nationkey < 20").select(F.col("c_custkey").alias("fund_id"))
    return loads.merge_known(stored, batch, ["fund_id"], ["price", "note"], owners, "fund_id", "seq")


_ED = "s AS (SELECT p_brand AS fy, p_type AS code, CAST(p_size AS BIGINT) AS rate FROM part), i AS (SELECT fy, code, CASE WHEN fy LIKE '%3' AND rate = 7 THEN 8 ELSE rate END AS rate FROM s WHERE NOT (fy LIKE '%4' AND rate = 9))"


def _editions(spark, d):
    s = read_table(spark, d, "part").select(F.col("p_brand").alias("fy"), F.col("p_type").alias("code"), F.col("p_size").cast("long").alias("rate"))
    i = s.filter("not (endswith(fy, '4') and rate = 9)").withColumn("rate", F.when(F.col("fy").endswith("3") & (F.col("rate") == 7), 8).otherwise(F.col("rate")))
    return s, i


@query(f"WITH {_ED}, a AS (SELECT * FROM s EXCEPT ALL SELECT * FROM i), b AS (SELECT * FROM i EXCEPT ALL SELECT * FROM s) SELECT fy, count(*) AS n_changed FROM (SELECT * FROM a UNION ALL SELECT * FROM b) GROUP BY 1")
def changed_editions(spark, d):
    return loads.changed_editions(*_editions(spark, d), "fy")


@query(f"WITH {_ED} SELECT fy, code, rate, count(*) AS n FROM i GROUP BY 1, 2, 3")
def replace_edition(spark, d):
    return loads.replace_edition(*_editions(spark, d), "fy").groupBy("fy", "code", "rate").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {A.MONTHLY} SELECT series_id, dims_key, obs_date, round(CASE WHEN series_id = 'Brand#5' THEN value * 2 ELSE value END, 6) AS value FROM monthly WHERE series_id <> 'Brand#5' OR month(obs_date) > 3")
def replace_derived(spark, d):
    m = A.monthly(spark, d)
    return rounded(loads.replace_derived(m, m.filter("month(obs_date) > 3").withColumn("value", F.col("value") * 2), ["Brand#5"]), "value")


@query("""WITH s AS (SELECT c_custkey AS code, CASE WHEN c_nationkey % 2 = 0 THEN c_name END AS name, DATE '1996-06-01' AS first_seen, DATE '1997-06-01' AS last_seen FROM customer),
i AS (SELECT o_custkey AS code, CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS name, CAST(o_orderdate AS DATE) AS d FROM orders),
n AS (SELECT code, arg_max(name, (d, name)) FILTER (name IS NOT NULL) AS name, min(d) AS first_seen, max(d) AS last_seen FROM i GROUP BY 1)
SELECT coalesce(s.code, n.code) AS code, coalesce(n.name, s.name) AS name, least(s.first_seen, n.first_seen) AS first_seen, greatest(s.last_seen, n.last_seen) AS last_seen FROM s FULL JOIN n ON s.code = n.code""")
def upsert_entities(spark, d):
    c, o = read_table(spark, d, "customer"), read_table(spark, d, "orders")
    day = F.to_date("o_orderdate")
    stored = c.select(F.col("c_custkey").alias("code"), F.when(F.col("c_nationkey") % 2 == 0, F.col("c_name")).alias("name"), F.lit("1996-06-01").cast("date").alias("first_seen"), F.lit("1997-06-01").cast("date").alias("last_seen"))
    batch = o.select(F.col("o_custkey").alias("code"), F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("name"), day.alias("first_seen"), day.alias("last_seen"))
    return loads.upsert_entities(stored, batch, "code", ["name"])


@query("""WITH t AS (SELECT CASE WHEN l_suppkey % 5 <> 0 THEN l_partkey END AS code, l_suppkey, l_orderkey * 10 + l_linenumber AS id FROM lineitem)
SELECT code, l_suppkey, min(id) AS id FROM t WHERE code IS NOT NULL GROUP BY 1, 2 UNION ALL SELECT code, l_suppkey, id FROM t WHERE code IS NULL""")
def drop_repeat_trades(spark, d):
    t = read_table(spark, d, "lineitem").select(F.when(F.col("l_suppkey") % 5 != 0, F.col("l_partkey")).alias("code"), "l_suppkey", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"))
    return loads.drop_repeats(t, ["code", "l_suppkey"], F.col("id"))


@query(f"""WITH {A.DAILY}, m AS (SELECT series_id, '{{"half":"' || CAST(CAST(substring(dims_key, 12, 1) AS INTEGER) % 2 AS VARCHAR) || '"}}' AS dims_key, obs_date, value, obs_date + CAST(substring(dims_key, 12, 1) AS INTEGER) AS first_seen FROM daily)
SELECT series_id, dims_key, obs_date, round(arg_min(value, (first_seen, value)), 6) AS value, min(first_seen) AS first_seen, count(DISTINCT value) AS conflicts FROM m GROUP BY 1, 2, 3""")
def rekey_and_merge(spark, d):
    n = F.get_json_object("dims_key", "$.bucket").cast("int")
    obs = A.daily(spark, d).withColumn("first_seen", F.date_add("obs_date", n))
    mapping = obs.select("dims_key").distinct().select("dims_key", F.concat(F.lit('{"half":"'), (n % 2).cast("string"), F.lit('"}')).alias("new_key"))
    return rounded(loads.rekey_and_merge(obs, mapping), "value")


@query("""WITH r AS (SELECT o_custkey AS fund_id, sum(o_totalprice) FILTER (o_orderstatus = 'F') AS f, sum(o_totalprice) FILTER (o_orderstatus = 'O') AS o, sum(o_totalprice) FILTER (o_orderstatus = 'P') * CASE WHEN o_custkey % 7 = 0 THEN 30 ELSE 1 END AS p, sum(o_totalprice) AS total FROM orders GROUP BY 1),
l AS (SELECT fund_id, 'f' AS kind, 100 * f / total AS pct FROM r UNION ALL SELECT fund_id, 'o', 100 * o / total FROM r UNION ALL SELECT fund_id, 'p', 100 * p / total FROM r), k AS (SELECT * FROM l WHERE pct BETWEEN -150 AND 150)
SELECT fund_id, kind, round(pct, 6) AS pct FROM k WHERE fund_id IN (SELECT fund_id FROM k GROUP BY 1 HAVING sum(pct) BETWEEN 90 AND 112)""")
def reparse_gate_allocations(spark, d):
    o, s = read_table(spark, d, "orders"), F.col("o_orderstatus")
    of = lambda k: F.sum(F.when(s == k, F.col("o_totalprice")))
    rows = o.groupBy(F.col("o_custkey").alias("fund_id")).agg(of("F").alias("f"), of("O").alias("o"), of("P").alias("p"), F.sum("o_totalprice").alias("total"))
    return rounded(loads.gate_allocations(rows.withColumn("p", F.col("p") * F.when(F.col("fund_id") % 7 == 0, 30).otherwise(1)), ["f", "o", "p"]), "pct")


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_tax <= 0.05 THEN l_tax END AS ter, l_discount AS fee FROM lineitem WHERE (l_tax > 0 AND l_tax <= 0.05) OR l_discount <> 0")
def cap_expense(spark, d):
    return loads.cap_expense(read_table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_tax").alias("ter"), F.col("l_discount").alias("fee")), "ter", 0.05, ["fee"])


@query("""WITH e AS (SELECT 's' || CAST(s_suppkey AS VARCHAR) AS source_key, CASE s_suppkey WHEN 0 THEN 'id.PROMO' WHEN 1 THEN 'id.PROMO_4' WHEN 2 THEN 'id.PROMO_2' WHEN 3 THEN 'id.ECONOMY_2010' WHEN 4 THEN 'id.LARGE_7' ELSE 'other.' || CAST(s_suppkey AS VARCHAR) END AS series_id FROM supplier),
f AS (SELECT DISTINCT 'p' || CAST(p_size AS VARCHAR) || p_type AS source_key, 'id.' || split_part(p_type, ' ', 1) || CASE WHEN p_size % 9 = 0 THEN '_3' ELSE '' END AS series_id FROM part),
r AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY source_key) - CASE WHEN series_id IN (SELECT series_id FROM e) THEN 0 ELSE 1 END AS ask FROM f),
o AS (SELECT series_id FROM e UNION SELECT series_id FROM r WHERE ask = 0),
free AS (SELECT b.series_id, k, row_number() OVER (PARTITION BY b.series_id ORDER BY k) AS nth FROM (SELECT series_id, max(ask) AS most FROM r GROUP BY 1) b, range(2, 3000) g(k) WHERE k <= most + 100 AND b.series_id || '_' || CAST(k AS VARCHAR) NOT IN (SELECT series_id FROM o))
SELECT source_key, series_id FROM e UNION ALL SELECT source_key, series_id FROM r WHERE ask = 0 UNION ALL SELECT r.source_key, r.series_id || '_' || CAST(k AS VARCHAR) FROM r JOIN free ON free.series_id = r.series_id AND nth = ask WHERE ask > 0""")
def merge_catalog(spark, d):
    k, size = F.col("s_suppkey"), F.col("p_size")
    taken = F.when(k == 0, "id.PROMO").when(k == 1, "id.PROMO_4").when(k == 2, "id.PROMO_2").when(k == 3, "id.ECONOMY_2010").when(k == 4, "id.LARGE_7")
    existing = read_table(spark, d, "supplier").select(F.concat(F.lit("s"), k.cast("string")).alias("source_key"), F.coalesce(taken, F.concat(F.lit("other."), k.cast("string"))).alias("series_id"))
    found_id = F.concat(F.lit("id."), F.split_part("p_type", F.lit(" "), F.lit(1)), F.when(size % 9 == 0, "_3").otherwise(""))
    found = read_table(spark, d, "part").select(F.concat(F.lit("p"), size.cast("string"), "p_type").alias("source_key"), found_id.alias("series_id"))
    return loads.merge_catalog(existing, found)


@query(f"""WITH {A.MONTHLY}, {A.CATALOG}, l AS (SELECT series_id, max(obs_date) AS last_date FROM monthly WHERE series_id <> 'Brand#7' GROUP BY 1)
SELECT series_id, frequency, last_date FROM catalog LEFT JOIN l USING (series_id) WHERE is_active AND (last_date IS NULL OR DATE '2002-01-31' - last_date > CASE frequency WHEN 'daily' THEN 5 WHEN 'monthly' THEN 70 ELSE 400 END) ORDER BY last_date NULLS FIRST, series_id LIMIT 8""")
def select_backfill(spark, d):
    return loads.select_backfill(A.catalog(spark, d), A.monthly(spark, d).filter("series_id <> 'Brand#7'"), {"daily": 5, "monthly": 70, "annual": 400}, F.lit("2002-01-31").cast("date"), 8)


@query(f"WITH {A.CATALOG} SELECT series_id, CASE WHEN unit IN ('pkr_per_kg', 'count') AND series_id LIKE '%2' THEN unit || '_mn' ELSE unit END AS unit FROM catalog")
def apply_unit_scale(spark, d):
    c = A.catalog(spark, d)
    scales = c.filter("endswith(series_id, '2')").select("series_id", F.lit("mn").alias("scale"))
    return loads.apply_unit_scale(c, scales, ["pkr_per_kg", "count"]).select("series_id", "unit")


@query(f"""WITH {A.MONTHLY} SELECT series_id, dims_key, obs_date, round(value * CASE WHEN month(obs_date) = 5 THEN 1000 ELSE 1 END, 4) AS value, month(obs_date) = 5 AS rescaled FROM monthly""")
def rescale_splices(spark, d):
    m = A.monthly(spark, d)
    listed = m.filter("month(obs_date) in (5, 6)").select("series_id", "dims_key", "obs_date", (F.col("value") + F.when(F.month("obs_date") == 6, 1).otherwise(0)).alias("listed"), F.lit(1000).alias("factor"))
    return rounded(loads.rescale_splices(m, listed), "value", digits=4)


_SHEET = """sheet AS (SELECT o_custkey % 50 AS sheet, o_orderkey AS pos, CASE WHEN o_totalprice > 495000 THEN 'stop' WHEN o_totalprice < 30000 THEN 'group' WHEN o_totalprice < 120000 THEN 'parent' WHEN o_totalprice < 350000 THEN 'child' ELSE 'item' END AS kind, 'L' || CAST(o_custkey AS VARCHAR) AS label FROM orders)"""


@query(f"""WITH {_SHEET}, w AS (SELECT *, max(pos) FILTER (kind IN ('group', 'parent')) OVER p AS head, max(pos) FILTER (kind = 'group') OVER p AS top, count(*) FILTER (kind = 'stop') OVER p AS stops FROM sheet WINDOW p AS (PARTITION BY sheet ORDER BY pos))
SELECT w.sheet, w.pos, g.label AS grp, CASE WHEN w.kind = 'child' AND h.kind = 'parent' THEN h.label || ' / ' || w.label ELSE w.label END AS label FROM w LEFT JOIN sheet h ON h.sheet = w.sheet AND h.pos = w.head LEFT JOIN sheet g ON g.sheet = w.sheet AND g.pos = w.top
WHERE stops = 0 AND w.kind IN ('parent', 'child', 'item')""")
def parent_labels(spark, d):
    v = F.col("o_totalprice")
    kind = F.when(v > 495000, "stop").when(v < 30000, "group").when(v < 120000, "parent").when(v < 350000, "child").otherwise("item")
    sheet = read_table(spark, d, "orders").select((F.col("o_custkey") % 50).alias("sheet"), F.col("o_orderkey").alias("pos"), kind.alias("kind"), F.concat(F.lit("L"), F.col("o_custkey").cast("string")).alias("label"))
    return loads.parent_labels(sheet, "sheet", "pos")


@query("""SELECT o_orderkey, last_day(CAST(o_orderdate AS DATE)) AS obs_date, o_totalprice AS value FROM orders UNION ALL SELECT o_orderkey, last_day(date_trunc('month', o_orderdate) - INTERVAL 1 DAY), o_totalprice / 2 FROM orders WHERE o_orderstatus <> 'P'""")
def unpivot_two_periods(spark, d):
    o = read_table(spark, d, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"), F.col("o_totalprice").alias("now"), F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice") / 2).alias("before"))
    return loads.unpivot_two_periods(o, ["o_orderkey"], "now", "before", "day")


_FY = "CAST(year(o_orderdate) + CASE WHEN month(o_orderdate) >= 7 THEN 1 ELSE 0 END AS INTEGER)"


@query(f"""WITH w AS (SELECT o_custkey AS item, {_FY} AS fy, o_orderkey AS pos, o_totalprice AS v, o_orderstatus AS base FROM orders), l AS (SELECT item, last_day(make_date(fy - 1, 7, 1) + to_months(CAST(m AS INTEGER))) AS obs_date, v + m AS value, pos FROM w, range(12) r(m) WHERE base = 'F' AND (m < 6 OR item % 2 = 0)),
r AS (SELECT *, row_number() OVER (PARTITION BY item, obs_date ORDER BY pos) AS rn FROM l) SELECT item, obs_date, round(value, 2) AS value FROM r WHERE rn = 1""")
def unpivot_fiscal_months(spark, d):
    day = F.col("o_orderdate")
    months = [F.when((F.lit(m) < 6) | (F.col("o_custkey") % 2 == 0), F.col("o_totalprice") + m).alias(f"m{m}") for m in range(12)]
    wide = read_table(spark, d, "orders").select(F.col("o_custkey").alias("item"), (F.year(day) + F.when(F.month(day) >= 7, 1).otherwise(0)).alias("fy"), F.col("o_orderkey").alias("pos"), F.col("o_orderstatus").alias("base"), *months)
    return rounded(loads.unpivot_fiscal_months(wide, ["item"], [f"m{m}" for m in range(12)], "fy", "pos", "F"), "value", digits=2)


@query("""SELECT CAST(l_shipdate AS DATE) AS obs_date, round(l_quantity * 1000, 4) AS value, '{"measure":"inflow","site":"' || CAST(l_suppkey AS VARCHAR) || '"}' AS dims_key FROM lineitem
UNION ALL SELECT CAST(l_shipdate AS DATE), round(l_tax * 0.5, 4), '{"measure":"level","site":"' || CAST(l_suppkey AS VARCHAR) || '"}' FROM lineitem WHERE l_discount > 0.02""")
def measures_to_long(spark, d):
    rows = read_table(spark, d, "lineitem").select(F.col("l_suppkey").cast("string").alias("s"), F.to_date("l_shipdate").alias("d"), F.col("l_quantity").alias("inflow"), F.when(F.col("l_discount") > 0.02, F.col("l_tax")).alias("level"))
    return rounded(loads.measures_to_long(rows, "s", "d", {"inflow": 1000.0, "level": 0.5}), "value", digits=4)


@query("""WITH r AS (SELECT o_custkey AS plant, year(o_orderdate) AS y, max(o_orderpriority) AS name, round(sum(o_totalprice), 2) AS v FROM orders GROUP BY 1, 2), n AS (SELECT plant, arg_max(name, y) AS name FROM r GROUP BY 1) SELECT plant, y, n.name, v FROM r JOIN n USING (plant)""")
def rename_to_latest(spark, d):
    r = read_table(spark, d, "orders").groupBy(F.col("o_custkey").alias("plant"), F.year("o_orderdate").alias("y")).agg(F.max("o_orderpriority").alias("name"), F.round(F.sum("o_totalprice"), 2).alias("v"))
    return loads.rename_to_latest(r, "plant", "name", "y")


@query(f"WITH {A.LOG}, r AS (SELECT DISTINCT day FROM log WHERE status < 300) SELECT day, count(*) AS n, day IN (SELECT day FROM r) AS may_drop FROM log WHERE day < DATE '2024-01-20' GROUP BY 1")
def archive_days(spark, d):
    log = A.request_log(spark, d)
    rows, drop = loads.archive_days(log, log.filter("status < 300").select("day"), F.lit("2024-01-20").cast("date"))
    counts = rows.groupBy("day").agg(F.count(F.lit(1)).alias("n"))
    return counts.join(drop.withColumn("may_drop", F.lit(True)), "day", "left").withColumn("may_drop", F.coalesce("may_drop", F.lit(False)))


@query(f"WITH {A.MONTHLY} SELECT obs_date, json_extract_string(dims_key, '$.flag') AS flag, round(value, 6) AS value FROM monthly WHERE series_id = 'Brand#12'")
def download_table(spark, d):
    return rounded(loads.download_table(A.monthly(spark, d), "Brand#12", ["flag"]), "value")


@query("""SELECT c_custkey AS who_id, CASE WHEN c_nationkey % 3 = 0 THEN '''=' || c_name ELSE '-' || CAST(c_nationkey AS VARCHAR) END AS who_name, '[' || CAST(c_nationkey AS VARCHAR) || ',' || CAST(c_nationkey + 1 AS VARCHAR) || ']' AS places, c_acctbal AS balance FROM customer""")
def flatten_for_csv(spark, d):
    n = F.col("c_nationkey")
    name = F.when(n % 3 == 0, F.concat(F.lit("="), "c_name")).otherwise(F.concat(F.lit("-"), n.cast("string")))
    flat = loads.flatten_for_csv(read_table(spark, d, "customer").select(F.struct(F.col("c_custkey").alias("id"), name.alias("name")).alias("who"), F.array(n, n + 1).alias("places"), F.col("c_acctbal").alias("balance")))
    return flat.toDF(*[c.replace(".", "_") for c in flat.columns])
