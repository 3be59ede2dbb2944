"""Queries of tariff editions and schedules, each with the SQL it must agree with."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.operators import tariff
from ledgerline.plans import adapters as A
from ledgerline.plans.registry import query, rounded
from ledgerline.sources.tables import read_table

_STR = "CAST({} AS VARCHAR)"


@query(f"""WITH {A.TARIFF} SELECT t.code, t.fy, t.description, cd.rate_pct AS cd_pct, cd.rate_text AS cd_text, rd.rate_pct AS rd_pct, acd.rate_text AS acd_text FROM tariff t
LEFT JOIN duties cd ON cd.code = t.code AND cd.fy = t.fy AND cd.component = 'cd' LEFT JOIN duties rd ON rd.code = t.code AND rd.fy = t.fy AND rd.component = 'rd' LEFT JOIN duties acd ON acd.code = t.code AND acd.fy = t.fy AND acd.component = 'acd'""")
def tariff_with_duties(spark, d):
    out = tariff.tariff_with_duties(A.tariff(spark, d), A.duties(spark, d))
    duty = lambda c: F.try_element_at("duties", F.lit(c))
    return out.select("code", "fy", "description", duty("cd")["rate_pct"].alias("cd_pct"), duty("cd")["rate_text"].alias("cd_text"), duty("rd")["rate_pct"].alias("rd_pct"), duty("acd")["rate_text"].alias("acd_text"))


@query(f"WITH {A.TARIFF}, c AS (SELECT code, fy + 1 AS fy, 2.5 AS concession_pct FROM tariff UNION ALL SELECT code, fy, 1.5 FROM tariff) SELECT c.code, c.fy, CAST(concession_pct AS DOUBLE) AS concession_pct, rate_pct AS normal_pct, rate_text AS normal_text FROM c LEFT JOIN duties d ON d.code = c.code AND d.fy = c.fy AND component = 'cd'")
def concession_vs_tariff(spark, d):
    t = A.tariff(spark, d)
    c = t.select("code", (F.col("fy") + 1).alias("fy"), F.lit(2.5).alias("concession_pct")).unionByName(t.select("code", "fy", F.lit(1.5).alias("concession_pct")))
    return tariff.concession_vs_tariff(c, A.duties(spark, d))


_ENTRIES = """entries AS (SELECT 's' || CAST(p_size % 3 AS VARCHAR) AS schedule, p_brand AS tbl, CAST(p_size AS BIGINT) AS serial, CAST(2020 + p_partkey % 4 AS INTEGER) AS fy, lpad(CAST(p_partkey AS VARCHAR), 8, '0') AS code FROM part),
heads AS (SELECT DISTINCT schedule, tbl, serial, fy FROM entries)"""


def _entries(spark, d):
    e = read_table(spark, d, "part").select(F.concat(F.lit("s"), (F.col("p_size") % 3).cast("string")).alias("schedule"), F.col("p_brand").alias("tbl"), F.col("p_size").cast("long").alias("serial"), (2020 + F.col("p_partkey") % 4).cast("int").alias("fy"), F.lpad(F.col("p_partkey").cast("string"), 8, "0").alias("code"))
    return e, e.select("schedule", "tbl", "serial", "fy").distinct()


@query(f"WITH {_ENTRIES}, c AS (SELECT schedule, tbl, serial, fy, string_agg(code, ',' ORDER BY code) AS codes, count(*) AS n_codes FROM entries WHERE serial <= 40 GROUP BY 1, 2, 3, 4) SELECT schedule, tbl, serial, fy, codes, n_codes FROM heads LEFT JOIN c USING (schedule, tbl, serial, fy)")
def schedule_codes(spark, d):
    codes, heads = _entries(spark, d)
    out = tariff.schedule_codes(heads, codes.filter("serial <= 40"), ["schedule", "tbl", "serial", "fy"])
    return out.withColumn("n_codes", F.when(F.col("codes").isNotNull(), F.size("codes")).cast("long")).withColumn("codes", F.when(F.col("codes").isNotNull(), F.array_join("codes", ",")))


@query(f"WITH {_ENTRIES} SELECT fy, schedule, count(*) AS n_entries, count(DISTINCT tbl) AS n_tables FROM heads GROUP BY 1, 2")
def schedule_editions(spark, d):
    return tariff.schedule_editions(_entries(spark, d)[1])


@query(f"""WITH {_ENTRIES} SELECT schedule, tbl, serial, count(DISTINCT fy) AS editions, min(fy) AS first_fy, max(fy) AS last_fy, count(DISTINCT code) AS n_codes, max(fy) = (SELECT max(fy) FROM entries) AS in_latest FROM entries GROUP BY 1, 2, 3""")
def schedule_spans(spark, d):
    codes, heads = _entries(spark, d)
    return tariff.schedule_spans(heads, codes)


_FREE = """free AS (SELECT CAST(s_suppkey AS BIGINT) AS entry, CAST(2024 + s_suppkey % 3 AS INTEGER) AS fy, CAST(0 AS INTEGER) AS item, lpad(CAST(s_suppkey * 4 % 100 AS VARCHAR), 2, '0') AS low, CAST(s_suppkey % 4 AS INTEGER) AS kind FROM supplier)"""


def _free(spark, d):
    """Entries whose text prints a heading, a subheading, a code or a range, among other words."""
    s, k = read_table(spark, d, "supplier"), F.col("s_suppkey")
    low = F.lpad((k * 4 % 100).cast("string"), 2, "0")
    text = F.when(k % 4 == 0, F.concat(F.lit("goods of heading 00.00 but not No. 12, see 99.17"))).when(k % 4 == 1, F.concat(F.lit("sub-heading 0000."), low)).when(k % 4 == 2, F.concat(F.lit("(PCT 0000.00"), low, F.lit(") only"))).otherwise(F.concat(F.lit("0000.00"), low, F.lit(" to 0000.99"), low, F.lit(", and 00.07")))
    return s.select(k.cast("long").alias("entry"), (2024 + k % 3).cast("int").alias("fy"), F.lit(0).alias("item"), text.alias("text"))


_TOKENS = """tokens AS (SELECT entry, fy, 'heading' AS kind, '0000' AS lo, '0000' AS hi FROM free WHERE kind = 0 UNION ALL SELECT entry, fy, 'subheading', '0000' || low, '0000' || low FROM free WHERE kind = 1
UNION ALL SELECT entry, fy, 'code', '000000' || low, '000000' || low FROM free WHERE kind = 2 UNION ALL SELECT entry, fy, 'range', '000000' || low, '000099' || low FROM free WHERE kind = 3 UNION ALL SELECT entry, fy, 'heading', '0007', '0007' FROM free WHERE kind = 3)"""
_COVERS = "t.fy = k.fy AND t.code >= k.lo AND (CASE kind WHEN 'range' THEN t.code <= k.hi ELSE starts_with(t.code, k.lo) END)"


@query(f"""WITH {A.TARIFF}, {_FREE}, {_TOKENS}, m AS (SELECT entry, k.fy, kind, lo, hi, t.code, row_number() OVER (PARTITION BY entry, k.fy, t.code ORDER BY CASE kind WHEN 'range' THEN 0 ELSE 1 END, lo) AS rn FROM tokens k JOIN tariff t ON {_COVERS})
SELECT entry, fy, CAST(0 AS INTEGER) AS item, kind, lo, hi, code FROM m WHERE rn = 1""")
def expand_entries(spark, d):
    return tariff.expand_entries(_free(spark, d), A.tariff(spark, d))[0]


@query(f"WITH {A.TARIFF}, {_FREE}, {_TOKENS} SELECT DISTINCT entry, fy, kind, lo, hi FROM tokens k WHERE NOT EXISTS (SELECT 1 FROM tariff t WHERE {_COVERS})")
def printed_code_rejects(spark, d):
    return tariff.expand_entries(_free(spark, d), A.tariff(spark, d))[1]


_RD = """rd AS (SELECT CAST(s_suppkey AS BIGINT) AS entry, CAST(2024 + s_suppkey % 3 AS INTEGER) AS fy, substring('000000' || lpad(CAST(s_suppkey * 11 % 100 AS VARCHAR), 2, '0'), 1, CAST(4 + 2 * (s_suppkey % 3) AS INTEGER)) AS printed,
CASE WHEN s_suppkey % 3 = 0 THEN 'all except 0000.00' || CAST(30 + s_suppkey % 9 AS VARCHAR) ELSE 'plain' END AS description, CASE WHEN s_suppkey % 5 <> 0 THEN CAST(5 * (s_suppkey % 4) AS DOUBLE) END AS rate_pct FROM supplier)"""


@query(f"""WITH {A.TARIFF}, {_RD}, m AS (SELECT e.*, t.code FROM rd e JOIN tariff t ON t.fy = e.fy AND starts_with(t.code, e.printed) WHERE rate_pct IS NOT NULL
AND (length(printed) = 8 OR e.description = 'plain' OR NOT starts_with(t.code, '000000' || right(e.description, 2)))),
b AS (SELECT *, max(length(printed)) OVER (PARTITION BY fy, code) AS best FROM m)
SELECT fy, code, CASE WHEN count(DISTINCT rate_pct) = 1 THEN max(rate_pct) END AS rate_pct, CASE WHEN count(DISTINCT rate_pct) > 1 THEN string_agg(printf('%.1f%%', rate_pct) || ' (' || description || ')', '; ' ORDER BY entry) END AS rate_text
FROM b WHERE length(printed) = best GROUP BY 1, 2""")
def regulatory_duty(spark, d):
    k = F.col("s_suppkey")
    printed = F.substring(F.concat(F.lit("000000"), F.lpad((k * 11 % 100).cast("string"), 2, "0")), F.lit(1), (4 + 2 * (k % 3)).cast("int"))
    e = read_table(spark, d, "supplier").select(k.cast("long").alias("entry"), (2024 + k % 3).cast("int").alias("fy"), printed.alias("printed"), F.when(k % 3 == 0, F.concat(F.lit("all except 0000.00"), (30 + k % 9).cast("string"))).otherwise("plain").alias("description"), F.when(k % 5 != 0, (5 * (k % 4)).cast("double")).alias("rate_pct"), F.lit(None).cast("string").alias("rate_text"))
    return tariff.regulatory_duty(e, A.tariff(spark, d))


@query(f"""WITH {A.TARIFF}, cd AS (SELECT * FROM duties WHERE component = 'cd'), listed AS (SELECT code, fy, CAST(1 AS DOUBLE) AS listed_pct FROM tariff WHERE right(code, 1) = '3')
SELECT fy, code, rate_pct, CASE WHEN starts_with(code, '000005') OR starts_with(code, '00000370') THEN NULL WHEN listed_pct IS NOT NULL THEN listed_pct WHEN rate_pct IS NULL THEN 4.0 WHEN rate_pct = 0 THEN 2.0 WHEN rate_pct = 5 THEN 3.0 WHEN rate_pct >= 15 THEN 7.0 END AS acd_pct
FROM cd LEFT JOIN listed USING (code, fy)""")
def additional_duty(spark, d):
    t, cd = A.tariff(spark, d), A.duties(spark, d).filter("component = 'cd'")
    years = t.select("fy").distinct()
    each = lambda *pairs: years.select("fy", F.explode(F.array(*[F.struct(*[F.lit(v).alias(k) for k, v in p.items()]) for p in pairs])).alias("x")).select("fy", "x.*")
    listed = t.filter(F.col("code").endswith("3")).select("fy", "code", F.lit(1.0).alias("listed_pct"))
    return tariff.additional_duty(cd, each({"prefix": "000005"}, {"prefix": "00000370"}), listed, each({"base": 0.0, "slab_pct": 2.0}, {"base": 5.0, "slab_pct": 3.0}), each({"specific_pct": 4.0, "higher_from": 15.0, "higher_pct": 7.0}))


@query(f"WITH {A.TARIFF} SELECT left(code, 4) AS heading, fy, count(*) AS codes, min(rate_pct) AS min_pct, max(rate_pct) AS max_pct, count(rate_text) AS specific FROM duties WHERE component = 'cd' GROUP BY 1, 2")
def duty_range(spark, d):
    return tariff.duty_range(A.duties(spark, d))


@query(f"""WITH {A.TRADE}, s AS (SELECT flow, fy, code, sum(value) AS parts, count(*) AS lines FROM trade GROUP BY 1, 2, 3), t AS (SELECT *, parts * CASE WHEN fy % 4 = 0 THEN 1.01 ELSE 1.0001 END AS total FROM s)
SELECT flow, fy, code, round(total, 4) AS total, round(parts, 4) AS parts, lines, round(parts - total, 4) AS gap FROM t WHERE abs(parts - total) > 1 + lines / 2 AND abs(parts - total) > abs(total) / 500""")
def reconcile_totals(spark, d):
    t = A.trade(spark, d)
    totals = t.groupBy("flow", "fy", "code").agg(F.sum("value").alias("v")).select("flow", "fy", "code", (F.col("v") * F.when(F.col("fy") % 4 == 0, 1.01).otherwise(1.0001)).alias("total"))
    return rounded(tariff.reconcile_totals(t, totals), "total", "parts", "gap", digits=4)


@query(f"""WITH {A.CALLS}, g AS (SELECT port, day, count(*) AS n FROM calls GROUP BY 1, 2), p AS (SELECT port, day, n + CASE WHEN day(day) = 9 THEN 1 ELSE 0 END AS printed FROM g WHERE day(day) <> 10)
SELECT port, day, vessel, direction, n = printed AS checks_ok FROM calls JOIN g USING (port, day) LEFT JOIN p USING (port, day)""")
def check_group_totals(spark, d):
    c = A.calls(spark, d).select("port", "day", "vessel", "direction")
    n = c.groupBy("port", "day").agg(F.count(F.lit(1)).alias("n"))
    printed = n.filter(F.dayofmonth("day") != 10).select("port", "day", (F.col("n") + F.when(F.dayofmonth("day") == 9, 1).otherwise(0)).alias("printed"))
    return tariff.check_group_totals(c, printed, ["port", "day"])


@query("""WITH r AS (SELECT l_returnflag AS zone, l_quantity AS arrivals, l_discount AS pressed, l_quantity - l_discount + CASE WHEN l_orderkey % 50 = 0 THEN 5 ELSE 0 END AS stock, l_tax AS sold FROM lineitem),
t AS (SELECT zone, sum(arrivals) AS arrivals, sum(pressed) + CASE WHEN zone = 'A' THEN 9 ELSE 0 END AS pressed, sum(stock) AS stock, CASE WHEN zone <> 'R' THEN sum(sold) END AS sold FROM r GROUP BY 1)
SELECT 'stock' AS "column", count(*) AS n, 'row identity' AS reason FROM r WHERE abs(arrivals - pressed - stock) > 1 HAVING count(*) > 0 UNION ALL SELECT 'pressed', 1, 'zone total' UNION ALL SELECT 'sold', 1, 'zone total' FROM t WHERE zone = 'R'""")
def failed_columns(spark, d):
    q, p = F.col("l_quantity"), F.col("l_discount")
    r = read_table(spark, d, "lineitem").select(F.col("l_returnflag").alias("zone"), q.alias("arrivals"), p.alias("pressed"), (q - p + F.when(F.col("l_orderkey") % 50 == 0, 5).otherwise(0)).alias("stock"), F.col("l_tax").alias("sold"))
    z = F.col("zone")
    t = r.groupBy("zone").agg(F.sum("arrivals").alias("arrivals"), F.sum("pressed").alias("pressed"), F.sum("stock").alias("stock"), F.sum("sold").alias("sold")).select("zone", "arrivals", (F.col("pressed") + F.when(z == "A", 9).otherwise(0)).alias("pressed"), "stock", F.when(z != "R", F.col("sold")).alias("sold"))
    return tariff.failed_columns(r, t, ["arrivals", "pressed", "stock", "sold"], {"stock": F.col("arrivals") - F.col("pressed") - F.col("stock")})


_PRINTS = """prints AS (SELECT CAST(l_linenumber AS INTEGER) AS file_no, CAST(2024 AS INTEGER) AS fy, lpad(CAST(l_partkey AS VARCHAR), 8, '0') AS code, l_orderkey * 10 + l_linenumber AS seq, l_returnflag || CAST(l_suppkey AS VARCHAR) AS description,
CASE WHEN l_suppkey % 2 = 0 THEN 'cd' ELSE 'rd' END AS component, CASE WHEN l_suppkey % 3 <> 0 THEN l_quantity END AS rate_pct FROM lineitem)"""


@query(f"""WITH {_PRINTS}, f AS (SELECT *, row_number() OVER (PARTITION BY fy, code, component, file_no ORDER BY seq, description) AS a FROM prints WHERE rate_pct IS NOT NULL), g AS (SELECT * FROM f WHERE a = 1),
h AS (SELECT *, row_number() OVER (PARTITION BY fy, code, component ORDER BY file_no DESC) AS b, first_value(description) OVER (PARTITION BY fy, code ORDER BY file_no DESC, seq, description DESC) AS said FROM g)
SELECT fy, code, component, rate_pct, said AS description FROM h WHERE b = 1""")
def merge_edition(spark, d):
    li, s = read_table(spark, d, "lineitem"), F.col("l_suppkey")
    prints = li.select(F.col("l_linenumber").cast("int").alias("file_no"), F.lit(2024).alias("fy"), F.lpad(F.col("l_partkey").cast("string"), 8, "0").alias("code"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"), F.concat("l_returnflag", s.cast("string")).alias("description"), F.when(s % 2 == 0, "cd").otherwise("rd").alias("component"), F.when(s % 3 != 0, F.col("l_quantity")).alias("rate_pct"), F.lit(None).cast("string").alias("rate_text"))
    return tariff.merge_edition(prints).drop("rate_text")


@query(f"""WITH {A.TARIFF}, i AS (SELECT code, fy, component, rate_pct + CASE WHEN right(code, 1) = '4' THEN 1 ELSE 0 END AS rate_pct, CASE WHEN right(code, 1) = '6' THEN replace(rate_text, '/kg', '/ton') ELSE rate_text END AS rate_text
FROM duties WHERE component = 'rd' AND right(code, 1) <> '5' AND fy > 2024), a AS (SELECT *, 's' AS side FROM duties UNION ALL SELECT *, 'i' FROM i),
k AS (SELECT code, fy, component, bool_or(side = 's') AS had, bool_or(side = 'i') AS got FROM a GROUP BY 1, 2, 3)
SELECT k.code, k.fy, k.component, CASE WHEN got THEN i.rate_pct ELSE s.rate_pct END AS rate_pct, CASE WHEN got THEN i.rate_text ELSE s.rate_text END AS rate_text,
CASE WHEN NOT had THEN 'new' WHEN NOT got AND k.component = 'rd' AND k.fy IN (SELECT fy FROM i) THEN 'deleted' WHEN NOT got THEN 'kept' WHEN s.rate_pct IS DISTINCT FROM i.rate_pct OR s.rate_text IS DISTINCT FROM i.rate_text THEN 'changed' ELSE 'same' END AS action
FROM k LEFT JOIN duties s ON s.code = k.code AND s.fy = k.fy AND s.component = k.component LEFT JOIN i ON i.code = k.code AND i.fy = k.fy AND i.component = k.component""")
def sync_components(spark, d):
    s, ends = A.duties(spark, d), F.col("code").endswith
    i = s.filter("component <> 'acd' and not endswith(code, '5') and fy > 2024").withColumn("rate_pct", F.col("rate_pct") + F.when(ends("4"), 1).otherwise(0))
    return tariff.sync_components(s, i.withColumn("rate_text", F.when(ends("6"), F.replace("rate_text", F.lit("/kg"), F.lit("/ton"))).otherwise(F.col("rate_text"))), ["rd"])


@query(f"WITH {A.TARIFF} SELECT left(code, 7) AS edition, count(*) AS n FROM tariff GROUP BY 1 HAVING count(*) < 2")
def min_rows_gate(spark, d):
    return tariff.too_few_rows(A.tariff(spark, d).withColumn("edition", F.substring("code", 1, 7)), "edition", 2)


@query(f"""WITH {A.TARIFF}, r AS (SELECT lpad(CAST(l_partkey * 37 % 100000000 AS VARCHAR), 8, '0') AS code, CAST(2024 + l_suppkey % 3 AS INTEGER) AS fy, l_orderkey * 10 + l_linenumber AS seq FROM lineitem), k AS (SELECT r.* FROM r SEMI JOIN tariff t ON t.code = r.code AND t.fy = r.fy)
SELECT code, fy, min(seq) AS seq, true AS known FROM k GROUP BY 1, 2 UNION ALL SELECT r.code, r.fy, r.seq, false FROM r ANTI JOIN tariff t ON t.code = r.code AND t.fy = r.fy""")
def dedupe_first_known(spark, d):
    r = read_table(spark, d, "lineitem").select(F.lpad((F.col("l_partkey") * 37 % 100000000).cast("string"), 8, "0").alias("code"), (2024 + F.col("l_suppkey") % 3).cast("int").alias("fy"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"))
    kept, rejected = tariff.dedupe_first_known(r, A.tariff(spark, d), ["code", "fy"], "seq")
    return kept.withColumn("known", F.lit(True)).unionByName(rejected.withColumn("known", F.lit(False)))


@query("""SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN CAST(p_size AS DOUBLE) WHEN p_size % 3 = 1 THEN p_size + 0.5 END AS rate_pct FROM part""")
def parse_rate(spark, d):
    n = F.col("p_size")
    text = F.when(n % 3 == 0, F.concat(n.cast("string"), F.lit(" %"))).when(n % 3 == 1, F.concat(F.lit(" "), (n + 0.5).cast("string"))).otherwise(F.concat(F.lit("Rs."), n.cast("string"), F.lit("/kg")))
    return read_table(spark, d, "part").select("p_partkey", tariff.parse_rate(text).alias("rate_pct"))
