"""Queries of findings and their verdicts, each with the SQL it must agree with."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.operators import findings, merge, series
from ledgerline.plans import adapters as A
from ledgerline.plans.registry import _SLIPS, _last, _points, _slips, query, rounded
from ledgerline.sources.tables import read_table

_NOW = "2024-01-01"


@query(f"""WITH {A.MONTHLY}, {A.CATALOG}, two AS (SELECT c.series_id, c.canonical_id FROM catalog c JOIN catalog t ON t.series_id = c.canonical_id AND t.frequency = c.frequency AND t.unit IS NOT DISTINCT FROM c.unit WHERE c.is_active)
SELECT a.series_id, canonical_id, a.dims_key, a.obs_date, round(a.value, 6) AS value, round(b.value, 6) AS twin_value FROM two JOIN monthly a USING (series_id) JOIN monthly b ON b.series_id = canonical_id AND b.dims_key = a.dims_key AND b.obs_date = a.obs_date
WHERE abs(a.value - b.value) * 200 > greatest(a.value, b.value)""")
def twin_mismatch(spark, d):
    return rounded(findings.twin_mismatch(A.monthly(spark, d), A.catalog(spark, d)), "value", "twin_value")


_WILD = """wild AS (SELECT series_id, dims_key, obs_date, value * CASE (year(obs_date) + month(obs_date)) % 11 WHEN 0 THEN 1000 WHEN 4 THEN -1 ELSE 1 END AS value FROM monthly)"""


def _wild(spark, d):
    n = (F.year("obs_date") + F.month("obs_date")) % 11
    return A.monthly(spark, d).withColumn("value", F.col("value") * F.when(n == 0, 1000).when(n == 4, -1).otherwise(1))


def _catalog(spark, d):
    return A.catalog(spark, d).withColumn("dataset", F.when(F.col("source") == "source_1", F.col("source")))


_FOUND = f"""{A.MONTHLY}, {A.CATALOG}, {_WILD}, live AS (SELECT w.* FROM wild w JOIN catalog c ON c.series_id = w.series_id AND is_active), {A.around("live", series.KEY)},
n AS (SELECT a.*, unit, CASE WHEN source = 'source_1' THEN 3 ELSE 1 END AS tier, pv / nv AS pn, value / pv AS vp FROM around a JOIN catalog USING (series_id)),
r AS (SELECT series_id, dims_key, median(abs(value - pv)) AS mad FROM n WHERE unit = 'percent' GROUP BY 1, 2),
s AS (SELECT *, pow(1000.0, round(ln(abs(value) / exp((ln(abs(pv)) + ln(abs(nv))) / 2)) / ln(1000.0))) AS f FROM n WHERE unit NOT IN ('percent', 'index', 'ratio') AND value * pv > 0 AND value * nv > 0 AND pn BETWEEN 0.67 AND 1.5 AND least(abs(pv), abs(nv)) >= 1),
found AS (SELECT series_id, dims_key, obs_date, value, pv, nv, tier, 'spike_level' AS detector FROM n WHERE unit <> 'percent' AND value * pv > 0 AND pv * nv > 0 AND pn > 0.7 AND pn < 1.3 AND (vp > 3 OR vp < 1.0 / 3)
UNION ALL SELECT series_id, dims_key, obs_date, value, pv, nv, tier, 'spike_rate' FROM n JOIN r USING (series_id, dims_key) WHERE unit = 'percent' AND abs(pv - nv) <= greatest(2 * mad, 0.2) AND abs(value - (pv + nv) / 2) > greatest(8 * mad, 1.0)
UNION ALL SELECT series_id, dims_key, obs_date, value, pv, nv, tier, 'sign_flip' FROM n WHERE pn > 0.8 AND pn < 1.2 AND vp > -1.2 AND vp < -0.8
UNION ALL SELECT series_id, dims_key, obs_date, value, pv, nv, tier, 'scale_slip' FROM s WHERE f <> 1 AND abs(value / f) >= 0.8 * least(abs(pv), abs(nv)) AND abs(value / f) <= 1.25 * greatest(abs(pv), abs(nv))
UNION ALL SELECT series_id, dims_key, obs_date, value, pv, nv, tier, 'out_of_range' FROM n WHERE CASE unit WHEN 'percent' THEN value NOT BETWEEN -100 AND 1000 WHEN 'pkr_per_kg' THEN value <= 0 ELSE value < 0 END)"""


@query(f"WITH {_FOUND} SELECT series_id, dims_key, obs_date, round(value, 4) AS value, round(pv, 4) AS pv, round(nv, 4) AS nv, detector, CAST(tier AS INTEGER) AS tier FROM found")
def run_detectors(spark, d):
    return rounded(findings.run_detectors(_wild(spark, d), _catalog(spark, d)), "value", "pv", "nv", digits=4)


@query(f"WITH {_SLIPS}, f AS (SELECT series_id, dims_key, obs_date, factor FROM found WHERE factor <> 1 AND abs(value) / factor >= lo * 4 / 5 AND abs(value) / factor <= hi * 5 / 4) SELECT series_id, dims_key, obs_date, round(value / coalesce(factor, 1), 4) AS value FROM slip LEFT JOIN f USING (series_id, dims_key, obs_date)")
def fix_scale(spark, d):
    obs, slips = _slips(spark, d)
    return rounded(findings.fix_scale(obs, slips, F.lit(_NOW).cast("timestamp"))[0], "value", digits=4)


@query(f"WITH {_SLIPS} SELECT series_id, dims_key, obs_date, round(value, 4) AS old_value, round(value / factor, 4) AS new_value, factor, TIMESTAMP '2024-01-01' AS corrected_at FROM found WHERE factor <> 1 AND abs(value) / factor >= lo * 4 / 5 AND abs(value) / factor <= hi * 5 / 4")
def scale_corrections(spark, d):
    return rounded(findings.fix_scale(*_slips(spark, d), F.lit(_NOW).cast("timestamp"))[1], "old_value", "new_value", digits=4)


@query("SELECT o_orderkey, round(o_totalprice, 2) AS price, CASE WHEN o_orderstatus IN ('F', 'O') AND (o_totalprice < 50000 OR o_totalprice > 150000) THEN 'price_out_of_range' END AS reason FROM orders")
def range_gate(spark, d):
    o = read_table(spark, d, "orders").select("o_orderkey", F.round("o_totalprice", 2).alias("price"), "o_orderstatus")
    kept, aside = findings.range_gate(o, "price", 50000, 150000, "price_out_of_range", F.col("o_orderstatus").isin("F", "O"))
    return kept.withColumn("reason", F.lit(None).cast("string")).unionByName(aside).drop("o_orderstatus")


_SIDES = f"a AS {_last('WHERE o_orderkey % 5 <> 0')}, b AS (SELECT * REPLACE (value * CASE seq % 7 WHEN 0 THEN 1.01 WHEN 1 THEN 1000 ELSE 1 END AS value) FROM {_last('WHERE o_orderkey % 5 <> 1')})"


def _sides(spark, d):
    p, n = _points(spark, d), F.col("seq") % 7
    ours = merge.dedupe_last(p.filter("seq % 5 <> 0"), merge.POINT, "seq")
    theirs = merge.dedupe_last(p.filter("seq % 5 <> 1"), merge.POINT, "seq")
    return ours, theirs.withColumn("value", F.col("value") * F.when(n == 0, 1.01).when(n == 1, 1000).otherwise(1))


@query(f"""WITH {_SIDES} SELECT a.series_id, a.obs_date, a.dims_key, round(a.value, 2) AS value, round(b.value, 2) AS theirs,
CASE WHEN b.value IS NULL THEN 'not_in_source' WHEN abs(a.value / b.value - 1) < 1e-6 THEN 'confirmed' WHEN abs(a.value * 1000 / b.value - 1) < 1e-3 THEN 'scale_corrected' ELSE 'differs' END AS verdict
FROM a LEFT JOIN b USING (series_id, obs_date, dims_key) WHERE a.value > 300000""")
def reconcile_verdicts(spark, d):
    ours, theirs = _sides(spark, d)
    out = findings.verdicts(ours.filter("value > 300000").drop("seq"), merge.compare_points(ours, theirs, merge.POINT))
    return rounded(out, "value", "theirs", digits=2)


@query(f"""WITH {_SIDES}, c AS (SELECT * FROM b WHERE year(obs_date) BETWEEN 1997 AND 1999), s AS (SELECT series_id, dims_key, min(obs_date) AS f, max(obs_date) AS l FROM c GROUP BY 1, 2), o AS (SELECT a.* FROM a JOIN s USING (series_id, dims_key) WHERE obs_date BETWEEN f AND l)
SELECT coalesce(o.series_id, c.series_id) AS series_id, coalesce(o.obs_date, c.obs_date) AS obs_date, coalesce(o.dims_key, c.dims_key) AS dims_key, round(o.value, 2) AS ours, round(c.value, 2) AS theirs,
CASE WHEN o.seq IS NULL THEN 'missing_ours' WHEN c.seq IS NULL THEN 'missing_source' WHEN abs(o.value / c.value - 1) < 1e-6 THEN 'matched' ELSE 'value' END AS kind FROM o FULL JOIN c ON o.series_id = c.series_id AND o.obs_date = c.obs_date AND o.dims_key = c.dims_key""")
def compare_partial(spark, d):
    ours, theirs = _sides(spark, d)
    return rounded(findings.compare_partial(ours, theirs.filter("year(obs_date) between 1997 and 1999"), merge.POINT), "ours", "theirs", digits=2)


_NAV2 = f"""{A.NAVS}, ours AS (SELECT * FROM navs WHERE day(obs_date) <> 3), src AS (SELECT fund_id, obs_date, floor(nav * 10 + 0.5) / 10 + CASE WHEN day(obs_date) = 20 THEN 7 ELSE 0 END AS nav FROM navs WHERE day(obs_date) <> 4 AND obs_date < DATE '2001-01-01'),
q AS (SELECT fund_id, obs_date FROM navs WHERE day(obs_date) = 3 AND fund_id % 2 = 0)"""


def _nav_sides(spark, d):
    n, day = A.navs(spark, d).withColumnRenamed("nav", "value"), F.dayofmonth("obs_date")
    source = n.filter((day != 4) & (F.col("obs_date") < "2001-01-01")).withColumn("value", F.floor(F.col("value") * 10 + 0.5) / 10 + F.when(day == 20, 7).otherwise(0))
    return n.filter(day != 3), source.withColumn("printed", F.format_string("%.1f", "value")), n.filter((day == 3) & (F.col("fund_id") % 2 == 0)).select("fund_id", "obs_date")


@query(f"""WITH {_NAV2}, e AS (SELECT fund_id, max(obs_date) AS e FROM src GROUP BY 1), j AS (SELECT coalesce(o.fund_id, s.fund_id) AS fund_id, coalesce(o.obs_date, s.obs_date) AS obs_date, o.nav AS ours, s.nav AS theirs FROM ours o FULL JOIN src s ON o.fund_id = s.fund_id AND o.obs_date = s.obs_date)
SELECT j.fund_id, j.obs_date, round(ours, 4) AS ours, round(theirs, 4) AS theirs, CASE WHEN ours IS NULL AND q.fund_id IS NOT NULL THEN 'quarantined' WHEN ours IS NULL THEN 'missing_ours' WHEN theirs IS NULL THEN 'missing_source' WHEN abs(ours - theirs) <= 1e-6 * greatest(ours, theirs) THEN 'matched' ELSE 'value' END AS kind
FROM j LEFT JOIN q ON q.fund_id = j.fund_id AND q.obs_date = j.obs_date LEFT JOIN e ON e.fund_id = j.fund_id WHERE NOT (theirs IS NULL AND j.obs_date > coalesce(e, DATE '0001-01-01'))""")
def reconcile_navs(spark, d):
    ours, source, aside = _nav_sides(spark, d)
    return rounded(findings.reconcile_with_quarantine(ours, source, aside, ["fund_id", "obs_date"]), "ours", "theirs", digits=4)


@query(f"""WITH {_NAV2}, t AS (SELECT DISTINCT fund_id FROM navs WHERE fund_id % 3 <> 0), e AS (SELECT fund_id, max(obs_date) AS e FROM src GROUP BY 1),
j AS (SELECT coalesce(o.fund_id, s.fund_id) AS fund_id, coalesce(o.obs_date, s.obs_date) AS obs_date, o.nav AS ours, s.nav AS theirs FROM ours o FULL JOIN src s ON o.fund_id = s.fund_id AND o.obs_date = s.obs_date),
k AS (SELECT j.*, CASE WHEN ours IS NULL AND theirs > 0 AND NOT EXISTS (SELECT 1 FROM q WHERE q.fund_id = j.fund_id AND q.obs_date = j.obs_date) THEN 'insert' WHEN theirs IS NULL AND j.obs_date < e THEN 'delete' WHEN abs(ours - theirs) > 0.05 + 1e-9 THEN 'update' END AS action FROM j SEMI JOIN t USING (fund_id) LEFT JOIN e ON e.fund_id = j.fund_id)
SELECT fund_id, obs_date, action, round(ours, 4) AS ours, round(theirs, 4) AS theirs FROM k WHERE action IS NOT NULL""")
def apply_source(spark, d):
    ours, source, aside = _nav_sides(spark, d)
    trusted = ours.select("fund_id").distinct().filter("fund_id % 3 <> 0")
    return rounded(findings.apply_source(ours, source, aside, trusted, "fund_id"), "ours", "theirs", digits=4)


@query(f"""WITH {_FOUND}, c AS (SELECT f.*, source, abs(value / pv) AS up, abs(pv / value) AS down FROM found f JOIN catalog USING (series_id) WHERE detector IN ('spike_level', 'out_of_range') AND year(obs_date) = 1999 AND dims_key LIKE '%"A"%'),
k AS (SELECT * FROM c WHERE detector = 'out_of_range' OR greatest(up, down) >= 100), few AS (SELECT series_id FROM k GROUP BY 1 HAVING count(*) < 3)
SELECT series_id, obs_date, dims_key, detector, 'As published by ' || source || ', re-checked at the source. ' || CASE detector WHEN 'out_of_range' THEN 'Unusual for its unit.' ELSE 'About ' || format('{{:,}}', CAST(round(greatest(up, down) / pow(10, floor(log10(greatest(up, down))) - 1)) * pow(10, floor(log10(greatest(up, down))) - 1) AS BIGINT)) || ' times ' || CASE WHEN up > 1 THEN 'above' ELSE 'below' END || ' the periods either side'
|| CASE WHEN (abs(value) / 1000 BETWEEN least(abs(pv), abs(nv)) * 0.8 AND greatest(abs(pv), abs(nv)) * 1.25) OR (abs(value) * 1000 BETWEEN least(abs(pv), abs(nv)) * 0.8 AND greatest(abs(pv), abs(nv)) * 1.25) THEN ', which suggests a unit slip in the source''s figure.' ELSE '.' END END AS note FROM k SEMI JOIN few USING (series_id)""")
def make_notes(spark, d):
    found = findings.run_detectors(_wild(spark, d), _catalog(spark, d), ["spike_level", "out_of_range"]).join(A.catalog(spark, d).select("series_id", "source"), "series_id")
    return findings.make_notes(found.filter((F.year("obs_date") == 1999) & F.contains("dims_key", F.lit('"A"'))).withColumn("verdict", F.lit("confirmed")))


@query(f"""WITH {A.MONTHLY}, f AS (SELECT series_id, obs_date, max(value) AS v FROM monthly GROUP BY 1, 2), i AS (SELECT 'in.' || series_id AS input_id, obs_date, CASE WHEN month(obs_date) = 2 THEN v + 1 ELSE v END AS iv FROM f WHERE month(obs_date) <> 7)
SELECT series_id, f.obs_date, round(v, 6) AS value, 'in.' || series_id AS input_id, round(iv, 6) AS input_value, CASE WHEN iv IS NULL OR abs(iv - v) > 1e-9 * v THEN 'copy_differs' WHEN ends_with(series_id, '3') THEN 'not_reconciled' WHEN month(f.obs_date) = 4 THEN 'source_differs' ELSE 'confirmed' END AS verdict
FROM f LEFT JOIN i ON i.input_id = 'in.' || series_id AND i.obs_date = f.obs_date""")
def copy_verdicts(spark, d):
    f = A.monthly(spark, d).groupBy("series_id", "obs_date").agg(F.max("value").alias("value"))
    month = F.month("obs_date")
    to_input = F.concat(F.lit("in."), "series_id")
    inputs = f.filter(month != 7).select(to_input.alias("series_id"), "obs_date", (F.col("value") + F.when(month == 2, 1).otherwise(0)).alias("value"))
    sources = f.select("series_id", to_input.alias("input_id")).distinct()
    return rounded(findings.copy_verdicts(f, sources, inputs, inputs.filter("not endswith(series_id, '3')"), inputs.filter(month == 4)), "value", "input_value")


@query("""WITH c AS (SELECT p_partkey AS series_id, p_name AS name, 'size ' || CAST(p_size % 3 AS VARCHAR) AS a, CASE WHEN p_partkey % 20 <> 0 THEN p_type ELSE '' END AS b, p_brand AS c FROM part), n AS (SELECT *, count(*) OVER (PARTITION BY name) AS n FROM c),
s1 AS (SELECT *, (SELECT count(DISTINCT x.a) FROM c x WHERE x.name = n.name) > 1 AS ua FROM n WHERE n > 1), g1 AS (SELECT *, CASE WHEN ua THEN a ELSE '' END AS k1 FROM s1),
d2 AS (SELECT name, k1, count(DISTINCT b) > 1 AND min(length(b)) > 0 AS ub FROM g1 GROUP BY 1, 2), g2 AS (SELECT g1.*, ub, CASE WHEN ub THEN b ELSE '' END AS k2 FROM g1 JOIN d2 USING (name, k1)),
d3 AS (SELECT name, k1, k2, count(DISTINCT c) > 1 AS uc FROM g2 GROUP BY 1, 2, 3)
SELECT series_id, name, concat_ws(', ', CASE WHEN ua THEN a END, CASE WHEN ub THEN b END, CASE WHEN uc THEN c END) AS qualifier FROM g2 JOIN d3 USING (name, k1, k2) WHERE ua OR ub OR uc""")
def disambiguate_names(spark, d):
    c = read_table(spark, d, "part").select(F.col("p_partkey").alias("series_id"), F.col("p_name").alias("name"), F.concat(F.lit("size "), (F.col("p_size") % 3).cast("string")).alias("a"), F.when(F.col("p_partkey") % 20 != 0, F.col("p_type")).otherwise("").alias("b"), F.col("p_brand").alias("c"))
    return findings.disambiguate_names(c, [F.col("a"), F.col("b"), F.col("c")])


_BLOCKS = """h AS (SELECT event_type AS block, CAST(ts AS DATE) AS month, CAST(hour(ts) AS INTEGER) AS hour, CASE WHEN day(ts) IN (3, 4) AND event_type = 'click' THEN hour(ts) ELSE round(avg(value) + CASE WHEN day(ts) = 8 THEN 500 ELSE 0 END, 4) END AS value FROM events GROUP BY event_type, CAST(ts AS DATE), hour(ts), day(ts)),
p AS (SELECT CAST(ts AS DATE) AS month, CAST(hour(ts) AS INTEGER) AS hour, avg(value) AS price FROM events GROUP BY 1, 2)"""


@query(f"""WITH {_BLOCKS}, g AS (SELECT block, h.month, avg(abs(value - price)) AS gap, count(*) AS n FROM h JOIN p ON p.month = h.month AND p.hour = h.hour GROUP BY 1, 2), s AS (SELECT block, month, list(hour || ':' || value ORDER BY hour) AS sign FROM h GROUP BY 1, 2)
SELECT block, month, 'profile' AS reason FROM g WHERE n >= 5 AND gap > 100 UNION ALL SELECT block, month, 'repeated' FROM s WHERE (SELECT count(*) FROM s x WHERE x.block = s.block AND x.sign = s.sign) > 1""")
def mislabelled_blocks(spark, d):
    e = read_table(spark, d, "events").select(F.col("event_type").alias("block"), F.to_date("ts").alias("month"), F.hour("ts").alias("hour"), "value")
    day = F.dayofmonth("month")
    m = e.groupBy("block", "month", "hour").agg(F.avg("value").alias("v")).select("block", "month", "hour", F.when(day.isin(3, 4) & (F.col("block") == "click"), F.col("hour").cast("double")).otherwise(F.round(F.col("v") + F.when(day == 8, 500).otherwise(0), 4)).alias("value"))
    return findings.mislabelled_blocks(m, e.select("month", "hour", "value"), 100, 5)


@query("""WITH r AS (SELECT l_orderkey * 10 + l_linenumber AS id, l_quantity AS a, CASE WHEN l_suppkey % 4 <> 0 THEN l_quantity + CASE WHEN l_linenumber = 1 THEN 2 ELSE 0.5 END END AS b, CASE WHEN l_suppkey % 4 <> 0 THEN l_extendedprice * CASE WHEN l_linenumber = 2 THEN 1.001 ELSE 1 END END AS c, l_extendedprice AS e FROM lineitem)
SELECT id, concat_ws(',', CASE WHEN abs(a - b) > 1 THEN 'teu' END, CASE WHEN abs(e - c) > greatest(1, 0.0001 * e) THEN 'manifest' END) AS failed, CASE WHEN b IS NOT NULL OR c IS NOT NULL THEN abs(a - b) <= 1 AND abs(e - c) <= greatest(1, 0.0001 * e) END AS checks_ok FROM r""")
def row_identities(spark, d):
    li, known = read_table(spark, d, "lineitem"), F.col("l_suppkey") % 4 != 0
    q, e = F.col("l_quantity"), F.col("l_extendedprice")
    rows = li.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), q.alias("a"), F.when(known, q + F.when(F.col("l_linenumber") == 1, 2).otherwise(0.5)).alias("b"), F.when(known, e * F.when(F.col("l_linenumber") == 2, 1.001).otherwise(1)).alias("c"), e.alias("e"))
    out = findings.row_identities(rows, {"teu": (F.col("a"), F.col("b"), 1.0, 0.0), "manifest": (F.col("e"), F.col("c"), 1.0, 0.0001)})
    return out.select("id", F.array_join("failed", ",").alias("failed"), "checks_ok")


@query("""WITH s AS (SELECT o_orderpriority AS port, CAST(o_orderdate AS DATE) AS day, o_orderkey AS seq, o_custkey % 3 AS total FROM orders) SELECT port, day, seq, total, total IS NOT DISTINCT FROM first_value(total) OVER (PARTITION BY port, day ORDER BY seq) AS accepted FROM s""")
def stale_date_guard(spark, d):
    s = read_table(spark, d, "orders").select(F.col("o_orderpriority").alias("port"), F.to_date("o_orderdate").alias("day"), F.col("o_orderkey").alias("seq"), (F.col("o_custkey") % 3).alias("total"))
    return findings.stale_date_guard(s, ["port", "day"], "total", "seq")


@query("""SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE 2 END AS dp, abs(o_totalprice - round(o_totalprice + CASE WHEN o_custkey % 5 = 0 THEN 1 ELSE 0 END, CAST(o_orderkey % 3 AS INTEGER))) <= 0.5 * pow(10.0, -(o_orderkey % 3)) + 1e-9 AS same FROM orders""")
def rounds_to(spark, d):
    k, v = F.col("o_orderkey") % 3, F.col("o_totalprice") + F.when(F.col("o_custkey") % 5 == 0, 1).otherwise(0)
    printed = F.when(k == 0, F.format_string("%.0f", F.round(v, 0))).when(k == 1, F.format_string("%.1f", F.round(v, 1))).otherwise(F.format_string("%.2f", F.round(v, 2)))
    o = read_table(spark, d, "orders").select("o_orderkey", "o_totalprice", printed.alias("printed"))
    return o.select("o_orderkey", findings.decimals(F.col("printed")).alias("dp"), findings.rounds_to(F.col("o_totalprice"), F.col("printed")).alias("same"))
