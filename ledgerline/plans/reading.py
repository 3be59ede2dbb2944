"""Queries of the read path and of search, each with the SQL it must agree with."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.operators import reads
from ledgerline.plans import adapters as A
from ledgerline.plans.registry import query, rounded
from ledgerline.sources.tables import read_table


def _today():
    return F.lit("2001-06-30").cast("date")


@query(f"""WITH {A.MONTHLY} SELECT series_id, dims_key, obs_date, round(value, 6) AS value FROM monthly
WHERE series_id = 'Brand#12' AND obs_date BETWEEN DATE '1996-01-01' AND DATE '1999-12-31' AND dims_key = '{{"flag":"A"}}' ORDER BY obs_date DESC LIMIT 24""")
def observations_window(spark, d):
    return rounded(reads.observations_window(A.monthly(spark, d), "Brand#12", "1996-01-01", "1999-12-31", {"flag": "A"}, 24, True), "value")


@query(f"""WITH {A.CATALOG} SELECT series_id, name, module, source FROM catalog WHERE is_active AND module = 'module_1' AND canonical_id IS NULL
AND (series_id || '|' || name || '|' || description) ILIKE '%brand#1%' ORDER BY series_id LIMIT 5 OFFSET 1""")
def catalog_page(spark, d):
    found = reads.catalog_filter(A.catalog(spark, d), module="module_1", q="BRAND#1", canonical_only=True)
    return reads.ordered_page(found, ["series_id"], 5, 1).select("series_id", "name", "module", "source")


@query(f"""WITH {A.MONTHLY}, n AS (SELECT series_id, dims_key, max(obs_date) AS obs_date, 'highest of ' || series_id AS note FROM monthly WHERE value > 60000 GROUP BY 1, 2)
SELECT m.series_id, m.dims_key, m.obs_date, round(value, 6) AS value, note FROM monthly m LEFT JOIN n USING (series_id, dims_key, obs_date)""")
def notes_for(spark, d):
    m = A.monthly(spark, d)
    notes = m.filter("value > 60000").groupBy("series_id", "dims_key").agg(F.max("obs_date").alias("obs_date")).withColumn("note", F.concat(F.lit("highest of "), "series_id"))
    return rounded(reads.notes_for(m, notes), "value")


@query(f"WITH {A.MONTHLY} SELECT series_id, dims_key, obs_date FROM monthly WHERE obs_date >= DATE '1999-06-30'")
def history_floor(spark, d):
    return reads.history_floor(A.monthly(spark, d), 2, _today()).select("series_id", "dims_key", "obs_date")


@query(f"""WITH {A.TRADE} SELECT 'code' AS kind, count(*) AS n FROM trade WHERE code = '00000042' UNION ALL SELECT 'prefix', count(*) FROM trade WHERE code LIKE '0000001%'
UNION ALL SELECT 'heading', count(*) FROM trade WHERE left(code, 4) = '0000' UNION ALL SELECT 'subheading', count(*) FROM trade WHERE substring(code, 1, 6) = '000001'""")
def code_filters(spark, d):
    t = A.trade(spark, d)
    kinds = {"code": reads.code_filter(t, " 00000042"), "prefix": reads.code_filter(t, "0000001*"), "heading": reads.heading_filter(t, "0000"), "subheading": reads.pct_filter(t, "0000.01")}
    out = None
    for kind, df in kinds.items():
        one = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(kind).alias("kind"), "n")
        out = one if out is None else out.unionByName(one)
    return out


@query("""SELECT lower(n_name) AS asked, n_name AS country FROM nation WHERE n_nationkey % 2 = 0 UNION ALL SELECT 'no ' || n_name, 'no ' || n_name FROM nation WHERE n_nationkey % 2 = 1""")
def canonical_countries(spark, d):
    n = read_table(spark, d, "nation")
    asked = n.select(F.when(F.col("n_nationkey") % 2 == 0, F.lower("n_name")).otherwise(F.concat(F.lit("no "), "n_name")).alias("asked"))
    return reads.canonical_countries(asked, n.select(F.col("n_name").alias("country")))


@query(f"""WITH {A.CALLS} SELECT port, day, direction, vessel, round(tonnes, 2) AS tonnes FROM calls WHERE port = '1-URGENT' AND direction = 'import' AND day BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'
ORDER BY tonnes DESC, vessel LIMIT 40""")
def listing(spark, d):
    out = reads.listing(A.calls(spark, d), {"port": "1-URGENT", "direction": "import", "commodity": None}, "day", "1996-01-01", "1996-12-31", [F.desc("tonnes"), F.col("vessel")], 40)
    return rounded(out.select("port", "day", "direction", "vessel", "tonnes"), "tonnes", digits=2)


@query(f"WITH {A.CALLS}, m AS (SELECT port, max(day) AS day FROM calls GROUP BY 1) SELECT port, day, direction, commodity, vessel, round(tonnes, 2) AS tonnes FROM calls JOIN m USING (port, day)")
def vessels(spark, d):
    return rounded(reads.snapshot(A.calls(spark, d)), "tonnes", digits=2)


@query(f"""WITH {A.CALLS} SELECT port, day, count(*) AS n FROM calls GROUP BY 1, 2""")
def statement_dates(spark, d):
    return A.calls(spark, d).groupBy("port", "day").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {A.CODES} SELECT code, name FROM codes WHERE starts_with(code, 'red 1') OR (contains(lower(name || ' ' || short_name || ' ' || heading || ' ' || description), 'red')
AND contains(lower(name || ' ' || short_name || ' ' || heading || ' ' || description), '1'))""")
def products_search(spark, d):
    return reads.products_search(A.codes(spark, d), " Red 1").select("code", "name")


@query(f"""WITH {A.MONTHLY}, {A.NAVS} SELECT 'observations' AS name, count(*) AS n FROM monthly WHERE obs_date > DATE '2001-07-03'
UNION ALL SELECT 'navs', count(*) FROM navs WHERE obs_date > DATE '2001-07-03'""")
def future_rows(spark, d):
    return reads.future_rows({"observations": A.monthly(spark, d), "navs": A.navs(spark, d)}, _today())


@query(f"""WITH {A.RULINGS} SELECT l_orderkey AS ruling_id, CAST(l_linenumber AS BIGINT) AS line_no, r.kind, round(l_extendedprice, 2) AS value FROM lineitem JOIN rulings r ON l_orderkey = r.ruling_id
WHERE r.kind <> 'withdrawal' AND r.issued_on <= DATE '1999-01-01' AND (r.superseded_on IS NULL OR r.superseded_on > DATE '1999-01-01')""")
def in_force(spark, d):
    values = read_table(spark, d, "lineitem").select(F.col("l_orderkey").alias("ruling_id"), F.col("l_linenumber").cast("long").alias("line_no"), F.col("l_extendedprice").alias("value"))
    return rounded(reads.in_force(values, A.rulings(spark, d), F.lit("1999-01-01").cast("date")).select("ruling_id", "line_no", "kind", "value"), "value", digits=2)


@query(f"""WITH {A.MONTHLY}, {A.CATALOG}, r AS (SELECT DISTINCT series_id, obs_date + 20 AS release_date FROM monthly)
SELECT series_id, release_date, name, module FROM r LEFT JOIN catalog USING (series_id) WHERE release_date BETWEEN DATE '1998-01-01' AND DATE '1998-06-30' AND module = 'module_2' ORDER BY release_date, series_id LIMIT 50""")
def calendar_window(spark, d):
    calendar = A.monthly(spark, d).select("series_id", F.date_add("obs_date", 20).alias("release_date")).distinct()
    return reads.calendar_window(calendar, A.catalog(spark, d), F.lit("1998-01-01").cast("date"), F.lit("1998-06-30").cast("date"), "module_2", 50).select("series_id", "release_date", "name", "module")


@query("""WITH e AS (SELECT s_suppkey AS entity_id, 'supplier-' || CAST(s_suppkey AS VARCHAR) AS slug, s_name AS name, 'S ' || CAST(s_suppkey % 10 AS VARCHAR) AS display_name, s_nationkey = 3 AS is_home FROM supplier),
a AS (SELECT 'OLD-' || CAST(s_suppkey AS VARCHAR) AS asked, 'supplier-' || CAST(s_suppkey AS VARCHAR) AS low FROM supplier UNION ALL SELECT CAST(s_suppkey AS VARCHAR), CAST(s_suppkey AS VARCHAR) FROM supplier
UNION ALL SELECT upper(s_name), lower(s_name) FROM supplier UNION ALL SELECT DISTINCT 's ' || CAST(s_suppkey % 12 AS VARCHAR), 's ' || CAST(s_suppkey % 12 AS VARCHAR) FROM supplier),
h AS (SELECT asked, entity_id, slug, is_home, CASE WHEN low = slug THEN 0 WHEN low = CAST(entity_id AS VARCHAR) THEN 1 WHEN low = lower(name) THEN 2 ELSE 3 END AS place
FROM a JOIN e ON low = slug OR low = CAST(entity_id AS VARCHAR) OR low = lower(name) OR low = lower(display_name)),
r AS (SELECT *, row_number() OVER (PARTITION BY asked ORDER BY place, is_home DESC, entity_id) AS rn FROM h) SELECT asked, entity_id, slug, CAST(place AS INTEGER) AS place FROM r WHERE rn = 1""")
def resolve_entity(spark, d):
    s = read_table(spark, d, "supplier")
    key = F.col("s_suppkey").cast("string")
    slug = F.concat(F.lit("supplier-"), key)
    e = s.select(F.col("s_suppkey").alias("entity_id"), slug.alias("slug"), F.col("s_name").alias("name"), F.concat(F.lit("S "), (F.col("s_suppkey") % 10).cast("string")).alias("display_name"), (F.col("s_nationkey") == 3).alias("is_home"))
    renamed = s.select(F.concat(F.lit("old-"), key).alias("old_slug"), slug.alias("slug"))
    asked = s.select(F.concat(F.lit("OLD-"), key).alias("asked")).unionByName(s.select(key.alias("asked"))).unionByName(s.select(F.upper("s_name").alias("asked")))
    asked = asked.unionByName(s.select(F.concat(F.lit("s "), (F.col("s_suppkey") % 12).cast("string")).alias("asked")).distinct())
    return reads.resolve_entity(e, asked, renamed)


@query(f"""WITH {A.DAILY}, b AS (SELECT a.series_id, a.dims_key, a.obs_date, p.value AS base, row_number() OVER (PARTITION BY a.series_id, a.dims_key, a.obs_date ORDER BY p.obs_date DESC) AS rn
FROM daily a JOIN daily p ON p.series_id = a.series_id AND p.dims_key = a.dims_key AND p.obs_date <= a.obs_date - INTERVAL 12 MONTH AND p.obs_date >= a.obs_date - INTERVAL 12 MONTH - INTERVAL 7 DAY)
SELECT a.series_id, a.dims_key, a.obs_date, round(a.value, 6) AS value, round(CASE WHEN base <> 0 THEN 100 * a.value / base - 100 END, 6) AS result
FROM daily a LEFT JOIN b ON b.series_id = a.series_id AND b.dims_key = a.dims_key AND b.obs_date = a.obs_date AND rn = 1 WHERE a.obs_date >= DATE '2024-01-05'""")
def transform_yoy_daily(spark, d):
    return rounded(reads.transform(A.daily(spark, d), "yoy", "daily", "2024-01-05"), "value", "result")


@query(f"""WITH {A.MONTHLY} SELECT a.series_id, a.dims_key, a.obs_date, round(a.value, 6) AS value, round(CASE WHEN b.value <> 0 THEN 100 * a.value / b.value - 100 END, 6) AS result, 'percent' AS unit
FROM monthly a LEFT JOIN monthly b ON a.series_id = b.series_id AND a.dims_key = b.dims_key AND b.obs_date = last_day(a.obs_date - INTERVAL 12 MONTH) WHERE a.obs_date >= DATE '1999-01-01'""")
def transform(spark, d):
    return rounded(reads.transform(A.monthly(spark, d), "yoy", "monthly", "1999-01-01"), "value", "result").withColumn("unit", reads.transformed_unit("yoy", F.lit("pkr")))


@query(f"""WITH {A.CATALOG} SELECT series_id, name, CASE WHEN series_id ILIKE 'brand#2' THEN 0 WHEN series_id ILIKE 'brand#2%' THEN 1 WHEN name ILIKE 'brand#2%' THEN 2 WHEN name ILIKE '%brand#2%' THEN 3 ELSE 4 END AS tier
FROM catalog WHERE is_active AND (series_id ILIKE '%brand#2%' OR name ILIKE '%brand#2%' OR description ILIKE '%brand#2%') ORDER BY tier, length(series_id), name, series_id LIMIT 20""")
def ranked_search(spark, d):
    return reads.ranked_search(A.catalog(spark, d), "Brand#2").select("series_id", "name", "tier")


_ENTITIES = """e AS (SELECT 'product' AS kind, CAST(p_partkey AS VARCHAR) AS key, p_name AS title, p_type AS subtitle, '/products/' || CAST(p_partkey AS VARCHAR) AS url, log10(1 + p_retailprice) AS boost,
lower(p_name || ' ' || p_type || ' ' || p_brand) AS haystack FROM part UNION ALL SELECT 'partner', CAST(n_nationkey AS VARCHAR), n_name, r_name, '/partners/' || CAST(n_nationkey AS VARCHAR), 0.0, lower(n_name || ' ' || r_name || ' nation')
FROM nation JOIN region ON n_regionkey = r_regionkey)"""


def _entities(spark, d):
    part, nation, region = (read_table(spark, d, t) for t in ("part", "nation", "region"))
    products = part.select(F.col("p_partkey").alias("key"), F.col("p_name").alias("title"), F.col("p_type").alias("subtitle"), F.concat(F.lit("/products/"), F.col("p_partkey").cast("string")).alias("url"), F.col("p_retailprice").alias("worth"), F.col("p_brand").alias("words"))
    partners = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_nationkey").alias("key"), F.col("n_name").alias("title"), F.col("r_name").alias("subtitle"), F.concat(F.lit("/partners/"), F.col("n_nationkey").cast("string")).alias("url"), F.lit(None).cast("double").alias("worth"), F.lit("nation").alias("words"))
    return reads.build_entities({"product": products, "partner": partners})


@query(f"WITH {_ENTITIES} SELECT kind, key, title, subtitle, url, round(boost, 6) AS boost, haystack FROM e")
def build_entities(spark, d):
    return rounded(_entities(spark, d), "boost")


_GRAMS = "SELECT {0}, substring('  ' || w || ' ', i, 3) AS t FROM (SELECT {0}, unnest(list_filter(regexp_split_to_array(lower({1}), '[^a-z0-9]+'), lambda x: x <> '')) AS w FROM {2}), LATERAL (SELECT unnest(range(1, CAST(length(w) AS INTEGER) + 2)) AS i)"


@query(f"""WITH q AS (SELECT DISTINCT left(p_name, length(p_name) - 1) || 'x' AS asked FROM part), {_ENTITIES},
g AS (SELECT DISTINCT * FROM ({_GRAMS.format('asked', 'asked', 'q')})), n AS (SELECT asked, count(*) AS n FROM g GROUP BY 1), h AS (SELECT DISTINCT * FROM ({_GRAMS.format('kind, key, title', 'title', 'e')})),
m AS (SELECT asked, kind, key, title, count(*) AS shared FROM g JOIN h USING (t) GROUP BY ALL) SELECT asked, kind, key, title, round(shared / n, 6) AS score FROM m JOIN n USING (asked) WHERE shared / n >= 0.5""")
def fuzzy_search(spark, d):
    p = read_table(spark, d, "part").select(F.expr("concat(left(p_name, length(p_name) - 1), 'x')").alias("asked")).distinct()
    return rounded(reads.fuzzy_search(_entities(spark, d), p), "score")


@query(f"WITH {A.MONTHLY} SELECT series_id, count(*) AS n FROM monthly WHERE json_extract_string(dims_key, '$.flag') IS NOT NULL AND json_extract_string(dims_key, '$.city') IS NULL GROUP BY 1")
def region_filter(spark, d):
    return reads.having_dims(A.monthly(spark, d), present=["flag"], absent=["city"]).groupBy("series_id").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {A.TRADE}, s AS (SELECT country, sum(value) AS value FROM trade GROUP BY 1) SELECT country, round(value, 2) AS value FROM s ORDER BY value DESC, country LIMIT 7")
def top_n(spark, d):
    return rounded(reads.top_n(A.trade(spark, d).groupBy("country").agg(F.sum("value").alias("value")), "value", 7, "country"), "value", digits=2)
