"""Queries of names, labels and publishers' words, each with the SQL it must agree with."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.functions import calendar, text
from ledgerline.operators import names
from ledgerline.plans import adapters as A
from ledgerline.plans.registry import query
from ledgerline.sources.tables import read_table


@query("""SELECT p_partkey, replace(p_name, ' ', '-') || '-and-' || lower(p_type) AS slug FROM part""")
def slugify(spark, d):
    return read_table(spark, d, "part").select("p_partkey", text.slugify(F.concat(F.lit(" "), F.initcap("p_name"), F.lit(" & "), F.lower("p_type"), F.lit("'!"))).alias("slug"))


@query("""SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN CAST(p_size AS VARCHAR) || 'm' WHEN 1 THEN CAST(p_size AS VARCHAR) || 'y' WHEN 2 THEN '3m' END AS tenor FROM part""")
def norm_tenor(spark, d):
    n, k = F.col("p_size").cast("string"), F.col("p_partkey") % 4
    label = F.when(k == 0, F.concat(n, F.lit(" - Months"))).when(k == 1, F.concat(n, F.lit(" Year"))).when(k == 2, " 61 - 90 days").otherwise("Spot")
    return read_table(spark, d, "part").select("p_partkey", text.norm_tenor(label).alias("tenor"))


@query("""SELECT o_orderkey, last_day(CAST(o_orderdate AS DATE)) AS monthly, last_day(make_date(CAST(year(o_orderdate) AS INTEGER), CAST(quarter(o_orderdate) * 3 AS INTEGER), 1)) AS quarterly, make_date(CAST(year(o_orderdate) + 1 AS INTEGER), 6, 30) AS annual FROM orders WHERE year(o_orderdate) >= 2000
UNION ALL SELECT o_orderkey, CAST(NULL AS DATE), CAST(NULL AS DATE), make_date(CAST(year(o_orderdate) + 1 AS INTEGER), 6, 30) FROM orders WHERE year(o_orderdate) < 2000""")
def period_label_to_date(spark, d):
    day, year = F.col("o_orderdate"), F.year("o_orderdate")
    names_ = F.element_at(F.array(*map(F.lit, ("Jan-Mar", "Apr-Jun", "Jul-Sep", "Oct-Dec"))), F.quarter(day))
    ok = year >= 2000
    o = read_table(spark, d, "orders").select("o_orderkey", F.when(ok, F.date_format(day, "MMM-yy")).otherwise("n/a").alias("m"), F.when(ok, F.concat(names_, F.date_format(day, " yy"))).otherwise("n/a").alias("q"), F.concat(year.cast("string"), F.lit("-99 (P)")).alias("a"))
    return o.select("o_orderkey", text.period_end(F.col("m"), "monthly").alias("monthly"), text.period_end(F.col("q"), "quarterly").alias("quarterly"), text.period_end(F.col("a"), "annual").alias("annual"))


@query("""SELECT p_partkey, CASE p_partkey % 3 WHEN 1 THEN p_name || ' ACID' WHEN 2 THEN left(p_name || '                              ', 30) ELSE p_name END AS description, CASE p_partkey % 3 WHEN 0 THEN 'NO' ELSE 'KG' END AS unit FROM part""".replace("left(p_name || '                              ', 30)", "rtrim(left(p_name || '                              ', 30))"))
def split_unit(spark, d):
    k = F.col("p_partkey") % 3
    desc = F.when(k == 2, F.concat(F.rpad("p_name", 30, " "), F.lit("kg"))).otherwise(F.col("p_name"))
    unit = F.when(k == 0, " no. ").when(k == 1, "ACIDKG")
    return read_table(spark, d, "part").select("p_partkey", text.split_unit(desc, unit, ["KG", "NO", "THNO"]).alias("s")).select("p_partkey", "s.description", "s.unit")


@query("""SELECT o_orderkey, CASE o_orderkey % 8 WHEN 0 THEN 'site' WHEN 1 THEN 'none' WHEN 2 THEN 'sheets' WHEN 3 THEN 'excel' WHEN 4 THEN 'bot' WHEN 5 THEN 'curl' WHEN 6 THEN 'script' ELSE CASE WHEN o_custkey % 2 = 0 THEN 'browser' ELSE 'other' END END AS kind FROM orders""")
def ua_class(spark, d):
    k = F.col("o_orderkey") % 8
    said = [None, "", "Mozilla/5.0 Google-Apps-Script", "Microsoft Office/16", "Mozilla/5.0 (compatible; GPTBot/1.0)", "curl/8.1", "python-requests/2"]
    agent = F.lit(None).cast("string")
    for i, a in enumerate(said):
        agent = F.when(k == i, F.lit(a).cast("string")).otherwise(agent)
    agent = F.when(k == 7, F.when(F.col("o_custkey") % 2 == 0, "Mozilla/5.0 (X11)").otherwise("Lynx")).otherwise(agent)
    return read_table(spark, d, "orders").select("o_orderkey", text.ua_class(agent, k == 0).alias("kind"))


_WORDS = "CASE o_orderkey % 5 WHEN 0 THEN {0} WHEN 1 THEN {1} WHEN 2 THEN {2} WHEN 3 THEN {3} ELSE {4} END"


@query(f"""SELECT o_orderkey, {_WORDS.format("'usd_mn'", "'pkr'", "'count'", "'percent'", "'metric tons'")} AS unit, {_WORDS.format("'monthly'", "'half_yearly'", "'annual'", "'quarterly'", "'now and then'")} AS frequency, CASE WHEN o_orderkey % 5 < 4 THEN CAST(o_orderdate AS DATE) END AS since, {_WORDS.format("'a b'", "'x'", "''", "'1 < 2'", "'t'")} AS plain FROM orders""")
def source_metadata(spark, d):
    k, day = F.col("o_orderkey") % 5, F.col("o_orderdate")
    pick = lambda *v: F.element_at(F.array(*map(F.lit, v)), (k + 1).cast("int"))
    since = F.when(k == 0, F.date_format(day, "yyyy-MM-dd")).when(k == 1, F.date_format(day, "dd-MMM-yyyy")).when(k == 2, F.date_format(day, " d MMM yyyy")).when(k == 3, F.date_format(day, "dd/MM/yyyy")).otherwise("unknown")
    raw = read_table(spark, d, "orders").select("o_orderkey", pick("Million US Dollars", "Rupees", "Nos", "%", "Metric Tons").alias("u"), pick(" Monthly, Quarterly", "Half-Yearly", "annually", "Foo/Quarterly", "Now and then").alias("f"), since.alias("s"), pick("a <b>b</b>", "<p>x</p>", "", "1 < 2", " <br/>t").alias("h"))
    return raw.select("o_orderkey", text.map_unit(F.col("u"), F.lit("Series")).alias("unit"), text.map_frequency(F.col("f")).alias("frequency"), text.iso_date(F.col("s")).alias("since"), text.strip_html(F.col("h")).alias("plain"))


@query("""SELECT c_custkey, CASE WHEN c_nationkey < 12 THEN 'Nation ' || CAST(c_nationkey AS VARCHAR) ELSE 'Republic of the Nation_' || CAST(c_nationkey AS VARCHAR) END AS country FROM customer""")
def clean_country(spark, d):
    n = F.col("c_nationkey")
    raw = read_table(spark, d, "customer").select("c_custkey", F.when(n % 2 == 0, F.concat(F.lit(" REPUBLIC  OF THE NATION_"), n.cast("string"), F.lit("."))).otherwise(F.concat(F.lit("Republic of the Nation_"), n.cast("string"))).alias("raw"))
    aliases = read_table(spark, d, "nation").filter("n_nationkey < 12").select(F.concat(F.lit("republic of the nation "), F.col("n_nationkey").cast("string")).alias("alias"), F.concat(F.lit("Nation "), F.col("n_nationkey").cast("string")).alias("name"))
    return names.canonical(raw, "raw", aliases, "country").drop("raw")


@query("""SELECT s_suppkey, 'Plant ' || CAST(s_nationkey AS VARCHAR) AS name, CASE WHEN s_suppkey % 3 = 0 THEN 'up to 1,200 MWh' END AS tranche, CASE WHEN s_suppkey % 2 = 0 THEN 'CC' END AS config, CASE WHEN s_suppkey % 5 = 0 THEN '2' WHEN s_suppkey % 5 = 1 THEN '7' END AS unit FROM supplier""")
def canon_plant(spark, d):
    k = F.col("s_suppkey")
    label = F.concat(F.lit("PLANT-"), F.col("s_nationkey").cast("string"), F.when(k % 2 == 1, " (Pvt) Ltd").otherwise(""), F.when(k % 5 == 0, " Unit-II").when(k % 5 == 1, ", Block 7").otherwise(""), F.when(k % 2 == 0, " (CC)").otherwise(""), F.when(k % 3 == 0, " ( Up to 1,200 MWh)").otherwise(""))
    raw = read_table(spark, d, "supplier").select("s_suppkey", names.split_details(label).alias("s")).select("s_suppkey", F.col("s.name").alias("label"), "s.tranche", "s.config", "s.unit")
    registry = read_table(spark, d, "nation").select(F.concat(F.lit("Plant "), F.col("n_nationkey").cast("string")).alias("name")).withColumn("alias", F.col("name"))
    return names.canonical(raw, "label", registry, "name").drop("label")


@query("""SELECT n_nationkey, 'District of ' || n_name || 'a' AS canonical FROM nation""")
def canon_district(spark, d):
    n = read_table(spark, d, "nation")
    i = F.col("n_nationkey")
    real = F.concat(F.lit("District of "), "n_name", F.lit("a"))
    asked = n.select("n_nationkey", F.col("n_regionkey").alias("province"), F.when(i % 2 == 0, F.upper(real)).otherwise(F.concat(F.lit("Distrct of "), "n_name", F.lit("a"))).alias("name"))
    found = names.close_names(asked, n.select(F.col("n_regionkey").alias("province"), real.alias("name")))
    return asked.join(found, ["province", "name"]).select("n_nationkey", "canonical")


@query(f"WITH {A.PRICES} SELECT item, city, week, CASE WHEN item < 'M' THEN round(floor(value) / 100, 2) WHEN item < 'S' THEN floor(value) END AS per_kg FROM prices")
def per_kg(spark, d):
    unit = F.when(F.col("item") < "M", "pkr_per_100kg").when(F.col("item") < "S", "pkr_per_kg").otherwise("pkr_per_dozen")
    return A.prices(spark, d).select("item", "city", "week", text.per_kg(F.floor("value").cast("double"), unit).alias("per_kg"))


@query("""WITH r AS (SELECT DISTINCT p_size, CAST(p_size % 7 AS INTEGER) AS wd, p_size AS md FROM part), k AS (SELECT p_size, DATE '2024-01-15' + CAST(i AS INTEGER) AS day, wd, md FROM r, range(121) t(i))
SELECT 'weekly ' || CAST(p_size AS VARCHAR) AS indicator, day AS release_date FROM k WHERE isodow(day) - 1 = wd UNION ALL SELECT 'monthly ' || CAST(p_size AS VARCHAR), day FROM k WHERE day(day) = CASE WHEN md <= day(last_day(day)) THEN md ELSE 28 END""")
def scheduled_releases(spark, d):
    sizes = read_table(spark, d, "part").select("p_size").distinct()
    name = lambda kind: F.concat(F.lit(f"{kind} "), F.col("p_size").cast("string")).alias("indicator")
    rules = sizes.select(name("weekly"), F.lit("weekly").alias("kind"), (F.col("p_size") % 7).alias("param")).unionByName(sizes.select(name("monthly"), F.lit("monthly_day").alias("kind"), F.col("p_size").alias("param")))
    return names.scheduled_releases(rules, F.lit("2024-01-15").cast("date"))


@query("""SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS fy, CAST(year(o_orderdate) - 1 AS VARCHAR) || '-' || right(CAST(year(o_orderdate) AS VARCHAR), 2) AS label FROM orders""")
def fy_label(spark, d):
    return read_table(spark, d, "orders").select(F.year("o_orderdate").alias("fy")).distinct().withColumn("label", calendar.fy_label(F.col("fy")))


@query("""WITH f AS (SELECT l_partkey AS code, 'Trade ' || CAST(l_linenumber AS VARCHAR) || CASE WHEN l_linenumber % 2 = 0 THEN ' 2003-04' ELSE ' Export-0605' END || '.csv' AS name, CASE WHEN l_linenumber % 2 = 0 THEN 2003 ELSE 2005 END AS y, l_quantity AS v FROM lineitem), s AS (SELECT code, name, y, sum(v) AS v FROM f GROUP BY 1, 2, 3)
SELECT code, arg_max(name, (y, name)) AS name, round(arg_max(v, (y, name)), 2) AS v FROM s GROUP BY 1""")
def publication_order(spark, d):
    n = F.col("l_linenumber")
    name = F.concat(F.lit("Trade "), n.cast("string"), F.when(n % 2 == 0, " 2003-04").otherwise(" Export-0605"), F.lit(".csv"))
    s = read_table(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("code"), name.alias("name")).agg(F.sum("l_quantity").alias("v"))
    return s.groupBy("code").agg(F.max_by(F.struct("name", "v"), text.publication_order(F.col("name"))).alias("p")).select("code", "p.name", F.round("p.v", 2).alias("v"))


@query("""SELECT o_orderkey, o_orderpriority AS a, o_orderstatus AS b, o_orderstatus = 'F' AND o_orderpriority = '5-LOW' AS held FROM orders""")
def dims_round_trip(spark, d):
    key = text.dims_key(F.create_map(F.lit("b"), "o_orderstatus", F.lit("a"), "o_orderpriority"))
    m = read_table(spark, d, "orders").select("o_orderkey", text.dims_from_json(key).alias("dims"))
    return m.select("o_orderkey", F.col("dims")["a"].alias("a"), F.col("dims")["b"].alias("b"), text.dims_contains(F.col("dims"), {"a": "5-LOW", "b": "F"}).alias("held"))


@query("""SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN o_totalprice WHEN 1 THEN CAST(o_custkey * 1000 AS DOUBLE) END AS number FROM orders""")
def to_number(spark, d):
    k = F.col("o_orderkey") % 4
    raw = F.when(k == 0, F.concat(F.lit(" "), F.col("o_totalprice").cast("decimal(20,2)").cast("string"))).when(k == 1, F.format_number(F.col("o_custkey") * 1000, 0)).when(k == 2, "-").otherwise("N/A")
    return read_table(spark, d, "orders").select("o_orderkey", text.to_number(raw).alias("number"))


@query("""SELECT o_orderkey, CAST(o_orderdate AS DATE) + CAST((12 - isodow(o_orderdate)) % 7 AS INTEGER) AS friday, last_day(CAST(o_orderdate AS DATE)) AS month_end FROM orders""")
def week_and_month_ends(spark, d):
    day = F.to_date("o_orderdate")
    return read_table(spark, d, "orders").select("o_orderkey", calendar.week_ending_friday(day).alias("friday"), F.last_day(day).alias("month_end"))


@query(None)
def cluster_spellings(spark, d):
    p = read_table(spark, d, "part").select(F.initcap("p_name").alias("name"), "p_partkey")
    misread = F.when(F.col("p_partkey") % 9 == 0, F.translate("name", "le", "1c")).when(F.col("p_partkey") % 7 == 0, F.replace("name", F.lit(" "), F.lit(""))).otherwise(F.col("name"))
    return names.cluster_spellings(p.select(misread.alias("name")))
