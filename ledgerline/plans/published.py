"""Queries of published files' readers and writers, over files that Spark writes from the given tables, and of what guards a
load, each with the SQL it must agree with."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.operators import editions, loads, merge, names
from ledgerline.plans import adapters as A
from ledgerline.plans.registry import _points, _POINT, _last, query, rounded
from ledgerline.session import scratch_dir
from ledgerline.sources import tables
from ledgerline.sources.tables import read_table


def _written(rows, group, line, head: str, tail: str, between: str) -> str:
    """A folder with one text of each group: lines in the order of their keys between a head and a tail."""
    folder = scratch_dir(rows.sparkSession)
    lines = F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", line.alias("line")))), lambda x: x["line"])
    texts = rows.groupBy(group.alias("file")).agg(F.concat(F.lit(head), F.array_join(lines, between), F.lit(tail)).alias("value"))
    texts.select("value", "file").repartition("file").write.partitionBy("file").text(folder)
    return folder


_HEAD = '{"columns": ["Dataset Name", "Series Key", " series name", "Observation Date", "Observation Value", "Comments"], "rows": ['
_BY = "o_custkey // 100"
_VALUE = "CASE o_orderkey % 5 WHEN 0 THEN NULL ELSE round(o_totalprice, 2) END"


def _by():
    return (F.col("o_custkey") / 100).cast("int")


@query(f"SELECT {_BY} AS file, o_orderpriority AS key, CAST(o_orderdate AS DATE) AS obs_date, {_VALUE} AS value FROM orders WHERE o_orderkey % 7 <> 0")
def read_series_json(spark, d):
    o, k = read_table(spark, d, "orders"), F.col("o_orderkey")
    value = F.when(k % 5 == 0, F.when(k % 2 == 0, "-").otherwise("NA")).when(k % 3 == 0, F.format_number("o_totalprice", 2)).otherwise(F.format_string("%.2f", "o_totalprice"))
    cells = F.array(F.lit("set"), F.col("o_orderpriority"), F.lit("a \"name\""), F.to_date("o_orderdate").cast("string"), value, F.lit("c"))
    row = F.to_json(F.when(k % 7 == 0, F.slice(cells, 1, 3)).otherwise(cells))
    out = tables.read_series_json(spark, _written(o, _by(), row, _HEAD, "]}", ", "))
    return rounded(out.withColumn("file", F.regexp_extract("file", r"file=(\d+)", 1).cast("long")), "value", digits=2)


@query(f"SELECT {_BY} AS file, o_orderpriority AS key, CAST(o_orderdate AS DATE) AS obs_date, {_VALUE} AS value FROM orders")
def read_series_json_lenient(spark, d):
    o, k = read_table(spark, d, "orders"), F.col("o_orderkey")
    number = F.format_string("%.2f", "o_totalprice")
    value = F.when(k % 5 == 0, F.when(k % 2 == 0, "null").otherwise('"-"')).when(k % 3 == 0, F.concat(F.lit('"'), number, F.lit('"'))).otherwise(number)
    row = F.concat(F.lit('["set", "'), "o_orderpriority", F.lit('", "n", "'), F.to_date("o_orderdate").cast("string"), F.lit('T00:00:00", '), value, F.lit(', "said "so" on ["x"] 12"]'))
    head = _HEAD.replace(" series name", "Series Name")
    out = tables.read_series_json_lenient(spark, _written(o, _by(), row, head, "]}", " ,\n"))
    return rounded(out.withColumn("file", F.regexp_extract("file", r"file=(\d+)", 1).cast("long")), "value", digits=2)


@query(f"""WITH {A.CATALOG} SELECT series_id AS source_key, name, description, CASE unit WHEN 'pkr_per_kg' THEN 'pkr_mn' WHEN 'percent' THEN 'percent' WHEN 'index' THEN 'index' ELSE 'count' END AS unit,
CASE frequency WHEN 'annual' THEN 'annual' ELSE frequency END AS frequency, DATE '2001-01-31' AS since, CAST(NULL AS DATE) AS refreshed FROM catalog""")
def read_dataset_meta(spark, d):
    c = A.catalog(spark, d)
    unit = F.when(F.col("unit") == "pkr_per_kg", "Million Rupees").when(F.col("unit") == "percent", "%").when(F.col("unit") == "index", "Index (2010=100)").otherwise("Nos")
    frequency = F.when(F.col("frequency") == "annual", "Yearly").otherwise(F.initcap("frequency"))
    row = F.to_json(F.array("series_id", F.concat(F.lit(" "), "name"), "description", unit, frequency, F.lit("31-Jan-2001")))
    rows = c.withColumn("o_orderkey", F.col("series_id"))
    head = '{"columns": ["Series Key", "Series Name", "Description", "Unit", "Frequency", "Available From"], "rows": ['
    return tables.read_dataset_meta(spark, _written(rows, F.col("module"), row, head, "]}", ", ")).drop("file").withColumn("unit", F.when(F.col("unit").startswith("index"), "index").otherwise(F.col("unit")))


_TENORS = ["1-Month", "3M", "61-90 days", "10 Year", "note"]


@query("""WITH r AS (SELECT CAST(o_orderdate AS DATE) AS obs_date, o_orderkey % 5 AS k, max(o_orderkey % 2000 - 200) / 100 AS rate FROM orders GROUP BY 1, 2)
SELECT obs_date, list_value('1m', '3m', '3m', '10y')[k + 1] AS tenor, CAST(rate AS DOUBLE) AS rate FROM r WHERE k < 4 AND rate > 0""")
def read_curve_csv(spark, d):
    k = F.col("o_orderkey")
    r = read_table(spark, d, "orders").groupBy(F.to_date("o_orderdate").alias("day"), (k % 5).alias("k")).agg((F.max(k % 2000 - 200) / 100).alias("rate"))
    line = F.concat_ws(",", F.get(F.array(*map(F.lit, _TENORS)), F.col("k").cast("int")), F.lit("1"), F.format_string("%.2f", "rate"))
    texts = r.groupBy("day").agg(F.array_join(F.sort_array(F.collect_list(line)), "\n").alias("body"))
    name = F.when(F.dayofmonth("day") % 2 == 0, F.concat(F.lit("/x/curve_"), F.col("day").cast("string"), F.lit(".csv"))).otherwise(F.concat(F.lit("/x/C"), F.date_format("day", "ddMMyyyy"), F.lit(".csv")))
    files = texts.select(name.alias("file"), F.concat(F.lit("Rates of the day\n\nTENOR,Change,\"Mid Rate\"\n"), "body").alias("value"))
    return tables.curve_rates(files).drop("file")


@query(f"""WITH {A.MONTHLY}, {A.CATALOG}, o AS (SELECT substring(series_id, 7, 1) || '.' || series_id AS series_id, obs_date, dims_key, value, series_id AS plain FROM monthly)
SELECT o.series_id, obs_date, dims_key, floor(value) AS value, name, unit, source, left(o.series_id, 1) AS dataset FROM o JOIN catalog ON catalog.series_id = plain WHERE is_active AND left(o.series_id, 1) <> '2'""")
def export_datasets(spark, d):
    """The changed data sets as packed CSV, read back."""
    new_id = F.concat(F.substring("series_id", 7, 1), F.lit("."), "series_id")
    obs = A.monthly(spark, d).withColumn("value", F.floor("value").cast("double"))
    catalog = A.catalog(spark, d).withColumn("series_id", new_id)
    obs = obs.withColumn("series_id", new_id).withColumn("revised_at", F.col("obs_date").cast("timestamp"))
    fresh = tables.dataset_fingerprints(obs)
    changed = tables.changed_datasets(fresh, fresh.filter("dataset = '2'"))
    folder = scratch_dir(spark)
    tables.write_datasets(obs.drop("revised_at"), catalog, folder, changed)
    schema = "series_id string, dims_key string, obs_date date, value double, name string, unit string, source string, dataset string"
    return tables.read_packed_csv(spark, folder, schema, 8)


@query(f"""WITH {A.MONTHLY}, f AS (SELECT substring(series_id, 7, 1) AS dataset, count(*) AS n_rows, count(DISTINCT series_id) AS n_series, max(obs_date) AS newest FROM monthly GROUP BY 1), l AS (SELECT dataset, n_rows + CASE dataset WHEN '3' THEN 1 ELSE 0 END AS n_rows FROM f WHERE dataset <> '4')
SELECT f.dataset, f.n_rows, n_series, newest, CASE WHEN l.dataset IS NULL OR l.n_rows <> f.n_rows THEN 'write' END AS action FROM f LEFT JOIN l USING (dataset) UNION ALL SELECT 'gone', NULL, NULL, NULL, 'drop'""")
def dataset_fingerprints(spark, d):
    obs = A.monthly(spark, d).withColumn("series_id", F.concat(F.substring("series_id", 7, 1), F.lit("."), "series_id")).withColumn("revised_at", F.col("obs_date"))
    fresh = tables.dataset_fingerprints(obs)
    last = fresh.filter("dataset <> '4'").withColumn("n_rows", F.col("n_rows") + F.when(F.col("dataset") == "3", 1).otherwise(0))
    last = last.unionByName(fresh.limit(1).withColumn("dataset", F.lit("gone")))
    return fresh.join(tables.changed_datasets(fresh, last), "dataset", "full_outer").select("dataset", "n_rows", "n_series", "newest", "action")


@query("""SELECT o_custkey AS page, CASE o_orderkey % 3 WHEN 0 THEN 'Mobile' WHEN 1 THEN 'Fixed' ELSE 'Other' END AS name, last_day(CAST(o_orderdate AS DATE)) AS obs_date, round(max(o_totalprice), 2) AS value FROM orders WHERE o_orderkey % 4 <> 0 GROUP BY ALL""")
def read_chart_json(spark, d):
    k, day = F.col("o_orderkey"), F.last_day(F.to_date("o_orderdate"))
    name = F.when(k % 3 == 0, "Mobile").when(k % 3 == 1, "Fixed").otherwise("Other")
    points = read_table(spark, d, "orders").groupBy(F.col("o_custkey").alias("page"), name.alias("name"), day.alias("day")).agg(F.max(F.when(k % 4 != 0, F.col("o_totalprice"))).alias("value"))
    days = points.groupBy("page").agg(F.sort_array(F.collect_set("day")).alias("days"))
    own = points.groupBy("page", "name").agg(F.map_from_entries(F.collect_list(F.struct("day", "value"))).alias("of")).join(days, "page")
    cell = lambda x: F.coalesce(F.format_string("%.2f", F.try_element_at("of", x)), F.lit("null"))
    data = F.concat(F.lit('{"name":"'), "name", F.lit('","data":['), F.array_join(F.transform("days", lambda x: F.when(F.try_element_at("of", x).isNull(), "null").otherwise(cell(x))), ","), F.lit("]}"))
    labels = F.concat(F.lit('["'), F.array_join(F.transform("days", lambda x: F.date_format(x, "MMM-yy")), '","'), F.lit('"]'))
    series = own.withColumn("data", data).withColumn("labels", labels).groupBy("page", "labels").agg(F.array_join(F.sort_array(F.collect_list("data")), ",").alias("all"))
    html = F.concat(F.lit("<script>xAxis: {categories: "), "labels", F.lit("}, series: ["), "all", F.lit(', {"name":"Mobile","data":[]}]</script>'))
    nineties = tables.read_chart_json(series.select("page", html.alias("html")), "monthly")
    # charts print two digits of a year, which are read as of this century
    return rounded(nineties.withColumn("obs_date", F.when(F.year("obs_date") > 2050, F.last_day(F.add_months("obs_date", -1200))).otherwise(F.col("obs_date"))), "value", digits=2)


@query(f"""WITH r AS {_last()} SELECT series_id, obs_date, dims_key, value, CASE WHEN obs_date > DATE '1999-01-01' THEN 'future date' WHEN value > 300000 THEN 'above maximum' END AS reason FROM r""")
def all_rejected_guard(spark, d):
    r = merge.dedupe_last(_points(spark, d), merge.POINT, "seq").drop("seq")
    catalog = r.select("series_id").distinct().select("series_id", F.lit(0.0).alias("min_value"), F.lit(300000.0).alias("max_value"), F.lit(None).cast("double").alias("max_step"))
    judged = merge.validate(r, catalog, merge.latest_value(r, r.limit(0)), F.lit("1999-01-01").cast("date"))
    return loads.all_rejected_guard(judged).drop("flagged")


@query(f"""WITH a AS {_last('WHERE o_orderkey % 4 <> 0')}, b AS {_last('WHERE o_orderkey % 4 <> 1')} SELECT a.series_id, a.obs_date, a.dims_key, a.value FROM a LEFT JOIN b ON a.series_id = b.series_id AND a.obs_date = b.obs_date AND a.dims_key = b.dims_key WHERE b.value IS NULL OR abs(a.value - b.value) > 1e-9""")
def change_detect(spark, d):
    last = lambda test: merge.dedupe_last(_points(spark, d).filter(test), merge.POINT, "seq").drop("seq")
    return merge.change_detect(last("seq % 4 <> 0"), last("seq % 4 <> 1"), merge.POINT)


@query(f"SELECT {_POINT}, CASE WHEN o_orderpriority = '5-LOW' THEN 'entity' ELSE 'observation' END AS kind, count(*) AS n FROM orders GROUP BY ALL")
def split_rows(spark, d):
    own, rest = editions.split_rows(_points(spark, d), F.col("series_id") == "5-LOW")
    return own.withColumn("kind", F.lit("entity")).unionByName(rest.withColumn("kind", F.lit("observation"))).groupBy(*merge.POINT, "kind").agg(F.count(F.lit(1)).alias("n"))


_SALT = b"a salt of this query"
_PADDED = _SALT.ljust(64, b"\0")
_BLOB = {n: "'" + "".join(f"\\x{b ^ n:02X}" for b in _PADDED) + "'::BLOB" for n in (0x36, 0x5C)}


@query(f"""WITH a AS (SELECT DISTINCT o_custkey, CASE WHEN o_custkey % 9 = 0 THEN '' ELSE '10.0.' || CAST(o_custkey // 256 AS VARCHAR) || '.' || CAST(o_custkey % 256 AS VARCHAR) END AS ip FROM orders)
SELECT o_custkey, ip, CASE WHEN ip = '' THEN '' ELSE left(sha256({_BLOB[0x5C]} || unhex(sha256({_BLOB[0x36]} || encode(ip)))), 16) END AS hashed FROM a""")
def hash_ip(spark, d):
    k = F.col("o_custkey")
    ip = F.when(k % 9 == 0, "").otherwise(F.concat(F.lit("10.0."), F.floor(k / 256).cast("string"), F.lit("."), (k % 256).cast("string")))
    return read_table(spark, d, "orders").select("o_custkey").distinct().select("o_custkey", ip.alias("ip")).withColumn("hashed", names.hash_address(F.col("ip"), _SALT))
