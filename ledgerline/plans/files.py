"""Queries of ingest jobs over files that Spark writes from the given tables, each with the SQL it must agree with."""

from __future__ import annotations

import csv
import datetime as dt

from pyspark.sql import functions as F

from ledgerline.plans.registry import query, rounded
from ledgerline.session import scratch_dir
from ledgerline.sources import jobs
from ledgerline.sources.tables import read_table

FIELDS = "series string, obs_date date, cust string, value double"


def _comma(text):
    lines = csv.reader(text.splitlines())
    next(lines)
    for day, series, cust, value in lines:
        yield series, dt.date.fromisoformat(day), cust, float(value)


def _semicolon(text):
    for line in text.splitlines()[2:]:
        series, day, cust, value = line.split(";")
        yield series, dt.datetime.strptime(day, "%d.%m.%Y").date(), cust, float(value.replace(",", ""))


LAYOUTS = [jobs.Layout("comma", lambda t: t.startswith("DATE,"), _comma), jobs.Layout("semicolon", lambda t: "series;day" in t[:200], _semicolon), jobs.Layout("curve", lambda t: t.startswith("Tenor"), None)]


def _folder(spark, d: str) -> str:
    """Files of a hundred customers and one status each, in two layouts; some hold a broken number, some are no such file, and
    some are another job's."""
    day, group = F.to_date("o_orderdate"), (F.col("o_custkey") / 100).cast("int")
    o = read_table(spark, d, "orders").withColumn("grp", group).withColumn("file", F.concat(F.lit("c"), F.lpad(group.cast("string"), 7, "0"), F.lit("-"), "o_orderstatus"))
    bad = (F.col("o_orderstatus") == "P") & (F.col("grp") % 7 == 3)
    comma = F.concat_ws(",", day.cast("string"), "o_orderpriority", F.col("o_custkey").cast("string"), F.when(bad, F.lit("12x")).otherwise(F.format_string("%.2f", "o_totalprice")))
    semicolon = F.concat_ws(";", "o_orderpriority", F.date_format(day, "dd.MM.yyyy"), F.col("o_custkey").cast("string"), F.format_number("o_totalprice", 2))
    lines = F.array_sort(F.collect_list(F.struct("o_orderkey", F.when(F.col("o_orderstatus") == "O", semicolon).otherwise(comma).alias("line"))))
    g = o.groupBy("file", "grp", "o_orderstatus").agg(F.array_join(F.transform(lines, lambda x: x["line"]), "\n").alias("body"))
    mod = F.when(F.col("o_orderstatus") == "P", F.col("grp") % 7)
    head = F.when(F.col("o_orderstatus") == "O", "Bulletin\nseries;day;cust;amount\n").when(mod == 5, "Notice\n").when(mod == 6, "Tenor,Mid Rate\n").otherwise("DATE,SERIES,CUST,VALUE\n")
    folder = scratch_dir(spark)
    g.select(F.concat(head, "body").alias("value"), "file").repartition("file").write.partitionBy("file").text(folder)
    return folder


_NAME = "'c' || lpad(CAST(o_custkey // 100 AS VARCHAR), 7, '0') || '-' || o_orderstatus"
_FILES = f"""lines AS (SELECT {_NAME} AS file, CASE o_orderstatus WHEN 'O' THEN 'semicolon' ELSE 'comma' END AS layout, CASE WHEN o_orderstatus = 'P' THEN o_custkey // 100 % 7 ELSE 0 END AS m, o_orderkey, o_orderpriority AS series,
CAST(o_orderdate AS DATE) AS obs_date, CAST(o_custkey AS VARCHAR) AS cust, round(o_totalprice, 2) AS value, row_number() OVER (PARTITION BY {_NAME} ORDER BY o_orderkey) - 1 AS row_no FROM orders),
good AS (SELECT * FROM lines WHERE m NOT IN (3, 5, 6)), broken AS (SELECT DISTINCT file, CASE m WHEN 3 THEN 'comma' END AS layout, CASE m WHEN 3 THEN 'ValueError: could not convert string to float: ''12x''' ELSE 'no layout fits' END AS error FROM lines WHERE m IN (3, 5))"""


def _named(df):
    return df.withColumn("file", F.regexp_extract("file", r"file=([^/]+)/", 1))


@query(f"""WITH {_FILES} SELECT file, layout, CAST(row_no AS INTEGER) AS row_no, CAST(NULL AS VARCHAR) AS error, series, obs_date, cust, value FROM good
UNION ALL SELECT file, layout, NULL, error, NULL, NULL, NULL, NULL FROM broken""")
def parse_layouts(spark, d):
    rows = jobs.parse_files(jobs.published(spark, _folder(spark, d)), LAYOUTS, FIELDS)
    return rounded(_named(rows.drop("length", "modified")), "value", digits=2)


def _records(rows):
    return rows.select(F.col("series").alias("series_id"), "obs_date", F.to_json(F.struct("cust")).alias("dims_key"), "value", F.struct("file", "row_no").alias("seq"), "file", "row_no")


@query(f"""WITH {_FILES}, k AS (SELECT *, row_number() OVER (PARTITION BY series, obs_date, cust ORDER BY file DESC, row_no DESC) AS rn FROM good),
v AS (SELECT *, CASE WHEN obs_date > DATE '2001-01-01' THEN 'future date' WHEN series = '3-MEDIUM' THEN 'not in catalog' WHEN value < 5000 THEN 'below minimum' WHEN value > 450000 THEN 'above maximum' END AS reason FROM k WHERE rn = 1)
SELECT 'point' AS kind, series AS name, count(*) AS n, round(sum(value), 2) AS total FROM v WHERE reason IS NULL GROUP BY 2 UNION ALL SELECT 'rejected', reason, count(*), NULL FROM v WHERE reason IS NOT NULL GROUP BY 2
UNION ALL SELECT 'bad file', error, count(*), NULL FROM broken GROUP BY 2 UNION ALL SELECT 'run', CASE WHEN EXISTS (SELECT 1 FROM broken) THEN 'partial' ELSE 'success' END, (SELECT count(DISTINCT file) FROM lines), NULL UNION ALL SELECT 'run', 'no_new_data', 0, NULL""")
def ingest_files(spark, d):
    """A job over the folder, run twice: what it stored, rejected and could not read, and what both runs said."""
    names = ["1-URGENT", "2-HIGH", "4-NOT SPECIFIED", "5-LOW"]
    catalog = spark.createDataFrame([(n, 5000.0, 450000.0, None) for n in names], "series_id string, min_value double, max_value double, max_step double")
    job = jobs.Job("orders", LAYOUTS, FIELDS, _records, jobs.observation_store(spark, scratch_dir(spark)))
    folder = _folder(spark, d)
    runs = [job.run(folder, catalog, F.lit("2001-01-01").cast("date")) for _ in range(2)]
    points = job.store.read().groupBy(F.lit("point").alias("kind"), F.col("series_id").alias("name")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total"))
    kind = F.when(F.col("row_no").isNull(), "bad file").otherwise("rejected")
    bad = job.bad_records().groupBy(kind.alias("kind"), F.col("error").alias("name")).agg(F.count(F.lit(1)).alias("n")).withColumn("total", F.lit(None).cast("double"))
    said = spark.createDataFrame([("run", r["status"], r["files"], None) for r in runs], "kind string, name string, n long, total double")
    return points.unionByName(bad).unionByName(said)
