"""Published files as the readers must take them."""

import datetime as dt
import gzip
import json

from pyspark.sql import functions as F

from ledgerline.functions import text
from ledgerline.sources import tables

D = dt.date


def put(path, body):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(body)
    return str(path)


COLUMNS = ["Dataset Name", "series key", " Series Name", "Observation Date", "OBSERVATION VALUE"]


def test_series_json(spark, tmp_path):
    rows = [["d", "k1", "n", "2024-01-31", "1,234.5"], ["d", "k1", "n", "2024-02-29", "-"], ["d", "k2", "n", "2024-01-31", "NA"], ["short"], []]
    put(tmp_path / "a.json", json.dumps({"columns": COLUMNS, "rows": rows}))
    got = sorted(((r.key, r.obs_date, r.value) for r in tables.read_series_json(spark, str(tmp_path)).collect()), key=str)
    assert got == [("k1", D(2024, 1, 31), 1234.5), ("k1", D(2024, 2, 29), None), ("k2", D(2024, 1, 31), None)]


def test_broken_series_json_is_read_row_by_row(spark, tmp_path):
    names = ", ".join(f'"{c}"' for c in tables.STANDARD_COLUMNS)
    put(tmp_path / "bad.json", '{"columns": [' + names + '], "rows": [["d", "k", "n", "2024-01-31T00:00", "1.5", "missing "MIS" here"], ["d", "k", "n", "2024-02-29", null], ["d", "k", "n", "2024-03-31", -2e1]]}')
    put(tmp_path / "fine.json", '{"columns": [' + names + '], "rows": [["d", "x", "n", "2024-01-31", "1"]]}')
    put(tmp_path / "other.json", '{"columns": ["a"], "rows": [["b" "c"]]}')
    got = sorted((r.key, r.obs_date, r.value) for r in tables.read_series_json_lenient(spark, str(tmp_path)).collect())
    assert got == [("k", D(2024, 1, 31), 1.5), ("k", D(2024, 2, 29), None), ("k", D(2024, 3, 31), -20.0)]


def test_dataset_meta_under_other_names(spark, tmp_path):
    put(tmp_path / "m.json", json.dumps({"columns": ["Series Key", "Series Name", "Description", "Frequency", "Unit", "Available From"], "rows": [[" K1 ", "Loans", "d", "Half-Yearly", "Million Rupees", "31-Jan-2001"], ["", "x", "", "", "", ""]]}))
    r = tables.read_dataset_meta(spark, str(tmp_path)).collect()
    assert [(x.source_key, x.unit, x.frequency, x.since, x.refreshed) for x in r] == [("K1", "pkr_mn", "half_yearly", D(2001, 1, 31), None)]


def test_curve_files(spark, tmp_path):
    put(tmp_path / "curve_2024-05-02.csv", "Some title\n\nTenor,Mid Rate,Change\n1-Month,20.5,0\n0-7 days,21,0\n10Y,-1,0\nnote,1,1\n")
    put(tmp_path / "PKRV03052024.csv", 'Userid,B1,B2,B3,"Avg"\n3M,1,2,3,19.25\n')
    put(tmp_path / "unknown_2024-05-04.csv", "Tenor,A,B,C\n1M,1,2,3\n")
    put(tmp_path / "none.csv", "nothing\n1,2\n")
    got = sorted((str(r.obs_date), r.tenor, r.rate) for r in tables.read_curve_csv(spark, str(tmp_path)).collect())
    assert got == [("2024-05-02", "1m", 20.5), ("2024-05-02", "1w", 21.0), ("2024-05-03", "3m", 19.25)]


def test_primary_chart_of_a_page(spark):
    html = """<script>xAxis: {"categories": ["Jul-25","Aug-25"]}, series: [{"name":"Mobile","data":[1,null]},{"name":"Fixed","data":[3,4]},{"name":"Odd","data":[3]}]
    other: [{"name":"Mobile","data":[8,9]}]</script>"""
    pages = spark.createDataFrame([("p", html), ("q", "no chart"), ("r", None)], "page string, html string")
    got = sorted((r.page, r.name, str(r.obs_date), r.value) for r in tables.read_chart_json(pages, "monthly").collect())
    assert got == [("p", "Fixed", "2025-07-31", 3.0), ("p", "Fixed", "2025-08-31", 4.0), ("p", "Mobile", "2025-07-31", 1.0)]


def test_packed_files_and_exports(spark, tmp_path):
    with gzip.open(tmp_path / "a.csv.gz", "wt") as f:
        f.write("code,value\n01,5\n02,\n")
    with gzip.open(tmp_path / "b.json.gz", "wt") as f:
        f.write('{"code": "01", "value": 5}\n{"code": "02"}\n')
    for df in (tables.read_packed_csv(spark, str(tmp_path / "a.csv.gz"), "code string, value double", 3), tables.read_packed_json(spark, str(tmp_path / "b.json.gz"), "code string, value double", 3)):
        assert sorted((r.code, r.value) for r in df.collect()) == [("01", 5.0), ("02", None)] and df.rdd.getNumPartitions() == 3
    obs = spark.createDataFrame([("fx.usd", "{}", D(2024, 1, 1), 1.0), ("fx.eur", "{}", D(2024, 1, 1), 2.0), ("cpi.all", "{}", D(2024, 1, 1), 3.0), ("old.x", "{}", D(2024, 1, 1), 3.0)], "series_id string, dims_key string, obs_date date, value double").withColumn("revised_at", F.lit("2024-02-01").cast("timestamp"))
    catalog = spark.createDataFrame([("fx.usd", "Dollar", "pkr", "SBP", True), ("fx.eur", "Euro", "pkr", "SBP", True), ("cpi.all", "CPI", "index", "PBS", True), ("old.x", "Old", "x", "y", False)], "series_id string, name string, unit string, source string, is_active boolean")
    fresh = tables.dataset_fingerprints(obs)
    last = fresh.filter("dataset <> 'old'").withColumn("n_rows", F.when(F.col("dataset") == "fx", 1).otherwise(F.col("n_rows"))).unionByName(fresh.filter("dataset = 'cpi'").withColumn("dataset", F.lit("gone")))
    changed = tables.changed_datasets(fresh, last)
    assert {(r.dataset, r.action) for r in changed.collect()} == {("fx", "write"), ("old", "write"), ("gone", "drop")}
    tables.write_datasets(obs, catalog, str(tmp_path / "out"), changed)
    back = spark.read.option("header", True).csv(str(tmp_path / "out"))
    assert sorted((r.series_id, r.name, r.dataset) for r in back.collect()) == [("fx.eur", "Euro", "fx"), ("fx.usd", "Dollar", "fx")]


def test_guards_raise(spark):
    import pytest

    from ledgerline.operators import loads, reads, tariff

    judged = spark.createDataFrame([("a", "x")], "id string, reason string")
    with pytest.raises(ValueError):
        loads.all_rejected_guard(judged)
    assert loads.all_rejected_guard(judged.limit(0)).count() == 0
    with pytest.raises(ValueError):
        tariff.min_rows_gate(judged, "id", 2)
    for bad in (("yoy", "annual"), ("mom", "daily"), ("none", "daily")):
        with pytest.raises(ValueError):
            reads.check_transform(*bad)
    with pytest.raises(ValueError):
        reads.pct_filter(judged.withColumnRenamed("id", "code"), "123")


def test_hashes_are_keyed(spark):
    import hashlib
    import hmac

    from ledgerline.operators.names import hash_address

    got = [r.h for r in spark.createDataFrame([("1.2.3.4",), ("",), (None,)], "ip string").select(hash_address(F.col("ip"), b"salt").alias("h")).collect()]
    assert got == [hmac.new(b"salt", b"1.2.3.4", hashlib.sha256).hexdigest()[:16], "", ""]


def test_printed_codes(spark):
    from ledgerline.operators.tariff import excepted_codes, printed_codes

    text_ = "0101.2100, headings 72.04 and 8471.30; 2701.1200 to 2703.0000 (except 0304.6200 and 87.03) 9917"
    row = spark.range(1).select(printed_codes(F.lit(text_)).alias("c"), excepted_codes(F.lit(text_)).alias("x")).first()
    assert {(c.kind, c.lo, c.hi) for c in row.c} == {("code", "01012100", "01012100"), ("code", "03046200", "03046200"), ("range", "27011200", "27030000"), ("subheading", "847130", "847130"), ("heading", "7204", "7204"), ("heading", "8703", "8703"), ("heading", "9917", "9917")}
    assert row.x == ["03046200", "8703"]


def test_spellings_cluster(spark):
    from ledgerline.operators.names import cluster_spellings

    reads = ["Halmore Power (CC)"] * 5 + ["Haimore Power (CC)"] * 2 + ["HalmorePower(CC)"] * 6 + ["Halmore Power (OC)"] * 3 + ["Other Name"]
    got = {r.name: r.canonical for r in cluster_spellings(spark.createDataFrame([(n,) for n in reads], "name string")).collect()}
    assert got["HalmorePower(CC)"] == got["Haimore Power (CC)"] == "Halmore Power (CC)" and got["Halmore Power (OC)"] == "Halmore Power (OC)" and "Other Name" not in got


def test_texts(spark):
    rows = [("Cotton & Yarn's", "cotton-and-yarns"), ("A" * 70, "a" * 60), ("one two " * 12, "one-two-" * 7 + "one")]
    got = [r.s for r in spark.createDataFrame(rows, "t string, w string").select(text.slugify(F.col("t")).alias("s")).collect()]
    assert got == [w for _, w in rows]
