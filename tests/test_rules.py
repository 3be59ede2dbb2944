"""Rules by hand-made cases that the given tables do not hold."""

import datetime as dt
import time

import duckdb
import pytest
from pyspark.sql import functions as F

from ledgerline.operators import derived, editions, loads, merge, reads, series, status, tariff, vintages
from ledgerline.plans import adapters, registry


def day(text):
    return dt.date.fromisoformat(text)


POINTS = "series_id string, dims_key string, obs_date date, value double"


def test_partners_are_the_same_date_of_every_frequency(spark):
    weekly = [("w", "{}", day("2022-01-07") + dt.timedelta(7 * i), 100.0 + i) for i in range(110)]
    quarterly = [("q", "{}", dt.date(2020 + i // 4, 1 + 3 * (i % 4), 1), 100.0 + 10 * i) for i in range(12)]
    ends = [("m", "{}", day(d), v) for d, v in (("2020-02-29", 1.0), ("2021-02-28", 2.0), ("2022-02-28", 3.0), ("2020-03-31", 4.0))]
    got = series.against_month(spark.createDataFrame([*weekly, *quarterly, *ends], POINTS), 12).collect()
    assert len(got) == 110 + 12 + 4
    of = lambda s: {r.obs_date: r.result for r in got if r.series_id == s and r.result is not None}
    assert len(of("q")) == 8 and abs(of("q")[day("2021-04-01")] - (150 / 110 - 1) * 100) < 1e-9
    known = {d for _, _, d, _ in weekly}
    assert set(of("w")) == {d for d in known if d.replace(year=d.year - 1) in known}
    assert set(of("m")) == {day("2022-02-28")}
    month = series.against_month(spark.createDataFrame(ends, POINTS), 1).collect()
    assert {r.obs_date: r.result for r in month if r.result is not None} == {day("2020-03-31"): 300.0}


ENDS = [("m", "{}", day(d), v) for d, v in (("2020-02-29", 1.0), ("2020-03-31", 2.0), ("2020-04-30", 3.0), ("2021-02-28", 4.0), ("2021-04-30", 6.0))]


def test_month_ends_meet_month_ends(spark):
    middle = [("d", "{}", day(d), v) for d, v in (("2020-03-30", 5.0), ("2020-03-31", 7.0), ("2020-04-30", 10.0), ("2020-05-15", 1.0))]
    got = series.against_month(spark.createDataFrame([*ENDS, *middle], POINTS), 1, month_ends=True).collect()
    assert len(got) == 9 and got[0].asDict().keys() == {"series_id", "dims_key", "obs_date", "value", "result"}
    assert {(r.series_id, str(r.obs_date)): r.result for r in got if r.result is not None} == {("m", "2020-03-31"): 100.0, ("m", "2020-04-30"): 50.0, ("d", "2020-04-30"): 100.0}
    year = series.against_month(spark.createDataFrame(ENDS, POINTS), 12, month_ends=True).collect()
    assert {str(r.obs_date): r.result for r in year if r.result is not None} == {"2021-02-28": 300.0, "2021-04-30": 100.0}


def test_yoy_compares_every_month_that_has_its_partner_month(spark, sf_dir):
    every_month_compares(registry.queries()["yoy"](spark, sf_dir).collect(), 12)


def test_mom_compares_every_month_that_has_its_partner_month(spark, sf_dir):
    every_month_compares(registry.queries()["mom"](spark, sf_dir).collect(), 1)


def test_transform_compares_every_month_that_has_its_partner_month(spark, sf_dir):
    every_month_compares(registry.queries()["transform"](spark, sf_dir).collect(), 12, adapters.monthly(spark, sf_dir).collect())
    assert [r.result for r in reads.transform(spark.createDataFrame(ENDS, POINTS), "mom", "monthly", "2020-04-01").orderBy("obs_date").collect()] == [50.0, None, None]


def every_month_compares(rows, months, of=None):
    """Each month of a row has a result if its partner month is there; so many months lie between them."""
    number = lambda r: (r.series_id, r.dims_key, r.obs_date.year * 12 + r.obs_date.month)
    known = {number(r) for r in (of or rows)}
    with_result = {number(r) for r in rows if r.result is not None}
    assert with_result == {n for n in map(number, rows) if (*n[:2], n[2] - months) in known}


def test_mean_of_three_annual_points_looks_back_three_years(spark):
    rows = [("a", "{}", dt.date(2010 + i, 1, 1), float(i)) for i in range(10)]
    got = reads.transform(spark.createDataFrame(rows, POINTS), "3ma", "annual", "2015-01-01").orderBy("obs_date").collect()
    assert [r.result for r in got] == [4.0, 5.0, 6.0, 7.0, 8.0]


def test_sign_ups_of_today_are_of_today_only(spark):
    rows = [("p", day(d), day(d)) for d in ("2024-03-01", "2024-03-02", "2024-03-03", "2024-02-24", "2024-02-23")]
    r = status.overview(spark.createDataFrame(rows, "plan string, signed_up date, last_seen date"), {"p": 2.0}, F.lit("2024-03-02").cast("date")).first()
    assert (r.users, r.today, r.week, r.revenue) == (5, 1, 4, 10.0)


def test_figures_print_as_their_binary_value(spark):
    rows = [(41.05, 41.0, 1), (41.05, 41.1, 1), (0.125, 0.13, 2), (2.5, 3.0, 0), (-2.5, -3.0, 0)]
    df = spark.createDataFrame(rows, "v double, pub double, dp int")
    ours = F.round(F.col("v") / F.pow(F.lit(10.0), -F.col("dp"))) * F.pow(F.lit(10.0), -F.col("dp"))
    assert [round(r.x, 2) for r in df.select(ours.alias("x")).collect()] == [41.0, 41.0, 0.13, 3.0, -3.0]
    assert [r.x for r in df.select(vintages.prints_as(F.col("v"), F.col("pub"), F.col("dp"), F.lit(1.0)).alias("x")).collect()] == [True, False, True, True, True]


def test_new_ids_are_free_and_unique(spark):
    catalog = lambda rows: spark.createDataFrame(rows, "source_key string, series_id string")
    got = lambda a, b: {r.source_key: r.series_id for r in loads.merge_catalog(catalog(a), catalog(b)).collect()}
    assert got([("x", "gdp_2")], [("y", "gdp_2")]) == {"x": "gdp_2", "y": "gdp_2_2"}
    assert got([("x", "cpi_2010")], [("y", "cpi")]) == {"x": "cpi_2010", "y": "cpi"}
    assert got([("x", "a"), ("z", "a_3")], [("y1", "a"), ("y2", "a"), ("y3", "a"), ("x", "other")]) == {"x": "a", "z": "a_3", "y1": "a_2", "y2": "a_4", "y3": "a_5"}
    assert got([], [("1", "b"), ("2", "b"), ("3", "b_2")]) == {"1": "b", "3": "b_2", "2": "b_3"}


def test_a_duty_whose_text_changed_is_changed(spark):
    schema = "code string, fy int, component string, rate_pct double, rate_text string"
    old = spark.createDataFrame([("1", 2025, "rd", None, "Rs.5/kg"), ("2", 2025, "rd", None, "Rs.5/kg")], schema)
    new = spark.createDataFrame([("1", 2025, "rd", None, "Rs.9/kg"), ("2", 2025, "rd", None, "Rs.5/kg")], schema)
    got = {r.code: (r.rate_text, r.action) for r in tariff.sync_components(old, new, ["rd"]).collect()}
    assert got == {"1": ("Rs.9/kg", "changed"), "2": ("Rs.5/kg", "same")}


def test_rulings_of_one_day_supersede_each_other(spark):
    rows = [(1, "n1", day("2020-01-01"), ["n2", "n1"]), (2, "n2", day("2020-01-01"), []), (3, "n1", day("2021-01-01"), ["n1"]), (4, "n9", day("2022-01-01"), ["n8"])]
    got = editions.link_supersessions(spark.createDataFrame(rows, "ruling_id long, number string, listed_on date, supersedes array<string>"))
    assert sorted((r.ruling_id, r.superseded_by) for r in got.collect()) == [(1, 3), (2, 1)]


def test_one_notice_far_ahead_drops_no_other(spark):
    def cleaned(rows):
        df = spark.createDataFrame([("f", i, day(d), v) for i, (d, v) in enumerate(rows)], "fuel string, pos int, obs_date date, value double")
        return [str(r.obs_date) for r in derived.price_notices(df, ["fuel"], "pos").orderBy("pos").collect()]

    assert cleaned([("2024-04-01", 100.0), ("2029-01-01", 101.0), ("2024-02-01", 102.0), ("2024-01-01", 103.0)]) == ["2024-04-01", "2024-02-01", "2024-01-01"]
    assert cleaned([("2024-05-01", 100.0), ("2024-04-01", 101.0), ("2024-03-01", 310.0), ("2024-02-01", 102.0), ("2024-01-01", 99.0)]) == ["2024-05-01", "2024-04-01", "2024-02-01", "2024-01-01"]
    assert cleaned([("2024-05-01", 200.0), ("2024-04-01", 200.0), ("2024-03-01", 500.0), ("2024-02-01", 140.0), ("2024-01-01", 140.0)]) == ["2024-05-01", "2024-04-01", "2024-03-01", "2024-02-01", "2024-01-01"]
    assert cleaned([("2024-04-01", 400.0), ("2024-03-01", 100.0), ("2024-03-01", 101.0), ("2024-02-01", 0.0)]) == ["2024-03-01"]


def test_long_archives_are_walked_once(spark):
    """120,000 notices of one archive, out of order throughout, beside a short one with missing dates, in small batches."""
    n, first = 120_000, dt.date(1990, 1, 1)
    long = [(i, first + dt.timedelta((n - i) // 5 + (i * 7919) % 400 * (i % 3))) for i in range(n)]
    short = [(i, None if i % 11 == 5 else first + dt.timedelta((i * 37) % 50)) for i in range(100)]

    def walk(rows):
        out, newer = {}, None
        for (i, d), (_, older) in zip(rows, [*rows[1:], (None, None)], strict=True):
            out[i] = None not in (newer, older, d) and newer >= older and not newer >= d >= older
            newer = newer if out[i] else d
        return out

    df = spark.createDataFrame([(k, i, d, 1.0) for k, rows in (("long", long), (None, short)) for i, d in rows], "fuel string, pos int, obs_date date, value double")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 1000)
    try:
        began = time.monotonic()
        got = {(r.fuel, r.pos): r.misdated for r in derived.misdated(df.repartition(3), ["fuel"], "pos").collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert time.monotonic() - began < 90
    assert got == {(k, i): bad for k, rows in (("long", long), (None, short)) for i, bad in walk(rows).items()}
    assert sum(got.values()) > 1000


def test_codes_as_schedules_print_them(spark):
    def codes(text):
        row = spark.range(1).select(tariff.printed_codes(F.lit(text)).alias("c"), tariff.excepted_codes(F.lit(text)).alias("x")).first()
        return [(c.kind, c.lo, c.hi) for c in row.c], row.x

    assert codes("0304.6200 – 0304.6900")[0] == [("range", "03046200", "03046900")]
    assert codes("03046200 and heading 0304")[0] == [("code", "03046200", "03046200"), ("heading", "0304", "0304")]
    assert codes("0304. 6200; 0304.62.00, 12 and .0304 No.0405")[0] == [("code", "03046200", "03046200")]
    assert codes("0101.1000to0102.1000 - 0103.1000")[0] == [("range", "01011000", "01021000"), ("code", "01031000", "01031000")]
    assert codes("")[0] == []
    assert codes("With the exception of code 0304.6200")[1] == []
    assert codes("all, except\nthose of 0304.6200 and 87.03")[1] == ["03046200", "8703"]


def test_points_are_known_since_they_were_first_seen(spark):
    ts = lambda t: dt.datetime.fromisoformat(t)
    rows = [("s", day("2019-01-31"), "a", 1.0, ts("2025-05-01"), ts("2019-02-10")), ("s", day("2019-01-31"), "b", 2.0, ts("2025-05-01"), None), ("s", day("2021-01-31"), "c", 3.0, ts("2025-05-01"), None)]
    obs = spark.createDataFrame(rows, "series_id string, obs_date date, dims_key string, value double, revised_at timestamp, first_seen_at timestamp")
    revs = spark.createDataFrame([("s", day("2019-01-31"), "a", 0.5, ts("2022-01-01"))], "series_id string, obs_date date, dims_key string, value double, superseded_at timestamp")
    known = lambda at, since: {r.dims_key: r.known_value for r in merge.known_asof(obs, revs, F.lit(at).cast("date"), F.lit(since).cast("date")).collect()}
    assert known("2021-06-30", "2020-01-01") == {"a": 0.5, "b": 2.0}
    assert known("2023-06-30", "2020-01-01") == {"a": 1.0, "b": 2.0}
    assert known("2019-12-01", "2020-01-01") == {"a": 0.5, "b": 2.0}
    assert known("2025-06-01", "2020-01-01") == {"a": 1.0, "b": 2.0, "c": 3.0}


@pytest.mark.parametrize("name", ["known_asof", "known_before_tracking"])
def test_of_revisions_superseded_at_one_time_the_first_counts(spark, tmp_path, name):
    """Twenty points of two revisions each that are superseded at one time, the second's price now higher, now lower."""
    at = dt.datetime(1999, 5, 5)
    rows = [(k + 3000 * n, k, "O", 1000.0 + (k if (k + n) % 2 else -k), at, "5-LOW") for k in range(300, 320) for n in (0, 1)]
    schema = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"
    for arrival in (rows, rows[::-1]):
        folder = str(tmp_path / str(arrival[0][0]))
        spark.createDataFrame(arrival, schema).coalesce(1).write.parquet(f"{folder}/orders.parquet")
        got = {r.dims_key: r.known_value for r in registry.queries()[name](spark, folder).collect()}
        assert got == {str(k % 20): 1000.0 + (k if k % 2 else -k) for k in range(300, 320)}
    duck = duckdb.connect()
    duck.execute(f"create view orders as select * from '{tmp_path}/300/orders.parquet/*.parquet'")
    assert {r[2]: r[3] for r in duck.execute(registry.oracle_sql()[name]).fetchall()} == got
