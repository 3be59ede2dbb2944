"""Literal cases of the quality and edition operators."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerline.operators import editions, quality, series
from tests.test_queries import obs


def test_sign_flip_needs_neighbours_that_agree(spark):
    assert [r.value for r in quality.sign_flip(series.neighbours(obs(spark, [10.0, -10.0, 11.0, 11.0]))).collect()] == [-10.0]
    assert quality.sign_flip(series.neighbours(obs(spark, [10.0, -10.0, 30.0]))).count() == 0


def test_isolated_price_spike(spark):
    near = quality.beside(obs(spark, [2500.0, 2500.0, 27002.0, 2500.0, 2500.0]), ["series_id"], "obs_date", "value")
    assert [r.value for r in quality.price_spikes(near, "value", 0.3, 0.25, 4).collect()] == [27002.0]
    shift = quality.beside(obs(spark, [1000.0, 1000.0, 5000.0, 5000.0]), ["series_id"], "obs_date", "value")
    assert quality.price_spikes(shift, "value", 0.3, 0.25, 4).count() == 0


def test_later_ruling_supersedes_and_never_the_reverse(spark):
    day = dt.date
    r = spark.createDataFrame([(1, "10", day(2020, 1, 1), []), (2, "11", day(2021, 1, 1), ["10"]), (3, "12", day(2022, 1, 1), ["10", "13"]), (4, "13", day(2023, 1, 1), None)], "ruling_id int, number string, listed_on date, supersedes array<string>")
    assert [tuple(x) for x in editions.link_supersessions(r).collect()] == [(1, 2, day(2021, 1, 1))]


def test_revision_list_is_ordered(spark):
    now = spark.createDataFrame([("a", 3.0), ("b", 1.0)], "k string, value double")
    past = spark.createDataFrame([("a", 2.0, dt.datetime(2024, 2, 1)), ("a", 1.0, dt.datetime(2024, 1, 1))], "k string, value double, superseded_at timestamp")
    got = {r.k: ([p.value for p in r.prints], r.first_print, r.revised) for r in editions.revision_history(now, past, ["k"]).collect()}
    assert got == {"a": ([1.0, 2.0], 1.0, True), "b": ([], 1.0, False)}


def test_blips_and_null_prints(spark):
    p = spark.createDataFrame([("a", i, v) for i, v in enumerate([1.0, 2.0, 1.0, 3.0, None])], "k string, issue int, value double")
    assert [r.value for r in editions.drop_blips(p, ["k"], "issue").orderBy("issue").collect()] == [1.0, 1.0, 3.0, None]


def test_repeated_parcels_are_numbered(spark):
    p = spark.createDataFrame([("a", 2), ("a", 1), ("b", 1)], "k string, o int")
    assert sorted(tuple(r) for r in editions.number_repeats(p, ["k"], [F.col("o")]).collect()) == [("a", 1, 0), ("a", 2, 1), ("b", 1, 0)]
