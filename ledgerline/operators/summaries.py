"""Partner, energy, port, usage and search summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.facts import PARTNER_LEAST


#: Fixed value: stand-ins for partners, which have no page of their own.
NO_PAGE = r"\(not specified\)|^Pakistan$|^Other \(origin"


def partner_index(trade: DataFrame, rates: DataFrame, recent_from: int, least: float = PARTNER_LEAST, no_page: str = NO_PAGE) -> DataFrame:
    """Per partner first and last year, its converted value over all years and since `recent_from`, and whether its page is
    indexable: a value of `least` or more over all years, and a name that is no stand-in. Rows are summed by year before the
    rates are joined."""
    yearly = trade.groupBy("country", "fy").agg(F.sum("value").alias("value")).join(rates, "fy", "left").withColumn("fx", F.col("value") / F.col("rate"))
    out = yearly.groupBy("country").agg(F.min("fy").alias("first_fy"), F.max("fy").alias("last_fy"), F.sum("fx").alias("all_fx"), F.sum(F.when(F.col("fy") >= recent_from, F.col("fx"))).alias("recent_fx"))
    return out.withColumn("indexable", (F.coalesce("all_fx", F.lit(0.0)) >= least) & ~F.col("country").rlike(no_page))


def hourly_to_daily(hours: DataFrame, key: list[str], least: int = 20) -> DataFrame:
    """Daily mean, peak and low of hourly values, for days with enough hours."""
    return hours.groupBy(*key, F.to_date("hour").alias("obs_date")).agg(F.avg("value").alias("mean"), F.max("value").alias("peak"), F.min("value").alias("low"), F.count("value").alias("n_hours")).filter(F.col("n_hours") >= least)


def container_cube(moves: DataFrame) -> DataFrame:
    """Containers by direction and load, each with its `all` level, in one cube."""
    c = moves.cube("direction", "cargo").agg(F.sum("value").alias("value"), F.count(F.lit(1)).alias("n"))
    return c.select(F.coalesce("direction", F.lit("all")).alias("direction"), F.coalesce("cargo", F.lit("all")).alias("cargo"), "value", "n")


def district_rollup(rows: DataFrame, printed: DataFrame) -> DataFrame:
    """Districts, provinces and the nation from one rollup; a printed total is preferred to the sum."""
    r = rows.rollup("province", "district").agg(F.sum("value").alias("summed"))
    r = r.select(F.coalesce("province", F.lit("all")).alias("province"), F.coalesce("district", F.lit("all")).alias("district"), "summed")
    return r.join(printed, ["province", "district"], "left").select("province", "district", F.coalesce("printed", "summed").alias("value"), F.col("printed").isNotNull().alias("is_printed"))


def complete_month_totals(daily: DataFrame, key: list[str]) -> DataFrame:
    """Monthly sums of months that have a value on every day."""
    g = daily.groupBy(*key, F.last_day("day").alias("month")).agg(F.sum("value").alias("value"), F.countDistinct("day").alias("n_days"))
    return g.filter(F.col("n_days") == F.dayofmonth("month"))


def user_daily(stored: DataFrame, log: DataFrame) -> DataFrame:
    """Requests per user and day; a stored count is never lowered."""
    seen = log.groupBy("user_id", "day").agg(F.count(F.lit(1)).alias("seen"))
    return stored.join(seen, ["user_id", "day"], "full_outer").select("user_id", "day", F.greatest("n", "seen").alias("n"))


def endpoint_usage(rollup: DataFrame, raw: DataFrame) -> DataFrame:
    """Past roll-ups and the rows of days without one as one figure per route: requests, weighted mean time, errors."""
    fresh = raw.join(rollup.select("day").distinct(), "day", "left_anti")
    today = fresh.groupBy("day", "route").agg(F.count(F.lit(1)).alias("n"), F.avg("ms").alias("ms"), F.count_if(F.col("status") >= 400).alias("errors"))
    return rollup.unionByName(today).groupBy("route").agg(F.sum("n").alias("n"), (F.sum(F.col("ms") * F.col("n")) / F.sum("n")).alias("mean_ms"), F.sum("errors").alias("errors"))


def word_search(entities: DataFrame, words: list[str]) -> DataFrame:
    """Entities whose haystack has every word (six at most), in tiers: title, start of title, within title, elsewhere."""
    phrase = " ".join(words[:6])
    hit: Column = F.lit(True)
    for word in words[:6]:
        hit = hit & F.contains("haystack", F.lit(word))
    title = F.lower("title")
    tier = F.when(title == phrase, 0).when(title.startswith(phrase), 1).when(F.contains(title, F.lit(phrase)), 2).otherwise(3)
    return entities.filter(hit).withColumn("tier", tier)
