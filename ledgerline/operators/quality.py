"""Findings on suspect values, agreement between two stores, and what is set aside."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.operators.series import KEY


def beside(df: DataFrame, key: list[str], order: str, value: str) -> DataFrame:
    """Previous (pv) and next (nv) value of each row of a key."""
    w = Window.partitionBy(*key).orderBy(order)
    return df.withColumn("pv", F.lag(value).over(w)).withColumn("nv", F.lead(value).over(w))


def sign_flip(near: DataFrame) -> DataFrame:
    """Of the opposite sign and similar size as two neighbours that agree within 20 %."""
    v, pv, nv = F.col("value"), F.col("pv"), F.col("nv")
    agree = (pv * nv > 0) & (F.abs(pv / nv - 1) < 0.2)
    return near.filter(agree & (v * pv < 0) & (F.abs(F.abs(v / pv) - 1) < 0.2))


def price_spikes(near: DataFrame, value: str, agree: float, low: float, high: float, nonpositive: bool = False) -> DataFrame:
    """Beyond low to high times the previous value while both neighbours agree; all three are positive. With nonpositive also
    every value of zero or less, whatever stands beside it."""
    v, pv, nv = F.col(value), F.col("pv"), F.col("nv")
    jump = (v > 0) & (pv > 0) & (nv > 0) & (F.abs(pv / nv - 1) < agree) & ((v / pv > high) | (v / pv < low))
    return near.filter(F.coalesce(jump, F.lit(False)) | (v <= 0) if nonpositive else jump)


#: Units whose values cannot be negative.
NEVER_NEGATIVE = ["index", "count", "gwh", "metric ton", "tbps"]


def out_of_range(obs: DataFrame, catalog: DataFrame) -> DataFrame:
    """Values that their unit rules out: percent beyond -100 to 1000, negative indices, counts, energy, tonnage and traffic,
    prices of zero or less."""
    u, v = F.col("unit"), F.col("value")
    bad = ((u == "percent") & ((v > 1000) | (v < -100))) | (u.isin(*NEVER_NEGATIVE) & (v < 0)) | (u.startswith("pkr_per_") & (v <= 0))
    return obs.join(catalog.select("series_id", "unit"), "series_id").filter(bad)


def yoy_vs_index(published: DataFrame, index: DataFrame, gap: float = 0.25) -> DataFrame:
    """Published yearly changes that differ from those of their own index (both with KEY, obs_date; `result` is the change)."""
    own = index.select(*KEY, "obs_date", F.col("result").alias("own"))
    return published.join(own, [*KEY, "obs_date"]).filter(F.abs(F.col("result") - F.col("own")) > gap)


def sum_identity(parts: DataFrame, totals: DataFrame, key: list[str], tolerance: float) -> DataFrame:
    """Totals that differ from the sum of their parts by more than a share of the total."""
    sums = parts.groupBy(*key).agg(F.sum("value").alias("parts"))
    return totals.join(sums, key).filter(F.abs(F.col("value") - F.col("parts")) > tolerance * F.abs("value"))


def bid_above_offer(quotes: DataFrame, key: list[str], side: Column) -> DataFrame:
    """Keys whose bid is above their offer, from one conditional aggregate."""
    g = quotes.groupBy(*key).agg(F.max(F.when(side == "bid", F.col("value"))).alias("bid"), F.max(F.when(side == "offer", F.col("value"))).alias("offer"))
    return g.filter("bid > offer")


def national_vs_cities(national: DataFrame, cities: DataFrame, key: list[str], least: int = 10, gap: float = 0.02) -> DataFrame:
    """National values more than `gap` off the mean of at least so many cities."""
    mean = cities.groupBy(*key).agg(F.avg("value").alias("city_mean"), F.count("value").alias("n_cities")).filter(F.col("n_cities") >= least)
    return national.join(mean, key).filter(F.abs(F.col("value") / F.col("city_mean") - 1) > gap)


def quarantine(df: DataFrame, flagged: DataFrame, keys: list[str], reason: str) -> DataFrame:
    """All rows with the reason for which they are set aside, null for those that stay."""
    marks = flagged.select(*keys).distinct().withColumn("reason", F.lit(reason))
    return df.join(marks, keys, "left")


def shared_dates(a: DataFrame, b: DataFrame, key: list[str], rel: float = 1e-6, least: float = 0.99) -> DataFrame:
    """Per key the dates both hold, the share that agrees, and whether a history may be trusted: the newest shared date
    agrees and so do at least 99 %."""
    j = a.select(*key, "obs_date", "value").join(b.select(*key, "obs_date", F.col("value").alias("other")), [*key, "obs_date"])
    same = F.abs(F.col("value") - F.col("other")) <= rel * F.greatest(F.abs("value"), F.abs("other"))
    g = j.groupBy(*key).agg(F.count(F.lit(1)).alias("n_shared"), F.avg(same.cast("double")).alias("agreement"), F.max_by(same, "obs_date").alias("newest_agrees"))
    return g.withColumn("trusted", F.col("newest_agrees") & (F.col("agreement") >= least))


def before_start(facts: DataFrame, entities: DataFrame, key: str, start: str, days: int = 60) -> DataFrame:
    """Entities with facts dated more than so many days before they existed, and how many."""
    early = facts.join(entities.select(key, start), key).filter(F.col("obs_date") < F.date_sub(start, days))
    return early.groupBy(key, start).agg(F.count(F.lit(1)).alias("n"), F.min("obs_date").alias("first_date"))


def reconcile_checks(compared: DataFrame, key: list[str]) -> DataFrame:
    """One check row per series from compared points: how many of each kind, and whether the series is clean."""
    kinds = ["matched", "value", "missing_ours", "missing_source"]
    g = compared.groupBy(*key).agg(*[F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in kinds])
    return g.withColumn("clean", F.col("n_value") + F.col("n_missing_ours") + F.col("n_missing_source") == 0)


def notable(findings: DataFrame, key: list[str], lumpy: int = 3) -> DataFrame:
    """Findings of series that have fewer than `lumpy` of them; others are uneven by nature."""
    few = findings.groupBy(*key).agg(F.count(F.lit(1)).alias("n_findings")).filter(F.col("n_findings") < lumpy)
    return findings.join(few, key)
