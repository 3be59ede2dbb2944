"""Time-series transforms over observations (series_id, dims_key, obs_date, value)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.functions.calendar import month_number

KEY = ["series_id", "dims_key"]


def _ordered():
    return Window.partitionBy(*KEY).orderBy("obs_date")


def pct_change(obs: DataFrame) -> DataFrame:
    """Percent against the previous observation; null without one, or on a zero base."""
    past = F.lag("value").over(_ordered())
    return obs.withColumn("result", F.when(past != 0, (F.col("value") / past - 1) * 100))


def against_month(obs: DataFrame, months: int, month_ends: bool = False) -> DataFrame:
    """Percent against the same date `months` earlier (12: yoy, 1: mom), or that month's last day where it is too short. Nothing
    stands in for a partner that is missing: a point at the end of February has none in a leap year's end of February.

    month_ends, for monthly series: a point on its month's last day that has no such partner takes the last day of the partner's
    month, so that a series dated on month ends compares every month (30 April with 31 March)."""
    past = obs.select(*KEY, F.col("obs_date").alias("partner"), F.col("value").alias("past"))
    asked = obs.withColumn("partner", F.add_months("obs_date", -months))
    if month_ends:
        late = (F.col("obs_date") == F.last_day("obs_date")) & (F.col("partner") != F.last_day("partner"))
        exact = past.withColumn("met", F.lit(True))
        ends = past.select(*KEY, F.col("partner").alias("end"), F.col("past").alias("at_end"))
        met = asked.withColumn("end", F.when(late, F.last_day("partner"))).join(exact, [*KEY, "partner"], "left").join(ends, [*KEY, "end"], "left")
        asked = met.withColumn("past", F.when(F.col("met"), F.col("past")).otherwise(F.col("at_end"))).drop("met", "end", "at_end")
    else:
        asked = asked.join(past, [*KEY, "partner"], "left")
    return asked.withColumn("result", F.when(F.col("past") != 0, (F.col("value") / F.col("past") - 1) * 100)).drop("past", "partner")


def ma3(obs: DataFrame) -> DataFrame:
    """Mean of the last three rows; a null among them gives null."""
    w = _ordered().rowsBetween(-2, 0)
    return obs.withColumn("result", F.when(F.count("value").over(w) == 3, F.avg("value").over(w)))


def index_100(obs: DataFrame) -> DataFrame:
    """Rebased to the first non-null value of the window."""
    w = _ordered().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    base = F.first("value", ignorenulls=True).over(w)
    return obs.withColumn("result", F.when(base != 0, F.col("value") / base * 100))


def latest(obs: DataFrame) -> DataFrame:
    return obs.withColumn("rn", F.row_number().over(Window.partitionBy(*KEY).orderBy(F.desc("obs_date")))).filter("rn = 1").drop("rn")


def rolling_sum_months(points: DataFrame, months: int = 12) -> DataFrame:
    """Sum of so many consecutive months; a gap breaks the window."""
    w = Window.partitionBy(*KEY).orderBy("month_no").rangeBetween(-(months - 1), 0)
    numbered = points.withColumn("month_no", month_number(F.col("obs_date")))
    return numbered.withColumn("n", F.count("value").over(w)).withColumn("result", F.sum("value").over(w)).filter(F.col("n") == months).drop("n", "month_no")


def ratio_to_trailing_mean(num: DataFrame, den: DataFrame, months: int = 3) -> DataFrame:
    """Each value of `num` over the mean of the last consecutive months of `den` up to that month, where their sum is positive."""
    total = rolling_sum_months(den, months).filter("result > 0").select(*KEY, "obs_date", (F.col("result") / months).alias("mean"))
    return num.join(total, [*KEY, "obs_date"]).withColumn("result", F.col("value") / F.col("mean")).drop("mean")


def monthly_mean(points: DataFrame, least: int) -> DataFrame:
    """Mean per month end that has at least `least` points."""
    out = points.groupBy(*KEY, F.last_day("obs_date").alias("obs_date")).agg(F.avg("value").alias("result"), F.count("value").alias("n"))
    return out.filter(F.col("n") >= least).drop("n")


def step_asof(changes: DataFrame, dates: DataFrame, key: list[str]) -> DataFrame:
    """The step value in force on each date: changes (key, obs_date, value), dates (key, obs_date). Union and last value,
    so that a key's rows are sorted once and no range join is needed. Dates before the first change are left out."""
    both = changes.select(*key, "obs_date", "value", F.lit(0).alias("asked")).unionByName(dates.select(*key, "obs_date", F.lit(None).cast("double").alias("value"), F.lit(1).alias("asked")))
    w = Window.partitionBy(*key).orderBy("obs_date", "asked").rowsBetween(Window.unboundedPreceding, 0)
    return both.withColumn("in_force", F.last("value", ignorenulls=True).over(w)).filter("asked = 1 and in_force is not null").select(*key, "obs_date", "in_force")


def splice(sources: list[DataFrame], key: list[str]) -> DataFrame:
    """Priority union: the first source that holds a key and date wins."""
    ranked = [s.select(*key, "value", F.lit(i).alias("priority")) for i, s in enumerate(sources)]
    every = ranked[0]
    for r in ranked[1:]:
        every = every.unionByName(r)
    return every.groupBy(*key).agg(F.min_by("value", "priority").alias("value"), F.min("priority").alias("source_no"))


def flat_runs(obs: DataFrame, least: int = 6) -> DataFrame:
    """Runs of at least `least` identical consecutive non-zero prints: start, end and length."""
    w = _ordered()
    changed = F.when(F.lag("value").over(w).eqNullSafe(F.col("value")), 0).otherwise(1)
    runs = obs.withColumn("changed", changed).withColumn("run", F.sum("changed").over(w)).filter("value <> 0")
    return runs.groupBy(*KEY, "run", "value").agg(F.min("obs_date").alias("start_date"), F.max("obs_date").alias("end_date"), F.count(F.lit(1)).alias("length")).filter(F.col("length") >= least).drop("run")


def neighbours(obs: DataFrame) -> DataFrame:
    """Previous and next value beside each point; computed once and shared by the detectors."""
    w = _ordered()
    return obs.withColumn("pv", F.lag("value").over(w)).withColumn("nv", F.lead("value").over(w))


def of_unit(near: DataFrame, catalog: DataFrame, only: list[str] = (), but: list[str] = ()) -> DataFrame:
    """Points of active series whose unit is one of `only`, or none of `but` (no unit is none of them)."""
    unit = F.coalesce("unit", F.lit(""))
    kept = catalog.filter("is_active").filter(unit.isin(*only) if only else ~unit.isin(*but))
    return near.join(kept.select("series_id"), "series_id", "left_semi")


def spike_level(near: DataFrame, catalog: DataFrame) -> DataFrame:
    """More than three times off both neighbours, which agree within 30 % and have its sign; not for series in percent."""
    v, pv, nv = F.col("value"), F.col("pv"), F.col("nv")
    ok = (v != 0) & (pv != 0) & (nv != 0) & (F.signum(v) == F.signum(pv)) & (F.signum(pv) == F.signum(nv))
    return of_unit(near, catalog, but=["percent"]).filter(ok).filter((F.abs(pv / nv - 1) < 0.3) & (F.greatest(F.abs(v / pv), F.abs(pv / v)) > 3))


def spike_rate(near: DataFrame, catalog: DataFrame, largest_exact: int | None = None) -> DataFrame:
    """Far from both neighbours, measured by the series' median absolute move; series in percent only. The median is exact
    unless largest_exact says how many points a series may have at most: above that it is the approximate one."""
    rates, move = of_unit(near, catalog, only=["percent"]), F.abs(F.col("value") - F.col("pv"))
    mad = rates.groupBy(*KEY).agg((F.median(move) if largest_exact is None else F.percentile_approx(move, 0.5, 10 * largest_exact)).alias("mad"))
    v, pv, nv, m = F.col("value"), F.col("pv"), F.col("nv"), F.col("mad")
    return rates.join(mad, KEY).filter((F.abs(pv - nv) <= F.greatest(2 * m, F.lit(0.2))) & (F.abs(v - (pv + nv) / 2) > F.greatest(8 * m, F.lit(1.0))))


#: Units and words in names of series that have no scale to slip.
SCALELESS_UNITS, SCALELESS_NAMES = ["percent", "index", "ratio"], ["percent", "growth"]


def scale_slips(near: DataFrame, catalog: DataFrame) -> DataFrame:
    """A value off by a power of 1000 from neighbours that agree; `factor` is that power. Series that have no scale by their
    unit or name are left out."""
    for word in SCALELESS_NAMES:
        catalog = catalog.filter(~F.col("name").ilike(f"%{word}%"))
    near = of_unit(near, catalog, but=SCALELESS_UNITS)
    v, pv, nv = F.col("value"), F.col("pv"), F.col("nv")
    ok = (v != 0) & (pv * v > 0) & (nv * v > 0) & (F.least(F.abs(pv), F.abs(nv)) >= 1) & F.abs(pv / nv).between(0.67, 1.5)
    power = F.round(F.log10(F.abs(v) / F.sqrt(F.abs(pv * nv))) / 3)
    out = near.filter(ok).withColumn("factor", F.pow(F.lit(1000.0), power)).filter("factor <> 1")
    back = F.abs(v / F.col("factor"))
    return out.filter((back >= 0.8 * F.least(F.abs(pv), F.abs(nv))) & (back <= 1.25 * F.greatest(F.abs(pv), F.abs(nv))))
