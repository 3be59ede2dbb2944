"""Rankings, indices, fund measures and usage roll-ups over fact tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Days back at which a year-old partner is looked for, best first.
OFFSETS = [364, 363, 365, 362, 366, 361, 367]


def rank_partners(trade: DataFrame, rates: DataFrame) -> DataFrame:
    """Partners by flow and fiscal year: value, share of the total line, value in foreign money, place. The totals are a
    second, tiny aggregate of the first, never a window over all rows."""
    sums = trade.groupBy("flow", "fy", "country").agg(F.sum("value").alias("value"))
    totals = sums.groupBy("flow", "fy").agg(F.sum("value").alias("total"))
    out = sums.join(totals, ["flow", "fy"]).join(rates, "fy", "left")
    place = F.row_number().over(Window.partitionBy("flow", "fy").orderBy(F.desc("value"), "country"))
    return out.select("flow", "fy", "country", "value", (F.col("value") / F.col("total") * 100).alias("share_pct"), (F.col("value") / F.col("rate")).alias("value_fx"), place.alias("place"))


def product_history(trade: DataFrame, flows: list[str]) -> DataFrame:
    """Yearly totals of each product, one column per flow."""
    return trade.groupBy("code", "fy").pivot("flow", flows).agg(F.sum("value"))


def page_index(trade: DataFrame, rates: DataFrame, recent: int = 3, total: str = "All countries") -> DataFrame:
    """Yearly average in foreign money over the last `recent` fiscal years, exports and imports side by side, of every
    8-digit code and every heading, in one pass over grouping sets. Lines of all countries together count if there are any,
    the sum of partners otherwise; grand totals never do."""
    latest = trade.agg(F.max("fy").alias("latest"))
    t = trade.filter((F.col("code") != "TOTAL") & (F.length("code") == 8) & (F.col("country") != total)).join(F.broadcast(latest), F.col("fy") > F.col("latest") - recent)
    t = t.join(rates, "fy").withColumn("fx", F.col("value") / F.col("rate") / recent).withColumn("heading", F.substring("code", 1, 4))
    side = [F.coalesce(F.sum(F.when(F.col("flow") == f, F.col("fx"))), F.lit(0.0)).alias(f) for f in ("export", "import")]
    out = t.filter(F.col("flow").isin("export", "import")).groupingSets([["code", "heading"], ["heading"]], "code", "heading").agg(*side)
    return out.select(F.coalesce("code", "heading").alias("page"), F.when(F.col("code").isNull(), "heading").otherwise("code").alias("kind"), "heading", "export", "import")


#: Least recent trade of an indexable heading, code and partner, and a code's largest share of its heading.
HEADING_LEAST, CODE_LEAST, PARTNER_LEAST, CODE_MOST_SHARE = 1_000, 10_000, 10_000, 0.9


def indexable(pages: DataFrame, heading_least: float = HEADING_LEAST, code_least: float = CODE_LEAST, most_share: float = CODE_MOST_SHARE) -> DataFrame:
    """Pages of page_index with trade enough to say something; a code must also be less than `most_share` of its heading."""
    headings = pages.filter("kind = 'heading'").select("heading", (F.col("export") + F.col("import")).alias("whole"))
    p = pages.join(headings, "heading").withColumn("own", F.col("export") + F.col("import"))
    code = (F.col("kind") == "code") & (F.col("own") >= code_least) & (F.col("own") < most_share * F.col("whole"))
    return p.withColumn("indexable", code | ((F.col("kind") == "heading") & (F.col("own") >= heading_least))).drop("own", "whole")


def top_n_per_group(df: DataFrame, keys: list[str], by: list[Column], n: int) -> DataFrame:
    return df.withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy(*by))).filter(F.col("place") <= n)


def city_cost_index(prices: DataFrame, least: int = 8, base_week: str | None = None) -> DataFrame:
    """Mean of price relatives to the base week, over the items a city priced then (price above 0). The base is base_week if
    any price is of that week, else the earliest week. A city needs `least` items in its basket; every week it has is kept."""
    wanted = F.lit(base_week).cast("date")
    first = prices.filter("value is not null").agg(F.coalesce(F.max(F.when(F.col("week") == wanted, F.col("week"))), F.min("week")).alias("week"))
    base = prices.join(F.broadcast(first), "week", "left_semi").filter("value > 0").select("city", "item", F.col("value").alias("base"))
    fit = base.groupBy("city").agg(F.count(F.lit(1)).alias("basket_n")).filter(F.col("basket_n") >= least)
    j = prices.join(base.join(fit, "city"), ["city", "item"])
    return j.groupBy("city", "week", "basket_n").agg(F.round(F.avg(F.col("value") / F.col("base") * 100), 2).alias("cost_index"), F.count("value").alias("n_items"))


def jevons_yoy(prices: DataFrame, least: int = 15, offsets: list[int] | None = None) -> DataFrame:
    """Geometric mean of price relatives to the first partner found at the ranked day offsets, by city and date."""
    offsets = offsets or OFFSETS
    ranked = F.explode(F.array(*[F.struct(F.lit(i).alias("rank"), F.lit(o).alias("days")) for i, o in enumerate(offsets)]))
    past = prices.filter("value > 0").select("item", "city", F.col("obs_date").alias("past_date"), F.col("value").alias("past"))
    now = prices.filter("value > 0").select("item", "city", "obs_date", "value", ranked.alias("o")).withColumn("past_date", F.date_sub("obs_date", F.col("o.days")))
    met = now.join(past, ["item", "city", "past_date"]).groupBy("item", "city", "obs_date", "value").agg(F.min_by("past", "o.rank").alias("past"))
    out = met.groupBy("city", "obs_date").agg(F.avg(F.log(F.col("value") / F.col("past"))).alias("m"), F.count(F.lit(1)).alias("n_items")).filter(F.col("n_items") >= least)
    return out.select("city", "obs_date", ((F.exp("m") - 1) * 100).alias("yoy_pct"), "n_items")


def national_mean(prices: DataFrame, least_cities: int = 5) -> DataFrame:
    """Unweighted mean over cities by item and week, without those beyond 0.3 to 3 times the median of at least five."""
    mid = prices.groupBy("item", "week").agg(F.median("value").alias("mid"), F.count("value").alias("cities"))
    kept = prices.join(mid, ["item", "week"]).filter((F.col("cities") < least_cities) | F.col("value").between(0.3 * F.col("mid"), 3 * F.col("mid")))
    return kept.groupBy("item", "week").agg(F.avg("value").alias("value"), F.count("value").alias("n_cities"))


def weekly_median(values: DataFrame, least: int = 5) -> DataFrame:
    """Median over entities of each one's latest value in its week, for weeks with enough of them."""
    last = values.groupBy("entity", "week").agg(F.max_by("value", "obs_date").alias("value"), F.max("obs_date").alias("obs_date"))
    return last.groupBy("week").agg(F.max("obs_date").alias("obs_date"), F.median("value").alias("median_value"), F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)


#: Days of each trailing return, and which of them are also given per year.
HORIZONS, YEARLY, YEAR_DAYS = {"1m": 30, "3m": 91, "6m": 182, "1y": 365, "3y": 1095, "5y": 1825}, ["3y", "5y"], 365.25


def fund_returns(navs: DataFrame, horizons: dict[str, int] | None = None, yearly: list[str] | None = None) -> DataFrame:
    """Trailing returns in percent from the last price on or before each horizon, since the start of the year and since
    inception; the long ones also per year, and the yearly growth since inception for funds older than half a year. Two
    aggregates by fund over one shuffle, no join: prices are first brought together as the fund's sorted history."""
    horizons, yearly = horizons or HORIZONS, YEARLY if yearly is None else yearly
    w = Window.partitionBy("fund_id")
    n = navs.filter("nav > 0").select("fund_id", "obs_date", "nav", F.max("obs_date").over(w).alias("last_date"))
    upto = lambda day: F.max_by("nav", F.when(F.col("obs_date") <= day, F.col("obs_date")))
    past = [upto(F.date_sub("last_date", days)).alias(f"nav_{k}") for k, days in horizons.items()] + [upto(F.trunc("last_date", "year")).alias("nav_ytd")]
    g = n.groupBy("fund_id", "last_date").agg(F.max_by("nav", "obs_date").alias("last"), F.min_by("nav", "obs_date").alias("first"), F.min("obs_date").alias("first_date"), F.count(F.lit(1)).alias("n"), *past).filter("n >= 2")
    grown = lambda base: F.round((F.col("last") / base - 1) * 100, 2)
    per_year = lambda base, years: F.round((F.pow(F.col("last") / base, 1 / years) - 1) * 100, 2)
    age = F.datediff("last_date", "first_date") / YEAR_DAYS
    return g.select(
        "fund_id", "first_date", "last_date",
        *[grown(F.col(f"nav_{k}")).alias(f"ret_{k}") for k in [*horizons, "ytd"]],
        grown(F.col("first")).alias("ret_inception"),
        *[per_year(F.col(f"nav_{k}"), F.lit(horizons[k] / YEAR_DAYS)).alias(f"yearly_{k}") for k in yearly],
        F.when(age > 0.5, per_year(F.col("first"), age)).alias("cagr"),
    )


def fund_drawdown(navs: DataFrame) -> DataFrame:
    """Largest fall from the running peak, in percent."""
    peak = F.max("nav").over(Window.partitionBy("fund_id").orderBy("obs_date").rowsBetween(Window.unboundedPreceding, 0))
    return navs.filter("nav > 0").withColumn("peak", peak).groupBy("fund_id").agg(F.round(F.min(F.col("nav") / F.col("peak") - 1) * 100, 4).alias("max_drawdown_pct"))


def fund_volatility(navs: DataFrame, least: int = 6) -> DataFrame:
    """Yearly volatility of month-end returns over consecutive available months."""
    ends = navs.filter("nav > 0").groupBy("fund_id", F.last_day("obs_date").alias("month")).agg(F.max_by("nav", "obs_date").alias("nav"))
    past = F.lag("nav").over(Window.partitionBy("fund_id").orderBy("month"))
    r = ends.withColumn("r", F.col("nav") / past - 1)
    return r.groupBy("fund_id").agg(F.count("r").alias("n"), F.round(F.stddev_samp("r") * F.sqrt(F.lit(12.0)) * 100, 4).alias("volatility_pct")).filter(F.col("n") >= least)


def port_day_series(calls: DataFrame) -> DataFrame:
    """Tonnage by day for all calls, by direction, by commodity and by both, from one pass over grouping sets."""
    out = calls.groupingSets([["port", "day"], ["port", "day", "direction"], ["port", "day", "commodity"], ["port", "day", "direction", "commodity"]], "port", "day", "direction", "commodity").agg(F.sum("tonnes").alias("tonnes"), F.countDistinct("vessel").alias("ships"))
    return out.select("port", "day", F.coalesce("direction", F.lit("all")).alias("direction"), F.coalesce("commodity", F.lit("total")).alias("commodity"), "tonnes", "ships")


ROLLUP_KEYS = ["day", "user_id", "auth", "route", "status_class"]


def usage_rollup(log: DataFrame) -> DataFrame:
    """Requests by day, user, kind of access, route and status class: count, exact median and 95th percentile of the time (between
    two ranks in proportion), bytes, cache hits.

    The same at every size: each group's times are counted by value first, which brings equal ones together on the map side,
    and ranked by running counts in a sort that spills, so that no group's times are held in memory."""
    rows = log.withColumn("status_class", (F.col("status") / 100).cast("int"))
    sums = rows.groupBy(*ROLLUP_KEYS).agg(F.count(F.lit(1)).alias("n"), F.count("ms").alias("timed"), F.sum("bytes").alias("bytes"), F.count_if(F.col("cache") == "hit").alias("cache_hits"))
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in ROLLUP_KEYS]
    values = rows.filter("ms is not null").groupBy(*ROLLUP_KEYS, "ms").agg(F.count(F.lit(1)).alias("times"))
    upto = F.sum("times").over(Window.partitionBy(*ROLLUP_KEYS).orderBy("ms").rowsBetween(Window.unboundedPreceding, 0))
    ranked = values.withColumn("upto", upto).alias("a").join(sums.select(*ROLLUP_KEYS, "timed").alias("b"), same).select("a.*", "b.timed")
    picks, shares = [], {"p50": 0.5, "p95": 0.95}
    for name, share in shares.items():
        rank = share * (F.col("timed") - 1)  # from 0; the values at the ranks on both sides are mixed
        for side, at in (("lo", F.floor(rank)), ("hi", F.ceil(rank))):
            picks.append(F.min(F.when(F.col("upto") > at, F.col("ms"))).alias(f"{name}_{side}"))
    found = ranked.groupBy(*ROLLUP_KEYS).agg(*picks)
    j = sums.alias("a").join(found.alias("b"), same, "left")
    mixed = lambda p, share: F.col(f"b.{p}_lo") + (share * (F.col("a.timed") - 1) - F.floor(share * (F.col("a.timed") - 1))) * (F.col(f"b.{p}_hi") - F.col(f"b.{p}_lo"))
    return j.select(*[f"a.{k}" for k in ROLLUP_KEYS], "a.n", *[mixed(p, s).alias(p) for p, s in shares.items()], "a.bytes", "a.cache_hits")


def usage_sketches(log: DataFrame, keys: list[str], k: int = 400, lg_k: int = 14) -> DataFrame:
    """What is stored of each day: count, bytes, a sketch of the times and one of the different addresses, by `day` and keys.
    Sketches of days are merged by merged_usage(). k and lg_k set their size: with k = 400 a quantile's rank is off by
    about 0.7 %, with lg_k = 14 a count of addresses by about 0.8 % (one standard deviation); both are exact for few values."""
    cells = F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes")
    return log.groupBy("day", *keys).agg(*cells, F.kll_sketch_agg_double("ms", F.lit(k)).alias("times"), F.hll_sketch_agg("address", F.lit(lg_k)).alias("addresses"))


def merged_usage(days: DataFrame, keys: list[str], shares: tuple[float, ...] = (0.5, 0.95)) -> DataFrame:
    """usage_sketches of several days -> count, bytes, quantiles of the time and different addresses by keys. A merge of merges is
    the same as one merge, so days may be merged to weeks and these to months."""
    g = days.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes"), F.kll_merge_agg_double("times").alias("times"), F.hll_union_agg("addresses").alias("addresses"))
    quantiles = [F.expr(f"kll_sketch_get_quantile_double(times, {s})").alias(f"p{round(100 * s)}") for s in shares]
    return g.select(*keys, "n", "bytes", *quantiles, F.hll_sketch_estimate("addresses").alias("addresses"))


def unique_visitors(log: DataFrame, error: float | None = None) -> DataFrame:
    """Different addresses by day; with `error`, an approximate count of that relative deviation."""
    return log.groupBy("day").agg((F.countDistinct("address") if error is None else F.approx_count_distinct("address", error)).alias("visitors"))


def top_values(log: DataFrame, dims: dict[str, Column], n: int = 500) -> DataFrame:
    """The n most frequent values of each dimension, from one pass and one count. dims: name -> the value as a string, null
    where the row does not count for that dimension."""
    pairs = F.explode(F.array(*[F.struct(F.lit(k).alias("dim"), v.cast("string").alias("val")) for k, v in dims.items()]))
    long = log.select(pairs.alias("p")).select("p.dim", "p.val").filter("val is not null").groupBy("dim", "val").agg(F.count(F.lit(1)).alias("n"))
    return top_n_per_group(long, ["dim"], [F.desc("n"), F.col("val")], n)


def nearest_prior(points: DataFrame, targets: DataFrame, key: list[str], tolerance: int = 7) -> DataFrame:
    """The last row on or before each target date within so many days: dates are spread over the tolerance on the side of
    the targets, so the join is an equality."""
    spread = targets.withColumn("back", F.explode(F.sequence(F.lit(0), F.lit(tolerance)))).withColumn("obs_date", F.date_sub("target", F.col("back")))
    return spread.join(points.select(*key, "obs_date", "value"), [*key, "obs_date"]).groupBy(*key, "target").agg(F.min_by("value", "back").alias("value"), F.min("back").alias("days_back"))


def expand_printed_codes(entries: DataFrame, codes: DataFrame) -> DataFrame:
    """Printed code prefixes of 2, 4, 6 or 8 digits to the year's full codes: one equality join per length."""
    out = None
    for n in (2, 4, 6, 8):
        hit = entries.filter(F.length("printed") == n).join(codes.withColumn("printed", F.substring("code", 1, n)), ["fy", "printed"])
        hit = hit.select("entry", "fy", "printed", "code")
        out = hit if out is None else out.unionByName(hit)
    return out


def most_specific_prefix(matches: DataFrame) -> DataFrame:
    """Of the entries that meet a code the one with the longest printed prefix."""
    w = Window.partitionBy("fy", "code").orderBy(F.desc(F.length("printed")), "entry")
    return matches.withColumn("rn", F.row_number().over(w)).filter("rn = 1").drop("rn")
