"""Derived indicators and the joins they need: differences, as-of values with an expiry, baskets, charts, and profiles."""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType
from pyspark.sql.window import Window

from ledgerline.operators import series
from ledgerline.operators.facts import OFFSETS, top_n_per_group
from ledgerline.session import scratch_dir


def difference(a: DataFrame, b: DataFrame, key: list[str]) -> DataFrame:
    """a minus b on the dates that both have."""
    return a.join(b.select(*key, "obs_date", F.col("value").alias("less")), [*key, "obs_date"]).select(*key, "obs_date", (F.col("value") - F.col("less")).alias("value"))


def share_pct(part: DataFrame, whole: DataFrame, key: list[str], scale: float = 1.0) -> DataFrame:
    """Part of a whole (in other units by scale) in percent, where the whole is not zero."""
    j = part.join(whole.select(*key, "obs_date", F.col("value").alias("whole")).filter("whole <> 0"), [*key, "obs_date"])
    return j.select(*key, "obs_date", (F.col("value") / (F.col("whole") * scale) * 100).alias("value"))


def difference_asof(a: DataFrame, changes: DataFrame, key: list[str]) -> DataFrame:
    """Values minus the step value in force on their dates."""
    steps = series.step_asof(changes, a.select(*key, "obs_date").distinct(), key)
    return a.join(steps, [*key, "obs_date"]).select(*key, "obs_date", (F.col("value") - F.col("in_force")).alias("value"))


def offset_match(points: DataFrame, key: list[str], offsets: list[int] | None = None) -> DataFrame:
    """Each point with the first partner that exists at the ranked day offsets: one equality join over the offsets."""
    ranked = F.explode(F.array(*[F.struct(F.lit(i).alias("rank"), F.lit(o).alias("days")) for i, o in enumerate(offsets or OFFSETS)]))
    asked = points.select(*key, "obs_date", "value", ranked.alias("o")).withColumn("past_date", F.date_sub("obs_date", F.col("o.days")))
    past = points.select(*key, F.col("obs_date").alias("past_date"), F.col("value").alias("past"))
    return asked.join(past, [*key, "past_date"]).groupBy(*key, "obs_date", "value").agg(F.min_by("past", "o.rank").alias("past"), F.min_by("o.days", "o.rank").alias("days"))


def carry_forward(prices: DataFrame, weeks: DataFrame, key: list[str], days: int = 14) -> DataFrame:
    """(key, obs_date, value) on every week of weeks (key, obs_date), carried forward for so many days at most."""
    both = prices.select(*key, "obs_date", F.struct("obs_date", "value").alias("p"), F.lit(0).alias("asked")).unionByName(weeks.select(*key, "obs_date", F.lit(None).cast("struct<obs_date: date, value: double>").alias("p"), F.lit(1).alias("asked")))
    w = Window.partitionBy(*key).orderBy("obs_date", "asked").rowsBetween(Window.unboundedPreceding, 0)
    last = both.withColumn("last", F.last("p", ignorenulls=True).over(w)).filter("asked = 1")
    return last.filter(F.datediff("obs_date", "last.obs_date") <= days).select(*key, "obs_date", F.col("last.value").alias("value"))


def basket_cost(prices: DataFrame, basket: DataFrame, group: list[str], days: int = 14) -> DataFrame:
    """(group, item, obs_date, value) and basket (item, qty) -> the weekly cost of the basket, for weeks on which every item
    has a price of the last days. The basket holds a few rows; its size is counted once."""
    size = basket.agg(F.count(F.lit(1)).alias("size"))
    own = prices.join(F.broadcast(basket.select("item")), "item", "left_semi")
    weeks = own.select(*group, "obs_date").distinct().join(F.broadcast(basket.select("item")), how="cross")
    carried = carry_forward(own, weeks, [*group, "item"], days).join(F.broadcast(basket), "item")
    g = carried.groupBy(*group, "obs_date").agg(F.sum(F.col("qty") * F.col("value")).alias("value"), F.count(F.lit(1)).alias("n"))
    return g.join(F.broadcast(size), how="cross").filter("n = size").select(*group, "obs_date", "value")


def month_ends(df: DataFrame, key: list[str], first: str, last: Column | str) -> DataFrame:
    """(key, obs_date): every month end from the month of `first` to that of `last`."""
    ends = F.transform(F.sequence(F.trunc(first, "month"), F.trunc(last, "month"), F.expr("interval 1 month")), lambda d: F.last_day(d))
    return df.select(*key, F.explode(ends).alias("obs_date"))


def in_usd_month_end(changes: DataFrame, fx: DataFrame, key: list[str], last_complete: Column, digits: int = 4) -> DataFrame:
    """A price dated at its changes, in foreign money: the price in force at each month end over that month's rate, up to
    the last month that is over and has a rate."""
    rates = fx.filter("value <> 0").select(F.last_day("obs_date").alias("obs_date"), F.col("value").alias("rate"))
    end = rates.agg(F.least(F.max("obs_date"), last_complete).alias("end"))
    spans = changes.groupBy(*key).agg(F.min("obs_date").alias("begin")).join(F.broadcast(end), how="cross").filter("begin <= end")
    steps = series.step_asof(changes, month_ends(spans, key, "begin", "end"), key)
    return steps.join(rates, "obs_date").select(*key, "obs_date", F.round(F.col("in_force") / F.col("rate"), digits).alias("value"))


def collect_mapped(catalog: DataFrame, obs: DataFrame, pattern: str, low: float = 0.5, high: float = 40) -> DataFrame:
    """Points of series whose names match a pattern with two groups (kind, tenor), by these: values out of bounds go, and the
    smallest source id wins a date."""
    known = catalog.select("series_id", F.regexp_extract("name", pattern, 1).alias("kind"), F.regexp_extract("name", pattern, 2).alias("tenor")).filter("kind <> ''")
    j = obs.join(known, "series_id").filter(F.col("value").between(low, high))
    return j.groupBy("kind", "tenor", "obs_date").agg(F.min_by("value", F.struct("series_id", "value")).alias("value"), F.min("series_id").alias("source_id"))


@dataclass
class Spec:
    """A derived indicator: how it is made from named inputs, and the bounds its values must keep. An input is addressed as
    `series`, `series|dim=value`, `spi:<city>` (prices of a city's items), `funds:<category>:<column>` (a column of a
    category's funds) or `=<id>` (the result of another indicator)."""

    id: str
    inputs: dict[str, str]
    compute: Callable[[dict[str, DataFrame]], DataFrame]
    low: float = float("-inf")
    high: float = float("inf")
    version: int = 1
    method: str = field(default="")


def by_dependency(specs: list[Spec]) -> list[Spec]:
    """Specs in an order in which each comes after those whose results it reads."""
    known, done, out = {s.id: s for s in specs}, set(), []

    def visit(s: Spec, path: tuple[str, ...]) -> None:
        if s.id in path:
            raise ValueError(f"indicators read each other: {' -> '.join([*path, s.id])}")
        if s.id in done:
            return
        for address in s.inputs.values():
            if address.startswith("="):
                if address[1:] not in known:
                    raise ValueError(f"{s.id} reads {address[1:]}, which no indicator makes")
                visit(known[address[1:]], (*path, s.id))
        done.add(s.id)
        out.append(s)

    for s in specs:
        visit(s, ())
    return out


INPUT = "item string, obs_date date, value double, input int"


def spec_inputs(addresses: list[str], obs: DataFrame, prices: DataFrame | None, funds: DataFrame | None) -> DataFrame:
    """(item, obs_date, value, input): the rows of every address, `input` being its place in the list. Each table is read once:
    a row is tagged with all addresses that ask for it, by a join with the list of them (as many rows as addresses) on what
    they name. prices: (city, item, obs_date, value); funds: (category, fund_id, obs_date, columns...)."""
    spark = obs.sparkSession
    named: list[tuple] = []
    cities: list[tuple] = []
    columns: list[tuple] = []
    for i, address in enumerate(addresses):
        kind, _, rest = address.partition(":")
        if kind == "spi" and rest:
            cities.append((i, rest))
        elif kind == "funds" and rest:
            columns.append((i, *rest.split(":")))
        else:
            series_id, _, pair = address.partition("|")
            name, _, value = pair.partition("=")
            named.append((i, series_id, f"$.{name}" if pair else None, value if pair else None))
    out = []
    if named:
        asked = F.broadcast(spark.createDataFrame(named, "input int, series_id string, path string, wanted string"))
        has = reduce(lambda c, p: F.when(F.col("path") == p, F.get_json_object("dims_key", p)).otherwise(c), sorted({n[2] for n in named if n[2]}), F.lit(None).cast("string"))
        out.append(obs.join(asked, "series_id").filter(F.col("path").isNull() | (has == F.col("wanted"))).select(F.lit(None).cast("string").alias("item"), "obs_date", "value", "input"))
    if cities:
        asked = F.broadcast(spark.createDataFrame(cities, "input int, city string"))
        out.append(prices.join(asked, "city").select("item", "obs_date", "value", "input"))
    if columns:
        asked = F.broadcast(spark.createDataFrame(columns, "input int, category string, measure string"))
        long = funds.unpivot(["category", F.col("fund_id").cast("string").alias("item"), "obs_date"], sorted({c[2] for c in columns}), "measure", "value")
        out.append(long.join(asked, ["category", "measure"]).select("item", "obs_date", F.col("value").cast("double").alias("value"), "input"))
    return reduce(DataFrame.unionByName, out)


def run_specs(obs: DataFrame, specs: list[Spec], digits: int = 6, prices: DataFrame | None = None, funds: DataFrame | None = None) -> DataFrame:
    """All indicators: (series_id, obs_date, value, version), values within each one's bounds (both included), rounded once.
    compute gets (item, obs_date, value) of each input; item is null but for prices and funds.

    The inputs of all indicators are written once, by input, so that the observations are scanned once however many
    indicators there are, and each then reads its own files. Results that others read are written too."""
    spark, folder = obs.sparkSession, scratch_dir(obs.sparkSession)
    ordered = by_dependency(specs)
    addresses = sorted({a for s in ordered for a in s.inputs.values() if not a.startswith("=")})
    if addresses:
        spec_inputs(addresses, obs, prices, funds).write.partitionBy("input").parquet(f"{folder}/inputs")
    read = {a[1:] for s in ordered for a in s.inputs.values() if a.startswith("=")}
    results: dict[str, DataFrame] = {}

    def given(address: str) -> DataFrame:
        if address.startswith("="):
            return results[address[1:]].select(F.lit(None).cast("string").alias("item"), "obs_date", "value")
        return spark.read.schema(INPUT).parquet(f"{folder}/inputs").filter(F.col("input") == addresses.index(address)).drop("input")

    for n, s in enumerate(ordered):
        points = s.compute({name: given(address) for name, address in s.inputs.items()})
        out = points.filter(F.col("value").between(s.low, s.high)).select(F.lit(s.id).alias("series_id"), "obs_date", F.round("value", digits).alias("value"), F.lit(s.version).alias("version"))
        if s.id in read:
            out.write.parquet(f"{folder}/result-{n}")
            out = spark.read.schema(out.schema).parquet(f"{folder}/result-{n}")
        results[s.id] = out
    return reduce(DataFrame.unionByName, [results[s.id] for s in specs])


#: Frequencies finer than a week, and of a week or two.
SUB_WEEKLY, WEEKLY = ["daily", "business_daily", "business daily"], ["weekly", "fortnightly"]


def six_digits(x: Column) -> Column:
    """A number to six significant digits; exact halves of the last one go away from zero."""
    unit = F.pow(F.lit(10.0), F.floor(F.log10(F.abs(x))) - 5)
    return F.when(x == 0, x).otherwise(F.round(x / unit) * unit)


def chart_points(obs: DataFrame, budget: int = 500, years: int = 5, least_room: int = 40) -> DataFrame:
    """What a full-history chart shows of each series, (series_id, dims_key, obs_date, value, frequency): the last years as
    published, of a daily series the last point of each ISO week; older points as averages to six digits, dated on their
    period's first day: by month for daily and weekly series, or by year if there are more months than room; by year for
    monthly ones; for quarterly ones by year if there are more points than room; of all other series as published. Room is
    what the budget leaves beside the last years, and least_room at least. Null values are no points."""
    key, freq = series.KEY, F.lower(F.coalesce("frequency", F.lit("")))
    o = obs.filter("value is not null").withColumn("freq", freq)
    last = o.groupBy(*key).agg(F.add_months(F.max("obs_date"), -12 * years).alias("cutoff"))
    j = o.join(last, key).withColumn("recent", F.col("obs_date") >= F.col("cutoff"))
    week = F.when(F.col("freq").isin(*SUB_WEEKLY), F.date_trunc("week", "obs_date").cast("date")).otherwise(F.col("obs_date"))
    shown = j.filter("recent").groupBy(*key, week.alias("slot")).agg(F.max("obs_date").alias("obs_date"), F.max_by("value", "obs_date").alias("value")).drop("slot")
    n_recent = shown.groupBy(*key).agg(F.count(F.lit(1)).alias("n_recent"))
    n_old = j.filter("not recent").groupBy(*key).agg(F.count(F.lit(1)).alias("points"), F.countDistinct(F.trunc("obs_date", "month")).alias("months"))
    room = F.greatest(F.lit(budget) - F.coalesce("n_recent", F.lit(0)), F.lit(least_room))
    by = F.when(F.col("freq").isin(*SUB_WEEKLY, *WEEKLY), F.when(F.col("months") > room, "year").otherwise("month")).when((F.col("freq") == "monthly") | ((F.col("freq") == "quarterly") & (F.col("points") > room)), "year")
    old = j.filter("not recent").join(n_old, key).join(n_recent, key, "left").withColumn("avg", by)
    slot = F.when(F.col("avg") == "year", F.trunc("obs_date", "year")).when(F.col("avg") == "month", F.trunc("obs_date", "month")).otherwise(F.col("obs_date"))
    older = old.groupBy(*key, slot.alias("obs_date"), "avg").agg(F.avg("value").alias("value"))
    older = older.withColumn("value", F.when(F.col("avg").isNull(), F.col("value")).otherwise(six_digits(F.col("value"))))
    return shown.withColumn("avg", F.lit(None).cast("string")).unionByName(older.select(*key, "obs_date", "value", "avg"))


#: Dimension values that a chart shows by default, best first.
DEFAULT_VALUES = ["offer", "national", "total", "sell"]


def default_group(obs: DataFrame, dims: list[str]) -> DataFrame:
    """The dimensions that stand for a series where none are asked for: the preferred value of each, else the first by name.
    One row for each series and dimension it has."""
    long = reduce(DataFrame.unionByName, [obs.select("series_id", F.lit(d).alias("dim"), F.get_json_object("dims_key", f"$.{d}").alias("val")).distinct() for d in dims]).filter("val is not null")
    place = reduce(lambda out, i: F.when(F.col("val") == DEFAULT_VALUES[i], i).otherwise(out), reversed(range(len(DEFAULT_VALUES))), F.lit(len(DEFAULT_VALUES)))
    return long.groupBy("series_id", "dim").agg(F.min_by("val", F.struct(place, "val")).alias("val"))


#: How far the neighbours of a spike may be apart, and how many times a spike is off.
NOTICE_AGREE, NOTICE_SPIKE = 0.25, 3


def misdated(notices: DataFrame, key: list[str], order: str) -> DataFrame:
    """notices (key, order, obs_date, value) in the order of their archive, the newest first, with `misdated`: dated outside of
    the span from the older neighbour to the newer one that was kept, where these two are in order. As what is kept decides on
    what follows, a key's rows are walked in order, once; all that is carried from row to row is the date kept last."""
    w = Window.partitionBy(*key).orderBy(order, "obs_date", "value")
    n = notices.select(*key, order, "obs_date", "value")
    names = n.columns

    def run(batches):
        newer = math.nan
        for batch in batches:
            # a missing date is NaN, for which no comparison holds
            days, olders = (batch.column(c).cast(pa.float64()).to_numpy(zero_copy_only=False).tolist() for c in ("_day", "_older"))
            bad = []
            for place, day, older in zip(batch.column("_place").to_pylist(), days, olders, strict=True):
                if place == 1:
                    newer = math.nan
                bad.append(newer >= older and (day > newer or day < older))
                if not bad[-1]:
                    newer = day
            yield pa.RecordBatch.from_arrays([*map(batch.column, names), pa.array(bad, pa.bool_())], [*names, "misdated"])

    walked = n.withColumns({"_place": F.row_number().over(w), "_day": F.unix_date("obs_date"), "_older": F.unix_date(F.lead("obs_date").over(w))})
    return walked.sortWithinPartitions(*key, "_place").mapInArrow(run, StructType([*n.schema.fields, StructField("misdated", BooleanType())]))


def price_notices(notices: DataFrame, key: list[str], order: str) -> DataFrame:
    """Dated price notices in the order of their archive, the newest first, cleaned: misdated ones go; then a price over three
    times the larger or under a third of the smaller of two neighbours that agree within 25 %, and one at either end off by
    more than three times from its only neighbour; of notices with one date the first listed of what is left counts. Prices
    of null are no neighbours and are left out, nor is a price of zero a neighbour to judge by."""
    kept = misdated(notices.filter("value is not null"), key, order).filter(~F.col("misdated")).drop("misdated")
    w = Window.partitionBy(*key).orderBy(order)
    near = kept.withColumn("nv", F.lag("value").over(w)).withColumn("pv", F.lead("value").over(w))
    pv, nv, v = F.col("pv"), F.col("nv"), F.col("value")
    spike = (F.abs(pv / nv - 1) < NOTICE_AGREE) & ((v > NOTICE_SPIKE * F.greatest(pv, nv)) | (v < F.least(pv, nv) / NOTICE_SPIKE))
    only = F.when(nv.isNull(), pv).when(pv.isNull(), nv)
    edge = (only != 0) & ~v.between(only / NOTICE_SPIKE, only * NOTICE_SPIKE)
    left = near.filter(~F.coalesce((pv != 0) & (nv != 0) & spike, F.lit(False)) & ~F.coalesce(edge, F.lit(False))).drop("pv", "nv")
    return top_n_per_group(left, [*key, "obs_date"], [F.col(order)], 1).drop("place")


def daily_peaks(hours: DataFrame, key: list[str], least: int = 20) -> DataFrame:
    """Daily average and peak of hourly demand, for days with enough hours."""
    return hours.groupBy(*key, F.to_date("hour").alias("obs_date")).agg(F.avg("value").alias("average"), F.max("value").alias("peak"), F.count("value").alias("n")).filter(F.col("n") >= least).drop("n")


def daily_to_monthly(daily: DataFrame, key: list[str], missing: int = 1) -> DataFrame:
    """Monthly means of months that lack at most so many days."""
    g = daily.groupBy(*key, F.last_day("obs_date").alias("month")).agg(F.avg("value").alias("value"), F.countDistinct("obs_date").alias("n"))
    return g.filter(F.col("n") >= F.dayofmonth("month") - missing).drop("n")


def plant_daily(hours: DataFrame) -> DataFrame:
    """Hourly kWh -> daily MWh of each plant and of each fuel, in one pass over grouping sets."""
    g = hours.withColumn("obs_date", F.to_date("hour")).groupingSets([["obs_date", "plant", "fuel"], ["obs_date", "fuel"]], "obs_date", "plant", "fuel").agg((F.sum("kwh") / 1000).alias("mwh"))
    return g.select("obs_date", F.coalesce("plant", F.lit("all")).alias("plant"), "fuel", "mwh")


#: The wider kinds of cargo that a kind adds to.
CARGO_PARENTS = {"containers": ["general", "dry", "all"], "break_bulk": ["general", "dry", "all"], "bulk": ["dry", "all"], "liquid": ["all"]}


def cargo_types(rows: DataFrame, key: list[str]) -> DataFrame:
    """Tonnage of each kind of cargo and of the wider kinds it belongs to, by direction and for both together."""
    wider = F.create_map(*[x for k, v in CARGO_PARENTS.items() for x in (F.lit(k), F.array(*map(F.lit, [k, *v])))])
    e = rows.select(*key, F.explode(F.array("direction", F.lit("all"))).alias("direction"), F.col("cargo").alias("own"), "tonnes").select(*key, "direction", F.explode(F.coalesce(wider[F.col("own")], F.array("own"))).alias("cargo"), "tonnes")
    return e.groupBy(*key, "direction", "cargo").agg(F.sum("tonnes").alias("tonnes"))


def all_direction_sums(rows: DataFrame, key: list[str]) -> DataFrame:
    """Repeated lines add up; `all` is import and export together."""
    e = rows.select(*key, F.explode(F.array("direction", F.lit("all"))).alias("direction"), "value")
    return e.groupBy(*key, "direction").agg(F.sum("value").alias("value"))


def latest_allocation(portfolio: DataFrame) -> DataFrame:
    """Every row of each fund's newest snapshot, numbered by weight, the largest first."""
    last = portfolio.groupBy("fund_id").agg(F.max("as_of").alias("as_of"))
    w = Window.partitionBy("fund_id").orderBy(F.desc("weight"), "asset")
    return portfolio.join(last, ["fund_id", "as_of"], "left_semi").withColumn("place", F.row_number().over(w))


def districts_index(obs: DataFrame, indicators: list[str]) -> DataFrame:
    """(indicator, district, obs_date, value) -> one row for each district of the newest census, with the newest value of
    each indicator as a column."""
    newest = obs.agg(F.max("obs_date").alias("d"))
    alive = obs.join(F.broadcast(newest), F.col("obs_date") == F.col("d")).select("district").distinct()
    return obs.join(alive, "district", "left_semi").groupBy("district").pivot("indicator", indicators).agg(F.max_by("value", "obs_date"))


def prev_day_chain(calls: DataFrame, key: list[str], room: float = 1.0) -> DataFrame:
    """Each line against the same line of the day before: its `before` must be that day's before and last 24 hours together.
    chain: ok, broken or null where there is no line of the day before."""
    past = calls.select(*key, F.date_add("day", 1).alias("day"), (F.coalesce("before", F.lit(0.0)) + F.coalesce("last_24h", F.lit(0.0))).alias("implied"))
    j = calls.join(past, [*key, "day"], "left")
    same = F.abs(F.col("implied") - F.col("before")) <= room
    return j.withColumn("chain", F.when(F.col("implied").isNull() | F.col("before").isNull(), None).when(same, "ok").otherwise("broken"))


def webhook_matches(updated: DataFrame, hooks: DataFrame, catalog: DataFrame, latest: DataFrame) -> DataFrame:
    """Which subscriptions an update concerns, by series or by module (two equality joins, no OR), each once, with the
    newest value as payload. hooks: (hook_id, series_id, module)."""
    u = updated.select("series_id").distinct().join(catalog.select("series_id", "module"), "series_id")
    by_series = u.join(hooks.filter("series_id is not null").select("hook_id", "series_id"), "series_id").select("hook_id", "series_id")
    by_module = u.join(hooks.filter("module is not null").select("hook_id", "module"), "module").select("hook_id", "series_id")
    return by_series.unionByName(by_module).distinct().join(latest, "series_id", "left")


def seen_recently(entities: DataFrame, facts: DataFrame, key: str, today: Column, days: int = 60) -> DataFrame:
    """Entities with a fact of the last days."""
    return entities.join(facts.filter(F.col("obs_date") > F.date_sub(today, days)).select(key), key, "left_semi")


def crop_across_regions(prices: DataFrame, crops: DataFrame, crop: str, today: Column, days: int = 30) -> DataFrame:
    """The newest price of the last days at each market of every commodity that a crop key stands for."""
    own = crops.filter(F.col("crop") == crop).select("commodity").distinct()
    near = prices.filter(F.col("obs_date").between(F.date_sub(today, days), today)).join(F.broadcast(own), "commodity", "left_semi")
    return near.groupBy("commodity", "market").agg(F.max("obs_date").alias("obs_date"), F.max_by("value", "obs_date").alias("value"))


def securities_latest(securities: DataFrame, prices: DataFrame) -> DataFrame:
    """Each security with its newest price and the change from the one before."""
    w = Window.partitionBy("code").orderBy("obs_date")
    p = prices.withColumn("before", F.lag("value").over(w)).groupBy("code").agg(F.max(F.struct("obs_date", "value", "before")).alias("p"))
    return securities.join(p, "code", "left").select("code", F.col("p.obs_date").alias("obs_date"), F.col("p.value").alias("value"), (F.col("p.value") - F.col("p.before")).alias("change"))


def derived_hub(catalog: DataFrame, obs: DataFrame) -> DataFrame:
    """Every series of the catalog with its newest point; of several dimensions the last by text counts."""
    last = obs.groupBy("series_id").agg(F.max(F.struct("obs_date", "dims_key", "value")).alias("p"))
    return catalog.join(last, "series_id", "left").select("series_id", "name", F.col("p.obs_date").alias("obs_date"), F.col("p.dims_key").alias("dims_key"), F.col("p.value").alias("value"))


def partner_history(trade: DataFrame, rates: DataFrame) -> DataFrame:
    """Yearly totals of each partner by flow, in both moneys; rows are summed before the rates are joined."""
    g = trade.groupBy("country", "flow", "fy").agg(F.sum("value").alias("value"))
    return g.join(rates, "fy", "left").select("country", "flow", "fy", "value", (F.col("value") / F.col("rate")).alias("value_fx"))


def rank_and_share(trade: DataFrame) -> DataFrame:
    """Each partner's place among all by flow, its share and how many are ranked. The windows run over one row a partner."""
    g = trade.groupBy("flow", "country").agg(F.sum("value").alias("value"))
    w = Window.partitionBy("flow")
    return g.select("flow", "country", "value", F.row_number().over(w.orderBy(F.desc("value"), "country")).alias("place"), F.count(F.lit(1)).over(w).alias("ranked"), (F.col("value") / F.sum("value").over(w) * 100).alias("share_pct"))
