"""The read path: windows of observations, catalog pages, filters by code, place and date, and ranked search."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.operators import series
from ledgerline.operators.facts import nearest_prior

#: The frequencies that a yearly and a monthly change make sense for.
YOY_FREQUENCIES = ["daily", "weekly", "monthly", "quarterly"]
MOM_FREQUENCIES = ["monthly"]
#: Days before the window's start that a transform looks at, and days of one period by frequency (a change
#: against the point before takes one, a mean of three takes three).
LOOKBACK_DAYS = {"yoy": 400, "mom": 40, "index": 0}
LOOKBACK_PERIODS = {"pct_change": 1, "3ma": 3}
PERIOD_DAYS = {"daily": 10, "weekly": 21, "fortnightly": 21, "monthly": 45, "quarterly": 120, "half-yearly": 200, "semiannual": 200, "annual": 400}
LONGEST_PERIOD = 400


def dim(dims_key: str | Column, name: str) -> Column:
    """One dimension of a canonical JSON key, null if absent."""
    return F.get_json_object(dims_key, f"$.{name}")


def having_dims(df: DataFrame, wanted: dict[str, str] | None = None, present: list[str] = (), absent: list[str] = ()) -> DataFrame:
    """Rows whose dimensions hold every wanted pair, have the keys of `present` and lack those of `absent`."""
    tests = [dim("dims_key", k) == v for k, v in (wanted or {}).items()]
    tests += [dim("dims_key", k).isNotNull() for k in present] + [dim("dims_key", k).isNull() for k in absent]
    return reduce(DataFrame.filter, tests, df)


def observations_window(obs: DataFrame, series_id: str, start: str | None = None, end: str | None = None, dims: dict[str, str] | None = None, limit: int | None = None, newest_first: bool = False) -> DataFrame:
    """One series' points between two dates (both included) whose dimensions hold every wanted pair, ordered and limited."""
    out = having_dims(obs.filter(F.col("series_id") == series_id), dims)
    out = out.filter(F.col("obs_date") >= F.lit(start).cast("date")) if start else out
    out = out.filter(F.col("obs_date") <= F.lit(end).cast("date")) if end else out
    out = out.orderBy(F.desc("obs_date") if newest_first else "obs_date", "dims_key")
    return out if limit is None else out.limit(limit)


def catalog_filter(catalog: DataFrame, module: str | None = None, source: str | None = None, q: str | None = None, canonical_only: bool = False) -> DataFrame:
    """Active series by module, source and text in id, name or description (any case); count() and pages are the caller's."""
    out = catalog.filter("is_active")
    for column, value in (("module", module), ("source", source)):
        out = out.filter(F.col(column) == value) if value else out
    if q:
        text = q.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")
        out = out.filter(reduce(Column.__or__, [F.col(c).ilike(f"%{text}%") for c in ("series_id", "name", "description")]))
    return out.filter(F.col("canonical_id").isNull()) if canonical_only else out


def ordered_page(df: DataFrame, keys: list[Column | str], limit: int, offset: int = 0) -> DataFrame:
    """A page of a stable order."""
    return df.orderBy(*keys).offset(offset).limit(limit)


def top_n(df: DataFrame, by: str, n: int, tie: str) -> DataFrame:
    """The n largest, nulls last; one TakeOrdered, no full sort."""
    return df.orderBy(F.desc_nulls_last(by), tie).limit(n)


def notes_for(points: DataFrame, notes: DataFrame) -> DataFrame:
    """Points with the public note on them, null without one."""
    key = ["series_id", "obs_date", "dims_key"]
    return points.join(notes.select(*key, "note"), key, "left")


def history_floor(df: DataFrame, years: int, today: Column) -> DataFrame:
    """Only the last so many calendar years (29 February counts as the 28th)."""
    return df.filter(F.col("obs_date") >= F.add_months(today, -12 * years))


def code_filter(df: DataFrame, code: str) -> DataFrame:
    """Rows of one code, or of all codes under `prefix*`."""
    c = code.strip().upper()
    return df.filter(F.col("code").startswith(c[:-1]) if c.endswith("*") else F.col("code") == c)


def heading_filter(df: DataFrame, heading: str) -> DataFrame:
    """The 8-digit codes of a four-digit heading, as a range that a scan can prune by."""
    return df.filter(F.col("code").between(heading, heading + "9999") & (F.length("code") == 8) & (F.substring("code", 1, 4) == heading))


def pct_filter(df: DataFrame, code: str) -> DataFrame:
    """An 8-digit tariff code, dotted or not, or a prefix of 2, 4 or 6 digits as a range."""
    c = "".join(x for x in code if x not in ". *\t")
    if not c.isdigit() or len(c) not in (2, 4, 6, 8):
        raise ValueError("code must be an 8-digit code or a 2-, 4- or 6-digit prefix")
    return df.filter(F.col("code") == c if len(c) == 8 else F.col("code").between(c.ljust(8, "0"), c.ljust(8, "9")))


def canonical_countries(asked: DataFrame, trade: DataFrame) -> DataFrame:
    """(asked) -> (asked, country): the stored spelling of a partner matched in any case, or what was asked."""
    known = trade.groupBy(F.lower("country").alias("low")).agg(F.min("country").alias("known"))
    return asked.withColumn("low", F.lower(F.trim("asked"))).join(known, "low", "left").select("asked", F.coalesce("known", F.trim("asked")).alias("country"))


def listing(df: DataFrame, equal: dict[str, str], day: str, start: str | None, end: str | None, order: list[Column], limit: int) -> DataFrame:
    """A filtered, ordered listing of a fact table: equalities, a range of days, an order and a limit."""
    tests = [F.col(k) == v for k, v in equal.items() if v is not None]
    tests += [F.col(day) >= F.lit(start).cast("date")] if start else []
    tests += [F.col(day) <= F.lit(end).cast("date")] if end else []
    return reduce(DataFrame.filter, tests, df).orderBy(*order).limit(limit)


def snapshot(calls: DataFrame, day: str | None = None) -> DataFrame:
    """Each port's rows of one statement day, by default of its newest."""
    if day:
        return calls.filter(F.col("day") == F.lit(day).cast("date"))
    return calls.join(calls.groupBy("port").agg(F.max("day").alias("day")), ["port", "day"], "left_semi")


def products_search(codes: DataFrame, q: str) -> DataFrame:
    """Product codes that begin with the query, or whose names together hold every word of it."""
    text = q.strip().lower()
    names = F.lower(F.concat_ws(" ", "name", "short_name", "heading", "description"))
    words = reduce(Column.__and__, [F.contains(names, F.lit(w)) for w in text.split()], F.lit(True))
    return codes.filter(F.col("code").startswith(text.replace(".", "")) | words)


def future_rows(tables: dict[str, DataFrame], today: Column, days: int = 3) -> DataFrame:
    """How many rows of each table are dated more than so many days ahead: name -> rows with obs_date."""
    late = [df.filter(F.col("obs_date") > F.date_add(today, days)).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, late)


def in_force(values: DataFrame, rulings: DataFrame, on: Column | None = None, excluded: tuple[str, ...] = ("withdrawal", "classification")) -> DataFrame:
    """Values of rulings that no later ruling has superseded, or that were valid on a date; some kinds set no values."""
    ok = rulings.filter(~F.col("kind").isin(*excluded))
    if on is None:
        ok = ok.filter("superseded_on is null")
    else:
        ok = ok.filter((F.col("issued_on") <= on) & (F.col("superseded_on").isNull() | (F.col("superseded_on") > on)))
    return values.join(ok.select("ruling_id", "kind", "issued_on", "superseded_on"), "ruling_id")


def calendar_window(calendar: DataFrame, catalog: DataFrame, start: Column, end: Column, module: str | None, limit: int) -> DataFrame:
    """Releases between two dates with their series' names, soonest first."""
    out = calendar.filter(F.col("release_date").between(start, end)).join(catalog.select("series_id", "name", "module"), "series_id", "left")
    return (out.filter(F.col("module") == module) if module else out).orderBy("release_date", "series_id").limit(limit)


def resolve_entity(entities: DataFrame, asked: DataFrame, renamed: DataFrame | None = None) -> DataFrame:
    """(asked) -> the entity meant: by slug (a renamed slug counts), then id, name and display name in any case. Four
    equality joins, and of several hits the best by kind, then the home one, then the smallest id."""
    text = asked.withColumn("low", F.lower(F.trim("asked")))
    if renamed is not None:
        text = text.join(renamed.select(F.col("old_slug").alias("low"), "slug"), "low", "left").withColumn("low", F.coalesce("slug", "low")).drop("slug")
    hits = []
    for place, column in enumerate(("slug", "entity_id", "name", "display_name")):
        keyed = entities.withColumn("low", F.lower(F.col(column).cast("string")))
        hits.append(text.join(keyed, "low").select("asked", "entity_id", "slug", F.col("name"), "is_home", F.lit(place).alias("place")))
    best = Window.partitionBy("asked").orderBy("place", F.desc("is_home"), "entity_id")
    return reduce(DataFrame.unionByName, hits).withColumn("rn", F.row_number().over(best)).filter("rn = 1").select("asked", "entity_id", "slug", "place")


def check_transform(kind: str, frequency: str) -> None:
    """Raise for a transform that does not fit the series' frequency."""
    if kind not in LOOKBACK_DAYS and kind not in LOOKBACK_PERIODS:
        raise ValueError(f"unknown transform {kind}")
    fits = {"yoy": YOY_FREQUENCIES, "mom": MOM_FREQUENCIES}.get(kind)
    if fits and frequency.lower() not in fits:
        raise ValueError(f"{kind} does not fit a series of frequency {frequency}")


def transformed_unit(kind: str, unit: Column) -> Column:
    return F.lit("percent") if kind in ("yoy", "mom", "pct_change") else F.lit("index") if kind == "index" else unit


def yoy_daily(obs: DataFrame, tolerance: int = 7) -> DataFrame:
    """Percent against the same day a year before, or against the last row within so many days before that day."""
    asked = obs.select(*series.KEY, "obs_date", "value", F.add_months("obs_date", -12).alias("target"))
    base = nearest_prior(obs, asked.select(*series.KEY, "target").distinct(), series.KEY, tolerance).select(*series.KEY, "target", F.col("value").alias("base"))
    out = asked.join(base, [*series.KEY, "target"], "left")
    return out.select(*series.KEY, "obs_date", "value", F.when(F.col("base") != 0, (F.col("value") / F.col("base") - 1) * 100).alias("result"))


def look_back(kind: str, frequency: str) -> int:
    """Days before a window that a transform reads."""
    if kind in LOOKBACK_DAYS:
        return LOOKBACK_DAYS[kind]
    return LOOKBACK_PERIODS[kind] * PERIOD_DAYS.get(frequency.lower(), LONGEST_PERIOD)


def transform(obs: DataFrame, kind: str, frequency: str, start: str | None = None) -> DataFrame:
    """Apply a transform from `start` on: what it needs before that date is read, used and cut away again, so that the first
    points are not null for want of a past. An index is rebased to the first value of the window itself. A monthly series dated on
    month ends is compared month by month (see against_month)."""
    check_transform(kind, frequency)
    first = F.lit(start).cast("date") if start else None
    read = obs.filter(F.col("obs_date") >= F.date_sub(first, look_back(kind, frequency))) if start else obs
    if kind == "yoy" and frequency.lower() == "daily":
        done = yoy_daily(read)
    else:
        ends = frequency.lower() == "monthly"
        done = {"yoy": lambda o: series.against_month(o, 12, ends), "mom": lambda o: series.against_month(o, 1, ends), "pct_change": series.pct_change, "3ma": series.ma3, "index": series.index_100}[kind](read)
    return done.filter(F.col("obs_date") >= first) if start else done


def ranked_search(catalog: DataFrame, q: str, limit: int = 20) -> DataFrame:
    """Active series whose id, name or description holds every word (six at most), in tiers: the id itself, start of the id,
    start of the name, within the name, else; short ids first."""
    text = q.strip().lower()
    out = catalog.filter("is_active")
    for w in text.split()[:6]:
        out = out.filter(reduce(Column.__or__, [F.coalesce(F.contains(F.lower(c), F.lit(w)), F.lit(False)) for c in ("series_id", "name", "description")]))
    i, n = F.lower("series_id"), F.lower("name")
    tier = F.when(i == text, 0).when(i.startswith(text), 1).when(n.startswith(text), 2).when(F.contains(n, F.lit(text)), 3).otherwise(4)
    return out.withColumn("tier", tier).orderBy("tier", F.length("series_id"), "name", "series_id").limit(limit)


def build_entities(kinds: dict[str, DataFrame]) -> DataFrame:
    """One row for each findable thing, from tables (key, title, subtitle, url, worth, words): boost is log10(1 + worth) and
    haystack all that may be searched, in lower case."""
    parts = [
        df.select(F.lit(kind).alias("kind"), F.col("key").cast("string").alias("key"), "title", "subtitle", "url", F.log10(1 + F.greatest(F.coalesce("worth", F.lit(0.0)), F.lit(0.0))).alias("boost"), F.lower(F.concat_ws(" ", "title", "subtitle", "words")).alias("haystack"))
        for kind, df in kinds.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def trigrams(text: Column) -> Column:
    """The distinct trigrams of a text's words, each word with two spaces before and one behind it."""
    words = F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda w: w != "")
    return F.array_distinct(F.flatten(F.transform(words, lambda w: F.transform(F.sequence(F.lit(1), F.length(w) + 1), lambda i: F.substring(F.concat(F.lit("  "), w, F.lit(" ")), i, F.lit(3))))))


def fuzzy_search(entities: DataFrame, queries: DataFrame, least: float = 0.5) -> DataFrame:
    """(asked) against (kind, key, title): entities that share at least `least` of a query's trigrams, with that share as score.

    An entity that holds ceil(least * n) of a query's n trigrams holds one of any n - ceil(least * n) + 1 of them, so only so
    many are looked up in the inverted index, the rarest ones; what they meet is then compared in full. A trigram that most
    titles have is looked up for a query only if the query has hardly any other. Different titles are compared, and found
    ones brought to their entities last."""
    asked = queries.select("asked", trigrams(F.col("asked")).alias("g")).filter(F.size("g") > 0).dropDuplicates(["asked"])
    index = entities.select("title").distinct().select("title", F.explode(trigrams(F.col("title"))).alias("t"))
    often = index.groupBy("t").agg(F.count(F.lit(1)).alias("often"))
    pieces = asked.select("asked", "g", F.explode("g").alias("t")).join(often, "t", "left")
    rarest = F.array_sort(F.collect_list(F.struct(F.coalesce("often", F.lit(0)).alias("often"), "t")))
    few = F.size("r") - F.ceil(least * F.size("r") - 1e-9).cast("int") + 1
    looked = pieces.groupBy("asked", "g").agg(rarest.alias("r")).select("asked", "g", F.explode(F.slice("r", F.lit(1), few)).alias("x")).filter("x.often > 0")
    met = looked.select("asked", "g", F.col("x.t").alias("t")).join(index, "t").select("asked", "g", "title").distinct()
    shared = F.size(F.array_intersect("g", trigrams(F.col("title"))))
    found = met.withColumn("score", shared / F.size("g")).filter(F.col("score") >= least).select("asked", "title", "score")
    return found.join(entities.select("kind", "key", "title"), "title").select("asked", "kind", "key", "title", "score")
