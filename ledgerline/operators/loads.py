"""Loads beyond the plain merge: ids, editions, entities, backfills, unit scales and published table layouts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.operators.facts import top_n_per_group


def canonicalize_ids(df: DataFrame, rules: dict[str, str], column: str = "series_id") -> DataFrame:
    """Legacy id prefixes renamed; the first rule whose prefix fits counts."""
    out = F.col(column)
    for old, new in reversed(rules.items()):
        out = F.when(F.col(column).startswith(old), F.concat(F.lit(new), F.substring(F.col(column), len(old) + 1, 1_000_000))).otherwise(out)
    return df.withColumn(column, out)


def all_rejected_guard(judged: DataFrame) -> DataFrame:
    """The rows of validate(), or an error if there are some and none was accepted. Looks for one accepted row only."""
    if judged.filter("reason is null").isEmpty() and not judged.isEmpty():
        raise ValueError("every record was rejected")
    return judged


def merge_known(stored: DataFrame, incoming: DataFrame, keys: list[str], cols: list[str], owners: DataFrame, owner: str, seq: str) -> DataFrame:
    """Merge in which a null never erases a stored value: incoming rows of unknown owners are left out, of repeated keys the
    last by seq counts."""
    known = incoming.join(owners.select(owner).distinct(), owner, "left_semi")
    last = top_n_per_group(known, keys, [F.desc(seq)], 1).select(*keys, *cols)
    old = stored.select(*keys, *[F.col(c).alias(f"old_{c}") for c in cols])
    return old.join(last, keys, "full_outer").select(*keys, *[F.coalesce(c, f"old_{c}").alias(c) for c in cols])


def changed_editions(stored: DataFrame, incoming: DataFrame, edition: str) -> DataFrame:
    """Editions of which a row was added or removed, by counts of equal rows: what has to be written again."""
    both = stored.withColumn("side", F.lit(1)).unionByName(incoming.withColumn("side", F.lit(-1)))
    off = both.groupBy(*stored.columns).agg(F.sum("side").alias("balance")).filter("balance <> 0")
    return off.join(incoming.select(edition).distinct(), edition, "left_semi").groupBy(edition).agg(F.sum(F.abs("balance")).alias("n_changed"))


def replace_edition(stored: DataFrame, incoming: DataFrame, edition: str) -> DataFrame:
    """Editions that differ are replaced as a whole, equal ones are left as they stand."""
    changed = changed_editions(stored, incoming, edition).select(edition)
    return stored.join(changed, edition, "left_anti").unionByName(incoming.join(changed, edition, "left_semi"))


def replace_derived(stored: DataFrame, computed: DataFrame, owned: list[str]) -> DataFrame:
    """Derived series become what was computed: points that the formula no longer yields go, other series stay."""
    return stored.filter(~F.col("series_id").isin(*owned)).unionByName(computed.filter(F.col("series_id").isin(*owned)))


def upsert_entities(stored: DataFrame, incoming: DataFrame, key: str, texts: list[str]) -> DataFrame:
    """Entities: new texts where there are any, the earliest first_seen, the latest last_seen."""
    new = incoming.groupBy(key).agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.struct("last_seen", c))).alias(c) for c in texts], F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"))
    cols = [*texts, "first_seen", "last_seen"]
    j = stored.select(key, *[F.col(c).alias(f"old_{c}") for c in cols]).join(new, key, "full_outer")
    return j.select(key, *[F.coalesce(c, f"old_{c}").alias(c) for c in texts], F.least("first_seen", "old_first_seen").alias("first_seen"), F.greatest("last_seen", "old_last_seen").alias("last_seen"))


def drop_repeats(df: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """One row of each natural key; rows with a null in their key are never equal to another and all stay."""
    whole = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
    return top_n_per_group(df.filter(whole), keys, [order], 1).drop("place").unionByName(df.filter(~whole))


def rekey_and_merge(obs: DataFrame, mapping: DataFrame) -> DataFrame:
    """(series_id, dims_key, obs_date, value, first_seen) under new keys (dims_key -> new_key): points that meet are one, with
    the value seen first, and `conflicts` counts the different values among them."""
    moved = obs.join(mapping, "dims_key", "left").withColumn("dims_key", F.coalesce("new_key", "dims_key"))
    return moved.groupBy("series_id", "dims_key", "obs_date").agg(F.min_by("value", F.struct("first_seen", "value")).alias("value"), F.min("first_seen").alias("first_seen"), F.countDistinct("value").alias("conflicts"))


def gate_allocations(rows: DataFrame, amounts: list[str], line_most: float = 150, low: float = 90, high: float = 112) -> DataFrame:
    """Wide amounts of each fund -> percent of their total, long. Lines beyond line_most percent go; a fund stays only if its
    lines then sum to 90 to 112 percent."""
    long = rows.unpivot(["fund_id", "total"], amounts, "kind", "amount").filter("amount is not null and total <> 0")
    pct = long.withColumn("pct", F.col("amount") / F.col("total") * 100).filter(F.abs("pct") <= line_most)
    fit = pct.groupBy("fund_id").agg(F.sum("pct").alias("whole")).filter(F.col("whole").between(low, high)).select("fund_id")
    return pct.join(fit, "fund_id", "left_semi").select("fund_id", "kind", "pct")


def cap_expense(df: DataFrame, column: str, cap: float, others: list[str]) -> DataFrame:
    """A ratio beyond the cap is no ratio; a row without any measure other than zero goes."""
    out = df.withColumn(column, F.when(F.col(column) <= cap, F.col(column)))
    return out.filter(reduce(Column.__or__, [F.coalesce(F.col(c), F.lit(0.0)) != 0 for c in [column, *others]]))


def merge_catalog(existing: DataFrame, found: DataFrame) -> DataFrame:
    """Catalog rows (source_key, series_id): what exists wins by source key. Of new rows with one id the first by source key
    keeps it if it is free; the others get the first free of _2, _3 ... behind it, in the order of their source keys. Ids
    are unique: a number is free if neither an existing row nor a new one that keeps its id has it.

    The r-th free number of an id is r + 1 plus how many taken numbers stand below it: taken numbers and rows that ask are
    sorted together once, by how many free numbers come before them."""
    kept = existing.select("source_key", "series_id")
    new = found.select("source_key", "series_id").join(kept.select("source_key"), "source_key", "left_anti").groupBy("source_key").agg(F.min("series_id").alias("series_id"))
    w = Window.partitionBy("series_id").orderBy("source_key")
    placed = new.withColumn("place", F.row_number().over(w)).join(kept.select("series_id", F.lit(1).alias("used")).distinct(), "series_id", "left")
    ask = F.col("place") - F.when(F.col("used").isNull(), 1).otherwise(0)  # 0: the id itself
    placed = placed.withColumn("ask", ask.cast("long"))
    own = placed.filter("ask = 0").select("source_key", "series_id")
    number = F.regexp_extract("series_id", r"_([1-9]\d*)$", 1).try_cast("long")
    taken = kept.unionByName(own).select(F.regexp_replace("series_id", r"_\d+$", "").alias("series_id"), number.alias("number")).filter("number >= 2").distinct()
    before = F.col("number") - 1 - F.row_number().over(Window.partitionBy("series_id").orderBy("number"))
    both = taken.withColumn("at", before).select("series_id", "at", F.lit(1).alias("is_taken"), F.lit(None).cast("string").alias("source_key"))
    both = both.unionByName(placed.filter("ask > 0").select("series_id", F.col("ask").alias("at"), F.lit(0).alias("is_taken"), "source_key"))
    below = F.coalesce(F.sum("is_taken").over(Window.partitionBy("series_id").orderBy("at", "is_taken").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    named = both.withColumn("n", F.col("at") + 1 + below).filter("is_taken = 0").select("source_key", F.concat_ws("_", "series_id", F.col("n").cast("string")).alias("series_id"))
    return kept.unionByName(own).unionByName(named)


def select_backfill(catalog: DataFrame, obs: DataFrame, grace: dict[str, int], today: Column, limit: int) -> DataFrame:
    """Series to fetch next: those without data first, then the ones older than their frequency's grace, oldest first."""
    last = obs.groupBy("series_id").agg(F.max("obs_date").alias("last_date"))
    days = F.coalesce(*[F.when(F.col("frequency") == k, v) for k, v in grace.items()], F.lit(0))
    j = catalog.filter("is_active").select("series_id", "frequency").join(last, "series_id", "left")
    due = j.filter(F.col("last_date").isNull() | (F.datediff(today, "last_date") > days))
    return due.orderBy(F.asc_nulls_first("last_date"), "series_id").limit(limit)


def apply_unit_scale(catalog: DataFrame, scales: DataFrame, bare: list[str]) -> DataFrame:
    """Bare currency units replaced by the scale verified for the series (series_id, scale), as in `pkr` -> `pkr_mn`."""
    j = catalog.join(scales, "series_id", "left")
    unit = F.when(F.col("unit").isin(*bare) & F.col("scale").isNotNull(), F.concat_ws("_", "unit", "scale")).otherwise(F.col("unit"))
    return j.withColumn("unit", unit).drop("scale")


def rescale_splices(obs: DataFrame, splices: DataFrame, rel: float = 1e-9) -> DataFrame:
    """Listed points (key, listed, factor) multiplied, but only while they still hold the listed value."""
    key = ["series_id", "dims_key", "obs_date"]
    j = obs.join(splices, key, "left")
    still = F.abs(F.col("value") - F.col("listed")) <= rel * F.abs("listed")
    return j.select(*key, F.when(still, F.col("value") * F.col("factor")).otherwise(F.col("value")).alias("value"), F.coalesce(still, F.lit(False)).alias("rescaled"))


def parent_labels(rows: DataFrame, sheet: str, order: str) -> DataFrame:
    """Rows of a printed table in order -> their full labels. A row of kind `group` sets the group, `parent` the parent of
    the `child` rows that follow; nothing counts from the sheet's `stop` row on."""
    w = Window.partitionBy(sheet).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    kind, label = F.col("kind"), F.col("label")
    out = rows.withColumn("stopped", F.max(F.when(kind == "stop", 1).otherwise(0)).over(w))
    out = out.withColumn("grp", F.last(F.when(kind == "group", label), ignorenulls=True).over(w))
    out = out.withColumn("parent", F.last(F.when(kind.isin("parent", "group"), F.when(kind == "parent", label).otherwise("")), ignorenulls=True).over(w))
    full = F.when((kind == "child") & (F.col("parent") != ""), F.concat_ws(" / ", "parent", "label")).otherwise(label)
    return out.filter((F.col("stopped") == 0) & kind.isin("parent", "child", "item")).select(sheet, order, "grp", full.alias("label"))


def unpivot_two_periods(rows: DataFrame, key: list[str], current: str, prior: str, day: str, months: int = 1) -> DataFrame:
    """A sheet with this period and the one before side by side -> points dated at their month ends."""
    pairs = F.array(F.struct(F.last_day(day).alias("obs_date"), F.col(current).alias("value")), F.struct(F.last_day(F.add_months(day, -months)).alias("obs_date"), F.col(prior).alias("value")))
    return rows.select(*key, F.explode(pairs).alias("p")).select(*key, "p.obs_date", "p.value").filter("value is not null")


def unpivot_fiscal_months(rows: DataFrame, key: list[str], months: list[str], fy: str, order: str, base: str | None = None) -> DataFrame:
    """Twelve columns from July to June -> month-end points; with `base` only rows of that base year; of repeated points the
    first by order counts."""
    rows = rows.filter(F.col("base") == base) if base else rows
    first = F.make_date(F.col(fy) - 1, F.lit(7), F.lit(1))
    long = rows.select(*key, fy, order, F.posexplode(F.array(*months)).alias("m", "value")).filter("value is not null")
    long = long.withColumn("obs_date", F.last_day(F.add_months(first, F.col("m"))))
    return top_n_per_group(long, [*key, "obs_date"], [F.col(order)], 1).select(*key, "obs_date", "value")


def measures_to_long(rows: DataFrame, site: str, day: str, measures: dict[str, float]) -> DataFrame:
    """One wide bulletin row for each site -> a point for each measure, in its unit (measure -> factor), with dimensions."""
    points = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), (F.col(m) * f).alias("value")) for m, f in measures.items()]))
    long = rows.select(F.col(site).alias("site"), F.col(day).alias("obs_date"), points.alias("p")).select("site", "obs_date", "p.measure", "p.value").filter("value is not null")
    return long.select("obs_date", "value", F.to_json(F.struct("measure", "site")).alias("dims_key"))


def rename_to_latest(rows: DataFrame, key: str, name: str, year: str) -> DataFrame:
    """Entities that were renamed over the years take their newest name in all years."""
    newest = rows.groupBy(key).agg(F.max_by(name, F.struct(year, name)).alias("newest"))
    return rows.join(newest, key).withColumn(name, F.col("newest")).drop("newest")


def archive_days(log: DataFrame, rollups: DataFrame, cutoff: Column) -> tuple[DataFrame, DataFrame]:
    """(rows to export, days to drop): whole days before the cutoff; a day may be dropped only once its roll-up exists."""
    old = log.filter(F.col("day") < cutoff)
    return old, old.select("day").distinct().join(rollups.select("day").distinct(), "day", "left_semi")


def download_table(obs: DataFrame, series_id: str, dims: list[str]) -> DataFrame:
    """A series as a wide file: date, one column for each dimension, value."""
    one = obs.filter(F.col("series_id") == series_id)
    return one.select("obs_date", *[F.get_json_object("dims_key", f"$.{d}").alias(d) for d in dims], "value")


def flatten_for_csv(df: DataFrame) -> DataFrame:
    """Nested structs as dotted columns, arrays and maps as JSON, and texts that a spreadsheet would run as formulas behind
    an apostrophe (numbers are left alone)."""
    cols: list[Column] = []

    def walk(fields, path: list[str]):
        for f in fields:
            here = [*path, f.name]
            c = reduce(lambda a, n: a.getField(n), here[1:], F.col(f"`{here[0]}`"))
            kind = f.dataType.typeName()
            if kind == "struct":
                walk(f.dataType.fields, here)
            elif kind in ("array", "map"):
                cols.append(F.to_json(c).alias(".".join(here)))
            elif kind == "string":
                risky = c.rlike(r"^[=+\-@\t\r]") & c.try_cast("double").isNull()
                cols.append(F.when(risky, F.concat(F.lit("'"), c)).otherwise(c).alias(".".join(here)))
            else:
                cols.append(c.alias(".".join(here)))

    walk(df.schema.fields, [])
    return df.select(*cols)
