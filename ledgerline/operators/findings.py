"""Findings of the detectors, their verdicts against the sources, and what is then changed, noted or set aside."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.operators import merge, quality, series

POINT = merge.POINT


def twin_mismatch(obs: DataFrame, catalog: DataFrame, gap: float = 0.005) -> DataFrame:
    """Points of a series that differ from its canonical twin's by more than half a percent; twins share frequency and unit."""
    c = catalog.select("series_id", "canonical_id", "frequency", "unit", "is_active")
    pairs = c.filter("is_active").join(c.select(F.col("series_id").alias("canonical_id"), "frequency", F.col("unit").alias("twin_unit")), ["canonical_id", "frequency"]).filter(F.col("unit").eqNullSafe(F.col("twin_unit")))
    own = obs.filter("value is not null").join(pairs.select("series_id", "canonical_id"), "series_id")
    twin = obs.filter("value is not null").select(F.col("series_id").alias("canonical_id"), "dims_key", "obs_date", F.col("value").alias("twin_value"))
    j = own.join(twin, ["canonical_id", "dims_key", "obs_date"])
    return j.filter(F.abs(F.col("value") - F.col("twin_value")) > gap * F.greatest(F.abs("value"), F.abs("twin_value")))


def run_detectors(obs: DataFrame, catalog: DataFrame, only: list[str] | None = None) -> DataFrame:
    """All detectors over one table of neighbours: (series_id, dims_key, obs_date, value, pv, nv, detector, tier). Curated
    series are of tier 1, those of a bulk source (dataset not null) of tier 3."""
    live = catalog.filter("is_active")
    near = series.neighbours(obs.filter("value is not null").join(live.select("series_id"), "series_id", "left_semi"))
    detectors = {
        "spike_level": lambda: series.spike_level(near, live),
        "spike_rate": lambda: series.spike_rate(near, live),
        "sign_flip": lambda: quality.sign_flip(near),
        "scale_slip": lambda: series.scale_slips(near, live),
        "out_of_range": lambda: quality.out_of_range(near, live),
    }
    cols = ["series_id", "dims_key", "obs_date", "value", "pv", "nv"]
    parts = [f().select(*cols, F.lit(name).alias("detector")) for name, f in detectors.items() if only is None or name in only]
    tier = live.select("series_id", F.when(F.col("dataset").isNull(), 1).otherwise(3).alias("tier"))
    return reduce(DataFrame.unionByName, parts).join(tier, "series_id")


def fix_scale(obs: DataFrame, slips: DataFrame, now: Column) -> tuple[DataFrame, DataFrame]:
    """(observations with slipped values divided by their factor, log of old and new values)."""
    j = obs.join(slips.select(*POINT, "factor"), POINT, "left")
    fixed = j.withColumn("value", F.coalesce(F.col("value") / F.col("factor"), F.col("value")))
    log = slips.select(*POINT, F.col("value").alias("old_value"), (F.col("value") / F.col("factor")).alias("new_value"), "factor", now.alias("corrected_at"))
    return fixed.drop("factor"), log


def range_gate(df: DataFrame, column: str, low: float, high: float, reason: str, kinds: Column) -> tuple[DataFrame, DataFrame]:
    """(kept, set aside with the reason): values out of bounds among the rows of the given kinds."""
    bad = F.coalesce(kinds & ((F.col(column) < low) | (F.col(column) > high)), F.lit(False))
    return df.filter(~bad), df.filter(bad).withColumn("reason", F.lit(reason))


def verdicts(findings: DataFrame, compared: DataFrame, rel: float = 1e-6) -> DataFrame:
    """Findings with what their source says: confirmed (the source has our value), scale_corrected (it has a power of 1000 of
    it), differs, or not_in_source. compared: points of compare_points."""
    src = compared.select(*POINT, "theirs")
    j = findings.join(src, POINT, "left")
    same = F.abs(F.col("value") - F.col("theirs")) <= rel * F.greatest(F.abs("value"), F.abs("theirs"))
    ratio = F.abs(F.col("theirs") / F.nullif(F.col("value"), F.lit(0.0)))
    power = F.round(F.log(ratio) / F.log(F.lit(1000.0)))
    slip = (power != 0) & (F.abs(ratio / F.pow(F.lit(1000.0), power) - 1) < 0.001)
    return j.withColumn("verdict", F.when(F.col("theirs").isNull(), "not_in_source").when(same, "confirmed").when(slip, "scale_corrected").otherwise("differs"))


def compare_partial(ours: DataFrame, source: DataFrame, key: list[str]) -> DataFrame:
    """Comparison limited to the dates that the source's files cover, between their first and last by key."""
    series_key = [k for k in key if k != "obs_date"]
    span = source.groupBy(*series_key).agg(F.min("obs_date").alias("first"), F.max("obs_date").alias("last"))
    covered = ours.join(span, series_key).filter(F.col("obs_date").between(F.col("first"), F.col("last")))
    return merge.compare_points(covered.select(ours.columns), source, key)


def reconcile_with_quarantine(ours: DataFrame, source: DataFrame, quarantine: DataFrame, key: list[str]) -> DataFrame:
    """Comparison in which what we set aside counts as `quarantined`, not missing, and points after the source's last date
    are not expected of it."""
    entity = [k for k in key if k != "obs_date"]
    end = source.groupBy(*entity).agg(F.max("obs_date").alias("end"))
    c = merge.compare_points(ours, source, key).join(quarantine.select(*key).distinct().withColumn("aside", F.lit(True)), key, "left").join(end, entity, "left")
    kind = F.when((F.col("kind") == "missing_ours") & F.col("aside"), "quarantined").otherwise(F.col("kind"))
    return c.withColumn("kind", kind).filter(~((F.col("kind") == "missing_source") & (F.col("obs_date") > F.coalesce("end", F.lit("0001-01-01").cast("date"))))).drop("aside", "end")


def decimals(text: Column) -> Column:
    """Digits printed behind the decimal point."""
    return F.when(F.contains(text, F.lit(".")), F.length(F.substring_index(text, ".", -1))).otherwise(0)


def rounds_to(ours: Column, printed: Column) -> Column:
    """Whether our value, rounded as the source prints it, is the printed figure (printed: its text)."""
    dp = decimals(printed)
    return F.abs(ours - printed.cast("double")) <= 0.5 * F.pow(F.lit(10.0), -dp) + 1e-9


def apply_source(ours: DataFrame, source: DataFrame, quarantine: DataFrame, trusted: DataFrame, entity: str) -> DataFrame:
    """What to do with each point of the entities whose source may be trusted: update, insert or delete; points that differ
    by the source's rounding, that were set aside, that are not positive, or that lie after its end are left alone. source
    carries `printed`, the value's text."""
    key = [entity, "obs_date"]
    a = ours.join(trusted.select(entity), entity, "left_semi").select(*key, F.col("value").alias("ours"), F.lit(True).alias("in_ours"))
    b = source.join(trusted.select(entity), entity, "left_semi").select(*key, F.col("value").alias("theirs"), "printed", F.lit(True).alias("in_source"))
    end = source.groupBy(entity).agg(F.max("obs_date").alias("end"))
    j = a.join(b, key, "full_outer").join(quarantine.select(*key).distinct().withColumn("aside", F.lit(True)), key, "left").join(end, entity, "left")
    same = rounds_to(F.col("ours"), F.col("printed"))
    action = (
        F.when(F.col("in_ours").isNull() & (F.col("theirs") > 0) & F.col("aside").isNull(), "insert")
        .when(F.col("in_source").isNull() & (F.col("obs_date") < F.col("end")), "delete")
        .when(F.col("in_ours") & F.col("in_source") & ~same, "update")
    )
    return j.withColumn("action", action).filter("action is not null").select(*key, "action", "ours", "theirs")


def two_figures(x: Column) -> Column:
    """A positive number to two significant figures, with thousands separated from 100 on."""
    r = F.round(x / F.pow(F.lit(10.0), F.floor(F.log10(x)) - 1)) * F.pow(F.lit(10.0), F.floor(F.log10(x)) - 1)
    return F.when(r >= 100, F.format_number(r, 0)).otherwise(F.regexp_replace(F.format_number(r, 1), r"\.0$", ""))


def exact_slip(value: Column, pv: Column, nv: Column) -> Column:
    """Whether dividing or multiplying by a power of 1000 puts a value between its neighbours."""
    lo, hi = F.least(F.abs(pv), F.abs(nv)) * 0.8, F.greatest(F.abs(pv), F.abs(nv)) * 1.25
    powers = F.array(*[F.lit(p) for k in (1, 2, 3) for p in (1000.0**k, 1000.0**-k)])
    return F.coalesce((value != 0) & nv.isNotNull() & F.exists(powers, lambda p: (F.abs(value) * p).between(lo, hi)), F.lit(False))


def make_notes(findings: DataFrame, least_ratio: float = 100, lumpy: int = 3) -> DataFrame:
    """Public notes on confirmed findings: jumps of a hundred times or more, and values their unit rules out. A series with
    three or more of them is uneven by nature and gets none."""
    v, pv, nv = F.col("value"), F.col("pv"), F.col("nv")
    ratio = F.greatest(F.abs(v / pv), F.abs(pv / v))
    where = F.concat(F.lit("As published by "), F.col("source"), F.lit(", re-checked at the source. "))
    jump = F.concat(where, F.lit("About "), two_figures(ratio), F.lit(" times "), F.when(F.abs(v) > F.abs(pv), "above").otherwise("below"), F.lit(" the periods either side"), F.when(exact_slip(v, pv, nv), ", which suggests a unit slip in the source's figure.").otherwise("."))
    note = F.when((F.col("detector") == "spike_level") & (pv != 0) & (v != 0) & (ratio >= least_ratio), jump).when(F.col("detector") == "out_of_range", F.concat(where, F.lit("Unusual for its unit.")))
    n = findings.filter("verdict = 'confirmed'").withColumn("note", note).filter("note is not null")
    few = n.groupBy("series_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") < lumpy).select("series_id")
    return n.join(few, "series_id", "left_semi").select(*POINT, "detector", "note")


def copy_verdicts(findings: DataFrame, sources: DataFrame, obs: DataFrame, checks: DataFrame, mismatches: DataFrame, rel: float = 1e-9) -> DataFrame:
    """Findings on series that copy another, settled by that input: copy_differs if the copy is not the input's value,
    not_reconciled if the input has not been checked, source_differs if it failed there, else confirmed."""
    inputs = obs.select(F.col("series_id").alias("input_id"), "obs_date", F.col("value").alias("input_value"))
    j = findings.join(sources, "series_id").join(inputs, ["input_id", "obs_date"], "left")
    j = j.join(checks.select(F.col("series_id").alias("input_id")).distinct().withColumn("checked", F.lit(True)), "input_id", "left")
    j = j.join(mismatches.select(F.col("series_id").alias("input_id"), "obs_date").distinct().withColumn("failed", F.lit(True)), ["input_id", "obs_date"], "left")
    same = F.abs(F.col("input_value") - F.col("value")) <= rel * F.greatest(F.abs("input_value"), F.abs("value"))
    verdict = F.when(F.col("input_value").isNull() | ~same, "copy_differs").when(F.col("checked").isNull(), "not_reconciled").when(F.col("failed"), "source_differs").otherwise("confirmed")
    return j.withColumn("verdict", verdict).select("series_id", "obs_date", "value", "input_id", "input_value", "verdict")


def disambiguate_names(catalog: DataFrame, steps: list[Column]) -> DataFrame:
    """Series that share a name with the qualifiers that tell them apart, joined by commas. Each step is taken within the
    groups that are still the same, where its values differ and none is empty. A fixed number of windows, no loop on data."""
    out = catalog.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("name"))).filter("_n > 1").drop("_n")
    out = out.withColumn("_group", F.col("name")).withColumn("_quals", F.array().cast("array<string>"))
    for step in steps:
        w = Window.partitionBy("_group")
        val = F.coalesce(step, F.lit(""))
        out = out.withColumn("_v", val).withColumn("_use", (F.size(F.collect_set("_v").over(w)) > 1) & (F.min(F.length("_v")).over(w) > 0))
        out = out.withColumn("_quals", F.when(F.col("_use"), F.concat("_quals", F.array("_v"))).otherwise(F.col("_quals"))).withColumn("_group", F.when(F.col("_use"), F.concat_ws("\u0001", "_group", "_v")).otherwise(F.col("_group")))
    return out.filter(F.size("_quals") > 0).select("series_id", "name", F.array_join("_quals", ", ").alias("qualifier"))


def mislabelled_blocks(monthly: DataFrame, hourly: DataFrame, apart: float = 0.5, hours: int = 24) -> DataFrame:
    """Blocks of monthly files (block, month, hour, value) to drop: a month whose hourly profile is off the prices' own by
    more than so much on average, and blocks that repeat another month's to the digit."""
    price = hourly.groupBy("month", "hour").agg(F.avg("value").alias("price"))
    gap = monthly.join(price, ["month", "hour"]).groupBy("block", "month").agg(F.avg(F.abs(F.col("value") - F.col("price"))).alias("gap"), F.count(F.lit(1)).alias("n"))
    wrong = gap.filter((F.col("n") >= hours) & (F.col("gap") > apart)).select("block", "month", F.lit("profile").alias("reason"))
    sign = monthly.groupBy("block", "month").agg(F.sha2(F.to_json(F.sort_array(F.collect_list(F.struct("hour", "value")))), 256).alias("sign"))
    again = sign.join(sign.groupBy("block", "sign").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), ["block", "sign"]).select("block", "month", F.lit("repeated").alias("reason"))
    return wrong.unionByName(again)


def row_identities(rows: DataFrame, checks: dict[str, tuple[Column, Column, float, float]]) -> DataFrame:
    """Rows with `failed` (names of identities that do not hold) and `checks_ok` (null if none could be checked): name ->
    (left, right, absolute room, relative room)."""
    holds = {k: F.abs(a - b) <= F.greatest(F.lit(room), rel * F.abs(a)) for k, (a, b, room, rel) in checks.items()}
    failed = F.filter(F.array(*[F.when(~ok, k) for k, ok in holds.items()]), lambda x: x.isNotNull())
    any_ = reduce(Column.__or__, [ok.isNotNull() for ok in holds.values()])
    return rows.withColumn("failed", failed).withColumn("checks_ok", F.when(any_, F.size("failed") == 0))


def stale_date_guard(statements: DataFrame, key: list[str], total: str, order: str) -> DataFrame:
    """Statements with `accepted`: of several for one day only those with the first one's running total are of that day."""
    first = F.first(total).over(Window.partitionBy(*key).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return statements.withColumn("accepted", F.col(total).eqNullSafe(first))
