"""Ingest: duplicates, gates, merge with revisions, and what was known on a date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

POINT = ["series_id", "obs_date", "dims_key"]


def dedupe_last(df: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """One row per key: the last by arrival order."""
    return df.withColumn("rn", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(seq)))).filter("rn = 1").drop("rn")


def _pairs(dims_key: Column) -> Column:
    """The pairs of a canonical JSON key, each as one text."""
    return F.transform(F.map_entries(F.from_json(dims_key, "map<string,string>")), lambda e: F.to_json(F.struct(e["key"].alias("k"), e["value"].alias("v"))))


def latest_value(records: DataFrame, obs: DataFrame) -> DataFrame:
    """(series_id, dims_key, last_date, last_value) for each key of the records that has one: the newest stored value whose
    dimensions hold all of the record's. Of one date's the key that is equal counts, else the smallest. Where the newest is
    null there is none.

    Keys that are stored as such, the common case, are met by equality. For the others the stored keys' pairs are an
    inverted index: a stored key holds an asked one if as many pairs meet as the asked one has. Only different keys are
    indexed, and of an asked key only its rarest pair by series is looked up, which the rest then verifies. A key without
    pairs is held by every key of its series."""
    key = ["series_id", "dims_key"]
    last = obs.groupBy(*key).agg(F.max(F.struct("obs_date", "value")).alias("p"))
    asked = records.select(*key).distinct()
    wanted = asked.withColumn("pairs", F.coalesce(_pairs(F.col("dims_key")), F.array().cast("array<string>")))
    stored = last.select("series_id", F.col("dims_key").alias("stored_key"), "p", F.coalesce(_pairs(F.col("dims_key")), F.array().cast("array<string>")).alias("held"))
    index = stored.select("series_id", "stored_key", "p", "held", F.explode("held").alias("pair"))
    often = index.groupBy("series_id", "pair").agg(F.count(F.lit(1)).alias("n"))
    each = wanted.filter(F.size("pairs") > 0).select(*key, "pairs", F.explode("pairs").alias("pair")).join(often, ["series_id", "pair"], "left")
    rarest = each.groupBy(*key, "pairs").agg(F.min_by("pair", F.struct(F.coalesce("n", F.lit(0)), "pair")).alias("pair"))
    met = rarest.join(index, ["series_id", "pair"]).filter(F.size(F.array_except("pairs", "held")) == 0).select(*key, "stored_key", "p")
    # without pairs: the newest of the whole series
    whole = stored.groupBy("series_id").agg(F.min_by(F.struct("stored_key", "p"), F.struct(F.negative(F.unix_date("p.obs_date")), F.col("stored_key") != "{}", "stored_key")).alias("w"))
    free = wanted.filter(F.size("pairs") == 0).join(whole, "series_id").select(*key, F.col("w.p.obs_date").alias("last_date"), F.col("w.p.value").alias("last_value"))
    order = F.struct(F.negative(F.unix_date("p.obs_date")), F.col("stored_key") != F.col("dims_key"), "stored_key")
    found = met.groupBy(*key).agg(F.min_by("p", order).alias("p")).select(*key, F.col("p.obs_date").alias("last_date"), F.col("p.value").alias("last_value"))
    return found.unionByName(free).filter("last_value is not null")


def validate(records: DataFrame, catalog: DataFrame, newest: DataFrame, today: Column) -> DataFrame:
    """records with `reason` (null if accepted) and `flagged`: future date, not in the catalog, below or above its gates;
    a step beyond max_step is flagged for dates after the stored latest one.

    catalog: (series_id, min_value, max_value, max_step); newest: (series_id, dims_key, last_date, last_value), as
    latest_value() gives it."""
    known = catalog.withColumn("known", F.lit(True))
    j = records.join(known, "series_id", "left").join(newest, ["series_id", "dims_key"], "left")
    reason = (
        F.when(F.col("obs_date") > today, "future date")
        .when(F.col("known").isNull(), "not in catalog")
        .when(F.col("value") < F.col("min_value"), "below minimum")
        .when(F.col("value") > F.col("max_value"), "above maximum")
    )
    flagged = F.coalesce((F.col("obs_date") > F.col("last_date")) & (F.abs(F.col("value") - F.col("last_value")) > F.col("max_step")), F.lit(False))
    return j.withColumn("reason", reason).withColumn("flagged", flagged).select(*records.columns, "reason", "flagged")


def merge_observations(stored: DataFrame, incoming: DataFrame, now: Column) -> DataFrame:
    """Full outer merge of (point, value, flagged, revised_at, first_seen_at) with (point, value, flagged). `action`: new,
    changed, flagged (the flag alone differs: it is written, but is no revision), same or kept; a changed row carries the
    value it replaces in `prior_value`, which is its revision as of now."""
    s = stored.select(*POINT, F.col("value").alias("old"), F.col("flagged").alias("old_flag"), "revised_at", "first_seen_at", F.lit(True).alias("in_store"))
    i = incoming.select(*POINT, F.col("value").alias("new"), F.col("flagged").alias("new_flag"), F.lit(True).alias("in_batch"))
    j = s.join(i, POINT, "full_outer")
    equal = F.col("old").eqNullSafe(F.col("new"))
    action = F.when(F.col("in_store").isNull(), "new").when(F.col("in_batch").isNull(), "kept").when(~equal, "changed").when(F.col("old_flag").eqNullSafe(F.col("new_flag")), "same").otherwise("flagged")
    j = j.withColumn("action", action)
    moved, kept = F.col("action").isin("new", "changed"), F.col("action") == "kept"
    return j.select(
        *POINT,
        F.when(kept, F.col("old")).otherwise(F.col("new")).alias("value"),
        F.when(kept, F.col("old_flag")).otherwise(F.col("new_flag")).alias("flagged"),
        F.when(moved, now).otherwise(F.col("revised_at")).alias("revised_at"),
        F.coalesce("first_seen_at", now).alias("first_seen_at"),
        "action",
        F.when(F.col("action") == "changed", F.col("old")).alias("prior_value"),
    )


def insert_only(stored: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Points never stored before; nothing is overwritten."""
    return stored.unionByName(incoming.join(stored.select(*keys), keys, "left_anti"))


def merge_coalesce(stored: DataFrame, incoming: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """A null in the new row never erases a stored value."""
    s = stored.select(*keys, *[F.col(c).alias(f"old_{c}") for c in cols])
    return s.join(incoming.select(*keys, *cols), keys, "full_outer").select(*keys, *[F.coalesce(c, f"old_{c}").alias(c) for c in cols])


def replace_partition(stored: DataFrame, incoming: DataFrame, part: list[str]) -> DataFrame:
    """A re-read snapshot replaces its partitions as a whole."""
    return stored.join(incoming.select(*part).distinct(), part, "left_anti").unionByName(incoming)


def change_detect(current: DataFrame, last: DataFrame, keys: list[str], tolerance: float = 1e-9) -> DataFrame:
    """Rows whose value differs from the last stored one, or has none."""
    j = current.join(last.select(*keys, F.col("value").alias("was")), keys, "left")
    return j.filter(F.col("was").isNull() | (F.abs(F.col("value") - F.col("was")) > tolerance)).drop("was")


def learn_bounds(obs: DataFrame, mult: float = 50, least: int = 8) -> DataFrame:
    """Gates of mult times the largest absolute value, where there is history enough."""
    out = obs.groupBy("series_id").agg(F.max(F.abs("value")).alias("largest"), F.count("value").alias("n")).filter(F.col("n") >= least)
    return out.select("series_id", (-mult * F.col("largest")).alias("min_value"), (mult * F.col("largest")).alias("max_value"))


def known_asof(obs: DataFrame, revs: DataFrame, vintage: Column, tracking: Column, seq: str | None = None) -> DataFrame:
    """Each point as known at the end of a date: obs (point, value, revised_at, first_seen_at), revs (point, value,
    superseded_at, seq); tracking is the day from which revisions were kept. Of a point's revisions superseded at one time the
    first by seq counts, their order of arrival (without one: the smallest value).

    A point is known since first_seen_at, else since its first revision or its latest writing, whichever was earlier, and if
    it is dated before tracking began, since that day at the latest. For a date before tracking began, points dated before
    it whose knowledge begins with tracking or later are shown as first held. Revisions are reduced to two values per point
    before the one join: when the first was superseded, and the value that was the first to be superseded after the date,
    which is what stood then."""
    ts, began = F.date_add(vintage, 1).cast("timestamp"), tracking.cast("timestamp")
    cuts = revs.groupBy(*POINT, "superseded_at").agg(F.min_by("value", seq or "value").alias("value"))
    r = cuts.groupBy(*POINT).agg(F.min("superseded_at").alias("first_cut"), F.min_by("value", F.when(F.col("superseded_at") >= ts, F.col("superseded_at"))).alias("then"), F.max(F.col("superseded_at") >= ts).alias("later"))
    j = obs.join(r, POINT, "left")
    held = F.least("revised_at", F.coalesce("first_cut", "revised_at"))
    known = F.coalesce("first_seen_at", F.when(F.col("obs_date") < tracking, F.least(held, began)).otherwise(held))
    early = (ts <= began) & (F.col("obs_date") < vintage) & (known >= began)
    return j.filter((known < ts) | early).withColumn("known_value", F.when(F.col("later"), F.col("then")).otherwise(F.col("value"))).select(*POINT, "known_value")


def compare_points(ours: DataFrame, source: DataFrame, keys: list[str], rel: float = 1e-6) -> DataFrame:
    """Both sides' points by kind: matched, value, missing_ours, missing_source. Source nulls that we lack are ignored."""
    a = ours.select(*keys, F.col("value").alias("ours"), F.lit(True).alias("in_ours"))
    b = source.select(*keys, F.col("value").alias("theirs"), F.lit(True).alias("in_source"))
    j = a.join(b, keys, "full_outer").filter(F.col("in_ours").isNotNull() | F.col("theirs").isNotNull())
    close = F.abs(F.col("ours") - F.col("theirs")) <= rel * F.greatest(F.abs("ours"), F.abs("theirs"), F.lit(1e-12))
    kind = F.when(F.col("in_ours").isNull(), "missing_ours").when(F.col("in_source").isNull(), "missing_source").when(close | (F.col("ours").isNull() & F.col("theirs").isNull()), "matched").otherwise("value")
    return j.withColumn("kind", kind).select(*keys, "ours", "theirs", "kind")
