"""Editions, files and rulings: what each adds, removes or supersedes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.session import scratch_dir


def merge_files(rows: DataFrame, keys: list[str], cols: list[str], order: Column) -> DataFrame:
    """Equal keys of one file add up (a null adds nothing); across files the later publication wins."""
    sums = rows.groupBy("file", *keys).agg(*[F.sum(c).alias(c) for c in cols])
    return sums.withColumn("rn", F.row_number().over(Window.partitionBy(*keys).orderBy(order.desc()))).filter("rn = 1").drop("rn")


def code_span(rows: DataFrame) -> DataFrame:
    """Per code the newest wording and the newest unit that are not empty, each for itself, and the first and last fiscal year."""
    newest = lambda c: F.max(F.when(F.length(F.trim(c)) > 0, F.struct("fy", c)))[c].alias(c)
    return rows.groupBy("code").agg(newest("description"), newest("unit"), F.min("fy").alias("first_fy"), F.max("fy").alias("last_fy"))


def split_rows(df: DataFrame, test: Column) -> tuple[DataFrame, DataFrame]:
    """(rows that pass, all others; null does not pass) of a table that is computed and written once, by side, so that each
    side then reads its own files."""
    folder = scratch_dir(df.sparkSession)
    df.withColumn("_side", F.coalesce(test, F.lit(False)).cast("int")).write.partitionBy("_side").parquet(folder)
    both = df.sparkSession.read.schema(f"{df._jdf.schema().toDDL()}, _side INT").parquet(folder)
    return both.filter("_side = 1").drop("_side"), both.filter("_side = 0").drop("_side")


def number_repeats(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Rows of equal keys numbered from 0 in the order given."""
    return df.withColumn("seq_no", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1)


def fill_after(primary: DataFrame, secondary: DataFrame, key: list[str]) -> DataFrame:
    """The second source supplies only dates after the first one's last date of the same key."""
    last = primary.groupBy(*key).agg(F.max("obs_date").alias("last_date"))
    late = secondary.join(last, key, "left").filter(F.col("last_date").isNull() | (F.col("obs_date") > F.col("last_date"))).drop("last_date")
    return primary.unionByName(late)


def edition_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows removed from and added to an edition, repeats counted."""
    return old.exceptAll(new).withColumn("change", F.lit("removed")).unionByName(new.exceptAll(old).withColumn("change", F.lit("added")))


def widen_bounds(series: DataFrame, batch: DataFrame) -> DataFrame:
    """First and last dates widened by a batch; a series with a value other than zero becomes active."""
    b = batch.groupBy("series_id").agg(F.min("obs_date").alias("lo"), F.max("obs_date").alias("hi"), F.max(F.col("value") != 0).alias("alive"))
    j = series.join(b, "series_id", "left")
    return j.select("series_id", F.least("first_date", "lo").alias("first_date"), F.greatest("last_date", "hi").alias("last_date"), (F.col("is_active") | F.coalesce("alive", F.lit(False))).alias("is_active"))


def revision_history(obs: DataFrame, revs: DataFrame, key: list[str]) -> DataFrame:
    """Each point's prints in order, every one valid `until` it was superseded, with its first print."""
    prints = F.array_sort(F.collect_list(F.struct(F.col("superseded_at").alias("until"), "value")))
    past = revs.groupBy(*key).agg(prints.alias("prints"))
    out = obs.join(past, key, "left").withColumn("prints", F.coalesce("prints", F.expr("cast(array() as array<struct<until: timestamp, value: double>>)")))
    return out.withColumn("first_print", F.coalesce(F.try_element_at("prints", F.lit(1))["value"], F.col("value"))).withColumn("revised", F.size("prints") > 0)


def drop_blips(prints: DataFrame, key: list[str], order: str) -> DataFrame:
    """Without the middle of A-B-A: a print whose neighbours agree with each other and not with it."""
    w = Window.partitionBy(*key).orderBy(order)
    before, after = F.lag("value").over(w), F.lead("value").over(w)
    return prints.withColumn("blip", F.coalesce((before == after) & (F.col("value") != before), F.lit(False))).filter("not blip").drop("blip")


def link_supersessions(rulings: DataFrame) -> DataFrame:
    """Which ruling supersedes which: each number named by a ruling means its latest earlier listing, and a ruling is
    superseded by the earliest that names it. Earlier is the same day too, but never the ruling itself; of one day's listings
    the largest id counts. rulings: (ruling_id, number, listed_on, supersedes array<string>).

    The latest earlier listing is found by a union and one sort per number, so no range join is needed; each listing brings
    the one before it, in case the latest is the asking ruling's own."""
    listed = rulings.select("number", F.col("listed_on").alias("on"), F.col("ruling_id").alias("id"), F.lit(0).alias("asks"))
    asked = rulings.select(F.explode("supersedes").alias("number"), F.col("listed_on").alias("on"), F.col("ruling_id").alias("id"), F.lit(1).alias("asks"))
    listed = listed.withColumn("before", F.lag("id").over(Window.partitionBy("number").orderBy("on", "id")))
    w = Window.partitionBy("number").orderBy("on", "asks", "id").rowsBetween(Window.unboundedPreceding, -1)
    both = listed.unionByName(asked.withColumn("before", F.lit(None).cast(listed.schema["id"].dataType)))
    found = both.withColumn("last", F.last(F.when(F.col("asks") == 0, F.struct("id", "before")), ignorenulls=True).over(w))
    found = found.withColumn("old_id", F.when(F.col("last.id") != F.col("id"), F.col("last.id")).otherwise(F.col("last.before")))
    links = found.filter("asks = 1 and old_id is not null").groupBy("old_id").agg(F.min(F.struct("on", "id")).alias("by"))
    return links.select(F.col("old_id").alias("ruling_id"), F.col("by.id").alias("superseded_by"), F.col("by.on").alias("superseded_on"))


def union_status(tables: dict[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """Records, entities and dates of each fact table: name -> (rows, entity column, date column)."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("records"), F.countDistinct(e).alias("entities"), F.min(F.to_date(d)).alias("first_date"), F.max(F.to_date(d)).alias("last_date")).select(F.lit(n).alias("name"), "*")
        for n, (df, e, d) in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)
