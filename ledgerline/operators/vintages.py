"""Revision histories from publications: printed figures matched to series by value, chained by issue, and checked.

Printed cells are rows (source, published, row_id, label, obs_date, pub, dp): the figure `pub` with `dp` decimals that the
row `row_id` of the issue of `published` gives for a period.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

ROW = ["source", "published", "row_id"]
#: Unit scales between a print and our series, how far apart a probe may be, and what a match needs.
SCALES = [1.0, 1e3, 1e-3, 1e6, 1e-6]
PROBES = [1.0, 1.004, 0.996]
LEAST_MATCHES, LEAST_SHARE = 4, 0.6
NEAR, OUTLIER, OUTLIER_ISSUES = 0.15, 0.5, 3
TRAILING, MOST_TRAILING = 0.15, 0.05
#: Words of a label that name units.
UNIT_WORDS = ["rs", "billion", "million", "us", "dollars", "dollar", "percent", "base", "unit"]


def label_family(label: Column) -> Column:
    """What a row label is about: its words in order of the alphabet, without unit words, and the years it names."""
    words = F.array_except(F.array_distinct(F.regexp_extract_all(F.replace(F.lower(label), F.lit("-"), F.lit(" ")), F.lit("([a-z]{2,})"), F.lit(1))), F.array(*map(F.lit, UNIT_WORDS)))
    years = F.regexp_extract_all(label, F.lit(r"((?:19|20)\d{2})"), F.lit(1))
    return F.array_join(F.array_sort(F.array_distinct(F.concat(words, years))), " ")


def informative(cells: DataFrame) -> DataFrame:
    """Without small whole numbers, which meet far too much by chance."""
    return cells.filter(~((F.col("dp") == 0) & (F.abs("pub") < 100)))


def figure3(x: Column) -> Column:
    """A value to three significant figures, as text: the bucket in which equal values meet."""
    return F.when(x == 0, "0").otherwise(F.format_string("%.2e", x))


def prints_as(value: Column, pub: Column, dp: Column, scale: Column) -> Column:
    """Whether our value, in the print's unit and precision, is the printed figure. The value is divided by the unit of the last
    digit, so that the binary double is rounded: 41.05 is a little less than it reads and prints as 41.0. Exact halves go
    away from zero."""
    unit = F.pow(F.lit(10.0), -dp)
    return F.abs(F.round(value / scale / unit) * unit - pub) <= 0.6 * unit


def _needed(n: Column) -> Column:
    return F.greatest(F.lit(LEAST_MATCHES), F.ceil(F.round(LEAST_SHARE * n, 9)))


def value_match(cells: DataFrame, obs: DataFrame) -> DataFrame:
    """(source, published, row_id, series_id, scale, votes): every series whose values print as a row's figures, at a unit
    scale, in enough of the row's periods. Cells are brought to the buckets of their probes, so that the join is an equality
    on period and three figures; what meets there is then verified."""
    c = informative(cells)
    probe = F.explode(F.array_distinct(F.flatten(F.array(*[F.array(*[F.struct(F.lit(s).alias("scale"), figure3(F.col("pub") * s * p).alias("figure")) for p in PROBES]) for s in SCALES]))))
    asked = c.select(*ROW, "obs_date", "pub", "dp", probe.alias("q")).select(*ROW, "obs_date", "pub", "dp", "q.scale", "q.figure")
    known = obs.select("series_id", "obs_date", "value", figure3(F.col("value")).alias("figure"))
    hits = asked.join(known, ["obs_date", "figure"]).filter(prints_as(F.col("value"), F.col("pub"), F.col("dp"), F.col("scale"))).select(*ROW, "obs_date", "series_id", "scale").distinct()
    votes = hits.groupBy(*ROW, "series_id", "scale").agg(F.count(F.lit(1)).alias("votes"))
    n = c.groupBy(*ROW).agg(F.count(F.lit(1)).alias("n"))
    return votes.join(n, ROW).filter(F.col("votes") >= _needed(F.col("n"))).select(*ROW, "series_id", "scale", "votes")


def labels(cells: DataFrame) -> DataFrame:
    """Each row's label family."""
    return cells.groupBy(*ROW).agg(label_family(F.min("label")).alias("family"))


def dominant_family_scale(matches: DataFrame, families: DataFrame) -> DataFrame:
    """One label family and one unit scale for each series: those of most of its rows (ties: the first family, the least scale)."""
    m = matches.join(families, ROW)

    def most(col: str) -> DataFrame:
        n = m.groupBy("source", "series_id", col).agg(F.count(F.lit(1)).alias("n"))
        return n.groupBy("source", "series_id").agg(F.min_by(col, F.struct(-F.col("n"), col)).alias(col))

    return most("family").join(most("scale"), ["source", "series_id"])


def near_match_pass(cells: DataFrame, obs: DataFrame, dominant: DataFrame, families: DataFrame, matched: DataFrame, exact_only: list[str] = ()) -> DataFrame:
    """Further rows of a series' own family that are mostly within 15 % of today's values: the old issues of series that are
    revised a lot. Not for rebased indices (exact_only)."""
    asked = dominant.filter(~F.col("series_id").isin(*exact_only)) if exact_only else dominant
    rows = families.join(asked, ["source", "family"]).join(matched.select(*ROW, "series_id"), [*ROW, "series_id"], "left_anti")
    j = informative(cells).join(rows, ROW).join(obs, ["series_id", "obs_date"])
    close = F.abs(F.col("pub") * F.col("scale") - F.col("value")) <= NEAR * F.greatest(F.abs("value"), F.lit(1e-9))
    g = j.groupBy(*ROW, "series_id", "scale").agg(F.count(F.lit(1)).alias("n"), F.count_if(close).alias("hits"))
    return g.filter((F.col("n") >= LEAST_MATCHES) & (F.col("hits") >= F.ceil(F.round(LEAST_SHARE * F.col("n"), 9)))).select(*ROW, "series_id", "scale", F.col("hits").alias("votes"))


def mapped_rows(cells: DataFrame, obs: DataFrame, exact_only: list[str] = ()) -> DataFrame:
    """Rows and the series they print, by both passes, each series from its dominant family and scale only."""
    families = labels(cells)
    first = value_match(cells, obs)
    dominant = dominant_family_scale(first, families)
    good = first.join(dominant.select("source", "series_id", "scale"), ["source", "series_id", "scale"], "left_semi")
    every = good.unionByName(near_match_pass(cells, obs, dominant, families, good, exact_only))
    return every.join(families, ROW).join(dominant.select("source", "series_id", "family"), ["source", "series_id", "family"], "left_semi").select(*ROW, "series_id", "scale")


def point_prints(cells: DataFrame, rows: DataFrame, obs: DataFrame) -> DataFrame:
    """The prints of each point: (series_id, obs_date, source, published, pub, dp, scale, printed, value), printed in our unit."""
    j = informative(cells).join(rows, ROW).withColumn("printed", F.col("pub") * F.col("scale"))
    return j.join(obs, ["series_id", "obs_date"]).select("series_id", "obs_date", "source", "published", "pub", "dp", "scale", "printed", "value")


POINT = ["series_id", "obs_date"]


def drop_blips(prints: DataFrame) -> DataFrame:
    """Without figures printed in one issue only while the issues on both sides agree (at the coarser precision)."""
    w = Window.partitionBy(*POINT, "source").orderBy("published")
    p = prints.withColumn("b", F.lag(F.struct("pub", "dp")).over(w)).withColumn("a", F.lead(F.struct("pub", "dp")).over(w))

    def same(x: Column, x_dp: Column, y: Column, y_dp: Column) -> Column:
        unit = F.pow(F.lit(10.0), -F.least(x_dp, y_dp))
        return F.round(x / unit) == F.round(y / unit)

    blip = same(F.col("b.pub"), F.col("b.dp"), F.col("a.pub"), F.col("a.dp")) & ~same(F.col("b.pub"), F.col("b.dp"), F.col("pub"), F.col("dp"))
    return p.filter(~F.coalesce(blip, F.lit(False))).drop("a", "b")


def drop_unconfirmed_outliers(prints: DataFrame) -> DataFrame:
    """A figure more than half off today's value counts only if at least three issues printed it."""
    n = F.count(F.lit(1)).over(Window.partitionBy(*POINT, "source", "pub"))
    far = F.abs(F.col("printed") - F.col("value")) > OUTLIER * F.greatest(F.abs("value"), F.lit(1e-9))
    return prints.withColumn("n", n).filter(~far | (F.col("n") >= OUTLIER_ISSUES)).drop("n")


def _equal(a: Column, b: Column) -> Column:
    """Two prints (printed, dp, scale) show one figure: at the coarser precision, or within half a unit of the coarser print
    where their units differ."""
    unit = F.pow(F.lit(10.0), -F.least(a["dp"], b["dp"]))
    half = 0.5 * F.greatest(F.pow(F.lit(10.0), -a["dp"]) * a["scale"], F.pow(F.lit(10.0), -b["dp"]) * b["scale"])
    in_unit = F.round(a["printed"] / a["scale"] / unit) == F.round(b["printed"] / b["scale"] / unit)
    return F.when(a["scale"] == b["scale"], in_unit).otherwise(F.abs(a["printed"] - b["printed"]) <= half)


def revision_chain(prints: DataFrame) -> DataFrame:
    """The different figures of each point in order of publication, as an array: a print equal to the last one kept is no new
    one. One fold over a point's sorted prints."""
    p = F.struct("published", "source", "printed", "dp", "scale")
    g = prints.groupBy(*POINT).agg(F.array_sort(F.collect_list(p)).alias("all"), F.first("value").alias("value"))
    kept = F.aggregate("all", F.slice("all", 1, 0), lambda acc, x: F.when(F.coalesce(_equal(F.try_element_at(acc, F.lit(-1)), x), F.lit(False)), acc).otherwise(F.concat(acc, F.array(x))))
    return g.select(*POINT, "value", F.col("all")[0]["published"].alias("first_seen"), kept.alias("chain"))


def build_vintages(cells: DataFrame, obs: DataFrame, tracking: Column, exact_only: list[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(first_seen, revisions). Each printed figure stood until the next other one was published; the last one, if it is not
    today's value, until our own tracking began, if it is within 15 % of today's. A series with more than 5 % of points
    further off is another concept and left out."""
    prints = drop_unconfirmed_outliers(drop_blips(point_prints(cells, mapped_rows(cells, obs, exact_only), obs)))
    chains = revision_chain(prints).withColumn("last", F.element_at("chain", -1))
    stale = ~prints_as(F.col("value"), F.col("last.printed") / F.col("last.scale"), F.col("last.dp"), F.col("last.scale"))
    big = F.abs(F.col("last.printed") - F.col("value")) > TRAILING * F.greatest(F.abs("value"), F.lit(1e-9))
    chains = chains.withColumn("stale", stale).withColumn("big", stale & big)
    fine = chains.groupBy("series_id").agg(F.avg(F.col("big").cast("int")).alias("share")).filter(F.col("share") <= MOST_TRAILING).select("series_id")
    kept = chains.join(fine, "series_id", "left_semi")
    steps = F.transform(F.sequence(F.lit(1), F.size("chain")), lambda i: F.struct(F.element_at("chain", i)["printed"].alias("value"), F.coalesce(F.try_element_at("chain", i + 1)["published"], F.when(F.col("stale") & ~F.col("big"), tracking)).alias("superseded_at"), F.element_at("chain", i)["source"].alias("source")))
    revisions = kept.select(*POINT, F.explode(steps).alias("r")).select(*POINT, "r.value", "r.superseded_at", "r.source").filter("superseded_at is not null")
    return kept.select(*POINT, "first_seen"), revisions


def build_pinned(prints: DataFrame, key: list[str]) -> DataFrame:
    """Rows that name their series themselves, (key, published, printed, dp): revisions by the chain of prints that differ by
    more than half a unit of the last digit."""
    p = F.struct("published", "printed", "dp")
    g = prints.groupBy(*key).agg(F.array_sort(F.collect_list(p)).alias("all"))

    def step(acc: Column, x: Column) -> Column:
        last = F.try_element_at(acc, F.lit(-1))
        same = F.abs(last["printed"] - x["printed"]) <= 0.5 * F.pow(F.lit(10.0), -F.least(last["dp"], x["dp"])) + 1e-12
        return F.when(F.coalesce(same, F.lit(False)), acc).otherwise(F.concat(acc, F.array(x)))

    chain = g.select(*key, F.aggregate("all", F.slice("all", 1, 0), step).alias("chain"))
    pairs = F.transform(F.sequence(F.lit(1), F.size("chain") - 1), lambda i: F.struct(F.element_at("chain", i)["printed"].alias("value"), F.element_at("chain", i + 1)["published"].alias("superseded_at")))
    return chain.filter(F.size("chain") > 1).select(*key, F.explode(pairs).alias("r")).select(*key, "r.*")


def only_changed_prints(copies: DataFrame, key: list[str], order: str) -> DataFrame:
    """Of a point's copies only those that are new or differ from the one before."""
    w = Window.partitionBy(*key).orderBy(order)
    first = F.row_number().over(w) == 1
    return copies.withColumn("fresh", first | ~F.col("value").eqNullSafe(F.lag("value").over(w))).filter("fresh").drop("fresh")


def latest_prints(cells: DataFrame, family: str) -> DataFrame:
    """The newest issue's figure for each period of a label family."""
    own = cells.filter(label_family(F.col("label")) == family)
    return own.groupBy("obs_date").agg(F.max_by("pub", F.struct("published", "source", "row_id")).alias("pub"), F.max("published").alias("published"))


def unmatched_candidates(cells: DataFrame, rows: DataFrame, catalog: DataFrame, most: int = 3) -> DataFrame:
    """Label families of rows that no series was found for: how many issues, first and last, and the `most` series whose names
    share most words with them, by an inverted index of words."""
    left = labels(cells).join(rows.select(*ROW).distinct(), ROW, "left_anti")
    g = left.groupBy("family").agg(F.countDistinct("published").alias("issues"), F.min("published").alias("first"), F.max("published").alias("last"))
    words = lambda c: F.explode(F.array_distinct(F.split(c, " ")))
    names = catalog.select("series_id", words(label_family(F.col("name"))).alias("word"))
    met = g.select("family", words(F.col("family")).alias("word")).join(names, "word").groupBy("family", "series_id").agg(F.count(F.lit(1)).alias("shared"))
    w = Window.partitionBy("family").orderBy(F.desc("shared"), "series_id")
    best = met.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= most).groupBy("family").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "series_id"))), lambda x: x["series_id"]), ",").alias("nearest"))
    return g.join(best, "family", "left")


def rebuild_backfill(revisions: DataFrame, fresh: DataFrame, sources: list[str]) -> DataFrame:
    """Revisions with all backfilled sources replaced together; an error if one of them is missing from the new ones."""
    found = {r["source"] for r in fresh.select("source").distinct().filter(F.col("source").isin(*sources)).limit(len(sources)).collect()}  # at most as many as sources
    if missing := set(sources) - found:
        raise ValueError(f"no revisions from {sorted(missing)}")
    return revisions.filter(~F.col("source").isin(*sources)).unionByName(fresh.filter(F.col("source").isin(*sources)))
