"""Queries of revision histories from publications, each with the SQL it must agree with."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.operators import vintages
from ledgerline.plans import adapters as A
from ledgerline.plans.registry import _POINT, _points, query, rounded
from ledgerline.sources.tables import read_table

_BASE = f"{A.MONTHLY}, {A.PRINTS}"
_PROBE = " OR ".join(f"printf('%.2e', o.value) = printf('%.2e', pub * scale * {p})" for p in vintages.PROBES)
_MATCH = f"""{_BASE}, scales(scale) AS (VALUES {', '.join(f'(CAST({s} AS DOUBLE))' for s in vintages.SCALES)}), n AS (SELECT published, row_id, count(*) AS n FROM cells GROUP BY 1, 2),
hit AS (SELECT DISTINCT c.published, c.row_id, c.obs_date, o.series_id, scale FROM cells c CROSS JOIN scales JOIN current o ON o.obs_date = c.obs_date WHERE ({_PROBE}) AND abs(round(o.value / scale / pow(10.0, -dp)) * pow(10.0, -dp) - pub) <= 0.6 * pow(10.0, -dp)),
matches AS (SELECT 'bulletin' AS source, published, row_id, series_id, scale, count(*) AS votes FROM hit JOIN n USING (published, row_id) GROUP BY published, row_id, series_id, scale, n HAVING count(*) >= greatest(4, ceil(round(0.6 * n, 9))))"""
_FAMILY = "array_to_string(list_sort(list_distinct(list_concat(list_filter(regexp_extract_all(replace(lower({0}), '-', ' '), '([a-z][a-z]+)', 1), lambda w: w NOT IN ('rs', 'billion', 'million', 'us', 'dollars', 'dollar', 'percent', 'base', 'unit')), regexp_extract_all({0}, '((?:19|20)\\d\\d)', 1)))), ' ')"
_FAMS = f"fam AS (SELECT published, row_id, {_FAMILY.format('min(label)')} AS family FROM cells GROUP BY 1, 2)"
_TOP = "SELECT series_id, {0}, row_number() OVER (PARTITION BY series_id ORDER BY count(*) DESC, {0}) AS rn FROM matches JOIN fam USING (published, row_id) GROUP BY 1, 2"
_DOM = f"f AS ({_TOP.format('family')}), s AS ({_TOP.format('scale')}), dom AS (SELECT f.series_id, family, scale FROM f JOIN s ON s.series_id = f.series_id AND f.rn = 1 AND s.rn = 1)"
_ROWS = f"""{_MATCH}, {_FAMS}, {_DOM}, good AS (SELECT m.published, m.row_id, m.series_id, m.scale FROM matches m JOIN dom USING (series_id, scale)),
nears AS (SELECT fam.published, fam.row_id, dom.series_id, dom.scale, count(*) AS n, count(*) FILTER (abs(pub * scale - o.value) <= 0.15 * abs(o.value)) AS hits FROM fam JOIN dom USING (family) JOIN cells c ON c.published = fam.published AND c.row_id = fam.row_id
JOIN current o ON o.series_id = dom.series_id AND o.obs_date = c.obs_date WHERE NOT EXISTS (SELECT 1 FROM good g WHERE g.published = fam.published AND g.row_id = fam.row_id AND g.series_id = dom.series_id) GROUP BY 1, 2, 3, 4),
near AS (SELECT * FROM nears WHERE n >= 4 AND hits >= ceil(round(0.6 * n, 9))), every AS (SELECT published, row_id, series_id, scale FROM good UNION ALL SELECT published, row_id, series_id, scale FROM near),
rows_ AS (SELECT e.* FROM every e JOIN fam USING (published, row_id) JOIN dom d ON d.series_id = e.series_id AND d.family = fam.family),
p AS (SELECT r.series_id, c.obs_date, c.published, pub, dp, scale, pub * scale AS printed, o.value FROM cells c JOIN rows_ r USING (published, row_id) JOIN current o ON o.series_id = r.series_id AND o.obs_date = c.obs_date)"""
_CLEAN = f"""{_ROWS}, w AS (SELECT *, lag(pub) OVER q AS b, lead(pub) OVER q AS a FROM p WINDOW q AS (PARTITION BY series_id, obs_date ORDER BY published)), noblip AS (SELECT * FROM w WHERE NOT coalesce(round(b * 10) = round(a * 10) AND round(b * 10) <> round(pub * 10), false)),
c AS (SELECT *, count(*) OVER (PARTITION BY series_id, obs_date, pub) AS times FROM noblip), fine AS (SELECT * FROM c WHERE abs(printed - value) <= 0.5 * abs(value) OR times >= 3)"""


@query(f"WITH {_MATCH} SELECT source, published, row_id, series_id, scale, votes FROM matches")
def value_match(spark, d):
    return vintages.value_match(A.cells(spark, d), A.current(spark, d))


@query(f"WITH {_MATCH}, {_FAMS}, {_DOM} SELECT 'bulletin' AS source, series_id, family, scale FROM dom")
def dominant_family_scale(spark, d):
    cells = A.cells(spark, d)
    return vintages.dominant_family_scale(vintages.value_match(cells, A.current(spark, d)), vintages.labels(cells))


@query(f"WITH {_ROWS} SELECT 'bulletin' AS source, published, row_id, series_id, scale, hits AS votes FROM near")
def near_match_pass(spark, d):
    cells, obs = A.cells(spark, d), A.current(spark, d)
    first, families = vintages.value_match(cells, obs), vintages.labels(cells)
    dominant = vintages.dominant_family_scale(first, families)
    good = first.join(dominant.select("source", "series_id", "scale"), ["source", "series_id", "scale"], "left_semi")
    return vintages.near_match_pass(cells, obs, dominant, families, good)


@query(f"WITH {_CLEAN} SELECT series_id, obs_date, published, pub, scale FROM fine")
def confirmed_prints(spark, d):
    cells, obs = A.cells(spark, d), A.current(spark, d)
    prints = vintages.point_prints(cells, vintages.mapped_rows(cells, obs), obs)
    return vintages.drop_unconfirmed_outliers(vintages.drop_blips(prints)).select("series_id", "obs_date", "published", "pub", "scale")


_CHAIN = f"""{_CLEAN}, h AS (SELECT *, lag(pub) OVER (PARTITION BY series_id, obs_date ORDER BY published) AS was FROM fine), links AS (SELECT series_id, obs_date, value, published, printed, scale, dp, lead(published) OVER (PARTITION BY series_id, obs_date ORDER BY published) AS until FROM h WHERE was IS NULL OR round(was * 10) <> round(pub * 10)),
tail AS (SELECT *, abs(round(value / scale / pow(10.0, -dp)) * pow(10.0, -dp) - printed / scale) > 0.6 * pow(10.0, -dp) AS stale, abs(printed - value) > 0.15 * abs(value) AS far FROM links WHERE until IS NULL), ok AS (SELECT series_id FROM tail GROUP BY 1 HAVING avg(CAST(stale AND far AS INTEGER)) <= 0.05)"""


@query(f"""WITH {_CHAIN} SELECT series_id, obs_date, round(printed, 4) AS value, until AS superseded_at, 'bulletin' AS source FROM links SEMI JOIN ok USING (series_id) WHERE until IS NOT NULL
UNION ALL SELECT series_id, obs_date, round(printed, 4), DATE '2005-01-01', 'bulletin' FROM tail SEMI JOIN ok USING (series_id) WHERE stale AND NOT far""")
def build_vintages(spark, d):
    return rounded(vintages.build_vintages(A.cells(spark, d), A.current(spark, d), F.lit("2005-01-01").cast("date"))[1], "value", digits=4)


@query(f"WITH {_CHAIN} SELECT series_id, obs_date, min(published) AS first_seen FROM links SEMI JOIN ok USING (series_id) GROUP BY 1, 2")
def first_seen(spark, d):
    return vintages.build_vintages(A.cells(spark, d), A.current(spark, d), F.lit("2005-01-01").cast("date"))[0]


_PIN = "p AS (SELECT o_custkey AS series_id, o_orderkey AS published, CAST(o_orderkey % 4 * 10 + o_orderkey % 3 * 0.2 AS DOUBLE) AS printed FROM orders)"


@query(f"""WITH RECURSIVE {_PIN}, n AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY published) AS rn FROM p), fold AS (SELECT series_id, rn, published, printed AS kept, true AS fresh FROM n WHERE rn = 1
UNION ALL SELECT n.series_id, n.rn, n.published, CASE WHEN abs(fold.kept - n.printed) <= 0.5 + 1e-12 THEN fold.kept ELSE n.printed END, abs(fold.kept - n.printed) > 0.5 + 1e-12 FROM fold JOIN n ON n.series_id = fold.series_id AND n.rn = fold.rn + 1),
k AS (SELECT series_id, kept AS value, lead(published) OVER (PARTITION BY series_id ORDER BY rn) AS superseded_at FROM fold WHERE fresh) SELECT series_id, round(value, 4) AS value, superseded_at FROM k WHERE superseded_at IS NOT NULL""")
def build_pinned(spark, d):
    k = F.col("o_orderkey")
    prints = read_table(spark, d, "orders").select(F.col("o_custkey").alias("series_id"), k.alias("published"), (k % 4 * 10 + k % 3 * 0.2).cast("double").alias("printed"), F.lit(0).alias("dp"))
    return rounded(vintages.build_pinned(prints, ["series_id"]), "value", digits=4)


@query("""WITH c AS (SELECT o_custkey AS k, o_orderkey AS issue, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderkey % 2 END AS value, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders)
SELECT a.k, a.issue, a.value FROM c a LEFT JOIN c b ON b.k = a.k AND b.rn = a.rn - 1 WHERE b.k IS NULL OR a.value IS DISTINCT FROM b.value""")
def only_changed_prints(spark, d):
    k = F.col("o_orderkey")
    copies = read_table(spark, d, "orders").select(F.col("o_custkey").alias("k"), k.alias("issue"), F.when(k % 5 != 0, k % 2).alias("value"))
    return vintages.only_changed_prints(copies, ["k"], "issue")


@query(f"WITH {_BASE} SELECT obs_date, arg_max(pub, published) AS pub, max(published) AS published FROM cells WHERE row_id = 'Brand#12' GROUP BY 1")
def latest_prints(spark, d):
    return vintages.latest_prints(A.cells(spark, d), "2010 brand xbcz")


@query(f"""WITH {_ROWS}, {A.CATALOG}, lost AS (SELECT family, published FROM fam WHERE NOT EXISTS (SELECT 1 FROM rows_ r WHERE r.published = fam.published AND r.row_id = fam.row_id)), g AS (SELECT family, count(DISTINCT published) AS issues, min(published) AS first, max(published) AS last FROM lost GROUP BY 1),
w AS (SELECT DISTINCT family, unnest(string_split(family, ' ')) AS word FROM g), k AS (SELECT DISTINCT series_id, unnest(string_split({_FAMILY.format('name')}, ' ')) AS word FROM catalog), m AS (SELECT family, series_id, row_number() OVER (PARTITION BY family ORDER BY count(*) DESC, series_id) AS place FROM w JOIN k USING (word) GROUP BY 1, 2)
SELECT g.family, issues, first, last, string_agg(series_id, ',' ORDER BY place) AS nearest FROM g LEFT JOIN m ON m.family = g.family AND place <= 3 GROUP BY ALL""")
def unmatched_candidates(spark, d):
    cells, obs = A.cells(spark, d), A.current(spark, d)
    return vintages.unmatched_candidates(cells, vintages.mapped_rows(cells, obs), A.catalog(spark, d))


@query(f"""WITH r AS (SELECT {_POINT}, o_totalprice AS value, CASE o_orderkey % 3 WHEN 0 THEN 'live' WHEN 1 THEN 'bulletin' ELSE 'yearbook' END AS source FROM orders) SELECT series_id, obs_date, dims_key, value, source FROM r WHERE source = 'live' UNION ALL SELECT series_id, obs_date, dims_key, value + 1, source FROM r WHERE source <> 'live' AND month(obs_date) > 2""")
def rebuild_backfill(spark, d):
    n = F.col("seq") % 3
    r = _points(spark, d).withColumn("source", F.when(n == 0, "live").when(n == 1, "bulletin").otherwise("yearbook")).drop("seq")
    return vintages.rebuild_backfill(r, r.filter("month(obs_date) > 2").withColumn("value", F.col("value") + 1), ["bulletin", "yearbook"])
