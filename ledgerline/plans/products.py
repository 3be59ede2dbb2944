"""Queries of product names, securities and port words, each with the SQL it must agree with."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.operators import names, trade_names
from ledgerline.plans.registry import query
from ledgerline.sources.tables import read_table

RULES = [(None, "sml", "small"), (None, "wdg", "widget"), (None, "sml wdg", "smallest widget"), (None, "i/s", "iron/steel"), (None, "n.s", "n.e.s."), (None, "n.s.", "n.e.s."), ("02", "i/s", "in stock"), ("03", "sml", "slim"), (None, "ht", "hot"), (None, "pln", "PLN")]
_TEXT = "upper(CASE split_part(p_name, ' ', 1) WHEN 'small' THEN 'sml' WHEN 'hot' THEN 'ht' ELSE split_part(p_name, ' ', 1) END || ' ' || CASE split_part(p_name, ' ', 2) WHEN 'widget' THEN 'wdg' ELSE split_part(p_name, ' ', 2) END)"


def _printed(spark, d):
    """Product names as customs print them."""
    first, second = F.split_part("p_name", F.lit(" "), F.lit(1)), F.split_part("p_name", F.lit(" "), F.lit(2))
    text = F.upper(F.concat_ws(" ", F.when(first == "small", "sml").when(first == "hot", "ht").otherwise(first), F.when(second == "widget", "wdg").otherwise(second)))
    code = F.concat(F.lit("0"), (F.col("p_size") % 4).cast("string"), F.lpad(F.col("p_partkey").cast("string"), 8, "0"))
    tail = F.when(F.col("p_size") % 3 == 0, " I/S,N.S.").when(F.col("p_size") % 3 == 1, "(OTHER) & PLN").otherwise(".BRAND NEW ")
    return read_table(spark, d, "part").select(code.alias("code"), F.concat(text, tail).alias("name"))


@query(f"""WITH p AS (SELECT '0' || CAST(p_size % 4 AS VARCHAR) || lpad(CAST(p_partkey AS VARCHAR), 8, '0') AS code, {_TEXT} || CASE p_size % 3 WHEN 0 THEN ' I/S,N.S.' WHEN 1 THEN '(OTHER) & PLN' ELSE '.BRAND NEW ' END AS name, p_size % 4 AS ch, p_size % 3 AS k,
split_part(p_name, ' ', 1) AS a, split_part(p_name, ' ', 2) AS b FROM part),
w AS (SELECT code, name, CASE WHEN ch = 3 AND a = 'small' THEN 'slim ' || b WHEN a = 'small' AND b = 'widget' THEN 'smallest widget' ELSE a || ' ' || b END || CASE k WHEN 0 THEN CASE ch WHEN 2 THEN ' in stock, n.e.s.' ELSE ' iron/steel, n.e.s.' END WHEN 1 THEN ' (other) and PLN' ELSE ' brand new' END AS s FROM p)
SELECT code, name, upper(left(s, 1)) || substring(s, 2) AS short_name FROM w""")
def expand_abbrev(spark, d):
    return trade_names.expand_abbrev(_printed(spark, d), RULES)


_REFS = """leaf AS (SELECT DISTINCT lpad(CAST(p_partkey * 37 % 1000000 AS VARCHAR), 6, '0') AS code, p_name, p_partkey AS n FROM part),
refs AS (SELECT e.edition, code, CASE n % 4 WHEN 0 THEN '- Other' WHEN 1 THEN '-- ' || p_name WHEN 2 THEN p_name || ' of ' || code ELSE '....mixed with ' || p_name END AS text, left(code, 4) AS parent FROM leaf, (VALUES (1), (2)) e(edition) WHERE e.edition = 2 OR n % 5 <> 0
UNION ALL SELECT e.edition, left(code, 4), CASE CAST(left(code, 4) AS INTEGER) % 3 WHEN 0 THEN '- of kind ' || left(code, 4) WHEN 1 THEN '-' ELSE 'Heading ' || left(code, 4) END, left(code, 2) FROM leaf, (VALUES (1), (2)) e(edition) GROUP BY ALL
UNION ALL SELECT e.edition, left(code, 2), CASE left(code, 2) WHEN '03' THEN '- Loose' ELSE 'Chapter ' || left(code, 2) END, 'TOTAL' FROM leaf, (VALUES (1), (2)) e(edition) GROUP BY ALL),
codes AS (SELECT DISTINCT lpad(CAST(p_partkey * 37 % 1000000 AS VARCHAR), 6, '0') || CASE p_partkey % 3 WHEN 0 THEN '00' ELSE lpad(CAST(p_size AS VARCHAR), 2, '0') END AS code, p_name AS short_name FROM part)"""


def _refs(spark, d):
    """Codes, and two editions of a tree over them: items, headings and chapters, some of whose texts continue their parent's.
    Beyond a million parts several share an item's code; seq is their order."""
    n, part = F.col("p_partkey"), read_table(spark, d, "part")
    code6 = F.lpad((n * 37 % 1000000).cast("string"), 6, "0")
    leaf = part.select(code6.alias("code"), "p_name", n.alias("n")).distinct()
    two = lambda df: df.withColumn("edition", F.explode(F.array(F.lit(1), F.lit(2))))
    text = F.when(F.col("n") % 4 == 0, "- Other").when(F.col("n") % 4 == 1, F.concat(F.lit("-- "), "p_name")).when(F.col("n") % 4 == 2, F.concat("p_name", F.lit(" of "), "code")).otherwise(F.concat(F.lit("....mixed with "), "p_name"))
    items = two(leaf).filter("edition = 2 OR n % 5 <> 0").select("edition", "code", text.alias("text"), F.substring("code", 1, 4).alias("parent"), F.col("n").alias("seq"))
    h = F.substring("code", 1, 4)
    kind = F.when(h.cast("int") % 3 == 0, F.concat(F.lit("- of kind "), h)).when(h.cast("int") % 3 == 1, "-").otherwise(F.concat(F.lit("Heading "), h))
    heads = two(leaf).select("edition", h.alias("code"), kind.alias("text"), F.substring("code", 1, 2).alias("parent")).distinct()
    c = F.substring("code", 1, 2)
    chapters = two(leaf).select("edition", c.alias("code"), F.when(c == "03", "- Loose").otherwise(F.concat(F.lit("Chapter "), c)).alias("text"), F.lit("TOTAL").alias("parent")).distinct()
    codes = part.select(F.concat(code6, F.when(n % 3 == 0, "00").otherwise(F.lpad(F.col("p_size").cast("string"), 2, "0"))).alias("code"), F.col("p_name").alias("short_name")).distinct()
    return codes, items.unionByName(heads, True).unionByName(chapters, True)


@query(f"""WITH RECURSIVE {_REFS}, up AS (SELECT edition, code, trim(text) AS top, '' AS rest, parent, 0 AS depth FROM refs WHERE length(code) = 6
UNION ALL SELECT u.edition, u.code, trim(r.text), CASE WHEN regexp_replace(u.top, '^[-.]+\\s*', '') = '' THEN u.rest ELSE '; ' || regexp_replace(u.top, '^[-.]+\\s*', '') || u.rest END, r.parent, depth + 1 FROM up u JOIN refs r ON r.edition = u.edition AND r.code = u.parent WHERE regexp_matches(u.top, '^[-.]+')),
best AS (SELECT *, row_number() OVER (PARTITION BY edition, code ORDER BY depth DESC) AS rn FROM up), full_ AS (SELECT edition, code, ltrim(regexp_replace(top, '^[-.]+\\s*', '') || rest, '; ') AS heading FROM best WHERE rn = 1),
newest AS (SELECT code, min(edition) AS edition, arg_min(heading, edition) AS heading FROM full_ GROUP BY 1)
SELECT c.code, short_name, heading, edition, CASE WHEN right(c.code, 2) = '00' AND length(heading) <= 100 AND NOT regexp_matches(lower(heading), '^other\\b') THEN heading ELSE short_name END AS display_name FROM codes c LEFT JOIN newest n ON n.code = left(c.code, 6)""")
def official_name(spark, d):
    return trade_names.official_names(*_refs(spark, d), seq="seq")


_TITLES = "t AS (SELECT p_partkey, p_name || ' (' || p_brand || ' (' || p_type || '))' || CASE p_size % 5 WHEN 0 THEN '; not ' || p_type WHEN 1 THEN ', ' || repeat(p_name || ', ', 9) || 'and more; ' || p_type WHEN 2 THEN repeat('-' || p_type, 12) WHEN 3 THEN '' ELSE ' ' || repeat(p_name || ' ', 9) || ';' || repeat(p_type || ' ', 6) END AS text FROM part)"


@query(f"""WITH {_TITLES}, b AS (SELECT *, regexp_replace(regexp_replace(text, '\\s*\\([^()]*\\)', '', 'g'), '\\s*\\([^()]*\\)', '', 'g') AS bare FROM t),
s AS (SELECT *, trim(split_part(bare, ';', 1), ' ,') AS head, trim(split_part(bare, ';', 2), ' ,') AS second FROM b),
c AS (SELECT *, unnest([70, 68 - length(second)]) AS room, unnest(['head', 'room']) AS kind FROM s),
k AS (SELECT *, CASE WHEN length(head) <= room THEN head ELSE trim(coalesce(nullif(regexp_extract(left(head, room), '^(.+), ', 1), ''), nullif(regexp_extract(left(head, room), '^(.+) ', 1), ''), left(head, room)), ' ,;') END AS cut FROM c),
p AS (SELECT p_partkey, text, any_value(head) AS head, any_value(second) AS second, max(cut) FILTER (kind = 'head') AS alone, max(cut) FILTER (kind = 'room') AS beside FROM k GROUP BY 1, 2)
SELECT p_partkey, text, CASE WHEN second <> '' AND length(head || ', ' || second) <= 70 THEN head || ', ' || second WHEN second <> '' AND length(second) <= 30 AND length(beside) >= 20 THEN beside || ', ' || second ELSE alone END AS title FROM p""")
def short_title(spark, d):
    n, name, kind = F.col("p_size") % 5, F.col("p_name"), F.col("p_type")
    many = lambda c, k: F.repeat(c, k)
    tail = F.when(n == 0, F.concat(F.lit("; not "), kind)).when(n == 1, F.concat(F.lit(", "), many(F.concat(name, F.lit(", ")), 9), F.lit("and more; "), kind)).when(n == 2, many(F.concat(F.lit("-"), kind), 12)).when(n == 3, "")
    tail = F.coalesce(tail, F.concat(F.lit(" "), many(F.concat(name, F.lit(" ")), 9), F.lit(";"), many(F.concat(kind, F.lit(" ")), 6)))
    text = F.concat(name, F.lit(" ("), "p_brand", F.lit(" ("), kind, F.lit("))"), tail)
    return read_table(spark, d, "part").select("p_partkey", text.alias("text"), trade_names.short_title(text).alias("title"))


_BONDS = """bonds AS (SELECT o_orderkey AS id, CASE o_orderkey % 4 WHEN 0 THEN 'GOPIS-' || CAST(o_custkey AS VARCHAR) || '-' || strftime(o_orderdate, '%d-%m-%Y') WHEN 1 THEN 'GOPIS' || CASE WHEN o_custkey % 2 = 0 THEN 'V' ELSE 'f' END || '-' || strftime(o_orderdate, '%-d-%-m-%Y')
WHEN 2 THEN CASE WHEN o_custkey % 2 = 0 THEN 'GOPIS-VRR' ELSE 'GOPIS FRR' END ELSE 'PIB' || CAST(o_custkey AS VARCHAR) END AS code, CASE WHEN o_orderkey % 4 = 0 THEN 'GIS (' || CASE WHEN o_custkey % 2 = 0 THEN 'VRR' ELSE 'FRR' END || ') -' || CAST(o_custkey % 30 AS VARCHAR) END AS alternative,
CASE WHEN o_orderkey % 4 = 2 THEN CASE WHEN o_orderkey % 3 = 0 THEN strftime(o_orderdate, '%d/%m/%Y') ELSE strftime(o_orderdate, '%Y-%m-%d') END END AS maturity, CAST(o_orderdate AS DATE) AS day, CASE WHEN o_custkey % 2 = 0 THEN 'VRR' ELSE 'FRR' END AS kind,
CASE o_orderkey % 7 WHEN 0 THEN NULL WHEN 1 THEN 43251 ELSE 90 + o_custkey % 20 END AS price FROM orders)"""


def _bonds(spark, d):
    """Printed prices of securities under three schemes of codes, among those of others; the last number is the price."""
    k, c, day = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderdate")
    even, text = c % 2 == 0, c.cast("string")
    code = F.when(k % 4 == 0, F.concat(F.lit("GOPIS-"), text, F.lit("-"), F.date_format(day, "dd-MM-yyyy"))).when(k % 4 == 1, F.concat(F.lit("GOPIS"), F.when(even, "V").otherwise("f"), F.lit("-"), F.date_format(day, "d-M-yyyy")))
    code = code.when(k % 4 == 2, F.when(even, "GOPIS-VRR").otherwise("GOPIS FRR")).otherwise(F.concat(F.lit("PIB"), text))
    alternative = F.when(k % 4 == 0, F.concat(F.lit("GIS ("), F.when(even, "VRR").otherwise("FRR"), F.lit(") -"), (c % 30).cast("string")))
    maturity = F.when(k % 4 == 2, F.when(k % 3 == 0, F.date_format(day, "dd/MM/yyyy")).otherwise(F.date_format(day, "yyyy-MM-dd")))
    last = F.when(k % 7 == 0, "-").when(k % 7 == 1, "43,251").otherwise((90 + c % 20).cast("string"))
    first = F.when(k % 7 == 0, "n/a").otherwise("99.5")
    return read_table(spark, d, "orders").select(k.alias("id"), code.alias("code"), alternative.alias("alternative"), maturity.alias("maturity"), F.array(first, F.lit(""), last, F.lit(" ")).alias("quotes"))


@query(f"""WITH {_BONDS} SELECT id, code, CASE id % 4 WHEN 0 THEN 'issue' WHEN 1 THEN 'flag' WHEN 2 THEN 'bare' END AS scheme, CASE WHEN id % 4 <> 3 THEN kind END AS rate_type, CASE WHEN id % 4 <> 3 THEN day END AS maturity_date,
CASE WHEN id % 4 <> 3 THEN 'GOPIS-' || kind || '-' || CAST(day AS VARCHAR) END AS canonical, CAST(price AS DOUBLE) AS price, CASE WHEN id % 4 = 3 THEN 'unknown code' WHEN price IS NULL THEN 'no price' WHEN price NOT BETWEEN 50 AND 150 THEN 'price out of bounds' END AS reason FROM bonds""")
def canonical_security_code(spark, d):
    return trade_names.resolve_securities(_bonds(spark, d)).drop("alternative", "maturity", "quotes")


@query(f"""WITH {_BONDS}, r AS (SELECT alternative, 'GOPIS-' || kind || '-' || CAST(day AS VARCHAR) AS canonical FROM bonds WHERE id % 4 = 0)
SELECT CAST(NULL AS VARCHAR) AS code, alternative, string_agg(DISTINCT canonical, ',' ORDER BY canonical) AS canonicals FROM r GROUP BY 2 HAVING count(DISTINCT canonical) > 1""")
def security_conflicts(spark, d):
    return trade_names.security_conflicts(trade_names.resolve_securities(_bonds(spark, d))).withColumn("canonicals", F.array_join("canonicals", ","))


@query("""SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'Containers' WHEN 1 THEN 'Coal' WHEN 2 THEN 'Steel Coil' WHEN 4 THEN 'LNG' END AS commodity,
CASE o_orderkey % 5 WHEN 0 THEN 'teu' WHEN 1 THEN 'metric ton' WHEN 2 THEN 'number' WHEN 3 THEN 'number' ELSE 'cubic metre' END AS measure, CASE o_orderkey % 4 WHEN 0 THEN 'Qasim Container Terminal' WHEN 1 THEN 'Coal Berth' WHEN 2 THEN 'New Pier' END AS terminal FROM orders""")
def port_words(spark, d):
    k = F.col("o_orderkey")
    cargo = F.when(k % 5 == 0, "DISCH. CNTR").when(k % 5 == 1, "coal").when(k % 5 == 2, "STEEL COIL").when(k % 5 == 3, F.when(k % 2 == 0, "Nil").otherwise(" 12 ")).otherwise("L.N.G")
    unit = F.when(k % 5 == 1, "?").when(k % 5 == 2, "Nos.").when(k % 5 == 3, "nos").otherwise("M/T")
    berth = F.when(k % 4 == 0, "QICT-VII").when(k % 4 == 1, "I.O.C.B").when(k % 4 == 2, "NEW PIER").otherwise("4-5")
    o = read_table(spark, d, "orders").select("o_orderkey", cargo.alias("cargo"), unit.alias("unit"), berth.alias("berth"))
    table = lambda rows: spark.createDataFrame(rows, "alias string, name string")
    out = names.canon_cargo(o, table([("cntr", "Containers"), ("COAL", "Coal"), ("L N G", "LNG")]), table([("NOS", "number"), ("M T", "metric ton")]), {"Containers": "teu", "LNG": "cubic metre"}, ["NIL"])
    return names.canon_vocabulary(out, "berth", table([("QICT", "Qasim Container Terminal"), ("I O C B", "Coal Berth")]), "terminal", names.BERTH).select("o_orderkey", "commodity", "measure", "terminal")
