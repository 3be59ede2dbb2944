"""Product names, titles, codes of securities and port words by cases."""

import datetime as dt

import duckdb
from pyspark.sql import functions as F

from ledgerline.operators import names, trade_names
from ledgerline.plans import registry

RULES = [(None, "leath", "leather"), (None, "buffal", "buffalo"), (None, "tann", "tanned"), (None, "oth", "other"), (None, "wov", "woven"), (None, "fab", "fabrics"), (None, "art", "artificial"), (None, "fil", "filament"), (None, "i/s", "iron/steel"), (None, "ns", "n.e.s.")]
RULES += [(None, "fr", "fresh"), (None, "chl", "chloride"), ("72", "fr", "flat-rolled"), (None, "i/na-s", "iron/non-alloy steel"), (None, "p/c", "plated or coated"), ("72", "s-q", "secondary quality"), ("03", "chl", "chilled"), ("03", "lvr", "livers"), ("03", "fre", "fresh"), (None, "h.r", "hot-rolled"), (None, "h.r.", "hot-rolled"), (None, "tv", "TV")]


def test_abbreviations_by_chapter_and_longest_phrase(spark):
    cases = [
        ("41000000", "LEATH BUFFAL HIDES,TANN,FINISH", "Leather buffalo hides, tanned, finish"),
        ("54000000", "OTH WOV FAB ART.FIL YARN", "Other woven fabrics artificial filament yarn"),
        ("73000000", "OTHER TUBES & PIPES I/S,NS", "Other tubes and pipes iron/steel, n.e.s."),
        ("72000000", "FR I/NA-S ELECTRO P/C ZINC S-Q", "Flat-rolled iron/non-alloy steel electro plated or coated zinc secondary quality"),
        ("03000000", "COD FISH EXCL LVR/ROES FRE/CHL", "Cod fish excl livers/roes fresh/chilled"),
        ("28000000", "AMMONIUM CHL (FR)OTH", "Ammonium chloride (fresh) other"),
        ("85000000", "H.R. COIL FRESHLY TV SETS ;", "Hot-rolled coil freshly TV sets"),
        ("85000000", "", ""),
        ("85000000", None, None),
        (None, "FR", "Fresh"),
    ]
    df = spark.createDataFrame([(c, n) for c, n, _ in cases] * 2, "code string, name string")
    got = trade_names.expand_abbrev(df, RULES).collect()
    assert sorted((str(r.code), str(r.name), str(r.short_name)) for r in got) == sorted((str(c), str(n), str(s)) for c, n, s in cases * 2)
    assert trade_names.expand_abbrev(df.limit(0), RULES).count() == 0


def test_official_names_follow_the_tree(spark):
    refs = [(1, "28", "28 text", "TOTAL"), (1, "2815", "Sodium hydroxide (caustic soda)", "28"), (1, "281511", "- solid", "2815"), (1, "281512", "-- - Other", "2815"), (2, "281511", "old", None), (2, "292242", "Glutamic acid", "9999"), (1, "50", "- lost", "49"), (1, "500000", "-- deep", "50"), (1, "600000", "Other things", None)]
    codes = [("28151100", "Sodium hydroxide solid"), ("28151190", "My lye"), ("29224200", "x"), ("28151200", "y"), ("50000000", "z"), ("60000000", "things"), ("7000", "none")]
    got = trade_names.official_names(spark.createDataFrame(codes, "code string, short_name string"), spark.createDataFrame(refs, "edition int, code string, text string, parent string"))
    rows = {r.code: (r.heading, r.edition, r.display_name) for r in got.collect()}
    assert rows["28151100"] == ("Sodium hydroxide (caustic soda); solid", 1, "Sodium hydroxide (caustic soda); solid")
    assert rows["28151190"] == ("Sodium hydroxide (caustic soda); solid", 1, "My lye")
    assert rows["29224200"] == ("Glutamic acid", 2, "Glutamic acid")
    assert rows["28151200"][0] == "Sodium hydroxide (caustic soda); - Other"
    assert rows["50000000"][0] == "lost; deep" and rows["60000000"] == ("Other things", 1, "things") and rows["7000"] == (None, None, "none")


def test_of_an_editions_texts_of_one_code_the_deepest_then_the_first_counts(spark):
    refs = [(1, "2815", "Soda", "28", 0), (1, "281511", "- solid", "2815", 5), (1, "281511", "- flakes", "2815", 7), (1, "281512", "Absolute", "2815", 1), (1, "281512", "- wet", "2815", 2)]
    for rows in (refs, refs[::-1]):
        df = spark.createDataFrame(rows, "edition int, code string, text string, parent string, seq int").coalesce(1)
        got = trade_names.official_names(spark.createDataFrame([("28151100", "x"), ("28151200", "y")], "code string, short_name string"), df, seq="seq")
        assert {r.code: r.heading for r in got.collect()} == {"28151100": "Soda; solid", "28151200": "Soda; wet"}


def test_parts_that_share_a_code_are_named_by_the_first(spark, tmp_path):
    rows = [(n + k * 1_000_000, f"{'zyx'[k]}{n} bolt", 7 + k) for k in (0, 1, 2) for n in range(40)]
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_size long").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    duck = duckdb.connect(config={"threads": 1})
    duck.execute(f"create view part as select * from '{tmp_path}/part.parquet/*.parquet'")
    got, cur = registry.queries()["official_name"](spark, str(tmp_path)), duck.execute(registry.oracle_sql()["official_name"])
    want = cur.fetchall()
    assert sorted(map(tuple, got.select([c[0] for c in cur.description]).collect())) == sorted(want)
    assert not any(" bolt" in r[2] and not r[2].rsplit("; ")[-1].removeprefix("mixed with ").startswith("z") for r in want)


def test_titles(spark):
    cases = [("Cotton; not carded or combed", "Cotton, not carded or combed"), ("Petroleum oils (other (crude)); x" + "y" * 80, "Petroleum oils"), (None, ""), ("(all gone)", "(all gone)"), ("Suits, ensembles, jackets, blazers, trousers, bib and brace overalls, shorts; men's or boys'", "Suits, ensembles, jackets, blazers, trousers, men's or boys'"), ("a" * 90, "a" * 70)]
    got = [r.s for r in spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "i int, t string").orderBy("i").select(trade_names.short_title(F.col("t")).alias("s")).collect()]
    assert got == [w for _, w in cases]


def test_three_schemes_give_one_security(spark):
    rows = [
        ("GOPIS-8-06-10-2026", "GIS (FRR) -08", None, ["99.58", "0.1x"]),
        ("gopisf-6-10-2026", None, None, ["98", "99", "-"]),
        ("GOPIS FRR", None, "6-Oct-26", ["1,000.5", "99.9"]),
        ("GOPIS FRR", None, "2026-10-06", ["43251"]),
        ("GOPIS-8-06-10-2026", "no kind", None, ["99"]),
        ("GOPISV-31-02-2026", None, None, ["99"]),
        ("GOPIS-8-06-10-2026", "GIS (VRR)", None, ["99"]),
        (None, None, None, None),
    ]
    got = trade_names.resolve_securities(spark.createDataFrame(rows, "code string, alternative string, maturity string, quotes array<string>"))
    assert [(r.canonical, r.price, r.reason) for r in got.collect()] == [
        ("GOPIS-FRR-2026-10-06", 99.58, None), ("GOPIS-FRR-2026-10-06", 99.0, None), ("GOPIS-FRR-2026-10-06", 99.9, None), ("GOPIS-FRR-2026-10-06", 43251.0, "price out of bounds"),
        (None, 99.0, "unknown code"), (None, 99.0, "unknown code"), ("GOPIS-VRR-2026-10-06", 99.0, None), (None, None, "unknown code"),
    ]
    assert got.filter("canonical = 'GOPIS-FRR-2026-10-06'").first().maturity_date == dt.date(2026, 10, 6)
    assert [(r.code, r.canonicals) for r in trade_names.security_conflicts(got).collect()] == [("GOPIS-8-06-10-2026", ["GOPIS-FRR-2026-10-06", "GOPIS-VRR-2026-10-06"])]


def test_port_words(spark):
    table = lambda rows: spark.createDataFrame(rows, "alias string, name string")
    rows = [("DISCH LOAD CNTRS", "x"), ("coal", "M/T"), ("NIL", "nos"), ("77", ""), ("PALM KERNEL", ""), (None, None)]
    got = names.canon_cargo(spark.createDataFrame(rows, "cargo string, unit string"), table([("CNTRS", "Containers"), ("COAL", "Coal")]), table([("NOS", "number"), ("M T", "metric ton")]), {"Containers": "teu"}, ["NIL"])
    assert sorted((str(r.cargo), r.commodity, r.measure) for r in got.collect()) == [("77", None, None), ("DISCH LOAD CNTRS", "Containers", "teu"), ("NIL", None, "number"), ("None", None, None), ("PALM KERNEL", "Palm Kernel", "metric ton"), ("coal", "Coal", "metric ton")]
