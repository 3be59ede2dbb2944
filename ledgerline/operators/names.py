"""Names as sources write them and as registries have them: aliases, legal suffixes, details, near spellings."""

from __future__ import annotations

import difflib
import hashlib
import hmac

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.functions.text import name_key, title_case
from ledgerline.session import scratch_dir

#: Legal forms at the end of a name, and roman numbers of units.
LEGAL = r"(privatelimited|pvtlimited|pvtltd|private|limited|pvt|ltd|company|co)+$"
ROMANS = {"I": "1", "II": "2", "III": "3", "IV": "4", "V": "5"}


def canonical(df: DataFrame, column: str, registry: DataFrame, to: str = "canonical") -> DataFrame:
    """(alias, name) -> each spelling with its registered name: by its key, else by its key without a legal form, else the
    spelling itself, tidied. Two equality joins with a registry that is small by nature."""
    known = registry.select(name_key(F.col("alias")).alias("k"), F.col("name").alias("found")).dropDuplicates(["k"])
    short = registry.select(F.regexp_replace(name_key(F.col("alias")), LEGAL, "").alias("k2"), F.col("name").alias("found2")).filter("k2 <> ''").groupBy("k2").agg(F.min("found2").alias("found2"))
    key = name_key(F.col(column))
    j = df.withColumn("k", key).withColumn("k2", F.regexp_replace(key, LEGAL, "")).join(known, "k", "left").join(short, "k2", "left")
    return j.withColumn(to, F.coalesce("found", "found2", title_case(F.col(column)))).drop("k", "k2", "found", "found2")


def vocabulary_key(raw: Column) -> Column:
    """A printed word's letters and digits in capitals, with single spaces for all else."""
    return F.trim(F.regexp_replace(F.upper(F.coalesce(raw, F.lit(""))), "[^A-Z0-9]+", " "))


#: What stands before a cargo's name as the work done with it, and behind a terminal's name as the berth's number.
WORK = r"^(?:DIS|DISC|DISCH|DISCHARGE|LOAD|LOADING)\s+(?:LOAD\s+)?"
BERTH = r"\s+(?:[IVX]+|\d+)$"


def canon_vocabulary(df: DataFrame, column: str, vocabulary: DataFrame, to: str, strip: str, nothing: list[str] = ()) -> DataFrame:
    """(alias, name) -> the name of each printed word in `to`: by its key, else by its key without `strip`, else the word itself,
    tidied. Words of `nothing`, numbers alone, blanks and nulls name nothing. Two equality joins with the vocabulary."""
    known = vocabulary.select(vocabulary_key(F.col("alias")).alias("_k"), F.col("name").alias("_n")).groupBy("_k").agg(F.min("_n").alias("_n"))
    key = vocabulary_key(F.col(column))
    j = df.withColumn("_key", key).withColumn("_short", F.regexp_replace(key, strip, ""))
    j = j.join(known.select(F.col("_k").alias("_key"), F.col("_n").alias("_whole")), "_key", "left").join(known.select(F.col("_k").alias("_short"), F.col("_n").alias("_part")), "_short", "left")
    none = (F.col("_key") == "") | F.col("_key").rlike(r"^[\d ]+$") | F.col("_key").isin(*nothing)
    return j.withColumn(to, F.when(~none, F.coalesce("_whole", "_part", title_case(F.col(column))))).drop("_key", "_short", "_whole", "_part")


def canon_cargo(df: DataFrame, vocabulary: DataFrame, units: DataFrame, fixed: dict[str, str], nothing: list[str] = (), default: str = "metric ton") -> DataFrame:
    """(cargo, unit) as printed, with `commodity` and `measure`: the work before a cargo's name goes; a commodity that is always
    counted in one unit has that, else what is printed by the units' vocabulary, else the default. What names no commodity
    keeps its printed unit, if that is known."""
    named = canon_vocabulary(df, "cargo", vocabulary, "commodity", WORK, nothing)
    known = units.select(vocabulary_key(F.col("alias")).alias("_u"), F.col("name").alias("_unit")).groupBy("_u").agg(F.min("_unit").alias("_unit"))
    j = named.withColumn("_u", vocabulary_key(F.col("unit"))).join(known, "_u", "left")
    own = F.coalesce(*[F.when(F.col("commodity") == k, v) for k, v in fixed.items()], F.lit(None).cast("string"))
    return j.withColumn("measure", F.when(F.col("commodity").isNotNull(), F.coalesce(own, "_unit", F.lit(default))).otherwise(F.col("_unit"))).drop("_u", "_unit")


def split_details(raw: Column) -> Column:
    """struct<name, tranche, config, unit> of a plant's label: `(up to 200 MWh)`, `(CC)`, `Unit II`, `Block 3` behind the name."""
    s = F.trim(F.regexp_replace(raw, r"\s+", " "))
    tranche = F.regexp_extract(s, r"(?i)\(\s*(up\s*to|above)\s*[\d,]+\s*MWh\s*\)", 1)
    amount = F.regexp_extract(s, r"(?i)\(\s*(?:up\s*to|above)\s*([\d,]+)\s*MWh\s*\)", 1)
    config = F.regexp_extract(s, r"\(\s*(CC|OC)\s*\)", 1)
    unit = F.upper(F.regexp_extract(s, r"(?i)\b(?:unit|block|phase)\s*-?\s*(\d+|[IV]+)\b", 1))
    bare = F.trim(F.regexp_replace(F.regexp_replace(s, r"(?i)\((?:\s*(?:up\s*to|above)[^)]*|\s*(?:CC|OC)\s*)\)", ""), r"(?i)[\s,-]*\b(?:unit|block|phase)\s*-?\s*(?:\d+|[IV]+)\b", ""))
    numbers = F.create_map(*[F.lit(x) for pair in ROMANS.items() for x in pair])
    some = lambda c: F.when(c != "", c)
    level = F.when(amount != "", F.concat(F.when(F.lower(tranche) == "above", "above ").otherwise("up to "), amount, F.lit(" MWh")))
    return F.struct(bare.alias("name"), level.alias("tranche"), some(config).alias("config"), some(F.coalesce(F.try_element_at(numbers, unit), unit)).alias("unit"))


#: Texts this long or longer are met by pieces of three letters, shorter ones by pieces of two.
LONG = 12
LEAST_LIKENESS = 0.85


def likeness(a: Column, b: Column) -> Column:
    """Twice the matching characters over all characters, by blocks of them in the same order."""

    @F.pandas_udf("double")
    def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([difflib.SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b, strict=True)], dtype="float64")

    return ratio(a, b)


def _least_matching(a: Column, b: Column, least: float) -> Column:
    """Matching characters that two texts of these lengths need."""
    return F.ceil(least * (a + b) / 2 - 1e-9)


def _prefixes(texts: DataFrame, group: list[str], least: float) -> DataFrame:
    """(group, text) -> (group, text, q, piece): of each text so many of its rarest pieces that two texts alike share one.

    With M matching characters in B blocks at least M - (q - 1) B pieces of q characters are kept, and there are at most
    1 + (characters without a match) blocks. If two texts share at least T pieces, so do all but their T - 1 most frequent
    ones. T is taken for the least favourable length that the other text may have. Repeated pieces are numbered."""
    size = F.length("text")
    lo, hi = F.ceil(size * least / (2 - least) - 1e-9), F.floor(size * (2 - least) / least + 1e-9)
    t = texts.select(*group, "text").distinct().filter(F.length("text") > 2).withColumns({"lo": lo, "hi": hi})
    parts = []
    for q, wanted in ((2, (size < LONG) | (F.col("lo") < LONG)), (3, size >= LONG)):
        pieces = F.transform(F.sequence(F.lit(1), size - q + 1), lambda i: F.substring(F.col("text"), i, F.lit(q)))  # noqa: B023
        numbered = F.transform("p", lambda x, i: F.concat(x, F.size(F.filter(F.slice("p", 1, i), lambda y: y == x)).cast("string")))
        shared = F.array_min(F.transform(F.sequence("lo", "hi"), lambda n: (2 * q - 1) * _least_matching(size, n, least) - (q - 1) * (1 + size + n)))  # noqa: B023
        rows = t.filter(wanted).withColumn("p", pieces).withColumn("p", numbered).withColumn("keep", F.size("p") - F.greatest(shared, F.lit(1)) + 1)
        parts.append(rows.select(*group, "text", F.lit(q).alias("q"), "keep", F.explode("p").alias("piece")))
    every = parts[0].unionByName(parts[1])
    often = every.groupBy("q", "piece").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(*group, "text", "q").orderBy("n", "piece")
    return every.join(often, ["q", "piece"]).withColumn("place", F.row_number().over(w)).filter("place <= keep").select(*group, "text", "q", "piece")


def alike(left: DataFrame, right: DataFrame, group: list[str], least: float = LEAST_LIKENESS, before: Column | None = None) -> DataFrame:
    """(group, a, b, r): the different texts of left and right, (group, text), of one group whose likeness r is at least `least`
    (0.85 or more). Exact: candidates share one of their rarest pieces, fit by length and by edit distance, and are then
    compared. before: a test on pairs (a, b), applied to candidates."""
    if least < LEAST_LIKENESS:
        raise ValueError(f"pieces find pairs with a likeness of {LEAST_LIKENESS} or more")
    both = _prefixes(left.select(*group, "text").unionByName(right.select(*group, "text")), group, least)
    a = both.join(left.select(*group, "text").distinct(), [*group, "text"], "left_semi").withColumnRenamed("text", "a")
    b = both.join(right.select(*group, "text").distinct(), [*group, "text"], "left_semi").withColumnRenamed("text", "b")
    la, lb = F.length("a"), F.length("b")
    met = a.join(b, [*group, "q", "piece"]).filter((F.col("a") != F.col("b")) & ((F.col("q") == 3) | (F.least(la, lb) < LONG)))
    met = met.filter(before) if before is not None else met
    apart = (la + lb - 2 * _least_matching(la, lb, least)).cast("int")
    near = met.filter(2 * F.least(la, lb) >= least * (la + lb) - 1e-9).select(*group, "a", "b").distinct().filter(F.levenshtein("a", "b") <= apart)
    return near.withColumn("r", likeness(F.col("a"), F.col("b"))).filter(F.col("r") >= least)


def close_names(names: DataFrame, registry: DataFrame, cutoff: float = 0.86) -> DataFrame:
    """names (province, name) -> the registered name of the same province: by key where it is the same, else the closest by
    likeness, if that is at least the cutoff; of equally close ones the last by name. Only the distinct names without a key
    are compared."""
    known = registry.select("province", name_key(F.col("name")).alias("k"), F.col("name").alias("canonical")).dropDuplicates(["province", "k"])
    asked = names.select("province", "name").distinct().withColumn("k", name_key(F.col("name")))
    exact = asked.join(known, ["province", "k"]).select("province", "name", "canonical")
    rest = asked.join(known, ["province", "k"], "left_anti")
    text = lambda df: df.select("province", F.col("k").alias("text"))
    pairs = alike(text(known), text(rest), ["province"], cutoff).withColumnsRenamed({"a": "k", "b": "asked"})
    named = pairs.join(known, ["province", "k"]).groupBy("province", "asked").agg(F.max_by("canonical", F.struct("r", "canonical")).alias("canonical"))
    best = rest.join(named.withColumnRenamed("asked", "k"), ["province", "k"]).select("province", "name", "canonical")
    return exact.unionByName(best)


def hash_address(address: Column, salt: bytes, length: int = 16) -> Column:
    """Keyed and truncated HMAC-SHA256 of an address; empty for none."""

    @F.pandas_udf("string")
    def keyed(ip: pd.Series) -> pd.Series:
        return ip.map(lambda x: hmac.new(salt, x.encode(), hashlib.sha256).hexdigest()[:length] if isinstance(x, str) and x else "")

    return keyed(address)


def leaders(pairs: DataFrame, nodes: DataFrame, most_rounds: int = 200) -> DataFrame:
    """nodes (node) and pairs (node, above) -> (node, leader): a node is a leader if no node above it, of those it is paired
    with, is one; else its leader is the one of these with the smallest `place`. pairs: (node, above, place of above).

    In rounds: a node with a leader above it is none, a node above which all are decided and none leads is one. Every round
    decides the topmost open nodes at least, and writes what is decided."""
    spark = nodes.sparkSession
    folder = scratch_dir(spark)

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    pairs = kept(pairs.select("node", "above", "place"), "pairs")
    state = kept(nodes.select("node").join(pairs.select("node").distinct().withColumn("below", F.lit(True)), "node", "left").select("node", F.when(F.col("below").isNull(), True).alias("leads")), "0")
    for n in range(1, most_rounds + 1):
        if state.filter("leads is null").isEmpty():
            break
        above = pairs.join(state.select(F.col("node").alias("above"), "leads"), "above")
        seen = above.groupBy("node").agg(F.max(F.coalesce("leads", F.lit(False))).alias("led"), F.max(F.col("leads").isNull()).alias("open"))
        verdict = F.coalesce("leads", F.when(F.col("led"), False).when(~F.col("open"), True))
        state = kept(state.join(seen, "node", "left").select("node", verdict.alias("leads")), str(n))
    else:
        raise RuntimeError(f"undecided after {most_rounds} rounds")
    led = pairs.join(state.filter("leads").select(F.col("node").alias("above")), "above", "left_semi").groupBy("node").agg(F.min_by("above", "place").alias("leader"))
    return state.join(led, "node", "left").select("node", F.when(F.col("leads"), F.col("node")).otherwise(F.col("leader")).alias("leader"))


def cluster_spellings(reads: DataFrame, least: float = LEAST_LIKENESS, least_reads: int = 3) -> DataFrame:
    """reads (name) -> (name, n, canonical): spellings of one thing. Names with the same details (unit numbers, configuration)
    are compared by their keys, in which often misread characters are one: a key follows the most frequent leading key that
    it is like, or leads itself; equally frequent keys go by the alphabet. Of a cluster's spellings with at least a tenth of
    its reads, and two, the one with most spaces stands for it, then the most frequent; of none such, any. Clusters read
    fewer than least_reads times are left out. Null names are none."""
    tag = F.array_join(F.array_sort(F.regexp_extract_all(F.lower("name"), F.lit(r"(\(cc\)|\(oc\)|\(hsd\)|unit\s*-?\s*\d+|upto|above)"), F.lit(1))), "|")
    names = reads.filter("name is not null").groupBy("name").agg(F.count(F.lit(1)).alias("n")).withColumn("sign", F.regexp_replace(tag, r"[\s-]", ""))
    names = names.withColumn("k", F.translate(name_key(F.col("name")), "l10", "iio"))
    keys = names.groupBy("sign", "k").agg(F.sum("n").alias("reads"))
    node, text = F.struct("sign", "k"), keys.select("sign", F.col("k").alias("text"))
    place = F.struct(F.negative("reads").alias("less"), "k")
    pairs = alike(text, text, ["sign"], least)
    below = keys.select("sign", F.col("k").alias("a"), place.alias("own"))
    over = keys.select("sign", F.col("k").alias("b"), place.alias("place"))
    ranked = pairs.join(below, ["sign", "a"]).join(over, ["sign", "b"]).filter(F.col("place") < F.col("own"))
    ranked = ranked.select(F.struct("sign", F.col("a").alias("k")).alias("node"), F.struct("sign", F.col("b").alias("k")).alias("above"), "place")
    lead = leaders(ranked, keys.select(node.alias("node"))).select("node.sign", "node.k", F.col("leader.k").alias("head"))
    own = names.join(lead, ["sign", "k"])
    whole = own.groupBy("sign", "head").agg(F.sum("n").alias("whole")).filter(F.col("whole") >= least_reads)
    kept = own.join(whole, ["sign", "head"])
    often = F.col("n") >= F.greatest(F.lit(2), 0.1 * F.col("whole"))
    spaces = F.length("name") - F.length(F.replace("name", F.lit(" "), F.lit("")))
    best = kept.groupBy("sign", "head").agg(F.max_by("name", F.struct(often, spaces, "n", "name")).alias("canonical"))
    return kept.join(best, ["sign", "head"]).select("name", "n", "canonical")


def scheduled_releases(rules: DataFrame, today: Column, days: int = 120) -> DataFrame:
    """(indicator, kind, param) -> release days of the next days: weekly on a weekday (0 is Monday), or monthly on a day (the
    28th in a month that is too short)."""
    d = rules.withColumn("release_date", F.explode(F.sequence(today, F.date_add(today, days))))
    weekly = (F.col("kind") == "weekly") & (F.weekday("release_date") == F.col("param"))
    day = F.when(F.col("param") <= F.dayofmonth(F.last_day("release_date")), F.col("param")).otherwise(28)
    return d.filter(weekly | ((F.col("kind") == "monthly_day") & (F.dayofmonth("release_date") == day))).select("indicator", "release_date")
