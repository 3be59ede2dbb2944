"""Tariff editions and schedules: duties by component, printed codes, additional duties, and checks of printed totals."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.operators.facts import top_n_per_group


def parse_rate(text: Column) -> Column:
    """A plain percentage as a number, else null (the text is kept beside it)."""
    t = F.trim(text)
    return F.when(t.rlike(r"^\d+(\.\d+)?\s*%?$"), F.regexp_extract(t, r"^(\d+(?:\.\d+)?)", 1).try_cast("double"))


#: Shapes of printed codes, by kind; eight and four digits may stand without a dot.
SHAPES = {"code": r"^\d{4}\.?\d{4}$", "subheading": r"^\d{4}\.\d{2}$", "heading": r"^\d{2}\.?\d{2}$"}
DOTTED, JOINERS = r"^\d{4}\.\d{4}$", ["to", "-", "–"]


def printed_codes(text: Column) -> Column:
    """array<struct<kind, lo, hi>> of the codes in free text: ranges of dotted 8-digit codes (joined by `to` or a dash), then
    codes (dddd.dddd or eight digits), subheadings (dddd.dd) and headings (dd.dd or four digits).

    The text is cut into runs of digits and dots, dashes and words; a run counts as a whole, so that no code is read out of a
    longer number. A space behind the dot of a code is let go first."""
    joined = F.regexp_replace(text, r"(?<=\b\d{4}\.)\s(?=\d{4}\b)", "")
    toks = F.regexp_extract_all(joined, F.lit(r"(?<![\d.])\d+(?:\.\d+)*|[-–]|[^\s\d–-]+"), F.lit(0))
    tok = lambda i: F.get(toks, i)
    spans = lambda i: F.coalesce((i >= 0) & tok(i).rlike(DOTTED) & tok(i + 1).isin(*JOINERS) & tok(i + 2).rlike(DOTTED), F.lit(False))
    opens = lambda i: spans(i) & ~spans(i - 2)
    bare = lambda c: F.replace(c, F.lit("."), F.lit(""))
    entry = lambda kind, lo, hi: F.struct(F.lit(kind).alias("kind"), bare(lo).alias("lo"), bare(hi).alias("hi"))
    at = F.filter(F.sequence(F.lit(-1), F.size(toks) - 1), lambda i: i >= 0)
    out = [F.transform(F.filter(at, opens), lambda i: entry("range", tok(i), tok(i + 2)))]
    for kind, shape in SHAPES.items():
        own = F.filter(at, lambda i: tok(i).rlike(shape) & ~opens(i) & ~opens(i - 2))  # noqa: B023
        out.append(F.transform(own, lambda i: entry(kind, tok(i), tok(i))))  # noqa: B023
    return F.concat(*out)


def excepted_codes(text: Column) -> Column:
    """Codes named anywhere behind the word `except` or `excluding`, on later lines too, as digit prefixes."""
    behind = F.regexp_extract(F.lower(text), r"(?s)\b(?:except|excluding)\b(.*)", 1)
    return F.transform(F.regexp_extract_all(behind, F.lit(r"\b(?:\d{2}\.\d{2}|\d{4}\.\d{2}(?:\d{2})?)\b"), F.lit(0)), lambda c: F.replace(c, F.lit("."), F.lit("")))


def tariff_with_duties(tariff: DataFrame, duties: DataFrame) -> DataFrame:
    """Each line of an edition with its duty components as one map."""
    pair = F.struct("component", F.struct("rate_pct", "rate_text").alias("duty"))
    folded = duties.groupBy("code", "fy").agg(F.map_from_entries(F.array_sort(F.collect_list(pair))).alias("duties"))
    return tariff.join(folded, ["code", "fy"], "left")


def concession_vs_tariff(concessions: DataFrame, duties: DataFrame) -> DataFrame:
    """Concessions beside the code's normal customs duty of that year."""
    normal = duties.filter("component = 'cd'").select("code", "fy", F.col("rate_pct").alias("normal_pct"), F.col("rate_text").alias("normal_text"))
    return concessions.join(normal, ["code", "fy"], "left")


def schedule_codes(entries: DataFrame, codes: DataFrame, key: list[str]) -> DataFrame:
    """Entries of a schedule with their codes as one sorted array."""
    return entries.join(codes.groupBy(*key).agg(F.sort_array(F.collect_set("code")).alias("codes")), key, "left")


#: Chapters of special procedures, which name no product codes.
SPECIAL_CHAPTERS = ["98", "99"]


def expand_entries(entries: DataFrame, tariff: DataFrame) -> tuple[DataFrame, DataFrame]:
    """entries (entry, fy, item, text) and tariff (fy, code) -> (matches, rejects).

    matches: every code of that year's tariff that an entry's printed code, subheading, heading or range covers, each once
    for an entry with the item that names it first. rejects: printed tokens that meet no code. Prefixes are joined by
    equality, one length at a time; a range is first brought to the chapters it touches, so it is no cross join."""
    tokens = entries.select("entry", "fy", "item", F.posexplode(printed_codes(F.col("text"))).alias("place", "t")).select("entry", "fy", "item", "place", "t.*")
    tokens = tokens.filter(~F.substring("lo", 1, 2).isin(*SPECIAL_CHAPTERS))
    hits = [tokens.filter((F.col("kind") != "range") & (F.length("lo") == n)).join(tariff.select("fy", "code", F.substring("code", 1, n).alias("lo")), ["fy", "lo"]) for n in (4, 6, 8)]
    chapter = F.explode(F.transform(F.sequence(F.substring("lo", 1, 2).cast("int"), F.substring("hi", 1, 2).cast("int")), lambda c: F.lpad(c.cast("string"), 2, "0")))
    wide = tokens.filter("kind = 'range' and lo <= hi").withColumn("chapter", chapter)
    spans = wide.join(tariff.withColumn("chapter", F.substring("code", 1, 2)), ["fy", "chapter"]).filter(F.col("code").between(F.col("lo"), F.col("hi")))
    cols = ["entry", "fy", "item", "place", "kind", "lo", "hi", "code"]
    every = reduce(DataFrame.unionByName, [h.select(cols) for h in [*hits, spans]])
    first = top_n_per_group(every, ["entry", "fy", "code"], [F.col("item"), F.col("place"), F.col("lo")], 1).drop("place")
    rejects = tokens.join(every.select("entry", "fy", "item", "kind", "lo", "hi").distinct(), ["entry", "fy", "item", "kind", "lo", "hi"], "left_anti").select("entry", "fy", "kind", "lo", "hi").distinct()
    return first.select("entry", "fy", "item", "kind", "lo", "hi", "code"), rejects


def regulatory_duty(entries: DataFrame, codes: DataFrame) -> DataFrame:
    """entries (entry, fy, printed digits, description, rate_pct, rate_text), codes (fy, code) -> the duty of each code: the
    entries with the longest printed prefix, without codes their descriptions except. Entries of one level that disagree
    give a text of all rates, each with its description; entries without a rate are passed over."""
    rated = entries.filter("rate_pct is not null or rate_text is not null")
    hits = [rated.filter(F.length("printed") == n).join(codes.select("fy", "code", F.substring("code", 1, n).alias("printed")), ["fy", "printed"]) for n in (2, 4, 6, 8)]
    every = reduce(DataFrame.unionByName, hits)
    spared = F.exists(excepted_codes(F.col("description")), lambda x: F.col("code").startswith(x) & x.startswith(F.col("printed")) & (x != F.col("printed")))
    kept = every.filter(~F.coalesce(spared, F.lit(False)) | (F.length("printed") == 8))
    level = kept.withColumn("best", F.max(F.length("printed")).over(Window.partitionBy("fy", "code"))).filter(F.length("printed") == F.col("best"))
    shown = F.coalesce("rate_text", F.concat(F.format_string("%.1f", "rate_pct"), F.lit("%")))
    said = F.array_sort(F.collect_list(F.struct("entry", F.concat(shown, F.lit(" ("), F.coalesce("description", F.lit("")), F.lit(")")).alias("said"))))
    g = level.groupBy("fy", "code").agg(F.countDistinct(F.coalesce(F.col("rate_pct").cast("string"), F.lit("-")), F.coalesce("rate_text", F.lit("-"))).alias("rates"), F.max(F.struct("entry", "rate_pct", "rate_text")).alias("last"), said.alias("all"))
    one = F.col("rates") == 1
    return g.select("fy", "code", F.when(one, F.col("last.rate_pct")).alias("rate_pct"), F.when(one, F.col("last.rate_text")).otherwise(F.concat_ws("; ", F.transform("all", lambda x: x["said"]))).alias("rate_text"))


def _under(df: DataFrame, prefixes: DataFrame, flag: str) -> DataFrame:
    """df with a flag: whether one of the year's prefixes (fy, prefix) begins the code. One equality join per length."""
    known = [F.substring("code", 1, n) for n in (2, 4, 6, 8)]
    keyed = df.select("fy", "code", F.explode(F.array(*known)).alias("prefix")).join(prefixes.select("fy", "prefix").distinct(), ["fy", "prefix"]).select("fy", "code", F.lit(True).alias(flag)).distinct()
    return df.join(keyed, ["fy", "code"], "left").withColumn(flag, F.coalesce(flag, F.lit(False)))


def additional_duty(cd: DataFrame, exempt: DataFrame, listed: DataFrame, slabs: DataFrame, special: DataFrame) -> DataFrame:
    """The additional duty of each code from its customs duty, first rule that applies: an exempt prefix pays none; a listed
    code pays its own rate; a specific duty pays the special rate for those; a base rate in a slab pays the slab's; a
    higher base pays the rate for higher ones.

    cd (fy, code, rate_pct, rate_text); exempt (fy, prefix); listed (fy, code, listed_pct); slabs (fy, base, slab_pct);
    special (fy, specific_pct, higher_from, higher_pct). The rule tables hold a few rows a year."""
    j = _under(cd, exempt, "exempt").join(listed, ["fy", "code"], "left").join(slabs.select("fy", F.col("base").alias("rate_pct"), "slab_pct"), ["fy", "rate_pct"], "left").join(special, "fy", "left")
    by_base = F.coalesce("slab_pct", F.when(F.col("rate_pct") >= F.col("higher_from"), F.col("higher_pct")))
    duty = F.when(F.col("exempt"), None).otherwise(F.coalesce("listed_pct", F.when(F.col("rate_pct").isNull(), F.when(F.col("rate_text").isNotNull(), F.col("specific_pct"))).otherwise(by_base)))
    return j.select("fy", "code", "rate_pct", duty.alias("acd_pct"))


def duty_range(duties: DataFrame) -> DataFrame:
    """Per heading and year: codes, least and largest customs duty, and how many are specific duties."""
    cd = duties.filter("component = 'cd'")
    return cd.groupBy(F.substring("code", 1, 4).alias("heading"), "fy").agg(F.count(F.lit(1)).alias("codes"), F.min("rate_pct").alias("min_pct"), F.max("rate_pct").alias("max_pct"), F.count_if(F.col("rate_pct").isNull() & F.col("rate_text").isNotNull()).alias("specific"))


def schedule_editions(entries: DataFrame) -> DataFrame:
    """Entries of each edition by schedule."""
    return entries.groupBy("fy", "schedule").agg(F.count(F.lit(1)).alias("n_entries"), F.countDistinct("tbl").alias("n_tables"))


def schedule_spans(entries: DataFrame, codes: DataFrame) -> DataFrame:
    """Per entry place (schedule, table, serial): editions, first and last year, different codes over all of them, and
    whether the newest edition still has it."""
    key = ["schedule", "tbl", "serial"]
    newest = entries.agg(F.max("fy").alias("newest"))
    spans = entries.groupBy(*key).agg(F.countDistinct("fy").alias("editions"), F.min("fy").alias("first_fy"), F.max("fy").alias("last_fy"))
    n = codes.groupBy(*key).agg(F.countDistinct("code").alias("n_codes"))
    return spans.join(n, key, "left").join(F.broadcast(newest), how="cross").select(*key, "editions", "first_fy", "last_fy", F.coalesce("n_codes", F.lit(0)).alias("n_codes"), (F.col("last_fy") == F.col("newest")).alias("in_latest"))


def reconcile_totals(trade: DataFrame, totals: DataFrame) -> DataFrame:
    """Partner lines against the printed total line of each (flow, fy, code): apart by more than the rounding of the lines
    (1 and a half for each) and more than 0.2 %."""
    sums = trade.groupBy("flow", "fy", "code").agg(F.sum("value").alias("parts"), F.count(F.lit(1)).alias("lines"))
    room = F.greatest(1 + 0.5 * F.col("lines"), 0.002 * F.abs("total"))
    return totals.join(sums, ["flow", "fy", "code"]).withColumn("gap", F.col("parts") - F.col("total")).filter(F.abs("gap") > room)


def check_group_totals(rows: DataFrame, printed: DataFrame, key: list[str], tolerance: float = 0.0) -> DataFrame:
    """Rows with checks_ok: whether their group's count equals what is printed for it (null where nothing is printed)."""
    sums = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    verdict = sums.join(printed, key, "left").select(*key, (F.abs(F.col("n") - F.col("printed")) <= tolerance).alias("checks_ok"))
    return rows.join(verdict, key)


def failed_columns(rows: DataFrame, totals: DataFrame, columns: list[str], identities: dict[str, Column], tolerance: float = 1.0) -> DataFrame:
    """Columns whose figures do not add up, with the reason: a row identity that fails (column -> the difference that should
    be zero), or a zone whose rows do not sum to its printed total. rows: (zone, columns); totals: (zone, columns)."""
    bad = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), (F.abs(gap) > tolerance).alias("bad")) for c, gap in identities.items()]))
    by_row = rows.select(bad.alias("b")).filter("b.bad").groupBy(F.col("b.column").alias("column")).agg(F.count(F.lit(1)).alias("n")).withColumn("reason", F.lit("row identity"))
    long = lambda df, name: df.unpivot(["zone"], columns, "column", name)
    sums = long(rows, "v").groupBy("zone", "column").agg(F.sum(F.coalesce("v", F.lit(0.0))).alias("summed"))
    off = long(totals, "total").join(sums, ["zone", "column"]).filter(F.col("total").isNull() | (F.abs(F.col("summed") - F.col("total")) > tolerance))
    by_zone = off.groupBy("column").agg(F.count(F.lit(1)).alias("n")).withColumn("reason", F.lit("zone total"))
    return by_row.unionByName(by_zone)


def merge_edition(prints: DataFrame) -> DataFrame:
    """Several files of one edition, prints (fy, code, file_no, seq, description, component, rate_pct, rate_text): within a
    file a code's first printing with a rate counts, a later file overrides the description and that one component only."""
    rated = prints.filter("rate_pct is not null or rate_text is not null")
    first = top_n_per_group(rated, ["fy", "code", "component", "file_no"], [F.col("seq")], 1).drop("place")
    duty = top_n_per_group(first, ["fy", "code", "component"], [F.desc("file_no")], 1).select("fy", "code", "component", "rate_pct", "rate_text")
    words = first.groupBy("fy", "code").agg(F.max(F.struct("file_no", F.negative("seq").alias("n"), "description"))["description"].alias("description"))
    return duty.join(words, ["fy", "code"])


def sync_components(stored: DataFrame, incoming: DataFrame, owned: list[str]) -> DataFrame:
    """The duties after a job's run: components it owns become what it printed (others of that edition go), components of
    other jobs and editions it did not print stay. A duty is its rate and its text. `action`: new, changed, same, deleted or kept."""
    key = ["code", "fy", "component"]
    fresh = incoming.filter(F.col("component").isin(*owned))
    years = fresh.select("fy").distinct().withColumn("printed_year", F.lit(True))
    duty = F.struct("rate_pct", "rate_text")
    s = stored.select(*key, duty.alias("old"), F.lit(True).alias("in_store"))
    j = s.join(fresh.select(*key, duty.alias("new"), F.lit(True).alias("in_batch")), key, "full_outer").join(years, "fy", "left")
    mine = F.col("component").isin(*owned) & F.coalesce("printed_year", F.lit(False))
    action = F.when(F.col("in_store").isNull(), "new").when(F.col("in_batch").isNull() & mine, "deleted").when(F.col("in_batch").isNull(), "kept").when(F.col("old").eqNullSafe(F.col("new")), "same").otherwise("changed")
    return j.withColumn("action", action).select(*key, F.when(F.col("in_batch").isNull(), F.col("old")).otherwise(F.col("new")).alias("duty"), "action").select(*key, "duty.rate_pct", "duty.rate_text", "action")


def too_few_rows(df: DataFrame, key: str, least: int) -> DataFrame:
    """Editions with fewer rows than a layout that was read whole would have."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") < least)


def min_rows_gate(df: DataFrame, key: str, least: int) -> DataFrame:
    """The rows, or an error that names an edition with too few of them."""
    bad = too_few_rows(df, key, least).orderBy(key).first()
    if bad:
        raise ValueError(f"{key} {bad[0]}: {bad['n']} rows, at least {least} expected")
    return df


def dedupe_first_known(rows: DataFrame, tariff: DataFrame, key: list[str], seq: str) -> tuple[DataFrame, DataFrame]:
    """(kept, rejected): the first printing of each key whose code is in that year's tariff; printings of other codes."""
    known = tariff.select("code", "fy").distinct()
    first = top_n_per_group(rows.join(known, ["code", "fy"], "left_semi"), key, [F.col(seq)], 1).drop("place")
    return first, rows.join(known, ["code", "fy"], "left_anti")
