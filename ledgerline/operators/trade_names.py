"""Readable product names: abbreviations written out, official texts joined along the code tree, titles, security codes."""

from __future__ import annotations

import re
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A word, a single mark, or white space: what a name is cut into.
PARTS = re.compile(r"[^\W_]+(?:'[^\W_]+)?|\s+|[^\w\s]|_")


class PhraseTrie:
    """Phrases by their parts; a match is the longest phrase that begins at a part. Phrases of a chapter go before general ones,
    even if shorter."""

    END = ""

    def __init__(self, rules: list[tuple[str | None, str, str]]):
        self.general: dict = {}
        self.chapters: dict[str, dict] = {}
        for chapter, phrase, meaning in rules:
            at = self.general if chapter is None else self.chapters.setdefault(chapter, {})
            for part in PARTS.findall(phrase.lower()):
                at = at.setdefault(part, {})
            at[self.END] = meaning

    def longest(self, root: dict, parts: list[str], begin: int) -> tuple[int, str | None]:
        end, meaning, at, i = begin, None, root, begin
        while i < len(parts) and (at := at.get(parts[i])) is not None:
            i += 1
            # a phrase ends where a word ends
            if self.END in at:
                end, meaning = i, at[self.END]
        return end, meaning

    def rewrite(self, text: str, chapter: str) -> str:
        parts = PARTS.findall(text.strip().lower())
        own = self.chapters.get(chapter)
        out, i = [], 0
        while i < len(parts):
            end, meaning = self.longest(own, parts, i) if own else (i, None)
            if meaning is None:
                end, meaning = self.longest(self.general, parts, i)
            out.append(parts[i] if meaning is None else meaning)
            i = max(end, i + 1)
        return self.spaced(out)

    @staticmethod
    def spaced(parts: list[str]) -> str:
        """One space behind commas, words for `&`, brackets apart from words, a dot between two longer words as a space."""
        out = ""
        for n, part in enumerate(parts):
            nxt = parts[n + 1] if n + 1 < len(parts) else ""
            word = out[-1:].isalpha()
            if part == ",":
                out = out.rstrip() + ", "
            elif part == "&":
                out = out.rstrip() + " and "
            elif part == "(" and word:
                out += " ("
            elif part == ")" and nxt[:1].isalpha():
                out += ") "
            elif part == "." and re.search(r"[^\W\d_]{3}$", out) and re.match(r"[^\W\d_]{3}", nxt):
                out += " "
            else:
                out += part
        return re.sub(r"\s+", " ", out).strip(" ,;")


def expand_abbrev(names: DataFrame, rules: list[tuple[str | None, str, str]], most_rules: int = 100_000) -> DataFrame:
    """names (code, name, ...) with `short_name`: each name's abbreviations written out by rules (chapter or None, phrase,
    meaning), from left to right, the longest phrase first, those of the code's first two digits before general ones. Text is
    in lower case but for meanings, which stay as given, and the first letter. Null names stay null.

    The rules travel to the tasks, so most_rules bounds them. Each different name of a chapter is rewritten once."""
    if len(rules) > most_rules:
        raise ValueError(f"{len(rules)} rules; at most {most_rules} are sent to every task")
    trie = PhraseTrie(rules)

    @F.pandas_udf("string")
    def rewritten(name: pd.Series, chapter: pd.Series) -> pd.Series:
        return pd.Series([None if n is None else trie.rewrite(n, c or "") for n, c in zip(name, chapter, strict=True)], dtype=object)

    chapter = F.substring("code", 1, 2)
    each = names.select(F.col("name").alias("_name"), chapter.alias("_chapter")).distinct()
    text = rewritten("_name", "_chapter")
    done = each.withColumn("short_name", text).withColumn("short_name", F.concat(F.upper(F.substring("short_name", 1, 1)), F.substring("short_name", 2, 1_000_000)))
    return names.join(done, F.col("name").eqNullSafe(F.col("_name")) & chapter.eqNullSafe(F.col("_chapter")), "left").drop("_name", "_chapter")


#: What marks a text that continues its parent's.
RELATIVE = r"^[-.]+\s*"


def full_texts(refs: DataFrame, levels: int = 6) -> DataFrame:
    """refs (edition, code, text, parent, ...) -> (edition, code, ..., heading, depth): an absolute text as it stands, a relative
    one behind its parent's, up the tree until an absolute text or the root (a parent that is not there), `depth` levels
    above. One equality join for each of the tree's levels."""
    kept = [c for c in refs.columns if c not in ("text", "parent")]
    known = refs.select("edition", F.col("code").alias("_up"), F.trim("text").alias("_text"), F.col("parent").alias("_parent"))
    out = refs.select(*kept, F.col("parent").alias("_up"), F.array(F.trim("text")).alias("parts"))
    bare = lambda c: F.regexp_replace(c, RELATIVE, "")
    for _ in range(levels):
        head = F.col("parts")[0]
        own = F.concat(F.array(bare(head)), F.slice("parts", 2, F.size("parts")))
        goes = head.rlike(RELATIVE) & F.col("_text").isNotNull()
        step = out.withColumn("_up", F.when(F.col("parts")[0].rlike(RELATIVE), F.col("_up"))).join(known, ["edition", "_up"], "left")
        out = step.select(*kept, F.when(goes, F.col("_parent")).otherwise(F.col("_up")).alias("_up"), F.when(goes, F.concat(F.array("_text"), own)).otherwise(F.col("parts")).alias("parts"))
    whole = F.transform("parts", lambda p, i: F.when(i == 0, bare(p)).otherwise(p))
    return out.select(*kept, F.array_join(F.filter(whole, lambda p: p != ""), "; ").alias("heading"), (F.size("parts") - 1).alias("depth"))


def official_names(codes: DataFrame, refs: DataFrame, lengths: tuple[int, ...] = (6,), longest_name: int = 100, levels: int = 6, seq: str | None = None) -> DataFrame:
    """codes (code, short_name, ...) with `heading`, `edition` and `display_name`. The heading is the full text of the longest
    ancestor among the lengths, from its newest edition (the smallest number); it is the name of a code that has only zeros
    behind that ancestor, unless it is longer than longest_name or begins with `other`. Of an edition's several texts of one
    code the one from deepest in the tree counts, of these the first by seq, a column of refs, then by its words."""
    texts = full_texts(refs, levels).filter("heading <> ''").withColumn("length", F.length("code"))
    newest = texts.groupBy("code").agg(F.min(F.struct("edition", F.negative("depth").alias("depth"), *([seq] if seq else []), "heading", "length")).alias("t"))
    keys = codes.select("code").distinct().withColumn("ancestor", F.explode(F.array(*[F.when(F.length("code") >= n, F.substring("code", 1, n)) for n in lengths]))).filter("ancestor is not null")
    found = keys.join(newest.withColumnRenamed("code", "ancestor"), "ancestor").groupBy("code").agg(F.max_by(F.struct("t.edition", "t.heading", "ancestor"), "t.length").alias("h"))
    j = codes.join(found, "code", "left")
    rest = F.expr("substring(code, length(h.ancestor) + 1)")
    exact = (F.translate(rest, "0", "") == "") & (F.length("h.heading") <= longest_name) & ~F.col("h.heading").rlike(r"(?i)^other\b")
    return j.select(*codes.columns, F.col("h.heading").alias("heading"), F.col("h.edition").alias("edition"), F.when(exact, F.col("h.heading")).otherwise(F.col("short_name")).alias("display_name"))


def _cut(text: Column, most: Column) -> Column:
    """A text cut at the last comma that fits, else the last space, else anywhere."""
    head = F.substring(text, F.lit(1), most + 1)
    comma = F.regexp_extract(F.substring(text, F.lit(1), most), r"^(.+), ", 1)
    space = F.regexp_extract(F.substring(text, F.lit(1), most), r"^(.+) ", 1)
    cut = F.when(comma != "", comma).when(space != "", space).otherwise(F.substring(text, F.lit(1), most))
    return F.when(F.length(head) <= most, text).otherwise(F.regexp_replace(cut, r"^[ ,;]+|[ ,;]+$", ""))


def short_title(text: Column, most: int = 70, nested: int = 4, qualifier: int = 30, least_head: int = 20) -> Column:
    """An official text as a title: without brackets (nested so deep), the first part and the second, behind a comma, where
    both fit; a short second part also behind a first one cut to what room there is; else the first part, cut."""
    t = F.coalesce(text, F.lit(""))
    for _ in range(nested):
        t = F.regexp_replace(t, r"\s*\([^()]*\)", "")
    parts = F.filter(F.transform(F.split(t, ";"), lambda p: F.regexp_replace(p, r"^[ ,]+|[ ,]+$", "")), lambda p: p != "")
    head, second = F.get(parts, F.lit(0)), F.get(parts, F.lit(1))
    both = F.concat(head, F.lit(", "), second)
    room = _cut(head, F.lit(most - 2) - F.length(second))
    short = (F.length(second) <= qualifier) & (F.length(room) >= least_head)
    return F.when(F.size(parts) == 0, F.trim(F.coalesce(text, F.lit("")))).when(F.length(both) <= most, both).when(short, F.concat(room, F.lit(", "), second)).otherwise(_cut(head, F.lit(most)))


#: Formats of maturities, and the prices (per 100 of face value) that can be one.
MATURITY_FORMATS = ["d-MMM-yy", "d-MMM-yyyy", "d/M/yyyy", "yyyy-M-d"]
PRICE_LOW, PRICE_HIGH = 50.0, 150.0
RATE_KINDS = {"V": "VRR", "F": "FRR"}


def security_identity(code: Column, alternative: Column, maturity: Column, stem: str = "GOPIS") -> Column:
    """struct<scheme, rate_type, maturity_date, canonical> of a security's printed code, null where none of the schemes fits:
    `issue` (a number and the maturity in the code, the kind of rate in the alternative code), `flag` (a letter for the kind
    and the maturity in the code), `bare` (the kind in the code, the maturity beside it)."""
    c, alt = F.upper(F.trim(code)), F.upper(F.coalesce(alternative, F.lit("")))
    part = lambda pattern, n: F.nullif(F.regexp_extract(c, pattern, n), F.lit(""))
    issue, flag, bare = rf"^{stem}-\d+-(\d+-\d+-\d{{4}})$", rf"^{stem}([VF])-(\d+-\d+-\d{{4}})$", rf"^{stem}[-\s]*(VRR|FRR)$"
    named = F.nullif(F.regexp_extract(alt, r"\b(VRR|FRR)\b", 1), F.lit(""))
    letters = F.create_map(*[F.lit(x) for pair in RATE_KINDS.items() for x in pair])
    beside = F.coalesce(*[F.try_to_date(F.trim(maturity), f) for f in MATURITY_FORMATS])
    schemes = [
        ("issue", named, F.try_to_date(part(issue, 1), "d-M-yyyy")),
        ("flag", F.try_element_at(letters, part(flag, 1)), F.try_to_date(part(flag, 2), "d-M-yyyy")),
        ("bare", part(bare, 1), beside),
    ]
    found = [F.when(kind.isNotNull() & day.isNotNull(), F.struct(F.lit(name).alias("scheme"), kind.alias("rate_type"), day.alias("maturity_date"), F.concat(F.lit(f"{stem}-"), kind, F.lit("-"), day.cast("string")).alias("canonical"))) for name, kind, day in schemes]
    return F.coalesce(*found)


def last_number(cells: Column) -> Column:
    """The last cell that is a number (thousands commas go): where lists of quotes print their average."""
    numbers = F.transform(cells, lambda x: F.regexp_replace(F.trim(x), ",", "").try_cast("double"))
    return F.try_element_at(F.filter(numbers, lambda x: x.isNotNull()), F.lit(-1))


def resolve_securities(rows: DataFrame) -> DataFrame:
    """rows (code, alternative, maturity, quotes array<string>, ...) with scheme, rate_type, maturity_date, canonical, price and
    `reason`, null for what may be stored: no scheme fits, no price, or a price outside of its bounds (a date's serial number
    in its place)."""
    # exploded from an array of one, so that later filters on its parts do not repeat the whole expression
    s = rows.withColumn("s", F.explode(F.array(security_identity(F.col("code"), F.col("alternative"), F.col("maturity"))))).withColumn("price", last_number(F.col("quotes")))
    reason = F.when(F.col("s").isNull(), "unknown code").when(F.col("price").isNull(), "no price").when(~F.col("price").between(PRICE_LOW, PRICE_HIGH), "price out of bounds")
    return s.select(*rows.columns, "s.*", "price", reason.alias("reason"))


def security_conflicts(resolved: DataFrame) -> DataFrame:
    """(code, alternative, canonicals): printed codes that stand for more than one security, by the printed code where the
    maturity is in it, and by the alternative code of an issue. Counts different codes only."""
    known = resolved.filter("canonical is not null").select("code", "alternative", "scheme", "canonical").distinct()
    by_code = known.filter("scheme <> 'bare'").groupBy("code").agg(F.sort_array(F.collect_set("canonical")).alias("canonicals")).select("code", F.lit(None).cast("string").alias("alternative"), "canonicals")
    by_alt = known.filter("scheme = 'issue'").groupBy("alternative").agg(F.sort_array(F.collect_set("canonical")).alias("canonicals")).select(F.lit(None).cast("string").alias("code"), "alternative", "canonicals")
    return reduce(DataFrame.unionByName, [by_code, by_alt]).filter(F.size("canonicals") > 1)
