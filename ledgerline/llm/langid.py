"""Language identification by interpolated Kneser-Ney character models, one for each language.

Spark counts the character 4-grams of all training documents by language, makes the lower orders' Kneser-Ney continuation
counts from them, and the interpolated probabilities by joins from the lowest order up; the tables stay in files. Letters are
lower-cased, everything else is one space. Four 16-bit characters make one 64-bit key, which is the hash under which a gram
stands in a sorted array; the models of all languages share the array, with one column of log-probabilities each, so a text
is scored for all languages by one binary search per character and, for unseen grams, by the lower orders' arrays. The
arrays are held by slices of a bounded size. The language with the least cross-entropy per character wins.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import give_back, held_out, only_cache, stored

ORDER = 4
CHUNK = 400_000
SPACE = 32
_LETTER: list[np.ndarray] = []


def letter_table() -> np.ndarray:
    """Which 16-bit code units are letters; both halves of a character outside the 16-bit plane are (see units_of)."""
    if not _LETTER:
        _LETTER.append(np.array([chr(i).isalpha() or 0xD800 <= i < 0xE000 for i in range(65536)]))
    return _LETTER[0]


def units_of(text: str) -> np.ndarray:
    """16-bit code units of the lower-cased text; what is outside the 16-bit plane and no letter becomes a space."""
    units = np.frombuffer(text.lower().encode("utf-16-le", "surrogatepass"), "<u2")
    if ((units & 0xF800) == 0xD800).any():
        plain = "".join([c if c < "\ud800" or "\udfff" < c <= "\uffff" or c.isalpha() else " " for c in text.lower()])
        units = np.frombuffer(plain.encode("utf-16-le"), "<u2")
    return units


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def chunks(texts: list[str]):
    """(from, to) of consecutive texts with about CHUNK characters together."""
    at, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= CHUNK:
            yield at, i + 1
            at, size = i + 1, 0
    if at < len(texts):
        yield at, len(texts)


def keys_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """4-gram keys of the texts' characters in order, and how many each text has. A text begins after spaces."""
    joined = "\x00" + "\x00".join([t.replace("\x00", " ") if "\x00" in t else t for t in texts])
    units = units_of(joined)
    begins = units == 0
    codes = np.where(letter_table()[units], units, SPACE).astype(np.uint16)
    blank = codes == SPACE
    keep = begins | ~(blank & np.r_[False, blank[:-1]])
    codes, begins = codes[keep], begins[keep]
    start = np.flatnonzero(begins)
    sizes = np.diff(np.r_[start, len(codes)]) - 1
    wide = codes.astype(np.uint64)
    place = np.arange(len(codes)) - np.repeat(start, sizes + 1)
    key = wide.copy()
    for back in range(1, ORDER):
        past = np.full(len(wide), SPACE, np.uint64)
        past[back:] = wide[:-back]
        past[place < back] = SPACE
        key |= past << np.uint64(16 * back)
    return key[~begins], sizes


def _counts(batches):
    """(lang, text) -> (lang, gram, n), summed within the task before the shuffle."""
    only_cache("langid", lambda: None)
    held: dict[str, list] = {}
    for pdf in batches:
        for lang, own in pdf.groupby("lang"):
            texts = own["text"].tolist()
            for a, b in chunks(texts):
                keys, n = np.unique(keys_of(texts[a:b])[0], return_counts=True)
                if lang in held:
                    both = np.concatenate([held[lang][0], keys])
                    keys, at = np.unique(both, return_inverse=True)
                    n = np.bincount(at, np.concatenate([held[lang][1], n])).astype(np.int64)
                held[lang] = [keys, n]
                if len(keys) > 2_000_000:
                    yield pd.DataFrame({"lang": lang, "gram": keys.astype(np.int64), "n": n})
                    del held[lang]
    for lang, (keys, n) in held.items():
        yield pd.DataFrame({"lang": lang, "gram": keys.astype(np.int64), "n": n})


def _low(order: int) -> int:
    return (1 << (16 * order)) - 1


def slice_of(keys, slices: int):
    """The slice of a gram of order 4 or 3 (numpy array or Column): by the two characters before its last one, so that both
    of its orders and their histories are in one slice."""
    if isinstance(keys, Column):
        return F.shiftright(F.shiftrightunsigned(keys, 16).bitwiseAND(F.lit(_low(2))) * 1_000_003, 12) % slices
    return (((keys >> np.uint64(16)) & np.uint64(_low(2))) * np.uint64(1_000_003) >> np.uint64(12)) % np.uint64(slices)


class Tables:
    """One slice of the models of all languages in sorted arrays: for each order keys and log-probabilities, and for each
    history the logarithm of the weight that is left to the lower order; one column a language."""

    def __init__(self, langs: int, alphabet: int, slices: int, own: int, grams: dict, histories: dict):
        self.langs, self.alphabet, self.slices, self.own = langs, alphabet, slices, own
        self.grams, self.histories = grams, histories

    def log_probabilities(self, keys: np.ndarray, order: int = ORDER) -> np.ndarray:
        """One row per key, one column per language."""
        if order == 0:
            return np.full((len(keys), self.langs), -np.log(self.alphabet), np.float32)
        out, missed = np.zeros((len(keys), self.langs), np.float32), np.arange(len(keys))
        if order in self.grams:
            own, table = self.grams[order]
            at = np.minimum(np.searchsorted(own, keys), len(own) - 1)
            out, missed = table[at], np.flatnonzero(own[at] != keys)
        if len(missed):
            rest = keys[missed]
            lower = self.log_probabilities(rest & np.uint64(_low(order - 1)), order - 1)
            if order in self.histories:
                h, weights = self.histories[order]
                hat = np.minimum(np.searchsorted(h, rest >> np.uint64(16)), len(h) - 1)
                lower += np.where((h[hat] == rest >> np.uint64(16))[:, None], weights[hat], 0)
            out[missed] = lower
        return out

    def sums(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Log-probabilities of the characters in this slice (rows: texts, columns: languages), and how many characters each
        text has in all slices."""
        all_, sizes_all = [np.zeros((0, self.langs))], [np.zeros(0, np.int64)]
        for a, b in chunks(texts):
            keys, sizes = keys_of(texts[a:b])
            if self.slices == 1:
                found = self.log_probabilities(keys)
            else:
                mine = np.flatnonzero(slice_of(keys, self.slices) == np.uint64(self.own))
                found = np.zeros((len(keys), self.langs), np.float32)
                found[mine] = self.log_probabilities(keys[mine])
            sums = np.zeros((b - a, self.langs))
            full = np.flatnonzero(sizes > 0)
            if len(full):
                sums[full] = np.add.reduceat(found, (np.cumsum(sizes) - sizes)[full], axis=0, dtype=np.float64)
            all_.append(sums)
            sizes_all.append(sizes)
        return np.concatenate(all_), np.concatenate(sizes_all)


class LanguageModel:
    """The trained tables, in files of the shared folder: grams (order, key, logs) and histories (order, key, logs), with one
    logarithm a language. slices is how many parts they are held in while texts are scored; limits are the entropies above
    which a language rejects."""

    def __init__(self, langs: list[str], alphabet: int = 1, slices: int = 1, grams: DataFrame | None = None, histories: DataFrame | None = None):
        self.langs, self.alphabet, self.slices, self.grams, self.histories = langs, alphabet, slices, grams, histories
        self.limits = np.full(len(langs), np.inf)
        self.held: Broadcast | None = None

    def shared(self, own: int = 0) -> Broadcast:
        """A slice as a broadcast, of the size that train's most_cells sets; that of a model of one slice is made once."""
        if self.slices > 1 or self.held is None:
            made = self.grams.sparkSession.sparkContext.broadcast(self.tables(own))
            if self.slices > 1:
                return made
            self.held = made
        return self.held

    def tables(self, own: int = 0) -> Tables:
        """One slice as arrays: all grams of orders 1 and 2 and those of the others that slice_of puts there."""

        def arrays(df: DataFrame, whole: Column) -> dict:
            mine = df if self.slices == 1 else df.filter((F.col("order") <= 2) | (slice_of(whole, self.slices) == own))
            got, out = mine.toArrow(), {}
            order = got["order"].to_numpy()
            keys = got["key"].to_numpy().astype(np.int64).view(np.uint64)
            logs = got["logs"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, len(self.langs))
            for k in np.unique(order):
                at = np.flatnonzero(order == k)
                at = at[np.argsort(keys[at])]
                out[int(k)] = (keys[at], logs[at])
            return out

        return Tables(len(self.langs), self.alphabet, self.slices, own, arrays(self.grams, F.col("key")), arrays(self.histories, F.shiftleft("key", 16)))

    def set_limits(self, sums: dict[str, tuple[int, float, float]], least_rows: int = 20) -> None:
        """sums: rows, sum and sum of squares of the entropies by language. A language with fewer than least_rows rows takes
        mean and deviation of all languages together; no rows at all: no limits."""
        all_ = tuple(sum(x) for x in zip(*sums.values(), strict=True)) if sums else (0, 0.0, 0.0)
        for i, lang in enumerate(self.langs):
            own = sums.get(lang, (0, 0.0, 0.0))
            n, s, q = own if own[0] >= least_rows else all_
            if n:
                mean = s / n
                self.limits[i] = max(mean + 6 * max(q / n - mean * mean, 0.0) ** 0.5, (mean + np.log(self.alphabet)) / 2)


def judge(langs: list[str], limits: np.ndarray, sums: np.ndarray, n: np.ndarray, worded: np.ndarray, least: int = 40, sharp: int = 64) -> pd.DataFrame:
    """lang_pred, score, entropy, accepted from the texts' summed log-probabilities and numbers of characters."""
    entropy = -sums / np.maximum(n, 1)[:, None]
    best = entropy.argmin(1)
    lowest = entropy[np.arange(len(best)), best]
    odds = np.exp(-(entropy - lowest[:, None]) * np.minimum(n, sharp)[:, None])
    accepted = worded & ((n < least) | (lowest <= limits[best]))
    return pd.DataFrame({"lang_pred": np.where(worded, np.array(langs, object)[best], "und"), "score": np.where(worded, 1 / odds.sum(1), 0.0), "entropy": np.where(worded, lowest, np.nan), "accepted": accepted})


def kneser_ney(counts: DataFrame, langs: list[str]) -> tuple[int, DataFrame, DataFrame]:
    """counts (lang, gram, n), one row a language and 4-gram -> size of the alphabet with one unseen character, grams and
    histories (order, key, logs).

    Lower orders count the different grams that end in them. Each language and order has the discount ones / (ones + 2 twos)
    of its own counts of counts (0.75 where either is none). Windows and joins are by history, or by the shorter gram: what
    shares one differs in one character, so no group is larger than the alphabet times the languages.
    """
    level = counts.select(F.array_position(F.lit(langs), F.col("lang")).cast("int").alias("i"), F.col("gram").alias("key"), "n")
    levels = level.withColumn("order", F.lit(ORDER))
    for order in range(ORDER - 1, 0, -1):
        level = level.groupBy("i", F.col("key").bitwiseAND(F.lit(_low(order))).alias("key")).agg(F.count(F.lit(1)).alias("n"))
        levels = levels.unionByName(level.withColumn("order", F.lit(order)))
    levels = stored(levels)
    alphabet = levels.filter("order = 1").agg(F.countDistinct("key")).first()[0] + 1
    ones, twos = F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2)
    off = levels.groupBy("order", "i").agg(F.when((ones > 0) & (twos > 0), ones / (ones + 2 * twos)).otherwise(F.lit(0.75)).alias("off"))  # four rows a language
    same = Window.partitionBy("order", "i", "h")
    rows = levels.join(F.broadcast(off), ["order", "i"]).withColumn("h", F.shiftrightunsigned("key", 16))
    rows = rows.withColumns({"total": F.sum("n").over(same), "followers": F.count(F.lit(1)).over(same)})
    rows = stored(rows.select("order", "i", "key", "h", (F.greatest(F.col("n") - F.col("off"), F.lit(0.0)) / F.col("total")).alias("first"), (F.col("off") * F.col("followers") / F.col("total")).alias("left")))

    def by_language(of: Column, missing: float) -> Column:
        """An array with one value a language, in the order of langs."""
        found = F.map_from_entries(F.collect_list(F.struct("i", of)))
        return F.transform(F.sequence(F.lit(1), F.lit(len(langs))), lambda i: F.coalesce(F.try_element_at(found, i), F.lit(missing)))

    weights = stored(rows.select("order", "i", "h", "left").distinct().groupBy("order", "h").agg(by_language(F.col("left"), 1.0).alias("left")))
    lower, done = None, []
    for order in range(1, ORDER + 1):
        of = rows.filter(F.col("order") == order).groupBy("key", "h").agg(by_language(F.col("first"), 0.0).alias("first"))
        of = of.join(weights.filter(F.col("order") == order).select("h", "left"), "h")
        if lower is None:
            below = F.array_repeat(F.lit(1.0 / alphabet), len(langs))
        else:
            of = of.withColumn("short", F.col("key").bitwiseAND(F.lit(_low(order - 1)))).join(lower.select(F.col("key").alias("short"), F.col("p").alias("below")), "short")
            below = F.col("below")
        spread = F.zip_with("left", below, lambda x, y: x * y)
        lower = stored(of.select("key", F.zip_with("first", spread, lambda x, y: x + y).alias("p")))
        done.append(lower.select(F.lit(order).alias("order"), "key", _logs("p")))
    return alphabet, reduce(DataFrame.unionByName, done), weights.select("order", F.col("h").alias("key"), _logs("left"))


def _logs(name: str) -> Column:
    return F.transform(name, lambda x: F.log(x).cast("float")).alias("logs")


def train(docs: DataFrame, most_cells: int = 32_000_000) -> LanguageModel:
    """Count over all training documents (fold and non-null text and lang). Every language and every 4-gram is in the model,
    so counts of counts, totals and followers are those of all text; Spark aggregates make it (kneser_ney) and it stays in
    files. most_cells bounds what driver and workers hold of it at a time: numbers of orders 3 and 4 in a slice, on the
    average. Any two characters' grams are in one slice, and orders 1 and 2 in each.

    A text of at least 40 characters is rejected if its lowest cross-entropy is above its language's limit: the larger of
    mean + 6 standard deviations over all training documents of 60 characters or more that the model gives that language
    (over all languages' where these are fewer than 20), and the middle between that mean and the entropy of characters
    drawn evenly from the alphabet.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("lang").cast("string").alias("lang")).filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    counts = rows.select("lang", "text").mapInPandas(_counts, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    counts = stored(counts)
    langs = sorted(r["lang"] for r in counts.select("lang").distinct().collect())  # one row a language
    if not langs:
        return LanguageModel([])
    alphabet, grams, histories = kneser_ney(counts, langs)
    cells = len(langs) * (grams.filter("order > 2").count() + histories.filter("order > 2").count())
    model = LanguageModel(langs, alphabet, max(1, -(-cells // most_cells)), grams, histories)
    long_ = identify(rows.filter(F.length("text") >= 60).select("text"), model)
    sums = long_.groupBy("lang_pred").agg(F.count("entropy").alias("n"), F.sum("entropy").alias("s"), F.sum(F.col("entropy") * F.col("entropy")).alias("q")).collect()  # one row a language
    model.set_limits({r["lang_pred"]: (r["n"], r["s"], r["q"]) for r in sums if r["n"]})
    return model


def _sums(shared: Broadcast, text: Column) -> Column:
    """A slice's sums for each text, its number of characters and whether it has a letter."""

    @F.pandas_udf("sums array<double>, n long, worded boolean")
    def sums(text: pd.Series) -> pd.DataFrame:
        only_cache("langid", lambda: None)
        found, n = shared.value.sums([t or "" for t in text])
        out = pd.DataFrame({"sums": list(found), "n": n, "worded": [has_letter(t) for t in text]})
        give_back()
        return out

    return sums(text)


def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """docs -> all its columns and lang_pred, score (0 to 1), entropy, accepted, from the whole text and nothing else.

    A null text or one without a letter: `und`, score 0, not accepted. A letter outside the 16-bit plane counts as two. Ties
    go to the first language by name. Repeated rows get equal results; no training rows: all `und`, and accepted if they
    have a letter; an empty table stays empty; columns of the four names are replaced.

    A model of one slice is broadcast and no row is shuffled. Of more slices one is broadcast at a time and its sums of
    every different text are written; the sums of all slices, added in their order, then meet the rows by the text's hash.
    """
    names = [c for c in docs.columns if c not in ("lang_pred", "score", "entropy", "accepted")]
    langs, limits, text = model.langs, model.limits.copy(), F.col(text_col)

    @F.pandas_udf("lang_pred string, score double, entropy double, accepted boolean")
    def verdict(found: pd.DataFrame) -> pd.DataFrame:
        sums = np.stack(found["sums"].to_list()) if len(found) else np.zeros((0, len(langs)))
        return judge(langs, limits, sums, found["n"].to_numpy(np.int64), found["worded"].to_numpy(bool))

    if not langs:
        @F.pandas_udf("boolean")
        def worded(text: pd.Series) -> pd.Series:
            return pd.Series([has_letter(t) for t in text], dtype=bool)

        return docs.select(*names, F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(float("nan")).alias("entropy"), worded(text).alias("accepted"))
    rows = docs.select(F.struct(*names).alias("row"), text.alias("text"))  # whatever names the columns have
    if model.slices == 1:
        return rows.select("row", verdict(_sums(model.shared(), F.col("text"))).alias("guess")).select("row.*", "guess.*")
    hashed, parts = F.sha2(F.coalesce("text", F.lit("")), 256).alias("hash"), []
    for own in range(model.slices):
        shared = model.shared(own)
        parts.append(stored(rows.select(hashed, _sums(shared, F.col("text")).alias("found")).select("hash", F.lit(own).alias("own"), "found.*").dropDuplicates(["hash"])))
        shared.destroy()
    added = F.aggregate(F.array_sort(F.collect_list(F.struct("own", "sums"))), F.array_repeat(F.lit(0.0), len(langs)), lambda a, x: F.zip_with(a, x["sums"], lambda p, q: p + q))
    whole = reduce(DataFrame.unionByName, parts).groupBy("hash").agg(F.struct(added.alias("sums"), F.min("n").alias("n"), F.min("worded").alias("worded")).alias("found"))
    return rows.withColumn("hash", hashed).join(whole, "hash").select("row", verdict("found").alias("guess")).select("row.*", "guess.*")


def op5_langid(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs)
    return identify(docs.select("doc_id", "text"), model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "accepted")
