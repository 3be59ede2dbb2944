"""How five filters act in every order, from a sparse document-term matrix of the whole table.

Each task turns its documents into CSR shards: local columns numbered by first appearance, with the shard's vocabulary beside
them. Words are encoded globally by a dictionary over all vocabularies: a word's code is its 64-bit hash, and words that share
one are given codes of their own, so that a code stands for one word. Row sums and nonzero counts of the matrix decide
filters A and B; marks found while a text was at hand decide C and D, and a join on id and digest decides E. The 120 orders
are then a matter of at most 32 counts for each part.
"""

from __future__ import annotations

import hashlib
import json
from collections import Counter, defaultdict
from itertools import count, permutations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import checkpoint, only_cache, short_batches, stored

LETTERS = "ABCDE"
MARKS = b"#$%&*|"
CAPITALS = bytes(range(65, 91))
#: A record is a matrix (its documents, then the packed arrays) or up to VOCABULARY_ROWS words of one; both name the shard.
SHARDS = "shard long, doc_ids array<long>, parts array<string>, digests array<binary>, n_chars array<long>, n_capitals array<long>, marked array<boolean>, ends binary, columns binary, counts binary, codes binary, first long, words array<binary>"
MATRIX = ["doc_ids", "parts", "digests", "n_chars", "n_capitals", "marked", "ends", "columns", "counts", "codes"]
ROWS = "doc_id long, part string, digest binary, fails int"
VOCABULARY_ROWS = 20_000


def word_code(word: bytes, bits: int = 64) -> int:
    """A word's hash, as a signed number: the same as xxhash64 in Spark."""
    code = xxhash.xxh64_intdigest(word, 42) & ((1 << bits) - 1)
    return code - (1 << 64) if code >> 63 else code


class Shard:
    """Documents as a CSR matrix: row i has columns[ends[i-1]:ends[i]], in ascending order, with as many counts."""

    def __init__(self):
        self.column_of: dict[bytes, int] = defaultdict(count().__next__)
        self.rows: list[tuple] = []
        self.columns: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.size = 0

    def add(self, doc_id: int | None, part: str, text: str) -> None:
        raw = text.encode("utf-8")
        found = Counter(map(self.column_of.__getitem__, raw.split()))  # bytes are split at exactly these six characters
        columns = np.fromiter(found.keys(), np.int32, len(found))
        order = np.argsort(columns)
        self.columns.append(columns[order])
        self.counts.append(np.fromiter(found.values(), np.int32, len(found))[order])
        marked = len(raw.translate(None, MARKS)) < len(raw)
        self.rows.append((doc_id, part, hashlib.sha256(raw).digest(), len(text), len(raw) - len(raw.translate(None, CAPITALS)), marked))
        self.size += len(raw)

    def batches(self, shard: int, bits: int):
        """One record of the matrix, then records of the vocabulary."""
        ends = np.cumsum([len(c) for c in self.columns], dtype=np.int64)
        pack = zstandard.ZstdCompressor(1).compress
        empty: np.ndarray = np.zeros(0, np.int32)
        fields = [list(x) for x in zip(*self.rows, strict=True)]
        words = list(self.column_of)
        codes = np.fromiter((word_code(w, bits) for w in words), np.int64, len(words))
        arrays = [ends, np.concatenate([empty, *self.columns]), np.concatenate([empty, *self.counts]), codes]
        yield _batch([[shard], *[[f] for f in fields], *[[pack(a.tobytes())] for a in arrays], [None], [None]])
        for at in range(0, len(words), VOCABULARY_ROWS):
            yield _batch([[shard], *[[None]] * len(MATRIX), [at], [words[at : at + VOCABULARY_ROWS]]])


def _batch(columns: list[list]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.binary()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.bool_()), *[pa.binary()] * 4, pa.int64(), pa.list_(pa.binary())]
    names = [c.split()[0] for c in SHARDS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def term_matrix(docs: DataFrame, shard_bytes: int = 16_000_000, bits: int = 64) -> DataFrame:
    """docs (doc_id, part, text) -> CSR shards and their vocabularies; a shard is closed when its texts pass shard_bytes."""

    def run(batches):
        only_cache("audit", lambda: None)
        base, made, now = TaskContext.get().partitionId() << 32, 0, Shard()
        for batch in batches:
            for doc_id, part, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                now.add(doc_id, part, text)
                if now.size >= shard_bytes:
                    yield from now.batches(base | made, bits)
                    made, now = made + 1, Shard()
        if now.rows:
            yield from now.batches(base | made, bits)

    return docs.mapInArrow(run, SHARDS)


def vocabulary(shards: DataFrame, bits: int = 64) -> DataFrame:
    """shards -> (shard, column, word, code): each word once for each shard that has it."""
    words = shards.filter(F.col("words").isNotNull()).select("shard", "first", F.posexplode("words").alias("i", "word"))
    code = F.xxhash64("word") if bits == 64 else F.xxhash64("word").bitwiseAND(F.lit((1 << bits) - 1))
    return words.select("shard", (F.col("first") + F.col("i")).alias("column"), "word", code.alias("code"))


def dictionary(shards: DataFrame, bits: int = 64) -> DataFrame:
    """(word, code, tie): the global encoding. Code and tie together belong to one word only: tie numbers the words that share
    a hash, by their bytes, and is 0 but for collisions. One shuffle of the shards' vocabularies."""
    words = vocabulary(shards, bits).select("code", "word").repartition("code").dropDuplicates(["code", "word"])
    return words.groupBy("code").agg(F.sort_array(F.collect_list("word")).alias("same")).select(F.posexplode("same").alias("tie", "word"), "code").select("word", "code", "tie")


def collisions(shards: DataFrame, bits: int = 64) -> DataFrame | None:
    """(shard, ties): for shards with words of tie 1 or more, these as (column, tie); None if no two words share a hash."""
    words = vocabulary(shards, bits).select("code", "word").repartition("code").dropDuplicates(["code", "word"])
    shared = checkpoint(words.groupBy("code").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("code"))
    if shared.isEmpty():
        return None
    known = vocabulary(shards, bits).join(shared, "code", "left_semi")
    same = known.select("code", "word").distinct().groupBy("code").agg(F.sort_array(F.collect_list("word")).alias("same"))
    ties = same.select("code", F.posexplode("same").alias("tie", "word")).filter("tie > 0")
    return known.join(ties, ["code", "word"]).groupBy("shard").agg(F.collect_list(F.struct("column", "tie")).alias("ties"))


def failures(shards: DataFrame, ties: DataFrame | None = None) -> DataFrame:
    """Matrix rows -> (doc_id, part, digest, fails): bits of A to D (1, 2, 4, 8) by row sums, nonzero counts and marks."""
    rows = shards.filter(F.col("doc_ids").isNotNull()).select("shard", *MATRIX)
    rows = rows.withColumn("ties", F.lit(None).cast("array<struct<column:long,tie:int>>")) if ties is None else rows.join(ties, "shard", "left")

    def run(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for r in batch.to_pylist():
                ends, counts, codes = (np.frombuffer(unpack(r[k]), t) for k, t in (("ends", np.int64), ("counts", np.int32), ("codes", np.int64)))
                tie = np.zeros(len(codes), np.int64)
                for t in r["ties"] or ():
                    tie[t["column"]] = t["tie"]
                order = np.lexsort((tie, codes))
                if ((np.diff(codes[order]) == 0) & (np.diff(tie[order]) == 0)).any():
                    raise ValueError("two words of one shard have the same code")
                begins = np.concatenate([[0], ends[:-1]])
                up_to = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
                words, distinct = up_to[ends] - up_to[begins], ends - begins
                capital = 100 * np.array(r["n_capitals"]) > 10 * np.array(r["n_chars"])
                fails = (words < 100) + 2 * (100 * distinct < 80 * words) + 4 * capital + 8 * np.array(r["marked"])
                yield pa.RecordBatch.from_arrays([pa.array(r["doc_ids"], pa.int64()), pa.array(r["parts"], pa.string()), pa.array(r["digests"], pa.binary()), pa.array(fails.astype(np.int32))], [c.split()[0] for c in ROWS.split(", ")])

    return rows.mapInArrow(run, ROWS)


def _orders() -> Column:
    """All steps of all orders: (filter_order, step, letter, bit, before), before having the bits of the earlier filters."""
    bit = {c: 1 << i for i, c in enumerate(LETTERS)}
    steps = [("".join(p), i + 1, p[i], bit[p[i]], sum(bit[c] for c in p[:i])) for p in permutations(LETTERS) for i in range(len(p))]
    names = ("filter_order", "step", "letter", "bit", "before")
    return F.from_json(F.lit(json.dumps([dict(zip(names, s, strict=True)) for s in steps])), "array<struct<filter_order:string,step:int,letter:string,bit:int,before:int>>")


def interactions(counted: DataFrame) -> DataFrame:
    """counted (part, fails, n, good, toxic) -> the report: every order and step of every part, zeros included."""
    each = counted.select("*", F.explode(_orders()).alias("o")).select("*", "o.*").drop("o")
    failed, earlier = F.col("fails").bitwiseAND(F.col("bit")) > 0, F.col("fails").bitwiseAND(F.col("before")) > 0
    of = lambda when, what="n": F.sum(F.when(when, F.col(what)).otherwise(0))
    steps = each.groupBy("part", "filter_order", "step", "letter").agg(
        of(~failed & ~earlier).alias("kept"), of(failed & ~earlier).alias("removed"), of(failed & earlier).alias("redundant"),
        of(F.col("fails") == F.col("bit")).alias("unique_fails"), of(failed & ~earlier, "good").alias("good_lost"), of(failed & ~earlier, "toxic").alias("toxic_lost"),
    )
    shapley = steps.groupBy("part", "letter").agg(F.sum("removed").alias("shapley"))
    return steps.join(shapley, ["part", "letter"]).drop("letter")


def audit(docs: DataFrame, labels: DataFrame, shard_bytes: int = 16_000_000, bits: int = 64) -> DataFrame:
    """docs (doc_id, lang, text) and labels (doc_id, quality, toxic) -> (part, filter_order, step, kept, removed, redundant,
    unique_fails, good_lost, toxic_lost, shapley), for every value of lang (null: empty string), order and step.

    A null text counts as empty: it fails A, and E where a smaller id has an empty or null text. Every row counts, repeated
    ones too; rows of one id and text fail E together or not at all. A null id has no label, fails no E, and is not smaller
    than any. A document is good or toxic if any of its label rows says so; null labels say nothing. Other columns are
    ignored whatever their names. A table without rows has no part and gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("lang"), F.lit("")).alias("part"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    with short_batches(docs.sparkSession):
        shards = stored(term_matrix(rows, shard_bytes, bits))
    with short_batches(docs.sparkSession, 4):
        facts = stored(failures(shards, collisions(shards, bits)))
    # only the smallest id of each text passes E: a join on both columns, so that a text with many copies is no hot key
    first = facts.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    said = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    marked = facts.join(first, ["doc_id", "digest"], "left").join(said, "doc_id", "left")
    fails = F.col("fails") + F.when(F.col("first").isNull() & F.col("doc_id").isNotNull(), 16).otherwise(0)
    counted = marked.groupBy("part", fails.alias("fails")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.coalesce("good", F.lit(0))).alias("good"), F.sum(F.coalesce("toxic", F.lit(0))).alias("toxic"))
    return interactions(counted)


def op13_filter_audit(spark, sf_dir: str) -> DataFrame:
    return audit(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


OP13_SQL = r"""WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY text) AS first FROM d),
f AS (SELECT w.doc_id, part, coalesce(quality = 1, false)::INT AS good, coalesce(toxic = 1, false)::INT AS toxic, [
  (len(words) < 100)::INT, (100 * len(list_distinct(words)) < 80 * len(words))::INT, (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text))::INT,
  regexp_matches(text, '[#$%&*|]')::INT, coalesce(w.doc_id > first, false)::INT] AS fail FROM w LEFT JOIN labels l ON l.doc_id = w.doc_id),
c AS (SELECT part, fail, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY ALL),
l AS (SELECT unnest(range(1, 6)) AS i),
o AS (SELECT [a.i, b.i, c.i, d.i, e.i] AS p FROM l a, l b, l c, l d, l e WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
s AS (SELECT array_to_string(list_transform(p, lambda x: 'ABCDE'[x]), '') AS filter_order, p, unnest(range(1, 6)) AS step FROM o),
x AS (SELECT part, filter_order, step, p[step] AS own, n, good, toxic, fail[p[step]] AS failed, list_sum(fail) AS fails,
  coalesce(list_sum(list_transform(p[:step - 1], lambda k: fail[k])), 0) AS earlier FROM c, s),
r AS (SELECT part, filter_order, step, own, sum(n * (failed = 0 AND earlier = 0)::INT) AS kept, sum(n * (failed = 1 AND earlier = 0)::INT) AS removed,
  sum(n * (failed = 1 AND earlier > 0)::INT) AS redundant, sum(n * (failed = 1 AND fails = 1)::INT) AS unique_fails,
  sum(good * (failed = 1 AND earlier = 0)::INT) AS good_lost, sum(toxic * (failed = 1 AND earlier = 0)::INT) AS toxic_lost FROM x GROUP BY ALL)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails,
  good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley FROM r"""
