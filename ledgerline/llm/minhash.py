"""Document fingerprints by one-permutation MinHash with optimal densification and b-bit packing.

Each five-word shingle is hashed once. The hash's high bits choose a bin, the least hash of a bin is its value. An empty
bin takes the value of a filled bin that a universal hash of (bin, attempt) picks, trying on until a filled one is found
(Shrivastava, 2017), so that equal sets densify alike. Only the low bits of each bin are packed and stored; likeness is the
share of equal bins (a bin's number is mixed in, so that chance agreements of one donated value don't repeat), corrected for the bits that agree by chance: (share - c) / (1 - c) with c = 2**-bits.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import only_cache, stored

ODD = np.uint64(0x9E3779B97F4A7C15)
_WORDS: dict[str, int] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every bit of the input moves every bit of the output."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(text: str | None, words_each: int = 5, most_kept: int = 500_000) -> np.ndarray:
    """One hash for each shingle of white-space-separated words; a shorter text has one shingle, an empty one none."""
    words = (text or "").split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(_WORDS) > most_kept:
        _WORDS.clear()
    for w in set(words).difference(_WORDS):
        _WORDS[w] = xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass"))
    h = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    n = min(words_each, len(h))
    out = np.zeros(len(h) - n + 1, np.uint64)
    for i in range(n):
        out = out * ODD + h[i : len(h) - n + 1 + i]
    return mix(out + np.uint64(n))


@lru_cache(maxsize=8)
def donors(bins: int, attempts: int) -> np.ndarray:
    """donors[a, i]: the bin that bin i looks at in its attempt a, the same for every document."""
    i, a = np.arange(bins, dtype=np.uint64), np.arange(attempts, dtype=np.uint64)
    return (mix(i[None, :] * ODD + mix(a[:, None] + np.uint64(1))) % np.uint64(bins)).astype(np.int64)


def one_permutation(hashes: np.ndarray, bins: int = 512, bits: int = 4) -> bytes:
    """Packed low bits of the densified bins; no shingle: no bytes."""
    if not len(hashes):
        return b""
    width = 64 - (bins.bit_length() - 1)
    bin_of = (hashes >> np.uint64(width)).astype(np.int64)
    least = np.full(bins, np.iinfo(np.uint64).max, np.uint64)
    np.minimum.at(least, bin_of, hashes)
    filled = np.zeros(bins, bool)
    filled[bin_of] = True
    empty = np.flatnonzero(~filled)
    attempts = 64
    while len(empty):
        table = donors(bins, attempts)[:, empty]
        ok = filled[table]
        first = ok.argmax(0)
        found = ok[first, np.arange(len(empty))]
        least[empty[found]] = least[table[first, np.arange(len(empty))][found]]
        empty, attempts = empty[~found], attempts * 4
    low = (mix(least + np.arange(bins, dtype=np.uint64) * ODD) & np.uint64((1 << bits) - 1)).astype(np.uint8)
    return np.packbits(np.unpackbits(low[:, None], axis=1)[:, 8 - bits :].ravel()).tobytes()


def fingerprint(text: str | None, bins: int = 512, bits: int = 4) -> str:
    """The packed bins in hex; an empty text has the empty fingerprint."""
    return one_permutation(shingle_hashes(text), bins, bits).hex()


def likeness(a: str, b: str, bins: int = 512, bits: int = 4) -> float:
    """Estimated Jaccard similarity of the shingle sets, 0 to 1. Equal fingerprints: 1; one of two empty: 0."""
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    x = np.unpackbits(np.frombuffer(bytes.fromhex(a), np.uint8) ^ np.frombuffer(bytes.fromhex(b), np.uint8)).reshape(bins, bits)
    share, chance = 1 - x.any(1).mean(), 2.0**-bits
    return float(min(1.0, max(0.0, (share - chance) / (1 - chance))))


def fingerprints(docs: DataFrame, bins: int = 512, bits: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs -> (doc_id, fingerprint) for each row. Null texts count as empty; repeated rows stay; no rows: none."""

    def run(batches):
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "fingerprint": [fingerprint(t, bins, bits) for t in pdf["text"]]})

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInPandas(run, "doc_id long, fingerprint string")


OUT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
WITH_ENDS = f"{OUT}, part int, head string, tail string"


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by as many first ones (or all) of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _row(doc, text: str, own: str, following: str, following_print: str) -> tuple:
    changed = edited(text, following)
    changed_print = own if changed == text else fingerprint(changed)
    return (doc, len(text), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(), own, changed_print, likeness(own, changed_print), likeness(own, following_print))


def compare_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows_each: int = 4000) -> DataFrame:
    """Fingerprints of every text and of its edit with the next text by descending id (after the last comes the first).

    Texts are dealt into ranges of ids and sorted there, one shuffle in all; each task compares neighbours and passes on
    its first and last text, which meet the neighbouring ranges' in a second step of two texts per range. Null texts
    count as empty; rows with equal ids follow each other by text; null ids come last; a single row follows itself.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    parts = max(1, -(-rows.count() // rows_each))
    dealt = rows.repartitionByRange(parts, F.col("doc_id").desc_nulls_last()).sortWithinPartitions(F.col("doc_id").desc_nulls_last(), "text")

    def table(out: list) -> pd.DataFrame:
        return pd.DataFrame(out, columns=[c.split()[0] for c in WITH_ENDS.split(", ")]).astype({"doc_id": "Int64", "n_chars": "Int64", "part": "Int32"})

    def run(batches):
        only_cache("minhash", _WORDS.clear)
        part, first, past = TaskContext.get().partitionId(), None, None
        for pdf in batches:
            out = []
            for doc, text in zip(pdf["doc_id"], pdf["text"], strict=True):
                now = (None if pd.isna(doc) else int(doc), text, fingerprint(text))
                if past is None:
                    first = text
                else:
                    out.append((*_row(*past, now[1], now[2]), None, None, None))
                past = now
            if out:
                yield table(out)
        if past is not None:
            yield table([(past[0], None, None, None, None, None, None, part, first, past[1])])

    packed = ["edited_sha256", "fingerprint", "edited_fingerprint"]  # as bytes, half of their digits, while on disk
    done = stored(dealt.mapInPandas(run, WITH_ENDS).withColumns({c: F.unhex(c) for c in packed})).withColumns({c: F.lower(F.hex(c)) for c in packed})
    names = [c.split()[0] for c in OUT.split(", ")]
    ends = done.filter(F.col("part").isNotNull()).select("doc_id", "part", "head", "tail")
    order = sorted(r["part"] for r in ends.select("part").collect())  # one number for each range
    shift = spark.createDataFrame([(p, order[(i + 1) % len(order)]) for i, p in enumerate(order)], "part int, following int")
    pairs = ends.join(shift, "part").select("doc_id", "tail", "following").join(ends.select(F.col("part").alias("following"), "head"), "following")

    def close(batches):
        for pdf in batches:
            yield pd.DataFrame([_row(None if pd.isna(r.doc_id) else int(r.doc_id), r.tail, fingerprint(r.tail), r.head, fingerprint(r.head)) for r in pdf.itertuples()], columns=names).astype({"doc_id": "Int64"})

    return done.filter(F.col("part").isNull()).select(names).unionByName(pairs.select("doc_id", "tail", "head").mapInPandas(close, OUT))


def op9_fingerprints(spark, sf_dir: str) -> DataFrame:
    return compare_with_next(spark.read.parquet(f"{sf_dir}/documents.parquet"))
