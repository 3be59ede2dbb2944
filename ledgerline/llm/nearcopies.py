"""Groups of near copies: five-word shingles with a Jaccard similarity of 0.8 or more, every link confirmed exactly.

A text's set is the 64-bit hashes of its lower-cased shingles; texts with equal sets are one node, so exact copies cost
nothing. Candidates come from op2's method: a SimHash of the set, here of 1,024 majority bits, whose 16-bit segments are the
buckets of the Gray-order index; in a bucket nodes meet that differ in at most 40 of the first 128 bits. Two sets at a similarity
of 0.8 differ in 15 % of the bits, so all of 128 segments differ with a chance of (1 - 0.85**16)**128 = 0.0001; sets of up to 32 shingles,
where chance may bring 19 %, have 192 segments. First every node is compared with one node of each of its groups, drawn by
a hash of node and segment, so that a large group gives it many different partners: with those of a few segments first,
then with the others that are in another component yet; what these links join needs no more work. Groups whose nodes are still in more than one component are then
compared in full, in tasks that hold them whole or in pairs of parts, with their sets: pairs from different components whose
fingerprints are near enough are confirmed there, and only links leave a task. Every link is confirmed by the sets; for
that 32 bits of each hash are kept (two shingles of one union that share them change a similarity by one in its size).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import checkpoint, freeing, only_cache, short_batches, shuffles_dropped, stored
from ledgerline.llm.components import components
from ledgerline.llm.minhash import _WORDS, mix, shingle_hashes
from ledgerline.llm.simhash import indexed_groups, majority, whole_print

WORDS, SEGMENTS, FEW, MOST, HEADS, FIRST = 16, 128, 32, 40, 24, 2
_SEEDS = mix(np.arange(1, WORDS + 1, dtype=np.uint64))
#: Bits of each segment: permutations of all bits, cut in 16s; those beyond SEGMENTS are for sets of up to FEW shingles only.
_PLACES = np.concatenate([np.random.RandomState(42 + k).permutation(64 * WORDS).reshape(-1, 16) for k in range(3)])
PRINTS = "id long, th long, node long, fp binary, size int, f0 long, f1 long, whole long, shingles binary"


def shingle_set(text: str | None, words_each: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the lower-cased text's shingles."""
    return np.unique(shingle_hashes((text or "").lower(), words_each))


def segments(prints: np.ndarray, sizes: np.ndarray, rows: int = 500) -> list[np.ndarray]:
    """Each fingerprint's segments as number * 65536 + bits; so many rows at a time, as a bit takes a byte meanwhile."""
    out = []
    for at in range(0, len(prints), rows):
        bits = np.unpackbits(prints[at : at + rows].view(np.uint8).reshape(-1, 8 * WORDS), axis=1, bitorder="little")
        cut = np.ascontiguousarray(np.packbits(bits[:, _PLACES.ravel()], axis=1)).view(">u2").astype(np.int32) + np.arange(len(_PLACES), dtype=np.int32) * 65536
        out += [row if few else row[:SEGMENTS] for row, few in zip(cut, sizes[at : at + rows] <= FEW, strict=True)]
    return out


def _forget() -> None:
    _WORDS.clear()  # by a function of this module: tasks would get `_WORDS.clear` with a copy of the table


def _prints(batches, words_each: int, rows: int = 200):
    only_cache("nearcopies", _WORDS.clear)
    for whole in batches:
        for at in range(0, len(whole), rows):
            pdf = whole.iloc[at : at + rows]
            sets = [shingle_set(t, words_each) for t in pdf["text"]]
            prints = np.array([majority(s, _SEEDS) for s in sets], np.uint64).reshape(len(sets), WORDS)
            node = np.array([xxhash.xxh64_intdigest(s.tobytes()) for s in sets], np.uint64).astype(np.int64)
            packed = [np.unique((s >> np.uint64(32)).astype(np.uint32)).tobytes() for s in sets]
            f0, f1 = prints[:, :2].astype(np.int64).T
            yield pd.DataFrame({"id": pdf["id"].to_numpy(), "th": pdf["th"].to_numpy(), "node": node, "fp": [x.tobytes() for x in prints], "size": [len(s) for s in sets], "f0": f0, "f1": f1, "whole": whole_print(f0, f1), "shingles": packed})


def jaccard(a: bytes, b: bytes) -> float:
    """Similarity of two packed sets; two empty sets are equal."""
    x, y = np.frombuffer(a, np.uint32), np.frombuffer(b, np.uint32)
    both = len(np.intersect1d(x, y, assume_unique=True))
    union = len(x) + len(y) - both
    return both / union if union else 1.0


def _confirmed(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose sets have a similarity of `least` or more."""

    @F.pandas_udf("boolean")
    def near(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([jaccard(a, b) >= least for a, b in zip(x, y, strict=True)], dtype=bool)

    one, other = (sets.select(F.col("node").alias(c), F.col("shingles").alias(f"of_{c}")) for c in ("a", "b"))
    sizes = F.least(F.octet_length("of_a"), F.octet_length("of_b")) >= least * F.greatest(F.octet_length("of_a"), F.octet_length("of_b"))
    return pairs.join(one, "a").join(other, "b").filter(sizes).filter(near("of_a", "of_b")).select("a", "b")


def _links(batches, least: float, most: int = MOST, rows: int = 10_000, cells: int = 200_000):
    """Whole buckets, sorted by (key, i, j) -> links between nodes of different components. Pairs whose fingerprints
    differ in `most` bits or fewer are confirmed by their sets, unless the links found in this bucket already join them; so a bucket
    gives fewer links than it has components, however many pairs it has."""

    def of(pdf: pd.DataFrame):
        keys = pdf[["key", "i", "j"]].to_numpy(np.int64)
        begin = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(1)])
        found = []
        for a, b in zip(begin, np.r_[begin[1:], len(pdf)], strict=True):
            node, sets = pdf["node"].to_numpy()[a:b], pdf["shingles"].iloc[a:b].tolist()
            comp = np.unique(pdf["comp"].to_numpy()[a:b], return_inverse=True)[1]
            fp = pdf[["f0", "f1"]].to_numpy(np.int64)[a:b].astype(np.uint64)
            size = np.array([len(s) for s in sets])
            for at in range(b - a):
                rest = at + 1 + np.flatnonzero(comp[at + 1 :] != comp[at])
                rest = rest[np.minimum(size[rest], size[at]) >= least * np.maximum(size[rest], size[at])]
                for c in range(0, len(rest), cells // 16):
                    part = rest[c : c + cells // 16]
                    for other in part[np.bitwise_count(fp[part] ^ fp[at]).sum(1) <= most]:
                        if comp[other] != comp[at] and jaccard(sets[at], sets[other]) >= least:
                            found.append((min(node[at], node[other]), max(node[at], node[other])))
                            comp[comp == comp[other]] = comp[at]
        if found:
            yield pd.DataFrame(found, columns=["a", "b"]).astype("int64")

    held, count = [], 0
    for pdf in batches:
        held.append(pdf)
        count += len(pdf)
        if count >= rows:
            all_ = pd.concat(held, ignore_index=True)
            keys = all_[["key", "i", "j"]].to_numpy(np.int64)
            other = np.flatnonzero((keys != keys[-1]).any(1))
            cut = int(other[-1]) + 1 if len(other) else 0
            if cut:
                yield from of(all_.iloc[:cut])
            held, count = [all_.iloc[cut:]], len(all_) - cut
    if count:
        yield from of(pd.concat(held, ignore_index=True))


def _met(nodes: DataFrame, index_rows: int) -> DataFrame:
    """(key, turn, node, head): the nodes of each of the index's groups and of each set of equal fingerprints, with one of them drawn."""

    @F.pandas_udf("array<int>")
    def segs(fp: pd.Series, size: pd.Series) -> pd.Series:
        return pd.Series(segments(np.frombuffer(b"".join(fp), np.uint64).reshape(-1, WORDS), size.to_numpy()))

    found = indexed_groups(nodes.select("f0", "f1", segs("fp", "size").alias("segs")), MOST, index_rows).distinct()
    named = nodes.select("node", F.col("whole").alias("fp"))
    members = found.join(named, "fp").select("key", (F.col("seg") % HEADS).alias("turn"), "node")
    equal = named.groupBy("fp").count().filter("count > 1").select("fp")
    members = members.unionByName(named.join(equal, "fp").select(F.col("fp").alias("key"), F.lit(0).alias("turn"), "node"))
    heads = members.groupBy("key").agg(F.min_by("node", F.xxhash64("node", "turn")).alias("head"))
    return members.join(heads, "key").select("key", "turn", "node", "head")


def _labelled(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, comp) for every node, also those without an edge."""
    roots = components(edges)
    return nodes.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("comp"))


def groups(docs: DataFrame, least: float = 0.8, words_each: int = 5, bucket_rows: int = 5000, index_rows: int = 50_000) -> DataFrame:
    """docs (id long, th long, text string) -> (id, th, comp), one row for each row of docs. Rows are in one component if a
    chain of links joins their sets. Null and empty texts are copies of each other; a text of fewer than words_each words is
    one shingle. A group of more than bucket_rows nodes, or a bucket of more than index_rows,
    is compared in pairs of parts."""
    with shuffles_dropped(docs.sparkSession):
        with short_batches(docs.sparkSession):
            prints = stored(docs.select("id", "th", "text").mapInPandas(freeing(lambda it: _prints(it, words_each), _forget), PRINTS))
        nodes = stored(prints.groupBy("node").agg(*[F.first(c).alias(c) for c in ("fp", "size", "f0", "f1", "whole")]))
        met = stored(_met(nodes, index_rows))
        stars = met.filter("node <> head").select(F.col("head").alias("a"), F.col("node").alias("b"), "turn")
        wanted = met.select("node").distinct()
        sets = stored(prints.join(wanted, "node", "left_semi").groupBy("node").agg(F.first("shingles").alias("shingles"), F.first("f0").alias("f0"), F.first("f1").alias("f1")))
        first = checkpoint(_confirmed(stars.filter(F.col("turn") < FIRST).select("a", "b").distinct(), sets, least))
        comps = checkpoint(_labelled(wanted, first))
        later = met.filter(F.col("turn") >= FIRST).join(comps, "node")
        tops = later.filter("node = head").select("key", F.col("comp").alias("top"))
        later = later.join(tops, "key").filter("comp <> top").select(F.col("head").alias("a"), F.col("node").alias("b")).distinct()
        edges = checkpoint(first.unionByName(_confirmed(later, sets, least)))
        comps = checkpoint(_labelled(wanted, edges))

        named = met.select("key", "node").join(comps, "node")
        split = named.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("comp").alias("low"), F.max("comp").alias("high")).filter("low <> high")
        split = split.select("key", F.ceil(F.col("n") / bucket_rows).cast("int").alias("parts"))
        apart = named.join(split, "key").withColumn("own", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
        apart = apart.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        apart = apart.select("key", "node", "comp", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")).join(sets, "node")
        dealt = apart.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
        with short_batches(docs.sparkSession):
            left = checkpoint(dealt.mapInPandas(freeing(lambda it: _links(it, least)), "a long, b long").distinct())
        named = _labelled(nodes.select("node"), edges.unionByName(left))
    return prints.select("id", "th", "node").join(named, "node").select("id", "th", "comp")
