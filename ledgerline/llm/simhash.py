"""SimHash near-duplicates, linked through a Gray-order hierarchical index.

Fingerprints are reduced to distinct values first, so copies cost nothing. Each value is routed by its four 16-bit
segments: two values within 3 bits share a whole segment, so they meet in some bucket. Within a bucket the values are
sorted by Gray rank, where neighbours differ in few bits; every eight neighbours form a node that holds the bits they all
share (bits under a mask), every eight nodes an upper node, up to one root. Nodes are then joined with nodes downwards:
a pair carries the differences counted on the bits both sides fix, only newly fixed bits are added lower down, and a pair
of whole groups is dropped once the sum passes the limit, or once all their members are already in one component. A
bucket gives a spanning star per component, never all its pairs; components() joins the stars over all buckets.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import checkpoint, freeing, only_cache
from ledgerline.llm.components import components
from ledgerline.llm.minhash import mix

FAN = 8
ALL = np.uint64(2**64 - 1)
BUCKET = ["seg", "val", "i", "j"]


def fingerprint(text: str | None, words_each: int = 3, seed: int = 42) -> int:
    """Majority bits of the XXH64 of all word shingles, repeats included; no word: 0. Null counts as empty."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) <= words_each:
        return xxhash.xxh64_intdigest(b" ".join(words), seed)
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    spans = zip(starts[: len(words) - words_each + 1].tolist(), ends[words_each - 1 :].tolist(), strict=True)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(line[a:b], seed) for a, b in spans), np.uint64, len(words) - words_each + 1)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65536):
        counts += np.unpackbits(hashes[at : at + 65536].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp): fp is the fingerprint's bits as a signed long."""

    def run(batches):
        only_cache("simhash", lambda: None)
        for pdf in batches:
            yield pd.DataFrame({"id": pdf["id"], "fp": np.array([fingerprint(t) for t in pdf["text"]], np.uint64).astype(np.int64)})

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInPandas(run, "id long, fp long")


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Place of a bit pattern in the order of the reflected Gray code."""
    for s in (1, 2, 4, 8, 16, 32):
        x = x ^ (x >> np.uint64(s))
    return x


def majority(hashes: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """A fingerprint of 64 bits for each seed over a set's 64-bit hashes, each mixed with each seed: a bit is 1 if set in over half
    of them. Rows are added up three at a time into sums and carries (bit-sliced counters) before bits are counted one by one."""
    counts, level, rows, step = np.zeros(64 * len(seeds), np.int64), {}, 4096, 24
    for at in range(0, len(hashes), rows):
        level.setdefault(0, []).append(mix(hashes[at : at + rows, None] ^ seeds))
        power = 0
        while power in level:
            x = np.concatenate(level.pop(power))
            while len(x) >= step:
                t = len(x) // 3
                a, b, c = x[:t], x[t : 2 * t], x[2 * t : 3 * t]
                either = a ^ b
                level.setdefault(power + 1, []).append((a & b) | (either & c))
                x = np.concatenate([either ^ c, x[3 * t :]])
            counts += np.unpackbits(x.astype("<u8", copy=False).view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64) << power
            power += 1
    return np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")


def _levels(bucket: np.ndarray, fp: np.ndarray) -> list[dict]:
    """Nodes of every level, leaves first; bucket and fp are sorted. A node: bits and mask all its leaves share, children."""
    level = {"bucket": bucket, "all": fp, "any": fp, "start": np.arange(len(fp)), "end": np.arange(len(fp)) + 1}
    levels = [level]
    while True:
        b = level["bucket"]
        first = np.r_[True, b[1:] != b[:-1]]
        place = np.arange(len(b)) - np.maximum.accumulate(np.where(first, np.arange(len(b)), 0))
        cut = np.flatnonzero(place % FAN == 0)
        if len(cut) == len(b) and first.all():
            break
        level = {"bucket": b[cut], "all": np.bitwise_and.reduceat(level["all"], cut), "any": np.bitwise_or.reduceat(level["any"], cut), "start": cut, "end": np.r_[cut[1:], len(b)]}
        levels.append(level)
    for x in levels:
        x["mask"] = ~(x["all"] ^ x["any"])
        x["bits"] = x["all"] & x["mask"]
    leaf = np.arange(len(fp))
    for x in levels[1:]:
        leaf = leaf[x["start"]]
        x["leaf"] = leaf
    return levels


def _unite(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Merge the components of a[i] and b[i]; labels hold each entry's least member."""
    while True:
        x, y = labels[a], labels[b]
        differ = x != y
        if not differ.any():
            return
        a, b, x, y = a[differ], b[differ], x[differ], y[differ]
        np.minimum.at(labels, np.maximum(x, y), np.minimum(x, y))
        while True:
            to = labels[labels]
            if (to == labels).all():
                break
            labels[:] = to


def index_links(bucket: np.ndarray, fp: np.ndarray, most: int = 3, chunk: int = 20_000) -> np.ndarray:
    """labels: for each entry the least entry of its component within its bucket, at most bits apart. Inputs are sorted
    by (bucket, Gray rank). fp has one row for each entry, of one or more 64-bit words."""
    fp = fp.reshape(len(fp), -1)
    labels = np.arange(len(fp))
    if len(fp) < 2:
        return labels
    levels = _levels(bucket, fp)
    top = len(levels) - 1
    roots = np.flatnonzero(levels[top]["end"] > levels[top]["start"]) if top else np.arange(0)
    zero = np.zeros(len(roots), np.int64)
    stack = [(top, roots[i : i + chunk], roots[i : i + chunk], zero[i : i + chunk], np.zeros((len(roots[i : i + chunk]), fp.shape[1]), np.uint64)) for i in range(0, len(roots), chunk)]
    changed, spans = True, {}
    while stack:
        depth, a, b, apart, known = stack.pop()
        if changed:
            spans, changed = {}, False
        if depth not in spans:
            starts = levels[depth]["leaf"]
            spans[depth] = (np.minimum.reduceat(labels, starts), np.maximum.reduceat(labels, starts))
        low, high = spans[depth]
        open_ = ~((low[a] == high[a]) & (low[b] == high[b]) & (low[a] == low[b]))
        a, b, apart, known = a[open_], b[open_], apart[open_], known[open_]
        if not len(a):
            continue
        here, below = levels[depth], levels[depth - 1]
        ca, cb = here["end"][a] - here["start"][a], here["end"][b] - here["start"][b]
        n = ca * cb
        pair = np.repeat(np.arange(len(a)), n)
        off = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        x = here["start"][a][pair] + off // cb[pair]
        y = here["start"][b][pair] + off % cb[pair]
        ok = np.where(a[pair] == b[pair], x < y if depth == 1 else x <= y, True)
        x, y, pair = x[ok], y[ok], pair[ok]
        fixed = below["mask"][x] & below["mask"][y]
        new = fixed & ~known[pair]
        total = apart[pair] + np.bitwise_count((below["bits"][x] ^ below["bits"][y]) & new).sum(1, dtype=np.int64)
        ok = total <= most
        x, y, total, fixed = x[ok], y[ok], total[ok], fixed[ok]
        if depth == 1:
            before = labels[x] != labels[y]
            if before.any():
                _unite(labels, x[before], y[before])
                changed = True
            continue
        order = np.argsort(x == y, kind="stable")  # groups paired with themselves are popped first, so clusters close early
        for i in range(0, len(order), chunk):
            s = order[i : i + chunk]
            stack.append((depth - 1, x[s], y[s], total[s], fixed[s]))
    return labels


def _whole_buckets(batches, by: list[str], least_rows: int = 100_000):
    """Rows sorted by the columns `by`, in chunks of whole buckets."""
    held: list[pd.DataFrame] = []
    rows = 0
    for pdf in batches:
        if not len(pdf):
            continue
        held.append(pdf)
        rows += len(pdf)
        if rows >= least_rows:
            all_ = pd.concat(held, ignore_index=True)
            keys = all_[by].to_numpy(np.int64)
            last = np.flatnonzero((keys != keys[-1]).any(1))
            cut = int(last[-1]) + 1 if len(last) else 0
            if cut:
                yield all_.iloc[:cut]
            held, rows = [all_.iloc[cut:]], len(all_) - cut
    if held:
        yield pd.concat(held, ignore_index=True)


def _indexed(pdf: pd.DataFrame, by: list[str], fp: list[str], most: int, chunk: int = 20_000):
    """(order, bucket, labels) of whole buckets: rows by bucket and Gray rank, and the least row of each row's component."""
    keys = pdf[by].to_numpy(np.int64)
    bucket = np.cumsum(np.r_[0, (keys[1:] != keys[:-1]).any(1)])
    words = pdf[fp].to_numpy(np.int64).astype(np.uint64)
    order = np.lexsort((*gray_rank(words).T[::-1], bucket))
    return order, bucket[order], index_links(bucket[order], words[order], most, chunk)


def _bucket_stars(batches, most: int):
    """Sorted rows (seg, val, i, j, fp) -> star edges (a, b) per bucket."""
    for pdf in _whole_buckets(batches, BUCKET):
        order, _, labels = _indexed(pdf, BUCKET, ["fp"], most)
        fp = pdf["fp"].to_numpy(np.int64)[order]
        far = np.flatnonzero(labels != np.arange(len(labels)))
        yield pd.DataFrame({"a": fp[far], "b": fp[labels[far]]})


def whole_print(f0, f1):
    """One number for a fingerprint of two words."""
    return mix(np.asarray(f0, np.int64).astype(np.uint64) ^ mix(np.asarray(f1, np.int64).astype(np.uint64))).astype(np.int64)


def _bucket_groups(batches, most: int):
    """Sorted rows (at, f0, f1) -> (key, seg, fp) for each entry of a component of two or more in its bucket."""
    for pdf in _whole_buckets(batches, ["at"]):
        order, _, labels = _indexed(pdf, ["at"], ["f0", "f1"], most, 4000)
        far = np.flatnonzero(np.bincount(labels, minlength=len(labels))[labels] > 1)
        if len(far):
            pdf = pdf.iloc[order]
            fp, at = whole_print(pdf["f0"], pdf["f1"]), pdf["at"].to_numpy(np.int64)[far].astype(np.uint64)
            key = mix(mix(at) ^ fp[labels[far]].astype(np.uint64)).astype(np.int64)
            yield pd.DataFrame({"key": key, "seg": (at >> np.uint64(56)).astype(np.int32), "fp": fp[far]})


def _large(rows: DataFrame, bucket_rows: int) -> DataFrame:
    """The buckets of more than bucket_rows, with the parts each is split into."""
    return rows.groupBy("seg", "val").count().filter(F.col("count") > bucket_rows).select("seg", "val", F.ceil(F.col("count") / bucket_rows).cast("int").alias("parts"))


def _split(rows: DataFrame, large: DataFrame, own: list[str]) -> DataFrame:
    """rows (seg, val, `own` and others) with the parts i and j of their buckets. A large bucket is split
    by a hash of `own` into parts, and each pair of parts becomes a bucket of its own, so that no task holds more than about
    twice that many rows and no link is lost."""
    rest = [c for c in rows.columns if c not in BUCKET]
    rows = rows.join(large, ["seg", "val"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    rows = rows.withColumn("own", F.pmod(F.xxhash64(*own), F.col("parts")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return rows.select(*rest, "seg", "val", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))


def links(distinct: DataFrame, most: int = 3, bucket_rows: int = 50_000) -> DataFrame:
    """distinct (fp) -> edges (a, b) between values at most `most` (up to 3) bits apart, enough to connect all of them.

    A bucket of more than bucket_rows values is compared in pairs of parts.
    """
    if not 0 <= most <= 3:
        raise ValueError("four segments find links of at most 3 bits")
    segs = F.array(*[F.struct(F.lit(s).alias("seg"), F.expr(f"cast(shiftrightunsigned(fp, {16 * s}) & 65535 as int)").alias("val")) for s in range(4)])
    rows = distinct.select("fp", F.explode(segs).alias("s")).select("fp", "s.seg", "s.val")
    dealt = _split(rows, _large(rows, bucket_rows), ["fp"]).repartition(*BUCKET).sortWithinPartitions(*BUCKET)
    return dealt.mapInPandas(lambda it: _bucket_stars(it, most), "a long, b long").distinct()


def indexed_groups(distinct: DataFrame, most: int, bucket_rows: int = 50_000) -> DataFrame:
    """distinct (f0 long, f1 long, segs array<int>) -> (key, seg, fp): the groups that the index makes of each segment's bucket, linked
    at `most` or fewer of the 128 bits; fp is whole_print(f0, f1). segs holds segment * 65536 + its 16 bits, as many as a
    fingerprint has. Buckets are counted only where 64 neighbouring ones together exceed bucket_rows. Both lists of large ones are
    broadcast: neither has more rows than a bucket_rows-th of the segments' rows."""
    rows = distinct.select("f0", "f1", F.explode("segs").alias("s"))
    rows = rows.select("f0", "f1", F.expr("shiftright(s, 16)").alias("seg"), F.expr("s & 65535").alias("val"))
    wide = rows.groupBy("seg", F.expr("shiftright(val, 6)").alias("near")).count().filter(F.col("count") > bucket_rows).select("seg", "near")
    some = rows.select("seg", "val", F.expr("shiftright(val, 6)").alias("near")).join(F.broadcast(wide), ["seg", "near"], "left_semi")
    split = _split(rows, F.broadcast(_large(some, bucket_rows)), ["f0", "f1"])
    packed = "shiftleft(cast(seg as long), 56) | shiftleft(cast(val as long), 40) | shiftleft(cast(i as long), 20) | j"  # one number shuffles in half the space
    dealt = split.select("f0", "f1", F.expr(packed).alias("at")).repartition("at").sortWithinPartitions("at")
    return dealt.mapInPandas(freeing(lambda it: _bucket_groups(it, most)), "key long, seg int, fp long")


def near_duplicates(docs: DataFrame, most: int = 3, id_col: str = "doc_id", text_col: str = "text", bucket_rows: int = 50_000) -> DataFrame:
    """docs -> (doc_id, fingerprint, component_id), one row for each row of docs.

    fingerprint: 16 lowercase hex digits. component_id: the smallest id reachable over links of at most `most` bits, the
    row's own id included. Null and empty texts have fingerprint zero and are linked like any other; repeated rows come
    back as often as they were given. A null id never is a component_id unless a component has no other. No rows: none.
    """
    prints = checkpoint(fingerprints(docs, id_col, text_col))
    values = checkpoint(prints.groupBy("fp").agg(F.min("id").alias("least")))
    roots = components(links(values.select("fp"), most, bucket_rows))
    rooted = values.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = rooted.join(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("fp", "component_id")
    return prints.join(named, "fp").select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op2_simhash(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
