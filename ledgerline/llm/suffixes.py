"""Removal of long repeated byte strings by bucket-pointer refinement of suffixes.

A suffix array of everything is not needed to know which strings of `length` bytes repeat, only which suffixes share that
many bytes. Initial buckets: of the 24-grams inside a window of `length` bytes that with the least hash (the leftmost of
equals) anchors it; the window goes to the bucket of the 112 bytes that begin at the anchor, or of those that end with it
where less follows. Equal windows so always meet in one bucket, and a text of n bytes touches about n / 60 buckets. Buckets
met only once are dropped in Spark; for the rest each occurrence brings the bytes its windows span. Refinement, within tasks
that hold whole buckets: suffixes get bucket identifiers by their first 8 bytes and are refined by sorting on (own
identifier, identifier of the suffix 8, 16, ... bytes later), each round reusing the identifiers of the last, until they
tell apart the first `length` bytes; suffixes alone in a bucket leave at once.

Hot buckets: what a task has already seen twice needs no counting, so only one row of it goes to the counting shuffle and
the others are dealt out evenly; occurrences with the same bytes all around are settled in the task that finds them, which
passes on one; exact copies of a text are settled by a digest, and only one of them brings bytes. A bucket of more than
`bucket_rows` different occurrences is refined over many tasks: by the same rounds, with identifiers made from the two
identifiers they join instead of from ranks, so that tasks agree on them without meeting; Spark counts the last round's.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.llm.common import freeing, only_cache, short_batches, stored
from ledgerline.llm.minhash import mix

GRAM = 24
KEY = 112
PLACE_BITS = 20
PIECE = 1 << 19
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}
_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
BASE = np.uint64(0x9E3779B97F4A7C15)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and its inverse modulo 2**64."""
    if 0 not in _POWERS or len(_POWERS[0][0]) < n:
        n = max(n, 1 << 16)
        back = np.uint64(pow(int(BASE), -1, 1 << 64))
        _POWERS[0] = tuple(np.cumprod(np.r_[np.uint64(1), np.full(n - 1, b, np.uint64)]) for b in (BASE, back))
    return _POWERS[0][0][:n], _POWERS[0][1][:n]


def running_sums(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of a polynomial in the bytes, and the factors that move any run of bytes to the same place."""
    up, down = _powers(len(raw) + 1)
    return np.r_[np.uint64(0), np.cumsum(_BYTES[raw] * up[: len(raw)])], down


def run_hashes(sums: tuple[np.ndarray, np.ndarray], at: np.ndarray | slice, size: int) -> np.ndarray:
    """Hashes of the runs of `size` bytes that begin at the given places."""
    total, down = sums
    if isinstance(at, slice):
        return mix((total[size:] - total[:-size]) * down[: len(total) - size])
    return mix((total[at + size] - total[at]) * down[at])


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Least of every `width` neighbours, by block-wise running minima from both ends."""
    n = len(x)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = x
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


def anchors(raw: bytes, length: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(bucket key, first and last window start it stands for), in arrays, for pieces of a long text."""
    out = []
    width, reach = length - GRAM + 1, length - KEY
    data = np.frombuffer(raw, np.uint8)
    for at in range(0, max(len(data) - length + 1, 0), PIECE):
        sums = running_sums(data[at : at + PIECE + length - 1])
        hashes = run_hashes(sums, slice(None), GRAM)
        key = (hashes >> np.uint64(PLACE_BITS) << np.uint64(PLACE_BITS)) | np.arange(len(hashes), dtype=np.uint64)
        place = (_sliding_min(key, width) & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
        first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
        last = np.r_[first[1:], len(place)] - 1
        own = place[first]
        ahead = last >= own - reach  # windows in which KEY bytes follow the anchor's begin
        out.append((run_hashes(sums, own[ahead], KEY).astype(np.int64), np.maximum(first, own - reach)[ahead] + at, last[ahead] + at))
        behind = first < own - reach  # the others, in which KEY bytes end with the anchor
        out.append((~run_hashes(sums, own[behind] + GRAM - KEY, KEY).astype(np.int64), first[behind] + at, np.minimum(last, own - reach - 1)[behind] + at))
    return out


MARKS = "h long, h2 long, id long, th int, lo long, n int, whole boolean, seen int, salt long"


def _marks(batches, length: int):
    """Rows of (id, text, th): one per initial bucket a text touches, and one for the text itself (whole, digest h, h2).

    seen: 0 for a row that must be counted, 2 for one whose equal was met in this batch and that stands for all of them in
    the count, 1 for the others, which need no counting and are spread by salt. For whole texts id is the least of the
    batch in rows with 0 or 2.
    """
    only_cache("suffixes", lambda: None)
    for pdf in batches:
        cols: list[list[np.ndarray]] = [[] for _ in range(7)]
        for doc, text, th in zip(pdf["id"], pdf["text"], pdf["th"], strict=True):
            raw = text.encode("utf-8", "surrogatepass")
            if len(raw) < length:
                continue
            digest = np.frombuffer(hashlib.sha256(raw).digest()[:16], np.int64)
            found = [(digest[:1], digest[1:], np.array([doc]), np.array([th]), np.array([0]), np.array([len(raw)]), np.array([True]))]
            for h, a, b in anchors(raw, length):
                found.append((h, np.zeros(len(h), np.int64), np.full(len(h), doc), np.full(len(h), th), a, b - a + 1, np.zeros(len(h), bool)))
            for f in found:
                for c, v in zip(cols, f, strict=True):
                    c.append(v)
        if not cols[0]:
            continue
        kinds = (np.int64, np.int64, np.int64, np.int32, np.int64, np.int32, bool)
        out = pd.DataFrame({n: np.concatenate(c).astype(k) for n, c, k in zip(("h", "h2", "id", "th", "lo", "n", "whole"), cols, kinds, strict=True)})
        out = out.sort_values(["whole", "h", "h2", "id", "lo"], kind="stable")
        new = _changes(out)
        many = np.bincount(np.cumsum(new) - 1)[np.cumsum(new) - 1] > 1
        out["seen"] = np.where(new, np.where(many, 2, 0), 1).astype(np.int32)
        out["salt"] = np.where(out["seen"] == 1, np.arange(len(out)) + 1, 0)
        yield out[["h", "h2", "id", "th", "lo", "n", "whole", "seen", "salt"]]


def _changes(pdf: pd.DataFrame) -> np.ndarray:
    """Where a sorted table's bucket differs from the row before."""
    new = np.ones(len(pdf), bool)
    new[1:] = False
    for c in ("whole", "h", "h2"):
        v = pdf[c].to_numpy()
        new[1:] |= v[1:] != v[:-1]
    return new


KEPT = "id long, th int, h long, lo long, n int, copy int"


def _repeated(batches):
    """Sorted by (whole, h, h2, seen descending): rows whose bucket holds more than one. copy: 0 an anchor, 1 a text with
    copies that stands for them, 2 another copy."""
    held: pd.DataFrame | None = None  # the last row, whose bucket may go on
    name = ["whole", "h", "h2"]
    open_key, open_count = None, 0

    def finish(pdf: pd.DataFrame, keep: np.ndarray, rep: np.ndarray) -> pd.DataFrame:
        copy = np.where(pdf["whole"], np.where(rep, 1, 2), 0).astype(np.int32)
        return pdf.assign(copy=copy)[keep][["id", "th", "h", "lo", "n", "copy"]]

    for pdf in batches:
        direct = pdf["seen"] == 1
        if direct.any():
            yield finish(pdf[direct], np.ones(int(direct.sum()), bool), np.zeros(int(direct.sum()), bool))
        pdf = pdf[~direct]
        if held is not None:
            pdf = pd.concat([held, pdf], ignore_index=True)
        if not len(pdf):
            continue
        new = _changes(pdf)
        goes_on = open_key is not None and tuple(pdf[name].iloc[0]) == open_key
        group = np.cumsum(new) - 1
        size = np.bincount(group)
        twice = np.zeros(len(size), bool)
        np.logical_or.at(twice, group, pdf["seen"].to_numpy() == 2)
        keep = (size > 1) | twice
        if goes_on:
            keep[0] = keep[0] or open_count > 0
        rep = new.copy()
        if goes_on and open_count:
            rep[0] = False
        tail = len(pdf) - 1
        body = np.arange(len(pdf)) < tail
        yield finish(pdf[body], keep[group][body], rep[body])
        held = pdf.iloc[tail:]
        before = int((group == group[tail]).sum()) - 1 + (open_count if goes_on and group[tail] == 0 else 0)
        open_key, open_count = tuple(pdf[name].iloc[tail]), before
    if held is not None:
        yield finish(held, np.array([open_count > 0 or int(held["seen"].iloc[0]) == 2]), np.array([open_count == 0]))


CONTEXT = "h long, id long, th int, lo long, n int, many boolean, salt long, ctx binary"
SPANS = "id long, th int, begin long, end long, h long, n int, many boolean, ctx binary"


def _contexts(batches, length: int, rows: int = 20_000):
    """(id, th, text, marks) -> the bytes that each repeated bucket's windows span in this text. Occurrences whose bytes
    are the same are settled here: one is passed on as `many`, the others go without bytes, spread by salt."""

    def settle(out: list) -> pd.DataFrame:
        met: dict[tuple, list] = {}
        for r in out:
            one = met.setdefault((r[0], r[4], r[7]), r)
            if one is not r:
                one[5], r[5], r[7] = True, True, None
        for i, r in enumerate(out):
            r[6] = i + 1 if r[7] is None else 0
        return pd.DataFrame(out, columns=["h", "id", "th", "lo", "n", "many", "salt", "ctx"])

    out: list[list] = []
    for pdf in batches:
        stood: set[tuple] = set()
        for doc, th, text, marks in zip(pdf["id"], pdf["th"], pdf["text"], pdf["marks"], strict=True):
            copies = {m["copy"] for m in marks}
            if 2 in copies and 1 not in copies:
                continue
            if 1 in copies:  # repeated rows share their marks; one of a batch brings the bytes
                if (doc, th, text) in stood:
                    continue
                stood.add((doc, th, text))
            raw = text.encode("utf-8", "surrogatepass")
            for m in marks:
                if m["copy"] == 0:
                    out.append([m["h"], doc, th, m["lo"], m["n"], False, 0, raw[m["lo"] : m["lo"] + m["n"] - 1 + length]])
            if len(out) >= rows:
                yield settle(out)
                out = []
    if out:
        yield settle(out)


def refine(data: np.ndarray, starts: np.ndarray, bucket: np.ndarray, length: int) -> np.ndarray:
    """Which of the suffixes `starts` share their first `length` bytes with another of the same bucket.

    data: bytes, long enough behind every start. Identifiers of round r tell apart the first 8 * 2**r bytes; they are kept
    for the positions that later rounds point to, which shrink with the suffixes that still share a bucket.
    """
    steps, depth = [], 8
    while depth * 2 <= length:
        steps.append(depth)
        depth *= 2
    if length > depth:
        steps.append(length - depth)

    def pointed(active: np.ndarray, rounds: list[int]) -> np.ndarray:
        mask = np.zeros(len(data), bool)
        mask[active] = True
        for step in reversed(rounds):
            at = np.flatnonzero(mask)
            mask[at + step] = True
        return np.flatnonzero(mask)

    def shared(ids: np.ndarray, own: np.ndarray) -> np.ndarray:
        got = np.unique(ids * np.int64(len(data) + 1) + own, return_inverse=True)[1]
        return np.bincount(got)[got] > 1

    alive = np.arange(len(starts))
    pointer = np.zeros(len(data), np.int32)
    at = pointed(starts, steps)
    words = np.lib.stride_tricks.sliding_window_view(data, 8)[at]
    pointer[at] = np.unique(np.ascontiguousarray(words).view(">u8").ravel(), return_inverse=True)[1]
    for i, step in enumerate(steps):
        alive = alive[shared(bucket[alive], pointer[starts[alive]].astype(np.int64))]
        if not len(alive):
            break
        at = pointed(starts[alive], steps[i + 1 :])
        pair = pointer[at].astype(np.int64) * np.int64(len(data) + 1) + pointer[at + step]
        pointer[at] = np.unique(pair, return_inverse=True)[1]
    hit = np.zeros(len(starts), bool)
    if len(alive):
        hit[alive[shared(bucket[alive], pointer[starts[alive]].astype(np.int64))]] = True
    return hit


def _table(rows: list, columns: list[str]) -> pd.DataFrame:
    """Rows of SPANS: spans, or occurrences of a large bucket, with the other columns null."""
    names = [c.split()[0] for c in SPANS.split(", ")]
    return pd.DataFrame(rows, columns=columns).reindex(columns=names).astype({"begin": "Int64", "end": "Int64", "h": "Int64", "n": "Int32"})


def _spans_of(pdf: pd.DataFrame, length: int) -> pd.DataFrame:
    """Whole buckets of occurrences -> spans of bytes under windows that repeat. Equal bytes are settled together."""
    group = pdf.groupby(["h", "n", "ctx"], sort=False).ngroup().to_numpy()
    size = np.bincount(group, 1 + pdf["many"].to_numpy())
    first = np.full(len(size), -1)
    first[group[::-1]] = np.arange(len(pdf))[::-1]
    h = pdf["h"].to_numpy()[first]
    kinds = np.bincount(np.unique(h, return_inverse=True)[1])[np.unique(h, return_inverse=True)[1]]
    ctx, n = pdf["ctx"].to_numpy()[first], pdf["n"].to_numpy()[first]
    runs_of = [[(0, int(n[i]) - 1)] if size[i] > 1 else [] for i in range(len(size))]
    unsettled = np.unique(h[(kinds > 1) & (size == 1)])
    open_ = np.flatnonzero(np.isin(h, unsettled))
    if len(open_):
        sizes = np.array([len(c) for c in ctx[open_]])
        begins = np.cumsum(sizes) - sizes
        counts = n[open_].astype(np.int64)
        at = np.cumsum(counts) - counts
        owner = np.repeat(np.arange(len(open_)), counts)
        starts = begins[owner] + np.arange(counts.sum()) - at[owner]
        bucket = np.unique(h[open_], return_inverse=True)[1][owner]
        hit = refine(np.frombuffer(b"".join(ctx[open_]) + b"\0" * 8, np.uint8), starts, bucket, length)
        for i, k in enumerate(open_):
            if size[k] == 1:
                mine = np.r_[False, hit[at[i] : at[i] + counts[i]], False]
                turn = np.flatnonzero(mine[1:] != mine[:-1])
                runs_of[k] = list(zip(turn[::2].tolist(), (turn[1::2] - 1).tolist(), strict=True))
    out = [(doc, th, lo + a, lo + b + length) for doc, th, lo, g in zip(pdf["id"], pdf["th"], pdf["lo"], group, strict=True) for a, b in runs_of[g]]
    return _table(out, ["id", "th", "begin", "end"])


def _refined(batches, length: int, bucket_rows: int, rows: int = 4000):
    """Occurrences sorted by bucket -> spans; whole buckets are gathered until there are `rows` rows. A bucket that has more
    than bucket_rows different occurrences is passed on as it is."""
    held: list[pd.DataFrame] = []
    count, large = 0, None
    own = ["id", "th", "begin", "h", "n", "many", "ctx"]
    for pdf in batches:
        pdf = pdf.assign(ctx=[None if c is None else bytes(c) for c in pdf["ctx"]])
        done = pdf["ctx"].isna()
        if done.any():
            d = pdf[done]
            yield _table(list(zip(d["id"], d["th"], d["lo"], d["lo"] + d["n"] - 1 + length, strict=True)), ["id", "th", "begin", "end"])
            pdf = pdf[~done]
        for at in range(0, len(pdf), rows):
            piece = pdf.iloc[at : at + rows]
            if large is not None:
                same = (piece["h"] == large).to_numpy()
                if same.any():
                    yield _table(piece[same].rename(columns={"lo": "begin"})[own].to_dict("records"), own)
                piece = piece[~same]
                if not len(piece):
                    continue
                large = None
            held.append(piece)
            count += len(piece)
            if count < rows:
                continue
            all_ = pd.concat(held, ignore_index=True)
            h = all_["h"].to_numpy()
            other = np.flatnonzero(h != h[-1])
            cut = int(other[-1]) + 1 if len(other) else 0
            if cut:
                yield _spans_of(all_.iloc[:cut].reset_index(drop=True), length)
            rest = all_.iloc[cut:]
            if len(rest) > bucket_rows:
                large = rest["h"].iloc[0]
                yield _table(rest.rename(columns={"lo": "begin"})[own].to_dict("records"), own)
                rest = rest.iloc[:0]
            held, count = [rest] if len(rest) else [], len(rest)
    if count:
        yield _spans_of(pd.concat(held, ignore_index=True), length)


#: Factors of the two halves of an identifier that is made from content.
HALVES = ((np.uint64(0x9FB21C651E98DF25), np.uint64(0xA0761D6478BD642F)), (np.uint64(0xE7037ED1A0B428DB), np.uint64(0x8EBC6AF09C88C6E3)))


def content_identifiers(ctx: bytes, n: int, length: int) -> np.ndarray:
    """Identifiers, 128 bits each, of the n windows of a context, by the rounds that refine() makes: of the first 8 bytes their
    value, then of twice as many the one made of the own identifier and of that so many bytes later, until `length` bytes
    are told apart. Made from content and not from ranks, they are the same in every task."""
    raw = np.frombuffer(ctx, np.uint8).astype(np.uint64)
    first = np.zeros(len(raw) - 7, np.uint64)
    for i in range(8):
        first |= raw[i : len(raw) - 7 + i] << np.uint64(8 * i)
    ids, width = [first, first], 8
    while width < length:
        step = min(width, length - width)
        ids = [mix(x[:-step] * f + mix(x[step:] + g)) for x, (f, g) in zip(ids, HALVES, strict=True)]
        width += step
    return np.stack([x[:n] for x in ids], axis=1).view(np.int64)


def _windows(batches, length: int):
    """The windows of a bucket too large for a task, with their identifiers; n counts twice what is known to repeat."""
    for pdf in batches:
        for doc, th, lo, n, many, ctx in zip(pdf["id"], pdf["th"], pdf["begin"], pdf["n"], pdf["many"], pdf["ctx"], strict=True):
            w = content_identifiers(bytes(ctx), int(n), length)
            yield pd.DataFrame({"id": doc, "th": th, "at": lo + np.arange(n), "w1": w[:, 0], "w2": w[:, 1], "times": 1 + bool(many)})


def merged(spans) -> list[tuple[int, int]]:
    """Spans in order, overlapping and touching ones as one."""
    out: list[list[int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([begin, end])
    return [(a, b) for a, b in out]


def repeated_spans(docs: DataFrame, length: int = 200, bucket_rows: int = 20_000) -> DataFrame:
    """docs (id long, th int, text string), one row per text with th a hash of it -> (id, th, begin, end): bytes under
    strings of `length` bytes that start anywhere else too. Spans of one text may overlap. A text with an exact copy is
    one span."""
    marks = docs.mapInPandas(freeing(lambda it: _marks(it, length)), MARKS)
    dealt = marks.repartition("h", "h2", "salt").sortWithinPartitions("whole", "h", "h2", "id", "lo")
    with short_batches(docs.sparkSession, 4000):
        kept = stored(dealt.mapInPandas(freeing(_repeated), KEPT))
    by_doc = kept.groupBy("id", "th").agg(F.collect_set(F.struct("h", "lo", "n", "copy")).alias("marks"))
    contexts = docs.join(by_doc, ["id", "th"]).mapInPandas(freeing(lambda it: _contexts(it, length)), CONTEXT)
    whole = kept.filter("copy > 0").select("id", "th", F.lit(0).cast("long").alias("begin"), F.col("n").cast("long").alias("end"))
    with short_batches(docs.sparkSession):
        found = stored(contexts.repartition("h", "salt").sortWithinPartitions("h").mapInPandas(freeing(lambda it: _refined(it, length, bucket_rows)), SPANS))
    spans = found.filter("ctx is null").select("id", "th", "begin", "end").unionByName(whole)
    large = found.filter("ctx is not null")
    if large.isEmpty():
        return spans
    windows = stored(large.mapInPandas(lambda it: _windows(it, length), "id long, th int, at long, w1 long, w2 long, times int"))
    twice = windows.groupBy("w1", "w2").agg(F.sum("times").alias("n")).filter("n > 1").select("w1", "w2")
    return spans.unionByName(windows.join(twice, ["w1", "w2"]).select("id", "th", F.col("at").alias("begin"), (F.col("at") + length).alias("end")))


def joined_runs(spans: DataFrame) -> DataFrame:
    """(id, th, begin, end) -> one row for each (id, th) with _spans, its spans in order, overlapping and touching ones as one."""
    order = Window.partitionBy("id", "th").orderBy("begin")
    past = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    longest = spans.groupBy("id", "th", "begin").agg(F.max("end").alias("end"))
    fresh = longest.withColumn("fresh", F.when(F.col("begin") <= past, 0).otherwise(1))
    runs = fresh.withColumn("run", F.sum("fresh").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    wide = runs.groupBy("id", "th", "run").agg(F.min("begin").alias("begin"), F.max("end").alias("end"))
    return wide.groupBy("id", "th").agg(F.sort_array(F.collect_list(F.struct("begin", "end"))).alias("_spans"))


def cut_spans(raw: bytes, spans) -> tuple[bytes, int]:
    """The bytes outside the spans, and how many maximal runs were cut."""
    runs = merged(spans)
    edges = [0, *(x for span in runs for x in span), len(raw)]
    return b"".join(raw[edges[i] : edges[i + 1]] for i in range(0, len(edges), 2)), len(runs)


def deduplicate(docs: DataFrame, length: int = 200, id_col: str = "doc_id", text_col: str = "text", bucket_rows: int = 20_000, most_broadcast: int = 500_000, with_text: bool = False) -> DataFrame:
    """docs -> all its columns and `kept` binary (the bytes that stay), `n_bytes`, `n_removed`, `n_spans`.

    Each byte of a text (UTF-8; null counts as empty) under a string of `length` bytes that also starts elsewhere, in the
    same or another row, goes; strings are judged on the input and never cross rows. Texts shorter than `length` stay.
    Repeated rows are copies of each other. Rows are told apart by id and text, those with a null id or one id by their text. No rows: none. Columns with
    these names, or named _id, _th, _spans, _bytes, _all or _cut, are replaced. with_text adds `kept_text`, the kept bytes
    as a string without what is left of a character that was cut in two.
    """
    names = [c for c in docs.columns if c not in ("kept", "kept_text", "n_bytes", "n_removed", "n_spans", "_id", "_th", "_spans", "_bytes", "_all", "_cut")]
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(*names, F.xxhash64(F.col(id_col), text).alias("_id"), F.hash(text).alias("_th"))  # 96 bits tell rows apart
    spans = repeated_spans(keyed.select(F.col("_id").alias("id"), F.col("_th").alias("th"), text.alias("text")), length, bucket_rows)

    found = stored(joined_runs(spans).select(F.col("id").alias("_id"), F.col("th").alias("_th"), "_spans"))
    few = (found.agg(F.sum(F.size("_spans") + 1)).first()[0] or 0) <= most_broadcast
    joined = keyed.join(F.broadcast(found) if few else found, ["_id", "_th"], "left")

    @F.pandas_udf("kept binary, kept_text string, n_spans long")
    def cut(text: pd.Series, spans: pd.Series) -> pd.DataFrame:
        out = []
        for t, s in zip(text, spans, strict=True):
            if s is None or not len(s):
                out.append((None, None, 0))
                continue
            kept, runs = cut_spans((t or "").encode("utf-8", "surrogatepass"), [(x["begin"], x["end"]) for x in s])
            out.append((kept, kept.decode("utf-8", "ignore") if with_text else None, runs))
        return pd.DataFrame(out, columns=["kept", "kept_text", "n_spans"])

    source = F.coalesce(F.col(text_col), F.lit(""))
    done = joined.select(*names, F.octet_length(source).cast("long").alias("_bytes"), source.alias("_all"), cut(F.col(text_col), F.col("_spans")).alias("_cut"))
    kept = F.coalesce("_cut.kept", F.col("_all").cast("binary"))
    text_too = [F.coalesce("_cut.kept_text", "_all").alias("kept_text")] if with_text else []
    return done.select(*names, kept.alias("kept"), *text_too, F.col("_bytes").alias("n_bytes"), (F.col("_bytes") - F.octet_length(kept)).alias("n_removed"), "_cut.n_spans")


def op10_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return deduplicate(docs).select("doc_id", "n_bytes", F.col("n_removed").cast("long").alias("n_removed"), "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
