"""The pipeline's near-copy stage against a plain version over five-word sets."""

import random
import time
import tracemalloc

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerline.llm import bpe, minhash, nearcopies, packing, simhash
from tests.llm.test_operators import words

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def grams(text):
    w = (text or "").lower().split()
    n = min(5, len(w))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set()


def similar(x, y):
    return len(x & y) >= 0.8 * len(x | y)


def with_edits(seed, text, edits):
    r = random.Random(seed)
    w = text.split()
    for at in r.sample(range(0, len(w), 8), edits):
        w[at] = f"new{seed}"
    return " ".join(w)


def rows_with_copies():
    rows = [(i, words(i, 120)) for i in range(40)]
    rows += [(100 + i, with_edits(i, words(i % 20, 120), 1 + i % 5)) for i in range(60)]
    return rows + [(300, None), (301, ""), (302, "a b"), (303, "A  b"), (304, "a b c")]


def roots(texts):
    sets = [grams(t) for t in texts]
    linked = [[j for j, b in enumerate(sets) if similar(a, b)] for a in sets]
    root = list(range(len(texts)))
    for _ in texts:
        root = [min(root[j] for j in own) for own in linked]
    return root


def test_near_copies_are_all_dropped(spark):
    rows = rows_with_copies()
    texts = [t for _, t in rows]
    root = roots(texts)
    docs = spark.createDataFrame([(i, t, "en", "x", 1) for i, t in rows], DOCS).repartition(3)
    got = sorted(r.doc_id for r in corpus_pipeline.near_copies(spark, docs, "").collect())
    assert got == sorted(rows[k][0] for k in range(len(rows)) if root[k] == k)
    assert corpus_pipeline.near_copies(spark, docs.limit(0), "").count() == 0


@pytest.mark.parametrize("bucket_rows", [5000, 3])
def test_chains_of_copies_join(spark, bucket_rows):
    base = words(900, 120).split()
    texts = [" ".join([*(f"x{k}" for k in range(4 * i)), *base[4 * i :]]) for i in range(7)]  # neighbours alone are similar
    docs = spark.createDataFrame([(i, i, t) for i, t in enumerate(texts)], "id long, th long, text string")
    got = nearcopies.groups(docs, bucket_rows=bucket_rows).select("id", "comp")
    assert got.select("comp").distinct().count() == len(set(roots(texts)))
    assert got.filter(F.col("comp").isNull()).count() == 0


def test_candidates_come_from_the_gray_order_index(spark, monkeypatch):
    docs = spark.createDataFrame([(i, i, t) for i, t in rows_with_copies()[:100]], "id long, th long, text string")
    joined = lambda: docs.count() - nearcopies.groups(docs, index_rows=3).select("comp").distinct().count()
    assert joined() == 100 - len(set(roots([t for _, t in rows_with_copies()[:100]])))
    index = nearcopies.indexed_groups
    monkeypatch.setattr(nearcopies, "indexed_groups", lambda *args: index(*args).limit(0))
    assert joined() == 0


def test_index_links_wide_fingerprints():
    r = np.random.RandomState(3)
    fp = r.randint(0, 2**63, (60, 2), dtype=np.int64).astype(np.uint64)
    fp = np.concatenate([fp, fp[:30] ^ np.left_shift(np.uint64(1), r.randint(0, 64, (30, 2)).astype(np.uint64))])
    order = np.lexsort((*simhash.gray_rank(fp).T[::-1], np.arange(90) % 3))
    bucket, fp = (np.arange(90) % 3)[order], fp[order]
    for most in (1, 2, 45):
        root = list(range(90))
        apart = np.bitwise_count(fp[:, None] ^ fp[None]).sum(2)
        for _ in root:
            root = [min(root[j] for j in range(90) if bucket[j] == bucket[i] and apart[i, j] <= most) for i in range(90)]
        assert simhash.index_links(bucket, fp, most).tolist() == root


def test_majority_bits_by_a_plain_count():
    r = np.random.RandomState(4)
    for n in (0, 1, 2, 5, 24, 100, 5000):
        x = r.randint(0, 2**63, n, dtype=np.int64).astype(np.uint64)
        seeds = np.array([5, 9], np.uint64)
        want = [sum(sum((int(h) >> b) & 1 for h in minhash.mix(x ^ s)) * 2 > n and 1 << b for b in range(64)) for s in seeds]
        assert simhash.majority(x, seeds).tolist() == want


def peak_mb(run):
    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_segments_and_index_hold_little_at_a_time():
    r = np.random.RandomState(5)
    prints, sizes = r.randint(0, 2**63, (5000, nearcopies.WORDS), dtype=np.int64).astype(np.uint64), r.randint(1, 64, 5000)
    cut = nearcopies.segments(prints, sizes)
    for k in (0, 499, 500, 4999):
        bits = np.unpackbits(prints[k].view(np.uint8), bitorder="little")
        want = [s * 65536 + int("".join(map(str, bits[places])), 2) for s, places in enumerate(nearcopies._PLACES)]
        assert cut[k].tolist() == want[: len(want) if sizes[k] <= nearcopies.FEW else nearcopies.SEGMENTS]
    assert peak_mb(lambda: nearcopies.segments(prints, sizes)) < 12
    rows = pd.DataFrame({"at": np.arange(60_000) // 3000, "f0": r.randint(0, 2**63, 60_000, dtype=np.int64), "f1": r.randint(0, 2**63, 60_000, dtype=np.int64)})
    assert peak_mb(lambda: list(simhash._bucket_groups([rows], nearcopies.MOST))) < 60


def test_tasks_leave_neither_words_nor_shuffle_files(spark):
    files = lambda: spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString(" ").count("/shuffle_")
    docs = spark.createDataFrame([(i, i, t) for i, t in rows_with_copies()], "id long, th long, text string").repartition(8)
    before, key = files(), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    setting = spark.conf.get(key)
    found = nearcopies.groups(docs)
    until = time.time() + 20
    while files() > before and time.time() < until:
        time.sleep(0.2)
    assert files() <= before
    assert spark.conf.get(key) == setting
    assert found.count() == docs.count()

    def kept(batches):
        for _ in batches:
            pass
        yield pd.DataFrame({"n": [len(minhash._WORDS)]})

    assert {r.n for r in spark.range(64).repartition(16).mapInPandas(kept, "n long").collect()} == {0}


def test_packing_tasks_leave_no_words(spark):
    docs = spark.createDataFrame([(i, words(i, 60)) for i in range(40)], "doc_id long, text string").repartition(8)
    assert packing.pack(docs, bpe.vocabulary()).count() >= 40

    def kept(batches):
        for _ in batches:
            pass
        enc = packing.encoder(bpe.vocabulary(), 250_000)
        yield pd.DataFrame({"n": [len(enc.words) + len(enc.pieces) + len(enc.words.before) + len(enc.pieces.before)]})

    assert {r.n for r in spark.range(64).repartition(16).mapInPandas(kept, "n long").collect()} == {0}


def test_a_large_group_is_joined_by_few_pairs(spark, monkeypatch):
    base, made, confirmed = words(7, 120), [], nearcopies._confirmed
    docs = spark.createDataFrame([(i, i, with_edits(i, base, 1)) for i in range(150)], "id long, th long, text string")
    monkeypatch.setattr(nearcopies, "_confirmed", lambda pairs, *args: made.append(pairs.count()) or confirmed(pairs, *args))
    assert nearcopies.groups(docs).select("comp").distinct().count() == 1
    assert sum(made) < 9 * 150
