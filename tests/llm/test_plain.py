"""Archive digests, encodings, packed pieces and fingerprint bins against plain versions, on awkward and empty tables."""

import base64
import hashlib
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import xxhash
from tokenizers import Tokenizer

from ledgerline.llm import bpe, minhash, packing, suffixes, warc
from tests.llm.test_operators import AWKWARD, words

BIG = (1 << 60) + 1
CLASH = "doc_id long, text string, n_tokens int, ids string, part int, fingerprint string, start string"
ROWS = [*AWKWARD, (40, words(11, 60_000)), (41, "<|endoftext|> x"), (42, "naïve ŠŒß ​﻿ 12٣"), (42, "again")]


def table(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x", 2, "f", "s") for i, t in rows], CLASH).repartition(3)


def test_encodings_are_those_of_the_library(spark):
    library = Tokenizer.from_file(bpe.vocabulary())
    want = Counter()
    for i, t in ROWS:
        ids = library.encode(t or "", add_special_tokens=False).ids
        said = library.decode(ids, skip_special_tokens=False)
        want[i, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(said.encode()).hexdigest()] += 1
    got = Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.encode_digests(table(spark, ROWS), bpe.vocabulary()).collect())
    assert got == want
    assert bpe.encode_digests(table(spark, ROWS).limit(0), bpe.vocabulary()).count() == bpe.encode_documents(table(spark, ROWS).limit(0), bpe.vocabulary()).count() == 0


def test_pieces_hold_every_id_once(spark):
    library = Tokenizer.from_file(bpe.vocabulary())
    rows = [(i, t) for i, t in ROWS if i not in (3, 42)] + [(3, "One")]
    ids = {i: [*library.encode(t or "", add_special_tokens=False).ids, 2] for i, t in rows}
    got = packing.pack(table(spark, rows), bpe.vocabulary()).collect()
    of, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        of[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
        assert r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{r.length}I", *ids[r.doc_id][r.start : r.start + r.length]))
    assert set(of) == set(ids)
    for i, pieces in of.items():
        spans = sorted((p.start, p.length) for p in pieces)
        assert [s for s, _ in spans] == [0, *np.cumsum([n for _, n in spans])[:-1]] and sum(n for _, n in spans) == len(ids[i])
    for pieces in sequences.values():
        spans = sorted((p.offset, p.length) for p in pieces)
        assert [s for s, _ in spans] == [0, *np.cumsum([n for _, n in spans])[:-1]] and sum(n for _, n in spans) <= 4096


def test_archive_digests_are_those_of_the_payloads(spark, tmp_path):
    rows = [(1, "http://a/1", "<p>é</p>"), (2, "http://a/2", "<p>é</p>"), (3, None, None), (4, "http://b/ x", ""), (BIG, "u", "<p>é</p>\r\n\r\nWARC/1.0\r\n"), (5, "v", "z" * 300_000)]
    pages = spark.createDataFrame([(*r, "c", 3) for r in rows], "page_id long, url string, html string, payload string, digest int")
    got = {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.archive(pages, str(tmp_path / "w")).collect()}
    raw = {i: (h or "").encode() for i, _, h in rows}
    first = {p: max(i for i in raw if raw[i] == p) for p in raw.values()}
    sha = lambda p: base64.b32encode(hashlib.sha1(p).digest()).decode()
    assert got == {i: (len(p), sha(p), "response" if first[p] == i else "revisit", None if first[p] == i else first[p]) for i, p in raw.items()}


M = (1 << 64) - 1


def plain_mix(x):
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & M
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & M
    return x ^ (x >> 31)


def plain_print(text, bins, bits):
    """Shingle by shingle, bin by bin, with one attempt after another for an empty bin."""
    odd, w = 0x9E3779B97F4A7C15, (text or "").split()
    if not w:
        return ""
    n, least = min(5, len(w)), {}
    for i in range(len(w) - n + 1):
        h = 0
        for x in w[i : i + n]:
            h = (h * odd + xxhash.xxh64_intdigest(x.encode())) & M
        h = plain_mix((h + n) & M)
        at = h >> (64 - (bins.bit_length() - 1))
        least[at] = min(h, least.get(at, M))
    out = []
    for i in range(bins):
        attempt, at = 0, i
        while at not in least:
            at = plain_mix((i * odd + plain_mix(attempt + 1)) & M) % bins
            attempt += 1
        out.append(plain_mix((least[at] + i * odd) & M) & ((1 << bits) - 1))
    text_bits = "".join(f"{v:0{bits}b}" for v in out)
    return int(text_bits, 2).to_bytes(len(text_bits) // 8, "big").hex()


def test_fingerprint_bins_and_densification():
    for bins, bits in ((512, 4), (64, 2), (128, 8)):
        for text in [t for _, t in AWKWARD] + [words(s, n) for s, n in ((1, 1), (2, 4), (3, 7), (4, 200), (5, 5000))]:
            assert minhash.fingerprint(text, bins, bits) == plain_print(text, bins, bits)


def test_fingerprints_of_clashing_repeated_and_empty_tables(spark):
    got = Counter((r.doc_id, r.fingerprint) for r in minhash.fingerprints(table(spark, ROWS)).collect())
    assert got == Counter((i, minhash.fingerprint(t)) for i, t in ROWS)
    assert minhash.compare_with_next(table(spark, ROWS).limit(0)).count() == 0
    pairs = minhash.compare_with_next(table(spark, [(1, words(1, 60_000)), (2, None), (2, None)])).collect()
    assert sorted((r.doc_id, r.n_chars, r.near_next) for r in pairs) == [(1, len(words(1, 60_000)), 0.0), (2, 0, 0.0), (2, 0, 1.0)]


def test_identifiers_from_content_tell_windows_apart():
    raw = (words(70, 300) + words(71, 40) + words(70, 300)).encode() + b"ab" * 400
    for length in (8, 9, 100, 200, 257):
        n = len(raw) - length + 1
        ids = [tuple(x) for x in suffixes.content_identifiers(raw, n, length).tolist()]
        of = defaultdict(set)
        for p, i in enumerate(ids):
            of[i].add(raw[p : p + length])
        assert len(ids) == n and all(len(x) == 1 for x in of.values()) and len(of) == len({raw[p : p + length] for p in range(n)})
