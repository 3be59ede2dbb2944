"""Fill-in-the-middle, token counts and the filter audit against plain versions, with the awkward rows."""

import hashlib
import random
import re
from collections import Counter
from itertools import permutations

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerline.llm import audit, fim, tokencount
from tests.llm.test_operators import words

CLASH = "doc_id long, text string, lang string, n long, form string, row long, part string, code long, n_tokens int, fails string"
BIG = (1 << 60) + 1


def table(spark, rows, langs=("en", None, "fr")):
    return spark.createDataFrame([(i, t, langs[k % len(langs)], 7, "x", 1, "p", 2, 3, "f") for k, (i, t) in enumerate(rows)], CLASH).repartition(3)


TEXTS = [None, "", "a", "Aa", "<P>", "x <S> y", "<", "é😀", "It's 12 o'clock,\n\n really.", "a<S", "<P", words(1, 300), words(1, 300), "ÀB1c" * 700, "z" * 5000, " ", "\n"]
ROWS = [(i, t) for i, t in enumerate(TEXTS * 6)] + [(BIG, "AB cd"), (None, "no id"), (None, None), (3, "Aa"), (3, "Aa"), (900, words(2, 40_000))]


def plain_fim(doc, text):
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    g = hashlib.sha256(f"1:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(g[i : i + 8], 16) for i in (0, 8, 16, 24)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if text == "" or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(units), "plain", None, None, text
    return len(units), *(("spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}") if h[3] % 100 < 20 else ("psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"))


def test_fim_matches_a_plain_version(spark):
    got = Counter(tuple(r) for r in fim.fill_in_middle(table(spark, ROWS), with_text=True).collect())
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = Counter((i, n, f, a, b, sha(o), sha(t or ""), o) for i, t in ROWS for n, f, a, b, o in [plain_fim(i, t or "")])
    assert got == want and {r[2] for r in got} == {"plain", "psm", "spm"}
    assert fim.fill_in_middle(table(spark, ROWS).limit(0)).count() == 0


def test_pieces_are_cut_and_put_back():
    r = random.Random(5)
    for _ in range(200):
        raw = "".join(r.choice("ab<PSM>é ") for _ in range(r.randint(1, 40))).encode()
        whole = fim.PieceTable.of(raw)
        a = r.randint(0, len(raw))
        left, right = whole.cut(a)
        assert left.joined() == raw[:a] and right.joined() == raw[a:] and whole.joined() == raw
        again = fim.PieceTable(whole.buffers, left.pieces + right.pieces).cut(len(raw) // 2)
        assert b"".join(x.joined() for x in again) == raw
        starts = fim.unit_starts(raw)
        assert [fim.position(starts, k, block=3) for k in range(int(starts.sum()) + 1)] == [*starts.nonzero()[0].tolist(), len(raw)]


NASTY = ["the cat's 're we'll 12 34\t\n  x", "  ", "   <|endoftext|>  ", "<|endoftext|>", "<|endoftext", "|>", "é", "😀😀", "…", "\r\n", "''s", "!!", "a" * 30, " " * 9, "7" * 12, "ÀÉ", "don't", "x y", "\x1c", "日本語の文"]


def nasty(seed, n):
    r = random.Random(seed)
    return "".join(r.choice(NASTY) for _ in range(n))


@pytest.mark.parametrize(("stride", "overlap"), [(61_440, 4_096), (80, 40), (200, 60)])
def test_token_counts_are_those_of_the_library(spark, stride, overlap):
    rows = [*ROWS[:23], (None, None), (None, "no id"), *[(1000 + i, nasty(i, 5 + 3 * i)) for i in range(60)], (2000, "b" * 3000), (2001, "b" * 300 + " c" * 200 + "!" * 500 + nasty(99, 90)), (2002, " " * 1500 + "x"), (BIG, words(3, 900)), (BIG, words(3, 900))]
    library = Tokenizer.from_file(tokencount.vocabulary())
    want = Counter()
    for i, t in rows:
        n = len(library.encode(t or "", add_special_tokens=False))
        want[i, len((t or "").encode()), n, n > 200] += 1
    got = Counter(tuple(r) for r in tokencount.count_tokens(table(spark, rows), tokencount.vocabulary(), 200, stride, overlap).collect())
    assert got == want
    assert tokencount.count_tokens(table(spark, rows).limit(0), tokencount.vocabulary(), 200, stride, overlap).count() == 0


def test_pieces_of_all_letters_and_spaces_are_those_of_the_library():
    library, count = Tokenizer.from_file(tokencount.vocabulary()), tokencount.PieceCounter(tokencount.vocabulary(), 50_000)
    some = [c for c in [*range(0x3400), *range(0xA000, 0xD800, 7), *range(0xE000, 0x20000, 3)] if not 0xD800 <= c < 0xE000]
    texts = [f"a{chr(c)}b 1{chr(c)}1 !{chr(c)}! {chr(c)}{chr(c)} x" for c in some]
    for t, e in zip(texts, library.encode_batch_fast(texts, add_special_tokens=False), strict=True):
        assert count.count(t) == len(e)
        count.known.renew()


def plain_audit(rows, labels):
    kind = {}
    for i, q, t in labels:
        if i is not None:
            a, b = kind.get(i, (0, 0))
            kind[i] = (a or int(q == 1), b or int(t == 1))
    first = {}
    for i, _, t in rows:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    out = {}
    for i, part, text in rows:
        text = text or ""
        w = re.findall("[^\x20\x09-\x0d]+", text)
        fails = {k for k, v in zip("ABCDE", (len(w) < 100, 100 * len(set(w)) < 80 * len(w), 100 * len(re.findall("[A-Z]", text)) > 10 * len(text), re.search("[#$%&*|]", text), i is not None and i > first[text])) if v}
        for order in map("".join, permutations("ABCDE")):
            gone = False
            for step, k in enumerate(order, 1):
                c = out.setdefault((part or "", order, step), [0] * 6)
                now = k in fails and not gone
                c[1] += now
                c[2] += k in fails and gone
                c[3] += fails == {k}
                c[4] += now and kind.get(i, (0, 0))[0]
                c[5] += now and kind.get(i, (0, 0))[1]
                gone = gone or k in fails
                c[0] += not gone
    total = Counter()
    for (part, order, step), c in out.items():
        total[part, order[step - 1]] += c[1]
    return {(*k, *c, total[k[0], k[1][k[2] - 1]]) for k, c in out.items()}


@pytest.mark.parametrize(("shard_bytes", "bits"), [(16_000_000, 64), (3000, 64), (3000, 6)])
def test_audit_matches_a_plain_version(spark, shard_bytes, bits):
    r = random.Random(6)
    texts = [*TEXTS, words(7, 120), "SHOUT " * 120, " ".join(words(8, 90).split() + ["x#"] * 30), "é É " * 80, words(9, 101).upper()]
    rows = [(r.randrange(300), r.choice(texts)) for _ in range(400)] + [(None, "Aa"), (None, None), (5, "Aa"), (5, "Aa"), (BIG, "Aa")]
    docs = table(spark, rows)
    labels = [(i, i % 2, i % 3) for i in range(0, 300, 2)] + [(4, 1, None), (4, None, 1), (None, 1, 1), (7, None, None)]
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    want = plain_audit([(x.doc_id, x.lang, x.text) for x in docs.collect()], labels)
    names = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert {tuple(x) for x in audit.audit(docs, known, shard_bytes, bits).select(names).collect()} == want
    assert audit.audit(docs.limit(0), known, shard_bytes, bits).count() == 0


def test_dictionary_gives_each_word_one_code(spark):
    docs = table(spark, [(i, words(i, 50)) for i in range(40)]).select("doc_id", "lang", "text")
    every = {w.encode() for r in docs.collect() for w in r.text.split()}
    for bits in (64, 5):
        shards = audit.term_matrix(docs, 2000, bits)
        got = audit.dictionary(shards, bits).collect()
        assert {bytes(r.word) for r in got} == every and len(got) == len(every) == len({(r.code, r.tie) for r in got})
        assert (audit.collisions(shards, bits) is None) == (bits == 64)
    assert shards.select("shard").distinct().count() > 3 and shards.filter(F.col("words").isNull()).count() > 3
