"""Fingerprint values by a plain version, and awkward tables: empty, repeated rows, null ids, long texts, clashing columns."""

import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from ledgerline.llm import html, langid, simhash, suffixes, toxicity, warc
from tests.llm.test_operators import words


def plain_fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    parts = re.findall("[^\x20\x09-\x0d]+", lower)
    shingles = [" ".join(parts[i : i + 3]) for i in range(len(parts) - 2)] or ([" ".join(parts)] if parts else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_values_and_clashing_columns(spark):
    texts = [None, "", " \t\x0b", "One", "a B", "É x y\x1cz A\x85b q", "a a a a a a", *[words(i, 3 + 5 * i) for i in range(30)], words(40, 70_000)]
    df = spark.createDataFrame([(i, t, "x", i) for i, t in enumerate(texts)], "doc_id long, text string, fp string, component_id int")
    got = {r.doc_id: r.fingerprint for r in simhash.near_duplicates(df).collect()}
    assert got == {i: f"{plain_fingerprint(t):016x}" for i, t in enumerate(texts)}


@pytest.mark.parametrize("copies", [0, 2])
def test_langid_and_toxicity_on_empty_repeated_and_long_tables(spark, copies):
    r = random.Random(4)
    rows = [(i, " ".join("".join(r.choice("abc" if i % 2 else "xyz") for _ in range(5)) for _ in range(30)) + (" zzvile" if i % 8 == 0 else ""), "aa" if i % 2 else "bb", "s", 9.0, 9) for i in range(400)]
    rows += [(900, words(1, 30_000), None, "s", 9.0, 9), (None, "abc cab bca", "aa", "s", 9.0, 9), (None, None, None, None, None, None)]
    schema = "doc_id long, text string, lang string, lang_pred string, score double, predicted int"
    df = spark.createDataFrame(rows * max(copies, 1), schema).limit(len(rows) * copies)
    labels = spark.createDataFrame([(i, int(i % 8 == 0)) for i in range(300)] * max(copies, 1), "doc_id long, toxic int").limit(300 * copies)
    guessed = langid.identify(df, langid.train(df))
    scored = toxicity.score(df, toxicity.train(df, labels))
    for out, names in ((guessed, ["lang_pred", "score", "accepted"]), (scored, ["score", "predicted"])):
        assert len(set(out.columns)) == len(out.columns) and out.count() == len(rows) * copies
        assert out.filter(F.col("score").isNull() | ~F.col("score").between(0, 1)).isEmpty()
        assert out.groupBy("doc_id", "text").agg(F.countDistinct(*names).alias("n")).filter("n > 1").isEmpty()


def test_archive_of_empty_repeated_and_long_pages(spark, tmp_path):
    schema = "page_id long, url string, html string, digest string, first long"
    rows = [(1, "u", "same", "x", 7), (1, "u", "same", "x", 7), (2, "v", "é" * 600_000, "x", 7), (3, "w", "same", "x", 7), (None, None, None, None, None)]
    got = sorted((r.page_id or 0, r.payload_bytes, r.record_type, r.refers_to) for r in warc.archive(spark.createDataFrame(rows, schema), str(tmp_path / "a")).collect())
    assert got == [(0, 0, "response", None), (1, 4, "revisit", 3), (1, 4, "revisit", 3), (2, 1_200_000, "response", None), (3, 4, "response", None)]
    assert warc.archive(spark.createDataFrame([], schema), str(tmp_path / "b")).count() == 0


def test_html_of_empty_repeated_and_clashing_tables(spark):
    schema = "page_id long, url string, html string, path string, text string"
    page = f"<body><article><p>{words(3, 40)}.</p></article></body>"
    long_ = "<body><article>" + f"<p>{words(5, 50)}</p>" * 4000 + "</article></body>"
    rows = [(1, "http://h/1", page, "p", "t"), (1, "http://h/1", page, "p", "t"), (2, "http://k/2", long_, None, None), (None, None, None, None, None)]
    got = sorted((r.page_id or 0, r.text) for r in html.extract(spark.createDataFrame(rows, schema)).collect())
    assert got == [(0, ""), (1, f"{words(3, 40)}."), (1, f"{words(3, 40)}."), (2, "\n".join([words(5, 50)] * 4000))]
    assert html.extract(spark.createDataFrame([], schema)).count() == 0


def test_html_forms_headers_and_footers_go_by_their_place(spark):
    para = lambda i: f"<p>{words(i, 30)}.</p>"
    body = "".join(map(para, range(8)))
    want = [f"{words(i, 30)}." for i in range(8)]
    pages = {
        1: f'<body><form id="aspnetForm"><div class="content"><h1>Title</h1>{body}</div></form></body>',
        2: f"<body><header><h1>Site</h1><a href=x>Home</a></header><article><header><h1>HEADLINE</h1></header>{body}</article><footer>Copyright {words(9, 40)}</footer></body>",
        3: f"<body><article><h1>Title</h1>{body}<footer>{para(20)}</footer></article></body>",
        4: f"<body><article><h1>Title</h1>{body}<footer><p>Share this</p><a href=x>more</a></footer></article><form><label>Your name</label><input></form></body>",
        5: f"<body><header><h1>Name of the site</h1></header><div><p>Short.</p></div><footer>{words(30, 60)}</footer></body>",
        6: f"<body><form><fieldset><label>Search {words(31, 9)}</label></fieldset></form><div>{body}</div></body>",
    }
    got = {r.page_id: r.text.split("\n") for r in html.extract(spark.createDataFrame([(i, f"http://h{i}/x", h) for i, h in pages.items()], "page_id long, url string, html string")).collect()}
    assert got == {1: ["Title", *want], 2: ["HEADLINE", *want], 3: ["Title", *want, f"{words(20, 30)}."], 4: ["Title", *want], 5: ["Short."], 6: want}


def test_suffix_dedup_of_empty_and_clashing_tables(spark):
    schema = "doc_id long, text string, kept string, _id long, _th int, _spans string"
    assert suffixes.deduplicate(spark.createDataFrame([], schema)).count() == 0
    rows = [(i, words(i % 2, 90), "k", 1, 1, "s") for i in range(3)] + [(None, None, None, None, None, None)]
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.n_removed > 0) for r in suffixes.deduplicate(spark.createDataFrame(rows, schema)).collect())
    assert got == [(-1, False), (0, True), (1, False), (2, True)]
