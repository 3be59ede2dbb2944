"""Each operator against a brute-force version, a round trip or held-out accuracy, with the awkward rows."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import bpe, html, langid, minhash, packing, simhash, suffixes, topk, toxicity, warc
from ledgerline.llm.components import components

TEXT = "doc_id long, text string, lang string, extra string"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", "x") for i, t in rows], TEXT).repartition(3)


def words(seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefgh") for _ in range(r.randint(2, 7))) for _ in range(n))


AWKWARD = [(1, None), (2, ""), (3, "One"), (3, "One"), (None, "no id"), (4, "a b c  d\te É ß 123 😀"), (5, words(1, 3000)), (6, words(1, 3000)), (7, words(2, 60) + " " + words(3, 80)), (8, words(4, 9) + " " + words(3, 80))]


def test_topk_matches_brute_force(spark):
    r = np.random.default_rng(1)
    rows = [(i, [int(x) for x in r.integers(-9, 9, 6)]) for i in range(300)] + [(900, [5] * 6), (901, [5] * 6), (902, None), (5, [0, 0, 0, 0, 0, 1]), (5, [0, 0, 0, 0, 0, 1]), (None, [1] * 6), (903, [3, 1]), (904, []), (905, [10**9] * 6)]
    df = spark.createDataFrame([(i, v, i, "x") for i, v in rows], "id long, vec array<bigint>, query_id long, rank string").repartition(3)
    known = [(i, v) for i, v in rows if i is not None and v is not None]
    wide = [(i, v + [0] * (6 - len(v))) for i, v in known]
    for k, extra in ((7, {"block_rows": 64, "slice_rows": 5, "group_rows": 100}), (400, {})):
        got = topk.exact_topk(df.filter("id % 20 = 0"), df, k=k, **extra).collect()
        want = []
        for q, x in ((i, v) for i, v in wide if i % 20 == 0):
            s = sorted((-sum(a * b for a, b in zip(x, v)), i) for i, v in wide if i != q)[:k]
            want += [(q, n + 1, i, -t) for n, (t, i) in enumerate(s)]
        assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == sorted(want)
    assert topk.exact_topk(df.limit(0), df.limit(0)).count() == topk.exact_topk(df, df.limit(0)).count() == 0


def test_topk_stops_early_where_the_bound_allows():
    r = np.random.default_rng(2)
    rows = np.round(1000 * r.pareto(1.5, (4000, 3))).astype(np.int64)
    queries = r.integers(1, 9, (10, 3))
    block = topk.build_block(np.arange(4000), rows)
    s, i = np.full((10, 5), topk.LEAST), np.full((10, 5), 10**9)
    scored = topk.threshold_search(block, np.full(10, -1), queries, s, i, 5)
    want = np.sort(queries @ rows.T, axis=1)[:, -5:]
    assert (np.sort(s, axis=1) == want).all() and scored < 0.2 * 10 * 4000
    smaller = topk.build_block(np.arange(4000, 8000), rows // 50)
    assert topk.threshold_search(smaller, np.full(10, -1), queries, s, i, 5) == 0


def test_scaled_leaves_out_bad_vectors(spark):
    df = spark.createDataFrame([(1, [0.5, -0.01]), (2, None), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (5, [None, 1.0])], "vec_id long, embedding array<float>")
    assert [(r.id, r.vec) for r in topk.scaled(df).collect()] == [(1, [32, -1])]


@pytest.mark.parametrize("bucket_rows", [50_000, 4])
def test_simhash_index_finds_every_link(spark, bucket_rows):
    r = random.Random(3)
    values = {r.getrandbits(64) for _ in range(150)}
    for v in list(values):
        for _ in range(3):
            for _ in range(r.randint(0, 3)):
                v ^= 1 << r.randrange(64)
            values.add(v)
    values = sorted(values | {0, 1})
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    edges = simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long"), bucket_rows=bucket_rows)
    root = {x.node: x.root for x in components(edges).collect()}
    label = {v: v for v in signed}
    for _ in range(len(signed)):
        new = {a: min(label[b] for b, y in zip(signed, values) if (x ^ y).bit_count() <= 3) for a, x in zip(signed, values)}
        if new == label:
            break
        label = new
    assert {v: root.get(v, v) for v in signed} == label


def test_simhash_rows(spark):
    got = simhash.near_duplicates(docs(spark, AWKWARD)).collect()
    assert len(got) == len(AWKWARD)
    by = {r.doc_id: r for r in got}
    assert by[1].fingerprint == by[2].fingerprint == "0" * 16 and by[2].component_id == 1
    assert by[6].component_id == 5
    assert simhash.near_duplicates(docs(spark, AWKWARD).limit(0)).count() == 0


PAGE = """<html><body><div id="header">Site</div><ul class="menu"><li><a href="#">x</a></ul><div class="cookie-notice">We use cookies</div>
<div class="post-12 content"><h1>T&eacute;st &lt;b&gt;</h1><p>Para one&nbsp;two <i>it</i>alic.<p>Para   three<br>line with enough words, and more.<ul><li>a<li>b</ul>
<div class="ad">BUY</div><form>f</form><p>last, one. with text enough, to be sure</div><div class="comments"><p>nice comment, long, very long, text text text text text</div><footer>foot</footer>"""


def test_html_text_and_votes(spark):
    short = PAGE.replace("Para   three<br>line with enough words, and more.", "x").replace("nice comment", "nice " * 50)
    rows = [(1, "http://h.org/1", PAGE), (2, "http://h.org/2", PAGE.replace("post-12", "post-9")), (3, "http://h.org/3", short), (4, None, None), (5, "bad", ""), (6, "http://o.org", "plain &amp; text"), (7, "http://o.org", "<p>a<script>var x='</p>'</script>b<!-- c --></p>")]
    got = {r.page_id: r.text for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[1] == got[2] == "Tést <b>\nPara one two italic.\nPara three line with enough words, and more.\na\nb\nlast, one. with text enough, to be sure"
    assert got[3].startswith("Tést") and "nice" not in got[3]
    assert got[4] == got[5] == "" and got[6] == "plain & text" and got[7] == "ab"


LONG = "".join(f"<p>{words(i, 30)}.</p>" for i in range(8))


@pytest.mark.parametrize("name", ["layout has-sidebar", "with-toc", "no-ads", "page-search", "sidebar"])
def test_html_layout_names_are_no_noise(name):
    for page in (f'<body><div class="{name}"><article><h1>Head</h1>{LONG}</article></div>', f'<body><div class="{name}"><div class="x"><h1>Head</h1>{LONG}</div></div>'):
        got = html.text_at(page, html.best_container(page)[0])
        assert got.startswith("Head\n") and words(7, 30) in got


def test_html_headline_and_lead_stay():
    page = f'<body><div class="menu"><a href="/">Home</a></div><div class="post"><h1>Head</h1><p class="lead">Lead text.</p><div class="post-body">{LONG}</div><div class="more"><ul><li><a href="/a">Other one</a></ul></div></div><div class="site-footer">Foot</div>'
    path = html.best_container(page)[0]
    got = html.text_at(page, path)
    assert path.endswith("div.post") and got.startswith("Head\nLead text.\n") and "Foot" not in got and "Home" not in got


def test_toxicity_held_out(spark):
    r = random.Random(5)
    rows, labels = [], []
    for i in range(1500):
        toxic = i % 8 == 0
        text = words(i + 10, 60) + (f" {r.choice(['zzvile', 'zzscum', 'zzmoron'])} {words(i, 9)}" if toxic else "")
        rows.append((i, text))
        if i % 2 == 0:
            labels.append((i, int(toxic)))
    df = docs(spark, [*rows, (9001, None), (9002, "")])
    model = toxicity.train(df, spark.createDataFrame(labels, "doc_id long, toxic int"))
    got = {x.doc_id: x.predicted for x in toxicity.score(df, model).collect()}
    held = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    assert np.mean([got[i] == (i % 8 == 0) for i in held]) > 0.97
    assert got[9001] == got[9002] == 0
    none = toxicity.train(df, spark.createDataFrame([], "doc_id long, toxic int"))
    assert toxicity.score(df, none).agg(F.max("score")).first()[0] == 0


def test_langid_held_out(spark):
    r = random.Random(6)

    def text(letters):
        return " ".join("".join(r.choice(letters) for _ in range(r.randint(2, 8))) for _ in range(40))

    rows = [(i, text("abcdefgh") if i % 2 else text("efghijklé"), "xx" if i % 2 else "yy") for i in range(400)] + [(800, None, "xx"), (801, "12 34", "yy"), (802, "", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {x.doc_id: x for x in langid.identify(df, langid.train(df)).collect()}
    assert all(got[i].lang_pred == lang for i, t, lang in rows[:400] if zlib.crc32(str(i).encode()) % 3 == 1)
    assert all(got[i].lang_pred == "und" and got[i].score == 0 and not got[i].accepted for i in (800, 801, 802))
    assert langid.identify(df, langid.train(df.limit(0))).filter("lang_pred <> 'und'").count() == 0


def test_langid_rare_language_has_a_limit(spark):
    r = random.Random(8)

    def text(letters):
        return " ".join("".join(r.choice(letters) for _ in range(r.randint(2, 8))) for _ in range(30))

    rows = [(i, text("abcdefgh"), "xx") for i in range(5000)] + [(9000 + i, text("рстуфх"), "zz") for i in range(36)] + [(9900 + i, text("klmn"), "yy") for i in range(6)]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.langs == ["xx", "yy", "zz"] and np.isfinite(model.limits).all()
    sums, n = model.tables().sums([t for _, t, lang in rows if lang == "zz"])
    own = -sums[:, 2] / n
    assert own.max() < model.limits[2] < np.log(model.alphabet)


def test_langid_keeps_all_languages_and_grams(spark):
    r = random.Random(9)
    rows = [(3 * i + k, "".join(chr(0x4E00 + 20 * i + r.randrange(20)) for _ in range(60)), f"l{i:02d}") for i in range(72) for k in range(3)]
    rows += [(1000 + i, "".join(chr(0x5800 + r.randrange(9000)) for _ in range(6000)), "wide") for i in range(60)]
    learned = [(t, lang) for i, t, lang in rows if zlib.crc32(str(i).encode()) % 3 != 1]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.langs == sorted({lang for _, lang in learned}) and len(model.langs) > 64
    assert model.grams.filter("order = 4").count() == len(np.unique(langid.keys_of([t for t, _ in learned])[0])) > 200_000


def test_packing_is_whole_and_tight(spark):
    from tokenizers import Tokenizer

    rows = [(i if i is not None else 77, t) for i, t in AWKWARD if i not in (3,)] + [(100 + i, words(i, 30 + 7 * i)) for i in range(60)]
    got = packing.pack(docs(spark, rows), bpe.vocabulary(), size=256, open_windows=4).toPandas()
    tok = Tokenizer.from_file(bpe.vocabulary())
    for i, t in rows:
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        own = got[got.doc_id == i].sort_values("start")
        assert own.start.tolist() == [0, *np.cumsum(own.length)[:-1].tolist()] and own.length.sum() == len(ids) == own.doc_tokens.iloc[0]
        assert all(zlib.crc32(ids[a : a + n].tobytes()) == c for a, n, c in zip(own.start, own.length, own.ids_crc32))
    for _, own in got.sort_values("offset").groupby("sequence_id"):
        assert own.offset.tolist() == [0, *np.cumsum(own.length)[:-1].tolist()]
        n = int(own.length.sum())
        assert n == 256 or n & (n - 1) == 0
    assert packing.pack(docs(spark, rows).limit(0), bpe.vocabulary()).count() == 0


def test_warc_round_trip(spark, tmp_path):
    rows = [(1, "http://a b/\n", "<p>é</p>"), (2, None, "<p>é</p>"), (3, "u", None), (4, "v", ""), (5, "w", "WARC/1.0\r\n\r\nfiledesc://\n"), (None, "n", "<p>é</p>"), (6, "x", "alone")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r for r in warc.archive(pages, str(tmp_path / "w")).collect()}
    assert len(got) == 7
    assert got[1].record_type == got[None].record_type == "revisit" and got[1].refers_to == 2 and got[2].record_type == "response"
    assert got[3].refers_to == 4 and got[4].payload_bytes == 0 and bytes(got[5].payload) == rows[4][2].encode() and got[6].refers_to is None


@pytest.mark.parametrize("version", [1, 2])
def test_arc_versions_and_lengths(version):
    raw = warc.write_arc([(1, "http://a/", b"x\ny"), (2, "http://b/", b"")], version, "f.arc")
    got = [(f["URL"], warc.http_parts(b)[1]) for f, b in warc.read_arc(raw)]
    assert got == [("http://a/", b"x\ny"), ("http://b/", b"")]
    with pytest.raises(ValueError):
        list(warc.read_arc(raw[:-6]))


def test_bpe_equals_the_library(spark):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(bpe.vocabulary())
    odd = ["Σ ΑΣ ΣΑΣ", "İstanbul I'LL don't 'RE x's", "a\x1cb \x1d", "<|endoftext|> hi<|startoftext|>x </w> a</w>", "123 ½ ² ٣", "é ẛ̣ ﬀ ǆ ẞ", "中文字符。。", "a" * 3000, "!?" * 300, "x\u0085y z"]
    rows = [(i, t) for i, t in enumerate([*odd, *[words(i, 50) for i in range(50)], None, ""])]
    for r in bpe.encode_documents(docs(spark, rows), bpe.vocabulary()).collect():
        want = tok.encode(rows[r.id][1] or "", add_special_tokens=False).ids
        assert list(r.ids) == want and r.decoded == tok.decode(want, skip_special_tokens=False)


def test_minhash_likeness_and_neighbours(spark):
    got = minhash.compare_with_next(docs(spark, AWKWARD), rows_each=2).toPandas()
    order = sorted(AWKWARD, key=lambda x: (x[0] is None, -(x[0] or 0), x[1] or ""))
    assert len(got) == len(order)

    def grams(t):
        w = (t or "").split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    for k, (i, t) in enumerate(order):
        if i in (3, None):
            continue
        after = order[(k + 1) % len(order)][1] or ""
        edit = minhash.edited(t or "", after)
        own = got[got.doc_id == i].iloc[0]
        assert own.edited_sha256 == hashlib.sha256(edit.encode()).hexdigest() and own.n_chars == len(t or "")
        for value, other in ((own.near_edited, edit), (own.near_next, after)):
            union = grams(t) | grams(other)
            assert abs(value - (len(grams(t) & grams(other)) / len(union) if union else 1)) < 0.15


@pytest.mark.parametrize("bucket_rows", [20_000, 2])
def test_suffix_dedup_is_exact(spark, bucket_rows, monkeypatch):
    monkeypatch.setattr(suffixes, "PIECE", 700)
    shared = words(50, 70)
    rows = [*AWKWARD, *[(100 + i, words(200 + i, 20) + shared[i : 380 - i] + words(300 + i, 20)) for i in range(12)], (150, "ab" * 900), (151, "abc" * 300 + shared), (152, "é" * 150 + words(9, 40))]
    raws = [(t or "").encode() for _, t in rows]
    seen = {}
    for raw in raws:
        for p in range(len(raw) - 199):
            seen[raw[p : p + 200]] = seen.get(raw[p : p + 200], 0) + 1
    want = []
    for (i, _), raw in zip(rows, raws):
        gone = np.zeros(len(raw) + 1, bool)
        for p in range(len(raw) - 199):
            if seen[raw[p : p + 200]] > 1:
                gone[p : p + 200] = True
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        want.append((i or -1, len(raw), int(gone.sum()), int((gone[:-1] & ~np.r_[False, gone[:-2]]).sum()) if raw else 0, kept))
    got = [(r.doc_id or -1, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffixes.deduplicate(docs(spark, rows), bucket_rows=bucket_rows).collect()]
    assert sorted(got) == sorted(want)


@pytest.mark.parametrize("again", [[(1, 1)], [(None, None)], [(1, 1), (2, 2)], [(1, 1, 1), (2,)]])
def test_suffix_repeated_rows_still_meet_other_texts(spark, again):
    shared = words(60, 80)
    whole = words(61, 20) + shared + words(62, 20)
    rows = [(i, whole) for group in again for i in group] + [(9, words(63, 20) + shared + words(64, 20)), (10, words(65, 90))]
    got = {r.doc_id: r for r in suffixes.deduplicate(docs(spark, rows)).collect()}
    assert got[9].n_spans == 1 and got[9].n_removed >= len(shared)
    assert all(got[i].n_removed == len(whole) for group in again for i in group) and got[10].n_removed == 0


def test_suffix_kept_text_drops_half_characters(spark):
    same = "ж" * 150
    rows = [(1, "é" + same + "ab"), (2, "ĩ" + same + "cd"), (3, None), (4, "")]  # é and ĩ end in one byte
    got = {r.doc_id: r for r in suffixes.deduplicate(docs(spark, rows), with_text=True).collect()}
    for i, text in rows:
        raw = (text or "").encode()
        assert bytes(got[i].kept).decode("utf-8", "ignore") == got[i].kept_text
        assert got[i].n_bytes == len(raw) and got[i].n_removed == len(raw) - len(got[i].kept)
    assert got[1].kept_text == "ab" and got[2].kept_text == "cd" and got[3].kept_text == got[4].kept_text == ""


def test_joined_runs_keeps_gaps(spark):
    rows = [(1, 0, 5, 9), (1, 0, 5, 7), (1, 0, 9, 12), (1, 0, 14, 20), (1, 0, 2, 4), (2, 0, 0, 3)]
    got = {r.id: [tuple(x) for x in r._spans] for r in suffixes.joined_runs(spark.createDataFrame(rows, "id long, th int, begin long, end long")).collect()}
    assert got == {1: [(2, 4), (5, 12), (14, 20)], 2: [(0, 3)]}
