"""Every stage of the pipeline against a plain version, on a small table with planted rows, and on awkward tables."""

import random

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from ledgerline.llm import bpe

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LETTERS = {"xx": "abcdefgh", "yy": "efghijkl"}
RANDOM = random.Random(11)


def prose(n, letters):
    return " ".join("".join(RANDOM.choice(letters) for _ in range(RANDOM.randint(2, 7))) for _ in range(n))


def row(i, text, lang="xx"):
    return (i, text, lang, "s", None if text is None else len(text))


TOXIC, FOREIGN, SHARED = {*range(0, 640, 8)}, {7001, 7002}, prose(80, LETTERS["xx"])
ROWS, LABELS = [], []
for _i in range(640):
    _lang = "xx" if _i % 2 else "yy"
    _text = prose(60, LETTERS[_lang])
    if _i in TOXIC:
        _text += " " + " ".join(RANDOM.choice(["zzvile", "zzscum", "zzmoron"]) for _ in range(4))
    ROWS.append(row(_i, _text, _lang))
    LABELS.append((_i, None, int(_i in TOXIC)))
ROWS += [row(7001, prose(60, "рстуфхцч"), None), row(7002, "12 34 !!", "yy")]
_base = prose(70, LETTERS["xx"]).split()
for _i in range(6):  # a chain of near copies, each one word off the last
    ROWS.append(row(7100 + _i, " ".join(_base)))
    _base[10 * _i + 5] = prose(1, LETTERS["xx"])
ROWS += [row(7200 + i, prose(40, LETTERS["xx"]) + " " + SHARED + " " + prose(40, LETTERS["xx"])) for i in range(4)]
ROWS += [row(7300, ROWS[1][1]), ROWS[1], row(None, ROWS[3][1]), row(None, prose(50, LETTERS["yy"])), row(7400, None), row(7401, ""), row(7402, prose(30_000, LETTERS["yy"]), "yy")]
AWKWARD = {7001, 7002, 7400, 7401}


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The rows that each stage got and gave."""
    home = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(ROWS, SCHEMA).repartition(3).write.parquet(f"{home}/documents.parquet")
    spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int").write.parquet(f"{home}/labels.parquet")
    out, docs = {}, spark.read.parquet(f"{home}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        stage(spark, docs, home).write.parquet(f"{home}/{name}")
        docs = spark.read.parquet(f"{home}/{name}")
        out[name] = (before, docs.collect())
    return out | {"home": home, "run": corpus_pipeline.run(spark, home).collect()}


def ids(rows):
    return sorted(r.doc_id if r.doc_id is not None else -1 for r in rows)


def test_toxic_rows_go(stages):
    before, after = stages["toxicity"]
    assert ids(after) == sorted(i for i in ids(before) if i not in TOXIC)
    assert {tuple(r) for r in after} <= {tuple(r) for r in before}


def test_texts_of_no_learned_language_go(stages):
    before, after = stages["language"]
    assert ids(after) == [i for i in ids(before) if i not in AWKWARD]


def shingles(text):
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def test_one_row_of_each_group_stays(stages):
    before, after = stages["near_copies"]
    sets, group = [shingles(r.text) for r in before], list(range(len(before)))
    for a in range(len(before)):
        for b in range(a):
            if group[a] != group[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                group = [group[b] if g == group[a] else g for g in group]
    first = {}
    for g, r in zip(group, before):
        key = (r.doc_id is None, r.doc_id)
        first[g] = min(first.get(g, (key, r.text)), (key, r.text))
    assert sorted((k[0][0], k[0][1] or 0, k[1]) for k in first.values()) == sorted((r.doc_id is None, r.doc_id or 0, r.text) for r in after)
    assert len(after) < len(before) and ids(after).count(1) == 1 and 7101 not in ids(after)


def test_repeated_passages_go(stages):
    before, after = stages["repeats"]
    seen, raws = {}, [r.text.encode() for r in before]
    for raw in raws:
        for p in range(len(raw) - 199):
            seen[raw[p : p + 200]] = seen.get(raw[p : p + 200], 0) + 1
    want = []
    for r, raw in zip(before, raws):
        gone = np.zeros(len(raw), bool)
        for p in range(len(raw) - 199):
            if seen[raw[p : p + 200]] > 1:
                gone[p : p + 200] = True
        text = bytes(b for b, g in zip(raw, gone) if not g).decode("utf-8", "ignore")
        want.append((r.doc_id or -1, text, r.lang, r.source, len(text)))
    assert sorted(want, key=str) == sorted(((r.doc_id or -1, *r[1:]) for r in after), key=str)
    assert max(len(r.text) for r in after if r.doc_id in range(7200, 7204)) < 700


def test_packing_holds_every_id(stages):
    before, after = stages["packing"]
    tok = Tokenizer.from_file(bpe.vocabulary())
    want = sorted((r.doc_id or -1, len(tok.encode(r.text, add_special_tokens=False).ids) + 1) for r in before)
    held = {}
    for r in after:
        held[r.doc_id or -1] = held.get(r.doc_id or -1, 0) + r.length
    assert want == sorted(held.items())
    assert sorted(tuple(r)[:5] for r in stages["run"] if r.doc_id) == sorted(tuple(r)[:5] for r in after if r.doc_id)


@pytest.mark.parametrize("name", [k for k, _ in corpus_pipeline.STAGES])
def test_empty_tables_and_extra_columns(spark, stages, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    clash = ", score double, predicted int, accepted boolean, comp long, th long, id long, kept binary, n_spans long, _th int, rows int"
    empty = spark.createDataFrame([], SCHEMA + clash)
    assert stage(spark, empty, stages["home"]).count() == 0
    few = spark.createDataFrame([(*r, *[None] * 10) for r in ROWS[:40]], SCHEMA + clash)
    got = stage(spark, few, stages["home"])
    assert name == "packing" or got.columns == corpus_pipeline.COLUMNS
    assert got.count() > 0
