"""The trained tables against Kneser-Ney written plainly with dictionaries, and models held in several slices."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from ledgerline.llm import langid

SCHEMA = "doc_id long, text string, lang string, _hash string, f int"


def plain_characters(text):
    """Lower-cased letters, anything else one space."""
    out = ""
    for c in text.lower():
        c = c if c.isalpha() else " "
        if c != " " or not out.endswith(" "):
            out += c
    return out[1:] if out.startswith(" ") else out


def plain_grams(text):
    padded = "   " + plain_characters(text)
    return [padded[i : i + 4] for i in range(len(padded) - 3)]


class Plain:
    def __init__(self, texts, alphabet):
        level, self.levels, self.alphabet = Counter(g for t in texts for g in plain_grams(t)), {}, alphabet
        for order in (4, 3, 2, 1):
            ones, twos = sum(n == 1 for n in level.values()), sum(n == 2 for n in level.values())
            total, followers = defaultdict(int), defaultdict(int)
            for g, n in level.items():
                total[g[:-1]] += n
                followers[g[:-1]] += 1
            self.levels[order] = (level, total, followers, ones / (ones + 2 * twos) if ones and twos else 0.75)
            level = Counter(g[1:] for g in level)

    def probability(self, gram):
        if not gram:
            return 1 / self.alphabet
        count, total, followers, off = self.levels[len(gram)]
        h, lower = gram[:-1], self.probability(gram[1:])
        return max(count[gram] - off, 0) / total[h] + off * followers[h] / total[h] * lower if h in total else lower

    def entropy(self, text):
        grams = plain_grams(text)
        return -sum(math.log(self.probability(g)) for g in grams) / max(len(grams), 1)


@pytest.fixture(scope="module")
def rows():
    r = random.Random(12)

    def text(letters, n):
        return " ".join("".join(r.choice(letters) for _ in range(r.randint(1, 7))) for _ in range(n))

    made = [(i, text(("abcdef", "cdefghé", "efxyz")[i % 3], 20 + i % 9), ("aa", "bb", "cc")[i % 3], "h", 1) for i in range(90)]
    return [*made, made[0], made[0], (200, None, "aa", None, None), (201, "", "bb", "h", 1), (None, "12, 3", None, "h", 1), (202, "ÄÖ! unseen LETTERS", None, "h", 1)]


def test_entropies_are_those_of_plain_kneser_ney(spark, rows):
    learned = [(t, lang) for i, t, lang, _, _ in rows if t is not None and lang and zlib.crc32(str(i if i is not None else "").encode()) % 3 != 1]
    alphabet = len({g[-1] for t, _ in learned for g in plain_grams(t)}) + 1
    plain = [Plain([t for t, x in learned if x == lang], alphabet) for lang in ("aa", "bb", "cc")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    model = langid.train(df)
    assert model.langs == ["aa", "bb", "cc"] and model.alphabet == alphabet
    texts = [t for _, t, _, _, _ in rows if t]
    sums, n = model.tables().sums(texts)
    assert [int(x) for x in n] == [len(plain_grams(t)) for t in texts]
    assert np.allclose(-sums / np.maximum(n, 1)[:, None], [[p.entropy(t) for p in plain] for t in texts], atol=1e-5)
    for r in langid.identify(df, model).collect():
        if r.text and any(map(str.isalpha, r.text)):
            all_ = [p.entropy(r.text) for p in plain]
            assert r.lang_pred == model.langs[int(np.argmin(all_))] and abs(r.entropy - min(all_)) < 1e-5
        else:
            assert (r.lang_pred, r.score, r.accepted) == ("und", 0.0, False)


def test_slices_give_the_rows_of_one_slice(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    one, many = langid.train(df), langid.train(df, most_cells=2500)
    assert one.slices == 1 and many.slices > 2
    assert np.allclose(one.limits, many.limits)
    held = [many.tables(i).grams[4][0] for i in range(many.slices)]
    assert sorted(np.concatenate(held)) == sorted(one.tables().grams[4][0]) and max(map(len, held)) < len(one.tables().grams[4][0])

    def got(model):
        return sorted((r.doc_id or 0, r.text or "", r.lang or "", r._hash or "", r.f or 0, r.lang_pred, round(r.score, 9), r.accepted) for r in langid.identify(df, model).collect())

    assert got(one) == got(many) and len(got(one)) == len(rows)
    assert langid.identify(df.limit(0), many).count() == 0
