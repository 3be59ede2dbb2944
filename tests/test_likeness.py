"""Likeness joins, clusters and search against plain versions; roll-ups that merge; indicators in one scan."""

import datetime as dt
import difflib
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import derived, facts, names, reads


def mutated(r, text):
    t = list(text)
    for _ in range(r.randint(0, 3)):
        at = r.randrange(len(t) + 1)
        kind = r.randrange(3)
        if kind == 0:
            t.insert(at, r.choice("abcdefgh"))
        elif at < len(t):
            t[at : at + 1] = [] if kind == 1 else [r.choice("abcdefgh")]
    return "".join(t) or "a"


def some_names(seed, n, low=1, high=26, letters="abcdefgh"):
    r = random.Random(seed)
    heads = ["".join(r.choice(letters) for _ in range(r.randint(low, high))) for _ in range(n // 4)]
    return heads + [mutated(r, r.choice(heads)) for _ in range(n - len(heads))]


def test_alike_finds_every_pair(spark):
    texts = sorted(set(some_names(1, 420) + some_names(2, 60, 1, 8, "ab") + ["a" * k for k in range(1, 30)] + ["ab" * k for k in range(1, 12)]))
    half = len(texts) // 2
    frame = lambda rows: spark.createDataFrame([("g", t) for t in rows], "g string, text string")
    got = {(r.a, r.b): r.r for r in names.alike(frame(texts), frame(texts[half:]), ["g"]).collect()}
    want = {}
    for a in texts:
        for b in texts[half:]:
            if a != b and (x := difflib.SequenceMatcher(None, a, b).ratio()) >= 0.85:
                want[a, b] = x
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in got)
    with pytest.raises(ValueError, match="0.85"):
        names.alike(frame(texts), frame(texts), ["g"], 0.5)


def plain_clusters(reads, least=0.85, least_reads=3):
    """The sequential rule: keys by how often they are read, each to the first leader that it is like."""
    key = lambda n: "".join(c for c in n.lower() if c.isascii() and c.isalnum()).translate(str.maketrans("l10", "iio"))
    n = Counter(reads)
    total = Counter()
    for name, count in n.items():
        total[key(name)] += count
    heads, of = [], {}
    for k in sorted(total, key=lambda k: (-total[k], k)):
        of[k] = next((h for h in heads if difflib.SequenceMatcher(None, k, h).ratio() >= least), k)
        if of[k] == k:
            heads.append(k)
    out = {}
    for head in heads:
        own = {name: c for name, c in n.items() if of[key(name)] == head}
        whole = sum(own.values())
        if whole >= least_reads:
            often = {a: c for a, c in own.items() if c >= max(2, 0.1 * whole)} or own
            best = max(often, key=lambda a: (a.count(" "), often[a], a))
            out |= {name: (c, best) for name, c in own.items()}
    return out


@pytest.mark.parametrize("seed", [3, 4])
def test_clusters_are_those_of_the_sequential_rule(spark, seed):
    r = random.Random(seed)
    spellings = some_names(seed, 160, 6, 24, "abc d")
    reads_ = [s for s in spellings for _ in range(r.choice([1, 1, 2, 5]))] + ["Xabcdefgh"] * 2 + ["Yabcdefgh"] * 3
    reads_ = [s for s in reads_ if s.strip()]
    got = {x.name: (x.n, x.canonical) for x in names.cluster_spellings(spark.createDataFrame([(s,) for s in reads_] + [(None,)], "name string")).collect()}
    assert got == plain_clusters(reads_)
    assert got["Xabcdefgh"] == (2, "Yabcdefgh")
    assert names.cluster_spellings(spark.createDataFrame([], "name string")).count() == 0


def test_leaders_along_a_long_chain(spark):
    n = 41
    nodes = spark.createDataFrame([(i,) for i in range(n)], "node int")
    pairs = spark.createDataFrame([(i + 1, i, i) for i in range(n - 1)], "node int, above int, place int")
    got = {r.node: r.leader for r in names.leaders(pairs, nodes).collect()}
    assert got == {i: i - i % 2 for i in range(n)}
    with pytest.raises(RuntimeError):
        names.leaders(pairs, nodes, most_rounds=3)


def plain_trigrams(text):
    out = set()
    for w in "".join(c if c.isascii() and c.isalnum() else " " for c in text.lower()).split():
        padded = f"  {w} "
        out |= {padded[i : i + 3] for i in range(len(padded) - 2)}
    return out


@pytest.mark.parametrize("least", [0.3, 0.5, 1.0])
def test_fuzzy_search_finds_all_that_share_enough(spark, least):
    titles = [f"the {a} {b}" for a, b in zip(some_names(7, 60, 3, 9), some_names(8, 60, 3, 9))] + ["the", ""]
    asked = [mutated(random.Random(i), t) for i, t in enumerate(titles[:25])] + ["the", "zzz", "", "!!"]
    e = spark.createDataFrame([("k", str(i), t) for i, t in enumerate(titles)], "kind string, key string, title string")
    got = {(r.asked, r.key): r.score for r in reads.fuzzy_search(e, spark.createDataFrame([(a,) for a in asked + asked], "asked string"), least).collect()}
    want = {}
    for a in asked:
        g = plain_trigrams(a)
        for i, t in enumerate(titles):
            if g and len(g & plain_trigrams(t)) >= math.ceil(least * len(g) - 1e-9):
                want[a, str(i)] = len(g & plain_trigrams(t)) / len(g)
    assert got == want


LOG = "day date, user_id string, auth string, route string, status int, ms double, bytes long, cache string, address string"


def test_rollup_is_exact_and_sketches_merge(spark):
    r = random.Random(5)
    start = dt.date(2024, 1, 1)
    rows = [(start + dt.timedelta(r.randrange(14)), r.choice(["u", None]), "key", r.choice(["/a", "/b"]), 200, r.choice([None, float(r.randrange(50)), r.random()]), 5, "hit", f"ip{r.randrange(300)}") for _ in range(4000)]
    log = spark.createDataFrame(rows, LOG)
    exact = {tuple(x): (x.p50, x.p95) for x in log.groupBy("day", "user_id", "auth", "route").agg(F.expr("percentile(ms, 0.5)").alias("p50"), F.expr("percentile(ms, 0.95)").alias("p95")).collect()}
    got = facts.usage_rollup(log).collect()
    assert len(got) == len(exact) and sum(x.n for x in got) == 4000
    for x in got:
        (p50, p95) = next(v for k, v in exact.items() if k[:4] == (x.day, x.user_id, x.auth, x.route))
        assert abs(x.p50 - p50) < 1e-9 and abs(x.p95 - p95) < 1e-9
    days = facts.usage_sketches(log, ["route"])
    weeks = facts.merged_usage(days.withColumn("week", F.date_trunc("week", "day")), ["route", "week"])
    assert weeks.count() == 4
    for x in facts.merged_usage(days, ["route"]).collect():
        own = sorted(t[5] for t in rows if t[3] == x.route and t[5] is not None)
        below = sum(v <= x.p50 for v in own) / len(own)
        assert abs(below - 0.5) < 0.03 and x.n == sum(t[3] == x.route for t in rows)
        assert abs(x.addresses - len({t[8] for t in rows if t[3] == x.route})) <= 6


def test_indicators_scan_the_observations_once(spark):
    day = lambda i: dt.date(2024, 1, 1 + i)
    rows = [(s, d, day(i), float(10 * n + i)) for n, (s, d) in enumerate([("a", "{}"), ("b", '{"side":"x"}'), ("b", '{"side":"y"}'), ("c", "{}")]) for i in range(3)]
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for pdf in batches:
            seen.add(len(pdf))
            yield pdf

    schema = "series_id string, dims_key string, obs_date date, value double"
    obs = spark.createDataFrame(rows, schema).mapInPandas(counted, schema)
    ab = {"a": "a", "b": "b|side=y"}
    minus = lambda i: derived.difference(i["b"], i["a"], [])
    specs = [
        derived.Spec("late", {"a": "=diff", "b": "c"}, minus), derived.Spec("diff", ab, minus, 20, 20), derived.Spec("all_b", {"b": "b"}, lambda i: i["b"]),
        derived.Spec("none", {"a": "zzz", "b": "a"}, minus), derived.Spec("spi", {"p": "spi:k"}, lambda i: i["p"].groupBy("obs_date").agg(F.max("value").alias("value"))),
    ]
    prices = spark.createDataFrame([("k", "i1", day(0), 5.0), ("k", "i2", day(0), 7.0), ("m", "i1", day(0), 9.0)], "city string, item string, obs_date date, value double")
    got = derived.run_specs(obs, specs, prices=prices).collect()
    assert seen.value == len(rows)
    of = lambda s: sorted(r.value for r in got if r.series_id == s)
    assert of("diff") == [20.0] * 3 and of("late") == [10.0, 11.0, 12.0] and len(of("all_b")) == 6 and of("none") == [] and of("spi") == [7.0]
    with pytest.raises(ValueError, match="read each other"):
        derived.by_dependency([derived.Spec("x", {"i": "=y"}, minus), derived.Spec("y", {"i": "=x"}, minus)])
