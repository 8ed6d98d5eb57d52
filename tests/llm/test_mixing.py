import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from pagelake.llm import mixing

SCHEMA = "doc_id long, source string, text string, taken string, rank int"


def refill(sizes, weights=mixing.WEIGHTS, share=mixing.SHARE, repeats=mixing.REPEATS):
    """Targets by the rule as it is told: share out, cut at the cap, share the excess again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, target, open_ = share * sum(sizes.values()), {}, set(order)
    while open_:
        part = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if part[s] > repeats * sizes[s]}
        if not over:
            target |= part
            break
        for s in over:
            target[s] = float(repeats * sizes[s])
            left -= target[s]
        open_ -= over
    return target


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def plain(rows):
    """The mix in plain Python: packets by finish time, cut at the budget."""
    docs = [(i, s, words(t), hashlib.md5(f"{mixing.SEED}:{'null' if i is None else i}".encode()).hexdigest(),
             hashlib.md5((t or "").encode()).hexdigest()) for i, s, t in rows]
    sizes = {}
    for d in docs:
        sizes[d[1]] = sizes.get(d[1], 0) + d[2]
    target = refill(sizes)
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    packets = []
    for rank, s in enumerate(order):
        at = 0
        mine = sorted((d for d in docs if d[1] == s), key=lambda d: (d[3], d[0] is not None, d[0] or 0, d[4], d[2]))
        for _ in range(mixing.REPEATS):
            for d in mine:
                borders = [at, at + d[2]]
                if at < int(target[s]) < at + d[2]:
                    borders.insert(1, int(target[s]))
                for a, b in zip(borders, borders[1:]):
                    packets.append((b / target[s] if target[s] else float("inf"), rank, b, b - a, docs.index(d), id(d)))
                at += d[2]
    taken, left = {id(d): 0 for d in docs}, int(mixing.SHARE * sum(sizes.values()))
    for *_, n, _, who in sorted(packets, key=lambda p: p[:4]):
        taken[who] += min(n, left)
        left -= min(n, left)
    return sorted(((d[0], d[2], sizes[d[1]], target[d[1]], taken[id(d)]) for d in docs), key=str)


def run(spark, rows):
    df = spark.createDataFrame([(*r, "clash", 5) for r in rows], SCHEMA)
    out = mixing.taken_per_document(mixing.mix_documents(df.repartition(3)))
    return sorted((tuple(r) for r in out.select("doc_id", "size", "source_size", "target", "taken").collect()), key=str)


def same(got, want):
    assert len(got) == len(want)
    for g, w in zip(got, want, strict=True):
        assert g[:3] == w[:3] and g[3] == pytest.approx(w[3], rel=1e-12) and g[4] == w[4]


def corpus(n, seed):
    rng = random.Random(seed)
    sources = ["hot"] * 10 + ["a", "b", "é", "\U0001f600", "￮", None]
    return [(i, rng.choice(sources), "w " * rng.randint(0, 40)) for i in range(n)]


def test_against_plain_python(spark):
    rows = corpus(400, 1)
    got = run(spark, rows)
    same(got, plain(rows))
    by = {}
    for _, size, total, target, taken in got:
        assert 0 <= taken <= 2 * size
        by.setdefault((total, target), []).append(taken)
    for (_, target), taken in by.items():
        assert abs(sum(taken) - target) <= 7
    assert run(spark, rows) == got


def test_one_long_document_and_small_sources(spark):
    rows = [(1, "a", "w\t" * 20_000), (2, "b", "x " * 30), (3, "b", "x"), (4, "c", " \n "), (5, None, "u v")]
    got = run(spark, rows)
    same(got, plain(rows))
    assert {r[0]: r[4] for r in got}[4] == 0


def test_nulls_ties_repeats_and_empty(spark):
    rows = [(None, "a", "x y"), (None, None, None), (1, "a", "x"), (1, "a", "x"), (1, "a", "x y z"), (2, "", ""), (2, "", "")]
    got = run(spark, rows)
    assert len(got) == 7 and sum(r[4] for r in got) == 10
    same([r for r in got], plain(rows))
    assert run(spark, []) == []
    assert [r[1:] for r in run(spark, [(1, "a", ""), (2, None, None)])] == [(0, 0, 0.0, 0), (0, 0, 0.0, 0)]


def test_order_of_the_mix(spark):
    """Every stretch of the mix serves the sources near their shares, and positions are the running sum."""
    rng = random.Random(4)
    rows = [(i, rng.choice("abc"), "w " * 5) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    mix = sorted(mixing.mix_documents(df).where("taken > 0").collect(), key=lambda r: r.position)
    at = 0
    for r in mix:
        assert r.position == at
        at += r.words
    half = [r for r in mix if r.position < at / 2]
    for s in "abc":
        target = next(r.target for r in mix if r.source == s)
        assert abs(sum(r.taken for r in half if r.source == s) - target / 2) <= 10


def test_targets(spark):
    sizes = {"a": 10, "b": 1000, "c": 7, "d": 0, "e": 400, None: 90}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    out, budget, n = mixing.source_targets(df)
    got = {r.source: r.target for r in out.collect()}
    want = refill(sizes)
    assert budget == 1.5 * 1507 // 1 and n == 6 and got.keys() == want.keys()
    for s, t in want.items():
        assert got[s] == pytest.approx(t, rel=1e-12)
    everything, budget, _ = mixing.source_targets(df, share=5.0)
    assert {r.source: r.target for r in everything.collect()} == {s: 2.0 * v for s, v in sizes.items()} and budget == 3014


def test_native_and_parameters(spark):
    df = spark.createDataFrame(corpus(20, 2), "doc_id long, source string, text string")
    plan = mixing.taken_per_document(mixing.mix_documents(df, size=F.length("text")))._jdf.queryExecution().toString()
    assert "Python" not in plan and "MapIn" not in plan
    for bad in ({"weights": ()}, {"weights": (0,)}, {"share": -1.0}, {"repeats": 0}):
        with pytest.raises(ValueError):
            mixing.mix_documents(df, **bad)
