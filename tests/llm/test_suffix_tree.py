import math
import os
import pickle
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagelake.llm import suffix_tree as st

END = object()


def tokens(text):
    return [*((text or "").encode().lower().split()), END]


class Brute:
    """The same tree with dictionaries, straight from the definitions."""

    def __init__(self, texts):
        seqs = [tokens(t) for t in texts]
        self.c = Counter(w for s in seqs for w in s)
        self.n = sum(self.c.values())
        n1, n2 = (sum(v == k for v in self.c.values()) for k in (1, 2))
        self.d = min(max(n1 / (n1 + 2 * n2) if n1 else 0.5, 0.1), 0.9)
        self.freq = {w for w, v in self.c.items() if v >= st.GAMMA_MIN * self.n}
        least, kept = max(2.0, st.P_MIN * self.n), max(2.0, st.GAMMA_MIN * self.n)
        follow = {}
        for s in seqs:
            for i, w in enumerate(s):
                for ctx in self.contexts(s, i):
                    follow.setdefault(ctx, Counter())[w] += 1
        self.follow = {x: f for x, f in follow.items() if sum(f.values()) >= least and all(
            w == "begin" or w in self.freq for w in x)}
        self.edges = {x: {w: v for w, v in f.items() if v >= kept and w in self.freq} for x, f in self.follow.items()}
        self.retained = set()
        for x in sorted(self.follow, key=len):
            total = sum(self.follow[x].values())
            e = self.edges[x]
            rest = 1 - sum((v - st.DISCOUNT) / total for v in e.values())
            other = 1 - sum(self.p(x[1:], w) for w in e)
            gain = sum((v - st.DISCOUNT) / total * math.log((v - st.DISCOUNT) / total / self.p(x[1:], w))
                       for w, v in e.items()) + rest * math.log(rest / other)
            if total * gain >= st.DIVERGENCE:
                self.retained |= {x, x[1:]} - {()}

    def contexts(self, s, i):
        before = ["begin", *s[:i]]
        return [tuple(before[-k:]) for k in (1, 2) if len(before) >= k]

    def p(self, x, w):
        if not x:
            return (self.c[w] - self.d if self.c[w] else self.d * len(self.c)) / self.n
        total, e = sum(self.follow[x].values()), self.edges[x]
        if w in e:
            return (e[w] - st.DISCOUNT) / total
        rest = 1 - sum((v - st.DISCOUNT) / total for v in e.values())
        return rest / (1 - sum(self.p(x[1:], v) for v in e)) * self.p(x[1:], w)

    def state(self, s, i):
        return max((x for x in self.contexts(s, i) if x in self.retained), key=len, default=())

    def score(self, text):
        s = tokens(text)
        return sum(math.log10(self.p(self.state(s, i), w)) for i, w in enumerate(s))

    def base(self, text):
        return sum(math.log10((self.c[w] + 1) / (self.n + len(self.c) + 1)) for w in tokens(text))


def corpus(seed=1, n=150):
    r = random.Random(seed)
    rows = []
    for d in range(n):
        w, out = "the", []
        for _ in range(r.randrange(0, 60)):
            w = r.choice({"the": ["cat", "dog", "Bird"], "cat": ["sat", "ran"], "dog": ["ran", "the"], "of": ["the"]}.get(
                w, ["the", "of", "x%d" % r.randrange(200), "on"]))
            out.append(w)
        rows.append((d, " ".join(out)))
    return rows + [(n, None), (n + 1, ""), (n + 1, "the cat"), (None, "the cat sat of the dog"), (n + 2, "unseenword " * 3),
                   (n + 3, "the cat sat\n" * 3000)]


def held(d):
    return d is not None and zlib.crc32(str(d).encode()) % 7 == 2


@pytest.mark.parametrize("p_min,gamma,divergence", [(1e-5, 1e-6, 12.0), (0.004, 0.002, 3.0), (0.02, 0.001, 0.5)])
def test_matches_brute_force(spark, monkeypatch, p_min, gamma, divergence):
    for k, v in {"P_MIN": p_min, "GAMMA_MIN": gamma, "DIVERGENCE": divergence, "CHUNK": 700}.items():
        monkeypatch.setattr(st, k, v)
    rows = corpus()
    model = Brute([t for d, t in rows if not held(d)])
    assert any(len(x) == 2 for x in model.retained)
    df = spark.createDataFrame([(*r, 1, "n") for r in rows], "doc_id long, text string, code int, n string")
    got = sorted(map(tuple, st.score_documents(df, st.held_out_fold("doc_id")).collect()), key=str)
    want = sorted(((d, held(d), len(tokens(t)), sum(model.c[w] > 0 for w in tokens(t)), model.n, model.base(t),
                    model.score(t)) for d, t in rows), key=str)
    for g, w in zip(got, want, strict=True):
        assert g[:5] == w[:5]
        np.testing.assert_allclose(g[5:], w[5:], rtol=1e-9)
    words = [*model.c, "unknown"]
    for x in [(), *model.retained]:
        assert abs(sum(model.p(x, w) for w in words) - 1) < 1e-9


def test_held_out_texts_gain(spark):
    from pagelake.llm.queries import op2_suffix_tree_scores

    out = op2_suffix_tree_scores(spark, "/root/testdata/sf0.01")
    r = out.where("held_out").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b"),
                                  F.sum("n_tokens").alias("n"), F.count("*").alias("docs")).first()
    assert r.docs > 100 and r.s > r.b
    assert (r.s - r.b) / r.n > 0.2  # a fifth of a decade per token
    plain = out.where("NOT held_out").agg(F.sum("n_tokens").alias("n"), F.max("train_tokens").alias("t")).first()
    assert plain.n == plain.t


def test_empty_and_untrained(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    assert st.score_documents(df.limit(0), F.lit(False)).count() == 0
    got = st.score_documents(df, F.lit(True)).orderBy("doc_id").collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got] == [(3, 0, 0, 0.0, 0.0), (1, 0, 0, 0.0, 0.0)]


def test_index():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 5000).astype(np.uint64) * np.uint64(2))
    index = st.Index(keys)
    assert (index.find(keys) == np.arange(len(keys))).all()
    assert (index.find(keys + np.uint64(1)) == -1).all()
    assert len(st.Index(keys[:0]).find(keys)) == len(keys)


@pytest.mark.parametrize("head", [0, 12, 10_000])
def test_rare_contexts_of_a_large_corpus(spark, monkeypatch, head):
    """What occurs twice counts, however large the corpus is, broadcast or joined."""
    twice = "some words occur twice in a large corpus and nowhere else in it"
    texts = [twice, twice, "some words occur once", "other words " * 3, None, *["x " * 25] * 12_000]
    with monkeypatch.context() as m:
        m.setattr(st, "P_MIN", 0.0)
        m.setattr(st, "GAMMA_MIN", 0.0)
        model = Brute(texts)
    monkeypatch.setattr(st, "HEAD", head, raising=False)
    assert (b"corpus",) in model.retained
    asked = "words occur twice here"
    df = spark.createDataFrame([*((i, t, False) for i, t in enumerate(texts)), (-1, asked, True)],
                               "doc_id long, text string, held boolean")
    got = {r.doc_id: r.score for r in st.score_documents(df, F.col("held")).where("doc_id < 6").collect()}
    for i, text in [*enumerate(texts[:6]), (-1, asked)]:
        np.testing.assert_allclose(got[i], model.score(text), rtol=1e-9)


def test_ngram_codes_are_those_of_spark(spark):
    a, b = (np.random.default_rng(k).integers(0, 1 << 64, 200, dtype=np.uint64) for k in (1, 2))
    df = spark.createDataFrame([(int(x), int(y)) for x, y in zip(a.view(np.int64), b.view(np.int64))], "ctx long, suf long")
    assert [r.c for r in df.select(st._code().alias("c")).collect()] == st.join(a, b).view(np.int64).tolist()


def test_only_the_scores_stay_on_disk(spark, monkeypatch):
    monkeypatch.setattr(st, "HEAD", 12)
    work = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    before = set(os.listdir(work))
    df = spark.createDataFrame(corpus(), "doc_id long, text string")
    out = st.score_documents(df, st.held_out_fold("doc_id"))
    new = {x for x in set(os.listdir(work)) - before if not x.startswith(".")}
    assert [x.rpartition("-")[0] for x in new] == ["scores"]
    assert out.count() == len(corpus())


def test_broadcasts_hold_no_more_than_the_table(spark):
    keys = np.unique(np.random.default_rng(2).integers(0, 1 << 63, 100_000).astype(np.uint64))
    index = st.Index(keys)
    sent = pickle.dumps(index)
    assert len(sent) < 9 * len(keys)
    assert (pickle.loads(sent).find(keys) == np.arange(len(keys))).all()
    bits = st._bits(spark.createDataFrame([(int(k),) for k in keys[:1000].view(np.int64)], "code long"))
    assert bits.table.nbytes <= 8 * 1000 and bits.may_have(keys[:1000]).all()
